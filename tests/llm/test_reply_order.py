"""Depth-first reply order of threads with branches, and quotations from elsewhere."""

import random

from colophon.llm import quotations

SCHEMA = "conv_id long, turn long, role string, text string"


def preorder(parents, n):
    children = {}
    for k in range(n):
        children.setdefault(parents.get(k), []).append(k)

    def walk(k):
        return [k, *(x for c in children.get(k, []) for x in walk(c))]

    return [x for k in children[None] for x in walk(k)]


def test_replies_stand_behind_what_they_answer(spark):
    rows, want, rng = [], {}, random.Random(3)
    threads = {0: {1: 0, 2: 0, 3: 1}, 1: {k: rng.choice([k - 1, rng.randrange(k)]) for k in range(1, 40) if k % 9},
               2: {k: 0 for k in range(1, 30)}, 3: {}}
    for conv, parents in threads.items():
        n = 4 if not conv else 40
        rows += [(conv, k, "user", (f"> message number {parents[k]} of this\n" if k in parents else "")
                  + f"message number {k} of this") for k in range(n)]
        want[conv] = preorder(parents, n)
    linked = quotations.link_quotations(spark.createDataFrame(rows, SCHEMA)).cache()
    got = linked.collect()
    assert len(got) == len(rows)
    for conv, order in want.items():
        mine = sorted((r["root_turn"], r["reply_place"], r["turn"]) for r in got if r["conv_id"] == conv)
        assert [turn for _, _, turn in mine] == order
    texts = {r["conv_id"]: r["text"] for r in quotations.reply_ordered(linked).collect()}
    assert texts[0].split("\n\n") == [f"message number {k} of this" for k in (0, 1, 3, 2)]
    assert set(texts) == set(want)


def test_quotations_from_elsewhere_stay(spark):
    rows = [
        (1, 0, "user", "How do I open it?\nIt is a\nlarge file."),
        (1, 1, "assistant", "Run this:\n>>> open('x')\n>>> 1\n\n> It is a large\n> file.\nBob wrote:\n> How do I open it?\nyes"),
        (1, 2, "user", "Carl wrote:\n> never said here\n>\n> nor this\nwell"),
        (None, 3, "user", "> How do I open it?"), (1, 4, "user", "> said later"), (1, 5, "user", "said later")]
    got = {r["turn"]: r for r in quotations.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1]["content"] == "Run this:\n>>> open('x')\n>>> 1\n\n> It is a large\n> file.\nyes"
    assert got[2]["content"] == "Carl wrote:\n> never said here\n>\n> nor this\nwell"
    assert got[3]["content"] == "> How do I open it?" and got[4]["content"] == "> said later"
    assert got[1]["parent_turn"] == 0 and got[2]["parent_turn"] is None


def test_rewrapped_passages_are_linked(spark):
    rows = [(1, 0, "user", "It is a large\nfile indeed."), (1, 1, "user", "> It is a\n> large file indeed.\nok")]
    got = {r["turn"]: r for r in quotations.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1]["content"] == "ok" and got[1]["parent_turn"] == 0
