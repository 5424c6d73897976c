"""Quotations in conversations: who quotes whom, and the messages in reply order without quotes.

Lines that begin with ``>`` are quoted, as deep as there are such marks. Runs of quoted lines of one
level that no blank line interrupts are passages; they and their lines are normalised and hashed. The
same is done with what messages say themselves. A quoted hash belongs to the first message of the
conversation that says it, so hashes that many messages say make no pairs. Of the earlier messages
that a message quotes, the one quoted at the outermost level and with most characters is its
parent, the latest one if these are equal.

A thread's reply order is depth-first: every reply stands behind the message it answers, before that
message's next reply. Its places come from the thread's tour, which enters and leaves every message,
by doubling the steps taken, so neither long nor broad threads pass through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from colophon.llm.columns import bound, gathered, narrow
from colophon.operators.ordering import dense_ids
from colophon.session import Scratch

MARKS = "^(?:[ \\t]*>)+"
QUOTED = "(?m)^[ \\t]*>"
INTRODUCTION = "(?i)^.{0,200}\\bwrote:[ \\t]*$"
HASHES = "array<bigint>"


def lines_of(text: Column) -> Column:
    """``(level, text)`` of every line."""
    def line(x):
        marks = F.regexp_extract(x, f"({MARKS})", 1)
        level = F.length(marks) - F.length(F.translate(marks, ">", ""))
        return F.struct(level.alias("level"), F.trim(F.regexp_replace(x, MARKS, "")).alias("text"))

    return F.transform(F.split(text, "\r?\n"), line)


def passages(lines: Column) -> Column:
    """Runs of lines of one level, and how many lines they have; blank lines end a run."""
    def runs(lines):
        def other(x, i):
            """Whether a run does not go on from line ``i`` to ``x`` or back."""
            near = F.get(lines, i)
            return near.isNull() | (near["level"] != x["level"]) | (near["text"] == "")

        marked = F.transform(lines, lambda x, i: F.struct(
            i.alias("at"), ((x["text"] != "") & other(x, i - 1)).alias("first"),
            ((x["text"] != "") & other(x, i + 1)).alias("last")))
        ends = bound(marked, lambda all_lines: F.arrays_zip(
            F.transform(F.filter(all_lines, lambda x: x["first"]), lambda x: x["at"]).alias("first"),
            F.transform(F.filter(all_lines, lambda x: x["last"]), lambda x: x["at"]).alias("last")))
        return F.transform(ends, lambda x: bound(F.slice(lines, x["first"] + 1, x["last"] - x["first"] + 1), lambda run: F.struct(
            F.get(run, F.lit(0))["level"].alias("level"),
            F.array_join(F.transform(run, lambda line: line["text"]), " ").alias("text"), F.size(run).alias("lines"))))

    return bound(lines, runs)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "\\s+", " "))


def _hash(text: Column) -> Column:
    return F.xxhash64(normalised(text))


def without_quotes(lines: Column, blocks: Column, found: Column) -> Column:
    """The lines without the quoted ones whose original was ``found``, by the hash of the line or
    of its passage, and without those that only introduce such a quotation. Quoted lines of other
    origin stay, with their marks; blank quoted lines stay behind such a line."""
    # Lines with text are, in order, those of the passages.
    of_passage = F.flatten(F.transform(blocks, lambda p: F.array_repeat(
        F.array_contains(found, _hash(p["text"])), p["lines"])))
    zero = F.struct(F.lit(0).alias("at"), F.lit(False).alias("stays"))

    def marked_by(of_passage):
        def step(a, x):
            blank = x["text"] == ""
            known = F.get(of_passage, a["at"]) | F.array_contains(found, _hash(x["text"]))
            stays = F.when(x["level"] == 0, F.lit(True)).when(blank, a["stays"]).otherwise(~known)
            state = F.struct((a["at"] + F.when(blank, 0).otherwise(1)).alias("at"), ((x["level"] > 0) & stays).alias("stays"))
            return state, F.array(F.struct(x["level"].alias("level"), x["text"].alias("text"), stays.alias("stays")))

        return gathered(lines, zero, step, "array<struct<level:int,text:string,stays:boolean>>")

    def shown(marked):
        own = F.filter(F.transform(marked, lambda x, i: F.struct(
            x["level"].alias("level"), x["text"].alias("text"), x["stays"].alias("stays"),
            F.coalesce(~F.get(marked, i + 1)["stays"], F.lit(False)).alias("quotes"))), lambda x: x["stays"] & ~(
                (x["level"] == 0) & x["quotes"] & x["text"].rlike(INTRODUCTION)))
        return F.trim(F.array_join(F.transform(own, lambda x: F.when(x["level"] > 0, F.rtrim(F.concat(
            F.repeat(F.lit(">"), x["level"]), F.lit(" "), x["text"]))).otherwise(x["text"])), "\n"), F.lit("\n "))

    # Texts without a quoted line need no marks; the marked lines are bound, so that they are made once.
    quoted = F.exists(lines, lambda x: x["level"] > 0)
    return F.when(quoted, bound(bound(of_passage, marked_by), shown)).otherwise(
        F.trim(F.array_join(F.transform(lines, lambda x: x["text"]), "\n"), F.lit("\n ")))


def _hashed(messages: DataFrame, quoted: bool) -> DataFrame:
    """A row per hash that a message says or quotes; ``weight`` is the length of what was hashed."""
    wanted = F.concat("passages", F.transform(F.filter("lines", lambda x: x["text"] != ""), lambda x: F.struct(
        x["level"].alias("level"), x["text"].alias("text"), F.lit(1).alias("lines"))))
    kept = F.filter(wanted, lambda x: x["level"] > 0 if quoted else x["level"] == 0)
    return messages.select("conv_id", "turn", F.explode(F.array_distinct(F.transform(kept, lambda x: F.struct(
        x["level"].alias("level"), _hash(x["text"]).alias("hash"),
        F.length(x["text"]).alias("weight"))))).alias("x")).select("conv_id", "turn", "x.*")


def parents(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, parent_turn, quote_level`` of the messages that quote an earlier one, and the
    hashes ``found`` of what they quote."""
    placed = messages.filter("conv_id is not null and turn is not null")
    said = _hashed(placed, quoted=False).groupBy("conv_id", "hash").agg(F.min("turn").alias("parent_turn"))
    links = _hashed(placed.filter("quotes"), quoted=True).join(said, ["conv_id", "hash"]).filter("parent_turn < turn")
    voted = links.groupBy("conv_id", "turn", "parent_turn").agg(
        F.min("level").alias("quote_level"), F.sum("weight").alias("weight"), F.collect_set("hash").alias("hashes"))
    best = F.max_by(F.struct("parent_turn", "quote_level"), F.struct(-F.col("quote_level"), "weight", "parent_turn"))
    return voted.groupBy("conv_id", "turn").agg(
        best.alias("best"), F.flatten(F.collect_list("hashes")).alias("found")).select("conv_id", "turn", "best.*", "found")


def _roots(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, turn, root_turn, depth`` of every linked message, by doubling the steps taken."""
    state = scratch.table(links.select(
        "conv_id", "turn", F.col("parent_turn").alias("root_turn"), F.lit(1).alias("depth")), "round0")
    rounds = 0
    while scratch.rows[f"round{rounds}"]:
        up = state.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("next_turn"),
                          F.col("depth").alias("more"))
        moved = state.join(up, ["conv_id", "root_turn"], "left")
        if moved.filter("next_turn is not null").isEmpty():
            break
        rounds += 1
        state = scratch.table(moved.select(
            "conv_id", "turn", F.coalesce("next_turn", "root_turn").alias("root_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), f"round{rounds}")
    return state


def _places(links: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, turn, reply_place`` of every linked message: its number in its thread, depth-first and
    earlier replies first. The first message of a thread, which has 0, is not among them.

    The tour enters a message, then tours its replies, then leaves it. The steps behind an event are
    counted by doubling; a message's number is how many messages the tour has entered before it.
    """
    placed = scratch.table(dense_ids(links.select("conv_id", "parent_turn", "turn"), ["conv_id", "parent_turn", "turn"], "p"), "placed")
    following = placed.select("conv_id", "parent_turn", (F.col("p") - 1).alias("p"), F.col("turn").alias("next_turn"))
    siblings = placed.join(following, ["conv_id", "parent_turn", "p"], "left")
    first = placed.groupBy("conv_id", F.col("parent_turn").alias("turn")).agg(F.min("turn").alias("first_turn"))
    # Entering and leaving a message as (turn, 0) and (turn, 1).
    def event(turn, side):
        return F.when(turn.isNotNull(), F.struct(turn.alias("turn"), F.lit(side).alias("side")))

    members = siblings.join(first, ["conv_id", "turn"], "full")
    tour = scratch.table(members.select("conv_id", F.explode(F.array(
        F.struct(event(F.col("turn"), 0).alias("event"), F.coalesce(
            event(F.col("first_turn"), 0), event(F.col("turn"), 1)).alias("next"), F.lit(1).cast("long").alias("n")),
        F.struct(event(F.col("turn"), 1).alias("event"), F.coalesce(
            event(F.col("next_turn"), 0), event(F.col("parent_turn"), 1)).alias("next"),
            F.lit(0).cast("long").alias("n")))).alias("x")).select("conv_id", "x.*"), "tour0")
    rounds = 0
    while True:
        ahead = tour.select("conv_id", F.col("event").alias("next"), F.col("next").alias("after"), F.col("n").alias("more"))
        moved = tour.join(ahead, ["conv_id", "next"], "left").select(
            "conv_id", "event", F.col("after").alias("next"), (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"))
        rounds += 1
        tour = scratch.table(moved, f"tour{rounds}")
        if tour.filter("next is not null").isEmpty():
            break
    entered = tour.filter("event.side = 0").select("conv_id", F.col("event.turn").alias("turn"), "n")
    whole = entered.select("conv_id", F.col("turn").alias("root_turn"), F.col("n").alias("all"))
    # A first message with many replies is one row here, and its replies a share of the table: broadcast
    # by Spark's own choice, or split as a skewed join.
    return roots.join(entered, ["conv_id", "turn"]).join(whole, ["conv_id", "root_turn"]).select(
        "conv_id", "turn", "root_turn", "depth", (F.col("all") - F.col("n")).alias("reply_place"))


def reply_ordered(linked: DataFrame) -> DataFrame:
    """``conv_id, text``: what a conversation's messages say, in reply order, from ``link_quotations``.

    A conversation is one value and so has to fit into one row; messages without one are left out.
    """
    keys = ["root_turn", "reply_place", "turn", "role", "content"]
    said = F.array_sort(F.collect_list(F.struct(*keys)))
    return linked.filter("conv_id is not null").groupBy("conv_id").agg(F.array_join(F.transform(
        F.filter(said, lambda m: m["content"] != ""), lambda m: m["content"]), "\n\n").alias("text"))


def link_quotations(conversations: DataFrame) -> DataFrame:
    """Every message of ``conv_id, turn, role, text`` with its place in the reply order.

    ``content`` is the text without what it quotes of earlier messages; quoted text from elsewhere stays.
    ``n_quoted`` counts quoted lines; ``parent_turn`` is the message it quotes, null for none;
    ``root_turn`` and ``depth`` lead to the start of its thread, ``reply_place`` is its depth-first number
    in it. A conversation in reply order is its messages by ``root_turn, reply_place``: every reply
    follows what it answers. It is a sort key, so that no conversation, however long, has to pass
    through one task; ``reply_ordered`` puts the texts together.

    A null text is empty. Messages without a conversation or turn quote nothing and start their own
    thread. Messages that repeat a turn share its parent. Empty tables stay empty; extra columns
    are ignored.
    """
    lines = lines_of(F.coalesce(F.col("text"), F.lit("")))
    messages = narrow(conversations, "conv_id", "turn", "role", "text").select(
        "conv_id", "turn", "role", lines.alias("lines"),
        F.coalesce(F.col("text").rlike(QUOTED), F.lit(False)).alias("quotes")).withColumn(
        "passages", passages(F.col("lines")))
    scratch = Scratch(conversations.sparkSession, "quotations")
    links = scratch.table(parents(messages), "links")
    roots = _roots(links, scratch)
    placed = roots.withColumn("reply_place", F.lit(0).cast("long"))
    if scratch.rows["links"]:
        placed = _places(links, roots, scratch)
    linked = links.join(placed, ["conv_id", "turn"])
    return messages.join(linked, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", without_quotes(
            F.col("lines"), F.col("passages"), F.coalesce("found", F.array().cast(HASHES))).alias("content"),
        F.size(F.filter("lines", lambda x: x["level"] > 0)).cast("long").alias("n_quoted"),
        "parent_turn", F.coalesce("quote_level", F.lit(0)).cast("long").alias("quote_level"),
        F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.coalesce("reply_place", F.lit(0)).cast("long").alias("reply_place"))
