"""Mixing sources to target weights through a multivariate-hypergeometric splitting tree.

A document is cut into blocks of ``BLOCK`` words, a shorter one is a block. The blocks of a source are
permuted by a hash, and the mix takes its quota of them from the front: whole passes over the source
while the target is larger than the source, then the front up to the target, whose last block is cut.

Which shard gets how many blocks of each source is decided by a tree: the quotas of all sources are
split between the left and the right half of the shards as if their blocks were drawn without
replacement, and both halves are split in turn. Quotas stay exact, shards are equally large, and a
shard holds the sources in about the proportions of the mix. The counts of a source, one after
the other, are disjoint ranges of its permutation, so every block finds its shard by its rank alone, and
what a shard has drawn is shuffled inside the shard.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from colophon.llm.columns import narrow, whole, words_of
from colophon.session import Scratch

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK = 1024
SHARDS = 64
SEED = 13
# The blocks of a source are ranked in groups of about so many, by leading digits of their hash.
RANKED, MOST_DIGITS = 1000, 4
# Beyond so many blocks a split is drawn from the normal law, which the exact one is then next to.
DRAWN = 10**9


def targets(sizes: list[int], weights: list[int], most: int = MOST) -> list[float]:
    """Shares of all sizes by weight, none above ``most`` times its size; what a source cannot take
    is shared by the others by weight, until none is above."""
    left, weight = sum(sizes), sum(weights)
    capped: dict[int, int] = {}
    while True:
        over = [i for i, (n, w) in enumerate(zip(sizes, weights))
                if i not in capped and w * left > most * n * weight]
        if not over:
            break
        for i in over:
            capped[i] = most * sizes[i]
        left = sum(sizes) - sum(capped.values())
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
    return [float(capped[i]) if i in capped else w * left / weight for i, w in enumerate(weights)]


def _drawn(quota: int, others: int, draws: int, rng: np.random.Generator) -> int:
    """How many of ``draws`` blocks, drawn without replacement, come from the first kind."""
    total = quota + others
    if total < DRAWN:
        return int(rng.hypergeometric(quota, others, draws)) if total else 0
    share = quota / total
    spread = math.sqrt(draws * share * (1 - share) * (total - draws) / (total - 1))
    drawn = round(draws * share + spread * rng.standard_normal())
    return min(max(drawn, draws - others, 0), quota, draws)


def splitting_tree(quotas: list[int], shards: int, rng: np.random.Generator) -> list[list[int]]:
    """For every shard, how many blocks it has of each source. Sums over shards are the quotas;
    shards differ by one block at most."""
    if shards == 1:
        return [list(quotas)]
    half, others = shards // 2, sum(quotas)
    draws = others * half // shards
    left = []
    for quota in quotas:
        others -= quota
        left.append(_drawn(quota, others, draws, rng))
        draws -= left[-1]
    right = [quota - own for quota, own in zip(quotas, left)]
    return splitting_tree(left, half, rng) + splitting_tree(right, shards - half, rng)


def _literal(rows: list[dict], schema: str) -> Column:
    """A short table as a column to explode, so that no Python data source is in the plan."""
    return F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>"))


def staged(docs: DataFrame, scratch: Scratch, with_text: bool = False) -> DataFrame:
    """``row, doc_id, source, size`` of every row, and its text if wanted, written once."""
    docs = narrow(docs, "doc_id", "text", "source")
    sized = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("source").cast("string").alias("source"),
        F.size(words_of(whole())).cast("long").alias("size"), *["text"] * with_text)
    return scratch.table(sized, "staged")


def sources_of(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> list[dict]:
    """One entry per source in code point order, null last: its size, weight, target and number."""
    found = rows.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found = sorted(((r["source"], r["size"]) for r in found), key=lambda x: (x[0] is None, x[0] or ""))
    shares = [weights[i % len(weights)] for i in range(len(found))]
    goals = targets([size for _, size in found], shares)
    return [{"source": name, "source_size": size, "target": goal, "number": i}
            for i, ((name, size), goal) in enumerate(zip(found, goals))]


def with_sources(rows: DataFrame, sources: list[dict], extra: str = "") -> DataFrame:
    """``rows`` with the entries of their sources."""
    schema = "source: string, source_size: bigint, target: double, number: int" + extra
    if not sources:
        sources = [{"source": None}]
    table = rows.sparkSession.range(1).select(_literal(sources, schema).alias("s")).select("s.*")
    table = table.withColumnRenamed("source", "__source")
    return rows.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")


def _permuted(rows: DataFrame, sources: list[dict], scratch: Scratch, seed: int) -> DataFrame:
    """All blocks with their rank in the permutation of their source and the words before them."""
    cut = with_sources(rows.drop("text").filter("size > 0"), sources).select(
        "row", "doc_id", "number", "size",
        F.explode(F.sequence(F.lit(0), ((F.col("size") - 1) / BLOCK).cast("int"))).alias("block"))
    words = F.least(F.lit(BLOCK), F.col("size") - F.col("block") * BLOCK).cast("long")
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "block", F.lit(seed))
    blocks = scratch.table(cut.select("row", "doc_id", "number", "block", words.alias("words"),
                                      F.md5(name).alias("hash")), "blocks")
    digits = min(MOST_DIGITS, max(0, math.ceil(math.log(max(scratch.rows["blocks"], 1) / RANKED, 16))))
    blocks = blocks.withColumn("part", F.substring("hash", 1, digits) if digits else F.lit(""))
    before = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.groupBy("number", "part").agg(F.sum("words").alias("w"), F.count(F.lit(1)).alias("n")).select(
        "number", "part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in "wn"))
    inside = Window.partitionBy("number", "part").orderBy("hash", "words", "row")
    ranked = blocks.select("*", F.row_number().over(inside).alias("place"), F.sum("words").over(
        inside.rowsBetween(Window.unboundedPreceding, 0)).alias("running"))
    return scratch.table(ranked.join(sums, ["number", "part"]).select(
        "row", "doc_id", "number", "block", "words", (F.col("n_before") + F.col("place") - 1).alias("rank"),
        (F.col("w_before") + F.col("running") - F.col("words")).alias("words_before")), "permuted")


def placements(rows: DataFrame, sources: list[dict], scratch: Scratch, shards: int = SHARDS,
               seed: int = SEED) -> DataFrame:
    """Every block that the mix takes, as often as it does, laid out shard by shard: ``shard``, its
    place there by ``order_key``, ``row`` and ``doc_id`` of its document, its first word and length."""
    ranked = _permuted(rows, sources, scratch, seed)
    goals = []
    for s in sources:
        goal = math.floor(s["target"] + 0.5)
        whole_passes, rest = divmod(goal, s["source_size"]) if s["source_size"] else (0, 0)
        goals.append({"number": s["number"], "passes": whole_passes, "rest": rest})
    goal_table = ranked.sparkSession.range(1).select(_literal(
        goals or [{}], "number: int, passes: bigint, rest: bigint").alias("g")).select("g.*")
    marked = ranked.join(F.broadcast(goal_table), "number")
    fronts = {r["number"]: (r["n"], r["front"]) for r in marked.groupBy("number").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("words_before") < F.col("rest")).alias("front")).collect()}
    quotas = [g["passes"] * fronts[g["number"]][0] + fronts[g["number"]][1] if g["number"] in fronts else 0
              for g in goals]
    counts = splitting_tree(quotas, shards, np.random.default_rng(seed)) if quotas else []
    ends = np.cumsum(np.array(counts, np.int64).reshape(len(counts), len(goals)), axis=0)
    for i, g in enumerate(goals):
        g |= {"blocks": fronts.get(g["number"], (0, 0))[0], "ends": ends[:, i].tolist()}
    full = ranked.sparkSession.range(1).select(_literal(
        goals or [{}], "number: int, passes: bigint, rest: bigint, blocks: bigint, ends: array<bigint>").alias("g"))
    times = F.col("passes") + (F.col("words_before") < F.col("rest")).cast("long")
    taken = ranked.join(F.broadcast(full.select("g.*")), "number").filter(times > 0).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)).alias("copy"))
    position = F.col("copy") * F.col("blocks") + F.col("rank")
    last = F.least(F.col("words"), F.col("rest") - F.col("words_before"))
    drawn = taken.select(
        F.size(F.filter("ends", lambda end: end <= position)).alias("shard"),
        F.xxhash64("row", "block", "copy", F.lit(seed)).alias("order_key"), "row", "doc_id", "block", "copy",
        (F.col("block").cast("long") * BLOCK).alias("first_word"),
        F.when(F.col("copy") < F.col("passes"), F.col("words")).otherwise(last).alias("length"))
    return drawn.repartition("shard").sortWithinPartitions("shard", "order_key", "row", "block", "copy")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mixed corpus: ``shard, order_key, doc_id, copy, first_word, length, text`` of every block taken.

    Rows of a shard stand together, in the order of ``order_key``. A document that is one whole block keeps its
    text as it is; other blocks are their words joined by spaces. A null text is empty, and texts
    without words are never taken. Rows without a source are a source of their own, the last.
    Repeated rows are documents of their own, extra columns are ignored, an empty table gives an
    empty mix. One entry per source and shard is planned on the driver, as weights are given per source.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = staged(docs, scratch, with_text=True)
    taken = placements(rows, sources_of(rows, weights), scratch, shards, seed).drop("doc_id")
    part = F.array_join(F.slice(words_of(F.col("text")), (F.col("first_word") + 1).cast("int"),
                                F.col("length").cast("int")), " ")
    texts = taken.join(rows.select("row", "doc_id", "text", "size"), "row").select(
        "shard", "order_key", "row", "doc_id", "copy", "first_word", "length",
        F.when(F.col("length") == F.col("size"), F.col("text")).otherwise(part).alias("text"))
    return texts.repartition("shard").sortWithinPartitions("shard", "order_key", "row", "first_word", "copy").drop("row")


def words_taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, shards: int = SHARDS,
                seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row: what the mix takes of it.

    Cases as in ``mix``; without any words every target is 0.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = staged(docs, scratch)
    sources = sources_of(rows, weights)
    mixed = scratch.table(placements(rows, sources, scratch, shards, seed), "mixed")
    taken = mixed.groupBy("row").agg(F.sum("length").alias("taken"))
    return with_sources(rows, sources).join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
