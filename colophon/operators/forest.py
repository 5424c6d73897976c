"""Maximum spanning forests: the few edges of a weighted graph that answer every threshold.

Two vertices are connected by edges above a threshold if and only if they are by such edges of a maximum
spanning forest, which has fewer edges than the graph has vertices. It is found in rounds (Boruvka, 1926):
every vertex picks its heaviest edge, which any maximum spanning forest has if no two edges are equal in
order; what is connected by picked edges becomes one vertex; of the edges between the new vertices the
heaviest of each pair stays. Each round at least halves the number of vertices.

A graph with many edges per vertex is not carried through the rounds (Osipov, Sanders and Singler, "The
filter-Kruskal minimum spanning tree algorithm", 2009): the forest of its heaviest edges comes first, and of the
others only those take part afterwards whose ends it has not connected. Those are all that may still be picked,
so the forest is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from colophon.operators.components import followed
from colophon.operators import skew
from colophon.operators.skew import lookup_join
from colophon.session import Scratch

MAX_ROUNDS = 64
# The heaviest edges come first in graphs of more than twice so many edges a vertex, and are so many or more.
FIRST_EDGES = 4
# Shares of lighter edges at which the heaviest ones may be cut off.
CUTS = [0.5, 0.75, 0.9, 0.95, 0.98, 0.99, 0.998]
# Of two edges of the same weight that with the larger ends comes first, so that the order is total.
_EDGE = ["w", "a", "b"]


def _heaviest(edges: DataFrame) -> DataFrame:
    """``u < v, w, a, b``: of the edges between two vertices the first in order."""
    ends = [F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")]
    return edges.where(F.col("u") != F.col("v")).groupBy(*ends).agg(
        F.max(F.struct(*_EDGE)).alias("best")).select("u", "v", "best.*")


def _picks(graph: DataFrame) -> DataFrame:
    """``id, to, w, a, b``: the heaviest edge of every vertex, and its other end. Edges are reduced to one
    per vertex before they are shuffled, so a hub is no single task's work."""
    both = graph.select(F.inline(F.array(
        F.struct("u", "v", *_EDGE), F.struct(F.col("v").alias("u"), F.col("u").alias("v"), *_EDGE))))
    return both.groupBy(F.col("u").alias("id")).agg(
        F.max(F.struct(*_EDGE, F.col("v").alias("to"))).alias("best")).select("id", "best.*")


def _roots(picks: DataFrame, rows: int, scratch: Scratch, name: str) -> DataFrame:
    """``id, rep``: the vertex that what picked edges connect is contracted to.

    Picks point towards heavier edges, so they end in two vertices that picked the same edge; the smaller
    one of them is the root. Pointers are followed in steps that double what they skip.
    """
    back = picks.select(F.col("id").alias("to"), F.col("to").alias("_back"))
    root = (F.col("_back") == F.col("id")) & (F.col("id") < F.col("to"))
    pointers = scratch.table(lookup_join(picks.select("id", "to"), back, "to", lookup_rows=rows).select(
        "id", F.when(root, F.col("id")).otherwise(F.col("to")).alias("rep")), f"{name}-0")
    step, moved = 0, 1
    while moved:
        pointers = followed(pointers, rows)
        onward = pointers.select(F.col("id").alias("rep"), F.col("rep").alias("_onward"))
        seen = Observation()
        further = lookup_join(pointers, onward, "rep", lookup_rows=rows).observe(
            seen, F.count_if(F.col("_onward") != F.col("rep")).alias("moved"))
        step += 1
        pointers = scratch.table(further.select("id", F.col("_onward").alias("rep")), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        moved = seen.get["moved"]
    return pointers


def _onward(labels: DataFrame | None, reps: DataFrame, rows: int, known: int, scratch: Scratch, name: str):
    """``id, rep`` of all vertices so far and their number, after one more round. A later round has only vertices
    that the first has, and those that are done are no longer in it."""
    if labels is None:
        return reps, rows
    to = reps.select(F.col("id").alias("rep"), F.col("rep").alias("_to"))
    return scratch.table(lookup_join(labels, to, "rep", lookup_rows=rows).select(
        "id", F.coalesce("_to", "rep").alias("rep")), name), known


def _first_weight(edges: DataFrame):
    """The weight from which on edges come first; nothing if all may. Quantiles and the number of vertices are
    approximate, which has no influence on the forest."""
    seen = edges.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("u").alias("nu"),
                     F.approx_count_distinct("v").alias("nv"), F.min("w").alias("least"),
                     F.percentile_approx("w", CUTS, 1_000).alias("cuts")).first()
    first = FIRST_EDGES * max(seen["nu"], seen["nv"])
    if seen["n"] <= 2 * first:
        return None
    able = [w for share, w in zip(CUTS, seen["cuts"]) if seen["n"] * (1 - share) >= first and w > seen["least"]]
    return able[-1] if able else None


def _contracted(graph: DataFrame, reps: DataFrame, rows: int, scratch: Scratch, name: str) -> DataFrame:
    """``u, v, w, a, b`` with the vertices ``u, v`` that the ends became; a vertex without one stays."""
    for end in ("u", "v"):
        new = reps.select(F.col("id").alias(end), F.col("rep").alias("_rep"))
        graph = lookup_join(graph, new, end, lookup_rows=rows).withColumn(end, F.coalesce("_rep", end)).drop("_rep")
        if end == "u" and rows > skew.BROADCAST_ROWS:
            graph = scratch.table(graph, f"{name}-u")  # the second lookup reads it more than once
    return graph.where("u <> v")


def spanning_forest(edges: DataFrame, weight: str = "pair_weight", src: str = "author1_id",
                    dst: str = "author2_id") -> DataFrame:
    """A maximum spanning forest with the columns ``src, dst, weight`` of the graph.

    Edges have no direction, and come back with the smaller end first. Weights are compared, and returned, at
    9 decimals, as thresholds are. Loops and edges without a weight or an end are left out; of repeated edges the
    heaviest counts. ``components_above`` gives the same result for the forest as for the graph. ``edges`` should
    be a written table, as a big one is read more than once.
    """
    scratch = Scratch(edges.sparkSession, "forest")
    usable = edges.where(F.col(weight).isNotNull() & F.col(src).isNotNull() & F.col(dst).isNotNull())
    whole = usable.select(
        F.col(src).alias("u"), F.col(dst).alias("v"), F.round(weight, 9).alias("w"),
        F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b")).where("u <> v")
    cut = _first_weight(whole)
    later = None if cut is None else whole.where(F.col("w") < F.lit(cut))
    graph = scratch.table(_heaviest(whole if cut is None else whole.where(F.col("w") >= F.lit(cut))), "edges0")
    labels, known = None, 0
    for round_no in range(MAX_ROUNDS):
        name = f"picks/round={round_no}"
        picks = scratch.table(_picks(graph), name)
        rows = scratch.rows[name]
        if rows == 0 and later is None:
            break
        if rows == 0:
            # The heaviest edges are done: the others take part with the vertices that those left.
            graph, later = _contracted(later, labels, known, scratch, "later"), None
        else:
            reps = _roots(picks, rows, scratch, f"reps{round_no}")
            graph = _contracted(graph, reps, rows, scratch, f"edges{round_no}")
            if later is not None:
                labels, known = _onward(labels, reps, rows, known, scratch, f"labels{round_no}")
        graph = scratch.table(_heaviest(graph), f"edges{round_no + 1}")
        scratch.drop(f"edges{round_no}")
        scratch.drop(f"edges{round_no}-u")
    else:
        raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")
    picked = edges.sparkSession.read.schema(picks.schema).parquet(f"{scratch.path}/picks")
    # Both ends of an edge may have picked it.
    return scratch.table(picked.select(
        F.col("a").alias(src), F.col("b").alias(dst), F.col("w").alias(weight)).distinct(), "forest")


def forest_edges_above(forest: DataFrame, thresholds, weight: str = "pair_weight") -> DataFrame:
    """``threshold, n_edges``: by so many the parts above a threshold are fewer than the vertices."""
    steps = F.array(*[F.lit(float(t)) for t in thresholds])
    every = forest.sparkSession.range(1).select(F.explode(steps).alias("threshold"))
    counts = forest.select(F.explode(F.filter(steps, lambda t: F.round(weight, 9) > t)).alias("threshold")).groupBy(
        "threshold").agg(F.count(F.lit(1)).alias("n"))
    return every.join(counts, "threshold", "left").select("threshold", F.coalesce("n", F.lit(0)).alias("n_edges"))
