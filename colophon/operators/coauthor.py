"""The weighted co-author graph and the rankings on it.

``author(person_id, publication_key)`` must have unique rows; edges are
``author1_id < author2_id, pair_count, pair_weight``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from colophon.operators.authors import authorship, top, with_publication_count
from colophon.operators.skew import checked_broadcast, in_tasks, prune_to
from colophon.session import Scratch

# Author lists longer than this are paired in blocks of this size.
BLOCK = 1_000
# So many authorships are paired by one task, unless they form more than four times as many pairs.
PAIRED_ROWS = 400_000
# So many pairs are added up to edges by one task, which holds the edges in its memory.
ADDED_PAIRS = 400_000


def _n_pairs(sized: DataFrame, list_size: str) -> tuple[int, int]:
    """How many authorships there are, and how many pairs they form."""
    found = sized.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(list_size) - 1).alias("others")).first()
    return found["rows"], (found["others"] or 0) // 2


def _pairing_tasks(rows: int, pairs: int) -> int:
    """The number of tasks follows the rows and pairs, as partitions of a size in bytes would be joined to few
    of which each forms too many pairs."""
    return max(rows, pairs // 4) // PAIRED_ROWS + 1


def _meet(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    first = left.withColumnRenamed("person_id", "author1_id")
    second = right.select(F.col("person_id").alias("author2_id"), *on)
    return first.join(second, on).where("author1_id < author2_id").select(
        "author1_id", "author2_id", "publication_key",
        (F.lit(1.0) / F.col("n_authors")).alias("publ_weight"))


def _paired(sized: DataFrame, tasks: int) -> DataFrame:
    """Pairs of each publication with a short list of authors. Long lists are on neither side."""
    sized = in_tasks(sized, tasks, "publication_key")
    return _meet(sized, sized, ["publication_key"])


def _paired_in_blocks(sized: DataFrame, list_size: str, block: int, tasks: int) -> DataFrame:
    """Pairs of publications with long author lists: each list is cut into blocks that meet the
    whole list, so that many tasks share one list."""
    cut = sized.withColumn("blocks", F.ceil(F.col(list_size) / F.lit(block)).cast("int"))
    part = cut.withColumn(
        "block", F.pmod(F.xxhash64("person_id"), F.col("blocks")).cast("int"))
    whole = cut.withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    on = ["publication_key", "block"]
    return _meet(in_tasks(part, tasks, *on), in_tasks(whole, tasks, *on), on)


def _sized(rows: DataFrame) -> DataFrame:
    """Authorships of publications with more than one author, with the number of authors."""
    return with_publication_count(rows).where("n_authors > 1")


def _held(sized: DataFrame) -> DataFrame:
    """Sized authorships as a written table, as they are counted, cut by size and paired from there."""
    return Scratch(sized.sparkSession, "authorships").table(sized, "sized")


def _pairs(short: DataFrame, long: DataFrame, list_size: str, block: int) -> tuple[DataFrame, int]:
    """Pairs of short and long lists of authors, and how many there are."""
    counts = _n_pairs(short, "n_authors"), _n_pairs(long, list_size)
    pairs = _paired(short, _pairing_tasks(*counts[0])).unionByName(
        _paired_in_blocks(long, list_size, block, _pairing_tasks(*counts[1])))
    return pairs, sum(n for _, n in counts)


def _all_pairs(sized: DataFrame, block: int) -> tuple[DataFrame, int]:
    return _pairs(sized.where(F.col("n_authors") <= block), sized.where(F.col("n_authors") > block), "n_authors", block)


def _edges(pairs: DataFrame, n_pairs: int, sized: DataFrame) -> DataFrame:
    """So many pairs of sized authorships added up, in tasks that follow the pairs. Only where any two authors have
    four pairs in common or more, that is left to the planner, whose tasks add up before the shuffle as well; else
    they would just hold about all pairs once more."""
    tasks = n_pairs // ADDED_PAIRS + 1
    if tasks > 1 and n_pairs >= 2 * sized.agg(F.approx_count_distinct("person_id")).first()[0] ** 2:
        tasks = 1
    ends = ["author1_id", "author2_id"]
    return in_tasks(pairs.select(*ends, "publ_weight"), tasks, *ends).groupBy(*ends).agg(
        F.count(F.lit(1)).alias("pair_count"),
        F.sum("publ_weight").alias("pair_weight"))


def coauthor_pairs(author: DataFrame, block: int = BLOCK) -> DataFrame:
    """``author1_id, author2_id, publication_key, publ_weight``: each pair of each publication.

    An equi-join on the publication with a residual ``<``; lists of more than ``block`` authors
    are paired by many tasks. Pairs are only formed where they are the result; rankings and
    components of all authors have forms without them.
    """
    return _all_pairs(_held(_sized(authorship(author))), block)[0]


def coauthor_graph(author: DataFrame, block: int = BLOCK) -> DataFrame:
    """Each undirected edge once, with the number of common publications and the sum of their
    weights."""
    sized = _held(_sized(authorship(author)))
    return _edges(*_all_pairs(sized, block), sized)


def edges_above(author: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """Co-author edges with ``pair_weight > threshold``.

    An edge weighs no more than the shared publications that either end has in total. Before a
    long author list is paired, it loses the authors whose total is not above the threshold;
    whoever only has long lists in common with others has a tiny total. The edges of the rest
    are complete.
    """
    sized = _held(_sized(authorship(author)))
    short = sized.where(F.col("n_authors") <= block)
    long = sized.where(F.col("n_authors") > block)
    total = sized.groupBy("person_id").agg(F.sum(F.lit(1.0) / F.col("n_authors")).alias("total"))
    # The slack covers rounding: sums of the same weights in another order.
    able = total.where(F.col("total") > F.lit(threshold) - 1e-6).select("person_id")
    kept = long.join(able, "person_id", "left_semi")
    # How many of a list remain; the weight goes on counting the whole list.
    kept = _held(with_publication_count(kept.withColumnRenamed("n_authors", "listed")).where(
        "n_authors > 1").withColumnsRenamed({"n_authors": "remaining", "listed": "n_authors"}))
    return _edges(*_pairs(short, kept, "remaining", block), sized).where(above(threshold))


def above(threshold: float, weight: str = "pair_weight") -> Column:
    """Strictly above; weights are compared without the noise of their summation order."""
    return F.round(weight, 9) > F.lit(threshold)


def weighted_degree(graph: DataFrame) -> DataFrame:
    """``author_id, author_count, author_weight`` summed over the edges at each author."""
    left = graph.select(F.col("author1_id").alias("author_id"), "pair_count", "pair_weight")
    right = graph.select(F.col("author2_id").alias("author_id"), "pair_count", "pair_weight")
    return left.unionAll(right).groupBy("author_id").agg(
        F.sum("pair_count").alias("author_count"),
        F.sum("pair_weight").alias("author_weight"))


def weighted_degree_of_authors(author: DataFrame) -> DataFrame:
    """The same degrees straight from the authorships, without forming any pair.

    In a publication with n authors each of them has n - 1 edges of weight 1/n.
    """
    others = F.col("n_authors") - 1
    return _sized(authorship(author)).groupBy(
        F.col("person_id").alias("author_id")
    ).agg(F.sum(others).alias("author_count"),
          F.sum(others / F.col("n_authors")).alias("author_weight"))


def top_authors(degrees: DataFrame, person: DataFrame, k: int | None = None) -> DataFrame:
    """Authors by weighted degree, then by count, both falling; the first ``k`` if given."""
    order = F.struct(F.round("author_weight", 9), F.col("author_count")).desc_nulls_first()
    if k is not None:
        # Only the persons among the k rows are looked up, during their scan while k is small.
        scratch = Scratch(degrees.sparkSession, "top")
        degrees = scratch.table(top(degrees, k, order, F.col("author_id")), "first")
        person = prune_to(person, degrees, "id", "author_id", rows=scratch.rows["first"])
    return (
        degrees.join(person, degrees["author_id"] == person["id"], "left")
        .orderBy(order, F.col("author_id"))
        .select("full_name", "author_count", "author_weight")
    )


def ranking_name_join(ranking: DataFrame, person: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` lowest rows of the ranking with every person of that name.

    Each ranked row gives at least one result row, so the first ``k`` results come from the
    ``k`` lowest ranked rows; only those meet the persons.
    """
    order = [F.col("author_count").asc_nulls_last(), F.col("author_weight").asc_nulls_last(),
             F.col("full_name").asc_nulls_last()]
    scratch = Scratch(ranking.sparkSession, "lowest")
    lowest = scratch.table(top(ranking, k, *order), "rows")
    named = person.select(F.col("id").alias("person_id"), "full_name").join(
        checked_broadcast(lowest, scratch.rows["rows"]), "full_name")
    unnamed = lowest.join(named.select("full_name"), "full_name", "left_anti")
    columns = [*lowest.columns, "person_id"]
    return top(
        named.select(*columns).unionByName(
            unnamed.withColumn("person_id", F.lit(None).cast("long")).select(*columns)),
        k, *order, F.col("person_id"))


def top_pairs(graph: DataFrame, person: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` heaviest edges with names, which are joined after the limit."""
    scratch = Scratch(graph.sparkSession, "pairs")
    heaviest = scratch.table(top(
        graph.withColumn("coauthor_weight", F.round("pair_weight", 9)), k,
        F.col("coauthor_weight").desc_nulls_first(), F.col("author1_id"), F.col("author2_id"),
    ).select("author1_id", "author2_id", "coauthor_weight"), "heaviest")
    for side in ("1", "2"):
        names = person.select(F.col("id").alias(f"author{side}_id"),
                              F.col("full_name").alias(f"name{side}"))
        heaviest = prune_to(names, heaviest, f"author{side}_id", f"author{side}_id", rows=scratch.rows["heaviest"]).join(
            heaviest, f"author{side}_id")
    return heaviest.select("author1_id", "author2_id", "name1", "name2", "coauthor_weight")


def edge_other_end(graph: DataFrame, person_id: int) -> DataFrame:
    """Neighbours of one author with the edges' weights."""
    here = F.lit(person_id)
    return graph.where((F.col("author1_id") == here) | (F.col("author2_id") == here)).select(
        F.when(F.col("author1_id") == here, F.col("author2_id"))
        .otherwise(F.col("author1_id")).alias("other_id"),
        "pair_count", "pair_weight")


EDGE_COLUMNS = ["author1_id", "author2_id", "pair_count", "pair_weight"]


def missing_edges(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The new edges that are not there in this form: the same ends and count, and the same weight at 9
    decimals, as the order of a distributed sum is not fixed."""
    def keyed(edges):
        return edges.select(*EDGE_COLUMNS).withColumn("_weight", F.round("pair_weight", 9))

    return keyed(new).join(
        keyed(existing), ["author1_id", "author2_id", "pair_count", "_weight"], "left_anti").select(*EDGE_COLUMNS)


def merge_edges(existing: DataFrame, new: DataFrame) -> DataFrame:
    """All existing edges and the new ones that are missing. ``edge_store`` adds these to written edges."""
    return existing.select(*EDGE_COLUMNS).unionByName(missing_edges(existing, new))
