"""Connected components of graphs of any size and shape.

The labels come from repeated contraction with random choices (Boegeholz, Brand and Todor,
"In-database connected component analysis", 2020): every vertex picks the neighbour, or itself,
that is first in a random order; all vertices with one choice become one vertex; the remaining
edges form the next, smaller graph. The expected number of vertices shrinks by a constant factor
whatever the graph looks like, so a long chain takes no more rounds than a bushy tree, and total
work stays a small multiple of the first round.

All joins of a round look up one row per vertex, and a hub or a giant component may hold most
rows of the other side: see ``lookup_join``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from colophon.operators import skew
from colophon.operators.skew import lookup_join, prune_to
from colophon.session import Scratch

MAX_ROUNDS = 200
# Folders of a graph's links that a walk chooses from.
BUCKETS = 32


def undirected(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """``u < v``: each edge once, without self-loops."""
    return edges.where(F.col(src) != F.col(dst)).select(
        F.least(src, dst).alias("u"), F.greatest(src, dst).alias("v")).distinct()


def mirrored(edges: DataFrame) -> DataFrame:
    """Edges ``u, v`` in both directions, from one scan."""
    there = F.struct(F.col("u"), F.col("v"))
    back = F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    return edges.select(F.inline(F.array(there, back)))


def _with_degrees(edges: DataFrame, scratch: Scratch, round_no: int) -> DataFrame:
    """``u, v, du, dv``: edges with minus the number of edges at either end."""
    name = f"degrees{round_no}"
    degrees = scratch.table(mirrored(edges).groupBy("u").agg((-F.count(F.lit(1))).alias("d")), name)
    rows = scratch.rows[name]
    with_u = lookup_join(edges, degrees.select("u", F.col("d").alias("du")), "u", lookup_rows=rows)
    return lookup_join(with_u, degrees.select(F.col("u").alias("v"), F.col("d").alias("dv")), "v", lookup_rows=rows)


def _choices(edges: DataFrame, scratch: Scratch, round_no: int) -> DataFrame:
    """``id, rep``: the first of each vertex and its neighbours in this round's order.

    Every third round uses a random order, which bounds the number of rounds for any graph.
    The others prefer vertices with many edges, so that stars and hubs collapse at once.
    """
    if round_no % 3 == 2:
        edges = edges.withColumns({"du": F.lit(0), "dv": F.lit(0)})
    else:
        edges = _with_degrees(edges, scratch, round_no)
    both = edges.select(F.inline(F.array(
        F.struct("u", "v", "du", "dv"),
        F.struct(F.col("v").alias("u"), F.col("u").alias("v"), F.col("dv").alias("du"),
                 F.col("du").alias("dv")))))

    def rank(vertex: str, degree: str):
        return F.struct(F.col(degree).alias("d"),
                        F.xxhash64(F.col(vertex), F.lit(round_no)).alias("h"),
                        F.col(vertex).alias("id"))

    best = F.least(F.min(rank("v", "dv")), F.min(rank("u", "du")))
    return both.groupBy(F.col("u").alias("id")).agg(best.alias("best")).select(
        "id", F.col("best.id").alias("rep"))


def followed(choice: DataFrame, rows: int) -> DataFrame:
    """A small table of choices with the choice of the choice, twice: up to four steps at once.

    Any vertex of the component may stand for the others, so this only saves rounds.
    """
    if rows > skew.BROADCAST_ROWS:
        return choice
    for _ in range(2):
        onward = choice.select(F.col("id").alias("rep"), F.col("rep").alias("_onward"))
        choice = choice.join(F.broadcast(onward), "rep").select(
            "id", F.col("_onward").alias("rep"))
    return choice


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``id, component`` for every vertex that has an edge; the label is the smallest id of the
    component. Edge direction and repetition do not matter."""
    scratch = Scratch(edges.sparkSession, "components")
    graph = scratch.table(undirected(edges, src, dst), "edges0")
    picked = []
    for round_no in range(MAX_ROUNDS):
        if scratch.rows[f"edges{round_no}"] == 0:
            break
        name = f"choice{round_no}"
        choice = scratch.table(_choices(graph, scratch, round_no), name)
        choice = followed(choice, scratch.rows[name])
        picked.append(choice)
        for end in ("u", "v"):
            new = choice.select(F.col("id").alias(end), F.col("rep").alias(f"new_{end}"))
            graph = lookup_join(graph, new, end, lookup_rows=scratch.rows[name])
        graph = scratch.table(
            undirected(graph.select("new_u", "new_v"), "new_u", "new_v"), f"edges{round_no + 1}")
        scratch.drop(f"edges{round_no}")
    else:
        raise RuntimeError(f"no convergence after {MAX_ROUNDS} rounds")
    if not picked:
        return graph.select(F.col("u").alias("id"), F.col("v").alias("component"))
    # Follow the choices back from the last, smallest graph to the first. Small steps stay one
    # plan of broadcast joins, until all that it would broadcast is as much as one lookup may be:
    # a step's lookup, and its choices twice where they were followed.
    last = len(picked) - 1
    labels, rows = picked[last], scratch.rows[f"choice{last}"]
    open_rows = 2 * rows
    for round_no in range(last - 1, -1, -1):
        onward = labels.select(F.col("id").alias("rep"), F.col("rep").alias("_onward"))
        labels = lookup_join(picked[round_no], onward, "rep", lookup_rows=rows).select(
            "id", F.coalesce("_onward", "rep").alias("rep"))
        open_rows += rows + 2 * scratch.rows[f"choice{round_no}"]
        rows = scratch.rows[f"choice{round_no}"]
        if round_no == 0 or open_rows > skew.BROADCAST_ROWS:
            labels, open_rows = scratch.table(labels, f"labels{round_no}"), 0
    smallest = labels.groupBy("rep").agg(F.min("id").alias("component"))
    if rows > skew.BROADCAST_ROWS:
        smallest = scratch.table(smallest, "smallest")
        rows = scratch.rows["smallest"]
    return lookup_join(labels, smallest, "rep", lookup_rows=rows).select("id", "component")


def with_isolated(labels: DataFrame, vertices: DataFrame, id_col: str) -> DataFrame:
    """Add the vertices without an edge as components of their own."""
    ids = vertices.select(F.col(id_col).alias("id")).distinct()
    return ids.join(labels, "id", "left").select(
        "id", F.coalesce("component", "id").alias("component"))


def _stars(relation: DataFrame, person: str, publication: str,
           scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Per publication its first person, as a written table, and one edge from there to each of
    its persons.

    The stars connect the same persons as all pairs would, with as many edges as rows. A
    publication that holds a large share of the rows is no single task's work.
    """
    relation = relation.where(F.col(publication).isNotNull())
    first = scratch.table(relation.groupBy(publication).agg(F.min(person).alias("first")), "first")
    edges = lookup_join(relation, first, publication, lookup_rows=scratch.rows["first"]).select(
        F.col("first").alias("src"), F.col(person).alias("dst"))
    return first, edges


def author_components(author: DataFrame, include_isolated: bool = True) -> DataFrame:
    """``id, component`` of the co-author graph's persons, labelled by the smallest person id.

    No pair of authors is formed. Persons who only wrote alone are components of their own, or
    left out.
    """
    rows = author.select("person_id", "publication_key")
    _, edges = _stars(rows, "person_id", "publication_key", Scratch(author.sparkSession, "stars"))
    labels = connected_components(edges)
    return with_isolated(labels, rows, "person_id") if include_isolated else labels


def bipartite_components(
    relation: DataFrame, person: str = "person_id", publication: str = "publication_key",
    vertices: DataFrame | None = None,
) -> DataFrame:
    """Components over a person-publication relation; ids are ``p:...`` and ``k:...``.

    Persons are labelled first; a publication has the label of any of its persons.
    ``vertices(id)`` adds isolated ones, e.g. persons who never wrote anything.
    """
    scratch = Scratch(relation.sparkSession, "bipartite")
    rows = relation.select(person, publication)
    first, edges = _stars(rows, person, publication, scratch)
    persons = scratch.table(with_isolated(connected_components(edges), rows, person), "persons")
    works = lookup_join(first, persons.withColumnRenamed("id", "first"), "first",
                        lookup_rows=scratch.rows["persons"])
    # Labels stay numbers until the end; the smallest tagged id of a component is a publication's,
    # the first in the order of its digits, or a person's if it has no publication.
    def tagged(tag, column):
        return F.concat(F.lit(tag), F.col(column).cast("string"))

    smallest = scratch.table(
        persons.select(F.col("component").alias("_label"), tagged("p:", "id").alias("id")).unionAll(
            works.select("component", tagged("k:", publication)))
        .groupBy("_label").agg(F.min("id").alias("component")), "smallest")
    labels = persons.select(tagged("p:", "id").alias("id"), F.col("component").alias("_label")).unionAll(
        works.select(tagged("k:", publication), "component"))
    found = lookup_join(
        labels, smallest, "_label", lookup_rows=scratch.rows["smallest"]
    ).select("id", "component")
    return found if vertices is None else with_isolated(found, vertices, "id")


def tagged_edges(relation: DataFrame, person: str = "person_id",
                 publication: str = "publication_key") -> DataFrame:
    """``src, dst`` with ids that say which table they come from."""
    return relation.select(
        F.concat(F.lit("p:"), F.col(person).cast("string")).alias("src"),
        F.concat(F.lit("k:"), F.col(publication).cast("string")).alias("dst"))


def tagged_vertices(person: DataFrame, publication: DataFrame, person_id: str = "id",
                    publication_key: str = "key") -> DataFrame:
    """All persons and publications as tagged ids."""
    return person.select(
        F.concat(F.lit("p:"), F.col(person_id).cast("string")).alias("id")
    ).unionAll(publication.select(
        F.concat(F.lit("k:"), F.col(publication_key).cast("string")).alias("id")))


def components_above(
    graph: DataFrame, thresholds: Sequence[float], vertices: DataFrame | None = None,
    id_col: str = "id",
) -> DataFrame:
    """``threshold, id, component`` for edges with ``pair_weight > threshold``.

    All thresholds are solved in one run, as parts of one graph that do not touch.
    """
    steps = F.array(*[F.lit(float(t)) for t in thresholds])
    weight = F.round("pair_weight", 9)
    passed = F.filter(steps, lambda t: weight > t)
    edges = graph.select("author1_id", "author2_id", F.explode(passed).alias("threshold"))
    labels = connected_components(
        edges.select(F.struct("threshold", F.col("author1_id").alias("id")).alias("src"),
                     F.struct("threshold", F.col("author2_id").alias("id")).alias("dst"))
    ).select("id.threshold", "id.id", F.col("component.id").alias("component"))
    if vertices is None:
        return labels
    # One copy of the vertices per threshold; the thresholds are a handful of constants.
    every = vertices.select(F.col(id_col).alias("id")).distinct().select(
        F.explode(steps).alias("threshold"), "id")
    return every.join(labels, ["threshold", "id"], "left").select(
        "threshold", "id", F.coalesce("component", "id").alias("component"))


def _bucket(col: str, buckets: int):
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


def adjacency(edges: DataFrame, scratch: Scratch, src: str, dst: str, buckets: int) -> DataFrame:
    """``u, v, bucket``: the edges in both directions, in one folder for every bucket of ``u``."""
    links = mirrored(edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v"))
    path = f"{scratch.path}/links"
    links.withColumn("bucket", _bucket("u", buckets)).repartition(buckets, "bucket").sortWithinPartitions(
        "bucket", "u").write.partitionBy("bucket").parquet(path)
    kinds = {f.name: f.dataType.simpleString() for f in links.schema}
    return edges.sparkSession.read.schema(f"u {kinds['u']}, v {kinds['v']}, bucket int").parquet(path)


def links_at(links: DataFrame, frontier: DataFrame, rows: int, buckets: int) -> DataFrame:
    """The links from a written frontier of so many rows. Folders of buckets without a frontier vertex
    are not read; the frontier, unless it is a big one, is broadcast, so links are not moved."""
    if rows <= min(skew.LISTED_KEYS, skew.BROADCAST_ROWS):
        listed = frontier.select("id", _bucket("id", buckets).alias("bucket")).collect()
        return links.where(F.col("bucket").isin(list({r["bucket"] for r in listed}))
                           & F.col("u").isin([r["id"] for r in listed]))
    held = frontier.select(_bucket("id", buckets)).distinct().collect()  # at most ``buckets``
    return prune_to(links.where(F.col("bucket").isin([r[0] for r in held])), frontier, "u", "id", rows)


def component_of(
    edges: DataFrame, start, src: str = "author1_id", dst: str = "author2_id", buckets: int = BUCKETS,
) -> DataFrame:
    """``id`` of every vertex in the component of ``start``; nothing if it has no edge.

    The edges are written once in both directions, in buckets by the end that steps start from. A
    frontier walks outwards, and each step reads only the buckets that the frontier is in. A
    new vertex can only have been seen in the frontier before or the one before that. The steps lie below
    one folder, so the result is one scan however many there are. For many
    vertices, or a graph whose components are deep, label all of it with
    ``connected_components`` instead.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "reach")
    links = adjacency(edges, scratch, src, dst, buckets)
    first = links.where((F.col("bucket") == _bucket_of(spark, start, links, buckets)) & (F.col("u") == F.lit(start)))
    frontier = scratch.table(first.limit(1).select(F.col("u").alias("id")), "reached/step=0")
    before, step = frontier.limit(0), 0
    while rows := scratch.rows[f"reached/step={step}"]:
        found = (
            links_at(links, frontier, rows, buckets)
            .select(F.col("v").alias("id")).distinct()
            .join(frontier, "id", "left_anti")
            .join(before, "id", "left_anti")
        )
        step += 1
        before, frontier = frontier, scratch.table(found, f"reached/step={step}")
    return spark.read.schema(frontier.schema).parquet(f"{scratch.path}/reached").select("id")


def _bucket_of(spark, value, links: DataFrame, buckets: int) -> int:
    """The bucket of one vertex, so that finding it reads one folder."""
    one = spark.range(1).select(F.lit(value).cast(links.schema["u"].dataType).alias("u"))
    return one.select(_bucket("u", buckets)).first()[0]


def labelled_component(labels: DataFrame, start) -> DataFrame:
    """``id`` of every vertex in the component of ``start``, from the written labels of a graph."""
    own = labels.where(F.col("id") == F.lit(start)).select("component")
    return labels.join(F.broadcast(own.limit(1)), "component", "left_semi").select("id")


def component_sizes(labels: DataFrame, label: str = "component") -> DataFrame:
    """Members per component."""
    return labels.groupBy(label).agg(F.count(F.lit(1)).alias("size"))


def write_back(vertices: DataFrame, labels: DataFrame, id_col: str,
               columns: Mapping[str, str] = {"component": "component"}) -> DataFrame:
    """Vertices with their labels as new columns; null for a vertex without a label."""
    renamed = labels.select(F.col("id").alias(id_col),
                            *[F.col(c).alias(n) for c, n in columns.items()])
    return vertices.join(renamed, id_col, "left")
