"""Author lookups, productivity counts and author samples.

Tables: ``person(id, full_name)``, ``author(person_id, publication_key)`` with unique rows,
``publication(key, title, booktitle, journal, pages, year, ...)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from colophon.operators.skew import LISTED_KEYS, checked_broadcast, lookup_join, prune_to
from colophon.session import Scratch

PUBLICATION_COLUMNS = ["key", "title", "booktitle", "journal", "pages", "year"]


def author_keys(person: DataFrame, author: DataFrame, name: str) -> DataFrame:
    """Publication keys of every person with this name; one null key for a person without."""
    named = person.where(F.col("full_name") == F.lit(name)).select("id")
    scratch = Scratch(person.sparkSession, "author")
    ids = scratch.table(named, "ids")
    rows = prune_to(author.select("person_id", "publication_key"), ids, "person_id", "id",
                    rows=scratch.rows["ids"])
    return ids.join(rows, ids["id"] == rows["person_id"], "left").select(
        F.col("id").alias("person_id"), "publication_key")


def publications_of(
    names: DataFrame, person: DataFrame, author: DataFrame, publication: DataFrame,
    person_by_id: DataFrame | None = None, author_by_publication: DataFrame | None = None,
) -> DataFrame:
    """Publications of all requested names with their authors, in one plan.

    ``names(requested_name)``, unique. One row per requested name, publication and author of
    it, the requested one included; a person without publications gives one row of nulls, a
    name without a person none.

    Each step reduces the next big table to the keys that matter: by a list that the scan gets or a
    broadcast filter during it while the keys are few, else by a shuffle join. ``person_by_id`` and
    ``author_by_publication`` are copies of the tables in the order of that column, if there are any.
    """
    spark = names.sparkSession
    scratch = Scratch(spark, "publications")
    rows = author.select("person_id", "publication_key")
    coauthor_rows = rows if author_by_publication is None else author_by_publication.select(*rows.columns)
    people = person.select("id", "full_name")
    listed_names = names.limit(LISTED_KEYS + 1).collect()
    if len(listed_names) <= LISTED_KEYS:
        wanted = people.where(F.col("full_name").isin(
            [r["requested_name"] for r in listed_names if r["requested_name"] is not None]
        )).select(F.col("full_name").alias("requested_name"), "id")
    else:
        wanted = people.join(
            checked_broadcast(names), F.col("full_name") == F.col("requested_name")
        ).select("requested_name", "id")
    # A short list goes through the driver, which saves a written table; its length is checked.
    few = wanted.limit(LISTED_KEYS + 1).collect()
    n_wanted = len(few)
    if n_wanted <= LISTED_KEYS:
        wanted = spark.createDataFrame(few, wanted.schema)
    else:
        wanted = scratch.table(wanted, "wanted")
        n_wanted = scratch.rows["wanted"]
    own = prune_to(rows, wanted, "person_id", "id", rows=n_wanted)
    keys = scratch.table(
        wanted.join(own, wanted["id"] == own["person_id"], "left").select(
            "requested_name", "publication_key"),
        "keys",
    )
    n_keys = scratch.rows["keys"]
    found = prune_to(
        publication.select(*PUBLICATION_COLUMNS), keys, "key", "publication_key", rows=n_keys)
    ids = scratch.table(
        prune_to(coauthor_rows, keys, "publication_key", "publication_key", rows=n_keys),
        "authorship")
    by_id = people if person_by_id is None else person_by_id.select(*people.columns)
    people = prune_to(by_id, ids, "id", "person_id", rows=scratch.rows["authorship"])
    named = ids.join(people, ids["person_id"] == people["id"], "left").select(
        F.col("publication_key").alias("named_key"), "full_name")
    columns = ["requested_name", "full_name", *PUBLICATION_COLUMNS]
    # A listed publication has an author, the requested one; the other rows stay nulls. The
    # authorships stream past the list of keys, so a long author list is no single task's work.
    listed = checked_broadcast(keys, n_keys)
    complete = named.join(listed, F.col("named_key") == F.col("publication_key")).join(
        found, F.col("publication_key") == F.col("key")).select(*columns)
    without = keys.join(found.select("key"), F.col("publication_key") == F.col("key"), "left_anti").select(
        "requested_name", *[F.lit(None).cast(kind).alias(name) for name, kind in [
            ("full_name", "string"), *[(c, publication.schema[c].dataType) for c in PUBLICATION_COLUMNS]]])
    return complete.unionByName(without.select(*columns))


def author_publications(
    name: str, person: DataFrame, author: DataFrame, publication: DataFrame,
    person_by_id: DataFrame | None = None, author_by_publication: DataFrame | None = None,
) -> DataFrame:
    """Publications of one name with all their authors."""
    names = person.sparkSession.createDataFrame([(name,)], "requested_name string")
    return publications_of(names, person, author, publication, person_by_id, author_by_publication).drop(
        "requested_name")


def author_pub_counts(person: DataFrame, author: DataFrame) -> DataFrame:
    """``id, full_name, count_publications`` of every person; 0 for a person without any."""
    counts = author.groupBy("person_id").agg(F.count("publication_key").alias("n"))
    return person.join(counts, person["id"] == counts["person_id"], "left").select(
        "id", "full_name", F.coalesce("n", F.lit(0)).alias("count_publications"))


def author_count_one(author: DataFrame, person_id: int) -> DataFrame:
    """Number of publications of one author; 0 if there are none."""
    return author.where(F.col("person_id") == person_id).agg(
        F.count("publication_key").alias("count_publications"))


def distinct_authors(author: DataFrame) -> DataFrame:
    return author.select("person_id").distinct()


def authorship(author: DataFrame) -> DataFrame:
    """The two keys of the author rows. The filter is what joins would add on some uses only;
    here it keeps all uses in a plan the same, so that they share one shuffle."""
    return author.select("person_id", "publication_key").where(
        "person_id is not null and publication_key is not null")


def authors_per_publication(author: DataFrame) -> DataFrame:
    return author.groupBy("publication_key").agg(F.count("person_id").alias("n_authors"))


def with_publication_count(rows: DataFrame) -> DataFrame:
    """Authorships with the number of authors of their publication. The counts are a written
    lookup, so a publication that holds a large share of all rows is no single task's work."""
    scratch = Scratch(rows.sparkSession, "sizes")
    counts = scratch.table(authors_per_publication(rows), "counts")
    return lookup_join(rows, counts, "publication_key", lookup_rows=scratch.rows["counts"], counted="n_authors")


def publication_weight(author: DataFrame) -> DataFrame:
    """The share each author has in a publication: 1 / number of authors."""
    return author.groupBy("publication_key").agg(
        (F.lit(1.0) / F.count("person_id")).alias("publ_weight"))


def publication_n_authors(publication: DataFrame, author: DataFrame) -> DataFrame:
    """Publications with their number of authors; null for a publication without any."""
    counts = authors_per_publication(author)
    return publication.join(
        counts, publication["key"] == counts["publication_key"], "left"
    ).drop("publication_key")


def name_pub_counts(person: DataFrame, author: DataFrame) -> DataFrame:
    """Publications per **name**: persons of one name count together, names without a
    publication are left out. Authorships are counted per person before names are joined."""
    counts = author.groupBy("person_id").agg(F.count("publication_key").alias("n"))
    return (
        counts.join(person, counts["person_id"] == person["id"])
        .groupBy(F.col("full_name").alias("name"))
        .agg(F.sum("n").alias("pub_count"))
    )


def fractional_productivity(person: DataFrame, author: DataFrame) -> DataFrame:
    """Sum of 1 / number of authors per name."""
    shares = with_publication_count(authorship(author)).groupBy("person_id").agg(
        F.sum(F.lit(1.0) / F.col("n_authors")).alias("share"))
    return (
        shares.join(person, shares["person_id"] == person["id"])
        .groupBy(F.col("full_name").alias("name"))
        .agg(F.sum("share").alias("weight"))
    )


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows of an order; give a unique last column to make ties definite."""
    return df.orderBy(*order).limit(k)


def top_k_authors(counts: DataFrame, k: int = 100) -> DataFrame:
    """Persons with most publications."""
    return top(counts, k, F.col("count_publications").desc_nulls_first(), F.col("id").asc())


def top_k_of(person: DataFrame, author: DataFrame, k: int = 100) -> DataFrame:
    """Persons with most publications, with names. Authorships are ranked per person first, and
    only the ``k`` that remain meet the persons. If fewer than ``k`` persons have publications,
    the lowest ids of the others follow."""
    counts = author.join(person.select(F.col("id").alias("person_id")), "person_id", "left_semi").groupBy(
        F.col("person_id").alias("id")).agg(F.count("publication_key").alias("count_publications"))
    scratch = Scratch(person.sparkSession, "top")
    first = scratch.table(top_k_authors(counts, k), "first")
    missing = k - scratch.rows["first"]
    if missing > 0:
        others = person.select("id").join(first, "id", "left_anti")
        first = first.unionByName(top(others, missing, F.col("id").asc()).select(
            "id", F.lit(0).cast("long").alias("count_publications")))
    return _with_names(first, person, scratch.rows["first"] + max(missing, 0))


def _with_names(few: DataFrame, person: DataFrame, rows: int) -> DataFrame:
    named = prune_to(person.select("id", "full_name"), few, "id", "id", rows=rows)
    return few.join(F.broadcast(named) if rows <= LISTED_KEYS else named, "id").select(
        "id", "full_name", "count_publications")


def random_of(person: DataFrame, author: DataFrame, n: int = 100, seed: str = "0") -> DataFrame:
    """A random but repeatable sample of ``n`` persons with their numbers of publications; only
    the authorships of the sample are counted."""
    scratch = Scratch(person.sparkSession, "sample")
    few = scratch.table(random_authors(person.select("id", "full_name"), n, seed), "persons")
    own = prune_to(author.select("person_id", "publication_key"), few, "person_id", "id",
                   rows=scratch.rows["persons"])
    counts = own.groupBy(F.col("person_id").alias("id")).agg(F.count("publication_key").alias("n"))
    return few.join(counts, "id", "left").select(
        "id", "full_name", F.coalesce("n", F.lit(0)).alias("count_publications"))


def random_authors(counts: DataFrame, n: int = 100, seed: str = "0") -> DataFrame:
    """A random but repeatable sample of ``n`` persons, whatever the partitioning."""
    draw = F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{seed}")))
    return top(counts, n, draw.asc(), F.col("id").asc())


def benchmark_authors(person: DataFrame, author: DataFrame, k: int = 100, n: int = 100,
                      seed: str = "0") -> DataFrame:
    """Names and counts of the most productive persons and of a random sample, without
    duplicates."""
    columns = ["full_name", "count_publications"]
    return (
        top_k_of(person, author, k).select(*columns)
        .union(random_of(person, author, n, seed).select(*columns))
        .distinct()
    )


def largest_author_lists(publication: DataFrame, author: DataFrame, k: int = 20) -> DataFrame:
    """Publications with the lowest weight per author. Only the keys are ranked; titles are
    joined to the ``k`` rows that remain."""
    weights = publication_weight(author)
    lowest = top(weights, k, F.col("publ_weight").asc_nulls_last(), F.col("publication_key"))
    return publication.join(
        F.broadcast(lowest), publication["key"] == lowest["publication_key"]
    ).select("key", "title", F.col("publ_weight").alias("weight"))
