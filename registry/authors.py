"""Author lookups, counts, samples and statistics on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from colophon.operators import authors as ops, stats
from colophon.plans import lookup
from colophon.session import Scratch
from colophon.sources import tables as table_io
from registry.common import (
    AUTHOR, PART_AUTHOR, PART_PERSON, PERSON, PUBLICATION, author, load, part_author,
    entries,
    part_person, person, publication,
)

ENTRIES, entry = entries()
NAME = "Supplier#000000003"


@entry("author_keys", f"""
with {PERSON}, {AUTHOR}
select id as person_id, publication_key from person left join author on person_id = id
where full_name = '{NAME}'""")
def _(spark, sf):
    return ops.author_keys(person(spark, sf), author(spark, sf), NAME)


_PUBLICATIONS = f"""
with {PERSON}, {AUTHOR}, {PUBLICATION}
select p.full_name, key, title, booktitle, journal, pages, year
from person me left join author a on a.person_id = me.id
  left join publication on publication.key = a.publication_key
  left join author b on b.publication_key = publication.key
  left join person p on p.id = b.person_id
where me.full_name = '{NAME}'"""


@entry("author_publications", _PUBLICATIONS)
def _(spark, sf):
    return ops.author_publications(
        NAME, person(spark, sf), author(spark, sf), publication(spark, sf))


@entry("author_publications_of_copies", _PUBLICATIONS)
def _(spark, sf):
    # The tables are laid out in the orders of the lookup first, as publishing does.
    tables = {"person": person(spark, sf), "author": author(spark, sf), "publication": publication(spark, sf)}
    folder = Scratch(spark, "copies").path
    lookup.write_copies(tables, folder)
    return ops.author_publications(NAME, **lookup.lookup_tables(
        spark, folder, {name: df.schema for name, df in tables.items()}))


@entry("author_pub_counts", f"""
with {PART_PERSON}, {PART_AUTHOR}
select id, full_name, count(publication_key) as count_publications
from person left join author on person_id = id group by id, full_name""")
def _(spark, sf):
    return ops.author_pub_counts(part_person(spark, sf), part_author(spark, sf))


@entry("author_count_one", f"""
with {AUTHOR} select count(publication_key) as count_publications from author
where person_id = 2""")
def _(spark, sf):
    return ops.author_count_one(author(spark, sf), 2)


@entry("distinct_authors", f"with {PART_AUTHOR} select distinct person_id from author")
def _(spark, sf):
    return ops.distinct_authors(part_author(spark, sf))


@entry("authors_per_publication", f"""
with {PART_AUTHOR} select publication_key, count(person_id) as n_authors from author group by 1""")
def _(spark, sf):
    return ops.authors_per_publication(part_author(spark, sf))


@entry("publication_weight", f"""
with {PART_AUTHOR} select publication_key, round(1.0 / count(person_id), 6) as publ_weight
from author group by 1""")
def _(spark, sf):
    return ops.publication_weight(part_author(spark, sf)).withColumn(
        "publ_weight", F.round("publ_weight", 6))


@entry("publication_n_authors", f"""
with {PART_AUTHOR}, {PUBLICATION}
select publication.*, n_authors from publication left join
  (select publication_key, count(*) as n_authors from author group by 1)
  on publication_key = key""")
def _(spark, sf):
    return ops.publication_n_authors(publication(spark, sf), part_author(spark, sf))


@entry("name_pub_counts", f"""
with {PART_PERSON}, {PART_AUTHOR}
select full_name as name, count(*) as pub_count from author join person on id = person_id
group by 1 order by pub_count desc nulls first, name limit 15""")
def _(spark, sf):
    counts = ops.name_pub_counts(part_person(spark, sf), part_author(spark, sf))
    return ops.top(counts, 15, F.col("pub_count").desc_nulls_first(), F.col("name"))


@entry("fractional_productivity", f"""
with {PART_PERSON}, {PART_AUTHOR},
w as (select publication_key, 1.0 / count(*) as w from author group by 1)
select full_name as name, round(sum(w), 6) as weight
from author join w using (publication_key) join person on id = person_id
group by 1 order by weight desc nulls first, name limit 15""")
def _(spark, sf):
    found = ops.fractional_productivity(part_person(spark, sf), part_author(spark, sf))
    return ops.top(found.withColumn("weight", F.round("weight", 6)), 15,
                   F.col("weight").desc_nulls_first(), F.col("name"))


_TOP = """top as (
  select id, full_name, count(publication_key) as count_publications
  from person left join author on person_id = id group by id, full_name
  order by count_publications desc nulls first, id limit {k})"""
_RANDOM = """random as (
  select id, full_name, count(publication_key) as count_publications
  from person left join author on person_id = id group by id, full_name
  order by md5(id || ':0'), id limit {n})"""


@entry("top_k_authors", f"""
with {PART_PERSON}, {PART_AUTHOR}, {_TOP.format(k=100)} select * from top""")
def _(spark, sf):
    return ops.top_k_of(part_person(spark, sf), part_author(spark, sf), 100)


@entry("random_sample", f"""
with {PART_PERSON}, {PART_AUTHOR}, {_RANDOM.format(n=100)} select * from random""")
def _(spark, sf):
    return ops.random_of(part_person(spark, sf), part_author(spark, sf), 100)


@entry("benchmark_authors", f"""
with {PART_PERSON}, {PART_AUTHOR}, {_TOP.format(k=100)}, {_RANDOM.format(n=100)}
select full_name, count_publications from top
union select full_name, count_publications from random""")
def _(spark, sf):
    return ops.benchmark_authors(part_person(spark, sf), part_author(spark, sf))


@entry("batch_author_lookup", f"""
with {PERSON}, {AUTHOR}, {PUBLICATION}, {_TOP.format(k=100)}, {_RANDOM.format(n=100)},
wanted as (select full_name from top union select full_name from random)
select wanted.full_name as requested_name, p.full_name, key, title, booktitle, journal, pages,
  year
from wanted join person me on me.full_name = wanted.full_name
  left join author a on a.person_id = me.id
  left join publication on publication.key = a.publication_key
  left join author b on b.publication_key = publication.key
  left join person p on p.id = b.person_id""")
def _(spark, sf):
    # The list of most productive and random authors goes through a CSV file, as a user's does.
    people, authorship = person(spark, sf), author(spark, sf)
    path = Scratch(spark, "names").path + "/authors.csv"
    table_io.write_csv(ops.benchmark_authors(people, authorship), path)
    return ops.publications_of(
        table_io.read_names(spark, path), people, authorship, publication(spark, sf))


@entry("largest_author_lists", f"""
with {PART_AUTHOR}, {PUBLICATION}
select key, title, round(w, 6) as weight
from (select publication_key, 1.0 / count(*) as w from author group by 1
      order by w asc nulls last, publication_key limit 20) join publication
  on key = publication_key""")
def _(spark, sf):
    return ops.largest_author_lists(
        publication(spark, sf), part_author(spark, sf)
    ).withColumn("weight", F.round("weight", 6))


@entry("summary_stats", """
select event_type, min(value) as time_min, max(value) as time_max,
  round(median(value), 6) as time_median, round(avg(value), 6) as time_mean,
  round(stddev_samp(value), 6) as time_std, round(sum(value), 4) as time_sum,
  count(value) as time_count,
  arg_max(event_id, struct_pack(v := value, e := -event_id)) as arg_max,
  arg_min(event_id, struct_pack(v := value, e := event_id)) as arg_min
from events group by event_type""")
def _(spark, sf):
    found = stats.summary_stats(
        load(spark, sf, "events"), "event_type", "value", "event_id", "event_id")
    return found.select(
        "event_type", F.col("min").alias("time_min"), F.col("max").alias("time_max"),
        F.round("median", 6).alias("time_median"), F.round("mean", 6).alias("time_mean"),
        F.round("std", 6).alias("time_std"), F.round("sum", 4).alias("time_sum"),
        F.col("count").alias("time_count"), "arg_max", "arg_min")


@entry("summary_of_runs", """
select count(s) as runs, round(avg(s), 4) as mean, round(stddev_samp(s), 4) as std
from (select sum(value) as s from events group by event_type)""")
def _(spark, sf):
    found = stats.summary_of_runs(load(spark, sf, "events"), "event_type", "value")
    return found.select("runs", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))
