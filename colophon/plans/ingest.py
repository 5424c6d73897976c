"""From an XML dump to checked tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from colophon.operators import checks, profile, shred
from colophon.plans import lookup
from colophon.schemas import TABLES
from colophon.session import Scratch
from colophon.sources import tables as table_io, xml


def profile_dump(spark: SparkSession, path: str | Sequence[str]) -> dict[str, DataFrame]:
    """What is in a dump: records, their child elements, unexpected elements, and the types of
    notes, links and numbers. The dump is scanned once."""
    chunks = Scratch(spark, "profile").table(xml.scan_chunks(spark, path), "chunks")
    records = xml.records_of(chunks)
    return {
        "records": profile.record_tag_counts(records),
        "children": profile.child_tag_counts(records),
        "unexpected": profile.unexpected_elements(chunks),
        "types": profile.distinct_attribute_values(
            xml.parse_records(records), {e: "type" for e in ("note", "ee", "url", "isbn")}),
    }


def ingest(
    spark: SparkSession, path: str | Sequence[str], folder: str, strict: bool = False, known: str | None = None
) -> dict[str, int]:
    """Shred a dump into the tables below ``folder`` and return their numbers of rows.

    The dump is read and parsed once into a staging table, which all tables are made from.
    Records that cannot be used go to ``folder/rejects``; with ``strict`` they fail the job. Texts
    where a whole number should be are null in the tables and listed in ``folder/rejects_integer``.
    The folder is for loading: ``publish`` puts its tables in place of the live ones.

    ``known`` is a folder of earlier tables. Persons, publishers, series and schools that it has keep their
    ids, and stay even if the dump has them no longer; only new ones are numbered, behind the others.
    """
    table_io.check_unpublished(spark, folder)
    scratch = Scratch(spark, "ingest")
    parsed = scratch.table(xml.parse_records(xml.scan_records(spark, path)), "records")
    xml.rejected_records(parsed).write.mode("overwrite").parquet(f"{folder}/rejects")
    records = xml.good_records(parsed, strict)
    shred.integer_rejects(records).write.mode("overwrite").parquet(f"{folder}/rejects_integer")

    # Copied, as the folder may be the one that is written.
    earlier = {t: scratch.table(df, f"known_{t}") for t, df in table_io.read_tables(
        spark, known, ("person", *shred.DICTIONARIES)).items()} if known else {}
    mentions = scratch.table(shred.person_mentions(records), "mentions")
    counts = table_io.write_tables({"person": shred.person_dictionary(mentions, earlier.get("person"))}, folder)
    person = table_io.read_table(spark, folder, "person")
    counts |= table_io.write_tables(
        {role: shred.contributions(mentions, person, role) for role in ("author", "editor")},
        folder)
    scratch.drop("mentions")

    counts |= table_io.write_tables(
        {t: shred.dictionary_table(records, t, earlier.get(t)) for t in shred.DICTIONARIES}, folder)
    names = table_io.read_tables(spark, folder, shred.DICTIONARIES)
    counts |= table_io.write_tables(
        {"publication": shred.publication_table(records, names)}, folder)
    counts |= table_io.write_tables(
        {t: shred.child_table(records, t) for t in shred.CHILD_TABLES}, folder)
    scratch.drop("records")
    return counts


def check(spark: SparkSession, folder: str) -> DataFrame:
    """Violations per rule of the tables below ``folder``."""
    return checks.integrity_report(table_io.read_tables(spark, folder))


# Rules of the data itself; the source breaks the others now and then.
PUBLISH_KINDS = ("primary key", "foreign key", "not null")


def publish(spark: SparkSession, folder: str, target: str | None = None,
            database: str | None = None, kinds: Sequence[str] = PUBLISH_KINDS) -> list[str]:
    """Make loaded tables visible once they hold their constraints.

    ``folder`` is where ``ingest`` or a CSV load put them. Raises with the broken rules if there are
    any of the given kinds, and changes nothing then. The tables replace those below ``target``, if
    it is given, all at once and with the copies that author lookups read, and are known to SQL: in
    ``database`` for every session, else in this one.
    A catalogue knows tables one by one, so there each table is complete, but only ``target`` changes as a whole.
    """
    broken = (
        check(spark, folder)
        .where(F.col("kind").isin(list(kinds)) & (F.col("violations") > 0))
        .collect()  # one row per rule at most
    )
    if broken:
        raise ValueError("; ".join(f"{r.kind} {r.rule}: {r.violations}" for r in broken))
    if target and target != folder:
        tables = table_io.read_tables(spark, folder)
        home = table_io.publish_tables(spark, tables | lookup.copies(tables), target)
    else:
        home = table_io.current_folder(spark, folder)
    known = set(t.name for t in spark.catalog.listTables(database)) if database else set()
    for table in TABLES:
        if not database:
            spark.read.schema(table_io.table_schema(table)).parquet(f"{home}/{table}").createOrReplaceTempView(table)
        elif table in known:
            spark.sql(f"alter table `{database}`.`{table}` set location '{home}/{table}'")
        else:
            spark.catalog.createTable(f"{database}.{table}", path=f"{home}/{table}", source="parquet")
    return list(TABLES)
