"""From parsed records to the relational tables with surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from colophon.functions.markup import (
    attribute, decode_entities, predefined_entities, strip_element,
)
from colophon.functions.values import blank_to_null, has_flag, last_value, month_number, safe_int
from colophon.operators.ordering import dense_ids, extended_ids
from colophon.operators.skew import lookup_join
from colophon.session import Scratch

# table -> (child element, column for its text, columns from its attributes)
CHILD_TABLES: Mapping[str, tuple[str, str, list[str]]] = {
    "electronic_edition": ("ee", "url", ["type"]),
    "crossref": ("crossref", "str", []),
    "cite": ("cite", "str", ["label", "ref"]),
    "note": ("note", "note", ["type", "label"]),
    "url": ("url", "url", ["type"]),
    "isbn": ("isbn", "isbn", ["type"]),
}
DICTIONARIES = ("publisher", "series", "school")


def _text(value: Column, element: str) -> Column:
    return F.coalesce(strip_element(value, [element]), F.lit(""))


def children(records: DataFrame, element: str) -> DataFrame:
    """One row per child element: publication key, position, text and attributes, and the record's place
    in the dump if it is known."""
    place = [c for c in records.columns if c == "at"]
    return records.select(
        F.col("_key").alias("publication_key"), *place, F.posexplode(element).alias("pos", "child")
    ).select("publication_key", *place, "pos", "child.*")


def person_mentions(records: DataFrame) -> DataFrame:
    """Authors and editors of every record with name and ORCID."""
    mentions = None
    for role in ("author", "editor"):
        rows = children(records, role)
        bibtex = F.col("_bibtex") if "_bibtex" in rows.columns else F.lit(None).cast("string")
        part = rows.select(
            F.lit(role).alias("role"),
            "publication_key",
            _text(F.col("_VALUE"), role).alias("full_name"),
            blank_to_null(F.col("_orcid")).alias("orcid"),
            bibtex.alias("bibtex"),
            F.col("_aux").alias("aux"),
        )
        mentions = part if mentions is None else mentions.unionByName(part)
    return mentions


def person_dictionary(mentions: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``person``: each (name, ORCID) once; a name with and without ORCID is two persons. ``known`` persons
    keep their ids."""
    found = mentions.select("full_name", "orcid").distinct()
    return extended_ids(known, found, ["full_name", "orcid"], ["full_name", "orcid"])


def _person_key() -> Column:
    """Name and ORCID as one key that is never null."""
    return F.concat(F.coalesce("orcid", F.lit("")), F.lit("\t"), "full_name")


def contributions(mentions: DataFrame, person: DataFrame, role: str) -> DataFrame:
    """``author`` or ``editor`` rows with person ids, each row once.

    ``mentions`` should be a written table. A name that holds a large share of all mentions is
    looked up apart from the others.
    """
    ids = person.select(_person_key().alias("_person"), F.col("id").alias("person_id"))
    rows = mentions.where(F.col("role") == role).withColumn("_person", _person_key())
    found = lookup_join(rows, ids, "_person")
    columns = ["person_id", "publication_key"]
    if role == "author":
        columns += ["bibtex", "aux"]
    return found.select(*columns).distinct()


def child_rows(records: DataFrame, table: str) -> DataFrame:
    """Rows of one of the per-publication tables, still without ids."""
    element, text_column, attributes = CHILD_TABLES[table]
    rows = children(records, element).select(
        "publication_key",
        "pos",
        _text(F.col("_VALUE"), element).alias(text_column),
        *[F.col(f"_{a}").alias(a) for a in attributes],
    )
    if table == "electronic_edition":
        rows = rows.select(
            "publication_key", "pos", "url",
            has_flag(F.col("type"), "archive").alias("is_archive"),
            has_flag(F.col("type"), "oa").alias("is_oa"),
        )
    return rows


def child_table(records: DataFrame, table: str) -> DataFrame:
    """One of the per-publication tables with dense ids in the order of key and position."""
    return dense_ids(child_rows(records, table), ["publication_key", "pos"]).drop("pos")


def name_dictionary(
    rows: DataFrame, name: str = "name", attributes: tuple[str, ...] = ("href",),
    order: tuple[str, ...] = ("publication_key", "pos"), known: DataFrame | None = None,
) -> DataFrame:
    """Each name once with a dense id; its attributes are those of the first occurrence. ``known`` names
    keep ids and attributes."""
    first = [F.min_by(a, F.struct(*order)).alias(a) for a in attributes]
    if first:
        named = rows.where(F.col(name).isNotNull()).groupBy(name).agg(*first)
    else:
        named = rows.where(F.col(name).isNotNull()).select(name).distinct()
    return extended_ids(known, named, [name], [name])


def dictionary_table(records: DataFrame, table: str, known: DataFrame | None = None) -> DataFrame:
    """``publisher``, ``series`` (name and href) or ``school`` (name)."""
    if table == "school":
        rows = records.select(F.explode("school").alias("name"))
        return name_dictionary(rows, attributes=(), known=known)
    # The first occurrence is that in the dump; records of unknown place stand in the order of their keys.
    place = "at" if "at" in records.columns else "publication_key"
    rows = children(records, table).select(
        place, "pos", _text(F.col("_VALUE"), table).alias("name"), F.col("_href").alias("href"))
    return name_dictionary(rows, order=(place, "pos"), known=known)


def publication_rows(records: DataFrame) -> DataFrame:
    """Publication columns of every record, with dictionary names instead of ids.

    Of a repeated element the last one counts.
    """
    def text(element: str) -> Column:
        return strip_element(last_value(F.col(element)), [element])

    columns = {
        "key": F.col("_key"),
        "category": F.col("category"),
        "title": text("title"),
        "year": safe_int(text("year")),
        "booktitle": text("booktitle"),
        "pages": text("pages"),
        "address": text("address"),
        "journal": text("journal"),
        "volume": safe_int(text("volume")),
        "number": text("number"),
        "month": F.lower(F.trim(text("month"))),
        "month_num": month_number(text("month")),
        "cdrom": text("cdrom"),
        "chapter": safe_int(text("chapter")),
        "publnr": safe_int(text("publnr")),
        "cdate": F.try_to_date("_cdate"),
        "mdate": F.try_to_date("_mdate"),
        "type": F.col("_publtype"),
        "title_bibtex": F.when(F.contains("xml", F.lit("bibtex")), _title_bibtex()),
        "reviewid": F.col("_reviewid"),
        "rating": F.col("_rating"),
        "school": last_value(F.col("school")),
        "publisher": _dictionary_name("publisher"),
        "series": _dictionary_name("series"),
    }
    return records.select(*[c.alias(n) for n, c in columns.items()])


def _title_bibtex() -> Column:
    """The attribute of the last title. Only the attribute is decoded, and that once."""
    raw = F.array(attribute(F.col("xml"), "title", "bibtex"))
    decoded = F.transform(raw, lambda v: decode_entities(v))
    return F.transform(decoded, lambda v: predefined_entities(v))[0]


INTEGERS = ("year", "volume", "chapter", "publnr")


def integer_rejects(records: DataFrame) -> DataFrame:
    """``key, element, value`` of child elements that should be whole numbers and are not, or do
    not fit. Of a repeated element the last one counts."""
    def reject(element: str) -> Column:
        value = strip_element(last_value(F.col(element)), [element])
        wrong = blank_to_null(value).isNotNull() & safe_int(value).isNull()
        return F.when(wrong, F.struct(F.lit(element).alias("element"), value.alias("value")))

    found = F.array_compact(F.array(*[reject(e) for e in INTEGERS]))
    return records.select(F.col("_key").alias("key"), F.inline(found))


def _dictionary_name(element: str) -> Column:
    last = last_value(F.col(element))
    return F.when(last.isNotNull(), _text(last["_VALUE"], element))


def resolve_names(rows: DataFrame, dictionary: DataFrame, column: str) -> DataFrame:
    """Replace a name column by the id of that name (null stays null)."""
    ids = dictionary.select(F.col("name").alias(column), F.col("id").alias(f"{column}_id"))
    return lookup_join(rows, ids, column).drop(column)


def publication_table(records: DataFrame, dictionaries: Mapping[str, DataFrame]) -> DataFrame:
    """``publication``: one row per record key with ids of school, publisher and series."""
    scratch = Scratch(records.sparkSession, "publication")
    rows = scratch.table(publication_rows(records), "named")
    for name in ("school", "publisher", "series"):
        rows = resolve_names(rows, dictionaries[name], name)
    return rows


def attach_by_position(left: DataFrame, right: DataFrame, order_left, order_right) -> DataFrame:
    """Put two files without a common key side by side, row by row.

    For files that already carry the same row order in the given columns. Rows of the longer
    file stay, with nulls beside them.
    """
    left_rows = dense_ids(left, order_left, "_row")
    right_rows = dense_ids(right, order_right, "_row")
    return left_rows.join(right_rows, "_row", "full").drop("_row")

