"""The relational tables as CSV and Parquet."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from colophon.functions.values import blank_to_null, integral
from colophon.schemas import DEFAULTS, TABLES
from colophon.session import Scratch, path_exists, read_line, remove_before, replace_line
from colophon.sources.lexical import (
    HEAD, RECORD, TAIL, SplitStates, joined_at_splits, lines_of, runs_of, split_states,
)


def table_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; texts quoted, quotes inside doubled."""
    df.write.mode("overwrite").csv(
        path, header=True, quoteAll=True, escape='"', dateFormat="yyyy-MM-dd")


def clean_value(col: Column, kind: T.DataType) -> Column:
    """CSV text as a value of the column's type: blanks become null, ``1991.0`` a number."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return integral(col, kind.simpleString())
    if isinstance(kind, T.StringType):
        return blank_to_null(col)
    if isinstance(kind, T.DateType):
        return F.try_to_date(F.trim(col))
    return F.trim(col).try_cast(kind)


def clean_columns(df: DataFrame, schema: T.StructType,
                  defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Columns of a table by name, cleaned and typed; a missing column is null. Blanks of a column
    with a default become that."""
    present, defaults = set(df.columns), defaults or {}

    def cleaned(field):
        value = (clean_value(F.col(f"`{field.name}`"), field.dataType) if field.name in present
                 else F.lit(None).cast(field.dataType))
        if field.name in defaults:
            blank = blank_to_null(F.col(f"`{field.name}`")).isNull() if field.name in present else F.lit(True)
            value = F.when(blank, F.lit(defaults[field.name]).cast(field.dataType)).otherwise(value)
        return value.alias(field.name)

    return df.select(*[cleaned(f) for f in schema.fields])


_RAW, _REASON = "_corrupt_record", "_reason"
# A row of more characters is not put together from several splits.
LONGEST_ROW = 64 << 20
_INSIDE = re.compile(r'[^"]*(?:""[^"]*)*')


def _open_after(line: str, quoted: int) -> int:
    """Whether a value is still open in quotes behind a line. A quote opens a value only at its begin;
    what stands behind the closing one belongs to the value up to the next comma."""
    at = 0
    if quoted:
        at = _INSIDE.match(line).end()
        if at == len(line):
            return 1
        at = line.find(",", at) + 1
        if not at:
            return 0
    while True:
        if line.startswith('"', at):
            at = _INSIDE.match(line, at + 1).end()
            if at == len(line):
                return 1
        at = line.find(",", at) + 1
        if not at:
            return 0


def _cut_at_rows(states: SplitStates):
    """Task function: lines of one or more splits in, whole rows out, which may be several lines; and of every
    split the end of a row that began before it, and the begin of one that goes on behind it."""
    def cut(batches):
        import pyarrow as pa

        names = ["file", "split_start", "place", "part", "body"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
        current, held, state, place, head = None, [], 0, 0, False

        def rest():
            return [(*current, place, HEAD if head else TAIL, "".join(f"{line}\n" for line in held))] if held else []

        def rows(out):
            columns = list(zip(*out)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            out = []
            files, splits = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            lines = batch.column(2).to_pylist()
            bounds = runs_of(files, splits)
            for begin, end in zip(bounds, bounds[1:]):
                split = (int(files[begin]), int(splits[begin]))
                if split != current:
                    out += rest() if current is not None else []
                    current, held, place, state = split, [], 0, states.at(*split)
                    head = bool(state)
                for line in lines[begin:end]:
                    state = _open_after(line, state)
                    held.append(line)
                    if not state:
                        body = "\n".join(held).removesuffix("\r")
                        if head or body.strip():
                            place += not head
                            out.append((*current, place, HEAD if head else RECORD, body))
                        held, head = [], False
            yield rows(out)
        if current is not None:
            yield rows(rest())

    return cut


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """``body, header`` of every row of CSV files whose values may hold line breaks, read by splits of any
    size. ``header`` marks the first row of a file.

    The quotes of all lines are read first, which tells the splits that begin inside a value. Only rows that
    cross the end of a split are written and joined afterwards.
    """
    lines = lines_of(spark, path, lineSep="\n")
    states = split_states(lines.where(F.contains("value", F.lit('"'))), _open_after, 2)
    pieces = lines.mapInArrow(_cut_at_rows(states), "file long, split_start long, place long, part int, body string")
    ends = Scratch(spark, "csv").table(pieces.where(F.col("part") != RECORD), "ends")
    whole = pieces.where(F.col("part") == RECORD).drop("part").unionByName(joined_at_splits(
        ends.withColumn("place", F.col("place") + 1), LONGEST_ROW))
    first = (F.col("split_start") == 0) & (F.col("place") == 1)
    return whole.select(F.when(first, F.ltrim(F.col("body"), F.lit("\ufeff"))).otherwise(F.col("body")).alias("body"),
                        first.alias("header"))


def _parsed_rows(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The values of all rows as text, and a row's text where their number is not that of the header. Every
    file has to have the same header."""
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RAW]])
    values = F.from_csv(F.col("body"), F.lit(", ".join(f"`{f.name}` string" for f in text)), {
        "mode": "PERMISSIVE", "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": _RAW})
    rows = csv_rows(spark, path).select("header", values.alias("v"))
    same = F.lower(F.to_json(F.array(*[F.col("v")[n] for n in names]))) == F.lower(
        F.to_json(F.array(*[F.lit(n) for n in names])))
    other = F.raise_error(F.concat(F.lit(f"{path}: another header: "), F.to_json("v"))).cast("boolean")
    return rows.where(F.when(~F.col("header"), True).when(same, False).otherwise(other)).select("v.*")


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True,
             defaults: Mapping[str, object] | None = None) -> DataFrame:
    """CSV with header, columns matched by name in any order, all rows. ``_reason`` says why a row
    cannot be used: it has more or fewer values than the header, or one that does not fit its
    column's type; ``_corrupt_record`` is then its text, or the values as JSON.

    Values may hold line breaks. Files are split in either case; without ``multi_line`` every line is a
    row, which saves reading the quotes first.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    names = spark.read.csv(path, **options).columns
    if multi_line:
        rows = _parsed_rows(spark, path, names)
    else:
        text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RAW]])
        rows = spark.read.schema(text).option("columnPruning", False).option(
            "columnNameOfCorruptRecord", _RAW).csv(path, mode="PERMISSIVE", enforceSchema=False, **options)
    fields = [f for f in schema.fields if f.name in names]
    misfit = F.array_compact(F.array(*[
        F.when(blank_to_null(F.col(f"`{f.name}`")).isNotNull()
               & clean_value(F.col(f"`{f.name}`"), f.dataType).isNull(), F.lit(f.name)) for f in fields]))
    reason = F.when(F.col(_RAW).isNotNull(), "wrong number of values").when(
        F.size(misfit) > 0, F.concat(F.lit("no such value: "), F.array_join(misfit, ", ")))
    raw = F.coalesce(_RAW, F.to_json(F.struct(*[F.col(f"`{n}`") for n in names])))
    marked = rows.withColumn("_why", reason).withColumn("_raw", raw)
    cleaned = clean_columns(marked, T.StructType([
        *schema.fields, T.StructField("_why", T.StringType()), T.StructField("_raw", T.StringType())]), defaults)
    return cleaned.withColumnsRenamed({"_why": _REASON, "_raw": _RAW})


def _usable(scanned: DataFrame) -> DataFrame:
    return scanned.where(F.col(_REASON).isNull()).drop(_REASON, _RAW)


def _unusable(scanned: DataFrame) -> DataFrame:
    return scanned.where(F.col(_REASON).isNotNull()).select(F.col(_REASON).alias("reason"), F.col(_RAW).alias("row"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True,
             defaults: Mapping[str, object] | None = None) -> DataFrame:
    """The usable rows of ``scan_csv``."""
    return _usable(scan_csv(spark, path, schema, multi_line, defaults))


def csv_rejects(spark: SparkSession, path: str, schema: T.StructType,
                multi_line: bool = True) -> DataFrame:
    """``reason, row`` of the rows that ``read_csv`` leaves out."""
    return _unusable(scan_csv(spark, path, schema, multi_line))


# A published folder has all its versions below one folder, and a file that names the current one and, behind
# it, the earlier ones that are kept.
VERSIONS, CURRENT = "_versions", "_current"
KEPT_VERSIONS = 2


def current_folder(spark: SparkSession, folder: str) -> str:
    """Where the tables of a folder are: in its current version if it was published, else in itself."""
    if not path_exists(spark, f"{folder}/{CURRENT}"):
        return folder
    return f"{folder}/{VERSIONS}/{read_line(spark, f'{folder}/{CURRENT}').split()[0]}"


def check_unpublished(spark: SparkSession, folder: str) -> None:
    """Refuse to load into a published folder: readers would not see what is written there."""
    if path_exists(spark, f"{folder}/{CURRENT}"):
        raise ValueError(f"{folder} is published; load into another folder and publish that")


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return read_tables(spark, folder, [table])[table]


def read_tables(spark: SparkSession, folder: str,
                tables: Iterable[str] = tuple(TABLES)) -> dict[str, DataFrame]:
    """Tables of a folder, all of one version."""
    home = current_folder(spark, folder)
    return {t: spark.read.schema(table_schema(t)).parquet(f"{home}/{t}") for t in tables}


def publish_tables(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str,
                   kept: int = KEPT_VERSIONS) -> str:
    """Replace all tables below ``folder`` at once, and return the folder that holds them.

    They are written as a new version, which readers do not see until the last one is complete and the
    name of the current version is replaced. A job that fails before leaves the old tables as they are.
    Queries that have begun go on with the version they opened; the last ``kept`` versions stay.
    """
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    home = f"{folder}/{VERSIONS}/{version}"
    write_tables(tables, home)
    current = f"{folder}/{CURRENT}"
    earlier = read_line(spark, current).split() if path_exists(spark, current) else []
    names = [version, *earlier][:kept]
    replace_line(spark, current, " ".join(names))
    # What jobs that failed have left goes as well.
    remove_before(spark, f"{folder}/{VERSIONS}", version, set(names))
    return home


# Columns that single values are looked up by: their files get bloom filters.
LOOKUP_COLUMNS = {
    "person": ["full_name", "id"],
    "author": ["person_id", "publication_key"],
    "editor": ["person_id", "publication_key"],
    "publication": ["key"],
    "coauthor_graph": ["author1_id", "author2_id"],
    "components": ["id"],
}


def bloom_filters(name: str, df: DataFrame) -> dict[str, str]:
    """Parquet options for the lookup columns of a table."""
    return {f"parquet.bloom.filter.enabled#{c}": "true"
            for c in LOOKUP_COLUMNS.get(name, ()) if c in df.columns}


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """Replace each table below ``folder`` and return its number of rows, which is observed
    while writing."""
    counts = {}
    for name, df in tables.items():
        rows = Observation(f"rows of {name}")
        df.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").options(
            **bloom_filters(name, df)).parquet(f"{folder}/{name}")
        counts[name] = rows.get["rows"]
    return counts


def load_csv_tables(spark: SparkSession, csv_folder: str, folder: str,
                    tables: Iterable[str] = tuple(TABLES), strict: bool = False,
                    multi_line: bool = True) -> dict[str, int]:
    """Load the CSV files there are for known tables into Parquet tables; other files are not
    touched. Rows that cannot be used go to ``rejects_<table>``, and their number is returned
    under that name if there are any; with ``strict`` they fail the job before its table is
    replaced."""
    check_unpublished(spark, folder)
    paths = {t: f"{csv_folder}/{t}.csv" for t in tables}
    counts, scratch = {}, Scratch(spark, "load")
    for table, path in paths.items():
        if not path_exists(spark, path):
            continue
        # Rows and rejects come from one scan.
        scanned = scratch.table(scan_csv(spark, path, table_schema(table), multi_line, DEFAULTS.get(table)), table)
        rejects = write_tables({f"rejects_{table}": _unusable(scanned)}, folder)
        found = {name: n for name, n in rejects.items() if n}
        if strict and found:
            raise ValueError(f"{table}: {sum(found.values())} unusable rows, see {folder}/rejects_{table}")
        counts |= found | write_tables({table: _usable(scanned)}, folder)
        scratch.drop(table)
    return counts


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """``requested_name`` from a CSV list of authors with a ``full_name`` column."""
    return spark.read.csv(path, header=True, escape='"').select(
        F.col("full_name").alias("requested_name")).distinct()


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, rows`` of each table."""
    found = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows")
        found = row if found is None else found.unionByName(row)
    return found
