"""Constraint checks, table counts and de-duplication on the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from colophon.operators import checks, profile
from colophon.session import Scratch
from colophon.sources import tables as table_io
from registry.common import entries, load

ENTRIES, entry = entries()
NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _tables(spark, sf):
    return {t: load(spark, sf, t) for t in NAMES}


def _union(parts):
    return reduce(DataFrame.unionByName, parts)


# Rules on the driver tables; some are broken on purpose.
KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
    "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
}
UNIQUE = [("part", ["p_name"], None), ("part", ["p_brand", "p_type"], "p_size > 45"),
          ("supplier", ["s_name"], None), ("customer", ["c_name"], None)]
FOREIGN = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("orders", "o_orderkey", "lineitem", "l_orderkey"),
]
DOMAINS = {
    ("orders", "o_orderstatus"): ["F", "O"],
    ("part", "p_type"): ["STANDARD", "SMALL", "MEDIUM", "ECONOMY", "PROMO", "LARGE"],
    ("customer", "c_mktsegment"): ["MACHINERY", "BUILDING", "AUTOMOBILE"],
}
REQUIRED = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"], "orders": ["o_orderkey", "o_custkey"],
    "part": ["p_partkey", "p_name"],
}
WIDTHS = {("part", "p_name"): 10, ("customer", "c_name"): 18, ("supplier", "s_name"): 10}


def _sql_list(values):
    return ", ".join(f"'{v}'" for v in values)


def _key_sql(table, key, covered=None):
    where = f" where {covered}" if covered else ""
    return (f"select {', '.join(key)}, count(*) as n from {table}{where} "
            f"group by {', '.join(key)} having count(*) > 1")


@entry("domain_violations", " union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, {c} as value, count(*) as rows "
    f"from {t} where {c} not in ({_sql_list(d)}) group by {c}" for (t, c), d in DOMAINS.items()))
def _(spark, sf):
    return checks.domain_violations(_tables(spark, sf), DOMAINS)


@entry("values_outside", """
select o_orderpriority as value, count(*) as rows from orders
where o_orderpriority not in ('1-URGENT', '2-HIGH') group by 1""")
def _(spark, sf):
    return profile.values_outside(
        load(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


def _with_nulls(spark, sf):
    """Orders left joined to lineitem: 'author' columns are null for orders without lines."""
    tables = _tables(spark, sf)
    joined = tables["orders"].join(
        tables["lineitem"], F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return {"joined": joined, **{t: tables[t] for t in REQUIRED}}


@entry("null_violations", """
with joined as (select * from orders left join lineitem on o_orderkey = l_orderkey)
""" + " union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, count(*) filter ({c} is null) as nulls "
    f"from {t}"
    for t, cs in {"joined": ["o_orderkey", "l_partkey"], **REQUIRED}.items() for c in cs))
def _(spark, sf):
    return checks.null_violations(
        _with_nulls(spark, sf), {"joined": ["o_orderkey", "l_partkey"], **REQUIRED})


@entry("pk_violations", " union all ".join(
    f"select '{t}' as table_name, cast({' || chr(44) || '.join(k)} as varchar) as key, "
    f"n as rows from ({_key_sql(t, k)})" for t, k in KEYS.items()))
def _(spark, sf):
    tables = _tables(spark, sf)
    return _union(
        checks.key_violations(tables[t], k).select(
            F.lit(t).alias("table_name"), F.concat_ws(",", *k).alias("key"), "rows")
        for t, k in KEYS.items())


@entry("unique_violations", " union all ".join(
    f"select '{t}' as table_name, {' || chr(44) || '.join(c)} as value, n as rows "
    f"from ({_key_sql(t, c, w)})" for t, c, w in UNIQUE))
def _(spark, sf):
    tables = _tables(spark, sf)
    return _union(
        checks.unique_violations(tables[t], c, w).select(
            F.lit(t).alias("table_name"), F.concat_ws(",", *c).alias("value"), "rows")
        for t, c, w in UNIQUE)


@entry("fk_orphans", " union all ".join(
    f"select '{c}.{fk}' as reference, {fk} as value, count(*) as rows from {c} "
    f"where {fk} is not null and not exists (select 1 from {p} where {p}.{k} = {c}.{fk}) "
    f"group by {fk}" for c, fk, p, k in FOREIGN))
def _(spark, sf):
    tables = _tables(spark, sf)
    return _union(
        checks.orphans(tables[c], fk, tables[p], k).select(
            F.lit(f"{c}.{fk}").alias("reference"), F.col("value").cast("long").alias("value"),
            "rows")
        for c, fk, p, k in FOREIGN)


@entry("width_violations", " union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, {w} as width, "
    f"count(*) filter (length({c}) > {w}) as too_long, "
    f"cast(max(length({c})) as int) as longest from {t}"
    for (t, c), w in WIDTHS.items()))
def _(spark, sf):
    return checks.width_violations(_tables(spark, sf), WIDTHS)


def _report_sql():
    parts = [f"select 'primary key' as kind, '{t}({', '.join(k)})' as rule, "
             f"count(*) as violations from ({_key_sql(t, k)})" for t, k in KEYS.items()]
    parts += [f"select 'unique', '{t}({', '.join(c)})" + (f" where {w}" if w else "")
              + f"', count(*) from ({_key_sql(t, c, w)})" for t, c, w in UNIQUE]
    parts += [f"select 'foreign key', '{c}.{fk} -> {p}.{k}', count(distinct {fk}) from {c} "
              f"where not exists (select 1 from {p} where {p}.{k} = {c}.{fk})"
              for c, fk, p, k in FOREIGN]
    parts += [f"select 'not null', '{t}.{c}', count(*) filter ({c} is null) from {t}"
              for t, cs in REQUIRED.items() for c in cs]
    parts += [f"select 'width', '{t}.{c}', count(*) filter (length({c}) > {w}) from {t}"
              for (t, c), w in WIDTHS.items()]
    parts += [f"select 'domain', '{t}.{c}', count(distinct {c}) from {t} "
              f"where {c} not in ({_sql_list(d)})" for (t, c), d in DOMAINS.items()]
    return " union all ".join(parts)


@entry("integrity_report", _report_sql())
def _(spark, sf):
    return checks.integrity_report(
        _tables(spark, sf), KEYS, REQUIRED, UNIQUE, FOREIGN, DOMAINS, WIDTHS)


@entry("table_counts", " union all ".join(
    f"select '{t}' as table_name, count(*) as rows from {t}" for t in NAMES))
def _(spark, sf):
    # A full reload: every table is replaced, its rows are observed on the way and read again.
    folder = Scratch(spark, "reload").path
    tables = _tables(spark, sf)
    table_io.write_tables(tables, folder)
    return table_io.table_counts(
        {t: spark.read.schema(df.schema).parquet(f"{folder}/{t}") for t, df in tables.items()})


@entry("distinct_rows", """
select distinct * from (select * from lineitem union all select * from lineitem)""")
def _(spark, sf):
    lines = load(spark, sf, "lineitem")
    return lines.unionAll(lines).dropDuplicates()
