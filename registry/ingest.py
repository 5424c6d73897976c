"""XML scan, parsing, value mapping, shredding and surrogate keys on the rendered dump."""

from __future__ import annotations

from pyspark.sql import functions as F

from colophon.functions import markup, values
from colophon.operators import profile, shred
from colophon.operators.ordering import dense_ids
from colophon.schemas import RECORD_TAGS
from colophon.session import Scratch
from colophon.sources import tables as table_io
from colophon.sources.xml import parse_stats, rejected_records
from registry.common import (
    MENTIONS, PERSONS, REC, load, xml_chunks, xml_good, xml_parsed, xml_records,
    entries,
)

ENTRIES, entry = entries()


# --- scan ----------------------------------------------------------------------------------------
@entry("xml_records", f"""
with {REC}
select tag, key, 1 as records from rec
union all select 'person', 'homepages/' || c_custkey, 1 from customer where c_acctbal >= 3000
union all select 'data', 'd/' || c_custkey, 1 from customer
          where c_acctbal >= 1000 and c_acctbal < 2000
union all select 'article', 'bad/' || c_custkey, 1 from customer
          where c_acctbal >= 0 and c_acctbal < 1000
union all select 'www', null, count(*) from customer where c_acctbal < 0""")
def _(spark, sf):
    key = F.nullif(F.regexp_extract("xml", r'^<[^>]*?\bkey="([^"]*)"', 1), F.lit(""))
    return xml_records(spark, sf).groupBy("tag", key.alias("key")).agg(
        F.count(F.lit(1)).alias("records"))


@entry("xml_rejects", """
select 'www' as category, 'no key' as reason, c_name as name from customer where c_acctbal < 0
union all
select 'article', 'not well-formed', c_name from customer
where c_acctbal >= 0 and c_acctbal < 1000""")
def _(spark, sf):
    return rejected_records(xml_parsed(spark, sf)).select(
        "category", "reason",
        F.regexp_extract("xml", r"<author>(Customer#\d+)", 1).alias("name"))


@entry("xml_parse_stats", f"""
with {REC}, seen as (
  select tag as category, 1 as ok from rec
  union all select 'www', 0 from customer where c_acctbal < 0
  union all select 'article', 0 from customer where c_acctbal >= 0 and c_acctbal < 1000)
select category, count(*) as total, cast(sum(ok) as bigint) as parsed,
       count(*) - cast(sum(ok) as bigint) as failed
from seen group by category""")
def _(spark, sf):
    return parse_stats(xml_parsed(spark, sf))


@entry("entity_decode", f"""
with {REC} select key, 'Order ' || k || ' & ' || status || ' Müller.' as title from rec""")
def _(spark, sf):
    # Decoded before parsing, or the records would have been rejected.
    return xml_good(spark, sf).select(
        F.col("_key").alias("key"),
        markup.strip_markup(values.last_value(F.col("title"))).alias("title"))


@entry("xml_last_wins", f"""
with {REC} select key, 'Order <i>' || k || '</i> & <sub>' || status || '</sub> Müller.' as title,
  case when price > 300000 then 2 else 1 end as titles,
  case when tag = 'www' and status = 'P' then segment end as school
from rec""")
def _(spark, sf):
    return xml_good(spark, sf).select(
        F.col("_key").alias("key"), values.last_value(F.col("title")).alias("title"),
        F.size("title").alias("titles"), values.last_value(F.col("school")).alias("school"))


@entry("xml_child_attrs", f"""
with {REC}, {MENTIONS}
select role, publication_key, full_name, orcid, bibtex, aux, count(*) as n from mention
group by all""")
def _(spark, sf):
    mentions = shred.person_mentions(xml_good(spark, sf))
    return mentions.groupBy(*mentions.columns).agg(F.count(F.lit(1)).alias("n"))


@entry("ee_flags", f"""
with {REC} select key as publication_key, 'http://x.org/' || k || '?a=1&b=2' as url,
  status in ('F', 'O') as is_archive, status = 'O' as is_oa from rec""")
def _(spark, sf):
    return shred.child_rows(xml_good(spark, sf), "electronic_edition").drop("pos")


# --- profile -------------------------------------------------------------------------------------
@entry("record_tag_counts", f"""
with {REC}, seen as (
  select tag from rec
  union all select case when c_acctbal < 0 then 'www' when c_acctbal < 1000 then 'article'
                        when c_acctbal < 2000 then 'data' else 'person' end
  from customer where c_acctbal < 2000 or c_acctbal >= 3000)
select tag, count(*) as records from seen group by tag""")
def _(spark, sf):
    return profile.record_tag_counts(xml_records(spark, sf))


@entry("child_tag_counts", f"""
with {REC}, {MENTIONS}, child as (
  select tag, role as child from mention join rec on key = publication_key
  union all select tag, unnest(['title', 'pages', 'year', 'volume', 'number', 'month', 'ee'])
            from rec
  union all select tag, 'title' from rec where price > 300000
  union all select tag, unnest(['booktitle', 'crossref']) from rec where tag = 'inproceedings'
  union all select tag, 'journal' from rec where tag = 'article'
  union all select tag, unnest(['cite', 'cite', 'series']) from rec where tag = 'book'
  union all select tag, unnest(['note', 'sub']) from rec where tag = 'www'
  union all select tag, 'url' from rec where tag in ('article', 'www')
  union all select tag, unnest(['isbn', 'publisher']) from rec
            where tag in ('book', 'proceedings')
  union all select tag, unnest(['school', 'school']) from rec where tag = 'www' and status = 'P'
  union all select 'www', 'author' from customer where c_acctbal < 0
  union all select 'article', 'author' from customer where c_acctbal >= 0 and c_acctbal < 1000
  union all select 'data', 'title' from customer where c_acctbal >= 1000 and c_acctbal < 2000
  union all select 'person', 'author' from customer where c_acctbal >= 3000)
select tag, child, count(*) as occurrences from child group by tag, child""")
def _(spark, sf):
    return profile.child_tag_counts(xml_records(spark, sf))


@entry("invalid_tags", """
select 'thing' as tag, count(*) as occurrences from customer
where c_acctbal >= 2000 and c_acctbal < 3000 having count(*) > 0""")
def _(spark, sf):
    return profile.unexpected_elements(xml_chunks(spark, sf), tags=RECORD_TAGS)


@entry("distinct_attr_values", f"""
with {REC}
select distinct 'ee' as element, case status when 'F' then 'archive' else 'oa archive' end
  as value from rec where status in ('F', 'O')
union select 'note', case when status = 'P' then 'mystery' else 'affiliation' end from rec
  where tag = 'www'
union select 'url', 'deprecated' from rec where tag in ('article', 'www') and status = 'F'
union select 'isbn', 'print' from rec where tag in ('book', 'proceedings')""")
def _(spark, sf):
    return profile.distinct_attribute_values(
        xml_good(spark, sf), {e: "type" for e in ("note", "ee", "url", "isbn")})


@entry("markup_tag_counts", r"""
select tag, count(*) as occurrences
from (select unnest(regexp_extract_all(html, '<([A-Za-z][\w-]*)', 1)) as tag from pages)
group by tag""")
def _(spark, sf):
    return profile.tag_counts(load(spark, sf, "pages"), "html")


# --- values --------------------------------------------------------------------------------------
@entry("strip_markup", """
select page_id, regexp_replace(html, '<[^>]*>', '', 'g') as text from pages""")
def _(spark, sf):
    return load(spark, sf, "pages").select(
        "page_id", markup.strip_markup(F.col("html")).alias("text"))


@entry("strip_leftover_tags", r"""
select page_id, regexp_replace(html, '</?(?:a|li|div)\b[^>]*>', '', 'g') as html from pages""")
def _(spark, sf):
    return load(spark, sf, "pages").select(
        "page_id", markup.strip_element(F.col("html"), ["a", "li", "div"]).alias("html"))


@entry("safe_int_cast", f"""
with {REC} select key, case when price >= 20000 then cast(y as smallint) end as year,
  case when vol <= 32767 then cast(vol as smallint) end as volume,
  cast(null as smallint) as number from rec""")
def _(spark, sf):
    rows = xml_good(spark, sf)
    return rows.select(
        F.col("_key").alias("key"),
        *[values.safe_int(values.last_value(F.col(c))).alias(c)
          for c in ("year", "volume", "number")])


@entry("clean_csv_values", """
select o_orderkey as key, o_orderstatus as status,
  case when o_totalprice = floor(o_totalprice) then cast(o_totalprice as bigint) end as price,
  o_custkey as cust, '1.05' as text from orders""")
def _(spark, sf):
    orders = load(spark, sf, "orders")
    rows = orders.select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.concat(F.lit(" "), "o_orderstatus", F.lit("  ")).alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("cust"),
        F.lit("1.05").alias("text"))
    schema = table_io.T.StructType.fromDDL(
        "key long, status string, price long, cust long, text string")
    return table_io.clean_columns(rows, schema)


@entry("page_range", f"""
with {REC} select key, pages,
  case m % 4 when 3 then null else cust end as lo,
  case m % 4 when 0 then cust + 10 when 1 then cust + 9 when 2 then cust end as hi from rec""")
def _(spark, sf):
    rows = xml_good(spark, sf).select(
        F.col("_key").alias("key"), values.last_value(F.col("pages")).alias("pages"))
    return rows.withColumn("r", values.page_range(F.col("pages"))).select(
        "key", "pages", "r.lo", "r.hi")


@entry("month_number", f"""
with {REC} select key, case status when 'P' then null else m end as month_num from rec""")
def _(spark, sf):
    return xml_good(spark, sf).select(
        F.col("_key").alias("key"),
        values.month_number(values.last_value(F.col("month"))).alias("month_num"))


@entry("positional_attach", """
select o_orderkey, c_name from
  (select o_orderkey, row_number() over (order by o_totalprice, o_orderkey) as r from orders) a
  full join (select c_name, row_number() over (order by c_acctbal, c_custkey) as r from customer) b
  on a.r = b.r""")
def _(spark, sf):
    left = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    right = load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return shred.attach_by_position(
        left, right, ["o_totalprice", "o_orderkey"], ["c_acctbal", "c_custkey"]
    ).select("o_orderkey", "c_name")


# --- surrogate keys and tables -------------------------------------------------------------------
@entry("dense_ids", """
select row_number() over (order by p_type, p_partkey) - 1 as id, p_type, p_partkey from part""")
def _(spark, sf):
    return dense_ids(load(spark, sf, "part").select("p_type", "p_partkey"),
                     ["p_type", "p_partkey"])


@entry("person_dictionary", f"""
with {REC}, {MENTIONS}, {PERSONS} select id, full_name, orcid from people""")
def _(spark, sf):
    return shred.person_dictionary(shred.person_mentions(xml_good(spark, sf)))


def _contributions(spark, sf, role):
    mentions = Scratch(spark, "mentions").table(
        shred.person_mentions(xml_good(spark, sf)), "mentions")
    people = Scratch(spark, "person").table(shred.person_dictionary(mentions), "person")
    return shred.contributions(mentions, people, role)


@entry("shred_author", f"""
with {REC}, {MENTIONS}, {PERSONS}
select distinct id as person_id, publication_key, bibtex, aux
from mention join people on mention.full_name = people.full_name
  and mention.orcid is not distinct from people.orcid
where role = 'author'""")
def _(spark, sf):
    return _contributions(spark, sf, "author")


@entry("shred_editor", f"""
with {REC}, {MENTIONS}, {PERSONS}
select distinct id as person_id, publication_key
from mention join people on mention.full_name = people.full_name
  and mention.orcid is not distinct from people.orcid
where role = 'editor'""")
def _(spark, sf):
    return _contributions(spark, sf, "editor")


@entry("name_dictionary", f"""
with {REC}, named as (
  select 'publisher' as dictionary, nation as name,
         arg_min('h/' || key, row(-price, k)) as href from rec  -- the first one in the dump
  where tag in ('book', 'proceedings') group by nation
  union all
  select 'series', segment || ' notes', min('s/' || segment) from rec where tag = 'book'
  group by segment
  union all
  select distinct 'school', unnest(['Old', segment]), null from rec
  where tag = 'www' and status = 'P')
select dictionary, row_number() over (partition by dictionary order by name) - 1 as id, name, href
from (select distinct * from named)""")
def _(spark, sf):
    rows = xml_good(spark, sf)
    found = None
    for table in shred.DICTIONARIES:
        part = shred.dictionary_table(rows, table)
        if "href" not in part.columns:
            part = part.withColumn("href", F.lit(None).cast("string"))
        part = part.select(F.lit(table).alias("dictionary"), "id", "name", "href")
        found = part if found is None else found.unionByName(part)
    return found


_DICTIONARIES = """
  publishers as (select name, row_number() over (order by name) - 1 as id from
    (select distinct nation as name from rec where tag in ('book', 'proceedings'))),
  seriess as (select name, row_number() over (order by name) - 1 as id from
    (select distinct segment || ' notes' as name from rec where tag = 'book')),
  schools as (select name, row_number() over (order by name) - 1 as id from
    (select distinct unnest(['Old', segment]) as name from rec
     where tag = 'www' and status = 'P'))"""
_FK = """
  left join publishers p on p.name = nation and tag in ('book', 'proceedings')
  left join seriess s on s.name = segment || ' notes' and tag = 'book'
  left join schools c on c.name = segment and tag = 'www' and status = 'P'"""


def _publication(spark, sf):
    rows = xml_good(spark, sf)
    return shred.publication_table(
        rows, {t: shred.dictionary_table(rows, t) for t in shred.DICTIONARIES})


@entry("publication_fk", f"""
with {REC}, {_DICTIONARIES}
select rec.key, p.id as publisher_id, s.id as series_id, c.id as school_id from rec {_FK}""")
def _(spark, sf):
    return _publication(spark, sf).select("key", "publisher_id", "series_id", "school_id")


@entry("publication_project", f"""
with {REC}, {_DICTIONARIES}
select rec.key, tag as category,
  'Order <i>' || k || '</i> & <sub>' || status || '</sub> Müller.' as title,
  case when price >= 20000 then cast(y as smallint) end as year,
  case when tag = 'inproceedings' then 'Proc ' || segment end as booktitle, pages,
  cast(null as varchar) as address, case when tag = 'article' then segment end as journal,
  case when vol <= 32767 then cast(vol as smallint) end as volume, cust || 'a' as number,
  case status when 'F' then cast(m as varchar) when 'O' then lower(monthname(mdate))
              else 'summer' end as month,
  case status when 'P' then null else m end as month_num,
  cast(null as varchar) as cdrom, cast(null as smallint) as chapter,
  cast(null as smallint) as publnr, cast(null as date) as cdate, mdate,
  case when status = 'P' then 'informal' end as type,
  case when tag = 'article' then 'T' || k || ' Müller & Co.' end as title_bibtex,
  cast(null as varchar) as reviewid, cast(null as varchar) as rating,
  p.id as publisher_id, s.id as series_id, c.id as school_id
from rec {_FK}""")
def _(spark, sf):
    return _publication(spark, sf)


_CHILDREN = """child as (
  select 'electronic_edition' as table_name, key, 0 as pos, 'http://x.org/' || k || '?a=1&b=2'
    as text, cast(null as varchar) as type, cast(null as varchar) as label,
    status in ('F', 'O') as is_archive, status = 'O' as is_oa from rec
  union all select 'crossref', key, 0, 'conf/' || cust, null, null, null, null from rec
    where tag = 'inproceedings'
  union all select 'cite', key, 0, 'c/' || cust, null, 'L' || status, null, null from rec
    where tag = 'book'
  union all select 'cite', key, 1, '...', null, null, null, null from rec where tag = 'book'
  union all select 'note', key, 0, nation, case when status = 'P' then 'mystery'
    else 'affiliation' end, status, null, null from rec where tag = 'www'
  union all select 'url', key, 0, 'db/' || k, case when status = 'F' then 'deprecated' end,
    null, null, null from rec where tag in ('article', 'www')
  union all select 'isbn', key, 0, '978-' || lpad(cast(k as varchar), 10, '0'), 'print', null,
    null, null from rec where tag in ('book', 'proceedings'))"""


@entry("shred_generic", f"""
with {REC}, {_CHILDREN}
select table_name, row_number() over (partition by table_name order by key, pos) - 1 as id,
  key as publication_key, text, type, label, is_archive, is_oa from child""")
def _(spark, sf):
    rows, found = xml_good(spark, sf), None
    for table, (_, text, _attributes) in shred.CHILD_TABLES.items():
        part = shred.child_table(rows, table)
        have = set(part.columns)

        def column(name, kind):
            return (F.col(name) if name in have else F.lit(None).cast(kind)).alias(name)

        part = part.select(
            F.lit(table).alias("table_name"), "id", "publication_key", F.col(text).alias("text"),
            column("type", "string"), column("label", "string"), column("is_archive", "boolean"),
            column("is_oa", "boolean"))
        found = part if found is None else found.unionByName(part)
    return found


# --- tables as files -----------------------------------------------------------------------------
def _person_csv(spark, sf):
    """Suppliers as a CSV file: names with quotes, commas and line breaks, some ids no numbers."""
    key = F.col("s_suppkey").cast("string")
    people = load(spark, sf, "supplier").select(
        F.when(F.col("s_acctbal") < -500, F.concat(F.lit("no. "), key)).otherwise(key).alias("id"),
        F.concat("s_name", F.lit(' "x",\ny')).alias("full_name"),
        F.when(F.col("s_acctbal") > 0, F.concat(F.lit("0000-"), key)).alias("orcid"))
    folder = Scratch(spark, "csv").path + "/person.csv"
    table_io.write_csv(people, folder)
    return folder


@entry("csv_roundtrip", """
select s_suppkey as id, s_name || ' "x",' || chr(10) || 'y' as full_name,
  case when s_acctbal > 0 then '0000-' || s_suppkey end as orcid
from supplier where s_acctbal >= -500""")
def _(spark, sf):
    return table_io.read_csv(spark, _person_csv(spark, sf), table_io.table_schema("person"))


@entry("csv_rejects", """
select 'no such value: id' as reason, count(*) as rows from supplier where s_acctbal < -500
group by 1""")
def _(spark, sf):
    rejects = table_io.csv_rejects(spark, _person_csv(spark, sf), table_io.table_schema("person"))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@entry("integer_rejects", f"""
with {REC}
select key, 'year' as element, 'xx' as value from rec where price < 20000
union all select key, 'volume', cast(vol as varchar) from rec where vol > 32767""")
def _(spark, sf):
    return shred.integer_rejects(xml_good(spark, sf))
