"""Driver tables in the roles of the bibliography, and an XML dump rendered from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from colophon.operators.skew import distinct_in_tasks
from colophon.session import Scratch
from colophon.sources.xml import good_records, parse_records, scan_chunks, records_of


def entries():
    """A registry of queries with their SQL, and the decorator that adds to it."""
    found = {}

    def entry(name, sql=None):
        def add(query):
            found[name] = (query, sql)
            return query
        return add

    return found, entry


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def person(spark, sf_dir) -> DataFrame:
    """Suppliers as persons; names are unique."""
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("full_name"))


def author(spark, sf_dir) -> DataFrame:
    """Suppliers as authors of orders."""
    rows = load(spark, sf_dir, "lineitem")
    return distinct_in_tasks(rows.select(
        F.col("l_suppkey").alias("person_id"), F.col("l_orderkey").alias("publication_key")), rows.count())


def part_person(spark, sf_dir) -> DataFrame:
    """Parts as persons; many share a name."""
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("full_name"))


def part_author(spark, sf_dir) -> DataFrame:
    """Parts as authors of orders."""
    rows = load(spark, sf_dir, "lineitem")
    return distinct_in_tasks(rows.select(
        F.col("l_partkey").alias("person_id"), F.col("l_orderkey").alias("publication_key")), rows.count())


def publication(spark, sf_dir) -> DataFrame:
    """Orders as publications."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("booktitle"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("journal"),
        F.col("o_custkey").cast("string").alias("pages"),
        F.year("o_orderdate").alias("year"))


def editor(spark, sf_dir) -> DataFrame:
    """Customers as editors of orders."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("publication_key"))


# The same roles as common table expressions for the SQL side.
PERSON = "person as (select s_suppkey as id, s_name as full_name from supplier)"
AUTHOR = ("author as (select distinct l_suppkey as person_id, l_orderkey as publication_key "
          "from lineitem)")
PART_PERSON = "person as (select p_partkey as id, p_name as full_name from part)"
PART_AUTHOR = ("author as (select distinct l_partkey as person_id, l_orderkey as publication_key "
               "from lineitem)")
PUBLICATION = """publication as (
  select o_orderkey as key, o_orderpriority as title, o_orderstatus as booktitle,
         'C' || o_custkey as journal, cast(o_custkey as varchar) as pages,
         year(o_orderdate) as year
  from orders)"""
EDITOR = "editor as (select o_custkey as person_id, o_orderkey as publication_key from orders)"

# --- XML dump ----------------------------------------------------------------------------------
# One record per order. This query runs on both sides; the dump renders its rows as XML, the
# checks compute from them what parsing and shredding must give.
FIELDS = """
  select o_orderkey as k, o_orderstatus as status,
         concat(lower(o_orderstatus), '/', cast(o_orderkey as string)) as key,
         case o_orderpriority when '1-URGENT' then 'article' when '2-HIGH' then 'inproceedings'
              when '3-MEDIUM' then 'proceedings' when '4-NOT SPECIFIED' then 'book'
              else 'www' end as tag,
         cast(o_orderdate as date) as mdate, year(o_orderdate) as y, month(o_orderdate) as m,
         o_totalprice as price, cast(floor(o_totalprice / 10) as bigint) as vol,
         c_custkey as cust, c_name, c_mktsegment as segment, n_name as nation,
         case when c_acctbal > 5000
              then concat('0000-0001-', lpad(cast(c_custkey as string), 8, '0')) end as orcid,
         case when month(o_orderdate) % 4 = 0
              then concat(cast(c_custkey as string), '-', cast(c_custkey + 10 as string))
              when month(o_orderdate) % 4 = 1
              then concat(cast(c_custkey + 9 as string), '-', cast(c_custkey as string))
              when month(o_orderdate) % 4 = 2 then cast(c_custkey as string)
              else '1:1-1:20' end as pages
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""
REC = f"rec as ({FIELDS})"

# Authors and editors as the dump holds them, before duplicates are removed.
MENTIONS = """mention as (
  select 'author' as role, key as publication_key, c_name as full_name, orcid,
         cast(null as varchar) as bibtex, cast(null as varchar) as aux
  from rec where tag <> 'proceedings'
  union all
  select 'author', key, nation, null, null, null from rec
  where tag <> 'proceedings' and status in ('O', 'P')
  union all
  select 'author', key, segment, null, 'B' || segment, 'x' from rec
  where tag <> 'proceedings' and status = 'P'
  union all
  select 'author', key, c_name, orcid, null, null from rec
  where tag <> 'proceedings' and price > 400000
  union all
  select 'editor', key, c_name, orcid, null, null from rec where tag = 'proceedings'
  union all
  select 'editor', key, nation, null, null, null from rec where tag = 'proceedings')"""
PERSONS = """people as (
  select row_number() over (order by full_name, orcid nulls first) - 1 as id, full_name, orcid
  from (select distinct full_name, orcid from mention))"""

_ORDER_XML = r"""
  concat('<', tag, ' mdate="', date_format(mdate, 'yyyy-MM-dd'), '" key="', key, '"',
    if(status = 'P', ' publtype="informal"', ''), '>\n',
    if(tag <> 'proceedings', concat(
      '<author', coalesce(concat(' orcid="', orcid, '"'), if(status = 'O', ' orcid=""', '')), '>',
      c_name, '</author>\n',
      if(status in ('O', 'P'), concat('<author>', nation, '</author>\n'), ''),
      if(status = 'P', concat('<author bibtex="B', segment, '" aux="x">', segment,
                              '</author>\n'), ''),
      if(price > 400000, concat('<author', coalesce(concat(' orcid="', orcid, '"'), ''), '>',
                                c_name, '</author>\n'), '')), ''),
    if(tag = 'proceedings', concat(
      '<editor', coalesce(concat(' orcid="', orcid, '"'), ''), '>', c_name, '</editor>',
      '<editor>', nation, '</editor>\n'), ''),
    if(price > 300000, '<title>Draft</title>\n', ''),
    '<title', if(tag = 'article', concat(' bibtex="T', k, ' M&uuml;ller &amp; Co&#46;"'), ''), '>Order <i>', k,
    '</i> &amp; <sub>', status, '</sub> M&uuml;ller.</title>\n',
    '<pages>', pages, '</pages>\n',
    '<year>', if(price < 20000, 'xx', cast(y as string)), '</year>\n',
    '<volume>', vol, '</volume><number>', cust, 'a</number>\n',
    '<month>', case status when 'F' then cast(m as string)
                           when 'O' then date_format(mdate, 'MMMM') else 'Summer' end,
    '</month>\n',
    if(tag = 'inproceedings', concat('<booktitle>Proc ', segment, '</booktitle>\n',
                                     '<crossref>conf/', cust, '</crossref>\n'), ''),
    if(tag = 'article', concat('<journal>', segment, '</journal>\n'), ''),
    '<ee', case status when 'F' then ' type="archive"' when 'O' then ' type="oa archive"'
                       else '' end, '>http://x.org/', k, '?a=1&amp;b=2</ee>\n',
    if(tag = 'book', concat('<cite label="L', status, '">c/', cust, '</cite>\n',
                            '<cite>...</cite>\n',
                            '<series href="s/', segment, '">', segment, ' notes</series>\n'), ''),
    if(tag = 'www', concat('<note type="', if(status = 'P', 'mystery', 'affiliation'),
                           '" label="', status, '">', nation, '</note>\n',
                           '<sub>home <url>nested</url><br/></sub>\n'), ''),
    if(tag in ('article', 'www'), concat('<url', if(status = 'F', ' type="deprecated"', ''),
                                         '>db/', k, '</url>\n'), ''),
    if(tag in ('book', 'proceedings'), concat(
      '<isbn type="print">978-', lpad(cast(k as string), 10, '0'), '</isbn>\n',
      '<publisher href="h/', key, '">', nation, '</publisher>\n'), ''),
    if(tag = 'www' and status = 'P', concat('<school>Old</school><school>', segment,
                                            '</school>\n'), ''),
    '</', tag, '>') as value"""
# What no scan may take for records: in front of some orders, inside one comment of several lines.
_HIDDEN_XML = r"""
  if(price > 350000, concat('<!-- was\n<article key="was/', k, '"><author>', c_name, '</author>\n</article>',
     '<![CDATA[ -->\n'), '')"""

# Customers give what a loader has to leave out.
_OTHER_XML = r"""
  case when c_acctbal < 0
       then concat('<www mdate="2020-01-01"><author>', c_name, '</author></www>')
       when c_acctbal < 1000
       then concat('<article key="bad/', c_custkey, '"><author>', c_name,
                   '&undefined;</author></article>')
       when c_acctbal < 2000
       then concat('<data key="d/', c_custkey, '"><title>', c_name, '</title></data>')
       when c_acctbal < 3000
       then concat('<thing id="', c_custkey, '"><part>', c_name, ' <![CDATA[<book key="in/', c_custkey,
                   '"/>\n<!-- </thing>]]></part></thing>')
       else concat('<person key="homepages/', c_custkey, '"><author>', c_name,
                   '</author></person>') end as value"""

_staged: dict[tuple[str, str, str], object] = {}


def _once(spark, sf_dir, what, make):
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _staged:
        _staged[key] = make()
    return _staged[key]


def xml_dump(spark, sf_dir) -> str:
    """Folder with the dump as text files; written once per session."""
    def write():
        tables = {t: load(spark, sf_dir, t) for t in ("orders", "customer", "nation")}
        fields = spark.sql(
            FIELDS.replace("from orders join customer", "from {orders} join {customer}")
                  .replace("join nation", "join {nation}"), **tables)
        # Dear orders come first, so the order of the dump is not that of keys.
        orders = fields.orderBy(F.desc("price"), "k").select(F.concat(
            F.expr(_HIDDEN_XML), F.expr(_ORDER_XML.replace("as value", ""))).alias("value"))
        others = tables["customer"].selectExpr(_OTHER_XML)
        folder = Scratch(spark, "dump").path + "/xml"
        orders.unionAll(others).write.text(folder)
        return folder

    return _once(spark, sf_dir, "dump", write)


def xml_chunks(spark, sf_dir) -> DataFrame:
    """The cut dump. It is not written, as the copy's few compressed splits would be few long tasks."""
    return _once(spark, sf_dir, "chunks", lambda: scan_chunks(spark, xml_dump(spark, sf_dir)))


def xml_records(spark, sf_dir) -> DataFrame:
    """``tag, xml`` of all records of the dump."""
    return records_of(xml_chunks(spark, sf_dir))


def xml_parsed(spark, sf_dir) -> DataFrame:
    """Parsed publication records, written once per session like a job's staging table."""
    return _once(spark, sf_dir, "parsed", lambda: Scratch(spark, "parsed").table(
        parse_records(xml_records(spark, sf_dir)), "records"))


def xml_good(spark, sf_dir) -> DataFrame:
    return good_records(xml_parsed(spark, sf_dir))
