"""Inputs that the driver's tables lack."""

import pytest
from pyspark.sql import functions as F

from colophon import __main__ as command_line
from colophon.functions import markup
from colophon.operators import authors, checks, coauthor, components, profile, shred, skew
from colophon.plans import graph as graph_plans, ingest
from colophon.session import Scratch, close_scratch, path_exists, shared_folder
from colophon.sources import graphfiles, tables as table_io, xml


def test_blank_orcid_is_none(spark):
    mentions = spark.createDataFrame(
        [("author", "k1", "A B", ""), ("author", "k2", "A B", None), ("author", "k3", "A B", " ")],
        "role string, publication_key string, full_name string, orcid string")
    records = spark.createDataFrame([("k1", [("A B", "")]), ("k2", [("A B", None)])],
                                    "_key string, author array<struct<_VALUE:string,_orcid:string>>")
    rows = shred.children(records, "author")
    assert rows.count() == 2
    cleaned = mentions.withColumn("orcid", shred.blank_to_null(F.col("orcid"))).withColumns(
        {"bibtex": F.lit(None).cast("string"), "aux": F.lit(None).cast("string")})
    people = shred.person_dictionary(cleaned)
    assert people.count() == 1
    assert shred.contributions(cleaned, people, "author").count() == 3


def test_attributes_are_decoded(spark):
    text = "<title bibtex='M&uuml;ller &amp; Co &#x41;&#66;&#128512; &quot;x&quot; &amp;lt;'>t</title>"
    got = spark.createDataFrame([(text,)], "x string").select(markup.predefined_entities(
        markup.attribute(markup.decode_entities(F.col("x")), "title", "bibtex"))).first()[0]
    assert got == 'Müller & Co AB😀 "x" &lt;'


def test_merge_ignores_the_order_of_sums(spark):
    columns = "author1_id long, author2_id long, pair_count long, pair_weight double"
    old = spark.createDataFrame([(1, 2, 2, 0.1 + 0.2)], columns)
    new = spark.createDataFrame([(1, 2, 2, 0.3), (1, 3, 1, 0.5)], columns)
    assert coauthor.merge_edges(old, new).count() == 2


def test_counts_are_those_of_the_files(spark, tmp_path):
    tables = {"person": spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id long, full_name string"),
              "author": spark.createDataFrame([(1, "k"), (1, "k")], "person_id long, publication_key string")}
    announced = {r.kind: r.n for r in graphfiles.graph_counts(tables).collect()}
    written = {r.kind: r.n for r in graphfiles.export_graph(spark, tables, str(tmp_path)).collect()}
    assert announced == written == {"nodes": 2, "relationships": 1}


def test_headers_follow_the_schema():
    schema = table_io.table_schema("publication")
    found = graphfiles.headers("publication", schema)
    assert found[0] == "key:ID(publication-ID)" and "title" in found
    assert {"school_id:long", "year:short", "mdate:date"} <= set(found)
    assert graphfiles.headers("author", table_io.table_schema("author"))[:2] == [
        ":START_ID(person-ID)", ":END_ID(publication-ID)"]


PERSON = "id long, full_name string, orcid string"


def test_csv_with_line_breaks_and_bad_rows(spark, tmp_path):
    path = str(tmp_path / "person.csv")
    with open(path, "w") as file:
        file.write('id,full_name,orcid\n1,"line one\nline two",\nx2,"no number",\n3,"too few"\n4,a,b,c\n5,"q ""x"", y",z\n')
    schema = table_io.table_schema("person")
    good = {r.id: r.full_name for r in table_io.read_csv(spark, path, schema).collect()}
    assert good == {1: "line one\nline two", 5: 'q "x", y'}
    reasons = sorted(r.reason for r in table_io.csv_rejects(spark, path, schema).collect())
    assert reasons == ["no such value: id", "wrong number of values", "wrong number of values"]
    counts = table_io.load_csv_tables(spark, str(tmp_path), str(tmp_path / "out"))
    assert counts == {"person": 2, "rejects_person": 3}
    with pytest.raises(ValueError):
        table_io.load_csv_tables(spark, str(tmp_path), str(tmp_path / "strict"), strict=True)
    assert not path_exists(spark, str(tmp_path / "strict" / "person"))


def test_column_defaults(spark, tmp_path):
    (tmp_path / "electronic_edition.csv").write_text(
        "id,publication_key,url,is_archive,is_oa\n0,k,http://x,,true\n1,k,http://y,true,\n")
    table_io.load_csv_tables(spark, str(tmp_path), str(tmp_path / "out"))
    rows = table_io.read_table(spark, str(tmp_path / "out"), "electronic_edition").collect()
    assert sorted((r.is_archive, r.is_oa) for r in rows) == [(False, True), (True, False)]


def test_positions_of_unequal_files(spark):
    left, right = spark.range(5).select(F.col("id").alias("a")), spark.range(3).select(F.col("id").alias("b"))
    got = shred.attach_by_position(left, right, ["a"], ["b"]).collect()
    assert sorted((r.a, -1 if r.b is None else r.b) for r in got) == [(0, 0), (1, 1), (2, 2), (3, -1), (4, -1)]


def scanned(spark, tmp_path, text):
    (tmp_path / "dump.xml").write_text(text)
    return xml.scan_chunks(spark, str(tmp_path / "dump.xml"))


def test_comments_and_character_data_are_no_records(spark, tmp_path):
    chunks = scanned(spark, tmp_path, """<?xml version="1.0"?>
<dblp>
<!-- <article key="z"> -->
<article key="a"><title>x <![CDATA[<book key="n"> & co]]></title></article>
<!-- several
lines <book key="y"/> -->
<book key="b"><title>y</title></book>
</dblp>
""")
    records = xml.records_of(chunks)
    assert sorted((r.tag) for r in records.collect()) == ["article", "book"]
    assert profile.unexpected_elements(chunks).count() == 0
    titles = [r.title for r in xml.parse_records(records).collect()]
    assert len(titles) == 2


def test_root_and_holders_of_records(spark, tmp_path):
    chunks = scanned(spark, tmp_path, "<?xml version='1.0'?>\n<dblp>\n<thing/>\n<odd><part/></odd>\n</dblp>\n")
    assert {r.tag: r.occurrences for r in profile.unexpected_elements(chunks).collect()} == {"thing": 1, "odd": 1}
    chunks = scanned(spark, tmp_path, "<dblp>\n<article key='a'/>\n<wrapper>\n<data key='d'/>\n</wrapper>\n</dblp>\n")
    assert {r.tag: r.occurrences for r in profile.unexpected_elements(chunks).collect()} == {"wrapper": 1}


def test_a_file_without_records_is_not_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(xml, "LONGEST_CHUNK", 5_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        chunks = scanned(spark, tmp_path, "".join(f"<line>{i:050d}</line>\n" for i in range(400)))
        lengths = [len(r.body) for r in chunks.collect()]
        assert max(lengths) < 5_000 and sum(lengths) == 400 * 64
        few = "<article key='a'>" + "<note>x</note>\n" * 300 + "</article>\n<book key='b'/>\n"
        got = xml.records_of(scanned(spark, tmp_path, few)).collect()
        assert sorted((r.tag, len(r.xml)) for r in got) == [("article", 17 + 300 * 15 + 10), ("book", 15)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_integer_rejects(spark):
    records = spark.createDataFrame(
        [("k", ["19xx"], ["1", "99999"], [], None), ("m", ["1999"], [], [], [""])],
        "_key string, year array<string>, volume array<string>, chapter array<string>, publnr array<string>")
    got = sorted((r.key, r.element, r.value) for r in shred.integer_rejects(records).collect())
    assert got == [("k", "volume", "99999"), ("k", "year", "19xx")]


def hot_rows(spark):
    """Half of the rows on one key, a tenth on null, a tenth on a key that the lookup lacks."""
    return spark.range(20_000).select(
        F.when(F.col("id") % 10 < 5, 7).when(F.col("id") % 10 == 5, None).when(F.col("id") % 10 == 6, 999_999)
        .otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))


def test_hot_keys_stay_out_of_the_shuffle(spark, shuffles_only):
    scratch = Scratch(spark, "hot")
    fact = scratch.table(hot_rows(spark), "fact")
    lookup = scratch.table(spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")), "lookup")
    joined = skew.lookup_join(fact, lookup, "k", hot_share=0.01)
    assert joined.count() == 20_000
    assert joined.where("k = 7 and w = 14").count() == 10_001
    assert joined.where("w is null").count() == 4_000
    # The second part of the union is what is shuffled: neither hot, nor null, nor missing hot keys.
    keys = joined.where("k is not null").groupBy("k").count().where("count > 100").count()
    assert keys == 2
    seen = joined.select("k", F.spark_partition_id().alias("p")).where("k = 7 or k is null or k = 999999")
    shuffled = joined.select("k", F.spark_partition_id().alias("p")).where("k % 10 > 6 and k <> 7 and k <> 999999")
    assert not {r.p for r in seen.distinct().collect() if r.p} & {r.p for r in shuffled.select("p").distinct().collect()}


def test_hot_publications(spark, shuffles_only):
    rows = [(i, "big") for i in range(3000)] + [(i, f"k{i // 2}") for i in range(3000)]
    author = spark.createDataFrame(rows, "person_id long, publication_key string")
    degrees = {r.author_id: r.author_count for r in coauthor.weighted_degree_of_authors(author).collect()}
    assert degrees == {i: 2999 + 1 for i in range(3000)}
    assert {r.component for r in components.author_components(author).collect()} == {0}


def test_names_come_after_the_limit(spark):
    person = spark.createDataFrame([(i, f"n{i % 5}") for i in range(30)], "id long, full_name string")
    author = spark.createDataFrame([(i, f"k{j}") for i in range(12) for j in range(i)], "person_id long, publication_key string")
    counts = authors.author_pub_counts(person, author)
    for k in (3, 20):
        assert sorted(map(tuple, authors.top_k_of(person, author, k).collect())) == sorted(
            map(tuple, authors.top_k_authors(counts, k).collect()))
    assert sorted(map(tuple, authors.random_of(person, author, 9).collect())) == sorted(
        map(tuple, authors.random_authors(counts, 9).collect()))


def test_wide_rows_are_not_broadcast(spark, monkeypatch):
    table = Scratch(spark, "wide").table(spark.range(10).select(F.lit("x" * 100).alias("t")), "t")
    assert skew.is_small(table)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 500)
    assert not skew.is_small(table)


def test_scratch_can_be_closed(spark):
    scratch = Scratch(spark, "closing")
    scratch.table(spark.range(3), "t")
    assert scratch.path.startswith(shared_folder(spark)) and path_exists(spark, scratch.path)
    scratch.close()
    assert not path_exists(spark, scratch.path)


def test_publish_replaces_only_what_holds(spark, tmp_path):
    (tmp_path / "dump.xml").write_text(
        "<dblp>\n<article key='a/1' mdate='2020-01-01'><author>A</author><title>T</title><year>2000</year></article>\n</dblp>\n")
    staging, live = str(tmp_path / "staging"), str(tmp_path / "live")
    ingest.ingest(spark, str(tmp_path / "dump.xml"), staging)
    ingest.publish(spark, staging, live)
    assert table_io.read_table(spark, live, "publication").count() == 1
    double = table_io.read_table(spark, staging, "publication")
    table_io.write_tables({"publication": Scratch(spark, "double").table(double.unionAll(double), "p")}, staging)
    with pytest.raises(ValueError):
        ingest.publish(spark, staging, live)
    assert table_io.read_table(spark, live, "publication").count() == 1


def test_commands_print_everything(spark, tmp_path, capsys, monkeypatch):
    lines = "".join(f"<article key='a/{i}'><author>A</author><author>B{i}</author><title>T</title></article>\n" for i in range(130))
    (tmp_path / "dump.xml").write_text(f"<dblp>\n{lines}</dblp>\n")
    folder = str(tmp_path / "tables")
    monkeypatch.setattr(command_line, "close_scratch", lambda _: None)
    command_line.main(["ingest", folder, str(tmp_path / "dump.xml")])
    command_line.main(["graph", folder])
    capsys.readouterr()
    command_line.main(["component", folder, "0"])
    assert len(capsys.readouterr().out.splitlines()) == 132
    command_line.main(["check", folder, "--out", str(tmp_path / "report")])
    assert spark.read.csv(str(tmp_path / "report"), header=True).count() > 20
    with pytest.raises(ValueError):
        graph_plans.build_graph(spark, folder, buckets=4)


def test_one_report_per_rule(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (2, "z"), (None, None)], "p long, kind string")
    parent = spark.createDataFrame([(1,), (3,)], "id long")
    report = checks.integrity_report(
        {"child": child, "other": child, "parent": parent}, {"parent": ["id"]}, {}, [],
        [("child", "p", "parent", "id"), ("other", "p", "parent", "id")],
        {("child", "kind"): ["a", "b"], ("other", "kind"): ["a", "b", "z"]}, {})
    got = {(r.kind, r.rule): r.violations for r in report.collect()}
    assert got == {("primary key", "parent(id)"): 0, ("foreign key", "child.p -> parent.id"): 1,
                   ("foreign key", "other.p -> parent.id"): 1, ("domain", "child.kind"): 1, ("domain", "other.kind"): 0}


def test_scratch_of_a_session_goes_at_once(spark):
    paths = [Scratch(spark, "gone").path for _ in range(2)]
    close_scratch(spark)
    assert not any(path_exists(spark, p) for p in paths)
