import datetime

from pyspark.sql import functions as F

from colophon.__main__ import main
from colophon.operators import checks, skew
from colophon.sources import graphfiles, tables as table_io


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_by_header_name(spark, tmp_path):
    path = write(tmp_path / "publication.csv", (
        '"title","key","volume","year","extra","cdate","number"\n'
        '"Say ""hi"", all","k1","12.0","1991.0","x","2001-02-03","1.05"\n'
        '"","k2","","xx","","",""\n'))
    got = table_io.read_csv(spark, path, table_io.table_schema("publication"))
    assert got.schema == table_io.table_schema("publication")
    [first] = got.collect()
    assert (first.title, first.volume, first.year) == ('Say "hi", all', 12, 1991)
    assert (first.number, first.cdate) == ("1.05", datetime.date(2001, 2, 3))
    assert first.category is None
    # A year that is no number makes its row a reject; blanks do not.
    assert [r.reason for r in table_io.csv_rejects(
        spark, path, table_io.table_schema("publication")).collect()] == ["no such value: year"]
    blank = write(tmp_path / "blank.csv", '"title","key","volume","year","cdate"\n"","k2","","",""\n')
    [second] = table_io.read_csv(spark, blank, table_io.table_schema("publication")).collect()
    assert (second.title, second.volume, second.year, second.cdate, second.category) == (
        None,) * 5


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'a "b", c', None), (2, "back\\slash", "0-1"), (3, "'", "0-2")]
    people = spark.createDataFrame(rows, "id long, full_name string, orcid string")
    table_io.write_csv(people, str(tmp_path / "person.csv"))
    counts = table_io.load_csv_tables(spark, str(tmp_path), str(tmp_path / "t"))
    assert counts == {"person": 3}
    got = table_io.read_table(spark, str(tmp_path / "t"), "person")
    assert sorted(map(tuple, got.collect())) == rows


def test_reload_replaces(spark, tmp_path):
    folder = str(tmp_path)
    one = spark.createDataFrame([(1, "k")], "person_id long, publication_key string")
    two = one.union(one)
    assert table_io.write_tables({"editor": two}, folder) == {"editor": 2}
    assert table_io.write_tables({"editor": one}, folder) == {"editor": 1}
    assert table_io.read_table(spark, folder, "editor").count() == 1


def test_point_lookup_skips_files(spark, tmp_path):
    # Every file holds ids of the whole range, so only the bloom filters can tell them apart.
    rows = spark.range(200_000).select(
        (F.col("id") * 999_983 % 200_000).alias("person_id"),
        F.concat(F.lit("k"), "id").alias("publication_key"))
    folder = str(tmp_path)
    table_io.write_tables({"editor": rows.repartition(8, "publication_key")}, folder)
    editor = table_io.read_table(spark, folder, "editor")
    wanted = spark.createDataFrame([(777,)], "id long")
    found = skew.prune_to(editor, wanted, "person_id", "id")
    plan = found._jdf.queryExecution().executedPlan()
    assert plan.execute().count() == 1
    scan = plan
    while not scan.children().isEmpty():
        scan = scan.children().head()
    assert "777" in scan.toString() and "PushedFilters: []" not in scan.toString()
    read = scan.metrics().apply("numOutputRows").value()
    assert read < 100_000, read


def test_graph_files(spark, tmp_path):
    tables = {
        "person": spark.createDataFrame([(1, "A"), (1, "A")], "id long, full_name string"),
        "publication": spark.createDataFrame(
            [("k", 1999, 3)], "key string, year int, school_id long"),
        "electronic_edition": spark.createDataFrame([(0, True)], "id long, is_oa boolean"),
        "author": spark.createDataFrame(
            [(1, "k", "b")], "person_id long, publication_key string, bibtex string"),
    }
    graphfiles.export_graph(spark, tables, str(tmp_path))

    def header(table):
        return spark.read.text(f"{tmp_path}/{table}.csv.header").first()[0]

    assert header("person") == "id:ID(person-ID), full_name"
    assert header("publication") == "key:ID(publication-ID), year:int, school_id:long"
    assert header("electronic_edition") == "id:ID(electronic_edition-ID), is_oa:boolean"
    assert header("author") == ":START_ID(person-ID), :END_ID(publication-ID), bibtex"
    assert spark.read.csv(f"{tmp_path}/person.csv").collect() == [("1", "A")]
    counts = {r.kind: r.n for r in graphfiles.graph_counts(tables).collect()}
    assert counts == {"nodes": 3, "relationships": 1}  # as many as were written


def test_checks(spark):
    person = spark.createDataFrame(
        [(1, "A", None), (2, "A", None), (3, "A", "0-1"), (4, "B", "x" * 20), (4, None, None)],
        "id long, full_name string, orcid string")
    author = spark.createDataFrame(
        [(1, "k"), (7, "k"), (7, "l"), (None, "k")], "person_id long, publication_key string")
    url = spark.createDataFrame([(1, "u", "odd", "k"), (2, None, None, "k")],
                                "id long, url string, type string, publication_key string")
    report = {r.rule: r.violations for r in checks.integrity_report(
        {"person": person, "author": author, "url": url}).collect()}
    assert report["person(id)"] == 1
    assert report["person(full_name, orcid)"] == 0  # nulls never collide
    assert report["person(full_name) where orcid is null"] == 1
    assert report["author.person_id -> person.id"] == 1
    assert report["person.full_name"] == 1 and report["author.person_id"] == 1
    assert report["person.orcid"] == 1 and report["url.type"] == 1
    orphans = checks.orphans(author, "person_id", person, "id").collect()
    assert [(r.value, r.rows) for r in orphans] == [(7, 2)]


def test_command_line(spark, tmp_path, capsys):
    dump = write(tmp_path / "d.xml", (
        '<bib><article key="a"><author>Ann</author><author>Bob</author><title>T</title>'
        '<year>2000</year></article>\n<book key="b"><editor>Eve</editor></book></bib>'))
    folder, out = str(tmp_path / "t"), str(tmp_path / "out")
    main(["profile", dump])
    main(["ingest", folder, dump])
    main(["check", folder])
    main(["graph", folder, "--threshold", "0.4"])
    main(["author", folder, "Ann", "--out", out])
    main(["sample", folder, "--top", "1", "--random", "1"])
    main(["component", folder, "0"])
    main(["export", folder, str(tmp_path / "g")])
    assert "'author': 2" in capsys.readouterr().out
    got = spark.read.csv(out, header=True)
    assert sorted(r.full_name for r in got.collect()) == ["Ann", "Bob"]
    names = write(tmp_path / "names.csv", "full_name\nBob\nAnn\n")
    main(["authors", folder, names, "--out", out])
    assert spark.read.csv(out, header=True).count() == 4
