import pytest

from colophon.operators import profile
from colophon.plans import ingest
from colophon.sources import tables as table_io, xml

DUMP = '''<?xml version="1.0" encoding="UTF-8"?>
<!DOCTYPE bib SYSTEM "bib.dtd">
<bib mdate="2020-01-01">
<article mdate="2019-01-01" key="journals/a/1" publtype="informal" reviewid="r1">
<author orcid="0000-0001-0000-0001" bibtex="B">Ann Lee</author><author>Bob</author>
<title bibtex="bt">Draft</title>
<title>On <i>H<sub>2</sub>O</i> &amp; ice.</title>
<pages>266-273</pages><year>1999</year><volume>12a</volume><month>June</month>
<ee type="oa archive">http://x?a=1&amp;b=2</ee><ee>http://y</ee>
<cite label="X1">journals/a/2</cite><cite>...</cite>
<address>Rome</address><chapter>4</chapter><publnr>7</publnr>
</article>
<inproceedings key="conf/b/1" mdate="2018-05-05" cdate="2017-01-02"><author>Ann Lee</author><author>Ann Lee</author>
<author>M&uuml;ller</author><title>T</title><year>xx</year><volume>99999</volume><month>6</month>
<crossref>conf/b/0</crossref><booktitle>B</booktitle></inproceedings><proceedings key="conf/b/0">
<editor>Only Editor</editor><editor>Ann Lee</editor><title>P</title><month>Summer</month>
<publisher href="h1">Springer</publisher><series href="s1">LN</series><isbn type="print">978-1</isbn>
</proceedings>
<book key="books/c/1"><author>Bob</author><title>C</title>
<publisher href="h2">Springer</publisher><school>S1</school><school>S2</school></book>
<www key="homepages/x" mdate="2001-01-01"><author>Bob</author><title>Home Page</title>
<note type="affiliation" label="n">Uni</note><url type="deprecated">u</url></www>
<person key="homepages/p"><author>Nobody</author></person>
<data key="d/1"><title>Set</title></data>
<phdthesis><author>No Key</author></phdthesis>
<article key="bad/1"><author>Broken &undefined;</author></article>
<surprise id="1"><inner/></surprise>
<mastersthesis key="ms/1" mdate="nonsense"><title>No authors</title></mastersthesis>
</bib>
'''


@pytest.fixture(scope="module")
def dump(tmp_path_factory):
    path = tmp_path_factory.mktemp("dump") / "d.xml"
    path.write_text(DUMP, encoding="utf-8")
    return str(path)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_records_of_all_tags_wherever_lines_break(spark, dump):
    found = rows(xml.scan_records(spark, dump), "tag", "xml")
    assert [t for t, _ in found] == [
        "article", "article", "book", "data", "inproceedings", "mastersthesis", "person",
        "phdthesis", "proceedings", "www"]
    assert all(text.startswith(f"<{tag}") and text.endswith(f"</{tag}>") for tag, text in found)


@pytest.mark.parametrize("size", [64, 200, 1000])
def test_records_across_splits_are_whole(spark, dump, size):
    whole = rows(xml.scan_records(spark, dump), "tag", "xml")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.text(dump).rdd.getNumPartitions() > 2
        assert rows(xml.scan_records(spark, dump), "tag", "xml") == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def in_splits_of(spark, size, read):
    """What ``read`` gives with splits of a few bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        return read()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


RECORDS = "".join(f'<article key="k{i}"><title>t{i}</title>\n<year>19{i:02d}</year></article>\n' for i in range(11))
HIDDEN = {
    "records in a comment": RECORDS.replace("<article key=\"k4\"", '<!-- old\n<article key="c1">\n</article>\n'
                                            + "filler\n" * 60 + '<article key="c2"/>\n--> <article key="k4"'),
    "a comment mark in character data": RECORDS.replace(
        "<title>t1</title>", "<title><![CDATA[" + "text\n" * 80 + "<!-- </title> <book key='b'/>\n]]></title>"),
    "marks of the other kind": RECORDS.replace("<title>t2</title>", "<!-- <![CDATA[ \n -->\n<title><![CDATA[ <!-- \n]]>t2</title><!---->"),
    "a dash before the end": RECORDS.replace("<title>t3</title>", "<!-->\n<book key='x'/>--->\n<title>t3</title>"),
    "a section of many splits": RECORDS.replace("<title>t5</title>", "<title><![CDATA[" + "<book key='n'/> & ]] >\n" * 200 + "]]></title>"),
}


@pytest.mark.parametrize("case", HIDDEN)
@pytest.mark.parametrize("size", [10_000_000, 500, 40])
def test_comments_and_character_data_across_splits(spark, tmp_path, case, size):
    (tmp_path / "d.xml").write_text(f'<?xml version="1.0"?>\n<bib>\n{HIDDEN[case]}</bib>\n')
    parsed = in_splits_of(spark, size, lambda: xml.parse_records(xml.scan_records(spark, str(tmp_path))).collect())
    assert sorted(r["_key"] for r in parsed) == sorted(f"k{i}" for i in range(11))
    assert all(r["_corrupt_record"] is None for r in parsed)
    titles = {r["_key"]: r["title"][-1] for r in parsed}
    assert titles["k10"] == "t10" and titles["k0"] == "t0"
    if case == "a section of many splits":
        assert titles["k5"].count("key='n'") == 200
    order = [r["_key"] for r in sorted(parsed, key=lambda r: tuple(r["at"]))]
    assert order == [f"k{i}" for i in range(11)]


def test_state_of_one_file_does_not_reach_the_next(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<bib><article key="a"/>\n<!-- never closed\n<article key="no"/>\n')
    (tmp_path / "b.xml").write_text('<bib><article key="b"/>\n--> <article key="c"/></bib>')
    for size in (10_000_000, 20):
        found = in_splits_of(spark, size, lambda: xml.parse_records(xml.scan_records(spark, str(tmp_path))).collect())
        assert [r["_key"] for r in sorted(found, key=lambda r: tuple(r["at"]))] == ["a", "b", "c"]


def test_records_end_where_their_first_end_tag_does(spark):
    bodies = {'<book key="a"/>\n<thing></book></thing>': '<book key="a"/>', '<book key="b"><title>x</title></book>\nrest</book>':
              '<book key="b"><title>x</title></book>', '<book key="c">x</book\n >\n</book>': '<book key="c">x</book\n >',
              '<book key="d">x</books></book>y': '<book key="d">x</books></book>', '<book key="e"><note/>x': '<book key="e"><note/>x',
              '<www key="é"><note>ü😀</note></www> z': '<www key="é"><note>ü😀</note></www>'}
    found = xml.records_of(spark.createDataFrame([(b,) for b in bodies], "body string"))
    assert sorted(r["xml"] for r in found.collect()) == sorted(bodies.values())


def test_each_split_is_a_task_of_whoever_reads_the_cut_dump(spark, tmp_path):
    """A written copy is compressed, so that a few long tasks would read it all."""
    from registry import common
    common._staged[(spark.sparkContext.applicationId, "here", "dump")] = str(tmp_path / "d")
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.xml").write_text("".join(
        f'<article key="k{i}"><author>A</author><title>title {i}</title></article>\n' for i in range(5000)))
    found, tasks = in_splits_of(spark, 20_000, lambda: (
        common.xml_records(spark, "here").count(), common.xml_chunks(spark, "here").rdd.getNumPartitions()))
    assert found == 5000 and tasks >= 15


def test_children_are_counted_by_depth(spark):
    records = spark.createDataFrame([
        ("article", '<article key="a>b"><cite><ref/><cite>x</cite></cite><i>x</i><title a="/>">H<sub>2<sub/></sub></title><ee/></article>'),
        ("article", "<article><i/><author>A</author></article>"), ("book", "<book/>")], "tag string, xml string")
    counts = {(t, c): n for t, c, n in rows(profile.child_tag_counts(records), "tag", "child", "occurrences")}
    assert counts == {("article", "cite"): 1, ("article", "i"): 2, ("article", "title"): 1, ("article", "ee"): 1,
                      ("article", "author"): 1}


def test_many_files_in_one_task(spark, tmp_path):
    for i in range(20):
        (tmp_path / f"{i}.xml").write_text(
            f'<bib><article key="a/{i}"><title>{i}</title></article>\n'
            f'<book key="b/{i}"></book></bib>')
    found = xml.parse_records(xml.scan_records(spark, str(tmp_path)))
    assert rows(found, "_key") == sorted((f"{t}/{i}",) for t in "ab" for i in range(20))


def test_gzip_is_one_split(spark, tmp_path):
    import gzip
    path = tmp_path / "d.xml.gz"
    path.write_bytes(gzip.compress(DUMP.encode()))
    assert xml.scan_records(spark, str(path)).count() == 10


def test_rejects_and_stats(spark, dump):
    parsed = xml.parse_records(xml.scan_records(spark, dump))
    assert rows(xml.rejected_records(parsed), "category", "reason") == [
        ("article", "not well-formed"), ("phdthesis", "no key")]
    stats = {r.category: (r.total, r.parsed, r.failed) for r in xml.parse_stats(parsed).collect()}
    assert stats["article"] == (2, 1, 1) and stats["phdthesis"] == (1, 0, 1)
    assert stats["book"] == (1, 1, 0) and "person" not in stats
    with pytest.raises(Exception, match="unusable record"):
        xml.good_records(parsed, strict=True).count()


def test_native_reader_gives_the_same_rows(spark, tmp_path):
    path = tmp_path / "n.xml"
    path.write_text('<bib><book key="b/1"><title>A <i>b</i></title></book>'
                    '<book key="b/2"><author orcid="o">X</author></book></bib>')
    native = xml.read_tag(spark, str(path), "book")
    scanned = xml.parse_records(xml.scan_records(spark, str(path)))
    columns = ["category", "_key", "title", "author"]
    assert rows(native, *columns) == rows(scanned, *columns)


def test_profile(spark, dump):
    found = ingest.profile_dump(spark, dump)
    assert dict(rows(found["records"], "tag", "records"))["article"] == 2
    children = {(t, c): n for t, c, n in rows(found["children"], "tag", "child", "occurrences")}
    assert children["article", "title"] == 2 and children["inproceedings", "author"] == 3
    assert ("article", "sub") not in children
    assert rows(found["unexpected"], "tag", "occurrences") == [("surprise", 1)]
    assert ("note", "affiliation") in rows(found["types"], "element", "value")
    with pytest.raises(Exception, match="unexpected element"):
        profile.unexpected_elements(xml.scan_chunks(spark, dump), strict=True).count()


@pytest.fixture(scope="module")
def loaded(spark, dump, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    return folder, ingest.ingest(spark, dump, folder)


def test_tables(spark, loaded):
    folder, counts = loaded
    t = table_io.read_tables(spark, folder)
    assert counts == {n: df.count() for n, df in t.items()}
    people = {(r.full_name, r.orcid): r.id for r in t["person"].collect()}
    assert set(people) == {("Ann Lee", "0000-0001-0000-0001"), ("Ann Lee", None), ("Bob", None),
                           ("Müller", None), ("Only Editor", None)}
    assert sorted(people.values()) == list(range(5))
    ann = people["Ann Lee", None]
    assert rows(t["author"].where(f"person_id = {ann}"), "publication_key") == [("conf/b/1",)]
    assert t["author"].where("bibtex = 'B'").count() == 1
    assert t["editor"].count() == 2
    p = {r.key: r for r in t["publication"].collect()}
    assert set(p) == {"journals/a/1", "conf/b/1", "conf/b/0", "books/c/1", "homepages/x", "ms/1"}
    a = p["journals/a/1"]
    assert a.title == "On <i>H<sub>2</sub>O</i> & ice."
    assert (a.year, a.volume, a.month, a.month_num) == (1999, None, "june", 6)
    assert (a.type, a.reviewid, a.address, a.chapter, a.publnr) == (
        "informal", "r1", "Rome", 4, 7)
    assert a.title_bibtex is None  # the last title counts and has none
    assert (p["conf/b/1"].year, p["conf/b/1"].volume, p["conf/b/1"].month_num) == (None, None, 6)
    assert str(p["conf/b/1"].cdate) == "2017-01-02" and p["ms/1"].mdate is None
    names = {r.id: (r.name, r.href) for r in t["publisher"].collect()}
    assert names == {0: ("Springer", "h1")}  # the first occurrence in the dump, not by key
    schools = {r.name: r.id for r in t["school"].collect()}
    assert set(schools) == {"S1", "S2"} and p["books/c/1"].school_id == schools["S2"]
    assert p["books/c/1"].publisher_id == 0 and p["journals/a/1"].publisher_id is None
    assert rows(t["electronic_edition"], "url", "is_archive", "is_oa") == [
        ("http://x?a=1&b=2", True, True), ("http://y", False, False)]
    assert rows(t["cite"], "id", "str", "label") == [(0, "journals/a/2", "X1"), (1, "...", None)]
    assert rows(t["note"], "note", "type", "label") == [("Uni", "affiliation", "n")]
    assert rows(t["isbn"], "isbn", "type") == [("978-1", "print")]
    assert rows(t["crossref"], "str") == [("conf/b/0",)]
    assert spark.read.parquet(f"{folder}/rejects").count() == 2


def test_loaded_tables_hold_their_constraints(spark, loaded):
    folder, _ = loaded
    report = ingest.check(spark, folder).where("violations > 0").collect()
    assert [(r.kind, r.rule) for r in report] == [("domain", "publication.month")]
    ingest.publish(spark, folder)
    assert spark.sql("select count(*) from author a join person p on a.person_id = p.id"
                     ).first()[0] == spark.table("author").count()
    with pytest.raises(ValueError, match="domain publication.month: 2"):
        ingest.publish(spark, folder, kinds=["domain"])


def test_big_dictionaries_give_the_same_tables(spark, dump, loaded, tmp_path, shuffles_only):
    folder, counts = loaded
    again = str(tmp_path / "again")
    assert ingest.ingest(spark, dump, again) == counts
    for name, df in table_io.read_tables(spark, again).items():
        assert rows(df, *df.columns) == rows(
            table_io.read_table(spark, folder, name), *df.columns)


def test_no_occurrence_gives_an_empty_table(spark, tmp_path):
    path = tmp_path / "e.xml"
    path.write_text('<bib><article key="k"><author>A</author></article></bib>')
    counts = ingest.ingest(spark, str(path), str(tmp_path / "t"))
    assert counts["note"] == counts["publisher"] == counts["editor"] == 0
    assert counts["author"] == counts["publication"] == 1
