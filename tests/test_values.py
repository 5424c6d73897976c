from pyspark.sql import functions as F

from colophon.functions import markup, values


def column(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r.v for r in df.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()]


def test_numbers_that_do_not_parse_or_fit_are_null(spark):
    got = column(spark, ["12", " 7 ", "12a", "xx", "99999", "", None], values.safe_int)
    assert got == [12, 7, None, None, None, None, None]


def test_trailing_zero_decimals_only_go_at_the_end(spark):
    got = column(spark, ["1991.0", "1991", "1.05", "10.00", "x.0"], values.integral)
    assert got == [1991, 1991, None, 10, None]


def test_blank(spark):
    assert column(spark, ["  ", "a ", None], values.blank_to_null) == [None, "a", None]


def test_month_names_and_numbers(spark):
    got = column(spark, ["June", "6", "december", "Summer", "13", "0", None],
                 values.month_number)
    assert got == [6, 6, 12, None, None, None, None]


def test_pages(spark):
    got = column(spark, ["266-273", "9", "1:1-1:20", "300-290", "5-", "1-2-3", None],
                 values.page_range)
    assert [tuple(g) if g else None for g in got] == [
        (266, 273), (9, 9), None, (290, 300), None, (1, 2), None]


def test_flags(spark):
    assert column(spark, ["oa archive", "oa", None],
                  lambda c: values.has_flag(c, "archive")) == [True, False, False]


def test_entities(spark):
    got = column(spark, ["M&uuml;ller &amp; &Ouml;z &times; &reg; &divide; &micro;", "plain",
                         "&auml;", "AT&T &uuml", "&;&&eth;", None], markup.decode_entities)
    assert got == ["Müller &amp; Öz × ® &divide; µ", "plain", "ä", "AT&T &uuml", "&;&ð", None]
    assert len(markup.latin_entities()) == 65


def test_leftover_tags_only_of_the_element(spark):
    got = column(spark, ['<author orcid="0-1">A <i>b</i></author>', "<authors>x"],
                 lambda c: markup.strip_element(c, ["author", "editor"]))
    assert got == ["A <i>b</i>", "<authors>x"]


def test_children_without_what_they_hold(spark):
    xml = '<article key="k"><author>A</author><title>x <i>y<sub>2</sub></i></title><ee/></article>'
    assert column(spark, [xml, "<book/>", None], lambda c: markup.child_counts(c)) == [{"author": 1, "title": 1, "ee": 1}, {}, None]


def test_attribute_of_the_last_element(spark):
    xml = '<a><title bibtex="one">x</title><title label="l" bibtex="two">y</title></a>'
    assert column(spark, [xml, "<a><title>x</title></a>"],
                  lambda c: markup.attribute(c, "title", "bibtex")) == ["two", None]


def test_orphans_need_no_join(spark):
    from colophon.operators import checks
    child = spark.createDataFrame([(1,), (2,), (2,), (None,), (9,), (9,), (9,)], "fk int")
    other = spark.createDataFrame([("9",), ("x",), ("1",)], "k string")
    parent = spark.createDataFrame([(1,), (1,), (3,), (None,)], "id long")
    found = checks.orphans(child, "fk", parent, "id")
    assert found.dtypes == [("value", "int"), ("rows", "bigint")]
    assert sorted(map(tuple, found.collect())) == [(2, 2), (9, 3)]
    every = checks.all_orphans({"child": child, "other": other, "parent": parent},
                               [("child", "fk", "parent", "id"), ("other", "k", "parent", "id")])
    assert sorted(map(tuple, every.collect())) == [
        ("child.fk -> parent.id", "2", 2), ("child.fk -> parent.id", "9", 3),
        ("other.k -> parent.id", "9", 1), ("other.k -> parent.id", "x", 1)]
    for df in (found, every):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Sort" not in plan and "SortAggregate" not in plan
