"""Loaded tables become visible all at once, and ids outlive a reload."""

import pytest

from colophon.operators import ordering, shred
from colophon.plans import ingest
from colophon.schemas import TABLES
from colophon.session import path_exists
from colophon.sources import tables as table_io


def dump(path, *keys, extra=""):
    path.write_text("<bib>\n" + "".join(
        f'<book key="{k}"><author>Author {k}</author><title>T</title><publisher href="h/{k}">P {k[0]}</publisher></book>\n'
        for k in keys) + extra + "</bib>\n")
    return str(path)


def rows(spark, folder, table, *columns):
    return sorted(tuple(r) for r in table_io.read_table(spark, folder, table).select(*columns).collect())


def test_publishing_is_all_or_nothing(spark, tmp_path, monkeypatch):
    staging, live = str(tmp_path / "staging"), str(tmp_path / "live")
    ingest.ingest(spark, dump(tmp_path / "a.xml", "b/1", "c/2"), staging)
    assert ingest.publish(spark, staging, live) == list(TABLES)
    before = {t: rows(spark, live, t, "*") for t in TABLES}
    assert [k for k, in rows(spark, live, "publication", "key")] == ["b/1", "c/2"]

    ingest.ingest(spark, dump(tmp_path / "b.xml", "d/1", "e/2", "f/3"), staging)
    written = []

    def failing(df, name, at=table_io.bloom_filters):
        written.append(df)
        if len(written) == 7:
            raise OSError("the disk is full")
        return at(df, name)

    monkeypatch.setattr(table_io, "bloom_filters", failing)
    with pytest.raises(OSError):
        ingest.publish(spark, staging, live)
    assert len(written) == 7
    assert {t: rows(spark, live, t, "*") for t in TABLES} == before
    monkeypatch.undo()
    opened = table_io.read_tables(spark, live)
    ingest.publish(spark, staging, live)
    assert [k for k, in rows(spark, live, "publication", "key")] == ["d/1", "e/2", "f/3"]
    assert spark.table("publication").count() == 3
    # A reader that opened the tables before still has the old ones.
    assert sorted(r["key"] for r in opened["publication"].select("key").collect()) == ["b/1", "c/2"]


def test_old_versions_go(spark, tmp_path):
    one = {"school": spark.createDataFrame([(0, "S")], "id long, name string")}
    homes = [table_io.publish_tables(spark, one, str(tmp_path), kept=2) for _ in range(4)]
    assert [path_exists(spark, h) for h in homes] == [False, False, True, True]
    assert table_io.current_folder(spark, str(tmp_path)) == homes[-1]
    assert rows(spark, str(tmp_path), "school", "id", "name") == [(0, "S")]


def test_nothing_is_loaded_into_a_published_folder(spark, tmp_path):
    one = {"school": spark.createDataFrame([(0, "S")], "id long, name string")}
    table_io.publish_tables(spark, one, str(tmp_path / "live"))
    with pytest.raises(ValueError, match="published"):
        ingest.ingest(spark, dump(tmp_path / "a.xml", "b/1"), str(tmp_path / "live"))
    with pytest.raises(ValueError, match="published"):
        table_io.load_csv_tables(spark, str(tmp_path), str(tmp_path / "live"))


def test_ids_survive_a_second_load(spark, tmp_path):
    first, second = str(tmp_path / "1"), str(tmp_path / "2")
    ingest.ingest(spark, dump(tmp_path / "a.xml", "m/1", "n/2", "m/3"), first)
    assert rows(spark, first, "publisher", "id", "name", "href") == [(0, "P m", "h/m/1"), (1, "P n", "h/n/2")]
    # Names that sort before the old ones, one old name is gone, an old publisher has another link.
    ingest.ingest(spark, dump(tmp_path / "b.xml", "a/0", "m/9", "m/1", extra='<www key="w"><author>Author m/1</author></www>'),
                  second, known=first)
    old = dict(rows(spark, first, "person", "full_name", "id"))
    new = dict(rows(spark, second, "person", "full_name", "id"))
    assert {name: new[name] for name in old} == old
    assert sorted(new.values()) == list(range(len(new))) and len(new) == len(old) + 2
    assert rows(spark, second, "publisher", "id", "name", "href") == [(0, "P m", "h/m/1"), (1, "P n", "h/n/2"), (2, "P a", "h/a/0")]
    assert dict(rows(spark, second, "publication", "key", "publisher_id")) == {"a/0": 2, "m/9": 0, "m/1": 0, "w": None}
    assert set(rows(spark, second, "author", "publication_key", "person_id")) >= {("m/1", old["Author m/1"]), ("w", old["Author m/1"])}
    # A load into the folder of the earlier tables itself.
    ingest.ingest(spark, dump(tmp_path / "c.xml", "0/0"), second, known=second)
    assert dict(rows(spark, second, "person", "full_name", "id")) == new | {"Author 0/0": len(new)}


def test_null_keys_are_known(spark):
    known = spark.createDataFrame([(5, "A", None), (9, "A", "o")], "id long, full_name string, orcid string")
    mentions = spark.createDataFrame([("A", None), ("A", "o"), ("A", "p"), ("A", None), ("B", None)], "full_name string, orcid string")
    got = sorted((r["id"], r["full_name"], r["orcid"]) for r in shred.person_dictionary(mentions, known).collect())
    assert got == [(5, "A", None), (9, "A", "o"), (10, "A", "p"), (11, "B", None)]
    empty = known.limit(0)
    assert sorted(r["id"] for r in ordering.extended_ids(empty, mentions.distinct(), ["full_name", "orcid"], ["full_name"]).collect()) == [0, 1, 2, 3]
