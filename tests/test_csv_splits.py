"""CSV files with line breaks in values, read by splits of any size, against Spark's one-task reader."""

import random

import pytest

from colophon.sources import tables as table_io
from pyspark.sql import functions as F

SCHEMA = "id long, full_name string, orcid string"


def split(spark, size, read):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        return read()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def made_file(path, seed, rows=120):
    """Quoted and plain values, quotes doubled or in the middle of plain values, breaks, wrong numbers of values."""
    rng = random.Random(seed)
    texts = ['a', '', 'x,y', 'two\nlines', '""q""', 'a ""b"",\n\n""c', '\n', 'é' * 30, ',\n,', 'end""', '\r\n', 'x' * 300 + '\n"",']
    lines = ["id,full_name,orcid"]
    for i in range(rows):
        quoted = [f'"{rng.choice(texts)}"' if rng.random() < 0.7 else rng.choice(["plain", "5 in", 'in 5" size', ""]) for _ in range(2)]
        if rng.random() < 0.05:
            quoted.append('"more\nthan"')
        if rng.random() < 0.05:
            quoted.pop()
        lines.append(",".join([rng.choice([str(i), f'"{i}"'] + (["x"] if rng.random() < 0.1 else [])), *quoted]))
        if rng.random() < 0.05:
            lines.append("")
    path.write_bytes("\n".join(lines).encode() + (b"\n" if seed % 2 else b""))


def by_spark(spark, path):
    text = table_io.T.StructType([table_io.T.StructField(n, table_io.T.StringType()) for n in ("id", "full_name", "orcid", "_corrupt_record")])
    rows = spark.read.schema(text).csv(str(path), header=True, escape='"', multiLine=True, mode="PERMISSIVE",
                                       columnNameOfCorruptRecord="_corrupt_record").collect()
    return sorted((r[:3] for r in rows if r["_corrupt_record"] is None), key=str), sum(r["_corrupt_record"] is not None for r in rows)


@pytest.mark.parametrize("seed", range(4))
def test_rows_do_not_depend_on_splits(spark, tmp_path, seed):
    made_file(tmp_path / "p.csv", seed)
    want, wrong = by_spark(spark, tmp_path / "p.csv")
    for size in (10_000_000, 700, 60):
        def read():
            parsed = table_io._parsed_rows(spark, str(tmp_path / "p.csv"), ["id", "full_name", "orcid"])
            return parsed.collect()
        rows = split(spark, size, read)
        assert sorted((r[:3] for r in rows if r["_corrupt_record"] is None), key=str) == want
        assert sum(r["_corrupt_record"] is not None for r in rows) == wrong


def test_one_file_is_many_tasks(spark, tmp_path):
    (tmp_path / "p.csv").write_text("full_name,id\n" + "".join(f'"name\n{i}",{i}\n' for i in range(5000)))
    def read():
        rows = table_io.csv_rows(spark, str(tmp_path / "p.csv"))
        busy = rows.select(F.spark_partition_id().alias("p")).distinct().count()
        return busy, table_io.read_csv(spark, str(tmp_path / "p.csv"), table_io.T.StructType.fromDDL(SCHEMA)).collect()
    busy, rows = split(spark, 5_000, read)
    assert busy >= 10
    assert sorted((r["id"], r["full_name"], r["orcid"]) for r in rows) == [(i, f"name\n{i}", None) for i in range(5000)]


def test_every_file_has_its_header(spark, tmp_path):
    (tmp_path / "p.csv").mkdir()
    for i in range(3):
        (tmp_path / "p.csv" / f"{i}.csv").write_text(f'﻿id,full_name\n{i},"a\nb"\n' if i == 1 else f'id,full_name\n{i},"a\nb"\n')
    assert sorted(r["id"] for r in table_io.read_csv(spark, str(tmp_path / "p.csv"), table_io.T.StructType.fromDDL(SCHEMA)).collect()) == [0, 1, 2]
    (tmp_path / "p.csv" / "9.csv").write_text('full_name,id\n"a",9\n')
    with pytest.raises(Exception, match="another header"):
        table_io.read_csv(spark, str(tmp_path / "p.csv"), table_io.T.StructType.fromDDL(SCHEMA)).collect()


def test_states_behind_lines():
    after = table_io._open_after
    assert [after(x, 0) for x in ('', 'a,b', '"a', '"a"', '"a""', '"a"",', 'a"b', 'a,"b', 'a,"b",c', '"a"x,"', '"",""', '"""')] == [
        0, 0, 1, 0, 1, 1, 0, 1, 0, 1, 0, 1]
    assert [after(x, 1) for x in ('', 'a,b', 'a"', 'a",b', 'a","b', '""', '"', '"""', 'x"y,"z')] == [1, 1, 0, 0, 1, 1, 0, 0, 1]


def test_loading_scans_once_and_single_lines_work(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "school.csv").write_text('id,name\n1,"A\nB"\nx,C\n2,D\n')
    counts = table_io.load_csv_tables(spark, str(tmp_path / "csv"), str(tmp_path / "t"))
    assert counts == {"school": 2, "rejects_school": 1}
    (tmp_path / "csv" / "school.csv").write_text('id,name\n1,"A"\n2,D\n')
    assert table_io.load_csv_tables(spark, str(tmp_path / "csv"), str(tmp_path / "t"), multi_line=False) == {"school": 2}
