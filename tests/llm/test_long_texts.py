"""One text with very many matches, quoted lines or notices: twice as many take about twice the time."""

import time

import pytest
from pyspark.sql import functions as F

from colophon.llm import licenses, quotations, secret_scan


def seconds(run, n):
    start = time.time()
    run(n)
    return time.time() - start


def secrets(spark):
    def run(n):
        docs = spark.createDataFrame([(1, 'key "token": "abcdef12" ' * n)], "doc_id long, text string")
        spans, = secret_scan.secret_scan(docs).collect()
        assert len(spans["spans"]) == n and spans["spans"][-1]["end"] == 24 * n - 2
    return run


def quoted_lines(spark):
    def run(n):
        lines = [f"line {i} of the message" for i in range(n)]
        talk = [(1, 0, "user", "\n".join(lines)), (1, 1, "user", "\n".join(f"> {x}\n\nyes {i}" for i, x in enumerate(lines)))]
        found = quotations.link_quotations(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")).collect()
        assert len(found) == 2
    return run


def notices(spark):
    def run(n):
        docs = spark.createDataFrame([(1, "licensed under the apache license version 2 0 and words between " * n)], "doc_id long, text string")
        found, = licenses.license_scan(docs).collect()
        assert found["n_base"] == n and "apache" in found["labels"]
    return run


@pytest.mark.parametrize("what, n", [(secrets, 25_000), (quoted_lines, 2_500), (notices, 10_000)])
def test_time_grows_with_the_length(spark, what, n):
    run = what(spark)
    seconds(run, n // 4)  # code is compiled
    once, twice = seconds(run, n), seconds(run, 2 * n)
    assert twice < 60 and twice < 3 * once + 2, (once, twice)
