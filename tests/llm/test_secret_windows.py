"""Secrets behind names, which only their own windows' class shows."""

import random

from pyspark.sql import functions as F

from colophon.llm import secret_scan

HEX, BASE32 = "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def drawn(alphabet, n, seed):
    return "".join(random.Random(seed).choices(alphabet, k=n))


def masked(spark, texts):
    """What masking leaves of each text."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in secret_scan.redact(df).orderBy("doc_id").collect()]


def test_names_in_front_hide_no_secret(spark):
    texts = [f"x {name}{drawn(alphabet, 32, seed)} y" for seed in range(30) for alphabet in (HEX, BASE32)
             for name in ("", "Key=", "id_", "Id=", "X-")]
    for before, after in zip(texts, masked(spark, texts)):
        assert "[SECRET]" in after and len(after.replace("[SECRET]", "")) < len(before) - 20, before


def test_windows_of_words_and_numbers_are_none(spark):
    texts = ["1234509876" * 2 + "11", "id_internationalization_of_names", "X-INTERNATIONALIZATION-OF-NAMES",
             "Internationalization_of_names"]
    assert masked(spark, texts) == texts


def test_limits_of_windows_are_those_of_classes(spark):
    rng, n = random.Random(7), secret_scan.WINDOW
    sets = ["0123456789", "0123456789abcdef", HEX, "abcxyz_", "ABCXYZ-", "abcXYZ=", "abcxyz019-", "ABCXYZ019_", BASE64]
    texts = ["".join(rng.choices(s, k=n)) for s in sets for _ in range(6)] + ["A" + "bcdefghijklmnopqrst", "aBcdefghijklmnopqrst"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    groups = F.array(*(F.regexp_count("text", F.lit(g)) for g in secret_scan.GROUPS))
    want = None
    for pattern, limit in secret_scan.CLASSES:
        limit, test = F.lit(limit).cast("double"), F.col("text").rlike(pattern)
        want = F.when(test, limit) if want is None else want.when(test, limit)
    got = df.select("text", secret_scan.window_limit(groups, F.col("text").rlike("^[A-Z]")).alias("got"), want.alias("want"))
    assert all(r["got"] == r["want"] for r in got.collect())


def test_allowed_strings_spare_only_what_they_overlap(spark):
    # The first line of an unencrypted OpenSSH key, whole and unwrapped, and keys beside allowed words.
    first = "b3BlbnNzaC1rZXktdjEAAAAABG5vbmUAAAAEbm9uZQAAAAAAAAABAAAAMwAAAAtzc2gtZW"
    keys = [drawn(BASE64, 40, seed) for seed in range(10)]
    lines = ["".join(keys[:2])[:70], first + "".join(keys)]
    for text in (first, *lines):
        assert masked(spark, [text])[0].startswith("[SECRET]")
    for key, after in zip(keys, masked(spark, ["SAMPLE_KEY=" + key for key in keys])):
        assert after.startswith("SAMPLE") and "[SECRET]" in after and key[4:-4] not in after
    assert not any(k in masked(spark, [first + "".join(keys)])[0] for k in keys)


def test_allowed_strings_alone_are_left(spark):
    texts = ["a" * 22 + "ZZZZZZZZ", "123e4567-e89b-12d3-a456-426614174000", "/usr/local/share/applications/x",
             "xQ7-example-Zr9Lk2Wv", "=" * 60, "AbCd0123456789EfGh+/"]
    assert masked(spark, texts) == texts
