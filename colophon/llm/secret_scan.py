"""Secrets in texts: fixed patterns, and windows of high entropy in candidate strings.

A candidate is a run of 20 or more characters that keys are written in. A window of 20 slides over
it; counts per character and the sum of ``c * log2(c)`` are updated by the character that enters and
the one that leaves, which gives the window's Shannon entropy. How much is suspicious depends on
the character class of the candidate. Strings of the allow-list are left alone.

``by_window`` also judges every window by its own class, kept by counts per group of characters, so
that a name in front of a secret does not move the secret into a stricter class.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from colophon.llm.columns import gathered, narrow, whole

# Kind -> its pattern, and a condition on the match (and on group 2).
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ["assign", "access", "hex", "entropy"]

SPANS = "array<struct<start:int,end:int,part:string>>"
WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
# Character class of a whole candidate, in this order -> bits per character that are suspicious.
# Digits alone and letters of one case alone are numbers and words.
CLASSES = [
    ("^[0-9]+$", None),
    ("^([0-9a-f]+|[0-9A-F]+)$", 2.9),
    ("^([a-z_=-]+|[A-Z_=-]+|[A-Z]?[a-z_=-]+)$", None),
    ("^[A-Za-z_=-]+$", 4.0),
    ("^[a-z0-9_=-]+$|^[A-Z0-9_=-]+$", 3.5),
    ("", 3.7),
]
# Groups of characters that tell the class of a window.
GROUPS = ["[0-9]", "[a-f]", "[A-F]", "[g-z]", "[G-Z]", "[+/]"]
ALLOWED = [
    "(?i)example|sample|dummy|placeholder|changeme|your[_-]",
    "(.)\\1{7,}",
    "(?i)0123456789|abcdefghij",
    "^[0-9A-Fa-f]{8}-([0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$",
    "^(/[A-Za-z_-]+){2,}/?$",
]


def located(text: Column, pattern: str, present: str, group: int = 0) -> Column:
    """``(start, end, part)`` of all leftmost matches, in code points; ``part`` is a group's text.

    Texts without ``present``, which every wanted match contains, get an empty array. The places are
    sums of the lengths between and of the matches.
    """
    none = F.array().cast(SPANS)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.arrays_zip(gaps.alias("gap"), found.alias("all"), part.alias("part"))

    def step(at, x):
        start = at + x["gap"]
        end = start + F.length(x["all"])
        span = F.struct(start.alias("start"), end.alias("end"), x["part"].alias("part"))
        return end, F.when(x["all"].isNull(), none).otherwise(F.array(span))

    return F.when(text.rlike(present), gathered(rows, F.lit(0), step, SPANS)).otherwise(none)


def window_limit(groups: Column, first_upper: Column) -> Column:
    """The limit of ``CLASSES`` for a window with so many characters of each of ``GROUPS``."""
    digits, low_hex, up_hex, low, up, signs = (F.get(groups, F.lit(k)) for k in range(len(GROUPS)))
    lower, upper = low_hex + low, up_hex + up
    joined = F.lit(WINDOW) - digits - lower - upper - signs
    one_case = (lower == 0) | (upper == 0)
    limits = [limit for _, limit in CLASSES]
    tests = [digits == WINDOW, (digits + low_hex + up_hex == WINDOW) & one_case,
             (digits + signs == 0) & (one_case | (first_upper & (upper == 1))),
             lower + upper + joined == WINDOW, (signs == 0) & one_case]
    out = F
    for test, limit in zip(tests, limits):
        out = out.when(test, F.lit(limit).cast("double"))
    return out.otherwise(F.lit(limits[-1]))


def without(text: Column, pattern: str) -> Column:
    """The text with a point in place of every character of a match."""
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"))
    return F.when(text.rlike(pattern), F.array_join(F.transform(pieces, lambda x: F.concat(
        x["gap"], F.coalesce(F.regexp_replace(x["all"], ".", "."), F.lit("")))), "")).otherwise(text)


def suspicious(candidate: Column, allowed: list[str], by_window: bool = False) -> Column:
    """``(first, last)``: the first and last suspicious window of a candidate, or null.

    A window is suspicious by the class of the candidate, and with ``by_window`` also by its own.
    """
    bits = None
    for pattern, limit in CLASSES:
        value = F.lit(limit).cast("double")
        bits = F.when(candidate.rlike(pattern), value) if bits is None else bits.when(
            candidate.rlike(pattern), value) if pattern else bits.otherwise(value)
    judged = F.lit(True)
    for pattern in allowed:
        judged = judged & ~candidate.rlike(pattern)
    bits = F.when(judged, bits)
    group_of = [next((k for k, g in enumerate(GROUPS) if re.match(g, c)), -1) for c in ALPHABET]
    groups_of = F.array(*map(F.lit, group_of))
    upper = [k for k, g in enumerate(GROUPS) if g in ("[A-F]", "[G-Z]")]

    def places_of(part):
        return F.transform(F.array_remove(F.split(part, ""), ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

    # Characters of the allow-list have the place -1 and no class.
    places = places_of(candidate)
    for pattern in allowed if by_window else []:
        places = F.zip_with(places, places_of(without(candidate, pattern)), lambda x, y: F.least(x, y))
    zero = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("sum"),
        F.array_repeat(F.lit(0), len(GROUPS)).alias("groups"), F.lit(0).alias("spared"),
        F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"), F.lit(0).alias("i"))

    def weight(c):
        return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(0.0)

    def slide(all_places, limit):
        def step(a, enters):
            i = a["i"]
            leaves = F.when(i >= WINDOW, F.get(all_places, i - WINDOW)).otherwise(-1)
            moved = enters != leaves
            grown, shrunk = F.get(a["counts"], enters), F.get(a["counts"], leaves)
            total = a["sum"] + F.when(moved, weight(grown + 1) - weight(grown) + F.coalesce(
                weight(shrunk - 1) - weight(shrunk), F.lit(0.0))).otherwise(0.0)
            counts = F.transform(a["counts"], lambda c, j: c + (j == enters).cast("int") - (j == leaves).cast("int"))
            entropy = F.log2(F.lit(float(WINDOW))) - total / WINDOW
            here = i - (WINDOW - 1)
            groups, spared, least = a["groups"], a["spared"], limit
            if by_window:
                spared = spared + (enters < 0).cast("int") - ((i >= WINDOW) & (leaves < 0)).cast("int")
                came, went = (F.coalesce(F.get(groups_of, x), F.lit(-1)) for x in (enters, leaves))
                groups = F.transform(groups, lambda c, j: c + (j == came).cast("int") - (j == went).cast("int"))
                least = F.least(limit, window_limit(groups, F.get(groups_of, F.get(all_places, here)).isin(upper)))
            hit = (i >= WINDOW - 1) & (spared == 0) & F.coalesce(F.round(entropy, 6) >= least, F.lit(False))
            return F.struct(
                counts.alias("counts"), total.alias("sum"), groups.alias("groups"), spared.alias("spared"),
                F.when(hit & a["first"].isNull(), here).otherwise(a["first"]).alias("first"),
                F.when(hit, here).otherwise(a["last"]).alias("last"), (i + 1).alias("i"))

        return F.aggregate(all_places, zero, step, lambda a: F.when(a["first"].isNotNull(), F.struct(
            a["first"].alias("first"), a["last"].alias("last"))))

    # The places are bound to a lambda variable, so that they are made once per candidate.
    return F.when(F.lit(True) if by_window else bits.isNotNull(), F.get(F.transform(F.array(F.struct(
        places.alias("places"), bits.alias("bits"))), lambda x: slide(x["places"], x["bits"])), 0))


def secret_spans(text: Column, allowed: list[str] = ALLOWED, by_window: bool = False) -> Column:
    """All spans of a text as ``(start, kind, end)``, ordered; ``kind`` counts in ``KINDS``.

    Spans may overlap. A null text must be made empty by the caller.
    """
    def kind(k, spans, start=lambda x: x["start"], end=lambda x: x["end"]):
        return F.transform(spans, lambda x: F.struct(
            start(x).alias("start"), F.lit(k).alias("kind"), end(x).alias("end")))

    assign = F.filter(located(text, ASSIGN, ASSIGN[:-2] + "{6})", 2), lambda x: F.length(x["part"]) >= 6)
    access = F.filter(located(text, ACCESS, "AKIA[A-Z0-9]{16}"), lambda x: x["end"] - x["start"] >= 20)
    hexes = F.filter(located(text, f"{HEX[:-1]}{{24,}}", f"{HEX[:-1]}{{24}}"), lambda x: x["end"] - x["start"] >= 24)
    judged = F.filter(F.transform(located(text, CANDIDATE, CANDIDATE), lambda x: F.struct(
        x["start"].alias("start"), suspicious(x["part"], allowed, by_window).alias("window"))), lambda x: x["window"].isNotNull())
    return F.sort_array(F.concat(
        kind(0, assign), kind(1, access), kind(2, hexes),
        kind(3, judged, lambda x: x["start"] + x["window"]["first"],
             lambda x: x["start"] + x["window"]["last"] + WINDOW)))


def secret_scan(docs: DataFrame, allowed: list[str] = ALLOWED) -> DataFrame:
    """``doc_id`` and ``spans`` of every row; a null text is empty and has none.

    Repeated rows give repeated results, an empty table an empty one; extra columns are ignored.
    """
    return narrow(docs, "doc_id", "text").select("doc_id", secret_spans(whole(), allowed).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined in their order."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]", allowed: list[str] = ALLOWED) -> DataFrame:
    """``docs`` with ``mark`` in place of every maximal stretch that spans cover, windows judged by
    their own class included.

    All rows and columns are kept; a null text stays null, and ``n_chars``, if it is there, is
    counted anew for the texts that change.
    """
    text = F.col("text")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a, x):
        gap = F.when(x["start"] >= a["at"], F.concat(a["out"], F.substring(
            text, a["at"] + 1, x["start"] - a["at"]), F.lit(mark))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), gap.alias("out"))

    spans = F.col("__spans")
    clean = F.when(F.size(spans) > 0, F.aggregate(spans, zero, step, lambda a: F.concat(
        a["out"], F.substring(text, a["at"] + 1, F.length(text))))).otherwise(text)
    out = docs.withColumn("__spans", secret_spans(whole(), allowed, by_window=True)).withColumn("text", clean)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            F.size("__spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
