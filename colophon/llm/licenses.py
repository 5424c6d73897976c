"""License notices by a positional index of the templates' rarest words.

Every template is a short notice. How rare a word is comes from all documents: its document
frequency. The five rarest words of each template are indexed with their positions. A document
looks up those it holds; a word at ``i`` that the template has at ``q`` votes for the notice
starting at ``i - q``, and two agreeing votes make a candidate. A candidate counts if every
mandatory phrase of the template stands near its place and its words, weighted by rarity, match.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from colophon.llm.columns import narrow, whole

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# Notice texts as their licences word them, label, mandatory phrases.
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files", ["permission is hereby granted", "associated documentation files"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license"]),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the "
               "license at http www apache org licenses license 2 0", ["except in compliance with the license"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["general public license"]),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as "
            "published by the free software foundation", ["gnu general public license", "free software foundation"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met", ["source and binary forms"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", ["with or without fee"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["unencumbered software", "public domain"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
]
BASE = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}
RARE, AGREE, SLACK = 5, 2, 3


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATOR), "")


def _texts(values) -> Column:
    return F.array(*map(F.lit, values))


def rarity(worded: DataFrame) -> dict[str, float]:
    """Inverse document frequency of every template word over all documents.

    At most as many rows as the templates have words reach the driver.
    """
    vocabulary = sorted({w for _, text, _ in TEMPLATES for w in text.split()})
    held = F.explode(F.array_append(F.array_intersect("words", _texts(vocabulary)), "")).alias("word")
    counts = {r["word"]: r["n"] for r in worded.select(held).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    documents = counts.get("", 0)
    return {w: math.log((documents + 1) / (counts.get(w, 0) + 1)) + 1 for w in vocabulary}


def base_places() -> Column:
    """``(label, at)`` of every place where a base phrase stands in ``words``."""
    words = F.col("words")

    def place(word, i):
        found = None
        for label, phrase in BASE.items():
            here = word == phrase[-1]
            for back, w in enumerate(reversed(phrase[:-1]), 1):
                here = here & (F.get(words, i - back) == w)
            value = F.struct(F.lit(label).alias("label"), (i - (len(phrase) - 1)).alias("at"))
            found = F.when(here, value) if found is None else found.when(here, value)
        return found

    none = F.array().cast("array<struct<label:string,at:int>>")
    return F.when(F.array_contains(words, "license"), F.array_compact(F.transform(words, place))).otherwise(none)


def votes(rare: list[tuple[str, int, int]]) -> Column:
    """Sorted ``(t, start)`` of every occurrence of an indexed word; ``rare``: (word, t, place)."""
    by_word: dict[str, list[tuple[int, int]]] = {}
    for word, t, q in rare:
        by_word.setdefault(word, []).append((t, q))
    postings = F.create_map(*(x for word, places in by_word.items() for x in (
        F.lit(word), F.array(*(F.struct(F.lit(t).alias("t"), F.lit(q).alias("q")) for t, q in places)))))
    indexed = _texts(by_word)
    held = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                    lambda x: F.array_contains(indexed, x["w"]))
    spread = F.flatten(F.transform(held, lambda x: F.transform(
        F.try_element_at(postings, x["w"]),
        lambda p: F.struct(p["t"].alias("t"), (x["i"] - p["q"]).alias("start")))))
    return F.when(F.arrays_overlap("words", indexed), F.sort_array(spread))


def agreed() -> Column:
    """The ``(t, start)`` that at least two ``votes`` share: in their order, those equal to the one before
    and not to the one before that."""
    def same(v, i):
        return F.coalesce(v == F.get("votes", i), F.lit(False))

    return F.filter("votes", lambda v, i: same(v, i - (AGREE - 1)) & ~same(v, i - AGREE))


def verified(idf: dict[str, float]) -> Column:
    """``(label, score)`` of the candidates in ``found`` whose mandatory phrases are there."""
    words = F.col("words")
    notices = F.array(*(F.struct(
        F.lit(label).alias("label"), _texts(text.split()).alias("words"),
        F.array(*(F.lit(idf[w]) for w in text.split())).alias("weights"),
        F.array(*(F.struct(F.lit(f" {p} ").alias("words"), F.lit(
            len(f" {text} ".split(f" {p} ")[0].split())).alias("at"), F.lit(len(p.split())).alias("n"))
            for p in phrases)).alias("phrases")) for label, text, phrases in TEMPLATES))

    def near(start, phrase):
        first = F.greatest(start + phrase["at"] - SLACK, F.lit(0))
        there = F.slice(words, first + 1, phrase["n"] + 2 * SLACK)
        return F.concat(F.lit(" "), F.array_join(there, " "), F.lit(" ")).contains(phrase["words"])

    def judged(c):
        notice = F.get(notices, c["t"])
        match = F.aggregate(F.transform(notice["words"], lambda w, q: F.when(
            F.get(words, c["start"] + q) == w, F.get(notice["weights"], q)).otherwise(0.0)),
            F.lit(0.0), lambda a, x: a + x)
        whole_weight = F.aggregate(notice["weights"], F.lit(0.0), lambda a, x: a + x)
        return F.when(F.forall(notice["phrases"], lambda p: near(c["start"], p)), F.struct(
            notice["label"].alias("label"), (match / whole_weight).alias("score")))

    return F.filter(F.array_compact(F.transform("found", judged)), lambda x: x["score"] >= 0.5)


def license_scan(docs: DataFrame) -> DataFrame:
    """Places and labels of license notices in every row of ``docs`` (``doc_id``, ``text``).

    Null and empty texts have no words and no labels. Repeated rows give repeated results, an
    empty table an empty one; extra columns are ignored. Equal scores need no order, as only the
    largest is returned.
    """
    worded = narrow(docs, "doc_id", "text").select("doc_id", words_of(whole()).alias("words"))
    idf = rarity(worded)
    rare = []
    for t, (_, text, _) in enumerate(TEMPLATES):
        places = text.split()
        chosen = sorted(set(places), key=lambda w: (-idf[w], w))[:RARE]
        rare += [(w, t, q) for q, w in enumerate(places) if w in chosen]
    found = worded.select("*", base_places().alias("base"), votes(rare).alias("votes"))
    found = found.withColumn("found", agreed()).withColumn("method", verified(idf))
    base = F.transform("base", lambda x: x["label"])
    method = F.coalesce(F.transform("method", lambda x: x["label"]), F.array().cast("array<string>"))
    return found.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["at"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["at"])).cast("long").alias("last_word"),
        F.sort_array(F.array_distinct(base)).alias("base_labels"),
        F.sort_array(F.array_union(base, method)).alias("labels"),
        F.coalesce(F.array_max(F.transform("method", lambda x: x["score"])), F.lit(0.0)).alias("score"))
