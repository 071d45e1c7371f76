"""License notices: exact phrases, and an exact set-similarity join with templates.

A text block is a line, or a run of as many words as the template has, across
line ends. A block meets a template when it holds at least ``threshold`` of the
template's distinct words. Template words are ordered by
how many documents hold them, rarest first, counted over all documents. Only
blocks with a word of a template's prefix are compared, after length and
positional filters, each pair of block and template once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import fold, words

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# Phrase and label.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Label and wording of common notices.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification "
            "are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 "
                  "international license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
            "this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
]
THRESHOLD = 0.8


def phrase_starts(found: str, phrase: str) -> Column:
    """Starts of ``phrase`` in the array column ``found``, counted from 0."""
    parts = phrase.split(" ")
    same = " and ".join(f"get({found}, i + {k}) = '{w}'" for k, w in enumerate(parts))
    some = " and ".join(f"array_contains({found}, '{w}')" for w in parts)
    return F.expr(
        f"case when size({found}) >= {len(parts)} and {some} then "
        f"filter(sequence(0, size({found}) - {len(parts)}), i -> {same}) "
        "else cast(array() as array<int>) end"
    )


def phrase_scan(docs: DataFrame, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """doc_id, text_key, n_words, n_base, first_word, last_word, base (labels) of
    every row. Null or empty text has no words and no places."""
    columns = {f"_at{k}": phrase_starts("_w", p) for k, p in enumerate(phrases)}
    held = [
        F.when(F.size(f"_at{k}") > 0, F.lit(label)) for k, label in enumerate(phrases.values())
    ]
    places = F.concat(*columns)
    return (
        docs.select("doc_id", _text_key(), words(fold(F.col("text")), SEPARATORS).alias("_w"))
        .withColumns(columns)
        .select(
            "doc_id",
            "text_key",
            F.size("_w").cast("bigint").alias("n_words"),
            F.size(places).cast("bigint").alias("n_base"),
            F.array_min(places).cast("bigint").alias("first_word"),
            F.array_max(places).cast("bigint").alias("last_word"),
            F.array_sort(F.array_distinct(F.array_compact(F.array(*held)))).alias("base"),
        )
    )


def template_matches(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, text_key, block (line number), label, containment of every line
    and template that meet the threshold; a null block is the best run of words of
    a text with line ends. Null or empty text has no block; the
    templates are code, so their join side is bounded by it."""
    spark = docs.sparkSession
    sets = [sorted(set(text.split(" "))) for _, text in templates]
    vocabulary = sorted(set().union(*sets))
    known = F.array(*map(F.lit, vocabulary))
    # one row per template word at most
    held = docs.select(
        F.explode(F.array_intersect(words(fold(F.col("text")), SEPARATORS), known)).alias("w")
    )
    df = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count("*").alias("n")).collect()}

    ordered = [sorted(s, key=lambda w: (df.get(w, 0), w)) for s in sets]
    need = [math.ceil(threshold * len(s)) for s in sets]
    index = [
        (w, at, words_, words_[:at], templates[t][0], need[t])
        for t, words_ in enumerate(ordered)
        for at, w in enumerate(words_[: len(words_) - need[t] + 1])
    ]
    index = spark.createDataFrame(
        index,
        "word string, at int, all array<string>, before array<string>, label string, need int",
    )
    blocks = (
        docs.select("doc_id", _text_key(), F.posexplode(F.split("text", "\n")))
        .select(
            "doc_id",
            "text_key",
            F.col("pos").alias("block"),
            F.array_distinct(words(fold(F.col("col")), SEPARATORS)).alias("tokens"),
        )
        .where(F.size("tokens") >= min(need))
    )
    hits = (
        blocks.select("*", F.explode("tokens").alias("word"))
        .join(F.broadcast(index), "word")
        .where("size(tokens) >= need")  # length
        .where("size(all) - at >= need")  # position: what can still be shared
        .where("not arrays_overlap(tokens, before)")  # one meeting for each pair
    )
    in_lines = hits.select(
        "doc_id",
        "text_key",
        "block",
        "label",
        (F.size(F.array_intersect("tokens", "all")) / F.size("all")).alias("containment"),
        "need",
        F.size(F.array_intersect("tokens", "all")).alias("shared"),
    ).where("shared >= need").drop("need", "shared")
    fixed = [
        F.struct(
            F.lit(label).alias("label"), F.array(*map(F.lit, words_)).alias("all"),
            F.array(*map(F.lit, words_[: len(words_) - n + 1])).alias("first"),
            F.lit(len(text.split(" "))).alias("length"), F.lit(n).alias("need"),
        )
        for (label, text), words_, n in zip(templates, ordered, need)
    ]
    return in_lines.unionByName(_runs(docs, F.array(*fixed), known))


def _runs(docs: DataFrame, templates: Column, known: Column) -> DataFrame:
    """The best run of words of every text with line ends and template that meet.
    Only runs around a word of the template's prefix, in texts that hold enough of
    its words, are compared."""
    enough = "filter(_templates, x -> size(array_intersect(_known, x.all)) >= x.need)"
    starts = "sequence(greatest(p - t.length + 1, 0), p)"
    shared = f"transform({starts}, s -> size(array_intersect(slice(_w, s + 1, t.length), t.all)))"
    at = "filter(sequence(0, size(_w) - 1), i -> array_contains(t.first, get(_w, i)))"
    return (
        docs.where(F.col("text").contains("\n"))
        .select("doc_id", _text_key(), words(fold(F.col("text")), SEPARATORS).alias("_w"))
        .select("*", F.array_intersect("_w", known).alias("_known"), templates.alias("_templates"))
        .select("doc_id", "text_key", "_w", F.explode(F.expr(enough)).alias("t"))
        .withColumn("shared", F.expr(f"array_max(transform({at}, p -> array_max({shared})))"))
        .where("shared >= t.need")
        .select(
            "doc_id", "text_key", F.lit(None).cast("int").alias("block"), "t.label",
            F.expr("shared / size(t.all)").alias("containment"),
        )
    )


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score.

    score is 1 with a phrase, else the highest containment found, else 0. Null
    and empty texts have no words, no labels and score 0. Repeated rows and null
    ids are kept; rows are told apart by id and text.
    """
    base = phrase_scan(docs)
    found = (
        template_matches(docs)
        .groupBy(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"))
        .agg(F.collect_set("label").alias("_labels"), F.max("containment").alias("_most"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("text_key").eqNullSafe(F.col("_key"))
    none = F.expr("cast(array() as array<string>)")
    return base.join(found, same, "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(
            F.array_sort(F.array_union("base", F.coalesce("_labels", none))), ","
        ).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_most", F.lit(0.0))).alias("score"),
    )


def _text_key() -> Column:
    return F.xxhash64("text").alias("text_key")
