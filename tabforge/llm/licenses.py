"""License scans by diagonal voting.

Templates are word lists. Every rolling k-gram of a document's words that also stands in a template votes for the
diagonal "place in the document minus place in the template". Votes come from a Spark join of gram hashes to template
positions and are counted per document, template and diagonal; neighbouring diagonals of one template (a word added
or lost in between) merge into one span, and a span counts when the grams that voted for it cover enough of the
template. Before any vote counts, the words of the gram are compared with the template's words.

The base phrases are templates whose grams are the whole phrase: each vote is a place where the phrase stands.
The grams that documents send to the join are those whose hash is among the templates' (a test on a table of fixed
size); hashes decide only that, the join and the comparison of words decide the rest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import stored
from .words import Words, flat, gram, slices, words_of

# The base phrases and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Wording of well-known licenses and notices, and the label that each gives
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
GRAM = 3
SHARE = 0.8
DRIFT = 2

HITS = "array<struct<at:int,hash:long,words:string>>"


def gram_rows(base=None, templates=TEMPLATES, k: int = GRAM) -> list[tuple]:
    """(gram, template, label, base, place, n_words, n_grams, size): one row per gram of each template."""
    rows = []
    entries = [(phrase, label, True) for phrase, label in (BASE if base is None else base).items()]
    entries += [(text, label, False) for label, text in templates]
    for number, (text, label, is_base) in enumerate(entries):
        words = words_of(text)
        size = len(words) if is_base else min(k, len(words))
        for place in range(len(words) - size + 1):
            rows.append((" ".join(words[place : place + size]), number, label, is_base, place, len(words), len(words) - size + 1, size))
    return rows


def template_grams(spark: SparkSession, base=None, templates=TEMPLATES, k: int = GRAM) -> DataFrame:
    rows = [(gram_hash(r[0].split()), *r) for r in gram_rows(base, templates, k)]
    return spark.createDataFrame(
        rows, "hash long, gram string, template int, label string, base boolean, place int, n_words int, n_grams int, size int"
    )


def gram_hash(words: list[str]) -> int:
    own = Words(*flat(pa.array(words, pa.string())))
    return int(gram(own.hashes(), np.zeros(1, np.int64), len(words)).view(np.int64)[0])


def _hits(docs: DataFrame, doc_id: str, text: str, wanted: dict[int, np.ndarray]) -> DataFrame:
    """doc_id, n_words, hits: the grams of each document whose hash is wanted, per gram size."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, b, data, begins in slices(batch.column(1)):
                words = Words(data, begins)
                hashes = words.hashes()
                found: list[list] = [[] for _ in range(b - a)]
                raw = words.data
                for size, own in wanted.items():
                    at, h = words.grams(hashes, size)
                    hit = np.flatnonzero(np.isin(h, own, kind="sort") if len(h) else np.zeros(0, bool))
                    for i in hit.tolist():
                        first = int(at[i])
                        doc = int(np.searchsorted(words.first, first, side="right")) - 1
                        text_of = " ".join(raw[words.start[j] : words.end[j]].tobytes().decode() for j in range(first, first + size))
                        found[doc].append({"at": first - int(words.first[doc]), "hash": int(h[i].view(np.int64)), "words": text_of})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(words.count, pa.int64()),
                     pa.array(found, pa.list_(pa.struct([("at", pa.int32()), ("hash", pa.int64()), ("words", pa.string())])))],
                    names=["doc_id", "n_words", "hits"],
                )

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, n_words long, hits {HITS}")


def license_spans(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", base=None, templates=TEMPLATES, k: int = GRAM, share: float = SHARE,
    drift: int = DRIFT,
) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): one row per document row with a row number, and the verified spans of each.

    A span has label, base, start, stop (word positions) and score, the share of the template's grams that voted for
    it. Base phrases need all; other templates ``share`` of them, over diagonals at most ``drift`` apart. Missing
    texts have no words; repeated rows get their own row numbers and equal results.
    """
    spark = docs.sparkSession
    table = template_grams(spark, base, templates, k)
    sizes: dict[int, list[int]] = {}
    for r in table.select("size", "hash").distinct().collect():  # as many rows as the given templates have grams
        sizes.setdefault(r["size"], []).append(r["hash"])
    wanted = {size: np.unique(np.array(h, np.int64).view(np.uint64)) for size, h in sizes.items()}
    found = stored(_hits(docs, doc_id, text, wanted).withColumn("row", F.monotonically_increasing_id()))
    votes = found.select("row", F.explode("hits").alias("h")).select("row", F.col("h.at").alias("at"), F.col("h.hash").alias("hash"), F.col("h.words").alias("gram"))
    voted = votes.join(F.broadcast(table), ["hash", "gram"]).withColumn("diagonal", F.col("at") - F.col("place"))
    by_diagonal = voted.groupBy("row", "template", "label", "base", "n_words", "n_grams", "diagonal").agg(
        F.count_distinct("place").alias("votes"), F.min("at").alias("start"), F.max(F.col("at") + F.col("size")).alias("stop")
    )
    same = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("base") | F.coalesce(F.col("diagonal") - F.lag("diagonal").over(same) > drift, F.lit(True))
    numbered = by_diagonal.withColumn("_new", apart.cast("int")).withColumn("_group", F.sum("_new").over(same))
    spans = numbered.groupBy("row", "template", "label", "base", "n_grams", "_group").agg(
        F.sum("votes").alias("votes"), F.min("start").alias("start"), F.max("stop").alias("stop")
    ).withColumn("score", F.least(F.lit(1.0), F.col("votes") / F.col("n_grams")))
    return found.drop("hits"), spans.where(F.col("score") >= F.when(F.col("base"), F.lit(1.0)).otherwise(F.lit(share))).select(
        "row", "label", "base", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), "score"
    )


def license_summary(docs: DataFrame, **options) -> DataFrame:
    """Per document row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans."""
    rows, spans = license_spans(docs, **options)
    base = F.col("base")
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    per_row = spans.groupBy("row").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"), F.max(F.when(base, F.col("start"))).alias("last_word"),
        names(F.when(base, F.col("label"))).alias("base_labels"), names("label").alias("labels"), F.max("score").alias("score"),
        F.array_sort(F.collect_set(F.struct("start", "stop", "label"))).alias("spans"),
    )
    return rows.join(per_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("spans", F.array().cast("array<struct<start:long,stop:long,label:string>>")).alias("spans"),
    )
