"""License scans by diagonal voting of word k-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.arrays import U64, Block, pieces, prefix, rolling, runs_hash
from tessera.session import cut_lineage

# Phrases and labels of the base search.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Usual wordings of licences and notices.
TEMPLATES = {
    "mit": ["permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction including "
            "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
            "copies of the software",
            "released under the mit license"],
    "apache": ["licensed under the apache license version 2 0 the license you may not use this file except in "
               "compliance with the license you may obtain a copy of the license at",
               "licensed under the apache license version 2 0"],
    "gpl": ["this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation",
            "this work is licensed under the gnu general public license version 3"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "cc": ["this work is licensed under a creative commons attribution license", "licensed under cc by nc 4 0",
           "licensed under cc by sa 4 0", "licensed under cc by 4 0"],
}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _words(texts: list[bytes]):
    """A block of lower-case texts with its words: runs of digits, letters and bytes beyond ASCII."""
    block = Block([t.lower() for t in texts])
    edge = np.flatnonzero(np.diff(np.concatenate([[False], _WORD[block.bytes]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    low, high = np.searchsorted(starts, block.start), np.searchsorted(starts, block.end)
    return block, starts, ends, low, high


def _grams(texts: list[bytes], k: int):
    block, starts, ends, low, high = _words(texts)
    return block, starts, ends, low, high, rolling(prefix(runs_hash(block.byte_sums(), starts, ends)), k)


def template_grams(spark: SparkSession, phrases: dict[str, str], templates: dict[str, list[str]], k: int) -> DataFrame:
    """``gram, said, template, label, base, length, place``: every k-gram of every template, with its place."""
    rows = []
    listed = [(p, label, True) for p, label in phrases.items()]
    listed += [(t, label, False) for label, some in templates.items() for t in some]
    for number, (wording, label, base) in enumerate(listed):
        words = wording.split()
        if len(words) < k:
            raise ValueError(f"a template needs at least {k} words: {wording}")
        *_, grams = _grams([wording.encode()], k)
        rows += [(int(g.view(np.int64)), " ".join(words[i:i + k]), number, label, base, len(words), i)
                 for i, g in enumerate(grams)]
    return spark.createDataFrame(rows, "gram long, said string, template int, label string, base boolean, "
                                       "length int, place int")


def _hits(wanted: np.ndarray, k: int):
    """Batch function: words of each text and its k-grams whose hash is that of a template k-gram."""
    table = np.zeros(1 << 16, bool)
    table[(wanted >> U64(48)).astype(np.int64)] = True

    def run(batches):
        for batch in batches:
            for a, b, texts in pieces(batch.column(1)):
                block, starts, ends, low, high, grams = _grams(texts, k)
                at = np.flatnonzero(table[(grams >> U64(48)).astype(np.int64)])
                at = at[np.isin(grams[at], wanted)]
                text = np.searchsorted(low, at, side="right") - 1
                inside = at + k <= high[text]
                at, text = at[inside], text[inside]
                said = [" ".join(block.raw[starts[i + j]:ends[i + j]].decode("utf-8", "replace") for j in range(k))
                        for i in at.tolist()]
                hits = pa.StructArray.from_arrays([pa.array((at - low[text]).astype(np.int32)),
                                                   pa.array(grams[at].view(np.int64)), pa.array(said, pa.string())],
                                                  ["pos", "gram", "said"])
                cuts = np.searchsorted(text, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(high - low),
                     pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), hits)], ["doc_id", "n_words", "hits"])

    return run


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: dict[str, str] | None = None,
                  templates: dict[str, list[str]] | None = None, k: int = 2, slack: int = 3, least: float = 0.8
                  ) -> tuple[DataFrame, DataFrame]:
    """``(documents, spans)`` of a scan for base phrases and license wordings.

    Words are lower-cased (A-Z) runs of digits, letters and characters beyond ASCII. ``spans`` has a row for
    each place found: ``row, label, base, first, last, coverage``; base phrases stand word for word, other
    templates are covered to ``least`` at least. ``documents`` has ``doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score``; the score is the best coverage of any template.

    Method: all rolling word k-grams are joined to the template places of the same k-gram (by hash, then word
    for word). Votes are counted for each diagonal, word place less template place. Diagonals of a template
    at most ``slack`` apart are merged, which bridges words left out or put in, and each span is verified by
    the template words it covers. The templates' hashes also sift the k-grams before they leave the scan.

    Null texts count as empty and have no words; repeated rows are documents of their own; an empty table
    gives empty tables; other columns are not read.
    """
    spark = docs.sparkSession
    known = template_grams(spark, PHRASES if phrases is None else phrases,
                           TEMPLATES if templates is None else templates, k)
    listed = known.select("gram").distinct().toPandas()["gram"].to_numpy()
    wanted = np.sort(listed.astype(np.int64).view(np.uint64))
    kind = docs.schema[doc_id].dataType.simpleString()
    scanned = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(
        _hits(wanted, k), f"doc_id {kind}, n_words long, hits array<struct<pos:int, gram:long, said:string>>")
    scanned = cut_lineage(scanned.withColumn("row", F.monotonically_increasing_id()))
    votes = (scanned.select("row", F.explode("hits").alias("h")).select("row", "h.*")
             .join(F.broadcast(known), ["gram", "said"])  # the templates are parameters, not data
             .withColumn("diagonal", F.col("pos") - F.col("place"))
             .groupBy("row", "template", "label", "base", "length", "diagonal")
             .agg(F.collect_set("place").alias("places")))
    exact = (votes.filter(F.col("base") & (F.size("places") == F.col("length") - (k - 1)))
             .select("row", "label", "base", F.col("diagonal").alias("first"),
                     (F.col("diagonal") + F.col("length") - 1).alias("last"), F.lit(1.0).alias("coverage")))
    beside = Window.partitionBy("row", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(beside) > slack, F.lit(True)).cast("int")
    places = F.array_distinct(F.flatten(F.collect_list("places")))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        places, lambda p: F.sequence(p, p + F.lit(k - 1))))))
    merged = (votes.filter(~F.col("base")).withColumn("fresh", fresh)
              .withColumn("group", F.sum("fresh").over(beside))
              .groupBy("row", "template", "label", "base", "length", "group")
              .agg((F.min(F.col("diagonal") + F.array_min("places"))).alias("first"),
                   (F.max(F.col("diagonal") + F.array_max("places")) + k - 1).alias("last"),
                   (covered / F.first("length")).alias("coverage"))
              .filter(F.col("coverage") >= least)
              .select("row", "label", "base", "first", "last", "coverage"))
    spans = cut_lineage(exact.unionByName(merged))
    at = F.when(F.col("base"), F.col("first"))
    said = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    summary = spans.groupBy("row").agg(
        F.count(at).alias("n_base"), F.min(at).cast("bigint").alias("first_word"),
        F.max(at).cast("bigint").alias("last_word"), said(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        said("label").alias("labels"), F.max("coverage").alias("score"))
    documents = scanned.select("row", "doc_id", "n_words").join(summary, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
    return documents, spans


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, base phrases and usual licenses."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))[0]
