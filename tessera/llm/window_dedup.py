"""Substring dedup by super-k-mers: words that lie in a repeated window of words are removed."""

from __future__ import annotations

import itertools

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.arrays import pieces
from tessera.llm.repeats import Windows, cover_mask, repeated_spans, text_key


def _cut(width: int, names: list[str], schema: T.StructType):
    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for a, b, texts in pieces(column["__text"], 4 << 20):
                kept, counts = [], []
                for text, found in zip(texts, column["__spans"].slice(a, b - a).to_pylist()):
                    words = text.split()
                    covered = cover_mask(len(words), found, width)
                    left = itertools.compress(words, (~covered).tolist()) if found else words
                    kept.append(b" ".join(left).decode())
                    counts.append((len(words), int(covered.sum())))
                own = [column[n].slice(a, b - a) for n in names]
                numbers = [pa.array([c[i] for c in counts], pa.int64()) for i in range(2)]
                yield pa.RecordBatch.from_arrays([*own, *numbers, pa.array(kept, pa.string())], schema=target)

    return run


def remove_repeated_windows(docs: DataFrame, text: str = "text", carry: list[str] | None = None, width: int = 35,
                            gram: int = 10, **options) -> DataFrame:
    """Remove each word covered by a window of ``width`` words that also starts anywhere else.

    Output: the ``carry`` columns (default ``doc_id``), ``n_words``, ``n_removed`` and ``kept``, the words
    that are left, joined by one space. Words are runs of characters other than ASCII white space, unchanged.

    Method: the minimiser of a window is the least hash among its runs of ``gram`` words. Neighbouring
    windows under one minimiser travel to its bucket as one packed string (a super-k-mer), where sorting
    counts the windows exactly; see :mod:`tessera.llm.repeats`. Minimisers that occur once in the corpus are
    not sent, since their windows occur once.

    Null texts have no words, texts of fewer than ``width`` words stay whole, repeated rows are documents of
    their own, an empty table gives an empty table. Columns that are not carried are left out.
    """
    names = carry or ["doc_id"]
    spans = repeated_spans(docs, text, Windows(True, width, min(gram, width)), **options)
    keyed = docs.select(*[F.col(n) for n in names], F.col(text).alias("__text"), *text_key(F.col(text)))
    joined = keyed.join(spans, ["__k1", "__k2"], "left").select(*names, "__text", "__spans")
    schema = T.StructType([*[docs.schema[n] for n in names], T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return joined.mapInArrow(_cut(width, names, schema), schema)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, windows of 35 words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeated_windows(docs).select("doc_id", "n_words", "n_removed",
                                                F.sha2(F.col("kept"), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  row_number() OVER () AS rid FROM documents),
p AS (SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS m
      FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM t WHERE len(w) >= 35)),
r AS (SELECT rid, i FROM p WHERE m IN (SELECT m FROM p GROUP BY m HAVING count(*) > 1)),
c AS (SELECT rid, list(DISTINCT j) AS gone FROM (SELECT rid, unnest(range(i, i + 35)) AS j FROM r) GROUP BY rid),
k AS (SELECT rid, array_to_string(list(w[j] ORDER BY j), ' ') AS kept
      FROM (SELECT rid, w, gone, unnest(range(1, len(w) + 1)) AS j FROM t JOIN c USING (rid))
      WHERE NOT list_contains(gone, j) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept, '') END) AS kept_sha256
FROM t LEFT JOIN c USING (rid) LEFT JOIN k USING (rid)"""
