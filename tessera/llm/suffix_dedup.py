"""Suffix-array dedup: bytes that lie in a repeated byte string of a given length are removed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.arrays import pieces
from tessera.llm.repeats import Windows, cover_mask, repeated_spans, text_key
from tessera.llm.suffix_order import difference_cover
from tessera.llm.tables import broadcast_if_small


def windows_plan(length: int) -> Windows:
    """Cover, sample length and minimiser length for strings of ``length`` bytes."""
    if length < 16:
        raise ValueError("strings of at least 16 bytes")
    order = max(q for q in (2, 3, 5, 7, 11, 13) if q == 2 or q * q + q + 1 <= length // 2)
    period, residues = difference_cover(order)
    return Windows(False, length, max(4, min(32, length // 4)), (period, residues, length - period + 1), 64)


def _cut(width: int, names: list[str], whole: str, schema: T.StructType, as_text: bool):
    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for a, b, texts in pieces(column["__text"], 4 << 20):
                kept, counts = [], []
                for text, found in zip(texts, column["__spans"].slice(a, b - a).to_pylist()):
                    covered = cover_mask(len(text), found, width)
                    edge = np.diff(covered.astype(np.int8), prepend=0)
                    kept.append(np.frombuffer(text, np.uint8)[~covered].tobytes() if found else text)
                    counts.append((len(text), int(covered.sum()), int((edge == 1).sum())))
                if as_text:
                    kept = [k.decode("utf-8", "ignore") for k in kept]
                own = [column["__text" if n == whole else n].slice(a, b - a) for n in names]
                numbers = [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
                left = pa.array(kept, pa.string() if as_text else pa.binary())
                yield pa.RecordBatch.from_arrays([*own, *numbers, left], schema=target)

    return run


def remove_repeats(docs: DataFrame, text: str = "text", carry: list[str] | None = None, length: int = 400,
                   as_text: bool = False, **options) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts anywhere else.

    Output: the ``carry`` columns (default ``doc_id``), ``n_bytes``, ``n_removed``, ``n_spans`` (maximal
    removed runs) and ``kept``, the remaining bytes in one piece (with ``as_text`` as a string, less characters
    that were cut in two). Texts are UTF-8 bytes and matches never
    cross documents; strings are judged on the input, so all copies of a repeated string go.

    Method: positions at the residues of a difference cover are the sample; two equal strings always meet at a
    pair of sample positions, wherever they start, so a string none of whose samples is seen twice is dropped.
    Suffixes that are left go to buckets by minimiser, neighbours in one packed string; a bucket is a text of its
    own. Its suffixes are sorted a block at a time, blocks by their first eight bytes: first by one period of
    bytes, then, in long ties, by ranks of the bucket's cover samples, which are made before
    (:mod:`tessera.llm.suffix_order`). Equal strings are then neighbours, told by their bytes. Suffixes under a
    minimiser of more than ``hot_strings`` strings travel as 128-bit hashes instead of text and are compared by
    them, dealt to buckets by hash, so no bucket outgrows a task; see :mod:`tessera.llm.repeats`.

    Null texts count as empty, texts shorter than ``length`` stay whole, repeated rows are documents of
    their own (and so remove each other), an empty table gives an empty table. Other columns are left out
    unless carried; a carried column may not have the name of an output.
    """
    names = carry or ["doc_id"]
    plan = windows_plan(length)
    spans = repeated_spans(docs, text, plan, **options)
    size = F.aggregate("__spans", F.lit(16), lambda n, part: n + F.octet_length(part) + 16)
    spans = broadcast_if_small(spans, size)
    sent = [n for n in names if n != text]
    keyed = docs.select(*[F.col(n) for n in sent], F.col(text).alias("__text"), *text_key(F.col(text)))
    joined = keyed.join(spans, ["__k1", "__k2"], "left").select(*sent, "__text", "__spans")
    schema = T.StructType([*[docs.schema[n] for n in names], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                           T.StructField("kept", T.StringType() if as_text else T.BinaryType())])
    return joined.mapInArrow(_cut(length, names, text, schema, as_text), schema)


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, strings of 400 bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                       F.sha2("kept", 256).alias("kept_sha256"))


# Hexadecimal text stands for bytes, as SQL has no substring of a blob.
OP6_SQL = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n,
                  row_number() OVER () AS rid FROM documents),
w AS (SELECT rid, p, hash(substr(h, 2 * p + 1, 800)) AS m
      FROM (SELECT rid, h, unnest(range(0, n - 399)) AS p FROM t WHERE n >= 400)),
r AS (SELECT rid, p FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
g AS (SELECT rid, p, sum(fresh) OVER (PARTITION BY rid ORDER BY p) AS run
      FROM (SELECT rid, p, CASE WHEN p - lag(p) OVER (PARTITION BY rid ORDER BY p) <= 400 THEN 0 ELSE 1 END AS fresh
            FROM r)),
s AS (SELECT rid, run, min(p) AS a, max(p) + 400 AS b FROM g GROUP BY rid, run),
k AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before,
             row_number() OVER (PARTITION BY rid ORDER BY a DESC) AS back FROM s),
e AS (SELECT rid, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS tail,
             list(struct_pack(x := before, y := a) ORDER BY a) AS kept FROM k GROUP BY rid)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN kept IS NULL THEN h
                         ELSE array_to_string(list_transform(kept, lambda z: substr(h, 2 * z.x + 1, 2 * (z.y - z.x))), '')
                              || substr(h, 2 * tail + 1) END)) AS kept_sha256
FROM t LEFT JOIN e USING (rid)"""
