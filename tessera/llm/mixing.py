"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ordering import number_rows
from tessera.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """``source, source_size, target`` from rows of (source, source_size).

    Sources in code point order, null last, take the weights in turn and share the sum of all sizes by
    weight. A target stops at ``cap`` times its source's size and the excess is shared again by weight among
    the others until none is above. Each round is one aggregate; only the common level comes to the driver.
    """
    ranked = cut_lineage(number_rows(sizes, [], ["source"], "__rank"))
    turn = ((F.col("__rank") - 1) % len(weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    most = F.col("source_size") * F.lit(float(cap))
    level, total = 0.0, ranked.agg(F.sum("source_size")).head()[0] or 0
    while total:
        full = F.lit(level) * weight > most
        held, free = ranked.agg(F.sum(F.when(full, most).otherwise(0.0)),
                                F.sum(F.when(full, 0.0).otherwise(weight))).head()
        raised = (total - held) / free if free else level
        if raised <= level:
            break
        level = raised
    return ranked.select("source", "source_size", F.least(most, F.lit(level) * weight).alias("target"))


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, seed: str = "mix") -> DataFrame:
    """How often each document is taken so that each source comes near its target of words.

    Output: ``doc_id, size, source, source_size, target, copies, taken`` and ``text_hash``; ``copies`` is at
    most ``cap`` rounded up and ``taken = copies * size``. Every document of a source expects
    ``target / source_size`` copies. Their prefix sums run over the source's documents by size, so taken
    words differ from the target by little; one offset in [0, 1), a function of source and seed, is added,
    and each whole number crossed is one copy. Places come from a range sort of narrow rows with counts per
    range, so a source with most of the rows meets no single task.

    Null texts and texts without words have size 0; a source of size 0 has target 0 and no copies; a null
    source is a source of its own; repeated rows are separate documents; an empty table gives an empty
    table. Other columns are not read.
    """
    sized = cut_lineage(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint").alias("size"),
        F.xxhash64(text).alias("text_hash")))
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    placed = cut_lineage(number_rows(sized, [], ["source", "size", "doc_id", "text_hash"], "__place", hot_rows=0))
    first = placed.groupBy("source").agg((F.min("__place") - 1).alias("__before")).withColumnRenamed("source", "__s")
    plan = cut_lineage(targets.join(first, F.col("source").eqNullSafe(F.col("__s"))).drop("source"))
    offset = F.conv(F.substring(F.md5(F.concat(F.coalesce("source", F.lit("")), F.lit(seed))), 1, 8), 16, 10)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    place = F.col("__place") - F.col("__before")
    shift = offset.cast("double") / 4294967296.0
    copies = F.floor(place * expected + shift) - F.floor((place - 1) * expected + shift)
    return (placed.join(plan, F.col("source").eqNullSafe(F.col("__s")))
            .select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).alias("taken"), "text_hash"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, weights 1, 2, 3, targets of at most three times a source."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             (1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3)::DOUBLE AS w
      FROM d GROUP BY source),
o AS (SELECT w, 3.0::DOUBLE * source_size AS most, row_number() OVER (ORDER BY 3.0 * source_size / w, source) AS k FROM s),
l AS (SELECT k, w, most, ((SELECT sum(source_size) FROM s)
             - coalesce(sum(most) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
t AS (SELECT source, source_size, least(3.0::DOUBLE * source_size,
             w * (SELECT level FROM l WHERE level * w <= most ORDER BY k LIMIT 1)) AS target,
             ('0x' || substr(md5(coalesce(source, '') || 'mix'), 1, 8))::UBIGINT / 4294967296.0::DOUBLE AS shift FROM s),
p AS (SELECT doc_id, size, source_size, target, shift,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS e,
             row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS i
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(i * e + shift) - floor((i - 1) * e + shift)) * size)::BIGINT AS taken FROM p"""
