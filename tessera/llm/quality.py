"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.arrays import U64, Block, mix, pieces, prefix, runs_hash
from tessera.session import cut_lineage

SAMPLE_ROWS = 20_000

# Byte classes counted for each document.
_GROUPS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\v\f", "\n", ".", ",",
           "!", "|", "%$&*#", "?;:'\"()-", "@/\\_+=<>~^`[]{}"]
_CLASS = np.full(256, len(_GROUPS), np.int64)
for _i, _g in enumerate(_GROUPS):
    _CLASS[list(_g.encode())] = _i
_CLASS[128:] = len(_GROUPS) + 1
_KINDS = len(_GROUPS) + 2
FEATURES = _KINDS + 12


def _share(values: np.ndarray, owner: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """For each document the share of distinct values, and of its most frequent one."""
    size = np.bincount(owner, minlength=count)
    order = np.argsort(values ^ mix(owner.astype(np.uint64) + U64(1)))  # equal pairs meet
    owner, values = owner[order], values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(fresh)
    runs = np.diff(np.append(at, len(values)))
    most = np.zeros(count)
    np.maximum.at(most, owner[at], runs)
    safe = np.maximum(size, 1)
    return np.bincount(owner[at], minlength=count) / safe, most / safe


def statistics(block: Block) -> np.ndarray:
    """One row of ``FEATURES`` numbers for each text of the block."""
    n = len(block.start)
    owner = np.repeat(np.arange(n), block.end - block.start + 1)
    kinds = np.bincount(owner * _KINDS + _CLASS[block.bytes], minlength=n * _KINDS).reshape(n, _KINDS).astype(float)
    kinds[:, _GROUPS.index("\n")] -= 1  # the separator
    size = np.maximum(block.end - block.start, 1)[:, None]
    starts, ends, low, high = block.words()
    sums = block.byte_sums()
    words = runs_hash(sums, starts, ends)
    of_word = np.repeat(np.arange(n), high - low)
    count = np.maximum(high - low, 1)
    distinct, most = _share(words, of_word, n)
    same = np.zeros(len(words))
    same[1:] = (words[1:] == words[:-1]) & (of_word[1:] == of_word[:-1])
    three = np.zeros(0, np.uint64)
    if len(words) > 2:
        run = prefix(words)
        three = runs_hash(run, np.arange(len(words) - 2), np.arange(3, len(words) + 1))
    inside = of_word[:-2] == of_word[2:] if len(words) > 2 else np.zeros(0, bool)
    distinct3, most3 = _share(three[inside], of_word[:-2][inside] if len(words) > 2 else of_word[:0], n)
    feeds = np.flatnonzero(block.bytes == 10)
    begin = np.append(0, feeds[:-1] + 1)
    full = feeds > begin
    of_line = np.searchsorted(block.start, begin[full], side="right") - 1
    distinct_l, most_l = _share(runs_hash(sums, begin[full], feeds[full]), of_line, n)
    last = block.bytes[ends - 1] if len(ends) else block.bytes[:0]
    marked = np.isin(_CLASS[last], [_GROUPS.index(g) for g in ("!", "|", "%$&*#")])
    lengths = (ends - starts).astype(float)
    mean = np.bincount(of_word, lengths, n) / count
    spread = np.sqrt(np.maximum(np.bincount(of_word, lengths ** 2, n) / count - mean ** 2, 0))
    more = [np.log1p(high - low), mean, spread, distinct, most, np.bincount(of_word, same, n) / count,
            distinct3, most3, distinct_l, most_l, np.bincount(of_word, marked, n) / count,
            np.bincount(of_line, minlength=n) / count]
    return np.concatenate([kinds / size, np.stack(more, axis=1)], axis=1)


def _describe(batches):
    for batch in batches:
        for a, b, texts in pieces(batch.column(1)):
            stats = statistics(Block(texts)).astype(np.float32)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * FEATURES, pa.int32()), pa.array(stats.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), flat], ["row", "stats"])


@dataclass
class Trees:
    """Complete trees of one depth as flat arrays: node ``i`` has children ``2i + 1`` and ``2i + 2``."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2 ** self.depth - 1)]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64,
              ridge: float = 1.0, least: float = 1.0) -> Trees:
    """Boosted trees on the logistic loss; splits are searched on histograms of binned features.

    Without rows the score is 0.5 everywhere.
    """
    inner, ends = 2 ** depth - 1, 2 ** depth
    rate0 = (y.sum() + 1) / (len(y) + 2)
    model = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, ends)),
                  float(np.log(rate0 / (1 - rate0))), depth)
    if not len(x):
        return model
    edges = np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0).T
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)
    width, total = x.shape[1], np.full(len(x), model.start)
    shift = np.arange(width) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, bend = y - p, p * (1 - p)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, n = 2 ** level - 1, 2 ** level
            cell = ((node - first)[:, None] * (width * bins) + shift + binned).ravel()
            g, h = (np.bincount(cell, np.repeat(v, width), n * width * bins).reshape(n, width, bins).cumsum(2)
                    for v in (slope, bend))
            gain = lambda a, b: a * a / (b + ridge)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            won = gain(g, h) + gain(all_g - g, all_h - h) - gain(all_g, all_h)
            won[(h < least) | (all_h - h < least)] = 0
            best = won[:, :, :-1].reshape(n, -1).argmax(1)
            for i, b in enumerate(best):
                f, at = divmod(int(b), bins - 1)
                if won[i, f, at] > 1e-9:
                    model.feature[t, first + i], model.cut[t, first + i] = f, edges[f, at]
            node = 2 * node + 1 + (x[np.arange(len(x)), model.feature[t, node]] > model.cut[t, node])
        end = node - inner
        g, h = np.bincount(end, slope, ends), np.bincount(end, bend, ends)
        model.leaf[t] = rate * g / (h + ridge)
        total += model.leaf[t][end]
    return model


def score_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  label: str = "quality", carry: list[str] | None = None, cut: float = 0.3,
                  sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``row, held_out, score, predicted``: the chance that a document is good, from its text alone.

    ``row`` is a struct of the ``carry`` columns (default the id). Statistics of every whole text are taken
    by numpy on Arrow batches and stored once. Trees are fitted on labelled rows that are not held out
    (crc32 of the id as text, modulo 5, is not 0): at most ``sample_rows`` of them, those with the least
    hash of the id. The flattened trees are broadcast and score all rows.

    Null texts count as empty and are scored too; several labels of one id count by their mean; labels other
    than 0 and 1, or of unknown ids, are not used; without labels every score is 0.5; repeated rows get
    equal scores; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    row = F.struct(*[F.col(c) for c in carry or [doc_id]]).alias("row")
    schema = docs.select(row).schema
    described = docs.select(row, F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(doc_id).alias("id"))
    held = F.pmod(F.crc32(F.coalesce(F.col(f"row.`{doc_id}`").cast("string"), F.lit(""))), F.lit(5)) == 0
    stats = cut_lineage(described.mapInArrow(_describe, schema.add("stats", T.ArrayType(T.FloatType())))
                        .withColumn("held_out", held))
    marks = (labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("__id"))
             .agg((F.avg(label) >= 0.5).cast("int").alias("y")))
    known = (stats.filter(~F.col("held_out")).join(marks, F.col(f"row.`{doc_id}`") == F.col("__id"))
             .select("__id", "stats", "y").orderBy(F.xxhash64("__id"), "__id").limit(sample_rows).toArrow())
    x = known["stats"].combine_chunks().flatten().to_numpy().reshape(-1, FEATURES).astype(np.float64)
    trees = fit_trees(x, known["y"].to_numpy().astype(np.float64))
    # plain arrays are sent: the workers need not have this package
    model = spark.sparkContext.broadcast((trees.feature, trees.cut, trees.leaf, trees.start, trees.depth))

    def apply(batches):
        own = Trees(*model.value)
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy().reshape(-1, FEATURES).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(own.score(flat))],
                                             ["row", "held_out", "score"])

    scored = stats.select("row", "stats", "held_out").mapInArrow(
        apply, docs.select(row).schema.add("held_out", "boolean").add("score", "double"))
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, trained on the labels."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score_quality(docs, labels).select("row.doc_id", "held_out", "score", "predicted")
