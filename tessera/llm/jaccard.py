"""N-gram Jaccard join: MinHash banding for candidates, full n-gram sets for the verdict."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.arrays import U64, Block, mix, pieces, prefix, runs_hash
from tessera.llm.graph import components
from tessera.llm.repeats import text_key
from tessera.llm.tables import broadcast_if_small
from tessera.session import cut_lineage

BLOCK_SHINGLES = 150_000
DOC_COST = 100
#: Bytes of the keys of all texts that met another, up to which only these texts are shuffled.
KEY_BYTES = 8 << 20


def choose_bands(threshold: float = 0.8, recall: float = 0.9999, most_hashes: int = 192) -> tuple[int, int]:
    """``(bands, rows)``: the most rows a band for which a pair at the threshold is met with ``recall``.

    More rows bring fewer false candidates; the bands needed are ``log(1 - recall) / log(1 - t^rows)``.
    """
    best = (1, 1)
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-min(threshold ** rows, 1 - 1e-12)))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    return best


def shingle_sets(block: Block, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of ``n`` words; a shorter text is one run."""
    starts, ends, low, high = block.words()
    words = runs_hash(block.byte_sums(), starts, ends)
    sums = prefix(words)
    first = np.arange(max(0, len(words) - n + 1))
    runs = runs_hash(sums, first, first + n)
    out = []
    for a, b in zip(low.tolist(), high.tolist()):
        out.append(np.unique(runs[a:b - n + 1]) if b - a >= n
                   else runs_hash(sums, np.array([a]), np.array([b])) if b > a else runs[:0])
    return out


class Bands:
    """MinHash of a set by multiply-add hashes, folded to one value for each band."""

    def __init__(self, bands: int, rows: int):
        draw = np.random.default_rng(11)
        self.shape = (bands, rows)
        self.factor = draw.integers(1, 1 << 63, bands * rows, dtype=np.uint64)[:, None] * U64(2) + U64(1)
        self.shift = draw.integers(1, 1 << 63, bands * rows, dtype=np.uint64)[:, None]
        self.fold = draw.integers(1, 1 << 63, rows, dtype=np.uint64) * U64(2) + U64(1)
        self.name = mix(np.arange(bands, dtype=np.uint64) + U64(1))

    def __call__(self, values: np.ndarray) -> np.ndarray:
        least = np.full(self.factor.shape[0], np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(values), 512):
            np.minimum(least, (self.factor * values[i:i + 512] + self.shift).min(axis=1), out=least)
        rows = mix(least).reshape(self.shape) * self.fold
        return mix(rows.sum(axis=1, dtype=np.uint64) + self.name).view(np.int64)


def _signatures(n: int, bands: int, rows: int):
    def run(batches):
        hashes = Bands(bands, rows)
        for batch in batches:
            for a, b, texts in pieces(batch.column(1)):
                out = []
                for values in shingle_sets(Block(texts), n):
                    size = len(values)
                    one, two = (int(mix(values + U64(s)).sum(dtype=np.uint64).view(np.int64)) for s in (1, 2))
                    out.append((one, two, size, hashes(values) if size else None))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(3), *[pa.array([o[i] for o in out], t) for i, t in
                     enumerate((pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())))]],
                    ["doc_id", "__k1", "__k2", "s1", "s2", "size", "bands"])

    return run


_MEMBER = "comp long, block int, blocks int, node long, copies long, shingles binary, bands binary"
_PAIR = "a long, b long, similarity double"
_LINKED = "node long, links long, root long, whole boolean"


def _members(n: int, bands: int, rows: int):
    def run(batches):
        hashes = Bands(bands, rows)
        for batch in batches:
            for a, b, texts in pieces(batch.column(0)):
                sets = shingle_sets(Block(texts), n)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in range(1, 6)], pa.array([v.tobytes() for v in sets], pa.binary()),
                     pa.array([hashes(v).tobytes() for v in sets], pa.binary())],
                    ["comp", "block", "blocks", "node", "copies", "shingles", "bands"])

    return run


def _verify(threshold: float, pairs: bool):
    """Function of one pair of blocks: exact similarity of all candidates, counts and a spanning forest.

    The forest points at the least node of each tree; it is ``whole`` if its group has no other block.
    """

    def run(table: pa.Table) -> pa.Table:
        node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        block = table["block"].to_numpy()
        crossed = table["lo"][0].as_py() != table["hi"][0].as_py()
        sets = [np.frombuffer(v.as_py(), np.uint64) for v in table["shingles"]]
        size = np.array([len(v) for v in sets])
        at = np.concatenate([[0], np.cumsum(size)])
        _, index = np.unique(np.concatenate(sets), return_inverse=True)
        marks = np.zeros(int(index.max()) + 1, bool)
        bands = np.stack([np.frombuffer(v.as_py(), np.int64) for v in table["bands"]])
        count = len(node)
        groups = []
        for column in bands.T:
            order = np.argsort(column, kind="stable")
            ordered = column[order]
            groups.append((order, np.searchsorted(ordered, column), np.searchsorted(ordered, column, side="right")))
        links, parent, said = np.zeros(count, np.int64), np.arange(count), []

        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for a in range(count):
            met = [order[lo[a]:hi[a]] for order, lo, hi in groups if hi[a] - lo[a] > 1]
            if not met:
                continue
            other = np.unique(np.concatenate(met))
            other = other[other > a]
            if crossed:
                other = other[block[other] != block[a]]
            other = other[np.minimum(size[other], size[a]) >= threshold * np.maximum(size[other], size[a]) - 1e-9]
            if not len(other):
                continue
            marks[index[at[a]:at[a + 1]]] = True
            for some in np.array_split(other, -(-int(size[other].sum()) // 4_000_000)):
                n = size[some]
                spots = np.repeat(at[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
                common = np.add.reduceat(marks[index[spots]].astype(np.int64), np.cumsum(n) - n)
                like = common / (size[a] + n - common)
                close = some[like >= threshold - 1e-12]
                links[a] += copies[close].sum()
                links[close] += copies[a]
                for c in close.tolist():
                    x, y = root(a), root(c)
                    if x != y:
                        parent[max(x, y)] = min(x, y)
                if pairs:
                    said += [(node[a], node[c], s) for c, s in zip(close, like[like >= threshold - 1e-12])]
            marks[index[at[a]:at[a + 1]]] = False
        if pairs:
            return pa.table({"a": pa.array([min(x[:2]) for x in said], pa.int64()),
                             "b": pa.array([max(x[:2]) for x in said], pa.int64()),
                             "similarity": pa.array([x[2] for x in said], pa.float64())})
        linked = np.flatnonzero(links)
        tree = np.array([root(i) for i in linked.tolist()], np.int64)
        least = node.copy()
        np.minimum.at(least, tree, node[linked])
        return pa.table({"node": pa.array(node[linked]), "links": pa.array(links[linked]), "root": pa.array(least[tree]),
                         "whole": pa.array(np.full(len(linked), table["blocks"][0].as_py() == 1))})

    return run


class JaccardJoin:
    """The steps of the join over one table; :func:`near_duplicates` gives its usual result."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5,
                 threshold: float = 0.8, recall: float = 0.9999, block_shingles: int = BLOCK_SHINGLES):
        self.n, self.threshold, self.block_shingles = n, threshold, block_shingles
        self.bands, self.rows = choose_bands(threshold, recall)
        lower = F.lower(F.coalesce(F.col(text), F.lit("")))
        self.texts = docs.select(lower.alias("text"), *text_key(lower))
        ids = docs.select(F.col(doc_id).alias("doc_id"), lower.alias("text"), *text_key(lower))
        kind = docs.schema[doc_id].dataType.simpleString()
        self.signed = cut_lineage(ids.mapInArrow(
            _signatures(n, self.bands, self.rows),
            f"doc_id {kind}, __k1 long, __k2 long, s1 long, s2 long, size int, bands array<long>"))
        self.count = self.signed.count()
        # one node for each distinct set, so exact copies never make pairs
        self.nodes = cut_lineage(self.signed.filter("size > 0").groupBy("s1", "s2").agg(
            F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"),
            F.min(F.struct("__k1", "__k2")).alias("k"), F.first("bands").alias("bands"))
            .withColumnRenamed("s1", "node"), self.count)

    def _checked(self, pairs: bool) -> DataFrame:
        spread = self.nodes.select("node", F.explode("bands").alias("bucket"))
        shared = cut_lineage(spread.groupBy("bucket").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("n"))
                             .filter("n > 1").select("bucket", "lead"), self.count * self.bands)
        near = components(spread.join(broadcast_if_small(shared, 16), "bucket")
                          .select(F.col("node").alias("a"), F.col("lead").alias("b")), self.count * self.bands)
        near = broadcast_if_small(near.withColumnRenamed("root", "comp"), 16)
        near = cut_lineage(self.nodes.drop("bands").join(near, "node"), self.count)
        cost = F.sum(F.col("size") + F.lit(DOC_COST))
        blocks = F.ceil(cost / F.lit(self.block_shingles)).cast("int").alias("blocks")
        blocks = cut_lineage(near.groupBy("comp").agg(blocks), self.count)
        plan = cut_lineage(near.join(broadcast_if_small(blocks, 12), "comp").select(
            F.col("k.__k1").alias("__k1"), F.col("k.__k2").alias("__k2"), "comp",
            F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), "blocks", "node", "copies"), self.count)
        keys, texts = plan.select("__k1", "__k2"), self.texts
        if plan.count() * 16 <= KEY_BYTES:
            texts = texts.join(F.broadcast(keys), ["__k1", "__k2"], "left_semi")
        once = texts.groupBy("__k1", "__k2").agg(F.first("text").alias("text"))
        members = once.join(plan, ["__k1", "__k2"]).select("text", "comp", "block", "blocks", "node", "copies")
        members = members.mapInArrow(_members(self.n, self.bands, self.rows), _MEMBER)
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        cells = members.select("*", other.alias("other")).select(
            "comp", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "blocks",
            "node", "copies", "shingles", "bands")
        return cells.groupBy("comp", "lo", "hi").applyInArrow(_verify(self.threshold, pairs), _PAIR if pairs else _LINKED)

    def pairs(self) -> DataFrame:
        """``a, b, similarity``: the least ids of two distinct sets at or above the threshold (any number of rows)."""
        names = self.nodes.select("node", "least_id")
        found = self._checked(True)
        left = found.join(names, found.a == names.node).drop("node", "a").withColumnRenamed("least_id", "a")
        both = left.join(names, left.b == names.node).drop("node", "b").withColumnRenamed("least_id", "b")
        return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "similarity")

    def classes(self) -> DataFrame:
        """``doc_id, class_id, n_links`` for every row."""
        found = cut_lineage(self._checked(False))
        # a group of one block comes as its whole trees; those of other groups are put together
        trees = components(found.filter("NOT whole").select(F.col("node").alias("a"), F.col("root").alias("b")))
        links = cut_lineage(found.groupBy("node").agg(
            F.sum("links").alias("links"), F.max(F.when(F.col("whole"), F.col("root"))).alias("own")), self.count)
        known = cut_lineage(self.nodes.select("node", "s2", "least_id", "copies")
                            .join(broadcast_if_small(links, 24), "node", "left")
                            .join(broadcast_if_small(trees, 16), "node", "left")
                            .withColumn("root", F.coalesce("root", "own", "node")), self.count)
        named = known.filter("links IS NOT NULL").groupBy("root").agg(F.min("least_id").alias("class_id"))
        named = cut_lineage(named, self.count)
        named = broadcast_if_small(named, F.length(F.to_json(F.struct("root", "class_id"))))
        facts = cut_lineage(known.join(named, "root", "left").select(
            F.col("node").alias("s1"), "s2", F.coalesce("class_id", "least_id").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), self.count)
        joined = self.signed.select("doc_id", "s1", "s2", "size").join(facts, ["s1", "s2"], "left")
        alone = F.col("size") == 0
        return joined.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                             F.when(alone, 0).otherwise(F.col("n_links")).cast("bigint").alias("n_links"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8,
                    recall: float = 0.9999, **options) -> DataFrame:
    """``doc_id, class_id, n_links``: one row for each document.

    Two documents are linked when the Jaccard similarity of their sets of ``n``-word runs (lower case, words
    between white space) is at least ``threshold``. ``n_links`` is the number of other documents linked to
    this one, copies included; a class holds all documents joined by links and is named by its least id.

    Method: equal sets are one node. MinHash bands, chosen so that a pair at the threshold meets in one with
    probability ``recall``, shuffle narrow rows to buckets. Nodes that meet are grouped, groups are cut into
    blocks of bounded size, and each pair of blocks is checked on full sets by one task, which returns counts
    and a spanning forest instead of pairs; so large groups of near copies make no quadratic number of rows.

    Texts of fewer than ``n`` words are one run. Null texts and texts without words have no links and a class
    of their own. Repeated rows are linked copies. Null ids take part; a class of them alone has a null name.
    An empty table gives an empty table; other columns are not read.
    """
    return JaccardJoin(docs, doc_id, text, n, threshold, recall, **options).classes()


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, five words, similarity 0.8."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS m
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.m = y.m AND x.doc_id <> y.doc_id
      GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE c >= 0.8 * (na.n + nb.n - c) - 1e-9),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.seen),
k AS (SELECT doc_id, min(seen) AS class_id FROM r GROUP BY doc_id)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links
FROM k LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM l GROUP BY a) USING (doc_id)"""
