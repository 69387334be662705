"""Merkle manifest of a dataset: superblocks reduced, their outer nodes exchanged, proofs folded."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ordering import number_rows
from tessera.session import cut_lineage

_NODE = "tree long, pos long, n long, hash string"
_OUTER = "tree long, pos long, path string, subroot string, root string"


def digest(said: str) -> str:
    return hashlib.sha256(said.encode()).hexdigest()


def leaf_hash(fields: list[str], changed: dict[str, Column] | None = None) -> Column:
    """Hash of a row: ``-`` for a null field, else its UTF-8 length, ``:`` and its value, one after the other."""
    said = []
    for name in fields:
        value = (changed or {}).get(name, F.col(name)).cast("string")
        said.append(F.when(value.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*said), 256)


def _steps(n: int, arity: int, most: int) -> int:
    """Levels that a block of a level of ``n`` nodes climbs: all of them if the tree fits, else ``most``."""
    steps = 0
    while n > 1 and steps < most:
        n = -(-n // arity)
        steps += 1
    return steps


def _climb(hashes: list[str], steps: int, arity: int) -> list[list[str]]:
    """A block's nodes, level by level."""
    levels = [hashes]
    for _ in range(steps):
        under = levels[-1]
        levels.append([digest("".join(under[i:i + arity])) for i in range(0, len(under), arity)])
    return levels


def _path(levels: list[list[str]], at: int, arity: int) -> str:
    """Siblings of a node up to its block's top: for each level those before it, ``|``, those behind it."""
    said = []
    for nodes in levels[:-1]:
        first = at - at % arity
        said.append("".join(nodes[first:at]) + "|" + "".join(nodes[at + 1:first + arity]))
        at //= arity
    return ",".join(said)


def fold(leaf: str, path: str) -> str:
    """Root that a leaf and its siblings give."""
    for step in path.split(",") if path else ():
        before, behind = step.split("|")
        leaf = digest(before + leaf + behind)
    return leaf


def _tops(arity: int, most: int):
    def run(key, block):
        block = block.sort_values("pos")
        n = int(block["n"].iloc[0])
        top = _climb(block["hash"].tolist(), _steps(n, arity, most), arity)[-1][0]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [-(-n // arity ** most)], "hash": [top]})

    return run


def _down(arity: int, most: int, leaves: bool):
    """Cogrouped function: the nodes of a superblock meet the siblings of its top."""

    def run(key, block, outer):
        if block.empty or outer.empty:
            return pd.DataFrame({n: pd.Series(dtype=object) for n in (
                ("id", "leaf", "subroot", "root", "proof", "folded") if leaves else
                ("tree", "pos", "path", "subroot", "root"))})
        block = block.sort_values("pos")
        above, subroot, root = outer[["path", "subroot", "root"]].iloc[0]
        hashes = block["hash"].tolist()
        levels = _climb(hashes, _steps(int(block["n"].iloc[0]), arity, most), arity)
        paths = [_path(levels, i, arity) for i in range(len(hashes))]
        paths = [",".join(p for p in (inner, above) if p) for inner in paths]
        if not leaves:
            return pd.DataFrame({"tree": block["tree"].to_numpy(), "pos": block["pos"].to_numpy(), "path": paths,
                                 "subroot": subroot, "root": root})
        start = [h if t is None or t != t else t for h, t in zip(hashes, block["tampered"])]
        return pd.DataFrame({"id": block["id"].to_numpy(), "leaf": hashes, "subroot": subroot, "root": root,
                             "proof": paths, "folded": [fold(s, p) for s, p in zip(start, paths)]})

    return run


def _blocks(nodes: DataFrame, size: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / size))


class _Forest:
    """Trees whose nodes are a table ``tree, pos, n, hash``; each level here is one of superblocks."""

    def __init__(self, nodes: DataFrame, arity: int, most: int):
        self.arity, self.most, self.size = arity, most, arity ** most
        self.levels, roots = [], None
        while True:
            self.levels.append(nodes)
            tops = cut_lineage(_blocks(nodes.select("tree", "pos", "n", "hash"), self.size).groupBy("tree", "block")
                               .applyInPandas(_tops(arity, most), _NODE))
            done = tops.filter("n = 1").select("tree", F.col("hash").alias("subroot"))
            roots = done if roots is None else roots.unionByName(done)
            nodes = tops.filter("n > 1")
            if not nodes.take(1):
                break
        self.roots = roots

    def outer(self, above: DataFrame) -> DataFrame:
        """Siblings above each superblock of the lowest level; ``above`` has those above each tree."""
        paths = None
        for level in reversed(self.levels):
            whole = (level.filter(F.col("n") <= self.size).select("tree").distinct().join(above, "tree")
                     .select("tree", F.lit(0).cast("bigint").alias("pos"), "path", "subroot", "root"))
            outer = cut_lineage(whole if paths is None else whole.unionByName(paths))
            if level is self.levels[0]:
                return outer
            paths = self.cogroup(level, outer, False, _OUTER)
        return above

    def cogroup(self, nodes: DataFrame, outer: DataFrame, leaves: bool, schema: str) -> DataFrame:
        blocks = outer.withColumnRenamed("pos", "block")
        return (_blocks(nodes, self.size).groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block"))
                .applyInPandas(_down(self.arity, self.most, leaves), schema))


def merkle_manifest(docs: DataFrame, fields: list[str], group: str = "lang", order: str = "doc_id",
                    tampered: dict[str, Column] | None = None, where: Column | None = None, arity: int = 2,
                    block_levels: int = 12) -> DataFrame:
    """Leaf, roots and inclusion proof of every row; the proof is folded from the row as it is found.

    Output: the ``order`` column, ``leaf``, ``subroot`` (of the row's group), ``root``, ``proof`` (for each level
    the siblings before the node, ``|`` and those behind it; levels from the leaf up, comma-joined), ``folded``
    (root recomputed from the leaf and the proof) and ``verified``. Rows where ``where`` holds are folded from the
    leaf they have with the ``tampered`` columns in place of their own.

    Leaves of a group ascend by ``order``; every ``arity`` neighbours become the hash of their hashes until one
    is left; groups in byte order, null first, give the root likewise. Rows are hashed where they are read; the
    narrow rows get places by a range sort with counts per range, so one group with most rows meets no single
    task. Superblocks of ``arity ** block_levels`` leaves are reduced one per task call to their top; tops are the
    leaves of the next, much smaller level. Back down, each superblock is cogrouped with the siblings above its
    top, reduces itself again and joins and folds its proofs: no task holds more than a superblock.

    A null field counts as ``-``; null ``order`` values come last in their group, rows with equal ones in order of
    their leaf, repeated rows are leaves of their own; a null group is a group; an empty table gives an empty
    table. Only the named columns are read, so names of others cannot clash.
    """
    found = F.coalesce(where, F.lit(False)) if where is not None else F.lit(False)
    kind = docs.schema[order].dataType
    rows = cut_lineage(docs.select(
        F.col(group).isNotNull().cast("int").alias("present"), F.col(group).cast("string").alias("group"),
        F.col(order).alias("order"), leaf_hash(fields).alias("hash"),
        F.when(found, leaf_hash(fields, tampered)).alias("tampered")))
    placed = cut_lineage(number_rows(rows, [], ["present", "group", "order", "hash"], "place", hot_rows=0))
    groups = placed.groupBy("present", "group").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = cut_lineage(number_rows(groups, [], ["present", "group"], "rank").select(
        F.col("group").alias("__g"), "first", "n", (F.col("rank") - 1).alias("tree")))
    nodes = placed.join(groups, F.col("group").eqNullSafe(F.col("__g"))).select(
        "tree", (F.col("place") - F.col("first")).alias("pos"), "n", "hash", "tampered",
        F.col("order").cast("string").alias("id"))
    forest = _Forest(nodes, arity, block_levels)
    subroots = cut_lineage(forest.roots)
    crown = _Forest(subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"),
                                    F.lit(groups.count()).cast("bigint").alias("n"), F.col("subroot").alias("hash")),
                    arity, block_levels)
    over = crown.roots.select("tree", F.lit("").alias("path"), F.col("subroot"), F.col("subroot").alias("root"))
    lifted = crown.cogroup(crown.levels[0], crown.outer(over), False, _OUTER)
    above = cut_lineage(lifted.select(F.col("pos").alias("tree"), "path", "root").join(subroots, "tree"))
    proofs = forest.cogroup(nodes, forest.outer(above), True,
                            "id string, leaf string, subroot string, root string, proof string, folded string")
    return proofs.select(F.col("id").cast(kind).alias(order), "leaf", "subroot", "root", "proof", "folded",
                         (F.col("folded") == F.col("root")).alias("verified"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by language; where 7 divides the checksum of the id, ``n_chars`` is found one too high."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    proofs = merkle_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"],
                             tampered={"n_chars": F.col("n_chars") + 1}, where=hit)
    return proofs.select("doc_id", "leaf", "subroot", "root",
                         F.sha2(F.translate("proof", "|,", ""), 256).alias("proof_sha256"),
                         F.col("folded").alias("folded_root"), "verified")


OP13_SQL = """
WITH RECURSIVE z AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(0, 8),
       lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END, i) AS c
       FROM (SELECT unnest(range(0, 256)) AS i))),
f AS (SELECT doc_id, lang, n_chars, lang IS NOT NULL AS present,
       [doc_id::VARCHAR, source, lang, n_chars::VARCHAR, text] AS v, [doc_id::VARCHAR, source, lang, (n_chars + 1)::VARCHAR, text] AS w,
       xor(list_reduce(range(0, len(doc_id::VARCHAR)), lambda a, b:
           xor(a // 256, t[xor(a % 256, ascii(substr(doc_id::VARCHAR, b::INT + 1, 1))) + 1]),
           4294967295), 4294967295) % 7 = 0 AS hit FROM documents, z),
d AS (SELECT doc_id, lang, present, hit,
       sha256(array_to_string(list_transform(v, lambda x: coalesce(strlen(x) || ':' || x, '-')), '')) AS leaf,
       sha256(array_to_string(list_transform(w, lambda x: coalesce(strlen(x) || ':' || x, '-')), '')) AS other FROM f),
g AS (SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS tree FROM d GROUP BY lang),
p AS (SELECT d.*, g.n, g.tree, row_number() OVER (PARTITION BY g.tree ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos
      FROM d JOIN g ON d.lang IS NOT DISTINCT FROM g.lang),
t AS (SELECT tree, 0 AS lvl, pos, n, leaf AS h FROM p UNION ALL
      SELECT tree, lvl + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY pos)) FROM t
      WHERE n > 1 GROUP BY tree, lvl, pos // 2),
s AS (SELECT tree, h AS subroot, lvl AS height FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, tree AS pos, (SELECT count(*) FROM s) AS n, subroot AS h FROM s UNION ALL
      SELECT lvl + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY pos)) FROM u
      WHERE n > 1 GROUP BY lvl, pos // 2),
l AS (SELECT p.tree, p.pos, t.lvl, CASE WHEN x.h IS NULL THEN 'N' WHEN x.pos < t.pos THEN 'B' || x.h ELSE 'A' || x.h END AS said
      FROM p JOIN t ON t.tree = p.tree AND t.n > 1 AND t.pos = p.pos >> t.lvl
      LEFT JOIN t x ON x.tree = t.tree AND x.lvl = t.lvl AND x.pos = xor(t.pos, 1)
      UNION ALL
      SELECT p.tree, p.pos, 1000 + u.lvl, CASE WHEN x.h IS NULL THEN 'N' WHEN x.pos < u.pos THEN 'B' || x.h ELSE 'A' || x.h END
      FROM p JOIN u ON u.n > 1 AND u.pos = p.tree >> u.lvl LEFT JOIN u x ON x.lvl = u.lvl AND x.pos = xor(u.pos, 1)),
q AS (SELECT tree, pos, list(said ORDER BY lvl) AS path FROM l GROUP BY tree, pos),
r AS (SELECT doc_id, leaf, subroot, (SELECT h FROM u WHERE n = 1) AS root, coalesce(path, []) AS path,
      CASE WHEN coalesce(hit, false) THEN other ELSE leaf END AS start FROM p JOIN s USING (tree) LEFT JOIN q USING (tree, pos)),
o AS (SELECT *, list_reduce(path, lambda a, x: sha256(CASE x[1] WHEN 'B' THEN x[2:] || a WHEN 'A' THEN a || x[2:] ELSE a END),
      start) AS folded_root FROM r)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x[2:]), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified FROM o"""
