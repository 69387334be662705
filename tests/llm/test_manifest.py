"""The Merkle manifest against plain Python."""
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from llm_fixtures import COLUMNS, hard_texts
from tessera.llm.merkle import fold, merkle_manifest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(said):
    return hashlib.sha256(said.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, arity):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        under = levels[-1]
        levels.append([sha("".join(under[i:i + arity])) for i in range(0, len(under), arity)])
    return levels


def siblings(levels, at, arity):
    out = []
    for nodes in levels[:-1]:
        first = at - at % arity
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + arity])))
        at //= arity
    return out


def brute(docs, arity):
    """(id, leaf, subroot, root, proof, folded) of each row; docs are (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for i, text, lang, source, n in docs:
        own = leaf((i, source, lang, n, text))
        hit = i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and n is not None
        found = leaf((i, source, lang, n + 1, text)) if hit else own
        groups.setdefault(lang, []).append((i is None, i or 0, own, found, i))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g])], arity) for g in names}
    crown = climb([trees[g][-1][0] for g in names], arity)
    out = []
    for place, g in enumerate(names):
        for at, (_, _, own, found, i) in enumerate(sorted(groups[g])):
            path = siblings(trees[g], at, arity) + siblings(crown, place, arity)
            up = found
            for a, b in path:
                up = sha(a + up + b)
            out.append((i, own, trees[g][-1][0], crown[-1][0], ",".join(f"{a}|{b}" for a, b in path), up))
    return sorted(out, key=repr)


def rows_of(docs, **options):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle_manifest(docs, FIELDS, tampered={"n_chars": F.col("n_chars") + 1}, where=hit, **options).collect()
    assert all(r.verified == (r.folded == r.root) for r in got)
    assert all(fold(r.leaf, r.proof) == r.root for r in got)
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.folded) for r in got), key=repr)


def data():
    """Nulls in every column, repeated rows, shared ids, one hot group, a group of one row."""
    out = [(i, t, "hot" if i % 3 else ["de", "en", None, "é"][i % 4], f"s{i % 2}", len(t or ""))
           for i, t in enumerate(hard_texts())]
    out += [out[3]] * 3 + [(5, "other", "hot", None, 5), (None, "x", "hot", "s", 1), (None, None, None, None, None),
                           (7, "n", "hot", "s", None), (10 ** 17 + 1, "long id", "lone", "s", 7)]
    return out


@pytest.mark.parametrize("arity,levels", [(2, 12), (2, 3), (3, 1)])
def test_proofs(spark, arity, levels):
    docs = spark.createDataFrame(data(), COLUMNS).repartition(5)
    assert rows_of(docs, arity=arity, block_levels=levels) == brute(data(), arity)


def test_small_tables(spark):
    one = [(1, "a", "en", None, 1)]
    docs = spark.createDataFrame(one, COLUMNS)
    got = rows_of(docs)
    assert got == brute(one, 2) and got[0][4] == "" and got[0][1] == got[0][3]
    assert rows_of(docs.limit(0)) == []
    clash = docs
    for name in ("tree", "pos", "n", "hash", "id", "block", "place", "group", "order", "root", "path", "tampered"):
        clash = clash.withColumn(name, F.lit("clash"))
    assert rows_of(clash) == got
