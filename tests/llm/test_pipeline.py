"""The pipeline: registered queries, its stages by their rules, and the queries with an SQL twin."""
import re
from collections import Counter
from pathlib import Path

import pytest

from check_sql import difference
from llm_fixtures import COLUMNS, make, sentence
from oracle import connect

import corpus_pipeline
from tessera.llm.mixing import mix_sources
from tessera.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
present = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@present
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    assert difference(spark, connect(FOLDER), FOLDER, name) is None


def test_every_operator_has_one_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)] and set(ORACLES) <= set(QUERIES)


@present
def test_stages(spark, tmp_path):
    docs, kept = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept.append([r.asDict() for r in docs.collect()])
        if i < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
    first, second, third, fourth, last = kept

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {r["doc_id"]: shingles(r["text"]) for r in first}
    stay = {r["doc_id"] for r in second}
    close = lambda a, b: a and b and len(a & b) >= 0.8 * len(a | b)
    for i, s in sets.items():
        if i not in stay:  # it is near another document of the stage
            assert any(close(s, o) for j, o in sets.items() if j != i)
    assert not any(close(sets[i], sets[j]) for i in stay for j in stay if i < j)
    assert {r["doc_id"] for r in third} <= stay
    n = corpus_pipeline.PASSAGE
    seen = Counter(r["text"].encode()[i:i + n] for r in second for i in range(len(r["text"].encode()) - n + 1))
    before = {r["doc_id"]: r["text"] for r in second}
    for r in third:
        body = before[r["doc_id"]].encode()
        gone = bytearray(len(body))
        for i in range(len(body) - n + 1):
            if seen[body[i:i + n]] > 1:
                gone[i:i + n] = b"\x01" * n
        assert r["text"] == bytes(b for b, g in zip(body, gone) if not g).decode("utf-8", "ignore")
        assert r["n_chars"] == len(r["text"])
    assert all(n <= 3 for n in Counter(r["doc_id"] for r in fourth).values())
    total = Counter()
    for r in last:
        total[r["row"]] += r["length"]
    assert len(total) == len(fourth) and all(total[r["row"]] == r["doc_tokens"] for r in last)


def test_stages_on_hard_rows(spark, tmp_path):
    """Stages after the classifier on nulls, empty texts, copies and no rows at all."""
    passage = sentence(1, 120)
    hard = make(spark, [None, "", "a", passage, passage, passage + " " + sentence(2, 90), sentence(3, 40) + " " + passage])
    for n, docs in enumerate((hard, hard.limit(0))):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES[1:]):
            stage(spark, docs, FOLDER).write.parquet(str(tmp_path / f"{n}-{i}"))
            docs = spark.read.parquet(str(tmp_path / f"{n}-{i}"))
            if n == 0 and i == 0:
                assert sorted(r.doc_id for r in docs.collect()) == [0, 1, 2, 3, 5, 6]
        assert (docs.count() > 0) == (n == 0)


def test_one_row_of_each_group(spark, tmp_path):
    """Repeated rows, shared ids and null ids: each group keeps one row, and its text stays in the corpus."""
    a, b, c, d, e = (sentence(i, 120) for i in range(11, 16))
    given = [(1, a), (1, a), (1, a), (2, b), (2, c), (3, b), (None, d), (None, d), (None, e), (None, a), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in given], COLUMNS)
    want = Counter([(1, a), (2, b), (2, c), (None, d), (None, e), (None, None)])
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[1:3]):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        assert Counter((r.doc_id, r.text) for r in docs.collect()) == want


def test_mix_takes_each_row_by_itself(spark):
    """Rows that share an id, also none, or repeat are taken as often as the mix says of each, at most three times."""
    given = [*((None, sentence(21, 40 + i), "a") for i in range(6)), *((7, sentence(22, 50), "b") for _ in range(5)),
             *((7, sentence(23, 60 + i), "b") for i in range(4)), *((i, sentence(24, 70 + i), "c") for i in range(4))]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in given], COLUMNS)
    want = Counter()
    for r in mix_sources(docs).collect():
        want[r.doc_id, r.size, r.source] += r.copies
    got = Counter((r.doc_id, len(r.text.split()), r.source) for r in corpus_pipeline.mix_by_weight(spark, docs, FOLDER).collect())
    assert got == +want
    rows = Counter((i, len(t.split()), s) for i, t, s in given)
    assert all(n <= 3 * rows[k] for k, n in got.items())


def test_tables_of_the_stage_before_go(spark):
    """Each stage deletes what its predecessor left; what others wrote in the session stays."""
    from tessera import session

    docs = make(spark, [sentence(i, 60) for i in range(8)])
    mine = session.cut_lineage(docs)
    kept = mine
    for _, stage in corpus_pipeline.STAGES[1:4]:
        kept = session.cut_lineage(stage(spark, kept, FOLDER))
        left = list(corpus_pipeline._left)
        assert left and all(Path(p.removeprefix("file:")).exists() for p in left)
        before = left
    corpus_pipeline.STAGES[4][1](spark, kept, FOLDER)
    assert not any(Path(p.removeprefix("file:")).exists() for p in before)
    assert mine.count() == 8 and kept.count() >= 0


@pytest.mark.parametrize("limit", [0, 1 << 25])
def test_decisions_meet_texts_either_way(spark, monkeypatch, tmp_path, limit):
    """The same rows whether decisions are broadcast or shuffled."""
    from tessera.llm import tables

    monkeypatch.setattr(tables.broadcast_if_small, "__defaults__", (limit,))
    a, b = sentence(31, 150), sentence(32, 150)
    docs = make(spark, [a, a, b, b + " x", a[:500] + " " + sentence(33, 80), None, ""])
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    kept = corpus_pipeline.keep_one_of_group(spark, docs, FOLDER)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 4, 5, 6]
    cut = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, docs.filter("doc_id IN (0, 4, 5)"), FOLDER).collect()}
    assert cut[5] is None and a[:500] not in cut[4] and cut[0] == a[500:]


def test_batches_of_stages_are_small(spark):
    """A partition of long texts goes to Python in batches of some 2 MB, if the session names no limit."""
    from tessera.session import BATCH_LIMIT

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["size", "n"])

    docs = spark.range(0, 3_000, 1, 1).selectExpr("repeat('x', 8000) AS text")
    spark.conf.unset(BATCH_LIMIT)
    try:
        for limit, least, most in ((None, 0, 3 << 20), ("9m", 6 << 20, 10 << 20)):
            if limit:
                spark.conf.set(BATCH_LIMIT, limit)
            stage = corpus_pipeline.staged(lambda s, d, f: d.select("text").mapInArrow(sizes, "size long, n long"))
            found = stage(spark, docs, FOLDER).collect()
            assert sum(r.n for r in found) == 3_000 and least < max(r.size for r in found) < most
    finally:
        spark.conf.unset(BATCH_LIMIT)
