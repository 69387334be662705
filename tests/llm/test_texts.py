"""Operators over texts against brute force on hard cases: nulls, empty, long, ties, copies, clashing columns."""
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import hard_texts, make, sentence

import public_tokenizers

SPACE = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module", params=[False, True], ids=["plain", "clashing"])
def docs(spark, request):
    return make(spark, hard_texts(), request.param).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return make(spark, ["x"]).limit(0)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def removed(units, width):
    """Which units of each list lie in a window seen more than once."""
    seen = Counter(tuple(u[i:i + width]) for u in units for i in range(len(u) - width + 1))
    out = []
    for u in units:
        gone = [False] * len(u)
        for i in range(len(u) - width + 1):
            if seen[tuple(u[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        out.append(gone)
    return out


@pytest.mark.parametrize("hot", [2_000, 1])
def test_suffix_dedup(docs, hot):
    from tessera.llm.suffix_dedup import remove_repeats

    texts = [(t or "").encode() for t in hard_texts()]
    got = by_id(remove_repeats(docs, length=60, hot_strings=hot))
    for i, (t, gone) in enumerate(zip(texts, removed([list(t) for t in texts], 60))):
        r = got[i][0]
        assert bytes(r.kept) == bytes(b for b, g in zip(t, gone) if not g), i
        assert (r.n_bytes, r.n_removed) == (len(t), sum(gone))
        assert r.n_spans == len(re.findall("1+", "".join("1" if g else "0" for g in gone)))


@pytest.mark.parametrize("hot", [2_000, 1])
def test_window_dedup(docs, hot):
    from tessera.llm.window_dedup import remove_repeated_windows

    words = [re.findall(SPACE, t or "") for t in hard_texts()]
    got = by_id(remove_repeated_windows(docs, width=12, gram=4, hot_strings=hot))
    for i, (w, gone) in enumerate(zip(words, removed(words, 12))):
        r = got[i][0]
        assert r.kept == " ".join(x for x, g in zip(w, gone) if not g), i
        assert (r.n_words, r.n_removed) == (len(w), sum(gone))


def test_difference_cover():
    from tessera.llm.suffix_dedup import difference_cover

    for q in (2, 3, 5, 7, 11, 13):
        period, residues = difference_cover(q)
        assert {(a - b) % period for a in residues for b in residues} == set(range(period))


@pytest.mark.parametrize("block", [150_000, 300])
def test_jaccard_join(docs, block):
    from tessera.llm.jaccard import JaccardJoin

    def shingles(t):
        w = re.findall(SPACE, (t or "").lower())
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for t in hard_texts()]
    linked = [[j for j, b in enumerate(sets) if i != j and a and b and len(a & b) >= 0.8 * len(a | b)]
              for i, a in enumerate(sets)]
    join = JaccardJoin(docs, block_shingles=block)
    got = by_id(join.classes())
    for i, near in enumerate(linked):
        group, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        assert (got[i][0].class_id, got[i][0].n_links) == (min(group), len(near)), i
    pairs = {(r.a, r.b): r.similarity for r in join.pairs().collect()}
    first = {}
    names = [first.setdefault(frozenset(s), i) for i, s in enumerate(sets)]
    assert set(pairs) == {(names[i], names[j]) for i, near in enumerate(linked) for j in near if names[i] < names[j]}
    assert all(abs(s - len(sets[a] & sets[b]) / len(sets[a] | sets[b])) < 1e-9 for (a, b), s in pairs.items())


def test_bands():
    from tessera.llm.jaccard import choose_bands

    bands, rows = choose_bands(0.8, 0.9999)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9999 and bands * rows <= 192


def test_components(spark):
    from tessera.llm.graph import components

    links = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 150)] + [(5, 5), (7, None)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 10 for i in range(10, 61)}, **{i: 100 for i in range(100, 150)}}


def test_tokenizer_stays_with_the_worker(monkeypatch):
    import sys

    import pyarrow as pa
    from pyspark import cloudpickle
    from tokenizers import Tokenizer

    from tessera.llm import packing

    monkeypatch.delitem(sys.modules, "tessera_worker_state", raising=False)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words", None]})
    run, out = packing._tokenised(packing.default_tokenizer(), 2_048, 16, 1), []
    for _ in range(2):  # each task gets a copy of the function
        task = cloudpickle.loads(cloudpickle.dumps(run))
        out.append([x.to_pylist() for x in task([batch])])
        words = sys.modules["tessera_worker_state"].words
        words.met = getattr(words, "met", 0) + 1
    assert out[0] == out[1] and words.met == 2 and isinstance(words.tokenizer, Tokenizer)
    words.place.update((f"x{i}", 0) for i in range(packing.KEPT_WORDS))
    again = cloudpickle.loads(cloudpickle.dumps(run))
    assert [x.to_pylist() for x in again([batch])] == out[0] and len(words.place) < packing.KEPT_WORDS


def test_components_files_and_rounds(spark):
    from pathlib import Path

    from tessera.llm.graph import components
    from tessera.session import scratch_mark, scratch_since

    few = spark.sparkContext.defaultParallelism
    settings = {"spark.sql.shuffle.partitions": str(8 * few), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        mark = scratch_mark()
        links = [(i // 10 * 10, i) for i in range(2_000)]
        got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), 2_000).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i // 10 * 10 for i in range(2_000)}
    written = scratch_since(mark)
    assert len(written) == 2  # stars as they are take no round
    assert all(len(list(Path(p.removeprefix("file:")).glob("part-*"))) <= few for p in written)


@pytest.mark.parametrize("block, whole", [(150_000, True), (300, False)])
def test_jaccard_trees_of_one_block(docs, block, whole):
    from tessera.llm.jaccard import JaccardJoin

    found = JaccardJoin(docs, block_shingles=block)._checked(False).collect()
    assert found and (not whole or all(r.whole for r in found)) and (whole or not all(r.whole for r in found))
    assert all(r.root <= r.node for r in found)


def check_packing(rows, texts, window=2048):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sequences, pad, total = {}, 0, 0
    for i, t in enumerate(texts):
        ids, at = tokenizer.encode(t or "", add_special_tokens=False).ids + [1], 0
        for p in sorted(rows[i], key=lambda r: r.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            part = np.array(ids[at:at + p.length], "<u4")
            assert p.ids_crc32 == zlib.crc32(part.tobytes()) and len(part) == p.length
            sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
            at += p.length
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
        total += at
        pad += window - at if at & (at - 1) else 0
    return pad / total


def test_packing(docs):
    from tessera.llm.packing import default_tokenizer, pack

    assert check_packing(by_id(pack(docs, default_tokenizer())), hard_texts()) < 0.1


def test_packing_of_equal_lengths(spark):
    """A third of all documents have one length; small shards meet the same rules."""
    from tessera.llm.packing import default_tokenizer, pack

    texts = ["same words here"] * 400 + [sentence(i, 20 + 3 * i % 290) for i in range(500)]
    rows = by_id(pack(make(spark, texts), default_tokenizer(), shard_rows=50, residual_rows=40))
    assert check_packing(rows, texts) < 0.05


def test_checksum_of_parts():
    from tessera.llm.packing import join_crc

    data = bytes(range(256)) * 3
    cuts = [64, 64, 200, 64, 376]
    at, parts = 0, []
    for n in cuts:
        parts.append(zlib.crc32(data[at:at + n]))
        at += n
    assert join_crc(parts, cuts) == zlib.crc32(data)


def test_fingerprints(docs):
    from tessera.llm.fingerprints import fingerprint

    texts = [t or "" for t in hard_texts()]
    for bucket in (4 << 20, 2_000):
        got = by_id(fingerprint(docs, bucket_bytes=bucket))
        assert sorted(got) == list(range(len(texts)))
        marks = {}
        for i, t in enumerate(texts):
            after, half = texts[(i + 1) % len(texts)], len(t) // 2
            edited = t[:len(t) - half] + after[:half]
            r = got[i][0]
            assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            assert marks.setdefault(t, r.fingerprint) == r.fingerprint
        far = [got[i][0] for i in range(30, 50)]
        assert sum(r.near_edited > r.near_next for r in far) > 15 and max(r.near_next for r in far) < 0.2


def test_fingerprints_without_words_of_the_lexicon():
    """Equal texts are like each other, other texts are not."""
    from tessera.llm.fingerprints import Subsets

    own = Subsets(np.zeros(0, np.uint64))
    a, b, c, e = own.signatures([b"one two", b"one two", b"one three", b""])
    like = own.likeness(np.stack([a, a, e, e]), np.stack([b, c, e, a]))
    assert like.tolist() == [1, 0, 1, 0]


def test_fingerprints_of_a_large_group_of_near_copies(spark):
    """The words that copies share may be too frequent for the lexicon; the copies are still like each other."""
    from tessera.llm.fingerprints import fingerprint

    group = sentence(50, 100)
    copies = [f"{group} own{i}a own{i}b" for i in range(100)]
    for texts in (copies + [sentence(100 + i, 100) for i in range(200)],
                  [t for i in range(100) for t in (sentence(100 + i, 100), copies[i], sentence(300 + i, 100))]):
        got = by_id(fingerprint(make(spark, texts)))
        near = [got[i][0] for i in range(99) if group in texts[i] and group in texts[i + 1]]
        assert len(near) in (0, 99) and all(r.near_next > 0.6 and r.near_edited > 0.25 for r in near)
        mixed = [got[i][0] for i in range(299) if (group in texts[i]) != (group in texts[i + 1])]
        assert np.mean([r.near_edited for r in mixed]) > 0.1 and max(r.near_next for r in mixed) < 0.2
    assert got[1][0].fingerprint != got[4][0].fingerprint
    shared = lambda a, b: sum(a[i:i + 8] == b[i:i + 8] for i in range(0, len(a), 8)) / (len(a) / 8)
    assert shared(got[1][0].fingerprint, got[4][0].fingerprint) > 0.6


def test_lexicon_band(spark):
    from tessera.llm.arrays import Block
    from tessera.llm.fingerprints import document_terms, lexicon_of

    texts = [f"all half{i % 2} tenth{i % 10} own{i}" for i in range(100)]
    found = lexicon_of(make(spark, texts), "text", 0.5, 3.0)
    want = document_terms(Block([" ".join([*(f"half{i}" for i in range(2)), *(f"tenth{i}" for i in range(10))]).encode()]))[1]
    assert sorted(found) == sorted(want)


def test_lexicon_is_bounded(spark):
    """The most frequent words below the low edge are in; of a frequency that does not fit whole, a part by hash."""
    from tessera.llm.arrays import Block
    from tessera.llm.fingerprints import document_terms, lexicon_of

    texts = [f"all half{i % 2} tenth{i % 10} own{i} other{i}" for i in range(100)]
    df = make(spark, texts)
    frequent = set(document_terms(Block([" ".join([*(f"half{i}" for i in range(2)), *(f"tenth{i}" for i in range(10))]).encode()]))[1])
    assert set(lexicon_of(df, "text", 0.1, most_terms=12)) == frequent
    part = lexicon_of(df, "text", 0.1, most_terms=112)
    assert frequent < set(part) and 80 < len(part) < 145
    assert len(lexicon_of(df, "text", 0.1)) == 212 and len(lexicon_of(df, "text", 0.0)) == 213


def plain_fingerprints(texts, levels, each):
    """Signatures of the subsets, said in plain Python on the hash of each word."""
    from tessera.llm.arrays import Block, mix
    from tessera.llm.fingerprints import Subsets, document_terms

    top = 1 << 64
    words = [{bytes(w) for w in re.findall(rb"[^ \t\n\x0b\x0c\r]+", t.encode())} for t in texts]
    n = Counter(w for ws in words for w in ws)
    lexicon = {w: int(document_terms(Block([w]))[1][0]) for w, k in n.items() if k <= len(texts) * np.exp(-0.1)}
    seeds = [int(s) for s in Subsets(np.zeros(0, np.uint64), levels, each).seeds]

    def sign(text):
        own = [lexicon[w] for w in set(re.findall(rb"[^ \t\n\x0b\x0c\r]+", text.encode())) if w in lexicon]
        if not own:
            return None
        out = []
        for level in range(levels):
            for seed in seeds:
                inside = [h * seed % top for h in own if h * seed % top < top >> level]
                total = sum(x | 1 for x in inside) % top
                out.append(max(int(mix(np.array([total], np.uint64))[0]) >> 48, int(total != 0)))
        return out

    return sign


def plain_likeness(a, b, levels, each):
    if a == b:
        return 1.0
    agree = spoken = 0
    rates = [range(i * each, i * each + each) for i in range(levels)]
    talk = [[i for i in rate if a[i] or b[i]] for rate in rates]
    partly = [t for t in talk if 0 < len(t) < each] or [t for t in talk[-1:] if t]
    for t in partly:
        spoken += len(t)
        agree += sum(a[i] == b[i] for i in t)
    return agree / spoken if spoken else 0.0


def test_fingerprints_against_plain_python(docs):
    from tessera.llm.fingerprints import fingerprint

    texts, levels, each = [t or "" for t in hard_texts()], 6, 8
    sign = plain_fingerprints(texts, levels, each)
    hexed = lambda s: "".join(f"{x:04x}" for x in s)
    checked = 0
    for r in fingerprint(docs, levels=levels, each=each, bucket_bytes=5_000).collect():
        t, after = texts[r.doc_id], texts[(r.doc_id + 1) % len(texts)]
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        own, other, following = sign(t), sign(edited), sign(after)
        if own:
            assert r.fingerprint == hexed(own)
        if other:
            assert r.edited_fingerprint == hexed(other)
        if own and other:
            assert r.near_edited == pytest.approx(plain_likeness(own, other, levels, each))
        if own and following:
            assert r.near_next == pytest.approx(plain_likeness(own, following, levels, each))
            checked += 1
    assert checked > 30


def test_fingerprints_of_shared_and_absent_ids(spark):
    """Rows of one id, or of none, are dealt by their hash; each has the next row as its successor."""
    from tessera.llm.fingerprints import fingerprint

    texts = [sentence(i, 30) for i in range(90)]
    rows = [(None if i < 30 else 5 if i < 60 else i, t, None, None, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = None
    for bucket in (4 << 20, 1_000):
        got = sorted(tuple(r) for r in fingerprint(df, bucket_bytes=bucket).fillna(-1, ["doc_id"]).collect())
        assert len(got) == 90 and len({r[2] for r in got}) == 90
        assert want in (None, got)
        want = got


def test_workers_without_the_package(tmp_path):
    """Operators with broadcasts run where the workers cannot import the package."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    here = Path(__file__).resolve()
    code = f"""
import sys
sys.path[:0] = [{str(here.parents[2])!r}, {str(here.parent)!r}]
from llm_fixtures import make, sentence
from tessera.llm.fingerprints import fingerprint
from tessera.llm.quality import score_quality
from tessera.session import get_session
spark = get_session("away", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
df = make(spark, [sentence(i, 20) for i in range(20)])
labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
print("rows", fingerprint(df).count(), score_quality(df, labels).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 20 20" in done.stdout, done.stderr[-2000:]


def test_token_counts(docs):
    from tessera.llm.tokens import count_edited, sample_edits

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    from tessera.llm.tokens import Counter as Tokens
    encode = Tokens(path, public_tokenizers.PATTERN).encoding.encode_ordinary
    got = by_id(count_edited(docs, path, public_tokenizers.PATTERN))
    for i, t in enumerate(hard_texts()):
        edited = t or ""
        for a, b, put in sample_edits(t or "", "en", f"src{i % 3}" if i % 7 else ""):
            edited = edited[:a] + put + edited[b:]
        assert (got[i][0].n_tokens, got[i][0].n_edited_tokens) == (len(encode(t or "")), len(encode(edited))), i
    assert got[18][0].n_encoded < got[18][0].n_pieces / 20


def test_token_tree_edits():
    """Many random edits of one tree, also ones that join and split pre-tokens."""
    from tessera.llm.tokens import Counter as Tokens, TokenTree

    tokens = Tokens(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    draw = np.random.default_rng(3)
    tree = TokenTree("It's  a test\n\n of we'll 12 words,   " * 60, tokens)
    for _ in range(400):
        n = len(tree.text)
        a = int(draw.integers(0, n + 1))
        b = min(n, a + int(draw.integers(0, 30)))
        put = "".join(draw.choice(list(" ab'1.\n"), int(draw.integers(0, 25))))
        if draw.random() < 0.02:
            put = "word " * 1500
        want = tree.text[:a] + put + tree.text[b:]
        tree.edit(a, b, put)
        assert tree.text == want and tree.total == len(tokens.encoding.encode_ordinary(want))


def test_small_edits_at_every_place():
    """Edits beside white space and apostrophes, where a split looks furthest ahead."""
    from tessera.llm.tokens import Counter as Tokens, TokenTree

    tokens = Tokens(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for text in ("le  e", "ee   l", "it'l be", "a\n\n b, '", "'v 12  ", "x"):
        for a in range(len(text) + 1):
            for b in range(a, len(text) + 1):
                for put in ("", " ", "l", "'", "e1", "\n "):
                    tree = TokenTree(text, tokens)
                    tree.edit(a, b, put)
                    want = text[:a] + put + text[b:]
                    assert tree.total == len(tokens.encoding.encode_ordinary(want)), (text, a, b, put)


def test_license_scan(docs):
    from tessera.llm.licenses import PHRASES, scan_licenses

    documents, _ = scan_licenses(docs)
    got = by_id(documents)
    for i, t in enumerate(hard_texts()):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        hits = [(j, label) for p, label in PHRASES.items() for j in range(len(w)) if w[j:j + len(p.split())] == p.split()]
        r = got[i][0]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(hits), ",".join(sorted({h[1] for h in hits})))
        assert (r.first_word, r.last_word) == (min((h[0] for h in hits), default=None), max((h[0] for h in hits), default=None))


def test_license_spans(spark):
    """A wording with words left out, put in and changed is still one verified span; unlike text is none."""
    from tessera.llm.licenses import TEMPLATES, scan_licenses

    whole = TEMPLATES["mit"][0].split()
    bent = whole[:10] + ["indeed"] + whole[10:25] + whole[26:]
    texts = [sentence(1, 50) + " " + " ".join(bent) + " " + sentence(2, 9), "free software for the license of use", "MIT " * 9]
    documents, spans = scan_licenses(make(spark, texts))
    got = by_id(documents)
    assert (got[0][0].labels, got[0][0].base_labels) == ("mit", "") and 0.8 < got[0][0].score < 1
    assert [got[i][0].labels for i in (1, 2)] == ["", ""]
    assert [(r.first, r.last) for r in spans.collect()] == [(50, 50 + len(bent) - 1)]


def test_quality(spark, docs):
    from tessera.llm.quality import score_quality

    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(5, 40)] + [(6, None, 0), (None, 1, 0), (99, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = score_quality(docs, labels).select("row.doc_id", "held_out", "score", "predicted").collect()
    assert len(rows) == len(hard_texts()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(len(rows))}
    none = score_quality(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_trees_learn():
    from tessera.llm.quality import fit_trees

    draw = np.random.default_rng(1)
    x = draw.normal(size=(4000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = fit_trees(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_mixing(docs):
    from tessera.llm.mixing import mix_sources

    got = by_id(mix_sources(docs))
    size = {i: len(re.findall(SPACE, t or "")) for i, t in enumerate(hard_texts())}
    source = {i: f"src{i % 3}" if i % 7 else None for i in size}
    total = Counter()
    for i, n in size.items():
        total[source[i]] += n
    weight = {s: 1 + k % 3 for k, s in enumerate(sorted(total, key=lambda s: (s is None, s or "")))}
    target, free = {}, set(total)
    while free:
        level = (sum(total.values()) - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * total[s]}
        if not over:
            target.update({s: level * weight[s] for s in free})
            break
        target.update({s: 3.0 * total[s] for s in over})
        free -= over
    for i, n in size.items():
        r = got[i][0]
        assert (r.size, r.source_size) == (n, total[source[i]]) and abs(r.target - target[source[i]]) < 1e-6
        assert r.taken == r.copies * n and 0 <= r.copies <= 3
    for s in total:
        mine = [i for i in size if source[i] == s]
        assert abs(sum(got[i][0].taken for i in mine) - target[s]) <= max(size[i] for i in mine)


def test_empty_tables(spark, empty):
    from tessera.llm.fingerprints import fingerprint
    from tessera.llm.jaccard import near_duplicates
    from tessera.llm.licenses import scan_licenses
    from tessera.llm.mixing import mix_sources
    from tessera.llm.packing import default_tokenizer, pack
    from tessera.llm.quality import score_quality
    from tessera.llm.suffix_dedup import remove_repeats
    from tessera.llm.tokens import count_edited
    from tessera.llm.window_dedup import remove_repeated_windows

    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for out in (fingerprint(empty), near_duplicates(empty), scan_licenses(empty)[0], mix_sources(empty),
                pack(empty, default_tokenizer()), score_quality(empty, labels), remove_repeats(empty),
                count_edited(empty, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
                remove_repeated_windows(empty)):
        assert out.count() == 0


def test_null_ids_and_repeated_rows(spark):
    """Rows without an id and rows that repeat are documents of their own."""
    from tessera.llm.fingerprints import fingerprint
    from tessera.llm.jaccard import near_duplicates
    from tessera.llm.licenses import scan_licenses
    from tessera.llm.mixing import mix_sources
    from tessera.llm.packing import default_tokenizer, pack
    from tessera.llm.quality import score_quality
    from tessera.llm.suffix_dedup import remove_repeats
    from tessera.llm.window_dedup import remove_repeated_windows

    text = sentence(1, 100)
    rows = [(None, text), (None, None), (4, text), (4, text), (4, "mit license"), (5, None)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int")
    for out in (fingerprint(df), near_duplicates(df), scan_licenses(df)[0], mix_sources(df),
                score_quality(df, labels), remove_repeats(df), remove_repeated_windows(df)):
        assert out.count() == len(rows)
    assert pack(df, default_tokenizer()).select("row").distinct().count() == len(rows)
    assert sorted(r.n_links for r in near_duplicates(df).collect()) == [0, 0, 0, 2, 2, 2]
    assert remove_repeats(df).agg({"n_removed": "sum"}).head()[0] == 3 * len(text)


@pytest.mark.parametrize("seed", range(4))
def test_suffix_order(seed):
    """Random texts of few letters with copies: order and equality of strings as bytes, whatever the blocks."""
    import numpy as np

    from tessera.llm.suffix_order import equal_neighbours

    rng = np.random.default_rng(seed)
    for _ in range(40):
        length = int(rng.integers(16, 120))
        base = bytes(rng.integers(97, 98 + int(rng.integers(0, 4)), 300, dtype=np.uint8))
        raw = b""
        for _ in range(int(rng.integers(1, 8))):
            a, b = sorted(rng.integers(0, 300, 2).tolist())
            part = bytearray(base[a:b])
            if part and rng.random() < 0.5:
                part[int(rng.integers(0, len(part)))] = 48
            raw += bytes(part) + b"\n"
        starts = np.arange(max(0, len(raw) - length + 1))
        starts = starts[rng.random(len(starts)) < 0.9]
        order, same = equal_neighbours(raw, starts, length, block=int(rng.choice([1, 7, 64, 65_536])))
        assert sorted(order.tolist()) == starts.tolist()
        strings = [raw[i:i + length] for i in order.tolist()]
        assert strings == sorted(strings)
        assert same.tolist() == [i > 0 and strings[i] == strings[i - 1] for i in range(len(strings))]


def test_words_encoded_by_parts():
    """Signs behind a word and its case change no id, whatever the word holds."""
    from tokenizers import Tokenizer

    from tessera.llm.packing import Words, default_tokenizer, token_ids

    tokenizer = Tokenizer.from_file(default_tokenizer())
    words = ["Word", "word,", "word", "WORD***", "it's.", "it'S.", "it'.", "...", "a.b.", "a1!?", "0.", "10%", "é.", "É,",
             "é.", "x²;", "¼.", "ﬁ.", "×.", "a×.", "x_", "x_.", "<|endoftext|>.", "<|endoftext|>", "A<|ENDOFTEXT|>a,",
             "<|endoftext|>ab,", "ſ.", "İ.", "ß!", "don't,", "a̸.", "#", "$5.00,", "日本.", "a‍.", "K.", "ª:", "µ#"]
    known = Words(tokenizer, 1)
    assert known.tail and known.lowers
    for texts in ([" ".join(words)], words, [w + "," for w in words], [w.upper() + ".#" for w in words], [" ".join(words)]):
        ids, at = token_ids(known, texts)
        for text, a, b in zip(texts, at, at[1:]):
            assert ids[a:b].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1], text


def test_words_of_letters_encoded_by_the_model():
    """Words of Latin-1 letters share one entry whatever their case; other tokenizers than the usual give their ids."""
    import json
    import random

    from tokenizers import Regex, Tokenizer, normalizers, pre_tokenizers

    from tessera.llm.packing import Words, default_tokenizer, token_ids

    usual = Tokenizer.from_file(default_tokenizer())
    known = Words(usual, 1)
    token_ids(known, ["École ÉCOLE, école. École?! 0 l0l a-b"])
    assert [w for w in known.place if w.startswith("é")] == ["école"]

    def variant(change):
        other = Tokenizer.from_file(default_tokenizer())
        return change(other) or other

    def without_marks(other):
        spec = json.loads(other.to_str())
        spec["model"]["end_of_word_suffix"] = None
        return Tokenizer.from_str(json.dumps(spec))

    def split_th(other):
        other.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex("tht"), "isolated"), other.pre_tokenizer])

    def cased(other):
        other.normalizer = normalizers.NFC()

    def plain_letters(other):
        other.normalizer = normalizers.Sequence([normalizers.NFD(), normalizers.StripAccents(), normalizers.Lowercase()])

    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzàéèêçßÿøæABCDEÀÉÇØthththth"
    words = ["".join(rng.choices(letters, k=rng.randint(1, 9))) + rng.choice(["", "", ",", "!?", "'s", "0", "µ"])
             for _ in range(3_000)] + ["00", "0", "the", "The", "THE.", "</w>", "a</w>", "ªº", "ÿ"]
    texts = [" ".join(words[i:i + 40]) for i in range(0, len(words), 40)] + ["", " \n"]
    makes = [lambda other: None, without_marks, split_th, cased, plain_letters, lambda other: other.add_tokens(["ab"]) and None]
    for make in makes:
        tokenizer = variant(make)
        ids, at = token_ids(Words(tokenizer, 1, most_words=1_000), texts)
        for text, a, b in zip(texts, at, at[1:]):
            assert ids[a:b].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1], (make, text)
    assert Words(variant(split_th), 1).model is None and Words(usual, 1).last is not None


def test_packing_holds_a_small_part_of_a_batch():
    """A batch of 16 MB is encoded in parts: Python and NumPy hold less than 40 MB at once."""
    import tracemalloc

    import pyarrow as pa

    from tessera.llm.packing import _tokenised, default_tokenizer

    line = "the quick brown fox jumps over a lazy dog, and Then it sleeps. "
    batch = pa.record_batch([pa.array(range(4_000)), pa.array([line * 64] * 4_000)], names=["doc_id", "text"])
    run = _tokenised(default_tokenizer(), 2_048, 16, 1)
    next(run([batch.slice(0, 1)]))
    tracemalloc.start()
    try:
        rows = sum(part.num_rows for part in run([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 4_000
    assert peak < 40 << 20, peak
