"""Personal data and spelling variants against plain Python."""
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from llm_fixtures import COLUMNS, hard_texts, make, sentence
from tessera.llm import personal, spelling

# The base forms as they are stated.
FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(said):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(said))]
    return sum(v // 10 + v % 10 for v in doubled) % 10 == 0


def base(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(p) > 255 for p in m.group().split(".")) or
                    kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)) or
                    kind == "phone" and not 8 <= len(digits) <= 15):
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_forms():
    draw = random.Random(4)
    bits = ["a", "b.c", "@", ".", "-", " ", "+", "1", "23", "4111111111111111", "(555) ", "255", "256.", "é", "%", "\n",
            "1.2.3.4", "+1 523 555 1055", "x@y.z", "00", "_"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    for text in [*texts, "a@b.c@d.e", "1.2.3.4.5.6.7.8", "@a.b", "a@b", "+1" * 30, "1 " * 40, "9" * 4000 + ".1.1.1"]:
        raw = text.encode()
        place = personal._places(raw)
        assert [(personal.KINDS[k], place(a), place(b)) for k, a, b in personal.base_spans(raw)] == base(text), text


def test_long_texts_take_linear_time():
    for text in (b"a" * 400_000, b"1" * 400_000, b"1 " * 200_000 + b"x", b"+1" + b" (" * 200_000, b"@" * 400_000,
                 b"a." * 200_000 + b"@", b"1." * 200_000, b"a:" * 200_000):
        personal._read(text)


def test_contexts_find_unseen_identifiers(spark):
    number = [f"+1 (523) 555-{1000 + i}" for i in range(12)]
    texts = [f"write a line then call me {n} today {i}" for i, n in enumerate(number)]
    texts += ["so please call me 555-987-6543 today", "é call me 555-987-6543 today", "a list 555-111-2222 of parts",
              "known again 1 523 555 1003 here", None, "", "order 77 of 1234567 items"]
    documents, spans, patterns = personal.find_personal_data(make(spark, texts, extra=True))
    added = {tuple(r) for r in documents.select("doc_id", F.explode("added").alias("s")).select("doc_id", "s.*").collect()}
    assert added == {(12, 3, 18, 30), (13, 3, 10, 22), (15, 3, 12, 26)}
    assert {r.kind for r in patterns.collect()} == {3} and patterns.filter("pattern = 'call me _'").count() == 1
    assert documents.count() == len(texts) and documents.filter("size(base) > 0").count() == len(number)
    again = personal.find_personal_data(make(spark, texts).repartition(3))[1]
    assert rows(again.select("kind", "start", "end", "value", "conf")) == rows(spans.select("kind", "start", "end", "value", "conf"))


def graph(mentions, accept):
    """Confidence of unseen values, in plain Python."""
    seeds = {v: k for v, k, *_ in mentions if k >= 0}
    fits = {v: 0 for v, *_ in mentions}
    for v, _, f, _ in mentions:
        fits[v] = max(fits[v], f)
    edges = {(v, p) for v, _, _, ps in mentions for p in ps}
    size = Counter(p for _, p in edges)
    known = {v: (k, 1.0) for v, k in seeds.items()}
    for _ in range(8):
        held = Counter()
        for v, p in edges:
            if v in known:
                held[p, known[v][0]] += known[v][1]
        score = {pk: h / (size[pk[0]] + 2) for pk, h in held.items() if h / (size[pk[0]] + 2) >= accept}
        doubt = {}
        for v, p in edges:
            for k in range(4):
                if v not in seeds and fits[v] >> k & 1 and (p, k) in score:
                    doubt[v, k] = doubt.get((v, k), 1.0) * (1 - score[p, k])
        best = {}
        for (v, k), d in sorted(doubt.items()):
            if v not in best or 1 - d > best[v][1]:
                best[v] = (k, round(1 - d, 6))
        known = {**{v: (k, 1.0) for v, k in seeds.items()}, **best}
    return {(v, k, c) for v, (k, c) in known.items() if c >= accept}


def test_graph(spark):
    draw = random.Random(8)
    words = ["call", "card", "mail", "host"]
    data = []
    for i in range(400):
        kind = draw.randrange(4)
        seen = draw.random() < 0.7
        said = [f"{words[kind if draw.random() < 0.95 else 0]} {draw.randrange(4)} _" for _ in range(draw.randrange(3))]
        data.append((f"v{draw.randrange(150)}k{kind}{seen}", kind if seen else -1, 1 << kind if seen else 5 << (kind // 2), said))
    mentions = spark.createDataFrame(data * 2, "value string, kind int, fits int, patterns array<string>").repartition(4)
    for accept in (0.3, 0.5):
        _, known = personal.learn_patterns(mentions, accept)
        got, want = {(r.value, r.kind, r.conf / 1e6) for r in known.collect()}, graph(data, accept)
        assert sorted(got - want) == sorted(want - got)


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
            yield word[:i] + c + word[i + 1:]
        yield word[:i] + word[i + 1:]


def variants(counts):
    letters = sorted({c for w in counts for c in w})
    near = {w: {e for e in edits(w, letters) if e != w and e in counts} for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= 5 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [500, 3, 0])
def test_variants(spark, hot):
    draw = random.Random(2)
    counts = {}
    for _ in range(60):
        word = "".join(draw.choice("abcé") for _ in range(draw.randint(4, 8)))
        counts[word] = draw.randint(5, 4000)
        for e in draw.sample([e for e in edits(word, "abcé") if len(e) >= 4], 12):
            counts.setdefault(e, draw.randint(5, 300))
    counts.update({"aaaaaa": 9, "aaaaaaa": 50, "aaaaaaaa": 300, "bbbb": 7, "ÿÿÿÿÿ": 5})
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5).withColumn("gram", F.lit(1))
    got = spelling.group_variants(df, hot_entries=hot).select("word", "form", "root", "n", "n_near", "form_n")
    assert rows(got) == variants(counts)
    assert spelling.group_variants(df.limit(0)).count() == 0


def words_of(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                counts[run] += 1
    return sorted(((w, n) for w, n in counts.items() if n >= 2), key=repr)


def test_words(spark):
    draw = random.Random(6)
    texts = hard_texts() + [" ".join(draw.choice(["Straße", "ÉCOLE_école", "running9running", "abcdef", "×÷ßßßß", "Running"])
                                     for _ in range(60)) for _ in range(120)] + [sentence(3, 50).replace("0", "o")]
    df = make(spark, texts, extra=True).withColumn("word", F.lit("clash"))
    df = df.union(df.limit(3)).withColumn("doc_id", F.when(F.col("doc_id") != 50, F.col("doc_id")))
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert rows(spelling.word_counts(df, min_count=2, drop_every=199)) == words_of(docs)
    assert spelling.word_counts(df.limit(0)).count() == 0


def test_registered_queries_on_hard_rows(spark, tmp_path):
    texts = hard_texts() + ["call +1 (523) 555-1055 or a.b@c.de or 4111111111111111 at 1.2.3.4"] * 2
    docs = make(spark, texts)
    docs = docs.union(spark.createDataFrame([(None, None, None, None, None)], COLUMNS))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = personal.op11_personal_data(spark, str(tmp_path)).collect()
    want = sorted((",".join("%s:%d:%d" % s for s in base(t or "")) for t in [*texts, None]), key=repr)
    assert sorted(r.spans for r in got) == want
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got) == sum(len(base(t or "")) for t in texts)
    assert spelling.op12_spelling_variants(spark, str(tmp_path)).columns == ["word", "form", "root", "n", "n_near", "form_n"]
