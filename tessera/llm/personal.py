"""Personal data: identifiers by form, and unseen ones by contexts learnt from them (bootstrapping)."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.arrays import pieces
from tessera.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# The forms of base identifiers. Quantifiers that give nothing back say the same in linear time.
_DOMAIN = re.compile(rb"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(rb"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")

# Forms an unseen identifier may have, wider than the base forms.
_LOOSE_MAIL = re.compile(rb"[^\s@,;:<>()\"']{1,64}@[^\s@,;:<>()\"']{1,64}")
_GROUPS = re.compile(rb"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,7}(?![0-9A-Za-z:])")
_SOME_GROUPS = re.compile(rb"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:")
_NUMBER = re.compile(rb"\(?[0-9](?:[\x20().\-/]{0,2}[0-9])*+")
_DIGIT = re.compile(rb"[0-9]")
_WORD = re.compile(rb"[A-Za-z\x80-\xFF]+")
_NO_DIGIT = bytes(b for b in range(256) if not 48 <= b <= 57)

_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
_MENTION = pa.struct([("value", pa.string()), ("kind", pa.int32()), ("fits", pa.int32()), ("start", pa.int32()),
                      ("end", pa.int32()), ("patterns", pa.list_(pa.string()))])
_DDL = ("base array<struct<kind:int,start:int,end:int>>, mentions array<struct<value:string,kind:int,fits:int,"
        "start:int,end:int,patterns:array<string>>>")


def luhn(digits: bytes) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for i, b in enumerate(reversed(digits)):
        v = (b - 48) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _emails(text: bytes):
    at, done = text.find(b"@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find(b"@", max(at + 1, done))


def _small(part: bytes) -> bool:
    part = part.lstrip(b"0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in bytes of the base identifiers, by kind and start."""
    spans = [(EMAIL, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        spans += [(IP, *m.span()) for m in _IP.finditer(text) if all(map(_small, m.groups()))]
        for m in _CARD.finditer(text):
            digits = m.group().translate(None, _NO_DIGIT)
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append((CARD, *m.span()))
        spans += [(PHONE, *m.span()) for m in _PHONE.finditer(text)
                  if 8 <= len(m.group().translate(None, _NO_DIGIT)) <= 15]
    return spans


def _value(kind: int, said: bytes) -> str:
    """What an identifier is told by: digits of numbers, else lower-case text."""
    said = said.translate(None, _NO_DIGIT) if kind in (CARD, PHONE) else said.lower()
    return said.decode("utf-8", "replace")


def _free(found: list[tuple], taken: list[tuple]) -> list[tuple]:
    """The found spans (first two fields) that meet none of the taken ones; both in order of start."""
    out, i = [], 0
    for span in found:
        while i < len(taken) and taken[i][1] <= span[0]:
            i += 1
        if i == len(taken) or taken[i][0] >= span[1]:
            out.append(span)
    return out


def _loose(text: bytes, taken: list[tuple[int, int]]) -> list[tuple[int, int, str, int]]:
    """``start, end, value, fits`` of identifier-like tokens beside the taken spans; bit k of fits: may be kind k."""
    out = []

    def add(found):
        fresh = _free(found, taken)
        out.extend(fresh)
        taken[:] = sorted([*taken, *[f[:2] for f in fresh]])

    if b"@" in text:
        add([(m.start(), m.start() + len(said), _value(EMAIL, said), 1 << EMAIL) for m in _LOOSE_MAIL.finditer(text)
             for said in [m.group().rstrip(b".!?")] if not said.endswith(b"@")])
    if _SOME_GROUPS.search(text):
        add([(*m.span(), _value(IP, m.group()), 1 << IP) for m in _GROUPS.finditer(text)])
    if _DIGIT.search(text):
        numbers = []
        for m in _NUMBER.finditer(text):
            a, b = m.span()
            if text[a - 1:a].isalnum() or text[b:b + 1].isalnum():
                continue
            value = _value(CARD, m.group())
            fits = (12 <= len(value) <= 19) << CARD | (7 <= len(value) <= 15) << PHONE
            numbers.append((a, b, value if fits else m.group().decode(), fits))
        add(numbers)
    return out


def _patterns(text: bytes, start: int, end: int) -> list[str]:
    """Lexical patterns around a span: two words before it; the words on both sides; a word with a mark before it."""
    before = text[max(0, start - 64):start]
    words = _WORD.findall(before.lower())[-2:]
    behind = _WORD.search(text, end, end + 32)
    near = words[-1] if words else b""
    said = []
    if len(words) == 2:
        said.append(b"%s %s _" % tuple(words))
    if near and behind:
        said.append(b"%s _ %s" % (near, behind.group().lower()))
    mark = before.rstrip()[-1:]
    if near and mark in (b":", b"=", b"#"):
        said.append(b"%s%s _" % (near, mark))
    return [s.decode("utf-8", "replace") for s in said]


def _places(text: bytes):
    """Function from byte to code point offsets."""
    if text.isascii():
        return lambda at: at
    before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return lambda at: int(before[at])


def _read(text: bytes) -> tuple[list[dict], list[dict]]:
    base = base_spans(text)
    loose = _loose(text, sorted((a, b) for _, a, b in base))
    if not base and not loose:
        return [], []
    place = _places(text)
    spans = [{"kind": k, "start": place(a), "end": place(b)} for k, a, b in base]
    found = [(_value(k, text[a:b]), k, 1 << k, a, b) for k, a, b in base]
    found += [(value, -1, fits, a, b) for a, b, value, fits in loose]
    return spans, [{"value": v, "kind": k, "fits": fits, "start": place(a), "end": place(b),
                    "patterns": _patterns(text, a, b)} for v, k, fits, a, b in found]


def _scan(batches):
    for batch in batches:
        for a, b, texts in pieces(batch.column(1)):
            read = [_read(t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(a, b - a), pa.array([r[0] for r in read], pa.list_(_SPAN)),
                pa.array([r[1] for r in read], pa.list_(_MENTION))], ["doc_id", "base", "mentions"])


def learn_patterns(mentions: DataFrame, accept: float = 0.8, rounds: int = 8) -> tuple[DataFrame, DataFrame]:
    """``(patterns, instances)`` of the graph of ``value, kind, fits, patterns``, by turns scored from each other.

    A value seen as a base identifier has confidence 1 in its kind. A pattern's score for a kind is the confidence
    of its distinct values by their number plus two, so a pattern needs support and no other company; those of at
    least ``accept`` count. An unseen value gets the noisy or of the counting patterns it stands in, for the kinds
    it fits; its best kind stays. Rounds end when no score changes, after ``rounds`` at most. Confidences are whole
    millionths, so sums do not depend on their order.

    ``patterns``: ``pattern, kind, score``; ``instances``: ``value, kind, conf`` of at least ``accept``.
    """
    values = mentions.groupBy("value").agg(F.max("kind").alias("seed"), F.max("fits").alias("fits"))
    edges = mentions.select("value", F.explode("patterns").alias("pattern")).distinct()
    edges = cut_lineage(edges.join(values, "value"))
    size = cut_lineage(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("size")))
    seeds = cut_lineage(values.filter("seed >= 0").select("value", F.col("seed").alias("kind"),
                                                          F.lit(1_000_000).cast("bigint").alias("conf")))
    kinds = F.explode(F.array(*[F.lit(k) for k in range(len(KINDS))]))
    open_edges = (edges.filter("seed < 0 AND fits > 0").select("value", "pattern", "fits", kinds.alias("kind"))
                  .filter(F.expr("shiftright(fits, kind) & 1 = 1")).drop("fits"))
    known, before = seeds, None
    for _ in range(rounds):
        score = F.col("held") / (1_000_000 * (F.col("size") + 2))
        scored = (edges.select("value", "pattern").join(known, "value").groupBy("pattern", "kind")
                  .agg(F.sum("conf").alias("held")).join(size, "pattern")
                  .select("pattern", "kind", score.alias("score")).filter(F.col("score") >= accept))
        scored = cut_lineage(scored)
        state = tuple(scored.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("pattern", "kind", "score"))).head())
        found = (open_edges.join(scored, ["pattern", "kind"]).groupBy("value", "kind")
                 .agg(F.sum(F.log(1 - F.col("score"))).alias("doubt"))
                 .select("value", "kind", F.round((1 - F.exp("doubt")) * 1_000_000).cast("bigint").alias("conf"))
                 .groupBy("value").agg(F.max(F.struct("conf", (-F.col("kind")).alias("less"))).alias("best"))
                 .select("value", (-F.col("best.less")).alias("kind"), F.col("best.conf").alias("conf")))
        known = cut_lineage(seeds.unionByName(found))
        if state == before:
            break
        before = state
    return scored, known.filter(F.col("conf") >= round(accept * 1_000_000))


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", accept: float = 0.8,
                       rounds: int = 8) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(documents, spans, patterns)`` of a search for e-mail and IP addresses, card and phone numbers.

    Every text is read once, whole: base identifiers by their forms, and other identifier-like tokens (numbers,
    groups of hexadecimal digits, words with an at sign) beside them, each with the lexical patterns around it.
    Base identifiers are the seeds of :func:`learn_patterns`; a token is added as a span if its value is known
    from a base identifier, or if patterns of high confidence say so. Values and patterns are counted once
    however many copies of a text hold them.

    ``documents``: ``row, doc_id, base`` (spans by kind and start) and ``added``; ``spans``: ``row, kind, start,
    end, value, conf`` of the added ones; offsets are code points, ``end`` excluded. Null texts count as empty;
    repeated rows are documents of their own; empty tables give empty tables; other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    scanned = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(
        _scan, f"doc_id {kind}, {_DDL}")
    scanned = cut_lineage(scanned.withColumn("row", F.monotonically_increasing_id()))
    mentions = scanned.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    patterns, known = learn_patterns(mentions, accept, rounds)
    spans = cut_lineage(mentions.filter("kind < 0 AND fits > 0").drop("kind").join(known, "value")
                        .filter(F.expr("shiftright(fits, kind) & 1 = 1"))
                        .select("row", "kind", "start", "end", "value", (F.col("conf") / 1_000_000).alias("conf")))
    added = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    documents = scanned.select("row", "doc_id", "base").join(added, "row", "left")
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return documents.withColumn("added", F.coalesce("added", none)), spans, patterns


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; counts and digest of the base spans, and all spans."""
    found, _, _ = find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def said(spans):
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    return found.select("doc_id", *[count(k) for k in range(len(KINDS))], F.sha2(said(F.col("base")), 256)
                        .alias("base_sha256"), said(F.concat("base", "added")).alias("spans"))
