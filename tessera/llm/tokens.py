"""Edit-aware token counts: a segment tree of pre-tokens for each document."""

from __future__ import annotations

import base64

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.arrays import texts_of

LEAF = 64
MEMORY = 400_000


class Counter:
    """Tokens of a pre-token, by a vocabulary file; a bounded number of pre-tokens is remembered."""

    def __init__(self, path: str, pattern: str, memory: int = MEMORY):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("edit-aware", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(pattern).findall
        self.match = regex.compile(pattern).match
        self.known: dict[str, int] = {}
        self.memory = memory

    def counts(self, parts: list[str]) -> list[int]:
        out = list(map(self.known.get, parts))
        if None in out:
            if len(self.known) > self.memory:
                self.known.clear()
            for i, n in enumerate(out):
                if n is None:
                    n = self.known.get(parts[i])
                    if n is None:
                        n = self.known[parts[i]] = len(self.encoding.encode_ordinary(parts[i]))
                    out[i] = n
        return out


class TokenTree:
    """Pre-tokens of a text in leaves, with sums of characters and tokens above them.

    ``edit`` splits and encodes anew only what the edit touches: from the last boundary that the change
    cannot reach to the first old boundary that the new split meets again.
    """

    def __init__(self, text: str, counter: Counter):
        self.counter, self.encoded = counter, 0
        self._build(text)

    def _build(self, text: str) -> None:
        parts = self.counter.split(text)
        self.text = text
        tokens, sizes = self.counter.counts(parts), list(map(len, parts))
        self.encoded += len(parts)
        self.leaves = [(sizes[i:i + LEAF], tokens[i:i + LEAF]) for i in range(0, len(parts), LEAF)] or [([], [])]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.sums = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (s, t) in enumerate(self.leaves):
            self.chars[self.width + i], self.sums[self.width + i] = sum(s), sum(t)
        for node in range(self.width - 1, 0, -1):
            self._pull(node)

    def _pull(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    @property
    def total(self) -> int:
        return self.sums[1]

    def _leaf(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character and where the leaf starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if start + self.chars[node] <= place and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return min(node - self.width, len(self.leaves) - 1), start

    def edit(self, start: int, end: int, put: str) -> None:
        """Replace the characters from ``start`` to ``end`` (excluded) by ``put``."""
        text = self.text[:start] + put + self.text[end:]
        # a match may look at two characters after its end, so a part that ends before start - 1 stands
        first, at = self._leaf(max(0, start - 2))
        while first and at >= max(1, start - 1):
            first -= 1
            at -= self.chars[self.width + first]
        sizes, tokens = self.leaves[first]
        kept, place = 0, at
        while kept < len(sizes) and place + sizes[kept] < start - 1:
            place += sizes[kept]
            kept += 1
        # old boundaries from here on, moved by the edit
        shift = len(put) - (end - start)
        leaf, spot, old = first, kept, place
        fresh, now = [], place
        while True:
            while old + shift < now or old < end:
                if spot < len(self.leaves[leaf][0]):
                    old += self.leaves[leaf][0][spot]
                    spot += 1
                elif leaf + 1 < len(self.leaves):
                    leaf, spot = leaf + 1, 0
                else:
                    break
            if old >= end and old + shift == now or now >= len(text):
                break
            part = self.counter.match(text, now).group()
            fresh.append(part)
            now += len(part)
        counts = self.counter.counts(fresh)
        self.encoded += len(fresh)
        if now >= len(text):
            leaf, spot = len(self.leaves) - 1, len(self.leaves[-1][0])
        rest = self.leaves[leaf][0][spot:], self.leaves[leaf][1][spot:]
        self.text = text
        merged = (sizes[:kept] + list(map(len, fresh)) + rest[0], tokens[:kept] + counts + rest[1])
        for i in range(first, leaf + 1):
            self.leaves[i] = merged if i == first else ([], [])
        if len(merged[0]) > 16 * LEAF:
            self._split(first)
            return
        touched = set()
        for i in range(first, leaf + 1):
            self.chars[self.width + i], self.sums[self.width + i] = sum(self.leaves[i][0]), sum(self.leaves[i][1])
            touched.add((self.width + i) // 2)
        while touched and max(touched):
            for node in touched:
                if node:
                    self._pull(node)
            touched = {node // 2 for node in touched}

    def _split(self, number: int) -> None:
        """Cut a leaf that has grown and set the tree up again from the counts it has."""
        sizes = [s for leaf in self.leaves for s in leaf[0]]
        tokens = [t for leaf in self.leaves for t in leaf[1]]
        self.leaves = [(sizes[i:i + LEAF], tokens[i:i + LEAF]) for i in range(0, len(sizes), LEAF)] or [([], [])]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.sums = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (s, t) in enumerate(self.leaves):
            self.chars[self.width + i], self.sums[self.width + i] = sum(s), sum(t)
        for node in range(self.width - 1, 0, -1):
            self._pull(node)


def sample_edits(text: str, lang: str, source: str) -> list[tuple[int, int, str]]:
    """The edits of the query, each in places of the text it meets: a cut, an insertion, a change, an addition."""
    n = len(text)
    out = [(n // 4, min(n, n // 4 + 8), "")]
    n -= out[0][1] - out[0][0]
    out.append((n // 2, n // 2, f" {lang} "))
    n += len(out[-1][2])
    a = 3 * n // 4
    out.append((a, min(n, a + 12), text[:12]))
    n += len(out[-1][2]) - (out[-1][1] - a)
    out.append((n, n, f"\n{source}"))
    return out


def count_edited(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
                 lang: str = "lang", source: str = "source", edits=sample_edits) -> DataFrame:
    """Token counts of each document before and after its edits, without encoding the edited text whole.

    Output: ``doc_id, n_tokens, n_edited_tokens, n_pieces`` (pre-tokens of the text) and ``n_encoded``
    (pre-tokens encoded for the edits). ``edits(text, lang, source)`` lists (start, end, replacement), each
    for the text the one before left. A document is a row and needs no other, so nothing is shuffled.

    Null texts, languages and sources count as empty; an empty table gives an empty table; other columns are
    not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))

    def run(batches):
        counter = Counter(path, pattern)
        for batch in batches:
            out = []
            for body, a, b in zip(texts_of(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                body = body.decode()
                tree = TokenTree(body, counter)
                whole, parts = tree.total, tree.encoded
                for start, end, put in edits(body, a, b):
                    tree.edit(start, end, put)
                out.append((whole, tree.total, parts, tree.encoded - parts))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([o[i] for o in out], pa.int64())
                                                                 for i in range(4)]],
                                             ["doc_id", "n_tokens", "n_edited_tokens", "n_pieces", "n_encoded"])

    return (docs.select(F.col(doc_id).alias("doc_id"), blank(text).alias("t"), blank(lang).alias("l"),
                        blank(source).alias("s"))
            .mapInArrow(run, f"doc_id {kind}, n_tokens long, n_edited_tokens long, n_pieces long, n_encoded long"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, four edits each."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_edited(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
