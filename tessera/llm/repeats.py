"""Repeated windows of fixed width over all texts, found exactly with bounded memory.

Three steps, each one shuffle of packed rows:

1. A sample of short runs of every text is hashed and counted: anchors, of which two equal windows always
   share one, and marks, chosen by their own hash. A bitmap of the runs seen twice (fixed size, broadcast)
   rules out nearly every window that is not repeated: one must hold a repeated anchor and no unrepeated mark.
2. Windows that are left and follow each other under one minimiser (the least run hash in the window)
   travel as one packed string to the bucket of that minimiser. Windows under a very frequent minimiser
   travel as hashes to buckets of their own, so no bucket is hot.
3. Buckets are sorted one at a time: windows of bytes as suffixes of the bucket's strings
   (:mod:`tessera.llm.suffix_order`), windows of words and those that travel as hashes by 128-bit hashes.
   A window that meets its equal there is repeated.

Spans are kept by the hash of the whole text: equal texts have equal spans.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.arrays import U64, Block, pieces, prefix, rolling, runs_hash, sliding, split_by
from tessera.llm.suffix_order import equal_neighbours
from tessera.session import cut_lineage

BITMAP_BITS = 28
HOT_STRINGS = 2_000
HOT_KEYS = 1 << 16
CHUNK_WINDOWS = 200_000


@dataclass(frozen=True)
class Windows:
    """``width`` units (bytes or words), minimisers of ``gram`` units.

    With ``cover`` = (period, residues, length) the anchors are the runs of ``length`` units at the residues
    of a difference cover; without it they are the minimisers. One run hash in ``marks`` is a mark.
    """

    words: bool
    width: int
    gram: int
    cover: tuple[int, tuple[int, ...], int] | None = None
    marks: int = 16


class _Units:
    """A block in units of the plan: bytes, or words by their hash."""

    def __init__(self, plan: Windows, block: Block):
        self.plan, self.block = plan, block
        if plan.words:
            self.starts, self.ends, self.low, self.high = block.words()
        else:
            self.low, self.high = block.start, block.end
        self.count = len(self.starts) if plan.words else len(block.bytes)
        fits = self.high - self.low >= plan.width
        step = np.zeros(self.count + 2, np.int32)
        step[self.low[fits]] += 1
        step[self.high[fits] - plan.width + 1] -= 1
        self.valid = np.cumsum(step)[:max(0, self.count - plan.width + 1)] > 0

    def sums(self, seed: int = 0) -> np.ndarray:
        sums = self.block.byte_sums(seed)
        return prefix(runs_hash(sums, self.starts, self.ends, seed), seed) if self.plan.words else sums

    def slice(self, first: int, last: int) -> bytes:
        """Bytes of the units from ``first`` to ``last``, both included."""
        if self.plan.words:
            return self.block.raw[self.starts[first]:self.ends[last]]
        return self.block.raw[first:last + 1]

    def minima(self, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Run hashes and, for each window, the least of them."""
        grams = rolling(sums, self.plan.gram)
        return grams, sliding(grams, self.plan.width - self.plan.gram + 1)[:len(self.valid)]

    def sample(self, sums: np.ndarray, grams: np.ndarray, least: np.ndarray):
        """``(runs, anchors, marks, span)``: a hash at each place, which places are anchors and which are marks.

        Equal windows share an anchor: a place of the cover, or the minimiser. Marks are chosen by their own
        hash alone, so every mark in a repeated window is seen again. A run may start at ``span`` places of
        a window.
        """
        if self.plan.cover:
            period, residues, length = self.plan.cover
            runs = rolling(sums, length)
            chosen = np.zeros(period, bool)
            chosen[list(residues)] = True
            anchors = np.zeros(len(runs), bool)
            inside = np.zeros(len(runs), bool)
            for low, high in zip(self.low.tolist(), self.high.tolist()):
                if high - low >= length:
                    stop = high - length + 1
                    anchors[low:stop] = np.resize(chosen, stop - low)
                    inside[low:stop] = True
        else:
            length, runs = self.plan.gram, grams
            span = self.plan.width - length + 1
            edge = np.zeros(span - 1, np.uint64)
            shown = np.concatenate([edge, np.where(self.valid, least, 0), edge])
            anchors = sliding(shown, span, np.maximum)[:len(grams)] == grams
            step = np.zeros(self.count + 2, np.int32)
            np.add.at(step, self.low, 1)
            np.add.at(step, np.maximum(self.low, self.high - length + 1), -1)
            inside = np.cumsum(step)[:len(runs)] > 0
        marks = inside & (runs % U64(self.plan.marks) == 0)
        return runs, anchors, marks, self.plan.width - length + 1


def _keys(valid: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Where a new run of neighbouring windows under one minimiser starts."""
    first = valid.copy()
    if len(first) > 1:
        first[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    return np.flatnonzero(first)


_COUNTED = "bucket int, kind int, data binary"


def _count_runs(plan: Windows, bits: int):
    """Batch function of step 1: sampled run hashes (kind 0) and minimisers (kind 1) by their top bits."""

    def rows(held):
        out = []
        for kind, arrays in enumerate(held):
            values = np.sort(np.concatenate(arrays)) if arrays else np.zeros(0, np.uint64)
            top = (values >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)
            out += [(b, kind, values[x:y].tobytes()) for b, x, y in split_by(top)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()),
                                           pa.array([r[1] for r in out], pa.int32()),
                                           pa.array([r[2] for r in out], pa.binary())], ["bucket", "kind", "data"])

    def run(batches):
        held, size = ([], []), 0
        for batch in batches:
            for _, _, texts in pieces(batch.column(0)):
                units = _Units(plan, Block(texts))
                sums = units.sums()
                grams, least = units.minima(sums)
                runs, anchors, marks, _ = units.sample(sums, grams, least)
                held[0].append(runs[anchors | marks])
                held[1].append(least[_keys(units.valid, least)])
                size += len(units.block.raw)
                if size > 4 << 20:
                    yield rows(held)
                    held, size = ([], []), 0
        yield rows(held)

    return run


def _seen(bits: int, hot_strings: int, hot_keys: int):
    """Batch function: for each bucket a bitmap page of hashes seen twice, and its frequent minimisers."""
    page_bits = BITMAP_BITS - bits

    def finish(bucket, kind, parts):
        values = np.sort(np.frombuffer(b"".join(parts), np.uint64))
        if kind == 0:
            twice = values[1:][values[1:] == values[:-1]]
            page = np.zeros(1 << page_bits, bool)
            page[((twice >> U64(64 - BITMAP_BITS)) & U64((1 << page_bits) - 1)).astype(np.int64)] = True
            return bucket, kind, zlib.compress(np.packbits(page).tobytes(), 1)
        found, counts = np.unique(values, return_counts=True)
        often = np.argsort(-counts, kind="stable")[:max(1, hot_keys >> bits)]
        often = often[counts[often] > hot_strings]
        return bucket, kind, found[often].tobytes()

    def run(batches):
        now, parts = None, []
        out = []
        for batch in batches:
            for b, k, data in zip(*[c.to_pylist() for c in batch.columns]):
                if (b, k) != now and parts:
                    out.append(finish(*now, parts))
                    parts = []
                now = (b, k)
                parts.append(data)
        if parts:
            out.append(finish(*now, parts))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()),
                                          pa.array([r[1] for r in out], pa.int32()),
                                          pa.array([r[2] for r in out], pa.binary())], ["bucket", "kind", "data"])

    return run


_SHIPPED = "hot boolean, slot long, payload binary, k1 long, k2 long, first int, owners binary, refs binary"


def _ship(plan: Windows, bitmap, hot, buckets: int):
    """Batch function of step 2: packed strings, and hashes of the windows under frequent minimisers."""

    def row_batch(out):
        names = ["hot", "slot", "payload", "k1", "k2", "first", "owners", "refs"]
        kinds = [pa.bool_(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names)

    def packed(units, windows, text, keys, sums):
        """Rows of window hashes by bucket, with the texts they come from."""
        one, two = (runs_hash(s, windows, windows + plan.width, i) for i, s in enumerate(sums))
        slot = (one % U64(buckets)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        one, two, slot, windows, text = one[order], two[order], slot[order], windows[order], text[order]
        for s, a, b in split_by(slot):
            own, index = np.unique(text[a:b], return_inverse=True)
            refs = np.stack([index, windows[a:b] - units.low[text[a:b]]]).astype(np.int32)
            yield (True, s, one[a:b].tobytes() + two[a:b].tobytes(), None, None, None, keys[own].tobytes(),
                   refs.tobytes())

    def run(batches):
        seen, often = np.frombuffer(zlib.decompress(bitmap.value), np.uint8), hot.value
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)], axis=1)
            for a, b, texts in pieces(batch.column(0)):
                units = _Units(plan, Block(texts))
                if not units.valid.any():
                    continue
                sums = units.sums()
                grams, least = units.minima(sums)
                runs, anchors, marks, span = units.sample(sums, grams, least)
                at = (runs >> U64(64 - BITMAP_BITS)).astype(np.int64)
                twice = (seen[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0

                def number(mask):
                    """How many places of each window the mask holds."""
                    before = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
                    return before[span:span + len(units.valid)] - before[:len(units.valid)]

                open_ = units.valid & (number(anchors & twice) > 0) & (number(marks & ~twice) == 0)
                starts = _keys(open_, least)
                if not len(starts):
                    continue
                # a run ends where the next one starts or where no window is open
                closed = np.flatnonzero(~open_)
                stops = np.minimum(np.append(starts[1:], len(open_)),
                                   np.append(closed, len(open_))[np.searchsorted(closed, starts)])
                text = np.searchsorted(units.low, starts, side="right") - 1
                key = least[starts]
                near = np.minimum(np.searchsorted(often, key), max(0, len(often) - 1))
                frequent = often[near] == key if len(often) else np.zeros(len(key), bool)
                own = keys[a:b]
                out = [(False, k, units.slice(s, e + plan.width - 2), int(own[t, 0]), int(own[t, 1]),
                        int(s - units.low[t]), None, None)
                       for k, s, e, t in zip(key[~frequent].view(np.int64).tolist(), starts[~frequent].tolist(),
                                             stops[~frequent].tolist(), text[~frequent].tolist())]
                if frequent.any():
                    size = (stops - starts)[frequent]
                    windows = np.repeat(starts[frequent] - np.cumsum(size) + size, size) + np.arange(size.sum())
                    out += packed(units, windows, np.repeat(text[frequent], size), own, (sums, units.sums(1)))
                for i in range(0, len(out), 5_000):
                    yield row_batch(out[i:i + 5_000])

    return run


_SPANS = "k1 long, k2 long, spans binary"


def _either(same: np.ndarray) -> np.ndarray:
    """Which of some neighbours equal the one before or the one behind, from the equality of each with the next."""
    again = np.zeros(len(same) + 1, bool)
    again[1:] |= same
    again[:-1] |= same
    return again


def _equal_hashes(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which windows have an equal, by both of their hashes."""
    order = np.argsort(one)
    same = one[order][1:] == one[order][:-1]
    if (two[order][1:][same] != two[order][:-1][same]).any():
        order = np.lexsort((two, one))
        same = one[order][1:] == one[order][:-1]
    return order[_either(same & (two[order][1:] == two[order][:-1]))]


def _resolve(plan: Windows):
    """Batch function of step 3: sort whole buckets, a bounded number of windows at a time."""

    def settle(rows):
        hashes, owners, places, found = [], [], [], []
        keys: list[tuple[int, int]] = []
        cold = [r for r in rows if not r[0]]
        if cold:
            units = _Units(plan, Block([r[2] for r in cold]))
            windows = np.flatnonzero(units.valid)
            if not plan.words:
                windows, same = equal_neighbours(units.block.raw, windows, plan.width)
                windows = windows[_either(same[1:])]
            text = np.searchsorted(units.low, windows, side="right") - 1
            at = np.array([r[5] for r in cold])[text] + windows - units.low[text]
            if plan.words:
                hashes.append([runs_hash(units.sums(i), windows, windows + plan.width, i) for i in (0, 1)])
                owners.append(text)
                places.append(at)
            else:
                found.append((text, at))
            keys += [(r[3], r[4]) for r in cold]
        for r in rows:
            if r[0]:
                hashes.append(np.frombuffer(r[2], np.uint64).reshape(2, -1))
                index, at = np.frombuffer(r[7], np.int32).reshape(2, -1)
                owners.append(index.astype(np.int64) + len(keys))
                places.append(at)
                keys += map(tuple, np.frombuffer(r[6], np.int64).reshape(-1, 2).tolist())
        if hashes:
            hit = _equal_hashes(*np.concatenate(hashes, axis=1))
            found.append((np.concatenate(owners)[hit], np.concatenate(places)[hit]))
        owner, place = (np.concatenate(x) for x in zip(*found))
        if not len(owner):
            return None
        names, ids = np.unique(np.array(keys, np.int64).reshape(-1, 2), axis=0, return_inverse=True)
        spot = np.unique((ids.ravel()[owner].astype(np.int64) << 32) | place.astype(np.int64))
        cut = np.flatnonzero(np.diff(spot) != 1) + 1
        first, last = spot[np.append(0, cut)], spot[np.append(cut - 1, len(spot) - 1)]
        spans = np.stack([first & 0xFFFFFFFF, (last & 0xFFFFFFFF) + 1], axis=1).astype(np.int32)
        found = split_by(first >> 32)
        return pa.RecordBatch.from_arrays([pa.array([names[n, 0] for n, _, _ in found], pa.int64()),
                                           pa.array([names[n, 1] for n, _, _ in found], pa.int64()),
                                           pa.array([spans[a:b].tobytes() for _, a, b in found], pa.binary())],
                                          ["k1", "k2", "spans"])

    def run(batches):
        rows, size, now = [], 0, None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if size > CHUNK_WINDOWS and row[:2] != now:
                    if (out := settle(rows)) is not None:
                        yield out
                    rows, size = [], 0
                now = row[:2]
                rows.append(row)
                size += len(row[2]) // (16 if row[0] else 6 if plan.words else 1)
        if rows and (out := settle(rows)) is not None:
            yield out

    return run


def text_key(text) -> list:
    """128 bits of a text as two columns; null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("__k1"), F.xxhash64(F.lit(1), whole).alias("__k2")]


def repeated_spans(docs: DataFrame, text: str, plan: Windows, hot_strings: int = HOT_STRINGS,
                   hot_keys: int = HOT_KEYS) -> DataFrame:
    """``__k1, __k2, __spans``: for each distinct text with repeated windows its lists of (start, end) runs.

    The runs hold starts of repeated windows and may overlap between lists. The two broadcasts are a bitmap
    of 2^28 bits and at most ``hot_keys`` frequent minimisers (or one a bucket), whatever the input's size;
    both only steer the work and change no result.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text), F.lit("")).alias("__text")
    size = docs.agg(F.sum(F.octet_length(text))).head()[0] or 0
    bits = int(min(22, max(6, np.ceil(np.log2(max(1, size) / (8 << 20))))))
    counted = (docs.select(whole).mapInArrow(_count_runs(plan, bits), _COUNTED)
               .repartition("bucket", "kind").sortWithinPartitions("bucket", "kind")
               .mapInArrow(_seen(bits, hot_strings, hot_keys), _COUNTED))
    page = 1 << (BITMAP_BITS - bits - 3)
    bitmap, hot = np.zeros(1 << (BITMAP_BITS - 3), np.uint8), [np.zeros(0, np.uint64)]
    for row in counted.collect():
        if row.kind == 0:
            bitmap[row.bucket * page:(row.bucket + 1) * page] = np.frombuffer(zlib.decompress(row.data), np.uint8)
        else:
            hot.append(np.frombuffer(row.data, np.uint64))
    often = np.sort(np.concatenate(hot))
    shared = spark.sparkContext.broadcast(zlib.compress(bitmap.tobytes(), 1))
    frequent = spark.sparkContext.broadcast(often)
    spans = (docs.select(whole, *text_key(F.col(text)))
             .mapInArrow(_ship(plan, shared, frequent, 1 << min(16, bits + 4)), _SHIPPED)
             .repartition("hot", "slot").sortWithinPartitions("hot", "slot")
             .mapInArrow(_resolve(plan), _SPANS))
    return cut_lineage(spans.groupBy(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"))
                       .agg(F.collect_list("spans").alias("__spans")))


def cover_mask(count: int, spans: list[bytes] | None, width: int) -> np.ndarray:
    """Which of ``count`` units lie in a repeated window."""
    step = np.zeros(count + 1, np.int32)
    for part in spans or ():
        for a, b in np.frombuffer(part, np.int32).reshape(-1, 2).tolist():
            step[a] += 1
            step[b + width - 1] -= 1
    return np.cumsum(step)[:count] > 0
