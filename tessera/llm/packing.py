"""Packing of tokenised documents into windows: non-negative least squares on the histogram of lengths."""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.arrays import ranges
from tessera.session import cut_lineage

WINDOW = 2_048
CHUNK = 16
SHARD_ROWS = 20_000
RESIDUAL_ROWS = 5_000
PIECE_BYTES = 2 << 20
WORDS = 500_000
KEPT_WORDS = 100_000
SIGN = "0"  # a word that stands behind each of many words encoded in one text
TAIL = ".,!?;:$%*#"  # signs at the end of a word that can be encoded apart from it
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"  # of ASCII and Latin-1, as a class of characters
WHOLE = "^[a-z\u00df-\u00f6\u00f8-\u00ff]+$"  # words of lower-case letters
BEFORE = {c for c in map(chr, range(256)) if c.isascii() and c.isalnum() or c >= "\u00c0" and c.isalpha()}


def names_letters(spec: str) -> bool:
    """If a pattern in the JSON of a normalizer or pre-tokenizer has letters or braces.

    Classes such as ``\\p{L}`` and letters behind an apostrophe do not count: no run of letters alone meets these.
    """
    node, found = [json.loads(spec)], []
    while node:
        one = node.pop()
        if isinstance(one, dict):
            found += (one.get("pattern") or {}).values()
        if isinstance(one, (dict, list)):
            node += one.values() if isinstance(one, dict) else one
    bare = (re.sub(r"\\[pP]\{\w+\}|\\[sSdDwWrnt]|'[a-z]+", "", pattern) for pattern in found)
    return any(c.isalpha() or c in "{}" for pattern in bare for c in pattern)


class Words:
    """Ids of the words met so far, each encoded once; all are forgotten when they have become too many.

    Place 0 is the empty word. If the tokenizer, by its answers to samples, parts a Latin-1 letter or a digit from
    the signs of ``TAIL`` behind it, these are encoded apart; if it lower-cases, plain words are encoded in lower
    case. So ``Word``, ``word,`` and ``word`` are encoded once. If it leaves words of lower-case Latin-1 letters whole,
    also by samples, its model encodes them without the steps before it.
    """

    def __init__(self, tokenizer, end_id: int, most_words: int = WORDS, most_ids: int = 8 * WORDS):
        self.tokenizer, self.end_id, self.most_words, self.most_ids = tokenizer, end_id, most_words, most_ids
        sign = tokenizer.encode(SIGN, add_special_tokens=False).ids
        self.sign = sign[0] if len(sign) == 1 else None
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        parted = tokenizer.pre_tokenizer is not None and all(
            len(tokenizer.pre_tokenizer.pre_tokenize_str(x + sign * 2)) == 2 for x in BEFORE for sign in TAIL)
        self.tail = TAIL if parted and not any(set(t) & set(TAIL) for t in added) else ""
        upper = "".join(sorted(c for c in BEFORE if c.lower() != c))
        self.lowers = (tokenizer.normalizer is not None and not any(t.isalnum() for t in added) and
                       tokenizer.normalizer.normalize_str(upper) == upper.lower())
        self.model = None if any(t.isalpha() for t in added) else self._model()
        self.last = self._last_ids() if self.model else None
        self.forget()

    def _model(self):
        """The tokenizer without normalizer, words parted at spaces only.

        None if one of its patterns names letters or counts, or if a sample comes out otherwise.
        """
        from tokenizers import Tokenizer, pre_tokenizers

        steps = [x.__getstate__().decode() for x in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer) if x]
        if any(map(names_letters, steps)):
            return None
        letters = sorted(c for c in BEFORE if c.isalpha() and c.lower() == c)
        cut, given = [pre_tokenizers.WhitespaceSplit()], self.tokenizer.pre_tokenizer
        if given is not None and given.pre_tokenize_str(letters[-1])[0][0] != letters[-1]:
            cut.append(pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False))
        model = Tokenizer(self.tokenizer.model)
        model.pre_tokenizer = pre_tokenizers.Sequence(cut)
        samples = [SIGN, "".join(letters), *(a + a + b + b for a in letters for b in letters)]
        same = self._encoded(samples), self._encoded(samples, model)
        return model if all(map(np.array_equal, *same)) else None

    def _last_ids(self):
        """For each id if it stands at the end of a word, where the model marks these; else None."""
        mark = getattr(self.model.model, "end_of_word_suffix", None)
        if not mark:
            return None
        vocabulary = self.model.get_vocab(with_added_tokens=False)
        last = np.zeros(max(vocabulary.values()) + 1, bool)
        last[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        return last

    def forget(self) -> None:
        self.place: dict[str, int] = {"": 0}
        self.ids, self.begin = np.zeros(0, "<u4"), np.zeros(2, np.int64)

    def _encoded(self, texts: list[str], tokenizer=None) -> list[np.ndarray]:
        found = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _in_lines(self, words: list[str], tokenizer=None, last=None, width: int = 256, at_once: int = 5_000):
        """Ids of words that go many in one text, and the number of ids of each word.

        Words end at ids of ``last``; without it ``SIGN`` stands behind each. A text has one end for each word; if it
        comes out otherwise, because a word makes such an id itself, its words go one by one.
        """
        between, close = (" ", "") if last is not None else (f" {SIGN} ", f" {SIGN}")
        for i in range(0, len(words), at_once):
            some = words[i:i + at_once]
            lines = [some[j:j + width] for j in range(0, len(some), width)]
            for line, ids in zip(lines, self._encoded([between.join(x) + close for x in lines], tokenizer)):
                ends = np.flatnonzero(last[ids] if last is not None else ids == self.sign)
                if len(ends) != len(line) or ends[-1] != len(ids) - 1:
                    yield from self._one_by_one(line)
                elif last is not None:
                    yield ids, np.diff(ends, prepend=-1)
                else:
                    yield np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def _one_by_one(self, words: list[str], at_once: int = 5_000):
        for i in range(0, len(words), at_once):
            found = self._encoded(words[i:i + at_once])
            yield np.concatenate(found), np.array([len(f) for f in found], np.int64)

    def _parts(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """What of each word is encoded, and the signs behind it that are encoded apart."""
        cores, tails = words, pa.array(np.full(len(words), "", object), pa.string())
        if self.tail:
            cores = pc.utf8_rtrim(words, characters=self.tail)
            ended = pc.less(pc.binary_length(cores), pc.binary_length(words))
            some, whole = cores.filter(ended), words.filter(ended)
            some = pc.if_else(pc.match_substring_regex(some, f"[{LETTERS}0-9]$"), some, whole)
            behind = [w[len(c):] for c, w in zip(as_list(some), as_list(whole))]
            cores = pc.replace_with_mask(cores, ended, some)
            tails = pc.replace_with_mask(tails, ended, pa.array(behind, pa.string()))
        if self.lowers:
            low = pc.utf8_lower(cores)
            cased = pc.not_equal(low, cores)
            some = cores.filter(cased)
            plain = pc.match_substring_regex(some, f"^(?:[{LETTERS}]+|[A-Za-z0-9]+)$")
            cores = pc.replace_with_mask(cores, cased, pc.if_else(plain, low.filter(cased), some))
        return cores, tails

    def _add(self, words, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.place.update(zip(words, range(len(self.begin) - 1, len(self.begin) - 1 + len(words))))
        self.ids = np.concatenate([self.ids, ids]).astype("<u4", copy=False)
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        lettered = pc.match_substring_regex(pa.array(words, pa.string()), WHOLE)
        signed = pc.match_substring(pa.array(words, pa.string()), SIGN)
        kind = np.where(lettered, 0, np.where(signed, 2, 1)) if self.model else np.where(signed, 2, 1)
        kind = kind.tolist() if self.sign is not None else [2] * len(words)
        bare, rest, single = ([w for w, k in zip(words, kind) if k == n] for n in range(3))
        found = [*self._in_lines(bare, self.model, self.last), *self._in_lines(rest), *self._one_by_one(single)]
        self._add(bare + rest + single, np.concatenate([ids for ids, _ in found]), np.concatenate([n for _, n in found]))

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some distinct words, one behind the other, and where each begins."""
        if len(self.place) > self.most_words or len(self.ids) > self.most_ids:
            self.forget()
        places = []
        for part in self._parts(words):
            coded = part.dictionary_encode()
            some = as_list(coded.dictionary)
            self._learn([w for w in some if w not in self.place])
            at = np.fromiter(map(self.place.__getitem__, some), np.int64, len(some))
            places.append(at[coded.indices.to_numpy(zero_copy_only=False)])
        ids, begin = at_places(self.ids, self.begin, np.stack(places, axis=1).ravel())
        return ids, begin[::2]


def as_list(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


def at_places(ids: np.ndarray, begin: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words at some places, one word behind the other, and where each begins."""
    first = begin[places]
    sizes = begin[places + 1] - first
    starts = np.concatenate([[0], np.cumsum(sizes)])
    spots = np.repeat(first - starts[:-1], sizes)
    spots += np.arange(starts[-1])
    return ids[spots], starts


def token_ids(known: Words, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each closed by the end id, and the offsets of the texts.

    The tokenizer drops white space and joins nothing across it, so each distinct word is encoded once and
    its ids are put wherever it stands.
    """
    lists = pc.ascii_split_whitespace(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
    coded = lists.flatten().dictionary_encode()
    ids, begin = known.encoded(coded.dictionary)
    at = lists.offsets.to_numpy().astype(np.int64) + np.arange(len(texts) + 1)
    ends = np.zeros(at[-1], bool)
    ends[at[1:] - 1] = True
    place = np.full(at[-1], len(begin) - 1, np.int64)  # behind all words, the end id
    place[~ends] = coded.indices.to_numpy(zero_copy_only=False)
    ids, starts = at_places(np.append(ids, np.uint32(known.end_id)), np.append(begin, begin[-1] + 1), place)
    return ids, starts[at]


def known_words(path: str, end_id: int) -> Words:
    """The tokenizer of a file and the words it has met, kept by a Python worker from task to task.

    A tokenizer loaded for each task leaves the worker's memory in pieces, and it grows with the number of tasks.
    Functions travel by value, so a global of this module would last for one task; a module of its own stays.
    Above ``KEPT_WORDS`` words a task starts without them.
    """
    from tokenizers import Tokenizer

    name = "tessera_worker_state"
    kept = vars(sys.modules.setdefault(name, types.ModuleType(name)))
    if (path, end_id) != kept.get("file"):
        kept.update(file=(path, end_id), words=Words(Tokenizer.from_file(path), end_id))
    if len(kept["words"].place) > KEPT_WORDS:
        kept["words"].forget()
    return kept["words"]


def _tokenised(path: str, window: int, chunk: int, end_id: int):
    """Batch function: token count of each document, checksums of its full windows, and of what is left.

    The remainder keeps the checksum of the whole and of each ``chunk`` ids of it, from which the checksum of
    any part that starts and ends at a chunk can be put together later.
    """
    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known = known_words(path, end_id)
        for batch in batches:
            for a, b in ranges(batch.column(1), PIECE_BYTES):
                texts = batch.column(1).slice(a, b - a)
                ids, at = token_ids(known, texts)
                raw, step = memoryview(ids.tobytes()), 4 * chunk
                full, rest, parts = [], [], []
                for s, e in zip(at.tolist(), at[1:].tolist()):
                    cut = s + (e - s) // window * window
                    full.append([zlib.crc32(raw[4 * i:4 * (i + window)]) for i in range(s, cut, window)])
                    left = raw[4 * cut:4 * e]
                    rest.append(zlib.crc32(left))
                    parts.append([zlib.crc32(left[i:i + step]) for i in range(0, len(left), step)])
                some = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(at)), pa.array(full, some),
                     pa.array(rest, pa.int64()), pa.array(parts, some)],
                    ["doc_id", "tokens", "full", "rest", "parts"])

    return run


def combinations(lengths: np.ndarray, window: int, anchors: int = 48) -> list[tuple[int, ...]]:
    """Sets of two or three lengths that fill the window exactly; one of three is among the common ones."""
    have = np.zeros(window + 1, bool)
    have[np.flatnonzero(lengths)] = True
    out = {(a, window - a) for a in range(1, window // 2 + 1) if have[a] and have[window - a]}
    for c in np.argsort(-lengths, kind="stable")[:anchors].tolist():
        if have[c]:
            left = window - c
            out |= {tuple(sorted((a, left - a, c))) for a in range(1, left // 2 + 1) if have[a] and have[left - a]}
    return sorted(out)


def repeats(lengths: np.ndarray, sets: list[tuple[int, ...]], rounds: int = 300) -> np.ndarray:
    """How often each set is used: non-negative least squares against the histogram, rounded down to what is there.

    Multiplicative steps keep the solution non-negative and lower the squared error in each round.
    """
    if not sets:
        return np.zeros(0, np.int64)
    member = np.array([x for s in sets for x in s])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    goal = np.bincount(owner, lengths[member].astype(float), len(sets))
    x = np.full(len(sets), max(1.0, lengths.sum() / (3 * len(sets))))
    for _ in range(rounds):
        made = np.bincount(member, x[owner], len(lengths))
        x *= goal / np.maximum(np.bincount(owner, made[member], len(sets)), 1e-12)
    left, used = lengths.astype(np.int64).copy(), np.zeros(len(sets), np.int64)
    for grow in (np.floor(x + 0.5).astype(np.int64), np.full(len(sets), 1 << 62)):  # then whatever still fits
        for i in np.argsort(-x, kind="stable").tolist():
            need = np.array(sorted(set(sets[i])))
            each = np.array([sets[i].count(n) for n in need])
            n = min(int(grow[i]), int((left[need] // each).min()))
            if n > 0:
                left[need] -= n * each
                used[i] += n
    return used


def slots(lengths: np.ndarray, window: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Rows ``(length, from, to, each, sequence, offset)`` and the number of sequences they fill.

    Documents of a length, in their order, from rank ``from`` to ``to`` (excluded), go ``each`` to a
    sequence, the first to ``sequence`` at ``offset`` and so on.
    """
    sets = combinations(lengths, window)
    used = repeats(lengths, sets)
    taken, rows, first = np.zeros(window + 1, np.int64), [], 0
    for s, n in zip(sets, used.tolist()):
        if n:
            offset = 0
            for length in sorted(set(s)):
                each = s.count(length)
                rows.append((length, int(taken[length]), int(taken[length] + n * each), each, first, offset))
                taken[length] += n * each
                offset += each * length
            first += n
    return rows, first


def _shift_tables(count: int) -> np.ndarray:
    """Four tables that move a CRC-32 past ``count`` zero bytes, one for each byte of it."""
    base = zlib.crc32(bytes(count))
    one = [zlib.crc32((1 << bit).to_bytes(4, "little") + bytes(count - 4)) ^ base for bit in range(32)] \
        if count >= 4 else None
    if one is None:
        raise ValueError("at least 4 bytes")
    tables = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for value in range(256):
            for bit in range(8):
                if value >> bit & 1:
                    tables[byte, value] ^= one[8 * byte + bit]
    return tables


def join_crc(parts: list[int], sizes: list[int]) -> int:
    """CRC-32 of byte strings put together, from the CRC-32 and length of each."""
    total = parts[0] if parts else 0
    for crc, size in zip(parts[1:], sizes[1:]):
        if size not in _TABLES:
            _TABLES[size] = _shift_tables(size).tolist()
        t = _TABLES[size]
        total = crc ^ t[0][total & 255] ^ t[1][total >> 8 & 255] ^ t[2][total >> 16 & 255] ^ t[3][total >> 24]
    return total


_TABLES: dict[int, list] = {}


def _greedy(window: int, chunk: int, names: list[str]):
    """Batch function: walk the residual documents of each shard and fill one sequence after the other."""
    def run(batches):
        shard, number, filled = None, 0, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    shard, number, filled = row["shard"], 0, 0
                done, rest = 0, row["length"]
                while rest:
                    room = window - filled
                    size = rest if rest <= room else room // chunk * chunk
                    if size:
                        parts = row["parts"][done // chunk:-(-(done + size) // chunk)]
                        sizes = [4 * min(chunk, size - i) for i in range(0, size, chunk)]
                        crc = row["rest"] if size == row["length"] else join_crc(parts, sizes)
                        out.append((row["row"], done, size, crc, shard, number, filled))
                        done, rest, filled = done + size, rest - size, filled + size
                    if rest or filled == window:
                        number, filled = number + 1, 0
            kinds = [pa.int64()] * 7
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names)

    return run


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
         end_id: int = 1, chunk: int = CHUNK, shard_rows: int = SHARD_ROWS, residual_rows: int = RESIDUAL_ROWS
         ) -> DataFrame:
    """Pieces of tokenised documents in sequences of at most ``window`` ids.

    Output, a row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and
    ``row``, the number of the document. ``tokenizer`` is the path of a tokenizer file whose pre-tokens do not
    cross white space; each document is closed by ``end_id``.

    Full windows of a document are sequences of their own. What is left of it has a length below the window.
    Combinations of two or three lengths that fill the window exactly are enumerated, their repeat counts
    solved by non-negative least squares against the histogram of lengths (``window`` numbers at the driver),
    rounded, and documents are dealt to them by their rank within a length. Residual documents are packed
    greedily, cut at a multiple of ``chunk`` ids when a sequence is full; only these sequences need padding.
    Ranks and sequence numbers are prefix sums over shards of bounded size, so no length is hot.

    Null texts count as empty and hold ``end_id`` alone, as do texts of white space; repeated rows are
    documents of their own; an empty table gives an empty table; other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    read = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(
        _tokenised(tokenizer, window, chunk, end_id),
        f"doc_id {kind}, tokens long, full array<long>, rest long, parts array<long>")
    read = cut_lineage(read.withColumn("row", F.monotonically_increasing_id()))
    left = (F.col("tokens") % window).cast("int")
    narrow = read.select("row", left.alias("length"), F.size("full").alias("n_full"))
    shards = max(1, -(-read.count() // shard_rows))
    narrow = narrow.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    groups = narrow.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n"))
    lengths = np.zeros(window + 1, np.int64)
    for length, n in groups.groupBy("length").agg(F.sum("n")).collect():
        lengths[length] = n
    lengths[0] = 0
    rows, filled = slots(lengths, window)
    plan = spark.createDataFrame(rows, "length int, low long, high long, each int, seq long, off int")

    upto = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = cut_lineage(groups.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).drop("n"))
    in_shard = Window.partitionBy("length", "shard").orderBy("row")
    ranked = (narrow.withColumn("own", F.row_number().over(in_shard) - 1).join(before, ["length", "shard"])
              .select("row", "length", "shard", (F.col("own") + F.col("before")).alias("rank")))
    dealt = cut_lineage(ranked.filter("length > 0").join(
        F.broadcast(plan.withColumnRenamed("length", "l")),  # at most a few rows for each enumerated set
        (F.col("length") == F.col("l")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")), "left"))
    step = F.col("rank") - F.col("low")
    placed = dealt.filter("seq IS NOT NULL").select(
        "row", (F.col("seq") + F.floor(step / F.col("each"))).alias("sequence_id"),
        (F.col("off") + F.pmod(step, F.col("each").cast("bigint")) * F.col("length")).cast("bigint").alias("offset"))

    residual = dealt.filter("seq IS NULL").select("row", "length")
    cells = max(1, -(-residual.count() // residual_rows))
    names = ["row", "start", "length", "ids_crc32", "shard", "number", "offset"]
    residual = residual.join(read.select("row", "rest", "parts"), "row").select(
        "row", "length", "rest", "parts", F.pmod(F.xxhash64("row"), F.lit(cells)).cast("int").alias("shard"))
    greedy = cut_lineage(residual.repartition("shard").sortWithinPartitions("shard", F.desc("length"), "row").mapInArrow(
        _greedy(window, chunk, names), ", ".join(f"{n} long" for n in names)))
    over = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ends = greedy.groupBy("shard").agg((F.max("number") + 1).alias("n")).select(
        F.col("shard").alias("s"), (F.coalesce(F.sum("n").over(over), F.lit(0)) + filled).alias("first"))
    more = (greedy.join(F.broadcast(ends), F.col("shard") == F.col("s"))
            .select("row", "start", "length", "ids_crc32", (F.col("first") + F.col("number")).alias("sequence_id"),
                    "offset"))
    used = filled + (greedy.groupBy("shard").agg((F.max("number") + 1).alias("n")).agg(F.sum("n")).head()[0] or 0)

    fulls = narrow.filter("n_full > 0")
    per = fulls.groupBy("shard").agg(F.sum("n_full").alias("n"))
    starts = per.select(F.col("shard").alias("s"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("first"))
    inner = Window.partitionBy("shard").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    numbered = (fulls.withColumn("own", F.coalesce(F.sum("n_full").over(inner), F.lit(0)))
                .join(F.broadcast(starts), F.col("shard") == F.col("s"))
                .select("row", (F.col("own") + F.col("first") + used).alias("base")))

    body = read.select("row", "doc_id", "tokens", "rest", "full")
    tail = F.when(F.col("sequence_id").isNotNull(), F.array(F.struct(
        (F.col("tokens") - F.col("tokens") % window).alias("start"), (F.col("tokens") % window).alias("length"),
        F.col("rest").alias("ids_crc32"), "sequence_id", "offset"))).otherwise(F.array())
    whole = F.transform(F.col("full"), lambda c, i: F.struct(
        (i.cast("bigint") * window).alias("start"), F.lit(window).cast("bigint").alias("length"), c.alias("ids_crc32"),
        (F.col("base") + i).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")))
    natural = (body.join(numbered, "row", "left").join(placed, "row", "left")
               .select("row", "doc_id", F.col("tokens").alias("doc_tokens"), F.explode(F.concat(whole, tail)).alias("p"))
               .select("row", "doc_id", "doc_tokens", "p.*"))
    shift = F.col("tokens") - F.col("tokens") % window
    cut = more.join(read.select("row", "doc_id", "tokens"), "row").select(
        "row", "doc_id", F.col("tokens").alias("doc_tokens"), (F.col("start") + shift).alias("start"), "length",
        "ids_crc32", "sequence_id", "offset")
    return natural.unionByName(cut)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2,048 ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, default_tokenizer()).select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                  "sequence_id", "offset")
