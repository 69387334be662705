"""Document fingerprints by I-Match with randomised lexicon subsets."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.arrays import U64, Block, mix, pieces, runs_hash
from tessera.session import cut_lineage, remove, scratch_mark, scratch_since

BUCKET_BYTES = 4 << 20
#: Words that a lexicon holds at most, 8 bytes each; the band's upper edge is set by it.
LEXICON_TERMS = 1 << 20


def document_terms(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, term) pairs of a block, by text; a term is the hash of a word."""
    starts, ends, low, high = block.words()
    terms = runs_hash(block.byte_sums(), starts, ends)
    owner = np.repeat(np.arange(len(low)), high - low)
    order = np.argsort(mix(terms + owner.astype(np.uint64)), kind="stable")
    terms, owner = terms[order], owner[order]
    fresh = np.ones(len(terms), bool)
    fresh[1:] = (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])
    terms, owner = terms[fresh], owner[fresh]
    order = np.argsort(owner, kind="stable")
    return owner[order], terms[order]


def _frequencies(batches):
    """Batch function: in how many of the texts each term occurs."""
    for batch in batches:
        held = [document_terms(Block(texts))[1] for _, _, texts in pieces(batch.column(0))]
        if held:
            terms, counts = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(counts)], ["term", "n"])


class Subsets:
    """Randomised subsets of the lexicon, drawn by hash at several rates, so that short and long texts have some of use."""

    def __init__(self, lexicon: np.ndarray, levels: int = 14, each: int = 24):
        self.lexicon, self.levels, self.each = lexicon, levels, each
        self.seeds = mix(np.arange(each, dtype=np.uint64) + U64(101)) | U64(1)

    def signatures(self, texts: list[bytes]) -> np.ndarray:
        """For each text 16 bits for each subset: of its sorted distinct terms there, 0 for none.

        Subset (level, draw) holds the terms whose hash under the draw has ``level`` leading zero bits.
        The sum of hashes stands for the sorted list, since it is the same for the same set. A text without
        words of the lexicon has the hash of its bytes everywhere, so it is like its equals and no other text.
        """
        out = np.zeros((len(texts), self.levels, self.each), np.uint64)
        block = Block(texts)
        owner, terms = document_terms(block)
        near = np.minimum(np.searchsorted(self.lexicon, terms), max(0, len(self.lexicon) - 1))
        known = self.lexicon[near] == terms if len(self.lexicon) else np.zeros(len(terms), bool)
        owner, terms = owner[known], terms[known]
        bare = np.bincount(owner, minlength=len(texts)) == 0
        if bare.any():
            out[bare] = (runs_hash(block.byte_sums(), block.start, block.end)[bare] | U64(1))[:, None, None]
        for d, seed in enumerate(self.seeds):
            drawn, who = terms * seed, owner
            for level in range(self.levels):
                if level:
                    keep = drawn < U64(1 << (64 - level))
                    drawn, who = drawn[keep], who[keep]
                if not len(drawn):
                    break
                first = np.flatnonzero(np.diff(who, prepend=-1))
                out[who[first], level, d] = np.add.reduceat(drawn | U64(1), first)
        short = np.maximum((mix(out) >> U64(48)).astype(np.uint16), out != 0)
        return short.reshape(len(texts), -1)

    def likeness(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Share of subsets on which two texts agree, at the rates where both hold few terms; 0 to 1.

        Subsets that both texts leave empty say nothing. Levels count by how many subsets speak there.
        """
        a, b = (x.reshape(-1, self.levels, self.each) for x in (a, b))
        speaks = (a != 0) | (b != 0)
        agree = (speaks & (a == b)).sum(2)
        spoken = speaks.sum(2)
        partly = (spoken < self.each) & (spoken > 0)
        partly |= ~partly.any(1, keepdims=True) & (spoken > 0) & (np.arange(self.levels) == self.levels - 1)
        share = (agree * partly).sum(1) / np.maximum((spoken * partly).sum(1), 1)
        same = (a == b).all((1, 2)) & speaks.any((1, 2))
        return np.where(same, 1.0, share)


def lexicon_of(docs: DataFrame, text: str, low: float, high: float | None = None,
               most_terms: int = LEXICON_TERMS) -> np.ndarray:
    """Sorted hashes of the terms in a band of inverse document frequency ``ln(N / df)``.

    Frequencies are exact and over all documents. The band begins at ``low`` and ends at ``high``, or at the first
    frequency from which on the band would hold more than ``most_terms``: frequencies are counted in eighths of a
    power of two, and of the eighth that does not fit whole the terms of least hash fill the rest. So what comes to the
    driver and is broadcast has at most ``most_terms`` terms, but for the chance of the last eighth's hashes.
    """
    count = docs.count()
    within = F.col("n") <= F.lit(count * math.exp(-low))
    if high is not None:
        within &= F.col("n") >= F.lit(count * math.exp(-high))
    counted = (docs.select(F.coalesce(F.col(text), F.lit("")).alias("t")).mapInArrow(_frequencies, "term long, n long")
               .groupBy("term").agg(F.sum("n").alias("n")).filter(within)
               .withColumn("eighth", F.floor(F.log2("n") * 8).cast("int")))
    mark = scratch_mark()
    counted = cut_lineage(counted)
    held, edge, share = 0, 0, 1.0
    for row in sorted(counted.groupBy("eighth").count().collect(), reverse=True):  # some hundred rows at any size
        if held + row["count"] > most_terms:
            edge, share = row.eighth, (most_terms - held) / row["count"]
            break
        held += row["count"]
    last = F.col("eighth") == edge
    if share < 1:
        last &= F.xxhash64("term") / 2.0 ** 64 + 0.5 < share
    terms = counted.filter((F.col("eighth") > edge) | last).select("term").toArrow()["term"].to_numpy()
    for path in scratch_since(mark):
        remove(docs.sparkSession, path)
    return np.sort(terms.view(np.uint64))


def _walk(shared):
    """Batch function over documents in order, bucket by bucket: each text, its edited text and its successor's."""
    from hashlib import sha256

    def finish(rows, subsets):
        texts, after, edited = [r[1] for r in rows], [r[2] for r in rows], []
        for t, n in zip(texts, after):
            half = len(t) // 2
            edited.append(t[:len(t) - half] + n[:half])
        raw = [x.encode() for x in edited]
        number = {t: i for i, t in enumerate(dict.fromkeys(texts + after))}  # most texts are a successor too
        plain, other = subsets.signatures([t.encode() for t in number]), subsets.signatures(raw)
        own, following = plain[[number[t] for t in texts]], plain[[number[n] for n in after]]
        shown = lambda s: [x.tobytes().hex() for x in s.astype(">u2")]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], rows[0][3]), pa.array([len(t) for t in texts], pa.int64()),
             pa.array([sha256(x).hexdigest() for x in raw]), pa.array(shown(own)), pa.array(shown(other)),
             pa.array(subsets.likeness(own, other)), pa.array(subsets.likeness(own, following))],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches):
        own = Subsets(*shared.value)
        held, rows, size = None, [], 0
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for bucket, guest, ident, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if held is not None and held[0] == bucket:
                    rows.append((held[1], held[2], text, kind))
                    size += len(held[2])
                # a guest is the first document of the next bucket and stands last in its own
                held = None if guest else (bucket, ident, text)
                if size > 1 << 19:
                    yield finish(rows, own)
                    rows, size = [], 0
        if rows:
            yield finish(rows, own)

    return run


def fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                idf: tuple[float, float | None] = (0.1, None), levels: int = 14, each: int = 24,
                bucket_bytes: int = BUCKET_BYTES, most_terms: int = LEXICON_TERMS) -> DataFrame:
    """I-Match fingerprints of each text and of its edited text, and their likeness.

    Output: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The
    edited text has its last ``n_chars // 2`` code points replaced by the first as many of the next document
    in order of id (after the last: the first). ``near_edited`` compares the fingerprints of both texts,
    ``near_next`` that of the text with the next document's.

    The lexicon holds the words whose inverse document frequency lies in the band ``idf``; its low edge leaves out
    the words of nearly all documents only, so the words of a large group of copies stay, and its upper edge comes from
    the measured frequencies: the ``most_terms`` most frequent words are in, see :func:`lexicon_of`. A fingerprint is
    the list of hashes (four hexadecimal digits each) of a text's sorted distinct words in ``levels * each`` randomised
    subsets of the lexicon; level ``i`` keeps about one word in ``2^i``. Likeness reads the same hashes.

    Documents are dealt by ranges of id to buckets of about ``bucket_bytes`` of text, rows without an id or of an id
    that fills several buckets by ranges of their texts' hash; the first document of a
    bucket is also sent to the bucket before, so each bucket knows all its successors and the texts are
    shuffled once. Null texts count as empty; texts without words of the lexicon, also empty ones, are like equal texts
    (1) and no others (0). Equal ids follow each other by hash of the text; null ids come first; a single document is
    its own successor; an empty table gives an empty table. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    lexicon = lexicon_of(docs, text, *idf, most_terms)
    octets = F.octet_length("text").cast("bigint")
    size, lost = rows.agg(F.sum(octets), F.sum(F.when(F.col("doc_id").isNull(), octets))).head()
    count = int(min(4096, max(1, -(-(size or 0) // bucket_bytes))))
    cuts = (rows.select(F.percentile_approx("doc_id", [i / count for i in range(1, count)], 20 * count).alias("p"))
            .head()[0] or []) if count > 1 else []
    bounds = sorted(set(cuts))

    def by_hash(parts):
        """The range of hashes a text falls into, of as many equal ones."""
        return F.least(F.floor((F.col("h") / 2.0 ** 64 + 0.5) * parts), parts - 1)

    bucket = F.lit(0).cast("bigint")
    if bounds:
        bucket = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("doc_id"))).cast("bigint") * (1 << 16)
        hot = [F.lit(v) for c in bounds if cuts.count(c) > 1 for v in (c, cuts.count(c))]
        if hot:
            parts = F.element_at(F.create_map(*hot), F.col("doc_id"))
            bucket = F.when(parts.isNull(), bucket).otherwise(bucket + 1 + by_hash(parts))
    absent = by_hash(F.lit(int(min(4096, max(1, -(-(lost or 0) // bucket_bytes))))).cast("bigint")) - (1 << 16)
    placed = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), absent).otherwise(bucket))
    # the first document of each bucket goes to the bucket before it as well, the very first to the last
    order = [F.col("doc_id").isNotNull().alias("o"), "doc_id", "h"]
    firsts = sorted(placed.groupBy("bucket").agg(F.min(F.struct(*order)).alias("f")).collect(), key=lambda r: r.bucket)
    guest_of = [(firsts[i].bucket, firsts[i - 1].bucket, firsts[i].f.doc_id, firsts[i].f.h) for i in range(len(firsts))]
    kind = docs.schema[doc_id].dataType
    here = placed.select("bucket", F.lit(False).alias("guest"), "doc_id", "text", "h")
    if guest_of:
        guests = spark.createDataFrame(guest_of, f"b bigint, into bigint, id {kind.simpleString()}, first bigint")
        same = ((F.col("bucket") == F.col("b")) & (F.col("h") == F.col("first")) & F.col("doc_id").eqNullSafe(F.col("id")))
        sent = (placed.join(F.broadcast(guests), same).groupBy("into").agg(F.min(F.struct(*order, "text")).alias("g"))
                .select(F.col("into").alias("bucket"), F.lit(True).alias("guest"), "g.doc_id", "g.text", "g.h"))
        here = here.unionByName(sent)
    # plain arrays are sent: the workers need not have this package
    shared = spark.sparkContext.broadcast((lexicon, levels, each))
    schema = (f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    return (here.repartition("bucket").sortWithinPartitions("bucket", "guest", F.asc_nulls_first("doc_id"), "h", "text")
            .mapInArrow(_walk(shared), schema))


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and their edited texts."""
    return fingerprint(spark.read.parquet(f"{sf_dir}/documents.parquet"))
