"""A corpus from documents: quality, near copies, repeated passages, source weights, packing."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.jaccard import near_duplicates
from tessera.llm.mixing import mix_sources
from tessera.llm.packing import default_tokenizer, pack
from tessera.llm.quality import score_quality
from tessera.llm.suffix_dedup import remove_repeats
from tessera.llm.tables import broadcast_if_small
from tessera.session import BATCH_LIMIT, bound_batches, cut_lineage, remove, scratch_mark, scratch_path, scratch_since

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The classifier's pass mark; a document below it goes.
CUT = 0.3
#: Bytes of a string that counts as a repeated passage: a run of 50 words has 200 bytes even if they are short.
PASSAGE = 200


_left: list[str] = []


def staged(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that begins by deleting the tables the stage before it left in the shared folder.

    A stage's result reads such tables until it is stored; it must be stored before the next stage is called,
    as :func:`run` does. Batches of rows for Python are bounded in the session from the first stage on, as the
    executors keep their memory from stage to stage.
    """

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        while _left:
            remove(spark, _left.pop())
        before = scratch_mark()
        result = stage(spark, docs, sf_dir)
        _left.extend(scratch_since(before))
        return result

    return run_stage


@staged
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not reject.

    Null and empty texts are scored like others; repeated rows and null ids are rows of their own; no documents
    give none.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_quality(docs, labels, carry=COLUMNS, cut=CUT)
    return scored.filter("predicted = 1").select("row.*")


def keyed(docs: DataFrame) -> DataFrame:
    """The documents, each row with a ``key`` of its own, whatever rows share its id or repeat it.

    Keys are in order of id (nulls last), content, and place of the row in its file, so only rows equal in all
    columns are told apart by their place in the input. Documents that are not read from files are stored first.
    """
    spark = docs.sparkSession
    place = ["_metadata.file_path", "_metadata.row_index"]
    try:
        docs.select(*place)
    except AnalysisException:
        path = scratch_path(spark, "documents")
        docs.select(*COLUMNS).write.parquet(path)
        docs = spark.read.schema(docs.select(*COLUMNS).schema).parquet(path)
    return docs.select(*COLUMNS, F.struct(
        F.col("doc_id").isNull().alias("absent"), F.col("doc_id").alias("id"), F.xxhash64(*COLUMNS).alias("content"),
        F.xxhash64(place[0]).alias("file"), F.col(place[1]).alias("row")).alias("key"))


def same_row(rows: DataFrame) -> Column:
    """Equality of a keyed row with the columns ``file, row`` of a table of decisions."""
    return (F.col("key.file") == F.col("file")) & (F.col("key.row") == F.col("row"))


@staged
def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the row of the least key, of each group of near copies; repeated rows are copies.

    Null texts and texts without words are no copies; no documents give none.
    """
    rows = keyed(docs)
    classes = near_duplicates(rows, "key")
    leads = (F.col("doc_id.file") == F.col("class_id.file")) & (F.col("doc_id.row") == F.col("class_id.row"))
    others = cut_lineage(classes.filter(~leads).select("doc_id.file", "doc_id.row"))
    return rows.join(broadcast_if_small(others, 16), same_row(rows), "left_anti").select(*COLUMNS)


@staged
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated strings of ``PASSAGE`` bytes; a document left without text goes.

    A character that is cut in two goes with the cut part. Null texts stay null; no documents give none. A bucket
    holds up to 20,000 strings, some 8 MB at this length, before its windows are dealt to several.
    """
    cut = remove_repeats(docs, carry=COLUMNS, as_text=True, length=PASSAGE, hot_strings=20_000).filter("n_removed = 0 OR kept <> ''")
    changed = F.col("n_removed") > 0
    return cut.select("doc_id", F.when(changed, F.col("kept")).otherwise(F.col("text")).alias("text"), "lang", "source",
                      F.when(changed, F.char_length("kept").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars"))


@staged
def mix_by_weight(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, whatever rows share its id or repeat it.

    Texts without words, null ones too, are not taken; no documents give none.
    """
    rows = keyed(docs)
    copies = cut_lineage(mix_sources(rows, "key").filter("copies > 0").select("doc_id.file", "doc_id.row", "copies"))
    taken = rows.join(broadcast_if_small(copies, 24), same_row(rows))
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select(*COLUMNS)


@staged
def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 ids; null and empty texts are an end id, no documents give none."""
    return pack(docs, default_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_group),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix_by_weight),
    ("packing", pack_windows),
]

#: Boosted trees, MinHash and tokenizers have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is stored as Parquet and read again, then the one before goes."""
    docs, before, bounded = spark.read.parquet(f"{sf_dir}/documents.parquet"), None, bound_batches(spark)
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    while _left:
        remove(spark, _left.pop())
    if bounded:
        spark.conf.unset(BATCH_LIMIT)
    return docs
