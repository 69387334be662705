"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tessera", master: str | None = "local[*]", **conf) -> SparkSession:
    """Named session, created once and reused afterwards (S-1)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own; on a
    cluster a missing setting is an error, since a machine-local folder would
    be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return jsc.getCheckpointDir().get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    own = tempfile.mkdtemp(prefix="tessera-")
    spark.sparkContext.setCheckpointDir(own)
    return own


_written: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder for a table written by a job."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this process wrote."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables this process wrote; results that read them must be stored first."""
    while _written:
        remove(spark, _written.pop())


def scratch_mark() -> int:
    """Number of tables written so far, for :func:`scratch_since`."""
    return len(_written)


def scratch_since(mark: int) -> list[str]:
    """Paths of the tables written since the mark."""
    return _written[mark:]


#: Spark's limit of the bytes of a batch of rows on its way to a Python worker, and what is set in its place.
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "2m"


def bound_batches(spark: SparkSession) -> bool:
    """Send rows to Python workers in batches of ``BATCH_BYTES``, unless the session has a limit of its own.

    By default a batch ends at 10,000 rows or 64 MB, so a partition of texts goes as one batch, which the
    executor and its worker both hold. Returns whether the limit was set here.
    """
    if BATCH_LIMIT in spark.conf.getAll:
        return False
    spark.conf.set(BATCH_LIMIT, BATCH_BYTES)
    return True


#: Rows of a narrow table that one task writes.
ROWS_A_TASK = 50_000


def cut_lineage(df: DataFrame, most_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Lost executors then cost no replay. A written table is used rather than
    ``checkpoint()``, which carries the constraints of the old plan along:
    in a loop they grow without end, and planning with them.

    A narrow table known to have ``most_rows`` rows at most is written by a
    task for each ``ROWS_A_TASK`` of them, one a core at least, instead of a
    file for each shuffle partition, which takes longer than its rows do.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "lineage")
    if most_rows is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, -(-most_rows // ROWS_A_TASK)))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
