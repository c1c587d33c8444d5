"""Session helpers: the shared working folder and size-checked broadcasts."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Where it is unset and the master is local, as in tests, one temporary folder per
    application is made and set as the checkpoint folder too. On a cluster executors could
    not see such a folder, so there an unset one is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="dayledger-")
        spark.sparkContext.setCheckpointDir(_own_folders[app])
    return _own_folders[app]


#: Codec of Parquet files that hold page text.
PAGE_CODEC = "zstd"


def bound_splits(spark: SparkSession) -> None:
    """Files are read 16 MB to a task unless the session sets its own size; Spark's default is 128 MB. Page text is many
    times as long as its file, and what is done with it takes longer than reading: few large tasks leave cores idle."""
    key = "spark.sql.files.maxPartitionBytes"
    default = str(128 << 20)
    if spark.conf.get(key, default) in (default, default + "b"):
        spark.conf.set(key, "16m")


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of 4 MB go to Python unless the session sets its own size; Spark's default is 64 MB. A worker
    and its JVM hold a batch several times, and a batch of texts may well be that large."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, "4m")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_and_reread(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a written table, columnar so later readers can prune."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_and_reread_dealt(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """The same, dealt into buckets by ``key`` and with each row's place (``_file``, ``_row``). Rows that come from
    a table dealt out alike are written where they are; others give a file for each task and bucket."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    known_as = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(known_as)
    place = (F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    written = spark.table(known_as).select("*", *place)
    spark.sql(f"DROP TABLE {known_as}")  # the name only: the files and how they are dealt are in the frame
    return written


def is_small(df: DataFrame, max_rows: int = 100_000) -> bool:
    """Few enough narrow rows to broadcast? Stops counting past the limit."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast hint when the rows are few; else leave the join to the optimizer."""
    return F.broadcast(df) if is_small(df, max_rows) else df
