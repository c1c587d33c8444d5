"""Partitioned tables that only grow.

Each job writes folders of its own inside each year. What a job writes counts once the ledger
holds a closing row for it, so readers never see half of a job, and a job that is tried again
after a failure writes other folders: nothing is deleted to make room.
"""

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType


@dataclass(frozen=True)
class Batch:
    """What one phase of one attempt of a run writes. The three are folders, and columns, of their
    own: no run's name can be taken for a part of another's."""

    run: str
    attempt: int
    phase: str

    def at(self, phase: str) -> "Batch":
        return replace(self, phase=phase)


BATCH_KEY = ("run", "attempt", "phase")
_BATCH_TYPES = {"run": StringType(), "attempt": IntegerType(), "phase": StringType()}


def batch_folders(batch: str | Batch) -> dict[str, str | int]:
    """Partition columns of a batch: its three parts, or for a landing its name alone."""
    return {"batch": batch} if isinstance(batch, str) else {c: getattr(batch, c) for c in BATCH_KEY}


def append_batch(df: DataFrame, path: str, batch: str | Batch, by_year: bool = True) -> None:
    """Add rows as ``batch``; the same batch written before is replaced, year by year."""
    folders = batch_folders(batch)
    (
        df.withColumns({name: F.lit(value) for name, value in folders.items()})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*(["year"] if by_year else []), *folders)
        .parquet(path)
    )


def drop_batch(spark: SparkSession, path: str, batch: str | Batch) -> None:
    """Remove exactly this batch's folders, with or without a year."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    place = "/".join(f"{name}={value}" for name, value in batch_folders(batch).items())
    for pattern in (f"year=*/{place}", place):
        for found in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, pattern)) or ():
            files.delete(found.getPath(), True)


def with_batch(schema: StructType) -> StructType:
    out = StructType([*schema.fields])
    for name, kind in _BATCH_TYPES.items():
        out = out.add(name, kind)
    return out


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    years: Iterable[int] | None = None,
    batches: DataFrame | None = None,
) -> DataFrame:
    """All rows, or those of some years and of some ``batches(run, attempt, phase)``; an empty frame when
    nothing was written yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(with_batch(schema)).parquet(path)
    if years is not None:
        df = df.where(F.col("year").isin(*years))
    if batches is not None:
        df = df.join(batches, list(BATCH_KEY), "left_semi")
    return df.select(*schema.fieldNames())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does the folder exist, on whatever file system the path names?"""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
