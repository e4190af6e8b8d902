"""Opening tables, free column names, and cutting lineage by a written table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.sources import scratch

# A task holds several copies of the batch that goes to Python; Spark's own 64 MB are much
# for whole texts.
BATCH_BYTES = 4 << 20
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` is called so."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def in_small_batches(texts: DataFrame) -> DataFrame:
    """The same rows; the session sends rows to Python in batches of ``BATCH_BYTES``,
    unless it was told another size."""
    conf = texts.sparkSession.conf
    if _BATCHES not in conf.getAll:
        conf.set(_BATCHES, BATCH_BYTES)
    return texts


def stored(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """Write rows to the shared folder and read them back.

    What follows then depends on files, not on executors, and no step before it
    is run twice.
    """
    folder = scratch.new_folder(df.sparkSession, purpose)
    df.write.partitionBy(*partition_by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def tasks(df: DataFrame) -> int:
    """How many parts a shuffle of this session makes."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
