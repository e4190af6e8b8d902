from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartpulse.llm import langid, lines, packing, simhash, similar, tables


def _largest_batch(texts) -> int:
    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            yield pa.record_batch([pa.array([rows.nbytes])], ["n"])

    return texts.mapInArrow(sizes, "n bigint").agg(F.max("n")).first()[0]


@pytest.mark.parametrize(
    "opened",
    [
        lambda docs: langid.language_stage(docs),
        lambda docs: lines.repeated_lines(docs),
        lambda docs: simhash.fingerprints(docs, 3),
        lambda docs: similar.keyed(docs),
        lambda docs: packing.pieces(docs, "word_bpe_49k.json"),
    ],
)
def test_whole_texts_go_to_python_in_small_batches(spark, opened):
    docs = spark.range(3000, numPartitions=1).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.concat("id", F.lit(" ein Satz ")), 300).alias("text"),
        F.lit("de").alias("lang"),
    )
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        opened(docs)
        assert _largest_batch(docs.select("text")) <= tables.BATCH_BYTES + 10_000
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def test_a_size_of_the_session_stays(spark):
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    try:
        tables.in_small_batches(spark.range(1))
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").startswith("1")
        assert _largest_batch(spark.range(3000).select(F.repeat(F.lit("x"), 2000))) < 2 << 20
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
