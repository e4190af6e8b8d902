"""Line dedup: levelled sorted runs of line hashes.

Every batch of documents adds a *run*: one row per line hash with the number of
documents that hold the line and the first of them, hashed into parts and sorted
in each. Runs of one level are merged into one of the next level as soon as
``fanout`` of them exist. A merge sets apart the hashes that have reached
``min_docs``; they are *settled*. A new batch is merge-anti-joined with the
settled runs, so a line that fills a third of the corpus is counted in the first
runs only, and adds what is left as its own run. With ``min_docs=1`` every line
seen before is settled, which is incremental dedup.

A line's key is the line without white space (space, \\t \\n \\v \\f \\r) at both
ends and with A-Z lower-cased; empty keys are never dropped. The hash is the first
half of the key's SHA-256.

Defined cases: a null or empty text is one empty line; every row counts as a
document, so repeated rows count each; a null ``doc_id`` is an id like any other
(first of all when the first holder is asked for); an empty table gives no rows;
further columns are not read by ``repeated_lines`` and kept by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartpulse.llm import tables
from cartpulse.sources import scratch

MIN_DOCS = 10
BATCHES = 4
FANOUT = 2
WHITE = b" \t\n\x0b\x0c\r"
RUN = "key binary, n_docs bigint, first struct<batch:int,doc_id:bigint>"
_ENTRY = "row_key bigint, batch int, doc_id bigint, key binary"


def line_key(line: bytes) -> bytes:
    """Hash of a line's key; nothing for an empty key."""
    key = line.strip(WHITE).lower()
    return hashlib.sha256(key).digest()[:16] if key else b""


class LineRuns:
    """The runs of one corpus in the shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT) -> None:
        self.spark = spark
        self.min_docs = min_docs
        self.fanout = fanout
        self.levels: list[list[str]] = []
        self.settled_runs: list[str] = []
        self._folder = scratch.new_folder(spark, "line-runs")
        self._written = 0

    def _write(self, rows: DataFrame) -> str:
        """Sorted run; settled hashes apart from open ones."""
        self._written += 1
        path = f"{self._folder}/run-{self._written}"
        marked = rows.withColumn("settled", (F.col("n_docs") >= self.min_docs).cast("int"))
        marked.sortWithinPartitions("settled", "key").write.partitionBy("settled").parquet(path)
        return path

    def _read(self, paths: Iterable[str], settled: int) -> DataFrame:
        return _union(
            self.spark,
            [
                self.spark.read.schema(f"{RUN}, settled int")
                .parquet(path)
                .filter(F.col("settled") == settled)
                .drop("settled")
                for path in paths
            ],
        )

    def settled(self) -> DataFrame:
        """Hashes known to be in ``min_docs`` documents, with their first holder."""
        return self._read(self.settled_runs, 1)

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch of (key, batch, doc_id), one row per key and document.

        The rows are counted per key first, so a line of a third of the batch reaches the
        join as one row. Gives the run that was added: the keys not settled before.
        """
        counted = lines.groupBy("key").agg(
            F.count("*").alias("n_docs"), F.min(F.struct("batch", "doc_id")).alias("first")
        )
        if self.settled_runs:
            known = self.settled().select("key").hint("merge")
            counted = counted.join(known, "key", "left_anti")
        path = self._write(counted)
        self._put(0, path)
        return self.spark.read.schema(f"{RUN}, settled int").parquet(path).drop("settled")

    def _put(self, level: int, path: str) -> None:
        self.settled_runs.append(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            merged = self._write(_merged(self._read(self.levels[level], 0)))
            self.levels[level] = []
            self._put(level + 1, merged)

    def frequent(self) -> DataFrame:
        """All keys in at least ``min_docs`` documents, after all batches."""
        rest = _merged(self._read([path for level in self.levels for path in level], 0))
        return self.settled().unionByName(rest.filter(F.col("n_docs") >= self.min_docs))


def _union(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    # no local list: Spark reads these by Python workers of their own, also an empty one
    fields = StructType.fromDDL(RUN).fields
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in fields]
    found = spark.range(1).select(*nulls).limit(0)
    for part in parts:
        found = found.unionByName(part)
    return found


def _merged(runs: DataFrame) -> DataFrame:
    return runs.groupBy("key").agg(
        F.sum("n_docs").alias("n_docs"), F.min("first").alias("first")
    )


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row key, batch, document, key) for every different key of a document."""
    for rows in batches:
        row_keys, numbers, ids, keys = [], [], [], []
        columns = (rows.column(name).to_pylist() for name in ("row_key", "batch", "doc_id", "text"))
        for row_key, number, doc_id, text in zip(*columns, strict=True):
            found = set(map(line_key, (text or "").encode().split(b"\n")))
            found.discard(b"")
            row_keys += [row_key] * len(found)
            numbers += [number] * len(found)
            ids += [doc_id] * len(found)
            keys += found
        yield pa.record_batch(
            [
                pa.array(row_keys, pa.int64()),
                pa.array(numbers, pa.int32()),
                pa.array(ids, pa.int64()),
                pa.array(keys, pa.binary()),
            ],
            ["row_key", "batch", "doc_id", "key"],
        )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without the lines whose hash is listed in ``drop``."""
    for rows in batches:
        total, lost, texts = [], [], []
        for text, drop in zip(
            rows.column("text").to_pylist(), rows.column("drop").to_pylist(), strict=True
        ):
            lines = (text or "").encode().split(b"\n")
            if drop:
                listed = set(drop)
                kept = [line for line in lines if line_key(line) not in listed]
            else:
                kept = lines
            total.append(len(lines))
            lost.append(len(lines) - len(kept))
            texts.append(b"\n".join(kept).decode())
        yield pa.record_batch(
            [
                rows.column("row"),
                pa.array(total, pa.int64()),
                pa.array(lost, pa.int64()),
                pa.array(texts, pa.string()),
            ],
            ["row", "n_lines", "n_dropped", "kept_text"],
        )


def _row_key():
    """Joins a row with what was found in it; rows that share it may share findings,
    since dropping depends on line hashes alone."""
    return F.xxhash64("doc_id", "text")


def repeated_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT
) -> tuple[DataFrame, DataFrame]:
    """(entries, frequent keys) of a corpus with ``doc_id`` and ``text``.

    Documents are dealt into batches by the hash of their row.
    """
    spark = docs.sparkSession
    source = tables.in_small_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    keyed = source.withColumn("row_key", _row_key()).withColumn(
        "batch", F.pmod(F.xxhash64("row_key"), F.lit(batches)).cast("int")
    )
    entries = tables.stored(keyed.mapInArrow(_entries, _ENTRY), "line-hashes", "batch")
    runs = LineRuns(spark, min_docs, fanout)
    for number in range(batches):
        runs.add(entries.filter(F.col("batch") == number))
    return entries, runs.frequent()


def without_repeats(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    keep_first: bool = False,
    row: list[str] | None = None,
) -> DataFrame:
    """Documents with ``n_lines``, ``n_dropped`` and ``kept_text`` in a struct ``row`` beside.

    ``keep_first`` leaves a repeated line in the first document that holds it
    (first batch, smallest ``doc_id``). ``row`` names the columns to carry along.
    """
    entries, frequent = repeated_lines(docs, min_docs, batches)
    known = frequent.select("key", F.col("first").alias("holder")).hint("merge")
    hits = entries.join(known, "key")
    if keep_first:
        hits = hits.filter(~F.struct("batch", "doc_id").eqNullSafe(F.col("holder")))
    drops = hits.groupBy("row_key").agg(F.collect_set("key").alias("drop"))
    carried = F.struct(*(row or ["doc_id"])).alias("row")
    source = docs.select(
        carried, F.col("doc_id").cast("long").alias("doc_id"), "text"
    ).withColumn("row_key", _row_key())
    joined = source.join(drops, "row_key", "left").select("row", "text", "drop")
    kind = docs.select(carried).schema["row"].dataType.simpleString()
    schema = f"row {kind}, n_lines bigint, n_dropped bigint, kept_text string"
    return joined.mapInArrow(_kept, schema)


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document: its lines, how many went, SHA-256 of what stays."""
    return without_repeats(docs, min_docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        "n_dropped",
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def dedup_stage(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents' own columns, repeated lines left in their first holder only.

    All documents stay, also those left without a line.
    """
    others = [name for name in docs.columns if name != "text"]
    found = without_repeats(docs, min_docs, keep_first=True, row=others)
    shown = {
        "text": F.col("kept_text").alias("text"),
        "n_chars": F.length("kept_text").cast("long").alias("n_chars"),
    }
    return found.select(
        *[shown[n] if n in shown else F.col("row").getField(n).alias(n) for n in docs.columns]
    )


LINE_SQL = """
WITH lines AS (
  SELECT doc_id, i, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)),
frequent AS (
  SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), ''))
         AS kept_sha256
FROM lines LEFT JOIN frequent f ON lines.key = f.key GROUP BY doc_id
"""
