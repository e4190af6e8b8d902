"""Quality rules: plain limits, then boosted trees over document statistics.

The trees learn from labelled documents and score every document by its statistics
alone. More symbols, repeated words or repeated lines never raise a score.

Learning reads a bounded sample, the ``max_labelled`` labelled documents first by a
hash of the id; the driver gets their statistics, a short vector a row. The verdict
keeps a document unless its score is below one half and below what all but
``spared`` of the good documents learnt from have.

Defined cases: words are runs without white space (space, \\t \\n \\v \\f \\r); a null
text has none and fails the base rules; documents without a label are scored like
others; labels without a document, or null, are not learnt from; without labels the
base rules decide; repeated rows are judged each; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm import boosting

MAX_LABELLED = 20_000
SPARED = 0.001
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words
_SYMBOLS = b"#*$%&|<>"
_OTHERS = bytes(set(range(256)) - set(_SYMBOLS))
_UPPER = re.compile(r"[^\W\d_a-zß-öø-ÿ]")
_DIGITS = re.compile(r"\d")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Statistic -> how the score may move with it (0: freely).
SIGNS = {
    "log_words": 0,
    "mean_word": 0,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": 0,
    "digit_share": 0,
    "mark_share": 0,
    "stop_share": 0,
    "distinct_share": 0,
    "words_per_line": 0,
}


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    size = len(numbers)
    # two joins of two numbers each: no product exceeds the square of the word count
    pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1].astype(np.int64) * size + ids[2:]
    _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
    twice = count[which] > 1
    marked = np.zeros(n, dtype=bool)
    for shift in range(3):
        marked[shift : shift + n - 2] |= twice
    return int(marked.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """(the base counts, the features) of a text."""
    text = text or ""
    data = text.encode()
    words = data.split()
    n = len(words)
    lines = [line for line in data.split(b"\n") if not line.isspace() and line]
    dup_lines = len(lines) - len(set(lines))
    symbols = len(data.translate(None, _OTHERS))
    repeats = repeated_words(words)
    chars = len(b"".join(words).decode())
    each, whole = max(n, 1), max(chars, 1)
    features = [
        float(np.log1p(n)),
        chars / each,
        symbols / each,
        dup_lines / max(len(lines), 1),
        repeats / each,
        len(_UPPER.findall(text)) / whole,
        len(_DIGITS.findall(text)) / whole,
        (data.count(b"!") + data.count(b"?")) / each,
        (data.count(b".") + data.count(b",")) / each,
        len(set(words)) / each,
        n / max(len(lines), 1),
    ]
    return [n, chars, symbols, dup_lines, repeats], features


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for at in range(0, rows.num_rows, 1024):
            part = rows.slice(at, 1024)
            found = [statistics(text.as_py()) for text in part.column("text")]
            counts = zip(*(one[0] for one in found), strict=True)
            yield pa.record_batch(
                [
                    *[part.column(name) for name in ("doc_id", "label")],
                    *[pa.array(column, pa.int64()) for column in counts],
                    pa.array([one[1] for one in found], pa.list_(pa.float64())),
                ],
                ["doc_id", "label", *COUNTS, "features"],
            )


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, label, the base counts, features) of rows with ``doc_id``, ``text``, ``label``."""
    counts = ", ".join(f"{name} bigint" for name in COUNTS)
    return docs.select("doc_id", "label", "text").mapInArrow(
        _rows, f"doc_id bigint, label int, {counts}, features array<double>"
    )


def fit(
    docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, spared: float = SPARED
) -> tuple[boosting.Trees, float]:
    """(trees, the score from which a document is kept)."""
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")
    ).filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    chosen = known.orderBy(F.xxhash64("doc_id", F.lit(8)), "label").limit(max_labelled)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # max_labelled rows at most, so the texts stay where they are
    sent = F.broadcast(chosen) if max_labelled <= MAX_LABELLED else chosen
    rows = with_statistics(source.join(sent, "doc_id")).select("label", "features")
    sample = rows.limit(max_labelled).collect()  # repeated ids could double rows
    x = np.array([row["features"] for row in sample]).reshape(-1, len(SIGNS))
    y = np.array([row["label"] for row in sample], dtype=float)
    trees = boosting.fit(x, y, np.array(list(SIGNS.values())))
    good = np.sort(trees.scores(x[y == 1])) if (y == 1).any() else np.array([0.0])
    return trees, float(min(0.5, good[int(spared * len(good))]))


def judged(docs: DataFrame, trees: boosting.Trees, least: float) -> DataFrame:
    """One row per document: counts, base verdict, score, verdict."""

    @F.pandas_udf("double")
    def score(features: pd.Series) -> pd.Series:
        if not len(features):
            return features.astype(float)
        return pd.Series(trees.scores(np.stack(features.to_numpy())))

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("int").alias("label"), "text"
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    scored = with_statistics(source).withColumn("score", score("features"))
    return scored.select(
        "doc_id",
        *COUNTS,
        failed.alias("base_failed"),
        (~failed & (F.col("score") >= least)).alias("kept"),
        "score",
    )


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judged(docs, *fit(docs, labels))
