"""Language identification by a string kernel.

The kernel of two texts counts the different character n-grams (one to three
characters, a blended spectrum, presence only) that both have, over the root of the
product of how many each has. A Nyström map through landmark texts and one-versus-rest
kernel ridge regression on it give a linear rule on the landmarks' n-grams, so a
batch of documents is scored by one product of its presence matrix with a matrix
of one column per language.

Characters are lower-cased; runs of anything but letters count as one space. N-grams
are hashed into ``SLOTS`` places.

Learning reads a bounded sample: of the rows offered, the ``max_training`` first by a
hash of the id; ``landmarks`` of them are the landmarks. What the driver gets of a landmark
is its slots, at most ``SLOTS``, of another row its kernel values, one short vector. Texts
are read whole and stay in the tasks.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as are
all rows if nothing can be learnt from; rows with a null or empty language are not
learnt from; ties go to the first language by name; repeated rows are predicted each;
an empty table gives no rows; further columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.llm import tables

UNDETERMINED = "und"
MAX_TRAINING = 4_000
LANDMARKS = 256
RIDGE = 1e-4
BATCH = 32  # texts scored by one product; a row has a number for each n-gram known
SLOTS = 1 << 18
_SHIFT = np.uint64(64 - 18)
_SPACE = 32
# odd multipliers, one per n-gram length, so that lengths hash apart
_MULTIPLIERS = [
    np.uint64(number)
    for number in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or a space."""
    table = np.full(0x110000, _SPACE, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0])
    return table


def ngram_slots(text: str) -> np.ndarray:
    """Places of a text's n-grams, repeats included; empty if it has no letter."""
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    if not len(codes):
        return np.empty(0, dtype=np.int64)
    spaces = codes == _SPACE
    if spaces.all():
        return np.empty(0, dtype=np.int64)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = ~(spaces[1:] & spaces[:-1])
    letters = codes[keep].astype(np.uint64)
    grams = letters
    found = []
    for n, multiplier in enumerate(_MULTIPLIERS, 1):
        if n > 1:
            grams = (grams[:-1] << np.uint64(21)) | letters[n - 1 :]
        with np.errstate(over="ignore"):
            found.append((grams * multiplier) >> _SHIFT)
    return np.concatenate(found).astype(np.int64)


def presence(texts: list[str | None], vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of the vocabulary each text has, how many different n-grams it has)."""
    rows = np.zeros((len(texts), len(vocabulary)), dtype=np.float32)
    sizes = np.zeros(len(texts), dtype=np.float32)
    flags = np.zeros(SLOTS, dtype=bool)
    for i, text in enumerate(texts):
        slots = ngram_slots(text) if text else ()
        if len(slots):
            flags[slots] = True
            sizes[i] = np.count_nonzero(flags)
            rows[i] = flags[vocabulary]
            flags[slots] = False
    return rows, sizes


@dataclass
class LanguageModel:
    languages: list[str]
    vocabulary: np.ndarray
    weights: np.ndarray  # one column per language

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        rows, sizes = presence(texts, self.vocabulary)
        known = sizes > 0
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        values = rows @ self.weights / np.sqrt(np.maximum(sizes, 1))[:, None]
        best = values.argmax(axis=1)
        score = np.clip(values.max(axis=1).astype(float), 0, 1)  # targets are 0 and 1
        names = [
            self.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)
        ]
        return names, np.where(known, score, 0.0)


def fit(
    docs: DataFrame,
    learnable: Column,
    max_training: int = MAX_TRAINING,
    landmarks: int = LANDMARKS,
    ridge: float = RIDGE,
) -> LanguageModel:
    """Learn from the rows for which ``learnable`` holds and text and lang are known."""
    order = F.xxhash64("doc_id", F.lit(10))
    usable = tables.in_small_batches(docs).filter(
        learnable & F.col("text").rlike(r"\p{L}") & (F.col("lang") != "")
    ).select("text", "lang", order.alias("place"))
    chosen = usable.select("place").orderBy("place").limit(max_training)
    bounds = chosen.agg(F.max("place")).first()[0]
    if bounds is None:
        return LanguageModel([], np.empty(0, dtype=np.int64), np.empty((0, 0)))
    sample = usable.filter(F.col("place") <= bounds)
    def slots_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            own = [np.unique(ngram_slots(t.as_py())).astype(np.int32) for t in rows.column("text")]
            yield pa.record_batch([pa.array(own, pa.list_(pa.int32()))], ["slots"])

    marks = sample.orderBy("place").limit(landmarks).select("text")
    found = marks.mapInArrow(slots_of, "slots array<int>").collect()
    slots = sorted((np.array(row["slots"], dtype=np.int32) for row in found), key=bytes)
    vocabulary = np.unique(np.concatenate(slots)).astype(np.int64)
    listed = np.concatenate(slots)
    starts = np.cumsum([0, *map(len, slots[:-1])])
    roots = np.sqrt([len(own) for own in slots])

    def kernel(present: np.ndarray) -> np.ndarray:
        """Kernel values of a text, given by a flag for each slot, with every landmark."""
        common = np.add.reduceat(present[listed], starts, dtype=np.int64)
        return common / roots / np.sqrt(max(np.count_nonzero(present), 1))

    def kernels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = np.zeros(SLOTS, dtype=bool)
        for rows in batches:
            values = []
            for text in rows.column("text"):
                own = ngram_slots(text.as_py())
                present[own] = True
                values.append(kernel(present))
                present[own] = False
            yield pa.record_batch(
                [rows.column("lang"), pa.array(values, pa.list_(pa.float64()))], ["lang", "kernel"]
            )

    # equal ids may share the last place; the row bound holds all the same
    rows = (
        sample.limit(max_training)
        .select("text", "lang")
        .mapInArrow(kernels, "lang string, kernel array<double>")
        .collect()
    )
    languages = sorted({row["lang"] for row in rows})
    x = np.array([row["kernel"] for row in rows], dtype=np.float64)
    y = np.array([[float(row["lang"] == name) for name in languages] for row in rows])
    present = np.zeros(SLOTS, dtype=bool)
    among = np.empty((len(slots), len(slots)))
    for i, own in enumerate(slots):
        present[own] = True
        among[i] = kernel(present)
        present[own] = False
    values, vectors = np.linalg.eigh(among)
    keep = values > 1e-6 * values.max()
    to_features = vectors[:, keep] / np.sqrt(values[keep])
    features = x @ to_features
    ridge_rule = np.linalg.solve(
        features.T @ features + ridge * len(rows) * np.eye(features.shape[1]),
        features.T @ y,
    )
    rule = to_features @ ridge_rule
    weights = np.zeros((len(vocabulary), len(languages)))
    for own, root, each in zip(slots, roots, rule, strict=True):
        weights[np.searchsorted(vocabulary, own)] += each / root
    return LanguageModel(languages, vocabulary, weights.astype(np.float32))


def predicted(docs: DataFrame, model: LanguageModel, *carried: str) -> DataFrame:
    """(row, lang_pred, score) of every row; ``row`` is a struct of ``carried`` and the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, BATCH):
                part = rows.slice(at, BATCH)
                names, scores = model.predict(part.column("text").to_pylist())
                columns = [part.column("row"), pa.array(names, pa.string()), pa.array(scores)]
                yield pa.record_batch(columns, ["row", "lang_pred", "score"])

    source = docs.select(F.struct(*carried).alias("row"), "text")
    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {kind}, lang_pred string, score double")


def held_out() -> Column:
    """Every fourth document, by CRC-32 of its id as text, is never learnt from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: whether it was held out, its language and the score."""
    model = fit(docs, F.coalesce(~held_out(), F.lit(True)))
    found = predicted(docs, model, "doc_id").select(F.col("row.doc_id"), "lang_pred", "score")
    return found.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def language_stage(docs: DataFrame, least_score: float = 0.1) -> DataFrame:
    """The documents' own columns; goes what has no language or is near none.

    A text whose n-grams the landmarks do not have scores 0 for every language; a
    short or mixed text of known languages scores some tenths at least. Only the text goes
    to Python, and only the verdict comes back. Null and empty texts go; repeated rows
    are judged each, an empty table gives no rows.
    """
    model = fit(docs, F.coalesce(~held_out(), F.lit(True)))

    @F.arrow_udf("boolean")
    def known(texts: pa.Array) -> pa.Array:
        kept = []
        for at in range(0, len(texts), BATCH):
            names, scores = model.predict(texts.slice(at, BATCH).to_pylist())
            kept += [n != UNDETERMINED and s >= least_score for n, s in zip(names, scores, strict=True)]
        return pa.array(kept, pa.bool_())

    return docs.filter(known("text"))
