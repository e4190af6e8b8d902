"""Tokenisers built from native array functions (no Python workers)."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters kept by each of the three tokenisers.
REVIEW_LETTERS = "a-záéíóúâêôãõç"
KEYWORD_LETTERS = "a-zà-ü"
# White space as the notebook tokeniser understands it (all of Unicode).
WHITE_SPACE = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SHORTEST_WORD = 3

# Words dropped besides MLlib's own Portuguese list.
EXTRA_STOP_WORDS = ["ser", "ter", "havia", "têm"]
DOMAIN_STOP_WORDS = ["produto", "comprei"]


def stop_words(domain: bool = True) -> list[str]:
    """Portuguese stop words; needs an active Spark session."""
    listed = StopWordsRemover.loadDefaultStopWords("portuguese") + EXTRA_STOP_WORDS
    return sorted(set(listed + (DOMAIN_STOP_WORDS if domain else [])))


def _long_enough(words: Column) -> Column:
    return F.filter(words, lambda word: F.length(word) >= SHORTEST_WORD)


def split_words(text: Column, letters: str) -> Column:
    """Lower-cased runs of ``letters``, short ones left out."""
    return _long_enough(F.split(F.lower(text), f"[^{letters}]+"))


def squeezed_words(text: Column) -> Column:
    """Words after *deleting* (not splitting on) everything but letters and spaces."""
    kept = F.regexp_replace(F.lower(text), f"[^{REVIEW_LETTERS}{WHITE_SPACE}]", "")
    return _long_enough(F.split(kept, f"[{WHITE_SPACE}]+"))


def with_bigrams(words: Column) -> Column:
    """The words followed by every pair of neighbours, joined by an underscore."""
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    neighbours = F.zip_with(
        F.slice(words, F.lit(1), pairs),
        F.slice(words, F.lit(2), pairs),
        lambda left, right: F.concat(left, F.lit("_"), right),
    )
    return F.concat(words, neighbours)


def add_keyword_tokens(df: DataFrame, text: str, tokens: str) -> DataFrame:
    """Add the unigram and bigram array used by the keyword statistics.

    The words are a column of their own: the bigram step reads them several
    times, and a text must be split only once.
    """
    return (
        df.withColumn("_words", split_words(F.col(text), KEYWORD_LETTERS))
        .withColumn(tokens, with_bigrams(F.col("_words")))
        .drop("_words")
    )
