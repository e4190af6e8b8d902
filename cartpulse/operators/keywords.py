"""Word counts and keyword statistics of review texts.

A corpus row is one text with a weight (``n_items``): a review belongs to an
order and counts once per item of it, so it is tokenised once and weighted,
not tokenised once per item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartpulse.functions import measures as M
from cartpulse.functions import text as T
from cartpulse.functions.labels import MISSING, review_bucket
from cartpulse.operators.fact import TEXT_ID, Inputs

# Fixed values of the keyword statistics.
BUCKETS = ("negative", "neutral", "positive")
MIN_TEXT_LENGTH = 6
MIN_IDF = 2.8
MIN_DOCUMENTS = 10
SMOOTHING = 0.5
KEYWORDS_PER_BUCKET = 30
MIN_CORPUS = 100
RULES_TO_SEND = 100_000

# Complaint words and the cause each one points to.
COMPLAINT_CAUSES = {
    "Refund Issues": ("estorno", "meu_dinheiro", "dinheiro_volta"),
    "Unresponsive CS": ("obtive_resposta", "uma_resposta"),
    "Poor Seller Behavior": ("falta_respeito",),
}


def _most_frequent(words: DataFrame, top: int) -> DataFrame:
    return words.orderBy(F.desc("frequency"), "word").limit(top)


def frequent_words(texts: DataFrame, max_score: int = 2, top: int = 20) -> DataFrame:
    """The most frequent words of low-scored reviews, stop words left out."""
    words = texts.filter(F.col("review_score") <= max_score).select(
        "n_items",
        F.explode(T.split_words(F.col("review_comment_message"), T.REVIEW_LETTERS)).alias("word"),
    )
    counted = (
        words.filter(~F.col("word").isin(T.stop_words()))
        .groupBy("word")
        .agg(F.sum("n_items").alias("frequency"))
    )
    return _most_frequent(M.kept_sums(counted, ["word"]), top)


def squeezed_word_counts(reviews: DataFrame, score: int = 1, top: int = 20) -> DataFrame:
    """Words of all reviews with one score, cleaned by deleting other characters."""
    words = reviews.filter(
        F.col("review_comment_message").isNotNull() & (F.col("review_score") == score)
    ).select(F.explode(T.squeezed_words(F.col("review_comment_message"))).alias("word"))
    counted = (
        words.filter(~F.col("word").isin(T.stop_words(domain=False)))
        .groupBy("word")
        .agg(F.count("*").alias("frequency"))
    )
    return _most_frequent(counted, top)


def cleaned_texts(reviews: DataFrame) -> DataFrame:
    """Review texts reduced to their counted words, in order."""
    stop = T.stop_words(domain=False)
    words = T.squeezed_words(F.col("review_comment_message"))
    return reviews.filter(F.col("review_comment_message").isNotNull()).withColumn(
        "cleaned_text",
        F.array_join(F.filter(words, lambda word: ~word.isin(stop)), " "),
    )


def cleaned_reviews(inputs: Inputs) -> DataFrame:
    """``cleaned_texts`` of the inputs' reviews; a text that comes apart is cleaned once."""
    if not inputs.texts_apart:
        return cleaned_texts(inputs.order_reviews)
    # a short table of long texts is a task or two, and cleaning takes long
    spread = inputs.review_texts.repartition(TEXT_ID)
    texts = cleaned_texts(spread).select(TEXT_ID, "cleaned_text")
    if inputs.sends_texts:
        texts = F.broadcast(texts)
    return inputs.review_keys.join(texts, TEXT_ID)


def review_corpus(texts: DataFrame) -> DataFrame:
    """Texts worth analysing, with their bucket and weight."""
    message = F.col("review_comment_message")
    return texts.filter(
        F.col("review_score").isNotNull()
        & message.isNotNull()
        & (message != MISSING)
        & (F.length(message) >= MIN_TEXT_LENGTH)
    ).select(
        message.alias("text"),
        review_bucket(F.col("review_score")).alias("review_bucket"),
        F.col("n_items").alias("weight"),
    )


def term_counts(corpus: DataFrame) -> DataFrame:
    """Term and document frequencies of every word, texts tokenised once.

    Equal texts are first folded into one row with a weight per bucket; the fold
    combines before its shuffle, so a text that makes up a third of the corpus
    costs no more than any other. Each text then emits its tokens (term
    frequency), its different tokens (document frequency) and one NULL word (the
    text itself), told apart by their position in the outer array. The NULL
    word's row holds the corpus size, so a single shuffle by word yields all
    statistics.

    All statistics are sums of weights, so those of several days add up, and a text
    with a negative weight is taken back. A text whose weights cancel is not tokenised.
    """

    def weigh(condition: Column, name: str) -> Column:
        weighed = F.when(condition, F.col("weight")).otherwise(F.lit(0).cast("long"))
        return F.sum(weighed).alias(name)

    folded = corpus.groupBy("text").agg(
        *[weigh(F.col("review_bucket") == bucket, bucket) for bucket in BUCKETS]
    )
    folded = folded.filter(" or ".join(f"{bucket} != 0" for bucket in BUCKETS))
    tokenised = T.add_keyword_tokens(folded, "text", "tokens").withColumn(
        "weight", F.col(BUCKETS[0]) + F.col(BUCKETS[1]) + F.col(BUCKETS[2])
    )
    streams = F.array("tokens", F.array_distinct("tokens"), F.array(F.lit(None).cast("string")))
    carried = [*BUCKETS, "weight"]
    emitted = tokenised.select(
        *carried, F.size("tokens").alias("length"), F.posexplode(streams)
    ).select(
        *carried, "length", F.col("pos").alias("stream"), F.explode("col").alias("word")
    )
    stream = F.col("stream")

    def in_bucket(bucket: str) -> Column:
        counted = F.when(stream == 0, F.col(bucket)).otherwise(F.lit(0).cast("long"))
        return F.sum(counted).alias(f"freq_{bucket}")

    counts = emitted.groupBy("word").agg(
        *[in_bucket(bucket) for bucket in BUCKETS],
        weigh(stream == 1, "doc_freq"),
        weigh((stream == 2) & (F.col("length") > 0), "corpus_size"),
        weigh(stream == 2, "text_count"),
    )
    return M.kept_sums(counts, ["word"])


def keyword_scores(corpus: DataFrame, require_min_docs: bool = False) -> DataFrame:
    """TF-IDF and log-odds of every (bucket, word) in the vocabulary.

    The vocabulary keeps words that are neither too common (IDF) nor too rare
    (document frequency); totals for the log-odds are over all words.
    ``require_min_docs`` gives no keywords at all for fewer than ``MIN_CORPUS`` texts.
    """
    counts = term_counts(corpus)
    sums = [F.sum(name).cast("double").alias(name) for name in counts.columns if name != "word"]
    totals = counts.agg(F.struct(*sums).alias("totals")).scalar()
    total = {name: totals.getField(name) for name in counts.columns if name != "word"}

    def log_odds(bucket: str) -> Column:
        seen = F.col(f"freq_{bucket}")
        return F.log((seen + SMOOTHING) / (total[f"freq_{bucket}"] - seen + SMOOTHING))

    in_either = F.col("freq_negative") + F.col("freq_positive") > 0
    vocabulary = (
        counts.filter(
            # not the NULL word; said of summed columns, so that this branch and
            # the totals keep the same grouped rows and Spark shuffles them once
            (F.col("corpus_size") + F.col("text_count") == 0)
            & (F.col("doc_freq") >= MIN_DOCUMENTS)
        )
        .withColumn("idf", F.log(total["corpus_size"] / F.col("doc_freq")))
        .filter(F.col("idf") >= MIN_IDF)
    )
    if require_min_docs:
        vocabulary = vocabulary.filter(total["text_count"] >= MIN_CORPUS)
    per_bucket = vocabulary.select(
        "word",
        "idf",
        "doc_freq",
        "freq_negative",
        "freq_positive",
        F.when(in_either, log_odds("negative") - log_odds("positive"))
        .otherwise(F.lit(0.0))
        .alias("log_odds"),
        F.explode(
            F.create_map(
                *[x for bucket in BUCKETS for x in (F.lit(bucket), F.col(f"freq_{bucket}"))]
            )
        ).alias("review_bucket", "tf"),
    ).filter(F.col("tf") > 0)
    return per_bucket.select(
        "review_bucket",
        F.col("word").alias("keyword"),
        F.round((F.log("tf") + 1) * F.col("idf"), 4).alias("tfidf_score"),
        F.round("log_odds", 4).alias("log_odds"),
        "freq_negative",
        "freq_positive",
        F.col("doc_freq").alias("total_docs"),
    )


def top_keywords(
    corpus: DataFrame, per_bucket: int = KEYWORDS_PER_BUCKET, require_min_docs: bool = False
) -> DataFrame:
    """The best keywords of each bucket by their rounded TF-IDF."""
    best_first = Window.partitionBy("review_bucket").orderBy(F.desc("tfidf_score"), "keyword")
    return (
        keyword_scores(corpus, require_min_docs)
        .withColumn("place", F.row_number().over(best_first))
        .filter(F.col("place") <= per_bucket)
        .drop("place")
    )


def complaint_rules(spark: SparkSession) -> DataFrame:
    """The stated rules as rows (cause, word)."""
    rows = [(cause, word) for cause, words in COMPLAINT_CAUSES.items() for word in words]
    return spark.createDataFrame(rows, "cause string, word string")


def complaint_causes(
    corpus: DataFrame, rules: DataFrame | None = None, most_sent: int = RULES_TO_SEND
) -> DataFrame:
    """How many texts point to each cause by one word at least.

    ``rules`` has a row (cause, word) per word; up to ``most_sent`` of them are sent to the
    tokens, more meet them in a shuffle. Either way only tokens with a rule go on. A text
    is known by its digest: all words that it has for a cause carry the same weight, so
    the greatest of their sums is the weight of the texts.
    """
    given = complaint_rules(corpus.sparkSession) if rules is None else rules
    pointing = given.filter(F.col("word").isNotNull()).select("cause", "word").distinct()
    if pointing.count() <= most_sent:
        pointing = F.broadcast(pointing)
    else:
        pointing = pointing.hint("merge")
    # equal texts are tokenised once
    folded = corpus.groupBy("text").agg(F.sum("weight").alias("weight"))
    tokens = T.add_keyword_tokens(folded, "text", "tokens").select(
        F.md5(F.col("text").cast("binary")).alias("digest"),
        "weight",
        F.explode(F.array_distinct("tokens")).alias("word"),
    )
    by_word = (
        tokens.join(pointing, "word")
        .groupBy("digest", "cause", "word")
        .agg(F.sum("weight").alias("weight"))
    )
    by_text = by_word.groupBy("digest", "cause").agg(F.max("weight").alias("weight"))
    counted = by_text.groupBy("cause").agg(F.sum("weight").alias("review_items"))
    return (
        given.select("cause")
        .distinct()
        .join(counted, "cause", "left")
        .select("cause", F.coalesce("review_items", F.lit(0)).alias("review_items"))
    )
