from __future__ import annotations

import math
from collections import Counter

import pytest

from cartpulse.operators import keywords as K
from cartpulse.operators.fact import Inputs
from cartpulse.schemas import INPUTS
from cartpulse.sources import testtables
from tests.conftest import SMALL, rows_of
from tests.test_functions import keyword_tokens_by_hand

REVIEWS = [
    (1, "Quero estorno do dinheiro, produto ruim", 2),
    (2, "quero meu dinheiro de volta", 1),
    (5, "otimo produto, chegou rapido", 3),
    (4, "chegou rapido e bem embalado", 1),
    (3, "produto normal", 1),
    (5, "ok!!!!", 1),
]


def corpus(frame, copies=1):
    rows = [(text, score, weight) for score, text, weight in REVIEWS] * copies
    texts = frame("review_comment_message string, review_score int, n_items bigint", rows)
    return K.review_corpus(texts)


def scores_by_hand(copies: int):
    """The definition, item by item, in plain Python."""
    docs = [
        ("negative" if s <= 2 else "positive" if s >= 4 else "neutral", keyword_tokens_by_hand(t))
        for s, t, w in REVIEWS * copies
        for _ in range(w)
    ]
    docs = [d for d in docs if d[1]]
    tf = {b: Counter(w for bucket, ws in docs if bucket == b for w in ws) for b in K.BUCKETS}
    df = Counter(w for _, ws in docs for w in set(ws))
    negative, positive = (sum(tf[b].values()) for b in ("negative", "positive"))
    found = {}
    for word, n in df.items():
        idf = math.log(len(docs) / n)
        if idf < K.MIN_IDF or n < K.MIN_DOCUMENTS:
            continue
        a, b = tf["negative"][word], tf["positive"][word]
        odds = 0.0
        if a + b:
            odds = math.log((a + 0.5) / (negative - a + 0.5)) - math.log(
                (b + 0.5) / (positive - b + 0.5)
            )
        for bucket in K.BUCKETS:
            if tf[bucket][word]:
                score = (1 + math.log(tf[bucket][word])) * idf
                found[bucket, word] = (round(score, 4), round(odds, 4), a, b, n)
    return found


def test_scores_match_the_definition(frame, monkeypatch):
    monkeypatch.setattr(K, "MIN_IDF", 1.0)
    rows = K.keyword_scores(corpus(frame, 12)).collect()
    found = {(r.review_bucket, r.keyword): tuple(r)[2:] for r in rows}
    assert found == scores_by_hand(12) and found


def test_small_corpus_gives_nothing(frame):
    assert K.keyword_scores(corpus(frame)).count() == 0


def test_best_keywords_per_bucket(frame, monkeypatch):
    monkeypatch.setattr(K, "MIN_IDF", 1.0)
    top = K.top_keywords(corpus(frame, 12), per_bucket=2).collect()
    wanted = scores_by_hand(12)
    for bucket in K.BUCKETS:
        ranked = sorted(
            (w for b, w in wanted if b == bucket), key=lambda w: (-wanted[bucket, w][0], w)
        )
        assert sorted(r.keyword for r in top if r.review_bucket == bucket) == sorted(ranked[:2])


def test_corpus_leaves_out_short_and_missing_texts(frame):
    texts = frame(
        "review_comment_message string, review_score int, n_items bigint",
        [(None, 1, 1), ("", 1, 1), ("missing", 1, 1), ("cinco", 1, 1), ("seis66", 1, 1), ("seis66", None, 1)],
    )
    assert rows_of(K.review_corpus(texts)) == [("seis66", "negative", 1)]


def test_frequent_words_are_weighted_and_skip_stop_words(frame):
    texts = frame(
        "review_comment_message string, review_score int, n_items bigint",
        [("Ruim, muito ruim", 1, 2), ("atraso para entrega ruim", 2, 1), ("ruim", 3, 9)],
    )
    assert [tuple(r) for r in K.frequent_words(texts, 2, 2).collect()] == [("ruim", 5), ("atraso", 1)]
    assert [tuple(r) for r in K.frequent_words(texts, 1, 5).collect()] == [("ruim", 4)]


def test_notebook_words(frame):
    reviews = frame(
        "review_comment_message string, review_score int",
        [("Não-chegou ainda", 1), ("ainda nada", 1), (None, 1), ("ainda", 2)],
    )
    found = [tuple(r) for r in K.squeezed_word_counts(reviews).collect()]
    assert found == [("ainda", 2), ("nada", 1), ("nãochegou", 1)]


def test_complaint_causes(frame):
    texts = frame(
        "text string, review_bucket string, weight bigint",
        [
            ("pedi estorno e quero meu dinheiro", "negative", 2),
            ("uma resposta", "negative", 1),
            ("falta respeito", "negative", 1),
            ("falta de respeito", "negative", 1),  # the short word is dropped first
            ("tudo certo", "positive", 5),
        ],
    )
    assert dict(rows_of(K.complaint_causes(texts))) == {
        "Refund Issues": 2, "Unresponsive CS": 1, "Poor Seller Behavior": 2,
    }


@pytest.mark.parametrize(("most_sent", "kind"), [(10, "BroadcastHashJoin"), (1, "SortMergeJoin")])
def test_complaint_rules_as_a_table(frame, most_sent, kind):
    rows = [("a late box", "negative", 2), ("a late box", "negative", 3), ("late again and late", "neutral", 1), ("fine", "positive", 7), (None, "negative", 9)]
    texts = frame("text string, review_bucket string, weight bigint", rows)
    rules = frame("cause string, word string", [("Delay", "late"), ("Delay", "again"), ("Delay", "late"), ("Packing", "box"), ("Never", "xyz"), ("Blank", None)])
    found = K.complaint_causes(texts, rules, most_sent)
    assert dict(rows_of(found)) == {"Delay": 6, "Packing": 5, "Never": 0, "Blank": 0}
    assert f"{kind} [word" in found._jdf.queryExecution().executedPlan().toString()


def test_one_shuffle_for_counts_and_totals(frame):
    scores = K.keyword_scores(corpus(frame, 12))
    scores.collect()
    assert "ReusedExchange" in scores._jdf.queryExecution().executedPlan().toString()


def test_cleaned_reviews_clean_a_text_once(spark, inputs_of):
    given = {name: getattr(inputs_of(), name) for name in INPUTS}
    texts = spark.createDataFrame([(1, "Muito BOM mesmo"), (2, None), (3, "")], "text_id bigint, review_comment_message string")
    keys = spark.createDataFrame(
        [("a", 1), ("b", 1), ("c", 2), ("d", None), ("e", 3), ("f", 9)], "review_id string, text_id bigint"
    )
    given["order_reviews"] = keys.join(texts, "text_id", "left").select("review_id", "review_comment_message")
    apart = Inputs(**given, review_keys=keys, review_texts=texts)
    found = K.cleaned_reviews(apart)
    want = rows_of(K.cleaned_reviews(Inputs(**given)), "review_id", "cleaned_text")
    assert rows_of(found, "review_id", "cleaned_text") == want and len(want) == 3
    # no text is in the rows that are joined, so none is cleaned once for every review
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("regexp_replace")


def test_equal_texts_are_tokenised_once_for_causes(frame):
    corpus = frame("text string, review_bucket string, weight bigint", [("quero meu dinheiro agora", "negative", n) for n in (1, 2, 4)])
    found = K.complaint_causes(corpus)
    assert dict(rows_of(found, "cause", "review_items"))["Refund Issues"] == 7
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    explode = next(i for i, line in enumerate(plan) if "Generate explode" in line)
    assert any("Aggregate [text" in line for line in plan[explode:])


def test_texts_are_spread_before_any_task_gathers_them(spark):
    """A file of one row group is one task, which must not sort or fold its texts."""
    documents = testtables.table(spark, SMALL, "documents")
    labelled = testtables.labelled_corpus(spark, SMALL)
    for rows in (testtables._review_texts(documents), K.term_counts(labelled)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        spread = plan.index("REPARTITION_BY_COL")
        below = plan[spread : plan.index("FileScan", spread)]
        assert "Aggregate" not in below and "Sort " not in below
