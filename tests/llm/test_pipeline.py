"""The pipeline's stages on odd rows: defined results, own columns, empty tables."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from cartpulse.llm import adaptjoin, langid, simhash

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row_key string, node int, keeper int, verdict string"


def docs_of(frame, rows):
    return frame(SCHEMA, [(i, text, "en", "s", 0, "r", 1, 2, "v") for i, text in rows])


def words(seed, n):
    draw = random.Random(seed)
    return " ".join(f"{draw.choice('abcdefgh')}{draw.randrange(10**6)}" for _ in range(n))


def test_one_of_each_group(frame):
    long = words(1, 100)
    rows = [
        (3, long), (1, long), (1, long), (7, long + " x"), (8, words(2, 100)), (None, words(3, 9)), (4, words(3, 9)),
        (9, None), (5, ""), (6, " \n"), (5, ""), (10, "two words"), (11, "TWO words"), (12, "two"),
    ]
    kept = adaptjoin.one_of_each_group(docs_of(frame, rows))
    assert kept.columns == docs_of(frame, rows).columns
    assert sorted(row.doc_id for row in kept.collect()) == [1, 4, 5, 8, 10, 12]
    assert simhash.dedup_stage(docs_of(frame, [])).collect() == []


def test_keys_beyond_the_bound_meet_their_rows_in_a_shuffle(frame, monkeypatch):
    monkeypatch.setattr(adaptjoin, "KEYS_TO_SEND", 0)
    long = words(1, 200)
    rows = [(i, long.replace(" ", f" e{i} ", i % 3)) for i in range(12)] + [(20, words(2, 50)), (1, long)]
    kept = adaptjoin.one_of_each_group(docs_of(frame, rows))
    assert sorted(row.doc_id for row in kept.collect()) == [0, 20]


def test_language_stage_keeps_columns_and_whole_texts(frame):
    english = "the cat and the dog went to the house of the old man and his wife " * 3
    german = "der hund und die katze gingen in das haus des alten mannes und seiner frau " * 3
    rows = [(i, (english, german)[i % 2] + words(i, 3), ("en", "de")[i % 2]) for i in range(40)]
    rows += [(50, None, "en"), (51, "", None), (52, "12 34", "en"), (53, english * 3_000, "en"), (54, "漢字" * 50, None)]
    schema = "doc_id bigint, text string, lang string, row int, known int, verdict int"
    docs = frame(schema, [(*row, 1, 2, 3) for row in rows])
    kept = langid.language_stage(docs)
    assert kept.columns == docs.columns
    found = {row.doc_id: row for row in kept.collect()}
    assert set(found) == {*range(40), 53} and len(found[53].text) == len(english * 3_000)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan  # only texts go to Python
    assert langid.language_stage(docs.limit(0)).collect() == []


@pytest.mark.parametrize("rows", [[], [(1, None), (None, ""), (2, "only one text that is known")]])
def test_run_on_tiny_tables(spark, frame, tmp_path, rows):
    docs_of(frame, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {row.doc_id for row in found} <= {i for i, text in rows if text}


def test_kernel_values_by_sets():
    """What the ridge learns from are shared n-grams over the root of both numbers of n-grams."""
    texts = ["abc abd", "abc", "xyz xyz", "ab ab ab", "hello world"]

    def grams(text):
        padded = " ".join(text.split())
        return {padded[i : i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1)}

    vocabulary = np.unique(np.concatenate([langid.ngram_slots(t) for t in texts]))
    rows, sizes = langid.presence(texts, vocabulary)
    for i, a in enumerate(texts):
        assert sizes[i] == len(grams(a))
        for j, b in enumerate(texts):
            assert rows[i] @ rows[j] == len(grams(a) & grams(b))


def test_near_dedup_keeps_one_of_each_group_by_brute_force(frame):
    """All pairs of all rows, whatever their fingerprints say: no link is left out."""
    draw = random.Random(7)
    texts = []
    for group in range(12):
        base = words(100 + group, draw.choice((12, 60, 150))).split()
        for _ in range(6):
            copy = list(base)
            for _ in range(draw.choice((0, 0, 1, 2, 4, 8))):
                copy[draw.randrange(len(copy))] = f"z{draw.randrange(10**6)}"
            texts.append(" ".join(copy))
    texts += ["", None, " \n", "one two", "ONE two", "one"]
    draw.shuffle(texts)

    def shingles(text):
        split = (text or "").lower().split()
        return {tuple(split[i : i + 5]) for i in range(max(len(split) - 4, 1))} if split else set()

    sets = [shingles(text) for text in texts]
    root = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            near = sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
            if (near or not sets[a] and not sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    kept = simhash.dedup_stage(docs_of(frame, list(enumerate(texts))))
    assert sorted(row.doc_id for row in kept.collect()) == sorted(set(root))
