from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartpulse.operators import forests, models, whatif
from cartpulse.plans import catalogue
from tests.conftest import SMALL, rows_of


@pytest.fixture
def drawn(spark):
    return spark.range(5_000).select(
        F.round(F.rand(1) * 200).alias("a"),
        (F.rand(2) < 0.5).cast("double").alias("b"),
        (F.pmod(F.xxhash64("id"), F.lit(5)) + 1).alias("review_score"),
    )


def test_forests_learn_from_all_rows(spark, monkeypatch):
    many = spark.range(20_500).select(F.col("id").cast("double").alias("a"), F.lit(3).alias("review_score"))
    assert models.labelled_sample(models.assemble(many, ["a"])).count() == 20_500
    seen, fit = [], forests.Forest.fit
    monkeypatch.setattr(forests.Forest, "fit", lambda self, rows: seen.append(rows.count()) or fit(self, rows))
    monkeypatch.setattr(models, "review_forest", lambda: forests.Forest(trees=2, depth=2))
    mart = catalogue.mart_of(spark, SMALL)
    prepared = whatif.prepare(mart.items("order_id", "order_item_id", "review_score", *whatif.SOURCES)).cache()
    whatif.forest_summary(prepared)
    catalogue._forest_detail(mart)
    models.cross_validate(whatif.training_rows(prepared), folds=2)
    every = prepared.count()
    assert seen.count(every) == 3 and sum(seen) == 4 * every


def test_thresholds_cut_sorted_rows_into_equal_parts(drawn):
    found = forests.thresholds_of(drawn.select(F.array("a", "b").alias("values")), 2)
    a = np.sort([row.a for row in drawn.collect()])
    values, counts = np.unique(a, return_counts=True)
    upto = np.cumsum(counts)
    before = upto - counts
    cut = np.flatnonzero((before * 32 // len(a) < upto * 32 // len(a))[:-1])
    assert found == [[(values[i] + values[i + 1]) / 2 for i in cut], [0.5]]


def test_folded_rows_count_every_row(drawn):
    rows = drawn.select(F.array("a", "b").alias("values"), F.col("review_score").cast("double").alias("label"))
    thresholds = [[10.0, 50.5, 90.0], [0.5]]
    found = {(row.key, row.label): row.n for row in forests.folded(rows, thresholds).collect()}
    want: dict = {}
    for row in rows.collect():
        key = int(np.searchsorted(thresholds[0], row["values"][0])) | int(row["values"][1] > 0.5) << 2
        want[key, row.label] = want.get((key, row.label), 0) + 1
    assert found == want
    at = forests.places(np.array([key for key, _ in want]), thresholds)
    assert [int(a | b << 2) for a, b in at.T] == [key for key, _ in want]


def test_draws_have_the_weight_as_mean_and_variance():
    hashes = np.random.default_rng(3).integers(0, 2**63, 20_000).astype(np.uint64)
    for n in (1, 5, 300):
        drawn = forests.Draws(42).of_trees(hashes, np.full(len(hashes), n), 3)
        assert drawn.mean(axis=1) == pytest.approx([n] * 4, rel=0.03)
        assert drawn.var(axis=1) == pytest.approx([n] * 4, rel=0.06)
        assert abs(np.corrcoef(drawn)[0, 1]) < 0.03


def test_best_split_by_brute_force():
    draw = np.random.default_rng(5)
    begins = np.array([0, 4, 6])
    place = np.stack([draw.integers(0, 4, 300), draw.integers(0, 2, 300)])
    label = draw.integers(1, 6, 300) + 2.0 * (place[0] > 1)
    sums = np.zeros((1, 6, 2))
    for f, begin in enumerate(begins[:2]):
        np.add.at(sums[0, :, 0], begin + place[f], 1)
        np.add.at(sums[0, :, 1], begin + place[f], label)
    found = forests.best_splits(sums, begins, 1)
    gains = {
        (f, b): 300 * label.var() - sum(side.size * side.var() for side in (label[place[f] <= b], label[place[f] > b]))
        for f, b in ((0, 0), (0, 1), (0, 2), (1, 0))
    }
    best = max(gains, key=gains.get)
    assert (found[0][1], found[0][2]) == best and found[0][3] == pytest.approx(gains[best])
    assert forests.best_splits(sums, begins, 200) == []


def test_fit_does_not_depend_on_where_rows_lie(drawn):
    rows = models.assemble(drawn, ("a", "b")).cache()
    small = forests.Forest(trees=3, depth=4)
    one, two = small.fit(rows.coalesce(1)), small.fit(rows.repartition(7, "a"))
    scores = [rows_of(model.transform(rows), "a", "b", "prediction") for model in (one, two)]
    assert scores[0] == scores[1]
    mse, spread = one.errors(rows)
    scored = one.transform(rows).toPandas()
    assert mse == pytest.approx(((scored.review_score - scored.prediction) ** 2).mean())
    assert spread == pytest.approx(scored.review_score.var(ddof=0)) and mse < spread
