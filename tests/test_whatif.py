from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from cartpulse.operators import models, whatif
from tests.conftest import SMALL

COLUMNS = "review_score int, delivery_delay_days double, shipping_duration_days double, freight_value double, price double, product_weight_g double"
EDGES = [
    (1, 20.0, 25.0, 45.0, 100.0, 6000.0),
    (2, 15.0, 1.5, 30.0, 1500.0, 5000.0),
    (3, 0.5, 70.0, 30.01, 20.0, 25000.0),
    (4, 0.0, 3.0, 10.0, 50.0, 100.0),
    (5, -40.0, 5.0, 200.0, 10.0, 5001.0),
    (5, None, None, 5.0, 10.0, 300.0),
    (5, 2.0, 8.0, 31.0, 10.0, 300.0),
]


@pytest.fixture
def prepared(frame):
    return whatif.prepare(frame(COLUMNS, [*EDGES, (None, 1.0, 1.0, 1.0, 1.0, 1.0)]))


def changed_by_hand(scenario: str) -> pd.DataFrame:
    """The measures in plain pandas, one after the other."""
    df = pd.DataFrame(EDGES, columns=[c.split()[0] for c in COLUMNS.split(", ")])
    df["late"] = (df.delivery_delay_days > 0).astype(int)
    df["dear"] = (df.freight_value > 30).astype(int)
    df["heavy"] = (df.product_weight_g > 5000).astype(int)
    for name, (low, high) in whatif.CLIPS.items():
        df[f"{name}_clipped"] = df[name].clip(low, high)
    steps = ["S1", "S2", "S3", "S4"] if scenario == "S5" else [scenario]
    for step in steps:
        delay = df.delivery_delay_days
        if step == "S1":
            mask, by = delay > 0, delay[delay > 0].mean()
            df.loc[mask, ["delivery_delay_days", "delivery_delay_days_clipped"]] = 0.0
            floors = {"shipping_duration_days": 1.0, "shipping_duration_days_clipped": 1.0}
        elif step == "S2":
            mask, by = delay > 14, 1.5
            floors = {"delivery_delay_days": -146, "delivery_delay_days_clipped": -30,
                      "shipping_duration_days": 1.0, "shipping_duration_days_clipped": 1.0}
        elif step == "S4":
            mask, by = (df.late == 1) & ((df.dear == 1) | (df.heavy == 1)), 2.0
            floors = {"delivery_delay_days": -146, "delivery_delay_days_clipped": -30,
                      "shipping_duration_days": 1.0}
        else:
            df["freight_value"] = df.freight_value.clip(upper=30)
            df["freight_value_clipped"] = df.freight_value_clipped.clip(upper=30)
            df["dear"] = 0
            continue
        for name, floor in floors.items():
            df.loc[mask, name] = (df.loc[mask, name] - by).clip(lower=floor)
        df["late"] = (df.delivery_delay_days > 0).astype(int)
    return df


@pytest.mark.parametrize("scenario", list(whatif.SCENARIOS))
def test_changed_values(prepared, scenario):
    names = [n for n in whatif._CHANGED if n.endswith(("_days", "_clipped", "_value"))]
    wanted = changed_by_hand(scenario)
    flags = {"is_late": "late", "is_high_freight": "dear"}
    kept = whatif.simulate(prepared).filter(f"scenario_id = '{scenario}'").toPandas()
    original = ["review_score", "price", "product_weight_g"]
    order = lambda df: df.sort_values(original).reset_index(drop=True)
    kept, wanted = order(kept), order(wanted)
    for name in names:
        np.testing.assert_allclose(
            kept[f"{name}_sim"].astype(float), wanted[name].astype(float), rtol=1e-12, err_msg=name
        )
    for name, by_hand in flags.items():
        assert kept[f"{name}_sim"].tolist() == wanted[by_hand].tolist()


def test_rule_summary(prepared):
    row = whatif.rule_summary(prepared).filter("scenario_id = 'S1'").first()
    scores = np.array([1 + 1.708, 2 + 1.708, 3 + 1.708, 4, 5, 5, 5])
    assert (row.total_orders, row.affected_orders) == (7, 4)
    assert row.baseline_avg_review == round(25 / 7, 4)
    assert row.projected_avg_review == round(scores.mean(), 4)
    margin = 1.96 * scores.std() / np.sqrt(7)
    assert row.ci_lower_95 == round(scores.mean() - margin, 4)
    assert row.projected_neutral_pct == round(2 / 7 * 100, 2)


def test_combined_equals_first_and_third(prepared):
    rows = {r.scenario_id: r for r in whatif.rule_summary(prepared).collect()}
    assert rows["S5"].review_delta >= max(rows["S1"].review_delta, rows["S3"].review_delta)
    assert whatif.best_scenario(whatif.rule_summary(prepared)).first().scenario_id == "S5"


def test_missing_columns_are_named(frame):
    with pytest.raises(ValueError, match="price.*product_weight_g"):
        whatif.prepare(frame("review_score int, delivery_delay_days double, shipping_duration_days double, freight_value double", []))


def test_clip_keeps_null(frame):
    df = frame("v double", [(-5.0,), (0.5,), (9.0,), (None,)])
    found = [r[0] for r in df.select(whatif.clip(df.v, 0.0, 1.0)).collect()]
    assert found == [0.0, 0.5, 1.0, None]


def test_forest_projection_and_detail(spark):
    from cartpulse.plans import catalogue

    mart = catalogue.mart_of(spark, SMALL)
    prepared = whatif.prepare(mart.items("order_item_id", "review_score", *whatif.SOURCES))
    training = whatif.training_rows(prepared)
    small = models.review_forest().setNumTrees(10)
    with models.kept(training) as rows:
        model = small.fit(rows)
    summary = {r.scenario_id: r for r in whatif.forest_summary(prepared, model).collect()}
    assert set(summary) == set(whatif.SCENARIOS)
    assert all(1 <= r.ci_lower_95 <= r.projected_avg_review <= r.ci_upper_95 <= 5 for r in summary.values())
    detail = whatif.order_detail(prepared, model)
    assert detail.count() == prepared.count()
    means = detail.agg({f"predicted_review_{s}": "avg" for s in whatif.SCENARIOS}).first().asDict()
    for scenario, row in summary.items():
        assert means[f"avg(predicted_review_{scenario})"] == pytest.approx(row.projected_avg_review, abs=1e-3)


def test_every_different_cell_is_scored_once(spark, monkeypatch):
    """Scores by cells are those of ``transform``, thresholds themselves included."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import RandomForestRegressionModel
    from pyspark.sql import functions as F

    drawn = spark.range(3_000).select(
        F.round(F.rand(1) * 20).alias("a"), F.rand(2).alias("b"), (F.col("id") % 5).alias("review_score")
    )
    rows = models.assemble(drawn, ("a", "b")).cache()
    model = models.review_forest().setNumTrees(4).setMaxDepth(3).fit(rows)
    at = [(x, y) for x in models.forest_thresholds(model)[0] for y in models.forest_thresholds(model)[1]]
    edges = models.assemble(spark.createDataFrame(at, "a double, b double"), ("a", "b"))
    rows = rows.select("a", "b", "features").unionByName(edges.select("a", "b", "features"))
    want = sorted(tuple(r) for r in model.transform(rows).select("a", "b", "prediction").collect())
    scored, transform = [], RandomForestRegressionModel.transform

    def counted(self, df, *more):
        scored.append(df.count())
        return transform(self, df, *more)

    monkeypatch.setattr(RandomForestRegressionModel, "transform", counted)
    values = rows.withColumn("values", vector_to_array("features"))
    found = models.cell_scores(values, model, {"values": "prediction"}).select("a", "b", "prediction")
    assert sorted(tuple(r) for r in found.collect()) == want
    assert sum(scored) < rows.count() / 2


def test_bootstrap_interval_is_near_the_normal_one(spark):
    from pyspark.sql import functions as F

    scored = spark.range(20_000).select(
        F.lit("S1").alias("scenario_id"), (F.pmod(F.xxhash64("id"), F.lit(5)) + 1).cast("double").alias("predicted")
    )
    low, high = whatif.bootstrap_interval(scored).select("ci_lower_95", "ci_upper_95").first()
    values = scored.agg(F.avg("predicted"), F.stddev_pop("predicted")).first()
    margin = 1.96 * values[1] / np.sqrt(20_000)
    assert low == pytest.approx(values[0] - margin, abs=margin / 3)
    assert high == pytest.approx(values[0] + margin, abs=margin / 3)
    again = whatif.bootstrap_interval(scored).select("ci_lower_95", "ci_upper_95").first()
    assert (low, high) == tuple(again)


def test_bootstrap_summary_replaces_the_interval_only(prepared):
    plain = {r.scenario_id: r.asDict() for r in whatif.rule_summary(prepared).collect()}
    drawn = whatif.rule_summary(prepared, bootstrap=True).collect()
    assert len(drawn) == len(plain)
    for row in drawn:
        same = {k: v for k, v in row.asDict().items() if not k.startswith("ci_")}
        assert same == {k: plain[row.scenario_id][k] for k in same}
        assert row.ci_lower_95 < row.projected_avg_review < row.ci_upper_95
