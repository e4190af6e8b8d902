"""Model jobs, the trend stream and a whole batch run."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from cartpulse.operators import clusters, models, whatif
from cartpulse.plans import catalogue, dashboards, job, tables
from cartpulse.plans.mart import StoredMart
from cartpulse.schemas import TABLES
from cartpulse.sources import testtables
from cartpulse.streaming import trend
from tests.conftest import SMALL, rows_of

CUSTOMERS = "customer_unique_id string, recency_days int, frequency bigint, monetary double"


@pytest.fixture(scope="module")
def live(spark):
    return catalogue.mart_of(spark, SMALL)


def test_clusters_separate_clear_groups(frame):
    centres = [(0, 1, 0.0), (300, 1, 0.0), (0, 20, 0.0), (0, 1, 9e5)]
    rows = [(f"c{i}", r + i % 3, f, m + i) for i, (r, f, m) in enumerate(centres * 10)]
    found = models.with_clusters(frame(CUSTOMERS, rows)).collect()
    labels = [{row.kmeans_cluster for row in found if int(row.customer_unique_id[1:]) % 4 == g} for g in range(4)]
    assert all(len(group) == 1 for group in labels)
    assert set().union(*labels) == {f"Cluster {i}" for i in range(4)}


def test_labels_follow_from_the_rows(live):
    """Any order and number of partitions give the same labels and costs; each is the nearest centre's."""
    customers = tables.loyalty_rfm(live).select("customer_unique_id", *models.RFM)
    rows = customers.toPandas()
    spark = customers.sparkSession
    results = []
    for n in (1, 7):
        df = spark.createDataFrame(rows.sample(frac=1, random_state=n)).repartition(n)
        labels = rows_of(models.with_clusters(df), "customer_unique_id", "kmeans_cluster")
        results.append((labels, rows_of(models.elbow(df, largest_k=5))))
    assert results[0] == results[1]

    values = rows[list(models.RFM)].fillna(0).to_numpy(float)
    scaled = (values - values.mean(axis=0)) / values.std(axis=0, ddof=1)
    found = clusters.fit(customers, models.RFM, [4], models.kept)[4]
    centres = np.array(found.centres) / clusters.UNIT
    apart = ((scaled[:, None, :] - centres[None]) ** 2).sum(axis=2)
    labels = dict(results[0][0])
    assert [labels[c] for c in rows.customer_unique_id] == [f"Cluster {i}" for i in apart.argmin(axis=1)]
    assert found.cost == pytest.approx(apart.min(axis=1).sum(), rel=1e-6)
    assert dict(results[0][1])[4] == pytest.approx(found.cost, rel=1e-12)
    # no further pass would lower the cost by much
    moved = np.array([scaled[apart.argmin(axis=1) == i].mean(axis=0) for i in range(4)])
    assert ((scaled[:, None, :] - moved[None]) ** 2).sum(axis=2).min(axis=1).sum() >= 0.99 * found.cost


def test_clusters_of_few_rows(frame):
    assert models.with_clusters(frame(CUSTOMERS, [])).collect() == []
    one = models.with_clusters(frame(CUSTOMERS, [("a", None, 1, None), ("a", None, 1, None)]))
    assert {row.kmeans_cluster for row in one.collect()} == {"Cluster 0"}


def test_folds_at_a_time_equal_folds_in_sequence(live, monkeypatch):
    small = models.review_forest().setNumTrees(5).setMaxDepth(4)
    monkeypatch.setattr(models, "review_forest", lambda: small.copy())
    prepared = whatif.prepare(live.items("order_id", "review_score", *whatif.SOURCES))
    training = whatif.training_rows(prepared)
    found = models.cross_validate(training, folds=3, max_labelled=2_000)
    measure = RegressionEvaluator(labelCol="review_score", metricName="r2")
    rows = models.labelled_sample(training, 2_000).withColumn(
        "fold", F.pmod(F.xxhash64("order_id"), F.lit(3)).cast("int")
    )
    want = []
    with models.kept(rows.select("features", "review_score", "fold")) as kept_rows:
        for fold in range(3):
            model = small.fit(kept_rows.filter(F.col("fold") != fold))
            want.append(measure.evaluate(model.transform(kept_rows.filter(F.col("fold") == fold))))
    assert found.r2 == pytest.approx(want, rel=1e-9) and found.mean() == pytest.approx(np.mean(want))


def test_clusters_work_their_rows_out_once(spark, frame):
    rows = [(f"c{i}", i % 50, i % 7, float(i % 11)) for i in range(200)]
    seen = spark.sparkContext.accumulator(0)

    def counted(value):
        seen.add(1)
        return value

    told = F.udf(counted, "double").asNondeterministic()
    models.elbow(frame(CUSTOMERS, rows).withColumn("monetary", told("monetary")), largest_k=3).collect()
    assert seen.value == len(rows)


def test_kept_rows_are_few_tasks_until_they_are_many(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    with models.kept(spark.range(10_000).repartition(100, "id")) as rows:
        assert rows.rdd.getNumPartitions() <= cores and rows.count() == 10_000
    monkeypatch.setattr(models, "ROWS_PER_TASK", 500)
    with models.kept(spark.range(10_000).repartition(100, "id")) as rows:
        assert rows.count() == 10_000


def test_cluster_profile_counts_every_customer(live):
    customers = tables.loyalty_rfm(live)
    profile = models.cluster_profile(customers).collect()
    assert sum(row.customers for row in profile) == customers.count()


def test_elbow_falls_and_starts_at_the_total_spread(frame):
    rows = [(f"c{i}", i % 50, i % 7, float(i % 11)) for i in range(200)]
    costs = dict(rows_of(models.elbow(frame(CUSTOMERS, rows), largest_k=4)))
    assert costs[1] == pytest.approx(3 * 199, rel=1e-9)  # sample deviation, three columns
    assert costs[1] > costs[2] > costs[4]


def test_driver_importances(live, frame):
    found = models.driver_importances(live.items("review_score", *models.DRIVERS)).collect()
    assert [row.feature_name for row in found] == list(models.DRIVERS)
    assert sum(row.importance_pct for row in found) == pytest.approx(100)
    nothing = frame(f"review_score int, {', '.join(f'{n} double' for n in models.DRIVERS)}", [])
    assert models.driver_importances(nothing).count() == 0


def test_feature_impact(live, monkeypatch):
    small = models.review_forest().setNumTrees(5).setMaxDepth(4)
    monkeypatch.setattr(models, "review_forest", lambda: small)
    prepared = whatif.prepare(live.items("order_item_id", "review_score", *whatif.SOURCES))
    found = whatif.feature_impact(prepared).collect()
    assert sorted(row.feature_name for row in found) == sorted(whatif.FEATURES)
    assert sum(row.importance_pct for row in found) == pytest.approx(100, abs=0.1)
    assert len({row.model_r2 for row in found}) == 1 and found[0].model_r2 < 1


def test_holdout_quality(frame):
    rows = [(1 + i % 5, float(i % 5), 1.0, 1.0, 1.0, 1.0) for i in range(400)]
    schema = f"review_score int, {', '.join(f'{n} double' for n in models.DRIVERS)}"
    found = dict(rows_of(models.holdout_quality(frame(schema, rows))))
    assert found["r2"] > 0.95 and found["mse"] < 0.1


def test_trend_stream_appends_per_batch_and_repeats_safely(spark, tmp_path, frame):
    source, target, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    schema = "order_id string, product_category_name_english string, price double, freight_value double, review_score int"

    def deliver(rows):
        frame(schema, rows).coalesce(1).write.mode("append").parquet(source)

    def work_off():
        stream = spark.readStream.schema(schema).parquet(source)
        trend.start_trend(stream, target, state, once=True).awaitTermination()

    deliver([("o1", "home", 1.0, 0.0, 5), ("o1", "home", 2.0, 0.0, 5), ("o2", "toys", 4.0, 0.0, None)])
    work_off()
    deliver([("o3", "home", 8.0, 0.0, 1)])
    work_off()
    work_off()  # nothing new
    found = trend.read_trend(spark, target)
    assert rows_of(found, "batch_id", trend.CATEGORY, "total_orders", "total_revenue", "avg_review_score") == [
        (0, "home", 1, 3.0, 5.0), (0, "toys", 1, 4.0, None), (1, "home", 1, 8.0, 1.0),
    ]
    assert {"batch_time", "ingested_date"} <= set(found.columns)


def test_an_order_counts_once_over_batches_and_restarts(spark, tmp_path, frame):
    """Three batches with shared orders, each worked off by a stream that starts anew."""
    source, target, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    schema = "order_id string, product_category_name_english string, price double, freight_value double, review_score int"
    batches = [
        [("o1", "home", 1.0, 0.0, 5), ("o1", "toys", 2.0, 0.0, 5), ("o2", "home", 4.0, 0.0, None)],
        [("o1", "home", 8.0, 0.0, 5), ("o3", "home", 16.0, 0.0, 1), ("o1", None, 1.5, 0.0, 5)],
        [("o1", "home", 32.0, 0.0, 5), ("o3", "toys", 64.0, 0.0, 2), ("o1", None, 1.5, 0.0, None), (None, "toys", 0.1, 0.0, 4)],
    ]
    for rows in batches:
        frame(schema, rows).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        trend.start_trend(stream, target, state, once=True).awaitTermination()
    found = trend.read_trend(spark, target)
    assert rows_of(found.filter("batch_id = 1"), trend.CATEGORY, "total_orders") == [("home", 1), (None, 1)]
    everything = frame(schema, [row for rows in batches for row in rows])
    batch = everything.groupBy(trend.CATEGORY).agg(
        F.size(F.collect_set(F.coalesce("order_id", F.lit("none")))).alias("total_orders"),
        F.round(F.sum("price"), 4).alias("total_revenue"),
        F.avg("review_score").alias("avg_review_score"),
    )
    columns = (trend.CATEGORY, "total_orders", "total_revenue", "avg_review_score")
    assert rows_of(trend.trend_totals(found), *columns) == rows_of(batch, *columns)


def test_whole_run(spark, tmp_path, live, monkeypatch):
    """All 27 tables are written, and the dashboards read the same from them."""
    small = models.review_forest().setNumTrees(3).setMaxDepth(3)
    monkeypatch.setattr(models, "review_forest", lambda: small)
    inputs = testtables.read_inputs(spark, SMALL)
    stored = job.run(spark, inputs, str(tmp_path), catalogue.RUN_DATE, buckets=4)
    for name, contract in TABLES.items():
        assert set(spark.table(name).columns) == {f.name for f in contract}, name
    assert spark.table("orders_db.order_items").count() == inputs.order_items.count()

    for name, query in dashboards.QUERIES.items():
        assert query(stored).columns, name
    # one or two per table; tab 8 and q5_2 depend on a model or the clock
    for name in (
        "q1_1 q1_2 q1_7 q2_1 q2_2 q2_3 q2_7 q3_1 q3_3 q3_4 q3_5 q3_6 q4_1 q4_5 q4_6 q4_7 q5_1"
        " q6_4 q6_5 q7_1 q7_4 q7_6 q7_7"
    ).split():
        rows = dashboards.QUERIES[name](stored)
        columns = sorted(rows.columns)
        assert rows_of(rows, *columns) == rows_of(dashboards.QUERIES[name](live), *columns), name

    assert dashboards.QUERIES["q5_2"](stored).first().total_batch_days == 1
    history = spark.table("orders_db.history_category_trend")
    once = history.count()
    job.run(spark, inputs, str(tmp_path), catalogue.RUN_DATE, buckets=4, with_models=False)
    assert spark.table("orders_db.history_category_trend").count() == once > 0
    later = f"{catalogue.RUN_DATE} 00:05:00"
    job.run(spark, inputs, str(tmp_path), catalogue.RUN_DATE, buckets=4, with_models=False, batch_time=later)
    history = spark.table("orders_db.history_category_trend")
    assert history.count() == 2 * once and history.select("batch_time").distinct().count() == 2
    job.run(spark, inputs, str(tmp_path), "2024-02-01", buckets=4, with_models=False)
    again = dashboards.QUERIES["q5_2"](StoredMart(spark)).first()
    assert (again.total_batch_days, again.last_ingest_date) == (2, "2024-02-01")


def test_bucketed_fact_counts_orders_without_a_shuffle_by_order(spark):
    if not spark.catalog.tableExists("orders_db.order_items"):
        pytest.skip("needs the tables of a run")
    lines = StoredMart(spark).lines(["seller_id"], "review_score")
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_options_change_what_they_say(live):
    plain = dict(rows_of(tables.payment_analysis(live), "payment_type", "total_revenue"))
    once = dict(rows_of(tables.payment_analysis(live, once_per_order=True), "payment_type", "total_revenue"))
    assert all(once[kind] < plain[kind] for kind in plain)
    words = tables.top_bad_review_words(live, keep_sentinel=True)
    assert words.filter(F.col("word") == "missing").count() == 1
    assert tables.top_bad_review_words(live).filter(F.col("word") == "missing").count() == 0
