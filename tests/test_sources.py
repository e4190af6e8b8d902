from __future__ import annotations

import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cartpulse.operators import fact
from cartpulse.schemas import INPUTS, TABLES
from cartpulse.sources import csvfiles, scratch, snapshots, warehouse
from tests.conftest import rows_of, ts

REVIEWS = (
    "order_id,review_score,review_comment_message,review_creation_date,review_id\n"
    'o1,5,"Chegou ""antes"",\ntudo certo",2018-01-02 00:00:00,r1\n'
    "o2,,,,r2\n"
)


def test_csv_follows_the_header_and_keeps_quoted_lines(spark, tmp_path):
    (tmp_path / "order_reviews.csv").write_text(REVIEWS, encoding="utf-8")
    df = csvfiles.read_inputs(spark, str(tmp_path)).order_reviews
    assert [f.dataType for f in df.schema] == [f.dataType for f in INPUTS["order_reviews"]]
    assert rows_of(df) == [
        ("r1", "o1", 5, 'Chegou "antes",\ntudo certo', ts("2018-01-02 00:00:00")),
        ("r2", "o2", None, None, None),
    ]


def test_csv_without_an_optional_column(spark, tmp_path):
    (tmp_path / "order_payments.csv").write_text(
        "order_id,payment_type,payment_installments,payment_value\no1,boleto,1,9.5\n"
    )
    df = csvfiles.read_inputs(spark, str(tmp_path)).order_payments
    assert rows_of(df) == [("o1", None, "boleto", 1, 9.5)]


def test_all_eight_files_make_a_fact(spark, tmp_path):
    header = {name: ",".join(schema.fieldNames()) for name, schema in INPUTS.items()}
    rows = {
        "orders": "o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 11:00:00,2018-01-02 10:00:00,"
        "2018-01-05 10:00:00,2018-01-04 10:00:00",
        "order_items": "o1,1,p1,s1,10.5,2.0",
        "products": "p1,casa,900,1,2,3",
        "customers": "c1,u1,01310,sao paulo,SP",
        "sellers": "s1,09350,maua,SP",
        "order_payments": "o1,1,boleto,1,12.5",
        "order_reviews": "r1,o1,4,bom,2018-01-09 00:00:00",
        "category_translation": "casa,home",
    }
    for name in INPUTS:
        (tmp_path / f"{name}.csv").write_text(f"{header[name]}\n{rows[name]}\n")
    row = fact.item_fact(csvfiles.read_inputs(spark, str(tmp_path))).first()
    assert (row.product_category_name_english, row.payment_value, row.review_score) == ("home", 12.5, 4)
    assert (row.customer_zip_code_prefix, row.delivery_delay_days) == (1310, 1.0)


def test_utf16_sample(spark, tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text(
        "review_score,delivery_delay_days,shipping_duration_days,freight_value,price,product_weight_g\n"
        "5,-1.5,3.0,10,20,300\n4.0,,,1,2,3\n",
        encoding="utf-16",
    )
    assert rows_of(csvfiles.read_sample(spark, str(path))) == [
        (4, None, None, 1.0, 2.0, 3.0),
        (5, -1.5, 3.0, 10.0, 20.0, 300.0),
    ]


def test_sample_names_missing_columns(spark, tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text("review_score,price\n5,1\n", encoding="utf-16")
    with pytest.raises(ValueError, match="freight_value"):
        csvfiles.read_sample(spark, str(path))


def test_scenarios_round_trip_and_fill_counts(spark, tmp_path, frame):
    schema = TABLES["analytics.simulation_scenarios"]
    row = tuple("S1" if f.name == "scenario_id" else None for f in schema)
    csvfiles.write_csv(spark.createDataFrame([row], schema), str(tmp_path / "out"))
    back = csvfiles.read_scenarios(spark, str(tmp_path / "out")).first()
    assert (back.scenario_id, back.total_orders, back.affected_orders) == ("S1", 0, 0)
    assert back.projected_avg_review is None


def test_feature_impact_round_trip(spark, tmp_path):
    schema = TABLES["analytics.simulation_feature_impact"]
    df = spark.createDataFrame([("price_clipped", "Product Price (BRL)", 12.5, 0.147)], schema)
    csvfiles.write_csv(df, str(tmp_path / "out"))
    assert rows_of(csvfiles.read_feature_impact(spark, str(tmp_path / "out"))) == rows_of(df)


def test_latest_snapshot(spark, tmp_path, frame):
    base = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        snapshots.read_latest_snapshot(spark, base)
    rows = frame("order_id string, order_item_id int, price double", [("o1", 1, 1.0)])
    snapshots.write_snapshot(rows, base, "2018-01-01")
    newer = rows.withColumn("price", F.lit(2.0))
    snapshots.write_snapshot(newer, base, "2018-01-02")
    snapshots.write_snapshot(newer, base, "2018-01-02")
    assert rows_of(snapshots.read_latest_snapshot(spark, base)) == [("o1", 1, 2.0)]

    # files without a record are those of a run that was not finished
    unfinished = f"{base}/snapshot=2018-01-03/run=0"
    rows.write.parquet(unfinished)
    read = snapshots.read_latest_snapshot(spark, base)
    assert rows_of(read) == [("o1", 1, 2.0)]
    assert len({path.rsplit("/", 1)[0] for path in read.inputFiles()}) == 1
    assert f"Location: InMemoryFileIndex(1 paths)[{read.inputFiles()[0].split(':')[0]}:" in read._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


def test_newest_file(spark, tmp_path, frame):
    folder = str(tmp_path / "lake")
    with pytest.raises(FileNotFoundError):
        snapshots.read_newest_file(spark, folder)
    for value in (1, 2):
        frame("v int", [(value,)]).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    assert rows_of(snapshots.read_newest_file(spark, folder)) == [(2,)]


def test_contract_cast(frame):
    df = frame("extra int, importance_pct string, feature_name string", [(1, "12.5", "price")])
    conformed = warehouse.conform(df, "analytics.feature_importances")
    assert conformed.schema == TABLES["analytics.feature_importances"]
    assert rows_of(conformed) == [("price", 12.5)]
    nan = frame("feature_name string, importance_pct double", [("a", float("nan"))])
    assert rows_of(warehouse.conform(nan, "analytics.feature_importances")) == [("a", None)]


def test_overwrite_with_nothing_and_append(spark, frame):
    warehouse.create_tables(spark)
    table, schema = "analytics.feature_importances", "feature_name string, importance_pct double"
    warehouse.overwrite(frame(schema, [("a", 1.0)]), table)
    warehouse.append(frame(schema, [("b", 2.0)]), table)
    assert rows_of(spark.table(table)) == [("a", 1.0), ("b", 2.0)]
    warehouse.overwrite(frame(schema, []), table)
    assert spark.table(table).count() == 0
    assert len(TABLES) == 27
    assert all(spark.catalog.tableExists(name) for name in TABLES)
    for name in TABLES:  # later tests write them with another layout
        spark.sql(f"DROP TABLE {name}")


def test_shared_folder_is_read_from_the_session(spark, tmp_path):
    """The setting is fixed when a session starts, so one is stood in here."""
    settings = {"spark.checkpoint.dir": f"{tmp_path}/"}
    session = SimpleNamespace(conf=settings)
    assert scratch.new_folder(session, "x").startswith(f"{tmp_path}/cartpulse-x-")
    assert "cartpulse-x-" in scratch.new_folder(spark, "x")


def test_free_text_is_written_to_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csvfiles, "ROWS_PER_FILE", 10)
    rows = spark.range(35).selectExpr("cast(id as string) as order_id", "'a\nb' as review_comment_message")
    csvfiles.write_csv(rows.coalesce(1), f"{tmp_path}/order_reviews.csv")
    assert len(list((tmp_path / "order_reviews.csv").glob("*.csv"))) == 4
    found = csvfiles.read_inputs(spark, str(tmp_path)).order_reviews
    assert rows_of(found, "order_id", "review_comment_message") == rows_of(rows)
