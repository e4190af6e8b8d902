"""Cases that once gave wrong rows or none."""

from __future__ import annotations

import sys

import pytest

from cartpulse.operators import fact
from cartpulse.plans import catalogue
from cartpulse.sources import csvfiles, testtables
from tests.conftest import SMALL, rows_of


def test_twins_need_no_installation_files(monkeypatch):
    from pathlib import Path

    monkeypatch.setattr(Path, "glob", lambda *a: iter(()))
    monkeypatch.delitem(sys.modules, "verification.stopwords", raising=False)
    from verification.query_twins import all_sql

    assert len(all_sql()) > 90


def test_trend_stream_over_a_folder_of_parts(spark, tmp_path):
    events = testtables.table(spark, SMALL, "events")
    events.repartition(3).write.parquet(f"{tmp_path}/many/events.parquet")
    events.limit(0).write.parquet(f"{tmp_path}/none/events.parquet")
    stream = catalogue.all_queries()["stream_category_trend"]
    assert rows_of(stream(spark, f"{tmp_path}/many")) == rows_of(stream(spark, SMALL))
    assert rows_of(stream(spark, f"{tmp_path}/none")) == []


def test_files_with_different_headers_are_not_misread(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.csv").write_text("seller_id,seller_city\ns1,Rome\n")
    (tmp_path / "s" / "b.csv").write_text("seller_city,seller_id\nOslo,s2\n")
    read = csvfiles.read_csv(spark, str(tmp_path / "s"), "seller_id string, seller_city string")
    with pytest.raises(Exception, match="(?i)header"):
        read.collect()


def test_payments_without_a_number_keep_their_type(frame):
    schema = (
        "order_id string, payment_sequential int, payment_type string,"
        " payment_installments int, payment_value double"
    )
    rows = [("o", None, "voucher", 1, 2.0), ("o", None, "boleto", 3, 1.0), ("p", None, None, 1, 1.0),
            ("q", 2, "boleto", 1, 1.0), ("q", None, "a", 1, 1.0)]
    got = fact.payments_per_order(frame(schema, rows))
    assert rows_of(got, "order_id", "payment_type") == [("o", "boleto"), ("p", None), ("q", "boleto")]


def test_scores_read_no_documents(spark):
    plan = catalogue.all_queries()["q1_4"](spark, SMALL)._jdf.queryExecution().optimizedPlan()
    assert "documents" not in plan.toString() and "text#" not in plan.toString()
