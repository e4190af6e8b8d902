from __future__ import annotations

from cartpulse.llm import lines


def test_line_runs_start_no_python_workers(spark, frame):
    runs = lines.LineRuns(spark, min_docs=2)
    assert runs.settled().count() == 0
    rows = [(b"a", 0, 1), (b"a", 0, 2), (b"b", 0, 1)]
    for _ in range(2):
        runs.add(frame("key binary, batch int, doc_id bigint", rows))
    found = runs.frequent()
    # a local list is an RDD that Python workers read
    assert "ExistingRDD" not in found._jdf.queryExecution().toString()
    # settled by the first batch
    assert {(bytes(r["key"]), r["n_docs"]) for r in found.collect()} == {(b"a", 2), (b"b", 2)}
