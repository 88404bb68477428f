import json

import pytest

from riskledger.operators import runs as R
from riskledger.sources import stores


def table(spark):
    make = lambda name, run, **m: R.run_row(spark, name, run, "2024-01-01", metrics=m, params={"C": 0.1})
    return (
        make("a", "20240101_1", capture_at_25=0.4, brier=0.2)
        .union(make("a", "20240102_2", capture_at_25=0.4, brier=0.1))
        .union(make("b", "20240101_3", denial_capture_at_25=0.5, brier=0.3))
        .union(R.run_row(spark, "c", "20240101_4", "2024-01-01", status="FAILED", tags={"error": "boom"}))
    )


def test_stored_runs(spark, tmp_path):
    path = str(tmp_path / "runs")
    stores.append_runs(table(spark), path)
    runs = stores.read_runs(spark, path)
    assert {r.experiment_name for r in R.list_experiments(runs).collect()} == {"a", "b", "c"}
    assert [r.run_id for r in R.list_runs(runs, "a").collect()] == ["20240101_1", "20240102_2"]
    assert runs.filter("status = 'FAILED'").first().tags == {"error": "boom"}


def test_best_per_metric_and_direction(spark):
    long = R.compare_runs(table(spark)).filter("experiment_name = 'a'")
    best = {r.metric: (r.run_id, r.value) for r in R.best_per_metric(long).collect()}
    assert best == {"capture_at_25": ("20240101_1", 0.4), "brier": ("20240101_1", 0.2)}
    turned = {r.metric: r.run_id for r in R.best_per_metric(long, lower_is_better=("brier",)).collect()}
    assert turned == {"capture_at_25": "20240101_1", "brier": "20240102_2"}


def test_leaderboard(spark):
    board = [(r.experiment_name, r.run_id, r.capture_at_25, r.is_best) for r in R.leaderboard(table(spark)).collect()]
    assert board == [("b", "20240101_3", 0.5, True), ("a", "20240102_2", 0.4, False), ("c", "20240101_4", 0.0, False)]


def test_run_documents(spark, tmp_path):
    for name, run in (("e1", "r1"), ("e2", "r2")):
        target = tmp_path / name / run
        target.mkdir(parents=True)
        document = {"run_id": run, "params": {"C": 0.1}, "metrics": {"roc_auc": 0.7}, "status": "FINISHED"}
        (target / "run_metadata.json").write_text(json.dumps(document, indent=2))
    got = {(r.experiment_name, r.run_id, r.metrics["roc_auc"], r.params["C"]) for r in stores.read_run_documents(spark, str(tmp_path)).collect()}
    assert got == {("e1", "r1", 0.7, "0.1"), ("e2", "r2", 0.7, "0.1")}


def test_states_of_runs(spark, tmp_path):
    """A dead driver leaves RUNNING, an attempt forgets the one before it, and repeated events count once."""
    from riskledger.sources import stores

    path = str(tmp_path / "events")

    def tell(run, status, at, **known):
        stores.append_events(R.event(spark, "e", run, "t", status, at, **known), path)

    tell("dead", "RUNNING", 1, params={"C": 1})
    tell("done", "RUNNING", 1, params={"C": 2})
    tell("done", "FINISHED", 5, metrics={"auc": 0.5}, artifact_uri="there")
    tell("done", "FINISHED", 5, metrics={"auc": 0.5}, artifact_uri="there")
    tell("broken", "RUNNING", 2, params={"C": 3})
    tell("broken", "FAILED", 2, tags={"error": "x"})
    tell("again", "RUNNING", 1, params={"C": 4})
    tell("again", "FINISHED", 2, metrics={"auc": 0.9})
    tell("again", "RUNNING", 3)
    tell("late", "FINISHED", 4, metrics={"auc": 0.1})  # its start was not written
    got = {r["run_id"]: r for r in stores.read_states(spark, path).collect()}
    assert {k: r["status"] for k, r in got.items()} == {"dead": "RUNNING", "done": "FINISHED", "broken": "FAILED", "again": "RUNNING", "late": "FINISHED"}
    assert got["done"]["params"] == {"C": "2"} and got["done"]["metrics"] == {"auc": 0.5} and got["done"]["artifact_uri"] == "there"
    assert got["broken"]["tags"] == {"error": "x"} and got["broken"]["params"] == {"C": "3"}
    assert got["again"]["metrics"] == {} and got["again"]["params"] == {} and got["dead"]["tags"] == {}
    with pytest.raises(ValueError):
        R.event(spark, "e", "r", "t", "DONE", 1)
