from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.functions.features import add_features
from riskledger.operators.contract import check_outputs
from riskledger.operators.scoring import rank_and_tier, top_rows
from riskledger.plans import experiments as P
from riskledger.plans.pinned import SCORECARD
from riskledger.plans.review import metrics_document, publish, review_list, score_current, score_with_card, train
from riskledger.sources.orders import current_claims, history_claims
from riskledger.streaming.review import explained_stream, store_stream
from riskledger.workspace import stage_table


def test_review_list_meets_its_contract(spark, folder):
    current = current_claims(spark, folder)
    n = current.count()
    done = publish(review_list(current, SCORECARD, 0.3))
    tiers = {"High": n // 4, "Medium": n // 4, "Low": n - 2 * (n // 4)}
    failed = check_outputs(done, expected_rows=n, expected_tiers=tiers).filter("not passed").collect()
    assert failed == []


def test_tiers_of_five_hundred(spark):
    rows = spark.range(500).select(F.format_string("C%03d", "id").alias("claim_id"), F.lit(0.5).alias("denial_probability"))
    tiered = rank_and_tier(rows, 0.5)
    counts = {r.risk_tier: r["count"] for r in tiered.groupBy("risk_tier").count().collect()}
    assert counts == K.EXPECTED_TIER_ROWS
    assert tiered.filter("rank = 125").first().claim_id == "C124"
    assert [r.claim_id for r in top_rows(rows, 3).collect()] == ["C000", "C001", "C002"]


def test_small_top_k_does_not_sort_everything(spark, folder):
    plan = top_rows(score_with_card(current_claims(spark, folder), SCORECARD))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_scan_reads_only_needed_columns(spark, folder):
    plan = score_with_card(current_claims(spark, folder), SCORECARD)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "o_comment" not in plan and "PythonUDF" not in plan
    assert "(o_orderstatus" in plan and "PushedFilters" in plan


def test_training_run(spark, folder):
    history = stage_table(history_claims(spark, folder), "history")
    trained = train(history, grid=(0.1,), eval_folds=2, final_folds=2)
    document = metrics_document(trained, 123, "none")
    assert document["best_C"] == 0.1 and 0.5 < document["test_roc_auc"] <= 1
    assert document["brier_post_calibration"] < document["brier_pre_calibration"]
    current = current_claims(spark, folder)
    scored = score_current(current, trained)
    assert scored.count() == current.count()
    assert scored.filter("denial_probability < 0.25 and factors[0] <> '%s'" % K.NO_FLAGS).count() == 0
    assert len(trained.matrix.names) == 53


def test_a_failing_experiment_does_not_stop_the_suite(spark, folder, tmp_path, monkeypatch):
    def broken(*_args, **_kwargs):
        raise ValueError("broken learner")

    monkeypatch.setattr(P.L, "fit_forest", broken)
    history = add_features(history_claims(spark, folder))
    current = add_features(current_claims(spark, folder))
    names = ("exp1_lr_baseline", "exp4_rf_robust", "exp5_lr_interactions")
    runs, ids = P.suite(history, current, str(tmp_path), only=names)
    got = {r.experiment_name: r for r in runs.collect()}
    assert {n: r.status for n, r in got.items()} == {names[0]: "FINISHED", names[1]: "FAILED", names[2]: "FINISHED"}
    assert "broken learner" in got[names[1]].tags["error"]
    assert got[names[2]].tags["features"].count(",") == 54
    stored = spark.read.parquet(f"{tmp_path}/predictions")
    assert stored.count() == 2 * current.count() and len(set(ids)) == 3


def test_stream_equals_batch(spark, folder, tmp_path):
    claims = current_claims(spark, folder)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    claims.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(claims.schema).option("maxFilesPerTrigger", 1).parquet(source)
    store_stream(explained_stream(stream, SCORECARD, 0.3), target, str(tmp_path / "cp")).awaitTermination(120)
    got, want = spark.read.parquet(target), explained_stream(claims, SCORECARD, 0.3)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
