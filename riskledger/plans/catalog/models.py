"""Queries: model matrix, learners, ensembles, experiment runs."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.functions.features import take_split
from riskledger.operators import ensembles as N
from riskledger.operators import learners as L
from riskledger.operators import metrics as M
from riskledger.operators import runs as R
from riskledger.operators.matrix import Matrix, fit_matrix, matrix_columns
from riskledger.plans import experiments as P
from riskledger.plans.catalog.base import LEVELS, add, features, model_scores, quoted
from riskledger.plans.review import labelled, metrics_document, score_current, train
from riskledger.sources import stores
from riskledger.sources.models import read_model, write_model
from riskledger.workspace import checkpoints_on, compact, fresh_path, stage_table

# --- model matrix -------------------------------------------------------------------------------


def _claims(spark, folder) -> DataFrame:
    """Feature rows, written once: fitting reads them several times."""
    return stage_table(features(spark, folder), "features")


def _matrix(spark, folder) -> tuple[Matrix, DataFrame]:
    """Matrix fitted on training claims, and all claims."""
    claims = _claims(spark, folder)
    return fit_matrix(take_split(claims, "train")), claims


def _named(frame: DataFrame, digits: int) -> DataFrame:
    return frame.select(K.KEY, *[F.round(F.col(f"`{c}`"), digits).alias(c.replace(" ", "_")) for c in frame.columns if c != K.KEY])


def _coded(claims: DataFrame, matrix: Matrix, keep, digits: int = 5) -> DataFrame:
    wide = matrix_columns(matrix.transform(claims), matrix.names)
    return _named(wide.select(K.KEY, *[F.col(f"`{n}`") for n in matrix.names if keep(n)]), digits)


def _is_level(name: str) -> bool:
    return any(name.startswith(f"{c}_") for c in K.CATEGORIES)


def _levels_sql() -> str:
    return ", ".join(
        f'CASE WHEN {c} = {quoted(level)} THEN 1e0 ELSE 0e0 END AS "{c}_{level.replace(" ", "_")}"'
        for c, levels in LEVELS.items() for level in levels
    )


def _scaled_sql(where: str) -> tuple[str, str]:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in K.MODEL_NUMERIC)
    scaled = ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 5) AS {c}" for c in K.MODEL_NUMERIC)
    return scaled, f"(SELECT {stats} FROM feats WHERE {where}) AS st"


_SCALED, _TRAIN_STATS = _scaled_sql("split = 'train'")


def pp_onehot(spark, folder) -> DataFrame:
    matrix, claims = _matrix(spark, folder)
    return _coded(claims, matrix, _is_level)


def pp_scale(spark, folder) -> DataFrame:
    matrix, claims = _matrix(spark, folder)
    return _coded(claims, matrix, lambda n: not _is_level(n))


def pp_matrix(spark, folder) -> DataFrame:
    """All 53 columns of all claims in order; the extended feature set adds two more in the experiments."""
    matrix, claims = _matrix(spark, folder)
    return _coded(claims, matrix, lambda n: True)


def pp_refit_full(spark, folder) -> DataFrame:
    """Matrix refitted on all history, applied to current claims."""
    claims = _claims(spark, folder)
    matrix = fit_matrix(claims.filter(F.col(K.SPLIT) != "current"))
    return _coded(claims.filter(F.col(K.SPLIT) == "current"), matrix, lambda n: True)


add("pp_onehot", pp_onehot, f"SELECT claim_id, {_levels_sql()} FROM feats")
add("pp_scale", pp_scale, f"SELECT claim_id, {_SCALED} FROM feats CROSS JOIN {_TRAIN_STATS}")
add("pp_matrix", pp_matrix, f"SELECT claim_id, {_levels_sql()}, {_SCALED} FROM feats CROSS JOIN {_TRAIN_STATS}")
_HISTORY_STATS = _scaled_sql("split <> 'current'")[1]
add("pp_refit_full", pp_refit_full, f"SELECT claim_id, {_levels_sql()}, {_SCALED} FROM feats CROSS JOIN {_HISTORY_STATS} WHERE split = 'current'")

# --- learners -----------------------------------------------------------------------------------
# Each query fits on the training claims and scores every validation claim.


def _sides(spark, folder) -> tuple[DataFrame, DataFrame]:
    checkpoints_on(spark)
    matrix, claims = _matrix(spark, folder)
    return tuple(compact(stage_table(labelled(take_split(claims, s), matrix), s)) for s in ("train", "validation"))


def _fitted(fit):
    def run(spark, folder) -> DataFrame:
        train_rows, held = _sides(spark, folder)
        return fit(train_rows, held).score(held).select(K.KEY, "label", "prob")
    return run


def ml_class_weight(spark, folder) -> DataFrame:
    rows = features(spark, folder).filter(F.col(K.TARGET).isNotNull()).withColumnRenamed(K.TARGET, "label")
    return L.class_weights(rows).select("label", "n", F.round("weight", 9).alias("weight"))


add("ml_class_weight", ml_class_weight, """
SELECT is_denied AS label, count(*) AS n, round(sum(count(*)) OVER () / CAST(count(*) OVER () * count(*) AS DOUBLE), 9) AS weight
FROM feats WHERE is_denied IS NOT NULL GROUP BY is_denied""")
add("ml_dummy", _fitted(lambda t, v: L.fit_chance(t)))
add("ml_lr", _fitted(lambda t, v: L.fit_logistic(t, 0.1)))


def ml_lr_sweep(spark, folder) -> DataFrame:
    """Validation average precision of every penalty of the grid, with the chosen one marked."""
    _, best, table = L.sweep_logistic(*_sides(spark, folder))
    return table.withColumn("chosen", F.col("c") == F.lit(best))


add("ml_lr_sweep", ml_lr_sweep)
add("ml_rf", _fitted(lambda t, v: L.fit_forest(t)))
add("ml_xgb", _fitted(lambda t, v: P.boosted_early(t, v)))
add("ml_gbm", _fitted(lambda t, v: L.fit_boosted(t, rounds=200, min_leaf=20)))
add("ml_calibrate_cv", _fitted(lambda t, v: N.calibrate_folds(t, lambda rows: L.fit_logistic(rows, 0.1), 3)))
add("ml_platt", _fitted(lambda t, v: N.calibrate_fitted(L.fit_logistic(t, 0.1), v)))
add("ml_mlp", _fitted(lambda t, v: L.fit_network(t)))
add("ml_svc_rbf", _fitted(lambda t, v: N.calibrate_folds(t, N.one_at_a_time(L.fit_kernel_machine), 3)))
add("ml_voting", _fitted(lambda t, v: P.voting(t)))
add("ml_stacking", _fitted(lambda t, v: P.stacking(t)))


def ml_final_refit(spark, folder) -> DataFrame:
    """The production step: tune, report, refit on all history, score current claims."""
    checkpoints_on(spark)
    claims = _claims(spark, folder)
    history = claims.filter(F.col(K.SPLIT) != "current")
    trained = train(history, grid=K.C_GRID)
    return score_current(claims.filter(F.col(K.SPLIT) == "current"), trained).select(
        K.KEY, "denial_probability", F.array_join("factors", ", ").alias("top_risk_factors")
    )


add("ml_final_refit", ml_final_refit)


def io_write_model(spark, folder) -> DataFrame:
    """Matrix stages and model saved, loaded and applied to current claims."""
    matrix, claims = _matrix(spark, folder)
    model = L.fit_logistic(stage_table(labelled(take_split(claims, "train"), matrix), "train"), 0.1)
    path = fresh_path(spark, "model")
    matrix.stages.write().overwrite().save(f"{path}/matrix")
    model.model.write().overwrite().save(f"{path}/logistic")
    loaded = Matrix(PipelineModel.load(f"{path}/matrix"), matrix.names)
    rows = loaded.transform(claims.filter(F.col(K.SPLIT) == "current")).select(K.KEY, "features")
    return L.Fitted(LogisticRegressionModel.load(f"{path}/logistic")).score(rows).select(K.KEY, "prob")


add("io_write_model", io_write_model)


def io_write_model_kinds(spark, folder) -> DataFrame:
    """Every kind of model written, read back and applied to current claims: rows, and rows whose score changed."""
    matrix, claims = _matrix(spark, folder)
    rows = compact(stage_table(labelled(take_split(claims, "train"), matrix), "train"))
    plain, strong = L.fit_logistic(rows, 0.1), L.fit_logistic(rows, 10.0)
    calibrated = N.calibrate_folds(rows, lambda part: L.fit_logistic(part, 0.1), 3)
    models = {
        "chance": L.fit_chance(rows),
        "logistic": plain,
        "calibrated": calibrated,
        "kernel": N.calibrate_fitted(L.fit_kernel_machine(rows), rows),
        "forest": L.fit_forest(rows, trees=20),
        "boosted": L.fit_boosted(rows, rounds=5),
        "voting": N.Voting([plain, N.Voting([strong, calibrated], [1, 1])], [2, 1]),
        "stacked": N.fit_stacked(rows, [lambda part: L.fit_logistic(part, 0.1), L.fit_chance], 3),
    }
    path = fresh_path(spark, "models")
    write_model(spark, matrix, f"{path}/matrix")
    again = read_model(spark, f"{path}/matrix")
    current = claims.filter(F.col(K.SPLIT) == "current")
    before, after = (stage_table(m.transform(current).select(K.KEY, "features"), "current") for m in (matrix, again))
    pairs = []
    for kind, model in models.items():
        write_model(spark, model, f"{path}/{kind}")
        loaded = read_model(spark, f"{path}/{kind}")
        pair = model.score(before, "a").select(K.KEY, "a").join(loaded.score(after, "b").select(K.KEY, "b"), K.KEY)
        pairs.append(pair.select(F.lit(kind).alias("kind"), (F.abs(F.col("a") - F.col("b")) > 1e-9).alias("changed")))
    return reduce(DataFrame.unionByName, pairs).groupBy("kind").agg(F.count("*").alias("n"), F.count_if("changed").alias("n_changed"))


add("io_write_model_kinds", io_write_model_kinds, """
SELECT kind, n, 0 AS n_changed FROM (SELECT count(*) AS n FROM feats WHERE split = 'current') AS c
CROSS JOIN (SELECT unnest(['chance', 'logistic', 'calibrated', 'kernel', 'forest', 'boosted', 'voting', 'stacked']) AS kind) AS k""")


def ml_folds(spark, folder) -> DataFrame:
    """The five folds of the labelled claims: each claim's fold."""
    claims = features(spark, folder).filter(F.col(K.TARGET).isNotNull())
    return N.with_fold(claims.select(K.KEY, F.col(K.TARGET).alias("label")), 5).withColumnRenamed("_fold", "fold")


add("ml_folds", ml_folds, """SELECT claim_id, is_denied AS label,
  (row_number() OVER (PARTITION BY is_denied ORDER BY md5(claim_id), claim_id) - 1) % 5 AS fold FROM feats WHERE is_denied IS NOT NULL""")

# --- experiment runs ----------------------------------------------------------------------------
# Three simple models, each evaluated on the validation and on the test claims, give six runs.

_METRICS = ("capture_at_25", "roc_auc", "pr_auc", "brier")
_RUN_IDS = {"validation": "20240101_000000_aaaaaa", "test": "20240102_000000_bbbbbb"}


def _runs(spark, folder) -> DataFrame:
    scored = model_scores(spark, folder).filter(F.col(K.SPLIT).isin(*_RUN_IDS))
    found = M.evaluate(scored, by=["model", K.SPLIT])
    run_id = F.when(F.col(K.SPLIT) == "validation", F.lit(_RUN_IDS["validation"])).otherwise(F.lit(_RUN_IDS["test"]))
    return found.select(
        run_id.alias("run_id"),
        F.concat(F.lit("exp_"), "model").alias("experiment_name"),
        F.lit("2024-01-01T00:00:00+00:00").alias("timestamp"),
        F.lit("FINISHED").alias("status"),
        F.create_map(F.lit("split"), F.col(K.SPLIT)).alias("params"),
        R.metrics_map(*_METRICS).alias("metrics"),
        F.create_map(F.lit("source"), F.lit("catalog")).alias("tags"),
        F.lit(None).cast("string").alias("artifact_uri"),
    )


def _stored_runs(spark, folder) -> DataFrame:
    path = fresh_path(spark, "runs")
    stores.append_runs(_runs(spark, folder), path)
    return stores.read_runs(spark, path)


_G = """SELECT model, split, prob, n, pos, sum(n) OVER w AS cum_n, sum(pos) OVER w AS cum_pos, sum(pos) OVER (PARTITION BY model, split) AS p, sum(n) OVER (PARTITION BY model, split) AS total
  FROM (SELECT model, split, prob, count(*) AS n, sum(label) AS pos FROM models WHERE split IN ('validation', 'test') GROUP BY model, split, prob) AS g
  WINDOW w AS (PARTITION BY model, split ORDER BY prob DESC)"""
_RUNS_SQL = f"""SELECT 'exp_' || model AS experiment_name, CASE split WHEN 'validation' THEN '{_RUN_IDS["validation"]}' ELSE '{_RUN_IDS["test"]}' END AS run_id, split,
  round(capture, 4) AS capture_at_25, round(roc_auc, 4) AS roc_auc, round(pr_auc, 4) AS pr_auc, round(brier, 4) AS brier
FROM (SELECT model, split, sum(pos * cum_pos / CAST(cum_n AS DOUBLE)) / max(p) AS pr_auc,
    (sum(pos * (2 * (total - cum_n) + n + 1) / 2e0) - max(p) * (max(p) + 1) / 2e0) / (max(p) * (max(total) - max(p))) AS roc_auc
  FROM ({_G}) AS c GROUP BY model, split) AS a
JOIN (SELECT model, split, sum(label) FILTER (place <= k) / CAST(sum(label) AS DOUBLE) AS capture, avg((prob - label) * (prob - label)) AS brier
  FROM (SELECT *, row_number() OVER (PARTITION BY model, split ORDER BY prob DESC, claim_id) AS place,
    greatest(1, floor(count(*) OVER (PARTITION BY model, split) * 0.25e0)) AS k FROM models WHERE split IN ('validation', 'test')) AS r
  GROUP BY model, split) AS b USING (model, split)"""
_LONG_SQL = " UNION ALL ".join(
    f"SELECT experiment_name, run_id, '{m}' AS metric, {m} AS value FROM ({_RUNS_SQL}) AS r" for m in _METRICS
)


def _wide(runs: DataFrame) -> DataFrame:
    return runs.select("experiment_name", "run_id", "status", F.col("params")["split"].alias("split"), *[F.col("metrics")[m].alias(m) for m in _METRICS])


_WIDE_SQL = f"SELECT experiment_name, run_id, 'FINISHED' AS status, split, {', '.join(_METRICS)} FROM ({_RUNS_SQL}) AS r"
add("io_write_run", lambda spark, folder: _wide(_stored_runs(spark, folder)), _WIDE_SQL)


def io_read_runs(spark, folder) -> DataFrame:
    """Run documents as JSON, one folder per run, read back under a fixed schema; the folder names the experiment."""
    runs, path = stage_table(_runs(spark, folder), "runs"), fresh_path(spark, "run-documents")
    for row in runs.select("experiment_name", "run_id").collect():  # one row a run
        one = (F.col("experiment_name") == row["experiment_name"]) & (F.col("run_id") == row["run_id"])
        stores.write_run_document(runs.filter(one).drop("experiment_name"), path, row["experiment_name"], row["run_id"])
    return _wide(stores.read_run_documents(spark, path))


add("io_read_runs", io_read_runs, _WIDE_SQL)


def _logged(spark, path: str, runs: DataFrame, status: str, at: int) -> None:
    """Events of all ``runs``: a start tells the parameters, an end the figures, a failure its error."""
    nothing = {"params": "map<string,string>", "metrics": "map<string,double>", "tags": "map<string,string>", "artifact_uri": "string"}
    told = {"RUNNING": ("params",), "FINISHED": ("metrics", "tags", "artifact_uri"), "FAILED": ("tags",)}[status]
    fields = [F.col(c) if c in told else F.lit(None).cast(k).alias(c) for c, k in nothing.items()]
    stores.append_events(runs.select("run_id", "experiment_name", "timestamp", F.lit(status).alias("status"), *fields, F.lit(at).cast("long").alias("at")), path)


def ex_log_run(spark, folder) -> DataFrame:
    """All runs start, then all end: their state as the events tell it."""
    runs, path = stage_table(_runs(spark, folder), "runs"), fresh_path(spark, "events")
    _logged(spark, path, runs, "RUNNING", 1)
    _logged(spark, path, runs, "FINISHED", 2)
    return _wide(stores.read_states(spark, path))


add("ex_log_run", ex_log_run, _WIDE_SQL)


def ex_run_states(spark, folder) -> DataFrame:
    """Runs in every state: of the delay model one fails and one ends in its second attempt, those of the gap model start again and do not end."""
    runs, path = stage_table(_runs(spark, folder), "runs"), fresh_path(spark, "events")
    name, split = F.col("experiment_name"), F.col("params")["split"]
    again = (name == "exp_gaps") | ((name == "exp_delay") & (split == "test"))
    _logged(spark, path, runs, "RUNNING", 1)
    _logged(spark, path, runs.filter(name != "exp_delay"), "FINISHED", 2)
    _logged(spark, path, runs.filter(name == "exp_delay"), "FAILED", 3)
    _logged(spark, path, runs.filter(again), "RUNNING", 4)
    _logged(spark, path, runs.filter(again & (name == "exp_delay")), "FINISHED", 5)
    return _wide(stores.read_states(spark, path))


_STATE = """CASE WHEN experiment_name = 'exp_gaps' THEN 'RUNNING' WHEN experiment_name = 'exp_delay' AND split = 'validation' THEN 'FAILED' ELSE 'FINISHED' END"""
add("ex_run_states", ex_run_states, f"""SELECT experiment_name, run_id, split, {_STATE} AS status,
  {", ".join(f"CASE WHEN {_STATE} = 'FINISHED' THEN {m} END AS {m}" for m in _METRICS)} FROM ({_RUNS_SQL}) AS r""")


def ex_list(spark, folder) -> DataFrame:
    runs = _stored_runs(spark, folder)
    return R.list_experiments(runs).withColumn("kind", F.lit("experiment")).withColumnRenamed("experiment_name", "name").unionByName(
        R.list_runs(runs, "exp_card").select(F.lit("run of exp_card").alias("kind"), F.col("run_id").alias("name")))


add("ex_list", ex_list, f"""SELECT DISTINCT 'experiment' AS kind, experiment_name AS name FROM ({_RUNS_SQL}) AS r
UNION ALL SELECT 'run of exp_card', run_id FROM ({_RUNS_SQL}) AS q WHERE experiment_name = 'exp_card'""")
add("ex_compare", lambda spark, folder: R.compare_runs(_stored_runs(spark, folder)), _LONG_SQL)
add("jn_run_matrix", lambda spark, folder: R.run_matrix(_stored_runs(spark, folder), list(_METRICS)),
    f"SELECT experiment_name, run_id, {', '.join(_METRICS)} FROM ({_RUNS_SQL}) AS r")
add("ex_best_per_metric", lambda spark, folder: R.best_per_metric(R.compare_runs(_stored_runs(spark, folder))), f"""
SELECT experiment_name, metric, run_id, value FROM (SELECT *, row_number() OVER (PARTITION BY experiment_name, metric ORDER BY value DESC, run_id) AS place
  FROM ({_LONG_SQL}) AS l) AS p WHERE place = 1""")


def ex_latest_run(spark, folder) -> DataFrame:
    return R.latest_runs(_stored_runs(spark, folder)).select("experiment_name", "run_id", F.col("metrics")["roc_auc"].alias("roc_auc"))


add("ex_latest_run", ex_latest_run, f"""SELECT experiment_name, max(run_id) AS run_id, arg_max(roc_auc, run_id) AS roc_auc FROM ({_RUNS_SQL}) AS r GROUP BY experiment_name""")
add("ex_leaderboard", lambda spark, folder: R.leaderboard(_stored_runs(spark, folder)), f"""
SELECT experiment_name, run_id, capture_at_25, row_number() OVER (ORDER BY capture_at_25 DESC, experiment_name) = 1 AS is_best
FROM (SELECT *, row_number() OVER (PARTITION BY experiment_name ORDER BY run_id DESC) AS age FROM ({_RUNS_SQL}) AS r) AS n WHERE age = 1""")


def ex_suite(spark, folder) -> DataFrame:
    """The ten named experiments at full size: their run rows."""
    checkpoints_on(spark)
    claims = _claims(spark, folder)
    path = fresh_path(spark, "suite")
    runs, _ = P.suite(claims.filter(F.col(K.SPLIT) != "current"), claims.filter(F.col(K.SPLIT) == "current"), path)
    return _wide_suite(runs)


def _wide_suite(runs: DataFrame) -> DataFrame:
    return runs.select("experiment_name", "status", *[F.col("metrics")[m].alias(m) for m in _METRICS])


add("ex_suite", ex_suite)


def sc_experiment_predictions(spark, folder) -> DataFrame:
    """Current claims scored by every experiment and stored under its run."""
    checkpoints_on(spark)
    claims = _claims(spark, folder)
    path = fresh_path(spark, "suite")
    P.suite(claims.filter(F.col(K.SPLIT) != "current"), claims.filter(F.col(K.SPLIT) == "current"), path)
    return spark.read.parquet(f"{path}/predictions").select("experiment_name", K.KEY, "prob")


add("sc_experiment_predictions", sc_experiment_predictions)
