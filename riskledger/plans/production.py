"""One production run: from claims to the stored review list, its audit and its figures, in steps that are kept.

Every step writes its tables and models to a folder that no other attempt uses, and is then entered in a ledger together
with its figures.  A step reads nothing but entered folders, so a run whose driver was lost goes on with the first step
that is not entered; what an unfinished attempt left behind is never read.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from functools import partial, reduce
from typing import Any
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.functions.features import add_features, take_split
from riskledger.operators import attribution as A
from riskledger.operators import learners as L
from riskledger.operators.audit import records
from riskledger.operators.contract import check_inputs, check_outputs, enforce
from riskledger.operators.ensembles import calibrate_folds, side_by_side
from riskledger.operators.explain import CompletionFunction, explain
from riskledger.operators.matrix import fit_matrix
from riskledger.operators.metrics import calibration_gain, evaluate, score_summary, select_model
from riskledger.operators.runs import event
from riskledger.operators.scoring import rank_and_tier
from riskledger.plans.review import figures_document, labelled, publish
from riskledger.sources import stores
from riskledger.sources.models import read_model, write_model
from riskledger.workspace import checkpoints_on, compact

EXPERIMENT = "production"
#: Compared on validation claims, in the order that settles ties after the preferred one; the chance model is only reported.
CANDIDATES = ("LR", "Cal-LR", "RF", "XGB")
DEPLOYED = "Cal-LR"


@dataclass(frozen=True)
class Settings:
    """What a run is made with; an unfinished run goes on only with the settings it was begun with."""

    grid: tuple[float, ...] = K.C_GRID
    eval_folds: int = 3
    final_folds: int = 5
    trees: int = 200
    rounds: int = 300
    completion_model: str = "none"


# --- ledger -------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Entry:
    """A finished step: its folder and its figures."""

    folder: str
    facts: dict[str, Any]


class Ledger:
    """Finished steps of a run, one row each, in ``<root>/ledger``.

    The rows of a step have a folder of their own, so steps that end at the same time do not share a staging folder.  If
    two drivers finished the same step, the earlier entry counts, for both.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def entries(self) -> dict[str, Entry]:
        table = self.spark.read.schema("folder string, facts string, at long, step string")
        try:
            rows = table.parquet(f"{self.root}/ledger").collect()  # one row a step
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        first: dict[str, Entry] = {}
        for row in sorted(rows, key=lambda r: (r["at"], r["folder"])):
            first.setdefault(row["step"], Entry(row["folder"], json.loads(row["facts"])))
        return first

    def enter(self, step: str, folder: str, facts: dict[str, Any]) -> Entry:
        row = [(folder, json.dumps(facts), time.time_ns() // 1000)]
        frame = self.spark.createDataFrame(row, "folder string, facts string, at long").coalesce(1)
        frame.write.mode("append").parquet(f"{self.root}/ledger/step={step}")
        return self.entries()[step]


# --- steps --------------------------------------------------------------------------------------

@dataclass
class Run:
    """One attempt at a run.  A step takes the folder to write to and returns its figures."""

    spark: SparkSession
    root: str
    run_id: str
    history: DataFrame
    current: DataFrame
    settings: Settings = Settings()
    completion: CompletionFunction | None = None
    after: Callable[[str], None] | None = None
    done: dict[str, Entry] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.ledger = Ledger(self.spark, self.root)

    def table(self, step: str, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.done[step].folder}/{name}")

    def model(self, step: str, name: str) -> Any:
        return read_model(self.spark, f"{self.done[step].folder}/{name}")

    def step(self, name: str, work: Callable[[str], dict[str, Any]]) -> None:
        """Does ``work`` unless the ledger has it."""
        if name not in self.done:
            folder = f"{self.ledger.root}/steps/{name}-{uuid4().hex[:12]}"
            self.done[name] = self.ledger.enter(name, folder, work(folder))
            if self.after:
                self.after(name)

    def go(self) -> dict[str, Entry]:
        """All steps, in order; candidates that do not need each other are fitted side by side."""
        self.done = self.ledger.entries()
        self.step("settings", lambda _: {"run_id": self.run_id, **asdict(self.settings)})
        begun = self.done["settings"].facts
        if begun != json.loads(json.dumps({"run_id": self.run_id, **asdict(self.settings)})):
            raise ValueError(f"{self.root} holds a run with other settings: {begun}")
        self.step("claims", self.claims)
        self.step("rows", self.rows)
        fits = {"chance": self.fit_chance, "LR": self.fit_plain, "RF": self.fit_forest, "XGB": self.fit_boosted}
        side_by_side([partial(self.step, name, partial(self.candidate, fit)) for name, fit in fits.items()])
        self.step("Cal-LR", partial(self.candidate, self.fit_calibrated))
        for name in ("comparison", "test", "refit", "ranked", "explained", "audit", "scored", "metrics"):
            self.step(name, getattr(self, name))
        return self.done

    def claims(self, out: str) -> dict[str, Any]:
        """Checked claims with their features; all later steps see these, also if the sources change."""
        for name, claims in (("history", self.history), ("current", self.current)):
            add_features(claims).write.parquet(f"{out}/{name}")
        history, current = (self.spark.read.parquet(f"{out}/{n}") for n in ("history", "current"))
        enforce(check_inputs(history, current, None, None))
        return {"history": history.count(), "current": current.count()}

    def rows(self, out: str) -> dict[str, Any]:
        """Matrix fitted on training claims, and the rows of every split in it."""
        history = self.table("claims", "history")
        matrix = fit_matrix(take_split(history, "train"))
        write_model(self.spark, matrix, f"{out}/matrix")
        for split in K.SPLITS:
            labelled(take_split(history, split), matrix).write.parquet(f"{out}/{split}")
        return {"features": len(matrix.names)}

    def candidate(self, fit: Callable[[DataFrame], tuple[Any, dict[str, Any]]], out: str) -> dict[str, Any]:
        """A model, fitted on training claims and written, and its scores of the validation claims."""
        model, facts = fit(compact(self.table("rows", "train")))
        write_model(self.spark, model, f"{out}/model")
        scored = model.score(self.table("rows", "validation"), "prob")
        scored.select(K.KEY, "label", "prob").write.parquet(f"{out}/validation")
        return facts

    def fit_chance(self, rows: DataFrame) -> tuple[Any, dict[str, Any]]:
        return L.fit_chance(rows), {}

    def fit_plain(self, rows: DataFrame) -> tuple[Any, dict[str, Any]]:
        model, c, _ = L.sweep_logistic(rows, self.table("rows", "validation"), self.settings.grid)
        return model, {"C": c}

    def fit_forest(self, rows: DataFrame) -> tuple[Any, dict[str, Any]]:
        return L.fit_forest(rows, trees=self.settings.trees), {"trees": self.settings.trees}

    def fit_boosted(self, rows: DataFrame) -> tuple[Any, dict[str, Any]]:
        held = compact(self.table("rows", "validation"))
        # Depth, share of columns and weight of the positive class.
        model = L.fit_boosted_early(
            rows, held, rounds=self.settings.rounds, depth=6, column_share=0.8, positive_weight=3.6
        )
        return model, {"rounds": model.model.getNumTrees}

    def fit_calibrated(self, rows: DataFrame) -> tuple[Any, dict[str, Any]]:
        return calibrate_folds(rows, self.chosen_fit(), self.settings.eval_folds), {"C": self.best_c}

    @property
    def best_c(self) -> float:
        return self.done["LR"].facts["C"]

    def chosen_fit(self) -> Callable[[DataFrame], L.Fitted]:
        return partial(L.fit_logistic, c=self.best_c)

    def comparison(self, out: str) -> dict[str, Any]:
        """Captures of all models on validation claims, the best of them, and the threshold of the deployed one.

        The calibrated model is deployed whichever is best, as its scores are read as probabilities.
        """
        scored = [self.table(m, "validation").withColumn("model", F.lit(m)) for m in ("chance", *CANDIDATES)]
        score_summary(reduce(DataFrame.unionByName, scored)).write.parquet(f"{out}/models")
        models = self.spark.read.parquet(f"{out}/models")
        place = F.array_position(F.array(*[F.lit(m) for m in CANDIDATES]), F.col("model"))
        ranked = models.filter(place > 0).select("model", F.col("capture_at_k").alias("capture"), place.alias("position"))
        best = select_model(ranked, preferred=DEPLOYED).first()
        figures = {r["model"]: r for r in models.collect()}  # one row a model
        before, after = (self.table(m, "validation") for m in ("LR", DEPLOYED))
        both = after.join(before.select(K.KEY, F.col("prob").alias("raw")), K.KEY)
        return {
            "best_model": best["best_model"],
            "captures": {m: r["capture_at_k"] for m, r in figures.items()},
            "threshold": figures[DEPLOYED]["binary_threshold"],
            **calibration_gain(both, "raw", "prob").first().asDict(),
        }

    def test(self, out: str) -> dict[str, Any]:
        """The deployed model on test claims, at the threshold frozen on validation claims."""
        scored = self.model(DEPLOYED, "model").score(self.table("rows", "test"), "prob").select(K.KEY, "label", "prob")
        threshold = self.done["comparison"].facts["threshold"]
        return evaluate(scored, by=[], binary_threshold=threshold).first().asDict()

    def refit(self, out: str) -> dict[str, Any]:
        """Matrix, plain model (for factors) and calibrated model (for probabilities) of all labelled claims."""
        history = self.table("claims", "history")
        matrix = fit_matrix(history)
        labelled(history, matrix).write.parquet(f"{out}/rows")
        rows = compact(self.spark.read.parquet(f"{out}/rows"))
        fit = self.chosen_fit()
        models = {"matrix": matrix, "plain": fit(rows), "calibrated": calibrate_folds(rows, fit, self.settings.final_folds)}
        for name, model in models.items():
            write_model(self.spark, model, f"{out}/{name}")
        return {"features": len(matrix.names)}

    def ranked(self, out: str) -> dict[str, Any]:
        """Current claims with probability, factors, rank, prediction and tier."""
        matrix, plain, calibrated = (self.model("refit", n) for n in ("matrix", "plain", "calibrated"))
        rows = matrix.transform(self.table("claims", "current")).select(K.KEY, "features")
        scored = calibrated.score(rows, "denial_probability")
        weights = A.contributions(F.col("features"), plain.model.coefficients.toArray().tolist())
        factors = A.ordered_factors(F.col("denial_probability"), weights, matrix.names)
        narrow = scored.select(K.KEY, "denial_probability", factors.alias("factors"))
        rank_and_tier(narrow, self.done["comparison"].facts["threshold"]).write.parquet(f"{out}/claims")
        tiers = self.spark.read.parquet(f"{out}/claims").groupBy("risk_tier").count().collect()
        return {"tiers": {r["risk_tier"]: r["count"] for r in tiers}}

    def explained(self, out: str) -> dict[str, Any]:
        """Explanations with all that an audit needs, written once: the list and the audit tell of the same calls."""
        explain(self.table("ranked", "claims"), completion=self.completion).write.parquet(f"{out}/claims")
        return {}

    def audit(self, out: str) -> dict[str, Any]:
        log = records(self.table("explained", "claims"), self.settings.completion_model)
        stores.write_audit(log, out, self.run_id)
        return {"records": stores.read_audit(self.spark, out).count()}

    def scored(self, out: str) -> dict[str, Any]:
        """The published list, checked as it is stored."""
        stores.write_scored(publish(self.table("explained", "claims")), f"{out}/claims")
        n = self.done["claims"].facts["current"]
        high, medium = int(n * K.REVIEW_CAPACITY), int(n * 0.25)
        tiers = {"High": high, "Medium": medium, "Low": n - high - medium}
        enforce(check_outputs(self.spark.read.parquet(f"{out}/claims"), expected_rows=n, expected_tiers=tiers))
        return {"rows": n}

    def metrics(self, out: str) -> dict[str, Any]:
        compared = self.done["comparison"].facts
        document = figures_document(
            {**self.done["test"].facts, **compared}, self.best_c, compared["threshold"],
            self.done["ranked"].facts["tiers"].get("High", 0), self.settings.completion_model,
        )
        stores.write_metrics(self.spark.createDataFrame([document], ", ".join(_typed(document))).coalesce(1), f"{out}/document")
        return document


def _typed(document: dict[str, Any]) -> list[str]:
    kinds = {str: "string", int: "long", float: "double"}
    return [f"{name} {kinds.get(type(value), 'double')}" for name, value in document.items()]


def produce(
    history: DataFrame,
    current: DataFrame,
    root: str,
    run_id: str,
    settings: Settings = Settings(),
    completion: CompletionFunction | None = None,
    after: Callable[[str], None] | None = None,
) -> dict[str, Entry]:
    """Does the run ``run_id`` in the shared folder ``root``, or what is left of it, and returns its finished steps.

    ``after`` is called with the name of each step as it is entered.  Every attempt is told to ``<root>/events``: RUNNING
    as it begins, then FINISHED with the figures, or FAILED with the error; a lost driver leaves RUNNING.
    """
    spark = history.sparkSession
    checkpoints_on(spark)
    run = Run(spark, root, run_id, history, current, settings, completion, after)
    started = datetime.now(timezone.utc).isoformat()

    def tell(status: str, **known: Any) -> None:
        step = event(spark, EXPERIMENT, run_id, started, status, time.time_ns() // 1000, **known)
        stores.append_events(step, f"{run.ledger.root}/events")

    tell("RUNNING", params=asdict(settings))
    try:
        done = run.go()
    except Exception as error:
        tell("FAILED", tags={"error": str(error)})
        raise
    figures = {k: v for k, v in done["metrics"].facts.items() if isinstance(v, (int, float))}
    tell("FINISHED", metrics=figures, artifact_uri=run.ledger.root)
    return done
