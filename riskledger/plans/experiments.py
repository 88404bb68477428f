"""The model experiments: ten named configurations on one shared matrix."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from concurrent.futures import Future
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial, reduce
from threading import Lock
from typing import Any
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.functions.features import add_interactions, take_split
from riskledger.operators import ensembles as N
from riskledger.operators import learners as L
from riskledger.operators.matrix import Matrix, fit_matrix
from riskledger.operators.metrics import evaluate
from riskledger.operators.runs import event, run_row
from riskledger.plans.review import labelled
from riskledger.sources import stores
from riskledger.sources.models import write_model
from riskledger.workspace import compact, stage_table

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Sizes:
    """How large the iterative members are; the defaults are the published configuration."""

    trees: int = 200
    rounds: int = 200
    boosted_rounds: int | None = None
    network_steps: int = 500
    folds: int = 5

    @property
    def early_rounds(self) -> int:
        return self.boosted_rounds or self.rounds * 3 // 2


FULL = Sizes()


def boosted_early(rows: DataFrame, validation: DataFrame, rounds: int = 300) -> L.Fitted:
    """Boosted trees with row and column sampling that stop once validation rows no longer improve."""
    return L.fit_boosted_early(
        rows, validation, rounds=rounds, depth=6, row_share=0.8, column_share=0.8, positive_weight=3.6
    )


def _logistic(rows: DataFrame) -> L.Fitted:
    return L.fit_logistic(rows, 0.1)


def _forest(sizes: Sizes) -> Callable[[DataFrame], L.Fitted]:
    return N.one_of_few(lambda rows: L.fit_forest(rows, trees=sizes.trees, min_leaf=1))


@dataclass
class Members:
    """The three base models of both ensembles, each fitted once per training set and shared.

    A model is fitted by who asks for it first, with no lock on the others; those who ask later wait for it.  Boosted models
    share their passes: the first one asked for is fitted together with all of ``plan``, among them those of the folds (by
    number) and the experiments' own.
    """

    sizes: Sizes
    plan: Sequence[str | int] = ()
    _held: dict[tuple[str | int, int], tuple[DataFrame, Future]] = field(default_factory=dict)
    _lock: Lock = field(default_factory=Lock)

    def fits(self) -> dict[str, Callable[[DataFrame], L.Fitted]]:
        return {"logistic": _logistic, "forest": _forest(self.sizes), "boosted": partial(self.boosted, "boosted")}

    def _kept(self, names: Sequence[str | int], rows: DataFrame, make: Callable[[Sequence[str | int]], Sequence[Any]]) -> Any:
        """The first of some models; whoever comes first makes all of them that nobody has asked for."""
        with self._lock:
            mine = [] if (names[0], id(rows)) in self._held else [n for n in names if (n, id(rows)) not in self._held]
            for name in mine:
                self._held[name, id(rows)] = (rows, Future())
            future = self._held[names[0], id(rows)][1]
        if mine:
            try:
                for name, made in zip(mine, make(mine)):
                    self._held[name, id(rows)][1].set_result(made)
            except BaseException as error:
                for name in mine:
                    self._held[name, id(rows)][1].set_exception(error)
                raise
        return future.result()

    def one(self, name: str, rows: DataFrame) -> L.Fitted:
        if name == "boosted":
            return self.boosted(name, rows)
        return self._kept([name], rows, lambda _: [self.fits()[name](rows)])

    def marked(self, rows: DataFrame) -> DataFrame:
        """The rows with their folds."""
        return self._kept(["marked"], rows, lambda _: [compact(N.with_fold(rows, self.sizes.folds))])

    def boosting(self, name: str | int) -> L.Boosting:
        if name == "exp3":
            return L.boosting(3.6, rounds=self.sizes.early_rounds, depth=6, row_share=1.0)
        if name == "exp6":
            return L.boosting(rounds=self.sizes.rounds, min_leaf=20)
        return L.boosting(rounds=self.sizes.rounds, without=name if isinstance(name, int) else None)

    def boosted(self, name: str | int, rows: DataFrame) -> L.Fitted:
        """A boosted model of the rows, or of those outside of a fold."""

        def make(names: Sequence[str | int]) -> list[L.Fitted]:
            frame = self.marked(rows) if any(isinstance(n, int) for n in names) else rows
            return L.fit_boosted_together(frame, [self.boosting(n) for n in names])

        try:
            return self._kept([name, *[n for n in self.plan if n != name]], rows, make)
        except Exception:  # noqa: BLE001 - another model of the plan may be what failed
            if len(self.plan) < 2:
                raise
            return make([name])[0]

    def of(self, rows: DataFrame) -> tuple[L.Fitted, ...]:
        return tuple(N.side_by_side([partial(self.one, name, rows) for name in self.fits()]))


def voting(rows: DataFrame, sizes: Sizes = FULL, members: Members | None = None) -> N.Voting:
    return N.Voting((members or Members(sizes)).of(rows), (2, 1, 1))


def stacking(rows: DataFrame, sizes: Sizes = FULL, members: Members | None = None) -> N.Stacked:
    shared = members or Members(sizes, ("boosted", *range(sizes.folds)))
    fits = shared.fits()
    fits["boosted"] = N.ByFolds(fits["boosted"], lambda _: [shared.boosted(fold, rows) for fold in range(sizes.folds)])
    return N.fit_stacked(rows, list(fits.values()), sizes.folds, members=lambda: shared.of(rows), marked=shared.marked(rows))


#: The boosted models of the experiments.
BOOSTED = {"exp3_xgb_tuned": ("exp3",), "exp6_gradient_boosting": ("exp6",), "exp7_voting_ensemble": ("boosted",), "exp8_stacking": ("boosted",)}


def configurations(sizes: Sizes = FULL, only: Sequence[str] | None = None) -> dict[str, tuple[Callable[[DataFrame], Any], dict[str, Any]]]:
    """Name -> (fit, recorded parameters), in order, of all experiments or some."""
    wanted = [n for n in BOOSTED if only is None or n in only]
    folds = range(sizes.folds) if "exp8_stacking" in wanted else ()
    shared = Members(sizes, (*dict.fromkeys(model for n in wanted for model in BOOSTED[n]), *folds))
    # Experiment names and recorded parameters.
    found = {
        "exp1_lr_baseline": (lambda rows: shared.one("logistic", rows), {"C": 0.1, "class_weight": "balanced", "type": "LR"}),
        "exp2_lr_calibrated": (
            lambda rows: N.calibrate_folds(rows, _logistic, sizes.folds),
            {"C": 0.1, "calibration": "sigmoid", "type": "LR-Calib"},
        ),
        "exp3_xgb_tuned": (lambda rows: shared.boosted("exp3", rows), {"max_depth": 6, "lr": 0.05, "scale_pos_weight": 3.6, "type": "XGB"}),
        "exp4_rf_robust": (lambda rows: shared.one("forest", rows), {"n_estimators": sizes.trees, "max_depth": 12, "type": "RF"}),
        "exp5_lr_interactions": (_logistic, {"C": 0.1, "feature_set": "interactions", "type": "LR"}),
        "exp6_gradient_boosting": (
            lambda rows: shared.boosted("exp6", rows),
            {"n_estimators": sizes.rounds, "max_depth": 5, "lr": 0.05, "subsample": 0.8, "type": "GBM"},
        ),
        "exp7_voting_ensemble": (
            lambda rows: voting(rows, sizes, shared),
            {"voting": "soft", "weights": "[2, 1, 1]", "estimators": "LR+RF+GBM", "type": "Voting"},
        ),
        "exp8_stacking": (
            lambda rows: stacking(rows, sizes, shared),
            {"cv": sizes.folds, "passthrough": True, "meta": "LR", "estimators": "LR+RF+GBM", "type": "Stacking"},
        ),
        "exp9_mlp_neural": (
            lambda rows: L.fit_network(rows, max_iter=sizes.network_steps),
            {"hidden": "(64,32)", "activation": "sigmoid", "type": "MLP"},
        ),
        "exp10_svc_rbf": (
            lambda rows: N.calibrate_folds(rows, N.one_at_a_time(L.fit_kernel_machine), 3),
            {"kernel": "rbf", "C": 1.0, "calibration": "sigmoid", "type": "SVC-Calib"},
        ),
    }
    return {name: how for name, how in found.items() if only is None or name in only}


def _new_run_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_") + uuid4().hex[:6]


@dataclass
class Inputs:
    """Written matrices of one feature set."""

    train: DataFrame
    validation: DataFrame
    current: DataFrame
    matrix: Matrix


def _inputs(history: DataFrame, current: DataFrame, numbers: Sequence[str]) -> Inputs:
    matrix = fit_matrix(take_split(history, "train"), numbers=numbers)
    sides = [compact(stage_table(labelled(take_split(history, s), matrix), s)) for s in ("train", "validation")]
    rows = stage_table(matrix.transform(current).select(K.KEY, "features"), "current")
    return Inputs(*sides, rows, matrix)


def suite(
    history: DataFrame,
    current: DataFrame,
    path: str,
    sizes: Sizes = FULL,
    only: Sequence[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Run the experiments; a failing one is recorded and does not stop the others.

    ``history`` and ``current`` hold features.  A RUNNING event goes to ``<path>/events`` as an experiment starts and
    a FINISHED or FAILED one as it ends, so a lost driver leaves its runs RUNNING.  Run rows go to ``<path>/runs``,
    models with their matrix to ``<path>/models`` and the scores of the current claims to ``<path>/predictions``, each
    as soon as it is there; then the model is let go.  Returns the run rows and the run ids.  The
    matrices are written once and shared by all experiments of a feature set; experiments run side by side.
    """
    spark = history.sparkSession
    plain = _inputs(history, current, K.MODEL_NUMERIC)
    writing = Lock()  # appends to one folder share a staging folder, so one at a time

    def one(name: str, fit: Callable[[DataFrame], Any], params: dict[str, Any]) -> tuple[DataFrame, str]:
        run_id, started = _new_run_id(), datetime.now(timezone.utc).isoformat()

        def tell(status: str, **known: Any) -> None:
            step = event(spark, name, run_id, started, status, time.time_ns() // 1000, **known)
            with writing:
                stores.append_events(step, f"{path}/events")

        tell("RUNNING", params=params)
        try:
            data = plain
            if name == "exp5_lr_interactions":
                data = _inputs(add_interactions(history), add_interactions(current), [*K.MODEL_NUMERIC, *K.INTERACTIONS])
            model = fit(data.train)
            write_model(spark, data.matrix, f"{path}/models/{run_id}/matrix")
            write_model(spark, model, f"{path}/models/{run_id}/model")
            figures = evaluate(model.score(data.validation), by=[]).first().asDict()
            metrics = {m: figures[m] for m in ("capture_at_25", "roc_auc", "pr_auc", "brier")}
            scored = model.score(data.current).select(
                K.KEY, "prob", F.lit(name).alias("experiment_name"), F.lit(run_id).alias("run_id")
            )
            with writing:
                stores.append_predictions(scored, f"{path}/predictions")
            tags, place = {"features": ",".join(data.matrix.names)}, f"{path}/models/{run_id}"
            row = run_row(spark, name, run_id, started, "FINISHED", params, metrics, tags, place)
            tell("FINISHED", metrics=metrics, tags=tags, artifact_uri=place)
        except Exception as error:  # noqa: BLE001 - recorded, the next experiment still runs
            log.warning("experiment %s failed: %s", name, error)
            row = run_row(spark, name, run_id, started, "FAILED", params, None, {"error": str(error)})
            tell("FAILED", tags={"error": str(error)})
        with writing:
            stores.append_runs(row, f"{path}/runs")
        return row, run_id

    wanted = [(n, *how) for n, how in configurations(sizes, only).items()]
    done = N.side_by_side([partial(one, *how) for how in wanted])
    return reduce(DataFrame.unionByName, [row for row, _ in done]), [run_id for _, run_id in done]
