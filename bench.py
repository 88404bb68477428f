"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from riskledger import constants as K  # noqa: E402
from riskledger.functions.features import take_split  # noqa: E402
from riskledger.operators import ensembles as N  # noqa: E402
from riskledger.operators import learners as L  # noqa: E402
from riskledger.operators.matrix import fit_matrix  # noqa: E402
from riskledger.plans.catalog import QUERIES  # noqa: E402
from riskledger.plans.catalog.base import features  # noqa: E402
from riskledger.plans.review import labelled  # noqa: E402
from riskledger.workspace import checkpoints_on, local_session, stage_table  # noqa: E402

HEADLINE = (
    "pj_drop_leakage",  # contract-free feature table
    "dq_unique_key",
    "dq_key_overlap",
    "sc_score",
    "sc_tier_rank",
    "mt_evaluate",
    "rf_string_pipe",
    "xp_plain_text",
    "xp_parse",
    "xp_generate",
    "au_quality",
    "au_quality_summary",
    "ex_leaderboard",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, partitions=int(cores), memory=os.environ.get("BENCH_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("OFF")
    checkpoints_on(spark)
    run(features(spark, folder))  # start-up of the session is not part of a query
    seconds = {name: timed(lambda n=name: run(QUERIES[n](spark, folder))) for name in HEADLINE}

    claims = stage_table(features(spark, folder), "features")
    rows = claims.filter(F.col(K.SPLIT) == "current").count()
    held = {}

    def prepare() -> None:
        matrix = fit_matrix(take_split(claims, "train"))
        held.update({s: stage_table(labelled(take_split(claims, s), matrix), s) for s in ("train", "validation")})

    seconds["fit_matrix"] = timed(prepare)
    seconds["fit_logistic"] = timed(lambda: held.update(lr=L.fit_logistic(held["train"], 0.1)))
    seconds["fit_calibrated_3_folds"] = timed(lambda: N.calibrate_folds(held["train"], lambda r: L.fit_logistic(r, 0.1), 3))
    seconds["fit_forest_200"] = timed(lambda: L.fit_forest(held["train"]))
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "rows_per_second": {n: round(rows / seconds[n]) for n in ("sc_tier_rank", "rf_string_pipe", "xp_plain_text", "xp_generate")},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
