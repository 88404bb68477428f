"""Fitted models of every kind as folders: written, and read back without knowing their kind.

A folder holds ``about`` (one row: kind and settings) and one folder per part.  Single models and matrices are Spark ML
folders, so they keep their own format; composed models are folders of folders.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import SparkSession

from riskledger.operators.ensembles import Calibrated, Sigmoid, Stacked, Voting
from riskledger.operators.learners import Chance, Fitted, KernelMachine
from riskledger.operators.matrix import Matrix


def _parts(model: Any) -> tuple[str, dict, dict[str, Any]]:
    """Kind, settings and named parts of a model."""
    match model:
        case Fitted():
            return "fitted", {}, {"model": model.model}
        case KernelMachine():
            settings = {"gamma": model.gamma, "width": model.width, "dims": model.dims, "seed": model.seed}
            return "kernel", settings, {"model": model.model}
        case Chance():
            return "chance", {"prior": model.prior, "key": model.key, "seed": model.seed}, {}
        case Calibrated():
            settings = {"sigmoids": [[s.slope, s.offset] for s in model.sigmoids]}
            return "calibrated", settings, {f"member-{i}": m for i, m in enumerate(model.models)}
        case Voting():
            return "voting", {"weights": list(model.weights)}, {f"member-{i}": m for i, m in enumerate(model.members)}
        case Stacked():
            members = {f"member-{i}": m for i, m in enumerate(model.members)}
            return "stacked", {"members": len(members)}, {**members, "final": model.final}
        case Matrix():
            return "matrix", {"names": model.names}, {"model": model.stages}
    raise TypeError(f"models of type {type(model).__name__} cannot be written")


def write_model(spark: SparkSession, model: Any, path: str) -> None:
    """Writes ``model`` to the new folder ``path``; ``about`` comes last, so a folder that has it is whole."""
    kind, settings, parts = _parts(model)
    for name, part in parts.items():
        if name == "model":
            part.write().save(f"{path}/{name}")
        else:
            write_model(spark, part, f"{path}/{name}")
    spark.createDataFrame([(kind, json.dumps(settings))], "kind string, settings string").write.parquet(f"{path}/about")


def read_model(spark: SparkSession, path: str) -> Any:
    """The model that ``write_model`` wrote."""
    about = spark.read.parquet(f"{path}/about").first()
    kind, settings = about["kind"], json.loads(about["settings"])

    def part(name: str) -> Any:
        return read_model(spark, f"{path}/{name}")

    def stored() -> Any:
        return DefaultParamsReader.loadParamsInstance(f"{path}/model", spark)

    match kind:
        case "fitted":
            return Fitted(stored())
        case "kernel":
            return KernelMachine(stored(), **settings)
        case "chance":
            return Chance(**settings)
        case "calibrated":
            sigmoids = [Sigmoid(*s) for s in settings["sigmoids"]]
            return Calibrated([part(f"member-{i}") for i in range(len(sigmoids))], sigmoids)
        case "voting":
            return Voting([part(f"member-{i}") for i in range(len(settings["weights"]))], settings["weights"])
        case "stacked":
            return Stacked([part(f"member-{i}") for i in range(settings["members"])], part("final"))
        case "matrix":
            return Matrix(PipelineModel.load(f"{path}/model"), settings["names"])
    raise ValueError(f"unknown kind of model: {kind}")
