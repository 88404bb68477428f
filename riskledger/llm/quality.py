"""Document quality by hierarchical empirical Bayes.

A logistic classifier on the shape of a text gives the evidence of the document.  Labelled documents give
counts of good ones per host and per path of a host; hosts shrink towards the global share, paths towards
their host, by weights that the spread between hosts (and between the paths of hosts) implies.  A document's
quality is the posterior: the classifier's odds over the global odds, times the odds of its path.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger.llm.shared import Scratch, as_bytes, small_side

#: Labelled rows that the classifier is fitted on at most; site counts use all of them.
TRAINING_ROWS = 20_000
RIDGE = 1.0
_GROUPS = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b".!?", b",;:", b"'\"()-",
    b"#$%&*+/<=>@[\\]^_`{}~", b"|", bytes(range(128, 256)),
)
_CLASS_OF = np.full(256, len(_GROUPS))
for _i, _group in enumerate(_GROUPS):
    _CLASS_OF[list(_group)] = _i
N_FEATURES = len(_GROUPS) + 1 + 11


def shape(text: bytes) -> list[float]:
    """Shares of character classes, word and line statistics, and repetition of a whole non-empty text."""
    share = np.bincount(_CLASS_OF[np.frombuffer(text, np.uint8)], minlength=len(_GROUPS) + 1) / len(text)
    words = text.split()
    n = max(len(words), 1)
    size = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    common = Counter(words).most_common(1)[0][1] if words else 0
    lines = text.split(b"\n")
    return [
        *np.sqrt(share), np.log1p(n), np.log1p(size.mean()), np.log1p(size.std()), len(set(words)) / n, common / n,
        sum(map(eq, words, words[1:])) / n, len(set(zip(words, words[1:]))) / n, len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        sum(map(bytes.isupper, words)) / n, sum(map(bytes.isalpha, words)) / n,
    ]


def has_content(text: bytes | None) -> bool:
    return bool(text) and bool(text.split())


def shape_column() -> Callable[[Column], Column]:
    @F.arrow_udf("array<double>")
    def shapes(text: pa.Array) -> pa.Array:
        return pa.array([shape(t) if has_content(t) else None for t in as_bytes(text)], pa.list_(pa.float64()))

    return shapes


@dataclass(frozen=True)
class Evidence:
    """Logistic weights on standardised shapes and their squares; ``share`` is the training share of good texts."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    share: float

    def logits(self, shapes: np.ndarray) -> np.ndarray:
        return design(shapes, self.centre, self.scale) @ self.weights


def design(shapes: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((shapes - centre) / scale, -6, 6)
    return np.concatenate((np.ones((len(z), 1)), z, z * z), axis=1)


def fit_evidence(shapes: np.ndarray, good: np.ndarray) -> Evidence:
    """Newton steps on the penalised logistic loss; an empty or one-sided sample gives no evidence."""
    share = (good.sum() + 1.0) / (len(good) + 2.0)
    if len(good) == 0 or good.min() == good.max():
        weights = np.zeros(1 + 2 * N_FEATURES)
        weights[0] = np.log(share / (1 - share))
        return Evidence(np.zeros(N_FEATURES), np.ones(N_FEATURES), weights, share)
    centre, scale = shapes.mean(axis=0), np.maximum(shapes.std(axis=0), 1e-6)
    x = design(shapes, centre, scale)
    penalty = np.full(x.shape[1], RIDGE)
    penalty[0] = 0.0
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        pull = x.T @ (p - good) + penalty * weights
        curve = (x * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, pull)
        weights -= step * min(1.0, 3.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return Evidence(centre, scale, weights, share)


def strength(groups: DataFrame, n: str, s: str, centre: Column, share: float) -> float:
    """How many labels the parent's share counts for, by the spread of the groups' shares (method of moments)."""
    row = groups.agg(
        F.count("*").alias("groups"), F.sum(n).alias("rows"), F.sum(F.col(n) * F.col(n).cast("double")).alias("squares"),
        F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - centre, 2)).alias("spread"),
    ).first()
    if not row["rows"]:
        return 1.0
    noise = share * (1 - share)
    free = row["rows"] - row["squares"] / row["rows"]
    between = max(0.0, row["spread"] - (row["groups"] - 1) * noise) / free if free > 0 else 0.0
    return float(np.clip(noise / between - 1 if between > 0 else 1e6, 1.0, 1e6))


@dataclass(frozen=True)
class QualityModel:
    evidence: Evidence
    sites: DataFrame  # host, path, their labels (n, s), the labels of the host (host_n, host_s)
    share: float
    host_strength: float
    path_strength: float


def one_label(labels: DataFrame) -> DataFrame:
    """doc_id and good (1.0 or 0.0) of every labelled document; repeated labels vote, a tie is good."""
    voted = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_id"))
    return voted.agg((F.avg("quality") >= 0.5).cast("double").alias("good"))


def fit(docs: DataFrame, labels: DataFrame, host: Column, path: Column, scratch: Scratch) -> QualityModel:
    """Learns from the labelled rows of ``docs`` (doc_id, text); only shapes and labels are joined, not texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host.alias("host"), path.alias("path"), shape_column()(F.col("text")).alias("shape"))
    known = rows.filter("shape IS NOT NULL").join(one_label(labels), F.col("doc_id") == F.col("label_id"))
    known = scratch.stage(known.select("doc_id", "host", "path", "shape", "good"), "labelled")
    total = known.agg(F.count("*").alias("n"), F.sum("good").alias("s")).first()
    wanted = min(1.0, 1.5 * TRAINING_ROWS / max(total["n"], 1))
    place = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    sample = known.filter(place < wanted).orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id", "good").limit(TRAINING_ROWS).collect()
    shapes = np.array([r["shape"] for r in sample]).reshape(-1, N_FEATURES)
    evidence = fit_evidence(shapes, np.array([r["good"] for r in sample]))
    share = ((total["s"] or 0.0) + 1.0) / (total["n"] + 2.0)

    paths = known.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("good").alias("s"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s")).withColumnRenamed("host", "_host")
    host_strength = strength(hosts, "host_n", "host_s", F.lit(share), share)
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    sites = scratch.stage(sites, "sites", keep=True)
    path_strength = strength(sites, "n", "s", (F.col("host_s") + host_strength * share) / (F.col("host_n") + host_strength), share)
    return QualityModel(evidence, sites, share, host_strength, path_strength)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def judge(docs: DataFrame, model: QualityModel, host: Column, path: Column, threshold: float = 0.5) -> DataFrame:
    """row (all columns of ``docs`` as a struct), doc_logit, site_share, quality and kept.

    Sites without labels have their host's share, unknown hosts the global one.
    Null texts and texts without a word have quality 0 and are not kept.
    """
    evidence = docs.sparkSession.sparkContext.broadcast(model.evidence)  # N_FEATURES numbers

    @F.arrow_udf("double")
    def logit(text: pa.Array) -> pa.Array:
        texts = as_bytes(text)
        full = [i for i, t in enumerate(texts) if has_content(t)]
        out = np.full(len(texts), np.nan)
        if full:
            out[full] = evidence.value.logits(np.array([shape(texts[i]) for i in full]))
        return pa.array(out, pa.float64(), mask=np.isnan(out))

    rows = docs.select(
        F.struct("*").alias("row"), host.alias("host"), path.alias("path"), F.col("doc_id").cast("long").alias("id"), logit(F.col("text")).alias("doc_logit")
    )
    sites = small_side(model.sites.withColumnRenamed("host", "_host").withColumnRenamed("path", "_path"))
    rows = rows.join(sites, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")), "left")
    k, j = model.host_strength, model.path_strength
    host_share = (F.coalesce("host_s", F.lit(0.0)) + k * model.share) / (F.coalesce("host_n", F.lit(0)) + k)
    path_share = (F.coalesce("s", F.lit(0.0)) + j * host_share) / (F.coalesce("n", F.lit(0)) + j)
    base = float(np.log(model.evidence.share / (1 - model.evidence.share)))
    rows = rows.withColumn("site_share", F.least(F.greatest(path_share, F.lit(1e-6)), F.lit(1 - 1e-6)))
    odds = F.col("doc_logit") - base + _logit(F.col("site_share"))
    quality = F.coalesce(1 / (1 + F.exp(-F.least(F.greatest(odds, F.lit(-50.0)), F.lit(50.0)))), F.lit(0.0))
    return rows.withColumn("quality", quality).withColumn("kept", quality >= threshold)


def judged(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    with Scratch(docs.sparkSession, "quality") as scratch:
        return judge(docs, fit(docs, labels, host, path, scratch), host, path)
