"""Toxicity of whole texts, learned from confirmed toxic examples and unlabelled texts.

A text is the set of its lower-cased words of letters and of the beginnings of ``PREFIXES`` bytes that longer words
have.  Members of a
small committee are fitted side by side, each on all sampled positive texts and on unlabelled texts of its own, which
are a plain sample of the corpus and so hold toxic ones at the class prior.  A member keeps features by the
class-prior-corrected contrast of their shares, then minimises the non-negative positive-unlabelled risk of Kiryo et
al. (2017) with logistic loss:  prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)).  A score is the logistic function of
the members' mean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskledger.llm.shared import Prefixes, Scratch, pieces

PREFIXES = (4, 5, 6, 7, 8)
#: Bounds of the fitted sample: positive texts, committee members, unlabelled texts of each member.
POSITIVES, MEMBERS, UNLABELLED = 4096, 4, 2048
#: Class prior where the labels cannot tell (no text is marked as not toxic).
PRIOR = 0.1
#: Features of a member at most, and what each needs: positive texts that it is in, a contrast in standard errors, and
#: a share in positive texts of so many times that in the others (long texts hold more of everything).
FEATURES, LEAST_TEXTS, LEAST_CONTRAST, LEAST_LIFT = 4096, 3, 4.0, 4.0
#: Features whose fitted weight is below go, and the others are fitted again.
LEAST_WEIGHT = 0.25
STEPS, RATE, DECAY = 300, 0.1, 1e-3
THRESHOLD = 0.3
_LETTERS = re.compile(r"[^\W\d_]+")


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes and the text each belongs to, sorted by text, then hash; each feature of a text once."""
    words, owners = [], []
    for i, text in enumerate(texts):
        own = set(_LETTERS.findall(text.lower())) if text else ()
        words += own
        owners.append(np.full(len(own), i))
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    coded = [w.encode() for w in words]
    size, owner = np.fromiter(map(len, coded), np.int64, len(coded)), np.concatenate(owners)
    end = np.cumsum(size + 1) - 1
    start = end - size
    spans = Prefixes(b" ".join(coded) + b" ")
    found, holder = [spans.spans(start, end + 1)], [owner]  # a whole word has the blank after it
    for n in PREFIXES:
        long = size > n
        found.append(spans.spans(start[long], start[long] + n))
        holder.append(owner[long])
    cell, owner = np.concatenate(found), np.concatenate(holder)
    order = np.lexsort((cell, owner))
    cell, owner = cell[order], owner[order]
    fresh = np.append(True, (cell[1:] != cell[:-1]) | (owner[1:] != owner[:-1]))
    return cell[fresh], owner[fresh]


def sketch(text: str | None) -> int:
    """The least hash of five words in a row; near copies mostly share it, other texts do not."""
    words = [w.encode() for w in _LETTERS.findall(text.lower())] if text else []
    size = np.array([len(w) + 1 for w in words], np.int64)
    end = np.cumsum(size)
    start = end - size
    least = min(5, len(words))
    if not least:
        return 0
    spans = Prefixes(b" ".join(words) + b" ").spans(start[: len(words) - least + 1], end[least - 1 :])
    return int(spans.view(np.int64).min())


@dataclass(frozen=True)
class Classifier:
    """Weights of features in the order of their hashes, and a bias."""

    cells: np.ndarray
    weights: np.ndarray
    bias: float

    def logits(self, cell: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        if not len(self.cells):
            return np.full(texts, self.bias)
        place = np.minimum(np.searchsorted(self.cells, cell), len(self.cells) - 1)
        known = self.cells[place] == cell
        return self.bias + np.bincount(owner[known], self.weights[place[known]], texts)


def contrasting(positive: np.ndarray, positives: int, unlabelled: np.ndarray, texts: int, prior: float) -> np.ndarray:
    """The features whose share in positive texts is above that in the others, which the prior makes out of all texts."""
    names, count = np.unique(positive, return_counts=True)
    names, count = names[count >= LEAST_TEXTS], count[count >= LEAST_TEXTS]
    ordered = np.sort(unlabelled)
    among = np.searchsorted(ordered, names, "right") - np.searchsorted(ordered, names, "left")
    share, whole = count / positives, among / texts
    others = np.clip((whole - prior * share) / (1 - prior), 0, 1)
    pooled = np.clip((count + among + 1) / (positives + texts + 2), 1e-12, 1 - 1e-12)
    contrast = (share - others) / np.sqrt(pooled * (1 - pooled) * (1 / positives + 1 / texts))
    order = np.lexsort((names, -contrast))
    telling = (contrast >= LEAST_CONTRAST) & (share >= LEAST_LIFT * others)
    return np.sort(names[order[telling[order]][:FEATURES]])


def risk_step(weights: np.ndarray, bias: float, positive: tuple, unlabelled: tuple, prior: float) -> tuple[float, np.ndarray, float]:
    """The non-negative risk and its gradient, for two samples given as (feature place, text, texts).

    Where the estimate for the other class is negative, it is raised again: its gradient is turned round, alone.
    """

    def logits(sample):
        place, owner, texts = sample
        return bias + np.bincount(owner, weights[place], texts)

    def back(sample, slope):
        place, owner, texts = sample
        return np.bincount(place, slope[owner], len(weights)) / texts, slope.mean()

    p, u = logits(positive), logits(unlabelled)
    up, uu = 1 / (1 + np.exp(-p)), 1 / (1 + np.exp(-u))
    missed = np.logaddexp(0, -p).mean()
    other = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
    toxic, from_p, from_u = back(positive, up - 1), back(positive, up), back(unlabelled, uu)
    slope = [f - prior * q for f, q in zip(from_u, from_p)]
    if other < 0:
        return prior * missed, -slope[0], -slope[1]
    return prior * missed + other, prior * toxic[0] + slope[0], prior * toxic[1] + slope[1]


def fit_member(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Classifier:
    """Adam steps on the risk of all sampled texts, each given by its features."""
    bias = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Classifier(np.zeros(0, np.uint64), np.zeros(0), bias)

    def flat(sample):
        return np.concatenate(sample), np.repeat(np.arange(len(sample)), [len(x) for x in sample])

    (pc, po), (uc, uo) = flat(positive), flat(unlabelled)
    cells = contrasting(pc, len(positive), uc, len(unlabelled), prior)
    if not len(cells):
        return Classifier(cells, np.zeros(0), bias)

    def placed(cell, owner, texts):
        place = np.minimum(np.searchsorted(cells, cell), len(cells) - 1)
        known = cells[place] == cell
        return place[known], owner[known], texts

    fitted = descend(cells, placed(pc, po, len(positive)), placed(uc, uo, len(unlabelled)), prior)
    cells = cells[fitted.weights >= LEAST_WEIGHT]
    return descend(cells, placed(pc, po, len(positive)), placed(uc, uo, len(unlabelled)), prior) if len(cells) else fitted


def descend(cells: np.ndarray, positive: tuple, unlabelled: tuple, prior: float) -> Classifier:
    bias = float(np.log(prior / (1 - prior)))
    state = np.append(np.zeros(len(cells)), bias)
    mean, square = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, STEPS + 1):
        _, slope, slant = risk_step(state[:-1], state[-1], positive, unlabelled, prior)
        pull = np.append(slope + DECAY * state[:-1], slant)
        mean = 0.9 * mean + 0.1 * pull
        square = 0.999 * square + 0.001 * pull * pull
        state -= RATE * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Classifier(cells, state[:-1], float(state[-1]))


def committee(members: list[Classifier], prior: float) -> Classifier:
    """One classifier with the members' mean logits."""
    if not members:
        return Classifier(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    cells, place = np.unique(np.concatenate([m.cells for m in members]), return_inverse=True)
    weights = np.bincount(place, np.concatenate([m.weights for m in members]), len(cells)) / len(members)
    return Classifier(cells, weights, float(np.mean([m.bias for m in members])))


def confirmed(labels: DataFrame) -> DataFrame:
    """doc_id and toxic (boolean) of every labelled document; repeated labels vote, a tie is toxic."""
    voted = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return voted.agg((F.avg("toxic") >= 0.5).alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, eligible: Column, prior: float | None = None) -> Classifier:
    """Learns from rows of ``docs`` (doc_id, text) that are ``eligible``, which may look at doc_id alone.

    ``prior`` is the share of toxic texts among all; by default their share among the eligible labelled documents, as
    labels are on a sample.  Nothing else is taken from documents marked as not toxic.  At most ``POSITIVES`` toxic
    and ``MEMBERS * UNLABELLED`` other texts are sampled, by hashes of id and text.  Of texts with one ``sketch`` (copies)
    a sample holds one, so that the words of a text copied often do not pass for toxic ones.
    Without a positive text every score is the prior.
    """
    spark = docs.sparkSession
    with Scratch(spark, "toxicity") as scratch:
        known = confirmed(labels).filter(eligible)
        count = known.agg(F.count("*").alias("n"), F.sum(F.col("toxic").cast("long")).alias("toxic")).first()
        positives = count["toxic"] or 0
        if prior is None:
            prior = positives / count["n"] if 0 < positives < count["n"] else PRIOR
        prior = float(np.clip(prior, 1e-4, 0.9))

        def threshold(column: Column, wanted: int, of: int) -> Column:
            return F.pmod(column, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * wanted / max(of, 1)))

        ids = known.filter("toxic").filter(threshold(F.xxhash64("doc_id", F.lit(5)), POSITIVES, positives)).select(F.col("doc_id").alias("_toxic"))
        ids = ids.orderBy(F.xxhash64("_toxic", F.lit(5)), "_toxic").limit(POSITIVES)  # few enough to broadcast
        rows = docs.filter("doc_id IS NOT NULL").filter(eligible).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        order = F.xxhash64("doc_id", "text", F.lit(6))
        chosen = rows.join(F.broadcast(ids), F.col("doc_id") == F.col("_toxic"), "left").withColumn("h", order)
        drawn = threshold(F.col("h"), MEMBERS * UNLABELLED, rows.count())
        member = F.pmod(F.xxhash64("h", F.lit(7)), F.lit(MEMBERS)).cast("int")
        sides = F.filter(F.array(F.when(F.col("_toxic").isNotNull(), -1), F.when(drawn, member)), lambda x: x.isNotNull())
        chosen = chosen.withColumn("sides", sides).filter(F.size("sides") > 0).select("sides", "h", "text")

        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, "text", limit=1 << 20, rows=256):
                    cell, owner = features(part.column("text").to_pylist())
                    cut = np.searchsorted(owner, np.arange(part.num_rows + 1))
                    found = [cell[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
                    sketches = pa.array([sketch(t) for t in part.column("text").to_pylist()], pa.int64())
                    yield pa.RecordBatch.from_pydict({"sides": part.column("sides"), "h": part.column("h"), "sketch": sketches, "cells": pa.array(found, pa.binary())})

        sampled = chosen.mapInArrow(cells, "sides array<int>, h long, sketch long, cells binary")
        sampled = sampled.select(F.explode("sides").alias("side"), "h", "sketch", "cells").withColumn("row", F.monotonically_increasing_id())
        sampled = scratch.stage(sampled, "sample")
        # Which rows stay is found without their features.
        copy = F.row_number().over(Window.partitionBy("side", "sketch").orderBy("h", "row"))
        place = F.row_number().over(Window.partitionBy("side").orderBy("h", "row"))
        bound = F.when(F.col("side") < 0, POSITIVES).otherwise(UNLABELLED)
        kept = sampled.select("side", "sketch", "h", "row").withColumn("copy", copy).filter(F.col("copy") == 1)
        kept = kept.withColumn("place", place).filter(F.col("place") <= bound).select("row")  # few enough to broadcast
        sampled = sampled.join(F.broadcast(kept), "row", "left_semi")
        # Every member meets all positives and its own unlabelled texts.
        side = F.when(F.col("side") < 0, F.sequence(F.lit(0), F.lit(MEMBERS - 1))).otherwise(F.array("side"))
        meeting = sampled.select(F.explode(side).alias("member"), (F.col("side") < 0).alias("toxic"), "h", "cells")

        def learn(table: pa.Table) -> pa.Table:
            table = table.sort_by([("toxic", "ascending"), ("h", "ascending"), ("cells", "ascending")])
            toxic = np.asarray(table.column("toxic"))
            texts = [np.frombuffer(c, np.uint64) for c in table.column("cells").to_pylist()]
            fitted = fit_member([t for t, y in zip(texts, toxic) if y], [t for t, y in zip(texts, toxic) if not y], prior)
            return pa.table({
                "member": table.column("member").slice(0, 1), "cells": pa.array([fitted.cells.tobytes()], pa.binary()),
                "weights": pa.array([fitted.weights.tobytes()], pa.binary()), "bias": pa.array([fitted.bias]),
            })

        found = meeting.groupBy("member").applyInArrow(learn, "member int, cells binary, weights binary, bias double").collect()  # a row per member
        found.sort(key=lambda r: r["member"])
        return committee([Classifier(np.frombuffer(r["cells"], np.uint64), np.frombuffer(r["weights"]), r["bias"]) for r in found], prior)


def predict(docs: DataFrame, model: Classifier, carried: list[Column], threshold: float = THRESHOLD) -> DataFrame:
    """``carried`` columns with score (0 to 1) and predicted (1 from ``threshold`` on) of every whole ``text``.

    A text without a word, a null or an empty one has the score of the bias alone.  Rows are scored by themselves:
    repeated rows repeat their score, an empty table gives an empty result, columns that are not carried are not read,
    and long texts are read whole, as the distinct words that they hold.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES * MEMBERS weights at most
    rows = docs.select(*carried, F.col("text").alias("_text"))
    kept = rows.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "_text", limit=1 << 20, rows=512):
                cell, owner = features(part.column("_text").to_pylist())
                score = 1 / (1 + np.exp(-np.clip(held.value.logits(cell, owner, part.num_rows), -30, 30)))
                yield pa.RecordBatch.from_pydict({
                    **{f.name: part.column(i) for i, f in enumerate(kept)},
                    "score": pa.array(score), "predicted": pa.array((score >= threshold).astype(np.int32)),
                })

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "score double, predicted int"])
    return rows.mapInArrow(run, schema)
