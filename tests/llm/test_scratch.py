"""Batches of staged steps."""

import pyarrow as pa
import pytest

from riskledger.llm import neardup
from riskledger.llm.shared import BATCH_SETTING, Scratch


def test_staged_batches_are_small_and_the_setting_comes_back(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    usual = spark.conf.get(BATCH_SETTING)
    rows = spark.range(0, 100, 1, 2)
    with Scratch(spark, "test", 7) as scratch:
        found = [r["n"] for r in scratch.stage(rows.mapInArrow(sizes, "n long"), "sizes").collect()]
    assert max(found) <= 7 and sum(found) == 100
    assert spark.conf.get(BATCH_SETTING) == usual
    with pytest.raises(ValueError), Scratch(spark, "test", 7):
        raise ValueError
    assert spark.conf.get(BATCH_SETTING) == usual


def test_near_duplicates_hands_few_whole_texts_to_python(spark, docs, monkeypatch):
    """Texts go to Python in batches of at most ``BATCH_ROWS`` rows."""
    seen = []
    stage = Scratch.stage

    def noted(self, *args, **named):
        seen.append(int(self.spark.conf.get(BATCH_SETTING)))
        return stage(self, *args, **named)

    monkeypatch.setattr(Scratch, "stage", noted)
    neardup.near_duplicates(docs.limit(50))
    assert seen and max(seen) <= neardup.BATCH_ROWS
