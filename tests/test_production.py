"""The production run: lost after every step and in the middle of steps, it goes on where it was."""

import os
from collections import Counter

import pytest

from riskledger import constants as K
from riskledger.operators.contract import ContractError
from riskledger.plans import production as P
from riskledger.plans.catalog.texts import stub_writer
from riskledger.sources import stores
from riskledger.sources.orders import current_claims, history_claims
from riskledger.workspace import stage_table

QUICK = P.Settings(grid=(0.1,), eval_folds=2, final_folds=2, trees=3, rounds=3, completion_model="stub")
STEPS = [
    "settings", "claims", "rows", "chance", "LR", "RF", "XGB", "Cal-LR", "comparison", "test", "refit", "ranked", "explained",
    "audit", "scored", "metrics",
]


class Lost(Exception):
    """Stands for a driver that ends."""


def test_a_lost_run_goes_on(spark, folder, tmp_path, monkeypatch):
    history, current = (stage_table(c(spark, folder), "claims") for c in (history_claims, current_claims))
    root, entered, worked = str(tmp_path / "run"), Counter(), Counter()
    step = P.Run.step

    def counted(self, name, work):
        def once(out):
            worked[name] += 1
            return work(out)
        step(self, name, once)

    def lose(name):
        entered[name] += 1
        raise Lost(name)

    monkeypatch.setattr(P.Run, "step", counted)
    write, broken = stores.write_scored, []

    def half_written(rows, path, **options):
        write(rows.limit(5), path, **options)
        broken.append(path)
        raise Lost("in the middle of a step")

    attempts, done = 0, None
    while done is None:
        attempts += 1
        # The step that stores the list is lost once in the middle, with some rows already written.
        monkeypatch.setattr(stores, "write_scored", write if broken else half_written)
        try:
            done = P.produce(history, current, root, "r1", QUICK, stub_writer(), lose)
        except Lost:
            status = stores.read_states(spark, f"{root}/events").first()["status"]
            assert status == "FAILED"
        assert attempts < 30

    assert list(entered) and set(entered) == set(STEPS) and set(entered.values()) == {1}
    assert {s: n for s, n in worked.items() if n > 1} == {"scored": 2}  # no finished step is done again
    assert set(done) == set(STEPS)
    state = stores.read_states(spark, f"{root}/events").first()
    assert state["status"] == "FINISHED" and state["metrics"]["best_C"] == 0.1 and state["tags"] == {}

    n = current.count()
    published = spark.read.parquet(f"{done['scored'].folder}/claims")
    assert broken and done["scored"].folder not in broken[0] and os.path.exists(broken[0])
    assert [r["rank"] for r in published.orderBy("rank").collect()] == list(range(1, n + 1))
    assert published.columns == ["rank", *K.SCORED_COLUMNS]
    log = stores.read_audit(spark, done["audit"].folder)
    assert log.count() == n and log.filter("is_from_api").count() > 0
    # The list and the audit tell of the same texts.
    texts = published.join(log, "claim_id").filter(f"substring(explanation, 1, {K.AUDIT_TEXT_CHARS}) <> response_text")
    assert texts.count() == 0
    document = spark.read.json(f"{done['metrics'].folder}/document").first().asDict()
    assert document == done["metrics"].facts and len(document) == 13
    assert document["high_tier_count"] == n // 4 and document["llm_model"] == "stub"

    before = dict(worked)
    assert P.produce(history, current, root, "r1", QUICK) == done and before == dict(worked)  # a finished run is only read
    with pytest.raises(ValueError, match="other settings"):
        P.produce(history, current, root, "r1", P.Settings())


def test_faulty_claims_stop_a_run(spark, folder, tmp_path):
    history, current = history_claims(spark, folder), current_claims(spark, folder)
    root = str(tmp_path / "run")
    with pytest.raises(ContractError, match="key_overlap|unique"):
        P.produce(history, current.union(current.limit(1)), root, "r1", QUICK)
    assert set(P.Ledger(spark, root).entries()) == {"settings"}
    state = stores.read_states(spark, f"{root}/events").first()
    assert state["status"] == "FAILED" and "unique" in state["tags"]["error"]


def test_ledger(spark, tmp_path):
    """The earlier of two entries counts; an entry that was not finished is none."""
    ledger = P.Ledger(spark, str(tmp_path / "run"))
    assert ledger.entries() == {}
    first = ledger.enter("a", "one", {"n": 1})
    assert ledger.enter("a", "two", {"n": 2}) == first == P.Entry("one", {"n": 1})
    os.makedirs(tmp_path / "run/ledger/step=b/_temporary/0")
    assert set(ledger.entries()) == {"a"}
    (tmp_path / "other").mkdir()
    assert P.Ledger(spark, str(tmp_path / "other")).entries() == {}
