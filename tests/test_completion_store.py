"""Calls are made once, whatever is lost between runs."""

import os
import uuid
from collections import Counter
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskledger.operators import explain as E


def noting(folder, deadly=(), refused=()):
    """A completion function that notes every prompt it sees, ends its process at a deadly one and fails at a refused one."""
    folder = str(folder)

    def answer(prompts: pd.Series) -> pd.DataFrame:
        if prompts.isin(refused).any():
            if len(prompts) == 1:
                (Path(folder) / uuid.uuid4().hex).write_text(prompts.iloc[0])
            raise RuntimeError("refused")
        if prompts.isin(deadly).any():
            os._exit(1)
        for text in prompts:
            (Path(folder) / uuid.uuid4().hex).write_text(text)
        return pd.DataFrame({"responded": True, "raw": "reply to " + prompts})

    return answer


def seen(folder):
    return Counter(f.read_text() for f in Path(folder).iterdir())


def claims(spark, n):
    return spark.range(n).select(F.format_string("C%02d", "id").alias("claim_id"), F.format_string("p%02d", "id").alias("prompt"))


def test_calls_of_a_lost_run_are_not_repeated(spark, tmp_path):
    notes, store = tmp_path / "notes", str(tmp_path / "store")
    notes.mkdir()
    rows = claims(spark, 40)
    options = {"store": store, "calls_per_write": 8, "lanes": 2, "batch": 1}
    names = rows.withColumn("call", E.call_key(F.col("claim_id"), F.col("prompt")))
    # The prompt that ends the process is one of the last job, so that jobs before it have ended.
    deadly = names.orderBy(F.desc(F.pmod(F.xxhash64("call"), F.lit(5)))).first().prompt
    with pytest.raises(Exception):
        E.complete(rows, noting(notes, deadly=[deadly]), **options).count()
    kept = {r.prompt for r in E.stored_completions(spark, store).join(names, "call").collect()}
    assert kept and deadly not in kept
    done = E.complete(rows, noting(notes), **options).collect()
    assert sorted((r.claim_id, r.raw) for r in done) == [(f"C{i:02d}", f"reply to p{i:02d}") for i in range(40)]
    counts = seen(notes)
    assert all(counts[p] == 1 for p in kept) and len(counts) == 40
    E.complete(rows, noting(notes), **options)
    assert seen(notes) == counts


def test_failed_calls_keep_their_reason_and_are_made_again(spark, tmp_path):
    notes, store = tmp_path / "notes", str(tmp_path / "store")
    notes.mkdir()
    rows = claims(spark, 6)
    first = {r.prompt: r for r in E.complete(rows.union(rows), noting(notes, refused=["p03"]), store=store, lanes=1).collect()}
    assert (first["p03"].responded, first["p03"].completion_error) == (False, "RuntimeError: refused")
    assert first["p02"].responded and first["p02"].completion_error is None
    again = E.complete(rows.union(rows), noting(notes), store=store)
    assert again.count() == 12 and again.filter("responded and raw = concat('reply to ', prompt)").count() == 12
    assert seen(notes) == {f"p{i:02d}": 2 if i == 3 else 1 for i in range(6)}


def test_another_prompt_of_a_claim_is_another_call(spark, tmp_path):
    notes, store = tmp_path / "notes", str(tmp_path / "store")
    notes.mkdir()
    rows = claims(spark, 2)
    E.complete(rows, noting(notes), store=store)
    changed = rows.withColumn("prompt", F.concat("prompt", F.lit(" now")))
    assert {r.raw for r in E.complete(changed, noting(notes), store=store).collect()} == {"reply to p00 now", "reply to p01 now"}
    assert E.complete(rows.limit(0), noting(notes), store=store).count() == 0
