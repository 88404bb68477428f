"""The corpus operators against brute force, on odd rows and on empty tables."""

import collections
import math
import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from llm_rows import DATA, ROW, rows_of, words
from riskledger.llm import decontam, language, lm, mixing, neardup, neighbours, quality, shards, spans, tokens
from riskledger.llm.graph import components
from riskledger.llm.shared import Scratch, fold_remainder
from riskledger.workspace import fresh_path


def word_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [(i, word_set(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in parent}


def test_near_duplicates_equal_brute_force(spark, odd, empty):
    r = random.Random(3)
    base = words(20, 200).split()
    texts = [(100 + k, " ".join(w if r.random() > 0.02 else "edit" for w in base)) for k in range(30)]
    rows = odd.unionByName(spark.createDataFrame(rows_of(texts), ROW))
    got = neardup.near_duplicates(rows).collect()
    pairs = [(x["doc_id"], x["text"]) for x in rows.collect()]
    expected = brute_components(pairs)
    assert len(got) == len(pairs)
    assert {x["doc_id"]: x["component_id"] for x in got} == {**expected, None: None}
    assert all(x["kept"] == (x["doc_id"] in (None, x["component_id"])) for x in got)
    assert sorted(x["n_shingles"] for x in got) == sorted(len(word_set(t)) for _, t in pairs)
    assert neardup.near_duplicates(empty).count() == 0
    kept = neardup.without_near_duplicates(rows)
    assert kept.columns == rows.columns
    ids = [x["doc_id"] for x in kept.select("doc_id").collect()]
    # Rows that share an id are texts of their own here: id 9 has two unlike ones.
    assert sorted(i for i in ids if i is not None) == sorted([*set(expected.values()), 9]) and ids.count(None) == 2


def test_unlike_texts_of_one_id_stay(spark):
    """Unlike texts are never linked by an id that they share, and each group of copies keeps one row."""
    a, b = words(50, 80), words(51, 80)
    rows = spark.createDataFrame(rows_of([(1, a), (1, b), (2, b), (3, a), (4, None), (4, ""), (4, ""), (5, a)]), ROW)
    kept = neardup.without_near_duplicates(rows)
    assert kept.columns == rows.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(1, a), (1, b), (4, None), (4, "")], key=str)


def test_close_signatures_share_a_key():
    random_numbers = np.random.default_rng(1)
    sign = random_numbers.integers(0, 1 << 16, (1, neardup.HASHES), dtype=np.uint16)
    for _ in range(200):
        other = sign.copy()
        at = random_numbers.choice(neardup.HASHES, neardup.CHUNKS * (neardup.ERRORS + 1) - 1, replace=False)
        other[0, at] ^= 1
        assert set(neardup.chunk_keys(sign)[0]) & set(neardup.chunk_keys(other)[0])


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    with Scratch(spark, "test") as scratch:
        got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(chain, "a long, b long"), scratch).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}


def test_languages(spark, docs, odd, empty):
    fold = fold_remainder("doc_id", 3)
    model = language.fit(docs, fold != 1)
    got = language.predict(docs, model, [F.col("doc_id"), (fold == 1).alias("held_out")]).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out AND lang IS NOT NULL").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).first()
    assert held[0] > 0.9 and 0 <= held[1] <= held[2] <= 1
    odd_rows = language.predict(odd, model, [F.col("doc_id")]).collect()
    assert len(odd_rows) == odd.count()
    assert {r["lang_pred"] for r in odd_rows if r["doc_id"] in (3, 4, 5, 6)} == {"und"}
    assert language.predict(empty, language.fit(empty, F.lit(True)), [F.col("doc_id")]).count() == 0


def test_token_counts_and_cache(spark, odd, empty):
    from tokenizers import Tokenizer

    path, cache = public_tokenizers.path("byte_bpe_50k.json"), fresh_path(spark, "cache")
    whole = Tokenizer.from_file(path)
    special = spark.createDataFrame(rows_of([(50, "a <|endoftext|> b"), (51, "é\n\n ü")]), ROW)
    rows = odd.unionByName(special)
    want = sorted((len((t or "").encode()), len(whole.encode(t or "", add_special_tokens=False).ids)) for (t,) in rows.select("text").collect())
    for _ in range(2):  # the second run finds all counts in the cache
        got = tokens.count_tokens(rows, path, cache).collect()
        assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
        stored = spark.read.parquet(cache)
        assert stored.count() == rows.select(F.coalesce("text", F.lit(""))).distinct().count()
    other = public_tokenizers.path("piece_bpe_32k.model")
    assert tokens.count_tokens(rows, other, cache).count() == len(want) and stored.select("version").distinct().count() == 1
    assert tokens.count_tokens(empty, path, cache).count() == 0


def brute_spans(rows):
    """Runs in the order of (id, text hash, position): sentences of all but the first occurrence."""
    found = collections.defaultdict(list)
    for i, h, text in rows:
        for pos, n, run in zip(*spans.runs(text)):
            found[run].append((i is None, i or 0, h, pos, n))
    gone = collections.defaultdict(set)
    for hits in found.values():
        first = min(hits)
        for none, i, h, pos, n in hits:
            if (none, i, h, pos) != first[:4]:
                gone[None if none else i, h] |= set(range(pos, pos + n))
    return gone


def test_repeated_passages_go(spark, odd, empty):
    passage = words(77, 60)
    texts = [(200 + k, f"{words(300 + k, 50)}\n{passage}\n{words(400 + k, 30)}") for k in range(6)]
    rows = odd.unionByName(spark.createDataFrame(rows_of(texts), ROW))
    got = spans.remove_repeats(rows)
    assert got.count() == rows.count()
    by_id = {r["doc_id"]: r["text"] for r in got.filter("doc_id >= 200").collect()}
    assert by_id[200] == texts[0][1] and not any(passage in by_id[200 + k] for k in range(1, 6))
    assert all(words(300 + k, 50) in by_id[200 + k] for k in range(6))
    keyed = rows.select("doc_id", F.xxhash64("text").alias("h"), "text")
    gone = brute_spans([tuple(r) for r in keyed.collect()])
    want = sorted(str((r["doc_id"], "".join(s for k, s in enumerate(spans.sentences(r["text"])) if k not in gone[r["doc_id"], r["h"]]) if r["text"] else r["text"])) for r in keyed.collect())
    assert sorted(str((r["doc_id"], r["text"])) for r in got.collect()) == want
    assert spans.remove_repeats(empty).count() == 0


def windows(text, size=50):
    w = text.lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def test_passages_of_short_sentences_go(spark):
    """No window of 50 words is left in two documents, whatever the length of its sentences up to ten words."""
    r = random.Random(5)
    passages = [[1] * 169, [1] * 60, [2] * 40, [3] * 30, [r.randint(1, 3) for _ in range(60)], [r.randint(1, 10) for _ in range(30)]]
    texts = []
    for k, lengths in enumerate(passages):
        each = iter(words(500 + k, sum(lengths), 10**6).split())
        mark = ("!! ", "\n", "? ")[k % 3]
        passage = mark.join(" ".join(next(each) for _ in range(n)) for n in lengths) + mark
        texts += [(10 * k + j, f"{words(600 + 10 * k + j, 40)}\n{passage}{words(700 + 10 * k + j, 40)}") for j in range(3)]
    got = {x["doc_id"]: x for x in spans.remove_repeats(spark.createDataFrame(rows_of(texts), ROW)).collect()}
    seen = collections.Counter(w for x in got.values() for w in windows(x["text"]))
    assert max(seen.values()) == 1
    everything = {w for x in got.values() for w in x["text"].lower().split()}
    for i, text in texts:
        assert set(text.lower().split()) <= everything  # each removed sentence stays once
        assert i % 10 or got[i]["text"] == text


def test_sentences_round_trip():
    for text in (words(1, 50), "a\n\n\nb!!  c", "", "no end", "x. ", "\n"):
        assert "".join(spans.sentences(text)) == text


def test_mixing(spark, docs, odd, empty):
    got = mixing.mix_sizes(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    by = got.groupby("source").agg(size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(by.index))}
    left, share = dict(by["size"].astype(float)), {}
    target, pool = {s: 0.0 for s in left}, float(sum(left.values()))
    while pool > 1e-6:  # share the excess again until none is above
        free = [s for s in left if target[s] < 3 * left[s] - 1e-9]
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += pool * weight[s] / total
        pool = sum(max(0.0, target[s] - 3 * left[s]) for s in left)
        target = {s: min(t, 3 * left[s]) for s, t in target.items()}
    assert all(math.isclose(by["target"][s], target[s], rel_tol=1e-9) for s in left)
    assert (got["taken"] <= 3 * got["size"]).all()
    assert mixing.mix_sizes(odd).count() == odd.count()
    assert mixing.mix_sizes(empty).count() == 0
    copies = mixing.mixed_documents(odd)
    assert copies.columns == odd.columns
    assert copies.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == mixing.mix_sizes(odd).agg(F.sum("taken")).first()[0]


def test_lm_scores(spark, docs, odd, empty):
    fold = fold_remainder("doc_id", 7)
    got = lm.lm_scores(docs, fold == 2, fold != 2).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    split = lambda t: (t or "").encode().lower().split() + [b" "]
    count = collections.Counter(w for i, t in texts if zlib.crc32(str(i).encode()) % 7 != 2 for w in split(t))
    total, kinds = sum(count.values()), len(count)
    base = {i: sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in split(t)) for i, t in texts}
    for r in got:
        assert r["train_tokens"] == total and math.isclose(r["base_score"], base[r["doc_id"]], rel_tol=1e-9)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    strange = lm.lm_scores(odd, fold == 2, F.lit(False)).collect()
    assert len(strange) == odd.count() and all(r["n_known"] == 0 and r["base_score"] == 0 for r in strange)
    assert lm.lm_scores(empty, fold == 2, fold != 2).count() == 0


def test_words_and_pairs_have_cells_of_their_own():
    """Distinct words have distinct hashes, and a corpus has more cells than features, at any size."""
    names = [str(i).encode() for i in range(100_000)]
    hashes = lm.token_hashes(names)
    assert len(set(hashes.tolist())) == len(names)
    for tokens in (0, 10**5, 10**7, 10**10):
        assert 1 << lm.cell_bits(tokens) > lm.FEATURES * tokens
    # 100,000 tokens, no word twice: nearly every feature stands alone
    row = {"ids": lm.planes(np.arange(len(names))), "n_tokens": [len(names)], "train": [True], "cells": hashes.tobytes(), "classes": bytes(len(names))}
    block = lm.Block.of(row)
    cells = block.features(slice(None), lm.cell_bits(len(names)))
    assert len(np.unique(cells)) > 0.65 * cells.size
    every = np.full(1 << (lm.FILTER_BITS - 3), 255, np.uint8)
    assert (lm.asked_cells(block, lm.cell_bits(len(names)), every) == np.unique(cells)).all()
    for least in (1, 3):
        found, counts = np.unique(cells, return_counts=True)
        assert (lm.frequent_cells(block, lm.cell_bits(len(names)), least) == found[counts >= least]).all()


def test_places_of_cells():
    r = np.random.default_rng(3)
    for n, top in ((0, 50), (1, 50), (40, 50), (3000, 4000), (5000, 1 << 40)):
        names = np.unique(r.integers(0, top, n))
        cells = np.concatenate((r.integers(0, top, 900), names)).reshape(-1, 1)
        got = lm.Places(names).of(cells)
        index = {int(x): i for i, x in enumerate(names)}
        assert got.ravel().tolist() == [index.get(int(x), len(names)) for x in cells.ravel()]


def test_numbers_of_words_have_32_bits():
    numbers = np.array([0, 1, 255, 256, 1 << 24, (1 << 24) + 5, (1 << 31) + 7, (1 << 32) - 1])
    assert lm.from_planes(lm.planes(numbers)).tolist() == numbers.tolist()


def test_small_weights_are_close():
    w = np.random.default_rng(1).normal(size=(500, lm.CLASSES)).astype(np.float32) * np.geomspace(1e-6, 1e3, 500)[:, None].astype(np.float32)
    w[3] = 0
    got = lm.weight_matrix(lm.weight_rows(w))
    assert (np.abs(got - w) <= np.abs(w).max(axis=1, keepdims=True) / 250 + 1e-12).all() and (got[3] == 0).all()


def brute_model(rows):
    """Scores of (doc_id, train, text) by a dense model with a row of weights for every feature, features being tuples."""
    texts = [(i, t, x.lower().encode().split() + [lm.END]) for i, t, x in rows]
    count = collections.Counter(w for _, t, x in texts if t for w in x)
    total, kinds = sum(count.values()), len(count)
    hashed = dict(zip(count, lm.token_hashes(list(count)).view(np.int64).tolist()))
    order = sorted(count, key=lambda w: (-count[w], hashed[w]))
    heads, tail = order[: lm.HEADS], order[lm.HEADS :]
    edges, mass, whole = [], 0, sum(count[w] for w in tail)
    for n in sorted({count[w] for w in tail}):
        mass += sum(count[w] for w in tail if count[w] == n)
        if len(edges) < lm.BANDS - 1 and mass >= whole * (len(edges) + 1) / lm.BANDS:
            edges.append(n)

    def kind(w):
        if w in heads:
            return heads.index(w)
        return lm.HEADS + 2 * sum(count[w] > e for e in edges) + (not w.isascii()) if count[w] else lm.HEADS

    share = np.zeros(lm.CLASSES)
    for w in count:
        share[kind(w)] += count[w] + 1
    share[lm.HEADS] += 1
    bias = np.where(share > 0, np.log(np.maximum(share, 1e-300) / share.sum()), -60)

    def features(x, i):
        one, two, three = (x[i - k] if i >= k else None for k in (1, 2, 3))
        return [("one", one), ("two", two), ("pair", one, two), ("three", three)]

    seen = [(features(x, i), kind(x[i])) for _, t, x in texts if t for i in range(len(x))]
    met = collections.Counter(f for fs, _ in seen for f in fs)
    weight = {f: np.zeros(lm.CLASSES) for f in met if met[f] >= lm.MET}
    square = {f: 1e-2 for f in weight}

    def softmax(fs):
        z = bias + sum((weight[f] for f in fs if f in weight), np.zeros(lm.CLASSES))
        z = np.exp(z - z.max())
        return z / z.sum()

    for at in range(0, len(seen), lm.STEP_TOKENS):
        pull = collections.defaultdict(lambda: np.zeros(lm.CLASSES))
        for fs, k in seen[at : at + lm.STEP_TOKENS]:
            error = softmax(fs)
            error[k] -= 1
            for f in fs:
                if f in weight:
                    pull[f] += error
        for f, g in pull.items():
            square[f] += (g * g).mean()
            weight[f] -= lm.RATE * g / np.sqrt(square[f])
    for f, w in weight.items():  # kept as whole 127ths of the largest
        weight[f] = np.rint(w / (np.abs(w).max() / 127)) * (np.abs(w).max() / 127)
    return {
        i: sum(math.log10(softmax(features(x, k))[kind(x[k])]) + math.log10((count[x[k]] + 1) / share[kind(x[k])]) for k in range(len(x)))
        for i, _, x in texts
    }


def test_scores_equal_a_dense_model(spark, monkeypatch):
    monkeypatch.setattr(lm, "cell_bits", lambda tokens: 40)  # so many cells that no two features share one
    r = random.Random(8)
    vocabulary = words(9, 60, 10**6).split() + ["été", "über"]
    texts = []
    for i in range(60):
        at, out = r.randrange(62), []
        for _ in range(r.randint(0, 80)):
            at = (at + r.choice([1, 1, 1, 5, r.randrange(62)])) % 62
            out.append(vocabulary[min(at, r.randrange(62))])
        texts.append((i, i % 5 != 0, " ".join(out)))
    frame = spark.createDataFrame(texts, "doc_id long, train boolean, text string").coalesce(1)
    got = {x["doc_id"]: x["score"] for x in lm.lm_scores(frame, ~F.col("train"), F.col("train")).collect()}
    want = brute_model(texts)
    assert got.keys() == want.keys()
    assert all(abs(got[i] - want[i]) < 2e-3 * (1 + abs(want[i])) for i in want)
    base = lm.lm_scores(frame, ~F.col("train"), F.col("train")).agg(F.sum("base_score")).first()[0]
    assert sum(want.values()) > base + 50  # the histories tell something here


def test_mean_weights_of_a_cell():
    """The mean of each cell over all learners, however the sorted rows are cut into batches."""
    r = np.random.default_rng(4)
    cell, n = np.sort(r.integers(0, 40, 300)), r.integers(1, 9, 300).astype(float)
    w = r.normal(size=(300, lm.CLASSES)).astype(np.float32)
    whole = lm.pa.RecordBatch.from_pydict({"cell": lm.pa.array(cell), "w": lm.weight_rows(w), "n": lm.pa.array(n)})
    for cut in (1, 7, 300):
        got = list(lm.average(whole.slice(at, cut) for at in range(0, 300, cut)))
        names = np.concatenate([np.asarray(b.column("cell")) for b in got])
        assert names.tolist() == sorted(set(cell.tolist()))
        means = np.concatenate([lm.weight_matrix(b.column("w")) for b in got])
        assert np.allclose(means, [np.average(w[cell == c], axis=0, weights=n[cell == c]) for c in names], atol=0.05)


def test_class_shares_add_up():
    hashes = lm.token_hashes([b"a", b"b", b"c", b"d"])
    row = {"ids": lm.planes(np.array([0, 1, 2, 3, 0, 0, 1, 2])), "n_tokens": [5, 3], "train": [True, False], "cells": hashes.tobytes(), "classes": bytes(4)}
    block = lm.Block.of(row)
    cells = block.features(slice(None), 14)
    assert block.owner.tolist() == [0] * 5 + [1] * 3 and cells[0].tolist() == cells[5].tolist() and (cells[1:3] == cells[6:8]).all()
    weights = np.random.default_rng(2).normal(size=(lm.CELLS, lm.CLASSES)).astype(np.float32)
    assert np.allclose(np.exp(lm.log_softmax(weights, np.zeros(lm.CLASSES, np.float32), cells)).sum(axis=1), 1, atol=1e-5)
    assert len(lm.Block.of(row, only_training=True).places) == 5


def test_quality(spark, docs, odd, empty):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    host, path = F.col("source"), F.col("lang")
    got = quality.judged(docs, labels, host, path)
    right = got.join(labels, F.col("id") == labels["doc_id"]).agg(F.avg((F.col("kept") == (labels["quality"] == 1)).cast("double"))).first()[0]
    assert right > 0.95
    strange = quality.judged(odd, labels, host, path)
    assert strange.count() == odd.count() and strange.filter("id IN (3, 4, 5) AND kept").count() == 0
    assert strange.select("row.*").columns == odd.columns
    assert quality.judged(empty, labels, host, path).count() == 0
    assert quality.judged(docs, labels.filter("false"), host, path).count() == docs.count()


def test_shrinking_sites(spark):
    """Sites that differ get their own shares, few labels stay near the whole; without a spread all shrink."""
    far = spark.createDataFrame([(100, 95.0), (100, 5.0), (2, 2.0)], "n long, s double")
    assert quality.strength(far, "n", "s", F.lit(0.5), 0.5) < 5
    even = spark.createDataFrame([(100, 50.0), (100, 50.0)], "n long, s double")
    assert quality.strength(even, "n", "s", F.lit(0.5), 0.5) == 1e6


def distance(item, text):
    row = [0] * (len(text) + 1)
    for c in item:
        last, row = row, [row[0] + 1]
        for j, d in enumerate(text):
            row.append(min(last[j] + (c != d), last[j + 1] + 1, row[j] + 1))
    return min(row)


def test_decontamination(spark, odd, empty):
    r = random.Random(9)
    items = [(i, words(500 + i, 25)) for i in range(6)] + [(6, "tiny one"), (7, None), (None, words(9, 30)), (8, "")]

    def edited(text, n):
        out = list(text)
        for _ in range(n):
            at = r.randrange(len(out))
            out[at : at + 1] = r.choice([["z"], [], [out[at], "z"]])
        return "".join(out)

    texts = [(20 + k, f"{words(600 + k, 60)} {edited(items[k % 6][1], k // 3)} {words(700 + k, 40)}") for k in range(45)]
    texts += [(90, items[2][1].upper()), (91, items[2][1][20:]), (92, "a tiny one here"), (93, "tinyone")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = odd.unionByName(spark.createDataFrame(rows_of(texts), ROW))
    got = {(x["doc_id"], x["item_id"]): x["edits"] for x in decontam.matches(rows, benchmark).collect()}
    want = {}
    for i, text in texts[:47]:
        for k, item in items[:6]:
            folded = decontam.fold(item)
            edits = distance(folded, decontam.fold(text))
            if edits <= min(int(decontam.EDIT_SHARE * len(folded)), (len(folded) - decontam.Q) // decontam.Q):
                want[i, k] = edits
    assert got == {**want, (92, 6): 0} and len(want) > 20
    clean = decontam.clean_documents(rows, benchmark)
    assert clean.columns == rows.columns and clean.count() == rows.count() - len({i for i, _ in got})
    assert decontam.matches(empty, benchmark).count() == 0
    assert decontam.matches(odd, benchmark.filter("false")).count() == 0


def test_shards(spark, docs, odd, empty):
    for rows in (docs, odd):
        got = shards.shard_table(rows).collect()
        assert len(got) == rows.count()
        load = collections.Counter()
        for r in got:
            load[r["shard"]] += r["size"]
        most = max(r["size"] for r in got)
        share = sum(load.values()) / 8
        assert all(abs(load[s] - share) <= most for s in range(8))
        for s in range(8):
            slots = sorted(r["slot"] for r in got if r["shard"] == s)
            assert slots == list(range(len(slots)))
        want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for (t,) in rows.select("text").collect())
        assert sorted((r["size"], r["text_crc32"]) for r in got) == want
    assert shards.shard_table(empty).count() == 0
    assert shards.shard_documents(odd).columns == [c for c in odd.columns if c != "shard"] + ["shard", "slot"]


def test_a_group_of_copies_is_cut(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.repeat(F.col("id").cast("string"), 3)).alias("text"))
    got = shards.shard_table(rows).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    sizes = [r["b"] for r in got]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 40


def test_neighbours(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding")
    size = len(table.first()["embedding"])
    odd_rows = [(9000, None), (9001, [0.0] * size), (9002, [float("nan")] * size), (9003, [None] * size), (9004, [1.0]), (None, [1.0] * size)]
    same = [(10_000 + i, [1.0] * size) for i in range(60)]
    rows = table.union(spark.createDataFrame(odd_rows + same, "vec_id long, embedding array<float>"))
    got = collections.defaultdict(list)
    for r in neighbours.nearest(rows, every=50).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    kept = [(r["vec_id"], r["embedding"]) for r in rows.collect() if r["vec_id"] is not None and (r["vec_id"] < 9000 or r["vec_id"] >= 10_000)]
    ids = np.array([i for i, _ in kept])
    unit = np.array([v for _, v in kept], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    asked, hit = [i for i in ids if i % 50 == 0], 0
    assert sorted(got) == sorted(asked)
    for q in asked:
        score = unit @ unit[list(ids).index(q)]
        order = [k for k in np.lexsort((ids, -np.round(score, 12))) if ids[k] != q][:5]
        hit += len({ids[k] for k in order} & {i for _, i, _ in got[q]})
        assert [r for r, _, _ in got[q]] == [1, 2, 3, 4, 5]
        for _, i, s in got[q]:
            assert math.isclose(s, score[list(ids).index(i)], abs_tol=1e-12)
    assert hit >= 0.9 * 5 * len(asked)
    assert [i for _, i, _ in got[10_000]] == [10_001, 10_002, 10_003, 10_004, 10_005]
    assert neighbours.nearest(rows.filter("false"), every=50).count() == 0


def test_pipeline_stages(spark, docs):
    import corpus_pipeline

    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        with_more = before.withColumn("kept", F.lit(1))
        after = stage(spark, with_more, DATA)
        assert after.columns == with_more.columns, name
        if name != "mixing":
            assert after.join(docs, "doc_id", "left_anti").count() == 0
    last = corpus_pipeline.run(spark, DATA)
    assert last.count() > 0 and last.columns == [*docs.columns, "shard", "slot"]


def test_kernel_of_a_long_text_equals_sets():
    """The kernel counts the n-grams that both texts hold, also in texts longer than any buffer."""
    texts = [" ".join(words(60 + k, n)) for k, n in enumerate((40, 3, 60_000))] + ["Été, l'été!", None, "12 _"]

    def grams(text):
        low = f" {text.lower()} "
        runs, out = [], ""
        for c in low:
            if c.isalpha():
                out += c
            elif not out.endswith(" "):
                out += " "
        runs = out
        return {runs[i : i + n] for n in language.ORDERS for i in range(len(runs) - n + 1)}

    cells, lettered = language.presence(texts)
    assert lettered.tolist() == [True] * 4 + [False] * 2 and not cells[4:].any()
    for text, row in zip(texts[:4], cells):
        found = grams(text)
        assert len(found) - 0.02 * len(found) ** 2 / language.BUCKETS * 50 <= row.sum() <= len(found)  # some n-grams share a cell
    again, _ = language.presence(texts[2:3])
    assert (again[0] == cells[2]).all()


def test_links_of_a_group_are_fewer_than_its_components():
    """A group of near copies gives a spanning tree of links, not all pairs, and joins the same components."""
    rng = np.random.default_rng(5)
    base = [rng.integers(0, 1 << 62, 60).astype(np.uint64) for _ in range(3)]
    items = [np.unique(np.concatenate((np.delete(base[i % 3], rng.integers(0, 60, 4)), rng.integers(0, 1 << 62, 2).astype(np.uint64)))) for i in range(60)]
    node, comp = np.arange(60) * 10, np.repeat(np.arange(30), 2)
    signs = np.stack([neardup.signature(x) for x in items])

    def parts(pairs):
        own = {int(n): int(c) for n, c in zip(node, comp)}
        for a, b in pairs:
            low, high = sorted((own[int(a)], own[int(b)]))
            own = {n: low if c == high else c for n, c in own.items()}
        return {frozenset(n for n in own if own[n] == c) for c in own.values()}

    every = []
    for a in range(60):
        for b in range(a):
            shared = len(np.intersect1d(items[a], items[b]))
            if 100 * shared >= 75 * (len(items[a]) + len(items[b]) - shared):
                every.append((node[a], node[b]))
    got = neardup.linked_in_group(node, comp, signs, items)
    assert len(every) > 400 and 0 < len(got) < 30
    assert parts(got) == parts(every)
    assert {(int(a), int(b)) for a, b in got} <= {(int(min(p)), int(max(p))) for p in every}
