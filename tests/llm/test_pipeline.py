"""The pipeline's stages against plain versions, and its rules for odd rows."""

import collections
import random
import tracemalloc

import corpus_pipeline
import numpy as np
from conftest import ROOT, plan
from test_operators import ODD, got, plain_ids, prose, table
from tidemark.llm import simhash, tokenids, toxicity
from tidemark.llm.common import stored


def shingles(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def test_stages(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_ids"]
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ROOT), name)
        held[name] = got(docs)
        if name != "token_ids":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before, after = held["toxicity"], held["simhash_near_dedup"]
    kept = {r["doc_id"]: shingles(r["text"]) for r in after}
    for r in before:
        own = shingles(r["text"])
        if r["doc_id"] not in kept:
            assert any(own == k or own and len(own & k) / len(own | k) >= 0.5 for k in kept.values())
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in after if not any(i and len(i & kept[r["doc_id"]]) >= 0.8 * len(i) for i in items)}
    assert {r["doc_id"] for r in held["benchmark_decontamination"]} == clean
    mixed = collections.Counter(r["doc_id"] for r in held["source_mixing"])
    assert set(mixed) <= clean and max(mixed.values()) <= 2
    rows = sorted(((r["doc_id"], r["text"], None) for r in held["source_mixing"]), key=lambda r: r[0])
    assert sorted(tuple(r.values()) for r in held["token_ids"]) == sorted(plain_ids(rows))
    assert sorted(map(tuple, corpus_pipeline.run(spark, ROOT).collect())) == sorted(tuple(r.values()) for r in held["token_ids"])


def test_planted_copies(spark):
    rng = random.Random(3)
    rows = [(i, prose(i, 150), "a") for i in range(80)]
    copies = {}
    for i in range(20):
        w = rows[i][1].split()
        if i % 2:
            w[rng.randrange(len(w))] = "changed"
        copies[100 + i] = i
        rows.append((100 + i, " ".join(w), "b"))
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, table(spark, rows), ROOT).collect()}
    assert kept == set(range(80))


def test_odd_rows(spark):
    docs = stored(table(spark, ODD), "odd")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ROOT), name)
    assert docs.count() > 0
    docs = table(spark, []).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ROOT), name)
    assert docs.count() == 0


def test_near_copies_meet_without_the_driver(spark, monkeypatch):
    plans, before = [], spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def seen(df, name, *more):
        df.collect()
        plans.append(plan(df))
        return stored(df, name, *more)

    monkeypatch.setattr(simhash, "stored", seen)
    rows = [(i, prose(i, 150), "a") for i in range(40)]
    rows += [(100 + i, rows[i][1] + " more", "b") for i in range(20)]
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, table(spark, rows), ROOT).collect()}
    assert kept == set(range(40))
    assert any("Join" in p for p in plans) and not any("BroadcastExchange" in p for p in plans)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before


def test_driver_needs_no_tokenizer(spark, monkeypatch):
    monkeypatch.setattr(tokenids, "_encoders", {})
    rows = [(i, prose(i, 50), "a") for i in range(20)]
    assert corpus_pipeline.token_ids(spark, table(spark, rows), ROOT).count() == 20
    assert not tokenids._encoders


def test_fit_holds_little_in_the_driver(monkeypatch):
    rng = np.random.default_rng(5)
    sets = [np.sort(rng.choice(6000, 200, replace=False)).astype(np.int32) for _ in range(5000)] + [np.empty(0, np.int32)]
    y, scale = (rng.random(len(sets)) < 0.1).astype(float), rng.random(6000)
    pairs = [(i, sets[i][::2]) for i in range(0, 5000, 50)]
    tracemalloc.start()
    weights, bias = toxicity._descend(sets, y, pairs, scale, 1.0, steps=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * sum(map(len, sets))
    monkeypatch.setattr(toxicity, "FIT_ENTRIES", 1 << 40)
    again, same = toxicity._descend(sets, y, pairs, scale, 1.0, steps=2)
    assert np.array_equal(weights, again) and bias == same
