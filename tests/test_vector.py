"""Search against brute force, and scorers on literal rows."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import evaluate as ev
from tidemark.operators import vector as vec


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    data = [(i, [float(round(x, 1)) for x in rng.normal(size=4)], i % 3) for i in range(300)]
    data += [(1000 + i, data[i][1], 0) for i in range(40)]  # exact copies, so distances tie
    data += [(2000 + i, data[0][1], 1) for i in range(150)]  # one vector many times
    return data


@pytest.fixture(scope="module")
def index(spark, vectors):
    return spark.createDataFrame(vectors, "id long, embedding array<float>, label int").repartition(6).cache()


@pytest.fixture(scope="module")
def queries(spark, vectors):
    return spark.createDataFrame([(i, vectors[i][1]) for i in range(0, 60, 2)], "query_id long, embedding array<float>").cache()


def brute(vectors, queries, k, keep=lambda r: True, unit=False):
    def prepared(v):
        v = np.array(v, dtype=np.float32).astype(np.float64)
        return v / (np.linalg.norm(v) or 1.0) if unit else v

    out = []
    for q in queries.collect():
        target = prepared(q["embedding"])
        found = sorted((math.sqrt(((prepared(v) - target) ** 2).sum()), i) for i, v, l in vectors if keep((i, v, l)))
        out += [(q["query_id"], i, n + 1, round(d, 6)) for n, (d, i) in enumerate(found[:k])]
    return sorted(out, key=repr)


def shaped(df):
    return rows(df.select("query_id", "id", "rank", F.round("distance", 6)))


@pytest.mark.parametrize("size", [vec.QUERY_BYTES, 500])
def test_exact_neighbours(index, queries, vectors, size):
    """All queries at once, or three chunks of them."""
    got = vec.knn(index, queries, 7, query_bytes=size)
    assert shaped(got) == brute(vectors, queries, 7)


def test_filter_comes_first(index, queries, vectors):
    got = vec.knn(index, queries, 5, where="label = 2")
    assert shaped(got) == brute(vectors, queries, 5, keep=lambda r: r[2] == 2)


def test_more_neighbours_than_rows(index, queries):
    assert vec.knn(index.filter("id < 3"), queries, 10).count() == 3 * queries.count()


def test_dimensions_must_agree(index, queries, spark):
    with pytest.raises(vec.DimensionMismatch):
        vec.knn(index, queries.unionAll(spark.createDataFrame([(9, [1.0])], queries.schema)), 3)
    with pytest.raises(Exception, match="dimensions"):
        vec.knn(index.select("id", F.slice("embedding", 1, 3).alias("embedding")), queries, 3).collect()


def test_all_cells_give_the_exact_neighbours(index, queries, vectors):
    """Ties and copies included, whatever the pieces and chunks."""
    held = vec.build_cells(index, cells=6, copies=2)
    assert shaped(vec.search_cells(held, queries, 7, probes=6)) == brute(vectors, queries, 7)
    assert shaped(vec.search_cells(held, queries, 7, probes=6, chunk_rows=9)) == brute(vectors, queries, 7)


def test_large_cells_are_cut(index, queries, vectors, monkeypatch):
    monkeypatch.setattr(vec, "PIECE_ROWS", 40)
    held = vec.build_cells(index, cells=3, copies=1)
    assert max(held.pieces.values()) > 1
    sizes = held.rows.groupBy("cell", "piece").count().agg(F.max("count")).first()[0]
    assert sizes <= 80
    assert shaped(vec.search_cells(held, queries, 4, probes=3)) == brute(vectors, queries, 4)


def test_recall_out_of_a_quarter_of_the_cells(tables):
    ask = tables.embeddings.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = vec.knn(tables.embeddings, ask, 10, key="vec_id")
    held = vec.build_cells(tables.embeddings, key="vec_id")
    near = vec.search_cells(held, ask, 10)
    assert len(held.centres) // 4 <= 0.25 * len(held.centres)
    assert vec.recall(near, exact).first()["recall"] >= 0.9
    # What is found has its exact distance.
    assert near.join(exact.select("query_id", "id", F.col("distance").alias("d")), ["query_id", "id"]).filter("distance <> d").isEmpty()
    lone = vec.build_cells(tables.embeddings, key="vec_id", copies=1)
    assert lone.rows.count() == tables.embeddings.count() < held.rows.count() <= 4 * tables.embeddings.count()
    assert vec.recall(vec.search_cells(lone, ask, 10), exact).first()["recall"] < 0.9, "copies of border vectors make the difference"


def test_cells_of_odd_indexes(spark, index):
    one = index.limit(1)
    ask = one.select(F.lit(5).cast("long").alias("query_id"), "embedding")
    assert vec.knn_ann(one, ask, 3).count() == 1
    assert vec.knn_ann(index, ask.limit(0), 3).collect() == []
    with pytest.raises(ValueError):
        vec.build_cells(index.limit(0))


def bm25(k):
    words = {i: re.findall("[a-z0-9]+", (t or "").lower()) for i, t in DOCS}
    mean = sum(map(len, words.values())) / len(words)
    out = []
    for q, text in ASK:
        scored = []
        for i, ws in words.items():
            s = 0.0
            for w in set(re.findall("[a-z0-9]+", text.lower())):
                df = sum(w in x for x in words.values())
                tf = ws.count(w)
                s += math.log(1 + (len(words) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / mean)) if tf else 0
            if s > 0:
                scored.append((-round(s, 9), i))
        out += [(q, i, n + 1, round(-s, 6)) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


DOCS = [(1, "the cat sat on the mat"), (2, "the dog"), (3, "cat cat cat"), (4, ""), (5, "a bird, the Cat!"), (6, None), (7, "...")]
ASK = [(1, "the cat"), (2, "bird bird"), (3, "nothing here"), (4, "")]


def bm25(k):
    words = {i: re.findall("[a-z0-9]+", (t or "").lower()) for i, t in DOCS}
    mean = sum(map(len, words.values())) / len(words)
    out = []
    for q, text in ASK:
        scored = []
        for i, ws in words.items():
            s = 0.0
            for w in set(re.findall("[a-z0-9]+", text.lower())):
                df = sum(w in x for x in words.values())
                tf = ws.count(w)
                s += math.log(1 + (len(words) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / mean)) if tf else 0
            if s > 0:
                scored.append((-round(s, 9), i))
        out += [(q, i, n + 1, round(-s, 6)) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [vec.QUERY_BYTES, 1])
def test_keyword_search(spark, size):
    docs = spark.createDataFrame(DOCS, "id long, text string").repartition(3)
    ask = spark.createDataFrame(ASK, "query_id long, text string")
    got = vec.keyword_search(docs, ask, 3, query_bytes=size)
    assert rows(got.select("query_id", "id", "rank", F.round("score", 6))) == bm25(3)


@pytest.mark.parametrize("block_docs", [3, 10_000])
def test_blocks_below_the_kth_score_are_skipped(spark, tables, block_docs):
    """The same hits whatever the blocks; small blocks are mostly passed over."""
    docs = tables.documents.select(F.col("doc_id").alias("id"), "text").coalesce(1)
    ask = tables.benchmark.select(F.col("item_id").alias("query_id"), "text")
    held = vec.build_postings(docs, block_docs=block_docs)
    words = ask.select("query_id", F.explode(F.array_distinct(vec.tokens("text"))).alias("word"))
    want = rows(vec.keyword_search(docs, ask, 3))
    assert rows(vec.search_postings(held, words, 3)) == want
    _, scorer = vec._scorer(words, held, 3, 1.2, 0.75)
    for r in held.rows.collect():
        assert len(r["ids"]) <= block_docs
        scorer.add({c: pa.array(r[c], pa.string() if c == "words" else pa.int64()) for c in r.asDict()})
    if block_docs == 3:
        assert 0 < scorer.scored < 0.7 * scorer.met
    else:
        assert scorer.scored == scorer.met


def test_word_frequencies(spark, tables):
    held = vec.build_postings(tables.documents, "doc_id", block_docs=7)
    split = tables.documents.select(F.explode(F.array_distinct(vec.tokens("text"))).alias("word"))
    assert rows(held.frequencies()) == rows(split.groupBy("word").count())
    assert held.n == tables.documents.count()


def test_hybrid_keeps_what_only_one_side_knows(spark):
    index = spark.createDataFrame(
        [(1, "red kite", [1.0, 0.0]), (2, "red barn", None), (3, None, [0.9, 0.1]), (4, "blue", [0.0, 1.0])], "id long, text string, embedding array<float>"
    )
    ask = spark.createDataFrame([(7, "red", [1.0, 0.0]), (8, "blue", None), (9, "none", [0.0, 1.0]), (10, None, None)], "query_id long, text string, embedding array<float>")
    found = {}
    for r in vec.hybrid_search(index, ask, 9).collect():
        found.setdefault(r["query_id"], set()).add(r["id"])
    assert found == {7: {1, 2, 3, 4}, 8: {4}, 9: {1, 3, 4}}


def test_fusion(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id long, id long, rank int")
    b = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], "query_id long, id long, rank int")
    assert [r["id"] for r in vec.fuse([a, b], 3).orderBy("rank").collect()] == [11, 10, 12]


def test_index_sync(spark):
    index = spark.createDataFrame([(1, "a"), (2, "b")], "id long, text string")
    feed = spark.createDataFrame(
        [(1, "a", "update_preimage", 5), (1, "A", "update_postimage", 5), (2, "b", "delete", 6), (3, "c", "insert", 6), (3, "c", "delete", 7)],
        "id long, text string, _change_type string, _commit_version int",
    )
    assert rows(vec.index_sync(index, feed, "id")) == [(1, "A")]


def test_scorers(spark):
    df = spark.createDataFrame([(1, "Answer: 42", "Answer: 42", 0.2), (2, "no", "yes", 3.0), (3, None, "x", None)],
                               "id int, out string, expected string, seconds double")
    scorers = {"number": ev.matches("out", r"\d+"), "same": ev.exact_match("out", "expected"), "fast": ev.within("seconds", 1.0)}
    got = {(r["id"], r["scorer"]): r["value"] for r in ev.score(df, ["id"], scorers).collect()}
    assert got == {(i, s): (1.0 if i == 1 else 0.0) for i in (1, 2, 3) for s in scorers}


def test_sample_is_repeatable(spark):
    df = spark.range(5000)
    first, second = ev.sampled(df, ["id"], 200), ev.sampled(df.repartition(7), ["id"], 200)
    assert rows(first) == rows(second)
    assert 800 < first.count() < 1200
