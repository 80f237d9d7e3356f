"""Vector and hybrid search, index upkeep and evaluation."""

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import vector as vec
from .registry import query

K = 10

#: Every twentieth row asks, all rows answer.
ASKED = """
    e AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    q AS (SELECT id AS query_id, v FROM e WHERE id % 20 = 0)"""


def asked(t):
    return t.embeddings.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def _rounded(df):
    return df.withColumn("distance", F.round("distance", 6))


@query("knn_exact", f"""
    WITH {ASKED} SELECT query_id, id, CAST(rank AS INT) AS rank, round(distance, 6) AS distance, label FROM (
      SELECT query_id, id, label, list_distance(q.v, e.v) AS distance,
             row_number() OVER (PARTITION BY query_id ORDER BY list_distance(q.v, e.v), id) AS rank FROM q, e) WHERE rank <= {K}""")
def knn_exact(t):
    return _rounded(vec.knn(t.embeddings, asked(t), K, key="vec_id", columns=["label"]))


@query("knn_exact_blocks", f"""
    WITH {ASKED} SELECT query_id, id, CAST(rank AS INT) AS rank, round(distance, 6) AS distance FROM (
      SELECT query_id, id, list_distance(q.v, e.v) AS distance,
             row_number() OVER (PARTITION BY query_id ORDER BY list_distance(q.v, e.v), id) AS rank FROM q, e) WHERE rank <= {K}""")
def knn_exact_blocks(t):
    """Queries in chunks of a few kilobytes."""
    return _rounded(vec.knn(t.embeddings, asked(t), K, key="vec_id", query_bytes=16_384))


@query("knn_cosine", f"""
    WITH {ASKED}, n AS (SELECT id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS v FROM e),
    m AS (SELECT query_id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS v FROM q)
    SELECT query_id, id, CAST(rank AS INT) AS rank, round(distance, 6) AS distance FROM (
      SELECT query_id, id, list_distance(m.v, n.v) AS distance,
             row_number() OVER (PARTITION BY query_id ORDER BY list_distance(m.v, n.v), id) AS rank FROM m, n) WHERE rank <= {K}""")
def knn_cosine(t):
    return _rounded(vec.knn(t.embeddings, asked(t), K, metric="cosine", key="vec_id"))


@query("knn_filtered", f"""
    WITH {ASKED} SELECT query_id, id, CAST(rank AS INT) AS rank, round(distance, 6) AS distance FROM (
      SELECT query_id, id, list_distance(q.v, e.v) AS distance,
             row_number() OVER (PARTITION BY query_id ORDER BY list_distance(q.v, e.v), id) AS rank FROM q, e WHERE e.label = 3)
    WHERE rank <= {K}""")
def knn_filtered(t):
    return _rounded(vec.knn(t.embeddings, asked(t), K, key="vec_id", where="label = 3"))


@query("knn_ann")
def knn_ann(t):
    """Neighbours out of a quarter of the cells; what share of them is right is ``knn_ann_recall``."""
    return _rounded(vec.knn_ann(t.embeddings, asked(t), K, key="vec_id"))


@query("knn_ann_recall", f"SELECT count(*) * {K} AS wanted, true AS enough FROM embeddings WHERE vec_id % 20 = 0")
def knn_ann_recall(t):
    near, exact = (f(t.embeddings, asked(t), K, key="vec_id") for f in (vec.knn_ann, vec.knn))
    return vec.recall(near, exact).select("wanted", (F.col("recall") >= 0.9).alias("enough"))


BM25 = """
    docs AS (SELECT doc_id AS id, list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '') AS w
             FROM documents {where}),
    ask AS (SELECT item_id AS query_id, unnest(list_distinct(list_filter(string_split(
              regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> ''))) AS word FROM benchmark {ask}),
    size AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM docs),
    tf AS (SELECT id, word, count(*) AS f, any_value(len) AS len FROM (SELECT id, unnest(w) AS word, len(w) AS len FROM docs) GROUP BY ALL),
    idf AS (SELECT word, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, size GROUP BY word, n),
    bm AS (SELECT query_id, id, round(sum(idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len / mean))), 9) AS score
           FROM ask JOIN tf USING (word) JOIN idf USING (word), size GROUP BY ALL),
    kw AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM bm)"""


@query("keyword_search", f"""
    WITH {BM25.format(where='', ask='')} SELECT query_id, id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM kw WHERE rank <= {K}""")
def keyword_search(t):
    found = vec.keyword_search(t.documents, t.benchmark, K, key="doc_id", query_key="item_id")
    return found.withColumn("score", F.round("score", 6))


@query("keyword_search_blocks", f"""
    WITH {BM25.format(where='', ask='')} SELECT query_id, id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM kw WHERE rank <= {K}""")
def keyword_search_blocks(t):
    """Queries in chunks of a kilobyte against blocks of few documents, most of which are skipped."""
    found = vec.keyword_search(t.documents, t.benchmark, K, key="doc_id", query_key="item_id", query_bytes=16_384, block_docs=16)
    return found.withColumn("score", F.round("score", 6))


@query("hybrid_search", f"""
    WITH {BM25.format(where='', ask='')},
    e AS (SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
    q AS (SELECT id AS query_id, v FROM e WHERE id % 20 = 0),
    vr AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY list_distance(q.v, e.v), id) AS rank FROM q, e),
    f AS (SELECT query_id, id, round(sum(part), 9) AS score FROM (
            SELECT query_id, id, 1.0::DOUBLE / (rank + 60) AS part FROM kw WHERE rank <= 50
            UNION ALL SELECT query_id, id, 1.0::DOUBLE / (rank + 60) FROM vr WHERE rank <= 50) GROUP BY ALL)
    SELECT query_id, id, score, CAST(rank AS INT) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM f) WHERE rank <= {K}""")
def hybrid_search(t):
    """All documents and vectors, all questions and every twentieth vector as one more; who lacks one side keeps the other."""
    vectors = t.embeddings.select(F.col("vec_id").alias("id"), "embedding")
    index = t.documents.select(F.col("doc_id").alias("id"), "text").join(vectors, "id", "full")
    questions = t.benchmark.select(F.col("item_id").alias("query_id"), "text")
    return vec.hybrid_search(index, questions.join(asked(t), "query_id", "full"), K)


@query("index_sync", """
    SELECT vec_id, label, 64 AS dims FROM embeddings WHERE label <> 4 AND label <> 7
    UNION ALL SELECT vec_id, label + 100, 64 FROM embeddings WHERE label = 4""")
def index_sync(t):
    rows = t.embeddings
    index = rows.filter("label <> 4 OR vec_id % 2 = 0")

    def change(where, kind, version):
        return rows.filter(where).withColumn("_change_type", F.lit(kind)).withColumn("_commit_version", F.lit(version))

    feed = (
        change("label = 4", "insert", 1)
        .unionAll(change("label = 4", "update_preimage", 2))
        .unionAll(change("label = 4", "update_postimage", 2).withColumn("label", F.col("label") + 100))
        .unionAll(change("label = 7", "delete", 2))
    )
    synced = vec.index_sync(index, feed, "vec_id")
    return synced.select("vec_id", "label", F.size("embedding").alias("dims"))


@query("batch_score", """
    SELECT c_custkey, round(0.3 * c_acctbal + 2 * c_nationkey, 4) AS score FROM customer""")
def batch_score(t):
    def model(frame):
        return 0.3 * frame["c_acctbal"] + 2 * frame["c_nationkey"]

    rows = t.customer.select("c_custkey", "c_acctbal", "c_nationkey")
    scored = vec.batch_score(rows, model, ["c_acctbal", "c_nationkey"], "score")
    return scored.select("c_custkey", F.round("score", 4).alias("score"))


def _scorers():
    return {
        "has_question": ev.matches("text", r"\?"),
        "is_assistant": ev.exact_match("role", F.lit("assistant")),
        "short": ev.within(F.length("text"), 400),
    }


@query("eval_scorers", """
    SELECT role, scorer, count(*) AS n, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high FROM (
      SELECT role, 'has_question' AS scorer, CAST(contains(text, '?') AS DOUBLE) AS value FROM conversations
      UNION ALL SELECT role, 'is_assistant', CAST(trim(role) = 'assistant' AS DOUBLE) FROM conversations
      UNION ALL SELECT role, 'short', CAST(length(text) <= 400 AS DOUBLE) FROM conversations) GROUP BY ALL""")
def eval_scorers(t):
    scores = ev.score(t.conversations, ["conv_id", "turn", "role"], _scorers())
    return ev.summarise(scores, ["role"])


@query("eval_labels", """
    SELECT scorer, count(*) AS n, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high FROM (
      SELECT 'agrees' AS scorer, CAST(quality = CAST(n_chars > 500 AS INT) AS DOUBLE) AS value FROM labels JOIN documents USING (doc_id)
      UNION ALL SELECT 'clean', CAST(toxic = 0 AS DOUBLE) FROM labels JOIN documents USING (doc_id)) GROUP BY 1""")
def eval_labels(t):
    joined = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    scorers = {
        "agrees": ev.exact_match(F.col("quality").cast("string"), (F.col("n_chars") > 500).cast("int").cast("string")),
        "clean": ev.within("toxic", 0),
    }
    return ev.summarise(ev.score(joined, ["doc_id"], scorers))


@query("eval_sample", """
    SELECT conv_id, turn, role FROM conversations
    WHERE CAST('0x' || substr(md5(conv_id || '|' || turn), 1, 7) AS BIGINT) % 1000 < 250""")
def eval_sample(t):
    return ev.sampled(t.conversations.select("conv_id", "turn", "role"), ["conv_id", "turn"], 250)


@query("eval_trace_spans", """
    SELECT conv_id, count(*) AS answer_spans, round(sum(length(text)), 6) AS answer_total, max(length(text)) AS answer_max
    FROM conversations WHERE role = 'assistant' GROUP BY 1""")
def eval_trace_spans(t):
    # A trace is a question with its answers: spans of several kinds, at most six turns, however long the conversation.
    span = F.struct("turn", F.col("role").alias("kind"), F.length("text").alias("size"))
    traces = t.conversations.groupBy("conv_id", F.floor(F.col("turn") / 6).alias("part")).agg(F.array_sort(F.collect_list(span)).alias("spans"))
    return ev.span_scores(traces, "conv_id", "spans", "assistant", F.col("span.size"), "answer")


@query("eval_compare", """
    WITH s AS (SELECT conv_id % 2 AS version, 'short' AS scorer, CAST(length(text) <= 400 AS DOUBLE) AS value FROM conversations
               UNION ALL SELECT conv_id % 2, 'has_question', CAST(contains(text, '?') AS DOUBLE) FROM conversations
               UNION ALL SELECT conv_id % 2, 'is_assistant', CAST(role = 'assistant' AS DOUBLE) FROM conversations),
    m AS (SELECT scorer, round(avg(value) FILTER (version = 0), 6) AS baseline, round(avg(value) FILTER (version = 1), 6) AS candidate
          FROM s GROUP BY 1)
    SELECT *, round(candidate - baseline, 6) AS delta, candidate < baseline - 0.01 AS regressed FROM m""")
def eval_compare(t):
    rows = t.conversations.withColumn("version", F.col("conv_id") % 2)
    scores = ev.score(rows, ["conv_id", "turn", "version"], _scorers())
    return ev.compare_versions(scores, "version", 0, 1, tolerance=0.01)
