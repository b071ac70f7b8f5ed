"""Embeddings, indexes and similarity search over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.operators import approximate, index_store, inference, vectors
from rowloom.plans.documents import WINDOWS_SQL, documents, windows
from rowloom.plans.registry import query, table, words_sql
from rowloom.session import materialise, scratch_path


def _embedding_sql(source, keys, dim):
    """``keys, bucket, weight`` of the hashed word counts, scaled to length one."""
    return f"""SELECT {keys}, bucket, CAST(n / length AS FLOAT) AS weight FROM (
                 SELECT {keys}, bucket, n, sqrt(sum(n * n) OVER (PARTITION BY {keys})) AS length FROM (
                   SELECT {keys}, CAST('0x' || substr(md5(word), 1, 4) AS INTEGER) % {dim} AS bucket, count(*) AS n
                   FROM (SELECT {keys}, unnest({words_sql('text')}) AS word FROM {source}) GROUP BY {keys}, bucket))"""


def embed(df, dim, text="text", out="embedding"):
    return df.withColumn(out, inference.vector_function(inference.HashingEmbedder(dim))(text))


def _entries(df, *keys):
    """One row per non-zero entry of each vector."""
    return (
        df.select(*keys, F.posexplode("embedding").alias("bucket", "weight"))
        .where("weight <> 0")
        .select(*keys, "bucket", F.round(F.col("weight").cast("double"), 6).alias("weight"))
    )


@query(
    f"""SELECT doc_id, pos, bucket, round(CAST(weight AS DOUBLE), 6) AS weight
        FROM ({_embedding_sql(f'(SELECT doc_id, pos, content AS text FROM ({WINDOWS_SQL}))', 'doc_id, pos', 16)})"""
)
def embed_chunks(spark, folder):
    """All chunks of all documents through the embedding model, 150 a call."""
    chunks = windows(documents(spark, folder, "text"))
    return _entries(embed(chunks, 16, "content"), "doc_id", "pos")


@query(
    """SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) AS dim,
              round(embedding[1] / sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 6) AS first,
              1.0::DOUBLE AS norm
       FROM embeddings"""
)
def index_build(spark, folder):
    index = vectors.build_index(table(spark, folder, "embeddings"), "vec_id", "embedding", 64)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x * x))
    return index.select(
        "id", F.size("embedding").alias("dim"), F.round(F.col("embedding")[0], 6).alias("first"), F.round(norm, 6).alias("norm")
    )


@query(
    f"""SELECT doc_id AS id, bucket, round(weight / sqrt(sum(CAST(weight AS DOUBLE) * weight) OVER (PARTITION BY doc_id)), 6) AS weight
        FROM ({_embedding_sql('documents', 'doc_id', 64)})"""
)
def index_from_text(spark, folder):
    """An index made from a text column in one job."""
    index = vectors.build_index(embed(documents(spark, folder, "text"), 64), "doc_id", "embedding", 64)
    return _entries(index, "id")


def _index(spark, folder):
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


TOPK_SQL = """WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    sims AS (SELECT q.vec_id AS query_id, i.vec_id AS vec_id, round(list_cosine_similarity(q.e, i.e), 6) AS sim
             FROM v q JOIN v i ON q.vec_id <> i.vec_id),
    ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS INTEGER) AS rank,
                      vec_id, sim FROM sims)
    SELECT query_id, rank, vec_id, sim FROM ranked WHERE rank <= 5"""


def neighbours(spark, folder, **how):
    index = _index(spark, folder)
    return vectors.top_k(index, index, 5, skip_self=True, **how)


@query(TOPK_SQL)
def vector_topk(spark, folder):
    """The five nearest other vectors of every vector."""
    return neighbours(spark, folder).withColumnRenamed("id", "vec_id")


@query(TOPK_SQL)
def vector_topk_cells(spark, folder):
    """The same by the way for many queries: cells, bounds and equi-joins of their pieces."""
    return neighbours(spark, folder, broadcast_queries=0).withColumnRenamed("id", "vec_id")


@query(TOPK_SQL)
def vector_topk_tree(spark, folder):
    """The same by a tree with small leaves, so that the queries visit leaves within their bounds."""
    return neighbours(spark, folder, broadcast_queries=0, leaf_rows=256).withColumnRenamed("id", "vec_id")


@query()
def approx_topk(spark, folder):
    """The five nearest other vectors of every vector that lists and codes find, of the recall that calibration sets."""
    index = _index(spark, folder)
    found = approximate.search(index, index, approximate.build(index, k=5), 5, skip_self=True)
    return found.withColumnRenamed("id", "vec_id")


@query(
    f"""SELECT count(DISTINCT query_id) AS queries, (SELECT count(*) FROM embeddings) AS coded, true AS recall_reached, 0::BIGINT AS wrong
        FROM ({TOPK_SQL})"""
)
def approx_recall(spark, folder):
    """The same beside the exact search: rows coded, whether 0.9 of the neighbours are found, and similarities that are not the exact ones."""
    index = _index(spark, folder)
    coded = approximate.build(index, k=5)
    found = materialise(approximate.search(index, index, coded, 5, skip_self=True, broadcast_queries=0), "found")
    exact = materialise(approximate.search(index, index, coded, 5, skip_self=True, exact=True), "exact")
    both = found.join(exact.withColumnRenamed("sim", "exact_sim"), ["query_id", "id"])
    wrong = both.agg(F.count_if(F.abs(F.col("sim") - F.col("exact_sim")) > 2e-6).alias("wrong"))
    shown = approximate.recall(found, exact).select("queries", (F.col("recall") >= 0.9).alias("recall_reached"))
    return shown.crossJoin(coded.rows.agg(F.count("*").alias("coded"))).crossJoin(wrong)  # one row each


_TEXT_TOPK_SQL = f"""WITH entries AS (
        {_embedding_sql("(SELECT 'q' AS side, item_id AS id, text FROM benchmark UNION ALL SELECT 'd', doc_id, text FROM documents)", 'side, id', 64)}),
    unit AS (SELECT side, id, bucket, weight / sqrt(sum(CAST(weight AS DOUBLE) * weight) OVER (PARTITION BY side, id)) AS w FROM entries),
    sims AS (SELECT q.id AS query_id, d.id AS doc_id, round(sum(q.w * d.w), 6) AS sim
             FROM unit q JOIN unit d ON q.bucket = d.bucket WHERE q.side = 'q' AND d.side = 'd' GROUP BY q.id, d.id),
    ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, doc_id) AS INTEGER) AS rank,
                      doc_id, sim FROM sims)
    SELECT query_id, rank, doc_id, sim FROM ranked WHERE rank <= 3"""


def _text_sides(spark, folder):
    questions = embed(table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text"), 64)
    docs = embed(documents(spark, folder, "text").select(F.col("doc_id").alias("id"), "text"), 64)
    return questions, docs


@query(_TEXT_TOPK_SQL)
def text_topk(spark, folder):
    """The three documents nearest to every benchmark text."""
    questions, docs = _text_sides(spark, folder)
    return vectors.top_k(questions, docs, 3).withColumnRenamed("id", "doc_id")


@query(f"SELECT t.query_id, t.rank, t.sim, t.doc_id AS id, d.lang, md5(d.text) AS h FROM ({_TEXT_TOPK_SQL}) t JOIN documents d USING (doc_id)")
def retrieve_batch(spark, folder):
    """The same with named columns of the documents found."""
    questions, docs = _text_sides(spark, folder)
    stored = table(spark, folder, "documents").withColumnRenamed("doc_id", "id")
    found = vectors.retrieve(questions, docs, stored, ["id", "lang", "text"], 3)
    return found.select("query_id", "rank", "sim", "id", "lang", F.md5("text").alias("h"))


@query(
    """SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS sim
       FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
)
def pair_similarity(spark, folder):
    """Each vector and its successor."""
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return rows.join(after, "vec_id").select("vec_id", vectors.cosine(F.col("embedding"), F.col("other")).alias("sim"))


@query(
    """WITH e AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(1, len(embedding) + 1)) AS d FROM embeddings),
            c AS (SELECT label, d, avg(x) AS m FROM e GROUP BY label, d),
            cn AS (SELECT label, sqrt(sum(m * m)) AS n FROM c GROUP BY label),
            en AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM e GROUP BY vec_id),
            s AS (SELECT e.vec_id, c.label, round(sum(e.x * c.m) / any_value(en.n * cn.n), 6) AS sim
                  FROM e JOIN c USING (d) JOIN cn ON cn.label = c.label JOIN en ON en.vec_id = e.vec_id GROUP BY e.vec_id, c.label)
       SELECT vec_id AS id, CAST(arg_max(label, (sim, -label)) AS BIGINT) AS predicted, max(sim) AS sim FROM s GROUP BY vec_id"""
)
def classify_nearest_centroid(spark, folder):
    return vectors.classify_nearest(table(spark, folder, "embeddings"), "vec_id", "embedding", "label")


def _versions(spark, folder):
    """Two versions of a table: one label leaves, one arrives, one has its vectors turned round."""
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vector"))
    old = rows.where("label <> 8")
    new = rows.where("label <> 9").withColumn("vector", F.when(F.col("label") == 3, F.reverse("vector")).otherwise(F.col("vector")))
    hashed = lambda df: df.withColumn("content_hash", vectors.content_hash("vector"))
    return hashed(old), hashed(new)


@query(
    """SELECT vec_id AS id, CASE label WHEN 8 THEN 'insert' WHEN 9 THEN 'delete' ELSE 'update' END AS action
       FROM embeddings WHERE label IN (3, 8, 9)"""
)
def index_sync(spark, folder):
    """What must change in an index made from the first version to serve the second."""
    old, new = _versions(spark, folder)
    return vectors.index_changes(old, new)


REFRESHED_SQL = """SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) AS dim,
              round(CASE label WHEN 3 THEN embedding[64] ELSE embedding[1] END
                    / sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 6) AS first
       FROM embeddings WHERE label <> 9"""


@query(REFRESHED_SQL)
def index_refresh(spark, folder):
    """The index brought up to date, vectors of unchanged rows kept."""
    old, new = _versions(spark, folder)

    def embed_rows(rows):
        return vectors.build_index(rows, "id", "vector", 64).join(rows.select("id", "content_hash"), "id")

    refreshed = vectors.sync_index(embed_rows(old), new, embed_rows)
    return refreshed.select("id", F.size("embedding").alias("dim"), F.round(F.col("embedding")[0], 6).alias("first"))


@query(REFRESHED_SQL)
def index_buckets(spark, folder):
    """The same by an index in buckets, made from the first version and synchronised with the second, of which it writes changed buckets."""
    old, new = _versions(spark, folder)
    path = scratch_path(spark, "index")

    def embed_rows(rows):
        return vectors.build_index(rows, "id", "vector", 64).join(rows.select("id", "content_hash"), "id")

    index_store.sync(spark, path, old, embed_rows)
    index_store.sync(spark, path, new, embed_rows)
    refreshed = index_store.read_index(spark, path)
    return refreshed.select("id", F.size("embedding").alias("dim"), F.round(F.col("embedding")[0], 6).alias("first"))
