"""Joins, counts, de-duplication, samples and scalar expressions over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.functions import sql as sql_fn
from rowloom.functions import structured
from rowloom.functions import text as text_fn
from rowloom.operators import assessments, inference, relational
from rowloom.plans.registry import query, table


@query(
    """SELECT n_name AS name, CAST(count(o_orderkey) AS INTEGER) AS purchases
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       GROUP BY n_name ORDER BY count(o_orderkey) DESC, n_name LIMIT 10"""
)
def purchase_location(spark, folder):
    """The ten nations with the most orders, through a SQL table function.

    Orders are counted per customer before they meet the customers.
    """
    orders = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    joined.select(F.col("c_nationkey").alias("destination_id"), "n").createOrReplaceTempView("rowloom_purchases")
    table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("destination_id"), F.col("n_name").alias("name")
    ).createOrReplaceTempView("rowloom_places")
    relational.purchase_location_function(spark, "rowloom_purchases", "rowloom_places", weight="n")
    return spark.sql("SELECT * FROM purchase_location()")


@query("SELECT event_type, count(*) AS n FROM events WHERE nullif(event_type, 'error') IS NOT NULL GROUP BY event_type")
def filter_not_null(spark, folder):
    """Events that are not errors, by way of a computed column that is NULL for errors."""
    events = table(spark, folder, "events").withColumn("kind", F.nullif("event_type", F.lit("error")))
    return events.where(F.col("kind").isNotNull()).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT * EXCLUDE (c_name, c_acctbal) FROM customer")
def star_except(spark, folder):
    table(spark, folder, "customer").createOrReplaceTempView("rowloom_customer")
    return spark.sql("SELECT * EXCEPT (c_name, c_acctbal) FROM rowloom_customer")


@query(
    """SELECT doc_id, CASE WHEN CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10 < 2
                           THEN 'val' ELSE 'train' END AS split
       FROM documents"""
)
def split_train_val(spark, folder):
    return relational.split_train_val(table(spark, folder, "documents"), "doc_id").select("doc_id", "split")


@query(
    """SELECT doc_id FROM documents WHERE CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 10 = 0
       ORDER BY doc_id LIMIT 10"""
)
def eval_sample(spark, folder):
    """A tenth of the documents by hash of the key, then the ten lowest keys."""
    return relational.stable_sample(table(spark, folder, "documents").select("doc_id"), "doc_id", 10, 10)


@query("SELECT event_type AS value, count(*) AS n FROM events GROUP BY event_type")
def value_counts(spark, folder):
    return relational.value_counts(table(spark, folder, "events"), "event_type")


@query(
    """SELECT quality, count(*) FILTER (WHERE n_chars <= 1000) AS pred_0, count(*) FILTER (WHERE n_chars > 1000) AS pred_1,
              0::BIGINT AS pred_other
       FROM documents JOIN labels USING (doc_id) GROUP BY quality"""
)
def confusion_matrix(spark, folder):
    """Labelled quality against a rule on length."""
    rule = F.when(F.col("n_chars") > 1000, 1).otherwise(0)
    scored = table(spark, folder, "documents").select("doc_id", rule.alias("pred"))
    labelled = scored.join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")
    return relational.confusion_matrix(labelled, "quality", "pred", [0, 1])


@query("SELECT p_type AS name, CAST(max(p_size) AS BIGINT) AS latest FROM part GROUP BY p_type")
def latest_version(spark, folder):
    """Sizes as text stand in for versions; text order and number order differ."""
    versions = table(spark, folder, "part").select(
        F.col("p_type").alias("name"), F.col("p_size").cast("string").alias("version")
    )
    return relational.latest_version(versions, "name", "version")


@query(
    """SELECT p_type AS name, max_by(p_partkey, p_size * 1000000000000 - p_partkey) AS p_partkey, max(p_size) AS version
       FROM part GROUP BY p_type"""
)
def latest_version_row(spark, folder):
    versions = table(spark, folder, "part").select(
        F.col("p_type").alias("name"), "p_partkey", F.col("p_size").cast("string").alias("version")
    )
    rows = relational.latest_row(versions, "name", "version", "p_partkey")
    return rows.withColumn("version", F.col("version").cast("int"))


def assessment_log(spark, folder):
    """Events as a log of assessments: even ones assess the text, odd ones a retrieval step."""
    even = F.col("event_id") % 2 == 0
    value = F.col("value").cast("string")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("row_id"),
        F.col("user_id").alias("request_id"),
        (F.col("event_id") % 3).alias("step_id"),
        F.struct(F.col("event_type").alias("id")).alias("source"),
        F.col("ts").alias("timestamp"),
        F.when(even, value).alias("text_assessment"),
        F.when(~even & (F.col("user_id") % 10 != 0), value).alias("retrieval_assessment"),
    )


_TEXT_SQL = """SELECT user_id AS request_id, arg_max(event_type, (ts, event_id)) AS source_id, max(ts) AS ts,
                      arg_max(CAST(value AS VARCHAR), (ts, event_id)) AS text_assessment
               FROM events WHERE event_id % 2 = 0 GROUP BY user_id"""
_RETRIEVAL_SQL = """SELECT user_id AS request_id, event_type AS source_id, event_id % 3 AS step_id, min(ts) AS ts,
                           string_agg(CAST(value AS VARCHAR), ',' ORDER BY ts, event_id) AS retrievals
                    FROM events WHERE event_id % 2 = 1 AND user_id % 10 <> 0 GROUP BY user_id, event_type, event_id % 3"""


@query(_TEXT_SQL)
def dedup_request_assessments(spark, folder):
    rows = assessments.latest_text_assessments(assessment_log(spark, folder))
    return rows.select(
        "request_id", F.col("source.id").alias("source_id"), F.col("timestamp").alias("ts"), "text_assessment"
    )


@query(_RETRIEVAL_SQL)
def dedup_retrieval_assessments(spark, folder):
    rows = assessments.retrieval_assessments(assessment_log(spark, folder))
    return rows.select(
        "request_id",
        F.col("source.id").alias("source_id"),
        "step_id",
        F.col("timestamp").alias("ts"),
        F.array_join("retrieval_assessments", ",").alias("retrievals"),
    )


def _merged(spark, folder, coalesce_keys):
    log = assessment_log(spark, folder)
    merged = assessments.merge_assessments(
        assessments.latest_text_assessments(log), assessments.retrieval_assessments(log), coalesce_keys
    )
    return merged.select(
        "request_id",
        F.col("source.id").alias("source_id"),
        F.col("timestamp").alias("ts"),
        "text_assessment",
        F.array_join("retrieval_assessments", ",").alias("retrievals"),
    )


@query(
    f"""SELECT t.request_id, t.source_id, t.ts, t.text_assessment, r.retrievals
        FROM ({_TEXT_SQL}) t FULL JOIN ({_RETRIEVAL_SQL}) r
             ON t.request_id = r.request_id AND t.source_id = r.source_id"""
)
def merge_assessments(spark, folder):
    return _merged(spark, folder, False)


@query(
    f"""SELECT coalesce(t.request_id, r.request_id) AS request_id, coalesce(t.source_id, r.source_id) AS source_id,
               t.ts, t.text_assessment, r.retrievals
        FROM ({_TEXT_SQL}) t FULL JOIN ({_RETRIEVAL_SQL}) r
             ON t.request_id = r.request_id AND t.source_id = r.source_id"""
)
def merge_assessments_keyed(spark, folder):
    return _merged(spark, folder, True)


@query(
    """SELECT 'documents' AS origin, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS total_chars FROM documents
       UNION ALL SELECT 'pages', count(*), CAST(sum(length(html)) AS BIGINT) FROM pages"""
)
def union_sources(spark, folder):
    docs = table(spark, folder, "documents").select(
        F.concat(F.lit("doc/"), F.col("doc_id")).alias("url"), F.col("text").alias("content")
    )
    pages = table(spark, folder, "pages").select("url", F.col("html").alias("content"))
    whole = relational.union_sources({"documents": docs, "pages": pages}, ["url", "content"])
    return whole.groupBy("origin").agg(F.count("*").alias("n"), F.sum(F.length("content")).alias("total_chars"))


@query(
    """SELECT event_id, TRY_CAST(props ->> '$.k' AS BIGINT) AS k,
              2 * TRY_CAST(props ->> '$.k' AS BIGINT) AS k2, TRY_CAST(props ->> '$.none' AS BIGINT) AS none
       FROM events"""
)
def lateral_json_fields(spark, folder):
    """A later item of the select list reads an earlier one."""
    table(spark, folder, "events").createOrReplaceTempView("rowloom_events")
    return spark.sql(
        """SELECT event_id, try_cast(get_json_object(props, '$.k') AS LONG) AS k, 2 * k AS k2,
                  try_cast(get_json_object(props, '$.none') AS LONG) AS none
           FROM rowloom_events"""
    )


@query("SELECT event_id, TRY_CAST(props ->> '$.k' AS BIGINT) AS k FROM events")
def json_fields(spark, folder):
    return table(spark, folder, "events").select("event_id", structured.json_long(F.col("props"), "k").alias("k"))


@query("SELECT c_custkey, 'Classify 100% of this.' || c_name AS prompt FROM customer")
def build_prompt(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", inference.build_prompt("Classify 100% of this.", F.col("c_name")).alias("prompt")
    )


@query(
    """SELECT c_custkey, c_name || ' ' || c_mktsegment || ' lives at ' || n_name AS spaced,
              c_name || '' || c_mktsegment || ' lives at ' || n_name AS unspaced
       FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def concat_fields(spark, folder):
    rows = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    tail = (F.col("c_mktsegment"), F.lit(" lives at "), F.col("n_name"))
    return rows.select(
        "c_custkey", F.concat("c_name", F.lit(" "), *tail).alias("spaced"), F.concat("c_name", *tail).alias("unspaced")
    )


@query("SELECT event_id, event_type IN ('click', 'view') AS ok FROM events")
def label_in_set(spark, folder):
    return relational.label_in_set(table(spark, folder, "events"), "event_type", ["click", "view"]).select("event_id", "ok")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def exists_in(spark, folder):
    """Customers with a finished order."""
    finished = table(spark, folder, "orders").where("o_orderstatus = 'F'").select("o_custkey").distinct()
    return relational.exists_in(table(spark, folder, "customer").select("c_custkey", "c_name"), "c_custkey", finished, "o_custkey")


@query("SELECT o_orderkey, contains(upper(o_orderpriority), 'URGENT') AS state FROM orders")
def status_match(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", text_fn.status_matches(F.col("o_orderpriority"), "urgent").alias("state")
    )


@query("SELECT c_custkey, 'Segment: ' || upper(c_mktsegment) AS v FROM customer")
def sql_scalar_fn(spark, folder):
    """A stored SQL function called on a column."""
    table(spark, folder, "customer").createOrReplaceTempView("rowloom_customer")
    sql_fn.create_scalar_function(
        spark, "rowloom_segment", "value STRING", "STRING", "concat(format_string('Segment: '), upper(value))", "Segment in capitals"
    )
    return spark.sql("SELECT c_custkey, rowloom_segment(c_mktsegment) AS v FROM rowloom_customer")


@query("SELECT doc_id, n_chars FROM documents WHERE n_chars >= 0")
def assert_guard(spark, folder):
    """All documents, or a failure naming the rule a document breaks."""
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    return relational.guard(docs, F.col("n_chars") >= 0, "a length is negative")
