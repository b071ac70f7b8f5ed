import datetime as dt

import pytest
from pyspark.sql import functions as F

from rowloom.functions import sql as sql_fn
from rowloom.functions import structured
from rowloom.operators import assessments, groups, relational

LOG = "row_id long, request_id string, step_id string, source struct<id:string>, timestamp timestamp, text_assessment string, retrieval_assessment string"


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def log(spark):
    rows = [
        (1, "r", None, ("a",), at(1), "first", None),
        (2, "r", None, ("b",), at(2), "second", None),
        (3, "r", None, ("a",), at(3), None, None),
        (4, "r", "1", ("b",), at(4), None, "x"),
        (5, "r", "1", ("b",), at(5), None, "y"),
        (6, "r", "2", ("b",), at(6), None, "z"),
        (7, "s", "1", ("c",), at(7), None, "only"),
        (8, "q", None, ("a",), at(8), "alone", None),
    ]
    return spark.createDataFrame(rows, LOG)


def test_latest_text_assessment(spark):
    rows = assessments.latest_text_assessments(log(spark)).collect()
    assert {(r["request_id"], r["source"]["id"], r["text_assessment"]) for r in rows} == {("r", "b", "second"), ("q", "a", "alone")}


def test_retrieval_assessments(spark):
    rows = assessments.retrieval_assessments(log(spark)).collect()
    found = {(r["request_id"], r["source"]["id"], r["step_id"]): r["retrieval_assessments"] for r in rows}
    assert found == {("r", "b", "1"): ["x", "y"], ("r", "b", "2"): ["z"], ("s", "c", "1"): ["only"]}


@pytest.mark.parametrize("coalesce", [False, True])
def test_merge(spark, coalesce):
    rows = log(spark)
    merged = assessments.merge_assessments(
        assessments.latest_text_assessments(rows), assessments.retrieval_assessments(rows), coalesce
    )
    found = sorted(
        (r["request_id"] or "", r["source"]["id"] if r["source"] else "", r["text_assessment"] or "", r["retrieval_assessments"] or [])
        for r in merged.collect()
    )
    lost = ("s", "c", "", ["only"]) if coalesce else ("", "", "", ["only"])
    assert found == sorted([lost, ("q", "a", "alone", []), ("r", "b", "second", ["x", "y"]), ("r", "b", "second", ["z"])])


def test_merge_equals_full_join(spark):
    """Against Spark's own full outer join, with NULL keys and repeated steps."""
    import random

    rng = random.Random(3)
    rows = [
        (
            i,
            rng.choice([None, "a", "b", "c", "d"]),
            str(rng.randrange(3)),
            (rng.choice(["x", "y", None]),),
            at(rng.randrange(60)),
            rng.choice([None, f"t{i}"]),
            rng.choice([None, f"r{i}"]),
        )
        for i in range(300)
    ]
    table = spark.createDataFrame(rows, LOG)
    texts, lists = assessments.latest_text_assessments(table), assessments.retrieval_assessments(table)
    right = lists.select(
        F.col("request_id").alias("rq"), F.col("source.id").alias("rs"), "step_id", "part", "retrieval_assessments"
    )
    left = texts.drop("retrieval_assessment", "step_id")
    plain = left.join(right, (left.request_id == right.rq) & (left.source.id == right.rs), "full").drop("rq", "rs")
    ours = assessments.merge_assessments(texts, lists)
    assert ours.columns == plain.columns
    assert sorted(map(str, ours.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("broadcast_keys", [100_000, 0])
def test_large_groups_come_in_parts(spark, monkeypatch, broadcast_keys):
    monkeypatch.setattr(groups, "BROADCAST_KEYS", broadcast_keys)
    rows = [(i, "hot" if i % 3 else None, str(i)) for i in range(900)] + [(9000 + i, f"k{i % 50}", str(i)) for i in range(100)]
    frame = spark.createDataFrame(rows, "row_id long, key string, v string")
    parted = groups.with_parts(frame, ["key"], ["row_id"], max_rows=100)
    sizes = {(r["key"], r["part"]): r["n"] for r in parted.groupBy("key", "part").agg(F.count("*").alias("n")).collect()}
    assert max(sizes.values()) < 200
    for key, n in (("hot", 600), (None, 300)):
        parts = sorted(p for k, p in sizes if k == key)
        assert parts == list(range(len(parts))) and len(parts) >= n // 200
        found = parted.where(F.col("key").eqNullSafe(key)).select("part", "row_id").collect()
        assert [r["row_id"] for r in sorted(found)] == sorted(r["row_id"] for r in found)
    assert all(part == 0 for key, part in sizes if key not in ("hot", None))
    assert sorted(tuple(r) for r in parted.drop("part").select("row_id", "v").collect()) == sorted((r[0], r[2]) for r in rows)


def test_confusion_matrix(spark):
    rows = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, None), (None, 1)], "gt int, pred int")
    expect = {0: (1, 1), 1: (0, 1)}
    for values in ([0, 1], None):
        found = relational.confusion_matrix(rows, "gt", "pred", values)
        assert found.columns == ["gt", "pred_0", "pred_1"] + (["pred_other"] if values else [])
        assert {r["gt"]: (r["pred_0"], r["pred_1"]) for r in found.collect()} == expect


def test_confusion_matrix_counts_predictions_outside_the_values(spark):
    rows = spark.createDataFrame([(0, 0), (0, 7)], "gt int, pred int")
    assert [tuple(r) for r in relational.confusion_matrix(rows, "gt", "pred", [0, 1, 2]).collect()] == [(0, 1, 0, 0, 1)]


def test_value_counts(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "v string")
    assert [tuple(r) for r in relational.value_counts(rows, "v").collect()] == [("b", 2), ("a", 1), ("c", 1)]


def test_versions_beyond_32_bits(spark):
    rows = spark.createDataFrame([("m", "9"), ("m", "20240101120000")], "name string, version string")
    assert relational.latest_version(rows, "name", "version").first()["latest"] == 20240101120000


def test_latest_version(spark):
    rows = spark.createDataFrame([("m", "9"), ("m", "10"), ("none", None)], "name string, version string")
    assert {tuple(r) for r in relational.latest_version(rows, "name", "version").collect()} == {("m", 10), ("none", 1)}
    assert {tuple(r) for r in relational.latest_version(rows, "name", "version", None).collect()} == {("m", 10), ("none", None)}
    assert {tuple(r) for r in relational.latest_row(rows, "name", "version", "version").collect()} == {("m", "10"), ("none", None)}


def test_purchases(spark):
    spark.createDataFrame([(i % 12,) for i in range(70)] + [(None,), (99,)], "destination_id int").createOrReplaceTempView("buys")
    spark.createDataFrame([(i, f"place {i:02d}") for i in range(12)], "destination_id int, name string").createOrReplaceTempView("places")
    relational.purchase_location_function(spark, "buys", "places", "best_places")
    frame = spark.sql("SELECT * FROM best_places()")
    assert frame.dtypes == [("name", "string"), ("purchases", "int")]
    assert [tuple(r) for r in frame.collect()] == [(f"place {i:02d}", 6) for i in range(10)]


def test_stable_sample(spark):
    rows = spark.range(1000)
    one = relational.stable_sample(rows, "id", 10).collect()
    other = relational.stable_sample(rows.repartition(13), "id", 10).collect()
    assert sorted(one) == sorted(other) and 60 < len(one) < 140
    assert relational.seeded_sample(rows, 0.1, 2, 10).count() == 10


def test_split_is_whole(spark):
    rows = relational.split_train_val(spark.range(1000), "id").groupBy("split").count().collect()
    sizes = {r["split"]: r["count"] for r in rows}
    assert sum(sizes.values()) == 1000 and 140 < sizes["val"] < 260


def test_guard(spark):
    rows = spark.createDataFrame([(1,), (2,)], "v int")
    assert relational.guard(rows, F.col("v") > 0, "must be positive").count() == 2
    with pytest.raises(Exception, match="must be positive"):
        relational.guard(rows, F.col("v") > 1, "must be positive").collect()


def test_structured(spark):
    rows = spark.createDataFrame(
        [(1, '{"sentiment":"1"}'), (2, '{"sentiment":"7"}'), (3, "bull"), (4, None)], "id int, r string"
    )
    flat = structured.flatten_response(rows, "r", structured.SENTIMENT_SCORE, ["id"]).orderBy("id").collect()
    assert [r["problem"] for r in flat] == ["ok", "not allowed sentiment", "malformed", "malformed"]
    values = rows.select(structured.json_long(F.col("r"), "sentiment").alias("v")).collect()
    assert [r["v"] for r in values] == [1, 7, None, None]
    counts = structured.format_compliance(rows, "r", structured.SENTIMENT_SCORE).collect()
    assert {tuple(r) for r in counts} == {("ok", 1), ("not allowed sentiment", 1), ("malformed", 2)}


def test_required_field(spark):
    schema = structured.text_analysis(("AAPL",))
    whole = '{"sentiment":"1","summary":"s","key_tickers":"AAPL","impact_level":"low"}'
    rows = spark.createDataFrame([(whole,), (whole.replace('"summary":"s",', ""),), (whole.replace("low", "huge"),)], "r string")
    flat = structured.flatten_response(rows, "r", schema, [])
    assert [r["problem"] for r in flat.collect()] == ["ok", "missing summary", "not allowed impact_level"]


def test_function_registry(spark):
    sql_fn.create_scalar_function(spark, "reg_up", "x STRING", "STRING", "upper(x)", "it's upper case")
    sql_fn.create_table_function(spark, "reg_rows", "n BIGINT", "SELECT id FROM range(2)", "two rows")
    found = sql_fn.function_registry(spark, "reg_")
    assert {tuple(r) for r in found.collect()} == {("reg_up", "scalar", "it's upper case"), ("reg_rows", "table", "two rows")}
    tools = found.unionByName(spark.createDataFrame([("docs", "retriever", "")], found.schema))
    resources = {tuple(r) for r in sql_fn.tool_resources(tools, "chat").collect()}
    assert resources == {("model endpoint", "chat"), ("function", "reg_up"), ("function", "reg_rows"), ("vector index", "docs")}
