"""Models over documents, their answers checked and scored; correction and classification by table."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import functions as F

from rowloom.functions import structured
from rowloom.operators import fuzzy, inference, relational
from rowloom.plans.documents import documents
from rowloom.plans.registry import query, table
from rowloom.session import materialise, scratch_path
from rowloom.sources.commits import CommittedTable

# The prompt and the models below share no letters the models look for.
PROMPT = "Class 0, 1 or 2: "


def keyword_model(prompts):
    """A stand-in model: the class depends on words the prompt contains."""
    return ["0" if "und" in p else "1" if "que" in p else "2" for p in prompts]


_CLASS_SQL = "CASE WHEN contains(text, 'und') THEN '0' WHEN contains(text, 'que') THEN '1' ELSE '2' END"


@query(f"SELECT doc_id, {_CLASS_SQL} AS pred FROM documents")
def batch_classify(spark, folder):
    docs = documents(spark, folder, "text")
    return inference.batch_infer(docs, inference.build_prompt(PROMPT, F.col("text")), keyword_model, "pred").select(
        "doc_id", "pred"
    )


@query(f"SELECT doc_id, {_CLASS_SQL} AS pred FROM documents")
def sql_model_fn(spark, folder):
    """The model called from SQL, inside a stored function."""
    spark.udf.register("rowloom_keyword_model", inference.text_function(keyword_model))
    documents(spark, folder, "text").createOrReplaceTempView("rowloom_documents")
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION rowloom_classify(value STRING) RETURNS STRING
            RETURN rowloom_keyword_model(concat('{PROMPT}', value))"""
    )
    return spark.sql("SELECT doc_id, rowloom_classify(text) AS pred FROM rowloom_documents")


def json_model(prompts):
    """A stand-in model that answers in JSON, now and then in a wrong form."""
    answers = []
    for p in prompts:
        if "tion" in p:
            answers.append(json.dumps({"sentiment": "7"}) if "und" in p else "bull")
        else:
            answers.append(json.dumps({"sentiment": "0" if "und" in p else "1" if "que" in p else "2"}))
    return answers


_STRUCTURED_SQL = """SELECT doc_id,
    CASE WHEN contains(text, 'tion') THEN CASE WHEN contains(text, 'und') THEN 7 END
         WHEN contains(text, 'und') THEN 0 WHEN contains(text, 'que') THEN 1 ELSE 2 END AS pred_value,
    CASE WHEN NOT contains(text, 'tion') THEN 'ok' WHEN contains(text, 'und') THEN 'not allowed sentiment'
         ELSE 'malformed' END AS problem
    FROM documents"""


def _json_answers(spark, folder):
    docs = documents(spark, folder, "text")
    return inference.batch_infer(docs, inference.build_prompt(PROMPT, F.col("text")), json_model).select("doc_id", "response")


@query(f"SELECT doc_id, CAST(pred_value AS BIGINT) AS pred_value, problem FROM ({_STRUCTURED_SQL})")
def structured_classify(spark, folder):
    flat = structured.flatten_response(_json_answers(spark, folder), "response", structured.SENTIMENT_SCORE, ["doc_id"])
    return flat.select("doc_id", F.col("sentiment").try_cast("long").alias("pred_value"), "problem")


@query(f"SELECT problem AS reason, count(*) AS n FROM ({_STRUCTURED_SQL}) GROUP BY problem")
def format_compliance(spark, folder):
    return structured.format_compliance(_json_answers(spark, folder), "response", structured.SENTIMENT_SCORE)


@query(
    f"""SELECT quality, count(*) FILTER (WHERE problem = 'ok' AND pred_value = 0) AS pred_0,
               count(*) FILTER (WHERE problem = 'ok' AND pred_value = 1) AS pred_1,
               count(*) FILTER (WHERE problem = 'ok' AND pred_value = 2) AS pred_2,
               count(*) FILTER (WHERE problem <> 'ok') AS pred_other
        FROM ({_STRUCTURED_SQL}) JOIN labels USING (doc_id) GROUP BY quality"""
)
def score_predictions(spark, folder):
    """Predictions written once, then scored against the labels; answers with a problem count as other."""
    answers = materialise(_json_answers(spark, folder), "answers")
    flat = structured.flatten_response(answers, "response", structured.SENTIMENT_SCORE, ["doc_id"])
    judged = flat.withColumn("sentiment", F.when(F.col("problem") == "ok", F.col("sentiment")).otherwise("invalid"))
    labelled = judged.join(table(spark, folder, "labels"), "doc_id")
    return relational.confusion_matrix(labelled, "quality", "sentiment", ["0", "1", "2"])


TICKERS = ("AAPL", "AMZN", "GOOGL", "MSFT")
ANALYSIS = structured.text_analysis(TICKERS)


def analysis_model(prompts):
    """A stand-in model with four fields; a text without ``que`` gets no summary."""
    answers = []
    for p in prompts:
        text = p[len(PROMPT) :]
        answer = {
            "sentiment": "0" if "und" in text else "1",
            "key_tickers": TICKERS[len(text) % 4],
            "impact_level": "low" if len(text) < 500 else "medium" if len(text) < 2000 else "high",
        }
        if "que" in text:
            answer["summary"] = text[:50]
        answers.append(json.dumps(answer))
    return answers


@query(
    """SELECT doc_id, CASE WHEN contains(text, 'und') THEN '0' ELSE '1' END AS sentiment,
              CASE WHEN contains(text, 'que') THEN substr(text, 1, 50) END AS summary,
              ['AAPL', 'AMZN', 'GOOGL', 'MSFT'][length(text) % 4 + 1] AS key_tickers,
              CASE WHEN length(text) < 500 THEN 'low' WHEN length(text) < 2000 THEN 'medium' ELSE 'high' END AS impact_level,
              CASE WHEN contains(text, 'que') THEN 'ok' ELSE 'missing summary' END AS problem
       FROM documents"""
)
def structured_multi_field(spark, folder):
    docs = documents(spark, folder, "text")
    answers = inference.batch_infer(docs, inference.build_prompt(PROMPT, F.col("text")), analysis_model)
    return structured.flatten_response(answers, "response", ANALYSIS, ["doc_id"])


# One field of each type.
TYPED = structured.ResponseSchema(
    ("label", "n", "share", "urgent", "tags"),
    {"label": ("blue", "green", "red")},
    required=("label", "n"),
    types={"n": "integer", "share": "number", "urgent": "boolean", "tags": "array"},
)


def constrained_model(prompts, response_format):
    """A stand-in model that fills in the schema it is given: it knows no field, only what types and values are asked for."""
    schema = response_format["json_schema"]["schema"]

    def fill(kind, size):
        if "enum" in kind:
            return kind["enum"][size % len(kind["enum"])]
        return {"integer": size, "number": size / 4, "boolean": size % 2 == 0, "array": ["a"] * (size % 3), "string": "x" * (size % 5)}[kind["type"]]

    answers = []
    for prompt in prompts:
        size = len(prompt) - len(PROMPT)
        answer = {name: fill(kind, size) for name, kind in schema["properties"].items()}
        if size % 7 == 0:
            answer[schema["required"][-1]] = "many"
        if size % 11 == 0:
            del answer[schema["required"][0]]
        answers.append(json.dumps(answer))
    return answers


@query(
    """SELECT doc_id, CASE WHEN n % 11 <> 0 THEN ['blue', 'green', 'red'][n % 3 + 1] END AS label,
              CASE WHEN n % 7 <> 0 THEN n END AS n, n / 4.0::DOUBLE AS share, n % 2 = 0 AS urgent,
              CAST(n % 3 AS INTEGER) AS tags,
              CASE WHEN n % 11 = 0 THEN 'missing label' WHEN n % 7 = 0 THEN 'wrong type n' ELSE 'ok' END AS problem
       FROM (SELECT doc_id, length(text) AS n FROM documents)"""
)
def schema_constrained(spark, folder):
    """Answers of a model that gets the response schema with every request, as typed columns."""
    docs = documents(spark, folder, "text")
    prompt = inference.build_prompt(PROMPT, F.col("text"))
    answers = inference.batch_infer(docs, prompt, constrained_model, response_schema=TYPED)
    flat = structured.flatten_response(answers, "response", TYPED, ["doc_id"])
    return flat.withColumn("tags", F.size("tags"))


@query(
    """WITH asked AS (SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS following FROM conversations)
       SELECT conv_id, turn, md5('Rate from 0 to 1 how alike these two texts are. Texts: ' || text || chr(10) || 'Second text: ' || following) AS answer
       FROM asked WHERE following IS NOT NULL"""
)
def preset_two_texts(spark, folder):
    """Each message and the one after it, given to the similarity instruction together."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("following"))
    pairs = turns.join(after, ["conv_id", "turn"]).where("text IS NOT NULL AND following IS NOT NULL")
    answered = inference.run_preset(pairs, "similarity", F.col("text"), echo_digest, other=F.col("following"))
    return answered.select("conv_id", "turn", F.col("response").alias("answer"))


def echo_digest(prompts):
    """A stand-in model whose answer depends on the whole prompt."""
    return [hashlib.md5(p.encode()).hexdigest() for p in prompts]


_PRESET_OPTIONS = {
    "analyze_sentiment": {},
    "classify": {"labels": "red, blue"},
    "extract": {"kind": "person"},
    "fix_grammar": {},
    "fix_spelling": {"kind": "name"},
    "gen": {},
    "mask": {"kind": "address"},
    "similarity": {},
    "summarize": {},
    "translate": {"language": "German"},
}


# The instructions once more, filled in, as SQL.
_PRESETS_SQL = """SELECT preset, count(*) AS n, CAST(sum(length(instruction || text)) AS BIGINT) AS total_chars,
           CAST(sum(CAST('0x' || substr(md5(instruction || text), 1, 8) AS BIGINT)) AS BIGINT) AS answers
    FROM (SELECT text FROM benchmark UNION ALL SELECT text FROM conversations),
         (VALUES
           ('analyze_sentiment', 'Give the sentiment as JSON with a field sentiment: 0 for negative, 1 for positive, 2 for neutral. '),
           ('classify', 'Answer with exactly one of these labels: red, blue. Text: '),
           ('extract', 'List every person in this text as a JSON list. Text: '),
           ('fix_grammar', 'Correct the grammar of this text and answer with the corrected text only. Text: '),
           ('fix_spelling', 'Correct the spelling of this name and answer with the corrected name only: '),
           ('gen', ''),
           ('mask', 'Replace every address in this text by [MASKED] and answer with the text only. Text: '),
           ('similarity', 'Rate from 0 to 1 how alike these two texts are. Texts: '),
           ('summarize', 'Summarize this text in one sentence. Text: '),
           ('translate', 'Translate this text to German. Text: ')) presets(preset, instruction)
    GROUP BY preset"""


@query(_PRESETS_SQL)
def model_presets(spark, folder):
    """Each ready instruction over all benchmark and conversation texts, answered by the prompt's digest, of which the sum is taken."""
    texts = table(spark, folder, "benchmark").select("text").unionAll(table(spark, folder, "conversations").select("text"))
    prompts = [
        F.struct(F.lit(name).alias("preset"), inference.PRESETS[name].prompt(F.col("text"), **options).alias("prompt"))
        for name, options in _PRESET_OPTIONS.items()
    ]
    asked = texts.select(F.inline(F.array(*prompts)))
    answered = inference.batch_infer(asked, F.col("prompt"), echo_digest)
    answer = F.conv(F.substring("response", 1, 8), 16, 10).cast("long")
    return answered.groupBy("preset").agg(F.count("*").alias("n"), F.sum(F.length("prompt")).cast("long").alias("total_chars"), F.sum(answer).alias("answers"))


@query(
    """WITH damaged AS (SELECT p_partkey, left(p_name, p_partkey % 5 + 1) || substr(p_name, p_partkey % 5 + 3) AS damaged FROM part),
            vocabulary AS (SELECT DISTINCT p_name FROM part),
            scored AS (SELECT d.damaged, v.p_name, levenshtein(d.damaged, v.p_name) AS dist
                       FROM (SELECT DISTINCT damaged FROM damaged) d, vocabulary v),
            best AS (SELECT damaged, arg_min(p_name, (dist, p_name)) AS best, min(dist) AS dist FROM scored GROUP BY damaged)
       SELECT p_partkey, damaged, best, CAST(dist AS INTEGER) AS dist FROM damaged JOIN best USING (damaged)"""
)
def fuzzy_correct(spark, folder):
    """Part names with one letter gone, corrected against the real names."""
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    at = (F.col("p_partkey") % 5).cast("int")
    damaged = parts.select(
        "p_partkey", F.concat(F.left("p_name", at + 1), F.substr("p_name", at + 3)).alias("damaged")
    )
    return fuzzy.fuzzy_correct(damaged, "damaged", parts, "p_name").select("p_partkey", "damaged", "best", "dist")


@query(
    """SELECT c_custkey, n_name, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey"""
)
def classify_by_mapping(spark, folder):
    """A closed vocabulary needs no model: country to region through a mapping table."""
    mapping = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, folder, "customer")
        .join(mapping, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "n_name", F.col("r_name").alias("region"))
    )


@query(
    """SELECT doc_id, CAST(length(text) AS VARCHAR) AS response,
              CASE WHEN max((lang = 'en')::INT) OVER (PARTITION BY text) = 1 THEN 'first' ELSE 'second' END AS batch, 1::BIGINT AS answers
       FROM documents"""
)
def infer_ledger(spark, folder):
    """English texts, then all, through a ledger: the run that asked for each text, and how often it was answered."""
    key = inference.prompt_key(F.col("text"), "lengths-1")
    # The key stands beside the text, so that later joins carry it alone; what the model gets is spread by infer_once.
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang").withColumn("prompt_key", key)
    ledger = CommittedTable(spark, scratch_path(spark, "ledger"), inference.ANSWERS)
    ask = lambda rows, batch: inference.infer_once(rows, F.col("text"), lengths, ledger, "lengths-1", batch)
    ask(docs.where("lang = 'en'"), "first")
    answered = ask(docs, "second")
    again = ask(docs, "third").select("doc_id", F.col("response").alias("again"))
    held = ledger.read().groupBy("prompt_key").agg(F.min("batch").alias("batch"), F.count("*").alias("answers"))
    rows = answered.join(again, "doc_id").where(F.col("response") == F.col("again"))
    return rows.join(held, "prompt_key").select("doc_id", "response", "batch", "answers")


def lengths(prompts):
    """A stand-in model: the length of each prompt."""
    return [str(len(p)) for p in prompts]
