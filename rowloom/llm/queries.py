"""The registered queries of the corpus operators, with SQL where SQL can give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import ann, bpe, chat, exact, language, mixing, near, packing, secrets, sharding, spelling, tokens, trie
from rowloom.llm.common import table
from rowloom.session import scratch_path


def vocabulary(name: str) -> str:
    """Where the public vocabulary file of this name lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


@query("op3_kd_shards")
def kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in the 16 leaves of a k-d tree, whose sizes are near equal."""
    placed = sharding.shards(table(spark, folder, "documents"), leaves=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op5_pareto_mix")
def pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The words that a mix of all sources takes of every document; documents of n words are taken with odds by 1 / sqrt(n)."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    rows = mixing.mix(docs.withColumn("weight", 1 / F.sqrt(F.greatest(mixing.word_count(F.col("text")), F.lit(1)))), weight="weight")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query(
    "op10_block_naming",
    """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
    FROM t JOIN g USING (text)
    """,
)
def block_naming(spark: SparkSession, folder: str) -> DataFrame:
    """The group of equal texts of every document, and which of them stays."""
    return exact.exact_groups(table(spark, folder, "documents"))


@query("op1_dart_minhash")
def dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near duplicates of every document, and which of them stays."""
    return near.near_groups(table(spark, folder, "documents")).drop("address")


@query("op2_swap_packing")
def swap_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 4,096 tokens."""
    return packing.pack(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


@query("op4_blob_ledger")
def blob_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets of all documents, scanned blob by blob into a ledger that starts empty."""
    docs, path = table(spark, folder, "documents"), scratch_path(spark, "ledger")
    secrets.scan_new(docs, path)
    return secrets.findings(docs, path, ["doc_id"]).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query("op6_multi_index")
def multi_index(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest of every hundredth vector among all."""
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op7_word_field")
def word_field(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, by a field learned from those that are not held out."""
    found = language.languages(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    held = language.held_out(F.col("doc_id"))
    return found.select("doc_id", held.alias("held_out"), F.col("__llm_lang").alias("lang_pred"), F.col("__llm_score").alias("score"))


@query("op8_whole_tokens")
def whole_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The tokens of every document."""
    counted = tokens.count_tokens(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


# Fixed value: a turn that holds the marks of many templates.
TRAP = "\\### Assistant: </turn> ok"

_WRITTEN = "replace(replace(replace(replace({}, '\\', '\\\\'), '#', '\\h'), '<', '\\l'), ':', '\\c')"


@query(
    "op9_reply_trees",
    f"""
    WITH t AS (
        SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '{TRAP}' UNION ALL SELECT -7, 1, 'assistant', '{TRAP}')
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
        sum(length({_WRITTEN.format("role")}) + length({_WRITTEN.format("text")}) + 14)::BIGINT AS formatted_chars
    FROM t GROUP BY conv_id
    """,
)
def reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one full of marks, formatted and read back; each turn replies to the one before it."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRAP).alias("text"),
    )
    trees = chat.reply_trees(turns.unionByName(trap), "conv_id", "turn")
    messages = trees.withColumnRenamed("conv_id", "tree").withColumn("score", F.lit(0.0))
    return chat.read_back(chat.conversations(messages))


@query("op11_pivotal_grams")
def pivotal_grams(spark: SparkSession, folder: str) -> DataFrame:
    """The words of all documents, some of them misspelled by a rule, with their near words and forms."""
    found = spelling.runs(table(spark, folder, "documents"))
    return spelling.variants(spelling.counted(found.select(spelling.misspelled(F.col("doc_id"), F.col("run")).alias("word"))))


@query("op12_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of every document, decoded again; ``n_split`` counts the tokens that begin inside a character."""
    import public_tokenizers

    ranks = vocabulary("byte_bpe_50k.tiktoken")
    rows = bpe.decode(bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN), ranks)
    split = F.size("starts") - F.size(F.array_distinct("starts"))
    return rows.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), split.cast("bigint").alias("n_split")
    )


# The CRC-32 of a decimal number, bit by bit: a byte is taken in, then shifted out.
_CRC = """xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(conv_id::VARCHAR, ''),
        lambda s: [ascii(s)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
        lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295)"""


# In SQL, every prefix of every rebuilt conversation is a list, and subtrees are found by joining each node to all above it.
@query(
    "op13_prefix_trie",
    f"""
    WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS place,
        {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS turn FROM conversations WHERE conv_id IS NOT NULL),
    lists AS (SELECT conv_id, list(turn ORDER BY place) AS turns FROM t GROUP BY conv_id),
    plan AS (SELECT l.conv_id, l.turns, coalesce(b.turns, []) AS head, crc_h AS h FROM
        (SELECT *, {_CRC} % 9 AS crc_h, conv_id - conv_id % 5 AS base FROM lists) l LEFT JOIN lists b ON b.conv_id = l.base),
    r AS (SELECT conv_id, list_concat(head[1:h], turns[h + 1:]) AS turns FROM plan),
    steps AS (SELECT conv_id, d, turns[1:d] AS node, turns[d].text AS text, len(turns) = d AS ends
        FROM r, unnest(range(len(turns) + 1)) AS x(d)),
    nodes AS (SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs, strlen(coalesce(any_value(text), '')) AS size,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM steps GROUP BY d, node),
    kids AS (SELECT d - 1 AS d, node[1:d - 1] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
    own AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (d, node)),
    above AS (SELECT u AS d, node[1:u] AS node, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
        FROM own, unnest(range(d + 1)) AS x(u) GROUP BY ALL)
    SELECT o.conv_id, o.d AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, a.n_leaves::BIGINT AS n_leaves,
        a.saved_tokens::BIGINT AS saved_tokens, o.ends_sha256
    FROM own o JOIN above a USING (d, node) LEFT JOIN nodes p ON p.d = o.d - 1 AND p.node = o.node[1:o.d - 1]
    """,
)
def prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt so that some begin alike."""
    turns = trie.numbered_turns(table(spark, folder, "conversations"))
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % trie.HEADS
    return trie.trie(*trie.grafted(turns, F.col("conv_id") - F.col("conv_id") % 5, heads))
