"""Models over rows.

A model is any callable ``list[str] -> list[str | None]`` (texts) or ``list[str] -> list[vector]``
(embeddings). It is called inside tasks on batches of bounded size. A text model that constrains its answers
also takes the keyword ``response_format``, a JSON schema as ``ResponseSchema.json_schema`` writes it.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.structured import SENTIMENT_SCORE, ResponseSchema
from rowloom.session import materialise, spread
from rowloom.sources.commits import CommittedTable
from rowloom.sources.web import TooManyRequests, with_backoff

TextModel = Callable[[list[str]], Sequence[str | None]]
VectorModel = Callable[[list[str]], Sequence]

# Fixed value: the most texts one model request may carry.
BATCH_SIZE = 150


def _batched(model: Callable, texts: list, batch_size: int, pool: ThreadPoolExecutor | None) -> list:
    """The model's answers in the order of ``texts``; NULL texts are not sent and answer NULL."""
    wanted = [i for i, text in enumerate(texts) if text is not None]
    requests = [[texts[i] for i in wanted[at : at + batch_size]] for at in range(0, len(wanted), batch_size)]
    answers = [a for part in (pool.map(model, requests) if pool else map(model, requests)) for a in part]
    if len(answers) != len(wanted):
        raise ValueError(f"the model gave {len(answers)} answers to {len(wanted)} texts")
    out: list = [None] * len(texts)
    for i, answer in zip(wanted, answers):
        out[i] = answer
    return out


def text_function(model: TextModel, batch_size: int = BATCH_SIZE, concurrency: int = 1, attempts: int = 3, wait: float = 3.0):
    """``model`` as a Spark function from text to text; also fit for ``spark.udf.register``.

    It is marked non-deterministic: Spark then computes it once per row even where a later
    filter reads the result.
    """

    @F.arrow_udf("string")
    def answer(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        patient = with_backoff(model, attempts, wait)
        pool = ThreadPoolExecutor(concurrency) if concurrency > 1 else None
        try:
            for texts in batches:
                yield pa.array(_batched(patient, texts.to_pylist(), batch_size, pool), pa.string())
        finally:
            if pool:
                pool.shutdown(cancel_futures=True)

    return answer.asNondeterministic()


def vector_function(model: VectorModel, batch_size: int = BATCH_SIZE, attempts: int = 3, wait: float = 3.0):
    """``model`` as a Spark function from text to ``array<float>``."""

    @F.arrow_udf("array<float>")
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        patient = with_backoff(model, attempts, wait)
        for texts in batches:
            vectors = _batched(patient, texts.to_pylist(), batch_size, None)
            yield pa.array(vectors, pa.list_(pa.float32()))

    return embed.asNondeterministic()


def chunk_function(split: Callable[[], Callable[[str], list[str]]]):
    """A Python splitter as a Spark function from text to ``array<string>``.

    ``split`` is called once per task and returns the function that cuts one text, so costly
    setup (loading a tokenizer) is not repeated per batch.
    """

    @F.arrow_udf("array<string>")
    def chunks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cut = split()
        for texts in batches:
            yield pa.array([[] if t is None else cut(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    return chunks.asNondeterministic()


def batch_infer(
    df: DataFrame,
    prompt: Column,
    model: TextModel,
    out: str = "response",
    batch_size: int = BATCH_SIZE,
    concurrency: int = 1,
    response_schema: ResponseSchema | None = None,
) -> DataFrame:
    """Add the model's response to each row's prompt. All rows and columns are kept.

    Only the prompt goes to the Python worker; the other columns stay in the JVM. With ``response_schema`` every
    request carries its JSON schema as ``response_format``.
    """
    if response_schema is not None:
        model = partial(model, response_format=response_schema.json_schema())
    return df.withColumn(out, text_function(model, batch_size, concurrency)(prompt))


# What a ledger of answers holds.
ANSWERS = "prompt_key STRING, response STRING, batch STRING"


def _alone_if_failing(model: TextModel) -> TextModel:
    """``model`` that asks prompts one by one after a failure; those that fail alone have no answer."""

    def ask(prompts: list[str], **how) -> list[str | None]:
        try:
            return model(prompts, **how)
        except TooManyRequests:
            raise
        except Exception as error:
            if len(prompts) == 1:
                warnings.warn(f"a prompt failed: {error}", stacklevel=2)
                return [None]
            return [answer for prompt in prompts for answer in ask([prompt], **how)]

    return ask


def prompt_key(prompt: Column, model_name: str, response_schema: ResponseSchema | None = None) -> Column:
    """The key of a prompt in a ledger of answers; NULL of a NULL prompt."""
    asked_as = json.dumps([model_name, response_schema.json_schema() if response_schema else None], sort_keys=True)
    return F.when(prompt.isNotNull(), F.sha2(F.concat(F.lit(asked_as + "\n"), prompt), 256))


def infer_once(
    df: DataFrame,
    prompt: Column,
    model: TextModel,
    ledger: CommittedTable,
    model_name: str,
    batch: str,
    out: str = "response",
    response_schema: ResponseSchema | None = None,
    **how,
) -> DataFrame:
    """``batch_infer`` through a ledger (schema ``ANSWERS``): a model gets each distinct prompt once, over all runs.

    A prompt is known by a hash of its text, the response schema and ``model_name``, which names model and version.
    Prompts that the ledger lacks are asked and their answers committed as ``batch``; then all rows are answered
    from the ledger. A failing prompt fails alone, has a NULL answer, and is asked again by the next run, as is all of a run that dies
    before its commit. NULL prompts are not asked. All rows and columns are kept; a column named ``out`` is replaced.
    """
    key = prompt_key(prompt, model_name, response_schema)
    keyed = df.drop(out).withColumn("_prompt_key", key)
    prompts = df.select(key.alias("prompt_key"), prompt.alias("prompt")).where("prompt_key IS NOT NULL")
    # Keys first: prompts are moved only where the ledger lacks some.
    lacking = prompts.select("prompt_key").distinct().join(ledger.read().select("prompt_key"), "prompt_key", "left_anti")
    lacking = materialise(lacking, "open-keys")
    if not lacking.isEmpty():
        open_prompts = prompts.join(lacking, "prompt_key", "left_semi").dropDuplicates(["prompt_key"])
        new = materialise(open_prompts, "open-prompts")
        answers = batch_infer(spread(new), F.col("prompt"), _alone_if_failing(model), "response", response_schema=response_schema, **how)
        ledger.append(answers.where("response IS NOT NULL").select("prompt_key", "response", F.lit(batch).alias("batch")))
    # Runs at the same time may have asked a prompt twice; the answer of the first batch by name holds.
    held = ledger.read().groupBy(F.col("prompt_key").alias("_prompt_key")).agg(F.min_by("response", F.struct("batch", "response")).alias(out))
    return keyed.join(held, "_prompt_key", "left").drop("_prompt_key")


def build_prompt(instruction: str, value: Column) -> Column:
    """Instruction and value with nothing between them; NULL for a NULL value.

    A ``%`` in the instruction is plain text.
    """
    return F.concat(F.format_string(instruction.replace("%", "%%")), value)


@dataclass(frozen=True)
class Preset:
    """A ready instruction; ``{...}`` names the options a caller fills in."""

    instruction: str
    response_schema: ResponseSchema | None = None

    def prompt(self, value: Column, other: Column | None = None, **options: str) -> Column:
        """The instruction and the text, and a second text under it where a task takes two."""
        first = build_prompt(self.instruction.format(**options), value)
        return first if other is None else F.concat(first, F.lit("\nSecond text: "), other)


PRESETS = {
    "analyze_sentiment": Preset(
        "Give the sentiment as JSON with a field sentiment: 0 for negative, 1 for positive, 2 for neutral. ", SENTIMENT_SCORE
    ),
    "classify": Preset("Answer with exactly one of these labels: {labels}. Text: "),
    "extract": Preset("List every {kind} in this text as a JSON list. Text: "),
    "fix_grammar": Preset("Correct the grammar of this text and answer with the corrected text only. Text: "),
    "fix_spelling": Preset("Correct the spelling of this {kind} and answer with the corrected {kind} only: "),
    "gen": Preset(""),
    "mask": Preset("Replace every {kind} in this text by [MASKED] and answer with the text only. Text: "),
    "similarity": Preset("Rate from 0 to 1 how alike these two texts are. Texts: "),
    "summarize": Preset("Summarize this text in one sentence. Text: "),
    "translate": Preset("Translate this text to {language}. Text: "),
    "question": Preset("Following these guidelines: {guidelines} write one question this text answers. Text: "),
}


def run_preset(
    df: DataFrame, name: str, value: Column, model: TextModel, out: str = "response", other: Column | None = None, **options: str
) -> DataFrame:
    """A ready instruction over ``value`` (and ``other``); the model gets the response schema of a preset that has one."""
    preset = PRESETS[name]
    return batch_infer(df, preset.prompt(value, other, **options), model, out, response_schema=preset.response_schema)


class HashingEmbedder:
    """A local embedding model: words counted in ``dim`` buckets by md5, scaled to length one.

    It needs no download and gives the same vector everywhere, which makes it fit for tests
    and as a plain lexical embedding.
    """

    def __init__(self, dim: int):
        self.dim = dim
        self._bucket: dict[str, int] = {}

    def __getstate__(self):
        return {"dim": self.dim, "_bucket": {}}

    def bucket(self, word: str) -> int:
        found = self._bucket.get(word)
        if found is None:
            import hashlib

            if len(self._bucket) > 500_000:
                self._bucket.clear()
            digest = hashlib.md5(word.encode("utf-8")).hexdigest()
            found = self._bucket[word] = int(digest[:4], 16) % self.dim
        return found

    def __call__(self, texts: list[str]) -> np.ndarray:
        # The same blanks as functions.text.BLANKS. Only distinct words are looked up one by one.
        listed = pc.split_pattern_regex(pa.array(texts, pa.string()), "[ \t\r\n]+")
        words = listed.flatten().dictionary_encode()
        buckets = np.array([self.bucket(w) if w else -1 for w in words.dictionary.to_pylist()], np.int64)
        of_word = buckets[words.indices.to_numpy()]
        row = np.repeat(np.arange(len(texts)), listed.value_lengths().to_numpy())
        cells = (row * self.dim + of_word)[of_word >= 0]
        counts = np.bincount(cells, minlength=len(texts) * self.dim).reshape(len(texts), self.dim).astype(np.float64)
        length = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        return np.divide(counts, length, out=counts, where=length > 0).astype(np.float32)
