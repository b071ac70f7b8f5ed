"""Typed access to JSON responses, and checks of their form."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_long(json: Column, name: str) -> Column:
    """A field as LONG; NULL where the text is not JSON, lacks the field or holds no number."""
    return F.get_json_object(json, f"$.{name}").try_cast("long")


# The kinds of fields besides text, by their names in JSON schemas.
TYPES = {"integer": "bigint", "number": "double", "boolean": "boolean", "array": "array<string>"}

# Holds a text that is no JSON object, beside the fields of those that are.
_UNREADABLE = "_unreadable"


@dataclass(frozen=True)
class ResponseSchema:
    """The fields of a response, the allowed values of some of them, and which must be there.

    A field is text unless ``types`` names it: ``integer``, ``number``, ``boolean`` or ``array`` (of texts).
    """

    fields: tuple[str, ...]
    enums: dict[str, tuple[str, ...]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    types: dict[str, str] = field(default_factory=dict)

    def json_schema(self, name: str = "response") -> dict[str, Any]:
        """The response format as models that constrain their answers take it: a named, strict JSON schema."""
        properties: dict[str, dict] = {}
        for one in self.fields:
            properties[one] = {"type": self.types.get(one, "string")}
            if properties[one]["type"] == "array":
                properties[one]["items"] = {"type": "string"}
            if one in self.enums:
                properties[one]["enum"] = list(self.enums[one])
        schema = {"type": "object", "properties": properties, "required": list(self.required), "additionalProperties": False}
        return {"type": "json_schema", "json_schema": {"name": name, "schema": schema, "strict": True}}

    def ddl(self) -> str:
        return ", ".join(f"`{name}` STRING" for name in self.fields)

    def parse(self, response: Column) -> Column:
        """All fields in one pass, as a struct, and the text itself where it is no JSON object."""
        schema = f"{self.ddl()}, `{_UNREADABLE}` STRING"
        return F.from_json(response, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _UNREADABLE})

    def value(self, parsed: Column, name: str) -> Column:
        """A field in its type; NULL where it is missing or of another type."""
        kind = self.types.get(name)
        if kind is None:
            return parsed[name]
        if kind == "array":
            return F.from_json(parsed[name], TYPES[kind])
        return parsed[name].try_cast(TYPES[kind])

    def problem(self, parsed: Column) -> Column:
        """``ok``, ``malformed``, ``missing <field>``, ``wrong type <field>`` or ``not allowed <field>``: the first that applies."""
        checks = F.when(parsed.isNull() | parsed[_UNREADABLE].isNotNull(), "malformed")
        for name in self.required:
            checks = checks.when(parsed[name].isNull(), f"missing {name}")
        for name in self.types:
            checks = checks.when(parsed[name].isNotNull() & self.value(parsed, name).isNull(), f"wrong type {name}")
        for name, allowed in self.enums.items():
            checks = checks.when(parsed[name].isNotNull() & ~parsed[name].isin(*allowed), f"not allowed {name}")
        return checks.otherwise("ok")


def flatten_response(df: DataFrame, response: str, schema: ResponseSchema, keep: list[str]) -> DataFrame:
    """``keep`` columns, one column per field, and ``problem``."""
    return df.select(*keep, schema.parse(F.col(response)).alias("_parsed")).select(
        *keep, *[schema.value(F.col("_parsed"), name).alias(name) for name in schema.fields], schema.problem(F.col("_parsed")).alias("problem")
    )


def format_compliance(df: DataFrame, response: str, schema: ResponseSchema) -> DataFrame:
    """How many responses have which problem: ``reason, n``."""
    return (
        df.select(schema.parse(F.col(response)).alias("_parsed"))
        .groupBy(schema.problem(F.col("_parsed")).alias("reason"))
        .agg(F.count("*").alias("n"))
    )


# The two response forms used with the classification prompts.
SENTIMENTS = ("0", "1", "2")
IMPACT_LEVELS = ("low", "medium", "high")
SENTIMENT_SCORE = ResponseSchema(("sentiment",), {"sentiment": SENTIMENTS}, required=("sentiment",))


def text_analysis(tickers: tuple[str, ...]) -> ResponseSchema:
    """Four required fields; the key ticker comes from a list the caller knows."""
    names = ("sentiment", "summary", "key_tickers", "impact_level")
    return ResponseSchema(
        names, {"sentiment": SENTIMENTS, "key_tickers": tickers, "impact_level": IMPACT_LEVELS}, required=names
    )
