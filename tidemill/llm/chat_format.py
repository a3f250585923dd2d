"""Chat formatting: link tool calls to their results, order, validate and write canonical JSON.

Messages are rows ``(conv_id, turn, role, text)``. The text of an assistant message may be an object with
``tool_calls`` (``id``, ``name`` and ``arguments``, an object or its JSON text); the text of a tool message may be an
object with ``tool_call_id`` and ``content``. The result has one row per event: a plain message, a call or a
result. It is one row per event, not per conversation, so that a conversation of any length is spread
over tasks; ``(conv_id, place, step)`` orders the events of a conversation topologically: a call comes after
its message's turn, and a result after its call even if its row came earlier.

* ``status`` of a call: ``answered``, ``open`` (no result), ``duplicate`` (an earlier call has the id), ``no id``; of a
  result: ``linked``, ``extra`` (not the first for its call), ``orphan`` (no such call); of messages ``plain``.
* ``errors`` of a call: what its arguments break in the schema of its tool, in order of the properties.
* ``json``: keys sorted at every level, no white space, numbers and escapes as Spark's variant writes them.

Text that is not valid JSON, or is an object without those keys, is a plain message; null text has
null content. Rows that are equal are events each; equal first calls or results all count as the first.
Rows with a null ``conv_id`` or id of a call link to nothing. Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.plans.scratch import materialize

# The JSON schema types and how Spark names the types of a variant.
TYPES = {
    "string": "^STRING$",
    "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$",
    "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL\\(.*\\))$",
    "boolean": "^BOOLEAN$",
    "object": "^OBJECT<",
    "array": "^ARRAY<",
    "null": "^VOID$",
}
COLUMNS = ["conv_id", "place", "step", "kind", "call_id", "name", "status", "errors", "json"]


def _property_errors(arguments: Column, name: str, rule: Mapping[str, Any], required: bool) -> Column:
    """Messages about one property, an array of text."""
    quote = '"' if "'" in name else "'"
    if quote in name:
        raise ValueError(f"a property with both kinds of quotes cannot be addressed: {name}")
    path = f"$[{quote}{name}{quote}]"
    value = F.try_variant_get(arguments, path, "variant")
    kind = F.schema_of_variant(value)
    text, number = F.try_variant_get(arguments, path, "string"), F.try_variant_get(arguments, path, "double")
    checks: list[tuple[Column, str]] = []
    if "type" in rule:
        checks.append((~kind.rlike(TYPES[rule["type"]]), f"{name} is not {rule['type']}"))
    is_text, is_number = kind.rlike(TYPES["string"]), kind.rlike(TYPES["number"])
    if "enum" in rule:
        checks.append((~F.to_json(value).isin([_json(v) for v in rule["enum"]]), f"{name} is not listed"))
    if "minLength" in rule:
        checks.append((is_text & (F.char_length(text) < rule["minLength"]), f"{name} is too short"))
    if "maxLength" in rule:
        checks.append((is_text & (F.char_length(text) > rule["maxLength"]), f"{name} is too long"))
    if "minimum" in rule:
        checks.append((is_number & (number < rule["minimum"]), f"{name} is too small"))
    if "maximum" in rule:
        checks.append((is_number & (number > rule["maximum"]), f"{name} is too large"))
    broken = F.array(*[F.when(c, F.lit(m)) for c, m in checks]) if checks else F.array().cast("array<string>")
    missing = F.array(F.lit(f"{name} is missing")) if required else F.array().cast("array<string>")
    return F.when(value.isNull(), missing).otherwise(F.filter(broken, lambda m: m.isNotNull()))


def _json(value: Any) -> str:
    import json

    return json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def schema_errors(tool: Column, arguments: Column, schemas: Mapping[str, Mapping[str, Any]]) -> Column:
    """What the arguments of a call break in the schema of its tool. ``schemas`` are object schemas with
    ``properties`` (``type``, ``enum``, lengths, limits), ``required`` and ``additionalProperties``."""
    errors = F.array(F.lit("unknown tool"))
    is_object = F.coalesce(F.schema_of_variant(arguments).rlike(TYPES["object"]), F.lit(False))
    given = F.map_keys(F.from_json(F.to_json(arguments), "map<string,string>"))
    for name, schema in schemas.items():
        known = schema.get("properties", {})
        required = set(schema.get("required", ()))
        parts = [_property_errors(arguments, p, rule, p in required) for p, rule in sorted(known.items())]
        parts += [_property_errors(arguments, p, {}, True) for p in sorted(required - set(known))]
        if schema.get("additionalProperties") is False:
            extra = F.array_sort(F.array_except(given, F.array(*[F.lit(p) for p in known]).cast("array<string>")))
            parts.append(F.transform(extra, lambda p: F.concat(p, F.lit(" is not known"))))
        found = F.concat(*parts) if parts else F.array().cast("array<string>")
        found = F.when(is_object, found).otherwise(F.array(F.lit("arguments are not an object")))
        errors = F.when(tool == name, found).otherwise(errors)
    return errors


def format_chat(messages: DataFrame, schemas: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """The events of ``messages`` with their order, links, errors and canonical JSON."""
    text = F.col("text")
    may = F.col("role").isin("assistant", "tool") & F.ltrim(text).startswith("{")
    rows = messages.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text", F.when(may, F.try_parse_json(text)).alias("v"))
    rows = rows.select(
        "*",
        F.when(F.col("role") == "assistant", F.try_variant_get("v", "$.tool_calls", "array<variant>")).alias("calls"),
        F.when(F.col("role") == "tool", F.try_variant_get("v", "$.tool_call_id", "string")).alias("answers"),
    )
    has_calls = F.coalesce(F.size("calls") > 0, F.lit(False))

    plain = rows.where(~has_calls & F.col("answers").isNull())
    plain = plain.select(
        "conv_id",
        F.col("turn").alias("place"),
        F.lit(0).alias("step"),
        F.lit("message").alias("kind"),
        F.lit(None).cast("string").alias("call_id"),
        F.lit(None).cast("string").alias("name"),
        F.lit("plain").alias("status"),
        F.array().cast("array<string>").alias("errors"),
        F.to_json(F.struct(F.col("text").alias("content"), "role"), {"ignoreNullFields": "false"}).alias("json"),
    )

    calls = rows.where(has_calls).select("conv_id", "turn", F.posexplode("calls").alias("number", "call"))
    raw = F.try_variant_get("call", "$.arguments", "variant")
    inner = F.try_parse_json(F.try_variant_get("call", "$.arguments", "string"))
    calls = calls.select(
        "conv_id",
        "turn",
        "number",
        F.try_variant_get("call", "$.id", "string").alias("call_id"),
        F.try_variant_get("call", "$.name", "string").alias("name"),
        F.when(F.schema_of_variant(raw) == "STRING", inner).otherwise(raw).alias("arguments"),
    )
    answers = rows.where("answers IS NOT NULL").select(
        "conv_id", "turn", F.col("answers").alias("call_id"), F.try_variant_get("v", "$.content", "variant").alias("content")
    )
    key = ["conv_id", "call_id"]
    linkable = "conv_id IS NOT NULL AND call_id IS NOT NULL"
    # Written, so that the joins see two shuffled tables and Spark can split a key with very many rows.
    first_call = calls.where(linkable).groupBy(*key).agg(F.min(F.struct("turn", "number")).alias("first"))
    first_call = materialize(first_call.select(*key, F.col("first.turn").alias("call_turn"), F.col("first.number").alias("call_number")), "calls")
    first_answer = materialize(answers.where(linkable).groupBy(*key).agg(F.min("turn").alias("answer_turn")), "answers")

    called = calls.join(first_call, key, "left").join(first_answer, key, "left")
    is_first = (F.col("turn") == F.col("call_turn")) & (F.col("number") == F.col("call_number"))
    errors = schema_errors(F.col("name"), F.col("arguments"), schemas)
    called = called.select(
        "conv_id",
        F.col("turn").alias("place"),
        (F.col("number") + 1).alias("step"),
        F.lit("call").alias("kind"),
        "call_id",
        "name",
        F.when(F.col("call_id").isNull(), "no id")
        .when(~F.coalesce(is_first, F.lit(True)), "duplicate")
        .when(F.col("answer_turn").isNull(), "open")
        .otherwise("answered")
        .alias("status"),
        errors.alias("errors"),
        F.to_json(F.struct("arguments", F.col("call_id").alias("id"), "name", F.lit("assistant").alias("role")), {"ignoreNullFields": "false"}).alias("json"),
    )

    answered = answers.join(first_call, key, "left").join(first_answer, key, "left")
    after = F.col("turn") > F.col("call_turn")
    answered = answered.select(
        "conv_id",
        F.greatest("turn", "call_turn").alias("place"),
        F.when(F.coalesce(after, F.lit(True)), F.lit(0)).otherwise(F.lit(2**30) + F.col("call_number")).cast("int").alias("step"),
        F.lit("result").alias("kind"),
        "call_id",
        F.lit(None).cast("string").alias("name"),
        F.when(F.col("call_turn").isNull(), "orphan").when(F.col("turn") == F.col("answer_turn"), "linked").otherwise("extra").alias("status"),
        F.array().cast("array<string>").alias("errors"),
        F.to_json(F.struct("content", F.lit("tool").alias("role"), F.col("call_id").alias("tool_call_id")), {"ignoreNullFields": "false"}).alias("json"),
    )
    return plain.unionByName(called).unionByName(answered).select(*COLUMNS)


# The tool of the view below.
ANSWER_SCHEMA = {
    "answer": {
        "type": "object",
        "properties": {
            "question": {"type": "string", "minLength": 1, "maxLength": 1000},
            "words": {"type": "integer", "minimum": 1, "maximum": 200},
        },
        "required": ["question", "words"],
        "additionalProperties": False,
    }
}


def as_tool_messages(conversations: DataFrame) -> DataFrame:
    """Conversations as an agent's log: each user message also calls the tool ``answer``, each assistant
    message is the result of the call one turn earlier, and other roles stay. Turns are doubled to make room."""
    turn = F.col("turn") * 2
    link = lambda t: F.concat_ws("-", F.col("conv_id").cast("string"), t.cast("string"))
    arguments = F.struct(F.regexp_count("text", F.lit("[^ \n]+")).alias("words"), F.col("text").alias("question"))
    call = F.struct(F.lit("answer").alias("name"), link(F.col("turn")).alias("id"), arguments.alias("arguments"))
    calling = F.to_json(F.struct(F.array(call).alias("tool_calls")))
    result = F.to_json(F.struct(link(F.col("turn") - 1).alias("tool_call_id"), F.col("text").alias("content")))
    is_user, is_assistant = F.col("role") == "user", F.col("role") == "assistant"
    own = conversations.select(
        "conv_id",
        turn.alias("turn"),
        F.when(is_assistant, F.lit("tool")).otherwise(F.col("role")).alias("role"),
        F.when(is_assistant, result).otherwise(F.col("text")).alias("text"),
    )
    calls = conversations.where(is_user).select("conv_id", (turn + 1).alias("turn"), F.lit("assistant").alias("role"), calling.alias("text"))
    return own.unionByName(calls)
