"""Chat messages with tool calls linked to their results.

A turn's text is plain, or a JSON object with ``tool_calls`` (a list of
``id``, ``name``, ``arguments``) or with ``tool_call_id`` (the result of a
call). Calls and results meet in a hash join by conversation and identifier.
Order: a call comes after the calls whose results its arguments name as
``{"$ref": id}``, a result after its call, in other turns too; last needed turns
and levels are worked out by joins, one round per step of the longest chain.
Every message leaves as canonical JSON: sorted keys, no spaces, text unescaped.

Arguments are validated against the tool's schema. Schemas come from the data: a
turn of the role ``system`` or ``developer`` whose text is an object with a list
``tools`` of ``name`` and ``parameters`` (or ``input_schema``; also inside
``function``) declares them for its conversation. A call meets the last
declaration up to its turn, or else the first. ``unknown_tool`` is a tool that
the conversation's lists do not name, ``no_schema`` one without a schema, or any
in a conversation without a list; a schema that cannot be read is ``bad_schema``,
and arguments that fit all but words not known here are ``unchecked``.

Each message is a row of its own with its place (``order_turn``, ``level``,
``part``), so a conversation of any length is never gathered. Null text is the
empty text, null role the role ``unknown``; a null conv_id or turn links with
nothing. Of calls with the same identifier the first turn has it, the others
are ``duplicate``; results of no call are ``orphan``; a call in a circle, or
after one, is ``cycle``. Repeated rows stay. A text that is not quite JSON (a key
twice, NaN, a number beyond a double, more than MAX_DEPTH brackets open) is plain
text; half of a surrogate pair leaves as its escape.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakegauge.llm.common import arrow_schema, lean
from lakegauge.llm.components import stored

# Brackets that may be open at once in a text that is read as JSON.
MAX_DEPTH = 100

# Schema types and what JSON gives for them.
_TYPES: dict[str, tuple[type, ...]] = {
    "object": (dict,),
    "array": (list,),
    "string": (str,),
    "boolean": (bool,),
    "integer": (int,),
    "number": (int, float),
    "null": (type(None),),
}


# Schema words that say nothing about what is valid.
_REMARKS = frozenset(
    "title description default examples format deprecated readOnly writeOnly "
    "$schema $id $comment".split()
)
# Schema words that are checked here; others make a fitting value ``unchecked``.
_CHECKED = frozenset(
    "type enum const properties required additionalProperties items minItems "
    "maxItems minLength maxLength pattern minimum maximum exclusiveMinimum "
    "exclusiveMaximum multipleOf anyOf oneOf allOf not".split()
)


def _is(value: Any, kind: str) -> bool:
    if isinstance(value, bool):
        return kind == "boolean"
    if kind == "integer" and isinstance(value, float):
        return value.is_integer()
    return isinstance(value, _TYPES[kind])


def _same(a: Any, b: Any) -> bool:
    return isinstance(a, bool) == isinstance(b, bool) and a == b


def valid(value: Any, schema: dict[str, Any] | bool) -> bool:
    """Whether a value fits what _CHECKED words of a JSON schema say. A value
    still to come from another call is not checked."""
    if isinstance(schema, bool):
        return schema
    if is_reference(value):
        return True
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if not any([_is(value, kind) for kind in kinds]):
            return False
    if "enum" in schema and not any(_same(value, v) for v in schema["enum"]):
        return False
    if "const" in schema and not _same(value, schema["const"]):
        return False
    if not all([valid(value, part) for part in schema.get("allOf", ())]):
        return False
    if "anyOf" in schema and not any([valid(value, s) for s in schema["anyOf"]]):
        return False
    if "oneOf" in schema and sum([valid(value, s) for s in schema["oneOf"]]) != 1:
        return False
    if "not" in schema and valid(value, schema["not"]):
        return False
    if isinstance(value, dict):
        return _valid_object(value, schema)
    if isinstance(value, list):
        many = schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", math.inf)
        return many and all([valid(item, schema.get("items", True)) for item in value])
    if isinstance(value, str):
        long = schema.get("minLength", 0) <= len(value)
        long = long and len(value) <= schema.get("maxLength", math.inf)
        return long and bool(re.search(schema.get("pattern", ""), value))
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        above = value > schema.get("exclusiveMinimum", -math.inf)
        below = value < schema.get("exclusiveMaximum", math.inf)
        whole = "multipleOf" not in schema or (value / schema["multipleOf"]) % 1 == 0
        inside = schema.get("minimum", value) <= value <= schema.get("maximum", value)
        return above and below and whole and inside
    return True


def _valid_object(value: dict[str, Any], schema: dict[str, Any]) -> bool:
    known = schema.get("properties", {})
    if any(name not in value for name in schema.get("required", ())):
        return False
    others = schema.get("additionalProperties", True)
    return all([valid(item, known.get(name, others)) for name, item in value.items()])


def unchecked_words(schema: Any) -> set[str]:
    """Words of a schema, at any depth, that :func:`valid` leaves out."""
    if not isinstance(schema, dict):
        return set()
    found = schema.keys() - _CHECKED - _REMARKS
    parts = [*schema.get("properties", {}).values()]
    parts += [schema.get(name) for name in ("items", "additionalProperties", "not")]
    for name in ("anyOf", "oneOf", "allOf"):
        parts += schema.get(name, ())
    return found.union(*map(unchecked_words, parts))


def is_reference(value: Any) -> bool:
    return isinstance(value, dict) and set(value) == {"$ref"} and (
        isinstance(value["$ref"], str)
    )


def references(value: Any) -> set[str]:
    if is_reference(value):
        return {value["$ref"]}
    items = value.values() if isinstance(value, dict) else value
    if isinstance(value, (dict, list)):
        return set().union(*map(references, items))
    return set()


_LONE = re.compile("[\ud800-\udfff]")


def written(text: str) -> str:
    """A string as UTF-8 can hold it: halves of a pair as their JSON escapes."""
    return _LONE.sub(lambda half: f"\\u{ord(half.group()):04x}", text)


def canonical(value: Any) -> str:
    made = json.dumps(
        value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False
    )
    return written(made)


def _once(pairs: list[tuple[str, Any]]) -> dict[str, Any]:
    found = dict(pairs)
    if len(found) != len(pairs):
        raise ValueError("a key stands twice")
    return found


def _finite(text: str) -> float:
    number = float(text)
    if math.isinf(number):
        raise ValueError("beyond a double")
    return number


def _no_number(text: str) -> float:
    raise ValueError(f"{text} is no JSON")


_STRING = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"', re.DOTALL)


def _depth(text: str) -> int:
    """How many brackets outside of strings are open at once, at most."""
    deepest = depth = 0
    for sign in re.findall(r"[\[{\]}]", _STRING.sub("", text)):
        depth += 1 if sign in "[{" else -1
        deepest = max(deepest, depth)
    return deepest


def _object(text: str) -> dict[str, Any] | None:
    """The JSON object that a text is. Text that is none stays plain text: also
    with a key that stands twice, a number that is none or beyond a double, or
    more than MAX_DEPTH brackets open."""
    if not text.lstrip().startswith("{") or _depth(text) > MAX_DEPTH:
        return None
    try:
        found = json.loads(
            text,
            object_pairs_hook=_once,
            parse_float=_finite,
            parse_constant=_no_number,
        )
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def messages_of(role: str | None, text: str | None) -> list[dict[str, Any]]:
    """The messages of a turn: kind, call id, needed ids, JSON; of calls the
    tool's name and the arguments as JSON."""
    role, text = role if role is not None else "unknown", text or ""
    found = _object(text)
    calls = found.get("tool_calls") if found else None
    if isinstance(calls, list) and calls and all(isinstance(c, dict) for c in calls):
        made = []
        if found.get("content"):
            plain = {"content": found["content"], "role": role}
            made.append(_message("text", None, [], plain))
        for call in calls:
            call_id, name = call.get("id"), call.get("name")
            arguments = call.get("arguments")
            if isinstance(arguments, str):
                parsed = _object(arguments)
                arguments = arguments if parsed is None else parsed
            whole = {"arguments": arguments, "id": call_id, "name": name}
            needs = sorted(references(arguments))
            key = call_id if isinstance(call_id, str) else None
            tool = name if isinstance(name, str) else None
            body = {"role": role, "tool_call": whole}
            made.append(_message("call", key, needs, body, tool, canonical(arguments)))
        return made
    if found and isinstance(found.get("tool_call_id"), str):
        body = {
            "content": found.get("content"),
            "role": role,
            "tool_call_id": found["tool_call_id"],
        }
        return [_message("result", found["tool_call_id"], [], body)]
    return [_message("text", None, [], {"content": text, "role": role})]


def _message(kind, call_id, needs, body, tool=None, arguments=None) -> dict[str, Any]:
    return {
        "kind": kind,
        "call_id": None if call_id is None else written(call_id),
        "needs": [written(need) for need in needs],
        "message": canonical(body),
        "tool": None if tool is None else written(tool),
        "arguments": arguments,
    }


def tools_of(text: str | None) -> list[tuple[str, str | None]] | None:
    """Names and JSON schemas (null without one) of the text's list ``tools``;
    None if it has no such list."""
    tools = (_object(text or "") or {}).get("tools")
    if not isinstance(tools, list):
        return None
    found = []
    for tool in tools:
        if isinstance(tool, dict) and isinstance(tool.get("function"), dict):
            tool = tool["function"]
        if isinstance(tool, dict) and isinstance(tool.get("name"), str):
            schema = tool.get("parameters", tool.get("input_schema"))
            name = written(tool["name"])
            found.append((name, None if schema is None else canonical(schema)))
    return found


def call_status(arguments: str, schema: str | None) -> str:
    """Of a call of a known tool: both are JSON."""
    if schema is None:
        return "no_schema"
    value, kind = json.loads(arguments), json.loads(schema)
    try:
        fits = isinstance(value, dict) and valid(value, kind)
        left = unchecked_words(kind)
    except (AttributeError, KeyError, TypeError, ArithmeticError, re.error):
        return "bad_schema"
    return "bad_arguments" if not fits else "unchecked" if left else "ok"


_TOOLS = "conv_id bigint, turn bigint, place bigint, tool string, schema string"


def declared_tools(conversations: DataFrame) -> DataFrame:
    """A row per declaration, and one without a tool per list of tools."""
    target = arrow_schema(_TOOLS)

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"conv_id": row["conv_id"], "turn": row["turn"], "place": place,
                 "tool": tool, "schema": schema}
                for row in batch.to_pylist()
                for tools in [tools_of(row["text"])] if tools is not None
                for place, (tool, schema) in enumerate([(None, None), *tools])
            ]
            yield pa.RecordBatch.from_pylist(rows, target)

    lists = conversations.where(
        """role IN ('system', 'developer') AND conv_id IS NOT NULL
           AND turn IS NOT NULL AND contains(text, '{')"""
    )
    columns = lists.selectExpr(
        "CAST(conv_id AS BIGINT) AS conv_id",
        "CAST(turn AS BIGINT) AS turn",
        "CAST(text AS STRING) AS text",
    )
    return columns.mapInArrow(work, _TOOLS)


_MESSAGES = (
    "conv_id bigint, turn bigint, part bigint, role string, kind string, "
    "call_id string, needs array<string>, message string, tool string, arguments string"
)


def messages(conversations: DataFrame) -> DataFrame:
    target = arrow_schema(_MESSAGES)

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"conv_id": row["conv_id"], "turn": row["turn"], "part": part,
                 "role": row["role"], **message}
                for row in batch.to_pylist()
                for part, message in enumerate(messages_of(row["role"], row["text"]))
            ]
            yield pa.RecordBatch.from_pylist(rows, target)

    columns = conversations.selectExpr(
        "CAST(conv_id AS BIGINT) AS conv_id",
        "CAST(turn AS BIGINT) AS turn",
        "CAST(role AS STRING) AS role",
        "CAST(text AS STRING) AS text",
    )
    return columns.mapInArrow(work, _MESSAGES)


_JUDGED = f"{_MESSAGES}, status string"


def _judged(
    calls: DataFrame, declared: DataFrame, schemas: dict[str, dict[str, Any]]
) -> DataFrame:
    """Calls with a status by their tool's schema: the one that the conversation
    declares last up to the call's turn, or else first; or else of ``schemas``."""
    everywhere = {name: canonical(schema) for name, schema in schemas.items()}
    target = arrow_schema(_JUDGED)
    by_tool = Window.partitionBy("conv_id", "tool").orderBy("turn", "place", "schema")
    # Declarations that change nothing are left out: a call meets one row only.
    changes = (
        declared.where("tool IS NOT NULL")
        .withColumn("is_first", F.row_number().over(by_tool) == 1)
        .withColumn("same", F.lag("schema").over(by_tool).eqNullSafe(F.col("schema")))
        .where("is_first OR NOT same")
        .withColumn("until", F.lead("turn").over(by_tool))
        .selectExpr(
            "conv_id", "tool", "if(is_first, NULL, turn) AS since", "until", "schema",
            "true AS declared",
        )
    )
    lists = declared.select("conv_id").distinct().withColumn("listed", F.lit(True))
    meets = (
        (calls["conv_id"] == changes["conv_id"])
        & (calls["tool"] == changes["tool"])
        & (changes["since"].isNull() | (calls["turn"] >= changes["since"]))
        & (changes["until"].isNull() | (calls["turn"] < changes["until"]))
    )
    met = calls.join(changes, meets, "left").drop(changes["conv_id"], changes["tool"])
    met = met.join(lists, "conv_id", "left")

    @lean
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                if row["declared"]:
                    row["status"] = call_status(row["arguments"], row["schema"])
                elif row["tool"] in everywhere:
                    row["status"] = call_status(row["arguments"], everywhere[row["tool"]])
                elif row["listed"] or everywhere:
                    row["status"] = "unknown_tool"
                else:
                    row["status"] = "no_schema"
            yield pa.RecordBatch.from_pylist(rows, target)

    columns = [*calls.columns, "schema", "declared", "listed"]
    return met.select(columns).mapInArrow(work, _JUDGED)


_KEY = ["conv_id", "call_id"]


def _levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, at_turn, level) of calls (.., needs, turn, result_turn).

    ``at_turn`` is the last turn among the call's own and the ``after`` of what
    it needs, that is of their places and results; ``level`` is 0 for calls that
    need none, else one more than the highest needed. Both are null in or after
    a circle. Needed identifiers of no call are ignored."""
    needs = calls.select("conv_id", "call_id", F.explode("needs").alias("need"))
    known = calls.selectExpr("conv_id", "call_id AS need")
    edges = stored(needs.join(known, ["conv_id", "need"]).distinct(), "needs")
    waiting = edges.select(*_KEY).distinct()
    turns = calls.select(*_KEY, "turn", "result_turn")
    done = calls.join(waiting, _KEY, "left_anti").selectExpr(
        *_KEY, "turn AS at_turn", "greatest(turn, result_turn) AS after", "0L AS level"
    )
    done = stored(done, "levels")
    while True:
        ready = done.selectExpr("conv_id", "call_id AS need", "after", "level")
        reached = (
            edges.join(ready, ["conv_id", "need"], "left")
            .groupBy(*_KEY)
            .agg(
                F.max("after").alias("after"),
                F.max("level").alias("level"),
                F.expr("bool_and(level IS NOT NULL) AS all"),
            )
        )
        fresh = reached.where("all").join(done.select(*_KEY), _KEY, "left_anti")
        fresh = fresh.join(turns, _KEY).selectExpr(
            *_KEY,
            "greatest(turn, after) AS at_turn",
            "greatest(turn, after, result_turn) AS after",
            "level + 1 AS level",
        )
        fresh = stored(fresh, "levels")
        if fresh.isEmpty():
            return calls.select(*_KEY).join(done.drop("after"), _KEY, "left")
        done = stored(done.union(fresh), "levels")


def link_tool_calls(
    conversations: DataFrame, schemas: dict[str, dict[str, Any]] | None = None
) -> DataFrame:
    """A row per message: place, role, kind, status and canonical JSON."""
    made = stored(messages(conversations), "messages")
    called = made.where("kind = 'call' AND call_id IS NOT NULL")
    first = called.groupBy(*_KEY).agg(
        F.expr("min_by(needs, struct(turn, part)) AS needs"),
        F.min(F.struct("turn", "part")).alias("at"),
    )
    results = made.where("kind = 'result'")
    answered = results.groupBy(*_KEY).agg(
        F.max("turn").alias("result_turn"), F.lit(True).alias("answered")
    )
    first = first.join(answered, _KEY, "left").withColumn("turn", F.col("at.turn"))
    known = _levels(first).join(first.select(*_KEY, "at", "answered"), _KEY).select(
        *_KEY, "level", "at_turn", "at",
        F.coalesce("answered", F.lit(False)).alias("answered"),
    )
    declared = stored(declared_tools(conversations), "tools")
    judged = _judged(made.where("kind = 'call'"), declared, schemas or {})
    others = made.where("kind <> 'call'").withColumn("status", F.lit("ok"))
    made = others.unionByName(stored(judged, "calls"))
    plain = made.where("call_id IS NULL").selectExpr(
        "*", "turn AS order_turn", "0L AS level"
    )
    linked = made.where("call_id IS NOT NULL").join(known, _KEY, "left")
    linked = linked.selectExpr(
        *[name for name in made.columns if name != "status"],
        """CASE WHEN kind = 'result' AND at IS NULL THEN 'orphan'
                WHEN kind = 'result' THEN 'ok'
                WHEN at IS NULL THEN status
                WHEN struct(turn, part) <> at THEN 'duplicate'
                WHEN level IS NULL THEN 'cycle'
                WHEN status IN ('ok', 'unchecked') AND NOT answered
                  THEN 'unanswered'
                ELSE status END AS status""",
        """CASE WHEN kind = 'result' AND at IS NOT NULL
                THEN greatest(turn, at.turn, at_turn)
                WHEN struct(turn, part) = at THEN greatest(turn, at_turn)
                ELSE turn END AS order_turn""",
        """CASE WHEN kind = 'result' AND at IS NOT NULL
                THEN 2 * coalesce(level, 0L) + 1
                ELSE 2 * coalesce(level, 0L) END AS level""",
    )
    columns = [
        "conv_id", "turn", "part", "order_turn", "level", "role", "kind", "call_id",
        "status", "message",
    ]
    return plain.select(columns).unionByName(linked.select(columns))
