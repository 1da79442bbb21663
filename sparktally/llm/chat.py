"""Tool-call linking for chat records.

Calls and results meet in a hash join on the call identifier. Each call may
name the call it builds on; its level in that order is found by pointer
doubling (a call knows its 2^r-th ancestor after round r), so a chain of any
length takes a logarithmic number of joins, every one of them on unique call
identifiers. Arguments are checked against the schema of their tool and every
linked call is serialised as canonical JSON: sorted keys, no white space,
UTF-8 as is, and numbers by value: a whole number as its digits whatever its
spelling (1.0, 1e2 and -0.0 are 1, 100 and 0), any other as the shortest
decimal that reads back as the same double.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktally.llm.common import drop_scratch, materialize, small_batches

EVENTS = ("conv_id", "turn", "kind", "call_id", "parent_id", "name", "body")

# Tools of the conversations query.
SCHEMAS = {
    "ask": {
        "type": "object",
        "required": ["chars", "text", "turn"],
        "properties": {
            "chars": {"type": "integer", "minimum": 1},
            "text": {"type": "string", "minLength": 1},
            "turn": {"type": "integer", "minimum": 0},
        },
        "additionalProperties": False,
    },
    "configure": {
        "type": "object",
        "required": ["text", "turn"],
        "properties": {
            "chars": {"type": "integer", "minimum": 0},
            "text": {"type": "string", "minLength": 1},
            "turn": {"type": "integer", "minimum": 0, "maximum": 0},
        },
        "additionalProperties": False,
    },
}


def canonical(value) -> str:
    """Canonical JSON of a parsed value."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def parse(text: str | None):
    """(value, None) of JSON text, or (None, problem). Numbers that JSON does
    not have (NaN, Infinity) or a double cannot hold (1e999) are problems, as
    are a repeated key and text that is not Unicode (half a surrogate pair)."""

    def pairs(items):
        out = dict(items)
        if len(out) != len(items):
            raise ValueError("repeated key")
        return out

    def constant(name):
        raise ValueError(f"{name} is not JSON")

    def number(digits):
        value = float(digits)
        if math.isinf(value):
            raise ValueError(f"{digits} is too large")
        return int(value) if value.is_integer() else value

    if text is None:
        return None, "no arguments"
    try:
        value = json.loads(text, object_pairs_hook=pairs, parse_constant=constant, parse_float=number)
        # What can be written inside a record, and as UTF-8.
        canonical({"": [value]}).encode("utf-8")
        return value, None
    except (ValueError, RecursionError) as exc:
        return None, f"not JSON: {type(exc).__name__}"


_KINDS = {
    "object": dict,
    "array": list,
    "string": str,
    "boolean": bool,
    "null": type(None),
    "integer": int,
    "number": (int, float),
}


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """Problems of a value under a JSON schema (type, enum, required,
    properties, additionalProperties, items, minimum, maximum, minLength,
    maxLength), each with its path."""
    kind = schema.get("type")
    if kind is not None:
        fits = isinstance(value, _KINDS[kind]) and not (kind in ("integer", "number") and isinstance(value, bool))
        if not fits:
            return [f"{at}: not of type {kind}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", -math.inf):
            out.append(f"{at}: below minimum")
        if value > schema.get("maximum", math.inf):
            out.append(f"{at}: above maximum")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{at}: too short")
        if len(value) > schema.get("maxLength", math.inf):
            out.append(f"{at}: too long")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            out += violations(item, schema["items"], f"{at}[{i}]")
    return out


def call_levels(calls: DataFrame) -> DataFrame:
    """(call_id, level) of distinct calls (call_id, parent_id): 0 without a
    parent among the calls, else one more than the parent; NULL on and below a
    cycle. A written table."""
    ids = calls.select(F.col("call_id").alias("known"))
    cur = materialize(
        calls.join(ids, F.col("parent_id") == F.col("known"), "left")
        .select("call_id", F.col("known").alias("up"), F.when(F.col("known").isNull(), 0).otherwise(1).cast("long").alias("steps")),
        "call-levels",
    )
    rounds = math.ceil(math.log2(cur.count() + 1)) + 1
    while rounds > 0 and not cur.where("up IS NOT NULL").isEmpty():
        above = cur.select(F.col("call_id").alias("a_id"), F.col("up").alias("a_up"), F.col("steps").alias("a_steps"))
        waiting = cur.where("up IS NOT NULL").join(above, F.col("up") == F.col("a_id"))
        nxt = materialize(
            cur.where("up IS NULL").union(waiting.select("call_id", "a_up", F.col("steps") + F.col("a_steps"))), "call-levels"
        )
        drop_scratch(cur)
        cur, rounds = nxt, rounds - 1
    out = materialize(cur.select("call_id", F.when(F.col("up").isNull(), F.col("steps")).alias("level")), "call-order")
    drop_scratch(cur)
    return out


def link_calls(events: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call identifier: conv_id, turn, call_id, parent_id, name,
    status, n_calls, n_results, level, valid, errors, call_json, result_json.

    ``events`` has the columns ``EVENTS``; kind is 'call' or 'result', body
    the arguments as JSON text, or the result. status is 'linked',
    'unanswered' (no result), 'orphan' (results without a call) or
    'unidentified' (NULL call_id: one row per event, never linked). Repeated
    calls or results of an identifier are counted and the smallest
    (conv_id, turn, body) stands for them, NULLs first. level orders calls:
    sorting by it puts every call after the one it builds on; a parent that is
    no call makes a root, a cycle has no level. Bodies may be NULL, empty or
    very long and are kept whole. Extra columns are ignored.
    """
    slim = events.select(*EVENTS)
    keep = F.struct("conv_id", "turn", "body", "parent_id", "name")
    calls = slim.where("kind = 'call' AND call_id IS NOT NULL").groupBy("call_id").agg(
        F.min(keep).alias("c"), F.count("*").alias("n_calls")
    )
    results = slim.where("kind = 'result' AND call_id IS NOT NULL").groupBy("call_id").agg(
        F.min(F.struct("conv_id", "turn", "body")).alias("r"), F.count("*").alias("n_results")
    )
    calls, results = materialize(calls, "calls"), materialize(results, "call-results")
    levels = call_levels(calls.select("call_id", "c.parent_id"))
    # Only identifiers and numbers are hashed; bodies, however long, join later.
    met = (
        calls.select("call_id", "n_calls").join(levels, "call_id")
        .hint("shuffle_hash")
        .join(results.select("call_id", "n_results").hint("shuffle_hash"), "call_id", "full")
    )
    linked = (
        met.join(calls.select("call_id", "c"), "call_id", "left")
        .join(results.select("call_id", "r"), "call_id", "left")
        .select(
            F.coalesce("c.conv_id", "r.conv_id").alias("conv_id"),
            F.coalesce("c.turn", "r.turn").alias("turn"),
            "call_id",
            "c.parent_id",
            "c.name",
            F.when(F.col("n_calls").isNull(), "orphan").when(F.col("n_results").isNull(), "unanswered").otherwise("linked").alias("status"),
            F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"),
            F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
            "level",
            F.col("c.body").alias("_arguments"),
            F.col("r.body").alias("_result"),
        )
    )
    is_call = F.col("kind") == "call"
    loose = slim.where("call_id IS NULL").select(
        "conv_id", "turn", "call_id", "parent_id", "name", F.lit("unidentified").alias("status"),
        is_call.cast("long").alias("n_calls"), (~is_call).cast("long").alias("n_results"), F.lit(None).cast("long").alias("level"),
        F.when(is_call, F.col("body")).alias("_arguments"), F.when(~is_call, F.col("body")).alias("_result"),
    )
    rows = linked.unionByName(loose)
    kept = [c for c in rows.columns if not c.startswith("_")]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "_arguments"):
            out: list[list] = [[], [], [], []]
            for row in batch.to_pylist():
                valid, errors, call, result = None, [], None, None
                if row["n_calls"]:
                    value, problem = parse(row["_arguments"])
                    tool = schemas.get(row["name"])
                    if problem:
                        errors = [problem]
                        value = row["_arguments"]
                    elif tool is None:
                        errors = ["unknown tool"]
                    else:
                        errors = violations(value, tool)
                    valid = not errors
                    call = canonical({"arguments": value, "id": row["call_id"], "level": row["level"], "name": row["name"]})
                if row["n_results"]:
                    result = canonical({"content": row["_result"], "id": row["call_id"]})
                for column, v in zip(out, (valid, errors, call, result)):
                    column.append(v)
            kinds = (pa.bool_(), pa.list_(pa.string()), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(c, k) for c, k in zip(out, kinds))],
                names=[*kept, "valid", "errors", "call_json", "result_json"],
            )

    return rows.mapInArrow(run, f"{schema}, valid boolean, errors array<string>, call_json string, result_json string")


def conversation_events(conversations: DataFrame) -> DataFrame:
    """Chat turns as events: a user's turn calls the tool 'ask', a system
    turn 'configure', any other turn is the result of the turn before it. A
    call builds on the call two turns earlier (turn 1: on turn 0). NULL
    conv_id or turn: no identifier; NULL role: a result."""
    turn, role = F.col("turn").cast("long"), F.coalesce(F.lower(F.col("role")), F.lit(""))
    call = role.isin("user", "system")
    ident = lambda t: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), t.cast("string"))
    arguments = F.to_json(
        F.struct(F.length("text").alias("chars"), F.col("text").alias("text"), turn.alias("turn")), {"ignoreNullFields": "false"}
    )
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        turn.alias("turn"),
        F.when(call, "call").otherwise("result").alias("kind"),
        F.when(call, ident(turn)).otherwise(ident(turn - 1)).alias("call_id"),
        F.when(call & (turn >= 2), ident(turn - 2)).when(call & (turn == 1), ident(turn - 1)).alias("parent_id"),
        F.when(call & (role == "system"), "configure").when(call, "ask").alias("name"),
        F.when(call, arguments).otherwise(F.col("text")).alias("body"),
    )


def link_conversations(conversations: DataFrame) -> DataFrame:
    """``link_calls`` over every turn of a conversations table."""
    return link_calls(conversation_events(conversations), SCHEMAS)


# ``link_conversations`` over the conversations table, its two schemas spelt out.
LINK_SQL = """
WITH RECURSIVE events AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, text, coalesce(lower(role), '') IN ('user', 'system') AS is_call,
         CASE lower(role) WHEN 'system' THEN 'configure' WHEN 'user' THEN 'ask' END AS name
  FROM conversations
), named AS (
  SELECT *, 'c' || CAST(conv_id AS VARCHAR) || '-' || CAST(CASE WHEN is_call THEN turn ELSE turn - 1 END AS VARCHAR) AS call_id,
         CASE WHEN is_call AND turn >= 1 THEN 'c' || CAST(conv_id AS VARCHAR) || '-' || CAST(greatest(turn - 2, 0) AS VARCHAR) END AS parent_id
  FROM events
), numbered AS (
  SELECT *, row_number() OVER same AS place, count(*) OVER (PARTITION BY call_id, is_call) AS n
  FROM named WINDOW same AS (PARTITION BY call_id, is_call ORDER BY conv_id, turn, text NULLS FIRST)
), calls AS (
  SELECT * FROM numbered WHERE is_call AND call_id IS NOT NULL AND place = 1
), results AS (
  SELECT * FROM numbered WHERE NOT is_call AND call_id IS NOT NULL AND place = 1
), levels(call_id, level) AS (
  SELECT call_id, CAST(0 AS BIGINT) FROM calls WHERE parent_id IS NULL OR parent_id NOT IN (SELECT call_id FROM calls)
  UNION ALL SELECT c.call_id, l.level + 1 FROM calls c JOIN levels l ON c.parent_id = l.call_id
), linked AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn) AS turn, coalesce(c.call_id, r.call_id) AS call_id,
         c.parent_id, c.name, CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
         coalesce(c.n, 0) AS n_calls, coalesce(r.n, 0) AS n_results, l.level, c.text AS arguments, r.text AS result
  FROM calls c FULL JOIN results r ON c.call_id = r.call_id LEFT JOIN levels l ON l.call_id = c.call_id
  UNION ALL
  SELECT conv_id, turn, call_id, parent_id, name, 'unidentified', CAST(is_call AS BIGINT), CAST(NOT is_call AS BIGINT), NULL,
         CASE WHEN is_call THEN text END, CASE WHEN NOT is_call THEN text END
  FROM named WHERE call_id IS NULL
), checked AS (
  SELECT *, CASE WHEN n_calls > 0 THEN list_filter([
    CASE WHEN arguments IS NULL THEN '$.chars: not of type integer' WHEN name = 'ask' AND arguments = '' THEN '$.chars: below minimum' END,
    CASE WHEN arguments IS NULL THEN '$.text: not of type string' WHEN arguments = '' THEN '$.text: too short' END,
    CASE WHEN turn IS NULL THEN '$.turn: not of type integer' WHEN turn < 0 THEN '$.turn: below minimum'
         WHEN name = 'configure' AND turn > 0 THEN '$.turn: above maximum' END], lambda e: e IS NOT NULL) ELSE []::VARCHAR[] END AS errors
  FROM linked
), shown AS (
  SELECT *, coalesce(CAST(to_json(arguments) AS VARCHAR), 'null') AS a, coalesce(CAST(to_json(result) AS VARCHAR), 'null') AS r,
         coalesce('"' || call_id || '"', 'null') AS i
  FROM checked
)
SELECT conv_id, turn, call_id, parent_id, name, status, n_calls, n_results, level,
       CASE WHEN n_calls > 0 THEN len(errors) = 0 END AS valid, errors,
       CASE WHEN n_calls > 0 THEN '{"arguments":{"chars":' || coalesce(CAST(length(arguments) AS VARCHAR), 'null') || ',"text":' || a || ',"turn":'
         || coalesce(CAST(turn AS VARCHAR), 'null') || '},"id":' || i || ',"level":' || coalesce(CAST(level AS VARCHAR), 'null')
         || ',"name":"' || name || '"}' END AS call_json,
       CASE WHEN n_results > 0 THEN '{"content":' || r || ',"id":' || i || '}' END AS result_json
FROM shown
"""
