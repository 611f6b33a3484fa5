"""Tool calls of chats: linked to their results, ordered, validated and serialised.

Calls and results are joined by conversation and call identifier, an equality join Spark can split where a
conversation is very large. The order is topological: a call's level is one more than the highest level of the
calls it depends on, found by rounds of joins that look at undecided calls only. Arguments are checked against their
tool's schema and everything is written as canonical JSON (sorted keys, no spaces, plain UTF-8).
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Workspace

CALL_SCHEMA = "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>"


HALF_PAIR = re.compile("[\ud800-\udfff]")


def canonical(value: Any) -> str:
    """Sorted keys, no white space, no escapes beyond those needed; whole floats as integers; no NaN."""

    def plain(v: Any) -> Any:
        if isinstance(v, float):
            if not math.isfinite(v):
                raise ValueError("a number that JSON does not have")
            return int(v) if v.is_integer() and abs(v) < 2**53 else v
        if isinstance(v, list):
            return [plain(x) for x in v]
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        return v

    text = json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    # Half of a surrogate pair is legal in JSON as an escape only.
    return HALF_PAIR.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


# Fixed values of JSON Schema.
TYPES = {
    "object": dict, "array": list, "string": str, "boolean": bool, "null": type(None), "integer": int, "number": (int, float),
}


#: What of a schema is checked; notes to readers are passed over, anything else is an error.
CHECKED = {
    "type", "enum", "required", "properties", "additionalProperties", "items", "minimum", "maximum", "minLength", "maxLength",
}
NOTES = {"title", "description", "default", "examples", "$comment", "$schema", "$id"}


def check_schema(schema: dict[str, Any], at: str = "$") -> None:
    """Raises on keywords that would go unchecked."""
    if unknown := sorted(set(schema) - CHECKED - NOTES):
        raise ValueError(f"{at}: schemas with {', '.join(unknown)} are not supported")
    if not isinstance(schema.get("additionalProperties", True), bool):
        raise ValueError(f"{at}: additionalProperties must be true or false")
    for name, inner in schema.get("properties", {}).items():
        check_schema(inner, f"{at}.{name}")
    if "items" in schema:
        check_schema(schema["items"], f"{at}[]")


def problem(value: Any, schema: dict[str, Any], at: str = "$") -> str | None:
    """The first violation of a schema (type, enum, required, properties, additionalProperties, items, bounds, lengths)."""
    kinds = schema.get("type", [])
    for kind in [kinds] if isinstance(kinds, str) else []:
        whole = kind == "integer" and isinstance(value, float) and value.is_integer()
        right = isinstance(value, TYPES[kind]) and (kind == "boolean" or not isinstance(value, bool))
        if not (right or whole):
            return f"{at}: not of type {kind}"
    if isinstance(kinds, list) and kinds and all(problem(value, {"type": k}) for k in kinds):
        return f"{at}: not of type {' or '.join(kinds)}"
    # As JSON, true is not 1, and 1.0 is 1.
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        return f"{at}: not an allowed value"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", -math.inf) or value > schema.get("maximum", math.inf):
            return f"{at}: out of bounds"
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", math.inf):
        return f"{at}: length out of bounds"
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            if found := problem(item, schema["items"], f"{at}[{i}]"):
                return found
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in sorted(schema.get("required", [])):
            if name not in value:
                return f"{at}.{name}: missing"
        for name in sorted(value):
            if name in known:
                if found := problem(value[name], known[name], f"{at}.{name}"):
                    return found
            elif schema.get("additionalProperties", True) is False:
                return f"{at}.{name}: not allowed"
    return None


def levels(ws: Workspace, calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of each identified call; level null in or behind a cycle.

    Dependencies on unknown calls are ignored. Each round decides the calls all of whose dependencies are decided.
    """
    nodes = calls.where("call_id is not null").select("conv_id", "call_id").distinct()
    edges = calls.select("conv_id", "call_id", F.explode("depends_on").alias("dep")).where("call_id is not null").distinct()
    known = nodes.select("conv_id", F.col("call_id").alias("dep"))
    edges = ws.write(_match(edges, known, ["conv_id", "dep"], "left_semi"), "edges")
    later = edges.select("conv_id", "call_id").distinct()
    decided = ws.write(_match(nodes, later, ["conv_id", "call_id"], "left_anti").withColumn("level", F.lit(0)), "level-0")
    done, open_edges, level = decided, edges, 0
    while not open_edges.isEmpty():
        level += 1
        before = decided.select("conv_id", F.col("call_id").alias("dep"))
        left = ws.write(_match(open_edges, before, ["conv_id", "dep"], "left_anti"), "open")
        waiting = left.select("conv_id", "call_id").distinct()
        mine = open_edges.select("conv_id", "call_id").distinct()
        decided = ws.write(
            _match(mine, waiting, ["conv_id", "call_id"], "left_anti").withColumn("level", F.lit(level)), f"level-{level}"
        )
        if decided.isEmpty():
            # Only cycles and what depends on them is left.
            return done.unionByName(waiting.withColumn("level", F.lit(None).cast("int")))
        done, open_edges = done.unionByName(decided), left
    return done


def _match(a: DataFrame, b: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys where null equals null."""
    right = b.select(*[F.col(c).alias(f"_{c}" if c in keys else c) for c in b.columns])
    on = [a[k].eqNullSafe(right[f"_{k}"]) for k in keys]
    return a.join(right, on, how).drop(*[f"_{k}" for k in keys])


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, Any]]) -> DataFrame:
    """One row per call and per result without a call.

    ``calls`` has the columns of ``CALL_SCHEMA``, ``results`` (conv_id, call_id, content). Returned: conv_id, call_id, turn,
    level, status ('linked', 'no result', 'no call'), name, valid, problem, json. A conversation in order of level,
    turn, call_id is in topological order; level is null in or behind a cycle, for calls without an identifier and
    for results alone. Several results of a call give several rows, as do repeated calls. Null arguments count as {};
    arguments that are no JSON object (or nested too deeply to be read), unknown tools and schema violations are
    invalid, with the reason. Missing identifiers never match. Schema keywords that are not checked are an error.
    """
    for own in schemas.values():
        check_schema(own)
    ws = Workspace(calls.sparkSession, "tools")
    order = levels(ws, calls)
    ordered = _match(calls, order, ["conv_id", "call_id"], "left")
    left = ordered.select("conv_id", "call_id", "turn", "level", "name", "arguments", F.lit(True).alias("called"))
    right = results.select(
        F.col("conv_id").alias("_conv"), F.col("call_id").alias("_call"), F.col("content").alias("content"), F.lit(True).alias("answered")
    )
    same = [F.col("conv_id").eqNullSafe(F.col("_conv")), F.col("call_id") == F.col("_call")]
    linked = left.join(right, same, "full_outer").select(
        F.coalesce("conv_id", "_conv").alias("conv_id"), F.coalesce("call_id", "_call").alias("call_id"), "turn", "level", "name", "arguments",
        F.when(F.col("called").isNull(), "no call").when(F.col("answered").isNull(), "no result").otherwise("linked").alias("status"),
        "content",
    )
    schema = "conv_id long, call_id string, turn long, level int, status string, name string, valid boolean, problem string, json string"
    names = [x.split()[0] for x in schema.split(", ")]

    def check(row: dict[str, Any]) -> dict[str, Any]:
        fault, arguments = None, None
        if row["status"] != "no call":
            try:
                arguments = json.loads(row["arguments"]) if row["arguments"] is not None else {}
                canonical(arguments)
            except (ValueError, RecursionError):
                fault = "$: not JSON"
        message = {"call_id": row["call_id"], "name": row["name"], "status": row["status"]}
        if row["status"] != "no result":
            message["content"] = row["content"]
        try:
            if row["status"] != "no call" and fault is None:
                own = schemas.get(row["name"])
                fault = "unknown tool" if own is None else problem(arguments, {"type": "object", **own})
                whole = canonical({**message, "arguments": arguments})
        except RecursionError:
            fault = "$: not JSON"
        if fault == "$: not JSON":
            whole = canonical({**message, "arguments": row["arguments"]})
        elif row["status"] == "no call":
            whole = canonical(message)
        valid = None if row["status"] == "no call" else fault is None
        return {**{n: row.get(n) for n in names}, "valid": valid, "problem": fault, "json": whole}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                rows = [check(r) for r in batch.slice(low, 1000).to_pylist()]
                yield pa.RecordBatch.from_pylist(rows, OUT)

    return linked.mapInArrow(run, schema)


OUT = pa.schema([
    ("conv_id", pa.int64()), ("call_id", pa.string()), ("turn", pa.int64()), ("level", pa.int32()), ("status", pa.string()),
    ("name", pa.string()), ("valid", pa.bool_()), ("problem", pa.string()), ("json", pa.string()),
])
