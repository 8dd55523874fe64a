"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from math import isfinite

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.arrow import map_arrow, map_rows
from sieveline.storage import written

#: How an assistant's text holds a call: a JSON object with id, name and arguments.
CALL = re.compile(r"<tool_call>(.*?)</tool_call>", re.DOTALL)
#: How a system or developer text declares tools: a JSON array of objects with name and parameters (a JSON Schema).
TOOLS = re.compile(r"<tools>(.*?)</tools>", re.DOTALL)
#: A string argument of this form stands for the result of another call, which must come before.
REFERENCE = re.compile(r"\$result:(\S+)")
RESULT_ROLES = ("tool", "function")
DECLARING_ROLES = ("system", "developer")
#: Schemas by tool name for tools that a conversation does not declare itself; tools without any schema are not validated.
SCHEMAS: dict[str, dict] = {}
_SURROGATES = re.compile("[\ud800-\udfff]")
_TYPES = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}
_ITEM = ("kind", "role", "call_id", "name", "body", "deps", "error", "json")
_PARSED = "conv_id long, turn long, item long, kind string, role string, call_id string, name string, body string, deps array<string>, error string, json string"
#: Edges of a conversation up to which its calls are ordered in one piece, and turns in a piece of a longer one.
PIECE_EDGES, PIECE_TURNS = 100_000, 256


# ---------------------------------------------------------------- JSON


def _number(text: str) -> float | int:
    value = float(text)
    if not isfinite(value):
        raise ValueError(f"{text} is no finite number")
    return int(value) if value.is_integer() and abs(value) < 1 << 53 else value


def _constant(text: str):
    raise ValueError(f"{text} is no JSON")


def loads(text: str):
    """The JSON value of ``text``; ValueError for anything that is not JSON, numbers beyond a double or nesting beyond the parser included."""
    try:
        return json.loads(text, parse_float=_number, parse_constant=_constant)
    except RecursionError:
        raise ValueError("nested too deeply") from None


def canonical(value) -> str:
    """JSON with keys sorted by code point, no white space, text as it is and whole floats as integers.

    Half surrogate pairs, which no encoding can hold, stay escapes.  ValueError if the nesting is beyond the writer.
    """
    try:
        made = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    except RecursionError:
        raise ValueError("nested too deeply") from None
    return _SURROGATES.sub(lambda m: f"\\u{ord(m[0]):04x}", made)


def _storable(value) -> bool:
    return isinstance(value, str) and not _SURROGATES.search(value)


def references(value) -> list[str]:
    """Ids of the calls whose results the arguments name, however deeply they are nested."""
    found, todo = set(), [value]
    while todo:
        v = todo.pop()
        if isinstance(v, str):
            found.update(r for r in REFERENCE.findall(v) if _storable(r))
        elif isinstance(v, dict):
            todo += v.values()
        elif isinstance(v, list):
            todo += v
    return sorted(found)


def faults(value, schema: dict, at: str = "$") -> list[str]:
    """What is wrong with ``value``: types, enum, required, properties, additionalProperties, items, minimum, maximum.

    Values equal those of an enum as JSON: 1 equals 1.0 but not true.
    """
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    kinds = schema.get("type")
    if kinds is not None:
        whole = number and (isinstance(value, int) or value.is_integer())
        fits = {"number": number, "integer": whole} | {k: isinstance(value, t) for k, t in _TYPES.items()}
        if not any(fits.get(k, False) for k in ([kinds] if isinstance(kinds, str) else kinds)):
            return [f"{at}: not of type {kinds}"]
    out = []
    if "enum" in schema and canonical(value) not in {canonical(v) for v in schema["enum"]}:
        out.append(f"{at}: not in enum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += faults(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += faults(v, schema["items"], f"{at}[{i}]")
    if number:
        if "minimum" in schema and value < schema["minimum"]:
            out.append(f"{at}: under minimum")
        if "maximum" in schema and value > schema["maximum"]:
            out.append(f"{at}: over maximum")
    return out


def checked(body: str, schema: str) -> str | None:
    """The faults of canonical arguments by a schema in JSON, joined; None for none.  A schema that cannot be read is a fault."""
    try:
        wrong = faults(loads(body), loads(schema))
    except (ValueError, TypeError, AttributeError, RecursionError):
        return "unusable schema"
    return _SURROGATES.sub("�", "; ".join(wrong)) or None


# ---------------------------------------------------------------- turns


def declared(text: str) -> Iterator[tuple[str, str]]:
    """(name, schema as canonical JSON) of the tools that a text declares; what is not readable declares nothing."""
    for block in TOOLS.findall(text):
        try:
            given = loads(block)
            for t in given if isinstance(given, list) else [given]:
                t = t.get("function", t) if isinstance(t, dict) else {}
                if isinstance(t, dict) and _storable(t.get("name")) and isinstance(t.get("parameters", {}), dict):
                    yield t["name"], canonical(t.get("parameters", {}))
        except ValueError:
            continue


def parse_call(block: str) -> dict:
    """call_id, name, body, deps and json of a call; ValueError if it is none."""
    given = loads(block)
    if not isinstance(given, dict) or not _storable(given.get("id")) or not _storable(given.get("name")):
        raise ValueError("no id or name")
    arguments = given.get("arguments", {})
    if isinstance(arguments, str):
        arguments = loads(arguments)
    return {
        "call_id": given["id"], "name": given["name"], "body": canonical(arguments), "deps": references(arguments),
        "json": canonical({"type": "call", "id": given["id"], "name": given["name"], "arguments": arguments}),
    }


def parse_turn(role: str | None, text: str | None) -> list[dict]:
    """The items of a turn, in order: its message without calls, then its calls; or a result; behind it the tools it declares."""
    text = text or ""
    row = dict.fromkeys(_ITEM) | {"role": role, "deps": []}

    def message(content: str, **more) -> dict:
        return row | {"kind": "message", "json": canonical({"role": role, "content": content})} | more

    if role in RESULT_ROLES:
        try:
            given = loads(text)
            if not isinstance(given, dict) or not _storable(given.get("id")):
                raise ValueError("no id")
            made = {"call_id": given["id"], "name": given.get("name") if _storable(given.get("name")) else None}
            return [row | made | {"kind": "result", "json": canonical({"type": "result", "id": given["id"], "content": given.get("content")})}]
        except ValueError:
            return [message(text, error="result without id")]
    if role in DECLARING_ROLES and "<tools>" in text:
        return [message(text), *(row | {"kind": "tool", "name": name, "body": schema} for name, schema in declared(text))]
    if role != "assistant" or "<tool_call>" not in text:
        return [message(text)]
    out = [message(CALL.sub("", text).strip())]
    for block in CALL.findall(text):
        try:
            out.append(row | {"kind": "call"} | parse_call(block))
        except ValueError:
            out.append(row | {"kind": "call", "error": "unreadable call", "json": canonical({"type": "call", "text": block})})
    return out


# ---------------------------------------------------------------- order


def _settle(piece: pa.Table) -> pa.Table:
    """The levels that follow within a piece of a conversation: rows (conv_id, call_id, dep, level of dep or null)."""
    conv = piece.column("conv_id")[0].as_py()
    waits, users, level, ready = defaultdict(int), defaultdict(list), defaultdict(int), []
    for call, dep, known in zip(piece.column("call_id").to_pylist(), piece.column("dep").to_pylist(), piece.column("level").to_pylist(), strict=True):
        level[call] = max(level[call], 0 if known is None else known + 1)
        waits[call] += known is None
        if known is None:
            users[dep].append(call)
    ready = [c for c, n in waits.items() if not n]
    for done in ready:  # grows as calls get ready
        for c in users.get(done, ()):
            level[c] = max(level[c], level[done] + 1)
            waits[c] -= 1
            if not waits[c]:
                ready.append(c)
    return pa.table({"conv_id": pa.array([conv] * len(ready), pa.int64()), "call_id": pa.array(ready, pa.string()), "level": pa.array([level[c] for c in ready], pa.int32())})


def levels(calls: DataFrame, piece_edges: int = PIECE_EDGES, piece_turns: int = PIECE_TURNS) -> DataFrame:
    """(conv_id, call_id, level) of ``calls`` (conv_id, call_id, turn, deps): 0 without references, else one over the highest of the calls referred to.

    References to calls that do not exist do not count.  Calls on a circle, or behind one, have no row.  A
    conversation with at most ``piece_edges`` references is ordered at once; a longer one in pieces of
    ``piece_turns`` turns, in as many rounds as its chains cross pieces.  There is no bound on depth.
    """
    edges = calls.select("conv_id", "call_id", "turn", F.explode(F.array_distinct("deps")).alias("dep"))
    known = calls.select("conv_id", F.col("call_id").alias("dep"))
    edges = edges.join(known, ["conv_id", "dep"], "left_semi")
    sizes = edges.groupBy("conv_id").agg(F.count("*").alias("n"))
    piece = F.when(F.col("n") > piece_edges, F.floor(F.col("turn") / piece_turns)).otherwise(F.lit(-1).cast("long")).alias("piece")
    edges = written(edges.join(sizes, "conv_id").select("conv_id", piece, "call_id", "dep"), "dependencies")
    free = calls.select("conv_id", "call_id").join(edges.select("conv_id", "call_id").distinct(), ["conv_id", "call_id"], "left_anti")
    done = written(free.withColumn("level", F.lit(0)), "levels")
    waiting = edges
    while not waiting.isEmpty():
        given = waiting.join(done.select("conv_id", F.col("call_id").alias("dep"), "level"), ["conv_id", "dep"], "left")
        new = written(given.select("conv_id", "piece", "call_id", "dep", "level").groupBy("conv_id", "piece").applyInArrow(_settle, "conv_id long, call_id string, level int"), "levels")
        if new.isEmpty():
            break
        done = done.unionByName(new)
        waiting = written(waiting.join(new.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti"), "waiting")
    return done


# ---------------------------------------------------------------- all of it


def _validated(calls: DataFrame, tools: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``calls`` with error: by the schema that the conversation declares for the tool, else by that of ``schemas``."""
    own = tools.groupBy("conv_id", "name").agg(F.min_by("body", F.struct("turn", "item", "body")).alias("_schema"))
    names = tools.groupBy("conv_id").agg(F.lit(True).alias("_declares"))
    joined = calls.join(own, ["conv_id", "name"], "left").join(names, "conv_id", "left")
    shared = {k: canonical(v) for k, v in schemas.items()}
    columns = calls.columns

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            errors = []
            for name, body, error, schema, declares in zip(*(b.column(c).to_pylist() for c in ("name", "body", "error", "_schema", "_declares")), strict=True):
                schema = schema if schema is not None else shared.get(name)
                if error is None and schema is not None:
                    error = checked(body, schema)
                elif error is None and declares:
                    error = "undeclared tool"
                errors.append(error)
            yield pa.RecordBatch.from_arrays([pa.array(errors, pa.string()) if c == "error" else b.column(c) for c in columns], names=columns)

    return map_arrow(joined, check, calls.schema)


def format_chats(turns: DataFrame, schemas: dict[str, dict] | None = None) -> DataFrame:
    """A row for each message, call and result of ``turns`` (conv_id, turn, role, text).

    conv_id, turn, item (place within the turn), kind, role, call_id, name, level, anchor_turn, anchor_item, linked,
    error, json.  Calls and results meet by conv_id and id: of several with one id the first by turn, item and JSON is
    linked, the rest are 'repeated id' (rows that are equal in all of these are linked alike); a result before or
    without a call is an 'orphan', a call without a result is not linked.  Within a conversation rows are in order by
    (anchor_turn, level, anchor_item, kind, turn, item): a result stands right behind its call, and a call behind the
    calls whose results it refers to; calls on a circle are 'circular'.  Arguments are validated by the schema that a
    system or developer turn of the conversation declares, the first of several, else by ``schemas``; error names what
    is wrong, 'undeclared tool' included; nothing is dropped.  json is the canonical form of the item.

    Null and empty texts are empty messages.  Text that is not JSON (NaN, numbers beyond a double, nesting beyond the
    parser, about 10,000 levels) is an 'unreadable call' or a 'result without id' and kept as text; ids and names with
    half surrogate pairs are none.  Rows with a null conv_id link to nothing.  Columns of other names are not looked
    at; repeated rows stay; an empty table gives an empty table.  Messages are not joined with anything, so a
    conversation of any length is no single task.
    """
    schemas = SCHEMAS if schemas is None else schemas

    def parse(slices: Iterator[dict]) -> Iterator[dict]:
        for x in slices:
            out = {c: [] for c in ("conv_id", "turn", "item", *_ITEM)}
            for conv, turn, role, text in zip(x["conv_id"], x["turn"], x["role"], x["text"], strict=True):
                for i, r in enumerate(parse_turn(role, text)):
                    for c, v in {"conv_id": conv, "turn": turn, "item": i, **r}.items():
                        out[c].append(v)
            yield out

    own = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    parsed = written(map_rows(own, parse, _PARSED), "items")
    key, place = ["conv_id", "call_id"], F.struct("turn", "item", "json")
    loose = parsed.filter("kind = 'message' or (kind <> 'tool' and (call_id is null or conv_id is null))")
    named = parsed.filter("kind in ('call', 'result') and call_id is not null and conv_id is not null")
    checked_calls = _validated(named.filter("kind = 'call'"), parsed.filter("kind = 'tool'"), schemas)
    named = written(checked_calls.unionByName(named.filter("kind = 'result'")), "named")
    first = lambda kind: named.filter(F.col("kind") == kind).groupBy(*key).agg(F.min(place).alias("at"))
    calls = named.filter("kind = 'call'").groupBy(*key).agg(F.min_by("deps", place).alias("deps"), F.min("turn").alias("turn"))
    pairs = first("call").withColumnRenamed("at", "call_at").join(first("result").withColumnRenamed("at", "result_at"), key, "full")
    rows = named.join(pairs.join(levels(calls), key, "left"), key)
    call, result = F.col("kind") == "call", F.col("kind") == "result"
    leads = F.coalesce(F.when(call, F.col("call_at") == place).otherwise(F.col("result_at") == place), F.lit(False))
    before = lambda c: F.struct(f"{c}.turn", f"{c}.item")
    met = F.col("call_at").isNotNull() & F.col("result_at").isNotNull() & (before("result_at") > before("call_at"))
    state = F.when(call & F.col("level").isNull(), F.lit("circular")).when(~leads, F.lit("repeated id")).when(result & ~met, F.lit("orphan"))
    anchored = result & leads & met
    at = ("conv_id", "turn", "item", "kind", "role", "call_id", "name")
    rows = rows.select(
        *at,
        F.when(call | anchored, F.coalesce("level", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("level"),
        F.when(anchored, F.col("call_at.turn")).otherwise(F.col("turn")).alias("anchor_turn"),
        F.when(anchored, F.col("call_at.item")).otherwise(F.col("item")).alias("anchor_item"),
        (leads & met).alias("linked"),
        F.nullif(F.concat_ws("; ", state, "error"), F.lit("")).alias("error"),
        "json",
    )
    loose = loose.select(*at, F.lit(0).cast("long").alias("level"), F.col("turn").alias("anchor_turn"), F.col("item").alias("anchor_item"), F.lit(False).alias("linked"), "error", "json")
    return loose.unionByName(rows)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
