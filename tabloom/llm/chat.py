"""Chat formatting: link tool calls to their results, order them, check arguments, write canonical JSON.

Output is one row per message, so that a conversation that holds a third of all
messages is never gathered; (conv_id, order_key) is the order inside a conversation.
"""

from __future__ import annotations

import json
import math
import pathlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tabloom.llm.storage import written



def read_schemas(path: str | pathlib.Path) -> dict:
    """Tools and the JSON Schema of their arguments, from a JSON file ``{name: schema}``."""
    return json.loads(pathlib.Path(path).read_text(encoding="utf-8"))


#: Tools of the production query.
SCHEMAS = read_schemas(pathlib.Path(__file__).with_name("tool_schemas.json"))
#: Objects and lists inside each other; a text that goes deeper is plain text.
DEEPEST = 200
IS_TYPE = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
}


def canonical(value) -> str:
    """JSON with sorted keys, no white space and characters as they are; unpaired surrogates stay escaped."""
    out = json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    return out if out.isascii() or not any("\ud800" <= c <= "\udfff" for c in out) else json.dumps(value, sort_keys=True, separators=(",", ":"))


def errors_of(value, schema: dict, at: str = "$") -> list[str]:
    """Violations of type, enum, required, properties, additionalProperties and items."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(IS_TYPE[k](value) for k in kinds):
        return [f"{at}: not {'/'.join(kinds)}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not in enum")
    if isinstance(value, dict):
        own = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for k in sorted(value):
            if k in own:
                found += errors_of(value[k], own[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for k, x in enumerate(value):
            found += errors_of(x, schema["items"], f"{at}[{k}]")
    return found


def _object(text: str | None) -> dict | None:
    """The JSON object that a text is; None for any other text, numbers beyond a double and depths beyond ``DEEPEST``."""
    if not text or not text.lstrip().startswith("{"):
        return None
    try:
        value = json.loads(text, parse_constant=_refuse, parse_float=_finite)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) and _shallow(value) else None


def _refuse(name: str):
    raise ValueError(f"{name} is not JSON")


def _finite(digits: str) -> float:
    number = float(digits)
    return number if math.isfinite(number) else _refuse(digits)


def _shallow(value) -> bool:
    level = [value]
    for _ in range(DEEPEST):
        level = [x for v in level for x in (v.values() if isinstance(v, dict) else v) if isinstance(x, (dict, list))]
        if not level:
            return True
    return False


def _besides(value: dict, *known: str) -> dict:
    return {k: v for k, v in value.items() if k not in known}


def _calls_of(body: dict | None, schemas: dict) -> list[dict] | None:
    """Calls with id, name, arguments, errors, after and all their other keys.

    Name and arguments may stand in an object ``function``; what else it holds stays there.
    """
    calls = body.get("tool_calls") if body else None
    if not isinstance(calls, list) or not calls or not all(isinstance(c, dict) and isinstance(c.get("id"), str) for c in calls):
        return None
    out = []
    for c in calls:
        rest, inner = _besides(c, "id", "name", "arguments"), c
        if isinstance(c.get("function"), dict) and "name" not in c and "arguments" not in c:
            inner = rest.pop("function")
            if more := _besides(inner, "name", "arguments"):
                rest["function"] = more
        given = inner.get("arguments")
        if isinstance(given, str):
            parsed = _object(given)
            given = given if parsed is None else parsed
        name = inner.get("name") if isinstance(inner.get("name"), str) else ""
        wrong = errors_of(given, schemas[name]) if name in schemas else [f"$: unknown tool {name}"]
        after = [x for x in c["after"] if isinstance(x, str)] if isinstance(c.get("after"), list) else []
        out.append({"id": c["id"], "errors": wrong, "after": after, "json": rest | {"id": c["id"], "name": name, "arguments": given}})
    return _topological(out)


def _topological(calls: list[dict]) -> list[dict]:
    """Calls of one message after those of it that they name in ``after``; else as given, cycles last as given."""
    left, out, done = list(calls), [], set()
    own = {c["id"] for c in calls}
    while left:
        ready = [c for c in left if all(a in done or a not in own or a == c["id"] for a in c["after"])] or left
        out += ready
        done |= {c["id"] for c in ready}
        left = [c for c in left if not any(c is r for r in ready)]
    return out


FIELDS = (
    "conv_id {0}, turn {1}, role string, json string, result_of string, "
    "calls array<struct<id: string, rank: int, after: array<string>>>, n_calls int, argument_errors array<string>"
)


def parsed(messages: DataFrame, schemas: dict = SCHEMAS, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages with their canonical JSON, the ids of their calls, and the call they answer."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                body = _object(text) if role in ("assistant", "tool") else None
                calls = _calls_of(body, schemas) if role == "assistant" else None
                answered = body.get("tool_call_id") if role == "tool" and body else None
                answered = answered if isinstance(answered, str) else None
                message: dict = {"role": role, "content": text or ""}
                if calls:
                    content = body.get("content")
                    message = body | {"role": role, "content": "" if content is None else content, "tool_calls": [c["json"] for c in calls]}
                elif answered is not None:
                    message = body | {"role": role, "content": body.get("content")}
                wrong = [f"{c['id']} {e}" for c in calls or () for e in c["errors"]]
                own = {c["id"] for c in calls or ()}
                told = [{"id": c["id"], "rank": k, "after": [a for a in c["after"] if a not in own]} for k, c in enumerate(calls or ())]
                out.append((canonical(message), answered, told, len(told), wrong))
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.string(), pa.string(), pa.list_(pa.struct([("id", pa.string()), ("rank", pa.int32()), ("after", pa.list_(pa.string()))])), pa.int32(), pa.list_(pa.string()))
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], names=["conv_id", "turn", "role", "json", "result_of", "calls", "n_calls", "argument_errors"])

    source = messages.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    kinds = [source.schema[c].dataType.simpleString() for c in ("conv_id", "turn")]
    return source.mapInArrow(read, FIELDS.format(*kinds))


def _links(calls: DataFrame, results: DataFrame) -> DataFrame:
    """(conv_id, id, turn, call_turn, rank): the call that each result answers.

    Calls of one id and the results up to the next call of it belong together: the last
    results' worth of calls is paired with them in order, further results with the last
    call. Results before any call of their id go to the first.
    """
    events = calls.select("conv_id", "id", "turn", "rank", F.lit(0).alias("is_result")).distinct()
    events = events.unionByName(results.select("conv_id", "id", "turn", F.lit(0).alias("rank"), F.lit(1).alias("is_result")).distinct())
    order = Window.partitionBy("conv_id", "id").orderBy("turn", "is_result", "rank")
    begins = (F.col("is_result") == 0) & (F.coalesce(F.lag("is_result").over(order), F.lit(1)) == 1)
    run = events.withColumn("begins", begins.cast("int")).withColumn("run", F.sum("begins").over(order))
    run = run.withColumn("k", F.row_number().over(Window.partitionBy("conv_id", "id", "run", "is_result").orderBy("turn", "rank")))
    size = run.groupBy("conv_id", "id", "run").agg(F.sum("is_result").alias("n"), F.sum(1 - F.col("is_result")).alias("m"))
    both = F.least("m", "n")
    goal = F.when(F.col("run") == 0, 1).when(F.col("k") <= both, F.col("m") - both + F.col("k")).otherwise(F.col("m")).cast("int")
    asked = run.where("is_result = 1").join(size, ["conv_id", "id", "run"])
    asked = asked.select("conv_id", "id", "turn", F.greatest("run", F.lit(1)).alias("run"), goal.alias("k"))
    given = run.where("is_result = 0").select("conv_id", "id", "run", "k", F.col("turn").alias("call_turn"), "rank")
    return asked.join(given, ["conv_id", "id", "run", "k"]).select("conv_id", "id", "turn", "call_turn", "rank")


def _needs(calls: DataFrame) -> DataFrame:
    """(conv_id, turn, need): turns of messages with calls, and of the other messages whose calls they name in ``after``.

    A name means the latest call with that id before, else the earliest behind.
    """
    named = calls.select("conv_id", F.explode("after").alias("id"), "turn").distinct().withColumn("at", F.lit(None).cast("bigint"))
    events = named.unionByName(calls.select("conv_id", "id", "turn", F.col("turn").alias("at")).distinct()).where("turn IS NOT NULL")
    by = Window.partitionBy("conv_id", "id")
    before = F.last("at", ignorenulls=True).over(by.orderBy("turn", F.col("at").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    behind = F.last("at", ignorenulls=True).over(by.orderBy(F.desc("turn"), F.col("at").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0))
    found = events.select("conv_id", "turn", "at", F.coalesce(before, behind).alias("need"))
    return found.where("at IS NULL AND need <> turn").select("conv_id", "turn", "need").distinct()


def _moves(calls: DataFrame) -> DataFrame | None:
    """(conv_id, call_turn, to_turn, step): messages that come behind a later one, as ``after`` wants; None if there are none.

    Conversations that name a later call are ordered in rounds, a message when all it
    needs are; what is left are cycles, and stays. Moved messages stand behind the
    turn ``to_turn``, in the order of ``step``.
    """
    needs = written(_needs(calls), "chat-needs")
    late = needs.where("need > turn").select("conv_id").distinct()
    if late.isEmpty():
        return None
    needs = written(needs.join(late, "conv_id", "left_semi"), "chat-needs")
    placed = needs.select("conv_id", F.col("need").alias("turn")).distinct().join(needs, ["conv_id", "turn"], "left_anti")
    placed = written(placed.select("conv_id", "turn", F.col("turn").alias("to_turn"), F.lit(0).alias("step")), "chat-placed")
    while not needs.isEmpty():
        done = placed.select("conv_id", F.col("turn").alias("need"), F.struct("to_turn", (F.col("step") + 1).alias("step")).alias("behind"))
        ready = needs.join(done, ["conv_id", "need"], "left").groupBy("conv_id", "turn")
        ready = ready.agg(F.max("behind").alias("behind"), F.every(F.col("behind").isNotNull()).alias("all")).where("all")
        moved = F.col("behind.to_turn") >= F.col("turn")
        ready = ready.select(
            "conv_id", "turn", F.when(moved, F.col("behind.to_turn")).otherwise(F.col("turn")).alias("to_turn"), F.when(moved, F.col("behind.step")).otherwise(0).alias("step")
        )
        ready = written(ready, "chat-ready")
        if ready.isEmpty():
            break
        placed = written(placed.unionByName(ready), "chat-placed")
        needs = written(needs.join(ready, ["conv_id", "turn"], "left_anti"), "chat-needs")
    step = F.row_number().over(Window.partitionBy("conv_id", "to_turn").orderBy("step", "turn"))
    return placed.where("step > 0").select("conv_id", F.col("turn").alias("call_turn"), "to_turn", step.cast("bigint").alias("step"))


def format_chat(messages: DataFrame, schemas: dict = SCHEMAS, **columns: str) -> DataFrame:
    """One row per message: conv_id, turn, role, order_key, json, n_calls, argument_errors, link.

    An assistant text that is a JSON object with ``tool_calls`` (each with a string
    ``id``) holds calls; a tool text that is a JSON object with ``tool_call_id`` is a
    result. Results are joined to calls by conversation and id; if an id occurs in
    several calls, the latest at or before the result's turn counts, else the first
    behind it, and several results are paired in order (``_links``). ``order_key``
    sorts a conversation: by turn, a linked result right behind its call in the order of
    the calls, wherever it stood; a message with a call that names one of a later
    message in ``after`` comes behind that message and its results (``_moves``).
    ``link`` is ``linked`` or ``orphan`` for results, else NULL. A call has the keys
    ``name`` and ``arguments``, or both in an object ``function``; the JSON holds the
    first form. All other keys of a message or call stay; the role is the column's.
    Everything that is no valid JSON of these forms is plain text, also an object with
    a number beyond a double or nested deeper than ``DEEPEST``; such an arguments
    string stays a string. NULL text is empty text, a NULL role stays
    NULL; messages without conversation are never linked. Repeated messages give
    repeated rows; an empty table none.
    """
    rows = parsed(messages, schemas, **columns)
    conv, text = columns.get("conv_col", "conv_id"), columns.get("text_col", "text")
    able = messages.where(F.col(conv).isNotNull() & F.col(text).cast("string").contains("{"))  # no other text is an object
    able = parsed(able, schemas, **columns).where("n_calls > 0 OR result_of IS NOT NULL")
    able = written(able.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "result_of", "calls"), "chat-calls")
    calls = able.select("conv_id", "turn", F.inline("calls"))
    links = _links(calls, able.where("result_of IS NOT NULL").select("conv_id", F.col("result_of").alias("id"), "turn"))
    moves = _moves(calls)
    if moves is None:
        links = links.withColumns({"to_turn": F.col("call_turn"), "step": F.lit(0).cast("bigint")})
    else:
        moves = written(moves, "chat-moves")
        links = links.join(moves, ["conv_id", "call_turn"], "left")
        links = links.withColumns({"to_turn": F.coalesce("to_turn", "call_turn"), "step": F.coalesce("step", F.lit(0))})
    placed = links.select("conv_id", "turn", F.col("id").alias("result_of"), "to_turn", "step", (F.col("rank") + 1).alias("place"))
    if moves is not None:
        own = moves.select("conv_id", F.col("call_turn").alias("turn"), F.lit(None).cast("string").alias("result_of"), "to_turn", "step", F.lit(0).alias("place"))
        placed = placed.unionByName(own)
    placed = written(placed, "chat-links").alias("p")
    turn = F.col("r.turn").cast("bigint")
    same = (F.col("r.conv_id") == F.col("p.conv_id")) & turn.eqNullSafe(F.col("p.turn")) & F.col("r.result_of").eqNullSafe(F.col("p.result_of"))
    joined = rows.alias("r").join(placed, same & ((F.col("r.n_calls") > 0) | F.col("r.result_of").isNotNull()), "left")
    found = F.col("p.place").isNotNull()
    key = F.struct(
        F.when(found, F.col("p.to_turn")).otherwise(turn).alias("turn"),
        F.when(found, F.shiftleft("p.step", 32) + F.col("p.place")).otherwise(F.lit(0)).alias("place"),
        turn.alias("own_turn"),
    )
    result = F.col("r.result_of").isNotNull()
    link = F.when(result & found, F.lit("linked")).when(result, F.lit("orphan"))
    return joined.select("r.conv_id", "r.turn", "r.role", key.alias("order_key"), "r.json", "r.n_calls", "r.argument_errors", link.alias("link"))
