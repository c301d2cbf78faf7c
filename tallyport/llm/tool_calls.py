"""Tool-call linking: calls meet their results by identifier, in an order that respects references.

`parse_calls` reads each call's arguments once: canonical JSON, the calls they refer to
({"$ref": call id} anywhere inside) and what the tool's schema objects to. `link` joins
calls and results on (conv_id, call_id). `levels` orders calls: a call without references
has level 0, another one more than the highest it refers to. Every call follows one of its
references; the lengths of the paths that result are found by pointer doubling, in as many
joins as the logarithm of the longest, for all conversations at once. As long as another
reference of a call leads higher than the one it follows, it follows that one instead.
No conversation is gathered anywhere. Order inside a conversation is (level, turn, call_id).
`serialise` writes canonical JSON: sorted keys, no spaces, shortest numbers, text unescaped.

Defined results: arguments that are NULL or no JSON object are an error and count as {}, and
so are numbers that JSON has not (NaN, infinities, numbers beyond a double, whole numbers of
more than 4,300 digits) and arguments nested deeper than the parser goes; a tool without
schema is an error; a reference to a call that is not there is an error and orders nothing;
calls on a cycle, and those after one, have a NULL level and an error; of calls or results
that repeat an id the first by (turn, text) is used and the others are counted; results
without a call are rows of their own; rows without conv_id or call id stay single, with level
0; half surrogates stay escaped; NULL and empty texts are values like others; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.common import map_arrow, stored

# The tools of the registered query: JSON schemas of their arguments.
TOOLS = {
    "search": {
        "type": "object", "required": ["query", "limit"], "additionalProperties": False,
        "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 40},
                       "after": {"type": "object"}},
    },
    "measure": {
        "type": "object", "required": ["text", "unit"], "additionalProperties": False,
        "properties": {"text": {"type": "string"}, "unit": {"enum": ["words", "chars"]}, "after": {"type": "object"}},
    },
}
KINDS = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
}


def plain(text: str) -> str:
    """A text that UTF-8 can hold: half surrogates as their escapes."""
    return text.encode("utf-8", "backslashreplace").decode("utf-8")


def canonical(value) -> str:
    """One text for equal values: sorted keys, no spaces, whole floats as integers.

    Walks with a stack of its own, so it goes as deep as its value.
    """
    out: list[str] = []
    todo: list[tuple[bool, object]] = [(False, value)]  # (ready to be written as it is, what)
    while todo:
        ready, value = todo.pop()
        if ready:
            out.append(value)
        elif isinstance(value, dict):
            parts: list[tuple[bool, object]] = [(True, "{")]
            for i, key in enumerate(sorted(value)):
                parts += [(True, f"{',' * (i > 0)}{canonical(key)}:"), (False, value[key])]
            todo += reversed([*parts, (True, "}")])
        elif isinstance(value, list):
            parts = [(True, "[")]
            for i, item in enumerate(value):
                parts += [(True, ",")] * (i > 0) + [(False, item)]
            todo += reversed([*parts, (True, "]")])
        else:
            if isinstance(value, float) and value.is_integer() and abs(value) < 1e21:
                value = int(value)
            out.append(plain(json.dumps(value, ensure_ascii=False)))
    return "".join(out)


def objections(value, schema: dict) -> list[str]:
    """What a schema objects to, each with its place; goes as deep as the schema says something."""
    out: list[str] = []
    todo: list[tuple | str] = [(value, schema, "")]
    while todo:
        if isinstance(todo[-1], str):
            out.append(todo.pop())
            continue
        value, schema, at = todo.pop()
        here = plain(at) or "arguments"
        kinds = schema.get("type")
        kinds = [kinds] if isinstance(kinds, str) else kinds or []
        if kinds and not any(KINDS[k](value) for k in kinds):
            out.append(f"{here}: not {' or '.join(kinds)}")
            continue
        if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
            out.append(f"{here}: not one of {canonical(schema['enum'])}")
        if KINDS["number"](value):
            out += [f"{here}: below {schema['minimum']}"] if value < schema.get("minimum", value) else []
            out += [f"{here}: above {schema['maximum']}"] if value > schema.get("maximum", value) else []
        if isinstance(value, str):
            out += [f"{here}: too short"] if len(value) < schema.get("minLength", 0) else []
            out += [f"{here}: too long"] if len(value) > schema.get("maxLength", len(value)) else []
        below = []
        if isinstance(value, list) and "items" in schema:
            below = [(item, schema["items"], f"{at}[{i}]") for i, item in enumerate(value)]
        if isinstance(value, dict):
            known = schema.get("properties", {})
            out += [f"{here}: {name} is missing" for name in schema.get("required", []) if name not in value]
            closed = schema.get("additionalProperties", True) is False
            below = [
                (value[name], known[name], f"{at}.{name}" if at else name) if name in known else f"{here}: {plain(name)} is unknown"
                for name in sorted(value) if name in known or closed
            ]
        todo += reversed(below)
    return out


def references(value) -> set[str]:
    """The calls that a value refers to."""
    found, todo = set(), [value]
    while todo:
        value = todo.pop()
        if isinstance(value, dict) and isinstance(value.get("$ref"), str):
            found.add(plain(value["$ref"]))
        elif isinstance(value, dict):
            todo += value.values()
        elif isinstance(value, list):
            todo += value
    return found


def _number(text: str) -> float:
    """A number of JSON that a double holds."""
    value = float(text)
    if not math.isfinite(value):
        raise ValueError(f"{text} is beyond a double")
    return value


def _no_number(name: str):
    raise ValueError(f"{name} is no JSON")


def read_arguments(text: str | None, schema: dict | None) -> tuple[str, list[str], list[str]]:
    """(canonical arguments, references, errors) of one call."""
    try:
        value = json.loads(text or "", parse_float=_number, parse_constant=_no_number)
    except RecursionError:
        return "{}", [], ["arguments: nested too deep"]
    except ValueError:
        return "{}", [], ["arguments: no JSON"]
    if not isinstance(value, dict):
        return "{}", [], ["arguments: not object"]
    errors = ["name: no such tool"] if schema is None else objections(value, schema)
    return canonical(value), sorted(references(value)), errors


def parse_calls(calls: DataFrame, tools: dict[str, dict]) -> DataFrame:
    """calls (conv_id, call_id, turn, name, arguments) with arguments read; the tools travel with the code."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [read_arguments(a, tools.get(n)) for n, a in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:4], pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.list_(pa.string())), pa.array([r[2] for r in rows], pa.list_(pa.string())),
                ],
                names=["conv_id", "call_id", "turn", "name", "arguments", "refs", "errors"],
            )

    slim = calls.select(
        F.col("conv_id").cast("long").alias("conv_id"), "call_id", F.col("turn").cast("long").alias("turn"), "name", "arguments"
    )
    return map_arrow(
        slim, work,
        "conv_id long, call_id string, turn long, name string, arguments string, refs array<string>, errors array<string>",
    )


KEY = ["conv_id", "call_id"]
# Level of calls on a cycle or after one, above any other.
ENDLESS = 1 << 62


def path_lengths(calls: DataFrame, follows: DataFrame, most: int) -> DataFrame:
    """(conv_id, call_id, level): steps from each call to the end of the path along `follows`.

    Pointer doubling: a pointer is joined with its target's, which doubles its reach, until
    it is at an end. A path of more steps than a conversation has calls goes in a circle.
    """
    at_end = F.col("ref").isNull()
    paths = stored(calls.join(follows, KEY, "left").select(*KEY, "ref", F.when(at_end, 0).otherwise(1).cast("long").alias("level")), "paths")
    for _ in range(most.bit_length()):
        moving = paths.where("ref IS NOT NULL")
        if moving.isEmpty():
            break
        target = paths.select("conv_id", F.col("call_id").alias("ref"), F.col("ref").alias("next"), F.col("level").alias("further"))
        doubled = moving.join(target, ["conv_id", "ref"]).select(*KEY, F.col("next").alias("ref"), (F.col("level") + F.col("further")).alias("level"))
        paths = stored(paths.where("ref IS NULL").unionByName(doubled), "paths")
    return paths.select(*KEY, F.when(at_end, F.col("level")).otherwise(ENDLESS).alias("level"))


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls (conv_id, call_id, turn, refs) that are on no cycle and after none.

    A call first follows its reference of the latest turn. Where the level of another one
    is higher than the path that a call follows, the call follows that one from then on;
    each such round makes paths longer only, and mostly one is enough.
    """
    nodes = calls.select(*KEY)
    edges = stored(
        calls.select(*KEY, F.explode("refs").alias("ref")).join(
            calls.select("conv_id", F.col("call_id").alias("ref"), F.col("turn").alias("at")), ["conv_id", "ref"]
        ),
        "references",
    )
    most = nodes.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    follows = edges.groupBy(*KEY).agg(F.max(F.struct("at", "ref")).alias("last")).select(*KEY, "last.ref")
    while True:
        now = stored(path_lengths(nodes, follows, most), "levels")
        above = edges.join(now.select("conv_id", F.col("call_id").alias("ref"), "level"), ["conv_id", "ref"])
        highest = above.groupBy(*KEY).agg(F.max(F.struct("level", "ref")).alias("highest"))
        better = stored(
            highest.join(now, KEY).where(F.least(F.col("highest.level") + 1, F.lit(ENDLESS)) > F.col("level")).select(*KEY, F.col("highest.ref").alias("higher")),
            "better",
        )
        if better.isEmpty():
            return now.where(F.col("level") < ENDLESS).select(*KEY, F.col("level").cast("int").alias("level"))
        follows = stored(follows.join(better, KEY, "left").select(*KEY, F.coalesce("higher", "ref").alias("ref")), "follows")


def first_of(rows: DataFrame, order: list[str], values: list[str]) -> DataFrame:
    """One row for each (conv_id, call_id), the first in `order`, and how many there were."""
    best = F.min(F.struct(*order, *(v for v in values if v not in order))).alias("best")
    return rows.groupBy("conv_id", "call_id").agg(best, F.count("*").alias("n")).select(
        "conv_id", "call_id", "n", *(F.col(f"best.{v}").alias(v) for v in values)
    )


def link(calls: DataFrame, results: DataFrame, tools: dict[str, dict]) -> DataFrame:
    """A row for each call, and each result without one: level, status, errors and canonical JSON.

    results: conv_id, call_id, turn, content. Rows without an identifier meet nothing.
    """
    has_id = "conv_id IS NOT NULL AND call_id IS NOT NULL"
    whole = stored(parse_calls(calls, tools).withColumn("lone", F.monotonically_increasing_id()), "calls")
    values = ["turn", "name", "arguments", "refs", "errors"]
    one = first_of(whole.filter(has_id), ["turn", "name", "arguments"], values)
    lone = whole.filter(f"NOT ({has_id})").select("conv_id", "call_id", "lone", F.lit(1).cast("long").alias("n"), *values)
    answers = results.select(
        F.col("conv_id").cast("long").alias("conv_id"), "call_id", F.col("turn").cast("long").alias("r_turn"), "content"
    )
    answer = first_of(answers.filter(has_id), ["r_turn", "content"], ["r_turn", "content"]).withColumnRenamed("n", "n_results")
    left_over = answers.filter(f"NOT ({has_id})").select(
        "conv_id", "call_id", F.lit(1).cast("long").alias("n_results"), "r_turn", "content"
    )
    one = stored(one, "calls")
    known = one.select("conv_id", F.col("call_id").alias("ref"))

    def unknown(rows: DataFrame, key: list[str]) -> DataFrame:
        refs = rows.select("conv_id", *[k for k in key if k != "conv_id"], F.explode("refs").alias("ref"))
        return refs.join(known, ["conv_id", "ref"], "left_anti").groupBy(*key).agg(F.array_sort(F.collect_set("ref")).alias("missing"))

    lone = lone.join(unknown(lone, ["lone"]), "lone", "left").drop("lone")
    joined = (
        one.join(levels(one), KEY, "left").join(unknown(one, KEY), KEY, "left").join(answer, KEY, "full")
        .unionByName(lone.withColumn("level", F.lit(0)), allowMissingColumns=True)
        .unionByName(left_over, allowMissingColumns=True)
    )
    is_call, answered = F.col("n").isNotNull(), F.col("n_results").isNotNull()
    status = F.when(is_call & answered, "linked").when(is_call, "no_result").otherwise("no_call")
    errors = F.concat(
        F.coalesce("errors", F.array().cast("array<string>")),
        F.transform(F.coalesce("missing", F.array().cast("array<string>")), lambda r: F.concat(F.lit("refers to no call: "), r)),
        F.when(is_call & F.col("level").isNull(), F.array(F.lit("refers in a cycle"))).otherwise(F.array().cast("array<string>")),
    )
    return joined.select(
        "conv_id", "call_id", F.coalesce("turn", "r_turn").alias("turn"), F.col("level").cast("int").alias("level"),
        status.alias("status"), "name", "arguments", errors.alias("errors"), "content",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_calls"), F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
    )


def serialise(linked: DataFrame) -> DataFrame:
    """Adds `json`: the call with its result as canonical JSON; keys without value are null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for row in batch.to_pylist():
                parts = {
                    "arguments": row["arguments"] or "null", "call_id": canonical(row["call_id"]),
                    "errors": canonical(row["errors"]), "level": canonical(row["level"]), "name": canonical(row["name"]),
                    "result": canonical(row["content"]), "status": canonical(row["status"]),
                }
                texts.append("{" + ",".join(f'"{k}":{v}' for k, v in parts.items()) + "}")
            keep = [batch.schema.get_field_index(n) for n in ("conv_id", "call_id", "turn", "level", "status", "name")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in keep), pa.array([len(e) for e in batch.column("errors").to_pylist()], pa.int64()),
                    batch.column("n_calls"), batch.column("n_results"), pa.array(texts, pa.string()),
                ],
                names=["conv_id", "call_id", "turn", "level", "status", "name", "n_errors", "n_calls", "n_results", "json"],
            )

    return map_arrow(
        linked, work,
        "conv_id long, call_id string, turn long, level int, status string, name string, n_errors long, n_calls long, "
        "n_results long, json string",
    )


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results as the registered query takes them from conversations.

    Every user turn asks a tool, every assistant turn answers the call of the turn before
    it. A call refers to the call two turns earlier (from turn 2 on); tool, limit and unit
    follow from turn and text, so some calls break their schema.
    """
    call_id = lambda turn: F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))
    turn, text = F.col("turn"), F.col("text")
    after = F.when(turn >= 2, F.concat(F.lit('"after":{"$ref":"'), call_id(turn - 2), F.lit('"},'))).otherwise(F.lit(""))
    quoted = F.expr("left({0}, length({0}) - 1)".format("substring(to_json(named_struct('t', coalesce(text, ''))), 6)"))
    search = F.concat(F.lit("{"), after, F.lit('"query":'), quoted, F.lit(', "limit": '), F.size(F.split(text, " ")).cast("string"), F.lit("}"))
    unit = F.when(F.length(text) % 5 == 0, "lines").when(F.length(text) % 2 == 0, "words").otherwise("chars")
    measure = F.concat(F.lit('{"unit":"'), unit, F.lit('", '), after, F.lit('"text": '), quoted, F.lit("}"))
    calls = conversations.filter("role = 'user'").select(
        "conv_id", call_id(turn).alias("call_id"), "turn", F.when(turn % 4 == 0, "search").otherwise("measure").alias("name"),
        F.when(turn % 4 == 0, search).otherwise(measure).alias("arguments"),
    )
    results = conversations.filter("role = 'assistant'").select(
        "conv_id", call_id(turn - 1).alias("call_id"), "turn", text.alias("content")
    )
    return calls, results


def digest(conversations: DataFrame) -> DataFrame:
    """Linked calls of the conversations table, each with its canonical JSON."""
    calls, results = calls_of(conversations)
    return serialise(link(calls, results, TOOLS))
