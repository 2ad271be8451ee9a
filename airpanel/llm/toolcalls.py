"""Chat formatting: tool calls linked to their results.

Calls and results are hash-joined by conversation and call id, never gathered per conversation: each message stays a row
of its own, with its place in the order. A call may use the results of other calls (``uses``); a message's level is the
length of the longest chain before it, found by rounds of joins in which a call takes over what the calls it uses still wait
for, so that chains halve in each round. The order of a conversation respects these chains and otherwise follows the turns. Arguments are validated against the schema of their tool (type, required,
properties, additionalProperties, enum, minimum, maximum, minLength, maxLength, items); texts become canonical JSON:
sorted keys, no spaces, no escapes beyond those JSON needs.

Defined results: a call without result is ``open``, a result without call ``orphan``, and these are kept; of several calls with
one id the first turn is the call (of one turn, that of the smallest digest) and the others are ``repeated``, and so for results; a call to an unknown tool,
with arguments that are no JSON object, or outside its schema is invalid, with the reason; calls that
wait for each other are ``cyclic``; null ids never link; null texts are written as null; repeated rows stay rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airpanel.llm.batches import by_value, stored

by_value(__name__)

_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _is(value: object, kind: str) -> bool:
    if kind in ("integer", "number"):
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        return number and (kind == "number" or float(value).is_integer())
    return isinstance(value, _TYPES[kind])


def violations(value: object, schema: dict, path: str = "$") -> list[str]:
    """What contradicts the schema, as texts that begin with the place."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{path}: not of type {'|'.join(kinds)}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{path}: not in enum")
    if isinstance(value, str):
        found += [f"{path}: too short"] * (len(value) < schema.get("minLength", 0))
        found += [f"{path}: too long"] * (len(value) > schema.get("maxLength", float("inf")))
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        found += [f"{path}: below minimum"] * (value < schema.get("minimum", float("-inf")))
        found += [f"{path}: above maximum"] * (value > schema.get("maximum", float("inf")))
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += violations(item, schema["items"], f"{path}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{path}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in known:
                found += violations(v, known[k], f"{path}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{path}.{k}: unknown")
    return found


def checked(name: object, arguments: object, schemas: dict[str, dict]) -> tuple[object, str | None]:
    """(arguments as a value or the text as given, reason why they are invalid or None)."""
    try:
        value = json.loads(arguments)
    except (TypeError, ValueError):
        return arguments if isinstance(arguments, str) else None, "$: no JSON"
    if name not in schemas:
        return value, "unknown tool"
    return value, "; ".join(violations(value, {"type": "object", **schemas[name]})) or None


def _written(batches: Iterator[pa.RecordBatch], schemas: dict[str, dict]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, reasons = [], []
        for row in batch.select(["kind", "call_id", "name", "body"]).to_pylist():
            reason = None
            if row["kind"] == "call":
                value, reason = checked(row["name"], row["body"], schemas)
                message = {"role": "assistant", "tool_calls": [
                    {"id": row["call_id"], "type": "function", "function": {"name": row["name"], "arguments": value}}]}
            elif row["kind"] == "result":
                message = {"role": "tool", "tool_call_id": row["call_id"], "content": row["body"]}
            else:
                message = {"role": row["name"], "content": row["body"]}
            texts.append(canonical(message))
            reasons.append(reason)
        kept = [c for c in batch.schema.names if c not in ("name", "body")]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(reasons, pa.string()), pa.array(texts, pa.string())],
                                         names=[*kept, "reason", "json"])


def _levels(calls: DataFrame, results: DataFrame) -> DataFrame:
    """(conv_id, call_id, level, after_call, after_result, cyclic) of each call.

    Level 0 uses no other call. ``after_call`` is the first turn at which a call may stand: its own, or the largest
    ``after_result`` of what it uses if that is later; ``after_result`` is that of its result.

    In a round, a used call that waits for nothing is settled, and one that waits for a single call is replaced by that
    call, ``steps`` further on; only calls that wait for several stay. A round that frees no call leaves those that wait
    for each other.
    """
    keys = ["conv_id", "call_id"]
    nodes = stored(calls.select(*keys, "turn", "uses").join(results.select(*keys, F.col("turn").alias("result_turn")), keys, "left"),
                   "calls-nodes")
    uses = nodes.select(*keys, F.explode("uses").alias("used")).distinct()
    uses = stored(uses.join(nodes.select("conv_id", F.col("call_id").alias("used")), ["conv_id", "used"])
                  .select(*keys, "used", F.lit(1).cast("long").alias("steps")), "calls-uses")
    own = F.greatest("turn", F.coalesce("result_turn", "turn"))
    found = nodes.select(*keys, "turn", own.alias("own"), F.lit(0).cast("long").alias("level"), F.lit(None).cast("long").alias("after"))
    waiting = uses.select(*keys).distinct().count()
    most = F.lit(nodes.count() if waiting else 0)  # no chain has more steps, only a circle
    while waiting:
        waits = uses.groupBy("conv_id", F.col("call_id").alias("used")).agg(
            F.count("*").alias("open"), F.first("used").alias("next"), F.first("steps").alias("more"))
        before = found.select("conv_id", F.col("call_id").alias("used"), F.col("level").alias("base"), F.greatest("own", "after").alias("ready"))
        passed = F.col("open").isNull() | (F.col("open") == 1)
        moved = stored(
            uses.join(before, ["conv_id", "used"]).join(waits, ["conv_id", "used"], "left").select(
                *keys, F.when(F.col("open") == 1, F.col("next")).when(F.col("open") > 1, F.col("used")).alias("used"),
                F.least(F.col("steps") + F.when(F.col("open") == 1, F.col("more")).otherwise(0), most).alias("steps"),
                F.when(passed, F.col("base") + F.col("steps")).alias("level"), F.when(passed, F.col("ready")).alias("after"))
            .groupBy(*keys, "used").agg(F.max("steps").alias("steps"), F.max("level").alias("level"), F.max("after").alias("after")), "calls-uses")
        gained = moved.groupBy(*keys).agg(F.max("level").alias("more_level"), F.max("after").alias("more_after"))
        found = stored(found.join(gained, keys, "left").select(
            *keys, "turn", "own", F.greatest("level", "more_level").alias("level"), F.greatest("after", "more_after").alias("after")), "calls-levels")
        uses = moved.where("used IS NOT NULL").select(*keys, "used", "steps")
        still = uses.select(*keys).distinct().count()
        if still == waiting:
            break
        waiting = still
    stuck = uses.select(*keys).distinct().withColumn("cyclic", F.lit(True))
    placed = lambda turn: F.when(F.col("cyclic"), F.col(turn)).otherwise(F.greatest(turn, "after"))
    return found.join(stuck, keys, "left").withColumn("cyclic", F.coalesce("cyclic", F.lit(False))).select(
        *keys, F.when(~F.col("cyclic"), F.col("level")).cast("int").alias("level"), placed("turn").alias("after_call"),
        placed("own").alias("after_result"), "cyclic")


def _digested(df: DataFrame, *columns: str) -> DataFrame:
    """With ``digest``, which tells the different rows of a conversation apart, unless the frame brings one."""
    if "digest" in df.columns:
        return df
    return df.withColumn("digest", F.left(F.md5(F.to_json(F.struct("turn", *columns)).cast("binary")), F.lit(16)))


def linked(calls: DataFrame, results: DataFrame, others: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per message, linked and ordered.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), uses (array of call ids); ``results``: conv_id, turn,
    call_id, content; ``others``: conv_id, turn, role, text. Calls and results may bring a ``digest`` of what tells the
    different rows of a conversation apart; then a frame that was joined on conv_id and digest moves its texts no more. Returns conv_id, turn, kind, call_id, status, level, order_turn,
    partner_turn, reason and json. Sorted by (order_turn, level, turn), a conversation has every call before its result and after
    the results it uses, and is otherwise in the order of its turns.
    """
    keys, row = ["conv_id", "call_id"], ["conv_id", "digest"]
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    calls, results = _digested(calls, "call_id", "name", "arguments", "uses"), _digested(results, "call_id", "content")

    def firsts(df: DataFrame, name: str, *more: str) -> DataFrame:
        first = df.where(known).groupBy(*keys).agg(F.min(F.struct("turn", "digest", *more)).alias("first"))
        return stored(first.select(*keys, "first.*"), name)

    first_calls, first_results = firsts(calls, "first-calls", "uses"), firsts(results, "first-results")
    ids = (_levels(first_calls, first_results)
           .join(first_calls.select(*keys, F.col("turn").alias("call_turn"), F.col("digest").alias("call_digest")), keys)
           .join(first_results.select(*keys, F.col("turn").alias("result_turn"), F.col("digest").alias("result_digest")), keys, "full"))

    def placed(df: DataFrame, own: str, other: str) -> DataFrame:
        """The messages with what their call id knows; texts move in this one join. Of equal rows one is the first."""
        known_of = df.where(known).select(*keys, "digest").join(ids, keys, "left").select(
            *row, (F.col("digest") == F.col(f"{own}_digest")).alias("is_first"), F.col(f"{other}_digest").isNotNull().alias("found"),
            F.col(f"{other}_turn").alias("partner_turn"), "level", F.col(f"after_{own}").alias("after"), "cyclic"
        ).dropDuplicates(row)
        nth = Window.partitionBy(*row).orderBy("digest")
        return df.join(known_of, row, "left").withColumn("status", F.when(F.col("is_first").isNotNull(), (
            F.when(~F.col("is_first") | (F.row_number().over(nth) > 1), "repeated").when(F.col("found"), "linked"))))

    c = placed(calls, "call", "result").select(
        "conv_id", "turn", F.lit("call").alias("kind"), "call_id",
        F.when(F.col("cyclic"), "cyclic").otherwise(F.coalesce("status", F.lit("open"))).alias("status"),
        (2 * F.col("level")).alias("level"), F.greatest("turn", F.coalesce("after", "turn")).alias("order_turn"),
        "partner_turn", F.col("name"), F.col("arguments").alias("body"))
    r = placed(results, "result", "call").select(
        "conv_id", "turn", F.lit("result").alias("kind"), "call_id", F.coalesce("status", F.lit("orphan")).alias("status"),
        (2 * F.col("level") + 1).alias("level"), F.greatest("turn", F.coalesce("after", "turn")).alias("order_turn"),
        "partner_turn", F.lit(None).cast("string").alias("name"), F.col("content").alias("body"))
    o = others.select("conv_id", "turn", F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"),
                      F.lit("plain").alias("status"), F.lit(0).alias("level"), F.col("turn").alias("order_turn"),
                      F.lit(None).cast("long").alias("partner_turn"), F.col("role").alias("name"), F.col("text").alias("body"))
    return c.unionByName(r).unionByName(o).mapInArrow(partial(_written, schemas=schemas), (
        "conv_id long, turn long, kind string, call_id string, status string, level int, order_turn long, partner_turn long, "
        "reason string, json string"))


ANSWER = {
    "answer": {
        "properties": {"question": {"type": "string", "minLength": 1}, "words": {"type": "integer", "minimum": 1}},
        "required": ["question", "words"], "additionalProperties": False,
    },
}


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and other messages of a plain chat: each user turn asks the tool ``answer``, an assistant turn answers.

    An answer belongs to the last user turn before it, whatever stands between and whatever numbers are left out; without
    one it has no call id. A call uses the last call before it that was answered, since its question follows on that
    answer. Both come from running maxima over the turns and roles of a conversation; the texts are joined to them.
    """
    turns = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    name = lambda t: F.concat(F.lit("call_"), F.col(t).cast("string"))
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    ordered = Window.partitionBy("conv_id").orderBy("turn")
    before, upto = (ordered.rangeBetween(Window.unboundedPreceding, last) for last in (-1, Window.currentRow))
    spoken = turns.where("role IN ('user', 'assistant')").withColumn(
        "digest", F.left(F.md5(F.concat_ws(":", "role", "turn", "text").cast("binary")), F.lit(16)))
    links = stored(
        spoken.where("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "digest")
        .agg(F.first("turn").alias("turn"), F.first("role").alias("role"))
        .withColumn("asked", F.max(F.when(F.col("role") == "user", F.col("turn"))).over(before))
        .withColumn("used", F.max(F.when(F.col("role") == "assistant", F.col("asked"))).over(upto)), "chat-links")
    linked_to = lambda role, column: spoken.where(F.col("role") == role).join(
        links.where(F.col("role") == role).select("conv_id", "digest", column), ["conv_id", "digest"], "left")
    calls = linked_to("user", "used").select(
        "conv_id", "turn", name("turn").alias("call_id"), F.lit("answer").alias("name"),
        F.to_json(F.struct(F.col("text").alias("question"), words.alias("words"))).alias("arguments"),
        F.array_compact(F.array(name("used"))).alias("uses"), "digest")
    results = linked_to("assistant", "asked").select(
        "conv_id", "turn", name("asked").alias("call_id"), F.col("text").alias("content"), "digest")
    others = turns.where("role IS NULL OR role NOT IN ('user', 'assistant')")
    return calls, results, others
