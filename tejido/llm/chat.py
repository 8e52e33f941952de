"""Chat formatting (operator 10): tool calls and results are linked, ordered, validated and serialised.

Calls and results meet by identifier in a hash join. A call may depend on an earlier one; its depth among the calls that it
hangs on is found by pointer doubling, joins whose number is the logarithm of the longest chain, so no conversation
is gathered in one task. Arguments are checked against the tool's schema and written as canonical JSON: keys sorted, no white space,
numbers in their shortest form.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ._shared import cut, drop_cut, fresh

#: Bound on the schemas' JSON, which goes to every task.
MOST_SCHEMA_BYTES = 1 << 20


def canonical(value: object) -> str:
    """Canonical JSON: object keys in code-point order of UTF-16, no white space, only needed escapes, integral numbers
    below 1e21 without a fraction."""
    if value is None or isinstance(value, bool):
        return {None: "null", True: "true", False: "false"}[value]
    if isinstance(value, str):
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("JSON has no such number")
        if value == int(value) and abs(value) < 1e21:
            return str(int(value))
        text = repr(value)
        mantissa, _, exponent = text.partition("e")
        if not exponent:
            return text
        power = int(exponent)
        if -7 < power < 0:
            return format(Decimal(text), "f")
        return f"{mantissa}e{'+' if power > 0 else '-'}{abs(power)}"
    if isinstance(value, list):
        return f"[{','.join(map(canonical, value))}]"
    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in keys) + "}"
    raise TypeError(type(value).__name__)


_KINDS = {
    "object": lambda v: isinstance(v, dict), "array": lambda v: isinstance(v, list), "string": lambda v: isinstance(v, str), "null": lambda v: v is None,
    "boolean": lambda v: isinstance(v, bool), "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
}


def faults(value: object, schema: dict, at: str = "$") -> Iterator[str]:
    """What a value has against a JSON schema (type, enum, const, required, properties, additionalProperties, items, bounds, pattern)."""
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if not any(_KINDS[k](value) for k in kinds):
            yield f"{at}: not of type {' or '.join(kinds)}"
            return
    if "enum" in schema and canonical(value) not in {canonical(v) for v in schema["enum"]}:
        yield f"{at}: not one of the values"
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        yield f"{at}: not the value"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for k in schema.get("required", []):
            if k not in value:
                yield f"{at}: {k} is missing"
        for k in sorted(value):
            if k in known:
                yield from faults(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                yield f"{at}: {k} is unknown"
            elif isinstance(schema.get("additionalProperties"), dict):
                yield from faults(value[k], schema["additionalProperties"], f"{at}.{k}")
    elif isinstance(value, list):
        if len(value) < schema.get("minItems", 0) or len(value) > schema.get("maxItems", len(value)):
            yield f"{at}: {len(value)} items"
        for i, v in enumerate(value):
            yield from faults(v, schema.get("items", {}), f"{at}[{i}]")
    elif isinstance(value, str):
        if len(value) < schema.get("minLength", 0) or len(value) > schema.get("maxLength", len(value)):
            yield f"{at}: {len(value)} characters"
        if "pattern" in schema and not re.search(schema["pattern"], value):
            yield f"{at}: doesn't match"
    elif _KINDS["number"](value):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            yield f"{at}: out of bounds"


def check_arguments(calls: DataFrame, schemas: dict[str, dict], tool: str = "tool", arguments: str = "arguments") -> DataFrame:
    """calls with arguments_json (canonical; null if they are no JSON), and faults: what they have against the tool's schema.

    A null tool or one without a schema, and arguments that are null or no JSON, are faults. Columns called as the new ones are replaced.
    """
    if len(json.dumps(schemas)) > MOST_SCHEMA_BYTES:
        raise ValueError("schemas of over 1 MB")
    kept = calls.drop("arguments_json", "faults")
    schema = T.StructType([*kept.schema.fields, T.StructField("arguments_json", T.StringType()), T.StructField("faults", T.ArrayType(T.StringType(), False), False)])

    def one(name: str | None, text: str | None) -> tuple[str | None, list[str]]:
        try:
            value = json.loads(text) if text is not None else None
            made = canonical(value) if text is not None else None
        except (ValueError, RecursionError):
            return None, ["$: no JSON"]
        if text is None:
            return None, ["$: no arguments"]
        if name not in schemas:
            return made, ["$: no such tool"]
        return made, list(faults(value, schemas[name]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [one(n, a) for n, a in zip(batch.column(tool).to_pylist(), batch.column(arguments).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([m for m, _ in made], pa.string()), pa.array([f for _, f in made], pa.list_(pa.string()))], [*batch.schema.names, "arguments_json", "faults"])

    return kept.mapInArrow(run, schema)


def depths(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, depth of calls (conv_id, call_id, parent): calls above it; null within or below a cycle.

    A parent that is null or not among the conversation's calls leaves a call at depth 0. call_id is unique in a conversation.
    """
    nodes = calls.select("conv_id", "call_id", "parent")
    known = nodes.select("conv_id", F.col("call_id").alias("parent"), F.lit(1).alias("known")).hint("shuffle_hash")
    now = cut(nodes.join(known, ["conv_id", "parent"], "left").select("conv_id", "call_id", F.when(F.col("known").isNotNull(), F.col("parent")).alias("up"), F.col("known").isNotNull().cast("long").alias("depth")), "depths")
    steps = max(1, int(now.count())).bit_length() + 1
    for _ in range(steps):
        if now.filter("up is not null").isEmpty():
            break
        above = now.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2")).hint("shuffle_hash")
        after = cut(now.join(above, ["conv_id", "up"], "left").select("conv_id", "call_id", F.col("up2").alias("up"), (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth")), "depths")
        drop_cut(now)
        now = after
    return now.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


CALL = ["conv_id", "call_id", "parent", "turn", "tool", "arguments"]


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row a different call: conv_id, call_id, tool, turn, role (if calls have one), depth, status, faults, arguments_json, result_turn, n_results, n_copies, record (canonical JSON).

    calls: conv_id, call_id, parent, turn, tool, arguments (JSON), and copies, if there is such a column; equal calls are one, whose n_copies tells how
    many they are. results: conv_id, call_id, turn, content. The first
    result after the call's turn answers it (before any other with the same turn, the least content); status is `answered`, `early` if results come only before
    it, `open` without one, `cycle` for calls that hang on themselves, `invalid` if the arguments have faults. Of different calls
    with one conv_id and call_id, the one with the least turn (then arguments, tool, parent) is linked, the others are `repeated`; calls with a null
    conv_id or call_id are `rejected`. Neither has a depth or a result, but both are checked and written. Results without a call give no row.
    Call order in a conversation: depth, turn, call_id; those without a depth last.
    """
    copies = F.sum(F.col("copies") if "copies" in calls.columns else F.lit(1)).cast("long").alias("n_copies")
    role = ["role"] if "role" in calls.columns else []
    different = cut(calls.groupBy(*CALL, *role).agg(copies), "calls")
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    rank = F.struct("turn", "arguments", "tool", "parent", *role)
    leads = different.filter(named).groupBy("conv_id", "call_id").agg(F.count("*").alias("n"), F.min(rank).alias("lead")).filter("n > 1").drop("n").hint("shuffle_hash")
    marked = different.join(leads, ["conv_id", "call_id"], "left").withColumn("kept", F.when(~named, "rejected").when(F.col("lead").isNotNull() & ~rank.eqNullSafe(F.col("lead")), "repeated")).drop("lead")
    whole = cut(check_arguments(marked, schemas), "calls")
    drop_cut(different)
    checked = whole.filter("kept is null").drop("kept")
    # a hash table of calls, whose keys are unique, meets the results as they come
    turns = checked.select("conv_id", "call_id", F.col("turn").alias("call_turn")).hint("shuffle_hash")
    met = results.select("conv_id", "call_id", F.col("turn").alias("result_turn"), "content").join(turns, ["conv_id", "call_id"])
    late = F.coalesce(F.col("result_turn") > F.col("call_turn"), F.lit(False))
    answers = met.groupBy("conv_id", "call_id").agg(F.min(F.when(late, F.struct("result_turn", "content"))).alias("answer"), F.count("*").alias("n_results"))
    joined = checked.join(answers.hint("shuffle_hash"), ["conv_id", "call_id"], "left").join(depths(checked).hint("shuffle_hash"), ["conv_id", "call_id"])
    status = F.when(F.col("depth").isNull(), "cycle").when(F.size("faults") > 0, "invalid").when(F.col("answer").isNotNull(), "answered").when(F.col("n_results").isNotNull(), "early").otherwise("open")
    own = ["conv_id", "call_id", "parent", "tool", "turn", *role]
    linked = joined.select(*own, "depth", status.alias("status"), "faults", "arguments_json", F.col("answer.result_turn").alias("result_turn"), F.col("answer.content").alias("content"), F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), "n_copies")
    other = whole.filter("kept is not null").select(*own, F.lit(None).cast("long").alias("depth"), F.col("kept").alias("status"), "faults", "arguments_json", F.lit(None).cast("long").alias("result_turn"), F.lit(None).cast("string").alias("content"), F.lit(0).cast("long").alias("n_results"), "n_copies")
    return serialised(linked.unionByName(other))


def serialised(linked: DataFrame) -> DataFrame:
    """linked with record: the call and its result as one canonical JSON object; parent and content then go."""
    kept = linked.drop("parent", "content")
    schema = T.StructType([*kept.schema.fields, T.StructField("record", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for r in batch.select(["call_id", "parent", "tool", "arguments_json", "status", "content"]).to_pylist():
                value = {"arguments": None, "id": r["call_id"], "name": r["tool"], "result": r["content"], "status": r["status"]}
                if r["parent"] is not None:
                    value["after"] = r["parent"]
                head = canonical({k: v for k, v in value.items() if k != "arguments"})
                arguments = r["arguments_json"] if r["arguments_json"] is not None else "null"
                after, _, rest = head.partition('"id":')
                made.append(f'{after}"arguments":{arguments},"id":{rest}')
            names = [c for c in batch.schema.names if c not in ("parent", "content")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(made, pa.string())], [*names, "record"])

    return linked.mapInArrow(run, schema)


#: The tool that a user's turn is taken to call, when a plain conversation is read as calls and results.
SCHEMAS = {
    "reply": {
        "type": "object", "required": ["prompt", "turn"], "additionalProperties": False,
        "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
    }
}


#: How calls stand in the text of an assistant's turn, and a result in that of a tool's. Arguments are JSON, as an object or as a string.
CALLS = "tool_calls array<struct<id: string, name: string, arguments: string, after: string>>, content string"
RESULT = "tool_call_id string, content string"
#: What the ids of calls begin with that are made of users' turns; underscores come before it where a conversation's own ids begin so.
MADE = "call_"


def name(turn: Column) -> Column:
    return F.concat("prefix", turn.cast("string"))


def read_messages(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies, last, made, beside, told of every different row with a conv_id and turn: how often it comes, the turn
    of the user's before it, the calls that an assistant's text holds (as CALLS has them), the content beside those, and what a tool's text tells
    (RESULT); null without such. Only texts that are JSON as a whole hold calls or results, whatever white space is around."""
    messages = conversations.filter("conv_id is not null and turn is not null").groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    marks = conversations.filter("conv_id is not null and turn is not null and role = 'user'").select("conv_id", "turn").distinct()
    json_ = F.btrim("text", F.lit(" \t\r\n")).startswith("{")
    # parsers stop at the end of a value: within brackets of either kind, what stands behind it is an error
    alone = (F.json_array_length(F.concat(F.lit("["), "text", F.lit("]"))) == 1) & F.try_parse_json(F.concat(F.lit('{"a":'), "text", F.lit("}"))).isNotNull()
    whole = F.when(F.col("role").isin("assistant", "tool") & json_, F.when(alone, F.col("text")))
    made, told = F.from_json("json", CALLS), F.from_json("json", RESULT)
    read = previous(messages, marks).withColumn("json", whole).withColumn("made", F.when(F.col("role") == "assistant", made)).withColumn("told", F.when(F.col("role") == "tool", told)).drop("json")
    held = F.size("made.tool_calls") > 0
    return read.withColumn("beside", F.when(held, F.col("made.content"))).withColumn("made", F.when(held, F.col("made.tool_calls"))).withColumn("told", F.when(F.col("told.tool_call_id").isNotNull(), F.col("told")))


def with_prefix(messages: DataFrame) -> DataFrame:
    """messages with prefix: what ids of made calls begin with, and no id that the conversation's texts name. MADE, where they name none that begins so."""
    ids = F.concat(F.coalesce(F.flatten(F.transform("made", lambda c: F.array(c["id"], c["after"]))), F.array().cast("array<string>")), F.array("told.tool_call_id"))
    named = messages.filter("made is not null or told is not null").select("conv_id", F.explode(ids).alias("id"))
    marks = named.select("conv_id", F.length(F.regexp_extract("id", f"^(_*){MADE}", 1)).alias("n"), F.col("id").rlike(f"^_*{MADE}").alias("clash")).filter("clash").groupBy("conv_id").agg(F.max("n").alias("n"))
    if marks.isEmpty():
        return messages.withColumn("prefix", F.lit(MADE))
    return messages.join(marks, "conv_id", "left").withColumn("prefix", F.when(F.col("n").isNull(), MADE).otherwise(F.concat(F.repeat(F.lit("_"), F.col("n") + 1), F.lit(MADE)))).drop("n")


def calls_of(messages: DataFrame) -> DataFrame:
    """Calls in messages: those that assistants' texts hold, and, for each user's turn, a call of `reply` with its text, after the user's turn
    before it. Of several users' texts in a turn, the least is the call."""
    arguments = F.to_json(F.struct(F.col("turn").alias("turn"), F.col("text").alias("prompt")), {"ignoreNullFields": "false"})
    asked = messages.filter("role = 'user'").groupBy("conv_id", "turn").agg(F.min(F.struct("text", "copies")).alias("least"), F.min("last").alias("last"), F.min("prefix").alias("prefix")).select("conv_id", "turn", "least.*", "last", "prefix")
    replies = asked.select("conv_id", name(F.col("turn")).alias("call_id"), name(F.col("last")).alias("parent"), "turn", F.lit("reply").alias("tool"), arguments.alias("arguments"), "copies", F.lit("user").alias("role"))
    held = messages.filter("made is not null").select("conv_id", "turn", F.explode("made").alias("call"), "copies")
    return replies.unionByName(held.select("conv_id", F.col("call.id").alias("call_id"), F.col("call.after").alias("parent"), "turn", F.col("call.name").alias("tool"), F.col("call.arguments").alias("arguments"), "copies", F.lit("assistant").alias("role")))


def results_of(messages: DataFrame) -> DataFrame:
    """Results in messages: a tool's turns that name a call, and an assistant's without calls, which answer the user's turn before them."""
    own = F.when(F.col("told").isNotNull(), F.col("told.tool_call_id")).when((F.col("role") == "assistant") & F.col("made").isNull(), name(F.col("last")))
    content = F.when(F.col("told").isNotNull(), F.col("told.content")).otherwise(F.col("text"))
    return messages.select("conv_id", own.alias("call_id"), "turn", "role", content.alias("content"), "copies").filter("call_id is not null")


#: Turns of a conversation that are looked at together.
STRIDE = 256


def previous(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """rows (conv_id, turn, ...) with last: the greatest marked turn of the conversation below the row's own.

    Turns are taken in strides, so that a long conversation is shared out: the last mark of earlier strides comes from a window over
    one row a stride, those within the stride from a window over its turns.
    """
    stride = F.floor(F.col("turn") / STRIDE)
    tops = marks.groupBy("conv_id", stride.alias("stride")).agg(F.max("turn").alias("top"))
    here = rows.select("conv_id", stride.alias("stride")).distinct()
    known = here.join(tops, ["conv_id", "stride"], "full")
    carried = known.withColumn("carried", F.max("top").over(Window.partitionBy("conv_id").orderBy("stride").rowsBetween(Window.unboundedPreceding, -1))).select("conv_id", "stride", "carried")
    mark = fresh("mark", rows.columns)
    both = rows.withColumn("stride", stride).withColumn(mark, F.lit(None).cast("long")).unionByName(marks.select("conv_id", "turn", stride.alias("stride"), F.col("turn").alias(mark)), allowMissingColumns=True).withColumn("own", F.col(mark).isNull())
    order = Window.partitionBy("conv_id", "stride").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    within = both.withColumn("near", F.max(mark).over(order)).filter("own").drop("own", mark)
    return within.join(carried, ["conv_id", "stride"], "left").withColumn("last", F.coalesce("near", "carried")).select(*rows.columns, "last")


def formatted(conversations: DataFrame, schemas: dict[str, dict] = SCHEMAS) -> DataFrame:
    """conv_id, turn, role, kind, call_id, tool, depth, status, n_faults, arguments_json, result_turn, n_results, n_copies, record: a row for
    every call, and for every message that is none. No row is left out: equal rows are one, whose n_copies tells how many they are, so that the copies of
    all rows add up to the messages without calls, the calls, and the contents beside calls.

    kind `call`: see link_calls(). kind `result`: a turn that answers a call; status `linked`, or `unlinked` if the conversation has no such call.
    kind `message`: all other turns, with their text; status `repeated` for further texts of a user's turn, `rejected` without a
    conv_id or turn, `unlinked` for assistants' turns before any user's, `beside` for what a text with calls says besides, else `kept`. Texts of any
    length, null and empty ones too, are written whole. Ids of calls that are made of users' turns clash with none of the conversation's.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    read = cut(read_messages(rows), "messages")
    messages = with_prefix(read)
    results = results_of(messages)
    calls = calls_of(messages)
    linked = link_calls(calls, results, schemas)
    done = linked.withColumn("kind", F.lit("call")).withColumn("n_faults", F.size("faults").cast("long"))
    keys = calls.select("conv_id", "call_id").distinct().withColumn("known", F.lit(True)).hint("shuffle_hash")
    answers = results.join(keys, ["conv_id", "call_id"], "left").select("conv_id", "turn", "role", F.lit("result").alias("kind"), "call_id", F.when(F.col("known"), "linked").otherwise("unlinked").alias("status"), F.col("copies").alias("n_copies"), "content")
    least = read.filter("role = 'user'").groupBy("conv_id", "turn").agg(F.min(F.struct("text")).alias("least"), F.count("*").alias("n")).filter("n > 1").hint("shuffle_hash")
    again = read.filter("role = 'user'").join(least, ["conv_id", "turn"]).filter(~F.col("text").eqNullSafe(F.col("least.text"))).withColumn("status", F.lit("repeated"))
    other = read.filter("role is null or role not in ('user', 'assistant', 'tool') or (role = 'tool' and told is null) or (role = 'assistant' and made is null and last is null)")
    other = other.withColumn("status", F.when(F.col("role") == "assistant", "unlinked").otherwise("kept"))
    said = read.filter("beside is not null").withColumn("text", F.col("beside")).withColumn("status", F.lit("beside"))
    gone = rows.filter("conv_id is null or turn is null").groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).withColumn("status", F.lit("rejected"))
    plain = [x.select("conv_id", "turn", "role", F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"), "status", F.col("copies").alias("n_copies"), F.col("text").alias("content")) for x in (again, other, said, gone)]
    told = answers
    for x in plain:
        told = told.unionByName(x)
    names = ["conv_id", "turn", "role", "kind", "call_id", "tool", "depth", "status", "n_faults", "arguments_json", "result_turn", "n_results", "n_copies", "record"]
    return done.select(names).unionByName(message_records(told), allowMissingColumns=True).select(names)


def message_records(messages: DataFrame) -> DataFrame:
    """messages with record: call, content, role and turn as one canonical JSON object, call only where there is one; content then goes."""
    kept = messages.drop("content")
    schema = T.StructType([*kept.schema.fields, T.StructField("record", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for call, content, role, turn in zip(*(batch.column(c).to_pylist() for c in ("call_id", "content", "role", "turn")), strict=True):
                made.append(canonical({"content": content, "role": role, "turn": turn} | ({"call": call} if call is not None else {})))
            names = [c for c in batch.schema.names if c != "content"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(made, pa.string())], [*names, "record"])

    return messages.mapInArrow(run, schema)
