"""Chat formatting: tool calls linked to results, put in topological order, checked against schemas, as canonical JSON.

DataFrame expressions only. Calls and results meet in shuffled hash joins on (conversation, identifier), whose build sides
have one row per identifier, so no group is multiplied. Dependencies are settled within a conversation, in one expression
over its calls, whatever their chains are; only conversations of more than CALLS_AT_ONCE calls, which could be too large for
one row, are settled in rounds of joins, one per link of the longest chain among them. Canonical JSON has sorted keys, no
blanks, and escapes only what JSON must.

Defined results. Of several calls with one identifier in a conversation the first (by turn, then name, arguments and
dependencies) is the call, others have status `duplicate`; of several results the first is linked, others are `duplicate`.
A result without call is `orphan`, a call without result `unanswered`; a call whose dependencies lead back to it or to a
missing call is `blocked` and stands at its own turn. A null conv_id or identifier links with nothing. Arguments that aren't
a JSON object, and names without schema, are errors. Exactly repeated rows count as one. Extra columns are ignored.

Order: an event stands at its turn, or right behind what it needs if that stands later: sort by (conv_id, order_turn,
order_depth, turn, kind, call_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import forget, materialise

CALL = ["conv_id", "turn", "call_id", "name", "arguments", "depends_on"]
RESULT = ["conv_id", "turn", "call_id", "content"]
MESSAGE = ["conv_id", "turn", "role", "content"]
CALLS_AT_ONCE = 256  # of a conversation that are put in order in one expression


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _property(arguments: Column, name: str, rule: dict, required: bool) -> list[Column]:
    path = "$[" + _quoted(name) + "]"
    value = F.try_variant_get(arguments, path, "variant")
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(arguments, path, "string")
    number = F.try_variant_get(arguments, path, "double")
    say = lambda bad, what: F.when(bad, F.lit(f"{name}: {what}"))
    fits = {
        "string": kind == "STRING",
        "integer": (kind == "BIGINT") | (kind.rlike(r"^DECIMAL\(\d+,0\)$")),
        "number": kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"),
        "boolean": kind == "BOOLEAN",
        "null": kind == "VOID",
        "array": F.startswith(kind, F.lit("ARRAY")),
        "object": F.startswith(kind, F.lit("OBJECT")),
    }
    out = [say(value.isNull(), "missing")] if required else []
    if "type" in rule:
        out.append(say(value.isNotNull() & ~fits[rule["type"]], f"not {rule['type']}"))
    if "minLength" in rule:
        out.append(say((kind == "STRING") & (F.length(text) < rule["minLength"]), "too short"))
    if "maxLength" in rule:
        out.append(say((kind == "STRING") & (F.length(text) > rule["maxLength"]), "too long"))
    if "minimum" in rule:
        out.append(say(fits["number"] & (number < rule["minimum"]), "too small"))
    if "maximum" in rule:
        out.append(say(fits["number"] & (number > rule["maximum"]), "too large"))
    if "enum" in rule:
        out.append(say((kind == "STRING") & ~text.isin(*rule["enum"]), "not allowed"))
    return out


def argument_errors(name: Column, arguments: Column, schemas: dict[str, dict]) -> Column:
    """What is wrong with a call's JSON arguments, in schema order; an empty array if nothing.

    schemas: by tool name, a JSON schema of one level (properties with type, minLength, maxLength, minimum, maximum and
    enum; required; additionalProperties).
    """
    parsed = F.try_parse_json(arguments)
    is_object = F.coalesce(F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")), F.lit(False))
    none = F.array().cast("array<string>")
    found: Column | None = None
    for tool, schema in schemas.items():
        required = schema.get("required", [])
        properties = {k: {} for k in required} | schema.get("properties", {})
        checks = [c for k, rule in properties.items() for c in _property(parsed, k, rule, k in required)]
        if not schema.get("additionalProperties", True):
            keys = F.map_keys(parsed.try_cast("map<string,variant>"))
            more = F.array_except(keys, F.array(*map(F.lit, properties)).cast("array<string>"))
            checks.append(F.when(F.size(more) > 0, F.concat(F.array_join(F.array_sort(more), ","), F.lit(": not allowed"))))
        errors = F.array_compact(F.array(*checks)) if checks else none
        found = F.when(name == tool, errors) if found is None else found.when(name == tool, errors)
    unknown = F.array(F.lit("unknown tool"))
    by_name = unknown if found is None else found.otherwise(unknown)
    return F.when(~is_object, F.array(F.lit("arguments: not an object"))).otherwise(by_name)


def from_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and plain messages of `messages` (conv_id, turn, role, text).

    An assistant's text {"tool_calls": [{"id", "name", "arguments", "depends_on"}]} is that many calls; a tool's text
    {"tool_call_id", "content"} is a result; everything else is a message.
    """
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").withColumn("v", F.try_parse_json("text"))
    items = F.try_variant_get("v", "$.tool_calls", "array<variant>")
    is_call = (F.col("role") == "assistant") & items.isNotNull()
    is_result = (F.col("role") == "tool") & F.try_variant_get("v", "$.tool_call_id", "string").isNotNull()
    call = lambda path, kind: F.try_variant_get("c", path, kind)
    calls = rows.where(is_call).select("conv_id", "turn", F.explode(items).alias("c")).select(
        "conv_id", "turn", call("$.id", "string").alias("call_id"), call("$.name", "string").alias("name"), F.to_json(call("$.arguments", "variant")).alias("arguments"), call("$.depends_on", "array<string>").alias("depends_on")
    )
    results = rows.where(is_result).select("conv_id", "turn", F.try_variant_get("v", "$.tool_call_id", "string").alias("call_id"), F.try_variant_get("v", "$.content", "string").alias("content"))
    plain = rows.where(~F.coalesce(is_call | is_result, F.lit(False))).select("conv_id", "turn", "role", F.col("text").alias("content"))
    return calls, results, plain


def from_turns(messages: DataFrame, tool: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same for plain dialogue, which has no tool calls: each user turn calls `tool`, and assistant turns are results.

    Identifiers and dependencies follow the conversation's number modulo 5, so that every case occurs:
    0: each call needs the one of the next user turn, if there is one (the order is reversed);
    1: each call needs the one of the user turn before, and the first one needs a call that doesn't exist;
    2: as 1, but the first needs the last one (a cycle);
    3: as 4, but two user turns share an identifier, and so do their answers;
    4: each call needs the one before, if there is one; an answer belongs to the next user turn, in all others to the last.
    """
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    users = rows.where("role = 'user' and conv_id is not null").groupBy("conv_id").agg(F.min("turn").alias("first"), F.max("turn").alias("last"))
    case = F.pmod("conv_id", F.lit(5))
    name = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.when(case == 3, F.floor(turn / 4)).otherwise(turn).cast("string"))
    turn, none = F.col("turn"), F.array().cast("array<string>")
    before = F.array(name(turn - 2))
    needs = (
        F.when(case == 0, F.when(turn < F.col("last"), F.array(name(turn + 2))).otherwise(none))
        .when((case == 2) & (turn == F.col("first")), F.array(name(F.col("last"))))
        .when((case == 1) | (turn > F.col("first")), F.when(case == 3, F.array_remove(before, name(turn))).otherwise(before))
        .otherwise(none)
    )
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    calls = rows.where("role = 'user'").join(users, "conv_id", "left").select(
        "conv_id", "turn", name(turn).alias("call_id"), F.lit(tool).alias("name"), F.to_json(F.struct(lines.alias("lines"), "text", "turn")).alias("arguments"), needs.alias("depends_on")
    )
    results = rows.where("role = 'assistant'").select("conv_id", "turn", name(F.when(case == 4, turn + 1).otherwise(turn - 1)).alias("call_id"), F.col("text").alias("content"))
    plain = rows.where("coalesce(role, '') not in ('user', 'assistant')").select("conv_id", "turn", "role", F.col("text").alias("content"))
    return calls, results, plain


def _later(a: Column, b: Column) -> Column:
    """Position of something at b that needs what stands at a: b, or right behind a."""
    return F.when((a["turn"] > b["turn"]) | ((a["turn"] == b["turn"]) & (a["depth"] >= b["depth"])), F.struct(a["turn"].alias("turn"), (a["depth"] + 1).alias("depth"))).otherwise(b)


def _firsts(events: DataFrame, *ties: str) -> DataFrame:
    """One row per identifier, by turn and then by the given columns."""
    best = F.min(F.struct("turn", *ties)).alias("b")
    return events.where("conv_id is not null and call_id is not null and turn is not null").groupBy("conv_id", "call_id").agg(best).select("conv_id", "call_id", "b.*")


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """A row per call and result: conv_id, turn, kind, call_id, partner_turn, status, errors, order_turn, order_depth, json."""
    key = ["conv_id", "call_id"]
    calls = calls.select(*CALL).withColumn("depends_on", F.coalesce("depends_on", F.array().cast("array<string>"))).distinct()
    calls = calls.withColumn("sig", F.sha2(F.to_json(F.struct("name", "arguments", "depends_on")), 256))
    results = results.select(*RESULT).distinct().withColumn("sig", F.sha2(F.to_json(F.struct("content")), 256))
    first_call = _firsts(calls, "name", "arguments", "depends_on", "sig").select(*key, F.col("turn").alias("call_turn"), F.col("sig").alias("call_sig"), F.array_distinct("depends_on").alias("depends_on"))
    answers = _firsts(results, "content", "sig").select(*key, F.col("turn").alias("result_turn"), F.col("sig").alias("result_sig"))
    # One narrow row per identifier: the call, its result if there is one, and where it stands.
    nodes = materialise(first_call.join(answers.hint("shuffle_hash"), key, "left"), "chat-calls")
    linked = materialise(_settled(nodes), "chat-linked")
    forget(nodes)

    own = F.struct(F.col("turn").alias("turn"), F.lit(0).cast("long").alias("depth"))
    joined = calls.join(linked.hint("shuffle_hash"), key, "left")
    is_first = F.coalesce((F.col("turn") == F.col("call_turn")) & (F.col("sig") == F.col("call_sig")), F.lit(False))
    errors = argument_errors(F.col("name"), F.col("arguments"), schemas)
    status = (
        F.when(F.col("call_turn").isNotNull() & ~is_first, "duplicate").when(F.size("errors") > 0, "invalid").when(F.coalesce(F.col("blocked"), F.lit(False)), "blocked").when(F.col("result_turn").isNull(), "unanswered").otherwise("linked")
    )
    parsed = F.try_parse_json("arguments")
    call_json = F.to_json(F.struct(F.coalesce(parsed, F.try_parse_json(F.to_json(F.struct(F.col("arguments").alias("raw"))))).alias("arguments"), F.col("call_id").alias("id"), "name", F.lit("tool_call").alias("type")))
    spot = F.coalesce(F.when(is_first, F.col("place")), own)
    out_calls = joined.withColumn("errors", errors).select(
        "conv_id", "turn", F.lit("call").alias("kind"), "call_id", F.when(is_first, F.col("result_turn")).alias("partner_turn"), status.alias("status"), "errors", spot["turn"].alias("order_turn"), spot["depth"].alias("order_depth"), call_json.alias("json")
    )

    met = results.join(linked.hint("shuffle_hash"), key, "left")
    leads = F.coalesce((F.col("turn") == F.col("result_turn")) & (F.col("sig") == F.col("result_sig")), F.lit(False))
    has_call = F.col("call_turn").isNotNull()
    state = F.when(~has_call, "orphan").when(~leads, "duplicate").otherwise("linked")
    where = F.when(has_call, _later(F.col("place"), own)).otherwise(own)
    result_json = F.to_json(F.struct("content", F.col("call_id").alias("id"), F.lit("tool_result").alias("type")))
    out_results = met.select(
        "conv_id", "turn", F.lit("result").alias("kind"), "call_id", F.when(leads, F.col("call_turn")).alias("partner_turn"), state.alias("status"), F.array().cast("array<string>").alias("errors"),
        where["turn"].alias("order_turn"), where["depth"].alias("order_depth"), result_json.alias("json"),
    )
    return out_calls.unionByName(out_results)


PLACE = "struct<turn:bigint,depth:bigint>"


def _end(place: Column, result_turn: Column) -> Column:
    """Where what a call needs is there: at its result, or at the call itself if it has none."""
    return F.when(result_turn.isNull(), place).otherwise(_later(place, F.struct(result_turn.alias("turn"), F.lit(0).cast("long").alias("depth"))))


def _settled(nodes: DataFrame) -> DataFrame:
    """The calls with place and blocked: where each stands once what it depends on has its place."""
    own = F.struct(F.col("call_turn").alias("turn"), F.lit(0).cast("long").alias("depth"))
    sizes = nodes.groupBy("conv_id").agg(F.count("*").alias("calls"), F.bool_or(F.size("depends_on") > 0).alias("ordered"))
    sized = nodes.join(sizes.hint("shuffle_hash"), "conv_id")
    free = sized.where("not ordered").select(*nodes.columns, own.alias("place"), F.lit(False).alias("blocked"))
    small = _in_one_row(sized.where(F.col("ordered") & (F.col("calls") <= CALLS_AT_ONCE)).select(*nodes.columns))
    large = sized.where(F.col("ordered") & (F.col("calls") > CALLS_AT_ONCE)).select(*nodes.columns)
    out = free.unionByName(small)
    return out if large.isEmpty() else out.unionByName(_in_rounds(large))


def _in_one_row(nodes: DataFrame) -> DataFrame:
    """Conversations of few calls: as many sweeps over the array of calls as there are calls settle every chain."""
    fields = [c for c in nodes.columns if c != "conv_id"]
    rows = nodes.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("call_turn", "call_id", *[c for c in fields if c not in ("call_turn", "call_id")]))).alias("calls"))
    # Dependencies as places in the array; 0 is a call that doesn't exist.
    ids = F.transform("calls", lambda c: c["call_id"])
    rows = rows.withColumn("needs", F.transform("calls", lambda c: F.transform(c["depends_on"], lambda d: F.array_position(ids, d).cast("int"))))
    at = lambda c: F.struct(c["call_turn"].alias("turn"), F.lit(0).cast("long").alias("depth"))
    start = F.transform("calls", lambda c: F.when(F.size(c["depends_on"]) == 0, at(c))).cast(f"array<{PLACE}>")

    def placed(acc: Column, c: Column, i: Column) -> Column:
        needs = F.get("needs", i)
        ready = F.forall(needs, lambda k: (k > 0) & F.get(acc, k - 1).isNotNull())
        last = F.array_max(F.transform(needs, lambda k: _end(F.get(acc, k - 1), F.get("calls", k - 1)["result_turn"]).cast(PLACE)))
        return F.coalesce(F.get(acc, i), F.when(ready, _later(last, at(c))))

    sweep = lambda acc, _: F.transform("calls", lambda c, i: placed(acc, c, i)).cast(f"array<{PLACE}>")
    rows = rows.withColumn("places", F.aggregate(F.sequence(F.lit(1), F.size("calls")), start, sweep))
    each = rows.select("conv_id", F.explode(F.arrays_zip(F.col("calls").alias("c"), F.col("places").alias("p"))).alias("x"))
    own = F.struct(F.col("x.c.call_turn").alias("turn"), F.lit(0).cast("long").alias("depth")).cast(PLACE)
    return each.select("conv_id", *[F.col(f"x.c.{f}").alias(f) for f in fields], F.coalesce("x.p", own).alias("place"), F.col("x.p").isNull().alias("blocked")).select(*nodes.columns, "place", "blocked")


def _in_rounds(nodes: DataFrame) -> DataFrame:
    """Conversations of many calls: a round of joins per link of the longest chain."""
    key = ["conv_id", "call_id"]
    own = F.struct(F.col("call_turn").alias("turn"), F.lit(0).cast("long").alias("depth"))
    done = materialise(nodes.where("size(depends_on) = 0").select(*key, "result_turn", own.alias("place")), "chat-done")
    waiting = materialise(nodes.where("size(depends_on) > 0").select(*key, "call_turn", "depends_on", "result_turn"), "chat-waiting")
    fresh = done
    while not fresh.isEmpty():
        ends = done.select("conv_id", F.col("call_id").alias("need"), _end(F.col("place"), F.col("result_turn")).alias("end"))
        needs = waiting.select(*key, F.size("depends_on").alias("n"), F.explode("depends_on").alias("need")).join(ends, ["conv_id", "need"])
        ready = needs.groupBy(*key, "n").agg(F.count("*").alias("met"), F.max("end").alias("end")).where("met = n")
        fresh = materialise(waiting.join(ready.drop("n"), key).select(*key, "result_turn", _later(F.col("end"), own).alias("place")), "chat-fresh")
        left = materialise(waiting.join(fresh, key, "left_anti"), "chat-waiting")
        both = materialise(done.unionByName(fresh), "chat-done")
        forget(waiting, done)
        done, waiting = both, left
    places = done.select(*key, F.col("place").alias("found"))
    joined = nodes.join(places, key, "left")
    return joined.select(*nodes.columns, F.coalesce("found", own).alias("place"), F.col("found").isNull().alias("blocked"))


def formatted(calls: DataFrame, results: DataFrame, messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Everything of all conversations: `link`'s rows and a row per plain message (kind message, status plain)."""
    plain = messages.select(*MESSAGE).distinct()
    text = F.to_json(F.struct("content", "role", F.lit("message").alias("type")))
    none = F.lit(None)
    rows = plain.select(
        "conv_id", "turn", F.lit("message").alias("kind"), none.cast("string").alias("call_id"), none.cast("long").alias("partner_turn"), F.lit("plain").alias("status"), F.array().cast("array<string>").alias("errors"),
        F.col("turn").alias("order_turn"), F.lit(0).cast("long").alias("order_depth"), text.alias("json"),
    )
    return link(calls, results, schemas).unionByName(rows)
