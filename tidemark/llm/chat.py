"""Chat formatting: tool-call linking; DataFrame functions only.

Calls and results are hash-joined by (conversation, call identifier). The order is topological: a result
stands right behind its call, and a call whose arguments hold the identifier of another call of its
conversation stands behind that call and its result. Calls keep their turn unless that breaks this order;
then they move behind what they depend on (``at_turn``, ``step``). Arguments are validated against the
tool's schema (required names, JSON types, lengths, no other names) and every row is serialised as
canonical JSON: sorted keys, no blanks.

Every call, result and other message is in a result row: ``linked``, ``moved`` (a result logged before its
call), ``no_result``, ``repeated_call``, ``no_call``, ``repeated_result``, ``message``. A call on a cycle, or
one that would have to move behind it, stays at its turn and says ``depends on itself`` among its errors.

Scale: joins and aggregates are all on (conversation, identifier), so a conversation with a third of all
rows is spread over its identifiers; no conversation is ever gathered. Equal rows are counted before they
are shuffled, a hot identifier is one row of the side that Spark hashes, and rows without identifier are
not shuffled at all. References to earlier turns, the usual ones, need no rounds; where others are, chains are
followed by doubling, in rounds that grow with the logarithm of the longest. Schemas are a parameter of the caller's code, not a table.

Edge cases: a null conversation or identifier never links; equal calls or results of one identifier are
one row, counted in ``n_calls`` / ``n_results``; of different ones the first by turn (then by content) is linked
and the others are rows of their own; null text is JSON null; arguments that aren't JSON objects are
invalid; a null for a parameter that isn't required counts as absent; extra columns are ignored; empty tables
give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.workspace import materialize

#: of each tool its parameters: (JSON type, required) or (JSON type, required, most characters)
Schemas = dict[str, dict[str, tuple]]

REPLY: Schemas = {"reply": {"after": ("string", False), "prompt": ("string", True, 300), "turn": ("integer", True)}}

_TYPES = {"string": r"STRING", "integer": r"(TINYINT|SMALLINT|INT|BIGINT)", "number": r"(TINYINT|SMALLINT|INT|BIGINT|DOUBLE|FLOAT|DECIMAL.*)", "boolean": "BOOLEAN", "array": r"ARRAY<.*", "object": r"OBJECT<.*"}
_STRINGS = r'"((?:[^"\\]|\\.)*)"'
_KEYS = ["conv_id", "call_id"]
ENDLESS = 1 << 30  # steps
_COLUMNS = ["conv_id", "call_id", "status", "at_turn", "step", "n_calls", "n_results", "errors", "json"]


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Messages, joined by '; ', or '' if the arguments (a JSON text) fit the tool's schema."""
    value = F.try_parse_json(arguments)
    given = F.json_object_keys(arguments)
    kind = F.schema_of_variant(value)
    found = F.when(F.lit(False), F.lit(""))
    for tool, parameters in schemas.items():
        checks = []
        for p, (expected, required, *most) in sorted(parameters.items()):
            is_there = F.array_contains(given, p)
            actual = F.schema_of_variant(F.try_variant_get(value, f"$['{p}']", "variant"))
            wrong = is_there & ~actual.rlike(f"^{_TYPES[expected]}$")
            checks.append(F.when(wrong if required else wrong & (actual != "VOID"), F.lit(f"{p}: not {expected}")))
            if most:
                checks.append(F.when(~wrong & (F.length(F.try_variant_get(value, f"$['{p}']", "string")) > most[0]), F.lit(f"{p}: longer than {most[0]}")))
            if required:
                checks.append(F.when(~is_there, F.lit(f"{p}: missing")))
        known = F.array(*(F.lit(p) for p in parameters)) if parameters else F.array().cast("array<string>")
        other = F.array_sort(F.array_except(given, known))
        checks.append(F.when(F.size(other) > 0, F.concat(F.lit("unknown: "), F.array_join(other, ","))))
        errors = F.concat_ws("; ", *checks)
        found = F.when(name == tool, F.when(kind.startswith("OBJECT"), errors).otherwise("arguments: not an object")).otherwise(found)
    return F.coalesce(found, F.lit("no such tool"))


def references(calls: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, call_id, turn, ref, ref_turn): calls whose arguments hold the identifier of another call of their conversation."""
    held = calls.select(*_KEYS, "turn", F.explode(F.array_distinct(F.regexp_extract_all("arguments", F.lit(_STRINGS), F.lit(1)))).alias("ref"))
    known = ids.where("first_call is not null").select("conv_id", F.col("call_id").alias("ref"), F.col("first_call.turn").alias("ref_turn"))
    return held.where("ref <> call_id").join(known.hint("shuffle_hash"), ["conv_id", "ref"])


def _later(place: Column, steps: Column | int) -> Column:
    """So many steps behind a place; what has no end keeps none."""
    return F.struct(place["t"].alias("t"), F.least(place["s"] + steps, F.lit(ENDLESS)).cast("int").alias("s"))


def _start(turn: str) -> Column:
    return F.struct(F.col(turn).alias("t"), F.lit(0).alias("s"))


def moves(edges: DataFrame) -> DataFrame | None:
    """(conv_id, call_id, place: (t, s)) of the calls with references in conversations where one refers to a later turn; None if none does.

    A call's place is (turn, 0) or behind the last place of what it refers to, whichever is later: the longest way along
    references. Each call follows one reference, what all ways so chosen reach is found by doubling, and calls
    that another reference sets later change to it, until none does. ``s`` is ENDLESS on a cycle or behind one.
    """
    forward = edges.where("ref_turn >= turn").select("conv_id").distinct()
    if forward.isEmpty():
        return None
    edges = materialize(edges.join(forward, "conv_id", "left_semi"))
    places = materialize(edges.groupBy(*_KEYS).agg(F.min(_start("turn")).alias("place")).withColumn("follows", F.lit(None).cast("string")))
    most = places.groupBy("conv_id").count().agg(F.max("count")).first()[0] + 1
    while True:
        known = places.select("conv_id", F.col("call_id").alias("ref"), F.col("place").alias("ref_place"))
        behind = _later(F.coalesce("ref_place", _start("ref_turn")), 1)
        best = edges.join(known.hint("shuffle_hash"), ["conv_id", "ref"], "left").groupBy(*_KEYS).agg(F.max(F.struct(behind.alias("place"), "ref")).alias("best"))
        later = F.col("best.place") > F.col("place")
        chosen = places.join(best.hint("shuffle_hash"), _KEYS).select(
            *_KEYS, later.alias("later"), F.greatest("place", "best.place").alias("place"), F.when(later | F.col("follows").isNull(), F.col("best.ref")).otherwise(F.col("follows")).alias("follows")
        )
        chosen = materialize(chosen)
        if chosen.where("later").isEmpty():
            return places.select(*_KEYS, "place")
        places = _reached(chosen.drop("later"), most)


def _reached(chosen: DataFrame, most: int) -> DataFrame:
    """``chosen`` with the last place on or behind the way that starts at each call, in as many rounds as its length has bits.

    A way of more than ``most`` steps to a place meets some call twice.
    """
    ways = chosen.select(*_KEYS, F.col("follows").alias("to"), F.lit(1).alias("steps"), "place")
    length = 1
    while length < 2 * most + 2 and not ways.where("to is not null").isEmpty():
        ahead = ways.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("on"), F.col("steps").alias("more"), F.col("place").alias("there"))
        # a null place would be the least, yet it is one: of a call without a turn
        further = F.when(F.col("there").isNotNull(), F.greatest("place", _later(F.col("there"), F.col("steps")))).otherwise(F.col("place"))
        ways = ways.join(ahead.hint("shuffle_hash"), ["conv_id", "to"], "left").select(*_KEYS, F.col("on").alias("to"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), further.alias("place"))
        ways = materialize(ways)
        length *= 2
    endless = F.struct(F.col("place.t").alias("t"), F.lit(ENDLESS).alias("s"))
    at = ways.select(*_KEYS, F.when(F.col("place.s") > most, endless).otherwise(F.col("place")).alias("place"))
    return materialize(at.join(chosen.select(*_KEYS, "follows").hint("shuffle_hash"), _KEYS))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas, others: DataFrame | None = None) -> DataFrame:
    """Join calls (conv_id, call_id, turn, name, arguments) and results (conv_id, call_id, turn, content); others (conv_id, turn, role, text) pass."""
    calls = calls.groupBy(*_KEYS, "turn", "name", "arguments").agg(F.count("*").alias("copies"))
    results = results.groupBy(*_KEYS, "turn", "content").agg(F.count("*").alias("copies"))
    keyed = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    one = calls.where(keyed).groupBy(*_KEYS).agg(F.min(F.struct("turn", "name", "arguments")).alias("first_call"), F.sum("copies").alias("n_calls"))
    two = results.where(keyed).groupBy(*_KEYS).agg(F.min(F.struct("turn", "content")).alias("first_result"), F.sum("copies").alias("n_results"))
    ids = one.join(two.hint("shuffle_hash"), _KEYS, "full_outer")

    called = calls.join(ids.hint("shuffle_hash"), _KEYS, "left")
    is_first = F.col("first_call").isNull() | (F.struct("turn", "name", "arguments").eqNullSafe(F.col("first_call")))
    answered = is_first & F.col("n_results").isNotNull()
    early = F.col("first_result.turn") < F.col("turn")
    status = F.when(answered & early, "moved").when(answered, "linked").when(is_first, "no_result").otherwise("repeated_call")
    later = moves(references(calls.where(keyed), ids))
    if later is not None:
        called = called.join(later.hint("shuffle_hash"), _KEYS, "left")
        behind = F.coalesce(F.col("place") > _start("turn"), F.lit(False))
        loops = behind & (F.col("place.s") == ENDLESS)
        free = behind & ~loops
        at_turn, step = F.when(free, F.col("place.t")).otherwise(F.col("turn")), F.when(free, F.col("place.s")).otherwise(F.lit(0))
        extra = F.when(loops, F.lit("depends on itself"))
    else:
        at_turn, step, extra = F.col("turn"), F.lit(0), F.lit(None).cast("string")
    errors = F.concat_ws("; ", F.nullif(argument_errors(F.col("name"), F.col("arguments"), schemas), F.lit("")), extra)
    own_call = F.struct(F.try_parse_json("arguments").alias("arguments"), F.col("call_id").alias("id"), F.col("name").alias("name"))
    own_result = lambda content: F.struct(content.alias("content"), F.col("call_id").alias("id"))
    count = lambda c, other=0: F.coalesce(F.col(c), other if isinstance(other, Column) else F.lit(other)).cast("long").alias(c)
    rows = called.select(
        *_KEYS, status.alias("status"), at_turn.cast("long").alias("at_turn"), step.cast("int").alias("step"),
        count("n_calls", F.col("copies")), count("n_results"), errors.alias("errors"),
        _canonical(F.struct(own_call.alias("call"), F.when(answered, own_result(F.col("first_result.content"))).alias("result"))).alias("json"),
    )

    told = results.join(ids.hint("shuffle_hash"), _KEYS, "left")
    is_first = F.col("first_result").isNull() | (F.struct("turn", "content").eqNullSafe(F.col("first_result")))
    alone = told.where(~is_first | F.col("n_calls").isNull()).select(
        *_KEYS, F.when(is_first, "no_call").otherwise("repeated_result").alias("status"), F.col("turn").cast("long").alias("at_turn"), F.lit(0).alias("step"),
        count("n_calls"), count("n_results", F.col("copies")), F.lit("").alias("errors"),
        _canonical(F.struct(F.lit(None).cast("string").alias("call"), own_result(F.col("content")).alias("result"))).alias("json"),
    )
    out = rows.unionByName(alone)
    if others is not None:
        message = _canonical(F.struct(F.struct(F.col("text").alias("content"), F.col("role").alias("role")).alias("message")))
        passed = others.select(
            "conv_id", F.lit(None).cast("string").alias("call_id"), F.lit("message").alias("status"), F.col("turn").cast("long").alias("at_turn"), F.lit(0).alias("step"),
            F.lit(0).cast("long").alias("n_calls"), F.lit(0).cast("long").alias("n_results"), F.lit("").alias("errors"), message.alias("json"),
        )
        out = out.unionByName(passed)
    return out.select(_COLUMNS)


def _canonical(value: Column) -> Column:
    """JSON without blanks; the fields of ``value`` are in the order of their names, as those of a variant are."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def calls_of_turns(conversations: DataFrame) -> DataFrame:
    """Plain conversations as calls: a user turn calls the tool ``reply`` with its text, and with the identifier of the exchange before it."""
    text, turn = F.col("text").alias("prompt"), F.col("turn")
    first = F.to_json(F.struct(text, turn), {"ignoreNullFields": "false"})
    later = F.to_json(F.struct(_call_id(turn - 2).alias("after"), text, turn), {"ignoreNullFields": "false"})
    arguments = F.when(turn >= 2, later).otherwise(first)
    return conversations.where(F.col("role") == "user").select("conv_id", _call_id(turn).alias("call_id"), "turn", F.lit("reply").alias("name"), arguments.alias("arguments"))


def results_of_turns(conversations: DataFrame) -> DataFrame:
    """An assistant turn is the result of the call in the turn before."""
    return conversations.where(F.col("role") == "assistant").select("conv_id", _call_id(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))


def other_turns(conversations: DataFrame, used: tuple[str, ...] = ("user", "assistant")) -> DataFrame:
    return conversations.where(~F.coalesce(F.col("role").isin(*used), F.lit(False))).select("conv_id", "turn", "role", "text")


def _call_id(turn: Column) -> Column:
    return F.concat(F.lit("call_"), turn.cast("string"))


def calls_of_json(messages: DataFrame) -> DataFrame:
    """Calls in assistant messages of the form {"tool_calls": [{"id", "name", "arguments": {...}}]}."""
    kind = "struct<tool_calls: array<struct<id: string, name: string, arguments: variant>>>"
    parsed = messages.where(F.col("role") == "assistant").select("conv_id", "turn", F.explode(F.from_json("text", kind)["tool_calls"]).alias("c"))
    return parsed.select("conv_id", F.col("c.id").alias("call_id"), "turn", F.col("c.name").alias("name"), F.to_json("c.arguments").alias("arguments"))


def results_of_json(messages: DataFrame) -> DataFrame:
    """Results in messages of the role ``tool`` of the form {"tool_call_id", "content"}."""
    parsed = messages.where(F.col("role") == "tool").select("conv_id", "turn", F.from_json("text", "struct<tool_call_id: string, content: string>").alias("r"))
    return parsed.select("conv_id", F.col("r.tool_call_id").alias("call_id"), "turn", F.col("r.content").alias("content"))


def op1_chat_tool_links(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return link(calls_of_turns(turns), results_of_turns(turns), REPLY, other_turns(turns))


# DuckDB: the references of these calls are all to earlier turns, so that no call moves.
ORACLE = r"""
with c as (
  select conv_id, 'call_' || turn::varchar call_id, turn, text, count(*) copies from conversations where role = 'user' group by all
), r as (
  select conv_id, 'call_' || (turn - 1)::varchar call_id, turn, text, count(*) copies from conversations where role = 'assistant' group by all
), c2 as (
  select *, row_number() over (partition by conv_id, call_id order by turn, text nulls first) k, sum(copies) over (partition by conv_id, call_id) n from c
), r2 as (
  select *, row_number() over (partition by conv_id, call_id order by turn, text nulls first) k, sum(copies) over (partition by conv_id, call_id) n from r
), rows_ as (
  select c2.conv_id, c2.call_id, case when c2.k > 1 then 'repeated_call' when r2.n is null then 'no_result' when r2.turn < c2.turn then 'moved' else 'linked' end status,
         c2.turn at_turn, c2.n n_calls, coalesce(r2.n, 0) n_results,
         case when c2.text is null then 'prompt: not string' when length(c2.text) > 300 then 'prompt: longer than 300' else '' end errors,
         '{"call":{"arguments":{' || case when c2.turn >= 2 then '"after":"call_' || (c2.turn - 2)::varchar || '",' else '' end || '"prompt":' || coalesce(to_json(c2.text)::varchar, 'null') || ',"turn":' || c2.turn::varchar
         || '},"id":' || to_json(c2.call_id)::varchar || ',"name":"reply"},"result":'
         || case when c2.k = 1 and r2.n is not null then '{"content":' || coalesce(to_json(r2.text)::varchar, 'null') || ',"id":' || to_json(c2.call_id)::varchar || '}' else 'null' end || '}' json
  from c2 left join r2 on c2.conv_id = r2.conv_id and c2.call_id = r2.call_id and r2.k = 1
  union all
  select r2.conv_id, r2.call_id, case when r2.k > 1 then 'repeated_result' else 'no_call' end, r2.turn, coalesce(c2.n, 0), r2.n, '',
         '{"call":null,"result":{"content":' || coalesce(to_json(r2.text)::varchar, 'null') || ',"id":' || to_json(r2.call_id)::varchar || '}}'
  from r2 left join c2 on c2.conv_id = r2.conv_id and c2.call_id = r2.call_id and c2.k = 1 where r2.k > 1 or c2.n is null
  union all
  select conv_id, null, 'message', turn, 0, 0, '', '{"message":{"content":' || coalesce(to_json(text)::varchar, 'null') || ',"role":' || coalesce(to_json(role)::varchar, 'null') || '}}'
  from conversations where role is null or role not in ('user', 'assistant')
)
select conv_id, call_id, status, at_turn::bigint at_turn, 0::int step, n_calls::bigint n_calls, n_results::bigint n_results, errors, json from rows_
"""
