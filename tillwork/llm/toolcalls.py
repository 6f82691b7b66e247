"""Tool calls of chats: linked with their results, put in topological order, validated, written as canonical JSON."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import settle, table


@dataclass(frozen=True)
class Field:
    """What a schema says of one value: string, integer, number, boolean, array or object; inclusive limits; the JSON of
    the values that are allowed; the rule of every item of an array; the fields of an object, which then has no others."""

    kind: str
    required: bool = False
    least: int | None = None
    most: int | None = None
    choices: tuple[str, ...] = ()
    items: Field | None = None
    fields: dict[str, Field] | None = None


Schemas = dict[str, dict[str, Field]]

# How the variant type names what JSON calls by these names.
VARIANT_TYPES = {
    "string": r"^STRING$",
    "integer": r"^BIGINT$",
    "number": r"^(BIGINT|DOUBLE|DECIMAL.*)$",
    "boolean": r"^BOOLEAN$",
    "array": r"^ARRAY<",
    "object": r"^OBJECT<",
}


def canonical_json(value: Column) -> Column:
    """JSON of a variant, in one spelling for equal values: no blanks, keys sorted at every depth, strings with the same
    escapes, numbers without exponent and closing zeros (100, 1e2 and 100.00 are 100; -0.0 is 0). Numbers from 1e38 on and
    below 1e-20 are written as doubles.

    Escaped backslashes and quotes are set aside as control characters, which JSON never holds as such. Then every
    second part between quotes is a string and the rest holds the numbers."""
    plain = F.replace(F.replace(F.to_json(value), F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    tokens = lambda part: F.regexp_extract_all(part, F.lit("(-?[0-9][0-9.Ee+-]*|[^-0-9]+)"), F.lit(1))
    outside = lambda part: F.array_join(F.transform(tokens(part), _plain_number), "")
    parts = F.transform(F.split(plain, '"'), lambda part, i: F.when(i % 2 == 0, outside(part)).otherwise(part))
    told = F.array_join(parts, '"')
    return F.replace(F.replace(told, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))


def _plain_number(token: Column) -> Column:
    """The one spelling of a number; other tokens stay as they are."""
    double = token.cast("double")
    size = F.abs(double)
    whole = F.when(double % 1 == 0, token.try_cast("decimal(38,0)").cast("string"))
    digits = F.when(token.rlike("[Ee]"), F.coalesce(
        F.when(size >= 1, F.coalesce(whole, token.try_cast("decimal(38,18)").cast("string"))),
        token.try_cast("decimal(38,37)").cast("string"),
    )).otherwise(token)
    cut = F.when(digits.contains("."), F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", "")).otherwise(digits)
    fraction = F.when((size < 1e-20) | (size >= 1e38), double.cast("string")).otherwise(cut)
    return F.when(~token.rlike("^-?[0-9]"), token).when(token.rlike("^-?[0.]+(?:[Ee].*)?$"), "0").when(token.rlike("[.Ee]"), fraction).otherwise(token)


Check = tuple[str, Callable[[Column], Column]]


def checks_of(rule: Field, path: str = "") -> list[Check]:
    """Messages with their conditions on a value that is there."""
    named = f"{path}: " if path else ""
    found: list[Check] = [(f"{named}not {rule.kind}", lambda v: ~F.schema_of_variant(v).rlike(VARIANT_TYPES[rule.kind]))]
    number = lambda v: F.try_variant_get(v, "$", "double")
    if rule.least is not None:
        found.append((f"{named}below {rule.least}", lambda v: number(v) < rule.least))
    if rule.most is not None:
        found.append((f"{named}above {rule.most}", lambda v: number(v) > rule.most))
    if rule.choices:
        found.append((f"{named}not one of {', '.join(rule.choices)}", lambda v: ~canonical_json(v).isin(*rule.choices)))
    if rule.items:
        for message, wrong in checks_of(rule.items, f"{path}[]"):
            found.append((message, lambda v, wrong=wrong: F.exists(F.try_variant_get(v, "$", "array<variant>"), lambda item: wrong(item))))
    if rule.fields is not None:
        found += field_checks(rule.fields, path)
    return found


def field_checks(fields: dict[str, Field], path: str = "") -> list[Check]:
    """What the fields of an object must hold, and that it has no others."""
    found: list[Check] = []
    for name, rule in sorted(fields.items()):
        own = f"{path}.{name}" if path else name
        child = lambda v, name=name: F.try_variant_get(v, f'$["{name}"]', "variant")
        if rule.required:
            found.append((f"{own}: missing", lambda v, child=child: F.schema_of_variant(v).startswith("OBJECT<") & child(v).isNull()))
        for message, wrong in checks_of(rule, own):
            found.append((message, lambda v, child=child, wrong=wrong: child(v).isNotNull() & wrong(child(v))))
    known = F.array(*[F.lit(f) for f in sorted(fields)]).cast("array<string>")
    keys = lambda v: F.json_object_keys(F.to_json(v))
    found.append((f"{path}: unknown argument" if path else "unknown argument", lambda v: F.size(F.array_except(keys(v), known)) > 0))
    return found


def argument_errors(arguments: Column, name: Column, schemas: Schemas) -> Column:
    """The sorted names of what is wrong with the arguments (a variant, null if they are no JSON), at every depth: a field
    of an object is named behind a dot, the items of an array by brackets."""
    kind = F.schema_of_variant(arguments)
    checks: list[Column] = []
    for tool, fields in sorted(schemas.items()):
        checks += [F.when((name == tool) & wrong(arguments), F.lit(message)) for message, wrong in field_checks(fields)]
    checks.append(F.when(~name.isin(*schemas) | name.isNull(), F.lit("unknown tool")))
    found = F.array_sort(F.array_compact(F.array(*checks)))
    return F.when(arguments.isNull() | ~kind.startswith("OBJECT"), F.array(F.lit("not an object"))).otherwise(found)


def topological_levels(calls: DataFrame) -> DataFrame:
    """(call_id, level) for calls (call_id, after: identifiers of the calls that come before): how many calls stand before
    one on the longest way to it; null for calls of a cycle or behind one.

    Calls with one predecessor are followed along their chain in steps of doubling length, up to a call without
    predecessors or with several; so chains cost the logarithm of their length, and what still has a way to go after more
    steps than the number of calls allows is a cycle. Calls with several predecessors are then ordered in rounds, each
    taking those whose predecessors all have a level: as many rounds as such calls stand behind each other."""
    edges = calls.select("call_id", F.explode(F.array_distinct("after")).alias("known")).join(
        calls.select(F.col("call_id").alias("known")), "known"
    )
    many = settle(edges.groupBy("call_id").agg(F.count("*").alias("n"), F.min("known").alias("up")), "call-predecessors")
    state = calls.select("call_id").join(many, "call_id", "left").select(
        "call_id", F.when(F.col("n") == 1, F.col("up")).alias("up"), F.expr("cast(n <=> 1 as long)").alias("steps"),
        F.coalesce(F.when(F.col("n") == 1, F.col("up")), "call_id").alias("anchor"),
    )
    state = settle(state, "call-chains")
    left = state.count()
    while left and state.where("up is not null").limit(1).count():
        ahead = state.select(F.col("call_id").alias("at"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("anchor").alias("far"))
        going = state.where("up is not null").join(ahead, F.col("up") == F.col("at"))
        moved = going.select("call_id", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), F.col("far").alias("anchor"))
        state = settle(state.where("up is null").unionByName(moved), "call-chains")
        left //= 2
    chains = state.where("up is null").select("call_id", "anchor", "steps")
    several = many.where("n > 1").select("call_id")
    levels = chains.where("call_id = anchor").join(several, "call_id", "left_anti").select("call_id", F.lit(0).cast("long").alias("level"))
    if several.limit(1).count():
        open_edges = edges.join(several, "call_id", "left_semi").join(state.selectExpr("call_id as known", "up", "anchor", "steps"), "known")
        open_edges = settle(
            open_edges.selectExpr("call_id", "if(up is null, anchor, null) as anchor", "steps + 1 as steps", "cast(null as long) as level"), "call-edges"
        )
        fresh = levels = settle(levels, "call-levels")
        while fresh.limit(1).count() and open_edges.limit(1).count():
            reached = fresh.select(F.col("call_id").alias("anchor"), F.col("level").alias("base"))
            filled = settle(open_edges.join(reached, "anchor", "left").select(
                "call_id", "anchor", "steps", F.coalesce("level", F.col("base") + F.col("steps")).alias("level")
            ), "call-edges")
            done = filled.groupBy("call_id").agg(F.max("level").alias("level"), F.bool_and(F.col("level").isNotNull()).alias("all"))
            fresh = settle(done.where("all").select("call_id", "level"), "call-levels")
            levels = levels.unionByName(fresh)
            open_edges = settle(filled.join(fresh.select("call_id"), "call_id", "left_anti"), "call-edges")
    behind = chains.join(levels.select(F.col("call_id").alias("anchor"), "level"), "anchor")
    found = behind.select("call_id", (F.col("level") + F.col("steps")).alias("level"))
    return calls.select("call_id").join(found, "call_id", "left")


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row for each call (call_id, conv_id, turn, name, arguments, after) with its result (call_id, content):
    (call_id, conv_id, turn, name, level, answered, valid, errors, canonical).

    Calls and results are joined by identifier. ``after`` names the calls that come before one (an array, or one
    identifier); ``level`` is the topological order, null for calls of a cycle or behind one. Names that are null, unknown
    or repeated don't count. ``canonical`` is JSON in one spelling for equal values (``canonical_json``); a missing result
    has no key. Calls of one identifier are one (the smallest by conversation, turn, name, arguments and predecessors), so
    are results; a null identifier links with nothing and is left out, as it cannot be answered. Results without a call
    are left out. Arguments that are null or no JSON object are invalid; those that are no JSON have no key. Texts may be
    of any length; empty tables give no rows; only the named columns are read."""
    own = F.struct("conv_id", "turn", "name", "arguments", "after")
    if calls.schema["after"].dataType.simpleString() == "string":
        calls = calls.withColumn("after", F.when(F.col("after").isNotNull(), F.array("after")))
    calls = calls.where("call_id is not null").groupBy("call_id").agg(F.min(own).alias("c")).select("call_id", "c.*")
    calls = settle(calls, "tool-calls")
    answers = results.where("call_id is not null").groupBy("call_id").agg(F.min("content").alias("content"), F.lit(True).alias("there"))
    linked = calls.join(answers, "call_id", "left").join(topological_levels(calls.select("call_id", "after")), "call_id")
    linked = linked.withColumn("parsed", F.try_parse_json("arguments"))
    linked = linked.withColumn("wrong", argument_errors(F.col("parsed"), F.col("name"), schemas))
    rest = F.to_json(F.struct(F.col("call_id").alias("id"), "name", F.col("content").alias("result")))
    first = F.when(F.col("parsed").isNotNull(), F.concat(F.lit('{"arguments":'), canonical_json(F.col("parsed")), F.lit(",")))
    return linked.select(
        "call_id", "conv_id", "turn", "name", "level",
        F.coalesce("there", F.lit(False)).alias("answered"),
        (F.size("wrong") == 0).alias("valid"),
        F.array_join("wrong", "; ").alias("errors"),
        F.concat(F.coalesce(first, F.lit("{")), F.substr(rest, F.lit(2))).alias("canonical"),
    )


# The conversations hold no tool calls of their own: every assistant turn is one here, the next turn answers it.
TOOLS = ("count", "lookup", "search")
SCHEMAS: Schemas = {
    "count": {"words": Field("integer", required=True, least=0)},
    "lookup": {"text": Field("string", required=True), "words": Field("integer", most=150)},
    "search": {"text": Field("string", required=True), "words": Field("integer", required=True, least=1)},
}


def derived_calls(chats: DataFrame) -> tuple[DataFrame, DataFrame]:
    identifier = "concat('call_', conv_id, '_', {})"
    calls = chats.where("role = 'assistant'").selectExpr(
        f"{identifier.format('turn')} as call_id",
        "conv_id",
        "turn",
        f"element_at(array{TOOLS}, cast(pmod(conv_id + turn, 3) as int) + 1) as name",
        "to_json(named_struct('words', size(split(text, ' ')), 'text', if(pmod(conv_id, 5) = 0, null, text))) as arguments",
        f"{identifier.format('turn - 2')} as after",
    )
    results = chats.selectExpr(f"{identifier.format('turn - 1')} as call_id", "text as content")
    return calls, results


def op2_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    return link_tool_calls(*derived_calls(table(spark, folder, "conversations")), SCHEMAS)


OP2_SQL = """
with recursive turns as (select conv_id, turn, text, role, len(string_split(text, ' ')) as words,
    case when conv_id % 5 = 0 then null else text end as told from conversations),
calls as (select 'call_' || conv_id || '_' || turn as call_id, conv_id, turn, words, told,
    ['count', 'lookup', 'search'][(conv_id + turn) % 3 + 1] as name, 'call_' || conv_id || '_' || (turn - 2) as after
    from turns where role = 'assistant'),
levels as (select call_id, 0::bigint as level from calls where after not in (select call_id from calls)
    union all select c.call_id, l.level + 1 from calls c join levels l on c.after = l.call_id),
joined as (select c.*, l.level, r.text as result, r.conv_id is not null as answered from calls c join levels l using (call_id)
    left join conversations r on r.conv_id = c.conv_id and r.turn = c.turn + 1),
judged as (select *, concat_ws('; ',
    case when name in ('lookup', 'search') and told is null then 'text: missing' end,
    case when name = 'count' and told is not null then 'unknown argument' end,
    case when name = 'lookup' and words > 150 then 'words: above 150' end,
    case when name = 'count' and words < 0 then 'words: below 0' end,
    case when name = 'search' and words < 1 then 'words: below 1' end) as errors from joined)
select call_id, conv_id, turn, name, level, answered, errors = '' as valid, errors,
    '{"arguments":{' || case when told is null then '' else '"text":' || to_json(told)::varchar || ',' end || '"words":' || words
    || '},"id":"' || call_id || '","name":"' || name || '"' || case when result is null then '' else ',"result":' || to_json(result)::varchar end
    || '}' as canonical
from judged"""
