"""Chat formatting with tool-call linking, of built-in functions only.

A message whose text is a JSON object with `tool_calls` (an array of {id, name, arguments, depends_on}) makes calls; one of
role `tool` whose text is a JSON object with `tool_call_id` is a result. Calls and results are joined by (conversation,
identifier); only messages that hold either are shuffled. Calls are ordered topologically: a call's depth is one more than
that of the deepest call it depends on, found round by round over the edges that are left; calls on a cycle have none and
are marked. Arguments are checked against schemas: required keys are there, known keys have the stated type. Schemas stand in
the conversation: a message of role `system` or `developer` whose text is a JSON object with `tools` (an array of {name,
parameters}, as they are or under `function`; the last of a name counts); others may be given for all conversations. Every
message is serialised as canonical JSON: keys in order, no space, arguments normalised.

Null text is null content. A message that is no JSON object is plain content. Every call counts, also if its identifier is
repeated: a result belongs to the nearest earlier call of its identifier (to the first, if none is earlier), and a call
depends on the nearest call of that identifier before it (on the first after it, if none is). Content and further keys of
messages, calls and results are kept, in order of keys. Messages of one turn are told apart by role and text; rows that are the
same are rows each, of the same calls, which count once. A null conv_id is a conversation of its own, a null turn comes
first. An empty table gives no rows; further columns are ignored. No conversation is gathered in one place: there is a row for each message.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import stash

CALL = "array<struct<id:string,name:string,arguments:string,depends_on:array<string>>>"
#: Types of schemas, as the kinds of parsed values.
KINDS = {"string": "STRING", "number": "DOUBLE", "integer": "BIGINT", "boolean": "BOOLEAN", "array": "ARRAY", "object": "OBJECT"}


def canonical(text: F.Column) -> F.Column:
    """JSON with sorted keys and no space; null if it isn't JSON."""
    return F.to_json(F.try_parse_json(text))


def quoted(x: F.Column) -> F.Column:
    return F.coalesce(F.regexp_extract(F.to_json(F.struct(x.alias("k"))), r"(?s)^\{\"k\":(.*)\}$", 1), F.lit("null"))


def json_of(x: F.Column) -> F.Column:
    return F.when(x.isNull(), F.lit("null")).otherwise(quoted(x))


def written(v: F.Column, own: dict[str, F.Column]) -> F.Column:
    """The object of the given keys (as JSON) and all other keys of the variant v, in order of keys."""
    other = F.map_filter(v.try_cast("map<string,variant>"), lambda k, _: ~k.isin(*own))
    pairs = F.transform(F.map_entries(other), lambda e: F.struct(e["key"].alias("k"), F.coalesce(F.to_json(e["value"]), F.lit("null")).alias("j")))
    mine = F.array(*[F.struct(F.lit(k).alias("k"), j.alias("j")) for k, j in own.items()])
    every = F.array_sort(F.concat(F.coalesce(pairs, F.slice(mine, 1, 0)), mine))
    return F.concat(F.lit("{"), F.array_join(F.transform(every, lambda e: F.concat(quoted(e["k"]), F.lit(":"), e["j"])), ","), F.lit("}"))


def parse(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, message (a hash of the row) with calls (array) and answers (identifier)."""
    obj = F.when(F.ltrim(F.col("text"), F.lit(" \t\n\r")).startswith("{"), F.try_parse_json("text"))
    calls = F.when(F.col("role") == "assistant", F.expr("try_variant_get(v, '$.tool_calls', 'array<variant>')"))
    m = messages.select("conv_id", "turn", "role", "text").withColumn("v", obj).withColumn("raw", calls)

    def get(x, path: str, kind: str):
        return F.try_variant_get(x, path, kind)

    def arguments(x):
        a = get(x, "$.arguments", "variant")
        return F.coalesce(F.when(F.schema_of_variant(a) == "STRING", F.to_json(F.try_parse_json(get(x, "$.arguments", "string")))), F.to_json(a))

    made = F.transform("raw", lambda x: F.struct(get(x, "$.id", "string").alias("id"), get(x, "$.name", "string").alias("name"), arguments(x).alias("arguments"), F.coalesce(get(x, "$.depends_on", "array<string>"), F.array().cast("array<string>")).alias("depends_on"), written(x, {"arguments": F.coalesce(arguments(x), F.lit("null")), "id": json_of(get(x, "$.id", "string")), "name": json_of(get(x, "$.name", "string"))}).alias("json")))
    answers = F.when(F.col("role") == "tool", get(F.col("v"), "$.tool_call_id", "string"))
    return m.select("conv_id", "turn", "role", "text", F.xxhash64("conv_id", "turn", "role", "text").alias("message"), made.alias("calls"), answers.alias("answers"), "v")


def schemas_of(parsed: DataFrame) -> DataFrame:
    """conv_id, name, required, types of the tools that conversations state."""
    tools = F.when(F.col("role").isin("system", "developer"), F.try_variant_get("v", "$.tools", "array<variant>"))
    t = parsed.filter(F.col("v").isNotNull()).select("conv_id", "turn", F.posexplode(tools).alias("at", "t"))
    get = lambda path, kind: F.coalesce(F.try_variant_get("t", f"$.function.{path}", kind), F.try_variant_get("t", f"$.{path}", kind))
    kinds = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    stated = F.transform_values(get("parameters.properties", "map<string,variant>"), lambda _, x: F.element_at(kinds, F.try_variant_get(x, "$.type", "string")))
    known = F.map_filter(stated, lambda _, x: x.isNotNull())
    t = t.select("conv_id", "turn", "at", get("name", "string").alias("name"), get("parameters.required", "array<string>").alias("required"), known.alias("types")).filter("name is not null")
    return t.groupBy("conv_id", "name").agg(F.max_by(F.struct("required", "types"), F.struct("turn", "at")).alias("s")).select("conv_id", "name", "s.required", "s.types")


def link_calls(spark: SparkSession, parsed: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call: conv_id, turn, message, at, id, name, arguments, depth (null on a cycle), valid, results.

    schemas: name, required (array of keys), types (map of key to STRING, BIGINT, DOUBLE, BOOLEAN, ARRAY or OBJECT), for
    conversations that state none of that name.
    """
    has = parsed.filter(F.size("calls") > 0).select("conv_id", "turn", "message", "calls").dropDuplicates(["conv_id", "turn", "message"])
    calls = has.select("conv_id", "turn", "message", F.posexplode("calls").alias("at", "c")).select("conv_id", "turn", "message", "at", "c.*")
    calls = stash(spark, calls.withColumn("uid", F.monotonically_increasing_id()), "calls")
    known = calls.filter("id is not null").select("conv_id", F.col("id").alias("key"), "turn", F.lit(0).alias("asks"), "at", "uid", F.lit(None).cast("long").alias("of"))

    def nearest(asked: DataFrame) -> DataFrame:
        """(of, uid): the last call of the key up to the asking turn, else the first one after; none if there is none."""
        w = W.partitionBy("conv_id", "key").orderBy("turn", "asks", "at")
        so_far, any_ = F.last("uid", True).over(w.rowsBetween(W.unboundedPreceding, 0)), F.first("uid", True).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        return known.unionByName(asked).select("asks", "of", F.coalesce(so_far, any_).alias("uid")).filter("asks = 1 and uid is not null").select("of", "uid")

    none = [F.lit(1).alias("asks"), F.lit(0).alias("at"), F.lit(None).cast("long").alias("uid")]
    answers = parsed.filter(F.col("answers").isNotNull()).select("conv_id", F.col("answers").alias("key"), "turn", *none, F.lit(0).cast("long").alias("of"))
    results = nearest(answers).groupBy("uid").agg(F.count("*").alias("results"))
    linked = calls.join(results, "uid", "left").withColumn("results", F.coalesce("results", F.lit(0)))

    # depth, round by round: a call whose calls are all placed is placed next
    nodes = calls.select("uid")
    need = calls.select("conv_id", F.explode("depends_on").alias("key"), "turn", *[c for c in none[:2]], F.lit(None).cast("long").alias("uid"), F.col("uid").alias("of"))
    left = stash(spark, nearest(need.filter("key is not null")).select(F.col("of").alias("uid"), F.col("uid").alias("on")).distinct(), "edges")
    placed, open_, depth = None, nodes, 0
    while True:
        now = stash(spark, open_.join(left.select("uid"), "uid", "left_anti").withColumn("depth", F.lit(depth)), "placed")
        placed = now if placed is None else placed.union(now)
        if not left.limit(1).count() or not now.limit(1).count():
            break
        open_ = stash(spark, open_.join(now, "uid", "left_anti"), "open")
        left = stash(spark, left.join(now.select(F.col("uid").alias("on")), "on", "left_anti").select("uid", "on"), "edges")
        depth += 1
    linked = linked.join(placed, "uid", "left")

    y, o, s = linked.alias("y"), schemas_of(parsed).alias("o"), schemas.alias("s")
    y = y.join(o, F.col("y.conv_id").eqNullSafe(F.col("o.conv_id")) & (F.col("y.name") == F.col("o.name")), "left").join(s, F.col("y.name") == F.col("s.name"), "left")
    stated = F.col("o.name").isNotNull()
    pick = lambda c: F.when(stated, F.col(f"o.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
    y = y.select("y.*", (stated | F.col("s.name").isNotNull()).alias("known"), pick("required"), pick("types"))
    keys = F.json_object_keys("arguments")
    missing = F.exists("required", lambda k: ~F.array_contains(keys, k))
    y = y.withColumn("own", F.expr("try_cast(try_parse_json(arguments) as map<string,variant>)"))
    wanted = F.map_filter("types", lambda k, _: F.array_contains(F.map_keys("own"), k))
    kinds = F.map_keys(wanted)

    def fits(k):
        kind, want = F.schema_of_variant(F.element_at("own", k)), F.element_at("types", k)
        return F.when(want == "DOUBLE", kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")).otherwise(kind.startswith(want))

    wrong = F.exists(kinds, lambda k: ~fits(k))
    valid = F.col("known") & keys.isNotNull() & ~F.coalesce(missing, F.lit(False)) & ~F.coalesce(wrong, F.lit(False))
    return y.withColumn("valid", F.coalesce(valid, F.lit(False))).drop("required", "types", "known", "depends_on", "own")


def no_schemas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "name string, required array<string>, types map<string,string>")


def format_chat(spark: SparkSession, messages: DataFrame, schemas: DataFrame | None = None) -> DataFrame:
    """conv_id, turn, role, json, n_calls, n_linked, n_valid, n_cyclic of every message. schemas: see link_calls."""
    parsed = parse(messages)
    calls = link_calls(spark, parsed, schemas if schemas is not None else no_schemas(spark))
    one = F.struct("depth", "turn", "at", "json")
    per = calls.groupBy("message").agg(
        F.sort_array(F.collect_list(one)).alias("ordered"),  # the calls of one message
        F.count("*").alias("n_calls"),
        F.sum((F.col("results") > 0).cast("int")).alias("n_linked"),
        F.sum(F.col("valid").cast("int")).alias("n_valid"),
        F.sum(F.col("depth").isNull().cast("int")).alias("n_cyclic"),
    )
    p, c = parsed.alias("p"), per.alias("c")
    m = p.join(c, (F.col("p.message") == F.col("c.message")) & (F.size("p.calls") > 0), "left").select("p.*", "c.ordered", "c.n_calls", "c.n_linked", "c.n_valid", "c.n_cyclic")
    head = F.concat(F.lit(',"role":'), json_of(F.col("role")))
    plain = F.concat(F.lit('{"content":'), json_of(F.col("text")), head, F.lit("}"))
    content = F.coalesce(F.to_json(F.try_variant_get(F.col("v"), "$.content", "variant")), F.lit("null"))
    each = F.concat(F.lit("["), F.array_join(F.transform("ordered", lambda x: x["json"]), ","), F.lit("]"))
    made = written(F.col("v"), {"content": content, "role": json_of(F.col("role")), "tool_calls": each})
    answer = written(F.col("v"), {"content": content, "role": json_of(F.col("role")), "tool_call_id": json_of(F.col("answers"))})
    line = F.when(F.size("ordered") > 0, made).when(F.col("answers").isNotNull(), answer).otherwise(plain)
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return m.select("conv_id", "turn", "role", line.alias("json"), *map(count, ("n_calls", "n_linked", "n_valid", "n_cyclic")))
