"""Chat formatting: tool calls linked with their results, ordered, validated and written as canonical JSON.

DataFrame functions only. An assistant message whose text is a JSON object with ``tool_calls`` holds calls (id, name, arguments,
after: ids of calls that have to come first); a message of role ``tool`` whose text is an object with ``tool_call_id`` holds a
result (content). Calls and results meet in hash joins on conversation and id. Calls get the level of their longest chain of
predecessors, so (level, turn, place) is a topological order: chains are followed by doubling, and only calls that link chains
take further rounds. Arguments are checked against the tool's schema. Canonical JSON has the keys of every
object sorted, no white space, and strings escaped as little as can be.

Edge cases: null or empty texts, texts that are no JSON or another object, and other roles are plain messages and give no row; of
calls that repeat an id the first (by turn and place) counts, the others have status ``repeated``; of results for a call the first counts, a
result without call has status ``orphan`` and no call columns; a call without result has status ``open``; predecessors that are not
calls of the conversation are left out; calls in a cycle, or behind one, have no level; arguments that are missing or no object are
``invalid``; messages without conversation or ids are left out; repeated rows are repeated calls; texts of any length are parsed whole;
of equal (turn, place) any one counts; an empty table gives no rows; other columns are not read, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.texts import keep
from starmill.session import work_folder

# A tool's arguments: name -> (type, required); types as in schema_of_variant.
Schemas = dict[str, dict[str, tuple[str, bool]]]


def canonical(json: Column) -> Column:
    """JSON text with sorted keys; null where it is no JSON."""
    return F.to_json(F.try_parse_json(json))


def parse(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls (conv_id, turn, place, call_id, name, arguments, after) and results (conv_id, turn, call_id, content)."""
    rows = messages.select("conv_id", "turn", "role", "text").filter("conv_id is not null")
    calls = rows.filter("role = 'assistant' and text like '%tool_calls%'").select("conv_id", "turn", F.posexplode(
        F.from_json("text", "tool_calls array<struct<id:string,name:string,arguments:string,after:array<string>>>")
        ["tool_calls"]).alias("place", "call"))
    calls = calls.select("conv_id", "turn", "place", F.col("call.id").alias("call_id"), F.col("call.name").alias("name"),
                         F.col("call.arguments").alias("arguments"), F.col("call.after").alias("after"))
    results = rows.filter("role = 'tool' and text like '%tool_call_id%'").select(
        "conv_id", "turn", F.from_json("text", "tool_call_id string, content string").alias("result"))
    results = results.select("conv_id", "turn", F.col("result.tool_call_id").alias("call_id"),
                             F.col("result.content").alias("content"))
    return calls.filter("call_id is not null"), results.filter("call_id is not null")


def errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with the arguments, sorted: unknown tool, invalid, missing:x, type:x, unknown:x."""
    parsed = F.try_parse_json(arguments)
    kind = F.schema_of_variant(parsed)
    keys = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
    cases = F.when(~F.coalesce(name, F.lit("")).isin(*schemas), F.array(F.lit("unknown tool")))
    cases = cases.when(F.coalesce(~kind.startswith("OBJECT"), F.lit(True)), F.array(F.lit("invalid")))
    for tool, fields in schemas.items():
        more = F.array_except(keys, F.array(*map(F.lit, fields)).cast("array<string>"))
        found = [F.transform(more, lambda k: F.concat(F.lit("unknown:"), k))]
        for field, (wanted, required) in fields.items():
            own = F.schema_of_variant(F.try_variant_get(parsed, f"$.{field}", "variant"))
            there = F.array_contains(keys, field) & own.isNotNull()
            wrong = F.when(there & (own != wanted) & (F.lit(required) | (own != "VOID")), F.array(F.lit(f"type:{field}")))
            if required:
                wrong = wrong.when(~there, F.array(F.lit(f"missing:{field}")))
            found.append(wrong.otherwise(F.array().cast("array<string>")))
        cases = cases.when(name == tool, F.array_sort(F.concat(*found)))
    return cases


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level: the longest chain of predecessors; calls in or behind a cycle are missing.

    A call without open predecessors has its level. One with a single open predecessor has the level ``max(c, level of it + w)``;
    such steps add up to one of the same form, so chains of them are followed by doubling, in as many steps as the
    logarithm of their length. Only calls with several open predecessors go to the next round, with their links led back to
    the calls that the chains end at; whoever waits for one of these gets its level when it has one. What is found is appended to
    one folder, so plans stay as small as a round's.
    """
    key = ["conv_id", "call_id"]
    known = calls.select(*key)
    links = calls.select(*key, F.explode(F.array_distinct("after")).alias("before"))
    links = links.join(known.select("conv_id", F.col("call_id").alias("before")).hint("shuffle_hash"), ["conv_id", "before"])
    edges = keep(links.select(*key, "before", F.lit(1).alias("w")), "calls-links")
    nodes = keep(known.withColumn("c", F.lit(0)), "calls-nodes")
    kind = dict(calls.dtypes)["conv_id"]
    found = Folder(calls.sparkSession, f"conv_id {kind}, call_id string, level int")
    waiting = Folder(calls.sparkSession, f"conv_id {kind}, call_id string, end string, c int, w int, turn int")
    turn = 0
    while True:
        open_links = edges.groupBy(*key).agg(F.count("*").alias("n"), F.max("before").alias("ptr"), F.max("w").alias("w"))
        state = nodes.join(open_links, key, "left").select(*key, "c", F.coalesce("n", F.lit(0)).alias("n"), "ptr", F.coalesce("w", F.lit(0)).alias("w"))
        state = keep(state, "calls-state")
        total, many = state.agg(F.count("*"), F.count_if(F.col("n") > 1)).first()
        if total == many:  # nothing left, or cycles
            break
        chains = follow(state)
        found.add(state.filter("n = 0").select(*key, F.col("c").alias("level")))
        found.add(chains.filter("end_n = 0").select(*key, F.greatest(F.col("c"), F.col("end_c") + F.col("w")).alias("level")))
        if not many:
            break
        late = chains.filter("end_n > 1").select(*key, F.col("ptr").alias("end"), "c", "w")
        waiting.add(late.withColumn("turn", F.lit(turn)))
        nodes, edges = contracted(state.filter("n > 1"), edges, found.read(), late)
        turn += 1
    for back in reversed(range(turn)):
        ends = found.read().select("conv_id", F.col("call_id").alias("end"), F.col("level").alias("end_level"))
        found.add(waiting.read().filter(F.col("turn") == back).join(ends, ["conv_id", "end"]).select(
            *key, F.greatest(F.col("c"), F.col("end_level") + F.col("w")).alias("level")))
    return found.read()


class Folder:
    """Rows appended in rounds to one folder of the shared work folder."""

    def __init__(self, spark: SparkSession, schema: str):
        self.spark, self.schema, self.path = spark, schema, work_folder(spark, "calls-rounds")
        spark.createDataFrame([], schema).write.parquet(self.path)

    def add(self, rows: DataFrame) -> None:
        names = [f.split()[0] for f in self.schema.split(", ")]
        rows.select(*names).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)


def follow(state: DataFrame) -> DataFrame:
    """The calls with one open predecessor, led to where their chain ends: ptr, c, w, end_n and end_c (of ptr). Chains that
    close on themselves have no end and are left out."""
    key = ["conv_id", "call_id"]
    ends = state.select("conv_id", F.col("call_id").alias("ptr"), F.col("n").alias("end_n"), F.col("c").alias("end_c"))
    chains = keep(state.filter("n = 1").drop("n").join(ends, ["conv_id", "ptr"]), "calls-chains")
    rows, left = chains.agg(F.count("*"), F.count_if(F.col("end_n") == 1)).first()
    for _ in range(rows.bit_length() + 1):
        if not left:
            break
        step = chains.select("conv_id", F.col("call_id").alias("ptr"), F.col("ptr").alias("next"), F.col("c").alias("next_c"),
                             F.col("w").alias("next_w"), F.col("end_n").alias("next_n"), F.col("end_c").alias("next_end_c"))
        moved = chains.filter("end_n = 1").join(step, ["conv_id", "ptr"]).select(
            *key, F.col("next").alias("ptr"), F.greatest(F.col("c"), F.col("next_c") + F.col("w")).alias("c"),
            (F.col("w") + F.col("next_w")).alias("w"), F.col("next_n").alias("end_n"), F.col("next_end_c").alias("end_c"))
        chains = keep(chains.filter("end_n <> 1").select(*moved.columns).unionByName(moved), "calls-chains")
        left = chains.filter("end_n = 1").count()
    return chains.filter("end_n <> 1")


def contracted(many: DataFrame, edges: DataFrame, found: DataFrame, late: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The calls with several open predecessors as nodes, and their links: those to calls with a level become a least level,
    those into a chain lead to its end. A call behind a cycle is left out."""
    key = ["conv_id", "call_id"]
    own = edges.join(many.select(*key), key, "left_semi")
    done = found.select("conv_id", F.col("call_id").alias("before"), F.lit(None).cast("string").alias("end"), "level", F.lit(0).alias("more"))
    led = late.select("conv_id", F.col("call_id").alias("before"), "end", F.col("c").alias("level"), F.col("w").alias("more"))
    same = many.select("conv_id", F.col("call_id").alias("before"), F.col("call_id").alias("end"), F.lit(0).alias("level"), F.lit(0).alias("more"))
    where = done.unionByName(led).unionByName(same).withColumn("met", F.lit(True))
    own = keep(own.join(where, ["conv_id", "before"], "left"), "calls-led")
    lost = own.filter("met is null").select(*key).distinct()
    own = own.join(lost, key, "left_anti")
    least = own.groupBy(*key).agg(F.max(F.col("level") + F.col("w")).alias("least"))
    nodes = many.select(*key, "c").join(least, key).select(*key, F.greatest("c", "least").alias("c"))
    links = own.filter("end is not null").groupBy(*key, F.col("end").alias("before")).agg(F.max(F.col("w") + F.col("more")).alias("w"))
    return keep(nodes, "calls-nodes"), keep(links, "calls-links")


def link(messages: DataFrame, schemas: Schemas) -> DataFrame:
    """A row for each call and each result without call: conv_id, turn, place, call_id, name, level, status, errors,
    result_turn, call_json (arguments, id, name and result as canonical JSON)."""
    key = ["conv_id", "call_id"]
    calls, results = (keep(x, "calls-parsed") for x in parse(messages))
    first = calls.groupBy(*key).agg(F.min(F.struct("turn", "place")).alias("first"))
    calls = keep(calls.join(first, key).withColumn(
        "repeats", F.struct("turn", "place") != F.col("first")).drop("first"), "calls-marked")
    own = calls.filter("not repeats").dropDuplicates(key)
    answers = results.groupBy(*key).agg(F.min(F.struct("turn", "content")).alias("answer"))
    ordered = own.join(levels(own), key, "left").join(answers.hint("shuffle_hash"), key, "full_outer")
    again = calls.filter("repeats").withColumn("level", F.lit(None).cast("int")).withColumn(
        "answer", F.lit(None).cast(ordered.schema["answer"].dataType))
    every = ordered.unionByName(again)
    status = F.when(F.col("repeats").isNull(), "orphan").when(F.col("repeats"), "repeated").when(
        F.col("answer").isNull(), "open").otherwise("linked")
    return every.select(
        "conv_id", F.coalesce("turn", "answer.turn").alias("turn"), "place", "call_id", "name", "level", status.alias("status"),
        F.when(status != "orphan", F.array_join(errors(F.col("name"), F.col("arguments"), schemas), ",")).alias("errors"),
        F.col("answer.turn").alias("result_turn"), call_json().alias("call_json"))


def call_json() -> Column:
    """Canonical JSON of a call; arguments that are no JSON stand as their text."""
    quoted = lambda c: F.expr(f"substr(to_json(struct({c} AS x)), 6, length(to_json(struct({c} AS x))) - 6)")
    field = lambda name, value: F.concat(F.lit(f'"{name}":'), value)
    return F.concat(F.lit("{"), F.concat_ws(
        ",", F.when(F.col("arguments").isNotNull(), field("arguments", F.coalesce(canonical(F.col("arguments")), quoted("arguments")))),
        field("id", quoted("call_id")), F.when(F.col("name").isNotNull(), field("name", quoted("name"))),
        F.when(F.col("answer.content").isNotNull(), field("result", quoted("answer.content")))), F.lit("}"))
