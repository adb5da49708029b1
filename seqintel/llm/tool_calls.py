"""Tool calls: linked with results, checked, ordered and written as canonical JSON.

Built-in functions only. Calls and results meet in a hash join on
(conversation, identifier), so a long conversation is spread over tasks.
Arguments become canonical JSON (sorted keys, plain numbers) by way of the
variant type and are checked against the tool's schema. A string argument
"$<id>" depends on the call with that identifier; levels are found by peeling:
each round settles the calls whose dependencies are settled, so there are as
many rounds as the longest chain is deep, each a join over what is left.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_same, stored, text_of


class Field(NamedTuple):
    kind: str  # string, integer, number or boolean
    required: bool = False
    low: float | None = None
    high: float | None = None
    one_of: tuple[str, ...] | None = None


Schema = Mapping[str, Field]
_TYPES = {"string": r"^STRING$", "integer": r"^(BIGINT|DECIMAL\([0-9]+,0\))$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
          "boolean": r"^BOOLEAN$"}


def canonical(arguments: Column) -> Column:
    """Canonical JSON of a JSON text; null if it is none."""
    return F.to_json(F.try_parse_json(arguments))


def json_string(text: Column) -> Column:
    """A text as a JSON string."""
    whole = F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("a")))
    return F.substring(whole, F.lit(6), F.char_length(whole) - 6)


def _field_errors(arguments: Column, name: str, field: Field) -> list[Column]:
    value = F.try_variant_get(F.try_parse_json(arguments), f"$.{name}", "variant")
    kind = F.schema_of_variant(value)
    absent = value.isNull() | (kind == "VOID")
    right = kind.rlike(_TYPES[field.kind])
    out = [F.when(~absent & ~right, f"type:{name}")]
    if field.required:
        out.append(F.when(absent, f"missing:{name}"))
    number = F.try_variant_get(F.try_parse_json(arguments), f"$.{name}", "double")
    if field.low is not None:
        out.append(F.when(right & (number < field.low), f"low:{name}"))
    if field.high is not None:
        out.append(F.when(right & (number > field.high), f"high:{name}"))
    if field.one_of is not None:
        text = F.try_variant_get(F.try_parse_json(arguments), f"$.{name}", "string")
        out.append(F.when(right & ~text.isin(*field.one_of), f"value:{name}"))
    return out


def errors(name: Column, arguments: Column, schemas: Mapping[str, Schema]) -> Column:
    """array<string> of what is wrong with a call, sorted; empty if nothing is."""
    none = F.array().cast("array<string>")
    found = F.array(F.lit("unknown tool"))
    for tool, schema in schemas.items():
        known = F.array(*map(F.lit, schema))
        extra = F.transform(F.array_except(F.map_keys(F.from_json(arguments, "map<string,string>")), known),
                            lambda k: F.concat(F.lit("extra:"), k))
        own = [c for field, rule in schema.items() for c in _field_errors(arguments, field, rule)]
        found = F.when(name == tool, F.concat(F.array_compact(F.array(*own)), F.coalesce(extra, none))).otherwise(found)
    object_ = F.schema_of_variant(F.try_parse_json(arguments)).startswith("OBJECT")
    return F.when(F.try_parse_json(arguments).isNull(), F.array(F.lit("no JSON"))).when(
        ~object_, F.array(F.lit("no object"))).otherwise(F.array_sort(found))


def levels(spark: SparkSession, calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls (conv_id, call_id, needs array<string>).

    Level 0 needs nothing; otherwise 1 + the highest level needed. Needs that
    name no call of the conversation are ignored here. Calls on or behind a
    cycle have a null level.
    """
    nodes = calls.select("conv_id", "call_id")
    edges = calls.select("conv_id", "call_id", F.explode(F.array_distinct("needs")).alias("need"))
    real = join_same(edges, nodes.withColumnRenamed("call_id", "need").distinct(), "conv_id", "need", how="left_semi")
    edges = stored(spark, real, "calls-edges")
    waiting = edges.select("conv_id", "call_id").distinct()
    done = [stored(spark, join_same(nodes, waiting, "conv_id", "call_id", how="left_anti").withColumn("level", F.lit(0)), "calls-level")]
    while True:
        left = stored(spark, join_same(edges, done[-1].select("conv_id", F.col("call_id").alias("need")), "conv_id", "need", how="left_anti"),
                      "calls-edges")
        now = join_same(edges.select("conv_id", "call_id").distinct(), left.select("conv_id", "call_id").distinct(),
                        "conv_id", "call_id", how="left_anti")
        now = stored(spark, now.withColumn("level", F.lit(len(done))), "calls-level")
        if now.isEmpty():
            break
        done.append(now)
        edges = left
    stuck = left.select("conv_id", "call_id").distinct().withColumn("level", F.lit(None).cast("int"))
    return reduce(DataFrame.unionByName, [*done, stuck])


def needed(arguments: Column) -> Column:
    """array<string>: what the string values ``$<id>`` of a canonical JSON text name, at any depth and in
    arrays too, unescaped. Keys are no values; a lone ``$`` names nothing; null has no needs."""
    found = F.regexp_extract_all(arguments, F.lit(r'[:\[,]"\$((?:[^"\\]++|\\.)++)"(?!:)'), F.lit(1))
    plain = F.transform(found, lambda g: F.when(~F.contains(g, F.lit("\\")), g).otherwise(
        F.get(F.from_json(F.concat(F.lit('["'), g, F.lit('"]')), "array<string>"), F.lit(0))))
    return F.coalesce(plain, F.array().cast("array<string>"))


def link(spark: SparkSession, messages: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """One row per call and one per result that answers no call or comes after the answer.

    messages: conv_id, turn, content, calls (array of id, name, arguments as
    JSON text), result_of (identifier, or null). Returns conv_id, call_id,
    turn, name, arguments (canonical JSON), errors, level, status, result_turn
    and record (the call as one canonical JSON object). A conversation's calls
    in topological order are its rows by (level, turn, place).

    status is ``linked``, ``no result``, ``repeated id`` (the earliest call with
    an identifier keeps it, later ones are not linked), ``orphan result`` or
    ``repeated result``. Of several results of one call the earliest is linked
    (a null turn comes last, the smaller text hash first on a tie), each further
    one is a row of its own, so every result is in the output once. Needs are
    the string values ``$<id>`` at any depth. A need that names no
    call is the error ``unresolved:<id>``; a call on or behind a cycle has the
    error ``cycle`` and no level. Null identifiers and null arguments count as
    empty texts; a null conv_id is a conversation of its own. An empty table
    gives an empty result; other columns are not read.
    """
    calls = messages.select("conv_id", "turn", F.posexplode("calls").alias("place", "call")).select(
        "conv_id", "turn", "place", F.coalesce("call.id", F.lit("")).alias("call_id"),
        F.coalesce("call.name", F.lit("")).alias("name"), F.coalesce("call.arguments", F.lit("")).alias("raw"))
    calls = calls.withColumn("arguments", canonical(F.col("raw"))).withColumn("errors", errors(F.col("name"), F.col("raw"), schemas))
    calls = calls.withColumn("needs", needed(F.col("arguments")))
    calls = stored(spark, calls.drop("raw"), "calls")
    # calls of one identifier meet in pre-aggregated form: the earliest keeps it
    first = calls.groupBy("conv_id", "call_id").agg(F.min_by("place", F.struct("turn", "place")).alias("first_place"), F.min("turn").alias("first_turn"))
    first = stored(spark, first, "calls-first")
    calls = join_same(calls, first, "conv_id", "call_id").withColumn(
        "own", F.col("turn").eqNullSafe(F.col("first_turn")) & (F.col("place") == F.col("first_place"))).drop("first_turn", "first_place")
    calls = stored(spark, calls, "calls-own")

    results = messages.filter("result_of IS NOT NULL").select("conv_id", F.col("result_of").alias("call_id"), F.col("turn").alias("result_turn"),
                                                              text_of("content").alias("result"))
    # the text of a result travels once; which one counts is settled on turns and hashes alone
    marked = results.withColumn("__h", F.xxhash64("result"))
    early = marked.groupBy("conv_id", "call_id").agg(F.min(F.struct(F.col("result_turn").isNull().alias("late"), "result_turn", "__h")).alias("e"))
    early = stored(spark, early.select("conv_id", "call_id", F.col("e.result_turn").alias("result_turn"), F.col("e.__h").alias("__h"),
                                       F.lit(True).alias("counts")), "calls-early")
    marked = join_same(marked, early, "conv_id", "call_id", "result_turn", "__h", how="left")
    answers = marked.filter("counts").groupBy("conv_id", "call_id", "result_turn").agg(
        F.min("result").alias("result"), F.count(F.lit(1)).alias("copies"))
    answers = stored(spark, answers, "calls-answers")
    # results after the one that counts, and further copies of it
    later = marked.filter("counts IS NULL").select("conv_id", "call_id", "result_turn", "result").unionByName(
        answers.filter("copies > 1").select("conv_id", "call_id", "result_turn", "result", F.explode(F.sequence(F.lit(2), "copies")).alias("__i")).drop("__i"))
    level = stored(spark, levels(spark, calls.filter("own").select("conv_id", "call_id", "needs")), "calls-levels")
    named = first.select("conv_id", F.col("call_id").alias("need"), F.lit(True).alias("known"))
    lost = join_same(calls.select("conv_id", "call_id", F.explode("needs").alias("need")).distinct(), named, "conv_id", "need", how="left_anti")
    lost = lost.groupBy("conv_id", "call_id").agg(F.collect_set(F.concat(F.lit("unresolved:"), "need")).alias("lost"))
    out = join_same(calls, level, "conv_id", "call_id", how="left")
    out = join_same(out, lost, "conv_id", "call_id", how="left")
    out = join_same(out, answers.drop("copies").withColumn("answered", F.lit(True)), "conv_id", "call_id", how="left")
    none = F.array().cast("array<string>")
    linked = F.col("own") & F.coalesce("answered", F.lit(False))
    out = out.withColumn("errors", F.array_sort(F.concat(
        "errors", F.coalesce("lost", none), F.when(F.col("level").isNull(), F.array(F.lit("cycle"))).otherwise(none)))).select(
        "conv_id", "call_id", "turn", "place", "name", "arguments", "errors", "level",
        F.when(~F.col("own"), "repeated id").when(linked, "linked").otherwise("no result").alias("status"),
        F.when(linked, F.col("result_turn")).alias("result_turn"), F.when(linked, F.col("result")).alias("result"))

    def alone(found: DataFrame, status: str) -> DataFrame:
        return found.select(
            "conv_id", "call_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("int").alias("place"), F.lit("").alias("name"),
            F.lit(None).cast("string").alias("arguments"), none.alias("errors"), F.lit(None).cast("int").alias("level"),
            F.lit(status).alias("status"), "result_turn", "result")

    known = first.select("conv_id", "call_id")
    orphan = alone(join_same(results, known, "conv_id", "call_id", how="left_anti"), "orphan result")
    repeated = alone(join_same(later, known, "conv_id", "call_id", how="left_semi"), "repeated result")
    return out.unionByName(orphan).unionByName(repeated).withColumn("record", record())


def record() -> Column:
    """The row as one JSON object with sorted keys."""
    def number(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("null"))

    def text(c):
        return F.when(F.col(c).isNull(), F.lit("null")).otherwise(json_string(F.col(c)))

    return F.concat(
        F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"errors":'), F.to_json("errors"),
        F.lit(',"id":'), text("call_id"), F.lit(',"level":'), number("level"), F.lit(',"name":'), text("name"),
        F.lit(',"result":'), text("result"), F.lit("}"))


#: Tools of the messages that ``from_conversations`` derives.
TOOLS: dict[str, Schema] = {
    "search": {"query": Field("string", True), "limit": Field("integer", True, 1, 20), "after": Field("string")},
    "count": {"text": Field("string", True), "unit": Field("string", True, one_of=("words", "characters")), "after": Field("string")},
    "define": {"term": Field("string", True), "after": Field("string")},
}


def from_conversations(turns: DataFrame) -> DataFrame:
    """Messages with tool calls, from plain conversations (conv_id, turn, role, text).

    Each user turn becomes a call whose tool and arguments follow from its
    text (some break the schema); half of them need the call two turns
    before, which may not exist. Each assistant turn is the result of the call of the
    turn before. Other turns call nothing.
    """
    text = text_of()
    size = F.char_length(text)
    ident = F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"))
    after = F.when(size % 2 == 0, F.concat(F.lit(',"after":"$'), ident, (F.col("turn") - 2).cast("string"), F.lit('"'))).otherwise("")
    first = F.regexp_extract(text, r"[^\x20\x09-\x0D]+", 0)
    name = F.when(size % 4 == 0, "search").when(size % 4 == 1, "count").when(size % 4 == 2, "define").otherwise("draw")
    arguments = (F.when(name == "search", F.concat(F.lit('{ "query": '), json_string(text), F.lit(', "limit": '), (size % 25).cast("string"), after, F.lit("}")))
                 .when(name == "count", F.concat(F.lit('{"unit":'), F.when(size % 3 == 0, F.lit('"lines"')).when(size % 3 == 1, F.lit('"words"')).otherwise(F.lit("7")),
                                                 F.lit(', "text": '), json_string(text), F.lit("}")))
                 .when(name == "define", F.concat(F.lit('{"term": '), json_string(first), F.when(size % 5 == 0, F.lit(', "loud": true')).otherwise(""), after, F.lit("}")))
                 .otherwise(F.lit("not json")))
    calls = F.when(F.col("role") == "user", F.array(F.struct(
        F.concat(ident, F.col("turn").cast("string")).alias("id"), name.alias("name"), arguments.alias("arguments"))))
    return turns.select("conv_id", "turn", text.alias("content"), calls.alias("calls"),
                        F.when(F.col("role") == "assistant", F.concat(ident, (F.col("turn") - 1).cast("string"))).alias("result_of"))
