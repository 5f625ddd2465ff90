"""Tool-call linking in conversations, in DataFrame operations only.

1. Calls and results are joined on the conversation and the identifier of the call. Of calls with one identifier the
   first is the one that results belong to.
2. A result comes after its call, and otherwise messages keep their turns: the level of a call is its turn, that of a result
   the later of its own turn and the call's. Sorting by ``conv_id, level, call_id, step`` is a topological order, and
   no conversation has to be gathered for it.
3. Arguments are parsed and checked against the schema of their function, field by field.
4. Each message is written as canonical JSON: sorted keys, no white space.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillvec.llm.tables import Scratch


@dataclass(frozen=True)
class Field:
    """``kind`` is ``string``, ``number``, ``boolean``, ``array`` or ``object``."""

    kind: str
    required: bool = True
    longest: int | None = None


#: A turn of a person, or of the system, is a call for a reply.
TURN_SCHEMAS = {"user": {"text": Field("string")}, "system": {"text": Field("string")}}
KINDS = {"string": "STRING", "number": "(BIGINT|DECIMAL.*|DOUBLE|FLOAT)", "boolean": "BOOLEAN", "array": "ARRAY<.*",
         "object": "OBJECT<.*"}


def calls_and_results(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls (``conv_id, turn, call_id, name, arguments``) and results (``conv_id, turn, call_id, content``) of a table
    ``conv_id, turn, role, text``.

    A message whose text is a JSON object with ``tool_calls`` (a list of ``id``, ``name``, ``arguments``) gives those
    calls, and one with ``tool_call_id`` and ``content`` is a result. Any other message of an assistant or a tool is the
    result of the turn before it, and any other message a call by its role, with its text as argument, named by
    its turn. ``content`` beside ``tool_calls`` is such a message of its own, with that text; a list without calls and
    without content leaves the message as it is. So every message gives at least one row. A NULL role counts as
    ``user``.
    """
    json = F.try_parse_json("text")
    calls = F.try_variant_get(json, "$.tool_calls", "array<struct<id:string,name:string,arguments:variant>>")
    answered = F.try_variant_get(json, "$.tool_call_id", "string")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), "text", *[
        F.when(F.col("text").rlike("^[ \\t\\n\\r]*\\{"), x).alias(name) for x, name in (
            (calls, "listed"), (answered, "answered"), (F.try_variant_get(json, "$.content", "variant"), "content"),
            (F.try_variant_get(json, "$.content", "string"), "said"))])
    said = F.when(F.col("listed").isNotNull(), F.coalesce("said", F.to_json("content")))
    rows = rows.withColumns({"said": said, "calls": F.when(F.size("listed") > 0, F.col("listed"))}) \
        .withColumn("text", F.coalesce("said", "text"))
    reply = F.col("role").isin("assistant", "tool")
    plain = rows.filter("answered IS NULL AND (calls IS NULL OR said IS NOT NULL)")
    own = plain.filter(~reply).select(
        "conv_id", "turn", F.concat(F.lit("turn-"), F.col("turn").cast("string")).alias("call_id"),
        F.col("role").alias("name"), F.to_json(F.struct("text")).alias("arguments"))
    listed = rows.filter("calls IS NOT NULL").select("conv_id", "turn", F.explode("calls").alias("c")).select(
        "conv_id", "turn", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"),
        F.to_json("c.arguments").alias("arguments"))
    replies = plain.filter(reply).select(
        "conv_id", "turn", F.concat(F.lit("turn-"), (F.col("turn") - 1).cast("string")).alias("call_id"),
        F.to_json(F.struct("text")).alias("content"))
    given = rows.filter("answered IS NOT NULL").select(
        "conv_id", "turn", F.col("answered").alias("call_id"), F.to_json("content").alias("content"))
    return own.unionByName(listed), replies.unionByName(given)


def errors_of(arguments: Column, name: Column, schemas: dict[str, dict[str, Field]]) -> Column:
    """What is wrong with the JSON text ``arguments``, in the order of the schema; unknown fields come last."""
    parsed = F.try_parse_json(arguments)
    found = F.lit("unknown function")
    for function, fields in schemas.items():
        errors = []
        for field, rule in fields.items():
            kind = F.schema_of_variant(F.try_variant_get(parsed, f"$.{field}", "variant"))
            absent = kind.isNull() | (kind == "VOID")
            wrong = ~F.coalesce(kind.rlike(f"^{KINDS[rule.kind]}$"), F.lit(False))
            errors.append(F.when(absent, F.lit(f"missing {field}") if rule.required else F.lit(None)).when(
                wrong, F.lit(f"{field} is no {rule.kind}")))
            if rule.longest is not None:
                text = F.try_variant_get(parsed, f"$.{field}", "string")
                errors.append(F.when(F.length(text) > rule.longest, F.lit(f"{field} is too long")))
        unknown = F.array_sort(F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(f) for f in fields])))
        errors.append(F.when(F.size(unknown) > 0, F.concat(F.lit("unknown "), F.array_join(unknown, " "))))
        checked = F.when(parsed.isNull(), F.lit("no JSON")).otherwise(F.concat_ws("; ", *errors))
        found = F.when(name == function, checked).otherwise(found)
    return found


def canonical(json: Column) -> Column:
    """JSON text with sorted keys and no white space; other text as a JSON string, NULL as ``null``.

    The binary form that JSON is parsed into holds the keys of objects in order.
    """
    return F.coalesce(F.to_json(F.try_parse_json(json)), _quoted(json), F.lit("null"))


def _quoted(text: Column) -> Column:
    """A JSON string: what stands in an object with this text alone."""
    whole = F.to_json(F.struct(text.alias("x")))
    return F.when(text.isNotNull(), whole.substr(F.lit(6), F.length(whole) - 6))


def linked_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, Field]]) -> DataFrame:
    """A row for each call and each result, in no order; sorted by ``conv_id, level, call_id, step`` they are in
    topological order.

    ``kind`` is ``call`` or ``result``; ``step`` is 0 or 1. ``status`` of a call is ``invalid`` (see ``errors``),
    ``repeated`` (another call has its identifier and comes first, by turn, then name and arguments), ``answered`` or
    ``unanswered``; that of a result is ``linked`` or ``orphan``. ``json`` is the message in canonical form.

    Every row comes back; equal calls share their status. NULL conversations are one conversation, a NULL identifier
    links nothing, a NULL turn comes first, and NULL arguments are no JSON. Other columns are left out.
    """
    scratch = Scratch(calls.sparkSession, "chat")
    key = ["conv_id", "call_id"]
    firsts = scratch.keep(calls.filter("call_id IS NOT NULL").groupBy(*key).agg(
        F.min(F.struct("turn", "name", "arguments")).alias("first")), "firsts")
    answered = scratch.keep(results.filter("call_id IS NOT NULL").groupBy(*key).agg(F.count("*").alias("n_results")),
                            "answered")
    c, f, a = calls.alias("c"), firsts.alias("f"), answered.alias("a")
    same = F.col("f.first") == F.struct("c.turn", "c.name", "c.arguments")
    errors = errors_of(F.col("arguments"), F.col("name"), schemas)
    status = F.when(F.col("errors") != "", "invalid").when(~F.coalesce("is_first", F.lit(True)), "repeated") \
        .when(F.col("n_results") > 0, "answered").otherwise("unanswered")
    made = c.join(f, F.col("c.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("c.call_id") == F.col("f.call_id")),
                  "left") \
        .join(a, F.col("c.conv_id").eqNullSafe(F.col("a.conv_id")) & (F.col("c.call_id") == F.col("a.call_id")), "left") \
        .select("c.*", F.coalesce("a.n_results", F.lit(0)).alias("n_results"),
                (F.col("f.call_id").isNull() | F.coalesce(same, F.col("f.first").eqNullSafe(
                    F.struct("c.turn", "c.name", "c.arguments")))).alias("is_first")) \
        .withColumn("errors", F.coalesce(errors, F.lit("unknown function"))).withColumn("status", status)
    body = ['"arguments":', canonical(F.col("arguments")), ',"call_id":', _text(F.col("call_id")), ',"name":',
            _text(F.col("name")), ',"turn":', _number(F.col("turn")), ',"type":"call"}']
    call_rows = made.select("conv_id", "turn", "call_id", F.lit("call").alias("kind"), F.lit(0).alias("step"),
                            F.col("turn").alias("level"), "status", "errors", _object(F.col("conv_id"), body, 1).alias("json"))
    r = results.alias("r")
    body = ['"call_id":', _text(F.col("call_id")), ',"content":', canonical(F.col("content"))]
    tail = [',"turn":', _number(F.col("turn")), ',"type":"result"}']
    result_rows = r.join(f, F.col("r.conv_id").eqNullSafe(F.col("f.conv_id"))
                         & (F.col("r.call_id") == F.col("f.call_id")), "left").select(
        "r.*", F.greatest("r.turn", "f.first.turn").alias("level"),
        F.when(F.col("f.call_id").isNull(), "orphan").otherwise("linked").alias("status")) \
        .select("conv_id", "turn", "call_id", F.lit("result").alias("kind"), F.lit(1).alias("step"), "level", "status",
                F.lit("").alias("errors"), F.concat(F.lit("{"), *map(_part, body), F.lit(',"conv_id":'),
                                                    _number(F.col("conv_id")), *map(_part, tail)).alias("json"))
    return call_rows.unionByName(result_rows)


def _part(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _object(conv: Column, body: list, at: int) -> Column:
    """An object whose ``conv_id`` belongs behind ``call_id``."""
    head, rest = body[:4], body[4:]
    return F.concat(F.lit("{"), *map(_part, head), F.lit(',"conv_id":'), _number(conv), *map(_part, rest))


def _number(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit("null"))


def _text(x: Column) -> Column:
    return F.coalesce(_quoted(x), F.lit("null"))
