"""Chat formatting: tool calls linked to their results, ordered, checked against schemas, as canonical JSON.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import drop_saved, ranked, save


CALL_COLUMNS, RESULT_COLUMNS = ("conv_id", "turn", "name", "arguments", "after"), ("conv_id", "turn", "content")


def _counted(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return rows.groupBy("call_id", *columns).agg(F.count(F.lit(1)).alias("copies"))


def _marked(each: DataFrame, columns: tuple[str, ...], name: str) -> DataFrame:
    """Distinct rows with `linked`: whether a row is the first by `columns` of those with its call_id.

    Only identifiers with several rows are joined; both sides are tables, so a hot one can be split.
    """
    each = save(each, name)
    first = F.min(F.struct(*columns)).alias("first")
    many = each.where("call_id is not null").groupBy("call_id").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
    marked = each.join(save(many.drop("n"), f"{name}-repeated"), "call_id", "left")
    first_one = F.col("first").isNull() | F.struct(*columns).eqNullSafe(F.col("first"))
    return marked.withColumn("linked", F.col("call_id").isNotNull() & first_one).drop("first")


def call_depths(calls: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(call_id, depth): how many calls come before a call along `after`; null for calls in or behind a cycle.

    Pointer doubling: each round a call's pointer jumps over its target's, so chains of any length take a logarithmic
    number of equi-joins. A pointer at no known call ends its chain. A round that settles nothing leaves cycles only.
    """
    ids = calls.select(F.col("call_id").alias("target"))
    state = (
        calls.select("call_id", "after")
        .join(ids, F.col("after") == F.col("target"), "left")
        .select("call_id", F.col("target").alias("up"), F.when(F.col("target").isNull(), 0).otherwise(1).cast("long").alias("depth"))
    )
    state = save(state, "depths")
    open_calls = state.where("up is not null").count()
    for _ in range(max_rounds):
        if not open_calls:
            break
        above = state.select(F.col("call_id").alias("mid"), F.col("up").alias("next"), F.col("depth").alias("more"))
        after = save(
            state.join(above, F.col("up") == F.col("mid"), "left").select(
                "call_id", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
            ),
            "depths",
        )
        drop_saved(state)
        state, before, open_calls = after, open_calls, after.where("up is not null").count()
        if open_calls == before:
            break
    return state.select("call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def _json_kind(value: Column) -> Column:
    """The JSON Schema type of a variant value."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.isNull(), F.lit("missing"))
        .when(kind == "STRING", F.lit("string"))
        .when(kind == "BIGINT", F.lit("integer"))
        .when(kind == "BOOLEAN", F.lit("boolean"))
        .when(kind == "VOID", F.lit("null"))
        .when(kind.startswith("ARRAY"), F.lit("array"))
        .when(kind.startswith("OBJECT"), F.lit("object"))
        .otherwise(F.lit("number"))
    )


def _at(name: str) -> str:
    """The variant path of a parameter, whatever dots or brackets its name holds."""
    if '"' in name and "'" in name:
        raise ValueError(f"no path to a name with both kinds of quotes: {name}")
    return f"$['{name}']" if '"' in name else f'$["{name}"]'


def _is_integral(name: str) -> Column:
    """Whether a number has no fraction: 1.0, 1e2 and integers beyond 64 bits are integers in JSON Schema."""
    exact = F.try_variant_get("args", _at(name), "string").rlike(r"^-?\d+(\.0*)?$")
    wide = F.try_variant_get("args", _at(name), "double")
    return F.coalesce(exact, F.lit(False)) | F.coalesce(wide == F.floor(wide), F.lit(False)) & F.schema_of_variant(F.try_variant_get("args", _at(name), "variant")).isin("DOUBLE", "FLOAT")


def checked_arguments(calls: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """Adds `args` (variant, null if the text is not a JSON object) and `errors` (array, empty if valid).

    schemas: {tool: {parameter: (JSON type, required)}}. A required parameter must be there and not null; a parameter
    that is there must have its type (an integer is also a number, a number without a fraction an integer; null stands
    for an optional one). Schemas have one level: what is inside objects and arrays is not checked. Unknown tools
    and arguments that are no object are errors; parameters that the schema does not know are ignored.
    """
    calls = calls.withColumn("args", F.try_parse_json("arguments"))
    calls = calls.withColumn("args", F.when(F.schema_of_variant("args").startswith("OBJECT"), F.col("args")))
    rules = []
    for tool, parameters in sorted(schemas.items()):
        for name, (kind, required) in sorted(parameters.items()):
            found = _json_kind(F.try_variant_get("args", _at(name), "variant"))
            absent = found.isin("missing", "null")
            fits = found.isin(kind, "integer") if kind == "number" else found == kind
            if kind == "integer":
                fits = fits | (found == "number") & _is_integral(name)
            wrong = F.when(absent, F.lit(f"{name}: required") if required else F.lit(None)).when(~fits, F.lit(f"{name}: not {kind}"))
            rules.append(F.when(F.col("name").eqNullSafe(tool), wrong))
    known = F.coalesce(F.col("name").isin(*schemas), F.lit(False)) if schemas else F.lit(False)
    errors = F.filter(F.array(F.lit(None).cast("string"), *rules), lambda e: e.isNotNull())
    return calls.withColumn(
        "errors",
        F.when(~known, F.array(F.lit("unknown tool")))
        .when(F.col("args").isNull(), F.array(F.lit("arguments: not an object")))
        .otherwise(errors),
    )


def _message(arguments: Column, call_id: Column, name: Column, result: Column) -> Column:
    """Keys in alphabetical order; a variant object writes its own keys sorted."""
    rest = F.to_json(F.struct(call_id.alias("id"), name.alias("name"), result.alias("result")), {"ignoreNullFields": "false"})
    return F.concat(F.lit('{"arguments":'), F.coalesce(arguments, F.lit("null")), F.lit(","), F.substr(rest, F.lit(2)))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """Rows call_id, conv_id, status, depth, valid, errors, calls, results, message; calls and results count the rows of
    the two tables that a row stands for, so their sums are the tables' rows.

    calls: (conv_id, turn, call_id, name, arguments JSON text, after: the call it needs, or null).
    results: (conv_id, turn, call_id, content). A call and its result meet by call_id in a hash join; of calls (or
    results) repeated with one identifier the first by (conv_id, turn, ...) is linked, so no identifier multiplies.

    status: "answered", "unanswered", or "orphan" for a result without a call; "repeated call" and "repeated result" for
    differing rows behind the first of their identifier; "unidentified" where call_id is null. Equal rows are one row.
    depth is the topological level: sorted by (conv_id, depth, call_id) every call follows the one that it needs; null in
    or behind a cycle, and for all that is not the linked call of an identifier. message is JSON with sorted keys and no
    white space. Null texts are carried as null. Extra columns are not read. Empty tables give an empty result.
    """
    return _linked(_counted(calls, CALL_COLUMNS), _counted(results, RESULT_COLUMNS), schemas)


def _linked(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """link_tool_calls() of distinct rows with `copies`."""
    called = _marked(calls, CALL_COLUMNS, "calls")
    answered = _marked(results, RESULT_COLUMNS, "results")
    none = F.lit(None).cast("string")
    zero = F.lit(0).cast("long")

    checked = checked_arguments(called, schemas).withColumn("json", F.to_json("args"))
    verdict = [(F.size("errors") == 0).alias("valid"), F.concat_ws("; ", "errors").alias("errors")]
    linked_calls = checked.where("linked").select("call_id", "conv_id", "name", "json", *verdict, "copies").join(call_depths(called.where("linked")), "call_id")
    answers = answered.where("linked").select("call_id", F.col("conv_id").alias("answer_conv"), "content", F.col("copies").alias("answer_copies"))
    both = linked_calls.join(answers, "call_id", "full")
    has_call, has_answer = F.col("copies").isNotNull(), F.col("answer_copies").isNotNull()
    linked = both.select(
        "call_id",
        F.coalesce("conv_id", "answer_conv").alias("conv_id"),
        F.when(~has_call, "orphan").when(has_answer, "answered").otherwise("unanswered").alias("status"),
        "depth",
        F.coalesce("valid", F.lit(False)).alias("valid"),
        F.coalesce("errors", F.lit("")).alias("errors"),
        F.coalesce("copies", zero).alias("calls"),
        F.coalesce("answer_copies", zero).alias("results"),
        _message(F.col("json"), F.col("call_id"), F.col("name"), F.col("content")).alias("message"),
    )
    alone = lambda kind: F.when(F.col("call_id").isNull(), "unidentified").otherwise(f"repeated {kind}").alias("status")
    depth = F.lit(None).cast("long").alias("depth")
    more_calls = checked.where("not linked").select(
        "call_id", "conv_id", alone("call"), depth, *verdict, F.col("copies").alias("calls"), zero.alias("results"), _message(F.col("json"), F.col("call_id"), F.col("name"), none).alias("message")
    )
    more_results = answered.where("not linked").select(
        "call_id", "conv_id", alone("result"), depth, F.lit(False).alias("valid"), F.lit("").alias("errors"), zero.alias("calls"), F.col("copies").alias("results"), _message(none, F.col("call_id"), none, F.col("content")).alias("message")
    )
    return linked.unionByName(more_calls).unionByName(more_results)


#: What conversation_calls() makes of plain chat turns.
REPLY_SCHEMAS = {"reply": {"after": ("string", False), "text": ("string", True), "turn": ("integer", False)}}

#: Turns of a conversation that one window holds.
CHUNK = 1024


def _numbered_turns(turns: DataFrame) -> DataFrame:
    """Distinct turns of known conversations with `copies`, their place `pos` and `asked`: the user turns up to them.

    Order: by turn (null first), then other roles, users, assistants, then by role and the text's SHA-256. Texts are not
    sorted. Running counts go by chunks of places.
    """
    digest = F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit(""))
    rank = F.when(F.col("role") == "user", 1).when(F.col("role") == "assistant", 2).otherwise(0)
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", digest.alias("digest"))
    rows = rows.groupBy("conv_id", "turn", "role", "digest").agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    rows = save(rows.withColumn("key", F.sha2(F.to_json(F.struct("conv_id", "turn", "role", "digest")).cast("binary"), 256)), "turns")
    placed = ranked(rows.select("conv_id", "turn", rank.alias("rank"), "role", "digest", "key"), ["conv_id"], ["turn", "rank", "role", "digest"], "turn-order")
    placed = save(placed.select("conv_id", "key", "rank", "pos", F.expr(f"pos div {CHUNK}").alias("chunk")), "turn-places")
    user = (F.col("rank") == 1).cast("long")
    chunks = placed.groupBy("conv_id", "chunk").agg(F.sum(user).alias("users"))
    chunks = chunks.select("conv_id", "chunk", (F.sum("users").over(Window.partitionBy("conv_id").orderBy("chunk")) - F.col("users")).alias("before"))
    within = F.sum(user).over(Window.partitionBy("conv_id", "chunk").orderBy("pos"))
    placed = placed.withColumn("within", within).join(chunks, ["conv_id", "chunk"]).select("key", "rank", "pos", (F.col("before") + F.col("within")).alias("asked"))
    return save(rows.join(placed, "key"), "turns-placed")


def conversation_calls(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """User and assistant turns of _numbered_turns() read as distinct calls and results with `copies`.

    The k-th user turn of a conversation calls the tool "reply" under the identifier "conv_id:k" with the arguments text,
    turn and after, the identifier of the user turn before it. An assistant turn carries the result of the last user turn
    before it, whatever the turns' numbers; one before all of them becomes an orphan under "conv_id:0".
    """
    ident = lambda k: F.concat_ws(":", F.col("conv_id").cast("string"), k.cast("string"))
    calls = placed.where("rank = 1").withColumn("after", F.when(F.col("asked") > 1, ident(F.col("asked") - 1)))
    calls = calls.select("conv_id", "turn", ident(F.col("asked")).alias("call_id"), F.lit("reply").alias("name"), F.to_json(F.struct("after", "text", "turn")).alias("arguments"), "after", "copies")
    results = placed.where("rank = 2").select("conv_id", F.col("pos").alias("turn"), ident(F.col("asked")).alias("call_id"), F.col("text").alias("content"), "copies")
    return calls, results


def conversation_messages(turns: DataFrame) -> DataFrame:
    """Plain chat turns (conv_id, turn, role, text) as messages: the rows of link_tool_calls() and `contexts`, a row for
    every distinct turn that is not linked into another's.

    calls, results and contexts add up to the rows of `turns`: equal rows (in these four columns) are counted. Differing
    texts at one turn are turns of their own, in a fixed order. An answer is the first assistant turn behind a user turn,
    further ones are "repeated result". Turns of other roles, and those of no conversation, are rows with the status
    "context" that hold content, id (conv_id:place, null without a conversation), role and turn. Extra columns are not read.
    """
    placed = _numbered_turns(turns)
    calls, results = conversation_calls(placed)
    linked = _linked(calls, results, REPLY_SCHEMAS).withColumn("contexts", F.lit(0).cast("long"))
    nowhere = turns.where("conv_id is null").select(F.lit(None).cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    nowhere = nowhere.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")).withColumn("pos", F.lit(None).cast("long"))
    other = placed.where("rank = 0").select("conv_id", "turn", "role", "text", "copies", "pos").unionByName(nowhere)
    ident = F.when(F.col("pos").isNotNull(), F.concat_ws(":", F.col("conv_id").cast("string"), F.lit("context"), F.col("pos").cast("string")))
    other = other.withColumn("id", ident)
    message = F.to_json(F.struct(F.col("text").alias("content"), "id", "role", "turn"), {"ignoreNullFields": "false"})
    zero = F.lit(0).cast("long")
    contexts = other.select(
        F.col("id").alias("call_id"), "conv_id", F.lit("context").alias("status"), F.lit(None).cast("long").alias("depth"), F.lit(True).alias("valid"), F.lit("").alias("errors"), zero.alias("calls"), zero.alias("results"), message.alias("message"), F.col("copies").alias("contexts")
    )
    return linked.unionByName(contexts)
