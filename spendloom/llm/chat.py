"""Chat formatting: records of many layouts become turns, and turns become training text that can be read back.

A record is a variant.  Its fingerprint is the hash of the nested field paths it has among those that any layout
declares.  A layout's print is the hash of the paths it needs, and the record's print for it the hash of those of them
that the record has.  Where both agree, the layout's declarative mapping (``LAYOUTS``) can be used: which path holds the
turns, or which fields are turns of which role.  Layouts take precedence in the order of ``LAYOUTS``, lists of turns
before single fields, so fields of further layouts don't matter.  A record with no layout's paths gets the layout
``unknown`` and no turns; ``unmapped()`` returns it.

A turn is written ``### role: text </turn>`` and a line end.  Inside texts and roles a backslash is doubled, two ``#``
never stand together, and ``</turn>`` is broken by a backslash, so control strings occur as controls only;
dropping the backslash before any character restores the text.

Expressions only.  A conversation is put together in two steps, by stretches of ``STRETCH`` turn numbers, then by
conversation.  Null texts and roles are empty.  Turns without a number come first; turns of one number are ordered by
role, then text, and repeated ones are kept.  Rows without a conversation id are one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRETCH = 256
LEARNED_ROLE = "assistant"

#: Layouts by name, in order of precedence: paths that a record must have, and its turns as SQL over ``payload``.
LIST_OF = "transform(try_variant_get(payload, '$.{0}', 'array<variant>'), e -> named_struct('role', {1}, 'text', try_variant_get(e, '$.{2}', 'string')))"
ONE = "named_struct('role', '{0}', 'text', try_variant_get(payload, '$.{1}', 'string'))"


def _field(role: str, path: str) -> str:
    return ONE.format(role, path)


def _optional(role: str, path: str) -> str:
    return f"if(try_variant_get(payload, '$.{path}', 'string') <> '', array({_field(role, path)}), array())"


_ROLE = "try_variant_get(e, '$.role', 'string')"
_SPEAKER = (
    "case lower(try_variant_get(e, '$.from', 'string')) when 'human' then 'user' when 'gpt' then 'assistant' "
    "else try_variant_get(e, '$.from', 'string') end"
)
_INSTRUCTION = (
    "array(named_struct('role', 'user', 'text', concat_ws('\\n\\n', try_variant_get(payload, '$.instruction', 'string'), "
    "nullif(try_variant_get(payload, '$.input', 'string'), ''))))"
)
_MESSAGES = LIST_OF.format("messages", _ROLE, "content")
_REPLY = (
    f"if(element_at({_MESSAGES}, -1).role <=> 'assistant', array(), array({ONE.format('assistant', 'response')}))"
)
LAYOUTS: dict[str, tuple[tuple[str, ...], str]] = {
    "turn row": (
        ("conv_id", "role", "text", "turn"),
        "array(named_struct('role', try_variant_get(payload, '$.role', 'string'), 'text', try_variant_get(payload, '$.text', 'string')))",
    ),
    # The reply to messages that don't end with one.
    "messages and response": (
        ("messages[].content", "messages[].role", "response"),
        f"concat({_optional('system', 'system')}, {_MESSAGES}, {_REPLY})",
    ),
    "messages": (
        ("messages[].content", "messages[].role"),
        f"concat({_optional('system', 'system')}, {_MESSAGES})",
    ),
    "speakers": (
        ("conversations[].from", "conversations[].value"),
        f"concat({_optional('system', 'system')}, {LIST_OF.format('conversations', _SPEAKER, 'value')})",
    ),
    "instruction": (
        ("instruction", "output"),
        f"concat({_optional('system', 'system')}, {_INSTRUCTION}, array({_field('assistant', 'output')}))",
    ),
    "completion": (
        ("completion", "prompt"),
        f"concat({_optional('system', 'system')}, array({_field('user', 'prompt')}, {_field('assistant', 'completion')}))",
    ),
    "response": (
        ("prompt", "response"),
        f"concat({_optional('system', 'system')}, array({_field('user', 'prompt')}, {_field('assistant', 'response')}))",
    ),
    "question": (
        ("answer", "question"),
        f"concat({_optional('system', 'system')}, array({_field('user', 'question')}, {_field('assistant', 'answer')}))",
    ),
}
PATHS = sorted({p for must, _ in LAYOUTS.values() for p in must})


def _has(path: str) -> str:
    """SQL: whether the payload has the path."""
    head, _, leaf = path.partition("[].")
    if not leaf:
        return f"try_variant_get(payload, '$.{path}', 'variant') is not null"
    return (
        f"coalesce(exists(try_variant_get(payload, '$.{head}', 'array<variant>'), "
        f"e -> try_variant_get(e, '$.{leaf}', 'variant') is not null), false)"
    )


def _hashed(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def _present() -> Column:
    """The known nested field paths that ``payload`` has."""
    found = ", ".join(f"if({_has(p)}, '{p}', null)" for p in PATHS)
    return F.expr(f"array_compact(array({found}))")


def _layout(present: Column) -> Column:
    """Name of the first layout whose print the record has."""
    name = F.lit("unknown")
    for layout, (must, _) in reversed(LAYOUTS.items()):
        needed = F.array(*[F.lit(p) for p in sorted(must)])
        name = F.when(_hashed(F.array_intersect(needed, present)) == _hashed(needed), layout).otherwise(name)
    return name


def layouts(records: DataFrame) -> DataFrame:
    """``records`` (record, payload) with the fingerprint and the layout it selects."""
    found = records.withColumn("_present", _present())
    return found.withColumns({"fingerprint": _hashed(F.col("_present")), "layout": _layout(F.col("_present"))}).drop("_present")


def unmapped(records: DataFrame) -> DataFrame:
    """Records that no layout maps, as rejects: ``record, fingerprint, payload`` as JSON text."""
    unknown = layouts(records.select("record", "payload")).filter(F.col("layout") == "unknown")
    return unknown.select("record", "fingerprint", F.to_json("payload").alias("payload"))


def turns(records: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of all records (record bigint, payload variant); rows of turns keep their own ids."""
    known = layouts(records.select("record", "payload"))
    mapped = F.expr("cast(array() as array<struct<role:string,text:string>>)")
    for layout, (_, sql) in LAYOUTS.items():
        mapped = F.when(F.col("layout") == layout, F.expr(sql)).otherwise(mapped)
    row = F.col("layout") == "turn row"
    spread = known.select("record", "payload", "layout", F.posexplode(mapped).alias("at", "t"))
    return spread.select(
        F.when(row, F.expr("try_variant_get(payload, '$.conv_id', 'bigint')")).otherwise(F.col("record")).alias("conv_id"),
        F.when(row, F.expr("try_variant_get(payload, '$.turn', 'bigint')")).otherwise(F.col("at").cast("bigint")).alias("turn"),
        F.coalesce("t.role", F.lit("")).alias("role"),
        F.coalesce("t.text", F.lit("")).alias("text"),
    )


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.regexp_replace(out, "#(?=#)", r"#\\")
    return F.replace(out, F.lit("</turn>"), F.lit("<\\/turn>"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(turn_rows: DataFrame) -> DataFrame:
    """One row for each conversation: ``conv_id, formatted, loss``.

    ``loss`` holds, for each turn to learn, its number, and where in the turn's own stretch its text starts and how long
    it is (code points, as written).
    """
    head = F.concat(F.lit("### "), F.replace(escaped(F.col("role")), F.lit(":"), F.lit("\\:")), F.lit(": "))
    body = escaped(F.col("text"))
    written = turn_rows.select(
        "conv_id",
        F.expr(f"turn div {STRETCH}").alias("stretch"),
        F.struct(
            "turn",
            "role",
            "text",
            F.concat(head, body, F.lit(" </turn>\n")).alias("line"),
            F.length(head).cast("bigint").alias("start"),
            F.when(F.col("role") == LEARNED_ROLE, F.length(body).cast("bigint")).otherwise(-1).alias("length"),
        ).alias("t"),
    )
    # Null turns sort first; within a stretch and between stretches.
    parts = (
        written.groupBy("conv_id", "stretch")
        .agg(F.array_sort(F.collect_list("t"), _by("turn", "role", "text")).alias("ts"))
        .select(
            "conv_id",
            F.struct(
                "stretch",
                F.array_join(F.transform("ts", lambda t: t["line"]), "").alias("lines"),
                F.transform("ts", lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("marks"),
            ).alias("p"),
        )
    )
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("p"), _by("stretch")).alias("ps"))
    marks = F.transform(
        F.flatten(F.transform("ps", lambda p: p["marks"])),
        lambda m, i: F.struct(i.alias("turn"), m["start"].alias("start"), m["length"].alias("length")),
    )
    return whole.select(
        "conv_id",
        F.array_join(F.transform("ps", lambda p: p["lines"]), "").alias("formatted"),
        F.filter(marks, lambda m: m["length"] >= 0).alias("loss"),
    )


def _by(*fields: str):
    """Comparison by these fields, nulls first."""

    def compare(x: Column, y: Column) -> Column:
        out = F.lit(0)
        for f in reversed(fields):
            a, b = x[f], y[f]
            here = (
                F.when(a.isNull() & b.isNull(), 0).when(a.isNull(), -1).when(b.isNull(), 1).when(a < b, -1).when(a > b, 1).otherwise(0)
            )
            out = F.when(here != 0, here).otherwise(out)
        return out

    return compare


def read_back(texts: DataFrame) -> DataFrame:
    """``conv_id, formatted, turns, learned``: role and text of each turn, and the texts under the loss mask."""
    lines = F.split("formatted", " </turn>\n", -1)
    lines = F.slice(lines, 1, F.size(lines) - 1)
    split = texts.select("conv_id", "formatted", "loss", lines.alias("lines"))
    pattern = r"(?s)^### ((?:[^:\\]|\\.)*+): (.*)$"
    return split.select(
        "conv_id",
        "formatted",
        F.transform(
            "lines",
            lambda s: F.struct(
                unescaped(F.regexp_extract(s, pattern, 1)).alias("role"),
                unescaped(F.regexp_extract(s, pattern, 2)).alias("text"),
            ),
        ).alias("turns"),
        F.transform(
            "loss",
            lambda m: unescaped(
                F.substring(F.element_at(F.col("lines"), m["turn"] + 1), (m["start"] + 1).cast("int"), m["length"].cast("int"))
            ),
        ).alias("learned"),
    )
