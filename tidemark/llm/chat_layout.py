"""Chat formatting by schema fingerprint.

Conversations arrive in many layouts: prompt and completion, instruction and output, message
lists under various names, or one row for each message. A record is a variant value. Its nested
field paths (names and nesting, without the types of the leaves) are hashed; the hash selects a
declared mapping that turns the record into canonical turns (role, text). Records whose
fingerprint no mapping declares come back with null turns and their fingerprint, so that a mapping
can be added.

Format: each turn is ``<|turn|>role<|text|>text<|end|>``. Control strings of this and other
common templates inside roles and texts get a word joiner (U+2060) after their first character;
joiners already in that place are kept and one is added, so that the change can be undone exactly.
The loss mask holds the place of each escaped assistant text in its turn, in code points.

Defined results: null role or text: empty. Turns are ordered by turn, ties by role and text; a
null turn comes first. Repeated rows are repeated turns. A null conversation id is a conversation
of its own. No rows give no conversations. A conversation is one output row by its nature, so one
very long conversation is assembled in one task; everything before is done row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh

JOINER = "⁠"
# Fixed control strings after their first character, as a pattern.
_TAILS = r"(\||/?s>|/?INST\]|/?<?/?SYS>>)"
_ESCAPE = rf"([<\[])({JOINER}*){_TAILS}"
_UNESCAPE = rf"([<\[]){JOINER}({JOINER}*){_TAILS}"

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
TURNS = "array<struct<role: string, text: string>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, f"$1{JOINER}$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


def field_paths(record: Column) -> Column:
    """Names and nesting of a variant's fields in sorted order, without leaf types."""
    leaf = r": (?:STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|VOID|DATE|TIMESTAMP(?:_NTZ)?|BINARY|UUID|VARIANT|DECIMAL\([0-9,]+\))(?=[,>])"
    return F.regexp_replace(F.schema_of_variant(record), leaf, "")


def fingerprint(paths: Column) -> Column:
    return F.lower(F.hex(F.xxhash64(paths)))


@dataclass(frozen=True)
class Mapping:
    """``paths`` as ``field_paths`` writes them; ``turns`` builds TURNS from the record."""

    name: str
    paths: str
    turns: Callable[[Column], Column]


def _get(record: Column, path: str) -> Column:
    return F.variant_get(record, path, "string")


def _pair(*parts: tuple[str, str]) -> Callable[[Column], Column]:
    """Turns from single fields: (role, path) in order; absent or null fields give no turn."""

    def build(record: Column) -> Column:
        turns = F.array(*(F.struct(F.lit(role).alias("role"), _get(record, path).alias("text")) for role, path in parts))
        return F.filter(turns, lambda t: t["text"].isNotNull())

    return build


def _list(path: str, role: str, text: str, roles: dict[str, str] | None = None) -> Callable[[Column], Column]:
    """Turns from a list of messages; ``roles`` renames roles of another convention."""

    def build(record: Column) -> Column:
        items = F.variant_get(record, path, f"array<struct<{role}: string, {text}: string>>")

        def named(m: Column) -> Column:
            said = m[role]
            for old, new in (roles or {}).items():
                said = F.when(m[role] == old, F.lit(new)).otherwise(said)
            return F.struct(said.alias("role"), m[text].alias("text"))

        return F.transform(items, named)

    return build


def _message(role: str, text: str) -> Callable[[Column], Column]:
    return lambda r: F.array(F.struct(_get(r, role).alias("role"), _get(r, text).alias("text")))


_SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant"}
MAPPINGS: tuple[Mapping, ...] = (
    Mapping("message row", "OBJECT<role, text, turn>", _message("$.role", "$.text")),
    Mapping("content row", "OBJECT<content, role>", _message("$.role", "$.content")),
    Mapping("prompt", "OBJECT<completion, prompt>", _pair(("user", "$.prompt"), ("assistant", "$.completion"))),
    Mapping("prompt response", "OBJECT<prompt, response>", _pair(("user", "$.prompt"), ("assistant", "$.response"))),
    Mapping("instruction", "OBJECT<instruction, output>",
            _pair(("user", "$.instruction"), ("assistant", "$.output"))),
    Mapping("instruction input", "OBJECT<input, instruction, output>",
            lambda r: F.array(
                F.struct(F.lit("user").alias("role"),
                         F.concat_ws("\n", _get(r, "$.instruction"), F.nullif(_get(r, "$.input"), F.lit(""))).alias("text")),
                F.struct(F.lit("assistant").alias("role"), _get(r, "$.output").alias("text")))),
    Mapping("question", "OBJECT<answer, question>", _pair(("user", "$.question"), ("assistant", "$.answer"))),
    Mapping("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", _list("$.messages", "role", "content")),
    Mapping("system messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>, system>",
            lambda r: F.concat(_pair(("system", "$.system"))(r), _list("$.messages", "role", "content")(r))),
    Mapping("conversations", "OBJECT<conversations: ARRAY<OBJECT<from, value>>>",
            _list("$.conversations", "from", "value", _SPEAKERS)),
)


def canonical_turns(
    df: DataFrame, record: Column, out: str = "turns", mappings: Sequence[Mapping] = MAPPINGS,
) -> DataFrame:
    """``df`` with ``fingerprint`` and ``out`` (TURNS; null where no mapping is declared).

    The few declared fingerprints are computed once per plan as constants.
    """
    held = fresh(df, "record")
    df = df.withColumn(held, record).withColumn("fingerprint", fingerprint(field_paths(F.col(held))))
    turns = F.lit(None).cast(TURNS)
    for m in mappings:
        built = F.transform(m.turns(F.col(held)), lambda t: F.struct(
            F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
        turns = F.when(F.col("fingerprint") == fingerprint(F.lit(m.paths)), built).otherwise(turns)
    return df.withColumn(out, turns).drop(held)


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Rows (conv, turn, role, text) to (conv, formatted, loss): the text and its loss mask.

    ``loss`` has one entry for each turn in order: (start, length) of the learned code points,
    counted from the turn's own mark, so that a mask is applied turn by turn in linear time.
    """
    said = F.coalesce("role", F.lit(""))
    rows = turns.select(
        F.col(conv),
        F.struct(
            F.col(turn).alias("turn"), said.alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        ).alias("p"))
    grouped = rows.groupBy(conv).agg(F.array_sort(F.collect_list("p")).alias("ps"))
    head = lambda p: F.concat(F.lit(TURN), escape(p["role"]), F.lit(TEXT))
    return grouped.select(
        conv,
        F.array_join(F.transform("ps", lambda p: F.concat(head(p), escape(p["text"]), F.lit(END))), "").alias("formatted"),
        F.transform("ps", lambda p: F.struct(
            F.length(head(p)).cast("long").alias("start"),
            F.when(p["role"] == "assistant", F.length(escape(p["text"]))).otherwise(0).cast("long").alias("length"),
        )).alias("loss"),
    )


def read_conversations(formatted: DataFrame, text: str = "formatted", mask: str = "loss") -> DataFrame:
    """Adds what the formatted text says: ``turns`` (TURNS) and ``loss_text`` (unescaped)."""
    marked = F.split(F.col(text), r"<\|turn\|>", -1)
    # Before the first mark stands nothing; every other piece is role, text mark, text, end mark.
    held = fresh(formatted, "pieces")
    df = formatted.withColumn(held, F.slice(marked, 2, F.size(marked)))
    cut = lambda x: F.split(F.substring(x, 1, F.length(x) - len(END)), r"<\|text\|>", 2)
    df = df.withColumn("turns", F.transform(F.transform(held, cut), lambda p: F.struct(
        unescape(p[0]).alias("role"), unescape(p[1]).alias("text"))))
    learned = F.transform(
        F.arrays_zip(F.col(held).alias("p"), F.col(mask).alias("m")),
        lambda z: F.when(z["m"]["length"] > 0, F.substring(
            F.concat(F.lit(TURN), z["p"]), z["m"]["start"].cast("int") + 1, z["m"]["length"].cast("int"))).otherwise(""))
    return df.withColumn("loss_text", F.array_join(F.transform(learned, unescape), "")).drop(held)
