r"""Chat formatting with a grammar round trip, in DataFrame operations only.

Grammar of a formatted conversation (one line of header per turn, then the body)::

    conversation = turn*
    turn         = "### " role ":" level "\n" body "</turn>\n"
    level        = "0" | "1" | "2"

The parser cuts at ``</turn>\n``, reads role and level from the header line and refuses a body
that holds a bare control string (``### `` or ``</turn>``). A turn is rendered, reparsed and
compared with its source at rising levels of escaping until both are identical:

* level 0: verbatim;
* level 1: a backslash inside each control string (``##\# `` and ``<\/turn>``);
* level 2: as level 1 after each backslash of the text became ``\s``; this always reverses.

As a turn ends at its own first bare ``</turn>\n``, turns that reparse alone also reparse in a
row; ``verified`` states for each conversation that the whole output was reparsed and that every
recovered turn has the digest of its source.

Defined cases: null role or text counts as empty; turns are ordered by (turn, role, text), null
turns first; repeated rows stay repeated; rows with a null conv_id form one conversation; an
empty table gives an empty result; further columns are ignored. A conversation is one value of
the result, so its length is bounded by what a row can hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import text_of

HEAD, END = "### ", "</turn>"
HEAD_SAFE, END_SAFE = "##\\# ", "<\\/turn>"
ASSISTANT = "assistant"


def _swap(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def _safe_role(role: Column) -> Column:
    return _swap(_swap(role, "\\", "\\s"), "\n", "\\n")


def _role(safe: Column) -> Column:
    return _swap(_swap(safe, "\\n", "\n"), "\\s", "\\")


def _escape(text: Column, level: int) -> Column:
    if level == 0:
        return text
    base = _swap(text, "\\", "\\s") if level == 2 else text
    return _swap(_swap(base, HEAD, HEAD_SAFE), END, END_SAFE)


def _unescape(body: Column, level: Column) -> Column:
    plain = _swap(_swap(body, END_SAFE, END), HEAD_SAFE, HEAD)
    return F.when(level == "0", body).when(level == "1", plain).otherwise(_swap(plain, "\\s", "\\"))


def render(role: Column, text: Column, level: int) -> Column:
    """One turn as text at a level of escaping."""
    return F.concat(F.lit(HEAD), _safe_role(role), F.lit(f":{level}\n"), _escape(text, level), F.lit(END + "\n"))


def _segment(segment: Column) -> Column:
    head = F.substring_index(segment, "\n", 1)
    body = F.substr(segment, F.length(head) + 2)
    valid = head.rlike(r"(?s)^### .*:[012]$") & ~F.contains(body, F.lit(HEAD)) & ~F.contains(body, F.lit(END))
    role = _role(F.substr(head, F.lit(len(HEAD) + 1), F.length(head) - len(HEAD) - 2))
    return F.when(valid, F.struct(role.alias("role"), _unescape(body, F.right(head, F.lit(1))).alias("text")))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation; a malformed turn is null."""
    parts = F.split(formatted, END + "\n", -1)
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), _segment)


def turn_digest(role: Column, text: Column) -> Column:
    return F.sha2(F.concat(role, F.lit("\n"), text, F.lit("\n")), 256)


def render_at(role: Column, text: Column, level: Column) -> Column:
    """One turn as text at the level that a column states."""
    return F.when(level == 0, render(role, text, 0)).when(level == 1, render(role, text, 1)).otherwise(render(role, text, 2))


def lowest_level(role: Column, text: Column) -> Column:
    """The first level of escaping at which a turn reparses to its source."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))

    def identical(level: int) -> Column:
        return F.coalesce(parse(render(role, text, level)) == source, F.lit(False))

    return F.when(identical(0), 0).when(identical(1), 1).otherwise(2)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation.

    conv_id, formatted, turns (role and text as reparsed from formatted), layout (per turn: level,
    characters, where its body starts and how long it is inside the turn, and whether the body is
    under the loss mask), verified.
    """
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"))
    level = lowest_level(F.col("role"), F.col("text"))
    digest = turn_digest(F.col("role"), F.col("text"))
    made = rows.select("conv_id", F.struct("turn", "role", "text", level.alias("level"), digest.alias("digest")).alias("part"))
    grouped = made.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    rendered = grouped.select(
        "conv_id",
        F.transform(
            "parts",
            lambda p: F.struct(
                render_at(p["role"], p["text"], p["level"]).alias("rendered"),
                p["level"].alias("level"),
                (F.length(_safe_role(p["role"])) + len(HEAD) + 3).alias("body_start"),
                p["digest"].alias("digest"),
                (p["role"] == ASSISTANT).alias("loss"),
            ),
        ).alias("parts"),
    )
    joined = rendered.select("conv_id", "parts", F.array_join(F.transform("parts", lambda p: p["rendered"]), "").alias("formatted"))
    parsed = joined.select("conv_id", "parts", "formatted", parse(F.col("formatted")).alias("turns"))
    same = F.transform("turns", lambda t: turn_digest(t["role"], t["text"])) == F.transform("parts", lambda p: p["digest"])
    layout = F.transform(
        "parts",
        lambda p: F.struct(
            p["level"].alias("level"),
            F.length(p["rendered"]).alias("chars"),
            p["body_start"].alias("body_start"),
            (F.length(p["rendered"]) - p["body_start"] - len(END) - 1).alias("body_chars"),
            p["loss"].alias("loss"),
        ),
    )
    return parsed.select("conv_id", "formatted", "turns", layout.alias("layout"), F.coalesce(same, F.lit(False)).alias("verified"))


def under_loss(formatted: Column, layout: Column) -> Column:
    """The text under the loss mask, unescaped: the masked range of each turn of the formatted text, in order, nothing between."""
    turns = F.zip_with(
        F.split(formatted, END + "\n", -1),
        layout,
        lambda turn, at: F.when(at["loss"], _unescape(F.substr(turn, at["body_start"] + 1, at["body_chars"]), at["level"].cast("string"))).otherwise(""),
    )
    return F.array_join(turns, "")


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what the formatted conversations say when read back; the loss digest reads the text under the mask."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = under_loss(F.col("formatted"), F.col("layout"))
    return formatted.select("conv_id", "formatted", "turns", "verified", said.alias("said"), masked.alias("masked")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "verified",
    )
