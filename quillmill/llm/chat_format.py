r"""Chat formatting by a declarative template and a finite-state machine [native].

A template names the roles, which role may follow which, which roles carry loss, and
the strings that mark a turn. The turns of a conversation are folded through the
role machine with aggregate(); the output is a list of text segments with a loss
flag each, and their concatenation.

Texts are escaped reversibly, so that no text can hold a control string: `<`, any
number of `&`, `|` gets one more `&` (`<|` becomes `<&|`), which leaves no `<|` in
it. In roles, `&`, `<` and line feeds are written `&a`, `&l` and `&n`.

Defined cases: null texts and roles are empty; turns are ordered by turn (null
first), then role and text; a conversation with a null id is one more conversation;
an order of roles that the machine does not allow gives valid = false and is still
formatted; repeated rows are repeated turns; an empty table gives an empty table;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    start: str = "<|im_start|>"
    role_end: str = "\n"
    end: str = "<|im_end|>"
    between: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: role -> roles that may follow; "" stands before the first turn.
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    #: roles with which a conversation may end.
    finals: tuple[str, ...] = ("assistant", "user", "system")


CHATML = ChatTemplate()
_INVALID = "!"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(&*)\|", "<&$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<&(&*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("&"), F.lit("&a")), F.lit("<"), F.lit("&l")), F.lit("\n"), F.lit("&n"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("&n"), F.lit("\n")), F.lit("&l"), F.lit("<")), F.lit("&a"), F.lit("&"))


def _state_after(template: ChatTemplate, turns: Column) -> Column:
    """The role machine's last state; _INVALID is a state that nothing leaves."""
    moves = [f"{a}\n{b}" for a, after in template.follows.items() for b in after]
    allowed = F.array(*[F.lit(m) for m in moves])
    return F.aggregate(
        turns,
        F.lit(""),
        lambda state, t: F.when(F.array_contains(allowed, F.concat(state, F.lit("\n"), t["role"])), t["role"]).otherwise(F.lit(_INVALID)),
    )


def format_chats(rows: DataFrame, template: ChatTemplate = CHATML, conv_col: str = "conv_id") -> DataFrame:
    """conv_id, valid, segments (array of text, loss), formatted: a row a conversation."""
    turns = rows.groupBy(F.col(conv_col)).agg(
        F.array_sort(
            F.collect_list(
                F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            )
        ).alias("turns")
    )

    def segments(t: Column) -> Column:
        loss = t["role"].isin(*template.loss_roles)
        piece = lambda text, flag: F.struct(text.alias("text"), flag.alias("loss"))
        return F.array(
            piece(F.concat(F.lit(template.start), escape_role(t["role"]), F.lit(template.role_end)), F.lit(False)),
            piece(escape_text(t["text"]), loss),
            piece(F.lit(template.end + template.between), F.lit(False)),
        )

    return (
        turns.withColumn("state", _state_after(template, F.col("turns")))
        .withColumn("segments", F.flatten(F.transform("turns", segments)))
        .select(
            conv_col,
            F.col("state").isin(*template.finals).alias("valid"),
            "segments",
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        )
    )


def parse_chats(formatted: Column, template: ChatTemplate = CHATML) -> Column:
    """The turns (array of role, text) that a formatted string holds."""
    tail = template.end + template.between

    def turn(piece: Column) -> Column:
        at = F.instr(piece, template.role_end)
        return F.struct(
            unescape_role(F.substring(piece, F.lit(1), at - 1)).alias("role"),
            unescape_text(
                F.substring(piece, at + len(template.role_end), F.length(piece) - at - len(template.role_end) + 1 - len(tail))
            ).alias("text"),
        )

    quoted = "".join("\\" + c if not c.isalnum() and c not in "_ \n" else c for c in template.start)
    pieces = F.split(formatted, quoted, -1)
    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def loss_text(segments: Column) -> Column:
    """All unescaped text under the loss mask, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape_text(s["text"])), "")
