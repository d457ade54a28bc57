"""Chat formatting with a grammar round trip.

A template marks turns. Rendered text is parsed again by a deterministic parser and the recovered turns are
compared with the source; a turn that does not come back is rendered with its content escaped. Escaping puts
a backslash behind the first character of a control string (and behind the backslashes that already stand
there), so that no control string is left inside a text, and unescaping takes exactly one away.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import any_of, digest, text_or_empty


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around role and text of a turn; `foreign` are other control strings that no text may hold as they are.

    No control string may hold the first character of one behind its own first character: then none can
    arise where a text meets a mark.
    """

    opens: str = "<|im_start|>"
    body: str = "<|im_sep|>"
    closes: str = "<|im_end|>"
    after: str = "\n"
    foreign: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>")

    def __post_init__(self) -> None:
        heads = {c[0] for c in self.controls}
        for control in self.controls:
            if len(control) < 2 or heads & set(control[1:]) or "\\" in control:
                raise ValueError(f"control string {control!r} can't be escaped")
        if any(c in self.after for c in self.controls):
            raise ValueError("the text between turns holds a control string")

    @property
    def controls(self) -> list[str]:
        return list(dict.fromkeys((self.opens, self.body, self.closes, *self.foreign)))

    @property
    def heads(self) -> list[str]:
        return sorted({c[0] for c in self.controls})

    def _pattern(self, slash: str) -> str:
        parts = []
        for head in self.heads:
            tails = any_of([c[1:] for c in self.controls if c[0] == head])
            parts.append(rf"({any_of([head])}){slash}(\\*)({tails})")
        return "|".join(parts)

    def _groups(self, between: str) -> list[str]:
        n = range(len(self.heads))
        return [*(f"{3 * i + 1}" for i in n), between, *(f"{3 * i + 2}" for i in n), *(f"{3 * i + 3}" for i in n)]

    @property
    def escape_pattern(self) -> str:
        return self._pattern("")

    @property
    def unescape_pattern(self) -> str:
        return self._pattern(r"\\")

    def escape(self, text: Column) -> Column:
        to = "".join(g if g == r"\\" else f"${g}" for g in self._groups(r"\\"))
        return F.regexp_replace(text, self.escape_pattern, to)

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, self.unescape_pattern, "".join(f"${g}" for g in self._groups("") if g))

    def render(self, role: Column, text: Column) -> Column:
        return F.concat(F.lit(self.opens), role, F.lit(self.body), text, F.lit(self.closes + self.after))

    def parse(self, formatted: Column) -> Column:
        """Turns as array<struct<role, text>>, null where the text isn't a sequence of whole turns."""
        control = any_of(self.controls)
        pieces, marks = F.split(formatted, control, -1), F.regexp_extract_all(formatted, F.lit(control), F.lit(0))
        n = F.floor(F.size(marks) / 3).cast("int")
        turn = F.array(F.lit(self.opens), F.lit(self.body), F.lit(self.closes))
        gaps = F.concat(F.array(F.lit("")), F.array_repeat(F.lit(self.after), n))

        def every_third(k: int) -> Column:
            return F.filter(pieces, lambda _, i: i % 3 == k)

        whole = (marks == F.flatten(F.array_repeat(turn, n))) & (every_third(0) == gaps)
        turns = F.zip_with(
            every_third(1),
            every_third(2),
            lambda role, text: F.struct(self.unescape(role).alias("role"), self.unescape(text).alias("text")),
        )
        return F.when(whole, turns)


def format_conversations(
    turns: DataFrame,
    template: ChatTemplate = ChatTemplate(),
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learned_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: conv_id, formatted, n_escaped (turns), recovered (turns), round_trip, loss_runs.

    loss_runs is the loss mask over `formatted` in code points, three runs per turn: texts of `learned_role`
    are learned, as they stand there. A conversation is one string in the end, so its turns are gathered
    in one row; nothing else is. Rows come by turn (null first), ties by role and text, repeated rows all
    count. Null role or text: empty. Rows with null conv_id are one conversation. An empty table gives no
    rows. Other columns are ignored.
    """
    said = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"), text_or_empty(role).alias("role"), text_or_empty(text).alias("text")
        ).alias("said"),
    )
    source = F.array(F.struct(F.col("said.role").alias("role"), F.col("said.text").alias("text")))
    rounds = (
        template.render(F.col("said.role"), F.col("said.text")),
        template.render(template.escape(F.col("said.role")), template.escape(F.col("said.text"))),
    )
    comes_back = [F.coalesce(template.parse(r) == source, F.lit(False)) for r in rounds]
    said = said.withColumn("plain", comes_back[0]).withColumn(
        "rendered",
        F.when(F.col("plain"), rounds[0])
        .when(comes_back[1], rounds[1])
        .otherwise(F.raise_error(F.lit("a turn doesn't survive the round trip"))),
    ).withColumn(
        "chars", F.length(F.when(F.col("plain"), F.col("said.text")).otherwise(template.escape(F.col("said.text"))))
    )
    gathered = said.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(F.struct("said.turn", "said.role", "said.text", "rendered", "chars", (~F.col("plain")).alias("escaped")))
        ).alias("t")
    ).withColumn("formatted", F.array_join(F.col("t.rendered"), ""))
    parsed = gathered.withColumn("recovered", template.parse(F.col("formatted")))
    tail = len(template.closes) + len(template.after)
    runs = F.transform(
        F.col("t"),
        lambda x: F.struct(
            (F.length(x["rendered"]) - x["chars"] - tail).alias("skipped"),
            F.when(x["role"] == learned_role, x["chars"]).otherwise(0).alias("learned"),
            F.when(x["role"] == learned_role, F.lit(tail)).otherwise(x["chars"] + tail).alias("skipped_after"),
        ),
    )
    return parsed.select(
        "conv_id",
        "formatted",
        F.size(F.filter(F.col("t"), lambda x: x["escaped"])).cast("long").alias("n_escaped"),
        "recovered",
        (
            F.col("recovered")
            == F.transform(F.col("t"), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
        ).alias("round_trip"),
        runs.alias("loss_runs"),
    )


def format_digest(formatted: DataFrame, learned_role: str = "assistant") -> DataFrame:
    """The digest columns, all read back from the formatted text."""
    turns = F.col("recovered")
    all_text = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == learned_role), lambda t: t["text"]), "")
    return formatted.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        digest(all_text).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        digest(learned).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
    )
