"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns up to it are
formatted, and only its own text carries loss.  A conversation whose last turn
is not the assistant's ends with one more example that holds all its turns and
trains nothing, so the output always holds every turn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import blank


@dataclass(frozen=True)
class Template:
    """Control strings around a turn: open, role, middle, text, close.

    In roles and texts a backslash is doubled and every control string gets a
    backslash after its first character, so no control string is left in them;
    dropping each backslash and keeping what follows it restores the original.
    """

    opening: str = "<s>[INST] "
    middle: str = " [/INST] "
    closing: str = "</s>"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    trained: str = "assistant"

    def escape(self, text: Column) -> Column:
        out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        for control in self.controls:
            out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
        return out

    @staticmethod
    def unescape(text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def turn(self, role: Column, text: Column) -> Column:
        return F.concat(F.lit(self.opening), self.escape(role), F.lit(self.middle), self.escape(text), F.lit(self.closing))


TEMPLATE = Template()


def prefix_examples(
    turns: DataFrame,
    template: Template = TEMPLATE,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, example, n_turns, formatted, loss_start, loss_length) from one row per turn.

    `formatted` holds the first `n_turns` turns; the code points
    [loss_start, loss_start + loss_length) are the reply to learn, none when
    `loss_length` is null.  Null texts and roles count as empty; turns order by number
    (null first), then role and text, so ties and repeated rows keep a defined order and
    all stay; rows with a null conversation id form one conversation.  An empty
    table gives no rows.  The output of a conversation grows with the square of its
    turns, as prefixes do.
    """
    r, t = blank(role), blank(text)
    one = F.struct(
        F.col(turn).alias("turn"),
        r.alias("role"),
        t.alias("text"),
        template.turn(r, t).alias("shown"),
        F.char_length(template.escape(t)).alias("long"),
    )
    whole = turns.select(F.col(conv_id).alias("conv_id"), one.alias("one")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("one")).alias("all")
    )
    count = F.size("all")
    replies = F.filter(
        F.transform("all", lambda x, i: F.when((x["role"] == template.trained) | (i == count - 1), i + 1)), lambda n: n.isNotNull()
    )
    at = F.element_at("all", F.col("n_turns"))
    shown = F.array_join(F.transform(F.slice("all", 1, F.col("n_turns")), lambda x: x["shown"]), "")
    trains = at["role"] == template.trained
    return (
        whole.select("conv_id", "all", F.posexplode(replies).alias("example", "n_turns"))
        .select("conv_id", "example", "n_turns", shown.alias("formatted"), at["long"].alias("_long"), trains.alias("_trains"))
        .select(
            "conv_id",
            "example",
            "n_turns",
            "formatted",
            F.when(F.col("_trains"), F.char_length("formatted") - len(template.closing) - F.col("_long")).alias("loss_start"),
            F.when(F.col("_trains"), F.col("_long")).alias("loss_length"),
        )
    )


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """Array of (role, text) parsed from a formatted string."""
    pieces = F.split(formatted, template.closing.replace("/", "\\/"))
    marked = F.slice(pieces, 1, F.size(pieces) - 1)

    def parse(piece: Column) -> Column:
        body = F.substring(piece, len(template.opening) + 1, 2**31 - 1)
        cut = F.instr(body, template.middle)
        return F.struct(
            template.unescape(body.substr(F.lit(1), cut - 1)).alias("role"),
            template.unescape(body.substr(cut + len(template.middle), F.lit(2**31 - 1))).alias("text"),
        )

    return F.transform(marked, parse)


def loss_text(template: Template = TEMPLATE) -> Column:
    """The text under an example's loss mask, unescaped; null where nothing is trained."""
    span = F.col("formatted").substr(F.col("loss_start") + 1, F.col("loss_length"))
    return template.unescape(span)


def conversation_digests(examples: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Per conversation, what the examples hold when they are read back.

    The longest example gives the turns, every example its own reply.
    """
    last = F.max_by("formatted", "n_turns")
    replies = F.array_sort(F.collect_list(F.when(F.col("loss_length").isNotNull(), F.struct("example", loss_text(template).alias("reply")))))
    per = examples.groupBy("conv_id").agg(
        last.alias("formatted"), F.array_join(F.transform(replies, lambda x: x["reply"]), "").alias("loss"), F.count(F.lit(1)).alias("n_examples")
    )
    turns = per.withColumn("turns", read_turns(F.col("formatted"), template))
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
        "n_examples",
    )
