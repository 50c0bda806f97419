"""Chat formatting in budgeted windows, all as column expressions.

A turn is written as <|im_start|>role<|im_sep|>text<|im_end|>. Control strings
inside roles and texts are broken up by a backslash after their first
character, and backslashes are doubled, which `unescape` takes back.

Windows: prefix sums of the turns' tokens give the spans. A window holds the
leading system turn, then turns of the window before as history (as many whole
turns as fit `history` tokens), then new turns while the sum stays within
`budget`. Every turn is new in exactly one window; a turn that is larger than
the budget has a window without history, whole. Only assistant texts that are new in a window are
under its loss mask; repeated ones are masked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Control strings of common chat templates, ours first.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = r"([<\[])(?=\|im_start\|>|\|im_sep\|>|\|im_end\|>|s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(CONTROL), F.lit(r"$1\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def estimated_tokens(written: Column) -> Column:
    """A quarter of the UTF-8 bytes, rounded up."""
    return F.ceil(F.octet_length(written) / 4).cast("long")


def windows(turns: DataFrame, budget: int = 512, history: int = 128, tokens=estimated_tokens) -> DataFrame:
    """One row per window: conv_id, window, n_repeated, n_tokens, formatted, loss_spans.

    turns: conv_id, turn, role, text; further columns are not read. A null role
    or text is empty; a null conv_id is a conversation of its own. Turns are
    ordered by (turn, role, text), nulls first, and repeated rows are turns of their own.
    The first n_repeated turns of a window stand in an earlier window as well.
    loss_spans: start (code points, from 0) and length in `formatted`. The unit
    of work is a conversation, as its texts are.
    """
    if budget < 1 or history < 0:
        raise ValueError("budget must be 1 or more, history 0 or more")
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), escape(text).alias("body"))
    rows = rows.withColumn("head", F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP)))
    rows = rows.withColumn("written", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns(
        {
            "at": F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")) - 1,
            "upto": F.sum(tokens(F.col("written"))).over(order),
            "chars": F.sum(F.char_length("written")).over(order).cast("int"),
        }
    )
    turn = F.struct(
        "at", "upto", "chars", "written",
        (F.col("role") == "assistant").alias("learned"), (F.col("role") == "system").alias("system"),
        F.char_length("head").alias("head"), F.char_length("body").alias("length"),
    )
    held = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    held = held.withColumn("n_system", F.when(F.element_at("t", 1)["system"], 1).otherwise(0))
    held = held.withColumn("s_tokens", F.when(F.col("n_system") == 1, F.element_at("t", 1)["upto"]).otherwise(F.lit(0).cast("long")))
    held = held.withColumn("starts", F.expr(_STARTS.format(budget=int(budget), history=int(history))))
    cut = held.select("conv_id", "t", "n_system", F.posexplode("starts").alias("window", "s"), F.col("starts"))
    last = F.when(F.col("window") + 1 < F.size("starts"), F.element_at("starts", F.col("window") + 2)["first"]).otherwise(F.size("t"))
    cut = cut.select("conv_id", "t", "n_system", "window", F.col("s.first").alias("first"), F.col("s.back").alias("back"), last.alias("last"))
    cut = cut.withColumn(
        "used",
        F.expr("filter(t, x -> (x.at < n_system) or (x.at >= back and x.at < last))"),
    )
    # Code points before the turns from `back` on, less those of the window itself.
    cut = cut.withColumn("shift", F.expr("if(back > 0, t[back - 1].chars, 0) - if(n_system = 1, t[0].chars, 0)"))
    return cut.select(
        "conv_id",
        "window",
        F.when(F.col("window") == 0, 0).otherwise(F.col("n_system") + F.col("first") - F.col("back")).alias("n_repeated"),
        F.expr(
            "if(n_system = 1, t[0].upto, 0L) + if(last > back, t[last - 1].upto - if(back > 0, t[back - 1].upto, 0L), 0L)"
        ).alias("n_tokens"),
        F.expr("array_join(transform(used, x -> x.written), '')").alias("formatted"),
        F.expr(
            "transform(filter(used, x -> x.learned and x.at >= first),"
            " x -> struct(x.chars - length(x.written) + x.head - shift as start, x.length as length))"
        ).alias("loss_spans"),
    )


# A fold over the turns: `base` is the prefix sum where the window's turns begin.
_STARTS = """
aggregate(
  filter(t, x -> x.at >= n_system),
  named_struct(
    'starts', array(named_struct('first', n_system, 'back', n_system)), 'base', s_tokens
  ),
  (acc, x) -> if(
    x.at = n_system or s_tokens + x.upto - acc.base <= {budget}L,
    acc,
    transform(
      array(greatest(n_system, x.at - size(filter(t, y -> y.at >= n_system and y.at < x.at
        and t[x.at - 1].upto - if(y.at > 0, t[y.at - 1].upto, 0L)
          <= least({history}L, {budget}L - s_tokens - (x.upto - t[x.at - 1].upto)))))),
      b -> named_struct(
        'starts', concat(acc.starts, array(named_struct('first', x.at, 'back', b))),
        'base', if(b > 0, t[b - 1].upto, 0L)
      )
    )[0]
  ),
  acc -> acc.starts
)
"""


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and learned texts from the windows alone, one row per conversation.

    conv_id, turns (array of role and text, each once, in order), learned (the
    texts under the loss masks joined), formatted_chars.
    """
    piece = F.expr(f"slice(split(formatted, '{_quoted(END)}'), 1, size(split(formatted, '{_quoted(END)}')) - 1)")
    turn = F.transform(
        F.expr("slice(pieces, n_repeated + 1, greatest(size(pieces) - n_repeated, 0))"),
        lambda p: F.struct(
            unescape(F.substring_index(F.substring(p, len(START) + 1, 1 << 30), SEP, 1)).alias("role"),
            unescape(F.substring_index(p, SEP, -1)).alias("text"),
        ),
    )
    learned = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    per_window = formatted.withColumn("pieces", piece).select(
        "conv_id",
        F.struct("window", turn.alias("turns"), F.array_join(learned, "").alias("learned")).alias("w"),
        F.char_length("formatted").alias("chars"),
    )
    whole = per_window.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("w")).alias("w"), F.sum("chars").cast("long").alias("formatted_chars")
    )
    return whole.select(
        "conv_id",
        F.flatten(F.col("w.turns")).alias("turns"),
        F.array_join("w.learned", "").alias("learned"),
        "formatted_chars",
    )


def _quoted(marker: str) -> str:
    return marker.replace("|", r"\\|")
