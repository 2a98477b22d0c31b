"""Chat formatting: multi-party perspective rotation.

Every participant of a dialogue gets a rendering in which that speaker is the assistant
and all others are users with their names.  System messages stay system messages.  The
mask of a rendering marks what is learned from: the assistant's words and the end mark
that follows them.

Built from DataFrame functions only.  A long dialogue is rendered in parts of a fixed
span of turn numbers, so that no task gathers a whole dialogue of any length; a part's
mask counts characters within the part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PART_TURNS = 256
SYSTEM = ("system",)
# Marks of the rendered format.
START, END, BREAK = "<|im_start|>", "<|im_end|>", "\n"


def _plain(text: Column) -> Column:
    """Marks inside a message lose their meaning; null is empty."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _name(speaker: Column) -> Column:
    """A speaker as it stands in a header: one line, without marks."""
    return F.regexp_replace(_plain(F.coalesce(speaker, F.lit("unknown"))), r"[\r\n]+", " ")


def rotate_perspectives(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    speaker_col: str = "role",
    text_col: str = "text",
    system: tuple[str, ...] = SYSTEM,
    part_turns: int = PART_TURNS,
) -> DataFrame:
    """(conv_id, perspective, part, n_messages, text, mask) for every participant.

    Participants are the distinct speakers but ``system`` and null.  A part holds the turns
    of one span of ``part_turns`` turn numbers; turns without a number come first, in part
    -1.  Turns of equal number stand in the order of speaker and text; repeated rows are
    repeated messages.  ``mask`` is an array of (start, end) character offsets in ``text``.
    A speaker of null is a user of the name unknown, a null text an empty message.  Rows
    without a conversation are in none; a dialogue without participants has no rendering.
    Further columns, whatever their names, are not looked at; an empty table gives none.
    """
    said = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(speaker_col).alias("speaker"), F.col(text_col).alias("said")
    ).filter("conv is not null")
    is_system = F.coalesce(F.col("speaker").isin(*system), F.lit(False))
    people = said.filter(F.col("speaker").isNotNull() & ~is_system).select("conv", F.col("speaker").alias("perspective")).distinct()

    own = F.coalesce(F.col("speaker") == F.col("perspective"), F.lit(False))
    head = (
        F.when(is_system, F.lit("system"))
        .when(own, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), _name(F.col("speaker"))))
    )
    rendered = said.join(people, "conv").select(
        "conv",
        "perspective",
        F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("long").alias("part"),
        "turn",
        "speaker",
        "said",
        own.alias("own"),
        F.concat(F.lit(START), head, F.lit(BREAK)).alias("head"),
        F.concat(_plain(F.col("said")), F.lit(END)).alias("body"),
    )
    order = W.partitionBy("conv", "perspective", "part").orderBy(
        F.col("turn").asc_nulls_first(), F.col("speaker").asc_nulls_first(), F.col("said").asc_nulls_first()
    )
    size = F.length("head") + F.length("body") + len(BREAK)
    start = F.sum(size).over(order.rowsBetween(W.unboundedPreceding, 0)) - size
    placed = rendered.select(
        "conv", "perspective", "part", "own", "head", "body", F.row_number().over(order).alias("no"), start.alias("start")
    )
    first = F.col("start") + F.length("head")
    span = F.when(F.col("own"), F.struct(first.alias("start"), (first + F.length("body")).alias("end")))
    segment = F.concat("head", "body", F.lit(BREAK))
    return placed.groupBy("conv", "perspective", "part").agg(
        F.count("*").alias("n_messages"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", segment.alias("s")))), lambda x: x["s"]), "").alias("text"),
        F.array_sort(F.collect_list(span)).alias("mask"),
    ).withColumnRenamed("conv", conv_col)


def oracle(part_turns: int = PART_TURNS) -> str:
    """The same rows in DuckDB's SQL, the mask as text."""
    plain = "replace(coalesce({}, ''), '<|', '< |')"
    return f"""
with people as (select distinct conv_id, role perspective from conversations where conv_id is not null and role is not null and role <> 'system'),
said as (
  select c.conv_id, perspective, coalesce(floor(turn / {part_turns}), -1)::bigint part, turn, role, text, coalesce(role = perspective, false) own,
    '<|im_start|>' || case when role = 'system' then 'system' when role = perspective then 'assistant'
      else 'user name=' || regexp_replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '[\\r\\n]+', ' ', 'g') end || chr(10) head,
    {plain.format("text")} || '<|im_end|>' body
  from conversations c join people p on c.conv_id = p.conv_id),
placed as (
  select *, row_number() over w no, sum(length(head) + length(body) + 1) over w - length(body) - 1 - length(head) start
  from said window w as (partition by conv_id, perspective, part order by turn nulls first, role nulls first, text nulls first rows unbounded preceding))
select conv_id, perspective, part, count(*) n_messages, string_agg(head || body || chr(10), '' order by no) text,
  coalesce(string_agg(case when own then (start + length(head))::bigint || '-' || (start + length(head) + length(body))::bigint end, ',' order by no), '') mask
from placed group by conv_id, perspective, part"""
