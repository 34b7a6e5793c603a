"""Preference formatting of chosen and rejected conversations, in DataFrame functions only.

The **prompt** of a pair is the longest run of turns, from the first on, that both conversations have; it is rendered
once. What follows is rendered twice, as the chosen and the rejected completion, each with the character spans that a
loss may be taken on: the assistant's turns with their end mark. Prompts have no such spans.

A rendered part is given in segments of ``SEGMENT`` turn numbers, in order of ``segment``; almost every part is one
row, and a conversation of any length never has to be gathered in one task. The common prefix is found without
gathering turns either: equal turns of both sides meet in one grouping on the whole turn, and a pair's first turn that
only one side has is a minimum.

Defined results: turns are ordered by number, then role, then text. Equal rows of a side count once. A NULL text or
role is empty, a NULL turn number stands before all others (segment -1 with negative numbers rounded down). Rows with a
NULL pair are left out, as nothing tells what they belong to. Equal conversations have a prompt only; a pair of which
one side is missing has no prompt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binledger.llm.registry import query, table

#: Turn numbers of a segment, and the role whose turns are learned.
SEGMENT, LEARNED = 64, "assistant"
_BEGIN, _END = "<|im_start|>", "<|im_end|>\n"


def rendered(message: Column) -> Column:
    return F.concat(F.lit(_BEGIN), message["role"], F.lit("\n"), message["text"], F.lit(_END))


def _spans(messages: Column, learned: str) -> Column:
    """'start-end' of the text and end mark of every learned turn, comma-joined; characters, the end not included."""
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("spans"))

    def step(held: Column, m: Column) -> Column:
        end = held["at"] + F.length(rendered(m))
        start = held["at"] + F.length(m["role"]) + len(_BEGIN) + 1
        span = F.concat(F.when(held["spans"] == "", "").otherwise(","), start.cast("string"), F.lit("-"), end.cast("string"))
        return F.struct(
            end.alias("at"), F.when(m["role"] == learned, F.concat(held["spans"], span)).otherwise(held["spans"]).alias("spans")
        )

    return F.aggregate(messages, empty, step, lambda held: held["spans"])


def preference_pairs(
    chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id", turn: str = "turn", role: str = "role",
    text: str = "text", learned: str = LEARNED, segment: int = SEGMENT,
) -> DataFrame:
    """(pair, part, segment, n_turns, text, loss_spans); part is prompt, chosen or rejected."""

    def side(df: DataFrame, is_chosen: bool) -> DataFrame:
        return df.where(F.col(pair).isNotNull()).select(
            F.col(pair).alias("pair"), F.coalesce(F.col(turn).cast("long"), F.lit(-1)).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
            F.lit(is_chosen).alias("c"), F.lit(not is_chosen).alias("r"),
        )

    turns = side(chosen, True).unionByName(side(rejected, False)).groupBy("pair", "turn", "role", "text").agg(
        F.bool_or("c").alias("c"), F.bool_or("r").alias("r")
    )
    here = F.struct("turn", "role", "text")
    apart = turns.where(~(F.col("c") & F.col("r"))).groupBy("pair").agg(F.min(here).alias("apart"))
    parted = turns.join(apart, "pair", "left").withColumn("common", F.coalesce(here < F.col("apart"), F.lit(True)))
    parts = F.when(F.col("common"), F.array(F.lit("prompt"))).otherwise(
        F.filter(F.array(F.when(F.col("c"), "chosen"), F.when(F.col("r"), "rejected")), lambda x: x.isNotNull())
    )
    rows = parted.select("pair", "turn", "role", "text", F.explode(parts).alias("part"))
    grouped = rows.groupBy("pair", "part", F.floor(F.col("turn") / segment).alias("segment")).agg(
        F.sort_array(F.collect_list(here)).alias("messages")
    )
    messages = F.col("messages")
    return grouped.select(
        F.col("pair").alias(pair), "part", "segment", F.size(messages).cast("long").alias("n_turns"),
        F.array_join(F.transform(messages, rendered), "").alias("text"),
        F.when(F.col("part") == "prompt", "").otherwise(_spans(messages, learned)).alias("loss_spans"),
    )


_ORACLE = f"""
with sides as (
  select distinct conv_id // 2 as pair_id, conv_id % 2 = 0 as is_chosen, coalesce(turn, -1) as turn,
         coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null
), turns as (
  select pair_id, turn, role, text, bool_or(is_chosen) as c, bool_or(not is_chosen) as r from sides group by all
), numbered as (
  select *, row_number() over (partition by pair_id order by turn, role, text) as k from turns
), marked as (
  select *, min(case when not (c and r) then k end) over (partition by pair_id) as first_apart from numbered
), parts as (
  select pair_id, turn, role, text, 'prompt' as part from marked where k < coalesce(first_apart, k + 1)
  union all select pair_id, turn, role, text, 'chosen' from marked where k >= first_apart and c
  union all select pair_id, turn, role, text, 'rejected' from marked where k >= first_apart and r
), shown as (
  select *, floor(turn / {SEGMENT}.0)::bigint as segment, '{_BEGIN}' || role || chr(10) || text || '<|im_end|>' || chr(10) as msg
  from parts
), placed as (
  select *, sum(length(msg)) over (partition by pair_id, part, segment order by turn, role, text) as stop from shown
)
select pair_id, part, segment, count(*) as n_turns, string_agg(msg, '' order by turn, role, text) as text,
       case when part = 'prompt' then '' else coalesce(string_agg(
         (stop - length(msg) + {len(_BEGIN) + 1} + length(role))::bigint::varchar || '-' || stop::bigint::varchar, ','
         order by turn, role, text) filter (role = '{LEARNED}'), '') end as loss_spans
from placed group by pair_id, part, segment
"""


@query("op10_preference_pairs", _ORACLE)
def op10(spark, folder: str) -> DataFrame:
    """The table states no preferences, so conversation 2k is taken as chosen over 2k + 1."""
    turns = table(spark, folder, "conversations").withColumn("pair_id", F.floor(F.col("conv_id") / 2))
    return preference_pairs(turns.where("conv_id % 2 = 0"), turns.where("conv_id % 2 != 0"))
