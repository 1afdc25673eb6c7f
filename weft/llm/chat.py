"""Perspective rotation of multi-party dialogues into chat-format training texts with loss masks.

A dialogue of n speakers gives n renderings: in each, one speaker's turns are the assistant's and the others are users
with their names. A turn is rendered as ``<|role|>`` or ``<|role|>name`` on a line, its text, and ``<|end|>``. The mask
covers the text and end mark of assistant turns; it is given as character ranges, from and to (exclusive).

Renderings come in parts of at most ``part_turns`` turn numbers, so no row and no task holds a dialogue of unbounded
length; parts follow each other by ``part``, and their texts joined are the whole rendering.

Defined results: rows that repeat conversation, turn, speaker and text count once; different rows of one turn are
ordered by speaker, then text; null texts are empty; null turn numbers come first, in part -1; a null or blank speaker
is ``unknown``; rows without a conversation are left out; marks inside a text are defused by a space after ``<``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rotated(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text", part_turns: int = 64) -> DataFrame:
    """``(conv_id, assistant, part, n_turns, n_assistant_turns, text, mask)``, mask an array of ``(first, last)``."""
    name = F.coalesce(F.nullif(F.trim(F.col(speaker).cast("string")), F.lit("")), F.lit("unknown"))
    rows = turns.filter(F.col(conversation).isNotNull()).select(
        F.col(conversation).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        name.alias("speaker"),
        F.replace(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("said"),
    )
    rows = rows.distinct().withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)))
    cast = rows.select("conv_id", F.col("speaker").alias("assistant")).distinct()
    own = F.col("speaker") == F.col("assistant")
    head = F.when(own, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user|>"), "speaker", F.lit("\n")))
    cells = rows.join(cast, "conv_id").groupBy("conv_id", "assistant", "part")
    in_order = F.sort_array(F.collect_list(F.struct("turn", "speaker", "said", own.alias("own"), head.alias("head"))))
    lists = cells.agg(in_order.alias("r"))
    step = lambda x: F.length(x["head"]) + F.length(x["said"]) + 8
    empty = F.from_json(F.lit('{"at":0,"mask":[]}'), "at int, mask array<struct<first:int,last:int>>")

    def add(state, x):
        span = F.struct((state["at"] + F.length(x["head"])).alias("first"), (state["at"] + step(x)).alias("last"))
        return F.struct((state["at"] + step(x)).alias("at"), F.when(x["own"], F.concat(state["mask"], F.array(span))).otherwise(state["mask"]).alias("mask"))

    return lists.select(
        "conv_id",
        "assistant",
        "part",
        F.size("r").cast("long").alias("n_turns"),
        F.size(F.filter("r", lambda x: x["own"])).cast("long").alias("n_assistant_turns"),
        F.array_join(F.transform("r", lambda x: F.concat(x["head"], x["said"], F.lit("<|end|>\n"))), "").alias("text"),
        F.aggregate("r", empty, add, lambda s: s["mask"]).alias("mask"),
    )


def digest(parts: DataFrame) -> DataFrame:
    """Renderings with their text as a hash and their mask as text."""
    mask = F.array_join(F.transform("mask", lambda m: F.concat_ws("-", m["first"].cast("string"), m["last"].cast("string"))), ",")
    return parts.select("conv_id", "assistant", "part", "n_turns", "n_assistant_turns", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), mask.alias("mask"))


ORACLE_SQL = """
with r as (
  select distinct conv_id, turn::bigint as turn, coalesce(nullif(trim(role), ''), 'unknown') as speaker,
    replace(coalesce(text, ''), '<|', '< |') as said
  from conversations where conv_id is not null
), c as (select distinct conv_id, speaker as assistant from r),
m as (
  select r.*, c.assistant, coalesce(floor(turn / 64)::bigint, -1) as part, r.speaker = c.assistant as own,
    case when r.speaker = c.assistant then '<|assistant|>' || chr(10) else '<|user|>' || r.speaker || chr(10) end as head
  from r join c using (conv_id)
), w as (
  select *, row_number() over p as k, coalesce(sum(length(head) + length(said) + 8) over (p rows between unbounded preceding and 1 preceding), 0) as pos
  from m window p as (partition by conv_id, assistant, part order by turn nulls first, speaker, said)
)
select conv_id, assistant, part, count(*) as n_turns, count(*) filter (own) as n_assistant_turns,
  sum(length(head) + length(said) + 8)::bigint as n_chars,
  sha256(string_agg(head || said || '<|end|>' || chr(10), '' order by k)) as text_sha256,
  coalesce(string_agg(((pos + length(head))::bigint)::varchar || '-' || ((pos + length(head) + length(said) + 8)::bigint)::varchar, ',' order by k) filter (own), '') as mask
from w group by conv_id, assistant, part"""
