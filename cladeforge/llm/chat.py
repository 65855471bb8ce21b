"""Multi-party conversations rendered from every participant's side, with DataFrame joins alone.

Each participant becomes the assistant once: their turns are to be learned, the others' turns are users' who are named, and
system turns stay what they are. Output is one row per side and turn; read by turn, the segments of a side are the dialogue,
and the masks tell which characters count. A dialogue is never gathered into one row, so one may hold any number of turns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.llm.common import checkpointed

SYSTEM = "system"
BEGIN, END = "<|im_start|>", "<|im_end|>\n"


def rotate_perspectives(turns: DataFrame) -> DataFrame:
    """conv_id, perspective, turn, tie, role, name, segment, learn_from, learn_chars of each side and turn.

    role: assistant (the side's own turns), user (others', with name) or system. segment: the rendered turn. Characters
    learn_from to learn_from + learn_chars of it are to be learned: the side's own text and its end; 0 of others' (masks
    count characters; a tokenizer's offsets make them token masks).
    Markers in texts and names are broken up, and white space in names is one space, so neither can open or end a turn. Null
    roles are the participant `unknown`, null texts are empty, null conv_ids are one conversation. A conversation of system
    turns only has no side. Turns that share a number, and repeated turns, are all rendered: a dialogue goes by turn, then by
    tie (a digest of role and text). Other columns are left aside.
    """
    text = F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("speaker"), text.alias("text"))
    rows = rows.withColumn("tie", F.md5(F.concat("speaker", F.lit("\n"), "text")))
    # a table of its own: then both sides of the join come from shuffles, and a hot conversation is dealt to several tasks
    sides = checkpointed(rows.filter(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("side_of"), F.col("speaker").alias("perspective")).distinct())
    both = rows.join(sides, F.col("conv_id").eqNullSafe(F.col("side_of")))
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(own, "assistant").otherwise("user")
    name = F.when(role == "user", F.col("speaker")).otherwise("")
    shown = F.replace(F.trim(F.regexp_replace("speaker", "[\\x00-\\x20\\x7F]+", " ")), F.lit("<|"), F.lit("< |"))
    head = F.concat(F.lit(BEGIN), role, F.when(role == "user", F.concat(F.lit(" name="), shown)).otherwise(""), F.lit("\n"))
    return both.select(
        "conv_id",
        "perspective",
        "turn",
        "tie",
        role.alias("role"),
        name.alias("name"),
        F.concat(head, F.col("text"), F.lit(END)).alias("segment"),
        F.length(head).cast("long").alias("learn_from"),
        F.when(own, F.length("text") + len(END)).otherwise(0).cast("long").alias("learn_chars"),
    )


def dialogues(turns: DataFrame) -> DataFrame:
    """conv_id, perspective, rendered: whole dialogues, for conversations known to be of bounded length."""
    sorted_turns = F.array_sort(F.collect_list(F.struct("turn", "tie", "segment")))
    return rotate_perspectives(turns).groupBy("conv_id", "perspective").agg(F.array_join(F.transform(sorted_turns, lambda x: x["segment"]), "").alias("rendered"))


ORACLE = f"""
with t as (select conv_id, cast(turn as bigint) as turn, coalesce(role, 'unknown') as speaker, replace(coalesce(text, ''), '<|', '< |') as text from conversations),
s as (select distinct conv_id, speaker as perspective from t where speaker <> '{SYSTEM}'),
b as (select t.*, perspective, case when speaker = '{SYSTEM}' then '{SYSTEM}' when speaker = perspective then 'assistant' else 'user' end as role
      from t join s on t.conv_id is not distinct from s.conv_id),
h as (select *, '{BEGIN}' || role || case when role = 'user' then ' name=' || replace(trim(regexp_replace(speaker, '[\\x00-\\x20\\x7F]+', ' ', 'g'), ' '), '<|', '< |') else '' end || chr(10) as head from b)
select conv_id, perspective, turn, md5(speaker || chr(10) || text) as tie, role, case when role = 'user' then speaker else '' end as name,
       head || text || '{END.strip()}' || chr(10) as segment, cast(length(head) as bigint) as learn_from,
       cast(case when speaker = perspective then length(text) + {len(END)} else 0 end as bigint) as learn_chars
from h"""
