"""Chat formatting by multi-party perspective rotation, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURNS = 64  # turns that one row renders


def rotate_perspectives(conversations: DataFrame) -> DataFrame:
    """For each conversation (conv_id, turn, role, text) and each of its participants, the dialogue with that
    participant as assistant and all others as named users: conv_id, perspective, block, part, n_turns, rendered, mask, n_masked.

    A turn renders as `<|assistant|>` or `<|user name=ROLE|>`, a line end, its text and a line end. mask
    lists the character ranges from-to of the assistant's texts, comma-joined, for the training loss; n_masked
    is their total length. A row renders at most TURNS turns: block is turn div TURNS (null turns: block -1), part counts from
    0 where a block has more rows than that; rows in order of (block, part) give the whole dialogue, so a conversation of
    any length stays in bounded rows.

    Turns are in order of turn, role and text; repeated rows are repeated turns. A null role is the participant
    `unknown`, null text is empty. `<`, `|`, `>` and line ends in a role become `_`, and `<|` in a text becomes `< |`, so no text forges a
    turn. A null conv_id is one conversation. An empty table gives an empty result; further columns are ignored."""
    rows = conversations.select(
        "conv_id",
        "turn",
        F.translate(F.coalesce("role", F.lit("unknown")), "<|>\r\n", "_____").alias("role"),
        F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-1)).cast("long").alias("block"),
    )
    place = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    rows = rows.withColumn("n", F.row_number().over(place) - 1).withColumn("part", F.floor(F.col("n") / TURNS).cast("long"))
    parts = rows.groupBy("conv_id", "block", "part").agg(F.array_sort(F.collect_list(F.struct("n", "role", "text"))).alias("turns"))
    # roles per part first: a long conversation sends few rows to its list of participants
    people = parts.select("conv_id", F.explode(F.array_distinct(F.col("turns.role"))).alias("perspective")).distinct()
    both = parts.withColumnRenamed("conv_id", "c").join(people, F.col("c").eqNullSafe(F.col("conv_id")))
    head = "if(t.role = perspective, '<|assistant|>\\n', concat('<|user name=', t.role, '|>\\n'))"
    spans = f"""aggregate(turns, named_struct('at', 0, 'm', cast(array() as array<string>), 'k', 0L),
        (s, t) -> named_struct('at', s.at + length({head}) + length(t.text) + 1,
            'm', if(t.role = perspective, concat(s.m, array(concat(s.at + length({head}), '-', s.at + length({head}) + length(t.text)))), s.m),
            'k', s.k + if(t.role = perspective, length(t.text), 0)))"""
    both = both.withColumn("s", F.expr(spans))
    return both.select(
        "conv_id",
        "perspective",
        "block",
        "part",
        F.size("turns").cast("long").alias("n_turns"),
        F.expr(f"array_join(transform(turns, t -> concat({head}, t.text, '\\n')), '')").alias("rendered"),
        F.array_join("s.m", ",").alias("mask"),
        F.col("s.k").alias("n_masked"),
    )
