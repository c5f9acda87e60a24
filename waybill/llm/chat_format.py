"""Chat formatting with cumulative-snapshot collapse.

Logs often hold a conversation many times: after every turn, the whole of it so far. A
rolling hash names every prefix of turns; a conversation whose whole name is a proper
prefix of another is a snapshot, and an anti-join drops it. What is left is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.session import materialised

#: The rendered form of a turn; text inside is kept as it is.
TURN = ("<|im_start|>", "\n", "<|im_end|>\n")


def snapshots(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, alone, turns, names): turns in order, and the name of every prefix.

    A name is the SHA-256 of the previous name, the role and the turn's own SHA-256, so
    no two turn lists share one. Repeated rows of a turn count once.
    """
    part = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = turns.select(F.col(conv_col).alias("conv_id"), part.alias("p"))
    # A row without an id is on its own, so that no group but a conversation is ever gathered.
    alone = F.when(F.col("conv_id").isNull(), F.sha2(F.to_json("p"), 256)).alias("alone")
    convs = rows.groupBy("conv_id", alone).agg(F.sort_array(F.collect_set("p")).alias("turns"))

    def step(acc: Column, p: Column) -> Column:
        link = F.concat_ws(":", F.coalesce(F.element_at(acc, -1), F.lit("")), F.sha2(p["role"], 256), F.sha2(p["text"], 256))
        return F.concat(acc, F.array(F.sha2(link, 256)))

    # element_at fails on an empty array, so the chain starts from one empty name.
    names = F.aggregate("turns", F.array(F.lit("")), step)
    return convs.select("conv_id", "alone", "turns", F.slice(names, F.lit(2), F.size("turns")).alias("names"))


def rendered(turns: Column) -> Column:
    before, middle, after = TURN
    one = lambda p: F.concat(F.lit(before), p["role"], F.lit(middle), p["text"], F.lit(after))
    return F.array_join(F.transform(turns, one), "")


def chat_format(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, n_turns, n_copies, text: one row per maximal conversation.

    Of equal conversations the smallest id stays and n_copies counts all of them. Turns
    are ordered by number, then role and text; null roles and texts are empty, null turn
    numbers come first. A row without conversation id is a conversation of one turn, its
    id null. Other columns are ignored; an empty table gives an empty result.

    Names of prefixes are made distinct before they are joined, so a first turn that a
    third of all conversations share is one row on both sides.
    """
    convs = materialised(snapshots(turns, conv_col, turn_col, role_col, text_col))
    whole = convs.select("conv_id", "alone", F.element_at("names", -1).alias("name"))
    first = whole.groupBy("name").agg(F.min(F.struct(F.col("conv_id").isNull(), "conv_id", "alone")).alias("k"), F.count(F.lit(1)).alias("n_copies"))
    proper = convs.select(F.explode(F.expr("slice(names, 1, size(names) - 1)")).alias("name")).distinct()
    kept = first.join(proper, "name", "left_anti").select(F.col("k.conv_id").alias("kept_id"), F.col("k.alone").alias("kept_alone"), "n_copies")
    same = convs["conv_id"].eqNullSafe(kept["kept_id"]) & convs["alone"].eqNullSafe(kept["kept_alone"])
    return convs.join(kept, same).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), "n_copies", rendered(F.col("turns")).alias("text")
    )
