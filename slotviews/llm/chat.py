"""Preference pairs: a shared prompt and two completions with loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAIR = "pair_id bigint, prompt string, chosen string, rejected string, chosen_mask string, rejected_mask string, prompt_turns bigint, chosen_turns bigint, rejected_turns bigint"


def rendered(role: Column, text: Column) -> Column:
    """A turn as text; a null role is empty, and so is a null text."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def preference_turns(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``(pair_id, part, pos, role, text)`` with part prompt, chosen or rejected.

    Both inputs hold ``(pair_id, turn, role, text)``. Turns of a side are ordered by turn
    (nulls first), role and text, and numbered from 0. The prompt is the longest run of
    turns from the start that both sides share in role and text, nulls equal to nulls.
    It is found without gathering a conversation: the smallest position that the two
    sides do not share bounds it. A side that is missing has no turns; rows without a
    pair_id are one pair.
    """
    turns = chosen.select("pair_id", "turn", "role", "text", F.lit(0).alias("side")).unionByName(rejected.select("pair_id", "turn", "role", "text", F.lit(1).alias("side")))
    order = Window.partitionBy("pair_id", "side").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    turns = turns.repartition("pair_id").withColumn("pos", F.row_number().over(order) - 1)
    both = Window.partitionBy("pair_id", "pos")
    same = (F.count(F.lit(1)).over(both) == 2) & F.min("text").over(both).eqNullSafe(F.max("text").over(both)) & F.min("role").over(both).eqNullSafe(F.max("role").over(both))
    same = same & (F.count("text").over(both) != 1) & (F.count("role").over(both) != 1)
    turns = turns.withColumn("same", same)
    first = F.min(F.when(~F.col("same"), F.col("pos"))).over(Window.partitionBy("pair_id"))
    turns = turns.withColumn("cut", first)
    shared = F.coalesce(F.col("pos") < F.col("cut"), F.lit(True))
    turns = turns.filter(~shared | (F.col("side") == 0))
    return turns.select("pair_id", F.when(shared, "prompt").when(F.col("side") == 0, "chosen").otherwise("rejected").alias("part"), "pos", "role", "text")


def preference_pairs(chosen: DataFrame, rejected: DataFrame, learned_role: str = "assistant") -> DataFrame:
    """One row for each pair: the prompt once, both completions, and their masks.

    A mask lists ``start:end`` of the completion's characters that count for the loss: the
    text and end mark of turns of ``learned_role``. Prompts never count. Sides that are
    equal throughout have empty completions; an empty input gives no rows. See
    ``preference_turns`` for the shared prefix, ties and nulls. Columns other than the
    four named are not read.
    """
    turns = preference_turns(chosen, rejected).withColumn("s", rendered(F.col("role"), F.col("text")))
    turns = turns.withColumn("learned", F.col("role").eqNullSafe(F.lit(learned_role)))
    upto = Window.partitionBy("pair_id", "part").orderBy("pos")
    turns = turns.withColumn("end", F.sum(F.length("s").cast("bigint")).over(upto))
    body = F.col("end") - F.length("s") + F.length(rendered(F.col("role"), F.lit(""))) - F.length(F.lit("<|end|>\n"))
    turns = turns.withColumn("span", F.when(F.col("learned"), F.concat_ws(":", body, F.col("end") - 1)))
    aggregates = []
    for part in ("prompt", "chosen", "rejected"):
        own = F.col("part") == part
        row = F.array_sort(F.collect_list(F.when(own, F.struct("pos", "s", "span"))))
        aggregates.append(row.alias(f"_{part}"))
    rows = turns.groupBy("pair_id").agg(*aggregates)
    text = lambda part: F.array_join(F.transform(f"_{part}", lambda x: x["s"]), "").alias(part)
    mask = lambda part: F.array_join(F.transform(f"_{part}", lambda x: x["span"]), ",").alias(f"{part}_mask")
    count = lambda part: F.size(f"_{part}").cast("bigint").alias(f"{part}_turns")
    return rows.select("pair_id", text("prompt"), text("chosen"), text("rejected"), mask("chosen"), mask("rejected"), count("prompt"), count("chosen"), count("rejected"))
