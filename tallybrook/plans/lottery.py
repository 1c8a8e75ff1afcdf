"""How often winners of a repeated draw had entered it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.operators.counting import count_by
from tallybrook.operators.grouping import distribution, max_by_group


# Entries that a task counts at most, unless more are of one number.
ENTRIES_PER_TASK = 1_000_000


def multiplier_distribution(
    entries: DataFrame, winners: DataFrame, number: str, batch: str, since: object
) -> DataFrame:
    """Winners by their largest multiplier: the copies of a number among one batch's entries.

    Only winners since a batch count, with all their entries, earlier ones too. A number
    that won more than once counts its copies once per win.

    Entries meet the winners' numbers first, so those of numbers that never won go before
    anything is counted. Both groupings use the same partitions by number. Beyond ``ENTRIES_PER_TASK`` entries these are
    as many as it takes, so the groups that a task holds do not grow with the table.
    """
    recent = winners.where(F.col(batch) >= F.lit(since)).select(number)
    wins = count_by(recent, number, name="wins")
    entries = entries.select(number, batch)
    multiplier = (F.col("copies") * F.col("wins")).alias("multiplier")
    met = entries.join(wins, number)
    parts = -(-entries.count() // ENTRIES_PER_TASK)
    met = met.repartition(parts, number) if parts > 1 else met
    copies = count_by(met, batch, number, "wins", name="copies")
    multipliers = max_by_group(copies.select(number, multiplier), [number], "multiplier")
    return distribution(multipliers, "multiplier")
