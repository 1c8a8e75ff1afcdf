"""Equi-joins and time-range joins, with salts for a side that one key may fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {
    "inner": "inner",
    "left": "left",
    "right": "right",
    "semi": "left_semi",
    "left_semi": "left_semi",
    "anti": "left_anti",
    "left_anti": "left_anti",
}


def _row_salt(df: DataFrame, salts: int) -> Column:
    """A salt from the row and the number of its partition: the same on every attempt of a
    task, unlike a random one, and different for copies of a row in different partitions."""
    columns = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*columns, F.spark_partition_id()), F.lit(salts)).cast("int")


def _every_salt(salts: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))


def _check_keys(left: DataFrame, right: DataFrame, on: list[str]) -> None:
    for key in on:
        kinds = {left.schema[key].dataType.simpleString(), right.schema[key].dataType.simpleString()}
        if len(kinds) > 1 and "string" in kinds:
            raise TypeError(f"join key {key} is text on one side only; cast it first")


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "inner",
    split: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """Join on same-named keys, which appear once in the result.

    Adaptive execution splits hot keys of both sides of an inner join and of the kept side
    of an outer, semi or anti join. It cannot split the other side of an outer join: name
    that side in ``split`` ("left" or "right") and give a number of ``salts``. Its rows are then dealt
    to the salts and the rows of the other side copied to each, so a key's rows are spread over
    ``salts`` tasks. A kept row without a partner is found by the distinct keys of the split
    side and not by its copies. The plan depends on these arguments alone, never on an
    estimate of sizes. Semi and anti joins reduce the right side to its distinct keys first.
    """
    on = [on] if isinstance(on, str) else list(on)
    kind = _KINDS[how]
    _check_keys(left, right, on)
    if split not in (None, "left", "right"):
        raise ValueError("split names a side: left or right")
    if salts < 1 or (salts > 1 and split is None):
        raise ValueError("salts is at least 1, and more need a side to split")
    if kind in ("left_semi", "left_anti"):
        right = right.select(*on).distinct()
        if split == "right":
            split = None
    if split is None or salts == 1:
        return left.join(right, on, kind)
    names = left.columns if kind.startswith("left_") else left.columns + [c for c in right.columns if c not in on]
    names = on + [c for c in names if c not in on]
    salted = [*on, "_salt"]
    parts = {"left": left, "right": right}
    other = "right" if split == "left" else "left"
    source, copied = parts[split], parts[other]
    parts[split] = source.withColumn("_salt", _row_salt(source, salts))
    # Merged, as a broadcast would hold the copies for all salts in every executor, many times the size that Spark expects.
    parts[other] = copied.withColumn("_salt", _every_salt(salts)).hint("merge")
    if kind in ("inner", split) or kind.startswith("left_"):
        # Every row of the split side keeps exactly one salt: the join is right as it stands.
        return parts["left"].join(parts["right"], salted, kind).select(*names)
    # The copied side is the kept one: pairs first, then its rows whose key has no partner at all.
    pairs = parts["left"].join(parts["right"], salted, "inner").select(*names)
    alone = copied.join(source.select(*on).distinct(), on, "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True).select(*names)


def range_join(
    points: DataFrame,
    starts: DataFrame,
    point_key: str,
    start_key: str,
    point_time: str,
    start_time: str,
    seconds: int,
    salts: int = 1,
) -> DataFrame:
    """Pairs of the same key with ``start <= point <= start + seconds``; batch or stream.

    Time is cut into slots as long as the range and the slot joins the key. A start belongs
    to its own slot and the next, a point to its own slot only, so each pair meets once. A
    hot key is thereby spread over its slots, and a row is tried against the rows of two
    slots and not against all rows of its key. On streams, set watermarks on both sides
    first; the time condition lets Spark drop old state.

    Where the points of a key may fill a slot, ``salts`` deals them to as many parts and copies the
    starts to each. The number is part of the plan, in a batch and in a stream, whichever keys
    are or grow hot; a stream's checkpoint is bound to it.
    """

    def slot(time: str) -> Column:
        return F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / seconds).cast("bigint")

    if salts < 1:
        raise ValueError("salts is at least 1")
    slotted_points = points.withColumns({"_point_slot": slot(point_time), "_point_salt": _row_salt(points, salts)})
    first = slot(start_time)
    slotted_starts = starts.withColumn("_start_slot", F.explode(F.array(first, first + 1)))
    slotted_starts = slotted_starts.withColumn("_start_salt", _every_salt(salts))
    condition = (
        (F.col(point_key) == F.col(start_key))
        & (F.col("_point_slot") == F.col("_start_slot"))
        & (F.col("_point_salt") == F.col("_start_salt"))
        & (F.col(point_time) >= F.col(start_time))
        & (F.col(point_time) <= F.col(start_time) + F.expr(f"INTERVAL {int(seconds)} SECONDS"))
    )
    joined = slotted_points.join(slotted_starts, condition)
    return joined.drop("_point_slot", "_start_slot", "_point_salt", "_start_salt")


def with_attributes(
    facts: DataFrame, attributes: DataFrame, fact_key: str, attribute_key: str, broadcast: bool = False
) -> DataFrame:
    """Inner join to a static frame, keeping both key columns; facts may be a stream.

    A batch is left to Spark, which sees the sizes of shuffles as they are written. A stream's
    plan is fixed at each batch; who knows that the static side stays small says ``broadcast``.
    """
    kinds = [facts.schema[fact_key].dataType, attributes.schema[attribute_key].dataType]
    if sum(isinstance(k, T.StringType) for k in kinds) == 1:
        raise TypeError(f"{fact_key} and {attribute_key}: only one of them is text; cast it first")
    side = F.broadcast(attributes) if broadcast else attributes
    return facts.join(side, F.col(fact_key) == F.col(attribute_key))
