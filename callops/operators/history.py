"""Effective-dated history of a dimension, out of its snapshots, and the join to the state of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from callops.operators.skew import lookup_join


def periods(snapshots: DataFrame, key: str, attributes: list[str], day: str = "snapshot") -> DataFrame:
    """One row per key and run of snapshots that show the same attributes.

    A period is valid from its first snapshot's day up to the day of the first snapshot that shows
    something else or lacks the key (``valid_to``, itself out; NULL while the newest snapshot shows it).
    Of several rows of a key in a snapshot the smallest counts; rows without key or day count nowhere, NULL
    attributes are equal to each other. One shuffle, by key: a key has a row per snapshot at most. The table
    of snapshot days has a row per day of the calendar.
    """
    given = snapshots.where(F.col(key).isNotNull() & F.col(day).isNotNull())
    in_order = Window.orderBy(day)
    days = given.select(day).distinct().select(
        day, F.row_number().over(in_order).alias("_n"), F.lead(day).over(in_order).alias("_next"))
    one = given.repartition(key).groupBy(key, day).agg(F.min(F.struct(*attributes)).alias("_row"))
    of_key = Window.partitionBy(key).orderBy("_n")
    goes_on = (F.lag("_n").over(of_key) == F.col("_n") - 1) & F.lag("_row").over(of_key).eqNullSafe(F.col("_row"))
    marked = one.join(days, day).withColumn("_starts", F.when(goes_on, 0).otherwise(1))
    runs = marked.withColumn("_run", F.sum("_starts").over(of_key))
    return (
        runs.groupBy(key, "_run").agg(
            F.min(day).alias("valid_from"), F.max(F.struct("_n", "_next")).alias("_last"), F.min("_row").alias("_row"))
        .select(key, "valid_from", F.col("_last._next").alias("valid_to"), "_row.*")
    )


def state_of_day(facts: DataFrame, history: DataFrame, key: str, date: str, values: list[str], row_id: list[str]) -> DataFrame:
    """Add ``values`` of the period that was valid on the fact's date; NULL where none was.

    ``history`` has the same ``key``, ``valid_from`` and ``valid_to``; periods of a key do not overlap. Facts are reduced to
    key-days, merged with the days on which a period starts or ends, and filled forward in one window, so
    there is no range join, and the calendar bounds the rows of a key.
    """
    state = F.struct(F.struct(*values).alias("row"))
    began = history.select(F.col(key).alias("_key"), F.col("valid_from").alias("_day"), state.alias("_began"))
    ended = history.where("valid_to is not null").select(
        F.col(key).alias("_key"), F.col("valid_to").alias("_day"), F.lit(True).alias("_ended"))
    asked = facts.select(F.col(key).alias("_key"), F.col(date).alias("_day"), F.lit(True).alias("_asked"))
    points = asked.unionByName(began, allowMissingColumns=True).unionByName(ended, allowMissingColumns=True)
    daily = points.dropna(subset=["_key", "_day"]).groupBy("_key", "_day").agg(
        F.max("_began").alias("_began"), F.max("_ended").alias("_ended"), F.max("_asked").alias("_asked"))
    # where one period ends and the next starts, the start counts
    change = F.when(F.col("_began").isNotNull() | F.col("_ended"), F.struct(F.col("_began").alias("now")))
    so_far = Window.partitionBy("_key").orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    filled = daily.withColumn("_state", F.last(change, ignorenulls=True).over(so_far)).where("_asked")
    lookup = filled.select("_key", "_day", *[F.col("_state.now.row")[v].alias(v) for v in values])
    keyed = facts.withColumn("_key", F.col(key)).withColumn("_day", F.col(date))
    return lookup_join(keyed, lookup, ["_key", "_day"], row_id).drop("_key", "_day")
