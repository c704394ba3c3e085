"""Joins of location rows with tables of few rows (one per forecast date, or per reported month and concept)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycast.params import ForecastParams

SALTS = 64


def join_few(locations: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on few-valued keys by shuffle.

    On such keys a plain shuffle would deal the location rows over a handful
    of partitions.  Each key is therefore dealt over SALTS parts.
    """
    salted = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (locations.withColumn("_salt", F.pmod(F.hash("loc_num", "date_forecast"), F.lit(SALTS)))
            .join(salted, [*keys, "_salt"], "left").drop("_salt"))


def at_most(few: DataFrame, rows: int) -> DataFrame:
    """`few`, whose use stops the run if it has more than `rows` rows.

    The window counts at most `rows + 1` rows, which a limit lets through.
    """
    message = f"a table to be broadcast has more than {rows} rows: raise broadcast_rows, or set it to 0 to join by shuffle"
    counted = few.limit(rows + 1).withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy()))
    return counted.where(F.when(F.col("_rows") <= rows, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))).drop("_rows")


def join_small(locations: DataFrame, few: DataFrame, keys: list[str], params: ForecastParams) -> DataFrame:
    """Left join without moving the location rows: `few` is counted and broadcast (see `broadcast_rows`)."""
    if not params.broadcast_rows:
        return join_few(locations, few, keys)
    return locations.join(F.broadcast(at_most(few, params.broadcast_rows)), keys, "left")
