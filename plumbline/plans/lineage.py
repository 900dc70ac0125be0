"""Cutting lineage through storage that all executors share, and joins whose small side is of a proven size."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A cut table of at most so many rows is sent to every executor; its rows are keys and a few short cells.
BROADCAST_ROWS = 500_000
#: Keys with more matching rows than this are joined without bringing their rows together.
HOT_ROWS = 1_000_000


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names. Only a session on one machine, as in tests, gets a local one."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            current = tempfile.mkdtemp(prefix="plumbline-")
        context.setCheckpointDir(current)
    return current


def cut(df: DataFrame) -> DataFrame:
    """The rows of a result that is used several times, written once to the shared folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def join_to_keys(rows: DataFrame, keys: DataFrame, on: Sequence[str], weight: str | None = None, broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of many rows to a table with one row per key, whatever share of the rows has one key.

    ``keys`` is cut and counted. Up to ``broadcast_rows`` of it are broadcast, and no row is shuffled. Beyond, keys that more
    than ``hot_rows`` rows have (column ``weight``) are broadcast alone: there can be no more of them than rows divided by
    ``hot_rows``. The others are met by a shuffle, in which no key has more rows than that.
    """
    keys = cut(keys)
    plain = keys.drop(weight) if weight else keys
    if keys.count() <= broadcast_rows:
        return rows.join(F.broadcast(plain), list(on))
    if weight is None:
        return rows.join(plain, list(on))
    hot: Column = F.col(weight) > hot_rows
    cold = rows.join(keys.where(~hot).drop(weight), list(on))
    return cold if keys.where(hot).isEmpty() else cold.unionByName(rows.join(F.broadcast(keys.where(hot).drop(weight)), list(on)))


def leave_out_keys(rows: DataFrame, keys: DataFrame, on: Sequence[str], weight: str, broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows that ``join_to_keys`` leaves out, by the same bounds."""
    keys = cut(keys)
    if keys.count() <= broadcast_rows:
        return rows.join(F.broadcast(keys.drop(weight)), list(on), "left_anti")
    hot = keys.where(F.col(weight) > hot_rows).drop(weight)
    rest = rows if hot.isEmpty() else rows.join(F.broadcast(hot), list(on), "left_anti")
    return rest.join(keys.drop(weight), list(on), "left_anti")
