"""Joins with tables that are usually small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymill.functions.session import materialise

FEW = 500_000


def if_few(df: DataFrame, name: str, limit: int = FEW) -> DataFrame:
    """The table, written once and counted: marked for broadcast up to `limit` rows, left to a plain join beyond."""
    df = materialise(df, name)
    return F.broadcast(df) if df.count() <= limit else df
