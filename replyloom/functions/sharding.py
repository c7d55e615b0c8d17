"""Shard numbers as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_shard(col: Column, shards: int) -> Column:
    """First 16 hex digits of ``md5(col)`` as an unsigned number, modulo ``shards``."""
    number = F.conv(F.substring(F.md5(col), 1, 16), 16, 10).cast("decimal(20,0)")
    return F.pmod(number, F.lit(shards).cast("decimal(20,0)")).cast("int")


def mod_shard(col: Column, shards: int) -> Column:
    """``col`` modulo ``shards``, never negative; rows without a key go to shard 0."""
    return F.coalesce(F.pmod(col, F.lit(shards)), F.lit(0)).cast("int")
