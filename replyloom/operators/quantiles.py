"""Exact quantiles of any number of different values.

Equal values are counted, the counts are put in order over range partitions, and running sums of
the partitions' totals say which of them hold the wanted ranks. Only those are summed value by
value, and of each quantile the two values around its rank are fetched. Nothing is held for all
values in one place: windows see one row per partition, or one partition's rows, which spill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def exact_quantiles(df: DataFrame, value: str, ranks: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``*by, n, quantiles`` per group: number of values and ``ranks`` as an array, linear between
    the two neighbours as ``percentile`` has it.

    Null values do not count; groups without others, and an empty table, give no row. ``by`` may
    be null, and one group may hold any share of the rows.
    """
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    counts = df.where(F.col(value).isNotNull()).groupBy(group.alias("_by"), F.col(value).cast("double").alias("_value")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    # Written, so that both passes below see the same partitions.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = counts.repartitionByRange(parts, "_by", "_value").withColumn("_part", F.spark_partition_id())
    ordered = materialize(ordered, "ordered-counts")

    groups = Window.partitionBy("_by")
    before = groups.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ordered.groupBy("_by", "_part").agg(F.sum("_n").alias("_rows")).select(
        "_by",
        "_part",
        "_rows",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(groups).alias("_all"),
    )
    wanted = sums.select("*", F.posexplode(F.array(*[F.lit(float(r)) for r in ranks])).alias("_rank", "_share"))
    wanted = wanted.withColumn("_at", F.col("_share") * (F.col("_all") - 1))
    ends = F.array(F.floor("_at"), F.ceil("_at"))
    wanted = wanted.select("*", F.posexplode(ends).alias("_end", "_place")).where(
        (F.col("_place") >= F.col("_before")) & (F.col("_place") < F.col("_before") + F.col("_rows"))
    )
    wanted = wanted.select("_by", "_part", "_all", "_rank", "_end", "_at", (F.col("_place") - F.col("_before")).alias("_place"))

    upto = F.sum("_n").over(Window.partitionBy("_by", "_part").orderBy("_value"))
    needed = ordered.join(wanted.select("_by", "_part").distinct(), ["_by", "_part"], "left_semi")
    placed = needed.withColumn("_upto", upto)
    found = placed.join(wanted, ["_by", "_part"]).where(
        (F.col("_place") < F.col("_upto")) & (F.col("_place") >= F.col("_upto") - F.col("_n"))
    )
    pairs = found.groupBy("_by", "_rank", "_at", "_all").agg(
        F.max(F.when(F.col("_end") == 0, F.col("_value"))).alias("low"),
        F.max(F.when(F.col("_end") == 1, F.col("_value"))).alias("high"),
    )
    share = F.col("_at") - F.floor("_at")
    between = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise((1 - share) * F.col("low") + share * F.col("high"))
    listed = pairs.groupBy("_by").agg(
        F.max("_all").alias("n"), F.sort_array(F.collect_list(F.struct("_rank", between.alias("value")))).alias("listed")
    )
    return listed.select(*[F.col(f"_by.{c}").alias(c) for c in by], "n", F.col("listed.value").alias("quantiles"))
