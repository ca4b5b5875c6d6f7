"""Running state over ordered rows, in segments: no task sees a whole file or partition.

What a state machine does over a segment is summed up in one row: the last value that each of its states took there, and
how many rows it counted. Summaries compose, so a segment starts with what the segments before it leave, and all
segments are run at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a file that one window runs over, where rows have a place.
SEGMENT = 100_000


def segment_of(place: str) -> Column:
    """The segment of a row by its place, a whole number from 0."""
    return F.floor(F.col(place) / SEGMENT)


def running(df: DataFrame, partition: list[str], order: list[str], lasts: dict[str, Column] | None = None, counts: dict[str, Column] | None = None, segment: Column | None = None) -> DataFrame:
    """``df`` with the state at each row of its partition, itself included: of ``lasts`` the last value that is not null, of ``counts`` how many rows hold.

    ``segment`` never falls in the given order, by which rows are split. Without it rows are dealt into ranges of the order, which are written once;
    rows equal in it stay together. What the segments before leave is a row for each partition and segment, gathered by window and joined back
    for the partitions alone that run over several.
    """
    from weft.sources.tables import kept

    lasts, counts = lasts or {}, counts or {}
    if segment is None:
        spark = df.sparkSession
        n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
        dealt = kept(df.repartitionByRange(n, *partition, *order).withColumn("_seg", F.spark_partition_id()))
    else:
        dealt = df.withColumn("_seg", segment)
    value = {f"_v_{c}": v for c, v in lasts.items()} | {f"_n_{c}": F.when(F.coalesce(v, F.lit(False)), 1).otherwise(0).cast("long") for c, v in counts.items()}
    marked = dealt.withColumns(value)
    at = F.struct(*order)
    summed = [F.max(F.when(F.col(f"_v_{c}").isNotNull(), F.struct(at.alias("at"), F.col(f"_v_{c}").alias("v"))))["v"].alias(f"_v_{c}") for c in lasts] + [F.sum(f"_n_{c}").alias(f"_n_{c}") for c in counts]
    by = marked.groupBy(*partition, "_seg").agg(*summed)
    before = Window.partitionBy(*partition).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.last(f"_v_{c}", ignorenulls=True).over(before).alias(f"_cv_{c}") for c in lasts] + [F.sum(f"_n_{c}").over(before).alias(f"_cn_{c}") for c in counts]
    place = F.row_number().over(Window.partitionBy(*partition).orderBy("_seg")).alias("_place")
    carry = by.select(*[F.col(c).alias(f"_p_{c}") for c in partition], F.col("_seg").alias("_p_seg"), place, *carried).filter("_place > 1").drop("_place")
    same = F.col("_seg") == F.col("_p_seg")
    for c in partition:
        same = same & F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    own = Window.partitionBy(*partition, "_seg").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = marked.withColumns({f"_v_{c}": F.last(f"_v_{c}", ignorenulls=True).over(own) for c in lasts} | {f"_n_{c}": F.sum(f"_n_{c}").over(own) for c in counts})
    out = run.join(carry, same, "left")
    states = {c: F.coalesce(f"_v_{c}", f"_cv_{c}") for c in lasts} | {c: F.col(f"_n_{c}") + F.coalesce(f"_cn_{c}", F.lit(0)) for c in counts}
    kept_ = [F.col(c) for c in df.columns if c not in states]
    return out.select(*kept_, *[v.alias(c) for c, v in states.items()])
