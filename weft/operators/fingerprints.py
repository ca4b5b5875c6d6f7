"""Fingerprints of tables that follow their changes: multiset hashes that add and subtract.

A row's hash is four numbers of 64 bits out of the SHA-256 of its columns; a part's state is the sum of its rows' numbers
modulo 2^64, and how many they are. So a state does not depend on the order of rows, repeated rows count, inserted rows are
added and deleted ones taken away, and only parts that changed are read again. It tells accidents, not a forger who
makes rows for a sum. Nothing is gathered: sums are made where the rows are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.operators.mutation import row_signature

LANES = 4


def _mod() -> Column:
    return F.lit("18446744073709551616").cast("decimal(20,0)")  # 2^64


def lanes(columns: Sequence[str]) -> list[Column]:
    """A row's numbers, from 16 digits of its hash each."""
    h = row_signature(*columns)
    return [F.conv(F.substring(h, 1 + 16 * k, 16), 16, 10).cast("decimal(20,0)") for k in range(LANES)]


def state(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by, n, h0 .. h3): the state of each part of ``df``."""
    rows = df.select(*by, *[c.alias(f"h{k}") for k, c in enumerate(lanes(columns))])
    return _summed(rows.withColumn("n", F.lit(1).cast("long")), by)


def _summed(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    total = lambda c: F.pmod(F.sum(F.col(c).cast("decimal(38,0)")), _mod()).cast("decimal(20,0)").alias(c)
    return rows.groupBy(*by).agg(F.sum("n").alias("n"), *[total(f"h{k}") for k in range(LANES)])


def changed(before: DataFrame, by: Sequence[str], added: DataFrame | None = None, taken: DataFrame | None = None) -> DataFrame:
    """``before`` with the states ``added`` and without the states ``taken``; parts left without rows go. Raises if a part had fewer rows than are taken."""
    out = before
    if added is not None:
        out = out.unionByName(added)
    if taken is not None:
        out = out.unionByName(taken.withColumns({"n": -F.col("n"), **{f"h{k}": F.pmod(_mod() - F.col(f"h{k}"), _mod()).cast("decimal(20,0)") for k in range(LANES)}}))
    summed = _summed(out, by)
    none = F.lit(True)
    for k in range(LANES):
        none = none & (F.col(f"h{k}") == 0)
    wrong = (F.col("n") < 0) | ((F.col("n") == 0) & ~none)
    return summed.withColumn("n", F.when(wrong, F.raise_error(F.lit("rows are taken that the part did not have"))).otherwise(F.col("n"))).filter("n > 0")


def total(states: DataFrame) -> DataFrame:
    """One row (n_rows, fingerprint) of all parts: the same however the table is divided into them."""
    one = _summed(states.withColumn("_all", F.lit(1)), ["_all"])
    text = F.concat(*[F.lpad(F.lower(F.conv(F.col(f"h{k}").cast("string"), 10, 16)), 16, "0") for k in range(LANES)])
    return one.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.max(text), F.lit("0" * 16 * LANES)).alias("fingerprint"))


def drifted(recorded: DataFrame, now: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, was, n, fault) of parts that are not as recorded: missing, new, or changed."""
    old = recorded.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("n").alias("was"), *[F.col(f"h{k}").alias(f"_h{k}") for k in range(LANES)])
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    both = old.join(now, same, "full")
    equal = F.col("was").eqNullSafe(F.col("n"))
    for k in range(LANES):
        equal = equal & F.col(f"h{k}").eqNullSafe(F.col(f"_h{k}"))
    fault = F.when(F.col("n").isNull(), "missing").when(F.col("was").isNull(), "new").otherwise("changed")
    return both.filter(~equal).select(*[F.coalesce(c, f"_{c}").alias(c) for c in by], "was", "n", fault.alias("fault"))
