"""Ranks and running totals over a global order, without a window over the whole table.

A window with no PARTITION BY moves every row into one task.  Instead the rows
are range-partitioned on the whole compound order (a row number breaks ties,
so equal keys can be cut apart), sorted within their ranges and written once;
the number of ranges follows from the number of rows.  A row's rank is its
place in its range plus the rows of all earlier ranges, and a running total is
the sum within the range plus the totals of the earlier ones.  Only one row
per range reaches the driver or a broadcast.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, release

ROWS_PER_RANGE = 250_000   # rows sorted and summed in one task
SMALL = 100_000            # a table counted to have no more rows is ranked by a plain window


def _numbered(df: DataFrame) -> tuple[DataFrame, int]:
    """The rows, written once with a row number, and their count."""
    stored = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    return stored, stored.count()


def _in_ranges(stored: DataFrame, order: list[Column], ranges: int) -> DataFrame:
    """The rows, written in ranges of the order, with ``_at``: range number (upper bits) and place in the range."""
    keys = [*order, F.col("_row").asc()]
    ranged = stored.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).drop("_row")
    out = cut_lineage(ranged.withColumn("_at", F.monotonically_increasing_id()))
    release(stored)
    return out


def _offsets(ranged: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """One row per range: ``_range`` and for every name the sum over the earlier ranges, to be broadcast."""
    spark, number = ranged.sparkSession, F.shiftright("_at", 33)
    rows = ranged.groupBy(number.alias("_range")).agg(*[F.sum(c).alias(n) for n, c in sums.items()]).orderBy("_range").collect()
    before, out = {n: 0 for n in sums}, []
    for r in rows:
        out.append((r["_range"], *before.values()))
        before = {n: v if r[n] is None else v + r[n] for n, v in before.items()}
    kinds = ranged.select(*[F.sum(c).alias(n) for n, c in sums.items()]).dtypes
    schema = ", ".join(["_range long", *[f"`{n}` {k}" for n, k in kinds]])
    of_kind = lambda v, k: float(v) if k == "double" else Decimal(v) if k.startswith("decimal") else v
    exact = [(r[0], *[of_kind(v, k) for v, (_, k) in zip(r[1:], kinds)]) for r in out]
    return F.broadcast(spark.createDataFrame(exact, schema))


def row_ranks(df: DataFrame, order: list[Column], out: str = "rank", ranges: int | None = None,
              rows_per_range: int = ROWS_PER_RANGE, small: int = SMALL) -> DataFrame:
    """``out`` (long): the row's 0-based place in ``order``; rows that the order does not tell apart stand in any order.

    A table of at most ``small`` rows (counted) takes a plain window; a larger
    one goes by ranges.  Both give the same ranks.
    """
    stored, n = _numbered(df)
    if ranges is None and n <= small:
        return stored.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("long") - 1).drop("_row")
    ranged = _in_ranges(stored, order, ranges or -(-n // rows_per_range))
    offsets = _offsets(ranged, {"_before": F.lit(1)})
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return ranged.join(offsets, F.shiftright("_at", 33) == F.col("_range")).withColumn(out, place).drop("_at", "_range", "_before")


def running_totals(df: DataFrame, order_col: str | list[Column], sum_cols: list[str],
                   descending: bool = True, ranges: int | None = None,
                   suffix: str = "_cum", rows_per_range: int = ROWS_PER_RANGE, small: int = SMALL) -> DataFrame:
    """Cumulative sums of ``sum_cols`` in the order of a column or of a list of sort columns.

    Adds ``<c><suffix>`` per column: the sum over all rows at or before this
    row in the order, nulls counting as 0.  Work per task is bounded by the range size.
    """
    order = [F.col(order_col).desc() if descending else F.col(order_col).asc()] if isinstance(order_col, str) else order_col
    stored, n = _numbered(df)
    if ranges is None and n <= small:
        w = Window.orderBy(*order, F.col("_row").asc()).rowsBetween(Window.unboundedPreceding, 0)
        return stored.select("*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}{suffix}") for c in sum_cols]).drop("_row")
    ranged = _in_ranges(stored, order, ranges or max(1, -(-n // rows_per_range)))
    offsets = _offsets(ranged, {f"_off_{c}": F.col(c) for c in sum_cols})
    staged = ranged.withColumn("_range_of", F.shiftright("_at", 33))
    w = Window.partitionBy("_range_of").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    out = staged.join(offsets, F.col("_range_of") == F.col("_range"))
    for c in sum_cols:
        out = out.withColumn(f"{c}{suffix}", F.coalesce(F.sum(c).over(w), F.lit(0)) + F.col(f"_off_{c}"))
    return out.drop("_at", "_range", "_range_of", *[f"_off_{c}" for c in sum_cols])
