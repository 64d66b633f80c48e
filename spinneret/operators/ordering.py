"""Dense ranks and running totals over a total order, without a one-task window.

A window without PARTITION BY moves every row to one task. Here the rows are range-partitioned on the (unique) keys, so
that the partitions themselves are in order and about equally large, and each row gets its position inside its
partition. Only one row per partition, with the partition's total, goes through the ordered window; these totals are
broadcast back, and their number is the number of shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from spinneret.session import cut_lineage

# Layout of monotonically_increasing_id(): partition number above bit 33, row number inside the partition below.
_ROW_BITS = 33

RANGE = "_range"
POSITION = "_position"


def in_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with ``_range`` (ordered partition number) and ``_position`` (0-based place in that partition).

    The result is checkpointed, because the numbers must not change when a lost partition is computed again.
    """
    tagged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_tag", F.monotonically_increasing_id())
    return cut_lineage(tagged).select(
        *df.columns,
        F.shiftright("_tag", _ROW_BITS).alias(RANGE),
        F.col("_tag").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(POSITION),
    )


def _before(per_range: DataFrame, combine) -> DataFrame:
    """Fold the totals of all earlier ranges; one row per shuffle partition, so the single task is small."""
    earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return per_range.select(RANGE, combine("_total").over(earlier).alias("_before"))


def _with_before(ranged: DataFrame, total: Column, combine) -> DataFrame:
    per_range = ranged.groupBy(RANGE).agg(total.alias("_total"))
    return ranged.join(F.broadcast(_before(per_range, combine)), RANGE)


def _drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(RANGE, POSITION, "_before")


def rank_rows(ranged: DataFrame, out: str) -> DataFrame:
    """Dense 0-based rank; reads the positions that :func:`in_ranges` left, no window over the rows."""
    placed = _with_before(ranged, F.count(F.lit(1)), F.sum)
    rank = F.coalesce("_before", F.lit(0)) + F.col(POSITION)
    return placed.withColumn(out, rank).drop("_before")


def dense_rank(df: DataFrame, *keys: str, out: str) -> DataFrame:
    """Number the rows 0..n-1 in key order; the keys must be unique."""
    return _drop_helpers(rank_rows(in_ranges(df, *keys), out))


def _scanned(placed: DataFrame, value: str, out: str, scan) -> DataFrame:
    """Add ``out``: ``scan(values, before)`` over each range, where the rows lie; ``before`` starts with ``_before``.

    A partition is a range in order (see :func:`in_ranges`), so a total is carried from one Arrow batch to the next, and no
    row moves: a window over the ranges would shuffle and sort them once more.
    """

    kept = [c for c in placed.columns if c != "_before"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in batches:
            if batch.num_rows:
                carried = batch.column("_before")[0].as_py() if carried is None else carried
                totals, carried = scan(batch.column(value), carried)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), totals], [*kept, out])

    fields = [placed.schema[c] for c in kept]
    return placed.mapInArrow(add, StructType([*fields, StructField(out, LongType())]))


def _sums(values: pa.Array, before: int | None) -> tuple[pa.Array, int]:
    values = pc.fill_null(values.cast(pa.int64()), 0)
    upto = pc.add(pc.cumulative_sum(values), before or 0)
    return pc.subtract(upto, values), upto[-1].as_py()


def _maxima(values: pa.Array, before: int | None) -> tuple[pa.Array, int | None]:
    least = np.iinfo(np.int64).min
    known = pc.fill_null(values.cast(pa.int64()), least).to_numpy(zero_copy_only=False)
    upto = np.maximum(np.maximum.accumulate(known), least if before is None else before)
    return pa.array(upto, pa.int64(), mask=upto == least), None if upto[-1] == least else int(upto[-1])


def scan_sum(ranged: DataFrame, value: str, out: str) -> DataFrame:
    """Sum of ``value`` over all rows strictly before this one."""
    return _scanned(_with_before(ranged, F.sum(value), F.sum), value, out, _sums)


def scan_max(ranged: DataFrame, value: str, out: str) -> DataFrame:
    """Greatest non-null ``value`` up to and including this row: an as-of join when ``value`` rises with the keys."""
    return _scanned(_with_before(ranged, F.max(value), F.max), value, out, _maxima)


def running_sum(ranged: DataFrame, value: str, out: str) -> DataFrame:
    """The same as :func:`scan_sum` with SQL functions only, for a shuffle and a sort more."""
    placed = _with_before(ranged, F.sum(value), F.sum)
    inside = Window.partitionBy(RANGE).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum(value).over(inside), F.lit(0)) + F.coalesce("_before", F.lit(0))
    return placed.withColumn(out, total.cast("bigint")).drop("_before")


def offsets(df: DataFrame, *keys: str, size: str, out: str) -> DataFrame:
    """Start offset of each row when rows of ``size`` bytes are laid out in key order."""
    return scan_sum(in_ranges(df, *keys), size, out).drop(RANGE, POSITION)


def ranked_tokens(token_dict: DataFrame) -> DataFrame:
    """``(token, offset, slot)`` of a dictionary in its ranges, for whatever is made of tokens in order."""
    tokens = token_dict.where(F.col("token") != "").select("token", F.col("offset").cast("bigint").alias("offset"))
    return rank_rows(in_ranges(tokens, "token"), "slot")
