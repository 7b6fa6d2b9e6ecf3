"""Row numbers, ordering and top-n."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnhouse.session import local_rows, scratch_path

_PARTITION_BITS = 33
_KEYS = {"int": 2**31 - 1, "long": 2**63 - 1}


def surrogate_key(
    df: DataFrame, order_by: Sequence[str], name: str, staging: str | None = None, key_type: str = "int"
) -> DataFrame:
    """Number the rows 1, 2, 3 … in the order of ``order_by``, put first as ``name``.

    The keys equal ``row_number() over (order by …)``, but no task sees all rows: the
    rows are sorted over many tasks and stored once with their position, then the
    number of rows in the tasks before is added. That offset table has one row per task
    of the sort, whatever the size of the data. Rows that tie on ``order_by`` may be
    numbered either way round; a hash of the whole row orders them, so that many ties
    still spread over many tasks. Keys have ``key_type``, whatever their number; more rows
    than it can count are an error.
    """
    spark = df.sparkSession
    path = staging or scratch_path(spark, name)
    # Position: the task in the high bits, the row within the task in the low ones.
    placed = df.orderBy(*order_by, F.xxhash64(*df.columns)).withColumn("_at", F.monotonically_increasing_id())
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)
    task = F.shiftright("_at", _PARTITION_BITS)
    sizes = stored.groupBy(task.alias("task")).agg(F.count("*").alias("rows")).collect()
    offsets, before = {}, 0
    for row in sorted(sizes, key=lambda r: r["task"]):
        offsets[row["task"]] = before
        before += row["rows"]
    starts = local_rows(spark, list(offsets.items()), "_task long, _before long")
    row = F.col("_at").bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    if before > _KEYS[key_type]:
        raise OverflowError(f"{before} rows are too many for keys of type {key_type}")
    key = (F.col("_before") + row + 1).cast(key_type)
    return (
        stored.withColumn("_task", task)
        .join(starts, "_task")
        .select(key.alias(name), *df.columns)
    )


Order = tuple[str, bool]


def _sort(order: Sequence[Order]) -> list[Column]:
    """Sort columns; each order is (column, ascending). Blanks come before all values."""
    return [
        F.col(c).asc_nulls_first() if ascending else F.col(c).desc_nulls_last()
        for c, ascending in order
    ]


def order_result(df: DataFrame, *order: Order) -> DataFrame:
    return df.orderBy(*_sort(order))


def _before(df: DataFrame, column: str, ascending: bool, value: object) -> Column:
    """Whether a column sorts strictly before ``value``."""
    c = F.col(column)
    if value is None:
        return F.lit(False) if ascending else c.isNotNull()
    bound = F.lit(value).cast(df.schema[column].dataType)
    return c.isNull() | (c < bound) if ascending else c.isNotNull() & (c > bound)


def top_n_ties(df: DataFrame, n: int, *order: Order) -> DataFrame:
    """The first ``n`` rows by the order, and every row that ties with the last of them.

    The n-th sort key is looked up first; then a plain filter keeps the rows not after
    it. No window gathers the rows in one task. ``df`` is evaluated twice, so pass
    stored or aggregated rows.
    """
    last = df.select(*[c for c, _ in order]).orderBy(*_sort(order)).offset(n - 1).limit(1).collect()
    if not last:
        return df
    keep, equal = [], F.lit(True)
    for column, ascending in order:
        value = last[0][column]
        keep.append(equal & _before(df, column, ascending, value))
        equal = equal & F.col(column).eqNullSafe(
            F.lit(value).cast(df.schema[column].dataType)
        )
    return df.filter(reduce(lambda a, b: a | b, keep) | equal)
