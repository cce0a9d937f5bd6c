"""Reference tables laid out so that a few keys are found without reading the rest.

Rows lie in the order of one column, so a row group has a narrow range of it; the columns
a row is looked up by have Bloom filters, which tell a row group that a value is not there.
A lookup names its values in the filter itself: Parquet then skips every row group none of
them can be in, whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The most values a filter names; more of them are joined.
FEW = 2000
#: Rows of a row group: few, as a lookup reads whole ones.
GROUP_ROWS = 5000
#: How often a Bloom filter errs: so seldom that thousands of lookups hit no group in vain.
ERRS = 1e-7
#: How many values an ``IN`` may have and still reach the scan value by value.
PUSHED = "spark.sql.parquet.pushdown.inFilterThreshold"


def write_clustered(
    frame: DataFrame, path: str, column: str, looked_up: tuple[str, ...], group_rows: int = GROUP_ROWS
) -> None:
    """Write a table in the order of a column, with Bloom filters on those it is looked up by."""
    ordered = frame.repartitionByRange(F.col(column)).sortWithinPartitions(column)
    writer = ordered.write.option("parquet.block.row.count.limit", group_rows)
    for name in looked_up:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{name}", group_rows)
        writer = writer.option(f"parquet.bloom.filter.fpp#{name}", ERRS)
    writer.parquet(path)


def few_values(keys: DataFrame, most: int = FEW) -> list | None:
    """The distinct values of a one-column frame, where there are few; else None.

    At most ``most`` + 1 values reach the driver.
    """
    rows = keys.filter(F.col(keys.columns[0]).isNotNull()).distinct().limit(most + 1).collect()
    return [r[0] for r in rows] if len(rows) <= most else None


def among(column: Column, values: list) -> Column:
    """Whether a column has one of a few values, as a filter that reaches the scan."""
    return column.isin(values) if values else F.lit(False)


def push_lookups(spark: SparkSession) -> None:
    """Let filters of few values reach the scan."""
    spark.conf.set(PUSHED, str(FEW))
