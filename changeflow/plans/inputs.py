"""What the registered queries share: inputs, settings, and how results are shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators import events
from changeflow.session import tune
from changeflow.settings import UpsertSettings
from changeflow.sources import fixtures

#: Small batches, so that the logs of the tests have many.
SETTINGS = UpsertSettings(batch_size=500)
APPLIED_AT = "2026-01-06 00:00:00"


def applied_at() -> Column:
    return F.lit(APPLIED_AT).cast("timestamp")


class Inputs:
    """The logs and reference tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = tune(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    @property
    def order_log(self) -> DataFrame:
        return fixtures.order_log(self.spark, self.sf_dir)

    @property
    def line_log(self) -> DataFrame:
        return fixtures.line_log(self.spark, self.sf_dir)

    @property
    def customer_log(self) -> DataFrame:
        return fixtures.customer_log(self.spark, self.sf_dir)

    @property
    def orders(self) -> DataFrame:
        return fixtures.orders_reference(self.spark, self.sf_dir)

    @property
    def customers(self) -> DataFrame:
        return fixtures.customers_reference(self.spark, self.sf_dir)

    @property
    def sources(self) -> DataFrame:
        return fixtures.sources_reference(self.spark)

    def records(self) -> DataFrame:
        """Relevant events, normalised, in batches of the configured size."""
        return events.numbered_batches(
            events.normalised(events.relevant(self.order_log)), SETTINGS.batch_size
        )

    def records_in(self, parts: int) -> DataFrame:
        """The same events in a given number of equally long batches."""
        return events.normalised(events.relevant(self.order_log)).withColumn(
            "batch_no", self.part_of(parts)
        )

    def part_of(self, parts: int) -> Column:
        last = self.table("events").agg(F.max("event_id")).first()[0]
        return F.expr(f"({parts} * kafka_offset) div {last + 1}")

    def resolution(self) -> tuple:
        """The arguments every resolving operator takes after the records."""
        return self.orders, self.sources, self.customers, SETTINGS, applied_at()


def shown(frame: DataFrame) -> DataFrame:
    """Render instants, dates, decimals and arrays as text, to compare across engines."""
    return frame.select(*[_text(frame[f.name], f.dataType).alias(f.name) for f in frame.schema])


def _text(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    if isinstance(kind, (T.DateType, T.DecimalType)):
        return column.cast("string")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        fields = kind.elementType.names
        return F.array_join(
            F.transform(
                column,
                lambda x: F.concat_ws(
                    "/", *[F.coalesce(x[n].cast("string"), F.lit("~")) for n in fields]
                ),
            ),
            ";",
        )
    if isinstance(kind, T.ArrayType):
        return F.array_join(column, ";")
    return column
