"""From raw change events to normalised records: filter, reject, reshape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.functions.values import utc_second

#: Fields whose keys an event must carry (their values may still be null).
REQUIRED_FIELDS = ("link_origin", "op_type", "order_id")

#: Outcomes of decoding a payload.
DECODED = "decoded"
UNDECODABLE = "undecodable"
EMPTY = "empty"
MISSING_FIELD = "missing_field"
UNKNOWN_FRAME = "unknown_frame"
UNKNOWN_SCHEMA = "unknown_schema"

#: Reasons that do not enter the count of skipped events.
UNCOUNTED = (UNDECODABLE, UNKNOWN_FRAME, UNKNOWN_SCHEMA)

#: Ranges of offsets that records are counted in before they are numbered.
RANGES = 1024

#: The operations that are applied, and the origin whose inserts are not.
APPLIED_OPERATIONS = ("I", "D")
AUTOMATIC_ORIGIN = "A"


def reject_reason(decode_status: Column | None = None) -> Column:
    """Why an event is not applied; null for an event that is.

    Updates are rejected because they also arrive as a delete and an insert;
    automatic inserts because the pipeline that made them stores them itself.
    """
    status = F.lit(DECODED) if decode_status is None else decode_status
    applied = F.coalesce(F.col("op_type").isin(*APPLIED_OPERATIONS), F.lit(False))
    return (
        F.when(status != DECODED, status)
        .when(F.col("order_id").isNull(), "no_order")
        .when(~applied, "other_operation")
        .when(_automatic_insert(), "automatic_insert")
        .when(F.col("op_ts").isNull(), "no_timestamp")
    )


def _automatic_insert() -> Column:
    return F.col("op_type").eqNullSafe("I") & F.col("link_origin").eqNullSafe(AUTOMATIC_ORIGIN)


def relevant(events: DataFrame) -> DataFrame:
    """Keep the events that change a link: those without a :func:`reject_reason`.

    Written as plain predicates, so they reach the scan of a columnar log.
    """
    return events.filter(
        F.col("order_id").isNotNull()
        & F.col("op_type").isin(*APPLIED_OPERATIONS)
        & ~_automatic_insert()
        & F.col("op_ts").isNotNull()
    )


def rejected(events: DataFrame, decode_status: str | None = None) -> DataFrame:
    """The other side of :func:`relevant`, with its ``reject_reason``.

    ``counted`` is false for payloads that could not be decoded at all: those are
    passed over without entering the count of skipped events.
    """
    reason = reject_reason(F.col(decode_status) if decode_status else None)
    return (
        events.withColumn("reject_reason", reason)
        .filter(F.col("reject_reason").isNotNull())
        .withColumn("counted", ~F.col("reject_reason").isin(*UNCOUNTED))
    )


def observed(events: DataFrame, name: str = "events") -> DataFrame:
    """Count events and skipped ones while they flow by.

    The counts appear in the query progress (``observedMetrics``) of a stream.
    """
    status = F.col("decode_status") if "decode_status" in events.columns else None
    skipped = F.count(F.when(~reject_reason(status).isin(*UNCOUNTED), True))
    return events.observe(name, F.count("*").alias("read"), skipped.alias("skipped"))


def normalised(events: DataFrame) -> DataFrame:
    """Project relevant events to the record the upsert works on.

    ``op_timestamp`` is second-granular; ``op_ts`` and the topic position ride
    along only to break ties deterministically.
    """
    return events.select(
        "order_id",
        "customer_ref",
        "channel_id",
        "status",
        "event_date",
        "link_origin",
        "op_type",
        utc_second(F.col("op_ts")).alias("op_timestamp"),
        "op_ts",
        "kafka_partition",
        "kafka_offset",
    )


def numbered_batches(records: DataFrame, batch_size: int) -> DataFrame:
    """Attach ``batch_no`` by cutting the offsets every ``batch_size`` events."""
    return records.withColumn("batch_no", F.expr(f"kafka_offset div {int(batch_size)}"))


def batches_by_relevance(records: DataFrame, batch_size: int, ranges: int = RANGES) -> DataFrame:
    """Attach ``batch_no`` by cutting after every ``batch_size`` of these records.

    Records are what :func:`relevant` keeps: the others do not count towards a batch. They
    are taken by offset, then partition. Their numbers are found in two levels: records are
    counted by range of offsets, and numbered within a range, so no task sees them all. The
    ranges, RANGES at most, are summed up in one row and broadcast.
    """
    ends = records.agg(F.min("kafka_offset").alias("lo"), F.max("kafka_offset").alias("hi"))
    low, high = ends.select("lo").scalar(), ends.select("hi").scalar()
    share = (F.col("kafka_offset") - low).cast("double") / (high.cast("double") - low + 1)
    ranged = records.withColumn("_range", F.floor(share * ranges).cast("int"))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    listed = counts.agg(F.sort_array(F.collect_list(F.struct("_range", "_n"))).alias("_all"))
    earlier = F.aggregate(F.slice("_all", 1, F.col("_at")), F.lit(0).cast("long"), lambda n, x: n + x["_n"])
    starts = listed.select("_all", F.posexplode("_all").alias("_at", "_own")).select(
        F.col("_own._range").alias("_range"), earlier.alias("_start")
    )
    within = Window.partitionBy("_range").orderBy("kafka_offset", "kafka_partition")
    number = F.col("_start") + F.row_number().over(within) - 1
    return (
        ranged.join(F.broadcast(starts), "_range")
        .withColumn("batch_no", F.floor(number / int(batch_size)))
        .drop("_range", "_start")
    )


def expanded_updates(changes: DataFrame) -> DataFrame:
    """Turn each before/after change into change events.

    Rows carry ``op_type``, ``op_ts`` and the structs ``before`` and ``after``.
    An update becomes the delete of the old image and, one millisecond later, the
    insert of the new one; other operations pass through with their own image.
    """

    def image(op: str | Column, ts: Column, row: Column) -> Column:
        op_col = F.lit(op) if isinstance(op, str) else op
        return F.struct(op_col.alias("op_type"), ts.alias("op_ts"), row.alias("image"))

    op, ts = F.col("op_type"), F.col("op_ts")
    before, after = F.col("before"), F.col("after")
    pair = F.array(image("D", ts, before), image("I", ts + 1, after))
    alone = F.array(image(op, ts, F.when(op == "D", before).otherwise(after)))
    carried = [c for c in changes.columns if c not in ("op_type", "op_ts", "before", "after")]
    return (
        changes.select(*carried, F.explode(F.when(op == "U", pair).otherwise(alone)).alias("e"))
        .select(*carried, "e.op_type", "e.op_ts", "e.image.*")
    )
