"""Queries over the upsert: each step, each state, and the whole flush."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.values import ACTION_INSERT
from changeflow.operators import apply, resolve
from changeflow.plans.inputs import SETTINGS, Inputs, applied_at, shown
from changeflow.plans.oracle import by_parts, instant_text, query
from changeflow.session import stored

#: The common columns the tables of a flush are compared on.
FLUSH_COLUMNS = (
    "table_name", "order_source_id", "order_id", "customer_source_id", "customer_id",
    "audit_action", "link_score", "created_at",
)
LINK_VIEW = ("order_source_id", "order_id", "customer_source_id", "customer_id", "audit_action",
             "link_score", "link_rating", "link_method", "created_at")


def _stage(inputs: Inputs, positions: bool = False) -> DataFrame:
    return resolve.staged(inputs.records(), *inputs.resolution(), positions=positions)


def backfill_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    distinct = resolve.distinct_records(inputs.records())
    missing = resolve.missing_customers(distinct, inputs.customers, SETTINGS, applied_at())
    return shown(missing.drop("updated_at"))


def stage_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_stage(Inputs(spark, sf_dir)).drop("updated_at"))


def candidates_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(apply.candidate_rows(_stage(Inputs(spark, sf_dir))).drop("updated_at"))


def links_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply.link_history_rows(_stage(Inputs(spark, sf_dir)))
    return shown(rows.drop("updated_at", "audit_action_at"))


def candidates_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    return _candidate_view(apply.candidates_from_log(inputs.records(), *inputs.resolution()))


def candidates_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of the log refreshes the candidates the first half left."""
    inputs = Inputs(spark, sf_dir)
    first, second = _halves(inputs)
    orders, sources, customers, settings, now = inputs.resolution()
    previous = apply.candidates_from_log(first, orders, sources, customers, settings, now)
    stage = resolve.staged(second, orders, sources, customers, settings, now)
    return _candidate_view(apply.refreshed_candidates(previous, stage))


def _halves(inputs: Inputs) -> tuple[DataFrame, DataFrame]:
    records = inputs.records_in(2)
    return records.filter(F.col("batch_no") == 0), records.filter(F.col("batch_no") == 1)


def _candidate_view(candidates: DataFrame) -> DataFrame:
    return shown(candidates.drop("updated_at"))


def replay_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = apply.replay_order(_stage(Inputs(spark, sf_dir), positions=True))
    return shown(
        numbered.select(
            "batch_no", "order_source_id", "order_id", "customer_id", "op_type", "created_at",
            "replay_no",
        )
    )


def links_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    return shown(
        apply.links_from_log(inputs.records(), *inputs.resolution()).select(*LINK_VIEW)
    )


def links_ms_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with instants compared to the millisecond."""
    inputs = Inputs(spark, sf_dir)
    links = apply.links_from_log(inputs.records(), *inputs.resolution(), precision="ms")
    return shown(links.select(*LINK_VIEW))


def links_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half of the log replayed onto the links the first half left."""
    inputs = Inputs(spark, sf_dir)
    first, second = _halves(inputs)
    previous = apply.links_from_log(first, *inputs.resolution())
    stage = resolve.staged(second, *inputs.resolution(), positions=True)
    return shown(apply.replayed_links(previous, stage).select(*LINK_VIEW))


def cdc_second_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links whose fate depends on whether instants are seconds or milliseconds."""
    inputs = Inputs(spark, sf_dir)
    links = apply.links_by_precision(inputs.records(), *inputs.resolution())
    return links.filter(~F.col("by_second").eqNullSafe(F.col("by_ms")))


def flush_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """The tables of a flush under each other, on their common columns."""

    def view(name: str, rows: DataFrame) -> DataFrame:
        kinds = {"order_source_id": "int", "customer_source_id": "int", "link_score": "int"}
        if "table_name" not in rows.columns:
            rows = rows.withColumn("table_name", F.lit(name))
        return rows.select(
            *[
                F.col(c) if c in rows.columns else F.lit(None).cast(kinds.get(c, "string")).alias(c)
                for c in FLUSH_COLUMNS
            ]
        )

    return shown(reduce(DataFrame.unionByName, [view(n, rows) for n, rows in tables.items()]))


def customer_rows(customers: DataFrame) -> DataFrame:
    """Backfilled customers under the column names of the link tables."""
    return customers.select(
        F.col("source_id").alias("customer_source_id"),
        F.col("id").alias("customer_id"),
        F.col("resolution_state").alias("audit_action"),
        "created_at",
    )


def _flushed(inputs: Inputs, records: DataFrame) -> dict[str, DataFrame]:
    """The tables after all batches, derived from one stored stage."""
    stage = stored(resolve.staged(records, *inputs.resolution(), positions=True))
    distinct = resolve.distinct_records(records)
    missing = resolve.missing_customers(distinct, inputs.customers, SETTINGS, applied_at())
    return {
        "customers": customer_rows(missing),
        "candidates": apply.last_batch_of(apply.candidate_rows(stage)),
        "histories": _histories(stage),
        "links": apply.standing_links(apply.last_operations(stage)),
    }


def _histories(stage: DataFrame) -> DataFrame:
    """Both histories from one pass over the stage: an insert is a row of each."""
    both = F.array(F.lit("links_history"), F.lit("candidates_history"))
    one = F.array(F.lit("links_history"))
    rows = apply.link_history_rows(stage)
    insert = F.col("audit_action") == ACTION_INSERT
    return rows.withColumn("table_name", F.explode(F.when(insert, both).otherwise(one)))


def flush_end_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five tables after every batch of the log."""
    inputs = Inputs(spark, sf_dir)
    return flush_tables(_flushed(inputs, inputs.records()))


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    tables = _flushed(inputs, inputs.records())
    catalog = inputs.customers.select("id").unionByName(
        tables["customers"].select(F.col("customer_id").alias("id"))
    )
    rows = [
        tables["links"].select(F.lit("links").alias("table_name")),
        tables["histories"].filter(F.col("table_name") == "links_history").select("table_name"),
        tables["candidates"].select(F.lit("candidates").alias("table_name")),
        catalog.select(F.lit("customers").alias("table_name")),
    ]
    return reduce(DataFrame.unionByName, rows).groupBy("table_name").agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        backfill_customers, stage_batch, candidates_history, links_history, candidates_bulk,
        candidates_refresh, replay_order, links_current, links_ms_precision, links_incremental,
        cdc_second_precision, flush_end_state, table_counts,
    )
}

_CREATED = instant_text("created_at")
_STAGED = f"""order_id, order_source_id, order_source_name, order_status, customer_id,
    customer_source_id, customer_source_name, link_score, link_rating, link_method,
    source_customer_ref, {_CREATED}, op_type, batch_no"""
_CANDIDATE = f"""order_source_id, order_id, customer_source_id, customer_id, link_score, link_rating,
    link_method, 'CDC_INSERT' AS audit_action, 'DONE' AS audit_action_status, {_CREATED}"""
_LINK = f"""order_source_id, order_id, customer_source_id, customer_id, 'CDC_INSERT' AS audit_action,
    link_score, link_rating, link_method, {_CREATED}"""
_ACTION = "CASE op_type WHEN 'D' THEN 'CDC_DELETE' ELSE 'CDC_INSERT' END AS audit_action"


def flush_sql(repeat: str = "1") -> str:
    """The tables of a flush; ``repeat`` tells how often the histories hold each row."""
    key = "order_source_id, order_id, customer_source_id, customer_id"
    return f"""
        SELECT 'customers' AS table_name, CAST(NULL AS INT) AS order_source_id,
               CAST(NULL AS VARCHAR) AS order_id, 12 AS customer_source_id, id AS customer_id,
               'PENDING' AS audit_action, CAST(NULL AS INT) AS link_score, {_CREATED}
        FROM backfill
        UNION ALL
        SELECT 'candidates', {key}, 'CDC_INSERT', link_score, {_CREATED} FROM candidates
        UNION ALL
        SELECT 'candidates_history', {key}, 'CDC_INSERT', link_score, {_CREATED}
        FROM stage, range({repeat}) WHERE op_type = 'I'
        UNION ALL
        SELECT 'links', {key}, 'CDC_INSERT', link_score, {_CREATED} FROM links
        UNION ALL
        SELECT 'links_history', {key}, {_ACTION}, link_score, {_CREATED}
        FROM stage, range({repeat})"""


ORACLE = {
    "backfill_customers": query(f"""
        SELECT id, customer_hash, external_customer_id, 12 AS source_id, 'catalog' AS source_name,
               '' AS customer_name, '' AS country_code, 'PENDING' AS resolution_state, {_CREATED}
        FROM backfill"""),
    "stage_batch": query(f"SELECT {_STAGED} FROM stage"),
    "candidates_history": query(f"SELECT {_CANDIDATE}, batch_no FROM stage WHERE op_type = 'I'"),
    "links_history": query(f"""
        SELECT order_source_id, order_id, customer_source_id, customer_id, {_ACTION},
               'DONE' AS audit_action_status, link_score, link_rating, link_method, {_CREATED}, batch_no
        FROM stage"""),
    "candidates_bulk": query(f"SELECT {_CANDIDATE} FROM candidates"),
    "candidates_refresh": query(f"SELECT {_CANDIDATE} FROM candidates", cut=by_parts(2)),
    "replay_order": query(f"""
        SELECT batch_no, order_source_id, order_id, customer_id, op_type, {_CREATED},
               row_number() OVER (
                   PARTITION BY batch_no, order_source_id, order_id
                   ORDER BY s.created_at, CASE op_type WHEN 'D' THEN 1 ELSE 2 END,
                            position, customer_id NULLS FIRST) AS replay_no
        FROM (SELECT batch_no, order_source_id, order_id, customer_id, source_customer_ref, op_type,
                     created_at, max(row(op_ts, kafka_partition, kafka_offset)) AS position
              FROM positioned_stage GROUP BY ALL) s"""),
    "links_current": query(f"SELECT {_LINK} FROM links"),
    "links_ms_precision": query(f"SELECT {_LINK} FROM links", instant="op_ts"),
    "links_incremental": query(f"SELECT {_LINK} FROM links", cut=by_parts(2)),
    "cdc_second_precision": query("""
        SELECT order_source_id, order_id, s.customer_id AS by_second, m.customer_id AS by_ms
        FROM links s
        FULL JOIN (SELECT * FROM (
            SELECT *, row_number() OVER (
                PARTITION BY order_source_id, order_id
                ORDER BY batch_no DESC, op_ts DESC, CASE op_type WHEN 'D' THEN 1 ELSE 2 END DESC,
                         kafka_partition DESC, kafka_offset DESC, customer_id DESC NULLS LAST) AS n
            FROM positioned_stage) WHERE n = 1 AND op_type = 'I') m
        USING (order_source_id, order_id)
        WHERE s.customer_id IS DISTINCT FROM m.customer_id"""),
    "flush_end_state": query(flush_sql()),
    "table_counts": query("""
        SELECT 'links' AS table_name, count(*) AS n FROM links
        UNION ALL SELECT 'links_history', count(*) FROM stage
        UNION ALL SELECT 'candidates', count(*) FROM candidates
        UNION ALL SELECT 'customers', (SELECT count(*) FROM customers_reference)
                                      + (SELECT count(*) FROM backfill)"""),
}
