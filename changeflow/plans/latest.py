"""Queries over latest state, roll-ups and the enriched view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators import enrich
from changeflow.operators import latest as state
from changeflow.operators.compaction import compacted
from changeflow.plans.inputs import Inputs, shown
from changeflow.plans.oracle import by_parts, query


def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest_orders(Inputs(spark, sf_dir).order_log)


def latest_orders_ignore_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest_orders(Inputs(spark, sf_dir).order_log, ignore_nulls=True)


def latest_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = state.latest_order_lines(Inputs(spark, sf_dir).line_log)
    return shown(lines.select("order_line_key.*", *state.LINE_COLUMNS))


#: Up to where the topic is compacted, in thirds of its offsets, and how long tombstones stay.
CLEAN_THIRDS, TOMBSTONE_DAYS = 2, 14


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    log = inputs.order_log
    newest = log.agg(F.max("op_ts")).scalar()
    expired = F.col("op_ts") < newest - TOMBSTONE_DAYS * 24 * 3600 * 1000
    return compacted(log, ["order_id"], inputs.part_of(3) < CLEAN_THIRDS, expired)


def topic_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the order topic once two thirds of it are compacted."""
    return _compacted(spark, sf_dir)


def latest_orders_of_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest orders, read from the compacted topic."""
    return state.latest_orders(_compacted(spark, sf_dir))


def latest_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest_customers(Inputs(spark, sf_dir).customer_log)


def lines_by_order_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(state.lines_by_order(Inputs(spark, sf_dir).line_log))


def lines_by_order_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(state.lines_by_order(Inputs(spark, sf_dir).line_log, mode="current"))


def lines_by_order_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of two lines each, so that most orders have several parts."""
    return shown(state.lines_by_order(Inputs(spark, sf_dir).line_log, chunk=2))


def order_lines_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each line event, with its position in the order."""
    lines = state.order_lines(Inputs(spark, sf_dir).line_log)
    return shown(lines.select("order_id", "position", "line_number", *state.LINE_COLUMNS))


def order_customer_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(state.order_customer_refs(Inputs(spark, sf_dir).order_log))


def orders_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = Inputs(spark, sf_dir)
    return shown(
        enrich.enriched_from_logs(inputs.order_log, inputs.customer_log, inputs.line_log)
    )


def orders_enriched_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and references of the view in parts of two, each told one by one."""
    inputs = Inputs(spark, sf_dir)
    view = enrich.enriched_from_logs(
        inputs.order_log, inputs.customer_log, inputs.line_log, chunk=2
    )
    # told in one pass: the view is not computed once for each of the three
    lines = F.transform("lines", lambda x: _told("line", x["line_number"].cast("string")))
    refs = F.transform("customer_refs", lambda ref: _told("ref", ref))
    total = F.when(F.col("order_total").isNotNull(), F.array(_told("total", F.col("order_total").cast("string"))))
    told = F.flatten(F.array_compact(F.array(lines, refs, total)))
    return view.select("order_id", F.explode(told).alias("x")).select("x.what", "order_id", "x.shown")


def _told(what: str, shown: Column) -> Column:
    return F.struct(F.lit(what).alias("what"), shown.alias("shown"))


QUERIES = {
    f.__name__: f
    for f in (
        latest_orders, latest_orders_ignore_nulls, latest_order_lines, latest_customers, topic_compacted, latest_orders_of_compacted,
        lines_by_order_changelog, lines_by_order_current, lines_by_order_chunked, order_lines_long,
        order_customer_refs, orders_enriched, orders_enriched_chunked,
    )
}


def _last_value(column: str) -> str:
    return f"arg_max({column}, kafka_offset) FILTER (WHERE {column} IS NOT NULL) AS {column}"


ORACLE = {
    "latest_orders": query("SELECT * FROM latest_orders"),
    "latest_orders_ignore_nulls": query(f"""
        SELECT order_id, {", ".join(_last_value(c) for c in (*state.ORDER_COLUMNS, "op_type"))}
        FROM order_log WHERE order_id IS NOT NULL GROUP BY order_id
        HAVING arg_max(op_type, kafka_offset) <> 'D'"""),
    "latest_order_lines": query("""
        SELECT order_id, line_number, product_ref, quantity, CAST(unit_price AS VARCHAR) AS unit_price
        FROM latest_lines"""),
    "latest_customers": query("SELECT * FROM latest_customers"),
    "lines_by_order_changelog": query("SELECT * FROM lines_by_order"),
    "lines_by_order_current": query("""
        SELECT order_id, 0::BIGINT AS lines_part,
               string_agg(line_number || '/' || coalesce(product_ref, '~') || '/'
                          || coalesce(CAST(quantity AS VARCHAR), '~') || '/'
                          || CAST(unit_price AS VARCHAR), ';' ORDER BY line_number) AS lines,
               CAST(CAST(coalesce(sum(quantity * unit_price), 0) AS DECIMAL(38, 2)) AS VARCHAR)
                   AS order_total
        FROM latest_lines GROUP BY order_id"""),
    "lines_by_order_chunked": query("""
        SELECT order_id, lines_part, string_agg(line, ';' ORDER BY kafka_offset) AS lines,
               CASE WHEN lines_part = 0 THEN max(order_total) END AS order_total
        FROM (SELECT *, (row_number() OVER (PARTITION BY order_id ORDER BY kafka_offset) - 1) // 2
                     AS lines_part FROM line_texts)
        JOIN (SELECT order_id, order_total FROM lines_by_order) USING (order_id)
        GROUP BY order_id, lines_part"""),
    "order_lines_long": query("""
        SELECT order_id, line_number, product_ref, quantity, CAST(unit_price AS VARCHAR) AS unit_price,
               row_number() OVER (PARTITION BY order_id ORDER BY kafka_offset) - 1 AS position
        FROM line_log WHERE order_id IS NOT NULL"""),
    "orders_enriched_chunked": query("""
        SELECT 'line' AS what, order_id, CAST(line_number AS VARCHAR) AS shown
        FROM line_log JOIN (SELECT order_id FROM lines_by_order) USING (order_id)
        JOIN (SELECT order_id FROM latest_orders) USING (order_id)
        UNION ALL
        SELECT DISTINCT 'ref', order_id, trim(customer_ref) FROM order_log
        JOIN (SELECT order_id FROM customer_refs) USING (order_id)
        JOIN (SELECT order_id FROM latest_orders) USING (order_id)
        WHERE customer_ref IS NOT NULL
        UNION ALL
        SELECT 'total', order_id, order_total FROM enriched WHERE order_total IS NOT NULL"""),
    "order_customer_refs": query("SELECT * FROM customer_refs"),
    "orders_enriched": query("SELECT * FROM enriched"),
    "topic_compacted": query(f"""
        SELECT * EXCLUDE (k, clean, place, newest) FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id, clean ORDER BY kafka_offset DESC) AS place
            FROM (SELECT *, {by_parts(3)} < {CLEAN_THIRDS} AS clean, max(op_ts) OVER () AS newest FROM order_log)
        ) WHERE NOT clean
             OR order_id IS NOT NULL AND place = 1
                AND NOT (op_type = 'D' AND op_ts < newest - {TOMBSTONE_DAYS} * 24 * 3600 * 1000::BIGINT)"""),
    "latest_orders_of_compacted": query("SELECT * FROM latest_orders"),
}
