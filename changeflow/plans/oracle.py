"""The derived relations once more, in the SQL of the checking engine.

``query(body, ...)`` prefixes a statement with the relations it names, in order of
need. Nothing here shares code with the operators it checks.
"""

from __future__ import annotations

import re

_RELATIONS = {
    "raw": """
        SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events""",
    "order_log": """
        SELECT CAST(user_id % 3 AS INT) AS kafka_partition, event_id AS kafka_offset,
               CASE WHEN k = 5 THEN 'NEW-' || lpad(CAST(user_id AS VARCHAR), 12, '0')
                    WHEN k <> 7 THEN 'ORD-' || lpad(CAST(user_id AS VARCHAR), 12, '0') END AS order_id,
               CASE WHEN k = 13 THEN NULL
                    WHEN k IN (21, 22) THEN ' ' || ref || ' '
                    ELSE ref END AS customer_ref,
               CASE WHEN k < 34 THEN 'web' WHEN k < 67 THEN 'phone' ELSE 'partner-api' END AS channel_id,
               CASE event_type WHEN 'view' THEN 'CONFIRMED' WHEN 'click' THEN 'PICKING'
                    WHEN 'signup' THEN NULL ELSE 'SHIPPED' END AS status,
               strftime(ts, '%Y-%m-%d') AS event_date,
               CASE WHEN k = 31 THEN NULL WHEN k >= 75 THEN 'A' ELSE 'M' END AS link_origin,
               CASE event_type WHEN 'error' THEN 'D' WHEN 'purchase' THEN 'U' ELSE 'I' END AS op_type,
               epoch_ms(date_trunc('day', ts)::TIMESTAMP) + k * 30 AS op_ts,
               epoch_ms(date_trunc('day', ts)::TIMESTAMP) + k * 30 + k AS current_ts, k
        FROM (SELECT *, 'CUST-' || lpad(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), 6, '0') AS ref
              FROM raw)""",
    "line_log": """
        SELECT CAST(l_orderkey % 3 AS INT) AS kafka_partition,
               CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT)
                   * 100000000000000 + l_partkey * 100 + l_linenumber AS kafka_offset,
               'ORD-' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS order_id,
               l_linenumber AS line_number,
               CASE WHEN l_tax > 0 THEN 'P-' || CAST(l_partkey AS VARCHAR) END AS product_ref,
               CASE WHEN l_discount > 0 THEN CAST(l_quantity AS INT) END AS quantity,
               CAST(l_extendedprice AS DECIMAL(12, 2)) AS unit_price,
               CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'I' END AS op_type
        FROM lineitem""",
    "customer_log": """
        SELECT c_custkey AS kafka_offset,
               'CUST-' || lpad(CAST(CAST(floor(abs(c_acctbal) / 50) AS BIGINT) AS VARCHAR), 6, '0')
                   AS customer_ref,
               CASE WHEN c_nationkey <> 7 THEN c_name END AS customer_name,
               'N' || CAST(c_nationkey AS VARCHAR) AS country_code,
               c_mktsegment AS segment,
               CASE WHEN c_nationkey = 11 THEN 'D' ELSE 'I' END AS op_type
        FROM customer""",
    "sources_reference": """
        SELECT * FROM (VALUES (1, 'storefront', 'operational-web'),
                              (2, 'call_center', 'operational-phone'),
                              (12, 'catalog', 'master-catalog')) AS s(id, source_name, source_type)""",
    "orders_reference": """
        SELECT 'ORD-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS id,
               source_id, s.source_name, o_orderstatus AS order_status,
               CAST(o_orderdate AS DATE) AS order_date
        FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN 12 WHEN o_orderpriority = '1-URGENT' THEN 2
                             WHEN o_orderpriority = '5-LOW' THEN 12 ELSE 1 END AS source_id FROM orders
              UNION ALL
              SELECT *, 2 FROM orders WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus <> 'P') o
        JOIN sources_reference s ON s.id = o.source_id""",
    "customers_reference": """
        SELECT md5('catalog|' || ref || '|') AS id, ref AS external_customer_id,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 12 ELSE 1 END AS source_id,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'catalog' ELSE 'storefront' END AS source_name
        FROM (SELECT *, 'CUST-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS ref FROM customer)
        UNION ALL
        SELECT md5('legacy|' || ref || '|'), ref, 12, 'catalog'
        FROM (SELECT *, 'CUST-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS ref FROM customer)
        WHERE c_mktsegment = 'BUILDING' AND c_nationkey < 12""",
    "relevant": """
        SELECT * FROM order_log
        WHERE order_id IS NOT NULL AND op_type IN ('I', 'D')
          AND NOT (op_type = 'I' AND link_origin IS NOT DISTINCT FROM 'A')""",
    "records": """
        SELECT *, date_trunc('second', make_timestamp(op_ts * 1000)) AS op_timestamp,
               {cut} AS batch_no
        FROM relevant""",
    "backfill": """
        SELECT md5('catalog|' || customer_ref || '|') AS id,
               md5('[''catalog'', ''' || customer_ref || ''']') AS customer_hash,
               customer_ref AS external_customer_id, min(op_timestamp) AS created_at
        FROM (SELECT *, min(batch_no) OVER (PARTITION BY customer_ref) AS first_batch FROM records
              WHERE customer_ref IS NOT NULL) r
        WHERE batch_no = first_batch
          AND NOT EXISTS (SELECT 1 FROM customers_reference c
                          WHERE c.source_id = 12 AND c.id = md5('catalog|' || r.customer_ref || '|'))
        GROUP BY customer_ref""",
    "catalog_rows": """
        SELECT id, external_customer_id, source_id, source_name FROM customers_reference
        UNION ALL
        SELECT id, external_customer_id, 12, 'catalog' FROM backfill""",
    "positioned_stage": """
        SELECT o.id AS order_id, o.source_id AS order_source_id, o.source_name AS order_source_name,
               o.order_status, c.id AS customer_id, c.source_id AS customer_source_id,
               c.source_name AS customer_source_name, 2 AS link_score, -1 AS link_rating,
               'manual' AS link_method, r.customer_ref AS source_customer_ref,
               r.op_timestamp AS created_at, r.op_type, r.batch_no,
               r.op_ts, r.kafka_partition, r.kafka_offset
        FROM records r
        JOIN orders_reference o ON o.id = r.order_id
         AND o.source_id IN (SELECT id FROM sources_reference WHERE source_type LIKE '%operational%')
        LEFT JOIN catalog_rows c ON c.source_id = 12 AND c.external_customer_id = r.customer_ref""",
    "stage": """
        SELECT DISTINCT order_id, order_source_id, order_source_name, order_status, customer_id,
               customer_source_id, customer_source_name, link_score, link_rating, link_method,
               source_customer_ref, created_at, op_type, batch_no
        FROM positioned_stage""",
    "links": """
        SELECT * FROM (
            SELECT *, row_number() OVER (
                PARTITION BY order_source_id, order_id
                ORDER BY batch_no DESC, {instant} DESC,
                         CASE op_type WHEN 'D' THEN 1 ELSE 2 END DESC,
                         op_ts DESC, kafka_partition DESC, kafka_offset DESC,
                         customer_id DESC NULLS LAST) AS place
            FROM positioned_stage)
        WHERE place = 1 AND op_type = 'I'""",
    "candidates": """
        SELECT s.* FROM stage s
        JOIN (SELECT order_source_id, order_id, max(batch_no) AS last_batch FROM stage
              WHERE op_type = 'I' GROUP BY ALL) l
          ON l.order_source_id = s.order_source_id AND l.order_id = s.order_id
         AND l.last_batch = s.batch_no
        WHERE s.op_type = 'I'""",
    "latest_orders": """
        SELECT order_id, customer_ref, channel_id, status, event_date, link_origin, op_type
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY kafka_offset DESC) AS place
              FROM order_log WHERE order_id IS NOT NULL)
        WHERE place = 1 AND op_type <> 'D'""",
    "latest_lines": """
        SELECT order_id, line_number, product_ref, quantity, unit_price
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_number
                                           ORDER BY kafka_offset DESC) AS place
              FROM line_log)
        WHERE place = 1 AND op_type <> 'D'""",
    "latest_customers": """
        SELECT customer_ref, customer_name, country_code, segment
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_ref ORDER BY kafka_offset DESC) AS place
              FROM customer_log)
        WHERE place = 1 AND op_type <> 'D'""",
    "line_texts": """
        SELECT *, coalesce(CAST(line_number AS VARCHAR), '~') || '/' || coalesce(product_ref, '~') || '/'
               || coalesce(CAST(quantity AS VARCHAR), '~') || '/'
               || coalesce(CAST(unit_price AS VARCHAR), '~') AS line
        FROM line_log""",
    "lines_by_order": """
        SELECT order_id, 0::BIGINT AS lines_part, string_agg(line, ';' ORDER BY kafka_offset) AS lines,
               CAST(CAST(coalesce(sum(quantity * unit_price), 0) AS DECIMAL(38, 2)) AS VARCHAR)
                   AS order_total
        FROM line_texts GROUP BY order_id
        HAVING arg_max(op_type, kafka_offset) <> 'D'""",
    "customer_refs": """
        SELECT order_id, 0::BIGINT AS refs_part,
               coalesce(string_agg(DISTINCT trim(customer_ref), ';' ORDER BY trim(customer_ref)), '')
                   AS customer_refs
        FROM order_log WHERE order_id IS NOT NULL GROUP BY order_id
        HAVING arg_max(op_type, kafka_offset) <> 'D'""",
    "enriched": """
        SELECT o.order_id AS order_key, o.order_id, o.status, o.event_date, o.channel_id, o.link_origin,
               o.customer_ref, r.customer_refs, c.customer_name, c.country_code,
               c.segment AS customer_segment, l.lines, l.order_total, l.lines_part, r.refs_part
        FROM latest_orders o
        LEFT JOIN latest_customers c ON c.customer_ref = o.customer_ref
        LEFT JOIN lines_by_order l ON l.order_id = o.order_id
        LEFT JOIN customer_refs r ON r.order_id = o.order_id""",
}

#: Batches of the configured size.
BY_SIZE = "kafka_offset // 500"


def by_parts(parts: int) -> str:
    """Cut the log into equally long batches."""
    return f"({parts} * kafka_offset) // (SELECT max(event_id) + 1 FROM events)"


def query(body: str, cut: str = BY_SIZE, instant: str = "created_at") -> str:
    """A statement over the relations above."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name in _RELATIONS:
            if re.search(rf"(FROM|JOIN)\s+{name}\b", text) and name not in needed:
                need(_RELATIONS[name])
                needed.append(name)

    need(body)
    relations = [
        f"{name} AS ({_RELATIONS[name].format(cut=cut, instant=instant)})" for name in needed
    ]
    return f"WITH {', '.join(relations)}\n{body}" if relations else body


def instant_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column.split('.')[-1]}"
