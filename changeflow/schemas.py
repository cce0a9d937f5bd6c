"""Fixed schemas of events and tables. Nothing is ever inferred."""

from __future__ import annotations

import json

from pyspark.sql import types as T

TEXT, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
DATE, TIME = T.DateType(), T.TimestampType()
PRICE, TOTAL = T.DecimalType(12, 2), T.DecimalType(33, 2)


def struct(required: str = "", **columns: T.DataType) -> T.StructType:
    """A struct of named columns, nullable unless listed as required."""
    never_null = set(required.split())
    return T.StructType([T.StructField(n, t, n not in never_null) for n, t in columns.items()])


#: Position of an event in its topic.
POSITION = struct(kafka_partition=INT, kafka_offset=LONG)



def positioned(event: T.StructType) -> T.StructType:
    """An event behind its position."""
    return T.StructType(POSITION.fields + event.fields)


ORDER_EVENT = struct(
    "order_id link_origin op_type op_ts current_ts",
    order_id=TEXT,
    customer_ref=TEXT,
    channel_id=TEXT,
    status=TEXT,
    event_date=TEXT,
    link_origin=TEXT,
    op_type=TEXT,
    op_ts=LONG,
    current_ts=LONG,
)
LINE_EVENT = struct(
    order_id=TEXT,
    line_number=INT,
    product_ref=TEXT,
    quantity=INT,
    unit_price=PRICE,
    op_type=TEXT,
)
CUSTOMER_EVENT = struct(
    customer_ref=TEXT, customer_name=TEXT, country_code=TEXT, segment=TEXT, op_type=TEXT
)

SOURCES = struct(
    "id source_name source_type", id=INT, source_name=TEXT, source_type=TEXT, description=TEXT
)
CUSTOMERS = struct(
    "id customer_hash external_customer_id source_id source_name",
    id=TEXT,
    customer_hash=TEXT,
    external_customer_id=TEXT,
    source_id=INT,
    source_name=TEXT,
    customer_name=TEXT,
    country_code=TEXT,
    resolution_state=TEXT,
    created_at=TIME,
    updated_at=TIME,
)
ORDERS = struct(
    "id source_id",
    id=TEXT,
    external_order_id=TEXT,
    source_id=INT,
    source_name=TEXT,
    order_status=TEXT,
    order_date=DATE,
    created_at=TIME,
    updated_at=TIME,
)
CANDIDATES = struct(
    "order_source_id order_id",
    order_source_id=INT,
    order_id=TEXT,
    customer_source_id=INT,
    customer_id=TEXT,
    link_score=INT,
    link_rating=INT,
    link_method=TEXT,
    audit_action=TEXT,
    audit_action_status=TEXT,
    created_at=TIME,
    updated_at=TIME,
)
LINKS = struct(
    "order_source_id order_id",
    order_source_id=INT,
    order_id=TEXT,
    customer_source_id=INT,
    customer_id=TEXT,
    audit_action=TEXT,
    audit_action_at=TIME,
    audit_action_status=TEXT,
    link_score=INT,
    link_rating=INT,
    link_method=TEXT,
    created_at=TIME,
    updated_at=TIME,
)

ORDER_LINES = T.ArrayType(
    struct(line_number=INT, product_ref=TEXT, quantity=INT, unit_price=PRICE)
)
ENRICHED = struct(
    order_key=TEXT,
    order_id=TEXT,
    status=TEXT,
    event_date=TEXT,
    channel_id=TEXT,
    link_origin=TEXT,
    customer_ref=TEXT,
    customer_refs=T.ArrayType(TEXT),
    customer_name=TEXT,
    country_code=TEXT,
    customer_segment=TEXT,
    lines=ORDER_LINES,
    order_total=TOTAL,
    lines_part=LONG,
    refs_part=LONG,
)

LINES_BY_ORDER = struct(order_id=TEXT, lines_part=LONG, lines=ORDER_LINES, order_total=TOTAL)
CUSTOMER_REFS = struct(order_id=TEXT, refs_part=LONG, customer_refs=T.ArrayType(TEXT))

#: How Avro names these types.
_AVRO_TYPES = {
    TEXT: "string",
    LONG: "long",
    INT: "int",
    DATE: {"type": "int", "logicalType": "date"},
    TIME: {"type": "long", "logicalType": "timestamp-micros"},
}


def _avro_type(kind: T.DataType) -> str | dict:
    if isinstance(kind, T.DecimalType):
        # How Avro writes a decimal.
        logical = {"logicalType": "decimal", "precision": kind.precision, "scale": kind.scale}
        return {"type": "bytes", **logical}
    return _AVRO_TYPES[kind]


def avro_schema(record: T.StructType, name: str, namespace: str) -> str:
    """The Avro record schema of an event; nullable fields default to null."""

    def field(f: T.StructField) -> dict:
        avro_type = _avro_type(f.dataType)
        if f.nullable:
            return {"name": f.name, "type": ["null", avro_type], "default": None}
        return {"name": f.name, "type": avro_type}

    return json.dumps(
        {
            "type": "record",
            "name": name,
            "namespace": namespace,
            "fields": [field(f) for f in record.fields],
        }
    )


#: The name and namespace of the order event, part of its contract.
ORDER_EVENT_AVRO = avro_schema(ORDER_EVENT, "OrderCdcEvent", "com.example.cdc.orders")
LINE_EVENT_AVRO = avro_schema(LINE_EVENT, "OrderLineCdcEvent", "com.example.cdc.orders")
CUSTOMER_EVENT_AVRO = avro_schema(CUSTOMER_EVENT, "CustomerCdcEvent", "com.example.cdc.orders")
