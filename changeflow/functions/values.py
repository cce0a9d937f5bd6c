"""Small value expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Audit actions, as fixed values.
ACTION_INSERT = "CDC_INSERT"
ACTION_DELETE = "CDC_DELETE"


def utc_second(epoch_millis: Column) -> Column:
    """Epoch milliseconds floored to the second (also below zero)."""
    return F.date_trunc("second", F.timestamp_millis(epoch_millis))


def op_rank(op_type: Column) -> Column:
    """Deletes sort before inserts of the same instant, anything else after."""
    return F.when(op_type == "D", 1).when(op_type == "I", 2).otherwise(3)


def audit_action(op_type: Column) -> Column:
    """Audit action of an operation; null for operations that are not applied."""
    return F.when(op_type == "D", ACTION_DELETE).when(op_type == "I", ACTION_INSERT)


def trim_controls(text: Column) -> Column:
    """Strip blanks and control characters (up to U+0020) from both ends."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
