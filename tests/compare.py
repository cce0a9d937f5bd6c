"""Run a registered query and its oracle, and compare the rows as multisets."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def spark_rows(frame) -> tuple[list[str], Counter]:
    names = sorted(frame.columns)
    return names, Counter(tuple(r) for r in frame.select(*names).collect())


def oracle_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return [columns[i] for i in order], rows


def differences(frame, connection, sql: str) -> str:
    """Empty when both sides agree."""
    names, ours = spark_rows(frame)
    expected_names, expected = oracle_rows(connection, sql)
    if names != expected_names:
        return f"columns {names} against {expected_names}"
    if ours != expected:
        extra, absent = list((ours - expected).items()), list((expected - ours).items())
        return f"{sum(ours.values())} against {sum(expected.values())} rows; extra {extra[:3]}, absent {absent[:3]}"
    return ""
