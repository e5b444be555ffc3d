"""Run registered queries against their SQL: check_oracles.py FOLDER [NAME...]."""

from __future__ import annotations

import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).parent.parent))

import __spark_entry__ as entry  # noqa: E402
from litscope.session import get_spark  # noqa: E402


# Queries whose method has no SQL; tests/llm holds them against brute force.
NO_SQL = frozenset(
    """op1_pigeonhole_vectors op2_html_layout op4_kernel_language op5_lsh_forest op6_string_tiling
    op7_kd_sharding op8_edit_counts op9_bootstrapped_pii op11_span_alignment pipeline""".split()
)


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in pathlib.Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, connection, folder: str, name: str) -> tuple[bool, str]:
    started = time.time()
    frame = entry.queries()[name](spark, folder)
    ours = normal([tuple(r) for r in frame.collect()], frame.columns)
    took = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return name in NO_SQL, f"no SQL: {len(ours)} rows, {took:.1f} s"
    relation = connection.execute(sql)
    columns = [d[0] for d in relation.description]
    theirs = normal(relation.fetchall(), columns)
    if sorted(columns) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} against {sorted(columns)}"
    if ours == theirs:
        return True, f"equal: {len(ours)} rows, {took:.1f} s"
    only_ours = sorted(set(ours) - set(theirs), key=repr)[:3]
    only_theirs = sorted(set(theirs) - set(ours), key=repr)[:3]
    return False, f"{len(ours)} rows against {len(theirs)}; ours {only_ours}; theirs {only_theirs}"


if __name__ == "__main__":
    source = sys.argv[1]
    session = get_spark("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    tables = duck(source)
    for query in sys.argv[2:] or entry.queries():
        try:
            good, note = compare(session, tables, source, query)
        except Exception as error:
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        print("ok  " if good else "FAIL", query, note, flush=True)
