"""Compare registered queries with their SQL: columns, types, rows and values."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def canonical(frame) -> list[str]:
    columns = sorted(frame.columns)
    return sorted(repr(tuple(row)) for row in frame[columns].astype(object).itertuples(index=False))


SPARK_TO_SQL = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "tinyint": "TINYINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def compare(spark_df, connection, sql: str) -> list[str]:
    """Differences as text; empty when both sides agree exactly."""
    result = connection.sql(sql)
    sql_types = dict(zip(result.columns, [str(t) for t in result.types]))
    spark_types = {f.name: SPARK_TO_SQL.get(f.dataType.simpleString()) for f in spark_df.schema}
    problems = []
    if spark_types != sql_types:
        odd = set(spark_types.items()) ^ set(sql_types.items())
        problems.append(f"types differ: {sorted(odd, key=str)}")
    if set(spark_types) != set(sql_types):
        return problems
    rows = {tuple(sorted(spark_types)): None}
    columns = list(rows)[0]
    mine = sorted(repr(tuple(row[c] for c in columns)) for row in spark_df.collect())
    order = [list(sql_types).index(c) for c in columns]
    theirs = sorted(repr(tuple(row[i] for i in order)) for row in connection.execute(sql).fetchall())
    if mine != theirs:
        extra = sorted(set(mine) - set(theirs))[:3]
        lost = sorted(set(theirs) - set(mine))[:3]
        problems.append(f"rows {len(mine)} vs {len(theirs)}; only spark {extra}; only sql {lost}")
    return problems


def main(sf_dir: str, only: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry_points
    from hourgrid.session import build_session

    spark = build_session(
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    queries, sql = entry_points.queries(), entry_points.oracle_sql()
    failed = 0
    print("sql without query:", sorted(set(sql) - set(queries)))
    for name, build in queries.items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            df = build(spark, sf_dir)
            if name in sql:
                problems = compare(df, connection, sql[name])
            else:
                problems = [] if df.collect() else ["no rows"]
        except Exception as error:  # noqa: BLE001 - a report, not a library
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        kind = "sql" if name in sql else "rows only"
        print(f"{'FAIL' if problems else 'ok':4} {time.time() - started:6.2f}s {name} ({kind})")
        for problem in problems:
            print("     ", problem)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
