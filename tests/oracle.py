"""Run a query on Spark and its SQL on DuckDB and compare the two results."""

from __future__ import annotations

import pathlib
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def as_rows(columns: list[str], table) -> list[tuple]:
    data = table.to_pydict()
    rows = zip(*[data[c] for c in columns]) if columns else []
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def arrow(result):
    return result.to_arrow_table() if hasattr(result, "to_arrow_table") else result.arrow()


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """Rows found and, when the results differ, how."""
    spark_table = df.toArrow()
    sql_table = arrow(con.sql(sql))
    names = sorted(spark_table.column_names)
    if names != sorted(sql_table.column_names):
        return spark_table.num_rows, f"columns {names} against {sorted(sql_table.column_names)}"
    kinds = []
    for name in names:
        a, b = str(spark_table.schema.field(name).type), str(sql_table.schema.field(name).type)
        a, b = a.replace("large_string", "string"), b.replace("large_string", "string")
        if a != b:
            kinds.append(f"{name}: {a} against {b}")
    if kinds:
        return spark_table.num_rows, "; ".join(kinds)
    ours, theirs = as_rows(names, spark_table), as_rows(names, sql_table)
    if len(ours) != len(theirs):
        extra = sorted(set(map(str, ours)) - set(map(str, theirs)))[:2]
        lack = sorted(set(map(str, theirs)) - set(map(str, ours)))[:2]
        return len(ours), f"{len(ours)} rows against {len(theirs)}; extra {extra}; lacking {lack}"
    for mine, his in zip(ours, theirs):
        if mine != his:
            return len(ours), f"{mine} against {his}"
    return len(ours), None


def main(sf_dir: str, *wanted: str) -> int:
    root = pathlib.Path(__file__).resolve().parents[1]
    sys.path.insert(0, str(root))
    from __spark_entry__ import oracle_sql, queries
    from everkey.session import local_session

    spark, con = local_session(8), connect(sf_dir)
    sql, wrong = oracle_sql(), 0
    for name, query in queries().items():
        if wanted and not any(name.startswith(x) for x in wanted):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            n, problem = compare(df, con, sql[name]) if name in sql else (df.count(), None)
        except Exception as error:
            n, problem = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        wrong += problem is not None
        print(f"{name:32s} {n:8d} {time.time() - start:6.1f}s {'rows only' if name not in sql else ''} {problem or 'ok'}", flush=True)
    print(f"{wrong} wrong")
    return wrong


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
