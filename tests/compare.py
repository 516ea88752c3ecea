"""Run registered queries beside their SQL twins.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _sorted(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, _sorted([tuple(_plain(r[n]) for n in names) for r in frame.collect()])


def duck_rows(db, sql):
    result = db.execute(sql)
    have = [d[0] for d in result.description]
    names = sorted(have)
    at = [have.index(n) for n in names]
    return names, _sorted([tuple(_plain(r[i]) for i in at) for r in result.fetchall()])


def kinds(frame, db, sql):
    """Column types on both sides, by their DuckDB names."""
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    result = db.execute(f"DESCRIBE {sql}").fetchall()
    return {n: same.get(t, t) for n, t in frame.dtypes}, {r[0]: r[1] for r in result}


def main(sf_dir: str, names: list[str]) -> None:
    import __spark_entry__ as contract
    from termloom.session import local_session

    spark, db = local_session(8), duck(sf_dir)
    queries, oracle = contract.queries(), contract.oracle_sql()
    print("without twin:", sorted(set(queries) - set(oracle)), "stray:", sorted(set(oracle) - set(queries)))
    for name in names or queries:
        start = time.time()
        try:
            frame = queries[name](spark, sf_dir)
            columns, got = spark_rows(frame)
            took = time.time() - start
            if name not in oracle:
                print(f"{name:26s} rows {len(got)} {took:.1f}s", flush=True)
                continue
            expected_columns, expected = duck_rows(db, oracle[name])
            ours, theirs = kinds(frame, db, oracle[name])
            good = columns == expected_columns and got == expected and len(got) > 0
            print(f"{name:26s} {'ok' if good else 'DIFFERENT'} rows {len(got)} {len(expected)} {took:.1f}s"
                  + ("" if ours == theirs else f" types {ours} {theirs}"), flush=True)
            if not good:
                print("   ", columns, expected_columns)
                for a, b in [(a, b) for a, b in zip(got, expected) if a != b][:3]:
                    print("    spark", str(a)[:160], "\n    duck ", str(b)[:160])
        except Exception as problem:  # noqa: BLE001
            print(f"{name:26s} FAILED {type(problem).__name__} {str(problem)[:500]}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001", sys.argv[2:])
