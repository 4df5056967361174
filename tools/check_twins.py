"""Run queries next to their SQL twins and compare columns, types and rows.

    python tools/check_twins.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from punctual.catalog import REGISTRY  # noqa: E402
from punctual.session import build_session  # noqa: E402

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), "" if v is None else v) if not isinstance(v, float) or not math.isnan(v)
                 else (True, "nan", "") for v in row)


def compare(df, relation) -> str | None:
    columns = sorted(df.columns)
    theirs = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    if columns != sorted(theirs):
        return f"columns {columns} != {sorted(theirs)}"
    dtypes = dict(df.dtypes)
    typed = [f"{c}: {dtypes[c]} / {theirs[c]}" for c in columns if TYPES.get(dtypes[c], dtypes[c]) != theirs[c]]
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    place = [relation.columns.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in place) for r in relation.fetchall()), key=key)
    if len(ours) != len(expected):
        return f"rows {len(ours)} != {len(expected)}"
    for a, b in zip(ours, expected):
        if repr(a) != repr(b):
            return f"row {a} != {b}"
    if typed:
        return f"types {typed}"
    return None if ours else "no rows"


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("twins", "local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false",
                                                   "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in args or REGISTRY:
        q = REGISTRY[name]
        start = time.time()
        try:
            df = q.run(spark, sf_dir)
            if q.sql is None:
                problem, kind = (None if df.count() else "no rows"), "rows"
            else:
                problem, kind = compare(df, con.sql(q.sql)), "twin"
        except Exception as error:  # noqa: BLE001
            problem, kind = f"{type(error).__name__}: {str(error)[:600]}", "error"
            if "-v" in os.environ.get("CHECK", ""):
                traceback.print_exc()
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failing of {len(args or REGISTRY)}")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
