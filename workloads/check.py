"""Run the registered queries beside their SQL and compare rows: ``python -m workloads.check [names]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

from dqspark.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value + 0.0, 6)
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return str(value) if value is not None else None


def row_counter(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(canonical(row[i]) for i in order) for row in rows)


def main(argv: list[str]) -> int:
    from workloads import ORACLES, QUERIES

    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    failed = 0
    for name in argv or list(QUERIES):
        begin = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            mine = row_counter(df.columns, df.collect())
            took = time.time() - begin
            if name not in ORACLES:
                print(f"ROWS {name}: {sum(mine.values())} rows, {took:.1f}s")
                continue
            relation = db.sql(ORACLES[name])
            theirs = row_counter(relation.columns, relation.fetchall())
            if sorted(df.columns) != sorted(relation.columns):
                failed += 1
                print(f"FAIL {name}: columns {sorted(set(df.columns) ^ set(relation.columns))}")
            elif mine != theirs:
                failed += 1
                print(f"FAIL {name}: {sum(mine.values())} rows against {sum(theirs.values())}, {took:.1f}s")
                for side, extra in (("spark", mine - theirs), ("sql", theirs - mine)):
                    for row in sorted(extra, key=str)[:3]:
                        print(f"   {side}: {row}")
                print(f"   columns: {sorted(df.columns)}")
            else:
                print(f"ok   {name}: {sum(mine.values())} rows, {took:.1f}s")
        except Exception as error:  # noqa: BLE001 - reported per query
            failed += 1
            print(f"ERR  {name}: {type(error).__name__} {str(error)[:900]}")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
