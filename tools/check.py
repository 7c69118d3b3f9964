"""Compare registered queries with their SQL on the given tables: python tools/check.py [sf_dir] [name part ...]"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
         "TIMESTAMP": "timestamp_ntz"}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _text(v) -> str:
    return "<null>" if v is None else repr(v) if isinstance(v, float) else str(v)


def difference(con: duckdb.DuckDBPyConnection, sql: str, df: DataFrame) -> tuple[int, str | None]:
    """Rows of the result and what differs from the SQL result in names, types or values (None: nothing)."""
    rows = df.collect()
    relation = con.execute(sql)
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in relation.description}
    names, want = [d[0] for d in relation.description], relation.fetchall()
    if sorted(names) != sorted(df.columns):
        return len(rows), f"columns {sorted(df.columns)} against {sorted(names)}"
    types = [f"{f.name}: {f.dataType.simpleString()} against {kinds[f.name]}" for f in df.schema if f.dataType.simpleString() != kinds[f.name]]
    if types:
        return len(rows), f"types {types}"
    order = sorted(names)
    got = sorted(tuple(_text(r[c]) for c in order) for r in rows)
    spots = [names.index(c) for c in order]
    expected = sorted(tuple(_text(r[i]) for i in spots) for r in want)
    if got == expected:
        return len(rows), None
    left, right = set(got), set(expected)
    return len(rows), (f"{len(got)} against {len(expected)} rows of {order}; "
                       f"here {[x for x in got if x not in right][:3]} there {[x for x in expected if x not in left][:3]}")


def main() -> int:
    from registry import ORACLES, QUERIES

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
             # CUT=1 keeps small shuffle partitions apart, so that keys are cut into chunks on small tables too
             .config("spark.sql.adaptive.coalescePartitions.enabled", str("CUT" not in os.environ).lower())
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name, run in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                n, wrong = difference(con, ORACLES[name], run(spark, sf))
            else:
                n, wrong = run(spark, sf).count(), None
        except Exception as e:  # report and go on with the next query
            n, wrong = -1, str(e)[:1500]
        bad += wrong is not None
        label = "FAIL" if wrong else "ok" if name in ORACLES else "rows"
        print(f"{label:4} {name}: {n} rows ({time.time() - start:.1f}s) {wrong or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
