"""Run queries and their SQL side by side: python tests/parity.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from airshed.session import build_session  # noqa: E402

KIND = {
    "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int",
    "BIGINT": "int", "INTEGER": "int", "SMALLINT": "int", "HUGEINT": "hugeint",
    "double": "double", "DOUBLE": "double", "string": "text", "VARCHAR": "text",
    "boolean": "bool", "BOOLEAN": "bool",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return repr(v)


def compare(spark, con, name, sf_dir) -> tuple[bool, str]:
    began = time.time()
    df = entry.queries()[name](spark, sf_dir)
    rows = df.collect()
    took = time.time() - began
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"{len(rows)} rows, no SQL, {took:.2f}s"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(names)}"
    cols = sorted(names)
    bad = [
        (c, df.schema[c].dataType.simpleString(), types[c])
        for c in cols
        if KIND.get(df.schema[c].dataType.simpleString()) != KIND.get(types[c], "?")
    ]
    got = Counter(tuple(norm(r[c]) for c in cols) for r in rows)
    at = [names.index(c) for c in cols]
    exp = Counter(tuple(norm(r[i]) for i in at) for r in want)
    if got != exp:
        a, b = list((got - exp).items())[:2], list((exp - got).items())[:2]
        return False, f"{len(rows)} against {len(want)} rows, types {bad}\n   {cols}\n   spark {a}\n   duck  {b}"
    if bad:
        return False, f"types {bad}"
    return True, f"{len(rows)} rows, {took:.2f}s"


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = []
    for name in chosen:
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        if not ok:
            failed.append(name)
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{len(chosen) - len(failed)} of {len(chosen)} agree; failed: {failed}")
