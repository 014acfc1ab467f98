"""Comparison of a query's rows with its SQL's rows in DuckDB. Run as a script to check queries by name.

    python tests/compare.py [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
DATA = Path("/root/testdata")


def connect(folder: str):
    con = duckdb.connect()
    for f in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _text(v) -> str:
    if v is None:
        return "<null>"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "<nan>" if math.isnan(v) else f"d:{v + 0.0:.6f}"
    if isinstance(v, int):
        return f"i:{v}"
    if isinstance(v, decimal.Decimal):
        return f"dec:{v}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_text(x) for x in v) + "]"
    return str(v)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    return cols, sorted(tuple(_text(v) for v in r) for r in df.select(*cols).toLocalIterator())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    con.execute(sql)
    names = [d[0] for d in con.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_text(r[i]) for i in order) for r in con.fetchall())


def difference(left, right) -> str | None:
    (lc, lr), (rc, rr) = left, right
    if lc != rc:
        return f"columns {sorted(set(lc) ^ set(rc))}"
    if len(lr) != len(rr):
        return f"rows {len(lr)} != {len(rr)}; e.g. {lr[:2]} / {rr[:2]}"
    bad = [(a, b) for a, b in zip(lr, rr) if a != b]
    if bad:
        a, b = bad[0]
        return f"{len(bad)} of {len(lr)} rows differ: " + "; ".join(f"{c}: {x} != {y}" for c, x, y in zip(lc, a, b) if x != y)
    return None


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="0.01")
    args = ap.parse_args()
    import __spark_entry__ as e
    from forecastops.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = str(DATA / f"sf{args.sf}")
    con = connect(folder)
    con.execute("SET TimeZone='UTC'")
    oracles, bad = e.oracle_sql(), 0
    for name, run in e.queries().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        t = time.time()
        try:
            got = spark_rows(run(spark, folder))
            took = time.time() - t
            result = difference(got, duck_rows(con, oracles[name])) if name in oracles else "(no SQL)"
            ok = result is None or result == "(no SQL)"
            print(f"{'ok ' if ok else 'BAD'} {name} {len(got[1])} rows {took:.1f}s {result or ''}"[:700], flush=True)
        except Exception as err:  # noqa: BLE001
            ok = False
            print(f"ERR {name} {type(err).__name__}: {str(err)[:600]}", flush=True)
            if "-v" in sys.argv:
                traceback.print_exc()
        bad += not ok
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
