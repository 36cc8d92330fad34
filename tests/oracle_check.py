"""Run registered Spark queries and their DuckDB oracle side by side and compare the results.

    python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive hash of the values (floats compared
exactly). Prints one line per query and a summary; exit code 1 on any mismatch.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canon(v):
    if v is None:
        return "\x00null"
    if isinstance(v, float):
        if math.isnan(v):
            return "\x00null"
        return repr(float(v))
    if hasattr(v, "item"):          # numpy scalar
        return _canon(v.item())
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    return str(v)


def canon_rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("\x01".join(_canon(r[i]) for i in order) for r in rows)


def digest(lines) -> str:
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode("utf-8", "surrogatepass"))
        h.update(b"\n")
    return h.hexdigest()[:16]


def compare(spark, sf_dir: str, names=None, verbose: bool = True):
    import __spark_entry__ as entry
    qs = entry.queries()
    oracle = entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = list(sdf.columns)
        except Exception as e:  # noqa: BLE001
            results[name] = ("spark-error", str(e)[:400])
            print(f"{name:28s} SPARK ERROR {str(e)[:400]}", flush=True)
            continue
        ts = time.time() - t0
        if name not in oracle:
            results[name] = ("rows-only", len(srows))
            print(f"{name:28s} rows-only   rows={len(srows)}  spark {ts:.1f}s", flush=True)
            continue
        try:
            rel = con.sql(oracle[name])
            dcols = list(rel.columns)
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("oracle-error", str(e)[:400])
            print(f"{name:28s} ORACLE ERROR {str(e)[:600]}", flush=True)
            continue
        sl, dl = canon_rows(srows, scols), canon_rows(drows, dcols)
        ok_cols = sorted(scols) == sorted(dcols)
        ok_n = len(srows) == len(drows)
        ok_v = digest(sl) == digest(dl)
        status = "OK" if (ok_cols and ok_n and ok_v) else "MISMATCH"
        results[name] = (status, len(srows), len(drows))
        print(f"{name:28s} {status:8s} rows spark={len(srows)} duck={len(drows)} cols={'ok' if ok_cols else (scols, dcols)}"
              f" values={'ok' if ok_v else 'DIFF'}  spark {ts:.1f}s", flush=True)
        if verbose and status != "OK" and ok_cols:
            a, b = set(sl), set(dl)
            for x in sorted(a - b)[:3]:
                print("   spark only:", x[:300].replace("\x01", " | "))
            for x in sorted(b - a)[:3]:
                print("   duck  only:", x[:300].replace("\x01", " | "))
    return results


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or None
    from trendlens.session import local_session
    spark = local_session(8)
    res = compare(spark, sf_dir, names)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "rows-only")]
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
