"""Runs queries beside their SQL: ``python tests/oracle.py SF_DIR [NAME...]``; also used by the tests."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402


def plain(v):
    if isinstance(v, float):
        return None if pd.isna(v) else round(v, 6)
    if isinstance(v, pd.Timestamp):
        return str(v.tz_localize(None) if v.tzinfo else v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return None if v is None or v is pd.NaT or v is pd.NA else v


def rows(frame: pd.DataFrame) -> list:
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(plain(v) for v in r) for r in frame.itertuples(index=False, name=None)), key=repr)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'" if p.is_file() else f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}/*.parquet'")
    return con


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con=None) -> str:
    """Empty if equal, else what differs."""
    t = time.time()
    df = query(spark, sf_dir)
    got = df.toPandas()
    took = time.time() - t
    if sql is None:
        print(f"{name}: {len(got)} rows, {took:.1f} s, no SQL", flush=True)
        return ""
    want = (con or connect(sf_dir)).execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"{name}: columns {sorted(got.columns)} {sorted(want.columns)}"
    a, b = rows(got), rows(want)
    print(f"{name}: {len(a)} rows, {took:.1f} s, {'equal' if a == b else 'DIFFERENT'}", flush=True)
    if a != b:
        sa, sb = set(map(repr, a)), set(map(repr, b))
        return f"{name}: {len(a)} and {len(b)} rows; only here {sorted(sa - sb)[:3]}; only in SQL {sorted(sb - sa)[:3]}; dtypes {df.dtypes}"
    return ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from driftmark.session import local_session

    spark, d = local_session(), sys.argv[1]
    con, qs, sql = connect(d), entry.queries(), entry.oracle_sql()
    for n in sys.argv[2:] or qs:
        for m in [k for k in qs if k == n or (n.endswith("*") and k.startswith(n[:-1]))]:
            try:
                if out := compare(spark, d, m, qs[m], sql.get(m), con):
                    print("  !!", out)
            except Exception as e:  # noqa: BLE001
                print(f"  !! {m}: {str(e)[:1500]}")
