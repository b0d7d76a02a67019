"""Compare registered queries with their SQL in DuckDB.

    python -m tests.oracle /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import tempfile
import time
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(x):
    if x is None:
        return None
    if isinstance(x, float):
        return "nan" if math.isnan(x) else x + 0.0
    if isinstance(x, Decimal):
        return float(x)
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None)
    return x


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))
    return [columns[i] for i in order], out


def compare(df, con, sql):
    """(ok, message)"""
    got_cols, got = normalise(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = normalise([c[0] for c in cur.description], cur.fetchall())
    types = {c[0]: str(c[1]) for c in cur.description}
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return False, f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return False, f"{len(bad)} of {len(got)} rows differ, e.g. {bad[0]}"
    spark_types = dict(df.dtypes)
    pairs = {c: (spark_types[c], types[c]) for c in got_cols}
    kin = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
           "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    odd = {c: p for c, p in pairs.items() if kin.get(p[0]) != p[1]}
    return True, f"{len(got)} rows" + (f"  types {odd}" if odd else "")


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from tidemark.session import clear_scratch, local_session

    spark = local_session(8, **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="oracle-")})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf_dir), entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sqls:
                ok, note = compare(fn(spark, sf_dir), con, sqls[name])
            else:
                rows = fn(spark, sf_dir).collect()
                ok, note = len(rows) > 0, f"{len(rows)} rows, no SQL"
        except Exception as err:  # noqa: BLE001
            ok, note = False, f"{type(err).__name__}: {str(err)[:900]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - start:6.1f}s  {note}", flush=True)
        clear_scratch(spark)
        if not ok:
            failed.append(name)
    print("failed:", failed)
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
