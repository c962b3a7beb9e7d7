"""Compare registered queries with their SQL: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


SAME_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _sortable(row):
    return tuple((v is not None, str(type(v)) if isinstance(v, bool) else "", v if v is not None else 0) for v in row)


def _clean(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_clean(r[i]) for i in order) for r in rows]
    try:
        return sorted(out, key=_sortable)
    except TypeError:
        return sorted(out, key=str)


def compare(got_names, got, want_names, want) -> str | None:
    """None when equal, else what differs."""
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = _rows(got, got_names), _rows(want, want_names)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        close = sum(
            all(
                p == q or (isinstance(p, float) and isinstance(q, float) and math.isclose(p, q, rel_tol=1e-9, abs_tol=1e-9))
                for p, q in zip(x, y)
            )
            for x, y in bad
        )
        return f"{len(bad)} of {len(a)} rows differ ({close} only in the last digits), e.g.\n  {bad[0][0]}\n  {bad[0][1]}"
    types = [
        (n, type(x).__name__, type(y).__name__)
        for n, x, y in zip(sorted(got_names), a[-1] if a else (), b[-1] if b else ())
        if type(x) is not type(y) and None not in (x, y)
    ]
    return f"types {types}" if types else None


def check(spark, con, name, sf_dir) -> tuple[str, int]:
    from __spark_entry__ import QUERIES, SQL

    df = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if name not in SQL:
        return "rows only", len(got)
    types = {r[0]: r[1] for r in con.execute("DESCRIBE " + SQL[name]).fetchall()}
    want = con.execute(SQL[name]).fetchall()
    problem = compare(df.columns, got, list(types), want)
    if problem is None:
        pairs = [(n, t, types[n]) for n, t in df.dtypes if SAME_TYPES.get(t) != types[n]]
        problem = f"types {pairs}" if pairs else None
    return problem or "equal", len(got)


def main(argv):
    from __spark_entry__ import QUERIES
    from sazonal.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session(
        "oracle", spark__master="local[8]", spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            verdict, n = check(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            verdict, n = f"ERROR {type(e).__name__}: {str(e)[:1500]}", -1
        failed += verdict not in ("equal", "rows only")
        print(f"{name}: {verdict} rows={n} {time.time() - started:.1f}s", flush=True)
    print("failed", failed, "of", len(names))


if __name__ == "__main__":
    main(sys.argv[1:])
