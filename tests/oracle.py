"""Run registered queries next to their SQL twins: ``python -m tests.oracle sf0.01 [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from rollweave.plans import registry


def norm(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if hasattr(value, "as_tuple"):
        return float(f"{float(value):.9g}")
    if hasattr(value, "isoformat"):
        return value.isoformat()[:26]
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def connect(root: str):
    con = duckdb.connect()
    for table in registry.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{root}/{table}.parquet'")
    return con


def compare(spark, con, root: str, name: str) -> tuple[bool, str]:
    spec = registry.load()[name]
    df = registry.queries()[name](spark, root)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if not spec.sql:
        return len(got) > 0, f"rows only: {len(got)}"
    rel = con.execute(spec.sql)
    columns = [d[0] for d in rel.description]
    want = rows_of(columns, rel.fetchall())
    if sorted(df.columns) != sorted(columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got == want:
        return len(got) > 0, f"{len(got)} rows"
    only_got = [r for r in got if r not in set(want)][:3]
    only_want = [r for r in want if r not in set(got)][:3]
    return False, f"{len(got)} vs {len(want)} rows\n   spark {str(only_got)[:700]}\n   sql   {str(only_want)[:700]}"


def main() -> int:
    from rollweave.session import local_session

    root = f"/root/testdata/{sys.argv[1]}"
    names = sys.argv[2:]
    specs = registry.load()
    names = [n for n in specs if not names or any(n.startswith(p.rstrip("*")) if p.endswith("*") else n == p or specs[n].run.__module__.endswith(p) for p in names)]
    spark, con, bad = local_session(), connect(root), []
    for name in names:
        start = time.time()
        try:
            ok, note = compare(spark, con, root, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:900]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(names) - len(bad)}/{len(names)} ok; failed: {bad}")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
