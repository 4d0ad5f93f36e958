"""Compare registered queries with their DuckDB text on the same Parquet files."""

from __future__ import annotations

import math
import sys
import time

from sampleloom.plans import registry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _order(row: tuple) -> tuple:
    return tuple((v is None, v) for v in row)


def compare(spark, con, key: str, sf_dir: str) -> tuple[str, int]:
    """``('ok', rows)`` or a text that says what differs."""
    df = registry.QUERIES[key](spark, sf_dir)
    got = sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=_order)
    if key not in registry.ORACLES:
        return "rows only", len(got)
    rel = con.sql(registry.ORACLES[key])
    types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    if sorted(types) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(types)}", len(got)
    bad = [(c, t, types[c]) for c, t in df.dtypes if t != {"varchar": "string", "integer": "int"}.get(
        types[c].lower(), types[c].lower())]
    if bad:
        return f"types {bad}", len(got)
    cols = ", ".join(f'"{c}"' for c in sorted(types))
    want = sorted(rel.project(cols).fetchall(), key=_order)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; {got[:2]} {want[:2]}", len(got)
    for g, x in zip(got, want):
        for a, b in zip(g, x):
            same = a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b)) or (
                a is None and b is None)
            if not same:
                return f"values {g} != {x}", len(got)
    return "ok", len(got)


def main(argv: list[str]) -> int:
    import duckdb

    from sampleloom.session import build_session

    sf_dir = argv[0]
    registry.load()
    keys = [k for k in registry.QUERIES if not argv[1:] or any(a in k for a in argv[1:])]
    spark = build_session("check", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    failed = 0
    for k in keys:
        t0 = time.time()
        try:
            said, n = compare(spark, con, k, sf_dir)
        except Exception as e:  # report and go on with the next query
            said, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        failed += said not in ("ok", "rows only")
        print(f"{'' if said in ('ok', 'rows only') else 'FAIL '}{k}: {said[:900]} [{n} rows, {time.time() - t0:.1f}s]", flush=True)
    print(f"{len(keys)} queries, {failed} failed", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
