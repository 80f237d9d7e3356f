"""Compare registered queries with the SQL that states their result."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(root):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{root}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, int):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (dt.date, dt.timedelta)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


_KINDS = {
    "integer": ("tinyint", "smallint", "int", "integer", "bigint", "hugeint", "ubigint", "uhugeint", "utinyint", "usmallint", "uinteger"),
    "float": ("float", "double"),
    "text": ("string", "varchar"),
    "time": ("timestamp", "timestamp_ntz", "timestamp_ms", "timestamp_ns"),
}


def _kind(name):
    name = str(name).lower()
    for kind, names in _KINDS.items():
        if name in names:
            return kind
    return name.split("(")[0]


def compare(spark, root, query):
    """Return ``(ok, message)`` for one registered query."""
    start = time.time()
    df = query(spark, root)
    got = [tuple(r) for r in df.collect()]
    took = f"{time.time() - start:.1f}s"
    if query.sql is None:
        return True, f"rows={len(got)} (no SQL) {took}"
    con = connect(root)
    rel = con.execute(query.sql)
    described = list(rel.description)
    names = [d[0] for d in described]
    want = rel.fetchall()
    con.close()
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(names)}"
    ours = {f.name: _kind(f.dataType.simpleString()) for f in df.schema.fields}
    theirs = {d[0]: _kind(d[1]) for d in described}
    other = {c: (ours[c], theirs[c]) for c in ours if ours[c] != theirs[c]}
    if other:
        return False, f"kinds (spark, sql): {other}"
    a, b = _rows(df.columns, got), _rows(names, want)
    if len(a) != len(b):
        return False, f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return False, f"first difference: spark {x} / sql {y}"
    return True, f"rows={len(a)} {took}"


if __name__ == "__main__":
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from tidemark.plans.registry import all_queries
    from tidemark.session import build_session

    root, names = sys.argv[1], sys.argv[2:]
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                    "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name, q in all_queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        try:
            ok, text = compare(spark, root, q)
        except Exception as exc:  # report and go on with the next query
            ok, text = False, f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, text, flush=True)
    print("failures:", bad)
