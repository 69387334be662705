"""Compare registered queries with DuckDB: ``python tests/oracle.py [name ...]``."""
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def table(columns, data):
    by = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in by], sorted((tuple(norm(r[i]) for i in by) for r in data), key=repr)


def compare(spark, con, folder, name):
    """None when both sides agree, else a description of the first difference."""
    from tessera.plans import ORACLES, QUERIES

    df = QUERIES[name](spark, folder)
    got = table(df.columns, [tuple(x) for x in df.collect()])
    if name not in ORACLES:
        return None if got[1] else "no rows"
    cur = con.execute(ORACLES[name])
    want = table([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows against {len(want[1])}; {got[1][:2]} {want[1][:2]}"
    if not want[1]:
        return "empty result"
    for a, b in zip(got[1], want[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"spark {a}\n      sql {b}"
    return None


if __name__ == "__main__":
    from tessera.plans import QUERIES
    from tessera.session import get_session

    folder = "/root/testdata/sf0.01"
    from tessera.plans import OPERATORS
    args = sys.argv[1:]
    names = [n for n in QUERIES if not args or any(n == a or OPERATORS[n].startswith(a) for a in args)]
    s = get_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for n in names:
        start = time.time()
        try:
            problem = compare(s, con, folder, n)
        except Exception as e:  # noqa: BLE001
            problem = "error " + str(e)[:700]
        took = time.time() - start
        if problem or took > 4:
            print(f"{n} {took:.1f}s {'ok' if not problem else problem}", flush=True)
        bad += bool(problem)
    print(f"{len(names) - bad} of {len(names)} agree")
