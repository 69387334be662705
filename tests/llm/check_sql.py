"""Compare the queries of the package with their SQL twins: ``python tests/llm/check_sql.py [name ...]``."""
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from oracle import connect, table  # noqa: E402


def difference(spark, con, folder, name):
    """None when query and twin agree, else the first rows that differ."""
    from tessera.llm.queries import ORACLES, QUERIES

    df = QUERIES[name](spark, folder)
    got = table(df.columns, [tuple(x) for x in df.collect()])
    if name not in ORACLES:
        return None if got[1] else "no rows"
    cur = con.execute(ORACLES[name])
    want = table([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0] or len(got[1]) != len(want[1]):
        return f"{got[0]} {len(got[1])} against {want[0]} {len(want[1])}"
    odd = [(a, b) for a, b in zip(got[1], want[1]) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return f"{len(odd)} rows differ, first {odd[0]}" if odd else None


if __name__ == "__main__":
    from tessera.llm.queries import QUERIES
    from tessera.session import get_session

    s = get_session("twins", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                            "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    folder = "/root/testdata/sf0.01"
    con = connect(folder)
    for n in sys.argv[1:] or QUERIES:
        start = time.time()
        try:
            said = difference(s, con, folder, n)
        except Exception as e:  # noqa: BLE001
            said = f"error {str(e)[-1800:]}"
        print(n, said or "ok", f"{time.time() - start:.1f}s", flush=True)
