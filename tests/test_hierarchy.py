"""The hierarchy of region, nation and segment: one whole tree a region."""
import json

from tessera.operators import aggregates as ag
from tessera.plans import ORACLES, QUERIES


def test_a_region_is_one_row_with_its_whole_tree(spark, tmp_path):
    import duckdb

    customers = [(i, i % 4, f"S{i % 5}") for i in range(200)]  # 15 leaves in EAST, two nations of one name in WEST
    nations = [(0, "A", 0), (1, "B", 0), (2, "C", 0), (3, "D", 1), (4, "D", 1)]
    customers += [(1000 + i, 4, "S1") for i in range(3)] + [(2000, 9, "S1"), (2001, None, "S1")]
    tables = {"customer": (customers, "c_custkey long, c_nationkey int, c_mktsegment string"),
              "nation": (nations, "n_nationkey int, n_name string, n_regionkey int"),
              "region": ([(0, "EAST"), (1, "WEST")], "r_regionkey int, r_name string")}
    con = duckdb.connect()
    for name, (rows, kind) in tables.items():
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = QUERIES["nested_hierarchy"](spark, str(tmp_path))
    assert got.columns == ["r_name", "tree"]
    found = sorted(tuple(r) for r in got.collect())
    assert found == sorted(con.execute(ORACLES["nested_hierarchy"]).fetchall())
    want = {}
    for key, nation, segment in customers:
        if nation in range(5):
            name, region = nations[nation][1], ("EAST", "WEST")[nations[nation][2]]
            leaf = want.setdefault(region, {}).setdefault(name, {}).setdefault(segment, {"n": 0, "top": 0})
            leaf.update(n=leaf["n"] + 1, top=max(leaf["top"], key))
    assert {region: json.loads(tree) for region, tree in found} == want


def test_whole_tree_of_more_leaves_than_a_part(spark):
    df = spark.range(30_000).selectExpr("'a' AS a", "id % 3 AS b", "id AS c", "id AS v")
    tree, = ag.nest_levels(df, ["a", "b", "c"], df.v, part_rows=None).collect()
    assert tree.asDict() == {"a": "a", "tree": {b: {c: c for c in range(b, 30_000, 3)} for b in range(3)}}
