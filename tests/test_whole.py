"""The whole-table queries without SQL against brute force; test_queries.py holds the others against theirs."""

import math

import duckdb

import __spark_entry__  # noqa: F401  (registers the queries)
from pavestone import registry


def hexagon(x, y, step, size=6.0):
    r = round(y / (1.5 * size))
    near = [(math.hypot(x - step * (q + s / 2), y - 1.5 * size * s), q, s) for s in range(r - 2, r + 3) for q in range(int(x / step - s / 2) - 3, int(x / step - s / 2) + 4)]
    return min(near)[1:]


def test_fill_cells_of_all_areas_and_trees(spark, data):
    got = {r.area_id: r.cells for r in registry.QUERIES["e07_fill_cells"](spark, data).collect()}
    customers = [k for (k,) in duckdb.sql(f"SELECT c_custkey FROM '{data}/customer.parquet'").fetchall()]
    parts = [k for (k,) in duckdb.sql(f"SELECT p_partkey FROM '{data}/part.parquet'").fetchall()]
    step = 6 * math.sqrt(3)
    taken = {hexagon(p * 37 % 1000 * 4.0, p * 91 % 1000 * 4.0, step) for p in parts}
    owner, dropped = {}, 0
    for k in sorted(customers):
        x, y = k * 53 % 1000 * 4.0, k * 29 % 1000 * 4.0
        for r in range(math.ceil(y / 9), math.floor((y + 60) / 9) + 1):
            for q in range(math.ceil(x / step - r / 2), math.floor((x + 80) / step - r / 2) + 1):
                dropped += (q, r) in taken
                if (q, r) not in taken:
                    owner.setdefault((q, r), k)
    want = {k: list(owner.values()).count(k) for k in set(owner.values())}
    assert dropped > 0 and got == want


def test_components_of_all_rows(spark, data):
    got = {r.node: r.component for r in registry.QUERIES["r01_components_whole"](spark, data).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for o, s in duckdb.sql(f"SELECT DISTINCT l_orderkey, -1 - l_suppkey FROM '{data}/lineitem.parquet'").fetchall():
        a, b = find(o), find(s)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in list(parent)}
