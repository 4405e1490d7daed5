"""Connected components of shapes that slow simple propagation down."""
import random

from starlake.llm.components import connected_components


def components(spark, edges):
    rows = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.root, set()).add(r.node)
    return sorted(map(sorted, groups.values()))


def test_path_star_cycle_and_loops(spark):
    path = [(i, i + 1) for i in range(1000, 1300)]
    star = [(0, i) for i in range(1, 200)]
    cycle = [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    edges = path + star + cycle + [(5000, 5000), (None, 3), (3, None), (7, 7)] + star[:20] + [(b, a) for a, b in path[:50]]
    random.Random(2).shuffle(edges)
    assert components(spark, edges) == [list(range(200)), list(range(1000, 1301)), list(range(2000, 2050))]


def test_no_edges(spark):
    assert components(spark, []) == []
