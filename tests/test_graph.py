import random

import pytest
from pyspark.sql import functions as F

from sightline.graph import Graph
from sightline.graph import build
from sightline.graph.components import connected_components, strong_components
from sightline.graph.factors import svd_plus_plus
from sightline.graph.paths import breadth_first_paths, landmark_distances
from sightline.graph.ranking import page_rank, propagate_labels
from sightline.graph.triangles import triangle_counts
from tests.conftest import sightings, values

# With HEAVY = 3 most hubs of these small graphs take the heavy-key path.
HEAVY = 3


def graph(spark, n, edges):
    return Graph(
        spark.createDataFrame([(i,) for i in range(n)], "id long"),
        spark.createDataFrame(edges, "src long, dst long"),
    )


def random_edges(n, m, seed):
    rng = random.Random(seed)
    edges = {(rng.randrange(n), rng.randrange(n)) for _ in range(m)}
    # A hub with a third of all edges.
    edges |= {(0, rng.randrange(n)) for _ in range(m // 4)} | {(rng.randrange(n), 0) for _ in range(m // 4)}
    return sorted(edges)


def reach(edges, start):
    seen, todo = {start}, [start]
    while todo:
        x = todo.pop()
        for a, b in edges:
            if a == x and b not in seen:
                seen.add(b)
                todo.append(b)
    return seen


def test_columns_are_checked(spark):
    v = spark.createDataFrame([(1,)], "id long")
    e = spark.createDataFrame([(1, 2)], "src long, dst long")
    with pytest.raises(ValueError, match="id"):
        Graph(v.withColumnRenamed("id", "key"), e)
    with pytest.raises(ValueError, match="dst"):
        Graph(v, e.drop("dst"))
    assert "id" in repr(Graph(v, e))
    assert Graph(v, e).cache().unpersist().edges is e


def test_small_graph_of_three(spark):
    v = spark.createDataFrame([(1, "ant"), (2, "bee"), (3, "cod")], "id long, name string")
    e = spark.createDataFrame([(1, 2, "calls"), (2, 1, "pays"), (2, 3, "visits")], "src long, dst long, action string")
    g = Graph(v, e)
    assert values(g.outDegrees) == [(1, 1), (2, 2)]
    assert values(g.inDegrees) == [(1, 1), (2, 1), (3, 1)]
    assert values(g.degrees) == [(1, 2), (2, 3), (3, 1)]
    assert g.triplets.columns == ["src", "edge", "dst"]
    assert values(g.triplets, "src.name", "edge.action", "dst.name") == [
        ("ant", "calls", "bee"), ("bee", "pays", "ant"), ("bee", "visits", "cod"),
    ]
    found = g.find("(a)-[e]->(b); (b)-[f]->(c)")
    assert found.columns == ["a", "e", "b", "f", "c"]
    assert values(found, "a.id", "b.id", "c.id") == [(1, 2, 1), (1, 2, 3), (2, 1, 2)]
    assert values(g.find("(a)-[]->(b); !(b)-[]->(a)"), "a.id", "b.id") == [(2, 3)]
    assert values(g.find("(a)-[]->(b); !(b)-[]->()"), "a.id", "b.id") == [(2, 3)]
    assert values(g.find("()-[e]->()"), "e.action") == [("calls",), ("pays",), ("visits",)]
    assert g.find("(a)").count() == 3
    assert g.find("(a)-[]->(a)").count() == 0
    for bad in ("(a)-[e]->(b); (c)-[f]->(d)", "!(a)-[]->(b)", "(a)-(b)", "(a)-[]->(b); !(a)-[e]->(b)", "(a)-[]->(b); (z)"):
        with pytest.raises(ValueError):
            g.find(bad)
    path = g.bfs("name = 'ant'", "name = 'cod'")
    assert path.columns == ["from", "e0", "v1", "e1", "to"]
    assert values(path, "from.id", "e0.action", "v1.id", "to.id") == [(1, "calls", 2, 3)]
    assert g.bfs("name = 'cod'", "name = 'ant'").count() == 0
    assert g.bfs("name = 'ant'", "name = 'cod'", edgeFilter="action <> 'visits'").count() == 0
    assert g.bfs("name = 'ant'", "name = 'cod'", maxPathLength=1).count() == 0
    assert values(g.bfs("id < 3", "id > 1"), "from.id", "to.id") == [(2, 2)]
    distances = {r["id"]: r["distances"] for r in g.shortestPaths([3]).collect()}
    assert distances == {1: {3: 2}, 2: {3: 1}, 3: {3: 0}}


def test_components(spark):
    edges = random_edges(60, 25, 7) + [(80 + i, 81 + i) for i in range(15)]
    g = graph(spark, 100, edges)
    both = edges + [(b, a) for a, b in edges]
    want = [(v, min(reach(both, v))) for v in range(100)]
    assert values(connected_components(g)) == sorted(want, key=repr)
    assert values(connected_components(g, min_heavy=HEAVY)) == sorted(want, key=repr)
    with pytest.raises(RuntimeError):
        connected_components(g, max_iter=1)


@pytest.mark.parametrize(
    "n, edges",
    [
        (4, [(0, 1), (1, 2), (2, 3), (3, 0)]),
        (6, [(0, 1), (1, 2), (2, 0), (3, 4), (4, 5), (5, 3), (2, 3)]),
        (3, [(1, 1), (0, 2)]),
        (25, random_edges(25, 30, 2)),
    ],
)
def test_strong_components(spark, n, edges):
    forward = {v: reach(edges, v) for v in range(n)}
    want = [(v, min(u for u in forward[v] if v in forward[u])) for v in range(n)]
    for heavy in (10**6, HEAVY):
        got = strong_components(graph(spark, n, edges), 20, min_heavy=heavy)
        assert values(got) == sorted(want, key=repr)


def test_strong_components_behind_a_long_chain(spark):
    # 0 -> 1 -> ... -> 60 -> 61 -> 62 -> 60 -> ... -> 70, numbered so that the smallest id leads everywhere.
    edges = [(i, i + 1) for i in range(70)] + [(62, 60), (66, 64)]
    got = dict(values(strong_components(graph(spark, 71, edges), 20)))
    assert [v for v in got if got[v] == 60] == [60, 61, 62]
    assert [v for v in got if got[v] == 64] == [64, 65, 66]
    assert all(got[v] == v for v in got if v not in (61, 62, 65, 66))


def test_page_rank_follows_the_formula(spark):
    edges = random_edges(20, 40, 3)
    out = {v: sum(a == v for a, _ in edges) for v in range(20)}

    def expected(rounds, base):
        rank = {v: base(v) for v in range(20)}
        for _ in range(rounds):
            rank = {
                v: 0.15 * base(v) + 0.85 * sum(rank[a] / out[a] for a, b in edges if b == v) for v in range(20)
            }
        return rank

    g = graph(spark, 20, edges)
    for heavy in (10**6, HEAVY):
        got = page_rank(g, max_iter=4, min_heavy=heavy)
        ranks = {r["id"]: r["pagerank"] for r in got.vertices.collect()}
        assert ranks == pytest.approx(expected(4, lambda v: 1.0))
    assert {round(r["weight"] * out[r["src"]], 9) for r in got.edges.collect()} == {1.0}
    personal = g.pageRank(sourceId=3, maxIter=3)
    assert {r["id"]: r["pagerank"] for r in personal.vertices.collect()} == pytest.approx(
        expected(3, lambda v: float(v == 3))
    )
    settled = g.pageRank(tol=1e-3)
    assert {r["id"]: r["pagerank"] for r in settled.vertices.collect()} == pytest.approx(
        expected(200, lambda v: 1.0), abs=2e-2
    )
    for bad in ({}, {"maxIter": 1, "tol": 0.1}):
        with pytest.raises(ValueError):
            g.pageRank(**bad)


def test_label_propagation(spark):
    edges = random_edges(15, 25, 4)
    label = {v: v for v in range(20)}
    for _ in range(3):
        new = {}
        for v in label:
            heard = [label[a] for a, b in edges if b == v] + [label[b] for a, b in edges if a == v]
            new[v] = min(set(heard), key=lambda x: (-heard.count(x), x)) if heard else label[v]
        label = new
    for heavy in (10**6, HEAVY):
        assert dict(values(propagate_labels(graph(spark, 20, edges), 3, heavy))) == label


def test_triangles(spark):
    edges = random_edges(20, 60, 5) + [(1, 1)]
    pairs = {(min(a, b), max(a, b)) for a, b in edges if a != b}
    want = {v: 0 for v in range(25)}
    for a in range(25):
        for b in range(a + 1, 25):
            for c in range(b + 1, 25):
                if {(a, b), (b, c), (a, c)} <= pairs:
                    for v in (a, b, c):
                        want[v] += 1
    for heavy in (10**6, HEAVY):
        assert dict(values(triangle_counts(graph(spark, 25, edges), heavy))) == want
    shown = graph(spark, 25, edges).triangleCount()
    assert shown.columns == ["id", "count"]


def test_bfs_lists_all_shortest_paths(spark):
    edges = [(0, 1), (0, 2), (1, 3), (2, 3), (3, 4), (0, 5), (5, 6), (6, 7), (7, 4)]
    g = graph(spark, 8, edges)
    for heavy in (10**6, 2):
        got = breadth_first_paths(g, "id = 0", "id = 4", min_heavy=heavy)
        assert values(got, "from.id", "v1.id", "v2.id", "to.id") == [(0, 1, 3, 4), (0, 2, 3, 4)]


def test_landmark_distances(spark):
    edges = random_edges(20, 30, 6)
    want = []
    for mark in (0, 7):
        level, seen = {mark}, {mark: 0}
        while level:
            level = {a for a, b in edges if b in level} - set(seen)
            seen |= {v: max(seen.values()) + 1 for v in level}
        want += [(v, mark, d) for v, d in seen.items()]
    for heavy in (10**6, HEAVY):
        got = landmark_distances(graph(spark, 20, edges), [0, 7], heavy)
        assert values(got) == sorted(want, key=repr)


def test_sighting_graph_joins_up(spark):
    rows = sightings(
        spark,
        {"anonymous_id": "c1", "data": "a.b.example.com", "count_seen": 3.0},
        {"anonymous_id": "c2", "data": " x.example.com", "count_seen": 1.0},
        {"anonymous_id": "c2", "data": "1.2.3.4", "count_seen": 4.0, "sector": "other"},
    )
    g = build.create_graph(rows)
    assert values(g.vertices, "id", "label") == [
        ("1.2.3.4", "HOST"), ("c1", "CUSTOMER"), ("c2", "CUSTOMER"), ("example.com", "HOST"),
    ]
    assert g.triplets.count() == g.edges.count() == 6
    assert g.edges.agg(F.sum("weight")).first()[0] == pytest.approx(2.0)


def test_factors_lower_the_loss(spark):
    rng = random.Random(9)
    edges = [(u, 100 + i, float((u + i) % 5)) for u in range(12) for i in range(8) if rng.random() < 0.8]
    ratings = spark.createDataFrame(edges, "src long, dst long, weight double")
    vertices = ratings.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    settings = dict(rank=4, maxIter=4, gamma1=0.3, gamma2=0.3)
    factors, losses = Graph(vertices, ratings).svdPlusPlus(**settings)
    assert losses == sorted(losses, reverse=True) and losses[-1] < losses[0]
    assert factors.count() == vertices.count()
    assert factors.where(F.size("column1") == 4).count() == vertices.count()
    again, same = svd_plus_plus(Graph(vertices, ratings), min_heavy=HEAVY, **settings)
    assert same == pytest.approx(losses)


def test_edges_held_for_rounds_are_not_sorted_again(spark, monkeypatch):
    from sightline.graph import links

    monkeypatch.setattr(links, "PART_ROWS", 10)
    edges = spark.createDataFrame([(i % 13, i % 7) for i in range(90)], "src long, dst long")
    held = links.Links(edges)
    assert held.cold.rdd.getNumPartitions() == 9
    states = spark.range(13).withColumn("rank", F.lit(1.0))
    met = held.meet(states.hint("merge"))
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert plan.split("InMemoryTableScan")[0].count("Sort [") == 0 and met.count() == 90
    held.close()


def test_motif_vertices_are_joined_before_rows_multiply(spark):
    edges = spark.createDataFrame([(1, 2), (1, 2), (2, 3), (3, 1), (3, 4), (9, 1), (2, 9)], "src long, dst long")
    g = Graph(spark.createDataFrame([(i, f"n{i}") for i in (1, 2, 3, 4)], "id long, name string"), edges)
    found = g.find("(a)-[]->(b); (b)-[]->(c); (c)-[]->(a)")
    assert values(found, "a.name", "b.name", "c.id") == sorted(
        [("n1", "n2", 3), ("n2", "n3", 1), ("n3", "n1", 2)] * 2
    )
    two = g.find("(a)-[]->(b); (b)-[e]->(c)")
    assert two.count() == 6 and values(g.find("(a)-[]->()"), "a.id") == [(1,), (1,), (2,), (2,), (3,), (3,)]
    # The rows of the motif are not written: the plan still holds the join of its terms.
    assert two._jdf.queryExecution().optimizedPlan().toString().count("Join") == 4


def test_sighting_graph_reads_sightings_once(spark):
    rows = sightings(spark, {"anonymous_id": "c1", "data": "x.a.com"}, {"anonymous_id": None, "data": "1.2.3.4"})
    g = build.create_graph(rows)
    for frame in (g.vertices, g.edges, g.triplets):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "parquet" in plan and "LocalRelation" not in plan and "LogicalRDD" not in plan
    assert g.vertices.count() == 4 and g.edges.count() == 4


def test_two_way_graphs_need_no_direction_added(spark):
    n, edges = 40, random_edges(36, 45, seed=9) + [(3, 3), (1, 2), (1, 2)]
    plain = graph(spark, n, edges + [(b, a) for a, b in edges])
    stated = Graph(plain.vertices, plain.edges, two_way=True)
    for found in (
        lambda g: connected_components(g, min_heavy=HEAVY),
        lambda g: strong_components(g, min_heavy=HEAVY),
        lambda g: propagate_labels(g, 3, min_heavy=HEAVY),
        lambda g: triangle_counts(g, min_heavy=HEAVY),
    ):
        assert sorted(map(tuple, found(stated).collect())) == sorted(map(tuple, found(plain).collect()))
    rows = sightings(spark, {"anonymous_id": "a", "data": "1.2.3.4"}, {"anonymous_id": "b", "data": "1.2.3.4"})
    built = build.create_graph(rows)
    ends = [(r["src"], r["dst"]) for r in built.edges.collect()]
    assert built.two_way and sorted(ends) == sorted((b, a) for a, b in ends)
