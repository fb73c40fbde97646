"""Running values over bins, depth-first order, traversal and tracks against plain walks."""

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from protolith.operators import graph, intervals, ordered, projection


@pytest.mark.parametrize("fan, bins", [(3, 20), (1024, 7)])
def test_climb_equals_a_plain_scan(spark, monkeypatch, fan, bins):
    monkeypatch.setattr(ordered, "FAN", fan)
    rnd = random.Random(fan)
    rows = [(i, rnd.choice([None, rnd.randrange(50)]), rnd.randrange(9)) for i in rnd.sample(range(500), 160)]
    placed = ordered.dealt(spark.createDataFrame(rows, "t int, v int, n long"), ["t"], bins)
    got = ordered.climb(placed.rows, placed.bins, sums={"s": F.col("n")}, lags={"p": F.col("v")}, leads={"f": F.col("v")},
                        peaks={"m": F.col("v")}).orderBy("t").collect()
    rows.sort()
    total, peak = 0, None
    for i, (r, (t, v, n)) in enumerate(zip(got, rows, strict=True)):
        peak = v if peak is None else peak if v is None else max(peak, v)
        assert (r.t, r.s, r.p, r.f, r.m) == (t, total, rows[i - 1][1] if i else None, rows[i + 1][1] if i + 1 < len(rows) else None, peak)
        total += n


def test_numbers_of_rows_with_ties_hot_and_missing_keys(spark, monkeypatch):
    monkeypatch.setattr(ordered, "FAN", 4)
    rows = [(("hot" if i % 3 else None) if i % 7 else f"k{i % 5}", i // 4, i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t int, i int")
    whole = ordered.number_rows(df, ["t", "i"], bins=30).collect()
    assert [r.number for r in sorted(whole, key=lambda r: (r.t, r.i))] == list(range(400))
    inside = ordered.number_rows(df, ["t"], keys=["k"], bins=30).collect()
    by = {}
    for r in sorted(inside, key=lambda r: r.number):
        by.setdefault(r.k, []).append(r)
    for group in by.values():
        assert [r.number for r in group] == list(range(len(group)))
        assert [r.t for r in group] == sorted(r.t for r in group)
    plan = ordered.number_rows(df, ["t"], bins=30)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


def test_numbers_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, t int")
    assert ordered.number_rows(df, ["t"]).count() == 0
    assert ordered.runs(df, ["k"], ["t"], "t").count() == 0


def test_runs_without_keys(spark):
    df = spark.createDataFrame([(i, "aab"[i % 3]) for i in range(9)], "t int, s string")
    got = sorted((r.start, r.end, r.symbol) for r in ordered.runs(df, [], ["t"], "s", bins=4).collect())
    assert got == [(i, i + n, s) for j in range(3) for i, n, s in ((3 * j, 2, "a"), (3 * j + 2, 1, "b"))]


def walk(roots, down, key, breadth=False):
    """Plain traversal with a list of nodes to visit."""
    seen, todo = [], list(sorted(roots, key=key))
    if not breadth:
        todo.reverse()
    while todo:
        node = todo.pop(0) if breadth else todo.pop()
        if node in seen:
            continue
        seen.append(node)
        todo.extend(sorted(down.get(node, []), key=key, reverse=not breadth))
    return seen


def made(seed, n, extra, cycle=False):
    rnd = random.Random(seed)
    names = [f"n{i}" for i in range(n)]
    rnd.shuffle(names)
    start = {x: rnd.randrange(6) for x in names}
    links = set()
    for i in range(1, n):
        if rnd.random() < 0.85:
            links.add((names[i], names[rnd.randrange(max(0, i - 12), i)]))
    for _ in range(extra):
        a, b = sorted(rnd.sample(range(n), 2))
        links.add((names[b], names[a]))
    if cycle:
        links |= {(names[1], names[n - 1]), ("lost1", "lost2"), ("lost2", "lost1"), ("lost3", "lost1"), ("self", "self")}
        for x in ("lost1", "lost2", "lost3", "self"):
            start[x] = 1
    return start, sorted(links)


def frames(spark, start, links):
    return spark.createDataFrame(list(start.items()), "id string, start int"), spark.createDataFrame(links, "child_id string, parent_id string")


@pytest.mark.parametrize("seed, extra, cycle", [(2, 30, False), (3, 60, True)])
def test_tree_order_equals_a_walk(spark, seed, extra, cycle):
    start, links = made(seed, 60, extra, cycle)
    down, tops = {}, set(start)
    for c, p in links:
        down.setdefault(p, []).append(c)
        tops.discard(c)
    nodes, edges = frames(spark, start, links + [("n3", "unknown")])
    got = [r.id for r in graph.tree_order(nodes, edges, ["start"]).orderBy("position").collect()]
    assert got == walk(tops, down, lambda x: (start[x], x))


def test_tree_order_of_a_chain_of_ten_thousand(spark):
    n = 10_000
    nodes = spark.range(n).selectExpr("id", "CAST(id % 7 AS INT) AS start")
    edges = spark.range(1, n).selectExpr("id AS child_id", "id - 1 AS parent_id")
    placed = graph.tree_order(nodes, edges, ["start"])
    assert "path" not in placed.columns
    assert placed.filter("position <> id OR root_id <> 0").count() == 0 and placed.count() == n


@pytest.mark.parametrize("breadth", [False, True])
def test_traversal_in_order(spark, breadth):
    start, links = made(5, 40, 25)
    links.append((links[0][1], links[0][0]))  # a cycle
    down, up = {}, {}
    for c, p in links:
        down.setdefault(p, []).append(c)
        up.setdefault(c, []).append(p)
    nodes, edges = frames(spark, start, links)
    roots = spark.createDataFrame([("n0",), ("n1",), ("n39",)], "id string")
    for flip, step in ((False, down), (True, up)):
        out = graph.traverse(nodes, edges, roots, ["start"], "breadth" if breadth else "depth", up=flip).collect()
        for root in ("n0", "n1", "n39"):
            got = [r.node_id for r in sorted((r for r in out if r.start_id == root), key=lambda r: r.position)]
            assert got == walk([root], step, lambda x: (start[x], x), breadth), (root, flip)
    with pytest.raises(ValueError):
        graph.traverse(nodes, edges, roots, ["start"], "sideways")


def relatives(links, node):
    out = {node}
    for a, b in ((0, 1), (1, 0)):
        todo = [node]
        seen = {node}
        while todo:
            x = todo.pop()
            for link in links:
                if link[a] == x and link[b] not in seen:
                    seen.add(link[b])
                    todo.append(link[b])
        out |= seen
    return out


def test_tracks_equal_a_walk(spark):
    start, links = made(8, 45, 12)
    track = {x: f"t{i % 6}" for i, x in enumerate(sorted(start)) if i % 5}
    nodes = spark.createDataFrame([(x, s, track.get(x)) for x, s in start.items()], "id string, start int, track string")
    edges = spark.createDataFrame(links, "child_id string, parent_id string")
    got = {(r.track, r.id) for r in graph.tracks(nodes, edges, F.col("track")).collect()}
    assert got == {(t, y) for x, t in track.items() for y in relatives(links, x)}
    taken = {}
    for x in sorted(track, key=lambda x: (start[x], x)):
        if x not in taken:
            for y in relatives(links, x):
                taken.setdefault(y, track[x])
    out = graph.first_tracks(nodes, edges, F.col("track"), ["start", "id"]).collect()
    assert {r.id: r.track for r in out} == taken and len(out) == len(taken)
    none = nodes.withColumn("track", F.lit(None).cast("string"))
    assert graph.tracks(none, edges, F.col("track")).count() == 0 and graph.first_tracks(none, edges, F.col("track"), ["id"]).count() == 0


def test_parent_lists_from_links(spark):
    nodes = spark.createDataFrame([("a", ["old"]), ("b", None)], "id string, parent array<string>")
    edges = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "y")], "child_id string, parent_id string")
    assert {r.id: r.parent for r in graph.with_parents(nodes, edges).collect()} == {"a": ["x", "y"], "b": []}


FOLDS = {"min": min, "max": max, "mean": lambda v: sum(v) / len(v), "median": median}


@pytest.mark.parametrize("reducer", list(FOLDS))
def test_deep_segments_of_several_columns(spark, monkeypatch, reducer):
    monkeypatch.setattr(intervals, "SHALLOW", 3)
    monkeypatch.setattr(intervals, "RADIX_BITS", 2)
    rows = [("ab"[i % 2], (i * 37) % 50, (i * 37) % 50 + 1 + (i * 13) % 40, float((i * 29) % 17) if i % 5 else None, float(i % 3), None)
            for i in range(60)]
    df = spark.createDataFrame(rows, "c string, s int, e int, v double, w double, x double")
    got = {(r.seqid, r.start, r.end): (r.v, r.w, r.x) for r in intervals.fold_overlaps(df, "c", "s", "e", ["v", "w", "x"], reducer).collect()}
    want = {}
    for c in "ab":
        mine = [r for r in rows if r[0] == c]
        points = sorted({p for r in mine for p in r[1:3]})
        for lo, hi in zip(points, points[1:]):
            cover = [r for r in mine if r[1] <= lo and hi <= r[2]]
            known = [[r[k] for r in cover if r[k] is not None] for k in (3, 4, 5)]
            if cover:
                want[(c, lo, hi)] = tuple(FOLDS[reducer](k) if k else None for k in known)
    assert got.keys() == want.keys()
    for k, values in want.items():
        assert all((a is None) == (b is None) and (a is None or abs(a - b) < 1e-9) for a, b in zip(got[k], values)), k


EXONS = "id string, seqid string, strand string, source string, start int, end int"
FEATURES = "id string, feature_id bigint, type string, source string, target string, p_start int, p_end int"


def test_strict_mapping_fails_where_lenient_mapping_leaves_out(spark):
    exons = spark.createDataFrame([("p", "c", "+", "s", 0, 30), ("q", "c", "+", "s", 0, 30), ("q", "c", "-", "s", 40, 70)], EXONS)
    good = ("p", 1, "protein_match", "t", "x", 1, 5)
    past = ("p", 2, "protein_match", "t", "x", 50, 60)
    mixed = ("q", 3, "protein_match", "t", "x", 1, 5)
    unknown = ("nobody", 4, "protein_match", "t", "x", 1, 5)
    only_p = exons.filter("id = 'p'")

    def mapped(rows, ex, strict):
        return projection.map_to_genome(spark.createDataFrame(rows, FEATURES), ex, strict=strict).collect()

    assert {r.feature_id for r in mapped([good, past, unknown], only_p, False)} == {1}
    assert {r.feature_id for r in mapped([good, unknown], only_p, True)} == {1}
    with pytest.raises(Exception, match="feature reaches no exon: 2"):
        mapped([good, past], only_p, True)
    with pytest.raises(Exception, match="several values of strand: q"):
        mapped([good, mixed], exons, True)
    assert {r.id for r in mapped([good, mixed], exons, False)} == {"p", "q"}


def test_features_before_and_beyond_the_protein(spark):
    exons = spark.createDataFrame([("p", "c", "+", "s", 10, 22), ("p", "c", "+", "s", 22, 22), ("p", "c", "+", "s", 30, 42)], EXONS)
    rows = [("p", 1, "x", "t", None, -2, 2), ("p", 2, "x", "t", None, 3, 99), ("p", 3, "x", "t", None, 2, 2), ("p", 4, "x", "t", None, -3, 0)]
    out = projection.project(spark.createDataFrame(rows, FEATURES), exons)
    assert sorted((r.feature_id, r.start, r.end) for r in out.collect()) == [(1, 10, 16), (2, 19, 22), (2, 30, 42)]
