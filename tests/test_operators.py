"""Operators that have no SQL, against brute force, and small cases of the others."""

from __future__ import annotations

import random

import pytest

from lexigrove.functions.text import porter, stems
from lexigrove.operators import geometry, graph, retrieval, windows
from lexigrove.operators.skew import heavy_keys, salted_join
from tests.util import rows


def test_gap_clusters_from_start(spark):
    random.seed(4)
    data = [(p, i, random.randint(0, 700) / 1.0) for p in range(5) for i in range(12)]
    got = {(r.page, r.rid): r.cluster for r in windows.gap_clusters_from_start(spark.createDataFrame(data, "page int, rid int, y double"), ["page"], "y", 100, "rid").collect()}
    for p in range(5):
        start, n = None, -1
        for y, i in sorted((y, i) for q, i, y in data if q == p):
            if start is None or y - start > 100:
                start, n = y, n + 1
            assert got[p, i] == n


def test_gap_clusters(spark):
    df = spark.createDataFrame([(1, i, float(y)) for i, y in enumerate([0, 50, 120, 121, 300])], "page int, rid int, y double")
    assert [r.cluster for r in windows.gap_clusters(df, ["page"], "y", 60, "rid").orderBy("y").collect()] == [0, 0, 1, 1, 2]


def test_clamped_levels(spark):
    from pyspark.sql import functions as F

    random.seed(8)
    raw = [random.randint(0, 6) for _ in range(60)]
    want, last = [], -1
    for r in raw:
        last = min(r, last + 1)
        want.append(last)
    df = spark.createDataFrame([(1, i, r) for i, r in enumerate(raw)], "v int, i int, raw int")
    assert [r.x for r in df.select("i", windows.clamped_levels(F.col("raw"), F.col("i"), F.col("v")).alias("x")).orderBy("i").collect()] == want


def test_longest_nondecreasing():
    random.seed(2)
    for _ in range(200):
        keys = [random.choice("abcdef") for _ in range(random.randint(0, 9))]
        got = windows.longest_nondecreasing(keys)
        assert got == sorted(got) and [keys[i] for i in got] == sorted(keys[i] for i in got)
        best = [1] * len(keys)
        for i in range(len(keys)):
            best[i] = 1 + max((best[j] for j in range(i) if keys[j] <= keys[i]), default=0)
        assert len(got) == max(best, default=0)


def test_islands(spark):
    df = spark.createDataFrame([("a", p) for p in (1, 2, 2, 3, 7, 9)], "k string, p int")
    assert rows(windows.islands(df, ["k"], "p")) == [("a", 1, 3, 3), ("a", 7, 7, 1), ("a", 9, 9, 1)]
    assert rows(windows.islands(df, ["k"], "p", 2)) == [("a", 1, 3, 3), ("a", 7, 9, 2)]


def boxes(spark, n=60, seed=1):
    random.seed(seed)
    data = []
    for i in range(n):
        x, y = random.randint(0, 400), random.randint(0, 600)
        data.append((1, i % 3, i, float(x), float(y), float(x + random.randint(5, 200)), float(y + random.randint(5, 80))))
    return data, spark.createDataFrame(data, "volume int, page int, rid bigint, x0 double, y0 double, x1 double, y1 double")


def test_candidate_pairs_are_all_that_touch(spark):
    from pyspark.sql import functions as F

    data, df = boxes(spark)
    got = [(r.a, r.b) for r in geometry.candidate_pairs(df).where(geometry.overlap_area("a", "b") > 0).select(F.col("a.rid").alias("a"), F.col("b.rid").alias("b")).collect()]
    want = {(a[2], b[2]) for a in data for b in data if a[2] < b[2] and a[1] == b[1] and min(a[5], b[5]) > max(a[3], b[3]) and min(a[6], b[6]) > max(a[4], b[4])}
    assert set(got) == want and len(got) == len(want)


def test_components(spark):
    keys = spark.createDataFrame([(i,) for i in range(40)], "key bigint")
    pairs = spark.createDataFrame([(i, i + 1) for i in range(0, 29)] + [(35, 33), (33, 35), (36, 36)], "a bigint, b bigint")
    got = {r.key: r.component for r in geometry.components(keys, pairs).collect()}
    assert all(got[i] == 0 for i in range(30)) and got[33] == got[35] == 33 and got[36] == 36 and got[31] == 31


def test_suppress_overlaps(spark):
    df = spark.createDataFrame([(1, 1, 1, 0.0, 0.0, 100.0, 10.0), (1, 1, 2, 10.0, 0.0, 40.0, 10.0), (1, 1, 3, 90.0, 0.0, 150.0, 10.0), (1, 2, 4, 10.0, 0.0, 40.0, 10.0)], "volume int, page int, rid bigint, x0 double, y0 double, x1 double, y1 double")
    assert {r.rid: r.kept for r in geometry.suppress_overlaps(df).collect()} == {1: True, 2: False, 3: True, 4: True}


def test_lattice(spark):
    cells = [(0, 0, 100, 20), (100, 0, 200, 20), (0, 20, 200, 40), (0, 40, 100, 80), (100, 40, 200, 60), (101, 60, 200, 80)]
    df = spark.createDataFrame([(1, 1, i, *map(float, c)) for i, c in enumerate(cells)], "volume int, page int, rid bigint, x0 double, y0 double, x1 double, y1 double")
    got = {r.rid: (r.r, r.c, r.rowspan, r.colspan) for r in geometry.lattice(df).collect()}
    assert got == {0: (0, 0, 1, 1), 1: (0, 1, 1, 1), 2: (1, 0, 1, 2), 3: (2, 0, 2, 1), 4: (2, 1, 1, 1), 5: (3, 1, 1, 1)}


def test_components_raise_at_the_bound(spark):
    keys = spark.createDataFrame([(i,) for i in range(200)], "key int")
    chain = spark.createDataFrame([(i, i + 1) for i in range(199)], "a int, b int")
    assert {r.component for r in geometry.components(keys, chain).collect()} == {0}
    with pytest.raises(RuntimeError, match="max_rounds"):
        geometry.components(keys, chain, max_rounds=3)


def test_longest_paths_of_a_loop_raise(spark):
    with pytest.raises(ValueError, match="loop"):
        graph.longest_paths(spark.createDataFrame([("a", 1), ("b", 1)], "key string, weeks int"), spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string"))


def test_longest_paths(spark):
    tracks = spark.createDataFrame([("a", 2), ("b", 3), ("c", 1), ("z", 5)], "key string, weeks bigint")
    steps = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c")], "src string, dst string")
    assert rows(graph.longest_paths(tracks, steps)) == [("a", 2), ("b", 5), ("c", 6), ("z", 5)]


def test_k_hop_with_hub_and_loop(spark):
    links = spark.createDataFrame([("a", "a", 0), ("a", "a/1", 1)], "ancestor string, descendant string, depth int")
    edges = spark.createDataFrame([("a/1", "h"), ("a", "b"), ("b", "c"), ("c", "b"), ("h", "x"), ("b", None), ("b", "a")], "src string, dst string")
    anchors, hubs = spark.createDataFrame([("a",)], "key string"), spark.createDataFrame([("h",)], "key string")
    assert rows(graph.k_hop(links, edges, anchors, 3, hubs)) == [("a", "b", 1), ("a", "c", 2), ("a", "h", 1)]


def test_within_budget(spark):
    lines = spark.createDataFrame([("g", p, o, s) for p, o, s in ((1, 1, 50), (2, 1, 60), (3, 1, 5), (4, 1, 5))], "g string, priority int, ord int, size int")
    assert [r.priority for r in graph.within_budget(lines, "g", ["priority", "ord"], 100, 2).orderBy("priority").collect()] == [1, 2]


@pytest.mark.parametrize("n, want", [(4, ["a", "x", "b", "y"]), (5, ["a", "x", "b", "y", "c"])])
def test_fuse_reserved(spark, n, want):
    one = spark.createDataFrame([(1, k, i) for i, k in enumerate("abcd", 1)], "qid int, id string, rank int")
    two = spark.createDataFrame([(1, k, i) for i, k in enumerate("xyzw", 1)], "qid int, id string, rank int")
    assert [r.id for r in retrieval.fuse_reserved(one, two, n).orderBy("place").collect()] == want


def test_knn_in_blocks(spark, data):
    v = spark.read.parquet(f"{data}/embeddings.parquet")
    q = v.where("vec_id % 10 = 0")
    whole = rows(retrieval.knn(v, q, "vec_id", "embedding", 7).select("qid", "id", "rank"))
    assert whole == rows(retrieval.knn(v, q, "vec_id", "embedding", 7, block=3).select("qid", "id", "rank"))
    assert all(a == b for a, b, r in whole if r == 1)
    assert rows(retrieval.knn(v, v.where("false"), "vec_id", "embedding", 7)) == []


def test_salted_join(spark):
    left = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(600)] + [(None, -1)], "k string, i int")
    right = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "k string, v int")
    hot = heavy_keys(left, "k", 0.1, 10)
    assert hot == ["hot"]
    assert rows(salted_join(left, right, "k", hot)) == rows(left.join(right, "k", "left"))
    assert rows(salted_join(left, right, "k", [])) == rows(left.join(right, "k", "left"))


@pytest.mark.parametrize("word, stem", [w.split(":") for w in "caresses:caress ponies:poni ties:ti cats:cat feed:feed agreed:agre plastered:plaster bled:bled motoring:motor sing:sing conflated:conflat troubled:troubl sized:size hopping:hop falling:fall hissing:hiss failing:fail filing:file happy:happi sky:sky relational:relat conditional:condit digitizer:digit operator:oper feudalism:feudal decisiveness:decis hopefulness:hope formaliti:formal triplicate:triplic formative:form electrical:electr goodness:good revival:reviv allowance:allow airliner:airlin adjustable:adjust replacement:replac adoption:adopt communism:commun activate:activ effective:effect rate:rate cease:ceas controll:control roll:roll".split()])
def test_porter(word, stem):
    assert porter(word) == stem


def test_stems(spark):
    df = spark.createDataFrame([("Cafés and RAMPS",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(stems("t")).collect()] == [["cafe", "and", "ramp"], None, []]
