import hashlib
import math

import numpy as np
import pytest

from ledgerlake.llm.clustering import Pivots, cluster_vectors, nearest, squared


def brute(rows, clusters, rounds, dims):
    """(vec_id, cluster, distance, sha) by plain Python."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: "null" if i is None else str(i)
    cents = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"3:{name(r[0])}".encode()).hexdigest(), r[1]))[:clusters]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for _ in range(rounds):
        at = [min((far(v, c), k) for k, c in enumerate(cents))[1] for _, v in kept]
        for k in range(len(cents)):
            mine = [v for (_, v), a in zip(kept, at) if a == k]
            if mine:
                cents[k] = [sum(col) // len(mine) for col in zip(*mine)]
    out = []
    for i, v in kept:
        d, k = min((far(v, c), k) for k, c in enumerate(cents))
        out.append((i, k, d, hashlib.sha256(",".join(map(str, cents[k])).encode()).hexdigest()))
    return out


def same(df, want):
    got = df.collect()
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(((r.vec_id, r.cluster, r.distance, r.centroid_sha256) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert r.cluster_inertia == sum(w[2] for w in want if w[1] == r.cluster) and r.inertia == sum(w[2] for w in want)
    return got


def test_matches_brute_force_on_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = same(cluster_vectors(vectors), brute(rows, 8, 10, 64))
    assert sum(r.checked for r in got) < 8 * len(got)


def test_well_parted_clusters_need_few_exact_distances(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * 0.01 + 40 * (i % 5) * np.eye(6)[i % 5]).tolist()) for i in range(400)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = same(cluster_vectors(vectors, clusters=5, rounds=6, dimensions=6), brute([(r.vec_id, r.embedding) for r in vectors.collect()], 5, 6, 6))
    assert sum(r.checked for r in got) < 2 * len(got)


def test_bad_vectors_ties_repeats_nulls_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [0.5, 0.5]), (None, [-0.0001, 2.5]), (4, None), (5, []), (6, [1.0]), (7, [1.0, None]), (8, [nan, 1.0]), (9, [1.0, -inf]), (10, [1.0, 2.0, 3.0])]
    schema = "vec_id long, embedding array<double>, ints string, far int, cluster string, distance string, k int, i int, n int, checked string"
    vectors = spark.createDataFrame([(*r, "x", 1, "y", "z", 2, 3, 4, "c") for r in rows], schema)
    for k in (1, 2, 3, 8):
        same(cluster_vectors(vectors, clusters=k, rounds=3, dimensions=2), brute(rows, k, 3, 2))
    assert cluster_vectors(vectors.where("vec_id = 4"), dimensions=2).collect() == []
    assert cluster_vectors(vectors.where("vec_id > 99"), dimensions=2).collect() == []


def test_all_vectors_equal(spark):
    vectors = spark.range(50).selectExpr("id as vec_id", "array(0.25f, -0.75f) as embedding")
    got = cluster_vectors(vectors, dimensions=2).collect()
    assert len(got) == 50 and all((r.cluster, r.distance, r.inertia) == (0, 0, 0) for r in got)


def test_components_whose_distances_fit_no_long_raise(spark):
    vectors = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="fits no long"):
        cluster_vectors(vectors, dimensions=2).collect()


@pytest.mark.parametrize("scale", [1, 1000, 1 << 26])
def test_bounds_never_exceed_the_distance(scale):
    rng = np.random.default_rng(scale)
    x, c = (rng.integers(-scale, scale + 1, (n, 5)) for n in (300, 9))
    c[0], x[0] = x[1], x[2]  # equal points too
    pivots = Pivots.among(x[:40], 6)
    bounds = pivots.squared_bounds(pivots.distances(x), pivots.distances(c))
    exact = squared(x[:, None], c[None])
    assert (bounds <= exact * (1 + 1e-15)).all() and (bounds > 0.01 * exact).mean() > 0.3
    cluster, best, _ = nearest(x, pivots.distances(x), c, pivots)
    assert (best == exact.min(axis=1)).all() and (cluster == exact.argmin(axis=1)).all()
