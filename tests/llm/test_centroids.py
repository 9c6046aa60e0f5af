import hashlib
import math

import duckdb
import numpy as np
import pytest

from tests.llm.helpers import SF, rows
from tramline.llm import centroids

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def plain(vectors, clusters=40, rounds=5):
    """The rounds without bounds, in Python's whole numbers."""
    kept = [
        (i, [math.floor(256 * float(x)) for x in v])
        for i, v in vectors
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    mark = {i: hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "~" for i, _ in kept}
    now = [v for _, v in sorted(kept, key=lambda r: (mark[r[0]], r[1]))[:clusters]]

    def assigned():
        out = []
        for _, v in kept:
            apart = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in now]
            out.append((min(range(len(now)), key=lambda j: (apart[j], j)), min(apart)))
        return out

    for _ in range(rounds):
        where = assigned()
        for j in range(len(now)):
            own = [v for (_, v), (c, _) in zip(kept, where, strict=True) if c == j]
            if own:
                now[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    where = assigned()
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    inertia = [sum(d for c, d in where if c == j) for j in range(len(now))]
    return sorted(
        str((i, c, d, inertia[c], sum(inertia), marks[c])) for (i, _), (c, d) in zip(kept, where, strict=True)
    )


def found(df):
    return sorted(str(tuple(r[c] for c in COLUMNS)) for r in df.collect())


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(centroids.OP11_SQL).df()
    got = centroids.op11_centroid_clustering(spark, SF).toPandas()
    assert rows(want, COLUMNS) == rows(got, COLUMNS)


SCHEMA = "vec_id long, embedding array<double>, cluster string, v int, known long, inertia double"


def vectors(rng, n):
    return [[float(x) for x in rng.normal(0, 1, 64)] for _ in range(n)]


def test_odd_rows_ties_and_clashing_names(spark):
    rng = np.random.default_rng(3)
    some = vectors(rng, 60)
    some += [some[0], some[0], some[1], [0.0] * 64, [-0.0] * 64, [-1e-9] * 64, [1e5] * 64]
    data = list(enumerate(some)) + [(5, some[7]), (5, some[5]), (None, some[3]), (None, None)]
    data += [(900, [math.nan] + some[0][1:]), (901, [math.inf] + some[0][1:]), (902, [None] + some[0][1:])]
    data += [(903, some[0][:63]), (904, some[0] + [1.0]), (905, [])]
    df = spark.createDataFrame([(i, v, "x", 1, 2, 0.5) for i, v in data], SCHEMA)
    assert found(centroids.centroid_clusters(df)) == plain(data)


def test_fewer_vectors_than_clusters_and_none(spark):
    data = list(enumerate(vectors(np.random.default_rng(4), 7)))
    df = spark.createDataFrame([(i, v, "x", 1, 2, 0.5) for i, v in data], SCHEMA)
    assert found(centroids.centroid_clusters(df)) == plain(data)
    assert centroids.centroid_clusters(spark.createDataFrame([], SCHEMA)).collect() == []
    assert centroids.centroid_clusters(spark.createDataFrame([(1, None, "x", 1, 2, 0.5)], SCHEMA)).collect() == []


def test_components_too_large_are_refused(spark):
    df = spark.createDataFrame([(1, [1e300] * 64, "x", 1, 2, 0.5)], SCHEMA)
    with pytest.raises(Exception, match="524288"):
        centroids.centroid_clusters(df).collect()


def test_bounds_save_comparisons_and_are_the_norm_of_the_sum():
    """A centroid that goes and comes back loosens nothing, though it has moved twice."""
    away, back = np.array([[0, 0], [100, 0]]), np.array([[0, 0], [10_000, 0]])
    bounds = centroids.Bounds([away, back, away])
    assert bounds.moved.tolist() == [[0, 0], [0, 9900], [0, 0]]


def test_later_rounds_compare_fewer(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(0, 4, (12, 64))
    data = [(i, [float(x) for x in centres[i % 12] + rng.normal(0, 0.3, 64)], "x", 1, 2, 0.5) for i in range(1500)]
    df = spark.createDataFrame(data, SCHEMA)
    state, history, compared = centroids.clustered(df)
    assert len(history) == 6 and len(compared) == 6
    assert compared[0] == 1500 * 40
    assert min(compared[2:]) < 1500 * 10
    assert found(centroids.centroid_clusters(df)) == plain([(r[0], r[1]) for r in data])


def test_superseded_states_are_removed(spark, tmp_path):
    import os

    def states():
        root = spark.conf.get("spark.checkpoint.dir")
        return {n for n in os.listdir(root) if n.startswith(("llm-assigned", "llm-vectors")) and os.path.isdir(f"{root}/{n}")}

    before = states()
    centroids.op11_centroid_clustering(spark, SF).collect()
    assert len(states() - before) == 1
