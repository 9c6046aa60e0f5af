"""Exact k-means rounds with bounds loosened by the norm of total displacement.

Each vector keeps, for every centroid, its distance at the round in which the two were last compared, and
that round. The driver keeps every centroid's whole history (rounds x k x components). Since then the
centroid has moved by one vector, the sum of its steps, and the bound is loosened by that vector's norm,
which is never more than the summed norms of the steps. Only centroids whose bound does not exclude them
are compared again, exactly, in whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import deleted, staged, table

CLUSTERS = 40
ROUNDS = 5
COMPONENTS = 64
SCALE = 256
# Components up to this keep 64 squared differences within a long.
LARGEST = 1 << 27
# Relative slack that makes up for rounding in square roots and stored bounds.
SLACK = 1e-6
# Vectors compared together.
TOGETHER = 4096


def whole_vectors(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id and ``v``, the vector as whole numbers, of the rows whose vector is complete and finite."""
    value = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    odd = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.select("vec_id", value.alias("x")).filter((F.size("x") == components) & ~odd)
    fits = F.forall("x", lambda x: F.abs(x) < LARGEST // scale)
    refuse = F.raise_error(F.lit(f"a component of {LARGEST // scale} or more has no distance that a long can hold"))
    floors = F.transform("x", lambda x: F.floor(x * scale).cast("long"))
    return kept.select("vec_id", F.when(fits, floors).otherwise(refuse).alias("v"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, components: int = COMPONENTS) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in that order; null ids last, ties by vector."""
    mark = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.select(mark.alias("mark"), "v").orderBy(F.col("mark").asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([row["v"] for row in rows], np.int64).reshape(len(rows), components)


class Bounds:
    """Assignment of vectors to the newest of a history of centroids."""

    def __init__(self, history: list[np.ndarray]) -> None:
        self.history = history
        self.now = len(history) - 1
        newest = history[-1].astype(float)
        # moved[t, j]: how far centroid j is from where it was in round t.
        self.moved = np.stack([np.sqrt(((newest - old) ** 2).sum(axis=1)) for old in history])
        self.compared = 0

    def exact(self, vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
        self.compared += len(vectors)
        apart = vectors - centroid
        return np.einsum("ij,ij->i", apart, apart)

    def assign(self, v: np.ndarray, cluster: np.ndarray, known: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Squared distances to the nearest centroids; changes ``cluster``, ``known`` and ``seen`` in place.

        ``seen`` is the round of the last comparison, -1 for none, and ``known`` the distance then.
        """
        k, now = len(self.history[-1]), self.history[-1]
        rows = np.arange(len(v))
        best = np.full(len(v), np.iinfo(np.int64).max)
        own = np.maximum(cluster, 0)
        for j in range(k):  # the own centroid first: its exact distance is what all bounds are held against
            at = rows[own == j]
            if len(at):
                best[at] = self.exact(v[at], now[j])
                known[at, j], seen[at, j] = np.sqrt(best[at]), self.now
        cluster[:] = own
        reach = np.sqrt(best.astype(float)) * (1 + SLACK)
        moved = self.moved[np.maximum(seen, 0), np.arange(k)]
        least = known * (1 - SLACK) - moved * (1 + SLACK)
        failed = (seen < 0) | (least <= reach[:, None])
        failed[rows, own] = False
        for j in range(k):
            at = rows[failed[:, j]]
            if len(at):
                found = self.exact(v[at], now[j])
                known[at, j], seen[at, j] = np.sqrt(found), self.now
                nearer = (found < best[at]) | ((found == best[at]) & (j < cluster[at]))
                best[at[nearer]], cluster[at[nearer]] = found[nearer], j
        return best


def _assigner(history: list[np.ndarray]):
    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bounds, k = Bounds(history), len(history[-1])
        for whole in frames:
            for start in range(0, len(whole), TOGETHER):
                frame = whole.iloc[start : start + TOGETHER]
                v = np.stack(frame["v"].to_numpy())
                cluster = frame["cluster"].to_numpy(np.int32, copy=True)
                # Bounds are stored in single precision; the slack is larger than its error.
                if len(history) == 1:
                    known, seen = np.zeros((len(v), k), np.float32), np.full((len(v), k), -1, np.int8)
                else:
                    known = np.frombuffer(b"".join(frame["known"]), np.float32).reshape(-1, k).copy()
                    seen = np.frombuffer(b"".join(frame["seen"]), np.int8).reshape(-1, k).copy()
                before = bounds.compared
                distance = bounds.assign(v, cluster, known, seen)
                out = pd.DataFrame({"vec_id": frame["vec_id"].to_numpy(), "v": list(v), "cluster": cluster, "distance": distance})
                out["known"], out["seen"] = [x.tobytes() for x in known], [x.tobytes() for x in seen]
                out["compared"] = 0
                out.loc[0, "compared"] = bounds.compared - before
                yield out

    return assign


def _moved(state: DataFrame, old: np.ndarray) -> np.ndarray:
    """Centroids after ``state``: the floor of the mean, exactly; an empty cluster's stays."""
    components = old.shape[1]
    sums = [F.sum(F.col("v")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(components)]
    new = old.copy()
    for row in state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # a row per cluster
        new[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(components)]
    return new


STATE = "vec_id string, v array<long>, cluster int, distance long, known binary, seen binary, compared long"


def clustered(
    rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE
) -> tuple[DataFrame, list[np.ndarray], list[int]]:
    """Final state (vec_id, v, cluster, distance), the history of centroids, and comparisons per assignment.

    A round reads the state written by the one before and writes its own; sums per cluster combine
    map-side, and only k rows of them reach the driver. So a lost executor repeats tasks of one round.
    """
    if not 1 <= rounds <= 126:
        raise ValueError("rounds must be between 1 and 126")
    vectors = staged(whole_vectors(rows, components, scale), "vectors")
    history, compared = [first_centroids(vectors, clusters, components)], []
    blank = F.lit(None).cast("binary")
    state = vectors.select(F.col("vec_id").cast("string").alias("vec_id"), "v", F.lit(-1).alias("cluster"), blank.alias("known"), blank.alias("seen"))
    for i in range(rounds + 1):
        last, state = state, staged(state.mapInPandas(_assigner(history), STATE), "assigned")
        compared.append(state.agg(F.sum("compared")).first()[0] or 0)
        deleted(vectors if i == 0 else last)
        if i < rounds:
            history.append(_moved(state, history[-1]))
            state = state.drop("distance", "compared")
    return state.select(F.col("vec_id").cast("long").alias("vec_id"), "v", "cluster", "distance"), history, compared


def centroid_clusters(rows: DataFrame, **options) -> DataFrame:
    """Per kept row of ``rows``: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors that are null, of another length, or hold a null or a value that is not finite are not kept.
    Repeated rows and null ids stay; a null id is last in the choice of first centroids, and of equal ids
    the smaller vector is first. With fewer kept vectors than clusters each is a centroid; equal centroids
    leave the later one empty. A component of 524,288 or more ends the query, as its distances do not fit
    the result's type. Other columns are ignored. An empty table gives no rows.
    """
    state, history, _ = clustered(rows, **options)
    total = F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")
    sums = {row["cluster"]: int(row["s"]) for row in state.groupBy("cluster").agg(total).collect()}  # a row per cluster
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in history[-1].tolist()]
    values = [(j, sums.get(j, 0), sum(sums.values()), mark) for j, mark in enumerate(marks)]
    few = rows.sparkSession.createDataFrame(values, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(few), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


def op11_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same rounds without bounds; sums divide by flooring."""
    parts = [
        f"""kept AS (SELECT row_number() OVER () AS r, vec_id, x FROM (
    SELECT vec_id, list_transform(embedding, lambda e: e::DOUBLE) AS x FROM embeddings)
  WHERE len(x) = {COMPONENTS} AND len(list_filter(x, lambda e: e IS NOT NULL AND isfinite(e))) = {COMPONENTS}),
whole AS MATERIALIZED (SELECT r, vec_id, list_transform(x, lambda e: floor({SCALE} * e)::BIGINT) AS v FROM kept),
cells AS MATERIALIZED (SELECT r, unnest(v) AS x, unnest(range({COMPONENTS})) AS d FROM whole),
first AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM whole
  QUALIFY c < {clusters}),
c0 AS MATERIALIZED (SELECT c, unnest(v) AS y, unnest(range({COMPONENTS})) AS d FROM first)"""
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (SELECT r, min(s * 1000 + c) % 1000 AS c, min(s) AS s FROM (
  SELECT r, c, sum((x - y) * (x - y)) AS s FROM cells JOIN c{i} USING (d) GROUP BY r, c) GROUP BY r)"""
        )
        if i < rounds:
            parts.append(
                f"""m{i} AS (SELECT c, d, sum(x) AS t, count(*) AS n FROM cells JOIN a{i} USING (r) GROUP BY c, d),
c{i + 1} AS MATERIALIZED (SELECT k.c, k.d, CASE WHEN n IS NULL THEN y ELSE (t - ((t % n) + n) % n) // n END AS y
  FROM c{i} k LEFT JOIN m{i} m ON k.c = m.c AND k.d = m.d)"""
            )
    last = f"a{rounds}"
    return f"""WITH {", ".join(parts)},
marks AS (SELECT c, sha256(string_agg(CAST(y AS BIGINT)::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, s::BIGINT AS distance, (sum(s) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(s) OVER ())::BIGINT AS inertia, centroid_sha256
FROM {last} JOIN whole USING (r) JOIN marks USING (c)"""


OP11_SQL = op11_sql()
