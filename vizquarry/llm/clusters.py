"""Centroid clustering by the Shallot search: exact k-means on integer vectors.

Each vector remembers its nearest and second-nearest centroid, an upper bound on the distance to the first and a lower
bound on the distance to every other one. Bounds move with the centroids. A vector whose upper bound stays below its
lower bound keeps its centroid unseen, and one whose distance to it does so is done after that one distance. The others
start from the closer of the two remembered centroids and go through that centroid's neighbours, sorted by
distance from it: a neighbour at distance r is at least r - d away from a vector at distance d, so the search ends
where that exceeds the second-smallest distance found so far, a ball that shrinks with each closer centroid. Bounds
only rule out; centroids that remain are compared by integer squared distances, ties going to the smaller number.

The state (vector, two centroids, two bounds) is one stored table a round, written by one pass and removed once its successor
is there; sums of a round change by the vectors that moved only, and k x dimensions of them reach the driver. A lost executor costs its tasks.

Defined results: null vectors, vectors of another length and vectors with a null or non-finite component take no part,
nor do extra columns; equal vectors get equal rows, and rows repeated under one id stay repeated; a null id is hashed as an empty
text; ids of equal hash, which are repeated ids, start in the order of their vectors; with fewer vectors than centroids each starts one;
an empty table gives an empty result. A component of 2^26 or more after scaling ends the query with an error, as squared
distances would not fit.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from vizquarry.session import remove, stored

#: Largest magnitude of a component: squared distances of 64 such differences stay below 2^62.
LARGEST = 1 << 26
#: Bounds are rounded outwards by this factor, far more than their rounding errors.
SLACK = 1e-9


def integers(vector: Column, scale: int) -> Column:
    """The components times ``scale``, rounded down; components must be finite."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    """Not null, and without a null or non-finite component."""
    infinite = F.lit(float("inf"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < infinite))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.einsum("ij,ij->i", d, d)


class Centroids:
    """The centroids of a round, their sorted neighbours and how far each has moved since the round before."""

    def __init__(self, at: np.ndarray, before: np.ndarray | None = None):
        self.at = at
        gaps = at[:, None, :] - at[None, :, :]
        self.apart = np.sqrt(np.einsum("ijk,ijk->ij", gaps, gaps).astype(np.float64))
        self.order = np.argsort(self.apart, axis=1, kind="stable")
        self.moved = np.zeros(len(at)) if before is None else np.sqrt(squared(at, before).astype(np.float64)) * (1 + SLACK)
        largest = np.argsort(-self.moved, kind="stable")[:2]
        #: How far any other centroid than the given one has moved.
        self.others_moved = np.full(len(at), self.moved[largest[0]])
        self.others_moved[largest[0]] = self.moved[largest[1]] if len(at) > 1 else 0.0


def search(x: np.ndarray, near: np.ndarray, second: np.ndarray, c: Centroids) -> tuple[np.ndarray, ...]:
    """(number, squared distance) of the nearest and second-nearest centroid, from two remembered ones."""
    d1, d2 = squared(x, c.at[near]), squared(x, c.at[second])
    swap = (d2 < d1) | ((d2 == d1) & (second < near))
    one, two = np.where(swap, second, near), np.where(swap, near, second)
    d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
    start, passed = one.copy(), two.copy()
    reach = np.sqrt(d1.astype(np.float64))
    for s in np.unique(start):
        live = np.flatnonzero(start == s)
        for j in c.order[s]:
            # The ball: no centroid further from s than this can be among the two nearest.
            live = live[c.apart[s, j] * (1 - SLACK) <= (reach[live] + np.sqrt(d2[live].astype(np.float64))) * (1 + SLACK)]
            if not len(live):
                break
            ask = live[passed[live] != j] if j != s else live[:0]
            if not len(ask):
                continue
            d = squared(x[ask], c.at[j])
            first = (d < d1[ask]) | ((d == d1[ask]) & (j < one[ask]))
            next_ = ~first & ((d < d2[ask]) | ((d == d2[ask]) & (j < two[ask])))
            a, b = ask[first], ask[next_]
            two[a], d2[a] = one[a], d1[a]
            one[a], d1[a] = j, d[first]
            two[b], d2[b] = j, d[next_]
    return one, d1, two, d2


def assign(x: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray, c: Centroids):
    """The state after a round: nearest, second, upper and lower bound, and how many vectors were searched."""
    near, second = near.copy(), second.copy()
    upper = (upper + c.moved[near]) * (1 + SLACK)
    lower = np.maximum(0.0, (lower - c.others_moved[near]) * (1 - SLACK))
    if len(c.at) == 1:
        return near, second, upper, lower, 0
    open_ = np.flatnonzero(upper >= lower)
    upper[open_] = np.sqrt(squared(x[open_], c.at[near[open_]]).astype(np.float64)) * (1 + SLACK)
    open_ = open_[upper[open_] >= lower[open_]]
    one, d1, two, d2 = search(x[open_], near[open_], second[open_], c)
    near[open_], second[open_] = one, two
    upper[open_] = np.sqrt(d1.astype(np.float64)) * (1 + SLACK)
    lower[open_] = np.sqrt(d2.astype(np.float64)) * (1 - SLACK)
    return near, second, upper, lower, len(open_)


def _matrix(column, dims: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) and max(-int(flat.min()), int(flat.max())) >= LARGEST:
        raise ValueError(f"a component of {LARGEST} or more after scaling")
    return flat.reshape(-1, dims)


def _round(c: Centroids, dims: int, first: bool):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            if first:
                was = np.full(len(x), -1)
                near, upper = np.zeros(len(x), np.int64), np.full(len(x), np.inf)
                second, lower = np.full(len(x), min(1, len(c.at) - 1)), np.zeros(len(x))
            else:
                was, second, upper, lower = (batch.column(k).to_numpy() for k in ("cluster", "second", "upper", "lower"))
                was, second = was.astype(np.int64), second.astype(np.int64)
                near = was
            near, second, upper, lower, _ = assign(x, near, second, upper, lower, c)
            columns = [batch.column("vec_id"), batch.column("x")]
            columns += [pa.array(v, pa.int32()) for v in (near, second, was)] + [pa.array(v, pa.float64()) for v in (upper, lower)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "x", "cluster", "second", "was", "upper", "lower"])

    return run


def _moves(dims: int, k: int):
    """What the vectors of a partition that moved add to the sums and counts of the clusters."""

    def run(batches):
        import pyarrow as pa

        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            to, was = batch.column("cluster").to_numpy(), batch.column("was").to_numpy()
            for j in np.unique(to):
                sums[j] += x[to == j].sum(axis=0)
                counts[j] += int((to == j).sum())
            for j in np.unique(was[was >= 0]):
                sums[j] -= x[was == j].sum(axis=0)
                counts[j] -= int((was == j).sum())
        rows = np.concatenate([sums, counts[:, None]], axis=1)
        at = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(rows[at].tolist(), pa.list_(pa.int64()))], ["cluster", "sums"]
        )

    return run


def _measured(c: Centroids, dims: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            found = [batch.column(k).to_numpy() for k in ("cluster", "second", "upper", "lower")]
            near, _, _, _, _ = assign(x, found[0].astype(np.int64), found[1].astype(np.int64), found[2], found[3], c)
            columns = [batch.column("vec_id"), pa.array(near, pa.int32()), pa.array(squared(x, c.at[near]), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return run


def initial(vectors: DataFrame, k: int) -> np.ndarray:
    """The k vectors of smallest sha256 of ``2:<id>``; the only vectors that reach the driver."""
    name = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(name.alias("name"), "x").orderBy("name", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], dtype=np.int64)


def cluster(
    table: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """One row for each kept vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = table.sparkSession
    own = F.col(vector)
    vectors = table.select(F.col(id_column).alias("vec_id"), own.alias("v")).where(usable(F.col("v")) & (F.size("v") == dims))
    vectors = vectors.select("vec_id", integers(F.col("v"), scale).alias("x"))
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    result = f"vec_id {id_type}, cluster int, distance long"
    at = initial(vectors, k)
    if not len(at):
        done = spark.createDataFrame([], result + ", cluster_inertia long, inertia long, centroid_sha256 string")
        return done.withColumnRenamed("vec_id", id_column)
    k = len(at)
    schema = f"vec_id {id_type}, x array<bigint>, cluster int, second int, was int, upper double, lower double"
    state, path, before = vectors, None, None
    sums, counts = [[0] * dims for _ in range(k)], [0] * k
    for turn in range(rounds):
        done, new_path = stored(state.mapInArrow(_round(Centroids(at, before), dims, turn == 0), schema))
        if path:
            remove(spark, path)
        state, path, before = done, new_path, at
        moved = state.where("cluster <> was").select("x", "cluster", "was").mapInArrow(_moves(dims, k), "cluster int, sums array<long>")
        summed = moved.select("cluster", F.posexplode("sums")).groupBy("cluster", "pos").agg(F.sum("col").alias("s"))
        for j, p, s in summed.collect():  # k x (dims + 1) rows at most
            if p == dims:
                counts[j] += s
            else:
                sums[j][p] += s
        at = np.array([[s // counts[j] for s in sums[j]] if counts[j] else before[j].tolist() for j in range(k)], dtype=np.int64)
    if path is None:
        state, path = stored(state.mapInArrow(_round(Centroids(at), dims, True), schema))
    final, _ = stored(state.mapInArrow(_measured(Centroids(at, before), dims), result))
    remove(spark, path)
    names = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in at.tolist()]
    named = final.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows at most
    overall = sum(r["cluster_inertia"] for r in named)
    clusters = spark.createDataFrame(
        [(r["cluster"], r["cluster_inertia"], overall, names[r["cluster"]]) for r in named],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    out = final.join(F.broadcast(clusters), "cluster")
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return out.select(*columns).withColumnRenamed("vec_id", id_column)


def check(k: int = 40, rounds: int = 5) -> str:
    """The same rows by plain assignment to all centroids, in SQL."""
    steps = [f"""WITH base AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda v: floor(v::DOUBLE * 256)) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS c, x FROM base
    QUALIFY c < {k}
)"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
    SELECT b.vec_id, any_value(b.x) AS x, min({{'d': list_dot_product(b.x, b.x) - 2 * list_dot_product(b.x, c.x) + list_dot_product(c.x, c.x), 'c': c.c}}) AS m
    FROM (SELECT *, row_number() OVER () AS at FROM base) b CROSS JOIN c{r} c GROUP BY b.at, b.vec_id
)""")
        if r < rounds:
            steps.append(f"""s{r} AS (
    SELECT c, list(floor(s / n) ORDER BY p) AS x
    FROM (SELECT c, p, sum(v) AS s, count(*) AS n FROM (SELECT m.c AS c, unnest(x) AS v, generate_subscripts(x, 1) AS p FROM a{r}) GROUP BY c, p)
    GROUP BY c
), c{r + 1} AS MATERIALIZED (
    SELECT c.c, coalesce(s.x, c.x) AS x FROM c{r} c LEFT JOIN s{r} s ON s.c = c.c
)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, m.c::INTEGER AS cluster, m.d::BIGINT AS distance,
    sum(m.d::BIGINT) OVER (PARTITION BY m.c)::BIGINT AS cluster_inertia, sum(m.d::BIGINT) OVER ()::BIGINT AS inertia,
    sha256(array_to_string(list_transform(c.x, lambda v: v::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.c = a.m.c"""
