"""K-means (M8).

Centroids travel with the task (k x d numbers), so assigning a point joins
nothing.  ``assign`` and ``lloyd_step`` are plain expressions over a literal array
(array functions, which Spark interprets per row); the fit assigns whole Arrow
batches in numpy, and its iterations are one distributed aggregation each, of
which k x d means return to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _centroid_literal(centroids: list[list[float]]) -> Column:
    return F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centroids])


def _euclid(v: Column, c: Column) -> Column:
    sq = F.zip_with(v, c, lambda a, b: (a - b) * (a - b))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x))


def assign(points: DataFrame, centroids: list[list[float]], vec: str = "embedding") -> DataFrame:
    """Nearest centroid by Euclidean distance; ties go to the lower index.
    Adds ``cluster`` (0-based) and ``distance``."""
    best = _nearest(F.col(vec), centroids)
    return (points.select("*", best.alias("__best"))
                  .select(*points.columns, F.col("__best.i").alias("cluster"),
                          F.col("__best.d").alias("distance")))


def _nearest(vec_col, centroids: list[list[float]]) -> Column:
    cents = _centroid_literal(centroids)
    v = F.transform(vec_col, lambda x: x.cast("double"))
    return F.array_min(F.transform(cents, lambda c, i: F.struct(_euclid(v, c).alias("d"),
                                                               i.alias("i"))))


def _cluster_means(assigned: DataFrame, vec: str, changed=None) -> DataFrame:
    """(cluster, position, mean[, changed]): coordinate means per cluster,
    and (on position 0, so once per point) how many points changed cluster."""
    cols = [F.col("cluster"), F.posexplode(F.col(vec)).alias("position", "x")]
    if changed is not None:
        cols.insert(1, changed.cast("long").alias("chg"))
    aggs = [F.avg(F.col("x").cast("double")).alias("mean")]
    if changed is not None:
        aggs.append(F.sum(F.when(F.col("position") == 0, F.col("chg"))).alias("changed"))
    return assigned.select(*cols).groupBy("cluster", "position").agg(*aggs)


def step_means(assigned: DataFrame, vec: str = "embedding") -> DataFrame:
    """Mean of every coordinate per cluster, long format (cluster, position, mean)."""
    return _cluster_means(assigned, vec)


def lloyd_step(points: DataFrame, centroids: list[list[float]], vec: str = "embedding") -> DataFrame:
    """One iteration: assign, then average per cluster (long format)."""
    return step_means(assign(points, centroids, vec), vec)


def first_k(points: DataFrame, k: int, order: str, vec: str = "embedding") -> list[list[float]]:
    """Deterministic start: the vectors of the ``k`` smallest ``order`` keys
    (a top-k; the reference draws k random rows)."""
    rows = points.orderBy(order).limit(k).select(vec).collect()
    return [[float(x) for x in r[0]] for r in rows]


def random_k(points: DataFrame, k: int, order: str, seed: int, vec: str = "embedding") -> list[list[float]]:
    """A random start: ``k`` rows in the order of a hash of the seed and the row's ``order`` key.
    The same rows however the table is partitioned; rows of one key are told apart by
    their vectors."""
    rank = F.md5(F.concat(F.lit(f"{seed}:").cast("binary"), F.col(order).cast("string").cast("binary")))
    rows = points.orderBy(rank, F.col(vec)).limit(k).select(vec).collect()
    return [[float(x) for x in r[0]] for r in rows]


def _distances(x, cents):
    """Squared distance of every row of ``x`` to every centroid, by direct
    differences (the expanded form loses digits where norms are large)."""
    import numpy as np

    out = np.empty((len(x), len(cents)))
    for i, c in enumerate(cents):
        diff = x - c
        out[:, i] = np.einsum("ij,ij->i", diff, diff)
    return out


def _matrix(column):
    """An Arrow column of lists as a matrix of doubles; vectors that are null or of other lengths
    are an error, null entries are NaN."""
    import numpy as np

    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if column.null_count or len(set(sizes.tolist())) > 1:
        raise ValueError("vectors must be there and of one length")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(sizes), -1)


def _assign_batches(vec: str, cents):
    import numpy as np
    import pyarrow as pa

    c = np.asarray(cents, dtype=np.float64)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            d2 = _distances(_matrix(batch.column(batch.schema.get_field_index(vec))), c)
            best = d2.argmin(1)
            dist = np.sqrt(d2[np.arange(len(best)), best])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best.astype(np.int32)), pa.array(dist), pa.array(dist * dist)],
                [*batch.schema.names, "cluster", "distance", "sq_error"])
    return run


#: bytes of doubles in one stored block of vectors
BLOCK_BYTES = 1 << 22


def _blocks(vec: str):
    """mapInArrow body: vectors as blocks of doubles, which every iteration reads without
    unpacking a vector."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(batch.schema.get_field_index(vec)))
            step = max(1, BLOCK_BYTES // (8 * max(1, x.shape[1])))
            for i in range(0, len(x), step):
                part = x[i:i + step]
                yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int64()), pa.array([part.tobytes()], pa.binary())],
                                                 ["n", "block"])
    return run


def _partial_sums(cents, prevs):
    """mapInArrow body over blocks: nearest centroid of every vector under the new and the
    previous centroids of every run (``cents`` and ``prevs`` by run); per-cluster sums
    accumulate over the whole partition, so k * d rows a run leave each task."""
    import numpy as np
    import pyarrow as pa

    new = {run: np.asarray(c, dtype=np.float64) for run, c in cents.items()}
    old = {run: np.asarray(c, dtype=np.float64) for run, c in prevs.items() if c is not None}

    def sums(batches):
        n = {run: np.zeros(len(c), dtype=np.int64) for run, c in new.items()}
        moved = {run: np.zeros(len(c), dtype=np.int64) for run, c in new.items()}
        total = {run: np.zeros(c.shape) for run, c in new.items()}
        for batch in batches:
            for rows, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(block.as_buffer(), dtype=np.float64).reshape(rows, -1)
                for run, c in new.items():
                    a = _distances(x, c).argmin(1)  # the first (lowest index) on ties
                    changed = np.ones(rows, dtype=bool) if run not in old else a != _distances(x, old[run]).argmin(1)
                    n[run] += np.bincount(a, minlength=len(c))
                    moved[run] += np.bincount(a[changed], minlength=len(c))
                    for j in range(len(c)):
                        total[run][j] += x[a == j].sum(0)
        # long format (run, cluster, position, sum); the point and change counts
        # ride on position 0 so they are added once per cluster
        for run, c in new.items():
            k, d = c.shape
            cl, pos = (m.ravel() for m in np.meshgrid(np.arange(k), np.arange(d), indexing="ij"))
            first = pos == 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k * d, run, dtype=np.int32)), pa.array(cl.astype(np.int32)), pa.array(pos.astype(np.int32)),
                 pa.array(total[run].ravel()), pa.array(np.where(first, n[run][cl], 0)),
                 pa.array(np.where(first, moved[run][cl], 0))], ["run", "cluster", "position", "s", "n", "changed"])
    return sums


#: vectors of one task of an iteration
TASK_VECTORS = 200_000


def _fits(points: DataFrame, starts: list, vec: str, max_iter: int | None) -> list[list[list[float]]]:
    """Lloyd's algorithm from every start, all in the same passes over the vectors; a run whose
    points keep their clusters takes no further part."""
    from pyspark import StorageLevel

    spark = points.sparkSession
    cents, prevs, n_iter = dict(enumerate(starts)), {run: None for run in range(len(starts))}, 0
    schema = "run int, cluster int, position int, s double, n long, changed long"
    rows = points.select(vec)
    # the blocks are read once per iteration: keep them (memory, spilling to disk) for the loop,
    # as MLlib's KMeans does, in enough parts for every core; a lost one is made anew from the source
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows.count() // TASK_VECTORS))
    blocks = rows.repartition(tasks).mapInArrow(_blocks(vec), "n long, block binary").persist(StorageLevel.MEMORY_AND_DISK)
    left = set(cents)
    try:
        while left:
            if max_iter is not None and n_iter >= max_iter:
                raise RuntimeError(f"points still change cluster after {max_iter} iterations")
            n_iter += 1
            parts = blocks.mapInArrow(_partial_sums({r: cents[r] for r in left}, {r: prevs[r] for r in left}), schema)
            per_cluster = (parts.groupBy("run", "cluster", "position")
                           .agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("changed").alias("changed"))
                           .collect())  # k * d rows a run
            for run in list(left):
                mine = [r for r in per_cluster if r["run"] == run]
                if prevs[run] is not None and sum(r["changed"] or 0 for r in mine) == 0:
                    left.discard(run)
                    continue
                sizes = {r["cluster"]: r["n"] for r in mine if r["position"] == 0}
                new = [list(c) for c in cents[run]]
                for r in mine:
                    if sizes.get(r["cluster"]):  # an empty cluster keeps its centroid
                        new[r["cluster"]][r["position"]] = r["s"] / sizes[r["cluster"]]
                prevs[run], cents[run] = cents[run], new
    finally:
        blocks.unpersist()
    return [cents[run] for run in range(len(starts))]


def _assigned(points: DataFrame, cents: list[list[float]], vec: str) -> DataFrame:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema.fields)
    return points.mapInArrow(_assign_batches(vec, cents), fields + ", cluster int, distance double, sq_error double")


def kmeans(points: DataFrame, k: int, order: str, vec: str = "embedding", max_iter: int | None = None,
           start: list[list[float]] | None = None) -> tuple[list[list[float]], DataFrame]:
    """Lloyd's algorithm until no point changes cluster (the reference's
    rule).  One job per iteration: each partition assigns its points under
    the new and the previous centroids and emits per-cluster partial sums
    (``mapInArrow``, numpy inside the task); Spark adds them up by
    (cluster, coordinate); k * d means and k change counts reach the
    driver.  An empty cluster keeps its previous centroid.  Returns the
    centroids and the final (lazy) assignment with squared errors.

    ``start`` gives the first centroids; unset, they are those of ``first_k``.
    ``max_iter`` bounds the iterations; reaching it with points still moving
    raises, so an unfinished result is never returned.  Nearest-centroid ties
    go to the lower index; the fit and the final assignment measure alike."""
    cents, = _fits(points, [first_k(points, k, order, vec) if start is None else start], vec, max_iter)
    return cents, _assigned(points, cents, vec)


def restarts(points: DataFrame, k: int, order: str, seeds: list[int], vec: str = "embedding",
             max_iter: int | None = None) -> tuple[int, list[list[float]], DataFrame]:
    """K-means from a random start per seed; the fit with the lowest sum of squared errors is
    kept (of equals, the first seed's).  Returns its seed, centroids and assignment."""
    starts = [random_k(points, k, order, seed, vec) for seed in seeds]
    best = None
    for seed, cents in zip(seeds, _fits(points, starts, vec, max_iter)):  # the seeds share their passes
        assigned = _assigned(points, cents, vec)
        error = assigned.agg(F.sum("sq_error")).first()[0]
        if best is None or error < best[0]:
            best = (error, seed, cents, assigned)
    return best[1:]
