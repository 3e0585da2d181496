"""Exact centroid clustering with the Shallot search.

Every vector remembers its centroid, the second-nearest one, an upper bound on
its distance to the first and a lower bound on its distance to all others. A
round moves the bounds by how far the centroids moved. A vector whose bounds
still part the two (or whose upper bound is below half the way to its
centroid's nearest neighbour) needs no search. The others start from the closer
of the two remembered centroids and scan that one's neighbours in order of
distance. The ball to scan has the radius "distance to the start plus distance
to the second-nearest so far", so it shrinks with every better one found. Bounds
are floating point with a margin; whatever they leave is compared by exact
integer distances, ties to the smaller number.

One map over the vectors per round, no shuffle of vectors: the state travels
with its vector, and a task adds up its vectors per centroid before anything is
sent. What reaches the driver are the k x dims sums. The table of a round is
written to the shared folder and the one before it is removed, so a lost
executor costs a part of one round.

Edge rows: a vector that is null, of another length, or holds a null or
non-finite component takes no part. A null id stays null and comes last among the
first centroids. Repeated rows count each, also among the first centroids, where
equal ids are ordered by their components. With fewer vectors than k there are
as many centroids as vectors; an empty table gives no rows. Extra columns are
not read. Components of any finite size are exact (wide ones in Python's
integers); a distance or sum that does not fit a long is null.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm.common import prepare
from haulage.llm.registry import query, table
from haulage.session import scratch_path

CLUSTERS, ROUNDS, SCALE, DIMS, SEED = 16, 3, 64, 64, 1
BLOCK_ROWS = 4096  # vectors that a task handles at once
MARGIN = 1e-9      # bounds differ by more than rounding can make
LIMB = 40          # bits of one part of a wide sum
LONG_MAX = (1 << 63) - 1

_STATE = ("vec_id long, w byte, v binary, cluster int, second int, upper double, lower double, distance long, "
          "sums array<struct<c:int,d:int,part:int,n:long>>")


def usable(vector, dims: int):
    """True for a vector of ``dims`` finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dims) & ~bad, F.lit(False))


def widest(dims: int) -> int:
    """Components up to this size have squared distances that fit 64 bits."""
    return int(np.sqrt((1 << 60) / max(dims, 1)))


def quantise(x: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """floor(scale * x), as int64 or, if wider than ``limit``, as Python integers."""
    with np.errstate(over="ignore"):
        y = np.floor(x * float(scale))
    if len(y) == 0 or np.abs(y).max() <= limit:
        return y.astype(np.int64)
    # a double this wide is an integer, so the product is taken in integers
    wide = [[int(f) if abs(f) <= limit else int(v) * scale if abs(v) >= 1 << 53 else int(f) for f, v in zip(a, b)]
            for a, b in zip(y.tolist(), x.tolist())]
    return np.array(wide, object)


def _pack(x: np.ndarray) -> tuple[int, list[bytes]]:
    if x.dtype == object:
        return 0, [",".join(map(str, r)).encode() for r in x.tolist()]
    most = int(np.abs(x).max()) if x.size else 0
    kind = next(t for t in (np.int8, np.int16, np.int32) if most <= np.iinfo(t).max)
    return np.dtype(kind).itemsize, [r.tobytes() for r in x.astype(kind)]


def _unpack(widths: np.ndarray, rows: list[bytes], dims: int) -> np.ndarray:
    if (widths == 0).any():
        out = np.empty((len(rows), dims), object)
        for i, (w, r) in enumerate(zip(widths.tolist(), rows)):
            out[i] = [int(t) for t in r.split(b",")] if w == 0 else np.frombuffer(r, f"i{w}").tolist()
        return out
    out = np.empty((len(rows), dims), np.int64)
    for w in np.unique(widths).tolist():
        at = np.flatnonzero(widths == w)
        out[at] = np.frombuffer(b"".join([rows[i] for i in at.tolist()]), f"i{w}").reshape(len(at), dims)
    return out


def _length(squared: int) -> float:
    """Root of a squared distance of any size; a bound beyond 1e300 leaves everything to the integers."""
    return min(math.sqrt(squared) if squared < 1 << 1000 else float(min(math.isqrt(squared), 10 ** 300)), 1e300)


def _root(d: np.ndarray) -> np.ndarray:
    if d.dtype == object:
        return np.array([_length(int(v)) for v in d], np.float64)
    return np.sqrt(d.astype(np.float64))


class Search:
    """Centroids as integers, with what the search needs of them."""

    def __init__(self, centroids: list[list[int]], before: list[list[int]] | None, limit: int):
        wide = any(abs(c) > limit for row in centroids for c in row)
        self.c = np.array(centroids, object if wide else np.int64)
        k = self.k = len(centroids)
        far = lambda a, b: _length(sum((p - q) ** 2 for p, q in zip(a, b)))
        between = np.array([[far(a, b) for b in centroids] for a in centroids]).reshape(k, k)
        self.between = between * (1 - MARGIN)
        self.order = np.argsort(between + np.diag([-1.0] * k), axis=1, kind="stable")
        off = self.between + np.diag([np.inf] * k)
        self.half = off.min(axis=1) / 2
        moved = np.zeros(k)
        if before is not None:
            moved = np.array([far(a, b) for a, b in zip(centroids, before)]) * (1 + MARGIN)
        self.moved = moved
        self.others = np.array([max([m for j, m in enumerate(moved) if j != i], default=0.0) for i in range(k)])

    def exact(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Squared distances of the vectors to one centroid each."""
        diff = x - self.c[which]
        return (diff * diff).sum(axis=1)

    def assign(self, x, cluster, second, upper, lower):
        """New (cluster, second, upper, lower) and how many distances were computed."""
        upper = (upper + self.moved[cluster]) * (1 + MARGIN)
        lower = (lower - self.others[cluster]) * (1 - MARGIN)
        cluster, second, upper, lower = cluster.copy(), second.copy(), upper, np.maximum(lower, 0)
        rows = np.flatnonzero(upper >= np.maximum(lower, self.half[cluster]))
        cost = len(rows)
        if len(rows) == 0:
            return cluster, second, upper, lower, cost
        d1 = self.exact(x[rows], cluster[rows])
        upper[rows] = _root(d1) * (1 + MARGIN)
        still = upper[rows] >= np.maximum(lower[rows], self.half[cluster[rows]])
        rows, d1 = rows[still], d1[still]
        if len(rows) == 0 or self.k == 1:
            lower[rows] = np.inf
            return cluster, second, upper, lower, cost
        y, c1, c2 = x[rows], cluster[rows], second[rows]
        d2 = self.exact(y, c2)
        cost += len(rows)
        closer = (d2 < d1) | ((d2 == d1) & (c2 < c1))
        c1, c2 = np.where(closer, c2, c1), np.where(closer, c1, c2)
        d1, d2 = np.where(closer, d2, d1), np.where(closer, d1, d2)
        start, known, reach = c1.copy(), c2.copy(), _root(d1)
        open_rows = np.arange(len(rows))
        for step in range(1, self.k):
            j = self.order[start[open_rows], step]
            inside = self.between[start[open_rows], j] <= (reach[open_rows] + _root(d2[open_rows])) * (1 + MARGIN)
            open_rows, j = open_rows[inside], j[inside]  # neighbours come in order: whoever is outside is done
            if len(open_rows) == 0:
                break
            fresh = j != known[open_rows]
            at, j = open_rows[fresh], j[fresh]
            if len(at) == 0:
                continue
            d = self.exact(y[at], j)
            cost += len(at)
            first = (d < d1[at]) | ((d == d1[at]) & (j < c1[at]))
            next_best = ~first & ((d < d2[at]) | ((d == d2[at]) & (j < c2[at])))
            a, b = at[first], at[next_best]
            d2[a], c2[a] = d1[a], c1[a]
            d1[a], c1[a] = d[first], j[first]
            d2[b], c2[b] = d[next_best], j[next_best]
        cluster[rows], second[rows] = c1, c2
        upper[rows], lower[rows] = _root(d1) * (1 + MARGIN), _root(d2) * (1 - MARGIN)
        return cluster, second, upper, lower, cost


class _Sums:
    """Sums and counts per centroid of one task."""

    def __init__(self, k: int, dims: int):
        self.n, self.narrow, self.wide = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), {}

    def add(self, x: np.ndarray, cluster: np.ndarray) -> None:
        self.n += np.bincount(cluster, minlength=len(self.n))
        if x.dtype != object:
            np.add.at(self.narrow, cluster, x)
            return
        for c, row in zip(cluster.tolist(), x.tolist()):
            held = self.wide.setdefault(c, [0] * len(row))
            self.wide[c] = [int(p) + int(q) for p, q in zip(held, row)]

    def rows(self) -> list[dict]:
        """One entry per centroid, component (-1: the count) and part of the sum."""
        out = [{"c": c, "d": -1, "part": 0, "n": n} for c, n in enumerate(self.n.tolist()) if n]
        totals = [(c, d, v) for c, row in enumerate(self.narrow.tolist()) for d, v in enumerate(row) if v]
        totals += [(c, d, v) for c, row in self.wide.items() for d, v in enumerate(row) if v]
        for c, d, v in totals:
            part = 0
            while abs(v) >= 1 << 62:
                out.append({"c": c, "d": d, "part": part, "n": v & (1 << LIMB) - 1})
                v, part = v >> LIMB, part + 1
            out.append({"c": c, "d": d, "part": part, "n": v})
        return out


def _blocks(batches, columns):
    """The batches joined to blocks of about BLOCK_ROWS rows."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= BLOCK_ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _state_schema() -> pa.Schema:
    part = pa.struct([("c", pa.int32()), ("d", pa.int32()), ("part", pa.int32()), ("n", pa.int64())])
    return pa.schema([("vec_id", pa.int64()), ("w", pa.int8()), ("v", pa.binary()), ("cluster", pa.int32()), ("second", pa.int32()),
                      ("upper", pa.float64()), ("lower", pa.float64()), ("distance", pa.int64()), ("sums", pa.list_(part))])


def _round(search: Search, scale: int, dims: int, limit: int, first: bool):
    """One pass over the vectors: new state rows, and a last row per task with its sums."""
    def run(batches):
        schema = _state_schema()
        sums = _Sums(search.k, dims)
        for t in _blocks(batches, schema):
            n = t.num_rows
            if first:
                values = t.column("v").combine_chunks()
                x = quantise(np.asarray(values.flatten(), np.float64).reshape(n, dims), scale, limit)
                width, packed = _pack(x)
                w, v = pa.array(np.full(n, width, np.int8)), pa.array(packed, pa.binary())
                cluster, second = np.zeros(n, np.int64), np.full(n, min(1, search.k - 1), np.int64)
                upper, lower = np.full(n, np.inf), np.zeros(n)
            else:
                w, v = t.column("w").combine_chunks(), t.column("v").combine_chunks()
                x = _unpack(np.asarray(w), v.to_pylist(), dims)
                cluster, second = (np.asarray(t.column(c), np.int64) for c in ("cluster", "second"))
                upper, lower = (np.asarray(t.column(c), np.float64) for c in ("upper", "lower"))
            cluster, second, upper, lower, _ = search.assign(x, cluster, second, upper, lower)
            sums.add(x, cluster)
            far = [int(d) if d <= LONG_MAX else None for d in search.exact(x, cluster).tolist()]
            yield pa.RecordBatch.from_arrays(
                [t.column("vec_id").combine_chunks(), w, v, pa.array(cluster, pa.int32()), pa.array(second, pa.int32()),
                 pa.array(upper), pa.array(lower), pa.array(far, pa.int64()), pa.nulls(n, schema.field("sums").type)], schema=schema)
        rows = sums.rows()
        if rows:
            yield pa.RecordBatch.from_pylist([{"sums": rows}], schema=schema)
    return run


def _means(state: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """floor(sum / count) per centroid and component; a centroid without vectors stays. k x dims rows are collected."""
    parts = (state.where("sums is not null").select(F.explode("sums").alias("s")).select("s.*")
             .groupBy("c", "d", "part").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")))
    total: dict[tuple[int, int], int] = {}
    for r in parts.collect():
        total[r.c, r.d] = total.get((r.c, r.d), 0) + (int(r.n) << LIMB * r.part)
    return [[total.get((c, d), 0) // total[c, -1] for d in range(len(row))] if (c, -1) in total else row
            for c, row in enumerate(centroids)]


@dataclass
class Clusters:
    """``rows``: (vec_id, cluster, second, distance), one per vector; ``centroids``: their integer components."""
    rows: DataFrame
    centroids: list[list[int]]


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
            scale: int = SCALE, dims: int = DIMS, seed: int = SEED) -> Clusters:
    """Clusters of the usable vectors of ``df`` after ``rounds`` rounds of means and one more assignment."""
    spark = df.sparkSession
    prepare(spark)
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    kept = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("v")).where(usable(F.col("v"), dims))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    limit = widest(dims)
    seeds = kept.select("v").orderBy(name.asc_nulls_last(), "v").limit(k).collect()
    centroids = [[int(c) for c in quantise(np.array([r.v], np.float64), scale, limit)[0]] for r in seeds]
    if not centroids:
        empty = spark.createDataFrame([], "vec_id long, cluster int, second int, distance long")
        return Clusters(empty, [])
    source, before, path = kept, None, None
    for i in range(rounds + 1):
        search = Search(centroids, before, limit)
        state = source.mapInArrow(_round(search, scale, dims, limit, i == 0), _STATE)
        last, path = path, scratch_path(spark, "clusters")
        state.write.option("compression", "zstd").parquet(path)
        state = spark.read.schema(state.schema).parquet(path)
        if last is not None:
            _remove(spark, last)
        if i < rounds:
            before, centroids = centroids, _means(state, centroids)
        source = state.where("sums is null").select("vec_id", "w", "v", "cluster", "second", "upper", "lower")
    return Clusters(state.where("sums is null").select("vec_id", "cluster", "second", "distance"), centroids)


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a round's table that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def inertia(found: Clusters) -> DataFrame:
    """``found.rows`` with the distances summed per cluster and over all, and the hash of the vector's centroid.

    A cluster's totals are one row of at most k, so that side is broadcast.
    """
    spark = found.rows.sparkSession
    total = (found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"),
                                               F.count("*").alias("n"), F.count("distance").alias("m")).collect())
    fits = lambda v: int(v) if v is not None and v <= LONG_MAX else None
    known = all(r.n == r.m for r in total)
    overall = fits(sum(int(r.s) for r in total)) if known else None
    rows = [(r.cluster, fits(int(r.s)) if r.n == r.m else None, overall,
             hashlib.sha256(",".join(map(str, found.centroids[r.cluster])).encode()).hexdigest()) for r in total]
    totals = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.join(F.broadcast(totals), "cluster")


def _sql() -> str:
    far = "list_sum(list_transform(range(1, {0}), lambda i: (v.v[i] - c.c[i]) * (v.v[i] - c.c[i])))::bigint".format(DIMS + 1)
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"a{i} as materialized (select n, arg_min(num, (d, num)) cluster, min(d) distance from "
                     f"(select v.n, c.num, {far} d from v, c{i} c) group by n)")
        if i < ROUNDS:
            steps.append(
                f"m{i} as (select num, list(floor_mean order by i) c from (select a.cluster num, i, "
                f"((sum(v.v[i]) - ((sum(v.v[i]) % count(*)) + count(*)) % count(*)) // count(*))::bigint floor_mean "
                f"from a{i} a join v using (n), range(1, {DIMS + 1}) t(i) group by 1, 2) group by num), "
                f"c{i + 1} as materialized (select c.num, coalesce(m.c, c.c) c from c{i} c left join m{i} m using (num))")
    last = f"a{ROUNDS}"
    return f"""
with v as materialized (select row_number() over () n, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) v
           from embeddings where len(embedding) = {DIMS} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as materialized (select (row_number() over (order by sha256('{SEED}:' || vec_id) nulls last, v) - 1)::int num, v c from v
           qualify num < {CLUSTERS}),
{', '.join(steps)},
s as (select cluster, sum(distance)::bigint cluster_inertia from {last} group by 1)
select v.vec_id, a.cluster::int cluster, a.distance, s.cluster_inertia, (select sum(distance)::bigint from {last}) inertia,
       sha256(array_to_string(c.c, ',')) centroid_sha256
from {last} a join v using (n) join s using (cluster) join c{ROUNDS} c on c.num = a.cluster"""


@query("op13_shallot_clusters", _sql())
def op13_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inertia(cluster(table(spark, sf_dir, "embeddings")))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
