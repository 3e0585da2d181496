"""Exact top-k by inner product over sorted lists, without random access.

One sorted list per dimension: a query reads it from the top where its own
component is positive, from the bottom where it is negative. After each depth
a row has a lower bound (unread components count as the list's worst value)
and an upper bound (unread components count as the value at the reading
depth). Rows whose upper bound is below the k-th lower bound cannot qualify.
When few other rows are left, reading stops and final scores are worked out for
those alone.

The table is cut into blocks of rows and the queries into blocks of queries;
a pair of blocks is one unit of work, its size is fixed by parameters, and
each unit returns at most k rows per query. The k best of those are the k
best of all. Scores are integers, so results are exact.

Edge rows: a vector that is null, empty of components, or holds a null or
non-finite component takes no part. Rows repeated in full count once. A row
is told from the query by its id and vector, so other rows under the query's id
are candidates, and each gets a list as a query. Rows with a null id take no part. Vectors of unequal length are
compared on the components that both have. An empty table gives no rows. Ties
go to the smaller id. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulage.llm.common import prepare, store
from haulage.llm.registry import query, table

SCALE = 256
BLOCK_ROWS = 8192      # rows of the table in a unit of work
QUERY_ROWS = 1024      # queries in a unit of work
DEPTHS = (0.5, 0.75, 0.9, 0.95)  # reading depths, as shares of a list


def to_integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as a double; null where a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)).cast("long")))


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.float64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def row_keys(ids, vectors: list) -> np.ndarray:
    """A 16-byte digest of each row's id and vector, so that equal ids of different rows stay apart."""
    return np.array([hashlib.blake2b(np.array([i, *v], np.int64).tobytes(), digest_size=16).digest() for i, v in zip(ids, vectors)], "V16")


def block_top_k(ids: np.ndarray, x: np.ndarray, keys: np.ndarray, q: np.ndarray, query_keys: np.ndarray, k: int):
    """The k best rows of a block for each query: arrays (query row, id, score), and
    at which of DEPTHS each query stopped (len(DEPTHS): not before the last).

    ``x`` and ``q`` hold integers as doubles; sums stay exact below 2**53.
    """
    n = len(ids)
    lists = np.sort(x, axis=0)  # ascending; read from either end
    low, high = lists[0], lists[-1]
    plus, minus = np.maximum(q, 0).T, np.minimum(q, 0).T
    own_row = {key.tobytes(): i for i, key in enumerate(keys)}
    own = np.array([own_row.get(key.tobytes(), -1) for key in query_keys], np.int64)
    open_q = np.arange(len(q))
    left = [np.arange(n)] * len(q)  # rows that can still qualify
    stopped = np.full(len(q), len(DEPTHS))
    for step, share in enumerate(DEPTHS):
        depth = max(1, int(n * share))
        if depth >= n or len(open_q) == 0:
            break
        top, bottom = lists[n - depth], lists[depth - 1]  # the value read last in each list
        read_top, read_bottom = x >= top, x <= bottom
        p, m = plus[:, open_q], minus[:, open_q]
        lower = np.where(read_top, x, low) @ p + np.where(read_bottom, x, high) @ m
        upper = np.where(read_top, x, top) @ p + np.where(read_bottom, x, bottom) @ m
        mine = np.flatnonzero(own[open_q] >= 0)
        lower[own[open_q][mine], mine] = -np.inf
        upper[own[open_q][mine], mine] = -np.inf
        kth = np.partition(lower, n - k, axis=0)[n - k] if n > k else np.full(len(open_q), -np.inf)
        can = upper >= kth  # a tie may still win by its id
        for j, r in enumerate(open_q.tolist()):
            left[r] = np.flatnonzero(can[:, j])
        done = can.sum(axis=0) <= max(4 * k, n // 64)  # few rows are left: stop reading
        stopped[open_q[done]] = step
        open_q = open_q[~done]
    out_q, out_id, out_score = [], [], []
    for r in range(len(q)):  # final scores, of the rows that the last bounds left
        rows = left[r][left[r] != own[r]]
        score = x[rows] @ q[r]
        if len(rows) > 4 * k:
            cut = np.partition(score, len(score) - k)[len(score) - k]
            near = score >= cut
            rows, score = rows[near], score[near]
        order = np.lexsort((ids[rows], -score))[:k]
        out_q.extend([r] * len(order))
        out_id.extend(ids[rows[order]].tolist())
        out_score.extend(score[order].astype(np.int64).tolist())
    return out_q, out_id, out_score, stopped


def top_k(rows: DataFrame, queries: DataFrame, k: int, block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for tables (vec_id, v array<bigint>)."""
    spark = rows.sparkSession
    prepare(spark)
    usable = "vec_id is not null and v is not null and size(v) > 0"
    rows = store(rows.where(usable).select("vec_id", "v").distinct(), "nra")
    queries = queries.where(usable).select("vec_id", "v").distinct()
    n_rows, n_queries = rows.count(), queries.count()
    blocks, q_blocks = max(1, -(-n_rows // block_rows)), max(1, -(-n_queries // query_rows))
    # every block of rows meets every block of queries: the queries go to all blocks of rows, in blocks
    spread = lambda c, n, salt: F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(n)).cast("int")
    left = rows.select(spread("vec_id", blocks, 1).alias("rb"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("qb"),
                       "vec_id", "v", F.lit(False).alias("is_query"))
    right = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("rb"), spread("vec_id", q_blocks, 2).alias("qb"),
                           "vec_id", "v", F.lit(True).alias("is_query"))

    def unit(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(a) == 0 or len(b) == 0:
            return pd.DataFrame({"query_id": [], "query_row": [], "vec_id": [], "score": []})
        width = max(a["v"].map(len).max(), b["v"].map(len).max())
        ids, q_ids = a["vec_id"].to_numpy(np.int64), b["vec_id"].to_numpy(np.int64)
        name = row_keys(q_ids, b["v"].tolist())
        r, i, s, _ = block_top_k(ids, _matrix(a["v"].tolist(), width), row_keys(ids, a["v"].tolist()), _matrix(b["v"].tolist(), width), name, k)
        return pd.DataFrame({"query_id": q_ids[r], "query_row": [name[x].tobytes() for x in r], "vec_id": i, "score": s})

    found = (left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb"))
             .applyInPandas(unit, "query_id long, query_row binary, vec_id long, score long"))
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


SQL = f"""
with v as (select distinct vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) v from embeddings
           where vec_id is not null and embedding is not null and len(embedding) > 0
           and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, c.vec_id, list_dot_product(q.v::double[], c.v::double[])::bigint score
      from v q join v c on q.vec_id % 50 = 0 and (c.vec_id <> q.vec_id or c.v <> q.v)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s)
select query_id, rank::int rank, vec_id, score from r where rank <= 5"""


@query("op4_nra_top_k", SQL)
def op4_nra_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", to_integers(F.col("embedding")).alias("v"))
    return top_k(rows, rows.where(F.col("vec_id") % 50 == 0), 5)
