"""Exact top-k inner products by a three-phase uniform threshold.

The components are cut into LISTS column blocks; each block of each table part is a list of partial scores.
Phase 1: every part takes the heads of each list for each query, adds up the scores of these heads alone, and keeps its
k best; over all parts the k-th best of these is a safe cutoff, as k rows reach it.
Phase 2: the cutoff is broadcast. A row whose score reaches it has a partial score of at least cutoff / LISTS in some
list, so collecting every entry that reaches this uniform threshold is sufficient.
Phase 3: the scores of the entries collected are resolved, exactly, as integers; those below the cutoff go, and the rest
are ranked, ties to the smaller id. Each part sends its k best at most, so identical vectors cannot pile up.

No index says where the high partial scores of a list are, so phases 1 and 2 each multiply all rows with the queries;
what they save is the sums, the sorting and the rows sent. Queries are handled in blocks of at most BLOCK_BYTES, the only
thing besides their cutoffs that is broadcast; a block's answer is written and its broadcast released before the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import stored, table

LISTS, SCALE = 2, 1024
BLOCK_BYTES, ROW_BLOCK = 8 << 20, 2048
EXACT = 2.0**53
MOST = 2**63 - 1


def quantised(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<double>) with floor(scale * x) of each component; rows with a null id, a null or empty vector, or
    a component that is null or not finite take no part."""
    v = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return df.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long"), v.alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, padded with zeros or cut to dim components (a longer row's rest meets zeros)."""
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    if len(sizes) and (sizes == dim).all():
        return flat[ends[0] : ends[-1]].reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    for i, (a, b) in enumerate(zip(ends, ends[1:])):
        m = min(dim, b - a)
        out[i, :m] = flat[a : a + m]
    return out


def _products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products; float64 is exact while the sums of magnitudes stay under 2^53, else Python integers."""
    bound = np.abs(x).sum(axis=1).max(initial=0) * np.abs(q).max(initial=0)
    if bound < EXACT / LISTS:  # so that the sum over the lists is exact too
        return x @ q.T
    return _whole(x) @ _whole(q).T


def _whole(m: np.ndarray) -> np.ndarray:
    """The same numbers as Python integers."""
    return np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape)


class _Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, which: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        own = self.queries[which] != ids
        self.rows.append((which[own], ids[own], scores[own]))
        self.size += int(own.sum())
        if self.size > 4 * self.k * len(self.queries) + 100_000:
            self.rows = [self.cut()]
            self.size = len(self.rows[0][0])

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.rows:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        which, ids, scores = (np.concatenate(x) for x in zip(*self.rows))
        order = np.lexsort((ids, -scores, which))
        which, ids, scores = which[order], ids[order], scores[order]
        begin = np.searchsorted(which, which)
        keep = np.arange(len(which)) - begin < self.k
        return which[keep], ids[keep], scores[keep]


def _pass(rows: DataFrame, held, dim: int, k: int) -> DataFrame:
    """One pass of a broadcast block (ids, queries, cutoffs) over all rows: (query_id, vec_id, score), k rows a query and
    part at most.

    Without a cutoff, phase 1; with one for each query, phases 2 and 3."""
    edges = [dim * i // LISTS for i in range(LISTS + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q, cutoff = held.value
        best = _Best(ids, k)
        for b in batches:
            for at in range(0, b.num_rows, ROW_BLOCK):
                part = b.slice(at, ROW_BLOCK)
                own, x = part.column(0).to_numpy(), _matrix(part.column(1), dim)
                lists = [_products(x[:, a:z], q[:, a:z]) for a, z in zip(edges, edges[1:]) if z > a]
                if any(p.dtype == object for p in lists):
                    lists = [_whole(p) for p in lists]
                if cutoff is None:
                    take = min(k + 1, len(own))  # one may be the query itself
                    picked = np.zeros(lists[0].shape, dtype=bool)
                    for p in lists:
                        top = np.argsort(-p, axis=0, kind="stable")[:take] if p.dtype == object else np.argpartition(-p, take - 1, axis=0)[:take]
                        np.put_along_axis(picked, top, True, axis=0)
                else:
                    picked = reduce(np.logical_or, [(p * len(lists) >= cutoff[None, :]).astype(bool) for p in lists])
                r, c = np.nonzero(picked)
                total = reduce(np.add, [p[r, c] for p in lists])
                if cutoff is not None:
                    reach = (total >= cutoff[c]).astype(bool)
                    r, c, total = r[reach], c[reach], total[reach]
                best.add(c, own[r], total)
        which, found, scores = best.cut()
        if len(which):
            yield pa.RecordBatch.from_arrays([pa.array(ids[which]), pa.array(found), pa.array([max(-MOST, min(MOST, int(s))) for s in scores], pa.int64())], names=["query_id", "vec_id", "score"])

    return rows.mapInArrow(run, "query_id long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best rows; both inputs as made by quantised().

    A row with the query's own vec_id is no candidate. Queries with the same vec_id and vector count once. Vectors of
    other lengths are padded with zeros. A score beyond a long counts as the greatest (or least) long. Fewer candidates than k: all of them. No query or no row: an empty result."""
    spark = rows.sparkSession
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    seen = queries.agg(F.count("*"), F.max(F.size("v"))).first()
    if not seen[0]:
        return none
    dim = seen[1]
    blocks = max(1, -(-2 * seen[0] * dim * 8 // BLOCK_BYTES))
    context = spark.sparkContext
    asked = stored(queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))), "queries")
    out = []
    for n in range(blocks):
        got = asked.filter(F.col("block") == n).drop("block").dropDuplicates().toArrow().combine_chunks()
        if not got.num_rows:
            continue
        ids, q = got.column(0).to_numpy(), _matrix(got.column(1).combine_chunks() if isinstance(got.column(1), pa.ChunkedArray) else got.column(1), dim)
        block = context.broadcast((ids, q, None))
        first = _ranked(_pass(rows, block, dim, k), k).groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("cut"))
        cut = {r[0]: r[1] for r in first.collect()}
        block.unpersist()
        # whole numbers that a double cannot hold stay Python integers
        large = any(c is not None and abs(c) >= EXACT for c in cut.values())
        least = np.array([float("-inf") if cut.get(i) is None else cut[i] for i in ids.tolist()], dtype=object if large else float)
        block = context.broadcast((ids, q, least))
        out.append(stored(_ranked(_pass(rows, block, dim, k), k), "top"))
        block.unpersist()
    if not out:
        return none
    # one table of all blocks' files, not a union with a branch for each
    kind = out[0].schema
    whole = spark.read.schema(kind).parquet(*[f for o in out for f in o.inputFiles()]) if any(o.inputFiles() for o in out) else out[0]
    return whole.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_exact_top_k(spark, sf_dir: str) -> DataFrame:
    """The ten best rows for every row whose id is divisible by 100, against all rows."""
    rows = quantised(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return top_k(rows, rows.filter(F.col("vec_id") % 100 == 0))


OP8_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
