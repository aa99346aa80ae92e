"""Exact top-k inner product search by columnar branch-and-bound.

Vectors are quantised to integers and packed into blocks in vertical layout
(one row per dimension). Every block of queries meets every block of
candidates in some task; there a query's scores grow dimension block by
dimension block, and candidates whose score cannot reach the k-th best any
more (by the product of the remaining norms) are compacted away.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostat.llm.common import small_batches, staged

CANDIDATES, QUERIES = 4096, 256  # vectors in a packed block
BLOCKS = 8  # packed blocks that a task takes of either side
STEP = 8  # dimensions added before candidates are compacted
LARGEST = 1 << 62  # a component from here on fails the job: no score of it could be a long
SAFE = float(1 << 62)  # bound of the inner products that are summed as longs; others are summed as Python integers

PACKED = "block long, dims int, ids binary, vectors binary"


def _pack(most: int):
    """Rows (vec_id, vector) to blocks, dimension by dimension, zero-padded."""

    def run(batches):
        seq, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                piece = batch.slice(at, most)
                ids = piece.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                rows = piece.column(1)
                n = np.diff(rows.offsets.to_numpy())
                dims = int(n.max(initial=0))
                matrix = np.zeros((len(ids), dims), dtype=np.int64)
                matrix[np.arange(dims)[None, :] < n[:, None]] = rows.flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([(task << 32) | seq], pa.int64()), "dims": pa.array([dims], pa.int32()),
                    "ids": [ids.tobytes()], "vectors": [np.ascontiguousarray(matrix.T).tobytes()]})
                seq += 1

    return run


def _unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All blocks of a table side by side: ids, and a matrix of dims x vectors."""
    if not table.num_rows:
        return np.zeros(0, np.int64), np.zeros((0, 0), np.int64)
    dims = max(table.column("dims").to_pylist())
    ids, parts = [], []
    for r in table.to_pylist():
        own = np.frombuffer(r["ids"], np.int64)
        part = np.zeros((dims, len(own)), np.int64)
        part[:r["dims"]] = np.frombuffer(r["vectors"], np.int64).reshape(r["dims"], len(own))
        ids.append(own)
        parts.append(part)
    return np.concatenate(ids), np.concatenate(parts, axis=1)


def _remaining(vectors: np.ndarray) -> np.ndarray:
    """Norm of what follows each dimension block, rounded up (blocks + 1 rows)."""
    square = vectors.astype(np.float64) ** 2
    starts = range(0, len(vectors), STEP)
    rows = [square[s:].sum(axis=0) for s in starts] + [np.zeros(vectors.shape[1])]
    return np.sqrt(np.array(rows)) * (1 + 1e-9) + 1e-9


def best_of(query: np.ndarray, own_rest: np.ndarray, vectors: np.ndarray, rest: np.ndarray,
            skip: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that may be among the k best of a query, with whole scores."""
    alive = np.flatnonzero(~skip)
    score = np.zeros(len(alive), np.int64)
    for b, at in enumerate(range(0, len(query), STEP)):
        for d in range(at, min(at + STEP, len(query))):
            if query[d]:
                score += query[d] * vectors[d, alive]
        slack = own_rest[b + 1] * rest[b + 1, alive]
        slack += 1e-6 * (np.abs(score) + slack) + 1
        if len(alive) > k:
            least = np.partition(score - slack, len(alive) - k)[len(alive) - k]
            stay = score + slack >= least
            alive, score = alive[stay], score[stay]
    return alive, score


def _exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of any size; one that no long can hold raises ``OverflowError``."""
    whole = [sum(a * b for a, b in zip(query.tolist(), v)) for v in vectors.T.tolist()]
    return np.array(whole, np.int64)


def _search(k: int):
    result = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {n: [] for n in result.names}
        ids, vectors = _unpack(right)
        if len(ids):
            for block in left.to_batches(max_chunksize=1):
                mine, queries = _unpack(pa.Table.from_batches([block]))
                dims = max(len(vectors), len(queries))
                queries = np.pad(queries, ((0, dims - len(queries)), (0, 0)))
                there = np.pad(vectors, ((0, dims - len(vectors)), (0, 0)))
                rest, own_rest = _remaining(there), _remaining(queries)
                largest, own_largest = (np.abs(x).max(axis=0, initial=0).astype(np.float64) * max(dims, 1) ** 0.5 for x in (there, queries))
                for i, one in enumerate(mine):
                    wide = largest * own_largest[i] >= SAFE
                    at, score = best_of(queries[:, i], own_rest[:, i], there, rest, (ids == one) | wide, k)
                    if wide.any():
                        more = np.flatnonzero(wide & (ids != one))
                        at = np.concatenate([at, more])
                        score = np.concatenate([score, _exact(queries[:, i], there[:, more])])
                    top = np.lexsort((ids[at], -score))[:k]
                    out["query"].append(np.full(len(top), block.column("block")[0].as_py() * QUERIES + i, np.int64))
                    out["query_id"].append(np.full(len(top), one, np.int64))
                    out["vec_id"].append(ids[at][top])
                    out["score"].append(score[top])
        return pa.table({n: np.concatenate([np.zeros(0, np.int64), *v]) for n, v in out.items()}, schema=result)

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 5, scale: int = 256, vec_id: str = "vec_id",
          embedding: str = "embedding") -> DataFrame:
    """The ``k`` largest integer inner products of every query row, exactly.

    A component x becomes floor(scale * x). ``queries`` says which rows ask;
    every row answers but those that carry the query's own id. Ties go to
    the smaller id. Returns ``query_id``, ``rank`` (from 1), ``vec_id``,
    ``score``; fewer than ``k`` rows if there are fewer candidates.

    Null ids, null vectors and vectors with a null or non-finite component
    take no part. Large components are scored exactly; the job fails if a
    score, or a scaled component, does not fit in a long. Shorter vectors
    count as padded with zeros. Rows that repeat an id are queries and candidates
    of their own. An empty table gives no rows; other columns are ignored.

    A task holds up to 8 blocks of 4,096 candidates and 8 of 256 queries.
    """
    small_batches(vectors.sparkSession)
    whole = F.transform(F.col(embedding), lambda x: F.when(F.abs(x.cast("double") * scale) < float(LARGEST), F.floor(
        x.cast("double") * scale)).otherwise(F.raise_error(F.lit("a component is too large for a score"))))
    ok = ~F.exists(F.col(embedding), lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & ok).select(
        F.col(vec_id).cast("long").alias("vec_id"), whole.cast("array<bigint>").alias("vector"), queries.alias("asks"))
    pairs = rows.select("vec_id", "vector")
    there = staged(pairs.mapInArrow(_pack(CANDIDATES), PACKED), "topk_candidates")
    asked = staged(rows.where("asks").select("vec_id", "vector").mapInArrow(_pack(QUERIES), PACKED), "topk_queries")
    n_there, n_asked = (-(-max(1, x.count()) // BLOCKS) for x in (there, asked))
    deal = lambda df, n: df.withColumn("own", F.pmod(F.xxhash64("block"), F.lit(n)))
    left = deal(asked, n_asked).withColumnRenamed("own", "q").withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(n_there - 1)))).withColumn("c", F.col("c").cast("long"))
    right = deal(there, n_there).withColumnRenamed("own", "c").withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1)))).withColumn("q", F.col("q").cast("long"))
    found = left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInArrow(
        _search(k), "query long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
