"""Exact top-k search by inner product over integer vectors, sorted by length.

Candidates are dealt by descending length into shelves, queries into strips. A pair of a
strip and a shelf is scored in one task: inside it candidates come in descending length,
in rows of a small block. A query leaves as soon as its length times the block's largest
length can't reach its k-th best score. What stays is rotated by the singular vectors of
the shelf, so that a few leading coordinates hold most of each product; their partial sums
plus the product of the residual lengths (Cauchy-Schwarz) bound the score from above, and
only candidates that a bound lets through are scored in full.

Scores are integer inner products and exact. Bounds only ever leave out candidates that
can't be in a result, so the result equals that of a full scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.plans.session import work_dir

SHELF_ROWS = 8_192
STRIP_ROWS = 2_048
BLOCK_ROWS = 1_024
#: Share of the coordinates that a partial sum takes.
LEADING = 0.25
#: Relative slack of bounds, above the rounding of double arithmetic.
SLACK = 1e-9
EXACT = 2**53

VECTORS = "vec_id long, dim int, norm double, vec binary"
PACKS = "pack string, dim int, rows int, top_norm double, ids binary, vecs binary"
HITS = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, dim, norm and the bytes of floor(scale * x) as doubles.

    vectors: vec_id, embedding; other columns are dropped. Rows whose id or vector is null, or
    whose vector holds a null or non-finite component, are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, BLOCK_ROWS):
                rows = []
                batch = whole.slice(first, BLOCK_ROWS)
                for vec_id, vector in zip(batch.column(0), batch.column(1), strict=True):
                    if not vec_id.is_valid or not vector.is_valid or vector.values.null_count:
                        continue
                    x = np.floor(scale * vector.values.to_numpy(zero_copy_only=False).astype(float))
                    if np.isfinite(x).all():
                        rows.append((vec_id.as_py(), len(x), float(np.sqrt(x @ x)), x.tobytes()))
                names, kinds = ["vec_id", "dim", "norm", "vec"], [pa.int64(), pa.int32(), pa.float64(), pa.binary()]
                columns = list(zip(*rows, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
                )

    return vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(run, VECTORS)


def _packed(rows_at_most: int, keep_equal: int | None):
    """Packs of consecutive rows; of equal vectors in a pack the `keep_equal` smallest ids stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get(), 0

        def pack(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal made
            dim = rows[0][1]
            ids = np.array([r[0] for r in rows], dtype=np.int64)
            flat = np.frombuffer(b"".join(r[3] for r in rows)).reshape(len(rows), dim)
            if keep_equal is not None:
                seen: dict[bytes, list[int]] = {}
                kept = []
                for k in sorted(range(len(rows)), key=lambda k: (-rows[k][2], rows[k][0])):
                    own = seen.setdefault(rows[k][3], [])
                    if len(own) < keep_equal and rows[k][0] not in own:
                        own.append(rows[k][0])
                        kept.append(k)
                ids, flat = ids[kept], flat[kept]
            made += 1
            top = max(r[2] for r in rows)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{dim}-{task.partitionId()}-{made}"]),
                    pa.array([dim], pa.int32()),
                    pa.array([len(ids)], pa.int32()),
                    pa.array([top]),
                    pa.array([ids.tobytes()], pa.binary()),
                    pa.array([flat.tobytes()], pa.binary()),
                ],
                names=["pack", "dim", "rows", "top_norm", "ids", "vecs"],
            )

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (len(held) >= rows_at_most or held[0][1] != row[1]):
                    yield pack(held)
                    held = []
                held.append(row)
        if held:
            yield pack(held)

    return run


def top_k(
    spark: SparkSession,
    vectors: DataFrame,
    k: int = 5,
    scale: int = 256,
    query_every: int = 50,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best candidates.

    Queries are the rows whose id is divisible by `query_every`; candidates are all rows
    but those with the query's id. Ties go to the smaller id; a query with fewer than k
    candidates gets all of them. Only vectors of the query's length (number of components)
    are its candidates. A row that repeats an id and its vector counts once; of a query id
    with several vectors the smallest vector asks. Empty tables give no rows.
    """
    folder = work_dir(spark, "topk")
    rows = quantised(vectors, scale)
    rows.write.parquet(f"{folder}/vectors")
    rows = spark.read.schema(VECTORS).parquet(f"{folder}/vectors")

    shelves = (
        rows.repartitionByRange("dim", F.desc("norm"), "vec_id")
        .sortWithinPartitions("dim", F.desc("norm"), "vec_id")
        .mapInArrow(_packed(SHELF_ROWS, k + 1), PACKS)
    )
    shelves.write.parquet(f"{folder}/shelves")
    shelves = spark.read.schema(PACKS).parquet(f"{folder}/shelves")

    asked = rows.where(F.col("vec_id") % query_every == 0)
    asked = asked.groupBy("vec_id").agg(F.min_by(F.struct("dim", "norm", "vec"), F.struct("dim", "vec")).alias("v"))
    asked = asked.select("vec_id", "v.dim", "v.norm", "v.vec")
    strips = (
        asked.repartitionByRange("dim", F.desc("norm"), "vec_id")
        .sortWithinPartitions("dim", F.desc("norm"), "vec_id")
        .mapInArrow(_packed(STRIP_ROWS, None), PACKS)
    )
    strips.write.parquet(f"{folder}/strips")
    strips = spark.read.schema(PACKS).parquet(f"{folder}/strips")

    # Seeds: the k-th best score among the longest candidates of each dimension.
    longest = shelves.groupBy("dim").agg(F.max_by("pack", "top_norm").alias("pack"))
    first = shelves.join(longest, ["dim", "pack"], "left_semi")
    seeds = _scored(strips, first, k).groupBy("query_id").agg(
        F.count("*").alias("n"), F.min("score").alias("seed")
    ).where(F.col("n") >= k)
    seeds.write.parquet(f"{folder}/seeds")
    seeded = _with_seeds(strips, spark.read.parquet(f"{folder}/seeds"))

    hits = _scored(seeded, shelves, k).dropDuplicates(["query_id", "vec_id", "score"])
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _with_seeds(strips: DataFrame, seeds: DataFrame) -> DataFrame:
    """Strips with the seeds of their queries; a strip has at most STRIP_ROWS of them."""

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(own, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pack] * len(own)), pa.array(own)], names=["pack", "query_id"]
                )

    members = strips.select("pack", "ids").mapInArrow(ids, "pack string, query_id long")
    known = (
        members.join(seeds, "query_id")
        .groupBy("pack")
        .agg(F.map_from_entries(F.collect_list(F.struct("query_id", "seed"))).alias("seeds"))
    )
    return strips.join(known, "pack", "left")


def _scored(strips: DataFrame, shelves: DataFrame, k: int) -> DataFrame:
    """Best hits of each pair of a strip and a shelf that can hold any.

    The queries are a stated set against all rows, in blocks: names of shelves, with their
    largest length, go to the strips; those that can't reach the least seed of a strip are
    left out there, and the data of packs follow by name.
    """
    names = shelves.groupBy("dim").agg(F.collect_list(F.struct("pack", "top_norm")).alias("all_shelves"))
    if "seeds" not in strips.columns:
        strips = strips.withColumn("seeds", F.lit(None).cast("map<bigint,bigint>"))
    all_seeded = F.coalesce(F.size("seeds") >= F.col("rows"), F.lit(False))
    least = F.when(all_seeded, F.array_min(F.map_values("seeds"))).cast("double")
    reach = lambda s: least.isNull() | ((s["top_norm"] * F.col("top_norm")) * (1 + SLACK) + SLACK >= least)
    pairs = (
        strips.select("pack", "dim", "rows", "top_norm", "seeds")
        .join(names, "dim")
        .select(F.col("pack").alias("strip"), F.explode(F.filter("all_shelves", reach)).alias("shelf"))
        .select("strip", F.col("shelf.pack").alias("shelf"))
    )
    left = strips.select(
        F.col("pack").alias("strip"), "dim", F.col("ids").alias("query_ids"), F.col("vecs").alias("queries"), "seeds"
    )
    right = shelves.select(F.col("pack").alias("shelf"), F.col("ids").alias("vec_ids"), "vecs")
    joined = pairs.join(left, "strip").join(right, "shelf").select(
        "dim", "query_ids", "queries", "seeds", "vec_ids", "vecs"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, query_ids, queries, seeds, vec_ids, vecs = (c[i].as_py() for c in batch.columns)
                found = search(
                    np.frombuffer(query_ids, dtype=np.int64),
                    np.frombuffer(queries).reshape(len(query_ids) // 8, dim),
                    dict(seeds or ()),
                    np.frombuffer(vec_ids, dtype=np.int64),
                    np.frombuffer(vecs).reshape(len(vec_ids) // 8, dim),
                    k,
                )
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query_id", "vec_id", "score"])

    return joined.mapInArrow(run, HITS)


def search(query_ids, queries, seeds, vec_ids, vecs, k):
    """Arrays (query_id, vec_id, score): each query's k best of one shelf, by length, pruned."""
    q_norm = np.sqrt(np.einsum("ij,ij->i", queries, queries))
    c_norm = np.sqrt(np.einsum("ij,ij->i", vecs, vecs))
    order = np.lexsort((vec_ids, -c_norm))
    vec_ids, vecs, c_norm = vec_ids[order], vecs[order], c_norm[order]
    floor = np.array([seeds.get(int(q), -np.inf) for q in query_ids], dtype=float)
    lead = max(1, int(queries.shape[1] * LEADING)) if queries.shape[1] else 0
    _, basis = np.linalg.eigh(vecs.T @ vecs)  # the right singular vectors, smallest first
    basis = basis[:, ::-1]
    q_turned, c_turned = queries @ basis, vecs @ basis
    q_rest = np.sqrt(np.einsum("ij,ij->i", q_turned[:, lead:], q_turned[:, lead:]))
    c_rest = np.sqrt(np.einsum("ij,ij->i", c_turned[:, lead:], c_turned[:, lead:]))

    best_q = np.empty(0, dtype=np.int64)
    best_c = np.empty(0, dtype=np.int64)
    best_s = np.empty(0, dtype=np.int64)
    for first in range(0, len(vec_ids), BLOCK_ROWS):
        block = slice(first, first + BLOCK_ROWS)
        slack = SLACK * (1 + q_norm * c_norm[first])
        active = np.flatnonzero(q_norm * c_norm[first] + slack >= floor)
        if not len(active):
            break  # all later candidates are shorter still
        bound = (
            q_turned[active, :lead] @ c_turned[block, :lead].T
            + np.outer(q_rest[active], c_rest[block])
            + slack[active, None]
        )
        own = query_ids[active, None] == vec_ids[None, block]
        open_pairs = (bound >= floor[active, None]) & ~own
        rows, columns = np.flatnonzero(open_pairs.any(1)), np.flatnonzero(open_pairs.any(0))
        if not len(rows):
            continue
        scores = _products(queries[active[rows]], vecs[block][columns])
        allowed = ~own[np.ix_(rows, columns)]
        ranked = np.where(allowed, scores, np.iinfo(np.int64).min)
        if ranked.shape[1] >= k:  # the k-th best of this block alone raises the floor
            kth = -np.partition(-ranked.astype(float), k - 1, axis=1)[:, k - 1]
            kth[allowed.sum(1) < k] = -np.inf
            floor[active[rows]] = np.maximum(floor[active[rows]], kth)
        r, c = np.nonzero(allowed & (scores >= floor[active[rows]][:, None]))
        best_q = np.concatenate((best_q, active[rows][r]))
        best_c = np.concatenate((best_c, first + columns[c]))
        best_s = np.concatenate((best_s, scores[r, c]))
        keep = np.lexsort((vec_ids[best_c], -best_s, best_q))
        best_q, best_c, best_s = best_q[keep], best_c[keep], best_s[keep]
        starts = np.searchsorted(best_q, best_q, side="left")
        rank = np.arange(len(best_q)) - starts
        last = rank == k - 1
        floor[best_q[last]] = np.maximum(floor[best_q[last]], best_s[last])
        keep = rank < k
        best_q, best_c, best_s = best_q[keep], best_c[keep], best_s[keep]
    return query_ids[best_q], vec_ids[best_c], best_s


def _products(queries: np.ndarray, vecs: np.ndarray) -> np.ndarray:
    """Exact integer products of integral doubles."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vecs).max(initial=0)) * queries.shape[1]
    if most < EXACT:
        return (queries @ vecs.T).astype(np.int64)
    if most >= 2**63:
        raise ValueError("scores of these vectors may leave 64 bits")
    return queries.astype(np.int64) @ vecs.astype(np.int64).T
