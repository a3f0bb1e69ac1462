"""Hard negatives for labelled vectors, by bounds along spanning trees of anchors.

A hard negative of an anchor and one of its positives is a row of another label whose score
(inner product with the anchor) is high, but clearly below the positive's: it lies in a window
given as shares of the positive's score.

Anchors that lie near each other are packed together, and each pack gets a minimum spanning
tree. Candidates come in shelves of one label, longest first. For a pack and a shelf only the
root is scored against all candidates. A child c of a parent p differs from it by an edge, so

    p.x - |c - p| |x|  <=  c.x  <=  p.x + |c - p| |x|,

and only candidates whose interval reaches into a window of the child are scored again, by
exact integer products. A candidate that is not keeps its interval, which widens by each edge
down the tree. As soon as a window holds its wanted number of rows, its lower end rises to the
least of them. Positives are found by the same search, among the rows of the anchor's label, in a
window without an upper end. Bounds only leave out what can't be in a result, so the result is
that of a full scan, whatever the vectors: the nearer the anchors of a pack, the less is scored.

Anchors are a stated query set against all rows, in blocks: names of packs and shelves are paired
by dimension and a dealt number, pairs that lengths rule out are dropped, and data follow by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.plans.session import session_conf, work_dir

#: Rows of a shelf, anchors of a tree, and candidates that go down a tree at once.
SHELF_ROWS = 4_096
TREE_ANCHORS = 256
BLOCK_ROWS = 1_024
#: Shelves are dealt to so many groups, each of which meets all trees.
DEALT = 64
#: Pairs of a pack and a shelf that are sent to a Python worker at once.
BATCH_PAIRS = "16"
#: Hits that a task holds, to merge those of all its pairs, before it sends any.
HELD_HITS = 500_000
#: Bits of the key by which near anchors are sorted together.
KEY_BITS = 16
#: Relative slack of bounds, above the rounding of double arithmetic.
SLACK = 1e-9
EXACT = 2**53
NOTHING = np.iinfo(np.int64).min

ROWS = "vec_id long, label long, dim int, norm double, place int, vec binary"
SHELVES = "shelf string, label long, dim int, top_norm double, vec_ids binary, vecs binary"
TREES = (
    "tree string, label long, dim int, top_norm double, anchor_ids binary, anchors binary, parents binary, edges binary"
)
HITS = "anchor_id long, window int, vec_id long, score long"


def prepared(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """ROWS: floor(scale * x) of every component, as integers, its length, and a key of its direction.

    vectors: vec_id, label, embedding; other columns are dropped. Rows with a null among them, or
    with a null or non-finite component, are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, BLOCK_ROWS):
                yield _prepared(whole.slice(first, BLOCK_ROWS), scale)

    wanted = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding").dropna()
    return wanted.mapInArrow(run, ROWS)


def _prepared(batch: pa.RecordBatch, scale: int) -> pa.RecordBatch:
    ids, labels = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    lists = batch.column(2)
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    values = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(float))
    broken = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    good = broken[ends] == broken[starts] if len(ends) else np.empty(0, dtype=bool)
    out: list[list] = [[], [], [], [], [], []]
    for dim in np.unique((ends - starts)[good]):
        own = np.flatnonzero(good & (ends - starts == dim))
        rows = values[starts[own, None] + np.arange(dim)]
        turned = rows @ np.random.default_rng(int(dim)).normal(size=(int(dim), KEY_BITS))
        place = (turned > 0) @ (1 << np.arange(KEY_BITS))
        out[0] += ids[own].tolist()
        out[1] += labels[own].tolist()
        out[2] += [int(dim)] * len(own)
        out[3] += np.sqrt(np.einsum("ij,ij->i", rows, rows)).tolist()
        out[4] += place.tolist()
        out[5] += [_narrow(row).tobytes() for row in rows]
    return _batch(out, ROWS)


def _narrow(values: np.ndarray) -> np.ndarray:
    """Integral doubles in the smallest of three types that holds them."""
    most = np.abs(values).max(initial=0)
    return values.astype("<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8")


def _wide(stored: bytes, rows: int, dim: int) -> np.ndarray:
    kind = {2: "<i2", 4: "<i4"}.get(len(stored) // max(rows * dim, 1), "<f8")
    return np.frombuffer(stored, dtype=kind).astype(float).reshape(rows, dim)


def _batch(columns: list[list], schema: str) -> pa.RecordBatch:
    kinds = {
        "long": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "binary": pa.binary(),
    }
    fields = [field.split() for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def _packed(rows_at_most: int, schema: str, finish):
    """Rows that follow each other in a task, of one label and dimension, as packs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get(), 0

        def pack(held: list[tuple]) -> pa.RecordBatch:
            nonlocal made
            made += 1
            _, label, dim = held[0][:3]
            name = f"{label}-{dim}-{task.partitionId()}-{made}"
            ids = np.array([r[0] for r in held], dtype=np.int64)
            vecs = np.concatenate([_wide(r[5], 1, dim) for r in held])
            row = [name, label, dim, max(r[3] for r in held), *finish(ids, vecs)]
            return _batch([[value] for value in row], schema)

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (len(held) >= rows_at_most or held[0][1:3] != row[1:3]):
                    yield pack(held)
                    held = []
                if not held or (held[-1][0], held[-1][5]) != (row[0], row[5]):  # a repeated row counts once
                    held.append(row)
        if held:
            yield pack(held)

    return run


def spanning_tree(vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """order, parents, edges: a minimum spanning tree, by growing it from the first row.

    `order` lists the rows so that parents come before children; parents[k] is a place in that
    order (-1 for the root), edges[k] the distance to the parent.
    """
    n = len(vecs)
    order, parents, edges = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64), np.zeros(n)
    distance, nearest, free = np.full(n, np.inf), np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    at = 0
    for k in range(n):
        if k:
            at = int(np.argmin(np.where(free, distance, np.inf)))
            parents[k], edges[k] = nearest[at], distance[at]
        order[k], free[at] = at, False
        away = vecs - vecs[at]
        to_it = np.sqrt(np.einsum("ij,ij->i", away, away))
        nearer = to_it < distance
        distance[nearer], nearest[nearer] = to_it[nearer], k
    return order, parents, edges


def _shelf(ids: np.ndarray, vecs: np.ndarray) -> tuple:
    return ids.tobytes(), _narrow(vecs).tobytes()


def _tree(ids: np.ndarray, vecs: np.ndarray) -> tuple:
    order, parents, edges = spanning_tree(vecs)
    return ids[order].tobytes(), _narrow(vecs[order]).tobytes(), parents.tobytes(), edges.tobytes()


def search(ids, anchors, parents, edges, windows, vec_ids, vecs, k):
    """Arrays (window, vec_id, score): of each window its `k` highest scores among the rows, and the work.

    windows: arrays (anchor as a place in `ids`, low, high), ends included. Ties go to the smaller
    id; rows with the anchor's id take no part; rows of equal id and score count once. The last
    value is the number of products that were computed.
    """
    owner, low, high = (np.array(x, dtype=np.int64) for x in windows)
    low = low.copy()
    a_norm, c_norm = (np.sqrt(np.einsum("ij,ij->i", x, x)) for x in (anchors, vecs))
    order = np.lexsort((vec_ids, -c_norm))
    vec_ids, vecs, c_norm = vec_ids[order], vecs[order], c_norm[order]
    depth = np.zeros(len(ids), dtype=np.int64)
    for place in range(1, len(ids)):
        depth[place] = depth[parents[place]] + 1
    levels = [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=-1)) + 1)]
    best = (np.empty(0, dtype=np.int64),) * 3  # window, place of the row, score
    done = 0
    for first in range(0, len(vec_ids), BLOCK_ROWS):
        block = slice(first, first + BLOCK_ROWS)
        own_ids, rows, lengths = vec_ids[block], vecs[block], c_norm[block]
        # The hull of an anchor's windows; anchors without one only carry bounds down.
        least, most = np.full(len(ids), np.inf), np.full(len(ids), -np.inf)
        np.minimum.at(least, owner, low)
        np.maximum.at(most, owner, high)
        lows = np.empty((len(ids), len(rows)))
        highs = np.empty_like(lows)
        scores = np.full(lows.shape, NOTHING)
        for level in levels:
            reach = np.outer(a_norm[level], lengths)
            slack = SLACK * (1 + reach)
            if parents[level[0]] < 0:
                wanted = np.ones(reach.shape, dtype=bool)
                lows[level], highs[level] = -reach, reach
            else:
                step = np.outer(edges[level], lengths) * (1 + SLACK)
                lows[level] = np.maximum(lows[parents[level]] - step, -reach) - slack
                highs[level] = np.minimum(highs[parents[level]] + step, reach) + slack
                wanted = (highs[level] >= least[level, None]) & (lows[level] <= most[level, None])
            r, c = np.flatnonzero(wanted.any(1)), np.flatnonzero(wanted.any(0))
            if len(r) and len(c):
                places = np.ix_(level[r], c)
                scores[places] = products(anchors[level[r]], rows[c])
                lows[places] = highs[places] = scores[places]
                done += len(r) * len(c)
        found = scores[owner]
        inside = (found >= low[:, None]) & (found <= high[:, None]) & (found != NOTHING)
        inside &= ids[owner][:, None] != own_ids[None, :]
        found = np.where(inside, found, NOTHING)
        if found.shape[1] > k and len(np.unique(own_ids)) == len(own_ids):
            # Of each window its k-th highest score and all that equal or pass it.
            inside &= found >= np.partition(found, -k, axis=1)[:, -k, None]
        w, c = np.nonzero(inside)
        best = _merged(best, (w, first + c, found[w, c]), vec_ids, k)
        rank = np.arange(len(best[0])) - np.searchsorted(best[0], best[0])
        last = rank == k - 1
        low[best[0][last]] = np.maximum(low[best[0][last]], best[2][last])
    return best[0], vec_ids[best[1]], best[2], done


def _merged(best, more, vec_ids, k):
    """The `k` first of each window, by score and then id; equal id and score once."""
    window, place, score = (np.concatenate(pair) for pair in zip(best, more, strict=True))
    keep = np.lexsort((vec_ids[place], -score, window))
    window, place, score = window[keep], place[keep], score[keep]
    again = np.zeros(len(window), dtype=bool)
    again[1:] = (
        (window[1:] == window[:-1]) & (score[1:] == score[:-1]) & (vec_ids[place[1:]] == vec_ids[place[:-1]])
    )
    window, place, score = window[~again], place[~again], score[~again]
    keep = np.arange(len(window)) - np.searchsorted(window, window) < k
    return window[keep], place[keep], score[keep]


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products of integral doubles; an error where 64 bits may not hold them."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if most < EXACT:
        return (left @ right.T).astype(np.int64)
    if most >= 2**63:
        raise ValueError("scores of these vectors may leave 64 bits")
    return left.astype(np.int64) @ right.astype(np.int64).T


def _hits(asked: DataFrame, shelves: DataFrame, same_label: bool, k: int) -> DataFrame:
    """HITS of all pairs of a tree and a shelf that lengths don't rule out.

    asked: TREES with `windows`, an array of (anchor_id, window, low, high).
    """
    shelf_names = shelves.select(
        "shelf",
        F.col("label").alias("shelf_label"),
        "dim",
        F.col("top_norm").alias("shelf_norm"),
        F.abs(F.xxhash64("shelf") % DEALT).alias("dealt"),
    )
    least = F.array_min(F.transform("windows", lambda w: w["low"])).cast("double")
    tree_names = asked.select(
        "tree", "label", "dim", "top_norm", least.alias("least"), F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))).alias("dealt")
    )
    label: Column = F.col("label") == F.col("shelf_label")
    pairs = (
        tree_names.join(shelf_names, ["dim", "dealt"])
        .where(label if same_label else ~label)
        .where((F.col("top_norm") * F.col("shelf_norm")) * (1 + SLACK) + SLACK >= F.col("least"))
        .select("tree", "shelf")
    )
    left = asked.select("tree", "dim", "anchor_ids", "anchors", "parents", "edges", "windows")
    joined = pairs.join(left, "tree").join(shelves.select("shelf", "vec_ids", "vecs"), "shelf").drop("tree", "shelf")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((4, 0), dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                dim, ids, anchors, parents, edges, windows, vec_ids, vecs = (c[i].as_py() for c in batch.columns)
                ids, vec_ids = np.frombuffer(ids, dtype=np.int64), np.frombuffer(vec_ids, dtype=np.int64)
                place = {int(own): at for at, own in enumerate(ids)}
                w, c, score, _ = search(
                    ids,
                    _wide(anchors, len(ids), dim),
                    np.frombuffer(parents, dtype=np.int64),
                    np.frombuffer(edges),
                    ([place[x["anchor_id"]] for x in windows], [x["low"] for x in windows], [x["high"] for x in windows]),
                    vec_ids,
                    _wide(vecs, len(vec_ids), dim),
                    k,
                )
                names = np.array([(x["anchor_id"], x["window"]) for x in windows], dtype=np.int64)[w]
                held = np.hstack((held, np.vstack((names.T, c, score))))
                if held.shape[1] >= HELD_HITS:
                    held = _best(held, k)
                if held.shape[1] >= HELD_HITS:
                    yield _batch(held.tolist(), HITS)
                    held = held[:, :0]
        yield _batch(_best(held, k).tolist(), HITS)

    return joined.mapInArrow(run, HITS)


def _best(hits: np.ndarray, k: int) -> np.ndarray:
    """The k first hits (anchor, window, row, score) of each window; equal rows and scores count once."""
    hits = hits[:, np.lexsort((hits[2], -hits[3], hits[1], hits[0]))]
    new = np.ones(hits.shape[1], dtype=bool)
    new[1:] = (hits[:, 1:] != hits[:, :-1]).any(0)
    hits = hits[:, new]
    begins = np.ones(hits.shape[1], dtype=bool)
    begins[1:] = (hits[:2, 1:] != hits[:2, :-1]).any(0)
    places = np.arange(hits.shape[1])
    return hits[:, places - np.maximum.accumulate(np.where(begins, places, 0)) < k]


def _first(hits: DataFrame, k: int) -> DataFrame:
    """The k first hits of each window, ranked from 1; a task gives at most k of them for most windows."""
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    ranked = hits.dropDuplicates(["anchor_id", "window", "vec_id", "score"]).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k)


def mine(
    spark: SparkSession,
    vectors: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: int = 256,
    anchor_every: int = 50,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by `anchor_every`. An anchor's positives are its
    highest scores among other rows of its label; for each of them the highest scores among rows
    of other labels follow that lie in low_percent to high_percent of the positive's, ends
    included, ties to the smaller id. Windows of negative scores are empty. An anchor or positive
    with fewer rows gets those there are.

    vectors: vec_id, label, embedding; see `prepared` for rows that are left out. Only vectors
    of the anchor's number of components are its candidates. Rows that repeat an id with another
    vector are rows of their own, but none is another row of an anchor with its id, and equal ids
    with equal scores count once; of an anchor id with several rows the smallest (label, vector)
    asks. Empty tables give no rows.
    """
    folder = work_dir(spark, "hardneg")

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    rows = written(prepared(vectors, scale), "rows")
    by_length = ["label", "dim", F.desc("norm"), "vec_id"]
    shelves = written(
        rows.repartitionByRange(*by_length)
        .sortWithinPartitions(*by_length, "vec")
        .mapInArrow(_packed(SHELF_ROWS, SHELVES, _shelf), SHELVES),
        "shelves",
    )
    asking = rows.where(F.col("vec_id") % anchor_every == 0).groupBy("vec_id")
    asking = asking.agg(F.min(F.struct("label", "dim", "vec", "norm", "place")).alias("own"))
    by_place = ["label", "dim", "place", "vec_id"]
    trees = written(
        asking.select("vec_id", "own.label", "own.dim", "own.norm", "own.place", "own.vec")
        .repartitionByRange(*by_place)
        .sortWithinPartitions(*by_place)
        .mapInArrow(_packed(TREE_ANCHORS, TREES, _tree), TREES),
        "trees",
    )
    members = trees.select("tree", "anchor_ids").mapInArrow(_members, "tree string, anchor_id long")

    def asked(windows: DataFrame) -> DataFrame:
        """Trees with the windows (anchor_id, window, low, high) of their anchors."""
        one = F.struct("anchor_id", "window", "low", "high")
        of_tree = members.join(windows, "anchor_id").groupBy("tree").agg(F.collect_list(one).alias("windows"))
        return trees.join(of_tree, "tree")

    whole = {"window": F.lit(0), "low": F.lit(NOTHING + 1), "high": F.lit(-(NOTHING + 1))}
    with session_conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch=BATCH_PAIRS):
        best = _hits(asked(members.select("anchor_id").withColumns(whole)), shelves, True, positives)
        known = written(
            _first(best, positives).select(
                "anchor_id",
                F.col("rank").alias("window"),
                F.col("vec_id").alias("positive_id"),
                F.col("score").alias("positive_score"),
                _share(low_percent, F.ceil).alias("low"),
                _share(high_percent, F.floor).alias("high"),
            ),
            "positives",
        )
        between = asked(known.where("low <= high").select("anchor_id", "window", "low", "high"))
        found = written(_hits(between, shelves, False, negatives), "negatives")
    return (
        _first(found, negatives)
        .join(known, ["anchor_id", "window"])
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


def _share(percent: int, rounded) -> Column:
    """A share of `score` rounded to a whole number, without a product that leaves 64 bits."""
    whole, rest = F.expr("score div 100"), F.expr("score % 100")
    return whole * percent + rounded((rest * percent).cast("decimal(20,0)") / 100).cast("long")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for tree, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = np.frombuffer(ids, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([tree] * len(own)), pa.array(own)], names=["tree", "anchor_id"])
