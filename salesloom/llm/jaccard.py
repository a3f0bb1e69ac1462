"""N-gram Jaccard join as a blocked sparse product of documents by n-grams.

A document is a row of the incidence matrix, the set of its distinct word 5-grams. Two documents
link when the sets' intersection is 80 % or more of their union. The product of the matrix with
itself holds all intersections; what of it can't reach the threshold is never made:

* Equal rows are one: documents with the same set form a class, with one node in what follows.
* N-grams have one global order, rare before frequent. Sets that link share one of their first
  elements, so only the first fifth of a row goes into blocks, a block for each n-gram.
* A pair that meets in a block is kept if its sizes and the parity bits of both sets allow a
  link: sets of n and m elements that link share t = 4 (n + m) / 9 or more, so they differ in at most
  n + m - 2 t elements, and bits that differ are never more than that.
* What the blocks hold of a pair is added up. The sum counts all common elements among the first
  ones of both sets; with those that can still follow in the rest of a set it must reach t, or the pair is
  discarded. Few pairs are left that don't link; an exact count over both texts decides.

Links are needed only between different components. First each row of a block meets the row
of the block where the element stands earliest, which is the most central of a group of near
copies. Then rows of one block that are still in different components meet, and only those. So
a group of near copies costs as many pairs as it has rows, and no link between different
components is lost.

Frequent n-grams are split into sub-blocks by their estimated count; the centres of sub-blocks
meet in a step of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm.components import components
from salesloom.llm.textops import Words, as_signed, fresh, lower_ascii, mixed, rolling, slices, strings
from salesloom.plans.session import work_dir

SHINGLE = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80
#: An n-gram is frequent where it stands in this share of documents; the number of frequent
#: n-grams is at most the mean size of a set over this share, however many documents there are.
FREQUENT = 0.0005
#: Rows of a sub-block, as estimated.
BLOCK_ROWS = 20_000
#: Rows of a tile of a block, of the blocks of a first node in a task, and pairs whose counts a task holds before it sends any.
TILE_ROWS = 2_048
ROUTE_ROWS = 4_096
HELD_PAIRS = 400_000
#: Bytes of packed text of pairs that are verified at once.
PAIR_BYTES = 2 << 20

#: Words of 64 parity bits of a set. They tell sets apart that differ in less than about as many elements.
PARITY = 16
PARITY_ROWS = 2_048
#: Bytes of text whose sets are in memory at once.
SLICE = 4 << 20

BITS = [f"bits_{k}" for k in range(PARITY)]
SETS = "doc_id long, text_key long, n long, node long, frequent array<long>, counts array<long>, " + ", ".join(
    f"{name} long" for name in BITS
)
PAIRS = "a long, b long, n long, m long, shared long"
ENTRIES = "block long, shingle long, node long, n int, rank int, split boolean"


class Sets:
    """The shingle sets of a slice of texts: values[bounds[i]:bounds[i + 1]], ascending."""

    def __init__(self, texts: pa.Array):
        words = Words(lower_ascii(texts))
        hashes, counts = words.hashes(), words.counts
        whole = rolling(hashes, SHINGLE)
        number = np.where(counts >= SHINGLE, counts - SHINGLE + 1, 0)
        owner = np.repeat(np.arange(len(texts)), number)
        at = words.bounds[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        values = whole[at] if len(at) else np.empty(0, dtype=np.uint64)
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        if len(short):  # fewer words: the whole sequence as one
            ends = [
                xxhash.xxh3_64_intdigest(hashes[words.bounds[k] : words.bounds[k + 1]].tobytes(), seed=1) for k in short
            ]
            owner = np.concatenate((owner, short))
            values = np.concatenate((values, np.array(ends, dtype=np.uint64)))
        order = np.lexsort((values, owner))
        owner, values = owner[order], values[order]
        keep = np.ones(len(owner), dtype=bool)
        keep[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
        self.owner, self.values = owner[keep], values[keep]
        self.sizes = np.bincount(self.owner, minlength=len(texts))
        self.bounds = np.concatenate(([0], np.cumsum(self.sizes)))

    def nodes(self) -> np.ndarray:
        """A number for each set, the same for equal sets; 0 for empty ones."""
        raw = self.values.astype("<u8").tobytes()
        return np.array(
            [
                xxhash.xxh3_64_intdigest(raw[8 * a : 8 * b]) if b > a else 0
                for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)
            ],
            dtype=np.uint64,
        )


    def parity(self) -> np.ndarray:
        """PARITY words for each set, whose bits say whether an odd number of elements falls on them."""
        bit = (mixed(self.values) & np.uint64(64 * PARITY - 1)).astype(np.int64)
        out = np.zeros((len(self.sizes), PARITY), dtype=np.int64)
        for first in range(0, len(self.sizes), PARITY_ROWS):
            last = min(first + PARITY_ROWS, len(self.sizes))
            own = slice(int(self.bounds[first]), int(self.bounds[last]))
            place = (self.owner[own] - first) * (64 * PARITY) + bit[own]
            odd = (np.bincount(place, minlength=(last - first) * 64 * PARITY) & 1).astype(np.uint8)
            out[first:last] = np.packbits(odd, bitorder="little").view("<i8").reshape(-1, PARITY)
        return out


def required(n, m, percent: int = PERCENT):
    """The smallest intersection of sets of n and m elements that link."""
    return -(-percent * (n + m) // (100 + percent))


def sets(documents: DataFrame) -> DataFrame:
    """SETS: a row for each document, and rows with n-grams frequent in a slice (node null).

    documents: doc_id, text_key, text. Sets are known by a 64-bit hash of all their elements:
    among 10**9 different sets the chance that any two share one is below 3 %.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in SETS.split(", ")]
        for batch in slices(batches, "text", SLICE):
            own = Sets(strings(batch.column("text")))
            size, empty = batch.num_rows, pa.nulls(batch.num_rows, pa.list_(pa.int64()))
            bits = [pa.array(word) for word in own.parity().T]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_key"), pa.array(own.sizes.astype(np.int64)),
                    pa.array(as_signed(own.nodes()), mask=own.sizes == 0), empty, empty, *bits,
                ],
                names=names,
            )
            values, counts = np.unique(own.values, return_counts=True)
            often = counts >= max(3, FREQUENT * size)
            listed = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (as_signed(values[often]), counts[often])]
            one = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [one, one, pa.array([-1], pa.int64()), one, *listed, *[one] * PARITY], names=names
            )

    return documents.mapInArrow(run, SETS)


def entries(documents: DataFrame, frequent: dict[int, int], percent: int = PERCENT) -> DataFrame:
    """ENTRIES: the first elements of each set, in the global order, with their places."""
    known = np.array(sorted(frequent), dtype=np.int64)
    shared = documents.sparkSession.sparkContext.broadcast(  # at most mean set size / FREQUENT
        (known.view(np.uint64), np.array([frequent[k] for k in known.tolist()], dtype=np.int64))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts = shared.value
        order = np.argsort(values)
        values, counts = values[order], counts[order]
        for batch in slices(batches, "text", SLICE):
            own = Sets(strings(batch.column("text")))
            nodes = own.nodes()
            _, firsts = np.unique(nodes, return_index=True)
            once = np.zeros(len(nodes), dtype=bool)
            once[firsts] = True
            keep = once[own.owner]
            owner, shingles = own.owner[keep], own.values[keep]
            count = np.zeros(len(shingles), dtype=np.int64)
            if len(values):
                at = np.minimum(np.searchsorted(values, shingles), len(values) - 1)
                count = np.where(values[at] == shingles, counts[at], 0)
            order = np.lexsort((shingles, count, owner))
            owner, shingles, count = owner[order], shingles[order], count[order]
            begins = np.searchsorted(owner, np.arange(len(nodes)))
            rank = np.arange(len(owner)) - begins[owner]
            n = own.sizes[owner]
            early = rank <= n - -(-percent * n // 100)
            owner, shingles, count, rank, n = (x[early] for x in (owner, shingles, count, rank, n))
            parts = np.maximum(1, -(-count // BLOCK_ROWS)).astype(np.uint64)
            part = mixed(nodes[owner]) % parts
            block = np.where(part > 0, mixed(shingles ^ mixed(part)), shingles)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(as_signed(block)), pa.array(as_signed(shingles)), pa.array(as_signed(nodes[owner])),
                    pa.array(n.astype(np.int32)), pa.array(rank.astype(np.int32)), pa.array(parts > 1),
                ],
                names=[field.split()[0] for field in ENTRIES.split(", ")],
            )

    return documents.select("text").mapInArrow(run, ENTRIES)


def _indexed(n: str, rank: str, percent: int) -> str:
    """Whether a place is early enough for the smaller set of a pair."""
    return f"{rank} <= {n} - ({2 * percent} * {n} + {99 + percent}) DIV {100 + percent}"


def _possible(n: str, i: str, m: str, j: str, percent: int) -> str:
    """Whether sets of n and m elements, first common element at i and j, may link."""
    return (
        f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m}) AND "
        f"{100 + percent} * least({n} - {i}, {m} - {j}) >= {percent} * ({n} + {m})"
    )


def _differ_little(n: str, m: str, one: str, other: str, percent: int) -> Column:
    """Whether sizes and parity bits allow sets to link; their columns begin with `one` and `other`."""
    differing = reduce(Column.__add__, [F.bit_count(F.col(one + b).bitwiseXOR(F.col(other + b))) for b in BITS])
    most = f"{n} + {m} - 2 * (({percent} * ({n} + {m}) + {99 + percent}) DIV {100 + percent})"
    return F.expr(f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m})") & (differing <= F.expr(most))


def _reachable(n: str, m: str, shared: str, percent: int) -> str:
    """Whether a pair with `shared` common elements among the first ones of both sets may link.

    The first ones of n elements are n - s + 1, s being the least share of n that the other set
    must hold. Beyond the set whose first ones end earlier in the order, s - 1 can follow at most.
    """
    rest = f"(({percent} * greatest({n}, {m}) + 99) DIV 100 - 1)"
    return f"{100 + percent} * ({shared} + {rest}) >= {percent} * ({n} + {m})"


def product(rest: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b, n, m, shared: pairs of nodes in different components, and common elements of both.

    rest: blocks (rows_1, rows_2) with their first node, height and weight (the number of elements
    that they stand for), and node, n, component and parity bits of their rows. Blocks are dealt by
    their first node, about ROUTE_ROWS to a task, so that what a group of near copies shares is mostly
    added up in few tasks; a block of more than TILE_ROWS is cut into tiles, and pairs of tiles are
    dealt like blocks. Sums of different tasks have still to be added.
    """
    names = ["rows_1", "rows_2", "one", "other", "tile", "weight", "node", "n", "component", *BITS]
    tiles = F.ceil(F.col("height") / TILE_ROWS)
    tile = F.pmod(F.xxhash64("node", F.lit(3)), tiles)
    cut = rest.withColumn("tile", tile).withColumn("with", F.explode(F.sequence(F.lit(0), (tiles - 1).cast("int"))))
    cut = cut.withColumns({"one": F.least("tile", "with"), "other": F.greatest("tile", "with")})
    # The blocks of one first node may be many: they are dealt to as many tasks as their rows need.
    led = rest.groupBy("first").agg(F.ceil(F.count("*") / ROUTE_ROWS).alias("routes")).where("routes > 1")
    led.write.parquet(folder := work_dir(rest.sparkSession, "jaccard-led"))  # one in ROUTE_ROWS at most
    led = rest.sparkSession.read.schema(led.schema).parquet(folder)
    whole = F.xxhash64("first", F.pmod("rows_1", F.coalesce("routes", F.lit(1))))
    route = F.when(tiles == 1, whole).otherwise(F.xxhash64("rows_1", "rows_2", "one", "other"))
    dealt = cut.join(led, "first", "left").withColumn("route", route).repartition("route").sortWithinPartitions("rows_1", "rows_2", "one", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        held = np.empty((len(names), 0), dtype=np.int64)
        for batch in batches:
            rows = np.hstack((held, np.array([c.to_numpy() for c in batch.columns], dtype=np.int64).reshape(len(names), -1)))
            turns = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(0)) + 1
            done = int(turns[-1]) if len(turns) else 0
            held = rows[:, done:]  # the last block may go on in the next batch
            yield from sums.add(_met(rows[:, :done], turns[:-1], percent))
        yield from sums.add(_met(held, np.empty(0, dtype=np.int64), percent))
        yield from sums.rest()

    return dealt.select(*names).mapInArrow(run, PAIRS)


def _met(rows: np.ndarray, turns: np.ndarray, percent: int) -> np.ndarray:
    """Rows (a, b, n, m, shared) of pairs in the same block; blocks begin at 0 and at `turns`."""
    size = rows.shape[1]
    block = np.zeros(size, dtype=np.int64)
    block[turns] = 1
    block = np.cumsum(block)
    cut, tile, weight, node, n, component = rows[2] != rows[3], *rows[4:9]
    bits = np.ascontiguousarray(rows[9:].T).view(np.uint64)  # bits of signed numbers would be those of their size
    found = [np.empty((5, 0), dtype=np.int64)]
    for apart in range(1, size):
        i = np.flatnonzero(block[apart:] == block[:-apart])
        if not len(i):
            break  # no block has more rows
        j = i + apart
        keep = (component[i] != component[j]) & (node[i] != node[j]) & (~cut[i] | (tile[i] != tile[j]))
        keep &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        i, j = i[keep], j[keep]
        differing = np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64)
        keep = differing <= n[i] + n[j] - 2 * required(n[i], n[j], percent)
        i, j = i[keep], j[keep]
        swap = node[i] > node[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        found.append(np.array([node[i], node[j], n[i], n[j], weight[i]]))
    return np.hstack(found)


class _Sums:
    """Adds up what pairs share, and gives sums away only where they grow beyond HELD_PAIRS."""

    def __init__(self):
        self.held = np.empty((5, 0), dtype=np.int64)

    def add(self, more: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held = np.hstack((self.held, more))
        if self.held.shape[1] >= HELD_PAIRS:
            self._sum()
            if self.held.shape[1] >= HELD_PAIRS // 2:
                yield from self.rest()

    def _sum(self) -> None:
        rows = self.held[:, np.lexsort((self.held[1], self.held[0]))]
        starts = np.flatnonzero(np.concatenate(([True], (rows[:2, 1:] != rows[:2, :-1]).any(0))))
        self.held = np.vstack((rows[:4, starts], np.add.reduceat(rows[4], starts)))

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held.shape[1]:
            self._sum()
            names = [field.split()[0] for field in PAIRS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in self.held], names=names)
            self.held = self.held[:, :0]


def verified(pairs: DataFrame, store: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b, overlap, total of the pairs (a, b) of nodes that link; total is the union's size.

    store: node, packed. A text travels once for each of its pairs; pairs of one node need not
    meet in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "packed_b", PAIR_BYTES):
            texts, places, ends = [], {}, []
            for side in ("a", "b"):
                nodes, packed = batch.column(side).to_pylist(), batch.column(f"packed_{side}")
                for k, node in enumerate(nodes):
                    if node not in places:
                        places[node] = len(texts)
                        texts.append(unpack(packed[k].as_buffer()).decode("utf-8", "surrogatepass"))
                ends.append(np.array([places[node] for node in nodes]))
            own = Sets(pa.array(texts, pa.large_string()))
            parts = [own.values[a:b] for a, b in zip(own.bounds[:-1], own.bounds[1:], strict=True)]
            overlap = np.array(
                [_common(parts[x], parts[y]) for x, y in zip(*ends, strict=True)], dtype=np.int64
            )
            total = own.sizes[ends[0]] + own.sizes[ends[1]] - overlap
            links = pa.array(100 * overlap >= percent * total)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(overlap), pa.array(total)],
                names=["a", "b", "overlap", "total"],
            ).filter(links)

    left = store.select(F.col("node").alias("a"), F.col("packed").alias("packed_a"))
    right = store.select(F.col("node").alias("b"), F.col("packed").alias("packed_b"))
    return (
        pairs.join(right, "b").join(left, "a").select("a", "b", "packed_a", "packed_b")
        .mapInArrow(run, "a long, b long, overlap long, total long")
    )


def _common(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum())


def _packed(documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches, "text", SLICE):
            texts = [pack(t.as_py().encode("utf-8", "surrogatepass")) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(texts, pa.binary())], names=["node", "packed"])

    return documents.select("node", "text").mapInArrow(run, "node long, packed binary")


class Join:
    """The join of `documents` (doc_id, text; others are dropped) with itself.

    sets: doc_id, text_key, n, node of each row. links: verified links (a, b, overlap, total)
    between nodes, at least those that connect each component. members: node, component of all
    nodes that have a link.
    """

    def __init__(self, spark: SparkSession, documents: DataFrame, percent: int = PERCENT):
        folder = work_dir(spark, "jaccard")
        kept = {"compression": "zstd"}

        def written(name: str, rows: DataFrame) -> DataFrame:
            rows.write.options(**kept).parquet(f"{folder}/{name}")
            return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

        text = F.coalesce("text", F.lit(""))
        long_id = F.col("doc_id").cast("long")
        keyed = documents.select(long_id.alias("doc_id"), F.xxhash64(long_id, text).alias("text_key"), text.alias("text"))
        found = written("sets", sets(keyed))
        self.sets = found.where("n >= 0").select("doc_id", "text_key", "n", "node")
        parity = found.where("node IS NOT NULL").groupBy("node").agg(*[F.first(b).alias(b) for b in BITS])
        lower = FREQUENT * self.sets.count()
        often = (
            found.where("n < 0")
            .select(F.explode(F.arrays_zip("frequent", "counts")).alias("x"))
            .groupBy(F.col("x.frequent").alias("shingle"))
            .agg(F.sum("x.counts").alias("n"))
            .where(F.col("n") >= max(3, math.ceil(lower)))
        )
        frequent = dict(often.toPandas().itertuples(index=False, name=None))

        block = Window.partitionBy("block")
        centre = F.when(F.expr(_indexed("n", "rank", percent)), F.struct("rank", "n", "node"))
        shared = (
            entries(keyed, frequent, percent)
            .withColumns(
                {"centre": F.min(centre).over(block), "low": F.min("node").over(block), "high": F.max("node").over(block)}
            )
            .where("split OR low != high")
            .select("block", "shingle", "node", "n", "rank", "centre")
        )
        # A row alone in a sub-block stays, as it has others in the rest of its block, and so do blocks
        # without a centre: their elements count when the overlap of a pair is added up.
        shared = written("shared", shared)
        near = shared.where("node != centre.node").where(
            _possible("n", "rank", "centre.n", "centre.rank", percent)
        ).select(F.col("centre.node").alias("a"), F.col("node").alias("b"))
        centres = shared.where("centre IS NOT NULL").select("shingle", "centre").distinct()
        first = centres.groupBy("shingle").agg(F.min("centre").alias("first"), F.count("*").alias("parts")).where("parts > 1")
        between = centres.join(first, "shingle").where("centre.node != first.node").select(
            F.col("first.node").alias("a"), F.col("centre.node").alias("b")
        )
        pairs = written("pairs", self._possible_pairs(ordered(near.unionByName(between)), parity, percent))

        owners = self.sets.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("owner"))

        def linked(found: DataFrame, name: str) -> DataFrame:
            """The pairs that link, by the texts of their nodes."""
            nodes = found.select(F.col("a").alias("node")).unionByName(found.select(F.col("b").alias("node"))).distinct()
            own = owners.join(nodes, "node", "left_semi").select("node", "owner.doc_id", "owner.text_key")
            same = [keyed["doc_id"].eqNullSafe(own["doc_id"]), keyed["text_key"] == own["text_key"]]
            store = written(f"store-{name}", _packed(keyed.join(own, same).select("node", "text")))
            return written(f"links-{name}", verified(found, store.dropDuplicates(["node"]), percent))

        links = linked(pairs, "1")
        members = components(spark, links, f"{folder}/components-1")

        # Rows of a block in different components meet. Blocks of the same rows are one, with their
        # number as its weight: two long texts that share a thousand elements meet once.
        with_component = shared.join(members, "node", "left").select(
            "shingle", "node", "n", F.coalesce("component", "node").alias("component")
        )
        same_rows = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"rows_{k}") for k in (1, 2)]
        open_ = (
            with_component.distinct()
            .groupBy("shingle")
            .agg(
                F.min("component").alias("low"),
                F.max("component").alias("high"),
                F.min("node").alias("first"),
                F.count("*").alias("height"),
                *same_rows,
            )
            .where("low != high")
            .drop("low", "high")
        )
        rest = with_component.distinct().join(open_, "shingle")
        rest = rest.groupBy("rows_1", "rows_2", "first", "height", "node", "n", "component").agg(
            F.count("*").alias("weight")
        )
        met = product(written("open", rest.join(parity, "node")), percent)
        counted = met.groupBy("a", "b", "n", "m").agg(F.sum("shared").alias("shared"))
        crossing = counted.where(_reachable("n", "m", "shared", percent)).select("a", "b")
        crossing = crossing.join(pairs, ["a", "b"], "left_anti")
        more = linked(written("crossing", crossing), "2")
        if more.limit(1).count():
            links = links.unionByName(more)
            members = components(spark, links, f"{folder}/components-2")
        self.links, self.members = links, members

    def _possible_pairs(self, pairs: DataFrame, parity: DataFrame, percent: int) -> DataFrame:
        """Pairs (a, b) whose sizes and parity bits allow a link."""
        sized = parity.join(self.sets.where("node IS NOT NULL").groupBy("node").agg(F.first("n").alias("n")), "node")
        of = lambda side: sized.select(*(F.col(c).alias(f"{side}_{c}" if c != "node" else side) for c in sized.columns))
        both = pairs.join(of("a"), "a").join(of("b"), "b")
        return both.where(_differ_little("a_n", "b_n", "a_", "b_", percent)).select("a", "b")

    def classes(self) -> DataFrame:
        """node, copies, first_id, component_id: each different set, by its documents' ids."""
        own = self.sets.where("node IS NOT NULL").groupBy("node").agg(
            F.count("*").alias("copies"), F.min("doc_id").alias("first_id")
        )
        linked = self.members.join(own, "node")
        least = linked.groupBy("component").agg(F.min("first_id").alias("least"))
        reached = linked.join(least, "component").select("node", "least")
        return own.join(reached, "node", "left").select(
            "node", "copies", "first_id", F.coalesce("least", "first_id").alias("component_id")
        )

    def per_document(self) -> DataFrame:
        """doc_id, n_shingles, component_id, copies of each row.

        A document without words links with nothing: its component is its own id. Documents with
        equal sets are in one component. Null ids have no say in the smallest id of a component.
        """
        classes = self.classes().select("node", "component_id", "copies")
        return self.sets.join(classes, "node", "left").select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
            F.coalesce("copies", F.lit(1)).alias("copies"),
        )


    def representatives(self, documents: DataFrame) -> DataFrame:
        """One row of each component of `documents`, all columns: that with the smallest id.

        `documents` are those of the join. Of rows that repeat id and text one stays. Rows without
        words all stay. A row without an id stays where its component has no row with one.
        """
        names = documents.columns
        rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
        chosen = (
            self.sets.where("node IS NOT NULL")
            .groupBy("node", "doc_id", "text_key")
            .agg((F.count("*") > 1).alias("repeated"))
            .join(self.members, "node", "left")
            .groupBy(F.coalesce("component", "node").alias("component"))
            .agg(F.min_by(F.struct("doc_id", "text_key", "repeated"), rank).alias("row"))
            .select("row.*")
        )
        empty = self.sets.where("node IS NULL").select("doc_id", "text_key", F.lit(False).alias("repeated")).distinct()
        kept = chosen.unionByName(empty)
        own_id, own_key, again = (fresh(names, name) for name in ("own_id", "own_key", "own_repeated"))
        long_id = F.col("doc_id").cast("long")
        rows = documents.withColumns({own_id: long_id, own_key: F.xxhash64(long_id, F.coalesce("text", F.lit("")))})
        found = rows.join(
            kept, [rows[own_id].eqNullSafe(kept["doc_id"]), rows[own_key] == kept["text_key"]]
        ).select(*(rows[c] for c in rows.columns), kept["repeated"].alias(again))
        single = found.where(~F.col(again))
        if chosen.where("repeated").limit(1).count():
            single = single.unionByName(found.where(again).dropDuplicates([own_id, own_key]))
        return single.select(*names)


def ordered(pairs: DataFrame) -> DataFrame:
    """Different pairs, the smaller node first."""
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct()
