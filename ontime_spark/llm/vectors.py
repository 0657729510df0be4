"""Nearest neighbours of vectors, approximate by inner product and exact by Hamming distance.

Vectors of one length are dealt to blocks of bounded size. A task builds its block's index once and takes
all queries past it, in batches; so what travels is every row once and every query once a block. Blocks'
answers, at most k a query, are merged by rank.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ontime_spark.llm.common import join_by_weight, keep, thrifty

BLOCK_ROWS = 16_384
BLOCK_BYTES = 64 << 20  # of a block's vectors, however long they are


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, width, rows, norm): rows with an id and a vector of finite numbers that aren't all zero, as doubles.

    rows and norm are of all vectors of the same length (width): their number and greatest squared norm.
    """
    v = F.col(f"`{vector_col}`").cast("array<double>")
    good = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & good & F.exists("v", lambda x: x != 0)
    )
    rows = keep(rows.withColumn("width", F.size("v")), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    widths = rows.groupBy("width").agg(F.count(F.lit(1)).alias("rows"), F.max(norm).alias("norm"))
    return join_by_weight(rows, keep(widths, "widths"), ["width"], "rows")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


# ---------------------------------------------------------------- approximate, by inner product


def chi_square(x: np.ndarray, freedom: int) -> np.ndarray:
    """The chance that a chi-square variable of an even number of degrees is at most x."""
    half = np.minimum(np.asarray(x, float) / 2, 700)
    term, total = np.ones_like(half), np.ones_like(half)
    for j in range(1, freedom // 2):
        term = term * half / j
        total = total + term
    return 1 - np.exp(-half) * total


class ProjectedTree:
    """A kd-tree over projections: leaves of points with their boxes, split at medians."""

    def __init__(self, points: np.ndarray, leaf: int = 128):
        self.leaves: list[np.ndarray] = []
        low, high = [], []
        stack = [np.arange(len(points))]
        while stack:
            part = stack.pop()
            box = points[part]
            a, b = box.min(axis=0), box.max(axis=0)
            if len(part) <= leaf or (a == b).all():  # equal points can't be split
                self.leaves.append(part)
                low.append(a)
                high.append(b)
                continue
            axis = int(np.argmax(b - a))
            middle = len(part) // 2
            halves = np.argpartition(box[:, axis], middle)
            stack += [part[halves[middle:]], part[halves[:middle]]]
        self.low, self.high = np.array(low), np.array(high)

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distance of a projected query to each leaf's box."""
        gap = np.maximum(np.maximum(self.low - q, q - self.high), 0)
        return (gap * gap).sum(axis=1)


def chi_square_quantile(chance: float, freedom: int) -> float:
    """The x that a chi-square variable of an even number of degrees stays below with this chance."""
    low, high = 0.0, 1400.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < chance else (low, middle)
    return high


FIRST_LEAVES = 4
STEPS = (256, 1024, 4096)  # so many projected neighbours, about, after which the search looks again how far to go
SAMPLED = 16  # the distances that so many neighbours reach are read off every 16th point


class ProjectedBlock:
    """A block's vectors with their projections in a kd-tree, both in the order of its leaves.

    With a last component that gives all candidates the norm ``greatest``, and 0 for queries, a larger
    inner product is a smaller distance. A squared projected distance over the squared distance is
    chi-square distributed with as many degrees of freedom as there are projections.
    """

    def __init__(self, ids: np.ndarray, v: np.ndarray, greatest: float, dimensions: int, confidence: float, seed: int):
        self.greatest = greatest
        self.projection = np.random.default_rng((seed, v.shape[1])).standard_normal((v.shape[1] + 1, dimensions))
        last = np.sqrt(np.maximum(greatest**2 - (v * v).sum(axis=1), 0))
        points = v @ self.projection[:-1] + last[:, None] * self.projection[-1]
        self.tree = ProjectedTree(points)
        order = np.concatenate(self.tree.leaves)
        self.ids, self.v, self.points = ids[order], v[order], points[order]
        self.squares = (self.points * self.points).sum(axis=1)
        self.sizes = np.array([len(leaf) for leaf in self.tree.leaves])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.quantile = chi_square_quantile(confidence, dimensions)
        self.verified = 0

    def _inside(self, leaves: np.ndarray) -> np.ndarray:
        """Where the points of some leaves are."""
        sizes = self.sizes[leaves]
        return np.arange(sizes.sum()) + np.repeat(self.starts[leaves] - np.cumsum(sizes) + sizes, sizes)

    def search(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int, float]]:
        """(query, id, inner product) of the k best, by incremental projected neighbours.

        Projected neighbours are verified by growing distance. The search ends when a neighbour nearer than
        the kth verified would, with the block's confidence, have come before the next one: beyond the
        chi-square quantile times the kth distance. The kth distance in the leaves with the nearest boxes bounds
        that from the start, and leaves with boxes beyond it stay closed.
        """
        length = float((q * q).sum()) + self.greatest**2
        projected = q @ self.projection[:-1]
        gaps = self.tree.distances(projected)

        def verify(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            self.verified += len(some)
            some = some[self.ids[some] != query_id]
            return some, self.v[some] @ q

        def reach(near: np.ndarray) -> float:
            """The projected distance beyond which the search need not go, with what rounding may add."""
            if len(near) < k:
                return math.inf
            return max(length - 2 * np.partition(near, -k)[-k], 0) * self.quantile + 1e-9 * length

        first = np.argsort(gaps, kind="stable")[:FIRST_LEAVES]
        at, near = verify(self._inside(first))  # these stay, so k are found wherever the end is
        start, end = -math.inf, reach(near)
        open_leaf = gaps <= end
        open_leaf[first] = False
        opened = self._inside(np.flatnonzero(open_leaf))
        everywhere = 2 * len(opened) > len(self.ids)  # quicker as they lie; a closed leaf's points are beyond the end
        among = slice(None) if everywhere else opened
        away = self.squares[among] - 2 * (self.points[among] @ projected) + projected @ projected
        if everywhere:
            away[self._inside(first)] = start
        sample = np.sort(away[::SAMPLED])
        sample = sample[np.searchsorted(sample, start, "right") :]
        for edge in [*(sample[s // SAMPLED] for s in STEPS if s // SAMPLED < len(sample)), math.inf]:
            edge = min(edge, end)
            some = np.flatnonzero((away > start) & (away <= edge))
            fresh, scores = verify(some if everywhere else opened[some])
            at, near = np.concatenate([at, fresh]), np.concatenate([near, scores])
            if len(near) > k:
                least = np.partition(near, -k)[-k]
                best = near >= least - 1e-9 * (1 + abs(least))  # all ties stay
                at, near = at[best], near[best]
            start, end = edge, min(end, reach(near))
            if start >= end:
                break
        exact = (self.v[at] * q).sum(axis=1)  # one row at a time: equal vectors score equally
        first = np.lexsort((self.ids[at], -exact))[:k]
        return [(int(query_id), int(self.ids[at[j]]), float(exact[j])) for j in first]


# ---------------------------------------------------------------- exact, by Hamming distance


def sign_codes(v: np.ndarray) -> np.ndarray:
    """One bit a component, set where it is positive, packed to 64-bit words."""
    bits = np.packbits(v > 0, axis=1)
    bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8)))
    return np.ascontiguousarray(bits).view(np.uint64)


class SegmentTables:
    """For each 16-bit segment of the codes, the rows by the segment's value."""

    def __init__(self, codes: np.ndarray):
        self.parts = codes.view(np.uint16)
        self.order, self.starts = [], []
        for s in range(self.parts.shape[1]):
            order = np.argsort(self.parts[:, s], kind="stable")
            self.order.append(order)
            self.starts.append(np.searchsorted(self.parts[order, s], np.arange(65537)))

    def rows(self, segment: int, values: np.ndarray) -> np.ndarray:
        a, b = self.starts[segment][values], self.starts[segment][values.astype(np.int64) + 1]
        some = b > a
        a, b = a[some], b[some]
        if len(a) == 0:
            return np.zeros(0, np.int64)
        length = b - a
        steps = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        return self.order[segment][np.repeat(a, length) + steps]


_ALL16 = np.arange(65536, dtype=np.uint16)
_RINGS = [_ALL16[np.bitwise_count(_ALL16) == r] for r in range(17)]


class CodeBlock:
    """A block's codes with their segment tables."""

    def __init__(self, ids: np.ndarray, v: np.ndarray):
        self.ids, self.codes = ids, sign_codes(v)
        self.tables = SegmentTables(self.codes)

    def search(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(query, id, distance) of the k nearest codes, ties to the smaller id; exact.

        At radius r every code with a segment within r of the query's is verified. A code not seen yet
        differs by r + 1 or more in each of the m segments, so by m * (r + 1) or more: once the kth verified
        distance is below that, nothing nearer and no tie can be left.
        """
        code = sign_codes(q[None, :])[0]
        parts, m = code.view(np.uint16), self.tables.parts.shape[1]
        seen = np.zeros(len(self.codes), bool)
        seen[self.ids == query_id] = True
        at, far = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for radius in range(17):
            fresh = np.concatenate([self.tables.rows(s, parts[s] ^ _RINGS[radius]) for s in range(m)])
            fresh = np.unique(fresh[~seen[fresh]])
            seen[fresh] = True
            d = np.bitwise_count(self.codes[fresh] ^ code).sum(axis=1, dtype=np.int64)
            at, far = np.concatenate([at, fresh]), np.concatenate([far, d])
            if len(far) >= k and np.partition(far, k - 1)[k - 1] < m * (radius + 1):
                break
        first = np.lexsort((self.ids[at], far))[:k]
        return [(int(query_id), int(self.ids[at[j]]), int(far[j])) for j in first]


# ---------------------------------------------------------------- both


def _search(rows: DataFrame, is_query, k: int, index: Callable, score_type: str, descending: bool) -> DataFrame:
    """The k best of what every block finds for every query of its length.

    A block's rows come first, then its queries: the index is built when the first of them comes, and then
    queries stream past it. Blocks that no query meets, and queries, are bounded by batches.
    """
    fit = F.greatest(F.least(F.lit(BLOCK_ROWS), F.floor(BLOCK_BYTES / (8 * F.col("width")))), F.lit(1))
    blocks = F.ceil(F.col("rows") / fit).cast("int")
    dealt = rows.withColumn("blocks", blocks)
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["width", "block", "query", "id", "v", "norm"]
    held = dealt.withColumn("block", mine).withColumn("query", F.lit(False)).select(columns)
    asked = dealt.filter(is_query).withColumn("block", every).withColumn("query", F.lit(True)).select(columns)
    # As many tasks as blocks, where the cluster has no more of them.
    number = dealt.agg(F.sum(1 / F.col("rows") * F.col("blocks"))).first()[0]
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), round(number or 1))
    meet = held.unionByName(asked).repartition(tasks, "width", "block").sortWithinPartitions("width", "block", "query")
    kinds = (pa.int64(), pa.int64(), pa.float64() if score_type == "double" else pa.int32())

    def packed(found):
        return pa.RecordBatch.from_arrays(
            [pa.array([f[c] for f in found], kinds[c]) for c in range(3)], names=["query_id", "vec_id", "score"]
        )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, built = None, [], None
        for batch in batches:
            heads = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((heads[1:] != heads[:-1]).any(axis=1)) + 1).tolist(), len(heads)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                part, (width, block, query) = batch.slice(a, b - a), heads[a].tolist()
                ids, v = part.column(3).to_numpy(), _matrix(part.column(4))
                if (width, block) != key:
                    key, parts, built = (width, block), [], None
                if not query:
                    parts.append((ids, v, part.column(5)[0].as_py()))
                    continue
                if built is None:  # a block of queries has rows, as they are among them
                    built = index(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), parts[0][2])
                    parts = []
                yield packed([f for i in range(len(ids)) for f in built.search(ids[i], v[i], k)])

    found = meet.select(columns).mapInArrow(thrifty(apply), f"query_id long, vec_id long, score {score_type}")
    order = F.col("score").desc() if descending else F.col("score").asc()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)


def nearest_by_inner_product(
    df: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    dimensions: int = 24, confidence: float = 0.9, seed: int = 3,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest other rows, by largest inner product.

    ``is_query`` is a condition on the column ``id``. Scores are in double precision on the vectors
    given; ties go to the smaller id. Rows whose id or vector is null, or whose vector is zero or not
    finite, take no part. Rows that repeat an id are candidates each.
    With fewer candidates than k all come. Other columns are ignored; an empty table gives no rows.

    Only the greatest norm of each length is learnt from the data; every row is indexed. A vector meets those
    of its own length, as it has no inner product with others.
    """
    rows = usable(df, id_col, vector_col)

    def index(ids, v, norm):
        return ProjectedBlock(ids, v, math.sqrt(norm) * (1 + 1e-12), dimensions, confidence, seed)

    return _search(rows, is_query, k, index, "double", True).select("query_id", "rank", "vec_id", "score")


def nearest_by_hamming(
    df: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, distance): each query's k nearest other rows by sign code, exactly.

    A vector's code has a bit for each component, set where it is positive. Ties go to the smaller id.
    Nulls, zero and non-finite vectors, repeated ids, few candidates, other columns and empty tables
    are as in ``nearest_by_inner_product``.
    """
    rows = usable(df, id_col, vector_col)

    found = _search(rows, is_query, k, lambda ids, v, norm: CodeBlock(ids, v), "int", False)
    return found.select("query_id", "rank", "vec_id", F.col("score").alias("distance"))
