"""N-gram Jaccard join over prefix trees.

Texts become sets of word n-grams. Equal sets are one class. Classes that can be similar share an
n-gram among the first few of their sets under one global order (rare first); the classes sharing
such an n-gram form a group. Inside a group the sets, ordered by how common their n-grams are there,
are stored in a trie whose nodes are runs of n-grams: a set is matched against the trie from the
root, so that sets with the same beginning share the overlap counted so far, and a subtree is left
as soon as what remains of both sides cannot reach the overlap that similarity asks for. Only links
that join two groups of already linked sets are put out, which leaves components as they are.

Whole sets travel as little as possible. Histograms of the sets' hashes, a fortieth of their size,
give an upper bound of each overlap and drop classes from groups where they can have no partner. Then
each class is matched in its largest group only; what remains are groups that still hold sets of
different components, and there only pairs of different components are looked at, again by
histograms first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime_spark.llm.common import chunks, keep, mix64, thrifty, with_arrow, word_hashes
from ontime_spark.llm.links import components

SPACE = b" \t\n\x0b\x0c\r"
RANK_BITS = 22
PAGE_BITS = 12  # the counts travel in pages of so many buckets
BLOCK = 512  # sets of a group that one trie holds
BLOCK_BYTES = 32 << 20
PIVOTS = 8

_WORD = np.ones(256, bool)
_WORD[list(SPACE)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Each text's distinct n-gram hashes, ascending; A-Z are lowered, a short text is one n-gram."""
    for _, data, offsets in chunks(column):
        hashes, begin = word_hashes(_LOWER[data], offsets, _WORD)
        rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for i in range(words):
            rolled = mix64(rolled + np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(rolled)])
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
            if b - a >= words:
                yield np.unique(rolled[a : b - words + 1])
            elif b > a:
                whole = np.full(1, b - a, np.uint64)
                for i in range(a, b):
                    whole = mix64(whole * np.uint64(3) + hashes[i : i + 1])
                yield whole
            else:
                yield np.zeros(0, np.uint64)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - RANK_BITS)).astype(np.int64)


def rank_table(docs: DataFrame, text_col: str, words: int) -> np.ndarray:
    """How many texts hold an n-gram of each of 2**22 hash buckets, over all texts.

    The table orders n-grams, rare ones first. It has a fixed size (4 MB: counts above 128 by their
    logarithm), and any order gives the same links; each task sends its counts in pages, saturated at 255.
    """
    page = 1 << PAGE_BITS

    def count(batches):
        total = np.zeros(1 << RANK_BITS, np.int32)
        for batch in batches:
            for part in shingle_sets(batch.column(0), words):
                np.add.at(total, _bucket(part), 1)
        small = np.minimum(total, 255).astype(np.uint8).reshape(-1, page)
        used = np.flatnonzero(small.any(axis=1))
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array([small[i].tobytes() for i in used], pa.binary())],
                names=["page", "counts"],
            )

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums.setdefault(at, np.zeros(page, np.uint32))[:] += np.frombuffer(blob, np.uint8)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                names=["page", "counts"],
            )

    schema = "page int, counts binary"
    pages = docs.select(F.col(f"`{text_col}`")).mapInArrow(thrifty(count), schema)
    rows = pages.repartition("page").mapInArrow(thrifty(add), schema).collect()
    table = np.zeros((1 << RANK_BITS) // page * page, np.uint32).reshape(-1, page)
    for row in rows:  # a fixed number of pages at most
        table[row["page"]] = np.frombuffer(row["counts"], np.uint32)
    table = table.reshape(-1)
    steep = np.minimum(128 + 6 * np.log2(np.maximum(table, 128) / 128), 255)
    return np.where(table < 128, table, steep).astype(np.uint8)


def least_size(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def least_overlap(a: int, b: int, percent: int) -> int:
    """The smallest intersection of sets of a and b members with 100 * i >= percent * (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


class Trie:
    """Ordered sets in a prefix tree whose nodes are runs of members (each node's span of leaves)."""

    def __init__(self, rows: list[np.ndarray]):
        self.rows = rows
        self.nodes: list[tuple] = []  # leaves lo:hi, members of the run, depth after it, min and max size, children
        # Top down by a stack, so that sets which branch one after another need no deep calls; then bottom up.
        runs, stack = [], [(0, len(rows), 0)]
        while stack:
            lo, hi, depth = stack.pop()
            runs.append((lo, hi, depth, *self._split(lo, hi, depth)))
            stack.extend((a, b, runs[-1][3]) for a, b in runs[-1][4])
        made: dict[tuple[int, int, int], int] = {}
        sizes = np.array([len(r) for r in rows])
        for lo, hi, depth, end, children, leaves in reversed(runs):
            kids = [made[a, b, end] for a, b in children]
            own = sizes[lo:hi]
            made[lo, hi, depth] = len(self.nodes)
            self.nodes.append((lo, hi, rows[lo][depth:end], end, int(own.min()), int(own.max()), kids, leaves))
        self.root = made[0, len(rows), 0]

    def _split(self, lo: int, hi: int, depth: int) -> tuple[int, list[tuple[int, int]], tuple[int, int]]:
        """How deep leaves lo:hi, which share their first ``depth`` members, go together; their branches and ends."""
        first, last = self.rows[lo], self.rows[hi - 1]
        most = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:most] != last[depth:most])
        end = depth + int(differ[0]) if len(differ) else most  # rows are sorted: all share what the outer two share
        children = []
        at = lo
        while at < hi and len(self.rows[at]) == end:
            at += 1
        leaves = (lo, at)
        while at < hi:
            member, stop = self.rows[at][end], at + 1
            while stop < hi and self.rows[stop][end] == member:
                stop += 1
            children.append((at, stop))
            at = stop
        return end, children, leaves


def link_sets(sets: list[np.ndarray], percent: int, label: np.ndarray, guest: np.ndarray | None = None):
    """Pairs (i, j) of similar sets, enough to connect what similarity connects; ``label`` is updated.

    Sets with equal labels are linked already. With ``guest`` (0 at home, 1 a guest, 2 both), only pairs
    of a guest and one at home count.
    """
    m = len(sets)
    everything = np.concatenate(sets)
    values, inverse, times = np.unique(everything, return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int32)
    rank[np.argsort(-times, kind="stable")] = np.arange(len(values), dtype=np.int32)
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    rows = [np.sort(r) for r in np.split(rank[inverse.reshape(-1)], cuts)]
    order = sorted(range(m), key=lambda i: rows[i].astype(">i4").tobytes())
    rows = [rows[i] for i in order]
    label = label[order]
    guest = None if guest is None else guest[order]
    found: list[tuple[int, int]] = []

    def join(i: int, j: int) -> None:
        found.append((order[i], order[j]))
        label[label == label[j]] = label[i]

    def wanted(i: int, j: int) -> bool:
        return label[i] != label[j] and (guest is None or guest[i] != guest[j] or guest[i] == 2)

    def similar(i: int, j: int) -> bool:
        need = least_overlap(len(rows[i]), len(rows[j]), percent)
        if min(len(rows[i]), len(rows[j])) < need:
            return False
        return len(np.intersect1d(rows[i], rows[j], assume_unique=True)) >= need

    for i in range(1, m):  # neighbours in the trie's order are mostly alike
        if wanted(i, i - 1) and similar(i, i - 1):
            join(i, i - 1)
    if m > 2 and len(np.unique(label)) > 1:
        _traverse(Trie(rows), rows, percent, label, guest, wanted, join, len(values))
    return found


def _traverse(trie, rows, percent, label, guest, wanted, join, universe) -> None:
    mask = np.zeros(universe, bool)
    for i, row in enumerate(rows):
        if (label == label[i]).all():
            return
        n, low, high = len(row), least_size(len(row), percent), 100 * len(row) // percent
        mask[row] = True
        stack = [(trie.root, 0)]
        while stack:
            node, overlap = stack.pop()
            lo, hi, run, depth, least, most, kids, leaves = trie.nodes[node]
            if hi <= i + 1 or most < low or least > high or (label[max(lo, i + 1) : hi] == label[i]).all():
                continue
            if len(run):
                overlap += int(np.count_nonzero(mask[run]))
                ahead = n - int(np.searchsorted(row, run[-1], "right"))
                need = least_overlap(n, max(least, low), percent)
                if overlap + min(ahead, most - depth) < need:
                    continue
            for j in range(max(leaves[0], i + 1), leaves[1]):
                if wanted(i, j) and overlap >= least_overlap(n, len(rows[j]), percent):
                    join(i, j)
            stack.extend((kid, overlap) for kid in reversed(kids))
        mask[row] = False


LINK = "u long, v long"


def sketch(part: np.ndarray, log: int = 4) -> bytes:
    """How many hashes begin with each value of their first bits, 2**(log - 1) to 2**log a value; a byte each.

    The hashes are uniform, so that a count of 255 or more does not arise.
    """
    bits = max(0, int(len(part)).bit_length() - log)
    if bits == 0:
        return np.array([len(part)], np.uint8).tobytes()
    where = (part >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(where, minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _tie_partners(tied: np.ndarray, some: np.ndarray, sizes: np.ndarray, labels: np.ndarray, sketches: list, percent: int) -> None:
    """Gives one number in ``tied`` to members of ``some`` that can be similar to each other and have other labels.

    The smaller of two counts bounds what two sets share of each value.
    """
    width = min(len(sketches[i]) for i in some)
    order = some[np.argsort(sizes[some], kind="stable")]
    folded = np.stack([sketches[i].reshape(width, -1).sum(axis=1) for i in order]).astype(np.int32)
    sizes, labels = sizes[order], labels[order]
    for i in range(len(order)):
        stop = int(np.searchsorted(sizes, 100 * sizes[i] // percent, "right"))
        if stop <= i + 1:
            continue
        need = -(-percent * (sizes[i] + sizes[i + 1 : stop]) // (100 + percent))
        fits = (np.minimum(folded[i], folded[i + 1 : stop]).sum(axis=1) >= need) & (labels[i + 1 : stop] != labels[i])
        if fits.any():
            old = np.append(tied[order[i + 1 : stop][fits]], tied[order[i]])
            tied[np.isin(tied, old)] = old.min()


def _near_parts(percent: int):
    """A mapper over rows (grp, cid, label, n, sketch), those of a group together, to (grp, cid, label, m).

    A group falls into parts between which no two sets of different labels can be similar; parts of one
    are left out. A part is named by a hash of its members, so that equal parts of several groups are one.
    """

    def close(rows):
        if len(rows) < 2:
            return []
        cids, labels, sizes = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 2))
        if (labels == labels[0]).all():
            return []
        sketches = [np.frombuffer(r[3], np.uint8) for r in rows]
        tied = np.arange(len(rows))
        bands: dict[int, list[int]] = {}
        for i in np.argsort(sizes, kind="stable").tolist():
            bands.setdefault(int(sizes[i]).bit_length(), []).append(i)
        for band, own in bands.items():  # sets of different bands fold to the coarser histogram
            both = own + bands.get(band + 1, [])
            for some in ([own] if len(both) == len(own) else [own, both]):
                if len(some) > 1:
                    _tie_partners(tied, np.array(some), sizes, labels, sketches, percent)
        out = []
        for first in np.unique(tied):
            part = np.flatnonzero(tied == first)
            if len(part) > 1:
                name = hashlib.blake2b(np.sort(cids[part]).tobytes(), digest_size=8).digest()
                grp = int.from_bytes(name, "little", signed=True)
                out += [(grp, int(cids[i]), int(labels[i]), len(part)) for i in part]
        return out

    def apply(batches):
        key, rows = None, []
        for batch in batches:
            found = []
            for grp, *row in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if grp != key:
                    found += close(rows)
                    key, rows = grp, []
                rows.append(row)
            yield _rows(found)
        yield _rows(close(rows))

    def _rows(found):
        names = ["grp", "cid", "label", "m"]
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(4)], names=names)

    return apply


def _link_groups(percent: int):
    """A mapper over rows (grp, block, cid, label, guest, members), those of a group and block together."""

    def close(rows):
        held: dict[int, list] = {}
        for cid, label, guest, members in rows:
            if cid in held:
                held[cid][1] = held[cid][1] if held[cid][1] == guest else 2
            else:
                held[cid] = [label, guest, np.frombuffer(members, np.uint64)]
        if len(held) < 2:
            return []
        ids, (labels, guests, sets) = list(held), zip(*held.values())
        guest = np.array(guests) if any(guests) else None
        return [(ids[i], ids[j]) for i, j in link_sets(list(sets), percent, np.array(labels), guest)]

    def apply(batches):
        key, rows = None, []
        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for grp, block, *row in zip(*columns):
                if (grp, block) != key:
                    out += close(rows)
                    key, rows = (grp, block), []
                rows.append(row)
            yield _links(out)
        yield _links(close(rows))

    def _links(pairs):
        return pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["u", "v"]
        )

    return apply


def _tasks(df: DataFrame) -> int:
    """A number of tasks that isn't cut down by the size of what they read: matching costs time, not bytes."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _run_groups(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    dealt = members.join(sets.select("cid", "members"), "cid").select("grp", "block", "cid", "label", "guest", "members")
    return (
        dealt.repartition(_tasks(dealt), "grp", "block")
        .sortWithinPartitions("grp", "block")
        .mapInArrow(thrifty(_link_groups(percent)), LINK)
        .distinct()
    )


def document_classes(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: int = 5, percent: int = 80,
    more: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, classes, links): documents with their class of equal sets, and links between classes.

    members: (id, n_shingles, digest) and the columns ``more`` per row of ``docs``; classes: (cid, digest, rep) where rep is the
    class's least id; links: (u, v) of class numbers, enough to connect what similarity connects.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), *more)
    ranks = spark.sparkContext.broadcast(rank_table(texts, "text", words))

    def describe():
        def one(column):
            sizes, digests, prefixes, sketches = [], [], [], []
            for part in shingle_sets(column, words):
                n = len(part)
                sizes.append(n)
                digests.append(hashlib.blake2b(part.tobytes(), digest_size=16).digest() if n else None)
                sketches.append(sketch(part) if n else None)
                take = n - least_size(n, percent) + 1 if n else 0
                seldom = ranks.value[_bucket(part)]
                if 0 < take < n:
                    edge = np.partition(seldom, take - 1)[take - 1]
                    part, seldom = part[seldom <= edge], seldom[seldom <= edge]
                prefixes.append(part[np.lexsort((part, seldom))][:take].view(np.int64))
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            return [sizes, digests, sketches, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]

        return one

    fields = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("sketch", T.BinaryType()),
        T.StructField("prefix", T.ArrayType(T.LongType())),
    ]
    # Two passes: what the first writes is small, and the second's prefixes go straight to their classes.
    members = keep(with_arrow(texts, ["text"], fields[:2], lambda: lambda c: describe()(c)[:2], ["id", *more]), "members")
    described = with_arrow(texts, ["text"], fields, describe, ["id"])
    classes = keep(
        described.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("prefix").alias("prefix"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
        [ranks],
    )
    return members, classes.select("cid", "digest", "rep"), _links_between(texts, classes, words, percent)


def _links_between(texts: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    heads = classes.select("cid", "n", F.posexplode("prefix").alias("place", "gram"))
    # Equal lists of classes need to be looked at once: lists are told apart by a sum of hashes and their length.
    # Size and place travel as one number, so that the aggregate's rows stay small.
    both = F.shiftleft(F.col("n"), 31) + F.col("place")
    lists = heads.groupBy("gram").agg(
        F.count(F.lit(1)).alias("m"),
        F.sum("n").alias("size"),
        F.expr("bit_xor(xxhash64(cid))").alias("x"),
        F.min(both).alias("least"),
        F.max(both).alias("most"),
    )
    member = lambda c: F.struct(F.shiftright(c, 31).alias("n"), F.col(c).bitwiseAND((1 << 31) - 1).alias("place"))
    lists = lists.withColumns({"a": member("least"), "b": member("most")})
    # Of a list of two, both sizes and places are known: what comes before and after the shared n-gram bounds
    # the overlap. In longer lists no two sets can be similar if even neighbours in size can't be; three show it.
    least = lambda a, b: F.ceil(percent * (a + b) / (100 + percent))
    within = F.least(F.col("a.place"), F.col("b.place")) + F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))
    middle = F.col("size") - F.col("a.n") - F.col("b.n")
    near = lambda a, b: 100 * a >= percent * b
    possible = (
        F.when(F.col("m") == 2, near(F.col("a.n"), F.col("b.n")) & (within >= least(F.col("a.n"), F.col("b.n"))))
        .when(F.col("m") == 3, near(F.col("a.n"), middle) | near(middle, F.col("b.n")))
        .otherwise(F.col("m") > 3)
    )
    lists = lists.filter(possible).select("gram", "m", "size", F.xxhash64("m", "x").alias("grp"))
    lists = keep(lists, "lists")
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("size") * 8 / BLOCK_BYTES)).cast("int")
    heads, held = _heads_in(classes, lists)
    groups = keep(heads.join(lists, "gram").select("grp", "cid", "m", blocks.alias("blocks")).distinct(), "groups", [held])
    # A group of one block falls into parts of possible partners; larger ones, mostly near copies, keep all.
    single = groups.filter("blocks = 1").withColumn("label", F.col("cid"))
    paired = _with_partners(single, classes.select("cid", "n", "sketch"), percent)
    paired = paired.select("grp", "cid", "m", F.lit(1).alias("blocks"))
    groups = keep(paired.unionByName(groups.filter("blocks > 1")), "paired")
    found, held = _sets_of(texts, classes, groups, words)
    sets = keep(found, "sets", [held])

    home = F.pmod(F.xxhash64("cid", "grp"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    # First each class in its largest group; a few members of a large group visit all its blocks.
    chosen = groups.groupBy("cid").agg(F.max_by(F.struct("grp", "blocks"), F.struct("m", "grp")).alias("g")).select("cid", "g.*")
    pivot = F.pmod(F.xxhash64("cid", "grp", F.lit(7)), F.col("blocks") * BLOCK) < PIVOTS
    first = chosen.select(
        "grp", F.explode(F.when((F.col("blocks") > 1) & pivot, every).otherwise(F.array(home))).alias("block"),
        "cid", F.col("cid").alias("label"), F.lit(0).alias("guest"),
    )
    links = keep(_run_groups(first, sets, percent), "links")

    # Then groups that still hold several components. Who is outside the main one visits all blocks.
    roots = components(links)
    placed = keep(
        groups.join(roots, groups.cid == roots.node, "left").select("grp", "cid", "blocks", F.coalesce("root", "cid").alias("label")),
        "placed",
    )
    sizes = placed.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("c"))
    main = sizes.groupBy("grp").agg(
        F.max_by("label", F.struct("c", "label")).alias("main"), (F.sum("c") - F.max("c")).alias("others")
    )
    main = main.filter("others > 0").select("grp", "main", F.ceil(F.col("others") / BLOCK).cast("int").alias("visits"))
    placed = placed.join(main, "grp")
    # Most members of a group of one block have all that is like them in their own component by now. Histograms
    # of one or two hashes a value are nearly exact, and a twelfth of the sets' size.
    near = _with_partners(placed.filter("blocks = 1"), sets.select("cid", "n", "sketch"), percent)
    whole = near.select("grp", F.lit(0).alias("home"), F.lit(0).alias("visit"), "cid", "label", F.lit(0).alias("guest"))
    placed = placed.filter("blocks > 1")
    stays = placed.select(
        "grp", "cid", "label", F.lit(0).alias("guest"), home.alias("home"),
        F.explode(F.sequence(F.lit(0), F.col("visits") - 1)).alias("visit"),
    )
    goes = placed.filter(F.col("label") != F.col("main")).select(
        "grp", "cid", "label", F.lit(1).alias("guest"), F.explode(every).alias("home"),
        F.pmod(F.xxhash64("cid", F.lit(3)), F.col("visits")).cast("int").alias("visit"),
    )
    second = whole.unionByName(stays).unionByName(goes).select("grp", F.xxhash64("home", "visit").alias("block"), "cid", "label", "guest")
    second = keep(second, "second")
    return links.union(_run_groups(second, sets, percent))


def _with_partners(placed: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The parts (grp, cid, label, m) of the groups in ``placed`` (grp, cid, label) that histograms leave together."""
    sketched = placed.select("grp", "cid", "label").join(sketches, "cid")
    grouped = sketched.select("grp", "cid", "label", "n", "sketch").repartition(_tasks(sketched), "grp").sortWithinPartitions("grp")
    return grouped.mapInArrow(thrifty(_near_parts(percent)), "grp long, cid long, label long, m long").distinct()


def _bit_pages(places: DataFrame, bits: int) -> np.ndarray:
    """A bit map with the places (0 to 2**bits - 1) set, in pages of 4 KB; its size is fixed."""
    pages = places.toDF("p").select(F.floor(F.col("p") / 32768).alias("page"), (F.col("p") % 32768).alias("bit"))
    out = np.zeros((1 << bits) // 8, np.uint8).reshape(-1, 4096)
    for row in pages.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():  # one row a page
        out[row["page"]] = np.frombuffer(row["bits"], np.uint8)
    return out


def _heads_in(classes: DataFrame, lists: DataFrame, bits: int = 26) -> tuple[DataFrame, Broadcast]:
    """(gram, cid) of the prefixes, without most n-grams that are in no list; and the bit map of 8 MB that tells them."""
    held = _bit_pages(lists.select(F.pmod("gram", F.lit(1 << bits))), bits)
    shared = classes.sparkSession.sparkContext.broadcast(held.reshape(-1))

    def apply(batches):
        for batch in batches:
            grams = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            cids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), np.asarray(batch.column(1).value_lengths()))
            p = grams & ((1 << bits) - 1)
            hit = (shared.value[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
            yield pa.RecordBatch.from_arrays([pa.array(grams[hit]), pa.array(cids[hit])], names=["gram", "cid"])

    return classes.select("cid", "prefix").mapInArrow(thrifty(apply), "gram long, cid long"), shared


def _sets_of(texts: DataFrame, classes: DataFrame, groups: DataFrame, words: int) -> tuple[DataFrame, Broadcast]:
    """(cid, members, n, sketch) of the classes in ``groups``, from the texts again; sketch is a fine histogram.

    Beside it the broadcast that reading it needs.

    A bit map of fixed size (1 MB) over the hashes of the wanted ids spares most other texts. Rows of equal
    text that it lets through are one row: each task sends a set once, and the rest meet by digest.
    """
    spark = texts.sparkSession
    wanted = keep(classes.join(groups.select("cid").distinct(), "cid").select("cid", "digest", "rep"), "wanted")
    place = F.pmod(F.xxhash64("rep"), F.lit(1 << 23))
    bits = _bit_pages(wanted.select(place), 23)
    shared = spark.sparkContext.broadcast(bits)

    def apply(batches):
        sent: set[bytes] = set()  # 16 bytes for a text of the task
        for batch in batches:
            p = batch.column(0).to_numpy(zero_copy_only=False)
            page, bit = p // 32768, p % 32768
            hit = np.flatnonzero((shared.value[page, bit // 8] >> (bit % 8).astype(np.uint8)) & 1)
            digests, sets, sizes, fine = [], [], [], []
            for part in shingle_sets(batch.column(1).take(pa.array(hit)), words):
                digest = hashlib.blake2b(part.tobytes(), digest_size=16).digest()
                if len(part) and digest not in sent:
                    sent.add(digest)
                    digests.append(digest)
                    sets.append(part.tobytes())
                    sizes.append(len(part))
                    fine.append(sketch(part, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(sets, pa.binary()), pa.array(sizes, pa.int64()), pa.array(fine, pa.binary())],
                names=["digest", "members", "n", "sketch"],
            )

    hashed = texts.select(F.pmod(F.xxhash64("id"), F.lit(1 << 23)).alias("p"), "text")
    found = hashed.mapInArrow(thrifty(apply), "digest binary, members binary, n long, sketch binary")
    # Dealt by digest first, so that the aggregate and the join share one shuffle and one sort.
    found = found.repartition("digest").groupBy("digest").agg(*[F.first(c).alias(c) for c in ("members", "n", "sketch")])
    return found.join(wanted.select("cid", "digest"), "digest").select("cid", "members", "n", "sketch"), shared


def near_duplicate_rows(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: int = 5, percent: int = 80,
    more: tuple[str, ...] = (),
) -> DataFrame:
    """Rows (id, n_shingles, root, component_id) and the columns ``more``, one per row of ``docs``.

    root numbers the component, also of rows without ids, and is null for a text without words.
    """
    members, classes, links = document_classes(docs, text_col, id_col, words, percent, more)
    roots = components(links)
    named = classes.join(roots, classes.cid == roots.node, "left").select(
        "digest", "rep", F.coalesce("root", "cid").alias("root")
    )
    named = keep(named, "named")
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = keep(named.join(least, "root").select("digest", "root", "component_id"), "named")
    return members.join(named, "digest", "left").drop("digest")


def near_duplicate_groups(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: int = 5, percent: int = 80
) -> DataFrame:
    """Rows (id, n_shingles, component_id), one per row of ``docs``.

    Two texts are linked when 100 * intersection >= percent * union of their sets of word n-grams
    (A-Z lowered, words cut at ASCII white space; a text shorter than an n-gram is one n-gram). The
    component is named by the least id that links reach.

    Null, empty and blank texts have an empty set, link to nothing and are their own component. Rows
    of equal text, also with equal id, share a component. A row with a null id takes part; its
    component is the least other id, or null. Other columns are ignored. An empty table gives no row.
    """
    joined = near_duplicate_rows(docs, text_col, id_col, words, percent)
    return joined.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and more) with one row of each group of near copies: five words, 0.8; the least id.

    Of several with this id a hash of the whole row chooses, always alike; an id comes before none. Different
    texts of one id are different documents. Of texts without words one of each id stays, and all without an id.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # Two hashes tell rows apart without their texts; nulls, which a hash skips, are counted beside.
    marks = {f"__h{k}": F.xxhash64(F.lit(k), *columns, *[c.isNull() for c in columns]) for k in (0, 1)}
    marked = docs.withColumns(marks)
    mark = ["__h0", "__h1"]
    rows = near_duplicate_rows(marked, more=tuple(mark))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", *mark)).alias("first")
    stay = rows.filter("n_shingles > 0").groupBy("root").agg(first)
    wordless = rows.filter("n_shingles = 0 and id is not null").groupBy("id").agg(first)
    stay = stay.select("first.*").union(wordless.select("first.*"))
    blank = rows.filter("n_shingles = 0 and id is null").select(mark)
    named = marked.join(stay.select(mark), mark, "left_semi").dropDuplicates(mark)
    return named.select(docs.columns).union(marked.filter("doc_id is null").join(blank, mark, "left_semi").select(docs.columns))
