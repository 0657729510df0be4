"""Prefix tree of conversations, by z-fast tries.

Turns are told apart by a digest, and a conversation's first d turns by a digest chained over theirs.
Conversations travel as pieces of bounded length, each with the digest at which it begins.

Each task keeps a compacted trie of its pieces. A node stands for a run of turns without a branch; a
dictionary finds it by the digest of its prefix of two-fattest length, the number in the node's span of
lengths that is divisible by the highest power of two. A new piece finds the node where it leaves the
trie in about log2(length) look-ups: the two-fattest length between what is known to match and what may
match is looked up, and halves that span either way. A batch of pieces is located first, then put in,
each starting from the place found. When the trie is full, and at the end, its edges are expanded to one
row per prefix, with counts for the whole subtree. These rows are combined over all tasks by prefix.

Sums over subtrees need no walk either: each node belongs to the smallest conversation in it, and a
conversation adds to all nodes above what it owns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ontime_spark.llm.common import join_by_weight, keep, thrifty

ROOT = bytes(16)
PIECE = 2048  # turns that travel together
HELD_TURNS = 200_000  # digests that a task's tries hold before they are expanded
IDS = 1 << 14  # conversation ids that are written into one text


def chain(before: bytes, token: bytes) -> bytes:
    return hashlib.blake2b(before + token, digest_size=16).digest()


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that is divisible by the highest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class Node:
    """A run of turns after ``begin`` up to ``end``, and how many pieces end exactly there."""

    __slots__ = ("begin", "end", "path", "sizes", "children", "n", "least")

    def __init__(self, begin: int, end: int, path: list[bytes], sizes: list[int]):
        self.begin, self.end = begin, end
        self.path = path  # digests of a piece that runs through the node, from its trie's root on
        self.sizes = sizes
        self.children: dict[bytes, Node] = {}
        self.n = 0
        self.least: int | None = None


class ZFastTrie:
    """Pieces that begin at one digest; lengths count from there."""

    def __init__(self, start: bytes):
        self.root = Node(0, 0, [start], [0])
        self.handles: dict[bytes, Node] = {}

    def _name(self, node: Node) -> bytes:
        return node.path[two_fattest(node.begin, node.end)]

    def exit_node(self, path: list[bytes], start: Node | None = None) -> tuple[Node, int]:
        """Where ``path`` leaves the trie: the deepest node it enters and how many turns they share.

        ``start`` is a node that the path is known to run through to its end.
        """
        node = start or self.root
        low, high = node.end, len(path) - 1
        while low < high:
            at = two_fattest(low, high)
            met = self.handles.get(path[at])
            if met is None:
                high = at - 1
            elif met.end < len(path) and path[met.end] == met.path[met.end]:
                node, low = met, met.end
            else:
                node = met
                break
        else:
            if node.end < len(path) - 1:  # the child's handle may lie beyond what is shared
                child = node.children.get(path[node.end + 1])
                node = child or node
        low, high = node.begin, min(node.end, len(path) - 1)
        while low < high:  # path[low] is shared
            middle = (low + high + 1) // 2
            if path[middle] == node.path[middle]:
                low = middle
            else:
                high = middle - 1
        return node, low

    def insert(self, path: list[bytes], sizes: list[int], conv: int, n: int, near: Node | None = None) -> int:
        """Add ``n`` pieces of one path, the smallest conversation of which is ``conv``; digests held more."""
        node, shared = self.exit_node(path, near)
        grown = 0
        if shared < node.end:
            upper = Node(node.begin, shared, node.path, node.sizes)
            above = self._above(path, node)
            if node.end > node.begin:
                del self.handles[self._name(node)]
            above.children[node.path[node.begin + 1]] = upper
            node.begin = shared
            upper.children[node.path[shared + 1]] = node
            self.handles[self._name(node)] = node
            self.handles[self._name(upper)] = upper
            node = upper
        if shared < len(path) - 1:
            leaf = Node(shared, len(path) - 1, path, sizes)
            node.children[path[shared + 1]] = leaf
            self.handles[self._name(leaf)] = leaf
            grown = len(path)
            node = leaf
        node.n += n
        node.least = conv if node.least is None else min(node.least, conv)
        return grown

    def _above(self, path: list[bytes], node: Node) -> Node:
        """The parent of ``node``, which ``path`` enters: the node that ends where it begins."""
        found, low, high = self.root, 0, node.begin
        while low < high:
            at = two_fattest(low, high)
            met = self.handles.get(path[at])
            if met is None or met.end > high:
                high = at - 1
            else:
                found, low = met, met.end
        return found

    def prefixes(self, depth: int) -> Iterator[tuple]:
        """(prefix, parent, depth, n, least, size) of every prefix; the trie's root counts if it is the whole tree's."""
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(node.children.values())
        for node in reversed(order):  # children before their parents
            for child in node.children.values():
                node.n += child.n
                node.least = child.least if node.least is None else min(node.least, child.least)
            for d in range(node.begin + 1, node.end + 1):
                yield node.path[d], node.path[d - 1], depth + d, node.n, node.least, node.sizes[d]
        if depth == 0 and self.root.n:
            yield self.root.path[0], None, 0, self.root.n, self.root.least, 0


NODES = "prefix binary, parent binary, depth long, n_convs long, conv_id long, size long"
NODE_TYPES = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def _columns(rows: list[tuple], schema: str, types: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in schema.split(", ")]
    )


def _expand(tries: dict) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for (_, depth), trie in tries.items():
        for row in trie.prefixes(depth):
            rows.append(row)
            if len(rows) == 8192:
                yield _columns(rows, NODES, NODE_TYPES)
                rows = []
    yield _columns(rows, NODES, NODE_TYPES)


def _through_tries(held_turns: int):
    """A mapper over pieces (conv_id, begin, depth, tokens, sizes) to the prefixes of its task's tries."""

    def apply(batches):
        tries: dict[tuple[bytes, int], ZFastTrie] = {}
        held = 0
        for batch in batches:
            convs, begins, depths = (batch.column(i).to_pylist() for i in range(3))
            alike: dict[tuple, list] = {}  # equal pieces go in together
            for i in range(batch.num_rows):
                path, sizes = [begins[i]], [0, *batch.column(4)[i].as_py()]
                for token in batch.column(3)[i].as_py():
                    path.append(chain(path[-1], token))
                known = alike.setdefault((begins[i], depths[i], path[-1]), [path, sizes, convs[i], 0])
                known[2], known[3] = min(known[2], convs[i]), known[3] + 1
            # The whole batch finds its places, then goes in.
            located = []
            for (begin, depth, _), (path, sizes, conv, n) in alike.items():
                trie = tries.setdefault((begin, depth), ZFastTrie(begin))
                node, shared = trie.exit_node(path)
                located.append((trie, node if shared == node.end else None, path, sizes, conv, n))
            for trie, near, path, sizes, conv, n in located:
                held += trie.insert(path, sizes, conv, n, near)
            if held > held_turns:
                yield from _expand(tries)
                tries, held = {}, 0
        yield from _expand(tries)

    return apply


PIECES = "conv_id long, begin binary, depth long, before long, tokens array<binary>, sizes array<long>, last boolean, stop binary"


def _cut(piece: int):
    """A mapper over rows (conv_id, token, size), a conversation's together and in order, to pieces.

    ``begin`` and ``stop`` are the digests around a piece, ``depth`` and ``before`` the turns and bytes before it.
    """
    types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.bool_(), pa.binary()]

    def apply(batches):
        out: list[tuple] = []
        conv, open_ = None, None  # begin, depth, before, tokens, sizes, digest so far

        def put(last):
            begin, depth, before, tokens, sizes, stop = open_
            out.append((conv, begin, depth, before, tokens, sizes, last, stop))

        for batch in batches:
            for c, token, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if open_ is None or c != conv:
                    if open_ is not None:
                        put(True)
                    conv, open_ = c, [ROOT, 0, 0, [], [], ROOT]
                if token is None:  # says only that the conversation is there
                    continue
                if len(open_[3]) == piece:
                    put(False)
                    open_ = [open_[5], open_[1] + piece, open_[2] + sum(open_[4]), [], [], open_[5]]
                open_[3].append(token)
                open_[4].append(size)
                open_[5] = chain(open_[5], token)
            if sum(len(o[4]) for o in out) > piece or len(out) > piece:
                yield _columns(out, PIECES, types)
                out = []
        if open_ is not None:
            put(True)
        yield _columns(out, PIECES, types)

    return apply


def rebuilt_turns(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Rows (conv_id, part, place, token, size): conversations that share their family's first turns.

    Conversation c begins with the first h turns of conversation c - c % ``family`` and goes on with its own
    after its first h; h is the crc32 of c's digits modulo ``most``. Each conversation also has a row
    without token. Turns are ordered by number, nulls first, ties by role and then by their digest.
    """
    c = F.col("conv_id").cast("long")
    role, text = (F.coalesce(F.col(n).cast("string"), F.lit("")) for n in ("role", "text"))
    # The role's length keeps role and text apart.
    token = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.filter(c.isNotNull()).select(
        c.alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        token.alias("token"), F.octet_length(text).cast("long").alias("size"),
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "token"))
    placed = keep(rows.select("conv_id", place.alias("place"), F.unhex("token").alias("token"), "size"), "turns")
    ids = placed.filter("place = 1").select("conv_id")
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    own = placed.filter(F.col("place") > shared).select("conv_id", F.lit(1).alias("part"), "place", "token", "size")
    first = placed.filter((F.col("place") < most) & (F.col("conv_id") % family == 0))
    members = F.explode(F.sequence(F.lit(1 - family), F.lit(family - 1)))
    lent = first.select(F.col("conv_id").alias("head"), members.alias("step"), "place", "token", "size")
    lent = lent.withColumn("conv_id", F.col("head") + F.col("step"))
    lent = lent.filter((F.col("conv_id") - F.col("conv_id") % family == F.col("head")) & (F.col("place") <= shared))
    lent = lent.join(ids, "conv_id", "left_semi").select("conv_id", F.lit(0).alias("part"), "place", "token", "size")
    there = ids.select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("place"), F.lit(None).cast("binary").alias("token"), F.lit(0).cast("long").alias("size"))
    return there.unionByName(lent).unionByName(own)


def pieces(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """Conversations of ``rows`` (conv_id, part, place, token, size) cut into pieces; see :func:`_cut`."""
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return dealt.select("conv_id", "token", "size").mapInArrow(thrifty(_cut(piece)), PIECES)


def _members(ends: DataFrame) -> DataFrame:
    """(prefix, ends_sha256) of the conversations (conv_id) that end at a prefix, their ids ascending.

    Ids are written to texts of bounded length in ranges of (prefix, id), so that a frequent end is one row
    a range where its digest is made.
    """

    def written(batches):
        key, ids, rows = None, [], []

        def put():
            if ids:
                rows.append((key, ids[0], ",".join(map(str, ids))))

        for batch in batches:
            for prefix, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if prefix != key or len(ids) == IDS:
                    put()
                    key, ids = prefix, []
                ids.append(conv)
            yield _columns(rows, "prefix, first, ids", [pa.binary(), pa.int64(), pa.string()])
            rows = []
        put()
        yield _columns(rows, "prefix, first, ids", [pa.binary(), pa.int64(), pa.string()])

    def digested(batches):
        key, digest, rows = None, None, []
        for batch in batches:
            for prefix, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if prefix != key:
                    if key is not None:
                        rows.append((key, digest.hexdigest()))
                    key, digest = prefix, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _columns(rows, "prefix, ends_sha256", [pa.binary(), pa.string()])
            rows = []
        if key is not None:
            rows.append((key, digest.hexdigest()))
        yield _columns(rows, "prefix, ends_sha256", [pa.binary(), pa.string()])

    ranges = ends.repartitionByRange("prefix", "conv_id").sortWithinPartitions("prefix", "conv_id")
    texts = ranges.mapInArrow(thrifty(written), "prefix binary, first long, ids string")
    meet = texts.repartition("prefix").sortWithinPartitions("prefix", "first")
    return meet.select("prefix", "ids").mapInArrow(thrifty(digested), "prefix binary, ends_sha256 string")


def _above_owned(batches):
    """Pieces with their conversation's (owns, leaf, kept) to what they add to each prefix: (prefix, leaves, saved).

    A conversation adds one leaf to all its prefixes if it owns one, and to each prefix above those it owns
    the bytes of the turns from there to the last that it does not own.
    """
    for batch in batches:
        rows = []
        columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
        for begin, depth, before, tokens, sizes, owns, leaf, shared in zip(
            *(columns[n] for n in ("begin", "depth", "before", "tokens", "sizes", "owns", "leaf", "shared"))
        ):
            prefix, total = begin, before
            if depth == 0 and (leaf or owns is None or owns > 0):
                rows.append((prefix, int(leaf), shared if owns is None or owns > 0 else 0))
            for i, (token, size) in enumerate(zip(tokens, sizes), depth + 1):
                prefix = chain(prefix, token)
                above = owns is None or i < owns
                if leaf or above:
                    rows.append((prefix, int(leaf), shared - total if above else 0))
                total += size
        yield _columns(rows, "prefix, leaves, saved", [pa.binary(), pa.int64(), pa.int64()])


def prefix_tree(cut: DataFrame, held_turns: int = HELD_TURNS) -> DataFrame:
    """One row per distinct prefix of the conversations in ``cut`` (pieces, as a kept table).

    Rows (prefix, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256);
    prefix is a digest of 128 bits, by which prefixes are told apart. No conversation gives no row.
    """
    bits = cut.select("conv_id", "begin", "depth", "tokens", "sizes").mapInArrow(thrifty(_through_tries(held_turns)), NODES)
    merged = bits.groupBy("prefix", "depth").agg(
        F.min("parent").alias("parent"), F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("size").alias("size")
    )
    nodes = keep(merged, "prefixes")
    children = keep(nodes.filter("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")), "children")
    leaves = nodes.join(children.withColumnRenamed("parent", "prefix"), "prefix", "left_anti").select("conv_id", F.lit(True).alias("leaf"))
    # A conversation owns the end of its path from some depth on: there it is the smallest. Sizes of what it
    # owns tell, with its whole size, how many bytes it does not own.
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("owns"), F.sum("size").alias("owned"))
    whole = cut.groupBy("conv_id").agg(F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)")).alias("bytes"))
    share = whole.join(owned, "conv_id", "left").join(leaves, "conv_id", "left").select(
        "conv_id", "owns", F.coalesce("leaf", F.lit(False)).alias("leaf"),
        (F.col("bytes") - F.coalesce("owned", F.lit(0))).alias("shared"),
    )
    fields = ["begin", "depth", "before", "tokens", "sizes", "owns", "leaf", "shared"]
    added = cut.join(share, "conv_id").select(*fields).mapInArrow(thrifty(_above_owned), "prefix binary, leaves long, saved long")
    sums = added.groupBy("prefix").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    ends = _members(cut.filter("last").select(F.col("stop").alias("prefix"), "conv_id"))
    # Many nodes may have one parent, so the join to parents is by weight.
    parents = children.join(nodes.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent")
    below = join_by_weight(nodes.filter("parent is not null"), parents.select("parent", "parent_conv_id", F.col("n_children").alias("w")), ["parent"], "w").drop("w")
    top = nodes.filter("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    tree = below.unionByName(top).join(children.withColumnRenamed("parent", "prefix"), "prefix", "left")
    tree = tree.join(sums, "prefix").join(ends, "prefix", "left")
    return tree.select(
        "prefix", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def conversation_tree(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """The prefix tree of ``turns`` (conv_id, turn, role, text), rebuilt by :func:`rebuilt_turns`.

    A node is a distinct sequence of the first turns (role and text) of some conversations, its members.
    Null role or text is empty; rows of null conversation take no part; rows alike are turns of their own.
    Turns are ordered by number, nulls first, ties by role and by a digest of role and text. Other columns
    are ignored. A tree without conversations has no node, not even a root.
    """
    cut = keep(pieces(rebuilt_turns(turns, family, most)), "pieces")
    return prefix_tree(cut)
