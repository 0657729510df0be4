"""Exact duplicates by compressed radix tries.

Texts are dealt to partitions by their length and a hash of their content, so that equal texts meet. A
partition inserts the whole byte strings into a compressed radix trie: an edge holds the bytes that all
texts below it share, and the node at which a text ends names its owner (the best identifier among the
text's rows) and counts the rows. Equality is thus a matter of the bytes and never of a hash.

The same trie combines each task's rows before the shuffle, so a text with a third of all rows travels
once a task. A trie that outgrows its budget spills: its heaviest subtree leaves as partial rows, and
what later ends below that subtree's place leaves as partial rows, too. Partial rows go through another
round, in more partitions and by another hash, until none is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime_spark.llm.common import join_by_weight, keep, thrifty

TRIE_BYTES = 48 << 20  # what a task's trie may hold before a subtree leaves it
PARTITION_BYTES = 32 << 20  # distinct texts that one partition should meet
NODE_BYTES = 400  # a node's own cost
BATCH_BYTES = 4 << 20


class Node:
    """The bytes from its parent to it, its children by their first byte, and a text's owner if one ends here."""

    __slots__ = ("edge", "children", "ends", "owner", "rows", "weight", "spilled")

    def __init__(self, edge: bytes):
        self.edge = edge
        self.children: dict[int, Node] = {}
        self.ends = False
        self.owner: int | None = None
        self.rows = 0
        self.weight = len(edge) + NODE_BYTES  # of the whole subtree
        self.spilled = False


def shared_length(a: bytes, b: bytes) -> int:
    """How many bytes ``a`` and ``b`` have in common at their beginning."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:  # a[:low] is shared, a[: high + 1] is not
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """A Patricia trie of byte strings whose terminal nodes name owners, with subtrees that can leave it."""

    def __init__(self, largest: bool, budget: int = TRIE_BYTES):
        self.root = Node(b"")
        self.best = max if largest else min
        self.budget = budget
        self.held = 0  # texts in the trie

    def _claim(self, node: Node, owner: int | None, rows: int) -> None:
        known = [i for i in (node.owner, owner) if i is not None]
        node.owner = self.best(known) if known else None
        node.rows += rows
        self.held += not node.ends
        node.ends = True

    def insert(self, text: bytes, owner: int | None, rows: int) -> None:
        """Add ``rows`` rows of ``text`` whose best identifier is ``owner``."""
        path, node, at = [self.root], self.root, 0
        grown = 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = Node(text[at:])
                child.spilled = node.spilled
                node.children[text[at]] = child
                grown += child.weight
                node = child
                break
            edge = child.edge
            if len(edge) > 1 and text[at : at + len(edge)] != edge:
                cut = shared_length(edge, text[at : at + len(edge)])
                upper = Node(edge[:cut])
                upper.spilled = node.spilled
                upper.children[edge[cut]] = child
                upper.weight = child.weight + NODE_BYTES
                child.edge = edge[cut:]
                node.children[text[at]] = upper
                grown += NODE_BYTES
                child = upper
            at += len(child.edge)
            node = child
            path.append(node)
        for seen in path:
            seen.weight += grown
        self._claim(node, owner, rows)

    def _texts(self, node: Node, before: bytes) -> Iterator[tuple[bytes, int | None, int, bool]]:
        stack = [(node, before)]
        while stack:
            top, prefix = stack.pop()
            text = prefix + top.edge
            if top.ends:
                yield text, top.owner, top.rows, top.spilled
            stack.extend((child, text) for child in top.children.values())

    def full(self) -> bool:
        """Whether a subtree should leave; a single text stays, however long."""
        return self.root.weight > self.budget and self.held > 1

    def spill(self) -> Iterator[tuple[bytes, int | None, int, bool]]:
        """Take out a heavy subtree, of at most half of the trie if there is one; its place stays marked."""
        path, node, prefix = [self.root], self.root, b""
        while node.children and (node is self.root or node.weight * 2 > self.root.weight):
            prefix += node.edge
            node = max(node.children.values(), key=lambda n: n.weight)
            path.append(node)
        for text, owner, rows, _ in self._texts(node, prefix):
            self.held -= 1
            yield text, owner, rows, True
        # No sibling shares the first byte of the edge: the mark needs no more of it. A mark weighs nothing,
        # so that every spill makes the trie lighter.
        node.edge, node.children, node.ends, node.owner, node.rows, node.spilled = node.edge[:1], {}, False, None, 0, True
        lost = node.weight
        for seen in path:
            seen.weight -= lost

    def texts(self) -> Iterator[tuple[bytes, int | None, int, bool]]:
        """(text, owner, rows, whether a subtree around it has left) of every text that is held."""
        yield from self._texts(self.root, b"")


PARTIAL = "length long, text binary, owner long, rows long, sha binary"


def _through_trie(largest: bool, budget: int, last: bool):
    """A mapper over rows (text, owner, rows) that meets a task's rows in one trie.

    It gives partial rows with their text. Where ``last``, texts that no subtree took along are done and
    give their digest only.
    """
    names = ["length", "text", "owner", "rows", "sha"]
    types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]

    def batch_of(rows):
        columns = zip(*rows) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def packed(found):
        rows, held = [], 0
        for text, owner, n, spilled in found:
            done = last and not spilled
            rows.append((len(text), None if done else text, owner, n, hashlib.sha256(text).digest() if done else None))
            held += 100 if done else len(text) + 100
            if held > BATCH_BYTES:
                yield batch_of(rows)
                rows, held = [], 0
        yield batch_of(rows)

    def apply(batches):
        trie = RadixTrie(largest, budget)
        for batch in batches:
            text, owner, rows = (batch.column(i) for i in range(3))
            for i in range(len(text)):
                trie.insert(text[i].as_py(), owner[i].as_py(), rows[i].as_py())
                while trie.full():
                    yield from packed(trie.spill())
        yield from packed(trie.texts())

    return apply


def owners(docs: DataFrame, total: int, largest: bool = True, budget: int = TRIE_BYTES, content_hash=F.xxhash64) -> DataFrame:
    """(length, sha, owner, rows) of every distinct text of ``docs`` (id long, text binary), of ``total`` bytes.

    ``content_hash(text, round)`` deals texts of one length to partitions.
    """
    spark = docs.sparkSession
    single = docs.select("text", F.col("id").alias("owner"), F.lit(1).cast("long").alias("rows"))
    partial = single.mapInArrow(thrifty(_through_trie(largest, budget, False)), PARTIAL)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PARTITION_BYTES))
    whole, turn = None, 0
    while True:
        dealt = partial.withColumn("hash", content_hash(F.col("text"), F.lit(turn))).repartition(parts << turn, "length", "hash")
        merged = keep(dealt.select("text", "owner", "rows").mapInArrow(thrifty(_through_trie(largest, budget, True)), PARTIAL), "owners")
        done = merged.filter("text is null").select("length", "sha", "owner", "rows")
        whole = done if whole is None else whole.union(done)
        partial = merged.filter("text is not null")
        if partial.isEmpty():
            return whole
        turn += 1


def exact_duplicates(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    largest: bool = True,
    normalise: Column | None = None,
    budget: int = TRIE_BYTES,
    content_hash=F.xxhash64,
) -> DataFrame:
    """Rows (id, keep_id, group_size, kept, text_sha256), one per row of ``docs``, dropped rows too.

    Texts are equal when their UTF-8 bytes are, after ``normalise`` (a column; by default the text as it
    is). Of equal texts the row with the largest id stays (``largest=False``: the smallest).

    A null text is the empty text. A null id ranks behind every other; a group of null ids alone has a null
    keep_id. Of rows that repeat both id and text one stays, any, as they are alike. Other columns are
    ignored, whatever their names. An empty table gives no row.
    """
    text = F.col(f"`{text_col}`") if normalise is None else normalise
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(text.cast("string"), F.lit("")).cast("binary").alias("text"))
    # Rows without their texts; the tables of owners find them by the text's length and digest.
    sha = F.unhex(F.sha2("text", 256))
    rows = plain.select("id", F.octet_length("text").cast("long").alias("length"), sha.alias("sha"), F.monotonically_increasing_id().alias("tag"))
    rows = keep(rows, "rows")
    total = rows.agg(F.sum("length")).first()[0] or 0
    table = owners(plain, total, largest, budget, content_hash)
    named = keep(join_by_weight(rows, table, ["length", "sha"], "rows"), "named")
    # Of rows that are alike in id and text the first stays. Mostly an owner's id is there once.
    same = named.filter(F.col("id").eqNullSafe(F.col("owner")))
    first = same.groupBy("length", "sha").agg(F.min("tag").alias("tag")).select("tag", F.lit(True).alias("kept"))
    return named.join(first, "tag", "left").select(
        F.col("id").alias(id_col),
        F.col("owner").alias("keep_id"),
        F.col("rows").alias("group_size"),
        F.coalesce("kept", F.lit(False)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
