"""Repair of conversation structure at least cost, with an audit of the edits.

A conversation's roles should read ``(s?(ua)+)?`` by their initials. Its rows are taken in order by a
dynamic programme over four states (nothing yet, after a system turn, after a user's, after an
assistant's). Each state holds the cheapest edits that lead to it; of equally cheap ones those whose
letters come first in ASCII.

The letters are persistent: an edit is a node linked to the edits before it, so that states share what
they have in common and a step costs one node. A node keeps its ancestors at distances of powers of two
and a rolling hash of the letters up to it. Two sequences are compared by searching their longest common
prefix along these ancestors; a prefix is taken as common only when its letters are, which a walk to the
first shared node shows.

A task streams through its conversations. Edits that all states share are settled: they are put out and
forgotten, so that a conversation of any length needs the memory of its unsettled end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ontime_spark.llm.common import thrifty

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3  # for a truncated row that stays
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {NOTHING: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ACCEPTED = (NOTHING, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
SETTLE = 256  # rows between two attempts to settle edits
PRIME, BASE = (1 << 61) - 1, 1_000_003


class Edit:
    """An edit, linked to those before it."""

    __slots__ = ("letter", "piece", "depth", "hash", "up")

    def __init__(self, before: Edit | None, letter: str = "", piece: tuple[str, str] | None = None):
        self.letter = letter
        self.piece = piece  # role and text that the edit leaves, if any
        if before is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = before.depth + 1
        self.hash = (before.hash * BASE + ord(letter)) % PRIME
        up, far = [before], before
        while len(far.up) >= len(up):  # the ancestor at twice the distance
            far = far.up[len(up) - 1]
            up.append(far)
        self.up = tuple(up)

    def ancestor(self, depth: int) -> Edit:
        node = self
        while node.depth > depth:
            node = node.up[(node.depth - depth).bit_length() - 1]
        return node


def same_letters(a: Edit, b: Edit) -> bool:
    """Whether two sequences of one length are equal, letter by letter as far as they share no node."""
    if a.hash != b.hash:
        return False
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def comes_first(a: Edit, b: Edit, equal: Callable[[Edit, Edit], bool] = same_letters) -> bool:
    """Whether the letters up to ``a`` sort before those up to ``b``: by their longest common prefix."""
    least = min(a.depth, b.depth)
    x, y = a.ancestor(least), b.ancestor(least)
    if equal(x, y):
        return a.depth < b.depth
    # Climb while the sequences differ: x and y end as the first nodes that do.
    for level in range(len(x.up) - 1, -1, -1):
        while level < len(x.up) and not equal(x.up[level], y.up[level]):
            x, y = x.up[level], y.up[level]
    return x.letter < y.letter


class Repair:
    """One conversation's rows in order, and what comes of them.

    ``settled`` is called with every edit, in order: (letter, piece).
    """

    def __init__(self, settled: Callable[[str, tuple[str, str] | None], None]):
        self.settled = settled
        self.states: dict[int, tuple[int, Edit]] = {NOTHING: (0, Edit(None))}
        self.gaps = self.rows = self.distinct = 0
        self.least = self.most = self.role = None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self._insert()

    def _offer(self, states: dict, state: int, cost: int, before: Edit, letter: str, piece) -> bool:
        """Take an edit into a state if it is cheaper than what is there, or as cheap and first."""
        known = states.get(state)
        if known is not None and known[0] < cost:
            return False
        made = Edit(before, letter, piece)
        if known is not None and known[0] == cost and not comes_first(made, known[1]):
            return False
        states[state] = (cost, made)
        return True

    def _insert(self) -> None:
        """Inserted turns, as long as one helps."""
        changed = True
        while changed:
            changed = False
            for state in (NOTHING, SYSTEM, USER, ASSISTANT):
                if state in self.states:
                    cost, before = self.states[state]
                    initial = "a" if state == USER else "u"
                    changed |= self._offer(self.states, NEXT[state][initial], cost + COST[INSERT], before, INSERT, (ROLES[initial], ""))
        # What starts over can't win any more when deleting a system turn (or nothing) brings another state level.
        done = self.states.get(ASSISTANT)
        for state, bound in ((NOTHING, COST[DELETE]), (SYSTEM, 0)):
            if done and state in self.states and self.states[state][0] > done[0] + bound:
                del self.states[state]

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        """The next row; ``repeated`` if the conversation has had its role and text before."""
        self.rows += 1
        if turn is not None:
            self.distinct += turn != self.most
            self.least, self.most = (turn if self.least is None else self.least), turn
        if self.role is not None and self.role[:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.role = role
        body = text.strip(SPACE)
        cut = False
        if not body:
            self.blank += 1
        elif repeated:
            self.duplicate += 1
        elif body[-1] not in ".!?":
            self.truncated += 1
            cut = True
        states: dict[int, tuple[int, Edit]] = {}
        for state, (cost, before) in self.states.items():
            self._offer(states, state, cost + COST[DELETE], before, DELETE, None)
            if not body or repeated:
                continue
            stays = cost + (TRUNCATED if cut else 0)
            kept = NEXT[state].get(role[:1], None) if role else state
            if kept is not None:
                self._offer(states, kept, stays + COST[KEEP], before, KEEP, (role, text))
            initial = "a" if state == USER else "u"
            self._offer(states, NEXT[state][initial], stays + COST[REROLE], before, REROLE, (ROLES[initial], text))
        self.states = states
        self._insert()
        if self.rows % SETTLE == 0:
            self._settle()

    def _put_out(self, last: Edit, after: int) -> None:
        """Settle the edits up to ``last`` that are deeper than ``after``."""
        line = []
        while last.depth > after:
            line.append(last)
            last = last.up[0]
        for edit in reversed(line):
            self.settled(edit.letter, edit.piece)

    def _settle(self) -> None:
        """Put out what all states share, and link what is left anew."""
        ends = [edit for _, edit in self.states.values()]
        depth = min(e.depth for e in ends)
        tops = [e.ancestor(depth) for e in ends]
        if any(t is not tops[0] for t in tops):
            for level in range(max(len(t.up) for t in tops) - 1, -1, -1):
                while level < len(tops[0].up) and any(t.up[level] is not tops[0].up[level] for t in tops):
                    tops = [t.up[level] for t in tops]
            tops = [t.up[0] for t in tops]
        shared = tops[0]
        if shared.depth == 0:
            return
        self._put_out(shared, 0)
        made = {id(shared): Edit(None)}

        def anew(edit: Edit) -> Edit:
            line = []
            while id(edit) not in made:
                line.append(edit)
                edit = edit.up[0]
            new = made[id(edit)]
            for old in reversed(line):
                new = made[id(old)] = Edit(new, old.letter, old.piece)
            return new

        self.states = {state: (cost, anew(edit)) for state, (cost, edit) in self.states.items()}

    def finish(self) -> int:
        """Settle the cheapest edits that end well; their cost."""
        best: tuple[int, Edit] | None = None
        for state in ACCEPTED:
            if state in self.states:
                cost, edit = self.states[state]
                if best is None or cost < best[0] or (cost == best[0] and comes_first(edit, best[1])):
                    best = (cost, edit)
        if self.rows == 0:
            return 0
        if self.least is not None:
            self.gaps = self.most - self.least + 1 - self.distinct
        self._put_out(best[1], 0)
        return best[0]


def _ordered(batches, close) -> Iterator[tuple]:
    """Rows of (conv, turn, role, text, repeated) with None before each new conversation."""
    started, conv = False, None
    for batch in batches:
        columns = [batch.column(i) for i in range(5)]
        for i in range(batch.num_rows):
            c, turn, role, text, repeated = (column[i].as_py() for column in columns)
            if not started or c != conv:
                if started:
                    yield from close()
                started, conv = True, c
                yield conv, None
            yield conv, (turn, role, text, repeated)
    if started:
        yield from close()


AUDIT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
EDITS = "conv_id long, place long, edit string, role string, text string"
ROWS_OUT = 2048


def _audits(batches):
    """One row per conversation: its faults, the cost, the edits' letters and a digest of what they leave."""
    done: list[tuple] = []
    now: dict = {}

    def start(conv):
        letters, digest = bytearray(), hashlib.sha256()
        state = {"conv": conv, "letters": letters, "digest": digest, "some": False}

        def settled(letter, piece):
            letters.extend(letter.encode())
            if piece is not None:
                digest.update(((b"\n" if state["some"] else b"") + f"{piece[0]}:{piece[1]}".encode()))
                state["some"] = True

        state["repair"] = Repair(settled)
        now.update(state=state)

    def close():
        state = now["state"]
        r = state["repair"]
        cost = r.finish()
        done.append((
            state["conv"], r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, cost,
            state["letters"].decode(), state["digest"].hexdigest(),
        ))
        return ()

    def packed():
        rows, done[:] = list(done), []
        names = [f.split()[0] for f in AUDIT.split(", ")]
        types = [pa.int64()] * 7 + [pa.string()] * 2
        columns = zip(*rows) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for conv, row in _ordered(batches, close):
        if row is None:
            start(conv)
        elif row[1] is not None:  # a conversation without rows is announced by a row without role
            now["state"]["repair"].add(*row)
        if len(done) >= ROWS_OUT:
            yield packed()
    yield packed()


def _edits(batches):
    """One row per edit: its place among the conversation's edits, its letter, and the turn it leaves."""
    out: list[tuple] = []
    now: dict = {}

    def start(conv):
        now.update(conv=conv, place=0)

        def settled(letter, piece):
            out.append((now["conv"], now["place"], letter, *(piece or (None, None))))
            now["place"] += 1

        now["repair"] = Repair(settled)

    def packed():
        rows, out[:] = list(out), []
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        columns = zip(*rows) if rows else [[] for _ in types]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in EDITS.split(", ")]
        )

    def close():
        now["repair"].finish()
        return ()

    for conv, row in _ordered(batches, close):
        if row is None:
            start(conv)
        elif row[1] is not None:
            now["repair"].add(*row)
        if len(out) >= ROWS_OUT:
            yield packed()
    yield packed()


def damage(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, again) of ``turns`` after a damage that each row's key decides.

    The crc32 of ``conv_id:turn`` modulo 20 drops a row (0), empties its text (1), takes ``.!?`` out of it
    (2), repeats it beside itself (3) or sets its role to user (4). A null role, text, or part of the key
    is one space. ``again`` is 1 for the repetition. A conversation that has lost a row also has a row
    without role, at the place of the dropped one, so that its id stays known.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")), F.lit(20))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    gone = kind == 0
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.when(~gone, F.col("turn").cast("long")).alias("turn"),
        F.when(~gone, F.when(kind == 4, F.lit("user")).otherwise(blank("role"))).alias("role"),
        F.when(~gone, text).alias("text"),
        F.explode(times).alias("again"),
    )


def in_order(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, again) dealt by conversation, in order, with ``repeated`` added.

    The order is by turn, nulls first, then by role and text, a repetition beside its row. Equal rows are
    found by a window over conversation, role and digest of the text, which divides a long conversation.
    """
    digest = F.md5(F.col("text").cast("binary"))
    earlier = Window.partitionBy("conv_id", "role", digest).orderBy("turn", "again")
    marked = rows.withColumn("repeated", F.row_number().over(earlier) > 1)
    placed = marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", "again")
    return placed.select("conv_id", "turn", "role", "text", "repeated")


def plain_turns(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """Rows (conv_id, turn, role, text, again) of any table of turns, as they are; null role or text is one space."""
    blank: Callable[[str], Column] = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return turns.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        blank(role_col).alias("role"), blank(text_col).alias("text"), F.lit(0).alias("again"),
    )


def audit(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, again): faults, cost, audit, digest.

    A row's first fault counts: blank (no character but white space), duplicate (role and text were there
    before), truncated (its last such character is not ``.``, ``!`` or ``?``). Edits cost: Keep 0, Rerole 3,
    Delete 4, which blank and duplicate rows need, Insert 3; a truncated row that stays costs 3 more. gaps
    counts the turn numbers that are missing between the least and the greatest; illegal the neighbours
    whose initials are not su, ua or au.

    Rows without role are no turns. A conversation without turns has zeros, no edits, and the digest of the
    empty string. A row with an empty role adds no initial and may be kept anywhere. Null conversation ids
    are one conversation, null turns come first. Other columns are ignored; an empty table gives no row.
    """
    return in_order(rows).mapInArrow(thrifty(_audits), AUDIT)


def repaired(rows: DataFrame) -> DataFrame:
    """Every edit of every conversation: (conv_id, place, edit, role, text); a deletion leaves no role and text."""
    return in_order(rows).mapInArrow(thrifty(_edits), EDITS)
