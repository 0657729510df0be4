"""The conversation trie, conversation repair and exact dedup: brute force, edges, and their inner structures."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ontime_spark.llm import radix_dedup, repair, zfast_trie

TURNS = "conv_id long, turn long, role string, text string, prefix string, parent long, again int, repeated string"


def turn_rows(rng, conversations, ids=None):
    """Conversations out of few texts, with nulls, ties and repeated rows."""
    rows = []
    for c in ids or range(conversations):
        for t in range(rng.randint(0, 7)):
            turn = rng.choice([t, t, t, 0, None])
            rows += [(c, turn, rng.choice(["user", "assistant", "system", "", None]), rng.choice(["a.", "b", "", None, " "]))] * rng.choice([1, 1, 1, 2])
    return rows


def frame_of(spark, rows, n=3):
    return spark.createDataFrame([(*r, "p", 7, 9, "x") for r in rows], TURNS).repartition(n)


# --- conversation trie ---------------------------------------------------------------------------


def plain_tree(rows):
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest())
    original = {}
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        original.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = original.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + own[h:]
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) > len(n) for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids), len(leaves), saved,
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return Counter(out)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("piece, held", [(2048, 200_000), (2, 200_000), (3, 5)])
def test_tree_against_brute_force(spark, monkeypatch, piece, held):
    """In one piece or many, in one trie or many: the same nodes."""
    rng = random.Random(piece)
    rows = turn_rows(rng, 40, [*range(-12, 28)]) + [(None, 1, "user", "x")]
    rows += [(c, t, "user", "same.") for c in range(100, 130) for t in range(6)]
    monkeypatch.setattr(zfast_trie, "IDS", 4)
    made = zfast_trie.keep(zfast_trie.pieces(zfast_trie.rebuilt_turns(frame_of(spark, rows)), piece), "pieces")
    got = zfast_trie.prefix_tree(made, held).select(COLUMNS).collect()
    assert Counter(map(tuple, got)) == plain_tree(rows)


def test_tree_of_nothing(spark):
    assert zfast_trie.conversation_tree(frame_of(spark, [(1, 1, "user", "x")]).limit(0)).isEmpty()
    only_null = frame_of(spark, [(None, 1, "user", "x")])
    assert zfast_trie.conversation_tree(only_null).isEmpty()
    one = zfast_trie.conversation_tree(frame_of(spark, [(1, None, None, None)])).select(COLUMNS).collect()
    assert Counter(map(tuple, one)) == plain_tree([(1, None, None, None)])


def test_trie_finds_exit_nodes():
    """Every path's place by fat binary search is where comparing with all paths puts it."""
    rng = random.Random(3)
    for _ in range(300):
        trie = zfast_trie.ZFastTrie(zfast_trie.ROOT)
        held = []
        for conv in range(rng.randint(1, 14)):
            path = [zfast_trie.ROOT]
            for _ in range(rng.randint(0, 12)):
                path.append(zfast_trie.chain(path[-1], rng.choice([b"a", b"b"])))
            node, shared = trie.exit_node(path)
            assert shared == max((sum(x == y for x, y in zip(path, other)) - 1 for other in held), default=0)
            assert node.path[: shared + 1] == path[: shared + 1] and node.begin <= shared <= node.end
            trie.insert(path, [0] * len(path), conv, 1, node if shared == node.end else None)
            held.append(path)
        for name, node in trie.handles.items():
            assert node.path[zfast_trie.two_fattest(node.begin, node.end)] == name


def test_two_fattest():
    for low in range(40):
        for high in range(low + 1, 41):
            assert zfast_trie.two_fattest(low, high) == max(range(low + 1, high + 1), key=lambda n: n & -n)


# --- conversation repair -------------------------------------------------------------------------


def plain_repair(rows):
    """Cheapest edits by keeping every string of initials apart; rows are (role, text, repeated)."""
    prefix = re.compile("(s?(ua)*u?)?")

    def take(states, key, value):
        if prefix.fullmatch(key) and (key not in states or value[:2] < states[key][:2]):
            states[key] = value

    def insert(states):
        for _ in range(3):
            for key, (cost, audit, out) in list(states.items()):
                for role in ("user", "assistant"):
                    take(states, key + role[0], (cost + 3, audit + "I", (*out, f"{role}:")))

    states = {"": (0, "", ())}
    insert(states)
    for role, text, repeated in rows:
        new = {}
        body = text.strip(repair.SPACE)
        for key, (cost, audit, out) in states.items():
            take(new, key, (cost + 4, audit + "D", out))
            if body and not repeated:
                more = 0 if body[-1] in ".!?" else 3
                take(new, key + role[:1], (cost + more, audit + "K", (*out, f"{role}:{text}")))
                for other in ("user", "assistant"):
                    take(new, key + other[0], (cost + more + 3, audit + "R", (*out, f"{other}:{text}")))
        states = new
        insert(states)
    cost, audit, out = min((v for k, v in states.items() if re.fullmatch("(s?(ua)+)?", k)), key=lambda v: v[:2])
    return (cost, audit, "\n".join(out)) if rows else (0, "", "")


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "tool", "", "user", "assistant"]
    return [(rng.choice(roles), rng.choice(["x.", "y", "", "z!"]), rng.random() < 0.1) for _ in range(n)]


def run_repair(rows):
    letters, left = [], []
    machine = repair.Repair(lambda letter, piece: (letters.append(letter), piece and left.append("%s:%s" % piece)))
    for i, row in enumerate(rows):
        machine.add(i, *row)
    return machine.finish(), "".join(letters), "\n".join(left)


@pytest.mark.parametrize("settle, prime", [(256, repair.PRIME), (1, repair.PRIME), (2, 3), (256, 1)])
def test_repair_against_enumeration(monkeypatch, settle, prime):
    """Cost, letters and outcome, also when edits settle at once and when every rolling hash collides."""
    monkeypatch.setattr(repair, "SETTLE", settle)
    monkeypatch.setattr(repair, "PRIME", prime)
    rng = random.Random(settle)
    for _ in range(400):
        rows = random_rows(rng, rng.randint(0, 7))
        assert run_repair(rows) == plain_repair(rows)


def test_long_conversations_settle():
    rng = random.Random(8)
    machine = repair.Repair(lambda letter, piece: None)
    for i, row in enumerate(random_rows(rng, 20_000)):
        machine.add(i, *row)
        assert max(e.depth for _, e in machine.states.values()) < 3 * repair.SETTLE


def plain_audit(rows):
    """The audit of ``rows`` (conv_id, turn, role, text) after damage, without Spark."""
    space = repair.SPACE
    word = lambda v: " " if v is None else str(v)
    left = {c: [] for c, *_ in rows}
    for c, turn, role, text in rows:
        kind = zlib.crc32(f"{word(c)}:{word(turn)}".encode()) % 20
        role, text = word(role), word(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        if kind:
            left[c] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for c, own in left.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked, blank, again, cut = set(), [], 0, 0, 0
        for turn, role, text in own:
            repeated = (role, text) in seen
            seen.add((role, text))
            body = text.strip(space)
            blank += not body
            again += bool(body) and repeated
            cut += bool(body) and not repeated and body[-1] not in ".!?"
            marked.append((role, text, repeated))
        known = [t for t, *_ in own if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, text = plain_repair(marked)
        out.append((c, gaps, blank, again, cut, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


def test_audit_against_brute_force(spark):
    rows = turn_rows(random.Random(5), 60) + [(None, 1, "user", "x."), (None, None, "tool", "y?\t")]
    rows += [(500, t, "user" if t % 2 else "system", "same text.") for t in range(200)]
    rows += [(c, 3, "user", "alone.") for c in range(1000, 1040)]  # some of these lose their only row
    got = repair.audit(repair.damage(frame_of(spark, rows))).collect()
    assert Counter(map(tuple, got)) == plain_audit(rows)
    assert any(r["audit"] == "" and r["cost"] == 0 for r in got)
    assert repair.audit(repair.damage(frame_of(spark, rows).limit(0))).isEmpty()


def test_repaired_turns(spark):
    rows = [(1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "tool", "Yes!"), (2, None, "assistant", "Only me"), (3, 1, None, None)]
    got = repair.repaired(repair.plain_turns(frame_of(spark, rows))).orderBy("conv_id", "place").collect()
    assert [tuple(r) for r in got] == [
        (1, 0, "K", "user", "Hi."), (1, 1, "D", None, None), (1, 2, "R", "assistant", "Yes!"),
        (2, 0, "D", None, None), (3, 0, "D", None, None),
    ]


def test_very_long_text(spark):
    rows = [(1, 1, "user", "word " * 200_000 + "?"), (1, 2, "assistant", "So.")]
    got = repair.audit(repair.plain_turns(frame_of(spark, rows))).first()
    assert (got["cost"], got["audit"]) == (0, "KK")


# --- exact dedup ---------------------------------------------------------------------------------

DOCS = "doc_id long, text string, keep_id string, kept int, text_sha256 string, hash long, tag long"


def plain_dedup(rows, largest=True):
    groups = {}
    for i, (doc, text) in enumerate(rows):
        groups.setdefault(text or "", []).append((doc, i))
    out = []
    for text, members in groups.items():
        ids = [d for d, _ in members if d is not None]
        keep = (max if largest else min)(ids) if ids else None
        stays = next(i for d, i in members if d == keep)
        out += [(d, keep, len(members), i == stays, hashlib.sha256(text.encode()).hexdigest()) for d, i in members]
    return Counter(out)


def weak(text, turn):
    """A hash that tells nothing apart in the first round."""
    return F.when(turn == 0, F.lit(0)).otherwise(F.xxhash64(text, turn))


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("budget, content_hash", [(radix_dedup.TRIE_BYTES, F.xxhash64), (20_000, F.xxhash64), (12_000, weak)])
def test_exact_dedup_against_brute_force(spark, budget, content_hash, largest):
    """Also with tries that spill all the time and with content hashes that all collide."""
    rng = random.Random(9)
    texts = ["", None, "a", "ab", "abc", "b", "é", "日本", "\x00", "long " * 5_000, "long " * 4_999 + "lone "]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randint(1, 8))) for _ in range(150)]
    rows = [(rng.choice([None, *range(40)]), rng.choice(texts)) for _ in range(400)] + [(None, "no id")] * 3 + [(7, "twice")] * 2
    rows += [(1000 + i, "hot") for i in range(300)]
    frame = spark.createDataFrame([(*r, "k", 1, "s", 5, 6) for r in rows], DOCS).repartition(4)
    got = radix_dedup.exact_duplicates(frame, largest=largest, budget=budget, content_hash=content_hash)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == plain_dedup(rows, largest)


def test_exact_dedup_of_nothing_and_normalised(spark):
    frame = spark.createDataFrame([(1, "A"), (2, "a"), (3, None)], "doc_id long, text string")
    assert radix_dedup.exact_duplicates(frame.limit(0)).isEmpty()
    got = radix_dedup.exact_duplicates(frame, normalise=F.lower("text")).collect()
    assert {(r["doc_id"], r["keep_id"]) for r in got} == {(1, 2), (2, 2), (3, 3)}


def test_radix_trie_holds_what_went_in():
    rng = random.Random(4)
    for budget in (1 << 30, 2_000):
        trie, want, got = radix_dedup.RadixTrie(True, budget), Counter(), Counter()
        for i in range(3_000):
            text = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 9)))
            want[text] += 1
            trie.insert(text, i, 1)
            while trie.full():
                before = trie.root.weight
                for t, _, n, away in trie.spill():
                    assert away
                    got[t] += n
                assert trie.root.weight < before
        done = set()
        for t, _, n, away in trie.texts():
            assert away or t not in got  # what is done has never left in part
            done.add(t)
            got[t] += n
        assert got == want and len(done) == trie.held
        if budget == 1 << 30:
            assert done == set(want)
