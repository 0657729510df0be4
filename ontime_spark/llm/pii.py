"""Personal data: fixed patterns, and a linear-chain conditional random field that adds spans.

Four kinds have exact patterns: e-mail addresses, IPv4 addresses, payment cards and telephone numbers.
Beside them a conditional random field over the shapes of words, trained from a small labelled table,
finds spans of the same kinds in forms that the patterns don't have. Words without a digit or @ are
outside of any span by the field's definition, so its best labelling splits at them: the runs of
other words are decoded alone, in batches, by Viterbi in numpy.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ontime_spark.llm.common import chunks, with_arrow
from ontime_spark.llm.pii_examples import LINES

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])
K = len(LABELS)

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits matches as a whole or not at all, so no match begins inside one.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_HIT = re.compile(r"[0-9@]")
_WORD = re.compile(r"\S+")
_BEFORE = re.compile(r"[A-Za-z]+\.?[:=]")  # what a number or address is called, written close to it


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from their @: the part before it is the run of its characters."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return out


def accepted(kind: str, found: str) -> bool:
    """The rules beyond the shape: parts of an address up to 255, lengths, the card's check digit."""
    digits = "".join(_DIGIT.findall(found))
    if kind == "ip":
        parts = re.findall(r"[0-9]+", found)
        return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 10 <= len(digits) <= 15
    return True


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns' matches, by start and then kind as listed; code points, end exclusive."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for k, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        if k == 3 and "+" not in text:
            continue
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if accepted(KINDS[k], m[0])]
    return [(a, KINDS[k], b) for a, k, b in sorted(out)]


SHAPE = 40  # characters of a shape, of a whole word, beyond which shapes are alike; no known form has so many


def shape(word: str) -> str:
    """Letters as a or A, digits as 9, runs of one class shortened to two; what is left of odd words is cut."""
    flat = re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"[0-9]", "9", word)))
    flat = re.sub(r"(.)\1+", r"\1\1", re.sub(r"[^\x00-\x7f]", "u", flat))
    return flat if len(flat) <= SHAPE else flat[:SHAPE] + "~"


def _length(word: str) -> str:
    n = len(_DIGIT.findall(word))
    return str(n) if n < 8 else "8-13" if n < 14 else "14-19" if n < 20 else "20+"


def word_features(words: list[str], i: int) -> list[str]:
    """The features of word i: its shape and digits, and its neighbours' shapes."""
    w = words[i]
    before = words[i - 1] if i else "<"
    after = words[i + 1] if i + 1 < len(words) else ">"
    core = w.strip(".,;:!?\"'")
    return [
        f"s={shape(core)}", f"n={_length(core)}", f"s-n={shape(core)}|{_length(core)}",
        f"@={core.find('@') > 0}{core.startswith('@')}", f"dots={min(core.count('.'), 4)}|{_length(core)}",
        f"first={core[:1] if not core[:1].isalnum() else ''}", f"before={shape(before)}", f"after={shape(after)}",
        f"pair={shape(before)}|{shape(core)}", f"next={shape(core)}|{shape(after)}",
    ]


def is_open(word: str) -> bool:
    """Whether a word may be in a span at all."""
    return _HIT.search(word) is not None


@dataclass(frozen=True)
class Field:
    names: dict[str, int]
    emit: np.ndarray  # features by labels
    move: np.ndarray  # from label to label; the outside begins and ends every run


_ALLOWED = np.array(
    [[not b.startswith("I-") or (a != "O" and a[2:] == b[2:]) for b in LABELS] for a in LABELS]
)
_MOVES = np.where(_ALLOWED, 0.0, -1e6)


def _read(line: str) -> tuple[list[str], list[int]]:
    """Words and labels of a marked line."""
    words, labels, inside, begun = [], [], None, False
    for part in re.split(r"(</?[a-z]+>)", line):
        if re.fullmatch(r"<[a-z]+>", part):
            inside, begun = part[1:-1], True
        elif part.startswith("</"):
            inside = None
        else:
            for word in part.split():
                if words and not inside and re.fullmatch(r"[.,;:!?]+", word) and not line.count(" " + word):
                    words[-1] += word
                    continue
                words.append(word)
                labels.append(LABELS.index(f"{'B' if begun else 'I'}-{inside}") if inside else 0)
                begun = False
    return words, labels


def _runs(words: list[str]) -> list[list[int]]:
    """Maximal runs of words that may be in a span."""
    out: list[list[int]] = []
    for i, w in enumerate(words):
        if is_open(w):
            if out and out[-1][-1] == i - 1:
                out[-1].append(i)
            else:
                out.append([i])
    return out


def _forward(scores: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(alpha, beta, log sum) of padded runs (runs, steps, labels) that begin and end outside."""
    s, t, _ = scores.shape
    alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
    alpha[:, 0] = scores[:, 0] + move[0]
    for i in range(1, t):
        alpha[:, i] = scores[:, i] + np.logaddexp.reduce(alpha[:, i - 1, :, None] + move[None], axis=1)
    for i in range(t - 1, -1, -1):
        last = (i == lengths - 1)[:, None]
        if i + 1 < t:
            onward = np.logaddexp.reduce(move[None] + (scores[:, i + 1] + beta[:, i + 1])[:, None, :], axis=2)
            beta[:, i] = np.where(last, move[:, 0][None], onward)
        else:
            beta[:, i] = move[:, 0]
    ends = np.arange(s)
    total = np.logaddexp.reduce(alpha[ends, lengths - 1] + move[:, 0][None], axis=1)
    return alpha, beta, total


def train(lines: list[str] = LINES, steps: int = 200, rate: float = 0.1, ridge: float = 0.02) -> Field:
    """A field from marked lines, by gradient ascent on the likelihood of their labels less a ridge."""
    runs: list[tuple[list[list[str]], list[int]]] = []
    for words, labels in map(_read, lines):
        for run in _runs(words):
            runs.append(([word_features(words, i) for i in run], [labels[i] for i in run]))
    names = {f: k for k, f in enumerate(sorted({f for fs, _ in runs for one in fs for f in one}))}
    steps_most, n = max(len(r[1]) for r in runs), len(runs)
    lengths = np.array([len(r[1]) for r in runs])
    used = np.arange(steps_most)[None] < lengths[:, None]
    at = np.full((n, steps_most, len(word_features(["x"], 0))), len(names))
    gold = np.zeros((n, steps_most), int)
    for k, (fs, labels) in enumerate(runs):
        gold[k, : len(labels)] = labels
        for i, one in enumerate(fs):
            at[k, i] = [names[f] for f in one]
    emit, move = np.zeros((len(names) + 1, K)), np.zeros((K, K))
    m = [np.zeros_like(emit), np.zeros_like(move)]
    v = [np.zeros_like(emit), np.zeros_like(move)]
    true_emit, true_move = np.zeros_like(emit), np.zeros_like(move)
    for k in range(n):
        before = 0
        for i in range(lengths[k]):
            np.add.at(true_emit[:, gold[k, i]], at[k, i], 1)
            true_move[before, gold[k, i]] += 1
            before = gold[k, i]
        true_move[before, 0] += 1
    for step in range(1, steps + 1):
        scores = emit[at].sum(axis=2)
        full = move + _MOVES
        alpha, beta, total = _forward(scores, lengths, full)
        p = np.exp(alpha + beta - total[:, None, None]) * used[:, :, None]
        hope_emit = np.zeros_like(emit)
        for j in range(at.shape[2]):
            np.add.at(hope_emit, at[:, :, j].reshape(-1), p.reshape(-1, K))
        hope_move = np.zeros_like(move)
        for i in range(1, steps_most):
            pair = alpha[:, i - 1, :, None] + full[None] + (scores[:, i] + beta[:, i])[:, None, :] - total[:, None, None]
            hope_move += (np.exp(np.minimum(pair, 0)) * used[:, i, None, None]).sum(axis=0)
        hope_move[0] += p[:, 0].sum(axis=0)
        hope_move[:, 0] += p[np.arange(n), lengths - 1].sum(axis=0)
        for w, g, mm, vv in ((emit, true_emit - hope_emit, m[0], v[0]), (move, true_move - hope_move, m[1], v[1])):
            g = g - ridge * w
            mm += 0.1 * (g - mm)
            vv += 0.01 * (g * g - vv)
            w += rate * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.99**step)) + 1e-8)
        emit[-1] = 0
    return Field(names, emit[:-1], move)


def viterbi(scores: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best labels of padded runs, decoded together; each begins and ends outside."""
    n, t, _ = scores.shape
    back = np.zeros((n, t, K), np.int8)
    best = scores[:, 0] + move[0]
    final = np.where((lengths == 1)[:, None], best, 0)
    for i in range(1, t):
        through = best[:, :, None] + move[None]
        back[:, i] = through.argmax(axis=1)
        best = through.max(axis=1) + scores[:, i]
        final = np.where((lengths == i + 1)[:, None], best, final)
    out = np.zeros((n, t), np.int8)
    rows = np.arange(n)
    label = (final + move[:, 0]).argmax(axis=1)
    for i in range(t - 1, -1, -1):
        inside = i < lengths
        out[inside, i] = label[inside]
        label = np.where(inside & (i > 0), back[rows, i, label], label)
    return out


def field_spans(texts: list[str], field: Field, batch_words: int = 20_000) -> list[list[tuple[int, str, int]]]:
    """(start, kind, end) that the field finds in each text; runs of like length are decoded together."""
    emit = field.emit
    out: list[list[tuple[int, str, int]]] = [[] for _ in texts]
    todo: list[tuple[int, list[tuple[int, int]], np.ndarray]] = []

    def flush() -> None:
        todo.sort(key=lambda r: len(r[1]))
        k = 0
        while k < len(todo):
            most = min(len(todo), k + 512)
            part = todo[k:most]
            while len(part) > 1 and len(part[-1][1]) > 2 * len(part[0][1]) + 4:  # little padding
                part = part[: max(1, len(part) // 2)]
            k += len(part)
            lengths = np.array([len(r[1]) for r in part])
            scores = np.zeros((len(part), lengths.max(), K))
            for j, (_, _, s) in enumerate(part):
                scores[j, : len(s)] = s
            for (text, places, _), labels in zip(part, viterbi(scores, lengths, field.move + _MOVES)):
                _collect(out[text], texts[text], places, labels)
        todo.clear()

    held = 0
    for t, text in enumerate(texts):
        runs = _places(text)
        for places in runs:
            a = text.rfind(" ", 0, max(0, places[0][0] - 1)) + 1
            context = [text[a : places[0][0]].strip() or "<"]
            words = context + [text[x:y] for x, y in places]
            following = _WORD.search(text, places[-1][1])
            words.append(following[0] if following else ">")
            scores = np.zeros((len(places), K))
            for i in range(len(places)):
                scores[i] = emit[[field.names[f] for f in word_features(words, i + 1) if f in field.names]].sum(axis=0)
            todo.append((t, places, scores))
            held += len(places)
            if held >= batch_words:
                flush()
                held = 0
    flush()
    for spans in out:
        spans.sort()
    return out


def _places(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring words with a digit or @, as (start, end)."""
    runs: list[list[tuple[int, int]]] = []
    at = 0
    while hit := _HIT.search(text, at):
        start = hit.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = _WORD.match(text, start).end()
        if runs and text[runs[-1][-1][1] : start].isspace():
            runs[-1].append((start, end))
        else:
            runs.append([(start, end)])
        at = end
    return runs


def _collect(out: list, text: str, places: list[tuple[int, int]], labels: np.ndarray) -> None:
    i = 0
    while i < len(places):
        if labels[i] == 0:
            i += 1
            continue
        kind, j = LABELS[labels[i]][2:], i + 1
        while j < len(places) and LABELS[labels[j]] == f"I-{kind}":
            j += 1
        start, end = places[i][0], places[j - 1][1]
        label = _BEFORE.match(text, start, end)
        start = label.end() if label else start
        while start < end and text[start] in ".,;:!?\"'<[{":
            start += 1
        while end > start and (text[end - 1] in ".,;:!?\"'>]}" or (text[end - 1] == ")" and "(" not in text[start:end])):
            end -= 1
        if text[start : start + 1] == "(" and text.find(")", start, end) < 0:
            start += 1
        found = text[start:end]
        plain = re.fullmatch(r"[+0-9 ()./-]+", found)
        if kind == "email":
            good = 0 < found.find("@") < len(found) - 1 and found.count("@") == 1
        else:
            good = plain is not None and accepted(kind, found)
        if good:
            out.append((start, kind, end))
        i = j


def all_spans(base: list[tuple[int, str, int]], added: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Base spans, and those added ones that overlap none of them."""
    ends = [(a, b) for a, _, b in base]
    fresh = [s for s in added if all(s[2] <= a or b <= s[0] for a, b in ends)] if ends else list(added)
    return sorted([*base, *fresh], key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def redact(text: str, spans: list[tuple[int, str, int]]) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _may_hold(column: pa.Array) -> np.ndarray:
    """Which texts have a digit or @ at all, from their bytes."""
    mark = np.zeros(256, bool)
    mark[[*range(48, 58), 64]] = True
    out = np.zeros(len(column), bool)
    for first, data, offsets in chunks(column):
        at = np.flatnonzero(mark[data])
        out[first : first + len(offsets) - 1] = np.diff(np.searchsorted(at, offsets)) > 0
    return out


SPAN = T.ArrayType(
    T.StructType([
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("base", T.BooleanType()),
    ])
)


def find_personal_data(
    docs: DataFrame, field: Field, text_col: str = "text", keep_columns: list[str] | None = None,
    with_redacted: bool = False,
) -> DataFrame:
    """``docs`` with personal: its spans (kind, start, end, base), and redacted: the text without them.

    Spans are in code points, end exclusive, by start and kind; base says that a fixed pattern found it.
    Null and empty texts have no spans; a null text stays null. Whole texts are read, with work in
    proportion to their length. Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(field))

    def make():
        f = Field(**shared.value)

        def one(column):
            hits = np.flatnonzero(_may_hold(column))
            texts = [column[int(i)].as_py() for i in hits]
            found: list[list[dict]] = [[] for _ in range(len(column))]
            clean: dict[int, str] = {}
            for i, text, added in zip(hits.tolist(), texts, field_spans(texts, f)):
                base = base_spans(text)
                spans = all_spans(base, added)
                known = set(base)
                found[i] = [{"kind": k, "start": a, "end": b, "base": (a, k, b) in known} for a, k, b in spans]
                if spans:
                    clean[i] = redact(text, spans)
            if not with_redacted:
                return [found]
            return [found, [clean.get(i, v.as_py()) for i, v in enumerate(column)]]

        return one

    fields = [T.StructField("personal", SPAN)]
    if with_redacted:
        fields.append(T.StructField("redacted", T.StringType()))
    return with_arrow(docs, [text_col], fields, make, keep_columns)
