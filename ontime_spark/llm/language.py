"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean embedding of its hashed subwords (byte n-grams of the lowered text in which every
run of non-letters is one blank). The embeddings and the softmax over languages are trained together
by stochastic gradient descent in numpy, on a bounded sample of labelled texts. On a part of the
sample that is not trained on, a temperature makes the scores probabilities, and a threshold is set
below which a prediction is rejected. A trained model is one table of a score for each bucket and
language, since a mean of embeddings times the softmax's weights is a mean of such products.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime_spark.llm.common import chunks, with_arrow

ORDERS = (2, 3, 4)
BUCKET_BITS = 16
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = _LETTER[128:] = True
_FACTORS = [np.uint32(x) for x in (2654435761, 2246822519, 3266489917, 668265263)]  # odd, for mixing bytes


def grams(data: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams that begin at each byte, and whether they say anything (have two letters)."""
    letters = np.where(_LETTER[data], data, 32).astype(np.uint32)
    n = max(0, len(data) - order + 1)
    h = np.full(n, order, np.uint32)
    known = np.zeros(n, np.uint8)
    for i in range(order):
        h = (h ^ letters[i : i + n]) * _FACTORS[i]
        h ^= h >> np.uint32(15)
        known += letters[i : i + n] != 32
    return (h >> np.uint32(32 - BUCKET_BITS)).astype(np.int32), known >= min(2, order - 1)


def within(offsets: np.ndarray, order: int, usable: np.ndarray) -> np.ndarray:
    """``usable`` without the n-grams that begin in one text and end in another."""
    usable = usable.copy()
    for back in range(1, order):
        at = offsets[1:] - back
        at = at[(at >= 0) & (at < len(usable))]
        usable[at] = False
    return usable


def has_letter(column: pa.Array) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    got = pc.match_substring_regex(pc.fill_null(column, ""), r"\p{L}")
    return got.to_numpy(zero_copy_only=False).astype(bool)


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column, ""))


def features(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text, the buckets of its subwords and their shares."""
    out = []
    for _, data, offsets in chunks(lowered(column)):
        parts = [(g, within(offsets, k, u)) for k in ORDERS for g, u in [grams(data, k)]]
        for a, b in zip(offsets[:-1], offsets[1:]):
            held = np.concatenate([g[a:b][u[a:b]] for g, u in parts])
            where, times = np.unique(held, return_counts=True)
            out.append((where.astype(np.int32), (times / max(1, times.sum())).astype(np.float32)))
    return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    scores: np.ndarray  # buckets by languages
    bias: np.ndarray
    temperature: float
    threshold: float


def fit_sgd(
    samples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_classes: int,
    dims: int = 8, epochs: int = 8, rate: float = 30.0, seed: int = 7,
) -> tuple[np.ndarray, np.ndarray]:
    """(scores by bucket, bias) after training embeddings and softmax weights together, text by text."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (1 << BUCKET_BITS, dims)).astype(np.float32)
    weights = rng.normal(0, 0.1, (dims, n_classes)).astype(np.float32)
    bias = np.zeros(n_classes, np.float32)
    steps, total = 0, epochs * len(samples)
    for _ in range(epochs):
        for i in rng.permutation(len(samples)):
            where, share = samples[i]
            step = rate * (1 - steps / total)
            steps += 1
            if len(where) == 0:
                continue
            mean = share @ table[where]
            z = mean @ weights + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            table[where] -= (step * share)[:, None] * (weights @ p)[None, :]
            weights -= 0.01 * step * np.outer(mean, p)
            bias -= 0.001 * step * p
    return table @ weights, bias


def calibrate(logits: np.ndarray, labels: np.ndarray, lost: float = 0.002, most: float = 0.5) -> tuple[float, float]:
    """(temperature, threshold): the temperature of least log loss, and the score under which a
    prediction is rejected: at most ``most``, and no more than a share ``lost`` of right ones go."""
    if len(labels) == 0:
        return 1.0, 0.0
    best = (np.inf, 1.0)
    for t in np.geomspace(0.05, 20, 60):
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        log_p = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        best = min(best, (float(-log_p[np.arange(len(labels)), labels].mean()), float(t)))
    z = logits / best[1]
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    right = p.max(axis=1)[p.argmax(axis=1) == labels]
    return best[1], float(min(most, np.quantile(right, lost))) if len(right) else 0.0


def train(
    docs: DataFrame, text_col: str = "text", label_col: str = "lang", key: Column | None = None,
    per_language: int = 400, languages: int = 100, seed: int = 11,
) -> Model:
    """A model of ``docs``; rows without text or label teach nothing.

    ``per_language`` (about) and ``languages`` bound the sample: of each of the most frequent
    languages so many texts, drawn by a hash of ``key``. An empty table gives a model without
    languages, whose predictions are all unknown. Extra columns are ignored.
    """
    known = docs.filter(F.col(f"`{text_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull())
    label = F.col(f"`{label_col}`").cast("string")
    sizes = known.groupBy(label.alias("label")).count().orderBy(F.desc("count"), "label").limit(languages).collect()
    if not sizes:
        return Model([], np.zeros((1 << BUCKET_BITS, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    names = sorted(r["label"] for r in sizes)
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["label"], per_language / r["count"])])
    draw = F.pmod(F.xxhash64(key if key is not None else F.col(f"`{text_col}`"), F.lit(seed)), F.lit(1_000_003)) / 1_000_003
    chosen = known.filter(draw < share[label]).select(F.col(f"`{text_col}`").alias("text"), label.alias("label"))

    def make():
        def one(texts):
            got = features(texts)
            return [[w.tobytes() for w, _ in got], [s.tobytes() for _, s in got]]

        return one

    fields = [T.StructField("buckets", T.BinaryType()), T.StructField("shares", T.BinaryType())]
    rows = with_arrow(chosen, ["text"], fields, make, ["label"]).collect()
    order = sorted((r["label"], bytes(r["buckets"]), bytes(r["shares"])) for r in rows)  # the same on any cluster
    samples = [(np.frombuffer(b, np.int32), np.frombuffer(s, np.float32)) for _, b, s in order]
    labels = np.array([names.index(x) for x, _, _ in order], np.int64)
    apart = np.arange(len(order)) % 4 == 3
    learn = np.flatnonzero(~apart)
    scores, bias = fit_sgd([samples[i] for i in learn], labels[learn], len(names))
    tested = np.array([s @ scores[w] + bias for w, s in (samples[i] for i in np.flatnonzero(apart))], np.float64)
    temperature, threshold = calibrate(tested.reshape(-1, len(names)), labels[apart])
    return Model(names, scores, bias, temperature, threshold)


def logits(model: Model, column: pa.Array) -> np.ndarray:
    """Mean scores of each text's subwords; texts without any get the bias alone."""
    columns = [np.ascontiguousarray(c) for c in model.scores.T]
    out = np.zeros((len(column), len(columns)))
    for first, data, offsets in chunks(lowered(column)):
        rows = len(offsets) - 1
        total, count = np.zeros((rows, len(columns))), np.zeros(rows)
        for order in ORDERS:
            held, usable = grams(data, order)
            at = np.flatnonzero(within(offsets, order, usable))
            edges = np.searchsorted(at, offsets)
            some = np.flatnonzero(edges[1:] > edges[:-1])
            if len(some) == 0:
                continue
            held = held[at]
            for c, column_scores in enumerate(columns):
                total[some, c] += np.add.reduceat(column_scores[held], edges[:-1][some], dtype=np.float64)
            count += np.diff(edges)
        out[first : first + rows] = total / np.maximum(count, 1)[:, None]
    return out + model.bias


def predict(
    docs: DataFrame, model: Model, text_col: str = "text", keep_columns: list[str] | None = None
) -> DataFrame:
    """``docs`` with lang_pred, score (the calibrated probability of lang_pred) and rejected.

    Null, empty and letterless texts are ``und`` with score 0, and rejected; so is every text under
    a model without languages. Whole texts are read, whatever their length. Equal texts get equal
    answers; ties go to the language that sorts first. Columns of these three names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values, which any worker can read

    def make():
        m = Model(**shared.value)
        names = np.array([*m.languages, UNKNOWN], object)

        def one(texts):
            z = logits(m, texts) / m.temperature
            if z.shape[1] == 0:
                best, p = np.zeros(len(z), np.int64), np.zeros(len(z))
                lettered = np.zeros(len(z), bool)
            else:
                z = np.exp(z - z.max(axis=1, keepdims=True))
                best, p = z.argmax(axis=1), z.max(axis=1) / z.sum(axis=1)
                lettered = has_letter(texts)
            score = np.where(lettered, p, 0.0)
            return [
                pa.array(names[np.where(lettered, best, len(m.languages))], pa.string()),
                pa.array(score),
                pa.array(~lettered | (score < m.threshold)),
            ]

        return one

    fields = [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
    return with_arrow(docs, [text_col], fields, make, keep_columns)
