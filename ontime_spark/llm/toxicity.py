"""Toxicity by multiple-instance learning: sentence scores joined by noisy-or.

A document is a bag of sentences. Each sentence has a probability of being offensive, from its
hashed words and beginnings of words; the document is toxic if any sentence is: 1 - prod(1 - p). The weights are learnt from
document labels alone by gradient descent, and then locate the sentences that offend.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime_spark.llm.common import chunks, with_arrow, word_hashes

BUCKET_BITS = 18
THRESHOLD = 0.7
HEAD_BYTES = 5

_WORD = np.zeros(256, bool)
_WORD[97:123] = _WORD[65:91] = _WORD[48:58] = _WORD[128:] = True
_END = np.zeros(256, bool)
_END[list(b".!?\n")] = True


def bags(column: pa.Array):
    """For each run of texts: first row, offsets of bytes, buckets of words (and, second half, of their
    beginnings), sentences of words, texts of sentences, and the byte each sentence begins at.

    Sentences end with . ! ? or a line; all have a word."""
    for first, data, offsets in chunks(pc.utf8_lower(pc.fill_null(column, ""))):
        hashes, begin, heads = word_hashes(data, offsets, _WORD, HEAD_BYTES)
        buckets = (np.stack([hashes, heads]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(begin))
        inside = _WORD[data] if len(data) else np.zeros(0, bool)
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        starts[edges] |= inside[edges]
        at = np.flatnonzero(starts)
        ends = np.cumsum(_END[data])[at] if len(at) else np.zeros(0, np.int64)
        fresh = np.ones(len(at), bool)
        fresh[1:] = (ends[1:] != ends[:-1]) | (text_of[1:] != text_of[:-1])
        yield first, offsets, buckets, np.cumsum(fresh) - 1, text_of[fresh], at[fresh]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def fit(
    documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray,
    epochs: int = 30, rate: float = 0.3, decay: float = 3e-5, least_documents: int = 5,
    least_z: float = 4.0, seed: int = 5,
) -> Model:
    """Weights by mini-batches with step sizes adapted per weight.

    Only buckets of at least ``least_documents`` documents that toxic ones hold more often than
    others, by a z-score of at least ``least_z``, get a weight.
    A document is (its buckets, the sentence number of each). With s the sentences' sums and
    S the sum of log(1 + exp(s)), the noisy-or is 1 - exp(-S), whose log loss has simple gradients.
    """
    rng = np.random.default_rng(seed)
    weights = np.zeros(1 << BUCKET_BITS)
    seen = np.full(1 << BUCKET_BITS, 1e-8)
    bias, bias_seen = -6.0, 1e-8
    held = np.zeros((2, 1 << BUCKET_BITS))
    for (buckets, _), y in zip(documents, labels):
        held[y, np.unique(buckets)] += 1
    n = np.maximum(np.bincount(labels, minlength=2), 1)
    pooled = held.sum(axis=0) / n.sum()
    spread = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-12) * (1 / n[0] + 1 / n[1]))
    z = (held[1] / n[1] - held[0] / n[0]) / spread
    telling = (held.sum(axis=0) >= least_documents) & (z >= least_z)
    documents = [(b[telling[b]], p[telling[b]], int(p.max(initial=-1)) + 1) for b, p in documents]
    share = labels.mean() if len(labels) else 0.5
    worth = np.where(labels == 1, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3))
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(documents)), max(1, len(documents) // 64)):
            grad: list[np.ndarray] = []
            where: list[np.ndarray] = []
            grad_bias = 0.0
            for i in batch:
                buckets, sentence, sentences = documents[i]
                if sentences == 0:
                    continue
                s = np.bincount(sentence, weights[buckets], minlength=sentences) + bias
                total = np.logaddexp(0, s).sum()
                slope = -np.exp(-total) / max(-np.expm1(-total), 1e-6) if labels[i] == 1 else 1.0
                d = worth[i] * slope / (1 + np.exp(np.minimum(-s, 50)))
                grad.append(d[sentence])
                where.append(buckets)
                grad_bias += d.sum()
            if not grad:
                continue
            at, inverse = np.unique(np.concatenate(where), return_inverse=True)
            g = np.bincount(inverse, np.concatenate(grad)) / len(batch) + decay * weights[at]
            seen[at] += g * g
            weights[at] -= rate * g / np.sqrt(seen[at])
            grad_bias /= len(batch)
            bias_seen += grad_bias * grad_bias
            bias -= 0.1 * rate * grad_bias / np.sqrt(bias_seen)
    return Model(weights.astype(np.float32), float(bias))


def train(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
    label_col: str = "toxic", per_class: int = 1500, seed: int = 13,
) -> Model:
    """A model from document labels: rows of ``labels`` whose label is 0 or 1, joined to texts by id.

    ``per_class`` bounds the sample (about): the labelled ids are drawn by a hash of the id, so many
    of each class, before any text is read. Null labels, ids and texts teach nothing; without any
    labelled text the model holds every sentence unlikely to offend. Extra columns are ignored.
    """
    marked = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y")).filter(
        "y in (0, 1) and id is not null"
    )
    sizes = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = F.when(F.col("y") == 1, per_class / sizes.get(1, 1)).otherwise(per_class / sizes.get(0, 1))
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_003)) / 1_000_003
    chosen = marked.filter(draw < rate).dropDuplicates(["id"])
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # about 2 * per_class rows of two numbers, whatever the size of the tables
    sample = texts.join(F.broadcast(chosen), "id").filter("text is not null").select("text", "y")

    def make():
        def one(column):
            words, parts = [], []
            for _, offsets, buckets, sentence, text_of, _ in bags(column):
                word_text = text_of[sentence]
                cuts = np.searchsorted(word_text, np.arange(len(offsets)))
                for a, b in zip(cuts[:-1], cuts[1:]):
                    words.append(buckets[:, a:b].astype(np.int32).tobytes())
                    place = (sentence[a:b] - (sentence[a] if b > a else 0)).astype(np.int32)
                    parts.append(np.concatenate([place, place]).tobytes())
            return [words, parts]

        return one

    fields = [T.StructField("words", T.BinaryType()), T.StructField("parts", T.BinaryType())]
    rows = with_arrow(sample, ["text"], fields, make, ["y"]).collect()
    order = sorted((bytes(r["words"]), bytes(r["parts"]), r["y"]) for r in rows)
    documents = [(np.frombuffer(w, np.int32), np.frombuffer(p, np.int32)) for w, p, _ in order]
    return fit(documents, np.array([y for _, _, y in order], np.int64))


def score(
    docs: DataFrame, model: Model, text_col: str = "text", keep_columns: list[str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with score (noisy-or of the sentences), predicted, and offending.

    offending lists (position, sentence, probability) of the sentences whose own probability is at
    least a half. Null, empty and wordless texts score 0. Whole texts are read. Equal texts score
    alike. Columns of these three names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values, which any worker can read

    def make():
        m = Model(**shared.value)

        def one(column):
            low = pc.utf8_lower(pc.fill_null(column, ""))
            scores = np.zeros(len(column))
            offending: list[list[dict]] = [[] for _ in range(len(column))]
            for first, offsets, buckets, sentence, text_of, at in bags(column):
                if len(text_of) == 0:
                    continue
                s = np.bincount(sentence, m.weights[buckets].sum(axis=0), minlength=len(text_of)) + m.bias
                total = np.bincount(text_of, np.logaddexp(0, s), minlength=len(offsets) - 1)
                scores[first : first + len(offsets) - 1] = -np.expm1(-total)
                opens = np.searchsorted(text_of, np.arange(len(offsets)))
                read, whole = -1, b""
                for k in np.flatnonzero(s >= 0):
                    row = int(text_of[k])
                    if row != read:  # a text's offending sentences follow each other
                        read, whole = row, low[first + row].as_py().encode()
                    a = int(at[k] - offsets[row])
                    last = k + 1 == opens[row + 1]
                    b = len(whole) if last else int(at[k + 1] - offsets[row])
                    offending[first + row].append(
                        {"position": int(k - opens[row]), "sentence": whole[a:b].decode().strip(), "probability": float(1 / (1 + np.exp(-s[k])))}
                    )
            return [pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), offending]

        return one

    found = T.ArrayType(
        T.StructType([
            T.StructField("position", T.IntegerType()),
            T.StructField("sentence", T.StringType()),
            T.StructField("probability", T.DoubleType()),
        ])
    )
    fields = [
        T.StructField("score", T.DoubleType()),
        T.StructField("predicted", T.IntegerType()),
        T.StructField("offending", found),
    ]
    return with_arrow(docs, [text_col], fields, make, keep_columns)

