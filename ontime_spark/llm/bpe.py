"""Byte-level BPE over a sentencepiece model made from a vocabulary of ranks, without training.

Every byte is written as one visible character, every entry of the vocabulary as a piece of such
characters with the negative of its rank as score. sentencepiece's BPE merges the neighbours whose
union scores highest, leftmost first, which is the lowest rank: the same merges. Texts are cut into
pre-tokens by a pattern; each distinct pre-token is encoded once per task and remembered. Decoding
looks every id up in the table of pieces' bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ontime_spark.llm.common import with_arrow

REMEMBERED = 32 << 20  # bytes of pre-tokens and their ids that a task remembers
FIRST_ID = 1  # sentencepiece needs an unknown piece; it comes before the vocabulary


def byte_letters() -> str:
    """A visible character for each byte: printable Latin-1 as itself, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return "".join(chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256))


def read_ranks(lines: str) -> list[bytes]:
    """Entries by rank, from lines of base64 text and rank; the ranks are 0, 1, 2 and so on."""
    pairs = [line.split() for line in lines.splitlines() if line.strip()]
    entries = {int(rank): base64.b64decode(text) for text, rank in pairs}
    if sorted(entries) != list(range(len(entries))):
        raise ValueError("ranks must be 0 to the number of entries less one")
    return [entries[i] for i in range(len(entries))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protocol-buffer field: whole numbers, floats and byte strings."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    return _varint(number << 3) + _varint(value)


def model_bytes(entries: list[bytes]) -> bytes:
    """The vocabulary as a serialised sentencepiece model, BPE without any normalisation."""
    letters = byte_letters()
    unknown = _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)
    pieces = [_field(1, unknown)]
    for rank, entry in enumerate(entries):
        shown = "".join(letters[b] for b in entry).encode()
        pieces.append(_field(1, _field(1, shown) + _field(2, -float(rank)) + _field(3, 1)))
    trainer = _field(3, 2) + _field(4, len(entries) + FIRST_ID) + _field(40, 0)
    trainer += b"".join(_field(n, (1 << 64) - 1) for n in (41, 42, 43))  # no begin, end or padding
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encodes and decodes; ids are the ranks."""

    def __init__(self, entries: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.entries = entries
        self.split = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(entries))
        self.letters = byte_letters()
        self.known: dict[str, str] = {}  # a pre-token's ids, as decimal numbers joined by blanks
        self.held = 0

    def _learn(self, fresh: list[str], at_once: int = 2000) -> None:
        """Encodes many pre-tokens in one call: a line end is in no piece, so nothing merges across it."""
        for k in range(0, len(fresh), at_once):
            part = fresh[k : k + at_once]
            shown = "\n".join([t.encode().decode("latin-1").translate(self.letters) for t in part])
            ids = np.array(self.model.encode(shown, num_threads=1), np.int64)
            ends = np.flatnonzero(ids == 0)
            numbers = [str(i) for i in (ids - FIRST_ID).tolist()]
            for token, a, b in zip(part, [0, *(ends + 1).tolist()], [*ends.tolist(), len(ids)]):
                self.known[token] = " ".join(numbers[a:b])
                self.held += 200 + 2 * len(token) + len(self.known[token])

    def encode_text(self, text: str) -> str:
        """The ids of ``text`` as decimal numbers joined by blanks."""
        tokens = self.split(text)
        if self.held > REMEMBERED:
            self.known.clear()
            self.held = 0
        known = self.known
        fresh = [t for t in dict.fromkeys(tokens) if t not in known]
        if fresh:
            self._learn(fresh)
        return " ".join([known[t] for t in tokens])

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.encode_text(text).split()))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.entries[i] for i in ids])


def encode_decode(
    docs: DataFrame, entries: list[bytes], pattern: str, text_col: str = "text",
    keep_columns: list[str] | None = None, digests_only: bool = False,
) -> DataFrame:
    """``docs`` with ids (the ranks of the text's pieces), n_tokens, decoded (bytes) and two digests.

    ids_sha256 is of the decimal ids joined by blanks, decoded_sha256 of the bytes that the ids decode
    to. Null and empty texts have no ids and decode to nothing. Texts are read whole; characters that
    the pattern matches nowhere are left out, as it says. ``digests_only`` leaves ids and decoded out.
    Columns of these names are replaced. The vocabulary must hold every single byte.
    """
    missing = set(range(256)) - {e[0] for e in entries if len(e) == 1}
    if missing:
        raise ValueError(f"bytes without an entry: {sorted(missing)}")
    shared = docs.sparkSession.sparkContext.broadcast(entries)

    def make():
        codec = Codec(shared.value, pattern)

        def one(column):
            ids, sizes, decoded, id_digests, decoded_digests = [], [], [], [], []
            for value in column:
                numbers = codec.encode_text(value.as_py() or "")
                got = list(map(int, numbers.split()))
                back = codec.decode(got)
                sizes.append(len(got))
                id_digests.append(hashlib.sha256(numbers.encode()).hexdigest())
                decoded_digests.append(hashlib.sha256(back).hexdigest())
                if not digests_only:
                    ids.append(np.array(got, np.int32))
                    decoded.append(back)
            out = [pa.array(sizes, pa.int64()), pa.array(id_digests), pa.array(decoded_digests)]
            return out if digests_only else [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary()), *out]

        return one

    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    whole = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]
    return with_arrow(docs, [text_col], fields if digests_only else whole + fields, make, keep_columns)
