"""Problem 7: token ids of every text by a public byte-level BPE vocabulary.

Certain cuts: where two neighbouring bytes are never neighbours inside any token of the vocabulary, no token can span
them, so the text may be cut there and the fragments encoded on their own. The table of such byte pairs is made from the
vocabulary. A cut is taken only where the split into words before the merges comes out the same on both sides: between
characters, not after white space and not before an apostrophe (which may open a contraction).

Cuts of a whole Arrow batch are found on its byte buffer at once, without a loop over the texts; fragments recur
constantly, so their ids are remembered (a bounded memory per Python worker) and put together again by array copies.

Null and empty texts give an empty list. Strings of special tokens are ordinary text. Very long texts need no care: work
is linear in the bytes, and a fragment without a cut is left to the library, whose merge is quasi-linear.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Fragments that a worker remembers, at about so many ids each; beyond it starts anew.
REMEMBERED, LONGEST = 200_000, 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_MAYBE_SPACE_2, _MAYBE_SPACE_3 = np.zeros(256, bool), np.zeros(256, bool)
_MAYBE_SPACE_2[0xC2] = True  # leads the white space of two bytes
_MAYBE_SPACE_3[[0xE1, 0xE2, 0xE3]] = True  # lead the white space of three bytes


class Encoder:
    def __init__(self, vocabulary: str):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.library = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.apart = np.ones(65536, bool)
        for token in ranks:
            if len(token) > 1:
                b = np.frombuffer(token, np.uint8).astype(np.int64)
                self.apart[b[:-1] * 256 + b[1:]] = False
        self.forget()

    def forget(self) -> None:
        """Known fragments: the number of each, and by number where its ids start in `store` and how many they are."""
        self.known: dict[bytes, int] = {}
        self.starts, self.lengths, self.store, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(8192, np.int32), 0

    def cuts(self, b: np.ndarray) -> np.ndarray:
        """Positions i where the bytes may be cut between i - 1 and i."""
        if len(b) < 2:
            return np.zeros(0, np.int64)
        left, right = b[:-1], b[1:]
        free = self.apart[left.astype(np.uint16) * np.uint16(256) + right]
        free &= ((right & 0xC0) != 0x80) & (right != 0x27) & ~_SPACE[left]
        wide = (left & 0xC0) == 0x80
        free[1:] &= ~(wide[1:] & _MAYBE_SPACE_2[b[:-2]])
        free[2:] &= ~(wide[2:] & _MAYBE_SPACE_3[b[:-3]])
        return np.nonzero(free)[0] + 1

    def learn(self, piece: bytes) -> int:
        ids = self.library.encode_to_numpy(piece.decode("utf-8"), disallowed_special=())
        n, end = len(self.known), self.used + len(ids)
        if n == len(self.starts):
            self.starts, self.lengths = np.concatenate([self.starts, np.zeros(n, np.int64)]), np.concatenate([self.lengths, np.zeros(n, np.int64)])
        if end > len(self.store):
            self.store = np.concatenate([self.store, np.zeros(max(end, len(self.store)), np.int32)])
        self.known[piece], self.starts[n], self.lengths[n] = n, self.used, len(ids)
        self.store[self.used : end], self.used = ids, end
        return n

    def batch(self, data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts lie in data between consecutive offsets (offsets[0] = 0). Ids of all texts, and the offsets of each text's ids."""
        if len(self.known) > REMEMBERED or self.used > REMEMBERED * LONGEST:
            self.forget()
        at = np.union1d(self.cuts(np.frombuffer(data, np.uint8)), offsets)
        bounds = at.tolist()
        get, learn = self.known.get, self.learn
        numbers = []
        for a, z in zip(bounds, bounds[1:]):
            n = get(piece := data[a:z])
            numbers.append(learn(piece) if n is None else n)
        which = np.array(numbers, np.int64)
        lengths = self.lengths[which]
        ends = np.zeros(len(at), np.int64)
        np.cumsum(lengths, out=ends[1:])
        ids = self.store[np.repeat(self.starts[which] - ends[:-1], lengths) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(at, offsets)]

    def text(self, text: str) -> list[int]:
        data = text.encode("utf-8")
        return self.batch(data, np.array([0, len(data)]))[0].tolist()


@lru_cache(2)
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def _pieces(batch: pa.RecordBatch, most: int = 2000) -> Iterator[pa.RecordBatch]:
    for lo in range(0, batch.num_rows, most):
        yield batch.slice(lo, most)


def _buffer(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of the texts, and their offsets in it."""
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = texts.buffers()[2]
    data = whole.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes() if whole is not None else b""
    return data, offsets - offsets[0]


def encode(docs: DataFrame, key: str, text: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(key, ids): the token ids of every row; a row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for whole in batches:
            for batch in _pieces(whole):
                ids, ends = own.batch(*_buffer(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))], names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(run, f"{key} {kind}, ids array<int>")


def token_counts(docs: DataFrame, key: str, text: str, *others: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(key, others ..., tokens): the number of tokens of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for whole in batches:
            for batch in _pieces(whole):
                _, ends = own.batch(*_buffer(batch.column(batch.num_columns - 1)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.diff(ends))], names=[key, *others, "tokens"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in (key, *others))
    return docs.select(key, *others, F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(run, f"{kinds}, tokens bigint")
