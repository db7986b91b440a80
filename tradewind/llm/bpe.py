"""Byte-level BPE encoding and decoding in padded numpy matrices.

The matches of the public pattern are put, by length, into matrices of token ids, one row
a match. In every round each row merges its leftmost pair of minimum rank and closes the
gap; rows without a mergeable pair leave the matrix. Ranks of pairs come from a hashed
table that is probed for a whole column of pairs at once. Matches longer than LONG bytes,
for which a row would be mostly waiting, take the same merges from a heap.

Units of text that repeat within a task are encoded once; the memory of a task holds at
most REMEMBERED of them. There is no shuffle.

Defined cases: a NULL text encodes like an empty one, to no ids; special tokens are
ordinary text; extra columns of the input are kept.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tradewind.llm.common import text_slices
from tradewind.llm.units import text_units

NO_RANK = np.int32(2 ** 31 - 1)
LONG = 256
REMEMBERED = 400_000
# Rows of a matrix at once: bounds its memory.
CELLS = 2_000_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _width(length: int) -> int:
    """Columns of the matrix for a match: exact for short ones, padded by up to a quarter beyond."""
    step = max(1, (1 << length.bit_length()) // 8)
    return length if length <= 32 else -(-length // step) * step


class PairTable:
    """Rank of a pair of ids in an open-addressed table with vectorized probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(len(left) * 2 - 1).bit_length() if len(left) else 4)
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NO_RANK, np.int32)
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at, todo = self._home(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] == -1
            # Of several keys that want one free place, the last written stays.
            self.keys[at[todo[free]]] = keys[todo[free]]
            placed = self.keys[at[todo]] == keys[todo]
            self.ranks[at[todo[placed]]] = rank[todo[placed]]
            todo = todo[~placed]
            at[todo] = (at[todo] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MULTIPLIER) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        out = np.full(len(keys), NO_RANK, np.int32)
        todo = np.arange(len(keys))
        at = self._home(keys[todo])
        while len(todo):
            found = self.keys[at]
            hit = found == keys[todo]
            out[todo[hit]] = self.ranks[at[hit]]
            go_on = ~hit & (found != -1)
            todo, at = todo[go_on], (at[go_on] + 1) & self.mask
        return out.reshape(left.shape)


class ByteBpe:
    """Encoder of the ranks in a `.tiktoken` file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, rank = [], [], []
        for token, r in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
        self.pairs = PairTable(np.array(left, np.int64), np.array(right, np.int64), np.array(rank, np.int32))
        self.rank_of_pair = dict(zip(zip(left, right), rank))
        every = np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)
        self.byte_pairs = self.pairs.look_up(*every).reshape(256, 256)

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of matches of the pattern, each encoded by itself."""
        out: list[list[int]] = [[]] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = [whole]
            elif len(piece) > LONG:
                out[i] = self._encode_long(piece)
            elif piece:
                buckets.setdefault(_width(len(piece)), []).append(i)
        for width, members in buckets.items():
            step = max(1, CELLS // width)
            for start in range(0, len(members), step):
                rows = members[start:start + step]
                for i, ids in zip(rows, self._encode_rows([pieces[i] for i in rows], width)):
                    out[i] = ids
        return out

    def _encode_rows(self, pieces: list[bytes], width: int) -> list[list[int]]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        octets = np.zeros((len(pieces), width), np.uint8)
        filled = np.arange(width) < lengths[:, None]
        octets[filled] = np.frombuffer(b"".join(pieces), np.uint8)
        ids = np.where(filled, self.byte_ids[octets], np.int32(-1))
        ranks = np.where(filled[:, 1:], self.byte_pairs[octets[:, :-1], octets[:, 1:]], NO_RANK)
        out: list[list[int]] = [[]] * len(pieces)
        rows, left = np.arange(len(pieces)), lengths
        while True:
            # Every row of the matrix has merged once a round, so it is a column narrower each time.
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(rows), np.int64)  # leftmost of equal ones
            every = np.arange(len(rows))
            best = ranks[every, at] if ranks.shape[1] else np.full(len(rows), NO_RANK)
            go_on = best != NO_RANK
            if not go_on.all():
                for row, n, values in zip(rows[~go_on].tolist(), left[~go_on].tolist(), ids[~go_on].tolist()):
                    out[row] = values[:n]
                ids, ranks, rows, left, at, best = (x[go_on] for x in (ids, ranks, rows, left, at, best))
                every = np.arange(len(rows))
            if not len(rows):
                return out
            ids[every, at] = best  # a rank is the id of the merged token
            width = ids.shape[1] - 1
            keep = np.ones(ids.shape, bool)
            keep[every, at + 1] = False
            ids, left = ids[keep].reshape(-1, width), left - 1
            keep = np.ones(ranks.shape, bool)
            keep[every, at] = False
            ranks = ranks[keep].reshape(-1, width - 1)
            after = np.flatnonzero(at + 1 < left)
            ranks[after, at[after]] = self.pairs.look_up(best[after], ids[after, at[after] + 1])
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.pairs.look_up(ids[before, at[before] - 1], best[before])

    def _encode_long(self, piece: bytes) -> list[int]:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        following, previous = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(rank, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:]))
                if (rank := self.rank_of_pair.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = following[i] if ids[i] >= 0 else len(ids)
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue  # an entry of a pair that is no more
            ids[i], ids[j], after = rank, -1, following[j]
            following[i] = after
            if after < len(ids):
                previous[after] = i
            for left, right in ((previous[i], i), (i, after)):
                if left >= 0 and right < len(ids):
                    pair = ids[left], ids[right]
                    if (new := self.rank_of_pair.get(pair)) is not None:
                        heapq.heappush(heap, (new, left, *pair))
        return [i for i in ids if i >= 0]

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """Ids of units of text; equal matches of the pattern are encoded once."""
        matches = list(map(self.pattern.findall, units))
        pieces = list({piece for found in matches for piece in found})
        ids = dict(zip(pieces, self.encode_pieces([piece.encode() for piece in pieces])))
        return [[i for piece in found for i in ids[piece]] for found in matches]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


class Memory(dict):
    """What a task remembers of units; emptied when it is full."""

    def fill(self, wanted: Iterable[list[str]], compute) -> None:
        new = list({unit for units in wanted for unit in units if unit not in self})
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list({unit for units in wanted for unit in units})
        self.update(zip(new, compute(new)))


@lru_cache(maxsize=4)
def memory(*purpose: str) -> Memory:
    """One memory for each purpose in a worker process; its tasks follow each other."""
    return Memory()


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the column `ids`, ARRAY<INT>, with the ids of the text."""
    schema = T.StructType([*docs.drop(ids).schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, known = encoder(path, pattern), memory("ids", path, pattern)
        gc.disable()  # nothing here is cyclic, and the memory is large
        for whole in batches:
            for batch in text_slices(whole, column=text):
                units = [text_units(value or "") for value in batch.column(text).to_pylist()]
                known.fill(units, bpe.encode_units)
                values = pa.array([[i for unit in found for i in known[unit]] for found in units], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, ids])

    return docs.drop(ids).mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Add the column `to`, BINARY, with the bytes of the ids; NULL ids give no bytes."""
    schema = T.StructType([*tokens.drop(to).schema.fields, T.StructField(to, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            values = pa.array([bpe.decode(row or ()) for row in batch.column(ids).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, to])

    return tokens.drop(to).mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode, decode, and return only the digests of both, so that no list of ids leaves a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, known = encoder(path, pattern), memory("digests", path, pattern)
        gc.disable()  # nothing here is cyclic, and the memory is large

        def compute(units: list[str]) -> list[tuple[str, int, bytes]]:
            return [(",".join(map(str, ids)), len(ids), bpe.decode(ids)) for ids in bpe.encode_units(units)]

        for whole in batches:
            for batch in text_slices(whole):
                units = [text_units(value or "") for value in batch.column("text").to_pylist()]
                known.fill(units, compute)
                rows = [[known[unit] for unit in found] for found in units]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"),
                    pa.array([sum(n for _, n, _ in row) for row in rows], pa.int64()),
                    pa.array([hashlib.sha256(",".join([ids for ids, _, _ in row]).encode()).hexdigest() for row in rows]),
                    pa.array([hashlib.sha256(b"".join([back for _, _, back in row])).hexdigest() for row in rows]),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(
            "n_tokens bigint, ids_sha256 string, decoded_sha256 string").fields]))


def op10_byte_bpe(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
