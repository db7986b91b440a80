"""Best-fit packing with a swap-based local search.

Texts are cut into pieces of at most `capacity` tokens. Full pieces are sequences of
their own. The others are dealt, by row number, to groups of about GROUP pieces; a group
is packed best-fit decreasing and then improved: documents are moved, exchanged one for
one or two for one between underfull bins as long as that raises the sum of squared
fills, until bins run empty. A group can be at most a bin worse for being packed alone,
one bin in tens of thousands of pieces, whatever the size of the corpus.

The pieces are staged before they are dealt, so a lost executor packs the same rows again,
and only their numbers are shuffled, never text or ids.

Defined cases: a NULL or empty text is the piece that holds only the end id; repeated rows
are packed each; extra columns of the input are not carried.
"""

from __future__ import annotations

import gc
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.bpe import memory
from tradewind.llm.common import stage, text_slices
from tradewind.llm.units import text_units

CAPACITY = 1024
END_ID = 2
GROUP = 50_000


class UnitEncoder:
    """Encodes units of text by the vocabulary of a byte-level BPE file of the tokenizers library.

    The merges are run by tiktoken, which takes the vocabulary as ranks and gives the same
    ids in a fifth of the time; the tests hold it against the tokenizers library.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        # The file writes a byte as a printable character: itself where it is one, else in order from U+0100.
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}
        special = {token["content"]: token["id"] for token in content["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in content["model"]["vocab"].items()
                 if token not in special}
        self.encoding = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.special = special
        self.between, self.between_id = next(iter(special.items()))

    def __call__(self, units: list[str]) -> list[bytes]:
        out = [b""] * len(units)
        plain = [i for i, unit in enumerate(units) if not any(token in unit for token in self.special)]
        # Many units in one call, told apart by a special token, which no merge crosses.
        for start in range(0, len(plain), 5000):
            members = plain[start:start + 5000]
            ids = self.encoding.encode_to_numpy(
                self.between.join([units[i] for i in members]), allowed_special="all").astype("<u4")
            cuts = np.flatnonzero(ids == self.between_id)
            data, starts, ends = ids.tobytes(), [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
            for i, a, b in zip(members, starts, ends):
                out[i] = data[4 * a:4 * b]
        for i in set(range(len(units))) - set(plain):
            out[i] = np.array(self.encoding.encode(units[i], allowed_special="all"), "<u4").tobytes()
        return out


@lru_cache(maxsize=1)
def _unit_encoder(path: str, pattern: str) -> UnitEncoder:
    return UnitEncoder(path, pattern)


def token_pieces(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of all texts; the first piece of a long text is the short one."""
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(
        "piece int, start bigint, length bigint, ids_crc32 bigint").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute, known, end = _unit_encoder(path, pattern), memory("pieces", path), np.array([end_id], "<u4").tobytes()
        gc.disable()  # nothing here is cyclic, and the memory is large
        for whole in batches:
            for batch in text_slices(whole):
                texts = [text_units(value or "") for value in batch.column("text").to_pylist()]
                known.fill(texts, compute)
                rows: list[tuple[int, int, int, int, int]] = []
                for i, units in enumerate(texts):
                    ids = b"".join([*map(known.__getitem__, units), end])
                    n, at, piece = len(ids) // 4, 0, 0
                    size = (n - 1) % capacity + 1
                    while at < n:
                        rows.append((i, piece, at, size, zlib.crc32(ids[4 * at:4 * (at + size)])))
                        at, piece, size = at + size, piece + 1, capacity
                which, piece, start, length, crc = zip(*rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array(which, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of positions in `lengths`: best-fit decreasing, then local search."""
    bins: list[list[int]] = []
    free_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    frees = 0  # bit f: a bin with f free tokens is open
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        size = lengths[i]
        fitting = frees >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            b = free_bins[free].pop()
            if not free_bins[free]:
                frees &= ~(1 << free)
            bins[b].append(i)
        else:
            b, free = len(bins), capacity
            bins.append([i])
        if free > size:
            free_bins[free - size].append(b)
            frees |= 1 << (free - size)
    least = -(-sum(lengths) // capacity)
    if len(bins) > least:
        bins = _improve(bins, lengths, capacity, least)
    return bins


def _improve(bins: list[list[int]], lengths: list[int], capacity: int, least: int) -> list[list[int]]:
    """Empty the emptiest bins by moves and exchanges that raise the sum of squared fills."""
    fill = [sum(lengths[i] for i in members) for members in bins]
    order = sorted((b for b in range(len(bins)) if fill[b] < capacity), key=lambda b: (fill[b], b))
    emptied: set[int] = set()
    stuck: set[int] = set()
    while len(bins) - len(emptied) > least:
        donor = next((b for b in order if b not in emptied and b not in stuck), None)
        if donor is None:
            break
        improved = True
        while improved and bins[donor]:
            improved = False
            for target in reversed(order):  # fullest first
                room = capacity - fill[target]
                if target == donor or target in emptied or not room or fill[target] < fill[donor]:
                    continue
                gain = _best_exchange(bins[donor], bins[target], lengths, room)
                if gain is None:
                    continue
                give, take = gain
                bins[donor] = [i for i in bins[donor] if i not in give] + take
                bins[target] = [i for i in bins[target] if i not in take] + give
                moved = sum(lengths[i] for i in give) - sum(lengths[i] for i in take)
                fill[donor] -= moved
                fill[target] += moved
                improved = True
                if not bins[donor]:
                    break
        if bins[donor]:
            stuck.add(donor)
        else:
            emptied.add(donor)
            stuck.clear()
        order = sorted((b for b in order if b not in emptied and fill[b] < capacity), key=lambda b: (fill[b], b))
    return [members for members in bins if members]


def _best_exchange(donor: list[int], target: list[int], lengths: list[int], room: int) -> tuple[list[int], list[int]] | None:
    """What to give and to take so that the target gains most, at most `room`; None if it cannot gain."""
    singles: dict[int, list[int]] = {}
    for i in donor:
        singles.setdefault(lengths[i], [i])
    pairs = dict(singles)
    for x, i in enumerate(donor):
        for j in donor[x + 1:]:
            pairs.setdefault(lengths[i] + lengths[j], [i, j])
    best, out = 0, None
    for size, give in singles.items():  # a move
        if best < size <= room:
            best, out = size, (give, [])
    for j in target:  # one for one, and two for one
        for size, give in pairs.items():
            if best < size - lengths[j] <= room:
                best, out = size - lengths[j], (give, [j])
    for x, i in enumerate(target):  # one for two
        for j in target[x + 1:]:
            for size, give in singles.items():
                if best < size - lengths[i] - lengths[j] <= room:
                    best, out = size - lengths[i] - lengths[j], (give, [i, j])
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Add sequence_id and offset to rows with a `length` of at most `capacity`.

    `pieces` is read twice and its rows are numbered by place, so give a staged table.
    """
    numbered = stage(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-numbered.where(F.col("length") < capacity).count() // group))
    schema = T.StructType([*numbered.schema.fields, T.StructField("_group", T.LongType()),
                           T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def pack_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_row", ignore_index=True)
        lengths = rows["length"].tolist()
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for b, members in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in members:
                sequence[i], offset[i] = b, at
                at += lengths[i]
        return rows.assign(sequence_id=(rows["_group"].to_numpy(np.int64) << 32) + sequence, offset=offset)

    open_pieces = (
        numbered.where(F.col("length") < capacity)
        .withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
        .groupBy("_group").applyInPandas(pack_group, schema)
    )
    full = numbered.where(F.col("length") == capacity).withColumns({
        "_group": F.lit(-1).cast("bigint"), "sequence_id": -1 - F.col("_row"), "offset": F.lit(0).cast("bigint")})
    return open_pieces.unionByName(full).drop("_row", "_group")


def pack_documents(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(token_pieces(docs, path, pattern, capacity), capacity)


def op2_best_fit_packing(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
