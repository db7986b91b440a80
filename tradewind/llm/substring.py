"""Substring dedup: passages that repeat, also inexactly, across documents.

Seeds are k-mers of words chosen by minimizers: of every WINDOW neighbouring k-mers the
one with the smallest number, so two texts with SEED + WINDOW - 1 words in common share a
seed. Every seed of a document is joined to one owner, the smallest document known to have
it: a star, not the pairs of all that share it. Matches of a document with an owner are
chained: a Fenwick tree finds for every match the best chain it can prolong, with both
positions growing and gaps costing. The gaps of chains and what lies beyond their ends are
aligned word by word with substitutions and gaps; where a gap does not align, the chain is
split. Equal words, not the span, make up the length of a passage. Where seeds that others
have lie close together, every run of MIN_WORDS words is matched as a whole too, so that
equal runs are found whichever documents have their seeds, and also if they are periodic.

Skew: a seed that many documents share is combined within its task first; only the first
row of a task goes to the owner of the seed, the others match that row. So a seed has at
most a row for each CHUNK_WORDS words in the shuffle, however many documents share it.
Words are compared in blocks of BLOCK words, so an owner that many documents match is
looked up in a join that can be split, and is never gathered.

The words of all texts are numbered once, four bytes each, and staged; seeds, blocks and
runs are made from the numbers. Two different words share a number with probability 2^-32.
After the first round of alignments only the documents that are still asked for are kept.

Defined cases: a NULL or empty text, and one of fewer words than a passage has, has no
passages; rows with the same id count as one document, a NULL id as one for each text;
passages within one document are no repeats; extra columns are not used.
"""

from __future__ import annotations

import gc
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import stage, text_slices
from tradewind.llm.shingles import WordTable, mixed, runs, word_numbers

SEED = 8
WINDOW = 8  # as SEED: the k-mers between two texts then keep their windows apart
CHUNK_WORDS = 2_000_000
GAP_COST = 0.1
# A passage to report, in words.
MIN_WORDS = 50
MERGE_GAP = 4
MARGIN = 32
MOST_MARGIN = 8192
FAR = 1 << 30
BLOCK = 32
SIDE = 1 << 28  # above the number of every block: places are 32-bit numbers
SLICE_BYTES = 4_000_000  # of word numbers, taken at once
PIECE_BYTES = 1_000_000  # of them, whose runs are numbered at once
PIECE_CHARACTERS = 1_000_000  # of texts that are Python objects at once
BATCH_ROWS = 50_000  # of what a task returns at once
TEXT_ROWS = 1_000  # whole texts given to a task at once
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_NONE = np.uint64(2 ** 64 - 1)
# Seeds, their documents and positions, and the number of words they were taken from.
Rows = tuple[np.ndarray, np.ndarray, np.ndarray, int]


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc, text); `doc` is the id, or a number of the text where it is NULL."""
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text")).alias("doc"), "text")


def numbered_words(docs: DataFrame, min_words: int = SEED) -> DataFrame:
    """(doc, words): the word numbers of the texts of `min_words` words or more, four bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordTable()
        for whole in batches:
            for batch in text_slices(whole, PIECE_CHARACTERS):
                numbers, lengths = word_numbers(batch.column("text").to_pylist(), known=known)
                data, ends = mixed(numbers).astype("<u4").tobytes(), (4 * np.cumsum(lengths)).tolist()
                words = [data[end - 4 * n:end] for end, n in zip(ends, lengths.tolist())]
                out = pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(words, pa.binary())], ["doc", "words"])
                yield out.filter(pa.array(lengths >= min_words))

    return docs.mapInArrow(run, "doc bigint, words binary")


def _numbers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of `words` in a row, and how many each row has."""
    rows = words.to_pylist()
    return np.frombuffer(b"".join(rows), "<u4"), np.fromiter(map(len, rows), np.int64, len(rows)) // 4


def minimizers(numbers: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seed, text, position) of the minimizers of texts whose word numbers stand in a row."""
    kmers = runs(numbers, SEED)
    if not len(kmers):
        return kmers, np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(lengths)), lengths)
    within = text[:len(kmers)] == text[SEED - 1:]
    kmers = np.where(within, kmers, _NONE)  # SEED - 1 of them between two texts, so no window sees both
    padded = np.concatenate((np.full(WINDOW - 1, _NONE), kmers, np.full(WINDOW - 1, _NONE)))
    least = padded[:len(padded) - WINDOW + 1].copy()
    for step in range(1, WINDOW):
        np.minimum(least, padded[step:len(padded) - WINDOW + 1 + step], out=least)
    chosen = np.zeros(len(kmers), bool)
    for step in range(WINDOW):
        chosen |= least[step:step + len(kmers)] == kmers
    at = np.flatnonzero(chosen & within)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return kmers[at], text[at], at - starts[text[at]]


def _cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A large batch in parts: the JVM holds what it is given at once outside its heap."""
    for start in range(0, batch.num_rows, BATCH_ROWS):
        yield batch.slice(start, BATCH_ROWS)


def _led(words: DataFrame, chosen: Callable[[pa.RecordBatch], Rows]) -> DataFrame:
    """(seed, doc, pos, owner, owner_pos, common) of the rows `chosen` takes from a batch.

    The owner is NULL for the first document of a seed in a chunk; `common` says whether
    the chunk has another one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        taken = 0

        def combined() -> pa.RecordBatch:
            seed, doc, pos = (np.concatenate(column) for column in zip(*held))
            held.clear()
            if not len(seed):
                return pa.RecordBatch.from_pylist([], pa.schema([
                    ("seed", pa.int64()), ("doc", pa.int64()), ("pos", pa.int32()), ("owner", pa.int64()),
                    ("owner_pos", pa.int32()), ("common", pa.bool_())]))
            order = np.lexsort((pos, doc, seed))
            seed, doc, pos = seed[order], doc[order], pos[order]
            first = np.concatenate(([True], seed[1:] != seed[:-1]))
            group = np.cumsum(first) - 1
            leader = np.flatnonzero(first)[group]
            # Repeats within the first document go on as rows of their own.
            own = doc == doc[leader]
            empty = pa.array(own)
            return pa.RecordBatch.from_arrays([
                pa.array(seed.view(np.int64)), pa.array(doc), pa.array(pos.astype(np.int32)),
                pc.if_else(empty, pa.scalar(None, pa.int64()), pa.array(doc[leader])),
                pc.if_else(empty, pa.scalar(None, pa.int32()), pa.array(pos[leader].astype(np.int32))),
                pa.array(np.logical_or.reduceat(~own, np.flatnonzero(first))[group]),
            ], ["seed", "doc", "pos", "owner", "owner_pos", "common"])

        for whole in batches:
            for batch in text_slices(whole, SLICE_BYTES, "words"):
                rows = chosen(batch)
                held.append(rows[:3])
                taken += rows[3]
                if taken > CHUNK_WORDS:
                    yield from _cut(combined())
                    taken = 0
        if held:
            yield from _cut(combined())

    return words.mapInArrow(run, "seed bigint, doc bigint, pos int, owner bigint, owner_pos int, common boolean")


def _whole_keys(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that rows of one key, which are neighbours, are in one batch."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        same = np.ones(held.num_rows, bool)
        for name in key:
            column = held.column(name).to_numpy(zero_copy_only=False)
            same &= column == column[-1]
        start = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if start:
            yield held.slice(0, start)
            held = held.slice(start)
    if held is not None:
        yield held


def _matches(led: DataFrame) -> DataFrame:
    """(doc, pos, owner, owner_pos) of every seed of `led` that several documents have.

    The owner is the smallest known document with the seed, and NULL in its own rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_keys(batches, ["seed"]):
            settled = batch.column("owner").is_valid().to_numpy(zero_copy_only=False)
            if settled.any():
                yield batch.filter(pa.array(settled)).select(["doc", "pos", "owner", "owner_pos"])
            rows = batch.filter(pa.array(~settled))
            if not rows.num_rows:
                continue
            seed, doc, pos = (rows.column(name).to_numpy() for name in ("seed", "doc", "pos"))
            order = np.lexsort((pos, doc, seed))
            seed, doc, pos = seed[order], doc[order], pos[order]
            first = np.concatenate(([True], seed[1:] != seed[:-1]))
            group = np.cumsum(first) - 1
            leader = np.flatnonzero(first)[group]
            own = doc == doc[leader]
            common = rows.column("common").to_numpy(zero_copy_only=False)[order] | ~own
            common = np.logical_or.reduceat(common, np.flatnonzero(first))[group]
            empty = pa.array(own[common])
            yield pa.RecordBatch.from_arrays([
                pa.array(doc[common]), pa.array(pos[common]),
                pc.if_else(empty, pa.scalar(None, pa.int64()), pa.array(doc[leader][common])),
                pc.if_else(empty, pa.scalar(None, pa.int32()), pa.array(pos[leader][common])),
            ], ["doc", "pos", "owner", "owner_pos"])

    place = F.when(F.col("owner").isNotNull(), F.xxhash64("doc", "pos")).otherwise(F.col("seed"))
    # One BIGINT is sorted by its digits; further columns would be compared row by row. NumPy orders the rows of a seed.
    return led.repartition(place).sortWithinPartitions("seed").mapInArrow(
        run, "doc bigint, pos int, owner bigint, owner_pos int")


def seed_matches(words: DataFrame) -> DataFrame:
    """The matches of the minimizers of the texts."""

    def chosen(batch: pa.RecordBatch) -> Rows:
        parts, taken = [], 0
        for few in text_slices(batch, PIECE_BYTES, "words"):
            numbers, lengths = _numbers(few.column("words"))
            seed, text, pos = minimizers(numbers.astype(np.uint64), lengths)
            parts.append((seed, few.column("doc").to_numpy()[text], pos))
            taken += len(numbers)
        seed, doc, pos = (np.concatenate(column) for column in zip(*parts))
        return seed, doc, pos, taken

    return _matches(_led(words, chosen))


class Fenwick:
    """Largest value at places below one, with its item."""

    def __init__(self, size: int):
        self.values = [float("-inf")] * (size + 1)
        self.items = [-1] * (size + 1)

    def put(self, place: int, value: float, item: int) -> None:
        place += 1
        while place < len(self.values):
            if value > self.values[place]:
                self.values[place], self.items[place] = value, item
            place += place & -place

    def below(self, place: int) -> tuple[float, int]:
        best, item = float("-inf"), -1
        while place > 0:
            if self.values[place] > best:
                best, item = self.values[place], self.items[place]
            place -= place & -place
        return best, item


def chains(pos: list[int], owner_pos: list[int]) -> list[tuple[int, int, int, int, list[int]]]:
    """(start, end, owner_start, owner_end, members) of the chains of matches, best first; `pos` ascends."""
    n = len(pos)
    step = owner_pos[0] - pos[0]
    if all(b - a == step for a, b in zip(pos, owner_pos)) and all(
            b - a < SEED / GAP_COST / 2 for a, b in zip(pos, pos[1:])):
        return [(pos[0], pos[-1] + SEED, owner_pos[0], owner_pos[-1] + SEED, list(range(n)))]  # one diagonal
    places = sorted(set(owner_pos))
    tree = Fenwick(len(places))
    score, back = [0.0] * n, [-1] * n
    i = 0
    while i < n:
        j = i
        while j < n and pos[j] == pos[i]:  # matches at one position do not prolong each other
            best, item = tree.below(bisect_left(places, owner_pos[j]))
            cost = GAP_COST * (pos[j] + owner_pos[j])
            score[j] = SEED
            if item >= 0 and best - cost > 0:
                # Overlapping seeds add only the words they cover anew.
                score[j] = best - cost + min(SEED, pos[j] - pos[item], owner_pos[j] - owner_pos[item])
                back[j] = item
            j += 1
        for k in range(i, j):
            tree.put(bisect_left(places, owner_pos[k]), score[k] + GAP_COST * (pos[k] + owner_pos[k]), k)
        i = j
    used = [False] * n
    out = []
    for end in sorted(range(n), key=lambda k: (-score[k], k)):
        if used[end]:
            continue
        at, members = end, []
        while True:
            used[at] = True
            members.append(at)
            if back[at] < 0 or used[back[at]]:
                break
            at = back[at]
        out.append((pos[at], pos[end] + SEED, owner_pos[at], owner_pos[end] + SEED, members[::-1]))
    return out


def pieces(pos: list[int], owner_pos: list[int]) -> list[list[int]]:
    """[start, end, owner_start, owner_end] of the runs of equal words that the seeds of a chain make up."""
    out: list[list[int]] = []
    for a, b in zip(pos, owner_pos):
        if out:
            _, end, _, owner_end = out[-1]
            if b - a == owner_end - end and a <= end:
                out[-1][1], out[-1][3] = a + SEED, b + SEED
                continue
            over = max(end - a, owner_end - b, 0)
            a, b = a + over, b + over
            out.append([a, a + SEED - over, b, b + SEED - over])
        else:
            out.append([a, a + SEED, b, b + SEED])
    return out


def regions(doc: np.ndarray, pos: np.ndarray, exact: dict[int, list[tuple[int, int]]], width: int) -> list[tuple[int, int, int]]:
    """(doc, start, end): the places where a run of `width` words may start that another document has too.

    `pos` are the places of the seeds that others have. All `width` words of an equal run lie
    on such seeds, but for WINDOW - 1 at either end. Runs within `exact` are known already.
    """
    order = np.lexsort((pos, doc))
    doc, pos = doc[order], pos[order]
    first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (pos[1:] > pos[:-1] + WINDOW))))
    last = pos[np.concatenate((first[1:], [len(doc)])) - 1]
    wide = last + SEED - pos[first] >= width - 2 * (WINDOW - 1)
    out = []
    for name, start, end in zip(doc[first][wide].tolist(), pos[first][wide].tolist(), last[wide].tolist()):
        parts = [(max(start - WINDOW + 1, 0), end + SEED + WINDOW - width)]
        for a, b in exact.get(name, ()):
            b = b - width + 1
            if a < b:
                parts = [part for low, high in parts for part in ((low, min(high, a)), (max(low, b), high)) if part[0] < part[1]]
        out += [(name, *part) for part in parts if part[0] < part[1]]
    return out


_FOUND = ("doc bigint, chain int, start int, end int, owner bigint, owner_start int, owner_end int, "
          "before int, owner_before int, after int, owner_after int")


def chained(matches: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, chain, start, end, owner, owner_start, owner_end, ...) of the pieces of chains, a chain's in a row.

    `before` and `after`, on both sides, are where its neighbours in the chain end and start.
    Rows without an owner are the `regions` of a document.
    """

    names = ["doc", "chain", "start", "end", "owner", "owner_start", "owner_end", "before", "owner_before", "after", "owner_after"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), *[pa.int32()] * 6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        for batch in _whole_keys(batches, ["doc"]):
            doc, pos = batch.column("doc").to_numpy(), batch.column("pos").to_numpy()
            matched = batch.column("owner").is_valid().to_numpy(zero_copy_only=False)
            owner = pc.fill_null(batch.column("owner"), 0).to_numpy(zero_copy_only=False)
            owner_pos = pc.fill_null(batch.column("owner_pos"), 0).to_numpy(zero_copy_only=False)
            order = np.lexsort((owner_pos, pos, owner, matched, doc))
            doc, pos, matched, owner, owner_pos = (column[order] for column in (doc, pos, matched, owner, owner_pos))
            fresh = np.concatenate(([True], doc[1:] != doc[:-1]))
            # A chain is named by the place of a match among those of its document.
            place = np.arange(len(doc)) - np.maximum.accumulate(np.where(fresh, np.arange(len(doc)), 0))
            first = np.flatnonzero(fresh | np.concatenate(([True], (owner[1:] != owner[:-1]) | (matched[1:] != matched[:-1]))))
            size = np.diff(np.concatenate((first, [len(doc)])))
            # One match with an owner is a chain and a piece.
            at = first[(size == 1) & matched[first]]
            none, far = np.zeros(len(at), np.int32), np.full(len(at), FAR, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(
                (doc[at], place[at], pos[at], pos[at] + SEED, owner[at], owner_pos[at], owner_pos[at] + SEED,
                 none, none, far, far), kinds)], names)
            exact: dict[int, list[tuple[int, int]]] = {}
            if SEED >= min_words:
                for i in at.tolist():
                    exact.setdefault(int(doc[i]), []).append((int(pos[i]), int(pos[i]) + SEED))
            rows: list[tuple] = []
            several = (size > 1) & matched[first]
            for a, n in zip(first[several].tolist(), size[several].tolist()):
                name, chain, with_ = int(doc[a]), int(place[a]), int(owner[a])
                here, there = pos[a:a + n].tolist(), owner_pos[a:a + n].tolist()
                for *_, members in chains(here, there):
                    parts = pieces([here[k] for k in members], [there[k] for k in members])
                    lower = [(0, 0), *[(piece[1], piece[3]) for piece in parts[:-1]]]
                    upper = [*[(piece[0], piece[2]) for piece in parts[1:]], (FAR, FAR)]
                    for piece, below, above in zip(parts, lower, upper):
                        rows.append((name, chain, piece[0], piece[1], with_, piece[2], piece[3], *below, *above))
                        if piece[1] - piece[0] >= min_words:
                            exact.setdefault(name, []).append((piece[0], piece[1]))
                    chain += 1
            rows += [(name, None, start, end, *[None] * 7) for name, start, end in regions(doc, pos, exact, min_words)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names)

    return matches.repartition("doc").sortWithinPartitions("doc").mapInArrow(run, _FOUND).withColumn("piece", F.monotonically_increasing_id())


def _blocks(words: DataFrame) -> DataFrame:
    """(doc, block, words): the numbers of BLOCK words after the other."""
    return words.select(
        "doc", "words", F.explode(F.sequence(F.lit(0), F.floor((F.length("words") - 1) / (4 * BLOCK)).cast("int"))).alias("block"),
    ).select("doc", "block", F.expr(f"substring(words, {4 * BLOCK} * block + 1, {4 * BLOCK})").alias("words"))


STEPS = ((1, 1), (1, 0), (0, 1), (2, 2), (2, 1), (1, 2), (2, 0), (0, 2))  # words passed on either side at a difference


def alignment(a: list[int], b: list[int]) -> tuple[int, int, int]:
    """How far two word lists align from their start, with substitutions and gaps of up to two words; the words that agree.

    A difference is passed if at least three of the next four words agree again.
    """
    i = j = same = 0
    end = 0, 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            i, j, same = i + 1, j + 1, same + 1
            end = i, j, same
            continue
        best = None
        if set(a[i:i + 6]).isdisjoint(b[j:j + 6]):
            break
        for di, dj in STEPS:
            agree = sum(x == y for x, y in zip(a[i + di:i + di + 4], b[j + dj:j + dj + 4]))
            if agree >= 3 and (best is None or agree > best[0]):
                best = agree, di, dj
        if best is None:
            break
        i, j = i + best[1], j + best[2]
    return end


def aligned_edges(numbers: np.ndarray, own: np.ndarray, other: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, ...]:
    """(i, j, same) of `alignment` for many pairs of lists at once.

    `numbers` holds the `own` words of the first pair, its `other` words, and so on. Lists that
    are not `ahead` are aligned from their ends back. What agrees up to the first difference,
    and whether that difference can be passed, is found for all pairs together.
    """
    starts = np.cumsum(own + other) - own - other
    sign = np.where(ahead, 1, -1)
    a0 = np.where(ahead, starts, starts + own - 1)
    b0 = np.where(ahead, starts + own, starts + own + other - 1)
    least = np.minimum(own, other)
    pair = np.repeat(np.arange(len(own)), least)
    step = np.arange(len(pair)) - np.repeat(np.cumsum(least) - least, least)
    differ = numbers[a0[pair] + sign[pair] * step] != numbers[b0[pair] + sign[pair] * step]
    same = least.copy()
    np.minimum.at(same, pair[differ], step[differ])
    i, j = same.copy(), same.copy()
    at = np.flatnonzero(same < least)
    places = same[at, None] + np.arange(6)
    sides = []
    for begin, count, none in ((a0, own, -1), (b0, other, -2)):
        inside = places < count[at, None]
        index = begin[at, None] + sign[at, None] * np.where(inside, places, 0)
        sides.append(np.where(inside, numbers[index].astype(np.int64), none))
    passed = np.zeros(len(at), bool)
    for di, dj in STEPS:
        passed |= (sides[0][:, di:di + 4] == sides[1][:, dj:dj + 4]).sum(1) >= 3
    for k in at[passed].tolist():
        done = int(same[k])
        a = numbers[starts[k]:starts[k] + own[k]].tolist()
        b = numbers[starts[k] + own[k]:starts[k] + own[k] + other[k]].tolist()
        if not ahead[k]:
            a, b = a[::-1], b[::-1]
        x, y, agree = alignment(a[done:], b[done:])
        i[k], j[k], same[k] = done + x, done + y, done + agree
    return i, j, same


def extended(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    return alignment(a.tolist(), b.tolist())[:2]


def _moved(edges: DataFrame, blocks: DataFrame, margin: int) -> DataFrame:
    """(edge, i, j, same, more): how far the words align from the edges on, for at most `margin` words.

    `more` says that the margin ended it. Edges that do not move have no row. What is shuffled for
    a block is kept narrow: `span` holds its side and the words wanted of it, `part` its side and number,
    and the edge, which is odd if the words ahead of it are wanted, stands for its direction.
    """

    def asked(side: int, doc: str, at: str, limit: str) -> DataFrame:
        low = F.when(F.col("ahead"), F.col(at)).otherwise(F.greatest(F.col(at) - margin, F.col(limit)))
        high = F.when(F.col("ahead"), F.least(F.col(at) + margin, F.col(limit))).otherwise(F.col(at))
        ranges = edges.select("edge", F.col(doc).alias("doc"), low.alias("from"), high.alias("to")).select(
            "*", F.explode(F.sequence((F.col("from") / BLOCK).cast("int"), ((F.col("to") - 1) / BLOCK).cast("int"))).alias("block"))
        first = F.greatest(F.col("from") - BLOCK * F.col("block"), F.lit(0))
        count = F.least(F.col("to") - BLOCK * F.col("block"), F.lit(BLOCK)) - first
        return ranges.select("edge", "doc", "block", (side + 2 * (first + BLOCK * count)).alias("span"))

    wanted = asked(0, "doc", "at", "limit").unionByName(asked(1, "owner", "owner_at", "owner_limit"))
    side, span = F.col("span") % 2, F.shiftright("span", 1)
    # Rows with the same id have the same blocks twice.
    got = wanted.join(blocks.hint("merge"), ["doc", "block"]).select(
        "edge", (F.col("block") + SIDE * side).alias("part"),
        F.substring("words", 4 * (span % BLOCK) + 1, 4 * (span / BLOCK).cast("int")).alias("words"))
    kinds = [pa.int64()] + [pa.int32()] * 3 + [pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        for batch in _whole_keys(batches, ["edge"]):
            edge, part = batch.column("edge").to_numpy(), batch.column("part").to_numpy()
            order = np.lexsort((part, edge))
            edge, part = edge[order], part[order]
            once = np.concatenate(([True], (edge[1:] != edge[:-1]) | (part[1:] != part[:-1])))
            edge, side = edge[once], part[once] // SIDE
            numbers, lengths = _numbers(batch.column("words").take(pa.array(order[once])))
            first = np.flatnonzero(np.concatenate(([True], edge[1:] != edge[:-1])))
            ahead = edge[first] % 2 == 1
            counts = [np.add.reduceat(np.where(side == which, lengths, 0), first) for which in (0, 1)]
            i, j, same = aligned_edges(numbers, counts[0], counts[1], ahead)
            # Differences within the last words of the margin can not be judged yet.
            more = ((counts[0] == margin) & (i >= margin - SEED)) | ((counts[1] == margin) & (j >= margin - SEED))
            moved = same > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(column[moved], kind) for column, kind in zip((edge[first], i, j, same, more), kinds)],
                ["edge", "i", "j", "same", "more"])

    return got.repartition("edge").sortWithinPartitions("edge").mapInArrow(
        run, "edge bigint, i int, j int, same int, more boolean")


def _edges(found: DataFrame) -> DataFrame:
    """(edge, ahead, doc, at, limit, owner, owner_at, owner_limit) of both ends of every piece, up to its neighbours in the chain."""
    ends = F.array(
        F.struct((2 * F.col("piece")).alias("edge"), F.lit(False).alias("ahead"), F.col("start").alias("at"), F.col("before").alias("limit"),
                 F.col("owner_start").alias("owner_at"), F.col("owner_before").alias("owner_limit")),
        F.struct((2 * F.col("piece") + 1).alias("edge"), F.lit(True).alias("ahead"), F.col("end").alias("at"), F.col("after").alias("limit"),
                 F.col("owner_end").alias("owner_at"), F.col("owner_after").alias("owner_limit")))
    return found.select("doc", "owner", F.explode(ends).alias("e")).select("doc", "owner", "e.*").where(
        "at != limit AND owner_at != owner_limit")


def aligned(found: DataFrame, words: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """(doc, start, end, owner, owner_start) of what aligns, of `min_words` equal words or more; the words still asked for.

    Pieces are moved outwards as far as the words align, in rounds of growing margins. Those of a
    chain are one alignment only if they meet, but for up to MERGE_GAP words on both sides. The
    words returned are those of the documents with `regions`, and of those of later rounds.
    """
    spans, found = found.where("owner IS NULL").select("doc"), found.where("owner IS NOT NULL")
    edges, margin, moves, kept = _edges(found), MARGIN, [], None
    while True:
        moves.append(stage(_moved(edges, _blocks(words if kept is None else kept), margin), "moves"))
        more = moves[-1].where("more")
        last = more.isEmpty()
        if not last:
            sign = F.when(F.col("ahead"), 1).otherwise(-1)
            edges = stage(edges.join(more.hint("merge"), "edge").select(
                "edge", "ahead", "doc", (F.col("at") + sign * F.col("i")).alias("at"), "limit", "owner",
                (F.col("owner_at") + sign * F.col("j")).alias("owner_at"), "owner_limit").where(
                "at != limit AND owner_at != owner_limit"), "edges")
            margin = min(4 * margin, MOST_MARGIN)
        if kept is None:
            asked = edges.select(F.explode(F.array("doc", "owner")).alias("doc"))
            kept = stage(words.join((spans if last else spans.unionByName(asked)).hint("merge"), "doc", "left_semi"), "words")
        if last:
            break
    total = reduce(DataFrame.unionByName, moves).groupBy("edge").agg(*[F.sum(c).cast("int").alias(c) for c in ("i", "j", "same")])
    total = total.groupBy(F.shiftright("edge", 1).alias("piece")).agg(*[
        F.coalesce(F.max(F.when(F.col("edge") % 2 == side, F.col(c))), F.lit(0)).alias(f"{c}{side}")
        for side in (0, 1) for c in ("i", "j", "same")])
    counts = [f"{c}{side}" for side in (0, 1) for c in ("i", "j", "same")]
    grown = found.join(total.hint("merge"), "piece", "left").na.fill(0, counts).select(
        "doc", "chain", "start", "end", "owner", "owner_start", "owner_end", *counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_keys(batches, ["doc", "chain"]):
            rows, now = [], None
            for doc, chain, start, end, owner, owner_start, owner_end, i0, j0, same0, i1, j1, same1 in zip(
                    *(batch.column(i).to_pylist() for i in range(13))):
                if now is not None and now["key"] == (doc, chain):
                    gap, owner_gap = start - now["end"], owner_start - now["owner_end"]
                    if gap - now["i"] - i0 <= MERGE_GAP and owner_gap - now["j"] - j0 <= MERGE_GAP:
                        now["words"] += end - start + min(now["same"] + same0, gap, owner_gap)
                        now.update(end=end, owner_end=owner_end, i=i1, j=j1, same=same1)
                        continue
                if now is not None:
                    rows.append(now)
                now = {"key": (doc, chain), "start": start - i0, "owner": owner, "owner_start": owner_start - j0, "end": end,
                       "owner_end": owner_end, "words": end - start + same0, "i": i1, "j": j1, "same": same1}
            rows = [(r["key"][0], r["start"], r["end"] + r["i"], r["owner"], r["owner_start"])
                    for r in [*rows, now] if r["words"] + r["same"] >= min_words]
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
                    ["doc", "start", "end", "owner", "owner_start"])

    return grown.repartition("doc").sortWithinPartitions("doc", "chain", "start").mapInArrow(
        run, "doc bigint, start int, end int, owner bigint, owner_start int"), kept


def equal_runs(found: DataFrame, words: DataFrame, width: int = MIN_WORDS) -> DataFrame:
    """(doc, start, end, owner, owner_start) of equal runs of `width` words or more within the `regions`.

    Every run of `width` words is matched as a whole. So it is found whichever documents have its
    seeds, and also if it is one line over and over.
    """
    spans = found.where("owner IS NULL").groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    texts = words.join(spans.hint("merge"), "doc").select("doc", "words", "spans")

    def chosen(batch: pa.RecordBatch) -> Rows:
        numbers, lengths = _numbers(batch.column("words"))
        every = runs(numbers.astype(np.uint64), width)
        at, text, first = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        starts = []
        for i, (length, parts) in enumerate(zip(lengths.tolist(), batch.column("spans").to_pylist())):
            for part in parts:
                places = np.arange(part["start"], min(part["end"], length - width + 1))
                at.append(places)
                text.append(np.full(len(places), i))
            starts.append(first)
            first += length
        pos, text = np.concatenate(at), np.concatenate(text)
        seed = every[pos + np.array(starts, np.int64)[text]] if len(pos) else np.zeros(0, np.uint64)
        return seed, batch.column("doc").to_numpy()[text], pos, len(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_keys(batches, ["doc"]):
            doc, pos, owner, owner_pos = (batch.column(i).to_numpy() for i in range(4))
            first = np.concatenate(([True], (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1]) | (pos[1:] != pos[:-1] + 1)
                                    | (owner_pos[1:] != owner_pos[:-1] + 1)))
            start = np.flatnonzero(first)
            last = np.concatenate((start[1:], [len(doc)])) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[start]), pa.array(pos[start]), pa.array(pos[last] + np.int32(width)), pa.array(owner[start]),
                 pa.array(owner_pos[start])], ["doc", "start", "end", "owner", "owner_start"])

    return _matches(_led(texts, chosen)).where("owner IS NOT NULL").repartition("doc").sortWithinPartitions(
        "doc", "pos", "owner", "owner_pos").mapInArrow(run, "doc bigint, start int, end int, owner bigint, owner_start int")


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile gives Python at most TEXT_ROWS whole texts at once."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(min(int(before), TEXT_ROWS) if int(before) > 0 else TEXT_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, start_word, n_words, other_doc, other_start): what a document repeats of smaller documents.

    Each passage has `min_words` words of one other document. Those of one document that
    touch or overlap are one passage, whichever documents they are with; the partner named
    is that of the longest of them.
    """
    # A text of fewer words can not hold a passage.
    with _small_batches(docs.sparkSession):
        words = stage(numbered_words(_numbered(docs), max(min_words, SEED)), "words")
    found = stage(chained(seed_matches(words), min_words), "chains")
    pieced, words = aligned(found, words, min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_keys(batches, ["doc"]):
            rows, now = [], None
            for doc, start, end, owner, owner_start in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if now is not None and now[0] == doc and start <= now[2]:
                    if end - start > now[5]:
                        now[3], now[4], now[5] = owner, owner_start, end - start
                    now[2] = max(now[2], end)
                else:
                    if now is not None:
                        rows.append(now)
                    now = [doc, start, end, owner, owner_start, end - start]
            doc, start, end, owner, owner_start, _ = zip(*rows, now)
            yield pa.RecordBatch.from_arrays([
                pa.array(doc, pa.int64()), pa.array(start, pa.int32()),
                pa.array([e - s for s, e in zip(start, end)], pa.int32()), pa.array(owner, pa.int64()),
                pa.array(owner_start, pa.int32())], ["doc", "start_word", "n_words", "other_doc", "other_start"])

    return (
        pieced.unionByName(equal_runs(found, words, min_words))
        .repartition("doc").sortWithinPartitions("doc", "start", F.desc("end"), "owner")
        .mapInArrow(run, "doc bigint, start_word int, n_words int, other_doc bigint, other_start int")
    )


_WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+")


def without_passages(docs: DataFrame, passages: DataFrame, key: Column | None = None) -> DataFrame:
    """`docs` (doc_id, text and any other columns) with the passages cut out of the texts.

    `key` is what the passages name a document by, if it is not its id.

    The white space before a passage goes with it. Documents of which no word is left go.
    """
    columns = docs.columns
    cuts = passages.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start_word", "n_words"))).alias("_cuts"))
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text")) if key is None else key
    marked = docs.withColumn("doc", key).join(cuts, "doc", "left").drop("doc")
    schema = marked.select(*columns, F.lit(False).alias("_cut")).schema
    place = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, changed = batch.column(place).to_pylist(), []
            for i, cuts in enumerate(batch.column(len(columns)).to_pylist()):
                changed.append(bool(cuts))
                if cuts:
                    texts[i] = cut_words(texts[i], [(c["start_word"], c["n_words"]) for c in cuts])
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(changed)], [*columns, "_cut"])

    cut = marked.mapInArrow(run, schema)
    return cut.where(~F.col("_cut") | F.col("text").rlike(r"[^\x20\x09-\x0D]")).drop("_cut")


def cut_words(text: str, cuts: list[tuple[int, int]]) -> str:
    places = [match.span() for match in _WORD.finditer(text)]
    out, at = [], 0
    for first, count in cuts:
        if first >= len(places):
            continue
        start = places[first - 1][1] if first else 0
        end = places[min(first + count, len(places)) - 1][1]
        out.append(text[at:max(start, at)])
        at = max(at, end)
    return "".join(out) + text[at:]


def op3_substring_dedup(docs: DataFrame) -> DataFrame:
    return repeated_passages(docs).select(
        F.col("doc").alias("doc_id"), "start_word", "n_words", F.col("other_doc").alias("other_doc_id"), "other_start")
