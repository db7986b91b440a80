"""LM scoring with a hashed maximum-entropy model, factored by word classes.

log P(word | history) = log P(class | history) + log P(word | class, history), two softmaxes.
The features of the first are n-grams and skips of the classes before (the last, the last
two together, the one before, and the topic most of the eight words before belong to),
hashed into FEATURES slots. The second goes over all words of the class. Its features are
n-grams and skips of the words before (the last, the last two together, the one before),
hashed into slots of the class, as many as the counted vocabulary asks for; a weight belongs to a
slot and a member of the class. The most frequent words are members by themselves, the others are hashed into members.
With s the sum of the weights of a word's member, and share its count in the class, smoothed
as in the base score,

    P(word | class, history) = share * exp(s) / (sum over the words of the class of share * exp(s)).

The sum is taken by members, whose shares are counted exactly, so it has all words. A class has one
type more, with s = 0, for words not seen.

Learning, all on the training documents:
1. the words of a slice of texts are numbered once, and the numbers staged; words are counted exactly;
   words of one ending are a bucket, and the buckets near a
   bucket are counted in a signed sketch of DIMENSIONS numbers; buckets with like
   neighbourhoods are a topic, and a class is a topic with a shape of the word's end, or
   one frequent bucket alone;
2. events (history, class) are counted; there are at most as many as histories x classes. What stands
   with each slot is counted by members;
3. the weights are trained by gradient updates: every task computes the gradient of its
   events, the sums of all are one step. Those of the words start from the counts, and a step takes
   one part of the slices: all steps together take every slice.
What comes to the driver is bounded by the sizes of the model (BUCKETS x DIMENSIONS, CLASSES, FEATURES,
CLASSES x MOST_SLOTS x MEMBERS).

The distinct words of a slice are joined with the counts of the corpus and come back to their
slice, which is scored from its numbers in numpy batches. The vocabulary is
never gathered, and a frequent word has one row in each slice.

Defined cases: a NULL or empty text has one token, the end; without training documents the
base score is that of N = 0, V = 0, and so is the model; rows with equal or NULL ids are
scored each; a NULL id counts as the empty text where ids are hashed.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.common import crc_share, stage, text_slices

BUCKETS = 1 << 15
DIMENSIONS = 32
BLOCK = 512  # rows of a table in a row of a DataFrame
NEAR = 6  # words on either side
CLASSES = 64
TOPICS = 8
SHAPES = 6
ALONE = 15  # CLASSES = 1 + ALONE + TOPICS * SHAPES
FEATURES = 4096
STEPS = 20
WINDOW = 8  # words before the last two that give the topic
ALPHA = 0.1
SLICE_CHARACTERS = 8_000_000
END = BUCKETS  # the bucket of the end of a text
MEMBERS = 32  # of a class
OWN = 24  # of them for one word each
FREQUENT = 4096  # words that may be members by themselves
MOST_SLOTS = 1024  # of a class, for features of words
WORD_FEATURES = 3
WORD_STEPS = 4
SMOOTH, SPREAD, RATE = 8.0, 1.2, 1.0  # of the start of the weights of words, and of their steps
_START = CLASSES  # the class before the first word
_END_WORD = b"\xff"  # no word of a text in UTF-8
_TOKENS = 1 << 14  # taken at once
PIECE = 1 << 18  # tokens of texts that are taken together
PIECE_BYTES = 1 << 20  # of texts whose words are Python objects at once


def bucket_of(word: bytes) -> int:
    """Longer words with the same ending share a bucket; short ones have one nearly alone."""
    return xxhash.xxh3_64_intdigest(word if len(word) <= 6 else word[-4:]) % BUCKETS


def shape_of(word: bytes) -> int:
    """What a word ends with: a letter or any character beyond ASCII, a full stop, a comma, |, !, or something else."""
    last = word[-1:]
    return {b".": 1, b",": 2, b"|": 3, b"!": 4}.get(last, 0 if last >= b"\x80" or b"a" <= last <= b"z" else 5)


_SHAPES = np.array([shape_of(bytes([last])) for last in range(256)], np.int32)


@dataclass(frozen=True)
class Words:
    """The texts of a slice as places in its vocabulary; every text ends with the end token."""

    ids: np.ndarray
    lengths: np.ndarray  # tokens of each text
    numbers: np.ndarray  # of each word of the vocabulary, 64 bits
    buckets: np.ndarray
    shapes: np.ndarray


def _few(texts: Sequence[bytes | None]) -> Iterator[Sequence[bytes | None]]:
    """Runs of texts of about PIECE_BYTES."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or b"")
        if held >= PIECE_BYTES:
            yield texts[start:i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def slice_words(texts: Sequence[bytes | None]) -> Words:
    place: dict[bytes, int] = {}
    pieces = [np.zeros(0, np.int32)]
    # A word that stands in the text again is an object only within a piece.
    for few in _few(texts):
        flat = b" ".join([part for text in few for part in (text or b"", _END_WORD)]).lower().split()
        for word in dict.fromkeys(flat):
            place.setdefault(word, len(place))
        pieces.append(np.fromiter(map(place.__getitem__, flat), np.int32, len(flat)))
        del flat
    ids, vocabulary = np.concatenate(pieces), list(place)
    numbers = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))
    # As bucket_of and shape_of, for all words at once.
    buckets = (numbers % np.uint64(BUCKETS)).astype(np.int64)
    long = np.flatnonzero(np.fromiter(map(len, vocabulary), np.int64, len(vocabulary)) > 6)
    endings = [vocabulary[i][-4:] for i in long.tolist()]
    bucket = {ending: xxhash.xxh3_64_intdigest(ending) % BUCKETS for ending in dict.fromkeys(endings)}
    buckets[long] = np.fromiter(map(bucket.__getitem__, endings), np.int64, len(endings))
    shapes = _SHAPES[np.fromiter((word[-1] for word in vocabulary), np.uint8, len(vocabulary))]
    if _END_WORD in place:
        buckets[place[_END_WORD]] = END
    ends = np.flatnonzero(ids == place.get(_END_WORD, -1))
    return Words(ids, np.diff(ends, prepend=-1), numbers, buckets, shapes)


def _counted(docs: DataFrame) -> DataFrame:
    """Rows of slices of the texts, as the input deals them: the ids of the documents, which are held out, their `Words`
    and how often each is in the training texts. Rows without a chunk are a block of buckets and its sketch."""
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([
        *T._parse_datatype_string(
            "chunk bigint, block int, data binary, n_tokens bigint, lengths array<bigint>, low binary, high binary, buckets binary, "
            "shapes binary, n binary, held_out array<boolean>").fields, T.StructField("doc_ids", T.ArrayType(id_type))])
    names = schema.names

    def row(id_kind: pa.DataType, **columns) -> pa.RecordBatch:
        kinds = dict(zip(names, (
            pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 5, pa.list_(pa.bool_()),
            pa.list_(id_kind))))
        return pa.RecordBatch.from_arrays([pa.array([columns.get(name)], kinds[name]) for name in names], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        columns = 2 * DIMENSIONS  # the second half counts negatively
        near = np.zeros((BUCKETS + 1) * columns, np.int64)
        chunk = TaskContext.get().partitionId() << 32
        id_kind = pa.null()
        for whole in batches:
            id_kind = whole.column("doc_id").type
            for batch in text_slices(whole, SLICE_CHARACTERS):
                if not batch.num_rows:
                    continue
                words = slice_words(batch.column("text").cast(pa.binary()).to_pylist())
                ids, given = words.ids, ~batch.column("held_out").to_numpy(zero_copy_only=False)
                parts = words.numbers.view(np.uint32).reshape(-1, 2)
                n = np.zeros(len(parts), np.int64)
                for texts, tokens in _pieces(words.lengths):
                    lengths = words.lengths[texts]
                    learn, text = np.repeat(given[texts], lengths), np.repeat(np.arange(len(lengths)), lengths)
                    b = words.buckets[ids[tokens]]
                    for lag in range(1, NEAR + 1):
                        inside = learn[lag:] & (text[lag:] == text[:-lag]) & (b[lag:] != END)
                        x, y = b[:-lag][inside], b[lag:][inside]
                        np.add.at(near, x * columns + y % columns, 1)
                        np.add.at(near, y * columns + x % columns, 1)
                    n += np.bincount(ids[tokens][learn], minlength=len(n))
                yield row(
                    id_kind, chunk=chunk, data=_packed(ids), n_tokens=len(ids), lengths=words.lengths, low=parts[:, 0].tobytes(),
                    high=parts[:, 1].tobytes(), buckets=words.buckets.astype(np.uint16).tobytes(),
                    shapes=words.shapes.astype(np.uint8).tobytes(),
                    n=_packed(n.astype(np.int32)),
                    held_out=batch.column("held_out").to_pylist(), doc_ids=batch.column("doc_id").to_pylist())
                chunk += 1
        table = near.reshape(-1, columns)[:BUCKETS]
        sketch = np.concatenate((table[:, :DIMENSIONS] - table[:, DIMENSIONS:], table.sum(1, keepdims=True)), axis=1)
        for block, data in _blocks(sketch):
            yield row(id_kind, block=block, data=data)

    return docs.mapInArrow(run, schema)


def _packed(values: np.ndarray) -> bytes:
    """Numbers of 32 bits, compressed: their first bytes, then their second ones, and so on."""
    planes = np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def _unpacked(data: pa.Buffer, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, 4 * count), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _words(slices: DataFrame) -> DataFrame:
    """(chunk, word, place, bucket, shape, n) of the words of each slice; n counts the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                low, high, buckets, shapes, n = (batch.column(name)[i].as_buffer() for name in ("low", "high", "buckets", "shapes", "n"))
                size = low.size // 4
                numbers = np.stack((np.frombuffer(low, np.uint32), np.frombuffer(high, np.uint32)), axis=1).view(np.int64).ravel()
                columns = (
                    np.full(size, batch.column("chunk")[i].as_py()), numbers, np.arange(size, dtype=np.int32),
                    np.frombuffer(buckets, np.uint16).astype(np.int32), np.frombuffer(shapes, np.uint8).astype(np.int32),
                    _unpacked(n, size).astype(np.int64))
                for start in range(0, size, 100_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(column[start:start + 100_000]) for column in columns], ["chunk", "word", "place", "bucket", "shape", "n"])

    return slices.select("chunk", "low", "high", "buckets", "shapes", "n").mapInArrow(
        run, "chunk bigint, word bigint, place int, bucket int, shape int, n bigint")


def _blocks(table: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The blocks of rows of a table that hold something."""
    for block in range(-(-len(table) // BLOCK)):
        rows = table[block * BLOCK:(block + 1) * BLOCK]
        if rows.any():
            yield block, rows.tobytes()


def _summed(parts: DataFrame, shape: tuple[int, int], kind: type) -> np.ndarray:
    """The sum of tables given as (block, data) of `_blocks`; the sums of blocks are made by tasks, in two steps."""

    def run(of: type):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for block, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist()):
                    values = np.frombuffer(data, of).astype(np.float64)
                    sums[block] = sums[block] + values if block in sums else values
            if sums:
                yield pa.RecordBatch.from_arrays([
                    pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                    ["block", "data"])
        return add

    spread = parts.repartition("block").mapInArrow(run(kind), "block int, data binary")
    out = np.zeros(shape)
    # One row for each block of the table.
    for row in spread.collect():
        out[row["block"] * BLOCK:(row["block"] + 1) * BLOCK] += np.frombuffer(row["data"]).reshape(-1, shape[1])
    return out


def _clusters(rows: np.ndarray, weights: np.ndarray, k: int, rounds: int = 25) -> np.ndarray:
    """Weighted k-means on the unit sphere, started from heavy rows that are far apart."""
    rows = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    centers = rows[[int(weights.argmax())]]
    far = 1 - rows @ centers[0]
    while len(centers) < k:
        pick = int((far * np.log1p(weights)).argmax())
        centers = np.vstack((centers, rows[pick]))
        far = np.minimum(far, 1 - rows @ rows[pick])
    for _ in range(rounds):
        label = (rows @ centers.T).argmax(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, label, rows * weights[:, None])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norms > 0, sums / np.maximum(norms, 1e-9), centers)
    return (rows @ centers.T).argmax(1)


@dataclass(frozen=True)
class Classes:
    of_bucket: np.ndarray  # class of each bucket, the end's last
    topic_of: np.ndarray  # topic of each class


def _classes(near: np.ndarray, tokens: np.ndarray, shapes: np.ndarray) -> Classes:
    """Class 0 is the end, the next ALONE are the most frequent buckets, the others a topic and a shape each."""
    weight = near[:, -1]
    topics = np.zeros(BUCKETS, np.int64)
    known = np.flatnonzero(weight > 0)
    if len(known):
        mean = near[:, :-1].sum(0) / weight.sum()
        # How a neighbourhood differs from the average one; that of a rare bucket is mostly noise.
        rows = (near[known, :-1] - weight[known, None] * mean) / np.sqrt(weight[known, None] + 50)
        topics[known] = _clusters(rows, np.sqrt(weight[known]), TOPICS)
    of_bucket = np.concatenate((1 + ALONE + topics * SHAPES + shapes, [0]))
    alone = np.argsort(-tokens, kind="stable")[:ALONE]
    of_bucket[alone] = 1 + np.arange(ALONE)
    topic_of = np.concatenate(([0], topics[alone], np.repeat(np.arange(TOPICS), SHAPES), [0]))
    return Classes(of_bucket, topic_of)


@dataclass(frozen=True)
class Members:
    """Which member of its class a word is; words are known by 32 bits of their numbers."""

    frequent: np.ndarray  # sorted numbers of words that are members by themselves
    place: np.ndarray  # and their places in their classes
    slots: int  # of a class, for features of words

    def of(self, numbers: np.ndarray) -> np.ndarray:
        out = OWN + (_hashed(numbers.astype(np.uint64)) >> np.uint64(32)).astype(np.int64) % (MEMBERS - OWN)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, numbers), len(self.frequent) - 1)
            out = np.where(self.frequent[at] == numbers, self.place[at], out)
        return out

    def features(self, numbers: np.ndarray, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Slots of every token, from the `numbers` and `classes` of all: the last word, the last two, the one before."""
        place = np.arange(len(numbers)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        words = numbers.astype(np.uint64) + np.uint64(1)
        last, before = np.zeros_like(words), np.zeros_like(words)
        last[1:], before[2:] = words[:-1], words[:-2]
        last[place < 1], before[place < 2] = 0, 0
        keys = (last, last * np.uint64(0xD6E8FEB86659FD93) + before + np.uint64(1 << 40), before + np.uint64(1 << 41))
        own = classes * self.slots
        return np.stack([own + ((_hashed(key) >> np.uint64(40)).astype(np.int64) & (self.slots - 1)) for key in keys], axis=1)


def _hashed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _members(totals: DataFrame, classes: Classes, types: int) -> Members:
    """The most frequent words of a class are members by themselves; slots grow with the types a class has on average."""
    # FREQUENT rows.
    top = totals.orderBy(F.desc("n"), "word").limit(FREQUENT).select("word", "bucket").toArrow()
    numbers = top["word"].to_numpy().view(np.uint64).astype(np.uint32)
    own = classes.of_bucket[top["bucket"].to_numpy()]
    taken, place = np.zeros(CLASSES, np.int64), {}
    for number, of in zip(numbers.tolist(), own.tolist()):
        if taken[of] < OWN and number not in place:
            place[number] = int(taken[of])
            taken[of] += 1
    frequent = np.array(sorted(place), np.uint32)
    slots = 1 << max(4, (max(types, 1) // CLASSES).bit_length())
    return Members(frequent, np.array([place[number] for number in frequent.tolist()], np.int64), min(slots, MOST_SLOTS))


def _member_counts(totals: DataFrame, classes: Classes, members: Members) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and types of training of every member, classes x MEMBERS."""
    shared = totals.sparkSession.sparkContext.broadcast((classes, members))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, own = shared.value
        tokens, types = np.zeros(CLASSES * MEMBERS, np.int64), np.zeros(CLASSES * MEMBERS, np.int64)
        for batch in batches:
            numbers = batch.column("word").to_numpy().view(np.uint64).astype(np.uint32)
            at = of.of_bucket[batch.column("bucket").to_numpy()] * MEMBERS + own.of(numbers)
            np.add.at(tokens, at, batch.column("n").to_numpy())
            types += np.bincount(at, minlength=len(types))
        at = np.flatnonzero(types)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(tokens[at]), pa.array(types[at])], ["at", "tokens", "types"])

    counts = totals.select("word", "bucket", "n").mapInArrow(run, "at bigint, tokens bigint, types bigint")
    tokens, types = np.zeros(CLASSES * MEMBERS), np.zeros(CLASSES * MEMBERS)
    # At most CLASSES x MEMBERS rows.
    table = counts.groupBy("at").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).toArrow()
    at = table["at"].to_numpy()
    tokens[at], types[at] = table["tokens"].to_numpy(), table["types"].to_numpy()
    return tokens.reshape(CLASSES, MEMBERS), types.reshape(CLASSES, MEMBERS)


def histories(classes: np.ndarray, lengths: np.ndarray, topic_of: np.ndarray) -> np.ndarray:
    """A number for the history of every token's class: the last class, the one before, and the topic before those."""
    n = len(classes)
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = np.arange(n) - starts
    last = np.where(place > 0, np.concatenate(([_START], classes[:-1])), _START)
    before = np.where(place > 1, np.concatenate(([_START] * min(2, n), classes[:-2])), _START)
    best, most = np.zeros(n, np.int64), np.zeros(n, np.int64)
    upper, lower = np.maximum(np.arange(n) - 2, starts), np.maximum(np.arange(n) - 2 - WINDOW, starts)
    topics = topic_of[classes]
    for topic in range(TOPICS):
        sums = np.concatenate(([0], np.cumsum(topics == topic)))
        here = sums[np.maximum(upper, lower)] - sums[lower]
        better = here > most
        best[better], most[better] = topic + 1, here[better]
    return (last * (CLASSES + 1) + before) * (TOPICS + 1) + best


HISTORIES = (CLASSES + 1) ** 2 * (TOPICS + 1)


def features(history: np.ndarray) -> np.ndarray:
    """Slots of the features of histories, one row each: bias, last, last two, skip, topic, topic with last."""
    topic, rest = history % (TOPICS + 1), history // (TOPICS + 1)
    before, last = rest % (CLASSES + 1), rest // (CLASSES + 1)
    columns = (np.zeros_like(history), 1 + last, 100_000 + last * 1000 + before, 1000 + before, 2000 + topic,
               3000 + topic * 100 + last)
    keys = np.stack(columns, axis=1).astype(np.uint64)
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int64)


def log_probabilities(history: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Natural logs of P(class | history), one row for each history."""
    scores = weights[features(history)].sum(1)
    scores -= scores.max(1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(1, keepdims=True))


def word_scores(slots: np.ndarray, classes: np.ndarray, weights: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, ...]:
    """(s, p, total): the sums of weights of all members, their shares times exp(s), and the sum over the words of the class.

    `shares` has the shares of members in their class, and last that of words not seen, whose s is 0.
    """
    s = weights[slots[:, 0]]
    for k in range(1, slots.shape[1]):
        s = s + weights[slots[:, k]]
    p = np.exp(s) * shares[classes, :-1]
    return s, p, p.sum(1) + shares[classes, -1]


@dataclass(frozen=True)
class _Slice:
    """A slice of the texts, with the classes and members of its vocabulary."""

    doc_ids: pa.Array
    held_out: np.ndarray
    lengths: np.ndarray
    ids: np.ndarray
    numbers: np.ndarray
    label: np.ndarray
    member: np.ndarray


_SLICE = ("data", "n_tokens", "lengths", "low", "buckets", "held_out", "doc_ids")


def _read(batch: pa.RecordBatch | pa.Table, i: int, classes: Classes, members: Members) -> _Slice:
    row = {name: batch.column(name)[i] for name in _SLICE}
    numbers = np.frombuffer(row["low"].as_buffer(), np.uint32)
    return _Slice(
        row["doc_ids"].values, row["held_out"].values.to_numpy(zero_copy_only=False), row["lengths"].values.to_numpy(),
        _unpacked(row["data"].as_buffer(), row["n_tokens"].as_py()), numbers,
        classes.of_bucket[np.frombuffer(row["buckets"].as_buffer(), np.uint16)], members.of(numbers))


def _pieces(lengths: np.ndarray) -> Iterator[tuple[slice, slice]]:
    """Runs of whole texts of about PIECE tokens: which texts, and which tokens."""
    ends = np.cumsum(lengths)
    first, start = 0, 0
    while first < len(lengths):
        last = max(int(np.searchsorted(ends, start + PIECE, "right")), first + 1)
        yield slice(first, last), slice(start, int(ends[last - 1]))
        first, start = last, int(ends[last - 1])


def _training(part: _Slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the vocabulary of the tokens of training, and the lengths of their texts, in pieces."""
    for texts, tokens in _pieces(part.lengths):
        learn, lengths = ~part.held_out[texts], part.lengths[texts]
        if learn.any():
            yield part.ids[tokens][np.repeat(learn, lengths)], lengths[learn]


def _events(slices: DataFrame, classes: Classes, members: Members) -> DataFrame:
    """(history, class, n) over the training documents, and (block, data) of the counts of members at each slot."""
    shared = slices.sparkSession.sparkContext.broadcast((classes, members))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        of, own = shared.value
        sums = np.zeros(HISTORIES * CLASSES, np.uint32)
        counts = np.zeros(CLASSES * own.slots * MEMBERS, np.uint32)
        names, one = ["history", "class", "n", "block", "data"], np.uint32(1)
        for batch in batches:
            for i in range(batch.num_rows):
                part = _read(batch, i, of, own)
                for ids, lengths in _training(part):
                    c = part.label[ids]
                    np.add.at(sums, histories(c, lengths, of.topic_of) * CLASSES + c, one)
                    slots, member = own.features(part.numbers[ids], c, lengths), part.member[ids]
                    for column in slots.T:
                        np.add.at(counts, column * MEMBERS + member, one)
        keys = np.flatnonzero(sums)
        for start in range(0, len(keys), 200_000):
            part = keys[start:start + 200_000]
            yield pa.RecordBatch.from_arrays([
                pa.array((part // CLASSES).astype(np.int32)), pa.array((part % CLASSES).astype(np.int32)),
                pa.array(sums[part].astype(np.int64)), pa.nulls(len(part), pa.int32()), pa.nulls(len(part), pa.binary())], names)
        for block, data in _blocks(counts.reshape(-1, MEMBERS)):
            yield pa.RecordBatch.from_arrays([
                *(pa.nulls(1, kind) for kind in (pa.int32(), pa.int32(), pa.int64())), pa.array([block], pa.int32()),
                pa.array([data], pa.binary())], names)

    return slices.mapInArrow(run, "history int, class int, n bigint, block int, data binary")


def _trained(events: DataFrame, steps: int = STEPS) -> np.ndarray:
    """Weights (features x classes) after `steps` gradient updates; every step sums the gradients of all tasks."""
    context = events.sparkSession.sparkContext
    weights = np.zeros((FEATURES, CLASSES))
    schema = "slot int, observed array<double>, expected array<double>"

    def gradient(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            observed, expected = np.zeros((FEATURES, CLASSES)), np.zeros((FEATURES, CLASSES))
            touched = np.zeros(FEATURES, bool)
            for batch in batches:
                history, place = np.unique(batch.column("history").to_numpy().astype(np.int64), return_inverse=True)
                counts = np.zeros((len(history), CLASSES))
                np.add.at(counts, (place, batch.column("class").to_numpy()), batch.column("n").to_numpy())
                model = np.exp(log_probabilities(history, shared.value)) * counts.sum(1, keepdims=True)
                slots = features(history)
                for column in slots.T:
                    np.add.at(observed, column, counts)
                    np.add.at(expected, column, model)
                touched[slots] = True
            at = np.flatnonzero(touched)
            yield pa.RecordBatch.from_arrays([
                pa.array(at.astype(np.int32)), pa.array(list(observed[at]), pa.list_(pa.float64())),
                pa.array(list(expected[at]), pa.list_(pa.float64()))], ["slot", "observed", "expected"])

        return events.mapInArrow(run, schema)

    active = features(np.zeros(1, np.int64)).shape[1]
    for _ in range(steps):
        shared = context.broadcast(weights.astype(np.float32))
        observed, expected = np.zeros((FEATURES, CLASSES)), np.zeros((FEATURES, CLASSES))
        # At most FEATURES rows from each task of the events, whose number is bounded.
        table = gradient(shared).toArrow()
        for name, sums in (("observed", observed), ("expected", expected)):
            if table.num_rows:
                values = table[name].combine_chunks().flatten().to_numpy().reshape(-1, CLASSES)
                np.add.at(sums, table["slot"].to_numpy(), values)
        # The gradient, scaled by the expected counts (its diagonal curvature) and damped by the features of an event.
        step = (observed - expected - 0.01 * weights) / (expected + 1.0)
        weights = weights + np.clip(step, -1.5, 1.5) * (1.5 / active)
        shared.destroy()
    return weights


def _word_gradient(slots: np.ndarray, classes: np.ndarray, member: np.ndarray, weights: np.ndarray, shares: np.ndarray,
                   out: np.ndarray) -> None:
    """Add to `out` what is observed less what is expected, by slot and member."""
    for start in range(0, len(slots), _TOKENS):
        here, c, m = (column[start:start + _TOKENS] for column in (slots, classes, member))
        _, p, total = word_scores(here, c, weights, shares)
        p /= -total[:, None]
        p[np.arange(len(m)), m] += 1
        for k in range(here.shape[1]):
            order = np.argsort(here[:, k].astype(np.uint16), kind="stable")  # there are at most 2^16 slots
            slot = here[order, k]
            first = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
            out[slot[first]] += np.add.reduceat(p[order], first, axis=0)


def _trained_words(slices: DataFrame, counts: np.ndarray, shares: np.ndarray, classes: Classes, members: Members,
                   steps: int = WORD_STEPS) -> np.ndarray:
    """Weights (slots x members) of the words; the steps take the slices in turn, those of few slices all of them."""
    context = slices.sparkSession.sparkContext
    seen = counts.sum(1, keepdims=True)
    share = np.repeat(shares[:, :-1], members.slots, axis=0)
    # The start: what each feature would weigh alone, smoothed, dealt to the features of a token.
    with np.errstate(divide="ignore", invalid="ignore"):
        alone = np.log((counts + SMOOTH * share) / (seen + SMOOTH) / share)
    weights = (np.where(share > 0, np.nan_to_num(alone, neginf=0.0), 0.0) * (SPREAD / WORD_FEATURES)).astype(np.float32)
    curvature = np.maximum(counts, seen * share)
    parts = min(steps, max(slices.count(), 1))
    tasks = max(1, slices.rdd.getNumPartitions() // parts)
    for step in range(steps):
        shared = context.broadcast((classes, members, weights, shares.astype(np.float32)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gc.disable()
            of, own, held, base = shared.value
            out = np.zeros(held.shape, np.float32)
            for batch in batches:
                for i in range(batch.num_rows):
                    part = _read(batch, i, of, own)
                    for ids, lengths in _training(part):
                        c = part.label[ids]
                        _word_gradient(own.features(part.numbers[ids], c, lengths), c, part.member[ids], held, base, out)
            for block, data in _blocks(out):
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([data], pa.binary())], ["block", "data"])

        taken = slices.where(F.pmod(F.xxhash64("chunk"), F.lit(parts)) == step % parts)
        gradient = _summed(taken.coalesce(tasks).mapInArrow(run, "block int, data binary"), weights.shape, np.float32)
        # Scaled by what the taken part has of the counts (its diagonal curvature) and damped by the features of a token.
        move = (gradient - 0.01 * weights) / (curvature / parts + 4.0)
        weights = (weights + np.clip(move, -1, 1) * (RATE / WORD_FEATURES)).astype(np.float32)
        shared.destroy()
    return weights


def _class_table(history: np.ndarray, weights: np.ndarray, table: np.ndarray) -> None:
    """Fill in log10 P(class | history) for the histories that occur and have only zeros so far."""
    here = np.flatnonzero(np.bincount(history, minlength=HISTORIES))
    new = here[~table[here].any(1)]
    for start in range(0, len(new), 4096):
        table[new[start:start + 4096]] = log_probabilities(new[start:start + 4096], weights) / np.log(10)


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of all rows of `docs`."""
    id_field = docs.schema["doc_id"]
    docs = docs.select("doc_id", "text", (crc_share(F.col("doc_id"), 10) == 0).alias("held_out"))
    spark = docs.sparkSession
    counted = stage(_counted(docs), "counts")
    words = _words(counted.where("chunk IS NOT NULL"))
    slices = counted.where("chunk IS NOT NULL").select("chunk", *_SLICE)
    totals = stage(words.groupBy("word", "bucket").agg(F.sum("n").alias("n")).where("n > 0"), "vocabulary")
    # BUCKETS + 1 rows.
    by_bucket = words.groupBy("bucket").agg(F.max_by("shape", F.col("n") * SHAPES + F.col("shape")).alias("shape")).join(
        totals.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("types")), "bucket").toArrow()
    tokens, types, shapes = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1, np.int64)
    for name, values in (("n", tokens), ("types", types), ("shape", shapes)):
        values[by_bucket["bucket"].to_numpy()] = by_bucket[name].to_numpy()
    near = _summed(counted.where("chunk IS NULL").select("block", "data"), (BUCKETS, DIMENSIONS + 1), np.int64)
    classes = _classes(near, tokens[:BUCKETS], shapes[:BUCKETS])
    n_all, v_all = int(tokens.sum()), int(types.sum())
    members = _members(totals, classes, v_all)
    member_tokens, member_types = _member_counts(totals, classes, members)
    class_total = member_tokens.sum(1) + ALPHA * (member_types.sum(1) + 1)
    shares = np.column_stack((member_tokens + ALPHA * member_types, np.full(CLASSES, ALPHA))) / class_total[:, None]
    found = stage(_events(slices, classes, members), "events")
    events = found.where("history IS NOT NULL").groupBy("history", "class").agg(F.sum("n").alias("n"))
    weights = _trained(stage(events.repartition(F.col("history")).sortWithinPartitions("history"), "events"))
    counts = _summed(found.where("block IS NOT NULL").select("block", "data"), (CLASSES * members.slots, MEMBERS), np.uint32)
    model = {
        "classes": classes, "members": members, "given": weights, "shares": shares.astype(np.float32),
        "weights": _trained_words(slices, counts, shares, classes, members),
        "base": np.log10(n_all + ALPHA * (v_all + 1)), "share": np.log10(class_total), "train_tokens": n_all,
    }
    shared = spark.sparkContext.broadcast(model)
    schema = T.StructType([id_field, *T._parse_datatype_string(
        "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double").fields])

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        gc.disable()
        m = shared.value
        part = _read(texts, 0, m["classes"], m["members"])
        c = np.zeros(len(part.numbers))
        c[known["place"].to_numpy()] = known["n"].to_numpy()
        columns, table = [], np.zeros((HISTORIES, CLASSES), np.float32)
        for texts, tokens in _pieces(part.lengths):
            ids, lengths = part.ids[tokens], part.lengths[texts]
            starts = np.cumsum(lengths) - lengths
            label, member, seen = part.label[ids], part.member[ids], (c > 0)[ids]
            own = np.log10(c + ALPHA)[ids]
            slots = m["members"].features(part.numbers[ids], label, lengths)
            factor = np.empty(len(ids))
            for start in range(0, len(ids), _TOKENS):
                here = slice(start, start + _TOKENS)
                s, _, total = word_scores(slots[here], label[here], m["weights"], m["shares"])
                factor[here] = np.where(seen[here], s[np.arange(len(s)), member[here]], 0) - np.log(total)
            history = histories(label, lengths, m["classes"].topic_of)
            _class_table(history, m["given"], table)
            given = table[history, label]
            columns.append((
                np.add.reduceat(seen.astype(np.int64), starts), np.add.reduceat(own - m["base"], starts),
                np.add.reduceat(own - m["share"][label] + given + factor / np.log(10), starts)))
        n_known, base_score, scores = (np.concatenate(column) for column in zip(*columns))
        return pa.table({
            id_field.name: part.doc_ids, "held_out": part.held_out, "n_tokens": part.lengths, "n_known": n_known,
            "train_tokens": np.full(len(n_known), m["train_tokens"], np.int64), "base_score": base_score, "score": scores})

    known = words.select("chunk", "word", "place").join(totals.select("word", "n"), "word").select(
        F.col("chunk").alias("slice"), "place", "n")
    return slices.groupBy("chunk").cogroup(known.groupBy("slice")).applyInArrow(score, schema)


def op1_lm_scoring(docs: DataFrame) -> DataFrame:
    return score_documents(docs.select("doc_id", "text"))
