"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors are integers (floor of SCALE times a component). They are put in the order of
label and of a Hilbert curve through their directions, cut into regions (ranges of that
order, one per task) and these into blocks of at most BLOCK vectors of one label. A block
is one Parquet row and carries its zone map: the least and the greatest value of every
dimension. For an anchor a, interval arithmetic over a zone map bounds the scores inside:

    sum of max(a_d * low_d, a_d * high_d)    and    sum of min(a_d * low_d, a_d * high_d)

These bounds decide twice. On the driver's zone maps of whole regions they choose the
regions an anchor is sent to; there, on the zone maps of the blocks, they choose the
blocks that are multiplied with it, in the order of their bounds, until the worst of the
wanted scores is out of reach of all that are left. Both are exact: nothing is skipped
that could be in the result.

Two passes: the first finds the positives of every anchor, the second the negatives in
the windows of scores that the positives set. A task holds the blocks of one region, of
about REGION_BYTES, and streams the anchors past them. Anchors are a share of all rows and
each is sent to every region its windows may reach, so the work is the stated query set
against all rows, in blocks. Equal vectors are told apart by their id in the order, so a
vector that a third of all rows hold is cut into many regions.

Defined cases: rows with a NULL id, label or vector, or with a component that is NULL or
not finite, take no part; nor do vectors whose squared length in integers reaches 2^59,
since their scores need not fit 64 bits. Vectors of different lengths have no score.
Rows equal in id, label and vector count once; rows with one id and different contents
are different rows, but none of them is a positive or negative of another. Equal scores
are ordered by id, the smaller first. An empty table gives no rows. Other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import slots_for, stage

SCALE = 256.0
BLOCK = 256
# Bytes of staged vectors in a region; a task holds one region.
REGION_BYTES = 64 << 20
LEAST_REGIONS = 8
# Zone maps of regions beyond this size are not brought to the driver; anchors then visit all regions.
ZONE_BYTES = 64 << 20
# Bits per dimension of the cells the curve runs through.
CURVE_BITS = 3
POSITIVES = 5
NEGATIVES = 5
# Bytes of scores held at once.
SCORE_BYTES = 32 << 20
_MOST_SQUARED = 2.0 ** 59

_POINTS = "id bigint, label bigint, dims int, cell binary, point binary"
_BLOCKS = ("region int, dims int, label bigint, label_to bigint, n int, ids array<bigint>, low binary, high binary, "
           "points binary")


# ---------------------------------------------------------------- the curve

def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of every cell (a row of coordinates of `bits` bits) on the Hilbert curve, as big-endian bits in bytes.

    The coordinates are turned into the transposed index by undoing rotations from the
    top bit down and Gray coding the result (Skilling, Programming the Hilbert curve, 2004).
    """
    axes = cells.astype(np.int64).T.copy()
    if not len(axes):
        return np.zeros((cells.shape[0], 0), np.uint8)
    bit = 1 << (bits - 1)
    while bit > 1:
        below = bit - 1
        for i, axis in enumerate(axes):
            inverted = (axis & bit) != 0
            swap = np.where(inverted, 0, (axes[0] ^ axis) & below)  # 0 for the first axis
            axes[0] ^= np.where(inverted, below, swap)
            if i:
                axis ^= swap
        bit >>= 1
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    turn = np.zeros(axes.shape[1], np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((axes[-1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    axes ^= turn
    planes = [(axes >> plane) & 1 for plane in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def direction_cells(points: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """The cell of a vector's direction: components over their mean square, cut at two of it on either side."""
    size = np.sqrt((points.astype(np.float64) ** 2).mean(axis=1, keepdims=True)) if points.size else np.ones((len(points), 1))
    spread = points / np.where(size > 0, size, 1.0)
    return np.clip(np.floor((spread + 2.0) / 4.0 * (1 << bits)), 0, (1 << bits) - 1).astype(np.int64)


# ---------------------------------------------------------------- vectors, regions, blocks

def integer_points(rows: DataFrame, scale: float = SCALE) -> DataFrame:
    """(id, label, dims, cell, point) of the rows (id, label, vector) that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, vectors = (batch.column(i) for i in range(3))
            lengths = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().cast(pa.float64())  # the offsets of a slice may not start at 0
            values = flat.to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(lengths)])
            for dims in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dims)
                matrix = values[starts[at][:, None] + np.arange(dims)].reshape(len(at), dims)
                with np.errstate(invalid="ignore", over="ignore"):
                    matrix = np.floor(matrix * scale)
                    good = np.isfinite(matrix).all(axis=1) & ((matrix ** 2).sum(axis=1) < _MOST_SQUARED)
                at, points = at[good], matrix[good].astype("<i4")
                if len(at):
                    keys = hilbert_keys(direction_cells(points), CURVE_BITS)
                    place = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(place), labels.take(place), pa.array(np.full(len(at), dims, np.int32)),
                         pa.array([key.tobytes() for key in keys], pa.binary()),
                         pa.array([point.tobytes() for point in points], pa.binary())],
                        ["id", "label", "dims", "cell", "point"])

    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").select(
        F.col("id").cast("bigint"), F.col("label").cast("bigint"), F.col("vector").cast("array<double>"))
    return rows.mapInArrow(run, _POINTS)


def blocks_of(points: DataFrame, regions: int) -> DataFrame:
    """Blocks of one label in the order of the curve, and one row of `n` 0 with the zone map of each region.

    `points` should be staged: the ranges are found by a pass of their own.
    """
    order = ["dims", "label", "cell", "id", "point"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region = TaskContext.get().partitionId()
        names = [part.split()[0] for part in _BLOCKS.split(", ")]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), *[pa.binary()] * 3]
        out: list[tuple] = []
        zones: dict[int, list] = {}
        held: list[tuple[int, bytes]] = []
        run_of, last = None, None

        def close() -> None:
            dims, label = run_of
            matrix = np.frombuffer(b"".join(point for _, point in held), "<i4").reshape(len(held), dims)
            low, high = matrix.min(axis=0), matrix.max(axis=0)
            out.append((region, dims, label, label, len(held), [i for i, _ in held], low.tobytes(), high.tobytes(),
                        matrix.tobytes()))
            zone = zones.setdefault(dims, [label, label, low, high])
            zone[:] = [min(zone[0], label), max(zone[1], label), np.minimum(zone[2], low), np.maximum(zone[3], high)]
            held.clear()

        def drain() -> pa.RecordBatch:
            columns = [pa.array(values, kind) for values, kind in zip(zip(*out), types)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            ids, labels, dims, points = (batch.column(name).to_pylist() for name in ("id", "label", "dims", "point"))
            for row in zip(dims, labels, ids, points):
                if row == last:
                    continue  # equal rows are neighbours
                last = row
                if held and (row[:2] != run_of or len(held) == BLOCK):
                    close()
                run_of = row[:2]
                held.append(row[2:])
            if len(out) * BLOCK >= 16_384:
                yield drain()
        if held:
            close()
        out.extend((region, dims, first, to, 0, [], low.tobytes(), high.tobytes(), b"")
                   for dims, (first, to, low, high) in zones.items())
        if out:
            yield drain()

    return points.repartitionByRange(regions, *order).sortWithinPartitions(*order).select(
        "id", "label", "dims", "point").mapInArrow(run, _BLOCKS)


# ---------------------------------------------------------------- bounds

def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest score each anchor can have with a vector between `low` and `high` of each zone.

    In doubles, widened by more than their rounding.
    """
    anchors, low, high = (np.asarray(m, np.float64) for m in (anchors, low, high))
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    least = plus @ low.T + minus @ high.T
    most = plus @ high.T + minus @ low.T
    slack = 1e-9 * (plus @ np.maximum(abs(low), abs(high)).T - minus @ np.maximum(abs(low), abs(high)).T)
    return np.floor(least - slack), np.ceil(most + slack)


def products(anchors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact integer inner products, through doubles where these hold every partial sum."""
    dims = anchors.shape[1]
    largest = float(abs(anchors).max(initial=0)) * float(abs(points).max(initial=0)) * max(dims, 1)
    if largest < 2.0 ** 53:
        return (anchors.astype(np.float64) @ points.astype(np.float64).T).astype(np.int64)
    return anchors.astype(np.int64) @ points.astype(np.int64).T


class Best:
    """The `k` highest scores of every slot, equal ones by smaller id; candidates gather and are cut back in bulk."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.astype(np.int64).copy()  # the least score that still counts, per slot
        self._kept = [np.zeros(0, np.int64)] * 3
        self._new: list[list[np.ndarray]] = []
        self._size = 0

    def add(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(slots):
            self._new.append([slots, scores, ids])
            self._size += len(slots)
            if self._size > 4 * self.k * len(self.floors) + 20_000:
                self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self._new:
            slots, scores, ids = (np.concatenate(parts) for parts in zip(self._kept, *self._new))
            order = np.lexsort((ids, -scores, slots))
            slots, scores, ids = slots[order], scores[order], ids[order]
            first = np.searchsorted(slots, slots, "left")
            place = np.arange(len(slots)) - first
            full = place == self.k - 1
            self.floors[slots[full]] = np.maximum(self.floors[slots[full]], scores[full])
            keep = place < self.k
            self._kept = [slots[keep], scores[keep], ids[keep]]
            self._new, self._size = [], 0
        return tuple(self._kept)


# ---------------------------------------------------------------- the two passes

_ANCHORS = "key bigint, id bigint, label bigint, dims int, point binary, floors array<bigint>, tops array<bigint>"
_FOUND = "key bigint, slot int, other bigint, score bigint"
_LOWEST = -(1 << 62)


def _routes(anchors: DataFrame, blocks: DataFrame, same_label: bool) -> DataFrame:
    """Anchors with the regions whose zone maps their windows may reach, a row per region."""
    zones = blocks.where("n = 0").select("region", "dims", "label", "label_to", "low", "high")
    count, size, regions = zones.agg(
        F.count("*"), F.coalesce(F.sum(F.length("low") + F.length("high")), F.lit(0)), F.max("region")).first()
    if count == 0:
        return anchors.withColumn("region", F.lit(0)).limit(0)
    if size + 40 * count > ZONE_BYTES:
        return anchors.withColumn("region", F.explode(F.sequence(F.lit(0), F.lit(regions))))
    known: dict[int, list] = {}
    for region, dims, label, label_to, low, high in zones.collect():
        known.setdefault(dims, []).append(
            (region, label, label_to, np.frombuffer(low, "<i4"), np.frombuffer(high, "<i4")))
    maps = {dims: tuple(np.array(column) for column in zip(*rows)) for dims, rows in known.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                lengths = np.array(batch.column("dims").to_pylist(), np.int64)
                for dims in np.unique(lengths).tolist():
                    region, label, label_to, low, high = maps[dims]
                    part = batch.take(pa.array(np.flatnonzero(lengths == dims)))
                    vectors, labels, floors, tops = _decoded(part, dims)
                    least, most = bounds(vectors, low, high)
                    reached = (most >= floors.min(axis=1)[:, None]) & (least <= tops.max(axis=1)[:, None])
                    inside = (label <= labels[:, None]) & (labels[:, None] <= label_to)
                    alone = inside & (label == label_to)
                    rows, at = np.nonzero(reached & (inside if same_label else ~alone))
                    routed = part.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [*routed.columns, pa.array(region[at], pa.int32())], [*routed.schema.names, "region"])

    return anchors.mapInArrow(run, _ANCHORS + ", region int")


def _decoded(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, ...]:
    vectors = np.frombuffer(b"".join(batch.column("point").to_pylist()), "<i4").reshape(batch.num_rows, dims)
    labels = np.array(batch.column("label").to_pylist(), np.int64)
    floors, tops = (np.array(batch.column(name).to_pylist(), np.int64).reshape(batch.num_rows, -1)
                    for name in ("floors", "tops"))
    return vectors, labels, floors, tops


def _search(batch: pa.RecordBatch, region: list[tuple], same_label: bool, k: int) -> pa.RecordBatch | None:
    """The best `k` of each window of the anchors of a batch (of one length) in the blocks of a region."""
    dims = batch.column("dims")[0].as_py()
    blocks = [block for block in region if block[0] == dims]
    if not blocks:
        return None
    vectors, labels, floors, tops = _decoded(batch, dims)
    own = np.array(batch.column("id").to_pylist(), np.int64)
    windows = floors.shape[1]
    best = Best(floors.ravel(), k)
    block_labels = np.array([block[1] for block in blocks])
    least, most = bounds(vectors, *(np.array([np.frombuffer(block[i], "<i4") for block in blocks]).reshape(len(blocks), dims)
                                    for i in (3, 4)))
    right_label = (labels[:, None] == block_labels) == same_label
    # The blocks that may hold the highest scores come first, so that the floors rise soon.
    for b in np.argsort(-np.where(right_label, most, -np.inf).max(axis=0), kind="stable").tolist():
        now = best.floors.reshape(-1, windows)
        # A window is out of reach if all of the block's scores are above or below what still counts.
        alive = right_label[:, b] & ((most[:, b, None] >= now) & (least[:, b, None] <= tops)).any(axis=1)
        at = np.flatnonzero(alive)
        if not len(at):
            continue
        ids = np.asarray(blocks[b][2], np.int64)
        points = np.frombuffer(blocks[b][5], "<i4").reshape(len(ids), dims)
        scores = products(vectors[at], points)
        other = own[at][:, None] != ids
        for window in range(windows):
            fits = other & (scores >= now[at, window][:, None]) & (scores <= tops[at, window][:, None])
            rows, columns = np.nonzero(fits)
            best.add(at[rows] * windows + window, scores[rows, columns], ids[columns])
        best.cut()
    slots, scores, ids = best.cut()
    keys = np.array(batch.column("key").to_pylist(), np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[slots // windows], pa.int64()), pa.array(slots % windows, pa.int32()), pa.array(ids),
         pa.array(scores)], ["key", "slot", "other", "score"])


def _pass(anchors: DataFrame, blocks: DataFrame, same_label: bool, k: int) -> DataFrame:
    """(key, slot, other, score, rank): the best `k` of every window over all regions."""
    whole = blocks.where("n > 0").select(
        "region", F.lit(0).alias("kind"), "dims", "label", "ids", "low", "high", "points",
        F.lit(None).cast("bigint").alias("key"), F.lit(None).cast("bigint").alias("id"),
        *[F.lit(None).cast("array<bigint>").alias(name) for name in ("floors", "tops")])
    routed = _routes(anchors, blocks, same_label).select(
        "region", F.lit(1).alias("kind"), "dims", "label", F.lit(None).cast("array<bigint>").alias("ids"),
        F.lit(None).cast("binary").alias("low"), F.lit(None).cast("binary").alias("high"),
        F.col("point").alias("points"), "key", "id", "floors", "tops")
    regions = (blocks.agg(F.max("region")).first()[0] or 0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, region = None, []
        for whole in batches:
            kinds = np.array(whole.column("kind").to_pylist()) if whole.num_rows else np.zeros(0)
            places = np.array(whole.column("region").to_pylist())
            lengths = np.array(whole.column("dims").to_pylist())
            at = 0
            while at < whole.num_rows:
                if places[at] != here:
                    here, region = int(places[at]), []
                if kinds[at] == 0:
                    region.append(tuple(whole.column(name)[at].as_py()
                                        for name in ("dims", "label", "ids", "low", "high", "points")))
                    at += 1
                    continue
                most_rows = max(1, SCORE_BYTES // (8 * max(BLOCK, len(region))))
                to = at + 1
                while (to < whole.num_rows and to - at < most_rows and places[to] == here and kinds[to] == 1
                       and lengths[to] == lengths[at]):
                    to += 1
                batch = whole.slice(at, to - at).select(["key", "id", "label", "dims", "points", "floors", "tops"])
                found = _search(batch.rename_columns(["key", "id", "label", "dims", "point", "floors", "tops"]),
                                region, same_label, k)
                if found is not None and found.num_rows:
                    yield found
                at = to

    rows = whole.unionByName(routed).repartitionById(regions, F.col("region"))
    found = rows.sortWithinPartitions("region", "kind", "dims").mapInArrow(run, _FOUND)
    best = Window.partitionBy("key", "slot").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least_share: tuple[int, int] = (4, 5), scale: float = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of `rows` (id, label, vector).

    The anchors are the rows for which `is_anchor`, a condition on the id, holds. A negative of
    an anchor and a positive has another label than the anchor, and a score of at most the
    positive's and of at least `least_share` (numerator, denominator) of it.
    """
    over, under = least_share
    points = stage(integer_points(rows, scale), "points")
    blocks = stage(blocks_of(points, slots_for(points, REGION_BYTES, LEAST_REGIONS)), "blocks")
    chosen = points.where(is_anchor).select(
        F.xxhash64("id", "label", "point").alias("key"), "id", "label", "dims", "point").dropDuplicates(["key"])
    chosen = stage(chosen, "anchors")
    anchors = chosen.withColumns({
        "floors": F.array(F.lit(_LOWEST).cast("bigint")), "tops": F.array(F.lit(-_LOWEST).cast("bigint"))})
    near = stage(_pass(anchors, blocks, True, positives).drop("slot"), "positives")
    # Windows in the order of the positives; the least score that counts is the share, rounded up.
    floor = F.expr(f"(score * {over}L) div {under}L + CAST((score * {over}L) % {under}L > 0 AS bigint)")
    windows = near.groupBy("key").agg(F.sort_array(F.collect_list(
        F.struct("rank", floor.alias("floor"), "score"))).alias("w"))
    windowed = chosen.join(windows, "key").withColumns({
        "floors": F.col("w.floor"), "tops": F.col("w.score")}).drop("w")
    # Arrays of one length, so that a batch is a matrix: a window from above to below holds nothing.
    pad = F.array_repeat(F.lit(-_LOWEST).cast("bigint"), F.lit(positives) - F.size("tops"))
    windowed = windowed.withColumns({
        "floors": F.concat("floors", pad),
        "tops": F.concat("tops", F.transform(pad, lambda value: -value))})
    hard = _pass(windowed, blocks, False, negatives)
    pairs = near.select("key", F.col("other").alias("positive_id"), F.col("score").alias("positive_score"),
                        (F.col("rank") - 1).alias("slot"))
    return hard.join(pairs, ["key", "slot"]).join(chosen.select("key", F.col("id").alias("anchor_id")), "key").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


# ---------------------------------------------------------------- the registered query

ANCHOR_EVERY = 100
RELABEL_EVERY = 7
LABELS = 10


def op11_hard_negatives(embeddings: DataFrame) -> DataFrame:
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    rows = embeddings.select(F.col("vec_id").alias("id"), moved.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives(rows, F.col("id") % ANCHOR_EVERY == 0)


OP11_SQL = f"""
WITH rows AS (
    SELECT vec_id AS id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
           [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
anchors AS (SELECT * FROM rows WHERE id % {ANCHOR_EVERY} = 0),
scored AS (
    SELECT a.id AS anchor_id, r.id, a.label = r.label AS same,
           CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.v, r.v)]) AS BIGINT) AS score
    FROM anchors a JOIN rows r ON a.id <> r.id),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= {NEGATIVES}"""
