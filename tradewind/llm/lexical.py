"""Ranked lexical search over a document FP-tree.

A document is restricted to the terms that any item asks for. In every part of the corpus
the restricted documents form an FP-tree: their terms, the most frequent of the part first,
are the path from the root, so documents that begin with the same frequent terms share it.
A branch of at most LEAF documents is kept as a bucket of documents. Every node knows, for
each term of its subtree, the greatest tf, and the least length measure m; the score grows
with tf and falls with m, so these give the highest score an item can have below the node.
Items go down the tree depth-first, branches with the higher bounds first, and leave a
branch out when its bound is below the last of their best documents so far.

Corpus statistics come from all documents: how many have a term, how many terms they have,
and how many documents hold each term that is asked for. What is shipped to read the texts
is a bitmap of 2^BITMAP_BITS hashed terms, whatever the number of items; a term it lets
through by chance belongs to no item and adds nothing. Restricted documents are dealt in
turn to parts of about PART_BYTES, one per task; the items are streamed past each tree and
every part returns at most `k` documents an item.

Terms are known by 64-bit numbers: two of n terms share one with probability n^2 / 2^65.

Defined cases: a NULL or empty text, or one without a term, is no document and no item; it
counts nowhere. Repeated documents, also those with one id, are all ranked; equal scores are
ordered by id, a NULL id last. Items equal in id and text count once. An empty table on
either side gives no rows. Very long texts are read whole, a few at a time. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import slots_for, stage, text_slices

TOP = 20
BITMAP_BITS = 22
PART_BYTES = 24 << 20
LEAST_PARTS = 8
LEAF = 32
# Terms of the items that go down a tree together.
ITEM_TERMS = 1 << 16
_UNITS = 1 << 20  # documents of a task are dealt to this many places in turn

# Of one-byte characters only digits and letters belong to terms; A-Z become a-z.
_TERM_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))


def terms_of(text: str) -> list[bytes]:
    """The terms of a text, repeats included, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def _numbered(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all terms of the texts in a row, and how many each text has."""
    lists = [terms_of(text) if text else [] for text in texts]
    flat = list(chain.from_iterable(lists))
    table = {term: xxhash.xxh3_64_intdigest(term) for term in dict.fromkeys(flat)}
    return (np.fromiter(map(table.__getitem__, flat), np.uint64, len(flat)).view(np.int64),
            np.fromiter(map(len, lists), np.int64, len(lists)))


def _counted(numbers: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number, times) of every distinct number of a row, by row and number."""
    rows = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((numbers, rows))
    rows, numbers = rows[order], numbers[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (numbers[1:] != numbers[:-1])
    at = np.flatnonzero(first)
    return rows[at], numbers[at], np.diff(np.append(at, len(rows)))


def _lists(rows: np.ndarray, values: np.ndarray, count: int, kind: pa.DataType) -> pa.ListArray:
    offsets = np.searchsorted(rows, np.arange(count + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def item_terms(items: DataFrame) -> DataFrame:
    """(key, item_id, term, times) of `items` (item_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole):
                rows, numbers, times = _counted(*_numbered(batch.column("text").to_pylist()))
                place = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(place), batch.column("item_id").take(place), pa.array(numbers),
                     pa.array(times, pa.int32())], ["key", "item_id", "term", "times"])

    distinct = items.where("text IS NOT NULL").select(
        F.xxhash64("item_id", "text").alias("key"), "item_id", "text").dropDuplicates(["key"])
    kind = items.schema["item_id"].dataType.simpleString()
    return distinct.mapInArrow(run, f"key bigint, item_id {kind}, term bigint, times int")


def term_bitmap(terms: DataFrame) -> bytes:
    """A bit for each value of the lowest BITMAP_BITS bits of `term`; its size is fixed."""
    place = F.col("term").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)) + 1
    buckets = terms.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    bits = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    width = 4096  # bytes of a bitmap of Spark
    for bucket, part in buckets:
        bits[(bucket - 1) * width:(bucket - 1) * width + len(part)] = np.frombuffer(part, np.uint8)
    return bits.tobytes()


def restricted(docs: DataFrame, bitmap: bytes) -> DataFrame:
    """(doc_id, n, terms, tfs, place) of the documents with a term; only terms of the bitmap are kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little").astype(bool)
        place = TaskContext.get().partitionId() * 7919
        for whole in batches:
            for batch in text_slices(whole):
                numbers, lengths = _numbered(batch.column("text").to_pylist())
                keep = known[numbers & ((1 << BITMAP_BITS) - 1)]
                owners = np.repeat(np.arange(len(lengths)), lengths)[keep]
                rows, numbers, times = _counted(numbers[keep], np.bincount(owners, minlength=len(lengths)))
                out = pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(lengths), _lists(rows, numbers, len(lengths), pa.int64()),
                     _lists(rows, times, len(lengths), pa.int32()),
                     pa.array((place + np.arange(len(lengths))) % _UNITS, pa.int32())],
                    ["doc_id", "n", "terms", "tfs", "place"])
                place += len(lengths)
                yield out.filter(pa.array(lengths > 0))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n bigint, terms array<bigint>, tfs array<int>, place int")


# ---------------------------------------------------------------- the tree

def share(tf: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    """What a term of weight 1 adds to a score; it grows with tf and falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Node:
    """A branch: the documents at places start..end of the tree's order, as children or as a bucket."""

    __slots__ = ("start", "end", "terms", "most", "least_m", "children")

    def __init__(self, start: int, end: int):
        self.start, self.end, self.children = start, end, []


class FpTree:
    """The FP-tree of restricted documents, which are numbered in the order of their ids."""

    def __init__(self, m: np.ndarray, offsets: np.ndarray, terms: np.ndarray, tfs: np.ndarray, leaf: int = LEAF):
        self.leaf = leaf
        self.vocabulary, local, frequency = np.unique(terms, return_inverse=True, return_counts=True)
        rank = np.empty(len(self.vocabulary), np.int64)
        rank[np.argsort(-frequency, kind="stable")] = np.arange(len(self.vocabulary))
        ranks = rank[local]
        owners = np.repeat(np.arange(len(m)), np.diff(offsets))
        order = np.lexsort((ranks, owners))  # paths: the most frequent term first
        paths, path_tfs = ranks[order], tfs[order].astype(np.int64)
        # Documents in the order of their paths; bytes of fixed width compare as the numbers do.
        wide = paths.astype(">u4").tobytes()
        keys = [wide[4 * a:4 * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        self.docs = np.array(sorted(range(len(m)), key=keys.__getitem__), np.int64)
        lengths = np.diff(offsets)[self.docs]
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        source = np.repeat(offsets[self.docs] - self.offsets[:-1], lengths) + np.arange(self.offsets[-1])
        self.paths, self.tfs, self.m = paths[source], path_tfs[source], m[self.docs]
        self.rank_of = rank
        self.root = Node(0, len(m))
        self._grow(self.root)

    def _grow(self, root: Node) -> None:
        """Split branches at their next term until they are small; then fill in the bounds from below."""
        grown, todo = [], [(root, 0)]
        while todo:
            node, depth = todo.pop()
            grown.append(node)
            if node.end - node.start <= self.leaf:
                continue
            starts = self.offsets[node.start:node.end] + depth
            ended = starts >= self.offsets[node.start + 1:node.end + 1]
            step = np.where(ended, -1, self.paths[np.minimum(starts, max(len(self.paths) - 1, 0))] if len(self.paths) else -1)
            if ended.all():
                # Equal paths: nothing is left to split by, so cut in pieces.
                cuts = list(range(node.start, node.end, self.leaf)) + [node.end]
                node.children = [Node(a, b) for a, b in zip(cuts, cuts[1:])]
                grown.extend(node.children)
                continue
            cuts = [node.start, *(np.flatnonzero(np.diff(step)) + 1 + node.start).tolist(), node.end]
            if len(cuts) == 2:
                todo.append((node, depth + 1))  # one child: the path goes on in the same node
                grown.pop()
                continue
            held = cuts[0]
            for a, b in zip(cuts, cuts[1:]):
                # Small neighbours share a bucket.
                if b - held > self.leaf:
                    if a > held:
                        child = Node(held, a)
                        node.children.append(child)
                        grown.append(child)
                    held = a
                    if b - a > self.leaf:
                        child = Node(a, b)
                        node.children.append(child)
                        todo.append((child, depth + 1 if step[a - node.start] >= 0 else depth))
                        held = b
            if held < node.end:
                child = Node(held, node.end)
                node.children.append(child)
                grown.append(child)
        for node in sorted(grown, key=lambda node: node.end - node.start):
            if node.children:
                terms = np.concatenate([child.terms for child in node.children])
                most = np.concatenate([child.most for child in node.children])
                node.least_m = min(child.least_m for child in node.children)
            else:
                inside = slice(self.offsets[node.start], self.offsets[node.end])
                terms, most = self.paths[inside], self.tfs[inside]
                node.least_m = int(self.m[node.start:node.end].min(initial=1 << 60))
            order = np.lexsort((-most, terms))
            terms, most = terms[order], most[order]
            first = np.ones(len(terms), bool)
            first[1:] = terms[1:] != terms[:-1]
            node.terms, node.most = terms[first], most[first]

    def search(self, offsets: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int):
        """(item, document, score) of the `k` best documents of every item, items given as rows of terms and weights."""
        count = len(offsets) - 1
        at = np.searchsorted(self.vocabulary, terms)
        at[at == len(self.vocabulary)] = 0
        here = self.vocabulary[at] == terms if len(self.vocabulary) else np.zeros(len(terms), bool)
        owners = np.repeat(np.arange(count), np.diff(offsets))[here]
        ranks, weights = self.rank_of[at[here]], weights[here]
        starts = np.searchsorted(owners, np.arange(count + 1))
        best_score = np.zeros((count, k), np.int64)
        best_doc = np.full((count, k), np.iinfo(np.int64).max)
        buffer = np.zeros(len(self.vocabulary), np.int64)

        def chosen(items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Places of the terms of some items, and where each item begins among them."""
            lengths = starts[items + 1] - starts[items]
            begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            return np.repeat(starts[items] - begin, lengths) + np.arange(lengths.sum()), begin

        def reach(node: Node, items: np.ndarray) -> np.ndarray:
            """The highest score each item can have below the node."""
            buffer[node.terms] = share(node.most, node.least_m)
            places, begin = chosen(items)
            out = np.add.reduceat(buffer[ranks[places]] * weights[places], begin)
            buffer[node.terms] = 0
            return out

        items = np.flatnonzero(starts[1:] > starts[:-1])
        stack = [(self.root, items, reach(self.root, items))] if len(items) and len(self.docs) else []
        while stack:
            node, items, bound = stack.pop()
            last = best_score[items, k - 1]
            items = items[(bound > 0) & (bound >= last)]
            if not len(items):
                continue
            if node.children:
                bounds = [reach(child, items) for child in node.children]
                # The branch with the highest bounds is gone down first, so it is put on the stack last.
                for i in sorted(range(len(bounds)), key=lambda i: int(bounds[i].sum())):
                    stack.append((node.children[i], items, bounds[i]))
                continue
            size = node.end - node.start
            inside = slice(self.offsets[node.start], self.offsets[node.end])
            row = np.repeat(np.arange(size), np.diff(self.offsets[node.start:node.end + 1]))
            matrix = np.zeros((size, len(self.vocabulary)), np.int64) if size * len(self.vocabulary) <= 1 << 22 else None
            places, begin = chosen(items)
            if matrix is not None:
                matrix[row, self.paths[inside]] = share(self.tfs[inside], self.m[node.start:node.end][row])
                scores = np.add.reduceat(matrix[:, ranks[places]] * weights[places], begin, axis=1).T
            else:
                scores = np.empty((len(items), size), np.int64)
                for i in range(size):
                    own = slice(self.offsets[node.start + i], self.offsets[node.start + i + 1])
                    buffer[self.paths[own]] = share(self.tfs[own], self.m[node.start + i])
                    scores[:, i] = np.add.reduceat(buffer[ranks[places]] * weights[places], begin)
                    buffer[self.paths[own]] = 0
            gains = scores.max(axis=1) >= np.maximum(best_score[items, k - 1], 1)
            items, scores = items[gains], scores[gains]
            if not len(items):
                continue
            scores = np.concatenate([best_score[items], scores], axis=1)
            found = np.concatenate(
                [best_doc[items], np.broadcast_to(self.docs[node.start:node.end], (len(items), size))], axis=1)
            order = np.lexsort((found, -scores), axis=1)[:, :k]
            best_score[items] = np.take_along_axis(scores, order, 1)
            best_doc[items] = np.take_along_axis(found, order, 1)
        item, place = np.nonzero(best_score > 0)
        return item, best_doc[item, place], best_score[item, place]


# ---------------------------------------------------------------- the search on Spark

def ranked(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` best of `docs` (doc_id, text) for each of `items` (item_id, text)."""
    asked = stage(item_terms(items), "asked")
    known = stage(restricted(docs, term_bitmap(asked.select("term").distinct())), "restricted")
    count, total = known.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = known.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    # One row per item: its terms and their weights, repeats counted in.
    weight = F.floor(1000 * F.log((2 * F.lit(count) + 2) / (2 * F.col("df") + 1))).cast("bigint") * F.col("times")
    weighted = asked.join(held, "term").select("key", "item_id", "term", weight.alias("weight")).where("weight > 0")
    rows = weighted.groupBy("key").agg(
        F.first("item_id").alias("item_id"), F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("w"))
    parts = slots_for(known, PART_BYTES, LEAST_PARTS)
    m = F.lit(100 - 25).cast("bigint") + F.expr(f"(25L * n * {count}L) div {max(total, 1)}L")
    # Documents of a part come first, then all items.
    whole = known.select(
        (F.col("place") % parts).alias("part"), F.lit(0).alias("kind"), "doc_id", m.alias("m"), "terms", "tfs",
        F.lit(None).cast("bigint").alias("key"), F.lit(None).cast("array<bigint>").alias("weights"))
    asking = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("kind"),
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.lit(None).cast("bigint").alias("m"),
        F.col("w.term").alias("terms"), F.lit(None).cast("array<int>").alias("tfs"), "key",
        F.col("w.weight").alias("weights"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, tree, ids = None, [], None, None
        for whole in batches:
            places, kinds = (np.array(whole.column(name).to_pylist()) for name in ("part", "kind"))
            cuts = np.flatnonzero((np.diff(places) != 0) | (np.diff(kinds) != 0)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), whole.num_rows]):
                if start == end:
                    continue
                if places[start] != here:
                    here, held, tree, ids = int(places[start]), [], None, None
                batch = whole.slice(start, end - start)
                if kinds[start] == 0:
                    held.append(batch.select(["doc_id", "m", "terms", "tfs"]))
                    continue
                if tree is None and held:
                    table = pa.Table.from_batches(held).combine_chunks()
                    held = []
                    table = table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending")]))
                    ids = table.column("doc_id")
                    terms, tfs = table.column("terms").combine_chunks(), table.column("tfs").combine_chunks()
                    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(terms).to_numpy())]).astype(np.int64)
                    tree = FpTree(table.column("m").to_numpy(), offsets, terms.flatten().to_numpy(), tfs.flatten().to_numpy())
                if tree is None:
                    continue
                for part in _term_slices(batch):
                    terms = part.column("terms")
                    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(terms).to_numpy())]).astype(np.int64)
                    item, doc, score = tree.search(
                        offsets, terms.flatten().to_numpy(), part.column("weights").flatten().to_numpy(), k)
                    if len(item):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(item), here, np.int32)), part.column("key").take(pa.array(item)),
                             ids.take(pa.array(doc)).combine_chunks(), pa.array(score)], ["part", "key", "doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = (
        whole.unionByName(asking).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "kind")
        .mapInArrow(run, f"part int, key bigint, doc_id {kind}, score bigint"))
    # The best of 64 parts at a time, then the best of all.
    for part in ([F.floor(F.col("part") / 64).alias("part")] if parts > 64 else []):
        found = _best(found.select(part, "key", "doc_id", "score"), ["part", "key"], k).drop("rank")
    return _best(found, ["key"], k).join(rows.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _term_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    lengths = pc.list_value_length(batch.column("terms")).to_pylist()
    start, held = 0, 0
    for i, length in enumerate(lengths):
        if held and held + length > ITEM_TERMS:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += length
    if start < batch.num_rows:
        yield batch.slice(start)


def op13_ranked_search(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return ranked(documents.select("doc_id", "text"), benchmark.select("item_id", "text"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = (f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),"
          r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
OP13_SQL = rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
docs AS (SELECT r, doc_id, t, CAST(len(t) AS BIGINT) AS n FROM texts WHERE len(t) > 0),
corpus AS (SELECT COUNT(*) AS big_n, CAST(SUM(n) AS BIGINT) AS l FROM docs),
tf AS (SELECT r, term, COUNT(*) AS tf FROM (SELECT r, unnest(t) AS term FROM docs) GROUP BY 1, 2),
df AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY 1),
items AS (SELECT DISTINCT item_id, text FROM benchmark),
asked AS (SELECT item_id, text, term, COUNT(*) AS times
          FROM (SELECT item_id, text, unnest({_TERMS}) AS term FROM items) GROUP BY 1, 2, 3),
weights AS (SELECT item_id, text, asked.term, times * CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w
            FROM asked JOIN df ON asked.term = df.term, corpus),
scored AS (
    SELECT item_id, weights.text, tf.r, doc_id,
           CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // l)))) AS BIGINT) AS score
    FROM weights JOIN tf ON weights.term = tf.term JOIN docs ON docs.r = tf.r, corpus GROUP BY 1, 2, 3, 4)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {TOP}"""
