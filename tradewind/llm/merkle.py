"""Document fingerprints: a Merkle tree over the sections and paragraphs of a text.

The leaves are content-defined pieces of a paragraph (they end with a space after a byte
divisible by PIECE, about every fourth word, so an edit changes the pieces it touches and no others), their hashes
make the hash of the paragraph (a line), paragraphs make sections (which end after a
paragraph whose hash is divisible by SECTION), sections make the root. Equal roots mean
equal texts; where roots differ, only differing branches have to be followed to find the
edits. The fingerprint is the root and a sketch of the leaves, the SKETCH smallest of
their hashes, so its size is bounded and two fingerprints tell how alike the texts are.

Defined cases: a NULL text counts as empty, and the empty text has a root without leaves.
For the next document rows are in order of descending id, then of the text; NULL ids come
last, and the first row follows the last.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.common import slots_for, text_slices

PIECE, SECTION, SKETCH = 4, 4, 96
_HASH_HEX = 8


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


@dataclass(frozen=True)
class Node:
    """A branch: its hash, its place in the text in code points, and what it is made of."""

    hash: bytes
    start: int
    end: int
    children: tuple["Node", ...] = ()


# A piece ends with a space that follows a byte divisible by PIECE, or with its line.
_PIECE = re.compile(b"(?s).+?(?:[" + b"".join(re.escape(bytes([b])) for b in range(0x21, 0x100) if b % PIECE == 0) + b"] |\\Z)")


def _pieces(line: bytes) -> list[bytes]:
    """The content-defined pieces of a line; joined they are the line."""
    return _PIECE.findall(line)


def tree(text: str) -> Node:
    """The whole tree of a text."""
    sections, paragraphs, at = [], [], 0
    for line in text.split("\n"):
        leaves, place = [], at
        for piece in _pieces(line.encode()):
            end = place + len(piece.decode())
            leaves.append(Node(_hash(b"\x00" + piece), place, end))
            place = end
        paragraph = Node(_hash(b"\x01" + b"".join(leaf.hash for leaf in leaves)), at, at + len(line), tuple(leaves))
        paragraphs.append(paragraph)
        at += len(line) + 1
        if paragraph.hash[0] % SECTION == 0:
            sections.append(paragraphs)
            paragraphs = []
    if paragraphs:
        sections.append(paragraphs)
    branches = tuple(Node(_hash(b"\x02" + b"".join(p.hash for p in held)), held[0].start, held[-1].end, tuple(held))
                     for held in sections)
    return Node(_hash(b"\x03" + b"".join(branch.hash for branch in branches)), 0, len(text), branches)


def differing(a: Node, b: Node) -> list[tuple[int, int]]:
    """Places of `a`, in code points, whose leaves are not in `b`; equal branches are not entered."""
    if a.hash == b.hash:
        return []
    known = {node.hash for node in _nodes(b)}
    out: list[tuple[int, int]] = []

    def follow(node: Node) -> None:
        if node.hash in known:
            return
        if not node.children:
            out.append((node.start, node.end))
        for child in node.children:
            follow(child)

    follow(a)
    return out


def _nodes(node: Node) -> Iterator[Node]:
    yield node
    for child in node.children:
        yield from _nodes(child)


@lru_cache(maxsize=512)  # an edited text is made of lines of its own text and the next
def _leaf_hashes(line: str) -> list[bytes]:
    return [_hash(b"\x00" + piece) for piece in _pieces(line.encode())]


def fingerprint(text: str) -> str:
    """32 hex digits of the root, then 8 of each of the smallest leaf hashes, equal leaves numbered apart."""
    root, section, seen, leaves = [], [], {}, []
    for line in text.split("\n"):
        hashes = _leaf_hashes(line)
        for leaf in hashes:
            times = seen[leaf] = seen.get(leaf, -1) + 1
            leaves.append(leaf[:4] if not times else _hash(leaf + times.to_bytes(4, "big"))[:4])
        paragraph = _hash(b"\x01" + b"".join(hashes))
        section.append(paragraph)
        if paragraph[0] % SECTION == 0:
            root.append(_hash(b"\x02" + b"".join(section)))
            section = []
    if section:
        root.append(_hash(b"\x02" + b"".join(section)))
    top = _hash(b"\x03" + b"".join(root))
    return top.hex() + b"".join(sorted(leaves if text else [])[:SKETCH]).hex()


def likeness(a: str, b: str) -> float:
    """Share of leaves two fingerprints have in common, 1 for equal texts.

    Up to the smaller of the two largest hashes of full sketches both sketches know all
    leaves; twice the common ones over all known ones estimates the share.
    """
    if a == b:
        return 1.0
    x, y = ([s[i:i + _HASH_HEX] for i in range(32, len(s), _HASH_HEX)] for s in (a, b))
    if not x or not y:
        return 0.0
    limit = min([s[-1] for s in (x, y) if len(s) >= SKETCH], default="g")
    x, y = [h for h in x if h <= limit], [h for h in y if h <= limit]
    # Different roots are not quite alike, whatever the sketch says.
    return min(2 * len(set(x) & set(y)) / max(len(x) + len(y), 1), 0.9999)


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, text: str = "text", to: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of every text; no shuffle."""
    schema = T.StructType([*docs.drop(to).schema.fields, T.StructField(to, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(value or "") for value in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.string())], [*batch.schema.names, to])

    return docs.drop(to).mapInArrow(run, schema)


# Bytes of input (compressed) in a range of ids.
RANGE_BYTES = 16 << 20


def with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, text, _range, _rank, _edge): documents in ranges of descending id, each range with its follower.

    One id per range comes to the driver. The texts are shuffled once; a copy of the first
    document of each range goes along to the range before, as its last row (`_edge`). NULL ids
    come after all others, in ranges by a hash of the text.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = slots_for(docs, range_bytes)
    bounds = [] if parts == 1 else sorted(set(docs.select("doc_id").approxQuantile(
        "doc_id", [i / parts for i in range(1, parts)], 0.2 / parts)), reverse=True)
    inside = F.size(F.filter(F.lit(bounds), lambda bound: F.col("doc_id") < bound)) if bounds else F.lit(0)
    hashed = F.pmod(F.xxhash64("text"), F.lit(parts)) + len(bounds) + 1
    ranged = docs.withColumns({
        "_range": F.when(F.col("doc_id").isNull(), hashed).otherwise(inside).cast("int"), "_edge": F.lit(False)})
    # The first row of a range has its largest id and, of rows with that id, the smallest text.
    tops = dict(ranged.groupBy("_range").agg(F.max("doc_id")).collect())
    order = sorted(tops)
    if order:
        # A row of three numbers for each range: where its first document goes as the follower.
        follows = docs.sparkSession.createDataFrame(
            [(this, tops[this], last) for last, this in zip([order[-1], *order[:-1]], order)],
            T.StructType([T.StructField("_of", T.IntegerType()), T.StructField("_top", docs.schema["doc_id"].dataType),
                          T.StructField("_to", T.IntegerType())]))
        first = (F.col("_range") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_top"))
        edges = ranged.join(F.broadcast(follows), first).groupBy(F.col("_to").alias("_range")).agg(
            F.max("doc_id").alias("doc_id"), F.min("text").alias("text"), F.lit(True).alias("_edge"))
        ranged = ranged.unionByName(edges)
    return ranged.repartitionById(max(order, default=0) + 1, F.col("_range")).sortWithinPartitions(
        "_range", "_edge", F.col("doc_id").desc_nulls_last(), "text")


def op7_merkle_fingerprints(docs: DataFrame) -> DataFrame:
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(
        "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double").fields])

    def row(doc_id, text: str, own: str, following: str, next_own: str) -> tuple:
        edited = edited_text(text, following)
        edited_own = fingerprint(edited)
        return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, edited_own,
                likeness(own, edited_own), likeness(own, next_own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the last row seen, until the row after it is
        for whole in batches:
            for batch in text_slices(whole):
                rows = []
                for doc_id, text, part, edge in zip(*(batch.column(i).to_pylist() for i in range(4))):
                    own = fingerprint(text)
                    if waiting is not None and waiting[3] == part:
                        rows.append(row(waiting[0], waiting[1], waiting[2], text, own))
                    waiting = None if edge else (doc_id, text, own, part)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values, field.type) for values, field in zip(zip(*rows), ARROW)], schema.names)

    ARROW = [*_arrow_fields(docs.schema["doc_id"])]
    return with_next(docs).select("doc_id", "text", "_range", "_edge").mapInArrow(run, schema)


def _arrow_fields(doc_id: T.StructField) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [pa.field("doc_id", to_arrow_type(doc_id.dataType)), pa.field("n_chars", pa.int64()),
            *(pa.field(name, pa.string()) for name in ("edited_sha256", "fingerprint", "edited_fingerprint")),
            *(pa.field(name, pa.float64()) for name in ("near_edited", "near_next"))]
