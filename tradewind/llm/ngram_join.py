"""N-gram Jaccard join: which texts have word shingle sets of Jaccard similarity 0.75 or more.

Texts with equal sets are one class. A class is listed under its prefix, the rarest
quarter of its shingles: two sets that reach the similarity have a number T of prefix shingles
in common that follows from their sizes, a tenth of a set or so. The order is that of the whole
corpus: shingles are counted in slots of a sketch of fixed size, which adds up over the tasks.

Candidates of a class share a list with it. They are an inverted index of prefix shingles, on
which DivideSkip solves the T-occurrence problem: it merges the short lists with a heap,
probes the long ones by binary search, and keeps those that occur T times. Texts that have only
a passage in common do not. For the few that are left the same search runs over the whole
sets, with the overlap that the similarity asks for; only their sets are ever shuffled.

Components do not need all pairs. In two rounds each list compares its members with one
leader, first with the member that has the largest share of its shingles in lists, that is
the least edited one; then only members of a list that are still in different components are
compared, with the longest lists of the smaller one set aside. No link between
components is lost, and no group of copies is expanded into pairs.

Skew: frequent shingles stand at the end of the order. Those that are in prefixes all the
same are not shuffled by their number. Lists grow with the corpus, and the planner would
judge their staged files by compressed bytes, so they are never broadcast: their joins are merge
joins at every size, which adaptive execution can split. Candidates of one class are dealt to blocks of BLOCK.

Defined cases: a NULL or empty text has an empty set and is linked with nothing; repeated
rows and ids are rows of their own; the component of texts without an id has the smallest
id there is, or NULL. A table without rows gives none. Sets, texts and shingles are known by 64-bit
numbers, all of which are compared. Other columns are ignored. Of the largest texts a batch
of some megabytes is in memory at once.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.common import stage, text_slices
from tradewind.llm.components import components
from tradewind.llm.shingles import WIDTH, shingle_sets

# Jaccard similarity I / (x + y - I) >= 3/4 is 7 I >= 3 (x + y).
PERCENT = 75
# Slots in which shingles are counted to order them, and those of one row of counts.
SKETCH_BITS, SKETCH_PART = 18, 1 << 12
# Shingles of slots with so many more than three times the usual count are dealt by row.
OFTEN = 256
BLOCK = 256
# Slots of the broadcast bitmap of wanted texts; texts that share one are turned into shingles in vain, no more.
SLOTS = 1 << 22


def required(x: Column, y: Column) -> Column:
    return F.ceil((x + y) * 3 / 7)


def prefix_length(n: int) -> int:
    """A set of n shingles shares at least three quarters of them with any set it is linked with."""
    return n - -(-3 * n // 4) + 1


def set_number(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def divide_skip(lists: Sequence[Sequence[int]], thresholds: Sequence[int]) -> dict[int, int]:
    """Numbers that occur in at least thresholds[number] of the sorted lists, with their counts.

    The longest lists are set aside, fewer than the least threshold; what occurs in too few
    of the others cannot reach it. The others are merged by a heap, and the survivors looked
    up in the long lists, longest last, until the threshold is out of reach.
    """
    least = min(thresholds)
    order = sorted(lists, key=len)
    total = len(order)
    longest = len(order[-1]) if order else 0
    # The balance of merging against probing, after the published rule.
    aside = min(total, max(0, int(least / (0.0085 * np.log2(longest + 1) + 1)), 0)) if longest else 0
    aside = min(aside, max(least - 1, 0))
    short, long = order[:total - aside], order[total - aside:]
    out = {}
    for number, same in groupby(heapq.merge(*short)):
        count = sum(1 for _ in same)
        need = thresholds[number]
        if count + len(long) < need:
            continue
        for left, members in zip(range(len(long), 0, -1), long):
            if count + left < need:
                break
            place = bisect_left(members, number)
            count += place < len(members) and members[place] == number
        if count >= need:
            out[number] = count
    return out


def least_overlap(x: int, y: int) -> int:
    """Shingles that linked sets of these sizes have in common."""
    return -(-3 * (x + y) // 7)


def least_common(x: int, y: int) -> int:
    """Prefix shingles that linked sets of these sizes have in common.

    Of the common shingles only those outside the prefix that ends first can be missing there,
    and outside a prefix of n shingles lie all but a quarter of n.
    """
    return max(1, least_overlap(x, y) + 1 - max(-(-3 * x // 4), -(-3 * y // 4)))


def t_occurrence(query: np.ndarray, candidates: list[np.ndarray], thresholds: list[int]) -> list[int]:
    """Places of the candidates that share at least their threshold of numbers with the query, all sorted.

    The candidates are turned into an inverted list for each number of the query.
    """
    flat = np.concatenate(candidates)
    owner = np.repeat(np.arange(len(candidates)), [len(candidate) for candidate in candidates])
    at = np.searchsorted(query, flat)
    hit = query[np.minimum(at, len(query) - 1)] == flat
    at, owner = at[hit], owner[hit]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    lists = [found.tolist() for found in np.split(owner, np.flatnonzero(np.diff(at)) + 1) if len(found)]
    return sorted(divide_skip(lists, thresholds)) if lists else []


# ---------------------------------------------------------------- one order of all shingles

def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def classes_and_sketches(docs: DataFrame) -> DataFrame:
    """One pass: rows of documents (kind 0), and parts of the counts of shingles by slot (kind 1).

    A task counts the shingles of its sets in 2^SKETCH_BITS slots and gives them away in
    parts of SKETCH_PART slots, which add up over the tasks.
    """
    schema = T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("doc_id", docs.schema["doc_id"].dataType),
        *T._parse_datatype_string("text_id bigint, n bigint, number bigint, part int, counts binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        type_of_id = None
        for whole in batches:
            type_of_id = whole.column("doc_id").type
            for batch in text_slices(whole):
                sets = shingle_sets(batch.column("text").to_pylist())
                rows = len(sets)
                if any(map(len, sets)):
                    counts += np.bincount(_slots(np.concatenate(sets)), minlength=len(counts))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.zeros(rows, np.int32)), batch.column("doc_id"), batch.column("text_id"),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array([set_number(s) for s in sets], pa.int64()),
                    pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], schema.names)
        if type_of_id is not None and counts.any():
            parts = counts.reshape(-1, SKETCH_PART)
            rows = len(parts)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.ones(rows, np.int32)), pa.nulls(rows, type_of_id), pa.nulls(rows, pa.int64()),
                pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64()), pa.array(np.arange(rows, dtype=np.int32)),
                pa.array([part.astype("<i8").tobytes() for part in parts], pa.binary())], schema.names)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_id")).mapInArrow(run, schema)


def _added(sketches: DataFrame) -> np.ndarray:
    """The counts of all tasks by slot: 2^SKETCH_BITS numbers, whatever the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                counts = np.frombuffer(counts, "<i8")
                sums[part] = sums[part] + counts if part in sums else counts
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["part", "counts"])

    total = np.zeros((1 << SKETCH_BITS) // SKETCH_PART * SKETCH_PART, np.int64).reshape(-1, SKETCH_PART)
    for part, counts in sketches.select("part", "counts").repartition("part").mapInArrow(run, "part int, counts binary").collect():
        total[part] = np.frombuffer(counts, "<i8")
    return total.ravel()


def _prefixes(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """(token, set_id, n, hot) of the prefix of every set: its shingles of the least frequent slots, then by number."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    often = int(3 * np.median(counts)) + OFTEN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        seen: set[int] = set()
        for whole in batches:
            for batch in text_slices(whole):
                tokens, ids, sizes, hots = [], [], [], []
                for shingles in shingle_sets(batch.column("text").to_pylist()):
                    n = len(shingles)
                    number = set_number(shingles)
                    if not n or number in seen:
                        continue
                    seen.add(number)
                    length = prefix_length(n)
                    found = counts[_slots(shingles)]
                    order = np.argsort(found, kind="stable")[:length]  # equal counts keep their order by number
                    tokens.append(shingles[order])
                    hots.append(found[order] >= often)
                    ids.append(number)
                    sizes.append(n)
                if ids:
                    lengths = [len(t) for t in tokens]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(_signed(np.concatenate(tokens))), pa.array(np.repeat(np.array(ids, np.int64), lengths)),
                        pa.array(np.repeat(np.array(sizes, np.int64), lengths)), pa.array(np.concatenate(hots)),
                    ], ["token", "set_id", "n", "hot"])
                if len(seen) > 500_000:
                    seen.clear()

    return docs.select("text").mapInArrow(run, "token bigint, set_id bigint, n bigint, hot boolean")


def _shared_tokens(prefixes: DataFrame) -> DataFrame:
    """Drop the tokens only one set has.

    Tokens known to be frequent are shared anyway: their rows are dealt by row, not by token.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last token's rows may go on in the next batch
        for batch in batches:
            held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            tokens = held.column("token").to_numpy()
            end = int(np.searchsorted(tokens, tokens[-1])) if len(tokens) else 0
            if end:
                yield from some(held.slice(0, end))
                held = held.slice(end)
        if held is not None and held.num_rows:
            yield from some(held)

    def some(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tokens, ids = rows.column("token").to_numpy(), rows.column("set_id").to_numpy()
        # Copies of a text in different tasks list the same set twice.
        new = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (ids[1:] != ids[:-1])))
        first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        lengths = np.diff(np.concatenate((first, [len(tokens)])))
        distinct = np.add.reduceat(new, first)
        keep = np.repeat(distinct > 1, lengths) & new
        keep |= rows.column("hot").to_numpy(zero_copy_only=False) & new
        yield rows.filter(pa.array(keep)).select(["token", "set_id", "n"])

    place = F.when(F.col("hot"), F.xxhash64("token", "set_id")).otherwise(F.col("token"))
    # Equal rows are neighbours, also those dealt by row.
    return prefixes.repartition(place).sortWithinPartitions("token", "set_id").mapInArrow(
        run, "token bigint, set_id bigint, n bigint")


def _band(n: Column) -> Column:
    """Linked sets are in the same band of sizes or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / float(np.log(4 / 3)) + 1e-9).cast("int")


def _with_share(posts: DataFrame) -> DataFrame:
    """Add the share of its shingles that a set has in lists; the less a copy was edited, the larger it is."""
    listed = posts.groupBy("set_id").agg(F.count("*").alias("listed"))
    return posts.join(listed.hint("merge"), "set_id").select(
        "token", "set_id", "n", (F.col("listed") / F.col("n")).alias("share"))


def _leading(turn: int) -> Column:
    """The least leads. First the set with the largest share, which is linked with most of a group of copies."""
    mixed = F.xxhash64("set_id", F.lit(turn))
    if turn % 2:
        return mixed
    return (F.lit(1 << 20) - F.floor(F.least("share", F.lit(1.0)) * (1 << 20))) * F.lit(1 << 42) + F.pmod(mixed, F.lit(1 << 42))


def _star_pairs(posts: DataFrame, labels: DataFrame | None, turn: int) -> DataFrame:
    """Each list (a token and two neighbouring bands of sizes) pairs its members with a leader."""
    lists = posts.withColumn("band", F.explode(F.array(_band(F.col("n")), _band(F.col("n")) - 1)))
    lists = lists.withColumn("comp", F.col("set_id"))
    if labels is not None:
        lists = lists.drop("comp").join(labels.select(F.col("id").alias("set_id"), "component").hint("merge"), "set_id", "left").withColumn(
            "comp", F.coalesce("component", "set_id")).drop("component")
    order = _leading(turn)
    leaders = lists.groupBy("token", "band").agg(
        F.min_by("set_id", order).alias("leader"), F.min_by("n", order).alias("leader_n"),
        F.min_by("comp", order).alias("leader_comp"), F.min("comp").alias("low"), F.max("comp").alias("high"),
    ).where("low <> high").drop("low", "high")
    return lists.join(leaders.hint("merge"), ["token", "band"]).where(
        (F.col("comp") != F.col("leader_comp"))
        & (4 * F.least("n", "leader_n") >= 3 * F.greatest("n", "leader_n"))
    ).select(F.col("leader").alias("a"), F.col("set_id").alias("b")).distinct()


def _least_common(a_n: Column, b_n: Column) -> Column:
    """Prefix shingles that linked sets of these sizes have in common; all but a quarter of a set are outside its prefix."""
    return F.greatest(F.lit(1), required(a_n, b_n) + 1 - F.greatest(F.ceil(a_n * 3 / 4), F.ceil(b_n * 3 / 4)))


def _cross_pairs(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of different components that may have enough prefix shingles in common to be linked.

    Linked sets have T prefix shingles or more in common. As in DivideSkip, of one of the two,
    that with fewer listed shingles, the T - 1 with the longest lists are set aside: the pair
    still meets in one of the others. So a set with few shingles in common with a large group
    is not paired with its members. The sizes in a list bound T from below before the join,
    the two sizes in it.
    """
    lists = posts.join(labels.select(F.col("id").alias("set_id"), "component").hint("merge"), "set_id", "left").withColumn(
        "comp", F.coalesce("component", "set_id")).drop("component")
    mixed = lists.groupBy("token").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("members"),
        F.min("n").alias("least_n"), F.max("n").alias("most_n")).where("low <> high").drop("low", "high")
    lists = lists.join(mixed.hint("merge"), "token")
    place = Window.partitionBy("set_id").orderBy(F.desc("members"), "token")
    lists = lists.withColumn("place", F.row_number().over(place)).withColumn(
        "listed", F.count("*").over(Window.partitionBy("set_id")))
    ends = [F.greatest("least_n", F.ceil(F.col("n") * 3 / 4)), F.least("most_n", F.floor(F.col("n") * 4 / 3))]
    # T grows towards equal sizes from both sides, but for rounding.
    bound = F.least(*[_least_common(F.col("n"), end) for end in ends]) - 1
    left = lists.where(F.col("place") >= bound).select(
        "token", "place", *[F.col(c).alias(f"a_{c}") for c in ("set_id", "n", "comp", "listed")])
    right = lists.select("token", *[F.col(c).alias(f"b_{c}") for c in ("set_id", "n", "comp", "listed")])
    common = _least_common(F.col("a_n"), F.col("b_n"))
    return (
        left.join(right.hint("merge"), "token").where(
            ((F.col("a_listed") < F.col("b_listed"))
             | ((F.col("a_listed") == F.col("b_listed")) & (F.col("a_set_id") < F.col("b_set_id"))))
            & (F.col("a_comp") != F.col("b_comp")) & (F.col("a_listed") >= common)
            & (4 * F.least("a_n", "b_n") >= 3 * F.greatest("a_n", "b_n")) & (F.col("place") >= common))
        .select(F.col("a_set_id").alias("a"), F.col("b_set_id").alias("b")).distinct()
    )


# ---------------------------------------------------------------- candidates and links

def _searched(pairs: DataFrame, values: DataFrame, least) -> DataFrame:
    """The pairs (a, b) whose numbers in `values` (set_id, n, numbers) have `least(n of a, n of b)` in common.

    The candidates of one `a` are dealt to blocks, so that a set with very many of them is
    searched in many tasks; in each block DivideSkip runs over their inverted lists. The pairs
    are staged, so that the planner knows their size and shuffles `values` only if they are many.
    `values` may have a set more than once.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = stage(pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block"), "b"), "dealt")
    rows = stage(dealt.select("a", "block", F.col("b").alias("set_id")).unionByName(
        dealt.select("a", "block", F.col("a").alias("set_id")).distinct()), "ends")
    rows = values.join(rows, "set_id").withColumn("other", F.col("set_id") != F.col("a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, query, last, members, found = None, None, None, [], []

        def decide() -> None:
            n, numbers = query
            kept = t_occurrence(numbers, [own for _, _, own in members], [least(n, m) for _, m, _ in members])
            found.extend((key[0], members[i][0]) for i in kept)
            members.clear()

        for batch in batches:
            for a, block, other, set_id, n, packed in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if (a, block) != key:
                    if members:
                        decide()
                    key, query, last = (a, block), None, None
                numbers = np.frombuffer(packed, np.uint64)
                if not other:
                    query = (n, numbers)
                elif set_id != last:
                    members.append((set_id, n, numbers))
                    if len(members) >= BLOCK:
                        decide()
                last = set_id
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*found)], ["a", "b"])
                found.clear()
        if members:
            decide()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*found)], ["a", "b"])

    # The query comes before its candidates.
    return rows.select("a", "block", "other", "set_id", "n", "numbers").repartition("a", "block").sortWithinPartitions(
        "a", "block", "other", "set_id").mapInArrow(run, "a bigint, b bigint")


def _listed(posts: DataFrame) -> DataFrame:
    """(set_id, n, numbers): the prefix shingles of a set that others have in theirs, sorted, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.sort(tokens.values.to_numpy().view(np.uint64)).tobytes() for tokens in batch.column("tokens")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("set_id"), batch.column("n"), pa.array(packed, pa.binary())], ["set_id", "n", "numbers"])

    gathered = posts.groupBy("set_id").agg(F.first("n").alias("n"), F.collect_list("token").alias("tokens"))
    return gathered.mapInArrow(run, "set_id bigint, n bigint, numbers binary")


def _whole_sets(docs: DataFrame, members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(set_id, n, numbers): all shingles of the sets in `pairs`, each made from one of its texts.

    Copies of a text in several tasks give the same row.
    """
    ends = pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id"))).distinct()
    wanted = members.join(ends, "set_id", "left_semi").groupBy("set_id").agg(F.min("text_id").alias("text_id"))
    place = F.pmod("text_id", F.lit(SLOTS)) + 1
    # A bitmap of fixed size says which texts may be wanted; the others are not turned into shingles.
    parts = wanted.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    bits = np.zeros(SLOTS // 8, np.uint8)
    for bucket, part in parts:
        bits[(bucket - 1) * 4096:(bucket - 1) * 4096 + len(part)] = np.frombuffer(part, np.uint8)
    packed = bits.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").astype(bool), set()
        for whole in batches:
            for batch in text_slices(whole.filter(pa.array(known[whole.column("text_id").to_numpy() % SLOTS]))):
                texts = {i: text for i, text in zip(batch.column("text_id").to_pylist(), batch.column("text").to_pylist())
                         if i not in seen}
                seen.update(texts)
                sets = shingle_sets(list(texts.values()))
                kept = [s for s in sets if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_number(s) for s in kept], pa.int64()), pa.array([len(s) for s in kept], pa.int64()),
                     pa.array([s.tobytes() for s in kept], pa.binary())], ["set_id", "n", "numbers"])

    texts = docs.where("text IS NOT NULL").select(F.xxhash64("text").alias("text_id"), "text")
    # Texts that fell into a wanted slot by chance go in the join with the pairs.
    return texts.mapInArrow(run, "set_id bigint, n bigint, numbers binary")


def similar_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_id, component_id) of all rows of `docs` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    passed = stage(classes_and_sketches(docs), "classes")
    members = passed.where("kind = 0").select("doc_id", "text_id", "n", F.col("number").alias("set_id"))
    counts = _added(passed.where("kind = 1"))
    posts = stage(_with_share(stage(_shared_tokens(_prefixes(docs, counts)), "shared")), "posts")
    listed = stage(_listed(posts), "listed")
    links: list[DataFrame] = []
    decided: list[DataFrame] = []
    labels = None
    for turn in range(3):
        pairs = _cross_pairs(posts, labels) if turn == 2 else _star_pairs(posts, labels, turn)
        # Each pair once, as it is: `a` is the leader, whose candidates meet in blocks.
        ends = {"low": F.least("a", "b"), "high": F.greatest("a", "b")}
        pairs = pairs.withColumns(ends).dropDuplicates(["low", "high"])
        for earlier in decided:
            pairs = pairs.join(earlier, ["low", "high"], "left_anti")
        pairs = stage(pairs, "pairs")
        decided.append(pairs.select("low", "high"))
        likely = stage(_searched(pairs.select("a", "b"), listed, least_common), "likely")
        if not likely.isEmpty():
            links.append(stage(_searched(likely, _whole_sets(docs, members, likely), least_overlap), "linked"))
            labels = stage(components(reduce(DataFrame.unionByName, links)), "labels")
        elif labels is None:
            labels = stage(components(likely), "labels")
    labels = labels.select(F.col("id").alias("set_id"), "component")
    named = members.join(labels, "set_id", "left").withColumn("component", F.when(
        F.col("n") > 0, F.coalesce("component", "set_id")))
    least = named.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "set_id",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op5_ngram_jaccard_join(docs: DataFrame) -> DataFrame:
    return similar_documents(docs).select("doc_id", "n_shingles", "component_id")
