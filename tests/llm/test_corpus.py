"""Operators that compare documents, against brute force."""

import random
import tracemalloc
import zlib
from collections import Counter, defaultdict
from math import log10

import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm.conftest import PASSAGE
from tradewind.llm import maxent, ngram_join, substring
from tradewind.llm.components import components


def _sets(rows):
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        yield doc_id, frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def _components(rows):
    sets = list(_sets(rows))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(sets):
        least[find(i)].append(doc_id)
    return Counter((doc_id, len(s), min((d for d in least[find(i)] if d is not None), default=None) if s else doc_id)
                   for i, (doc_id, s) in enumerate(sets))


def test_ngram_join_against_brute_force(spark, corpus):
    seed = random.Random(5)
    base = [f"t{seed.randrange(300)}" for _ in range(90)]
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    for i in range(60):  # a chain of near copies and a passage in many
        base[seed.randrange(len(base))] = f"new{i}"
        rows.append((100 + i, " ".join(base)))
        rows.append((300 + i, PASSAGE + " " + " ".join(f"u{i}x{k}" for k in range(12))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter(map(tuple, ngram_join.op5_ngram_jaccard_join(docs.repartition(3)).collect()))
    assert got == _components(rows)


def test_divide_skip():
    seed = random.Random(1)
    for _ in range(50):
        lists = [sorted(seed.sample(range(12), seed.randrange(1, 12))) for _ in range(20)]
        thresholds = [seed.randrange(3, 18) for _ in range(12)]
        counts = Counter(i for members in lists for i in members)
        assert ngram_join.divide_skip(lists, thresholds) == {i: n for i, n in counts.items() if n >= thresholds[i]}


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(50, 51), (52, 51), (60, 60)], "a bigint, b bigint")
    got = dict(map(tuple, components(links).collect()))
    assert got == {i: 1 for i in range(1, 31)} | {50: 50, 51: 50, 52: 50}


def test_passages(spark, corpus, nothing):
    rows = substring.op3_substring_dedup(corpus).collect()
    found = {r.doc_id: r for r in rows}
    assert set(found) == {2, 3, 4} and found[4].start_word == 60 and found[4].n_words == 60 and found[4].other_doc_id == 1
    assert found[2].n_words == 100
    assert substring.op3_substring_dedup(nothing).count() == 0


def test_substring_steps_hold_few_texts_and_seeds_at_once(spark, tmp_path, monkeypatch):
    """The batches that the steps give and take are small, and the result does not depend on them."""
    rng = random.Random(3)
    texts = [" ".join(f"v{rng.randrange(5000)}" for _ in range(70)) for _ in range(2400)]
    texts[7] = texts[2000] + " " + texts[7]
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    given = docs.selectExpr("doc_id AS doc", "text")

    class Words:  # the step of seeds on one batch
        def mapInArrow(self, run, schema):
            numbers, lengths = substring.word_numbers(texts)
            data, ends = substring.mixed(numbers).astype("<u4").tobytes(), (4 * lengths.cumsum()).tolist()
            words = [data[end - 4 * n:end] for end, n in zip(ends, lengths.tolist())]
            return list(run(iter([pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(words, pa.binary())], ["doc", "words"])])))

    monkeypatch.setattr(substring, "_matches", lambda led: led)
    led = substring.seed_matches(Words())
    assert sum(batch.num_rows for batch in led) < substring.CHUNK_WORDS
    monkeypatch.setattr(substring, "BATCH_ROWS", 1000)
    small = substring.seed_matches(Words())
    assert max(batch.num_rows for batch in small) <= 1000
    assert pa.Table.from_batches(small).equals(pa.Table.from_batches(led))
    monkeypatch.setattr(substring, "PIECE_BYTES", 1)  # each text for itself
    assert pa.Table.from_batches(substring.seed_matches(Words())).equals(pa.Table.from_batches(led))

    before = spark.conf.get(substring._BATCH)
    with substring._small_batches(spark):
        most = given.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n bigint").agg({"n": "max"}).first()[0]
    assert most == substring.TEXT_ROWS and spark.conf.get(substring._BATCH) == before


def test_fuzzy_passage_and_chain():
    words = list(range(100))
    assert substring.extended(*map(__import__("numpy").array, (words, [*words[:50], 999, *words[51:]]))) == (100, 100)
    found = substring.chains([0, 20, 21, 50], [100, 120, 5, 152])
    assert found[0][:4] == (0, 58, 100, 160) and substring.cut_words("a b\nc d", [(1, 2)]) == "a d"


def _found(spark, texts, parts=1):
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(parts, "doc_id")
    found = defaultdict(set)
    for r in substring.op3_substring_dedup(docs).collect():
        found[r.doc_id] |= set(range(r.start_word, r.start_word + r.n_words))
    return found


def _own(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def test_unshared_text_within_a_chain_stays(spark):
    head, foot, phrase = _own("h", 60), _own("f", 55), [_own(f"p{k}_", 9) for k in range(4)]
    fuzzy = head.split()
    fuzzy[20], fuzzy[40] = "changed", "again"
    far = [w if i % 7 else f"far{i}" for i, w in enumerate(_own("z", 400).split())]
    found = _found(spark, {
        1: " ".join((head, _own("a", 100), foot)), 2: " ".join((head, _own("b", 100), foot)),
        3: _own("c", 10).join(["", *phrase]), 4: _own("d", 10).join(["", *phrase]),
        5: " ".join((_own("e", 5), *fuzzy)),
        6: _own("k", 20) + " " + _own("z", 400), 7: " ".join(["k%d" % i for i in range(20)] + far)})
    assert found[2] == set(range(60)) | set(range(160, 215))
    assert 3 not in found and 4 not in found
    assert found[5] == set(range(5, 65))
    assert 400 <= len(found[7]) <= 420


@pytest.mark.parametrize("period", [1, 2, 7, 12, 15])
def test_periodic_passages(spark, period):
    line = [f"m{k}" for k in range(period)]
    run = (line * 60)[:60]
    found = _found(spark, {i: " ".join([_own(f"d{i}_", 30), *run[i % period:], *run[:i % period], _own(f"t{i}_", 30)]) for i in (1, 2)})
    same = 60 - max(i % period for i in (1, 2))
    assert len(found[2]) >= same and found[2] <= set(range(30, 90)) and 1 not in found


@pytest.mark.parametrize("parts", [1, 7])
def test_passage_that_the_owner_has_in_part(spark, parts):
    passage = _own("s", 56).split()
    found = _found(spark, {
        1: " ".join(["x1", *passage[:44], _own("a", 40)]), 2: " ".join(["x2", _own("b", 30), *passage, _own("b_", 9)]),
        3: " ".join([_own("c", 20), *passage, _own("c_", 9)])}, parts)
    assert found == {3: set(range(20, 76))}


def test_equal_runs_against_brute_force(spark):
    seed = random.Random(3)
    base = [[f"{k}v{seed.randrange(90)}" for _ in range(120)] for k in range(4)]
    texts = {}
    for i in range(1, 60):
        words = []
        for _ in range(6):
            part, at = base[seed.randrange(4)], seed.randrange(100)
            words += part[at:at + seed.randrange(30, 70)] + [f"u{i}" for _ in range(seed.randrange(4))]
        texts[i] = " ".join(words)
    want, held = defaultdict(set), set()
    for i, text in texts.items():
        words = text.split()
        grams = [tuple(words[p:p + 50]) for p in range(len(words) - 49)]
        for p, gram in enumerate(grams):
            if gram in held:
                want[i] |= set(range(p, p + 50))
        held |= set(grams)
    found = _found(spark, texts, 3)
    assert want and all(want[i] <= found[i] for i in want)


def test_lm_scores(spark, corpus):
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    tokens = [(doc_id, [*(text or "").encode().lower().split(), b" "]) for doc_id, text in rows]
    held = {doc_id: zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 10 == 0 for doc_id, _ in rows}
    counts = Counter(w for doc_id, words in tokens if not held[doc_id] for w in words)
    total, size = sum(counts.values()), len(counts)
    want = sorted((str(d), len(w), sum(x in counts for x in w), round(sum(
        log10((counts[x] + 0.1) / (total + 0.1 * (size + 1))) for x in w), 6)) for d, w in tokens)
    got = maxent.op1_lm_scoring(corpus).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert all(r.held_out == held[r.doc_id] and r.train_tokens == total and r.score < 0 for r in got)


def test_lm_beats_its_base_on_held_out_texts(spark):
    rows = maxent.op1_lm_scoring(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_histories_give_a_distribution():
    import numpy as np

    weights = np.random.default_rng(0).normal(size=(maxent.FEATURES, maxent.CLASSES))
    assert np.allclose(np.exp(maxent.log_probabilities(np.arange(50), weights)).sum(1), 1)


def test_words_of_a_slice_are_objects_only_piece_by_piece():
    import numpy as np

    rng = np.random.default_rng(5)
    texts = [" ".join(f"Word{k}" for k in rng.integers(0, 3000, 400)).encode() for _ in range(1000)] + [None, b""]
    tracemalloc.start()
    words = maxent.slice_words(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    flat = [w for text in texts for w in [*(text or b"").lower().split(), maxent._END_WORD]]
    place = {w: k for k, w in enumerate(dict.fromkeys(flat))}
    assert words.ids.tolist() == [place[w] for w in flat]
    assert words.lengths.tolist() == [401] * 1000 + [1, 1]
    # 401,000 words would be 17 MB as objects, and their list 3 MB.
    assert peak < 16_000_000


def test_lm_words_depend_on_the_words_before(spark):
    """All words have one ending, so they are of one class, and are equally frequent."""
    train = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10]
    held = [i for i in range(400) if i not in train][:2]
    texts = {i: ("alphaword betaword " if i % 2 else "gammaword deltaword ") * 9 for i in train[:len(train) // 2 * 2]}
    texts |= {held[0]: "alphaword betaword alphaword betaword", held[1]: "alphaword deltaword alphaword deltaword"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: r for r in maxent.op1_lm_scoring(docs).collect()}
    assert abs(got[held[0]].base_score - got[held[1]].base_score) < 0.5
    assert got[held[0]].score > got[held[1]].score + 2


def test_words_of_a_class_have_a_distribution():
    import numpy as np

    rng = np.random.default_rng(0)
    members = maxent.Members(np.array([7, 9], np.uint32), np.array([0, 1]), 16)
    numbers, classes = rng.integers(0, 1 << 32, 60).astype(np.uint32), rng.integers(0, maxent.CLASSES, 60)
    numbers[:2] = 7, 9
    n = rng.integers(0, 50, 60)
    weights = rng.normal(size=(maxent.CLASSES * 16, maxent.MEMBERS))
    at, shares = members.of(numbers), np.zeros((maxent.CLASSES, maxent.MEMBERS + 1))
    np.add.at(shares, (classes, at), n + maxent.ALPHA)
    shares[:, -1] = maxent.ALPHA
    total = shares.sum(1)
    slots = members.features(numbers, classes, np.array([20, 40]))
    s, _, sums = maxent.word_scores(slots, classes, weights, shares / total[:, None])
    for token in range(60):
        c = classes[token]
        words = np.flatnonzero(classes == c)
        p = [(n[w] + maxent.ALPHA) / total[c] * np.exp(sum(weights[slot, at[w]] for slot in slots[token])) / sums[token] for w in words]
        assert np.isclose(sum(p) + maxent.ALPHA / total[c] / sums[token], 1)
        assert np.isclose(np.exp(s[token, at[token]]), np.exp(sum(weights[slot, at[token]] for slot in slots[token])))
    # A gradient step makes what was seen more probable.
    out = np.zeros((maxent.CLASSES * 16, maxent.MEMBERS))
    maxent._word_gradient(slots, classes, at, np.zeros_like(out), shares / total[:, None], out)
    s, _, sums = maxent.word_scores(slots, classes, 0.1 * out, shares / total[:, None])
    assert (s[np.arange(60), at] - np.log(sums)).sum() > 0


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_takes_an_empty_table(spark, name):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, "").columns == list(corpus_pipeline.COLUMNS)


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, sf).select("doc_id", "text").collect()
    single = corpus_pipeline.near_duplicates(spark, corpus_pipeline.quality(spark, docs, sf), sf)
    groups = {component for _, _, component in _components([tuple(r) for r in kept])}
    assert single.count() == len(groups)
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in kept}


def test_texts_with_half_of_each_other_are_not_compared_in_pairs(spark):
    """600 texts share half of their shingles, none is linked; the order of shingles is that of the corpus, not of a task."""
    common = [" ".join(f"c{i}x{j}" for j in range(12)) for i in range(20)]
    texts = [" ".join(common) + " " + " ".join(f"u{i}w{j}" for j in range(240)) for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(120)
    passed = ngram_join.classes_and_sketches(docs)
    counts = ngram_join._added(passed.where("kind = 1"))
    posts = ngram_join._with_share(ngram_join._shared_tokens(ngram_join._prefixes(docs, counts))).cache()
    nothing = spark.createDataFrame([], "id bigint, component bigint")
    compared = sum(pairs.count() for pairs in (
        ngram_join._star_pairs(posts, None, 0), ngram_join._star_pairs(posts, None, 1), ngram_join._cross_pairs(posts, nothing)))
    assert compared < 10_000
    got = ngram_join.op5_ngram_jaccard_join(docs).collect()
    assert all(r.component_id == r.doc_id for r in got) and len(got) == 600


def test_sketches_add_up_over_tasks(spark):
    docs = spark.createDataFrame([(i, f"a b c d e f{i % 7}") for i in range(50)], "doc_id bigint, text string")
    sums = [ngram_join._added(ngram_join.classes_and_sketches(docs.repartition(n)).where("kind = 1")) for n in (1, 3, 9)]
    assert sums[0].sum() == 100 and all((s == sums[0]).all() for s in sums)


def test_prefixes_of_linked_sets_have_enough_in_common():
    rng = random.Random(12)
    for _ in range(400):
        n = rng.randint(1, 60)
        a = rng.sample(range(1000), n)
        b = a[:rng.randint(1, n)] + rng.sample(range(1000, 2000), rng.randint(0, 12))
        both = len(set(a) & set(b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            first, second = (set(sorted(s)[:ngram_join.prefix_length(len(s))]) for s in (a, b))
            assert len(first & second) >= ngram_join.least_common(len(a), len(b))
            assert both >= ngram_join.least_overlap(len(a), len(b))
