"""Language identification of mixed-language text.

Script ranges narrow the languages a word can be in: those that learning saw written in
its script. Within them a word has a score from the hashed character n-grams of its
letters, learned from labelled documents. Viterbi over the words of a text, with a penalty
for switching, labels them; runs of one label are its spans, and the language of the text
is the one that holds most letters.

Learning counts n-grams over a sample of at most about LEARN_ROWS documents of each
language, each task into an array of fixed size; the sums, at most BUCKETS x (number of languages) numbers, are the whole model, so
what is broadcast does not grow with the corpus.

Defined cases: a text that is NULL or has no letter is `und` with score 0, no spans; a
language that is NULL is not learned from; without any labelled text all are `und`. Of
languages that are equally likely the first in text order is taken. Repeated rows and ids
are labelled one by one; an empty table gives no rows. Long texts are labelled whole.
"""

from __future__ import annotations

import gc
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.common import crc_share, text_slices

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
SWITCH_PENALTY = 6.0
# Characters of the texts that go through Viterbi together.
CHARACTERS = 8_000_000
_SMOOTHING = 0.5
_BASE, _SPREAD = np.uint64(1_000_003), np.uint64(0x9E3779B97F4A7C15)

# First and last code point of the main blocks of scripts (Unicode).
SCRIPT_RANGES = (
    (0x0041, 0x024F, "latin"), (0x0370, 0x03FF, "greek"), (0x0400, 0x052F, "cyrillic"), (0x0530, 0x058F, "armenian"),
    (0x0590, 0x05FF, "hebrew"), (0x0600, 0x077F, "arabic"), (0x0900, 0x097F, "devanagari"), (0x0980, 0x09FF, "bengali"),
    (0x0E00, 0x0E7F, "thai"), (0x10A0, 0x10FF, "georgian"), (0x1E00, 0x1EFF, "latin"), (0x3040, 0x30FF, "kana"),
    (0x3400, 0x9FFF, "han"), (0xAC00, 0xD7AF, "hangul"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, _, name in SCRIPT_RANGES)) + ("other",)
_LETTERS = re.compile(r"[^\W\d_]+")
# The same for texts whose characters are all below U+0250, of which only these are no lower-case letters.
_LOW_LETTERS = re.compile("[^\x00-\x60\x7b-\xa9\xab-\xb4\xb6-\xb9\xbb-\xbf\xd7\xf7]+")
_HIGH = re.compile("[\u0250-\U0010ffff]")
# Rows of each language that are learned from.
LEARN_ROWS = 5_000


def script_of(word: str) -> int:
    """The script of the first letter of a word, as a place in SCRIPTS."""
    point = ord(word[0])
    for low, high, name in SCRIPT_RANGES:
        if low <= point <= high:
            return SCRIPTS.index(name)
    return len(SCRIPTS) - 1


def words_of(text: str) -> list[str]:
    text = text.lower()
    return (_LETTERS if _HIGH.search(text) else _LOW_LETTERS).findall(text)


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, bucket) of every word itself and of its 1- to 4-grams with borders, for all words at once."""
    points = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le"), np.uint32).astype(np.uint64)
    border = points == ord("<")
    word = np.cumsum(border) - 1
    inside = np.arange(len(points)) - np.flatnonzero(border)[word]
    powers = np.cumprod(np.full(int(inside.max()) + 1, _BASE))
    whole = np.bitwise_xor.reduceat(points * powers[inside], np.flatnonzero(border))
    places, hashes = [np.arange(len(words))], [whole * np.uint64(31)]
    rolling = np.zeros(len(points), np.uint64)
    for n in range(1, 5):
        rolling = (rolling[:-1] if n > 1 else rolling) * _BASE + points[n - 1:]
        fits = word[:len(rolling)] == word[n - 1:]
        if n == 1:
            fits &= ~border & (points != ord(">"))
        places.append(word[:len(rolling)][fits])
        hashes.append(rolling[fits] + np.uint64(n))
    buckets = (np.concatenate(hashes) * _SPREAD) >> np.uint64(64 - BUCKET_BITS)
    return np.concatenate(places), buckets.astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray  # log probability of a gram, by bucket and language
    allowed: np.ndarray  # by script and language

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language, far down where the script is not its own."""
        places, buckets = word_grams(words)
        sums = np.stack([np.bincount(places, self.weights[buckets, i], len(words))
                         for i in range(len(self.languages))], axis=1)
        # Overlapping n-grams count letters several times: the mean keeps a word's weight to its letters.
        letters = np.fromiter(map(len, words), np.float64, len(words))
        sums *= (letters / np.bincount(places, minlength=len(words)))[:, None]
        scripts = np.fromiter(map(script_of, words), np.int64, len(words))
        return np.where(self.allowed[scripts], sums, sums.min(1, keepdims=True) - 20.0)


def learn(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows_each: int = LEARN_ROWS,
) -> LanguageModel:
    """Count the grams and scripts of a sample of about `rows_each` texts of each language, chosen by a hash of `key`."""
    labelled = docs.select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.xxhash64(key).alias("key"),
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    # Every label is learned: a row for each comes to the driver.
    rows = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().collect()}
    languages = tuple(sorted(rows))
    if not languages:
        return LanguageModel((), np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPTS), 0), bool))
    share = F
    for name in languages:
        share = share.when(F.col("lang") == name, F.lit(min(1.0, rows_each / rows[name])))
    labelled = labelled.where(F.pmod("key", F.lit(1 << 30)) < share * (1 << 30)).select("text", "lang")
    index = {name: i for i, name in enumerate(languages)}
    size = BUCKETS + len(SCRIPTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        sums = np.zeros((len(languages), size), np.int64)
        for whole in batches:
            for batch in text_slices(whole):
                counts: dict[str, Counter] = {}
                for value, name in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                    if name in index:
                        counts.setdefault(name, Counter()).update(words_of(value))
                for name, held in counts.items():
                    if held:
                        words, times = list(held), np.fromiter(held.values(), np.int64, len(held))
                        places, buckets = word_grams(words)
                        sums[index[name]] += np.bincount(buckets, times[places], size).astype(np.int64)
                        scripts = np.fromiter(map(script_of, words), np.int64, len(words))
                        sums[index[name], BUCKETS:] += np.bincount(scripts, times, len(SCRIPTS)).astype(np.int64)
        rows, columns = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows.astype(np.int32)), pa.array(columns.astype(np.int32)), pa.array(sums[rows, columns])],
            ["language", "bucket", "n"])

    table = labelled.mapInArrow(count, "language int, bucket int, n bigint").groupBy("language", "bucket").agg(
        F.sum("n").alias("n")).toArrow()  # at most (number of languages) x (BUCKETS + scripts) rows
    counts = np.zeros((size, len(languages)))
    counts[table["bucket"].to_numpy(), table["language"].to_numpy()] = table["n"].to_numpy()
    grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
    weights = np.log((grams + _SMOOTHING) / (grams.sum(0) + _SMOOTHING * BUCKETS))
    allowed = scripts >= 0.01 * np.maximum(scripts.sum(0), 1)
    allowed[~allowed.any(1)] = True  # a script nobody learned rules nobody out
    return LanguageModel(languages, weights, allowed)


def viterbi(scores: list[np.ndarray], penalty: float = SWITCH_PENALTY) -> list[np.ndarray]:
    """Best label of every word of every text; all texts go forward together, the longest longest."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = np.array([len(scores[i]) for i in order])
    width = scores[0].shape[1]
    flat = np.concatenate([scores[i] for i in order])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    # A label that arrives by a switch comes from the best one of the word before.
    switched = np.zeros(flat.shape, bool)
    best_before = np.zeros(len(flat), np.int16)
    value = flat[starts].copy()
    for step in range(1, int(lengths[0])):
        active = int(np.searchsorted(-lengths, -step, side="left"))  # texts with more than `step` words
        at = starts[:active] + step
        before = value[:active]
        best = before.argmax(1)
        jump = before[np.arange(active), best] - penalty
        switch = before < jump[:, None]
        switched[at], best_before[at] = switch, best
        value[:active] = flat[at] + np.where(switch, jump[:, None], before)
    labels = np.zeros(len(flat), np.int16)
    ends = starts + lengths - 1
    now = value.argmax(1)
    labels[ends] = now
    for step in range(int(lengths[0]) - 1, 0, -1):
        active = int(np.searchsorted(-lengths, -step, side="left"))
        at = starts[:active] + step
        here = labels[at]
        labels[at - 1] = np.where(switched[at, here], best_before[at], here)
    out: list[np.ndarray] = [labels[:0]] * len(scores)
    for place, i in enumerate(order):
        out[i] = labels[starts[place]:starts[place] + lengths[place]]
    return out


_RESULT = ("lang_pred string, lang_score double, spans array<struct<lang: string, first_word: int, n_words: int>>")


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", spans: bool = True) -> DataFrame:
    """Add lang_pred, lang_score (0 to 1) and, if wanted, the spans of words in one language."""
    names = ("lang_pred", "lang_score", *(("spans",) if spans else ()))
    kept = docs.drop(*names)
    schema = T.StructType([*kept.schema.fields, *T._parse_datatype_string(_RESULT).fields[:len(names)]])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        held = shared.value
        span_type = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32())]))
        for whole in batches:
            for batch in text_slices(whole, CHARACTERS, text):
                predictions = _label(batch.column(text).to_pylist(), held, spans)
                columns = [pa.array([p[0] for p in predictions], pa.string()),
                           pa.array([p[1] for p in predictions], pa.float64())]
                if spans:
                    columns.append(pa.array([p[2] for p in predictions], span_type))
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])

    return kept.mapInArrow(run, schema)


def _label(texts: list[str | None], model: LanguageModel, spans: bool) -> list[tuple[str, float, list[dict]]]:
    out: list[tuple[str, float, list[dict]]] = [("und", 0.0, [])] * len(texts)
    words = [words_of(value or "") for value in texts]
    use = [i for i, held in enumerate(words) if held]
    if not use or not model.languages:
        return out
    flat = list(chain.from_iterable(words))
    vocabulary = list(dict.fromkeys(flat))
    place = dict(zip(vocabulary, range(len(vocabulary))))
    ids = np.fromiter(map(place.__getitem__, flat), np.int64, len(flat))
    found = np.split(ids, np.cumsum([len(held) for held in words])[:-1])
    del words, flat, place
    table = model.word_scores(vocabulary)
    letters = np.fromiter(map(len, vocabulary), np.float64, len(vocabulary))
    labels = viterbi([table[found[i]] for i in use])
    for i, label in zip(use, labels):
        share = np.bincount(label, letters[found[i]], len(model.languages))
        best = int(share.argmax())
        # The odds of the best language over the text, per letter, times its share of the letters.
        total = table[found[i]].sum(0) / letters[found[i]].sum()
        sure = np.exp(total - total.max())
        runs = []
        if spans:
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(label)) + 1, [len(label)]))
            runs = [{"lang": model.languages[label[a]], "first_word": int(a), "n_words": int(b - a)}
                    for a, b in zip(cuts, cuts[1:])]
        score = float(share[best] / share.sum() * min(1.0, sure[best] / sure.sum() * 2))
        out[i] = (model.languages[best], min(score, 1.0), runs)
    return out


def op6_language_id(docs: DataFrame) -> DataFrame:
    held_out = crc_share(F.col("doc_id"), 5) == 0
    model = learn(docs.select("doc_id", "text", "lang").where(~held_out))
    return identify(docs.select("doc_id", "text"), model, spans=False).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
