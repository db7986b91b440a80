"""License scans: overlapping windows of a text against license templates.

Every template is a set of word shingles with MinHash signatures of its own windows, cut
into bands. Windows of a text, half of them overlapping the next, look up each of their
bands in the table of all template bands; what they hit is verified by exact containment
of the template's shingles in the neighbourhood of the window.

With BANDS bands of ROWS rows a window that has a share s of its shingles in common with a
template's window shares a band with probability 1 - (1 - s^ROWS)^BANDS. A window starts
every half template and is half as long again, so some window holds a template of m
shingles whole, among at most twice as many: s >= 0.75 / 2 at the least containment, and the
band settings give a collision with more than 0.999 at s = 0.3 (`collision_probability`).

Templates are a parameter of fixed size and the only thing broadcast; there is no shuffle.

Defined cases: NULL and empty texts match nothing; a template that occurs several times
gives a row for each place; rows of repeated documents are reported each.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tradewind.llm.common import text_slices
from tradewind.llm.shingles import mixed, runs, word_numbers

WIDTH = 5
CONTAINMENT = 0.75
PUNCTUATION = b".,;:!?()[]\"'"  # at the ends of words it does not count
ROWS, BANDS = 1, 24

# Short notices of common licenses, as they stand in files and pages.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at"),
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"),
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"),
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
_SALTS = mixed(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def collision_probability(share: float, rows: int = ROWS, bands: int = BANDS) -> float:
    return 1 - (1 - share ** rows) ** bands


@dataclass(frozen=True)
class Templates:
    names: tuple[str, ...]
    shingles: tuple[np.ndarray, ...]  # sorted and distinct
    words: tuple[int, ...]


def compiled(templates: Mapping[str, str] = TEMPLATES) -> Templates:
    """Shingle sets of the templates; one of fewer than WIDTH words is a single shorter shingle."""
    sets, words = [], []
    for text in templates.values():
        numbers, _ = word_numbers([text], PUNCTUATION)
        words.append(len(numbers))
        sets.append(np.unique(runs(numbers, min(WIDTH, len(numbers)))) if len(numbers) else np.zeros(0, np.uint64))
    return Templates(tuple(templates), tuple(sets), tuple(words))


def signatures(shingles: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bands (windows x BANDS) of the MinHash of shingles[start:end] for each window; `ends` may overlap the next start."""
    out = np.empty((len(starts), BANDS), np.uint64)
    cuts = np.stack((starts, ends), axis=1).ravel()
    for band in range(BANDS):
        parts = []
        for row in range(ROWS):
            hashed = np.append(mixed(shingles ^ _SALTS[band * ROWS + row]), np.uint64(0))
            parts.append(np.minimum.reduceat(hashed, cuts)[::2])
        out[:, band] = runs_of(parts)
    return out


def runs_of(parts: list[np.ndarray]) -> np.ndarray:
    total = parts[0]
    for part in parts[1:]:
        total = mixed(total) + part
    return total


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, license, start_word, containment): each place where a text holds enough of a template."""
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(
        "license string, start_word int, containment double").fields])
    known = compiled(templates)
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        t = shared.value
        sizes: dict[tuple[int, int], list[int]] = {}
        for i, (shingles, words) in enumerate(zip(t.shingles, t.words)):
            if len(shingles):
                # Templates of like length share their windows.
                sizes.setdefault((min(WIDTH, words), 1 << (len(shingles) - 1).bit_length()), []).append(i)
        bands = {key: [signatures(t.shingles[i], np.array([0]), np.array([len(t.shingles[i])]))[0] for i in members]
                 for key, members in sizes.items()}
        for whole in batches:
            for batch in text_slices(whole):
                numbers, lengths = word_numbers(batch.column("text").to_pylist(), PUNCTUATION)
                ends = np.cumsum(lengths)
                rows: list[tuple[int, str, int, float]] = []
                for (width, size), members in sizes.items():
                    shingles = runs(numbers, width)
                    if not len(shingles):
                        continue
                    text = np.repeat(np.arange(len(lengths)), lengths)[:len(shingles)]
                    inside = text == np.repeat(np.arange(len(lengths)), lengths)[width - 1:]
                    starts = np.arange(0, len(shingles), max(1, size // 2))
                    stops = np.minimum(starts + size + size // 2, len(shingles))
                    found = signatures(shingles, starts, stops)
                    for i, own in zip(members, bands[size_key := (width, size)]):
                        hits = np.flatnonzero((found == own).any(1))
                        rows += _verified(t, i, hits, starts, stops, shingles, text, inside, ends - lengths, containment)
                rows = sorted(set(rows))
                if rows:
                    at, name, start, share = zip(*rows)
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(name, pa.string()),
                        pa.array(start, pa.int32()), pa.array(share, pa.float64())], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _verified(t: Templates, i: int, hits, starts, stops, shingles, text, inside, begins, containment) -> list[tuple]:
    """Exact containment around each hit: in each text, of the template's distinct shingles at neighbouring places."""
    own, out = t.shingles[i], []
    reach = len(own) + WIDTH
    for hit in hits.tolist():
        low, high = max(int(starts[hit]) - reach, 0), min(int(stops[hit]) + reach, len(shingles))
        window = shingles[low:high]
        at = np.minimum(np.searchsorted(own, window), len(own) - 1)
        places = low + np.flatnonzero((own[at] == window) & inside[low:high])
        for number in np.unique(text[places]):
            here = places[text[places] == number]
            # Places further apart than the template is long are separate occurrences.
            for group in np.split(here, np.flatnonzero(np.diff(here) > reach) + 1):
                share = len(np.unique(shingles[group])) / len(own)
                if share >= containment:
                    out.append((int(number), t.names[i], int(group[0] - begins[number]), float(share)))
    return out


def op4_license_scan(docs: DataFrame) -> DataFrame:
    return scan(docs)
