"""License scans: MinHash bands over overlapping windows of words retrieve templates, shingle containment confirms.

Words are lower-cased runs of letters and digits, shingles are five words. Templates are grouped by length; for those of
up to L words a text is cut to windows of 2 L words, L apart, so that any occurrence lies whole in some window. A
template of which c of m shingles are left there, as few as count, has a likeness of at least c / (2 L - 4 + m - c) to
that window. Bands have one row; the number of bands of a group is set so that a pair of this least likeness shares none
with a probability of at most MISS. A text with a
window that shares a band with a template is searched for all its occurrences: runs of the template's shingles, in the
template's order and no longer than a window, that hold at least CONTAINED of them. Shingles in no such run count in any
order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.common import KEY, doc_id, documents, map_batches, one_row_per_document
from vitrina.llm.text_classifier import _WORD
from vitrina.llm.textbytes import _PLACE, SliceHash, chunks, encoded, mix

SHINGLE, CONTAINED, MISS = 5, 0.8, 1e-6
_rng = np.random.default_rng(4)

# Notices and headers by which licenses are declared.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at",
    "BSD-3-Clause-header": "Redistribution and use in source and binary forms, with or without modification, are "
                           "permitted provided that the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation, either version 3 of the "
                  "License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-header": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction",
}


def shingles(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(shingle hashes, start of each text's) of some texts at a time, in order; a text with fewer than SHINGLE words
    has none. The second array has one element more than there are texts."""
    for lo, hi in chunks(texts):
        b = np.frombuffer(b"\n".join(texts[lo:hi]).lower() + b"\n", np.uint8)
        first = np.cumsum([0] + [len(t) + 1 for t in texts[lo:hi]])
        edge = np.diff(_WORD[b].astype(np.int8), prepend=0, append=0)
        start = np.flatnonzero(edge == 1)
        w = SliceHash(b)(start, np.flatnonzero(edge == -1))
        text = np.searchsorted(first, start, side="right") - 1  # of each word
        n = max(len(w) - SHINGLE + 1, 0)
        s = np.zeros(n, np.uint64)
        for j in range(SHINGLE):
            s += w[j:j + n] * _PLACE[j]
        own = text[:n] == text[SHINGLE - 1:] if n else np.zeros(0, bool)
        yield mix(s[own]), np.searchsorted(text[:n][own], np.arange(hi - lo + 1))


class Group:
    """Templates of similar length with their bands."""

    def __init__(self, words: int, templates: dict[str, np.ndarray]):
        self.words, self.names = words, list(templates)
        self.sets, self.places = [], []
        for t in templates.values():
            own, of = np.unique(t, return_inverse=True)
            self.sets.append(own)
            self.places.append([np.flatnonzero(of == i).tolist() for i in range(len(own))])
        held = [math.ceil(CONTAINED * len(s)) for s in self.sets]
        least = min(c / (2 * words - SHINGLE + 1 + len(s) - c) for c, s in zip(held, self.sets))
        self.bands = math.ceil(math.log(MISS) / math.log1p(-min(least, 0.9)))
        self.xor = _rng.integers(0, 2 ** 64, self.bands, dtype=np.uint64)
        self.times = _rng.integers(0, 2 ** 64, self.bands, dtype=np.uint64) | np.uint64(1)
        self.keys = np.array([[((s ^ x) * t).min() for x, t in zip(self.xor, self.times)] for s in self.sets])

    def candidates(self, s: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
        """(text, template) where a window of the text shares a band with the template. ``s``, ``at``: as of
        ``shingles``."""
        size = np.diff(at)
        windows = -(-size // self.words)
        text = np.repeat(np.arange(len(size)), windows)
        starts = at[text] + (np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)) * self.words
        if not len(starts):
            return []
        # a window is a block of ``words`` shingles and the part of the next one that it still covers
        rest = np.minimum(starts + self.words, at[text + 1])
        end = np.minimum(starts + 2 * self.words - SHINGLE + 1, at[text + 1])
        more = end > rest
        cuts = np.stack([rest, end], 1)[more].ravel()
        found = np.zeros((len(self.sets), len(starts)), bool)
        for band in range(self.bands):
            h = (s ^ self.xor[band]) * self.times[band]
            least = np.minimum.reduceat(h, starts)
            if len(cuts):
                tail = np.minimum.reduceat(np.append(h, np.uint64(2 ** 64 - 1)), cuts)[::2]
                least[more] = np.minimum(least[more], tail)
            found |= least[None, :] == self.keys[:, band, None]
        return sorted({(int(text[j]), int(i)) for i, j in zip(*np.nonzero(found))})

    def occurrences(self, s: np.ndarray, i: int) -> list[tuple[int, float]]:
        """(first word, containment) of all occurrences of template ``i`` in a text with the shingles ``s``.

        The first word is where the template's own would be, so lost words at the start do not move it. Each shingle of
        the text counts for one occurrence at most.
        """
        own, places = self.sets[i], self.places[i]
        slot = np.minimum(np.searchsorted(own, s), len(own) - 1)
        held = np.flatnonzero(own[slot] == s)
        span = 2 * self.words - SHINGLE + 1
        need = CONTAINED * len(own)
        runs: list[list[tuple[int, int, int]]] = []  # (position, shingle, place in the template)
        for p, u in zip(held.tolist(), slot[held].tolist()):
            if runs and p - runs[-1][0][0] < span:
                after = next((x for x in places[u] if x > runs[-1][-1][2]), None)
                if after is not None:
                    runs[-1].append((p, u, after))
                    continue
            runs.append([(p, u, places[u][0])])
        found: list[tuple[int, float]] = []
        rest: list[tuple[int, int]] = []

        def any_order() -> None:
            lo, counts = 0, {}
            for hi, (p, u) in enumerate(rest):
                counts[u] = counts.get(u, 0) + 1
                while p - rest[lo][0] >= span or counts[rest[lo][1]] > 1:
                    v = rest[lo][1]
                    counts[v] -= 1
                    if not counts[v]:
                        del counts[v]
                    lo += 1
                # as long as the next one adds a shingle, the occurrence goes on
                more = hi + 1 < len(rest) and rest[hi + 1][0] - rest[lo][0] < span and rest[hi + 1][1] not in counts
                if len(counts) >= need and not more:
                    found.append((rest[lo][0], len(counts) / len(own)))
                    lo, counts = hi + 1, {}
            rest.clear()

        for run in runs:
            share = len({u for _, u, _ in run}) / len(own)
            if share >= CONTAINED:
                any_order()
                found.append((max(run[0][0] - run[0][2], 0), share))
            else:
                rest += [(p, u) for p, u, _ in run]
        any_order()
        return found

    def matches(self, s: np.ndarray, at: np.ndarray) -> list[tuple[int, str, int, float]]:
        """(text, template, first word, containment) of all occurrences, in the order of text, template and place."""
        return [(text, self.names[i], word, share) for text, i in self.candidates(s, at)
                for word, share in sorted(self.occurrences(s[at[text]:at[text + 1]], i))]


def groups(templates: dict[str, str]) -> list[Group]:
    """Templates by length, up to the next power of two."""
    by: dict[int, dict[str, np.ndarray]] = {}
    for name, text in templates.items():
        (s, _), = shingles([text.encode()])
        if not len(s):
            raise ValueError(f"template {name} has fewer than {SHINGLE} words")
        by.setdefault(1 << (len(s) + SHINGLE - 2).bit_length(), {})[name] = s
    return [Group(words, own) for words, own in sorted(by.items())]


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """(_doc, matches) of (_doc, text): an array of (license, first_word, containment), empty without a match or text.

    The templates and their bands go to the tasks with the function: they are a fixed list, not data.
    """
    own = groups(templates or TEMPLATES)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: list[list[dict]] = []
        for s, at in shingles(encoded(batch.column(1))):
            found += [[] for _ in range(len(at) - 1)]
            for text, name, word, share in (m for g in own for m in g.matches(s, at)):
                found[text - len(at) + 1].append({"license": name, "first_word": word, "containment": share})
        kind = pa.list_(pa.struct([("license", pa.string()), ("first_word", pa.int64()), ("containment", pa.float64())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=[KEY, "matches"])
    return map_batches(docs.select(KEY, "text"), rows,
                       f"{KEY} long, matches array<struct<license: string, first_word: bigint, containment: double>>")


def op4_license_scan(spark, sf_dir):
    """Licenses declared in ``documents``: one row per doc_id, ``licenses`` the distinct names in order, joined by commas
    (empty without a match), ``n_matches`` the occurrences, ``best`` the highest containment (null without)."""
    d = license_matches(one_row_per_document(documents(spark, sf_dir)))
    names = F.sort_array(F.array_distinct(F.col("matches.license")))
    return d.select(doc_id(), F.array_join(names, ",").alias("licenses"), F.size("matches").cast("long").alias("n_matches"),
                    F.array_max(F.col("matches.containment")).alias("best"))
