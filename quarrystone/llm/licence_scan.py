"""Licence scan: a suffix automaton of licence templates over word ids.

Templates are whole licence texts and notices (the files in ``licences``, one for each
label) and sentences by which works state a licence.  Words of a text are hashed
together, a slice of the batch at a time.  Only runs of
at least ``min_match`` words that all occur in some template can hold a match of
that length, so the automaton walks these runs alone and yields for each position
the longest match that ends there (the matching statistics).  Maximal matches, at every
place that a template has them, are chained for each template in text and template order
over short gaps; the chains that cover most of their template, and enough of it, and do
not overlap give a span and the label of the template.

The base phrases are counted at every place where their words stand consecutively.

Cases: null text = empty text = no words, null first and last places, empty labels,
score 0; equal matches of several templates count for each of them; of overlapping chains
that cover the same the first counts; repeated rows get the same result; very long texts
are read whole, one at a time; further columns of the input are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quarrystone.llm.common import LETTERS, hash_words, lower_ascii, slices, small_batches, table, text_bytes, tidied, word_spans

_WORD = re.compile(r"[a-z0-9\x80-\U0010ffff]+")

# Phrases and the labels that their occurrence gives.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Sentences by which works state a licence, by label.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "all rights reserved"),
]


def whole_licences() -> list[tuple[str, str]]:
    """Label and words of each licence text that comes with this module."""
    files = sorted((Path(__file__).parent / "licences").glob("*.txt"))
    return [(f.stem, " ".join(_WORD.findall(f.read_text().lower()))) for f in files]


class SuffixAutomaton:
    """All factors of some sequences.  ``ends[state]`` maps a sequence to the places where
    the state's factors end in it; states of factors shorter than ``least`` have none."""

    def __init__(self, sequences: list[list[int]], least: int = 1):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [{}]
        for number, seq in enumerate(sequences):
            last = 0
            for at, c in enumerate(seq):
                last = self._extend(last, c)
                self.ends[last].setdefault(number, set()).add(at)
        for s in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.length[self.link[s]] >= least:
                up = self.ends[self.link[s]]
                for number, places in self.ends[s].items():
                    up.setdefault(number, set()).update(places)

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.ends.append({})
        return len(self.link) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """The state of the factors of ``q`` no longer than those through ``p`` and ``c``."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if (q := self.next[last].get(c)) is not None:
            return self._split(last, q, c)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][c], c)
        return new

    def matches(self, tokens: list[int], least: int) -> list[tuple[int, int, int]]:
        """Maximal matches: (first token, tokens, state)."""
        out, state, n = [], 0, 0
        for at, c in enumerate(tokens):
            was, had = state, n
            while state and c not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            if (to := self.next[state].get(c)) is not None:
                state, n = to, n + 1
            else:
                state, n = 0, 0
            if had >= least and n <= had:
                out.append((at - had, had, was))
        if n >= least:
            out.append((len(tokens) - n, n, state))
        return out


class LicenceScanner:
    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str], min_match: int, gap: int, coverage: float):
        self.min_match, self.gap, self.coverage = min_match, gap, coverage
        self.labels = [label for label, _ in templates]
        split = [text.split() for _, text in templates]
        words = sorted({w for t in split for w in t} | {w for p in phrases for w in p.split()})
        raw = "".join(words).encode()
        ends = np.cumsum([len(w.encode()) for w in words])
        hashes = hash_words(np.frombuffer(raw, np.uint8), ends - [len(w.encode()) for w in words], ends)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]
        number = {w: k + 1 for k, w in enumerate(words)}
        self.sequences = [[number[w] for w in t] for t in split]
        self.automaton = SuffixAutomaton(self.sequences, min_match)
        self.in_template = np.zeros(len(words) + 1, bool)
        self.in_template[[c for s in self.sequences for c in s]] = True
        self.phrases = [([number[w] for w in p.split()], label) for p, label in phrases.items()]

    def spans(self, runs: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, float]]:
        """Covered spans (template, first word, end word, coverage) of one text from its runs of template words."""
        found: dict[int, list[tuple[int, int, int]]] = {}
        for start, tokens in runs:
            for at, n, state in self.automaton.matches(tokens, self.min_match):
                for t, ends in self.automaton.ends[state].items():
                    found.setdefault(t, []).extend((start + at, n, end - n + 1) for end in ends)
        out = []
        for t, hits in found.items():
            out += [(t, *span) for span in self._chains(sorted(hits), len(self.sequences[t]))]
        return sorted(out, key=lambda s: (s[1], s[0]))

    def _chains(self, hits: list[tuple[int, int, int]], size: int) -> list[tuple[int, int, float]]:
        """(first word, end word, coverage) of the chains of matches (place, words, place in the template)."""
        covered, first, low = [0] * len(hits), [0] * len(hits), 0
        longest = max(n for _, n, _ in hits)
        for k, (a, n, p) in enumerate(hits):
            covered[k], first[k] = n, a
            while hits[low][0] + longest + self.gap < a:
                low += 1
            for j in range(low, k):
                b, m, q = hits[j]
                if b < a <= b + m + self.gap and q < p:
                    new = n - max(0, b + m - a, q + m - p)
                    if new > 0 and covered[j] + new > covered[k]:
                        covered[k], first[k] = covered[j] + new, first[j]
        enough = [k for k in range(len(hits)) if covered[k] >= self.coverage * size]
        taken: list[tuple[int, int, float]] = []
        for k in sorted(enough, key=lambda k: (-covered[k], first[k])):
            span = (first[k], hits[k][0] + hits[k][1], covered[k] / size)
            at = bisect.bisect_left(taken, span)
            if (at == 0 or taken[at - 1][1] <= span[0]) and (at == len(taken) or taken[at][0] >= span[1]):
                taken.insert(at, span)
        return taken

    def scan(self, col: pa.Array) -> dict[str, list]:
        data, off = text_bytes(col)
        data = lower_ascii(data)
        starts, ends, doc = word_spans(data, off, LETTERS)
        docs = len(col)
        n_words = np.bincount(doc, minlength=docs)
        first = np.concatenate([[0], np.cumsum(n_words)[:-1]]).astype(np.int64)
        h = hash_words(data, starts, ends)
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        ids = np.where(self.sorted[at] == h, self.order[at] + 1, 0)
        n_base, low, high = np.zeros(docs, np.int64), np.full(docs, np.iinfo(np.int64).max), np.full(docs, -1)
        base: list[set[str]] = [set() for _ in range(docs)]
        for seq, label in self.phrases:
            m = len(seq)
            if len(ids) < m:
                continue
            hit = doc[m - 1 :] == doc[: len(doc) - m + 1]
            for k, c in enumerate(seq):
                hit &= ids[k : len(ids) - m + 1 + k] == c
            where = np.flatnonzero(hit)
            of = doc[where]
            np.add.at(n_base, of, 1)
            np.minimum.at(low, of, where - first[of])
            np.maximum.at(high, of, where - first[of])
            for d in set(of.tolist()):
                base[d].add(label)
        inside = self.in_template[ids]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        cut = np.flatnonzero(np.diff(doc)) + 1
        cut = cut[inside[cut] & inside[cut - 1]] if len(cut) else cut
        begin, end = np.sort(np.concatenate([edge[::2], cut])), np.sort(np.concatenate([edge[1::2], cut]))
        long = end - begin >= self.min_match
        runs: dict[int, list[tuple[int, list[int]]]] = {}
        for b, e in zip(begin[long].tolist(), end[long].tolist()):
            d = int(doc[b])
            runs.setdefault(d, []).append((b - int(first[d]), ids[b:e].tolist()))
        spans = [self.spans(runs[d]) if d in runs else [] for d in range(docs)]
        return {
            "n_words": n_words.tolist(),
            "n_base": n_base.tolist(),
            "first_word": [int(x) if n else None for x, n in zip(low, n_base)],
            "last_word": [int(x) if n else None for x, n in zip(high, n_base)],
            "base_labels": [",".join(sorted(b)) for b in base],
            "labels": [",".join(sorted(b | {self.labels[t] for t, *_ in s})) for b, s in zip(base, spans)],
            "score": [max((c for *_, c in s), default=0.0) for s in spans],
            "spans": [[{"label": self.labels[t], "start_word": a, "end_word": b, "coverage": c} for t, a, b, c in s] for s in spans],
        }


@functools.lru_cache(maxsize=2)
def _scanner(templates: tuple, phrases: tuple, min_match: int, gap: int, coverage: float) -> LicenceScanner:
    """Built once for each worker: the tasks that follow on it use it again."""
    return LicenceScanner(list(templates), dict(phrases), min_match, gap, coverage)


SCHEMA = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, spans array<struct<label:string,start_word:bigint,end_word:bigint,coverage:double>>"
_ARROW = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("label", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("coverage", pa.float64())])))]


def scan_licences(df: DataFrame, templates: list[tuple[str, str]] | None = None, phrases: dict[str, str] = PHRASES, min_match: int = 3, gap: int = 8, coverage: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence labels, spans and base phrases of each row.  Map-only: no shuffle."""
    templates = TEMPLATES + whole_licences() if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(tuple(templates), tuple(phrases.items()), min_match, gap, coverage)
        for b in batches:
            for some in slices(b, text_col):
                got = scanner.scan(some.column(1))
                yield pa.RecordBatch.from_arrays([some.column(0), *(pa.array(got[k], t) for k, t in _ARROW)], [id_col, *(k for k, _ in _ARROW)])

    kind = df.schema[id_col].dataType.simpleString()
    return small_batches(df.select(id_col, text_col)).mapInArrow(tidied(run), f"`{id_col}` {kind}, {SCHEMA}")


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents")).drop("spans")
