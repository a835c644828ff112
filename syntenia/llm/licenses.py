"""License scans by template-markup matching.

A license notice is written as a template: plain words are mandatory, ``{a|b}``
is a replaceable region with fixed choices, ``[words]`` an optional region and
``<name:k>`` a replaceable region of up to k words. Each template is compiled to
a token automaton; the text is read as words, and a notice is accepted where the
mandatory wording matches exactly, whatever stands in the other regions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syntenia.llm import common

#: Phrases of the base scan and their labels.
PHRASES = {(b"cc", b"by"): "cc-by", (b"general", b"public", b"license"): "gpl", (b"all", b"rights", b"reserved"): "reserved"}

#: label: template
TEMPLATES = {
    "apache-2.0": "licensed under the apache license [version] 2 0",
    "mit": "{released|distributed|licensed|available} under the [terms of the] mit license",
    "bsd": "{released|distributed|licensed|available} under the [terms of the] [new|simplified|revised] bsd [<n:2> clause] license",
    "gpl-notice": "{released|distributed|licensed} under the [terms of the] gnu general public license [version <n:2>]",
    "lgpl-notice": "{released|distributed|licensed} under the [terms of the] gnu lesser general public license [version <n:2>]",
    "mpl-2.0": "subject to the terms of the mozilla public license [v] [version] 2 0",
    "cc-by-notice": "licensed under [a] [the] {cc|creative commons} {by|attribution} [<kind:3>] <version:2>",
    "copyright-notice": "copyright [c] <holder:8> all rights reserved",
    "mit-body": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files [the software] to deal in the software without restriction "
    "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
    "subject to the following conditions the above copyright notice and this permission notice [including the next paragraph] shall be included in all copies or substantial portions of the software",
    "isc-body": "permission to use copy modify and [or] distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-body": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "[1] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "[2] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
    "[[3] neither the name of [the] <holder:12> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission]",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
}

_NOT_WORD = bytes(i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 else 0x20 for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words after A-Z are lower-cased: ASCII letters, digits and all beyond ASCII."""
    return (text or "").encode().lower().translate(_NOT_WORD).split()


class Automaton:
    """A non-deterministic automaton over words.

    ``edges[state]`` lists (word or None for any, next state); ``free[state]`` the
    states reached without a word. State sets are advanced word by word.
    """

    def __init__(self, template: str):
        self.edges: list[list[tuple[bytes | None, int]]] = [[]]
        self.free: list[set[int]] = [set()]
        self.mandatory = 0
        self.wording: set[bytes] = set()  # words that every accepted notice holds
        end = self._sequence(re.findall(r"\[|\]|\{[^}]*\}|<\w+:\d+>|\||\w+", template.lower()), 0)
        self.last = end
        self.start = self._closure({0})
        self.first = {w for s in self.start for w, _ in self.edges[s]}

    def _new(self) -> int:
        self.edges.append([])
        self.free.append(set())
        return len(self.edges) - 1

    def _words(self, at: int, words: list[str], depth: int) -> int:
        for w in words:
            nxt = self._new()
            self.edges[at].append((w.encode(), nxt))
            self.mandatory += not depth
            if not depth:
                self.wording.add(w.encode())
            at = nxt
        return at

    def _sequence(self, parts: list[str], at: int) -> int:
        entry: list[tuple[int, list[int]]] = []  # of open optional regions: where they begin, ends of their choices
        for p in parts:
            if p == "[":
                entry.append((at, []))
            elif p == "|":
                entry[-1][1].append(at)
                at = entry[-1][0]
            elif p == "]":
                begin, ends = entry.pop()
                out = self._new()
                for e in (*ends, at, begin):
                    self.free[e].add(out)
                at = out
            elif p[0] == "{":
                out = self._new()
                for choice in p[1:-1].split("|"):
                    self.free[self._words(at, choice.split(), 1)].add(out)
                self.mandatory += not entry
                at = out
            elif p[0] == "<":
                out = self._new()
                for _ in range(int(p[1:-1].split(":")[1])):
                    nxt = self._new()
                    self.edges[at].append((None, nxt))
                    self.free[nxt].add(out)
                    at = nxt
                at = out
            else:
                at = self._words(at, [p], len(entry))
        return at

    def _closure(self, states: set[int]) -> frozenset[int]:
        todo = list(states)
        while todo:
            for s in self.free[todo.pop()] - states:
                states.add(s)
                todo.append(s)
        return frozenset(states)

    def accepts(self, words: list[bytes], at: int) -> int:
        """The end of the shortest accepted notice from ``at``, or -1."""
        states, i = self.start, at
        while states:
            if self.last in states:
                return i
            if i == len(words):
                return -1
            w = words[i]
            states = self._closure({t for s in states for x, t in self.edges[s] if x is None or x == w})
            i += 1
        return -1


AUTOMATA = {label: Automaton(t) for label, t in TEMPLATES.items()}
#: A notice can begin only at these words.
STARTS = {w for a in AUTOMATA.values() for w in a.first}
#: The longest mandatory word of each template: a text without any of these holds no notice.
HINTS = {max(sorted(a.wording), key=len) for a in AUTOMATA.values()}


def scan_text(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    words = words_of(text)
    have = set(words)
    base: list[tuple[int, str]] = []
    for phrase, label in PHRASES.items():
        if have.issuperset(phrase):
            i = -1
            while True:
                try:
                    i = words.index(phrase[0], i + 1)
                except ValueError:
                    break
                if tuple(words[i : i + len(phrase)]) == phrase:
                    base.append((i, label))
    own: dict[str, int] = {}
    if not have.isdisjoint(HINTS):
        for w in STARTS & have:
            i = -1
            while True:
                try:
                    i = words.index(w, i + 1)
                except ValueError:
                    break
                for label, a in AUTOMATA.items():
                    if w in a.first and (end := a.accepts(words, i)) >= 0:
                        own[label] = max(own.get(label, 0), a.mandatory)
    labels = {x for _, x in base}
    score = 1.0 if own else 0.5 if base else 0.0
    at = [i for i, _ in base]
    return len(words), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | set(own))), score


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: base places and labels, labels of accepted templates, score.

    score is 1 where a template's mandatory wording is accepted, 0.5 where only
    base phrases stand, else 0. Null and empty texts: no words, first_word and
    last_word null, empty labels, score 0. Repeated rows give a row each; an empty
    table gives no rows; only doc_id and text are read. A notice's length is
    bounded by its template, so the work is linear in the text.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        for b in batches:
            rows = [scan_text(t) for k in range(0, b.num_rows, 256) for t in b.column(1).slice(k, 256).to_pylist()]
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))], names)

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    return src.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op9_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(common.table(spark, sf_dir, "documents"))
