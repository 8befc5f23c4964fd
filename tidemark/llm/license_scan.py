"""Licence texts in documents, by a generalised suffix automaton over licence words.

Templates are notices of a sentence and whole licence texts, the files of ``licences``, which
the tasks read.  The templates' words form one automaton.  A document's words are streamed through it, which
gives the matching statistics: at every word the longest run ending there that occurs in any
template.  Runs of at least ``min_run`` words that cannot be extended are kept, placed in the
templates they occur in and chained per template: runs that follow one another in the text
and in the template, at most ``max_gap`` words apart in the text, form one span.  A template's
label is added when one chain covers at least ``min_share`` of its words and no overlapping
chain covers more.  Templates of a few words share their openings, so they need
``SHORT_SHARE``.  Of a whole text a stretch is enough: ``STRETCH`` words in one chain, and
``min_share`` of the words from its first to its last.  Where overlapping chains of different labels cover equally much, the words
decide that one template has and the other has not: the one of which fewer are missing stays,
and neither does when as many are missing of both.  A stretch that stands in several whole
texts gets the labels of all of them.  A notice beside a word that only another
licence has (``VETO``) gives no label.  Base phrases give their labels wherever they stand.

Words are runs of a-z, 0-9 and characters beyond ASCII after lower-casing A-Z.  A null or
empty text has no words, no places, empty labels and score 0.  Repeated rows are judged
alike, an empty table gives an empty result, other columns are not read.  A text is streamed
whole, whatever its length.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import pkgutil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import map_batches, words_of

MIN_RUN = 4
MAX_GAP = 12
MIN_SHARE = 0.5
#: Templates below so many words need a larger share.
SHORT, SHORT_SHARE = 16, 0.8
#: Words of a whole licence text that count as a part of it.
STRETCH = 20

# Phrases that name a licence and the label each gives.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Public notices and clauses of well-known licences, by label.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the \"Software\"), to deal in the"
        " Software without restriction, including without limitation the rights to use, copy,"
        " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this"
        " file except in compliance with the License.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the"
        " terms of the GNU General Public License as published by the Free Software"
        " Foundation",
    ),
    (
        "lgpl",
        "This library is free software: you can redistribute it and/or modify it under the"
        " terms of the GNU Lesser General Public License as published by the Free Software"
        " Foundation",
    ),
    (
        "agpl",
        "This program is free software: you can redistribute it and/or modify it under the"
        " terms of the GNU Affero General Public License as published by the Free Software"
        " Foundation",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("lgpl", "This work is licensed under the GNU Lesser General Public License"),
    ("agpl", "This work is licensed under the GNU Affero General Public License"),
    (
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution license"),
    (
        "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution-NonCommercial license",
    ),
    (
        "cc-by-sa",
        "This work is licensed under a Creative Commons Attribution-ShareAlike license",
    ),
    ("cc0", "To the extent possible under law, the author has waived all copyright"),
    (
        "cc-by-nd",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives license",
    ),
    (
        "cc-by-nc-sa",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike"
        " license",
    ),
    (
        "cc-by-nc-nd",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives"
        " license",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0."),
    ("gpl", "Licensed under the GNU General Public License v3.0"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("apache-2", "SPDX-License-Identifier: Apache-2.0"),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("bsd", "SPDX-License-Identifier: BSD-2-Clause"),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("gpl", "SPDX-License-Identifier: GPL-2.0-only"),
    ("lgpl", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("agpl", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("mpl-2", "SPDX-License-Identifier: MPL-2.0"),
    ("all-rights-reserved", "All rights reserved. No part of this work may be reproduced"),
]

# Words that a notice of the licence does not have: beside it they name another one.
_NC, _ND = {b"nc", b"noncommercial"}, {b"nd", b"noderivatives", b"noderivs"}
_SA = {b"sa", b"sharealike"}
VETO = {
    "cc-by": frozenset(_NC | _ND | _SA),
    "cc-by-nc": frozenset(_ND | _SA),
    "cc-by-sa": frozenset(_NC | _ND),
    "cc-by-nd": frozenset(_NC | _SA),
    "cc-by-nc-sa": frozenset(_ND),
    "cc-by-nc-nd": frozenset(_SA),
    "gpl": frozenset({b"lesser", b"library", b"affero"}),
}

# Files of whole licence texts: label, and after a dot the version where one label has several.
WHOLE_TEXTS = (
    "apache-2 artistic bsd cc0 gfdl.1-2 gfdl.1-3 gpl.1 gpl.2 gpl.3 isc lgpl.2 lgpl.2-1 lgpl.3"
    " mit mpl-1 mpl-2 unlicense zlib"
).split()


def whole_texts() -> list[tuple[str, str]]:
    """The whole licence texts by label; read from the package, zipped or not."""
    return [
        (name.split(".")[0], pkgutil.get_data(__package__, f"licences/{name}.txt").decode())
        for name in WHOLE_TEXTS
    ]


class SuffixAutomaton:
    """Generalised suffix automaton: the runs of words of several sequences."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends: list[set[tuple[int, int]]] = [set()]  # (sequence, place of the last word)
        for number, words in enumerate(sequences):
            last = 0
            for place, word in enumerate(words):
                last = self._extend(last, word)
                self.ends[last].add((number, place))
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(last, word, known)
        state = self._new(self.length[last] + 1, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
            return state
        known = self.next[at][word]
        fits = self.length[known] == self.length[at] + 1
        self.link[state] = known if fits else self._clone(at, word, known)
        return state

    def _new(self, length: int, edges: dict[bytes, int]) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _clone(self, at: int, word: bytes, known: int) -> int:
        copy = self._new(self.length[at] + 1, dict(self.next[known]))
        self.link[copy] = self.link[known]
        self.link[known] = copy
        while at >= 0 and self.next[at].get(word) == known:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def runs(self, words: list[bytes], shortest: int) -> list[tuple[int, int, int]]:
        """Maximal runs: (place of the last word, length, state), in the order of the text."""
        found, state, size, step = [], 0, 0, self.next[0]
        for place, word in enumerate(words):
            if word in step:
                state = step[word]
                size += 1
                step = self.next[state]
                continue
            if not size:
                continue
            if size >= shortest:
                found.append((place - 1, size, state))
            while state > 0 and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                size += 1
            step = self.next[state]
        if size >= shortest:
            found.append((len(words) - 1, size, state))
        return found


Span = tuple[int, int, int, int]  # words covered, template, first word, past the last word


def _uncovered(spans: list[Span]) -> list[Span]:
    """Licences share wording: where chains overlap, the one that covers more counts.  Chains are
    taken up by what they cover, and each is looked for among the stretches kept before, which
    are disjoint and sorted, so the time grows with the number of chains, not with its square."""
    kept: list[Span] = []
    starts: list[int] = []
    stops: list[int] = []
    for _, equal in itertools.groupby(sorted(spans, reverse=True), key=lambda x: x[0]):
        fresh = []
        for span in equal:
            at = bisect.bisect_right(stops, span[2])  # the first stretch that ends beyond its start
            if at == len(stops) or starts[at] >= span[3]:
                fresh.append(span)
        kept += fresh
        for _, _, first, stop in fresh:
            low, high = bisect.bisect_left(stops, first), bisect.bisect_right(starts, stop)
            if low < high:
                first, stop = min(first, starts[low]), max(stop, stops[high - 1])
            starts[low:high], stops[low:high] = [first], [stop]
    return kept


class LicenceScanner:
    def __init__(self, templates, phrases, min_run, max_gap, min_share, bodies=()):
        self.notices = len(templates)  # whole texts have the numbers from here on
        templates = [*templates, *bodies]
        self.labels = [label for label, _ in templates]
        texts = [words_of(text) for _, text in templates]
        self.sizes = [len(words) for words in texts]
        self.texts, self.vocabularies = texts, [set(words) for words in texts]
        self.automaton = SuffixAutomaton(texts)
        self.min_run, self.max_gap, self.min_share = min_run, max_gap, min_share
        self.phrases = [(words_of(phrase), label) for phrase, label in phrases.items()]

    def places(self, words: list[bytes]) -> list[tuple[int, str]]:
        """Every place where a phrase stands, with its label."""
        found = []
        for phrase, label in self.phrases:
            at = -1
            try:
                while phrase:
                    at = words.index(phrase[0], at + 1)
                    if words[at : at + len(phrase)] == phrase:
                        found.append((at, label))
            except ValueError:
                pass
        return found

    def _needed(self, number: int, first: int, stop: int) -> float:
        size = self.sizes[number]
        if number >= self.notices:
            return max(min(STRETCH, self.min_share * size), self.min_share * (stop - first))
        return size * (max(self.min_share, SHORT_SHARE) if size < SHORT else self.min_share)

    def _of(self, number: int, first: int, stop: int) -> int:
        """The words that a share is of: those of a notice, or of the stretch of a whole text."""
        return self.sizes[number] if number < self.notices else stop - first

    def _gives_way(self, span, other, words: list[bytes]) -> bool:
        """Whether the words that tell two equal chains apart do not support the first."""
        (covered, number, first, stop), (others, rival, start, end) = span, other
        if covered != others or self.labels[number] == self.labels[rival]:
            return others > covered
        if max(number, rival) >= self.notices:
            return False
        here = set(words[min(first, start) : max(stop, end) + self.max_gap])
        own = self.vocabularies[number] - self.vocabularies[rival] - here
        its = self.vocabularies[rival] - self.vocabularies[number] - here
        return len(own) >= len(its) and bool(own)

    def _supported(self, spans: list[Span], words: list[bytes]) -> list[Span]:
        """Without the spans that give way to an equal one they overlap, or that stand beside a
        word that only another licence has."""
        loses, active = set(), []
        ordered = sorted(spans, key=lambda x: (x[2], x[3]))
        for span in ordered:
            active = [o for o in active if span[2] < o[3]]
            for other in active:  # as many as templates match here
                loses |= {a for a, b in ((span, other), (other, span)) if self._gives_way(a, b, words)}
            active.append(span)
        return [s for s in ordered if s not in loses and not self._vetoed(s, words)]

    def _vetoed(self, span: Span, words: list[bytes]) -> bool:
        _, number, first, stop = span
        if number >= self.notices:
            return False
        strange = VETO.get(self.labels[number], frozenset())
        return not strange.isdisjoint(words[first : stop + 2])

    def spans(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """Chains of long matches: label, first word, past the last word, covered share."""
        chains: dict[int, list[list[int]]] = {}  # template: [first, stop, last in it, covered]
        for place, size, state in self.automaton.runs(words, self.min_run):
            start = place - size + 1
            for number, last in sorted(self.automaton.ends[state]):
                own = chains.setdefault(number, [])
                chain = None
                for old in reversed(own):
                    if start - old[1] > self.max_gap:
                        break
                    if old[2] < last and old[1] <= place:
                        chain = old
                        break
                if chain is None:
                    own.append([start, place + 1, last, size])
                else:
                    fresh = min(size, last - chain[2], place + 1 - chain[1])
                    chain[1:] = [place + 1, last, chain[3] + fresh]
        long_enough = [
            (covered, number, first, stop)
            for number, own in chains.items()
            for first, stop, _, covered in own
            if covered >= self._needed(number, first, stop)
        ]
        kept = self._supported(_uncovered(long_enough), words)
        return [
            (self.labels[number], first, stop, min(1.0, covered / self._of(number, first, stop)))
            for covered, number, first, stop in sorted(kept, key=lambda x: (x[2], x[1]))
        ]


@functools.cache
def _scanner(templates, phrases, min_run, max_gap, min_share, bodies) -> LicenceScanner:
    bodies = whole_texts() if bodies is None else bodies
    return LicenceScanner(templates, dict(phrases), min_run, max_gap, min_share, bodies)


def scan_licences(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    phrases: dict[str, str] | None = None,
    min_run: int = MIN_RUN,
    max_gap: int = MAX_GAP,
    min_share: float = MIN_SHARE,
    bodies: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Per row: ``n_words``, ``n_base`` (places of phrases), ``first_word`` and ``last_word``
    (smallest and largest start of those, else null), ``base_labels`` and ``labels`` (sorted,
    comma-joined), ``score`` (1 where a phrase stands, else the best covered share) and
    ``spans`` (label, first word, past the last word, covered share: of a notice, or of the
    stretch that is part of a whole text).  ``bodies`` are whole texts, default the package's."""
    settings = (
        tuple(TEMPLATES if templates is None else templates),
        tuple((PHRASES if phrases is None else phrases).items()),
        min_run,
        max_gap,
        min_share,
        None if bodies is None else tuple(bodies),
    )

    def make():
        scanner = _scanner(*settings)

        def work(columns):
            out = {name: [] for name in names}
            for text in columns["text"]:
                words = words_of(text)
                places, spans = scanner.places(words), scanner.spans(words)
                starts = [place for place, _ in places]
                base = {label for _, label in places}
                out["n_words"].append(len(words))
                out["n_base"].append(len(places))
                out["first_word"].append(min(starts, default=None))
                out["last_word"].append(max(starts, default=None))
                out["base_labels"].append(",".join(sorted(base)))
                out["labels"].append(",".join(sorted(base | {s[0] for s in spans})))
                out["score"].append(1.0 if base else max((s[3] for s in spans), default=0.0))
                out["spans"].append(
                    [dict(zip(("label", "first", "stop", "share"), span)) for span in spans]
                )
            return {id_col: columns["id"]} | out

        names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")
        names += ("score", "spans")
        return work

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = f"`{id_col}` long, n_words long, n_base long, first_word long, last_word long,"
    schema += " base_labels string, labels string, score double,"
    schema += " spans array<struct<label:string,first:bigint,stop:bigint,share:double>>"
    return map_batches(rows, make, schema)
