"""Licence scans: files streamed through a generalised suffix automaton of licence templates.

The automaton holds every run of words of every template. Streaming the words of a file gives, at
each word, the longest run ending there that some template has. Long matches are chained by place in
the file and in the template; the share of a template that its best chain covers scores the file.
Only chains count that hold words which tell the template from other licences.

The templates are a fixed, short list, so automaton and lookup tables have a fixed size and travel
with the task. A word outside all templates ends every match, so only runs of known words are
streamed word by word; everything else is done on whole batches. Chains go on over such words, as
edited notices have them.

Cases: null and empty texts have no words and no labels. Ties between templates of equal coverage
give all their labels. Columns of the input named like new ones are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tablestream.llm.textarrays import ALPHANUMERIC, LOWER, Hashes, Words, flat, per_text_sum, slices

# Licence notices as their stewards publish them, label by label.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
               "file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of "
            "the GNU General Public License as published by the Free Software Foundation, either version "
            "3 of the License, or (at your option) any later version"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                 "International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
            "without fee is hereby granted, provided that the above copyright notice and this permission "
            "notice appear in all copies"),
    ("0bsd", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
             "without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
             "WARRANTIES WITH REGARD TO THIS SOFTWARE"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of "
             "the GNU Lesser General Public License as published by the Free Software Foundation; either "
             "version 2.1 of the License, or (at your option) any later version"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of "
             "the GNU Affero General Public License as published by the Free Software Foundation, either "
             "version 3 of the License, or (at your option) any later version"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                 "License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or "
            "neighboring rights to this work"),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be "
                     "used to endorse or promote products derived from this software without specific "
                     "prior written permission"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("epl", "This program and the accompanying materials are made available under the terms of the "
            "Eclipse Public License v. 2.0"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event "
             "will the authors be held liable for any damages arising from the use of this software"),
    ("boost", "Permission is hereby granted, free of charge, to any person or organization obtaining a "
              "copy of the software and accompanying documentation covered by this license"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]
# Phrases that label a file wherever their words stand.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
# Words that name a licence. The rest of a template that has some also stands in notices
# of other licences.
NAMING = [
    "mit", "apache", "gnu", "general public license", "nc", "noncommercial", "mozilla", "affero", "lesser",
    "sa", "sharealike", "eclipse",
]
# Labels that take the place of a more general one where their templates cover its words.
INSTEAD_OF = {
    "agpl": ["gpl"], "lgpl": ["gpl"], "cc-by-nc": ["cc-by"], "cc-by-sa": ["cc-by"], "isc": ["0bsd"],
}

#: Shortest match, in words, that a chain takes up, and the share of a template that labels a file.
LONG = 3
COVERED = 0.6
#: Distance of two matches of a chain, in lengths of the template.
GAP = 2
NAMES = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label:string,start:long,end:long,score:double>>"
)


def split(text: str) -> list[bytes]:
    return re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower())


class SuffixAutomaton:
    """All runs of words of several sequences. Each state knows where, in which sequences, its runs
    first end; sequences are short, so a state keeps one place for each of them."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]
        for number, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].setdefault(number, place)
        # A run ends wherever a longer run with the same ending does.
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            above = self.ends[self.link[state]]
            for number, place in self.ends[state].items():
                above[number] = min(above.get(number, place), place)

    def _state(self, length: int, next_: dict[int, int], link: int) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.next) - 1

    def _split(self, state: int, word: int) -> int:
        """The state of the longest run that ends with the word after the runs of ``state``."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word)
        return new

    def statistics(self, words: list[int]) -> list[tuple[int, int]]:
        """State and length of the longest run that ends at each word."""
        state, length, out = 0, 0, []
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            out.append((state, length))
        return out


class Scanner:
    def __init__(self, templates: list[tuple[str, str]]):
        self.labels = [label for label, _ in templates]
        texts = [split(text) for _, text in templates]
        phrases = [split(text) for text, _ in PHRASES]
        known = sorted({w for t in texts + phrases for w in t})
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in known])])
        raw = np.frombuffer(b"".join(known), np.uint8)
        codes = Hashes(raw)(bounds[:-1], bounds[1:])
        order = np.argsort(codes)
        self.codes = codes[order]
        self.numbers = order
        number = {w: k for k, w in enumerate(known)}
        self.lengths = [len(t) for t in texts]
        self.automaton = SuffixAutomaton([[number[w] for w in t] for t in texts])
        naming = [split(text) for text in NAMING]
        self.named = [
            [(k, k + len(n)) for n in naming for k in range(len(t)) if t[k : k + len(n)] == n] for t in texts
        ]
        self.phrases = [np.array([number[w] for w in p]) for p in phrases]

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, -1 for words of no template."""
        at = np.minimum(np.searchsorted(self.codes, hashes), len(self.codes) - 1)
        return np.where(self.codes[at] == hashes, self.numbers[at], -1)

    def _tells(self, state: int, number: int, end: int, length: int) -> bool:
        """Whether a match tells a template from others: it has words that name the licence or, in a
        template without such words, it stands in templates of one label only."""
        if self.named[number]:
            return any(end - length < a and b <= end + 1 for a, b in self.named[number])
        return len({self.labels[other] for other in self.automaton.ends[state]}) == 1

    def matches(self, words: list[int], first: int) -> Iterator[tuple[int, int, int, int, bool]]:
        """Template, last place in the file and in the template, length, and whether it tells the
        template from others, of each long match in one run of known words that begins at place
        ``first``."""
        stats = self.automaton.statistics(words)
        for k, (state, length) in enumerate(stats):
            # A match is over where the next word doesn't make it longer.
            if length >= LONG and (k + 1 == len(stats) or stats[k + 1][1] <= length):
                for number, end in self.automaton.ends[state].items():
                    yield number, first + k, end, length, self._tells(state, number, end, length)

    def _best(self, number: int, matches: list[tuple[int, int, int, bool]]) -> tuple[int, int, int] | None:
        """Covered words, first and last place in the file, of the best chain that tells the template
        from others; None if there is none."""
        reach = GAP * self.lengths[number]
        # Place in the file and in the template, covered words and start of the best chain, and of the
        # best one that tells.
        best: list[tuple[int, int, tuple[int, int], tuple[int, int] | None]] = []
        for k, end, length, tells in matches:
            top = (length, k - length + 1)
            told = top if tells else None
            for before, place, chain, telling in reversed(best):
                if k - before > reach:
                    break  # too far apart to be one notice
                # What both have of the template counts once; chains go forward in both.
                fresh = min(length, end - place, k - before)
                if fresh > 0:
                    top = max(top, (chain[0] + fresh, chain[1]))
                    own = chain if tells else telling
                    if own:
                        own = (own[0] + fresh, own[1])
                        told = max(told, own) if told else own
            best.append((k, end, top, told))
        # Of equals the shortest; of those one in the middle, so that few steps part many copies.
        middle = (len(best) - 1) / 2
        found = [(*told, k, i) for i, (k, _, _, told) in enumerate(best) if told]
        return max(found, key=lambda c: (c[0], c[1] - c[2], -abs(c[3] - middle)))[:3] if found else None

    def chains(self, found: dict[int, list[tuple[int, int, int, bool]]]) -> Iterator[tuple[int, int, int, int]]:
        """Template, covered words, first and last place in the file, of the best chain of each
        template over the matches of a whole text, and of further ones before and after a chain
        that covers enough."""
        for number, matches in found.items():
            parts = [matches]
            while parts:
                part = parts.pop()
                chain = self._best(number, part)
                if chain is None:
                    continue
                covered, start, end = chain
                yield number, covered, start, end
                if covered / self.lengths[number] >= COVERED:
                    sides = [m for m in part if m[0] < start], [m for m in part if m[0] - m[2] >= end]
                    parts.extend(side for side in sides if side)


def _special(spans: list[dict]) -> list[dict]:
    """The spans in order, without those of a general label that share words with a more special one of
    at least their coverage."""
    out = [
        s for s in spans
        if not any(
            s["label"] in INSTEAD_OF.get(o["label"], ()) and o["start"] < s["end"] and s["start"] < o["end"]
            and o["score"] >= s["score"]
            for o in spans
        )
    ]
    return sorted(out, key=lambda s: (s["start"], s["end"]))


def scan(docs: DataFrame, text: str = "text", templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """Add the columns of ``SCHEMA`` to each row: counts and places of the phrases, labels of the
    phrases and of templates covered to 60 % or more, the highest coverage, and the covered spans."""
    docs = docs.drop(*NAMES)
    templates = templates or TEMPLATES
    kind = pa.list_(
        pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for part in slices(batches, text):
            raw, offsets = flat(part.column(text))
            raw = LOWER[raw]
            words = Words(raw, offsets, ALPHANUMERIC)
            number = scanner.lookup(Hashes(raw)(words.start, words.end))
            n, total = part.num_rows, len(words)
            place = np.arange(total) - words.bounds[words.text]
            left = words.bounds[words.text + 1] - np.arange(total)
            base, labels = np.zeros(total, np.int64), [set() for _ in range(n)]
            for phrase, (_, label) in zip(scanner.phrases, PHRASES, strict=True):
                hit = left >= len(phrase)
                for k, word in enumerate(phrase):
                    hit[: total - k] &= number[k:] == word
                    hit[total - k :] = False
                base += hit
                for t in np.unique(words.text[hit]).tolist():
                    labels[t].add(label)
            first = np.full(n, np.iinfo(np.int64).max)
            last = np.full(n, -1)
            at = np.flatnonzero(base)
            np.minimum.at(first, words.text[at], place[at])
            np.maximum.at(last, words.text[at], place[at])
            # Runs of known words, within one text, long enough for a match.
            known = number >= 0
            begins = known.copy()
            begins[1:] &= ~known[:-1] | (words.text[1:] != words.text[:-1])
            ends = known.copy()
            ends[:-1] &= ~known[1:] | (words.text[1:] != words.text[:-1])
            begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
            spans: list[list[dict]] = [[] for _ in range(n)]
            score = np.zeros(n)
            found: dict[int, dict[int, list[tuple[int, int, int, bool]]]] = {}
            for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                if b - a < LONG:
                    continue
                own = found.setdefault(int(words.text[a]), {})
                for which, *match in scanner.matches(number[a:b].tolist(), int(place[a])):
                    own.setdefault(which, []).append(tuple(match))
            for t, own in found.items():
                for which, covered, start, stop in scanner.chains(own):
                    share = covered / scanner.lengths[which]
                    score[t] = max(score[t], share)
                    if share >= COVERED:
                        spans[t].append(
                            {"label": scanner.labels[which], "start": start, "end": stop + 1, "score": share}
                        )
                spans[t] = _special(spans[t])
            some = last >= 0
            base_labels = [sorted(own) for own in labels]
            both = [sorted(own | {s["label"] for s in more}) for own, more in zip(labels, spans, strict=True)]
            new = [
                pa.array(words.counts), pa.array(per_text_sum(base, words.bounds)),
                pa.array(first, mask=~some), pa.array(last, mask=~some),
                pa.array([",".join(own) for own in base_labels]), pa.array([",".join(own) for own in both]),
                pa.array(np.minimum(1.0, score)), pa.array(spans, kind),
            ]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *NAMES])

    added = StructType.fromDDL(SCHEMA)
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *added.fields]))
