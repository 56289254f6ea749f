"""License scans: matching statistics against a suffix automaton of license texts, chained into template spans."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.texts import PLAIN, texts_of

#: Phrases that give a label wherever their words stand together. Fixed values.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: License notices as they stand in files, by label. Fixed values.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("mit", "Released under the MIT License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
]
SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
          "labels string, score double, spans array<struct<label:string,start:bigint,end:bigint,share:double>>")


def plain_words(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


class LicenseAutomaton:
    """A generalised suffix automaton of templates and phrases over word numbers.

    Its size is linear in the templates' words; it holds nothing of the corpus.
    """

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        texts = [(label, plain_words(text.encode()), False) for label, text in templates]
        texts += [(label, plain_words(text.encode()), True) for text, label in phrases.items()]
        self.texts = texts
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for number, (_, words, _) in enumerate(texts):
            last = 0
            for at, word in enumerate(words):
                last = self._add(last, self.ids.setdefault(word, len(self.ids)), ends)
                ends[last].add((number, at))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                ends[self.link[state]] |= ends[state]
        self.ends = [sorted(e) for e in ends]
        # the phrases that end wherever a state is reached with so many words
        own: list[list[tuple[int, str]]] = [[] for _ in self.link]
        for label, words, phrase in texts:
            if phrase:
                state = 0
                for word in words:
                    state = self.next[state][self.ids[word]]
                own[state].append((len(words), label))
        self.phrases = [[] for _ in self.link]
        for state in sorted(range(1, len(self.link)), key=lambda s: self.length[s]):
            self.phrases[state] = own[state] + self.phrases[self.link[state]]

    def _add(self, last: int, c: int, ends: list) -> int:
        def state(length: int, following: dict, link: int) -> int:
            self.length.append(length)
            self.next.append(following)
            self.link.append(link)
            ends.append(set())
            return len(self.length) - 1

        def clone(p: int, q: int) -> int:
            k = state(self.length[p] + 1, dict(self.next[q]), self.link[q])
            self.link[q] = k
            while p >= 0 and self.next[p].get(c) == q:
                self.next[p][c] = k
                p = self.link[p]
            return k

        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else clone(last, q)
        new, p = state(self.length[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else clone(p, q)
        return new

    def scan(self, words: list[bytes], least: int) -> tuple[list, list]:
        """Places (start, words, label) of phrases, and right-maximal matches (end, length, state) of ``least`` words and more."""
        places, matches = [], []
        state = length = 0
        following, link, lengths, phrases = self.next, self.link, self.length, self.phrases
        for i, c in enumerate(map(self.ids.get, words)):
            if c is None:
                if length >= least:
                    matches.append((i, length, state))
                state = length = 0
                continue
            if c not in following[state]:
                if length >= least:
                    matches.append((i, length, state))
                while state and c not in following[state]:
                    state = link[state]
                    length = lengths[state]
            to = following[state].get(c)
            if to is None:
                length = 0
                continue
            state = to
            length += 1
            for size, label in phrases[state]:
                if size <= length:
                    places.append((i + 1 - size, size, label))
        if length >= least:
            matches.append((len(words), length, state))
        return places, matches

    def chains(self, matches: list, gap: int) -> list[tuple[str, int, int, float]]:
        """(label, first word, end, share of the template) of chained matches, for every template they touch.

        Matches are taken in the order of the text; one joins the open chain of a template if it lies behind it in the template
        too and at most ``gap`` words on in both, else it opens a new chain.
        """
        open_chains: dict[int, list[int]] = {}
        closed = []
        for end, length, state in matches:
            for number, at in self.ends[state]:
                t_end = at + 1
                n = min(length, t_end)
                chain = open_chains.get(number)
                if chain:
                    over = max(0, chain[1] - (end - n), chain[2] - (t_end - n))
                    if over < n and end - n - chain[1] <= gap and t_end - n - chain[2] <= gap:
                        chain[1], chain[2], chain[3] = end, t_end, chain[3] + n - over
                        continue
                    closed.append((number, chain))
                open_chains[number] = [end - n, end, t_end, n]
        closed += open_chains.items()
        return [(self.texts[k][0], c[0], c[1], c[3] / len(self.texts[k][1])) for k, c in closed if not self.texts[k][2]]


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES,
                  least_words: int = 3, gap: int = 8, least_share: float = 0.6) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``spans`` has each covered template span with its label, words from start to before end, and share of the template. A
    label is given by a phrase, or by a chain that covers ``least_share`` of a template. ``score`` is 1 with a phrase, else the
    largest share covered. Null and empty texts have no words and score 0. Whole texts are streamed; memory is that of one
    text and the templates. Only doc_id and text are read.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = LicenseAutomaton(templates, phrases)
        for batch in batches:
            rows = []
            for text in texts_of(batch.column(1)):
                words = plain_words(text)
                places, matches = automaton.scan(words, least_words)
                chains = automaton.chains(matches, gap) if matches else []
                spans = [c for c in chains if c[3] >= least_share]
                base = {p[2] for p in places}
                starts = [p[0] for p in places]
                rows.append((
                    len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                    ",".join(sorted(base | {s[0] for s in spans})),
                    1.0 if base else min(1.0, max((c[3] for c in chains), default=0.0)),
                    [dict(zip(("label", "start", "end", "share"), s)) for s in spans]))
            columns = list(zip(*rows)) or [()] * 8
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
                [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]))]
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, types)], names)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(scan, SCHEMA)


def op2_license_scans(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")
