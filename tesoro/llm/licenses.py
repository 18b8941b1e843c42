"""License scan: exact containment join of text blocks with license templates.

A document is cut into overlapping blocks of ``2 * step`` words, one every
``step`` words, so any span of up to ``step`` words lies whole in a block.  A
block matches a template when it holds at least ``threshold`` of the
template's distinct words.  The join is exact set similarity with filters:

* the templates' words are ordered by how many documents of the whole corpus
  hold them, rarest first;
* prefix: with ``need`` common words required, a match holds at least one of
  the ``size - need + 1`` rarest template words, so only blocks around those
  words are built;
* length: a block with fewer than ``need`` template words is dropped;
* positional: the words left after the first common one in either ordered
  list must still reach ``need``; survivors are verified on full sets.

With ``marks``, a notice that holds one of its label's marks (word runs that
tell it from its siblings: "lesser general public", "by sa") is met only by a
block in which a mark of that label stands, word after word.

The templates are part of the library (a fixed list), so they travel with the
tasks.  Phrase places (the base labels) come from the same word list.

Defined results: null texts are empty documents; every row is reported, also
repeated ones and null ids; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesoro.llm.common import ascii_words, map_rows, text_of

THRESHOLD = 0.8
STEP = 40

# Phrases whose places count as base labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Notices of well-known licenses (opening sentence or usual grant).
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License version 3"),
    ("gpl", "This program is free software you can redistribute it and or modify it under the terms of the GNU General Public License"),
    ("lgpl", "Licensed under the GNU Lesser General Public License"),
    ("agpl", "Licensed under the GNU Affero General Public License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY SA 4.0"),
    ("cc-by-nd", "Licensed under CC BY ND 4.0"),
    ("cc0", "To the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("bsd", "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("isc", "Permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("proprietary", "All rights reserved No part of this publication may be reproduced without prior written permission"),
]

# Word runs that tell a license from those with almost the same notice.
MARKS = {
    "mit": ["mit license"],
    "apache": ["apache license"],
    "gpl": ["gnu general public license"],
    "lgpl": ["lesser general public license"],
    "agpl": ["affero general public license"],
    "cc-by": ["cc by"],
    "cc-by-nc": ["by nc"],
    "cc-by-sa": ["by sa", "by nc sa"],
    "cc-by-nd": ["by nd", "by nc nd"],
}


def _word_sets(templates) -> list[tuple[str, set[bytes]]]:
    return [(label, set(ascii_words(text))) for label, text in templates]


def template_frequencies(docs: DataFrame, templates=TEMPLATES) -> dict[bytes, int]:
    """Documents of the whole corpus that hold each template word.  At most
    one row a word reaches the driver."""
    universe = set().union(*(s for _, s in _word_sets(templates)), set())

    def count(batches):
        from collections import Counter

        import pyarrow as pa
        n: Counter = Counter()
        for b in batches:
            for text in b.column(1):
                n.update(universe.intersection(ascii_words(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], names=["word", "n"])

    rows = text_of(docs).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {w: 0 for w in universe} | {bytes(r["word"]): r["n"] for r in rows}


def _holds(words: Sequence[bytes], run: list[bytes]) -> bool:
    return any(words[i:i + len(run)] == run for i, w in enumerate(words) if w == run[0])


class TemplateIndex:
    """Prefix index over templates in the corpus's frequency order."""

    def __init__(self, frequencies: dict[bytes, int], templates=TEMPLATES, threshold: float = THRESHOLD, marks=None):
        self.rank = {w: i for i, (_, w) in enumerate(sorted((n, w) for w, n in frequencies.items()))}
        self.templates = []
        self.prefix: dict[bytes, list[int]] = {}
        for (label, words), (_, notice) in zip(_word_sets(templates), templates):
            own = [ascii_words(m) for m in (marks or {}).get(label, ())]
            own = own if any(_holds(ascii_words(notice), m) for m in own) else []
            ordered = sorted(words, key=self.rank.__getitem__)
            need = max(1, -(-round(threshold * 1000) * len(ordered) // 1000))
            for w in ordered[:len(ordered) - need + 1]:
                self.prefix.setdefault(w, []).append(len(self.templates))
            self.templates.append((label, ordered, need, own))

    def matches(self, block: Sequence[bytes]) -> list[tuple[str, float]]:
        """(label, containment) of every template that the block meets."""
        held = sorted((w for w in set(block) if w in self.rank), key=self.rank.__getitem__)
        place = {w: j for j, w in enumerate(held)}
        out = []
        for t in sorted({t for w in held for t in self.prefix.get(w, ())}):
            label, words, need, own = self.templates[t]
            if len(held) < need:
                continue
            i = next(i for i, w in enumerate(words) if w in place)
            if 1 + min(len(words) - i - 1, len(held) - place[words[i]] - 1) < need:
                continue
            common = sum(w in place for w in words)
            if common >= need and (not own or any(_holds(block, m) for m in own)):
                out.append((label, common / len(words)))
        return out


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD, step: int = STEP,
                 marks: dict[str, list[str]] | None = None) -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels,
    labels, score (the largest containment met; 1 where a base phrase stands;
    else 0) and blocks (label, first word, containment) of matching blocks."""
    index = TemplateIndex(template_frequencies(docs, templates), templates, threshold, marks)
    wanted: dict[bytes, list[tuple[list[bytes], str]]] = {}
    for text, label in phrases:
        words = ascii_words(text)
        wanted.setdefault(words[0], []).append((words, label))
    triggers = frozenset(wanted) | frozenset(index.prefix)
    kind = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
            "score double, blocks array<struct<label:string,first_word:bigint,containment:double>>")

    def scan(batches):
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = ascii_words(text.as_py())
                places: list[int] = []
                base: set[str] = set()
                blocks: list[dict] = []
                if not triggers.isdisjoint(words):
                    starts: set[int] = set()
                    for i, w in enumerate(words):
                        if w in triggers:
                            for phrase, label in wanted.get(w, ()):
                                if words[i:i + len(phrase)] == phrase:
                                    places.append(i)
                                    base.add(label)
                            if w in index.prefix:
                                starts.update(x for x in (i // step * step, i // step * step - step) if x >= 0)
                    for at in sorted(starts):
                        blocks += [{"label": label, "first_word": at, "containment": c}
                                   for label, c in index.matches(words[at:at + 2 * step])]
                labels = base | {x["label"] for x in blocks}
                score = 1.0 if places else max((x["containment"] for x in blocks), default=0.0)
                rows.append((doc, len(words), len(places), places[0] if places else None, places[-1] if places else None,
                             ",".join(sorted(base)), ",".join(sorted(labels)), score, blocks))
            yield rows

    return map_rows(text_of(docs), scan, kind)
