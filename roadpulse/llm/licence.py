"""License scan over a positional index of the rare words of licence templates.

The index lists, for each word that few templates have (its inverse document frequency over the
templates is high), the templates and positions where it stands. A file's such words are looked up;
postings of one template at one relative position (place in the file less place in the template)
count together, and so do positions that differ by a few inserted or missing words. A template is reported
where enough of its rare words agree on a position and all its mandatory phrases stand in the stretch of the
file that the agreeing positions cover, with the same slack. The place reported is the position of most words;
its score is the share of the template's words found at one of the agreeing positions.

Base labels beside that: wherever one of `PHRASES` stands, word by word.

Rows: a null or empty text has no words, no labels and a score of 0. Repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable
from math import log

from pyspark.sql import DataFrame

from roadpulse.llm.divergence import COMMON_WORDS
from roadpulse.llm.text import map_rows, text_of

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Notices of public licences, each with phrases that must be there.
TEMPLATES = {
    "agpl": ("under the terms of the gnu affero general public license as published by the free software foundation",
             ["affero general public license"]),
    "apache-2.0": ("licensed under the apache license version 2.0", ["apache license version 2 0"]),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", ["redistribution and use in source and binary forms"]),
    "cc-by": ("licensed under a creative commons attribution 4.0 international license",
              ["creative commons attribution"]),
    "cc-by-nc": ("licensed under cc by nc 4.0", ["cc by nc"]),
    "gpl": ("this work is licensed under the gnu general public license version 3", ["gnu general public license"]),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", ["permission to use copy modify", "with or without fee"]),
    "lgpl": ("under the terms of the gnu lesser general public license as published by the free software foundation",
             ["lesser general public license"]),
    "mit": ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction",
            ["permission is hereby granted free of charge"]),
    "mit-notice": ("released under the mit license", ["the mit license"]),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2.0",
                ["mozilla public license"]),
    "unlicense": ("this is free and unencumbered software released into the public domain",
                  ["unencumbered software released into the public domain"]),
}
#: Labels that two templates share.
NAMES = {"mit-notice": "mit", "apache-2.0": "apache"}
RARE_IN = 3          # a word is rare if at most so many templates have it, and it is no function word
RARE_SHARE = 0.5     # of a template's rare words so many must agree on a relative position
SLACK_PART = 4       # a place gives way by two words and a quarter of the template's
RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, matches string")
# Bytes that belong to no word become spaces; capitals become small.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def _phrase(words: str) -> re.Pattern[bytes]:
    """Finds starts; overlapping places count too. Words in the searched bytes are divided by one space."""
    return re.compile(rb"(?=(?<= )" + re.escape(b" ".join(words_of(words))) + rb" )")


class Index:
    """Postings of the templates' rare words, and what verification needs."""

    def __init__(self, templates: dict[str, tuple[str, list[str]]]) -> None:
        self.words = {name: words_of(text) for name, (text, _) in templates.items()}
        self.mandatory = {name: [b" ".join(words_of(p)) for p in phrases] for name, (_, phrases) in templates.items()}
        having = Counter(w for words in self.words.values() for w in set(words))
        self.idf = {w: log(len(templates) / n) for w, n in having.items()}
        least = log(len(templates) / RARE_IN)
        self.postings: dict[bytes, list[tuple[str, int]]] = defaultdict(list)
        common = {w.encode() for w in COMMON_WORDS["en"]}
        for name, words in self.words.items():
            for position, word in enumerate(words):
                if self.idf[word] >= least and word not in common:
                    self.postings[word].append((name, position))
        self.rare = Counter(name for found in self.postings.values() for name, _ in found)
        short = [name for name in templates if not self.rare[name]]
        if short:
            raise ValueError(f"templates without a rare word: {short}")

    def find(self, words: list[bytes], wanted: Iterable[bytes]) -> list[tuple[str, int, float]]:
        """Template, first word and score of each verified place; `wanted`: rare words of the file."""
        wanted = set(wanted)
        aligned: dict[str, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for place, word in enumerate(words):
            if word in wanted:
                for name, position in self.postings[word]:
                    aligned[name][place - position].append(position)
        out = []
        for name, found in aligned.items():
            template, needed = self.words[name], RARE_SHARE * self.rare[name]
            slack = 2 + len(template) // SLACK_PART
            used: set[int] = set()
            for start in sorted(found, key=lambda o: (-len(found[o]), o)):     # places of most words first
                if start in used:
                    continue
                band = [o for o in range(start - slack, start + slack + 1) if o in found and o not in used]
                agreeing = [(o, position) for o in band for position in found[o]]
                if min(len({o + p for o, p in agreeing}), len({p for _, p in agreeing})) < needed:
                    continue
                first, last = max(0, band[0] - slack), max(0, band[-1] + len(template) + slack)
                joined = b" " + b" ".join(words[first:last]) + b" "
                if all(b" " + p + b" " in joined for p in self.mandatory[name]):
                    used.update(band)
                    there = sum(any(0 <= o + i < len(words) and words[o + i] == w for o in band)
                                for i, w in enumerate(template))
                    out.append((name, max(0, start), there / len(template)))
        return sorted(out, key=lambda x: (x[1], x[0]))


def scan_text(text: str, index: Index, phrases: dict[re.Pattern[bytes], tuple[bytes, str]]) -> tuple:
    """The columns of `RESULT` for one text."""
    words = words_of(text)
    present = set(words)
    starts: list[int] = []
    base: set[str] = set()
    found = [(p, label) for p, (last, label) in phrases.items() if last in present]
    rare = present & index.postings.keys()
    if found:
        joined = b" " + b" ".join(words) + b" "
        for pattern, label in found:
            at = [m.start() for m in pattern.finditer(joined)]
            if at:
                base.add(label)
                # Words before a place are the spaces before it, less the one in front of the first word.
                before, last = -1, 0
                for a in at:
                    before += joined.count(b" ", last, a)
                    last = a
                    starts.append(before)
    matches = index.find(words, rare) if rare else []
    labels = sorted(base | {NAMES.get(name, name) for name, _, _ in matches})
    score = max([1.0] * bool(base) + [s for _, _, s in matches], default=0.0)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(labels), score, ",".join(f"{name}:{start}:{s:.3f}" for name, start, s in matches))


def scan(docs: DataFrame, columns: list[str], templates: dict[str, tuple[str, list[str]]] | None = None) -> DataFrame:
    """`columns` of `docs` and the columns of `RESULT`; `matches` lists template:first word:score."""
    index = Index(templates or TEMPLATES)
    phrases = {_phrase(p): (words_of(p)[-1], label) for p, label in PHRASES.items()}
    return map_rows(docs, columns, ["text"], RESULT, lambda text: scan_text(text_of(text), index, phrases))
