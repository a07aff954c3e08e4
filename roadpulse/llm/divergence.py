"""Quality rules: how far a document's characters and common words are from its language's.

For each language two histograms are summed over all its documents: eight classes of characters,
and the language's commonest function words with one place for all other words. A document's own
histograms are compared with these references by the Jensen-Shannon distance (base 2, 0 to 1). It is
rejected if either distance is above its limit, which is wider for short texts. Documents of fewer than `MIN_WORDS` words, and
languages of fewer than `MIN_REFERENCE_WORDS`, aren't judged by distance: such histograms say little.

Before that a base rule rejects documents of fewer than ten words, and those in which more than a
fifth of the words stand in five-word windows that occur twice or more.

Rows: a null text has no words. A language that isn't in `COMMON_WORDS`, a null one included, belongs
to one shared reference, whose common words are those of no language. Repeated rows are judged alike
and each counts in the reference. Other input columns, whatever their names, are left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from roadpulse.llm.text import map_rows, small_batches, text_of

# Common function words of each language.
COMMON_WORDS = {
    "en": "the of and to a in is it that was for on are with as be this have from or by not but what".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er".split(),
    "fr": "de la le et les des en un une du que est pour qui dans par plus pas sur au avec il ce elle".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus".split(),
}
OTHER = ""
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
MARKS = b".,;:!?'\"()-#*$%&|<>"
WINDOW = 5
MIN_WORDS, MIN_REFERENCE_WORDS = 50, 1000
#: A histogram of n words is off by about 1/sqrt(n) by chance alone, so limits are wider for short texts:
#: a distance must exceed limit + noise / sqrt(n).
CHAR_LIMIT, CHAR_NOISE = 0.22, 0.8
WORD_LIMIT, WORD_NOISE = 0.22, 1.4
#: Character classes: vowels, consonants, capitals, letters beyond ASCII, digits, white space, marks of prose, the rest.
CLASSES = 8
VERDICT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, char_distance double, word_distance double, kept boolean")
_PLACES = max(map(len, COMMON_WORDS.values())) + 1


def _class_table() -> np.ndarray:
    table = np.full(0x250, 7, dtype=np.int64)
    for characters, kind in (("aeiouy", 0), ("bcdfghjklmnpqrstvwxz", 1), (map(chr, range(65, 91)), 2),
                             ((chr(c) for c in range(0xC0, 0x250) if chr(c).isalpha()), 3), ("0123456789", 4),
                             (" \t\n\r\v\f", 5), (".,;:!?'\"()-", 6)):
        for c in characters:
            table[ord(c)] = kind
    return table


_TABLE = _class_table()
_PLACE = {lang: {w.encode(): i for i, w in enumerate(words)} for lang, words in COMMON_WORDS.items()}


def char_histogram(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    kinds = _TABLE[np.minimum(points, len(_TABLE) - 1)]
    beyond = points >= len(_TABLE)
    if beyond.any():  # of other scripts letters count as letters
        kinds[beyond] = [3 if chr(p).isalpha() else 7 for p in points[beyond]]
    return np.bincount(kinds, minlength=CLASSES)


def language_of(lang: object) -> str:
    return lang if lang in COMMON_WORDS else OTHER


def word_histogram(words: list[bytes], lang: str) -> np.ndarray:
    """Counts of the language's common words, in lower case and without marks around; last all others."""
    out, places = np.zeros(_PLACES, dtype=np.int64), _PLACE.get(lang, {})
    for word, n in Counter(words).items():
        out[places.get(word.strip(MARKS).lower(), _PLACES - 1)] += n
    return out


def distance(a: np.ndarray, b: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms; 0 if either is empty."""
    if not a.sum() or not b.sum():
        return 0.0
    p, q = a / a.sum(), b / b.sum()
    m = (p + q) / 2

    def divergence(x: np.ndarray) -> float:
        at = x > 0
        return float((x[at] * np.log2(x[at] / m[at])).sum())

    return float(np.sqrt(max(0.0, (divergence(p) + divergence(q)) / 2)))


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a five-word window found at least twice in the text."""
    if len(words) <= WINDOW:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    # Windows get numbers by joining the numbers of their halves, so equal numbers mean equal words.
    ranked = lambda a, b: np.unique(a * (b.max() + 1) + b, return_inverse=True)[1]
    pairs = ranked(ids[:-1], ids[1:])
    fours = ranked(pairs[:-2], pairs[2:])
    windows = ranked(fours[:-1], ids[WINDOW - 1:])
    again = np.bincount(windows)[windows] > 1
    change = np.zeros(len(words) + 1, dtype=np.int64)
    starts = np.flatnonzero(again)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    return int((np.cumsum(change) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = Counter(line for line in text.split("\n") if line.strip(WHITE))
    return sum(lines.values()) - len(lines)


def references(docs: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each known language and for `OTHER` the histograms over all its documents.

    The driver gets at most one row for each language in `COMMON_WORDS` and each place.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                text, lang = text_of(text), language_of(lang)
                found = np.concatenate([char_histogram(text), word_histogram(text.encode().split(), lang)])
                sums[lang] = sums[lang] + found if lang in sums else found
        for lang, counts in sums.items():
            yield pd.DataFrame({"lang": lang, "place": range(len(counts)), "n": counts})

    rows = small_batches(docs).select("text", "lang").mapInPandas(run, "lang string, place int, n long")
    out = {lang: np.zeros(CLASSES + _PLACES, dtype=np.int64) for lang in [*COMMON_WORDS, OTHER]}
    for row in rows.groupBy("lang", "place").agg(F.sum("n").alias("n")).collect():
        out[row["lang"]][row["place"]] = row["n"]
    return {lang: (counts[:CLASSES], counts[CLASSES:]) for lang, counts in out.items()}


def judge_text(text: str, lang: str, known: dict) -> tuple:
    """The columns of `VERDICT` for one text."""
    words = text.encode().split()  # of bytes only ASCII white space divides
    n, again = len(words), repeated_words(words)
    failed = n < 10 or 100 * again > 20 * n
    by_char = by_word = 0.0
    far = False
    if n >= MIN_WORDS and known[lang][1].sum() >= MIN_REFERENCE_WORDS:
        by_char = distance(char_histogram(text), known[lang][0])
        by_word = distance(word_histogram(words, lang), known[lang][1])
        far = by_char > CHAR_LIMIT + CHAR_NOISE / sqrt(n) or by_word > WORD_LIMIT + WORD_NOISE / sqrt(n)
    return (n, len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), repeated_lines(text), again,
            failed, by_char, by_word, not failed and not far)


def judge(docs: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of `docs` and the columns of `VERDICT`."""
    known = references(docs)
    return map_rows(docs, columns, ["text", "lang"], VERDICT,
                    lambda text, lang: judge_text(text_of(text), language_of(lang), known))


def keep(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, as they came."""
    known = references(docs)

    @F.pandas_udf("boolean")
    def good(text: pd.Series, lang: pd.Series) -> pd.Series:
        return pd.Series([judge_text(text_of(t), language_of(x), known)[-1] for t, x in zip(text, lang)], dtype=bool)

    return docs.filter(good("text", "lang"))
