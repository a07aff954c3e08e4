"""SentencePiece encoding with N best segmentations, and decoding.

The vocabulary is read from a public SentencePiece model. Its pieces come in order of rank, so a piece's
score is its log probability under Zipf's law, in whole millionths. A lattice has an edge for every piece
at every place of the text; a character that is no piece gets an edge of byte pieces. Going forward,
Viterbi scores give each place its best score from the start. Going backward from the end, A* search
takes these as its estimate of what is still to come. The estimate is exact, so paths leave the queue in
the order of their scores, and the first N that reach the start are the N best.

Characters that stand side by side in no piece can't be joined, so a text divides there into parts that
are independent. The best path of each part and the cost of its cheapest alternative are remembered, as
words repeat. The N best of a whole text follow exactly: they use no alternatives but those of the N - 1
parts whose cheapest alternatives cost least, and only these parts are searched by A*. Between equal
scores the choice is arbitrary but always the same.

Decoding gives the text back, character by character, also where it has the marker that stands for a
space (which is encoded as bytes). Rows: a null or empty text has no pieces and one segmentation. Repeated
rows are equal.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from hashlib import sha256
from itertools import chain, count
from math import log

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame

from roadpulse.llm.text import map_rows, map_slices, text_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
BEST = 4
#: Parts that a worker remembers, twice; then the older half goes, which changes nothing but time. Rows of ids need
#: memory too, so it remembers less where it gives them.
REMEMBERED, REMEMBERED_FOR_DIGESTS = 50_000, 100_000
#: Characters of the texts whose parts are told apart together, likewise.
SLICE, SLICE_FOR_DIGESTS = 1 << 21, 1 << 22
#: New parts whose lattices are solved side by side.
TOGETHER = 1 << 12
#: Longer parts aren't remembered: they hardly repeat.
LONG = 40
ENCODED = "n_pieces long, ids array<int>"
_NBEST = "nbest_scores string, nbest_pieces string, round_trip boolean, nbest_sha256 string"
SEGMENTED = "n_pieces long, score long, ids_sha256 string, " + _NBEST
TOKENS = "n_pieces long, ids array<int>, score long, " + _NBEST
Path = tuple[int, tuple[int, ...]]
_NONE = -(1 << 60)


def _divisions(pieces: list[str]) -> re.Pattern[str]:
    """Finds the parts: spaces with a run of characters that pieces may join, or one other character."""
    leader: dict[str, str] = {}

    def lead(c: str) -> str:
        while leader.setdefault(c, c) != c:
            c = leader[c]
        return c

    for piece in pieces:
        word = piece.lstrip(SPACE)
        for a, b in zip(word, word[1:]):
            leader[lead(a)] = lead(b)
    groups: dict[str, str] = {}
    for c in sorted({c for p in pieces for c in p} - {SPACE, " "}):
        groups[lead(c)] = groups.get(lead(c), "") + c
    joined = [g for g in groups.values() if len(g) > 1]
    single = "".join(g for g in groups.values() if len(g) == 1)
    runs = sorted(joined, key=len, reverse=True) + ([single] if single else [])
    return re.compile("|".join([f"\x20*[{re.escape(g)}]+" for g in runs] + ["\x20+", r"[\s\S]"]))


class Trie:
    """The pieces and their beginnings as numbered nodes, to be walked from many places at once."""

    _EMPTY = np.uint64((1 << 64) - 1)

    def __init__(self, walk: dict[str, tuple]) -> None:
        node = {"": 0} | {text: i for i, text in enumerate(walk, 1)}
        self.score = np.array([0] + [e[0] if e else 0 for e in walk.values()], dtype=np.int64)
        self.id = np.array([-1] + [e[1][0] if e else -1 for e in walk.values()], dtype=np.int64)
        # An open hash table of (node, character) -> node, at most a quarter full.
        self.bits = (4 * len(node)).bit_length()
        self.keys, self.child = np.full(1 << self.bits, self._EMPTY), np.zeros(1 << self.bits, dtype=np.int64)
        keys = self._key(np.array([node[t[:-1]] for t in walk]), np.array([ord(t[-1]) for t in walk]))
        for key, slot, child in zip(keys, self._slot(keys).tolist(), range(1, len(node))):
            while self.keys[slot] != self._EMPTY:
                slot = (slot + 1) % len(self.keys)
            self.keys[slot], self.child[slot] = key, child

    @staticmethod
    def _key(nodes: np.ndarray, characters: np.ndarray) -> np.ndarray:
        return nodes.astype(np.uint64) << np.uint64(21) | characters.astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, nodes: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """The node that each node leads to by a character; 0 for none."""
        keys = self._key(nodes, characters)
        slots = self._slot(keys)
        out, left = np.zeros(len(keys), dtype=np.int64), np.arange(len(keys))
        while len(left):
            there = self.keys[slots[left]]
            hit = there == keys[left]
            out[left[hit]] = self.child[slots[left[hit]]]
            left = left[~hit & (there != self._EMPTY)]
            slots[left] = (slots[left] + 1) % len(self.keys)
        return out

    def edges(self, characters: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, length, node) of every piece at every place that ends by `ends` (of the place)."""
        place, node, found, length = np.arange(len(characters)), np.zeros(len(characters), dtype=np.int64), [], 0
        while len(place):
            node = self.step(node, characters[place + length])
            length += 1
            place, node = place[node > 0], node[node > 0]
            piece = self.id[node] >= 0
            found.append((place[piece], np.full(int(piece.sum()), length), node[piece]))
            more = place + length < ends[place]
            place, node = place[more], node[more]
        return tuple(np.concatenate(column) for column in zip(*found))


class Vocabulary:
    """Pieces, scores and the searches over them; one for each model and worker."""

    def __init__(self, model: str, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered
        loaded = sentencepiece.SentencePieceProcessor(model_file=model)
        size = loaded.vocab_size()
        plain = [i for i in range(size) if not (
            loaded.is_byte(i) or loaded.is_control(i) or loaded.is_unknown(i) or loaded.is_unused(i))]
        total = log(sum(1 / rank for rank in range(1, len(plain) + 1)))
        pieces = {loaded.id_to_piece(i): i for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece goes on after a space, so texts can't be divided there")
        # Score and ids of each piece; nothing for what only begins pieces, so that walks know where to end.
        self.walk: dict[str, tuple] = {p[:n]: () for p in pieces for n in range(1, len(p))}
        self.walk |= {p: (round(-1e6 * (log(rank) + total)), (i,)) for rank, (p, i) in enumerate(pieces.items(), 1)}
        self.trie = Trie(self.walk)
        self.byte_score = round(-1e6 * (log(len(plain)) + total))
        self.byte_id = {int(loaded.id_to_piece(i)[1:-1], 16): i for i in range(size) if loaded.is_byte(i)}
        if len(self.byte_id) != 256:
            raise ValueError("the model needs a piece for every byte")
        self.longest = max(map(len, pieces))
        self.parts = _divisions(list(pieces)).findall
        # Bytes beyond ASCII decode as escapes, which whole characters then replace.
        self.shown = np.full(size, "", dtype=object)
        for piece, i in pieces.items():
            self.shown[i] = piece.replace(SPACE, " ")
        for b, i in self.byte_id.items():
            self.shown[i] = chr(b if b < 128 else 0xDC00 + b)
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}
        self.distinct: tuple[dict[str, tuple], dict[str, tuple]] = {}, {}
        self.paths: dict[tuple[str, int], list[Path]] = {}

    def _bytes(self, character: str) -> Path:
        ids = tuple(self.byte_id[b] for b in character.encode())
        return self.byte_score * len(ids), ids

    def _lattice(self, part: str) -> tuple[list[int], list[tuple], list[tuple[int, int, int, tuple[int, ...]]]]:
        """Viterbi scores of all places, the last edge of the best path to each, and all edges by their start."""
        n, get, longest = len(part), self.walk.get, self.longest
        best, last, edges = [_NONE] * (n + 1), [()] * (n + 1), []
        best[0] = 0
        for start in range(n):
            base = best[start]
            for end in range(start + 1, min(n, start + longest) + 1):
                found = get(part[start:end])
                if found is None:
                    if end > start + 1:
                        break
                    found = self._bytes(part[start])
                elif not found:      # only the beginning of pieces
                    if end > start + 1:
                        continue
                    found = self._bytes(part[start])
                score, ids = found
                edges.append((start, end, score, ids))
                if base + score > best[end]:
                    best[end], last[end] = base + score, (start, ids)
        return best, last, edges

    def best(self, part: str) -> tuple[int, tuple[int, ...], float]:
        """Score and ids of the best path, and what its cheapest alternative costs (infinity: has none)."""
        if part == SPACE:   # the marker itself, which must not decode to a space
            return *self._bytes(part), float("inf")
        part = part.replace(" ", SPACE)
        if len(part) == 1:
            return *(self.walk.get(part) or self._bytes(part)), float("inf")
        best, last, edges = self._lattice(part)
        ids, place, after = [], len(part), {}
        while place:
            start, own = last[place]
            after[start] = place
            ids.append(own)
            place = start
        behind, other = [_NONE] * len(part) + [0], _NONE
        for start, end, score, _ in reversed(edges):
            onward = score + behind[end]
            if onward > behind[start]:
                behind[start] = onward
            if best[start] + onward > other and after.get(start) != end:
                other = best[start] + onward
        return best[-1], tuple(chain.from_iterable(reversed(ids))), float(best[-1] - other) if other > _NONE // 2 else float("inf")

    def best_of_all(self, parts: list[str]) -> list[tuple[int, tuple[int, ...], float]]:
        """`best` of many parts of two characters or more, all lattices side by side.

        Places of all parts stand in one row, each part with one more than it has characters. Edges are taken
        in rounds by where in their part they start: forward for the scores to each place, backward for
        those from it on.
        """
        sizes = np.array([len(p) for p in parts])
        characters = np.frombuffer(bytearray("".join(parts).replace(" ", SPACE).encode("utf-32-le")), dtype=np.uint32)
        part = np.repeat(np.arange(len(parts)), sizes)
        first = np.cumsum(sizes) - sizes
        start, length, node = self.trie.edges(characters, (first + sizes)[part])
        score, piece = self.trie.score[node], self.trie.id[node]
        # A character that is no piece is its bytes; these edges have its code below -1 for a piece.
        bare = np.ones(len(characters), dtype=bool)
        bare[start[length == 1]] = False
        plain = np.flatnonzero(bare)
        code = characters[plain].astype(np.int64)
        width = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        start, length = np.concatenate([start, plain]), np.concatenate([length, np.ones_like(plain)])
        score, piece = np.concatenate([score, self.byte_score * width]), np.concatenate([piece, -2 - code])
        own = part[start]
        order = np.lexsort((length, start, start - first[own]))
        start, length, score, piece, own = (a[order] for a in (start, length, score, piece, own))
        rounds = np.searchsorted(start - first[own], np.arange(sizes.max() + 1))
        begin, end = start + own, start + own + length
        here, last = np.full(len(characters) + len(parts), _NONE), np.zeros(len(characters) + len(parts), dtype=np.int64)
        here[first + np.arange(len(parts))] = 0
        for a, b in zip(rounds, rounds[1:]):        # in a round each place is the end of one edge at most
            reached = here[begin[a:b]] + score[a:b]
            better = np.flatnonzero(reached > here[end[a:b]])
            here[end[a:b][better]], last[end[a:b][better]] = reached[better], better + a
        behind = np.full(len(here), _NONE)
        final = first + np.arange(len(parts)) + sizes
        behind[final] = 0
        for a, b in reversed(list(zip(rounds, rounds[1:]))):
            np.maximum.at(behind, begin[a:b], score[a:b] + behind[end[a:b]])
        on_path, at, origin = np.zeros(len(start), dtype=bool), final, first + np.arange(len(parts))
        while len(at):
            on_path[last[at]] = True
            at = begin[last[at]]
            at, origin = at[at > origin], origin[at > origin]
        total = here[final]
        other = np.full(len(parts), _NONE)
        rest = ~on_path
        np.maximum.at(other, own[rest], here[begin[rest]] + score[rest] + behind[end[rest]])
        cost = np.where(other > _NONE // 2, (total - other).astype(np.float64), np.inf)
        chosen = np.flatnonzero(on_path)
        chosen = chosen[np.argsort(start[chosen], kind="stable")]
        counts = np.bincount(own[chosen], minlength=len(parts))
        ids, ends = piece[chosen].tolist(), np.cumsum(counts).tolist()
        out = []
        for a, b, value, lost in zip([0, *ends], ends, total.tolist(), cost.tolist()):
            path = ids[a:b]
            if min(path) < 0:
                path = chain.from_iterable(self._bytes(chr(-2 - i))[1] if i < 0 else (i,) for i in path)
            out.append((value, tuple(path), lost))
        return out

    def search(self, part: str, n: int) -> list[Path]:
        """The n best paths of a part, best first, by A* from its end."""
        if part == SPACE:
            return [self._bytes(part)]
        part = part.replace(" ", SPACE)
        best, _, edges = self._lattice(part)
        into: list[list[tuple]] = [[] for _ in best]
        for start, end, score, ids in edges:
            into[end].append((start, score, ids))
        found: list[Path] = []
        order = count()
        # Cost of the whole path, place (of equal paths the longest goes on), score so far, ids so far.
        queue = [(-best[-1], len(part), next(order), 0, ())]
        while queue and len(found) < n:
            _, place, _, behind, path = heapq.heappop(queue)
            if not place:
                ids = []
                while path:
                    own, path = path
                    ids.extend(own)
                found.append((behind, tuple(ids)))
                continue
            for start, score, own in into[place]:
                heapq.heappush(queue, (-(best[start] + score + behind), start, next(order), score + behind, (own, path)))
        return found

    def _known(self, part: str) -> tuple[int, tuple[int, ...], float]:
        entry = self.old.get(part) or self.best(part)
        if len(part) <= LONG:
            if len(self.young) >= self.remembered:
                self.old, self.young = self.young, {}
            self.young[part] = entry
        return entry

    def _known_all(self, parts: list[str]) -> list[tuple[int, tuple[int, ...], float]]:
        """The entries of distinct parts; new ones are solved together."""
        young, old = self.distinct
        entries = list(map(young.get, parts))
        new = []
        for i in [i for i, e in enumerate(entries) if e is None]:
            part = parts[i]
            entries[i] = young[part] = old.get(part)
            if entries[i] is None:
                del young[part]
                if 1 < len(part) <= LONG and part != SPACE:
                    new.append(i)
                else:
                    entries[i] = self.best(part)
        for at in range(0, len(new), TOGETHER):
            some = new[at:at + TOGETHER]
            for i, entry in zip(some, self.best_of_all([parts[i] for i in some])):
                entries[i] = young[parts[i]] = entry
        if len(young) >= self.remembered:
            self.distinct = {}, young
        return entries

    def _searched(self, part: str, n: int) -> list[Path]:
        if len(part) > LONG:
            return self.search(part, n)
        if len(self.paths) >= self.remembered // 20:
            self.paths.clear()
        if (part, n) not in self.paths:
            self.paths[part, n] = self.search(part, n)
        return self.paths[part, n]

    def _solve(self, text: str) -> tuple[list[str], list[tuple]]:
        parts = self.parts(" " + text) if text else []
        get, known = self.young.get, self._known
        return parts, [get(p) or known(p) for p in parts]

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable([e[1] for e in self._solve(text)[1]]))

    def shown_as(self, ids: Sequence[int] | np.ndarray) -> str:
        text = "".join(self.shown[np.asarray(ids, dtype=np.int64)].tolist())
        return text if text.isascii() else text.encode("utf-8", "surrogateescape").decode("utf-8")

    def decode(self, ids: Sequence[int] | np.ndarray) -> str:
        return self.shown_as(ids)[1:]

    def _ways(self, parts: list[str], entries: list[tuple], n: int) -> list[tuple[int, dict[int, tuple]]]:
        """Of parts and their entries (all of a text's, or those with its cheapest alternatives), in order: for each
        of the n best segmentations what it loses, and the ids it has instead by part."""
        # Single changes, cheapest first; at most n - 1 of them can be in use.
        changes = sorted((entry[0] - score, i, ids) for i, entry in enumerate(entries) if entry[2] < float("inf")
                         for score, ids in self._searched(parts[i], n)[1:])[:n - 1]
        ways = [(0, {})]
        for lost, i, ids in changes:
            ways += [(old + lost, {**way, i: ids}) for old, way in ways if i not in way]
        return sorted(ways, key=lambda w: (w[0], sorted(w[1])))[:n]

    def segment(self, text: str, n: int = BEST) -> list[Path]:
        """The n best segmentations of a text, best first; fewer if there are no more."""
        parts, solved = self._solve(text)
        total, some = sum(e[0] for e in solved), _cheapest(np.array([e[2] for e in solved]), n)
        ways = self._ways([parts[i] for i in some], [solved[i] for i in some], n)
        place = {i: at for at, i in enumerate(some)}
        return [(total - lost, tuple(chain.from_iterable(way.get(place.get(i), e[1]) for i, e in enumerate(solved))))
                for lost, way in ways]

    def segment_all(self, texts: list[str], n: int = BEST) -> Iterator[tuple[list[np.ndarray], list[int], bool]]:
        """For each text the ids and the scores of its n best segmentations, best first, and whether every one of
        them, decoded as a whole, is the text.

        Words repeat: each distinct part of the texts is solved once, and the best segmentations are gathers by its
        number. The others have the ids of some parts replaced.
        """
        found = [self.parts(" " + t) if t else [] for t in texts]
        flat = np.empty(sum(map(len, found)), dtype=object)
        flat[:] = list(chain.from_iterable(found))
        codes, distinct = pd.factorize(flat)
        entries = self._known_all(distinct.tolist())
        score = np.array([e[0] for e in entries], dtype=np.int64)
        cost = np.array([e[2] for e in entries], dtype=np.float64)
        sizes = np.array([len(e[1]) for e in entries], dtype=np.int64)
        ids = np.fromiter(chain.from_iterable([e[1] for e in entries]), dtype=np.int32, count=int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        at = 0
        for text, parts in zip(texts, found):
            own = codes[at:at + len(parts)]
            at += len(parts)
            lengths = sizes[own]
            ends = np.cumsum(lengths)
            best = ids[np.arange(int(lengths.sum())) + np.repeat(starts[own] - (ends - lengths), lengths)]
            some = _cheapest(cost[own], n)
            ways = self._ways([parts[i] for i in some], [entries[own[i]] for i in some], n)
            total, paths, scores = int(score[own].sum()), [], []
            for lost, way in ways:
                path, done = [], 0
                for i, new in sorted(way.items()):
                    end = int(ends[some[i]])
                    path += [best[done:end - int(lengths[some[i]])], np.array(new, dtype=np.int32)]
                    done = end
                paths.append(np.concatenate([*path, best[done:]]) if path else best)
                scores.append(total - lost)
            yield paths, scores, all(self.decode(path) == text for path in paths)


def _cheapest(cost: np.ndarray, n: int) -> list[int]:
    """The n - 1 parts whose cheapest alternatives cost least, in the order of the text."""
    if n < 2:
        return []
    some = np.argpartition(cost, n - 2)[:n - 1] if len(cost) >= n else np.arange(len(cost))
    return sorted(some.tolist())


@cache
def vocabulary(model: str, remembered: int = REMEMBERED) -> Vocabulary:
    return Vocabulary(model, remembered)


def _encoded(model: str) -> Callable[[object], tuple]:
    def run(text: object) -> tuple:
        ids = vocabulary(model).encode(text_of(text))
        return len(ids), np.array(ids, dtype=np.int32)
    return run


def encode(docs: DataFrame, columns: list[str], model: str = MODEL) -> DataFrame:
    """`columns` of `docs`, and the number and ids of the best segmentation's pieces."""
    return map_rows(docs, columns, ["text"], ENCODED, _encoded(model))


def _digest(ids: np.ndarray) -> str:
    return sha256(ids.tobytes()).hexdigest()


def _segmented(model: str, n: int, remembered: int, rows: pd.DataFrame) -> Iterator[tuple]:
    """For each text the ids and score of its best segmentation, then what all n best are told by."""
    texts = [text_of(t) for t in rows["text"]]
    for paths, scores, whole in vocabulary(model, remembered).segment_all(texts, n):
        yield (paths[0], scores[0], ",".join(map(str, scores)), ",".join(str(len(p)) for p in paths), whole,
               ",".join(map(_digest, paths)))


def segment(docs: DataFrame, columns: list[str], n: int = BEST, model: str = MODEL) -> DataFrame:
    """`columns` of `docs` and a digest of the n best segmentations.

    These are the best one's number of pieces, score and SHA-256 (of its ids as 32-bit integers), all scores and numbers
    of pieces, whether every one of them decodes to the text, and the SHA-256 of each.
    """
    return map_slices(docs, columns, ["text"], SEGMENTED, lambda rows: [
        (len(ids), score, _digest(ids), *rest)
        for ids, score, *rest in _segmented(model, n, REMEMBERED_FOR_DIGESTS, rows)], SLICE_FOR_DIGESTS)


def tokens(docs: DataFrame, columns: list[str], n: int = BEST, model: str = MODEL) -> DataFrame:
    """What `segment` gives, with the ids of the best segmentation instead of their digest."""
    return map_slices(docs, columns, ["text"], TOKENS, lambda rows: [
        (len(ids), ids, *rest) for ids, *rest in _segmented(model, n, REMEMBERED, rows)], SLICE)
