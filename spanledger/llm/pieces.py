"""SentencePiece encoding and decoding with N-best segmentation.

The best segmentation of a text into pieces has the highest sum of piece scores. Forward Viterbi scores over the lattice of
pieces are exact heuristics for the backward A-star search that yields segmentations in order of score (`Lattice`).

A model of byte-pair merges (its scores are ranks, so whole numbers) was trained on texts cut by its merges, so
`ids` are cut that way, as the model's own library does: of all neighbours that make a piece, those of the best rank are joined first, the
leftmost first. `score` is the sum of their ranks; the N best are those of the lattice, whose sums are as high or higher. With the
scores of other models, which are logarithms of probabilities, `ids` are the best segmentation.

No piece has anything before a word mark, and none has a line feed among others (checked when a model is loaded; else a text is
one unit), so a text is a row of units that are segmented apart from each other. Many units at once go through the lattice as
numpy arrays: forward and backward Viterbi scores, and from both the best segmentation that differs from the best one. The
N best segmentations of a text change the few units that lose least; A-star lists the alternatives of just these.

Characters without a piece become byte pieces. Scores are the model file's; a character without a piece costs the smallest
score less 10. The text is not normalised: a word mark is put first, blanks become word marks, and decoding gives the text back.

Texts of any length are encoded whole, a megabyte of whole texts at a time; one longer text is one row's work. Null and empty texts have no pieces, a score of 0 and one segmentation. Repeated rows are
encoded each. An empty table gives an empty result. Further columns are not read. The vocabulary is sent to the tasks as the
model's bytes (at most MODEL_BYTES); nothing of the documents is gathered, and each task keeps at most CACHE_UNITS units.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from spanledger.llm.common import ARROW_BYTES, in_batches, kept, text_blocks, text_column

MARK = "▁"
MODEL_BYTES = 64 << 20
CACHE_UNITS = 400_000
TEXT_BYTES = 1 << 20
LONG_UNIT = 48
BATCH_UNITS = 16_000
NBEST = 3
_NONE = -np.inf


class Segmentation(NamedTuple):
    score: float
    ids: tuple[int, ...]


class Vocabulary:
    def __init__(self, model: bytes) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        names, scores = [sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        self.bytes = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        if len(self.bytes) < 256:
            raise ValueError("the model has no byte pieces, so not every text can be encoded")
        self.pieces = {names[i]: (i, scores[i]) for i in range(n) if not special[i] and not sp.is_byte(i) and names[i]}
        self.longest = max(map(len, self.pieces))
        self.unknown = min(s for _, s in self.pieces.values()) - 10.0
        self.out = [
            bytes([int(names[i][3:5], 16)]) if sp.is_byte(i) else b"" if special[i] else names[i].replace(MARK, " ").encode()
            for i in range(n)
        ]
        inner = re.compile(f"[^{MARK}]{MARK}|.\n|\n.", re.S)
        apart = not any(inner.search(p) for p in self.pieces)
        self.units = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n+" if apart else "(?s:.+)")
        self.merges = all(s == int(s) for _, s in self.pieces.values())
        if self.merges:
            self.pairs = self._pairs(n)
        keys = sorted((_code(p), i, s) for p, (i, s) in self.pieces.items())
        self.codes = np.array([k for k, _, _ in keys], np.uint64)
        if len(np.unique(self.codes)) < len(keys):
            raise ValueError("two pieces have one hash")
        self.code_ids = np.array([i for _, i, _ in keys], np.int32)
        self.code_scores = np.array([s for _, _, s in keys])
        self.near = np.zeros(1 << 20, bool)
        self.near[_spread(self.codes)] = True

    def _pairs(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Neighbours that make a piece: their sorted keys (left id times n, plus right id), the ids and scores of what they make, which
        hashes they have, and the scores of all ids."""
        found = []
        for piece, (i, s) in self.pieces.items():
            for cut in range(1, len(piece)):
                a, b = self.pieces.get(piece[:cut]), self.pieces.get(piece[cut:])
                if a and b:
                    found.append((a[0] * n + b[0], i, s))
        found.sort()
        keys = np.array([f[0] for f in found], np.int64)
        near, scores = np.zeros(1 << 20, bool), np.zeros(n)
        near[_spread(keys.view(np.uint64))] = True
        for i, s in self.pieces.values():
            scores[i] = s
        return keys, np.array([f[1] for f in found], np.int64), np.array([f[2] for f in found], np.float64), near, scores

    def unknown_ids(self, char: str) -> tuple[int, ...]:
        return tuple(self.bytes[b] for b in char.replace(MARK, " ").encode())


def merged(vocabulary: Vocabulary, unit: str) -> Segmentation:
    """The segmentation of a unit by merges in the order of their ranks, the leftmost first."""
    pieces = vocabulary.pieces
    parts: list[str | None] = list(unit)
    if len(parts) <= LONG_UNIT:
        while len(parts) > 1:
            best, at = _NONE, -1
            for k, (a, b) in enumerate(zip(parts, parts[1:])):
                found = pieces.get(a + b)
                if found and found[1] > best:
                    best, at = found[1], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
    else:
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(a: int) -> None:
            if a >= 0 and after[a] < len(parts):
                joined = parts[a] + parts[after[a]]
                found = pieces.get(joined)
                if found:
                    heapq.heappush(heap, (-found[1], a, joined))

        for a in range(len(parts) - 1):
            offer(a)
        while heap:
            _, a, joined = heapq.heappop(heap)
            b = after[a]
            if parts[a] is None or b >= len(parts) or parts[a] + parts[b] != joined:
                continue
            parts[a], parts[b], after[a] = joined, None, after[b]
            if after[a] < len(parts):
                before[after[a]] = a
            offer(before[a])
            offer(a)
        parts = [p for p in parts if p is not None]
    ids, score = [], 0.0
    for p in parts:
        found = pieces.get(p)
        ids += [found[0]] if found else vocabulary.unknown_ids(p)
        score += found[1] if found else vocabulary.unknown
    return Segmentation(score, tuple(ids))


def merge_batch(vocabulary: Vocabulary, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `merged`, for units of known characters: ids one after another, how many each has, and the scores. One pair of every unit
    is joined at a time, and only the pairs beside it are looked up again."""
    keys, made, ranks, near, scores = vocabulary.pairs
    n = len(scores)
    single = {c: vocabulary.pieces[c][0] for c in set().union(*units)}
    ids = np.array([single[c] for u in units for c in u], np.int64)
    unit = np.repeat(np.arange(len(units)), [len(u) for u in units])
    done_ids, done_units = [], []

    def look(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of what the symbols at these places make with the next ones."""
        value, new = np.full(len(at), _NONE), np.zeros(len(at), np.int64)
        pairs = np.flatnonzero((at + 1 < len(ids)) & (unit[np.minimum(at + 1, len(ids) - 1)] == unit[at]))
        key = ids[at[pairs]] * n + ids[at[pairs] + 1]
        some = near[_spread(key.view(np.uint64))]
        pairs, key = pairs[some], key[some]
        place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        same = keys[place] == key
        value[pairs[same]], new[pairs[same]] = ranks[place[same]], made[place[same]]
        return value, new

    value, new = look(np.arange(len(ids)))
    while len(ids):
        first = np.flatnonzero(np.diff(unit, prepend=-1))
        best = np.maximum.reduceat(value, first)
        sizes = np.diff(np.append(first, len(ids)))
        over = best == _NONE
        if over.any():
            out = np.repeat(over, sizes)
            done_ids.append(ids[out])
            done_units.append(unit[out])
            ids, unit, value, new = ids[~out], unit[~out], value[~out], new[~out]
            best, sizes = best[~over], sizes[~over]
            if not len(ids):
                break
        hit = np.flatnonzero(value == np.repeat(best, sizes))
        at = hit[np.flatnonzero(np.diff(unit[hit], prepend=-1))]  # the leftmost of each unit
        ids[at] = new[at]
        stay = np.ones(len(ids), bool)
        stay[at + 1] = False
        at = (np.cumsum(stay) - 1)[at]
        ids, unit, value, new = ids[stay], unit[stay], value[stay], new[stay]
        changed = np.concatenate((at, np.maximum(at - 1, 0)))
        value[changed], new[changed] = look(changed)
    flat, owner = np.concatenate(done_ids), np.concatenate(done_units)
    by = np.argsort(owner, kind="stable")
    flat, sizes = flat[by], np.bincount(owner, minlength=len(units))
    return flat.astype(np.int32), sizes, np.add.reduceat(scores[flat], np.cumsum(sizes) - sizes)


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _code(piece: str) -> int:
    h = 0
    for c in piece:
        h = (h * int(_STEP) + ord(c) + 1) % (1 << 64)
    return h


def _spread(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(44)


class Lattice:
    """All pieces of one string, with the forward Viterbi scores."""

    def __init__(self, vocabulary: Vocabulary, text: str) -> None:
        self.vocabulary, self.text = vocabulary, text
        n = len(text)
        self.ending: list[list[tuple[int, int, float]]] = [[] for _ in range(n + 1)]  # (start, id or -1, score)
        pieces, longest = vocabulary.pieces, vocabulary.longest
        for a in range(n):
            for b in range(a + 1, min(n, a + longest) + 1):
                found = pieces.get(text[a:b])
                if found:
                    self.ending[b].append((a, *found))
                elif b == a + 1:
                    self.ending[b].append((a, -1, vocabulary.unknown))
        self.best = [0.0] + [_NONE] * n
        for b in range(1, n + 1):
            self.best[b] = max(self.best[a] + s for a, _, s in self.ending[b])

    def segmentations(self) -> Iterator[Segmentation]:
        """All segmentations, best first: A-star from the end, with the forward scores as what the rest can still bring."""
        count = itertools.count()
        heap = [(-self.best[-1], next(count), len(self.text), 0.0, None)]
        while heap:
            _, _, at, score, rest = heapq.heappop(heap)
            if at == 0:
                ids, link = [], rest
                while link:
                    (a, i), link = link
                    ids += self.vocabulary.unknown_ids(self.text[a]) if i < 0 else (i,)
                yield Segmentation(score, tuple(ids))
                continue
            for a, i, s in self.ending[at]:
                heapq.heappush(heap, (-(self.best[a] + (s + score)), next(count), a, s + score, ((a, i), rest)))

    def nbest(self, n: int) -> list[Segmentation]:
        return list(itertools.islice(self.segmentations(), n))


def batch(vocabulary: Vocabulary, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For units of known characters: the best ids one after another, how many each has, their scores, and how much the
    second best loses (inf: there is none)."""
    lengths = np.array([len(u) for u in units])
    chars = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    n, width = len(chars), min(vocabulary.longest, int(lengths.max()))
    unit = np.repeat(np.arange(len(units)), lengths)
    left = ends[unit] - np.arange(n)  # characters from here to the unit's end
    scores = np.full((width + 1, n), _NONE)
    ids = np.zeros((width + 1, n), np.int32)
    code = np.zeros(n, np.uint64)
    for size in range(1, width + 1):
        m = n - size + 1
        code = code[:m] * _STEP + chars[size - 1 :]
        at = np.flatnonzero((left[:m] >= size) & vocabulary.near[_spread(code)])
        place = np.minimum(np.searchsorted(vocabulary.codes, code[at]), len(vocabulary.codes) - 1)
        same = vocabulary.codes[place] == code[at]
        at, place = at[same], place[same]
        scores[size, at], ids[size, at] = vocabulary.code_scores[place], vocabulary.code_ids[place]
    forward, backward = np.full(n + len(units), _NONE), np.full(n + len(units), _NONE)  # one more place per unit
    shift = np.arange(len(units))
    head, tail = starts + shift, ends + shift
    chosen = np.zeros(n + len(units), np.int64)
    forward[head] = 0.0
    backward[tail] = 0.0
    for step in range(1, int(lengths.max()) + 1):
        own = np.flatnonzero(lengths >= step)
        to, back = head[own] + step, tail[own] - step
        at, back_at = starts[own] + step, ends[own] - step
        for size in range(1, min(width, step) + 1):
            value = forward[to - size] + scores[size, at - size]
            better = value > forward[to]
            forward[to[better]], chosen[to[better]] = value[better], size
            np.copyto(value, backward[back + size] + scores[size, back_at])
            backward[back] = np.maximum(backward[back], value)
    best = forward[tail]
    parts, at, own = [], ends.copy(), np.arange(len(units))
    while len(own):  # from the end, one piece of every unit at a time
        size = chosen[at + own]
        at = at - size
        parts.append((own, at.copy(), ids[size, at]))
        scores[size, at] = _NONE  # what is left differs from the best segmentation
        going = at > starts[own]
        own, at = own[going], at[going]
    second = np.full(len(units), _NONE)
    here = np.arange(n) + unit
    for size in range(1, width + 1):
        m = n - size + 1
        value = np.full(n, _NONE)
        inside = np.flatnonzero(left[:m] >= size)
        value[inside] = forward[here[inside]] + scores[size, inside] + backward[here[inside] + size]
        second = np.maximum(second, np.maximum.reduceat(value, starts))
    units_of, places, found = (np.concatenate(x) for x in zip(*parts))
    with np.errstate(invalid="ignore"):
        return found[np.lexsort((places, units_of))], np.bincount(units_of, minlength=len(units)), best, best - second


def ragged(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... sizes[0] of them, then those of first[1], and so on."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class _Grown:
    """A numpy array that grows at its end."""

    def __init__(self, kind: type) -> None:
        self.room, self.n = np.empty(1 << 16, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.room):
            self.room = np.concatenate((self.room[: self.n], np.empty(self.n + 2 * len(more), self.room.dtype)))
        self.room[self.n : self.n + len(more)] = more
        self.n += len(more)


class Encoder:
    """Segments texts; units that were met before are looked up."""

    def __init__(self, vocabulary: Vocabulary, cache_units: int = CACHE_UNITS, batch_units: int = BATCH_UNITS) -> None:
        self.vocabulary, self.cache_units, self.batch_units = vocabulary, cache_units, batch_units
        self.known = frozenset(p for p in vocabulary.pieces if len(p) == 1)
        sizes = np.array([len(b) for b in vocabulary.out])
        self.out = np.frombuffer(b"".join(vocabulary.out), np.uint8), np.cumsum(sizes) - sizes, sizes
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.others: dict[str, list[tuple[float, tuple[int, ...]]]] = {}
        self.ids, self.sizes, self.score, self.loss = _Grown(np.int32), _Grown(np.int64), _Grown(np.float64), _Grown(np.float64)
        self.first = _Grown(np.int64)
        self.own_ids, self.own_sizes, self.own_score = _Grown(np.int32), _Grown(np.int64), _Grown(np.float64)
        self.own_first = _Grown(np.int64)

    def units(self, text: str) -> list[str]:
        return self.vocabulary.units.findall(MARK + text.replace(" ", MARK)) if text else []

    def _add(self, units: list[str], ids: np.ndarray, sizes: np.ndarray, score: np.ndarray, loss: np.ndarray, own: tuple | None) -> None:
        """own: ids, sizes and scores of the units cut by merges, where the model has these."""
        self.place.update(zip(units, range(len(self.place), len(self.place) + len(units))))
        self.first.add(self.ids.n + np.cumsum(sizes) - sizes)
        for room, more in ((self.ids, ids), (self.sizes, sizes), (self.score, score), (self.loss, loss)):
            room.add(more)
        if own is not None:
            ids, sizes, score = own
        self.own_first.add(self.own_ids.n + np.cumsum(sizes) - sizes)
        for room, more in ((self.own_ids, ids), (self.own_sizes, sizes), (self.own_score, score)):
            room.add(more)

    def learn(self, units: list[str]) -> np.ndarray:
        """Segments the units that are new; the places of all in the arrays."""
        distinct = set(units)
        missing = distinct.difference(self.place)
        if len(self.place) + len(missing) > self.cache_units and self.place:
            self.forget()
            missing = distinct
        plain = [u for u in missing if len(u) <= LONG_UNIT and self.known.issuperset(u)]
        for at in range(0, len(plain), self.batch_units):
            some = plain[at : at + self.batch_units]
            self._add(some, *batch(self.vocabulary, some), merge_batch(self.vocabulary, some) if self.vocabulary.merges else None)
        for u in missing.difference(plain):
            first, *more = Lattice(self.vocabulary, u).nbest(2)
            loss = first.score - more[0].score if more else np.inf
            cut = merged(self.vocabulary, u)
            own = (np.array(cut.ids, np.int32), np.array([len(cut.ids)]), np.array([cut.score])) if self.vocabulary.merges else None
            self._add([u], np.array(first.ids), np.array([len(first.ids)]), np.array([first.score]), np.array([loss]), own)
        return np.fromiter(map(self.place.__getitem__, units), np.int64, len(units))

    def own(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The model's ids of the units one after another, and how many each has."""
        sizes = self.own_sizes.room[places]
        return self.own_ids.room[ragged(self.own_first.room[places], sizes)], sizes

    def encode(self, text: str) -> list[int]:
        """The model's ids of a text."""
        return self.own(self.learn(self.units(text)))[0].tolist()

    def best(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the units one after another, and how many each has."""
        sizes = self.sizes.room[places]
        return self.ids.room[ragged(self.first.room[places], sizes)], sizes

    def alternatives(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """(loss, ids) of the n - 1 next best segmentations of a unit."""
        found = self.others.get(unit)
        if found is None or len(found) < n - 1:
            best = tuple(self.best(np.array([self.place[unit]]))[0].tolist())
            all_of_it = Lattice(self.vocabulary, unit).nbest(n)
            found = [(all_of_it[0].score - s.score, s.ids) for s in all_of_it if s.ids != best][: n - 1]
            if len(self.others) >= self.cache_units // 16:
                self.others.clear()
            self.others[unit] = found
        return found

    def changes(self, units: list[str], losses: np.ndarray, n: int) -> list[tuple[float, list[tuple[int, tuple[int, ...]]]]]:
        """For the 2nd to n-th best segmentation of a text: its loss, and the units that differ from the best one's.

        These are among the n - 1 units with the smallest losses. Ties come in no certain order.
        """
        places = range(len(units))
        if len(units) >= n:
            limit = np.partition(losses, n - 2)[n - 2]
            places = [*np.flatnonzero(losses < limit).tolist(), *np.flatnonzero(losses == limit)[: n - 1].tolist()][: n - 1]
        options = [(i, self.alternatives(units[i], n)) for i in places if losses[i] < np.inf]
        options = sorted((o for o in options if o[1]), key=lambda o: o[1][0][0])
        # choices are (option, alternative) with options ascending; each set of choices is reached once
        heap = [(options[0][1][0][0], ((0, 0),))] if options else []
        out = []
        while heap and len(out) < n - 1:
            loss, choices = heapq.heappop(heap)
            out.append((loss, [(options[o][0], options[o][1][k][1]) for o, k in choices]))
            o, k = choices[-1]
            others = loss - options[o][1][k][0]
            if k + 1 < len(options[o][1]):
                heapq.heappush(heap, (others + options[o][1][k + 1][0], (*choices[:-1], (o, k + 1))))
            if o + 1 < len(options):
                first = options[o + 1][1][0][0]
                heapq.heappush(heap, (loss + first, (*choices, (o + 1, 0))))
                if k == 0:
                    heapq.heappush(heap, (others + first, (*choices[:-1], (o + 1, 0))))
        return out

    def nbest(self, text: str, n: int) -> list[Segmentation]:
        """The n best segmentations of a text."""
        units = self.units(text)
        places = self.learn(units)
        score = float(self.score.room[places].sum())
        parts = [tuple(self.best(places[i : i + 1])[0].tolist()) for i in range(len(units))]
        out = [Segmentation(score, tuple(itertools.chain.from_iterable(parts)))]
        for loss, changed in self.changes(units, self.loss.room[places], n) if n > 1 else []:
            own = dict(changed)
            out.append(Segmentation(score - loss, tuple(itertools.chain.from_iterable(own.get(i, p) for i, p in enumerate(parts)))))
        return out

    def spelled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the pieces one after another, and how many each has."""
        flat, first, sizes = self.out
        return flat[ragged(first[ids], sizes[ids])], sizes[ids]

    def decode(self, ids) -> str:
        table = self.vocabulary.out
        raw = b"".join([table[i] for i in ids])
        return raw[raw.startswith(b" ") :].decode("utf-8", "replace")


def _encoder(model: bytes, cache_units: int = CACHE_UNITS, batch_units: int = BATCH_UNITS) -> Encoder:
    """One per worker process, for the tasks that follow each other in it."""
    name = f"encoder {hashlib.sha256(model).hexdigest()} {cache_units} {batch_units}"
    return kept(name, lambda: Encoder(Vocabulary(model), cache_units, batch_units))


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        model = f.read(MODEL_BYTES + 1)
    if len(model) > MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
    return model


def default_model() -> str:
    """The public 32k model of this installation."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, model: bytes, n_best: int = NBEST, small: bool = False) -> DataFrame:
    """doc_id, n_bytes, ids, n_pieces and score of the model's segmentation, nbest_scores and nbest_pieces of the n_best best of
    the lattice, and round_trip: whether the ids decode to the text.

    small: smaller blocks of text, batches and memory of units in each worker, for about a third more CPU time; the rows are the same. For executors
    whose memory other work has filled.
    """
    shrink = 16 if small else 1
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value, CACHE_UNITS // min(shrink, 8), BATCH_UNITS // min(shrink, 4))
        for rows in batches:
            for row, offsets, data in text_blocks(text_column(rows, "text"), TEXT_BYTES // shrink):
                raw, ends = data.tobytes(), offsets.tolist()
                texts = [raw[a:b].decode() for a, b in zip(ends, ends[1:])]
                units = [encoder.units(t) for t in texts]
                stops = np.cumsum([0, *map(len, units)])
                places = encoder.learn(list(itertools.chain.from_iterable(units)))
                ids, own_sizes = encoder.own(places)
                before = np.concatenate(([0], np.cumsum(own_sizes)))  # pieces before each unit
                sizes = encoder.sizes.room[places]
                loss = encoder.loss.room[places]
                bytes_of, spelled = encoder.spelled(ids)
                letters = np.concatenate(([0], np.cumsum(spelled)))
                out: list[tuple] = []
                for i, own in enumerate(units):
                    a, b = int(stops[i]), int(stops[i + 1])
                    best_pieces = int(sizes[a:b].sum())
                    total = float(encoder.score.room[places[a:b]].sum())
                    others = encoder.changes(own, loss[a:b], n_best)
                    grown = [sum(len(new) - int(sizes[a + j]) for j, new in changed) for _, changed in others]
                    back = bytes_of[letters[before[a]] : letters[before[b]]].tobytes()
                    out.append((
                        ends[i + 1] - ends[i], int(before[b] - before[a]), float(encoder.own_score.room[places[a:b]].sum()),
                        [total, *(total - x for x, _ in others)], [best_pieces, *(best_pieces + x for x in grown)],
                        back[1:] == raw[ends[i] : ends[i + 1]],
                    ))
                lists = pa.ListArray.from_arrays(pa.array(before[stops], pa.int32()), pa.array(ids, pa.int32()))
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.bool_())
                columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).slice(row, len(texts)), *columns, lists],
                    names=["doc_id", "n_bytes", "n_pieces", "score", "nbest_scores", "nbest_pieces", "round_trip", "ids"],
                )

    schema = (
        f"doc_id {kind}, n_bytes bigint, n_pieces bigint, score double, nbest_scores array<double>, "
        "nbest_pieces array<bigint>, round_trip boolean, ids array<int>"
    )
    return in_batches(docs.select("doc_id", "text"), run, schema, keeps=True, most=ARROW_BYTES // min(shrink, 4))


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """doc_id and text of encoded documents."""
    sent = encoded.sparkSession.sparkContext.broadcast(model)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value)
        for rows in batches:
            texts = [encoder.decode(x or []) for x in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return in_batches(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, text string", keeps=True)
