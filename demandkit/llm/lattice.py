"""Distinct random segmentations of texts into the pieces of a SentencePiece model.

The segmentations of a text are the paths of a lattice whose edges are pieces. Adding independent
Gumbel noise to the log probabilities of all paths and taking the k largest draws k paths without
replacement (Kool et al., 2019). The largest is found by a perturbed A* search (Maddison et al.,
2014): all paths but the ones already found are kept as sets, each set being the paths that follow
a found path up to a node and leave it there by an edge not yet taken. A set's mass is known from
the backward sums of the lattice, its largest perturbed value is drawn from a Gumbel distribution cut
off at the value of the set it came from, and only the set with the largest value is opened.

All texts of a batch take each step together in numpy. As no piece holds white space after its
beginning, the lattice of a text is a chain of small ones, and each distinct one is built once.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np

SPACE = "▁"  # fixed value: how pieces write a space
_NO_PIECE = 0x110000  # a code no text has, for the space sign itself when it is in a text
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniforms(seed: np.ndarray, draw: int, place: np.ndarray, row: np.ndarray | None = None) -> np.ndarray:
    """Numbers in (0, 1) that depend on a row's seed, the draw and the place in the row, and on nothing else.

    ``row`` says which seed each place belongs to; without it they go side by side.
    """
    start = _mix(seed + np.uint64((draw + 1) * int(_GOLD) % (1 << 64)))
    bits = _mix((start if row is None else start[row]) + _GOLD * (place.astype(np.uint64) + np.uint64(1)))
    return ((bits >> np.uint64(40)).astype(np.float64) + 0.5) / (1 << 24)


@dataclass
class Vocabulary:
    """Pieces as a hash table of their code points, with log probabilities, and the bytes they decode to."""

    longest: int
    slots: np.ndarray  # piece id; -2 for the beginning of a piece that is none itself; -1 if empty
    hashes: np.ndarray
    log_p: np.ndarray  # by id
    byte_ids: np.ndarray  # id of each byte
    byte_log_p: float
    decoded: list[bytes]  # by id

    @classmethod
    def of(cls, pieces: Sequence[str], scores: Sequence[float], byte_ids: Sequence[int], ranked: bool) -> Vocabulary:
        """``pieces`` by id; empty ones are not used in segmentations.

        ``scores`` are log probabilities, or, if ``ranked`` (a merge model), minus the rank of the
        piece: rank r then has a probability in proportion to 1 / r.
        """
        used = np.array([bool(p) for p in pieces])
        scores = np.asarray(scores, float)
        log_p = -np.log(1 - np.minimum(scores, 0)) if ranked else scores.copy()
        top = log_p[used].max()
        log_p -= top + np.log(np.exp(log_p[used] - top).sum())
        entries: dict[int, int] = {}
        for i in np.flatnonzero(used).tolist():
            h = 0
            for n, c in enumerate(pieces[i], 1):
                h = (h * int(_BASE) + ord(c) + 1) % (1 << 64)
                if n == len(pieces[i]):
                    entries[h] = i
                else:
                    entries.setdefault(h, -2)
        size = 1 << max(10, (len(entries) * 4 - 1).bit_length())
        slots, hashes = np.full(size, -1, np.int32), np.zeros(size, np.uint64)
        keys = np.array(list(entries), np.uint64)
        places = (_mix(keys) >> np.uint64(64 - size.bit_length() + 1)).tolist()
        for h, at, i in zip(keys, places, entries.values()):
            while slots[at] != -1:
                at = (at + 1) % size
            slots[at], hashes[at] = i, h
        decoded = [p.replace(SPACE, " ").encode() for p in pieces]
        for b, i in enumerate(byte_ids):
            decoded[i] = bytes([b])
        return cls(max(map(len, pieces)), slots, hashes, log_p, np.asarray(byte_ids), float(log_p[used].min()) - 2, decoded)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a SentencePiece model file with byte pieces."""
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        odd = [m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i) for i in range(n)]
        scores = [m.get_score(i) for i in range(n)]
        # pieces no merge ever makes are put far below all others: of these only single code points count
        made = [not x and s > -1e8 for x, s in zip(odd, scores)]
        plain = [p or not odd[i] and len(m.id_to_piece(i)) == 1 for i, p in enumerate(made)]
        least = min(s for s, p in zip(scores, made) if p)
        scores = [max(s, least) for s in scores]
        byte_ids = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(p and SPACE in m.id_to_piece(i)[1:] for i, p in enumerate(plain)):
            raise ValueError("a piece holds a space after its beginning: the lattice is no chain of words")
        ranked = all(s == int(s) for s, p in zip(scores, plain) if p)
        return cls.of([m.id_to_piece(i) if p else "" for i, p in enumerate(plain)], scores, byte_ids, ranked)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of hashes of code points; -2 where a piece only begins so, -1 where none does."""
        at = (_mix(h) >> np.uint64(64 - len(self.slots).bit_length() + 1)).astype(np.int64)
        found = self.slots[at]
        open_ = np.flatnonzero((found != -1) & (self.hashes[at] != h))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.slots)
            found[open_] = self.slots[at[open_]]
            open_ = open_[(found[open_] != -1) & (self.hashes[at[open_]] != h[open_])]
        return found

    def decode(self, ids: Sequence[int]) -> str:
        """The text of a segmentation of ``segment``; the space put before every text goes again."""
        return b"".join(map(self.decoded.__getitem__, ids))[1:].decode("utf-8", "surrogatepass")


@dataclass
class Lattice:
    """The lattices of distinct words.

    The words are ranked from long to short, and a position is where it lies by the number of code
    points left: the positions with r left, one for each word that is long enough, follow each other
    from ``first[r]`` on in the order of the words. A step of the backward sums then takes one
    slice and adds others to it.

    ``log_q[n - 1, p]`` is the log probability to leave position p by the edge of n code points,
    ``upto[p]`` the running sum over n, ``ids[n - 1, p]`` the piece, or -1 - code point for one that
    only bytes can write.
    """

    log_q: np.ndarray
    upto: np.ndarray
    ids: np.ndarray
    first: np.ndarray


def build(v: Vocabulary, words: Sequence[str]) -> tuple[Lattice, np.ndarray, np.ndarray]:
    """Lattice of all ``words``; the rank of each, and how many code points it has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sign = codes == ord(SPACE)
    codes[codes == 0x20] = ord(SPACE)
    codes[sign] = _NO_PIECE
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(-sizes, kind="stable")] = np.arange(len(words))
    longer = np.cumsum(np.bincount(sizes, minlength=2)[::-1])[::-1]  # words of at least r code points
    first = np.concatenate([[0, 0], np.cumsum(longer[1:])])
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))
    place = first[left] + np.repeat(rank, sizes)

    ids, log_w = [], []
    at, rolling = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
    for n in range(1, min(v.longest, len(longer) - 1) + 1):
        rolling = rolling * _BASE + (codes[at + n - 1] + np.uint64(1))
        found = v.find(rolling)
        hit = found >= 0
        own, w = np.full(len(codes), -1, np.int32), np.full(len(codes), -np.inf, np.float32)
        to = place[at[hit]]
        own[to], w[to] = found[hit], v.log_p[found[hit]]
        if n == 1:  # what has no piece of its own is written in bytes
            code, to = codes[at[~hit]].astype(np.int64), place[at[~hit]]
            code[code == _NO_PIECE] = ord(SPACE)
            own[to] = np.where(code < 128, v.byte_ids[np.minimum(code, 127)], -1 - code)
            w[to] = (1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)) * v.byte_log_p
        ids.append(own)
        log_w.append(w)
        goes_on = (found != -1) & (left[at] > n)
        at, rolling = at[goes_on], rolling[goes_on]
    while len(log_w) > 1 and not np.isfinite(log_w[-1]).any():
        ids.pop()
        log_w.pop()
    log_q, most = np.stack(log_w), len(log_w)
    upto = np.ones((len(codes), most), np.float32)
    back = [np.zeros(len(words))]
    for r in range(1, len(longer)):
        n, here = min(r, most), slice(first[r], first[r] + longer[r])
        values = log_q[:n, here] + np.stack([back[-1 - i][: longer[r]] for i in range(n)])
        top = values.max(axis=0)
        sums = np.cumsum(np.exp(values - top), axis=0)
        total = top + np.log(sums[-1])
        log_q[:n, here] = values - total
        upto[here, :n] = (sums / sums[-1]).T
        back = [*back[-most:], total] if most > 1 else [total]
    return Lattice(log_q, upto, np.stack(ids), first), rank, sizes


@dataclass
class Segmentation:
    ids: np.ndarray
    log_p: float
    perturbed: float
    log_inclusion: float


def _log1mexp(x: np.ndarray) -> np.ndarray:
    """log(1 - exp(x)) for x <= 0; -inf at 0."""
    with np.errstate(divide="ignore"):
        return np.where(x > -0.7, np.log(-np.expm1(np.minimum(x, 0))), np.log1p(-np.exp(np.minimum(x, -0.7))))


def _cut_gumbel(mass: np.ndarray, most: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The largest of Gumbel values with total log mass ``mass``, given that it is below ``most``."""
    return mass - np.log(np.exp(np.minimum(mass - most, 700)) - np.log(u))


_WORDS = re.compile(r"\n| *[^ \n]+| +")


def segment(v: Vocabulary, texts: Sequence[str], seeds: Sequence[int], k: int) -> list[list[Segmentation]]:
    """For each text its ``k`` segmentations of largest perturbed log probability, largest first.

    A text that has fewer segmentations gives them all; an empty text has one, of no pieces. The
    inclusion probability of a path is that of its perturbed value exceeding the (k + 1)-th largest.
    """
    out: list[list[Segmentation]] = [[] for _ in texts]
    rows = [i for i, t in enumerate(texts) if t]
    for i, t in enumerate(texts):
        if not t:
            out[i].append(Segmentation(np.zeros(0, np.int32), 0.0, 0.0, 0.0))
    if not rows:
        return out
    known: defaultdict[str, int] = defaultdict(count().__next__)
    word_lists = [list(map(known.__getitem__, _WORDS.findall(" " + texts[i]))) for i in rows]
    lattice, rank, sizes = build(v, list(known))
    words = np.concatenate([np.array(x, np.int64) for x in word_lists])
    row_of = np.repeat(np.arange(len(rows)), [len(x) for x in word_lists])
    length = sizes[words]
    begin = np.cumsum(length) - length  # of each word in the batch's texts
    total = int(length.sum())
    first_word = np.searchsorted(row_of, np.arange(len(rows)))
    first = begin[first_word]
    seed = np.array([seeds[i] % (1 << 64) for i in rows], np.uint64)
    end = begin + length
    where = lattice.first[np.repeat(end, length) - np.arange(total)] + np.repeat(rank[words], length)  # in the lattice

    def walk(steps: np.ndarray, draw: int, at: np.ndarray, word: np.ndarray) -> None:
        """Leave every place in ``at`` by random edges to the end of its word; ``steps`` gets their lengths."""
        while len(at):
            row = row_of[word]
            u = uniforms(seed, draw, at - first[row], row).astype(np.float32)
            n = (lattice.upto[where[at]] > u[:, None]).argmax(axis=1) + 1
            steps[at] = n
            at = at + n
            going = at < end[word]
            at, word = at[going], word[going]

    all_steps: list[np.ndarray] = []
    # of each draw, for the places its path leaves the ones before it behind: where they are, the
    # largest value of the paths that leave it there, its log probability up to there; cuts by row
    spots_of: list[np.ndarray] = []
    values: list[np.ndarray] = []
    prefix: list[np.ndarray] = []
    cuts: list[np.ndarray] = []
    taken: dict[tuple[int, int], list[int]] = {}
    log_ps: list[np.ndarray] = []
    pieces: list[tuple[np.ndarray, np.ndarray]] = []
    live = np.ones(len(rows), bool)
    paths: list[list[tuple[int, float]]] = [[] for _ in rows]
    last_word = np.searchsorted(row_of, np.arange(len(rows)), "right")

    for draw in range(k):
        steps = np.zeros(total, np.uint8)
        start = first.copy()  # the place where the path leaves the one it came from
        base = np.zeros(len(rows))  # log probability up to there
        if draw == 0:
            top = -np.log(-np.log(uniforms(seed, 0, np.full(len(rows), 1 << 40))))
            walk(steps, draw, begin, np.arange(len(words)))
        else:
            top = np.full(len(rows), -np.inf)
            at, word = [], []
            for r in np.flatnonzero(live).tolist():
                a, d, j = int(first[r]), -1, -1
                for i in range(draw):
                    low, high = cuts[i][r], cuts[i][r + 1]
                    if low < high:
                        at_most = low + int(values[i][low:high].argmax())
                        if values[i][at_most] > top[r]:
                            top[r], d, j = values[i][at_most], i, at_most
                if d < 0:
                    live[r] = False
                    continue
                t = int(spots_of[d][j])
                # leave there by an edge that no path has taken
                gone = taken.setdefault((d, j), [int(all_steps[d][t])])
                p = np.exp(lattice.log_q[:, where[t]].astype(np.float64))
                p[np.array(gone) - 1] = 0
                u = uniforms(seed[r : r + 1], draw, np.array([t - a]))[0]
                n = int((np.cumsum(p) <= u * p.sum()).sum()) + 1
                while p[n - 1] == 0:
                    n -= 1
                gone.append(n)
                rest = p.sum() - p[n - 1]
                base[r] = prefix[d][j] + lattice.log_q[n - 1, where[t]]
                if rest > 1e-12 * p.sum() and (p > 0).sum() > 1:
                    u = uniforms(seed[r : r + 1], draw, np.array([(1 << 41) + t - a]))[0]
                    values[d][j] = _cut_gumbel(prefix[d][j] + np.log(rest), top[r], u)
                else:
                    values[d][j] = -np.inf
                steps[a:t] = all_steps[d][a:t]
                steps[t] = n
                start[r] = t + 1
                w = first_word[r] + int(np.searchsorted(begin[first_word[r] : last_word[r]], t, "right")) - 1
                if t + n < end[w]:
                    at.append(np.array([t + n]))
                    word.append(np.array([w]))
                later = np.arange(w + 1, last_word[r])
                at.append(begin[later])
                word.append(later)
            if at:
                walk(steps, draw, np.concatenate(at), np.concatenate(word))
        spots = np.flatnonzero(steps)
        n = steps[spots].astype(np.int64) - 1
        pieces.append((lattice.ids[n, where[spots]], np.searchsorted(spots, np.append(first, total))))
        if draw:
            new = spots >= np.repeat(start, np.diff(pieces[-1][1]))
            spots, n = spots[new], n[new]
        cut = np.searchsorted(spots, np.append(first, total))
        row = np.repeat(np.arange(len(rows)), np.diff(cut))
        log_q = lattice.log_q[n, where[spots]].astype(np.float64)
        sums = np.concatenate([[0.0], np.cumsum(log_q)])
        before = (base - sums[cut[:-1]])[row] + sums[:-1]
        mass = before + _log1mexp(log_q)
        u = uniforms(seed, draw, (1 << 42) + spots - first[row], row)
        with np.errstate(divide="ignore", invalid="ignore"):
            values.append(np.where(np.isfinite(mass), _cut_gumbel(mass, top[row], u), -np.inf))
        all_steps.append(steps)
        spots_of.append(spots)
        prefix.append(before)
        cuts.append(cut)
        log_ps.append(base + sums[cut[1:]] - sums[cut[:-1]])
        for r in np.flatnonzero(live).tolist():
            paths[r].append((draw, float(top[r])))

    best = np.full(len(rows), -np.inf)
    for value, cut in zip(values, cuts):
        np.maximum.at(best, np.repeat(np.arange(len(rows)), np.diff(cut)), value)
    for r, i in enumerate(rows):
        for draw, value in paths[r]:
            ids, cut = pieces[draw]
            mine = ids[cut[r] : cut[r + 1]]
            log_p = float(log_ps[draw][r])
            over = log_p - best[r]
            # log(1 - exp(-exp(over))): the path's own Gumbel value exceeds the best of what is left
            inclusion = 0.0 if over > 4 else float(np.log(-np.expm1(-np.exp(over)))) if over > -30 else over
            out[i].append(Segmentation(_in_bytes(v, mine), log_p, value, inclusion))
    return out


def _in_bytes(v: Vocabulary, ids: np.ndarray) -> np.ndarray:
    """Code points that no piece writes as the pieces of their bytes."""
    if not len(ids) or ids.min() >= 0:
        return ids
    parts, low = [], 0
    for at in np.flatnonzero(ids < 0).tolist():
        parts += [ids[low:at], v.byte_ids[list(chr(-1 - int(ids[at])).encode("utf-8", "surrogatepass"))]]
        low = at + 1
    return np.concatenate([*parts, ids[low:]]).astype(np.int32)
