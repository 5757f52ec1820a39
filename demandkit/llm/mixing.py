"""Adaptive context-mixing range coder for token ids: blocks of ids to bytes and back.

A block is coded from nothing: its models are reset, so that any block can be read alone. Three
predictions are mixed for every id. Order 2 and order 1 name the id that last followed the same two
ids, and the same one id, each with a confidence of 0 to 3. How much of the code space their ids get
is learned for each pair of confidences, apart for pairs that agree. Order 0 shares out the rest: ids
lie in classes of neighbouring ids, classes get space by their counts so far, the ids of one class
alike. What follows a context is taken in at once; counts of classes and of right predictions become
space at the steps of ``RENEW``. Encoder and decoder keep the same state in whole numbers, and each id
narrows one range of 64 bits, whose upper 32 bits are written as soon as the range fits into the lower
ones.

Blocks do not depend on each other, so many are coded side by side: a step of the loops below takes
the next id of every block, as a few numpy operations over all of them. The encoder knows the ids
ahead; between two renewals only its followers and its range go step by step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Ids are kept in 16 bits.
IDS = 1 << 16
#: Log 2 of the slots for contexts of one order in a block.
SLOTS = 12
#: Log 2 of the code space that all ids share, of order 0's own scale within its part, and of its cells.
SPACE, SCALE, CELLS = 28, 20, 11
CLASSES = 128
#: After how many ids counts become space; from the last on, again and again.
RENEW = (32, 64, 128, 256)
#: Most steps of which the encoder holds everything.
_STRETCH = 64
_WORD = np.uint64(32)
_SPACE = np.uint64(SPACE)
_FULL = np.uint64((1 << 64) - 1)
_SMALL = np.uint64(1 << 32)
#: A 64th of the space always stays for order 0.
_SHARE, _LEAST = (1 << SPACE) - (1 << (SPACE - 6)), 2048
_TIMES, _TIMES2, _SHIFT = np.int32(-1640531535), np.int32(-2048144777), np.uint32(32 - SLOTS)
#: How often a class is counted for one id, against once at first.
_COUNT = 24
#: Right predictions of 65,536 at first, by confidence, and how many predictions that counts as.
_FIRST, _WEIGHT = np.array([512, 16384, 32768, 49152]), 24
#: A follower is an id above five bits for its confidence, which lies where the state has it.
_ID, _ONE, _MOST = 5, np.array([[2], [8]], np.int32), np.array([[6], [24]], np.int32)


def _class_starts() -> np.ndarray:
    """Where classes begin: narrow among small ids, which merge lists give to frequent tokens."""
    edges = np.unique(np.round(np.expm1(np.linspace(0, np.log1p(IDS / 64), CLASSES + 1)) * 64).astype(np.int64))
    while len(edges) <= CLASSES:
        widest = np.argmax(np.diff(edges))
        edges = np.insert(edges, widest + 1, (edges[widest] + edges[widest + 1]) // 2)
    return edges


_EDGES = _class_starts()
_LOW, _WIDE = _EDGES[:-1], np.diff(_EDGES)
_CLASS_OF = np.repeat(np.arange(CLASSES), _WIDE)
_CELL, _EACH = SCALE - CELLS, (1 << SCALE) - 1
#: Cells that a class has at least, so that each of its ids has some space.
_CELLS = -(-_WIDE >> _CELL)


class _Models:
    """What is known of each of ``lanes`` blocks after some of its ids."""

    def __init__(self, lanes: int):
        self.follower = np.zeros(2 * lanes << SLOTS, np.int32)
        self.slots = np.arange(2 * lanes).reshape(2, lanes) << SLOTS
        state = np.arange(32)
        first2 = _FIRST[state >> 3]
        first1 = np.where(state & 1, 0, (65536 - first2) * _FIRST[state >> 1 & 3] >> 16)
        first = np.stack([first2, first1, 65536 - first2 - first1], axis=1)
        #: By block and state: how often order 2, only order 1, or none of them was right.
        self.right = np.tile((first * _WEIGHT).ravel(), lanes)
        self.counts = np.ones(lanes * CLASSES, np.int64)
        lane = np.arange(lanes)
        self.rows, self.of_class, self.of_cell = lane << 5, lane * CLASSES, lane << CELLS
        self.renew(lanes)

    def renew(self, n: int) -> None:
        """Space of both orders by state; where each class begins, and the space for each id of it."""
        right = self.right.reshape(-1, 3)[: n << 5]
        whole = right.sum(axis=1)
        space2 = right[:, 0] * _SHARE // whole + _LEAST
        self.spaces = space2 << 32 | space2 + right[:, 1] * _SHARE // whole + _LEAST
        counts = self.counts.reshape(-1, CLASSES)[:n]
        cells = ((1 << CELLS) - _CELLS.sum()) * counts // counts.sum(axis=1, keepdims=True) + _CELLS
        self.cells = cells
        begins = np.zeros((n, CLASSES), np.int64)
        np.cumsum(cells[:, :-1], axis=1, out=begins[:, 1:])
        self.classes = (begins << SCALE | (cells << _CELL) // _WIDE).astype(np.int32).ravel()

    def learn(self, n: int, states: np.ndarray, ids: np.ndarray, right2: np.ndarray, missed: np.ndarray) -> None:
        """Count what came in some steps, as rows, in the first ``n`` blocks."""
        kind = states * 3 + 1
        kind += missed
        kind -= right2
        self.right[: n * 96] += np.bincount(kind.ravel(), minlength=n * 96) << 16
        at = (_CLASS_OF.take(ids) + self.of_class[:n])[missed]
        self.counts[: n * CLASSES] += _COUNT * np.bincount(at, minlength=n * CLASSES)

    def contexts(self, last: np.ndarray, before: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Where the followers of one id and of two ids are kept."""
        hashed = np.empty((2, *last.shape), np.int32)
        np.multiply(last, _TIMES, out=hashed[0])
        np.multiply(hashed[0] ^ before, _TIMES2, out=hashed[1])
        at = (hashed.view(np.uint32) >> _SHIFT).astype(np.int64)
        at += slots
        return at

    def follow(self, at: np.ndarray, found: np.ndarray, said: np.ndarray, ids: np.ndarray) -> None:
        """``ids`` came where ``found`` was kept: a right follower is surer, a wrong one is replaced."""
        raised = ids << _ID
        self.follower[at] = np.where(said == ids, np.minimum(found + _ONE, raised | _MOST), raised | _ONE)


def _states(found: np.ndarray, said: np.ndarray) -> np.ndarray:
    """Both confidences and whether the orders agree, as one number."""
    return (found[0] & 6) + (found[1] & 24) + (said[0] == said[1])


def _layout(lengths: list[int]) -> tuple[np.ndarray, Iterator[tuple[int, int, int, bool]]]:
    """Blocks by falling length; stretches of steps, how many blocks go on in them, and whether counts become space before."""
    sizes = np.array(lengths, np.int64)
    order = np.argsort(-sizes, kind="stable")
    steps = int(sizes.max(initial=0))
    renewals = {*RENEW, *range(RENEW[-1], steps, RENEW[-1])}
    cuts = sorted(c for c in {*range(0, steps, _STRETCH), *renewals, *sizes.tolist()} if c <= steps)
    going = len(sizes) - np.searchsorted(np.sort(sizes), cuts, side="right")
    return order, ((a, b, n, a in renewals) for a, b, n in zip(cuts, cuts[1:], going.tolist()))


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of ids (below 65,536) as bytes, by itself."""
    order, stretches = _layout([len(b) for b in blocks])
    lanes, steps = len(blocks), max(map(len, blocks), default=0)
    #: two steps ahead of the ids, so that each has two before it
    table = np.zeros((steps + 2, lanes), np.int32)
    for row, at in enumerate(order):
        table[2 : len(blocks[at]) + 2, row] = blocks[at]
    wide = steps + 3
    words = np.zeros(lanes * wide, np.uint32)
    end = np.arange(lanes, dtype=np.int64) * wide
    first = end.copy()
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, _FULL)
    models, one = _Models(lanes), np.uint32(1)
    for start, stop, n, renewed in stretches:
        if renewed:
            models.renew(n)
        ids = np.ascontiguousarray(table[start + 2 : stop + 2, :n])
        at = models.contexts(table[start + 1 : stop + 1, :n], table[start:stop, :n], models.slots[:, None, :n]).swapaxes(0, 1).copy()
        found = np.empty((2, stop - start, n), np.int32)
        for step in range(stop - start):
            known = models.follower.take(at[step])
            found[:, step] = known
            models.follow(at[step], known, known >> _ID, ids[step])
        said = found >> _ID
        states = models.rows[:n] + _states(found, said)
        spaces = models.spaces.take(states)
        space2, both = spaces >> 32, spaces & 0xFFFFFFFF
        unit = ((1 << SPACE) - both) >> SCALE
        right2 = said[1] == ids
        only1 = (said[0] == ids) & ~right2
        missed = ~(right2 | only1)
        classes = _CLASS_OF.take(ids)
        known = models.classes.take(models.of_class[:n] + classes)
        each = known & _EACH
        begins = both + unit * ((known >> SCALE << _CELL) + (ids - _LOW.take(classes)) * each)
        begins = np.where(missed, begins, np.where(only1, space2, 0)).view(np.uint64)
        widths = np.where(missed, unit * each, np.where(only1, both - space2, space2)).view(np.uint64)
        models.learn(n, states, ids, right2, missed)
        for begin, width in zip(begins, widths):
            part = size[:n] >> _SPACE
            begin *= part
            width *= part
            new = low[:n]
            new += begin
            carried = new < begin
            back = end[np.flatnonzero(carried)] - 1
            while len(back):  # a carry into words already written, and on where these were all ones
                words[back] += one
                back = back[words[back] == 0] - 1
            out = np.flatnonzero(width < _SMALL)
            place, ready = end[out], new[out]
            words[place] = ready >> _WORD
            end[out] = place + 1
            new[out] = ready << _WORD
            width[out] <<= _WORD
            size[:n] = width
    words[end], words[end + 1] = low >> _WORD, low.astype(np.uint32)
    made = [b""] * lanes
    for row, at in enumerate(order.tolist()):
        made[at] = words[first[row] : end[row] + 2].astype("<u4").tobytes()
    return made


def decode_blocks(coded: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The ids of each block, whose numbers are given."""
    order, stretches = _layout(lengths)
    lanes, steps = len(coded), max(lengths, default=0)
    # two words are always ahead of the ids read so far
    words = np.frombuffer(b"".join(coded[at] for at in order), "<u4").astype(np.uint64)
    sizes = np.array([len(coded[at]) // 4 for at in order], np.int64)
    at_word = np.cumsum(sizes) - sizes
    code = words[at_word] << _WORD | words[at_word + 1] if lanes else np.empty(0, np.uint64)
    at_word = at_word + 2
    size = np.full(lanes, _FULL)
    table = np.zeros((steps + 2, lanes), np.int32)
    models = _Models(lanes)
    cell_class = np.empty(0, np.uint8)
    for start, stop, n, renewed in stretches:
        if renewed or not start:
            models.renew(n)
            left_over = (1 << CELLS) - models.cells.sum(axis=1)
            models.cells[:, -1] += left_over
            cell_class = np.repeat(np.tile(np.arange(CLASSES, dtype=np.uint8), n), models.cells.ravel())
        slots, rows, of_class, of_cell = (np.ascontiguousarray(x[..., :n]) for x in (models.slots, models.rows, models.of_class, models.of_cell))
        states, hits, misses = np.empty((stop - start, n), np.int64), np.empty((stop - start, n), bool), np.empty((stop - start, n), bool)
        rest, left = code[:n], size[:n]
        before, last = table[start, :n], table[start + 1, :n]
        for step in range(stop - start):
            at = models.contexts(last, before, slots)
            found = models.follower.take(at)
            said = found >> _ID
            state = np.add(rows, _states(found, said), out=states[step])
            spaces = models.spaces.take(state)
            space2, both = spaces >> 32, spaces & 0xFFFFFFFF
            unit = ((1 << SPACE) - both) >> SCALE
            part = left >> _SPACE
            place = (rest // part).view(np.int64)
            right2 = np.less(place, space2, out=hits[step])
            missed = np.greater_equal(place, both, out=misses[step])
            own = (place - both) // unit
            # where an order was right, this is any class
            classes = cell_class.take(of_cell + (own >> _CELL), mode="clip")
            known = models.classes.take(of_class + classes)
            each, begins = known & _EACH, known >> SCALE << _CELL
            nth = (own - begins) // each
            begin = np.where(missed, both + unit * (begins + nth * each), np.where(right2, 0, space2))
            width = np.where(missed, unit * each, np.where(right2, space2, both - space2))
            ids = table[step + start + 2, :n]
            ids[:] = np.where(missed, nth + _LOW.take(classes), np.where(right2, said[1], said[0]))
            rest -= begin.view(np.uint64) * part
            np.multiply(width.view(np.uint64), part, out=left)
            out = np.flatnonzero(left < _SMALL)
            next_word = at_word[out]
            rest[out] = rest[out] << _WORD | words[next_word]
            at_word[out] = next_word + 1
            left[out] <<= _WORD
            models.follow(at, found, said, ids)
            before, last = last, ids
        models.learn(n, states, table[start + 2 : stop + 2, :n], hits, misses)
    made = [np.empty(0, np.uint16)] * lanes
    for row, at in enumerate(order.tolist()):
        made[at] = table[2 : lengths[at] + 2, row].astype(np.uint16)
    return made
