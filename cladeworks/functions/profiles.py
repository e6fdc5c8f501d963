"""Alignment of two profiles, and guide trees from words.

A profile is a matrix (columns x letters) of how many of its rows have a letter there, with the number of rows and a mark a column: 0 as usual, 1 for
a column that the last step left without a partner, 2 for one that it left so twice. Columns of mark 1 are passed over at no
cost, and ones of mark 2 are never given a partner: an insertion is not aligned again and not paid for again.
"""

from __future__ import annotations

import math

import numpy as np

from .local import NUCLEOTIDE, PROTEIN, Scoring

#: Scores of letters as they count in profiles: of equal and unequal bases, and of amino acids; costs of opening a gap and of each column in it.
BASES = np.where(np.eye(4) > 0, 2.0, -1.0)
OPENING, EXTENDING = 4.0, 0.6
#: Cells of a table whose moves are held at once.
HELD = 1 << 25
#: Of tables that are made together: cells of a row of all of them, and such as are there for a wider one's sake, at most; rows whose scores are made at once.
ROW, IDLE, BLOCK = 1 << 13, 3000, 8


def letters(protein: bool) -> Scoring:
    return PROTEIN if protein else NUCLEOTIDE


def one_row(text: str, protein: bool) -> np.ndarray:
    """The profile of one sequence: letters that aren't known count for none."""
    codes = letters(protein).codes(text)
    return np.vstack([np.eye(len(letters(protein).letters)), np.zeros(len(letters(protein).letters))])[np.minimum(codes, len(letters(protein).letters))]


def align_profiles(a: np.ndarray, b: np.ndarray, rows_a: int, rows_b: int, marks_a: np.ndarray | None = None, marks_b: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(places of a's columns, places of b's columns, width) in the best global alignment of two profiles under affine gaps.

    A column costs as much to pass over as it is filled. Every ``step``-th row of the table is kept and those between are made again on the way
    back, so memory grows with the length to the power of 1.5; a table of up to HELD cells is made once.
    """
    n, m = len(a), len(b)
    scores = PROTEIN.matrix[:20, :20].astype(float) / 2 if a.shape[1] == 20 else BASES
    right = (scores @ (b / rows_b).T)
    left = a / rows_a
    marks_a = np.zeros(n, np.int8) if marks_a is None else marks_a
    marks_b = np.zeros(m, np.int8) if marks_b is None else marks_b
    full_a, full_b = np.where(marks_a > 0, 0, left.sum(1)), np.where(marks_b > 0, 0, (b / rows_b).sum(1))
    open_a, more_a = OPENING * full_a, EXTENDING * full_a
    open_b = OPENING * full_b
    along = np.concatenate([[0], np.cumsum(EXTENDING * full_b)])
    closed_b = np.where(marks_b == 2, 1e9, 0.0)
    step = max(math.isqrt(n) + 1, HELD // (m + 1))
    never = -1e9

    def across(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What a row becomes by passing over columns of b, and how it does: 3 where that is better, 8 where more than one column is passed."""
        e = np.full(m + 1, never)
        opened = h[:-1] + along[:-1] - open_b
        e[1:] = np.maximum.accumulate(opened)
        longer = np.zeros(m + 1, np.uint8)
        longer[1:] = (e[1:] > opened + 1e-9) * np.uint8(8)
        e[1:] -= along[1:]
        return np.maximum(h, e), np.where(e > h, np.uint8(3), np.uint8(0)) | longer

    def below(h: np.ndarray, f: np.ndarray, i: int, moves: bool):
        new_f = np.maximum(h - open_a[i], f) - more_a[i]
        d = np.full(m + 1, never)
        d[1:] = h[:-1] + left[i] @ right - closed_b
        if marks_a[i] == 2:
            d[:] = never
        top = np.maximum(d, new_f)
        new, flat = across(top)
        if not moves:
            return new, new_f, None
        # 1 both, 2 a column of a alone, 3 of b alone; 4: the gap before goes on; 8: that along b does
        return new, new_f, np.where(flat & 3, flat, np.where(d >= new_f, np.uint8(1), np.uint8(2)) | (flat & 8)) | ((f > h - open_a[i]).astype(np.uint8) << 2)

    start = np.full(m + 1, never)
    start[0] = 0
    h, _ = across(start)
    f = np.full(m + 1, never)
    kept = [(h, f)]
    for i in range((n - 1) // step * step):
        h, f, _ = below(h, f, i, False)
        if (i + 1) % step == 0:
            kept.append((h, f))
    i, j, pairs, passing = n, m, [], 0  # passing: 2 over a's columns, 3 over b's
    while i > 0:
        base = (i - 1) // step * step
        h, f = kept[base // step]
        block = []
        for k in range(base, i):
            h, f, own = below(h, f, k, True)
            block.append(own)
        while i > base:
            move = int(block[i - 1 - base][j])
            kind = passing or move & 3
            if kind == 3:
                j -= 1
                pairs.append((-1, j))
                passing = 3 if move & 8 else 0
                continue
            i -= 1
            if kind == 1:
                j -= 1
                pairs.append((i, j))
            else:
                pairs.append((i, -1))
                passing = 2 if move & 4 else 0
    pairs += [(-1, k) for k in range(j - 1, -1, -1)]
    pairs = np.array(pairs[::-1], np.int64).reshape(-1, 2)
    return np.flatnonzero(pairs[:, 0] >= 0), np.flatnonzero(pairs[:, 1] >= 0), len(pairs)


def align_many(jobs: list[tuple[np.ndarray, np.ndarray, int, int, np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """What :func:`align_profiles` gives for each of its arguments. Pairs of like lengths are made together, a row of all their tables a step, so what
    a step costs by itself is shared; a table of over HELD cells is made alone."""
    out: list = [None] * len(jobs)
    order = sorted(range(len(jobs)), key=lambda k: (int(4 * math.log(len(jobs[k][0]) + 1)), len(jobs[k][1])))
    at = 0
    while at < len(order):
        rows, width, idle, to = len(jobs[order[at]][0]), 0, 0, at
        while to < len(order):
            a, b = jobs[order[to]][:2]
            more, wider = max(rows, len(a)), max(width, len(b) + 1)
            idle += (to - at) * (wider - width)
            if to > at and (idle > IDLE or (to - at + 1) * wider > ROW or (to - at + 1) * wider * more > HELD):
                break
            rows, width, to = more, wider, to + 1
        own = sorted(order[at:to], key=lambda k: -len(jobs[k][0]))
        found = _together([jobs[k] for k in own]) if rows * width <= HELD else [align_profiles(*jobs[k]) for k in own]
        for k, x in zip(own, found, strict=True):
            out[k] = x
        at = to
    return out


def _together(jobs) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Pairs in order of their first profiles' lengths, the longest first: those whose rows are done leave, and columns beyond a narrower table's own change none of
    its own. Columns lie along the first axis and pairs along the last, so that all steps but one run over neighbours in memory."""
    p, rows, width = len(jobs), len(jobs[0][0]), max(len(b) for _, b, *_ in jobs) + 1
    scores = PROTEIN.matrix[:20, :20].astype(float) / 2 if jobs[0][0].shape[1] == 20 else BASES
    never = -1e9
    lefts, rights = [a / n for a, _, n, *_ in jobs], [scores @ (b / n).T for _, b, _, n, *_ in jobs]
    open_a, more_a, apart = np.zeros((rows, p)), np.zeros((rows, p)), np.zeros((rows, p), bool)
    open_b, along, closed_b = np.zeros((width - 1, p)), np.zeros((width, p)), np.zeros((width - 1, p))
    for k, (a, b, _, n, ma, mb) in enumerate(jobs):
        full_a, full_b = np.where(ma > 0, 0, lefts[k].sum(1)), np.where(mb > 0, 0, (b / n).sum(1))
        open_a[: len(a), k], more_a[: len(a), k] = OPENING * full_a, EXTENDING * full_a
        open_b[: len(b), k] = OPENING * full_b
        along[1 : len(b) + 1, k] = np.cumsum(EXTENDING * full_b)
        apart[: len(a), k] = ma == 2
        closed_b[: len(b), k] = np.where(mb == 2, 1e9, 0.0)
    closed, any_apart = bool(closed_b.any()), apart.any(1)
    lengths = np.array([len(a) for a, *_ in jobs])
    h, f, d, e = (np.full((width, p), never) for _ in range(4))
    h[0] = 0
    e[1:] = np.maximum.accumulate(h[:-1] + along[:-1] - open_b, axis=0) - along[1:]
    h = np.maximum(h, e)
    held, shapes, on = [], [], 0
    for i in range(rows):
        if i % BLOCK == 0:
            left = int((lengths > i).sum())
            if left < on or not on:
                on = left
                h, f, d, e, open_b, along, closed_b = (np.ascontiguousarray(x[:, :on]) for x in (h, f, d, e, open_b, along, closed_b))
                block = np.zeros((BLOCK, width - 1, on))
                new_f, before, start, gain = np.empty((width, on)), np.empty((width, on)), np.empty((width - 1, on)), np.empty((width - 1, on))
            for k in range(on):
                own = lefts[k][i : i + BLOCK] @ rights[k]
                block[: len(own), : own.shape[1], k] = own
        np.subtract(h, open_a[i, :on], out=before)
        longer = f > before
        np.maximum(before, f, out=new_f)
        new_f -= more_a[i, :on]
        np.add(h[:-1], block[i % BLOCK], out=d[1:])
        if closed:
            d[1:] -= closed_b
        if any_apart[i]:
            d[:, apart[i, :on]] = never
        np.maximum(d, new_f, out=h)
        # the same moves as in align_profiles
        way = np.subtract(np.uint8(2), (d >= new_f).view(np.uint8))
        way |= longer.view(np.uint8) << 2
        # what passing over columns of b makes of it
        np.add(h[:-1], along[:-1], out=start)
        start -= open_b
        np.maximum.accumulate(start, axis=0, out=gain)
        start += 1e-9
        way[1:] |= (gain > start).view(np.uint8) << 3
        np.subtract(gain, along[1:], out=e[1:])
        way |= (e > h).view(np.uint8) * np.uint8(3)
        np.maximum(h, e, out=h)
        held.append(memoryview(way.reshape(-1)))
        shapes.append(on)
        f, new_f = new_f, f
    return [_way_back(held, shapes, k, len(a), len(b)) for k, (a, b, *_) in enumerate(jobs)]


def _way_back(moves: list[memoryview], shapes: list[int], k: int, n: int, m: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The places of the k-th pair's columns, from the rows of moves of all."""
    i, j, kinds, passing = n, m, bytearray(), 0  # kinds: 1 both, 2 a column of a alone, 3 of b alone
    while i > 0:
        move = moves[i - 1][j * shapes[i - 1] + k]
        kind = passing or move & 3
        kinds.append(kind)
        if kind == 3:
            j -= 1
            passing = 3 if move & 8 else 0
        else:
            i -= 1
            if kind == 1:
                j -= 1
            passing = 2 if kind == 2 and move & 4 else 0
    kinds += b"\x03" * j
    way = np.frombuffer(bytes(kinds), np.uint8)[::-1]
    return np.flatnonzero(way != 3), np.flatnonzero(way != 2), len(way)


def joined(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, width: int, marks_a: np.ndarray, marks_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The profile of both, and its marks: a column that has a partner is as usual, one without goes from 0 to 1 and from 1 to 2."""
    both, marks = np.zeros((width, a.shape[1])), np.zeros(width, np.int8)
    both[at_a] += a
    both[at_b] += b
    alone_a, alone_b = np.ones(width, bool), np.ones(width, bool)
    alone_a[at_b] = False
    alone_b[at_a] = False
    for at, own, alone in ((at_a, marks_a, alone_a), (at_b, marks_b, alone_b)):
        marks[at] = np.where(alone[at], np.minimum(own + 1, 2), marks[at])
    return both, marks


def word_sketch(text: str, k: int = 6, bins: int = 512) -> np.ndarray:
    """Counts of a sequence's words in bins."""
    x = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    code = np.zeros(max(len(x) - k + 1, 0), np.uint64)
    for i in range(k):
        code = code * np.uint64(0x9E3779B1) + x[i : i + len(code)]
    return np.bincount(((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % bins, minlength=bins).astype(np.float32)


def merge_order(sketches: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of numbers to merge, average linkage on shared words; the k-th pair makes number n + k. Of equal distances the first pair."""
    n = len(sketches)
    size = np.maximum(sketches.sum(1), 1)
    near = np.zeros((n, n))
    for i in range(n):
        near[i] = np.minimum(sketches[i], sketches).sum(1) / np.minimum(size[i], size)
    np.fill_diagonal(near, -np.inf)
    numbers, counts, out = list(range(n)), np.ones(n), []
    for k in range(n - 1):
        i, j = sorted(divmod(int(near.argmax()), n))
        out.append((numbers[i], numbers[j]))
        merged = (near[i] * counts[i] + near[j] * counts[j]) / (counts[i] + counts[j])
        merged[[i, j]] = -np.inf
        near[i], near[:, i] = merged, merged
        near[j], near[:, j] = -np.inf, -np.inf
        counts[i] += counts[j]
        numbers[i] = n + k
    return out
