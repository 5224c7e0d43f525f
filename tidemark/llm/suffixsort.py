"""Suffix comparison by prefix hashes, and the repeats within groups of pieces of text.

A piece is some bytes with an anchor in them; pieces of one group carry the
same bytes from the anchor on (at least those that made it an anchor).  The
suffixes at the anchors are sorted by mergesort, and so are the reversed
prefixes before them.  Two suffixes are compared by the length of their common
extension, which a binary search over polynomial prefix hashes finds in
logarithmic time.  Whatever the hashes say is checked on the bytes: a sort that
they got wrong is repeated on the bytes themselves.

All merges of a level, over all groups, are numpy operations.
"""

from __future__ import annotations

from functools import cmp_to_key

import numpy as np

from tidemark.llm.textblocks import BYTE_VALUE, powers


#: Bytes hashed or compared at once.
PART = 1 << 19


class Pieces:
    """Pieces laid out in one buffer, ordered by group, with their prefix hashes."""

    def __init__(self, pieces: list[bytes], anchors: np.ndarray, groups: np.ndarray):
        self.sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.anchors = np.asarray(anchors, dtype=np.int64)
        self.groups = np.asarray(groups, dtype=np.int64)
        self.at = self.starts + self.anchors
        self.after = self.sizes - self.anchors
        # Written part by part: only the prefix hashes and the powers at the anchors are kept.
        self.prefix = np.zeros(len(self.data) + 1, dtype=np.uint64)
        self.power = np.zeros(len(self.at), dtype=np.uint64)
        table = powers(min(PART, len(self.data)) + 1)
        scale, by_place = np.ones(1, dtype=np.uint64), np.argsort(self.at, kind="stable")
        for low in range(0, max(1, len(self.data)), PART):
            part = self.data[low : low + PART]
            values = np.cumsum(BYTE_VALUE[part] * (table[: len(part)] * scale)) + self.prefix[low]
            self.prefix[low + 1 : low + 1 + len(part)] = values
            first, last = np.searchsorted(self.at[by_place], (low, low + PART))
            who = by_place[first:last]
            self.power[who] = table[self.at[who] - low] * scale
            scale = scale * table[-1:] if len(part) == PART else scale  # wraps around, as meant

    def common(self, x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
        """Length of the common extension of pieces x and y from their anchors, to either side, by binary search."""
        px, py = self.at[x], self.at[y]
        room = self.after if forward else self.anchors
        low, high = np.zeros(len(x), dtype=np.int64), np.minimum(room[x], room[y])
        wx, wy = self.power[x], self.power[y]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            mid = (low[open_] + high[open_] + 1) >> 1
            a, b = px[open_], py[open_]
            if forward:
                left, right = self.prefix[a + mid] - self.prefix[a], self.prefix[b + mid] - self.prefix[b]
            else:
                left, right = self.prefix[a] - self.prefix[a - mid], self.prefix[b] - self.prefix[b - mid]
            same = left * wy[open_] == right * wx[open_]
            low[open_[same]] = mid[same]
            high[open_[~same]] = mid[~same] - 1

    def next_byte(self, x: np.ndarray, length: np.ndarray, forward: bool) -> np.ndarray:
        """The byte after (or before) the extension; -1 at the end of the piece."""
        inside = length < (self.after if forward else self.anchors)[x]
        where = self.at[x] + length if forward else self.at[x] - length - 1
        return np.where(inside, self.data[np.where(inside, where, 0)].astype(np.int64), -1)

    def equal_bytes(self, x: np.ndarray, y: np.ndarray, length: np.ndarray, forward: bool) -> np.ndarray:
        """Whether the extensions of that length really are the same bytes."""
        total = int(length.sum())
        if not total:
            return np.ones(len(x), dtype=bool)
        if total > 2 * PART and len(x) > 1:
            half = len(x) // 2
            parts = (slice(None, half), slice(half, None))
            return np.concatenate([self.equal_bytes(x[p], y[p], length[p], forward) for p in parts])
        first = np.cumsum(length) - length
        within = np.arange(total) - np.repeat(first, length)
        back = np.zeros_like(length) if forward else length
        differs = self.data[np.repeat(self.at[x] - back, length) + within] != self.data[np.repeat(self.at[y] - back, length) + within]
        wrong = np.concatenate([[0], np.cumsum(differs)])
        return wrong[first + length] == wrong[first]

    def order(self, forward: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pieces sorted by extension within their groups, and the common length of each with its predecessor (0 for a group's first)."""
        n = len(self.sizes)
        segment_start = np.searchsorted(self.groups, self.groups, side="left")
        segment_end = np.searchsorted(self.groups, self.groups, side="right")
        here = np.arange(n)
        local = here - segment_start
        order = here.copy()
        width, longest = 1, int((segment_end - segment_start).max()) if n else 0
        while width < longest:
            run = local // width
            other = segment_start + (run ^ 1) * width
            stop = np.minimum(other + width, segment_end)
            low, high = np.zeros(n, dtype=np.int64), np.maximum(stop - other, 0)
            first = run % 2 == 0
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                mine, theirs = order[open_], order[other[open_] + mid]
                length = self.common(mine, theirs, forward)
                a, b = self.next_byte(mine, length, forward), self.next_byte(theirs, length, forward)
                before = (b < a) | ((b == a) & ~first[open_])  # equal ones keep the order of the runs
                low[open_[before]] = mid[before] + 1
                high[open_[~before]] = mid[~before]
            place = segment_start + (run & ~1) * width + (local - run * width) + low
            merged = np.empty_like(order)
            merged[place] = order
            order = merged
            width *= 2
        shared = np.zeros(n, dtype=np.int64)
        follows = np.flatnonzero(local > 0)
        x, y = order[follows - 1], order[follows]
        shared[follows] = self.common(x, y, forward)
        length = shared[follows]
        right = self.equal_bytes(x, y, length, forward)
        a, b = self.next_byte(x, length, forward), self.next_byte(y, length, forward)
        right &= (a < b) | ((a == b) & (a == -1))
        return (order, shared) if right.all() else self._order_by_bytes(forward)

    def _extension(self, i: int, forward: bool) -> bytes:
        a, z = self.starts[i], self.starts[i] + self.sizes[i]
        return self.data[self.at[i] : z].tobytes() if forward else self.data[a : self.at[i]][::-1].tobytes()

    def _order_by_bytes(self, forward: bool) -> tuple[np.ndarray, np.ndarray]:
        """The same without hashes, for the case that they collided."""
        ext = [self._extension(i, forward) for i in range(len(self.sizes))]
        less = lambda i, j: (ext[i] > ext[j]) - (ext[i] < ext[j])
        by_group = sorted(range(len(ext)), key=lambda i: self.groups[i])
        order, shared, at = [], [], 0
        while at < len(by_group):
            end = at
            while end < len(by_group) and self.groups[by_group[end]] == self.groups[by_group[at]]:
                end += 1
            part = sorted(by_group[at:end], key=cmp_to_key(less))
            order += part
            shared += [0] + [_common_bytes(ext[i], ext[j]) for i, j in zip(part, part[1:], strict=False)]
            at = end
        return np.array(order), np.array(shared)


def _common_bytes(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x, y = np.frombuffer(a[:n], np.uint8), np.frombuffer(b[:n], np.uint8)
    differs = np.flatnonzero(x != y)
    return int(differs[0]) if len(differs) else n


def _largest(order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """By piece: the longest extension shared with any other piece of its group (a neighbour in the order has it)."""
    out = np.zeros(len(order), dtype=np.int64)
    out[order] = np.maximum(shared, np.append(shared[1:], 0))
    return out


def repeated_windows(pieces: Pieces, length: int, wanted: np.ndarray, rank: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """``(piece, low, high)``: the windows of ``length`` bytes that begin ``low`` to ``high`` bytes before the anchor occur in another piece.

    With ``rank``, in another piece of smaller rank: all occurrences but the first.

    A window that begins j bytes before the anchor occurs in another piece if
    both share j bytes before it and ``length - j`` from it on.  From its place
    in the sorted suffixes each wanted piece looks at neighbours further and
    further away, as long as a window is open that the common extension with
    them could still cover.
    """
    order, shared = pieces.order(True)
    back_order, back_shared = pieces.order(False)
    most_back = _largest(back_order, back_shared)
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    top = np.minimum(pieces.anchors, most_back)
    bottom = np.maximum(pieces.anchors - (pieces.sizes - length), 0)
    width = int(pieces.anchors.max(initial=0)) + 1
    rows = np.flatnonzero(wanted)
    line = np.full(len(order), -1)
    line[rows] = np.arange(len(rows))
    covered = np.zeros((len(rows), width), dtype=bool)
    before = np.arange(width)
    for step in (-1, 1):
        who, at = rows, place[rows]
        run = np.full(len(rows), np.iinfo(np.int64).max)
        while len(who):
            edge = at if step < 0 else at + 1  # shared[e] belongs to the pair (e - 1, e)
            inside = (edge > 0) & (edge < len(order)) if step > 0 else edge > 0
            who, at, run, edge = who[inside], at[inside], run[inside], edge[inside]
            run = np.minimum(run, shared[edge])
            at = at + step
            low = np.maximum(bottom[who], length - run)
            open_ = low <= top[who]
            who, at, run, low = who[open_], at[open_], run[open_], low[open_]
            spans = (before >= low[:, None]) & (before <= top[who][:, None])
            open_ = (spans & ~covered[line[who]]).any(axis=1)
            who, at, run, low = who[open_], at[open_], run[open_], low[open_]
            if not len(who):
                break
            other = order[at]
            back = pieces.common(who, other, False)
            wrong = np.flatnonzero(~pieces.equal_bytes(who, other, back, False))
            for i in wrong:  # a collision: count on the bytes
                back[i] = _common_bytes(pieces._extension(who[i], False), pieces._extension(other[i], False))
            high = np.minimum(back, top[who])
            if rank is not None:
                high = np.where(rank[other] < rank[who], high, -1)
            covered[line[who]] |= (before >= low[:, None]) & (before <= high[:, None])
    return _runs(covered, rows)


def _runs(covered: np.ndarray, rows: np.ndarray) -> list[tuple[int, int, int]]:
    padded = np.zeros((covered.shape[0], covered.shape[1] + 2), dtype=np.int8)
    padded[:, 1:-1] = covered
    change = np.diff(padded, axis=1)
    r, a = np.nonzero(change == 1)
    _, b = np.nonzero(change == -1)
    return list(zip(rows[r].tolist(), a.tolist(), (b - 1).tolist(), strict=True))
