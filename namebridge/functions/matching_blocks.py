"""Matching-blocks ratio of many pairs of strings at a time.

The ratio counts the characters of the longest common block of two strings and, recursively, of
what lies left and right of it. Here all pairs of an Arrow batch take that step together: one
numpy table per group of similar length holds the common suffix lengths, and the pieces left and
right of every block found form the next round.

Results equal ``difflib.SequenceMatcher(None, left, right, autojunk=False).ratio()`` for strings of any
length. On request the popularity heuristic of difflib applies (from 200 characters on the right); those
pairs then go to difflib itself.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np

_HEURISTIC_LENGTH = 200
_TABLE_CELLS = 1 << 17
# Padding that equals neither a character (shifted by two) nor the other side's padding.
_LEFT_PAD, _RIGHT_PAD = 0, 1


class _Strings:
    """Code points of all strings in one array."""

    def __init__(self, strings: list[str]):
        self.lengths = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        text = "".join(strings)
        if text.isascii():
            self.codes = np.frombuffer(text.encode("ascii"), dtype=np.uint8) + np.uint8(2)
        else:
            self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) + np.uint32(2)

    def table(self, low: np.ndarray, high: np.ndarray, pad: int) -> np.ndarray:
        """Characters of the pieces, one piece per column."""
        positions = low + np.arange((high - low).max())[:, None]
        inside = positions < high
        return np.where(inside, self.codes[np.where(inside, positions, 0)], self.codes.dtype.type(pad))


def _longest_blocks(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and both offsets of the longest common block of each column pair, the earliest if several."""
    height, columns = right.shape
    counter = np.uint8 if min(len(left), height) < 255 else np.int32
    size = np.zeros(columns, counter)
    left_end, right_end = np.zeros(columns, np.int64), np.zeros(columns, np.int64)
    before, suffix = np.zeros((height + 1, columns), counter), np.zeros((height + 1, columns), counter)
    for row, characters in enumerate(left):
        np.add(before[:-1], counter(1), out=suffix[1:])
        suffix[1:] *= right == characters
        longest = suffix.max(axis=0)
        (better,) = np.nonzero(longest > size)
        if better.size:
            size[better] = longest[better]
            left_end[better] = row + 1
            right_end[better] = (suffix[:, better] == longest[better]).argmax(axis=0)
        before, suffix = suffix, before
    wide = size.astype(np.int64)
    return wide, left_end - wide, right_end - wide


def _groups(left_lengths: np.ndarray, right_lengths: np.ndarray):
    """Index groups of pieces of similar lengths, each small enough for one table."""
    order = np.lexsort((left_lengths, right_lengths))
    start = 0
    while start < len(order):
        stop = min(len(order), start + max(1, _TABLE_CELLS // int(right_lengths[order[start]] + 1)))
        # The last piece is the longest on the right: shrink until the table fits.
        while stop - start > 1 and (stop - start) * int(right_lengths[order[stop - 1]] + 1) > 2 * _TABLE_CELLS:
            stop = start + (stop - start) // 2
        yield order[start:stop]
        start = stop


def _matching_characters(left: _Strings, right: _Strings) -> np.ndarray:
    matched = np.zeros(len(left.lengths), np.int64)
    pair = np.arange(len(matched))
    pieces = (pair, left.starts, left.ends, right.starts, right.ends)
    while True:
        pair, left_low, left_high, right_low, right_high = pieces
        left_lengths, right_lengths = left_high - left_low, right_high - right_low
        alive = (left_lengths > 0) & (right_lengths > 0)
        if not alive.any():
            return matched
        pair, left_low, left_high, right_low, right_high = (part[alive] for part in pieces)
        following = []
        for group in _groups(left_lengths[alive], right_lengths[alive]):
            lows, highs = (left_low[group], right_low[group]), (left_high[group], right_high[group])
            size, left_at, right_at = _longest_blocks(
                left.table(lows[0], highs[0], _LEFT_PAD), right.table(lows[1], highs[1], _RIGHT_PAD)
            )
            np.add.at(matched, pair[group], size)
            found = size > 0
            owner, size = pair[group][found], size[found]
            left_at, right_at = (lows[0] + left_at)[found], (lows[1] + right_at)[found]
            following.append((owner, lows[0][found], left_at, lows[1][found], right_at))
            following.append((owner, left_at + size, highs[0][found], right_at + size, highs[1][found]))
        pieces = tuple(np.concatenate(parts) for parts in zip(*following, strict=True))


def ratios(left: list[str | None], right: list[str | None], popularity_heuristic: bool = False) -> np.ndarray:
    """Ratio per pair; 0 if either string is missing or empty."""
    result = np.zeros(len(left))
    rows: dict[tuple[str, str], list[int]] = {}
    for row, (a, b) in enumerate(zip(left, right, strict=True)):
        if a and b:
            rows.setdefault((a, b), []).append(row)
    by_heuristic = {pair for pair in rows if popularity_heuristic and len(pair[1]) >= _HEURISTIC_LENGTH}
    values = {pair: SequenceMatcher(None, *pair).ratio() for pair in by_heuristic}
    plain = [pair for pair in rows if pair not in by_heuristic]
    if plain:
        a, b = _Strings([p[0] for p in plain]), _Strings([p[1] for p in plain])
        if a.codes.dtype != b.codes.dtype:
            a.codes, b.codes = a.codes.astype(np.uint32), b.codes.astype(np.uint32)
        values.update(zip(plain, 2.0 * _matching_characters(a, b) / (a.lengths + b.lengths), strict=True))
    for pair, indices in rows.items():
        result[indices] = values[pair]
    return result
