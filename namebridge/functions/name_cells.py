"""The leading register names of each client name in a cell of a block, all pairs of the cell at a time.

A cell is a list of client names that meet a list of register names. Edit distances and longest common subsequences of
all its pairs come from bit-parallel columns in numpy: a client name is a row of machine words, and each step takes one
character of every register name. Edit distances are exact; the subsequence bounds the matching-blocks ratio, which is
then computed only for pairs that can still be among the leading ones.

Scores here only decide which pairs leave the cell: every pair that may be among the ``depth`` best of a client profile,
or reach a floor, does, ties and roundings included. The caller scores and ranks what is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from namebridge.functions.matching_blocks import ratios

_ONE, _TOP = np.uint64(1), np.uint64(63)
#: Rounding to four places moves a score by half a unit at most; a tie of two rounded scores spans one.
SLACK = 2e-4
#: Pairs of one table; its words stay in the cache.
_PAIRS = 1 << 14


def _codes(names: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the names, a row each, padded with zeros, and their lengths."""
    lengths = np.fromiter(map(len, names), np.int64, len(names))
    points = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.zeros((len(names), size), np.uint32)
    codes[np.arange(size) < lengths[:, None]] = points
    return codes, lengths


class _Patterns:
    """Client names as bit masks: for each known character and word, the places that hold it."""

    def __init__(self, names: list[str]):
        codes, self.lengths = _codes(names, max(map(len, names)))
        inside = np.arange(codes.shape[1]) < self.lengths[:, None]
        self.alphabet = np.unique(codes[inside])
        self.words = max(1, -(-codes.shape[1] // 64))
        self.masks = np.zeros((self.words, len(self.alphabet) + 1, len(names)), np.uint64)
        row, place = np.nonzero(inside)
        letter = np.searchsorted(self.alphabet, codes[inside])
        np.bitwise_or.at(self.masks, (place >> 6, letter, row), _ONE << (place & 63).astype(np.uint64))
        # Bits of the words that belong to the name.
        used = np.clip(self.lengths - 64 * np.arange(self.words)[:, None], 0, 64)
        self.used = np.where(used == 64, ~np.uint64(0), (_ONE << (used % 64).astype(np.uint64)) - _ONE)

    def letters(self, codes: np.ndarray) -> np.ndarray:
        """Index of each character in the alphabet; the last row of masks, which is empty, for others."""
        at = np.searchsorted(self.alphabet, codes)
        known = self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == codes if len(self.alphabet) else codes < 0
        return np.where(known, at, len(self.alphabet))


def _edits(patterns: _Patterns, letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Edit distances, register names (longest first) by client names."""
    shape = (patterns.words, len(lengths), len(patterns.lengths))
    up, down = np.full(shape, ~np.uint64(0)), np.zeros(shape, np.uint64)
    active = np.searchsorted(-lengths, -np.arange(letters.shape[1]), "left")
    work = [np.empty(shape[1:], np.uint64) for _ in range(5)]
    for step in range(letters.shape[1]):
        n = active[step]
        eq, xv, xh, ph, mh = (w[:n] for w in work)
        plus: np.ndarray | np.uint64 = _ONE
        minus: np.ndarray | None = None
        for word in range(patterns.words):
            pv, mv = up[word, :n], down[word, :n]
            np.take(patterns.masks[word], letters[:n, step], axis=0, out=eq, mode="clip")
            np.bitwise_or(eq, mv, out=xv)
            if minus is not None:
                np.bitwise_or(eq, minus, out=eq)
            np.bitwise_and(eq, pv, out=xh)
            np.add(xh, pv, out=xh)
            np.bitwise_xor(xh, pv, out=xh)
            np.bitwise_or(xh, eq, out=xh)
            np.bitwise_or(xh, pv, out=ph)
            np.invert(ph, out=ph)
            np.bitwise_or(ph, mv, out=ph)
            np.bitwise_and(pv, xh, out=mh)
            last = word + 1 == patterns.words
            after = None if last else (ph >> _TOP, mh >> _TOP)
            np.left_shift(ph, _ONE, out=ph)
            np.bitwise_or(ph, plus, out=ph)
            np.left_shift(mh, _ONE, out=mh)
            if minus is not None:
                np.bitwise_or(mh, minus, out=mh)
            np.bitwise_or(xv, ph, out=pv)
            np.invert(pv, out=pv)
            np.bitwise_or(pv, mh, out=pv)
            np.bitwise_and(ph, xv, out=mv)
            if after is not None:
                plus, minus = after
    total = np.repeat(lengths[:, None], shape[2], axis=1)
    for word in range(patterns.words):
        total += np.bitwise_count(up[word] & patterns.used[word]).astype(np.int64)
        total -= np.bitwise_count(down[word] & patterns.used[word])
    return total


def _subsequences(patterns: _Patterns, letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences, register names (longest first) by client names."""
    shape = (patterns.words, len(lengths), len(patterns.lengths))
    open_ = np.full(shape, ~np.uint64(0))
    active = np.searchsorted(-lengths, -np.arange(letters.shape[1]), "left")
    work = [np.empty(shape[1:], np.uint64) for _ in range(2)]
    for step in range(letters.shape[1]):
        n = active[step]
        eq, both = (w[:n] for w in work)
        carry = None
        for word in range(patterns.words):
            v = open_[word, :n]
            np.take(patterns.masks[word], letters[:n, step], axis=0, out=eq, mode="clip")
            np.bitwise_and(v, eq, out=both)
            np.bitwise_xor(v, both, out=eq)
            if word + 1 < patterns.words or carry is not None:
                before = v.copy()
                np.add(v, both, out=v)
                over = v < before
                if carry is not None:
                    np.add(v, carry, out=v)
                    over |= v < carry
                carry = over.astype(np.uint64)
            else:
                np.add(v, both, out=v)
            np.bitwise_or(v, eq, out=v)
    total = np.zeros(shape[1:], np.int64)
    for word in range(patterns.words):
        total += np.bitwise_count(~open_[word] & patterns.used[word])
    return total


def _tables(clients: list[str], candidates: list[str], kernel) -> np.ndarray:
    """``kernel`` for all pairs, client names by register names; names of similar length share a table."""
    result = np.zeros((len(clients), len(candidates)), np.int64)
    by_words: dict[int, list[int]] = {}
    for i, name in enumerate(clients):
        by_words.setdefault(-(-len(name) // 64), []).append(i)
    order = np.argsort([-len(c) for c in candidates], kind="stable")
    for words, rows in by_words.items():
        if not words:
            continue
        patterns = _Patterns([clients[i] for i in rows])
        rows_, per_table = np.array(rows), max(1, _PAIRS // (len(rows) * words))
        for start in range(0, len(order), per_table):
            part = order[start:start + per_table]
            names = [candidates[j] for j in part]
            size = len(names[0])
            if not size:
                continue
            codes, lengths = _codes(names, size)
            result[np.ix_(rows_, part)] = kernel(patterns, patterns.letters(codes), lengths).T
    return result


def edit_distances(clients: list[str], candidates: list[str]) -> np.ndarray:
    """Edit distance of every client name and register name."""
    result = _tables(clients, candidates, _edits)
    # Pairs with an empty name are in no table.
    a, b = (np.array([len(x) for x in names], np.int64) for names in (clients, candidates))
    empty = (a[:, None] == 0) | (b == 0)
    return np.where(empty, np.maximum(a[:, None], b), result)


def common_subsequences(clients: list[str], candidates: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of every client name and register name."""
    return _tables(clients, candidates, _subsequences)


# --- scores of a cell -----------------------------------------------------------------------------


def _incidence(words: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows by vocabulary, number of words) of a list array of distinct words."""
    sizes = pc.fill_null(words.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = pc.fill_null(pc.index_in(words.flatten(), value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    table = np.zeros((len(sizes), len(vocabulary)), np.float32)
    table[row[at >= 0], at[at >= 0]] = 1
    return table, sizes


def _overlap(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Jaccard overlap of all pairs of word lists, 0 without words, and the sizes of both."""
    vocabulary = left.flatten().unique()
    (a, n), (b, m) = _incidence(left, vocabulary), _incidence(right, vocabulary)
    shared = (a @ b.T).astype(np.float64)
    return shared / np.maximum(n[:, None] + m - shared, 1), n, m


class _Side:
    """The names of one side of a cell with their profiles; fields as ``named_profiles`` and its callers order them."""

    def __init__(self, rows: pa.StructArray):
        self.rows = rows
        self.name, profiles, self.tokens = rows.flatten()
        self.names = self.name.to_pylist()
        sizes = profiles.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.owner = np.repeat(np.arange(len(rows)), sizes)
        self.country, self.address, self.address_tokens = profiles.flatten().flatten()[:3]


class Scores:
    """How a pair is scored: the weights and limits of the caller."""

    def __init__(self, name: float, token: float, country: float, address: float, bonus: float, cap: float,
                 not_given: float, missing: float, address_not_given: float, levenshtein: bool, heuristic: bool):
        self.name, self.token, self.country, self.address = name, token, country, address
        self.bonus, self.cap, self.not_given, self.missing = bonus, cap, not_given, missing
        self.address_not_given, self.levenshtein, self.heuristic = address_not_given, levenshtein, heuristic

    def fields(self, left: _Side, right: _Side) -> np.ndarray:
        """All but the name similarity, profiles by profiles."""
        tokens = _overlap(left.tokens, right.tokens)[0]
        both = pa.concat_arrays([left.country, right.country]).dictionary_encode()
        code = both.indices.to_numpy(zero_copy_only=False)
        a, b = code[:len(left.country)], code[len(left.country):]
        given_a, given_b = (pc.not_equal(x, "").to_numpy(zero_copy_only=False) for x in (left.country, right.country))
        same = (a[:, None] == b) & given_a[:, None]
        country = np.where(~given_a[:, None], self.not_given, np.where(~given_b, self.missing, same))
        total = self.token * tokens[np.ix_(left.owner, right.owner)] + self.country * country + self.bonus * same
        gave = pc.not_equal(left.address, "").to_numpy(zero_copy_only=False)
        total[~gave] += self.address * self.address_not_given
        if gave.any():
            overlap, n, m = _overlap(left.address_tokens.filter(pa.array(gave)), right.address_tokens)
            total[gave] += self.address * np.where((n[:, None] > 0) & (m > 0), overlap, self.missing)
        return total

    def similarity(self, clients: list[str], candidates: list[str]) -> np.ndarray:
        """Name similarity of all pairs, or for the matching-blocks ratio an upper bound of it."""
        a, b = (np.array([len(x) for x in names], np.float64) for names in (clients, candidates))
        if self.levenshtein:
            value = 1.0 - edit_distances(clients, candidates) / np.maximum(np.maximum(a[:, None], b), 1)
        else:
            value = 2.0 * common_subsequences(clients, candidates) / np.maximum(a[:, None] + b, 1)
        return np.where((a[:, None] > 0) & (b > 0), value, 0.0)

    def by_length(self, clients: list[str], candidates: list[str]) -> np.ndarray:
        """The similarity that two names of such lengths can have at most."""
        a, b = (np.array([len(x) for x in names], np.float64) for names in (clients, candidates))
        low, high = np.minimum(a[:, None], b), np.maximum(a[:, None], b)
        return low / np.maximum(high, 1) if self.levenshtein else 2.0 * low / np.maximum(low + high, 1)


def _kth(scores: np.ndarray, depth: int) -> np.ndarray:
    """The ``depth`` largest of each row, the least first, filled up with -1."""
    if scores.shape[1] < depth:
        scores = np.pad(scores, ((0, 0), (0, depth - scores.shape[1])), constant_values=-1.0)
    return -np.partition(-scores, depth - 1, axis=1)[:, :depth]


def _leading(left: _Side, right: _Side, paired: np.ndarray, scores: Scores, depth: int, floor: float,
             seen: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(client row, register row, similarity) of the pairs that may lead, and the best scores of each client profile.

    ``seen`` holds the best scores of the cells before; no pair below ``floor`` is wanted. With depth 0 only the floor
    decides.
    """
    if seen is None:
        seen = np.full((len(left.owner), depth), -1.0)
    best, pairs = seen, paired[np.ix_(left.owner, right.owner)]
    fields = scores.fields(left, right)
    similarity, found = np.zeros(paired.shape), np.zeros(paired.shape, bool)
    by_length = scores.by_length(left.names, right.names)

    def limit() -> np.ndarray:
        least = best.min(axis=1, initial=2.0) if depth else np.full(len(best), -1.0)
        return np.maximum(np.maximum(least, floor)[:, None] - SLACK, 0.0)

    def total(similarity: np.ndarray, columns: np.ndarray) -> np.ndarray:
        value = scores.name * similarity[np.ix_(left.owner, right.owner[columns])] + fields[:, columns]
        return np.where(pairs[:, columns], np.minimum(value, scores.cap), -1.0)

    def of_names(wanted: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Pairs of names of which a pair of profiles is wanted."""
        names = np.zeros(paired.shape, bool)
        row, column = np.nonzero(wanted)
        names[left.owner[row], right.owner[columns[column]]] = True
        return names

    def best_with(value: np.ndarray) -> np.ndarray:
        return _kth(np.concatenate([best, value], axis=1), depth) if depth else best

    def exact(wanted: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Scores with the matching-blocks ratio, -1 where that is not wanted."""
        i, j = np.nonzero(of_names(wanted, columns) & ~found)
        if len(i):
            similarity[i, j] = ratios([left.names[x] for x in i], [right.names[x] for x in j], scores.heuristic)
            found[i, j] = True
        return np.where(found[np.ix_(left.owner, right.owner[columns])], total(similarity, columns), -1.0)

    kept = np.zeros(paired.shape, bool)
    for columns in _by_length(left, right):
        columns = columns[(total(by_length, columns) >= limit()).any(axis=0)]
        if not len(columns):
            continue
        used = np.unique(right.owner[columns])
        similarity[:, used] = scores.similarity(left.names, [right.names[j] for j in used])
        value = total(similarity, columns)
        if not scores.levenshtein:
            bound, before, lowest = value, best, limit()
            if depth:
                # The pairs of the largest bounds first: their ratios tell which others can still lead.
                first = (bound >= _kth(bound, depth).min(axis=1)[:, None]) & (bound >= lowest)
                best = best_with(exact(first, columns))
                lowest, best = limit(), before
            value = exact(bound >= lowest, columns)
        best = best_with(value)
        kept |= of_names(value >= limit(), columns)
    i, j = np.nonzero(kept)
    return i, j, similarity[i, j], best


def _by_length(left: _Side, right: _Side) -> Iterator[np.ndarray]:
    """Register profiles in groups of similar lengths, those of lengths like the clients' first.

    What they leave open is little for a name of many times that length, which would take as many steps.
    """
    step = np.array([len(x) for x in right.names]) // (2 * max(map(len, left.names)) + 1)
    group = np.frexp(step)[1][right.owner]
    for number in np.unique(group):
        yield np.flatnonzero(group == number)


def leading_pairs(scores: Scores, depth: int, floor: float, prefix_length: int, schema: pa.Schema):
    """A function for ``mapInArrow`` over (key, client list, clients, candidates), each side as ``_Side`` reads it.

    Cells of a key follow each other in a task, so the best scores of a client list are kept from cell to cell.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seen = None, {}
        for batch in batches:
            for at in range(batch.num_rows):
                block, number, clients, candidates = (batch.column(c)[at] for c in range(4))
                if block.as_py() != key:
                    key, seen = block.as_py(), {}
                left, right = _Side(clients.values), _Side(candidates.values)
                paired = np.ones((len(left.names), len(right.names)), bool)
                if not key.startswith("p:"):
                    # Such pairs meet by their prefix.
                    heads = [np.array([x[:prefix_length] for x in side.names], object) for side in (left, right)]
                    paired = heads[0][:, None] != heads[1]
                    if not paired.any():
                        continue
                i, j, similarity, best = _leading(
                    left, right, paired, scores, depth, floor, seen.get(number.as_py()))
                seen[number.as_py()] = best
                if len(i):
                    columns = [*left.rows.take(pa.array(i)).flatten(), *right.rows.take(pa.array(j)).flatten()]
                    yield pa.RecordBatch.from_arrays([
                        column.cast(field.type)
                        for column, field in zip([*columns, pa.array(similarity)], schema, strict=True)
                    ], schema=schema)

    return run
