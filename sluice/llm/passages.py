"""Repeated passages: MinHash bands over all windows of fifty words, confirmed on the words themselves.

A paragraph here is any run of fifty words, whatever lines it lies in, so a
passage is found inside other text too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import rows_of, saved, saved_at, shuffles_removed
from sluice.llm.components import components
from sluice.llm.shingles import SHINGLE_WORDS, mixed, shingle_hashes, word_hashes
from sluice.session import remove_dir

WINDOW = 50
PERCENT = 75
#: Bands of one minimum; two windows are compared if they agree in any of them.
BANDS = 3
SHINGLES = WINDOW - SHINGLE_WORDS + 1
#: Shingles around a key that windows with it can reach: all windows of these hold the key.
AROUND = 2 * SHINGLES - 1
#: Windows among these.
WINDOWS = AROUND - SHINGLES + 1
#: Of two windows of 46 different shingles each, so many are shared at the least similarity.
ENOUGH = -(-2 * SHINGLES * PERCENT // (100 + PERCENT))
#: Places of a key that meet in one comparison; more are cut into blocks, any two of which meet.
BLOCK = 8192
#: Meetings of more places are searched for what can be shared before any are compared; of yet more, place by place.
FEW, MANY = 8, 64
#: Places with recurring shingles in a meeting, above which its places are found by the rarest shingles of their windows.
LOOSE = 0
#: Windows whose shingles are sorted at a time, and pairs of places found so.
SORTED, FOUND = 1 << 14, 1 << 20
#: Pairs of places compared at a time, and those of them of which any two windows are.
PAIRS, CROSS = 4096, 128
#: Places of shingles around a key: every window about it holds the first seven or the last seven.
PROBES = np.r_[SHINGLES // 2 : SHINGLES - 4 : 3, SHINGLES + 3 : SHINGLES + 22 : 3]
#: Places read before the meetings among them are held.
TOGETHER = 10_000
_at = np.arange(AROUND)
_factors = np.random.default_rng(19).integers(1, 2**63, AROUND + 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_salts = np.random.default_rng(9).integers(1, 2**63, BANDS, dtype=np.uint64)
_LAST = (1 << 63) - 1


def _sliding(values: np.ndarray, width: int, best: np.ufunc, worst: int) -> np.ndarray:
    """The best of each run of ``width``, from running bests of blocks in either direction."""
    n = len(values)
    padded = np.full(-(-n // width) * width, worst, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - width + 1], ahead[width - 1 : n])


def _thinned(values: np.ndarray, doc: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """``chosen`` without places between two kept ones of the same value that no window fits between; texts stand in order."""
    order = chosen[np.lexsort((values[chosen], doc[chosen]))]
    same = (values[order[1:]] == values[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    keep = np.ones(len(order), bool)
    last, before = -1, -1
    for i in np.flatnonzero(same[1:] & same[:-1]) + 1:
        if i != before + 1:
            last = order[i - 1]
        elif keep[before]:
            last = order[before]
        if order[i + 1] - last <= SHINGLES:
            keep[i] = False
        before = i
    return np.sort(order[keep])


def keys_of(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The band keys of all windows of texts that follow one another, each once a text.

    With each key its text and the place of the shingle that is the minimum,
    in order of texts.  A shingle is the minimum of a window it lies in if the
    largest minimum among those windows is its own value.  Of a key that
    recurs, places are left out where every window with such a place holds one
    that is kept.
    """
    inner = np.flatnonzero(sizes >= WINDOW)
    if not len(inner):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
    # Runs of five words that lie in one text, as do the windows of these.
    if len(inner) < len(sizes):
        words = words[np.repeat(sizes >= WINDOW, sizes)]
    n = sizes[inner].astype(np.int64) - SHINGLE_WORDS + 1
    starts = np.cumsum(n + SHINGLE_WORDS - 1) - (n + SHINGLE_WORDS - 1)
    all_shingles = shingle_hashes(words)
    first = np.cumsum(n) - n
    doc = np.repeat(np.arange(len(inner)), n)
    shingles = all_shingles[np.arange(len(doc)) + (starts - first)[doc]]
    across = doc[: len(doc) - SHINGLES + 1] != doc[SHINGLES - 1 :]
    edge = np.zeros(SHINGLES - 1, np.uint64)
    keys, places = [], []
    for salt in _salts:
        values = mixed(shingles ^ salt)
        low = _sliding(values, SHINGLES, np.minimum, np.iinfo(np.uint64).max)
        low[across] = 0
        chosen = np.flatnonzero(_sliding(np.concatenate([edge, low, edge]), SHINGLES, np.maximum, 0) == values)
        chosen = _thinned(values, doc, chosen)
        keys.append(values[chosen])
        places.append(chosen)
    own = doc[np.concatenate(places)]
    order = np.argsort(own, kind="stable")
    own = own[order]
    return inner[own], np.concatenate(keys)[order].view(np.int64), (np.concatenate(places)[order] - first[own]).astype(np.int32)


def window_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The band keys of a text and their places, as by ``keys_of``."""
    return keys_of(words, np.array([len(words)]))[1:]


def _hashes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As ``word_hashes`` the words of all texts, one text after the other, and their numbers.

    Most words are seen once or twice, so remembering them costs more than it saves.
    """
    hashes = []
    for text in texts.cast(pa.binary()).to_pylist():
        words = (text or b"").lower().split()
        hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
    return np.concatenate(hashes), np.array([len(x) for x in hashes])


def _in_place(equal: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether windows in [low, high) agree enough place by place, and the first and last shingle they share."""
    total = np.zeros((len(equal), AROUND + 1), np.int8)
    np.cumsum(equal, axis=1, dtype=np.int8, out=total[:, 1:])
    similar = total[:, SHINGLES:] - total[:, :-SHINGLES] >= ENOUGH
    similar &= (_at[:SHINGLES] >= low[:, None]) & (_at[:SHINGLES] + SHINGLES <= high[:, None])
    start = similar.argmax(axis=1)[:, None]
    stop = (SHINGLES - 1 - similar[:, ::-1].argmax(axis=1))[:, None] + SHINGLES
    inside = equal & (_at >= start) & (_at < stop)
    return similar.any(axis=1), *_ends(inside)


def _ends(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last place of each row that is ``held``."""
    return held.argmax(axis=1), held.shape[1] - 1 - held[:, ::-1].argmax(axis=1)


def _holders(values: np.ndarray, holder: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last holder of each value; ``holder`` ascends."""
    order = np.argsort(values, kind="stable")
    edges = np.flatnonzero(np.r_[True, values[order[1:]] != values[order[:-1]]])
    sizes = np.diff(np.r_[edges, len(values)])
    first, last = np.empty(len(values), np.int64), np.empty(len(values), np.int64)
    first[order] = np.repeat(holder[order[edges]], sizes)
    last[order] = np.repeat(holder[order[edges + sizes - 1]], sizes)
    return first, last


def _before_in(rows: np.ndarray) -> np.ndarray:
    """The place in its row before each at which its value was last, -1 for none."""
    order = np.argsort(rows, axis=1, kind="stable")
    ordered = np.take_along_axis(rows, order, axis=1)
    row, at = np.nonzero(ordered[:, 1:] == ordered[:, :-1])
    out = np.full(rows.shape, -1)
    out[row, order[row, at + 1]] = order[row, at]
    return out


def _counted(held: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """The number of different shingles that are ``held`` in each window; ``fresh`` is the first window that counts one."""
    row, at = np.nonzero(held)
    size = AROUND + 1
    plus = np.bincount(row * size + fresh[row, at], minlength=len(held) * size)
    minus = np.bincount(row * size + at + 1, minlength=len(held) * size)
    return (plus - minus).reshape(-1, size).cumsum(axis=1)[:, :WINDOWS]


def _may(shared: np.ndarray, sizes: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether windows that share so many shingles can be similar to one of ``least`` shingles or more."""
    return (100 * shared >= PERCENT * sizes) & ((100 + PERCENT) * shared >= PERCENT * (sizes + least))


class Meeting:
    """Places of keys, in order of meeting and document, with the shingles around each; ``compare`` finds what is repeated.

    ``spans`` are first and last shingle around a place that another document
    holds too, ``gone`` those an earlier one holds; ``group`` is the first of
    the places joined with this one.  Only places of one meeting are compared.
    """

    def __init__(
        self, own: np.ndarray, side: np.ndarray, around: np.ndarray, valid: np.ndarray, meeting: np.ndarray | None = None
    ) -> None:
        n = len(own)
        self.own, self.side, self.around, self.valid = own, side, np.where(valid, around, np.uint32(0)), valid
        self.meeting = np.zeros(n, np.int64) if meeting is None else meeting
        self.group = np.arange(n)
        self.spans = np.tile(np.array([AROUND, -1]), (n, 1))
        self.gone = self.spans.copy()
        self.low, self.high = valid.argmax(axis=1), AROUND - valid[:, ::-1].argmax(axis=1)
        self.edges = AROUND - valid.sum(axis=1)
        self.whole = (_at[:WINDOWS] >= self.low[:, None]) & (_at[:WINDOWS] + SHINGLES <= self.high[:, None])
        # Most rows lie inside their text and hold no shingle twice.
        ordered = np.sort(self.around, axis=1)
        self.unlike = (ordered[:, 1:] != ordered[:, :-1]).all(axis=1) & (self.edges == 0)
        self.fresh = np.tile(np.maximum(_at - SHINGLES + 1, 0), (n, 1))
        self.sizes = np.full((n, WINDOWS), SHINGLES, np.int16)
        other = np.flatnonzero(~self.unlike)
        if len(other):
            # Places that are no shingles agree with nothing.
            fits, at = valid[other], _at.astype(np.uint64)
            before = _before_in(np.where(fits, self.around[other], (np.uint64(1) << np.uint64(32)) | at))
            self.fresh[other] = np.maximum(self.fresh[other], before + 1)
            self.sizes[other] = _counted(fits, self.fresh[other])
            self.unlike[other] = (before < 0).all(axis=1) & ~((self.around[other] == 0) & fits).any(axis=1)
        self.least = np.where(self.whole, self.sizes, SHINGLES).min(axis=1).astype(np.int64)

    def _settled(self, one: np.ndarray, two: np.ndarray, *ends: np.ndarray) -> np.ndarray:
        """Whether places are joined and share nothing beyond what is known to be repeated."""
        known = (self.spans[one, 0] <= ends[0]) & (ends[1] <= self.spans[one, 1])
        for spans in (self.spans, self.gone):
            known &= (spans[two, 0] <= ends[2]) & (ends[3] <= spans[two, 1])
        return known & (self.group[two] == self.group[one])

    def _join(self, one: np.ndarray, two: np.ndarray, *found: np.ndarray) -> None:
        """Adds spans that places and later places share."""
        for spans, places, first, last in ((self.spans, one, *found[:2]), (self.spans, two, *found[2:]), (self.gone, two, *found[2:])):
            np.minimum.at(spans[:, 0], places, first)
            np.maximum.at(spans[:, 1], places, last)
        self._unite(one, two)

    def _unite(self, one: np.ndarray, two: np.ndarray) -> None:
        """Joins the groups of places, in pairs."""
        while len(one):
            first, second = self.group[one], self.group[two]
            apart = first != second
            one, two = one[apart], two[apart]
            np.minimum.at(self.group, np.maximum(first, second)[apart], np.minimum(first, second)[apart])
            while (self.group != self.group[self.group]).any():
                self.group = self.group[self.group]

    def _join_equal(self, rows: np.ndarray) -> None:
        """Joins places among ``rows`` by windows that are equal, shingle by shingle, at one distance from the key."""
        total = np.zeros((len(rows), AROUND + 1), np.uint64)
        np.cumsum(mixed(self.around[rows].astype(np.uint64) | (_at.astype(np.uint64) << np.uint64(32))), axis=1, out=total[:, 1:])
        prints = total[:, SHINGLES:] - total[:, :-SHINGLES] + mixed(self.meeting[rows].astype(np.uint64))[:, None]
        self._join_prints(rows, prints)

    def _join_prints(self, rows: np.ndarray, prints: np.ndarray) -> None:
        """Joins places among ``rows`` by windows of one print."""
        whole = self.whole[rows]
        at = np.nonzero(whole)[0]
        holder = rows[at]
        earliest, latest = _holders(prints[whole], holder)
        shared, gone = np.zeros_like(whole), np.zeros_like(whole)
        shared[whole] = self.own[earliest] != self.own[latest]
        gone[whole] = self.own[holder] != self.own[earliest]
        for spans, held in ((self.spans, shared), (self.gone, gone)):
            some = held.any(axis=1)
            first, last = _ends(held[some])
            spans[rows[some], 0] = np.minimum(spans[rows[some], 0], first)
            spans[rows[some], 1] = np.maximum(spans[rows[some], 1], last + SHINGLES - 1)
        joined = shared[whole]
        self._unite(earliest[joined], holder[joined])

    def _reach(self, rows: np.ndarray, held: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and last shingle in ``held`` that similar windows can share; ``AROUND`` and -1 without any."""
        may = self.whole[rows] & _may(_counted(held, self.fresh[rows]), self.sizes[rows], least[:, None])
        some = may.any(axis=1)
        start, stop = _ends(may)
        inside = held & (_at >= start[:, None]) & (_at < stop[:, None] + SHINGLES) & some[:, None]
        return np.where(inside, _at, AROUND).min(axis=1), np.where(inside, _at, -1).max(axis=1)

    def compare(self) -> None:
        """Every two places of different documents, but for those that can add nothing.

        Shingles that no place of another document holds can't be shared.  A
        place all of whose shared ones lie in what is known to be repeated adds
        nothing to another such place that it is joined with already.
        """
        n = len(self.own)
        if n < 2:
            return
        starts = np.flatnonzero(np.r_[True, self.meeting[1:] != self.meeting[:-1]])
        sizes = np.diff(np.r_[starts, n])
        size = np.repeat(sizes, sizes)
        # What places can share, at most, and hold of what others hold.
        self.reach, self.reach_gone = np.tile([[0, AROUND - 1]], (n, 1)), np.tile([[0, AROUND - 1]], (n, 1))
        left = size > 1
        rows = np.flatnonzero(size > FEW)
        if len(rows):
            self._join_equal(rows)
            valid = self.valid[rows]
            holder = rows[np.nonzero(valid)[0]]
            named = (np.repeat(np.arange(len(starts)), sizes)[rows][:, None] << 32) | self.around[rows]
            earliest, latest = _holders(named[valid], holder)
            several, before = np.zeros_like(valid), np.zeros_like(valid)
            several[valid] = self.own[earliest] != self.own[latest]
            before[valid] = self.own[holder] != self.own[earliest]
            least = np.repeat(np.minimum.reduceat(self.least, starts), sizes)[rows]
            self.reach[rows] = np.stack(self._reach(rows, several, least), axis=1)
            self.reach_gone[rows] = np.stack(self._reach(rows, before, least), axis=1)
            left[rows] = self.reach[rows, 1] >= 0
        large = left & (size > MANY)
        self._compare_all(np.flatnonzero(left & ~large))
        if large.any():
            slots = (self.around & 0xFFFF).astype(np.uint16)
            probes = np.ascontiguousarray(slots[:, PROBES])
            for start, end in zip(starts[sizes > MANY], (starts + sizes)[sizes > MANY], strict=True):
                self._compare_many(start + np.flatnonzero(large[start:end]), slots, probes)

    def _closed(self, spans: np.ndarray, reach: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return (spans[rows, 0] <= reach[rows, 0]) & (reach[rows, 1] <= spans[rows, 1])

    def _open(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether places, in pairs, are of different documents and blocks, and can add something."""
        fits = (self.own[one] != self.own[two]) & ((self.side[one] != self.side[two]) | (self.side[one] == 2))
        closed = self._closed(self.spans, self.reach, one) & self._closed(self.spans, self.reach, two)
        closed &= self._closed(self.gone, self.reach_gone, two) & (self.group[one] == self.group[two])
        return fits & ~closed

    def _compare_all(self, rows: np.ndarray) -> None:
        """``rows`` with those that follow in their meetings; the first of all meetings, then the second, and so on."""
        if len(rows) < 2:
            return
        starts = np.flatnonzero(np.r_[True, self.meeting[rows[1:]] != self.meeting[rows[:-1]]])
        sizes = np.diff(np.r_[starts, len(rows)])
        at = np.arange(len(rows))
        rank = at - np.repeat(starts, sizes)
        later = np.repeat(sizes, sizes) - 1 - rank
        order = np.argsort(rank, kind="stable")
        order = order[later[order] > 0]
        total = np.cumsum(later[order])
        start = 0
        while start < len(order):
            done = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, done + PAIRS, "right")))
            part = order[start:end]
            one = np.repeat(part, later[part])
            two = one + 1 + np.arange(len(one)) - np.repeat(total[start:end] - later[part] - done, later[part])
            self._compare(rows[one], rows[two])
            start = end

    def _compare_many(self, rows: np.ndarray, slots: np.ndarray, probes: np.ndarray) -> None:
        """``rows`` of one meeting with one another.

        A window of different shingles that is similar to another such shares
        all but six with it, so at least one of seven; every window holds the
        first or the last seven probes.
        """
        if (~self.unlike[rows]).sum() > LOOSE and self._compare_sets(rows):
            return
        table = np.zeros(1 << 16, bool)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        pairs = 0
        for k, i in enumerate(rows[:-1]):
            others = rows[k + 1 :]
            table[slots[i]] = True
            if self.unlike[i]:
                others = others[table[probes[others]].any(axis=1) | ~self.unlike[others]]
            table[slots[i]] = False
            one = np.full(len(others), i)
            some = self._open(one, others)
            waiting.append((one[some], others[some]))
            pairs += len(waiting[-1][0])
            if pairs >= PAIRS:
                self._compare(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
                waiting, pairs = [], 0
        if pairs:
            self._compare(*(np.concatenate(x) for x in zip(*waiting, strict=True)))

    def _compare_sets(self, rows: np.ndarray) -> bool:
        """``rows`` of one meeting with one another, by the sets of shingles of their windows; False if that leaves out little.

        Windows of one set join their places, and share all they hold.  Of two
        similar windows of different sets, each holds three quarters of the
        other, so the rarest shingles of the one, one more than it may have
        for itself, and those of the other have one in common; sets of one or
        two shingles are similar to no other.
        """
        valid, fresh, whole = self.valid[rows], self.fresh[rows], self.whole[rows]
        n = len(rows)
        if n < 2:
            return True
        row = np.nonzero(valid)[0]
        values, number = np.unique(self.around[rows][valid], return_inverse=True)
        weight = np.zeros((n, AROUND), np.uint64)
        weight[valid] = mixed(mixed(values.astype(np.uint64)))[number]
        prints = np.zeros((n, AROUND + 1), np.uint64)
        np.add.at(prints, (row, fresh[valid]), weight[valid])
        prints[:, 1:] -= weight
        prints = np.cumsum(prints, axis=1, dtype=np.uint64)[:, :WINDOWS]
        self._join_prints(rows, prints)

        rank = np.empty(len(values), np.int32)
        rank[np.argsort(np.bincount(number), kind="stable")] = np.arange(len(values), dtype=np.int32)
        ranks = np.zeros((n, AROUND), np.int32)
        ranks[valid] = rank[number]
        whole &= self.sizes[rows] > 2
        place, start = np.nonzero(whole)
        _, first, kind = np.unique(prints[whole], return_index=True, return_inverse=True)
        rarest, several = [], []
        for k in range(0, len(first), SORTED):
            some = first[k : k + SORTED]
            held = np.sort(ranks[place[some][:, None], start[some][:, None] + _at[:SHINGLES]], axis=1)
            fresh_one = np.ones(held.shape, bool)
            fresh_one[:, 1:] = held[:, 1:] != held[:, :-1]
            size = self.sizes[rows[place[some]], start[some]].astype(np.int64)
            own, of = size + 1 - -(-PERCENT * size // 100), np.cumsum(fresh_one, axis=1)
            kept = fresh_one & (of <= own[:, None])
            rarest.append(held[kept])
            several.append(kept.sum(axis=1))
        if not rarest:
            return True
        # Each place once with each of the rarest shingles of its windows, in order of these.
        rarest, several = np.concatenate(rarest).astype(np.int64), np.concatenate(several)
        ends = np.cumsum(several)
        named = np.unique(place * len(first) + kind)
        place, kind = named // len(first), named % len(first)
        many = several[kind]
        which = np.repeat(ends[kind] - np.cumsum(many), many) + np.arange(many.sum())
        named = np.unique(rarest[which] * n + np.repeat(place, many))
        shingle, place = named // n, named % n
        stop = np.searchsorted(shingle, shingle, "right")
        later = stop - 1 - np.arange(len(place))
        if later.sum() > n * n:
            return False
        # The later places with each shingle of a place, place by place.
        order = np.argsort(place, kind="stable")
        order = order[later[order] > 0]
        total = np.cumsum(later[order])
        begin = 0
        while begin < len(order):
            done = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, done + FOUND, "right")))
            part = order[begin:end]
            one = np.repeat(place[part], later[part])
            two = place[np.repeat(part + 1 - (total[begin:end] - later[part] - done), later[part]) + np.arange(len(one))]
            pairs = np.unique(one * n + two)
            self._compare(rows[pairs // n], rows[pairs % n])
            begin = end
        return True

    def _compare(self, one: np.ndarray, two: np.ndarray) -> None:
        """Joins places, in pairs, that hold similar windows; the second of a pair is the later one."""
        for start in range(0, len(one), PAIRS):
            own, other = one[start : start + PAIRS], two[start : start + PAIRS]
            some = self._open(own, other)
            self._compare_part(own[some], other[some])

    def _compare_part(self, one: np.ndarray, two: np.ndarray) -> None:
        if not len(one):
            return
        a, b = self.around[one], self.around[two]
        both = np.sort(np.concatenate([a, b], axis=1), axis=1)
        # Exact where nothing recurs, else too many; edges are zeros.
        shared = (both[:, 1:] == both[:, :-1]).sum(axis=1) - np.maximum(self.edges[one] + self.edges[two] - 1, 0)
        stay = (100 + PERCENT) * shared >= PERCENT * (self.least[one] + self.least[two])
        one, two, shared = one[stay], two[stay], shared[stay]
        equal = (a[stay] == b[stay]) & self.valid[one] & self.valid[two]
        low, high = np.maximum(self.low[two], self.low[one]), np.minimum(self.high[two], self.high[one])
        # Where all that is shared lies at one shift and nothing recurs, no other windows are more alike,
        # provided that those of the one are windows of the other too.
        plain = (low == self.low[one]) & (high == self.high[one]) | (low == self.low[two]) & (high == self.high[two])
        plain &= self.unlike[one] & self.unlike[two] & (equal.sum(axis=1) == shared)
        rest = np.flatnonzero(~plain)
        first, last = _ends(equal)
        plain &= ~self._settled(one, two, first, last, first, last)
        if plain.any():
            is_repeat, first, last = _in_place(equal[plain], low[plain], high[plain])
            first, last = first[is_repeat], last[is_repeat]
            self._join(one[plain][is_repeat], two[plain][is_repeat], first, last, first, last)
        for start in range(0, len(rest), CROSS):
            part = rest[start : start + CROSS]
            self._cross(one[part], two[part])

    def _cross(self, one: np.ndarray, two: np.ndarray) -> None:
        """Any window of the one place against any of the other, by the similarity of their shingle sets.

        A value counts where it is the first of its kind in both windows, so a
        match counts in a rectangle of window pairs.
        """
        # Edges of the one are zeros, those of the other ones, so that few of them agree.
        a, b = self.around[one], np.where(self.valid[two], self.around[two], np.uint32(1))
        match = a[:, :, None] == b[:, None, :]
        need = -(-PERCENT * (self.least[one] + self.least[two]) // (100 + PERCENT))
        ends, some = [], np.ones(len(one), bool)
        for held in (match.any(axis=2) & self.valid[one], match.any(axis=1) & self.valid[two]):
            # No window shares more than lies in it.
            total = np.zeros((len(one), AROUND + 1), np.int8)
            np.cumsum(held, axis=1, dtype=np.int8, out=total[:, 1:])
            may = total[:, SHINGLES:] - total[:, :-SHINGLES] >= need[:, None]
            some &= may.any(axis=1)
            start, stop = _ends(may)
            ends += _ends(held & (_at >= start[:, None]) & (_at < stop[:, None] + SHINGLES))
        some = np.flatnonzero(some & ~self._settled(one, two, *ends))
        if not len(some):
            return
        one, two = one[some], two[some]
        at, q = np.nonzero(match[some].reshape(-1, AROUND))
        pair = at // AROUND
        p = at - pair * AROUND
        at_one, at_two = one[pair] * AROUND + p, two[pair] * AROUND + q
        if (self.edges[one] + self.edges[two]).any():
            fits = self.valid.ravel()[at_one] & self.valid.ravel()[at_two]
            pair, p, q, at_one, at_two = pair[fits], p[fits], q[fits], at_one[fits], at_two[fits]
        top, left = self.fresh.ravel()[at_one], self.fresh.ravel()[at_two]
        bottom, right = np.minimum(p + 1, WINDOWS), np.minimum(q + 1, WINDOWS)
        fits = (top < bottom) & (left < right)
        top, left, bottom, right = top[fits], left[fits], bottom[fits], right[fits]
        width = WINDOWS + 1
        size, base = len(one) * width * width, pair[fits] * (width * width)
        top, bottom = base + top * width, base + bottom * width
        plus = np.bincount(np.r_[top + left, bottom + right], minlength=size)
        minus = np.bincount(np.r_[top + right, bottom + left], minlength=size)
        shared = (plus - minus).astype(np.int16).reshape(-1, width, width)
        shared = shared.cumsum(axis=1, dtype=np.int16).cumsum(axis=2, dtype=np.int16)[:, :WINDOWS, :WINDOWS]
        sizes = self.sizes[one][:, :, None] + self.sizes[two][:, None, :]
        similar = (100 + PERCENT) * shared >= PERCENT * sizes
        similar &= self.whole[one][:, :, None] & self.whole[two][:, None, :]
        rows, columns = similar.any(axis=2), similar.any(axis=1)
        some = rows.any(axis=1)
        (top, bottom), (left, right) = _ends(rows), _ends(columns)
        inside = some[pair] & (p >= top[pair]) & (p < bottom[pair] + SHINGLES) & (q >= left[pair]) & (q < right[pair] + SHINGLES)
        pair, p, q = pair[inside], p[inside], q[inside]
        if len(pair):
            # Matches lie in order of pair.
            first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
            ends = [f.reduceat(x, first) for x in (p, q) for f in (np.minimum, np.maximum)]
            self._join(one[pair[first]], two[pair[first]], *ends)


def similar_windows(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int] | None:
    """First and last shingle in ``a`` and in ``b`` that their similar windows share; None without such windows.

    Any window of the one is held against any of the other; neither is longer than the surroundings of a key.
    """
    around, valid = np.zeros((2, AROUND), np.uint32), np.zeros((2, AROUND), bool)
    for row, fits, values in zip(around, valid, (a, b), strict=True):
        row[: len(values)], fits[: len(values)] = values, True
    met = Meeting(np.arange(2), np.full(2, 2), around, valid)
    met._cross(np.array([0]), np.array([1]))
    return (*met.spans[0].tolist(), *met.spans[1].tolist()) if met.spans[0, 1] >= 0 else None


def _kinds(rows: np.ndarray) -> np.ndarray:
    """The number of each row's kind; rows of a kind are equal."""
    _, first, kind = np.unique(rows.astype(np.uint64) @ _factors[: rows.shape[1]], return_index=True, return_inverse=True)
    if (rows[first[kind]] != rows).any():
        _, kind = np.unique(rows, axis=0, return_inverse=True)
    return kind.reshape(-1)


def repeats(
    own: np.ndarray, side: np.ndarray, around: np.ndarray, valid: np.ndarray, meeting: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans, gone and group of a ``Meeting``, with equal surroundings compared once.

    The first and the last place of equal surroundings stand for all of them:
    if these are of two documents, all that surrounds any of the places is
    repeated, and gone but in the first document; whether an earlier document
    holds a part of that one shows in its first place.  A place without a span
    may be given the group of another of its document.
    """
    if meeting is None:
        meeting = np.zeros(len(own), np.int64)
    number = np.cumsum(np.diff(meeting, prepend=meeting[:1]) != 0)
    ends = np.stack([valid.argmax(axis=1), valid.sum(axis=1), number], axis=1).astype(np.uint32)
    kind = _kinds(np.concatenate([around, ends], axis=1))
    order = np.argsort(kind, kind="stable")
    edges = np.flatnonzero(np.diff(kind[order], prepend=-1))
    first, last = order[edges][kind], order[np.r_[edges[1:], len(order)] - 1][kind]
    several = own[first] != own[last]
    chosen = np.unique(np.r_[first, last[several]])
    at = np.zeros(len(own), np.int64)
    at[chosen] = np.arange(len(chosen))
    met = Meeting(own[chosen], side[chosen], around[chosen], valid[chosen], number[chosen])
    whole = np.stack([met.low, met.high - 1], axis=1)
    one, other = at[first[several]], at[last[several]]
    met.spans[one], met.spans[other], met.gone[other] = whole[one], whole[other], whole[other]
    met.group[other] = one
    met.compare()
    rep = at[first]
    spans, gone = met.spans[rep], met.gone[rep]
    later = own > own[first]
    gone[later] = whole[rep][later]
    return spans, gone, chosen[met.group[rep]]


def _identity() -> list[Column]:
    """A row's document, those without doc_id last, and the hash of its text."""
    return [F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("row")]


def _keyed(docs: DataFrame) -> DataFrame:
    """doc, row, print (128 bits of the words), n_words, keys, places of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 2 << 20):
            words, sizes = _hashes_of(batch.column(2))
            text, keys, places = keys_of(words, sizes)
            ends = np.cumsum(sizes)
            prints = [xxhash.xxh3_128_digest(words[end - size : end].tobytes()) for end, size in zip(ends, sizes, strict=True)]
            offsets = pa.array(np.r_[0, np.cumsum(np.bincount(text, minlength=len(sizes)))], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(prints, pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.ListArray.from_arrays(offsets, pa.array(keys)),
                    pa.ListArray.from_arrays(offsets, pa.array(places)),
                ],
                ["doc", "row", "print", "n_words", "keys", "places"],
            )

    schema = "doc bigint, row bigint, print binary, n_words int, keys array<bigint>, places array<int>"
    return docs.select(*_identity(), "text").mapInArrow(run, schema)


def _around(held: DataFrame) -> DataFrame:
    """doc, row, key, place, size, n, around (32 bits of each shingle about the place) of every place in ``spots``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "row", "key", "place", "size", "n", "around"]
        for batch in rows_of(batches, 2 << 20):
            words, sizes = _hashes_of(batch.column(2))
            # The shingles of each text, and behind them four that reach into the next one and are edge.
            hashes = shingle_hashes(np.r_[words, np.zeros(SHINGLE_WORDS, np.uint64)])
            shingles = (hashes >> np.uint64(32)).astype(np.uint32)
            first, n = np.cumsum(sizes) - sizes, sizes - SHINGLE_WORDS + 1
            spots = batch.column(3)
            text = np.repeat(np.arange(len(sizes)), spots.value_lengths().to_numpy())
            key, place, size = (x.to_numpy() for x in spots.flatten().flatten())
            for start in range(0, len(text), 4096):
                own = text[start : start + 4096]
                at = place[start : start + 4096].astype(np.int64)[:, None] + _at - (SHINGLES - 1)
                valid = (at >= 0) & (at < n[own][:, None])
                data = np.where(valid, shingles[np.where(valid, at + first[own][:, None], 0)], np.uint32(0)).tobytes()
                around = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * AROUND), len(own), [None, pa.py_buffer(data)])
                part = slice(start, start + 4096)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(own)),
                        batch.column(1).take(pa.array(own)),
                        pa.array(key[part]),
                        pa.array(place[part]),
                        pa.array(size[part]),
                        pa.array(n[own], pa.int32()),
                        around.cast(pa.binary()),
                    ],
                    names,
                )

    schema = "doc bigint, row bigint, key bigint, place int, size bigint, n int, around binary"
    return held.select("id.doc", "id.row", "text", "spots").mapInArrow(run, schema)


def _meetings(around: DataFrame) -> DataFrame:
    """The places with meeting and side: every two blocks of a key's places meet, and each block itself."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("doc", "row", F.lit("block")), blocks).cast("int")
    meet = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(
            F.xxhash64("key", F.least(block, other), F.greatest(block, other)).alias("meeting"),
            F.when(block == other, 2).when(block < other, 0).otherwise(1).alias("side"),
        ),
    )
    met = around.select("doc", "row", "place", "n", "around", F.explode(meet).alias("m"))
    return met.select("m.meeting", "m.side", "doc", "row", "place", "n", "around")


def _met(rows: DataFrame) -> DataFrame:
    """id, start, end, gone_start, gone_end, other, other_start, other_end, in words, of places that repeat others.

    ``gone`` is the part an earlier document holds, null for none; ``other``
    is the first place of the meeting joined with this one.
    """
    names = ["id", "start", "end", "gone_start", "gone_end", "other", "other_start", "other_end"]

    def made(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, row, place, n, side, meeting = (batch.column(c).to_numpy() for c in ("doc", "row", "place", "n", "side", "meeting"))
        order = np.lexsort((place, row, doc, meeting))
        doc, row, place, n, side, meeting = (x[order] for x in (doc, row, place, n, side, meeting))
        around = np.frombuffer(b"".join(batch.column("around").to_pylist()), np.uint32).reshape(-1, AROUND)[order]
        at = place[:, None].astype(np.int64) + _at - (SHINGLES - 1)
        valid = (at >= 0) & (at < n[:, None])
        # A document's own places don't repeat each other.
        same = (meeting[1:] == meeting[:-1]) & (doc[1:] == doc[:-1]) & (row[1:] == row[:-1])
        spans, gone, group = repeats(np.r_[0, np.cumsum(~same)], side, around, valid, meeting)
        low = place.astype(np.int64)[:, None] - (SHINGLES - 1) + np.array([0, SHINGLE_WORDS])
        words, lost = spans + low, gone + low
        some = np.flatnonzero(spans[:, 1] >= 0)
        other = group[some]
        kept, alone = gone[some, 1] < 0, other == some
        ident = lambda at, nulls=None: pa.StructArray.from_arrays([pa.array(doc[at]), pa.array(row[at])], ["doc", "row"], mask=nulls)
        ints = lambda values, nulls=None: pa.array(values, pa.int32(), mask=nulls)
        spans_of = lambda values, nulls=None: [ints(values[:, 0], nulls), ints(values[:, 1], nulls)]
        columns = [ident(some), *spans_of(words[some]), *spans_of(lost[some], kept)]
        columns += [ident(other, pa.array(alone)), *spans_of(words[other], alone)]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            if sum(x.num_rows for x in waiting) < TOGETHER:
                continue
            # All but the last meeting, which may go on in the next batch.
            joined = pa.concat_batches(waiting)
            meeting = joined.column(0).to_numpy()
            cut = int(np.searchsorted(meeting, meeting[-1]))
            if cut:
                yield made(joined.slice(0, cut))
            waiting = [joined.slice(cut)]
        if waiting:
            yield made(pa.concat_batches(waiting))

    kind = "struct<doc:bigint,row:bigint>"
    schema = f"id {kind}, start int, end int, gone_start int, gone_end int, other {kind}, other_start int, other_end int"
    dealt = rows.repartition("meeting").sortWithinPartitions("meeting")
    return dealt.mapInArrow(run, schema)


def _merged(spans: DataFrame) -> DataFrame:
    """id, start, end of each span, with the bounds (first, last) of all spans it overlaps with."""
    ordered = W.partitionBy("id").orderBy("start", "end")
    before = F.max("end").over(ordered.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.when(before.isNull() | (F.col("start") >= before), 1).otherwise(0)
    numbered = spans.distinct().withColumn("fresh", fresh).withColumn("number", F.sum("fresh").over(ordered))
    whole = W.partitionBy("id", "number")
    return numbered.select(
        "id", "start", "end", F.min("start").over(whole).alias("first"), F.max("end").over(whole).alias("last")
    )


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, first_word, n_words, n_removed, component_id: a row per repeated passage of a document.

    A passage is repeated if another document holds it at a shingle similarity
    of 0.75 or more over any fifty words.  ``n_removed`` are those of its words
    that an earlier document (by doc_id) holds too; the first holder keeps
    them, so nothing disappears everywhere.  Passages that repeat one another
    are a component, named by its smallest doc_id.  Documents without a
    repeated passage have no row.

    Texts of the same words are a class and are searched once.  Each row of
    fifty words or more in a class of several is a repeated passage as a whole
    and goes but for the first.  All places at which classes hold a band key
    meet, in blocks of ``BLOCK`` of which any two meet in a task of their own,
    with the shingles of all windows around them.  Any two windows there that
    agree in a band are held against each other by the similarity of their
    shingle sets, so words put in or left out and parts that changed places
    count as what they are.  Places already joined that share nothing beyond
    what is known are left out.  A meeting returns a row a place, no pairs, and
    no key is capped.

    Null and empty texts and texts of fewer than fifty words have no passages.
    Rows without doc_id take part as the last document; their component_id is
    null if no other has one.  Repeated rows are copies.  An empty table gives
    an empty one.  Columns besides doc_id and text are ignored.
    """
    with shuffles_removed(docs.sparkSession):
        return _passages(docs)


def _passages(docs: DataFrame) -> DataFrame:
    full, full_folder = saved_at(_keyed(docs), "passage-windows")
    rows = saved(full.select("doc", "row", "print", "n_words"), "passage-rows")
    ident = F.struct("doc", "row")
    named = [F.min(ident).alias("id"), F.count("*").alias("n")]
    classes = full.filter(F.col("n_words") >= WINDOW).groupBy("print").agg(*named, F.first("keys").alias("keys"), F.first("places").alias("places"))
    placed = F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("places").alias("place")))
    keyed, keyed_folder = saved_at(classes.select("id", placed), "passage-keys")
    remove_dir(docs.sparkSession, full_folder)
    ends = F.min("id").alias("least"), F.max("id").alias("most")
    shared = keyed.groupBy("key").agg(*ends, F.count("*").alias("size")).filter("least < most")
    shared = saved(shared.select("key", "size"), "passage-shared")
    spots = F.collect_list(F.struct("key", "place", "size")).alias("spots")
    held = saved(keyed.join(shared, "key").groupBy("id").agg(spots), "passage-spots")
    remove_dir(docs.sparkSession, keyed_folder)
    # Rows repeated with their doc_id have one id, and one of them is read.
    texts = docs.select(F.struct(*_identity()).alias("id"), "text").join(held, "id")
    texts = texts.groupBy("id").agg(F.first("text").alias("text"), F.first("spots").alias("spots"))
    found = saved(_met(_meetings(_around(texts))), "passage-found").distinct()

    merged = saved(_merged(found.select("id", "start", "end")), "passage-spans")
    lost = found.filter("gone_start is not null").select("id", F.col("gone_start").alias("start"), F.col("gone_end").alias("end"))
    gone = _merged(lost).select("id", "first", "last").distinct()

    edges = found.filter("other is not null").select(
        *(F.col(a).alias(b) for a, b in (("id", "one"), ("start", "one_start"), ("end", "one_end"))),
        *(F.col(a).alias(b) for a, b in (("other", "two"), ("other_start", "two_start"), ("other_end", "two_end"))),
    )
    for end in ("one", "two"):
        own = merged.select(
            F.col("id").alias(end), F.col("start").alias(f"{end}_start"), F.col("end").alias(f"{end}_end"),
            F.struct("id", F.col("first").alias("start")).alias(f"node_{end}"),
        )
        edges = edges.join(own, [end, f"{end}_start", f"{end}_end"])
    joined = components(edges.select(F.col("node_one").alias("a"), F.col("node_two").alias("b")))

    spans = merged.select("id", "first", "last").distinct()
    inner = gone.select(F.col("id").alias("g_id"), F.col("first").alias("g_first"), F.col("last").alias("g_last"))
    covered = (F.col("id") == F.col("g_id")) & (F.col("g_first") >= F.col("first")) & (F.col("g_last") <= F.col("last"))
    counted = (
        spans.join(inner, covered, "left")
        .groupBy("id", "first", "last")
        .agg(F.coalesce(F.sum(F.col("g_last") - F.col("g_first")), F.lit(0)).alias("n_removed"))
    )
    node = F.struct("id", F.col("first").alias("start"))
    labelled = counted.join(joined, node == F.col("node")).select(
        "id", "first", "last", "n_removed", F.col("component.id.doc").alias("component_id")
    )
    passages = saved(labelled, "passage-labels")
    first_of = saved(rows.filter(F.col("n_words") >= WINDOW).groupBy("print").agg(*named), "passage-classes")
    placed = rows.select("doc", "row", "print", "n_words").join(first_of, "print")
    inner_rows = placed.join(passages, "id").select(
        "doc", F.col("first").alias("first_word"), (F.col("last") - F.col("first")).alias("n_words"), "n_removed", "component_id"
    )
    order = F.row_number().over(W.partitionBy("print", "doc", "row").orderBy("n_words"))
    copies = placed.filter("n > 1").withColumn("at", order)
    stays = (ident == F.col("id")) & (F.col("at") == 1)
    copies = copies.select(
        "doc",
        F.lit(0).alias("first_word"),
        "n_words",
        F.when(stays, 0).otherwise(F.col("n_words")).alias("n_removed"),
        F.col("id.doc").alias("component_id"),
    )
    real = lambda c: F.nullif(F.col(c), F.lit(_LAST)).alias("doc_id" if c == "doc" else c)
    return inner_rows.unionByName(copies).select(
        real("doc"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("n_words").cast("long").alias("n_words"),
        F.col("n_removed").cast("long").alias("n_removed"),
        real("component_id"),
    )
