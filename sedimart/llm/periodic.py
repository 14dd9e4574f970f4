"""Periodic runs of words: longest common extensions over difference-cover sampled suffixes, on a harmonic grid."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: A perfect difference set and its modulus. Any two places reach sampled ones by one
#: common distance below the modulus.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Words of a run at least.
LEAST = 12
#: Texts are searched together, as many as hold about so many words; pairs of places are compared in blocks.
TOGETHER, WORDS, PAIRS = 500, 60_000, 400_000


def _distances() -> np.ndarray:
    sampled = np.isin(np.arange(MODULUS), COVER)
    shifts = np.arange(MODULUS)
    both = sampled[(shifts[:, None, None] + shifts[None, :, None]) % MODULUS] & sampled[(shifts[:, None, None] + shifts[None, None, :]) % MODULUS]
    return both.argmax(0).astype(np.int64)


#: The common distance of two places to sampled ones, by their residues.
DISTANCE = _distances()


class Extensions:
    """Answers how many words from two places on are equal, for many pairs at once.

    Only the suffixes at places whose residue is in the cover are sorted: runs of MODULUS words from
    them get names, and the names are doubled until all differ. Neighbours in that order know how far
    they agree, and a sparse table of minima answers for any two. Other places are compared word by
    word until both have reached a sampled place, fewer than MODULUS words later.
    """

    def __init__(self, words: np.ndarray):
        """``words`` are numbers of 0 and more, or below -1 for those that occur once."""
        self.n = len(words)
        self.words = np.concatenate([words, np.full(MODULUS, -1, words.dtype)])
        chains = [np.arange(r, self.n, MODULUS) for r in COVER]
        place = np.concatenate(chains)
        m = len(place)
        # names left in the chain of places that lie MODULUS words apart, this one included
        room = np.concatenate([np.arange(len(c), 0, -1) for c in chains])
        blocks = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(self.words, MODULUS)[place])
        names = np.unique(blocks.view(np.dtype((np.void, blocks.itemsize * MODULUS))).ravel(), return_inverse=True)[1].astype(np.int64).ravel()
        levels, width = [names], 1
        while m and names.max() < m - 1:
            after = np.zeros(m, np.int64)
            far = np.flatnonzero(room > width)
            after[far] = names[far + width] + 1
            names = np.unique(names * (m + 1) + after, return_inverse=True)[1].astype(np.int64).ravel()
            levels.append(names)
            width *= 2
        self.rank = np.full(self.n + MODULUS, -1, np.int64)
        self.rank[place] = names
        self.least = self._neighbours(place, names, levels, room)

    def _neighbours(self, place: np.ndarray, names: np.ndarray, levels: list[np.ndarray], room: np.ndarray) -> list[np.ndarray]:
        """Minima, over 1, 2, 4 ... pairs of neighbours in order, of the words they have in common."""
        order = np.empty(len(place), np.int64)
        order[names] = np.arange(len(place))
        a, b = order[:-1], order[1:]
        same = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            inside = np.flatnonzero(same < np.minimum(room[a], room[b]))
            equal = inside[levels[level][a[inside] + same[inside]] == levels[level][b[inside] + same[inside]]]
            same[equal] += 1 << level
        common = MODULUS * same
        common += self._compared(place[a] + common, place[b] + common, np.full(len(a), MODULUS))
        table = [common]
        while 2 << (len(table) - 1) <= len(common):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return table

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, found word by word, up to ``most``."""
        out = np.zeros(len(i), np.int64)
        going = np.flatnonzero(most > 0)
        step = 0
        while len(going):
            going = going[self.words[i[going] + step] == self.words[j[going] + step]]
            step += 1
            out[going] = step
            going = going[most[going] > step]
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from i and from j on, where i < j <= n."""
        need = DISTANCE[i % MODULUS, j % MODULUS]
        out = self._compared(i, j, need)
        at = np.flatnonzero((out == need) & (j + need < self.n))
        x, y = self.rank[i[at] + need[at]], self.rank[j[at] + need[at]]
        low, far = np.minimum(x, y), np.abs(x - y)
        level = np.frexp(far.astype(np.float64))[1] - 1
        for k in np.unique(level):
            own = level == k
            row = self.least[k]
            out[at[own]] += np.minimum(row[low[own]], row[low[own] + far[own] - (1 << int(k))])
        return out


def _grid(words: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of pairs (place, period) of equal words at multiples of each period and one period on.

    A run of two periods or more holds a multiple of its period within its first period, so it is met.
    """
    places, periods, held = [], [], 0
    for period in range(1, longest // 2 + 1):
        at = np.flatnonzero(words[:-period:period] == words[period::period]) * period
        if not len(at):
            continue
        for begin in range(0, len(at), PAIRS):
            part = at[begin : begin + PAIRS]
            places.append(part)
            periods.append(np.full(len(part), period))
            held += len(part)
            if held >= PAIRS:
                yield np.concatenate(places), np.concatenate(periods)
                places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def _smallest(found: np.ndarray) -> np.ndarray:
    """Of rows (start, end, period) with equal start and end the one with the smallest period, sorted."""
    found = found[np.lexsort(found.T[::-1])]
    again = (found[1:, :2] == found[:-1, :2]).all(1)
    return found[np.concatenate([[True], ~again])] if len(found) else found


def runs_of(words: np.ndarray, longest: int, least: int = LEAST) -> np.ndarray:
    """Rows (start, end, smallest period) of all maximal runs in ``words``, sorted by start, then end.

    ``words`` may hold several texts of at most ``longest`` words, each followed by a number that
    occurs nowhere else: no run crosses it.
    """
    found = np.zeros((0, 3), np.int64)
    if longest < 2:
        return found
    n = len(words)
    right, left = Extensions(words), Extensions(np.ascontiguousarray(words[::-1]))
    for place, period in _grid(words, longest):
        ahead = right.common(place, place + period)
        behind = np.zeros(len(place), np.int64)
        inner = np.flatnonzero(place > 0)
        behind[inner] = left.common(n - place[inner] - period[inner], n - place[inner])
        long = np.flatnonzero((ahead + behind >= period) & (ahead + behind + period >= least))
        rows = np.stack([place[long] - behind[long], place[long] + period[long] + ahead[long], period[long]], 1)
        found = _smallest(np.concatenate([found, rows]))
    return found


def _found(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                texts = [(t or "").encode().split() for t in part["text"].to_pylist()]
                runs, rest = [[] for _ in texts], [b""] * len(texts)
                group: list[int] = []
                held = 0
                for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
                    if group and held + len(texts[i]) > WORDS:
                        _search(texts, group, least, runs, rest)
                        group, held = [], 0
                    group.append(i)
                    held += len(texts[i])
                _search(texts, group, least, runs, rest)
                kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
                yield pa.RecordBatch.from_arrays([part["key"], pa.array(map(len, texts), pa.int64()), pa.array(runs, kind), pa.array(rest).cast(pa.string())], ["key", "n_words", "runs", "collapsed"])

    return run


def _search(texts: list[list[bytes]], group: list[int], least: int, runs: list, rest: list[bytes]) -> None:
    """Fill in the runs of the texts of a group, and the words that are left when repeats go."""
    ids: dict[bytes, int] = defaultdict(count().__next__)
    first = np.cumsum([0, *(len(texts[i]) + 1 for i in group)])
    flat = np.empty(first[-1], np.int32)
    for k, i in enumerate(group):
        flat[first[k] : first[k + 1] - 1] = list(map(ids.__getitem__, texts[i]))
        flat[first[k + 1] - 1] = -2 - k
    found = runs_of(flat, max((len(texts[i]) for i in group), default=0), least)
    owner = np.searchsorted(first, found[:, 0], side="right") - 1
    stops = np.searchsorted(owner, np.arange(len(group) + 1))
    for k, i in enumerate(group):
        own = found[stops[k] : stops[k + 1]] - [first[k], first[k], 0]
        if not len(own):
            rest[i] = b" ".join(texts[i])
            continue
        own = own[np.lexsort((own[:, 2], own[:, 0]))]
        runs[i] = [{"start": s, "length": e - s, "period": p} for s, e, p in own.tolist()]
        edges = np.zeros(len(texts[i]) + 1, np.int64)
        np.add.at(edges, own[:, 0] + own[:, 2], 1)
        np.add.at(edges, own[:, 1], -1)
        kept = np.flatnonzero(np.cumsum(edges)[:-1] == 0)
        rest[i] = b" ".join([texts[i][w] for w in kept.tolist()])


def periodic_runs(df: DataFrame, key: str | Column = "doc_id", text: str | Column = "text", least: int = LEAST, name: str = "doc_id") -> DataFrame:
    """One row for each document: its key as ``name``, n_words, runs, collapsed.

    Words lie between the blanks space, tab, line feed, vertical tab, form feed and carriage return;
    they are compared as they are. A run is a stretch of consecutive words that repeats with a
    smallest period q, holds ``least`` words or more and two periods or more, and that no neighbouring
    word extends with period q. ``runs`` lists (start, length, period) of every run by start, then
    period; ``collapsed`` is the text without the words that some run holds after its first period,
    joined by single spaces.

    Each text is searched whole, in time that grows as n log n: no pair of places but those one
    period apart on the grid of that period's multiples is looked at, whatever the words. Many short
    texts share one search. Null and empty texts have no words and no runs, rows of one key or of a
    null key are rows of their own, other columns are not read, an empty table gives no rows.
    """
    column = lambda c: F.col(c) if isinstance(c, str) else c
    rows = df.select(column(key).cast("long").alias("key"), column(text).alias("text"))
    kinds = "key long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return rows.mapInArrow(_found(least), kinds).withColumnRenamed("key", name)
