"""Periodic runs of words, found exactly with a grammar made by recompression.

A run is a stretch of words with a smallest period q (words q apart are identical) that no neighbouring
word extends, of at least ``least_words`` words and ``least_periods`` periods.

1. The words of a slice of texts are numbered and compressed by turns: *blocks* (a symbol repeated k
   times becomes one symbol), then *pairs* (neighbours of which the first is on the left side and the
   second on the right side of a seeded partition of the symbols become one).  Both depend on the symbols
   alone, so equal stretches are compressed alike but for their rims.  Every round leaves about three
   quarters of the symbols; texts are kept apart by separators that never join.  The result is a
   run-length grammar of all texts of the slice, in arrays.
2. The longest common extension of two places is read off the grammar: both climb while their symbols
   agree and both begin a group, and descend from the first difference, one comparison a level.  All
   questions of a slice are asked at once; a mirrored grammar answers those to the left.
3. A run of period p covers two neighbouring places of the grid 0, p, 2p, ...  All grids of a text have
   about n ln n places (a harmonic sum).  Pairs of neighbours that hold the same word are candidates;
   their extensions to both sides give the run's exact ends.  Of runs with the same ends the smallest
   period is the period.

Words are told apart by their bytes, symbols by exact names, so there are no collisions, and there is
no suffix array.  The work is local to a text: one pass, no shuffle.  Candidates are taken in portions of
bounded number, and texts in slices of bounded bytes or one longer text, so memory follows the longest
text.

Null and empty texts have no words and no runs.  Very long texts are examined whole.  Repeated rows and
null ids each give their row.  An empty table gives no rows.  Other columns are ignored, so their names
cannot clash.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerwatch.llm import words
from ledgerwatch.llm.batches import map_texts

SLICE_BYTES = 1_000_000
RUNS = "array<struct<start:long,length:long,period:long>>"


@dataclass(frozen=True)
class RunConfig:
    least_words: int = 12
    least_periods: int = 2
    seed: int = 11
    portion: int = 500_000  # grid places looked at together


def _first_of(group):
    """Whether each entry of a non-decreasing array begins a new value."""
    fresh = np.ones(len(group), bool)
    fresh[1:] = group[1:] != group[:-1]
    return fresh


class Level:
    """Symbols of one level; ``parent`` leads to the next level, ``first`` and ``last`` back down."""

    def __init__(self, symbols):
        self.symbols = symbols
        self.parent = self.begins = None  # of the next level, if there is one
        self.down = None  # of each symbol: the first symbol of its group one level below
        self.run_end = None  # at a level compressed by blocks: the end of each symbol's block

    def mirrored(self, below):
        """The same level read from the right; ``below`` is the mirrored level under it."""
        out, n = Level(self.symbols[::-1]), len(self.symbols)
        if self.parent is not None:
            out.parent = self.parent[-1] - self.parent[::-1]
            out.begins = _first_of(out.parent)
        if self.run_end is not None:
            out.run_end = _ends(out.begins)[out.parent]
        if below is not None:
            out.down = np.flatnonzero(below.begins)
        assert out.down is None or len(out.down) == n
        return out


def _ends(begins):
    """The end of each group."""
    return np.append(np.flatnonzero(begins)[1:], len(begins))


def _lifted(level, begins, symbols):
    """The level above: one symbol for each group."""
    level.begins, level.parent = begins, np.cumsum(begins) - 1
    out = Level(symbols)
    out.down = np.flatnonzero(begins)
    return out


def _blocks(level, fresh_name):
    """Blocks of equal symbols; returns the level above and the next free name."""
    s = level.symbols
    begins = _first_of(s)
    at = np.flatnonzero(begins)
    size = np.diff(np.append(at, len(s)))
    level.run_end = None
    symbols = s[at].copy()
    many = np.flatnonzero(size > 1)
    if not len(many):
        return None, fresh_name
    key = symbols[many] * (int(size.max()) + 1) + size[many]
    names, which = np.unique(key, return_inverse=True)
    symbols[many] = fresh_name + which
    level.run_end = np.repeat(at + size, size)
    return _lifted(level, begins, symbols), fresh_name + len(names)


def _pairs(level, fresh_name, side_seed):
    """Pairs of a left and a right symbol; returns the level above and the next free name."""
    s = level.symbols
    bit = (words.mix64(s.astype(np.uint64) ^ np.uint64(side_seed)) >> np.uint64(40)) & np.uint64(1)
    own = s >= 0  # separators are on no side
    second = np.zeros(len(s), bool)
    second[1:] = (own & (bit == 0))[:-1] & (own & (bit == 1))[1:]
    if not second.any():
        return None, fresh_name
    at = np.flatnonzero(second)
    names, which = np.unique(s[at - 1] * fresh_name + s[at], return_inverse=True)
    symbols = s.copy()
    symbols[at - 1] = fresh_name + which
    return _lifted(level, ~second, symbols[~second]), fresh_name + len(names)


def grammar(symbols, seed=11):
    """The levels of a sequence of names (>= 0) between separators (distinct negative numbers).

    Compression ends when each text that has words is a single symbol.
    """
    levels, fresh = [Level(symbols)], int(symbols.max(initial=0)) + 1
    wall = symbols < 0
    turn, least = 0, np.count_nonzero(wall) + np.count_nonzero(~wall[1:] & wall[:-1])
    while len(levels[-1].symbols) > least:
        above, fresh = _blocks(levels[-1], fresh)
        if above is not None:
            levels.append(above)
        turn += 1
        side = int(words.mix64(np.array([seed * 1_000_003 + turn], np.uint64))[0])
        above, fresh = _pairs(levels[-1], fresh, side)
        if above is not None:
            levels.append(above)
    return levels


def mirrored(levels):
    out = []
    for level in levels:
        out.append(level.mirrored(out[-1] if out else None))
    return out


def extensions(levels, x, y):
    """How many symbols from ``x[i]`` and from ``y[i]`` on agree, for all i; x and y differ.

    A separator ends every text, so no extension leaves its text.
    """
    origin, out = x, np.zeros(len(x), np.int64)
    who = np.arange(len(x))
    stopped = []  # at each level: who met a difference there, and where

    def settle(level, who, x, y):
        """Split into those that differ here and those that may climb on."""
        s = level.symbols
        same = s[x] == s[y]
        differ = [(who[~same], x[~same], y[~same])]
        who, x, y = who[same], x[same], y[same]
        inside = ~(level.begins[x] & level.begins[y])
        if inside.any():  # not both begin a group: step to where they do
            w, p, q = who[inside], x[inside], y[inside]
            if level.run_end is not None:
                left, right = level.run_end[p] - p, level.run_end[q] - q
                step = np.minimum(left, right)
                level_on = left == right
            else:
                step, level_on = 1, np.ones(len(p), bool)
            p, q = p + step, q + step
            level_on &= s[p] == s[q]
            differ.append((w[~level_on], p[~level_on], q[~level_on]))
            who = np.concatenate([who[~inside], w[level_on]])
            x = np.concatenate([x[~inside], p[level_on]])
            y = np.concatenate([y[~inside], q[level_on]])
        return [np.concatenate(part) for part in zip(*differ)], who, x, y

    for level in levels:
        if level.parent is None:  # the top: each text is one symbol, so all have met a difference
            stopped.append((who, x, y))
            break
        met, who, x, y = settle(level, who, x, y)
        stopped.append(met)
        if not len(who):
            break
        x, y = level.parent[x], level.parent[y]
    who = x = y = np.zeros(0, np.int64)
    for depth in range(len(stopped) - 1, -1, -1):
        # Those from above differ in their symbols: their groups here agree up to a point.
        if len(who):
            level, s = levels[depth], levels[depth].symbols
            x, y = levels[depth + 1].down[x], levels[depth + 1].down[y]
            same = s[x] == s[y]
            if level.run_end is not None:
                step = np.where(same, np.minimum(level.run_end[x] - x, level.run_end[y] - y), 0)
            else:
                step = same.astype(np.int64)
            x, y = x + step, y + step
        w, p, q = stopped[depth]
        who, x, y = np.concatenate([who, w]), np.concatenate([x, p]), np.concatenate([y, q])
    out[who] = x - origin[who]
    return out


def _grid(sizes, config):
    """(text, place, period) of the neighbours on all grids of texts with ``sizes`` words, in portions."""
    top = np.where(sizes >= config.least_words, sizes // config.least_periods, 0)
    text = np.repeat(np.arange(len(sizes)), top)
    period = np.arange(int(top.sum())) - np.repeat(np.cumsum(top) - top, top) + 1
    held = (sizes[text] - 1) // period  # neighbours (k p, k p + p) inside the text
    upto, at = np.cumsum(held), 0
    while at < len(held):
        before = int(upto[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(upto, before + config.portion, "right")))
        h, p = held[at:end], period[at:end]
        k = np.arange(int(h.sum())) - np.repeat(np.cumsum(h) - h, h)
        p = np.repeat(p, h)
        yield np.repeat(text[at:end], h), k * p, p
        at = end


def runs_of(numbers, sizes, config=RunConfig()):
    """(text, start, length, period) of all runs, by text, start and period.

    ``numbers`` holds the numbered words of all texts one after the other, ``sizes`` their counts.
    """
    none = [np.zeros(0, np.int64)] * 4
    if not len(numbers):
        return none
    begin = np.cumsum(sizes + 1) - sizes  # behind each text's separator
    symbols = np.empty(len(numbers) + len(sizes) + 1, np.int64)
    walls = np.append(begin - 1, len(symbols) - 1)
    wall = np.zeros(len(symbols), bool)
    wall[walls] = True
    symbols[~wall], symbols[wall] = numbers, -1 - np.arange(len(walls))
    found, levels = [], None
    for text, place, period in _grid(sizes, config):
        x = begin[text] + place
        hit = np.flatnonzero(symbols[x] == symbols[x + period])
        if not len(hit):
            continue
        if levels is None:
            levels = grammar(symbols, config.seed)
            mirror = mirrored(levels)
        text, place, period, x = text[hit], place[hit], period[hit], x[hit]
        y, back = x + period, len(symbols) - 1
        ahead = extensions(levels, x, y)
        behind = extensions(mirror, back - y, back - x) - 1  # the places themselves agree
        length = behind + ahead + period
        keep = length >= np.maximum(config.least_words, config.least_periods * period)
        found.append(np.stack([text, place - behind, length, period])[:, keep])
    if not found:
        return none
    text, start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start, text))
    text, start, length, period = (a[order] for a in (text, start, length, period))
    fresh = _first_of(text) | _first_of(start) | _first_of(length)  # the smallest period comes first
    text, start, length, period = (a[fresh] for a in (text, start, length, period))
    order = np.lexsort((period, start, text))
    return [a[order] for a in (text, start, length, period)]


def kept_words(sizes, text, start, length, period):
    """Which words stay: those outside of all runs, and the first period of each run."""
    base = np.cumsum(sizes) - sizes
    change = np.zeros(int(sizes.sum()) + 1, np.int64)
    np.add.at(change, base[text] + start + period, 1)
    np.add.at(change, base[text] + start + length, -1)
    return np.cumsum(change[:-1]) == 0


def detect(docs, config=RunConfig(), id_col="doc_id", text_col="text", rewrite=None):
    """(id, n_words, runs, collapsed) of every row.

    ``runs`` is an array of (start, length, period) by start, then period, counted in words.
    ``collapsed`` is the text of the words that stay, joined by single spaces.  ``rewrite`` (id, words)
    may give other words to examine.
    """

    def make(ids, raws):
        split = [raw.split() for raw in raws]  # bytes: at ASCII white space alone
        if rewrite:
            split = [rewrite(i, w) for i, w in zip(ids.to_pylist(), split)]
        sizes = np.array([len(w) for w in split], np.int64)
        every = np.empty(int(sizes.sum()), object)
        every[:] = [w for part in split for w in part]
        numbers = pd.factorize(every)[0].astype(np.int64)
        text, *run = runs_of(numbers, sizes, config)
        keep = kept_words(sizes, text, *run)
        at = np.searchsorted(text, np.arange(len(raws) + 1)).astype(np.int32)
        end = np.cumsum(sizes)
        held = pa.StructArray.from_arrays([pa.array(r, pa.int64()) for r in run],
                                          ["start", "length", "period"])
        return {
            "n_words": pa.array(sizes),
            "runs": pa.ListArray.from_arrays(pa.array(at), held),
            "collapsed": pa.array([b" ".join(every[e - n:e][keep[e - n:e]]).decode("utf-8")
                                   for e, n in zip(end, sizes)], pa.string())}

    return map_texts(docs, make, f"n_words long, runs {RUNS}, collapsed string", id_col, text_col,
                     SLICE_BYTES)


def listed(runs):
    """A digest text of runs: a line of ``start,length,period`` for each."""
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return F.concat(F.array_join(line, "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))


def longest(runs):
    """The run with the greatest length; of equals the smallest start, then period."""
    return F.array_min(F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
