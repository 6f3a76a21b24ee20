"""Periodic runs of words: stretches that repeat a period four times or more.

Internal pattern matching. The words of a slice of texts are numbered and their suffixes sorted by
doubled prefixes; at each power of two the blocks at its multiples ask where they occur next, before
and after. That is a range successor: the least place in the block's interval of the suffix array
that lies beyond the block, answered by a wavelet tree over the suffix array. Occurrences of a block
within a window of twice its length form one arithmetic progression, whose difference is the first
gap and the block's period. Blocks that follow each other with the same difference are one run;
its ends are found by comparing words.

Why none is missed: let a run have period q and at least 4 q words (6 for q = 1), and let L be the
least power of two that is q or more (2 for q = 1), so L <= 2 q - 1 beyond q = 2. The first multiple
s of L in the run is followed by L words of the run. If s lies q or more into the run, the block also
stands at s - q; else s + q + L is still in the run, and it stands at s + q. It stands nowhere
between, or the run would have a smaller period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from listmill.llm.common import parts

#: A run has this many words at least, and this many times its period.
LEAST_WORDS, LEAST_TIMES = 6, 4
_SEPARATORS = np.zeros(256, bool)
_SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """The words of several texts one after the other: bytes, codes, and whose they are."""

    def __init__(self, texts: pa.Array) -> None:
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
        ends = ends - ends[0]
        inside = ~_SEPARATORS[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = ends[:-1][ends[:-1] < len(data)]
        first[begins] = inside[begins]
        starts = np.flatnonzero(first)
        kept = data[inside]
        places = np.append((np.cumsum(inside) - 1)[starts], len(kept)).astype(np.int64)
        self.words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(kept)])
        self.text = np.searchsorted(ends, starts, "right") - 1
        self.counts = np.bincount(self.text, minlength=len(texts)).astype(np.int64)
        self.begins = np.cumsum(self.counts) - self.counts

    def symbols(self) -> np.ndarray:
        """Equal for equal words of one text, different for words of different texts."""
        codes = self.words.dictionary_encode()
        return self.text * max(1, len(codes.dictionary)) + codes.indices.to_numpy()

    def joined(self, kept: np.ndarray) -> pa.Array:
        """Each text's words among ``kept`` (a mask), joined by one space."""
        counts = np.bincount(self.text[kept], minlength=len(self.counts))
        offsets = np.append(0, np.cumsum(counts)).astype(np.int64)
        chosen = self.words if kept.all() else self.words.take(pa.array(np.flatnonzero(kept)))
        return pc.binary_join(pa.LargeListArray.from_arrays(offsets, chosen), pa.scalar(b" ", pa.large_binary())).cast(pa.string())


def suffix_blocks(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]]:
    """Suffixes in the order of their first words, and per power of two its blocks that occur twice.

    A block is its place and its interval of that order, in which all its occurrences lie. Words are
    compared as far as periods of a text with ``longest`` words need. Only suffixes that still have
    an equal are sorted on.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank, slots, places = np.empty(n, np.int64), np.arange(n), order
    keys, length, blocks = symbols[order], 1, []
    while True:
        new = np.append(True, keys[1:] != keys[:-1])
        borders = np.append(np.flatnonzero(new), len(slots))
        low, size = np.repeat(slots[borders[:-1]], np.diff(borders)), np.repeat(np.diff(borders), np.diff(borders))
        rank[places] = low
        shared = size > 1
        slots, places, low, size = slots[shared], places[shared], low[shared], size[shared]
        if length > 1:
            whole = places % length == 0
            blocks.append((places[whole], low[whole], low[whole] + size[whole], length))
        if not len(slots) or 2 * length > max(2, longest // 2):
            return order, blocks
        following = places + length
        keys = low * (n + 1) + np.where(following < n, rank[np.minimum(following, n - 1)] + 1, 0)
        by = np.argsort(keys)
        keys, places = keys[by], places[by]
        order[slots] = places
        length *= 2


class WaveletTree:
    """Counts and order statistics of any interval of a permutation, bit by bit (levels as bit vectors)."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = []
        for bit in reversed(range(int(len(values)).bit_length())):
            ones = (values >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(values) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)
            self.levels.append((bit, words, before, int(len(values) - ones.sum())))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & mask)

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many entries of each interval are less than ``value``."""
        count = np.zeros(len(low), np.int64)
        for bit, words, before, zeros in self.levels:
            a, b = self._ones(words, before, low), self._ones(words, before, high)
            one = (value >> bit & 1).astype(bool)
            count += np.where(one, high - low - (b - a), 0)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return count

    def entry(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The entry of each interval that has ``nth`` lesser ones."""
        value = np.zeros(len(low), np.int64)
        for bit, words, before, zeros in self.levels:
            a, b = self._ones(words, before, low), self._ones(words, before, high)
            none = high - low - (b - a)
            one = nth >= none
            nth = np.where(one, nth - none, nth)
            value += one.astype(np.int64) << bit
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return value


def agreeing(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
    """How many symbols agree from each pair of places on, going by ``step`` (1 or -1)."""
    n, done = len(symbols), np.zeros(len(left), np.int64)
    todo, width = np.arange(len(left)), 8
    while len(todo):
        more = []
        for some in np.array_split(todo, -(-len(todo) * width // (1 << 20))):
            ahead = step * (done[some][:, None] + np.arange(width))
            a, b = left[some][:, None] + ahead, right[some][:, None] + ahead
            there = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < n)
            same = there & (symbols[np.clip(a, 0, n - 1)] == symbols[np.clip(b, 0, n - 1)])
            full = same.all(axis=1)
            done[some] += np.where(full, width, same.argmin(axis=1))
            more.append(some[full])
        todo, width = np.concatenate(more), min(width * 2, 1 << 16)
    return done


def runs(symbols: np.ndarray, longest: int) -> np.ndarray:
    """Rows of start, length and period of all runs, by start and then period."""
    if longest < LEAST_WORDS:
        return np.zeros((0, 3), np.int64)
    order, blocks = suffix_blocks(symbols, longest)
    tree, found = None, []
    for at, low, high, length in blocks:
        if not len(at):
            continue
        tree = tree or WaveletTree(order)
        lesser = tree.below(low, high, at)
        for side in (1, -1):
            there = np.flatnonzero(lesser + 1 < high - low if side > 0 else lesser > 0)
            gap = side * (tree.entry(low[there], high[there], lesser[there] + side) - at[there])
            # a smaller difference is a smaller block's, but for the smallest
            fits = (gap <= length) & ((2 * gap > length) | (length == 2))
            place, gap = at[there][fits], gap[fits]
            by = np.argsort(place)
            place, gap = place[by], gap[by]
            head = np.append(True, (np.diff(place) != length) | (np.diff(gap) != 0))[: len(place)]
            first = place[head] - (gap[head] if side < 0 else 0)
            last = place[np.append(head[1:], True)[: len(place)]]
            period = gap[head]
            end = last + length + (period if side > 0 else 0)
            hopeful = end - first + 2 * length >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
            first, end, period = first[hopeful], end[hopeful], period[hopeful]
            first = first - agreeing(symbols, first - 1, first - 1 + period, -1)
            end = end + agreeing(symbols, end, end - period, 1)
            enough = end - first >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
            found.append(np.stack([first, end - first, period], axis=1)[enough])
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return np.unique(rows[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]] if len(rows) else rows


RUNS_TYPE = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])
)


def find_runs(
    docs: DataFrame, text_column: str = "text", words_column: str = "n_words", runs_column: str = "runs", collapsed_column: str = "collapsed"
) -> DataFrame:
    """``docs`` with three columns in place of the text: the number of words, all periodic runs, and
    the words without repeats of a run's first period, joined by one space.

    A word is what lies between spaces and the characters 0x09 to 0x0D. Runs come by start, then
    period; a run's start is a word's number from 0. A null or empty text has no words, no runs and
    an empty collapsed text. Repeated rows are worked on each by itself; an empty table gives no
    rows; other columns are carried along, and a column that has a new one's name (other than the
    text) is an error. Whole texts are read, a very long one by itself; texts are not shuffled.
    """
    rest = [c for c in docs.columns if c != text_column]
    made = [words_column, runs_column, collapsed_column]
    if {c.lower() for c in made} & {c.lower() for c in rest}:
        raise ValueError(f"columns {made} must not be there already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, len(rest)):
                words = Words(part.column(len(rest)))
                rows = runs(words.symbols(), int(words.counts.max(initial=0)))
                border = np.zeros(len(words.text) + 1, np.int64)
                np.add.at(border, rows[:, 0] + rows[:, 2], 1)
                np.add.at(border, rows[:, 0] + rows[:, 1], -1)
                kept = np.cumsum(border)[:-1] == 0
                text = words.text[rows[:, 0]]
                offsets = np.append(0, np.cumsum(np.bincount(text, minlength=len(words.counts)))).astype(np.int32)
                columns = [pa.array(rows[:, 0] - words.begins[text]), pa.array(rows[:, 1]), pa.array(rows[:, 2])]
                found = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, names=["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(rest)], pa.array(words.counts), found, words.joined(kept)], names=[*rest, *made]
                )

    types = [T.LongType(), RUNS_TYPE, T.StringType()]
    schema = T.StructType([*(docs.schema[c] for c in rest), *(T.StructField(c, t) for c, t in zip(made, types))])
    return docs.select(*rest, text_column).mapInArrow(run, schema)
