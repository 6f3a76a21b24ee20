"""Benchmark decontamination: item-sized windows meet items through CGK embeddings and bit sampling.

The walk of Chakraborty, Goldenberg and Koucky copies the symbol under a pointer and moves the
pointer by a random bit that depends on the step and the symbol; after an edit two walks soon run
together again, so few edits mean few differing steps. Sampled steps of such walks are the keys of
a locality-sensitive hash. Symbols are words; whatever shares a key is verified by edit distance.

Windows are laid where a match can begin: of an item's n words with at most k edits, k + 1 edit-free
runs remain, so one run of (n - k) / (k + 1) words stands in the text unchanged, at most k words
from where it would stand without edits. This leaves out no window that could match.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from listmill.engine import cut
from listmill.llm.common import parts
from listmill.llm.files import new_folder, opened

SIMILARITY = 0.8
#: Walks, samples of steps from each walk, steps in a sample. Measured on passages with up to a
#: fifth of their words edited, this finds over 95 of 100; unedited ones always.
WALKS, SAMPLES, STEPS = 8, 8, 3
SEED = 20240607
#: Longest unchanged run that is looked for.
RUN = 4
#: Bytes of benchmark text that one pass over the documents is held against.
BLOCK_BYTES = 8 << 20
#: Bytes of documents that a task holds while it opens all blocks.
HELD_BYTES = 32 << 20
#: Windows of a document that are embedded together, words that a worker remembers.
WINDOWS, REMEMBERED = 1 << 14, 300_000

_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words_of(text: str | None) -> list[str]:
    """Lower-cased words without ASCII punctuation at their ends; words of nothing else are left out."""
    return [w for w in (x.strip(_EDGES) for x in (text or "").lower().split()) if w]


def _scrambled(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit integers with all bits mixed (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def edits_allowed(n: int, similarity: float) -> int:
    return int(n * (1 - similarity) + 1e-9)


def run_length(n: int, k: int) -> int:
    return min(RUN, -(-(n - k) // (k + 1)))


def best_alignment(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edits between the item and any stretch of the text, and where the first such stretch
    ends: dynamic programming over bit vectors (Myers) as long as the item."""
    n = len(item)
    masks: dict[int, int] = {}
    for i, symbol in enumerate(item.tolist()):
        masks[symbol] = masks.get(symbol, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    best, end = n, 0
    for at, symbol in enumerate(text.tolist(), 1):
        same = masks.get(symbol, 0)
        zero = (((same & up) + up) ^ up) | same | down
        plus = down | full & ~(zero | up)
        minus = up & zero
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 & full, minus << 1 & full  # a stretch may start anywhere
        up, down = minus | full & ~(zero | plus), plus & zero
        if score < best:
            best, end = score, at
    return best, end


@dataclass
class Index:
    """The items of one block: words, unchanged runs, and sampled keys of their embeddings."""

    similarity: float
    walks: int
    samples: int

    def build(self, items: list[tuple[object, str | None]]) -> Index:
        self.vocabulary: dict[str, int] = {}
        self.ids, self.items = [], []
        for item_id, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if words:
                self.ids.append(item_id)
                self.items.append(np.array(words, np.int64))
        self.other = len(self.vocabulary)  # any word that no item has
        self.lengths = np.array([len(x) for x in self.items], np.int64)
        self.allowed = np.array([edits_allowed(n, self.similarity) for n in self.lengths.tolist()], np.int64)
        self._index_runs()
        rng = np.random.default_rng(SEED)
        # a walk's bit is hashed from walk, step and symbol: a table of all would grow with steps times words
        self.hashed = _scrambled(np.arange(1, self.other + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        # the steps of a sample are set for each length, as shares of twice the length
        self.shares = rng.random((self.walks, self.samples, STEPS))
        self.mixers = rng.integers(1, 1 << 62, (self.walks, self.samples, STEPS), np.int64).astype(np.uint64) | np.uint64(1)
        # by length, walk and sample: the sorted keys and their items
        self.tables: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray]] = {}
        for n in np.unique(self.lengths).tolist():
            which = np.flatnonzero(self.lengths == n)
            stacked = np.stack([self.items[i] for i in which])
            starts = np.arange(len(which)) * n
            for walk, sample, keys in self.keys(stacked.ravel(), starts, starts + n, n):
                order = np.argsort(keys, kind="stable")
                self.tables[n, walk, sample] = keys[order], which[order].astype(np.int32)
        return self

    def _step_keys(self, walk: int, steps: int) -> tuple[list[np.uint64], list[np.uint64]]:
        """What is added to a symbol's hash at each step of a walk, and the odd number it is multiplied by."""
        base = np.arange(2 * steps, dtype=np.uint64) + np.uint64((SEED << 36) + (walk << 30 << 1))
        mixed = _scrambled(base * np.uint64(0x9E3779B97F4A7C15))
        return list(mixed[::2]), list(mixed[1::2] | np.uint64(1))

    def _index_runs(self) -> None:
        base = np.uint64(self.other + 2)
        found: dict[int, list[tuple[np.ndarray, int]]] = {}
        for i, words in enumerate(self.items):
            size = run_length(len(words), int(self.allowed[i]))
            key = np.zeros(len(words) - size + 1, np.uint64)
            for at in range(size):
                key = key * base + (words[at : at + len(key)] + 1).astype(np.uint64)
            found.setdefault(size, []).append((key, i))
        self.runs = {}
        for size, rows in found.items():
            # keys of four words may pass 64 bits: they are reduced, and what collides is found out by the checks
            keys = np.concatenate([k for k, _ in rows])
            order = np.argsort(keys, kind="stable")
            items = np.repeat(np.array([i for _, i in rows]), [len(k) for k, _ in rows])
            self.runs[size] = (keys[order], items[order], np.concatenate([np.arange(len(k)) for k, _ in rows])[order])

    def keys(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """For each walk and sample the keys of the windows of ``n`` words at ``starts``, cut at ``ends``."""
        size = len(text)
        room = np.minimum(n, ends - starts)
        for walk in range(self.walks):
            steps = (self.shares[walk] * 2 * n).astype(np.int64)
            sampled = set(steps.ravel().tolist())
            added, times = self._step_keys(walk, int(steps.max()) + 1)
            keys = np.zeros((self.samples, len(starts)), np.uint64)
            pointer = np.zeros(len(starts), np.int64)
            for step in range(int(steps.max()) + 1):
                at = starts + pointer
                symbol = text[np.minimum(at, size - 1)]
                symbol = np.where(pointer < room, symbol, self.other + 1)
                for sample, position in zip(*np.nonzero(steps == step)) if step in sampled else ():
                    mixed = (symbol + 1).astype(np.uint64) * self.mixers[walk, sample, position]
                    keys[sample] += mixed ^ (mixed >> np.uint64(29))
                bits = (self.hashed[np.minimum(symbol, self.other)] + added[step]) * times[step] >> np.uint64(63)
                pointer += bits.view(np.int64)
            for sample in range(self.samples):
                yield walk, sample, keys[sample]

    def run_hits(self, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(item, place, offset): runs of items that stand unchanged at a place in the text."""
        base = np.uint64(self.other + 2)
        known = text != self.other
        for size, (keys, items, offsets) in self.runs.items():
            if len(text) < size:
                continue
            good = known[: len(text) - size + 1].copy()
            for i in range(1, size):
                good &= known[i : len(text) - size + 1 + i]
            at = np.flatnonzero(good)
            if len(at) == 0:
                continue
            key = np.zeros(len(at), np.uint64)
            for i in range(size):
                key = key * base + (text[at + i] + 1).astype(np.uint64)
            low = np.searchsorted(keys, key)
            hit = keys[np.minimum(low, len(keys) - 1)] == key
            if hit.any():
                at, low, key = at[hit], low[hit], key[hit]
                counts = np.searchsorted(keys, key, "right") - low
                rows = np.repeat(low - np.append(0, np.cumsum(counts)[:-1]), counts) + np.arange(counts.sum())
                yield items[rows], np.repeat(at, counts), offsets[rows]

    def windows(self, flat: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> dict[int, np.ndarray]:
        """Starts of windows by item length: around each hit as far as the edits can shift it.

        A text with fewer words than an item keeps after its edits cannot hold it and gets no window.
        """
        found: dict[int, list[np.ndarray]] = {}
        for items, at, offsets in self.run_hits(flat):
            texts = np.searchsorted(begins, at, "right") - 1
            fits = (ends - begins)[texts] >= (self.lengths - self.allowed)[items]
            items, at, offsets, texts = items[fits], at[fits], offsets[fits], texts[fits]
            lengths = self.lengths[items]
            for n in np.unique(lengths).tolist():
                k, of_n = edits_allowed(n, self.similarity), lengths == n
                around, within = (at - offsets)[of_n], texts[of_n]
                lows, highs = (np.clip(around + x, begins[within], ends[within] - 1) for x in (-k, k))
                order = np.lexsort((highs, lows))
                lows, highs = lows[order], highs[order]
                # stretches that overlap are merged before their places are listed
                new = np.append(True, lows[1:] > highs[:-1])
                sizes = highs[np.append(new[1:], True)] + 1 - lows[new]
                places = np.arange(sizes.sum()) + np.repeat(lows[new] - (np.cumsum(sizes) - sizes), sizes)
                found.setdefault(n, []).append(places)
        return {n: np.unique(np.concatenate(x)) for n, x in found.items()}

    def matches(self, texts: list[np.ndarray]) -> Iterator[tuple[int, object, int, int, int]]:
        """(text, item id, edits, item's words, last word's place): the best match of each item in each text.

        The texts lie one behind the other with a word between them that no item has.
        """
        if not self.items or not texts:
            return
        gap = np.array([self.other])
        flat = np.concatenate([x for text in texts for x in (text, gap)])
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        begins = ends - [len(t) for t in texts]
        found: dict[tuple[int, int], set[int]] = {}
        for n, starts in self.windows(flat, begins, ends).items():
            for a in range(0, len(starts), WINDOWS):
                part = starts[a : a + WINDOWS]
                within = np.searchsorted(begins, part, "right") - 1
                for walk, sample, keys in self.keys(flat, part, ends[within], n):
                    known, items = self.tables[n, walk, sample]
                    low = np.searchsorted(known, keys)
                    hit = np.flatnonzero(known[np.minimum(low, len(known) - 1)] == keys)
                    high = np.searchsorted(known, keys[hit], "right")
                    for text, start, first, last in zip(within[hit].tolist(), part[hit].tolist(), low[hit].tolist(), high.tolist()):
                        for item in items[first:last].tolist():
                            found.setdefault((text, item), set()).add(start - int(begins[text]))
        for (text, item), starts in sorted(found.items()):
            n, k = int(self.lengths[item]), int(self.allowed[item])
            edits, end = self._verify(item, texts[text], sorted(starts))
            if edits <= k:
                yield text, self.ids[item], edits, n, end

    def _verify(self, item: int, text: np.ndarray, starts: list[int]) -> tuple[int, int]:
        """Least edits and last word around the windows; those that overlap are taken as one stretch."""
        n, k = int(self.lengths[item]), int(self.allowed[item])
        best, first, last = (k + 1, 0), starts[0], starts[0] + n + 2 * k
        for start in [*starts[1:], None]:
            if start is None or start - k > last:
                a = max(0, first - k)
                edits, end = best_alignment(self.items[item], text[a:last])
                best = min(best, (edits, a + end))
                first = start
            last = last if start is None else start + n + 2 * k
        return best


class WordIds(dict):
    """Ids of raw words by an index; -1 for words that are left out. Forgets when it grows too large."""

    def __init__(self, index: Index):
        super().__init__()
        self.known, self.other = index.vocabulary, index.other

    def __missing__(self, raw: str) -> int:
        word = raw.strip(_EDGES)
        self[raw] = number = self.known.get(word, self.other) if word else -1
        return number

    def of(self, text: str) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        raw = text.lower().split()
        ids = np.fromiter(map(self.__getitem__, raw), np.int64, len(raw))
        return ids[ids >= 0]


def in_blocks(benchmark: DataFrame, item_column: str, text_column: str, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """block, item_id, text of the different items, and the number of blocks.

    Blocks hold up to ``block_bytes`` of text. Items of more than an eighth of that are placed one by
    one and the others in groups by hash; an item longer than a block is a block. The driver sees the
    sizes of groups and long items, no text.
    """
    size, hashed = F.octet_length("text") + F.lit(64), F.xxhash64("item_id", "text")
    items = benchmark.select(F.col(item_column).alias("item_id"), F.col(text_column).alias("text")).where("text is not null").distinct()
    items = cut(items.withColumn("size", size.cast("bigint")).withColumn("hashed", hashed))
    total = items.agg(F.sum("size")).first()[0] or 0
    groups, long = 64 * -(-total // block_bytes), F.col("size") > block_bytes // 8
    items = items.withColumn("long", long).withColumn("unit", F.when(long, F.col("hashed")).otherwise(F.pmod("hashed", F.lit(max(1, groups)))))
    block, filled, placed = 0, 0, []
    for is_long, unit, n in sorted(map(tuple, items.groupBy("long", "unit").agg(F.sum("size")).collect())):
        if filled and filled + n > block_bytes:
            block, filled = block + 1, 0
        filled += n
        placed.append((is_long, unit, block))
    where = benchmark.sparkSession.createDataFrame(placed, "long boolean, unit bigint, block int")
    return items.join(where, ["long", "unit"]).select("block", "item_id", "text"), block + bool(placed)


def stored_indexes(
    benchmark: DataFrame, item_column: str, text_column: str, similarity: float, walks: int, samples: int, block_bytes: int
) -> list[str]:
    """Paths of the blocks' indexes: each is built by the task that has the block and written below
    the shared folder, an attempt under its own name."""
    items, count = in_blocks(benchmark, item_column, text_column, block_bytes)
    if not count:
        return []
    folder = new_folder(benchmark.sparkSession, "benchmark")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        store.create_dir(base, recursive=True)
        done, block, held = [], None, []

        def close() -> None:
            name = f"block-{block:06d}-{uuid.uuid4().hex}"
            with store.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(pickle.dumps(vars(Index(similarity, walks, samples).build(sorted(held, key=repr)))))
            done.append((block, f"{folder}/{name}"))
            held.clear()

        for batch in batches:
            for number, item, text in zip(*(c.to_pylist() for c in batch.columns)):
                if block is not None and number != block:
                    close()
                block = number
                held.append((item, text))
        if held:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int32(), pa.string()))], names=["block", "path"])

    tasks = min(count, 100_000)
    spread = items.repartitionById(tasks, F.col("block") % tasks).sortWithinPartitions("block")
    return [r["path"] for r in cut(spread.mapInArrow(build, "block int, path string")).orderBy("block").collect()]


class Opened:
    """The stored indexes, one in memory at a time; a single one stays open."""

    def __init__(self, paths: list[str]):
        self.paths, self.at = paths, None

    def __iter__(self) -> Iterator[tuple[Index, WordIds]]:
        for path in self.paths:
            if self.at != path:
                self.one = None  # let go before the next is read
                folder, _, name = path.rpartition("/")
                store, base = opened(folder)
                with store.open_input_stream(f"{base}/{name}", compression=None) as file:
                    index = Index(0, 0, 0)
                    vars(index).update(pickle.loads(file.read()))
                self.at, self.one = path, (index, WordIds(index))
            yield self.one


def _held_together(batches: Iterator[pa.RecordBatch], column: int, paths: list[str]) -> Iterator[pa.RecordBatch]:
    """The batches in slices: as they come for one block, else of up to HELD_BYTES, since each slice
    opens all blocks."""
    if len(paths) < 2:
        yield from batches
        return
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += pc.sum(pc.fill_null(pc.binary_length(batch.column(column)), 0)).as_py() or 0
        if size > HELD_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    similarity: float = SIMILARITY,
    walks: int = WALKS,
    samples: int = SAMPLES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, item_id, edits, item_words, last_word: a row per document and item that it holds.

    An item is held if some stretch of the whole text is within (1 - similarity) times the item's
    words of it in word edits; ``edits`` are the fewest and ``last_word`` the place where the first
    such stretch ends, counted over the normalised words. Null or empty texts hold nothing, items
    without words are never held, repeated documents give a row each, equal items too.
    The benchmark is the query set: its blocks lie in the shared folder and a task opens them one
    after the other, so its memory holds one block (bounded by ``block_bytes`` or one longer item),
    however many there are. Documents are read once and not shuffled.
    """
    item_type = benchmark.schema[item_column].dataType
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_column].dataType), T.StructField("item_id", item_type)]
        + [T.StructField(c, T.LongType()) for c in ("edits", "item_words", "last_word")]
    )
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    paths = stored_indexes(benchmark, item_column, item_text_column, similarity, walks, samples, block_bytes)
    if not paths:
        return docs.sparkSession.createDataFrame([], schema)
    item_arrow = to_arrow_type(item_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = Opened(paths)
        for batch in _held_together(batches, 1, paths):
            for index, ids in indexes:
                for part in parts(batch, 1):
                    rows = list(index.matches([ids.of(text or "") for text in part.column(1).to_pylist()]))
                    if rows:
                        at, items, *numbers = zip(*rows)
                        columns = [part.column(0).take(pa.array(at)), pa.array(items, item_arrow), *map(pa.array, numbers)]
                        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return texts.mapInArrow(run, schema)


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    similarity: float = SIMILARITY,
    walks: int = WALKS,
    samples: int = SAMPLES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that hold no item, in its columns.

    Every row is judged by its own text where it is read, so nothing is shuffled and repeated and null
    ids need no rule; each block of the benchmark takes out rows that the next one need not see. A
    task opens the blocks one after the other, see ``find_leaks``.
    """
    at = docs.columns.index(text_column)
    paths = stored_indexes(benchmark, item_column, item_text_column, similarity, walks, samples, block_bytes)
    if not paths:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = Opened(paths)
        for batch in _held_together(batches, at, paths):
            clean = np.ones(batch.num_rows, bool)
            for index, ids in indexes:
                left = np.flatnonzero(clean)
                first = 0
                for part in parts(batch.filter(pa.array(clean)), at):
                    for match in index.matches([ids.of(text or "") for text in part.column(at).to_pylist()]):
                        clean[left[first + match[0]]] = False
                    first += part.num_rows
            yield batch if clean.all() else batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
