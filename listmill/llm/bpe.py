"""Byte-level BPE by rank files: a hierarchical-bitmap queue of merge ranks over linked lists.

The distinct pre-tokens of a batch that are not known yet lie one behind the other in a single
linked list of bytes. A bucket per merge rank holds the positions whose pair has that rank; three
levels of 64-bit words say which buckets are in use, and find-first-set gives the next rank. All
positions of a bucket merge in one vector operation; entries that a merge made stale are skipped.
Long pre-tokens cost no more than the same bytes in short ones.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from listmill.llm.common import fresh, parts, slices

#: Distinct pre-tokens and their characters that a task remembers before it starts anew.
REMEMBERED, REMEMBERED_CHARS = 400_000, 8 << 20
#: Bytes of texts that are worked on together; the different chunks of a task then come up once or twice.
TOGETHER = 8 << 20
#: Bytes of texts whose ids are put together, decoded and handed on at once.
HANDED_ON = 2 << 20
#: Chunks of texts that are matched at once, and pre-tokens that are held as strings before Arrow takes them.
MATCHED, HELD = 1 << 15, 1 << 16
#: Bytes of pre-tokens whose first pairs are looked up at once.
STRETCH = 1 << 18


def rank_of_tokens(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}


class RankTable:
    """A rank file in arrays: the rank of each pair of tokens that makes one."""

    def __init__(self, content: bytes):
        self.ranks = rank_of_tokens(content)
        self.size = max(self.ranks.values(), default=-1) + 1
        self.byte_ids = np.array([self.ranks.get(bytes([b]), self.size) for b in range(256)], np.int64)
        get, pairs = self.ranks.get, []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = get(token[:i]), get(token[i:])
                if left is not None and right is not None:
                    pairs.append((left * (self.size + 1) + right, rank, left, right))
        table = np.array(sorted(pairs), np.int64).reshape(-1, 4)
        self.keys, self.merged = table[:, 0].copy(), table[:, 1].copy()
        # a rank is plain if no pair with its token comes before it: its merges can't be interrupted
        first = np.full(self.size, np.iinfo(np.int64).max)
        for side in (2, 3):
            np.minimum.at(first, table[:, side], table[:, 1])
        self.plain = first > np.arange(self.size)
        every = np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)
        self.byte_pairs = self.pair_ranks(*every).astype(np.int32)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it makes no token. Id ``size`` stands for no token."""
        if not len(self.keys):
            return np.full(len(left), -1)
        key = left.astype(np.int64) * (self.size + 1) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], -1)


class RankQueue:
    """Buckets of positions by rank, 4 bytes a position, and a bitmap in three levels over the buckets in use."""

    def __init__(self, size: int):
        self.low = [0] * ((size >> 6) + 1)
        self.middle = [0] * ((size >> 12) + 1)
        self.high = 0
        self.buckets: dict[int, bytearray] = {}

    def push(self, rank: int, positions: np.ndarray) -> None:
        self._push(rank, positions.astype(np.int32).tobytes())

    def _push(self, rank: int, positions: bytes) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = bytearray(positions)
            self.low[rank >> 6] |= 1 << (rank & 63)
            self.middle[rank >> 12] |= 1 << (rank >> 6 & 63)
            self.high |= 1 << (rank >> 12)
        else:
            bucket += positions

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if len(ranks) == 0:
            return
        order = np.argsort(ranks, kind="stable")
        ranks, data = ranks[order], positions[order].astype(np.int32).tobytes()
        ends = [*(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        start = 0
        for rank, end in zip(ranks[[0, *ends[:-1]]].tolist(), ends):
            self._push(rank, data[4 * start : 4 * end])
            start = end

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank in use with its positions, or None."""
        if not self.high:
            return None
        a = (self.high & -self.high).bit_length() - 1
        b = a << 6 | (self.middle[a] & -self.middle[a]).bit_length() - 1
        rank = b << 6 | (self.low[b] & -self.low[b]).bit_length() - 1
        self.low[b] &= self.low[b] - 1
        if not self.low[b]:
            self.middle[a] &= self.middle[a] - 1
            if not self.middle[a]:
                self.high &= self.high - 1
        return rank, np.frombuffer(self.buckets.pop(rank), np.int32)


def merge_pieces(table: RankTable, pieces: list[bytes]) -> list[bytes]:
    """The ids of each piece after all merges, as little-endian unsigned 32-bit integers."""
    if not pieces:
        return []
    lengths = np.array([len(p) for p in pieces])
    ends = np.cumsum(lengths)
    n = int(ends[-1])
    letters = np.frombuffer(b"".join(pieces), np.uint8)
    ids = np.full(n + 1, table.size, np.int32)
    piece = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
    following, previous = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    filled = lengths > 0
    following[ends[filled] - 1] = n  # position n stands for none
    previous[(ends - lengths)[filled]] = n
    pending = np.full(n + 1, -1, np.int32)
    stretches = [slice(a, min(a + STRETCH, n)) for a in range(0, n, STRETCH)]
    for at in stretches:
        ids[at] = table.byte_ids[letters[at]]
        right = letters[at.start + 1 : at.stop + 1]
        pending[at.start : at.start + len(right)] = table.byte_pairs[letters[at][: len(right)].astype(np.int32) << 8 | right]
    pending[ends[filled] - 1] = -1
    queue = RankQueue(table.size)
    for at in stretches:
        first = np.flatnonzero(pending[at] >= 0) + at.start
        queue.push_all(pending[first], first)
    while (popped := queue.pop()) is not None:
        rank, at = popped
        at = at[pending[at] == rank]
        if len(at) == 0:
            continue
        if len(at) > 1:
            at = np.sort(at)
            at = at[np.append(True, at[1:] != at[:-1])]
            if table.plain[rank]:
                # of positions that overlap in a chain, every second one merges, from the left
                linked = following[at[:-1]] == at[1:]
                if linked.any():
                    index = np.arange(len(at))
                    start = np.maximum.accumulate(np.where(np.append(False, linked), 0, index))
                    at = at[(index - start) % 2 == 0]
            else:
                # a merge may bring up a lower rank: only the leftmost of each piece, then look again
                leading = np.append(True, piece[at[1:]] != piece[at[:-1]])
                if not leading.all():
                    queue.push(rank, at[~leading])
                at = at[leading]
        gone = following[at]
        after = following[gone]
        ids[at], ids[gone] = rank, table.size
        following[at], previous[after] = after, at
        pending[gone] = -1
        touched = np.concatenate([at, previous[at]])
        touched = touched[touched < n]
        ranks = table.pair_ranks(ids[touched], ids[following[touched]])
        pending[touched] = ranks
        known = ranks >= 0
        queue.push_all(ranks[known], touched[known])
    kept = ids[:n] < table.size
    data = ids[:n][kept].astype("<u4").tobytes()
    counts = np.append(0, np.cumsum(kept, dtype=np.int32))[np.append(0, ends)].tolist()
    del ids, kept, piece, following, previous, pending, queue
    return [data[4 * a : 4 * b] for a, b in pairwise(counts)]


class Encoder:
    """Encodes texts; remembers the ids of pre-tokens.

    A pre-token holds a space behind other characters only if all of it is white space. So a text
    may be cut before each space that other text precedes and no white space follows; a text with a
    chunk that begins with white space is matched whole. Of the chunks, and then of the pre-tokens
    in them, only the different ones are looked at; Arrow numbers them and puts their ids in place.
    """

    def __init__(self, table: RankTable, pattern: str):
        self.table, self.pattern = table, regex.compile(pattern)
        self._forget()

    def _forget(self) -> None:
        self.pieces: dict[str, bytes] = {}
        self.chars = 0

    def _learn(self, pieces: list[str]) -> None:
        get, known = self.table.ranks.get, self.pieces
        new = [p for p in pieces if p not in known]
        raw = [p.encode() for p in new]
        ranks = [get(r) for r in raw]
        merge = [i for i, rank in enumerate(ranks) if rank is None]
        known.update((p, rank.to_bytes(4, "little")) for p, rank in zip(new, ranks) if rank is not None)
        known.update(zip([new[i] for i in merge], merge_pieces(self.table, [raw[i] for i in merge])))
        self.chars += sum(map(len, new))

    def _matches(self, texts: Iterable[str]) -> tuple[pa.ChunkedArray, np.ndarray]:
        """The pre-tokens of texts one behind the other, and where those of each text begin and end."""
        counts, held, taken = [0], [], []
        for text in texts:
            found = self.pattern.findall(text)
            counts.append(len(found))
            held += found
            if len(held) >= HELD:
                taken.append(pa.array(held, pa.large_string()))
                held = []
        return pa.chunked_array([*taken, pa.array(held, pa.large_string())]), np.cumsum(counts)

    def _ids(self, pieces: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
        """The ids of each pre-token, and which of them begin with a space."""
        if not len(pieces):
            return pa.array([], pa.large_binary()), np.zeros(0, bool)
        coded = pieces.dictionary_encode().chunks  # they share one dictionary
        indices = np.concatenate([c.indices.to_numpy() for c in coded])
        dictionary = coded[-1].dictionary
        del coded, pieces
        different = dictionary.to_pylist()
        self._learn(different)
        ids = pa.array([self.pieces[p] for p in different], pa.large_binary())
        spaced = pc.starts_with(dictionary, " ").to_numpy(zero_copy_only=False)
        return ids.take(pa.array(indices)), spaced[indices]

    def _chunk_ids(self, chunks: pa.Array) -> pa.Array:
        """The ids of chunks that have a space before them and do not begin with white space."""
        if not len(chunks):
            return pa.array([], pa.large_binary())
        cuts = pa.array([*range(0, len(chunks), MATCHED), len(chunks)], pa.int64())
        lines = pc.binary_join(pa.LargeListArray.from_arrays(cuts, chunks), pa.scalar(" ", pa.large_string()))
        ids, spaced = self._ids(self._matches(" " + line.as_py() for line in lines)[0])
        return joined(ids, np.append(np.flatnonzero(spaced), len(ids)))

    def _text_ids(self, texts: Iterable[str]) -> pa.Array:
        """The ids of texts that are matched whole."""
        pieces, ends = self._matches(texts)
        return joined(self._ids(pieces)[0], ends)

    def encode_slices(self, texts: pa.Array, width: int = 4) -> Iterator[pa.Array]:
        """The ids of each text, ``width`` bytes an id, for one slice of the texts after the other; texts are not null."""
        if not len(texts):
            return
        if len(self.pieces) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self._forget()
        split = pc.split_pattern(texts.cast(pa.large_string()), " ")
        begins, chunks = split.offsets.to_numpy(), split.values.dictionary_encode()
        heads = split.values.take(pa.array(begins[:-1]))
        codes, different = chunks.indices.to_numpy(), chunks.dictionary
        del split, chunks
        first = pc.utf8_slice_codeunits(different, 0, 1).dictionary_encode()
        usable = np.array([not (not c or c.isspace()) for c in first.dictionary.to_pylist()], bool)[first.indices.to_numpy()]
        # a text is a row of values: first what has no space before it, then the chunks
        whole = np.logical_or.reduceat(~usable[codes], begins[:-1])
        rows = (np.cumsum(usable, dtype=np.int32) - 1)[codes]
        n = int(usable.sum())
        rows[np.repeat(whole, np.diff(begins))] = n + len(heads)  # nothing more
        rows[begins[:-1]] = n + np.arange(len(heads))
        own = different.filter(pa.array(usable))
        del codes, different, first
        ids = [self._chunk_ids(own), self._text_ids((texts if w else heads)[i].as_py() for i, w in enumerate(whole.tolist()))]
        ids = narrowed(pa.concat_arrays([*ids, pa.array([b""], pa.large_binary())]), width)
        del own, heads
        for a, b in slices(texts, HANDED_ON):
            yield joined(ids.take(pa.array(rows[begins[a] : begins[b]])), begins[a : b + 1] - begins[a])

    def encode_column(self, texts: pa.Array, width: int = 4) -> pa.Array:
        """The ids of each text, ``width`` bytes an id; texts are not null."""
        return pa.concat_arrays([pa.array([], pa.large_binary()), *self.encode_slices(texts, width)])

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_column(pa.array(texts, pa.large_string())).to_pylist()


def joined(values: pa.Array, begins: np.ndarray) -> pa.Array:
    """The values from each begin to the next one, joined."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    return pa.Array.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(at[begins].astype(np.int64)), data])


def narrowed(ids: pa.Array, width: int) -> pa.Array:
    """Ids of 4 bytes as ids of ``width`` bytes."""
    if width == 4:
        return ids
    _, offsets, data = ids.buffers()
    at = np.frombuffer(offsets, np.int64)[ids.offset : ids.offset + len(ids) + 1]
    short = np.frombuffer(data or b"", "<u4", int(at[-1]) // 4).astype("<u2")
    return pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(at // 2), pa.py_buffer(short)])


_TABLES: dict[int, RankTable] = {}


def rank_table(content: bytes) -> RankTable:
    """One table per worker and rank file; what an encoder remembers goes with its task."""
    key = hash(content)
    if key not in _TABLES:
        _TABLES[key] = RankTable(content)
    return _TABLES[key]


def rank_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def decoded(ids: bytes | None, tokens: dict[int, bytes], width: int = 4) -> bytes:
    return b"".join([tokens[i] for i in np.frombuffer(ids or b"", f"<u{width}").tolist()])


def encode(
    df: DataFrame, ranks: bytes, pattern: str, text_column: str = "text", ids_column: str = "ids", decoded_column: str | None = None, width: int = 4
) -> DataFrame:
    """``df`` with the text column replaced by its token ids: binary, ``width`` (2 or 4) little-endian bytes an id.

    The ids are those of the tiktoken library without special tokens: each match of ``pattern`` is
    merged by itself, a match that is a token as a whole is that token. A null text counts as empty
    and has no ids. ``ranks`` is the content of a rank file; it has as many lines as the vocabulary,
    so the broadcast does not grow with the data. If a column is already called ``ids_column``, the
    new one gets underscores before its name. With ``decoded_column`` the ids are decoded again where
    they are made, as ``decode`` would do it in a pass of its own.
    """
    if width not in (2, 4) or max(rank_of_tokens(ranks).values(), default=0) >= 1 << 8 * width:
        raise ValueError(f"ids do not fit into {width} bytes")
    rest = [c for c in df.columns if c != text_column]
    ids_column = fresh(df.select(*rest), ids_column)
    made = [ids_column, *([fresh(df.select(*rest), decoded_column)] if decoded_column else [])]
    sent = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(rank_table(sent.value), pattern)
        tokens = {rank: token for token, rank in coder.table.ranks.items()}
        for batch in batches:
            for part in parts(batch, len(rest), TOGETHER):
                done = 0
                for ids in coder.encode_slices(pc.fill_null(part.column(len(rest)), ""), width):
                    columns = [ids.cast(pa.binary())]
                    if decoded_column:
                        columns.append(pa.array([decoded(x.as_py(), tokens, width) for x in ids], pa.binary()))
                    others = [c.slice(done, len(ids)) for c in part.columns[: len(rest)]]
                    yield pa.RecordBatch.from_arrays([*others, *columns], names=[*rest, *made])
                    done += len(ids)

    schema = T.StructType([*(df.schema[c] for c in rest), *(T.StructField(c, T.BinaryType()) for c in made)])
    return df.select(*rest, text_column).mapInArrow(run, schema)


def decode(df: DataFrame, ranks: bytes, ids_column: str = "ids", bytes_column: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids stand for; null ids give no bytes. Unknown ids raise an error."""
    columns = df.columns
    bytes_column = fresh(df, bytes_column)
    at = columns.index(ids_column)
    sent = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in rank_of_tokens(sent.value).items()}
        for batch in batches:
            for part in parts(batch, at):
                out = [decoded(ids, tokens) for ids in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*columns, bytes_column])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(bytes_column, T.BinaryType())]))
