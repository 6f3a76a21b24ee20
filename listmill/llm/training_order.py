"""Training order: every fixed-length sequence of tokens gets a global slot, and shards hold slots in order.

The documents' tokens form one stream, an end token behind each document; the stream is cut into
sequences of equal length. A keyed Feistel network over the next power of four, walked until it
falls below the number of sequences, permutes the sequence numbers into slots: no table of the
order is kept, and any slot's sequence can be computed. A shard is a file of consecutive slots, all
of one stride, so slot s lies at a known byte and reading can begin anywhere.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listmill.engine import cut
from listmill.llm import bpe
from listmill.llm.files import new_folder, opened

SEQUENCE_TOKENS = 2048
SHARD_BYTES = 16 << 20
ROUNDS = 6

MANIFEST = "shard int, path string, first_slot bigint, sequences bigint, bytes bigint"


def _mixed(values: np.ndarray, key: int) -> np.ndarray:
    """Scrambles unsigned 64-bit integers under a key (the finaliser of SplitMix64)."""
    x = values + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Permutation:
    """A keyed bijection of 0 .. size - 1."""

    size: int
    key: int

    def _half_bits(self) -> int:
        return max(1, -(-max(1, self.size - 1).bit_length() // 2))

    def _round_keys(self) -> list[int]:
        base = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return _mixed(base, self.key & (1 << 64) - 1).tolist()

    def _network(self, x: np.ndarray, inverse: bool) -> np.ndarray:
        bits = np.uint64(self._half_bits())
        mask = np.uint64((1 << int(bits)) - 1)
        left, right = x >> bits, x & mask
        for key in reversed(self._round_keys()) if inverse else self._round_keys():
            if inverse:
                left, right = right ^ (_mixed(left, key) & mask), left
            else:
                left, right = right, left ^ (_mixed(right, key) & mask)
        return left << bits | right

    def _walk(self, values, inverse: bool) -> np.ndarray:
        out = np.array(values, np.uint64)
        todo = np.arange(len(out))
        while len(todo):  # a cycle leads back below the size, after two steps on average at most four
            out[todo] = self._network(out[todo], inverse)
            todo = todo[out[todo] >= self.size]
        return out.astype(np.int64)

    def slots(self, sequences) -> np.ndarray:
        return self._walk(sequences, False)

    def sequences(self, slots) -> np.ndarray:
        return self._walk(slots, True)


@dataclass(frozen=True)
class Layout:
    """What a reader must know: token width in bytes, tokens of a sequence, number of tokens, and the key."""

    width: int
    length: int
    tokens: int
    key: int
    shard_bytes: int

    @property
    def stride(self) -> int:
        return self.width * self.length

    @property
    def sequences(self) -> int:
        return -(-self.tokens // self.length)

    @property
    def per_shard(self) -> int:
        return max(1, self.shard_bytes // self.stride)

    @property
    def shards(self) -> int:
        return -(-self.sequences // self.per_shard)

    @property
    def order(self) -> Permutation:
        return Permutation(self.sequences, self.key)


def materialise(
    docs: DataFrame,
    folder: str,
    key: int,
    ids_column: str = "ids",
    width: int = 2,
    end: bytes = b"\xff\xff",
    length: int = SEQUENCE_TOKENS,
    shard_bytes: int = SHARD_BYTES,
) -> tuple[DataFrame, Layout]:
    """Writes the shards of ``docs``; returns their stored manifest and the layout.

    ``ids_column`` holds a document's token ids, each of ``width`` bytes; ``end`` is the id behind
    each document, which also fills the last sequence. Null and empty documents are their end alone.
    Documents follow each other as they are read: ``docs`` must come from files (see ``cut``), so
    that both passes meet the same partitions; a task that meets others raises an error. An empty
    table gives no shard. Repeated rows are repeated in the stream. Only ids are read.

    The first pass sums the tokens of each partition, one number each for the driver; the second
    cuts the stream and sends each piece to the range of slots that its sequence belongs to. Every
    attempt of a task writes files of its own, and the manifest names those that ended well.
    """
    ids = docs.select(F.col(ids_column).alias("ids"))
    size = F.coalesce(F.octet_length("ids"), F.lit(0)).cast("bigint") + len(end)
    sums = {r[0]: r[1] for r in ids.groupBy(F.spark_partition_id()).agg(F.sum(size)).collect()}
    begins, total = {}, 0
    for part in sorted(sums):
        begins[part] = total
        total += sums[part]
    layout = Layout(width, length, total // width, key, shard_bytes)
    sent = docs.sparkSession.sparkContext.broadcast((begins, sums))
    stride = layout.stride

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        at = begin = sent.value[0].get(part, 0)
        held, held_from = bytearray(), at
        for batch in batches:
            rows: list[tuple[int, int, bytes]] = []
            for data in batch.column(0).to_pylist():
                held += data or b""
                held += end
                at = held_from + len(held)
                if at // stride > held_from // stride:
                    first = 0
                    while held_from // stride < at // stride:
                        n = stride - held_from % stride
                        rows.append((held_from // stride, held_from % stride, bytes(held[first : first + n])))
                        first, held_from = first + n, held_from + n
                    del held[:first]
            if rows:
                yield packed(rows)
        if held:
            yield packed([(held_from // stride, held_from % stride, bytes(held))])
        if at - begin != sent.value[1].get(part, 0):
            raise RuntimeError(f"partition {part} was read differently the second time")

    def packed(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        packer = zstandard.ZstdCompressor(level=3)
        sequence, place, data = zip(*rows)
        slots = layout.order.slots(np.array(sequence))
        data = [packer.compress(d) for d in data]  # half the bytes to shuffle
        return pa.RecordBatch.from_arrays([pa.array(slots), pa.array(place, pa.int64()), pa.array(data, pa.binary())], names=["slot", "place", "data"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        store.create_dir(base, recursive=True)
        done, out, path, first, slot, filled = [], None, "", 0, -1, 0
        unpacker = zstandard.ZstdDecompressor()

        def close_sequence() -> None:
            nonlocal filled
            if filled < stride:
                if slot != last_slot:
                    raise RuntimeError(f"slot {slot} has {filled} bytes")
                out.write(end * ((stride - filled) // width))
            filled = 0

        def close_shard() -> None:
            count = slot + 1 - first
            if first % layout.per_shard or count != min(layout.per_shard, layout.sequences - first):
                raise RuntimeError(f"the shard of slot {first} has {count} sequences")
            out.close()
            done.append((first // layout.per_shard, path, first, count, count * stride))

        last_slot = int(layout.order.slots([layout.sequences - 1])[0]) if layout.sequences else -1
        for batch in batches:
            for new, place, data in zip(*(c.to_pylist() for c in batch.columns)):
                if new != slot:
                    if out is not None:
                        close_sequence()
                    if out is None or new // layout.per_shard != slot // layout.per_shard:
                        if out is not None:
                            close_shard()
                        name = f"shard-{new // layout.per_shard:06d}-{uuid.uuid4().hex}.bin"
                        path, first = f"{folder}/{name}", new
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    elif new != slot + 1:
                        raise RuntimeError(f"slot {slot + 1} is missing")
                    slot = new
                if place != filled:
                    raise RuntimeError(f"slot {slot} lacks bytes from {filled} to {place}")
                data = unpacker.decompress(data)
                out.write(data)
                filled += len(data)
        if out is not None:
            close_sequence()
            close_shard()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), manifest_types)], names=manifest_names)

    manifest_names = [c.split()[0] for c in MANIFEST.split(", ")]
    manifest_types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    pieces = ids.mapInArrow(cut_up, "slot bigint, place bigint, data binary")
    ranges = max(1, min(layout.shards, 100_000))
    part = F.expr(f"cast((slot div {layout.per_shard}) * {ranges} div {max(1, layout.shards)} as int)")
    return cut(pieces.repartitionById(ranges, part).sortWithinPartitions("slot", "place").mapInArrow(write, MANIFEST)), layout


def read_shards(manifest: DataFrame, layout: Layout, first_slot: int = 0, with_data: bool = True) -> DataFrame:
    """slot, sequence, shard, first_byte, n_tokens, crc32 and data of all slots from ``first_slot`` on.

    Each task reads shards from front to back; rows of a shard come in the order of slots, and a
    reader that stopped goes on at the slot it wants next. The last sequence's filling is not
    counted in ``n_tokens`` but is in ``data`` and ``crc32``.
    """
    stride, at_once = layout.stride, max(1, (4 << 20) // layout.stride)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path, first, count in zip(*(c.to_pylist() for c in batch.columns)):
                folder, _, name = path.rpartition("/")
                store, base = opened(folder)
                with store.open_input_file(f"{base}/{name}") as file:
                    begin = max(first, first_slot)
                    file.seek((begin - first) * stride)
                    for a in range(begin, first + count, at_once):
                        slots = np.arange(a, min(a + at_once, first + count))
                        data = file.read(len(slots) * stride)
                        if len(data) < len(slots) * stride:
                            raise OSError(f"{path} is cut off")
                        rows = [data[i : i + stride] for i in range(0, len(data), stride)]
                        sequences = layout.order.sequences(slots)
                        tokens = np.minimum(layout.length, layout.tokens - sequences * layout.length)
                        columns = [
                            pa.array(slots), pa.array(sequences), pa.array(np.full(len(slots), shard, np.int32)), pa.array((slots - first) * stride),
                            pa.array(tokens), pa.array([zlib.crc32(r) for r in rows], pa.int64()),
                        ]
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, pa.binary())] if with_data else columns, names=names)

    schema = "slot bigint, sequence bigint, shard int, first_byte bigint, n_tokens bigint, crc32 bigint" + ", data binary" * with_data
    names = [c.split()[0] for c in schema.split(", ")]
    wanted = manifest.where(F.col("first_slot") + F.col("sequences") > first_slot).select("shard", "path", "first_slot", "sequences")
    return wanted.repartition(max(1, min(layout.shards, 100_000)), "shard").sortWithinPartitions("shard").mapInArrow(run, schema)


def token_order(docs: DataFrame, key: int, ranks: bytes, pattern: str, text_column: str = "text", length: int = SEQUENCE_TOKENS) -> DataFrame:
    """The training order of texts as BPE token ids of 2 bytes (the end mark 0xFFFF behind each text).

    The ids are computed once and stored below the shared folder, as two passes read them; shards
    are written there too and read back; a row per slot. A null or empty text is its end alone, a
    very long one runs through many sequences, repeated rows are repeated, an empty table gives no
    rows; other columns are not read.
    """
    if max(bpe.rank_of_tokens(ranks).values(), default=0) >= 0xFFFF:
        raise ValueError("an id is the end mark or above it")
    path = new_folder(docs.sparkSession, "ids")
    ids = bpe.encode(docs.select(text_column), ranks, pattern, text_column, width=2)
    # pages of ids compress to half, which the default codec does not reach
    ids.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "6").parquet(path)
    ids = docs.sparkSession.read.schema(ids.schema).parquet(path)
    manifest, layout = materialise(ids, new_folder(docs.sparkSession, "order"), key, length=length)
    return read_shards(manifest, layout, with_data=False)


def byte_order(docs: DataFrame, key: int, text_column: str = "text", length: int = SEQUENCE_TOKENS) -> DataFrame:
    """The training order of texts as byte-level tokens (a byte an id, 255, which no UTF-8 text has,
    behind each text): shards are written below the shared folder and read back; a row per slot."""
    ids = docs.select(F.encode(F.col(text_column), "UTF-8").alias("ids"))
    manifest, layout = materialise(ids, new_folder(docs.sparkSession, "order"), key, width=1, end=b"\xff", length=length)
    return read_shards(manifest, layout, with_data=False)
