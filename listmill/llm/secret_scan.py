"""Secrets in texts: a keyword automaton, anchored patterns where it hits, checksums inside the match.

One Aho-Corasick pass finds the keywords of all kinds; a kind's pattern is tried only where one of
its keywords begins, never searched. Kinds that carry a checksum are kept only if it holds, so a
random string of the same shape is not reported. A kind without a keyword (hex) is found by a run of
its character class of the least length.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from listmill.llm.common import fresh, parts

# Alphabets of the checksums.
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BECH32 = b"qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def base62(value: int, digits: int) -> bytes:
    out = bytearray()
    for _ in range(digits):
        value, digit = divmod(value, 62)
        out.append(BASE62[digit])
    return bytes(out[::-1])


def crc_tail_holds(token: bytes) -> bool:
    """Four characters of a prefix, thirty at random, and their CRC-32 as six base-62 digits."""
    return len(token) == 40 and base62(zlib.crc32(token[4:34]), 6) == token[34:]


def bech32_state(values, state: int = 1) -> int:
    for value in values:
        top, state = state >> 25, (state & 0x1FFFFFF) << 5 ^ value
        for bit, step in enumerate(BECH32_STEPS):
            if top >> bit & 1:
                state ^= step
    return state


def bech32_prefix(name: bytes) -> int:
    """The checksum's state behind a human-readable part."""
    return bech32_state([*(c >> 5 for c in name), 0, *(c & 31 for c in name)])


AGE_PREFIX = b"AGE-SECRET-KEY-"


def age_holds(token: bytes) -> bool:
    """A secret key of the age format: 74 characters, all of one case, with a Bech32 checksum."""
    data = token[len(AGE_PREFIX) + 1 :].lower()
    return len(token) == 74 and set(data) <= set(BECH32) and bech32_state(map(BECH32.index, data), bech32_prefix(AGE_PREFIX.lower())) == 1


@dataclass(frozen=True)
class Kind:
    """A kind of secret. Keywords are in lower case and no keyword of a kind lies in another."""

    name: str
    keywords: tuple[bytes, ...]
    pattern: bytes
    holds: Callable[[re.Match], bool]
    any_case: bool = False

    @functools.cached_property
    def match(self):
        return re.compile(self.pattern, re.IGNORECASE if self.any_case else 0).match


LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

#: In the order in which spans of one start are listed: the base kinds, then those with a checksum.
KINDS = (
    Kind(
        "assign",
        (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"),
        rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= LEAST_VALUE,
        any_case=True,
    ),
    Kind("access", (b"akia",), rb"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= LEAST_ACCESS),
    Kind("hex", (), rb"[0-9a-f]+", lambda m: len(m[0]) >= LEAST_HEX),
    Kind("github", (b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_"), rb"gh[pousr]_[0-9A-Za-z]+", lambda m: crc_tail_holds(m[0])),
    Kind("npm", (b"npm_",), rb"npm_[0-9A-Za-z]+", lambda m: crc_tail_holds(m[0])),
    Kind("age", (b"age-secret-key-1",), rb"AGE-SECRET-KEY-1[A-Z0-9]+", lambda m: age_holds(m[0])),
)
BASE_KINDS = ("assign", "access", "hex")

_HEX_RUN = b"h" * LEAST_HEX
_HEX_CLASS = bytes(ord("h") if chr(c) in "0123456789abcdef" else ord(" ") for c in range(256))


@functools.cache
def automaton():
    """The automaton of all keywords; a keyword leads to its length and the kinds that have it."""
    import ahocorasick

    kinds: dict[bytes, list[int]] = {}
    for number, kind in enumerate(KINDS):
        for word in kind.keywords:
            kinds.setdefault(word, []).append(number)
    built = ahocorasick.Automaton()
    for word, numbers in kinds.items():
        built.add_word(word.decode(), (len(word), tuple(numbers)))
    built.make_automaton()
    return built


def _hits(data: bytes) -> Iterator[tuple[int, int]]:
    """(kind's number, place) of each place where a kind may begin; rising within a kind."""
    # bytes.lower changes A-Z only; as Latin-1 each byte is one character to the automaton
    for last, (length, numbers) in automaton().iter(data.lower().decode("latin-1")):
        for number in numbers:
            yield number, last + 1 - length
    classes = data.translate(_HEX_CLASS)
    at = classes.find(_HEX_RUN)
    while at >= 0:
        yield BASE_KINDS.index("hex"), at
        after = classes.find(b" ", at)
        at = classes.find(_HEX_RUN, after) if after >= 0 else -1


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then in the order of KINDS.

    Within a kind matches are leftmost and do not overlap; a match that fails its check still takes
    its place, as in a search over the text.
    """
    data = (text or "").encode()
    free, found = [0] * len(KINDS), []
    for number, at in _hits(data):
        if at >= free[number] and (m := KINDS[number].match(data, at)):
            free[number] = m.end()
            if KINDS[number].holds(m):
                found.append((at, number, m.end()))
    if found and len(data) > len(text):  # bytes to code points, from left to right
        places, point, before = {}, 0, 0
        for place in sorted({p for at, _, end in found for p in (at, end)}):
            point += len(data[before:place].decode())
            before = place
            places[place] = point
        found = [(places[at], number, places[end]) for at, number, end in found]
    return [(KINDS[number].name, at, end) for at, number, end in sorted(found)]


SPANS_TYPE = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, text_column: str = "text", spans_column: str = "spans") -> DataFrame:
    """``docs`` with the spans of secrets in each whole text, in place of the text.

    A null or empty text has no spans. Repeated rows are scanned each by itself; an empty table
    gives no rows; other columns are carried along, and a column that has the new one's name (other
    than the text) is an error. Spans of different kinds may overlap. Texts are neither shuffled nor
    cut; a very long one is worked on by itself.
    """
    rest = [c for c in docs.columns if c != text_column]
    if spans_column.lower() in {c.lower() for c in rest}:
        raise ValueError(f"there is a column {spans_column} already; try {fresh(docs, spans_column)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, len(rest)):
                rows = [[dict(zip(("kind", "start", "end"), s)) for s in spans(t)] for t in part.column(len(rest)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], pa.array(rows, _ARROW_SPANS)], names=[*rest, spans_column])

    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField(spans_column, SPANS_TYPE)])
    return docs.select(*rest, text_column).mapInArrow(run, schema)
