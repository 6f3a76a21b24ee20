"""A hidden Markov language model: Baum-Welch over all training documents, exact scaled likelihoods.

A state emits one of 65,535 classes of words (a hash of the word), and the class emits the word by
its share of the class's training count. The classes bound the model however many words there are;
with a class for each word it is the plain hidden Markov model. Words that training has not seen
share one symbol, as in the base score.

Documents are cut into chunks. A chunk lists its distinct words once, so the counts of words meet
the chunks, not the tokens, and a frequent word is one row a chunk.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listmill.engine import cut
from listmill.llm.common import fold_of, parts

#: States; the most rounds over all training documents, and the gain of a round per token (natural
#: logarithm) below which there is no other.
STATES, ROUNDS, LEAST_GAIN = 8, 5, 1e-3
#: Word classes; class 0 is the end of a text.
CLASSES = 1 << 16
#: Tokens of a chunk, and tokens that go through the model together; a longer text comes by itself.
CHUNK_TOKENS, TOGETHER = 4_000_000, 500_000
#: Bytes of texts that are split together, and stored partitions that one task of a round reads: a task
#: hands on a row per class, however many tokens it has seen.
SPLIT_TOGETHER, READ_TOGETHER = 4 << 20, 4
#: Share of a state's emissions that follows the counts of all states.
SHARED = 0.02
#: The first guess: documents, tokens of each, rounds, random starts. Every later count covers all
#: training documents.
GUESS_DOCS, GUESS_TOKENS, GUESS_ROUNDS, GUESSES = 2000, 300, 20, 4
SEED = 11

_CHUNKS = "chunk bigint, doc_id bigint, held_out boolean, ids binary, classes binary, word binary, local int, n bigint"


class Words(dict):
    """Numbers of words in the order of their first coming in a chunk; the end of a text is 0."""

    def __init__(self):
        super().__init__({b"": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def class_of(word: bytes) -> int:
    """The class of a word; CLASS_SQL says the same of the column ``word``."""
    if not word:
        return 0
    signed = xxhash.xxh64_intdigest(word, 42)
    return 1 + (signed - (1 << 64) * (signed >> 63)) % (CLASSES - 1)


CLASS_SQL = f"if(octet_length(word) = 0, 0, cast(1 + pmod(xxhash64(word), {CLASSES - 1}) as int))"


def packed_tokens(values: np.ndarray) -> bytes:
    """Numbers as they are stored: most are small, so they are worth compressing."""
    return zstandard.compress(values.tobytes(), 1)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def numbered(texts: pa.Array, words: Words) -> list[np.ndarray]:
    """The tokens of each text as numbers of ``words``, which learns new ones. Only the different
    words of all texts together are looked up."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = split.values.dictionary_encode()
    different = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    codes, begins = coded.indices.to_numpy(), split.offsets.to_numpy()
    if b"" in different:  # white space at an end of a text
        kept = codes != different.index(b"")
        codes, begins = codes[kept], np.append(0, np.cumsum(kept))[begins]
    numbers = np.fromiter(map(words.__getitem__, different), np.int32, len(different))
    lengths = np.diff(begins)
    out = np.zeros(len(codes) + len(lengths), np.int32)  # the end of a text is 0
    out[np.arange(len(codes)) + np.repeat(np.arange(len(lengths)), lengths)] = numbers[codes]
    return np.split(out, np.cumsum(lengths + 1)[:-1])


def chunked(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Two kinds of rows: a document's tokens (ids are its chunk's word numbers; classes only where
    they are trained on), and a chunk's words with their counts in its training documents."""
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), (fold_of(F.col(id_column)) == 1).alias("held_out"), F.col(text_column).alias("text")
    )
    names = [c.split()[0] for c in _CHUNKS.split(",")]
    types = dict(zip(names, [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int64()]))

    def packed(rows: int, columns: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[c], types[c]) if c in columns else pa.nulls(rows, types[c]) for c in names], names=names
        )

    def closed(chunk: int, words: Words, held: list[tuple[int | None, bool, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        classes = np.array([class_of(w) for w in words], np.uint16)
        counts = np.zeros(len(words), np.int64)
        for a in range(0, len(held), 2000):
            part = held[a : a + 2000]
            learned = [ids for _, out, ids in part if not out]
            if learned:
                counts += np.bincount(np.concatenate(learned), minlength=len(words))
            columns = {
                "chunk": [chunk] * len(part),
                "doc_id": [d for d, _, _ in part],
                "held_out": [h for _, h, _ in part],
                "ids": [packed_tokens(x.astype("<i4")) for _, _, x in part],
                "classes": [None if out else packed_tokens(classes[x]) for _, out, x in part],
            }
            yield packed(len(part), columns)
        listed = list(words)
        for a in range(0, len(listed), 100_000):
            part = listed[a : a + 100_000]
            b = a + len(part)
            columns = {"chunk": [chunk] * len(part), "word": part, "local": np.arange(a, b), "n": counts[a:b]}
            yield packed(len(part), columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, words, held, tokens = TaskContext.get().partitionId() << 32, Words(), [], 0
        for batch in batches:
            for part in parts(batch, 2, SPLIT_TOGETHER):
                ids = numbered(part.column(2), words)
                held += zip(part.column(0).to_pylist(), part.column(1).to_pylist(), ids)
                tokens += sum(map(len, ids))
                if tokens >= CHUNK_TOKENS:
                    yield from closed(chunk, words, held)
                    chunk, words, held, tokens = chunk + 1, Words(), [], 0
        if held:
            yield from closed(chunk, words, held)

    return rows.mapInArrow(run, _CHUNKS)


def _batches(sequences: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Numbers of the sequences, the longest first, in batches of about TOGETHER tokens."""
    lengths = np.array([len(s) for s in sequences], np.int64)
    order = np.argsort(-lengths, kind="stable")
    group = (np.cumsum(lengths[order]) - lengths[order]) // TOGETHER
    for part in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        if len(part):
            yield part


def _by_step(sequences: list[np.ndarray], part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of a batch, first those of all first steps, and where each step begins."""
    lengths = np.array([len(sequences[i]) for i in part])
    flat = np.concatenate([sequences[i] for i in part])
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")  # sequences longer than t; lengths fall
    begins = np.append(0, np.cumsum(active))
    starts = np.cumsum(lengths) - lengths
    out = np.empty(len(flat), flat.dtype)
    for t in range(len(active)):
        n = active[t]
        out[begins[t] : begins[t] + n] = flat[starts[:n] + t]
    return out, begins


@dataclass
class Model:
    """start [state], moves [state, state] and, class by class, emits [class, state]."""

    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray

    def log_likelihoods(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Natural logarithm of each sequence's probability: the forward recursion, scaled at each step."""
        out = np.zeros(len(sequences))
        for part in _batches(sequences):
            symbols, begins = _by_step(sequences, part)
            total = np.zeros(len(part))
            state, ones = None, np.ones(len(self.start))
            for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
                given = self.emits[symbols[a:b]]
                state = (self.start if state is None else state[: b - a] @ self.moves) * given
                scale = state @ ones
                state /= scale[:, None]
                total[: b - a] += np.log(scale)
            out[part] = total
        return out

    def expected_counts(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Baum-Welch's expected counts of starts, moves and emissions, and the log-likelihood."""
        k = len(self.start)
        starts, moves, emits, likelihood = np.zeros(k), np.zeros((k, k)), np.zeros_like(self.emits, np.float64), 0.0
        model_start, model_moves, model_emits = (x.astype(np.float32) for x in (self.start, self.moves, self.emits))
        for part in _batches(sequences):
            symbols, begins = _by_step(sequences, part)
            steps = list(zip(begins[:-1].tolist(), begins[1:].tolist()))
            given = model_emits[symbols]
            states, scales, ones = np.empty_like(given), np.empty(len(symbols), np.float32), np.ones(k, np.float32)
            before = None
            for a, b in steps:
                here = (model_start if before is None else before[: b - a] @ model_moves) * given[a:b]
                np.matmul(here, ones, out=scales[a:b])
                here /= scales[a:b, None]
                states[a:b] = before = here
            likelihood += float(np.log(scales, dtype=np.float64).sum())
            behind = np.ones((0, k), np.float32)
            for t in range(len(steps) - 1, -1, -1):
                a, b = steps[t]
                # what the next step gives back; sequences that end here have 1
                back = np.ones((b - a, k), np.float32)
                if len(behind):
                    a2, b2 = steps[t + 1]
                    ahead = behind * given[a2:b2] / scales[a2:b2, None]
                    back[: len(behind)] = ahead @ model_moves.T
                    moves += states[a : a + len(behind)].T @ ahead
                states[a:b] *= back  # the chance of each state at this step, given the whole text
                behind = back
            starts += states[: begins[1]].sum(axis=0, dtype=np.float64)
            for s in range(k):
                emits[:, s] += np.bincount(symbols, states[:, s], len(emits))
        return starts, moves * self.moves, emits, likelihood


def estimated(starts: np.ndarray, moves: np.ndarray, emits: np.ndarray, shared: np.ndarray) -> Model:
    """The model of expected counts; a share of the emissions follows ``shared``, the distribution of all classes."""
    emits = emits / np.maximum(emits.sum(axis=0), 1e-30)
    emits = (1 - SHARED) * emits + SHARED * shared[:, None]
    moves, starts = moves + 0.1, starts + 0.1
    return Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))


def first_guess(sequences: list[np.ndarray], shared: np.ndarray, states: int) -> Model:
    """A model from some rounds over a few pieces of text, so that the rounds over all begin with
    states that differ: the likeliest of a few random starts, each piece given to one state."""
    stay = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(stay, 0.9)
    best, likeliest = None, -np.inf
    for start in range(GUESSES):
        rng = np.random.default_rng(SEED + start)
        emits = 20 * shared[:, None] * rng.uniform(0.5, 1.5, (CLASSES, states))
        for s, seq in zip(rng.integers(0, states, len(sequences)).tolist(), sequences):
            np.add.at(emits[:, s], seq, 1)
        model = estimated(np.ones(states), stay * 100, emits, shared)
        for _ in range(GUESS_ROUNDS // 2):
            *counts, likelihood = model.expected_counts(sequences)
            model = estimated(*counts, shared)
        if likelihood > likeliest:
            best, likeliest = model, likelihood
    for _ in range(GUESS_ROUNDS // 2):
        best = estimated(*best.expected_counts(sequences)[:3], shared)
    return best


def train_round(texts: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts over all rows of ``classes`` and the log-likelihood of them under ``model``:
    summed in each task, then added up by class.

    A task gives one row per class it has met, so the driver receives at most CLASSES rows; a task reads
    several stored partitions, as the rows that are shuffled grow with the tasks.
    """
    k = len(model.start)
    sent = texts.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    columns = [f"s{i}" for i in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(sent.value)
        starts, moves, emits, likelihood = np.zeros(k), np.zeros((k, k)), np.zeros_like(own.emits, np.float64), 0.0
        held, tokens = [], 0

        def add() -> None:
            nonlocal starts, moves, emits, likelihood
            a, b, c, d = own.expected_counts(held)
            starts, moves, emits, likelihood = starts + a, moves + b, emits + c, likelihood + d

        for batch in batches:
            for data in batch.column(0).to_pylist():
                held.append(unpacked(data, "<u2"))
                tokens += len(held[-1])
                if tokens >= CHUNK_TOKENS:
                    add()
                    held, tokens = [], 0
        if held:
            add()
        used = np.flatnonzero(emits.sum(axis=1))
        rows = np.concatenate([emits[used], moves, starts[None, :]])
        at = np.concatenate([used, -1 - np.arange(k), [-1 - k]]).astype(np.int64)
        values = [pa.array(rows[:, i].astype(np.float32)) for i in range(k)]
        likelihoods = np.where(at == -1 - k, likelihood, 0.0)
        yield pa.RecordBatch.from_arrays([pa.array(at), *values, pa.array(likelihoods)], names=["at", *columns, "likelihood"])

    schema = ", ".join(["at bigint", *(f"{c} float" for c in columns), "likelihood double"])
    stored = texts.rdd.getNumPartitions()
    tasks = max(-(-stored // READ_TOGETHER), min(stored, texts.sparkSession.sparkContext.defaultParallelism), 1)
    sums = texts.select("classes").coalesce(tasks).mapInArrow(run, schema).groupBy("at").agg(*(F.sum(c).alias(c) for c in [*columns, "likelihood"]))
    starts, moves, emits, likelihood = np.zeros(k), np.zeros((k, k)), np.zeros((CLASSES, k)), 0.0
    for row in sums.collect():
        values, likelihood = row[1:-1], likelihood + row[-1]
        if row[0] >= 0:
            emits[row[0]] = values
        elif row[0] >= -k:
            moves[-1 - row[0]] = values
        else:
            starts[:] = values
    return starts, moves, emits, likelihood


def trained(texts: DataFrame, model: Model, shared: np.ndarray, tokens: int, rounds: int = ROUNDS, least_gain: float = LEAST_GAIN) -> tuple[Model, list[float]]:
    """Rounds over all training documents until the likelihood stops rising or ``rounds`` are done:
    the last model, and the log-likelihood per token under the model that each round began with."""
    per_token: list[float] = []
    for _ in range(rounds):
        *counts, likelihood = train_round(texts, model)
        per_token.append(likelihood / max(1, tokens))
        model = estimated(*counts, shared)
        if len(per_token) > 1 and per_token[-1] - per_token[-2] < least_gain:
            break
    return model, per_token


def sample_pieces(texts: DataFrame) -> list[np.ndarray]:
    """A bounded sample: for the GUESS_DOCS documents that a hash puts first, some tokens from anywhere
    in each. Tasks hand on only what lies below a bar set for about twice as many."""
    total = texts.count()
    bar = min(1 << 63, (2 * GUESS_DOCS << 63) // max(1, total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn, pieces = [], []
            for data in batch.column(0).to_pylist():
                draw = xxhash.xxh64_intdigest(data) >> 1
                if draw < bar:
                    tokens = unpacked(data, "<u2")
                    at = draw % max(1, len(tokens) - GUESS_TOKENS)
                    drawn.append(draw)
                    pieces.append(tokens[at : at + GUESS_TOKENS].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(drawn, pa.int64()), pa.array(pieces, pa.binary())], names=["h", "p"])

    # equal texts are drawn together and count once
    chosen = texts.select("classes").mapInArrow(run, "h bigint, p binary").groupBy("h").agg(F.first("p").alias("p"))
    return [np.frombuffer(r["p"], "<u2") for r in chosen.orderBy("h").limit(GUESS_DOCS).collect()]


@dataclass
class Scorer:
    """The model with the training counts that turn classes into words."""

    model: Model
    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_words: np.ndarray

    def __post_init__(self) -> None:
        unseen = 0.5 / (self.tokens + 0.5 * (self.distinct + 1))
        m = self.model
        # one more symbol, for all words that training has not seen
        emits = np.vstack([m.emits * (1 - unseen), np.full((1, len(m.start)), unseen)])
        self.full = Model(m.start, m.moves, emits)

    def score(self, ids: list[np.ndarray], classes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        """n_tokens, n_known, base score and score of documents, given each word number's class and
        training count; numbers beyond those are unseen words."""
        n = np.array([len(x) for x in ids])
        begins = np.cumsum(n) - n
        word = np.concatenate(ids)
        seen = word < len(counts)
        word = np.where(seen, word, 0)
        kind, c = classes[word], np.where(seen, counts[word], 0)
        known = c > 0
        base = np.add.reduceat(np.log10((c + 0.5) / (self.tokens + 0.5 * (self.distinct + 1))), begins)
        n_known = np.add.reduceat(known.astype(np.int64), begins)
        if not self.tokens:
            return n, n_known, base, base
        below = self.class_tokens[kind] + 0.5 * self.class_words[kind]
        inside = np.add.reduceat(np.log10(np.where(known, (c + 0.5) / np.where(known, below, 1), 1)), begins)
        symbols = np.split(np.where(known, kind, CLASSES), begins[1:])
        return n, n_known, base, inside + self.full.log_likelihoods(symbols) / np.log(10)


def score_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Trained on the documents whose fold is not 1; null ids count as the empty text there. A null or
    empty text is its end alone. Repeated rows count and are scored each; without training documents
    the score is the base score; an empty table gives no rows. Other columns are not looked at.
    """
    stored = cut(chunked(docs, id_column, text_column))
    texts = stored.where("word is null")
    words = stored.where("word is not null").select("chunk", "word", "local", "n")
    # a word has one row per chunk, so no word is frequent here
    by_word = Window.partitionBy("word")
    numbers = cut(
        words.select(
            F.col("chunk").alias("of_chunk"),
            "local",
            F.expr(CLASS_SQL).alias("class"),
            F.sum("n").over(by_word).alias("c"),
            (F.row_number().over(by_word.orderBy("chunk")) == 1).alias("first"),
        ).where("c > 0")
    )
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in numbers.where("first").groupBy("class").agg(F.sum("c"), F.count("*")).collect():  # at most CLASSES rows
        class_tokens[row[0]], class_words[row[0]] = row[1], row[2]
    training = texts.where("classes is not null")
    shared = class_tokens + 0.5 * class_words
    shared = shared / max(1, shared.sum())
    model = Model(np.ones(1), np.ones((1, 1)), np.ones((CLASSES, 1)))
    if class_tokens.sum():
        model, _ = trained(training, first_guess(sample_pieces(training), shared, states), shared, int(class_tokens.sum()), rounds)
    scorer = Scorer(model, int(class_tokens.sum()), int(class_words.sum()), class_tokens, class_words)
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(scorer))
    train_tokens = scorer.tokens

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = pickle.loads(sent.value)
        size = 1 + (pc.max(right["local"]).as_py() or 0)
        counts, classes = np.zeros(size), np.zeros(size, np.int64)
        local = right["local"].to_numpy()
        counts[local], classes[local] = right["c"].to_numpy(), right["class"].to_numpy()
        out = []
        for batch in left.to_batches(max_chunksize=2000):
            if batch.num_rows:
                ids = [unpacked(x, "<i4") for x in batch.column("ids").to_pylist()]
                n, known, base, score = own.score(ids, classes, counts)
                numbers = [pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(np.full(len(n), train_tokens, np.int64))]
                columns = [batch.column("doc_id"), batch.column("held_out"), *numbers, pa.array(base), pa.array(score)]
                out.append(pa.RecordBatch.from_arrays(columns, names=result))
        return pa.Table.from_batches(out, schema=pa.schema(list(zip(result, result_types))))

    result = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    result_types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    return (
        texts.select("chunk", "doc_id", "held_out", "ids")
        .groupBy("chunk")
        .cogroup(numbers.select("of_chunk", "local", "class", "c").groupBy("of_chunk"))
        .applyInArrow(
            run,
            "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
        )
    )
