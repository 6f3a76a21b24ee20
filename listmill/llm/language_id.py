"""Language identification by a bidirectional gated recurrent network over bytes.

The network labels every byte of a text with a distribution over the learned languages; a
document's distribution is the mean over all its bytes. Long texts go through it in windows that
also read some bytes of their neighbours on either side, so that no label is given by a state that
has just begun. It is trained in numpy by backpropagation through time on windows of a bounded
sample of labelled documents.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listmill.llm.common import fold_of, fresh, parts

#: The sample: documents per language at most, and in all; windows of a document, characters of a
#: window, of which as many whole ones train as fit into that many bytes.
DOCS_PER_LANGUAGE, DOCS_IN_ALL = 400, 4000
WINDOWS_PER_DOC, WINDOW_CHARS = 6, 64
#: Texts of a language that are drawn beyond what its share asks, as few are wanted of many languages.
SPARE = 20
#: Hidden units of a direction, training steps, windows of a step, learning rate.
HIDDEN, STEPS, BATCH, RATE = 8, 300, 384, 0.02
#: Bytes of a window when texts are labelled, bytes that it also reads before and after, and windows
#: that go through the network together.
SPAN, CONTEXT, TOGETHER = 256, 24, 1024
#: What a text without any letter is.
UNDETERMINED = "und"
SEED = 7


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, 0.5, out=x)
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


class Direction:
    """A gated recurrent unit that reads bytes in one direction; gates in the order update, reset, candidate."""

    def __init__(self, hidden: int, rng: np.random.Generator):
        h = self.hidden = hidden
        self.inputs = rng.normal(0, 0.3, (256, 3 * h)).astype(np.float32)  # a byte's input to the gates, bias included
        self.recurrent = rng.normal(0, h**-0.5, (h, 3 * h)).astype(np.float32)
        self.bias = np.zeros(h, np.float32)  # of the candidate's recurrent part

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.bias]

    def walk(self, steps: np.ndarray, trace: list | None = None) -> Iterator[np.ndarray]:
        """Hidden states [window, unit] step by step for bytes [step, window]; ``trace`` gets what training needs."""
        h = self.hidden
        state = np.zeros((steps.shape[1], h), np.float32)
        for t in range(len(steps)):
            given, own = self.inputs[steps[t]], state @ self.recurrent
            gates = _sigmoid(given[:, : 2 * h] + own[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            inner = own[:, 2 * h :] + self.bias
            candidate = np.tanh(given[:, 2 * h :] + reset * inner)
            if trace is not None:
                trace.append((state, update, reset, inner, candidate))
            state = candidate + update * (state - candidate)
            yield state

    def states(self, steps: np.ndarray, trace: list | None = None) -> np.ndarray:
        """All hidden states [step, window, unit]."""
        out = np.empty((*steps.shape, self.hidden), np.float32)
        for t, state in enumerate(self.walk(steps, trace)):
            out[t] = state
        return out

    def gradients(self, steps: np.ndarray, trace: list, d_out: np.ndarray) -> list[np.ndarray]:
        """Backpropagation through time: gradients of the parameters from those of the states."""
        d_recurrent, d_bias = np.zeros_like(self.recurrent), np.zeros_like(self.bias)
        d_given = np.empty((*steps.shape, 3 * self.hidden), np.float32)
        d_state = np.zeros_like(d_out[0])
        for t in reversed(range(len(steps))):
            before, update, reset, inner, candidate = trace[t]
            d = d_out[t] + d_state
            d_candidate = d * (1 - update) * (1 - candidate**2)
            d_update = d * (before - candidate) * update * (1 - update)
            d_reset = d_candidate * inner * reset * (1 - reset)
            d_inner = d_candidate * reset
            d_given[t] = np.concatenate([d_update, d_reset, d_candidate], axis=1)
            d_own = np.concatenate([d_update, d_reset, d_inner], axis=1)
            d_recurrent += before.T @ d_own
            d_bias += d_inner.sum(axis=0)
            d_state = d * update + d_own @ self.recurrent.T
        d_inputs = np.zeros_like(self.inputs)
        np.add.at(d_inputs, steps.ravel(), d_given.reshape(-1, d_given.shape[2]))
        return [d_inputs, d_recurrent, d_bias]


def _mirrored(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each window's first ``lengths`` steps in reverse order; the rest stays where it is. Its own inverse."""
    n = len(values)
    if (lengths == n).all():
        return values[::-1]
    at = np.arange(n)[:, None]
    at = np.where(at < lengths, lengths - 1 - at, at)
    return values[at, np.arange(values.shape[1])]


def _softmax(scores: np.ndarray) -> np.ndarray:
    """Over the last axis, in place."""
    scores -= scores.max(axis=-1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=-1, keepdims=True)
    return scores


class Network:
    """Two directions and a softmax over the languages at every byte."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.forward, self.backward = Direction(hidden, rng), Direction(hidden, rng)
        self.output = rng.normal(0, 0.1, (2 * hidden, len(languages))).astype(np.float32)
        self.offset = np.zeros(len(languages), np.float32)

    @property
    def parameters(self) -> list[np.ndarray]:
        return [*self.forward.parameters, *self.backward.parameters, self.output, self.offset]

    def probabilities(self, steps: np.ndarray, lengths: np.ndarray, traces: tuple[list, list] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """[step, window, language] and the joined states for bytes [step, window]."""
        ahead = self.forward.states(steps, traces and traces[0])
        behind = self.backward.states(_mirrored(steps, lengths), traces and traces[1])
        states = np.concatenate([ahead, _mirrored(behind, lengths)], axis=2)
        return _softmax(states @ self.output + self.offset), states

    def labels(self, steps: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The probabilities alone: no state outlives its step, so memory holds one array [step, window, language]."""
        h, n = self.forward.hidden, len(steps)
        scores = np.empty((*steps.shape, len(self.languages)), np.float32)
        for t, state in enumerate(self.forward.walk(steps)):
            np.matmul(state, self.output[:h], out=scores[t])
            scores[t] += self.offset
        alike = bool((lengths == n).all())
        for t, state in enumerate(self.backward.walk(_mirrored(steps, lengths))):
            at = slice(None) if alike else np.flatnonzero(lengths > t)
            scores[n - 1 - t if alike else lengths[at] - 1 - t, at] += state[at] @ self.output[h:]
        return _softmax(scores)

    def loss_and_gradients(self, steps: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all labelled bytes, and its gradients in the order of ``parameters``."""
        traces: tuple[list, list] = ([], [])
        p, states = self.probabilities(steps, lengths, traces)
        inside = np.arange(len(steps))[:, None] < lengths
        total = np.float32(max(1, inside.sum()))
        own = np.take_along_axis(p, np.broadcast_to(labels[None, :, None], (*steps.shape, 1)), axis=2)[..., 0]
        loss = float(-(np.log(np.maximum(own, 1e-30)) * inside).sum() / total)
        d = p.copy()
        at = np.arange(len(labels))
        d[:, at, labels] -= 1
        d *= inside[..., None] / total
        d_states = d @ self.output.T
        h = self.forward.hidden
        flat = d.reshape(-1, d.shape[2])
        ahead = self.forward.gradients(steps, traces[0], np.ascontiguousarray(d_states[..., :h]))
        behind = self.backward.gradients(_mirrored(steps, lengths), traces[1], _mirrored(d_states[..., h:], lengths))
        return loss, [*ahead, *behind, states.reshape(len(flat), -1).T @ flat, flat.sum(axis=0)]

    def train(self, windows: list[bytes], labels: list[int], steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> None:
        """Adam over random batches; languages are drawn equally often."""
        rng = np.random.default_rng(seed)
        span = max(map(len, windows))
        data = np.zeros((span, len(windows)), np.uint8)
        for i, w in enumerate(windows):
            data[: len(w), i] = np.frombuffer(w, np.uint8)
        lengths, labels = np.array([len(w) for w in windows]), np.array(labels)
        weights = 1 / np.bincount(labels, minlength=len(self.languages))[labels]
        weights /= weights.sum()
        first = [np.zeros_like(p) for p in self.parameters]
        second = [np.zeros_like(p) for p in self.parameters]
        for step in range(1, steps + 1):
            at = rng.choice(len(windows), min(batch, len(windows)), p=weights)
            _, gradients = self.loss_and_gradients(data[:, at], lengths[at], labels[at])
            speed = rate * min(1, 2 * (1 - step / (steps + 1)))
            for p, g, a, b in zip(self.parameters, gradients, first, second):
                np.clip(g, -1, 1, out=g)
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= speed * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)

    def label_bytes(self, texts: list[bytes], span: int = SPAN, context: int = CONTEXT) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Windows over all bytes of all texts: (window, its text, its length, probabilities [byte, window, language]).

        Both directions begin ``context`` bytes outside a window, or at the text's end where that is
        nearer; what they say of those bytes is left to the window that holds them.
        """
        sizes = np.array([len(t) for t in texts], np.int64)
        flat = np.frombuffer(b"".join(texts) + bytes(span + 2 * context), np.uint8)
        counts = -(-sizes // span)
        text = np.repeat(np.arange(len(texts)), counts)
        index = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        lengths = np.minimum(span, sizes[text] - index * span)
        lead = np.minimum(context, index * span)
        read = lead + lengths + np.minimum(context, sizes[text] - index * span - lengths)
        starts = (np.cumsum(sizes) - sizes)[text] + index * span - lead
        alike = (lead == context) & (lengths == span) & (read == span + 2 * context)
        for inner in (True, False):
            which = np.flatnonzero(alike == inner)
            which = which[np.argsort(read[which], kind="stable")]
            for a in range(0, len(which), TOGETHER):
                part = which[a : a + TOGETHER]
                steps = np.ascontiguousarray(flat[starts[part][None, :] + np.arange(int(read[part].max()))[:, None]])
                p = self.labels(steps, read[part])
                if inner:
                    own = p[context : context + span]
                else:
                    at = lead[part] + np.arange(int(lengths[part].max()))[:, None]
                    own = p[np.minimum(at, len(p) - 1), np.arange(len(part))]
                yield part, text[part], lengths[part], own

    def pooled(self, texts: list[bytes], span: int = SPAN, context: int = CONTEXT) -> np.ndarray:
        """The mean distribution over the bytes of each text; zeros for an empty one."""
        sums = np.zeros((len(texts), len(self.languages)))
        for _, text, lengths, p in self.label_bytes(texts, span, context):
            p[np.arange(len(p))[:, None] >= lengths] = 0
            np.add.at(sums, text, p.sum(axis=0, dtype=np.float64))
        sizes = np.array([max(1, len(t)) for t in texts])
        return sums / sizes[:, None]


def whole_characters(text: str, most: int) -> bytes:
    """The longest beginning of ``text`` in whole characters that takes at most ``most`` bytes."""
    return text.encode()[:most].decode(errors="ignore").encode()


def sample_windows(docs: DataFrame, text_column: str, language_column: str) -> list[tuple[str, str]]:
    """(language, window) pairs of a bounded sample of distinct labelled texts.

    Texts are drawn by a hash of the text alone, in equal number for each language; the driver gets
    WINDOWS_PER_DOC short pieces from anywhere in each text, never the text. The share that is drawn
    goes by the distinct texts with a letter, so copies take no text's place.
    """
    language, text = F.col(language_column), F.col(text_column)
    labelled = docs.where(language.isNotNull() & text.rlike(r"\p{L}"))
    draw = F.xxhash64(text)
    sizes = labelled.groupBy(language.alias("l")).agg(F.approx_count_distinct(draw).alias("n"))
    counts = {r["l"]: r["n"] for r in sizes.orderBy(F.desc("n"), "l").limit(DOCS_IN_ALL).collect()}
    if not counts:
        return []
    wanted = max(1, min(DOCS_PER_LANGUAGE, DOCS_IN_ALL // len(counts)))
    share = F.coalesce(*(F.when(language == k, F.lit(min(1.0, (1.5 * wanted + SPARE) / n))) for k, n in sorted(counts.items())), F.lit(0.0))
    piece = F.transform(
        F.sequence(F.lit(0), F.lit(WINDOWS_PER_DOC - 1)),
        lambda i: F.substring(text, (F.pmod(F.xxhash64(draw, i), F.greatest(F.length(text) - WINDOW_CHARS, F.lit(1))) + 1).cast("int"), F.lit(WINDOW_CHARS)),
    )
    drawn = (
        labelled.where(F.pmod(draw, F.lit(1 << 30)) < share * (1 << 30))
        .select(language.alias("l"), draw.alias("draw"), piece.alias("pieces"))
        .groupBy("l", "draw")
        .agg(F.first("pieces").alias("pieces"))
    )
    ranked = drawn.withColumn("rank", F.expr("row_number() over (partition by l order by draw)"))
    rows = ranked.where(F.col("rank") <= wanted).select("l", F.explode("pieces").alias("w"))
    return sorted({(r["l"], r["w"]) for r in rows.collect() if r["w"]})


def learn(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang") -> Network | None:
    """A network trained on documents outside the held-out fold; None if none of them has a language."""
    pairs = sample_windows(docs.where(fold_of(F.col(id_column)) != 0), text_column, language_column)
    if not pairs:
        return None
    network = Network(sorted({language for language, _ in pairs}))
    number = {language: i for i, language in enumerate(network.languages)}
    network.train([whole_characters(w, WINDOW_CHARS) for _, w in pairs], [number[language] for language, _ in pairs])
    return network


def predict(df: DataFrame, network: Network | None, text_column: str = "text", language_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """``df`` with the predicted language and its probability; a name that is taken gets underscores before it.

    Every byte of the whole text is labelled, however long it is, in windows of bounded memory. A null
    text, and one without a letter, is ``und`` with score 0, as is every text if no language was
    learned. Of languages with the same probability the first in order of name counts. Repeated rows
    each get their result; an empty table gives an empty one.
    """
    language_name, score_name = fresh(df, language_name), fresh(df, score_name)
    columns, at = df.columns, df.columns.index(text_column)
    sent = df.sparkSession.sparkContext.broadcast(pickle.dumps(network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(sent.value)
        for batch in batches:
            for part in parts(batch, at):
                texts = part.column(at).to_pylist()
                known = [own is not None and bool(t) and any(map(str.isalpha, t)) for t in texts]
                found, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                if any(known):
                    which = np.flatnonzero(known)
                    p = own.pooled([texts[i].encode() for i in which.tolist()])
                    best = p.argmax(axis=1)
                    scores[which] = np.clip(p[np.arange(len(which)), best], 0, 1)
                    for i, b in zip(which.tolist(), best.tolist()):
                        found[i] = own.languages[b]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string()), pa.array(scores)], names=[*columns, language_name, score_name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(language_name, T.StringType()), T.StructField(score_name, T.DoubleType())]))


#: Least score of a document that the pipeline keeps.
LEAST_SCORE = 0.3


def keep_identified(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text has a language, in its columns: not ``und``, and a score that
    is not about as low for all languages. The network is learned from ``docs`` themselves."""
    name, score = fresh(docs, "lang_pred"), fresh(docs, "score")
    found = predict(docs, learn(docs, id_column, text_column, language_column), text_column, name, score)
    return found.where((F.col(name) != UNDETERMINED) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def language_runs(docs: DataFrame, network: Network, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, first_byte, n_bytes, lang: the stretches of a text's bytes with one label, window by window.

    Null and empty texts have none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(network))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(sent.value)
        for batch in batches:
            for part in parts(batch, 1):
                texts = [(t or "").encode() for t in part.column(1).to_pylist()]
                out = []
                first = np.concatenate([np.arange(0, len(t), SPAN) for t in texts])
                for window, text, lengths, p in own.label_bytes(texts):
                    best = p.argmax(axis=2)
                    for j, (w, i, n) in enumerate(zip(window.tolist(), text.tolist(), lengths.tolist())):
                        labels = best[:n, j]
                        starts = np.append(0, np.flatnonzero(np.diff(labels)) + 1)
                        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), n]):
                            out.append((i, int(first[w]) + a, b - a, own.languages[labels[a]]))
                if out:
                    at, begins, sizes, languages = zip(*sorted(out))
                    columns = [part.column(0).take(pa.array(at)), pa.array(begins, pa.int64()), pa.array(sizes, pa.int64()), pa.array(languages)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "first_byte", "n_bytes", "lang"])

    fields = [T.StructField("doc_id", docs.schema[id_column].dataType), T.StructField("first_byte", T.LongType())]
    return rows.mapInArrow(run, T.StructType([*fields, T.StructField("n_bytes", T.LongType()), T.StructField("lang", T.StringType())]))
