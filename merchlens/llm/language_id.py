"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows. In each window one network of gated
units reads forward and one backward, and the two states at a byte give
probabilities of the languages there. A document's probabilities are the means
over all its bytes, so every byte of every text counts and windows of one text
need not be read in order.

The network is trained here, by backpropagation through time over windows of a
bounded sample of labelled documents, each byte having the document's language.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.token_files import text_batches

WINDOW = 64  # bytes
STATES = 16  # units in each direction
# Bounds of what is fitted on: languages (the most frequent ones), documents of each, windows of a document.
LANGUAGES = 64
PER_LANGUAGE = 300
PER_DOCUMENT = 8
EPOCHS = 6
BATCH = 128
# So many windows go through the network at once: the state's product with the
# weights then stays below the size at which the linear algebra library starts threads.
_AT_ONCE = 320


def _sigmoid(x: np.ndarray) -> None:
    """The logistic function, in place."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5


@dataclass
class Direction:
    """Weights of one direction; the first axis holds the gates update, reset and new."""

    bytes_in: np.ndarray  # 3 x 256 x states, offsets of the gates included
    state_in: np.ndarray  # 3 x states x states
    new_offset: np.ndarray  # inside the reset

    def read(self, x: np.ndarray, mask: np.ndarray, keep: list) -> np.ndarray:
        """The states at every byte, for training; ``x`` is (time, windows), and where ``mask`` is 0 the state stays."""
        steps, n = x.shape
        s, kind = len(self.new_offset), self.state_in.dtype
        h = np.zeros((n, s), kind)
        gates, own = np.empty((3, n, s), kind), np.empty((3, n, s), kind)
        out = np.empty((steps, n, s), kind)
        for t in range(steps):
            self.bytes_in.take(x[t], axis=1, out=gates, mode="clip")
            np.matmul(h, self.state_in, out=own)
            update_reset, new, inner = gates[:2], gates[2], own[2]
            update_reset += own[:2]
            _sigmoid(update_reset)
            inner += self.new_offset
            kept_inner = inner.copy()
            inner *= gates[1]
            new += inner
            np.tanh(new, out=new)
            gates[0][mask[t] == 0] = 1
            keep.append((gates.copy(), kept_inner))
            h -= new
            h *= gates[0]
            h += new
            out[t] = h
        return out

    def learn(self, x: np.ndarray, states: np.ndarray, keep: list, slope: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weights, given those of the states, backward through time."""
        steps, n, s = states.shape
        by_gate = np.empty((3, steps, n, s), states.dtype)
        d_state, d_offset = np.zeros_like(self.state_in), np.zeros_like(self.new_offset)
        dh = np.zeros((n, s), states.dtype)
        back = self.state_in.transpose(0, 2, 1)
        for t in range(steps - 1, -1, -1):
            dh = dh + slope[t]
            (z, r, new), inner = keep[t]
            before = states[t - 1] if t else np.zeros_like(dh)
            d_new = dh * (1 - z) * (1 - new * new)
            d_inner = d_new * r
            # Where a mask has set the update to 1, z (1 - z) is 0: nothing flows to the gates.
            from_state = np.stack([dh * (before - new) * z * (1 - z), d_new * inner * r * (1 - r), d_inner])
            by_gate[:2, t], by_gate[2, t] = from_state[:2], d_new
            d_state += before.T @ from_state
            d_offset += d_inner.sum(axis=0)
            dh = dh * z + (from_state @ back).sum(axis=0)
        flat, code = by_gate.reshape(3, -1, s), x.ravel()
        order = np.argsort(code, kind="stable")
        heads = np.flatnonzero(np.diff(code[order].astype(np.int64), prepend=-1))
        d_bytes = np.zeros_like(self.bytes_in)
        d_bytes[:, code[order][heads]] = np.add.reduceat(flat[:, order], heads, axis=1)
        return [d_bytes, d_state, d_offset]


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # 2 states x languages
    offset: np.ndarray

    @staticmethod
    def new(languages: list[str], states: int = STATES, seed: int = 0, kind: type = np.float32) -> Network:
        rng = np.random.default_rng(seed)

        def some(size: float, *shape: int) -> np.ndarray:
            return rng.normal(0, size, shape).astype(kind)

        def direction() -> Direction:
            return Direction(some(0.3, 3, 256, states), some(states**-0.5, 3, states, states), np.zeros(states, kind))

        return Network(languages, direction(), direction(), some(states**-0.5, 2 * states, len(languages)), np.zeros(len(languages), kind))

    def weights(self) -> list[np.ndarray]:
        return [
            self.forward.bytes_in, self.forward.state_in, self.forward.new_offset,
            self.backward.bytes_in, self.backward.state_in, self.backward.new_offset, self.out, self.offset,
        ]

    def labels(self, x: np.ndarray, mask: np.ndarray, keep: dict) -> np.ndarray:
        """Probabilities of the languages at every byte of windows, for training: (languages, time, windows)."""
        ahead: list = []
        behind: list = []
        f = self.forward.read(x, mask, ahead)
        b = self.backward.read(x[::-1], mask[::-1], behind)[::-1]
        half = len(self.out) // 2
        p = self.out[:half].T @ f.reshape(-1, half).T
        p += self.out[half:].T @ np.ascontiguousarray(b).reshape(-1, half).T
        p += self.offset[:, None]
        # States lie between -1 and 1, so this bound is met by no trained network.
        np.clip(p, -60, 60, out=p)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        keep.update(ahead=ahead, behind=behind, f=f, b=b)
        return p.reshape(-1, *x.shape)

    def gradients(self, x: np.ndarray, mask: np.ndarray, truth: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """The mean loss over the bytes of windows whose languages are ``truth``, and the gradients of ``weights()``."""
        keep: dict = {}
        p = self.labels(x, mask, keep)
        n = mask.sum()
        each = np.arange(x.shape[1])
        loss = -(np.log(np.maximum(p[truth, :, each].T, 1e-30)) * mask).sum() / n
        p[truth, :, each] -= 1
        p *= mask / n
        f, b, half = keep["f"], keep["b"], len(self.out) // 2
        flat = p.reshape(len(p), -1).T
        d_out = np.concatenate([f.reshape(-1, half).T @ flat, b.reshape(-1, half).T @ flat])
        d_f, d_b = ((flat @ w.T).reshape(f.shape) for w in (self.out[:half], self.out[half:]))
        ahead = self.forward.learn(x, f, keep["ahead"], d_f)
        behind = self.backward.learn(x[::-1], b[::-1], keep["behind"], d_b[::-1])
        return float(loss), [*ahead, *behind, d_out, p.sum(axis=(1, 2))]

    def documents(self, texts: list[str]) -> np.ndarray:
        """Probabilities of the languages, means over all bytes of each text: (texts, languages)."""
        coded = [np.frombuffer(t.encode(errors="replace"), np.uint8) for t in texts]
        sums = np.zeros((len(texts), len(self.languages)))
        reader = Reader(self)

        def pool(x: np.ndarray, mask: np.ndarray | None, owner: np.ndarray) -> None:
            p = reader.labels(x, mask)
            if mask is not None:
                p *= mask[:, None]
            np.add.at(sums, owner, p.sum(axis=0).T)

        full = [len(c) // WINDOW for c in coded]
        # Whole windows of all texts, in groups that may span texts.
        group: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        held = 0
        for i, c in enumerate(coded):
            windows = c[: full[i] * WINDOW].reshape(-1, WINDOW)
            at = 0
            while at < len(windows):
                take = windows[at : at + _AT_ONCE - held]
                group.append(take)
                owners.append(np.full(len(take), i))
                held, at = held + len(take), at + len(take)
                if held == _AT_ONCE:
                    pool(np.concatenate(group).T, None, np.concatenate(owners))
                    group, owners, held = [], [], 0
        if held:
            pool(np.concatenate(group).T, None, np.concatenate(owners))
        # What is left of each text, by length, so that little is padded.
        tails = sorted((len(c) % WINDOW, i) for i, c in enumerate(coded) if len(c) % WINDOW)
        for a in range(0, len(tails), _AT_ONCE):
            some = tails[a : a + _AT_ONCE]
            x, mask = padded([coded[i][full[i] * WINDOW :] for _, i in some])
            pool(x, mask, np.array([i for _, i in some]))
        return sums / np.maximum([[len(c)] for c in coded], 1)


class Reader:
    """A network laid out to read windows, with room for ``_AT_ONCE`` of them that every call uses again.

    Both directions go side by side. In place of a state h it holds (1 + h) / 2, so a new state tanh(v) is
    1 / (1 + exp(-2v)), and with the gates' exponentials a step is a few passes over arrays. Hyperbolic tangents
    take more than twice the time of exponentials on CPUs without AVX-512. Signs, factors and what the
    shift of the state adds are put into the weights.
    """

    def __init__(self, net: Network) -> None:
        states, kind, both = len(net.out) // 2, net.out.dtype, (net.forward, net.backward)
        # Update gate: 1 - 1 / (1 + exp(a)); reset gate: 1 / (1 + exp(-a)).
        factor = np.array([1.0, -1.0, -2.0])[:, None, None, None]
        bytes_in, state_in = (np.stack(w, axis=1).astype(np.float64) for w in ([d.bytes_in for d in both], [d.state_in for d in both]))
        shift = state_in.sum(axis=2, keepdims=True)
        # What is added to the new state's product lies inside the reset.
        inside = np.stack([d.new_offset for d in both])[:, None] - shift[2]
        bytes_in[:2] -= shift[:2]
        out = net.out.reshape(2, states, -1).astype(np.float64)
        self.bytes_in = (factor * bytes_in).astype(kind).reshape(3, 2 * 256, states)
        self.state_in = (2 * factor * state_in).astype(kind)
        self.new_offset = (-2 * inside).astype(kind)
        self.out = np.ascontiguousarray(2 * out.transpose(0, 2, 1)).astype(kind)
        self.offset = (net.offset - out.sum(axis=(0, 1))).astype(kind)[:, None]
        self.room: dict[str, np.ndarray] = {}

    def _room(self, name: str, shape: tuple[int, ...], most: int, kind: np.dtype | type) -> np.ndarray:
        """An array of this shape, anything in it, in room for ``most`` numbers that is made at first use."""
        if name not in self.room:
            self.room[name] = np.empty(most, kind)
        return self.room[name][: math.prod(shape)].reshape(shape)

    def labels(self, x: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
        """Probabilities of the languages at every byte of windows: (time, languages, windows), until the next call.

        ``x`` is (time, windows), at most ``WINDOW`` by ``_AT_ONCE``. With a ``mask`` of what is there, windows come by
        length, the shortest first; what is not there gets any probabilities.
        """
        (steps, n), (_, languages, s), kind = x.shape, self.out.shape, self.out.dtype
        at = self._room("at", (steps, 2, n), WINDOW * 2 * _AT_ONCE, np.intp)
        at[:, 0], at[:, 1] = x, x[::-1]
        at[:, 1] += 256
        at = at.reshape(steps, 2 * n)
        gates = self._room("gates", (3, 2, n, s), 6 * _AT_ONCE * s, kind)
        own = self._room("own", (3, 2, n, s), 6 * _AT_ONCE * s, kind)
        h = self._room("h", (2, n, s), 2 * _AT_ONCE * s, kind)
        each = self._room("each", (steps, 2, languages, n), WINDOW * 2 * languages * _AT_ONCE, kind)
        by_byte, turned = gates.reshape(3, 2 * n, s), h.transpose(0, 2, 1)
        update_reset, (update, reset, new) = gates[:2], gates
        own_update_reset, inner = own[:2], own[2]
        # Of its full size, which is quicker to add than one that is spread over windows.
        new_offset = self._room("new_offset", (2, n, s), 2 * _AT_ONCE * s, kind)
        new_offset[:] = self.new_offset
        # Windows that the backward direction, which meets what is padded first, has not begun.
        waiting = np.zeros(steps, np.int64) if mask is None else n - mask[::-1].sum(axis=1).astype(np.int64)
        h.fill(0.5)
        with np.errstate(over="ignore"):
            for t in range(steps):
                self.bytes_in.take(at[t], axis=1, out=by_byte, mode="clip")
                np.matmul(h, self.state_in, out=own)
                update_reset += own_update_reset
                np.exp(update_reset, out=update_reset)
                update_reset += 1
                inner += new_offset
                inner /= reset
                new += inner
                np.exp(new, out=new)
                new += 1
                np.reciprocal(new, out=new)
                # Where an exponential is infinite the quotient is 0, as it should be.
                new -= h
                new /= update
                h += new
                h[1, : waiting[t]] = 0.5
                np.matmul(self.out, turned, out=each[t])
        p = self._room("p", (steps, languages, n), WINDOW * languages * _AT_ONCE, kind)
        np.add(each[:, 0], each[::-1, 1], out=p)
        p += self.offset
        # States lie between -1 and 1, so this bound is met by no trained network.
        np.clip(p, -60, 60, out=p)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p


def padded(windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Windows as (time, windows) with zeros behind the shorter ones, and a mask of what is there."""
    x = np.zeros((max(map(len, windows)), len(windows)), np.uint8)
    mask = np.zeros(x.shape, np.float32)
    for i, w in enumerate(windows):
        x[: len(w), i], mask[: len(w), i] = w, 1
    return x, mask


def fit(windows: list[bytes], truth: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 0) -> Network:
    """Train on windows with their languages' places.

    Of a batch's windows every fourth is cut short, since short texts are too, and every eighth is put in capitals (A-Z).
    """
    net = Network.new(languages, seed=seed)
    rng = np.random.default_rng(seed)
    coded, capital = ([np.frombuffer(w, np.uint8) for w in made] for made in (windows, [w.upper() for w in windows]))
    # Every language weighs alike, however many windows it has.
    by_language = [np.flatnonzero(truth == k) for k in range(len(languages))]
    most = max(map(len, by_language))
    weights = net.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step, total = 0, epochs * -(-most * len(languages) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(np.concatenate([np.resize(rng.permutation(at), most) for at in by_language]))
        for a in range(0, len(order), BATCH):
            batch = order[a : a + BATCH]
            cut = [(capital if k % 8 == 1 else coded)[i][: rng.integers(1, len(coded[i]) + 1) if k % 4 == 0 else None] for k, i in enumerate(batch)]
            _, slopes = net.gradients(*padded(cut), truth[batch])
            size = np.sqrt(sum(float((g * g).sum()) for g in slopes))
            step += 1
            rate = 0.02 * min(1.0, step / 20) * (1 - 0.95 * step / total)
            for w, g, m, v in zip(weights, slopes, first, second, strict=True):
                g = g * min(1.0, 1.0 / max(size, 1e-12))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


# -- Spark -------------------------------------------------------------------


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[list[str], list[bytes], np.ndarray]:
    """Windows of a bounded sample: languages, windows, and the place of each window's language."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        F.col("lang").isNotNull() & F.rlike("text", F.lit(r"\p{L}"))
    )
    found = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    counts = {r["lang"]: r["count"] for r in found}
    if not counts:
        return [], [], np.zeros(0, np.int64)
    spread = F.xxhash64("id", "text")
    # Twice as many as wanted pass by their hash, so that the ranking below is over a bounded number of rows.
    unit = F.pmod(spread, F.lit(1 << 30)) / (1 << 30)
    share = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(min(1.0, 2 * PER_LANGUAGE / n))) for lang, n in counts.items()])
    few = known.filter(F.col("lang").isin(list(counts)) & (unit < share)).withColumn("spread", spread)
    order = Window.partitionBy("lang").orderBy("spread", "id")
    bytes_of = F.encode("text", "utf-8")
    windows = (
        few.withColumn("r", F.row_number().over(order))
        .filter(F.col("r") <= PER_LANGUAGE)
        .select("lang", "spread", bytes_of.alias("b"), F.explode(F.sequence(F.lit(0), F.lit(PER_DOCUMENT - 1))).alias("k"))
        # A text shorter than so many windows gives no more than it has.
        .filter(F.col("k") * WINDOW < F.length("b"))
        .select("lang", "spread", "k", F.substr("b", (F.pmod(F.xxhash64("spread", "k"), F.greatest(F.length("b") - WINDOW, F.lit(0)) + 1) + 1).cast("int"), F.lit(WINDOW)).alias("w"))
    )
    rows = sorted((r["lang"], r["spread"], r["k"], bytes(r["w"])) for r in windows.collect())
    languages = sorted({r[0] for r in rows})
    place = {lang: k for k, lang in enumerate(languages)}
    return languages, [r[3] for r in rows], np.array([place[r[0]] for r in rows], np.int64)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """Fit a network on a sample of labelled documents; None where none has a language and a letter.

    At most ``PER_LANGUAGE`` documents of each of the ``LANGUAGES`` most frequent languages and ``PER_DOCUMENT``
    windows of each are taken, by a hash of id and text.
    """
    languages, windows, truth = _sample(docs, id_col, text_col, lang_col)
    return fit(windows, truth, languages) if languages else None


def _predict(net: Network) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = batch.column("lettered").to_pylist()
            langs: list[str] = []
            scores: list[float] = []
            for _, texts in text_batches([t if ok else "" for t, ok in zip(batch.column("text").to_pylist(), lettered, strict=True)]):
                p = net.documents(texts)
                best = p.argmax(axis=1)
                langs += [net.languages[k] for k in best]
                scores += np.clip(p.max(axis=1), 0, 1).tolist()
            langs = [lang if ok else "und" for lang, ok in zip(langs, lettered, strict=True)]
            scores = [s if ok else 0.0 for s, ok in zip(scores, lettered, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["row", "lang_pred", "score"])

    return run


def with_language(docs: DataFrame, net: Network | None, text_col: str = "text") -> DataFrame:
    """Every row with the predicted language ``lang_pred`` and its probability ``score`` added.

    Defined cases: a null text, and one without a letter, is ``und`` with score 0; so is every text without a
    trained network. A text of any length is read whole, window by window. Equal texts get equal results up to rounding. An empty
    table gives none. Other columns pass through; input columns named ``lang_pred`` or ``score``, in any case, are replaced.
    """
    passed = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    lettered = F.coalesce(F.rlike(F.col(text_col), F.lit(r"\p{L}")), F.lit(False))
    if net is None:
        return docs.select(*passed, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    # The row stays inside one struct, so no name can clash with those made here.
    rows = docs.select(F.struct(*passed).alias("row"), F.col(text_col).alias("text"), lettered.alias("lettered"))
    kind = rows.schema["row"].dataType.simpleString()
    found = rows.mapInArrow(_predict(net), f"row {kind}, lang_pred string, score double")
    return found.select(*[F.col("row")[c].alias(c) for c in passed], "lang_pred", "score")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: its id's CRC-32 leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def language_report(docs: DataFrame) -> DataFrame:
    """Train on the documents that are not held out and predict the language of every one."""
    net = train(docs.filter(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return with_language(rows, net).drop("text")
