"""Toxicity by a support vector machine on a gap-weighted subsequence kernel.

Two strings are alike in this kernel if they share subsequences of three and
four letters; a subsequence that spans s letters weighs decay ** s, so letters
may be put between those of an insult, and other characters do not count. A text
is a bag of windows (its words, runs of single letters taken together, and
stretches of very long words), of which its three highest margins count.

Training is by multiple instances: a label says of a bag that some window of it
is toxic, or none. Each distinct sentence of the labelled documents counts once;
one that a clean document has is clean. At first the windows that tell are those
that toxic sentences have far more often than chance explains. Bags without one
are looked through again; there a window tells if it is far more frequent than
in clean sentences that share its most frequent companion, so that words of a
language that has few labels tell nothing by themselves. All windows of clean
sentences are negative; rounds add those that the machine scores highest until
none scores above the cut, also as landmarks. Windows that tell are also shown
with a letter put in.

Nystroem features of the kernel against landmarks, which are windows of both
kinds, go into a linear support vector machine. As the kernel is a finite sum
over subsequences, the trained machine folds into one weight for each of them.
Last, a logistic function of a document's three highest margins is fitted to the
labelled documents: one window that no clean text has is enough, windows that
clean texts have now and then must occur more than once.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.token_files import text_batches
from merchlens.llm.worker import give_back, kept
from merchlens.session import stage

DECAY = 0.7
REACH = 6  # a subsequence spans at most this many letters plus one
WINDOW = 24  # longer words are cut into windows of this length, half overlapping
LANDMARKS = 200
# Bounds of what is fitted on: labelled documents of each label, and distinct windows.
SAMPLE_DOCS = 4_000
CANDIDATES = 4_000
NEGATIVES = 6_000
ROUNDS = 8
TOP = 3  # margins of a document that its score depends on
# A witness stands in clean sentences at most at this share of its rate in toxic ones.
CLEAN_RATE = 0.1
NOTHING = -1.0  # the margin of a window without subsequences, and of no window
_CACHE = 300_000
_WINDOWS_AT_ONCE = 2_000  # windows whose subsequences are made at once
_CHUNK = 200  # windows whose kernel rows are made at once

# Characters read as letters.
_READ_AS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_SPELLED = re.compile(r"(?<!\S)\S(?:[ \t]{1,3}\S){2,}(?!\S)")


def _letter(c: str) -> int:
    """The code of a character, 1 to 31; 0 for one that can only be a gap."""
    c = _READ_AS.get(c, c)
    base = unicodedata.normalize("NFKD", c.lower())[:1]
    if "a" <= base <= "z":
        return ord(base) - 96
    return 27 + ord(base) % 5 if base.isalpha() else 0


class _Letters(dict):
    def __missing__(self, c: str) -> int:
        self[c] = code = _letter(c)
        return code


def windows_of(word: str) -> list[str]:
    # At a word's end this is punctuation, elsewhere a letter.
    word = word.rstrip("!") or word
    if len(word) <= WINDOW:
        return [word]
    half = WINDOW // 2
    return [word[i : i + WINDOW] for i in range(0, len(word) - half, half)]


# Codes of subsequences: three letters of five bits, then four letters.
_THREE = 1 << 15
CODES = _THREE + (1 << 20)


def subsequences(words: list[str], letters: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All subsequences of three and four letters of windows as (window, code, weight).

    The weights of a window are scaled to unit length.
    """
    # Characters that can only be a gap leave none, so letters set apart by them stand together.
    own = [[code for c in w if (code := letters[c])] for w in words]
    width = max(3, *map(len, own)) if own else 3
    codes = np.zeros((len(words), width), np.int64)
    for i, o in enumerate(own):
        codes[i, : len(o)] = o
    found, owners, weights = [], [], []

    def add(code: np.ndarray, far: int) -> None:
        # Letters stand at the front, so the last letter's place tells whether all are there.
        w, at = np.nonzero(codes[:, far:])
        owners.append(w)
        found.append(code[w, at])
        weights.append(np.full(len(w), DECAY ** (far + 1)))

    for far in range(2, min(REACH, width - 1) + 1):
        a, z = codes[:, : width - far], codes[:, far:]
        for i in range(1, far):
            b = codes[:, i : width - far + i]
            add(a << 10 | b << 5 | z, far)
            for j in range(i + 1, far):
                add(_THREE + (a << 15 | b << 10 | codes[:, j : width - far + j] << 5 | z), far)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    owner, code, weight = np.concatenate(owners), np.concatenate(found), np.concatenate(weights)
    scale = np.sqrt(np.bincount(owner, weights=weight**2, minlength=len(words)))
    return owner, code, weight / scale[owner]


def _features(words: list[str], landmarks: list[str]) -> np.ndarray:
    """The kernel of windows against landmarks."""
    letters = _Letters()
    owner, code, weight = subsequences(landmarks, letters)
    # Only subsequences of landmarks matter: the others share the empty last row.
    used, row = np.unique(code, return_inverse=True)
    table = np.zeros((len(used) + 1, len(landmarks)))
    np.add.at(table, (row, owner), weight)
    out = np.zeros((len(words), len(landmarks)))
    for a in range(0, len(words), _CHUNK):
        owner, code, weight = subsequences(words[a : a + _CHUNK], letters)
        row = np.minimum(np.searchsorted(used, code), len(used) - 1) if len(used) else np.zeros(len(code), np.int64)
        shared = used[row] == code if len(used) else np.zeros(len(code), bool)
        owner, row, weight = owner[shared], row[shared], weight[shared]
        order = np.argsort(owner, kind="stable")
        if len(order):
            heads = np.flatnonzero(np.diff(owner[order], prepend=-1))
            out[a + owner[order][heads]] = np.add.reduceat(weight[order][:, None] * table[row[order]], heads)
    return out


@dataclass
class Model:
    """Weights of subsequences (those that have one), the offset, and what the score makes of the highest margins."""

    codes: np.ndarray
    weights: np.ndarray
    offset: float
    slopes: tuple[float, ...] = (1.0,)
    shift: float = 0.0

    def table(self) -> np.ndarray:
        out = np.zeros(CODES)
        out[self.codes] = self.weights
        return out

    def margins(self, words: list[str], letters: dict[str, int], table: np.ndarray) -> np.ndarray:
        """The margins of windows; ``table`` is that of this model. A window too short for a subsequence is clean."""
        out = np.full(len(words), NOTHING)
        # By length, so that short windows are not padded to long ones.
        sizes = np.array([len(w) for w in words])
        for low, high in ((0, 8), (8, 12), (12, 16), (16, WINDOW)):
            group = np.flatnonzero((sizes > low) & (sizes <= high))
            for a in range(0, len(group), _WINDOWS_AT_ONCE):
                at = group[a : a + _WINDOWS_AT_ONCE]
                owner, code, weight = subsequences([words[i] for i in at], letters)
                found = np.bincount(owner, weights=weight * table[code], minlength=len(at)) + self.offset
                out[at] = np.where(np.bincount(owner, minlength=len(at)) > 0, found, NOTHING)
        return out

    def probability(self, top: np.ndarray) -> np.ndarray:
        """The score of documents by their highest margins, in falling order."""
        z = _clipped(top)[:, : len(self.slopes)] @ np.array(self.slopes) + self.shift
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _clipped(top: np.ndarray) -> np.ndarray:
    return np.clip(top, -2.0, 2.0)


class _Scorer:
    """Margins of words, each computed once; emptied at a bound."""

    def __init__(self, model: Model):
        self.model, self.letters, self.table = model, _Letters(), model.table()
        self.known: dict[str, float] = {}

    def top(self, texts: list[str]) -> np.ndarray:
        """The three highest margins of the windows of each text, in falling order; that of nothing where it has fewer."""
        if len(self.known) > _CACHE:
            self.known = {}
        split = [t.split() for t in texts]
        new = list({w for words in split for w in words} - self.known.keys())
        cut = [windows_of(w) for w in new]
        margins = self.model.margins([w for c in cut for w in c], self.letters, self.table)
        if new:
            self.known.update(zip(new, np.maximum.reduceat(margins, np.cumsum([0, *map(len, cut)])[:-1]).tolist(), strict=True))
        look = self.known.__getitem__
        out = np.full((len(texts), TOP), NOTHING)
        for i, (text, words) in enumerate(zip(texts, split, strict=True)):
            found = np.fromiter(map(look, words), np.float64, len(words))
            spelled = [w for run in _SPELLED.findall(text) for w in windows_of(run)]
            if spelled:
                found = np.concatenate([found, self.model.margins(spelled, self.letters, self.table)])
            if len(found) > TOP:
                found = found[np.argpartition(found, -TOP)[-TOP:]]
            out[i, : len(found)] = np.sort(found)[::-1]
        return out


def _score(model: Model, margins: bool = False) -> Callable:
    """Scores of texts, or with ``margins`` their highest margins."""
    name = f"toxicity:{hashlib.sha256(model.weights.tobytes() + model.codes.tobytes()).hexdigest()}:{model.offset}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer: _Scorer = kept("toxicity", name, lambda: _Scorer(model))
        for batch in batches:
            parts = [scorer.top(texts) for _, texts in text_batches(batch.column("text").to_pylist())]
            top = np.concatenate(parts) if parts else np.zeros((0, TOP))
            if margins:
                out = pa.FixedSizeListArray.from_arrays(pa.array(top.ravel()), TOP).cast(pa.list_(pa.float64()))
            else:
                out = pa.array(model.probability(top))
            yield pa.RecordBatch.from_arrays([batch.column("row"), out], ["row", "score"])
        give_back()

    return run


# -- training ----------------------------------------------------------------


def _sample(docs: DataFrame, labels: DataFrame, per_label: int, id_col: str, text_col: str) -> DataFrame:
    """Up to ``per_label`` labelled documents of each label, by a hash of the id: (id, toxic, text)."""
    known = (
        labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("id is not null and toxic in (0, 1)")
        # A document labelled both ways says nothing.
        .groupBy("id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .filter("toxic = most")
        .select("id", "toxic")
    )
    chosen = [known.filter(F.col("toxic") == k).orderBy(F.xxhash64("id"), "id").limit(per_label) for k in (0, 1)]
    # At most twice ``per_label`` ids, so the broadcast is bounded.
    ids = F.broadcast(chosen[0].unionAll(chosen[1]))
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(ids, "id")


def _sentences(docs: DataFrame) -> DataFrame:
    sentence = F.explode(F.split(F.coalesce("text", F.lit("")), r"(?<=[.!?])\s+|\n"))
    return docs.select("toxic", sentence.alias("sentence")).groupBy("sentence").agg(F.min("toxic").alias("toxic"))


def _words(sentences: DataFrame) -> DataFrame:
    words = sentences.select("toxic", F.explode(F.array_distinct(F.split("sentence", r"\s+"))).alias("word"))
    return words.filter(F.char_length("word").between(3, WINDOW))


def _window_counts(sample: DataFrame) -> tuple[DataFrame, DataFrame, dict[int, int]]:
    """The sample's distinct sentences; their windows, with the sentences of each label that have them; and how many there are.

    A sentence counts once however often it is copied; one that also stands in a
    clean document is clean.
    """
    distinct = stage(_sentences(sample), "sentences")
    counts = _words(distinct).groupBy("word").agg(F.sum("toxic").alias("n_toxic"), F.sum(1 - F.col("toxic")).alias("n_clean"))
    return distinct, stage(counts, "windows"), {r["toxic"]: r["count"] for r in distinct.groupBy("toxic").count().collect()}


def _telling(counts: DataFrame, n_words: int, n_toxic: int, n_clean: int) -> list[tuple[str, int]]:
    """Words that stand in toxic sentences more often than chance explains, and hardly in clean ones.

    A word of k toxic and j clean sentences is that toxic by chance with
    probability at most exp(-evidence); so many words are looked at that only
    far smaller ones tell. Without clean sentences it is share ** k.
    """
    share = n_toxic / (n_toxic + n_clean)
    k, j = F.col("n_toxic"), F.col("n_clean")
    evidence = k * F.log(k / ((k + j) * share)) + F.when(j > 0, j * F.log(j / ((k + j) * (1 - share)))).otherwise(0.0)
    found = (
        counts.filter((k >= 3) & (j * n_toxic <= CLEAN_RATE * n_clean * k))
        .filter(evidence >= 2 * float(np.log(max(n_words, 2))))
        .orderBy(F.desc("n_toxic"), "word").limit(CANDIDATES)
    )
    return [(r["word"], r["n_toxic"]) for r in found.select("word", "n_toxic").collect()]


def _by_companion(rest: DataFrame, distinct: DataFrame, counts: DataFrame, totals: dict[int, int]) -> list[tuple[str, int]]:
    """Words of unexplained toxic sentences that clean sentences with the same companion do not account for.

    A word's companion is the one it stands with most often here, most often a
    common word of its language. If the word were as frequent in toxic sentences
    with the companion as in clean ones, its number there would be Poisson; it
    tells if chance gives so large a number hardly ever.
    """
    own = _words(rest.select(F.lit(1).alias("toxic"), "sentence")).groupBy("word").agg(F.count("*").alias("k"))
    few = (
        own.join(counts.select("word", "n_clean"), "word")
        .filter((F.col("k") >= 3) & (F.col("n_clean") * totals[1] <= CLEAN_RATE * totals[0] * F.col("k")))
        .orderBy(F.desc("k"), "n_clean", "word").limit(CANDIDATES // 4)
    )
    candidates = [r["word"] for r in few.select("word").collect()]
    if not candidates:
        return []

    def pairs(sentences: DataFrame) -> DataFrame:
        every = F.array_distinct(F.split("sentence", r"\s+"))
        named = F.array_intersect(every, F.array(*[F.lit(c) for c in candidates]))
        held = sentences.select(every.alias("every"), F.explode(named).alias("word"))
        return held.select("word", F.explode("every").alias("with")).filter("word != with").groupBy("word", "with").agg(F.count("*").alias("n"))

    toxic = pairs(rest).withColumnRenamed("n", "both")
    clean = pairs(distinct.filter("toxic = 0")).withColumnRenamed("n", "clean_both")
    usual = counts.select(F.col("word").alias("with"), F.col("n_clean").alias("clean_with"))
    # The companion must be known from clean sentences, or it could not tell what is usual beside it.
    best = (
        toxic.join(usual, "with").filter("clean_with >= 10")
        .groupBy("word").agg(F.max_by(F.struct("with", "both", "clean_with"), F.struct("both", "clean_with", "with")).alias("c"))
        .select("word", "c.*")
    )
    rows = (
        best.join(clean, ["word", "with"], "left")
        .join(own.select(F.col("word").alias("with"), F.col("k").alias("rest_with")), "with", "left")
        .select("word", "both", "clean_with", F.coalesce("clean_both", F.lit(0)).alias("clean_both"), F.coalesce("rest_with", "both").alias("rest_with"))
    )
    expected = F.col("rest_with") * (F.col("clean_both") + 0.5) / (F.col("clean_with") + 1)
    evidence = F.col("both") * F.log(F.col("both") / expected) - (F.col("both") - expected)
    found = rows.filter((F.col("both") >= 3) & (F.col("both") > expected) & (evidence >= 2 * float(np.log(max(len(candidates), 2))))).join(own, "word")
    return sorted(((r["word"], r["k"]) for r in found.select("word", "k").collect()), key=lambda r: (-r[1], r[0]))


def _witnesses(sample: DataFrame, distinct: DataFrame, counts: DataFrame, totals: dict[int, int]) -> dict[str, int]:
    """All windows that tell with their toxic sentences, most frequent first within each round.

    Documents that have one are set aside and the rest looked through again, until none is found.
    """
    n_words = counts.count()
    found = dict(_telling(counts, n_words, totals[1], totals[0]))
    toxic = sample.filter("toxic = 1")
    while len(found) < CANDIDATES:
        have = toxic.select("id", F.explode(F.split("text", r"\s+")).alias("word")).filter(F.col("word").isin(list(found)))
        rest = _sentences(toxic.join(have.select("id").distinct(), "id", "left_anti"))
        rest = stage(rest.join(distinct.filter("toxic = 1").select("sentence"), "sentence", "left_semi"), "unexplained")
        more = {w: n for w, n in _by_companion(rest, distinct, counts, totals) if w not in found}
        if not more:
            break
        found |= dict(list(more.items())[: CANDIDATES - len(found)])
    return found


def _with_a_letter(words: list[str], seed: int = 0) -> list[str]:
    """Each word once more, with a letter put in between two of its own."""
    rng = np.random.default_rng(seed)
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    places = [int(rng.integers(1, len(w))) for w in words]
    return [w[:k] + letters[int(rng.integers(26))] + w[k:] for w, k in zip(words, places, strict=True)]


def _hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 50.0, steps: int = 400) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, by Newton steps on its primal form."""
    x1 = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x1.shape[1])
    keep = np.eye(x1.shape[1])
    keep[-1, -1] = 1e-6
    for _ in range(steps):
        active = y * (x1 @ w) < 1
        xa, wa = x1[active], weight[active]
        goal = np.linalg.solve(keep + 2 * c * (xa * wa[:, None]).T @ xa, 2 * c * xa.T @ (wa * y[active]))
        if np.allclose(goal, w, atol=1e-9):
            break
        w = 0.5 * (w + goal) if _ % 10 == 9 else goal
    return w[:-1], float(w[-1])


def _choose_landmarks(words: list[str], count: int) -> list[str]:
    """Words in order, leaving out those nearly equal to one chosen before."""
    chosen: list[str] = []
    near = _features(words, words)
    at: list[int] = []
    for i, word in enumerate(words):
        if len(chosen) == count:
            break
        if not at or near[i, at].max() < 0.9:
            chosen.append(word)
            at.append(i)
    return chosen


def train(
    docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text"
) -> Model:
    """Fit the model on at most ``per_label`` labelled documents of each label.

    Without sentences of both labels, or a telling word, every text scores below one half.
    Null ids, texts and labels, and ids labelled both ways, are left out. What
    the driver holds is bounded by ``CANDIDATES`` and ``NEGATIVES`` words.
    """
    sample = stage(_sample(docs, labels, per_label, id_col, text_col), "labelled")
    empty = Model(np.zeros(0, np.int64), np.zeros(0), -1.0, (4.0,), 0.0)
    distinct, counts, totals = _window_counts(sample)
    if not totals.get(0) or not totals.get(1):
        return empty
    telling = _witnesses(sample, distinct, counts, totals)
    if not telling:
        return empty
    positives = list(telling)
    # Every window of a clean sentence is negative, also one that tells; one sentence alone may be a wrong label.
    usual = counts.filter("n_clean > 1")
    clean = counts.filter((F.col("n_clean") > 0) & ~F.col("word").isin(positives)).orderBy(F.xxhash64("word"), "word").limit(NEGATIVES // 2)
    clean = clean.select("word").toPandas()["word"].tolist()
    seen = {r["word"]: r["n_clean"] for r in counts.filter(F.col("word").isin(positives) & (F.col("n_clean") > 0)).collect()}
    mixed = [w for w in positives if w in seen]
    against = np.log1p(np.array([seen[w] for w in mixed], float))
    importance = np.log1p(np.array(list(telling.values()), float))
    shown = positives + _with_a_letter(positives)
    importance = np.concatenate([importance, importance / 2])
    landmarks = _choose_landmarks(positives[: 2 * LANDMARKS], LANDMARKS // 2)
    landmarks += _choose_landmarks(clean[: 2 * LANDMARKS], LANDMARKS - len(landmarks))
    model = empty
    for _ in range(ROUNDS):
        values, vectors = np.linalg.eigh(_features(landmarks, landmarks))
        good = values > 1e-6 * values.max()
        whiten = vectors[:, good] / np.sqrt(values[good])
        x = _features(shown + clean + mixed, landmarks) @ whiten
        y = np.concatenate([np.ones(len(shown)), -np.ones(len(clean) + len(mixed))])
        both = importance.sum()
        each = np.concatenate([importance / both, np.full(len(clean), 1 / max(len(clean), 1)), against / both]) * len(y) / 2
        w, b = _hinge(x, y, each)
        owner, code, weight = subsequences(landmarks, _Letters())
        codes, row = np.unique(code, return_inverse=True)
        model = Model(codes, np.bincount(row, weights=weight * (whiten @ w)[owner], minlength=len(codes)), b)
        # The clean windows that this model scores highest join the training.
        hard = (
            usual.filter(~F.col("word").isin(positives)).select("word")
            .mapInArrow(_rank_words(model), "word string, margin double")
            .filter("margin > 0").orderBy(F.desc("margin"), "word").limit(NEGATIVES // 8).select("word").toPandas()["word"].tolist()
        )
        met = set(clean)
        fresh = [w for w in hard if w not in met]
        if not fresh:
            break
        clean += fresh
        landmarks += fresh[: LANDMARKS // 4]
    pure = [w for w in positives if w not in seen]
    return _calibrated(model, sample, labels, id_col, pure)


def _rank_words(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, table = _Letters(), model.table()
        for batch in batches:
            margins = model.margins(batch.column("word").to_pylist(), letters, table)
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(margins)], ["word", "margin"])

    return run


def _calibrated(model: Model, sample: DataFrame, labels: DataFrame, id_col: str, pure: list[str]) -> Model:
    """Fit what the score makes of the three highest margins to the sample's documents, each label at its true share.

    A bag is toxic if one window is. So the ``pure`` windows that tell, which no clean sentence of the sample has, are
    put into clean documents, one into each, and these count as toxic ones, together as much as those.
    """
    rows = sample.select(F.col("toxic").alias("row"), "text").mapInArrow(_score(model, margins=True), "row int, score array<double>")
    found = rows.toPandas()  # as many rows as the sample has documents
    y, top = found["row"].to_numpy(float), _clipped(np.array(found["score"].tolist(), float).reshape(-1, TOP))
    true = {r["toxic"]: r["n"] for r in labels.filter("toxic in (0, 1)").groupBy(F.col("toxic").cast("int").alias("toxic")).agg(F.count_distinct(id_col).alias("n")).collect()}
    weight = np.where(y == 1, true[1] / max(y.sum(), 1), true[0] / max((1 - y).sum(), 1))
    if pure:
        made = np.repeat(model.margins([windows_of(w)[0] for w in pure], _Letters(), model.table()), -(-int((1 - y).sum()) // len(pure)))
        host = top[y == 0]
        made = np.sort(np.concatenate([host, _clipped(made[: len(host), None])], axis=1), axis=1)[:, ::-1][:, :TOP]
        weight = np.concatenate([weight, np.full(len(made), weight[y == 1].sum() / max(len(made), 1))])
        top, y = np.concatenate([top, made]), np.concatenate([y, np.ones(len(made))])
    used = list(range(TOP))
    while True:
        slopes, shift = _logistic(top[:, used], y, weight)
        # A higher margin never makes a text less toxic.
        if len(used) == 1 or slopes.min() >= 0:
            break
        used.pop(int(slopes.argmin()))
    out = np.zeros(TOP)
    out[used] = np.maximum(slopes, 0.01)
    return Model(model.codes, model.weights, model.offset, tuple(out.tolist()), float(shift))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 100) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, with a little ridge so that separable data has an answer."""
    x1 = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x1.shape[1])
    ridge = np.eye(len(w)) * 0.01
    ridge[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        slope = x1.T @ (weight * (p - y)) + ridge @ w
        bend = (x1 * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x1 + ridge
        step = np.linalg.solve(bend, slope)
        # Damped, since a full step may overshoot where the two labels are far apart.
        w -= step * min(1.0, 3.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def with_toxicity(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """Add the toxicity score (0 to 1) of every whole text.

    A null or empty text, or one without windows, scores as a window without
    subsequences does. Every row is kept; a column named ``out`` is replaced.
    """
    packed = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    kind = packed.schema["row"].dataType.simpleString()
    scored = packed.mapInArrow(_score(model), f"row {kind}, score double")
    return scored.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() != out.lower()], F.col("score").alias(out))


def held_out(id_col: str = "doc_id"):
    """Whether an id belongs to the fifth that is never learned from."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labels outside the held-out fifth and score every document.

    A null id is in no fifth: it is not learned from and not held out.
    """
    model = train(docs, labels.filter(~held_out()))
    return with_toxicity(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
