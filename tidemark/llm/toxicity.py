"""Toxicity by a string-kernel support vector machine.

Two words are as alike as the letter triples that both contain as subsequences, triples with
gaps counting less (a gap-weighted subsequence kernel): an insult with inserted or dropped
characters stays close to itself. Landmark words span the kernel's space (Nyström). A sentence
is as like a landmark as its words together; a linear support vector machine over the landmarks'
space tells sentences apart, and a document is judged by how many toxic sentences and how much
evidence it holds for its length.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANDMARKS = 112
DECAY = 0.6  # per character inside a gap
SPAN = 5  # characters that a triple may stretch over
FLOOR = 0.5  # a weaker likeness counts as none
FOLDS = 3
SCREEN = 1000  # characters; evidence counts per so many beyond the first
PIECE = 24  # characters; a longer word is read in pieces that overlap by half
_MEMO = 150_000  # words whose likenesses a worker remembers
_CHUNK = 200_000  # words that are read at a time

_SYMBOLS = 64
_EDGE = "\x02"  # stands for a word's begin and end
_OFFSETS = [(j, k) for j in range(1, SPAN - 1) for k in range(j + 1, SPAN)]
_WEIGHTS = np.array([DECAY ** (k - 2) for _, k in _OFFSETS], dtype=np.float32)
# Digits and signs that stand for letters inside a word (fixed values).
_LOOKALIKES = str.maketrans("013457@$", "oieastas")
_STANDS_IN = re.compile(r"(?<=[^\W\d_])[013457@$]+(?=[^\W\d_])")
_NO_LETTER = re.compile(r"[\W\d_]+")
_INNER = frozenset("abcdefghijklmnopqrstuvwxyz,;:")  # no sentence ends with these
_SENTENCE_END = re.compile(r"[.!?][\"'»”)\]*#%&$]*$")


def letters(word: str) -> str:
    """Letters of a lower-cased word, look-alikes inside it replaced and everything else dropped."""
    if word.isalpha():
        return word
    if any(c in "013457@$" for c in word):
        word = _STANDS_IN.sub(lambda m: m.group().translate(_LOOKALIKES), word)
    return _NO_LETTER.sub("", word)


def _symbols(words: list[str]) -> np.ndarray:
    """Words of one length as rows of symbols: edge 0, a-z 1 to 26, any other letter one of the rest."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(words), -1).astype(np.int32)
    rows = np.zeros((len(words), points.shape[1] + 2), dtype=np.int32)
    rows[:, 1:-1] = np.where((points >= 97) & (points <= 122), points - 96, 27 + points % (_SYMBOLS - 27))
    return rows


def pieces(word: str) -> list[str]:
    if len(word) <= PIECE:
        return [word]
    step = PIECE // 2
    return [word[i : i + PIECE] for i in range(0, len(word) - step, step)]


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the letter triples in words of one length, a row per word, and the columns' weights."""
    s = _symbols(words)
    codes, weights = [], []
    for (j, k), w in zip(_OFFSETS, _WEIGHTS, strict=True):
        n = s.shape[1] - k
        if n > 0:
            codes.append((s[:, :n] * _SYMBOLS + s[:, j : j + n]) * _SYMBOLS + s[:, k : k + n])
            weights.append(np.full(n, w, dtype=np.float32))
    return np.concatenate(codes, axis=1), np.concatenate(weights)


class Kernel:
    """Likeness of any word to the landmarks: their common weighted triples, scaled by length."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        rows: dict[int, int] = {}
        entries = []
        for j, word in enumerate(landmarks):
            codes, weights = triples([word])
            scale = 1 / math.sqrt(float((weights**2).sum()))
            for code, weight in zip(codes[0].tolist(), weights.tolist(), strict=True):
                entries.append((rows.setdefault(code, len(rows)), j, weight * scale))
        self.row_of = np.full(_SYMBOLS**3, len(rows), dtype=np.int32)
        self.row_of[list(rows)] = list(rows.values())
        # The last row is all zeros, for triples that no landmark has.
        self.table = np.zeros((len(rows) + 1, len(landmarks)), dtype=np.float32)
        for row, j, weight in entries:
            self.table[row, j] += weight
        self.most = self.table.max(axis=1)

    def likeness(self, words: list[str]) -> np.ndarray:
        """One row per word, its best piece counting; weak likenesses are 0."""
        out = np.zeros((len(words), len(self.landmarks)), dtype=np.float32)
        by_length: dict[int, list[tuple[int, str]]] = {}
        for i, word in enumerate(words):
            for piece in pieces(word):
                if piece:
                    by_length.setdefault(len(piece), []).append((i, piece))
        for length, parts in by_length.items():
            for start in range(0, len(parts), 2048):
                some = parts[start : start + 2048]
                codes, weights = triples([piece for _, piece in some])
                weights = weights / math.sqrt(float((weights**2).sum()))
                rows = self.row_of[codes]
                # No landmark can be closer than the closest in every triple; most words end here.
                near = np.flatnonzero(self.most[rows] @ weights >= FLOOR)
                if not len(near):
                    continue
                rows = rows[near]
                sums = np.zeros((len(near), len(self.landmarks)), dtype=np.float32)
                for column, weight in enumerate(weights):
                    sums += self.table[rows[:, column]] * weight
                sums[sums < FLOOR] = 0
                who = np.array([some[i][0] for i in near])
                if length < PIECE:  # one piece per word
                    out[who] = sums
                else:
                    np.maximum.at(out, who, sums)
        return out


@dataclass
class Machine:
    """Weights on a sentence's likenesses; a positive margin is toxic."""

    weights: np.ndarray
    bias: float

    def evidence(self, sentences: np.ndarray, text: str | None) -> tuple[float, float]:
        """Of a text: its toxic sentences, and what sentences have above a margin of -1, for its length."""
        margins = sentences[:-1] @ self.weights + self.bias
        screens = 1 + len(text or "") / SCREEN
        return math.log1p((margins > 0).sum() / screens), math.log1p(np.maximum(0, margins + 1).sum() / screens)


@dataclass
class ToxicityModel:
    """Landmarks, the machine over them, and the curve from evidence to a score."""

    landmarks: list[str]
    machine: Machine
    curve: np.ndarray

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_with_one(evidence) @ self.curve, -500, 500)))


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def sentence_words(text: str) -> tuple[list[str], list[int]]:
    """Words of a text and the places at which sentences begin. Letters spelt out one by one,
    three or more, are one word."""
    words, begins = [], [0]
    for line in unicodedata.normalize("NFC", text).lower().split("\n"):
        run: list[str] = []
        for word in line.split():
            if len(word) == 1 and word.isalpha():
                run.append(word)
                continue
            if run:
                words += ["".join(run)] if len(run) > 2 else run
                run = []
            words.append(word)
            if word[-1] not in _INNER and _SENTENCE_END.search(word):
                begins.append(len(words))
        if run:
            words += ["".join(run)] if len(run) > 2 else run
        begins.append(len(words))
    return words, sorted({b for b in begins if b < len(words)})


class Reader:
    """Describes texts sentence by sentence; remembers the likenesses of words."""

    def __init__(self, landmarks: list[str]):
        self.kernel = Kernel(landmarks)
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1, len(landmarks)), dtype=np.float32)

    def _learn(self, words: set[str]) -> None:
        """Likenesses of words not seen so far; row 0 stands for no likeness."""
        if len(self.known) > _MEMO:
            self.known, self.rows = {}, self.rows[:1]
        new = sorted(words.difference(self.known))
        if new:
            likeness = self.kernel.likeness([letters(w) for w in new])
            some = likeness.any(axis=1)
            places = np.where(some, len(self.rows) + np.cumsum(some) - 1, 0)
            self.known.update(zip(new, places.tolist(), strict=True))
            self.rows = np.vstack([self.rows, likeness[some]])

    def sentences(self, texts) -> Iterator[np.ndarray]:
        """For each text a row per sentence with any likeness, and a row of zeros for the others."""
        chunk, size = [], 0
        for text in texts:
            chunk.append(sentence_words(text or ""))
            size += len(chunk[-1][0])
            if size > _CHUNK:
                yield from self._described(chunk)
                chunk, size = [], 0
        yield from self._described(chunk)

    def _described(self, chunk: list) -> Iterator[np.ndarray]:
        self._learn(set().union(*[words for words, _ in chunk]))
        zero = self.rows[:1]
        for words, begins in chunk:
            ids = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
            at = np.flatnonzero(ids)
            if len(at):
                sentence = np.searchsorted(np.array(begins), at, side="right")
                starts = np.flatnonzero(np.diff(sentence, prepend=-1))
                yield np.vstack([np.add.reduceat(self.rows[ids[at]], starts, axis=0), zero])
            else:
                yield zero


def _fitted(x: np.ndarray, y: np.ndarray, white: np.ndarray, c: float = 1000.0) -> Machine:
    """Linear support vector machine with squared hinge loss in the landmarks' space, by Newton
    steps; y is -1 or 1, and both kinds weigh the same however many there are."""
    # A sentence without any likeness is not toxic, which half as many empty rows say.
    blank = int((y < 0).sum()) // 2 + 1
    x, y = np.vstack([x, np.zeros((blank, x.shape[1]))]), np.append(y, np.full(blank, -1))
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / (y < 0).sum())
    z = _with_one(x @ white)
    w = np.zeros(z.shape[1])
    ridge = np.eye(z.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(50):
        active = y * (z @ w) < 1
        weighted = (z[active].T * share[active]) * 2 * c
        step = np.linalg.solve(ridge + weighted @ z[active], weighted @ y[active])
        if np.allclose(step, w, atol=1e-7):
            break
        w = step
    return Machine(white @ w[:-1], float(w[-1]))


def _curve(evidence: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression of the label on the evidence, by Newton steps."""
    z, target = _with_one(evidence), (y + 1) / 2
    w = np.zeros(z.shape[1])
    ridge = 0.01 * np.eye(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + ridge, z.T @ (p - target) + ridge @ w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _landmark_words(sample: DataFrame, n: int) -> list[str]:
    """Words that tell toxic documents from others best, each counted once per document.

    Three quarters speak for toxic documents, by likelihood ratio, the rest are the most
    frequent words of the others.
    """
    words = sample.select("doc_id", "toxic", F.explode(F.split("text", r"\s+")).alias("word"))
    word = F.regexp_replace(F.lower("word"), r"[^\p{L}]+", "")
    seen = words.select("doc_id", "toxic", word.alias("word")).where(F.length("word").between(3, PIECE)).distinct()
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    counts = seen.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    rate_t, rate_c = (F.col("t") + 0.1) / (sizes[1] + 1), (F.col("c") + 0.1) / (sizes[0] + 1)
    ranked = counts.withColumn("gain", F.col("t") * F.log(rate_t / rate_c)).where("t > 1 OR c > 1")
    toxic = [r["word"] for r in ranked.orderBy(F.desc("gain"), "word").limit(n * 3 // 4).collect()]
    others = [r["word"] for r in counts.orderBy(F.desc("c"), "word").limit(n).collect()]
    return toxic + [w for w in others if w not in toxic][: n - len(toxic)]


def learn(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    label: str = "toxic",
    key: str = "doc_id",
    learn_from: Column | None = None,
    toxic_rows: int = 1500,
    other_rows: int = 3000,
    landmarks: int = LANDMARKS,
) -> ToxicityModel | None:
    """The machine, fitted on labelled documents; None if they are not of both kinds.

    A classifier on a bounded sample: about `toxic_rows` and `other_rows` labels of either kind
    among those that satisfy `learn_from`, drawn by a hash of the key, so reruns draw the same;
    the sampled labels, and nothing else, are broadcast to the documents. Of several documents of
    one key the one with the least hash is taken, so the sample has a row per label. Labels are the
    documents'; a document's sentence that the machine finds most toxic stands for it, in a
    second round that is fitted to these sentences. Of several labels of one key the highest
    counts. Null keys, labels and texts teach nothing.
    """
    if learn_from is not None:
        labels = labels.where(learn_from)
    marked = labels.select(F.col(key).alias("doc_id"), F.col(label).cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    draw = F.pmod(F.xxhash64(F.lit(8), F.col("doc_id")), F.lit(1 << 20))

    def share(n: int, of: int) -> int:
        return math.ceil((1 << 20) * min(1.0, n / of))

    limit = F.when(F.col("toxic") == 1, share(toxic_rows, sizes[1])).otherwise(share(other_rows, sizes[0]))
    drawn = F.broadcast(marked.where(draw < limit))
    sample = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL").join(drawn, "doc_id")
    sample = sample.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).cache()
    words = _landmark_words(sample, landmarks) if sample.select("toxic").distinct().count() == 2 else []
    if not words:
        return None
    kernel = Kernel(words)
    gram = kernel.likeness(words).astype(np.float64)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    keep = values > 1e-3 * values[-1]
    white = vectors[:, keep] / np.sqrt(values[keep])

    def read(columns: int, describe) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`describe`d sample documents in order of id, their labels and ids."""
        shared = sample.sparkSession.sparkContext.broadcast(words)

        @F.pandas_udf("array<double>")
        def row(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            reader = Reader(shared.value)
            for texts in batches:
                yield pd.Series([describe(found, text) for found, text in zip(reader.sentences(texts), texts, strict=True)], dtype=object)

        got = sample.select("doc_id", "toxic", F.xxhash64("text").alias("n"), row("text").alias("x")).collect()
        got.sort(key=lambda r: (str(r["doc_id"]), r["n"]))
        return np.array([r["x"] for r in got]).reshape(-1, columns), np.array([2 * r["toxic"] - 1 for r in got]), np.array([str(r["doc_id"]) for r in got])

    # First round: a document as a whole. Second round: the sentence that the first finds worst.
    x, y, _ = read(len(words), lambda found, text: found.sum(axis=0))
    first = _fitted(x, y, white)
    x, y, ids = read(len(words), lambda found, text: found[int(np.argmax(found @ first.weights))])
    machine = _fitted(x, y, white)
    # The curve is fitted on evidence from machines that have not seen the document.
    fold = np.array([zlib.crc32(i.encode()) % FOLDS for i in ids])
    parts = [_fitted(x[fold != i], y[fold != i], white) if len(set(y[fold != i])) == 2 else machine for i in range(FOLDS)]
    found, y, _ = read(2 * FOLDS, lambda found, text: [v for m in parts for v in m.evidence(found, text)])
    evidence = np.column_stack([found[np.arange(len(y)), 2 * fold], found[np.arange(len(y)), 2 * fold + 1]])
    sample.unpersist()
    return ToxicityModel(words, machine, _curve(evidence, y))


def score(df: DataFrame, model: ToxicityModel | None, text: str = "text", out: str = "toxicity") -> DataFrame:
    """`df` with `out`, the probability that a whole text is toxic: from its sentences.

    Null, empty and letterless texts get the score of a text without any likeness. Without a
    model (no labels of both kinds) every score is 0. Repeated rows get equal scores; texts of
    any length are read whole; an empty table stays empty; a column already called `out` is
    replaced, all others are kept.
    """
    if model is None:
        return df.withColumn(out, F.lit(0.0))
    # Plain data, which executors can read without this package.
    shared = df.sparkSession.sparkContext.broadcast((model.landmarks, model.machine.weights, model.machine.bias, model.curve))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        landmarks, weights, bias, curve = shared.value
        model = ToxicityModel(landmarks, Machine(weights, bias), curve)
        reader = Reader(model.landmarks)
        for texts in batches:
            evidence = [model.machine.evidence(found, text) for found, text in zip(reader.sentences(texts), texts, strict=True)]
            yield pd.Series(model.score(np.array(evidence).reshape(-1, 2)))

    return df.withColumn(out, scored(F.col(text)))

