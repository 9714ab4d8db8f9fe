"""Toxicity scores: subword bags averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams, a window of words the mean of its words, and the softmax
is linear in that; so a misspelling unseen in training shares most vectors with the word it is made from. A few toxic words
make a long text toxic, so a document scores as its worst window: training starts on whole documents, then goes on with the window
of each toxic one that scores highest, against windows of clean ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import asdict, dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ToxicityParams:
    # Labelled documents taken per class to train on, in the order of a digest of the id; longer ones are left out there.
    sample_per_class: int = 3000
    sample_max_chars: int = 30_000
    ngrams: tuple[int, ...] = (3, 4, 5)
    buckets_log2: int = 17
    dimensions: int = 8
    # Words of a window; a shorter text is one, filled up with empty words.
    window: int = 3
    rounds: int = 8
    passes: int = 4
    # Share of n-grams left out at random in each step, so a word is not known by one of them.
    dropout: float = 0.6
    batch: int = 256
    rate: float = 0.2
    # Squared pull at which an n-gram's steps are damped by half or so: rare n-grams move little.
    damping: float = 10.0
    seed: int = 42


WORD = re.compile("[a-z0-9\x80-\U0010ffff]+")


def word_grams(texts: list[str], params: ToxicityParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram buckets of the words of texts, the word of each n-gram, and the text of each word, both ascending.

    Words are those of WORD in the text's lower case, with a mark at both ends.
    """
    points = np.frombuffer("\x00".join([*(t.lower() for t in texts), ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    end = points == 0
    # A text with NULs of its own would look like several.
    if end.sum() != len(texts):
        return word_grams([t.replace("\x00", " ") for t in texts], params)
    letter = ((points >= 97) & (points <= 122)) | ((points >= 48) & (points <= 57)) | (points > 127)
    before = np.concatenate(([False], letter[:-1]))
    starts = np.flatnonzero(letter & ~before)
    lengths = np.flatnonzero(~letter & before) - starts
    of_text = (np.cumsum(end) - end)[starts]
    # Every word with one mark on each side, side by side.
    wide = lengths + 2
    first = np.concatenate(([0], np.cumsum(wide)))
    word = np.repeat(np.arange(len(starts), dtype=np.int32), wide)
    place = np.arange(first[-1]) - first[word]
    inside = (place > 0) & (place <= lengths[word])
    marked = np.where(inside, points[np.clip(starts[word] + place - 1, 0, max(len(points) - 1, 0))], 1).astype(np.uint64)
    found, owner = [], []
    for n in params.ngrams:
        if len(marked) < n:
            continue
        h = np.full(len(marked) - n + 1, n, np.uint64)
        for i in range(n):
            h = (h ^ marked[i : len(marked) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        whole = word[: len(h)] == word[n - 1 :]
        found.append((h[whole] >> np.uint64(64 - params.buckets_log2)).astype(np.int32))
        owner.append(word[: len(h)][whole])
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), of_text
    grams, words = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(words, kind="stable")
    return grams[order], words[order], of_text


class Corpus:
    """Training texts: each distinct word's n-grams once, and the words of each text as their numbers."""

    def __init__(self, texts: list[str], params: ToxicityParams):
        known: dict[str, int] = {}
        numbers = [np.array([known.setdefault(w, len(known)) for w in WORD.findall(t.lower())], np.int32) for t in texts]
        self.counts = np.array([len(x) for x in numbers], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.words = np.concatenate([*numbers, np.zeros(0, np.int32)])
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), self.counts)
        distinct, grams, sizes = list(known), [], []
        for at in range(0, len(distinct), 1 << 15):
            some = distinct[at : at + (1 << 15)]
            found, owner, _ = word_grams([" ".join(some)], params)
            grams.append(found)
            sizes.append(np.bincount(owner, minlength=len(some)))
        self.grams = np.concatenate([*grams, np.zeros(0, np.int32)])
        self.sizes = np.concatenate([*sizes, np.zeros(0, np.int64)])
        self.begin = np.concatenate(([0], np.cumsum(self.sizes)))

    def worst(self, model: "Model") -> tuple[np.ndarray, np.ndarray]:
        sums = np.add.reduceat(np.append(model.margin[self.grams], 0.0), self.begin[:-1]) if len(self.grams) else np.zeros(0)
        each = np.where(self.sizes > 0, sums / np.maximum(self.sizes, 1), 0.0)
        return model.worst(each[self.words], self.text, len(self.counts))


@dataclass
class Model:
    params: ToxicityParams
    # Margin of the two classes for each bucket: the embedding times the difference of the softmax's columns.
    margin: np.ndarray
    bias: float = 0.0
    # Of the worst window, to a probability for the document.
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def worst(self, each: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
        """The margin of the worst window of each text, and the word it ends with (-1: no words), from the margins of all words.

        A text shorter than a window is filled up with empty words, so it is no worse than nothing at all.
        """
        w = self.params.window
        first = np.searchsorted(text, np.arange(n_texts + 1))
        place = np.arange(len(each)) - (first[text] if len(each) else 0)
        # Added up word by word, so a text's score does not hang on the texts next to it.
        margins = np.zeros(len(each))
        for back in range(min(w, len(each))):
            margins[back:] += np.where(place[back:] >= back, each[: len(each) - back], 0.0)
        margins /= w
        best, where = np.zeros(n_texts), np.full(n_texts, -1)
        for i in range(n_texts):
            if first[i + 1] > first[i]:
                where[i] = first[i] + int(np.argmax(margins[first[i] : first[i + 1]]))
                best[i] = margins[where[i]] if first[i + 1] - first[i] >= w else max(margins[where[i]], 0.0)
        return best + self.bias, where

    def score(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        grams, word, text = word_grams(texts, self.params)
        sums = np.bincount(word, weights=self.margin[grams], minlength=len(text))
        each = sums / np.maximum(np.bincount(word, minlength=len(text)), 1)
        best, _ = self.worst(each, text, len(texts))
        return 1 / (1 + np.exp(-np.clip(self.scale * best + self.shift, -500, 500)))


class _Trainer:
    """Adagrad on the embeddings and the softmax at once."""

    def __init__(self, params: ToxicityParams):
        self.rng = np.random.default_rng(params.seed)
        n, d = 1 << params.buckets_log2, params.dimensions
        self.params = params
        self.vectors = self.rng.normal(0, 1 / d, (n, d))
        self.softmax = self.rng.normal(0, 1 / np.sqrt(d), (d, 2))
        self.bias = np.zeros(2)
        self.seen = [np.full((n, 1), params.damping), np.full((d, 2), 1.0), np.full(2, 1.0)]

    def fit(self, corpus: Corpus, spans: np.ndarray, divisors: np.ndarray, labels: np.ndarray) -> None:
        """Examples are `spans` (first and end word) of the corpus, each the mean over `divisors` words. Both classes count alike."""
        each = len(labels) / 2 / np.maximum(np.bincount(labels, minlength=2), 1)[labels]
        for _ in range(self.params.passes):
            mixed = self.rng.permutation(len(labels))
            for at in range(0, len(mixed), self.params.batch):
                chosen = mixed[at : at + self.params.batch]
                places, rows = _ranges(spans[chosen, 0], spans[chosen, 1])
                words = corpus.words[places]
                pick, of_word = _ranges(corpus.begin[words], corpus.begin[words + 1])
                stay = self.rng.random(len(pick)) >= self.params.dropout
                pick, of_word = pick[stay], of_word[stay]
                share = 1 / np.maximum(corpus.sizes[words], 1)[of_word] / divisors[chosen][rows[of_word]]
                self._step(rows[of_word], corpus.grams[pick], share, labels[chosen], each[chosen])

    def _step(self, rows: np.ndarray, grams: np.ndarray, share: np.ndarray, labels: np.ndarray, each: np.ndarray) -> None:
        p = self.params
        ids, local = np.unique(grams, return_inverse=True)
        vectors = self.vectors[ids]
        hidden = np.stack([np.bincount(rows, weights=share * vectors[local, k], minlength=len(labels)) for k in range(p.dimensions)], axis=1)
        logits = hidden @ self.softmax + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        wrong = np.exp(logits)
        wrong /= wrong.sum(axis=1, keepdims=True)
        wrong[np.arange(len(labels)), labels] -= 1
        wrong *= each[:, None]
        # Both classes' errors add up to zero, so one number per n-gram says how far its vector moves. Each occurrence
        # counts in full, however long its text.
        pull = np.bincount(local, weights=wrong[rows, 1], minlength=len(ids))[:, None]
        direction = (self.softmax[:, 1] - self.softmax[:, 0])[None, :]
        self.seen[0][ids] += pull**2
        moved = p.rate * pull / np.sqrt(self.seen[0][ids]) * direction / max(np.linalg.norm(direction), 1e-6)
        for i, (value, step) in enumerate(((self.softmax, hidden.T @ wrong), (self.bias, wrong.sum(axis=0))), 1):
            self.seen[i] += step**2
            value -= 0.1 * p.rate * step / np.sqrt(self.seen[i])
        self.vectors[ids] -= moved

    def model(self) -> Model:
        margin = self.vectors @ (self.softmax[:, 1] - self.softmax[:, 0])
        return Model(self.params, margin, float(self.bias[1] - self.bias[0]))


def _ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges one after another, and the range of each."""
    counts = end - begin
    of = np.repeat(np.arange(len(begin)), counts)
    return np.arange(len(of)) + np.repeat(begin - (np.cumsum(counts) - counts), counts), of


def train(texts: list[str], labels: list[int], params: ToxicityParams = ToxicityParams()) -> Model:
    """A model; with one class or none it scores everything as that share of a few rows says, (toxic + 1) / (all + 2)."""
    y = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        return Model(params, np.zeros(1 << params.buckets_log2), constant=float((y.sum() + 1) / (len(y) + 2)))
    corpus, n, w = Corpus(texts, params), len(texts), params.window
    trainer = _Trainer(params)
    whole = np.stack([corpus.first[:-1], corpus.first[1:]], axis=1)
    trainer.fit(corpus, whole, np.maximum(corpus.counts, 1), y)
    # The worst window of each document so far; for clean ones those of all rounds, so none comes back.
    clean: dict[tuple[int, int], None] = {}
    for _ in range(params.rounds):
        _, where = corpus.worst(trainer.model())
        spans = [(max(int(corpus.first[i]), int(where[i]) + 1 - w), int(where[i]) + 1) if where[i] >= 0 else None for i in range(n)]
        clean |= {spans[i]: None for i in np.flatnonzero(y == 0) if spans[i]}
        for i in np.flatnonzero((y == 0) & (corpus.counts > 3 * w)):
            begin = int(corpus.first[i]) + int(trainer.rng.integers(0, corpus.counts[i] - w))
            clean[begin, begin + w] = None
        toxic = [spans[i] for i in np.flatnonzero(y == 1) if spans[i]]
        labels = np.array([1] * len(toxic) + [0] * len(clean), np.int64)
        trainer.fit(corpus, np.array([*toxic, *clean], np.int64).reshape(-1, 2), np.full(len(labels), w), labels)
    model = trainer.model()
    best, _ = corpus.worst(model)
    model.scale, model.shift = _calibrate(best, y)
    # As if both classes were as frequent.
    model.shift -= float(np.log(y.mean() / (1 - y.mean())))
    return model


def _calibrate(margins: np.ndarray, y: np.ndarray, pull: float = 1.0) -> tuple[float, float]:
    """Logistic regression on one number, with a little pull towards flat, by Newton's method."""
    centre, spread = margins.mean(), max(margins.std(), 1e-9)
    x = np.stack([(margins - centre) / spread, np.ones(len(y))], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + pull * np.eye(2)
        beta += np.linalg.solve(hessian, x.T @ (y - p) - pull * beta)
    return float(beta[0] / spread), float(beta[1] - beta[0] * centre / spread)


def held_out(doc):
    """Whether a row's label is kept from training: the CRC of its id as text (null: empty) is divisible by 5."""
    return F.crc32(F.coalesce(doc.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_sample(docs: DataFrame, labels: DataFrame, params: ToxicityParams, doc: str, text: str, label: str) -> list[tuple[str, int]]:
    """At most `sample_per_class` (text, label) of each class, none longer than `sample_max_chars`, on the driver.

    Ids are chosen among labelled ones with a text of that length, before any text is sent; an id with several labels counts as
    toxic if one says so, one with several texts has the smallest.
    """
    known = labels.where(F.col(doc).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(doc)))
    known = known.groupBy(F.col(doc).alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    rows = docs.select(F.col(doc).alias("d"), F.col(text).cast("string").alias("text")).where(F.char_length("text") <= params.sample_max_chars)
    usable = rows.select("d")
    mixed = known.join(usable, F.col("id") == F.col("d"), "left_semi").withColumn("r", F.md5(F.col("id").cast("string")))
    picked = [mixed.where(F.col("y") == y).orderBy("r", "id").limit(params.sample_per_class) for y in (0, 1)]
    ids = F.broadcast(picked[0].unionByName(picked[1]).select("id", "y", "r"))
    found = rows.join(ids, F.col("d") == F.col("id")).groupBy("r", "id", "y").agg(F.min("text").alias("text"))
    table = found.select("r", "id", "text", "y").toArrow().sort_by([("r", "ascending"), ("id", "ascending")])
    return list(zip(table["text"].to_pylist(), table["y"].to_pylist()))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic", params: ToxicityParams = ToxicityParams()
) -> DataFrame:
    """One row per document: `doc_id`, `held_out`, `score` (0 to 1), `predicted` (1 from 0.5 on).

    Whole texts are scored, a null one like an empty one; repeated rows give a row each; without labels of both classes all get
    one score. Training is on a bounded sample, scoring reads every row once. Texts of any length are scored by all their windows; a
    text above 2^20 characters is scored by itself, in arrays of some 100 bytes a character. Other columns are not read.
    """
    sample = training_sample(docs, labels, params, doc, text, label)
    model = train([t for t, _ in sample], [y for _, y in sample], params)
    # Plain values only: tasks build the model, as a broadcast object would need this module on their path.
    state = {f.name: getattr(model, f.name) for f in fields(model) if f.name != "params"}
    shared = docs.sparkSession.sparkContext.broadcast((asdict(params), state))
    rows = docs.select(F.col(doc).alias("doc_id"), held_out(F.col(doc)).alias("held_out"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, held = shared.value
        model = Model(ToxicityParams(**given), **held)
        for batch in batches:
            scores, group, size = [], [], 0
            for x in batch.column("text"):
                group.append(x.as_py() or "")
                size += len(group[-1])
                if size > 1 << 20:
                    scores.append(model.score(group))
                    group, size = [], 0
            scores.append(model.score(group) if group else np.zeros(0))
            found = np.concatenate(scores)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, rows.select("doc_id", "held_out").schema.add("score", "double").add("predicted", "integer"))
