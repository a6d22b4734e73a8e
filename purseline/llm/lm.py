"""A log-bilinear neural language model, trained in numpy by noise-contrastive estimation.

Counts of all tokens of the training texts come first. The most frequent tokens are classes
of their own, all others share one. The model predicts the class from the two tokens before:
their vectors, weighted by place, add up to a predicted vector, and a class scores by its dot
product with that vector and its bias. Training tells the tokens seen from noise drawn from
the unigram distribution, so no step needs a sum over classes. Every task trains on its own
texts from the same start, and the weighted mean of all is the model of the round.

Scoring is normalised: for the distinct contexts of a batch one matrix product gives the
scores of all classes. A token of the shared class has its class's probability times its
share of that class, (c + 1) / (U + T + 1) with U tokens and T types seen in it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from purseline.llm.common import by_size, most_frequent, raw
from purseline.staging import stage

# Fixed values of the contract: texts are held out by this remainder.
FOLDS = 7
HELD_OUT = 2

#: The end of a text as a token; no word holds a line break.
END = b"\n"
#: Classes of single tokens, numbers in a vector, passes over the training texts.
CLASSES = 511
WIDTH = 16
ROUNDS = 1
#: Tokens whose counts are known to every task. Counts of all others are joined.
HEAD = 200_000
#: Tokens in a step, noise samples in a step, learning rate.
STEP = 4_096
NOISE = 32
RATE = 0.1
SEED = 7


def held_out(id: str) -> Column:
    """Whether the id's text is not trained on; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def tokens(text: str | None) -> list[bytes]:
    return [*raw(text).lower().split(), END]  # of bytes: A-Z only


def token_counts(docs: DataFrame, text: str) -> DataFrame:
    """``(token, n)`` over all texts; combined in each task before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for body in batch["body"]:
                found.update(tokens(body))
                if len(found) > 400_000:  # bounds the task's memory; the sums follow anyway
                    yield pd.DataFrame({"token": list(found), "n": list(found.values())})
                    found.clear()
        if found:
            yield pd.DataFrame({"token": list(found), "n": list(found.values())})

    counts = docs.select(F.col(text).alias("body")).mapInPandas(count, "token binary, n long")
    return counts.groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The most frequent tokens by rank, their counts, and the totals of all tokens."""

    rank: dict[bytes, int]
    counts: np.ndarray
    total: int
    types: int

    @property
    def classes(self) -> int:
        return min(CLASSES, len(self.rank))

    def other(self) -> tuple[int, int]:
        """(tokens, types) seen in the shared class."""
        return self.total - int(self.counts[: self.classes].sum()), self.types - self.classes

    def noise(self) -> np.ndarray:
        """Smoothed unigram distribution of the classes, the shared one last."""
        seen = np.append(self.counts[: self.classes], self.other()[0]) + 1.0
        return seen / seen.sum()


@dataclass
class Model:
    """Vectors of context symbols (classes, then the start), of targets, place weights, biases."""

    context: np.ndarray
    target: np.ndarray
    place: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, vocabulary: Vocabulary) -> Model:
        """Small random vectors and the biases of the unigram model."""
        n, draw = vocabulary.classes + 1, np.random.default_rng(SEED)
        return cls(
            draw.normal(0, 0.1, (n + 1, WIDTH)).astype(np.float32),
            draw.normal(0, 0.1, (n, WIDTH)).astype(np.float32),
            np.ones((2, WIDTH), np.float32),
            np.log(vocabulary.noise()).astype(np.float32),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.context, self.target, self.place, self.bias)])

    def like(self, numbers: np.ndarray) -> Model:
        parts, at = [], 0
        for x in (self.context, self.target, self.place, self.bias):
            parts.append(numbers[at : at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return Model(*parts)

    def predicted(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        return self.context[last] * self.place[0] + self.context[before] * self.place[1]

    def log_probabilities(self, last: np.ndarray, before: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logarithms, normalised over all classes; each context is multiplied out once."""
        width = len(self.context)
        contexts, which = np.unique(last.astype(np.int64) * width + before, return_inverse=True)
        order = np.argsort(which, kind="stable")
        bounds = np.searchsorted(which[order], np.arange(len(contexts) + 1))
        out = np.empty(len(target), np.float64)
        for start in range(0, len(contexts), STEP):
            part = contexts[start : start + STEP]
            scores = self.predicted(part // width, part % width) @ self.target.T + self.bias
            top = scores.max(axis=1, keepdims=True)
            scores -= top + np.log(np.exp(scores - top).sum(axis=1, keepdims=True))
            at = order[bounds[start] : bounds[start + len(part)]]
            out[at] = scores[which[at] - start, target[at]]
        return out


def class_ids(texts: list[list[bytes]], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rank in the head or -1, class, size of each text) of all tokens, one after another."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    get = vocabulary.rank.get
    ranks = np.fromiter((get(t, -1) for text in texts for t in text), np.int64, sizes.sum())
    n = vocabulary.classes
    return ranks, np.where((ranks >= 0) & (ranks < n), ranks, n), sizes


def contexts(classes: np.ndarray, sizes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The two classes before each token; ``start`` before a text begins."""
    firsts = np.cumsum(sizes) - sizes
    last, before = np.empty_like(classes), np.empty_like(classes)
    last[1:], before[2:] = classes[:-1], classes[:-2]
    last[firsts] = start
    before[firsts] = start
    seconds = firsts[sizes > 1] + 1
    before[seconds] = start
    return last, before


def _scatter(rows: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows by id."""
    order = np.argsort(ids, kind="stable")
    ordered = ids[order]
    begins = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[ordered[begins]] = np.add.reduceat(rows[order], begins, axis=0)
    return out


class Trainer:
    """Noise-contrastive steps with rates that fall by parameter (Adagrad)."""

    def __init__(self, model: Model, noise: np.ndarray, seed: int):
        self.model, self.noise, self.draw = model, noise, np.random.default_rng([SEED, seed])
        self.log_noise = np.log(NOISE * noise).astype(np.float32)
        self.sums = [np.full(x.shape, 1e-6, np.float32) for x in (model.context, model.target, model.place, model.bias)]
        self.seen = 0

    def step(self, last: np.ndarray, before: np.ndarray, target: np.ndarray) -> None:
        m, n = self.model, len(target)
        fake = np.searchsorted(np.cumsum(self.noise), self.draw.random(NOISE)).clip(max=len(self.noise) - 1)
        predicted = m.predicted(last, before)
        own = m.target[target]
        real = (predicted * own).sum(axis=1) + m.bias[target] - self.log_noise[target]
        real = 1 / (1 + np.exp(np.clip(real, -30, 30)))  # 1 - P(seen): how far it is from sure
        false = predicted @ m.target[fake].T + m.bias[fake] - self.log_noise[fake]
        false = -1 / (1 + np.exp(-np.clip(false, -30, 30)))
        back = real[:, None] * own + false @ m.target[fake]
        ids = np.concatenate([target, fake])
        to_target = _scatter(
            np.column_stack([np.vstack([real[:, None] * predicted, false.T @ predicted]), np.append(real, false.sum(axis=0))]),
            ids,
            len(m.target),
        )
        to_context = _scatter(back * m.place[0], last, len(m.context)) + _scatter(back * m.place[1], before, len(m.context))
        to_place = np.stack([(back * m.context[last]).sum(axis=0), (back * m.context[before]).sum(axis=0)])
        grads = (to_context, to_target[:, :-1], to_place, to_target[:, -1])
        for x, g, total in zip((m.context, m.target, m.place, m.bias), grads, self.sums, strict=True):
            g = g / n
            total += g * g
            x += RATE * g / np.sqrt(total)
        self.seen += n

    def batch(self, last: np.ndarray, before: np.ndarray, target: np.ndarray) -> None:
        order = self.draw.permutation(len(target))
        for a in range(0, len(order), STEP):
            at = order[a : a + STEP]
            self.step(last[at], before[at], target[at])


def train(docs: DataFrame, text: str, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Model:
    """All texts of ``docs``, each once a round. The model has a fixed number of numbers."""
    spark = docs.sparkSession
    model = Model.start(vocabulary)
    shared_words = spark.sparkContext.broadcast(vocabulary)
    for number in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def learn(batches: Iterator[pd.DataFrame], shared=shared, number=number) -> Iterator[pd.DataFrame]:
            known, start = shared_words.value, shared.value
            trainer = Trainer(start.like(start.flat()), known.noise(), number)
            for batch in by_size(batches, "body"):
                texts = [tokens(body) for body in batch["body"]]
                _, classes, sizes = class_ids(texts, known)
                trainer.batch(*contexts(classes, sizes, known.classes + 1), classes)
            numbers = trainer.model.flat().astype(np.float64)
            if trainer.seen:
                yield pd.DataFrame({"i": np.arange(len(numbers)), "v": numbers * trainer.seen, "w": float(trainer.seen)})

        parts = docs.select(F.col(text).alias("body")).mapInPandas(learn, "i long, v double, w double")
        means = parts.groupBy("i").agg((F.sum("v") / F.sum("w")).alias("v")).collect()  # the numbers of one model
        if means:
            numbers = np.empty(len(means))
            for row in means:
                numbers[row["i"]] = row["v"]
            model = model.like(numbers)
    return model


def build_vocabulary(counts: DataFrame) -> Vocabulary:
    """From staged counts; at most ``HEAD`` tokens come to the driver."""
    types, total = counts.agg(F.count("*"), F.sum("n")).first()
    top = sorted(most_frequent(counts, HEAD).collect(), key=lambda row: (-row["n"], bytes(row["token"])))
    return Vocabulary(
        {bytes(row["token"]): i for i, row in enumerate(top)},
        np.array([row["n"] for row in top], np.int64),
        int(total or 0),
        int(types),
    )


def _read_texts(docs: DataFrame, id: str, text: str, vocabulary: Vocabulary, model: Model) -> DataFrame:
    """Per text what the head and the model tell; its other tokens as a list with counts."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((vocabulary, model))
    schema = (
        "row long, id string, held_out boolean, n_tokens long, n_known long, known double, "
        "n_other long, other double, classes double, rest array<struct<token: binary, n: long>>"
    )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, learned = shared.value
        logs = np.append(np.log10(known.counts + 1.0), 0.0)  # rank -1 finds the last
        for batch in by_size(batches, "body"):
            texts = [tokens(body) for body in batch["body"]]
            ranks, classes, sizes = class_ids(texts, known)
            last, before = contexts(classes, sizes, known.classes + 1)
            chances = learned.log_probabilities(last, before, classes) / np.log(10)
            firsts = np.cumsum(sizes) - sizes
            shared_class = classes == known.classes
            sums = np.add.reduceat(
                np.column_stack(
                    [ranks >= 0, logs[ranks], shared_class, np.where(shared_class, logs[ranks], 0.0), chances]
                ),
                firsts,
                axis=0,
            )
            missing = np.split(np.flatnonzero(ranks < 0), np.searchsorted(np.flatnonzero(ranks < 0), firsts[1:]))
            rest = [
                [{"token": t, "n": n} for t, n in Counter(text[i - first] for i in at.tolist()).items()]
                for text, first, at in zip(texts, firsts.tolist(), missing, strict=True)
            ]
            yield pd.DataFrame(
                {
                    "row": batch["row"].to_numpy(),
                    "id": batch["id"].to_numpy(),
                    "held_out": batch["held"].to_numpy(),
                    "n_tokens": sizes,
                    "n_known": sums[:, 0].astype(np.int64),
                    "known": sums[:, 1],
                    "n_other": sums[:, 2].astype(np.int64),
                    "other": sums[:, 3],
                    "classes": sums[:, 4],
                    "rest": rest,
                }
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id).cast("string").alias("id"),  # a NULL among numbers would make them doubles
        F.col(text).alias("body"),
        held_out(id).alias("held"),
    )
    return rows.mapInPandas(read, schema).withColumn("id", F.col("id").cast(docs.schema[id].dataType))


def score_texts(docs: DataFrame, id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Per input row the contract's columns, each text scored whole.

    NULL and empty texts are one end token. Rows that repeat are trained on as often as they
    occur and scored alike. With no training text every token is unknown and all classes but
    the shared one are missing, which gives score 0.
    """
    training = docs.where(~held_out(id))
    counts = stage(token_counts(training, text), "lm-counts")
    vocabulary = build_vocabulary(counts)
    model = train(training, text, vocabulary, rounds)
    read = stage(_read_texts(docs, id, text, vocabulary, model), "lm-texts")
    rare = read.select(F.col("row").alias("at"), F.explode("rest").alias("x")).select("at", "x.token", F.col("x.n").alias("times"))
    logs = F.log10(F.col("n") + 1)
    found = rare.join(counts, "token").groupBy("at").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * logs).alias("more_log")
    )
    out = read.join(found, F.col("row") == F.col("at"), "left")
    more, more_log = F.coalesce("more", F.lit(0)), F.coalesce("more_log", F.lit(0.0))
    spread = float(np.log10(vocabulary.total + vocabulary.types + 1))
    others, types = vocabulary.other()
    within = float(np.log10(others + types + 1))
    return out.select(
        F.col("id").alias(id),
        "held_out",
        "n_tokens",
        (F.col("n_known") + more).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("known") + more_log - F.col("n_tokens") * spread).alias("base_score"),
        (F.col("classes") + F.col("other") + more_log - F.col("n_other") * within).alias("score"),
    )
