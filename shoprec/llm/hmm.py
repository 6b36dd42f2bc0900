"""Hidden Markov language model: Baum-Welch training and exact scaled forward scoring.

Symbols of the model are the most frequent words of the training texts, classes of all other words
by their last bytes, and the end of a text. A class is followed by a word of it with add-one
frequency over all training words of the class, one unknown word included, so the probabilities of
all texts over known words and the unknown one sum to one. Word counts come from all training texts.
Expected counts are summed over tasks by Spark in each round; only the parameters, whose number does
not depend on the corpus, come to the driver. Counts of rare words never do: they are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoprec.llm.common import spool, steps, texts_of
from shoprec.llm.words import lowered, mix, text_bytes, word_bounds, word_hashes

#: Tokens of the sequences that run through the recursions side by side.
SIDE = 400_000


@dataclass(frozen=True)
class Settings:
    """Sizes of the model. `known` bounds the table of frequent words that tasks hold, `symbols`
    how many of them have probabilities of their own in each state."""

    states: int = 8
    rounds: int = 6
    known: int = 1 << 17
    symbols: int = 1 << 13
    classes: int = 64
    prior: float = 20.0
    seed: int = 7


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # states x symbols

    def chunks(self, sequences: list[np.ndarray]) -> Iterator[list[int]]:
        """Indexes of sequences of similar length, about SIDE tokens together."""
        order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        at = 0
        while at < len(order):
            n = max(1, SIDE // max(1, len(sequences[order[at]])))
            yield order[at : at + n]
            at += n

    def forward(self, padded: np.ndarray, alive: list[int], keep: bool):
        """Scaled forward recursion over (time, sequence) symbols, longest sequences first; `alive`
        is the number of sequences that reach each time. (scaled alphas if kept, log10 likelihoods)."""
        table = np.ascontiguousarray(self.emit.T)
        total = np.zeros(padded.shape[1])
        alphas = []
        a = None
        for t, n in enumerate(alive):
            p = self.start if a is None else a[:n] @ self.move
            a = p * table[padded[t, :n]]
            scale = a.sum(axis=1)
            a = a / scale[:, None]
            total[:n] += np.log10(scale)
            if keep:
                alphas.append((a, scale))
        return alphas, total


def padded_of(sequences: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    """(time, sequence) symbols of sequences in falling length, and how many reach each time."""
    lengths = np.array([len(s) for s in sequences])
    out = np.zeros((int(lengths.max()), len(sequences)), np.int64)
    for i, s in enumerate(sequences):
        out[: len(s), i] = s
    alive = np.searchsorted(-lengths, -np.arange(out.shape[0]), side="left")
    return out, alive.tolist()


def expected_counts(model: Model, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions of the sequences, and their log10 likelihood."""
    k, s = model.emit.shape
    starts, moves, emits, total = np.zeros(k), np.zeros((k, k)), np.zeros((s, k)), 0.0
    table = np.ascontiguousarray(model.emit.T)
    for part in model.chunks(sequences):
        padded, alive = padded_of([sequences[i] for i in part])
        alphas, logs = model.forward(padded, alive, True)
        total += logs.sum()
        beta = np.ones((0, k))
        gammas = []
        for t in range(len(alive) - 1, -1, -1):
            n = alive[t]
            a = alphas[t][0]
            if len(beta) < n:  # sequences that end here
                beta = np.concatenate([beta, np.ones((n - len(beta), k))])
            g = a * beta
            gammas.append(g)
            if t:
                w = beta * table[padded[t, :n]] / alphas[t][1][:, None]
                moves += alphas[t - 1][0][:n].T @ w
                beta = w @ model.move.T
            else:
                starts += g.sum(axis=0)
        symbols = np.concatenate([padded[t, : alive[t]] for t in range(len(alive) - 1, -1, -1)])
        g = np.concatenate(gammas)
        for j in range(k):
            emits[:, j] += np.bincount(symbols, g[:, j], minlength=s)
    return starts, moves * model.move, emits.T, total


def form_class(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, classes: int) -> np.ndarray:
    """Class of each word by its last two bytes."""
    last = data[ends - 1].astype(np.uint64)
    before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
    return (mix(last * np.uint64(257) + before + np.uint64(1)) % np.uint64(classes)).astype(np.int64)


END_WORD = np.int64(-(1 << 63))  # name of the end token; a word has this hash with chance 2^-64


def _counted(step: pa.RecordBatch, classes: int):
    data, offsets = text_bytes(step["text"])
    data = lowered(data)
    starts, ends, first = word_bounds(data, offsets)
    return word_hashes(data, starts, ends).view(np.int64), form_class(data, starts, ends, classes), first


def word_counts(training: DataFrame, classes: int, most: int = 1 << 20) -> DataFrame:
    """(word, class, c) over all texts of `training`, without the ends of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged():
            word, kind, n = (np.concatenate([h[i] for h in held]) for i in range(3))
            names, at, back = np.unique(word, return_index=True, return_inverse=True)
            held[:] = [(names, kind[at], np.bincount(back, n, len(names)).astype(np.int64))]
            return len(names)

        def flushed():
            batch = pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["word", "class", "c"])
            held.clear()
            return batch

        waiting = 0
        for batch in batches:
            for step in steps(batch):
                word, kind, _ = _counted(step, classes)
                names, at, n = np.unique(word, return_index=True, return_counts=True)
                held.append((names, kind[at], n.astype(np.int64)))
                waiting += len(names)
                if waiting > most:
                    waiting = merged()
                    if waiting > most // 2:
                        yield flushed()
                        waiting = 0
        if held:
            merged()
            yield flushed()

    parts = training.select("text").mapInArrow(count, "word long, class long, c long")
    return parts.groupBy("word").agg(F.min("class").alias("class"), F.sum("c").alias("c"))


def frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, class, c) of the most frequent words, `most` at most, by word; all words from some
    frequency on, found from a histogram over logarithms of frequency."""
    step = F.floor(F.log2("c") * 64).cast("int")
    rows = counts.groupBy(step.alias("b")).agg(F.count("*").alias("n")).collect()  # 64 a power of two
    total, lowest = 0, None
    for row in sorted(rows, key=lambda r: -r["b"]):
        total += row["n"]
        if total > most:
            break
        lowest = row["b"]
    if lowest is None:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    top = counts.where(step >= lowest).select("word", "class", "c").toArrow()
    word, kind, c = (top[x].to_numpy() for x in ("word", "class", "c"))
    order = np.argsort(word)
    return word[order], kind[order], c[order]


def language_model_scores(docs: DataFrame, trains: Column, settings: Settings = Settings(),  # noqa: B008
                          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) for each row.

    `trains`, over the id as doc_id, says which rows the model learns from. Tokens are lower-case
    words (A-Z) and one end. base_score: sum of log10((c + 1) / (N + V + 1)). score: log10 of the
    text's probability under the model. A null or empty text is the end alone. Repeated rows count
    and are scored one by one. Without training rows every count is 0 and the model is even.
    """
    set_ = settings
    texts = texts_of(docs, id_col, text_col).select(
        "doc_id", "text", F.coalesce(trains, F.lit(False)).alias("train"), F.monotonically_increasing_id().alias("row")
    )
    counts = spool(word_counts(texts.where("train"), set_.classes), "words")
    ends = texts.where("train").count()
    sums = counts.agg(F.sum("c"), F.count("*")).first()
    total, distinct = (sums[0] or 0) + ends, sums[1] + (1 if ends else 0)
    word, kind, c = frequent(counts, set_.known)
    rank = np.argsort(-c, kind="stable")
    own = np.full(len(word), -1, np.int64)
    own[rank[: set_.symbols]] = np.arange(min(set_.symbols, len(word)))
    m = int((own >= 0).sum())
    n_symbols = m + set_.classes + 1
    # Words and frequency of each class without the words that have symbols of their own.
    per = {r["class"]: (r["c"], r["v"]) for r in counts.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()}
    class_c = np.array([per.get(i, (0, 0))[0] for i in range(set_.classes)], float)
    class_v = np.array([per.get(i, (0, 0))[1] for i in range(set_.classes)], float)
    np.subtract.at(class_c, kind[own >= 0], c[own >= 0])
    np.subtract.at(class_v, kind[own >= 0], 1)
    class_log = np.log10(class_c + class_v + 1)
    base_log = np.log10(total + distinct + 1)
    end_log = np.log10(ends + 1) - base_log
    classes = set_.classes

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch):
                names, forms, first = _counted(step, classes)
                at = np.searchsorted(word, names)
                at[at == len(word)] = 0
                hit = word[at] == names if len(word) else np.zeros(len(names), bool)
                freq = np.where(hit, c[at], 0) if len(word) else np.zeros(len(names), np.int64)
                symbol = np.where(hit, own[at], -1) if len(word) else np.full(len(names), -1)
                in_class = symbol < 0
                symbol = np.where(in_class, m + forms, symbol)
                base = np.where(hit, np.log10(freq + 1), 0.0) - base_log
                inner = np.where(in_class, np.where(hit, np.log10(freq + 1), 0.0) - class_log[forms], 0.0)
                cum = lambda x: np.concatenate(([0.0], np.cumsum(x)))
                part = lambda x: cum(x)[first[1:]] - cum(x)[first[:-1]]
                rare = ~hit
                rare_first = np.concatenate(([0], np.cumsum(rare)))[first]
                seqs = [
                    np.append(symbol[a:b], n_symbols - 1).astype("<u2").tobytes()
                    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        step["doc_id"], step["train"], step["row"],
                        pa.array(np.diff(first) + 1), pa.array((part(hit) + (1 if ends else 0)).round().astype(np.int64)),
                        pa.array(part(base) + end_log), pa.array(part(inner)), pa.array(seqs, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(rare_first.astype(np.int32)), pa.array(names[rare])),
                    ],
                    ["doc_id", "train", "row", "n_tokens", "n_known", "base", "inner", "symbols", "rare"],
                )

    if n_symbols > 1 << 16:
        raise ValueError("symbols and classes must fit two bytes")
    coded = spool(
        texts.mapInArrow(
            encode,
            "doc_id long, train boolean, row long, n_tokens long, n_known long, base double, inner double, "
            "symbols binary, rare array<long>",
        ),
        "coded",
    )
    unigram = np.concatenate([c[rank[:m]].astype(float), class_c, [float(ends)]]) + 1.0
    model = train(coded.where("train").select("symbols"), unigram / unigram.sum(), set_)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs = [np.frombuffer(x, "<u2") for x in batch["symbols"].to_pylist()]
            logs = np.zeros(len(seqs))
            for part in model.chunks(seqs):
                padded, alive = padded_of([seqs[i] for i in part])
                logs[part] = model.forward(padded, alive, False)[1]
            keep = [batch[x] for x in ("doc_id", "train", "row", "n_tokens", "n_known", "base", "inner")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(logs)], ["doc_id", "train", "row", "n_tokens", "n_known", "base", "inner", "log"]
            )

    scored = coded.drop("rare").mapInArrow(
        score,
        "doc_id long, train boolean, row long, n_tokens long, n_known long, base double, inner double, log double",
    )
    # Words outside the frequent table get their counts by a join; each adds log10(c + 1).
    lowest = int(c.min()) if len(c) else None
    rest = counts if lowest is None else counts.where(F.col("c") < lowest)
    seldom = coded.select("row", F.explode("rare").alias("word"))
    found = seldom.join(rest.select("word", "c"), "word").groupBy("row").agg(
        F.sum(F.log10(F.col("c") + 1)).alias("more"), F.count("*").alias("also")
    )
    more = F.coalesce("more", F.lit(0.0))
    return scored.join(found, "row", "left").select(
        "doc_id", "train", "n_tokens",
        (F.col("n_known") + F.coalesce("also", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("log") + F.col("inner") + more).alias("score"),
    )


def train(sequences: DataFrame, unigram: np.ndarray, settings: Settings) -> Model:
    """Baum-Welch over (symbols), two bytes each. Rounds are Spark jobs over all sequences; each
    task sends its expected counts, which are summed by (state, symbol)."""
    k, s = settings.states, len(unigram)
    rng = np.random.default_rng(settings.seed)
    emit = unigram * rng.uniform(0.3, 1.7, (k, s))
    model = Model(np.full(k, 1 / k), np.full((k, k), 0.1 / k) + 0.9 * np.eye(k), emit / emit.sum(axis=1, keepdims=True))
    for _ in range(settings.rounds):
        now = model

        def expect(batches: Iterator[pa.RecordBatch], now: Model = now) -> Iterator[pa.RecordBatch]:
            starts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros((k, s))
            for batch in batches:
                a, b, e, _ = expected_counts(now, [np.frombuffer(x, "<u2") for x in batch["symbols"].to_pylist()])
                starts, moves, emits = starts + a, moves + b, emits + e
            whole = np.concatenate([starts[:, None], moves, emits], axis=1)
            state, place = np.nonzero(whole)
            yield pa.RecordBatch.from_arrays(
                [pa.array((state * whole.shape[1] + place).astype(np.int64)), pa.array(whole[state, place])], ["at", "x"]
            )

        summed = sequences.mapInArrow(expect, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).toArrow()
        whole = np.zeros(k * (1 + k + s))
        whole[summed["at"].to_numpy()] = summed["x"].to_numpy()
        whole = whole.reshape(k, 1 + k + s)
        start = whole[:, 0] + 1.0
        move = whole[:, 1 : 1 + k] + 1.0
        emit = whole[:, 1 + k :] + settings.prior * unigram
        model = Model(
            start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True)
        )
    return model
