"""Quality classifier: naive Bayes log-count ratios as feature scales for a linear hinge-loss model.

Features are indicators of n-grams of a text: its words, and runs of up to two word shapes (kinds of
characters in order, and whether the word triple was seen earlier in the text) together with the
order of magnitude of their share. Each indicator is scaled by the log ratio of its smoothed counts
in good and bad documents (Wang and Manning 2012); the weights are fitted by dual coordinate descent
(Hsieh et al. 2008), and margins of documents left out of the fit are turned to probabilities.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoprec.llm.common import steps, texts_of
from shoprec.llm.labelled import fitted, sample
from shoprec.llm.words import lowered, mix, sequences, text_bytes, word_bounds, word_hashes

#: Hash buckets of features, and labelled documents learned from at most.
BUCKETS = 1 << 18
ROWS = 12_000


def _kinds() -> np.ndarray:
    """Kind of each byte: capital, small (and beyond ASCII), digit, or the sign itself."""
    t = np.arange(256, dtype=np.uint8)
    t[ord("A") : ord("Z") + 1] = ord("A")
    t[ord("a") : ord("z") + 1] = ord("a")
    t[128:] = ord("a")
    t[ord("0") : ord("9") + 1] = ord("0")
    return t


def shape_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word's kinds of characters, runs of one kind taken once."""
    kinds = _kinds()[data]
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    keep = np.cumsum(inside[:-1]) > 0
    first = np.zeros(len(data), bool)
    first[starts] = True
    keep[1:] &= first[1:] | (kinds[1:] != kinds[:-1])
    places = np.concatenate(([0], np.cumsum(keep)))
    return word_hashes(kinds[keep], places[starts], places[ends])


def features(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features, first of each text and one more entry); the features of a text are different."""
    data, offsets = text_bytes(col)
    starts, ends, first = word_bounds(data, offsets)
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)
    word = word_hashes(lowered(data), starts, ends)
    triple = np.zeros(len(word), np.uint64)
    runs = sequences(word, 3)
    triple[: len(runs)] = runs
    whole = np.flatnonzero(text[2:] == text[:-2])  # a triple that crosses texts is none
    order = whole[np.lexsort((triple[whole], text[whole]))]
    again = np.zeros(len(word), bool)
    again[order[1:]] = (triple[order[1:]] == triple[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    shape = mix(shape_hashes(data, starts, ends) + again.astype(np.uint64))
    pair = sequences(shape, 2)
    within = text[1:] == text[:-1] if len(text) else np.empty(0, bool)
    out_text, out = [text], [mix(word + np.uint64(1))]
    for salt, grams, own in ((2, shape, text), (3, pair[within], text[:-1][within] if len(text) else text)):
        order = np.lexsort((grams, own))
        g, t = grams[order], own[order]
        edge = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (t[1:] != t[:-1])))) if len(g) else np.empty(0, np.int64)
        count = np.diff(np.append(edge, len(g)))
        share = count / np.maximum(n[t[edge]], 1) if len(edge) else np.empty(0)
        level = np.minimum(6, np.floor(-np.log2(share + 1e-12))).astype(np.int64) if len(edge) else np.empty(0, np.int64)
        out_text.append(t[edge])
        out.append(mix(g[edge] * np.uint64(2 * salt + 1) + level.astype(np.uint64)))
    t, f = np.concatenate(out_text), (np.concatenate(out) % np.uint64(BUCKETS)).astype(np.int64)
    both = np.unique(t * BUCKETS + f)
    t, f = both // BUCKETS, both % BUCKETS
    return f, np.searchsorted(t, np.arange(len(n) + 1))


def ratios(feature: np.ndarray, label_of: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """Log ratio of the smoothed shares of each feature among good and bad documents."""
    good = np.bincount(feature[label_of == 1], minlength=BUCKETS) + alpha
    bad = np.bincount(feature[label_of == 0], minlength=BUCKETS) + alpha
    return np.log(good / good.sum()) - np.log(bad / bad.sum())


def coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: float = 1.0,
                       epochs: int = 12, seed: int = 3) -> np.ndarray:
    """Weights of the linear model with squared hinge loss, by dual coordinate descent; the last
    weight is that of a constant 1. `rows` are (features, values), y is 1 or -1."""
    rng = np.random.default_rng(seed)
    w, dual = np.zeros(size + 1), np.zeros(len(rows))
    diagonal = 1 / (2 * cost)
    norms = np.array([v @ v + 1.0 for _, v in rows]) + diagonal
    for _ in range(epochs):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            slope = y[i] * (w[at] @ v + w[-1]) - 1 + diagonal * dual[i]
            new = max(dual[i] - slope / norms[i], 0.0)
            step = (new - dual[i]) * y[i]
            if step:
                w[at] += step * v
                w[-1] += step
                dual[i] = new
            largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return w


def platt(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(slope, offset) of the logistic curve of y (0 or 1) over margins, by Newton's method."""
    a, b = 1.0, 0.0
    good, bad = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        h = p * (1 - p)
        m = np.array([[(h * margin**2).sum(), (h * margin).sum()], [(h * margin).sum(), h.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(m, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def _scaled(feature: np.ndarray, first: np.ndarray, r: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    rows = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        at = feature[a:b]
        v = r[at]
        norm = np.sqrt(v @ v)
        rows.append((at, v / norm if norm else v))
    return rows


def fit(table: pa.Table) -> bytes:
    """Model from (text, label): scaled weights, offset, slope and offset of the probability."""
    parts, firsts, labels = [], [np.zeros(1, np.int64)], []
    for batch in table.select(["text", "label"]).to_batches():
        for step in steps(batch):
            f, first = features(step["text"])
            parts.append(f)
            firsts.append(first[1:] + firsts[-1][-1])
            labels.append(step["label"].to_numpy(zero_copy_only=False))
    feature, first, label = np.concatenate(parts), np.concatenate(firsts), np.concatenate(labels)
    order = np.lexsort((np.diff(first), label))  # both folds get texts of all sizes and both labels
    n = len(label)
    if len(set(label.tolist())) < 2:
        score = 0.5 if not n else (0.99 if label[0] else 0.01)
        return _pack(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 1.0, float(np.log(score / (1 - score))))

    def learned(rows: np.ndarray):
        keep = np.isin(np.repeat(np.arange(n), np.diff(first)), rows)
        r = ratios(feature[keep], np.repeat(label, np.diff(first))[keep])
        scaled = _scaled(feature, first, r)
        return r, scaled, coordinate_descent([scaled[i] for i in rows], np.where(label[rows] == 1, 1.0, -1.0), BUCKETS)

    margin = np.zeros(n)
    for fold in (0, 1):
        inside = order[np.arange(n) % 2 != fold]
        if len(set(label[inside].tolist())) < 2:
            inside = order
        _, scaled, w = learned(inside)
        for i in order[np.arange(n) % 2 == fold]:
            margin[i] = w[scaled[i][0]] @ scaled[i][1] + w[-1]
    slope, offset = platt(margin, label)
    r, _, w = learned(np.sort(order))
    return _pack(r, w[:-1], float(w[-1]), slope, offset)


def _pack(r: np.ndarray, w: np.ndarray, bias: float, slope: float, offset: float) -> bytes:
    out = io.BytesIO()
    np.savez(out, r=r.astype(np.float32), w=w.astype(np.float32), last=np.array([bias, slope, offset]))
    return out.getvalue()


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", trains: Column | None = None,
                  rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for each row of `docs`: probability of label 1 from the whole text.

    Only the text is an input of a score. At most `rows` labelled ids are learned from, among those
    that `trains` (over doc_id) admits. A null or empty text has no feature and gets the score of
    the constant alone. Repeated rows get equal scores, rows with a null id theirs. With one label
    only, scores are 0.99 or 0.01; without labels 0.5. Other columns are not looked at.
    """
    model = fitted(sample(docs, labels, label, rows, trains, id_col, text_col), fit) or _pack(
        np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 1.0, 0.0
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.load(io.BytesIO(model))
        square = kept["r"].astype(float) ** 2
        weight = kept["r"].astype(float) * kept["w"]
        bias, slope, offset = kept["last"]
        for batch in batches:
            for step in steps(batch):
                f, first = features(step["text"])
                own = np.repeat(np.arange(step.num_rows), np.diff(first))
                sums = lambda x: np.bincount(own, x[f], minlength=step.num_rows)  # noqa: E731,B023
                norm = np.sqrt(np.maximum(sums(square), 0))
                margin = np.where(norm > 1e-9, sums(weight) / np.maximum(norm, 1e-9), 0.0) + bias
                p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
                yield pa.RecordBatch.from_arrays([step["doc_id"], pa.array(p)], ["doc_id", "score"])

    return texts_of(docs, id_col, text_col).mapInArrow(score, "doc_id long, score double")


def with_decision(scored: DataFrame, held_out: Column, threshold: float = 0.3) -> DataFrame:
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
