"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. Each is a logistic model over word indicators and the
probabilities of the categories before it; in training those are out-of-fold predictions, of words and
a lexicon mined without the fold too, so that a later model meets them as unsure as it will later. Words are runs of letters, lower-cased (A-Z);
indicators are of whole words and of their first bytes, as insults are also inflected and compounded.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoprec.llm.common import steps, texts_of, worker_state
from shoprec.llm.labelled import fitted, sample
from shoprec.llm.words import lowered, mix, text_bytes, word_bounds, word_hashes

#: Labelled documents learned from at most, words with a weight, and words of the lexicon.
ROWS, VOCABULARY, LEXICON = 6_000, 2_048, 256
#: First bytes of a word that are indicators too, of longer words. Least documents with an indicator,
#: and least distance from chance, in standard deviations, for one with a weight.
HEADS = (5, 6, 7)
LEAST, DISTANCE = 5, 5.0
#: Probability from which a document is rejected; above a half, as clean ones must stay.
THRESHOLD = 0.6
FOLDS = 3
#: The chain: a word of the lexicon occurs; two or more do; the label itself.
CATEGORIES = ("insult", "repeated", "toxic")


def letters(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One row of hashes for each run of letters of all texts, the word and its heads (0 where it is
    not longer), and the first of each text."""
    data, offsets = text_bytes(col)
    data = lowered(data)
    other = np.ones(256, bool)
    other[ord("a") : ord("z") + 1] = False
    other[128:] = False
    data = np.where(other[data], np.uint8(32), data)
    starts, ends, first = word_bounds(data, offsets)
    forms = np.zeros((len(starts), 1 + len(HEADS)), np.uint64)
    forms[:, 0] = word_hashes(data, starts, ends)
    for k, size in enumerate(HEADS, 1):
        at = np.flatnonzero(ends - starts > size)
        if len(at):
            forms[at, k] = mix(word_hashes(data, starts[at], starts[at] + size) + np.uint64(k))
    return forms, first


def indicators(forms: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all forms there are."""
    ok = forms != 0
    return np.broadcast_to(row[:, None], forms.shape)[ok], forms[ok]


def logistic(row: np.ndarray, at: np.ndarray, dense: np.ndarray, y: np.ndarray, size: int, ridge: float = 0.3,
             rounds: int = 800) -> np.ndarray:
    """Weights of a logistic model by accelerated gradient descent on diagonally scaled features:
    `size` for the indicators (row, at), then those of the dense columns, then the constant."""
    n, k = len(y), dense.shape[1]
    scale = np.concatenate([np.sqrt(np.bincount(at, minlength=size) + ridge), np.sqrt((dense**2).sum(axis=0) + ridge), [np.sqrt(n + ridge)]])
    per_row = np.bincount(row, 1 / scale[at] ** 2, minlength=n) + (dense**2 / scale[size:-1] ** 2).sum(axis=1) + 1 / scale[-1] ** 2
    widest = np.bincount(row, minlength=n).max(initial=0) + k + 1
    rate = 4 / max(widest, float(per_row.max()), 1.0)
    w = ahead = np.zeros(size + k + 1)
    for i in range(rounds):
        v = ahead / scale
        z = np.bincount(row, v[at], minlength=n) + dense @ v[size:-1] + v[-1]
        miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.concatenate([np.bincount(at, miss[row], minlength=size), dense.T @ miss, [miss.sum()]]) + ridge * np.append(v[:-1], 0)
        new = ahead - rate * g / scale
        ahead = new + i / (i + 3) * (new - w)
        w = new
    return w / scale


def predict(row: np.ndarray, at: np.ndarray, dense: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    k = dense.shape[1]
    z = np.bincount(row, w[at], minlength=n) + dense @ w[len(w) - 1 - k : -1] + w[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def mined(row: np.ndarray, word: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vocabulary, lexicon): words that tell the classes apart most, by a test of proportions, and
    those of them that mark label 1 nearly always; both sorted, from different words of each row."""
    names, at, df = np.unique(word, return_inverse=True, return_counts=True)
    bad = np.bincount(at, y[row], minlength=len(names))
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    z = (bad - share * df) / np.sqrt(share * (1 - share) * df)
    enough = (df >= LEAST) & (np.abs(z) >= DISTANCE)
    vocabulary = names[enough][np.argsort(-np.abs(z[enough]), kind="stable")[:VOCABULARY]]
    sure = enough & (bad >= 0.8 * df) & (z > 0)
    lexicon = names[sure][np.argsort(-z[sure], kind="stable")[:LEXICON]]
    return np.sort(vocabulary), np.sort(lexicon)


def found_in(names: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words in sorted names, and whether they are there."""
    if not len(names):
        return np.zeros(len(word), np.int64), np.zeros(len(word), bool)
    at = np.searchsorted(names, word)
    at[at == len(names)] = 0
    return at, names[at] == word


def chain(row: np.ndarray, word: np.ndarray, vocabularies: list[np.ndarray], targets: list[np.ndarray]) -> list[np.ndarray]:
    """Weights of each category's model over the last vocabulary.

    `vocabularies` and `targets`, (rows, categories) of 0 and 1, are those mined without each fold,
    then those of all rows. A row's out-of-fold probability comes of a model, a vocabulary and
    targets that never saw its label.
    """
    n = len(targets[-1])
    fold = np.arange(n) % FOLDS
    earlier = np.zeros((n, 0))
    models = []
    for k in range(targets[-1].shape[1]):
        left_out = np.zeros(n)
        for f, (names, aim) in enumerate(zip(vocabularies, targets, strict=True)):
            at, ok = found_in(names, word)
            own, at = row[ok], at[ok]
            if f == FOLDS:
                models.append(logistic(own, at, earlier, aim[:, k].astype(float), len(names)))
                continue
            inside, outside = fold != f, fold == f
            renumber = np.cumsum(inside) - 1
            mine = inside[own]
            w = logistic(renumber[own[mine]], at[mine], earlier[inside], aim[inside, k].astype(float), len(names))
            left_out[outside] = predict(own, at, earlier, w, n)[outside]
        earlier = np.column_stack([earlier, left_out])
    return models


def fit(table: pa.Table) -> bytes:
    """Vocabulary and weights from (text, label)."""
    batches = table.select(["text", "label"]).to_batches()
    rows, words_, labels, base = [], [], [np.empty(0)], 0
    for step in (x for batch in batches for x in steps(batch)):
        forms, first = letters(step["text"])
        row, word = indicators(forms, np.repeat(np.arange(step.num_rows), np.diff(first)))
        order = np.lexsort((word, row))
        row, word = row[order], word[order]
        different = np.ones(len(row), bool)
        different[1:] = (word[1:] != word[:-1]) | (row[1:] != row[:-1])
        rows.append((row[different] + base).astype(np.int32))
        words_.append(word[different])
        labels.append(step["label"].to_numpy(zero_copy_only=False).astype(float))
        base += step.num_rows
    once_row, once, y = np.concatenate(rows), np.concatenate(words_), np.concatenate(labels)
    fold = np.arange(len(y)) % FOLDS
    vocabularies, lexicons = [], []
    for f in range(FOLDS + 1):  # without each fold, then of all rows
        inside = fold != f
        mine = inside[once_row]
        names, sure = mined((np.cumsum(inside) - 1)[once_row[mine]], once[mine], y[inside])
        vocabularies.append(names)
        lexicons.append(sure)
    hits, base = np.zeros((FOLDS + 1, len(y)), np.int64), 0
    for step in (x for batch in batches for x in steps(batch)):  # again, rather than holding all words
        forms, first = letters(step["text"])
        own = np.repeat(np.arange(step.num_rows), np.diff(first))
        for f, lexicon in enumerate(lexicons):
            marked = found_in(lexicon, forms.ravel())[1].reshape(forms.shape).any(axis=1)
            hits[f, base : base + step.num_rows] = np.bincount(own[marked], minlength=step.num_rows)
        base += step.num_rows
    targets = [np.column_stack([h >= 1, h >= 2, y == 1]) for h in hits]
    models = chain(once_row, once, vocabularies, targets)
    vocabulary = vocabularies[-1]
    out = io.BytesIO()
    np.savez(out, vocabulary=vocabulary, **{f"w{k}": w for k, w in enumerate(models)})
    return out.getvalue()


def probabilities(col: pa.Array, kept) -> np.ndarray:
    """One row of category probabilities for each text; `kept` are the parts of a model, or None."""
    n = len(col)
    p = np.zeros((n, len(CATEGORIES)))
    if kept is None:
        return p
    forms, first = letters(col)
    row, word = indicators(forms, np.repeat(np.arange(n), np.diff(first)))
    at, ok = found_in(kept["vocabulary"], word)
    row = row[ok]
    size = max(len(kept["vocabulary"]), 1)
    once = np.unique(row * size + at[ok])
    row, at = once // size, once % size
    for k in range(p.shape[1]):
        p[:, k] = predict(row, at, p[:, :k], kept[f"w{k}"], n)
    return p


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = ROWS, trains: Column | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """A model from at most `rows` labelled ids; empty without labels."""
    return fitted(sample(docs, labels, label, rows, trains, id_col, text_col), fit)


def score_toxicity(docs: DataFrame, model: bytes, threshold: float = THRESHOLD, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, p_insult, p_repeated, p_toxic, toxic) for each row of `docs`, over the whole text.

    toxic is 1 where p_toxic reaches the threshold. A null or empty text has no word and gets the
    constants' probabilities. Repeated rows get equal results, rows with a null id theirs. With an
    empty model nothing is toxic and probabilities are 0. Other columns are not looked at.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = dict(np.load(io.BytesIO(model))) if model else None
        for batch in batches:
            for step in steps(batch):
                p = probabilities(step["text"], kept)
                yield pa.RecordBatch.from_arrays(
                    [step["doc_id"], *[pa.array(p[:, k]) for k in range(p.shape[1])],
                     pa.array((p[:, -1] >= threshold).astype(np.int32))],
                    ["doc_id", *[f"p_{c}" for c in CATEGORIES], "toxic"],
                )

    columns = ", ".join(f"p_{c} double" for c in CATEGORIES)
    return texts_of(docs, id_col, text_col).mapInArrow(score, f"doc_id long, {columns}, toxic int")


def without_toxic(docs: DataFrame, model: bytes, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are not toxic, with all their columns; no row is moved."""

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        kept = worker_state(f"toxicity_{hash(model)}", lambda: dict(np.load(io.BytesIO(model)))) if model else None
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
        found = [probabilities(step["text"], kept)[:, -1] < threshold for step in steps(batch)]
        return pd.Series(np.concatenate([np.empty(0, bool), *found]))

    return docs.where(clean(F.coalesce(F.col(text_col), F.lit(""))))
