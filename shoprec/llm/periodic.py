"""Periodic runs of words in texts, and texts without the repetitions of a run.

In a run of at least m words whose period is at most half of it, each word lies in some window of
m / 2 words that occurs again in the run. So hashes of windows cut a text into stretches of words
under windows that occur twice in their stretch; a run lies in one of them and ends where it would end
in the text. Trees are built for these stretches only, which are few where texts do not repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shoprec.llm.common import steps, texts_of
from shoprec.llm.suffix_tree import runs
from shoprec.llm.words import mix, sequences, text_bytes, word_bounds, word_hashes

#: Of a document's id and number of words: (first place, period) of words to take the place of the
#: others from there on, or None.
Rewrite = Callable[[int | None, int], tuple[int, int] | None]

_DIGESTS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)
_RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def stretches(hashes: np.ndarray, text: np.ndarray, window: int) -> list[tuple[int, int]]:
    """(from, to) of the stretches of words that lie under windows which occur twice in the stretch.

    `text` numbers the texts of the words, a stretch never crosses one. An equal hash of unequal
    windows makes a stretch longer and hides none.
    """
    n = len(hashes)
    if n <= window:
        return []
    windows = sequences(hashes, window)
    at = np.flatnonzero(text[: len(windows)] == text[window - 1 :])
    home = text.astype(np.uint64)
    while True:
        names = mix(windows[at] ^ mix(home[at] + np.uint64(1)))
        order = np.argsort(names, kind="stable")
        same = names[order][1:] == names[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        left = at[twice]
        if not len(left):
            return []
        fresh = np.append(True, (np.diff(left) > window) | (text[left[1:]] != text[left[:-1]]))
        first = left[fresh]
        last = left[np.append(fresh[1:], True)] + window
        if len(left) == len(at):
            return list(zip(first.tolist(), last.tolist(), strict=True))
        # Windows on both sides of a gap are no longer of one stretch.
        home[left] = np.cumsum(fresh).astype(np.uint64)
        at = left


class Found:
    """Words and runs of the texts of one batch."""

    def __init__(self, step: pa.RecordBatch, minimum: int, rewrite: Rewrite | None) -> None:
        self.data, offsets = text_bytes(step["text"])
        starts, ends, first = word_bounds(self.data, offsets)
        hashes = word_hashes(self.data, starts, ends)
        self.first, self.rewritten = first, np.zeros(step.num_rows, bool)
        if rewrite:
            place = np.arange(len(starts))
            sizes = np.diff(first).tolist()
            for k, doc_id in enumerate(step["doc_id"].to_pylist()):
                if change := rewrite(doc_id, sizes[k]):
                    a, period = first[k] + change[0], change[1]
                    place[a : first[k + 1]] = a + np.arange(first[k + 1] - a) % period
                    self.rewritten[k] = True
            starts, ends, hashes = starts[place], ends[place], hashes[place]
        self.starts, self.ends = starts, ends
        text = np.repeat(np.arange(step.num_rows), np.diff(first))
        self.runs: list[list[tuple[int, int, int]]] = [[] for _ in range(step.num_rows)]
        raw = self.data.tobytes()
        for a, b in stretches(hashes, text, (minimum + 1) // 2):
            codes: dict[bytes, int] = {}
            symbols = [
                codes.setdefault(raw[x:y], len(codes) + 1)
                for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)
            ]
            doc = int(text[a])
            base = a - int(first[doc])
            self.runs[doc] += [(base + s, length, p) for s, length, p in runs(symbols, minimum)]
        self.raw = raw
        self._plain(offsets)

    def _plain(self, offsets: np.ndarray) -> None:
        """All texts with one space between words, for texts that stay as they are."""
        if self.rewritten.all():
            return
        own = np.repeat(~self.rewritten, np.diff(self.first))  # the others are put together word by word
        starts, ends = self.starts[own], self.ends[own]
        change = np.zeros(len(self.data) + 1, np.int8)
        change[starts] = 1
        change[ends] -= 1
        word = np.cumsum(change[:-1], dtype=np.int8) > 0
        later = np.ones(len(self.starts), bool)  # all but the first words of the texts
        later[self.first[:-1][np.diff(self.first) > 0]] = False
        keep = word.copy()
        keep[self.starts[own & later] - 1] = True
        edges = np.concatenate(([0], np.cumsum(keep)))[offsets]
        self.flat = np.where(word[keep], self.data[keep], 0x20).astype(np.uint8).tobytes()
        self.edges = edges.tolist()

    def collapsed(self, k: int) -> bytes:
        """The text's words without those behind the first period of a run, one space between."""
        a, b = int(self.first[k]), int(self.first[k + 1])
        if not self.runs[k] and not self.rewritten[k]:
            return self.flat[self.edges[k] : self.edges[k + 1]]
        gone = np.zeros(b - a + 1, np.int64)
        for start, length, period in self.runs[k]:
            gone[start + period] += 1
            gone[start + length] -= 1
        kept = a + np.flatnonzero(np.cumsum(gone[:-1]) == 0)
        raw = self.raw
        return b" ".join([raw[x:y] for x, y in zip(self.starts[kept].tolist(), self.ends[kept].tolist(), strict=True)])


def _scan(docs: DataFrame, row: Callable, schema: str, names: list[str], kinds: list, minimum: int,
          rewrite: Rewrite | None, id_col: str, text_col: str) -> DataFrame:
    if minimum < 2:
        raise ValueError(f"a run has two words at least, not {minimum}")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch):
                found = Found(step, minimum, rewrite)
                rows = [row(found, k) for k in range(step.num_rows)]
                cols = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [step["doc_id"], *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]], ["doc_id", *names]
                )

    return texts_of(docs, id_col, text_col).mapInArrow(scan, schema)


def periodic_runs(docs: DataFrame, minimum: int = 12, rewrite: Rewrite | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row.

    Words are bytes outside 0x20 and 0x09-0x0D, compared as they are. A run is a stretch of words with
    smallest period q and at least max(minimum, 2 q) words that no neighbour extends; `runs` holds
    (start, length, period) by start, then period, start counted from 0. `collapsed` has all words but
    those that a run holds behind its first q, one space between. A null text is empty, and a
    text without words has no runs and collapses to nothing. Each row counts for itself: repeated rows
    and ids give as many rows. `rewrite` may say for a document that from a word on the text goes on
    with a period. Other columns are not looked at. Without rows the result is empty. A task
    holds one batch of texts, and the trees of one stretch, some 600 bytes for each of its words.
    """
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def row(found: Found, k: int) -> tuple:
        spans = [dict(zip(("start", "length", "period"), r, strict=True)) for r in sorted(found.runs[k], key=lambda r: (r[0], r[2]))]
        return int(found.first[k + 1] - found.first[k]), spans, found.collapsed(k).decode()

    return _scan(docs, row, _RUNS, ["n_words", "runs", "collapsed"], [pa.int64(), pa.list_(struct), pa.string()],
                 minimum, rewrite, id_col, text_col)


def run_digests(docs: DataFrame, minimum: int = 12, rewrite: Rewrite | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256): the same
    as `periodic_runs`, told by the longest run (ties: the first, then the shortest period; nulls if
    there is none) and by hashes of the lines `start,length,period` and of the collapsed text."""

    def row(found: Found, k: int) -> tuple:
        spans = sorted(found.runs[k], key=lambda r: (r[0], r[2]))
        best = min(spans, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{a},{n},{p}\n" for a, n, p in spans)
        return (
            len(spans), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(found.collapsed(k)).hexdigest(),
        )

    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return _scan(docs, row, _DIGESTS, names, [*[pa.int64()] * 5, pa.string(), pa.string()],
                 minimum, rewrite, id_col, text_col)
