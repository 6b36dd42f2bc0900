"""Vector best-fit packing of token sequences.

A piece of a document takes part of three capacities of a sequence: tokens, documents and
attention cost (the square of its length, as attention is within documents). All three follow from
the length, so pieces of one length are alike, and the bins are chosen over the counts of lengths:
at most `tokens` rows, whatever the corpus. Bins with the same contents are one entry with a count.
Pieces then find their places by their rank among the pieces of their length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from shoprec.llm.common import spool, steps, texts_of, worker_state

END = 2  # fixed value: the id after each document
#: Words whose ids a worker remembers.
REMEMBERED = 400_000


@dataclass(frozen=True)
class Capacity:
    """Limits of a sequence. `weights` are for tokens, documents and attention cost; `score` is
    "norm" (smallest weighted norm of what is left) or "dot" (largest weighted dot product of the
    piece with what is left)."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    score: str = "norm"

    def __post_init__(self) -> None:
        if min(self.tokens, self.documents) < 1 or self.attention < self.tokens**2:
            raise ValueError("a sequence must hold one piece of full length")
        if self.score not in ("norm", "dot"):
            raise ValueError(f"unknown score {self.score!r}")


def best_fit(counts: dict[int, int], capacity: Capacity) -> list[tuple[int, list[int]]]:
    """Bins as (number of bins, lengths in them) for counts of pieces by length, longest first.

    Each piece goes to the bin with the best score among those with room in all three capacities,
    or opens one. Equal scores: the bin with fewer tokens left, then the older one. Pieces of one
    length are placed in one step as they would be one by one: a bin that took one scores better
    than before by "norm" and worse by "dot", so it takes all that fit, or one until its equals have
    one too; a bin opened because no other had room takes all that fit.
    """
    limits = (capacity.tokens, capacity.documents, capacity.attention)
    shares = [w / m for w, m in zip(capacity.weights, limits, strict=True)]
    closed: list[tuple[int, list[int]]] = []
    bins: list[list] = []  # [tokens left, documents left, attention left, number, lengths]

    def score(entry: list, need: tuple[int, int, int]) -> float:
        if capacity.score == "dot":
            return -sum(s * s * left * n for s, left, n in zip(shares, entry, need, strict=False))
        return sum((s * (left - n)) ** 2 for s, left, n in zip(shares, entry, need, strict=False))

    def most(entry: list, need: tuple[int, int, int]) -> int:
        return min(left // n for left, n in zip(entry, need, strict=False))

    for length in sorted((x for x in counts if counts[x] > 0), reverse=True):
        need, todo = (length, 1, length * length), counts[length]
        while todo:
            fits = [b for b in bins if b[0] >= length and b[1] >= 1 and b[2] >= need[2]]
            if fits:
                old = min(fits, key=lambda b: (score(b, need), b[0]))
                each = 1 if capacity.score == "dot" else most(old, need)
            else:
                old, each = [*limits, todo, []], most(limits, need)
            each = min(each, todo)
            taken = min(todo // each, old[3])  # bins; the last pieces of the length are another step
            old[3] -= taken
            if fits and not old[3]:
                bins = [b for b in bins if b is not old]
            new = [*(left - each * n for left, n in zip(old, need, strict=False)), taken, [*old[4], *[length] * each]]
            todo -= each * taken
            if new[0] and new[1] and new[2]:
                bins.append(new)
            else:
                closed.append((taken, new[4]))
    return closed + [(b[3], b[4]) for b in bins]


def slots(bins: list[tuple[int, list[int]]]) -> dict[int, list[tuple[int, int, int]]]:
    """For each length, (first rank, first sequence id, offset) of its runs of places, by rank."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    seen: dict[int, int] = {}
    sequence = 0
    for number, lengths in bins:
        offset = 0
        for length in lengths:
            out.setdefault(length, []).append((seen.get(length, 0), sequence, offset))
            seen[length] = seen.get(length, 0) + number
            offset += length
        sequence += number
    return out


def _encoder(path: str):
    """Function of a text giving its ids as little-endian 32-bit bytes.

    A byte-level BPE never merges across a break before white space, so a text is cut at single
    spaces and the ids of each part are remembered; a text in which a space stands next to other
    white space is encoded whole.
    """
    import re

    import numpy as np
    from tokenizers import Tokenizer

    coder, known = Tokenizer.from_file(path), {}
    coder.encode_special_tokens = True  # their strings in a text are ordinary text
    odd = re.compile(r" \s|\s ").search
    quick = None
    if path.endswith(".json"):
        try:  # the same vocabulary and breaks in a library with less work per call
            import base64

            import public_tokenizers
            import tiktoken

            with open(path[: -len("json")] + "tiktoken", "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            quick = tiktoken.Encoding(
                "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            ).encode_ordinary
        except (ImportError, OSError):
            quick = None

    def ids(text: str) -> bytes:
        found = quick(text) if quick else coder.encode(text, add_special_tokens=False).ids
        return np.array(found, "<u4").tobytes()

    def encode(text: str) -> bytes:
        if odd(text):
            return ids(text)
        parts = text.split(" ")
        out = [ids(parts[0])] if parts[0] else []
        for part in parts[1:]:
            got = known.get(part)
            if got is None:
                got = ids(" " + part)
                if len(part) < 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[part] = got
            out.append(got)
        return b"".join(out)

    return encode


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, rank long"


def cut_pieces(docs: DataFrame, tokenizer: str, tokens: int) -> DataFrame:
    """Pieces of each document with the number of earlier pieces of that length in the task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import numpy as np
        from pyspark import TaskContext

        encode = worker_state(f"encoder_{tokenizer}", lambda: _encoder(tokenizer))
        part = TaskContext.get().partitionId()
        seen = np.zeros(tokens + 1, np.int64)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            for step in steps(batch):
                rows = []
                for doc_id, text in zip(step["doc_id"].to_pylist(), step["text"].to_pylist(), strict=True):
                    ids = encode(text) + end
                    n = len(ids) // 4
                    first = n % tokens or tokens
                    for k, start in enumerate([0, *range(first, n, tokens)]):
                        length = first if k == 0 else tokens
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        rows.append((doc_id, k, start, length, crc, part, int(seen[length])))
                        seen[length] += 1
                cols = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    return docs.mapInArrow(cut, PIECES)


def pack(docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity(),  # noqa: B008
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece.

    A document is its ids and the end id; only one longer than a sequence is cut, all pieces but
    the first being full. A null or empty text is the end id alone. Repeated rows are packed one by
    one, rows with a null id as well. Equal pieces keep the order of the input, by task and place.
    Without rows the result is empty. Other columns are not looked at.
    """
    pieces = spool(cut_pieces(texts_of(docs, id_col, text_col), tokenizer, capacity.tokens), "pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = slots(best_fit(counts, capacity))  # from at most `tokens` counts
    ranked = pieces.join(starts, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("rank")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        tables = {k: np.array(v, np.int64).reshape(-1, 3) for k, v in places.items()}
        for batch in batches:
            length = batch["length"].to_numpy(zero_copy_only=False)
            rank = batch["rank"].to_numpy(zero_copy_only=False)
            found = np.zeros((len(rank), 2), np.int64)
            for x in np.unique(length).tolist():
                at = np.flatnonzero(length == x)
                run = np.searchsorted(tables[x][:, 0], rank[at], side="right") - 1
                found[at, 0] = tables[x][run, 1] + rank[at] - tables[x][run, 0]
                found[at, 1] = tables[x][run, 2]
            keep = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(found[:, 0]), pa.array(found[:, 1])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def lower_bound(counts: dict[int, int], tokens: int) -> int:
    """Sequences that any packing of these pieces needs at least."""
    return math.ceil(sum(k * n for k, n in counts.items()) / tokens)
