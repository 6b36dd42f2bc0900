"""Benchmark decontamination by greedy string tiling.

Seeds are runs of words of the shortest match counted. A filter of fixed size made of the benchmark's
seeds leaves of each document the stretches that may match; seeds found there are joined with the
benchmark's. For each (document, item) the longest matches not yet covered are marked again and again,
found by running Karp-Rabin hashes, and the share of the item's words under marks decides. The order
of the matches does not count, so reordered passages are caught.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoprec.llm.common import spool, steps, texts_of
from shoprec.llm.words import sequences, words

#: Bits of the filter, which is the same size for any benchmark; it only saves work.
FILTER_BITS = 1 << 25
#: Words of the shortest match; share of an item's words from which a document is contaminated.
SHORTEST, COVERAGE = 5, 0.5


def _seeds(items: DataFrame, shortest: int) -> tuple[DataFrame, DataFrame]:
    """(i, item_id, words) and (seed, size, i), the seeds of an item once each. An item with
    fewer words than the shortest match is one seed. `i` names an id and its words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch):
                hashes, first = words(step["text"])
                yield pa.RecordBatch.from_arrays(
                    [step["doc_id"], pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))],
                    ["item_id", "words"],
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, seeds, sizes = [], [], []
            for item, own in zip(batch["i"].to_pylist(), batch["words"], strict=True):
                own = np.asarray(own.values.to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
                size = min(shortest, len(own))
                if size:
                    found = np.unique(sequences(own, size))
                    ids += [item] * len(found)
                    sizes += [size] * len(found)
                    seeds.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.empty(0, np.int64), *seeds])), pa.array(sizes, pa.int32()), pa.array(ids, pa.int64())],
                ["seed", "size", "i"],
            )

    listed = items.mapInArrow(scan, "item_id long, words array<long>").where(F.size("words") > 0).distinct()
    listed = spool(listed.withColumn("i", F.xxhash64("item_id", "words")), "items")
    return listed, spool(listed.mapInArrow(cut, "seed long, size int, i long"), "seeds")


def _filter(seeds: DataFrame) -> np.ndarray:
    """Bit for each seed hash modulo FILTER_BITS, as bytes. Slices of 4 KB at most come together."""
    bit = F.pmod(F.col("seed"), F.lit(FILTER_BITS)) + 1  # slices number from 1, with 32,768 bits each
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    slices = seeds.groupBy(F.bitmap_bucket_number(bit).alias("slice")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")
    )
    for row in slices.toLocalIterator():
        own = np.frombuffer(bytes(row["bits"]), np.uint8)
        at = (row["slice"] - 1) * len(own)
        out[at : at + len(own)] = own[: len(out) - at]
    return out


def mark_tiles(text: np.ndarray, item: np.ndarray, shortest: int) -> tuple[int, int]:
    """(words of the item marked, number of tiles) by running Karp-Rabin greedy string tiling.

    The search length falls from the longest match of unmarked words to the next longest; matches of
    that length are marked unless a word of theirs is marked already. Equal lengths: first in the
    item, then first in the text.
    """
    text, item = np.asarray(text, np.int64).view(np.uint64), np.asarray(item, np.int64).view(np.uint64)
    shortest = min(shortest, len(item))
    top = max(len(text), len(item)) + 1
    ours, theirs = _Runs(text, top), _Runs(item, top)
    tiles, length = 0, min(len(text), len(item))
    while shortest and (length := _longest(ours, theirs, shortest, length)):
        places, hashes = ours.free(length)
        order = np.argsort(hashes, kind="stable")
        places, hashes = places[order], hashes[order]
        at, wanted = theirs.free(length)
        low, high = np.searchsorted(hashes, wanted, "left"), np.searchsorted(hashes, wanted, "right")
        hit = np.flatnonzero(low < high)
        behind: dict[int, int] = {}  # places of a hash passed over; a marked one stays marked
        for j, a, b in zip(at[hit].tolist(), low[hit].tolist(), high[hit].tolist(), strict=True):
            if theirs.taken(j, length):
                continue
            k = behind.get(a, a)
            while k < b and ours.taken(int(places[k]), length):
                k += 1
            behind[a] = k
            while k < b:  # the first free place, if its words are equal and not only the hash
                i = int(places[k])
                if not ours.taken(i, length) and np.array_equal(text[i : i + length], item[j : j + length]):
                    ours.marked[i : i + length] = theirs.marked[j : j + length] = True
                    tiles += 1
                    break
                k += 1
        length -= 1
    return int(theirs.marked.sum()), tiles


class _Runs:
    """Words, which of them are marked, and running hashes of the unmarked stretches of any length."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, words: np.ndarray, top: int):
        n = len(words)
        self.marked = np.zeros(n, bool)
        powers = np.full(top + 1, self.BASE, np.uint64)
        powers[0] = 1
        self.powers = np.cumprod(powers, dtype=np.uint64)
        # Sums of word x base^(top - place): the difference of two, times base^place, is the hash of a run,
        # the same in all words with one `top`.
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(words * self.powers[top : top - n : -1], dtype=np.uint64)))

    def free(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the runs without a marked word, in order, and their hashes."""
        before = np.concatenate(([0], np.cumsum(self.marked)))
        at = np.flatnonzero(before[length:] == before[: len(before) - length])
        return at, (self.sums[at + length] - self.sums[at]) * self.powers[at]

    def taken(self, at: int, length: int) -> bool:
        """Whether a run holds a marked word. Tiles are as long as the run at least, so one of its ends is."""
        return bool(self.marked[at] or self.marked[at + length - 1])


def _lists(col: pa.ListArray) -> Iterator[np.ndarray]:
    """The lists one by one, without copying their words."""
    for one in col:
        yield one.values.to_numpy(zero_copy_only=False)


def _longest(ours: _Runs, theirs: _Runs, least: int, most: int) -> int:
    """The greatest length of `least` to `most` with an unmarked run in common, 0 without one. A match
    holds shorter ones, so it is found by bisection."""
    found = 0
    while least <= most:
        middle = (least + most + 1) // 2 if found else least
        if np.isin(theirs.free(middle)[1], ours.free(middle)[1]).any():
            found, least = middle, middle + 1
        else:
            most = middle - 1
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, shortest: int = SHORTEST, coverage: float = COVERAGE,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(doc_id, item_id, item_words, matched_words, tiles, coverage) of the contaminated pairs.

    Whole texts are looked at. A pair is contaminated where marked matches cover at least
    `coverage` of the item's words. Null or empty texts and items match nothing. Repeated rows give
    one pair; an id with several texts, of a document or an item, counts by the best of them; a null
    id is an id like others. Other columns are not looked at. Without documents or items the result is empty.
    """
    items, seeds = _seeds(texts_of(benchmark, item_col, text_col), shortest)
    sizes = sorted(r["size"] for r in seeds.select("size").distinct().collect())  # 1 to `shortest`
    bits = _filter(seeds)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch):
                hashes, first = words(step["text"])
                owner = np.repeat(np.arange(step.num_rows), np.diff(first))
                covered = np.zeros(len(hashes) + 1, np.int64)
                hits: list[tuple[np.ndarray, np.ndarray]] = []
                for size in sizes:
                    runs = sequences(hashes, size)
                    at = (runs.view(np.int64) % FILTER_BITS).astype(np.int64)
                    hit = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1
                    place = np.flatnonzero((hit == 1) & (owner[: len(runs)] == owner[size - 1 :][: len(runs)]))
                    np.add.at(covered, place, 1)
                    np.add.at(covered, place + size, -1)
                    hits.append((place, runs[place]))
                inside = np.cumsum(covered[:-1]) > 0
                ids, stretch, found = [], [], []
                place = np.concatenate([np.empty(0, np.int64), *[h[0] for h in hits]])
                seed = np.concatenate([np.empty(0, np.uint64), *[h[1] for h in hits]])
                own = owner[place]
                for i in np.unique(own).tolist():
                    a, b = int(first[i]), int(first[i + 1])
                    # Words that no seed covers are left out; 0 stands between stretches.
                    keep = inside[a:b]
                    word = hashes[a:b].view(np.int64)
                    gap = np.flatnonzero(np.diff(keep.astype(np.int8)) == -1) + 1
                    kept = np.insert(np.where(keep, word, 0), gap, 0)
                    kept_flag = np.insert(keep, gap, True)
                    ids.append(step["doc_id"][i].as_py())
                    stretch.append(kept[kept_flag])
                    found.append(np.unique(seed[own == i]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(stretch, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.int64()))],
                    ["doc_id", "words", "seeds"],
                )

    # A part is named by its id and words, so rows with a null or repeated id meet their own items
    # only. Were two names equal, more pairs would be looked at and none found that is not one.
    held = texts_of(docs, id_col, text_col).mapInArrow(scan, "doc_id long, words array<long>, seeds array<long>").distinct()
    held = spool(held.withColumn("d", F.xxhash64("doc_id", "words")), "stretches")
    pairs = spool(
        held.select("d", F.explode("seeds").alias("seed")).join(seeds.select("seed", "i"), "seed").select("d", "i").distinct(),
        "pairs",
    )
    parts = held.select("d", "doc_id", F.col("words").alias("doc_words"))
    texts = items.select("i", "item_id", F.col("words").alias("item"))
    joined = pairs.join(parts, "d").join(texts, "i").select("doc_id", "item_id", "doc_words", "item")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for d, i, text, item in zip(
                batch["doc_id"].to_pylist(), batch["item_id"].to_pylist(), _lists(batch["doc_words"]), _lists(batch["item"]),
                strict=True,
            ):
                marked, tiles = mark_tiles(text, item, shortest)
                if marked >= coverage * len(item):
                    rows.append((d, i, len(item), marked, tiles, marked / len(item)))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            names = ["doc_id", "item_id", "item_words", "matched_words", "tiles", "coverage"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    found = joined.mapInArrow(
        tile, "doc_id long, item_id long, item_words long, matched_words long, tiles long, coverage double"
    )
    best = F.max_by(F.struct("item_words", "matched_words", "tiles", "coverage"), F.struct("coverage", "item_words", "tiles"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")
