"""Removing long repeated byte strings with a distributed merge sort of suffixes.

A string of `length` bytes that starts at two places is wanted. Only suffixes at *anchors* are
sorted: in each window of `length` bytes the place with the smallest hash of the next few bytes, so
that two equal windows have their anchor at the same offset. Anchors whose next bytes occur nowhere
else are left out by a count of hashes. What remains is cut to the bytes that matter, `length` after
the anchor and the anchor's reach before it (reversed), and sorted: each task makes sorted runs, cuts
them at common split points, and sends them front-coded, equal strings once with a count. Each
range is merged by a loser tree that never compares known prefixes again, and the common prefixes it
puts out say how far each anchor's surroundings repeat.

Equal texts are looked at once. A group of anchors with the same next bytes is settled in one task
if it has at most `crowd` members; the windows of larger ones are counted by hash instead, which
gives the same result and spreads over all tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoprec.llm.common import spool, steps
from shoprec.llm.merging import merge_front_coded
from shoprec.llm.words import _BASE, _INVERSE, _byte_values, _powers, mix, text_bytes

#: Bytes of text whose anchors are found at once.
BLOCK = 1 << 20
#: Strings of a sorted run, and strings in a range, about.
RUN, RANGE = 60_000, 20_000
#: Largest group of anchors with the same next bytes that one task settles.
CROWD = 100_000
PAD = 0xFF  # in no UTF-8 text


@dataclass(frozen=True)
class Shape:
    """Sizes that follow from the length of the strings wanted."""

    length: int

    @property
    def gram(self) -> int:
        """Bytes that are hashed to choose anchors."""
        return max(1, min(16, self.length // 4))

    @property
    def window(self) -> int:
        """Places an anchor is chosen from; a power of two."""
        return 1 << ((self.length - self.gram + 1).bit_length() - 1)

    @property
    def left(self) -> int:
        return self.window - 1

    @property
    def prefix(self) -> int:
        """Bytes after the anchor that lie in each of its windows."""
        return self.length - self.left

    @property
    def total(self) -> int:
        return self.length + self.left


def anchors(data: np.ndarray, offsets: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash of the next bytes, text) of the anchors of all texts laid end to end."""
    n, places, hashes = len(data), [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    values, reach = _byte_values(), shape.length
    size = min(n, BLOCK + reach)
    up, down = _powers(_BASE, size), _powers(_INVERSE, size)
    last_start = offsets[1:] - reach  # last window of each text
    for at in range(0, max(0, n - reach + 1), BLOCK):
        part = data[at : at + BLOCK + reach - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * up[: len(part)], dtype=np.uint64, out=sums[1:])
        m = len(part) - shape.gram + 1
        grams = (sums[shape.gram :] - sums[:m]) * down[:m] * np.uint64(0x9E3779B97F4A7C15)
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
        step = 1
        while step < shape.window:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        starts = len(part) - reach + 1
        chosen = (least[:starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        text = np.searchsorted(offsets, np.arange(at, at + starts), side="right") - 1
        chosen = chosen[np.arange(at, at + starts) <= last_start[text]]
        if len(chosen):
            chosen = chosen[np.concatenate(([True], chosen[1:] != chosen[:-1]))]
            hashes.append(mix((sums[chosen + shape.prefix] - sums[chosen]) * down[chosen]))
            places.append(chosen + at)
    place, hashed = np.concatenate(places), np.concatenate(hashes)
    if len(place):
        first = np.concatenate(([True], place[1:] != place[:-1]))  # at the seam of blocks
        place, hashed = place[first], hashed[first]
    return place, hashed, np.searchsorted(offsets, place, side="right") - 1


def surroundings(data: np.ndarray, offsets: np.ndarray, place: np.ndarray, text: np.ndarray, shape: Shape) -> np.ndarray:
    """One row of bytes for each anchor: what follows it, then what is before it, nearest first."""
    out = np.full((len(place), shape.total), PAD, np.uint8)
    after = place[:, None] + np.arange(shape.length)
    ok = after < offsets[text + 1][:, None]
    out[:, : shape.length][ok] = data[after[ok]]
    before = place[:, None] - 1 - np.arange(shape.left)
    ok = before >= offsets[text][:, None]
    out[:, shape.length :][ok] = data[before[ok]]
    return out


def names_of(rows: np.ndarray) -> list[bytes]:
    """128-bit names of rows of bytes."""
    import xxhash

    return [xxhash.xxh3_128_digest(r.data) for r in np.ascontiguousarray(rows)]


def shared_prefix(x: bytes, y: bytes) -> int:
    if x == y:
        return len(x)
    n = min(len(x), len(y))
    differ = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def settle(group: list[tuple[int, bytes, int]], shape: Shape) -> list[tuple[int, int]]:
    """(bytes before, bytes from the anchor on) that repeated windows around each string cover.

    The group holds different strings in order, all with the same first bytes: (prefix shared with
    the one before, string, count). For a shared prefix of r bytes the best partner is the one that
    shares most of the bytes before, a neighbour in their order among all strings that share r; a
    window is covered where both together reach the length. (0, 0): nothing repeats.
    """
    n, length = len(group), shape.length
    after = [s.find(b"\xff", 0, length) for _, s, _ in group]
    after = [length if x < 0 else x for x in after]
    before = [s[length:] for _, s, _ in group]
    room = [x.find(b"\xff") for x in before]
    room = [shape.left if x < 0 else x for x in room]
    best = [(room[i], after[i]) if group[i][2] > 1 else (0, 0) for i in range(n)]
    if n == 1:
        return best
    shared = [min(g[0], length) for g in group]

    def meet(i: int, j: int, r: int, side: int) -> None:
        for k in (i, j):
            a, b = min(side, room[k]), min(r, after[k])
            if a + b >= length:
                best[k] = (max(best[k][0], a), max(best[k][1], b))

    if n == 2:
        meet(0, 1, shared[1], shared_prefix(before[0], before[1]))
        return best
    run = list(range(n))  # first member of the interval that a member is in
    members: dict[int, list[int]] = {i: [i] for i in range(n)}
    for level in sorted(set(shared[1:]), reverse=True):
        touched = set()
        for i in range(1, n):
            if shared[i] == level:
                a, b = run[i - 1], run[i]
                both = members[a] + members.pop(b)
                for k in members_of(run, i, n, b):
                    run[k] = a
                members[a] = both
                touched.add(a)
                touched.discard(b)
        for a in touched:
            order = sorted(members[a], key=before.__getitem__)
            members[a] = order
            for x, y in zip(order, order[1:], strict=False):
                meet(x, y, level, shared_prefix(before[x], before[y]))
    return best


def members_of(run: list[int], start: int, n: int, name: int) -> Iterator[int]:
    """Members of the interval that begins at `start`, which lie next to each other."""
    while start < n and run[start] == name:
        yield start
        start += 1


def pack_run(rows: np.ndarray, counts: np.ndarray) -> bytes:
    """Front-coded form of different sorted rows."""
    shared = np.zeros(len(rows), np.uint16)
    if len(rows) > 1:
        shared[1:] = (rows[1:] != rows[:-1]).argmax(axis=1)
    rest = rows[np.arange(rows.shape[1]) >= shared[:, None]]
    head = np.array([len(rows)], "<u4").tobytes()
    return zlib.compress(head + shared.astype("<u2").tobytes() + counts.astype("<u4").tobytes() + rest.tobytes(), 1)


def unpack_run(packed: bytes, total: int) -> Iterator[tuple[int, bytes, int]]:
    raw = zlib.decompress(packed)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    shared = np.frombuffer(raw, "<u2", n, 4).tolist()
    counts = np.frombuffer(raw, "<u4", n, 4 + 2 * n).tolist()
    at = 4 + 6 * n
    for s, c in zip(shared, counts, strict=True):
        yield s, raw[at : at + total - s], c
        at += total - s


def repeated_spans(texts: DataFrame, length: int = 200, run: int = RUN, range_size: int = RANGE,
                   crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """(spans, copies) for texts (doc_id, text, h, n_bytes): the repeated stretches [start, end) of
    each different text (h, n_bytes), and each different text with its number of rows."""
    shape = Shape(length)
    texts = texts.drop("carried")
    long_enough = texts.where(F.col("n_bytes") >= length)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch):
                data, offsets = text_bytes(step["text"])
                _, hashed, text = anchors(data, offsets, shape)
                order = np.lexsort((hashed, text))
                hashed, text = hashed[order], text[order]
                same = (hashed[1:] == hashed[:-1]) & (text[1:] == text[:-1])
                first = np.concatenate(([True], ~same)) if len(hashed) else np.empty(0, bool)
                again = np.concatenate((same, [False]))[first] if len(hashed) else first
                keys = step["h"].to_numpy(zero_copy_only=False)[text[first]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashed[first].view(np.int64)), pa.array(keys), pa.array(again)], ["hash", "h", "again"]
                )

    seeds = spool(long_enough.select("text", "h").mapInArrow(found, "hash long, h long, again boolean"), "anchors")
    repeated = spool(
        seeds.groupBy("hash")
        .agg(F.min("h").alias("a"), F.max("h").alias("b"), F.max("again").alias("again"), F.count("*").alias("n"))
        .where((F.col("a") != F.col("b")) | F.col("again"))
        .select("hash", (F.col("n") > crowd).alias("crowded")),
        "repeated",
    )
    copies = spool(
        texts.groupBy("h", "n_bytes").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "copies"
    )
    wanted = (
        seeds.join(repeated, "hash")
        .groupBy("h")
        .agg(F.collect_set(F.struct("hash", "crowded")).alias("wanted"))
        .join(copies.select(F.col("h"), F.col("n_bytes"), "rep"), "h")
        .select("h", "n_bytes", F.col("rep").alias("doc_id"), "wanted")
    )
    keys = ["h", "n_bytes", "doc_id"]
    match = long_enough.select(*[F.col(k).alias(f"x_{k}") for k in keys], "text")
    on = [match[f"x_{k}"].eqNullSafe(F.col(k)) for k in keys]
    held = spool(
        match.join(wanted, on)
        .select("h", "n_bytes", "text", F.transform("wanted", lambda x: x["hash"]).alias("hashes"),
                F.transform("wanted", lambda x: x["crowded"]).alias("crowded")),
        "held",
    )

    def chosen(step: pa.RecordBatch, crowded: bool, all_starts: bool = False):
        """Bytes, text ends, and the wanted anchors (place, text) of a step."""
        data, offsets = text_bytes(step["text"])
        place, hashed, text = anchors(data, offsets, shape)
        lists, flags = step["hashes"], step["crowded"]
        flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        flag = np.asarray(flags.flatten().to_numpy(zero_copy_only=False), bool)
        owner = np.repeat(np.arange(step.num_rows), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
        mine, theirs = np.lexsort((hashed, text)), np.lexsort((flat, owner))
        pick = np.zeros(len(place), bool)
        pairs = np.empty(len(theirs), [("o", np.int64), ("h", np.uint64)])
        pairs["o"], pairs["h"] = owner[theirs], flat[theirs]
        have = np.empty(len(mine), pairs.dtype)
        have["o"], have["h"] = text[mine], hashed[mine]
        at = np.searchsorted(pairs, have)
        at[at == len(pairs)] = 0
        ok = (pairs[at] == have) & (flag[theirs][at] == crowded) if len(pairs) else np.zeros(len(have), bool)
        pick[mine] = ok
        return data, offsets, place, text, pick

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, most=1 << 19):
                data, offsets, place, text, pick = chosen(step, False)
                place, text = place[pick], text[pick]
                rows = surroundings(data, offsets, place, text, shape)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(step["h"].to_numpy(zero_copy_only=False)[text]),
                        pa.array(step["n_bytes"].to_numpy(zero_copy_only=False)[text]),
                        pa.array(place - offsets[text]), pa.array(names_of(rows), pa.binary()),
                    ],
                    ["h", "n_bytes", "place", "name"],
                )

    located_at = spool(held.mapInArrow(located, "h long, n_bytes long, place long, name binary"), "located")
    splits = _splits(held, located_at.count(), range_size, chosen, shape)

    def sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        held_rows: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(held_rows)
            held_rows.clear()
            kind = f"S{shape.total}"
            text, counts = np.unique(np.ascontiguousarray(rows).view(kind).ravel(), return_counts=True)
            rows = np.ascontiguousarray(text).view(np.uint8).reshape(-1, shape.total)
            heads = np.ascontiguousarray(rows[:, : shape.prefix]).view(f"S{shape.prefix}").ravel()
            part = np.searchsorted(splits, heads, side="right") if len(splits) else np.zeros(len(rows), np.int64)
            edges = np.flatnonzero(np.diff(part)) + 1
            pieces = list(zip([0, *edges], [*edges, len(rows)], strict=True))
            name = uuid.uuid4().hex
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([int(part[a]) for a, _ in pieces], pa.int32()), pa.array([name] * len(pieces)),
                    pa.array([pack_run(rows[a:b], counts[a:b]) for a, b in pieces], pa.binary()),
                ],
                ["range", "run", "packed"],
            )

        waiting = 0
        for batch in batches:
            for step in steps(batch, most=1 << 19):
                data, offsets, place, text, pick = chosen(step, False)
                place, text = place[pick], text[pick]
                if len(place):
                    held_rows.append(surroundings(data, offsets, place, text, shape))
                    waiting += len(place)
                if waiting >= run:
                    yield flush()
                    waiting = 0
        if waiting:
            yield flush()

    def merged(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = [x for t in tables for x in t["packed"].to_pylist()]
        out: list[tuple[bytes, int, int]] = []
        group: list[tuple[int, bytes, int]] = []

        def close() -> None:
            if len(group) > 1 or (group and group[0][2] > 1):
                for (_, s, _), (a, b) in zip(group, settle(group, shape), strict=True):
                    if b:
                        out.append((s, a, b))
            group.clear()

        def flushed() -> pa.RecordBatch:
            import xxhash

            batch = pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s) for s, _, _ in out], pa.binary()),
                 pa.array([a for _, a, _ in out], pa.int32()), pa.array([b for _, _, b in out], pa.int32())],
                ["name", "before", "after"],
            )
            out.clear()
            return batch

        for shared, text, count in merge_front_coded([unpack_run(p, shape.total) for p in packed]):
            if group and shared == shape.total:
                group[-1] = (group[-1][0], text, group[-1][2] + count)
                continue
            if group and shared < shape.prefix:
                close()
                if len(out) > 20_000:
                    yield flushed()
            group.append((shared, text, count))
        close()
        yield flushed()

    def by_range(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(merged(iter(table.to_batches()))))

    covered = (
        held.mapInArrow(sorted_runs, "range int, run string, packed binary")
        .groupBy("range").applyInArrow(by_range, "name binary, before int, after int")
    )
    spans = located_at.join(covered, "name").select(
        "h", "n_bytes", (F.col("place") - F.col("before")).alias("start"), (F.col("place") + F.col("after")).alias("end")
    )

    def all_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each window that has a crowded anchor, by a name of its bytes."""
        import xxhash

        for batch in batches:
            for step in steps(batch, most=1 << 19):
                data, offsets, place, text, pick = chosen(step, True)
                if not pick.any():
                    continue
                raw, rows = data.tobytes(), []
                for p, t in zip(place[pick].tolist(), text[pick].tolist(), strict=True):
                    low, high = max(int(offsets[t]), p - shape.left), min(p, int(offsets[t + 1]) - shape.length)
                    for s in range(low, high + 1):
                        rows.append((t, s - int(offsets[t]), xxhash.xxh3_128_digest(raw[s : s + shape.length])))
                own, start, name = zip(*dict.fromkeys(rows), strict=True)
                own = np.array(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(step["h"].to_numpy(zero_copy_only=False)[own]),
                     pa.array(step["n_bytes"].to_numpy(zero_copy_only=False)[own]),
                     pa.array(start, pa.int64()), pa.array(name, pa.binary())],
                    ["h", "n_bytes", "start", "name"],
                )

    if repeated.where("crowded").limit(1).count():
        windows = spool(held.mapInArrow(all_windows, "h long, n_bytes long, start long, name binary"), "windows")
        often = windows.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
        spans = spans.unionByName(
            windows.join(often, "name").select("h", "n_bytes", "start", (F.col("start") + length).alias("end"))
        )
    return spans, copies


def _splits(held: DataFrame, n: int, range_size: int, chosen, shape: Shape) -> np.ndarray:
    """First bytes at which ranges of about `range_size` strings begin, from an even sample with
    about 20 strings a range; only the balance of the tasks depends on it."""
    ranges = -(-n // range_size)
    if ranges < 2:
        return np.empty(0, f"S{shape.prefix}")
    share = min(1.0, 20 * ranges / n)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, most=1 << 19):
                data, offsets, place, text, pick = chosen(step, False)
                drawn = (mix(place.astype(np.uint64) + np.uint64(len(data))) >> np.uint64(11)) < share * 2**53
                place, text = place[pick & drawn], text[pick & drawn]
                rows = surroundings(data, offsets, place, text, shape)[:, : shape.prefix]
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary())], ["head"])

    heads = sorted(r["head"] for r in held.mapInArrow(sample, "head binary").toLocalIterator())
    cuts = [heads[len(heads) * i // ranges] for i in range(1, ranges)] if heads else []
    return np.array(sorted(set(cuts)), f"S{shape.prefix}")


def union_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(doc_id, text, carried, h, n_bytes): texts are told apart by hash and length."""
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("struct<x: int>")
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        carried.alias("carried"),
    ).withColumns({"h": F.xxhash64("text"), "n_bytes": F.octet_length("text").cast("long")})


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text",
                   carry: list[str] | None = None, **sizes: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, carried) for each row. `kept` is what
    stays without characters that were cut in part, `carried` a struct of the columns in `carry`.

    Every byte is removed that lies in a string of `length` bytes that also starts anywhere else,
    in another row or in the same one, overlaps included; no match crosses rows. n_spans counts the
    maximal removed stretches. A null text is an empty one: nothing is removed. Texts shorter than
    `length` stay. Rows that repeat a text lose it whole if it is long enough, repeated ids
    included, as each occurs elsewhere. Other columns are not looked at; no row, no result.
    """
    texts = keyed(docs, id_col, text_col, carry)
    spans, copies = repeated_spans(texts, length, **sizes)
    whole = copies.where((F.col("copies") > 1) & (F.col("n_bytes") >= length)).select(
        "h", "n_bytes", F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")
    )
    cuts = spool(
        spans.unionByName(whole).groupBy("h", "n_bytes")
        .agg(F.collect_set(F.struct("start", "end")).alias("spans"))
        .select("h", "n_bytes", F.transform("spans", lambda x: x["start"]).alias("starts"),
                F.transform("spans", lambda x: x["end"]).alias("ends")),
        "cuts",
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            for step in steps(batch):
                rows = []
                data, offsets = text_bytes(step["text"])
                raw, at = data.tobytes(), offsets.tolist()
                starts, ends = step["starts"].to_pylist(), step["ends"].to_pylist()
                for i, doc_id in enumerate(step["doc_id"].to_pylist()):
                    text = raw[at[i] : at[i + 1]]
                    runs = union_spans(list(zip(starts[i] or [], ends[i] or [], strict=True)))
                    edges = [0, *[x for r in runs for x in r], len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    rows.append((doc_id, len(text), len(text) - len(kept), len(runs),
                                 hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "carried"]
                cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*cols, step["carried"]], names)

    kind = texts.schema["carried"].dataType.simpleString()
    return texts.join(cuts, ["h", "n_bytes"], "left").select("doc_id", "text", "starts", "ends", "carried").mapInArrow(
        cut,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string, "
        f"carried {kind}",
    )
