"""Exact Jaccard join of word n-gram sets with a token-group matrix.

Equal sets are one node. Tokens (hashed n-grams) are put in one order for all sets, with tokens of
very many documents last, and of each set of n only the first n - ceil(t n) + 1 count: two sets
whose similarity reaches t share one of those. A first round links each set to the best of the sets
that lead its tokens; what hangs together is a group of similar documents. The matrix then holds,
for groups of bounded size, the union of their members' tokens. The overlap of a set with a union
bounds its overlap with every member, so only groups whose bound reaches t are opened, and only
those of another component, whose members are compared exactly. Nothing is capped, so no link
between components is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoprec.llm.common import Scratch, steps, texts_of
from shoprec.llm.components import components
from shoprec.llm.words import mix, shingles, words

#: Cells of the table of token counts, which is the same size for any corpus.
CELLS = 1 << 23
#: Sets in one group of the matrix.
GROUP = 64
#: Tokens in a range of the hash, about, and in the blocks that a task sends at once.
BUCKET, FLUSH = 200_000, 2_000_000
#: Sets that a group meets in one task, about.
ASKING = 500
#: Sets of a token from which its join is dealt to several tasks, and to how many at most; parts of
#: the members of a large group.
COMMON, SALTS = 2_000, 64


def need(n: Column, percent: int) -> Column:
    """Tokens that a set of n must share with any set at the similarity, ceil(percent n / 100)."""
    return F.floor((n * percent + 99) / 100).cast("long")


def set_name(tokens: np.ndarray) -> int:
    """64-bit name of a sorted set of tokens."""
    if not len(tokens):
        return 0
    place = np.arange(1, len(tokens) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return int(mix(np.array([mix(tokens ^ mix(place)).sum(dtype=np.uint64)]) + np.uint64(len(tokens)))[0].view(np.int64))


def token_counts(texts: DataFrame, n: int, cells: int = CELLS) -> np.ndarray:
    """Documents per cell of the token hash: `cells` numbers, summed over all tasks."""
    slices = 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int32)
        for batch in batches:
            for step in steps(batch):
                for s in shingles(*words(step["text"]), n):
                    np.add.at(total, (s & np.uint64(cells - 1)).astype(np.int64), np.int32(1))
        parts = total.reshape(slices, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(slices), pa.int32()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())],
            ["slice", "counts"],
        )

    def sum_up(table: pa.Table) -> pa.Table:
        total = np.zeros(cells // slices, np.int64)
        for x in table["counts"].to_pylist():
            total += np.frombuffer(zlib.decompress(x), np.int32)
        return pa.table({"slice": table["slice"][:1], "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    summed = texts.select("text").mapInArrow(count, "slice int, counts binary").groupBy("slice").applyInArrow(
        sum_up, "slice int, counts binary"
    )
    out = np.zeros((slices, cells // slices), np.int64)
    for row in summed.collect():  # `slices` rows of bounded size
        out[row["slice"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return out.ravel()


def levels(counts: np.ndarray) -> np.ndarray:
    """Order class of each cell: 0, or more the more its count exceeds what is usual."""
    mean = counts.mean()
    usual = max(16.0, mean + 4 * np.sqrt(mean))
    return np.where(counts > usual, 1 + np.log2(np.maximum(counts, 1) / usual) * 4, 0).astype(np.uint8)


def verified(scratch: Scratch, pairs: DataFrame, held: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of set names whose sets reach the similarity."""
    left = held.select(F.col("s").alias("a"), F.col("text").alias("text_a"))
    right = held.select(F.col("s").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[int | None, np.ndarray] = (None, np.empty(0, np.uint64))
        for batch in batches:
            for step in steps(batch, "text_a"):
                a, b = step["a"].to_pylist(), step["b"].to_pylist()
                mine = shingles(*words(step["text_a"]), n)
                keep = []
                for i in range(step.num_rows):
                    if known[0] != b[i]:
                        known = (b[i], shingles(*words(step["text_b"].slice(i, 1)), n)[0])
                    x, y = mine[i], known[1]
                    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                        continue
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * same >= percent * (len(x) + len(y) - same):
                        keep.append(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"]
                )

    return scratch.write(both.mapInArrow(check, "a long, b long"), "links")


def _within(scratch: Scratch, opened: DataFrame, members: DataFrame, held: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) of sets with the members of the groups opened for them, of other components.

    A group of at most GROUP members meets at most about ASKING sets in a task; more sets are dealt
    to several copies of the group. The union of the group's tokens bounds each overlap first.
    """
    keys = ["g", "chunk", "part"]
    parts = scratch.write(
        opened.groupBy("g", "chunk").agg(F.ceil(F.count("*") / ASKING).cast("long").alias("parts")), "parts"
    )
    asking = opened.join(parts, ["g", "chunk"]).select(
        "g", "chunk", F.pmod(F.xxhash64("s"), "parts").alias("part"), "s", "own"
    ).join(held, "s")
    asked = members.join(parts, ["g", "chunk"]).select(
        "g", "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "s", "own"
    ).join(held, "s")

    # Fresh names: both sides come from the same tables.
    asking, asked = (df.select(*[F.col(c).alias(c) for c in (*keys, "s", "own", "text")]) for df in (asking, asked))

    def check(queries: pa.Table, group: pa.Table) -> pa.Table:
        def sets(table: pa.Table) -> list[tuple[int, int, np.ndarray]]:
            out = []
            for batch in table.to_batches():
                for step in steps(batch):
                    out += zip(step["s"].to_pylist(), step["own"].to_pylist(), shingles(*words(step["text"]), n), strict=True)
            return out

        links: list[tuple[int, int]] = []
        home = sets(group)
        if home:
            union = np.unique(np.concatenate([x for _, _, x in home]))
            for s, own, x in sets(queries):
                at = np.searchsorted(union, x)
                at[at == len(union)] = 0
                if 100 * int((union[at] == x).sum()) < percent * len(x):
                    continue
                for t, other, y in home:
                    if other == own or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                        continue
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * same >= percent * (len(x) + len(y) - same):
                        links.append((s, t))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    far = scratch.write(
        asking.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(check, "a long, b long"), "far"
    )
    scratch.drop(parts)
    return far


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of `docs`.

    Words are lower-cased (A-Z). A text with fewer than n words has its whole sequence as its one
    n-gram; a null text or one without words has none and is linked with nothing, not with another
    empty one. component_id is the smallest id reachable over links of at least `percent` percent;
    equal sets are linked, repeated rows and ids too. A null id is no smallest id, unless alone.
    Other columns are not looked at. Without rows the result is empty.
    """
    scratch = Scratch(docs.sparkSession)
    texts = texts_of(docs, id_col, text_col)
    nodes, live = _nodes(scratch, texts, n, percent)
    least = nodes.where("n > 0").groupBy("s").agg(F.min("doc_id").alias("rep"))
    held = _held(scratch, texts, live.select("s").distinct().join(least, "s"), n)

    # First round: each set and the leader it shares most tokens with. A token is led by the set whose
    # tokens are the most common: an original rather than one of its changed copies.
    weight = scratch.write(live.groupBy("s").agg(F.sum("df").alias("weight")), "weight")
    leads = scratch.write(
        live.select("token", "s", "n", "df").join(weight, "s").groupBy("token")
        .agg(F.max(F.struct("weight", "s", "n")).alias("lead"), F.max("df").alias("df"))
        .select("token", F.col("lead.s").alias("lead"), F.col("lead.n").alias("lead_n"), "df"),
        "leads",
    )
    # The sets of a common token are dealt to several tasks, each with the token's leader.
    salts = F.when(F.col("df") > COMMON, F.least(F.lit(SALTS), F.ceil(F.col("df") / COMMON))).otherwise(1)
    salted = live.select("token", "s", "n", F.pmod(F.xxhash64("s"), salts).cast("long").alias("salt"))
    spread = leads.select("token", "lead", "lead_n", F.explode(F.sequence(F.lit(0).cast("long"), salts.cast("long") - 1)).alias("salt"))
    led = scratch.write(
        salted.join(spread, ["token", "salt"])
        .where((F.col("s") != F.col("lead")) & (100 * F.least("n", "lead_n") >= percent * F.greatest("n", "lead_n")))
        .groupBy("s", "lead").agg(F.count("*").alias("c"))
        .groupBy("s").agg(F.max_by("lead", F.struct("c", "lead")).alias("lead")),
        "led",
    )
    scratch.drop(weight, leads)
    near = verified(scratch, led.select(F.col("s").alias("a"), F.col("lead").alias("b")), held, n, percent)
    group_of = scratch.write(components(near), "groups")

    # Second round: sets against groups that hold another component. A group is the sets with one
    # leader, linked or not, cut into chunks.
    placed = scratch.write(
        live.select("token", "s", "n").join(group_of.withColumnRenamed("node", "s"), "s", "left")
        .select("token", "s", "n", F.coalesce("component", "s").alias("own")),
        "placed",
    )
    scratch.drop(live, group_of)
    mixed = placed.groupBy("token").agg(F.min("own").alias("x"), F.max("own").alias("y")).where("x <> y").select("token")
    mixed = scratch.write(mixed, "mixed")
    open_tokens = scratch.write(placed.join(mixed, "token"), "open")
    scratch.drop(placed, mixed)
    members = _chunked(
        open_tokens.select("s", "n", "own").distinct().join(led, "s", "left").select(
            "s", "n", "own", F.coalesce("lead", "s").alias("g")
        )
    )
    members = scratch.write(members, "members")
    scratch.drop(led)
    bounds = members.groupBy("g", "chunk").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("own").alias("x"), F.max("own").alias("y"),
        F.count("*").alias("m"),
    )
    where_ = members.select("s", F.col("g").alias("my_g"), F.col("chunk").alias("my_chunk"))
    asking = open_tokens.join(where_, "s")
    matrix = scratch.write(
        asking.select("token", F.col("my_g").alias("g"), F.col("my_chunk").alias("chunk")).distinct()
        .join(bounds, ["g", "chunk"]),
        "matrix",
    )
    suffix = lambda x: need(F.col(x), percent) - 1  # noqa: E731  tokens behind the first ones
    later = (F.col("my_g") > F.col("g")) | ((F.col("my_g") == F.col("g")) & (F.col("my_chunk") >= F.col("chunk")))
    opened = (
        asking.join(matrix, "token")
        .where(later & ~((F.col("x") == F.col("y")) & (F.col("x") == F.col("own"))))
        .where((100 * F.col("high") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("low")))
        .groupBy("s", "n", "own", "g", "chunk", "low", "high", "m").agg(F.count("*").alias("c"))
        .where(
            (F.col("c") + F.greatest(suffix("n"), suffix("high"))) * (100 + percent)
            >= percent * (F.col("n") + F.col("low"))
        )
        .select("s", "own", "g", "chunk", "m")
    )
    opened = scratch.write(opened, "opened")
    scratch.drop(open_tokens, matrix)
    single = members.select(F.col("s").alias("b"), "g", "chunk")
    alone = opened.where("m = 1").join(single, ["g", "chunk"]).select(F.col("s").alias("a"), "b")
    alone = verified(scratch, alone, held, n, percent)
    far = _within(scratch, opened.where("m > 1"), members, held, n, percent)
    scratch.drop(held, opened, members)
    whole = scratch.write(components(near.unionByName(alone).unionByName(far)), "components")
    scratch.drop(near, alone, far)

    named = least.join(whole.withColumnRenamed("node", "s"), "s", "left").select(
        "s", "rep", F.coalesce("component", "s").alias("component")
    )
    named = scratch.write(named, "named")
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    labels = scratch.write(named.join(smallest, "component").select("s", "component_id"), "labels")
    scratch.drop(whole, named)
    return nodes.join(labels, "s", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _chunked(members: DataFrame) -> DataFrame:
    """Members (s, n, own, g) with a chunk of at most about GROUP for those of one group. Only groups
    with more are joined, each in SALTS parts, so no task gets all members of a large one."""
    large = members.groupBy("g").agg(F.ceil(F.count("*") / GROUP).cast("long").alias("chunks")).where("chunks > 1")
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = members.withColumn("salt", F.pmod(F.xxhash64("s", "g"), F.lit(SALTS)).cast("int"))
    return salted.join(large.select("g", "chunks", every), ["g", "salt"], "left").select(
        "s", "n", "own", "g", F.pmod(F.xxhash64("s"), F.coalesce("chunks", F.lit(1))).alias("chunk")
    )


def _nodes(scratch: Scratch, texts: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, s, n) for each row, and (token, s, n, df) for the first tokens of each set that
    another set has among its first ones too; `df` is the number of such sets.

    Tokens of usual frequency are sent in packed blocks, by ranges of the hash; the sets that share
    one of them are few. Those of very frequent ones are plain rows that Spark can split.
    """
    counts = token_counts(texts, n)
    order = levels(counts)
    mask = np.uint64(len(order) - 1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists(parts: list[np.ndarray]) -> pa.Array:
            ends = np.array([0, *[len(x) for x in parts]]).cumsum()
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts).view(np.int64)))

        for batch in batches:
            for step in steps(batch):
                names, sizes, usual, often = [], [], [], []
                for s in shingles(*words(step["text"]), n):
                    m = len(s)
                    level = order[(s & mask).astype(np.int64)]
                    first = m - -(-percent * m // 100) + 1 if m else 0
                    at = np.lexsort((s, level))[:first] if level.any() else slice(0, first)
                    head, hot = s[at], level[at] > 0
                    names.append(set_name(s))
                    sizes.append(m)
                    usual.append(head[~hot])
                    often.append(head[hot])
                yield pa.RecordBatch.from_arrays(
                    [step["doc_id"], pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), lists(usual), lists(often)],
                    ["doc_id", "s", "n", "tokens", "often"],
                )

    sets = scratch.write(
        texts.mapInArrow(scan, "doc_id long, s long, n long, tokens array<long>, often array<long>"), "sets"
    )
    total = sets.agg(F.sum(F.size("tokens"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET))

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            token, s, m = (np.concatenate([h[i] for h in held]) for i in range(3))
            held.clear()
            by = np.argsort(token)
            token, s, m = token[by], s[by], m[by]
            part = (token // np.uint64(-(-(1 << 64) // buckets))).astype(np.int64) if buckets > 1 else np.zeros(len(token), np.int64)
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(token)]
            rows = []
            for a, b in zip(edges, edges[1:], strict=False):
                if a < b:
                    names, place, at = np.unique(s[a:b], return_index=True, return_inverse=True)
                    rows.append((int(part[a]), _packed(token[a:b]), at.astype("<u4").tobytes(), names.tobytes(),
                                 m[a:b][place].astype("<i8").tobytes()))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(cols)],
                ["bucket", "tokens", "at", "names", "sizes"],
            )

        waiting = 0
        for batch in batches:
            lists = batch["tokens"]
            k = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            own = np.repeat(np.arange(batch.num_rows), k)
            held.append((
                lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64),
                batch["s"].to_numpy(zero_copy_only=False)[own], batch["n"].to_numpy(zero_copy_only=False)[own],
            ))
            waiting += len(own)
            if waiting > FLUSH:
                yield flush()
                waiting = 0
        if held:
            yield flush()

    def meet(table: pa.Table) -> pa.Table:
        parts = []
        for row in table.to_pylist():
            at = np.frombuffer(row["at"], "<u4")
            parts.append((_unpacked(row["tokens"]), np.frombuffer(row["names"], np.int64)[at],
                          np.frombuffer(row["sizes"], "<i8")[at]))
        token, s, m = (np.concatenate([p[i] for p in parts]) for i in range(3))
        by = np.lexsort((s, token))
        token, s, m = token[by], s[by], m[by]
        new = np.concatenate(([True], (token[1:] != token[:-1]) | (s[1:] != s[:-1])))  # a set counts once
        token, s, m = token[new], s[new], m[new]
        first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(token))))
        df = np.bincount(group)[group]
        keep = df > 1
        return pa.table({"token": token[keep].view(np.int64), "s": s[keep], "n": m[keep], "df": df[keep]})

    kind = "token long, s long, n long, df long"
    blocks = sets.select("s", "n", "tokens").mapInArrow(
        block, "bucket int, tokens binary, at binary, names binary, sizes binary"
    )
    usual = blocks.groupBy("bucket").applyInArrow(meet, kind)
    rows = sets.select(F.explode("often").alias("token"), "s", "n").distinct()
    rows = scratch.write(rows, "often")
    common = scratch.write(rows.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "common")
    often = rows.join(common, "token").select("token", "s", "n", "df")
    live = scratch.write(usual.unionByName(often), "live")
    nodes = scratch.write(sets.select("doc_id", "s", "n"), "nodes")
    scratch.drop(rows, common, sets)
    return nodes, live


def _packed(tokens: np.ndarray) -> bytes:
    """Sorted tokens as differences, in planes of their bytes, compressed."""
    steps_ = np.diff(tokens, prepend=np.uint64(0))
    return zlib.compress(steps_.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _held(scratch: Scratch, texts: DataFrame, reps: DataFrame, n: int) -> DataFrame:
    """(s, text), one row for each of the sets that may have a link.

    A set's text is that of the row with its name and smallest id. A task sends a set once for each
    id, and rows that repeat an id or have none meet only rows of their own set.
    """

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            for step in steps(batch):
                names = [set_name(x) for x in shingles(*words(step["text"]), n)]
                keep = []
                for i, key in enumerate(zip(names, step["x_id"].to_pylist(), strict=True)):
                    if key[0] and key not in sent:
                        sent.add(key)
                        keep.append(i)
                at = pa.array(keep, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()).take(at), step["x_id"].take(at), step["text"].take(at)], ["s", "x_id", "text"]
                )

    x_id = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias("x_id")  # noqa: E731  equal sets may share one
    named = texts.select(x_id("doc_id"), "text").mapInArrow(name, "s long, x_id long, text string")
    joined = named.join(reps.select("s", x_id("rep")), ["s", "x_id"])
    return scratch.write(joined.groupBy("s", "x_id").agg(F.first("text").alias("text")).select("s", "text"), "held")
