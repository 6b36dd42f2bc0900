"""Shards of near equal size by a minimax contiguous partition, in DataFrame functions only.

Equal texts are an atomic group. Groups stand in the order of a hash of their text; that order is
cut into `shards` runs so that the largest run is as small as possible. The smallest feasible
capacity is found by binary search, and a greedy pass over the ordered sizes checks each try. A
group larger than an even share has a shard of its own, and the others are cut as evenly as they can.
To keep the searched list bounded whatever the corpus, groups with the same leading `bits` bits
of the hash are one item of it, so a cut is exact to the size of one such item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoprec.llm.common import spool

#: Leading bits of the text hash that order the groups: 2^16 items, about 1/4096 of a shard at 16.
BITS = 16
#: Rows that get their places in one group.
PART = 1024


def _sorted_items(alone: list[int]) -> Column:
    """Items in the order of atom, at most 2^BITS; those that stand alone have -1 bytes."""
    size = F.when(F.col("atom").isin(alone), F.lit(-1).cast("long")).otherwise(F.col("bytes")) if alone else F.col("bytes")
    return F.array_sort(F.collect_list(F.struct("atom", size.alias("bytes"))))


def _smallest(sizes: DataFrame, shards: int, alone: list[int], high: int | None) -> tuple[int, list[int]]:
    """(capacity, full): the smallest capacity with which the items that do not stand alone fill at
    most `shards` runs, none across an item that does, and the items of exactly this size; `high` is
    a capacity that is enough, if known."""
    free = ~F.col("atom").isin(alone) if alone else F.lit(True)
    size = F.when(free, F.col("bytes"))
    whole = sizes.agg(
        _sorted_items(alone).alias("items"),
        F.coalesce(F.sum(size), F.lit(0)).alias("total"),
        F.coalesce(F.max(size), F.lit(0)).alias("largest"),
    )
    lowest = F.greatest("largest", F.ceil(F.col("total") / shards).cast("long"))
    # Any run closed by a greedy pass with this capacity exceeds capacity - largest.
    enough = F.col("largest") + F.ceil(F.col("total") / shards).cast("long")
    highest = enough if high is None else F.lit(high).cast("long")
    start = F.struct(lowest.alias("low"), highest.alias("high"))
    middle = lambda s: F.floor((s["low"] + s["high"]) / 2).cast("long")

    def runs(capacity):
        """Runs that a greedy pass makes with this capacity."""
        return F.aggregate(
            "items",
            F.struct(F.lit(0).alias("runs"), capacity.alias("used")),
            lambda s, x: F.when(x["bytes"] < 0, F.struct(s["runs"].alias("runs"), capacity.alias("used")))
            .when(
                s["used"] + x["bytes"] <= capacity,
                F.struct(s["runs"].alias("runs"), (s["used"] + x["bytes"]).alias("used")),
            ).otherwise(F.struct((s["runs"] + 1).alias("runs"), x["bytes"].alias("used"))),
            lambda s: s["runs"],
        )

    def halved(s, _):
        ok = runs(middle(s)) <= shards
        return F.when(
            s["low"] < s["high"],
            F.when(ok, F.struct(s["low"].alias("low"), middle(s).alias("high"))).otherwise(
                F.struct((middle(s) + 1).alias("low"), s["high"].alias("high"))
            ),
        ).otherwise(s)

    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.greatest(highest - lowest, F.lit(0)) + 2)).cast("int") + 1)
    capacity = whole.select(F.aggregate(steps, start, halved, lambda s: s["high"]).alias("capacity")).first()[0]
    # At most `shards` rows, as each needs a run of its own.
    return capacity, [r["atom"] for r in sizes.where(size == capacity).select("atom").collect()]


def cuts(sizes: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(capacity, last): the smallest capacity with which the items of (atom, bytes), in the order
    of atom, fill at most `shards` runs, and the last atom of each run but the final one.

    Sizes are 1 or more. An item as large as the capacity has a run of its own; the search is then
    repeated for the items between such ones and the shards that remain, so that the other runs are
    not filled up to it. What remains is cut near even shares. No shard is left empty while there
    are items for it. All queries return one row for each item that stands alone at most. Without
    items: capacity 0, no runs.
    """
    capacity, full = _smallest(sizes, shards, [], None)
    if not capacity:
        return 0, []
    alone, each = sorted(full), capacity
    while full and len(alone) < shards:
        each, full = _smallest(sizes, shards - len(alone), alone, each)
        if not each:  # all items stand alone
            break
        alone = sorted([*alone, *full])

    # One row for each stretch of items between those that stand alone.
    stretch = sum([(F.col("atom") > x).cast("int") for x in alone], F.lit(0))
    rest = sizes.where(~F.col("atom").isin(alone)) if alone else sizes
    stretches = rest.groupBy(stretch.alias("stretch")).agg(
        F.sum("bytes").alias("total"), F.count("*").alias("n"), F.max("atom").alias("end"),
        _sorted_items([]).alias("items"),
    )
    # The last atoms of the runs that a greedy pass from the end makes: so many are needed from an item on.
    closing = F.aggregate(
        F.reverse("items"),
        F.struct(F.lit(each).cast("long").alias("used"), F.array().cast("array<int>").alias("closing")),
        lambda s, x: F.when(
            s["used"] + x["bytes"] <= each, F.struct((s["used"] + x["bytes"]).alias("used"), s["closing"].alias("closing"))
        ).otherwise(F.struct(x["bytes"].alias("used"), F.array_append(s["closing"], x["atom"]).alias("closing"))),
        lambda s: s["closing"],
    )
    stretches = stretches.withColumn("closing", closing)
    parts = {r["stretch"]: r for r in stretches.select("stretch", "total", "n", "end", F.size("closing").alias("runs")).collect()}
    runs = {k: r["runs"] for k, r in parts.items()}
    for _ in range(shards - len(alone) - sum(runs.values())):
        more = [k for k in runs if runs[k] < parts[k]["n"]]
        if more:
            runs[max(more, key=lambda k: (parts[k]["total"] / runs[k], -k))] += 1
    last = [*alone, *(r["end"] for r in parts.values())]
    if runs:
        given = F.element_at(F.create_map(*[F.lit(x) for pair in runs.items() for x in pair]), F.col("stretch"))
        for r in stretches.withColumn("given", given).select(_even(each).alias("last")).collect():
            last.extend(r["last"])
    return capacity, sorted(last)[:-1]


def _even(capacity: int) -> Column:
    """The last atom of each run but the final one when `items` are cut into `given` runs, each
    closed where it is nearest to an even share of what is left, as far as `closing` and `n` allow."""

    def step(s, x):
        need = F.size(F.filter(s["closing"], lambda c: c >= x["atom"]))
        over = s["used"] + x["bytes"]
        # Nearer to the even share of used + left without the item than with it.
        near = (s["used"] + over) * s["free"] >= 2 * (s["used"] + s["left"])
        close = s["before"].isNotNull() & (need < s["free"]) & ((over > capacity) | (s["n"] < s["free"]) | near)
        rest = (s["closing"].alias("closing"), (s["left"] - x["bytes"]).alias("left"), (s["n"] - 1).alias("n"),
                x["atom"].alias("before"))
        return F.when(
            close,
            F.struct(x["bytes"].alias("used"), *rest, (s["free"] - 1).alias("free"),
                     F.array_append(s["last"], s["before"]).alias("last")),
        ).otherwise(F.struct(over.alias("used"), *rest, s["free"].alias("free"), s["last"].alias("last")))

    return F.aggregate(
        "items",
        F.struct(
            F.lit(0).cast("long").alias("used"), F.col("closing"),  # in the state: made once, not for each item
            F.col("total").alias("left"), F.col("n").alias("n"),
            F.lit(None).cast("int").alias("before"), F.col("given").alias("free"),
            F.array().cast("array<int>").alias("last"),
        ),
        step,
        lambda s: s["last"],
    )


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                    bits: int = BITS, part: int = PART) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of `docs`.

    A null text has size 1, as an empty one, and both are one group. Repeated rows are placed one
    by one; rows with a null id are placed too. Ties in the order go by id, then by place in the
    input. Other columns are not looked at. Without rows the result is empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = spool(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(text), 64 - bits).cast("int").alias("atom"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shards",
    )
    # One row per atom, at most 2^bits.
    atoms = spool(rows.groupBy("atom").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "atoms")
    _, last = cuts(atoms, shards)
    earlier = [(F.col("atom") > x).cast("int") for x in last]  # one cut less than shards at most
    placed = atoms.select(
        "atom",
        sum(earlier, F.lit(0)).cast("int").alias("shard"),
        F.ceil(F.col("n") / part).cast("long").alias("parts"),
    )
    # A broadcast of at most 2^bits rows of three numbers. Large groups are dealt out by row.
    dealt = rows.join(F.broadcast(placed), "atom").withColumn("part", F.pmod(F.xxhash64("row"), "parts"))
    before = Window.partitionBy("shard").orderBy("atom", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("shard", "atom", "part").agg(F.count("*").alias("n"))
        .select("shard", "atom", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    within = Window.partitionBy("atom", "part").orderBy("doc_id", "row")
    return dealt.join(starts.drop("shard"), ["atom", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.row_number().over(within) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
