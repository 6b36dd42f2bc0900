"""Pairs of dense vectors with a high cosine, for item factors of any number of items.

Vectors are assigned to the nearest of a few centres. For a vector q and a cell with centre c
that holds b, the triangle inequality on angles gives

    angle(q, b) >= angle(q, c) - radius(cell)
    angle(q, b) >= (angle(q, c) - angle(q, own centre)) / 2

so q is sent only to where a match can be. Cells lie on shelves of bounded size, and q goes once to each
shelf with such a cell, however many they are; there it meets these cells by matrix products. With k, a
first round inside the own cell gives each vector a bound that narrows the second round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoprec.functions.scalars import DIGITS, norm
from shoprec.operators.copies import expand_all, expand_top, group_copies
from shoprec.operators.ranking import top_k
from shoprec.session import keep

MIN_SIM = 0.4
BLOCK = 500
CENTRES = 1024
_CELLS_PER_BLOCK = 4
_SIM_SLACK = 2.0 * 10.0**-DIGITS  # more than rounding can move a similarity
_ANGLE_SLACK = 1e-6  # more than arccos loses near 1


def _unit(vectors: DataFrame) -> DataFrame:
    """(id, unit) without zero vectors."""
    sized = vectors.select("id", "features", norm(F.col("features")).alias("length"))
    return sized.where(F.col("length") > 0).select(
        "id", F.transform("features", lambda x: x.cast("double") / F.col("length")).alias("unit")
    )


def _centres(groups: DataFrame, block: int, most: int) -> np.ndarray:
    """Some of the vectors, in hash order: a few per block, two at least, and `most` at the utmost.

    That bound, not the data, limits what is collected here. Beyond it cells hold more than a
    block, and a cell of more than a shelf has several, so no task grows with the data.
    """
    count = min(max(2, -(-groups.count() * _CELLS_PER_BLOCK // block)), most)
    rows = groups.orderBy(F.xxhash64("sig"), "sig").limit(count).select("unit").collect()
    return np.array([r.unit for r in rows], dtype=float)


def _angles_to(centres: np.ndarray):
    """Function of unit vectors: their angles to all centres.

    An inner function, as those handed to Spark below: they travel whole, and the workers
    need not have this package.
    """

    def angles(units: pd.Series) -> np.ndarray:
        return np.arccos(np.clip(np.stack(units.to_numpy()) @ centres.T, -1.0, 1.0))

    return angles


def _assign(groups: DataFrame, centres: np.ndarray) -> DataFrame:
    """Vectors with their cell and the angle to its centre."""
    angles_of = _angles_to(centres)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                angles = angles_of(rows["unit"])
                cell = angles.argmin(axis=1)
                yield rows.assign(cell=cell, angle=angles[np.arange(len(rows)), cell])

    return groups.mapInPandas(nearest, "sig int, unit array<double>, cell int, angle double")


#: Vectors whose angles to all centres are held at once, and visits in a frame.
SLICE, FRAME = 1024, 65_536
#: Vectors of a shelf and visitors that meet it in one task, at most, shelves if there are fewer vectors, and
#: similarities that a task holds at once.
SIDE, WAYS, PRODUCTS = 65_536, 8, 4_000_000


def _shelves(cells: list, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Of each cell the radius, its first shelf and its number of shelves, and the size of a shelf: small cells share
    one, a large one has several. One row per centre, so the tables are bounded by the number of centres."""
    total = sum(r["n"] for r in cells)
    side = min(SIDE, max(block, -(-total // WAYS)))
    most = 1 + max((r["cell"] for r in cells), default=-1)
    radius, first, parts = np.full(most, -np.inf), np.zeros(most, np.int64), np.zeros(most, np.int64)
    number, filled = 0, 0
    for r in sorted(cells, key=lambda r: r["cell"]):
        if filled and filled + r["n"] > side:
            number, filled = number + 1, 0
        radius[r["cell"]], first[r["cell"]], parts[r["cell"]] = r["radius"], number, -(-r["n"] // side)
        filled += r["n"]
        if parts[r["cell"]] > 1:
            number, filled = number + int(parts[r["cell"]]), 0
    return radius, first, parts, side


def _visits(queries: DataFrame, centres: np.ndarray, radius: np.ndarray, first: np.ndarray, parts: np.ndarray) -> DataFrame:
    """(sig, shelf) for each shelf with another cell that may hold a vector within `reach` of a query."""
    angles_of = _angles_to(centres)
    size, frame, slack = SLICE, FRAME, _ANGLE_SLACK
    held = np.flatnonzero(parts)  # a centre may have lost all vectors to an equally near one
    on = np.zeros((len(held), int((first + parts).max(initial=0))), np.float32)
    for i, c in enumerate(held.tolist()):
        on[i, first[c] : first[c] + parts[c]] = 1.0

    def reachable(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), size):
                rows = batch.iloc[start : start + size]
                angles = angles_of(rows["unit"])[:, held]
                own = rows["angle"].to_numpy()[:, None]
                reach = rows["reach"].to_numpy()[:, None]
                near = ((angles - own) / 2 <= reach + slack) & (angles - reach <= radius[held] + slack)
                near &= held != rows["cell"].to_numpy()[:, None]
                at, shelf = np.nonzero(near.astype(np.float32) @ on)
                sig = rows["sig"].to_numpy()
                for begin in range(0, len(at), frame):
                    some = slice(begin, begin + frame)
                    yield pd.DataFrame({"sig": sig[at[some]], "shelf": shelf[some]})

    return queries.mapInPandas(reachable, "sig int, shelf int")


def _matcher(min_sim: float, k: int | None, centres: np.ndarray | None = None, radius: np.ndarray | None = None):
    """Function of visitors and a shelf: pairs above min_sim, the k best per query when k is set.

    Without centres a query meets its own cell, with them the other cells that it may reach; of the second
    round only pairs that reach its `floor` are left.
    """
    products, margin, slack, digits = PRODUCTS, _SIM_SLACK, _ANGLE_SLACK, DIGITS

    def met(ids, units, floors, cells, others, homes, theirs):
        sims = units @ homes.T
        least = np.maximum(floors, min_sim)[:, None] - margin
        good = sims > least
        same = ids[:, None] == others[None, :]
        if centres is not None:
            same |= cells[:, None] == theirs[None, :]
        good &= ~same
        if k is not None:
            full = np.flatnonzero(np.count_nonzero(good, axis=1) > k)
            if len(full):
                some = np.where(good[full], sims[full], -9.0)
                kth = np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k]
                good[full] &= sims[full] >= kth[:, None] - margin
        at, to = np.nonzero(good)
        score = np.round(sims[at, to], digits)
        keep = (score > min_sim) & (score >= floors[at])
        return ids[at[keep]], others[to[keep]], score[keep]

    def best(found):
        ids, others, score = (np.concatenate(x) for x in zip(*found, strict=True))
        if k is not None and len(ids):
            order = np.lexsort((others, -score, ids))
            ids, others, score = ids[order], others[order], score[order]
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            place = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
            ids, others, score = ids[place < k], others[place < k], score[place < k]
        return pd.DataFrame({"sig": ids, "other": others, "score": score})

    def match(queries: pd.DataFrame, homes: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"sig": [], "other": [], "score": []}).astype(
            {"sig": "int32", "other": "int32", "score": "float64"}
        )
        if not len(queries) or not len(homes):
            return none
        homes, queries = homes.sort_values(["cell", "sig"]), queries.sort_values(["cell", "sig"])
        ids, cells, floors = (queries[c].to_numpy() for c in ("sig", "cell", "floor"))
        others, theirs = homes["sig"].to_numpy(), homes["cell"].to_numpy()
        units, there = np.stack(queries["unit"].to_numpy()), np.stack(homes["unit"].to_numpy())
        held, begin = np.unique(theirs, return_index=True)
        end = np.append(begin[1:], len(theirs))
        found = []
        if centres is None:
            for c, i, j in zip(held.tolist(), begin.tolist(), end.tolist(), strict=True):
                mine = np.flatnonzero(cells == c)
                step = max(1, products // (j - i))
                for some in (mine[x : x + step] for x in range(0, len(mine), step)):
                    found.append(met(ids[some], units[some], floors[some], cells[some], others[i:j], there[i:j], theirs[i:j]))
        else:
            angle, reach = (queries[c].to_numpy()[:, None] for c in ("angle", "reach"))
            step = max(1, min(512, products // len(theirs)))
            for x in range(0, len(ids), step):
                some = slice(x, x + step)
                angles = np.arccos(np.clip(units[some] @ centres[held].T, -1.0, 1.0))
                near = ((angles - angle[some]) / 2 <= reach[some] + slack) & (angles - reach[some] <= radius[held] + slack)
                near &= cells[some][:, None] != held[None, :]
                wanted = np.repeat(near.any(axis=0), end - begin)
                to = slice(None) if wanted.all() else np.flatnonzero(wanted)
                found.append(met(ids[some], units[some], floors[some], cells[some], others[to], there[to], theirs[to]))
        return best(found) if found else none

    return match


def _search(queries: DataFrame, homes: DataFrame, side: int, match) -> DataFrame:
    """Directed matches (sig, other, score) of queries (sig, unit, cell, angle, reach, floor, shelf) with the
    vectors (sig, unit, cell, shelf) of a shelf.

    What is moved grows with the visits and with the shelves times their groups of visitors.
    """
    columns = F.ceil(F.count(F.lit(1)) / side).cast("int").alias("_columns")
    visitors = F.broadcast(queries.groupBy("shelf").agg(columns))  # one row a shelf
    keys, width = ["shelf", "_j"], int(homes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def spread(rows: DataFrame, group: Column, *names: str) -> DataFrame:
        # Fresh names on both sides: queries and homes may be the same table.
        placed = rows.join(visitors, "shelf").select(*[F.col(c).alias(c) for c in (*names, "shelf")], group.alias("_j"))
        return placed.repartition(width, *keys)

    asking = spread(
        queries, F.pmod(F.xxhash64("sig"), F.col("_columns")).cast("int"), "sig", "unit", "cell", "angle", "reach", "floor"
    ).groupBy(*keys)
    asked = spread(homes, F.explode(F.sequence(F.lit(0), F.col("_columns") - 1)), "sig", "unit", "cell").groupBy(*keys)
    return asking.cogroup(asked).applyInPandas(match, "sig int, other int, score double")


def _similar_groups(
    groups: DataFrame, min_sim: float, k: int | None, block: int, centres: int
) -> DataFrame:
    """Directed matches (sig, other, score) between distinct unit vectors."""
    points = _centres(groups, block, centres)
    if not len(points):
        return groups.select("sig", F.col("sig").alias("other"), F.lit(1.0).alias("score")).limit(0)
    homes = keep(_assign(groups, points))
    cells = homes.groupBy("cell").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n")).collect()
    radius, first, parts, side = _shelves(cells, block)
    places = F.broadcast(homes.sparkSession.createDataFrame(
        [(c, int(first[c]), int(parts[c])) for c in np.flatnonzero(parts).tolist()], "cell int, _first int, _parts int"
    ))
    there = homes.join(places, "cell")
    one = (F.col("_first") + F.pmod(F.xxhash64("sig"), F.col("_parts"))).cast("int").alias("shelf")
    placed = there.select("sig", "unit", "cell", one)
    widest = F.lit(float(np.arccos(max(-1.0, min_sim - _SIM_SLACK))))
    query = ["sig", "unit", "cell", "angle"]
    every = F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_parts") - 1)).alias("shelf")
    own = there.select(*query, widest.alias("reach"), F.lit(-2.0).alias("floor"), every)
    near = _search(own, placed, side, _matcher(min_sim, k))
    if k is None:
        queries = homes.select(*query, widest.alias("reach"), F.lit(-2.0).alias("floor"))
    else:
        near = keep(top_k(near, "sig", "score", "other", k))
        bound = near.where(F.col("rank") == k).select("sig", (F.col("score") - _SIM_SLACK).alias("_floor"))
        reach = F.coalesce(F.acos(F.greatest(F.lit(-1.0), "_floor")), widest).alias("reach")
        queries = homes.join(bound, "sig", "left").select(*query, reach, F.coalesce("_floor", F.lit(-2.0)).alias("floor"))
    # Visits are (sig, shelf) only; the values are joined to them here.
    visits = _visits(queries, points, radius, first, parts).join(queries, "sig")
    far = _search(visits, placed, side, _matcher(min_sim, k, points, radius))
    return near.select("sig", "other", "score").unionByName(far)


def cosine_sim(
    vectors: DataFrame,
    min_sim: float = MIN_SIM,
    k: int | None = None,
    block: int = BLOCK,
    centres: int = CENTRES,
) -> DataFrame:
    """Directed pairs of (id, features) rows with a cosine above min_sim.

    Returns (productId, recProductId, score), with k the k best per item and their rank. The
    result is exact. Equal vectors are searched once.
    """
    groups, members = group_copies(_unit(vectors), "id", "unit")
    groups = groups.select("sig", "n", "unit")
    searched = groups.select("sig", "unit")
    matches = _similar_groups(searched, min_sim, k, block, centres)
    alike = groups.select("sig", "n")
    if k is None:
        return expand_all(members, alike, matches, "id")
    return expand_top(members, alike, matches, "id", k)
