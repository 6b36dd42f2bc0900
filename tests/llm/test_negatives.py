import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoprec.llm import hard_negatives as hn
from shoprec.llm.hard_negatives import Asking, Bucket, Shape, hard_negatives

KIND = "vec_id long, vector array<long>, label int, part string, uid string, score int, rank int, length string"


def brute(rows, anchor, k, m, percent):
    """Sorted result rows by comparing each anchor with every row."""
    last = 1 << 70
    live = [(i, v, c) for i, v, c in rows if v is not None and c is not None and None not in v]
    out = []
    for at, (i, v, c) in enumerate(live):
        if i is None or not anchor(i):
            continue
        scored = []
        for other, (j, w, d) in enumerate(live):
            if other != at:
                scored.append((-sum(x * y for x, y in zip(v, w, strict=False)), last if j is None else j, d))
        scored.sort(key=lambda x: x[:2])
        for s, p, _ in [x for x in scored if x[2] == c][:k]:
            fits = [x for x in scored if x[2] != c and percent[0] * -s <= 100 * -x[0] <= percent[1] * -s][:m]
            out += [(i, None if p == last else p, r, None if j == last else j, -s, -t) for r, (t, j, _) in enumerate(fits, 1)]
    return sorted(out, key=str)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "p", "u", 1, 2, "l") for r in rows], KIND)
    got = hard_negatives(frame, F.col("vec_id") % 10 == 0, **options)
    return sorted((tuple(r) for r in got.collect()), key=str)


def clustered(rnd, n, width=8, scale=100):
    centres = [[rnd.gauss(0, scale) for _ in range(width)] for _ in range(12)]
    rows = []
    for i in range(n):
        c = rnd.choice(centres)
        stretch = rnd.choice([0.1, 1, 1, 3])
        rows.append((i, [int(stretch * (x + rnd.gauss(0, scale / 5))) for x in c], rnd.randrange(4)))
    return rows


@pytest.mark.parametrize("sizes", [(2048, 512), (16, 3)])
@pytest.mark.parametrize("case", ["clusters", "ties", "wide"])
def test_against_all_pairs(spark, case, sizes, monkeypatch):
    rnd = random.Random(len(case))
    if case == "clusters":
        rows = clustered(rnd, 400)
    elif case == "ties":
        rows = [(i, [rnd.randrange(-1, 2) for _ in range(3)], rnd.randrange(3)) for i in range(300)]
    else:
        rows = [(i, [rnd.randrange(-(1 << 29), 1 << 29) for _ in range(4)], rnd.randrange(2)) for i in range(200)]
    rows += [(None, [1, 2, 3], 0), (900, None, 1), (910, [1, 2, 3], None), (920, [1, None, 2], 1), (930, [], 1), (940, [5], 2),
             (950, [0, 0, 0], 1), (0, rows[0][1], rows[0][2]), (0, rows[0][1], 3), (None, rows[10][1], rows[10][2])]
    monkeypatch.setattr(hn, "BUCKET", sizes[0])
    monkeypatch.setattr(hn, "BLOCK", sizes[1])
    for percent, k, m in (((80, 100), 5, 5), ((50, 120), 2, 3), ((80, 100), 1, 1)):
        got = run(spark, rows, positives=k, negatives=m, percent=percent)
        assert got == brute(rows, lambda i: i % 10 == 0, k, m, percent)
        assert got or case != "clusters"


def test_a_third_of_all_rows_are_copies(spark):
    rows = clustered(random.Random(5), 300)
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(200)]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0, 5, 5, (80, 100))


def test_nothing_to_mine(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1, 2], 0), (2, [1, 2], 1)]) == []  # no anchor
    assert run(spark, [(10, [1, 2], 0), (20, [1, 2], 1)]) == []  # no positive
    assert run(spark, [(10, [1, 2], 0), (11, [1, 2], 0), (12, [-1, -2], 1)]) == []  # no negative in the band
    assert run(spark, [(10, [-1, -2], 0), (11, [1, 2], 0), (12, [1, 2], 1)]) == []  # negative scores have an empty band


def test_products_beyond_doubles(spark):
    big = 1 << 30
    rows = [(10, [big, 1], 0), (11, [big, 3], 0), (12, [big, 2], 1), (13, [big, 3], 1), (14, [big, 4], 1)]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0, 5, 5, (80, 100))
    assert len(run(spark, rows)) == 2


def test_ranges_leave_few_to_verify():
    rnd = np.random.default_rng(1)
    centres = rnd.normal(0, 100, (64, 16))
    rows = (centres[rnd.integers(0, 64, 8192)] + rnd.normal(0, 4, (8192, 16))).astype(np.int16)
    rows = rows[np.argsort(-(rows.astype(float) ** 2).sum(axis=1))]
    shape = Shape(16, "<i2", True)
    buckets = [Bucket("x", np.arange(k, k + 2048), np.arange(k, k + 2048), rows[k : k + 2048]) for k in range(0, 8192, 2048)]
    for b in buckets:
        assert all((np.diff(b.sorted(f)[0]) >= 0).all() for f in range(16))
    anchors = shape.numbers(rows[:100])
    own = (anchors * anchors).sum(axis=1)
    low, high = np.floor(0.9 * own)[:, None], own[:, None]
    asking = Asking(anchors, np.arange(100), low, high, 5)
    for b in buckets:
        asking.meet(b, shape)
    scores = anchors @ shape.numbers(rows).T
    for i, _, s, ids, _ in asking.lists():
        fits = [(-x, j) for j, x in enumerate(scores[i].tolist()) if low[i, 0] <= x <= high[i, 0] and j != i]
        assert list(zip((-s).tolist(), ids.tolist(), strict=True)) == sorted(fits)[:5]
    assert 0 < asking.verified < 0.2 * anchors.shape[0] * len(rows)
