"""Hand-worked cases and brute-force comparisons of the operators."""

from __future__ import annotations

import hashlib
import math
import os
import random
import subprocess
import sys
import time
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from shoprec.functions import scalars
from shoprec.operators import accounts, content, cooccur, factors, pairs, ranking, realtime, serving, stats, vectors
from shoprec.plans.queries import QUERIES
from shoprec.schemas import USER, conform
from shoprec.session import stored
from shoprec.streaming import replay


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


# scalars


@pytest.mark.parametrize("seconds, month", [(1593561599, 202006), (1593561600, 202007), (0, 197001)])
def test_month_edge_is_utc(spark, seconds, month):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert value(spark, scalars.year_month(F.lit(seconds).cast("bigint"))) == month
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_milliseconds_become_seconds(spark):
    assert value(spark, scalars.epoch_seconds(F.lit(1593500000000))) == 1593500000
    assert value(spark, scalars.epoch_seconds(F.lit(1593500000))) == 1593500000


def test_rounding_halves_away_from_zero(spark):
    assert value(spark, scalars.rounded(F.lit(3 / 128))) == 0.023438
    assert value(spark, scalars.rounded(F.lit(-3 / 128))) == -0.023438
    assert value(spark, scalars.rounded(F.lit(0.0))) == 0.0


@pytest.mark.parametrize("name", ["", "a", "Customer#000000001", "富勒", "naïve", "😀 smile", "polygenelubricants"])
def test_name_id_wraps_like_32_bit(spark, name):
    h = 0
    data = name.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (31 * h + int.from_bytes(data[i : i + 2], "big")) & 0xFFFFFFFF
    assert value(spark, scalars.name_id(F.lit(name))) == (h - 2**32 if h >= 2**31 else h)


def test_cosine_of_zero_vector_is_null(spark):
    a, b = F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(0.0))
    assert value(spark, scalars.cosine(a, b)) is None
    assert value(spark, scalars.cosine(b, F.array(F.lit(1.0), F.lit(1.0)))) == pytest.approx(math.sqrt(0.5))


@pytest.mark.parametrize("tags, words", [("A|b C", ["a", "b", "c"]), ("a||b", ["a", "", "b"]), ("a|", ["a"])])
def test_tokens(spark, tags, words):
    assert value(spark, scalars.tokens(F.lit(tags))) == words


def test_half_score(spark):
    assert value(spark, scalars.half_score(F.lit(7.0))) == 3.5
    assert value(spark, scalars.half_score(F.lit(4.25))) == 2.13


def test_conform_names_missing_columns(spark):
    with pytest.raises(ValueError, match="username"):
        conform(spark.range(1).withColumnRenamed("id", "userId"), USER)


# statistics


def test_statistics(ratings):
    r = ratings((1, 10, 5.0, 1593561599), (2, 10, 2.0, 1593561600), (1, 11, 3.0, 1593561600))
    assert rows(stats.rate_more(r), "productId", "count") == [(10, 2), (11, 1)]
    assert rows(stats.average_score(r), "productId", "avg") == [(10, 3.5), (11, 3.0)]
    recent = stats.rate_recent(r)
    assert rows(recent, "yearMonth", "productId", "count") == [(202006, 10, 1), (202007, 10, 1), (202007, 11, 1)]
    assert [x["productId"] for x in stats.hot_products(recent, 2).collect()] == [10, 11]
    assert [x["productId"] for x in stats.top_rated(stats.rate_more(r), 1).collect()] == [10]


# ranking


def test_ties_go_to_the_smaller_id_and_nesting_keeps_order(spark):
    df = spark.createDataFrame([(1, 7, 0.5), (1, 3, 0.5), (1, 5, 0.9), (2, 1, 0.1)], "productId int, recProductId int, score double")
    top = ranking.top_k(df, "productId", "score", "recProductId", 2)
    assert rows(top, "productId", "rank", "recProductId") == [(1, 1, 5), (1, 2, 3), (2, 1, 1)]
    keys = spark.createDataFrame([(1,), (2,), (9,)], "productId int")
    nested = ranking.to_nested(top, "productId", keys=keys)
    assert {r["productId"]: [x["productId"] for x in r["recs"]] for r in nested.collect()} == {1: [5, 3], 2: [1], 9: []}
    assert rows(ranking.to_long(nested, "productId"), "productId", "rank", "recProductId", "score") == [
        (1, 1, 5, 0.9), (1, 2, 3, 0.5), (2, 1, 1, 0.1)
    ]


# co-rating


def brute_cooccurrence(data):
    counts, per_user = Counter(p for _, p in data), {}
    for u, p in data:
        per_user.setdefault(u, []).append(p)
    found = Counter((a, b) for items in per_user.values() for a in items for b in items if a != b)
    return {k: (n, counts[k[0]], counts[k[1]]) for k, n in found.items()}


@pytest.mark.parametrize("chunk", [2, 1000])
def test_cooccurrence_equals_plain_self_join_with_a_hot_user(ratings, monkeypatch, chunk):
    monkeypatch.setattr(pairs.pairs_within, "__defaults__", ((), None, None, chunk))
    rng = random.Random(chunk)
    data = [(0, p) for p in range(25)] + [(rng.randrange(1, 8), rng.randrange(30)) for _ in range(90)]
    got = cooccur.cooccurrence(ratings(*[(u, p, 1.0) for u, p in data])).collect()
    expected = brute_cooccurrence(data)
    assert len(got) == len(expected)
    for r in got:
        n, a, b = expected[r["product1"], r["product2"]]
        assert (r["cocount"], r["count1"], r["count2"]) == (n, a, b)
        assert r["sim"] == pytest.approx(n / math.sqrt(a * b), abs=1e-6)


@pytest.mark.parametrize("basket, pairs", [(3, 50), (1000, 7)])
def test_cooccurrence_over_many_blocks_and_split_baskets(ratings, basket, pairs):
    rng = random.Random(basket)
    data = [(0, p) for p in range(-5, 25)] + [(rng.randrange(1, 8), rng.randrange(30)) for _ in range(90)]
    got = cooccur.counts(ratings(*[(u, p, 1.0) for u, p in data]), basket=basket, pairs=pairs).collect()
    expected = brute_cooccurrence(data)
    assert len(got) == len(expected)
    assert {(r["product1"], r["product2"]): (r["cocount"], r["count1"], r["count2"]) for r in got} == expected


def test_pairs_are_counted_without_an_exchange_of_pairs(ratings):
    """A user of n products has n * n pairs; only the baskets and the best of each product are moved."""
    plan = cooccur.cooccurrence(ratings(*[(1, p, 1.0) for p in range(40)]))._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Exchange")]
    assert "MapInArrow" in above and "Aggregate" not in above and "SortMergeJoin" not in plan


def test_lists_counted_in_rounds_equal_lists_counted_at_once(ratings, monkeypatch):
    rng = random.Random(5)
    data = [(0, p) for p in range(-5, 25)] + [(rng.randrange(1, 8), rng.randrange(30)) for _ in range(90)]
    r = ratings(*[(u, p, 1.0) for u, p in data])
    expected = rows(cooccur.counts(r, 4), "product1", "product2", "cocount", "count1", "count2")
    made = []
    monkeypatch.setattr(cooccur, "ROUND", 300)
    monkeypatch.setattr(cooccur, "stored", lambda df, name: made.append(name) or stored(df, name))
    for basket in (3, 1000):
        made.clear()
        assert rows(cooccur.counts(r, 4, basket, 40), "product1", "product2", "cocount", "count1", "count2") == expected
        assert made.count("co-rated") > 2


def test_baskets_are_dealt_in_few_bytes_and_leave_no_shuffle_files(spark, ratings):
    rng = random.Random(6)
    data = [(u, p) for u in range(300) for p in rng.sample(range(50_000), 40)]
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().shuffleManager().shuffleBlockResolver()
    before = held.getStoredShuffles().size()
    baskets = cooccur._baskets(ratings(*[(u, p, 1.0) for u, p in data]), 1024)
    assert held.getStoredShuffles().size() <= before

    def dealt(half):
        rows = cooccur._packed(baskets, 100, True, half)
        return rows.agg(F.sum(F.length("theirs")), F.count(F.lit(1))).first()

    copies = 40 * len({(u, (p * 2654435761 % 2**32 >> 8) % 100) for u, p in data})
    whole, half = dealt(False), dealt(True)
    assert whole[0] < 4 * copies  # of 12 bytes, and one row for many baskets
    assert half[0] < 0.65 * whole[0] and whole[1] < 300 * 10


def test_duplicate_ratings_weigh_in(ratings):
    r = ratings((1, 10, 5.0), (1, 10, 5.0), (1, 11, 3.0), (2, 11, 4.0))
    assert rows(cooccur.cooccurrence(r), "product1", "product2", "cocount", "count1", "count2") == [
        (10, 11, 2, 2, 2), (11, 10, 2, 2, 2)
    ]


def test_lonely_item_keeps_an_empty_list(ratings):
    r = ratings((1, 10, 5.0), (1, 11, 3.0), (2, 12, 4.0))
    nested = ranking.to_nested(cooccur.item_cf(r), "productId", keys=r)
    assert {x["productId"]: [y["productId"] for y in x["recs"]] for x in nested.collect()} == {10: [11], 11: [10], 12: []}


def test_equal_similarities_are_cut_by_id(ratings):
    r = ratings(*[(1, p, 1.0) for p in (40, 30, 20, 10)])
    assert rows(cooccur.item_cf(r, k=2).where("productId = 40"), "rank", "recProductId") == [(1, 10), (2, 20)]


# similarity by content and by vectors


def brute_lists(sims, ids, k, min_sim):
    out = []
    for i, a in enumerate(ids):
        found = sorted((-round(sims[i][j], 6), b) for j, b in enumerate(ids) if a != b and round(sims[i][j], 6) > min_sim)
        out += [(a, r, b, -s) for r, (s, b) in enumerate(found[:k] if k else found, 1)]
    return sorted(out)


def tag_sims(tags, bucket=None):
    bags = [Counter(map(bucket or str, t.lower().replace("|", " ").split(" "))) for t in tags]
    df = Counter(t for b in bags for t in b)
    weights = [{t: n * math.log((len(bags) + 1) / (df[t] + 1)) for t, n in b.items()} for b in bags]
    norms = [math.sqrt(sum(w * w for w in x.values())) for x in weights]
    return [
        [sum(w * y.get(t, 0) for t, w in x.items()) / (nx * ny) if nx and ny else 0 for y, ny in zip(weights, norms)]
        for x, nx in zip(weights, norms)
    ]


def make_products(spark, tags):
    data = [(i, f"p{i}", "", "", t) for i, t in enumerate(tags)]
    return spark.createDataFrame(data, "productId int, name string, imageUrl string, categories string, tags string")


def skewed_tags(seed, n):
    """A third are copies of one another, every product has the frequent word."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(14)]
    tags = ["common|copy"] * (n // 3)
    tags += ["|".join(["common", *rng.choices(words, k=rng.randrange(1, 5))]) for _ in range(n - len(tags))]
    rng.shuffle(tags)
    return tags


@pytest.mark.parametrize("k", [None, 3])
def test_content_equals_pairwise_cosine(spark, monkeypatch, k):
    monkeypatch.setattr(pairs.pairs_within, "__defaults__", ((), None, None, 4))
    monkeypatch.setattr("shoprec.operators.copies.CHUNK", 5)
    tags = skewed_tags(1, 60)
    got = content.content_sim(make_products(spark, tags), k=k)
    expected = brute_lists(tag_sims(tags), range(60), k, 0.4)
    if k is None:
        got = ranking.top_k(got, "productId", "score", "recProductId")
    assert rows(got, "productId", "rank", "recProductId", "score") == expected


def test_content_classes_hold_all_pairs_without_writing_out_copies(spark, monkeypatch):
    monkeypatch.setattr(pairs.pairs_within, "__defaults__", ((), None, None, 4))
    tags = [*skewed_tags(9, 60), *["|".join(reversed(t.split("|"))) for t in skewed_tags(9, 60)], *["common"] * 3]
    products = make_products(spark, tags)
    found = content.content_sim(products, classes=True).collect()
    alike = {(r["productId"], r["recProductId"]): r["score"] for r in found if r["kind"] == "pair"}
    of = {r["productId"]: r["recProductId"] for r in found if r["kind"] == "member"}
    bags = ["|".join(sorted(t.split("|"))) for t in tags]
    assert all(of[p] == bags.index(bags[p]) for p in of)
    assert len(found) == len(of) + len(alike) and {p for x in alike for p in x} <= set(of.values())
    got = sorted(
        (a, b, 1.0 if of[a] == of[b] else alike[of[a], of[b]])
        for a in of for b in of if a != b and (of[a] == of[b] or (of[a], of[b]) in alike)
    )
    assert got == rows(content.content_sim(products), "productId", "recProductId", "score")
    assert len(found) < len(got) / 2


def test_content_query_writes_out_the_pairs_of_copies(spark, tmp_path):
    kinds = [("almond red", "B1", "STEEL"), ("almond red", "B1", "STEEL"), ("red almond", "B1", "STEEL"), ("blue lace", "B2", "TIN"),
             ("blue mint", "B2", "TIN"), ("rose", "B3", "NICKEL")]
    parts = spark.createDataFrame([(i, *k) for i, k in enumerate(kinds)], "p_partkey bigint, p_name string, p_brand string, p_type string")
    parts.write.parquet(f"{tmp_path}/part.parquet")
    tags = ["|".join([*name.split(" "), brand, kind]) for name, brand, kind in kinds]
    found = ranking.top_k(QUERIES["content_sim"](spark, str(tmp_path)), "productId", "score", "recProductId")
    assert rows(found, "productId", "rank", "recProductId", "score") == brute_lists(tag_sims(tags), range(6), None, 0.4)
    assert found.where("productId < 3 and recProductId < 3 and score = 1").count() == 6


def test_hashed_content_equals_pairwise_cosine_over_buckets(spark):
    tags = skewed_tags(2, 40)
    words = sorted({w for t in tags for w in t.split("|")})
    buckets = {w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 7 for w in words}
    got = content.content_sim(make_products(spark, tags), k=4, mode="hashed", buckets=7)
    expected = brute_lists(tag_sims(tags, buckets.__getitem__), range(40), 4, 0.4)
    assert rows(got, "productId", "rank", "recProductId", "score") == expected


def test_similarities_of_some_products_and_pairs(spark, monkeypatch):
    monkeypatch.setattr(pairs.pairs_within, "__defaults__", ((), None, None, 4))
    tags = skewed_tags(4, 60)
    products = make_products(spark, tags)
    every = rows(content.content_sim(products), "productId", "recProductId", "score")
    some = content.TagSimilarities(products)
    asked = products.where("productId % 7 = 1").select("productId")
    found = rows(some.of(asked), "productId", "recProductId", "score")
    assert found == [r for r in every if r[0] % 7 == 1]
    wanted = spark.range(60).selectExpr("cast(id AS int) AS productId").crossJoin(
        spark.range(0, 60, 3).selectExpr("cast(id AS int) AS recProductId"))
    assert rows(some.between(wanted), "productId", "recProductId", "score") == [r for r in every if r[1] % 3 == 0]


def test_products_whose_words_are_in_all_have_no_similarity(spark):
    assert content.content_sim(make_products(spark, ["same"] * 5)).count() == 0


def make_vectors(spark, data):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id int, features array<double>")


@pytest.mark.parametrize("k, block", [(None, 2000), (None, 16), (3, 16), (3, 2000), (30, 16)])
def test_vector_similarity_equals_all_pairs(spark, k, block):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(120, 4)) + 0.8
    data[:40] = data[0]  # a third are copies
    data[50] = 0.0
    norms = np.linalg.norm(data, axis=1, keepdims=True)
    unit = np.divide(data, norms, out=np.zeros_like(data), where=norms > 0)
    got = vectors.cosine_sim(make_vectors(spark, data), k=k, block=block)
    if k is None:
        got = ranking.top_k(got, "productId", "score", "recProductId")
    got = rows(got, "productId", "rank", "recProductId", "score")
    expected = brute_lists(unit @ unit.T, range(120), k, 0.4)
    assert [x[:3] for x in got] == [x[:3] for x in expected]
    assert [x[3] for x in got] == pytest.approx([x[3] for x in expected], abs=2e-6)


def test_vector_frames_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SLICE", 7)
    monkeypatch.setattr(vectors, "FRAME", 5)
    data = np.random.default_rng(6).normal(size=(90, 3))
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    got = rows(vectors.cosine_sim(make_vectors(spark, data), k=4, block=10), "productId", "rank", "recProductId", "score")
    assert [x[:3] for x in got] == [x[:3] for x in brute_lists(unit @ unit.T, range(90), 4, 0.4)]


def test_zero_vectors_only(spark):
    assert vectors.cosine_sim(make_vectors(spark, np.zeros((3, 2)))).count() == 0


# factor model


@pytest.fixture(scope="module")
def taste(spark):
    """Two groups of users and products; scores are high inside a group."""
    rng = random.Random(3)
    data = [(u, p, 5.0 if u % 2 == p % 2 else 1.0, u * 100 + p) for u in range(40) for p in range(30) if rng.random() < 0.6]
    return spark.createDataFrame(data, "userId int, productId int, score double, timestamp bigint")


def test_model_is_repeatable_and_finds_the_groups(taste):
    first, second = factors.fit(taste), factors.fit(taste)
    assert rows(first.itemFactors, "id", "features") == rows(second.itemFactors, "id", "features")
    top = factors.user_recs(first, k=5)
    assert top.groupBy("userId").count().where("count <> 5").count() == 0
    assert top.where("userId % 2 <> recProductId % 2").count() == 0
    sim = factors.item_sim(first, k=3)
    assert sim.where("productId % 2 <> recProductId % 2").count() == 0


def test_fitted_users_solve_the_normal_equations(taste):
    model = factors.fit(taste)
    fitted = factors.normal_equations(model, taste)
    assert fitted.count() == 40 and fitted.where("miss > 0.001").count() == 0
    other = factors.normal_equations(model, taste.withColumn("score", 6 - F.col("score")))
    assert other.where("miss < 0.1").count() == 0


def test_split_is_a_partition_and_depends_on_the_seed(taste):
    train, test = factors.split(taste)
    assert train.count() + test.count() == taste.count()
    assert train.intersect(test).count() == 0
    assert 0.7 < train.count() / taste.count() < 0.9
    again, _ = factors.split(taste.repartition(5))
    assert rows(train, "userId", "productId") == rows(again, "userId", "productId")
    other, _ = factors.split(taste, seed=7)
    assert rows(train, "userId", "productId") != rows(other, "userId", "productId")


def test_rmse(spark):
    pairs = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "score double, prediction double")
    assert factors.rmse(pairs).first()["rmse"] == pytest.approx(math.sqrt(2.5), abs=1e-6)


def test_grid(taste):
    results = factors.grid_search(taste, ranks=(2, 3), regs=(0.1, 0.01), iterations=3)
    found = results.collect()
    assert {(r["rank"], r["lambda"]) for r in found} == {(a, b) for a in (2, 3) for b in (0.1, 0.01)}
    assert factors.best(results).first() == min(found, key=lambda r: (r["rmse"], r["rank"], r["lambda"]))


def test_grid_tasks_are_bounded_by_blocks_and_large_fits_run_alone(taste, monkeypatch):
    n = factors.split(taste)[0].count()
    monkeypatch.setattr(factors, "TASK_BYTES", n)  # a quarter of a float for each rating
    monkeypatch.setattr(factors, "SIDE_BYTES", 1)
    made, running, make = [], [], factors._estimator

    def estimator(*a, **k):
        als = make(*a, **k)
        running.append(als)
        assert len(running) == 1
        made.append((als.getRank(), als.getNumUserBlocks(), als.getNumItemBlocks()))
        return als

    monkeypatch.setattr(factors, "_estimator", estimator)
    monkeypatch.setattr(factors, "_drop_files", lambda spark: running.clear())
    results = factors.grid_search(taste, ranks=(2, 5), regs=(0.1,), iterations=3).collect()
    assert sorted(made) == [(2, 10, 10), (5, 20, 20)]
    assert sorted((r["rank"], r["lambda"]) for r in results) == [(2, 0.1), (5, 0.1)] and all(r["rmse"] < 1.5 for r in results)
    assert factors.grid_blocks(10 * factors.TASK_RATINGS + 1, 0) == 11


def test_grid_leaves_no_shuffle_files(spark, taste):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        names = [name.rsplit("/", 1)[-1] for name in disk.getAllFiles().mkString("\n").split("\n")]
        return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}

    before = files()
    factors.grid_search(taste, ranks=(2, 3), regs=(0.1,), iterations=3).collect()
    until = time.time() + 20
    while len(files() - before) > 150 and time.time() < until:
        time.sleep(0.5)
    assert len(files() - before) <= 150  # 208 while all files of the fits stay


# live recommendations


def make_sims(spark, *data):
    return spark.createDataFrame(data, "productId int, recProductId int, score double")


def test_score_formula(spark, ratings):
    cands = spark.createDataFrame([(1, 9)], "userId int, candidate int")
    sims = make_sims(spark, (9, 1, 0.5), (9, 2, 0.8), (9, 4, 0.3))
    recent = ratings((1, 1, 5.0), (1, 2, 2.0), (1, 4, 4.0))
    assert rows(realtime.score_candidates(cands, recent, sims), "recProductId", "score") == [(9, 2.05)]


def test_score_logs(spark, ratings):
    cands = spark.createDataFrame([(1, 9)], "userId int, candidate int")
    sims = make_sims(spark, (9, 1, 0.5), (9, 2, 0.5), (9, 4, 0.5))
    recent = ratings((1, 1, 5.0), (1, 2, 4.0), (1, 4, 1.0))
    assert rows(realtime.score_candidates(cands, recent, sims), "score") == [(1.967697,)]


def test_lookup_goes_from_candidate_to_rated(spark, ratings):
    cands = spark.createDataFrame([(1, 9)], "userId int, candidate int")
    assert realtime.score_candidates(cands, ratings((1, 1, 5.0)), make_sims(spark, (1, 9, 0.9))).count() == 0


@pytest.mark.parametrize("ranked", [False, True])
def test_candidates_leave_out_rated_products(spark, ratings, ranked):
    sims = make_sims(spark, *[(1, p, 0.9 - p / 100) for p in range(2, 12)])
    if ranked:
        sims = ranking.top_k(sims, "productId", "score", "recProductId")
    history = ratings((1, 1, 5.0), (1, 2, 1.0), (1, 4, 1.0), (2, 1, 1.0))
    events = ratings((1, 1, 5.0), (2, 1, 1.0), (3, 77, 4.0))
    got = realtime.candidates(events, sims, history, k=3)
    assert rows(got, "userId", "rank", "candidate") == [
        (1, 1, 3), (1, 2, 5), (1, 3, 6), (2, 1, 2), (2, 2, 3), (2, 3, 4)
    ]


def test_unknown_item_gives_no_row_and_no_match_an_empty_list(spark, ratings):
    sims = make_sims(spark, (1, 2, 0.9))
    events = ratings((1, 1, 5.0, 5), (2, 77, 5.0, 5))
    got = realtime.score_events(events, events, sims, events).collect()
    assert [(r["userId"], r["recs"]) for r in got] == [(1, [])]


def test_only_the_newest_event_of_a_user_is_scored(spark, ratings):
    sims = make_sims(spark, (1, 2, 0.9), (5, 6, 0.9), (6, 5, 0.8))
    events = ratings((1, 1, 5.0, 5), (1, 5, 5.0, 6))
    got = realtime.score_events(events, events, sims, events).first()
    assert [(x["productId"], x["score"]) for x in got["recs"]] == [(6, 4.0)]


def test_upsert_with_nulls_and_one_shuffle_of_the_table(ratings):
    events = ratings((1, 10, 5.0, 100), (None, 10, 2.0, 90), (3, 30, 4.0, 80))
    old = ratings((1, 10, 1.0, 7), (1, 10, 2.0, 6), (None, 10, 1.0, 5), (1, None, 3.0, 4), (2, 20, 1.0, 3), (2, 20, 1.0, 3))
    got = realtime.upsert_ratings(events, old)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted([
        (1, 10, 5.0, 6), (None, 10, 2.0, 90), (3, 30, 4.0, 80), (None, 10, 1.0, 5), (1, None, 3.0, 4), (2, 20, 1.0, 3), (2, 20, 1.0, 3),
    ], key=key)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_history_is_the_difference_of_bags(spark):
    kind = "userId int, productId int, score double, timestamp bigint, orderkey bigint, linenumber int"
    rng = random.Random(4)
    rows_ = [(rng.choice([None, 1, 2, 3]), rng.randrange(3), 1.0, rng.choice([None, 5, 6]), 1, 1) for _ in range(60)]
    ratings = spark.createDataFrame(rows_, kind)
    for n in (1, 3):
        events, history = replay.live_and_history(ratings, n)
        assert Counter(history.collect()) == Counter(ratings.exceptAll(events.drop("seq")).collect())
        assert "Aggregate" not in history._jdf.queryExecution().executedPlan().toString()


def test_scores_by_meeting_rows_equal_scores_by_pairs(spark, ratings):
    words = ["a|b|c", "a|b|d", "a|b|c", "d|e", "a|e|f", "b|c|d", "x"]
    sims = content.TagSimilarities(make_products(spark, words), min_sim=0.1)
    cands = spark.createDataFrame([(u, p) for u in (1, 2) for p in range(7)], "userId int, candidate int")
    recent = ratings(*[(u, p, float(1 + (u + p) % 5)) for u in (1, 2, 3) for p in range(0, 7, u)])

    class Pairs:
        between = sims.between

    columns = ("userId", "recProductId", "score", "rank")
    got = realtime.score_candidates(cands, recent, sims, 0.2)
    assert rows(got, *columns) == rows(realtime.score_candidates(cands, recent, Pairs(), 0.2), *columns)
    assert got.count() > 6


def test_meeting_rows_keep_repeats_and_columns_and_are_scored_by_matrices(spark):
    sims = content.TagSimilarities(make_products(spark, ["a|b", "a|b", "a|c", "d", "e|f|a", "b"]))
    left = spark.createDataFrame([(1, 0, "x"), (1, 0, "x"), (2, 2, "y"), (None, 0, "z"), (3, None, "w"), (4, 9, "v")], "userId int, candidate int, note string")
    right = spark.createDataFrame([(1, 1, 5.0), (1, 1, 5.0), (1, 0, 4.0), (1, 2, 3.0), (2, 0, None), (2, 3, 1.0), (None, 1, 2.0)], "userId int, _rated int, _score double")
    met = sims.meet(left, right, "userId", "candidate", "_rated")
    assert met.columns == ["userId", "candidate", "note", "_rated", "_score", "_sim"]
    alike = {(r["productId"], r["recProductId"]): r["score"] for r in sims.of(spark.range(6).select(F.col("id").cast("int").alias("productId"))).collect()}
    expected = [
        (*x, *y[1:], alike[x[1], y[1]])
        for x in left.collect() for y in right.collect()
        if x[0] is not None and x[0] == y[0] and (x[1], y[1]) in alike
    ]
    assert Counter(map(tuple, met.collect())) == Counter(expected) and (1, 0, "x", 1, 5.0, 1.0) in expected
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "element_at" not in plan


def test_replay_holds_few_shuffles_and_makes_the_history_once(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    orders = [(o, o % 6, f"2020-01-{1 + o % 28:02d}") for o in range(40)]
    lines = [(o, rng.randrange(60), n, float(rng.randrange(1, 50))) for o in range(40) for n in range(3)]
    tables = {
        "orders": spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, d string").selectExpr("o_orderkey", "o_custkey", "cast(d as timestamp) o_orderdate"),
        "lineitem": spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double"),
        "part": spark.createDataFrame([(p, f"w{p % 3} v{p % 2}", "B", f"T{p % 4}") for p in range(60)], "p_partkey bigint, p_name string, p_brand string, p_type string"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().shuffleManager().shuffleBlockResolver()
    made, create = [], replay.State.create

    def written(self, sims, ratings, queue):
        made.append(ratings._jdf.queryExecution().executedPlan().toString())
        return create(self, sims, ratings, queue)

    monkeypatch.setattr(replay.State, "create", written)
    before = held.getStoredShuffles().size()
    state, _ = replay.run(spark, str(tmp_path), buckets=2)
    until = time.time() + 20
    while held.getStoredShuffles().size() - before > 30 and time.time() < until:
        time.sleep(0.5)
    assert held.getStoredShuffles().size() - before <= 30  # 80 while they wait for the driver's garbage
    assert len(made) == 1 and "Exchange" not in made[0] and "Window" not in made[0]
    wanted = rows(QUERIES["stream_scores"](spark, str(tmp_path)), "userId", "entries")
    assert rows(state.recs(spark), "userId", F.size("recs")) == wanted and len(wanted) > 3


def test_queue_keeps_40_and_repeats(ratings):
    old = ratings(*[(1, i, 3.0, i) for i in range(41)])
    queue = realtime.push_recent(ratings((1, 40, 5.0, 99)), old)
    assert queue.count() == 40
    assert rows(queue.where("productId = 40"), "seq", "score") == [(1, 5.0), (2, 3.0)]
    assert ranking.latest_n(queue.drop("seq"), realtime.RECENT).count() == 21


def test_upsert_keeps_the_first_time_and_other_rows(ratings):
    base = ratings((1, 10, 1.0, 100), (1, 11, 2.0, 101), (2, 10, 3.0, 102), (2, 10, 3.0, 102))
    events = ratings((1, 10, 4.0, 900), (1, 10, 5.0, 901), (3, 12, 2.0, 902))
    got, queue = realtime.apply_ratings(events, base, base.where("false"))
    assert rows(got, "userId", "productId", "score", "timestamp") == [
        (1, 10, 5.0, 100), (1, 11, 2.0, 101), (2, 10, 3.0, 102), (2, 10, 3.0, 102), (3, 12, 2.0, 902)
    ]
    assert rows(queue, "userId", "seq", "score") == [(1, 1, 5.0), (1, 2, 4.0), (3, 1, 2.0)]


# lookups and accounts


def test_serving(spark, ratings):
    products = make_products(spark, ["a", "b", "c"])
    avg = stats.average_score(ratings((1, 0, 4.0), (2, 0, 5.0)))
    recs = spark.createDataFrame([(7, 1, 0.9, 1), (7, 0, 0.8, 2), (7, 99, 0.7, 3), (8, 2, 0.6, 1)], "userId int, recProductId int, score double, rank int")
    keys = spark.createDataFrame([(7,), (9,)], "userId int")
    found = serving.hydrate(serving.recs_for(keys, recs, "userId"), products, avg)
    assert rows(found, "userId", "rank", "recProductId", "name", "avg") == [(7, 1, 1, "p1", 0.0), (7, 2, 0, "p0", 4.5)]
    assert serving.recs_for(keys, recs, "userId", num=1).count() == 1
    assert rows(serving.search(products, avg, "[01]$"), "productId", "avg") == [(0, 4.5), (1, 0.0)]
    ids = spark.createDataFrame([(2,), (2,), (50,)], "productId int")
    assert rows(serving.products_by_id(ids, products, avg), "productId", "avg") == [(2, 0.0)]


def make_users(spark, *data):
    return spark.createDataFrame([(i, n, f, 0, g) for i, n, f, g in data], USER)


def test_register_gives_a_name_once_and_keeps_taken_ones(spark):
    users = make_users(spark, (1, "ann", False, []))
    names = spark.createDataFrame([("ann",), ("bob",), ("bob",), (None,)], "username string")
    assert rows(accounts.register(names, users, 5), "userId", "username", "first", "timestamp") == [(98 * 31**2 + 111 * 31 + 98, "bob", True, 5)]


def test_preferences_take_the_last_change(spark):
    users = make_users(spark, (1, "ann", True, ["x"]), (2, "bob", True, []))
    changes = spark.createDataFrame([(1, False, ["a"], 1), (1, False, ["b"], 2), (9, True, [], 1)], "userId int, first boolean, prefGenres array<string>, seq int")
    assert rows(accounts.update_preferences(changes, users), "userId", "first", "prefGenres") == [(1, False, ["b"]), (2, True, [])]


def test_resolve_users(spark):
    users = make_users(spark, (1, "ann", True, []), (2, "bob", True, []))
    names = spark.createDataFrame([("bob",), ("eve",)], "username string")
    assert rows(serving.resolve_users(names, users), "username", "userId") == [("bob", 2)]
    assert rows(serving.users_by_name(names, users), "userId") == [(2,)]


@pytest.mark.parametrize("make", [lambda: vectors._matcher(0.4, 3), lambda: vectors._angles_to(np.eye(2))])
def test_worker_functions_need_no_package_on_the_worker(make):
    load = "import pickle, sys; pickle.load(sys.stdin.buffer); assert 'shoprec' not in sys.modules"
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", load], input=cloudpickle.dumps(make()), cwd="/", env=environment, check=True)


def test_a_vector_goes_once_to_a_shelf(spark, monkeypatch):
    """Without clusters every cell may hold a match; a vector is sent to the few shelves, not to the cells."""
    monkeypatch.setattr(vectors, "SIDE", 60)
    data = np.random.default_rng(8).normal(size=(240, 16))
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    seen = []
    visits = vectors._visits
    monkeypatch.setattr(vectors, "_visits", lambda *x: seen.append(visits(*x)) or seen[-1])
    got = rows(vectors.cosine_sim(make_vectors(spark, data), k=3, min_sim=0.1, block=10), "productId", "rank", "recProductId", "score")
    assert [x[:3] for x in got] == [x[:3] for x in brute_lists(unit @ unit.T, range(240), 3, 0.1)]
    most = seen[0].groupBy("sig").count().agg(F.max("count")).first()[0]
    assert most <= 2 * 240 // 30  # of 96 cells

    cells = [{"cell": c, "radius": 1.0, "n": n} for c, n in ((0, 5), (1, 5), (3, 130), (4, 50))]
    _, first, parts, side = vectors._shelves(cells, 60)
    assert side == 60 and first.tolist() == [0, 0, 0, 1, 4] and parts.tolist() == [1, 1, 0, 3, 1]
