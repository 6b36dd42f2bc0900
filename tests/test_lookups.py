"""Messages by position, queues in stream state, JSON documents, folded factors, search by trigrams."""

import random
import re
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoprec.operators import factors, ranking, realtime, search, serving
from shoprec.schemas import RATING
from shoprec.sources import text, topic
from shoprec.sources.tables import save_bucketed
from shoprec.streaming import queues

ONCE = {"availableNow": True}


def put(spark, folder, first, *values):
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, place int")
    return topic.publish(rows.repartition(3), folder, first)


def take(spark, folder, progress, start):
    out = []
    stream = topic.read_messages(spark, folder, start)
    query = stream.writeStream.foreachBatch(lambda df, _: out.extend((r["offset"], r["value"]) for r in df.collect()))
    query.option("checkpointLocation", progress).trigger(**ONCE).start().awaitTermination()
    return sorted(out)


def test_messages_from_any_position(spark, tmp_path):
    folder = str(tmp_path / "topic")
    assert put(spark, folder, 0, "a", "b|1", "c\nd", None, "é") == 5
    every = [(0, "a"), (1, "b|1"), (2, "c d"), (3, ""), (4, "é")]
    assert take(spark, folder, str(tmp_path / "all"), "earliest") == every
    assert take(spark, folder, str(tmp_path / "some"), 3) == every[3:]
    assert take(spark, folder, str(tmp_path / "new"), "latest") == []
    assert put(spark, folder, 5, "x", "y") == 7
    # A stream goes on from its checkpoint, whatever start is asked for.
    late = [(5, "x"), (6, "y")]
    for name, start in (("all", "earliest"), ("some", "earliest"), ("new", "latest")):
        assert take(spark, folder, str(tmp_path / name), start) == late
        assert take(spark, folder, str(tmp_path / name), start) == []
    assert take(spark, str(tmp_path / "none"), str(tmp_path / "p"), "earliest") == []


def test_queues_of_a_stream_equal_those_of_the_batch(spark, tmp_path):
    rnd = random.Random(1)
    kind = "userId int, productId int, score double, timestamp bigint, place bigint"
    rows = [(rnd.randrange(5), rnd.randrange(30), float(rnd.randrange(1, 6)), rnd.randrange(60), i) for i in range(150)]
    rows += [(9, 1, 2.0, 5, i) for i in range(200, 260)]  # equal times, more than a queue holds
    parts = [rows[:70], rows[70:120], rows[120:]]
    (tmp_path / "in").mkdir()
    events = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")

    def log(df, batch):
        df.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{tmp_path}/log/part={batch}")

    def go(history=None):
        queues.start_recent_queues(events, str(tmp_path / "progress"), log, history, cap=10, trigger=ONCE).awaitTermination()

    frame = lambda some: spark.createDataFrame(some, kind).coalesce(1)
    history = frame(parts[0])
    frame(parts[1]).write.parquet(f"{tmp_path}/in/{uuid.uuid4()}")
    go(history)
    frame(parts[2]).write.parquet(f"{tmp_path}/in/{uuid.uuid4()}")
    go(history)  # a new start from the checkpoint, which does not read the history again
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    got = queues.newest_queues(spark.read.parquet(f"{tmp_path}/log")).select("userId", "seq", "productId", "score", "timestamp")
    touched = {r[0] for p in parts[1:] for r in p}
    wanted = ranking.latest_n(frame(rows), 10, order=("timestamp", "place", "productId", "score")).where(F.col("userId").isin(list(touched)))
    assert sorted(got.collect()) == sorted(wanted.select("userId", "seq", "productId", "score", "timestamp").collect())


@pytest.mark.parametrize("keys", [1, 3])
def test_users_who_share_a_key_keep_their_own_queues(spark, tmp_path, keys):
    kind = "userId int, productId int, score double, timestamp bigint, place bigint"
    rnd = random.Random(keys)
    rows = [(rnd.randrange(7), rnd.randrange(30), 1.0, rnd.randrange(60), i) for i in range(200)]
    frame = lambda some: spark.createDataFrame(some, kind).coalesce(1)
    frame([r for r in rows[150:] if r[0] != 3]).write.parquet(f"{tmp_path}/in/1")
    events = spark.readStream.schema(kind).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")

    def log(df, batch):
        df.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{tmp_path}/log/part={batch}")

    queues.start_recent_queues(
        events, str(tmp_path / "progress"), log, frame(rows[:150]), cap=10, trigger=ONCE, keys=keys
    ).awaitTermination()
    got = queues.newest_queues(spark.read.parquet(f"{tmp_path}/log")).select("userId", "seq", "productId", "timestamp")
    touched = {r[0] for r in rows[150:] if r[0] != 3}
    used = [r for i, r in enumerate(rows) if i < 150 or r[0] != 3]
    wanted = ranking.latest_n(frame(used), 10, order=("timestamp", "place", "productId", "score")).where(F.col("userId").isin(list(touched)))
    assert sorted(got.collect()) == sorted(wanted.select("userId", "seq", "productId", "timestamp").collect())


def test_documents_there_and_back(spark, ratings):
    rows = ratings((1, 2, 3.5, 10), (2, 3, 1.0, 20))
    good, bad = text.parse_documents(text.to_documents(rows).withColumn("at", F.lit(7)), RATING)
    assert sorted(map(tuple, good.collect())) == [(7, 1, 2, 3.5, 10), (7, 2, 3, 1.0, 20)] and bad.count() == 0
    texts = ['{"userId":1,"productId":2,"score":3.0,"timestamp":4', "", None, "junk", "[1]", '{"userId":"x","productId":2,"score":1,"timestamp":1}',
             '{"productId":1,"userId":5,"timestamp":9,"score":2,"more":{"a":1}}']
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    good, bad = text.parse_documents(lines, RATING)
    assert [tuple(r) for r in good.collect()] == [(5, 1, 2.0, 9)]
    assert sorted(r["value"] or "" for r in bad.collect()) == sorted(t or "" for t in texts[:-1])


def test_folded_factors(spark, ratings, tmp_path):
    rnd = random.Random(2)
    rows = [(u, rnd.randrange(40), float(rnd.randrange(1, 6))) for u in range(30) for _ in range(8)]
    model = factors.fit(ratings(*rows), rank=3)
    factors.save(model, str(tmp_path / "model"))
    factors.save(model, str(tmp_path / "model"))
    again = factors.load(str(tmp_path / "model"))
    items = {r["id"]: np.array(r["features"], float) for r in again.itemFactors.collect()}
    assert items.keys() == {r["id"] for r in model.itemFactors.collect()}
    fresh = [(100, p, float(p % 5 + 1)) for p in list(items)[:6]] + [(100, 9999, 5.0), (101, 9999, 1.0), (1, list(items)[0], 5.0)]
    got = {r["id"]: r for r in factors.fold_in(again.itemFactors, ratings(*fresh)).collect()}
    assert set(got) == {100, 1} and got[100]["ratings"] == 6
    for user, row in got.items():
        own = [(items[p], s) for u, p, s in fresh if u == user and p in items]
        left = sum(np.outer(v, v) for v, _ in own) + factors.REG * len(own) * np.eye(3)
        assert np.allclose(left @ np.array(row["features"]), sum(v * s for v, s in own))
    lists = factors.fold_in_recs(again, ratings(*fresh), 4).collect()
    u = np.array(got[100]["features"])
    best = sorted(((-round(float(u @ v), 6), p) for p, v in items.items() if u @ v > 0))[:4]
    assert [(r["recProductId"], r["rank"]) for r in sorted(lists, key=lambda r: r["rank"]) if r["userId"] == 100] == [(p, i) for i, (_, p) in enumerate(best, 1)]


@pytest.mark.parametrize(("pattern", "ways"), [
    ("spring", [{"spr", "pri", "rin", "ing"}]),
    ("ring|blue", [{"rin", "ing"}, {"blu", "lue"}]),
    ("ring|ge[a-z]r", None),
    ("lemon.*(green|blue)", [{"lem", "emo", "mon"}]),
    ("colou?r", [{"col", "olo"}]),
    ("abc{2}def", [{"def"}]),
    ("abcd+", [{"abc"}]),
    ("(spring)", None),
    (r"hot\.dog", [{"hot", "dog"}]),
    ("[abc]def", [{"def"}]),
    ("(?i)spring", None),
    ("^spring$", [{"spr", "pri", "rin", "ing"}]),
])
def test_grams_an_expression_needs(pattern, ways):
    assert search.needed(pattern) == ways


def test_indexed_search_finds_what_the_expression_finds(spark, tmp_path):
    rnd = random.Random(3)
    words = ["spring", "blue", "lemon", "green", "hot", "é", "gear", "ring"]
    names = [" ".join(rnd.sample(words, rnd.randrange(1, 5))) for _ in range(200)] + ["", "ab", None, "hot.dog", "ringring"]
    products = spark.createDataFrame([(i, n, "u", "c", "t") for i, n in enumerate(names)],
                                     "productId int, name string, imageUrl string, categories string, tags string")
    means = spark.createDataFrame([(1, 2.0)], "productId int, avg double")
    search.save_grams(products, str(tmp_path))
    for pattern in ("spring", "ring|blue g", "lemon.*(green|blue)", "ge[a-z]r", r"hot\.dog", "^ring$", "nothing here", "hot( |$)"):
        got = search.search_indexed(spark, str(tmp_path), products, means, pattern)
        plain = serving.search(products, means, pattern)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
        assert {r["name"] for r in got.collect()} == {n for n in names if n is not None and re.search(pattern, n)}
    plan = search.candidates(spark, str(tmp_path), search.needed("spring"))._jdf.queryExecution().toString()
    assert "In(gram" in plan


def test_bucketed_tables_are_joined_without_an_exchange(spark, tmp_path):
    one = spark.createDataFrame([(i, f"p{i}") for i in range(300)], "productId int, name string")
    many = spark.createDataFrame([(i % 300, i) for i in range(900)], "productId int, other int")
    empty = one.limit(0)
    a, b, c = (save_bucketed(df, str(tmp_path), name, "productId", 4) for df, name in ((one, "one"), (many, "many"), (empty, "none")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        met = a.join(b, "productId")
        counted = met.groupBy("productId", "name").agg(F.sum("other").alias("sum"))
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
        assert {r["productId"]: r["sum"] for r in counted.collect()} == {i: 3 * i + 900 for i in range(300)}
        assert a.join(c, "productId", "left_semi").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    save_bucketed(one.limit(10), str(tmp_path), "one", "productId", 2)  # in place of the older table
    assert spark.read.parquet(str(tmp_path / "one")).count() == 10
