"""The operators as queries over a star-schema folder, for checks and timing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoprec.functions.scalars import dot, name_id, rounded
from shoprec.operators import accounts, content, cooccur, factors, mips, ranking, realtime, search, serving, stats, vectors
from shoprec.schemas import RATING, conform
from shoprec.session import keep, work_dir
from shoprec.sources import retail, text, topic
from shoprec.sources.tables import load_table, save_bucketed, save_table
from shoprec.streaming import queues, replay

NUM = 20
LOOKUP_NUM = 5
SEARCH = "ring|ge[a-z]r"
SEARCH_LITERAL = "ring|lemon.*(green|blue)|hot( |$)"
NOW = 1_700_000_000


def rate_more(spark: SparkSession, sf: str) -> DataFrame:
    return stats.rate_more(retail.ratings(spark, sf))


def rate_recent(spark: SparkSession, sf: str) -> DataFrame:
    return stats.rate_recent(retail.ratings(spark, sf))


def average_score(spark: SparkSession, sf: str) -> DataFrame:
    means = stats.average_score(retail.ratings(spark, sf))
    return means.select("productId", rounded(F.col("avg")).alias("avg"))


def _hydrated(recs: DataFrame, spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    means = stats.average_score(retail.ratings(spark, sf))
    rows = serving.hydrate(recs, retail.products(spark, sf), means)
    return rows.select(*columns, "recProductId", "name", rounded(F.col("avg")).alias("avg"))


def top_rated_products(spark: SparkSession, sf: str) -> DataFrame:
    """The most rated products with name and mean score."""
    top = stats.top_rated(stats.rate_more(retail.ratings(spark, sf)), NUM)
    return _hydrated(top.withColumnRenamed("productId", "recProductId"), spark, sf, "count")


def hot_products(spark: SparkSession, sf: str) -> DataFrame:
    hot = stats.hot_products(stats.rate_recent(retail.ratings(spark, sf)), NUM)
    return _hydrated(hot.withColumnRenamed("productId", "recProductId"), spark, sf, "yearMonth", "count")


def distinct_users_products(spark: SparkSession, sf: str) -> DataFrame:
    ratings = retail.ratings(spark, sf)

    def kind(column: str, name: str) -> DataFrame:
        found = serving.entities(ratings, column)
        return found.select(F.lit(name).alias("kind"), F.col(column).alias("id"))

    return kind("userId", "user").unionByName(kind("productId", "product"))


def cooccurrence(spark: SparkSession, sf: str) -> DataFrame:
    return cooccur.cooccurrence(retail.ratings(spark, sf))


def itemcf_topk(spark: SparkSession, sf: str) -> DataFrame:
    return cooccur.item_cf(retail.ratings(spark, sf))


def _as_text(nested: DataFrame, key: str) -> DataFrame:
    """Lists as text, scores in millionths."""
    entry = F.transform(
        "recs",
        lambda x: F.concat_ws(
            ":", x["productId"].cast("string"), F.rint(x["score"] * 1e6).cast("bigint").cast("string")
        ),
    )
    return nested.select(key, F.size("recs").alias("entries"), F.array_join(entry, ",").alias("recs"))


def itemcf_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Stored form: a list for each product, empty when nothing was rated with it."""
    nested = ranking.to_nested(itemcf_topk(spark, sf), "productId", keys=retail.products(spark, sf))
    return _as_text(nested, "productId")


def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights = content.tfidf(retail.products(spark, sf))
    return weights.withColumns({c: rounded(F.col(c)) for c in ("idf", "weight")})


def content_sim(spark: SparkSession, sf: str) -> DataFrame:
    """Every directed pair of products with similar tags, copies included."""
    return content.content_sim(retail.products(spark, sf))


def content_topk(spark: SparkSession, sf: str) -> DataFrame:
    return content.content_sim(retail.products(spark, sf), k=NUM)


def content_hashed(spark: SparkSession, sf: str) -> DataFrame:
    return content.content_sim(retail.products(spark, sf), k=NUM, mode="hashed")


def vector_sim(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.cosine_sim(retail.vectors(spark, sf))


def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.cosine_sim(retail.vectors(spark, sf), min_sim=0.1, k=LOOKUP_NUM)


def vector_topk_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """As `vector_topk`, with blocks so small that any table makes many cells."""
    return vectors.cosine_sim(retail.vectors(spark, sf), min_sim=0.1, k=LOOKUP_NUM, block=80)


def als_user_recs(spark: SparkSession, sf: str) -> DataFrame:
    return factors.user_recs(factors.fit(retail.ratings(spark, sf)))


def _stretched(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors, stretched to seven lengths."""
    v = retail.vectors(spark, sf)
    return v.select("id", F.transform("features", lambda x: x * (1 + F.col("id") % 7)).alias("features"))


def mips_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors with the largest inner products of each vector, itself included."""
    v = _stretched(spark, sf)
    found = mips.max_products(v, v, NUM, part=256, block=64)
    return found.select(F.col("id").alias("vecId"), F.col("other").alias("otherId"), "score", "rank")


def als_item_sim(spark: SparkSession, sf: str) -> DataFrame:
    return factors.item_sim(factors.fit(retail.ratings(spark, sf)), k=NUM)


def als_fit_check(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings of each user, and whether its factors solve the normal equations for the item factors."""
    ratings = retail.ratings(spark, sf)
    checked = factors.normal_equations(factors.fit(ratings), ratings)
    return checked.select("userId", "ratings", (F.coalesce("miss", F.lit(0.0)) < 1e-3).alias("solved"))


def als_lists_check(spark: SparkSession, sf: str) -> DataFrame:
    """Of each user's list: whether ranks are complete, scores fall, and each is the product of the factors."""
    model = factors.fit(retail.ratings(spark, sf))
    u = model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("u"))
    v = model.itemFactors.select(F.col("id").alias("recProductId"), F.col("features").alias("v"))
    rows = factors.user_recs(model).join(v, "recProductId").join(u, "userId")
    entry = F.struct("rank", "score", (F.abs(dot(F.col("u"), F.col("v")) - F.col("score")) < 1e-3).alias("right"))
    lists = rows.groupBy("userId").agg(F.array_sort(F.collect_list(entry)).alias("list"))  # k entries at most
    ranks = F.transform("list", lambda x: x["rank"]) == F.sequence(F.lit(1), F.size("list"))
    falling = F.forall(
        F.zip_with("list", F.slice("list", 2, factors.USER_LIST), lambda x, y: F.coalesce(x["score"] >= y["score"], F.lit(True))),
        lambda x: x,
    )
    return lists.select(
        "userId", ranks.alias("ranked"), falling.alias("falling"), F.forall("list", lambda x: x["right"]).alias("right")
    )


def als_holdout(spark: SparkSession, sf: str) -> DataFrame:
    """The test rows whose user and product occur in training, and whether the prediction is a number."""
    train, test = factors.split(retail.ratings(spark, sf))
    predicted = factors.predict(factors.fit(train), test)
    number = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return predicted.select("userId", "productId", "score", "timestamp", number.alias("predicted"))


def als_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The parameter pairs, whether their error is a number, and whether the best one is below that of
    predicting no stars at all. Weakly regularised models of high rank can be worse than that."""
    ratings = retail.ratings(spark, sf)
    _, test = factors.split(ratings)
    none = factors.rmse(test.withColumn("prediction", F.lit(0.0))).select(F.col("rmse").alias("none"))
    results = factors.grid_search(ratings)
    best = factors.best(results).select(F.col("rmse").alias("least"))
    found = results.crossJoin(F.broadcast(none)).crossJoin(F.broadcast(best))  # one row each
    number = F.col("rmse").isNotNull() & ~F.isnan("rmse")
    return found.select(
        "rank", "lambda", number.alias("number"), (F.col("least") < F.col("none")).alias("best_better")
    )


def rating_split(spark: SparkSession, sf: str) -> DataFrame:
    train, test = factors.split(retail.ratings(spark, sf))
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return sides.groupBy("userId", "side").agg(
        F.count(F.lit(1)).alias("ratings"), F.sum("score").alias("total")
    )


def rmse(spark: SparkSession, sf: str) -> DataFrame:
    """Error of the product mean of the training rows on the test rows."""
    train, test = factors.split(retail.ratings(spark, sf))
    means = stats.average_score(train).withColumnRenamed("avg", "prediction")
    return factors.rmse(test.join(means, "productId"))


def latest_ratings(spark: SparkSession, sf: str) -> DataFrame:
    ratings = retail.ratings(spark, sf, order=True)
    newest = ranking.latest_n(ratings, realtime.RECENT, order=retail.ORDER)
    return newest.select("userId", "seq", "productId", "score", "timestamp")


def _live(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Per user the newest rating as an event, and all the others as history."""
    events, history = replay.live_and_history(retail.ratings(spark, sf, order=True))
    return events.drop("seq"), history


def rating_queue(spark: SparkSession, sf: str) -> DataFrame:
    """Recent-rating queues after the live events were pushed on the history."""
    events, history = _live(spark, sf)
    return realtime.push_recent(events, history, order=retail.ORDER).select(
        "userId", "seq", "productId", "score"
    )


def rating_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Rating table after the live events; equal keys in the history stay, touched ones become one."""
    events, history = _live(spark, sf)
    return realtime.upsert_ratings(events, history, order=("timestamp", "orderkey", "linenumber"))


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    ratings = retail.ratings(spark, sf, order=True)
    events = ranking.latest_n(ratings, 1, order=retail.ORDER)
    return realtime.candidates(events, content.TagSimilarities(retail.products(spark, sf)), ratings)


def stream_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return _candidates(spark, sf)


def stream_scores(spark: SparkSession, sf: str) -> DataFrame:
    ratings = retail.ratings(spark, sf, order=True)
    events = ranking.latest_n(ratings, 1, order=retail.ORDER).drop("seq")
    recent = ranking.latest_n(ratings, realtime.RECENT, order=retail.ORDER)
    sims = content.TagSimilarities(retail.products(spark, sf))
    return _as_text(realtime.score_events(events, recent, sims, ratings, hold=keep), "userId")


def stream_replay(spark: SparkSession, sf: str) -> DataFrame:
    state, _ = replay.run(spark, sf)
    return _as_text(state.recs(spark), "userId")


def stream_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    """First entries of the lists after two batches, the second replacing lists of the first, looked
    up by user in the logs."""
    state, users = replay.run(spark, sf, rounds=2)
    return _micro(serving.recs_for(users, state.recs(spark, users), "userId", LOOKUP_NUM), "userId")


def _micro(recs: DataFrame, key: str) -> DataFrame:
    score = F.rint(F.col("score") * 1e6).cast("bigint").alias("score")
    return recs.select(key, "recProductId", "rank", score)


def user_recs_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """First ranks in the stored list of the factor model for each user who rated."""
    ratings = retail.ratings(spark, sf)
    root = work_dir(spark, "user-recs")
    lists = ranking.to_nested(factors.user_recs(factors.fit(ratings)), "userId")
    save_table(lists, root, "user_recs", ["userId"])
    users = serving.entities(ratings, "userId")
    return serving.recs_for(users, load_table(spark, root, "user_recs"), "userId", LOOKUP_NUM).select("userId", "rank")


def stream_queue(spark: SparkSession, sf: str) -> DataFrame:
    """Recent-rating queues kept in the state of a stream: history first, then the three newest ratings of
    each user in two micro-batches."""
    root = work_dir(spark, "queues")
    ratings = retail.ratings(spark, sf, order=True)
    place = (F.col("orderkey") * 10 + F.col("linenumber")).alias("place")
    newest = keep(ranking.latest_n(ratings, realtime.QUEUE + 3, order=retail.ORDER).select(
        "userId", "productId", "score", "timestamp", place, "seq"
    ))
    for n, some in enumerate((F.col("seq") == 3, F.col("seq") < 3)):
        newest.where(some).drop("seq").coalesce(1).write.mode("append").parquet(f"{root}/events/batch={n}")
    events = spark.readStream.schema(
        "userId int, productId int, score double, timestamp bigint, place bigint"
    ).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{root}/events")

    def log(rows: DataFrame, batch: int) -> None:
        rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{root}/log/part={batch}")

    history = newest.where(F.col("seq") > 3)
    queues.start_recent_queues(events, f"{root}/progress", log, history, trigger={"availableNow": True}).awaitTermination()
    kept = queues.newest_queues(spark.read.parquet(f"{root}/log"))
    return kept.select("userId", "seq", "productId", "score")


def stream_from_position(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings of a message folder from a position in its middle on, and, once the stream goes on from its
    checkpoint, of the messages that came later."""
    root = work_dir(spark, "topic")
    orders = retail.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    sold = retail.table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    fields = ("o_custkey", "l_partkey", F.col("l_quantity") % 5 + 1, retail.seconds(F.col("o_orderdate")))
    value = F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in fields])
    lines = keep(sold.select(value.alias("value"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("place"), "l_linenumber"))
    early = lines.where("l_linenumber <= 3")
    middle = topic.publish(early.where("l_linenumber = 1"), f"{root}/messages")
    end = topic.publish(early.where("l_linenumber > 1"), f"{root}/messages", middle)

    def take() -> None:
        messages = topic.read_messages(spark, f"{root}/messages", middle)
        good, _ = text.parse_ratings(messages)
        good.writeStream.format("parquet").option("path", f"{root}/ratings").option(
            "checkpointLocation", f"{root}/progress"
        ).trigger(availableNow=True).start().awaitTermination()

    take()
    topic.publish(lines.where("l_linenumber > 3"), f"{root}/messages", end)
    take()
    return spark.read.parquet(f"{root}/ratings").select("userId", "productId", "score", "timestamp")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings as JSON texts, those of every eleventh user cut short."""
    rows = conform(retail.ratings(spark, sf), RATING)
    whole = text.to_documents(rows)
    cut = F.when(F.get_json_object("value", "$.userId").cast("int") % 11 == 0, F.regexp_replace("value", r"\}$", ""))
    return whole.select(F.explode(F.array(F.coalesce(cut, F.col("value")))).alias("value"))


def rating_documents(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = text.parse_documents(_documents(spark, sf), RATING)
    return good


def rejected_rating_documents(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = text.parse_documents(_documents(spark, sf), RATING)
    return rejected


def fold_in(spark: SparkSession, sf: str) -> DataFrame:
    """Factors of users for fixed item factors: the first two components of the vector with the product's id."""
    items = retail.vectors(spark, sf).select("id", F.slice("features", 1, 2).alias("features"))
    found = factors.fold_in(items, retail.ratings(spark, sf))
    part = lambda i: rounded(F.element_at("features", i))
    return found.select(F.col("id").alias("userId"), "ratings", part(1).alias("u1"), part(2).alias("u2"))


def registrations(spark: SparkSession, sf: str) -> DataFrame:
    """Names asked for: the buyer of every order, all taken, and the supplier of every line."""
    buyers = retail.table(spark, sf, "orders").join(
        retail.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    sellers = retail.table(spark, sf, "lineitem").join(
        retail.table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    names = buyers.select(F.col("c_name").alias("username")).unionByName(
        sellers.select(F.col("s_name").alias("username"))
    )
    added = accounts.register(names, retail.users(spark, sf), NOW)
    return added.select("userId", "username", "first", "timestamp", F.size("prefGenres").alias("genres"))


def preference_update(spark: SparkSession, sf: str) -> DataFrame:
    """Users who rated choose their segment and nation."""
    customers = retail.table(spark, sf, "customer").join(
        retail.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    raters = serving.entities(retail.ratings(spark, sf), "userId")
    changes = customers.select(
        F.col("c_custkey").cast("int").alias("userId"),
        (F.col("c_acctbal") > 0).alias("first"),
        F.array("c_mktsegment", "n_name").alias("prefGenres"),
    ).join(raters, "userId", "left_semi")
    changed = accounts.update_preferences(changes, retail.users(spark, sf))
    return changed.select("userId", "username", "first", F.array_join("prefGenres", ",").alias("prefGenres"))


def _log(spark: SparkSession, sf: str) -> DataFrame:
    """A log: each rating as a line, those of flag A padded, those of flag N as they are, all others
    cut short, and all documents between."""
    orders = retail.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    sold = retail.table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = sold.select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("productId"),
        (F.col("l_quantity") % 5 + 1).alias("score"),
        retail.seconds(F.col("o_orderdate")).alias("timestamp"),
        "l_returnflag",
    )
    line = text.rating_line()
    value = (
        F.when(F.col("l_returnflag") == "N", line)
        .when(F.col("l_returnflag") == "A", F.concat(F.lit("INFO rating "), line, F.lit(" \t")))
        .otherwise(F.regexp_replace(line, r"\|-?\d+$", ""))
    )
    noise = retail.table(spark, sf, "documents").select(F.col("text").alias("value"))
    made = rows.select(F.explode(F.array(value)).alias("value"))  # a line is put together once, then read as from a file
    return made.unionByName(noise)


def parse_rating_log(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = text.parse_ratings(text.filter_log(_log(spark, sf)))
    return good


def rejected_rating_log(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = text.parse_ratings(text.filter_log(_log(spark, sf)))
    return rejected


def format_rating_log(spark: SparkSession, sf: str) -> DataFrame:
    return text.format_rating(retail.ratings(spark, sf))


def load_products(spark: SparkSession, sf: str) -> DataFrame:
    """Product file lines, made from the part table, read back."""
    p = retail.products(spark, sf)
    line = F.concat_ws(
        "^", F.col("productId").cast("string"), F.concat(F.lit(' "'), "name", F.lit(" ")),
        F.lit("1,2"), F.lit("shop"), "imageUrl", "categories", "tags",
    )
    return text.parse_products(p.select(line.alias("value")))


def load_ratings(spark: SparkSession, sf: str) -> DataFrame:
    """Rating file lines, times in milliseconds for orders of status O, read back."""
    orders = retail.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    sold = retail.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    seconds = retail.seconds(F.col("o_orderdate"))
    at = F.when(F.col("o_orderstatus") == "O", seconds * 1000).otherwise(seconds)
    fields = ("o_custkey", "l_partkey", F.col("l_quantity") % 5 + 1, at)
    line = F.concat_ws(",", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in fields])
    return text.parse_rating_rows(sold.select(line.alias("value")))


def recs_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """First co-rated products of every product, with name and mean score."""
    keys = retail.products(spark, sf).select("productId")
    root = work_dir(spark, "itemcf-recs")
    save_table(ranking.to_nested(itemcf_topk(spark, sf), "productId"), root, "itemcf_recs", ["productId"])
    found = serving.recs_for(keys, load_table(spark, root, "itemcf_recs"), "productId", LOOKUP_NUM)
    return _hydrated(found, spark, sf, "productId", "rank", "score")


def bucketed_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Products, mean scores and co-rating lists, in the same buckets of the product."""
    root, buckets = work_dir(spark, "bucketed"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    save = lambda df, name: save_bucketed(df, root, name, "productId", buckets)
    return (
        save(retail.products(spark, sf), "products"),
        save(stats.average_score(retail.ratings(spark, sf)), "average_score"),
        save(itemcf_topk(spark, sf), "itemcf_recs"),
    )


def bucketed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Every product with its mean score and list, from bucketed tables: no row is moved."""
    products, means, lists = bucketed_tables(spark, sf)
    named = serving.with_average(products, means).select("productId", "name", rounded(F.col("avg")).alias("avg"))
    return named.join(lists.select("productId", "recProductId", "rank", "score"), "productId")


def content_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """First similar products of every rated product."""
    keys = serving.entities(retail.ratings(spark, sf), "productId")
    found = serving.recs_for(keys, content_topk(spark, sf), "productId", LOOKUP_NUM)
    return _hydrated(found, spark, sf, "productId", "rank", "score")


def recs_by_username(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate products of users given by name."""
    names = retail.table(spark, sf, "customer").select(F.col("c_name").alias("username"))
    users = serving.resolve_users(names, retail.users(spark, sf))
    recs = _candidates(spark, sf).withColumnRenamed("candidate", "recProductId")
    found = serving.recs_for(users, recs, "userId", LOOKUP_NUM).join(users, "userId")
    return _hydrated(found, spark, sf, "username", "rank", "score")


def product_search(spark: SparkSession, sf: str) -> DataFrame:
    means = stats.average_score(retail.ratings(spark, sf))
    found = serving.search(retail.products(spark, sf), means, SEARCH)
    return found.withColumn("avg", rounded(F.col("avg")))


def product_search_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Search by stored trigrams of the names."""
    products, root = retail.products(spark, sf), work_dir(spark, "grams")
    search.save_grams(products, root)
    means = stats.average_score(retail.ratings(spark, sf))
    found = search.search_indexed(spark, root, products, means, SEARCH_LITERAL)
    return found.withColumn("avg", rounded(F.col("avg")))


def product_info(spark: SparkSession, sf: str) -> DataFrame:
    ratings = retail.ratings(spark, sf)
    ids = serving.entities(ratings, "productId")
    found = serving.products_by_id(ids, retail.products(spark, sf), stats.average_score(ratings))
    return found.withColumn("avg", rounded(F.col("avg")))


def user_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Users looked up by every customer and supplier name."""
    names = retail.table(spark, sf, "customer").select(F.col("c_name").alias("username")).unionByName(
        retail.table(spark, sf, "supplier").select(F.col("s_name").alias("username"))
    )
    return serving.users_by_name(names, retail.users(spark, sf)).select("userId", "username", "first")


def score_scale(spark: SparkSession, sf: str) -> DataFrame:
    """Each sale as a ten-star request."""
    lines = retail.table(spark, sf, "lineitem")
    requests = lines.select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_linenumber").alias("linenumber"),
        (F.col("l_quantity") % 10 + 1).alias("score"),
    )
    return accounts.scale_score(requests)


def user_hash(spark: SparkSession, sf: str) -> DataFrame:
    users = retail.users(spark, sf)
    return users.select("username", name_id(F.col("username")).alias("userId"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        rate_more, rate_recent, average_score, top_rated_products, hot_products,
        distinct_users_products, cooccurrence, itemcf_topk, itemcf_lists, tfidf_weights,
        content_sim, content_topk, content_hashed, vector_sim, vector_topk, vector_topk_blocks, mips_topk, als_user_recs,
        als_item_sim, als_fit_check, als_lists_check, als_holdout, als_grid, rating_split, rmse, latest_ratings, rating_queue,
        rating_upsert, stream_candidates, stream_scores, stream_replay, stream_two_batches, stream_queue, stream_from_position, fold_in, user_recs_lookup, registrations,
        preference_update, parse_rating_log, rejected_rating_log, format_rating_log, rating_documents, rejected_rating_documents,
        load_products, load_ratings, recs_lookup, bucketed_lookup, content_lookup, recs_by_username,
        product_search, product_search_indexed, product_info, user_by_name, score_scale, user_hash,
    )
}
