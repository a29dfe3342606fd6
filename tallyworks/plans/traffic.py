"""n01 - n14: event streams, membership, classifiers, graph and routes.

These jobs are known by name only; their definition is this library's own.
"""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyworks.operators import features, graphs, joins, learners, sketches, statistics as stats
from tallyworks.plans.learning import embedding_columns
from tallyworks.plans.registry import query, rounded
from tallyworks.session import fresh_path
from tallyworks.sources import files
from tallyworks.streaming import events as streams


def event_stream(t):
    return streams.with_time(streams.read_stream(t.spark, f"{t.folder}/events.parquet", t.events.schema))


def _by_day(table):
    start = F.col("w.start").cast("timestamp_ntz").cast("date").alias("day")
    return table.select(start, *[c for c in table.columns if c != "w"])


@query("n01_stream_page_views", "SELECT ts::DATE AS day, count(*) AS views FROM events GROUP BY 1")
def page_views(t):
    return _by_day(streams.run_to_table(streams.page_views(event_stream(t)), "complete"))


@query("n02_stream_unique_visitors", "SELECT ts::DATE AS day, count(DISTINCT user_id) AS visitors FROM events GROUP BY 1")
def unique_visitors(t):
    seen = streams.run_to_table(streams.first_seen(event_stream(t), ["user_id"]), "update")
    return _by_day(streams.unique_visitors(seen))


@query("n02_visitor_sketches", """SELECT ts::DATE AS day, count(DISTINCT user_id) AS visitors, true AS within_bound
  FROM events GROUP BY 1""")
def visitor_sketches(t):
    """Visitors per day from stored sketches that each batch of the stream merges into, held against exact numbers."""
    table = streams.SketchTable(t.spark, fresh_path(t.spark, "visitor-sketches"))
    stream = event_stream(t).select(F.to_date("ts").alias("day"), "user_id")
    streams.run_batches(stream, lambda batch: table.merge(batch, "user_id"))
    exact = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.countDistinct("user_id").alias("visitors"))
    gap = F.abs(F.col("estimate") - F.col("visitors")) / F.col("visitors")
    return exact.join(table.estimates("estimate"), "day", "left").select(
        "day", "visitors", F.coalesce(gap <= sketches.distinct_bound(), F.lit(False)).alias("within_bound"))


N03_SQL = """SELECT * FROM (SELECT event_type, user_id, count(*) AS count FROM events GROUP BY ALL) c
  QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY count DESC, user_id) <= 10"""


@query("n03_heavy_hitters", N03_SQL)
def heavy_hitters(t):
    """The same rows from a bounded state per event type and day, merged, and an exact count of its candidates."""
    days = t.events.select("event_type", "user_id", F.to_date("ts").alias("day"))
    return sketches.most_frequent(days, "event_type", "user_id", 10, ["day"]).drop("rank")


@query("n03_most_frequent_keys", N03_SQL)
def most_frequent(t):
    counts = t.events.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("count"))
    return stats.top_per_group(counts, "event_type", [F.desc("count"), "user_id"], 10).drop("rank")


@query("n04_train_classifiers")
def classifiers(t):
    """Accuracy of a decision tree and a small network on the held-out vectors."""
    names = [f"x{i}" for i in range(64)]
    rows = features.assemble(t.embeddings.select("vec_id", "label", *embedding_columns(64)), names)
    train, test = learners.split(rows.select("vec_id", "label", "features"), "vec_id")
    accuracy = F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy")
    parts = []
    for name, learner in (("tree", learners.tree_classifier("label")),
                          ("network", learners.network_classifier("label", [64, 16, 10]))):
        scored = learner.fit(train).transform(test)
        parts.append(scored.agg(accuracy, F.count(F.lit(1)).alias("rows")).withColumn("model", F.lit(name)))
    return parts[0].unionByName(parts[1])


def event_features(events):
    columns = events.select("event_id", "event_type", F.col("value").alias("x0"),
                            F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("x1"),
                            F.hour("ts").cast("double").alias("x2"))
    labelled = columns.withColumn("label", (F.col("event_type") == "error").cast("double"))
    return features.assemble(labelled, ["x0", "x1", "x2"]).select("event_id", "label", "features")


@query("n05_score_stream")
def score_stream(t):
    model = learners.tree_classifier("label", depth=5).fit(event_features(t.events))
    return streams.run_to_table(streams.class_counts(event_features(event_stream(t)), model), "complete")


@query("n06_membership", """SELECT user_id, user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase') AS member
  FROM (SELECT DISTINCT user_id FROM events) e""")
def membership(t):
    """Which visitors ever bought: Spark filters such joins by itself."""
    return joins.membership(t.events, t.events.where("event_type = 'purchase'"), "user_id")


@query("n07_discard_repeats", """SELECT DISTINCT user_id, event_type, ts::DATE AS day FROM events
  WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 40)""")
def discard(t):
    """First row of each user, type and day, of users that are not known; keys leave the state a day later."""
    known = t.events.where("event_type = 'error' and value > 40")
    events = event_stream(t).withColumn("day", F.to_date("ts"))
    seen = streams.seen_once(events, ["user_id", "event_type", "day"])
    kept = streams.run_to_table(seen, "append", lambda batch: streams.discard_known(batch, known, "user_id"))
    return kept.select("user_id", "event_type", "day")


@query("n08_libsvm", """SELECT label::DOUBLE AS label, round(embedding[1]::DOUBLE, 6) AS first,
  round(embedding[64]::DOUBLE, 6) AS last,
  round(list_sum([i * embedding[i]::DOUBLE for i in range(1, 65)]), 4) AS weighted FROM embeddings""")
def libsvm(t):
    path = fresh_path(t.spark, "libsvm")
    names = [f"x{i}" for i in range(64)]
    rows = features.assemble(t.embeddings.select("label", *embedding_columns(64)), names)
    files.write_libsvm(rows, path, "label", "features")
    found = files.load(t.spark, path, "libsvm", numFeatures="64").select("label", vector_to_array("features").alias("v"))
    total = F.aggregate(F.transform("v", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return found.select("label", rounded(F.col("v")[0]).alias("first"), rounded(F.col("v")[63]).alias("last"),
                        rounded(total, 4).alias("weighted"))


@query("n09_logistic_regression")
def logistic(t):
    """Accuracy of a text quality classifier on held-out labelled documents."""
    docs = learners.with_words(t.texts("documents", "doc_id", "text"), "text").drop("text")
    rows = docs.join(t.labels.select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id")
    train, test = learners.split(rows, "doc_id")
    scored = learners.word_pipeline("label").fit(train).transform(test)
    return scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
                      F.count(F.lit(1)).alias("rows"))


@query("n10_neighbour_stats", """SELECT l_suppkey AS src, count(*) AS neighbours, round(avg(p_retailprice), 9) AS mean_feature
  FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) e JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def neighbours(t):
    edges = t.lineitem.select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"))
    prices = t.part.select(F.col("p_partkey").alias("dst"), "p_retailprice")
    found = graphs.neighbour_stats(edges, prices, "p_retailprice")
    return found.withColumn("mean_feature", rounded("mean_feature", 9))


def routes(t):
    """Each vector as a route of 32 stops in the plane; its label is its island."""
    stop = lambda i: F.struct(F.col("embedding")[2 * i].cast("double").alias("x"),
                              F.col("embedding")[2 * i + 1].cast("double").alias("y"))
    return t.embeddings.select("vec_id", "label", F.transform(F.sequence(F.lit(0), F.lit(31)), stop).alias("stops"))


LEGS_SQL = """legs AS (SELECT vec_id, label, leg::INT AS leg,
    sqrt(power(embedding[2 * leg + 1]::DOUBLE - embedding[2 * leg + 3]::DOUBLE, 2)
       + power(embedding[2 * leg + 2]::DOUBLE - embedding[2 * leg + 4]::DOUBLE, 2)) AS distance
    FROM embeddings, (SELECT unnest(range(31)) AS leg) g),
  lengths AS (SELECT vec_id, label, sum(distance) AS length FROM legs GROUP BY ALL)"""


@query("n11_leg_distances", f"WITH {LEGS_SQL} SELECT vec_id, leg, round(distance, 6) AS distance FROM legs")
def leg_distances(t):
    return graphs.leg_table(routes(t), "vec_id", "stops").withColumn("distance", rounded("distance"))


NEAR = 0.02


@query("n11_within_radius", f"""WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings),
  d AS (SELECT a.vec_id AS key_a, b.vec_id AS key_b, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS distance
        FROM p a JOIN p b ON a.vec_id < b.vec_id)
  SELECT key_a, key_b, round(distance, 6) AS distance FROM d WHERE distance <= {NEAR}""")
def within_radius(t):
    """Distances of all points of a plane that are near each other."""
    points = t.embeddings.select("vec_id", F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))
    return graphs.pairs_within(points, "vec_id", "x", "y", NEAR).withColumn("distance", rounded("distance"))


def lengths(t):
    return routes(t).select("vec_id", "label", graphs.route_length(F.col("stops")).alias("length"))


@query("n12_route_lengths", f"WITH {LEGS_SQL} SELECT vec_id, round(length, 6) AS length FROM lengths")
def route_lengths(t):
    return lengths(t).select("vec_id", rounded("length").alias("length"))


@query("n13_selection_shares", f"""WITH {LEGS_SQL}, shares AS (
    SELECT vec_id, (1 / length) / (SELECT sum(1 / length) FROM lengths) AS probability FROM lengths)
  SELECT vec_id, round(probability, 9) AS probability, round(sum(probability) OVER (ORDER BY vec_id), 6) AS running
  FROM shares""")
def selection_shares(t):
    fit = lengths(t).select("vec_id", (1 / F.col("length")).alias("fitness"))
    found = graphs.selection_shares(fit, "vec_id", "fitness")
    return found.select("vec_id", rounded("probability", 9).alias("probability"), rounded("running").alias("running"))


@query("n14_best_per_island", f"""WITH {LEGS_SQL} SELECT label, vec_id, round(length, 6) AS length FROM lengths
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY length, vec_id) = 1""")
def best_per_island(t):
    found = graphs.best_per_island(lengths(t), "label", "vec_id", "length")
    return found.withColumn("length", rounded("length"))
