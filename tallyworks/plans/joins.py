"""j01 - j09, u01, u02: joins, lookups and unions."""

from pyspark.sql import functions as F

from tallyworks.functions.cells import price_band
from tallyworks.operators import joins as ops
from tallyworks.operators import tags
from tallyworks.operators.features import distinct_tokens
from tallyworks.operators.statistics import top_per_group
from tallyworks.operators.words import explode_words
from tallyworks.plans.filters import BAND_SQL
from tallyworks.plans.inputs import STOP_SQL, TAGS_SQL, WORDS_SQL, stop_words, stored_baskets
from tallyworks.plans.registry import query, rounded
from tallyworks.session import fresh_path, materialize
from tallyworks.sources import keyed
from tallyworks.sources.files import union_tables

# A relation request names its tags; here all types of the part table.
REQUESTED = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "UNSEEN"]


@query("j01_left_join_two_keys", """WITH poi AS (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem
    WHERE l_returnflag = 'R' GROUP BY ALL)
  SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, n
  FROM lineitem LEFT JOIN poi USING (l_suppkey, l_partkey)""")
def left_join(t):
    poi = materialize(t.lineitem.where("l_returnflag = 'R'").groupBy("l_suppkey", "l_partkey")
                      .agg(F.count(F.lit(1)).alias("n")), "poi")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")
    return ops.lookup_join(rows, poi, ["l_suppkey", "l_partkey"])


@query("j02_lookup_or_zero", """SELECT n_nationkey, coalesce(c, 0) AS customers FROM nation LEFT JOIN
  (SELECT c_nationkey, count(*) AS c FROM customer WHERE c_acctbal > 9900 GROUP BY 1) k
  ON n_nationkey = c_nationkey""")
def lookup(t):
    rich = t.customer.where("c_acctbal > 9900").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("customers"))
    return ops.lookup_or_zero(t.nation.select("n_nationkey"), rich, ["n_nationkey"], "customers")


@query("j02_required_keys", """SELECT n_nationkey, c AS customers FROM nation JOIN
  (SELECT c_nationkey, count(*) AS c FROM customer GROUP BY 1) k ON n_nationkey = c_nationkey""")
def required_keys(t):
    counts = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    return ops.require_keys(t.nation.select("n_nationkey"), counts, ["n_nationkey"])


@query("j03_update_by_key", """WITH newer AS (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS price
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
  SELECT o_orderkey, o_orderstatus, coalesce(price, o_totalprice) AS o_totalprice
  FROM orders LEFT JOIN newer ON o_orderkey = l_orderkey""")
def update(t):
    newer = materialize(t.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey"))
                        .agg(rounded(F.sum("l_extendedprice"), 2).alias("o_totalprice")), "newer")
    return ops.update_by_key(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), newer,
                             "o_orderkey", ["o_totalprice"])


@query("j03_versioned_update", """WITH raised AS (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS price
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
  v1 AS (SELECT o_orderkey, o_orderstatus, CASE WHEN l_orderkey IS NULL THEN o_totalprice ELSE price END AS o_totalprice
         FROM orders LEFT JOIN raised ON o_orderkey = l_orderkey)
  SELECT 0 AS version, o_orderkey, o_orderstatus, o_totalprice FROM orders
  UNION ALL SELECT 1, * FROM v1
  UNION ALL SELECT 2, o_orderkey, CASE WHEN o_orderkey % 100 = 7 THEN NULL ELSE o_orderstatus END, o_totalprice FROM v1
  UNION ALL SELECT 2, -c_custkey, 'N', c_acctbal FROM customer WHERE c_acctbal > 9900""")
def versioned_update(t):
    """All versions of a stored table: two updates in place, the second one with nulls and new keys."""
    table = keyed.KeyedTable.create(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"),
                                    fresh_path(t.spark, "orders"), "o_orderkey")
    raised = t.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        rounded(F.sum("l_extendedprice"), 2).alias("o_totalprice"))
    table.update(raised, ["o_totalprice"])
    closed = table.read().where("o_orderkey % 100 = 7").withColumn("o_orderstatus", F.lit(None).cast("string"))
    added = t.customer.where("c_acctbal > 9900").select(
        (-F.col("c_custkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), F.col("c_acctbal").alias("o_totalprice"))
    table.append(closed.union(added))
    return union_tables([table.read(v).withColumn("version", F.lit(v)) for v in table.versions()])


@query("j04_earlier_pairs", """WITH lines AS (SELECT l_orderkey AS basket, p_type AS tag,
      row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS i
    FROM lineitem JOIN part ON l_partkey = p_partkey)
  SELECT greatest(a.tag, b.tag) AS tag1, least(a.tag, b.tag) AS tag2, count(*) AS count
  FROM lines a JOIN lines b ON a.basket = b.basket AND b.i < a.i
  WHERE a.tag IN ('LARGE', 'SMALL') OR b.tag IN ('LARGE', 'SMALL') GROUP BY 1, 2""")
def earlier_pairs(t):
    asked = ["LARGE", "SMALL"]
    return tags.earlier_pairs(tags.cooccurrence(stored_baskets(t), "o_orderkey", asked), asked)


@query("j05_requested_pairs", f"""WITH {TAGS_SQL},
  asked AS (SELECT unnest({REQUESTED}) AS tag, unnest(range({len(REQUESTED)}))::INT AS i)
  SELECT a.i, b.i AS j, a.tag AS tag1, b.tag AS tag2, coalesce(count, 0) AS count
  FROM asked a JOIN asked b ON b.i < a.i LEFT JOIN pairs ON tag1 = a.tag AND tag2 = b.tag""")
def requested_pairs(t):
    counts = tags.cooccurrence(stored_baskets(t), "o_orderkey", REQUESTED)
    return tags.requested_pairs(counts, REQUESTED)


@query("j06_remove_stop_words", f"""SELECT word, count(*) AS count FROM
  (SELECT {WORDS_SQL.format('text')} AS word FROM documents) w
  WHERE word NOT IN (SELECT * FROM (VALUES {STOP_SQL}) s) GROUP BY word""")
def without_stop_words(t):
    counts = explode_words(t.texts("documents", "text"), "text").groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return ops.remove_stop_words(counts, stop_words(t))


@query("j07_fetch_ranked", """WITH ranked AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rank
    FROM documents QUALIFY rank <= 20)
  SELECT doc_id, rank::INT AS rank, lang, source, n_chars FROM documents JOIN ranked USING (doc_id)""")
def fetch_ranked(t):
    longest = t.documents.select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(20)
    ranked = top_per_group(longest.withColumn("one", F.lit(1)), "one", [F.desc("n_chars"), "doc_id"], 20)
    return ops.fetch_ranked(t.documents.select("doc_id", "lang", "source", "n_chars"),
                            ranked.select("doc_id", "rank"), "doc_id")


MONTHS = ["20220101", "20220201", "20220301"]


@query("j08_period_category_page", f"""SELECT n_nationkey, n_name, period, page::INT AS page
  FROM nation, (SELECT unnest({MONTHS}) AS period) m, (SELECT unnest(range(1, 101)) AS page) p""")
def grid(t):
    return ops.with_grid(t.nation.select("n_nationkey", "n_name"), period=MONTHS, page=range(1, 101))


@query("j09_row_aligned_column", """SELECT l_orderkey, l_linenumber, l_partkey,
  round(l_extendedprice - l_quantity * 1000, 4) AS delta FROM lineitem""")
def row_aligned(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             rounded(F.col("l_extendedprice") - F.col("l_quantity") * 1000, 4).alias("delta"))


@query("u01_union_all", f"""SELECT p_partkey, {BAND_SQL.format('p_size')} AS band, 'size' AS kind FROM part
  UNION ALL SELECT p_partkey, {BAND_SQL.format('(p_retailprice - 895)')}, 'price' FROM part""")
def union_all(t):
    by_size = t.part.select("p_partkey", price_band(F.col("p_size")).alias("band"), F.lit("size").alias("kind"))
    by_price = t.part.select("p_partkey", price_band(F.col("p_retailprice") - 895).alias("band"),
                             F.lit("price").alias("kind"))
    return union_tables([by_size, by_price])


@query("u02_distinct_tokens", "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS token FROM part")
def tokens(t):
    return distinct_tokens(t.part, "p_name")
