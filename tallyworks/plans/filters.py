"""p01 - p25: projections, filters and predicates."""

from pyspark.sql import functions as F

from tallyworks.functions.cells import letter_words, open_between, price_band, words
from tallyworks.functions.fixed_values import FIRST_YEAR
from tallyworks.operators import tables as ops
from tallyworks.plans.inputs import LABELLED_SQL, LABELLED_TEXT_SQL, WORDS_SQL, labelled_documents, text_mark
from tallyworks.plans.registry import query, rounded

BAND_SQL = """CASE WHEN {0} > 0 AND {0} < 10 THEN '10万以下' WHEN {0} > 10 AND {0} < 30 THEN '10-30万'
  WHEN {0} > 30 AND {0} < 50 THEN '30-50万' WHEN {0} > 50 AND {0} < 70 THEN '50-70万'
  WHEN {0} > 70 AND {0} < 90 THEN '70-90万' WHEN {0} > 90 AND {0} < 110 THEN '90-110万'
  WHEN {0} > 110 AND {0} < 150 THEN '110-150万' WHEN {0} > 150 AND {0} < 200 THEN '150-200万'
  WHEN {0} > 200 AND {0} < 10000 THEN '200万以上' END"""


@query("p01_select_columns", "SELECT p_name, p_retailprice FROM part")
def select_columns(t):
    return t.part.select("p_name", "p_retailprice")


@query("p02_drop_columns", """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice
  FROM lineitem""")
def drop_columns(t):
    return t.lineitem.drop("l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@query("p03_sentinel_to_null", """SELECT event_id, user_id, nullif(event_type, 'error') AS event_type
  FROM events""")
def sentinel_to_null(t):
    return ops.blank_to_null(t.events.select("event_id", "user_id", "event_type"), "error", ["event_type"])


@query("p04_replace_value", """SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '2023'
  ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def replace_value(t):
    return t.orders.select("o_orderkey", "o_orderpriority").replace(
        {"4-NOT SPECIFIED": "2023"}, subset=["o_orderpriority"])


@query("p05_drop_null_rows", f"""SELECT * EXCLUDE (text) FROM ({LABELLED_TEXT_SQL}) d
  WHERE text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL""")
def drop_null_rows(t):
    return labelled_documents(t, text_mark()).dropna("any").drop("text")


@query("p06_keep_not_null", f"SELECT doc_id, quality FROM ({LABELLED_SQL}) d WHERE quality IS NOT NULL")
def keep_not_null(t):
    return labelled_documents(t).where(F.col("quality").isNotNull()).select("doc_id", "quality")


@query("p07_drop_zero_rows", """SELECT l_orderkey, l_linenumber, l_partkey, l_discount, l_tax FROM lineitem
  WHERE NOT (coalesce(l_discount = 0, false) OR coalesce(l_tax = 0, false) OR coalesce(l_quantity = 0, false)
             OR coalesce(l_suppkey = 0, false) OR coalesce(l_partkey = 0, false))""")
def drop_zero_rows(t):
    rows = ops.drop_zero_rows(t.lineitem, ["l_discount", "l_tax", "l_quantity", "l_suppkey", "l_partkey"])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax")


@query("p08_keep_price_range", """SELECT p_partkey, p_retailprice / 2 AS price FROM part
  WHERE p_retailprice / 2 IS NULL OR p_retailprice / 2 BETWEEN 460 AND 490""")
def keep_price_range(t):
    priced = t.part.select("p_partkey", (F.col("p_retailprice") / 2).alias("price"))
    return ops.keep_range(priced, "price", 460, 490)


@query("p09_keep_from_year", """SELECT o_orderkey, year(o_orderdate)::INT AS year FROM orders
  WHERE year(o_orderdate) >= 2000 OR o_orderdate IS NULL""")
def keep_from_year(t):
    return ops.keep_range(t.orders.select("o_orderkey", F.year("o_orderdate").alias("year")), "year", FIRST_YEAR)


@query("p10_drop_sentinel_rows", """SELECT o_orderkey, o_orderpriority FROM orders
  WHERE o_orderpriority IS DISTINCT FROM '4-NOT SPECIFIED'""")
def drop_sentinel_rows(t):
    return ops.drop_equal(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", "4-NOT SPECIFIED")


@query("p11_open_interval", "SELECT p_partkey, p_size FROM part WHERE p_size > 10 AND p_size < 30")
def open_interval(t):
    return t.part.where(open_between(F.col("p_size"), 10, 30)).select("p_partkey", "p_size")


@query("p12_date_range", """SELECT o_orderkey, o_orderdate FROM orders
  WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate <= TIMESTAMP '1998-06-30'""")
def date_range(t):
    low, high = F.lit("1998-01-01").cast("timestamp_ntz"), F.lit("1998-06-30").cast("timestamp_ntz")
    return t.orders.where(F.col("o_orderdate").between(low, high)).select("o_orderkey", "o_orderdate")


@query("p13_fill_null_zero", f"""SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
  FROM ({LABELLED_SQL}) d""")
def fill_null_zero(t):
    return labelled_documents(t).select("doc_id", "quality", "toxic").fillna(0)


@query("p14_distinct_pairs", "SELECT DISTINCT l_suppkey, l_partkey FROM lineitem")
def distinct_pairs(t):
    return t.lineitem.select("l_suppkey", "l_partkey").distinct()


@query("p15_scale_unit", "SELECT o_orderkey, o_totalprice / 10000 AS price FROM orders")
def scale_unit(t):
    return t.orders.select("o_orderkey", (F.col("o_totalprice") / 10000).alias("price"))


@query("p16_round_keys", """SELECT s_suppkey, round(s_acctbal / 7, 6) AS x, round(s_acctbal / 11, 6) AS y
  FROM supplier""")
def round_keys(t):
    return t.supplier.select("s_suppkey", rounded(F.col("s_acctbal") / 7).alias("x"),
                             rounded(F.col("s_acctbal") / 11).alias("y"))


@query("p17_regex_filter", """SELECT p_partkey, p_name, regexp_matches(p_name, '^(red|hot) .*g') AS by_pattern
  FROM part WHERE regexp_matches(p_name, '^(red|hot) .*g') OR contains(lower(p_name), lower('ANVIL'))""")
def regex_filter(t):
    names = t.part.select("p_partkey", "p_name")
    by_pattern = ops.match_text(names, "p_name", "^(red|hot) .*g").withColumn("by_pattern", F.lit(True))
    by_text = ops.match_text(names, "p_name", "ANVIL", literal=True).where(~F.col("p_name").rlike("^(red|hot) .*g"))
    return by_pattern.unionByName(by_text.withColumn("by_pattern", F.lit(False)))


@query("p18_equality_filter", """SELECT event_id, user_id FROM events
  WHERE event_type = 'purchase' AND month(ts) = 1""")
def equality_filter(t):
    return t.events.where((F.col("event_type") == "purchase") & (F.month("ts") == 1)).select("event_id", "user_id")


@query("p19_still_missing", f"SELECT doc_id FROM ({LABELLED_SQL}) d WHERE quality IS NULL")
def still_missing(t):
    return labelled_documents(t).where(F.col("quality").isNull()).select("doc_id")


@query("p20_drop_empty_tokens", """SELECT word, count(*) AS count FROM
  (SELECT unnest(regexp_split_to_array(text, '[^a-zA-Z]')) AS word FROM documents) w
  WHERE length(trim(word)) > 0 GROUP BY word""")
def drop_empty_tokens(t):
    pieces = t.texts("documents", "text").select(F.explode(letter_words(F.col("text"))).alias("word"))
    return pieces.where(F.length(F.trim("word")) > 0).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


@query("p21_keep_long_tokens", f"""SELECT word, count(*) AS count FROM
  (SELECT {WORDS_SQL.format('text')} AS word FROM documents) w WHERE length(word) > 1 GROUP BY word""")
def keep_long_tokens(t):
    tokens = t.texts("documents", "text").select(F.explode(words(F.col("text"))).alias("word"))
    return tokens.where(F.length("word") > 1).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


@query("p22_price_band", f"""SELECT p_partkey, {BAND_SQL.format('(p_retailprice - 895) * 2')} AS price_band
  FROM part""")
def band_rows(t):
    return t.part.select("p_partkey", price_band((F.col("p_retailprice") - 895) * 2).alias("price_band"))


@query("p23_repair_with_group_mode", """WITH counts AS (
    SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY ALL),
  modes AS (SELECT p_brand, p_size AS size FROM counts
            QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_size) = 1)
  SELECT p_partkey, p_brand, CASE WHEN p_retailprice > 995 THEN size ELSE p_size END AS p_size
  FROM part JOIN modes USING (p_brand)""")
def repair_rows(t):
    rows = t.part.select("p_partkey", "p_brand", "p_size", "p_retailprice")
    return ops.repair_with_group_mode(rows, F.col("p_retailprice") > 995, "p_size", "p_brand").drop("p_retailprice")


NAMES = {"p_partkey": "key", "p_name": "title", "p_brand": "maker", "p_type": "level", "p_size": "length",
         "p_retailprice": "price"}


@query("p24_rename_columns", """SELECT p_partkey AS key, p_name AS title, p_brand AS maker, p_type AS level,
  p_size AS length, p_retailprice AS price FROM part""")
def rename(t):
    return ops.rename_columns(t.part, NAMES)


@query("p25_columns_by_type", "SELECT p_partkey, p_size, p_retailprice FROM part")
def columns_by_type(t):
    return t.part.select(*ops.numeric_columns(t.part))
