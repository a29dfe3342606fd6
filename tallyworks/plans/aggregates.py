"""a01 - a38: grouped counts, sums and distribution statistics."""

from pyspark.sql import functions as F

from tallyworks.functions.cells import int_or_zero
from tallyworks.operators import quantiles, sketches, statistics as stats, tags, words as text
from tallyworks.plans.filters import BAND_SQL
from tallyworks.plans.inputs import (DAY_TAGS_SQL, LABELLED_SQL, LABELLED_TEXT_SQL, STOP_SQL, TAGS_SQL, WORDS_SQL, basket_tags,
                                     labelled_documents, order_tags, stop_words, stored_baskets, text_mark,
                                     user_counts)
from tallyworks.plans.registry import query, rounded
from tallyworks.session import materialize

SALES_SQL = """SELECT p_brand, sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity::BIGINT END)::BIGINT AS sales
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand"""


def sales_by_brand(t):
    """Quantities as text, unreadable on returned lines, summed by brand."""
    amount = F.when(F.col("l_returnflag") == "R", "x").otherwise(F.col("l_quantity").cast("int").cast("string"))
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return stats.sum_through_lookup(t.lineitem, "l_partkey", int_or_zero(amount), brands, "p_brand", "sales")


@query("a01_sum_by_category", SALES_SQL)
def sum_by_category(t):
    return sales_by_brand(t).orderBy(F.desc("sales"), "p_brand")


@query("a02_sum_by_price_band", f"""SELECT price_band, sum(n)::BIGINT AS sales FROM (
    SELECT {BAND_SQL.format('(p_retailprice - 895) * 2')} AS price_band, p_size AS n FROM part
    WHERE p_size % 7 <> 0) b WHERE price_band IS NOT NULL GROUP BY 1""")
def sum_by_band(t):
    rows = t.part.select(((F.col("p_retailprice") - 895) * 2).cast("string").alias("price"),
                         F.when(F.col("p_size") % 7 == 0, "x").otherwise(F.col("p_size").cast("string")).alias("n"))
    return stats.sum_by_price_band(rows, "price", "n")


LETTER_COUNTS_SQL = """SELECT word, count(*) AS count FROM
  (SELECT unnest(regexp_split_to_array(text, '[^a-zA-Z]')) AS word FROM documents) w
  WHERE length(trim(word)) > 0 GROUP BY word"""


@query("a03_word_count", LETTER_COUNTS_SQL)
def word_count(t):
    return text.letter_word_counts(t.texts("documents", "text"), "text")


@query("a04_total_words", f"SELECT sum(count)::BIGINT AS total FROM ({LETTER_COUNTS_SQL}) c")
def total_words(t):
    return text.letter_word_counts(t.texts("documents", "text"), "text").agg(F.sum("count").alias("total"))


@query("a05_title_word_count", f"""SELECT word, count(*) AS count FROM
  (SELECT {WORDS_SQL.format('text')} AS word FROM documents) w
  WHERE length(word) > 1 AND word NOT IN (SELECT * FROM (VALUES {STOP_SQL}) s) GROUP BY word""")
def title_words(t):
    return text.title_word_counts(t.texts("documents", "text"), "text", stop_words(t)).orderBy(F.desc("count"), "word")


@query("a06_value_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def value_counts(t):
    return stats.value_counts(t.events, "event_type").orderBy(F.desc("count"), "event_type")


@query("a07_daily_counts", "SELECT ts::DATE AS day, count(*) AS count FROM events GROUP BY 1")
def daily_counts(t):
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("count")).orderBy("day")


@query("a08_distinct_numbers", """SELECT count(DISTINCT p_brand) AS brands, count(DISTINCT p_type) AS types,
  count(DISTINCT p_size) AS sizes FROM part""")
def distinct_numbers(t):
    return t.part.agg(F.countDistinct("p_brand").alias("brands"), F.countDistinct("p_type").alias("types"),
                      F.countDistinct("p_size").alias("sizes"))


@query("a08_distinct_sketches", """SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, true AS within_bound
  FROM lineitem GROUP BY 1""")
def distinct_by_sketch(t):
    """Distinct parts per flag, merged from a stored sketch per flag and line status, held against the exact numbers."""
    stored = materialize(sketches.distinct_sketches(t.lineitem, ["l_returnflag", "l_linestatus"], "l_partkey"), "sketches")
    found = sketches.distinct_estimates(sketches.merged_sketches(stored, ["l_returnflag"]), to="estimate")
    exact = t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("parts"))
    gap = F.abs(F.col("estimate") - F.col("parts")) / F.col("parts")
    return exact.join(found, "l_returnflag").select(
        "l_returnflag", "parts", (gap <= sketches.distinct_bound()).alias("within_bound"))


@query("a09_distinct_values", "SELECT DISTINCT p_brand FROM part")
def distinct_values(t):
    return t.part.select("p_brand").distinct()


@query("a10_mean_by_group", """SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean_price
  FROM orders GROUP BY 1""")
def mean_by_group(t):
    return t.orders.groupBy("o_orderpriority").agg(rounded(F.avg("o_totalprice"), 4).alias("mean_price")).orderBy("mean_price")


def shipped(t, first, last):
    """Lines shipped from the start of one year to before that of another, as a range that reaches the scan."""
    low, high = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (first, last))
    return t.lineitem.where((F.col("l_shipdate") >= low) & (F.col("l_shipdate") < high))


@query("a11_mean_difference", """SELECT
  round(avg(CASE WHEN year(l_shipdate) = 1997 THEN l_extendedprice - l_quantity * 1000 END), 4) AS mean_1997,
  round(avg(CASE WHEN year(l_shipdate) = 1998 THEN l_extendedprice - l_quantity * 1000 END), 4) AS mean_1998
  FROM lineitem""")
def mean_difference(t):
    gap = F.col("l_extendedprice") - F.col("l_quantity") * 1000
    return shipped(t, 1997, 1999).agg(*[rounded(F.avg(F.when(F.year("l_shipdate") == y, gap)), 4).alias(f"mean_{y}")
                            for y in (1997, 1998)])


@query("a12_mode", "SELECT p_size AS mode FROM part GROUP BY p_size ORDER BY count(*) DESC, p_size LIMIT 1")
def mode(t):
    return quantiles.mode_of(t.part, "p_size")


@query("a13_mode_by_group", """SELECT p_brand, p_size AS mode FROM
  (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY ALL) c
  QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_size) = 1""")
def mode_by_group(t):
    return quantiles.mode_of(t.part, "p_size", ["p_brand"])


@query("a14_median", "SELECT round(quantile_cont(l_extendedprice, 0.5), 6) AS median FROM lineitem")
def median(t):
    return quantiles.exact_quantiles(t.lineitem, ["l_extendedprice"], [0.5]).select(
        rounded(F.col("quantiles")[0]).alias("median"))


FENCES_SQL = """SELECT '{0}' AS "column", quantile_cont({0}, 0.25) AS q1, quantile_cont({0}, 0.75) AS q3
  FROM lineitem"""


@query("a15_iqr_fences", f"""SELECT "column", round(q1, 6) AS q1, round(q3, 6) AS q3,
  round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper
  FROM ({FENCES_SQL.format('l_extendedprice')} UNION ALL {FENCES_SQL.format('l_quantity')}) f""")
def fences(t):
    found = quantiles.iqr_fences(t.lineitem, ["l_extendedprice", "l_quantity"])
    return found.select("column", *[rounded(c).alias(c) for c in ("q1", "q3", "lower", "upper")])


SUMMARY_SQL = """SELECT '{0}' AS "column", count({0}) AS count, round(avg({0}), 4) AS mean, round(stddev({0}), 4) AS std,
  min({0})::DOUBLE AS min, round(quantile_cont({0}, 0.25), 4) AS p25, round(quantile_cont({0}, 0.5), 4) AS p50,
  round(quantile_cont({0}, 0.75), 4) AS p75, max({0})::DOUBLE AS max FROM lineitem"""


@query("a16_numeric_summary", " UNION ALL ".join(
    SUMMARY_SQL.format(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))
def numeric_summary(t):
    found = quantiles.numeric_summary(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return found.select("column", "count", "min", "max",
                        *[rounded(c, 4).alias(c) for c in ("mean", "std", "p25", "p50", "p75")])


TEXT_SUMMARY_SQL = """SELECT '{0}' AS "column", count({0}) AS count, count(DISTINCT {0}) AS "unique",
  (SELECT {0} FROM part GROUP BY {0} ORDER BY count(*) DESC, {0} LIMIT 1) AS top,
  (SELECT count(*) FROM part GROUP BY {0} ORDER BY count(*) DESC LIMIT 1) AS freq FROM part"""


@query("a17_text_summary", " UNION ALL ".join(TEXT_SUMMARY_SQL.format(c) for c in ("p_name", "p_brand", "p_type")))
def text_summary(t):
    return stats.text_summary(t.part, ["p_name", "p_brand", "p_type"])


DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


@query("a18_null_counts", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls FROM ({LABELLED_TEXT_SQL}) d""" for c in DOC_COLUMNS))
def null_counts(t):
    return stats.null_counts(labelled_documents(t, text_mark()))


@query("a19_null_percent", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(100.0 * (count(*) - count({c})) / count(*), 6)::DOUBLE AS null_percent
    FROM ({LABELLED_TEXT_SQL}) d""" for c in DOC_COLUMNS))
def null_percent(t):
    return stats.null_percent(labelled_documents(t, text_mark())).withColumn("null_percent", rounded("null_percent"))


@query("a20_shape", "SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def shape(t):
    return stats.shape(t.lineitem)


CORR_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a21_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
    for a in CORR_COLUMNS for b in CORR_COLUMNS))
def correlations(t):
    return stats.correlations(t.lineitem, CORR_COLUMNS).withColumn("r", rounded("r"))


HISTOGRAM_SQL = """SELECT '{0}' AS "column", least(floor(({0} - low) / ((high - low) / {1})), {2})::INT AS bin,
  count(*) AS count FROM lineitem, (SELECT min({0}) AS low, max({0}) AS high FROM lineitem) l GROUP BY 1, 2"""


@query("a22_histogram", f"""{HISTOGRAM_SQL.format('l_extendedprice', 40, 39)}
  UNION ALL {HISTOGRAM_SQL.format('l_quantity', 20, 19)}""")
def histogram(t):
    return stats.histograms(t.lineitem, {"l_extendedprice": 40, "l_quantity": 20})


@query("a23_box_statistics", """WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
    quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1)
  SELECT l_returnflag, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median,
    round(any_value(q3), 4) AS q3, min(l_extendedprice) AS whisker_low, max(l_extendedprice) AS whisker_high
  FROM lineitem JOIN q USING (l_returnflag)
  WHERE l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY 1""")
def box(t):
    found = quantiles.box_statistics(t.lineitem, "l_extendedprice", "l_returnflag")
    return found.withColumns({c: rounded(c, 4) for c in ("q1", "median", "q3")})


DENSITY_SQL = """SELECT {0} AS year, point, round(x, 4) AS x, round(sum(exp(-0.5 * power((x - centre) / h, 2)) * n)
    / (h * sqrt(2 * pi())) / total, 10) AS density FROM (
  SELECT b.n, point::INT AS point, low + point * (high - low) / 49 AS x, low + (bin + 0.5) * ((high - low) / 200) AS centre, h, total
  FROM (SELECT least(floor((l_extendedprice - low) / ((high - low) / 200)), 199) AS bin, count(*) AS n
        FROM lineitem, (SELECT min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem
                        WHERE year(l_shipdate) = {0}) l WHERE year(l_shipdate) = {0} GROUP BY 1) b,
    (SELECT min(l_extendedprice) AS low, max(l_extendedprice) AS high, count(*) AS total,
            stddev(l_extendedprice) * power(count(*), -0.2) AS h FROM lineitem WHERE year(l_shipdate) = {0}) s,
    (SELECT unnest(range(50)) AS point) g) k
  GROUP BY point, x, h, total"""


@query("a24_density", f"{DENSITY_SQL.format(1997)} UNION ALL {DENSITY_SQL.format(1998)}")
def density(t):
    found = stats.densities(shipped(t, 1997, 1999), "l_extendedprice",
                            {y: F.col("l_shipdate") < F.lit(f"{y + 1}-01-01").cast("timestamp_ntz")
                             if y == 1997 else F.col("l_shipdate") >= F.lit(f"{y}-01-01").cast("timestamp_ntz")
                             for y in (1997, 1998)})
    return found.withColumnRenamed("group", "year").withColumns({"x": rounded("x", 4), "density": rounded("density", 10)})


@query("a25_move_shares", """SELECT round(avg((l_extendedprice > l_quantity * 2000)::INT), 6) AS up,
  round(avg((l_extendedprice < l_quantity * 2000)::INT), 6) AS down,
  round(1 - avg((l_extendedprice <> l_quantity * 2000)::INT), 6) AS same FROM lineitem""")
def move_shares(t):
    listed = t.lineitem.withColumn("listed", F.col("l_quantity") * 2000)
    found = stats.move_shares(listed, "l_extendedprice", "listed", "l_linestatus")
    return found.select(*[rounded(c).alias(c) for c in found.columns])


CHANGE_SQL = """SELECT '{0}' AS "column", round((b - a) / a, 6) AS change FROM (
  SELECT avg(CASE WHEN year(l_shipdate) = 1997 THEN {0} END) AS a,
         avg(CASE WHEN year(l_shipdate) = 1998 THEN {0} END) AS b FROM lineitem) m"""


@query("a26_mean_change", " UNION ALL ".join(CHANGE_SQL.format(c) for c in CORR_COLUMNS))
def mean_change(t):
    year = F.year("l_shipdate")
    return stats.mean_change(shipped(t, 1997, 1999), CORR_COLUMNS, year == 1997, year == 1998).withColumn(
        "change", rounded("change"))


@query("a27_tags_per_month", f"WITH {TAGS_SQL} SELECT month, tag, sum(n)::BIGINT AS count FROM tags GROUP BY ALL")
def tags_per_month(t):
    return tags.tag_counts(order_tags(t), "month")


@query("a28_tag_totals", f"WITH {TAGS_SQL} SELECT tag, sum(n)::BIGINT AS count FROM tags GROUP BY ALL")
def tag_totals(t):
    return tags.tag_counts(basket_tags(t))


ASKED = ["STANDARD", "ECONOMY", "PROMO"]
ASKED_SQL = "WHERE tag1 IN ('STANDARD', 'ECONOMY', 'PROMO')"


@query("a29_cooccurrence", f"WITH {TAGS_SQL} SELECT * FROM pairs {ASKED_SQL}")
def cooccurrence(t):
    return tags.cooccurrence(stored_baskets(t), "o_orderkey", ASKED)


@query("a30_relation_by_totals", f"""WITH {TAGS_SQL}, totals AS (SELECT tag, sum(n) AS n FROM tags GROUP BY 1)
  SELECT tag1, tag2, round(2 * count / (u.n + v.n), 6)::DOUBLE AS relation
  FROM pairs JOIN totals u ON tag1 = u.tag JOIN totals v ON tag2 = v.tag {ASKED_SQL} AND tag1 <> tag2""")
def relation_by_totals(t):
    counts = stored_baskets(t)
    scored = tags.relation_by_totals(tags.cooccurrence(counts, "o_orderkey", ASKED), tags.tag_counts(counts))
    return scored.withColumn("relation", rounded("relation"))


@query("a30_relation_request", f"""WITH {TAGS_SQL}, totals AS (SELECT tag, sum(n) AS n FROM tags GROUP BY 1),
  asked AS (SELECT unnest({ASKED}) AS tag, unnest(range(3))::INT AS i)
  SELECT a.i, b.i AS j, round(2 * coalesce(count, 0) / (u.n + v.n), 6)::DOUBLE AS relation
  FROM asked a JOIN asked b ON a.i <> b.i JOIN totals u ON u.tag = a.tag JOIN totals v ON v.tag = b.tag
  LEFT JOIN pairs ON tag1 = a.tag AND tag2 = b.tag""")
def relation_request(t):
    return tags.relation_request(stored_baskets(t), "o_orderkey", ASKED).withColumn("relation", rounded("relation"))


@query("a31_relation_by_pairs", f"""WITH {TAGS_SQL}, sums AS (SELECT tag1 AS tag, sum(count) AS n FROM pairs GROUP BY 1)
  SELECT tag1, tag2, round(2 * count / (u.n + v.n), 6)::DOUBLE AS relation
  FROM pairs JOIN sums u ON tag1 = u.tag JOIN sums v ON tag2 = v.tag {ASKED_SQL} AND tag1 <> tag2""")
def relation_by_pairs(t):
    scored = tags.relation_by_pairs(stored_baskets(t), "o_orderkey", ASKED)
    return scored.withColumn("relation", rounded("relation"))


def customer_labels(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), "r_name", F.concat_ws("-", "r_name", "n_name").alias("label"))


PLACES_SQL = """orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey"""


@query("a32_sum_by_label", f"""SELECT r_name || '-' || n_name AS label, round(sum(o_totalprice), 2) AS num
  FROM {PLACES_SQL} GROUP BY 1""")
def sum_by_label(t):
    sums = stats.sum_through_lookup(t.orders, "o_custkey", F.col("o_totalprice"), customer_labels(t), "label", "num")
    return sums.withColumn("num", rounded("num", 2))


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("a33_pivot_period_label", f"""SELECT month(o_orderdate)::INT AS month, {', '.join(
    f'''count(*) FILTER (r_name = '{r}') AS "{r}"''' for r in REGIONS)} FROM {PLACES_SQL} GROUP BY 1""")
def pivot(t):
    per_key = t.orders.groupBy("o_custkey", F.month("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return (per_key.join(customer_labels(t).select("o_custkey", "r_name"), "o_custkey")
            .groupBy("month").pivot("r_name", REGIONS).agg(F.sum("n")).fillna(0))


@query("a34_exceed_rates", """SELECT 'o_totalprice' AS metric, round(1 - avg((o_totalprice > 250000)::INT), 6) AS rate FROM orders
  UNION ALL SELECT 'o_custkey', round(1 - avg((o_custkey > 100)::INT), 6) FROM orders""")
def exceed_rates(t):
    return stats.exceed_rates(t.orders, {"o_totalprice": 250000, "o_custkey": 100}).withColumn("rate", rounded("rate"))


@query("a35_label_rates", """SELECT count(*) FILTER (toxic = 0) AS pos_num, count(*) FILTER (toxic = 1) AS neg_num,
  round(avg((toxic = 0)::INT), 6) AS pos_rate, round(avg((toxic = 1)::INT), 6) AS neg_rate FROM labels""")
def label_rates(t):
    found = stats.label_rates(t.labels, F.col("toxic") == 0)
    return found.withColumns({c: rounded(c) for c in ("pos_rate", "neg_rate")})


@query("a36_reply_word_counts", f"""WITH runs AS (SELECT regexp_extract_all(word, '[a-z]+') AS runs FROM
    (SELECT {WORDS_SQL.format('text')} AS word FROM conversations) w
    WHERE length(word) > 1 AND word NOT IN (SELECT * FROM (VALUES {STOP_SQL}) s))
  SELECT runs[1] AS word, count(*) AS count FROM runs WHERE len(runs) = 1 AND length(runs[1]) > 1 GROUP BY 1""")
def reply_words(t):
    return text.reply_word_counts(t.texts("conversations", "text"), "text", stop_words(t), "[a-z]+").orderBy(F.desc("count"), "word")


@query("a37_percent_of_total", """SELECT p_type, count(*) AS count,
  round(count(*) * 100 / (SELECT count(*) FROM part), 6)::DOUBLE AS percent FROM part GROUP BY 1""")
def percent(t):
    return stats.percent_of_total(t.part, "p_type").withColumn("percent", rounded("percent"))


@query("a38_top_lists", f"""WITH {DAY_TAGS_SQL},
  ranked AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY count DESC, tag) AS rank FROM day_tags)
  SELECT day, string_agg(tag, ',' ORDER BY rank) AS names, string_agg(count::VARCHAR, ',' ORDER BY rank) AS counts
  FROM ranked GROUP BY day""")
def top_lists(t):
    lists = stats.top_lists(user_counts(t), "day", "tag", "count")
    return lists.select("day", F.array_join("names", ",").alias("names"),
                        F.array_join(F.col("counts").cast("array<string>"), ",").alias("counts"))
