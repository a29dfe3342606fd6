"""w01 - w05 and t01 - t08: windows, sorts and top rows."""

from pyspark.sql import functions as F

from tallyworks.operators import ordering, quantiles, statistics as stats
from tallyworks.operators.tables import match_text
from tallyworks.operators.words import letter_word_counts
from tallyworks.plans.aggregates import LETTER_COUNTS_SQL, SALES_SQL, sales_by_brand
from tallyworks.plans.inputs import DAY_TAGS_SQL, user_counts
from tallyworks.plans.learning import IMPORTANCE_SQL, price_correlations
from tallyworks.plans.registry import query, rounded


@query("w01_top_per_group", f"""WITH {DAY_TAGS_SQL} SELECT day, tag, count,
  row_number() OVER (PARTITION BY day ORDER BY count DESC, tag)::INT AS rank FROM day_tags QUALIFY rank <= 3""")
def top_per_group(t):
    return stats.top_per_group(user_counts(t), "day", [F.desc("count"), "tag"], 3)


@query("w02_sequence_number", f"""SELECT row_number() OVER (ORDER BY count DESC, word) AS row_number, word, count
  FROM ({LETTER_COUNTS_SQL}) c""")
def sequence_number(t):
    return ordering.number_rows(letter_word_counts(t.texts("documents", "text"), "text"), [F.desc("count"), "word"])


@query("w03_rebuild_index", """SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS index, o_orderkey
  FROM orders WHERE o_orderstatus = 'F'""")
def rebuild_index(t):
    kept = t.orders.where("o_orderstatus = 'F'").select("o_orderkey")
    return ordering.number_rows(kept, ["o_orderkey"], "index", first=0)


@query("w04_exceed_rate_per_row", """SELECT o_orderkey, o_totalprice,
  round(cume_dist() OVER (ORDER BY o_totalprice), 9) AS rate FROM orders""")
def exceed_rate_per_row(t):
    rows = stats.exceed_rate_per_row(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice")
    return rows.withColumn("rate", rounded("rate", 9))


@query("w05_blend_ranks", """WITH best AS (SELECT p_partkey, p_retailprice, p_size FROM part
    ORDER BY p_retailprice DESC, p_partkey DESC LIMIT 20),
  placed AS (SELECT *, row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1 AS position,
    row_number() OVER (ORDER BY p_size, p_partkey) - 1 AS by_views FROM best),
  blended AS (SELECT a.*, 0.99 * a.position + 0.01 * b.position AS blend
    FROM placed a JOIN placed b ON a.position = b.by_views)
  SELECT p_partkey, p_size, row_number() OVER (ORDER BY blend DESC, position DESC)::INT AS place FROM blended""")
def blend_ranks(t):
    return stats.blend_ranks(t.part, "p_retailprice", "p_size", "p_partkey").select("p_partkey", "p_size", "place")


@query("t01_global_sort", "SELECT p_partkey, p_retailprice FROM part")
def global_sort(t):
    return t.part.select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey")


@query("t02_first_after_sort", f"{SALES_SQL} ORDER BY sales DESC, p_brand LIMIT 10")
def first_after_sort(t):
    return sales_by_brand(t).orderBy(F.desc("sales"), "p_brand").limit(10)


@query("t03_top_with_filter", """SELECT p_name, count(*) AS count FROM part WHERE regexp_matches(p_name, 'ring')
  GROUP BY 1 ORDER BY count DESC, p_name LIMIT 10""")
def top_with_filter(t):
    counts = stats.value_counts(match_text(t.part, "p_name", "ring"), "p_name")
    return counts.orderBy(F.desc("count"), "p_name").limit(10)


@query("t04_top_of_period", f"""WITH {DAY_TAGS_SQL} SELECT tag, count FROM day_tags WHERE day = 7
  ORDER BY count DESC, tag LIMIT 3""")
def top_of_period(t):
    on_day = user_counts(t).where("day = 7").select("tag", "count")
    return on_day.orderBy(F.desc("count"), "tag").limit(3)


@query("t05_series_of_tag", f"WITH {DAY_TAGS_SQL} SELECT day, count FROM day_tags WHERE tag = 'click'")
def series_of_tag(t):
    return user_counts(t).where("tag = 'click'").select("day", "count").orderBy("day")


# The cap is the question here; without one all rows are scanned.
ASKED_ROWS = 1000


@query("t06_row_cap", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT {ASKED_ROWS}")
def row_cap(t):
    return ordering.first_rows(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], ASKED_ROWS)


@query("t07_sorted_importances", f"SELECT feature, round(importance, 9) AS importance FROM {IMPORTANCE_SQL}")
def sorted_importances(t):
    return price_correlations(t).withColumn("importance", rounded("importance", 9)).orderBy(
        F.desc("importance"), "feature")


# Fences this near leave rows on both sides of the test prices.
NEAR = 0.3


@query("t08_first_beyond_fence", f"""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1,
    quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem),
  sides AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
    CASE WHEN l_extendedprice > q3 + {NEAR} * (q3 - q1) THEN 'above'
         WHEN l_extendedprice < q1 - {NEAR} * (q3 - q1) THEN 'below' END AS side FROM lineitem, q)
  SELECT * FROM sides WHERE side IS NOT NULL QUALIFY row_number() OVER (
    PARTITION BY side ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) <= 5""")
def beyond_fence(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return quantiles.beyond_fence(rows, "l_extendedprice", rows.columns, 5, NEAR)
