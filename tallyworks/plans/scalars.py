"""f01 - f27: cell functions on texts and numbers derived from the tables."""

from pyspark.sql import functions as F

from tallyworks.functions import cells
from tallyworks.operators import cutting
from tallyworks.plans.inputs import CUT_SQL
from tallyworks.plans.registry import query, rounded
from tallyworks.sources.pages import id_names



def event_digits():
    return F.regexp_extract("props", "([0-9]+)", 1)


@query("f01_int_or_zero", """SELECT event_id, CASE WHEN event_type = 'error' THEN 0
  ELSE regexp_extract(props, '([0-9]+)', 1)::BIGINT END AS k FROM events""")
def int_or_zero(t):
    given = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.concat(F.lit(" "), event_digits()))
    return t.events.select("event_id", cells.int_or_zero(given).alias("k"))


@query("f02_pair_or_zero", """SELECT p_partkey, CASE WHEN p_size % 5 = 0 OR p_size % 7 = 0 THEN 0.0
    ELSE p_retailprice END::DOUBLE AS price,
  CASE WHEN p_size % 5 = 0 OR p_size % 7 = 0 THEN 0 ELSE p_size END::BIGINT AS count FROM part""")
def pair_or_zero(t):
    price = F.when(F.col("p_size") % 5 == 0, "-").otherwise(F.col("p_retailprice").cast("string"))
    count = F.when(F.col("p_size") % 7 == 0, "x").otherwise(F.col("p_size").cast("string"))
    return t.part.select("p_partkey", cells.pair_or_zero(price, count).alias("p")).select(
        "p_partkey", "p.price", "p.count")


@query("f03_to_number", """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events""")
def to_number(t):
    given = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    return t.events.select("event_id", cells.to_number(given).alias("value"))


@query("f04_typed_text", """SELECT event_id,
  CASE event_type WHEN 'view' THEN 'long' WHEN 'click' THEN 'double' WHEN 'error' THEN 'long'
    WHEN 'purchase' THEN 'double' ELSE 'text' END AS kind,
  CASE event_type WHEN 'view' THEN regexp_extract(props, '([0-9]+)', 1)::BIGINT WHEN 'error' THEN 0 END AS long,
  CASE event_type WHEN 'click' THEN value
    WHEN 'purchase' THEN regexp_extract(props, '([0-9]+)', 1)::DOUBLE * 10 END AS double,
  CASE WHEN event_type = 'signup' THEN event_type END AS text FROM events""")
def typed_text(t):
    kind = F.col("event_type")
    given = (F.when(kind == "view", event_digits()).when(kind == "click", F.col("value").cast("string"))
             .when(kind == "error", "-").when(kind == "purchase", F.concat(event_digits(), F.lit("e1")))
             .otherwise(kind))
    return t.events.select("event_id", cells.typed_text(given).alias("v")).select("event_id", "v.*")


@query("f05_split_non_letters", """SELECT doc_id, len(p) AS pieces, list_sum([length(x) for x in p])::BIGINT AS letters
  FROM (SELECT doc_id, regexp_split_to_array(text, '[^a-zA-Z]') AS p FROM documents) d""")
def split_non_letters(t):
    pieces = cells.letter_words(F.col("text"))
    return t.texts("documents", "doc_id", "text").select("doc_id", pieces.alias("p")).select(
        "doc_id", F.size("p").cast("bigint").alias("pieces"),
        F.aggregate("p", F.lit(0).cast("bigint"), lambda n, x: n + F.length(x)).alias("letters"))


@query("f06_split_list", """SELECT p_partkey, string_split(p_name, ' ')[1] AS first, string_split(p_name, ' ')[2] AS second,
  len(string_split(p_name, ' '))::INT AS parts FROM part""")
def split_list(t):
    return t.part.select("p_partkey", F.split("p_name", " ").alias("s")).select(
        "p_partkey", F.get("s", F.lit(0)).alias("first"), F.get("s", F.lit(1)).alias("second"),
        F.size("s").alias("parts"))


@query("f07_before_marker", "SELECT p_partkey, string_split(p_name, ' ')[1] AS name FROM part")
def before_marker(t):
    return t.part.select("p_partkey", cells.before(F.col("p_name"), " ").alias("name"))


@query("f08_strip_unit", "SELECT p_partkey, replace(p_size::VARCHAR || '㎡', '㎡', '') AS size FROM part")
def strip_unit(t):
    sized = F.concat(F.col("p_size").cast("string"), F.lit("㎡"))
    return t.part.select("p_partkey", cells.strip_unit(sized, "㎡").alias("size"))


@query("f09_squeeze", """SELECT doc_id, md5(regexp_replace(text, '[ \\n\\t]', '', 'g')) AS digest,
  length(regexp_replace(text, '[ \\n\\t]', '', 'g')) AS n FROM documents""")
def squeeze(t):
    squeezed = cells.squeeze(F.col("text"))
    return t.texts("documents", "doc_id", "text").select("doc_id", F.md5(squeezed).alias("digest"), F.length(squeezed).cast("bigint").alias("n"))


@query("f10_lower_case", "SELECT doc_id, md5(lower(text)) AS digest FROM documents")
def lower_case(t):
    return t.texts("documents", "doc_id", "text").select("doc_id", F.md5(F.lower("text")).alias("digest"))


@query("f11_script_runs", """SELECT doc_id, md5(array_to_string(regexp_extract_all(text, '[a-z]+'), ' ')) AS digest
  FROM documents""")
def script_runs(t):
    return t.texts("documents", "doc_id", "text").select("doc_id", F.md5(cells.script_runs(F.col("text"), "[a-z]+")).alias("digest"))


@query("f12_cut_words", f"""SELECT doc_id, len(w) AS words, md5(array_to_string(w, ' ')) AS digest FROM
  (SELECT doc_id, {CUT_SQL.format('text')} AS w FROM documents) d""")
def cut_words(t):
    return t.texts("documents", "doc_id", "text").select("doc_id", cells.words(F.col("text")).alias("w")).select(
        "doc_id", F.size("w").cast("bigint").alias("words"), F.md5(F.array_join("w", " ")).alias("digest"))


@query("f12_dictionary_cut", "SELECT p_partkey, p_name AS words FROM part")
def dictionary_cut(t):
    """Part names written without spaces, cut again by a dictionary of the words and their counts."""
    dictionary = t.part.select(F.explode(F.split("p_name", " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    joined = t.part.select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("")).alias("words"))
    found = cutting.cut_texts(joined, "words", cutting.read_dictionary(dictionary), "[a-z]+")
    return found.select("p_partkey", F.array_join(cutting.split_words(F.col("words")), " ").alias("words"))


@query("f13_range_midpoint", """SELECT o_orderkey, CASE o_orderstatus
    WHEN 'F' THEN ((o_custkey % 9000 + 1000) + (o_orderkey % 9000 + 1000)) / 2
    WHEN 'O' THEN o_custkey % 9000 + 1000 END::DOUBLE AS speed FROM orders""")
def range_midpoint(t):
    low = (F.col("o_custkey") % 9000 + 1000).cast("string")
    high = (F.col("o_orderkey") % 9000 + 1000).cast("string")
    given = (F.when(F.col("o_orderstatus") == "F", F.concat_ws("-", low, high))
             .when(F.col("o_orderstatus") == "O", low).otherwise("about 5000"))
    return t.orders.select("o_orderkey", cells.range_midpoint(given).alias("speed"))


@query("f14_year_prefix", """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate) END::INT AS year
  FROM orders""")
def year_prefix(t):
    given = F.when(F.col("o_orderstatus") == "P", "未上牌").otherwise(F.date_format("o_orderdate", "yyyy.MM"))
    return t.orders.select("o_orderkey", cells.year_prefix(given).alias("year"))


@query("f15_leading_small_int", """SELECT p_partkey, CASE WHEN p_size >= 10 THEN p_size END::TINYINT AS years FROM part""")
def leading_small_int(t):
    given = F.concat(F.col("p_size").cast("string"), F.lit("年"))
    return t.part.select("p_partkey", cells.leading_small_int(given).alias("years"))


@query("f16_named_numbers", """SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN p_size END::BIGINT AS rooms,
  CASE WHEN p_type <> 'PROMO' THEN p_partkey % 4 END AS halls, CASE WHEN p_type <> 'PROMO' THEN 1 END::BIGINT AS kitchens,
  CASE WHEN p_type <> 'PROMO' THEN p_partkey % 3 END AS baths FROM part""")
def named_numbers(t):
    layout = F.concat(F.col("p_size").cast("string"), F.lit("室"), (F.col("p_partkey") % 4).cast("string"),
                      F.lit("厅1厨"), (F.col("p_partkey") % 3).cast("string"), F.lit("卫"))
    given = F.when(F.col("p_type") == "PROMO", "车位").otherwise(layout)
    names = ["rooms", "halls", "kitchens", "baths"]
    return t.part.select("p_partkey", *cells.named_numbers(given, r"(\d+)室(\d+)厅(\d+)厨(\d+)卫", names))


@query("f17_to_time", """SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS at
  FROM events""")
def to_time(t):
    given = F.when(F.col("event_type") == "error", "n/a").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.events.select("event_id", cells.to_time(given).cast("timestamp_ntz").alias("at"))


@query("f18_month", """SELECT o_orderkey, month(o_orderdate)::INT AS month, month(o_orderdate)::INT AS digits FROM orders""")
def month(t):
    return t.orders.select("o_orderkey", F.month("o_orderdate").alias("month"),
                           cells.month_digits(F.date_format("o_orderdate", "yyyyMMdd")).alias("digits"))


KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


@query("f19_guarded_ratio", f"""SELECT {', '.join(KEYS)}, l_extendedprice / (l_quantity - 1 + 1) AS coin,
  l_discount / (l_quantity - 1 + 1) AS "like" FROM lineitem""")
def guarded_ratio(t):
    views = F.col("l_quantity") - 1
    return t.lineitem.select(*KEYS, cells.guarded_ratio(F.col("l_extendedprice"), views).alias("coin"),
                             cells.guarded_ratio(F.col("l_discount"), views).alias("like"))


@query("f20_plain_ratio", f"""SELECT {', '.join(KEYS)}, CASE WHEN l_quantity <> 1
  THEN l_extendedprice / (l_quantity - 1) END AS coin FROM lineitem""")
def plain_ratio(t):
    ratio = cells.plain_ratio(F.col("l_extendedprice"), F.col("l_quantity") - 1)
    return t.lineitem.select(*KEYS, ratio.alias("coin"))


@query("f21_interaction", f"""SELECT {', '.join(KEYS)}, round((l_discount + l_tax) / ln(l_quantity - 1 + 2), 6) AS interact
  FROM lineitem""")
def interaction(t):
    score = cells.interaction(F.col("l_discount"), F.col("l_tax"), F.col("l_quantity") - 1)
    return t.lineitem.select(*KEYS, rounded(score).alias("interact"))


@query("f22_row_errors", f"""SELECT {', '.join(KEYS)}, abs(l_extendedprice / 2000 - (l_quantity - 1)) AS abs_err,
  CASE WHEN l_quantity <> 1 THEN abs(l_extendedprice / 2000 - (l_quantity - 1)) / (l_quantity - 1) END AS ape
  FROM lineitem""")
def row_errors(t):
    return t.lineitem.select(*KEYS, *cells.errors(F.col("l_quantity") - 1, F.col("l_extendedprice") / 2000))


def part_options(t):
    """Each part with a reply that lists its options as id and name."""
    item = lambda number, name: F.concat(F.lit('{"optionid": '), number.cast("string"), F.lit(', "optionname": "'),
                                         F.col(name), F.lit('"}'))
    reply = F.concat(F.lit('{"result": ['), item(F.col("p_size"), "p_type"), F.lit(", "),
                     item(F.col("p_size") + 100, "p_brand"), F.lit("]}"))
    schema = "result array<struct<optionid: bigint, optionname: string>>"
    return t.part.select("p_partkey", F.from_json(reply, schema)["result"].alias("options"))


@query("f23_join_list", """SELECT p_partkey, p_size::VARCHAR || '、' || (p_size + 100)::VARCHAR AS ids,
  p_type || '、' || p_brand AS names FROM part""")
def join_list(t):
    ids = F.transform("options", lambda o: o["optionid"].cast("string"))
    return part_options(t).select("p_partkey", cells.join_list(ids).alias("ids"),
                                  cells.join_list(F.col("options.optionname")).alias("names"))


@query("f23_option_names", """SELECT optionid, min(optionname) AS optionname FROM (
  SELECT p_size::BIGINT AS optionid, p_type AS optionname FROM part
  UNION ALL SELECT p_size + 100, p_brand FROM part) o GROUP BY 1""")
def option_names(t):
    return id_names(part_options(t), "options", "optionid", "optionname")


@query("f24_swap_separator", "SELECT o_orderkey, strftime(o_orderdate, '%Y.%m') AS registered FROM orders")
def swap_separator(t):
    given = F.date_format("o_orderdate", "yyyy/MM")
    return t.orders.select("o_orderkey", cells.swap_separator(given).alias("registered"))


@query("f25_clean_id", """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_partkey::VARCHAR
    ELSE 'b1x' || p_partkey::VARCHAR END AS id,
  CASE WHEN p_size % 2 = 0 THEN 'https://example.org/video/av' || p_partkey::VARCHAR
    ELSE 'https://example.org/video/BV1x' || p_partkey::VARCHAR END AS link FROM part""")
def clean_id(t):
    number = F.col("p_partkey").cast("string")
    even = F.col("p_size") % 2 == 0
    loose = F.when(even, F.concat(F.lit("AV"), number, F.lit("va"))).otherwise(F.concat(F.lit("vab1x"), number))
    shown = F.when(even, number).otherwise(F.concat(F.lit("BV1x"), number))
    return t.part.select("p_partkey", cells.clean_id(loose).alias("id"),
                         cells.id_link(shown, "https://example.org/video/").alias("link"))


@query("f26_position_pair", """SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN (page_id + 0.5)::VARCHAR END AS longitude,
  CASE WHEN page_id % 3 <> 0 THEN length(url)::VARCHAR END AS latitude FROM pages""")
def position_pair(t):
    literal = F.concat(F.lit("\nresblockPosition:'"), (F.col("page_id") + F.lit(0.5)).cast("string"), F.lit(","),
                       F.length("url").cast("string"), F.lit("'"))
    given = F.when(F.col("page_id") % 3 == 0, F.col("html")).otherwise(F.concat("html", literal))
    return t.pages.select("page_id", given.alias("page")).select("page_id", *cells.position_pair(F.col("page")))


@query("f27_skip_label", "SELECT p_partkey, p_name AS kind FROM part")
def skip_label(t):
    given = F.concat(F.lit("房屋户型  "), F.col("p_name"), F.lit("  "))
    return t.part.select("p_partkey", cells.skip_label(given).alias("kind"))
