"""m01 - m14: feature preparation."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyworks.operators import features, quantiles, words as text
from tallyworks.operators.tables import fill_from_neighbours
from tallyworks.plans.inputs import LABELLED_SQL, WEIGHTS_SQL, labelled_documents
from tallyworks.plans.learning import IMPORTANCE_SQL, price_correlations
from tallyworks.plans.registry import query, rounded

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("m01_category_codes", """SELECT p_partkey, (dense_rank() OVER (ORDER BY p_brand) - 1)::INT AS p_brand_code,
  CASE WHEN p_type = 'PROMO' THEN -1 ELSE (dense_rank() OVER (ORDER BY nullif(p_type, 'PROMO')) - 1)::INT END AS p_type_code
  FROM part""")
def category_codes(t):
    rows = t.part.select("p_partkey", "p_brand", F.nullif("p_type", F.lit("PROMO")).alias("p_type"))
    coded = features.category_codes(features.category_codes(rows, "p_brand"), "p_type")
    return coded.select("p_partkey", "p_brand_code", "p_type_code")


@query("m02_one_hot_by_appearance", f"""WITH seen AS (SELECT p_type, row_number() OVER (ORDER BY min(p_partkey)) AS i
    FROM part GROUP BY 1)
  SELECT p_partkey, {', '.join(f'(i = {i})::INT AS p_type_{i}' for i in range(1, 7))} FROM part JOIN seen USING (p_type)""")
def one_hot(t):
    return features.one_hot_by_appearance(t.part.select("p_partkey", "p_type"), "p_type", "p_partkey")


@query("m03_dummies_by_value", f"""SELECT p_partkey,
  {', '.join(f"(p_type = '{v}')::INT AS p_type_{v}" for v in TYPES)} FROM part""")
def dummies(t):
    return features.dummies_by_value(t.part.select("p_partkey", "p_type"), ["p_type"])


TOKENS = "anvil blue bolt cold gear gizmo hot large new old plate red ring rod small widget".split()


@query("m04_dummies_by_token", f"""SELECT p_partkey,
  {', '.join(f"contains(p_name, '{v}')::INT AS p_name_{v}" for v in TOKENS)} FROM part""")
def token_dummies(t):
    return features.dummies_by_token(t.part.select("p_partkey", "p_name"), "p_name")


@query("m05_assemble", "SELECT p_partkey, p_size::DOUBLE AS v0, p_retailprice AS v1 FROM part")
def assemble(t):
    vectors = features.assemble(t.part, ["p_size", "p_retailprice"])
    v = vector_to_array("features")
    return vectors.select("p_partkey", v[0].alias("v0"), v[1].alias("v1"))


@query("m06_quadratic_terms", """SELECT p_partkey, x, round(x * x, 4) AS xx, y, round(x * y, 4) AS xy, round(y * y, 4) AS yy
  FROM (SELECT p_partkey, p_size::DOUBLE AS x, p_retailprice AS y FROM part) p""")
def quadratic(t):
    terms = features.quadratic_terms(features.assemble(t.part, ["p_size", "p_retailprice"]))
    names = ["x", "xx", "y", "xy", "yy"]
    values = [rounded(vector_to_array("terms")[i], 4).alias(n) for i, n in enumerate(names)]
    return terms.select("p_partkey", *values)


@query("m07_standard_scaled", """SELECT l_orderkey, l_linenumber, l_partkey,
  round((l_quantity - mq) / sq, 6) AS l_quantity, round((l_extendedprice - mp) / sp, 6) AS l_extendedprice
  FROM lineitem, (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp,
                         stddev_pop(l_extendedprice) AS sp FROM lineitem) s""")
def scaled(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    found = features.standard_scaled(rows, ["l_quantity", "l_extendedprice"])
    return found.withColumns({c: rounded(c) for c in ("l_quantity", "l_extendedprice")})


POWER_SQL = """SELECT '{0}' AS "column", lam AS power, round(raw, 2) AS fit FROM (
  SELECT lam, -sum(n) / 2.0 * ln(sum(n * z * z) / sum(n) - power(sum(n * z) / sum(n), 2))
      + (lam - 1) * sum(n * ln(1 + x)) AS raw FROM (
    SELECT lam, x, n, CASE WHEN abs(lam) < 1e-12 THEN ln(1 + x) ELSE (power(x + 1, lam) - 1) / lam END AS z
    FROM (SELECT {0}::DOUBLE AS x, count(*) AS n FROM lineitem GROUP BY 1) v,
      (SELECT unnest(range(-2000, 2001)) / 1000.0::DOUBLE AS lam) g) t
  GROUP BY lam) f ORDER BY raw DESC LIMIT 1"""


@query("m08_best_powers", f"""SELECT * FROM ({POWER_SQL.format('l_quantity')}) UNION ALL
  SELECT * FROM ({POWER_SQL.format('l_extendedprice')})""")
def best_powers(t):
    found = features.best_powers(t.lineitem, ["l_quantity", "l_extendedprice"])
    return found.drop("at_end").withColumn("fit", rounded("fit", 2))


POWERED_SQL = """(CASE WHEN abs(power_{0}) < 1e-12 THEN ln(1 + {0})
    ELSE (power({0} + 1, power_{0}) - 1) / power_{0} END)"""


@query("m08_power_transform", f"""WITH powered AS (SELECT l_orderkey, l_linenumber, l_partkey,
    {POWERED_SQL.format('l_quantity')} AS q, {POWERED_SQL.format('l_extendedprice')} AS p
    FROM lineitem, (SELECT power AS power_l_quantity FROM ({POWER_SQL.format('l_quantity')})),
      (SELECT power AS power_l_extendedprice FROM ({POWER_SQL.format('l_extendedprice')})))
  SELECT l_orderkey, l_linenumber, l_partkey, round((q - avg(q) OVER ()) / stddev_pop(q) OVER (), 6) AS l_quantity,
    round((p - avg(p) OVER ()) / stddev_pop(p) OVER (), 6) AS l_extendedprice FROM powered""")
def power_transform(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    found = features.power_transformed(rows, ["l_quantity", "l_extendedprice"])
    return found.withColumns({c: rounded(c) for c in ("l_quantity", "l_extendedprice")})


@query("m09_random_split", """SELECT p_partkey, CASE WHEN ('0x' || substr(md5(p_partkey::VARCHAR), 1, 8))::BIGINT % 10000 < 8000
  THEN 'train' ELSE 'test' END AS part FROM part""")
def random_split(t):
    part = F.when(features.in_training_part(F.col("p_partkey")), "train").otherwise("test")
    return t.part.select("p_partkey", part.alias("part"))


# Fences this near leave rows outside them in the test tables.
NEAR = 0.3
SIDE_SQL = """SELECT '{0}' AS "column", count(*) FILTER ({0} > q3 + 0.3 * (q3 - q1)) AS above,
  count(*) FILTER ({0} < q1 - 0.3 * (q3 - q1)) AS below
  FROM lineitem, (SELECT quantile_cont({0}, 0.25) AS q1, quantile_cont({0}, 0.75) AS q3 FROM lineitem) q"""


@query("m10_outlier_counts", f"{SIDE_SQL.format('l_extendedprice')} UNION ALL {SIDE_SQL.format('l_quantity')}")
def outlier_counts(t):
    return quantiles.outlier_counts(t.lineitem, ["l_extendedprice", "l_quantity"], NEAR)


PASS_SQL = """SELECT r.* FROM {1} r, (SELECT quantile_cont({0}, 0.25) AS q1, quantile_cont({0}, 0.75) AS q3 FROM {1}) q
  WHERE {0} BETWEEN q1 - 0.3 * (q3 - q1) AND q3 + 0.3 * (q3 - q1)"""


@query("m11_drop_outliers", f"""WITH a AS ({PASS_SQL.format('l_extendedprice', 'lineitem')}),
  b AS ({PASS_SQL.format('l_quantity', 'a')}), c AS ({PASS_SQL.format('l_tax', 'b')})
  SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_tax FROM c""")
def drop_outliers(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_tax")
    return quantiles.drop_outliers(rows, ["l_extendedprice", "l_quantity", "l_tax"], NEAR)


@query("m11_removed_counts", f"""WITH a AS ({PASS_SQL.format('l_extendedprice', 'lineitem')}),
  b AS ({PASS_SQL.format('l_quantity', 'a')}), c AS ({PASS_SQL.format('l_tax', 'b')}),
  n AS (SELECT (SELECT count(*) FROM lineitem) AS n, (SELECT count(*) FROM a) AS na, (SELECT count(*) FROM b) AS nb,
    (SELECT count(*) FROM c) AS nc)
  SELECT 'l_extendedprice' AS "column", n - na AS removed FROM n UNION ALL SELECT 'l_quantity', na - nb FROM n
  UNION ALL SELECT 'l_tax', nb - nc FROM n""")
def removed_counts(t):
    return quantiles.removed_counts(t.lineitem, ["l_extendedprice", "l_quantity", "l_tax"], NEAR)


@query("m12_fill_from_neighbours", f"""WITH d AS (SELECT doc_id, nullif(lang, 'es') AS lang, source,
    CASE WHEN toxic IS NULL THEN NULL ELSE n_chars // 1000 END AS grade FROM ({LABELLED_SQL}) l),
  counts AS (SELECT lang, source, grade, count(*) AS n FROM d WHERE grade IS NOT NULL AND lang IS NOT NULL GROUP BY ALL),
  modes AS (SELECT lang, source, grade AS local FROM counts
    QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY n DESC, grade) = 1),
  overall AS (SELECT grade AS common FROM d WHERE grade IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, grade LIMIT 1)
  SELECT doc_id, lang, source, CASE WHEN lang IS NULL THEN grade ELSE coalesce(grade, local, common) END AS grade
  FROM d LEFT JOIN modes USING (lang, source), overall""")
def fill(t):
    grade = F.when(F.col("toxic").isNotNull(), F.expr("n_chars div 1000"))
    rows = labelled_documents(t).select("doc_id", F.nullif("lang", F.lit("es")).alias("lang"), "source",
                                        grade.alias("grade"))
    return fill_from_neighbours(rows, "grade", ["lang", "source"])


@query("m13_important_features", f"""SELECT feature, round(importance, 9) AS importance FROM {IMPORTANCE_SQL}
  WHERE importance >= (SELECT median(importance) FROM {IMPORTANCE_SQL})""")
def important(t):
    found = price_correlations(t)
    median = quantiles.exact_quantiles(found, ["importance"], [0.5]).first()["quantiles"][0]
    return features.important_features(found, median).withColumn("importance", rounded("importance", 9))


@query("m14_text_weights", f"WITH {WEIGHTS_SQL} SELECT doc_id, word, round(weight, 6) AS weight FROM weights")
def text_weights(t):
    weights, _ = text.text_weights(t.texts("documents", "doc_id", "text"), "doc_id", "text")
    return weights.withColumn("weight", rounded("weight"))
