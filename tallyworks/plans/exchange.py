"""s01 - s15: readers, writers and extraction from replies and pages."""

from pyspark.sql import functions as F

from tallyworks.functions.cells import unwrap_jsonp
from tallyworks.operators import words as text
from tallyworks.operators.statistics import value_counts
from tallyworks.plans.inputs import LABELLED_SQL, WEIGHTS_SQL, labelled_documents
from tallyworks.plans.registry import query, rounded
from tallyworks.session import discard, fresh_path
from tallyworks.sources import documents, files, models, pages

PART_SCHEMA = ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
               "p_retailprice double")
PART_SQL = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"


@query("s01_read_lines", """SELECT value, count(*) AS n FROM
  (SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS value FROM documents) l GROUP BY 1""")
def read_lines(t):
    path = fresh_path(t.spark, "lines")
    t.documents.select("text").write.text(path)
    return files.read_lines(t.spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("s02_csv_skip_header", PART_SQL)
def csv_skip_header(t):
    path = fresh_path(t.spark, "csv")
    files.write_csv(t.part, path)
    return files.read_csv(t.spark, path, PART_SCHEMA)


@query("s03_csv_inferred", "SELECT p_partkey, p_size, p_retailprice, p_type FROM part")
def csv_inferred(t):
    path = fresh_path(t.spark, "csv")
    files.write_csv(t.part.select("p_partkey", "p_size", "p_retailprice", "p_type"), path, sep=" ")
    found = files.read_csv(t.spark, path, sep=" ")
    return found.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query("s04_csv_legacy_encoding", "SELECT p_partkey, '级别' || p_type AS level FROM part")
def csv_gbk(t):
    path = fresh_path(t.spark, "gbk")
    levels = t.part.select("p_partkey", F.concat(F.lit("级别"), "p_type").alias("level"))
    files.write_csv(levels, path, encoding="GBK")
    return files.read_csv(t.spark, path, "p_partkey bigint, level string", encoding="GBK")


@query("s05_many_csv_files", f"""{PART_SQL.replace(' FROM', ', NULL::VARCHAR AS note FROM')} WHERE p_size <= 25
  UNION ALL {PART_SQL.replace(' FROM', ", 'long' AS note FROM")} WHERE p_size > 25""")
def many_csv_files(t):
    first, second = fresh_path(t.spark, "csv"), fresh_path(t.spark, "csv")
    files.write_csv(t.part.where("p_size <= 25").repartition(4), first)
    files.write_csv(t.part.where("p_size > 25").withColumn("note", F.lit("long")).repartition(4), second)
    return files.union_tables([files.read_csv(t.spark, first, PART_SCHEMA),
                               files.read_csv(t.spark, second, PART_SCHEMA + ", note string")])


@query("s06_load_collection", "SELECT doc_id, lang, source, n_chars FROM documents")
def load_collection(t):
    return files.load(t.spark, f"{t.folder}/documents.parquet").select("doc_id", "lang", "source", "n_chars")


def varied_documents(t):
    """Three shapes of documents in one folder; ids, sizes and makers change their types."""
    path = fresh_path(t.spark, "varied")
    shapes = [t.part.select(F.col("p_partkey").alias("id"), F.lit("part").alias("kind"), F.col("p_size").alias("size"),
                            F.struct(F.col("p_brand").alias("brand")).alias("maker")),
              t.nation.select(F.col("n_name").alias("id"), F.lit("nation").alias("kind"), F.col("n_regionkey").alias("region")),
              t.supplier.select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind"), F.col("s_name").alias("size"),
                                F.struct(F.col("s_nationkey").alias("brand")).alias("maker"))]
    for rows in shapes:
        rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(path)
    return documents.read_documents(t.spark, path)


@query("s06_documents_of_any_schema", """SELECT 'part' AS kind, p_partkey::VARCHAR AS id, 'BIGINT' AS id_type, p_size::VARCHAR AS size,
    p_brand AS brand, NULL::BIGINT AS region FROM part
  UNION ALL SELECT 'nation', n_name, 'STRING', NULL, NULL, n_regionkey::BIGINT FROM nation
  UNION ALL SELECT 'supplier', s_suppkey::VARCHAR, 'BIGINT', s_name, s_nationkey::VARCHAR, NULL FROM supplier""")
def documents_of_any_schema(t):
    """Fields found in the documents themselves; those of changing type keep each value as it is."""
    found = documents.flattened(varied_documents(t))
    return found.select("kind", documents.as_text(F.col("id")).alias("id"), documents.type_name(F.col("id")).alias("id_type"),
                        documents.as_text(F.col("size")).alias("size"), documents.as_text(F.col("maker.brand")).alias("brand"),
                        F.col("region").cast("bigint").alias("region"))


@query("s06_field_types", """WITH n AS (SELECT (SELECT count(*) FROM part) AS p, (SELECT count(*) FROM nation) AS n,
    (SELECT count(*) FROM supplier) AS s)
  SELECT field, type, documents FROM n, LATERAL (VALUES ('id', 'BIGINT', p + s), ('id', 'STRING', n), ('kind', 'STRING', p + n + s),
    ('size', 'BIGINT', p), ('size', 'STRING', s), ('maker', 'OBJECT', p + s), ('maker.brand', 'STRING', p),
    ('maker.brand', 'BIGINT', s), ('region', 'BIGINT', n)) v(field, type, documents)""")
def field_types(t):
    return documents.field_types(varied_documents(t))


@query("s07_append_rows", "SELECT p_type, p_size, count(*) AS count FROM part GROUP BY ALL")
def append_rows(t):
    path = fresh_path(t.spark, "counts")
    counts = t.part.groupBy("p_type", "p_size").agg(F.count(F.lit(1)).alias("count"))
    files.append(counts.where("p_size <= 25"), path)
    files.append(counts.where("p_size > 25"), path)
    return files.load(t.spark, path)


@query("s08_write_csv", PART_SQL)
def write_csv(t):
    path = fresh_path(t.spark, "csv")
    files.write_csv(t.part, path, sep=" ")
    return files.read_csv(t.spark, path, PART_SCHEMA, sep=" ")


@query("s09_write_pairs", "SELECT p_brand || chr(9) || count(*)::VARCHAR AS value FROM part GROUP BY p_brand")
def write_pairs(t):
    path = fresh_path(t.spark, "pairs")
    files.write_pairs(value_counts(t.part, "p_brand"), path)
    return files.read_lines(t.spark, path)


@query("s10_copy_with_metric", f"SELECT *, doc_id AS _id FROM ({LABELLED_SQL}) d WHERE quality IS NOT NULL")
def copy_with_metric(t):
    return files.keep_with_metric(labelled_documents(t), "quality", "doc_id")


@query("s11_flatten_json", """SELECT event_id, regexp_extract(props, '([0-9]+)', 1)::BIGINT AS view FROM events
  WHERE event_type <> 'error'""")
def flatten_json(t):
    return replies(t).where("parsed").select("event_id", "view")


def replies(t):
    """Event replies as nested JSON; an error event answers with a page instead."""
    body = F.concat(F.lit('{"data": {"stat": '), F.col("props"), F.lit("}}"))
    reply = F.when(F.col("event_type") == "error", F.lit("<html>")).otherwise(body)
    return pages.flatten_json(t.events.select("event_id", reply.alias("reply")), "reply",
                              "data struct<stat: struct<k: bigint>>", {"view": "data.stat.k"})


@query("s11_malformed_replies", """SELECT count(*) AS replies, count(*) FILTER (event_type = 'error') AS malformed FROM events""")
def malformed(t):
    return pages.malformed_count(replies(t))


@query("s12_unwrap_jsonp", "SELECT event_id, regexp_extract(props, '([0-9]+)', 1)::BIGINT AS k FROM events")
def jsonp(t):
    body = unwrap_jsonp(F.concat(F.lit("callback("), F.col("props"), F.lit(")")))
    return t.events.select("event_id", F.from_json(body, "k bigint")["k"].alias("k"))


HTML_FIELDS = {"title": "<title>([^<]*)</title>", "lang": '<html lang="([^"]*)"', "heading": "<h1>([^<]*)</h1>",
               "advert": '<div class="ad">([^<]*)</div>'}


@query("s13_html_fields", "SELECT page_id, " + ", ".join(
    f"CASE WHEN regexp_matches(html, '{p}') THEN regexp_extract(html, '{p}', 1) END AS {n}"
    for n, p in HTML_FIELDS.items()) + " FROM pages")
def html_fields(t):
    return pages.html_fields(t.pages.select("page_id", "html"), "html", HTML_FIELDS).drop("html")


@query("s14_links", """SELECT page_id, unnest(range(len(l)))::INT AS position, unnest(l) AS link FROM
  (SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS l FROM pages) p""")
def page_links(t):
    return pages.links(t.pages.select("page_id", "html"), "html")


@query("s15_saved_model", f"WITH {WEIGHTS_SQL} SELECT doc_id, word, round(weight, 6) AS weight FROM weights")
def saved_model(t):
    path = fresh_path(t.spark, "text-model")
    weights, idf = text.text_weights(t.texts("documents", "doc_id", "text"), "doc_id", "text")
    models.save_text_model(weights, "doc_id", idf, path)
    for stored in (weights, idf):
        discard(stored)
    return models.load_text_model(t.spark, path).weights().withColumn("weight", rounded("weight"))
