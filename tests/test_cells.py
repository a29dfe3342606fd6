"""Hand-worked values for cell functions."""

import math

import pytest

from pyspark.sql import functions as F

from tallyworks.functions import cells
from tallyworks.operators import statistics as stats


def one(spark, value, make, kind="string"):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    result = make(F.col("c"))
    return df.select(*result if isinstance(result, list) else [result]).first()


def test_numbers(spark):
    assert one(spark, " 12 ", cells.int_or_zero)[0] == 12
    assert one(spark, "x", cells.int_or_zero)[0] == 0
    assert one(spark, "1.5", cells.int_or_zero)[0] == 0
    assert one(spark, "1e3", cells.to_number)[0] == 1000.0
    for text in ("n/a", "", "1e", "1d", None, "."):
        assert one(spark, text, cells.to_number)[0] is None
    assert one(spark, "-inf", cells.to_number)[0] == -math.inf
    with pytest.raises(Exception, match="beyond 64 bits"):
        one(spark, "99999999999999999999", cells.int_or_zero)
    assert one(spark, "+7", cells.int_or_zero)[0] == 7


def test_pair_is_zero_if_either_fails(spark):
    df = spark.createDataFrame([("5", "x"), ("x", "5"), ("5", "7")], "p string, n string")
    rows = df.select(cells.pair_or_zero(F.col("p"), F.col("n")).alias("v")).select("v.*").collect()
    assert [tuple(r) for r in rows] == [(0.0, 0), (0.0, 0), (5.0, 7)]


def test_typed_text(spark):
    df = spark.createDataFrame([("12",), ("1.5",), ("-",), ("abc",), (None,), ("-3",),
                                ("12345678901234567890",)], "c string")
    rows = df.select(cells.typed_text(F.col("c")).alias("v")).select("v.*").collect()
    assert [tuple(r) for r in rows] == [("long", 12, None, None), ("double", None, 1.5, None), ("long", 0, None, None),
                                        ("text", None, None, "abc"), (None, None, None, None),
                                        ("double", None, -3.0, None), ("text", None, None, "12345678901234567890")]
    kept = df.where("c = '1.5'").select(cells.typed_text(F.col("c"), keep_text=True).alias("v")).select("v.*").first()
    assert tuple(kept) == ("text", None, None, "1.5")


def test_texts(spark):
    assert one(spark, "a b\n\tc", cells.squeeze)[0] == "abc"
    assert one(spark, "abc你好 x世界", cells.script_runs)[0] == "你好 世界"
    assert one(spark, "av123", cells.clean_id)[0] == "123"
    assert one(spark, "VA12av", cells.clean_id)[0] == "12"
    assert one(spark, "BV1x", lambda c: cells.id_link(c, "u/"))[0] == "u/BV1x"
    assert one(spark, "12", lambda c: cells.id_link(c, "u/"))[0] == "u/av12"
    assert one(spark, "渝中二手房", lambda c: cells.before(c, "二手房"))[0] == "渝中"
    assert one(spark, "89.5㎡", lambda c: cells.strip_unit(c, "㎡"))[0] == "89.5"
    assert one(spark, "2019/05", cells.swap_separator)[0] == "2019.05"
    assert one(spark, "房屋户型 2室 ", cells.skip_label)[0] == "2室"
    assert one(spark, "20190630", cells.month_digits)[0] == 6


def test_words_cut_chinese_runs_in_pairs(spark):
    assert one(spark, "Hi 你好吗 B2 世", cells.words)[0] == ["hi", "你好", "好吗", "b2", "世"]
    assert one(spark, "Über-Fuß", cells.words)[0] == ["über", "fuß"]
    assert one(spark, "a1b", cells.letter_words)[0] == ["a", "b"]


def test_forms(spark):
    assert one(spark, "5500", cells.range_midpoint)[0] == 5500.0
    assert one(spark, "5000-6000", cells.range_midpoint)[0] == 5500.0
    assert one(spark, "500-600", cells.range_midpoint)[0] is None
    assert one(spark, "2019.05", cells.year_prefix)[0] == 2019
    assert one(spark, "70年", cells.leading_small_int)[0] == 70
    rooms = lambda c: cells.named_numbers(c, r"(\d+)室(\d+)厅(\d+)厨(\d+)卫", list("abcd"))
    assert tuple(one(spark, "2室1厅1厨1卫", rooms)) == (2, 1, 1, 1)
    assert tuple(one(spark, "车位", rooms)) == (None,) * 4
    assert tuple(one(spark, "x resblockPosition:'106.5,29.6' y", cells.position_pair)) == ("106.5", "29.6")
    assert one(spark, 'cb({"a":1})', cells.unwrap_jsonp)[0] == '{"a":1}'
    assert one(spark, "no call", cells.unwrap_jsonp)[0] is None


def test_ratios(spark):
    row = spark.createDataFrame([(1, 2, 0)], "reply int, danmaku int, view int").select(
        cells.interaction(F.col("reply"), F.col("danmaku"), F.col("view")),
        cells.plain_ratio(F.col("reply"), F.col("view")),
        cells.guarded_ratio(F.col("danmaku"), F.col("view"))).first()
    assert math.isclose(row[0], 3 / math.log(2)) and row[1] is None and row[2] == 2.0


def test_price_bands_leave_edges_out(spark):
    df = spark.createDataFrame([(str(p), "1") for p in (9.9, 10, 10.1, 30, 200, 201, 10000, "x")], "p string, n string")
    rows = stats.sum_by_price_band(df, "p", "n").collect()
    assert {tuple(r) for r in rows} == {("10万以下", 1), ("10-30万", 1), ("200万以上", 1)}


def test_sum_by_category(spark):
    df = spark.createDataFrame([("A", "3"), ("A", "x"), ("B", "2"), ("A", "1")], "k string, n string")
    assert {tuple(r) for r in stats.sum_by_category(df, "k", "n").collect()} == {("A", 4), ("B", 2)}


@pytest.mark.parametrize("text,words", [
    ("Příliš žluťoučký KŮŇ, 3x", ["příliš", "žluťoučký", "kůň", "3x"]), ("Zażółć gęślą jaźń", ["zażółć", "gęślą", "jaźń"]),
    ("Καλημέρα, κόσμε!", ["καλημέρα", "κόσμε"]), ("Привет мир", ["привет", "мир"]), ("हिन्दी में", ["हिन्दी", "में"]),
    ("数据科学 spark很快 一", ["数据", "据科", "科学", "spark", "很快", "一"]), ("Šimon żil łódź café", ["šimon", "żil", "łódź", "café"])])
def test_words_of_many_scripts(spark, text, words):
    assert one(spark, text, cells.words)[0] == words
