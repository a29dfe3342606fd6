"""Physical plans hold what the operators promise."""

import pytest
import __spark_entry__ as entry
from tests.conftest import SMALL, executed_plan


def plan(spark, name):
    df = entry.queries()[name](spark, SMALL)
    df.collect()
    return executed_plan(df)


def initial(spark, name):
    return executed_plan(entry.queries()[name](spark, SMALL))


def test_two_columns_are_read(spark):
    assert "ReadSchema: struct<p_name:string,p_retailprice:double>" in initial(spark, "p01_select_columns")


def test_filters_reach_the_scan(spark):
    text = initial(spark, "p11_open_interval")
    assert "GreaterThan(p_size,10)" in text and "LessThan(p_size,30)" in text
    assert "o_orderdate" in initial(spark, "p12_date_range").split("PushedFilters:")[1]


def test_bands_take_one_scan_and_one_shuffle(spark):
    text = initial(spark, "a02_sum_by_price_band")
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_top_per_group_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in initial(spark, "w01_top_per_group")


def test_top_rows_need_no_sort_of_the_table(spark):
    assert "TakeOrderedAndProject" in initial(spark, "t02_first_after_sort")


def test_stop_words_are_a_broadcast_anti_join(spark):
    text = plan(spark, "a05_title_word_count")
    assert "LeftAnti" in text and "BroadcastHashJoin" in text


def test_facts_are_summed_before_the_lookup(spark):
    text = initial(spark, "a01_sum_by_category")
    lower = text.index("Join")
    assert "l_partkey" in text[lower:] and text[lower:].count("HashAggregate") >= 2


def test_grid_is_not_a_join(spark):
    text = initial(spark, "j08_period_category_page")
    assert "Join" not in text and "Exchange" not in text


@pytest.mark.parametrize("name", ["w02_sequence_number", "w04_exceed_rate_per_row", "m01_category_codes",
                                  "n13_selection_shares", "w03_rebuild_index"])
def test_no_window_over_the_whole_table(spark, name):
    assert "SinglePartition" not in initial(spark, name).replace("TakeOrdered", "")


def test_counts_are_summed_before_the_pair_shuffle(spark):
    text = initial(spark, "a29_cooccurrence")
    assert "partial_sum" in text and "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["j01_left_join_two_keys", "j03_update_by_key", "n10_neighbour_stats"])
def test_lookups_read_the_facts_once(spark, name):
    text = initial(spark, name)
    assert text.count("FileScan") == 2 and "Union" not in text
