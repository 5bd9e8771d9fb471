"""Hand-made rows for the rules that are easy to get wrong."""

import pytest
from pyspark.sql import functions as F

from conftest import by_id
from riskloom import vocab
from riskloom.functions import counts, dates, flags, text
from riskloom.operators import clean, dedup, scaling, selection
from riskloom.operators.joins import collision_names, join_features
from riskloom.operators.ordering import global_row_number, global_running_total, top_features
from riskloom.plans import compact, wide

ADDRESS = "id string, addr_id string, region string, phone string, fix_phone string, receiver_md5 string"
CARD = "id string, bank_name string, tail_num string, card_type string, phone string"
ORDER = ("id string, amt_order string, type_pay string, time_order string, sts_order string, "
         "phone string, unit_price double, name_rec_md5 string")
AUTH = "id string, id_card string, auth_time string, phone string"
USER = ("id string, sex string, birthday string, merriage string, account_grade string, "
        "qq_bound string, wechat_bound string, degree string, id_card string, income string")
SPINE = "id string, appl_sbm_tm string"


def orders(make, *rows):
    """Rows as (id, {column: value})."""
    names = [c.split()[0] for c in ORDER.split(", ")]
    return make(ORDER, [tuple({"id": i, **given}.get(n) for n in names) for i, given in rows])


def test_set_length_is_reset_by_null(make):
    df = make(ADDRESS, [("1", "a", "广东省广州", "p", None, None), ("1", None, None, None, None, None),
                        ("2", "a", "北京市", "p", None, None), ("2", "b", "广东省", "p", None, None),
                        ("3", None, None, None, None, None)])
    got = by_id(wide.address_features(df), "province_len", "广东", "null", "record_count")
    assert got == {"1": (0, 1, 1, 2), "2": (2, 1, 0, 2), "3": (0, 0, 1, 1)}
    assert by_id(compact.address_features(df), "province_len") == {"1": 0, "2": 2, "3": 0}


def test_value_outside_vocabulary_counts_but_has_no_column(make):
    df = make(ADDRESS, [("1", "a", "火星基地", "p", None, None), ("1", "b", "北京市", "p", None, None)])
    out = wide.address_features(df)
    assert by_id(out, "province_len", "北京") == {"1": (2, 1)}
    assert len(out.columns) == 38


def test_blank_address_precedence(make):
    df = make(ADDRESS, [("1", None, None, None, "f", None), ("2", None, None, None, "f", "r"),
                        ("3", "a", None, None, None, None), ("4", None, None, None, None, "r")])
    assert by_id(wide.address_features(df), "all_null") == {"1": 1, "2": 0, "3": 0, "4": 1}


def test_null_counts_as_one_distinct_value(make):
    df = orders(make, ("1", {"type_pay": "a"}), ("1", {}), ("1", {}))
    assert by_id(wide.order_profile(df), "type_pay_count") == {"1": 2}
    direct = df.groupBy("id").agg(counts.distinct_with_null("type_pay").alias("n"))
    assert by_id(direct, "n") == {"1": 2}


def test_first_card_in_declared_order(make):
    df = make(CARD, [("1", "a", "1", vocab.CREDIT_CARD, "p"), ("1", "b", "2", vocab.DEBIT_CARD, "p"),
                     ("2", "a", "1", vocab.DEBIT_CARD, "p"), ("2", "b", "2", vocab.CREDIT_CARD, "p"),
                     ("3", None, "9", None, None), ("3", "a", "1", vocab.CREDIT_CARD, "p")])
    assert by_id(wide.bankcard_features(df), "have_credit_card") == {"1": 1, "2": 0, "3": 0}
    backwards = wide.bankcard_features(df.withColumn("seq", -F.col("tail_num").cast("int")), ["seq"])
    assert by_id(backwards, "have_credit_card") == {"1": 0, "2": 1, "3": 0}


def test_bankcard_counts(make):
    row = ("1", "a", "1", vocab.DEBIT_CARD, None)
    df = make(CARD, [row, row, ("1", "a", "2", vocab.DEBIT_CARD, "p"), ("1", "a", "3", None, "q")])
    out = by_id(wide.bankcard_features(df), "phone_count", "card_record_count", "store_card_count",
                "card_category_count", "credit_count", "card_count_one", "record_is_unique")
    assert out == {"1": (3, 2, 2, 2, 0, 0, 0)}
    flat = by_id(compact.bankcard_features(df), "card_1_cnt", "card_2_cnt", "id_bank_cnt",
                 "id_phone_set", "id_card_set", "id_bank_set")
    assert flat == {"1": (3, 0, 4, 3, 2, 1)}


def test_population_standard_deviation(make):
    df = orders(make, ("1", {"amt_order": "5"}), ("2", {"amt_order": "1"}),
                ("2", {"amt_order": "3"}))
    assert by_id(wide.order_profile(df), "amt_order_std") == {"1": 0.0, "2": 1.0}


def test_amount_fill_and_price_fallback(make):
    df = orders(make, ("1", {"amt_order": "10", "unit_price": 4.0}), ("2", {"amt_order": "20"}),
                ("3", {"amt_order": "null"}), ("4", {}))
    got = by_id(wide.order_profile(df), "amt_order_mean", "unit_price_mean", "order_all_is_null")
    assert got == {"1": (10.0, 4.0, 0), "2": (20.0, 20.0, 0), "3": (15.0, 15.0, 0),
                   "4": (15.0, 15.0, 1)}
    assert clean.usable_rows(df, "amt_order").count() == 2


def test_payment_and_status_flags(make):
    df = orders(make, ("1", {"type_pay": "在线支付", "sts_order": "完成"}),
                ("1", {"type_pay": "在线支付 ", "sts_order": "完成"}), ("2", {"type_pay": "余额"}))
    out = wide.order_features(df)
    assert len(out.columns) == 96
    assert by_id(out, "在线支付", "在线支付 ", "余额", "null_x", "type_pay_len", "完成", "null_y",
                 "sts_order_len") == {"1": (1, 1, 0, 0, 2, 1, 0, 1), "2": (0, 0, 1, 0, 1, 0, 1, 0)}


def test_constant_column_scales_to_null(make):
    df = make("id string, a double, b double", [("1", 2.0, 1.0), ("2", 2.0, 3.0), ("3", 2.0, 2.0)])
    assert by_id(scaling.scale_columns(df, ["a", "b"]), "a", "b") == {
        "1": (None, 0.0), "2": (None, 1.0), "3": (None, 0.5)}
    other = make("id string, a double, b double", [("9", 0.0, 0.0), ("8", 4.0, 4.0)])
    fitted = scaling.column_ranges(other, ["a", "b"])
    assert by_id(scaling.scale_columns(df, ["a", "b"], fitted), "b") == {"1": .25, "2": .75, "3": .5}


def test_credit_features(make):
    df = make("id string, credit_score double, overdraft double, quota double", [
        ("1", 5.0, 1.0, 2.0), ("2", 7.0, None, None), ("3", None, 3.0, 3.0), ("4", 0.0, 0.0, 0.0)])
    out = by_id(wide.credit_features(df), "quota_rate", "quota_is_zero", "all_is_null",
                "all_is_zero", "credit_score_is_null", "quota_surplus_is_null", "credit_score_rank")
    assert out == {"1": (.5, 0, 1, 0, 0, 0, 1 / 3), "2": (0.0, 1, 1, 0, 0, 0, 0.0),
                   "3": (1.0, 0, 1, 0, 0, 1, 2 / 3), "4": (0.0, 1, 1, 1, 1, 0, 1.0)}
    assert by_id(wide.credit_filled(df), "credit_score")["3"] == 4.0
    assert by_id(compact.credit_features(df), "q/o", "q_o") == {
        "1": (.5, 1.0), "2": (None, None), "3": (1.0, 0.0), "4": (0.0, 0.0)}


def test_rank_ties_follow_the_id(make):
    df = make("id int, s double", [(1, 5.0), (2, 7.0), (3, 7.0)])
    assert by_id(global_row_number(df, F.col("s").desc(), "id"), "rank") == {1: 3, 2: 1, 3: 2}


def test_running_total(make):
    df = make("id int, n long", [(i, i) for i in range(1, 101)])
    got = by_id(global_running_total(df, F.col("id").asc(), amount="n", name="before"), "before")
    assert got == {i: sum(range(1, i)) for i in range(1, 101)}


@pytest.mark.parametrize("text_value, valid", [
    ("0000-00-00", False), (None, False), ("1990-5", False), ("1990", False), ("1990-5-3", True),
    ("1990-05-03 10:00:00", True), ("1990-05-03 25:00:00", False), ("1990-02-30", False),
    ("0000-05-05", False), ("1990-05-03 ", False), ("abc", False)])
def test_valid_dates(make, text_value, valid):
    row = make("d string", [(text_value,)]).select(dates.is_valid_date("d").alias("v")).first()
    assert row.v is valid


def test_age_bands(make):
    blank = [None] * 7
    rows = [(str(y), None, f"{y}-01-01", *blank) for y in (2000, 1988, 1987, 1900, 2018, 1958, 1957)]
    got = by_id(wide.user_features(make(USER, rows)), "age_one", "age_two", "age_three", "age_four",
                "age_five")
    assert got == {"2000": (1, 0, 0, 0, 0), "1988": (0, 1, 0, 0, 0), "1987": (0, 0, 1, 0, 0),
                   "1900": (0, 0, 0, 0, 0), "2018": (0, 0, 0, 0, 0), "1958": (0, 0, 1, 0, 0),
                   "1957": (0, 0, 0, 1, 0)}


def test_sex_names_are_swapped_and_null_is_not_female(make):
    rows = [("f", vocab.FEMALE, *[None] * 8), ("m", vocab.MALE, *[None] * 8), ("n", *[None] * 9)]
    df = make(USER, rows)
    assert by_id(wide.user_features(df), "sex_not_male", "female", "male", "merriage_is_null") == {
        "f": (0, 0, 1, 1), "m": (1, 1, 0, 1), "n": (1, 0, 0, 1)}
    assert by_id(compact.user_features(df), "sex_isnull", "sex2", "sex3") == {
        "f": (1, 0, 1), "m": (1, 1, 0), "n": (0, 0, 0)}
    assert (len(wide.user_features(df).columns), len(compact.user_features(df).columns)) == (30, 33)


def test_auth_flags_say_present(make):
    df = make(AUTH, [("1", "1", None, "p"), ("2", None, None, None)])
    out = wide.auth_features(df)
    assert [tuple(r) for r in out.orderBy("id").collect()] == [
        ("1", 1, 0, 1, 0, 0, 0, 0), ("2", 0, 0, 0, 1, 0, 1, 1)]
    assert by_id(compact.auth_features(df), "id_card_isnull", "auth_time_isnull") == {
        "1": (1, 0), "2": (0, 0)}


def test_contact_flags(make):
    df = make(AUTH, [("1", "4401", None, "13912345678"), ("2", None, None, "17000000000")])
    assert by_id(wide.auth_contact_flags(df), "mobile", "virtual", "id_card_four") == {
        "1": (1, 0, 1), "2": (0, 1, 0)}


def test_application_gap(make):
    spine = make(SPINE, [(i, "2017-01-10 08:00:00") for i in "12345"])
    auth = make(AUTH, [("1", None, "2017-01-01", None), ("2", None, "0000-00-00", None),
                       ("3", None, None, None), ("4", None, "2017-02-01", None)])
    assert by_id(wide.application_gap_features(auth, spine), "feature_1", "register_days") == {
        "1": (0, 9), "2": (0, 0), "3": (0, 0), "4": (1, -22), "5": (0, 0)}
    assert by_id(compact.days_features(auth, spine), "days", "days_is_neg", "years") == {
        "1": (9, 1, 0), "2": (0, 0, 0), "3": (0, 0, 0), "4": (-22, 0, 0)}


def test_order_gap(make):
    spine = make(SPINE, [(i, "2017-01-10 08:00:00") for i in "1234"])
    df = orders(make, ("1", {"time_order": "2017-01-08 23:00:00"}), ("1", {}),
                ("2", {"time_order": "2016-01-19"}), ("3", {"time_order": "2017-01-20 00:00:00"}))
    got = by_id(wide.order_gap_features(df, spine), "day_mean", "day_max", "day_min",
                "order_record_count", "order_record_unique")
    assert got == {"1": (1.0, 2, 0, 2, 0), "2": (0.0, 0, 0, 1, 1), "3": (-10.0, -10, -10, 1, 1),
                   "4": (0.0, 0, 0, 1, 1)}


def test_auth_order_gap(make):
    auth = make(AUTH, [(i, None, d, None) for i, d in (
        ("1", "2017-01-10"), ("2", "0000-00-00"), ("3", "2017-01-10"), ("4", "2017-01-10"),
        ("5", "2017-01-10"))])
    df = orders(make, ("1", {}), ("2", {"time_order": "2017-01-01 00:00:00"}),
                ("3", {"time_order": "2017-01-10 05:00:00"}),
                ("4", {"time_order": "2017-01-07 05:00:00"}),
                ("4", {"time_order": "2017-01-13 05:00:00"}), ("4", {"time_order": "2017-01-13"}))
    got = by_id(compact.auth_order_features(auth, df), "time_days_mean", "time_days_mean_is_neg")
    assert got == {"1": (-1.0, 0), "2": (-1.0, 0), "3": (-1.0, 0), "4": (5 / 3, 1), "5": (-1.0, 0)}


def test_compact_order_counts(make):
    df = orders(make, ("1", {"type_pay": "在线支付", "sts_order": "已完成"}),
                ("1", {"type_pay": "在线支付", "sts_order": "已完成"}),
                ("1", {"type_pay": "货到付款", "sts_order": "订单取消", "phone": "p"}),
                ("1", {"sts_order": None, "phone": "q"}))
    got = by_id(compact.order_features(df), "way1_cnt", "way2_cnt", "id_type_pay_set",
                "id_sts_order_set", "id_phone_set", "wan_cheng_cnt", "cheng_gong_cnt", "qu_xiao_cnt")
    assert got == {"1": (1, 1, 3, 3, 3, 1, 0, 1)}


def test_collision_names():
    assert collision_names([["null", "a"], ["null"], ["null", "b"]]) == [
        {"null": "null_x", "a": "a"}, {"null": "null_y"}, {"null": "null", "b": "b"}]


def test_published_lists_resolve(spark, make):
    tables = empty_tables(make)
    matrix = wide.wide_matrix(tables, make("id string, target int, appl_sbm_tm string", []))
    assert len(matrix.columns) == 3 + 194
    assert set(vocab.TREE_FEATURES) | set(vocab.LINEAR_FEATURES) <= set(matrix.columns)
    assert (len(vocab.TREE_FEATURES), len(vocab.LINEAR_FEATURES)) == (73, 96)
    assert (len(vocab.PROVINCES), len(vocab.PAYMENT_TYPES), len(vocab.ORDER_STATUSES)) == (34, 42, 38)
    assert len(compact.compact_matrix(tables, make(SPINE, [])).columns) == 2 + 64


def empty_tables(make):
    return {"auth_info": make(AUTH, []), "bankcard_info": make(CARD, []),
            "order_info": make(ORDER, []), "recieve_addr_info": make(ADDRESS, []),
            "user_info": make(USER, []),
            "credit_info": make("id string, credit_score double, overdraft double, quota double", [])}


def test_spine_keeps_its_rows_and_missing_is_zero_or_null(make):
    spine = make(SPINE, [("1", "2017-01-10 08:00:00"), ("2", "2017-01-10 08:00:00")])
    wide_rows = wide.wide_matrix(empty_tables(make), spine)
    assert by_id(wide_rows, "quota", "order_record_count", "广东") == {"1": (0.0, 1, 0), "2": (0.0, 1, 0)}
    compact_rows = compact.compact_matrix(empty_tables(make), spine)
    assert by_id(compact_rows, "days", "sex1") == {"1": (None, None), "2": (None, None)}


def test_month_split(make):
    df = make(SPINE, [("a", "2016-02-29 00:00:00"), ("b", "2016-03-01 00:00:00"),
                      ("c", "2017-03-31 23:59:59"), ("d", "2017-04-01 00:00:00"),
                      ("e", "2016-12-31 10:00:00"), ("f", "2017-05-01 00:00:00.0")])
    train = clean.months_between(df, *vocab.TRAIN_MONTHS)
    assert {r.id for r in train.collect()} == {"b", "c", "e"}
    other, held = clean.split_off_month(df, vocab.VALIDATION_MONTH)
    assert {r.id for r in held.collect()} == {"d"} and other.count() == 5
    december = clean.months_between(df, "201612", "201612")
    assert {r.id for r in december.collect()} == {"e"}
    assert df.select(text.month_key("appl_sbm_tm").alias("m")).first().m == "201602"


def test_duplicates(make):
    df = make("id string, a string", [("1", None), ("1", None), ("1", "x"), (None, None), (None, None)])
    assert dedup.distinct_rows(df).count() == 3
    assert dedup.distinct_keys(df).count() == 2
    assert by_id(dedup.first_per_key(df), "a") == {"1": None, None: None}
    with pytest.raises(ValueError):
        dedup.require_unique(df)
    assert dedup.require_unique(df.filter("a = 'x'")).count() == 1


def test_null_tokens(make):
    df = make("id string, a string, b double", [("1", "null", float("nan")), ("2", "", 1.0),
                                                ("3", "x", None)])
    assert by_id(clean.normalise_missing(df), "a", "b") == {
        "1": (None, None), "2": (None, 1.0), "3": ("x", None)}


def test_wide_vocabulary_uses_several_masks(make):
    values = [f"v{i}" for i in range(130)]
    df = make("id string, c string", [("1", "v0"), ("1", "v61"), ("1", "v62"), ("2", "v129"),
                                      ("3", "other")])
    masks = df.groupBy("id").agg(*counts.membership_masks("c", values, "m"))
    flagged = masks.select("id", *counts.membership_flags(values, "m"))
    assert by_id(flagged, "v0", "v61", "v62", "v129", "v1") == {
        "1": (1, 1, 1, 0, 0), "2": (0, 0, 0, 1, 0), "3": (0, 0, 0, 0, 0)}


def test_statistics_of_many_columns(spark):
    """One row a task and column instead of one aggregate a column, with nulls, NaN, empty columns and values far from zero."""
    nan = float("nan")
    rows = [(i, int(i % 3 == 0) if i % 10 else None, 1e9 + i % 2, None, None if i % 4 else float(i % 8), nan if i == 7 else float(i % 2), float(i % 3),
             i % 2 == 0) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, target int, far double, none double, gaps double, nan double, three double, flag boolean").repartition(5)
    names = ["far", "none", "gaps", "nan", "three", "flag"]
    scored = selection.variance_scores(df, names)
    assert "MapInArrow" in scored._jdf.queryExecution().toString()
    variance = {r.feature: r.score for r in scored.collect()}
    assert [r.feature for r in scored.orderBy("position").collect()] == names and variance["none"] is None
    assert variance["far"] == pytest.approx(.25) and variance["gaps"] == pytest.approx(4.0) and variance["flag"] == pytest.approx(.25)
    assert variance["nan"] != variance["nan"] and variance["three"] == pytest.approx(df.agg(F.var_pop("three")).first()[0])
    share, total = df.agg(F.avg((F.col("target") == 1).cast("double")), F.sum("three")).first()
    seen = df.agg(F.sum(F.when(F.col("target") == 1, F.col("three")).otherwise(0.0))).first()[0]
    chi2 = {r.feature: r.score for r in selection.chi2_scores(df, names).collect()}
    assert chi2["none"] is None and chi2["three"] == pytest.approx(
        (seen - share * total) ** 2 * (1 / (share * total) + 1 / ((1 - share) * total)))
    assert selection.binary_columns(df, names) == ["far", "gaps", "flag"]
    empty = df.limit(0)
    assert [r.score for r in selection.variance_scores(empty, names).collect()] == [None] * 6
    assert [r.score for r in selection.chi2_scores(empty, names).collect()] == [None] * 6 and selection.binary_columns(empty, names) == []


def test_selection(make):
    rows = [(1, 1, 0.0, 5.0, 0, 1), (2, 0, 1.0, 5.0, 1, 0), (3, 1, 0.5, 5.0, 1, 0), (4, 0, 0.0, 5.0, 1, 0)]
    df = make("id int, target int, a double, b double, c int, d int", rows)
    names = ["a", "b", "c", "d"]
    variance = {r.feature: r.score for r in selection.variance_scores(df, names).collect()}
    assert variance["b"] == 0.0 and variance["c"] == pytest.approx(0.1875)
    chi2 = {r.feature: r.score for r in selection.chi2_scores(df, names).collect()}
    # c: observed 1 and 2, expected 1.5 each
    assert chi2["c"] == pytest.approx(1 / 3) and chi2["b"] == 0.0
    # equal variance of c and d: the later column wins
    top = top_features(selection.variance_scores(df, names), 2)
    assert selection.names_of(top) == ["d", "c"]
    assert selection.binary_columns(df, names) == ["c", "d"]
    assert selection.tree_layout(df, names, 1) == ["a", "b", "c"]
    assert selection.linear_layout(df, names, 1) == ["c", "a", "b"]
    assert selection.combine_names(["a", "c"], ["c", "d"]) == ["c"]
    assert selection.combine_names(None, ["c", "d"]) == []
    assert selection.selectable_features(df.withColumn("mobile", F.lit(1))) == names


def test_join_keeps_unmatched_spine_rows(make):
    spine = make("id string", [("1",), ("2",)])
    out = join_features(spine, [make("id string, a int", [("1", 4)])])
    assert by_id(out, "a") == {"1": 4, "2": None}


def test_flags_are_never_null(make):
    df = make("a string", [(None,), ("x",), ("y",)])
    out = df.select(flags.equals_flag("a", "x").alias("e"), flags.differs_flag("a", "x").alias("d"),
                    flags.in_flag("a", ["x"]).alias("i"), flags.contains_flag("a", "x").alias("c"))
    assert [tuple(r) for r in out.collect()] == [(0, 1, 0, 0), (1, 0, 1, 1), (0, 1, 0, 0)]


def test_month_pivot_and_amount_extras(make):
    df = orders(make, ("1", {"time_order": "2016-04-01 00:00:00", "amt_order": "1"}),
                ("1", {"time_order": "2016-04-09 00:00:00", "amt_order": "3"}), ("1", {}))
    assert by_id(compact.order_month_counts(df), "1604", "00000000", "1704") == {"1": (2, 1, 0)}
    assert by_id(compact.order_amount_features(df), "id_amt_order_mean", "id_amt_order_var") == {
        "1": (2.0, 2.0)}
