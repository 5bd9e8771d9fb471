"""What the plans must look like, and that results do not depend on the data layout or on skew."""

import glob
import io
import re
import time
from contextlib import redirect_stdout
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import queries as q
from checks import warehouse as w
from checks.compare import spark_result
from conftest import SMALL, by_id
from riskloom.operators import clean, dedup, ordering
from riskloom.operators.grouping import summarise
from riskloom.plans import compact, wide


def plan_of(df, mode="simple"):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture
def tables(spark):
    return w.tables(spark, SMALL)


def test_no_python_and_no_cross_join(spark, tables):
    for build in (q._wide, q._compact):
        plan = plan_of(build(spark, SMALL))
        assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.mark.parametrize("role", ["train", "score"])
def test_order_lines_meet_their_orders_once(spark, role):
    for name, df in w.tables(spark, SMALL, role).items():
        plan = plan_of(df)
        assert "lineitem.parquet" not in plan, name
        if name in ("auth_info", "target", "list"):  # read for the check of unique ids and again for the features
            assert not re.search("Join|Aggregate", plan), name


def test_row_features_do_not_shuffle(tables):
    for df in (wide.user_features(tables["user_info"]), wide.auth_features(
            tables["user_info"].select("id", "id_card", F.col("sex").alias("auth_time"),
                                       F.col("income").alias("phone")))):
        assert "Exchange" not in plan_of(df)


def test_summaries_use_hash_aggregation(tables):
    orders = tables["order_info"]
    for df in (wide.order_profile(orders), compact.bankcard_features(orders.select(
            "id", F.col("type_pay").alias("bank_name"), F.col("sts_order").alias("card_type"),
            "phone")), wide.order_days(orders)):
        plan = plan_of(df)
        assert "HashAggregate" in plan
        assert not re.search(r"SortAggregate|ObjectHashAggregate|Window|collect_", plan)


def test_sets_are_not_collected(spark):
    plans = [plan_of(build(spark, SMALL)) for build in (q._wide, q._compact)]
    assert not any(re.search(r"collect_set|collect_list", p) for p in plans)


def test_global_rank_windows_only_slice_totals(spark, tables):
    ranked = wide.credit_ranked(tables["credit_info"])
    windows = [line for line in plan_of(ranked).splitlines() if " Window " in line]
    assert windows and all("slice_total" in line for line in windows)


def test_month_filter_reaches_the_file(spark, tables, tmp_path):
    path = str(tmp_path / "spine")
    tables["target"].write.parquet(path)
    plan = plan_of(clean.months_between(spark.read.parquet(path), "199901", "200106"), "formatted")
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(appl_sbm_tm,1999-01\)", plan)
    assert re.search(r"PushedFilters: .*LessThan\(appl_sbm_tm,2001-07\)", plan)


def test_profile_reads_only_its_columns(spark, tables, tmp_path):
    path = str(tmp_path / "orders")
    tables["order_info"].withColumn("unused", F.lit("x")).write.parquet(path)
    plan = plan_of(wide.order_profile(spark.read.parquet(path)), "formatted")
    assert "unused" not in "".join(re.findall(r"ReadSchema: .*", plan))


@pytest.mark.parametrize("name", ["wide_bankcard", "compact_order"])
def test_deduplicated_rows_are_shuffled_once(spark, name):
    df = q.QUERIES[name](spark, SMALL)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def skewed_orders(make):
    """One id holds more than a third of the rows."""
    rows = []
    for i in range(900):
        key = 0 if i % 5 < 2 else i
        rows.append((key, str(i % 11), f"type{i % 4}", f"2016-0{i % 9 + 1}-11 10:00:00",
                     "完成" if i % 3 else None, str(i % 13), float(i % 17), str(i % 3)))
    return make("id int, amt_order string, type_pay string, time_order string, sts_order string, "
                "phone string, unit_price double, name_rec_md5 string", rows)


def test_hot_id_is_counted_whole(make):
    df = skewed_orders(make)
    hot = [r for r in df.collect() if r.id == 0]
    got = by_id(wide.order_profile(df), "order_phone_count", "order_rows", "type_pay_count",
                "unit_price_mean")[0]
    assert len(hot) == 360
    assert got == (len({r.phone for r in hot}), 360, len({r.type_pay for r in hot}),
                   sum(r.unit_price for r in hot) / 360)
    twice = summarise(df, "id", [F.count(F.lit(1)).alias("n")], {"phones": F.col("phone")},
                      {"pays": F.coalesce(F.col("type_pay"), F.lit("null"))})
    assert by_id(twice, "n", "phones", "pays")[0] == (360, 13, 4)


def test_shared_value_is_ranked_whole(spark, make):
    """A value of 60% of the rows is cut into several slices and still ranked 1..n."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = make("id int, s double", [(i, 5.0 if i % 5 < 3 else float(i)) for i in range(2000)])
    got = by_id(ordering.global_row_number(df.repartition(7), F.col("s").desc(), "id"), "rank")
    want = sorted(range(2000), key=lambda i: (-(5.0 if i % 5 < 3 else float(i)), i))
    assert got == {key: place for place, key in enumerate(want, start=1)}
    slices = ordering._sorted_slices(df, [F.col("s").desc(), F.col("id")])
    assert slices.filter("s = 5.0").select("slice_id").distinct().count() > 1


@pytest.mark.parametrize("name", ["wide_order", "wide_bankcard", "compact_address", "global_rank",
                                  "auc_exact_continuous", "compact_auth_order"])
def test_result_does_not_depend_on_layout(spark, monkeypatch, name):
    expected = spark_result(q.QUERIES[name](spark, SMALL))
    original = w.given
    monkeypatch.setattr(w, "given", lambda s, d, t: original(s, d, t).orderBy(F.rand(5)).repartition(3))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert spark_result(q.QUERIES[name](spark, SMALL)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_first_row_keeps_one_candidate_per_task(tables):
    plan = plan_of(dedup.first_per_key(tables["user_info"]))
    assert "partial_min" in plan and "Window" not in plan


def test_invariants_of_the_wide_matrix(spark):
    matrix = q._wide(spark, SMALL)
    spine = w.table(spark, SMALL, "target")
    assert matrix.count() == spine.count()
    scaled = [*wide.ORDER_SCALED, *wide.CREDIT_SCALED]
    flags = ["female", "all_null", "广东", "null_x", "feature_1", "have_credit_card", "age_three"]
    outside = matrix.agg(
        *[F.max((~F.col(c).between(0, 1)).cast("int")).alias(c) for c in scaled],
        *[F.max((~F.col(c).isin(0, 1)).cast("int")).alias(c) for c in flags],
        *[F.max(F.col(c).isNull().cast("int")).alias(f"null_{i}")
          for i, c in enumerate(matrix.columns)]).first()
    assert set(outside) == {0}


def test_working_folder_comes_from_the_session(spark):
    from riskloom.session import materialize, shared_dir
    path = shared_dir(spark)
    stored = materialize(spark.range(3), "probe")
    assert stored.count() == 3
    assert path.rstrip("/") in stored.inputFiles()[0]


# joined lines, freed shuffles ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """Given tables with repeated and null keys, and keys that meet nothing."""
    folder = str(tmp_path_factory.mktemp("odd"))
    rows = {
        "customer": ("c_custkey long, c_acctbal double", [(1, 5.0), (2, -3.0), (3, None), (None, 1.0)]),
        "supplier": ("s_suppkey long, s_nationkey int, s_acctbal double", [(7, 1, 2.0), (7, 4, 2.5), (8, None, -1.0), (None, 3, 0.0), (9, 2, 6.0)]),
        "part": ("p_partkey long, p_brand string", [(100, "a"), (100, "b"), (101, None), (None, "c"), (102, "a")]),
        "orders": ("o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz",
                   [(k, c, 10.5 * i, datetime(1998, 1, 1 + i)) for i, (k, c) in enumerate([(1, 1), (2, 1), (2, 2), (None, 3), (4, None), (5, 2)])]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_shipdate timestamp_ntz",
                     [(o, p, s, i % 5, "ARN"[i % 3], datetime(1998, 2, 1 + i)) for i, (o, p, s) in enumerate(
                         [(1, 100, 7), (1, 100, 7), (2, 101, 8), (2, 102, None), (None, 100, 7), (4, None, 9), (5, 103, 8), (5, 100, 10), (6, 100, 7)])]),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("role", ["train", "score"])
def test_tables_of_joined_lines_are_the_same(spark, odd_tables, role):
    shared = w.tables(spark, odd_tables, role, joined=lambda: w.joined_lines(spark, odd_tables))
    plain = w.tables(spark, odd_tables, role, stored=False)
    assert list(shared) == list(plain)
    for name, df in plain.items():
        assert shared[name].dtypes == df.dtypes
        assert sorted(map(repr, shared[name].collect())) == sorted(map(repr, df.collect())), name
    assert shared["bankcard_info"].count() > 0 and shared["recieve_addr_info"].count() > 0


def test_both_roles_read_one_join(spark, odd_tables):
    lines = w.joined_lines(spark, odd_tables)
    read = [{f.rsplit("/", 2)[1] for f in w.tables(spark, odd_tables, role, joined=lambda: lines)[name].inputFiles()}
            for role in ("train", "score") for name in ("bankcard_info", "recieve_addr_info")]
    assert read[0] == read[2] and read[1] == read[3] and all(len(r) == 1 for r in read)


def _shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for folder in folders for f in glob.glob(f"{folder}/*/shuffle_*.data")}


def test_stored_tables_leave_no_shuffle_files(spark):
    from riskloom.session import materialize, shuffles_freed
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, kept = spark.conf.get(setting), _shuffle_files(spark)
    counted = spark.range(0, 1000, 1, 3).groupBy((F.col("id") % 7).alias("k")).count()
    stored = materialize(counted, "counted")
    until = time.time() + 20
    while _shuffle_files(spark) - kept and time.time() < until:
        time.sleep(.2)
    assert not _shuffle_files(spark) - kept
    assert sorted(r["count"] for r in stored.collect()) == sorted(r["count"] for r in counted.collect())
    first, second = shuffles_freed(spark), shuffles_freed(spark)
    first.__enter__(), second.__enter__(), first.__exit__(None, None, None)
    assert spark.conf.get(setting) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(setting) == before
