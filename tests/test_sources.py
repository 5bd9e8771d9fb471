"""Reading CSV files as others write them, and guards on keys and labels."""

import pytest

from riskloom.operators.clean import split_off_month
from riskloom.operators.dedup import require_unique_tables
from riskloom.operators.grouping import summarise
from riskloom.sources.tables import read_table
from pyspark.sql import functions as F


def write(tmp_path, name, text):
    path = tmp_path / f"{name}.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_doubled_quotes_and_commas_stay_in_their_field(spark, tmp_path):
    path = write(tmp_path, "auth", 'id,id_card,auth_time,phone\n1,"ab ""x"", y",2016-01-01,13\n')
    row = read_table(spark, path, "auth_info").first()
    assert (row.id_card, row.auth_time, row.phone) == ('ab "x", y', "2016-01-01", "13")


def test_line_ends_inside_a_field(spark, tmp_path):
    path = write(tmp_path, "auth", 'id,id_card,auth_time,phone\n1,"a\nb",2016-01-01,13\n')
    assert read_table(spark, path, "auth_info", multi_line=True).first().id_card == "a\nb"


def test_labels_written_as_numbers(spark, tmp_path):
    path = write(tmp_path, "target", "id,appl_sbm_tm,target\n1,2016-01-01,1.0\n2,2016-01-01,0\n3,2016-01-01,\n")
    assert [r.target for r in read_table(spark, path, "target").orderBy("id").collect()] == [1, 0, None]
    for wrong in ("2", "yes"):
        path = write(tmp_path, f"wrong{wrong}", f"id,appl_sbm_tm,target\n1,2016-01-01,{wrong}\n")
        with pytest.raises(Exception, match="not 0 or 1"):
            read_table(spark, path, "target").collect()


def test_rows_without_a_month_stay_with_the_others(make):
    df = make("id string, appl_sbm_tm string", [("1", "2017-04-02 1"), ("2", "2017-03-02 1"), ("3", None)])
    others, month = split_off_month(df, "201704")
    assert {r.id for r in others.collect()} == {"2", "3"} and [r.id for r in month.collect()] == ["1"]


def test_a_repeated_id_is_an_error(make):
    once, twice = make("id string", [("1",), ("2",)]), make("id string", [("1",), ("1",)])
    require_unique_tables({"auth_info": once}, once)
    for tables, spine in (({"auth_info": twice}, once), ({"user_info": twice}, once), ({}, twice)):
        with pytest.raises(ValueError, match="not unique"):
            require_unique_tables(tables, spine)


def test_summary_without_distinct_counts(make):
    df = make("id string, v int", [("1", 2), ("1", 3), (None, 9)])
    assert [tuple(r) for r in summarise(df, "id", [F.sum("v").alias("s")]).collect()] == [("1", 5)]


# matrices by month, tables in buckets, cuts --------------------------------------------------------

def monthly(make, rows):
    return make("id long, target int, appl_sbm_tm string, a double", rows)


def test_one_month_is_written_again_and_the_others_stay(spark, make, tmp_path):
    from riskloom.sources.sinks import write_monthly
    from riskloom.sources.tables import read_month_split, read_monthly
    path = str(tmp_path / "monthly")
    rows = [(i, i % 2, f"2016-0{1 + i % 3}-05 10:00:00", float(i)) for i in range(30)] + [(99, 1, None, 0.5)]
    write_monthly(monthly(make, rows), path)
    write_monthly(monthly(make, [(100, 1, "2016-02-07 00:00:00", 7.0)]), path)
    back = read_monthly(spark, path)
    assert back.columns == ["id", "target", "appl_sbm_tm", "a"]
    assert {r.id for r in back.collect()} == {i for i in range(30) if i % 3 != 1} | {99, 100}
    assert {r.id for r in read_monthly(spark, path, "201602", "201602").collect()} == {100}
    assert {r.id for r in read_monthly(spark, path, "201602").collect()} == {100} | {i for i in range(30) if i % 3 == 2}
    other, held = read_month_split(spark, path, "201603")
    assert {r.id for r in held.collect()} == {i for i in range(30) if i % 3 == 2}
    assert {r.id for r in other.collect()} == {i for i in range(30) if i % 3 == 0} | {99, 100}


def test_month_splits_read_their_folders_only(spark, make, tmp_path):
    from riskloom.sources.sinks import write_monthly
    from riskloom.sources.tables import read_month_split, read_monthly
    from test_plans import plan_of
    path = str(tmp_path / "monthly")
    write_monthly(monthly(make, [(i, 0, f"2016-0{1 + i % 3}-05", 1.0) for i in range(9)]), path)
    for df in (read_monthly(spark, path, "201601", "201602"), *read_month_split(spark, path, "201603")):
        filters = plan_of(df, "formatted").split("PartitionFilters: [")[1].split("\n")[0]
        assert "month" in filters
        assert len(df.inputFiles()) > 0


def test_bucketed_tables_meet_without_an_exchange(spark):
    from checks import queries as q
    from riskloom.operators.joins import join_features
    from riskloom.plans import wide
    from test_plans import plan_of
    from conftest import SMALL
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored, spine = q._bucketed(spark, SMALL, 4)
        orders = stored["order_info"].groupBy("id").agg(F.count("phone").alias("phones"), F.max("unit_price").alias("dearest"))
        joined = join_features(spine, [wide.user_features(stored["user_info"]), orders, stored["credit_info"]])
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        whole = plan_of(wide.wide_matrix(stored, spine))
        # By id moves only what is made on the way: the ranked credit lines, the order profile, and distinct values laid out
        # one per row, which an exchange by (id, value) precedes.
        for part in whole.split("Exchange hashpartitioning(id")[1:]:
            by_value = "kind#" in part.split("\n")[0]
            between = part.split("FileScan")[0]
            assert by_value or "Exchange" in between or "FileScan parquet spark_catalog" not in part[len(between):len(between) + 40]
        assert spine.count() == joined.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_every_core_has_a_bucket(spark, monkeypatch):
    from checks import queries as q
    from riskloom.sources import sinks
    from riskloom.sources import tables as stored
    found = []
    monkeypatch.setattr(q.w, "tables", lambda *_: {"target": None})
    monkeypatch.setattr(stored, "read_bucketed", lambda *_: {"target": None})
    monkeypatch.setattr(sinks, "write_bucketed", lambda tables, prefix, folder, buckets: found.append(buckets))
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda _: 12))
    q._bucketed(spark, "")
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda _: 2))
    q._bucketed(spark, "")
    assert found == [12, 8]


def test_categories_are_looked_up_and_those_of_the_choices(spark, make):
    from checks import warehouse as w
    from test_plans import plan_of
    keys = [None, -43, -2, *range(150)]  # the price divides by 1 + key % 4
    rows = [(k, c, 10.5, None) for k in keys for c in (None, -2, 0, 7, 36)]
    orders = make("o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp", rows)
    looked = spark.sql(w._for_spark(w.TABLE_SQL["order_info"]), orders=orders)
    chosen = spark.sql(w.TABLE_SQL["order_info"], orders=orders)
    assert looked.schema == chosen.schema
    assert looked.exceptAll(chosen).count() == chosen.exceptAll(looked).count() == 0
    for texts in (w.TABLE_SQL, w.SCORE_SQL):
        for name in ("order_info", "recieve_addr_info", "user_info"):
            assert "get(array(" in w._for_spark(texts[name]) and "WHEN 9 THEN" not in w._for_spark(texts[name]), name
    assert plan_of(w.table(spark, "/root/testdata/sf0.001", "order_info")).count("CASE WHEN") < 20


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, int(i % 3 == 0), float(i % 3 == 0) * 5, float(i % 2), 3.0, 0.0, float(i)) for i in range(60)]
    return spark.createDataFrame(rows, "id long, target int, signal double, noise double, same double, zero double, `the.rest` double")


def test_cut_is_that_of_the_training_matrix(labelled):
    from riskloom.operators.chi2_cut import cut_matrices
    from riskloom.operators.selection import chi2_scores, top_names
    columns = ["signal", "noise", "same", "zero", "the.rest"]
    renamed = labelled.withColumnRenamed("the.rest", "rest")
    columns = [c.replace("the.", "") for c in columns]
    train, held = renamed.where("id < 40"), renamed.where("id >= 40")
    cut = cut_matrices({"train": train, "validate": held, "test": renamed.drop("target")}, columns, 3)
    want = top_names(chi2_scores(train, columns), 3)
    assert cut["train"].columns == ["id", "target"] + [c for c in columns if c in want] == cut["validate"].columns
    assert cut["test"].columns == ["id"] + [c for c in columns if c in want] and cut["validate"].count() == 20


def test_cut_in_a_pipeline_is_stored_and_loaded(labelled, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from riskloom.operators.chi2_cut import ChiSquaredCut, ChiSquaredCutModel
    from riskloom.operators.models import assembled_features
    vectors = assembled_features(labelled, ["signal", "noise", "same", "zero"])
    model = Pipeline(stages=[ChiSquaredCut(k=2)]).fit(vectors)
    assert model.stages[0].positions() == [0, 2]  # noise and same both score 0: the later one stays
    model.write().overwrite().save(str(tmp_path / "pipe"))
    model.stages[0].save(str(tmp_path / "cut"))
    ChiSquaredCut(k=7).save(str(tmp_path / "estimator"))
    again = PipelineModel.load(str(tmp_path / "pipe"))
    assert ChiSquaredCutModel.load(str(tmp_path / "cut")).positions() == [0, 2]
    assert ChiSquaredCut.load(str(tmp_path / "estimator")).getOrDefault("k") == 7
    rows = again.transform(vectors.where("id < 2")).orderBy("id").collect()
    assert [list(r.selected) for r in rows] == [[5.0, 3.0], [0.0, 3.0]]
    one_class = Pipeline(stages=[ChiSquaredCut(k=2)]).fit(vectors.where("target = 0"))
    assert len(one_class.stages[0].positions()) == 2
    assert Pipeline(stages=[ChiSquaredCut(k=2)]).fit(vectors.limit(0)).stages[0].positions() == []
