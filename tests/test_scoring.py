"""AUC, blends, sources and sinks."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from conftest import by_id
from riskloom import vocab
from riskloom.operators.blending import blend_scores, blend_three, blend_two
from riskloom.operators.evaluation import exact_auc
from riskloom.sources import sinks, tables


def pairwise_auc(labels, scores):
    ones = [s for l, s in zip(labels, scores) if l == 1]
    zeros = [s for l, s in zip(labels, scores) if l != 1]
    wins = sum((a > b) + (a == b) / 2 for a in ones for b in zeros)
    return wins / (len(ones) * len(zeros))


def auc(make, labels, scores):
    return exact_auc(make("target int, prob double", list(zip(labels, scores)))).first().auc


def test_auc_by_hand(make):
    assert auc(make, [1, 0, 1, 0, 0], [.5, .5, .9, .1, .7]) == 0.75


def test_auc_matches_all_pairs(make):
    rng = random.Random(1)
    labels = [rng.randint(0, 1) for _ in range(400)]
    scores = [rng.choice([.1, .2, .3, rng.random()]) for _ in labels]
    got = auc(make, labels, scores)
    assert got == pytest.approx(pairwise_auc(labels, scores), abs=1e-12)
    assert auc(make, labels, [-s for s in scores]) == pytest.approx(1 - got, abs=1e-12)


def test_auc_agrees_with_mllib(make):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rng = random.Random(2)
    df = make("target int, prob double", [(rng.randint(0, 1), rng.random()) for _ in range(300)])
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="prob", labelCol="target", numBins=0)
    assert exact_auc(df).first().auc == pytest.approx(evaluator.evaluate(df), abs=1e-9)


def test_auc_of_one_class_is_null(make):
    assert auc(make, [1, 1], [.1, .2]) is None


def test_blends(make):
    frames = [make("ID string, PROB double", rows) for rows in (
        [("a", .5), ("b", .2)], [("a", .1), ("b", .4), ("c", .9)], [("a", .3)])]
    two = {r.ID: r.PROB for r in blend_two(*frames[:2]).collect()}
    assert two == {"a": pytest.approx(.3), "b": pytest.approx(.3)}
    three = {r.ID: r.PROB for r in blend_three(*frames).collect()}
    assert three == {"a": pytest.approx(.34), "b": None}
    with pytest.raises(ValueError):
        blend_scores(frames, [.5, .5])


def test_csv_tables_by_header_name(spark, tmp_path):
    content = {
        "auth_info": "phone,id,extra,auth_time,id_card\n139,1,z,2017-01-01,4\nnull,2,z,0000-00-00,\n",
        "bankcard_info": "id,bank_name,tail_num,card_type,phone\n1,工行,12,储蓄卡,NULL\n",
        "credit_info": "id,credit_score,overdraft,quota\n1,500,,NaN\n",
        "order_info": "id,amt_order,type_pay,time_order,sts_order,phone,unit_price,no_order_md5,"
                      "name_rec_md5,product_id_md5\n1,null,在线支付 ,2016-01-19 22:38:26,完成,1,2.5,a,b,c\n",
        "recieve_addr_info": "id,addr_id,region,phone,fix_phone,receiver_md5\n1,a,广东省,1,,r\n",
        "user_info": "id,sex,birthday,merriage,account_grade,qq_bound,wechat_bound,degree,id_card,"
                     "income\n1,男,1990-01-01,未婚,注册会员,已绑定,,本科,4,\n",
        "target": "id,target,appl_sbm_tm\n1,1,2017-01-10 08:00:00\n2,0,2017-04-10 08:00:00\n",
        "list": "id,appl_sbm_tm\n9,2017-05-01 08:00:00\n",
    }
    for name, body in content.items():
        for prefix in ("train", "score"):
            (tmp_path / f"{prefix}_{name}.csv").write_text(body, encoding="utf-8")
    t = tables.read_tables(spark, str(tmp_path))
    assert by_id(t["auth_info"], "phone", "id_card") == {"1": ("139", "4"), "2": (None, None)}
    assert by_id(t["credit_info"], "credit_score", "quota") == {"1": (500.0, None)}
    assert by_id(t["order_info"], "amt_order", "type_pay") == {"1": (None, "在线支付 ")}
    assert by_id(t["target"], "target") == {"1": 1, "2": 0}
    assert by_id(tables.read_tables(spark, str(tmp_path), "score")["list"], "appl_sbm_tm") == {
        "9": "2017-05-01 08:00:00"}
    from riskloom.plans.wide import wide_matrix
    matrix = wide_matrix(t, t["target"])
    assert by_id(matrix, "广东", "在线支付 ", "在线支付") == {"1": (1, 1, 0), "2": (0, 0, 0)}

    (tmp_path / "bad_list.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path / "bad_list.csv"), "list")


def test_matrices_and_scores_come_back(spark, make, tmp_path):
    rows = [("1", 1, "2016-05-01 00:00:00", 1), ("2", 0, "2017-04-02 00:00:00", 0)]
    labelled = make("id string, target int, appl_sbm_tm string, `充值失败;退款成功` int", rows)
    paths = sinks.write_matrices(labelled, labelled.drop("target"), str(tmp_path),
                                 vocab.TRAIN_MONTHS, vocab.VALIDATION_MONTH)
    stored = {k: tables.read_matrix(spark, p) for k, p in paths.items()}
    assert {k: v.count() for k, v in stored.items()} == {
        "train": 1, "validate": 1, "test": 2, "train_test": 2}
    assert stored["train"].columns == labelled.columns
    scores = labelled.select(F.col("id").alias("ID"), F.lit(.25).alias("PROB"))
    for fmt in ("parquet", "csv"):
        sinks.write_scores(scores, str(tmp_path / fmt), fmt)
        back = tables.read_scores(spark, str(tmp_path / fmt), fmt)
        assert {r.ID: r.PROB for r in back.collect()} == {"1": .25, "2": .25}


def test_scoring_matrix_from_the_stored_one_and_cuts_side_by_side(spark, make, tmp_path, monkeypatch):
    import threading
    rows = [("1", 1, "2016-05-01 00:00:00"), ("2", 0, "2017-04-02 00:00:00"), ("2", 0, "2017-04-02 00:00:00"), (None, 1, None)]
    labelled = make("id string, target int, appl_sbm_tm string", rows)
    # Each cut waits until all three are being written.
    write, together = sinks.write_matrix, threading.Barrier(3, timeout=60)
    monkeypatch.setattr(sinks, "write_matrix", lambda df, path: (
        None if path.endswith("train_test_feature") else together.wait(), write(df, path)))
    paths = sinks.write_matrices(labelled, lambda stored: stored.drop("target"), str(tmp_path), vocab.TRAIN_MONTHS, vocab.VALIDATION_MONTH)
    stored = {k: tables.read_matrix(spark, p) for k, p in paths.items()}
    assert {k: v.count() for k, v in stored.items()} == {"train": 1, "validate": 2, "test": 4, "train_test": 4}
    assert stored["test"].columns == ["id", "appl_sbm_tm"]


def test_a_cut_that_fails_is_not_lost(make, tmp_path):
    labelled = make("id string, target int, appl_sbm_tm string", [("1", 1, "2016-05-01 00:00:00")])
    with pytest.raises(Exception, match="no such"):
        sinks.write_matrices(labelled, labelled.selectExpr("raise_error('no such') AS id"), str(tmp_path), vocab.TRAIN_MONTHS, vocab.VALIDATION_MONTH)


def test_final_scores_makes_tables_once_and_compact_does_not_wait(spark, monkeypatch):
    from checks import queries
    from riskloom.plans import scoring
    made, fitted = [], threading.Event()

    def matrix(waits):
        def build(session, _folder, role="train", _tables=None):
            if waits and not fitted.wait(60):
                raise AssertionError("the compact model waits for the wide matrices")
            return session.createDataFrame([(1, 0)], "id long, target int")
        return build

    def scores(prob, done=False):
        def fit(_labelled, apply, *_names):
            if done:
                fitted.set()
            return apply.selectExpr("id AS ID", f"double({prob}) AS PROB")
        return fit

    monkeypatch.setattr(queries.w, "tables", lambda _s, _d, role="train", **_: made.append(role) or {"role": role})
    monkeypatch.setattr(queries, "_wide", matrix(True))
    monkeypatch.setattr(queries, "_compact", matrix(False))
    monkeypatch.setattr(queries.selection, "listed_features", lambda _matrix, _names: ["target"])
    monkeypatch.setattr(scoring, "compact_trees", scores(0.5, done=True))
    monkeypatch.setattr(scoring, "wide_trees", scores(0.5))
    monkeypatch.setattr(scoring, "wide_linear", scores(0.5))
    assert [tuple(r) for r in queries.QUERIES["final_scores"](spark, "unused").collect()] == [(1, 0.5)]
    assert made == ["train", "score"]
