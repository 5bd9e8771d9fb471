"""The checked queries: one per operator or feature plan, over the whole given tables.

Each entry takes ``(spark, sf_dir)``. Where the result can be said in SQL, the same entry carries
that SQL. Doubles whose value depends on the order of a sum are rounded on both sides.
"""

import functools
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import facts as f
from checks import oracle as o
from checks import warehouse as w
from riskloom import vocab
from riskloom.functions import counts, dates, flags, numbers, text
from riskloom.operators import chi2_cut, clean, dedup, extra_trees, moments, ordering, scaling, selection, tree_table
from riskloom.operators.blending import blend_three, blend_two
from riskloom.operators.evaluation import exact_auc
from riskloom.operators.grouping import summarise
from riskloom.operators.joins import attach_aggregate, join_features
from riskloom.plans import compact, wide
from riskloom.session import materialize, shared_dir, shared_path

QUERIES = {}
SQL = {}

# A published category ends in a blank, which a CSV writer would cut off.
CSV_OUT = {"header": True, "quote": '"', "escape": '"', "ignoreTrailingWhiteSpace": False, "ignoreLeadingWhiteSpace": False}

# Columns whose last digits depend on the order of a sum.
ORDER_DOUBLES = list(wide.ORDER_SCALED)
CREDIT_DOUBLES = ["credit_score", "quota_rate"]
WIDE_DOUBLES = ORDER_DOUBLES + CREDIT_DOUBLES


def query(name, sql=None, role="train"):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = o.with_pieces(sql, role)
        return fn
    return register


def rounded(df, columns, digits=9):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def load(spark, sf_dir, *names):
    frames = [w.table(spark, sf_dir, n) for n in names]
    return frames[0] if len(frames) == 1 else frames


# ---- cleaning, filters, duplicates ------------------------------------------------------------

@query("clean_amount_mean_fill",
       "SELECT id, amt_order, unit_price FROM order_filled")
def _(spark, sf_dir):
    filled = clean.amount_mean_fill(load(spark, sf_dir, "order_info"))
    return filled.select("id", "amt_order",
                         F.coalesce("unit_price", "amt_order").alias("unit_price"))


@query("clean_usable_amounts", """
SELECT id, amt_order FROM order_info WHERE amt_order IS NOT NULL AND amt_order <> 'null'""")
def _(spark, sf_dir):
    return clean.usable_rows(load(spark, sf_dir, "order_info"), "amt_order").select(
        "id", "amt_order")


@query("clean_fill_constant", """
SELECT id, COALESCE(overdraft, 0) AS overdraft, COALESCE(quota, 0) AS quota FROM credit_info""")
def _(spark, sf_dir):
    return load(spark, sf_dir, "credit_info").select(
        "id", numbers.filled("overdraft", 0.0).alias("overdraft"),
        numbers.filled("quota", 0.0).alias("quota"))


@query("clean_fill_category", """
SELECT id, COALESCE(sts_order, '0') AS sts_order, COALESCE(type_pay, 'null') AS type_pay
FROM order_info""")
def _(spark, sf_dir):
    return load(spark, sf_dir, "order_info").select(
        "id", numbers.filled("sts_order", "0").alias("sts_order"),
        text.null_as_category("type_pay").alias("type_pay"))


@query("clean_zero_fill_joined", f"""
SELECT target.id, COALESCE(day_mean, 0) AS day_mean,
  COALESCE(credit_score, 0) AS credit_score, COALESCE(phone_count, 0) AS phone_count
FROM target LEFT JOIN wide_order_time ON target.id = wide_order_time.id
  LEFT JOIN credit_info ON target.id = credit_info.id
  LEFT JOIN wide_bankcard ON target.id = wide_bankcard.id""")
def _(spark, sf_dir):
    orders, credit, cards, spine = load(spark, sf_dir, "order_info", "credit_info",
                                        "bankcard_info", "target")
    return clean.zero_fill(join_features(spine.select("id"), [
        wide.order_gap_features(orders, spine).select("id", "day_mean"),
        credit.select("id", "credit_score"),
        wide.bankcard_features(cards).select("id", "phone_count")]))


@query("credit_mean_fill", "SELECT id, credit_score FROM credit_filled")
def _(spark, sf_dir):
    return clean.mean_fill(load(spark, sf_dir, "credit_info"), "credit_score").select(
        "id", "credit_score")


@query("whole_table_stats", """
SELECT AVG(credit_score) AS mean, MIN(credit_score) AS low, MAX(credit_score) AS high
FROM credit_info""")
def _(spark, sf_dir):
    return load(spark, sf_dir, "credit_info").agg(
        F.avg("credit_score").alias("mean"), F.min("credit_score").alias("low"),
        F.max("credit_score").alias("high"))


@query("dedup_rows", "SELECT DISTINCT * FROM bankcard_info")
def _(spark, sf_dir):
    return dedup.distinct_rows(load(spark, sf_dir, "bankcard_info"))


@query("dedup_first_per_id", """
SELECT id, bank_name, tail_num, card_type, phone FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY bank_name NULLS FIRST,
    tail_num NULLS FIRST, card_type NULLS FIRST, phone NULLS FIRST) AS rn FROM bankcard_info)
WHERE rn = 1""")
def _(spark, sf_dir):
    return dedup.first_per_key(load(spark, sf_dir, "bankcard_info"))


@query("distinct_ids", "SELECT DISTINCT id FROM bankcard_info")
def _(spark, sf_dir):
    return dedup.distinct_keys(load(spark, sf_dir, "bankcard_info"))


@query("project_rename_drop", """
SELECT birthday AS born, sex, income FROM user_info""")
def _(spark, sf_dir):
    users = load(spark, sf_dir, "user_info")
    kept = users.drop("merriage", "account_grade", "qq_bound", "wechat_bound", "degree",
                      "id_card", "no_such_column").withColumnRenamed("birthday", "born")
    return kept.select(*selection.feature_columns(kept, keys=("id",)))


def _listed_sql(names):
    return o.rounded("(SELECT " + ", ".join(map(o.q, names)) + " FROM wide_matrix)", [c for c in WIDE_DOUBLES if c in names])


def _listed(spark, sf_dir, names):
    matrix = _wide(spark, sf_dir)
    return rounded(matrix.select(*selection.listed_features(matrix, names)), [c for c in WIDE_DOUBLES if c in names])


@query("project_feature_list", _listed_sql(vocab.LINEAR_FEATURES))
def _(spark, sf_dir):
    """The 96 names of the linear model."""
    return _listed(spark, sf_dir, vocab.LINEAR_FEATURES)


@query("project_published_features", _listed_sql(vocab.TREE_FEATURES))
def _(spark, sf_dir):
    """The 73 names of the tree model."""
    return _listed(spark, sf_dir, vocab.TREE_FEATURES)


@query("month_split_range", """
SELECT id, target, CASE WHEN m = '200107' THEN 'validate' ELSE 'train' END AS part FROM (
  SELECT *, substr(replace(appl_sbm_tm, '-', ''), 1, 6) AS m FROM target)
WHERE m BETWEEN '199901' AND '200107'""")
def _(spark, sf_dir):
    spine = load(spark, sf_dir, "target")
    train = clean.months_between(spine, *w.TRAIN_MONTHS)
    held = clean.months_between(spine, w.VALIDATION_MONTH, w.VALIDATION_MONTH)
    return (train.select("id", "target", F.lit("train").alias("part"))
            .unionByName(held.select("id", "target", F.lit("validate").alias("part"))))


@query("month_split_other", """
SELECT id, target, substr(replace(appl_sbm_tm, '-', ''), 1, 6) = '200107' AS held_out
FROM target""")
def _(spark, sf_dir):
    train, held = clean.split_off_month(load(spark, sf_dir, "target"), w.VALIDATION_MONTH)
    return (train.select("id", "target", F.lit(False).alias("held_out"))
            .unionByName(held.select("id", "target", F.lit(True).alias("held_out"))))


@query("month_split_all", """
SELECT id, target, substr(replace(appl_sbm_tm, '-', ''), 1, 6) AS month FROM target""")
def _(spark, sf_dir):
    return load(spark, sf_dir, "target").select(
        "id", "target", text.month_key("appl_sbm_tm").alias("month"))


# ---- row-wise features ------------------------------------------------------------------------

@query("flags_onehot", f"""
SELECT id, {o.numbered_flags("merriage", "merriage", vocab.MARRIAGE)},
  {o.numbered_flags("income", "income", vocab.INCOME_BANDS)},
  {o.flag("sex IS NULL OR sex <> '女'", "sex_not_male")},
  {o.flag("degree IN ('硕士', '其他', '博士')", "degree")},
  {o.flag("birthday = '0000-00-00'", "birthday_is_zero")} FROM user_info""")
def _(spark, sf_dir):
    return load(spark, sf_dir, "user_info").select(
        "id", *flags.one_hot("merriage", flags.numbered("merriage", vocab.MARRIAGE)),
        *flags.one_hot("income", flags.numbered("income", vocab.INCOME_BANDS)),
        flags.differs_flag("sex", vocab.FEMALE).alias("sex_not_male"),
        flags.in_flag("degree", vocab.MARKED_DEGREES).alias("degree"),
        flags.equals_flag("birthday", vocab.ZERO_DATE).alias("birthday_is_zero"))


@query("flags_null", f"""
SELECT id, {o.flag("degree IS NULL", "degree_missing")},
  {o.flag("degree IS NOT NULL", "degree_present")} FROM user_info""")
def _(spark, sf_dir):
    return load(spark, sf_dir, "user_info").select(
        "id", flags.null_flag("degree").alias("degree_missing"),
        flags.present_flag("degree").alias("degree_present"))


@query("flags_multi_null", f"""
SELECT id, addr_id, fix_phone, receiver_md5, CAST(all_null AS INTEGER) AS all_null,
  {o.flag("fix_phone IS NULL AND receiver_md5 IS NULL", "pair_null")},
  {o.flag("fix_phone IS NOT NULL AND receiver_md5 IS NOT NULL", "pair_present")}
FROM addr_prepared""")
def _(spark, sf_dir):
    return load(spark, sf_dir, "recieve_addr_info").select(
        "id", "addr_id", "fix_phone", "receiver_md5", flags.blank_address_flag().alias("all_null"),
        flags.null_flag("fix_phone", "receiver_md5").alias("pair_null"),
        flags.present_flag("fix_phone", "receiver_md5").alias("pair_present"))


@query("flags_threshold", f"""
SELECT id, {o.flag("quota = 0", "quota_is_zero")},
  {o.flag("credit_score = 0 AND overdraft = 0 AND quota = 0", "all_is_zero")},
  {o.flag("quota_surplus = 0 AND quota <> 0", "fully_drawn")},
  {o.flag("overdraft > 6", "above_six")} FROM credit_filled""")
def _(spark, sf_dir):
    filled = wide.credit_filled(load(spark, sf_dir, "credit_info"))
    score, overdraft, quota = F.col("credit_score"), F.col("overdraft"), F.col("quota")
    return filled.select(
        "id", flags.as_flag(quota == 0).alias("quota_is_zero"),
        flags.as_flag((score == 0) & (overdraft == 0) & (quota == 0)).alias("all_is_zero"),
        flags.as_flag((F.col("quota_surplus") == 0) & (quota != 0)).alias("fully_drawn"),
        flags.as_flag(overdraft > 6).alias("above_six"))


@query("math_diff_ratio", """
SELECT id, quota - overdraft AS unused,
  CASE WHEN quota = 0 THEN CAST(0 AS DOUBLE) ELSE overdraft / quota END AS drawn_share
FROM credit_info""")
def _(spark, sf_dir):
    quota, overdraft = F.col("quota"), F.col("overdraft")
    return load(spark, sf_dir, "credit_info").select(
        "id", (quota - overdraft).alias("unused"),
        numbers.guarded_ratio(overdraft, quota).alias("drawn_share"))


@query("string_prefix", """
SELECT a.id, COALESCE(substr(a.id_card, 1, 1), '-1') AS first_digit,
  COALESCE(substr(a.phone, 1, 3), '') AS phone_start FROM auth_info a""")
def _(spark, sf_dir):
    return load(spark, sf_dir, "auth_info").select(
        "id", text.first_character("id_card").alias("first_digit"),
        F.coalesce(F.substring("phone", 1, 3), F.lit("")).alias("phone_start"))


@query("string_region_prefix", "SELECT id, province FROM addr_prepared")
def _(spark, sf_dir):
    return load(spark, sf_dir, "recieve_addr_info").select(
        "id", text.region_prefix("region").alias("province"))


@query("string_contains", f"""
SELECT id, {o.flag("type_pay LIKE '%LOW%'", "low")}, {o.flag("type_pay LIKE '%HIGH%'", "high")},
  {o.flag("type_pay LIKE '%SPECIFIED%'", "specified")} FROM order_info""")
def _(spark, sf_dir):
    words = {"low": "LOW", "high": "HIGH", "specified": "SPECIFIED"}
    return load(spark, sf_dir, "order_info").select(
        "id", *[flags.contains_flag("type_pay", v).alias(k) for k, v in words.items()])


@query("auth_contact_flags", "SELECT id, " + ", ".join(
    o.flag(f"substr(phone, 1, 3) IN ({', '.join(o.s(v) for v in values)})", name)
    for name, values in vocab.CARRIER_PREFIXES.items()) + ", " + ", ".join(
    o.flag(f"substr(id_card, 1, 1) = {o.s(v)}", name)
    for name, v in vocab.ID_CARD_DIGITS.items()) + " FROM auth_info")
def _(spark, sf_dir):
    return wide.auth_contact_flags(load(spark, sf_dir, "auth_info"))


@query("age_buckets", f"SELECT id, age, {o.AGE_FLAGS} FROM user_aged")
def _(spark, sf_dir):
    aged = load(spark, sf_dir, "user_info").withColumn("age", dates.age_in(2018))
    return aged.select("id", "age", *dates.age_flags("age"))


@query("auth_gap", """
SELECT id, CAST(date_diff('day', auth, appl) AS INTEGER) AS days,
  CAST(year(appl) - year(auth) AS INTEGER) AS years FROM spine_auth""")
def _(spark, sf_dir):
    auth, spine = load(spark, sf_dir, "auth_info", "target")
    dated = spine.join(auth.select("id", "auth_time"), "id", "left").select(
        "id", "auth_time", dates.day_of("appl_sbm_tm").alias("appl"))
    checked = dates.effective_auth_day(F.col("appl"))
    return dated.select("id", F.datediff("appl", checked).alias("days"),
                        dates.year_gap(F.col("appl"), checked).alias("years"))


# ---- aggregates -------------------------------------------------------------------------------

@query("agg_basic", """
SELECT id, COUNT(*) AS row_count, COUNT(phone) AS phone_rows, AVG(unit_price) AS price_mean,
  MAX(unit_price) AS price_max, MIN(unit_price) AS price_min FROM order_info GROUP BY id""")
def _(spark, sf_dir):
    return load(spark, sf_dir, "order_info").groupBy("id").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("phone").alias("phone_rows"),
        F.avg("unit_price").alias("price_mean"), F.max("unit_price").alias("price_max"),
        F.min("unit_price").alias("price_min"))


@query("agg_std", """
SELECT id, ROUND(STDDEV_POP(unit_price), 3) AS price_std FROM order_info GROUP BY id""")
def _(spark, sf_dir):
    return load(spark, sf_dir, "order_info").groupBy("id").agg(
        F.round(F.stddev_pop("unit_price"), 3).alias("price_std"))


@query("agg_amount_variance", """
SELECT id, AVG(a) AS id_amt_order_mean, MAX(a) AS id_amt_order_max, MIN(a) AS id_amt_order_min,
  ROUND(VAR_SAMP(a), -6) AS id_amt_order_var, AVG(unit_price) AS id_unit_price_mean,
  MAX(unit_price) AS id_unit_price_max, MIN(unit_price) AS id_unit_price_min,
  ROUND(VAR_SAMP(unit_price), -6) AS id_unit_price_var
FROM (SELECT *, TRY_CAST(amt_order AS DOUBLE) AS a FROM order_info) GROUP BY id""")
def _(spark, sf_dir):
    return rounded(compact.order_amount_features(load(spark, sf_dir, "order_info")),
                   ["id_amt_order_var", "id_unit_price_var"], -6)


@query("agg_conditional", f"""
SELECT id, {o.total("card_type = '储蓄卡'", "debit")}, {o.total("card_type = '信用卡'", "credit")}
FROM bankcard_info GROUP BY id""")
def _(spark, sf_dir):
    return load(spark, sf_dir, "bankcard_info").groupBy("id").agg(
        counts.count_where(F.col("card_type") == vocab.DEBIT_CARD).alias("debit"),
        counts.count_where(F.col("card_type") == vocab.CREDIT_CARD).alias("credit"))


@query("agg_distinct_with_null", f"""
SELECT id, {o.distinct_null("type_pay", "pays")}, {o.distinct_null("sts_order", "statuses")},
  {o.distinct_null("phone", "phones")} FROM order_info GROUP BY id""")
def _(spark, sf_dir):
    return summarise(load(spark, sf_dir, "order_info"), "id", [F.count(F.lit(1)).alias("n")], distinct={
        "pays": F.col("type_pay"), "statuses": F.col("sts_order"), "phones": F.col("phone")}).drop("n")


@query("agg_set", """
SELECT DISTINCT id, COALESCE(type_pay, 'null') AS category FROM order_info""")
def _(spark, sf_dir):
    return load(spark, sf_dir, "order_info").select(
        "id", text.null_as_category("type_pay").alias("category")).distinct()


@query("agg_flag_minmax", """
SELECT id, CAST(MIN(all_null) AS INTEGER) AS every_row, CAST(MAX(all_null) AS INTEGER) AS any_row
FROM addr_prepared GROUP BY id""")
def _(spark, sf_dir):
    flagged = load(spark, sf_dir, "recieve_addr_info").select(
        "id", flags.blank_address_flag().alias("blank"))
    return flagged.groupBy("id").agg(F.min("blank").alias("every_row"),
                                     F.max("blank").alias("any_row"))


@query("agg_first_row", f"""
SELECT id, {o.flag("card_type = '信用卡'", "have_credit_card")} FROM card_first""")
def _(spark, sf_dir):
    cards = load(spark, sf_dir, "bankcard_info")
    first = dedup.first_per_key(cards, keep=["card_type"])
    return first.select("id", flags.equals_flag("card_type", vocab.CREDIT_CARD)
                        .alias("have_credit_card"))


@query("agg_other_key", """
SELECT c.id, c.bank_name, c.tail_num, b.bank_cnt FROM bankcard_info c LEFT JOIN (
  SELECT bank_name, COUNT(tail_num) AS bank_cnt FROM bankcard_info GROUP BY bank_name) b
ON c.bank_name = b.bank_name""")
def _(spark, sf_dir):
    cards = load(spark, sf_dir, "bankcard_info")
    return attach_aggregate(cards, "bank_name", F.count("tail_num").alias("bank_cnt")).select(
        "id", "bank_name", "tail_num", "bank_cnt")


@query("agg_month_pivot", "SELECT id, " + ", ".join(
    f"CAST(SUM(CASE WHEN m = '{m}' THEN 1 ELSE 0 END) AS BIGINT) AS {o.q(m)}"
    for m in ("9901", "9902", "0001", "0101", "00000000")) + """ FROM (SELECT id,
  COALESCE(substr(time_order, 3, 2) || substr(time_order, 6, 2), '00000000') AS m
  FROM order_info) GROUP BY id""")
def _(spark, sf_dir):
    return compact.order_month_counts(load(spark, sf_dir, "order_info"),
                                      ("9901", "9902", "0001", "0101", "00000000"))


@query("multi_hot_province", f"""
SELECT id, {o.hot("province", w.PROVINCES)} FROM addr_prepared GROUP BY id""")
def _(spark, sf_dir):
    grouped = load(spark, sf_dir, "recieve_addr_info").groupBy("id").agg(
        *counts.membership_masks(text.region_prefix("region"), w.PROVINCES, "m"))
    return grouped.select("id", *counts.membership_flags(w.PROVINCES, "m"))


@query("multi_hot_pay", f"SELECT id, {o.hot('pay', w.PAY_TYPES)} FROM order_filled GROUP BY id")
def _(spark, sf_dir):
    grouped = load(spark, sf_dir, "order_info").groupBy("id").agg(
        *counts.membership_masks(text.null_as_category("type_pay"), w.PAY_TYPES, "m"))
    return grouped.select("id", *counts.membership_flags(w.PAY_TYPES, "m"))


@query("multi_hot_status", f"SELECT id, {o.hot('sts', w.STATUSES)} FROM order_filled GROUP BY id")
def _(spark, sf_dir):
    grouped = load(spark, sf_dir, "order_info").groupBy("id").agg(
        *counts.membership_masks(text.null_as_category("sts_order"), w.STATUSES, "m"))
    return grouped.select("id", *counts.membership_flags(w.STATUSES, "m"))


@query("set_length", f"""
SELECT id, {o.set_size("pay", "pay_len")}, {o.set_size("sts", "status_len")}
FROM order_filled GROUP BY id""")
def _(spark, sf_dir):
    return load(spark, sf_dir, "order_info").groupBy("id").agg(
        counts.set_length(text.null_as_category("type_pay")).alias("pay_len"),
        counts.set_length(text.null_as_category("sts_order")).alias("status_len"))


# ---- joins, ranks, scaling --------------------------------------------------------------------

@query("join_spine", """
SELECT target.id, target.target, quota, sex FROM target
LEFT JOIN credit_info ON target.id = credit_info.id LEFT JOIN user_info ON target.id = user_info.id""")
def _(spark, sf_dir):
    spine, credit, users = load(spark, sf_dir, "target", "credit_info", "user_info")
    return join_features(spine.select("id", "target"),
                         [credit.select("id", "quota"), users.select("id", "sex")])


@query("join_back", """
SELECT c.id, c.tail_num, n.card_1_cnt FROM bankcard_info c LEFT JOIN (
  SELECT id, CAST(SUM(CASE WHEN card_type = '储蓄卡' THEN 1 ELSE 0 END) AS BIGINT) AS card_1_cnt
  FROM bankcard_info GROUP BY id) n ON c.id = n.id""")
def _(spark, sf_dir):
    debit = counts.count_where(F.col("card_type") == vocab.DEBIT_CARD).alias("card_1_cnt")
    return attach_aggregate(load(spark, sf_dir, "bankcard_info"), "id", debit).select(
        "id", "tail_num", "card_1_cnt")


@query("join_suffix", """
SELECT target.id, b.p AS phones_x, r.p AS phones_y, a.p AS phones FROM target
LEFT JOIN (SELECT id, COUNT(phone) AS p FROM bankcard_info GROUP BY id) b ON target.id = b.id
LEFT JOIN (SELECT id, COUNT(phone) AS p FROM order_info GROUP BY id) r ON target.id = r.id
LEFT JOIN (SELECT id, COUNT(phone) AS p FROM recieve_addr_info GROUP BY id) a ON target.id = a.id""")
def _(spark, sf_dir):
    spine, *details = load(spark, sf_dir, "target", "bankcard_info", "order_info",
                           "recieve_addr_info")
    return join_features(spine.select("id"), [
        d.groupBy("id").agg(F.count("phone").alias("phones")) for d in details])


@query("global_rank", "SELECT id, credit_score, credit_score_rank FROM credit_ranked")
def _(spark, sf_dir):
    ranked = wide.credit_ranked(load(spark, sf_dir, "credit_info"))
    return ranked.select("id", "credit_score", "credit_score_rank")


@query("global_rank_tied_lines", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_discount,
  ROW_NUMBER() OVER (ORDER BY l_discount DESC, l_orderkey, l_linenumber, l_partkey,
    l_extendedprice) AS place FROM lineitem""")
def _(spark, sf_dir):
    lines = w.given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount")
    return ordering.global_row_number(
        lines, F.col("l_discount").desc(), "l_orderkey", "l_linenumber", "l_partkey",
        "l_extendedprice", name="place")


@query("minmax_scale", f"""
SELECT id, {o.scaled("quota", "quota")}, {o.scaled("overdraft", "overdraft")} FROM credit_info""")
def _(spark, sf_dir):
    credit = load(spark, sf_dir, "credit_info").select("id", "quota", "overdraft")
    return scaling.scale_columns(credit, ["quota", "overdraft"])


# ---- feature plans ----------------------------------------------------------------------------

def _wide(spark, sf_dir, role="train", tables=None):
    tables = tables or w.tables(spark, sf_dir, role)
    return wide.wide_matrix(tables, tables["target" if role == "train" else "list"], pay_types=w.PAY_TYPES,
                            statuses=w.STATUSES, provinces=w.PROVINCES, grades=w.GRADES)


def _compact(spark, sf_dir, role="train", tables=None):
    tables = tables or w.tables(spark, sf_dir, role)
    return compact.compact_matrix(tables, tables["target" if role == "train" else "list"], grades=w.GRADES, ways=w.PAY_WAYS,
                                  status_words=w.STATUS_WORDS)


@query("wide_credit", o.rounded("wide_credit", CREDIT_DOUBLES))
def _(spark, sf_dir):
    return rounded(wide.credit_features(load(spark, sf_dir, "credit_info")), CREDIT_DOUBLES)


@query("wide_user", "SELECT * FROM wide_user")
def _(spark, sf_dir):
    return wide.user_features(load(spark, sf_dir, "user_info"), w.GRADES)


@query("wide_address", "SELECT * FROM wide_address")
def _(spark, sf_dir):
    return wide.address_features(load(spark, sf_dir, "recieve_addr_info"), w.PROVINCES)


@query("wide_bankcard", "SELECT * FROM wide_bankcard")
def _(spark, sf_dir):
    return wide.bankcard_features(load(spark, sf_dir, "bankcard_info"))


@query("wide_auth", "SELECT * FROM wide_auth")
def _(spark, sf_dir):
    return wide.auth_features(load(spark, sf_dir, "auth_info"))


@query("wide_order", o.rounded("wide_order", ORDER_DOUBLES))
def _(spark, sf_dir):
    return rounded(wide.order_features(load(spark, sf_dir, "order_info"), w.PAY_TYPES, w.STATUSES),
                   ORDER_DOUBLES)


@query("wide_time", "SELECT * FROM wide_time")
def _(spark, sf_dir):
    return wide.application_gap_features(*load(spark, sf_dir, "auth_info", "target"))


@query("wide_order_time", "SELECT * FROM wide_order_time")
def _(spark, sf_dir):
    return wide.order_gap_features(*load(spark, sf_dir, "order_info", "target"))


@query("wide_matrix", o.rounded("wide_matrix", WIDE_DOUBLES))
def _(spark, sf_dir):
    return rounded(_wide(spark, sf_dir), WIDE_DOUBLES)


@query("compact_auth", "SELECT * FROM compact_auth")
def _(spark, sf_dir):
    return compact.auth_features(load(spark, sf_dir, "auth_info"))


@query("compact_bankcard", "SELECT * FROM compact_bankcard")
def _(spark, sf_dir):
    return compact.bankcard_features(load(spark, sf_dir, "bankcard_info"))


@query("compact_credit", "SELECT * FROM compact_credit")
def _(spark, sf_dir):
    return compact.credit_features(load(spark, sf_dir, "credit_info"))


@query("compact_order", "SELECT * FROM compact_order")
def _(spark, sf_dir):
    return compact.order_features(load(spark, sf_dir, "order_info"), w.PAY_WAYS, w.STATUS_WORDS)


@query("compact_address", "SELECT * FROM compact_address")
def _(spark, sf_dir):
    return compact.address_features(load(spark, sf_dir, "recieve_addr_info"))


@query("compact_user", "SELECT * FROM compact_user")
def _(spark, sf_dir):
    return compact.user_features(load(spark, sf_dir, "user_info"), w.GRADES)


@query("compact_days", "SELECT * FROM compact_days")
def _(spark, sf_dir):
    return compact.days_features(*load(spark, sf_dir, "auth_info", "target"))


@query("compact_auth_order", "SELECT * FROM compact_auth_order")
def _(spark, sf_dir):
    return compact.auth_order_features(*load(spark, sf_dir, "auth_info", "order_info"))


@query("compact_matrix", "SELECT * FROM compact_matrix")
def _(spark, sf_dir):
    return _compact(spark, sf_dir)


# ---- selection --------------------------------------------------------------------------------

TOP_K = 40


def _score_frames(spark, sf_dir):
    matrix = materialize(_wide(spark, sf_dir), "matrix")
    names = selection.selectable_features(matrix)
    return [rounded(fn(matrix, names), ["score"], 6)
            for fn in (selection.variance_scores, selection.chi2_scores)]


@query("select_variance", f"SELECT feature, score FROM variance_scores {o.TOP} {TOP_K}")
def _(spark, sf_dir):
    variance, _chi2 = _score_frames(spark, sf_dir)
    return ordering.top_features(variance, TOP_K).select("feature", "score")


@query("select_chi2", f"SELECT feature, score FROM chi2_scores {o.TOP} {TOP_K}")
def _(spark, sf_dir):
    _variance, chi2 = _score_frames(spark, sf_dir)
    return ordering.top_features(chi2, TOP_K).select("feature", "score")


@query("select_combine", f"""
SELECT feature FROM (SELECT feature FROM variance_scores {o.TOP} {TOP_K})
INTERSECT SELECT feature FROM (SELECT feature FROM chi2_scores {o.TOP} {TOP_K})""")
def _(spark, sf_dir):
    variance, chi2 = _score_frames(spark, sf_dir)
    variance = materialize(variance, "scores")  # read twice, one row a feature
    names = selection.combine_names(selection.top_names(variance, TOP_K),
                                    selection.top_names(chi2, TOP_K))
    return variance.filter(F.col("feature").isin(names)).select("feature")


@query("select_binary_split", """
SELECT feature, CASE WHEN n = 2 THEN 'binary' ELSE 'continuous' END AS kind FROM binary_flags""")
def _(spark, sf_dir):
    matrix = materialize(_wide(spark, sf_dir), "matrix")
    names = selection.selectable_features(matrix)
    binary = set(selection.binary_columns(matrix, names))
    return spark.createDataFrame([(n, "binary" if n in binary else "continuous") for n in names], "feature string, kind string")


_CUT = [c for c in f.COLUMNS if c != "credit_score"]  # a credit score may be negative
_CUT_K = 5


@query("select_chi2_matrices", f"""
SELECT matrix, CAST(row_number() OVER (PARTITION BY matrix ORDER BY place) - 1 AS INTEGER) AS position, feature
FROM (SELECT list_position([{", ".join(map(o.s, _CUT))}], feature) AS place, feature, score
  FROM (UNPIVOT (SELECT {", ".join(f"{o._chi2(c)} AS {o.q(c)}" for c in _CUT)} FROM ({f.ORACLE})
    WHERE substr(replace(appl_sbm_tm, '-', ''), 1, 6) BETWEEN '{w.TRAIN_MONTHS[0]}' AND '{w.TRAIN_MONTHS[1]}')
    ON COLUMNS(*) INTO NAME feature VALUE score)
  ORDER BY score DESC NULLS LAST, place DESC LIMIT {_CUT_K}), (VALUES ('train'), ('validate'), ('test'), ('train_test')) m(matrix)""")
def _(spark, sf_dir):
    """The columns of all four matrices after the cut that the training one selects."""
    labelled = materialize(_facts(spark, sf_dir), "facts")
    train, held = _splits(labelled)
    cut = chi2_cut.cut_matrices({"train": train, "validate": held, "test": labelled.drop("target"), "train_test": labelled},
                                _CUT, _CUT_K)
    names = [(m, i, c) for m, df in cut.items() for i, c in enumerate(selection.feature_columns(df))]
    return spark.createDataFrame(names, "matrix string, position int, feature string")


@query("topk_features", f"""
SELECT position, feature, score FROM variance_scores {o.TOP} 20""")
def _(spark, sf_dir):
    return ordering.top_features(_score_frames(spark, sf_dir)[0], 20)


# ---- evaluation and blending ------------------------------------------------------------------

def _auc_sql(score):
    return f"""
SELECT SUM(pos * (lower + CAST(neg AS DOUBLE) / 2)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)) AS auc,
  CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives
FROM (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND
    1 PRECEDING), 0) AS lower
  FROM (SELECT {score} AS score, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS pos,
      COUNT(*) FILTER (WHERE l_returnflag <> 'R') AS neg FROM lineitem GROUP BY {score}))"""


def _returned(spark, sf_dir):
    return w.given(spark, sf_dir, "lineitem").select(
        flags.equals_flag("l_returnflag", "R").alias("target"), "l_discount", "l_extendedprice")


@query("auc_exact", _auc_sql("l_discount"))
def _(spark, sf_dir):
    return exact_auc(_returned(spark, sf_dir), score="l_discount")


@query("auc_exact_continuous", _auc_sql("l_extendedprice"))
def _(spark, sf_dir):
    return exact_auc(_returned(spark, sf_dir), score="l_extendedprice")


_SCORE_SQL = {
    "a": "SELECT c_custkey AS ID, CAST(c_custkey % 997 AS DOUBLE) / CAST(997 AS DOUBLE) AS PROB"
         " FROM customer",
    "b": "SELECT o_custkey AS ID, CAST(COUNT(*) AS DOUBLE) / CAST(100 AS DOUBLE) AS PROB"
         " FROM orders GROUP BY o_custkey",
    "c": "SELECT user_id AS ID, CAST(COUNT(*) AS DOUBLE) / CAST(64 AS DOUBLE) AS PROB"
         " FROM events GROUP BY user_id",
}


def _scores(spark, sf_dir):
    customer, orders, events = (w.given(spark, sf_dir, t)
                                for t in ("customer", "orders", "events"))
    a = customer.select(F.col("c_custkey").alias("ID"),
                        ((F.col("c_custkey") % 997).cast("double") / 997.0).alias("PROB"))
    b = orders.groupBy(F.col("o_custkey").alias("ID")).agg(
        (F.count(F.lit(1)).cast("double") / 100.0).alias("PROB"))
    c = events.groupBy(F.col("user_id").alias("ID")).agg(
        (F.count(F.lit(1)).cast("double") / 64.0).alias("PROB"))
    return a, b, c


@query("blend_two", f"""
SELECT a.ID, a.PROB * CAST(0.5 AS DOUBLE) + b.PROB * CAST(0.5 AS DOUBLE) AS PROB
FROM ({_SCORE_SQL["a"]}) a LEFT JOIN ({_SCORE_SQL["b"]}) b ON a.ID = b.ID""")
def _(spark, sf_dir):
    a, b, _c = _scores(spark, sf_dir)
    return blend_two(a, b)


@query("blend_three", f"""
SELECT a.ID, a.PROB * CAST(0.4 AS DOUBLE) + b.PROB * CAST(0.2 AS DOUBLE)
  + c.PROB * CAST(0.4 AS DOUBLE) AS PROB
FROM ({_SCORE_SQL["a"]}) a LEFT JOIN ({_SCORE_SQL["b"]}) b ON a.ID = b.ID
  LEFT JOIN ({_SCORE_SQL["c"]}) c ON a.ID = c.ID""")
def _(spark, sf_dir):
    return blend_three(*_scores(spark, sf_dir))


# ---- sources and sinks ------------------------------------------------------------------------

def _scratch(spark, label):
    import uuid
    return f"{shared_dir(spark).rstrip('/')}/riskloom/{label}-{uuid.uuid4().hex}"


@query("source_csv_orders", """
SELECT CAST(id AS STRING) AS id, NULLIF(amt_order, 'null') AS amt_order, type_pay, time_order,
  sts_order, phone, name_rec_md5, unit_price FROM order_info""")
def _(spark, sf_dir):
    from riskloom.sources.tables import read_table
    path = _scratch(spark, "orders-csv")
    load(spark, sf_dir, "order_info").write.csv(path, **CSV_OUT)
    return read_table(spark, path, "order_info").drop("no_order_md5", "product_id_md5")


@query("source_csv_tables", """
SELECT CAST(t.id AS STRING) AS id, t.target, quota, sex, auth_time FROM target t
LEFT JOIN credit_info c ON t.id = c.id LEFT JOIN user_info u ON t.id = u.id
LEFT JOIN auth_info a ON t.id = a.id""")
def _(spark, sf_dir):
    from riskloom.sources.tables import read_tables
    root = _scratch(spark, "tables")
    for name, df in w.tables(spark, sf_dir).items():
        df.write.csv(f"{root}/train_{name}.csv", **CSV_OUT)
    t = read_tables(spark, root, "train")
    return join_features(t["target"].select("id", "target"), [
        t["credit_info"].select("id", "quota"), t["user_info"].select("id", "sex"),
        t["auth_info"].select("id", "auth_time")])


@query("source_csv_score_tables", """
SELECT CAST(t.id AS STRING) AS id, t.appl_sbm_tm, quota, sex, auth_time FROM target t
LEFT JOIN credit_info c ON t.id = c.id LEFT JOIN user_info u ON t.id = u.id
LEFT JOIN auth_info a ON t.id = a.id""", role="score")
def _(spark, sf_dir):
    """The second set of tables, which has applicants of its own and no labels."""
    from riskloom.sources.tables import read_tables
    root = _scratch(spark, "score-tables")
    for name, df in w.tables(spark, sf_dir, "score").items():
        df.write.csv(f"{root}/score_{name}.csv", **CSV_OUT)
    t = read_tables(spark, root, "score")
    return join_features(t["list"].select("id", "appl_sbm_tm"), [
        t["credit_info"].select("id", "quota"), t["user_info"].select("id", "sex"),
        t["auth_info"].select("id", "auth_time")])


@query("wide_score_matrix", o.rounded("(SELECT * EXCLUDE (target) FROM wide_matrix)", WIDE_DOUBLES), role="score")
def _(spark, sf_dir):
    return rounded(_wide(spark, sf_dir, "score"), WIDE_DOUBLES)


@query("compact_score_matrix", "SELECT * EXCLUDE (target) FROM compact_matrix", role="score")
def _(spark, sf_dir):
    return _compact(spark, sf_dir, "score")


@query("matrix_roundtrip", o.rounded("wide_matrix", WIDE_DOUBLES) + """
WHERE substr(replace(appl_sbm_tm, '-', ''), 1, 6) BETWEEN '199901' AND '200106'""")
def _(spark, sf_dir):
    from riskloom.sources.sinks import write_matrices
    from riskloom.sources.tables import read_matrix
    paths = write_matrices(_wide(spark, sf_dir), lambda stored: stored.drop("target"), _scratch(spark, "matrices"),
                           w.TRAIN_MONTHS, w.VALIDATION_MONTH)
    return rounded(read_matrix(spark, paths["train"]), WIDE_DOUBLES)


@query("month_partitions", f"""
SELECT *, CASE WHEN m = '{w.VALIDATION_MONTH}' THEN 'validate' ELSE 'train' END AS part, false AS other FROM
  (SELECT id, target, quota, substr(replace(appl_sbm_tm, '-', ''), 1, 6) AS m FROM ({f.ORACLE}))
WHERE m BETWEEN '{w.TRAIN_MONTHS[0]}' AND '{w.VALIDATION_MONTH}'
UNION ALL SELECT id, target, quota, substr(replace(appl_sbm_tm, '-', ''), 1, 6), 'other', true FROM ({f.ORACLE})
WHERE substr(replace(appl_sbm_tm, '-', ''), 1, 6) <> '{w.VALIDATION_MONTH}'""")
def _(spark, sf_dir):
    """Train, validation and every other month, cut from one matrix stored by month."""
    from riskloom.sources.sinks import write_monthly
    from riskloom.sources.tables import read_month_split, read_monthly
    path = _scratch(spark, "monthly")
    write_monthly(_facts(spark, sf_dir), path)
    other, held = read_month_split(spark, path, w.VALIDATION_MONTH)
    parts = {"train": read_monthly(spark, path, *w.TRAIN_MONTHS), "validate": held, "other": other}
    return functools.reduce(DataFrame.unionByName, [
        df.select("id", "target", "quota", text.month_key("appl_sbm_tm").alias("m"), F.lit(name).alias("part"),
                  F.lit(name == "other").alias("other")) for name, df in parts.items()])


@query("wide_matrix_bucketed", o.rounded("wide_matrix", WIDE_DOUBLES))
def _(spark, sf_dir):
    """The wide matrix from tables that are stored in buckets by id."""
    return rounded(wide.wide_matrix(*_bucketed(spark, sf_dir)), WIDE_DOUBLES)


def _bucketed(spark, sf_dir, buckets=None):
    """The tables and their spine, stored in buckets under a name of their own. All later steps by id have one task a bucket."""
    import uuid

    from riskloom.sources.sinks import write_bucketed
    from riskloom.sources.tables import read_bucketed
    prefix = f"bucketed_{uuid.uuid4().hex}"
    given = w.tables(spark, sf_dir)
    buckets = buckets or max(8, spark.sparkContext.defaultParallelism)
    write_bucketed(given, prefix, _scratch(spark, "buckets"), buckets)
    stored = read_bucketed(spark, prefix, given)
    return stored, stored["target"]


@query("scores_blend_roundtrip", f"""
SELECT a.ID, a.PROB * CAST(0.5 AS DOUBLE) + b.PROB * CAST(0.5 AS DOUBLE) AS PROB
FROM ({_SCORE_SQL["a"]}) a LEFT JOIN ({_SCORE_SQL["b"]}) b ON a.ID = b.ID""")
def _(spark, sf_dir):
    """Two score files, read, blended, written and read again."""
    from riskloom.sources.sinks import write_scores
    from riskloom.sources.tables import read_scores
    a, b, _c = _scores(spark, sf_dir)
    paths = [_scratch(spark, "scores") for _ in range(3)]
    write_scores(a, paths[0], "csv")
    write_scores(b, paths[1], "csv")
    write_scores(blend_two(read_scores(spark, paths[0], "csv"), read_scores(spark, paths[1], "csv")), paths[2], "csv")
    return read_scores(spark, paths[2], "csv").withColumn("ID", F.col("ID").cast("bigint"))


@query("scores_roundtrip", _SCORE_SQL["a"])
def _(spark, sf_dir):
    from riskloom.sources.sinks import write_scores
    from riskloom.sources.tables import read_scores
    path = _scratch(spark, "scores")
    write_scores(_scores(spark, sf_dir)[0], path, "csv")
    return read_scores(spark, path, "csv").withColumn("ID", F.col("ID").cast("bigint"))


@query("preview_shape", f"""
SELECT COUNT(*) AS row_count, CAST({len(o.WIDE_FEATURES) + 3} AS INTEGER) AS column_count
FROM wide_matrix""")
def _(spark, sf_dir):
    matrix = _wide(spark, sf_dir)
    return matrix.agg(F.count(F.lit(1)).alias("row_count"),
                      F.lit(len(matrix.columns)).alias("column_count"))


@query("preview_rows", o.rounded("wide_matrix", WIDE_DOUBLES) + " ORDER BY id LIMIT 5")
def _(spark, sf_dir):
    return rounded(_wide(spark, sf_dir), WIDE_DOUBLES).orderBy("id").limit(5)


# ---- models on the facts, with SQL ------------------------------------------------------------

def _facts(spark, sf_dir):
    return f.facts(spark, w.tables(spark, sf_dir, stored=False))


@query("second_moments", f.moments_sql())
def _(spark, sf_dir):
    return moments.as_pairs(_facts(spark, sf_dir), [*f.COLUMNS, "target"])


@query("extra_trees_importances", f.extra_trees_sql(6, 4, 3))
def _(spark, sf_dir):
    return rounded(extra_trees.importance_scores(
        _facts(spark, sf_dir), f.COLUMNS, trees=6, depth=4, per_node=3), ["score"])


def _fixed_ensemble(spark):
    return spark.createDataFrame(f.ENSEMBLE, tree_table.SCHEMA)


@query("ensemble_scores", f"""
SELECT id AS ID, round(1 / (1 + exp(-2 * ({f.margin_sql(3)}))), 9) AS PROB, target FROM ({f.ORACLE})""")
def _(spark, sf_dir):
    """Scores of a fixed ensemble stored as a table, by joins with its nodes."""
    return rounded(tree_table.table_scores(_fixed_ensemble(spark), _facts(spark, sf_dir), f.COLUMNS), ["PROB"])


def _grouped_auc_sql(rows, group):
    """Pairs of a positive and a negative by a running total of the negatives in each group; ``rows`` has group, target, score."""
    return f"""
SELECT {group}, SUM(pos * (lower + CAST(neg AS DOUBLE) / 2)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)) AS auc,
  CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives
FROM (SELECT *, COALESCE(SUM(neg) OVER (PARTITION BY {group} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower
  FROM (SELECT {group}, score, COUNT(*) FILTER (WHERE target = 1) AS pos, COUNT(*) FILTER (WHERE target <> 1) AS neg
    FROM ({rows}) GROUP BY {group}, score)) GROUP BY {group}"""


@query("auc_by_group", _grouped_auc_sql("""
SELECT l_linenumber, l_extendedprice AS score, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target FROM lineitem""",
                                        "l_linenumber"))
def _(spark, sf_dir):
    lines = w.given(spark, sf_dir, "lineitem").withColumn("target", flags.equals_flag("l_returnflag", "R"))
    return tree_table.grouped_auc(lines, "l_linenumber", score="l_extendedprice")


_WATCHED = " UNION ALL ".join(f"SELECT CAST({r} AS INTEGER) AS round, held, target, {f.margin_sql(r)} AS score FROM sides" for r in (1, 2, 3))


@query("ensemble_watch_list", f"""
SELECT * FROM (WITH sides AS (SELECT *, replace(substr(appl_sbm_tm, 1, 7), '-', '') >= '200001' AS held FROM ({f.ORACLE})), watched AS ({_WATCHED})
SELECT round, round(max(auc) FILTER (WHERE NOT held), 9) AS train_auc, round(max(auc) FILTER (WHERE held), 9) AS validation_auc
FROM (SELECT grp // 2 AS round, grp % 2 = 1 AS held, auc FROM ({_grouped_auc_sql(
    "SELECT 2 * round + CAST(held AS INTEGER) AS grp, target, score FROM watched", "grp")})) GROUP BY round)""")
def _(spark, sf_dir):
    """AUC of both sides of a split after every round of the fixed ensemble."""
    facts = materialize(_facts(spark, sf_dir), "facts")
    held = text.month_key("appl_sbm_tm") >= "200001"
    watched = tree_table.watch_list(_fixed_ensemble(spark), facts.filter(~held), facts.filter(held), f.COLUMNS)
    return rounded(watched, ["train_auc", "validation_auc"])


# ---- models (no SQL counterpart) --------------------------------------------------------------

def _splits(matrix):
    train = clean.months_between(matrix, *w.TRAIN_MONTHS)
    held = clean.months_between(matrix, w.VALIDATION_MONTH, w.VALIDATION_MONTH)
    return train, held


def _model_tables(spark, sf_dir, build):
    matrix = materialize(build(spark, sf_dir), "matrix")
    return matrix, selection.selectable_features(matrix)


_fits = {}


def _compact_fit(spark, sf_dir):
    """The published fit on the compact matrix: model, feature names, both sides of the split. Fitted once per session and data."""
    from riskloom.operators import models as m
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _fits:
        matrix, names = _model_tables(spark, sf_dir, _compact)
        train, held = clean.split_off_month(matrix, w.VALIDATION_MONTH)
        _fits[key] = m.fit(train, names, m.boosted_trees(m.COMPACT_TREES), m.MISSING), names, train, held
    return _fits[key]


@query("gbt_compact_scores")
def _(spark, sf_dir):
    from riskloom.operators import models as m
    model, names, _train, held = _compact_fit(spark, sf_dir)
    return m.score(model, held, names, m.MISSING)


@query("gbt_table_scores")
def _(spark, sf_dir):
    """The like from the model's nodes as a table, without the model."""
    from riskloom.operators import models as m
    model, names, _train, held = _compact_fit(spark, sf_dir)
    return tree_table.table_scores(tree_table.ensemble_table(model), held, names, m.MISSING)


@query("split_counts_top20")
def _(spark, sf_dir):
    model, names, _train, _held = _compact_fit(spark, sf_dir)
    return ordering.top_features(tree_table.split_counts(tree_table.ensemble_table(model), names), 20)


@query("gbt_watch_list")
def _(spark, sf_dir):
    """AUC on both sides after every round."""
    from riskloom.operators import models as m
    model, names, train, held = _compact_fit(spark, sf_dir)
    return tree_table.watch_list(tree_table.ensemble_table(model), train, held, names, m.MISSING)


@query("gbt_wide_scores")
def _(spark, sf_dir):
    from riskloom.operators import models as m
    matrix, names = _model_tables(spark, sf_dir, _wide)
    train, held = _splits(matrix)
    trees = m.boosted_trees(m.WIDE_TREES)
    return m.fit_and_score(train, held, names, trees)


@query("lr_wide_scores")
def _(spark, sf_dir):
    from riskloom.operators import models as m
    matrix, names = _model_tables(spark, sf_dir, _wide)
    train, held = _splits(matrix)
    return m.fit_and_score(train, held, names, m.ridge_logistic(train))


@query("gbt_selected_scores")
def _(spark, sf_dir):
    """Listed features only, fitted on every labelled row and applied to the scoring set."""
    from riskloom.operators import models as m
    lines = functools.cache(lambda: w.joined_lines(spark, sf_dir))
    matrix, new = (materialize(_wide(spark, sf_dir, role, w.tables(spark, sf_dir, role, joined=lines)), "matrix") for role in ("train", "score"))
    listed = selection.listed_features(matrix, vocab.TREE_FEATURES)
    trees = m.boosted_trees(m.SELECTED_TREES)
    return m.fit_and_score(matrix, new, listed, trees)


@query("final_scores")
def _(spark, sf_dir):
    """Both matrices, three models fitted side by side, and the published blend of their scores.

    The joined lines are made once for both roles, the tables of a role once for both its matrices, and the compact model does not wait for
    the wide matrices.
    """
    from riskloom.operators import models as m
    from riskloom.plans import scoring
    folder = shared_path(spark, "scores")
    lines = functools.cache(lambda: w.joined_lines(spark, sf_dir))
    tables = {role: w.tables(spark, sf_dir, role, joined=lines) for role in ("train", "score")}

    def matrices(build):
        return [materialize(build(spark, sf_dir, role, tables[role]), "matrix") for role in tables]

    # One matrix at a time, so that the disk holds the shuffles of one.
    small, small_new = matrices(_compact)
    with ThreadPoolExecutor(1) as thread:
        compact_job = {"compact": lambda: scoring.compact_trees(small, small_new)}
        waiting = thread.submit(inheritable_thread_target(spark)(m.stored_results), spark, compact_job, folder)
        dense, dense_new = matrices(_wide)
        found = m.stored_results(spark, {
            "trees": lambda: scoring.wide_trees(dense, dense_new, selection.listed_features(dense, vocab.TREE_FEATURES)),
            "linear": lambda: scoring.wide_linear(dense, dense_new, selection.listed_features(dense, vocab.LINEAR_FEATURES))}, folder)
        found |= waiting.result()
    return scoring.final_scores(found["compact"], found["linear"], found["trees"])


@query("holdout_auc")
def _(spark, sf_dir):
    from riskloom.operators import models as m
    matrix, _names = _model_tables(spark, sf_dir, _wide)
    train, held = _splits(matrix)
    listed = selection.listed_features(matrix, vocab.LINEAR_FEATURES)
    scored = m.fit_and_score(train, held, listed, m.ridge_logistic(train))
    return exact_auc(scored, score="PROB")


@query("importance_top20")
def _(spark, sf_dir):
    from riskloom.operators import models as m
    matrix, names = _model_tables(spark, sf_dir, _compact)
    trees = m.boosted_trees(m.COMPACT_TREES)
    model = m.fit(matrix, names, trees, m.MISSING)
    return ordering.top_features(m.importance_scores(model, spark, names), 20)


@query("gbt_round_losses")
def _(spark, sf_dir):
    from riskloom.operators import models as m
    model, names, train, held = _compact_fit(spark, sf_dir)
    return m.round_losses(model, spark, train, held, names, m.MISSING)


@query("select_trees")
def _(spark, sf_dir):
    """300 extremely randomised trees of depth 7 on all features."""
    from riskloom.operators import models as m
    matrix, names = _model_tables(spark, sf_dir, _wide)
    return ordering.top_features(m.forest_scores(matrix, names), TOP_K)


@query("select_linear_elimination")
def _(spark, sf_dir):
    """Every feature's place in recursive elimination by 1."""
    matrix, names = _model_tables(spark, sf_dir, _wide)
    return moments.elimination(matrix, names, keep=TOP_K)
