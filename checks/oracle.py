"""Plain SQL for the checked queries, written from the definitions rather than the Spark plans.

Common table expressions are named pieces; :func:`with_pieces` prepends the ones a
statement needs.
"""

import re

from checks import warehouse as w
from riskloom import vocab


def q(name):
    return '"' + name.replace('"', '""') + '"'


def s(value):
    return "'" + value.replace("'", "''") + "'"


def flag(condition, name):
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS INTEGER) AS {q(name)}"


def scaled(expr, name):
    """Min-max over all rows; a constant column gives null."""
    low, high = f"MIN({expr}) OVER ()", f"MAX({expr}) OVER ()"
    return (f"CAST(({expr} - {low}) AS DOUBLE) / NULLIF(CAST(({high} - {low}) AS DOUBLE), 0) "
            f"AS {q(name)}")


def distinct_null(c, name):
    return (f"CAST(COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) "
            f"AS {q(name)}")


def total(condition, name):
    return f"CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT) AS {q(name)}"


def hot(c, values, rename=None):
    rename = rename or {}
    return ", ".join(
        f"CAST(MAX(CASE WHEN {c} = {s(v)} THEN 1 ELSE 0 END) AS INTEGER) AS {q(rename.get(v, v))}"
        for v in values)


def set_size(c, name):
    return (f"CAST(CASE WHEN MAX(CASE WHEN {c} = 'null' THEN 1 ELSE 0 END) = 1 THEN 0 "
            f"ELSE COUNT(DISTINCT {c}) END AS BIGINT) AS {q(name)}")


def numbered_flags(c, prefix, values):
    return ", ".join(flag(f"{c} = {s(v)}", f"{prefix}{i}") for i, v in enumerate(values, start=1))


PIECES = {name: sql.format(**{t: t for t in w.SOURCES[name]}) for name, sql in w.TABLE_SQL.items()}

# ---- wide set ---------------------------------------------------------------------------------

PIECES["credit_filled"] = """
SELECT id, COALESCE(credit_score, (SELECT AVG(credit_score) FROM credit_info)) AS credit_score,
  COALESCE(overdraft, 0) AS overdraft, COALESCE(quota, 0) AS quota,
  COALESCE(quota, 0) - COALESCE(overdraft, 0) AS quota_surplus
FROM credit_info"""
PIECES["credit_ranked"] = """
SELECT *, ROW_NUMBER() OVER (ORDER BY credit_score DESC, id) AS credit_score_rank
FROM credit_filled"""
CREDIT_SCALED = ("credit_score", "overdraft", "quota", "quota_surplus", "credit_score_rank")
PIECES["wide_credit"] = f"""
SELECT id, {", ".join(scaled(c, c) for c in CREDIT_SCALED)},
  {flag("quota = 0", "quota_is_zero")},
  CASE WHEN quota = 0 THEN CAST(0 AS DOUBLE) ELSE overdraft / quota END AS quota_rate,
  1 AS all_is_null, {flag("credit_score = 0 AND overdraft = 0 AND quota = 0", "all_is_zero")},
  {flag("credit_score = 0", "credit_score_is_null")},
  {flag("quota_surplus = 0 AND quota <> 0", "quota_surplus_is_null")}
FROM credit_ranked"""

PIECES["user_aged"] = r"""
SELECT *, CASE WHEN regexp_matches(birthday, '^\d{4}-\d{1,2}-\d{1,2}$')
    AND TRY_CAST(birthday AS DATE) IS NOT NULL
  THEN 2018 - CAST(substr(birthday, 1, 4) AS INTEGER) ELSE 0 END AS age
FROM user_info"""
AGE_FLAGS = ", ".join([flag("age > 0 AND age <= 18", "age_one"),
                       flag("age > 18 AND age <= 30", "age_two"),
                       flag("age > 30 AND age <= 60", "age_three"),
                       flag("age > 60 AND age <= 100", "age_four"), "0 AS age_five"])
PIECES["wide_user"] = f"""
SELECT id, {flag("birthday = '0000-00-00'", "birthday_is_zero")},
  {flag("sex IS NULL OR sex <> '女'", "sex_not_male")}, {flag("sex = '男'", "female")},
  {flag("sex = '女'", "male")}, {flag("sex = '保密'", "sex_secret")},
  {numbered_flags("merriage", "merriage", vocab.MARRIAGE)},
  {flag("merriage IS NULL", "merriage_is_null")},
  {numbered_flags("account_grade", "account_grade", w.GRADES)},
  {flag("account_grade IS NULL", "account_grade_is_null")},
  {flag("qq_bound IS NULL", "qq_bound_is_null")},
  {flag("wechat_bound IS NULL", "wechat_bound_is_null")},
  {flag("degree IN ('硕士', '其他', '博士')", "degree")},
  {flag("id_card IS NULL", "id_card_is_null")},
  {numbered_flags("income", "income", vocab.INCOME_BANDS)}, {AGE_FLAGS}
FROM user_aged"""

PIECES["addr_prepared"] = """
SELECT *, COALESCE(substr(region, 1, 2), 'null') AS province,
  CASE WHEN addr_id IS NULL AND region IS NULL AND phone IS NULL
    AND (fix_phone IS NULL OR receiver_md5 IS NULL) THEN 1 ELSE 0 END AS all_null
FROM recieve_addr_info"""
PIECES["wide_address"] = f"""
SELECT id, CAST(MIN(all_null) AS INTEGER) AS all_null, COUNT(*) AS record_count,
  {hot("province", w.PROVINCES)}, {set_size("province", "province_len")}
FROM addr_prepared GROUP BY id"""

PIECES["cards_distinct"] = "SELECT DISTINCT * FROM bankcard_info"
PIECES["card_first"] = """
SELECT id, card_type FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY bank_name NULLS FIRST,
    tail_num NULLS FIRST, card_type NULLS FIRST, phone NULLS FIRST) AS rn
  FROM cards_distinct) WHERE rn = 1"""
PIECES["card_counts"] = f"""
SELECT id, {distinct_null("phone", "phone_count")}, COUNT(phone) AS card_record_count,
  {total("card_type = '储蓄卡'", "store_card_count")},
  {distinct_null("card_type", "card_category_count")}
FROM cards_distinct GROUP BY id"""
PIECES["wide_bankcard"] = f"""
SELECT c.id, phone_count, card_record_count, store_card_count,
  {flag("f.card_type = '信用卡'", "have_credit_card")}, card_category_count,
  card_record_count - store_card_count AS credit_count,
  {flag("card_record_count > 6", "card_count_one")},
  {flag("card_record_count = 1", "record_is_unique")}
FROM card_counts c JOIN card_first f ON c.id = f.id"""

PIECES["wide_auth"] = f"""
SELECT id, {flag("id_card IS NOT NULL", "auth_id_card_is_null")},
  {flag("auth_time IS NOT NULL", "auth_time_is_null")},
  {flag("phone IS NOT NULL", "phone_is_null")},
  {flag("id_card IS NULL AND auth_time IS NULL AND phone IS NULL", "all_is_null")},
  {flag("id_card IS NOT NULL AND auth_time IS NOT NULL AND phone IS NOT NULL", "all_not_null")},
  {flag("id_card IS NULL AND auth_time IS NULL", "card_time_is_null")},
  {flag("phone IS NULL AND auth_time IS NULL", "time_phone_is_null")}
FROM auth_info"""

PIECES["amount_mean"] = """
SELECT AVG(CAST(amt_order AS DOUBLE)) AS mean FROM order_info
WHERE amt_order IS NOT NULL AND amt_order <> 'null'"""
PIECES["order_filled"] = """
SELECT * REPLACE (
    COALESCE(TRY_CAST(amt_order AS DOUBLE), (SELECT mean FROM amount_mean)) AS amt_order,
    COALESCE(unit_price, TRY_CAST(amt_order AS DOUBLE), (SELECT mean FROM amount_mean))
      AS unit_price),
  CASE WHEN amt_order IS NULL AND type_pay IS NULL AND time_order IS NULL AND sts_order IS NULL
    THEN 1 ELSE 0 END AS blank,
  COALESCE(type_pay, 'null') AS pay, COALESCE(sts_order, 'null') AS sts
FROM order_info"""


def _spread(c):
    return (f"AVG({c}) AS {c}_mean, MAX({c}) AS {c}_max, MIN({c}) AS {c}_min, "
            f"STDDEV_POP({c}) AS {c}_std")


PIECES["order_grouped"] = f"""
SELECT id, {_spread("unit_price")}, MAX(blank) AS order_all_is_null, {_spread("amt_order")},
  {distinct_null("type_pay", "type_pay_count")}, {distinct_null("sts_order", "sts_order_count")},
  {distinct_null("phone", "order_phone_count")},
  {distinct_null("name_rec_md5", "name_rec_md5_count")},
  {hot("pay", w.PAY_TYPES, {"null": "null_x"})}, {set_size("pay", "type_pay_len")},
  {hot("sts", w.STATUSES, {"null": "null_y"})}, {set_size("sts", "sts_order_len")}
FROM order_filled GROUP BY id"""
ORDER_SCALED = (
    "unit_price_mean", "unit_price_max", "unit_price_min", "unit_price_std", "order_all_is_null",
    "amt_order_mean", "amt_order_max", "amt_order_min", "amt_order_std", "type_pay_count",
    "sts_order_count", "order_phone_count", "name_rec_md5_count")
ORDER_HOT = [{"null": "null_x"}.get(v, v) for v in w.PAY_TYPES] + ["type_pay_len"] + [
    {"null": "null_y"}.get(v, v) for v in w.STATUSES] + ["sts_order_len"]
PIECES["wide_order"] = f"""
SELECT id, {", ".join(scaled(c, c) for c in ORDER_SCALED)}, {", ".join(q(c) for c in ORDER_HOT)}
FROM order_grouped"""

PIECES["spine_auth"] = """
SELECT t.id, CAST(substr(t.appl_sbm_tm, 1, 10) AS DATE) AS appl,
  COALESCE(CASE WHEN a.auth_time <> '0000-00-00' THEN CAST(a.auth_time AS DATE) END,
    CAST(substr(t.appl_sbm_tm, 1, 10) AS DATE)) AS auth
FROM target t LEFT JOIN auth_info a ON t.id = a.id"""
PIECES["wide_time"] = f"""
SELECT id, {flag("appl < auth", "feature_1")},
  CAST(date_diff('day', auth, appl) AS INTEGER) AS register_days
FROM spine_auth"""
PIECES["spine_order_gap"] = """
SELECT t.id, CASE WHEN o.time_order IS NULL OR length(o.time_order) <> 19 THEN 0
    ELSE date_diff('day', CAST(substr(o.time_order, 1, 10) AS DATE),
      CAST(substr(t.appl_sbm_tm, 1, 10) AS DATE)) END AS days
FROM target t LEFT JOIN order_info o ON t.id = o.id"""
PIECES["wide_order_time"] = f"""
SELECT id, AVG(days) AS day_mean, CAST(MAX(days) AS BIGINT) AS day_max,
  CAST(MIN(days) AS BIGINT) AS day_min, COUNT(*) AS order_record_count,
  {flag("COUNT(*) = 1", "order_record_unique")}
FROM spine_order_gap GROUP BY id"""

USER_COLUMNS = (
    "birthday_is_zero sex_not_male female male sex_secret merriage1 merriage2 merriage3 "
    "merriage_is_null account_grade1 account_grade2 account_grade3 account_grade4 account_grade5 "
    "account_grade_is_null qq_bound_is_null wechat_bound_is_null degree id_card_is_null income1 "
    "income2 income3 income4 income5 age_one age_two age_three age_four age_five").split()
WIDE_PARTS = [
    ("wide_credit", ["credit_score", "overdraft", "quota", "quota_is_zero", "quota_surplus",
                     "quota_rate", "credit_score_rank", ("all_is_null", "all_is_null_x"),
                     "all_is_zero", "credit_score_is_null", "quota_surplus_is_null"]),
    ("wide_order", [*ORDER_SCALED, *ORDER_HOT]),
    ("wide_user", USER_COLUMNS),
    ("wide_address", ["all_null", "record_count", *w.PROVINCES, "province_len"]),
    ("wide_bankcard", ["phone_count", "card_record_count", "store_card_count", "have_credit_card",
                       "card_category_count", "credit_count", "card_count_one",
                       "record_is_unique"]),
    ("wide_auth", ["auth_id_card_is_null", "auth_time_is_null", "phone_is_null",
                   ("all_is_null", "all_is_null_y"), "all_not_null", "card_time_is_null",
                   "time_phone_is_null"]),
    ("wide_time", ["feature_1", "register_days"]),
    ("wide_order_time", ["day_mean", "day_max", "day_min", "order_record_count",
                         "order_record_unique"]),
]


def _matrix(parts, fill):
    columns, joins = [], []
    for piece, names in parts:
        for name in names:
            source, out = name if isinstance(name, tuple) else (name, name)
            value = f"{piece}.{q(source)}"
            columns.append(f"{f'COALESCE({value}, 0)' if fill else value} AS {q(out)}")
        joins.append(f"LEFT JOIN {piece} ON target.id = {piece}.id")
    return (f"SELECT target.id, target.target, target.appl_sbm_tm, {', '.join(columns)} "
            f"FROM target {' '.join(joins)}")


PIECES["wide_matrix"] = _matrix(WIDE_PARTS, fill=True)
WIDE_FEATURES = [n[1] if isinstance(n, tuple) else n for _, names in WIDE_PARTS for n in names]
SELECTABLE = [c for c in WIDE_FEATURES if c not in vocab.NOT_SELECTABLE]

# ---- compact set ------------------------------------------------------------------------------

PIECES["compact_auth"] = f"""
SELECT id, {flag("id_card IS NOT NULL", "id_card_isnull")},
  {flag("phone IS NOT NULL", "phone_isnull")}, {flag("auth_time IS NOT NULL", "auth_time_isnull")}
FROM auth_info"""
PIECES["compact_bankcard"] = f"""
SELECT id, {total("card_type = '储蓄卡'", "card_1_cnt")},
  {total("card_type = '信用卡'", "card_2_cnt")}, COUNT(bank_name) AS id_bank_cnt,
  {distinct_null("phone", "id_phone_set")}, {distinct_null("card_type", "id_card_set")},
  {distinct_null("bank_name", "id_bank_set")}
FROM bankcard_info GROUP BY id"""
PIECES["compact_credit"] = """
SELECT id, credit_score, quota, overdraft, quota - overdraft AS q_o,
  CASE WHEN quota = 0 THEN CAST(0 AS DOUBLE) ELSE overdraft / quota END AS "q/o"
FROM credit_info"""
PIECES["compact_order"] = f"""
SELECT id, {total(f"type_pay = {s(w.PAY_WAYS[0])}", "way1_cnt")},
  {total(f"type_pay = {s(w.PAY_WAYS[1])}", "way2_cnt")},
  {distinct_null("type_pay", "id_type_pay_set")}, {distinct_null("sts_order", "id_sts_order_set")},
  {distinct_null("phone", "id_phone_set")},
  {", ".join(total(f"COALESCE(sts_order, '0') LIKE '%{v}%'", k)
             for k, v in w.STATUS_WORDS.items())}
FROM (SELECT DISTINCT * FROM order_info) GROUP BY id"""
PIECES["addr_first"] = """
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY addr_id NULLS FIRST,
    region NULLS FIRST, phone NULLS FIRST, fix_phone NULLS FIRST, receiver_md5 NULLS FIRST) AS rn
  FROM addr_prepared) WHERE rn = 1"""
PIECES["addr_counts"] = f"""
SELECT id, {distinct_null("phone", "id_phone_set")}, {set_size("province", "province_len")}
FROM addr_prepared GROUP BY id"""
PIECES["compact_address"] = f"""
SELECT f.id, {flag("phone IS NOT NULL", "phone_isnull")},
  {flag("fix_phone IS NOT NULL", "fix_phone_isnull")}, id_phone_set, province_len
FROM addr_first f JOIN addr_counts c ON f.id = c.id"""
GRADE_NAMES = ("account_grade_one", "account_grade_two", "account_grade_three",
               "account_grade_four", "account_grade_five")
COMPACT_USER = [
    *[(f"degree = {s(d)}", d) for d in vocab.DEGREES],
    ("sex IS NOT NULL", "sex_isnull"), ("sex = '保密'", "sex1"), ("sex = '男'", "sex2"),
    ("sex = '女'", "sex3"), ("birthday = '0000-00-00'", "0000-00-00"),
    *[(f"merriage = {s(v)}", f"merriage{i}") for i, v in enumerate(vocab.MARRIAGE, start=1)],
    ("income IS NOT NULL", "income_isnull"),
    *[(f"income = {s(v)}", f"income{i}") for i, v in enumerate(vocab.INCOME_BANDS, start=1)],
    ("id_card IS NOT NULL", "id_card_isnull"),
    ("qq_bound = '已绑定'", "qq_bound_one"), ("qq_bound = '未绑定'", "qq_bound_two"),
    ("wechat_bound = '已绑定'", "wechat_bound_one"),
    ("wechat_bound = '未绑定'", "wechat_bound_two"),
    *[(f"account_grade = {s(v)}", n) for n, v in zip(GRADE_NAMES, w.GRADES)],
]
PIECES["compact_user"] = f"""
SELECT id, {", ".join(flag(c, n) for c, n in COMPACT_USER)} FROM user_info"""
PIECES["compact_days"] = f"""
SELECT *, {flag("days > 0", "days_is_neg")}, {flag("years > 0", "years_is_neg")} FROM (
  SELECT a.id, CAST(date_diff('day', s.auth, s.appl) AS INTEGER) AS days,
    CAST(year(s.appl) - year(s.auth) AS INTEGER) AS years
  FROM auth_info a LEFT JOIN spine_auth s ON a.id = s.id)"""
PIECES["auth_order_gap"] = """
SELECT a.id, ABS(date_diff('day', CASE WHEN a.auth_time <> '0000-00-00' THEN
      CAST(a.auth_time AS DATE) END, CASE WHEN length(o.time_order) > 16 THEN
      CAST(substr(o.time_order, 1, 10) AS DATE) END)) AS gap
FROM auth_info a LEFT JOIN order_info o ON a.id = o.id"""
PIECES["compact_auth_order"] = f"""
SELECT *, {flag("time_days_mean > 0", "time_days_mean_is_neg")} FROM (
  SELECT id, AVG(CASE WHEN gap > 0 AND gap < 50000 THEN gap ELSE -1 END) AS time_days_mean
  FROM auth_order_gap GROUP BY id)"""
COMPACT_PARTS = [
    ("compact_auth", [("id_card_isnull", "id_card_isnull_x"), ("phone_isnull", "phone_isnull_x"),
                      "auth_time_isnull"]),
    ("compact_bankcard", ["card_1_cnt", "card_2_cnt", "id_bank_cnt",
                          ("id_phone_set", "id_phone_set_x"), "id_card_set", "id_bank_set"]),
    ("compact_credit", ["credit_score", "quota", "overdraft", "q_o", "q/o"]),
    ("compact_order", ["way1_cnt", "way2_cnt", "id_type_pay_set", "id_sts_order_set",
                       ("id_phone_set", "id_phone_set_y"), *w.STATUS_WORDS]),
    ("compact_address", [("phone_isnull", "phone_isnull_y"), "fix_phone_isnull", "id_phone_set",
                         "province_len"]),
    ("compact_user", [(n, "id_card_isnull_y") if n == "id_card_isnull" else n
                      for _, n in COMPACT_USER]),
    ("compact_days", ["days", "days_is_neg", "years", "years_is_neg"]),
    ("compact_auth_order", ["time_days_mean", "time_days_mean_is_neg"]),
]
PIECES["compact_matrix"] = _matrix(COMPACT_PARTS, fill=False)

# ---- selection --------------------------------------------------------------------------------

_POSITIONS = "(VALUES " + ", ".join(
    f"({i}, {s(c)})" for i, c in enumerate(SELECTABLE)) + ") p(position, feature)"
_SHARE = "AVG(CAST(target AS DOUBLE))"


def _chi2(c):
    one = f"SUM(CASE WHEN target = 1 THEN CAST({q(c)} AS DOUBLE) ELSE 0 END)"
    zero = f"SUM(CASE WHEN target = 1 THEN 0 ELSE CAST({q(c)} AS DOUBLE) END)"
    expected = f"({_SHARE} * SUM(CAST({q(c)} AS DOUBLE)))"
    rest = f"((1 - {_SHARE}) * SUM(CAST({q(c)} AS DOUBLE)))"
    return (f"POWER({one} - {expected}, 2) / NULLIF({expected}, 0) + "
            f"POWER({zero} - {rest}, 2) / NULLIF({rest}, 0)")


def _scores(expr, digits):
    wide = ", ".join(f"ROUND({expr(c)}, {digits}) AS {q(c)}" for c in SELECTABLE)
    return (f"SELECT CAST(p.position AS INTEGER) AS position, p.feature, u.score FROM {_POSITIONS} "
            f"LEFT JOIN (UNPIVOT (SELECT {wide} FROM wide_matrix) ON COLUMNS(*) "
            f"INTO NAME feature VALUE score) u ON p.feature = u.feature")


PIECES["variance_scores"] = _scores(lambda c: f"VAR_POP(CAST({q(c)} AS DOUBLE))", 6)
PIECES["chi2_scores"] = _scores(_chi2, 6)
TOP = "ORDER BY score DESC NULLS LAST, position DESC LIMIT"
PIECES["binary_flags"] = (
    f"SELECT CAST(p.position AS INTEGER) AS position, p.feature, u.n FROM {_POSITIONS} JOIN "
    "(UNPIVOT (SELECT " + ", ".join(f"COUNT(DISTINCT {q(c)}) AS {q(c)}" for c in SELECTABLE)
    + " FROM wide_matrix) ON COLUMNS(*) INTO NAME feature VALUE n) u ON p.feature = u.feature")

_READS = re.compile(r"\b(?:FROM|JOIN)\s+(\w+)")


def _needed(sql, found):
    for name in dict.fromkeys(_READS.findall(sql)):
        if name in PIECES and name not in found:
            _needed(PIECES[name], found)
            found.setdefault(name, None)
    return found


# The base tables of the scoring set under the names of the others; its label is unknown.
SCORE_PIECES = {("target" if name == "list" else name): text.format(**{t: t for t in w._SCORE_SOURCES})
                for name, text in w.SCORE_SQL.items()}
SCORE_PIECES["target"] = f"SELECT id, CAST(NULL AS INTEGER) AS target, appl_sbm_tm FROM ({SCORE_PIECES['target']})"


def with_pieces(sql, role="train"):
    used = _needed(sql, {})
    if not used:
        return sql
    texts = PIECES if role == "train" else PIECES | SCORE_PIECES
    head = ", ".join(f"{n} AS MATERIALIZED ({texts[n]})" for n in used)
    return f"WITH {head} {sql}"


def rounded(piece, columns, digits=9):
    """Read a piece with some doubles rounded (sums of fractions depend on the order)."""
    changes = ", ".join(f"ROUND({q(c)}, {digits}) AS {q(c)}" for c in columns)
    return f"SELECT * REPLACE ({changes}) FROM {piece}"
