"""The applicant tables, derived from the given order-management tables.

One SQL text per logical table serves Spark and the SQL oracle. The given tables hold no nulls
where the features need them, so values (never rows) are blanked by a rule on the key: all rows of
all tables take part. Categories are the published values, dealt by arithmetic on the keys, so that all features exist and
every value occurs. Amounts are whole numbers so that sums and means are exact in any order.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import vocab
from riskloom.session import materialize


_LOOKUPS = {}


def _dealt(number, values):
    """The value in the place that a number gives, by its rest; null beyond the values."""
    case = f"CASE {number} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"
    _LOOKUPS[case] = "get(array(" + ", ".join(f"'{v}'" for v in values) + f"), CAST({number} AS INT))"
    return case


SOURCES = {
    "order_info": ("orders",),
    "bankcard_info": ("lineitem", "orders", "part"),
    "recieve_addr_info": ("lineitem", "orders", "supplier"),
    "credit_info": ("customer",),
    "user_info": ("customer",),
    "auth_info": ("orders", "lineitem"),
    "target": ("customer", "orders"),
}

# The readers take the text "null" for missing, so no category holds it; the flag "null" comes from missing values.
_PAYMENTS, _STATES = ([v for v in values if v != vocab.NULL_CATEGORY] for values in (vocab.PAYMENT_TYPES, vocab.ORDER_STATUSES))
# Whole addresses; the province is their first two characters.
_REGIONS = [f"{p}某区某路" for p in vocab.PROVINCES if p != vocab.NULL_CATEGORY]

TABLE_SQL = {
    "order_info": """
SELECT o_custkey AS id,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'null'
    ELSE CAST(CAST(ROUND(o_totalprice * 100) AS BIGINT) AS STRING) END AS amt_order,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL
    ELSE """ + _dealt(f"o_orderkey % {len(_PAYMENTS)}", _PAYMENTS) + """ END AS type_pay,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN '0000-00-00'
    ELSE CAST(o_orderdate AS STRING) END AS time_order,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL
    ELSE """ + _dealt(f"(o_orderkey + o_custkey) % {len(_STATES)}", _STATES) + """ END AS sts_order,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 5 AS STRING) END AS phone,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL
    ELSE CAST(FLOOR(o_totalprice * 100 / (1 + o_orderkey % 4)) AS DOUBLE) END AS unit_price,
  CAST(o_orderkey % 3 AS STRING) AS name_rec_md5
FROM {orders}""",
    "bankcard_info": """
SELECT o_custkey AS id, p_brand AS bank_name, CAST(l_linenumber AS STRING) AS tail_num,
  CASE l_returnflag WHEN 'A' THEN '储蓄卡' WHEN 'R' THEN '信用卡' END AS card_type,
  CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE CAST(l_suppkey % 3 AS STRING) END AS phone
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey""",
    "recieve_addr_info": """
SELECT o_custkey AS id,
  CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END AS addr_id,
  CASE WHEN l_partkey % 101 = 0 THEN NULL
    ELSE """ + _dealt(f"(l_partkey + s_nationkey) % {len(_REGIONS)}", _REGIONS) + """ END AS region,
  CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE CAST(l_suppkey % 4 AS STRING) END AS phone,
  CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST(l_linenumber AS STRING) END AS fix_phone,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS receiver_md5
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
  JOIN {supplier} ON l_suppkey = s_suppkey""",
    "credit_info": """
SELECT c_custkey AS id,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(FLOOR(c_acctbal / 100) AS DOUBLE) END
    AS credit_score,
  CASE WHEN c_custkey % 14 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN CAST(0 AS DOUBLE)
    ELSE CAST(FLOOR(ABS(c_acctbal) / 2) AS DOUBLE) END AS overdraft,
  CASE WHEN c_custkey % 15 = 0 THEN NULL WHEN c_custkey % 6 = 0 THEN CAST(0 AS DOUBLE)
    ELSE CAST(FLOOR(ABS(c_acctbal)) AS DOUBLE) END AS quota
FROM {customer}""",
    "user_info": """
SELECT c_custkey AS id,
  CASE c_custkey % 4 WHEN 0 THEN '男' WHEN 1 THEN '女' WHEN 2 THEN '保密' END AS sex,
  CASE c_custkey % 10 WHEN 0 THEN '0000-00-00' WHEN 1 THEN NULL WHEN 2 THEN '1990-5'
    ELSE CAST(1915 + c_custkey % 95 AS STRING) || '-03-15' END AS birthday,
  CASE c_custkey % 5 WHEN 0 THEN '未婚' WHEN 1 THEN '已婚' WHEN 2 THEN '保密' END AS merriage,
  """ + _dealt(f"c_custkey % {len(vocab.ACCOUNT_GRADES) + 2}", vocab.ACCOUNT_GRADES) + """ AS account_grade,
  CASE c_custkey % 3 WHEN 0 THEN '已绑定' WHEN 1 THEN '未绑定' END AS qq_bound,
  CASE c_custkey % 7 WHEN 0 THEN '已绑定' WHEN 1 THEN '未绑定' END AS wechat_bound,
  CASE c_custkey % 6 WHEN 0 THEN '硕士' WHEN 1 THEN '本科' WHEN 2 THEN '其他' WHEN 3 THEN '博士' END
    AS degree,
  CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE CAST(1 + c_custkey % 6 AS STRING) END AS id_card,
  CASE c_custkey % 11 WHEN 0 THEN '4000-5999元' WHEN 1 THEN '8000元以上' WHEN 2 THEN '2000-3999元'
    WHEN 3 THEN '6000-7999元' WHEN 4 THEN '2000元以下' END AS income
FROM {customer}""",
    "auth_info": """
SELECT o_custkey AS id,
  CASE WHEN o_custkey % 8 = 0 THEN NULL ELSE CAST(1 + o_custkey % 6 AS STRING) END AS id_card,
  CASE WHEN o_custkey % 12 = 0 THEN NULL WHEN o_custkey % 13 = 0 THEN '0000-00-00'
    WHEN o_custkey % 6 = 1 THEN CAST(CAST(MAX(l_shipdate) AS DATE) AS STRING)
    ELSE CAST(CAST(MIN(l_shipdate) AS DATE) AS STRING) END AS auth_time,
  CASE WHEN o_custkey % 16 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS phone
FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey GROUP BY o_custkey""",
    "target": """
SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS target,
  COALESCE(CAST(MAX(o_orderdate) AS STRING), '2001-01-01 00:00:00') AS appl_sbm_tm
FROM {customer} LEFT JOIN {orders} ON o_custkey = c_custkey GROUP BY c_custkey, c_acctbal""",
}

def _for_suppliers(sql):
    """The SQL of a table with suppliers as applicants: their keys, balances and order lines in place of the customers'."""
    for old, new in (("{customer}", "{supplier}"), ("c_custkey", "s_suppkey"), ("c_acctbal", "s_acctbal"), ("o_custkey", "l_suppkey")):
        sql = sql.replace(old, new)
    return sql


# The scoring set: other applicants, without labels.
SCORE_SQL = {name: _for_suppliers(sql) for name, sql in TABLE_SQL.items() if name != "target"}
SCORE_SQL["order_info"] = SCORE_SQL["order_info"].replace("FROM {orders}", "FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey")
SCORE_SQL["list"] = """
SELECT s_suppkey AS id, COALESCE(CAST(MAX(o_orderdate) AS STRING), '2001-01-01 00:00:00') AS appl_sbm_tm
FROM {supplier} LEFT JOIN {lineitem} ON l_suppkey = s_suppkey LEFT JOIN {orders} ON o_orderkey = l_orderkey
GROUP BY s_suppkey"""
_SCORE_SOURCES = ("orders", "lineitem", "part", "supplier")

# The vocabularies of the checks.
PAY_TYPES, STATUSES, PROVINCES, GRADES = vocab.PAYMENT_TYPES, vocab.ORDER_STATUSES, vocab.PROVINCES, vocab.ACCOUNT_GRADES
PAY_WAYS = (vocab.ONLINE_PAYMENT, vocab.CASH_ON_DELIVERY)
STATUS_WORDS = vocab.STATUS_WORDS
TRAIN_MONTHS = ("199901", "200106")
VALIDATION_MONTH = "200107"


def _for_spark(sql):
    """The SQL of a table with long choices by a number as places of an array: Spark would work out the number anew for every value tried."""
    for case, lookup in _LOOKUPS.items():
        for named in (str, _for_suppliers):
            sql = sql.replace(named(case), named(lookup))
    return sql


def given(spark: SparkSession, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir, name) -> DataFrame:
    """One logical table as a DataFrame."""
    return spark.sql(_for_spark(TABLE_SQL[name]), **{s: given(spark, sf_dir, s) for s in SOURCES[name]})


# What the tables of both roles take from an order line and its order, and the joins that it stands for.
_LINES = ("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_shipdate"
          " FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey")
_LINE_JOINS = ("{lineitem} JOIN {orders} ON l_orderkey = o_orderkey", "{orders} JOIN {lineitem} ON l_orderkey = o_orderkey")
# Without a line of an order a supplier has no order either; the latest date per supplier is all that the list takes.
_LIST_JOIN = ("{lineitem} ON l_suppkey = s_suppkey LEFT JOIN {orders} ON o_orderkey = l_orderkey",
              "(SELECT l_suppkey, MAX(o_orderdate) AS o_orderdate FROM {lines} GROUP BY l_suppkey) ON l_suppkey = s_suppkey")
# Results of a whole join or grouping with one row per applicant: used for the check of unique ids and again for the features.
_STORED = ("auth_info", "target", "list")


# Lines with what cards and addresses take from a further table.
_LINES_WITH = {
    "cards": ("{lines} JOIN {part} ON l_partkey = p_partkey", "o_custkey, l_suppkey, l_linenumber, l_returnflag, p_brand"),
    "addresses": ("{lines} JOIN {supplier} ON l_suppkey = s_suppkey", "o_custkey, l_suppkey, l_orderkey, l_partkey, l_linenumber, s_nationkey"),
}


def _from_lines(sql, joined=()):
    for join in _LINE_JOINS:
        sql = sql.replace(join, "{lines}")
    sql = sql.replace(*_LIST_JOIN).replace("{lines}\n  JOIN", "{lines} JOIN")
    for name, (join, _columns) in _LINES_WITH.items():
        if name in joined:
            sql = sql.replace(join, "{" + name + "}")
    return sql


def _stored_lines(spark, frames):
    lines = spark.sql(_LINES, lineitem=frames["lineitem"], orders=frames["orders"])
    return materialize(lines, "lines", compression="zstd").withColumn("l_orderkey", F.col("o_orderkey"))


def joined_lines(spark: SparkSession, sf_dir) -> dict:
    """Order lines with their orders, and these with part and supplier, stored once for the tables of both roles and all that is made of them."""
    frames = {s: given(spark, sf_dir, s) for s in _SCORE_SOURCES}
    frames["lines"] = _stored_lines(spark, frames)

    def stored(name):
        join, columns = _LINES_WITH[name]
        used = {s: frame for s, frame in frames.items() if "{" + s + "}" in join}
        return materialize(spark.sql(f"SELECT {columns} FROM {join}", **used), name, compression="zstd")

    return {"lines": frames["lines"], **{name: stored(name) for name in _LINES_WITH}}


def tables(spark: SparkSession, sf_dir, role="train", stored=True, joined=None) -> dict:
    """All tables of the labelled applicants, or of those to be scored.

    Order lines meet their orders once, and the joined lines are ``stored`` for all tables made of them; so are tables that are
    the result of a grouping. For few columns of few tables it is cheaper not to store them. Who needs the tables of both roles, or makes two
    matrices of them, passes as ``joined`` a function that gives the same ``joined_lines`` every time.
    """
    texts = TABLE_SQL if role == "train" else SCORE_SQL
    needed = {s for names in SOURCES.values() for s in names} if role == "train" else set(_SCORE_SOURCES)
    frames = {s: given(spark, sf_dir, s) for s in needed}

    def made(text):
        return spark.sql(_for_spark(text), **{s: frame for s, frame in frames.items() if "{" + s + "}" in text})

    if not stored:
        return {name: made(text) for name, text in texts.items()}
    lines = joined() if joined else {"lines": _stored_lines(spark, frames)}
    frames |= lines
    built = {name: made(_from_lines(text, lines)) for name, text in texts.items()}
    return {name: materialize(df, name) if name in _STORED else df for name, df in built.items()}
