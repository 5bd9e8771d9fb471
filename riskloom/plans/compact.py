"""The compact feature set: 64 columns per application. Missing values stay null."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import vocab
from riskloom.functions import counts, dates, flags, numbers, text
from riskloom.operators.dedup import distinct_rows, first_per_key, require_unique_tables
from riskloom.operators.grouping import summarise, with_key
from riskloom.operators.joins import join_features


def auth_features(auth: DataFrame, extra=()) -> DataFrame:
    """Three flags, 1 when the value is present."""
    return auth.select("id", *[flags.present_flag(c).alias(f"{c}_isnull")
                               for c in ("id_card", "phone", "auth_time")], *extra)


def bankcard_features(cards: DataFrame) -> DataFrame:
    """Six counts per id; repeated card rows count."""
    return summarise(
        cards, "id",
        [counts.count_where(F.col("card_type") == vocab.DEBIT_CARD).alias("card_1_cnt"),
         counts.count_where(F.col("card_type") == vocab.CREDIT_CARD).alias("card_2_cnt"),
         F.count("bank_name").alias("id_bank_cnt")],
        distinct={"id_phone_set": F.col("phone"), "id_card_set": F.col("card_type"),
                  "id_bank_set": F.col("bank_name")},
    )


def credit_features(credit: DataFrame, order_by=None) -> DataFrame:
    """Raw credit line of the first row per id, with unused quota and drawn share."""
    first = first_per_key(credit.select("id", "credit_score", "quota", "overdraft"), "id", order_by)
    return first.select(
        "*",
        (F.col("quota") - F.col("overdraft")).alias("q_o"),
        numbers.guarded_ratio(F.col("overdraft"), F.col("quota")).alias("q/o"),
    )


def order_features(orders: DataFrame, ways=(vocab.ONLINE_PAYMENT, vocab.CASH_ON_DELIVERY),
                   status_words=None) -> DataFrame:
    """Eight counts per id over distinct order rows."""
    status_words = status_words or vocab.STATUS_WORDS
    counted = {"way1_cnt": F.col("type_pay") == ways[0], "way2_cnt": F.col("type_pay") == ways[1],
               **{n: F.col("sts_order").contains(word) for n, word in status_words.items()}}
    sets = {"id_type_pay_set": F.col("type_pay"), "id_sts_order_set": F.col("sts_order"),
            "id_phone_set": F.col("phone")}
    grouped = summarise(
        distinct_rows(with_key(orders, "id")), "id",
        [counts.count_where(condition).alias(n) for n, condition in counted.items()], sets)
    return grouped.select("id", "way1_cnt", "way2_cnt", *sets, *status_words)


def order_amount_features(orders: DataFrame) -> DataFrame:
    """Optional extras: mean, max, min and sample variance of amount and unit price."""
    amount = numbers.number_or_null("amt_order")
    priced = orders.select("id", amount.alias("amt_order"), "unit_price")
    kinds = {"mean": F.avg, "max": F.max, "min": F.min, "var": F.var_samp}
    return priced.groupBy("id").agg(*[
        fn(c).alias(f"id_{c}_{kind}") for c in ("amt_order", "unit_price")
        for kind, fn in kinds.items()])


def order_month_counts(orders: DataFrame, months=vocab.ORDER_MONTHS) -> DataFrame:
    """Optional extras: orders per id and month (``yyMM``), one column per listed month."""
    monthly = orders.select("id", text.short_month_key("time_order").alias("month"))
    return (monthly.groupBy("id").pivot("month", list(months)).count()
                   .fillna(0, subset=list(months)))


def address_features(addresses: DataFrame, order_by=None,
                     provinces=vocab.PROVINCES) -> DataFrame:
    """Phone flags of the first address, distinct phones, and number of provinces."""
    first = first_per_key(addresses, "id", order_by, keep=["phone", "fix_phone"])
    grouped = summarise(addresses, "id", [], {"id_phone_set": F.col("phone")},
                        members={"province": (text.region_prefix("region"), provinces)})
    return first.join(grouped, "id").select(
        "id", flags.present_flag("phone").alias("phone_isnull"),
        flags.present_flag("fix_phone").alias("fix_phone_isnull"), "id_phone_set", "province_len")


def user_features(users: DataFrame, grades=vocab.ACCOUNT_GRADES, order_by=None) -> DataFrame:
    """32 flags of the first profile row per id."""
    first = first_per_key(users, "id", order_by)
    grade_names = ("account_grade_one", "account_grade_two", "account_grade_three",
                   "account_grade_four", "account_grade_five")
    return first.select(
        "id",
        *flags.one_hot("degree", {d: d for d in vocab.DEGREES}),
        flags.present_flag("sex").alias("sex_isnull"),
        *flags.one_hot("sex", {"sex1": vocab.SECRET, "sex2": vocab.MALE, "sex3": vocab.FEMALE}),
        flags.equals_flag("birthday", vocab.ZERO_DATE).alias(vocab.ZERO_DATE),
        *flags.one_hot("merriage", flags.numbered("merriage", vocab.MARRIAGE)),
        flags.present_flag("income").alias("income_isnull"),
        *flags.one_hot("income", flags.numbered("income", vocab.INCOME_BANDS)),
        flags.present_flag("id_card").alias("id_card_isnull"),
        *[flags.equals_flag(f"{app}_bound", value).alias(f"{app}_bound_{n}")
          for app in ("qq", "wechat")
          for n, value in (("one", vocab.BOUND), ("two", vocab.UNBOUND))],
        *flags.one_hot("account_grade", dict(zip(grade_names, grades))),
    )


def _days_columns(has_auth) -> list:
    """From ``appl_sbm_tm`` and ``auth_day``; null where the id has no identity check."""
    appl_day = dates.day_of("appl_sbm_tm")
    auth_day = F.coalesce(F.col("auth_day"), appl_day)
    days, years = F.datediff(appl_day, auth_day), dates.year_gap(appl_day, auth_day)
    return [F.when(has_auth, value).alias(name) for name, value in (
        ("days", days), ("days_is_neg", flags.as_flag(days > 0)),
        ("years", years), ("years_is_neg", flags.as_flag(years > 0)))]


def days_features(auth: DataFrame, spine: DataFrame, order_by=None) -> DataFrame:
    """Days and calendar years from identity check to application (``*_is_neg``: 1 if positive)."""
    dated = auth.select("id", dates.auth_day("auth_time").alias("auth_day")).join(
        spine.select("id", "appl_sbm_tm"), "id", "left")
    gaps = dated.select("id", *_days_columns(F.lit(True)))
    return first_per_key(gaps, "id", order_by)


def auth_order_features(auth: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean distance in days between the identity check and the orders of an id.

    Orders are counted per id and day before the join, so a hot id brings at most one row per
    calendar day into it. A missing side counts as -1, an id without orders once.
    """
    daily = (orders.select("id", dates.long_text_day("time_order").alias("order_day"))
                   .groupBy("id", "order_day").agg(F.count(F.lit(1)).alias("orders")))
    checked = auth.select("id", dates.auth_day("auth_time").alias("auth_day"))
    joined = checked.join(daily, "id", "left").withColumn("orders", F.coalesce("orders", F.lit(1)))
    gap = dates.bounded_gap(F.col("order_day"), F.col("auth_day"))
    means = joined.groupBy("id").agg(
        (F.sum(gap * F.col("orders")) / F.sum("orders")).alias("time_days_mean"))
    return means.select("id", "time_days_mean",
                        flags.as_flag(F.col("time_days_mean") > 0).alias("time_days_mean_is_neg"))


def compact_matrix(tables: dict, spine: DataFrame, *, grades=vocab.ACCOUNT_GRADES,
                   ways=(vocab.ONLINE_PAYMENT, vocab.CASH_ON_DELIVERY), status_words=None,
                   first_row_order: dict | None = None) -> DataFrame:
    """Spine with all 64 features; ``first_row_order`` declares row order per table.

    A repeated id in a table of one row per id is an error.
    """
    require_unique_tables(tables, spine)
    order = first_row_order or {}
    checked = tables["auth_info"].withColumn("auth_day", dates.auth_day("auth_time"))
    joined = join_features(spine, [
        auth_features(checked, ["auth_day"]),
        bankcard_features(tables["bankcard_info"]),
        credit_features(tables["credit_info"], order.get("credit_info")),
        order_features(tables["order_info"], ways, status_words),
        address_features(tables["recieve_addr_info"], order.get("recieve_addr_info")),
        user_features(tables["user_info"], grades, order.get("user_info")),
        auth_order_features(tables["auth_info"], tables["order_info"]),
    ])
    late = ("time_days_mean", "time_days_mean_is_neg")
    features = [c for c in joined.columns if c not in late and c != "auth_day"]
    has_auth = F.col("auth_time_isnull").isNotNull()
    return joined.select(*[F.col(c) for c in features], *_days_columns(has_auth), *late)
