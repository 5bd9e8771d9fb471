"""The wide feature set: 194 columns per application from six applicant tables.

Names that say ``*_is_null`` while the value means "present", and ``female``/``male`` swapped, are
part of the published feature set and kept.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import vocab
from riskloom.functions import counts, dates, flags, numbers, text
from riskloom.operators.clean import table_mean, zero_fill
from riskloom.operators.dedup import distinct_rows, first_per_key, require_unique_tables
from riskloom.operators.grouping import summarise, with_key
from riskloom.operators.joins import collision_names, join_features
from riskloom.operators.ordering import global_row_number
from riskloom.operators.scaling import column_ranges, scale_columns
from riskloom.session import materialize

CREDIT_SCALED = ("credit_score", "overdraft", "quota", "quota_surplus", "credit_score_rank")
ORDER_SCALED = (
    "unit_price_mean", "unit_price_max", "unit_price_min", "unit_price_std", "order_all_is_null",
    "amt_order_mean", "amt_order_max", "amt_order_min", "amt_order_std",
    "type_pay_count", "sts_order_count", "order_phone_count", "name_rec_md5_count",
)
_ORDER_DAYS = ("order_rows", "dated_rows", "day_sum", "first_day", "last_day")


def credit_filled(credit: DataFrame) -> DataFrame:
    """Missing score takes the table mean, missing overdraft and quota 0; then the difference."""
    score = F.coalesce(F.col("credit_score"), table_mean(credit, F.col("credit_score")))
    overdraft, quota = numbers.filled("overdraft", 0.0), numbers.filled("quota", 0.0)
    return credit.select("id", score.alias("credit_score"), overdraft.alias("overdraft"),
                         quota.alias("quota"), (quota - overdraft).alias("quota_surplus"))


def credit_ranked(credit: DataFrame) -> DataFrame:
    """Filled credit lines with ``credit_score_rank``: 1 for the best score, ties by id."""
    return global_row_number(credit_filled(credit), F.col("credit_score").desc(), F.col("id"),
                             name="credit_score_rank")


def credit_features(credit: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Eleven columns per id. The five numeric ones are scaled over the whole table."""
    ranked = credit_ranked(credit)
    zero = {c: F.col(c) == 0 for c in ("credit_score", "overdraft", "quota", "quota_surplus")}
    flagged = ranked.select(
        "id", "credit_score", "overdraft", "quota",
        flags.as_flag(zero["quota"]).alias("quota_is_zero"),
        "quota_surplus",
        numbers.guarded_ratio(F.col("overdraft"), F.col("quota")).alias("quota_rate"),
        "credit_score_rank",
        F.lit(1).alias("all_is_null"),  # always 1 in the published set
        flags.as_flag(zero["credit_score"] & zero["overdraft"] & zero["quota"]).alias("all_is_zero"),
        flags.as_flag(zero["credit_score"]).alias("credit_score_is_null"),
        flags.as_flag(zero["quota_surplus"] & ~zero["quota"]).alias("quota_surplus_is_null"),
    )
    return scale_columns(flagged, CREDIT_SCALED, ranges)


def user_features(users: DataFrame, grades=vocab.ACCOUNT_GRADES, year=2018) -> DataFrame:
    """29 columns per profile row; one projection, no shuffle."""
    aged = users.withColumn("age", dates.age_in(year))
    return aged.select(
        "id",
        flags.equals_flag("birthday", vocab.ZERO_DATE).alias("birthday_is_zero"),
        flags.differs_flag("sex", vocab.FEMALE).alias("sex_not_male"),
        *flags.one_hot("sex", {"female": vocab.MALE, "male": vocab.FEMALE,
                               "sex_secret": vocab.SECRET}),
        *flags.one_hot("merriage", flags.numbered("merriage", vocab.MARRIAGE)),
        flags.null_flag("merriage").alias("merriage_is_null"),
        *flags.one_hot("account_grade", flags.numbered("account_grade", grades)),
        flags.null_flag("account_grade").alias("account_grade_is_null"),
        flags.null_flag("qq_bound").alias("qq_bound_is_null"),
        flags.null_flag("wechat_bound").alias("wechat_bound_is_null"),
        flags.in_flag("degree", vocab.MARKED_DEGREES).alias("degree"),
        flags.null_flag("id_card").alias("id_card_is_null"),
        *flags.one_hot("income", flags.numbered("income", vocab.INCOME_BANDS)),
        *dates.age_flags("age"),
    )


def address_profile(addresses: DataFrame, provinces=vocab.PROVINCES) -> DataFrame:
    """Delivery addresses per id, the provinces as a bit mask."""
    prepared = addresses.select("id", flags.blank_address_flag().alias("all_null"),
                                text.region_prefix("region").alias("province"))
    return summarise(
        prepared, "id",
        [F.min("all_null").alias("all_null"), F.count(F.lit(1)).alias("record_count")],
        members={"province": (F.col("province"), provinces)},
    ).drop("province_count")


def address_features(addresses: DataFrame, provinces=vocab.PROVINCES) -> DataFrame:
    """37 columns per id from the delivery addresses."""
    return address_profile(addresses, provinces).select(
        "id", "all_null", "record_count",
        *counts.membership_flags(provinces, "province_mask"), "province_len")


def bankcard_features(cards: DataFrame, order_by=None) -> DataFrame:
    """Eight columns per id, after dropping repeated card rows.

    ``have_credit_card`` looks at the first card of an id only, in the declared order
    (all columns by default). ``card_record_count`` counts cards with a phone number, so
    ``credit_count`` can be negative.
    """
    unique = distinct_rows(with_key(cards, "id"))
    first = first_per_key(unique, "id", order_by, keep=["card_type"])
    grouped = summarise(
        unique, "id",
        [F.count("phone").alias("card_record_count"),
         counts.count_where(F.col("card_type") == vocab.DEBIT_CARD).alias("store_card_count")],
        distinct={"phone_count": F.col("phone"), "card_category_count": F.col("card_type")},
    )
    return grouped.join(first, "id", "left").select(
        "id", "phone_count", "card_record_count", "store_card_count",
        flags.equals_flag("card_type", vocab.CREDIT_CARD).alias("have_credit_card"),
        "card_category_count",
        (F.col("card_record_count") - F.col("store_card_count")).alias("credit_count"),
        flags.as_flag(F.col("card_record_count") > 6).alias("card_count_one"),
        flags.as_flag(F.col("card_record_count") == 1).alias("record_is_unique"),
    )


def auth_features(auth: DataFrame, extra=()) -> DataFrame:
    """Seven flags per identity check; the first three are 1 when the value is present."""
    return auth.select(
        "id",
        flags.present_flag("id_card").alias("auth_id_card_is_null"),
        flags.present_flag("auth_time").alias("auth_time_is_null"),
        flags.present_flag("phone").alias("phone_is_null"),
        flags.null_flag("id_card", "auth_time", "phone").alias("all_is_null"),
        flags.present_flag("id_card", "auth_time", "phone").alias("all_not_null"),
        flags.null_flag("id_card", "auth_time").alias("card_time_is_null"),
        flags.null_flag("phone", "auth_time").alias("time_phone_is_null"),
        *extra,
    )


def auth_contact_flags(auth: DataFrame) -> DataFrame:
    """Optional extras: mobile carrier and first id-card digit (named in older feature lists)."""
    digit = auth.withColumn("digit", text.first_character("id_card"))
    return digit.select("id", *text.carrier_flags("phone"),
                        *flags.one_hot("digit", vocab.ID_CARD_DIGITS))


def order_profile(orders: DataFrame, pay_types=vocab.PAYMENT_TYPES,
                  statuses=vocab.ORDER_STATUSES) -> DataFrame:
    """Everything the features need from the order history, one row per id.

    Holds the raw aggregates, the category sets as bit masks, and the order dates as
    count, sum, first and last day. The day gaps follow from these
    without joining the spine to single orders, where a hot id would not split.
    """
    amount = numbers.number_or_null("amt_order")
    prepared = orders.select(
        "id",
        F.coalesce(amount, table_mean(orders, amount)).alias("amt_order"),
        "unit_price", "type_pay", "sts_order", "phone", "name_rec_md5",
        flags.null_flag("amt_order", "type_pay", "time_order", "sts_order").alias("blank"),
        F.unix_date(dates.full_timestamp_day("time_order")).cast("bigint").alias("order_day"),
    ).withColumn("unit_price", F.coalesce("unit_price", "amt_order"))

    def spread(c):
        return [F.avg(c).alias(f"{c}_mean"), F.max(c).alias(f"{c}_max"),
                F.min(c).alias(f"{c}_min"), F.stddev_pop(c).alias(f"{c}_std")]

    return summarise(prepared, "id", [
        *spread("unit_price"),
        F.max("blank").alias("order_all_is_null"),
        *spread("amt_order"),
        F.count(F.lit(1)).alias("order_rows"),
        F.count("order_day").alias("dated_rows"),
        F.sum("order_day").alias("day_sum"),
        F.min("order_day").alias("first_day"),
        F.max("order_day").alias("last_day"),
    ], distinct={
        "order_phone_count": F.col("phone"), "name_rec_md5_count": F.col("name_rec_md5"),
    }, members={
        "type_pay": (text.null_as_category("type_pay"), pay_types),
        "sts_order": (text.null_as_category("sts_order"), statuses),
    })


def order_features_from(profile: DataFrame, pay_types=vocab.PAYMENT_TYPES,
                        statuses=vocab.ORDER_STATUSES, ranges: DataFrame | None = None) -> DataFrame:
    """Scale the 13 aggregates of a profile and spread the category sets into flags."""
    pay_names, status_names = collision_names([pay_types, statuses])
    return scale_columns(profile, ORDER_SCALED, ranges).select(
        "id", *ORDER_SCALED,
        *counts.membership_flags(pay_types, "type_pay_mask", pay_names), "type_pay_len",
        *counts.membership_flags(statuses, "sts_order_mask", status_names), "sts_order_len",
    )


def order_features(orders: DataFrame, pay_types=vocab.PAYMENT_TYPES, statuses=vocab.ORDER_STATUSES,
                   ranges: DataFrame | None = None) -> DataFrame:
    """95 columns per id from the order history.

    The profile (one row per id) is stored first, because the scaling needs it twice. The order table
    itself is read for the mean amount, the plain aggregates and the distinct counts.
    """
    profile = materialize(order_profile(orders, pay_types, statuses), "order-profile")
    return order_features_from(profile, pay_types, statuses, ranges)


def _application_gap_columns() -> list:
    """From ``appl_sbm_tm`` and ``auth_day``."""
    appl_day = dates.day_of("appl_sbm_tm")
    auth_day = F.coalesce(F.col("auth_day"), appl_day)
    return [flags.as_flag(appl_day < auth_day).alias("feature_1"),
            F.datediff(appl_day, auth_day).alias("register_days")]


def application_gap_features(auth: DataFrame, spine: DataFrame) -> DataFrame:
    """Whether an application came before the identity check, and the days between."""
    checked = auth.select("id", dates.auth_day("auth_time").alias("auth_day"))
    return spine.select("id", "appl_sbm_tm").join(checked, "id", "left").select(
        "id", *_application_gap_columns())


def order_days(orders: DataFrame) -> DataFrame:
    """The date part of :func:`order_profile` alone."""
    day = F.unix_date(dates.full_timestamp_day("time_order")).cast("bigint")
    return orders.select("id", day.alias("order_day")).groupBy("id").agg(
        F.count(F.lit(1)).alias("order_rows"), F.count("order_day").alias("dated_rows"),
        F.sum("order_day").alias("day_sum"), F.min("order_day").alias("first_day"),
        F.max("order_day").alias("last_day"))


def _order_gap_columns() -> list:
    """From ``appl_sbm_tm`` and the order dates of a profile.

    An order without a full timestamp counts with gap 0, and an id without
    orders has one such record.
    """
    appl = F.unix_date(dates.day_of("appl_sbm_tm")).cast("bigint")
    rows = F.coalesce("order_rows", F.lit(1))
    dated = F.coalesce("dated_rows", F.lit(0))
    undated = rows > dated
    longest = appl - F.col("first_day")
    shortest = appl - F.col("last_day")
    zero = F.lit(0).cast("bigint")
    gap_sum = F.coalesce(dated * appl - F.col("day_sum"), zero)
    return [
        (gap_sum / rows).alias("day_mean"),
        F.when(undated, F.greatest(longest, zero)).otherwise(longest).alias("day_max"),
        F.when(undated, F.least(shortest, zero)).otherwise(shortest).alias("day_min"),
        rows.alias("order_record_count"),
        flags.as_flag(rows == 1).alias("order_record_unique"),
    ]


def order_gap_features(orders: DataFrame, spine: DataFrame) -> DataFrame:
    """Mean, longest and shortest gap between the orders and the application of an id."""
    return spine.select("id", "appl_sbm_tm").join(order_days(orders), "id", "left").select(
        "id", *_order_gap_columns())


def fitted_ranges(tables: dict, pay_types=vocab.PAYMENT_TYPES,
                  statuses=vocab.ORDER_STATUSES) -> dict:
    """Value ranges of one set of tables, to scale another set alike.

    By default every table is scaled by its own range, as in the published features.
    """
    ranked = credit_ranked(tables["credit_info"])
    profile = materialize(order_profile(tables["order_info"], pay_types, statuses), "order-profile")
    return {"credit": materialize(column_ranges(ranked, CREDIT_SCALED), "ranges"),
            "order": materialize(column_ranges(profile, ORDER_SCALED), "ranges")}


def wide_matrix(tables: dict, spine: DataFrame, *, pay_types=vocab.PAYMENT_TYPES,
                statuses=vocab.ORDER_STATUSES, provinces=vocab.PROVINCES,
                grades=vocab.ACCOUNT_GRADES, year=2018, card_order=None,
                ranges: dict | None = None) -> DataFrame:
    """Spine (``id``, ``appl_sbm_tm``, any label) with all 194 features, nulls as 0.

    Join the spine once and split the result by month; a split per training set would repeat
    all joins. The date gaps and the category flags are computed on the joined row: neither the spine
    nor a table that serves two feature groups is joined a second time, and the shuffles carry three
    bit masks instead of 114 flags. A repeated id in a table of one row per id is an error.
    """
    require_unique_tables(tables, spine)
    ranges = ranges or {}
    profile = materialize(order_profile(tables["order_info"], pay_types, statuses), "order-profile")
    auth = tables["auth_info"]
    sets = {"type_pay": pay_types, "sts_order": statuses, "province": provinces}
    masks = {k: counts.mask_columns(values, f"{k}_mask") for k, values in sets.items()}
    order_part = scale_columns(profile, ORDER_SCALED, ranges.get("order")).select(
        "id", *ORDER_SCALED, "type_pay_len", "sts_order_len", *masks["type_pay"],
        *masks["sts_order"], *_ORDER_DAYS)
    joined = join_features(spine, [
        credit_features(tables["credit_info"], ranges.get("credit")),
        order_part,
        user_features(tables["user_info"], grades, year),
        address_profile(tables["recieve_addr_info"], provinces),
        bankcard_features(tables["bankcard_info"], card_order),
        auth_features(auth.withColumn("auth_day", dates.auth_day("auth_time")), ["auth_day"]),
    ])
    flags_before = {
        f"{k}_len": counts.membership_flags(values, f"{k}_mask", names)
        for (k, values), names in zip(sets.items(), collision_names(list(sets.values())))}
    helpers = {"auth_day", *_ORDER_DAYS, *(m for columns in masks.values() for m in columns)}
    features = []
    for c in joined.columns:
        if c not in helpers:
            features += [*flags_before.get(c, ()), F.col(c)]
    return zero_fill(joined.select(*features, *_application_gap_columns(), *_order_gap_columns()))
