"""Column types of the logical input tables (only the columns the features read)."""

from pyspark.sql import types as T


def _table(text="", numbers=(), ints=()):
    fields = [T.StructField("id", T.StringType())]
    fields += [T.StructField(c, T.StringType()) for c in text.split()]
    fields += [T.StructField(c, T.DoubleType()) for c in numbers]
    fields += [T.StructField(c, T.IntegerType()) for c in ints]
    return T.StructType(fields)


SCHEMAS = {
    "auth_info": _table("id_card auth_time phone"),
    "bankcard_info": _table("bank_name tail_num card_type phone"),
    "credit_info": _table(numbers=("credit_score", "overdraft", "quota")),
    "order_info": _table(
        "amt_order type_pay time_order sts_order phone no_order_md5 name_rec_md5 product_id_md5",
        numbers=("unit_price",),
    ),
    "recieve_addr_info": _table("addr_id region phone fix_phone receiver_md5"),
    "user_info": _table(
        "sex birthday merriage account_grade qq_bound wechat_bound degree id_card income"
    ),
    "target": _table("appl_sbm_tm", ints=("target",)),
    "list": _table("appl_sbm_tm"),
}

FEATURE_TABLES = ("auth_info", "bankcard_info", "credit_info", "order_info",
                  "recieve_addr_info", "user_info")
SPINES = {"train": "target", "score": "list"}

# One row per id; a repeated key would multiply rows in the joins.
ONE_ROW_PER_ID = ("auth_info", "credit_info", "user_info", "target", "list")
