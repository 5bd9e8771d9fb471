"""Category vocabularies, null tokens and published feature lists.

These are data, not logic. The values and their spelling decide column names and
flag results, so they must stay exactly as they are (one payment type even ends
in a blank). The order is the order of the output columns.
"""

NULL_CATEGORY = "null"
ZERO_DATE = "0000-00-00"

# Text that a CSV reader with default settings takes for "missing".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

PROVINCES = (
    "甘肃", "云南", "贵州", "河南", "黑龙", "香港", "北京", "湖南", "江苏", "青海", "宁夏", "内蒙",
    "浙江", "吉林", "海南", "福建", "重庆", "台湾", "陕西", "湖北", "江西", "辽宁", "山西", "西藏",
    "广东", "安徽", "四川", "河北", "山东", "上海", "广西", "新疆", "天津", "null",
)

PAYMENT_TYPES = (
    "定向京券支付", "白条支付", "在线+余额+限品东券", "高校代理-代理支付", "京券全额支付", "分期付款",
    "积分支付", "在线+限品东券", "定向东券", "东券混合支付", "余额", "京豆东券混合支付", "前台自付",
    "在线", "在线+东券支付", "上门自提", "公司转账", "在线支付", "在线支付 ", "在线+京豆", "邮局汇款",
    "在线+全品京券", "货到付款", "分期付款(招行)", "在线+全品东券", "余额+限品东券", "在线+京券支付",
    "在线+余额", "限品京券", "null", "京豆支付", "在线预付", "定向京券", "混合支付", "全品京券",
    "京豆", "在线+定向东券", "京豆混合支付", "在线+限品京券", "高校代理-自己支付", "京券混合支付",
    "在线+东券",
)

ORDER_STATUSES = (
    "null", "等待审核", "等待处理", "已退款", "已收货", "购买成功", "付款成功", "失败退款", "已完成",
    "预订结束", "退款完成", "正在出库", "订单已取消", "充值成功", "商品出库", "下单失败", "请上门自提",
    "已晒单", "充值失败;退款成功", "退款成功", "未入住", "等待收货", "配送退货", "出票失败",
    "等待付款确认", "缴费成功", "预约完成", "未抢中", "完成", "已取消", "出票成功", "抢票已取消",
    "等待付款", "已取消订单", "正在处理", "等待退款", "充值失败", "订单取消",
)

FEMALE, MALE, SECRET = "女", "男", "保密"
MARRIAGE = ("未婚", "已婚", "保密")
ACCOUNT_GRADES = ("注册会员", "铜牌会员", "银牌会员", "金牌会员", "钻石会员")
INCOME_BANDS = ("4000-5999元", "8000元以上", "2000-3999元", "6000-7999元", "2000元以下")
DEGREES = ("本科", "初中", "中专", "其他", "硕士", "大专", "博士", "高中")
MARKED_DEGREES = ("硕士", "其他", "博士")
BOUND, UNBOUND = "已绑定", "未绑定"
DEBIT_CARD, CREDIT_CARD = "储蓄卡", "信用卡"
ONLINE_PAYMENT, CASH_ON_DELIVERY = "在线支付", "货到付款"
STATUS_WORDS = {"wan_cheng_cnt": "完成", "cheng_gong_cnt": "成功", "qu_xiao_cnt": "取消"}

CARRIER_PREFIXES = {
    "mobile": ("134", "135", "136", "137", "138", "139", "150", "151", "152", "157", "158", "159",
               "182", "183", "184", "187", "188", "147", "178"),
    "unicom": ("130", "131", "132", "155", "156", "185", "186", "145", "176"),
    "telecom": ("180", "181", "189", "133", "153", "177"),
    "virtual": ("170",),
}
ID_CARD_DIGITS = {"id_card_one": "1", "id_card_two": "2", "id_card_three": "3",
                  "id_card_four": "4", "id_card_five": "5", "id_card_six": "6"}

# yyMM values of the monthly order-count pivot; the last one stands for "no order time".
ORDER_MONTHS = (
    "1604", "1704", "1504", "1607", "1508", "1505", "1608", "1602", "1701", "1512", "1612", "1506",
    "1610", "1412", "1603", "00000000", "1601", "1611", "1605", "1606",
)

# Columns left out before statistical feature selection.
NOT_SELECTABLE = ("feature_1", "register_days", *ID_CARD_DIGITS, *CARRIER_PREFIXES)

# Months (yyyyMM) of the published split.
TRAIN_MONTHS = ("201603", "201703")
VALIDATION_MONTH = "201704"

# Published feature lists: 73 names for the tree model, 96 for the linear one.
TREE_FEATURES = (
    "order_all_is_null", "feature_1", "register_days", "quota", "quota_surplus", "all_is_null_y",
    "account_grade_is_null", "all_is_zero", "account_grade2", "age_three", "type_pay_len", "null_y",
    "等待付款", "income1", "auth_time_is_null", "record_count", "qq_bound_is_null",
    "card_record_count", "quota_is_zero", "新疆", "云南", "account_grade3", "广东",
    "card_time_is_null", "have_credit_card", "充值成功", "已取消", "credit_count", "在线", "四川",
    "wechat_bound_is_null", "null", "credit_score_rank", "未抢中", "null_x", "完成", "天津",
    "age_two", "female", "订单取消", "quota_rate", "山东", "重庆", "sts_order_len", "merriage1",
    "福建", "account_grade1", "phone_count", "record_is_unique", "上海", "income3", "湖北",
    "phone_is_null", "time_phone_is_null", "province_len", "birthday_is_zero", "混合支付",
    "auth_id_card_is_null", "credit_score", "江西", "货到付款", "吉林", "credit_score_is_null",
    "江苏", "all_not_null", "sex_secret", "已完成", "card_category_count", "card_count_one",
    "等待收货", "湖南", "male", "store_card_count",
)

LINEAR_FEATURES = (
    "order_all_is_null", "feature_1", "record_is_unique", "浙江", "辽宁", "card_time_is_null",
    "income1", "account_grade2", "黑龙", "江苏", "未抢中", "山东", "内蒙", "上海", "分期付款",
    "货到付款", "overdraft", "公司转账", "null", "订单取消", "age_two", "充值成功", "在线", "新疆",
    "完成", "quota_rate", "sex_not_male", "湖北", "quota", "account_grade_is_null", "安徽",
    "card_category_count", "all_not_null", "phone_is_null", "河北", "merriage_is_null", "混合支付",
    "quota_surplus_is_null", "birthday_is_zero", "income3", "江西", "store_card_count",
    "time_phone_is_null", "id_card_is_null", "auth_id_card_is_null", "已取消", "广东",
    "record_count", "云南", "等待付款", "已完成", "card_count_one", "type_pay_len", "female",
    "sts_order_len", "福建", "auth_time_is_null", "在线支付", "null_x", "income2", "quota_is_zero",
    "credit_score_is_null", "account_grade3", "四川", "等待审核", "重庆", "河南", "all_is_null_y",
    "吉林", "抢票已取消", "province_len", "credit_count", "account_grade1", "credit_score_rank",
    "sts_order_count", "湖南", "充值失败;退款成功", "wechat_bound_is_null", "card_record_count",
    "male", "邮局汇款", "merriage1", "山西", "phone_count", "sex_secret", "海南", "merriage2",
    "等待收货", "all_is_zero", "天津", "credit_score", "age_three", "null_y", "qq_bound_is_null",
    "have_credit_card", "北京",
)
