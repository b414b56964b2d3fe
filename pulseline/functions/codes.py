"""Fixed values shared with the upstream data producers and the downstream readers.

They have to stay exactly as they are for results to be right.
"""

# Order status codes.
CREATED = "1001"
PAID = "1002"
CANCELLED = "1003"
COMPLETED = "1004"
REFUND_REQUESTED = "1005"
REFUNDED = "1006"
SALES_STATUSES = (CREATED, PAID, COMPLETED)

# Machine statuses.
WARNING = "预警"
RUNNING = "运行"

# Produce flag of a product that passed its check.
PASSED = "1"

# Temperature limit (degrees) and hold times of the two alerts.
TEMPERATURE_LIMIT = 38.0
WARNING_HOLD = "30 seconds"
TEMPERATURE_HOLD = "3 minutes"

# Keys of the latest-value table.
KEY_SALES_TOTAL = "totalprice"
KEY_REFUND_TOTAL = "totalrefundordercount"
KEY_ORDER_COUNT = "totalcount"
KEY_REFUND_REQUESTS = "refundcountminute"
KEY_CANCEL_RATE = "cancelrate"
KEY_TOP_USERS = "top2userconsumption"
KEY_TOP_SKU_QUANTITY = "top3itemamount"
KEY_TOP_SKU_AMOUNT = "top3itemconsumption"
HASH_PRODUCED = "totalproduce"
HASH_TOP_WARNING = "warning_last3min_everymin_out"
HASH_WARNING_HELD = "warning30sMachine"

# Row-store and JDBC table names.
TABLE_ORDER_INFO = "order_info"
TABLE_ORDER_JOIN = "orderpositiveaggr"
TABLE_TEMPERATURE = "EnvTemperatureMonitor"
TABLE_PRODUCED = "Produce5minAgg"
TABLE_WARNING_COUNT = "threemin_warning_state_agg"
TABLE_TRANSITIONS = "change_state_other_to_run_agg"

# Text formats.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_FORMAT_MILLIS = "yyyy-MM-dd HH:mm:ss.SSS"
MONEY = "decimal(18,2)"

# Line layouts: field name, position after splitting on commas, type. LAST is the last non-empty field.
LAST = -1
ORDER_LINE = (
    ("id", 0, "long"),
    ("consignee", 1, "text"),
    ("consignee_tel", 2, "text"),
    ("amount", 3, "money"),
    ("status", 4, "text"),
    ("user_id", 5, "text"),
    ("create_time", 10, "time"),
    ("operation_time", 11, "time"),
    ("freight", LAST, "text"),
)
DETAIL_LINE = (
    ("detail_id", 0, "text"),
    ("order_id", 1, "long"),
    ("sku_id", 2, "text"),
    ("price", 4, "money"),
    ("num", 5, "int"),
    ("create_time", 6, "time"),
)
PRODUCE_LINE = (
    ("machine_id", 1, "text"),
    ("passed", LAST, "text"),
)
CHANGE_LINE = (
    ("machine_id", 1, "text"),
    ("status", 3, "text"),
    ("start_time", 4, "time"),
    ("flag", LAST, "int"),
)
ENVIRONMENT_LINE = (
    ("machine_id", 1, "text"),
    ("temperature", 5, "double"),
)
