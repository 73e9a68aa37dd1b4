"""Fixed values.

Lists and patterns that results are compared by; change them only together with the
tables they describe. Reason texts stand with their rules, in ``plans``.
"""

# customers
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PROVINCES = ("AB", "BC", "MB", "ON", "QC")
CUSTOMER_STATUSES = ("ACTIVE", "INACTIVE")

# products
PRODUCT_CATEGORIES = ("LAPTOP", "MONITOR", "KEYBOARD", "MOUSE", "PHONE", "TABLET")
PRODUCT_STATUSES = ("ACTIVE", "INACTIVE")

# orders
ORDER_STATUSES = ("COMPLETED", "PENDING", "CANCELLED", "REFUNDED")
AMOUNT_TOLERANCE = "0.01"

# Click events
EVENT_TYPES = ("page_view", "product_view", "add_to_cart", "checkout", "purchase", "click")

# Column types of money and discount in gold
MONEY = "decimal(12,2)"
FRACTION = "decimal(5,4)"

# Types in which amounts are checked: a whole quantity times a price, less a discount, plus
# tax has 38 digits in them, so that no step before the last rounds
WIDE_MONEY = "decimal(15,6)"
WIDE_FRACTION = "decimal(9,6)"

# What separates the reasons of one rejected row
REASON_SEPARATOR = "; "

# Order in which copies of one key are ranked, newest first
NEWEST_FIRST = ("_ingested_at", "_source_file_modified_at")

# Ingest parameters
LANDING_FORMATS = ("csv", "avro", "json", "parquet")
LOAD_MODES = ("overwrite", "append")
