"""Fixed values that must equal the original warehouse's for equal results.

Kept together, as plain text, in their natural order.
"""

# --- fixed values -----------------------------------------------------------

# Token the surrogate-key macro writes for a NULL key part (a public macro
# library's convention), and the separator placed between key parts.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"

# Warehouse layers (one database / schema each), in build order.
LAYERS = ["raw", "staging", "intermediate", "marts"]

# Day-of-week names for order_dow 0..6 (the source never documented the
# mapping; 0 and 1 are taken as the weekend).
DAY_NAMES = ["Saturday", "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]
WEEKEND_DAYS = [0, 1]

# Day parts by hour of day (inclusive bounds); any other hour is "Night".
DAY_PARTS = [("Morning", 5, 11), ("Afternoon", 12, 16), ("Evening", 17, 20)]
DAY_PART_OTHER = "Night"

# Size of the time dimension: 7 days x 24 hours.
DAYS_PER_WEEK = 7
HOURS_PER_DAY = 24

# Order line sets that are loaded (test orders carry no lines).
LOADED_EVAL_SETS = ["prior", "train"]

# Accepted values of the reordered flag.
REORDERED_VALUES = [0, 1]

# Wave label: zero-padded to three digits.
WAVE_LABEL_FORMAT = "%03d"

# Product feed defaults: page size (feed maximum 100), pages per run.
FEED_PAGE_SIZE = 100
FEED_MAX_PAGES = 5
FEED_FIELDS = ["code", "product_name", "brands", "categories_tags", "countries_tags", "nutriments",
               "last_modified_t"]
FEED_WATERMARK_FIELD = "last_modified_t"

# Nutriment fields read from the product payload, with the column each lands in.
NUTRIMENT_FIELDS = [
    ("energy-kcal_100g", "energy_kcal_100g"),
    ("sugars_100g", "sugars_100g"),
    ("fat_100g", "fat_100g"),
    ("proteins_100g", "proteins_100g"),
    ("salt_100g", "salt_100g"),
]

# Field a landed product object carries its feed position in (ours, not the source's).
FEED_SEQUENCE_FIELD = "feed_seq"

# --- end of fixed values ----------------------------------------------------
