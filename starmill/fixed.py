"""Fixed values of the data model: names, layouts, patterns and sizes that results depend on."""

# Column-name normalisation: runs that become "_", then characters that are dropped.
NAME_GAP = r"[\s\-]+"
NAME_DROP = r"[^\w]"

# Words that mark a time column when no spec says so.
TIME_WORDS = ("date", "update", "time")

# Column that carries the last change of a source row.
CHANGE_COLUMN = "last_update"

# Raw and clean zone layout.
INCREMENTAL_ZONE = "incremental-data"
HISTORICAL_ZONE = "historical-data"
NO_DATE = "no-date"
CSV_SUFFIX = ".csv"

# Rows per extract chunk.
CHUNK_ROWS = 10_000

# Date patterns.
DAY_PATTERN = "yyyy-MM-dd"
DATE_ID_PATTERN = "yyyyMMdd"
MONTH_NAME_PATTERN = "MMMM"
DAY_NAME_PATTERN = "EEEE"
# Day-of-week numbers of a weekend (1 = Sunday, 7 = Saturday).
WEEKEND = (1, 7)

# Histogram sizes and top-k size of the profile reports.
AMOUNT_BINS = 20
DURATION_BINS = 10
TOP_K = 10

# Prefix of tables that are appended to; all others are replaced.
FACT_PREFIX = "fact_"

# Output columns of the star schema, in order.
DIM_CUSTOMER = ("customer_id", "first_name", "last_name", "email", "active", "address", "district",
                "postal_code", "city", "country", "create_date", "last_update")
DIM_FILM = ("film_id", "title", "description", "release_year", "rental_duration", "rental_rate",
            "length", "rating", "language", "category", "last_update")
DIM_STORE = ("store_id", "manager_first_name", "manager_last_name", "store_address", "store_city",
             "store_country", "last_update")
DIM_DATE = ("date_id", "full_date", "day", "month", "month_name", "quarter", "year", "day_of_week",
            "is_weekend")
FACT_PAYMENT = ("payment_id", "customer_id", "film_id", "store_id", "date_id", "rental_id", "amount",
                "payment_date", "last_update")

# Source tables each star table needs.
STAR_SOURCES = {
    "dim_customer": ("customer", "address", "city", "country"),
    "dim_film": ("film", "film_category", "category", "language"),
    "dim_store": ("store", "staff", "address", "city", "country"),
    "dim_date": ("payment",),
    "fact_payment": ("payment", "rental", "inventory", "staff"),
}

# Trigger classes of the event log.
TRIGGER_FILE = "s3"
TRIGGER_SCHEDULE = "schedule"
TRIGGER_HISTORICAL = "historical"
TRIGGER_DIRECT = "direct"
TRIGGER_UNKNOWN = "unknown"
FILE_EVENT_SOURCE = "aws:s3"
SCHEDULE_SOURCE = "aws.events"
