"""Names and shapes of the data: wire message, flat row, and the state tables."""

# The wire shape of the feed and the column names derived from it.
# Consumers of the feed rely on these exact names and orders.

MESSAGE_SCHEMA = """
    name STRING,
    is_potentially_hazardous_asteroid BOOLEAN,
    estimated_diameter STRUCT<
        kilometers: STRUCT<estimated_diameter_max: DOUBLE, estimated_diameter_min: DOUBLE>>,
    close_approach_data ARRAY<STRUCT<
        close_approach_date: STRING,
        relative_velocity: STRUCT<kilometers_per_second: STRING>,
        miss_distance: STRUCT<kilometers: STRING>>>
"""

ENVELOPE_FIELD = "near_earth_objects"

DATE_PATTERN = "yyyy-MM-dd"

LABEL = "is_potentially_hazardous_asteroid"

FLAT_COLUMNS = [
    "name",
    "close_approach_date",
    "estimated_diameter_km_max",
    "estimated_diameter_km_min",
    "relative_velocity_km_s",
    "miss_distance_km",
    LABEL,
]

FEATURE_COLUMNS = [
    "estimated_diameter_km_min",
    "estimated_diameter_km_max",
    "miss_distance_km",
    "relative_velocity_km_s",
]

HAZARDOUS = "Hazardous"
NOT_HAZARDOUS = "Not Hazardous"

FLAT_VIEW = "streaming_data"

COUNT_COLUMN = "neos_fetched"

REAL_VALUE, PREDICTED_VALUE = "real_value", "predicted_value"

# End of fixed values.

# Row bound of a written file. Equal rows shrink to almost nothing on disk, so a byte-sized read
# split alone could hand one task any number of them.
MAX_FILE_ROWS = 1_000_000

# Objects are kept as raw JSON text, so that fields nobody declared survive the fan-out.
ENVELOPE_SCHEMA = f"{ENVELOPE_FIELD} MAP<STRING, ARRAY<STRING>>"

# Enough to count objects per date without materialising any of them.
ENVELOPE_COUNT_SCHEMA = f"{ENVELOPE_FIELD} MAP<STRING, ARRAY<STRUCT<>>>"

FLAT_SCHEMA = f"""
    name STRING,
    close_approach_date STRING,
    estimated_diameter_km_max DOUBLE,
    estimated_diameter_km_min DOUBLE,
    relative_velocity_km_s DOUBLE,
    miss_distance_km DOUBLE,
    {LABEL} DOUBLE
"""

DATED_SCHEMA = f"{FLAT_SCHEMA}, approach_date DATE"

# The stored flat table: the last column is the partition directory.
FLAT_TABLE_SCHEMA = f"{DATED_SCHEMA}, approach_month DATE"

# Rows of a batch as staged by the step; the last two columns are partition directories.
# In merged batches only the last is.
ROWS_SCHEMA = f"{DATED_SCHEMA}, reason STRING, batch_id BIGINT, part STRING"

SOURCES_SCHEMA = "source STRING, modified TIMESTAMP, batch_id BIGINT"

SCORED_SCHEMA = f"""
    {DATED_SCHEMA},
    features ARRAY<DOUBLE>,
    rawPrediction ARRAY<DOUBLE>,
    probability ARRAY<DOUBLE>,
    prediction DOUBLE,
    batch_id BIGINT
"""

LEDGER_SCHEMA = """
    n_rows BIGINT,
    n_rejected BIGINT,
    n_late BIGINT,
    n_train BIGINT,
    n_test BIGINT,
    n_fitted BIGINT,
    total_train BIGINT,
    first_date DATE,
    cursor_date DATE,
    accuracy DOUBLE,
    coefficients ARRAY<DOUBLE>,
    intercept DOUBLE,
    batch_id BIGINT
"""
