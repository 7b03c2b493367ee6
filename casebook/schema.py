"""The case record: its columns, their types and the role each one plays."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "complaint_id"
TARGET = "consumer_disputed"
RECEIVED = "date_received"
SENT = "date_sent_to_company"

# Names and types of the record columns.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("complaint_id", T.StringType()),
        T.StructField("date_received", T.TimestampType()),
        T.StructField("date_sent_to_company", T.TimestampType()),
        T.StructField("company", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("sub_product", T.StringType()),
        T.StructField("issue", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("timely", T.StringType()),
        T.StructField("submitted_via", T.StringType()),
        T.StructField("company_response", T.StringType()),
        T.StructField("company_public_response", T.StringType()),
        T.StructField("consumer_consent_provided", T.StringType()),
        T.StructField("consumer_disputed", T.StringType()),
        T.StructField("complaint_what_happened", T.StringType()),
    ]
)

# Which columns feed which kind of feature, in assembly order.
CATEGORY_COLUMNS = ["company_response", "consumer_consent_provided", "submitted_via"]
TEXT_COLUMN = "issue"
DATE_COLUMNS = ["date_sent_to_company", "date_received"]
ELAPSED = "diff_in_days"

# Prefixes of the columns that the feature stages add.
IMPUTED = "im_"
INDEXED = "si_"
ENCODED = "tf_"

# Names of the columns that feature and model stages add.
ASSEMBLED = "va_input_features"
SCALED = "scaled_input_features"
LABEL_INDEX = "indexed_consumer_disputed"
PREDICTION = "prediction"
PREDICTED_LABEL = "prediction_consumer_disputed"

# Columns no model uses, dropped whatever their content.
UNWANTED_COLUMNS = ["complaint_id", "sub_product", "complaint_what_happened"]

# Tag of quarantined values, and the share of NULLs a column may hold.
QUARANTINE_REASON = "Contains many missing values"
MISSING_THRESHOLD = 0.2

# Split share, width of the hashed text vector, promotion margin, first date to load.
TEST_SHARE = 0.3
TEXT_BUCKETS = 40
PROMOTION_MARGIN = 0.002
FIRST_DATE = "2012-01-01"

SCORING_COLUMNS = [*CATEGORY_COLUMNS, TEXT_COLUMN, *DATE_COLUMNS]
TRAINING_COLUMNS = [TARGET, *SCORING_COLUMNS]


def prefixed(prefix: str, columns: list[str]) -> list[str]:
    return [prefix + column for column in columns]
