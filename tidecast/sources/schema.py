"""Names and types of the raw daily record and of the tables derived from it."""

from pyspark.sql import types as T

# fixed values: columns of the raw daily record, in file order
RAW_COLUMNS = [
    "No", "Date", "Ticker", "Reference", "Open_price", "Close_price",
    "Highest_price", "Lowest_price", "Average",
    "Change", "Change_percent", "Matched_volume", "Matched_value",
    "Negotiated_volume", "Negotiated_value",
    "Total_volume", "Total_value", "Market_cap",
]

# fixed values: columns whose text carries thousands separators
FORMATTED_COLUMNS = [
    "Reference", "Open_price", "Close_price", "Highest_price", "Lowest_price",
    "Average", "Change", "Matched_value", "Negotiated_value", "Total_value", "Market_cap",
]

# Further numeric text that carries no separators; typed only on request.
PLAIN_NUMERIC_COLUMNS = [
    "Change_percent", "Matched_volume", "Negotiated_volume", "Total_volume",
]

TARGET = "Close_price"
MIN_ROWS = 20

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

# fixed values: columns of the result files
PREDICTIONS_SCHEMA = T.StructType([
    T.StructField("Ticker", T.StringType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Actual", T.DoubleType()),
    T.StructField("Predicted", T.DoubleType()),
    T.StructField("Model", T.StringType()),
])

METRICS_SCHEMA = T.StructType([
    T.StructField("Ticker", T.StringType()),
    T.StructField("Model", T.StringType()),
    T.StructField("MAE", T.DoubleType()),
    T.StructField("RMSE", T.DoubleType()),
    T.StructField("MAPE", T.DoubleType()),
    T.StructField("R2", T.DoubleType()),
])
