"""Table layouts, candidate column names and serving constraints."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Columns of every table, in storage order.
BRONZE_SERIES = (
    "id string, series_id string, series_name string, category string, period string, "
    "value string, source string, ingestion_timestamp string, raw_response string, "
    "_partition_key string"
)
BRONZE_ANNUAL = (
    "id string, indicator_id string, indicator_name string, category string, country string, "
    "country_code string, year string, value string, unit string, source string, "
    "ingestion_timestamp string, raw_response string"
)
BRONZE_TRADE = (
    "id string, reporter_code string, reporter string, partner_code string, partner string, "
    "flow_code string, flow_desc string, year string, cmd_code string, cmd_desc string, "
    "trade_value double, net_weight double, source string, ingestion_timestamp string, "
    "raw_response string, _partition_key string"
)
INDICATORS = (
    "indicator_id string, indicator_name string, category string, source string, date date, "
    "year int, month int, value_numeric double"
)
SILVER_INDICATORS = INDICATORS + ", processed_timestamp timestamp"
SILVER_TRADE = (
    "partner_code int, partner string, flow_code string, flow_desc string, year int, "
    "cmd_code string, cmd_desc string, trade_value double, net_weight double, source string, "
    "trade_value_millions double, processed_timestamp timestamp"
)
DIM_DATE = (
    "full_date date, date_key int, year int, quarter int, month int, month_name string, "
    "week_of_year int, day_of_week int, day_name string, is_weekend boolean"
)
DIM_INDICATOR = (
    "indicator_key string, indicator_name string, category string, source string, unit string"
)
DIM_TRADE_PARTNER = "partner_key int, partner_name string, region string"
FACT_INDICATORS = (
    "date_key int, indicator_key string, source string, category string, value_numeric double, "
    "year int, month int, prev_year_value double, yoy_change double, load_timestamp timestamp"
)
FACT_TRADE = (
    "date_key int, partner_key int, flow_code string, flow_desc string, cmd_code string, "
    "cmd_desc string, trade_value double, trade_value_millions double, net_weight double, "
    "year int, prev_year_value double, yoy_change_pct double, load_timestamp timestamp"
)

# Names of the tables in each layer.
LAYER_TABLES = {
    "bronze": {
        "bcrp_indicators": BRONZE_SERIES,
        "worldbank_indicators": BRONZE_ANNUAL,
        "comtrade_peru": BRONZE_TRADE,
    },
    "silver": {"economic_indicators": SILVER_INDICATORS, "trade_data": SILVER_TRADE},
    "gold": {
        "dim_date": DIM_DATE,
        "dim_indicator": DIM_INDICATOR,
        "dim_trade_partner": DIM_TRADE_PARTNER,
        "fact_economic_indicators": FACT_INDICATORS,
        "fact_trade_yearly": FACT_TRADE,
    },
}

# Accepted source columns of each indicator column, best first.
SERIES_CANDIDATES = {
    "indicator_id": ("series_id", "id"),
    "indicator_name": ("series_name", "name", "source"),
    "category": ("category", "_partition_key"),
    "period": ("period", "date"),
    "value": ("value", "amount"),
}
ANNUAL_CANDIDATES = {
    "indicator_id": ("indicator_id", "id"),
    "indicator_name": ("indicator_name", "name", "source"),
    "category": ("category", "_partition_key"),
    "period": ("year", "period", "date"),
    "value": ("value", "amount"),
}

# Constraints of the serving star schema.
PRIMARY_KEYS = {
    "dim_date": ("date_key",),
    "dim_indicator": ("indicator_key",),
    "dim_trade_partner": ("partner_key",),
}
FOREIGN_KEYS = {
    "fact_economic_indicators": {"date_key": "dim_date", "indicator_key": "dim_indicator"},
    "fact_trade_yearly": {"date_key": "dim_date", "partner_key": "dim_trade_partner"},
}
NOT_NULL = {
    "dim_date": (
        "date_key", "full_date", "year", "quarter", "month", "month_name", "week_of_year",
        "day_of_week", "day_name", "is_weekend",
    ),
    "dim_indicator": ("indicator_key", "indicator_name", "category", "source"),
    "dim_trade_partner": ("partner_key", "partner_name"),
    "fact_economic_indicators": ("date_key", "indicator_key"),
    "fact_trade_yearly": ("date_key", "partner_key", "flow_code"),
}
DECIMALS = {
    "fact_economic_indicators": {
        "value_numeric": (18, 4), "prev_year_value": (18, 4), "yoy_change": (10, 2),
    },
    "fact_trade_yearly": {
        "trade_value": (18, 2), "trade_value_millions": (12, 2), "net_weight": (18, 2),
        "prev_year_value": (18, 2), "yoy_change_pct": (10, 2),
    },
}
TEXT_LENGTHS = {
    "dim_date": {"month_name": 20, "day_name": 20},
    "dim_indicator": {
        "indicator_key": 50, "indicator_name": 200, "category": 50, "source": 50, "unit": 50,
    },
    "dim_trade_partner": {"partner_name": 100, "region": 50},
    "fact_economic_indicators": {"indicator_key": 50, "source": 50, "category": 50},
    "fact_trade_yearly": {"flow_code": 5, "flow_desc": 50, "cmd_code": 20, "cmd_desc": 200},
}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def names(ddl: str) -> list[str]:
    """Column names of one of the flat layouts above, without a session."""
    return [column.split()[0] for column in ddl.split(",")]
