"""Declared schemas of the landing, derived, telemetry and message tables."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)
AUM = T.DecimalType(28, 4)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, nullable) for name, dtype, nullable in fields])


def _required(name, dtype=T.StringType()):
    return (name, dtype, False)


def _optional(name, dtype=T.StringType()):
    return (name, dtype, True)


_TS = T.TimestampNTZType()

TERRITORY_DIM = _struct(
    _required("territory_id"), _required("territory_name"), _optional("region"),
    _optional("territory_mgr"), _optional("active", T.BooleanType()), _required("row_timestamp", _TS),
)

FUND_DIM = _struct(
    _required("fund_id"), _required("fund_name"), _optional("fund_category"), _optional("asset_class"),
    _optional("benchmark"), _optional("inception_date", T.DateType()), _required("row_timestamp", _TS),
)

ADVISOR_DIM = _struct(
    _required("advisor_id"), _required("advisor_name"), _required("territory_id"), _optional("tier"),
    _optional("hire_date", T.DateType()), _optional("email"), _optional("active", T.BooleanType()),
    _required("row_timestamp", _TS),
)

ADVISOR_EVENTS = _struct(
    _required("event_id"), _required("advisor_id"), _required("territory_id"), _required("event_type"),
    _required("event_timestamp", _TS), _optional("fund_id"), _optional("aum_amount", MONEY),
    _optional("opportunity_id"), _optional("metadata", T.VariantType()), _required("row_timestamp", _TS),
)

FUND_FLOWS = _struct(
    _required("flow_id"), _required("fund_id"), _required("advisor_id"), _required("territory_id"),
    _required("flow_amount", MONEY), _required("flow_date", T.DateType()), _required("flow_type"),
    _optional("share_class"), _required("row_timestamp", _TS),
)

OPPORTUNITY = _struct(
    _required("opportunity_id"), _required("advisor_id"), _required("territory_id"), _required("stage"),
    _optional("amount", MONEY), _optional("close_date", T.DateType()), _optional("fund_id"),
    _optional("created_date", T.DateType()), _optional("last_modified", T.DateType()), _required("row_timestamp", _TS),
)

ACCOUNT = _struct(
    _required("account_id"), _required("advisor_id"), _required("territory_id"), _required("account_name"),
    _optional("aum_tier"), _optional("relationship_mgr"), _optional("last_activity", _TS),
    _required("row_timestamp", _TS),
)

LANDING = {
    "territory_dim": TERRITORY_DIM,
    "fund_dim": FUND_DIM,
    "advisor_dim": ADVISOR_DIM,
    "advisor_events": ADVISOR_EVENTS,
    "fund_flows": FUND_FLOWS,
    "opportunity": OPPORTUNITY,
    "account": ACCOUNT,
}

# One JSON object of the event stream.  Times stay text and metadata stays raw JSON
# until the values have been checked; ``_corrupt`` receives lines that do not parse.
MESSAGE = _struct(
    _optional("event_id"), _optional("advisor_id"), _optional("territory_id"), _optional("event_type"),
    _optional("event_timestamp"), _optional("fund_id"), _optional("aum_amount", T.DoubleType()),
    _optional("opportunity_id"), _optional("metadata"), _optional("row_timestamp"), _optional("_corrupt"),
)
