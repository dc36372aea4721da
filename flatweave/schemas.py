"""Source schemas, table names and the routing between them.

The export format fixes every name in this module.  Struct fields are listed in
the order of the flat output, so a depth-first walk over the scalar leaves of a
source schema *is* the flat table's select list.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import types as T

_STRING, _LONG, _DOUBLE, _BOOLEAN = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _strings(names: str) -> dict:
    return dict.fromkeys(names.split(), _STRING)


def _doubles(names: str) -> dict:
    return dict.fromkeys(names.split(), _DOUBLE)


def _longs(names: str) -> dict:
    return dict.fromkeys(names.split(), _LONG)


def _struct(fields: dict) -> T.StructType:
    """A struct type: a dict is a nested struct, a list of one dict an array of structs."""

    def kind(spec):
        if isinstance(spec, dict):
            return _struct(spec)
        return T.ArrayType(_struct(spec[0])) if isinstance(spec, list) else spec

    return T.StructType([T.StructField(name, kind(spec)) for name, spec in fields.items()])


# ---- Fixed values: source columns -------------------------------------------

_PARAM_VALUE = {**_strings("string_value"), **_longs("int_value"), **_doubles("float_value double_value")}

EVENTS = _struct(
    {
        "event_date": _STRING,
        "event_timestamp": _LONG,
        "event_name": _STRING,
        "event_previous_timestamp": _LONG,
        "event_value_in_usd": _DOUBLE,
        "event_bundle_sequence_id": _LONG,
        "event_server_timestamp_offset": _LONG,
        "user_id": _STRING,
        "user_pseudo_id": _STRING,
        "privacy_info": _strings("analytics_storage ads_storage uses_transient_token"),
        "user_first_touch_timestamp": _LONG,
        "user_ltv": {"revenue": _DOUBLE, "currency": _STRING},
        "device": {
            **_strings(
                "category mobile_brand_name mobile_model_name mobile_marketing_name mobile_os_hardware_model"
                " operating_system operating_system_version vendor_id advertising_id language is_limited_ad_tracking"
            ),
            "time_zone_offset_seconds": _LONG,
            **_strings("browser browser_version"),
            "web_info": _strings("browser browser_version hostname"),
        },
        "geo": _strings("continent country region city sub_continent metro"),
        "app_info": _strings("id version install_store firebase_app_id install_source"),
        "traffic_source": _strings("name medium source"),
        "stream_id": _STRING,
        "platform": _STRING,
        "event_dimensions": _strings("hostname"),
        "ecommerce": {
            "total_item_quantity": _LONG,
            **_doubles(
                "purchase_revenue_in_usd purchase_revenue refund_value_in_usd refund_value shipping_value_in_usd"
                " shipping_value tax_value_in_usd tax_value"
            ),
            "unique_items": _LONG,
            "transaction_id": _STRING,
        },
        "collected_traffic_source": _strings(
            "manual_campaign_id manual_campaign_name manual_source manual_medium manual_term manual_content"
            " manual_source_platform manual_creative_format manual_marketing_tactic gclid dclid srsltid"
        ),
        "is_active_user": _BOOLEAN,
        **_longs("batch_event_index batch_page_id batch_ordering_id"),
        "session_traffic_source_last_click": {
            "manual_campaign": _strings(
                "campaign_id campaign_name source medium term content source_platform creative_format marketing_tactic"
            ),
            "google_ads_campaign": _strings(
                "customer_id account_name campaign_id campaign_name ad_group_id ad_group_name"
            ),
            "cross_channel_campaign": _strings(
                "campaign_id campaign_name source medium source_platform default_channel_group primary_channel_group"
            ),
            "sa360_campaign": _strings(
                "campaign_id campaign_name source medium ad_group_id ad_group_name creative_format engine_account_name"
                " engine_account_type manager_account_name"
            ),
            "cm360_campaign": _strings(
                "campaign_id campaign_name source medium account_id account_name advertiser_id advertiser_name"
                " creative_id creative_format creative_name creative_type creative_type_id creative_version"
                " placement_id placement_cost_structure placement_name rendering_id site_id site_name"
            ),
            "dv360_campaign": _strings(
                "campaign_id campaign_name source medium advertiser_id advertiser_name creative_id creative_format"
                " creative_name exchange_id exchange_name insertion_order_id insertion_order_name line_item_id"
                " line_item_name partner_id partner_name"
            ),
        },
        "publisher": {"ad_revenue_in_usd": _DOUBLE, **_strings("ad_format ad_source_name ad_unit_id")},
        "event_params": [{"key": _STRING, "value": _PARAM_VALUE}],
        "user_properties": [{"key": _STRING, "value": {**_PARAM_VALUE, "set_timestamp_micros": _LONG}}],
        "items": [
            {
                **_strings(
                    "item_id item_name item_brand item_variant item_category item_category2 item_category3"
                    " item_category4 item_category5"
                ),
                **_doubles("price_in_usd price"),
                "quantity": _LONG,
                **_doubles("item_revenue_in_usd item_revenue item_refund_in_usd item_refund"),
                **_strings(
                    "coupon affiliation location_id item_list_id item_list_name item_list_index promotion_id"
                    " promotion_name creative_name creative_slot"
                ),
            }
        ],
    }
)

_USER_COLUMNS = {
    "user_info": {
        **_longs("last_active_timestamp_micros user_first_touch_timestamp_micros"),
        "first_purchase_date": _STRING,
    },
    "device": _strings("operating_system category mobile_brand_name mobile_model_name unified_screen_name"),
    "geo": _strings("city country continent region"),
    "user_ltv": {
        "revenue_in_usd": _DOUBLE,
        **_longs("sessions engagement_time_millis purchases engaged_sessions session_duration_micros"),
    },
    "predictions": _doubles("in_app_purchase_score_7d purchase_score_7d churn_score_7d revenue_28d_in_usd"),
    "privacy_info": _strings("is_limited_ad_tracking is_ads_personalization_allowed"),
    **_strings("occurrence_date last_updated_date"),
    "user_properties": [
        {
            "key": _STRING,
            "value": {"string_value": _STRING, "set_timestamp_micros": _LONG, "user_property_name": _STRING},
        }
    ],
    "audiences": [
        {
            **_strings("id name"),
            **_longs("membership_start_timestamp_micros membership_expiry_timestamp_micros"),
            "npa": _STRING,
        }
    ],
}

PSEUDO_USERS = _struct({**_strings("pseudo_user_id stream_id"), **_USER_COLUMNS})
USERS = _struct({"user_id": _STRING, **_USER_COLUMNS})

# ---- Fixed values: source tables and the flat tables each one feeds -----------

SOURCE_SCHEMAS = {
    "events": EVENTS,
    "events_intraday": EVENTS,
    "pseudonymous_users": PSEUDO_USERS,
    "users": USERS,
}

EVENT_TABLES = ("events", "event_params", "user_properties", "items")
PSEUDO_USER_TABLES = ("pseudo_users", "pseudo_user_properties", "pseudo_user_audiences")
USER_TABLES = ("users", "users_user_properties", "users_user_audiences")

TABLES_OF_SOURCE = {
    "events": EVENT_TABLES,
    "events_intraday": EVENT_TABLES,
    "pseudonymous_users": PSEUDO_USER_TABLES,
    "users": USER_TABLES,
}

ALL_TABLES = EVENT_TABLES + PSEUDO_USER_TABLES + USER_TABLES

# Event columns that only the daily table selects.
DAILY_ONLY = (
    "batch_event_index",
    "batch_page_id",
    "batch_ordering_id",
    "session_traffic_source_last_click",
    "publisher",
)

# Shard from which the same-day export carries a column, and the collected
# traffic fields that the same-day view exposes.
COLLECTED_TRAFFIC_SINCE = "20230503"
ACTIVE_USER_SINCE = "20230717"
INTRADAY_COLLECTED_TRAFFIC = (
    "manual_campaign_id",
    "manual_campaign_name",
    "manual_source",
    "manual_medium",
    "manual_term",
    "manual_content",
    "gclid",
    "dclid",
    "srsltid",
)

# ---- Columns every source row carries next to its export fields ----------------

PLACE = ("dataset", "shard")
PLACE_FIELDS = [T.StructField(name, T.StringType()) for name in PLACE]


def leaf_paths(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, T.DataType]]:
    """Dotted path and type of every scalar leaf outside arrays, depth first."""
    for field in schema.fields:
        path = prefix + field.name
        if isinstance(field.dataType, T.StructType):
            yield from leaf_paths(field.dataType, path + ".")
        elif not isinstance(field.dataType, T.ArrayType):
            yield path, field.dataType


def has_path(schema: T.StructType, path: str) -> bool:
    """True if the dotted path names a field of the schema."""
    head, _, rest = path.partition(".")
    if head not in schema.names:
        return False
    inner = schema[head].dataType
    return not rest or (isinstance(inner, T.StructType) and has_path(inner, rest))


def date_field(table: str) -> str:
    """Name of the day column of a flat table (without the ``flat_`` prefix)."""
    return "event_date" if table in EVENT_TABLES else "date"


def is_intraday(source: str) -> bool:
    return "intraday" in source
