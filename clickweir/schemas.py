"""Column layouts of every layer. Nothing is ever inferred from files."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES = {"string": StringType(), "int": IntegerType(), "long": LongType(), "double": DoubleType(), "boolean": BooleanType(), "binary": BinaryType()}


def _layout(spec: str) -> StructType:
    pairs = (item.split(":") for item in spec.split())
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


PERIOD = ["lang", "year", "month"]

BRONZE = _layout("lang:string year:int month:int prev:string curr:string type:string n:string")
SILVER = _layout("lang:string year:int month:int prev_title:string curr_title:string type:string n:int")
# Readable rows of dump files, before the dumps that count are chosen.
STAGED = _layout(
    "file:int kept:boolean lang:string year:int month:int prev_title:string curr_title:string type:string n:int"
)
MANIFEST = _layout("path:string lang:string year:int month:int")
PARTITIONS = _layout("lang:string year:int month:int")

DICTIONARY = _layout("lang:string id:long title:string")

GOLD = {
    "article_popularity": _layout("lang:string year:int month:int curr_id:long total_clicks:long"),
    "article_top": _layout("lang:string year:int month:int curr_id:long total_clicks:long rn:long"),
    "referrers_top": _layout(
        "lang:string year:int month:int curr_id:long prev_id:long clicks_from_prev:long rn:long"
    ),
    "edges_monthly": _layout(
        "lang:string year:int month:int prev_id:long curr_id:long total_transitions:long"
    ),
}

INSIGHTS = {
    "top10_by_year": _layout("lang:string year:int curr_title:string clicks_year:long rn:long"),
    "all_time_top": _layout("lang:string curr_title:string clicks_all_time:long"),
    "edges_6m": _layout(
        "lang:string year:int month:int prev_title:string curr_title:string transitions_6m:long"
    ),
    "trending_mom": _layout(
        "lang:string year:int month:int curr_title:string clicks_now:long clicks_prev:long "
        "abs_delta:long pct_delta:double"
    ),
    "referrers_6m": _layout(
        "lang:string year:int month:int curr_title:string prev_title:string clicks_6m:long rn:long"
    ),
}

# Hive partition columns of each insight table; every other layered table uses PERIOD.
INSIGHT_PARTITIONS = {
    "top10_by_year": ["lang", "year"],
    "all_time_top": ["lang"],
    "edges_6m": PERIOD,
    "trending_mom": PERIOD,
    "referrers_6m": PERIOD,
}

# What grows by month: totals that new months are added to, and the parts of profiles.
STATES = {
    "yearly_totals": _layout("lang:string year:int curr_id:long total_clicks:long"),
    "all_time_totals": _layout("lang:string curr_id:long total_clicks:long"),
    "profiles": _layout("lang:string year:int month:int bucket:long bits:binary records:long total_clicks:long"),
}
STATE_PARTITIONS = {"yearly_totals": ["lang", "year"], "all_time_totals": ["lang"], "profiles": PERIOD}
