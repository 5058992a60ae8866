from .jsontext import apart, as_json, canonical_json, document, explode_parsed, field, parse_once
from .marks import is_distinct, marked_distinct
from .tags import tag, tags_to_map
from .text import nth, text_or_null
from .times import (
    ago,
    day_index,
    hour_of_day,
    hour_start,
    in_window,
    instant,
    launch_instant,
    minute_index,
    minutes_between,
    partition_day,
    timebound,
)

__all__ = [
    "ago",
    "apart",
    "as_json",
    "canonical_json",
    "day_index",
    "document",
    "explode_parsed",
    "field",
    "hour_of_day",
    "hour_start",
    "in_window",
    "instant",
    "is_distinct",
    "launch_instant",
    "marked_distinct",
    "minute_index",
    "minutes_between",
    "nth",
    "parse_once",
    "partition_day",
    "tag",
    "tags_to_map",
    "text_or_null",
    "timebound",
]
