from spindlewatch.functions.columns import (
    as_double,
    as_int,
    day_of,
    format_day,
    instant_of,
    joined_text,
    key_text,
    not_null,
    parse_day,
    parse_instant,
    pick_union_members,
    typed_telemetry,
    union_member,
)

__all__ = [
    "as_double",
    "as_int",
    "day_of",
    "format_day",
    "instant_of",
    "joined_text",
    "key_text",
    "not_null",
    "parse_day",
    "parse_instant",
    "pick_union_members",
    "typed_telemetry",
    "union_member",
]
