from perigee.functions.columns import (
    class_text,
    day,
    decode,
    first_approach,
    flag_to_label,
    is_finite,
    keyed_bucket,
    linear_margin,
    to_day,
    to_double,
)

__all__ = [
    "class_text",
    "day",
    "decode",
    "first_approach",
    "flag_to_label",
    "is_finite",
    "keyed_bucket",
    "linear_margin",
    "to_day",
    "to_double",
]
