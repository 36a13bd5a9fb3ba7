from .parse import (format_timestamp, iso_timestamp, nan_to_null, parse_number,
                    parse_timestamp, round_to_second, to_decimal)
from .stats import exact_avg, ratio
from .text import clean_text, strip, title_case

__all__ = [
    "clean_text", "exact_avg", "format_timestamp", "iso_timestamp", "nan_to_null",
    "parse_number", "parse_timestamp", "ratio", "round_to_second", "strip",
    "title_case", "to_decimal",
]
