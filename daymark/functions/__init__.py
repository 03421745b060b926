from daymark.functions.dates import partition_date
from daymark.functions.numbers import difference, parse_decimal_comma, parse_grouped_long
from daymark.functions.text import cell_text, let, strip

__all__ = [
    "cell_text",
    "difference",
    "let",
    "parse_decimal_comma",
    "parse_grouped_long",
    "partition_date",
    "strip",
]
