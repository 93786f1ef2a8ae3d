from lotbook.functions.dates import parse_date
from lotbook.functions.keys import surrogate_key
from lotbook.functions.numbers import outside, percentage
from lotbook.functions.sums import ExactSum
from lotbook.functions.text import blank_to_null, drop_path, fold, source_name, table_name

__all__ = [
    "ExactSum",
    "blank_to_null",
    "drop_path",
    "fold",
    "outside",
    "parse_date",
    "percentage",
    "source_name",
    "surrogate_key",
    "table_name",
]
