from .units import (COMPAT, SCALED, parse_int, parse_int_of_float, size_to_double,
                    size_to_long, strip_brackets)
from .timefmt import (clock_text, epoch_to_timestamp, max_label, min_label, now_epoch,
                      ntz_epoch_seconds)
from .sql import register_sql_functions

__all__ = [
    "COMPAT", "SCALED", "parse_int", "parse_int_of_float", "size_to_double", "size_to_long",
    "strip_brackets", "clock_text", "epoch_to_timestamp", "max_label", "min_label",
    "now_epoch", "ntz_epoch_seconds", "register_sql_functions",
]
