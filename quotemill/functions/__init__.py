from quotemill.functions.clock import clock_text, clock_unit, stamp_date
from quotemill.functions.keys import INT_MAX, date_key
from quotemill.functions.messages import envelope_records, envelope_type, to_message

__all__ = [
    "INT_MAX", "clock_text", "clock_unit", "date_key", "envelope_records",
    "envelope_type", "stamp_date", "to_message",
]
