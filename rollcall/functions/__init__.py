from rollcall.functions.json import (
    blank_to_null, is_json_object, json_int, json_record, json_text, record_json,
)
from rollcall.functions.keys import composite_key, salted_row_key
from rollcall.functions.text import (
    date_text, int_to_ipv4, money, money_text, partition_date, timestamp_text, to_time,
)
from rollcall.functions.times import event_time, to_millis

__all__ = [
    "blank_to_null", "composite_key", "date_text", "event_time", "int_to_ipv4",
    "is_json_object", "json_int", "json_record", "json_text", "money", "money_text", "partition_date",
    "record_json", "salted_row_key", "timestamp_text", "to_millis", "to_time",
]
