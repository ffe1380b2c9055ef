from rivulet.functions.jsonmap import (parse_object, normalize_object, parse_string_map, member, member_str,
                                       member_long, member_array, with_member, without_members,
                                       to_json_object)
from rivulet.functions.times import (ts_to_day, day_text, ts_to_date, ts_to_datetime, ts_to_partition_day,
                                     datetime_to_ts, date_to_ts, previous_day, ms_of)

__all__ = ["parse_object", "normalize_object", "parse_string_map", "member", "member_str", "member_long",
           "member_array", "with_member", "without_members", "to_json_object",
           "ts_to_day", "day_text", "ts_to_date", "ts_to_datetime", "ts_to_partition_day", "datetime_to_ts",
           "date_to_ts", "previous_day", "ms_of"]
