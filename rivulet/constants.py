"""Names and values that outputs must agree on.

Fixed values (they must equal the behaviour being reproduced):
  output topics: dwd_traffic_page, dwd_traffic_start, dwd_traffic_display,
                 dwd_traffic_action, dwd_traffic_err, dirty_data
  input topics:  topic_log (log lines), topic_db (change records)
  accepted change types: insert, update, delete, bootstrap-insert
  config ops:    r (snapshot read), c (create), u (update), d (delete)
  database accepted by default: gmall
  key-value namespace: gmall
  day boundary zone for dates: Asia/Shanghai (UTC+8); previous day = ts - 86400000 ms
"""

TOPIC_PAGE = "dwd_traffic_page"
TOPIC_START = "dwd_traffic_start"
TOPIC_DISPLAY = "dwd_traffic_display"
TOPIC_ACTION = "dwd_traffic_action"
TOPIC_ERR = "dwd_traffic_err"
TOPIC_DIRTY = "dirty_data"

TOPIC_LOG = "topic_log"
TOPIC_DB = "topic_db"

CHANGE_TYPES = ("insert", "update", "delete")
BOOTSTRAP_INSERT = "bootstrap-insert"
DEFAULT_DATABASE = "gmall"
NAMESPACE = "gmall"

DEFAULT_TZ = "Asia/Shanghai"
FIXED_OFFSET_HOURS = 8
DAY_MS = 86_400_000
