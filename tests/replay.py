"""Plain-Python, record-by-record replays of the reproduced jobs' rules.

Used only by tests, on small fixtures, as a brute-force oracle independent
of both the Spark code and the SQL oracles."""

from __future__ import annotations

import datetime as dt
import json

DAY = 86_400_000
PLUS8 = dt.timezone(dt.timedelta(hours=8))


def day(ms: int) -> str:
    return dt.datetime.fromtimestamp(ms / 1000, PLUS8).strftime("%Y-%m-%d")


def _text(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (dict, list)):
        return json.dumps(v, separators=(",", ":"))
    return str(v)


def replay_visitor(lines):
    """lines: iterable of (seq, value). Returns {seq: (mid, is_new_in, visit, first, is_new)}."""
    state, out = {}, {}
    for seq, value in sorted(lines, key=lambda x: x[0]):
        try:
            obj = json.loads(value)
        except (TypeError, ValueError):
            continue
        if not isinstance(obj, dict) or not isinstance(obj.get("common"), dict):
            continue
        mid, ts = obj["common"].get("mid"), obj.get("ts")
        if mid is None or ts is None:
            continue
        mid, flag_in = _text(mid), _text(obj["common"].get("is_new"))
        cur, flag = day(int(ts)), _text(obj["common"].get("is_new"))
        if flag == "1":
            if mid not in state:
                state[mid] = cur
            elif state[mid] != cur:
                flag = "0"
        elif mid not in state:
            state[mid] = day(int(ts) - DAY)
        out[seq] = (mid, flag_in, cur, state[mid], flag)
    return out


def replay_dims(config_lines, change_lines, database="gmall"):
    """Replays config and change records in seq order (config first on ties).
    Returns the final cells as a sorted list of (sink_table, row_key, col, value)."""
    items = [(s, 0, v) for s, v in config_lines] + [(s, 1, v) for s, v in change_lines]
    routes, tables = {}, {}
    for seq, kind, value in sorted(items, key=lambda x: (x[0], x[1])):
        try:
            rec = json.loads(value)
        except ValueError:
            continue                       # set aside
        if kind == 0:
            op = rec.get("op")
            img = rec.get("before") if op == "d" else rec.get("after")
            if img is None:
                continue
            src, sink = img["source_table"], img["sink_table"]
            if op == "d":
                routes.pop(src, None)
                tables.pop(sink, None)
            elif op in ("r", "c"):
                routes[src] = img
                tables.setdefault(sink, {})
            else:
                routes[src] = img
                tables[sink] = {}
            continue
        typ, data = rec.get("type"), rec.get("data")
        data_text = None if data is None else json.dumps(data, separators=(",", ":"))
        if rec.get("database") != database or not (
                typ in ("insert", "update", "delete")
                or (typ == "bootstrap-insert" and data_text is not None and len(data_text) > 2)):
            continue
        cfg = routes.get(rec.get("table"))
        if cfg is None:
            continue
        if data is None:
            continue                       # set aside
        cols = cfg["sink_columns"].split(",")
        kept = {k: v for k, v in data.items() if k in cols}
        kept["type"] = typ
        kept.pop("type")
        key = _text(kept.get(cfg["sink_row_key"]))
        sink = cfg["sink_table"]
        assert sink in tables, f"write to a missing table {sink} at seq {seq}"
        assert key is not None, f"null row key at seq {seq}"
        if typ == "delete":
            tables[sink].pop(key, None)
        else:
            row = tables[sink].setdefault(key, {})
            for k, v in kept.items():
                if v is not None and _text(v) != "":
                    row[k] = _text(v)
    return sorted((t, k, c, v) for t, rows in tables.items() for k, row in rows.items()
                  for c, v in row.items())
