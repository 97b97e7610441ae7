from brookmart.operators.changes import cdc_increase, cdc_select, cdc_transition, change_rows, transition
from brookmart.operators.columns import amount
from brookmart.operators.joins import (
    Step, enrich, enrich_chain, interval_join, lookup, lookup_as_of, small_side, wide_join,
)
from brookmart.operators.logs import log_rows, split_log
from brookmart.operators.parse import parse_or_drop, parse_or_fail, parse_or_quarantine, to_json_value
from brookmart.operators.routing import latest_config, route_dims
from brookmart.operators.state import (
    bounces, daily_first_times, first_by, first_ever, first_per_day, first_state, latest_by_key, of_keys,
    repair_is_new, returning_users,
)
from brookmart.operators.windows import emitted, measures, tumble, tumble_distinct

__all__ = [
    "Step", "amount", "bounces", "cdc_increase", "cdc_select", "cdc_transition", "change_rows",
    "daily_first_times", "emitted", "enrich", "enrich_chain", "first_by", "first_ever", "first_per_day", "first_state",
    "interval_join", "latest_by_key", "latest_config", "log_rows", "lookup", "lookup_as_of",
    "measures", "of_keys", "parse_or_drop", "parse_or_fail",
    "parse_or_quarantine", "repair_is_new", "returning_users", "route_dims", "small_side",
    "split_log", "to_json_value", "transition", "tumble", "tumble_distinct", "wide_join",
]
