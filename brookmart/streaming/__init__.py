from brookmart.streaming.bounces import bounces_stream
from brookmart.streaming.buffer import newest_after_pause
from brookmart.streaming.dedup import earliest_per_day_stream, first_per_day_stream
from brookmart.streaming.jobs import LateRows, late_rows, run_to_end, start_batches
from brookmart.streaming.ledger import Ledger

__all__ = [
    "LateRows", "Ledger", "bounces_stream", "earliest_per_day_stream", "first_per_day_stream", "late_rows", "newest_after_pause",
    "run_to_end", "start_batches",
]
