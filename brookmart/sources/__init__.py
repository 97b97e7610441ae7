from brookmart.sources.dims import read_dim
from brookmart.sources.events import read_changes, read_config_events, read_json, read_log
from brookmart.sources.text import kafka_source, read_delimited, read_text, read_text_stream

__all__ = [
    "kafka_source", "read_changes", "read_config_events", "read_delimited", "read_dim", "read_json", "read_log",
    "read_text", "read_text_stream",
]
