from brookmart.sinks.append import kafka_sink, write_append, write_console
from brookmart.sinks.dims import ensure_dim_table, read_dim_table, upsert_dims
from brookmart.sinks.jdbc import write_jdbc_batch
from brookmart.sinks.upsert import compact_upsert, read_upsert, upsert_batch, write_upsert

__all__ = [
    "compact_upsert", "ensure_dim_table", "kafka_sink", "read_dim_table", "read_upsert", "upsert_batch",
    "upsert_dims", "write_append", "write_console", "write_jdbc_batch", "write_upsert",
]
