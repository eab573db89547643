from quotemill.sinks.files import write_csv
from quotemill.sinks.remote import (
    encode_messages,
    jdbc_append,
    publish_messages,
    warehouse_append,
)
from quotemill.sinks.tables import (
    append_table,
    bucketed_table,
    copy_table,
    create_if_absent,
    replace_partitions,
    replace_table,
    write_tables,
)

__all__ = [
    "append_table", "bucketed_table", "copy_table", "create_if_absent", "encode_messages",
    "jdbc_append", "publish_messages", "replace_partitions", "replace_table", "warehouse_append", "write_csv",
    "write_tables",
]
