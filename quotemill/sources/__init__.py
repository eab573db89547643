from quotemill.sources.files import (
    bulk_load,
    read_csv,
    read_quotes,
    read_shard_files,
    read_symbols,
)
from quotemill.sources.html import html_rows, nested_table_rows, table_rows
from quotemill.sources.ledger import FileLedger, read_new_shard_files, read_symbols_listed
from quotemill.sources.remote import jdbc_query, jdbc_table, topic_reader, warehouse_query
from quotemill.sources.responses import (
    company_records,
    envelope_explode,
    response_records,
    response_status,
)
from quotemill.sources.sql import register_tables, sql_query, sql_query_named

__all__ = [
    "FileLedger", "bulk_load", "company_records", "envelope_explode", "html_rows", "jdbc_query",
    "jdbc_table", "nested_table_rows", "read_csv", "read_new_shard_files", "read_quotes", "read_shard_files",
    "read_symbols", "read_symbols_listed",
    "register_tables", "response_records", "response_status", "sql_query", "sql_query_named", "table_rows",
    "topic_reader", "warehouse_query",
]
