from quotemill.streaming.backfill import (
    backfill,
    backfill_messages,
    replay_chunks,
    resumable_backfill,
)
from quotemill.streaming.decode import (
    BAD_FIELD,
    BAD_JSON,
    QUOTES,
    decode_quotes,
    route_messages,
    split_malformed,
)
from quotemill.streaming.route import read_route, start_routed_stream
from quotemill.streaming.sink import (
    all_of,
    compact,
    jdbc_batch_writer,
    keyed_batch_writer,
    plain_batch_writer,
    query_id,
    read_batches,
    run_to_end,
    start_batches,
    start_console,
    start_quote_stream,
    stream_table,
)

__all__ = [
    "BAD_FIELD", "BAD_JSON", "QUOTES", "all_of", "backfill", "backfill_messages", "compact",
    "decode_quotes", "jdbc_batch_writer", "keyed_batch_writer", "plain_batch_writer", "query_id",
    "read_batches", "read_route", "replay_chunks", "resumable_backfill", "route_messages", "run_to_end", "split_malformed",
    "start_batches", "start_console", "start_quote_stream", "start_routed_stream", "stream_table",
]
