from quotemill.operators.ledger import KeyLedger, new_load
from quotemill.operators.loading import append_new, rows_not_in
from quotemill.operators.numbering import assign_keys, last_key, positions
from quotemill.operators.publish import publish_if_complete, union_shards
from quotemill.operators.quality import (
    date_id_overflow,
    fk_orphans,
    pk_violations,
    unmatched_quotes,
)
from quotemill.operators.selection import (
    distinct_on_date,
    first_record,
    price_page,
    price_range,
)
from quotemill.operators.summaries import (
    KeySummaries,
    fk_orphans_of_load,
    key_blocks,
    pk_violations_of_load,
    refresh_dimensions,
)
from quotemill.operators.symbols import (
    missing_codes,
    position_slice,
    symbol_count,
    symbol_positions,
    symbol_shards,
)

__all__ = [
    "KeyLedger", "KeySummaries", "append_new", "assign_keys", "date_id_overflow", "distinct_on_date", "first_record",
    "fk_orphans", "fk_orphans_of_load", "key_blocks", "last_key", "missing_codes", "new_load",
    "pk_violations", "pk_violations_of_load", "position_slice", "positions", "price_page",
    "price_range", "publish_if_complete", "refresh_dimensions", "rows_not_in",
    "symbol_count", "symbol_positions", "symbol_shards", "union_shards", "unmatched_quotes",
]
