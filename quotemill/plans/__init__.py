from quotemill.plans.daily import (
    day_quotes,
    fact_rows,
    load_staging,
    load_star,
    read_day,
    replace_star,
    run_daily,
    star_tables,
)
from quotemill.plans.staging import blank_staging, rename_by_position, transform_quotes
from quotemill.plans.star import (
    datetime_dim,
    dimensions,
    fact_table,
    keyed_measures,
    measure_dim,
    measure_rows,
    number_staging,
    star_readback,
)

__all__ = [
    "blank_staging", "datetime_dim", "day_quotes", "dimensions", "fact_rows", "fact_table",
    "keyed_measures", "load_staging", "load_star", "measure_dim", "measure_rows",
    "number_staging", "read_day", "rename_by_position", "replace_star", "run_daily",
    "star_readback", "star_tables", "transform_quotes",
]
