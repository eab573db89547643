"""Repeated rows out of HTML text, with positions and NULL for missing cells."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A table row, a table cell, and markup inside a cell.
TABLE_ROW = r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"
TABLE_CELL = r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"
MARKUP = r"(?s)<[^>]*>"

# What holds no table although it may look so, where a table begins or ends, and the
# tags of rows and cells.
NOT_CONTENT = r"(?is)<(?:!--.*?-->|(script|style)\b[^>]*>.*?</\1\s*>)"
TABLE_BORDER = r"(?i)(?=</?table\b)"
ROW_OR_CELL_TAG = r"(?i)</?t[rdh]\b[^>]*>"
# Begins the text of a table; taken out of pages before.
TABLE_MARK = "\x00"

# Cell numbers (from 1) of the listing page's columns, and its first data row.
LISTING_CELLS = {"Stock_Code": 2, "Name_Company": 3, "Industry": 4, "Exchange": 5, "KLCPNY": 6}
LISTING_FIRST_ROW = 3


def html_rows(
    pages: DataFrame,
    pattern: str,
    name: str,
    html: str = "html",
    keep: tuple[str, ...] = (),
    first: int = 1,
    last: int | None = None,
) -> DataFrame:
    """Each match of ``pattern`` (its group 1) with ``pos`` counted from 1 per page."""
    matches = F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))
    rows = pages.select(*keep, F.posexplode(matches).alias("pos", name)).withColumn(
        "pos", F.col("pos") + 1
    )
    wanted = F.col("pos") >= first
    if last is not None:
        wanted = wanted & (F.col("pos") <= last)
    return rows.where(wanted)


def table_rows(
    pages: DataFrame,
    cells: Mapping[str, int] = LISTING_CELLS,
    html: str = "html",
    keep: tuple[str, ...] = (),
    first: int = LISTING_FIRST_ROW,
    last: int | None = None,
) -> DataFrame:
    """Table rows from ``first`` to ``last`` with the named cells as text."""
    rows = html_rows(pages, TABLE_ROW, "__row", html, keep, first, last)
    found = F.regexp_extract_all(F.col("__row"), F.lit(TABLE_CELL), F.lit(1))
    rows = rows.select(*keep, "pos", found.alias("__cells"))
    return rows.select(
        *keep,
        "pos",
        *(
            F.trim(F.regexp_replace(F.get("__cells", F.lit(number - 1)), MARKUP, "")).alias(name)
            for name, number in cells.items()
        ),
    )


def _tables_at(html: Column, depth: int) -> Column:
    """The text of each table that stands in ``depth`` - 1 others, in page order, without the row and
    cell tags of the tables inside it.

    A page is cut only where tables begin and end, so the state carried from piece to piece is
    one number, and the pieces kept are as many as there are such tags.
    """
    content = F.replace(F.regexp_replace(html, NOT_CONTENT, " "), F.lit(TABLE_MARK), F.lit(""))
    # With a blank in front, every piece but the first begins with a tag, and the first with none.
    pieces = F.split(F.concat(F.lit(" "), content), TABLE_BORDER)
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))

    def step(state: Column, piece: Column) -> Column:
        ends, begins = piece.startswith("</"), piece.startswith("<")
        now = F.when(ends, F.greatest(F.lit(0), state["depth"] - 1)).when(begins, state["depth"] + 1).otherwise(0)
        first = F.when(begins & ~ends, F.lit(TABLE_MARK)).otherwise(F.lit(" "))
        text = F.when(now == depth, F.concat(first, piece)).otherwise(F.regexp_replace(piece, ROW_OR_CELL_TAG, " "))
        kept = F.when(now >= depth, F.concat(state["kept"], F.array(text))).otherwise(state["kept"])
        return F.struct(now.alias("depth"), kept.alias("kept"))

    marked = F.array_join(F.aggregate(pieces, start, step)["kept"], "")
    # What stands before the first mark is empty.
    return F.filter(F.split(marked, TABLE_MARK), lambda _, at: at > 0)


def nested_table_rows(
    pages: DataFrame,
    cells: Mapping[str, int] = LISTING_CELLS,
    html: str = "html",
    keep: tuple[str, ...] = (),
    depth: int = 1,
    first: int = 1,
    last: int | None = None,
) -> DataFrame:
    """Rows of the tables at one depth, with the number of their table (``table_no``) and in it (``pos``).

    ``depth`` 1 are tables outside all others, 2 the tables in their cells, and so on. A table inside a
    cell is text of that cell: its rows and cells count only at its own depth. White space of a cell
    is one blank, none at its ends. Comments, scripts and styles hold no tables. A table that is
    never closed reaches to the end of its page; an end without a beginning is passed over. A null
    page, or one without tables at that depth, has no rows.
    """
    # The inner explode would be given a filter that finds the tables a second time.
    tables = pages.select(*keep, F.posexplode_outer(_tables_at(F.col(html), depth)).alias("__no", "__table"))
    tables = tables.where(F.col("__table").isNotNull()).withColumn("table_no", F.col("__no") + 1)
    rows = html_rows(tables, TABLE_ROW, "__row", "__table", (*keep, "table_no"), first, last)
    found = F.regexp_extract_all(F.col("__row"), F.lit(TABLE_CELL), F.lit(1))
    rows = rows.select(*keep, "table_no", "pos", found.alias("__cells"))

    def cell(number: int) -> Column:
        text = F.regexp_replace(F.get("__cells", F.lit(number - 1)), MARKUP, "")
        return F.trim(F.regexp_replace(text, r"\s+", " "))

    return rows.select(*keep, "table_no", "pos", *(cell(n).alias(name) for name, n in cells.items()))
