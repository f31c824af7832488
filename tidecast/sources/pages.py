"""Table rows out of saved web pages."""

from pyspark.sql import functions as F

from tidecast.functions.text import mark_missing, plain_text
from tidecast.sources.schema import RAW_COLUMNS


def _elements(col, tag):
    """Inner HTML of every element of a tag."""
    return F.regexp_extract_all(
        col, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"), F.lit(1))


def page_rows(pages, html="html", row_tag="tr", cell_tag="td", names=RAW_COLUMNS,
              keep=("page_id",)):
    """Rows of a page with exactly ``len(names)`` cells, one column per name.

    ``row_no`` is the position among all rows of the page, kept or not. Cells are text
    without markup, trimmed, and an unrenderable cell becomes ``N/A``.
    """
    rows = pages.select(*keep, F.posexplode(_elements(F.col(html), row_tag))
                        .alias("row_no", "_row"))
    cells = rows.select(*keep, "row_no", F.transform(
        _elements(F.col("_row"), cell_tag),
        lambda cell: mark_missing(plain_text(cell))).alias("_cells"))
    return (cells.filter(F.size("_cells") == len(names))
            .select(*keep, "row_no",
                    *[F.col("_cells")[i].alias(name) for i, name in enumerate(names)]))


def source_urls(series_df, template):
    """One URL per series from a template with one ``%s``."""
    return series_df.select("series").distinct().select(
        "series", F.format_string(template, F.col("series")).alias("url"))
