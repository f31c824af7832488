"""Text cleaning: formatted numbers, day-first dates, cell placeholders."""

from pyspark.sql import functions as F


def clean_number(col):
    """``"22,600"`` to 22600.0; anything that is not a number to null.

    A trailing letter is refused because the JVM reads ``5d`` as a double.
    """
    col = F.col(col) if isinstance(col, str) else col
    plain = F.replace(col, F.lit(","), F.lit(""))
    return F.when(~plain.rlike("[A-Za-z]\\s*$"), plain.try_cast("double"))


def parse_day(col):
    """Strict day-first date; unpadded parts are fine, impossible days are null."""
    return F.try_to_date(col, "d/M/yyyy")


def parse_day_lenient(col):
    """Day-first where the text allows it, else ISO, as an upload may hold either."""
    return F.coalesce(
        F.try_to_date(col, "d/M/yyyy"),
        F.try_to_date(col, "d-M-yyyy"),
        F.try_to_date(col, "yyyy-M-d"),
    )


def parse_iso(col):
    return F.try_to_date(col, "yyyy-MM-dd")


def iso_text(col):
    return F.date_format(col, "yyyy-MM-dd")


def year_part(col):
    """Year of a ``dd/MM/yyyy`` text, as text."""
    return F.get(F.split(col, "/"), F.lit(2))


def mark_missing(col):
    """Trim, then turn the first run of five hashes into ``N/A``; later ones stay."""
    col = F.col(col) if isinstance(col, str) else col
    text = F.regexp_replace(col, "^\\s+|\\s+$", "")
    return F.regexp_replace(text, "^(?s)(.*?)#####", "$1N/A")


def plain_text(col):
    """Text content of an HTML fragment: no tags, the common entities decoded."""
    text = F.regexp_replace(col, "<[^>]*>", "")
    # fixed values: named entities
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                         ("&nbsp;", " "), ("&amp;", "&")]:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text
