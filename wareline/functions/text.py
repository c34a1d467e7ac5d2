"""Text expressions. Everything stays in the JVM except accent folding."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# The characters str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# A word character, and the two contact patterns built on it.
WORD = r"\p{L}\p{N}_"
# A match may only begin where a run of address characters begins (or where
# the previous match ended), so a long run without "@" is scanned once.
EMAIL = (
    rf"(?:\G|(?<![{WORD}.+-]))[{WORD}.+-]++@[{WORD}.-]+\.[A-Za-z]{{2,}}"
)
PHONE = rf"(?<![{WORD}])\+?\p{{Nd}}[\p{{Nd}} ()-]{{7,}}\p{{Nd}}(?![{WORD}])"
EMAIL_TOKEN = "[email removed]"
PHONE_TOKEN = "[phone removed]"
# Cells a CSV reader treats as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# English words that carry no topic.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves "
    "he him his himself she her hers herself it its itself they them their "
    "theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the "
    "and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in "
    "out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don should now cannot could "
    "ought would"
).split()
FORMULA_START = r"^[=+@-]"


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace of every kind."""
    return F.btrim(col, F.lit(WHITESPACE))


def collapse(col: Column) -> Column:
    """Every run of whitespace becomes one space."""
    return F.regexp_replace(col, f"[{WHITESPACE}]+", " ")


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def missing_to_null(col: Column) -> Column:
    """Map the CSV spellings of a missing cell to NULL."""
    return F.when(~col.isin(MISSING_TOKENS), col)


def redact(col: Column) -> Column:
    """Mask addresses first, phone numbers second; NULL becomes empty."""
    text = F.coalesce(col, F.lit(""))
    masked = F.when(
        F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL, EMAIL_TOKEN)
    ).otherwise(text)
    return F.regexp_replace(masked, PHONE, PHONE_TOKEN)


def first_segment(col: Column) -> Column:
    """The part of a category path before its first pipe."""
    return F.substring_index(col, "|", 1)


def view_category(col: Column) -> Column:
    """Main category of the analytics view: the first segment as it stands."""
    blank = col.isNull() | (F.trim(col) == "")
    return F.when(blank, F.lit("Uncategorized")).otherwise(first_segment(col))


def public_category(redacted: Column) -> Column:
    """Main category of the public snapshot: trimmed, never empty."""
    segment = strip(first_segment(redacted))
    return F.coalesce(blank_to_null(segment), F.lit("Uncategorized"))


def training_label(col: Column) -> Column:
    """Training label: trimmed first segment, empty becomes NULL."""
    return blank_to_null(strip(first_segment(strip(col))))


def casefold(col: Column) -> Column:
    """Caseless form: lower case by way of upper case, with ß as ss and one
    form of sigma."""
    folded = F.translate(F.lower(F.upper(col)), "ςẞ", "σß")
    return F.replace(folded, F.lit("ß"), F.lit("ss"))


def name_key(col: Column) -> Column:
    """Key under which two titles count as the same."""
    return collapse(casefold(col))


def query_tokens(col: Column) -> Column:
    """Tokens of a query that may name a product."""
    return F.regexp_extract_all(casefold(col), F.lit(rf"([{WORD}-]+)"), 1)


def words(folded: Column) -> Column:
    """Word tokens of two or more characters."""
    return F.regexp_extract_all(folded, F.lit(rf"([{WORD}]{{2,}})"), 1)


@F.pandas_udf(T.StringType())
def _without_marks(texts: pd.Series) -> pd.Series:
    def fold(text):
        if text is None or text.isascii():
            return text
        text = unicodedata.normalize("NFKD", text)
        for mark in set(text):
            if unicodedata.combining(mark):
                text = text.replace(mark, "")
        return text

    return texts.map(fold, na_action="ignore")


def fold_accents(col: Column) -> Column:
    """Lower-case and drop combining marks. Spark has no NFKD, hence Arrow."""
    return _without_marks(F.lower(col))


def document_text(*cols: Column) -> Column:
    """Join the searchable fields, missing ones as empty text."""
    return F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in cols])


def spreadsheet_safe(col: Column) -> Column:
    """Quote text that a spreadsheet would run as a formula."""
    risky = F.ltrim(col, F.lit(WHITESPACE)).rlike(FORMULA_START)
    return F.when(risky, F.concat(F.lit("'"), col)).otherwise(col)


def fact_line() -> Column:
    """One sentence of stored facts about a public product row."""
    price = F.when(F.col("discounted_price").isNull(), F.lit("unknown")).otherwise(
        F.format_string("INR %.2f", F.col("discounted_price"))
    )
    rating = F.coalesce(F.col("rating").cast("string"), F.lit("unknown"))
    stock = (
        F.when(F.col("stock_quantity").isNull(), F.lit("unknown"))
        .when(F.col("stock_quantity") == 0, F.lit("out of stock"))
        .otherwise(F.concat(F.col("stock_quantity").cast("string"), F.lit(" units")))
    )
    return F.concat(
        F.lit("["), F.col("product_id"), F.lit("] "), F.col("product_name"),
        F.lit(": price "), price, F.lit("; rating "), rating,
        F.lit("; stock "), stock, F.lit("."),
    )
