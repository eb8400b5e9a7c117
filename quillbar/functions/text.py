"""Text cleaning and string helpers, all Column to Column and inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The character classes that decide what counts as clean text.
NON_ASCII = r"[^\x00-\x7F]"
LINE_BREAK = r"[\r\n]"
NOT_PRINTABLE_RUN = r"[^\x20-\x7E]+"
STRIPPED = r"(?Us)^[\s\x1C-\x1F]*(.*[^\s\x1C-\x1F])"
BLANKS = "\t\n\x0b\f\r"


def drop_non_ascii(c: Column) -> Column:
    return F.regexp_replace(c, NON_ASCII, "")


def space_non_ascii(c: Column) -> Column:
    return F.regexp_replace(c, NON_ASCII, " ")


def space_line_breaks(c: Column) -> Column:
    """Every CR and every LF becomes one space, so CRLF gives two."""
    return F.regexp_replace(c, LINE_BREAK, " ")


def clean_string(c: Column) -> Column:
    """ASCII only, trimmed, on one line, trimmed again; null becomes the empty string."""
    one_line = space_line_breaks(F.trim(drop_non_ascii(c)))
    return F.coalesce(F.trim(one_line), F.lit(""))


def clean_printable(c: Column) -> Column:
    """Strip the ends first, then delete runs outside printable ASCII. Not stripped again on purpose."""
    stripped = F.regexp_extract(c, STRIPPED, 1)
    return F.coalesce(F.regexp_replace(stripped, NOT_PRINTABLE_RUN, ""), F.lit(""))


def words(c: Column) -> Column:
    """The blank-separated words of a text. Splitting at one plain character is several times faster than at a pattern."""
    for blank in BLANKS:
        c = F.replace(c, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(c, " ", -1), "")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def clean_all_strings(df: DataFrame, clean=clean_string) -> DataFrame:
    """Apply ``clean`` to every string column in one projection; other types pass through."""
    texts = set(string_columns(df))
    return df.select(
        *[
            (clean(quoted(name)) if name in texts else quoted(name)).alias(name)
            for name in df.columns
        ]
    )


def fill_empty(df: DataFrame) -> DataFrame:
    """Null to the empty string, string columns only."""
    return df.na.fill("")


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def is_palindrome(c: Column) -> Column:
    """Compare letters and digits only, ignoring case."""
    kept = F.lower(F.regexp_replace(c, "[^A-Za-z0-9]", ""))
    return kept == F.reverse(kept)


def capitalize_words(c: Column) -> Column:
    """Upper-case the first character of each space-separated word and leave the rest as it is."""
    return F.array_join(
        F.transform(F.split(c, " ", -1), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))),
        " ",
    )


def shout(c: Column) -> Column:
    return F.upper(F.trim(c))


def drop_quotes(c: Column) -> Column:
    return F.replace(c, F.lit("'"), F.lit(""))


def spell_ampersand(c: Column) -> Column:
    return F.replace(c, F.lit("&"), F.lit("and"))
