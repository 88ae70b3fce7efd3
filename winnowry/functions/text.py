"""String, array and JSON helpers as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: patterns ---------------------------------------------------
FENCE = "```"
FENCED_BLOCK = r"(?s)```\w*\n?(.*?)```"
FENCE_MARK = r"```\w*"
JSON_ARRAY = r"(?s)\[.*\]"
CLASSES_SECTION = r"(?si)##\s*Classes(.*?)(##|\z)"
BOLD_NAME = r"\*\*([^*]+)\*\*"
TOKEN = r"[\p{L}\p{N}_]{2,}"
# ------------------------------------------------------------------------------

EDGE_SPACE = r"^\s+|\s+$"


def strip(c: Column) -> Column:
    """Trim every kind of white space at both ends."""
    return F.regexp_replace(c, EDGE_SPACE, "")


def norm_label(c: Column, lower: bool = False) -> Column:
    """Label as text: trimmed, ``1.0`` written as ``1``; NULL stays NULL."""
    text = strip(c.cast("string"))
    if lower:
        text = F.lower(text)
    return F.regexp_replace(text, r"\.0$", "")


def slug(c: Column) -> Column:
    """File-name form of a topic or dataset name."""
    return F.translate(F.lower(F.trim(c)), " /:", "___")


def strip_fences(c: Column) -> Column:
    """Body of the first Markdown code block; text without fences is unchanged."""
    return (
        F.when(~F.contains(c, F.lit(FENCE)), c)
        .when(c.rlike(FENCED_BLOCK), strip(F.regexp_extract(c, FENCED_BLOCK, 1)))
        .otherwise(strip(F.regexp_replace(c, FENCE_MARK, "")))
    )


def json_array_slice(c: Column) -> Column:
    """Text from the first ``[`` to the last ``]``, NULL if there is no such pair."""
    return F.nullif(F.regexp_extract(c, JSON_ARRAY, 0), F.lit(""))


def truncate(c: Column, chars: int | None = None) -> Column:
    """The first ``chars`` characters; everything by default."""
    return c if chars is None else F.substring(c, 1, chars)


def spec_classes(c: Column) -> Column:
    """Bold names in the ``## Classes`` section of a Markdown spec, NULL if none."""
    names = F.regexp_extract_all(
        F.regexp_extract(c, CLASSES_SECTION, 1), F.lit(BOLD_NAME), F.lit(1)
    )
    return F.when(F.size(names) > 0, names)


def tokens(c: Column) -> Column:
    """Lower-case word tokens of at least two characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def ngrams(words: Column) -> Column:
    """Unigrams and bigrams of a token array.

    The array is read several times: pass a column, not the ``tokens`` expression.
    """
    rest = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(words, F.lit(1), rest), F.slice(words, F.lit(2), rest),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.concat(words, pairs)


def size_in_megabytes(size: Column) -> Column:
    """Bytes as ``"n MB"`` with n the whole number of 10^6 bytes."""
    return F.concat((F.floor(size / F.lit(1_000_000))).cast("bigint").cast("string"), F.lit(" MB"))


def size_on_disk(size: Column) -> Column:
    """Bytes as ``"x.x MB"`` below a GiB, ``"x.xx GB"`` from there, NULL for nothing.

    Halves go to the even digit, as C and Python print them; Java's own printing rounds them up.
    """
    mebi = size / F.lit(1024.0 * 1024.0)
    return (
        F.when((mebi > 0) & (mebi < 1024), F.format_string("%.1f MB", F.bround(mebi, 1)))
        .when(mebi >= 1024, F.format_string("%.2f GB", F.bround(mebi / 1024, 2)))
    )


def tag_value(tags: Column, prefix: str, anywhere: bool = False) -> Column:
    """First tag carrying ``prefix`` with the prefix removed, NULL if none."""
    has = (lambda t: F.contains(t, F.lit(prefix))) if anywhere else (
        lambda t: F.startswith(t, F.lit(prefix))
    )
    return F.replace(F.try_element_at(F.filter(tags, has), F.lit(1)), F.lit(prefix), F.lit(""))


def json_path(c: Column, path: str) -> Column:
    """Value under a dot path of a JSON text, the whole text for an empty path."""
    return F.get_json_object(c, "$." + path) if path else c


def pct_change(before: Column, after: Column) -> Column:
    """Relative change as ``+x.x%``, ``n/a`` from zero."""
    return F.when(before == 0, F.lit("n/a")).otherwise(
        F.format_string("%+.1f%%", (after - before) / before * 100)
    )
