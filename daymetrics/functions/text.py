"""Text operators: markup clean-up, message parts, number rendering, templates."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymetrics import constants as K

# The characters that count as blank, Unicode blanks and the four separator
# controls included, as a pattern class and as text.
BLANK = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BLANKS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# What counts as a tag and as the mark of a code fence.
TAG, FENCE = r"<[^>]+>", r"```[a-z]*"

# Pieces per block when a text is cut; keeps the cost of long texts near linear.
_PIECES_PER_BLOCK = 64


def strip_markup(col: Column) -> Column:
    """Remove <tags>, code fences and asterisks, close up blank lines, trim both ends.

    The tag pattern stays linear on hostile text: an unclosed '<' is consumed once, and put
    back through the group.
    """
    col = F.regexp_replace(col, TAG + r"|(<[^>]*\z)", "$1")
    col = F.regexp_replace(col, FENCE, "")
    col = F.replace(col, F.lit("*"), F.lit(""))
    col = F.regexp_replace(col, rf"\n{BLANK}*\n{BLANK}*\n", "\n\n")
    return F.trim(col, F.lit(BLANKS))


def _pieces(col: Column, size: int) -> Column:
    last = F.floor((F.length(col) - 1) / size).cast("int")
    starts = F.when(F.length(col) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(col, i * F.lit(size) + 1, F.lit(size)))


def chunk(df: DataFrame, col: str, size: int = K.MESSAGE_SIZE) -> DataFrame:
    """One row per slice of `size` characters, numbered from 0; an empty or NULL text gives none.

    Substring has to walk to its start, so a long text is first cut into large blocks and
    each block into slices.
    """
    blocks = _pieces(F.col(col), size * _PIECES_PER_BLOCK)
    slices = F.flatten(F.transform(blocks, lambda block: _pieces(block, size)))
    kept = [c for c in df.columns if c != col]
    return df.select(*kept, F.posexplode(slices).alias("chunk_no", "chunk"))


def number_text(x: Column, digits: int = 1) -> Column:
    """A double of up to `digits` decimals as the report prints it: 62.0, 7.25, 20000000.0.

    The cast alone turns to 2.0E7 from ten million on.
    """
    plain = x.cast(f"decimal(38,{digits})").cast("string")
    if digits > 1:
        plain = F.regexp_replace(plain, r"(\.\d+?)0+$", "$1")
    return F.when(F.abs(x) < 1e7, x.cast("string")).otherwise(plain)


def template(pattern: str, values: Mapping[str, Column]) -> Column:
    """Fill a {name} template with columns."""
    parts = re.split(r"\{(\w+)\}", pattern)
    filled = [values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if i % 2 or p]
    return F.concat(*filled)
