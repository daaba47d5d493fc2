"""Text cleaning with Unicode-aware whitespace rules."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The 29 code points that a Unicode-aware strip removes.
# Spark's plain trim() removes only U+0020.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# End-of-text markers of other tokenizers, in removal order.
END_TOKENS = ("<EOS_TOKEN>", "</s>", "<eos>", "<|endoftext|>", "<|eot_id|>")

# Dedup key width, longest code sent to a prompt, label width.
DEDUP_PREFIX = 100
MAX_CODE_CHARS = 3000
TRUNCATION_MARK = "\n# ... (truncated)"
LABEL_CHARS = 60


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns whose values are costly, like ``withColumns``.

    Catalyst copies a projected expression into every conjunct of a filter
    above it and computes it again afterwards. A generated column stays where
    it is: one struct per row is generated here, so each value is computed
    once, and filters on it stay above it.
    """
    kept = [c for c in df.columns if c not in columns]
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(values)))


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace, Unicode-aware."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return strip(c) == ""


def or_empty(c: Column) -> Column:
    """Stringify; null becomes the empty string."""
    return F.coalesce(c.cast("string"), F.lit(""))


def remove_end_tokens(c: Column) -> Column:
    """Remove the end markers one after another.

    The order matters: taking ``</s>`` out of ``<e</s>os>`` leaves ``<eos>``,
    which the next step then removes. One alternation regex would not. Only a
    text that holds some marker is rewritten; looking is the faster part.
    """
    without = reduce(lambda text, token: F.replace(text, F.lit(token), F.lit("")), END_TOKENS, c)
    present = reduce(or_, [c.contains(token) for token in END_TOKENS])
    return F.when(present, without).otherwise(c)


def clean_text(c: Column) -> Column:
    return strip(remove_end_tokens(c))


def dedup_key(instruction: Column) -> Column:
    """Case-folded start of the instruction; two rows with one key are copies."""
    return F.lower(strip(F.substring(instruction, 1, DEDUP_PREFIX)))


def truncate_code(c: Column) -> Column:
    """Cut code beyond the prompt limit and say so in a trailing comment."""
    return F.when(
        F.length(c) > MAX_CODE_CHARS,
        F.concat(F.substring(c, 1, MAX_CODE_CHARS), F.lit(TRUNCATION_MARK)),
    ).otherwise(c)


def short_label(c: Column) -> Column:
    """First characters of a text for a caption, with an ellipsis if cut."""
    return F.concat(
        F.substring(c, 1, LABEL_CHARS),
        F.when(F.length(c) > LABEL_CHARS, F.lit("...")).otherwise(F.lit("")),
    )
