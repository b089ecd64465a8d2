"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the tokenizer splits lower-cased text on runs of non-word
# characters (ASCII ``\W``, as in Java regex and RE2).
NON_WORD = r"\W+"


def tokens(text: Column | str) -> Column:
    """Array of lower-case tokens of the whole text; empty tokens removed."""
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(t), NON_WORD), lambda w: w != F.lit(""))
