"""Keyword router for free-text questions (G1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeris.constants import DATA_DEPENDENT_INTENTS, INTENT_RULES
from aeris.functions._util import ident, sql_literal


def question_intent(text: str, has_index: bool | Column = True) -> Column:
    """G1 over a column: first matching keyword rule over the lower-cased text, NULL when none matches.

    ``has_index``: whether any station has an index; the ``best`` and ``pollutant``
    answers need one and otherwise fall through to the next rule."""
    available = has_index if isinstance(has_index, Column) else F.lit(bool(has_index))
    q = f"lower(coalesce({ident(text)}, ''))"

    def any_of(words: tuple[str, ...]) -> str:
        return "(" + " OR ".join(f"contains({q}, {sql_literal(w)})" for w in words) + ")"

    intent = F.lit(None).cast("string")
    for name, words, also in reversed(INTENT_RULES):
        found = F.expr(any_of(words) + (f" AND {any_of(also)}" if also else ""))
        if name in DATA_DEPENDENT_INTENTS:
            found = found & available
        intent = F.when(found, F.lit(name)).otherwise(intent)
    return intent
