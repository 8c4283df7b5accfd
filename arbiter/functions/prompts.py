"""Prompt template rendering: ``{{var}}`` placeholders filled from a map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arbiter.functions.text import col

PLACEHOLDER = r"\{\{[A-Za-z_][A-Za-z0-9_]*\}\}"


def render(template, variables) -> Column:
    """Fill every ``{{key}}`` of the template from the variable map, in one
    pass: the template is split at its placeholders and joined with the
    values, so braces inside a value are plain text.  A name without a value
    stays as it is, and so do single braces."""
    literals = F.split(col(template), PLACEHOLDER, -1)
    names = F.regexp_extract_all(col(template), F.lit(r"\{\{([A-Za-z_][A-Za-z0-9_]*)\}\}"))
    filled = F.transform(names, lambda name, i: F.concat(
        F.coalesce(F.try_element_at(col(variables), name), F.concat(F.lit("{{"), name, F.lit("}}"))),
        F.get(literals, i + 1)))
    return F.concat(F.get(literals, F.lit(0)), F.array_join(filled, ""))


def unresolved(rendered) -> Column:
    """True when a ``{{name}}`` placeholder is still present."""
    return col(rendered).rlike(PLACEHOLDER)
