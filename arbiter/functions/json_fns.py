"""JSON-valued scorers and parsers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arbiter import defaults as D
from arbiter.functions.text import col


def is_json(text) -> Column:
    """True iff the whole text is one JSON document; NULL is not.

    The JVM parser stops after the first document, so the text is parsed as
    an element and as a member: text after the document, or a list of
    documents, fails one of the two."""
    t = col(text)
    as_item = F.try_parse_json(F.concat(F.lit("["), t, F.lit("]")))
    as_member = F.try_parse_json(F.concat(F.lit('{"v":'), t, F.lit("}")))
    return as_item.isNotNull() & as_member.isNotNull()


def strict_json(text) -> Column:
    """The text where it is one JSON document, else NULL."""
    return F.when(is_json(text), col(text))


def min_items(text, field: str = "skills", bound: int = D.MIN_SKILLS) -> Column:
    """JSON field present as a list with more than ``bound`` items (strict >);
    anything unparsable is False."""
    parsed = F.from_json(strict_json(text), f"`{field}` ARRAY<STRING>")
    return F.coalesce(F.size(parsed[field]) > F.lit(bound), F.lit(False))


def tool_args(arguments) -> Column:
    """Tool arguments as map<string,string>; malformed JSON -> empty map."""
    parsed = F.from_json(strict_json(arguments), "MAP<STRING,STRING>")
    return F.coalesce(parsed, F.create_map().cast("map<string,string>"))


def tool_name(name) -> Column:
    """Catalog function name: double underscores become dots."""
    return F.replace(col(name), F.lit("__"), F.lit("."))


def numeric_or_null(value) -> Column:
    return F.expr(f"try_cast({value} AS DOUBLE)") if isinstance(value, str) else \
        value.try_cast("double")
