"""Content-derived surrogate keys as native column expressions.

Both digests are defined over Python text: the identifier over the parts joined
by a bar, the entity hash over the printed form of a list of strings. The printed
form is rebuilt here from built-in functions, so no Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Parts that say nothing about an entity (compared in lower case).
NULL_LIKE = ("", "none", "null", "unknown", "n/a")

#: Source name that takes part in every catalog key.
CATALOG = "catalog"

# Blanks as Python's str.strip() sees them: Unicode white space plus FS..US.
_OUTER_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
# Characters the printed form escapes by code point.
_UNPRINTABLE = r"[[\p{C}\p{Z}]&&[^ ]]"
_NAMED_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))


def surrogate_id(*parts: Column) -> Column:
    """MD5 of all parts joined by ``|``; a null part keeps its place as ``''``."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def entity_hash(*parts: Column) -> Column:
    """MD5 of the printed list of the parts that are not null-like."""
    kept = F.filter(F.array(*[p.cast("string") for p in parts]), _is_meaningful)
    printed = F.transform(kept, printed_text)
    return F.md5(F.concat(F.lit("["), F.array_join(printed, ", "), F.lit("]")))


def customer_id(ref: Column) -> Column:
    """Catalog identifier of a customer reference."""
    return surrogate_id(F.lit(CATALOG), ref, F.lit(None))


def customer_hash(ref: Column) -> Column:
    """Catalog entity hash of a customer reference."""
    return entity_hash(F.lit(CATALOG), ref, F.lit(None))


def _is_meaningful(part: Column) -> Column:
    stripped = F.lower(F.regexp_replace(part, _OUTER_BLANKS, ""))
    return part.isNotNull() & ~stripped.isin(*NULL_LIKE)


def printed_text(text: Column) -> Column:
    """The quoted, escaped form Python prints for a string inside a list."""
    escaped = reduce(
        lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), _NAMED_ESCAPES, text
    )
    escaped = F.when(text.rlike(_UNPRINTABLE), _escape_code_points(escaped)).otherwise(escaped)
    single, double = F.contains(text, F.lit("'")), F.contains(text, F.lit('"'))
    return F.when(single & ~double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def _escape_code_points(text: Column) -> Column:
    def escape(char: Column) -> Column:
        code = F.ascii(char)
        digits = F.lower(F.hex(code))
        numbered = (
            F.when(code < 0x100, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
            .when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
            .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
        )
        return F.when(char.rlike(_UNPRINTABLE), numbered).otherwise(char)

    return F.array_join(F.transform(F.split(text, ""), escape), "")
