"""Columns on classification code lists."""

from itertools import groupby

from pyspark.sql import functions as F

from foliosift.functions.text import WHITE_SPACE, literal

EMPTY_LIST_TEXT = "[]"


def without_spaces(codes):
    """List column ``codes`` with every space removed from each code."""
    return F.expr(f"transform({codes}, code -> replace(code, ' ', ''))")


def split_codes(text):
    """Comma-joined text to a list of codes without spaces."""
    packed = F.replace(text, F.lit(" "), F.lit(""))
    return F.when(packed == EMPTY_LIST_TEXT, F.array().cast("array<string>")).otherwise(
        F.split(packed, ",")
    )


def joined_codes(codes):
    """List to comma-joined text. An empty list stays apart from a null one."""
    return F.when(F.size(codes) > 0, F.array_join(codes, ",")).otherwise(
        F.when(codes.isNotNull(), F.lit(EMPTY_LIST_TEXT))
    )


def _one_of(value, texts):
    return f"{value} in ({', '.join(map(literal, texts))})"


def _under_prefix(code, prefixes):
    # One hash lookup for each prefix length, whatever the number of prefixes.
    ordered = sorted(set(prefixes), key=lambda prefix: (len(prefix), prefix))
    return [_one_of(f"left({code}, {n})", same) for n, same in groupby(ordered, len)]


def _any_code(codes, tests):
    if not tests:
        return F.lit(False)
    return F.expr(f"coalesce(exists({codes}, code -> coalesce({' or '.join(tests)}, false)), false)")


def any_code_under(codes, prefixes):
    """True where any code of column ``codes`` starts with a prefix; not without codes."""
    return _any_code(codes, _under_prefix(f"ltrim({literal(WHITE_SPACE)}, code)", prefixes))


def any_code_matches(codes, patterns):
    """True where any code equals a pattern, or starts with one that ends in ``*``."""
    packed = {pattern.replace(" ", "") for pattern in patterns}
    exact = sorted(pattern for pattern in packed if not pattern.endswith("*"))
    bare = "replace(code, ' ', '')"
    tests = _under_prefix(bare, [pattern[:-1] for pattern in packed if pattern.endswith("*")])
    return _any_code(codes, [*tests, *([_one_of(bare, exact)] if exact else [])])
