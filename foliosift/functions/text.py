"""SQL texts and columns on text.

Rules on array elements are written as SQL texts: a lambda built call by call costs a
round trip to the JVM for each of its parts.
"""

from pyspark.sql import functions as F

# The code points that count as white space when text is stripped.
WHITE_SPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ],
    )
)


def literal(text):
    """``text`` as a SQL string literal."""
    escaped = (c if c.isalnum() or c in " .,;:/*-_<>=" else f"\\U{ord(c):08X}" for c in text)
    return "'" + "".join(escaped) + "'"


def stripped(text):
    """SQL: ``text`` without white space at either end; plain trim takes only spaces.

    Most text has none there, which the first and last character tell at little cost.
    """
    space = literal(WHITE_SPACE)
    edges = f"concat(left({text}, 1), right({text}, 1))"
    return f"if(translate({edges}, {space}, '') <> {edges}, btrim({text}, {space}), {text})"


def holds_any_term(text, terms):
    """True where column ``text`` holds one of ``terms`` in any letter case; not for null."""
    if not terms:
        return F.lit(False)
    quoted = ("\\Q" + term.replace("\\E", "\\E\\\\E\\Q") + "\\E" for term in terms)
    return F.coalesce(text.rlike("(?iu)" + "|".join(quoted)), F.lit(False))
