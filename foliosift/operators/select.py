"""Filters on application rows."""

from pyspark.sql import functions as F

from foliosift import fixed_values as V
from foliosift.functions.codes import any_code_matches, any_code_under, without_spaces
from foliosift.functions.text import holds_any_term
from foliosift.session import written


def normalised(apps):
    """Codes without spaces, titles in lower case."""
    return apps.withColumns(
        {
            "cpcs": without_spaces("cpcs"),
            "invention_title": F.lower("invention_title"),
        }
    )


def filed_between(apps, first=V.FIRST_FILING_DATE, last=V.LAST_FILING_DATE):
    """Applications filed from ``first`` to ``last``, both included."""
    return apps.filter(F.col("filing_date").between(F.lit(first), F.lit(last)))


def without_codes_under(apps, prefixes=V.EXCLUDED_CODE_PREFIXES):
    """Drop applications with any code under a prefix; those without codes stay."""
    return apps.filter(~any_code_under("cpcs", prefixes))


def without_title_terms(apps, terms=V.MEDICAL_TITLE_TERMS):
    """Drop applications whose title holds a term; those without title stay."""
    return apps.filter(~holds_any_term(F.col("invention_title"), terms))


def without_statuses(apps, statuses=V.DROPPED_STATUSES):
    """Drop applications with one of these status descriptions; null stays."""
    listed = F.coalesce(F.col("status_desc").isin(list(statuses)), F.lit(False))
    return apps.filter(~listed)


def with_codes_matching(apps, patterns=None, default=None):
    """Keep applications with a code that matches a pattern, row by row.

    A pattern is a code, or a prefix when it ends in ``*``. ``patterns`` is a list or a
    one-column table; null or an empty one means ``default``. A list becomes a predicate on
    the row, without shuffle. A table of any length is joined by code list, see
    ``matching_lists``; then ``apps`` is read twice and should be a stored table. Both look
    at nothing but the codes of the row, so repeated and null application numbers are kept
    or dropped one by one.
    """
    if _nothing(patterns):
        patterns = default
    if _nothing(patterns):
        raise ValueError("give patterns or a default list of patterns")
    if isinstance(patterns, (list, tuple)):
        return apps.filter(any_code_matches("cpcs", patterns))
    return _by_list(apps, patterns, "left_semi")


def without_codes_matching(apps, patterns):
    """Drop applications with a code that matches a pattern; a list or a table."""
    if isinstance(patterns, (list, tuple)):
        return apps.filter(~any_code_matches("cpcs", patterns))
    return _by_list(apps, patterns, "left_anti")


def _nothing(patterns):
    if patterns is None or isinstance(patterns, (list, tuple)):
        return not patterns
    return _pattern_rows(patterns).isEmpty()


def _by_list(apps, patterns, how):
    lists = matching_lists(apps, patterns).withColumnRenamed("codes", "_codes")
    return apps.join(lists, code_list("cpcs") == F.col("_codes"), how)


def code_list(codes):
    """A code list as a sorted set without spaces: the same for lists that match alike."""
    return F.array_sort(F.array_distinct(without_spaces(codes)))


def _pattern_rows(patterns):
    """(text, is_prefix) of a one-column table of patterns, without spaces and the ``*``."""
    text = F.replace(F.col(patterns.columns[0]), F.lit(" "), F.lit(""))
    rows = patterns.select(text.alias("pattern")).filter("pattern <> ''")
    is_prefix = F.endswith(F.col("pattern"), F.lit("*"))
    bare = F.expr("left(pattern, length(pattern) - 1)")
    return rows.select(
        F.when(is_prefix, bare).otherwise(F.col("pattern")).alias("text"), is_prefix.alias("is_prefix")
    ).distinct()


def _beginnings(text, last):
    """All beginnings of ``text``, the empty one included, up to ``last`` characters."""
    return F.expr(f"explode(transform(sequence(0, {last}), n -> left({text}, n)))")


def disjoint_patterns(patterns):
    """Patterns without those that a shorter prefix covers: (text, is_prefix).

    A prefix stands for the interval of all codes that begin with it, and two intervals are
    either disjoint or one holds the other. With the inner ones merged away no code is in
    more than one. A pattern is covered if one of its own beginnings is a prefix, so the
    merge is an equality join, whatever the number of patterns.
    """
    rows = written(_pattern_rows(patterns), "patterns")
    prefixes = rows.filter("is_prefix").select(F.col("text").alias("begin"))
    beginnings = rows.filter("length(text) > 0 or not is_prefix").select(
        "text", "is_prefix", _beginnings("text", "length(text) - int(is_prefix)").alias("begin")
    )
    covered = beginnings.join(prefixes, "begin", "left_semi").select("text", "is_prefix").distinct()
    return rows.join(covered, ["text", "is_prefix"], "left_anti")


def matching_lists(apps, patterns):
    """The distinct normalised code lists in ``apps`` that match a table of patterns: (codes).

    Applications are many, their code lists fewer, and codes fewer still. Each distinct code
    is looked up once: its beginnings meet the disjoint intervals of the patterns by equality,
    and a code is in one of them at most. What matches goes back to the lists and, by the
    caller, from the lists to the rows. Lists and codes are stored, so that AQE splits a code
    that very many lists hold.
    """
    lists = apps.select(code_list("cpcs").alias("codes")).filter(F.size("codes") > 0)
    lists = written(lists.distinct(), "lists")
    held = lists.select("codes", F.explode("codes").alias("code")).filter("code is not null")
    codes = written(held.select("code").distinct(), "codes")
    wanted = written(disjoint_patterns(patterns), "intervals")
    begun = codes.select("code", _beginnings("code", "length(code)").alias("text"))
    hits = begun.join(wanted, "text").filter("is_prefix or text = code").select("code")
    found = held.join(written(hits, "hits"), "code", "left_semi")
    return written(found.select("codes").distinct(), "matching")
