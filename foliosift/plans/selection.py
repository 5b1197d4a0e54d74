"""Choose applications: search by code and date, then drop what is not wanted."""

from functools import reduce

from foliosift import fixed_values as V
from foliosift.operators.select import (
    filed_between,
    normalised,
    with_codes_matching,
    without_codes_under,
    without_statuses,
    without_title_terms,
)


def searched(
    apps,
    patterns=None,
    default=None,
    first=V.FIRST_FILING_DATE,
    last=V.LAST_FILING_DATE,
):
    """Applications filed in the range that carry a code matching a pattern.

    The date range comes first, so it reaches the scan of a stored table.
    """
    return with_codes_matching(filed_between(apps, first, last), patterns, default)


def selected(
    apps,
    prefixes=V.EXCLUDED_CODE_PREFIXES,
    title_terms=(V.MEDICAL_TITLE_TERMS, V.VEHICLE_TITLE_TERMS),
    statuses=V.DROPPED_STATUSES,
):
    """All exclusions on normalised rows, in one stage without shuffle."""
    kept = without_codes_under(normalised(apps), prefixes)
    kept = reduce(without_title_terms, title_terms, kept)
    return without_statuses(kept, statuses)
