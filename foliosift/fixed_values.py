"""Default lists, limits and markers. Every operator takes them as arguments."""

from datetime import date

# Applications with a code under one of these prefixes are dropped.
EXCLUDED_CODE_PREFIXES = [
    "A",
    "G16H",
    "B60W",
    "G05D",
    "B25J",
    "G06F3",
    "H04N21",
    "G10L",
    "H04N5",
    "H04N23",
    "G06T",
    "G06Q",
]

# Titles holding one of these terms are dropped.
MEDICAL_TITLE_TERMS = [
    "medical",
    "parkinson's",
    "parkinsons",
    "disease",
    "therapy",
    "clinical",
    "alzheimer's",
    "alzheimers",
    "biotech",
]
VEHICLE_TITLE_TERMS = ["autonomous veh"]

# Status descriptions that are dropped, double spaces included.
DROPPED_STATUSES = [
    "Final Rejection Counted, Not Yet Mailed",
    "Final Rejection Mailed",
    "Expressly Abandoned  --  During Examination",
    "Abandoned  --  Failure to Respond to an Office Action",
    "Notice of Appeal Filed",
    "Proceedings Terminated",
    "Abandonment for Failure to Correct Drawings/Oath/NonPub Request",
    "Expressly Abandoned  --  During Publication Process",
    "Abandoned  --  After Examiner's Answer or Board of Appeals Decision",
    "Patent Expired Due to NonPayment of Maintenance Fees Under 37 CFR 1.362",
]

# Filing dates searched, both ends included.
FIRST_FILING_DATE = date(2018, 8, 4)
LAST_FILING_DATE = date(2026, 1, 1)

# Page sizes.
SEARCH_PAGE_SIZE = 100
DETAIL_PAGE_SIZE = 50
PAGES_PER_BUCKET = 100

# Document codes in listing order.
DOCUMENT_TYPES = ["SPEC", "ABST"]

# Text lengths in characters and paragraph count per section.
HEADING_LENGTH = 50
ABSTRACT_LENGTH = 100
FALLBACK_LENGTH = 50
LONG_ENOUGH = 300
PARAGRAPHS_PER_SECTION = 10

# Markers that cut a payload into XML documents.
XML_DECLARATION = '<?xml version="1.0" encoding="utf-8"?>'
DOCUMENT_START = "<uspat:SpecificationDocument"
DOCUMENT_END = "</uspat:SpecificationDocument>"
DOCUMENT_START_WITHIN = 100

# XML namespaces.
COMMON_NAMESPACE = "urn:us:gov:doc:uspto:common"
DOCUMENT_NAMESPACE = "urn:us:gov:doc:uspto:patent"
ID_NAMESPACE = "http://www.wipo.int/standards/XMLSchema/ST96/Common"
