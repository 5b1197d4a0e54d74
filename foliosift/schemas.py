"""Schemas of everything that is read or written."""

from pyspark.sql import types as T

APPLICATION_COLUMNS = [
    "application_number",
    "patent_number",
    "cpcs",
    "filing_date",
    "invention_title",
    "grant_date",
    "status_code",
    "status_desc",
]

APPLICATIONS = T.StructType(
    [
        T.StructField("application_number", T.StringType()),
        T.StructField("patent_number", T.StringType()),
        T.StructField("cpcs", T.ArrayType(T.StringType())),
        T.StructField("filing_date", T.DateType()),
        T.StructField("invention_title", T.StringType()),
        T.StructField("grant_date", T.DateType()),
        T.StructField("status_code", T.StringType()),
        T.StructField("status_desc", T.StringType()),
    ]
)

_RECORD_FIELDS = [
    T.StructField("applicationNumberText", T.StringType()),
    T.StructField("patentNumber", T.StringType()),
    T.StructField("cpcClassificationBag", T.ArrayType(T.StringType())),
    T.StructField("filingDate", T.StringType()),
    T.StructField("inventionTitle", T.StringType()),
    T.StructField("grantDate", T.StringType()),
    T.StructField("applicationStatusCode", T.StringType()),
    T.StructField("applicationStatusDescriptionText", T.StringType()),
    T.StructField("applicationTypeLabelName", T.StringType()),
]

# A field may sit on the record or in its metadata, so both levels list all of them.
RAW_RECORD = T.StructType(
    [*_RECORD_FIELDS, T.StructField("applicationMetaData", T.StructType(_RECORD_FIELDS))]
)

SEARCH_RESPONSE = T.StructType(
    [T.StructField("patentFileWrapperDataBag", T.ArrayType(RAW_RECORD))]
)

DOCUMENT_LISTING = T.StructType(
    [
        T.StructField("application_number", T.StringType()),
        T.StructField(
            "documentBag",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("documentCode", T.StringType()),
                        T.StructField(
                            "downloadOptionBag",
                            T.ArrayType(
                                T.StructType(
                                    [
                                        T.StructField("downloadUrl", T.StringType()),
                                        T.StructField("mimeTypeIdentifier", T.StringType()),
                                    ]
                                )
                            ),
                        ),
                    ]
                )
            ),
        ),
    ]
)

PAYLOADS = T.StructType(
    [T.StructField("url", T.StringType()), T.StructField("content", T.BinaryType())]
)

# One element of an XML document. ``text`` is what stands before the first child,
# ``tails`` what stands after each child, ``full_text`` everything inside a heading.
NODES = T.ArrayType(
    T.StructType(
        [
            T.StructField("pos", T.IntegerType()),
            T.StructField("root_child", T.BooleanType()),
            T.StructField("tag", T.StringType()),
            T.StructField("node_id", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("tails", T.ArrayType(T.StringType())),
            T.StructField("full_text", T.StringType()),
        ]
    )
)

PARSED_XML = T.StructType([T.StructField("error", T.StringType()), T.StructField("nodes", NODES)])
