"""Document listings to document references."""

from pyspark.sql import functions as F

from foliosift import fixed_values as V

# Positions of one document type stay below this; types follow each other.
TYPE_STRIDE = 2**31


def listed_documents(listings, types=V.DOCUMENT_TYPES):
    """One row for each download option of each listed document of a wanted type.

    Columns: application_number, doc_type, seq, url, mime. ``seq`` orders the options
    of an application: all of the first type, then all of the next, each in listing
    order.
    """
    empty = F.array()
    rows = listings
    for number, code in enumerate(types):
        documents = F.filter(
            F.coalesce(F.col("documentBag"), empty), lambda d: d["documentCode"] == code
        )
        options = F.flatten(
            F.transform(documents, lambda d: F.coalesce(d["downloadOptionBag"], empty))
        )
        tagged = F.transform(
            options,
            lambda option, at: F.struct(
                F.lit(code).alias("doc_type"),
                (F.lit(number * TYPE_STRIDE) + at).cast("bigint").alias("seq"),
                option["downloadUrl"].alias("url"),
                option["mimeTypeIdentifier"].alias("mime"),
            ),
        )
        rows = rows.withColumn(f"_options_{number}", tagged)
    every = F.concat(*(F.col(f"_options_{n}") for n in range(len(types))))
    return rows.select("application_number", F.inline(every))


def xml_references(documents, mime="XML"):
    """Distinct URLs of an application: first position, type of the last position.

    Documents of no application are left out; they belong to no row of the result.
    """
    return (
        documents.filter((F.col("mime") == mime) & F.col("application_number").isNotNull())
        .groupBy("application_number", "url")
        .agg(
            F.min("seq").alias("seq"),
            F.max_by("doc_type", F.struct("seq", "doc_type")).alias("doc_type"),
        )
    )
