"""Inputs of the catalogue queries, derived from the given tables.

Orders stand for applications and the brands of their parts for codes; lines of
documents stand for the elements of an XML document; conversations for the documents
of an application.
"""

from pyspark.sql import functions as F

from foliosift import fixed_values as V
from foliosift.functions.nodes import HEADING, PARAGRAPH
from foliosift.functions.text import literal
from foliosift.session import spread


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def apps(spark, folder, orders=None):
    """Application rows; codes come as a sorted set, at most one for each brand."""
    orders = table(spark, folder, "orders") if orders is None else orders
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_name")
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    items = spread(items, "l_orderkey")
    codes = (
        items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(
            F.array_sort(F.collect_set("p_brand")).alias("cpcs"),
            F.min("p_name").alias("invention_title"),
        )
    )
    return orders.join(codes, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").cast("string").alias("application_number"),
        F.col("o_orderdate").cast("date").alias("filing_date"),
        "cpcs",
        "invention_title",
        F.col("o_orderstatus").alias("status_code"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("status_desc"),
    )


def printable(rows):
    """Code lists as text and dates as text, so that values compare across engines."""
    changed = {}
    if "cpcs" in rows.columns:
        changed["cpcs"] = F.array_join("cpcs", ",")
    if "filing_date" in rows.columns:
        changed["filing_date"] = F.col("filing_date").cast("string")
    return rows.withColumns(changed)


def documents(spark, folder, *columns):
    return spread(table(spark, folder, "documents").select("doc_id", *columns), "doc_id")


LINES = r"split(text, '\n')"


def line_nodes(spark, folder):
    """One row (doc_id, nodes) for each document: its lines as elements of a list."""
    # Fields in the order of the node schema.
    node = f"""named_struct('pos', at, 'root_child', true,
        'tag', if(length(line) < {V.HEADING_LENGTH}, '{HEADING}', '{PARAGRAPH}'),
        'node_id', concat('n-', at), 'text', line,
        'tails', cast(array() as array<string>), 'full_text', line)"""
    rows = documents(spark, folder, "text")
    return rows.selectExpr("doc_id", f"transform({LINES}, (line, at) -> {node}) as nodes")


def line_listings(spark, folder):
    """Each document as a listing: every line is a listed document with two options."""
    document = f"""named_struct(
        'documentCode', case when length(line) < {V.HEADING_LENGTH} then 'ABST'
                             when contains(line, '?') then 'CLM' else 'SPEC' end,
        'downloadOptionBag', array(
            named_struct('downloadUrl', line,
                         'mimeTypeIdentifier', if(contains(line, ','), 'XML', 'PDF')),
            named_struct('downloadUrl', lower(line), 'mimeTypeIdentifier', 'XML')))"""
    return documents(spark, folder, "text").selectExpr(
        "cast(doc_id as string) as application_number",
        f"transform({LINES}, line -> {document}) as documentBag",
    )


def xml_payloads(spark, folder):
    """Each document as payload bytes: one specification between a preface and a decoy.

    A line is an element with an id. What a heading is for stands in a nested element,
    so that the leading text of every element is exactly its line.
    """
    escaped = "replace(replace(replace(line, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    tag = f"if(length(line) < {V.HEADING_LENGTH}, 'uscom:Heading', 'uscom:P')"
    purpose = (
        "case when contains(upper(line), 'TH') then 'abstract and summary' "
        "when contains(upper(line), 'AN') then 'background' else 'note' end"
    )
    element = (
        f"concat('<', {tag}, ' com:id=\"n-', at, '\">', {escaped}, "
        f"'<uscom:I>', {purpose}, '</uscom:I></', {tag}, '>')"
    )
    opening = (
        "preface" + V.XML_DECLARATION + V.DOCUMENT_START
        + f' xmlns:uspat="{V.DOCUMENT_NAMESPACE}" xmlns:uscom="{V.COMMON_NAMESPACE}"'
        + f' xmlns:com="{V.ID_NAMESPACE}"><uscom:DocumentCode>'
    )
    decoy = V.XML_DECLARATION + f'<uspat:ClaimSet xmlns:uspat="{V.DOCUMENT_NAMESPACE}"/>'
    text = (
        f"concat({literal(opening)}, lang, '</uscom:DocumentCode>', "
        f"array_join(transform({LINES}, (line, at) -> {element}), ''), "
        f"{literal(V.DOCUMENT_END + decoy)})"
    )
    return documents(spark, folder, "text", "lang").selectExpr(
        "cast(doc_id as string) as url", f"encode({text}, 'UTF-8') as content"
    )


def document_references(spark, folder):
    """Every document as a reference of the application named by its source."""
    return table(spark, folder, "documents").select(
        F.col("source").alias("application_number"),
        F.col("doc_id").cast("string").alias("url"),
        F.col("doc_id").alias("seq"),
        F.when(F.col("lang") == "en", F.lit("SPEC")).otherwise(F.lit("ABST")).alias("doc_type"),
    )


def parts_of_doc(spark, folder):
    """Turns of a conversation as the documents of an application."""
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("application_number"),
        F.col("turn").alias("seq"),
        F.col("role").alias("doc_type"),
        "text",
    )


# Documents of an application, in the queries that go from listings to texts.
DOCUMENTS_EACH = 4


def document_applications(spark, folder):
    """Every few documents as an application."""
    rows = table(spark, folder, "documents").select("doc_id", "lang")
    number = F.expr(f"cast(doc_id div {DOCUMENTS_EACH} as string)").alias("application_number")
    return rows.groupBy(number).agg(F.min("lang").alias("lang"))


def document_listings(spark, folder):
    """The listing of each application but every fifth, which has none."""
    rows = table(spark, folder, "documents").select("doc_id", "lang")
    option = F.struct(
        F.col("doc_id").cast("string").alias("downloadUrl"), F.lit("XML").alias("mimeTypeIdentifier")
    )
    document = F.struct(
        "doc_id",
        F.when(F.col("lang") == "en", F.lit("SPEC")).otherwise(F.lit("ABST")).alias("documentCode"),
        F.array(option).alias("downloadOptionBag"),
    )
    number = F.expr(f"doc_id div {DOCUMENTS_EACH}").alias("number")
    bags = rows.groupBy(number).agg(F.sort_array(F.collect_list(document)).alias("bag"))
    return bags.filter("number % 5 <> 2").selectExpr(
        "cast(number as string) as application_number",
        "transform(bag, d -> named_struct('documentCode', d.documentCode, "
        "'downloadOptionBag', d.downloadOptionBag)) as documentBag",
    )


def damaged_payloads(spark, folder):
    """Payloads of which some have not landed, lack an end tag or declare a document type."""
    rows = xml_payloads(spark, folder).selectExpr(
        "url", "cast(url as bigint) as n", "decode(content, 'UTF-8') as text"
    )
    opened = F.when(F.expr("n % 11 = 5"), F.replace(F.col("text"), F.lit("</uscom:DocumentCode>"), F.lit("")))
    text = F.coalesce(opened, F.col("text"))
    declared = F.replace(text, F.lit(V.XML_DECLARATION), F.lit(V.XML_DECLARATION + "<!DOCTYPE a>"))
    text = F.when(F.expr("n % 13 = 6"), declared).otherwise(text)
    return rows.filter("n % 7 <> 3").select("url", F.encode(text, "UTF-8").alias("content"))


def landed_responses(spark, folder, path):
    """Applications landed as search responses in all kinds of layout, good and bad."""
    metadata = F.struct(
        F.col("cpcs").alias("cpcClassificationBag"),
        F.col("filing_date").cast("string").alias("filingDate"),
        F.col("invention_title").alias("inventionTitle"),
        F.col("status_code").alias("applicationStatusCode"),
        F.col("status_desc").alias("applicationStatusDescriptionText"),
    ).alias("applicationMetaData")

    def response(number, **options):
        record = F.struct(number.alias("applicationNumberText"), metadata)
        return F.to_json(F.struct(F.array(record).alias("patentFileWrapperDataBag")), options)

    number = F.col("application_number")
    plain = response(number)
    doubled = F.concat(plain, F.lit(" "), response(F.concat(F.lit("x"), number)))
    kind = number.cast("bigint") % 5
    text = (
        F.when(kind == 0, F.expr("left(plain, length(plain) - 7)"))
        .when(kind == 1, doubled)
        .when(kind == 2, response(number, pretty="true"))
        .when(kind == 3, F.concat(F.lit('{"code":404,"message":"'), number, F.lit('"}')))
        .otherwise(plain)
    )
    rows = apps(spark, folder).withColumn("plain", plain)
    rows.select(text.alias("value")).write.text(path)
