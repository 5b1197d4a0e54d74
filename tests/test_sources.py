import datetime
import json

from pyspark.sql import functions as F

from foliosift.operators.facets import facet_counts
from foliosift.sources import applications as A
from foliosift.sources import documents as D
from foliosift.schemas import APPLICATION_COLUMNS, APPLICATIONS


def landed(tmp_path, name, *objects):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "one.json").write_text("\n".join(json.dumps(o) for o in objects))
    return str(folder)


RECORDS = [
    {
        "applicationNumberText": "007",
        "applicationMetaData": {
            "patentNumber": "11",
            "cpcClassificationBag": ["H05K   7/20", "G06F1/20"],
            "filingDate": "2020-02-29",
            "inventionTitle": 'Rack, "cold"',
            "grantDate": "2022-01-04",
            "applicationStatusCode": 150,
            "applicationStatusDescriptionText": "Patented Case",
            "applicationTypeLabelName": "Utility",
        },
    },
    {"applicationNumberText": "1", "applicationMetaData": {"cpcClassificationBag": [], "filingDate": "no date"}},
    {"applicationNumberText": "2", "inventionTitle": "outer", "applicationMetaData": {"inventionTitle": "inner"}},
    {"applicationNumberText": "3", "inventionTitle": "outer", "applicationMetaData": {}},
    {"applicationNumberText": "4"},
    {"applicationNumberText": "5", "applicationMetaData": {"applicationNumberText": "inner 5"}},
]


def test_search_responses(spark, tmp_path):
    path = landed(
        tmp_path, "responses",
        {"patentFileWrapperDataBag": RECORDS[:2], "count": 2}, {"patentFileWrapperDataBag": RECORDS[2:]},
        {"patentFileWrapperDataBag": []}, {"message": "none"},
    )
    records = A.read_search_responses(spark, path)
    rows = {row.application_number: row for row in A.application_rows(records).collect()}
    assert sorted(rows) == ["007", "1", "2", "3", "4", "inner 5"]
    first = rows["007"]
    assert first.asDict() == {
        "application_number": "007",
        "patent_number": "11",
        "cpcs": ["H05K   7/20", "G06F1/20"],
        "filing_date": datetime.date(2020, 2, 29),
        "invention_title": 'Rack, "cold"',
        "grant_date": datetime.date(2022, 1, 4),
        "status_code": "150",
        "status_desc": "Patented Case",
    }
    assert (rows["1"].cpcs, rows["1"].filing_date, rows["1"].patent_number) == ([], None, None)
    assert (rows["2"].invention_title, rows["3"].invention_title) == ("inner", "outer")
    assert rows["4"].invention_title is None
    counts = facet_counts(A.application_rows(records, with_type=True)).collect()
    found = {(row.facet, row.value): row.n for row in counts}
    assert found[("application_type", "Utility")] == 1 and found[("status_code", None)] == 5


def response(*numbers, **more):
    bag = [{"applicationNumberText": n, "applicationMetaData": {"inventionTitle": 'a} {b "c" \\'}} for n in numbers]
    return {"patentFileWrapperDataBag": bag, "count": len(bag), **more}


def test_landed_layouts(spark, tmp_path):
    """No layout loses a record, and no damage goes unseen."""
    folder = tmp_path / "landing"
    folder.mkdir()
    plain = lambda *n, **more: json.dumps(response(*n, **more))
    (folder / "lines.json").write_text("\n".join([plain("1", "2"), plain(), "", plain("3")]))
    (folder / "doubled.json").write_text(plain("4") + plain("5") + "  " + plain("6") + "\n" + plain("7"))
    (folder / "indented.json").write_text(
        "\ufeff" + json.dumps(response("8", "9"), indent=2) + "\r\n" + json.dumps(response("10"), indent="\t")
    )
    (folder / "array.json").write_text(json.dumps([response("11"), response("12")]))
    (folder / "lines_in_array.json").write_text("[\n" + plain("13") + ",\n" + plain("14") + "\n]\n")
    (folder / "cut.json").write_text(plain("15")[:-20] + "\n" + plain("16") + "\n" + plain("17")[:9])
    (folder / "mixed.json").write_text(plain("18") + " oops " + plain("19") + plain("20")[:-3])
    (folder / "others.json").write_text('{"message": "no } { list"}\nnot json\n{}\n' + plain("21", error=None))
    (folder / "empty.json").write_text("")
    records, broken = A.landed_search_responses(spark, str(folder))
    rows = records.select("applicationNumberText", "applicationMetaData.inventionTitle").collect()
    good = [n for n in range(1, 22) if n not in (15, 17, 20)]
    assert sorted(int(r[0]) for r in rows) == good
    assert {r[1] for r in rows} == {'a} {b "c" \\'}
    found = sorted((r.file.rsplit("/")[-1], r.reason, r.object[:8]) for r in broken.collect())
    assert found == [
        ("cut.json", "malformed JSON", '{"patent'), ("cut.json", "malformed JSON", '{"patent'),
        ("mixed.json", "malformed JSON", "oops"), ("mixed.json", "malformed JSON", '{"patent'),
        ("others.json", "malformed JSON", "not json"), ("others.json", "no patentFileWrapperDataBag", '{"messag'),
        ("others.json", "no patentFileWrapperDataBag", "{}"),
    ]


def test_large_files_are_split(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    text = "\n".join(json.dumps(response(str(n)), indent=1 if n % 3 else None) for n in range(3000))
    (folder / "one.json").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(len(text) // 20))
    records, broken = A.landed_search_responses(spark, str(folder))
    assert records.rdd.getNumPartitions() > 4
    assert sorted(int(r[0]) for r in records.select("applicationNumberText").collect()) == list(range(3000))
    assert broken.count() == 0
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_broken_listings(spark, tmp_path):
    folder = tmp_path / "listings"
    folder.mkdir()
    (folder / "one.json").write_text('{"application_number": "1"}{"documentBag": []}\n{"application_number": "2", "docu')
    good, broken = D.landed_listings(spark, str(folder))
    assert [r.application_number for r in good.collect()] == ["1"]
    assert sorted(r.reason for r in broken.collect()) == ["malformed JSON", "no application_number"]


def test_csv_files_of_many_headers(spark, tmp_path):
    folder = tmp_path / "more csv"
    folder.mkdir()
    (folder / "a.csv").write_text('application_number,invention_title\n1,"  two\nlines "\n2,plain\n')
    (folder / "b.csv").write_text('\ufeffinvention_title,,status_desc,application_number\n"say ""x"", y",9,Docketed,3\n')
    (folder / "c.csv").write_text("application_number,invention_title\n4,\n")
    (folder / "d.csv").write_text("")
    rows = A.read_applications_csv(spark, str(folder)).orderBy("application_number").collect()
    assert [(r.application_number, r.invention_title, r.status_desc) for r in rows] == [
        ("1", "  two\nlines ", None), ("2", "plain", None), ("3", 'say "x", y', "Docketed"), ("4", None, None),
    ]


def test_parquet_and_csv_round_trips(spark, tmp_path):
    path = landed(tmp_path, "responses", {"patentFileWrapperDataBag": RECORDS})
    apps = A.application_rows(A.read_search_responses(spark, path)).cache()
    table, text = str(tmp_path / "table"), str(tmp_path / "text")
    A.replace_applications(apps, table)
    A.append_applications(apps.filter("application_number = '1'"), table)
    A.export_csv(apps, text)
    A.export_csv(apps.filter("application_number = '1'"), text)
    key = lambda rows: sorted(map(repr, rows.collect()))
    expected = key(apps.union(apps.filter("application_number = '1'")))
    assert key(A.read_applications(spark, table)) == expected
    packed = apps.withColumn("cpcs", F.transform("cpcs", lambda c: F.replace(c, F.lit(" "), F.lit(""))))
    from_text = A.read_applications_csv(spark, text)
    assert from_text.schema == APPLICATIONS
    assert key(from_text) == key(packed.union(packed.filter("application_number = '1'")))
    A.replace_applications(apps.limit(2), table)
    assert A.read_applications(spark, table).count() == 2


def test_csv_with_other_columns_and_order(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text(
        ",status_desc,application_number,cpcs,invention_title\n"
        '0,Docketed,0042,"A 1,B2","say ""x"", y"\n1,,7,,\n'
    )
    rows = A.read_applications_csv(spark, str(folder)).orderBy("application_number").collect()
    assert rows[0].__fields__ == APPLICATION_COLUMNS
    assert (rows[0].application_number, rows[0].cpcs, rows[0].invention_title) == ("0042", ["A1", "B2"], 'say "x", y')
    assert (rows[1].cpcs, rows[1].status_desc, rows[1].filing_date) == (None, None, None)


def test_buckets(spark, tmp_path):
    path = str(tmp_path / "buckets")
    rows = spark.range(100).withColumn("bucket", F.floor(F.col("id") / 30))
    A.append_buckets(rows, path)
    A.append_buckets(rows.filter("bucket = 0"), path)
    counts = spark.read.parquet(path).groupBy("bucket").count().orderBy("bucket").collect()
    assert [row["count"] for row in counts] == [60, 30, 30, 10]


def test_patterns_file(spark, tmp_path):
    (tmp_path / "patterns.txt").write_text("G06N3/08  # networks\n# off\n\nF28D*\n")
    rows = A.read_patterns(spark, str(tmp_path / "patterns.txt")).collect()
    assert [row.pattern for row in rows] == ["G06N3/08", "F28D*"]


def test_listings_and_payloads(spark, tmp_path):
    bag = [{"documentCode": "SPEC", "downloadOptionBag": [{"downloadUrl": "u", "mimeTypeIdentifier": "XML"}]}]
    path = landed(tmp_path, "listings", {"application_number": "1", "documentBag": bag}, {"application_number": "2"})
    rows = D.read_listings(spark, path).orderBy("application_number").collect()
    assert rows[0].documentBag[0].downloadOptionBag[0].downloadUrl == "u" and rows[1].documentBag is None
    files = tmp_path / "payloads" / "deep"
    files.mkdir(parents=True)
    (files / "a.xml").write_bytes(b"\xff\x00")
    (files / "a.txt").write_bytes(b"no")
    name = F.concat(F.lit("https://host/"), F.element_at(F.split("path", "/"), -1))
    found = D.read_payload_files(spark, str(tmp_path / "payloads"), url=name).collect()
    assert [(row.url, bytes(row.content)) for row in found] == [("https://host/a.xml", b"\xff\x00")]
    table = str(tmp_path / "table")
    D.read_payload_files(spark, str(tmp_path / "payloads")).write.parquet(table)
    assert D.read_payload_table(spark, table).first().url.endswith("deep/a.xml")
