import pytest
from compare import differences, second_engine
from foliosift.llm.queries import ORACLES, QUERIES
from foliosift.llm.url_lists import listed_captures


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, small, name):
    rows, unequal = differences(QUERIES[name](spark, small), second_engine(small), ORACLES[name])
    assert rows > 0 and unequal == []


def test_awkward_captures(spark):
    changes = [("a.b", "2024-01-01 00:00:00", True), ("a.b", "2024-02-20 00:00:00", False)]
    changes += [("a.b", "2024-02-20 00:00:00", True), ("a.b", "2024-03-01 00:00:00", False)]
    changes += [("x.a.b/p", "2024-01-01 00:00:00", True), (None, None, None), ("c.d", None, True)]
    table = spark.createDataFrame(changes, "entry string, at string, listed boolean")
    rows = [(1, "http://u@X.a.b:80/p/q?z", "2024-02-29 23:59:59"), (1, "http://a.b", "2024-03-01 00:00:00")]
    rows += [(2, "http://a.b", "2024-01-01 00:00:00")] * 2 + [(3, None, None), (None, "junk", "2024-01-05 00:00:00")]
    rows += [(4, "http://a.b", "2023-12-31 23:59:59"), (5, "http://c.d/", "2024-05-01 00:00:00")]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_at string")
    got = listed_captures(captures, table)
    found = sorted(((r.page_id, r.url, r.n_entries) for r in got.collect()), key=repr)
    assert found == sorted([
        (1, "http://u@X.a.b:80/p/q?z", 2), (1, "http://a.b", 0), (2, "http://a.b", 1),
        (2, "http://a.b", 1), (3, None, 0), (None, "junk", 0), (4, "http://a.b", 0),
        (5, "http://c.d/", 0),
    ], key=repr)
    assert listed_captures(captures.limit(0), table).count() == 0
    assert {r.blocked for r in listed_captures(captures, table.limit(0)).collect()} == {False}
