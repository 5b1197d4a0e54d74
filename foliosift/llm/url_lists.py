"""URL filters: dated list entries joined with captures at the time of the fetch."""

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliosift.llm.common import name_of, row_of, with_columns
from foliosift.session import written

WEEK = 7 * 86_400
LAST = "9999-12-31 00:00:00"


def host_of(url):
    """Host in lower case, without user and port; empty where the text is no URL."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def path_of(url):
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def entry_keys(url):
    """Entries that can name a URL: its host, the domains above it, and path prefixes.

    A domain has two labels at least. A prefix is the host with the first path segments.
    """
    labels = F.split(host_of(url), r"\.")
    size = F.size(labels)
    domains = F.when(
        size > 1,
        F.transform(
            F.sequence(F.lit(1), size - 1), lambda i: F.array_join(F.slice(labels, i, size), ".")
        ),
    ).otherwise(F.array(host_of(url)))
    segments = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    prefixes = F.when(
        F.size(segments) > 0,
        F.transform(
            F.sequence(F.lit(1), F.size(segments)),
            lambda i: F.concat_ws("/", host_of(url), F.array_join(F.slice(segments, 1, i), "/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.concat(domains, prefixes), lambda k: k != ""))


def week_of(time):
    return F.floor(F.unix_seconds(time.cast("timestamp")) / WEEK).cast("bigint")


def validity_intervals(changes, entry="entry", at="at", listed="listed"):
    """(entry, since, until) for each span in which an entry is on the list.

    A change puts an entry on the list or takes it off; it holds until the next change of
    the entry, the last one for good. Of several changes at one time, one that lists wins.
    Changes without entry, time or state are left out.

    The next change is looked for inside the week, then in the first change of the next
    week with any, so no window holds more than the distinct times of an entry in a week
    or the weeks of an entry, however many changes it has.
    """
    states = changes.select(
        name_of(entry).alias("entry"),
        name_of(at).cast("timestamp").alias("since"),
        name_of(listed).alias("listed"),
    ).filter("entry is not null and since is not null and listed is not null")
    states = states.groupBy("entry", "since").agg(F.max("listed").alias("listed"))
    states = states.withColumn("week", week_of(F.col("since")))
    weeks = states.groupBy("entry", "week").agg(F.min("since").alias("first"))
    following = F.lead("first").over(W.partitionBy("entry").orderBy("week"))
    weeks = weeks.select("entry", "week", following.alias("following"))
    inside = F.lead("since").over(W.partitionBy("entry", "week").orderBy("since"))
    spans = states.withColumn("inside", inside).join(weeks, ["entry", "week"])
    until = F.coalesce("inside", "following", F.lit(LAST).cast("timestamp"))
    return spans.filter("listed").select("entry", "since", until.alias("until"))


def listed_captures(captures, changes, url="url", at="fetched_at", key="page_id"):
    """``captures`` with ``entries``, ``n_entries`` and ``blocked`` as of their fetch.

    ``changes`` has the columns entry, at and listed. A capture is blocked by the entries
    whose interval holds its fetch time, start included, end not. Intervals are laid out
    over weeks up to the last fetch, so the as-of join is an equality of entry and week
    with a test of times; each entry matches a capture once at most. The intervals are
    stored, so that AQE splits the captures of a very large host. Only DataFrame functions.

    A null or broken URL, or a null time, matches nothing: no entries, not blocked. Rows
    are judged one by one, also repeated ones and those without key. Empty tables give no
    rows, or rows without entries. Other columns stay; the three named ones are replaced.
    """
    base = captures.select(
        name_of(key).alias("key"),
        name_of(url).alias("url"),
        name_of(at).cast("timestamp").alias("at"),
        row_of(captures),
    )
    # The last fetch as text, as a time of any zone comes back unchanged that way.
    last = F.lit(base.agg(F.max("at").cast("string")).first()[0]).cast("timestamp")
    spans = validity_intervals(changes).filter(F.col("since") <= last)
    weeks = F.sequence(week_of(F.col("since")), week_of(F.least(F.col("until"), last)))
    spans = spans.select("entry", "since", "until", F.explode(weeks).alias("week"))
    spans = written(spans, "intervals")
    keys = base.select("key", "url", "at", F.explode(entry_keys(F.col("url"))).alias("entry"))
    keys = keys.withColumn("week", week_of(F.col("at")))
    hits = (
        keys.join(spans, ["entry", "week"])
        .filter((F.col("since") <= F.col("at")) & (F.col("at") < F.col("until")))
        .groupBy("key", "url", "at")
        .agg(F.sort_array(F.collect_set("entry")).alias("entries"))
    )
    same = reduce(
        lambda a, b: a & b, (base[c].eqNullSafe(hits[c]) for c in ("key", "url", "at"))
    )
    found = base.join(hits, same, "left").select("row", hits["entries"])
    entries = F.coalesce("entries", F.array().cast("array<string>"))
    return with_columns(
        found,
        {
            "entries": entries,
            "n_entries": F.size(entries).cast("bigint"),
            "blocked": F.size(entries) > 0,
        },
        captures.columns,
    )


def dated_captures(pages):
    """Captures with a fetch time made from the page id, in the month of the events."""
    seconds = F.col("page_id") * 7919 % (30 * 86_400)
    start = F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return pages.select("page_id", "url", F.timestamp_seconds(start + seconds).alias("fetched_at"))


def list_changes(pages, events):
    """Dated list changes: each event changes the entry of the page of its user.

    Entries are hosts, the domains above them, or a host with a first path segment.
    """
    url = F.col("url")
    host = host_of(url)
    segment = F.regexp_extract(url, r"^\w+://[^/?#]*/([^/?#]+)", 1)
    entry = (
        F.when(F.col("page_id") % 3 == 0, host)
        .when(F.col("page_id") % 3 == 1, F.regexp_replace(host, r"^[^.]+\.", ""))
        .otherwise(F.concat(host, F.lit("/"), segment))
    )
    entries = pages.select(F.col("page_id").alias("user_id"), entry.alias("entry"))
    return events.join(entries, "user_id").select(
        "entry",
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("at"),
        (~F.col("event_type").isin("error", "purchase")).alias("listed"),
    )


def op5_url_lists(spark, sf_dir):
    """Every page with the list entries that hold at its fetch."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "ts", "event_type")
    found = listed_captures(dated_captures(pages), list_changes(pages, events))
    return found.select(
        "page_id", "url", "n_entries", F.array_join("entries", ",").alias("entries"), "blocked"
    )


OP5_SQL = r"""
with parts as (
  select page_id, url,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) as host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) as path,
    timestamp '2024-01-01' + to_seconds(page_id * 7919 % 2592000) as fetched_at
  from pages
), changes as (
  select case page_id % 3 when 0 then host when 1 then regexp_replace(host, '^[^.]+\.', '')
      else host || '/' || regexp_extract(url, '^\w+://[^/?#]*/([^/?#]+)', 1) end as entry,
    date_trunc('second', ts) as changed, bool_or(event_type not in ('error', 'purchase')) as listed
  from events join parts on page_id = user_id group by all
), intervals as (
  select entry, listed, changed as since, coalesce(lead(changed) over (partition by entry order by changed),
    timestamp '9999-12-31') as until from changes
), labelled as (
  select *, string_split(host, '.') as labels,
    list_filter(string_split(path, '/'), lambda s: s <> '') as segments from parts
), keys as (
  select page_id, url, fetched_at,
    array_to_string(labels[i:], '.') as entry
  from (select *, unnest(range(1, greatest(len(labels), 2))) as i from labelled)
  union
  select page_id, url, fetched_at, host || '/' || array_to_string(segments[1:i], '/')
  from (select *, unnest(range(1, len(segments) + 1)) as i from labelled)
), hits as (
  select page_id, url, count(distinct entry) as n, string_agg(distinct entry, ',' order by entry) as entries
  from keys join intervals using (entry)
  where listed and since <= fetched_at and fetched_at < until group by page_id, url
)
select page_id, url, cast(coalesce(n, 0) as bigint) as n_entries, coalesce(entries, '') as entries,
  coalesce(n, 0) > 0 as blocked
from parts left join hits using (page_id, url)
"""
