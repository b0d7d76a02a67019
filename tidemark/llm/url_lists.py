"""URL filter lists that change over time, applied to captures as of their fetch time.

A list is a log of dated entries: a pattern (a host, a domain with all below it, or a URL prefix)
is added to or removed from a category at some time. The log becomes validity intervals, and
every capture is tested against the entries that were active when it was fetched.

The as-of join is an equality join. Each URL yields the keys that could list it (its host, each
parent domain, each prefix of its path), and keys meet intervals on (key, period) of ``PERIOD_DAYS``. An interval
has a row in the period it begins in, and one more in each later period in which a capture asks for its key: the state
is handed on from period to period, so nothing is written for days on which nothing happens. Which interval
holds the fetch time is settled inside the period. A host with a third of all captures is spread over its periods, and
adaptive execution splits what is still too large. Entries of keys that no capture has are dropped before the intervals are
made, and only distinct (url, fetch time) pairs are evaluated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, read_table

PERIOD_DAYS = 1
KINDS = ("host", "domain", "prefix")


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without user, port or a final dot; NULL if it has none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"\.?(?::\d*)?$", ""))
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """The path of a URL up to its query or fragment, beginning with a slash."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def url_keys(url: Column) -> Column:
    """All (kind, pattern) that list this URL: its host, each parent domain, each prefix that ends with a slash or the path."""
    host, path = host_of(url), path_of(url)
    labels, steps = F.split(host, r"\."), F.split(path, "/")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    heads = F.transform(
        F.sequence(F.lit(1), F.size(steps)),
        lambda k: F.concat(host, F.array_join(F.slice(steps, 1, k), "/"), F.when(k < F.size(steps), F.lit("/")).otherwise(F.lit(""))),
    )

    def keys(kind: str, patterns: Column) -> Column:
        return F.transform(patterns, lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("pattern")))

    return F.array_distinct(F.concat(keys("host", F.array(host)), keys("domain", tails), keys("prefix", heads)))


def _period(at: Column, days: int) -> Column:
    return F.floor(F.datediff(at, F.lit("1970-01-01").cast("date")) / days)


def intervals(entries: DataFrame, period_days: int = PERIOD_DAYS) -> DataFrame:
    """Validity intervals of a log (kind, pattern, category, action, listed_at): valid_from, valid_to (NULL: still open).

    An ``add`` while listed, and a ``remove`` while not, change nothing. Of entries of one
    moment the removal counts last. An interval holds its start and not its end; entries
    without a pattern, category, time or known action are left out.

    A pattern's log is lined up period by period, and the periods' ends are handed on in a second
    window of one row per period, so that a pattern with a third of all entries is split.
    """
    known = entries.select("kind", "pattern", "category", "action", "listed_at").where(
        F.col("pattern").isNotNull() & F.col("category").isNotNull() & F.col("listed_at").isNotNull()
        & F.col("kind").isin(*KINDS) & F.col("action").isin("add", "remove")
    )
    # One row for each moment: whether the pattern is listed from then on.
    key = ["kind", "pattern", "category"]
    states = known.groupBy(*key, "listed_at").agg((F.max("action") == "add").alias("on")).withColumn(
        "period", _period(F.col("listed_at"), period_days)
    )
    inside = Window.partitionBy(*key, "period").orderBy("listed_at")
    across = Window.partitionBy(*key).orderBy("period")
    ends = states.groupBy(*key, "period").agg(F.max_by("on", "listed_at").alias("last_on"))
    handed = ends.withColumn("on_before", F.lag("last_on", 1, False).over(across)).drop("last_on")
    changes = (
        states.withColumn("before", F.lag("on").over(inside)).join(handed, [*key, "period"])
        .where(F.col("on") != F.coalesce("before", "on_before")).drop("before", "on_before")
    )
    starts = changes.groupBy(*key, "period").agg(F.min("listed_at").alias("first_change"))
    following = starts.withColumn("next_change", F.lead("first_change").over(across)).drop("first_change")
    spans = changes.withColumn("next_here", F.lead("listed_at").over(inside)).join(following, [*key, "period"])
    return spans.where("on").select(
        *key, F.col("listed_at").alias("valid_from"), F.coalesce("next_here", "next_change").alias("valid_to")
    )


def _pieces(spans: DataFrame, wanted: DataFrame, period_days: int) -> DataFrame:
    """Intervals by ``__period``: where they begin, and where they are open and the period is wanted.

    Intervals of one (kind, pattern, category) do not overlap, so only the last one before a period can reach into it.
    One row for each of these and period goes into the window, however many entries or captures it has.
    """
    key, period = ["kind", "pattern", "category"], F.col("__period")
    begun = spans.withColumn("__period", _period(F.col("valid_from"), period_days))
    span = F.struct("valid_from", "valid_to")
    last = begun.groupBy(*key, "__period").agg(F.max_by(span, "valid_from").alias("__last"), F.lit(False).alias("__asked"))
    asked = begun.select(*key).distinct().join(wanted, key[:2]).select(
        *key, "__period", F.lit(None).cast(last.schema["__last"].dataType).alias("__last"), F.lit(True).alias("__asked")
    )
    before = Window.partitionBy(*key).orderBy("__period").rangeBetween(Window.unboundedPreceding, -1)
    states = last.unionByName(asked).groupBy(*key, "__period").agg(
        F.max("__last").alias("__last"), F.max("__asked").alias("__asked")
    ).withColumn("__open", F.last("__last", ignorenulls=True).over(before))
    until = F.col("__open.valid_to")
    carried = states.where(F.col("__asked") & F.col("__open").isNotNull() & (until.isNull() | (_period(until, period_days) >= period)))
    return begun.unionByName(carried.select(*key, F.col("__open.valid_from").alias("valid_from"), until.alias("valid_to"), "__period"))


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at", period_days: int = PERIOD_DAYS) -> DataFrame:
    """``captures`` with n_matches, categories (sorted, comma-joined) and listed_since of the entries active at the fetch.

    ``listed_since`` is the earliest start among the active intervals; both are NULL without one.
    Every capture keeps its row. A NULL or hostless URL and a NULL time match nothing. Other
    columns are kept as they are; the three results may not be among them. No captures give no rows, an empty log no matches;
    repeated captures and entries count once for each other. URLs of any length are read whole.
    """
    own_url, own_at = free_name(captures, "asked_url"), free_name(captures, "asked_at")
    asked = captures.select(F.col(url).alias(own_url), F.col(at).alias(own_at)).where(
        F.col(own_at).isNotNull() & host_of(F.col(own_url)).isNotNull()
    ).distinct()
    keys = asked.withColumn("__key", F.explode(url_keys(F.col(own_url)))).select(
        own_url, own_at, F.col("__key.kind").alias("kind"), F.col("__key.pattern").alias("pattern"), _period(F.col(own_at), period_days).alias("__period")
    )
    key = ["kind", "pattern"]
    wanted = keys.select(*key, "__period").distinct()
    pieces = _pieces(intervals(entries.join(wanted, key, "left_semi"), period_days), wanted, period_days)
    active = (F.col("valid_from") <= F.col(own_at)) & (F.col("valid_to").isNull() | (F.col(own_at) < F.col("valid_to")))
    found = keys.join(pieces, ["kind", "pattern", "__period"]).where(active).groupBy(own_url, own_at).agg(
        F.count(F.lit(1)).alias("n_matches"),
        F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"),
        F.min("valid_from").alias("listed_since"),
    )
    out = captures.join(found, (F.col(url) == F.col(own_url)) & (F.col(at) == F.col(own_at)), "left").drop(own_url, own_at)
    return out.withColumn("n_matches", F.coalesce("n_matches", F.lit(0).cast("long")))


def _page_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the page that it falls on: page ids go round with the events' ids."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "user_id")
    return events.withColumn("page_id", F.col("event_id") % F.lit(max(pages.count(), 1))).join(pages, "page_id")


def page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of type ``view`` and ``click`` as captures of their pages."""
    seen = _page_events(spark, sf_dir).where(F.col("event_type").isin("view", "click"))
    return seen.select("event_id", "page_id", "url", F.col("ts").alias("fetched_at"))


def page_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All other events as a log of the pages' own hosts.

    Events of type ``error`` and ``purchase`` add to a list, others remove. The kind of
    pattern follows the page's id: host, parent domain, or host with its first path step.
    """
    host, url = host_of(F.col("url")), F.col("url")
    return _page_events(spark, sf_dir).where(host.isNotNull() & ~F.col("event_type").isin("view", "click")).select(
        F.when(F.col("page_id") % 3 == 0, "host").when(F.col("page_id") % 3 == 1, "domain").otherwise("prefix").alias("kind"),
        F.when(F.col("page_id") % 3 == 0, host)
        .when(F.col("page_id") % 3 == 1, F.regexp_replace(host, r"^[^.]*\.", ""))
        .otherwise(F.concat(host, F.regexp_extract(path_of(url), r"^(/[^/]*/?)", 1))).alias("pattern"),
        F.when(F.col("user_id") % 2 == 0, "spam").otherwise("adult").alias("category"),
        F.when(F.col("event_type").isin("error", "purchase"), "add").otherwise("remove").alias("action"),
        F.col("ts").alias("listed_at"),
    )


def op3_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(page_captures(spark, sf_dir), page_lists(spark, sf_dir))


QUERIES = {"op3_url_lists": op3_url_lists}

ORACLE_SQL = {
    "op3_url_lists": r"""
    WITH parts AS (
      SELECT page_id, url, nullif(lower(regexp_replace(regexp_replace(
               regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), '\.?(?::\d*)?$', '')), '') AS host,
             CASE regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) WHEN '' THEN '/'
               ELSE regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) END AS path
      FROM pages),
    log AS (
      SELECT CASE p.page_id % 3 WHEN 0 THEN 'host' WHEN 1 THEN 'domain' ELSE 'prefix' END AS kind,
             CASE p.page_id % 3 WHEN 0 THEN host WHEN 1 THEN regexp_replace(host, '^[^.]*\.', '')
               ELSE host || regexp_extract(path, '^(/[^/]*/?)', 1) END AS pattern,
             CASE WHEN user_id % 2 = 0 THEN 'spam' ELSE 'adult' END AS category,
             event_type IN ('error', 'purchase') AS adds, ts AS listed_at
      FROM parts p JOIN events e ON e.event_id % (SELECT count(*) FROM pages) = p.page_id
      WHERE host IS NOT NULL AND event_type NOT IN ('view', 'click')),
    captures AS (
      SELECT event_id, page_id, url, ts AS fetched_at, host, path
      FROM parts JOIN events ON event_id % (SELECT count(*) FROM pages) = page_id WHERE event_type IN ('view', 'click')),
    -- The latest moment of each listed pattern before the fetch says whether it is listed; a removal of the same moment wins.
    moments AS (SELECT kind, pattern, category, listed_at, bool_and(adds) AS adds FROM log GROUP BY ALL),
    runs AS (
      SELECT *, coalesce(adds <> lag(adds) OVER w, true) AS changed FROM moments
      WINDOW w AS (PARTITION BY kind, pattern, category ORDER BY listed_at)),
    spans AS (
      SELECT *, lead(listed_at) OVER (PARTITION BY kind, pattern, category ORDER BY listed_at) AS until FROM runs WHERE changed),
    hits AS (
      SELECT DISTINCT c.url, c.fetched_at, s.kind, s.pattern, s.category, s.listed_at
      FROM (SELECT DISTINCT url, fetched_at, host, path FROM captures) c JOIN spans s
        ON s.adds AND s.listed_at <= c.fetched_at AND (s.until IS NULL OR c.fetched_at < s.until)
       AND CASE s.kind WHEN 'host' THEN c.host = s.pattern
             WHEN 'domain' THEN c.host = s.pattern OR ends_with(c.host, '.' || s.pattern)
             ELSE c.host || c.path = s.pattern OR (ends_with(s.pattern, '/') AND starts_with(c.host || c.path, s.pattern)) END),
    found AS (
      SELECT url, fetched_at, count(*) AS n_matches, string_agg(DISTINCT category, ',' ORDER BY category) AS categories,
             min(listed_at) AS listed_since
      FROM hits GROUP BY url, fetched_at)
    SELECT c.event_id, c.page_id, c.url, c.fetched_at, coalesce(n_matches, 0) AS n_matches, categories, listed_since
    FROM captures c LEFT JOIN found f ON f.url = c.url AND f.fetched_at = c.fetched_at""",
}
