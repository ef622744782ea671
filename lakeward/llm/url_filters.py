"""URL filters by a temporal list join (operator 8), DataFrame operations only.

Dated list entries (a pattern is added to or removed from a list) become validity
intervals: from an addition to the next change of the same pattern in the same
list. A capture looks up every pattern that may match it: its host and parent
domains, and its host with each leading part of its path. Captures and intervals
meet by an equality join on (kind, pattern, time bucket, salt) and an interval
counts if it holds the fetch time. An interval is repeated for each bucket it
crosses, clipped to the days that captures have, so a pattern's whole history is
never compared with all its captures; the salt spreads a host with a third of all
captures.

Defined cases: an interval holds its first moment and not its last; at one moment
a removal wins over an addition; a removal without an addition does nothing;
entries with a null field are ignored; a capture with a null or unparsable url,
or a null time, matches nothing and is allowed; repeated captures get a row each;
repeated entries count once; letter case and slashes at the end of a pattern mean
nothing; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.common import salted_lookup

BUCKET_DAYS = 30
SALTS = 8


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; empty if there is none."""
    place = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(place, r"^.*@", ""), r":[0-9]*$", ""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def as_pattern(text: Column) -> Column:
    """Lower-case, without slashes at the end."""
    return F.regexp_replace(F.lower(text), r"/+$", "")


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, since, until) from (list, kind, pattern, at, action);
    until is null while the entry stands."""
    own = Window.partitionBy("list", "kind", "pattern").orderBy("at", "action")
    clean = entries.select("list", "kind", as_pattern(F.col("pattern")).alias("pattern"), "at", "action").dropna().distinct()
    spans = clean.withColumn("until", F.lead("at").over(own)).where(F.col("action") == "add")
    return spans.select("list", "kind", "pattern", F.col("at").alias("since"), "until").where("until is null or until > since")


def lookups(captures: DataFrame) -> DataFrame:
    """(url, at, kind, pattern): what may be listed for each distinct url and time."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    urls = captures.select("url", "at").dropna().distinct().withColumn("_host", host).withColumn("_path", path).where("_host != ''")
    labels = F.split("_host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")))
    parts = F.filter(F.split("_path", "/"), lambda x: x != "")
    leading = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(
        F.lit("prefix").alias("kind"), as_pattern(F.concat_ws("/", F.col("_host"), F.array_join(F.slice(parts, 1, i), "/"))).alias("pattern")))
    return urls.select("url", "at", F.inline(F.array_distinct(F.concat(domains, leading))))


def bucket(at: Column) -> Column:
    return F.floor(F.unix_date(F.to_date(at)) / BUCKET_DAYS).cast("int")


def active_entries(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(url, at, list, kind, pattern): entries active for a url at its fetch time."""
    days = captures.agg(F.min("at").alias("low"), F.max("at").alias("high")).first()
    spans = intervals(entries)
    low, high = F.lit(days["low"]), F.lit(days["high"])
    spans = spans.where((F.col("since") <= high) & (F.col("until").isNull() | (F.col("until") > low)))
    first, last = bucket(F.greatest("since", low)), bucket(F.least(F.coalesce("until", high), high))
    spread = (spans.withColumn("_bucket", F.explode(F.sequence(first, last)))
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    asked = (lookups(captures).withColumn("_bucket", bucket(F.col("at")))
             .withColumn("_salt", F.pmod(F.xxhash64("url", "at"), F.lit(SALTS)).cast("int")))
    met = asked.join(spread.hint("merge"), ["kind", "pattern", "_bucket", "_salt"])
    return met.where((F.col("since") <= F.col("at")) & (F.col("until").isNull() | (F.col("at") < F.col("until")))).select(
        "url", "at", "list", "kind", "pattern")


def url_filter(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(id, url, at) captures with blocked, n_entries and lists (names joined by commas)."""
    verdicts = active_entries(captures, entries).groupBy("url", "at").agg(
        F.count("*").alias("n_entries"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"))
    rows = salted_lookup(captures.select("id", "url", "at"), verdicts, ["url", "at"], "id")
    return rows.select("id", "url", "at", F.col("n_entries").isNotNull().alias("blocked"),
                       F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"), F.coalesce("lists", F.lit("")).alias("lists"))
