"""URL and identity functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: scheme, host, path, query of a URL
PARTS = r"^([a-zA-Z][a-zA-Z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
TRACKERS = r"^(?:utm_[^=]*|fbclid|gclid|searchId|rps)(?:=|$)"


def _piece(url: Column, k: int) -> Column:
    return F.regexp_extract(url, PARTS, k)


def with_scheme(url: Column) -> Column:
    t = F.trim(F.coalesce(url, F.lit("")))
    return F.when((t == "") | t.contains("://"), t).otherwise(F.concat(F.lit("https://"), t))


def review_key(url: Column) -> Column:
    """Scheme and host in lower case, single slashes, no trailing slash and no
    fragment; the query stays as it is. Blank gives ''."""
    u = with_scheme(url)
    path = F.regexp_replace(F.regexp_replace(_piece(u, 3), "/+", "/"), "/$", "")
    query = _piece(u, 4)
    return F.when(u == "", "").otherwise(F.concat(F.lower(_piece(u, 1)), F.lit("://"), F.lower(_piece(u, 2)), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def canonical(url: Column) -> Column:
    """As ``review_key``, with query pairs sorted and trackers dropped; an
    empty path reads "/"."""
    u = with_scheme(url)
    path = F.regexp_replace(F.regexp_replace(_piece(u, 3), "/+", "/"), "/$", "")
    pairs = F.array_sort(F.filter(F.split(_piece(u, 4), "&"), lambda p: (p != "") & ~p.rlike(TRACKERS)))
    query = F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(pairs, "&"))).otherwise("")
    return F.when(u == "", "").otherwise(F.concat(F.lower(_piece(u, 1)), F.lit("://"), F.lower(_piece(u, 2)), F.when(path == "", "/").otherwise(path), query))


def host(url: Column) -> Column:
    return F.lower(_piece(with_scheme(url), 2))


def detect_source(url: Column, hosts: list[tuple[str, str]], other: str = "generic") -> Column:
    """First source whose host part occurs in the URL's host, in the given order."""
    out = F.lit(other)
    for part, name in reversed(hosts):
        out = F.when(host(url).contains(part), F.lit(name)).otherwise(out)
    return out


def site_id(url: Column, pattern: str) -> Column:
    """The id that a URL's path holds by a pattern with one group; '' if none."""
    return F.regexp_extract(_piece(with_scheme(url), 3), pattern, 1)


def hash_id(url: Column, prefix: str, places: int = 4) -> Column:
    """Prefix and a number drawn from the URL's hash: the same everywhere."""
    n = F.conv(F.substring(F.sha2(url, 256), 1, 8), 16, 10).cast("long") % (10**places)
    return F.concat(F.lit(prefix), F.lpad(n.cast("string"), places, "0"))


def plan_signature(urls: Column) -> Column:
    """Hash of an ordered list of URLs."""
    return F.sha2(F.array_join(urls, "\n"), 256)


def unique_ids(df: DataFrame, url: str, prefix: str, places: int = 4) -> DataFrame:
    """(url, id) of each distinct address: the hashed slot, and for addresses
    that meet in a slot a number by the order of their hashes. The same set of
    addresses gets the same ids whatever the order of the rows."""
    one = df.select(F.col(f"`{url}`").alias("url")).where(F.col("url").isNotNull()).distinct().withColumn("_s", F.sha2("url", 256))
    slot = F.conv(F.substring("_s", 1, 8), 16, 10).cast("long") % (10**places)
    n = F.row_number().over(Window.partitionBy("_slot").orderBy("_s"))
    return one.withColumn("_slot", slot).withColumn("_n", n).select(
        "url", F.concat(F.lit(prefix), F.lpad(F.col("_slot").cast("string"), places, "0"), F.when(F.col("_n") > 1, F.concat(F.lit("_"), F.col("_n").cast("string"))).otherwise("")).alias("id")
    )


def site_url(url: Column, sites: list[tuple[str, bool, bool]]) -> Column:
    """Canonical address by the rules of the board whose host part it has: always
    https and without a closing slash, with "www." in front or the query dropped
    where the board wants it; other boards' as ``review_key``."""
    u = with_scheme(url)
    name, path, query = F.lower(_piece(u, 2)), F.regexp_replace(_piece(u, 3), "/+$", ""), _piece(u, 4)
    out = review_key(url)
    for part, www, drop in reversed(sites):
        front = F.concat(F.lit("www."), F.regexp_replace(name, r"^www\.", "")) if www else name
        tail = F.lit("") if drop else F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")
        out = F.when(name.contains(part), F.concat(F.lit("https://"), front, path, tail)).otherwise(out)
    return F.when(u == "", "").otherwise(out)


def page_key(url: Column, passing: list[str]) -> Column:
    """Host, path and sorted query of a page without passing parameters."""
    u = with_scheme(url)
    pairs = F.array_sort(F.filter(F.split(_piece(u, 4), "&"), lambda p: (p != "") & ~p.rlike(rf"^(?:utm_[^=]*|{'|'.join(passing)})(?:=|$)")))
    return F.concat(F.lower(_piece(u, 2)), _piece(u, 3), F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(pairs, "&"))).otherwise(""))
