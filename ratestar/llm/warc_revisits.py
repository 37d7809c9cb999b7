"""Web archives: not-modified revisits resolved to the response they stand for (operator 7).

A crawler that is told `304 Not Modified` archives a revisit record without a
body. Each revisit is joined as of its time to the latest earlier full response
of the same canonical URL; its validators are checked against that response, and
the headers that a 304 may update are merged into the stored ones.

The as-of join is a running last value in a sort of all records by URL, time and
number, with revisits before the responses of their time. One URL, and one time of it, may hold a
third of all records, so the sort is cut into blocks of rows; windows run within a
URL and a block, and what a block leaves behind, one response per URL, is
carried over to the later blocks of the URL. No task holds all records of a URL. Revisits without
a time or canonical URL refer to nothing and are in no sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratestar.session import cut_lineage

#: Rows of the sort in one block.
BLOCK_ROWS = 8_192
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row in partition below
#: Headers of a 304 response that update the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that don't choose the content (fixed values).
TRACKING = ("utm_[a-z]+", "fbclid", "gclid", "ref", "sessionid")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical_url(url: Column) -> Column:
    """host[:port]/path?query: without scheme, `www.`, default port, fragment, tracking parameters; parameters in order.

    Null for null and for URLs without `://`.
    """
    rest = F.regexp_replace(F.substring(url, F.instr(url, "://") + 3, F.length(url)), "#.*$", "")
    authority = F.translate(F.regexp_extract(rest, "^[^/?]*", 0), _UPPER, _LOWER)
    host = F.regexp_replace(F.regexp_replace(authority, "^www[.]", ""), ":(80|443)$", "")
    after = F.substring(rest, F.length(authority) + 1, F.length(url))
    path = F.regexp_extract(after, "^[^?]*", 0)
    query = F.split(F.regexp_extract(after, "[?](.*)$", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike("^(" + "|".join(TRACKING) + ")(=|$)"))), "&")
    return F.when(F.instr(url, "://") > 0, F.concat(
        host, F.when(path == "", "/").otherwise(path), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(records: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """What each revisit record stands for.

    records: record_id, url, ts (any ordered number or timestamp), kind
    (`response`, `revisit` or other), status (int), headers (map of lower-case
    names), payload_digest. Full responses are responses with status 200 and a
    time and canonical URL. Returns for each revisit record_id, canonical_url,
    ts, refers_to (record_id of the latest full response with a smaller time; of
    equally late ones the largest id), outcome, and for resolved ones the merged
    headers and the payload_digest; null otherwise.

    outcome: `resolved`; `no earlier response`; `etag differs` or `last-modified
    differs` if the revisit has that validator (the etag, compared weakly, counts
    first) and the response's is missing or another; `digest differs` if neither
    validator is given and both digests are and differ. Headers of the revisit in
    PERMITTED replace or extend those of the response. Null headers are no
    headers. Revisits without a time or canonical URL have no earlier response;
    repeated rows are resolved each by itself. A URL or a time of any number of records is
    spread over blocks of block_rows. Empty tables give empty results;
    other columns don't matter.
    """
    rows = records.select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), "ts", "kind", "status",
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"), "payload_digest")
    full = F.coalesce((F.col("kind") == "response") & (F.col("status") == 200), F.lit(False)) & F.col("ts").isNotNull() & F.col("canonical_url").isNotNull()
    rows = rows.where(full | (F.col("kind") == "revisit"))
    response = F.when(full, F.struct("record_id", "headers", "payload_digest"))
    rows = rows.withColumn("response", response).withColumn("is_response", full)
    placed = F.col("canonical_url").isNotNull() & F.col("ts").isNotNull()
    # A revisit comes before the responses of its time, which are not earlier; what is equal in all is parted by its place in the input.
    order = ["canonical_url", "ts", "is_response", "record_id", "arrival"]
    arrived = rows.where(placed).withColumn("arrival", F.monotonically_increasing_id())
    # Written once, as the bounds of a sort are sampled anew each time it runs.
    ordered = cut_lineage(arrived.orderBy(*order).withColumn("row", F.monotonically_increasing_id()).drop("arrival"))
    block = F.struct(F.shiftright("row", _ROW_BITS).alias("part"), F.expr(f"(row & {(1 << _ROW_BITS) - 1}) div {block_rows}").alias("number"))
    ordered = ordered.withColumn("block", block)

    earlier = Window.partitionBy("canonical_url", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    near = ordered.withColumn("near", F.last("response", ignorenulls=True).over(earlier)).where("NOT is_response")
    left = ordered.groupBy("canonical_url", "block").agg(F.max_by("response", F.when(F.col("is_response"), F.col("row"))).alias("last"))
    # Every block that holds records of a URL gets what the blocks before it left.
    before = Window.partitionBy("canonical_url").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = left.withColumn("carried", F.last("last", ignorenulls=True).over(before)).where("carried IS NOT NULL").select("canonical_url", "block", "carried")
    source = F.coalesce("near", "carried")
    columns = ["record_id", "canonical_url", "ts", "headers", "payload_digest"]
    found = near.join(carried, ["canonical_url", "block"], "left").select(*columns, source.alias("source"))
    apart = rows.where(~placed & ~F.col("is_response")).select(*columns, F.lit(None).cast(rows.schema["response"].dataType).alias("source"))
    found = found.unionAll(apart)

    etag, modified = F.col("headers")["etag"], F.col("headers")["last-modified"]
    stored = F.col("source.headers")
    differs = (F.when(F.col("source").isNull(), "no earlier response")
               .when(etag.isNotNull(), F.when(~_weak(etag).eqNullSafe(_weak(stored["etag"])), "etag differs"))
               .when(modified.isNotNull(), F.when(~modified.eqNullSafe(stored["last-modified"]), "last-modified differs"))
               .when(F.col("payload_digest") != F.col("source.payload_digest"), "digest differs"))
    updates = F.map_filter("headers", lambda name, _: name.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(stored, lambda name, _: ~F.map_contains_key(updates, name)), updates)
    found = found.withColumn("outcome", F.coalesce(differs, F.lit("resolved")))
    resolved = F.col("outcome") == "resolved"
    return found.select(
        "record_id", "canonical_url", "ts", F.col("source.record_id").alias("refers_to"), "outcome",
        F.when(resolved, merged).alias("headers"), F.when(resolved, F.col("source.payload_digest")).alias("payload_digest"))


def captures(pages: DataFrame) -> DataFrame:
    """Archive records of the pages table, which has neither times nor headers: each page was fetched, and asked for again.

    The first capture of a page is a full response. The second, later one is a
    revisit under a variant of the URL; one in seven has changed since (another
    etag), one in eleven has only a date to compare, one in thirteen nothing.
    """
    page = F.col("page_id")
    etag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    digest = F.concat(F.lit("sha256:"), F.sha2(F.coalesce("html", F.lit("")), 256))
    day = (page * 7919) % 100_003
    first = F.struct(
        (page * 2).alias("record_id"), F.col("url").alias("url"), day.alias("ts"), F.lit("response").alias("kind"), F.lit(200).alias("status"),
        F.create_map(F.lit("etag"), etag, F.lit("last-modified"), F.concat(F.lit("day "), day.cast("string")), F.lit("content-type"),
                     F.lit("text/html"), F.lit("cache-control"), F.lit("max-age=60")).alias("headers"), digest.alias("payload_digest"))
    changed = F.when(page % 7 == 0, '"changed"').otherwise(F.concat(F.lit("W/"), etag))
    validators = (F.when(page % 13 == 0, F.create_map().cast("map<string,string>"))
                  .when(page % 11 == 0, F.create_map(F.lit("last-modified"), F.concat(F.lit("day "), day.cast("string"))))
                  .otherwise(F.create_map(F.lit("etag"), changed)))
    again = F.struct(
        (page * 2 + 1).alias("record_id"), F.concat("url", F.lit("#again")).alias("url"), (day + 1 + page % 5000).alias("ts"),
        F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        F.map_concat(validators, F.create_map(F.lit("cache-control"), F.lit("max-age=90"), F.lit("content-type"), F.lit("none"))).alias("headers"),
        digest.alias("payload_digest"))
    return pages.select(F.explode(F.array(first, again)).alias("r")).select("r.*")


def op7_warc_revisits(spark, sf_dir: str) -> DataFrame:
    """record_id, canonical_url, refers_to, outcome, merged headers as text, and payload_digest of every revisit."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = resolve_revisits(captures(pages))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return found.select("record_id", "canonical_url", "refers_to", "outcome", text.alias("headers"), "payload_digest")


OP7_SQL = r"""
WITH base AS (
    SELECT page_id, url, '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS etag, 'sha256:' || sha256(coalesce(html, '')) AS digest,
           (page_id * 7919) % 100003 AS day, regexp_replace(substr(url, strpos(url, '://') + 3), '#.*$', '') AS rest
    FROM pages),
parts AS (
    SELECT *, translate(regexp_extract(rest, '^[^/?]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS authority,
           substr(rest, length(regexp_extract(rest, '^[^/?]*')) + 1) AS after FROM base),
canonical AS (
    SELECT *, CASE WHEN strpos(url, '://') > 0 THEN
        regexp_replace(regexp_replace(authority, '^www[.]', ''), ':(80|443)$', '')
        || CASE WHEN regexp_extract(after, '^[^?]*') = '' THEN '/' ELSE regexp_extract(after, '^[^?]*') END
        || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS canonical_url
    FROM (SELECT *, array_to_string(list_sort(list_filter(string_split(regexp_extract(after, '[?](.*)$', 1), '&'),
              lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|fbclid|gclid|ref|sessionid)(=|$)'))), '&') AS query FROM parts)),
full_responses AS (
    SELECT canonical_url AS url, day AS ts, max(page_id) AS page_id FROM canonical WHERE canonical_url IS NOT NULL GROUP BY ALL),
revisits AS (
    SELECT page_id * 2 + 1 AS record_id, canonical_url, day + 1 + page_id % 5000 AS ts, digest,
           CASE WHEN page_id % 13 = 0 OR page_id % 11 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '"changed"' ELSE 'W/' || etag END AS etag,
           CASE WHEN page_id % 13 <> 0 AND page_id % 11 = 0 THEN 'day ' || day END AS modified
    FROM canonical),
joined AS (
    SELECT r.*, f.page_id AS source FROM revisits r ASOF LEFT JOIN full_responses f ON r.canonical_url = f.url AND r.ts > f.ts),
checked AS (
    SELECT j.*, s.etag AS stored_etag, s.day AS stored_day, s.digest AS stored_digest,
        CASE WHEN source IS NULL THEN 'no earlier response'
             WHEN j.etag IS NOT NULL THEN CASE WHEN regexp_replace(j.etag, '^W/', '') = s.etag THEN 'resolved' ELSE 'etag differs' END
             WHEN modified IS NOT NULL THEN CASE WHEN modified = 'day ' || s.day THEN 'resolved' ELSE 'last-modified differs' END
             WHEN j.digest <> s.digest THEN 'digest differs' ELSE 'resolved' END AS outcome
    FROM joined j LEFT JOIN base s ON s.page_id = source)
SELECT record_id, canonical_url, source * 2 AS refers_to, outcome,
       CASE WHEN outcome = 'resolved' THEN 'cache-control=max-age=90;content-type=text/html;etag=' || coalesce(etag, stored_etag)
            || ';last-modified=day ' || stored_day END AS headers,
       CASE WHEN outcome = 'resolved' THEN stored_digest END AS payload_digest
FROM checked
"""
