"""URL filters: rules, and for the rest link-graph propagation over hosts (operator 6).

Rules allow or block a host with its subdomains below a path; the longest one
that fits a URL wins. URLs without a rule are judged by their host. Hosts with
allowed pages are trusted seeds and hosts with blocked pages distrusted ones,
each weighted by its share of such pages. Trust follows the links between hosts
(personalised PageRank), distrust runs against them, from a blocked host to
those that link to it. A host is blocked if its distrust outweighs its trust.

Only DataFrame functions are used. Both scores are sums over walks: each step
joins the mass that arrived at the hosts with their edges and adds it up per
target, which combines before the shuffle. Hosts without mass are in no join.
Edges are distinct pairs of hosts; those of a host with very many, and the pages
of a host with very many, are spread over salted keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratestar.session import cut_lineage

#: Up to so many rules become one expression; more are a table that hosts and paths are looked up in.
MOST_IN_EXPRESSION = 1_000
DAMPING, STEPS = 0.85, 20
#: Distrust must be over so many times the trust.
RATIO = 1.0
SALTS = 8
#: Steps between two cuts of the lineage.
CUT_EVERY = 4
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s>]+)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A verdict, `allow` or `block`, for hosts and paths that begin with `text`, like `example.org/en/`."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]


RULES = (Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"), Rule("allow", "com/fr/"),
         Rule("block", "com/de/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and without `://`."""
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(url)), "^[^?#]*", 0)
    return F.when(known, F.translate(host, _UPPER, _LOWER)).otherwise(""), F.when(known, path).otherwise("")


def winning_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null without one; of equal ones a block, then the first, wins.

    An expression with a branch for each rule.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: (len(r.text), r.verdict == "block")):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def rules_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """(place, text, verdict) of rules."""
    return spark.createDataFrame([(i, r.text, r.verdict) for i, r in enumerate(rules)], "place long, text string, verdict string")


def ruled_by_table(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds `rule` and `ruled` to urls with a host and path, as winning_rule does, for any number of rules (place, text, verdict).

    The distinct hosts with their domains meet the rules' hosts first; a host's URLs are joined with the rules that
    fit it, and those whose path fits are compared. Rows are numbered, and a host with very many is spread over salted keys.
    """
    split = F.instr("text", "/")
    own = rules.select("place", "text", "verdict", F.when(split > 0, F.substring(F.col("text"), F.lit(1), split - 1)).otherwise(F.col("text")).alias("domain"),
                       F.when(split > 0, F.substring(F.col("text"), split, F.length("text"))).otherwise("").alias("begin"))
    labels = F.split("host", "[.]")
    domains = urls.select("host").distinct().select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("domain"))
    fitting = domains.join(own, "domain").groupBy("host").agg(F.collect_list(F.struct("begin", "text", "verdict", "place")).alias("rules"))
    salted = fitting.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    with_rules = urls.withColumn("salt", F.pmod(F.xxhash64("id", "path"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    # The last in this order wins: the longest, a block before an allow, the first given.
    best = F.array_max(F.transform(F.filter("rules", lambda r: F.startswith(F.col("path"), r["begin"])), lambda r: F.struct(
        F.length(r["text"]).alias("length"), (r["verdict"] == "block").alias("blocks"), (-r["place"]).alias("first"), r["text"].alias("text"), r["verdict"].alias("verdict"))))
    return with_rules.withColumn("best", best).select(*urls.columns, F.col("best.text").alias("rule"), F.col("best.verdict").alias("ruled"))


def host_links(pages: DataFrame, host: Column, html_col: str = "html") -> DataFrame:
    """(src, dst): the distinct pairs of a page's host and another host that it links to."""
    links = pages.select(host.alias("src"), F.explode(F.regexp_extract_all(html_col, F.lit(_LINK), 1)).alias("dst"))
    return (links.select("src", F.translate("dst", _UPPER, _LOWER).alias("dst"))
            .where((F.col("src") != F.col("dst")) & (F.col("src") != "")).distinct())


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, steps: int = STEPS) -> DataFrame:
    """(kind, host, score) of walks from seeds (kind, host, mass) along edges (kind, src, dst).

    A walk goes on with probability `damping`, to each target alike, and ends
    where there is none. The score of a host is the mass of walks that stop at
    it, up to so many steps; what lies beyond is under damping ** steps.
    """
    salt = F.pmod(F.xxhash64("dst"), F.lit(SALTS)).cast("int")
    degrees = edges.groupBy("kind", "src").agg(F.count("*").alias("degree"))
    salted = cut_lineage(edges.withColumn("salt", salt).join(
        degrees.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["kind", "src", "salt"])
        .select("kind", "src", "salt", "dst", (F.lit(damping) / F.col("degree")).alias("share")))
    mass = cut_lineage(seeds)
    total = mass
    if not salted.isEmpty():
        for step in range(1, steps + 1):
            spread = mass.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            mass = (salted.join(spread.withColumnRenamed("host", "src"), ["kind", "src", "salt"])
                    .groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.col("mass") * F.col("share")).alias("mass")))
            total = total.unionByName(mass).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
            if step % CUT_EVERY == 0:
                mass, total = cut_lineage(mass), cut_lineage(total)
                if mass.isEmpty():
                    break
    return total.select("kind", "host", (F.col("mass") * (1 - damping)).alias("score"))


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] | DataFrame = RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               damping: float = DAMPING, steps: int = STEPS, ratio: float = RATIO) -> DataFrame:
    """A verdict for the URL of every page, by the longest fitting rule or else by the host's scores.

    Returns the id, host, path, rule (its text; null without one), verdict
    (`allow` or `block`), trust and distrust (0 for hosts that neither reaches).
    URLs that are null or have no `://` have an empty host and path, no rule, and
    are allowed. Null html has no links. Rows that repeat an id are judged each
    by itself, and count each as a page of its host. Rules of any number may be given, as Rule objects or as a table of
    place, text and verdict; a host with very many rules of its own holds them together. Scores are compared after
    rounding to 12 places. Empty tables give empty results; other columns don't
    matter.
    """
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    if isinstance(rules, tuple) and len(rules) <= MOST_IN_EXPRESSION:
        rule, verdict = winning_rule(F.col("host"), F.col("path"), rules)
        judged = split.withColumns({"rule": rule, "ruled": verdict})
    else:
        judged = ruled_by_table(split, rules_table(pages.sparkSession, rules) if isinstance(rules, tuple) else rules)
    counts = judged.where("ruled IS NOT NULL").groupBy("ruled", "host").agg(F.count("*").alias("n"))
    totals = counts.groupBy("ruled").agg(F.sum("n").alias("all"))
    seeds = counts.join(F.broadcast(totals), "ruled").select(F.col("ruled").alias("kind"), "host", (F.col("n") / F.col("all")).alias("mass"))
    links = cut_lineage(host_links(pages, host, html_col))
    edges = (links.select(F.lit("allow").alias("kind"), "src", "dst")
             .unionAll(links.select(F.lit("block").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"))))
    scores = (propagate(seeds, edges, damping, steps).groupBy("host")
              .agg(F.round(F.sum(F.when(F.col("kind") == "allow", F.col("score")).otherwise(0.0)), 12).alias("trust"),
                   F.round(F.sum(F.when(F.col("kind") == "block", F.col("score")).otherwise(0.0)), 12).alias("distrust")))
    # A host with a third of all pages is joined under several keys.
    salted = scores.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = judged.withColumn("salt", F.pmod(F.xxhash64("id", "path"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    return found.select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("ruled", F.when(distrust > trust * ratio, "block").otherwise("allow")).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"))


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = r"""
WITH RECURSIVE split AS (
    SELECT page_id, html, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS sep FROM pages),
parts AS (
    SELECT page_id, html, sep, regexp_extract(substr(url, sep + 3), '^[^/?#]*') AS raw_host, substr(url, sep + 3) AS rest FROM split),
urls AS (
    SELECT page_id, html,
           CASE WHEN sep > 0 THEN translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
           CASE WHEN sep > 0 THEN regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') ELSE '' END AS path FROM parts),
judged AS (
    SELECT *, CASE WHEN rule IS NULL THEN NULL WHEN rule IN ('org/', 'com/fr/') THEN 'allow' ELSE 'block' END AS ruled
    FROM (SELECT page_id, html, host, path, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM urls)),
links AS (
    SELECT DISTINCT src, dst FROM (
        SELECT host AS src, translate(unnest(regexp_extract_all(
            html, '(?i)<a\s[^>]*?href\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"''\s>]+)', 1)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM judged)
    WHERE src <> dst AND src <> ''),
edges AS (
    SELECT kind, src, dst, 0.85::DOUBLE / count(*) OVER (PARTITION BY kind, src) AS share
    FROM (SELECT 'allow' AS kind, src, dst FROM links UNION ALL SELECT 'block', dst, src FROM links)),
walk AS (
    SELECT 0 AS step, ruled AS kind, host, count(*) / sum(count(*)) OVER (PARTITION BY ruled) AS mass
    FROM judged WHERE ruled IS NOT NULL GROUP BY ruled, host
    UNION ALL
    SELECT step + 1, walk.kind, edges.dst, sum(mass * share)
    FROM walk JOIN edges ON edges.kind = walk.kind AND edges.src = walk.host WHERE step < 20 GROUP BY step, walk.kind, edges.dst),
scores AS (
    SELECT host, round(coalesce(sum(mass) FILTER (WHERE kind = 'allow'), 0) * (1 - 0.85::DOUBLE), 12) AS trust,
           round(coalesce(sum(mass) FILTER (WHERE kind = 'block'), 0) * (1 - 0.85::DOUBLE), 12) AS distrust
    FROM walk GROUP BY host)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN scores USING (host)
"""
