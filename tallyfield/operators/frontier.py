"""Which pages a crawl would take: frontier, robots, admission, fresh links by page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tallyfield.plans.scratch import stage, unstage

DELAY_SECONDS = 1.5
AGENT = "*"


def frontier(links: DataFrame, fetches: DataFrame, limit: int | None = None) -> DataFrame:
    """Pages in the order a crawl takes them: source, listing, pos, url, final_url.

    links: source, listing (number), pos, url; fetches: url, final_url, ok.  Without a limit
    each final url counts once, where it comes first, by aggregation.  With one, at most
    `limit` fetches of a listing succeed, those that land on known pages included.
    """
    rows = links.join(fetches, "url").filter("ok").select("source", "listing", "pos", "url", "final_url")
    if limit is None:
        first = F.min(F.struct("listing", "pos", "url")).alias("m")
        return rows.groupBy("source", "final_url").agg(first).select("source", "m.listing", "m.pos", "m.url", "final_url")
    return _limited(rows, limit)


def _limited(rows: DataFrame, limit: int) -> DataFrame:
    """What a source's crawl takes, by rounds over all links at once.

    A link is fetched unless its url is known, and its page is taken unless the final url is;
    known is what earlier links have taken, and the limit cuts each listing.  A round takes what
    the round before has taken as known and judges every link anew.  Its verdicts on the first
    links of a source are right, and with each round those of more; when no verdict changes they
    are what the links taken one by one would give, since each rests on earlier ones only.  Few
    links wait for long chains of others, so rounds are few.  Keys are urls and listings: a
    source's links are spread over tasks, and a listing is one page's links."""
    order = F.struct("listing", "pos", "url")
    key = ["source", "listing", "pos", "url"]
    within = Window.partitionBy("source", "listing").orderBy("pos", "url").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    now = stage(rows.withColumns({"kept": F.lit(True), "was": F.lit(False)}), "frontier")
    while not now.filter("kept <> was").isEmpty():
        entered = now.filter("kept").select("source", order.alias("at"), F.explode(F.array_distinct(F.array("url", "final_url"))).alias("known"))
        first = stage(entered.groupBy("source", "known").agg(F.min("at").alias("first")), "known")
        by_url = first.select("source", F.col("known").alias("url"), F.col("first").alias("url_first"))
        by_final = first.select("source", F.col("known").alias("final_url"), F.col("first").alias("final_first"))
        judged = now.select(*key, "final_url", F.col("kept").alias("was")).join(by_url, ["source", "url"], "left").join(by_final, ["source", "final_url"], "left")
        fetched = F.coalesce(F.col("url_first") >= order, F.lit(True))
        judged = judged.withColumn("fetched", fetched).withColumn("n", F.sum(F.col("fetched").cast("int")).over(within))
        kept = F.col("fetched") & (F.col("n") <= limit) & F.coalesce(F.col("final_first") >= order, F.lit(True))
        old, now = now, stage(judged.select(*key, "final_url", kept.alias("kept"), "was"), "frontier")
        unstage(old)
        unstage(first)
    return now.filter("kept").select(*key, "final_url")


def _unquoted(x: Column) -> Column:
    """Percent-decoded; as it stands where that can't be done."""
    return F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)


def robots_rules(robots: DataFrame, agent: str = AGENT) -> DataFrame:
    """(host, rules, crawl_delay): what (host, robots_txt) tells an agent: its rules in order, and its delay.

    Lines that name agents begin an entry, which an empty line ends; rules before any agent, and
    agents without a rule, count for nothing.  The first entry that names the agent holds, else the
    first for all.  An entry is told by counts over the file's lines; a host's file is one page."""
    lines = robots.select("host", F.posexplode(F.split("robots_txt", r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")).alias("n", "line"))
    body = F.btrim(F.regexp_replace("line", "(?s)#.*$", ""), F.lit(" \t"))
    named = F.lower(F.btrim(F.split_part(body, F.lit(":"), F.lit(1)), F.lit(" \t")))
    value = _unquoted(F.btrim(F.regexp_replace(body, "(?s)^[^:]*:", ""), F.lit(" \t")))
    field = F.when(F.col("line") == "", "end").when(body.contains(":"), named)
    kind = F.when(field == "user-agent", "agent").when(field == "end", "end").when(field.isin("allow", "disallow", "crawl-delay", "request-rate"), "rule")
    events = lines.select("host", "n", kind.alias("kind"), field.alias("field"), value.alias("value")).filter("kind is not null")
    file = Window.partitionBy("host").orderBy("n")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    opens = (F.col("kind") == "agent") & F.coalesce(F.lag("kind").over(file) != "agent", F.lit(True))
    heard = F.last(F.when(F.col("kind") != "rule", F.col("kind")), ignorenulls=True).over(before)
    events = events.withColumns({"opens": opens, "heard": heard}).withColumn("entry", F.sum(F.col("opens").cast("int")).over(file))
    counted = events.filter("kind = 'agent' or kind = 'rule' and heard = 'agent'")
    is_rule = F.col("field").isin("allow", "disallow")
    allow = (F.col("field") == "allow") | (F.col("value") == "")
    rule = F.struct("n", allow.alias("allow"), F.regexp_replace("value", r"\?$", "").alias("path"))
    entries = counted.groupBy("host", "entry").agg(
        F.array_sort(F.collect_list(F.when(is_rule, rule))).alias("rules"),
        F.max_by("value", F.when((F.col("field") == "crawl-delay") & F.col("value").rlike("^[0-9]+$"), F.col("n"))).alias("delay"),
        F.bool_or(F.col("kind") == "rule").alias("any"),
        F.bool_or((F.col("kind") == "agent") & (F.col("value") == "*")).alias("for_all"),
        F.bool_or((F.col("kind") == "agent") & F.lit(agent.split("/")[0].lower()).contains(F.lower("value"))).alias("for_me"),
    ).filter("any and (for_all or for_me)")
    chosen = F.min_by(F.struct("rules", "delay"), F.struct("for_all", "entry"))
    return entries.groupBy("host").agg(chosen.alias("e")).select("host", "e.rules", F.col("e.delay").cast("double").alias("crawl_delay"))


def robots_filter(urls: DataFrame, robots: DataFrame, agent: str = AGENT, delay: float = DELAY_SECONDS) -> DataFrame:
    """(host, url, allowed, delay): the first rule that begins a url's path decides; a host without rules allows all; delays are never below `delay`.

    Rules are joined to the urls, so a host with many urls is many tasks."""
    path = F.regexp_replace(F.regexp_replace(_unquoted(F.col("url")), r"^[A-Za-z][A-Za-z0-9+.-]*:", ""), r"^//[^/?#]*", "")
    path = F.regexp_replace(F.regexp_replace(path, "#$", ""), r"\?(?=#|$)", "")
    rows = urls.join(robots_rules(robots, agent), "host", "left").withColumn("path", F.when(path == "", "/").otherwise(path))
    first = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    return rows.select("host", "url", F.coalesce(first["allow"], F.lit(True)).alias("allowed"), F.greatest(F.lit(delay), F.coalesce("crawl_delay", F.lit(delay))).alias("delay"))


def _is_page() -> Column:
    kind = F.lower(F.coalesce("content_type", F.lit("")))
    return F.col("url").rlike(r"^https?://[^/?#]") & (F.col("status") == 200) & (kind.contains("html") | kind.contains("xml"))


def admitted(fetches: DataFrame) -> DataFrame:
    """Responses that count as pages: web url with a host, status 200, html or xml."""
    return fetches.filter(_is_page())


def _counts(allowed: str) -> list[Column]:
    ok, free = F.coalesce(_is_page(), F.lit(False)), F.coalesce(F.col(allowed), F.lit(True))
    return [F.count_if(free & ok).alias("n_ok"), F.count_if(free & ~ok).alias("n_failed"), F.count_if(~free).alias("n_blocked")]


def fetch_counts(fetches: DataFrame, allowed: str = "allowed") -> DataFrame:
    return fetches.agg(*_counts(allowed))


def save_fetches(fetches: DataFrame, path: str, allowed: str = "allowed") -> DataFrame:
    """Write the pages among allowed fetches and give `fetch_counts` of all, as metrics of the writing job."""
    seen = Observation()
    free = F.coalesce(F.col(allowed), F.lit(True))
    admitted(fetches.observe(seen, *_counts(allowed)).filter(free)).write.mode("overwrite").parquet(path)
    names = ("n_ok", "n_failed", "n_blocked")
    return fetches.sparkSession.createDataFrame([tuple(seen.get[n] for n in names)], ", ".join(f"{n} long" for n in names))


def fresh_links(links: DataFrame) -> DataFrame:
    """(listing, page, n_links, n_fresh) up to and with the first page of a listing that has nothing new.

    links: listing, page, url."""
    one = links.select("listing", "page", "url").distinct()
    first = one.groupBy("listing", "url").agg(F.min("page").alias("page"))
    fresh = first.groupBy("listing", "page").agg(F.count("*").alias("n_fresh"))
    pages = one.groupBy("listing", "page").agg(F.count("*").alias("n_links")).join(fresh, ["listing", "page"], "left")
    pages = pages.withColumn("n_fresh", F.coalesce("n_fresh", F.lit(0)))
    before = Window.partitionBy("listing").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)  # a row for each page
    stopped = F.coalesce(F.max((F.col("n_fresh") == 0).cast("int")).over(before), F.lit(0))
    return pages.withColumn("stopped", stopped).filter("stopped = 0").drop("stopped")
