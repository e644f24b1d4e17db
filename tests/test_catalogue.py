"""Merging, matching, clusters, upserts, frontier and payloads: hand cases and brute force."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import text as T
from tallyfield.operators import cluster, commits, compare, frontier, merge, payload, upsert
from tallyfield.operators.graph import components
from tallyfield.sources import products as tables
from tallyfield.streaming import upserts


def test_payloads(spark):
    h = json.dumps({"title": "<b>N</b>", "price": 25000000, "variants": [{"sku": "", "inventory_quantity": -3}, {"sku": "s", "inventory_quantity": 5}, {"inventory_quantity": "7"}], "images": ["/i.jpg", "//c.vn/j.jpg"]})
    w = json.dumps([{"id": 3, "average_rating": "0.00", "prices": {"price": "1050", "currency_minor_unit": 2}, "variations": [{"id": 1, "attributes": [{"value": "x"}, {"value": "y"}]}]}])
    rows = spark.createDataFrame([("https://a.vn/p/q", h, w), ("https://a.vn/p", '{"title": "t"}', "[]"), ("https://a.vn/p", '{"variants": []}', "bad")], "u string, h string, w string")
    got = rows.select(payload.parse_haravan(F.col("h"), F.col("u")).alias("h"), payload.parse_woo(F.col("w")).alias("w")).collect()
    assert (got[0].h.name, got[0].h.price, got[0].h.sku, got[0].h.stock_qty) == ("N", 250000.0, "s", 5)
    assert got[0].h.images == ["https://a.vn/i.jpg", "https://c.vn/j.jpg"]
    assert (got[0].w.price, got[0].w.rating, got[0].w.review_count, got[0].w.variants[0].title) == (10.5, 0.0, 0, "x / y")
    assert got[1].h is None and got[1].w is None and got[2].h.stock_qty is None and got[2].w is None


def test_jsonld(spark):
    ld = lambda x: f'<script type="application/ld+json">{x}</script>'
    one = json.dumps({"@graph": [{"@type": "WebPage"}, {"@type": "Product", "name": "n", "image": "i.jpg", "brand": "b", "offers": [{"price": "5", "availability": "https://schema.org/OutOfStock"}], "aggregateRating": {"ratingValue": 0, "reviewCount": 2}}]})
    rows = spark.createDataFrame([(ld("{bad") + ld(one),), (ld('{"@type": "Thing"}'),), ("",)], "html string")
    a, b, c = (r.d for r in rows.select(payload.parse_jsonld(F.col("html")).alias("d")).collect())
    assert (a.name, a.price, a.in_stock, a.vendor, a.images, a.rating, a.review_count) == ("n", 5.0, False, "b", ["i.jpg"], None, 2)
    assert b is None and c is None


def test_merge_without_payload_changes_platform_only(spark):
    page = tables.with_all_columns(spark.createDataFrame([("u", 10.0, "B", "s0")], "url string, price double, brand string, sku string"))
    none = spark.createDataFrame([("u", "woocommerce")], "url string, platform string").withColumns({"d": F.lit(None).cast(tables.STRUCTURED), "reviews": F.lit(None).cast(tables.PRODUCTS["reviews"].dataType)})
    r = merge.merge_structured(page, none).first()
    assert (r.price, r.brand, r.sku, r.platform) == (10.0, "B", "s0", "woocommerce")
    given = none.withColumn("d", payload._record(F.lit(True), name=F.lit("NPK 1-2-3 bao 5kg")))
    r = merge.merge_structured(page, given).first()
    assert (r.price, r.brand, r.sku, r.npk, r.pack_kg) == (10.0, "B", None, "1-2-3", 5.0)


def test_reparse_is_a_fixed_point(spark):
    rows = spark.createDataFrame([("NPK 16-16-8 bao 50kg", None, "x", None, None), ("Kali", "gói 100g", None, None, "túi")], "name string, description string, npk string, pack_kg double, unit string")
    once = merge.reparse(rows)
    assert [(r.npk, r.pack_kg, r.unit, r.changed) for r in once.collect()] == [("16-16-8", 50.0, "bao 50kg", True), (None, 0.1, "gói 100g", True)]
    assert merge.reparse_counts(merge.reparse(once.drop("changed", "newly_parsed"))).first().updated == 0


def items_of(spark, seed, n=60):
    r = random.Random(seed)
    words = ["dau", "trau", "sao", "vang", "lua", "xanh", "hoa", "qua1", "npk"]
    rows = [(k, f"shop{r.randrange(4)}", " ".join(r.sample(words, r.randint(1, 9))), r.choice([None, "16-16-8", "20-20-15", "7-7-7"]), r.choice([10.0, 20.0, 40.0, 41.0, 100.0])) for k in range(n)]
    return rows, spark.createDataFrame(rows, "item_id long, source string, name string, npk string, per_kg double")


def brute_matches(rows):
    tokens = lambda name: {w for w in name.split() if len(w) > 2 and w not in T.STOPWORDS}
    out = {}
    for a, b in itertools.combinations(rows, 2):
        a, b = sorted((a, b), key=lambda x: x[1])
        if a[1] == b[1] or a[3] and b[3] and a[3] != b[3] or max(a[4], b[4]) / min(a[4], b[4]) > 4:
            continue
        same, score = bool(a[3]) and a[3] == b[3], len(tokens(a[2]) & tokens(b[2]))
        if score >= (1 if same else 3):
            out[a[0], b[0]] = (same, score)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_matching_equals_brute_force(spark, seed):
    rows, df = items_of(spark, seed)
    want = brute_matches(rows)
    found = compare.matches(df)
    got = {(r.a_id, r.b_id): (r.same, r.score) for r in found.collect()}
    assert got == want
    source = {r[0]: r[1] for r in rows}
    best = {}
    for (a, b), (same, score) in want.items():
        for x, y in ((a, b), (b, a)):
            key, rank = (x, source[y]), score + 5 * same
            if key not in best or (rank, -y) > (best[key][0], -best[key][1]):
                best[key] = (rank, y)
    mutual = sorted((a, b) for (a, b) in want if best[a, source[b]][1] == b and best[b, source[a]][1] == a)
    chosen = compare.best_matches(df)
    assert {((r.a_id, r.source_b), (r.rank, r.b_id)) for r in chosen.collect()} == set(best.items())
    pairs = compare.mutual_pairs(chosen)
    got_pairs = [(r.a_id, r.b_id, r.score, r.source_a, r.source_b) for r in pairs.collect()]
    assert sorted(p[:2] for p in got_pairs) == mutual
    # component by component equals all at once
    ordered = sorted(got_pairs, key=lambda p: (-p[2], p[3], p[4], p[0]))
    assert clusters_of(pairs) == greedy([p[:3] for p in ordered])


@pytest.mark.parametrize("seed", [11, 12])
def test_best_matches_over_all_prices(spark, seed):
    """Prices of every step, many a ratio of four apart but for a little, and items that are alike in all but the id."""
    r = random.Random(seed)
    words = ["dau", "trau", "sao", "vang", "lua", "xanh", "hoa"]
    price = lambda: r.choice([4.0 ** (r.randrange(-8, 24) / 16), 10 * 4.0 ** r.randrange(3) * r.choice([1, 1.0000001, 0.9999999]), 4 ** r.uniform(-1, 3)])
    rows = [(k, f"shop{r.randrange(3)}", " ".join(r.sample(words, r.randint(1, 6))), r.choice([None, "", "16-16-8", "7-7-7"]), price()) for k in range(150)]
    rows += [(200 + k, *x[1:]) for k, x in enumerate(rows[:30])]
    want, source = {}, {x[0]: x[1] for x in rows}
    for (a, b), (same, score) in brute_matches(rows).items():
        for x, y in ((a, b), (b, a)):
            found = (score + 5 * same, -y, score)
            want[x, source[y]] = max(found, want.get((x, source[y]), found))
    df = spark.createDataFrame(rows, "item_id long, source string, name string, npk string, per_kg double")
    got = {(x.a_id, x.source_b): (x["rank"], -x.b_id, x.score) for x in compare.best_matches(df).collect()}
    assert got == want


def test_alike_items_of_many_shops_are_not_paired(spark, monkeypatch):
    """Forty names of one formula in eight shops: 44,800 pairs match; tables stay as large as the result."""
    rows = [(40 * s + k, f"shop{s}", f"npk word{k} name{k % 7}", "7-7-7", 10.0 + k / 10) for s in range(8) for k in range(40)]
    sizes, stage = {}, compare.stage
    monkeypatch.setattr(compare, "stage", lambda df, name: sizes.update({name: max(sizes.get(name, 0), (out := stage(df, name)).count())}) or out)
    df = spark.createDataFrame(rows, "item_id long, source string, name string, npk string, per_kg double")
    best = {(r.a_id, r.source_b): (r.b_id, r.score) for r in compare.best_matches(df).collect()}
    assert best == {(40 * s + k, f"shop{z}"): (40 * z + k, 3) for s in range(8) for z in range(8) if s != z for k in range(40)}
    assert max(sizes.values()) <= 8 * len(rows), sizes


def test_price_ratio_limit(spark):
    rows = [(1, "a", "dau trau sao", None, 100.0), (2, "b", "dau trau sao", None, 400.0), (3, "c", "dau trau sao", None, 401.0)]
    got = compare.matches(spark.createDataFrame(rows, "item_id long, source string, name string, npk string, per_kg double")).collect()
    assert sorted((r.a_id, r.b_id) for r in got) == [(1, 2), (2, 3)]


def greedy(pairs):
    """The rule, pair by pair: members and worst score of each cluster, pairs of (a, b, score) in order."""
    score, clusters = {frozenset(p[:2]): p[2] for p in pairs}, []
    for a, b, _ in pairs:
        for c in clusters:
            new = {a, b} - c
            if len(new) < 2 and all(frozenset((n, m)) in score for n in new for m in c):
                c |= new
                break
        else:
            if not any({a, b} & c for c in clusters):
                clusters.append({a, b})
    return sorted((tuple(sorted(c)), min(score[frozenset(x)] for x in itertools.combinations(c, 2))) for c in clusters)


def clusters_of(pairs):
    found = {}
    for r in cluster.clusters(pairs).collect():
        found.setdefault((r.cluster_id, r.worst), []).append(r.item_id)
    return sorted((tuple(sorted(items)), worst) for (_, worst), items in found.items())


PAIRS = "a_id long, b_id long, score long, source_a string, source_b string"


def test_clusters_overlap(spark):
    rows = [(1, 2, 9), (3, 4, 8), (1, 3, 7), (2, 3, 6)]
    assert greedy(rows) == [((1, 2, 3), 6), ((3, 4), 8)]
    df = spark.createDataFrame([(a, b, s, f"s{a}", f"s{b}") for a, b, s in rows], PAIRS)
    assert clusters_of(df) == greedy(rows)
    assert {r.cluster_id for r in cluster.clusters(df).collect()} == {"1-2", "3-4"}
    assert cluster.clusters(df.filter("false")).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_clusters_of_random_mutual_pairs(spark, seed):
    """Matchings between shops, dense enough for one component with long chains of pairs that wait."""
    r = random.Random(seed)
    shops = {f"s{k}": list(range(100 * k, 100 * k + 25)) for k in range(5)}
    pairs = []
    for (s, left), (t, right) in itertools.combinations(shops.items(), 2):
        size = r.randrange(10, 25)
        pairs += [(a, b, r.randrange(1, 4), s, t) for a, b in zip(r.sample(left, size), r.sample(right, size), strict=True)]
    ordered = sorted(pairs, key=lambda p: (-p[2], p[3], p[4], p[0]))
    assert clusters_of(spark.createDataFrame(pairs, PAIRS)) == greedy([p[:3] for p in ordered])


def test_report_confidence(spark):
    items = spark.createDataFrame([(1, "a", "x", None, 10.0), (2, "b", "x", None, 20.0), (3, "a", "y", "1-1-1", 5.0), (4, "b", "y", "1-1-1", 5.0)], "item_id long, source string, name string, npk string, per_kg double")
    members = spark.createDataFrame([("p", 1, 4), ("p", 2, 4), ("q", 3, 1), ("q", 4, 1)], "cluster_id string, item_id long, worst long")
    rows = {r.item_id: r for r in cluster.cluster_report(members, items).collect()}
    assert (rows[1].confidence, rows[3].confidence, rows[2].gap_pct, rows[1].cheapest, rows[4].cheapest) == ("CHECK", "HIGH", 100.0, True, False)


@pytest.mark.parametrize("small", [0, 1000])
def test_components(spark, small):
    found = lambda edges: {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b", small).collect()}
    assert found([(1, 2), (2, 3), (9, 8), (5, 5), (7, 3), (None, 1)]) == {1: 1, 2: 1, 3: 1, 7: 1, 8: 8, 9: 8}
    assert found([]) == {} and found([(4, 4)]) == {}
    r = random.Random(small)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(55)] + [(k, k + 1) for k in range(100, 130)]
    of = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in of:
        for a, b in edges:
            if a != b:
                of[a] = of[b] = min(of[a], of[b])
    assert found(edges) == of


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("u", "s1", 1.0, 1), ("v", "s1", 2.0, 2)], "url string, source string, price double, seq long")
    new = spark.createDataFrame([("u", "s2", 5.0, 3), ("u", "s2", None, 4), ("w", "s3", 7.0, 5)], old.schema)
    once = upsert.upsert(old, new)
    assert sorted(map(tuple, once.collect())) == [("u", "s2", None, 4), ("v", "s1", 2.0, 2), ("w", "s3", 7.0, 5)]
    assert sorted(map(tuple, upsert.upsert(once, new).collect())) == sorted(map(tuple, once.collect()))


def test_frontier_limit_counts_redirects(spark):
    links = spark.createDataFrame([("s", 0, k, u) for k, u in enumerate(["a", "b", "c", "d"])] + [("s", 1, 0, "a"), ("s", 1, 1, "e")], "source string, listing int, pos int, url string")
    fetches = spark.createDataFrame([("a", "A", True), ("b", "A", True), ("c", "C", False), ("d", "D", True), ("e", "E", True)], "url string, final_url string, ok boolean")
    assert sorted(r.final_url for r in frontier.frontier(links, fetches, 2).collect()) == ["A", "E"]
    assert sorted(r.final_url for r in frontier.frontier(links, fetches).collect()) == ["A", "D", "E"]


def crawl(links, fetches, limit):
    """The rule, link by link."""
    out, seen, taken = [], {}, {}
    for source, listing, pos, url in sorted(links):
        known = seen.setdefault(source, set())
        final, ok = fetches.get(url, (None, False))
        if not ok or taken.get((source, listing), 0) >= limit or url in known:
            continue
        taken[source, listing] = taken.get((source, listing), 0) + 1
        if final not in known:
            known |= {url, final}
            out.append((source, listing, pos, url, final))
    return sorted(out)


@pytest.mark.parametrize("seed, limit", [(1, 2), (2, 3), (3, 1), (4, 50)])
def test_limited_frontier_equals_the_walk(spark, seed, limit):
    """Listings that overlap, with redirects to other links of the same and of earlier listings, and chains of them."""
    r = random.Random(seed)
    urls = [f"u{k}" for k in range(40)]
    fetches = {u: (u if r.random() < 0.5 else r.choice(urls), r.random() < 0.9) for u in urls}
    fetches |= {f"c{k}": (f"c{k + 1}", True) for k in range(12)}
    links = [(f"s{s}", n, pos, u) for s in range(3) for n in range(5) for pos, u in enumerate(r.sample(urls, r.randrange(4, 14)))]
    links += [("s9", 0, k, f"c{k}") for k in range(12)]
    df = spark.createDataFrame(links, "source string, listing int, pos int, url string")
    got = frontier.frontier(df, spark.createDataFrame([(u, *x) for u, x in fetches.items()], "url string, final_url string, ok boolean"), limit)
    assert sorted(map(tuple, got.collect())) == crawl(links, fetches, limit)
    assert frontier.frontier(df.filter("false"), spark.createDataFrame([], "url string, final_url string, ok boolean"), limit).collect() == []


def test_robots_and_admission(spark):
    urls = spark.createDataFrame([("h", "https://h/p"), ("h", "https://h/q"), ("i", "https://i/p")], "host string, url string")
    robots = spark.createDataFrame([("h", "User-agent: *\nDisallow: /p\nCrawl-delay: 9")], "host string, robots_txt string")
    got = {r.url: (r.allowed, r.delay) for r in frontier.robots_filter(urls, robots).collect()}
    assert got == {"https://h/p": (False, 9.0), "https://h/q": (True, 9.0), "https://i/p": (True, 1.5)}
    rows = spark.createDataFrame([("https://h/a", 200, "text/HTML"), ("ftp://h/a", 200, "text/html"), ("https://h/b", 200, None), ("https://h/c", 500, "text/html")], "url string, status int, content_type string")
    assert [r.url for r in frontier.admitted(rows).collect()] == ["https://h/a"]


@pytest.mark.parametrize("agent", ["*", "CrawlBot/2.0", "other"])
def test_robots_rules_equal_the_standard_parser(spark, agent):
    from urllib.robotparser import RobotFileParser

    r = random.Random(agent)
    line = lambda: r.choice(
        ["", "", " ", "# note", "User-agent: *", "user-agent : CrawlBot", "User-Agent: bot # x", "User-agent: nobody", "Disallow: /a", "Disallow:", "Allow: /a/b", "disallow: /a%2Fc?", "Allow: *",
         "Disallow: /q?x=1", "Disallow: /é", "Crawl-delay: 7", "Crawl-delay: 2.5", "Crawl-delay: 1", "Sitemap: s", "nonsense", "Disallow /z", "Request-rate: 1/5", "Disallow: /a+b", "Allow: /%zz"]
    )
    texts = {f"h{k}": r.choice(["\n", "\r\n"]).join(line() for _ in range(r.randrange(1, 14))) for k in range(150)}
    paths = ["", "/", "/a", "/a/b/c", "/a%2fc", "/a/c?d", "/q?x=1&y", "/q?", "/%C3%A9", "/é1", "/a+b", "/a b", "/%zz", "/x#frag", "/x?#"]
    urls = spark.createDataFrame([(h, f"https://{h}{p}") for h in texts for p in paths], "host string, url string")
    got = {x.url: (x.allowed, x.delay) for x in frontier.robots_filter(urls, spark.createDataFrame(list(texts.items()), "host string, robots_txt string"), agent).collect()}
    for host, text in texts.items():
        judge = RobotFileParser()
        judge.parse(text.splitlines())
        delay = max(1.5, float(judge.crawl_delay(agent) or 0))
        for p in paths:
            assert got[f"https://{host}{p}"] == (judge.can_fetch(agent, f"https://{host}{p}"), delay), (text, p)


def test_tolerant_schema_and_json_text(spark):
    df = tables.with_all_columns(spark.createDataFrame([(1, "u", ["i"])], "item_id long, url string, images array<string>"))
    assert df.schema == tables.PRODUCTS
    back = tables.from_json_text(tables.to_json_text(df)).first()
    assert back.images == ["i"] and back.specs is None


ARRIVALS = "url string, crawled_at string, seq long, price double"


def arrive(spark, path, rows, **options):
    """Let a stream over the files under path take rows, a file each."""
    for row in rows:
        spark.createDataFrame([row], ARRIVALS).coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(ARRIVALS).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    running = upserts.start_upserts(stream, f"{path}/out", f"{path}/ck", once=True, **options)
    running.awaitTermination()
    return sorted((r.url, r.price) for r in upserts.read_table(spark, f"{path}/out").collect())


@pytest.mark.parametrize("files", [1, 3])
def test_stream_state_does_not_depend_on_batches(spark, tmp_path, files):
    rows = [("u", "2024-01-02", 2, 1.0), ("u", "2024-01-01", 9, 2.0), ("v", "2024-01-01", 1, 3.0), ("u", "2024-01-02", 3, 4.0)]
    spark.createDataFrame(rows, ARRIVALS).repartition(files).write.parquet(f"{tmp_path}/in")
    assert arrive(spark, tmp_path, []) == [("u", 4.0), ("v", 3.0)]


def test_stream_goes_on_after_a_stop(spark, tmp_path):
    first = [(f"u{k}", "2024-01-01", k, float(k)) for k in range(4)]
    table = arrive(spark, tmp_path, first)
    assert table == [(r[0], r[3]) for r in first]
    more = [("u1", "2024-01-02", 9, 11.0), ("u1", "2024-01-03", 10, 12.0), ("w", "2024-01-01", 11, 13.0), ("u2", "2023-01-01", 99, 0.0)]
    assert arrive(spark, tmp_path, more) == sorted({**dict(table), "u1": 12.0, "w": 13.0}.items())
    assert commits.state(spark, f"{tmp_path}/out")["done"] == {"stream": 7}


ROWS = "url string, seq long, price double"


def put(spark, path, rows, **how):
    return commits.commit(spark.createDataFrame(rows, ROWS), path, **how)


def held(spark, path):
    return sorted((r.url, r.seq, r.price) for r in commits.read(spark, path).collect())


def test_commits_count_and_replace(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(ValueError, match="nothing"):
        commits.read(spark, path)
    one = put(spark, path, [("a", 1, 1.0), ("a", 2, 2.0), ("b", 9, 3.0)])
    assert (one["version"], one["before"], one["pushed"], one["after"]) == (1, 0, 2, 2)
    two = put(spark, path, [("b", 1, None), ("c", 1, 5.0)], base=1)
    assert (two["before"], two["pushed"], two["after"]) == (2, 2, 3) and held(spark, path) == [("a", 2, 2.0), ("b", 1, None), ("c", 1, 5.0)]
    assert put(spark, path, [])["after"] == 3 and len(held(spark, path)) == 3


def test_stale_and_repeated_batches(spark, tmp_path):
    path = f"{tmp_path}/t"
    put(spark, path, [("a", 1, 1.0)], batch=("w", 4))
    with pytest.raises(commits.StaleBase):
        put(spark, path, [("a", 2, 2.0)], base=0)
    assert put(spark, path, [("a", 3, 3.0)], batch=("w", 4))["version"] == 1 == put(spark, path, [("a", 3, 3.0)], batch=("w", 3))["version"]
    assert held(spark, path) == [("a", 1, 1.0)]
    # another writer takes the version while this one writes its rows
    rows = spark.createDataFrame([("a", 5, 5.0)], ROWS)
    real = commits.write_once

    def late(session, where, text):
        commits.write_once = real
        put(spark, path, [("z", 1, 1.0)])
        return real(session, where, text)

    commits.write_once = late
    try:
        with pytest.raises(commits.StaleBase, match="another"):
            commits.commit(rows, path)
    finally:
        commits.write_once = real
    assert held(spark, path) == [("a", 1, 1.0), ("z", 1, 1.0)]


def test_killed_batches_leave_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    put(spark, path, [("a", 1, 1.0)])
    dies = spark.createDataFrame([("b", 1, 1.0)], ROWS).withColumn("price", F.raise_error(F.lit("killed")).cast("double"))
    with pytest.raises(Exception, match="killed"):
        commits.commit(dies, path)
    assert held(spark, path) == [("a", 1, 1.0)] and commits.state(spark, path)["version"] == 1


@pytest.mark.parametrize("newest", [False, True])
def test_what_a_batch_writes_follows_the_batch(spark, tmp_path, newest):
    path, want, r = f"{tmp_path}/t", {}, random.Random(7)
    put(spark, path, [(f"k{k}", 1, 0.0) for k in range(5000)], newest=newest)
    want = {f"k{k}": (1, 0.0) for k in range(5000)}
    large = commits.state(spark, path)["parts"][0]["folder"]
    for n in range(2, 14):
        rows = [(f"k{r.randrange(6000)}", r.randrange(10), float(n)) for _ in range(10)]
        put(spark, path, rows, newest=newest, counts=False)
        last = {}
        for url, seq, price in rows:
            if url not in last or (seq, price) >= last[url]:
                last[url] = (seq, price)
        for url, x in last.items():
            if not newest or url not in want or x[0] >= want[url][0]:
                want[url] = x
    now = commits.state(spark, path)
    assert now["parts"][0]["folder"] == large and len(now["parts"]) <= 5 and sum(p["rows"] for p in now["parts"][1:]) <= 120
    got = {u: (s, p) for u, s, p in held(spark, path)}
    assert got.keys() == want.keys() and all(got[u][0] == want[u][0] for u in want)
    assert len(list((tmp_path / "t" / "parts").iterdir())) <= 2 * len(now["parts"]) + 4
    put(spark, path, [(f"k{k}", 99, 1.0) for k in range(4000)], newest=newest)
    assert len(commits.state(spark, path)["parts"]) == 1 and sum(p == 1.0 for _, _, p in held(spark, path)) == 4000


def test_shared_tokens_of_a_pair_are_worked_out_once(spark):
    """No join of all pairs tests tokens, which stand once beside each pair that prices and formulas allow."""
    rows = [(k, f"shop{k % 5}", "dau trau sao vang", f"{k}-1-1", 10.0) for k in range(20)]
    found = compare.matches(spark.createDataFrame(rows, "item_id long, source string, name string, npk string, per_kg double"))
    assert found.collect() == []
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [x for x in plan if "Join Inner" in x and "array_intersect" in x] and sum(x.count("array_intersect") for x in plan) == 2
