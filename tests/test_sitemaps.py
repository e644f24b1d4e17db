"""Sitemap expansion against hand cases."""

from tallyfield.operators import sitemaps


def xml(*locs):
    return "<urlset>\n" + "\n".join(f"<url><loc>{x}</loc></url>" for x in locs)


FETCHED = [
    ("https://flat/sitemap.xml", xml("a", "b", "a")),
    ("https://flat/sitemap_index.xml", xml("c")),
    ("m/one", xml(*(f"m/sub{k}.xml" for k in range(10)), "page")),
    *((f"m/sub{k}.xml", xml(f"u{k}", f"deep{k}.xml")) for k in range(10) if k != 1),
    ("deep0.xml", xml("v0")),
    ("m/two", xml("late")),
    ("m/three", xml("never")),
    ("https://broken/sitemap.xml", "<loc>split\nloc</loc><loc></loc>"),
]


def found(spark, robots, **how):
    rows = sitemaps.expand(spark.createDataFrame(robots, "host string, robots_txt string"), spark.createDataFrame(FETCHED, "url string, xml string"), **how)
    return sorted((r.host, r.map_no, tuple(r.path), r.pos, r.url) for r in rows.collect())


def test_hosts_without_robots_lines(spark):
    got = found(spark, [("flat", None), ("none", "User-agent: *"), ("broken", "")])
    assert got == [("broken", 0, (), 0, ""), ("flat", 0, (), 0, "a"), ("flat", 0, (), 1, "b"), ("flat", 0, (), 2, "a"), ("flat", 1, (), 0, "c")]


def test_indexes_and_limits(spark):
    robots = [("h", "Sitemap: m/one\nx\nSITEMAP:m/two sitemap:\n m/three")]
    got = found(spark, robots)
    assert [x[4] for x in got] == [y for k in (0, 2, 3, 4, 5, 6, 7) for y in (f"u{k}", f"deep{k}.xml")] + ["late"]
    assert got[2] == ("h", 0, (2,), 0, "u2")
    assert [x[4] for x in found(spark, robots, enough=13)][-1] == "deep7.xml"  # 14 addresses are more than enough
    assert [x[4] for x in found(spark, robots, enough=14)][-1] == "late"
    assert [x[4] for x in found(spark, robots, maps=3, sub_maps=1)] == ["u0", "deep0.xml", "late", "never"]
    assert [(x[2], x[4]) for x in found(spark, robots, levels=2)] == [((0, 0), "v0"), ((), "late")]
    assert [x[4] for x in found(spark, robots, levels=0)][-2:] == ["page", "late"]


def test_collection_maps(spark):
    fetched = [
        ("https://a/sitemap.xml", xml("x/pages.xml", "x/collections.xml")), ("x/collections.xml", xml("a/collections/NPK-1", "a/collections/z", "a/npk", "a/collections/NPK-1")),
        ("https://b/sitemap.xml", xml("y1", "y2", "y3", "y4", "y5")), *((f"y{k}", xml(f"b/collections/npk{k}")) for k in (1, 4, 5)),
    ]
    hosts, maps = spark.createDataFrame([("a",), ("b",), ("c",)], "host string"), spark.createDataFrame(fetched, "url string, xml string")
    got = sorted(map(tuple, sitemaps.collection_addresses(hosts, maps, ("npk",)).collect()))
    assert got == [("a", "a/collections/NPK-1"), ("b", "b/collections/npk1"), ("b", "b/collections/npk4")]
