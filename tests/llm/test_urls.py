from pyspark.sql import functions as F

from larkspur.llm.url_filter import canonical, judge_urls


def test_verdicts(spark):
    pages = spark.createDataFrame([
        (1, "http://Www.A.com/fr/x", "f"), (2, "https://b.com/de/", "f"), (3, "http://x.example.org/es/q", "f"),
        (4, "http://example.org/en/12", "f"), (5, "http://bad.net/p/?utm_source=z&q=1#t", "f"), (6, None, "f"),
        (7, "no scheme", "f"), (8, "http://ok.net", "f"), (8, "http://ok.net", "f"), (9, "http://notexample.org?x", "f"),
        (10, "http://m.bad.net/p?q=1", "f")], "page_id bigint, url string, host string")
    listed = spark.createDataFrame([("https://www.bad.net/p?q=1",), (None,)], "url string")
    got = sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages, listed).collect()))
    assert got == [
        (1, "www.a.com", "/fr/x", "com/fr/", "allow"), (2, "b.com", "/de/", "com/de/", "block"),
        (3, "x.example.org", "/es/q", "example.org/es/", "block"), (4, "example.org", "/en/12", "example.org/en/1", "block"),
        (5, "bad.net", "/p/", None, "block"), (6, "", "", None, "allow"), (7, "", "", None, "allow"),
        (8, "ok.net", "", None, "allow"), (8, "ok.net", "", None, "allow"), (9, "notexample.org", "", None, "allow"),
        (10, "m.bad.net", "/p", None, "block")]
    assert judge_urls(pages.limit(0), listed).count() == 0
    assert judge_urls(pages, listed.limit(0)).filter("verdict = 'block' AND rule IS NULL").count() == 0


def test_no_false_positive_is_left(spark):
    from larkspur.llm.url_filter import listed as mark
    pages = spark.range(20_000).select(F.concat(F.lit("h/"), F.col("id").cast("string")).alias("canon"), "id")
    urls = pages.filter("id % 7 = 0").select("canon")
    got = mark(pages, urls, max_words=64)  # a filter that is far too small
    assert got.filter("listed <> (id % 7 = 0)").count() == 0 and got.count() == 20_000


def test_canonical(spark):
    df = spark.createDataFrame([("HTTP://m.X.com/a//?ref=1&b=2&utm_x#z",)], "url string")
    assert df.select(canonical(F.col("url"))).first()[0] == "x.com/a?b=2"
