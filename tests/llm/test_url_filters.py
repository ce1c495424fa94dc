import math
import random

from edmart.llm import url_filters as U

COLUMNS = "page_id long, url string, html string, host string, score string"


def pages(spark, urls, html="<p>free bets and sea side town hotel sea side</p>"):
    return spark.createDataFrame([(i, u, html, "h", "s") for i, u in enumerate(urls)], COLUMNS)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_host_path_and_rules(spark):
    cases = {
        "HTTP://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://example.net/en": ("example.net", "/en", "net/", "block"),
        "http://example.net": ("example.net", "", None, None),
        "https://m.example.com/de/": ("m.example.com", "/de/", "example.com/de/", "block"),
        "https://badexample.com/de/": ("badexample.com", "/de/", None, None),
        "http://x.org/fr/a/b": ("x.org", "/fr/a/b", "org/fr/", "allow"),
        "http://É.org?x://y/": ("É.org", "", None, None),
        "http://a#b/c": ("a", "", None, None),
        "no scheme/net/": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
        "a://b\n.net/\n/c": ("b\n.net", "/\n/c", "net/", "block"),
    }
    urls = list(cases)
    rows = {r["page_id"]: r for r in U.filter_urls(pages(spark, urls), labels(spark, [])).collect()}
    for i, url in enumerate(urls):
        host, path, rule, verdict = cases[url]
        r = rows[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        assert r["verdict"] == (verdict or "allow"), url


def test_split_equals_all_splits():
    rng = random.Random(4)
    vocabulary = {"a": 5, "ab": 3, "ba": 9, "abc": 2, "c": 1, "bab": 4}
    total = sum(vocabulary.values())

    def weight(word):
        n = vocabulary.get(word)
        return math.log(n / total) if n else math.log(10 / total) - len(word) * math.log(10)

    def every(text):
        if not text:
            yield []
        for k in range(1, len(text) + 1):
            for rest in every(text[k:]):
                yield [text[:k], *rest]

    for _ in range(60):
        name = "".join(rng.choice("abc") for _ in range(rng.randint(1, 8)))
        known = {(i, j - i): vocabulary[name[i:j]] for i in range(len(name)) for j in range(i + 1, len(name) + 1) if name[i:j] in vocabulary}
        got = U.split_name(name, known, total)
        assert "".join(got) == name
        assert math.isclose(sum(map(weight, got)), max(sum(map(weight, s)) for s in every(name)))


def test_segmentation_and_bayes_equal_a_plain_count(spark):
    urls = ["http://freebets.com/a/1"] * 3 + ["http://seaside.com/town/2"] * 4 + ["http://www.freebets.org/b"]
    taught = labels(spark, [(0, 1, 1), (1, 0, None), (3, 1, 0), (4, 1, None), (5, None, None)])
    rows = {r["page_id"]: r for r in U.filter_urls(pages(spark, urls), taught).collect()}
    assert rows[0]["host_tokens"] == ["free", "bets", "com"]
    assert rows[3]["host_tokens"] == ["sea", "side", "com"]
    assert rows[2]["verdict"] == "block" and rows[6]["verdict"] == "allow" and rows[7]["verdict"] == "block"
    bad = ["free", "bets", "com", "a", "0"] * 2
    good = ["sea", "side", "com", "town", "0"] * 3
    want = math.log(2 / 3) + sum(
        math.log((bad.count(t) + 1) / (len(bad) + U.BUCKETS)) - math.log((good.count(t) + 1) / (len(good) + U.BUCKETS))
        for t in ["free", "bets", "com", "a", "0"]
    )
    assert math.isclose(rows[0]["score"], want)


def test_empty_and_repeated(spark):
    none = labels(spark, [])
    assert U.filter_urls(pages(spark, []), none).count() == 0
    two = pages(spark, ["http://a.net/x"]).unionByName(pages(spark, ["http://a.net/x"], html=None))
    assert [r["verdict"] for r in U.filter_urls(two, none).collect()] == ["block", "block"]
