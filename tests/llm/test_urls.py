from llm_frames import rows_of

from tallyline.llm import urls
from tallyline.llm.queries import URL_RULES

PAGES = "page_id long, url string, HOST string, rule string, verdict string"


def pages(spark, given):
    return spark.createDataFrame([(k, url, "h", "r", "v") for k, url in enumerate(given)], PAGES)


def by_hand(url, rules=URL_RULES):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [
        (len(h + p), len(h), h + p, verdict)
        for verdict, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    listed = set(host.replace("-", ".").split(".")) & set(urls.HOST_WORDS)
    return host, path, None, "block" if listed else "allow"


GIVEN = [
    "http://a.example.org/es/1", "https://example.org/en/12?x#y", "https://example.org/en/2",
    "HTTP://WWW.Example.ORG", "http://org/", "http://borg/", "http://x.com/fr/9#top",
    "http://x.com/de/", "https://casino-win.example.net/fr/", "http://x.adsy.net/", None, "",
    "no scheme", "http://", "http:///path", "http://h?q=/a", "http://É.org/es/", "a://b://c/d",
    "http://h.com/" + "x" * 100_000, "http://x.com/de/", "http://x\ny.com/de/",
]


def test_judges(spark):
    got = urls.judge_urls(pages(spark, GIVEN), URL_RULES)
    want = [(k, *by_hand(url)) for k, url in enumerate(GIVEN)]
    assert rows_of(got, *got.columns) == sorted(want, key=repr)


def test_a_list_in_parts_gives_the_same(spark):
    frame = pages(spark, GIVEN)
    whole = urls.judge_urls(frame, URL_RULES)
    parts = urls.judge_urls(frame, URL_RULES, part_bytes=60)
    assert rows_of(whole, *whole.columns) == rows_of(parts, *parts.columns)


def test_equal_digests_do_not_match(monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda text: len(text))
    listed = urls.DigestList(urls.pack([("ab", "block", 1), ("cd", "allow", 1), ("abc", "block", 2)]))
    assert [listed.text(k) if k >= 0 else None for k in listed.find([b"cd", b"ef", b"ab", b"abc", b""])] == [
        b"cd", None, b"ab", b"abc", None,
    ]


def test_longer_host_wins_a_tie(spark):
    rules = [("block", "example.org", "/a"), ("allow", "x.example.org", "")]
    assert len("example.org/a") == len("x.example.org")
    (row,) = urls.judge_urls(pages(spark, ["http://x.example.org/a"]), rules).collect()
    assert (row.rule, row.verdict) == ("x.example.org", "allow")


def test_empty(spark):
    assert urls.judge_urls(pages(spark, []), URL_RULES).count() == 0
    (row,) = urls.judge_urls(pages(spark, ["http://casino.com/"]), [], words=()).collect()
    assert (row.rule, row.verdict) == (None, "allow")
