"""URL rules and licence phrases against brute force."""

import random
import re

from cabstar.llm import licences, urls
from cabstar.llm.queries import op3_url_filter, op5_licences

SF = "/root/testdata/sf0.001"
HOSTS = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in HOSTS:
        h, _, p = rule.partition("/")
        fits = (host == h or host.endswith("." + h)) and path.startswith("/" + p)
        if fits and (best is None or len(rule) > len(best)):
            best = rule
    return host, path, best, HOSTS.get(best)


def test_contract_rules_on_odd_urls(spark):
    rng = random.Random(2)
    parts = ["http://", "://", "/", "?", "#", ".", "com", "COM", "example", "www", "net", "en", "es", "fr", "En", ":8", "@", " ", "\n", "é", "x"]
    made = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(3000)]
    made += ["https://" + rng.choice(["", "a.", "www.", "xwww."]) + rng.choice(["example.com", "com", "a.net", "net", "notexample.com"]) + rng.choice(["", "/", "/en", "/en/", "/en/1?x=/en/", "/es/x", "/fr/", "?/en/", "#/en/"]) for _ in range(500)]
    table = spark.createDataFrame([(i, u) for i, u in enumerate([None, "", "no url", *made])], "page_id long, url string")
    for r in urls.judge_urls(table, keep=("page_id", "url")).collect():
        host, path, rule, verdict = brute_url(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert rule is None or r.verdict == verdict


def test_index_gives_the_same_as_trying_every_rule(spark):
    sample = ["http://a.com/login", "http://a.com/loginx", "http://a.net/x.zip", "http://a.net/x.zip?y", "http://b.org/p?phpsessid=4",
              "http://b.org/en/casino?x", "http://b.org/casinos", "http://c.org/ads/banner", "http://c.org/"]
    table = spark.createDataFrame(list(enumerate(sample)), "page_id long, url string")
    rules = urls.PATTERN_RULES + urls.HOST_RULES
    counts = urls.token_counts(table, rules)
    assert counts["com"] == 2 and counts["login"] == 1
    index = urls.Index(rules, counts)
    for url in sample:
        subject = "".join(urls.split_url(url))
        want = [r for r in rules if re.search(r.regex, subject, re.S)]
        assert sorted(map(repr, index.fits(subject))) == sorted(map(repr, want))
    got = {r.url: r for r in urls.judge_urls(table, keep=("url",)).collect()}
    assert got["http://a.com/login"].rule == "com/" and got["http://a.com/login"].verdict == "allow"
    assert got["http://a.net/x.zip"].verdict == "block" and got["http://a.net/x.zip"].pattern == ".zip|"
    assert got["http://a.net/x.zip?y"].verdict == "allow" and got["http://b.org/casinos"].verdict == "allow"
    assert got["http://b.org/p?phpsessid=4"].verdict == "block" and got["http://c.org/ads/banner"].verdict == "block"


def test_urls_empty_and_repeated(spark):
    table = spark.createDataFrame([(1, "http://x.com/", "h"), (1, "http://x.com/", "h")], "page_id long, url string, host string")
    assert [(r.host, r.verdict) for r in urls.judge_urls(table, keep=("page_id", "host")).collect()] == [("x.com", "allow")] * 2
    assert urls.judge_urls(table.limit(0)).count() == 0
    assert urls.judge_urls(table, rules=()).first().verdict == "allow"


def test_url_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op3_url_filter(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        host, path, rule, _ = brute_url(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute_phrases(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    found = []
    for phrase, label in PHRASES.items():
        w = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(w)] == w]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def scanned(spark, texts, tmp):
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp}/documents.parquet")
    return {r.doc_id: r for r in op5_licences(spark, tmp).collect()}


def test_licence_phrases(spark, scratch):
    rng = random.Random(4)
    bits = ["CC BY", "cc", "by", "General Public License", "general", "public", "license", "All Rights Reserved", "all", "rights", "reserved", "é", "x-y", "\n", "K", "7"]
    texts = [None, "", "...", "cc by", "x" * 100_000, "cc by " * 3000]
    texts += [rng.choice([" ", "-", ", "]).join(rng.choices(bits, k=rng.randrange(60))) for _ in range(400)]
    got = scanned(spark, texts, scratch)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_phrases(t), t
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")


def test_licence_templates(spark, scratch):
    texts = {t.label: f"Header 12, {t.text.upper()} and more." for t in licences.COMMON}
    got = scanned(spark, list(texts.values()) + ["granted free of charge to any person", "gnu lesser license"], scratch)
    for i, label in enumerate(texts):
        assert label in got[i].labels.split(",") and got[i].score == 1.0
    assert got[len(texts)].labels == "" and got[len(texts) + 1].labels == ""


def test_licences_empty_repeated_and_clashing(spark):
    docs = spark.createDataFrame([(1, "cc by", 5), (1, "cc by", 5), (None, None, 5)], "doc_id long, text string, matches int")
    rows = licences.scan_licences(docs, keep=("doc_id", "matches")).collect()
    assert sorted(len(r.matches) for r in rows) == [0, 1, 1]
    assert licences.scan_licences(docs.limit(0)).count() == 0


def test_licence_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op5_licences(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_phrases(texts[r.doc_id])
