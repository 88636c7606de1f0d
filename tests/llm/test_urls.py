import random

from touchline.llm.urls import bloom_filter, judge_urls, might_hold


def brute(url, entries):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0] or [len(rest)])
    host, rest = rest[:cut].lower(), rest[cut:]
    path = rest[: min([i for i in map(rest.find, "?#") if i >= 0] or [len(rest)])]
    fits = []
    for entry in entries:
        name, _, tail = entry.partition("/")
        if host and ("." + host).endswith("." + name) and (path.startswith("/" + tail) if entry.endswith("/") else path == "/" + tail):
            fits.append(entry)
    return host, path, max(fits, key=lambda e: (len(e), e)) if fits else None


def test_equals_brute_force_on_random_urls(spark):
    rng = random.Random(2)
    part = lambda: rng.choice(["a", "b", "net", "org", "x1"])
    entries = {".".join(part() for _ in range(rng.randint(1, 3))) + "/" + "".join(part() + "/" for _ in range(rng.randint(0, 2))) + rng.choice(["", "", "page"]) for _ in range(25)}
    urls = [None, "", "no scheme", "http://", "http://a", "HTTP://A.NET/b/?q=/x", "x://a.net#/b/", "a://b://net/", "http://é.net/a/"]
    urls += [f"http://{'.'.join(part() for _ in range(rng.randint(1, 4)))}{rng.choice(['', '/'])}{''.join(part() + '/' for _ in range(rng.randint(0, 3)))}{rng.choice(['', 'page', '?a=1', '#t'])}" for _ in range(500)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, entry string")
    listed = spark.createDataFrame([(e, "block", 0) for e in entries] + [(None, "allow", 9)], "entry string, verdict string, rank int")
    got = {r.page_id: (r.host, r.path, r.entry) for r in judge_urls(pages, listed).collect()}
    assert got == {i: brute(u, entries) for i, u in enumerate(urls)}
    assert {r.entry for r in judge_urls(pages, listed.limit(0)).collect()} == {None}
    assert judge_urls(pages.limit(0), listed).count() == 0
    assert judge_urls(pages.union(pages), listed).count() == 2 * len(urls)


def test_rank_goes_before_length(spark):
    listed = spark.createDataFrame([("net/", "allow", 1), ("a.net/long/", "block", 0)], "entry string, verdict string, rank int")
    pages = spark.createDataFrame([(1, "http://a.net/long/x")], "page_id long, url string")
    assert [(r.entry, r.verdict) for r in judge_urls(pages, listed).collect()] == [("net/", "allow")]


def test_filter_holds_all_entries_and_few_others(spark):
    import numpy as np
    from pyspark.sql import functions as F

    entries = spark.range(20_000).select(F.concat(F.lit("host"), "id").alias("entry"))
    filter_ = bloom_filter(entries, "entry", 20_000)
    hashes = lambda df: np.array([r[0] for r in df.select(F.xxhash64("entry")).collect()], np.int64)
    assert might_hold(filter_, hashes(entries)).all()
    others = might_hold(filter_, hashes(spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("entry"))))
    assert others.mean() < 0.02
