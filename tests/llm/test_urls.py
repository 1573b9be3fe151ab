import re
from itertools import combinations

from pyspark.sql import functions as F

from vinlake.llm import urls
from vinlake.llm.common import table


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_rule(host, path):
    fit = [r for r in urls.GIVEN if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text), default=None)


def test_whole_table_against_brute_force(spark):
    folder = "/root/testdata/sf0.1"
    pages, labels = table(spark, folder, "pages"), table(spark, folder, "labels")
    expected = {r.page_id: r.url for r in pages.collect()}
    out = urls.judge(pages, labels).collect()
    assert len(out) == len(expected)
    for r in out:
        host, path = plain_parts(expected[r.page_id])
        rule = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.text)
        if rule:
            assert r.verdict == rule.verdict


def test_mined_rules_against_every_combination(spark):
    rows = []
    for i in range(600):
        if i % 6 == 0:
            rows.append((i, f"http://h{i % 12}.org/free/bets/{i}", 0))
        else:
            rows.append((i, f"http://h{i % 12}.org/{'free' if i % 2 else 'bets'}/{i}?page={i}", int(i % 50 != 1)))
    frame = spark.createDataFrame(rows, "page_id long, url string, quality int")
    split = urls.with_parts(frame).withColumn("tokens", urls.tokens())
    labels = frame.select(F.col("page_id").alias("doc_id"), "quality")
    found = {tuple(r.rule) for r in urls.mine(split.select("page_id", "tokens"), labels).collect()}
    baskets = [(set(r.tokens), q == 0) for r, (_, _, q) in zip(split.orderBy("page_id").collect(), rows, strict=True)]
    share, kept = sum(bad for _, bad in baskets) / len(baskets), set()
    names = sorted(set().union(*(t for t, _ in baskets)))
    for size in (1, 2, 3, 4):
        for rule in combinations(names, size):
            hits = [bad for t, bad in baskets if t.issuperset(rule)]
            if sum(hits) >= max(urls.LEAST, urls.SUPPORT * len(baskets)) and sum(hits) / len(hits) >= max(urls.CONFIDENCE, urls.LIFT * share):
                kept.add(rule)
    least = {r for r in kept if not any(r[:i] + r[i + 1 :] in kept for i in range(len(r)))}
    assert found == least and ("path:bets", "path:free") in found
    verdicts = {r.page_id: r.verdict for r in urls.judge(frame, labels).collect()}
    for (i, _, _), (t, _) in zip(rows, baskets, strict=True):
        assert verdicts[i] == ("block" if any(t.issuperset(r) for r in least) else "allow")


def test_null_empty_long_repeated_and_clashing(spark):
    made = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "http://example.com/en/", "http://a.example.com/en"]
    made += ["http://x.net/fr/?a=1#b", "http://net/es/1", "http://com", "http://com?x=/", "://a.net/es/", "http://notnet/es/", "a://b://c.net/fr/"]
    made += ["http://a.org/" + "x/" * 50_000, "http://ÄB.net/es/\n?q", "http://a.com/?x", "http://a.com/?x"]
    pages = spark.createDataFrame([(i if i else None, u, "r") for i, u in enumerate(made)], "page_id long, url string, rule string")
    labels = spark.createDataFrame([(1, 0), (None, 0), (2, None), (2, 1)], "doc_id long, quality int")
    for marks in (labels, labels.limit(0)):
        out = {r.page_id: r for r in urls.judge(pages, marks).collect()}
        assert len(out) == len(made)
        for i, url in enumerate(made):
            host, path = plain_parts(url)
            rule, row = plain_rule(host, path), out[i if i else None]
            assert (row.host, row.path, row.rule) == (host, path, rule and rule.text), url
            assert row.verdict == (rule.verdict if rule else "allow")
    assert urls.judge(pages.limit(0), labels).count() == 0


def test_general_rules_stay_beside_many_longer_ones(spark):
    rows, deep = [], "/".join(f"x{'abcdefghijklmn'[k]}" for k in range(14))  # 2 ** 14 sure combinations and more
    for i in range(400):
        rows.append((i, f"//{i}", 1))
    for i in range(60):
        rows.append((400 + i, f"q://deep/{deep}", 0))
        rows.append((500 + i, "q://wide/spam", int(i % 10 == 0)))
    frame = spark.createDataFrame(rows, "page_id long, url string, quality int")
    frame = frame.withColumn("url", F.when(F.col("page_id") < 400, F.concat(F.lit("q://h"), F.col("page_id"), F.lit(".org/"))).otherwise(F.col("url")))
    verdicts = {r.page_id: r.verdict for r in urls.judge(frame, frame.select(F.col("page_id").alias("doc_id"), "quality")).collect()}
    assert {v for i, v in verdicts.items() if i < 400} == {"allow"} and {v for i, v in verdicts.items() if i >= 400} == {"block"}
