import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from vinlake.llm import phrases
from vinlake.llm.common import table


def plain(rows, longest=3, least=10, share=50, top=2_000):
    """All counts by plain loops, in Python integers."""
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for at in range(len(words) - size + 1):
                    count[lang, tuple(words[at : at + size])] += 1
    candidates = {key: n for key, n in count.items() if len(key[1]) > 1 and n >= least}
    best_longer = Counter()
    for (lang, words), n in candidates.items():
        for size in range(2, len(words)):
            for at in range(len(words) - size + 1):
                inner = lang, words[at : at + size]
                best_longer[inner] = max(best_longer[inner], n)
    out = defaultdict(list)
    for (lang, words), a in candidates.items():
        if 100 * best_longer[lang, words] >= share * a:
            continue
        cuts = []
        for cut in range(1, len(words)):
            l, r = count[lang, words[:cut]], count[lang, words[cut:]]
            cuts.append((1_000_000 * a * a // (l * r), cut, l, r))
        score, _, l, r = min(cuts)
        out[lang].append((-score, -a, " ".join(words).encode(), l, r))
    rows = []
    for lang, many in out.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(many)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(rows)


def found(docs, *args):
    return sorted(tuple(row) for row in phrases.mine(docs, *args).collect())


def test_whole_table_against_brute_force_and_sql(spark, folder):
    docs = table(spark, folder, "documents")
    expected = plain(docs.select("text", "lang").collect())
    assert found(docs) == expected and expected
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    assert sorted(duckdb.sql(phrases.SQL).fetchall()) == expected


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_made_texts_with_heavy_words_and_small_memory(spark, monkeypatch, longest):
    chance = random.Random(longest)
    monkeypatch.setattr(phrases, "HELD", 50)
    monkeypatch.setattr(phrases, "HEAVY", 8)
    words = ["of", "the", "of", "the", "THE", "a", "Née", "b\x00c", "x-y", "é", "né"]
    passage = "one two three four five six seven eight nine ten"
    rows = []
    for number in range(400):
        text = "".join(chance.choice(words) + chance.choice(["  ", " ", "\t", " ", ", ", "\n", "."]) for _ in range(chance.randrange(30)))
        rows.append((text + (passage if number % 9 == 0 else ""), chance.choice(["en", "en", "en", None, "und", "f\nr"])))
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert found(docs, longest, 5, 50, 40) == plain(rows, longest, 5, 50, 40)


def test_paths_of_unary_nodes_are_compacted(spark):
    texts = ["a b c d e f"] * 5 + ["x b c"] * 0 + ["p q r p q r p"] * 3
    counted = phrases.counts(spark.createDataFrame([(t, "en") for t in texts], "text string, lang string"), 3, 3)
    rows = {r.node: (r.last, r.steps, r.n) for r in phrases.compacted(counted).collect()}
    assert {node: rows[node] for node in ("b c", "c d", "d e")} == {"b c": ("e f", 3, 5), "c d": ("e f", 2, 5), "d e": ("e f", 1, 5)}
    assert "a b" not in rows and "e f" not in rows
    circle = spark.createDataFrame([("en", w, len(w.split()), 4) for w in ("a b c", "b c a", "c a b", "a b", "b c", "c a")], "lang string, phrase string, size int, n long")
    assert {r.node: (r.last, r.steps) for r in phrases.compacted(circle).collect()} == {"a b": ("b c", 1), "b c": ("c a", 1), "c a": ("a b", 1)}


def test_null_empty_long_ties_repeats_and_no_rows(spark):
    rows = [(None, "en", 1), ("", None, 1), (" .,; \n", "en", 1), ("tie one, tie two, " * 12, None, 1), ("go on " * 200_000, "en", 1)]
    rows += [("same words here", "de", 1)] * 10
    docs = spark.createDataFrame(rows, "text string, lang string, first int").withColumn("n", phrases.F.lit(1)).withColumn("phrase", phrases.F.lit("x"))
    assert found(docs) == plain([(a, b) for a, b, _ in rows])
    assert found(docs.limit(0)) == []
    with pytest.raises(ValueError):
        phrases.mine(docs, 1)


def test_edges_are_shuffled_once(spark, folder):
    docs = table(spark, folder, "documents")
    seen = []
    original, phrases.stored = phrases.stored, lambda rows, name, *by: seen.append((name, rows)) or original(rows, name, *by)
    try:
        phrases.counts(docs)
    finally:
        phrases.stored = original
    rows = dict(seen)["counts"]
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning(first") == 1
    assert plan.split("Initial Plan")[0].count("Exchange ") == 2


def test_edges_are_spelled_with_salt_and_without_what_fills_them_up(spark):
    docs = spark.createDataFrame([("go é x. go é x. go. é go", "f\nr")], "text string, lang string").coalesce(1)
    texts = docs.select("lang", phrases.F.col("text").cast("binary").alias("bytes"))
    for longest, expected in ((2, {"é": 2, "": 2}), (3, {"é x": 2, "": 2}), (4, {"é x": 2, "": 2})):
        found = phrases.edges(texts, longest, set()).collect()
        assert {r.rest: r.n for r in found if r.first == "go\n\nf\nr"} == expected
        assert [(r.first, r.rest, r.n) for r in found if r.first.startswith("\n")] == [("\n\nf\nr", "", 9)]
    salted = {r.first for r in phrases.edges(texts, 3, {("f\nr", b"go")}).collect() if r.first.startswith("go\n")}
    assert len(salted) == 2 and all(first.split("\n", 2)[1][0] == "s" for first in salted)
