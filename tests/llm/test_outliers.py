import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vinlake.llm import outliers
from vinlake.llm.common import table


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    seen, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, duplicates, len(repeated)


def test_counts_against_brute_force():
    chance = random.Random(5)
    for _ in range(300):
        text = "".join(chance.choices(["a", "b", " ", "  ", "\n", "\t", "#", "<x>", "é", "　", "\x1c", "A!"], k=chance.randint(0, 60)))
        assert outliers.count(text)[:5] == plain_counts(text), text


def test_whole_table_keeps_clean_texts_and_drops_junk(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", name) for name in ("documents", "labels"))
    rows = outliers.judge(docs).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    junk = [r for r in rows if r.quality == 0 and not r.base_failed]
    assert sum(not r.kept for r in junk) >= 0.9 * len(junk)
    assert not any(r.kept and (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)


def test_estimates_resist_a_quarter_of_outliers(spark):
    chance = np.random.default_rng(6)
    good, bad = chance.normal(0, 0.5, (1500, 6)), chance.normal(8, 0.1, (400, 6))
    names = [f"x_{name}" for name in outliers.STATISTICS]
    rows = [("g", *map(float, row)) for row in np.concatenate((good, bad))]
    found = outliers.estimates(spark.createDataFrame(rows, ["group", *names])).collect()
    assert len(found) == 1 and np.abs(found[0].mean).max() < 0.15
    inverse = np.array(found[0].inverse).reshape(6, 6)

    def far(x):
        return float((x - found[0].mean) @ inverse @ (x - found[0].mean)) / found[0].scale

    limit = outliers.chi_square(outliers.SURE)
    assert all(far(x) > limit for x in bad) and sum(far(x) > limit for x in good) <= 3


def test_small_groups_fall_back_and_edges(spark):
    text = " ".join(f"word{i} other{i * 7 % 11}" for i in range(60))
    rows = [(i, text + f" end{i}", "en" if i % 2 else None, f"s{i % 3}", i) for i in range(30)]
    rows += [(100, None, "en", None, 0), (101, "", None, "s1", 0), (102, "a b c " * 50_000, "en", "s1", 0)]
    rows += [(None, text, "xx", "only", 0), (None, text, "xx", "only", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    out = outliers.judge(docs).collect()
    assert len(out) == len(rows)
    assert all(r.kept for r in out if r.doc_id is None or r.doc_id < 100)
    assert {r.doc_id: r.kept for r in out if (r.doc_id or 0) >= 100} == {100: False, 101: False, 102: False}
    assert outliers.judge(docs.limit(0)).count() == 0
    assert outliers.judge(docs.filter(F.col("doc_id") >= 100)).count() == 3


@pytest.mark.parametrize(("sure", "value"), [(0.5, 5.348), (0.99, 16.812), (0.999, 22.458)])
def test_chi_square(sure, value):
    assert outliers.chi_square(sure, 6) == pytest.approx(value, rel=0.01)


def test_words_are_counted_once():
    assert outliers.count("a b c a b c d")[4] == 6


def test_few_texts_of_rare_sources_are_held_against_their_language(spark):
    def text(i, word):
        return " ".join(f"{word}{(i + 1) * k % 397}" for k in range(1, 61))

    rows = [(i, text(i, "word"), lang, "large") for i, lang in enumerate(["en"] * 250 + ["fr"] * 5)]
    odd = [(1000, text(1, "A-B!C?D;E:"), "en", "rare"), (1001, text(2, "A-B!C?D;E:"), "fr", "rare")]
    odd += [(1002, text(3, "A-B!C?D;E:"), "xx", "rare")]
    plain = [(2000, text(7, "word"), "en", "scarce"), (2001, text(8, "word"), "yy", "scarce")]
    docs = spark.createDataFrame(rows + odd[:1] + plain[:1], "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r.kept for r in outliers.judge(docs).collect()}
    assert not found[1000] and found[2000] and sum(found.values()) == 256
    docs = spark.createDataFrame(rows + odd + plain, docs.schema)
    found = {r.doc_id: r.kept for r in outliers.judge(docs).collect()}
    assert not any(found[i] for i in (1000, 1001, 1002)) and sum(found.values()) == 257
