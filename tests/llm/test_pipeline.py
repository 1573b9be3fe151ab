import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from brute_force import plain_components
from test_pii import plain as plain_spans
from test_simhash import plain_fingerprint, plain_links
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vinlake.llm import mixing, toxicity
from vinlake.llm.common import table


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The rows of documents and of every stage, each from the Parquet of the one before."""
    folder, out = "/root/testdata/sf0.01", tmp_path_factory.mktemp("stages")
    docs = table(spark, folder, "documents")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{out}/{name}")
        docs = spark.read.parquet(f"{out}/{name}")
        found.append(docs)
    assert [d.columns == found[0].columns for d in found] == [True] * 5 + [False]
    return [d.collect() for d in found]


def test_toxic_documents_go_and_the_others_stay(spark, steps):
    folder = "/root/testdata/sf0.01"
    scores = toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels")).collect()
    assert {r.doc_id for r in steps[1]} == {r.doc_id for r in scores if r.score < 0.3}
    assert len(steps[1]) >= 0.85 * len(steps[0])


def test_one_document_of_each_group_stays(steps):
    ids, texts = sorted(r.doc_id for r in steps[1]), {r.doc_id: r.text for r in steps[1]}
    links = plain_links([plain_fingerprint(texts[i]) for i in ids])
    groups = plain_components(ids, [(ids[a], ids[b]) for a, b in links])
    assert sorted(r.doc_id for r in steps[2]) == sorted(set(groups.values()))


def test_personal_data_is_masked_and_nothing_else(steps):
    before = {r.doc_id: r.text for r in steps[2]}
    assert {r.doc_id for r in steps[3]} == before.keys()
    for r in steps[3]:
        assert not plain_spans(r.text) and r.n_chars == len(r.text)
        if not re.search("[0-9@]", before[r.doc_id]):
            assert r.text == before[r.doc_id]
        for span in plain_spans(before[r.doc_id]):
            kind, start, end = span.split(":")
            assert before[r.doc_id][int(start) : int(end)] not in r.text and f"[{kind.upper()}]" in r.text


def test_mix_repeats_whole_documents(spark, steps):
    times, size = Counter(r.doc_id for r in steps[4]), {r.doc_id: len(r.text.split()) for r in steps[3]}
    assert max(times.values()) <= 3 and times.keys() <= size.keys()
    docs = spark.createDataFrame(steps[3])
    expected = {r.doc_id: r.times for r in mixing.mix(docs).collect()}
    assert {i: n for i, n in expected.items() if n} == dict(times)
    taken, target = defaultdict(int), {}
    for r in mixing.mix(docs).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= max(size.values()) for s in target)


def test_tokens_are_those_of_the_public_library(steps):
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in steps[4]}
    assert len(steps[5]) == len(steps[4])
    for r in steps[5]:
        expected = reference.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (np.frombuffer(r.ids, dtype="<u4").tolist(), r.n_tokens) == (expected, len(expected))


def test_null_empty_repeated_and_further_columns(spark, folder):
    # Their ids have no labels, so nothing is learned about them and nothing is toxic.
    rows = [(10**6, "same text here", "en", "a", 14, 0), (10**6, "same text here", "en", "a", 14, 0), (None, "same text here", None, None, None, 1)]
    rows += [(None, None, None, None, None, 2), (10**6 + 1, "", "en", "a", 0, 3), (10**6 + 2, "you idiot, mail a@b.co", "en", "b", 22, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")
    for start in (docs, docs.limit(0)):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, folder)
            if name != "bpe":
                assert now.columns == docs.columns
            if name == "simhash":
                kept = sorted((r.doc_id or 0, r.text or "") for r in now.collect())
                assert kept == ([(10**6, "same text here"), (10**6 + 1, ""), (10**6 + 2, rows[-1][1])] if start is docs else [])
        assert now.count() == 0 or start is docs


CLASHING = ["row", "place", "spans", "chance", "facts", "size", "text_", "_source", "_other", "_llm_row", "_llm_chance", "_llm_facts", "_llm_turn"]
CLASHING += ["_pii_spans", "_spans", "_candidates", "_right_key", "_right_hash", "fp", "key", "component_id", "col", "label", "toxic", "target", "times"]


def test_no_name_of_a_further_column_clashes(spark, folder):
    rows = [(10**6, "mail a@b.co or call 1.2.3.4 today", "en", "a", 33), (10**6 + 1, "another text with words", None, "b", 23)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *[F.concat(F.lit(f"{name} of "), F.col("doc_id")).alias(name) for name in CLASHING])
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, folder)
        assert now.columns == docs.columns, name
        found = now.collect()
        assert {r.doc_id for r in found} <= {10**6, 10**6 + 1} and found, name
        assert all(r[column] == f"{column} of {r.doc_id}" for r in found for column in CLASHING), name
        if name == "pii":
            assert {r.text for r in found} == {"mail [EMAIL] or call [IP] today", "another text with words"}
    assert corpus_pipeline.STAGES[-1][1](spark, now, folder).columns == ["doc_id", "source", "ids", "n_tokens"]
