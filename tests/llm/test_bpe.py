import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vinlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "A", "é", "the", "ing", " ", "  ", "\n", "\r\n", "\x1c", "\x85", "\xa0", "　", "1", "²", "!", "'s", "'ll"]
PARTS += ["😀", "文字", "​", "<|endoftext|>", "<|endof", "aaaa", "\x00", "̀", "٣", "—"]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def test_encodes_and_decodes_as_the_public_library(reference):
    own, chance = bpe.tokenizer(PATH), random.Random(1)
    for _ in range(5_000):
        text = "".join(chance.choices(PARTS, k=chance.randint(0, 25)))
        expected = reference.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), dtype="<u4").tolist() == expected, text
        assert own.decode(own.encode(text)) == reference.decode(expected, skip_special_tokens=False)


def test_a_small_automaton_against_merging_by_hand():
    chance, letters = random.Random(2), b"abc"
    for _ in range(300):
        tokens, merges, seen = [bytes([x]) for x in letters], [], set()
        for _ in range(8):
            pair = (chance.randrange(len(tokens)), chance.randrange(len(tokens)))
            if tokens[pair[0]] + tokens[pair[1]] not in tokens:
                merges.append((*pair, len(tokens)))
                tokens.append(tokens[pair[0]] + tokens[pair[1]])
                seen.add(pair)
        own = bpe.MergeAutomaton({x: place for place, x in enumerate(letters)}, merges)
        for _ in range(30):
            word = bytes(chance.choices(letters, k=chance.randint(1, 12)))
            ids = [letters.index(x) for x in word]
            for left, right, merged in merges:
                place = 0
                while place < len(ids) - 1:
                    if (ids[place], ids[place + 1]) == (left, right):
                        ids[place : place + 2] = [merged]
                    place += 1
            assert b"".join(own.label[x] for x in own.encode(word)) == word
            if all(own.born.get(x) is not None for *_, x in merges):
                assert own.encode(word) == ids, (merges, word)


def test_null_empty_long_repeated_and_clashing(spark, reference):
    long = "ab" * 200_000 + " c" * 50_000
    rows = [(1, None, "x"), (2, "", "x"), (3, long, None), (3, long, None), (None, "Hi <|endoftext|> there", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.encode_documents(docs, PATH).collect()
    assert sorted((r.doc_id or 0) for r in out) == [0, 1, 2, 3, 3]
    for row in out:
        text = {1: "", 2: "", 3: long, None: "Hi <|endoftext|> there"}[row.doc_id]
        assert np.frombuffer(row.ids, dtype="<u4").tolist() == reference.encode(text, add_special_tokens=False).ids
        assert row.decoded == text
    assert bpe.encode_documents(docs.limit(0), PATH).count() == 0


def test_bytes_that_are_no_text_decode_to_replacement_characters(reference):
    ids = reference.encode("文", add_special_tokens=False).ids[:1]
    packed = np.array(ids, dtype="<u4").tobytes()
    assert bpe.tokenizer(PATH).decode(packed) == reference.decode(ids, skip_special_tokens=False)


def test_a_full_memory_keeps_what_is_met_again(reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 64)
    own, spelled = bpe.Tokenizer(PATH), []
    encode = own.automaton.encode
    monkeypatch.setattr(own.automaton, "encode", lambda word: spelled.append(word) or encode(word))
    text = "".join(f" often x{chr(97 + n % 26)}{chr(97 + n // 26)} often," for n in range(600))
    ids = np.frombuffer(own.encode(text), dtype="<u4").tolist()
    assert ids == reference.encode(text, add_special_tokens=False).ids
    assert spelled.count(b" often") == 1 and len(own.known) <= 64 and len(own.older) <= 64


def test_words_with_the_same_beginning_and_forgotten_beginnings(reference, monkeypatch):
    monkeypatch.setattr(bpe, "BEGINNINGS", 3)
    own, chance = bpe.Tokenizer(PATH), random.Random(3)
    beginnings = ["there", "ther", "the", "é文", "aaaaa", "'ll", "1234"]
    words = [chance.choice(beginnings) + "".join(chance.choices("aeinrst文", k=chance.randint(0, 9))) for _ in range(3_000)]
    for word in words:
        assert np.frombuffer(own.encode(word), dtype="<u4").tolist() == reference.encode(word, add_special_tokens=False).ids, word
    assert len(own.automaton.begun) <= 3


def test_a_task_leaves_no_memory_of_its_texts_to_the_next(spark):
    path = PATH

    def left(batches):
        for batch in batches:
            own = bpe.tokenizer(path)
            yield batch.assign(left=len(own.known) + len(own.older) + len(own.automaton.arcs) + len(own.automaton.begun))[["left"]]

    docs = spark.createDataFrame([(f"word{n} and more of them, {n}",) for n in range(200)], "text string").coalesce(1)
    for _ in range(2):
        assert docs.select(bpe.encode(bpe.F.col("text"), path).alias("ids")).filter("length(ids) > 0").count() == 200
    assert {r.left for r in spark.range(16, numPartitions=16).mapInPandas(left, "left long").collect()} == {0}


def test_forgetting_changes_no_encoding():
    own = bpe.Tokenizer(PATH)
    before = own.encode("Some words, 12 of them; überall")
    assert own.known
    own.forget()
    assert not own.known and not own.older and own.encode("Some words, 12 of them; überall") == before
