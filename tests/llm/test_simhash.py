import random
import re

import numpy as np
import pytest
import xxhash
from brute_force import plain_components

from vinlake.llm import simhash
from vinlake.llm.common import table
from vinlake.llm.components import components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_links(prints):
    numbers = np.array(prints, dtype=np.uint64)
    for place, one in enumerate(numbers):
        for other in np.flatnonzero(np.bitwise_count(numbers[:place] ^ one) <= 3):
            yield place, int(other)


def test_whole_table_against_brute_force(spark, folder):
    docs = table(spark, folder, "documents")
    texts = dict(docs.select("doc_id", "text").collect())
    ids = sorted(texts)
    prints = [plain_fingerprint(texts[i]) for i in ids]
    expected = plain_components(ids, [(ids[a], ids[b]) for a, b in plain_links(prints)])
    found = simhash.near_duplicates(docs).withColumn("fingerprint", simhash.as_hex(simhash.F.col("fingerprint"))).collect()
    assert len(found) == len(ids)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {
        i: (f"{p:016x}", expected[i]) for i, p in zip(ids, prints, strict=True)
    }


def test_links_of_made_fingerprints_in_chains_and_balls(spark):
    chance, prints = random.Random(3), {0, (1 << 64) - 1}
    for _ in range(40):
        now = chance.getrandbits(64)
        for _ in range(chance.randint(1, 25)):
            prints.add(now)
            for bit in chance.sample(range(64), chance.randint(1, 5)):
                now ^= 1 << bit
    prints = sorted(prints)
    signed = [(simhash._signed(p),) for p in prints]
    found = {frozenset(x) for x in simhash.links(spark.createDataFrame(signed, "fp long")).collect()}
    assert found == {frozenset((signed[a][0], signed[b][0])) for a, b in plain_links(prints)}


@pytest.mark.parametrize("kind", ["path", "star", "random"])
def test_components_against_brute_force(spark, kind):
    chance = random.Random(4)
    order = chance.sample(range(300), 300)
    if kind == "path":
        links = list(zip(order, order[1:], strict=False))
    elif kind == "star":
        links = [(order[0], other) for other in order]
    else:
        links = [(chance.randrange(300), chance.randrange(300)) for _ in range(200)]
    expected = plain_components(range(300), links)
    edges = spark.createDataFrame([*links, (None, 1)], "a long, b long")
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert dict(components(edges).collect()) == {i: expected[i] for i in touched}


def test_null_empty_long_repeated_and_clashing(spark):
    long = "word " * 200_000
    rows = [(5, None, 1), (3, "", 1), (4, " \n", 1), (7, long, 1), (6, long, 1), (6, long, 2), (None, long, 3), (8, "A b C", 1)]
    rows += [(9, "a B c", 1), (2, "other", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r.component_id for r in found}
    assert by_id == {5: 3, 3: 3, 4: 3, 7: 6, 6: 6, None: 6, 8: 8, 9: 8, 2: 2}
    assert all(r.fingerprint == 0 for r in found if r.doc_id in (3, 4, 5))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
