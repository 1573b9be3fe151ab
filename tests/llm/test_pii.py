import hashlib
import random
import re

from pyspark.sql import functions as F

from vinlake.llm import pii
from vinlake.llm.common import table

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in match[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{match.start()}:{match.end()}")
    return out


def test_whole_table_against_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = dict(docs.select("doc_id", "text").collect())
    rows = pii.find(docs).collect()
    assert len(rows) == len(texts) and any(r.spans for r in rows)
    for r in rows:
        expected = plain(texts[r.doc_id])
        assert r.base_spans == ",".join(expected)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in expected) for k in PLAIN]
        assert set(expected) <= set(r.spans.split(","))


def test_made_texts_against_brute_force(spark):
    chance, texts = random.Random(8), []
    parts = ["a.b", "x", "@", "@", ".", "..", "-", "--", " ", "  ", "+", "1", "12", "255", "256", "00", "(", ")", "4035787455641871", "é", "😀", "_", "\n", "com"]
    for _ in range(3_000):
        texts.append("".join(chance.choices(parts, k=chance.randint(1, 40))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(docs).collect():
        assert r.base_spans == ",".join(plain(texts[r.doc_id])), texts[r.doc_id]


def test_doubtful_candidates_and_masking(spark):
    rows = [(i, f"card 4035787455641871 mail bob.{i}@mail.example.com and call +1 (799) 555-37{i:02d} now") for i in range(40)]
    rows += [(100 + i, f"please call (799) 555-37{i:02d} or 799-555-37{i:02d} now") for i in range(10)]
    rows += [(200, "order 1234567890123456 of yesterday"), (201, "Écrire à a@b.com@c.org, 1.2.3.4 +49 170.116.163.254")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_spans", F.lit(1))
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    assert found[200].base_spans == "" and found[200].spans == ""
    assert all(set(plain(t)) <= set(found[i].spans.split(",")) or not plain(t) for i, t in rows)
    masked = {r.doc_id: r for r in pii.mask(docs).collect()}
    assert masked[3].text == "card [CARD] mail [EMAIL] and call [PHONE] now" and masked[3]["_spans"] == 1
    assert masked[200].text == rows[-2][1]
    assert "@" not in masked[201].text.replace("@c.org", "") and "[IP]" in masked[201].text


def test_null_empty_long_and_repeated(spark):
    def text(n):
        return "1" * n + " " + "a." * n + "@b" + ".c" * n + " 1-1" * n + " +1 799 555 3729"

    rows = [(1, None), (2, ""), (3, text(2_000)), (3, text(2_000)), (None, "a@b.co")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = pii.find(docs).collect()
    assert len(out) == 5
    for r in out:
        assert r.base_spans == ",".join(plain(dict(rows)[r.doc_id]))
        assert r.spans or r.doc_id != 3
    longer = spark.createDataFrame([(1, text(100_000))], "doc_id long, text string")
    assert pii.find(longer).first().n_email == 1
    assert pii.find(docs.limit(0)).count() == 0 and pii.mask(docs.limit(0)).count() == 0
    assert {r.doc_id: r.text for r in pii.mask(docs).collect()}[1] is None


def test_digest_of_the_query(spark, folder):
    from vinlake.llm.queries import op8_pii

    texts = dict(table(spark, folder, "documents").select("doc_id", "text").collect())
    for r in op8_pii(spark, folder).collect():
        assert r.base_sha256 == hashlib.sha256(",".join(plain(texts[r.doc_id])).encode()).hexdigest()
