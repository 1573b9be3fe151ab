"""Phrases whose words come together more often than chance, from a weighted de Bruijn graph of the corpus.

Nodes are phrases of one word less than the longest, edges the longest phrases: from their first words to their last ones, weighted by
their occurrences. Only edges are counted in the texts. Where a piece of text ends, the words that begin no whole edge are kept as
shorter ones, the correction for the end of the piece. What begins with a phrase is then all that flows out of its node:
counts of shorter phrases are sums over edges by their first words.

Edges are dealt out by their first word, so each shorter count is a sum within a task. A word that begins very many edges is dealt
by its following words as well and its sums are put together afterwards. Which words these are is guessed from a sample; it
decides where edges go, never what is counted.

Nodes that pass all their flow from one edge to one other are *unary*; paths of them are compacted. A unary node's phrase
occurs only inside the longer one, so no candidate remains within a path but its edges.
"""

import gc
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vinlake.llm.common import short_batches, stored, unit_hash

LONGEST = 3  # words of an edge
LEAST = 10  # occurrences of a candidate
SHARE = 50  # hundredths of its occurrences in a longer candidate that drop a candidate
TOP = 2_000  # candidates of a language that are returned
HELD = 300_000  # different edges that a task adds up before it passes them on
HEAVY = 2_000  # a word with more than one of so many sampled words is dealt out by its following words
SALTS = 64
SAMPLE = 20_000  # documents, about, that the heavy words are taken from
SEED = 13
UNKNOWN = "und"
# Lower-case A-Z, a line feed for what ends a piece, a space for what ends a word.
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


def pieces_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of each piece."""
    for piece in text.translate(_BYTES).split(b"\n"):
        words = piece.split(b" ")
        if b"" in words:
            words = [word for word in words if word]
        if words:
            yield words


def edges_of(words: list[bytes], longest: int) -> Iterator[tuple[bytes, ...]]:
    """What begins at each word: the longest phrase, filled up with empty words where the piece ends."""
    filled = [*words, *[b""] * (longest - 1)]
    return zip(*[islice(filled, begin, begin + len(words)) for begin in range(longest)], strict=True)


def heavy_words(docs: DataFrame, share: float) -> set[tuple[str, bytes]]:
    """Languages and words that make up more than 1 in ``HEAVY`` words of a sample: fewer than ``HEAVY`` altogether."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["bytes"], strict=True):
                for words in pieces_of(text.as_py()):
                    found.update((lang, word) for word in words)
            total = sum(found.values())
            if len(found) > HELD:  # rare so far, and only balance rests on it
                found = Counter({word: n for word, n in found.items() if n * HEAVY > total})
        if found:
            total = sum(found.values())
            kept = [(*word, n) for word, n in found.items() if n * 4 * HEAVY > total] + [("", b"", total)]
            langs, words, numbers = zip(*kept, strict=True)
            arrays = [pa.array(langs, pa.string()), pa.array(words, pa.binary()), pa.array(numbers, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "word", "n"])

    sampled = docs.filter(F.rand(SEED) < share).mapInArrow(count, "lang string, word binary, n long")
    counted = stored(sampled.groupBy("lang", "word").agg(F.sum("n").alias("n")), "heavy")
    total = counted.filter(F.col("word") == F.lit(b"")).agg(F.max("n")).first()[0] or 0
    return {(row.lang, bytes(row.word)) for row in counted.filter((F.col("n") * HEAVY > total) & (F.length("word") > 0)).collect()}


def _salt(lang: str, edge: tuple[bytes, ...], heavy: set) -> bytes:
    """Empty, or where an edge of a heavy word goes: ``s`` by its second word, ``h`` by all if that is heavy too."""
    if (lang, edge[0]) not in heavy:
        return b""
    if len(edge) < 3 or (lang, edge[1]) not in heavy:
        return b"s%d" % (crc32(edge[1]) % SALTS)
    return b"h%d" % (crc32(b" ".join(edge[1:])) % SALTS)


def edges(docs: DataFrame, longest: int, heavy: set) -> DataFrame:
    """``first, rest, n``: first word with salt and language behind line feeds, the following words, occurrences added up per task.

    A row with an empty first word holds the number of all words of the language.
    """

    def spell(lang: str, counted: Counter) -> pa.RecordBatch:
        hot = {word for one, word in heavy if one == lang}
        words = [pa.array([edge[place] for edge in counted], pa.binary()) for place in range(longest)]
        salts = pa.array([_salt(lang, edge, heavy) if edge[0] in hot else b"" for edge in counted], pa.binary())
        language, line, space = (pa.scalar(part, pa.binary()) for part in (lang.encode(), b"\n", b" "))
        first = pc.binary_join_element_wise(words[0], salts, language, line).cast(pa.string())
        rest = pc.ascii_rtrim(pc.binary_join_element_wise(*words[1:], space).cast(pa.string()), " ")
        batch = pa.RecordBatch.from_arrays([first, rest, pa.array(list(counted.values()), pa.int64())], names=["first", "rest", "n"])
        # Edges with the same first word follow each other, which shuffle files compress well.
        return batch.take(pa.array(np.argsort(np.fromiter(map(hash, [edge[0] for edge in counted]), np.int64, len(counted)))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # millions of small tuples, none in a circle
        try:
            held: dict[str, Counter] = defaultdict(Counter)
            words_of: Counter = Counter()
            for batch in batches:
                for lang, text in zip(batch["lang"].to_pylist(), batch["bytes"], strict=True):
                    mine = held[lang]
                    for words in pieces_of(text.as_py()):
                        words_of[lang] += len(words)
                        mine.update(edges_of(words, longest))
                        if len(mine) > HELD:
                            yield spell(lang, mine)
                            mine.clear()
                if sum(map(len, held.values())) > HELD:
                    for lang, mine in held.items():
                        if mine:
                            yield spell(lang, mine)
                            mine.clear()
            for lang, mine in held.items():
                if words_of[lang]:
                    mine[(b"",) * longest] = words_of[lang]
                    yield spell(lang, mine)
        finally:
            gc.enable()

    return docs.mapInArrow(count, "first string, rest string, n long")


def counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``lang, phrase, size, n``: phrases of up to ``longest`` words with at least ``least`` occurrences; size 0 for all words."""
    texts = docs.select(
        F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("bytes")
    )
    short_batches()
    share = SAMPLE / max(SAMPLE, docs.count())
    spread = edges(texts, longest, heavy_words(texts, share)).repartition("first")
    word, salt = F.substring_index("first", "\n", 1), F.split("first", "\n", 3)[1]
    lang = F.split("first", "\n", 3)[2]
    # Flow out of the nodes: an edge counts for all that begins with its first words, and so does the end of a piece.
    begins = [F.col("rest"), *[F.substring_index("rest", " ", words) for words in range(longest - 2, 0, -1)], F.lit("")]
    shorter = [F.when(more != less, less) for more, less in zip(begins, begins[1:], strict=False)]
    flows = spread.select("first", F.explode(F.array(F.col("rest"), *shorter)).alias("rest"), "n").filter(F.col("rest").isNotNull())
    flows = flows.groupBy("first", "rest").agg(F.sum("n").alias("n"))
    size = F.when(word == "", 0).when(F.col("rest") == "", 1).otherwise(F.size(F.split("rest", " ")) + 1)
    partial = F.when(F.col("rest") == "", salt != "").otherwise(salt.startswith("h"))
    phrase = F.concat_ws(" ", word, F.when(F.col("rest") != "", F.col("rest")))
    own = flows.filter((F.col("n") >= least) | partial | (word == ""))
    own = own.select(lang.alias("lang"), phrase.alias("phrase"), size.alias("size"), "n")
    found = own.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    return stored(found.filter((F.col("n") >= least) | (F.col("size") == 0)), "counts")


def _words(phrase: str, begin: Column | int, number: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), begin, number), " ")


def unary_links(counted: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``lang, node, to``: for each unary node, the node that its only edge leads to."""
    edge = counted.filter(F.col("size") == longest).select(
        "lang", _words("phrase", 1, longest - 1).alias("node"), _words("phrase", 2, longest - 1).alias("to"), "n"
    )
    node = counted.filter(F.col("size") == longest - 1).select("lang", F.col("phrase").alias("node"), F.col("n").alias("flow"))
    # All flow comes by one edge and leaves by one: the largest edge on each side carries the whole of it.
    inward = edge.groupBy("lang", F.col("to").alias("node")).agg(F.max("n").alias("inward"))
    outward = edge.groupBy("lang", "node").agg(F.max(F.struct("n", "to")).alias("outward"))
    joined = node.join(inward, ["lang", "node"]).join(outward, ["lang", "node"])
    unary = joined.filter((F.col("inward") == F.col("flow")) & (F.col("outward.n") == F.col("flow")))
    return unary.select("lang", "node", F.col("outward.to").alias("to"), F.col("flow").alias("n"))


def compacted(counted: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``lang, node, last, steps, n``: for each unary node, the node in which its path ends and the edges up to there.

    Each round doubles the steps (pointer jumping), so rounds grow with the logarithm of the longest path. Nodes of a circle, which
    has no end, are a path of their own each.
    """
    links = stored(unary_links(counted, longest), "links")
    total, rounds, now = links.count(), 1, links.select("lang", "node", F.col("to").alias("last"), F.lit(1).cast("long").alias("steps"), "n")
    while rounds <= max(1, total):
        ahead = now.select("lang", F.col("node").alias("last"), F.col("last").alias("further"), F.col("steps").alias("more"))
        joined = now.join(ahead, ["lang", "last"], "left")
        moved = joined.select(
            "lang", "node", F.coalesce("further", "last").alias("last"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), "n",
            F.col("further").isNotNull().alias("moved"),
        )
        now = stored(moved, "paths")
        if now.filter("moved").isEmpty():
            return now.drop("moved")
        rounds, now = 2 * rounds, now.drop("moved")
    circle = F.col("steps") > total
    here = now.join(links.select("lang", "node", "to"), ["lang", "node"])
    return here.select(
        "lang", "node", F.when(circle, F.col("to")).otherwise(F.col("last")).alias("last"), F.when(circle, 1).otherwise(F.col("steps")).cast("long").alias("steps"), "n"
    )


def scored(candidates: DataFrame, counted: DataFrame) -> DataFrame:
    """``a, l, r, score`` of each candidate, by the cut that scores lowest; of equal ones the first."""
    size = F.col("size")
    cuts = candidates.select("lang", "phrase", "size", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    cuts = cuts.withColumn("left", _words("phrase", 1, F.col("cut"))).withColumn("right", _words("phrase", F.col("cut") + 1, size))
    sides = counted.filter(size > 0)
    left = sides.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = sides.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    both = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    # Exact in 38 digits: counts up to 10^15.
    a, l, r = (F.col(name).cast("decimal(19,0)") for name in "alr")
    both = both.withColumn("above", F.lit(1_000_000).cast("decimal(7,0)") * a * a).withColumn("below", l * r)
    both = both.withColumn("score", F.expr("CAST(above div below AS BIGINT)"))
    best = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def mine(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the first ``top`` phrases of each language.

    NULL texts are empty, a NULL language is ``und``, and repeated rows count as often as they are there. Equal scores are ranked
    by occurrences, then by the bytes of the phrase. Other columns than text and lang are not read. No rows give no rows.
    """
    if longest < 2:
        raise ValueError("phrases have two words at least")
    counted = counts(docs, longest, least)
    candidates = counted.filter(F.col("size") > 1)
    if longest > 2:  # nodes within compacted paths occur in longer candidates only
        inside = compacted(counted, longest).select("lang", F.col("node").alias("phrase"))
        candidates = candidates.join(inside, ["lang", "phrase"], "left_anti")
    # A longer candidate holds one of a word more that occurs at least as often, so those decide.
    longer = counted.filter(F.col("size") > 2)
    ends = F.explode(F.array(_words("phrase", 1, F.col("size") - 1), _words("phrase", 2, F.col("size") - 1)))
    longer = longer.select("lang", ends.alias("phrase"), F.col("n").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("n"))
    )
    found = stored(scored(kept.drop("longer"), counted), "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold most phrases: the first of each part, then the first of those.
    part = F.floor(unit_hash("phrase") * SALTS)
    first = found.withColumn("part", part)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    totals = counted.filter(F.col("size") == 0).select("lang", F.col("n").alias("total"))
    ranked = ranked.filter(F.col("rank") <= top).join(totals, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


SQL = r"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (SELECT lang, w, i, unnest([1, 2, 3]) AS k FROM places),
f AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS c
  FROM grams WHERE i + k - 1 <= len(w) GROUP BY ALL
),
totals AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM f WHERE k > 1 AND c >= 10),
longer AS (
  SELECT lang, phrase, max(c) AS c FROM (
    SELECT lang, c, unnest([split_part(phrase, ' ', 1) || ' ' || split_part(phrase, ' ', 2),
                            split_part(phrase, ' ', 2) || ' ' || split_part(phrase, ' ', 3)]) AS phrase
    FROM candidates WHERE k = 3
  ) GROUP BY ALL
),
kept AS (
  SELECT a.* FROM candidates a LEFT JOIN longer b USING (lang, phrase)
  WHERE a.k = 3 OR b.c IS NULL OR 100 * b.c < 50 * a.c
),
cuts AS (
  SELECT lang, phrase, c, cut, array_to_string(string_split(phrase, ' ')[1 : cut], ' ') AS lphrase,
         array_to_string(string_split(phrase, ' ')[cut + 1 : k], ' ') AS rphrase
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept)
),
scores AS (
  SELECT cuts.lang, cuts.phrase, cuts.c AS a, x.c AS l, y.c AS r, cut,
         ((1000000::HUGEINT * cuts.c * cuts.c) // (x.c::HUGEINT * y.c)) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lphrase JOIN f y ON y.lang = cuts.lang AND y.phrase = rphrase
),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scores),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE place = 1
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
