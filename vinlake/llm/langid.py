"""Language identification by unigram pieces with all segmentations summed.

Every language has a probability for each piece of a fixed public vocabulary. A word's probability is the
sum over all ways of writing it as pieces of the product of their probabilities, which the forward
algorithm gives in one pass over its letters. A text's is the product over its words.

The probabilities are learned by expectation-maximisation on the words of a bounded sample, at most about
``ROWS`` ids of each language, one text of each: expected uses of a piece under all segmentations (forward and
backward sums) over all uses, with ``SMOOTHING`` uses added to every piece.
"""

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinlake.llm.common import remainder, short_batches, stored, unit_hash

ROWS = 2_000
ROUNDS = 3
SMOOTHING = 0.05
LONG = 256  # letters; longer words are scored one by one, in logs, and not learned from
SEED = 3
UNKNOWN = "und"
START = "▁"  # how the vocabulary writes the beginning of a word
_WORD = re.compile(r"[^\W\d_]+")
_LETTER = regex.compile(r"\p{L}")
_REMEMBERED = 1 << 19
_TINY = 1e-250  # smaller sums are taken in logs, before they lose digits or become 0


def pieces_of(path: str) -> list[str]:
    """Lower-cased pieces of letters in a vocabulary file, and the beginning of a word."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = {model.id_to_piece(place).lower() for place in range(model.get_piece_size())}
    return sorted(piece for piece in every if re.fullmatch(rf"{START}?[^\W\d_]*", piece) and piece)


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    return _WORD.findall(text.lower()) if text else []


class Pieces:
    """The vocabulary as a trie: states by letters, the number of the piece that ends in each; the last number is for a letter
    that is no piece."""

    def __init__(self, pieces: list[str]):
        self.number = {piece: place for place, piece in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        letters = sorted({letter for piece in pieces for letter in piece})
        # Letters as columns of the table; column 0 is for all letters of no piece, state 0 for what no piece begins with.
        self.column = np.zeros(0x110000, dtype=np.int32)
        self.column[[ord(letter) for letter in letters]] = np.arange(1, len(letters) + 1)
        steps, ends = [{}, {}], [-1, -1]
        for piece, place in self.number.items():
            state = 1
            for letter in piece:
                column = int(self.column[ord(letter)])
                if column not in steps[state]:
                    steps[state][column] = len(steps)
                    steps.append({})
                    ends.append(-1)
                state = steps[state][column]
            ends[state] = place
        self.ends = np.array(ends, dtype=np.int32)
        # Few of all states and letters go together: steps are kept in a hash table, the next place free where two meet.
        self.width = len(letters) + 1
        links = [(state * self.width + column, to) for state, following in enumerate(steps) for column, to in following.items()]
        self.bits = max(4, (4 * len(links)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.targets = np.zeros(1 << self.bits, dtype=np.int32)
        for (key, to), place in zip(links, self._places(np.array([key for key, _ in links], np.int64)).tolist(), strict=True):
            while self.keys[place] >= 0:
                place = (place + 1) % len(self.keys)
            self.keys[place], self.targets[place] = key, to

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, states: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """The states that letters lead to, 0 where no piece goes on."""
        keys = states.astype(np.int64) * self.width + columns
        places = self._places(keys)
        there = self.keys[places]
        out = np.where(there == keys, self.targets[places], 0)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            places[left] = (places[left] + 1) % len(self.keys)
            there = self.keys[places[left]]
            hit = there == keys[left]
            out[left[hit]] = self.targets[places[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out

    def columns(self, words: list[str]) -> np.ndarray:
        """Table columns of the letters of words of one length, their beginning marked."""
        size = len(words[0]) + 1
        return self.column[np.array([START + word for word in words], dtype=f"U{size}").view(np.uint32).reshape(len(words), size)]

    def uses(self, words: list[str]) -> np.ndarray:
        """For words of one length: number of the piece that ends at each place with each length, or -1."""
        columns = self.columns(words)
        rows, size = columns.shape
        out = np.full((rows, size + 1, min(self.longest, size) + 1), -1, dtype=np.int32)
        for begin in range(size):
            alive, state = np.arange(rows), np.ones(rows, dtype=np.int32)
            for length in range(1, min(self.longest, size - begin) + 1):
                state = self.step(state, columns[alive, begin + length - 1])
                on = np.flatnonzero(state)
                if len(on) < len(alive):
                    alive, state = alive[on], state[on]
                    if not len(alive):
                        break
                out[alive, begin + length, length] = self.ends[state]
        single = out[:, 1:, 1]
        single[single < 0] = len(self.number)
        return out


def _forward(uses: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Probability of each beginning of each word under each language."""
    rows, ends, lengths = uses.shape
    sums = np.zeros((rows, ends, chances.shape[1]))
    sums[:, 0] = 1.0
    for end in range(1, ends):
        for length in range(1, min(lengths - 1, end) + 1):
            found = np.flatnonzero(uses[:, end, length] >= 0)
            if len(found):
                sums[found, end] += sums[found, end - length] * chances[uses[found, end, length]]
    return sums


def _forward_logs(uses: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """The same in logs: slower, but of any size."""
    rows, ends, lengths = uses.shape
    sums = np.full((rows, ends, logs.shape[1]), -np.inf)
    sums[:, 0] = 0.0
    for end in range(1, ends):
        for length in range(1, min(lengths - 1, end) + 1):
            found = np.flatnonzero(uses[:, end, length] >= 0)
            if len(found):
                sums[found, end] = np.logaddexp(sums[found, end], sums[found, end - length] + logs[uses[found, end, length]])
    return sums


def _long_log_chances(word: str, pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    """Log probability of one word of any length under each language, with memory for the longest piece only."""
    columns, keep = pieces.columns([word])[0], pieces.longest + 1
    unknown = len(pieces.number)
    sums = np.full((keep, logs.shape[1]), -np.inf)  # beginnings of the word, by their length modulo keep
    sums[0] = 0.0
    links = dict(zip(pieces.keys.tolist(), pieces.targets.tolist(), strict=True))
    for begin in range(len(columns)):
        here, state = sums[begin % keep].copy(), 1
        sums[begin % keep] = -np.inf
        for length, column in enumerate(columns[begin : begin + pieces.longest].tolist(), 1):
            state = links.get(state * pieces.width + column, 0)
            piece = int(pieces.ends[state]) if state else -1
            if length == 1 and piece < 0:
                piece = unknown
            if piece >= 0:
                to = (begin + length) % keep
                sums[to] = np.logaddexp(sums[to], here + logs[piece])
            if not state:
                break
    return sums[len(columns) % keep]


def by_length(words: list[str]) -> list[list[int]]:
    """Places of the words, those of one length together."""
    groups: dict[int, list[int]] = defaultdict(list)
    for place, word in enumerate(words):
        groups[len(word)].append(place)
    return list(groups.values())


def log_chances(words: list[str], pieces: Pieces, chances: np.ndarray) -> np.ndarray:
    """Log probability of each word under each language, summed over all segmentations."""
    out = np.zeros((len(words), chances.shape[1]))
    for places in by_length(words):
        if len(words[places[0]]) > LONG:
            for place in places:
                out[place] = _long_log_chances(words[place], pieces, np.log(chances))
            continue
        at_once = max(1, (1 << 16) // len(words[places[0]]))
        for some in range(0, len(places), at_once):
            part = places[some : some + at_once]
            uses = pieces.uses([words[p] for p in part])
            whole = _forward(uses, chances)[:, -1]
            tiny = np.flatnonzero((whole < _TINY).any(axis=1))
            if len(tiny):
                whole[tiny] = 1.0
            out[part] = np.log(whole)
            if len(tiny):
                out[np.asarray(part)[tiny]] = _forward_logs(uses[tiny], np.log(chances))[:, -1]
    return out


def expected_uses(words: list[str], counts: np.ndarray, pieces: Pieces, chances: np.ndarray) -> np.ndarray:
    """Expected uses of every piece by every language, for words that occur ``counts[word, language]`` times."""
    out = np.zeros_like(chances)
    for places in by_length(words):
        at_once = max(1, (1 << 16) // len(words[places[0]]))
        for some in range(0, len(places), at_once):
            part = places[some : some + at_once]
            uses, times = pieces.uses([words[p] for p in part]), counts[part]
            forward, (_, ends, lengths) = _forward(uses, chances), uses.shape
            tiny = (forward[:, -1] < _TINY).any(axis=1)
            if tiny.any():
                _add_expected_by_logs(out, uses[tiny], times[tiny], np.log(chances))
                uses, times, forward = uses[~tiny], times[~tiny], forward[~tiny]
            backward = np.zeros_like(forward)
            backward[:, -1] = times / forward[:, -1]
            for end in range(ends - 1, 0, -1):
                for length in range(1, min(lengths - 1, end) + 1):
                    found = np.flatnonzero(uses[:, end, length] >= 0)
                    if len(found):
                        number = uses[found, end, length]
                        back = backward[found, end] * chances[number]
                        backward[found, end - length] += back
                        np.add.at(out, number, forward[found, end - length] * back)
    return out


def _add_expected_by_logs(out: np.ndarray, uses: np.ndarray, times: np.ndarray, logs: np.ndarray) -> None:
    """Add the expected uses of words whose probability is too small for a plain sum."""
    forward, (_, ends, lengths) = _forward_logs(uses, logs), uses.shape
    backward = np.full_like(forward, -np.inf)
    with np.errstate(divide="ignore"):
        backward[:, -1] = np.log(times) - forward[:, -1]
    for end in range(ends - 1, 0, -1):
        for length in range(1, min(lengths - 1, end) + 1):
            found = np.flatnonzero(uses[:, end, length] >= 0)
            if len(found):
                number = uses[found, end, length]
                back = backward[found, end] + logs[number]
                backward[found, end - length] = np.logaddexp(backward[found, end - length], back)
                np.add.at(out, number, np.exp(forward[found, end - length] + back))


@dataclass
class Model:
    """Languages, vocabulary and the probability of each piece in each language."""

    languages: list[str]
    pieces: Pieces
    chances: np.ndarray


def sample(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """``lang, text`` of about ``rows`` documents of every language, outside the held-out third."""
    known = docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.filter(F.coalesce(remainder(F.col("doc_id"), 3) != 1, F.lit(False)))
    # One row per language; the number of languages does not grow with the documents. Ids count once, however often they are there.
    counts = {row.lang: row.n for row in known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()}
    if not counts:
        return known.limit(0).select("lang", "text")
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, rows / n))])
    some = known.filter(unit_hash(F.lit(SEED), "doc_id") < share[F.col("lang")])
    return some.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")


def fit(docs: DataFrame, path: str, rows: int = ROWS) -> Model:
    """Learn the probabilities; the vocabulary file is read on the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                found[lang].update(word for word in words_of(text) if len(word) <= LONG)
            flat = [(lang, word, n) for lang, many in found.items() for word, n in many.items()]
            yield pd.DataFrame(flat, columns=["lang", "word", "n"])

    counted = sample(docs, rows).mapInPandas(count, "lang string, word string, n long")
    counted = stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    languages = [row.lang for row in counted.select("lang").distinct().orderBy("lang").collect()]
    pieces = Pieces(pieces_of(path))
    place = {lang: number for number, lang in enumerate(languages)}
    chances = np.full((len(pieces.number) + 1, len(languages)), 1.0 / (len(pieces.number) + 1))
    context = docs.sparkSession.sparkContext

    for _ in range(ROUNDS if languages else 0):
        shared = context.broadcast((pieces, place, chances))

        def expect(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            pieces, place, chances = shared.value
            sums = np.zeros_like(chances)
            for batch in batches:
                words, row = np.unique(batch["word"].to_numpy(str), return_inverse=True)
                counts = np.zeros((len(words), len(place)))
                counts[row, batch["lang"].map(place)] = batch["n"]
                sums += expected_uses(words.tolist(), counts, pieces, chances)
            piece, lang = np.nonzero(sums)
            yield pd.DataFrame({"piece": piece, "lang": lang, "uses": sums[piece, lang]})

        spread = counted.repartition("word").mapInPandas(expect, "piece int, lang int, uses double")
        # At most a row per piece and language.
        found = spread.groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toPandas()
        sums = np.full_like(chances, SMOOTHING)
        sums[found["piece"], found["lang"]] += found["uses"]
        chances = sums / sums.sum(axis=0)
        shared.unpersist()
    return Model(languages, pieces, chances)


class Scorer:
    """Scores texts and remembers the words met so far."""

    def __init__(self, model: Model):
        self.model, self.place = model, {}
        self.known = np.zeros((0, len(model.languages)))

    def _learn(self, words: set[str]) -> None:
        if len(self.place) + len(words) > _REMEMBERED:
            self.place, self.known = {}, self.known[:0]
        new = sorted(words)
        self.place.update({word: len(self.known) + place for place, word in enumerate(new)})
        self.known = np.concatenate((self.known, log_chances(new, self.model.pieces, self.model.chances)))

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Likeliest language and its probability among the languages, each as likely beforehand."""
        many, languages = [words_of(text) for text in texts], self.model.languages
        new = {word for words in many for word in words}
        if not new.issubset(self.place.keys()):
            if len(self.place) + len(new) > _REMEMBERED:
                self._learn(new)
            else:
                self._learn(new - self.place.keys())
        out = []
        for text, words in zip(texts, many, strict=True):
            if not words or not languages or not _LETTER.search(text):
                out.append((UNKNOWN, 0.0))
                continue
            at = np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))
            sums = self.known[at].sum(axis=0)
            likely = np.exp(sums - sums.max())
            best = int(likely.argmax())
            out.append((languages[best], float(likely[best] / likely.sum())))
        return out


def chunks(texts: list[str | None], letters: int = 1 << 20) -> Iterator[list[str | None]]:
    """The texts in order, some at a time, about so many characters together."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text or "")
        if size >= letters:
            yield some
            some, size = [], 0
    if some:
        yield some


def predictor(docs: DataFrame, model: Model):
    """A function of a text column that gives STRUCT<lang_pred, score>."""
    short_batches()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in batches:
            found = [one for some in chunks(texts.tolist()) for one in scorer.score(some)]
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, path: str, rows: int = ROWS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document.

    ``docs`` has doc_id, text and lang (which only training reads); other columns are not read. NULL texts
    and texts without a letter are ``und`` with score 0, and so is every text if no row has a language.
    Repeated rows get equal results; equally likely languages go to the first in code point order.
    A NULL id is not held out, and not learned from either.
    """
    predict = predictor(docs, fit(docs, path, rows))
    predicted = docs.select("doc_id", predict(F.col("text")).alias("_found"))
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "_found.lang_pred", "_found.score")


def held_out(doc_id: Column) -> Column:
    """The third of the ids that is not learned from."""
    return F.coalesce(remainder(doc_id, 3) == 1, F.lit(False))
