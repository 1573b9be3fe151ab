"""BPE encoding and decoding by a deterministic automaton that merges build up gadget by gadget.

States and arc labels are token ids. The first automaton has one arc per byte from every state: any
sequence of byte tokens is allowed. The gadget of merge number k, ``(u, v) -> w``, changes it so:

* the arc v is cut from the state reached by u, since from now on "u v" is written "w";
* a state w is added, a copy of state v as it was before this cut: what may follow w is what could
  follow v;
* an arc w is added wherever the arc u was left after this cut (so "a a a" gives "aa a", never "a aa").

The copies are made on first use (copy on write): ``cut_at(s, t)`` follows a copied state or arc to
what it was copied from and compares the number of the merge at which the arc was cut there. After the
last merge exactly one path spells any given word, and that path is its encoding. Each prefix of a word
has exactly one such path too, so reading a word from left to right has one state per position: the
only label ending there whose arc leaves the state at which the label begins. Words that begin with the
same bytes share these states, so they are kept for the beginnings met so far. Labels ending at a byte are
found by a byte-driven table (a trie with links to the next shorter suffix); decoding writes the bytes
that each arc stands for.
"""

import json
import re
import struct
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from vinlake.llm.common import short_batches

# How byte-level tokenizers split a text before encoding, and the white space they mean.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
NEVER = 1 << 40  # later than any merge
UNBORN = -1
REMEMBERED = 3 << 16  # chunks and words whose encoding a Python worker keeps, and as many that it met before them
BEGINNING = 5  # bytes of a word whose states are kept
BEGINNINGS = 1 << 16  # so many at most


def byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte: itself if it prints, else one from 256 up."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + place): byte for place, byte in enumerate(hidden)}


class MergeAutomaton:
    """The automaton of a list of merges over bytes."""

    def __init__(self, byte_ids: dict[int, int], merges: list[tuple[int, int, int]]):
        """byte_ids: token id by byte; merges: (left id, right id, merged id) in order."""
        self.born: dict[int, int] = {}
        self.copied: dict[int, tuple[int, int]] = {}
        self.cut: dict[tuple[int, int], int] = {}
        self.label: dict[int, bytes] = {}
        self.arcs: dict[tuple[int, int], int] = {}
        for byte, token in byte_ids.items():
            self.born[token] = UNBORN
            self.label[token] = bytes([byte])
        for number, (left, right, merged) in enumerate(merges):
            self._gadget(number, left, right, merged)
        self.arcs.clear()  # only what text needs is kept from here on
        self.begun: dict[bytes, tuple[int, list[int]]] = {}
        self._link_labels()

    def _link_labels(self) -> None:
        """Tables by node, one node for each prefix of a label: next nodes, node of the longest shorter
        suffix, and the labels that end here as (token, length), the longest first."""
        self.next: list[dict[int, int]] = [{}]
        ends: list[tuple[tuple[int, int], ...]] = [()]
        for token, label in self.label.items():
            node = 0
            for byte in label:
                if byte not in self.next[node]:
                    self.next[node][byte] = len(self.next)
                    self.next.append({})
                    ends.append(())
                node = self.next[node][byte]
            ends[node] = ((token, len(label)),)
        self.shorter, self.ends = [0] * len(self.next), ends
        waiting = deque(self.next[0].values())
        while waiting:
            node = waiting.popleft()
            self.ends[node] += self.ends[self.shorter[node]]
            for byte, child in self.next[node].items():
                other = self.shorter[node]
                while other and byte not in self.next[other]:
                    other = self.shorter[other]
                self.shorter[child] = self.next[other].get(byte, 0)
                waiting.append(child)

    def _gadget(self, number: int, left: int, right: int, merged: int) -> None:
        if left not in self.born or right not in self.born or merged in self.born:
            return
        if self.cut_at(left, right) <= number:
            return  # no path goes along this arc any more, so the merge never applies
        self.cut[left, right] = number
        self.arcs[left, right] = number
        self.born[merged] = number
        self.copied[merged] = (left, right)
        self.label[merged] = self.label[left] + self.label[right]

    def cut_at(self, state: int, arc: int) -> int:
        """The merge that cut this arc from this state; UNBORN if it never was there, NEVER if it is still."""
        known = self.arcs.get((state, arc))
        if known is None:
            since_state, since_arc = self.born[state], self.born[arc]
            if since_state == since_arc == UNBORN:
                there = True
            elif since_arc >= since_state:
                there = self.cut_at(state, self.copied[arc][0]) > since_arc
            else:
                there = self.cut_at(self.copied[state][1], arc) >= since_state
            known = self.cut.get((state, arc), NEVER) if there else UNBORN
            if len(self.arcs) > 1 << 20:
                self.arcs.clear()
            self.arcs[state, arc] = known
        return known

    def _walk(self, part: bytes, node: int, state: list[int]) -> int:
        """Append the state after each byte of ``part``; ``node`` is that of the table before it, the result that after it."""
        known, cut_at, follow, shorter, ends = self.arcs.get, self.cut_at, self.next, self.shorter, self.ends
        place = len(state)
        for byte in part:
            step = follow[node]
            while byte not in step:
                node = shorter[node]
                step = follow[node]
            node = step[byte]
            for token, length in ends[node]:
                if length == place:
                    break
                arc = state[place - length], token
                until = known(arc)
                if (cut_at(*arc) if until is None else until) == NEVER:
                    break
            state.append(token)
            place += 1
        return node

    def encode(self, word: bytes) -> list[int]:
        """The ids on the only path that spells the word."""
        beginning = word[:BEGINNING]
        begun = self.begun.get(beginning)
        if begun is None:
            state = [-1]
            begun = self._walk(beginning, 0, state), state
            if len(self.begun) >= BEGINNINGS:
                self.begun.clear()
            self.begun[beginning] = begun
        node, state = begun
        size = len(word)
        if size > BEGINNING:
            state = state.copy()
            self._walk(word[BEGINNING:], node, state)
        path, label = [], self.label
        while size:
            token = state[size]
            path.append(token)
            size -= len(label[token])
        path.reverse()
        return path


class Tokenizer:
    """A byte-level vocabulary file as an automaton, with memory for the chunks met so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary, letters = content["model"]["vocab"], byte_letters()
        pairs = (pair if isinstance(pair, list) else pair.split(" ") for pair in content["model"]["merges"])
        merges = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs]
        self.automaton = MergeAutomaton({byte: vocabulary[letter] for letter, byte in letters.items()}, merges)
        added = {entry["content"]: entry["id"] for entry in content.get("added_tokens", [])}
        self.added = {text: np.uint32(token).tobytes() for text, token in added.items()}
        self.labels = self.automaton.label | {token: text.encode() for text, token in added.items()}
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.split = regex.compile(SPLIT)
        # A chunk is white space and what follows it. No match of the split goes on past the end of a chunk.
        self.chunks = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
        # A word is one match of the split by itself too, so chunks and words share one memory.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _remember(self, part: str, packed: bytes) -> bytes:
        """Keep what a part is encoded to. When the memory is full, parts not met again until it next is are forgotten."""
        if len(self.known) >= REMEMBERED:
            self.older = self.known.copy()
            self.known.clear()
        if len(part) <= 64:
            self.known[part] = packed
        return packed

    def _word(self, word: str) -> bytes:
        packed = self.older.get(word)
        if packed is None:
            ids = self.automaton.encode(word.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
        return self._remember(word, packed)

    def _chunk(self, chunk: str) -> bytes:
        packed = self.older.get(chunk)
        if packed is None:
            words = self.split.findall(chunk)
            if len(words) == 1:
                return self._word(chunk)
            known, new = self.known.get, self._word
            packed = b"".join([known(word) or new(word) for word in words])
        return self._remember(chunk, packed)

    def forget(self) -> None:
        """Let go of all that was met so far; the automaton stays."""
        for memory in (self.known, self.older, self.automaton.arcs, self.automaton.begun):
            memory.clear()

    def _plain(self, text: str) -> bytes:
        known, new = self.known.get, self._chunk
        return b"".join([known(chunk) or new(chunk) for chunk in self.chunks.findall(text)])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.parts is None or not any(special in text for special in self.added):
            return self._plain(text)
        return b"".join(self.added.get(part) or self._plain(part) for part in self.parts.split(text))

    def decode(self, ids: bytes | None) -> str:
        """The text that ids stand for; bytes that are no UTF-8 become U+FFFD."""
        if not ids:
            return ""
        label = self.labels
        return b"".join([label[token] for token in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


@cache
def tokenizer(path: str) -> Tokenizer:
    """One automaton per Python worker and file."""
    return Tokenizer(path)


def encode(text: Column, path: str) -> Column:
    """Token ids of a text as BINARY, four little-endian bytes each; NULL gives none, like the empty text.

    ``path`` names a byte-level vocabulary file that is installed on every executor. What a task has met is forgotten
    with it: Python workers stay for the stages and jobs that follow, and these need their executor's memory themselves.
    """

    short_batches()

    @F.pandas_udf(BinaryType())
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = tokenizer(path)
        try:
            for texts in batches:
                yield pd.Series([own.encode(one) for one in texts], dtype=object)
        finally:
            own.forget()

    return apply(text)


def decode(ids: Column, path: str) -> Column:
    """The text of token ids as ``encode`` gives them; NULL gives the empty text."""

    short_batches()

    @F.pandas_udf(StringType())
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for many in batches:
            yield pd.Series([tokenizer(path).decode(one) for one in many], dtype=object)

    return apply(ids)


def encode_and_decode(text: Column, path: str) -> Column:
    """STRUCT of ``ids`` and the text ``decoded`` from them, in one pass through one Python worker."""
    short_batches()
    kind = StructType([StructField("ids", BinaryType()), StructField("decoded", StringType())])

    @F.pandas_udf(kind)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            own = tokenizer(path)
            ids = [own.encode(one) for one in texts]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(map(own.decode, ids), dtype=object)})

    return apply(text)


def token_count(ids: Column) -> Column:
    """How many ids a BINARY of ids holds."""
    return (F.length(ids) / 4).cast("bigint")


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and decoded of every row of ``docs``, which has doc_id and text and may have other columns.

    A NULL or empty text gives no ids and an empty text back. Repeated rows are encoded each. An
    empty table gives an empty result. Any text fits: long runs without white space are encoded in
    time that grows with their length. No shuffle.
    """
    return docs.select("doc_id", encode_and_decode(F.col("text"), path).alias("_bpe")).select("doc_id", "_bpe.ids", "_bpe.decoded")
