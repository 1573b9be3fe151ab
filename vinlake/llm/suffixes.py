"""Bytes of passages that occur twice, found on Burrows-Wheeler transforms of the text around common anchors.

A string of ``LENGTH`` bytes repeats if it starts at two places of the corpus. Three steps find all such strings:

1. *Anchors.* Each window of ``LENGTH`` bytes is filed under the smallest hash of its ``GRAM``-byte strings, the leftmost
   if several are equal. Equal windows have equal anchors, so windows under an anchor that occurs at one place only
   cannot repeat. Consecutive windows with one anchor make a *piece*, and only pieces of repeated anchors go on.
2. *Groups.* Pieces under one anchor are compared with each other, equal ones once with the number of their places. A group of too
   many bytes is split by content: windows at similar distances from the anchor share a longer *core* of bytes around it, so they
   are filed under that core instead. Each split halves the distances and lengthens the core, until a group is small or all its
   windows are equal. Nothing is dropped.
3. *Interval expansion.* The pieces of a bucket of groups are sorted and transformed. Starting from its table of short
   strings, intervals of equal prefixes are extended backward, breadth first: extending strings of n bytes finds exactly the borders
   where neighbouring suffixes agree in n bytes. It stops at ``LENGTH`` bytes; neighbours without a border by then agree in all of them.
"""

from collections.abc import Iterator
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinlake.llm.common import short_batches, stored
from vinlake.operators.joins import left_join_splittable

LENGTH = 400
GRAM = 64
GROUP_BYTES = 1 << 20  # larger groups are split by content
BUCKET_BYTES = 1 << 21  # about so many bytes are transformed at once
CHUNK = 1 << 16  # windows whose anchors are looked for at once
SYMBOLS = 7  # of nine bits in a 64-bit key: what the first sort compares
_EMPTY = sha256(b"").hexdigest()
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93]


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every string of ``size`` bytes, put together from those of its halves."""
    if size == 1:
        return data.astype(np.uint64) * np.uint64(_ODD[2])
    half = size // 2
    parts = _hashes(data, half)
    last = len(data) - size + 1
    mixed = parts[:last] * np.uint64(_ODD[0]) + (parts[size - half : size - half + last] ^ np.uint64(size)) * np.uint64(_ODD[1])
    if size % 2:
        mixed += data[half : half + last] * np.uint64(_ODD[2])
    return mixed ^ (mixed >> np.uint64(31))


def pieces(text: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int, int]]:
    """``(anchor, at, windows, far)``: the anchor's hash, the first window's place, how many follow each other, bytes to the anchor."""
    width = length - gram + 1
    for begin in range(0, len(text) - length + 1, CHUNK):
        windows = min(CHUNK, len(text) - length + 1 - begin)
        part = np.frombuffer(text, np.uint8, windows + length - 1, begin)
        hashes = _hashes(part, gram)
        blocks = -(-len(hashes) // width)
        low = np.uint64((1 << (CHUNK + length).bit_length()) - 1)
        ranked = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
        ranked[: len(hashes)] = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        ranked = ranked.reshape(blocks, width)
        # Smallest of a window: the end of one block and the beginning of the next.
        ahead = np.minimum.accumulate(ranked, axis=1).ravel()
        behind = np.minimum.accumulate(ranked[:, ::-1], axis=1)[:, ::-1].ravel()
        place = (np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & low).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        many = np.diff(first, append=windows)
        signed = hashes[place[first]].view(np.int64)
        yield from zip(signed.tolist(), (first + begin).tolist(), many.tolist(), (place[first] - first).tolist(), strict=True)


def _sorted_suffixes(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotations in the order of their first ``length`` symbols at least, and the keys of their first ``SYMBOLS`` in that order."""
    size = len(symbols)
    around = np.concatenate((symbols, symbols[: SYMBOLS % size if size < SYMBOLS else SYMBOLS]))
    while len(around) < size + SYMBOLS:
        around = np.concatenate((around, symbols))
    keys = np.zeros(size, np.int64)
    for place in range(SYMBOLS):
        keys = (keys << 9) | around[place : place + size]
    order = np.argsort(keys)
    keys = keys[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    rank = np.empty(size, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(size), 0))
    known = SYMBOLS
    while known < length:
        alone = new & np.append(new[1:], True)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        some = order[open_]
        follow = some + known
        follow[follow >= size] %= size
        both = (rank[some] << 32) | rank[follow]
        by = np.argsort(both)
        some, both = some[by], both[by]
        order[open_] = some
        new[open_] = np.concatenate(([True], both[1:] != both[:-1]))
        rank[some] = np.maximum.accumulate(np.where(new[open_], open_, 0))
        known *= 2
    return order, keys


def _borders(symbols: np.ndarray, order: np.ndarray, keys: np.ndarray, length: int) -> np.ndarray:
    """Where, in sorted order, a suffix agrees in fewer than ``length`` symbols with the one before it."""
    size = len(symbols)
    border = np.zeros(size + 1, bool)
    border[0] = border[size] = True
    # The table of short strings: the place of the first symbol that differs, by the highest bit that does.
    differ = keys[1:] ^ keys[:-1]
    border[1:size] = differ != 0
    ends = np.flatnonzero(border)[1:]
    begins = np.concatenate(([0], ends[:-1]))
    last_only = np.zeros(size + 1, bool)
    last_only[1:size] = (differ != 0) & (differ < 512)
    fresh = last_only[ends]
    begins, ends = begins[fresh], ends[fresh]
    before = symbols[order - 1]  # the transform
    back = np.argsort(before, kind="stable")
    forward = np.empty(size, np.int64)
    forward[back] = np.arange(size)
    first = before[back]  # first symbols, in order
    for _ in range(SYMBOLS, length):
        if not len(begins):
            break
        counts = ends - begins
        single = counts == 1
        to = forward[begins[single]]
        found_begins, found_ends = [to], [to + 1]
        if not single.all():
            begins, ends, counts = begins[~single], ends[~single], counts[~single]
            inside = np.repeat(begins - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
            to, upper, lower = forward[inside], np.repeat(ends, counts), np.repeat(begins, counts)
            # Extensions by one symbol lie together: one ends where the next place is of another symbol or comes from outside.
            above, below = np.minimum(to + 1, size - 1), np.maximum(to - 1, 0)
            is_end = (to + 1 == size) | (first[above] != first[to]) | (back[above] >= upper)
            is_begin = (to == 0) | (first[below] != first[to]) | (back[below] < lower)
            found_begins.append(np.sort(to[is_begin]))
            found_ends.append(np.sort(to[is_end]) + 1)
        begins, ends = np.concatenate(found_begins), np.concatenate(found_ends)
        fresh = ~border[ends]
        begins, ends = begins[fresh], ends[fresh]
        border[ends] = True
    return border


def repeated_windows(contents: list[bytes], places: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each content, which of its windows occur at two places of all contents; equal contents come once, with their places."""
    sizes = np.array([len(content) for content in contents], np.int64)
    symbols = np.frombuffer(b"\0".join([*contents, b""]), np.uint8).astype(np.int64) + 1
    gaps = np.cumsum(sizes + 1) - 1
    symbols[gaps] = 0
    order, keys = _sorted_suffixes(symbols, length)
    border = _borders(symbols, order, keys, length)
    same = ~border[1:-1]
    twice = np.zeros(len(symbols), bool)
    twice[1:] |= same
    twice[:-1] |= same
    repeated = np.zeros(len(symbols), bool)
    repeated[order[twice]] = True
    out = []
    for gap, size, many in zip(gaps.tolist(), sizes.tolist(), places, strict=True):
        windows = max(0, size - length + 1)
        out.append(np.ones(windows, bool) if many > 1 else repeated[gap - size : gap - size + windows])
    return out


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Beginning and end of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _find_pieces(length: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["key"].to_pylist(), batch["bytes"], strict=True):
                rows += [(key, *piece) for piece in pieces(text.as_py(), length, min(GRAM, length))]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "anchor", "at", "windows", "far"])

    return find


def _cut_out(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, found in zip(batch["key"].to_pylist(), batch["bytes"], batch["found"].to_pylist(), strict=True):
                text, rows = text.as_py(), []
                for one in found:
                    content = text[one["at"] : one["at"] + one["windows"] + length - 1]
                    rows.append((one["anchor"], key, one["at"], one["far"], md5(content).digest(), content))
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["grp", "key", "at", "far", "digest", "content"])

    return cut


def _split(rows: DataFrame, width: int, length: int) -> DataFrame:
    """Pieces cut to blocks of ``width`` distances from the anchor, each grouped by the core that all its windows share."""
    windows = F.octet_length("content") - (length - 1)
    blocks = F.sequence(F.floor((F.col("far") - windows + 1) / width), F.floor(F.col("far") / width))
    cut = rows.withColumn("block", F.explode(blocks)).withColumn("low", F.col("block").cast("int") * F.lit(width))
    cut = cut.withColumn("skip", F.greatest(F.lit(0), F.col("far") - F.col("low") - F.lit(width - 1)))
    cut = cut.withColumn("last", F.least(windows - 1, F.col("far") - F.col("low")))
    part = F.substring("content", F.col("skip") + 1, F.col("last") - F.col("skip") + F.lit(length))
    far = F.col("far") - F.col("skip")
    core = F.substring(part, far - F.col("low") + 1, F.lit(length - width + 1))
    return cut.select(
        F.xxhash64("grp", "low", core).alias("grp"),
        "key",
        (F.col("at") + F.col("skip")).alias("at"),
        far.alias("far"),
        F.unhex(F.md5(part)).alias("digest"),
        part.alias("content"),
    )


def _in_small_groups(members: DataFrame, length: int, most: int) -> list[DataFrame]:
    """The members, those of groups above ``most`` bytes of different contents split until none is left or their windows are equal."""
    done, width = [], 1 << (length - 1).bit_length()
    while width > 1:
        different = members.select("grp", "digest", F.octet_length("content").alias("size")).distinct()
        large = different.groupBy("grp").agg(F.sum("size").alias("size")).filter(F.col("size") > most).select("grp")
        large = stored(large, "large_groups")
        if large.isEmpty():
            break
        width //= 2
        done.append(left_join_splittable(members, large, "grp", "left_anti"))
        members = stored(_split(left_join_splittable(members, large, "grp", "left_semi"), width, length), "split")
    return [*done, members]


def _expand(length: int):
    def expand(table: pa.Table) -> pa.Table:
        contents = table["content"].to_pylist()
        found = repeated_windows(contents, table["places"].to_pylist(), length)
        rows = [
            (md5(content).digest(), [{"begin": a, "end": b} for a, b in runs(flags)])
            for content, flags in zip(contents, found, strict=True)
            if flags.any()
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 2
        kinds = [pa.binary(), pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["digest", "runs"])

    return expand


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _removals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, text, spans in zip(batch["key"].to_pylist(), batch["bytes"], batch["spans"].to_pylist(), strict=True):
            text, spans = text.as_py(), merged([(one["begin"], one["end"]) for one in spans])
            left, last = sha256(), 0
            for begin, end in spans:
                left.update(text[last:begin])
                last = end
            left.update(text[last:])
            packed = [{"begin": begin, "end": end} for begin, end in spans]
            rows.append((key, sum(end - begin for begin, end in spans), packed, left.hexdigest()))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = [pa.binary(), pa.int64(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.string()]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "n_removed", "spans", "kept_sha256"])


def key_of(text: Column) -> Column:
    """Half the SHA-256 of a text's bytes: equal texts are looked at once, under this key."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def repeated_spans(texts: DataFrame, length: int = LENGTH, most: int = GROUP_BYTES) -> DataFrame:
    """``key, n_removed, spans, kept_sha256`` of the texts (``key, bytes``) that hold a string of ``length`` bytes which starts at
    two places of *different* texts, or twice in one. Rows with the same key are one text."""
    if length <= SYMBOLS:
        raise ValueError(f"length must be above {SYMBOLS}")
    long = texts.filter(F.octet_length("bytes") >= length)
    found = long.mapInArrow(_find_pieces(length), "key binary, anchor long, at int, windows int, far int")
    found = stored(found, "pieces")
    # An anchor counts if it stands at two places; copies of a text are one.
    place = [F.xxhash64("key", "at"), F.xxhash64("at", "key", F.lit(1))]
    ends = [F.struct(*[function(one) for one in place]) for function in (F.min, F.max)]
    repeated = found.groupBy("anchor").agg(ends[0].alias("low"), ends[1].alias("high")).filter("low != high").select("anchor")
    kept = left_join_splittable(found, repeated, "anchor", "left_semi")
    per_text = kept.groupBy("key").agg(F.collect_set(F.struct("at", "anchor", "windows", "far")).alias("found"))
    once = long.groupBy("key").agg(F.any_value("bytes").alias("bytes"))
    chosen = stored(once.join(per_text, "key"), "texts")
    kinds = "grp long, key binary, at int, far int, digest binary, content binary"
    members = stored(chosen.mapInArrow(_cut_out(length), kinds), "members")
    groups = _in_small_groups(members, length, most)
    facts = []
    for rows in groups:
        different = rows.groupBy("grp", "content").agg(F.count("*").alias("places"))
        different = stored(different, "contents")
        total = different.agg(F.sum(F.octet_length("content"))).first()[0] or 0
        buckets = F.pmod(F.xxhash64(F.lit(1), "grp"), F.lit(1 + total // BUCKET_BYTES))
        kinds = "digest binary, runs array<struct<begin: int, end: int>>"
        hits = stored(different.groupBy(buckets.alias("bucket")).applyInArrow(_expand(length), kinds), "hits")
        joined = left_join_splittable(rows.select("key", "at", "digest"), hits, "digest", "inner")
        one = F.explode("runs").alias("run")
        span = F.struct(
            (F.col("at") + F.col("run.begin")).alias("begin"), (F.col("at") + F.col("run.end") + F.lit(length - 1)).alias("end")
        )
        facts.append(joined.select("key", "at", one).select("key", span.alias("span")))
    spans = facts[0]
    for more in facts[1:]:
        spans = spans.unionAll(more)
    spans = spans.groupBy("key").agg(F.collect_set("span").alias("spans"))
    joined = chosen.select("key", "bytes").join(spans, "key")
    kinds = "key binary, n_removed long, spans array<struct<begin: long, end: long>>, kept_sha256 string"
    return joined.mapInArrow(_removals, kinds)


def cut_repeats(docs: DataFrame, length: int = LENGTH, most: int = GROUP_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256`` of every document.

    Removed is each byte covered by a string of ``length`` bytes that also starts anywhere else in the texts, be it in the same
    one or overlapping; ``spans`` are the maximal removed runs of bytes (beginning, end). NULL and empty texts and texts shorter than
    ``length`` lose nothing; a NULL text counts as empty. Of equal texts each loses everything once it is long enough.
    Repeated and NULL ids keep their rows. Other columns than doc_id and text are not read. An empty table gives an empty table.
    """
    short_batches()
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    texts = docs.select(key_of(data).alias("key"), data.alias("bytes"))
    rows = docs.select("doc_id", key_of(data).alias("key"), F.octet_length(data).cast("long").alias("n_bytes"), F.sha2(data, 256).alias("whole"))
    copies = rows.filter(F.col("n_bytes") >= length).groupBy("key").agg(F.count("*").alias("n"), F.max("n_bytes").alias("size"))
    copies = copies.filter("n > 1").select("key", "size")
    found = repeated_spans(texts, length, most)
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("size").alias("end")))
    facts = found.join(copies, "key", "full").select(
        "key",
        F.coalesce("size", "n_removed").alias("n_removed"),
        F.when(F.col("size").isNotNull(), all_of_it).otherwise(F.col("spans")).alias("spans"),
        F.when(F.col("size").isNotNull(), F.lit(_EMPTY)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
    joined = left_join_splittable(rows, stored(facts, "facts"), "key")
    none = F.expr("CAST(array() AS array<struct<begin: bigint, end: bigint>>)")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )
