"""Near-duplicate embeddings by NN-descent.

1. Equal vectors become one node with a multiplicity. Vectors that are NULL, zero or hold NULL or
   non-finite components are no nodes.
2. A first graph: nodes that share a sign pattern under random hyperplanes are compared, and each keeps
   its ``K`` nearest. There are so many tables of patterns that a pair at the threshold shares one with
   chance ``MEET``, however long the patterns are.
3. Rounds of NN-descent: the neighbours of a node, in both directions, are compared with each other (a
   neighbour of a neighbour is likely a neighbour), and each keeps its K nearest of all met so far. The rounds
   end when at most ``CHANGED`` of the lists' entries are new; only nodes with new neighbours hold meetings.
4. An audit compares ``QUERIES`` nodes with all rows, in blocks, and takes the mean recall per node, apart for
   nodes with few and with many links. Below the wanted recall there are twice as many tables, up to ``ATTEMPTS``;
   if that does not do, all nodes are compared with all, as in 5.
5. Links are the entries at or above the threshold, verified in double precision. A list whose last entry is
   still a link is saturated: it may have more. Its neighbour list is enlarged to its whole component,
   which is compared in blocks, all with all, giving counts instead of pairs. So that components are whole
   where lists are full, the links among the nodes of each meeting are also kept as a spanning forest,
   beside the lists: whoever met and is linked ends in one component.

Lists of neighbours meet in chunks of at most about ``CHUNK``, so no hub or hot pattern is gathered in a task.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from vinlake.llm.common import stored, unit_hash
from vinlake.llm.components import components
from vinlake.operators.joins import left_join_splittable

LINK = 0.95
K = 8
TABLES = 12  # at least
MEET = 0.99
PER_PATTERN = 16  # nodes that a sign pattern has in the mean
CHUNK = 64
BLOCK = 512
CHANGED = 0.01
QUERIES = 1024
RECALL = 0.97
ATTEMPTS = 3
DOUBT = 1e-4  # single precision is trusted up to here
SEED = 11


@F.pandas_udf(BinaryType())
def unit_bytes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The vector at length one as doubles in bytes; NULL if it has no direction."""
    for vectors in batches:
        out = []
        for vector in vectors:
            values = None if vector is None else np.array([np.nan if x is None else x for x in vector], dtype="f8")
            if values is None or not len(values) or not np.isfinite(values).all() or not values.any():
                out.append(None)
            else:
                values = values / np.abs(values).max()
                out.append((values / np.linalg.norm(values)).astype("<f8").tobytes())
        yield pd.Series(out, dtype=object)


def _matrix(vectors: list[bytes], kind: str = "<f8") -> np.ndarray:
    return np.frombuffer(b"".join(vectors), dtype=kind).reshape(len(vectors), -1)


def _forest(links: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges (child, parent) of a spanning forest of the links."""
    children, parents = [], []
    new = links.any(axis=1)
    while new.any():
        waiting = [int(new.argmax())]
        new[waiting[0]] = False
        while waiting:
            parent = waiting.pop()
            found = np.flatnonzero(links[parent] & new).tolist()
            new[found] = False
            waiting += found
            children += found
            parents += [parent] * len(found)
    return children, parents


def _nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each row of ``ids`` and ``vectors`` the K nearest of every member among the others.

    Also, as ``tree``, a spanning forest of the sure links among the members, and all links in doubt.
    """
    for batch in batches:
        nodes, others, sims, trees = [], [], [], []
        for ids, vectors in zip(batch["ids"], batch["vectors"], strict=True):
            if len(ids) < 2:
                continue
            ids, matrix = np.asarray(ids), _matrix(vectors, "<f4")
            cosine = matrix @ matrix.T
            np.fill_diagonal(cosine, -2)
            kept = min(K, len(ids) - 1)
            best = np.argpartition(-cosine, kept - 1, axis=1)[:, :kept]
            nodes.append(np.repeat(ids, kept))
            others.append(ids[best].ravel())
            sims.append(np.take_along_axis(cosine, best, axis=1).ravel())
            trees.append(np.zeros(len(nodes[-1]), dtype=bool))
            if cosine.max() >= LINK - DOUBT:
                children, parents = _forest(cosine >= LINK + DOUBT)
                unsure = np.nonzero(np.triu(np.abs(cosine - LINK) <= DOUBT, 1))
                ends = np.concatenate((children, unsure[0])).astype(int), np.concatenate((parents, unsure[1])).astype(int)
                nodes.append(ids[ends[0]])
                others.append(ids[ends[1]])
                sims.append(cosine[ends])
                trees.append(np.ones(len(ends[0]), dtype=bool))
        if nodes:
            found = {"node": nodes, "other": others, "sim": sims, "tree": trees}
            out = pd.DataFrame({name: np.concatenate(parts) for name, parts in found.items()})
            yield out.drop_duplicates(["node", "other", "tree"])


def _meet(members: DataFrame, *keys: str) -> DataFrame:
    """Candidates among the members (``id``, ``single``) that share the keys."""
    groups = members.groupBy(*keys).agg(F.collect_list("id").alias("ids"), F.collect_list("single").alias("vectors"))
    met = groups.select("ids", "vectors").mapInPandas(_nearest, "node long, other long, sim float, tree boolean")
    return met.withColumn("fresh", F.lit(True))


def _closest(candidates: DataFrame) -> DataFrame:
    """The K nearest of every node, as rows that are ``listed``, and the rows of trees; ``fresh`` if only met now."""
    flags = [F.max("tree").alias("tree"), F.min("fresh").alias("fresh")]
    pairs = candidates.groupBy("node", "other").agg(F.max("sim").alias("sim"), *flags)
    best = F.sort_array(F.collect_list(F.struct("sim", "other", "tree", "fresh")), asc=False)
    ranked = pairs.groupBy("node").agg(best.alias("best")).select("node", F.posexplode("best").alias("rank", "best"))
    ranked = ranked.select("node", "best.*", (F.col("rank") < K).alias("listed"))
    return ranked.filter("listed or tree").select("node", "other", "sim", "tree", "fresh", "listed")


def _known(graph: DataFrame) -> DataFrame:
    return graph.select("node", "other", "sim", "tree", F.lit(False).alias("fresh"))


def _tables(bits: int) -> int:
    """How many tables of patterns a pair at the threshold needs to share one with chance MEET."""
    shared = (1 - np.arccos(LINK) / np.pi) ** bits
    return max(TABLES, int(np.ceil(np.log(1 - MEET) / np.log(1 - shared))))


def _patterns(nodes: DataFrame, width: int, total: int, seed: int, times: int = 1) -> DataFrame:
    """Candidates from sign patterns, ``times`` as many tables as needed, crowded patterns in chunks by chance."""
    bits = min(30, max(1, int(np.log2(max(total / PER_PATTERN, 2)))))
    tables = times * _tables(bits)
    planes = np.random.default_rng(seed).standard_normal((width, tables * bits)).astype("f4")
    shared = nodes.sparkSession.sparkContext.broadcast(planes)

    @F.pandas_udf("array<long>")
    def signs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        powers = 1 << np.arange(bits, dtype=np.int64)
        for vectors in batches:
            found = (_matrix(vectors.tolist(), "<f4") @ shared.value > 0).reshape(len(vectors), tables, bits)
            yield pd.Series(list((found @ powers).astype(np.int64)))

    keyed = nodes.select("id", "single", F.posexplode(signs("single")).alias("table", "pattern"))
    keyed = stored(keyed, "patterns")
    sizes = keyed.groupBy("table", "pattern").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    crowded = sizes.filter(F.col("n") > CHUNK).select(
        F.col("table").alias("_table"), F.col("pattern").alias("_pattern"), F.ceil(F.col("n") / CHUNK).alias("chunks")
    )
    same = (F.col("table") == F.col("_table")) & (F.col("pattern") == F.col("_pattern"))
    chunk = F.pmod(F.xxhash64("id", "table", F.lit(seed)), F.coalesce("chunks", F.lit(1))).alias("chunk")
    chunked = keyed.join(crowded, same, "left").select("id", "single", "table", "pattern", chunk)
    return _meet(chunked, "table", "pattern", "chunk")


def _descend(graph: DataFrame, nodes: DataFrame, seed: int) -> DataFrame:
    """One round: neighbours in both directions meet at every node that has new ones, in chunks dealt by chance."""
    lists = graph.filter("listed")
    ends = lists.select(F.col("node").alias("at"), F.col("other").alias("id"), "fresh")
    back = lists.select(F.col("other").alias("at"), F.col("node").alias("id"), "fresh")
    own = lists.select(F.col("node").alias("at"), F.col("node").alias("id"), F.lit(False).alias("fresh"))
    ends = ends.unionAll(back).unionAll(own).groupBy("at", "id").agg(F.max("fresh").alias("fresh"))
    sizes = ends.groupBy("at").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"), F.max("fresh").alias("_fresh"))
    chunked = left_join_splittable(ends, sizes.filter("_fresh"), "at", "inner")
    chunk = F.pmod(F.xxhash64("id", "at", F.lit(seed)), F.col("chunks")).alias("chunk")
    members = left_join_splittable(chunked.select("at", "id", chunk), nodes.select("id", "single"), "id", "inner")
    return _closest(_known(graph).unionAll(_meet(members, "at", "chunk")))


def _changed(graph: DataFrame) -> float:
    """Share of the lists' entries that are new."""
    return graph.filter("listed").agg(F.avg(F.col("fresh").cast("int"))).first()[0] or 0.0


def _verified(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links ``a, b`` (a < b) of the graph, by cosine in double precision."""
    near = graph.filter(F.col("sim") >= LINK - DOUBT)
    pairs = near.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    left = left_join_splittable(pairs, nodes.select(F.col("id").alias("a"), F.col("unit").alias("_a")), "a", "inner")
    both = left_join_splittable(left, nodes.select(F.col("id").alias("b"), F.col("unit").alias("_b")), "b", "inner")

    @F.pandas_udf("double")
    def cosine(one: pd.Series, other: pd.Series) -> pd.Series:
        if not len(one):
            return pd.Series([], dtype="f8")
        return pd.Series(np.einsum("ij,ij->i", _matrix(one.tolist()), _matrix(other.tolist())))

    return both.filter(cosine("_a", "_b") >= LINK).select("a", "b")


def _count_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of the members of two blocks, counted with multiplicity: ``id, n``; ``other`` is the id again.

    Also, with a count of 0, the links ``id, other`` of a spanning forest.
    """
    for batch in batches:
        for row in batch.itertuples():
            ids, n, block = np.asarray(row.ids), np.asarray(row.copies), np.asarray(row.blocks)
            matrix = _matrix(row.vectors)
            first = block == row.low
            second = block == row.high
            links = matrix[first] @ matrix[second].T >= LINK
            if row.low == row.high:
                np.fill_diagonal(links, False)
                yield pd.DataFrame({"id": ids[first], "other": ids[first], "n": links @ n[second]})
                order, square = ids[first], links
            else:
                yield pd.DataFrame({"id": ids[first], "other": ids[first], "n": links @ n[second]})
                yield pd.DataFrame({"id": ids[second], "other": ids[second], "n": links.T @ n[first]})
                order, half = np.concatenate((ids[first], ids[second])), links.shape[0]
                square = np.zeros((len(order), len(order)), dtype=bool)
                square[:half, half:], square[half:, :half] = links, links.T
            children, parents = _forest(square)
            if children:
                yield pd.DataFrame({"id": order[children], "other": order[parents], "n": 0})


def _blocks(members: DataFrame) -> DataFrame:
    """``id, other, n`` of ``_count_blocks`` for the members (``root, id, unit, copies``), all of a root with all in blocks."""
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).alias("_blocks"))
    dealt = left_join_splittable(members, sizes, "root").withColumn("block", F.pmod(F.xxhash64("id"), F.col("_blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1))
    spread = dealt.withColumn("other", other).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    groups = spread.groupBy("root", "low", "high").agg(
        F.collect_list("id").alias("ids"),
        F.collect_list("copies").alias("copies"),
        F.collect_list("block").alias("blocks"),
        F.collect_list("unit").alias("vectors"),
    )
    groups = groups.select("low", "high", "ids", "copies", "blocks", "vectors")
    return groups.mapInPandas(_count_blocks, "id long, other long, n long")


def _all_with_all(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What ``_count`` gives, by comparing all nodes with all."""
    counted = stored(_blocks(nodes.select(F.lit(0).alias("root"), "id", "unit", "copies")), "all")
    counts = counted.groupBy("id").agg(F.sum("n").alias("n"))
    return stored(counts, "counts"), stored(components(counted.select(F.col("id").alias("a"), F.col("other").alias("b"))), "roots")


def _count(graph: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``id, n`` of all nodes that have links to others, and ``node, root`` of their components."""
    links = stored(_verified(graph, nodes), "links")
    roots = stored(components(links), "roots")
    last = graph.filter("listed").groupBy("node").agg(F.count("*").alias("n"), F.min("sim").alias("last"))
    saturated = last.filter((F.col("n") >= K) & (F.col("last") >= LINK - DOUBT)).select("node")
    dense = stored(roots.join(saturated, "node").select("root").distinct(), "dense")
    marked = left_join_splittable(roots, dense.withColumn("is_dense", F.lit(True)), "root")
    whole = marked.filter("is_dense").select(F.col("node").alias("id"), "root")
    facts = nodes.select("id", "unit", "copies")
    enlarged = _blocks(left_join_splittable(whole, facts, "id", "inner")).groupBy("id").agg(F.sum("n").alias("n"))
    ends = links.select(F.col("a").alias("id"), F.col("b").alias("other")).unionAll(links.select("b", "a"))
    ends = left_join_splittable(ends, whole.select("id"), "id", "left_anti")
    plain = left_join_splittable(ends, nodes.select(F.col("id").alias("other"), "copies"), "other", "inner")
    plain = plain.groupBy("id").agg(F.sum("copies").alias("n"))
    return stored(enlarged.unionAll(plain), "counts"), roots


def audit(counts: DataFrame, nodes: DataFrame, queries: int = QUERIES) -> float:
    """Mean share of its true links that a query node has found, among the nodes with fewer than K linked nodes or
    among the others, whichever is less. At most ``queries`` nodes, drawn by hash, are held against all rows."""
    drawn = nodes.orderBy(unit_hash(F.lit(SEED), "id"), "id").select("id", "unit").limit(queries).collect()
    if not drawn:
        return 1.0
    shared = nodes.sparkSession.sparkContext.broadcast((np.array([r.id for r in drawn]), _matrix([bytes(r.unit) for r in drawn])))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, wanted = shared.value
        sums, linked = np.zeros((2, len(ids)), dtype=np.int64)
        for batch in batches:
            if len(batch):
                links = (wanted @ _matrix(batch["unit"].tolist()).T >= LINK) & (ids[:, None] != batch["id"].to_numpy())
                sums += links @ batch["copies"].to_numpy()
                linked += links.sum(axis=1)
        yield pd.DataFrame({"id": ids, "true": sums, "linked": linked})

    true = nodes.select("id", "unit", "copies").mapInPandas(compare, "id long, true long, linked long")
    true = true.groupBy("id").agg(F.sum("true").alias("true"), F.sum("linked").alias("linked")).filter(F.col("true") > 0)
    share = F.least(F.col("true"), F.coalesce("n", F.lit(0))) / F.col("true")
    means = true.join(counts, "id", "left").groupBy(F.col("linked") < K).agg(F.avg(share).alias("recall")).collect()
    return min((row.recall for row in means), default=1.0)


def _facts(rows: DataFrame, width: int) -> DataFrame:
    """``id, least, copies, n`` of the vectors of ``width`` components that have copies or links."""
    grouped = rows.groupBy("unit").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    single = F.pandas_udf(lambda units: units.map(lambda x: np.frombuffer(x, "<f8").astype("<f4").tobytes()), BinaryType())
    # A node is numbered by its vector, not by an id that may be NULL or repeat.
    nodes = stored(grouped.withColumns({"id": F.xxhash64("unit"), "single": single("unit")}), "nodes")
    total = nodes.count()

    graph = None
    for attempt in range(ATTEMPTS):
        found = _patterns(nodes, width, total, SEED + attempt, 1 << attempt)
        graph, number = stored(_closest(found if graph is None else _known(graph).unionAll(found)), "graph"), 0
        while _changed(graph) > CHANGED:
            graph, number = stored(_descend(graph, nodes, SEED + number), "graph"), number + 1
        counts, roots = _count(graph, nodes)
        if audit(counts, nodes) >= RECALL:
            break
    else:
        counts, roots = _all_with_all(nodes)

    first = nodes.select(F.col("id").alias("node"), "first")
    with_first = roots.join(first, "node")
    least = with_first.groupBy("root").agg(F.min("first").alias("least"))
    facts = left_join_splittable(roots, least, "root").select(F.col("node").alias("_node"), "least")
    facts = nodes.select("id", "first", "copies").join(facts, F.col("id") == F.col("_node"), "left").drop("_node")
    facts = facts.join(counts.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left").drop("_id")
    facts = facts.filter((F.col("copies") > 1) | F.col("least").isNotNull())
    return stored(facts.select("id", F.coalesce("least", "first").alias("least"), "copies", "n"), "facts")


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``embeddings`` (vec_id, embedding).

    Rows without a direction link with nothing. Vectors of different lengths have no cosine and are never linked; each
    length that occurs is searched by itself. Equal vectors link
    with each other. Rows with a NULL id take part; among copies the smallest known id stands for them.
    Repeated rows count as copies. Other columns are not read. An empty table gives an empty result.
    """
    unit = unit_bytes("embedding")
    rows = stored(embeddings.select("vec_id", unit.alias("unit")).withColumn("size", F.length("unit")), "vectors")
    sizes = sorted(row["size"] for row in rows.filter(F.col("size").isNotNull()).select("size").distinct().collect())
    if not sizes:
        return rows.select("vec_id", *_alone())
    found = [_facts(rows.filter(F.col("size") == size), size // 8).withColumn("size", F.lit(size)) for size in sizes]
    key = F.struct("size", "id")
    facts = reduce(DataFrame.unionAll, found).select(key.alias("key"), "least", "copies", "n")
    keyed = rows.withColumn("id", F.xxhash64("unit")).select("vec_id", F.when(F.col("size").isNotNull(), key).alias("key"))
    joined = left_join_splittable(keyed, facts, "key")
    links = F.coalesce("n", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1
    component = F.coalesce("least", "vec_id")
    return joined.select("vec_id", *_alone(links, component))


def _alone(links: Column | None = None, component: Column | None = None) -> list[Column]:
    links = F.lit(0) if links is None else links
    component = F.col("vec_id") if component is None else component
    kept = F.coalesce(F.col("vec_id") == component, F.lit(False))
    return [links.cast("bigint").alias("n_links"), component.alias("component_id"), kept.alias("kept")]
