"""Near-duplicate vectors by NN-descent on a neighbour graph.

1. Equal vectors form a class; one of them stands for it, so copies cost nothing.
2. First lists: random hyperplanes deal the vectors into buckets, large buckets are
   split at random, and every vector takes its best ``k`` from its cells.
3. Rounds: every vector gathers its list and the vectors that list it (the best ``k``
   of them), and tells each of them about the others that improve on the worst of
   its list. Rounds end when few lists change.
4. Edges with cosine >= ``threshold`` give components. A list is saturated when all
   its entries reach the threshold: it then says nothing about the rest. Vectors with
   such lists get a list of vectors of other components, by the same rounds, until
   no list is saturated or no component finds another. Lists are then
   enlarged to the whole component: its members are compared in double
   precision, block against block, which gives every link between vectors of one
   component. Only counts leave the blocks, no pairs.
5. An audit compares samples of vectors, by number of links and without any, with
   all others by brute force. While less than ``recall`` of the links were found,
   everything is repeated with lists of twice the size and twice the tables, up to
   ``attempts`` times; what is still short then is an error.

A vector needs more than one row per neighbour nowhere but in step 4, whose work is
the number of pairs within components.

Results of ``link_vectors`` (one row per row of the input):

* null or zero vectors, and vectors with null or non-finite components, link with nothing and are their own component;
* vectors of different lengths link with nothing of another length;
* repeated rows count as vectors of their own; a row without an id links like any other, but never names a component
  (a component without any id is null);
* an empty table gives an empty table; of the input only the two named columns are read.
"""

from __future__ import annotations

import hashlib
import logging

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netvigil.llm.common import batches_of, column_of, kept, read_table
from netvigil.llm.components import components

THRESHOLD = 0.95
NEIGHBOURS, TABLES = 6, 12
SETTLED = 0.01
CELL, BLOCK = 96, 256
AUDITED, RECALL, ATTEMPTS = 200, 0.97, 3
SEED = 20_011
MARGIN = 1e-4  # of single precision, which is used on the way
POINTS = "vec_id long, dim int, digest binary, vector binary"
EDGES = "u long, w long, cosine double"

log = logging.getLogger(__name__)


def normalised(values) -> np.ndarray | None:
    """The vector scaled to length 1, or None if it links with nothing."""
    if not values or any(v is None for v in values):
        return None
    vector = np.array(values, np.float64) + 0.0
    if not np.isfinite(vector).all():
        return None
    vector = vector / (np.abs(vector).max() or 1)  # neither overflow nor underflow below
    length = np.sqrt(vector @ vector)
    return vector / length if length else None


def prepared(rows: DataFrame) -> DataFrame:
    """Vectors scaled to length 1 as bytes, and a digest by which equal ones are found."""

    def run(batches):
        for batch in batches:
            found = []
            for vec_id, values in zip(*(c.to_pylist() for c in batch.columns)):
                vector = normalised(values)
                raw = None if vector is None else vector.tobytes()
                found.append((vec_id, None, None, None) if raw is None else
                             (vec_id, len(vector), hashlib.blake2b(np.array(values, np.float64).tobytes(), digest_size=16).digest(), raw))
            yield from batches_of([found], POINTS)

    return rows.mapInArrow(run, POINTS)


def cells_of(rows: DataFrame, keys: list[str], schema: str, work) -> DataFrame:
    """``work(columns)`` for the rows of every cell; cells have bounded sizes and come one by one, in order."""

    def run(batches):
        held = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            if not len(columns[0]):
                continue
            new = np.zeros(len(columns[0]) - 1, bool)
            for column in columns[:len(keys)]:
                new |= column[1:] != column[:-1]
            starts = np.flatnonzero(np.concatenate([[True], new]))
            for start, end in zip(starts[:-1], starts[1:]):
                yield from batches_of([work([c[start:end] for c in columns[len(keys):]])], schema)
            held = [c[starts[-1]:] for c in columns]
        if held is not None:
            yield from batches_of([work(held[len(keys):])], schema)

    others = [c for c in rows.columns if c not in keys]
    return rows.select(*keys, *others).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def stacked(raw, kind) -> np.ndarray:
    return np.array([np.frombuffer(v, kind) for v in raw])


def best_of_cell(k: int):
    """Every member's best ``k`` of its cell, in other groups than its own, that improve on its ``worst`` entry."""

    def work(columns):
        ids, raw, own, worst = columns
        ids, first = np.unique(ids, return_index=True)
        if len(ids) < 2:
            return
        vectors = stacked(raw[first], np.float32)
        cosines = vectors @ vectors.T
        own = own[first]
        cosines[own[:, None] == own[None, :]] = -3
        most = min(k, len(ids) - 1)
        best = np.argpartition(-cosines, most - 1, axis=1)[:, :most]
        found = np.take_along_axis(cosines, best, 1)
        rows, places = np.nonzero(found > worst[first][:, None] + 1e-7)
        yield from zip(ids[rows].tolist(), ids[best[rows, places]].tolist(), found[rows, places].astype(float).tolist())

    return work


def best_lists(edges: DataFrame, k: int) -> DataFrame:
    ranked = edges.groupBy("u", "w").agg(F.max("cosine").alias("cosine")).withColumn(
        "place", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("cosine"), "w")))
    return ranked.where(F.col("place") <= k)


def first_lists(points: DataFrame, count: int, k: int, tables: int, cell: int) -> DataFrame:
    """Edges within the cells of ``tables`` random hyperplane tables."""
    bits = max(0, int(np.ceil(np.log2(max(1, count) / cell * 2))))
    schema = "tab int, dim int, bucket long, id long, v32 binary, own long"

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = []
            for vec_id, dim, raw, own in zip(*(c.to_pylist() for c in batch.columns)):
                if dim not in planes:
                    planes[dim] = np.random.default_rng(SEED).standard_normal((tables * bits, dim))
                vector = np.frombuffer(raw)
                signs = (planes[dim] @ vector > 0).reshape(tables, bits)
                buckets = signs @ (1 << np.arange(bits, dtype=np.int64))
                short = vector.astype(np.float32).tobytes()
                rows += [(t, dim, b, vec_id, short, own) for t, b in enumerate(buckets.tolist())]
            yield from batches_of([rows], schema)

    dealt = kept(points.select("id", "dim", "vector", "own").mapInArrow(run, schema))
    sizes = dealt.groupBy("tab", "dim", "bucket").agg(F.count("*").alias("members"))
    parts = F.ceil(F.col("members") / cell)
    split = dealt.join(sizes, ["tab", "dim", "bucket"]).withColumn("part", F.pmod(F.xxhash64("id", "tab"), parts)).drop("members")
    rows = split.select("tab", "dim", "bucket", "part", "id", "v32", "own", F.lit(-2.0).alias("worst"))
    return cells_of(rows, ["tab", "dim", "bucket", "part"], EDGES, best_of_cell(k))


def descend(points: DataFrame, count: int, k: int, tables: int, cell: int = CELL, around: DataFrame | None = None) -> DataFrame:
    """The neighbour graph (u, w, cosine) after NN-descent, without edges inside a group (column ``own`` of ``points``).

    Edges of ``around``, at most a list per vector, lead on to neighbours in the same group.
    """
    short = kept(points.select("id", "vector").mapInArrow(_shortened, "id long, v32 binary").join(points.select("id", "own"), "id"))
    graph = kept(best_lists(first_lists(points, count, k, tables, cell), k))
    while True:
        back = graph.select(F.col("w").alias("pivot"), F.col("u").alias("id"), "cosine").withColumn(
            "place", F.row_number().over(Window.partitionBy("pivot").orderBy(F.desc("cosine"), "id")))
        members = graph.select(F.col("u").alias("pivot"), F.col("w").alias("id")).unionAll(
            back.where(F.col("place") <= k).select("pivot", "id")).unionAll(
            graph.select(F.col("u").alias("pivot"), F.col("u").alias("id")))
        if around is not None:
            members = members.unionAll(around.select(F.col("u").alias("pivot"), F.col("w").alias("id")))
        members = members.distinct()
        worst = graph.groupBy(F.col("u").alias("id")).agg(
            F.when(F.count("*") >= k, F.min("cosine")).otherwise(F.lit(-2.0)).alias("worst"))
        told = short.join(worst, "id", "left").withColumn("worst", F.coalesce("worst", F.lit(-2.0)))
        better = cells_of(members.join(told, "id").select("pivot", "id", "v32", "own", "worst"), ["pivot"], EDGES, best_of_cell(k))
        before = graph
        graph = kept(best_lists(before.select("u", "w", "cosine").unionAll(better), k))
        changed = graph.join(before, ["u", "w"], "left_anti").count()
        if changed <= SETTLED * k * count:
            return graph


def saturated(graph: DataFrame, k: int, threshold: float) -> DataFrame:
    """(id) of the vectors whose lists are full of entries that reach the threshold."""
    return graph.where(F.col("cosine") >= threshold - MARGIN).groupBy(F.col("u").alias("id")).agg(
        F.count("*").alias("entries")).where(F.col("entries") >= k).select("id")


def linked_groups(points: DataFrame, count: int, k: int, tables: int, threshold: float) -> DataFrame:
    """(vertex, component) of the vectors with near others, with components that full lists hide from each other joined."""
    graph = descend(points.withColumn("own", F.col("id")), count, k, tables)
    reach = F.col("cosine") >= threshold - MARGIN
    near = graph.where(reach).select(F.col("u").alias("a"), F.col("w").alias("b"))
    grouped, full = kept(components(near)), saturated(graph, k, threshold)
    while True:
        # A link between components is in neither end's list only if both lists are full.
        hidden = kept(points.join(full, "id").join(grouped.withColumnRenamed("vertex", "id"), "id").withColumnRenamed("component", "own"))
        size, groups = hidden.agg(F.count("*"), F.countDistinct("own")).first()
        if groups < 2:
            return grouped
        around = graph.join(hidden.select(F.col("id").alias("u")), "u", "left_semi").join(
            hidden.select(F.col("id").alias("w")), "w", "left_semi")
        others = descend(hidden, size, k, tables, around=kept(around))
        found = kept(others.where(reach).select(F.col("u").alias("a"), F.col("w").alias("b")))
        if found.isEmpty():
            return grouped
        full = kept(saturated(others, k, threshold))
        near = grouped.select(F.col("vertex").alias("a"), F.col("component").alias("b")).where("a <> b").unionAll(found)
        grouped = kept(components(near))


def _shortened(batches):
    for batch in batches:
        rows = [(i, np.frombuffer(v).astype(np.float32).tobytes()) for i, v in zip(*(c.to_pylist() for c in batch.columns))]
        yield from batches_of([rows], "id long, v32 binary")


def local_components(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix the smallest row of its component."""
    labels = np.arange(len(linked))
    while True:
        near = np.where(linked, labels[None, :], len(linked)).min(1, initial=len(linked))
        lower = np.minimum(labels, near)
        if (lower == labels).all():
            return labels
        labels = lower


def links_within(points: DataFrame, grouped: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(id, n_links, near): links of every vector with all others of its component, block against block.

    One row per vector and pair of blocks in which it has links. ``near`` is the
    smallest id of its component there, so that these pairs have the components
    of all links.
    """
    schema = "id long, n_links long, near long"

    def work(columns):
        order = np.argsort(columns[0], kind="stable")
        ids, sizes, sides, raw = (c[order] for c in columns)
        vectors = stacked(raw, np.float64)
        linked = vectors @ vectors.T >= threshold
        np.fill_diagonal(linked, False)
        if (sides != 0).any():  # two blocks: links inside one of them belong to another cell
            linked &= sides[:, None] != sides[None, :]
        names = ids[local_components(linked)]
        counts = linked @ sizes
        own = np.flatnonzero(counts)
        yield from zip(ids[own].tolist(), counts[own].tolist(), names[own].tolist())

    sized = grouped.groupBy("component").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / block).cast("int")
    placed = grouped.join(sized, "component").join(points, grouped["vertex"] == points["id"]).select(
        "component", "id", "size", "vector", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    cells = placed.select("component", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "id",
                          "size", F.signum(F.col("own") - F.col("other")).cast("int").alias("side"), "vector")
    return cells_of(cells, ["component", "low", "high"], schema, work)


def audit(points: DataFrame, found: DataFrame, threshold: float, sample: int = AUDITED) -> list[tuple[int, int, int, int]]:
    """(vectors, sampled, links found, links there) of at most ``sample`` vectors against all, per power of two of links found."""
    counted = kept(points.join(found.select("id", "n_links"), "id", "left").select(
        "id", "dim", "vector", F.coalesce("n_links", F.lit(0)).alias("n_links")).withColumn(
        "stratum", F.ceil(F.log2(F.col("n_links") + 1)).cast("int")))
    strata = {r["stratum"]: r["count"] for r in counted.groupBy("stratum").count().collect()}  # at most 64
    chosen = [r for stratum in strata for r in counted.where(F.col("stratum") == stratum).orderBy(
        F.xxhash64("id", F.lit(SEED)), "id").limit(sample).collect()]
    queries: dict[int, tuple] = {}
    for dim in {r["dim"] for r in chosen}:
        own = [r for r in chosen if r["dim"] == dim]
        queries[dim] = np.array([r["id"] for r in own]), np.array([np.frombuffer(bytes(r["vector"])) for r in own])
    schema = "id long, there long"

    def run(batches):
        for batch in batches:
            ids, dims, sizes, raw = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            rows = []
            for dim, (names, vectors) in queries.items():
                own = np.flatnonzero(dims == dim)
                if len(own):
                    linked = (vectors @ stacked(raw[own], np.float64).T >= threshold) & (names[:, None] != ids[own][None, :])
                    rows += zip(names.tolist(), (linked @ sizes[own]).tolist())
            yield from batches_of([rows], schema)

    there = {r["id"]: r["there"] for r in points.select("id", "dim", "size", "vector").mapInArrow(run, schema).groupBy("id").agg(
        F.sum("there").alias("there")).collect()}  # one row per sampled vector
    result = []
    for stratum, vectors in strata.items():
        own = [r for r in chosen if r["stratum"] == stratum]
        result.append((vectors, len(own), sum(min(r["n_links"], there[r["id"]]) for r in own), sum(there[r["id"]] for r in own)))
    return result


def is_short(audited: list[tuple[int, int, int, int]], recall: float) -> bool:
    """Whether less than ``recall`` of the links were found: of all, as projected, or in a stratum with enough links to tell."""
    got = sum(vectors / sampled * found for vectors, sampled, found, _ in audited)
    of = sum(vectors / sampled * there for vectors, sampled, _, there in audited)
    return got < recall * of or any(0 < found < recall * there and there * (1 - recall) >= 1 for _, _, found, there in audited)


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS, tables: int = TABLES,
                 recall: float = RECALL, attempts: int = ATTEMPTS, id_column: str = "vec_id",
                 vector_column: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = kept(prepared(vectors.select(column_of(vectors, id_column, "long").alias("vec_id"),
                                        column_of(vectors, vector_column, "array<double>").alias("embedding"))))
    # Classes get numbers of their own, because ids may repeat or be null.
    classes = rows.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("size"), F.first("dim").alias("dim"), F.first("vector").alias("vector"))
    points = kept(classes.withColumn("id", F.monotonically_increasing_id()))
    count = points.count()

    for attempt in range(attempts):
        k, t = neighbours << attempt, tables << attempt
        links = kept(links_within(points, linked_groups(points, count, k, t, threshold), threshold))
        found = links.groupBy("id").agg(F.sum("n_links").alias("n_links"))
        audited = audit(points, found, threshold)
        log.info("attempt %s: (vectors, sampled, links found, links there) %s", attempt + 1, audited)
        if not is_short(audited, recall):
            break
    else:
        raise RuntimeError(f"less than {recall} of the links found after {attempts} attempts: {audited}")

    grouped = components(links.select(F.col("id").alias("a"), F.col("near").alias("b")))
    named = points.select("digest", "id", "rep", "size").join(grouped.withColumnRenamed("vertex", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "component").join(found.select("id", "n_links"), "id", "left").select(
        "digest", (F.coalesce("n_links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id")
    return rows.join(named, "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(read_table(spark, sf_dir, "embeddings"))
