"""Approximate nearest neighbours: NN-descent graph, greedy graph search.

Nearness is the largest inner product. For the graph every vector gets one coordinate
more, the root of what its squared length lacks to the greatest one (queries get zero
there), so that near means the same between any two vectors and no long vector becomes
everybody's neighbour. Equal vectors are one node; a node remembers its ``k + 1``
smallest ids, which is all that a list of k can show of it.

*Graph.* First lists come from ``TREES`` random partitions by hyperplanes between sampled
points; cells above ``LEAF`` nodes are split at random, so a cell of near copies fills
many tasks. Then NN-descent: every node meets its neighbours and up to ``BACK`` of the
nodes that name it (its hubs' other edges stand in those nodes' own lists); pairs among
them that no earlier round compared are scored, better ones enter the lists. Each round
is joins and grouped minima over edges; rounds end when fewer than ``SETTLED`` of the list
places changed. A list has ``DEGREE`` places.

*Search.* A beam of the ``BEAM`` best nodes per query starts at the query's own node, where
it is one, and at the best of the sampled points. A round expands up to ``STEP`` nodes of
each beam through one join with the graph, whose rows carry the neighbours' coordinates at
half precision and which is bucketed by node, so only the beams' slim rows travel. Only
candidates above a beam's worst are returned, so nothing need remember what was seen; a
query is done when all of its beam is expanded. The best ``FINAL`` nodes are scored anew
in double precision on the original vectors.

The sampled points (at most ``SAMPLE``) only place hyperplanes and entries; every vector is
in the graph. Recall is measured against brute force in the tests.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
take no part, nor do vectors that have not the commonest length (of equally common ones the
longest), nor rows with a null id; rows equal in id and vector count once; a query finds no
row of its own id; several vectors of one id are candidates each, and as queries each get a
list; with fewer than k candidates all found are returned; ties go to the smaller id. An
empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmfold.llm.common import pick, written
from firmfold.session import scratch_dir

NEAREST = 20
DEGREE = 24
BACK = 16
TREES = 6
LEAF = 2048
SETTLED = 0.1
ROUNDS = 12
BEAM = 256
STEP = 64
FINAL = 64
SAMPLE = 512
ENTRIES = 4
STRIP = 256
SEED = 20240311


@dataclass(frozen=True)
class Index:
    nodes: DataFrame      # node, vector (double), ids: the smallest ones
    graph: DataFrame      # node, neighbours, codes; bucketed by node
    points: list          # (node, code) of the sampled points
    greatest: float       # greatest length of a vector
    keep: int             # ids kept per node


def _usable(rows: DataFrame) -> DataFrame:
    entry = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.withColumn("vector", F.col("vector").cast("array<double>")).filter(F.col("id").isNotNull() & F.coalesce(
        F.forall("vector", entry) & F.exists("vector", lambda x: x != 0), F.lit(False)))


def _node(vector: Column) -> Column:
    return F.xxhash64(F.transform(vector, lambda x: x + F.lit(0.0)))  # -0.0 is 0.0


def _matrix(codes: pa.Array, width: int) -> np.ndarray:
    """Half-precision rows of a binary array, widened."""
    raw = b"".join(codes.to_pylist())
    return np.frombuffer(raw, dtype=np.float16).reshape(-1, width).astype(np.float32)


def _coded(vectors: np.ndarray, greatest: float, lift: bool) -> np.ndarray:
    scaled = vectors / greatest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1))) if lift else np.zeros(len(scaled))
    return np.column_stack([scaled, rest]).astype(np.float16)


def _with_codes(rows: DataFrame, greatest: float, lift: bool) -> DataFrame:
    """The rows with ``code`` in place of ``vector``."""
    kept = [c for c in rows.columns if c != "vector"]
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept) + ", code binary"

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                codes = _coded(np.stack(batch["vector"].to_numpy()), greatest, lift)
                yield batch[kept].assign(code=[c.tobytes() for c in codes])

    return rows.mapInPandas(encode, schema)


def _lists(edges: DataFrame, degree: int) -> DataFrame:
    """Of edges (node, other, score, new), each once, the best per node; what was known stays known."""
    once = edges.groupBy("node", "other").agg(F.max("score").alias("score"), F.min("new").alias("new"))
    best = Window.partitionBy("node").orderBy(F.desc("score"), "other")
    return once.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= degree).drop("rank")


def _planes(points: list, bits: int, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per tree, normals and offsets of hyperplanes half-way between two sampled points."""
    draw = np.random.default_rng(SEED)
    codes = np.frombuffer(b"".join(c for _, c in points), dtype=np.float16).reshape(-1, width).astype(np.float32)
    out = []
    for _ in range(TREES):
        ends = np.array([draw.choice(len(codes), 2, replace=False) for _ in range(bits)], dtype=int).reshape(-1, 2)
        one, two = codes[ends[:, 0]], codes[ends[:, 1]]
        out.append(((one - two).T, ((one * one).sum(axis=1) - (two * two).sum(axis=1)) / 2))
    return out


def _first_edges(codes: DataFrame, points: list, count: int, width: int, degree: int) -> DataFrame:
    bits = max(0, int(np.ceil(np.log2(max(1, count / LEAF)))))
    trees = _planes(points, bits if len(points) > 1 else 0, width) if bits else [(np.zeros((width, 0)), np.zeros(0))]

    def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(batch.column(1), width)
            for tree, (normals, offsets) in enumerate(trees):
                side = matrix @ normals > offsets
                cell = side @ (1 << np.arange(side.shape[1], dtype=np.int64)) if side.shape[1] else np.zeros(len(matrix), np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.full(len(cell), tree, np.int32)),
                                                  pa.array(cell.astype(np.int64))], ["node", "code", "tree", "cell"])

    placed = codes.mapInArrow(cells, "node bigint, code binary, tree int, cell bigint")
    held = placed.groupBy("tree", "cell").agg(F.count(F.lit(1)).alias("held"))
    chunk = F.pmod(F.xxhash64("node", "tree"), F.ceil(F.col("held") / LEAF))
    dealt = placed.join(held, ["tree", "cell"]).withColumn("chunk", chunk)

    def leaf(rows: pd.DataFrame) -> pd.DataFrame:
        nodes = rows["node"].to_numpy()
        matrix = np.frombuffer(b"".join(rows["code"]), dtype=np.float16).reshape(-1, width).astype(np.float32)
        most, out = min(degree, len(nodes) - 1), []
        for start in range(0, len(nodes), STRIP):
            score = matrix[start:start + STRIP] @ matrix.T
            own = np.arange(len(score))
            score[own, start + own] = -np.inf
            best = np.argpartition(-score, most - 1, axis=1)[:, :most] if most else np.zeros((len(score), 0), int)
            out.append(pd.DataFrame({"node": np.repeat(nodes[start + own], most), "other": nodes[best].ravel(),
                                     "score": np.take_along_axis(score, best, axis=1).ravel()}))
        return pd.concat(out)

    edges = dealt.groupBy("tree", "cell", "chunk").applyInPandas(leaf, "node bigint, other bigint, score float")
    return edges.withColumn("new", F.lit(True))


def _met(lists: DataFrame, codes: DataFrame, width: int, degree: int) -> DataFrame:
    """One round: pairs of each node's neighbourhood that no round has compared, where they improve a list."""
    worst = lists.groupBy("node").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n")).select(
        F.col("node").alias("other"), F.when(F.col("n") >= degree, F.col("score")).otherwise(-1e30).cast("float").alias("worst"))
    order = Window.partitionBy("node").orderBy(F.desc("new"), F.xxhash64("node", "other"))
    back = lists.select(F.col("other").alias("node"), F.col("node").alias("other"), "new").withColumn(
        "rank", F.row_number().over(order)).filter(F.col("rank") <= BACK).drop("rank")
    around = lists.select("node", "other", "new").unionByName(back).groupBy("node", "other").agg(F.min("new").alias("new"))
    about = codes.withColumnRenamed("node", "other").join(worst, "other", "left")
    gathered = around.join(about, "other").groupBy("node").agg(F.collect_list(
        F.struct("other", "new", F.coalesce("worst", F.lit(-1e30).cast("float")).alias("worst"), "code")).alias("near"),
        F.max("new").alias("new")).filter("new").select("near")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = batch.column(0)
            ends = near.offsets.to_numpy()
            others, new, worsts, coded = near.flatten().flatten()
            others, new, worsts = (c.to_numpy(zero_copy_only=False) for c in (others, new, worsts))
            matrix, out = _matrix(coded, width), []
            ends = ends - ends[0]
            for a, b in zip(ends, ends[1:]):
                score = matrix[a:b] @ matrix[a:b].T
                better = (score > worsts[a:b, None]) & (new[a:b, None] | new[None, a:b])
                better[np.arange(b - a), np.arange(b - a)] = False
                one, two = np.nonzero(better)
                out.append((others[a + one], others[a + two], score[one, two]))
            if out:
                node, other, score = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(other), pa.array(score.astype(np.float32))],
                                                 ["node", "other", "score"])

    return gathered.mapInArrow(compare, "node bigint, other bigint, score float").withColumn("new", F.lit(True))


def _bucketed(frame: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder in buckets of ``node``, read as a table of the session."""
    spark = frame.sparkSession
    buckets, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{label}_{uuid.uuid4().hex}"
    (frame.repartition(buckets, "node").write.bucketBy(buckets, "node").sortBy("node")
     .option("path", scratch_dir(spark, label)).saveAsTable(name))
    return spark.table(name)


def build(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST) -> Index:
    """The graph over all usable vectors."""
    rows = _usable(pick(vectors, id=id_col, vector=vector_col))
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))).alias("greatest"))
    first = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    length, greatest = (first["length"], first["greatest"]) if first else (0, 1.0)
    rows = rows.filter(F.size("vector") == length).withColumn("node", _node(F.col("vector")))
    width, degree = length + 1, max(DEGREE, k + 4)

    each = rows.groupBy("node", "id").agg(F.first("vector").alias("vector"))
    smallest = Window.partitionBy("node").orderBy("id")
    some = each.withColumn("rank", F.row_number().over(smallest)).filter(F.col("rank") <= k + 1)
    nodes = written(some.groupBy("node").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("id")).alias("ids")), "nodes")
    codes = written(_with_codes(nodes.select("node", "vector"), greatest, lift=True), "codes")
    count = codes.count()
    points = [(r["node"], bytes(r["code"])) for r in codes.orderBy(F.xxhash64("node", F.lit(SEED))).limit(SAMPLE).collect()]

    lists = written(_lists(_first_edges(codes, points, count, width, degree), degree), "lists")
    for _ in range(ROUNDS):
        known = lists.withColumn("new", F.lit(False))
        lists = written(_lists(known.unionByName(_met(lists, codes, width, degree)), degree), "lists")
        if lists.filter("new").count() <= SETTLED * degree * count:
            break
    ranked = Window.partitionBy("node").orderBy(F.xxhash64("node", "other"))
    back = lists.select(F.col("other").alias("node"), F.col("node").alias("other")).withColumn(
        "rank", F.row_number().over(ranked)).filter(F.col("rank") <= BACK).drop("rank")
    edges = lists.select("node", "other").unionByName(back).distinct()
    graph = edges.join(codes.withColumnRenamed("node", "other"), "other").groupBy("node").agg(
        F.collect_list(F.struct("other", "code")).alias("near"))
    graph = graph.select("node", F.col("near.other").alias("neighbours"), F.col("near.code").alias("codes"))
    return Index(nodes, _bucketed(graph, "graph"), points, greatest, k + 1)


BEAM_SCHEMA = "query bigint, code binary, nodes array<bigint>, scores array<float>, next array<bigint>, open array<bigint>"


def _entered(queries: DataFrame, index: Index, width: int) -> DataFrame:
    """First beams: the best sampled points, and the query's own node."""
    names = np.array([n for n, _ in index.points], dtype=np.int64)
    matrix = np.frombuffer(b"".join(c for _, c in index.points), dtype=np.float16).reshape(-1, width).astype(np.float32)

    def enter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            asked = np.frombuffer(b"".join(batch["code"]), dtype=np.float16).reshape(-1, width).astype(np.float32)
            score = asked @ matrix.T
            best = np.argsort(-score, axis=1, kind="stable")[:, :ENTRIES]
            own = batch["query"].to_numpy()
            starts = [np.concatenate([[q], names[b][names[b] != q]]) for q, b in zip(own, best)]
            # The own node stands for an entry only: its neighbours' scores count, its own comes with them.
            yield pd.DataFrame({"query": own, "code": batch["code"].to_numpy(),
                                "nodes": [np.zeros(0, np.int64)] * len(own), "scores": [np.zeros(0, np.float32)] * len(own),
                                "next": starts, "open": [np.zeros(0, np.int64)] * len(own)})

    return queries.mapInPandas(enter, BEAM_SCHEMA)


def _stepped(beams: DataFrame, graph: DataFrame, width: int) -> DataFrame:
    """Every beam after one expansion of its next nodes."""
    least = F.when(F.size("scores") >= BEAM, F.array_min("scores")).otherwise(-1e30).cast("float").alias("least")
    asked = beams.filter(F.size("next") > 0).select("query", "code", least, F.explode("next").alias("node"))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            query, code, least, near, codes = (batch.column(k) for k in range(5))
            ends = near.offsets.to_numpy() - near.offsets.to_numpy()[0]
            matrix, asked = _matrix(codes.flatten(), width), _matrix(code, width)
            row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            found = np.einsum("ij,ij->i", matrix, asked[row])
            good = found > least.to_numpy()[row]
            row, other, found = row[good], near.flatten().to_numpy()[good], found[good]
            place = np.searchsorted(row, np.arange(len(ends))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [query, pa.ListArray.from_arrays(place, pa.array(other)), pa.ListArray.from_arrays(place, pa.array(found))],
                ["query", "others", "found"])

    met = asked.join(graph, "node").select("query", "code", "least", "neighbours", "codes")
    found = met.mapInArrow(score, "query bigint, others array<bigint>, found array<float>").groupBy("query").agg(
        F.flatten(F.collect_list("others")).alias("others"), F.flatten(F.collect_list("found")).alias("found"))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = {c: [] for c in ("nodes", "scores", "next", "open")}
            for nodes, scores, turned, still, others, found in zip(
                    *(batch[c] for c in ("nodes", "scores", "next", "open", "others", "found"))):
                if others is None or turned is None or len(turned) == 0:
                    others, found = np.zeros(0, np.int64), np.zeros(0, np.float32)
                others, first = np.unique(others, return_index=True)
                fresh = ~np.isin(others, nodes)
                others, found = others[fresh], np.asarray(found)[first][fresh]
                nodes, scores = np.concatenate([nodes, others]), np.concatenate([scores, found])
                best = np.argsort(-scores, kind="stable")[:BEAM]
                nodes, scores = nodes[best].astype(np.int64), scores[best].astype(np.float32)
                # Entries were expanded without standing in the beam; once they are met they need no other turn.
                waiting = np.isin(nodes, np.concatenate([still, others[~np.isin(others, turned)]])) & ~np.isin(nodes, turned)
                out["nodes"].append(nodes)
                out["scores"].append(scores)
                out["next"].append(nodes[waiting][:STEP])
                out["open"].append(nodes[waiting][STEP:])
            yield batch[["query", "code"]].assign(**out)

    return beams.join(found, "query", "left").mapInPandas(merge, BEAM_SCHEMA)


def search(index: Index, queries: DataFrame, k: int = NEAREST, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, ``id_col``, score): each query's nearest, nearest first."""
    if k + 1 > index.keep:
        raise ValueError(f"the index keeps {index.keep} ids of a node: build it for k = {k}")
    kind = queries.schema[id_col].dataType.simpleString()
    schema = f"query_id {kind}, rank int, `{id_col}` {kind}, score double"
    if not index.points:
        return queries.sparkSession.createDataFrame([], schema)
    width = len(index.points[0][1]) // 2
    rows = _usable(pick(queries, id=id_col, vector=vector_col)).filter(F.size("vector") == width - 1)
    rows = rows.select("id", _node(F.col("vector")).alias("query"), "vector")
    asked = rows.select("query", "id").distinct()
    vectors = written(rows.groupBy("query").agg(F.first("vector").alias("vector")), "queries")
    beams = written(_entered(_with_codes(vectors, index.greatest, lift=False), index, width), "beams")
    while not beams.filter(F.size("next") > 0).isEmpty():
        beams = written(_stepped(beams, index.graph, width), "beams")

    best = beams.select("query", F.explode(F.slice("nodes", 1, max(FINAL, 2 * k))).alias("node"))
    product = F.aggregate(F.zip_with("vector", "asked", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    scored = best.join(index.nodes, "node").join(vectors.withColumnRenamed("vector", "asked"), "query").select(
        "query", product.alias("score"), F.explode("ids").alias("found"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "found")
    top = scored.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    listed = top.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "found", "score"))).alias("found"))
    others = asked.join(listed, "query").select("id", F.slice(F.filter("found", lambda x: x["found"] != F.col("id")), 1, k).alias("found"))
    return others.select(F.col("id").alias("query_id"), F.posexplode("found").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.found").alias(id_col), F.col("hit.score").alias("score"))
