"""N-gram Jaccard join with a count-vector R-tree.

A document's set holds its distinct word shingles. Tokens (shingles) are hashed into
groups; a document is the point of its group counts. For two points the sum of the
coordinate minima bounds the overlap from above, and for two tree pages the same sum
over their upper corners bounds every pair between them. Pairs whose bound reaches the
wanted similarity are verified on the sets themselves.

The tree is a distributed one, with nothing that grows with the data on the driver:

* Equal sets are one class; only classes enter the tree, copies follow by membership.
* Entry to the tree is an equi-join on shingles. With all shingles in one global order,
  frequent ones last, two similar sets share at least c shingles among the first
  ``n - ceil(t n) + c`` of each, so sets that share fewer with anybody are finished.
* The others are put on leaf pages by the entry they share with most sets and their size
  band; families beyond a page's room are split. A page knows its upper corner.
* Pages meet if they hold a common entry shingle, are of neighbouring bands and their
  corners' minima can reach the similarity. Within two pages, points are bounded, then
  verified; pairs that already hang together are skipped, so a pair of pages gives at
  most one link per document and loses no connection.

The frequent shingles are counted over all documents and only decide the order, so a
bounded number of them (``FREQUENT``) is sent to the tasks; any order gives the same links.

Defined results: a null text, or one without words, has size 0 and is linked with
nothing; a text of fewer words than a shingle is one whole-sequence shingle; rows with
repeated ids are linked by their texts, null ids take part but name no component (a
group of null ids only has a null component); an empty table gives an empty result.
Only the named columns are read. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmfold.llm.common import pick, written
from firmfold.llm.components import components

SHINGLE = 5
PERCENT = 80
FREQUENT = 100_000
CORNER_GROUPS = 64
POINT_GROUPS = 256
PAGE_TOKENS = 1 << 18
BIT_TABLE = 1 << 25
_CHUNK_TOKENS = 4_000_000
_CHUNK_LEAST = 3
_SLICE_BYTES = 1 << 20
_SEEN_CLASSES = 200_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


# Random numbers of the bytes, A-Z equal to a-z; powers of an odd number and of its inverse.
_BYTE = np.random.default_rng(5).integers(0, 1 << 64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.empty(0, dtype=np.uint64)] * 2


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            _powers[k] = np.cumprod(factors)
    return _powers


def _word_hashes(raw: bytes) -> np.ndarray:
    """Hashes of the words of a text: sums of byte numbers times powers of the place in the word."""
    data = np.frombuffer(raw, dtype=np.uint8)
    edge = np.ones(len(data) + 2, dtype=bool)
    edge[1:-1] = _SPACE[data]
    bounds = np.flatnonzero(edge[1:] != edge[:-1])
    starts, ends = bounds[::2], bounds[1::2]
    up, down = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=sums[1:])
    return _finished((sums[ends] - sums[starts]) * down[starts])


def _sliced(raw: bytes) -> Iterator[bytes]:
    """A long text in slices that end at white space."""
    at = 0
    while len(raw) - at > _SLICE_BYTES:
        ends = [e for e in (raw.find(s, at + _SLICE_BYTES) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if e >= 0]
        if not ends:
            break
        yield raw[at:min(ends)]
        at = min(ends)
    yield raw[at:] if at else raw


def _finished(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text; A-Z count as a-z."""
    parts = [_word_hashes(raw) for raw in _sliced((text or "").encode("utf-8", "surrogatepass"))]
    h = parts[0] if len(parts) == 1 else np.concatenate(parts)
    if not len(h):
        return h
    n = max(1, len(h) - size + 1)
    total = np.full(n, min(len(h), size), dtype=np.uint64)
    for k in range(min(size, len(h))):
        total += h[k:k + n] * _ODD[k]
    total = np.sort(_finished(total))
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


def _class_of(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def _frequent(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of all documents, sorted, with the order class of each."""
    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n, seen = [], 0, set()

        def summed() -> pd.DataFrame:
            values, times = np.unique(np.concatenate(held), return_counts=True)
            often = times >= _CHUNK_LEAST
            return pd.DataFrame({"key": values[often].view(np.int64), "n": times[often]})

        for batch in batches:
            for text in batch["text"]:
                tokens = shingles(text, size)
                own = _class_of(tokens)
                if own in seen:  # copies in one chunk count once
                    continue
                seen.add(own)
                held.append(tokens)
                n += len(tokens)
                if n >= _CHUNK_TOKENS:
                    yield summed()
                    held, n, seen = [], 0, set()
        if held:
            yield summed()

    often = rows.select("text").mapInPandas(counts, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    top = often.orderBy(F.desc("n"), "key").limit(FREQUENT).toPandas()
    keys = top["key"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], (1 + np.log2(top["n"].to_numpy(dtype=float)))[order].astype(np.int8)


def _entries(tokens: np.ndarray, often: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """The set's first shingles in the global order: as many as make every similar set share c of them."""
    n = len(tokens)
    length = min(n, n - -(-percent * n // 100) + 1 + n // 20)
    at = np.minimum(np.searchsorted(often, tokens), max(len(often) - 1, 0))
    late = np.where(often[at] == tokens, rank[at], 0) if len(often) else np.zeros(n, dtype=np.int8)
    return tokens[np.argsort(late, kind="stable")[:length]] if late.any() else tokens[:length]


def _sketched(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """handle, id, n, class and entry shingles per document; copies within a task carry no entries."""
    often, rank = _frequent(rows, size)
    order = rows.sparkSession.sparkContext.broadcast((often, rank))

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        often, rank = order.value
        for batch in batches:
            out = []
            for handle, doc, text in zip(batch["handle"], batch["id"], batch["text"]):
                tokens = shingles(text, size)
                own = _class_of(tokens)
                first = own not in seen and len(tokens) > 0
                if len(seen) >= _SEEN_CLASSES:
                    seen.clear()
                seen.add(own)
                keys = _entries(tokens, often, rank, percent).view(np.int64) if first else None
                out.append((handle, doc, len(tokens), own, keys))
            yield pd.DataFrame(out, columns=["handle", "id", "n", "class", "keys"]).astype({"id": "Int64"})

    return rows.mapInPandas(sketch, "handle bigint, id bigint, n bigint, class bigint, keys array<bigint>")


def _least_shared(n: Column, percent: int) -> Column:
    """How many entries a set of n shingles shares with any similar one, at least."""
    return 1 + F.floor(F.floor((n * percent + 99) / 100) / 20)


def _shared_entries(base: DataFrame, percent: int) -> DataFrame:
    """(key, class, n, family) of the classes that share enough entries with others.

    The family is the entry that most classes share, so that what hangs together is put together.
    """
    rows = base.select("class", "n", F.explode("keys").alias("key"))
    by_key, by_class = Window.partitionBy("key"), Window.partitionBy("class")
    shared = rows.withColumns({"low": F.min("class").over(by_key), "high": F.max("class").over(by_key),
                               "held": F.count(F.lit(1)).over(by_key)}).filter("low < high")
    hits = shared.select("key", "class", "n", F.count(F.lit(1)).over(by_class).alias("hits"),
                         F.max(F.struct("held", "key")).over(by_class)["key"].alias("family"))
    return hits.filter(F.col("hits") >= _least_shared(F.col("n"), percent)).drop("hits")


def _placed(entries: DataFrame, base: DataFrame, percent: int) -> DataFrame:
    """(class, handle, band, leaf) of each class in the tree."""
    nodes = entries.groupBy("class").agg(F.first("n").alias("n"), F.first("family").alias("family"))
    nodes = nodes.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int"))
    room = nodes.groupBy("family", "band").agg(F.ceil(F.sum("n") / PAGE_TOKENS).alias("pages"))
    handles = base.groupBy("class").agg(F.min("handle").alias("handle"))
    page = F.pmod(F.xxhash64("class"), F.col("pages"))
    return nodes.join(room, ["family", "band"]).withColumn("leaf", F.xxhash64("family", "band", page)).join(
        handles, "class").select("class", "handle", "band", "leaf")


def _corner(tokens: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount((tokens % np.uint64(groups)).astype(np.int64), minlength=groups)


def _may_be_among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key (bigint) may be among those of ``wanted``, before anything is moved.

    A bit table of fixed size, set by an aggregation, stands for the keys: a row it
    passes wrongly is dropped by the join that follows.
    """
    bit = F.pmod(key, F.lit(BIT_TABLE))
    word = F.call_function("div", bit, F.lit(64)).alias("word")
    mask = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int"))).alias("mask")
    # At most BIT_TABLE / 64 rows, whatever the number of keys.
    found = wanted.groupBy(word).agg(mask).toPandas()
    table = np.zeros(BIT_TABLE // 64, dtype=np.int64)
    table[found["word"].to_numpy(dtype=np.int64)] = found["mask"].to_numpy(dtype=np.int64)
    shared = rows.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def able(keys: pd.Series) -> pd.Series:
        at = np.mod(keys.to_numpy(dtype=np.int64), BIT_TABLE)
        return pd.Series((shared.value[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1)

    return rows.filter(F.pandas_udf(able, "boolean")(F.col(key)))


def _pages(rows: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """One row per leaf page: its band, smallest set, upper corner, and the sets."""
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens = [shingles(t, size) for t in batch["text"]]
            yield pd.DataFrame({"class": batch["class"], "leaf": batch["leaf"], "band": batch["band"], "n": list(map(len, tokens)),
                                "corner": [_corner(t, CORNER_GROUPS) for t in tokens], "tokens": [t.tobytes() for t in tokens]})

    # Rows that repeat in id and text have one handle: one of them is the class on its page.
    one = _may_be_among(rows.select("handle", "text"), "handle", nodes).dropDuplicates(["handle"])
    wanted = one.join(nodes, "handle").select("class", "leaf", "band", "text")
    held = wanted.mapInPandas(sets, "class bigint, leaf bigint, band int, n int, corner array<int>, tokens binary")
    # A page has bounded room, so its lists are bounded; lists of one aggregation have one order.
    return held.groupBy("leaf").agg(
        F.first("band").alias("band"), F.min("n").alias("least"), F.sum("n").alias("room"), F.count(F.lit(1)).alias("members"),
        F.array(*[F.max(F.get("corner", F.lit(g))) for g in range(CORNER_GROUPS)]).alias("corner"),
        F.collect_list("class").alias("classes"), F.collect_list("tokens").alias("tokens"))


def _meeting(entries: DataFrame, nodes: DataFrame, pages: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different leaf pages that may hold a similar pair; a is the smaller page."""
    held = entries.select("key", "class").join(nodes.select("class", "band", "leaf"), "class").select(
        "key", "band", "leaf").distinct()
    near = held.select("key", F.col("band").alias("b_band"), F.col("leaf").alias("b"),
                       F.explode(F.array(F.col("band") - 1, F.col("band"))).alias("band"))
    met = held.withColumnRenamed("leaf", "a").join(near, ["key", "band"]).filter(
        (F.col("band") < F.col("b_band")) | (F.col("a") < F.col("b"))).groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    corners = [pages.select(F.col("leaf").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("least", "room", "corner")]) for s in "ab"]
    bounds = met.join(corners[0], "a").join(corners[1], "b")
    most = F.aggregate(F.zip_with("a_corner", "b_corner", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)
    enough = F.col("shared") >= _least_shared(F.least("a_least", "b_least"), percent)
    able = bounds.filter(enough & ((100 + percent) * most >= percent * (F.col("a_least") + F.col("b_least"))))
    small = F.col("a_room") <= F.col("b_room")
    return able.select(F.when(small, F.col("a")).otherwise(F.col("b")).alias("a"),
                       F.when(small, F.col("b")).otherwise(F.col("a")).alias("b"))


def _linked(a: list[np.ndarray], b: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """Index pairs that connect all similar sets of two pages; b is None for a page with itself."""
    other = a if b is None else b
    points = np.array([_corner(t, POINT_GROUPS) for t in other], dtype=np.int32)
    sizes = np.array([len(t) for t in other])
    parent = list(range(len(a) + (0 if b is None else len(b))))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    for i, tokens in enumerate(a):
        point = points[i] if b is None else _corner(tokens, POINT_GROUPS)
        most = np.minimum(points, point).sum(axis=1)
        able = (100 + percent) * most >= percent * (sizes + len(tokens))
        if b is None:
            able[:i + 1] = False
        for j in np.flatnonzero(able):
            x, y = root(i), root(int(j) if b is None else len(a) + int(j))
            if x == y:
                continue
            small, large = (tokens, other[j]) if len(tokens) <= len(other[j]) else (other[j], tokens)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            common = int((large[at] == small).sum())
            if 100 * common >= percent * (len(small) + len(large) - common):
                parent[x] = y
                found.append((i, int(j)))
    return found


def _links(meeting: DataFrame, pages: DataFrame, percent: int) -> DataFrame:
    """Verified links (a, b) between classes, of pages in themselves and of pages that meet."""
    def sets(tokens: list[bytes]) -> list[np.ndarray]:
        return [np.frombuffer(x, dtype=np.uint64) for x in tokens]

    def within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(names[i], names[j]) for names, tokens in zip(batch["classes"], batch["tokens"])
                   for i, j in _linked(sets(tokens), None, percent)]
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    def between(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(r.a_classes[i], r.b_classes[j]) for r in batch.itertuples(index=False)
                   for i, j in _linked(sets(r.a_tokens), sets(r.b_tokens), percent)]
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    meeting = written(meeting, "meeting")
    ends = meeting.select(F.col("a").alias("leaf")).unionByName(meeting.select(F.col("b").alias("leaf")))
    met_pages = _may_be_among(pages.select("leaf", "classes", "tokens"), "leaf", ends)

    def side(name: str) -> DataFrame:
        return met_pages.select(F.col("leaf").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("classes", "tokens")])

    schema = "a bigint, b bigint"
    own = pages.filter("members > 1").select("classes", "tokens").mapInPandas(within, schema)
    met = meeting.join(side("a"), "a").join(side("b"), "b").drop("a", "b")
    return own.unionByName(met.mapInPandas(between, schema))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``handle`` (a hash of id and text),
    ``stays`` (the text with its component's smallest id, and every text without a word)."""
    rows = pick(docs, id=id_col, text=text_col).withColumn("handle", F.xxhash64("id", "text"))
    base = written(_sketched(rows, size, percent), "sketches")
    entries = written(_shared_entries(base, percent), "entries")
    nodes = written(_placed(entries, base, percent), "nodes")
    pages = written(_pages(rows, nodes, size), "pages")
    links = _links(_meeting(entries, nodes, pages, percent), pages, percent)
    joined = components(links)
    slim = base.select("handle", "id", "n", "class")
    # Classes without a link are components of their own.
    groups = slim.join(joined, F.col("class") == F.col("node"), "left").select(
        "handle", "id", "n", F.coalesce("component", "class").alias("component"))
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("handle"))).alias("first")
    least = groups.groupBy("component").agg(F.min("id").alias("component_id"), first)
    none = F.col("n") == 0
    return groups.join(least, "component").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(none, F.col("id")).otherwise(F.col("component_id")).alias("component_id"), "handle",
        (none | (F.col("handle") == F.col("first.handle"))).alias("stays"))


def keep_one(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns; texts without a word all stay."""
    mark, nth = "__jaccard_handle", "__jaccard_nth"
    found = near_duplicates(docs, percent, size, id_col, text_col).filter("stays")
    chosen = found.select(F.col("handle").alias(mark), (F.col("n_shingles") == 0).alias(nth)).distinct()
    marked = docs.withColumn(mark, F.xxhash64(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`")))
    # Repeated rows have one handle: the first of them stays.
    order = F.row_number().over(Window.partitionBy(mark).orderBy(mark))
    kept = marked.join(chosen, mark).withColumn(nth, F.when(F.col(nth), 1).otherwise(order)).filter(F.col(nth) == 1)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
