"""Jaccard join, components and embedding near-dedup against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmfold.llm import embed_dedup, jaccard
from firmfold.llm.components import components


class Union(dict):
    def root(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


def sets_of(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets, union = {i: sets_of(t) for i, t in rows}, Union()
    for a in sets:
        union.root(a)
        for b in sets:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                    union.join(a, b)
    return {i: (len(sets[i]), union.root(i)) for i in sets}


def test_components(llm):
    draw = random.Random(3)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(1000, k) for k in range(400, 600)]
    pairs += [(k, k + 1) for k in range(700, 760)]
    union = Union()
    for a, b in pairs:
        union.join(a, b)
    got = {r.node: r.component for r in components(llm.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {x: union.root(x) for a, b in pairs if a != b for x in (a, b)}
    assert components(llm.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_jaccard_on_the_table(llm, sf):
    docs = llm.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_near_the_border(llm, seed, monkeypatch):
    """A star of near copies around the border, a common passage, short texts; small pages."""
    monkeypatch.setattr(jaccard, "PAGE_TOKENS", 2000)
    monkeypatch.setattr(jaccard, "_CHUNK_TOKENS", 3000)
    draw = random.Random(seed)
    base, passage = [f"b{k}" for k in range(80)], [f"p{k}" for k in range(30)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(draw.randrange(6)):
            text[draw.randrange(80)] = f"e{draw.randrange(10_000)}"
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join([f"u{i}x{k}" for k in range(draw.randrange(10, 60))] + passage)) for i in range(150, 220)]
    rows += [(i, " ".join(f"s{draw.randrange(3)}" for _ in range(draw.randrange(0, 8)))) for i in range(220, 280)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()}
    assert got == brute(rows)
    kept = {r.doc_id for r in jaccard.keep_one(docs).collect()}
    assert kept == {i for i, (n, c) in got.items() if n == 0 or i == c}


def test_jaccard_odd_rows(odd_docs, no_docs):
    out = jaccard.near_duplicates(odd_docs).collect()
    got = {(r.doc_id, r.n_shingles): r.component_id for r in out}
    assert len(out) == 13
    assert got[1, 0] == 1 and got[2, 0] == 2 and got[3, 0] == 3  # without words: alone
    assert got[6, 192] == 5 and got[5, 196] == 5
    assert got[8, 1] == 7  # short texts, case folded
    assert (None, 0) in got and got[None, 0] is None
    kept = jaccard.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        *[(False, k) for k in (1, 2, 3, 4, 5, 7, 9, 10)], (True, 0), (True, 0)]
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_jaccard_repeated_rows(llm, monkeypatch):
    """Rows that repeat in id and text, null ids too, are one class on their page, whatever their number."""
    text = [f"r{k}" for k in range(60)]
    rows = [(3, " ".join(text))] * 200 + [(None, " ".join(text[:-1]))] * 200 + [(1, " ".join(["x", *text[1:]])), (2, "alone here")]
    pages = []
    monkeypatch.setattr(jaccard, "_links", lambda meeting, held, percent, links=jaccard._links: (
        pages.append(held), links(meeting, held, percent))[1])
    docs = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect())
    assert got == [(0, 55, 1)] * 200 + [(1, 56, 1), (2, 1, 2)] + [(3, 56, 1)] * 200
    held = pages[0].select("members", "room", F.size("classes").alias("size")).collect()
    assert sum(r.members for r in held) == sum(r["size"] for r in held) == 3
    assert sum(r.room for r in held) == 55 + 2 * 56


def test_shingles_of_long_texts(monkeypatch):
    text = " ".join(f"w{k % 501}\n" for k in range(5000))
    whole = jaccard.shingles(text)
    monkeypatch.setattr(jaccard, "_SLICE_BYTES", 100)
    assert (jaccard.shingles(text) == whole).all() and len(whole) == len(sets_of(text))
    assert (jaccard.shingles("ÀB c  d") == jaccard.shingles("Àb C d")).all()
    assert len(jaccard.shingles("à b")) == 1 and (jaccard.shingles("à b") != jaccard.shingles("À b")).all()


def exact(vectors, cosine=0.95):
    units = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v in vectors}
    links, union = dict.fromkeys(units, 0), Union()
    for a in units:
        union.root(a)
        for b in units:
            if a != b and units[a].shape == units[b].shape and units[a] @ units[b] >= cosine:
                links[a] += 1
                union.join(a, b)
    return {i: (links[i], union.root(i), union.root(i) == i) for i in units}


def test_embeddings(llm, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CHUNK", 40)
    draw = np.random.default_rng(4)
    centre = draw.standard_normal((12, 32))
    rows = [(i, (centre[i % 12] + 0.22 * draw.standard_normal(32)).tolist()) for i in range(300)]
    rows += [(300 + i, (5 * centre[0]).tolist()) for i in range(30)]  # equal ones
    rows += [(330 + i, draw.standard_normal(32).tolist()) for i in range(100)]
    rows += [(430, [1.0, 0.0]), (431, [2.0, 0.0]), (432, [1.0])]
    bad = [(500, None), (501, []), (502, [0.0] * 32), (503, [float("nan")] * 32), (504, [None] * 32), (505, [float("inf")] + [0.0] * 31)]
    frame = llm.createDataFrame(rows + bad, "vec_id bigint, embedding array<float>").withColumn("n", F.lit("clash"))
    rows = [(r.vec_id, r.embedding) for r in frame.collect() if r.vec_id < 500]
    want = exact(rows) | {i: (0, i, True) for i, _ in bad}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(frame).collect()}
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(w[0] for w in want.values())
    assert sum(got[i] == want[i] for i in want) >= 0.95 * len(want)
    assert got[430] == (1, 430, True) and got[431] == (1, 430, False)
    assert embed_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_embeddings_repeated_and_null_ids(llm):
    frame = llm.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [0.0, 1.0])],
                                "vec_id bigint, embedding array<float>")
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id or 0, r.kept) for r in embed_dedup.near_duplicates(frame).collect())
    assert got == [(0, 0, 0, False), (0, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True)]


@pytest.mark.parametrize("cosine", [0.951, 0.97])
def test_recall_of_planted_pairs(llm, cosine):
    """Pairs just above the threshold, planted among a whole table of vectors, against brute force."""
    table = llm.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    vectors = np.array([r.embedding for r in table.orderBy("vec_id").collect()], dtype=float)
    draw = np.random.default_rng(int(1000 * cosine))
    units = vectors[draw.permutation(len(vectors))[:300]]
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    aside = draw.standard_normal(units.shape)
    aside -= (aside * units).sum(axis=1, keepdims=True) * units
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    planted = cosine * units + np.sqrt(1 - cosine ** 2) * aside
    extra = llm.createDataFrame([(10_000_000 + k, v.tolist()) for k, v in enumerate(planted)], "vec_id bigint, embedding array<double>")
    frame = table.withColumn("embedding", F.col("embedding").cast("array<double>")).union(extra)
    everything = np.vstack([vectors / np.linalg.norm(vectors, axis=1, keepdims=True), planted])
    want = int((everything @ everything.T >= 0.95).sum()) - len(everything)
    got = embed_dedup.near_duplicates(frame, cosine=0.95).agg(F.sum("n_links")).first()[0]
    assert 600 <= want and got <= want and got >= 0.9 * want
