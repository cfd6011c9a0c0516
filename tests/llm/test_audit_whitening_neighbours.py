"""Filter audit, whitening and neighbour search against brute force."""

from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmfold.llm import filter_audit, neighbours, whitening
from firmfold.llm.common import table
from firmfold.llm.queries import QUERIES

VECTORS = "vec_id bigint, embedding array<float>"


# -- filter audit ---------------------------------------------------------------

def plain_audit(docs, labels):
    """(part, order, step) -> counts, filter by filter."""
    first = {}
    for d, text, _ in docs:
        if d is not None:
            first[text or ""] = min(first.get(text or "", d), d)

    def fails(d, text):
        text = text or ""
        words = [w for w in "".join(" " if c in "\x20\x09\x0a\x0b\x0c\x0d" else c for c in text).split(" ") if w]
        return {k for k, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), any(c in "#$%&*|" for c in text),
            d is not None and d > first[text])) if bad}

    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = [(source or "", d, fails(d, text)) for d, text, source in docs]
    out = {}
    for part in {r[0] for r in rows}:
        mine, shapley = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[2]]
                failing = [r for r in mine if f in r[2]]
                left = [r for r in left if f not in r[2]]
                shapley[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), len(failing) - len(gone), sum(r[2] == {f} for r in mine),
                                          sum(r[1] in good for r in gone), sum(r[1] in toxic for r in gone)]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return out


def test_audit_of_odd_rows(llm, odd_docs):
    words = " ".join(f"w{i}" for i in range(300))
    more = llm.createDataFrame([(20, words, None), (21, words, "a"), (22, words, ""), (19, words + " $", "a"), (23, words.upper(), "a"),
                                (24, "x y " * 400, "b"), (25, "ÄÖ z " * 400, "b")], "doc_id bigint, text string, source string")
    docs = odd_docs.unionByName(more, allowMissingColumns=True)
    labels = llm.createDataFrame([(1, 1, 0), (4, 1, 1), (5, None, 1), (20, 1, None), (20, 0, 1), (21, 0, 1), (None, 1, 1), (99, 1, 1)],
                                 "doc_id bigint, quality int, toxic int").withColumn("part", F.lit("clash"))
    got = {(r[0], r[1], r[2]): list(r[3:]) for r in filter_audit.audit(docs, labels).collect()}
    want = plain_audit([tuple(r) for r in docs.select("doc_id", "text", "source").collect()],
                       [tuple(r)[:3] for r in labels.collect()])
    assert got == want


def test_audit_of_nothing(llm, no_docs):
    labels = llm.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(no_docs, labels).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 100, 4097])
def test_carry_save_counts(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    assert filter_audit.positional_counts(words).tolist() == [int(((words >> k) & 1).sum()) for k in range(32)]


# -- whitening ------------------------------------------------------------------

def plain_components(vectors):
    x = np.floor(np.asarray(vectors, dtype=np.float64) * 1024).astype(np.int64) + 100000
    deviations = len(x) * x - x.sum(axis=0)
    centred = deviations / len(x)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    return (deviations.astype(object) ** 2).sum(axis=1), centred, values[::-1], axes[:, ::-1]


def test_whitening_query_equals_eigenvectors(llm, sf):
    rows = table(llm, sf, "embeddings").toPandas().sort_values("vec_id")
    deviation, centred, values, axes = plain_components(np.stack(rows["embedding"]))
    got = QUERIES["op12_whitening"](llm, sf).toPandas().sort_values(["vec_id", "component"])
    assert len(got) == 8 * len(rows) and got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-12
    assert got[got["component"] == 1]["deviation"].tolist() == deviation.tolist()
    white = got["whitened"].to_numpy().reshape(-1, 8)
    want = centred @ axes[:, :8] / np.sqrt(values[:8])
    for k in range(8):
        assert min(np.abs(white[:, k] - want[:, k]).max(), np.abs(white[:, k] + want[:, k]).max()) < 1e-9
    assert np.allclose(got["explained"].iloc[:8], values[:8] / values.sum(), rtol=1e-12)


def test_whitening_of_odd_rows(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 0.5]), (2, [1.0, 2.0, 0.5]), (2, [0.0, 2.0, 0.0]), (None, [3.0, 2.0, 0.25]), (3, None), (4, [1.0, None, 0.0]),
            (5, [nan, 1.0, 1.0]), (6, [inf, 1.0, 1.0]), (7, [1.0, 2.0]), (8, []), (9, [2e12, 0.0, 0.0])]
    frame = llm.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({"n": F.lit("clash"), "id": F.lit(0), "vector": F.lit(1)})
    got = whitening.whiten(frame).toPandas()
    assert sorted(got["vec_id"].fillna(-1).astype(int)) == [-1] * 3 + [1] * 3 + [2] * 6
    _, _, values, _ = plain_components([r[1] for r in rows[:4]])
    one = got[got["vec_id"] == 1].sort_values("component")
    assert (one["n"] == 4).all() and np.allclose(one["explained"], values / values.sum(), atol=1e-12)
    assert one["whitened"].notna().tolist() == [True, True, False]  # the second column is constant
    assert got["identity_error"].iloc[0] < 1e-9
    for few in ([], rows[4:7]):
        assert whitening.whiten(llm.createDataFrame(few, "vec_id bigint, embedding array<double>")).collect() == []
    alone = whitening.whiten(llm.createDataFrame(rows[:2], VECTORS)).collect()
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alone] == [(0, None, None, None)] * 6


def test_whitening_of_nearly_dependent_and_large_columns(llm):
    draw = np.random.default_rng(3)
    base = draw.standard_normal((400, 4)) * [1e6, 1.0, 300.0, 0.01]
    base[:, 3] = base[:, 0] / 1e6 + base[:, 3]
    frame = llm.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id bigint, embedding array<double>")
    got = whitening.whiten(frame).toPandas().sort_values(["vec_id", "component"])
    deviation, centred, _, _ = plain_components(base)
    wide = [int(v) if v < 1 << 63 else None for v in deviation]
    ones = whitening.whiten(frame).filter("component = 1").orderBy("vec_id")
    assert [r["deviation"] for r in ones.collect()] == wide
    _, singular, axes = np.linalg.svd(centred, full_matrices=False)
    want = centred @ axes.T / singular * np.sqrt(len(base))
    white = got["whitened"].to_numpy().reshape(-1, 4)
    for k in range(4):
        assert min(np.abs(white[:, k] - want[:, k]).max(), np.abs(white[:, k] + want[:, k]).max()) < 1e-4
    assert got["identity_error"].iloc[0] < 1e-4


# -- neighbours -----------------------------------------------------------------

def nearest(ids, x, queries, k):
    out = {}
    for q in queries:
        score = x @ x[q]
        order = sorted((i for i in range(len(ids)) if ids[i] != ids[q]), key=lambda i: (-score[i], ids[i]))[:k]
        out[ids[q]] = [ids[i] for i in order]
    return out


def lists_of(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    return out


def recall(got, want):
    return np.mean([len(set(got.get(q, [])) & set(w)) / len(w) for q, w in want.items()])


def test_query_recall_and_scores(llm, sf):
    rows = table(llm, sf, "embeddings").toPandas().sort_values("vec_id")
    ids, x = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(np.float64)
    asked = np.flatnonzero(ids % 20 == 0)
    result = QUERIES["op11_neighbours"](llm, sf)
    assert recall(lists_of(result), nearest(ids, x, asked, 20)) > 0.99
    place = {i: k for k, i in enumerate(ids)}
    found = result.collect()
    assert len(found) == 20 * len(asked)
    for r in found:
        assert abs(r["score"] - x[place[r["query_id"]]] @ x[place[r["vec_id"]]]) < 1e-12


def test_recall_with_descent_at_work(llm, monkeypatch):
    """Small leaves, long and short vectors, near copies: the rounds and the search have to find the rest."""
    monkeypatch.setattr(neighbours, "LEAF", 128)
    monkeypatch.setattr(neighbours, "TREES", 2)
    draw = np.random.default_rng(5)
    centres = draw.standard_normal((30, 24))
    x = centres[draw.integers(0, 30, 3000)] + 0.7 * draw.standard_normal((3000, 24))
    x[:900] = centres[0] + 0.05 * draw.standard_normal((900, 24))
    x *= draw.uniform(0.3, 2.0, 3000)[:, None]
    x = x.astype(np.float32).astype(np.float64)
    frame = llm.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], VECTORS)
    index = neighbours.build(frame)
    result = neighbours.search(index, frame.filter("vec_id % 20 = 0"))
    assert recall(lists_of(result), nearest(list(range(3000)), x, range(0, 3000, 20), 20)) >= 0.9
    outside = llm.createDataFrame([(-1, (x[17] * 1.5).tolist()), (-2, (-x[950]).tolist())], VECTORS)
    got = lists_of(neighbours.search(index, outside))
    want = {q: np.argsort(-(x @ v), kind="stable")[:20].tolist() for q, v in ((-1, x[17]), (-2, -x[950]))}
    assert recall(got, want) >= 0.9


def test_neighbours_of_odd_rows(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, [0.0, 2.0]), (3, [0.5, 0.5]), (4, None), (5, []),
            (40, [0.0, 0.0]), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [1.0, None]), (120, [1.0]), (None, [1.0, 1.0]), (140, [-1.0, -0.0])]
    frame = llm.createDataFrame(rows, VECTORS).withColumns({"id": F.lit("clash"), "node": F.lit(1), "query": F.lit(2), "rank": F.lit(3)})
    result = neighbours.search(neighbours.build(frame), frame.filter("vec_id % 20 = 0"))
    assert lists_of(result) == {0: [1, 2, 3, 20, 140], 20: [3, 0, 1, 2, 140], 140: [20, 3, 0, 1, 2]}
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    for few in ([], rows[6:9]):
        frame = llm.createDataFrame(few, VECTORS)
        assert neighbours.search(neighbours.build(frame), frame).collect() == []


def test_many_equal_vectors(llm):
    frame = llm.createDataFrame([(i, [1.0, 2.0]) for i in range(500)] + [(i, [2.0, 1.0]) for i in range(500, 510)], VECTORS)
    got = lists_of(neighbours.search(neighbours.build(frame), frame.filter("vec_id in (0, 300, 505)")))
    assert got == {0: list(range(1, 21)), 300: list(range(20)),
                   505: [500, 501, 502, 503, 504, 506, 507, 508, 509] + list(range(11))}
