"""Quality rules and mixing against plain Python."""

import re
from collections import Counter


from firmfold.llm import mixing, quality
from firmfold.llm.quality import Threshold

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    w = WORD.findall(text or "")
    seen = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    covered = {j for k in range(len(w) - 7) if seen[tuple(w[k:k + 8])] > 1 for j in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_match_plain_python(llm, sf, odd_docs):
    docs = llm.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd_docs.select("doc_id", "text"))
    texts = sorted(((r.doc_id is None, r.doc_id or 0, *plain(r.text)) for r in docs.collect()))
    got = sorted((r.doc_id is None, r.doc_id or 0, *(r[c] for c in COUNTS)) for r in quality.judge(docs).collect())
    assert got == texts


def test_base_and_table(llm):
    good = " ".join(f"the w{i}" for i in range(30))
    rows = [(1, good), (2, "too few words"), (3, " ".join(["a b c d e f g h"] * 4)), (4, good.replace("the", "%%%"))]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert out[1].kept and not out[1].base_failed
    assert out[2].base_failed and "too_short" in out[2].failed
    assert out[3].base_failed and "repeats" in out[3].failed
    assert not out[4].kept and not out[4].base_failed and "symbols" in out[4].failed
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == {1}
    only = quality.judge(docs, rules=(Threshold("long", "n_words", at_most=10),), base=()).collect()
    assert {r.doc_id for r in only if r.kept} == {2}


def test_no_user_function(llm, sf):
    plan = quality.judge(llm.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_rules_keep_odd_rows_and_empty_tables(odd_docs, no_docs):
    assert quality.judge(odd_docs).count() == 13
    assert quality.judge(no_docs).count() == 0
    assert quality.keep_good(odd_docs).columns == odd_docs.columns


def test_mix_is_near_its_targets_and_bounded(llm, sf):
    docs = llm.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix(docs, block=8).collect()
    again = mixing.mix(docs.repartition(7), block=8).collect()
    assert sorted(rows) == sorted(again) and len(rows) == docs.count()
    assert all(r.taken <= 2 * r["size"] for r in rows)
    by = {}
    for r, d in ((r, r.target) for r in rows):
        taken, _ = by.get((d, r.source_size), (0, 0))
        by[d, r.source_size] = taken + r.taken, 0
    total = sum(r["size"] for r in rows)
    assert abs(sum(r.taken for r in rows) - 1.5 * total) < 0.02 * total


def test_targets_fill_like_water(llm):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 40, None: 7}
    docs = llm.createDataFrame([(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes.items())],
                               "doc_id bigint, text string, source string")
    got = {r.s: r.target for r in mixing.source_targets(mixing.measured(docs), block=4).collect()}
    weight = dict(zip(["0a", "0b", "0c", "0d", "1"], [5, 2, 1, 5, 2]))
    size = dict(zip(weight, [10, 1000, 500, 40, 7]))
    target, left, open_ = {}, 1.5 * sum(size.values()), set(size)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * size[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2 * size[s]
            left -= target[s]
        open_ -= over
    assert got.keys() == target.keys() and all(abs(got[s] - target[s]) < 1e-6 for s in target)


def test_slots_permute_blocks(llm):
    docs = llm.createDataFrame([(i, " ".join(["w"] * 50), "s") for i in range(20)], "doc_id bigint, text string, source string")
    targets = mixing.source_targets(mixing.measured(docs), block=10)
    slots = mixing.draw_slots(targets, shard_slots=16).collect()
    assert len(slots) == 150
    assert Counter(r["pass"] for r in slots) == {0: 100, 1: 50}
    assert len({(r["pass"], r.block) for r in slots}) == 150  # no block twice in a pass
    assert sorted(r.shard * 16 + r.slot for r in slots) == list(range(150))
    counts = mixing.shard_counts(mixing.draw_slots(targets, shard_slots=16)).collect()
    assert sum(r.n_blocks for r in counts) == 150


def test_mixed_texts_hold_the_taken_words(llm, odd_docs, no_docs):
    rows = {(r.doc_id, r["size"]): r.taken for r in mixing.mix(odd_docs, block=16).collect() if r.doc_id not in (None, 5)}
    mixed = mixing.mixed_texts(odd_docs, block=16)
    assert mixed.columns == odd_docs.columns
    taken = Counter()
    for r in mixed.collect():
        assert r.n_chars == len(r.text)
        taken[r.doc_id] += len(WORD.findall(r.text))
    for (doc, size), n in rows.items():
        assert taken[doc] == n
    assert mixing.mix(odd_docs, block=16).count() == 13
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_texts(no_docs).count() == 0


def test_mix_runs_no_python(llm, sf):
    plan = mixing.mix(llm.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
