"""Packing as an exact round trip; the pipeline against plain Python, stage by stage."""

import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from firmfold.llm import language, packing
from tests.llm.test_links import brute
from tests.llm.test_rules_and_mix import WORD, plain


def whole_ids(texts):
    encode = packing._encoder(packing.VOCABULARY)._whole.encode
    return [[*encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def check_pieces(rows, docs, capacity):
    """Every document's ids stand in the pieces, in order; sequences are gapless and within capacity."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.start - r.piece * capacity), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    want = Counter()
    for (doc, text), ids in zip(docs, whole_ids([t for _, t in docs])):
        for k in range(0, len(ids), capacity):
            part = ids[k:k + capacity]
            want[doc, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    return len(by_sequence), -(-sum(r.length for r in rows) // capacity)


def test_encoder_equals_the_tokenizer(sf, llm):
    texts = [r.text for r in llm.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += ["".join(map(chr, range(0x250))), " ".join(map(chr, range(0x250))), "x".join(map(chr, range(0x20, 0x250))),
              "ª²½ x²y ½½ 1²3 don't're 's've'll'd'm _'_ ȺȾƁƆƎ ȺȾ", "w" * 5000, "\x1c a\x1fb \x0b\x0c\xa0 c\xadd", "<|startoftext|>a< |b<|"]
    texts += ["I'll don't 'S'T", "İ ΣΑΣ <|endoftext|> x½²٣ _a_b q", "é É ß ŉ \x00\x85", "ǅ 日本 語 ªº¼", "a̕ é"]
    encoder = packing.Encoder(packing.VOCABULARY)
    assert [[*np.frombuffer(encoder.encode(t), "<u4"), 1] for t in texts] == whole_ids(texts)


def test_pack_the_table(llm, sf):
    docs = llm.read.parquet(f"{sf}/documents.parquet")
    used, least = check_pieces(packing.pack(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()], 4096)
    assert used <= least + 1


def test_pack_odd_rows(llm, odd_docs, no_docs):
    rows = packing.pack(odd_docs, capacity=64).collect()
    check_pieces(rows, [(r.doc_id, r.text) for r in odd_docs.collect()], 64)
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_shards_pack_tightly(seed):
    draw = random.Random(seed)
    lengths = np.array([draw.choice([100, draw.randrange(1, 101), draw.randrange(26, 60), draw.randrange(1, 20)]) for _ in range(1500)])
    sequence, offset = packing.pack_shard(lengths, 100, 10)
    fill = np.bincount(sequence, weights=lengths)
    assert (fill <= 100).all() and len(set(zip(sequence, offset))) == len(lengths)
    assert len(fill) <= 1.02 * np.ceil(lengths.sum() / 100) + 1
    alone, _ = packing.pack_shard(np.array([51] * 9), 100)
    assert len(set(alone)) == 9
    assert len(packing.pack_shard(np.array([], dtype=int), 100)[0]) == 0


def lengths_between(low, high, n=8192, seed=1):
    return np.random.default_rng(seed).integers(low, high + 1, n)


@pytest.mark.parametrize("lengths", [
    lengths_between(1, 4096), lengths_between(1400, 2700), lengths_between(1025, 2400),
    np.clip(np.random.default_rng(2).normal(1500, 300, 8192), 1, 4096).astype(int)], ids=["flat", "halves", "thirds", "bell"])
def test_never_worse_than_best_fit_decreasing(lengths):
    sequence, _ = packing.pack_shard(lengths)
    assert np.bincount(sequence, weights=lengths).max() <= 4096
    plain = packing._Rooms(lengths, 4096)
    plain.best_fit(np.argsort(-lengths, kind="stable").tolist())
    assert len(set(sequence.tolist())) <= len(plain.room)


def test_sequences_hold_the_ids(llm, sf):
    docs = llm.read.parquet(f"{sf}/documents.parquet").limit(40)
    docs = docs.filter(docs.doc_id < 60)
    found = {}
    for r in packing.sequences(docs, capacity=512).collect():
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length <= 512
        for p in r.parts:
            found[p.doc_id, p.piece] = ids[p.offset:p.offset + p.length].tolist()
    rows = docs.collect()
    for r, ids in zip(rows, whole_ids([r.text for r in rows])):
        assert sum((found[r.doc_id, k] for k in range(-(-len(ids) // 512))), []) == ids


def test_pipeline_by_stages(llm, sf):
    docs = llm.read.parquet(f"{sf}/documents.parquet")
    columns, held = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    stage = dict(corpus_pipeline.STAGES)

    good = stage["quality_rules"](llm, docs, sf).cache()
    kept = {r.doc_id: r.text for r in good.collect()}
    stops = set(corpus_pipeline.quality.STOP_WORDS)

    def passes(text):
        n, chars, symbols, dup, repeats = plain(text)
        lines = len([x for x in text.split("\n") if WORD.search(x)])
        stop = sum(w.lower() in stops for w in WORD.findall(text))
        return (n >= 20 and 100 * repeats <= 30 * n and 2 <= chars / n <= 20 and symbols <= 0.1 * n
                and stop >= 0.02 * n and dup <= 0.5 * lines)

    assert kept == {i: t for i, t in held.items() if passes(t)}

    told = stage["language_id"](llm, good, sf).cache()
    model = language.train(good)
    names, shares = language._predicted(pd.Series(kept.values()), model)
    known = {i: t for (i, t), name, share in zip(kept.items(), names, shares) if name != "und" and share >= 0.3}
    assert {r.doc_id: r.text for r in told.collect()} == known

    single = stage["jaccard_join"](llm, told, sf).cache()
    groups = brute(list(known.items()))
    one = {r.doc_id: r.text for r in single.collect()}
    assert one == {i: t for i, t in known.items() if groups[i][1] == i}

    mixed = stage["mix_sources"](llm, single, sf).cache()
    taken = Counter()
    for r in mixed.collect():
        taken[r.doc_id] += len(WORD.findall(r.text))
        rest = Counter(WORD.findall(one[r.doc_id]))
        assert not Counter(WORD.findall(r.text)) - rest  # a pass takes no word twice
    want = corpus_pipeline.mixing.mix(single).collect()
    assert {r.doc_id: r.taken for r in want if r.taken} == taken
    assert all(f.columns == columns for f in (good, told, single, mixed))

    rows = [(r.doc_id, r.text) for r in mixed.collect()]
    packed = stage["best_fit_packing"](llm, mixed, sf).collect()
    used, least = check_pieces(packed, rows, 4096)
    assert used <= least + 1


def test_run_equals_the_stages(llm, sf):
    docs = llm.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(llm, docs, sf).cache()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(corpus_pipeline.run(llm, sf).select(names).collect()) == sorted(docs.select(names).collect())


def test_pipeline_of_an_empty_table(llm, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(llm, docs, "")
    assert docs.count() == 0
