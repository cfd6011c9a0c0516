"""Language and toxicity: held-out accuracy and defined results; license scans against plain Python."""

import re
import zlib

from pyspark.sql import functions as F

from firmfold.llm import language, license_scan, toxicity


def test_language_held_out(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify(docs, language.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in out if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_language_odd_rows(llm, odd_docs, no_docs):
    model = language.train(odd_docs)
    out = language.identify(odd_docs, model).collect()
    got = {(r.doc_id): (r.lang_pred, r.score) for r in out}
    assert len(out) == 13 and got[1] == got[2] == got[3] == got[9] == ("und", 0.0)
    kept = language.keep_known(odd_docs, model)
    assert kept.columns == odd_docs.columns and 9 not in {r.doc_id for r in kept.collect()}
    assert language.train(no_docs) is None
    assert language.identify(no_docs, None).count() == 0
    assert {r.lang_pred for r in language.identify(odd_docs, None).collect()} == {"und"}


def test_toxicity_held_out(llm):
    docs = llm.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = llm.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.train(docs, labels)
    out = toxicity.judge(docs, model).join(labels, "doc_id").filter("held_out").collect()
    toxic, clean = [[r.score for r in out if r.toxic == t] for t in (1, 0)]
    assert min(len(toxic), len(clean)) > 50
    assert sum(s >= 0.3 for s in toxic) >= 0.85 * len(toxic)  # some 300 toxic texts to learn from, few per language
    assert sum(s < 0.3 for s in clean) >= 0.97 * len(clean)


def test_toxicity_odd_rows(llm, odd_docs, no_docs):
    labels = llm.createDataFrame([(4, 1), (5, 0), (6, 0), (7, 1), (7, 1), (10, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(odd_docs, labels)
    out = toxicity.judge(odd_docs, model).collect()
    assert len(out) == 13 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert toxicity.train(no_docs, labels) is None and toxicity.train(odd_docs, labels.limit(0)) is None
    assert toxicity.judge(no_docs, model).count() == 0


def test_toxicity_sample_is_of_documents_that_are_there(llm):
    """Labels of absent and of long documents take no place in the sample; texts of one id are told apart by their hash."""
    docs = llm.createDataFrame([(k, f"word{k % 7} and more of text {k}") for k in range(60)]
                               + [(100 + k, "long " * 4000) for k in range(50)] + [(1, "another text")], "doc_id bigint, text string")
    labels = llm.createDataFrame([(k, k % 2) for k in range(60)] + [(100 + k, k % 2) for k in range(50)]
                                 + [(1000 + k, k % 2) for k in range(3000)], "doc_id bigint, toxic int")
    learnt = []
    real = toxicity.Model.__init__

    def noted(self, texts, goals):
        learnt.append((texts, goals))
        real(self, texts, goals)

    toxicity.Model.__init__ = noted
    try:
        models = [toxicity.train(docs.orderBy(F.rand(s)), labels.orderBy(F.rand(s)), rows=20) for s in (1, 2)]
    finally:
        toxicity.Model.__init__ = real
    able = [k for k in range(60) if zlib.crc32(str(k).encode()) % 4 != 2]
    assert learnt[0] == learnt[1] and models[0].intercept == models[1].intercept
    for label in (0, 1):
        assert learnt[0][1].count(label) == min(20, sum(k % 2 == label for k in able))
    assert all(len(t) < 100 for t in learnt[0][0])


def test_toxicity_grams_are_of_characters():
    """Three characters of any script make one 3-gram; equal n-grams have equal hashes, others do not."""
    for text in ("abcd", "\u0436\u0437\u0438\u0439", "\u65e5\u672c\u8a9e\u6587", "\U0001F600\U0001F601ab"):
        assert [len(toxicity.grams(text, n)) for n in (3, 4, 5, 6, 7)] == [4, 3, 2, 1, 0]
    texts = ["the quick brown fox", "\u0436\u0437\u0438 the quick", "", None, "THE  quick\nbrown"]
    code_of = {}
    for text in texts:
        flat = f" {' '.join((text or '').lower().split())} "
        for n in toxicity.LENGTHS:
            want = [flat[k:k + n] for k in range(len(flat) - n + 1)]
            for gram, code in zip(want, toxicity.grams(text, n).tolist(), strict=True):
                assert code_of.setdefault(gram, code) == code
    assert len(set(code_of.values())) == len(code_of)


def test_license_base(llm, sf, odd_docs, no_docs):
    docs = llm.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in license_scan.scan(docs).collect():
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in texts[r.doc_id])
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(k, label) for p, label in license_scan.BASE.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        starts, labels = [k for k, _ in places], {x for _, x in places}
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            len(w), len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted(labels)) and labels <= set(filter(None, r.labels.split(",")))
    assert license_scan.scan(odd_docs).count() == 13 and license_scan.scan(no_docs).count() == 0


def test_license_edits():
    scan = license_scan.Scanner().scan
    for notice, label in license_scan.NOTICES.items():
        edits = min(len(notice) // license_scan.EDIT_EVERY, license_scan.EDITS_MOST)
        text = list(notice)
        for k in range(edits):  # spread substitutions away from blanks
            at = (k + 1) * len(text) // (edits + 1)
            while text[at] == " ":
                at += 1
            text[at] = "q"
        out = scan("some words " + "".join(text) + " more")
        assert label in out[5].split(",") and 0 < out[6] <= 1, notice
        found = [s for s in out[7] if s[0] == label]
        assert found and found[0][2] == 2
    assert scan("cc by cc by")[1:4] == (2, 0, 2)
    assert scan("nothing to see here, all right and reserved seats")[5] == ""
    assert scan(None) == (0, 0, None, None, "", "", 0.0, [])


def test_license_copies_side_by_side():
    """Exact and damaged copies of one notice without words between them: each has its place."""
    copies = ["gnu genral public license", "gnu genral public license", "gnu general public license",
              "gnu generl public license", "gnu general public license", "gnu generalx public licnse"]
    spans = license_scan.Scanner().scan(" ".join(copies))[7]
    assert [(s[1], s[2], s[3], s[4]) for s in spans] == [
        ("gnu general public license", 4 * k, 4, e) for k, e in enumerate([1, 1, 0, 1, 0, 2])]
    many = license_scan.Scanner().scan("al rights reserved the " * 300)[7]
    assert [(s[2], s[3], s[4]) for s in many] == [(4 * k, 3, 1) for k in range(300)]


def test_license_edits_rise_with_the_length():
    """Long notices may have one edit in eight characters too, and not one more."""
    notice = "redistribution and use in source and binary forms with or without modification"
    letters = [k for k, c in enumerate(notice) if c != " "]
    for edits, places in ((5, 1), (9, 1), (10, 0)):
        text = list(notice)
        for k in range(edits):
            text[letters[(2 * k + 1) * len(letters) // (2 * edits)]] = "q"
        spans = license_scan.Scanner().scan("so " + "".join(text) + " it is")[7]
        assert [(s[0], s[2], s[4]) for s in spans] == [("bsd", 1, edits)] * places


def test_every_language_is_learnt(llm):
    """More languages than LANGUAGES, and one whose texts are all long."""
    rows = [(70 * k + n, f"w{n}a w{n}b w{n}c", f"l{n:02}") for n in range(70) for k in range(3)]
    rows += [(10_000 + k, "long " * 5_000, "long") for k in range(3)]
    model = language.train(llm.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert set(model.languages) == {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 5}
    assert len(model.languages) > language.LANGUAGES and "long" in model.languages


def test_language_batches_equal_kernels(llm):
    """Scores of a batch are those of the definition: shared n-grams, landmark by landmark."""
    import numpy as np

    texts = ["der hund und die katze", "le chien et le chat", "the dog and the cat", "der und die und das", "ce n'est pas le chat"]
    model = language.Model(texts, ["de", "fr", "en", "de", "fr"], landmarks=5)
    asked = ["die katze", "x", "le chat and the dog " * 50]
    got = model.scores(asked)
    for text, shares in zip(asked, got):
        bins = language.present(text)
        value = sum(model.weights[b].astype(float) for b in bins) / np.sqrt(len(bins))
        power = np.exp(language.SHARPNESS * (value - value.max()))
        assert np.allclose(shares, power / power.sum(), atol=1e-9)


def test_language_choice_moves_no_text(llm):
    """Before the sample is chosen nothing but slim rows is dealt out."""
    rows = [(k, f"wort{k} " * 200, "de" if k % 3 else "fr") for k in range(300)] + [(7, "anders", "de")]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string, lang string")
    one, two = (language.train(docs.orderBy(F.rand(s))) for s in (1, 2))
    assert (one.weights == two.weights).all()


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_license_edits_equal_brute_force():
    """Random edits, at both ends and of blanks too: found where plain edit distances allow it, with as many edits."""
    import random

    draw, seen = random.Random(11), [0, 0]
    for _ in range(250):
        notice = draw.choice(list(license_scan.NOTICES))
        most, text = len(notice) // license_scan.EDIT_EVERY, list(notice)
        for _ in range(draw.randint(0, most + 2)):
            at, kind = draw.randrange(len(text)), draw.random()
            text[at:at + 1] = draw.choice("aex ") if kind < 0.4 else "" if kind < 0.7 else text[at] + draw.choice("aex ")
        words = f"so it {''.join(text)} is".split()
        least = min(_distance(notice, " ".join(words[a:b])) for a in range(len(words)) for b in range(a + 1, len(words) + 1))
        scanner = license_scan.Scanner(base={}, notices={notice: "own"})
        spans = scanner.scan(" ".join(words))[7]
        assert [s[4] for s in spans][:1] == ([least] if least <= most else []), (notice, words)
        for _, _, first, n, edits in spans:
            assert _distance(notice, " ".join(words[first:first + n])) == edits <= most
        seen[least <= most] += 1
    assert min(seen) > 20


def test_license_many_equal_notices_take_linear_time():
    from time import perf_counter

    scan = license_scan.Scanner().scan
    took = []
    for n in (1000, 4000):
        start = perf_counter()
        assert len([s for s in scan("permission is granted all rights reserved " * n)[7] if s[0] == "reserved"]) == n
        took.append(perf_counter() - start)
    assert took[1] < 10 * took[0]


def test_license_words_end_at_blanks_only():
    """A no-break space is part of a word; many notices in one text are counted in one pass."""
    scan = license_scan.Scanner().scan
    assert scan("x\u00a0al rights reserved y")[7] == []
    assert [s[2:] for s in scan("x\u00a0y al rights reserved z")[7]] == [(1, 3, 1)]
    n = 4000
    out = scan("cc by and all rights reserved so " * n)
    assert out[1:4] == (2 * n, 0, 7 * (n - 1) + 3)
    exact = [s[2] for s in out[7] if s[1] == "all rights reserved"]
    assert exact == [7 * k + 3 for k in range(n)]
