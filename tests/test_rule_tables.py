"""Rules by join give what the same rules give as expressions."""

import re

import pytest
from pyspark.sql import functions as F

from firmfold.functions import classify as C
from firmfold.functions.rules import DEFAULT_RULES, PrefixRule, load_rules
from firmfold.functions.text import fold_text
from firmfold.operators.govern import recategorize
from firmfold.operators.normalize import normalize_businesses
from firmfold.operators import rule_tables
from firmfold.operators.rule_tables import RuleTables, classify_by_rules, codes_by_rules, regions_by_rules
from firmfold.schemas import LEAD, RAW

CATEGORY_RULES = "category string, name string, ord int, keyword string, whole_word boolean"
REGION_RULES = "region_id string, name string, ord int, keyword string"

TEXTS = ["Irodatakarítás", "clean", "cleaning-service", "unclean", "IT support & co", "bit it.", "Microsoft  365", "microsoft 365!",
         "air condition", "air conditioning", "hair condition", "a&b c++ d", "R&D", "", None, "x" * 5000 + " takarit", "é", "KLÍMA és őrzés",
         "1051 Budapest", "9021 GYŐR", "Vác, Fő u. 1", "ab  abc abcd", "tűzjelző", "co-op", "coop", "clean", "日本語 clean"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, text string")


def default_tables(spark):
    cats, n = [], 0
    for c in DEFAULT_RULES.categories:
        for words, whole in ((c.stems, False), (c.words, True)):
            for w in words:
                n += 1
                cats.append((c.id, c.name, n, w, whole))
    regions = [(r.id, r.name, 100 * a + b, k) for a, r in enumerate(DEFAULT_RULES.regions) for b, k in enumerate(r.keywords)]
    return RuleTables(spark.createDataFrame(cats, CATEGORY_RULES), spark.createDataFrame(regions, REGION_RULES))


def odd_tables(spark):
    cats = [("z", "Z", 1, "&", False), ("y", "Y", 2, "c++", True), ("x", "X", 3, "R&D", True), ("w", "W", 4, "b", False),
            ("v", "V", 5, "clean", True), ("u", "U", 6, " ", False), ("t", "T", 7, "ab  abc", False), ("s", "S", 8, "abc abcd", True),
            ("r", "R", 9, "no such stem", False), ("q", "Q", 10, "É", True), ("p", "P", 11, "co-op", True), ("o", "O", 12, "o-o", False),
            ("z", "Z2", 13, "clean", True), ("n", "N", 14, "語", True), ("m", "M", 15, "本", False), ("l", "L", 16, None, True)]
    return RuleTables(spark.createDataFrame(cats, CATEGORY_RULES), spark.createDataFrame([], REGION_RULES))


def test_default_rules_by_join(spark, texts):
    tables = default_tables(spark)
    want = texts.select("i", C.classify_text(F.col("text")).alias("c"), C.detect_region(F.col("text")).alias("r")).orderBy("i").collect()
    got = classify_by_rules(texts, tables, fold_text(F.col("text")), "c")
    got = regions_by_rules(got, tables, fold_text(F.col("text")), "r").select("i", "c", "r").orderBy("i").collect()
    assert got == want


def test_odd_keywords_by_join(spark, texts):
    tables = odd_tables(spark)
    rules = load_rules(tables.categories.filter("keyword is not null"), tables.regions)
    want = texts.select("i", C.classify_text(F.col("text"), rules).alias("c")).orderBy("i").collect()
    got = classify_by_rules(texts, tables, fold_text(F.col("text")), "c").select("i", "c").orderBy("i").collect()
    assert got == want and any("z" in r["c"] for r in got) and any("m" in r["c"] for r in got)


def test_no_rules_no_rows(spark, texts):
    none = RuleTables(spark.createDataFrame([], CATEGORY_RULES), spark.createDataFrame([], REGION_RULES))
    hay = fold_text(F.col("text"))
    assert {tuple(r["c"]) for r in classify_by_rules(texts, none, hay, "c").collect()} == {()}
    assert {r["r"] for r in regions_by_rules(texts, none, hay, "r").collect()} == {"budapest", None}  # by postcode
    assert classify_by_rules(texts.filter("false"), default_tables(spark), hay, "c").count() == 0


def test_codes_by_join(spark):
    rules = [("0", "small"), ("02", "mid"), ("1", "large"), ("", "any"), ("10", "large"), ("08", "unlisted"), ("12345", "far"), ("02", "small")]
    prefixes = spark.createDataFrame([(p, c, i) for i, (p, c) in enumerate(rules)], "prefix string, category string, ord int")
    known = spark.createDataFrame([(c,) for c in ("small", "mid", "large", "any", "far")], "category string")
    lists = [["02.1", "1"], ["1", "0-2"], [], None, [None, "x"], ["1234567"], ["0812", "0812"], ["10", "10", None]]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(lists)] * 2, "i int, codes array<string>")
    usable = tuple(PrefixRule(p, c) for p, c in rules)
    want = rows.select("i", C.classify_by_prefix(F.col("codes"), 4, usable, ("small", "mid", "large", "any", "far")).alias("c"))
    got = codes_by_rules(rows, prefixes, known, F.col("codes"), 4, "c").select("i", "c")
    assert sorted(map(tuple, map(lambda r: (r[0], tuple(r[1])), got.collect()))) == sorted((r[0], tuple(r[1])) for r in want.collect())


def test_jobs_take_rule_tables(spark):
    tables = default_tables(spark)
    raw = spark.createDataFrame([("Klíma Kft.", "9021 Győr", ["given"]), ("Őrzés Bt.", "1117 Bp.", None), (None, None, None)],
                                "legal_name string, address string, categories array<string>")
    raw = raw.select(*[F.col(n) if n in raw.columns else F.lit(None).cast(t).alias(n) for n, t in RAW.items()])
    assert sorted(normalize_businesses(raw, tables).collect(), key=str) == sorted(normalize_businesses(raw).collect(), key=str)
    lead = spark.createDataFrame([("a", "klíma"), ("b", None)], "lead_id string, classification_text string")
    lead = lead.select(*[F.col(n) if n in lead.columns else F.lit(None).cast(t).alias(n) for n, t in (c.split() for c in LEAD.split(","))])
    assert recategorize(lead, tables).select("lead_id", "categories").orderBy("lead_id").collect() == recategorize(
        lead).select("lead_id", "categories").orderBy("lead_id").collect()


def test_no_rule_is_collected(spark, texts, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Frame
    monkeypatch.setattr(Frame, "collect", lambda self: pytest.fail("rules went through the driver"))
    frame = classify_by_rules(texts, default_tables(spark), fold_text(F.col("text")), "c")
    assert "c" in frame.columns


def large_broadcasts(frame):
    """Hashed broadcasts of sides that take lists apart or group what was taken apart."""
    lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    found = []
    for i, line in enumerate(lines):
        if "BroadcastExchange HashedRelation" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            under = []
            for x in lines[i + 1:]:
                if len(x) - len(x.lstrip(" :+-")) <= depth:
                    break
                under.append(x)
            found += [line] if any("Generate" in x for x in under) else []
    return found


def test_no_growing_side_is_broadcast(spark, texts):
    """Small as the tables are here: their files say little about what is made of them."""
    hay, tables = fold_text(F.col("text")), default_tables(spark)
    assert large_broadcasts(classify_by_rules(texts, tables, hay, "c")) == []
    assert large_broadcasts(regions_by_rules(texts, tables, hay, "r")) == []
    prefixes = spark.createDataFrame([("0", "small", 1)], "prefix string, category string, ord int")
    rows = spark.createDataFrame([(1, ["02"])], "i int, codes array<string>")
    assert large_broadcasts(codes_by_rules(rows, prefixes, None, F.col("codes"), 4, "c")) == []


def test_stems_around_the_length_of_runs(spark):
    """Stems as long as a run, longer and shorter; one keyword of several ids; an id found by several keywords."""
    stems = ["abcdefgh", "abcdefghi", "bcdefghijk", "h", "hij", "zzzzzzzzz", "abcdefgi", "hij"]
    cats = [(f"c{i % 5}", "n", i, w, False) for i, w in enumerate(stems)] + [("c9", "n", None, "hij", False)]
    tables = RuleTables(spark.createDataFrame(cats, CATEGORY_RULES), spark.createDataFrame([], REGION_RULES))
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["xabcdefghijkl", "abcdefgh", "hi", "zzzzzzzz", "ijh"])], "i int, text string")
    place = {c: min((o for d, _, o, *_ in cats if d == c and o is not None), default=-1) for c, *_ in cats}
    got = classify_by_rules(rows, tables, fold_text(F.col("text")), "c")
    for r in got.collect():
        want = {c for c, _, _, w, _ in cats if w in r["text"]}
        assert r["c"] == sorted(want, key=lambda c: (place[c], c)), r


def shuffled_bytes(frame):
    """Bytes of all rows that a run of the frame hands to its shuffles, before they are compressed."""
    frame.collect()
    plans, found, seen = [frame._jdf.queryExecution().executedPlan()], 0, set()
    while plans:
        plan = plans.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            plans.append(plan.plan())
        elif kind != "ReusedExchangeExec":
            if kind == "ShuffleExchangeExec" and plan.id() not in seen:
                seen.add(plan.id())
                found += plan.metrics().apply("dataSize").value()
            plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return found


def codes_by_hand(lists, rules, known, digits):
    """Every code's hits in order of (ord, category), nulls first; each category once."""
    best = {}
    for p, c, o in rules:
        if p is not None and (known is None or c in known):
            have = best.get((p, c))
            best[p, c] = o if have is None else have if o is None else min(o, have)
    rank = lambda x: (x is not None, x if x is not None else 0)
    out = []
    for codes in lists:
        got = []
        for code in codes or []:
            n = "".join(x for x in code or "" if x in "0123456789")[:digits] if code is not None else None
            hits = [] if n is None else [(o, c) for (p, c), o in best.items() if n.startswith(p) and len(p) <= digits]
            got += [c for _, c in sorted(hits, key=lambda h: (rank(h[0]), (h[1] is not None, h[1] or "")))]
        out.append(list(dict.fromkeys(got)))
    return out


@pytest.mark.parametrize("digits,units,known", [(8, None, None), (8, 3, True), (11, 3, None), (5, None, True), (3, None, True)])
def test_codes_of_any_length(spark, monkeypatch, digits, units, known):
    """More categories than one character tells apart, several heads above each other, null ranks and categories."""
    if units:
        monkeypatch.setattr(rule_tables, "UNITS", units)
    numbers = [str((i * 7919 + 13) % 10 ** (1 + i % 11)).zfill(1 + i % 11) for i in range(150)] + [""]
    rules = [(n[:k], f"c{(i + k) % 8}", None if (i + k) % 9 == 0 else (i * 37 + k) % 50)
             for i, n in enumerate(numbers) for k in (0, 1, 2, 4, 5, 7, 8, 9, 11) if (i + k) % 3 and (k or i < 4)]
    rules += [("1", None, 4), (None, "c1", 1), ("12x", "c2", 0), ("1\n", "c3", 0), ("4", "c4", None), ("4", "c4", 3)]
    lists = [[numbers[i], numbers[(i * 7) % 151], numbers[i]] for i in range(151)] + [None, [], [None, "1-2.3"]]
    wanted = [None, "c1", "c2", "c3", "c4", "c5", "none"] if known else None
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, codes array<string>")
    table = spark.createDataFrame(rules, "prefix string, category string, ord int")
    listed = spark.createDataFrame([(c,) for c in wanted], "category string") if known else None
    got = codes_by_rules(rows, table, listed, F.col("codes"), digits, "c").select("i", "c").orderBy("i").collect()
    assert [r["c"] for r in got] == codes_by_hand(lists, rules, wanted and {c for c in wanted if c}, digits)
    assert codes_by_rules(rows, table.filter("false"), None, F.col("codes"), digits, "c").filter("size(c) > 0").count() == 0


def test_codes_ship_no_lists_of_rules(spark):
    """Numbers that share prefixes of many categories: the lists stay with the prefixes."""
    rules = spark.range(10 * 60).selectExpr("repeat(cast(id % 10 as string), 3) prefix", "concat('category ', id div 10) category", "cast(id * 7 % 601 as int) ord")
    rows = spark.range(9000).selectExpr("id i", "array(concat(repeat(cast(id % 10 as string), 4), lpad(id, 4, '0'))) codes")
    frame = codes_by_rules(rows, rules, None, F.col("codes"), 8)
    assert shuffled_bytes(frame) < 9_000 * 500
    assert {len(r["categories"]) for r in frame.collect()} == {60}


def test_more_groups_than_a_row_of_bits_holds(spark):
    """600 groups of 550 ids, some without a place; stems, long stems, words and keywords of two parts."""
    words = [f"k{i}" for i in range(40)] + [f"long stem {i}" for i in range(5)] + [f"abcdefgh{i}" for i in range(40)] + ["&", "c++"]
    cats = [(f"c{i % 550}", f"n{i}", None if i % 11 == 0 else (i * 389) % 601, words[i % len(words)], i % 4 == 0) for i in range(600)]
    cats += [("c3", "n3", 1000, words[1], False), (None, "n", 1, "k1", False), ("c4", None, 1, "k1", False), ("c5", "n5", 5, "k7", None)]
    tables = RuleTables(spark.createDataFrame(cats, CATEGORY_RULES), spark.createDataFrame(
        [(c, n, o, k) for c, n, o, k, _ in cats], REGION_RULES), capital="c77")
    texts = ["k1 k22x", "xabcdefgh1", "abcdefgh23 c++", "a long stem 3", "k7&k8", "", "none", " ".join(words), " ".join(words[:30])] * 2
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    place = {}
    for c, n, o, _, _ in cats:
        if c is not None and n is not None:
            have = place.get((c, n))
            place[c, n] = o if have is None else have if o is None else min(have, o)

    def by_hand(text, stems):
        hit = {}
        for c, n, _, k, whole in cats:
            inside = k in text and (stems or not whole or bool(re.search(rf"(?<![a-z0-9]){re.escape(k)}(?![a-z0-9])", text)))
            if (c, n) in place and (stems or whole is not None) and inside:
                hit.setdefault(c, []).append(place[c, n])
        order = {c: min((p for p in ps if p is not None), default=-1) for c, ps in hit.items()}
        return sorted(order, key=lambda c: (order[c], c))

    got = classify_by_rules(rows, tables, fold_text(F.col("text")), "c")
    got = regions_by_rules(got, tables, fold_text(F.col("text")), "r").orderBy("i").collect()
    for r in got:
        assert r["c"] == by_hand(r["text"], False), r["text"]
        ids = by_hand(r["text"], True)
        assert r["r"] == ("c77" if "c77" in ids else ids[0] if ids else None), r["text"]
    assert max(len(r["c"]) for r in got) > 500


def test_texts_ship_no_lists_of_rules(spark):
    """Texts that hold many keywords of many categories: what travels is unions."""
    rules = spark.range(300 * 60).selectExpr("concat('category ', id div 300) category", "'n' name", "cast(id as int) ord",
                                             "concat('s', lpad(id % 300, 3, '0')) keyword", "false whole_word")
    rows = spark.range(1500).selectExpr("id i", "array_join(transform(sequence(0, 11), j -> concat('s', lpad((id * 7 + j * 23) % 300, 3, '0'))), '') text")
    frame = classify_by_rules(rows, RuleTables(rules, spark.createDataFrame([], REGION_RULES)), F.col("text"))
    assert shuffled_bytes(frame) < 5_000_000
    assert {len(r["categories"]) for r in frame.collect()} == {60}


def test_hot_tokens_can_be_split(spark, texts):
    """A token that stands in most texts: AQE splits a join only where both of its sides come from a shuffle of its own."""
    plans, sides = [classify_by_rules(texts, default_tables(spark), F.col("text"))._jdf.queryExecution().executedPlan()], []
    while plans:
        plan = plans.pop()
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        children = [plan.children().apply(i) for i in range(plan.children().size())]
        if plan.getClass().getSimpleName() == "SortMergeJoinExec" and "_t1" in plan.leftKeys().toString():
            sides += [c.children().apply(0).getClass().getSimpleName() for c in children]
        plans += children
    assert len(sides) == 4 and set(sides) == {"ShuffleExchangeExec"}
