"""Column expressions: behaviours stated as small cases."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from firmfold.functions import classify as C
from firmfold.functions import contact as K
from firmfold.functions import identity as I
from firmfold.functions import score as Q
from firmfold.functions import text as T
from firmfold.functions.rules import DEFAULT_RULES, load_rules


def test_trim_takes_every_blank(apply):
    assert apply([" \t x　﻿", "\n", None], T.js_trim) == ["x", "", None]
    assert apply(["   ", " a "], T.blank_to_null) == [None, "a"]


def test_fold_equals_canonical_decomposition(apply):
    samples = ["Árvíztűrő TÜKÖRFÚRÓGÉP", "ÅNGSTRÖM é", "plain", "Ђ Ё й", "ß ø ł"]
    want = ["".join(c for c in unicodedata.normalize("NFD", s.lower()) if not 0x300 <= ord(c) <= 0x36F)
            for s in samples]
    assert apply(samples, T.fold_text) == want == [T.fold_str(s) for s in samples]


def test_entities_one_pass_each(apply):
    cases = {"a &amp;lt; b": "a &lt; b", "&#x41;&#66;": "AB", "&amp;#65;": "&#65;", "&#x26;#66;": "B",
             "&#xD800;&#1114112;&#99999999999999999999;": "&#xD800;&#1114112;&#99999999999999999999;",
             "&#128512;&#xFEFF;": "\U0001F600﻿", "&quot;&apos;&nbsp;|": "\"' |", "&copy;": "&copy;"}
    assert apply(list(cases), T.decode_entities) == list(cases.values())
    assert apply(["<p>a<br/>b &amp; <script>x</script></p>"], T.strip_tags) == ["a b & x"]


def test_email(apply):
    assert apply([" Info@X.hu ", "a@b", "a@@b.c", "a b@c.d", "x@y.z\n", "é@ő.hu", "a b@c.d", None, ""],
                 K.norm_email) == ["info@x.hu", None, None, None, "x@y.z", "é@ő.hu", None, None, None]


def test_phone(apply):
    assert apply(["06 30 111 2233", "0036 20 987 6543", "123", "+36 (1) 234-5678", "3612345678", "361234567",
                  "+36+1+2345678", "06+12345678", "+49 30 1234567", None],
                 K.norm_phone_hu) == ["+36301112233", "+36209876543", None, "+3612345678", "+3612345678", None,
                                      "+3612345678", "+36+12345678", None, None]


def test_domain(apply):
    cases = {"https://www.Pelda.hu/a?b#c": "pelda.hu", "pelda.hu": "pelda.hu", "localhost": None, "": None,
             "http://u:p@pelda.hu:8080": "pelda.hu", "ceg e.hu": None, "http:///pelda.hu": "pelda.hu",
             "pelda.hu?q": "pelda.hu", "www.hu": None, "a_b.hu": "a_b.hu", "http://pelda.hu:99999999": None,
             "https://Árvíztűrő.hu": "xn--rvztr-wqa0gx3bwi.hu", "mailto:x@pelda.hu": "pelda.hu",
             "ftp://pelda.hu": None}
    assert apply(list(cases), K.url_domain) == list(cases.values())


@pytest.mark.parametrize("host", ["bücher.ch", "пример.рф", "日本語.jp", "ünïcödé-ä.x.hu", "a.öäü.b", "ő.hu"])
def test_ascii_host_is_rfc_3492(apply, host):
    assert apply([host], K.url_domain) == [host.encode("idna").decode()]


def test_spellings_of_one_host_meet(apply):
    """Decomposed, full-width, half-width and oddly dotted spellings; sharp s and over-long labels stay themselves."""
    papa, long = "xn--ppa-ela.hu", "\u00e1" * 70
    cases = {"p\u00e1pa.hu": papa, "pa\u0301pa.hu": papa, "PA\u0301PA.hu": papa, "\uff50\u00e1\uff50\uff41.hu": papa,
             "p\u00e1pa\u3002hu": papa, "https://\uff57\uff57\uff57\uff0ep\u00e1pa\uff61hu/x": papa, "p\u00e1\u00adpa.hu": papa,
             "\uff50\uff45\uff4c\uff44\uff41.hu": "pelda.hu", "\uff57\uff57\uff57.hu": None,
             "p\uff05a.hu": None, "stra\u00dfe.de": "xn--strae-oqa.de",
             "vie\u0323\u0302t.vn": "vi\u1ec7t.vn".encode("idna").decode(), "\u30cf\u3099.jp": "\u30d0.jp".encode("idna").decode(),
             "\uff8a\uff9e.jp": "\u30d0.jp".encode("idna").decode(), f"{long}.hu": f"xn--{long.encode('punycode').decode()}.hu"}
    got = dict(zip(cases, apply(list(cases), K.url_domain)))
    assert got == cases


@pytest.mark.parametrize("seed", range(3))
def test_mapping_equals_the_normal_form(apply, seed):
    """Composed letters of small scripts, spelled apart, come together again."""
    import random
    import unicodedata

    draw = random.Random(seed)
    letters = [c for c in map(chr, range(0xE0, 0x1F00)) if c.islower() and unicodedata.normalize("NFKC", c) == c
               and len(unicodedata.normalize("NFD", c)) > 1]
    hosts = ["x" + "".join(draw.choice(letters) for _ in range(draw.randint(1, 6))) + ".hu" for _ in range(60)]
    want = [f"xn--{h[:-3].encode('punycode').decode()}.hu" for h in hosts]
    assert apply(hosts, K.url_domain) == want
    assert apply([unicodedata.normalize("NFD", h) for h in hosts], K.url_domain) == want


def test_contacts_in_first_seen_order(apply):
    html = "<p>B@x.hu, a@x.hu <b>b@X.hu</b></p><i>06 30/111-2233</i>; +36 1 234 5678 abc 06 30 111 2233 x 06 12"
    got, = apply([html], K.extract_contacts)
    assert got["emails"] == ["b@x.hu", "a@x.hu"] and got["phones"] == ["+36301112233", "+3612345678"]


def test_vat_checksum(apply):
    assert apply(["23456787", "23456787-2-41", "HU23456787", "23456788", "123", "1077338", None],
                 I.is_valid_hu_vat) == [True, True, True, False, False, False, False]
    assert apply(["23456787-2-41", "23456788"], I.vat_core) == ["23456787", None]
    assert apply(["02-09-345678", "12345678", None], I.is_valid_reg_number) == [True, False, False]


def test_company_name(apply):
    cases = {"Pék Kft.": "pék", "PÉK ZRT": "pék", "Kis Pál e.v.": "kis pál e v", "e.v.x Kft": "x",
             "Nagy egyéni vállalkozó": "nagy egyéni vállalkozó", "Nagy egyeni vallalkozo": "nagy",
             "öbt": "ö", "kftx": "kftx", " Több   szó, bt. ": "több szó", "Bt.kft.a": "a",
             "x szövetkezet": "x", "e.v.bt": "e v"}
    assert apply(list(cases), I.norm_company_name) == list(cases.values())
    assert apply([None], I.norm_company_name) == [""]


def test_key_ladder(spark):
    rows = [("23456787-2-41", "02-09-345678", "x.hu", "A Kft.", "pest"), ("23456788", "02-09-345678", "x.hu", "A", "pest"),
            (None, "12345678", "X.hu", "A", "pest"), (None, None, None, "Ábra Kft.", "pest"), (None, None, "", "Á", None)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                  "i int, v string, r string, d string, n string, g string")
    c = F.col
    keys = [r["k"] for r in frame.select("i", I.dedupe_key(c("v"), c("r"), c("d"), c("n"), c("g")).alias("k"))
            .orderBy("i").collect()]
    assert keys == ["vat:23456787", "reg:0209345678", "domain:x.hu", "name:ábra|pest", "name:á|"]


def test_personal(spark):
    rows = [("Nagy P. e.v.", None), ("X Kft.", "kis.pal@x.hu"), ("X Kft.", "info@x.hu"), ("X", "info.pal@x.hu"),
            ("Őstermelő Bt", None), ("X", "kispal@x.hu"), ("X", None)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, n string, e string")
    got = [r["p"] for r in frame.select("i", I.looks_personal(F.col("n"), F.col("e")).alias("p")).orderBy("i").collect()]
    assert got == [True, True, False, False, True, False, False]


def test_categories(apply):
    cases = {"Lépcsőház tisztítása hetente": ["cleaning"], "SZELLOZES tervezese": ["hvac"], "beléptetők, takarítók": ["cleaning", "security"],
             "cukrászda": [], "": [], "Britta Kapitány": [], "observers": [], "our server room": ["it-support"],
             "IT.": ["it-support"], "tűzoltó készülék, menekülési terv": ["fire-safety"], "üzemorvosi rendelés": ["occupational-safety"],
             "hűtéstechnika; security guard": ["hvac", "security"]}
    assert apply(list(cases), C.classify_text) == list(cases.values())
    assert apply([None], C.classify_text) == [[]]


def test_codes(apply):
    codes = [["90911200-8", "79710000-4"], ["72253000-3", "72000000-5"], ["15000000-8"], ["", "n/a", None], [],
             ["50312000-5", "75251000-0"], ["45331210-1"], ["42512000-8"], ["42520000-7", "30213100-6"], ["30200000-1"]]
    assert apply(codes, C.cpv_to_categories, "array<string>") == [
        ["cleaning", "security"], ["it-support"], [], [], [], ["it-support", "fire-safety"], ["hvac"], [], [], ["it-support"]]
    activities = [["81.29"], ["8020"], ["84.25"], ["6209"], ["6311"], ["35.30"], ["4711"], ["-"]]
    assert [x[0] if x else None for x in apply(activities, C.activity_to_categories, "array<string>")] == [
        "cleaning", "security", "fire-safety", "it-support", "it-support", "hvac", None, None]


def test_regions(apply):
    cases = {"1117 Bp., Duna sor 3": "budapest", "Pest megye és Budapest": "budapest", "2600 Vac": "pest",
             "Hatvan": "heves", "Kosice": None, "8900 Zalaegerszeg": "heves", "31000 Yy 1234": "budapest"}
    assert apply(list(cases) + [None], C.detect_region) == [*cases.values(), None]
    assert apply(["8900 Zalaegerszeg"], lambda c: C.detect_region(c, match="word")) == ["zala"]


def test_rules_from_tables(spark, apply):
    cats = spark.createDataFrame([("a", "A", 1, "Ál", False), ("b", "B", 2, "b c", True)],
                                 "category string, name string, ord int, keyword string, whole_word boolean")
    regions = spark.createDataFrame([("z", "Z", 2, "zet"), ("y", "Y", 1, "ze")],
                                    "region_id string, name string, ord int, keyword string")
    prefixes = spark.createDataFrame([("cpv", "9", "b", 1), ("cpv", "99", "nope", 2)],
                                     "scheme string, prefix string, category string, ord int")
    rules = load_rules(cats, regions, prefixes, capital="y")
    assert apply(["halál b c", "ab c"], lambda c: C.classify_text(c, rules)) == [["a", "b"], []]
    assert apply(["zet"], lambda c: C.detect_region(c, rules)) == ["y"]
    assert apply([["99"]], lambda c: C.cpv_to_categories(c, rules), "array<string>") == [["b"]]


def test_quality_score(spark):
    full = ("e", "p", "w", "d", "a", "r", ["c"], "23456787", "02-09-345678")
    rows = [full, (None,) * 6 + ([], None, None), (None,) * 6 + ([], "23456788", "02-09-345678"),
            (None, None, None, "d", None, None, ["c"], None, "1")]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                  "i int, email string, phone string, website string, domain string, address string, "
                                  "region_id string, categories array<string>, vat_number string, registration_number string")
    assert [r["s"] for r in frame.select("i", Q.score_of_row().alias("s")).orderBy("i").collect()] == [100, 0, 10, 25]


def test_reasons(spark):
    frame = spark.createDataFrame([(True, "CANCELLED", False), (False, "SUSPENDED", None), (False, "ACTIVE", True)],
                                  "p boolean, s string, d boolean")
    none = F.lit(None).cast("string")
    got = frame.select(
        Q.review_reasons(none, none, F.array().cast("array<string>"), F.lit(39), F.col("p")).alias("r"),
        Q.tax_risk_reasons(F.col("s"), F.col("d")).alias("t")).collect()
    assert got[0]["r"] == [Q.PERSONAL, Q.NO_CHANNEL, Q.UNCATEGORISED, Q.LOW] and len(got[1]["r"]) == 3
    assert [r["t"] for r in got] == [[Q.TAX_CANCELLED, Q.TAX_DEBT], [Q.TAX_SUSPENDED], []]


def test_purge_decision(spark):
    day = lambda s: f"timestamp'{s}'"
    rows = [("false", "true", "NEW", "2023-06-02 12:00:00"), ("false", "true", "NEW", "2023-06-02 12:00:00.001"),
            ("false", "true", "CONTACTED", "2020-01-01"), ("false", "false", "NEW", "2020-01-01"),
            ("true", "true", "NEW", "2020-01-01")]
    got = []
    for sup, personal, life, at in rows:
        expr = Q.purge_decision(F.expr(sup), F.expr(personal), F.lit(life), F.expr(day(at)),
                                F.expr(day("2024-06-01 12:00:00")), 365)
        got.append(spark.range(1).select(expr.alias("x")).first()["x"])
    assert got == ["PERSONAL_DATA_EXPIRED", None, None, None, "SUPPRESSED"]


def test_default_ids():
    assert DEFAULT_RULES.category_ids == ("cleaning", "hvac", "security", "occupational-safety", "fire-safety", "it-support")
    assert len(DEFAULT_RULES.regions) == 20
