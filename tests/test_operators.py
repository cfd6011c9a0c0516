"""Operators on small frames: order, skew, and the rules of the merge."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from firmfold.operators import consolidate as M
from firmfold.operators import enrich as E
from firmfold.operators import govern as G
from firmfold.operators import pages as P
from firmfold.operators import suppress as U
from firmfold.sources.contact_pages import merge_contact_pages
from firmfold.sources.lookups import parse_places, parse_tax_signals, parse_vat_register
from firmfold.sources.pages import explode_records, latest_pages, parse_pages, row_counts
from firmfold.sources.registry import SourceSpec, get_source, list_sources, register
from firmfold.schemas import RAW_PAGES
from tests import fixture_pages as X

IDS = ("a", "b", "c")
BATCH = ("dedupe_key string, seq int, legal_name string, source string, source_url string, source_license string, "
         + ", ".join(f"{g} string" for g in M.GAPS)
         + ", classification_text string, categories array<string>, is_personal_data boolean")


def now():
    return F.lit(datetime(2024, 6, 1))


def _fold(rows):
    """The merge as a loop over records in order of arrival."""
    out = {}
    for r in sorted(rows, key=lambda r: r[1]):
        key = r[0]
        gaps, text, cats, flag = list(r[6:6 + len(M.GAPS)]), r[-3], list(r[-2]), r[-1]
        if key not in out:
            out[key] = [r[2:6], gaps, text, cats, flag, 1]
            continue
        o = out[key]
        o[1] = [x if x is not None else y for x, y in zip(o[1], gaps)]
        if len(text or "") > len(o[2] or ""):
            o[2] = text
        o[3] = list(dict.fromkeys(o[3] + cats))
        o[4] = o[4] or flag
        o[5] += 1
    return out


def _rows(n, keys, seed):
    rnd = random.Random(seed)
    pick = lambda: rnd.choice([None, None, f"v{rnd.randint(0, 9)}"])
    return [(rnd.choice(keys), i, f"n{i}", f"s{i}", None if i % 3 else f"u{i}", "l", *[pick() for _ in M.GAPS],
             rnd.choice([None, "t" * rnd.randint(1, 5), f"text{rnd.randint(0, 9)}"]),
             rnd.sample(["a", "b", "c", "z"], rnd.randint(0, 3)), rnd.random() < 0.1) for i in range(n)]


def _merge(df):
    return {r["dedupe_key"]: r for r in M.dedupe_batch(df, IDS).collect()}


def test_merge_equals_the_fold_in_any_partitioning(spark):
    # One key holds a third of all rows.
    rows = _rows(600, ["hot"] * 10 + [f"k{i}" for i in range(20)], 1)
    want = _fold(rows)
    df = spark.createDataFrame(rows, BATCH)
    for parts in (1, 7):
        got = _merge(df.repartition(parts))
        assert set(got) == set(want)
        for key, (identity, gaps, text, cats, flag, count) in want.items():
            g = got[key]
            assert tuple(g[c] for c in M.IDENTITY) == identity
            assert [g[c] for c in M.GAPS] == gaps
            assert (g["classification_text"], g["is_personal_data"], g["input_count"]) == (text, flag, count)
            assert g["categories"] == cats  # all ids by first appearance, those outside the rule set too


def test_upsert_equals_one_fold(spark):
    rows = _rows(300, [f"k{i}" for i in range(40)], 2)
    rows = [r[:-2] + ([c for c in r[-2] if c in IDS], r[-1]) for r in rows]
    first, second = rows[:120], rows[120:]
    batch = lambda r: M.dedupe_batch(spark.createDataFrame(r, BATCH), IDS)
    lead = M.upsert_lead(spark.createDataFrame([], M.LEAD), batch(first), now())
    out = {r["dedupe_key"]: r for r in M.upsert_lead(lead, batch(second), now()).collect()}
    want = _fold(rows)
    assert set(out) == set(want)
    for key, (identity, gaps, text, cats, flag, _) in want.items():
        g = out[key]
        assert tuple(g[c] for c in M.IDENTITY) == identity and [g[c] for c in M.GAPS] == gaps
        assert (g["classification_text"], g["categories"], g["is_personal_data"]) == (text, cats, flag)
        assert (g["lifecycle"], g["review_status"], g["gdpr_basis"]) == ("NEW", "PENDING", "legitimate_interest")


def test_merge_aggregates_before_the_shuffle(spark):
    df = spark.createDataFrame(_rows(10, ["k"], 3), BATCH)
    plan = M.dedupe_batch(df, IDS)._jdf.queryExecution().executedPlan().toString()
    # The records are dealt out once; ids outside the rule set are, by key and id and then by key.
    assert plan.count("Exchange hashpartitioning") == 3 and "partial_min" in plan and "collect_set" not in plan


def test_a_key_with_very_many_lists(spark):
    """Lists of one key are summed up where they are read; none is gathered."""
    n = 200_000
    rows = spark.range(n).select(
        F.lit("k").alias("dedupe_key"), F.col("id").alias("seq"),
        *[F.lit("x" if c in ("legal_name", "source") else None).cast("string").alias(c) for c in (*M.IDENTITY, *M.GAPS, "classification_text")],
        F.array(F.concat(F.lit("o"), ((F.col("id") * 7 + 3) % 50).cast("string")), F.lit("a")).alias("categories"),
        F.lit(False).alias("is_personal_data"))
    one, = M.dedupe_batch(rows, ("a",)).collect()
    assert one["input_count"] == n and one["categories"][:3] == ["o3", "a", "o10"] and len(one["categories"]) == 51


COUNTS = "source string, region_id string, page int, n_rows int, malformed boolean"


@pytest.mark.parametrize("pages, start, cap, last, failed", [
    ([(1, 2), (2, 1), (3, 0), (4, 5)], 1, 50, 2, False),       # stops at an empty page
    ([(1, 2), (3, 1)], 1, 50, 1, False),                      # or at a missing one
    ([(2, 2), (3, 1)], 1, 50, 0, False),                      # nothing at the start
    ([(1, 1), (2, 1), (3, 1)], 2, 50, 3, False),              # last page is absolute
    ([(1, 1), (2, 1), (3, 1)], 1, 2, 2, False),               # page cap
    ([(p, 1) for p in range(1, 61)], 1, None, 60, False),     # none unless asked for
    ([], 4, 50, 3, False),
    ([(1, 1), (2, None), (3, 1)], 1, 50, 1, True),            # the run hits a bad page
    ([(1, 1), (2, 0), (3, None)], 1, 50, 1, False),           # a bad page behind the end
])
def test_page_prefix(spark, pages, start, cap, last, failed):
    counts = spark.createDataFrame([("s", "r", p, n or 0, n is None) for p, n in pages], COUNTS)
    starts = spark.createDataFrame([("s", "r", start)], "source string, region_id string, start_page int")
    row = P.page_prefix(counts, starts, cap).first()
    assert (row["last_page"], row["failed"]) == (last, failed)


def test_cursors(spark):
    state = spark.createDataFrame([("s", "a", 3, 10), ("s", "b", 0, 0)],
                                  "source string, region_id string, last_page int, total_seen bigint").withColumn(
        "last_run_at", F.lit(None).cast("timestamp"))
    wanted = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "c")], "source string, region_id string")
    start = lambda full: [r["start_page"] for r in P.resume_cursor(wanted, state, full).orderBy("region_id").collect()]
    assert start(False) == [3, 1, 1] and start(True) == [1, 1, 1]
    seen = spark.createDataFrame([("s", "a", 2, 5), ("s", "c", 7, 1)],
                                 "source string, region_id string, last_page int, n_seen int")
    got = {r["region_id"]: (r["last_page"], r["total_seen"]) for r in P.save_cursor(state, seen, now()).collect()}
    assert got == {"a": (3, 15), "b": (0, 0), "c": (7, 1)}


def test_parsers_and_limit(spark):
    pages = spark.createDataFrame(X.ALL, RAW_PAGES)
    parsed = parse_pages(pages, get_source("directory"))
    rows = explode_records(parsed).orderBy("crawl_region", "page", "pos").collect()
    assert [r["legal_name"] for r in rows] == ["Kék Klíma Kft.", "Fényes Iroda Bt.", "Tiltott Kft.", "Gödöllői Szerver Kft."]
    assert rows[0]["source_url"].endswith("/biz/7") and rows[1]["source_url"].endswith("example")
    assert rows[0]["classification_text"] == "klíma szerelés Kék Klíma Kft." and rows[0]["pos"] == 0
    cut = explode_records(P.record_limit(parsed, row_counts(parsed), {"directory": 2}))
    assert sorted(r["legal_name"] for r in cut.collect()) == ["Fényes Iroda Bt.", "Gödöllői Szerver Kft.", "Kék Klíma Kft."]

    listing = explode_records(parse_pages(pages, get_source("htmldir"))).orderBy("pos").collect()
    assert [r["legal_name"] for r in listing] == ["Tűz & Társa Kft.", "Második Kft."]
    assert (listing[0]["email"], listing[0]["website"], listing[0]["phone"], listing[0]["address"]) == (
        "iroda@tuztarsa.hu", "https://tuztarsa.hu", "06 20 333 4444", "1111 Budapest")
    assert listing[0]["source_url"].endswith("/biz/a1") and listing[1]["email"] == "b@masodik.hu"

    poi = explode_records(parse_pages(pages, get_source("overpass"))).orderBy("pos").collect()
    assert [(r["legal_name"], r["brand_name"]) for r in poi] == [("Kék Klíma", "Kék Csoport"), ("Magányos Bolt", None)]
    assert poi[0]["vat_number"] == "23456787" and poi[0]["address"] == "Budapest, Váci út"
    assert poi[1]["classification_text"] == "it Magányos Bolt" and poi[1]["source_url"].endswith("/way/12")

    trader, = explode_records(parse_pages(pages, get_source("evny"))).collect()
    assert trader["is_personal_data"] and trader["categories"] == ["cleaning"]
    award, = explode_records(parse_pages(pages, get_source("kozbeszerzes"))).collect()
    assert award["categories"] == ["cleaning"] and award["email"] is None


def test_newest_copy_of_a_page(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 2, 1)
    pages = spark.createDataFrame([("s", "r", 1, "old", old), ("s", "r", 1, "new", new)], RAW_PAGES)
    assert [r["body"] for r in latest_pages(pages).collect()] == ["new"]


def test_a_new_source_is_only_a_spec(spark):
    spec = register(SourceSpec("mine", "own", "https://mine.example", get_source("directory").parse))
    try:
        page = spark.createDataFrame([X.page("mine", "pest", 1, X.results({"id": 1, "name": "Új Kft."}))], RAW_PAGES)
        row, = explode_records(parse_pages(page, spec)).collect()
        assert (row["source"], row["source_url"], row["source_license"]) == ("mine", "https://mine.example/biz/1", "own")
        assert list_sources()[-1] is spec
    finally:
        from firmfold.sources import registry
        registry._REGISTRY.pop("mine")


def test_lookup_answers(spark):
    answers = lambda *bodies: spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "key string, body string")
    vat = parse_vat_register(answers('{"valid":true,"name":" A  B ","address":"---"}', '{"valid":"true"}', "nope")).orderBy("core").collect()
    assert [(r["valid"], r["name"], r["address"]) for r in vat] == [(True, "A B", None), (False, None, None), (False, None, None)]
    tax = parse_tax_signals(answers(
        '{"taxStatus":" active ","debtFree":true,"employeeCount":7.9}', '{"taxStatus":"x","debtFree":"true"}',
        '{"employeeCount":null}', '{"employeeCount":-1}', '{"employeeCount":"12"}', '{"employeeCount":"many"}')).orderBy("core").collect()
    assert [r["tax_status"] for r in tax[:2]] == ["ACTIVE", "UNKNOWN"] and [r["debt_free"] for r in tax[:2]] == [True, None]
    assert [r["employee_count"] for r in tax] == [7, None, 0, None, 12, None]
    place, = parse_places(answers('{"phone":" ","formatted_phone_number":" 1 ","websiteUri":"w","address":5}')).collect()
    assert (place["phone"], place["website"], place["address"]) == ("1", "w", None)


def test_contact_pages_stop_at_the_first_address(spark):
    at = datetime(2024, 1, 1)
    pages = spark.createDataFrame(
        [("x.hu", "", "06 30 111 2233", at), ("x.hu", "/impresszum", "b@x.hu 06 30 111 2244", at),
         ("x.hu", "/contact", "c@x.hu", at), ("x.hu", "/other", "d@x.hu", at),
         ("y.hu", "/kapcsolat", "old@y.hu", at), ("y.hu", "/kapcsolat", "new@y.hu", datetime(2024, 2, 1))],
        "domain string, path string, body string, fetched_at timestamp")
    got = {r["domain"]: (r["emails"], r["phones"]) for r in merge_contact_pages(pages).collect()}
    assert got == {"x.hu": (["b@x.hu"], ["+36301112233", "+36301112244"]), "y.hu": (["new@y.hu"], [])}


def test_suppression(spark):
    listed = spark.createDataFrame([("x.hu", "DOMAIN"), ("a@y.hu", "EMAIL"), ("z.hu", "EMAIL")], "value string, kind string")
    rows = spark.createDataFrame([(1, "a@x.hu", None), (2, "A@y.hu ", None), (3, "b@y.hu", "X.hu"), (4, "b@y.hu", None),
                                  (5, None, None), (6, None, "z.hu")], "i int, email string, domain string")
    assert sorted(r["i"] for r in U.anti_suppressed(rows, listed).collect()) == [4, 5]
    flags = U.flag_suppressed(rows, listed)
    assert sorted(r["i"] for r in flags.filter("suppressed").collect()) == [1, 2, 3, 6] and flags.count() == 6
    assert sorted(r["i"] for r in U.is_suppressed(rows, listed).collect()) == [1, 2]
    assert sorted(r["i"] for r in U.is_domain_suppressed(rows, listed).collect()) == [3]
    plan = U.anti_suppressed(rows, listed)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_add_suppression(spark):
    held = spark.createDataFrame([("x.hu", "DOMAIN", "old", datetime(2020, 1, 1))],
                                 "value string, kind string, reason string, created_at timestamp")
    new = spark.createDataFrame([("https://www.X.hu/a", None, "newer", 1), (" A@B.hu ", None, None, 2), ("x.hu", "EMAIL", "newest", 3)],
                                "value string, kind string, reason string, ord int")
    got = {r["value"]: r for r in U.add_suppression(held, new, now()).collect()}
    assert set(got) == {"x.hu", "a@b.hu"}
    assert (got["x.hu"]["kind"], got["x.hu"]["reason"], got["x.hu"]["created_at"].year) == ("DOMAIN", "newest", 2020)
    assert (got["a@b.hu"]["kind"], got["a@b.hu"]["reason"]) == ("EMAIL", "manual")


def test_access_report_has_one_shape(spark, tmp_path):
    lead = spark.createDataFrame([("l1", "k1", "a@x.hu"), ("l2", "k2", "a@x.hu")], "lead_id string, dedupe_key string, email string")
    for name, type_ in (p.split() for p in M.LEAD.split(",")):
        if name not in lead.columns:
            lead = lead.withColumn(name, F.lit(None).cast(type_))
    events = spark.range(30).select(
        F.concat(F.lit("e"), F.col("id")).alias("event_id"), F.when(F.col("id") < 25, "l1").otherwise("l2").alias("lead_id"),
        F.lit("MERGED").alias("type"), F.lit("{}").alias("meta"), F.timestamp_seconds(1000 - F.col("id")).alias("created_at"))
    report = G.dsar_export(lead, events, spark.createDataFrame([("A@x.hu",)], "email string"))
    docs = {r["lead_id"]: r["trail_events"] for r in G.dsar_documents(report).collect()}
    assert docs == {"l1": 25, "l2": 5}
    G.write_dsar_report(report, str(tmp_path / "r"), now())
    trail = spark.read.json(str(tmp_path / "r" / "trail")).collect()
    times = [(r["lead_id"], r["created_at"]) for r in trail]
    assert len(times) == 30 and times == sorted(times)
    subject, = spark.read.json(str(tmp_path / "r" / "subjects")).collect()
    assert (subject["subject"], subject["lead_count"], subject["generated_at"]) == ("a@x.hu", 2, "2024-06-01T00:00:00.000Z")


def test_access_report_derives_its_trail_once(spark, tmp_path, monkeypatch):
    """Only the trail's own folder is written from the events; the counts are those of its lines."""
    from pyspark.sql.readwriter import DataFrameWriter
    types = ["subject", "lead_id", "type", "meta", "created_at", "at", "event_id"]
    spark.createDataFrame([("a@x.hu", f"l{i % 3}", "MERGED", "{}", "t", i, f"e{i}") for i in range(7)],
                          ", ".join(f"{n} {'int' if n == 'at' else 'string'}" for n in types)).write.parquet(str(tmp_path / "events"))
    records = spark.createDataFrame([("a@x.hu", f"l{i}") for i in range(4)], "subject string, lead_id string")
    json, read = DataFrameWriter.json, {}

    def spied(self, path, *args, **kw):
        read[path.rsplit("/", 1)[1]] = any("/events/" in f for f in self._df.inputFiles())
        return json(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "json", spied)
    G.write_dsar_report(G.AccessReport(records, spark.read.parquet(str(tmp_path / "events"))), str(tmp_path / "r"), now())
    assert read == {"trail": True, "records": False, "subjects": False}
    counts = {r["lead_id"]: r["trail_events"] for r in spark.read.json(str(tmp_path / "r" / "records")).collect()}
    assert counts == {"l0": 3, "l1": 2, "l2": 2, "l3": 0}
    subject, = spark.read.json(str(tmp_path / "r" / "subjects")).collect()
    assert (subject["subject"], subject["lead_count"]) == ("a@x.hu", 4)


def test_region_expand():
    assert P.region_expand(" pest, zala,") == ["pest", "zala"] and len(P.region_expand("all")) == 20
    with pytest.raises(ValueError):
        P.region_expand(None)


def test_a_hot_lookup_key_is_split(spark):
    """A third of all leads on one site, a lookup too large to broadcast."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 6000
        base = spark.range(0, n, 1, 8).select(
            F.col("id").cast("string").alias("lead_id"), F.concat(F.lit("k"), F.col("id")).alias("dedupe_key"),
            F.when(F.col("id") % 3 == 0, "hot.hu").otherwise(F.concat(F.lit("d"), F.col("id"))).alias("domain"),
            F.sha2(F.col("id").cast("string"), 512).alias("address"))
        types = dict(p.split() for p in M.LEAD.split(","))
        lead = base.select("*", *[F.lit(None).cast(t).alias(c) for c, t in types.items() if c not in base.columns])
        contacts = spark.range(0, n, 1, 8).select(
            F.when(F.col("id") == 0, "hot.hu").otherwise(F.concat(F.lit("d"), F.col("id"))).alias("domain"),
            F.array(F.concat(F.lit("a@d"), F.col("id"))).alias("emails"), F.array().cast("array<string>").alias("phones"))
        out = E.enrich_contacts(lead, contacts, now())
        assert out.filter("answered").count() == n
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == n and "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
