"""Jobs over a store, from landed pages to erasure."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from firmfold.plans import jobs
from firmfold.plans.ingest import ingest
from firmfold.plans.store import Store
from firmfold.schemas import LEAD_COLUMNS, RAW_PAGES
from firmfold.sources.contact_pages import merge_contact_pages
from firmfold.sources.lookups import parse_places, parse_tax_signals, parse_vat_register
from tests import fixture_pages as P

NOW = datetime(2024, 6, 1, 12, 0, 0)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(P.ALL, RAW_PAGES).coalesce(1)


def suppress(spark, store, *values):
    entries = spark.createDataFrame([(v, None, "opt-out", i) for i, v in enumerate(values)],
                                    "value string, kind string, reason string, ord int")
    jobs.suppress(store, entries, "suppress", NOW)


def by_key(store):
    return {r["dedupe_key"]: r.asDict() for r in store.read("lead").collect()}


def events(store):
    return sorted((r["type"], r["lead_id"], r["meta"]) for r in store.read("audit_event").collect())


def lookups(spark):
    answers = lambda rows: spark.createDataFrame(rows, "key string, body string")
    contact = spark.createDataFrame(
        [("kekklima.hu", "", "<p>nincs</p>", NOW), ("tuztarsa.hu", "", "x@tuztarsa.hu", NOW),
         ("gone.hu", "", "a@gone.hu", NOW)],
        "domain string, path string, body string, fetched_at timestamp")
    return jobs.Lookups(
        parse_vat_register(answers([("23456787", '{"valid":true,"address":"Cím  1"}')])),
        parse_tax_signals(answers([("23456787", '{"taxStatus":"active","debtFree":false,"employeeCount":4}')])),
        merge_contact_pages(contact),
        parse_places(answers([("Magányos Bolt", '{"website":"https://bolt.hu/","phone":" 1 2 "}')])))


def test_ingest_consolidates_all_sources(spark, store, pages):
    suppress(spark, store, "https://tiltott.hu/")
    stats = ingest(store, pages, "r1", NOW, rules=jobs.DEFAULT_RULES)
    leads = by_key(store)
    assert set(leads) == {
        "vat:23456787", "domain:fenyesiroda.hu", "reg:0110222222", "name:gödöllői szerver|pest",
        "name:magányos bolt|budapest", "domain:tuztarsa.hu", "name:második|budapest"}
    kek = leads["vat:23456787"]
    # The point of interest arrives first, gaps come from later sources.
    assert (kek["legal_name"], kek["source"], kek["brand_name"]) == ("Kék Klíma", "overpass", "Kék Csoport")
    assert kek["email"] == "info@kekklima.hu" and kek["phone"] == "+3612223344"
    assert kek["registration_number"] == "02-09-345678"
    assert kek["categories"] == ["hvac", "cleaning"]
    assert kek["classification_text"].startswith("gépészet")
    assert kek["quality_score"] == 100
    assert stats.skipped_suppressed == 1 and stats.fetched == 13
    assert stats.created == 7 and stats.merged == 5
    assert "evny" not in stats.per_source and stats.failed_regions == []
    state = {(r["source"], r["region_id"]): (r["last_page"], r["total_seen"])
             for r in store.read("crawl_state").collect()}
    assert state[("directory", "budapest")] == (2, 3) and ("overpass", "budapest") not in state
    kinds = [e[0] for e in events(store)]
    # Kék Klíma meets three later sources, the guards and the cleaners one each.
    assert kinds.count("COLLECTED") == 7 and kinds.count("MERGED") == 5 and kinds.count("SUPPRESSED_SKIP") == 1


def test_one_pass_equals_source_after_source(spark, store, pages, tmp_path):
    ingest(store, pages, "all", NOW, sources=["overpass", "directory", "ebeszamolo"])
    other = Store(spark, str(tmp_path / "other"))
    totals = [0, 0, 0]
    some = ["overpass", "directory", "ebeszamolo"]
    for source in some:
        s = ingest(other, pages, f"run-{source}", NOW, sources=[source])
        totals = [a + b for a, b in zip(totals, (s.fetched, s.created, s.merged))]
    assert by_key(store) == by_key(other)
    assert [e for e in events(store)] == [e for e in events(other)]
    assert totals == [8, 6, 2]


def test_replay_of_a_run_changes_nothing(spark, store, pages):
    ingest(store, pages, "r1", NOW)
    before, log = by_key(store), events(store)
    again = ingest(store, pages, "r1", NOW)
    assert by_key(store) == before and events(store) == log and again.created == 8


def test_second_run_merges(spark, store, pages):
    ingest(store, pages, "r1", NOW)
    before = by_key(store)
    again = ingest(store, pages, "r2", NOW)
    assert by_key(store) == before
    # The cursor of the directory stands on page 2, so page 1 is not read again.
    assert again.created == 0 and again.fetched == 11


def test_sensitive_source_is_gated(spark, store, pages):
    with pytest.raises(PermissionError):
        ingest(store, pages, "r1", NOW, sources=["evny"])
    with pytest.raises(ValueError, match="known"):
        ingest(store, pages, "r1", NOW, sources=["nope"])
    ingest(store, pages, "r2", NOW, sources=["evny"], enabled={"evny"})
    only, = by_key(store).values()
    assert only["is_personal_data"] and only["categories"] == ["cleaning"]


def test_malformed_page_fails_its_region_only(spark, store):
    bad = P.DIRECTORY[:1] + [P.page("directory", "budapest", 2, '{"results": [')] + P.DIRECTORY[2:]
    stats = ingest(store, spark.createDataFrame(bad, RAW_PAGES), "r1", NOW)
    assert stats.failed_regions == [("directory", "budapest")]
    assert set(by_key(store)) == {"name:gödöllői szerver|pest"}
    assert [r["region_id"] for r in store.read("crawl_state").collect()] == ["pest"]


def test_refresh_enriches_and_logs(spark, store, pages):
    summary = jobs.refresh(store, pages, lookups(spark), "r", NOW)
    assert (summary.verified, summary.nav_checked, summary.contacts_enriched, summary.places_enriched) == (1, 1, 0, 1)
    leads = by_key(store)
    kek, bolt = leads["vat:23456787"], leads["name:magányos bolt|budapest"]
    assert kek["tax_status"] == "ACTIVE" and kek["debt_free"] is False and kek["employee_count"] == 4
    assert kek["last_verified_at"] == NOW and kek["address"] == "Budapest, Váci út"
    # The key is frozen although the place brought a site.
    assert (bolt["website"], bolt["domain"], bolt["phone"]) == ("https://bolt.hu/", "bolt.hu", "1 2")
    assert bolt["dedupe_key"].startswith("name:") and bolt["quality_score"] == 85
    assert leads["domain:fenyesiroda.hu"]["contact_checked_at"] is None
    kinds = [e[0] for e in events(store)]
    assert kinds.count("VERIFIED") == 1 and kinds.count("NAV_CHECKED") == 1 and kinds.count("ENRICHED") == 1
    # Answered rows are no candidates any more, unanswered ones are.
    again = jobs.enrich(store, lookups(spark), "again", NOW)
    assert again["verify"]["scanned"] == 0 and again["places"]["scanned"] == 5


def test_review_recategorize_export(spark, store, pages, tmp_path):
    ingest(store, pages, "r1", NOW)
    ids = {k: v["lead_id"] for k, v in by_key(store).items()}
    decide = lambda rows: spark.createDataFrame(rows, "lead_id string, action string, note string, ord int")
    with pytest.raises(ValueError, match="unknown lead"):
        jobs.review(store, decide([("zzz", "approve", None, 1)]), "bad", NOW)
    with pytest.raises(ValueError, match="unknown action"):
        jobs.review(store, decide([(ids["vat:23456787"], "maybe", None, 1)]), "bad2", NOW)
    n = jobs.review(store, decide([(ids["vat:23456787"], "reject", "x", 1), (ids["vat:23456787"], "approve", None, 2),
                                   (ids["domain:tuztarsa.hu"], "reject", "dup", 1)]), "rev", NOW)
    leads = by_key(store)
    assert n == 2 and leads["vat:23456787"]["review_status"] == "APPROVED"
    assert leads["domain:tuztarsa.hu"]["review_note"] == "dup"

    stats = jobs.recategorize(store, "rc", NOW, dry_run=True)
    assert stats["changed"] == 2 and by_key(store) == leads
    assert jobs.recategorize(store, "rc2", NOW)["changed"] == 2
    # Categories that came from codes only are gone, the score stays.
    assert by_key(store)["vat:23456787"]["categories"] == ["hvac"]
    assert by_key(store)["vat:23456787"]["quality_score"] == leads["vat:23456787"]["quality_score"]

    out = str(tmp_path / "export")
    jobs.export(store, out)
    lines = spark.read.text(out).collect()
    assert len(lines) == 7 and '"vatNumber":null' in "".join(r["value"] for r in lines)
    jobs.export(store, out, approved_only=True)
    assert [r["externalId"] for r in spark.read.json(out).collect()] == [ids["vat:23456787"]]


def test_purge_and_erasure(spark, store, pages, tmp_path):
    ingest(store, pages, "r1", NOW, enabled={"evny"})
    late = datetime(2025, 6, 1, 12, 0, 0)  # 365 days later: the boundary day goes
    suppress(spark, store, "tuztarsa.hu")
    assert jobs.purge(store, "p0", late, dry_run=True) == {"scanned": 9, "suppressed": 1, "expired": 1}
    assert store.read("lead").count() == 9
    assert jobs.purge(store, "p1", late) == {"scanned": 9, "suppressed": 1, "expired": 1}
    left = by_key(store)
    assert len(left) == 7 and "domain:tuztarsa.hu" not in left
    purged = [e for e in events(store) if e[0] == "PURGED"]
    assert len(purged) == 2 and all(e[1] is None and "@" not in e[2] for e in purged)
    # Nothing of the erased rows is left in any file of the store.
    assert not list((tmp_path / "store").glob("runs/*"))
    assert not [f for f in (tmp_path / "store").rglob("*.parquet") if b"tuztarsa" in f.read_bytes()
                and "suppression" not in str(f)]
    # Started again, the purge finds its work done.
    log = events(store)
    jobs.purge(store, "p1", late)
    assert by_key(store) == left and events(store) == log

    subject = spark.createDataFrame([(" INFO@kekklima.hu ",)], "email string")
    jobs.dsar_export(store, subject, str(tmp_path / "dsar"), "d0", NOW)
    record = spark.read.json(str(tmp_path / "dsar" / "records")).first()
    assert record["legal_name"] == "Kék Klíma" and record["collected_at"] == "2024-06-01T12:00:00.000Z"
    assert record["trail_events"] == 4
    trail = spark.read.json(str(tmp_path / "dsar" / "trail")).collect()
    assert sorted(e["type"] for e in trail) == ["COLLECTED", "MERGED", "MERGED", "MERGED"]
    assert [e[0] for e in events(store)].count("DSAR") == 1
    assert jobs.dsar_erase(store, subject, "d1", NOW) == 1
    assert "vat:23456787" not in by_key(store)
    # A suppressed subject does not come back, its company's other address does.
    ingest(store, pages, "r2", NOW, full=True)
    assert by_key(store).get("vat:23456787", {}).get("email") is None
    with pytest.raises(Exception, match="not a valid e-mail"):
        jobs.dsar_erase(store, spark.createDataFrame([("nope",)], "email string"), "d2", NOW)


def test_key_is_unique_and_only_near_parts_are_read(spark, tmp_path, pages):
    store = Store(spark, str(tmp_path / "p"), parts=50)
    ingest(store, pages, "r1", NOW)
    lead = store.read("lead")
    assert lead.columns == LEAD_COLUMNS
    assert lead.groupBy("dedupe_key").count().filter("count > 1").count() == 0
    key = lead.filter("dedupe_key = 'vat:23456787'").select("dedupe_key")
    near = store.lead_near(key)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "PartitionFilters: [(part" in plan
    assert near.filter("dedupe_key = 'vat:23456787'").count() == 1 and near.count() < lead.count()


def test_scheduled_cycle(spark, store, pages, tmp_path):
    out = jobs.scheduled_cycle(store, "full", "c1", NOW, pages=pages, lookups=lookups(spark),
                               export_path=str(tmp_path / "x"))
    assert out["report"][0]["total"] == 8 and out["purge"]["scanned"] == 8
    assert set(jobs.scheduled_cycle(store, "verify", "c2", NOW, lookups=lookups(spark))["enrich"]) == {"verify", "tax"}
    assert set(jobs.scheduled_cycle(store, "enrich", "c3", NOW, lookups=lookups(spark))["enrich"]) == {"contacts"}
    with pytest.raises(ValueError):
        jobs.scheduled_cycle(store, "other", "c4", NOW)


def test_stop_purge_restart(spark, store, pages, monkeypatch):
    """A run cut off after staging, a purge, the run again: nothing is lost, and what was suppressed meanwhile stays out."""
    change = store.change_lead

    def cut_off(keys, change, run_id):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(store, "change_lead", cut_off)
    with pytest.raises(RuntimeError):
        ingest(store, pages, "r1", NOW)
    monkeypatch.setattr(store, "change_lead", change)
    suppress(spark, store, "tuztarsa.hu")
    jobs.purge(store, "p1", NOW)
    stats = ingest(store, pages, "r1", NOW)
    assert stats.fetched == 13 and stats.skipped_suppressed == 1 and stats.created == len(by_key(store)) > 5
    assert "domain:tuztarsa.hu" not in by_key(store)
    # The ended run finds its work done, also after its frames were emptied.
    jobs.purge(store, "p2", NOW)
    left = by_key(store)
    ingest(store, pages, "r1", NOW)
    assert by_key(store) == left


def test_many_pages_points_and_copies(spark, store):
    """Nothing is capped, and a page landed twice counts once, as its newest copy."""
    rows = [P.page("directory", "pest", n, P.results({"name": f"Lapos {n} Kft.", "website": f"lap{n}.hu"})) for n in range(1, 61)]
    source, region, page, body, landed = rows[6]
    rows.append((source, region, page, body.replace("Lapos 7", "Zárt 7"), landed.replace(year=2020)))
    rows.append((source, region, page, body.replace("Lapos 7", "Nyitott 7"), landed.replace(year=2025)))
    rows.append(P.page("overpass", "pest", 1, {"elements": [
        {"type": "node", "id": k, "tags": {"name": f"Pont {k}", "website": f"pont{k}.hu"}} for k in range(500)]}))
    rows.append(P.page("mkik", "baranya", 1, P.results({"companyName": "Első Kft."})))
    rows.append(("mkik", "baranya", 2, "not json", landed))
    frame = spark.createDataFrame(rows, RAW_PAGES)
    stats = ingest(store, frame, "r1", NOW)
    leads = by_key(store)
    assert stats.fetched == stats.created == len(leads) == 560 and stats.capped_pages == 0
    assert leads["domain:lap7.hu"]["legal_name"] == "Nyitott 7 Kft."
    state = {r["source"]: (r["last_page"], r["total_seen"]) for r in store.read("crawl_state").collect()}
    assert state["directory"] == (60, 60) and "mkik" not in state
    assert stats.failed_regions == [("mkik", "baranya")] and stats.bad_pages == [("mkik", "baranya", 2)]


def test_small_batch_swaps_its_parts_only(spark, tmp_path):
    """A batch of ten keys rewrites ten parts at most; started again, or landed again, it changes no row."""
    root = tmp_path / "s"
    store = Store(spark, str(root), parts=64)
    rows = [P.page("directory", "pest", 1, P.results(*[{"name": f"Lapos {n} Kft.", "website": f"lap{n}.hu"} for n in range(400)]))]
    ingest(store, spark.createDataFrame(rows, RAW_PAGES), "r1", NOW)
    assert Store(spark, str(root), parts=7).parts() == 64

    def files():
        return {p.parent.name: p.name for p in (root / "lead").glob("part=*/*.parquet")}

    before = files()
    assert len(list((root / "lead").glob("part=*/*.parquet"))) == len(before) == 64
    ten = [P.page("mkik", "pest", 1, P.results(*[{"companyName": f"Lapos {n} Kft.", "website": f"lap{n}.hu", "email": f"a@lap{n}.hu"}
                                                for n in range(395, 405)]))]
    ingest(store, spark.createDataFrame(ten, RAW_PAGES), "r2", NOW)
    after = files()
    changed = [p for p in after if after[p] != before[p]]
    assert 1 <= len(changed) <= 10
    assert store.read("lead").count() == 405 and store.read("lead").filter("email is not null").count() == 10
    held = by_key(store)
    ingest(store, spark.createDataFrame(ten, RAW_PAGES), "r2", NOW)
    assert files() == after
    ingest(store, spark.createDataFrame(ten, RAW_PAGES), "r3", NOW, full=True)
    assert by_key(store) == held
    one = store.read("lead").filter("dedupe_key = 'domain:lap3.hu'").select("lead_id").first()["lead_id"]
    now = files()
    decision = spark.createDataFrame([(one, "approve", None, 1)], "lead_id string, action string, note string, ord int")
    jobs.review(store, decision, "d1", NOW)
    assert sum(files()[p] != now[p] for p in now) == 1
    assert store.read("lead").filter("review_status = 'APPROVED'").count() == 1


def test_run_cut_off_between_writes(spark, store, pages, monkeypatch):
    """Whatever was written before the break is written again, and counts once."""
    append, left = store.append, ["crawl_state", "audit_event"]

    def break_once(name, rows, run_id):
        append(name, rows, run_id)
        if left and name == left[-1]:
            left.pop()
            raise RuntimeError("executor lost")

    monkeypatch.setattr(store, "append", break_once)
    for _ in range(2):
        with pytest.raises(RuntimeError):
            ingest(store, pages, "r1", NOW)
    stats = ingest(store, pages, "r1", NOW)
    state = {(r["source"], r["region_id"]): (r["last_page"], r["total_seen"]) for r in store.read("crawl_state").collect()}
    assert state[("directory", "budapest")] == (2, 3) and stats.created == 8
    log = events(store)
    assert len(log) == len({r["event_id"] for r in store.read("audit_event").collect()})
    ingest(store, pages, "r1", NOW)
    assert events(store) == log


def test_erasure_of_events_keeps_the_others(spark, store):
    made = lambda run, *rows: store.append("audit_event", spark.createDataFrame(
        [(f"{run}{i}", lead, "MERGED", None, NOW) for i, lead in enumerate(rows)],
        "event_id string, lead_id string, type string, meta string, created_at timestamp"), run)
    made("a", "x", "y", None)
    made("b", "x")
    made("c", "z")
    untouched = set(str(p) for p in Path(store.root).glob("audit_event/run_id=c/*"))
    doomed = spark.createDataFrame([("x",)], "lead_id string")
    for _ in range(2):
        touched = store.read("audit_event").join(doomed, "lead_id", "left_semi").select("run_id")
        store.erase_events(lambda held: jobs.G.erase_events(held, doomed), touched, "e")
        assert sorted(r["event_id"] for r in store.read("audit_event").collect()) == ["a1", "a2", "c0"]
    assert untouched == set(str(p) for p in Path(store.root).glob("audit_event/run_id=c/*"))


def test_erasure_cuts_a_large_run_among_tasks(spark, store):
    """The events of one run are not rewritten by one task, nor the leads of one part."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        rows = spark.range(40000).select(
            F.sha2(F.col("id").cast("string"), 256).alias("event_id"), F.sha2((F.col("id") % 9000).cast("string"), 256).alias("lead_id"),
            F.lit("MERGED").alias("type"), F.lit(None).cast("string").alias("meta"), F.lit(NOW).alias("created_at"))
        store.append("audit_event", rows.repartition(4), "a")
        doomed = rows.limit(1).select("lead_id")
        gone = store.read("audit_event").join(doomed, "lead_id", "left_semi")
        want = 40000 - gone.count()
        store.erase_events(lambda held: jobs.G.erase_events(held, doomed), gone.select("run_id"), "e")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert store.read("audit_event").count() == want
    files = [p for p in Path(store.root).glob("audit_event/run_id=a/*.parquet")]
    assert len(files) > 1 and all(p.name.startswith("kept") for p in files)
