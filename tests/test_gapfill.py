"""Gap-fill, attribution, views and probes against plain loops."""

import datetime as dt
import random

import pytest

from footfall.operators import attribution, clean, gapfill, plays, probes
from footfall.operators.gapfill import AD_SLOT
from footfall.operators.plays import SLOT
from footfall.plans import adapters, jobs

DAY, NEXT = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
MIDNIGHT = 1704067200
SCANS = ("time date, devid string, mac string, sch_version int, uploadcount int, pls_index int, "
         "play_index int, plninfo string, scan_time long")
PLAYS = ("time date, devid string, sch_version int, uploadcount int, pls_index int, play_index int, "
         "plninfo string, start_ms long, end_ms long, adcontent string, ad_length int")
APPEND, FLAG = 40, 30


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(21)
    scans, plays = set(), set()
    for d in ("d1", "d2"):
        for m in range(25):
            t = MIDNIGHT + rng.choice([0, 500, 86200])
            for _ in range(rng.randint(1, 12)):
                t += rng.choice([1, 5, 20, 30, 31, 80, 200])
                if t < MIDNIGHT + 86400:
                    scans.add((DAY, d, f"m{m}", 1, 1, rng.randint(1, 2), 1, f"p{rng.randint(1, 2)}", t))
        for base in (0, 500, 86200):
            t = (MIDNIGHT + base) * 1000
            for _ in range(120):
                t += rng.choice([0, 1000, 4000, 7500, 15000])
                s = rng.randint(1, 2)
                day = DAY if t < (MIDNIGHT + 86400) * 1000 else NEXT
                plays.add((day, d, 1, 1, s, 1, rng.choice([f"p{s}", "NULL"]), t,
                           t + rng.choice([2000, 5000, 9999]), f"ad{s}", rng.choice([5, 15])))
    scans, plays = sorted(scans), sorted(plays)
    return scans, plays, spark.createDataFrame(scans, SCANS), spark.createDataFrame(plays, PLAYS)


def visitors(scans):
    out = {}
    for s in sorted(scans, key=lambda s: (s[8], *s[3:8])):
        out.setdefault(s[:3], []).append(s)
    return out


def windows(scans):
    for i, s in enumerate(scans):
        t = s[8]
        if i + 1 < len(scans) and scans[i + 1][8] - t <= FLAG:
            yield s, t, scans[i + 1][8], False
        else:
            end = t + APPEND
            yield s, t, min(end, scans[i + 1][8]) if i + 1 < len(scans) else end, True


def rebuilt_rows(scans, plays):
    """Rows of each visitor, in order: (slot..., time, time_diff)."""
    out = {}
    for who, mine in visitors(scans).items():
        rows = []
        for s, t, e, closed in windows(mine):
            rows.append((*s[3:8], t, 0))
            hits = [p for p in plays if p[:2] == who[:2] and t * 1000 <= p[7] < e * 1000]
            for p in sorted(hits, key=lambda p: (p[7], p[8], *p[2:7])):
                if closed or p[8] <= e * 1000:
                    plan = s[7] if p[6] == "NULL" else p[6]
                    rows.append((*p[2:6], plan, p[7] // 1000, p[7] - t * 1000 if closed else 0))
        out[who] = rows
    return out


def running(plays, devid, t, next_day=True):
    days = (DAY, NEXT) if next_day else (DAY,)
    hits = [p for p in plays if p[1] == devid and p[0] in days and p[7] <= t * 1000 <= p[8]]
    return min(hits, key=lambda p: (-p[7], p[8], *p[2:7], p[9], p[10])) if hits else None


def logged_rows(scans, plays):
    """As above, with the ad: (slot..., time, time_diff, adcontent, ad_length)."""
    out = {}
    for who, mine in visitors(scans).items():
        rows = []
        for s, t, e, closed in windows(mine):
            ad = running(plays, who[1], t)
            rows.append((*s[3:8], t, 0, ad and ad[9], ad and ad[10]))
            hits = [p for p in plays if p[1] == who[1] and t * 1000 < p[7] < e * 1000]
            for p in sorted(hits, key=lambda p: (p[7], p[8], *p[2:7])):
                rows.append((*p[2:7], (p[7] + 1000) // 1000, p[7] - t * 1000 if closed else 0, p[9], p[10]))
        out[who] = rows
    return out


def views_by_loop(rows, fits):
    """(first row, start, end) of the views of one visitor."""
    views = []
    for r in rows:
        last = views[-1] if views else None
        if last and r[5] - last["to"] <= FLAG and last["row"][:4] == r[:4] and fits(last, r):
            last["to"], last["n"] = r[5], last["n"] + 1
        else:
            views.append({"row": r, "from": r[5], "to": r[5], "n": 1})
    return [(v["row"], v["from"] * 1000, v["from"] * 1000 + 1 if v["n"] == 1 else v["to"] * 1000) for v in views]


def flat(by_visitor):
    return sorted(((*who, *r) for who, rs in by_visitor.items() for r in rs), key=repr)


def test_gapfill_rebuilt(case):
    scans, plays, sdf, pdf = case
    hot = gapfill.device_hot_keys(sdf, ["time", "devid"], 1)
    out = gapfill.exposure_gapfill(sdf, pdf, APPEND, FLAG, hot)
    got = out.select("time", "devid", "mac", *SLOT, "scan_time", "time_diff").collect()
    want = rebuilt_rows(scans, plays)
    assert sorted(map(tuple, got), key=repr) == flat(want)
    assert len(got) > len(scans)


def test_view_merge(case):
    scans, plays, sdf, pdf = case
    filled = gapfill.exposure_gapfill(sdf, pdf, APPEND, FLAG)
    got = gapfill.view_merge(filled, FLAG).select(
        "time", "devid", "mac", *AD_SLOT, "time_diff", "start_ms", "end_ms").collect()
    want = [(*who, *row[:4], row[6], a, b) for who, rs in rebuilt_rows(scans, plays).items()
            for row, a, b in views_by_loop(rs, lambda v, r: True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("next_day", [True, False])
def test_attribution(case, next_day):
    scans, plays, sdf, pdf = case
    out = attribution.attribute_ads(sdf, pdf, ("adcontent", "ad_length"), next_day)
    want = []
    for s in scans:
        ad = running(plays, s[1], s[8], next_day)
        want.append((*s, ad and ad[9], ad and ad[10]))
    got = out.select(*sdf.columns, "adcontent", "ad_length").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert any(w[-1] is None for w in want) and any(w[-1] for w in want)


def test_an_end_years_ahead_is_attributed_without_a_million_buckets(spark):
    columns = "time date, devid string, sch_version int, uploadcount int, pls_index int, play_index int, plninfo string, start_ms long, end_ms long, adcontent string"
    ten_years, start = 315_360_000_000, MIDNIGHT * 1000
    rows = [(DAY, "d1", 1, 1, 1, 1, "p", start, start + ten_years, "long"),
            (DAY, "d2", 1, 1, 1, 1, "p", start, 9_000_000_000_000_000_000, "garbage"),
            (DAY, "d1", 1, 1, 1, 1, "p", start + 50_000, start + 60_000, "short")]
    scans = spark.createDataFrame(
        [(DAY, d, "m", MIDNIGHT + t) for d in ("d1", "d2") for t in (0, 55, 80_000)],
        "time date, devid string, mac string, scan_time long")
    out = attribution.attribute_ads(scans, spark.createDataFrame(rows, columns), ("adcontent",))
    got = {(r.devid, r.scan_time - MIDNIGHT): r.adcontent for r in out.collect()}
    assert got == {("d1", 0): "long", ("d1", 55): "short", ("d1", 80_000): "long",
                   ("d2", 0): "garbage", ("d2", 55): "garbage", ("d2", 80_000): "garbage"}


PLAY_TIMES = ("time date, devid string, sch_version int, uploadcount int, pls_index int, play_index int, "
              "plninfo string, start_ms long, end_ms long, adcontent string")


@pytest.mark.parametrize("batch", [3, 10_000])
def test_overlapping_plays_are_swept_apart(spark, batch):
    """Nested, staggered, equal and touching plays, read in small and large batches."""
    rng = random.Random(4)
    rows, seconds = [], []
    for d in range(60):
        for k in range(rng.randint(1, 9)):
            start = MIDNIGHT * 1000 + rng.randint(0, 20) * 500
            end = start + rng.choice([-1, 0, 500, 1000, 3000, 9000, 40_000_000])
            rows.append((rng.choice([DAY, NEXT]), f"d{d}", 1, 1, 1, 1, "p", start, end, f"ad{k % 4}"))
        seconds += [(DAY, f"d{d}", "m", MIDNIGHT + s) for s in range(0, 25) for _ in range(2)]
    plays = spark.createDataFrame(rows, PLAY_TIMES)
    scans = spark.createDataFrame(seconds, "time date, devid string, mac string, scan_time long")
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, batch)
        got = attribution.attribute_ads(scans, plays, ("adcontent",)).collect()
        segments = attribution.swept(plays, ("adcontent",)).orderBy("time", "devid", "from").collect()
    finally:
        spark.conf.set(setting, before)
    want = []
    for day, devid, mac, t in seconds:
        hits = [p for p in rows if p[1] == devid and p[7] <= t * 1000 <= p[8]]
        best = min(hits, key=lambda p: (-p[7], p[8], p[9]), default=None)
        want.append((day, devid, mac, t, best and best[9]))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    for one, other in zip(segments, segments[1:]):
        assert one.to < other["from"] or (one.time, one.devid) != (other.time, other.devid)


def test_plays_out_of_reach_are_not_swept(spark):
    """Of a date's plays only those that touch the time of its scans are shuffled and swept; a
    long play begun before is still found under a short one that ended."""
    plays = spark.createDataFrame(
        [(DAY, "d", 1, 1, 1, 1, "p", (MIDNIGHT + a) * 1000, (MIDNIGHT + b) * 1000, ad) for a, b, ad in
         [(0, 5000, "long"), (1000, 1010, "short"), (10, 999, "gone"), (6000, 6010, "late")]]
        + [(NEXT, "d", 1, 1, 1, 1, "p", (MIDNIGHT + 86400 + k) * 1000, (MIDNIGHT + 86410 + k) * 1000, "next") for k in range(50)],
        "time date, devid string, sch_version int, uploadcount int, pls_index int, play_index int, "
        "plninfo string, start_ms long, end_ms long, adcontent string")
    scans = spark.createDataFrame(
        [(DAY, "d", MIDNIGHT + t) for t in (1000, 1010, 1011, 5000)], "time date, devid string, scan_time long")
    got = {r.scan_time - MIDNIGHT: r.adcontent for r in attribution.attribute_ads(scans, plays, ("adcontent",)).collect()}
    assert got == {1000: "short", 1010: "short", 1011: "long", 5000: "long"}
    asked = spark.createDataFrame([(DAY, MIDNIGHT + 1000, MIDNIGHT + 5000)], "time date, _first long, _last long")
    assert attribution.swept(plays, ("adcontent",)).count() > 50
    assert {r.ad.adcontent for r in attribution.swept(plays, ("adcontent",), True, asked).collect()} == {"long", "short"}


def test_plays_that_run_at_no_scan_are_not_swept(spark, monkeypatch):
    """Most plays of a device lie between its scans; only those that run at one reach the sweep,
    and the seconds with scans are all that leaves it."""
    plays = spark.createDataFrame(
        [(DAY, "d", 1, 1, 1, 1, "p", (MIDNIGHT + 10 * k) * 1000, (MIDNIGHT + 10 * k + 9) * 1000, f"ad{k}") for k in range(500)],
        PLAY_TIMES)
    times = [0, 1005, 1009, 1010, 1010, 4999, 9000]
    scans = spark.createDataFrame([(DAY, "d", MIDNIGHT + t) for t in times], "time date, devid string, scan_time long")
    sweeper, count = attribution._sweeper, spark.sparkContext.accumulator(0)

    def counted(**options):
        run = sweeper(**options)

        def counting(batches):
            for batch in batches:
                count.add(batch.num_rows)
                yield batch

        return lambda batches: run(counting(batches))

    monkeypatch.setattr(attribution, "_sweeper", counted)
    got = [(r.scan_time - MIDNIGHT, r.adcontent) for r in attribution.attribute_ads(scans, plays, ("adcontent",)).collect()]
    assert sorted(got, key=repr) == sorted(
        [(0, "ad0"), (1005, "ad100"), (1009, "ad100"), (1010, "ad101"), (1010, "ad101"), (4999, "ad499"), (9000, None)], key=repr)
    assert count.value == 4 + 6  # plays, and distinct seconds


def test_runs_of_one_view_are_stored_as_a_row(spark, monkeypatch):
    """Of a run that is one view, whatever its length, one row is written."""
    rows = spark.range(1000).selectExpr(
        "date '2024-01-01' AS time", "'d' AS devid", "concat('m', id % 2) AS mac", "1 AS sch_version", "1 AS uploadcount",
        "1 AS pls_index", "1 AS play_index", "'p' AS plninfo", f"{MIDNIGHT} + id AS scan_time",
        f"{MIDNIGHT} + id AS anchor", "0 AS inserted", "cast(null as long) AS p_start",
        "cast(null as long) AS p_end", "'a' AS adcontent", "cast(5000 AS int) AS ad_length")
    written, staged = [], gapfill.staged
    monkeypatch.setattr(gapfill, "staged", lambda df: written.append(staged(df)) or written[-1])
    views = gapfill.view_merge_adlen(rows, FLAG)
    base = MIDNIGHT * 1000
    assert sorted((r.mac, r.start_ms, r.end_ms) for r in views.collect()) == [
        ("m0", base, base + 998_000), ("m1", base + 1000, base + 999_000)]
    assert written[0].count() == 2


def test_attribution_shuffles_each_side_once(spark, case):
    _, _, sdf, pdf = case
    text = attribution.swept(pdf, ("adcontent",))._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
    text = attribution.attribute_ads(sdf, pdf, ("adcontent",))._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(sequence" not in text and text.count("MapInArrow") == 1


@pytest.mark.parametrize("split", [False, True])
def test_dealt_gapfill(case, split):
    """Scans dealt out once: the same rows and views, and no shuffle from the scans to the views."""
    scans, plays, sdf, pdf = case
    hot = gapfill.device_hot_keys(sdf, ["time", "devid"], 20) if split else None
    dealt = gapfill.dealt_visitors(sdf, hot)
    out = gapfill.dealt_gapfill(dealt, pdf, APPEND, FLAG, hot)
    got = out.select("time", "devid", "mac", *SLOT, "scan_time", "time_diff").collect()
    assert sorted(map(tuple, got), key=repr) == flat(rebuilt_rows(scans, plays))
    if split:
        assert dealt.select("devid", "_salt").distinct().count() > 2
        assert dealt.groupBy("devid", "mac").agg({"_salt": "min"}).count() == dealt.select("devid", "mac", "_salt").distinct().count()
    views = gapfill.view_merge(out, FLAG)
    whole = gapfill.view_merge(gapfill.exposure_gapfill(sdf, pdf, APPEND, FLAG), FLAG)
    assert sorted(map(tuple, views.collect()), key=repr) == sorted(map(tuple, whole.select(*views.columns).collect()), key=repr)
    text = views._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" not in text and "Exchange hashpartitioning" not in text.split("Union")[0]


def test_rebuilt_job_makes_plays_in_contacts_only(spark, monkeypatch):
    """Views over the rebuilt log are those over all rebuilt plays, but only the plays that start
    in a contact are made; the scans are dealt out once."""
    scans, schedule, factory = (
        f(spark, "/root/testdata/sf0.001") for f in (adapters.view_info, adapters.schedule_days, adapters.mac_factory))
    genuine = clean.spoof_filter(scans, factory)
    kept = gapfill.visitor_scans(clean.dominant_serial(genuine, ["time", "devid"]), 1000)
    whole = plays.rebuild_plays(genuine, schedule)
    want = gapfill.view_merge(gapfill.exposure_gapfill(kept, whole, 600, 1800), 1800)
    made, rebuild = [], plays.rebuild_plays
    monkeypatch.setattr(plays, "rebuild_plays", lambda *a: made.append(rebuild(*a)) or made[-1])
    got = jobs.rebuilt_views(scans, schedule, factory, 600, 1800, 1000)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.select(*got.columns).collect()), key=repr)
    assert 0 < made[0].count() < whole.count() / 3
    assert "_bucket" not in got._jdf.queryExecution().executedPlan().toString()


def test_gapfill_from_log(case):
    scans, plays, sdf, pdf = case
    hot = gapfill.device_hot_keys(sdf, ["devid"], 1)
    out = gapfill.exposure_gapfill_playlog(sdf, pdf, APPEND, FLAG, ("adcontent", "ad_length"), hot=hot)
    got = out.select("time", "devid", "mac", *SLOT, "scan_time", "time_diff", "adcontent", "ad_length").collect()
    assert sorted(map(tuple, got), key=repr) == flat(logged_rows(scans, plays))


@pytest.mark.parametrize("next_day", [True, False])
def test_plays_near_contacts(case, next_day):
    """Every play that ran during a contact is marked, and all plays are counted."""
    scans, plays, sdf, pdf = case
    spans = gapfill.contact_spans(sdf, APPEND, FLAG)
    near = gapfill.near_plays(pdf, spans, next_day).cache()
    held = {d: [w[1:3] for who, mine in visitors(scans).items() if who[1] == d for w in windows(mine)] for d in ("d1", "d2")}
    days = (DAY, NEXT) if next_day else (DAY,)
    want = [p for p in plays if p[0] in days
            and any(a * 1000 <= p[8] and b * 1000 >= p[7] for a, b in held[p[1]])]
    assert sorted(map(tuple, near.where("_near").select(*pdf.columns).collect()), key=repr) == sorted(want, key=repr)
    assert 0 < len(want) < len(plays)
    counted = {(r.time, r.devid): r["_plays"] for r in near.where("_plays > 0").collect()}
    assert counted == {k: sum(p[:2] == k for p in plays) for k in {p[:2] for p in plays}}
    rows = sorted((r["_from"], r["_to"]) for r in spans.where("devid = 'd1'").collect())
    assert all(a[1] < b[0] for a, b in zip(rows, rows[1:]))  # spans do not touch
    near.unpersist()


def test_bad_plays_near_contacts(spark):
    """A play without an end, or one that ends before it starts, still counts where it starts."""
    scans = spark.createDataFrame([(DAY, "d", "m", 1, 1, 1, 1, "p", MIDNIGHT + 1000)], SCANS)
    at = (MIDNIGHT + 1000) * 1000
    times = [(at + 5000, None), (at + 5000, at - 90_000), (at - 500, at), (at - 9000, at - 1), (None, at), (at + 40_001, at + 50_000)]
    plays = spark.createDataFrame([(DAY, "d", 1, 1, 1, 1, "p", a, b, "ad", 5) for a, b in times], PLAYS)
    near = gapfill.near_plays(plays, gapfill.contact_spans(scans, APPEND, FLAG))
    got = [(r.start_ms, r.end_ms) for r in near.where("_near").collect()]
    assert sorted(got, key=repr) == sorted(times[:3], key=repr)


def test_logged_job_keeps_plays_near_contacts_only(spark, case, monkeypatch):
    """Plays that run while nobody is there are counted, but not stored, swept or joined."""
    _, _, sdf, pdf = case
    extra = ["ad_content_id", "suit_kind", "adproduct", "adcustomer", "city_name", "building_no", "building_name"]
    full = pdf.selectExpr("*", *[f"'x' AS {c}" for c in extra])
    far = full.withColumns({"start_ms": full.start_ms + 30_000_000, "end_ms": full.end_ms + 30_000_000})
    written, staged = [], jobs.staged
    monkeypatch.setattr(jobs, "staged", lambda df: written.append(staged(df)) or written[-1])
    want = jobs.logged_gapfill(sdf, full, APPEND, FLAG, 1, None).collect()
    few = sum(t.where("start_ms is not null").count() for t in written if "start_ms" in t.columns)
    written.clear()
    many = full.unionByName(far.where(f"start_ms < {(MIDNIGHT + 80_000) * 1000}"))
    got = jobs.logged_gapfill(sdf, many, APPEND, FLAG, 1, None).collect()
    assert many.count() > pdf.count() + 100
    assert sum(t.where("start_ms is not null").count() for t in written if "start_ms" in t.columns) == few
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


@pytest.mark.parametrize("by_content", [False, True])
def test_view_merge_adlen(case, by_content):
    scans, plays, sdf, pdf = case
    filled = gapfill.exposure_gapfill_playlog(sdf, pdf, APPEND, FLAG, ("adcontent", "ad_length"))

    def fits(view, r):
        same = not by_content or (r[7] is not None and r[7] == view["row"][7])
        return same and r[8] is not None and r[5] - view["from"] <= r[8]

    got = gapfill.view_merge_adlen(filled, FLAG, by_content).select(
        "time", "devid", "mac", *AD_SLOT, "time_diff", "adcontent", "start_ms", "end_ms").collect()
    want = [(*who, *row[:4], row[6], row[7], a, b) for who, rs in logged_rows(scans, plays).items()
            for row, a, b in views_by_loop(rs, fits)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert any(b - a > 1 for *_, a, b in want)


def test_one_run_of_a_whole_day_is_cut_into_views(spark):
    """A visitor seen in every second of a day, each view lasting as long as the ad allows."""
    rows = spark.range(86_400).selectExpr(
        "date '2024-01-01' AS time", "'d' AS devid", "'m' AS mac", "1 AS sch_version", "1 AS uploadcount",
        "1 AS pls_index", "1 AS play_index", "'p' AS plninfo", f"{MIDNIGHT} + id AS scan_time",
        f"{MIDNIGHT} + id AS anchor", "0 AS inserted", "cast(null as long) AS p_start",
        "cast(null as long) AS p_end", "'a' AS adcontent", "cast(7 + (id DIV 1000) % 3 AS int) AS ad_length")
    views = gapfill.view_merge_adlen(rows, FLAG)
    want, since = [], None
    for t in range(86_400):
        if since is None or t - since > 7 + t // 1000 % 3:
            since = t
            want.append([since, since])
        want[-1][1] = t
    got = sorted((r.start_ms, r.end_ms) for r in views.collect())
    base = MIDNIGHT * 1000
    assert got == [(base + a * 1000, base + (b * 1000 if b > a else a * 1000 + 1)) for a, b in want]


def test_logged_job_drops_quiet_devices(case):
    _, plays, sdf, pdf = case
    extra = ["ad_content_id", "suit_kind", "adproduct", "adcustomer", "city_name", "building_no", "building_name"]
    full = pdf.selectExpr("*", *[f"'x' AS {c}" for c in extra])
    busiest = max(sum(p[1] == d for p in plays) for d in ("d1", "d2"))
    assert jobs.logged_views(sdf, full, APPEND, FLAG, min_plays=busiest, max_scans=None).count() == 0
    assert jobs.logged_views(sdf, full, APPEND, FLAG, min_plays=1, max_scans=None).count() > 0


def test_visitors_with_too_many_scans_are_dropped(spark):
    many = [(DAY, "d", "hot", 1, 1, 1, 1, "p", MIDNIGHT + i % 40) for i in range(1001)]
    few = [(DAY, "d", "ok", 1, 1, 1, 1, "p", MIDNIGHT + i) for i in range(1000)]
    scans = spark.createDataFrame(many + few, SCANS)
    assert gapfill.visitor_scans(scans, None).count() == 2001
    out = gapfill.visitor_scans(scans, 1000)
    assert {r.mac for r in out.collect()} == {"ok"} and out.count() == 1000


@pytest.mark.parametrize("by_device", [True, False])
def test_probe_counts(case, spark, by_device):
    scans, _, sdf, _ = case
    rng = random.Random(8)
    moments = [(i, rng.choice(["d1", "d2"]), MIDNIGHT + rng.randint(0, 900)) for i in range(60)]
    faces = [(DAY, i, rng.choice(["d1", "d2"]), MIDNIGHT + rng.randint(0, 900)) for i in range(200)]
    out = probes.probe_counts(
        spark.createDataFrame(moments, "probe_id long, devid string, at long"), sdf,
        spark.createDataFrame(faces, "time date, logid long, devid string, starttime long"), 8,
        by_device=by_device)
    count = {}
    for s in scans:
        count[s[:3]] = count.get(s[:3], 0) + 1
    light = [s for s in scans if count[s[:3]] <= 8]
    want = []
    for i, d, at in moments:
        row = [i, d, at]
        for w in (10, 15):
            near = [s for s in light if (s[1] == d or not by_device) and abs(s[8] - at) <= w]
            seen = [f for f in faces if (f[2] == d or not by_device) and abs(f[3] - at) <= w]
            row += [len(near), len({s[2] for s in near}), len(seen)]
        want.append(tuple(row))
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert any(w[3] for w in want)


def test_network_counts_meet_no_probes(spark):
    """Figures of a whole network are running sums over the seconds of a date: no probe is joined
    with the scans around it. Scans without a mac count as scans; other dates never count."""
    other, last = DAY + dt.timedelta(days=1), MIDNIGHT + 86399
    scans = spark.createDataFrame([
        (DAY, "d1", "a", MIDNIGHT + 3), (DAY, "d2", "a", MIDNIGHT + 23), (DAY, "d2", "a", MIDNIGHT + 44),
        (DAY, "d1", None, MIDNIGHT + 4), (DAY, "d1", "b", last), (DAY, "d1", "b", last + 2),
        (other, "d1", "c", last + 3), (DAY, "d3", "e", MIDNIGHT + 900_000), (None, "d3", "e", MIDNIGHT + 3),
    ], "time date, devid string, mac string, scan_time long")
    faces = spark.createDataFrame([(DAY, "d9", last - 10), (other, "d9", last)], "time date, devid string, starttime long")
    moments = [(1, "x", MIDNIGHT), (2, "y", MIDNIGHT + 13), (3, "y", MIDNIGHT + 13), (4, "z", last),
               (5, "z", last + 1), (6, "z", MIDNIGHT + 30), (7, "z", None), (8, "z", MIDNIGHT + 34)]
    out = probes.probe_counts(
        spark.createDataFrame(moments, "probe_id long, devid string, at long"), scans, faces, 9, by_device=False)
    got = {r[0]: tuple(r[3:]) for r in out.collect()}
    assert got == {  # scans, macs, faces within 10 and 15 seconds
        1: (2, 1, 0, 2, 1, 0), 2: (3, 1, 0, 3, 1, 0), 3: (3, 1, 0, 3, 1, 0), 4: (2, 1, 1, 2, 1, 1),
        5: (1, 1, 1, 1, 1, 1), 6: (1, 1, 0, 2, 1, 0), 7: (0,) * 6, 8: (1, 1, 0, 2, 1, 0),
    }
    assert "_bucket" not in out._jdf.queryExecution().executedPlan().toString()
