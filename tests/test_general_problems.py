"""The general data-preparation operators against plain Python, and their edge cases."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from editlume.operators.event_features import append_cells, clean_label, cumulative_cells, daily_cells, feature_table, features_of, window_features
from editlume.operators.history import canonical_name, checkpoint_delta, group_set, reconstruct, rights_changes
from editlume.operators import orphans as O
from editlume.operators.orphans import Reference, orphan_references, orphan_report
from editlume.operators.sessions import sessionize
from editlume.operators.skew import heavy_join, heavy_keys, salted_aggregate
from editlume.plans import problems

T0 = datetime(2015, 1, 1)
EVENTS = "log_id long, log_user long, log_type string, log_action string, log_timestamp timestamp_ntz, v long, _entity string, day int"


def events(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], EVENTS)


def features(df, as_of=None, windows=(30,)):
    return window_features(df, "log_user", "log_id", "log_timestamp", ["log_type", "log_action"], as_of, windows, "v")


def test_features_against_loop(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(600):
        user = 1 if rnd.random() < 0.4 else rnd.randrange(2, 20)  # one hot user
        ts = T0 + timedelta(days=rnd.randrange(400), seconds=rnd.randrange(5))  # many ties
        rows.append((i, user, rnd.choice([" Block", "block ", "MOVE"]), rnd.choice(["a-b", "A_B"]), ts, rnd.choice([None, 1, 5])))
    rows += rnd.sample(rows, 60)  # repeated rows
    as_of = date(2015, 10, 1)
    want: dict = {}
    for i, u, t, a, ts, v in {r[0]: r for r in rows}.values():
        if ts.date() > as_of:
            continue
        w = want.setdefault((u, t.strip().lower(), a.lower().replace("-", "_")), [0, 0, 0, 0, (T0, -1)])
        w[0] += 1
        w[1] += v or 0
        if ts.date() > as_of - timedelta(days=30):
            w[2] += 1
            w[3] += v or 0
        w[4] = max(w[4], (ts, i))
    got = {
        (r.log_user, r.log_type, r.log_action): [r.n, r.total, r.n_30d, r.total_30d, (r.last_ts, r.last_id)]
        for r in features(events(spark, rows), as_of).collect()
    }
    assert got == want


def test_features_nulls_and_empty(spark):
    rows = [(1, None, "a", "b", T0, 1), (2, 5, None, "b", T0, 1), (3, 5, "a", "b", None, 1), (None, 5, "a", "b", T0, 1), (4, 5, "", "", T0, None)]
    got = features(events(spark, rows)).collect()
    assert [(r.log_user, r.log_type, r.n, r.total, r.last_id) for r in got] == [(5, "", 1, 0, 4)]
    assert features(events(spark, [])).count() == 0
    table = feature_table(features(events(spark, rows)), "log_user", ["log_type", "log_action"]).collect()
    assert len(table) == 1 and table[0].n_types == 1 and list(table[0].features) == ["/"]


def test_undated_events_count(spark, tmp_path):
    rows = [(1, 5, "a", "b", T0, 3), (2, 5, "a", "b", None, 4), (2, 5, "a", "b", None, 4), (3, 5, "c", "d", None, None), (4, 6, "A ", "b", None, 2)]
    df = events(spark, rows)
    got = window_features(df, "log_user", "log_id", "log_timestamp", ["log_type", "log_action"], None, (30,), "v", undated=True).collect()
    assert sorted((r.log_user, r.log_type, r.n, r.total, r.n_30d, r.total_30d, r.last_ts, r.last_id) for r in got) == [
        (5, "a", 2, 7, 1, 3, T0, 1), (5, "c", 1, 0, 0, 0, None, None), (6, "a", 1, 2, 0, 0, None, None)
    ]
    df.withColumnRenamed("v", "log_new_flag").write.parquet(f"{tmp_path}/logging.parquet")
    users = {r.log_user: r for r in problems.p1_feature_table(spark, str(tmp_path)).collect()}
    assert {u: (r.n_events, r.n_types, r.last_ts) for u, r in users.items()} == {5: (3, 2, T0), 6: (1, 1, None)}
    assert users[5].features["a/b"].total == 7 and [r.log_user for r in problems.p1_found(spark, str(tmp_path)).collect()] == [5]
    with pytest.raises(ValueError):
        window_features(df, "log_user", "log_id", "log_timestamp", ["log_type", "log_action"], date(2020, 1, 1), undated=True)


def test_clean_label(spark):
    got = spark.createDataFrame([(" \tMove-Prot \n",)], "x string").select(clean_label(F.col("x"))).first()[0]
    assert got == "move_prot"


REV = "rev_id long, rev_user long, rev_timestamp timestamp_ntz, entity string, pred int"


def revisions(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], REV)


def loop_sessions(rows, gap):
    by: dict = {}
    for i, u, t in {r[0]: r for r in rows}.values():
        by.setdefault(u, []).append((t, i))
    out = set()
    for u, es in by.items():
        es.sort()
        start = 0
        for k in range(1, len(es) + 1):
            if k == len(es) or (es[k][0] - es[k - 1][0]).total_seconds() > gap:
                out.add((u, es[start][1], es[k - 1][1], es[start][0], es[k - 1][0], k - start))
                start = k
    return out


@pytest.mark.parametrize("gap", [60, 3600])
def test_sessions_against_loop(spark, gap):
    rnd = random.Random(gap)
    rows = []
    t = T0
    for i in range(500):
        t += timedelta(seconds=rnd.choice([0, 1, gap, gap + 1, gap // 2, 5 * gap]))
        rows.append((rnd.randrange(10**6), 1 if rnd.random() < 0.6 else rnd.randrange(2, 6), t))
    rows = list({r[0]: r for r in rows}.values())
    rows += rows[:40]
    got = {(r.rev_user, r.first_id, r.last_id, r.start, r.end, r.n_events) for r in sessionize(revisions(spark, rows), "rev_user", "rev_id", "rev_timestamp", gap).collect()}
    assert got == loop_sessions(rows, gap)


def test_one_long_session_and_exact_gap(spark):
    rows = [(k, 7, T0 + timedelta(seconds=3600 * k)) for k in range(70)] + [(1000, 7, T0 + timedelta(seconds=3600 * 69 + 3600, microseconds=1))]
    got = sorted((r.first_id, r.last_id, r.n_events, r.duration_s) for r in sessionize(revisions(spark, rows), "rev_user", "rev_id", "rev_timestamp").collect())
    assert got == [(0, 69, 70, 3600 * 69), (1000, 1000, 1, 0)]


def test_sessions_nulls_and_empty(spark):
    rows = [(1, None, T0), (2, 3, None), (None, 3, T0), (4, 3, T0)]
    assert [(r.rev_user, r.first_id) for r in sessionize(revisions(spark, rows), "rev_user", "rev_id", "rev_timestamp").collect()] == [(3, 4)]
    assert sessionize(revisions(spark, []), "rev_user", "rev_id", "rev_timestamp").count() == 0


def orphan_frames(spark, revs, page, removed):
    r = spark.createDataFrame(revs, "rev_id long, rev_page long, rev_parent_id long, rev_timestamp timestamp_ntz, loaded_at timestamp_ntz, kind string, key long")
    p = spark.createDataFrame(page, "page_id long, loaded_at timestamp_ntz")
    x = spark.createDataFrame(removed, "ref_table string, row_key long, removed_at timestamp_ntz")
    refs = [Reference("rev_page", p, "page_id", "page"), Reference("rev_parent_id", r, "rev_id", "revision", (0,))]
    return orphan_references(r, "rev_id", "rev_timestamp", "loaded_at", refs, x)


def test_orphans(spark):
    d = timedelta(days=1)
    revs = [
        (1, 10, None, T0, T0 + 2 * d, "x", 1), (2, 11, 1, T0, T0 + 2 * d, "x", 1), (3, 12, 0, T0, T0 + 2 * d, "x", 1), (4, 13, 99, None, T0 + 2 * d, "x", 1),
        (5, None, 6, T0, T0 + 2 * d, "x", 1), (6, 14, 4, T0, T0 + 3 * d, "x", 1), (6, 14, 4, T0, T0 + 9 * d, "x", 1), (None, 12, 1, T0, T0, "x", 1),
    ]
    page = [(10, T0), (11, T0 + 5 * d), (11, T0 + 8 * d), (14, T0), (None, T0)]
    removed = [("page", 12, T0), ("page", 14, T0), ("page", 12, T0), ("wiki_user", 13, T0), ("page", None, T0)]
    got = {(r.rev_id, r.ref_field, r.kind, r.period) for r in orphan_frames(spark, revs, page, removed).collect()}
    assert got == {
        (2, "rev_page", "late", "2015-01"), (3, "rev_page", "deleted", "2015-01"), (4, "rev_page", "missing", None),
        (4, "rev_parent_id", "missing", None), (5, "rev_parent_id", "late", "2015-01"),
    }
    report = {(r.ref_field, r.kind, r.period): r.n_refs for r in orphan_report(orphan_frames(spark, revs, page, removed)).collect()}
    assert report[("rev_page", "missing", None)] == 1


def test_orphans_hot_key_and_empty(spark):
    revs = [(i, 5 if i % 3 else i, None, T0, T0, "x", 1) for i in range(1, 400)]
    got = orphan_frames(spark, revs, [(i, T0) for i in range(1, 400) if i != 5], []).collect()
    assert len(got) == sum(1 for i in range(1, 400) if i % 3) + 0 and {r.kind for r in got} == {"missing"}
    assert orphan_frames(spark, [], [], []).count() == 0


def test_balance_in_batches(spark):
    """Loads, withdrawals, removals and restorations, merged in batches of any order, give what one run gives."""
    day = lambda k: T0 + timedelta(days=k)
    refs = [Reference("rev_page", None, "page_id", "page")]
    recs = lambda rows: spark.createDataFrame(rows, "_id long, rev_page long, first_loaded timestamp_ntz")
    keys = lambda *ids: spark.createDataFrame([(i, day(3)) for i in ids], "page_id long, loaded_at timestamp_ntz")
    batches = [
        O.reference_deltas(recs([(1, 10, day(1)), (2, 11, day(5)), (3, 12, day(5))]), refs),
        O.existence_deltas(keys(10, 11, 12), "rev_page", "page_id", "loaded_at"),
        O.existence_deltas(keys(11, 12), "rev_page", "page_id", None, -1),
        O.existence_deltas(keys(12), "rev_page", "page_id"),
        O.reference_deltas(recs([(4, 13, day(2)), (5, 14, day(2))]), refs),
        O.reference_deltas(recs([(5, 14, day(2))]), refs, -1),
    ]
    want = {(10, "late"), (11, "deleted"), (13, "missing")}
    for order in (batches, batches[::-1], batches[2:] + batches[:2]):
        balance = None
        for b in order:
            balance = O.merge(balance, b)
        assert {(r.key, r.kind) for r in O.faulty_keys(balance).collect()} == want
    assert {r.n_ref for r in balance.where("key = 14").collect()} == {0}


def test_store_of_cells_in_batches(spark):
    rnd = random.Random(11)
    rows = [(i, rnd.randrange(1, 6), rnd.choice("ab"), "x", None if i % 17 == 0 else T0 + timedelta(days=rnd.randrange(60)), rnd.choice([None, 2])) for i in range(300)]
    types = ["log_type", "log_action"]
    cells = lambda part: daily_cells(events(spark, part), "log_user", "log_id", "log_timestamp", types, "v")
    whole = cumulative_cells(cells(rows), 2)
    grown = append_cells(cumulative_cells(cells(rows[::2]), 2), cells(rows[1::2]), 2)
    assert sorted(map(str, whole.collect())) == sorted(map(str, grown.select(whole.columns).collect()))
    a, b = (sorted(map(str, features_of(s, "log_user", types, date(2015, 2, 1), (7,)).collect())) for s in (whole, grown))
    assert a == b and a


def test_group_sets(spark):
    texts = ["a:1:{i:0;s:3:\"Bot\";}", "['sysop', 'Bot']", "bot,sysop,bot", "x | y-z", "(none)", "[]", " ", "a:0:{}", None, "a\nb"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "x string").select(group_set(F.col("x"))).collect()]
    assert got == [["bot"], ["bot", "sysop"], ["bot", "sysop"], ["x", "y-z"], [], [], [], [], None, ["a", "b"]]


def test_canonical_names(spark):
    names = [" ada_Lovelace ", "User:ada  Lovelace", "user : Ada", "Éric", "", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in names], "x string").select(canonical_name(F.col("x"))).collect()]
    assert got == ["Ada Lovelace", "Ada Lovelace", "Ada", "Éric", "", None]


LEVEL = "level_log_id long, level_username string, level_timestamp timestamp_ntz, level_old string, level_new string, entity string, state string, period int"


def histories(spark, rows, users, most=500):
    lv = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], LEVEL)
    wu = spark.createDataFrame(users, "user_id long, user_name string")
    return reconstruct(*checkpoint_delta(rights_changes(lv, wu), most=most))


@pytest.mark.parametrize("most", [500, 3])
def test_history_against_loop(spark, most):
    rnd = random.Random(9)
    groups = ["bot", "sysop", "oversight"]
    rows = []
    for i in range(300):
        u = "Hot" if rnd.random() < 0.5 else f"U{rnd.randrange(6)}"
        s = rnd.sample(groups, rnd.randrange(4))
        rows.append((i, u, T0 + timedelta(days=rnd.randrange(90)), None, rnd.choice([",".join(s), str(s), " | ".join(x.upper() for x in s)])))
    rows += rows[:20]
    by: dict = {}
    for r in {r[0]: r for r in rows}.values():
        s = tuple(sorted({g.strip().lower() for g in r[4].strip("[]").replace("'", "").replace("|", ",").split(",")} - {""}))
        by.setdefault(r[1], []).append((r[2], r[0], s))
    want = set()
    for u, es in by.items():
        es.sort()
        opened = [e for k, e in enumerate(es) if k == 0 or e[2] != es[k - 1][2]]
        for k, (ts, i, s) in enumerate(opened):
            nxt = opened[k + 1] if k + 1 < len(opened) else (None, None, None)
            want.add((u, i, s, ts, nxt[0], nxt[1]))
    got = {(r.entity, r.id, tuple(r.state), r.valid_from, r.valid_to, r.next_id) for r in histories(spark, rows, [(1, "Hot")], most).collect()}
    assert got == want


def test_history_edge_cases(spark):
    rows = [(1, "user:a_b", T0, None, None), (2, "A b", T0, None, ""), (3, "a B", T0, None, "bot"), (4, None, T0, None, "bot"), (5, "A b", None, None, "bot"), (None, "A b", T0, None, "x")]
    got = [(r.entity, r.id, r.state, r.next_id) for r in histories(spark, rows, [(1, "A b"), (2, None)]).orderBy("id").collect()]
    assert got == [("A b", 2, [], None), ("A B", 3, ["bot"], None)]
    assert histories(spark, [], []).count() == 0


def test_salted_aggregate_against_loop(spark):
    rnd = random.Random(5)
    rows = [(i, 1 if rnd.random() < 0.4 else rnd.randrange(300), rnd.choice([None, 3])) for i in range(3000)]
    rows += rows[:300] + [(9999, None, 1)]
    df = spark.createDataFrame(rows, "id long, k long, v long")
    got = salted_aggregate(df, ["k"], "id", {"_v": F.max("v")}, {"n": (F.count("*"), F.sum("n")), "s": (F.sum("_v"), F.sum("s"))}, rows_per_salt=200)
    want: dict = {}
    for i, k, v in {r[0]: r for r in rows}.values():
        if k is not None:
            n, s = want.get(k, (0, None))
            want[k] = (n + 1, s if v is None else (s or 0) + v)
    assert {r.k: (r.n, r.s) for r in got.collect()} == want
    assert {r[0] for r in heavy_keys(df, "k", 0.1).collect()} == {1}
    empty = df.where("id < 0")
    assert salted_aggregate(empty, ["k"], "id", {"_v": F.max("v")}, {"n": (F.count("*"), F.sum("n"))}).count() == 0


def test_heavy_join_keeps_every_row(spark):
    left = spark.createDataFrame([(i, 1 if i % 2 else i) for i in range(500)] + [(1000, None)], "id long, k long")
    right = spark.createDataFrame([(i, f"n{i}") for i in range(0, 400)], "rk long, name string")
    got = {r.id: r.name for r in heavy_join(left, right, "k", "rk", ["name"]).collect()}
    assert len(got) == 501 and got[3] == "n1" and got[2] == "n2" and got[498] is None and got[1000] is None
    assert heavy_join(left, right, "k", "rk", ["name"], "inner").count() == 450
