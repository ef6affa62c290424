"""Dated features against plain loops: as-of mapping, currencies, upserts, history, positions, event order, keys."""

import datetime as dt
import os
import random
import uuid
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kiln.operators import currency, sketches
from kiln.operators.asof import as_of, iso_day, standardize_as_of
from kiln.operators.dedup import By
from kiln.operators.position import carried_changes, daily_position, out_of_sequence, reconciled
from kiln.operators.sizing import SizeBook
from kiln.plans import monitoring
from kiln.plans.dag import shared_folder
from kiln.sources.history import HistoryTable
from kiln.sources.surrogate import SurrogateKeys
from kiln.sources.upsert import PART, Folder, UpsertTable
from kiln.streaming import latest

EPOCH = dt.date(2024, 1, 1)
day = lambda n: None if n is None else EPOCH + dt.timedelta(days=n)


@pytest.fixture
def base(spark):
    return f"{shared_folder(spark)}/dated-{uuid.uuid4().hex[:10]}"


@pytest.fixture
def stage(spark, base):
    def write(df, name):
        path = f"{base}/{name}-{uuid.uuid4().hex[:6]}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    return write


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- as-of lookups

def brute_as_of(key, d, versions):
    own = [v for v in versions if v[0] == key and key is not None]
    if not own:
        return None, "unknown"
    if d is None:
        return None, "undated"
    valid = [v for v in own if (v[1] is None or v[1] <= d) and (v[2] is None or v[2] >= d)]
    if not valid:
        return None, "outside"
    latest = max(v[1] or dt.date.min for v in valid)
    return min(v[3] for v in valid if (v[1] or dt.date.min) == latest), "valid"


@pytest.mark.parametrize("most", [0, 10**6])     # 0: merge join, else broadcast
def test_as_of_equals_brute_force(spark, stage, most):
    rng = random.Random(most)
    versions = [(rng.choice("abcd"), day(rng.choice([None, rng.randint(-900, 900)])), day(rng.choice([None, rng.randint(-900, 900)])),
                 rng.choice("uvwx")) for _ in range(60)] + [("e", day(5), day(1), "never"), (None, None, None, "n")]
    records = [(i, rng.choice(["a", "a", "a", "b", "c", "d", "e", "zz", None]), day(rng.choice([None, rng.randint(-1200, 1200)])))
               for i in range(900)]
    v = spark.createDataFrame(versions, "k string, start date, end date, value string")
    r = spark.createDataFrame(records, "i int, k string, d date")
    got = as_of(r, F.col("k"), F.col("d"), v, stage, SizeBook(most))
    assert rows(got) == sorted(((i, k, d, *brute_as_of(k, d, versions)) for i, k, d in records), key=str)


def test_as_of_hot_key_is_reduced_to_days(spark, stage):
    """A key with most of the records meets its versions once a day, not once a record."""
    records = spark.range(60_000).select(F.lit("hot").alias("k"), F.date_add(F.lit(EPOCH), (F.col("id") % 50).cast("int")).alias("d"))
    v = spark.createDataFrame([("hot", day(n), day(n + 400), f"v{n:03d}") for n in range(40)], "k string, start date, end date, value string")
    steps = []

    def counted(df, name):
        out = stage(df, name)
        steps.append(out.count())
        return out
    got = as_of(records, F.col("k"), F.col("d"), v, counted, SizeBook(10)).groupBy("as_of_value").count()
    assert steps == [50]
    assert {r[0]: r[1] for r in got.collect()} == {f"v{n:03d}": 1200 * (11 if n == 39 else 1) for n in range(40)}


def test_standardize_as_of_keeps_unmapped_text(spark, stage):
    tax = spark.createDataFrame(
        [("sku", " Ab ", "NEW", 1, "2024-01-05", None), ("sku", "ab", "OLD", 1, None, "2024-01-04"), ("sku", "ab", "OFF", 0, None, None),
         ("other", "cd", "X", 1, None, None), ("sku", "ef", "E", 1, "bad", "2024-02-30")],
        "mapping_type string, raw_value string, standard_value string, is_active int, effective_start_date string, effective_end_date string")
    recs = spark.createDataFrame([("AB", "2024-01-04"), (" ab", "2024-01-05"), ("ab", ""), ("ab", "2024-13-01"), (" cd ", "2024-01-01"),
                                  ("ef", "1990-01-01"), (None, "2024-01-01"), ("AB", "2024-01-04")], "raw string, day string")
    got = standardize_as_of(recs, tax, "raw", "sku", "day", "std", stage, SizeBook(100))
    assert rows(got.select("raw", "day", "std", "std_mapping")) == sorted([
        ("AB", "2024-01-04", "OLD", "valid"), ("AB", "2024-01-04", "OLD", "valid"), (" ab", "2024-01-05", "NEW", "valid"),
        ("ab", "", "ab", "undated"), ("ab", "2024-13-01", "ab", "undated"), (" cd ", "2024-01-01", "cd", "unknown"),
        ("ef", "1990-01-01", "E", "valid"), (None, "2024-01-01", None, "unknown")], key=str)
    assert standardize_as_of(recs.limit(0), tax, "raw", "sku", "day", "std", stage, SizeBook(100)).collect() == []
    assert {r["std_mapping"] for r in standardize_as_of(recs, tax.limit(0), "raw", "sku", "day", "std", stage, SizeBook(100)).collect()} == {"unknown"}


# ---- currencies

def test_currencies_are_never_added(spark, stage):
    df = spark.createDataFrame([("a", 10.0, "usd"), ("a", 5.5, " CAD "), ("a", 0.25, "USD"), ("a", None, "EUR"), ("a", 1.0, "euro"),
                                ("a", 2.0, None), (None, 3.0, "JPY"), ("b", 1.0, "usd")], "k string, x double, c string")
    totals = currency.totals_by_currency(df, ["k"], "x", "c")
    assert rows(totals) == sorted([("a", "USD", 2, 10.25), ("a", "CAD", 1, 5.5), ("a", "EUR", 1, None), ("a", "???", 2, 3.0),
                                   (None, "JPY", 1, 3.0), ("b", "USD", 1, 1.0)], key=str)
    maps = currency.total_map(totals, ["k"])
    assert {r["k"]: r["totals"] for r in maps.collect()} == {
        "a": {"USD": 10.25, "CAD": 5.5, "???": 3.0}, None: {"JPY": 3.0}, "b": {"USD": 1.0}}
    again = currency.map_sum(maps.withColumn("g", F.lit("all")), ["g"], "totals").first()["totals"]
    assert again == {"USD": 11.25, "CAD": 5.5, "???": 3.0, "JPY": 3.0}


def test_conversion_uses_the_rate_of_the_day(spark, stage):
    rates = spark.createDataFrame([("cad", "2024-01-01", 0.5), ("CAD", "2024-02-01", 0.75), ("CAD", "2024-03-01", None),
                                   ("EUR", "2024-01-15", 2.0)], "currency string, effective_date string, rate double")
    cases = [(1, 10.0, "CAD", "2024-01-31", 5.0), (2, 10.0, "cad ", "2024-02-01", 7.5), (3, 10.0, "CAD", "2023-12-31", None),
             (4, 10.0, "USD", None, 10.0), (5, 10.0, "EUR", None, None), (6, 10.0, "EUR", "2030-01-01", 20.0),
             (7, 10.0, "???", "2024-02-01", None), (8, 10.0, "GBP", "2024-02-01", None), (9, None, "USD", "2024-01-01", None),
             (10, 4.0, "CAD", "2024-05-01", 3.0)]
    df = spark.createDataFrame([c[:4] for c in cases], "i int, x double, c string, d string")
    got = currency.converted(df, "x", "c", iso_day("d"), rates, "USD", stage, SizeBook(0))
    assert {r["i"]: r["converted"] for r in got.collect()} == {c[0]: c[4] for c in cases}


# ---- upserts

SCHEMA = "k string, d string, v int, w string"


def table(spark, path):
    return UpsertTable(spark, path, StructType.fromDDL(SCHEMA), ["k", "d"], [By("v", desc=True)], F.substring("d", 1, 7))


def best_rows(all_rows):
    """The full refresh: greatest v (NULL last), then least w (NULL first) of each key."""
    groups = defaultdict(list)
    for r in all_rows:
        groups[r[:2]].append(r)
    order = lambda r: (r[2] is None, -(r[2] or 0), r[3] is not None, r[3] or "")
    return sorted((min(g, key=order) for g in groups.values()), key=str)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path.removeprefix("file:"))
            for f in fs if f.endswith(".parquet")}


def test_merges_equal_a_full_refresh_in_any_order(spark, base):
    rng = random.Random(4)
    batches = [[(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *[f"2024-{m:02d}-0{d}" for m in range(1, 5) for d in (1, 2)]]),
                 rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"])) for _ in range(40)] for _ in range(3)]
    for turn, order in enumerate(([0, 1, 2], [2, 0, 1, 0])):
        t = table(spark, f"{base}/t{turn}")
        for n in order:
            t.merge(spark.createDataFrame(batches[n], SCHEMA))
        assert rows(t.read()) == best_rows(sum(batches, []))


def test_merge_rewrites_changed_partitions_only(spark, base):
    t = table(spark, f"{base}/t")
    assert t.read().collect() == []
    first = spark.createDataFrame([("a", "2024-01-01", 1, "x"), ("b", "2024-02-01", 1, "x"), ("c", None, 1, None)], SCHEMA)
    assert t.merge(first).partitions == ("2024-01", "2024-02", "none")
    before = files(t.path)
    again = t.merge(first)
    assert (again.rows, again.partitions) == (0, ()) and files(t.path) == before      # nothing is written
    worse = spark.createDataFrame([("a", "2024-01-01", 0, "x")], SCHEMA)
    assert t.merge(worse).rows == 0 and files(t.path) == before
    got = t.merge(spark.createDataFrame([("b", "2024-02-01", 2, "y"), ("a", "2024-01-01", 1, "x"), ("d", "2024-02-09", 1, "z")], SCHEMA))
    assert (got.rows, got.partitions) == (2, ("2024-02",))
    kept = {f for f in before if "2024-02" not in f}
    assert {f: m for f, m in files(t.path).items() if f in kept} == {f: before[f] for f in kept}
    assert rows(t.read()) == [("a", "2024-01-01", 1, "x"), ("b", "2024-02-01", 2, "y"), ("c", None, 1, None), ("d", "2024-02-09", 1, "z")]
    assert not Folder(spark, t.pending).children()


def test_a_merge_that_died_is_carried_out_or_dropped(spark, base, monkeypatch):
    t = table(spark, f"{base}/t")
    t.merge(spark.createDataFrame([("a", "2024-01-01", 1, "x")], SCHEMA))

    def die(step):
        raise RuntimeError("executor lost")
    monkeypatch.setattr(t, "_apply", die)
    with pytest.raises(RuntimeError):
        t.merge(spark.createDataFrame([("a", "2024-01-01", 5, "new"), ("e", "2024-03-01", 1, "x")], SCHEMA))
    assert rows(t.read()) == [("a", "2024-01-01", 1, "x")]
    spark.createDataFrame([("z", "2024-01-01", 9, "never")], SCHEMA).write.parquet(f"{t.pending}/unfinished")
    Folder(spark, f"{t.pending}/unfinished/_SUCCESS").delete()
    other = table(spark, t.path)
    assert [m.partitions for m in other.recover()] == [("2024-01", "2024-03")]
    assert rows(other.read()) == [("a", "2024-01-01", 5, "new"), ("e", "2024-03-01", 1, "x")]
    assert PART not in other.read().columns


# ---- history

def brute_history(snapshots):
    """Versions from (day, {key: value}) in order."""
    out, held = [], {}
    for d, snap in snapshots:
        for k in [k for k in held if k not in snap or snap[k] != held[k][0]]:
            v, since = held.pop(k)
            out.append((k, *v, since, d - dt.timedelta(days=1)))
        for k, v in snap.items():
            held.setdefault(k, (v, d))
    return sorted(out + [(k, *v, since, None) for k, (v, since) in held.items()], key=str)


def test_history_equals_brute_force(spark, base):
    rng = random.Random(6)
    t = HistoryTable(spark, f"{base}/h", StructType.fromDDL("k string, a string, b int"), ["k"])
    assert t.versions().collect() == [] and t.current().collect() == []
    snapshots = []
    for n in range(5):
        snap = {k: (rng.choice([None, "", "x"]), rng.choice([None, 0, 1])) for k in ["p", "q", "r", "s", None] if rng.random() < 0.7}
        snapshots.append((day(10 * n), {} if n == 3 else snap))
        df = spark.createDataFrame([(k, *v) for k, v in snapshots[-1][1].items()], "k string, a string, b int")
        for _ in range(1 + n % 2):                                  # every second snapshot is applied twice
            t.apply(df.unionByName(df), str(snapshots[-1][0]))      # repeated rows count once
        assert rows(t.versions()) == brute_history(snapshots)
        assert rows(t.current().drop("valid_from")) == sorted(((k, *v) for k, v in snapshots[-1][1].items()), key=str)
    with pytest.raises(ValueError, match="older"):
        t.apply(df, "2023-12-01")


def test_a_snapshot_that_died_halfway_is_not_read(spark, base):
    t = HistoryTable(spark, f"{base}/h", StructType.fromDDL("k string, a string"), ["k"])
    t.apply(spark.createDataFrame([("p", "1")], "k string, a string"), "2024-01-01")
    t.apply(spark.createDataFrame([("p", "2")], "k string, a string"), "2024-01-05")
    Folder(spark, f"{t.path}/open/as_of=2024-01-05/_SUCCESS").delete()         # as if the write had been cut off
    assert rows(t.versions()) == [("p", "1", day(0), None)]
    t.apply(spark.createDataFrame([("p", "2")], "k string, a string"), "2024-01-05")
    assert rows(t.versions()) == sorted([("p", "1", day(0), day(3)), ("p", "2", day(4), None)], key=str)


# ---- positions, balances, order of events

def test_positions_and_balances_equal_brute_force(spark):
    rng = random.Random(8)
    reads = [(rng.choice(["w", "v", None]), rng.choice("abc"), day(rng.choice([None, rng.randint(0, 60)])), rng.choice([None, rng.randint(-5, 50)]))
             for _ in range(150)]
    moves = [(rng.choice(["w", "v", "only moves", None]), rng.choice("abc"), day(rng.choice([None, rng.randint(-20, 70)])), rng.choice([None, rng.randint(-9, 9)]))
             for _ in range(300)]
    r = spark.createDataFrame(reads, "w string, s string, d date, q int")
    m = spark.createDataFrame(moves, "w string, s string, day date, quantity long")
    last = defaultdict(dict)
    for w, s, d, q in reads:
        if d is not None and q is not None:
            last[w, s][d] = max(q, last[w, s].get(d, q))
    want = []
    for (w, s), own in last.items():
        ds = sorted(own)
        for p, d in zip([None, *ds], ds):
            moved = None if p is None else sum(q or 0 for a, b, x, q in moves if (a, b) == (w, s) and x and p < x <= d)
            before = None if p is None else own[p]
            want.append((w, s, d, own[d], before, moved, None if p is None else before + moved, None if p is None else own[d] - before - moved))
    assert rows(reconciled(r, m, ["w", "s"], "d", "q")) == sorted(want, key=str)

    changes = carried_changes(r, ["w", "s"], "d", "q").drop("s")
    flows = m.select("w", "day", F.col("quantity").alias("flow"))
    end = max(max(own) for own in last.values())
    want = []
    for w in {k[0] for k in last}:
        d = min(min(own) for k, own in last.items() if k[0] == w)
        while d <= end:
            on_hand = sum(own[max(x for x in own if x <= d)] for k, own in last.items() if k[0] == w and min(own) <= d)
            flow = sum(q or 0 for a, _, x, q in moves if a == w and x and d - dt.timedelta(days=6) <= x <= d)
            want.append((w, d, on_hand, flow))
            d += dt.timedelta(days=1)
    assert rows(daily_position(changes, flows, ["w"], 7)) == sorted(want, key=str)
    assert daily_position(changes.limit(0), flows, ["w"], 7).collect() == []


def test_event_order_equals_brute_force(spark):
    rng = random.Random(9)
    events = [(rng.choice(["hot", "hot", "a", None]), rng.choice([None, f"{rng.randint(0, 40):02d}"]), rng.choice([None, 1, 2, 3])) for _ in range(400)]
    late = lambda k, t, s: None if t is None or s is None else int(any(
        a == k and b is not None and c is not None and c > s and b < t for a, b, c in events))
    df = spark.createDataFrame(events, "k string, t string, s int")
    assert rows(out_of_sequence(df, ["k"], "t", "s")) == sorted(((*e, late(*e)) for e in events), key=str)


# ---- surrogate keys

def test_surrogate_keys_are_dense_and_stay(spark, base, stage):
    schema = StructType.fromDDL("a string, b int, other string")
    keys = SurrogateKeys(spark, f"{base}/keys", schema, ["a", "b"], "id")
    given, naturals = {}, []
    for batch in ([("x", 1), ("x", None), ("m", 2), ("x", 1)], [("a", 0), ("x", 1), (None, None)], [], [("zz", 1)]):
        df = spark.createDataFrame([(*k, "o") for k in batch], schema)
        got = {(r["a"], r["b"]): r["id"] for r in keys.assign(df, stage).collect()}
        assert given.items() <= got.items() and sorted(got.values()) == list(range(1, len(got) + 1))
        naturals += batch
        assert set(got) == set(naturals)
        given = got
    assert keys.collisions().collect() == []
    spark.createDataFrame([("x", 1, 99), ("new", 5, 1)], keys.schema).write.parquet(f"{base}/keys/999999")
    assert {r["n"] for r in keys.collisions().collect()} == {2} and keys.collisions().count() == 2


# ---- mergeable distinct counts, thresholds, streams

def test_sketches_add_up_within_the_stated_error(spark):
    rng = random.Random(10)
    pairs = [(f"d{rng.randint(0, 9)}", rng.choice(["hot", "hot", "cold"]), f"v{rng.randint(0, 30_000)}") for _ in range(60_000)]
    pairs += [("d0", "few", v) for v in ("a", "b", "a", None)] + [("d1", "none", None)]
    df = spark.createDataFrame(pairs, "d string, k string, v string")
    stored = sketches.sketches(df, ["d", "k"], "v")
    got = {r["k"]: r["n"] for r in sketches.merged(stored, ["k"]).select("k", sketches.estimate().alias("n")).collect()}
    exact = {k: len({v for _, q, v in pairs if q == k and v is not None}) for k in ("hot", "cold", "few", "none")}
    assert got["few"] == 2 and got["none"] == 0
    for k in ("hot", "cold"):
        assert abs(got[k] - exact[k]) <= 4 * sketches.STANDARD_ERROR * exact[k]


def test_finding_counts_are_kept_and_repeated_runs_change_nothing(spark, base):
    counts = monitoring.FindingCounts(spark, f"{base}/counts")
    sizes = spark.createDataFrame([("fct_shipments", 100), ("fct_sales_orders", 50)], "source_model string, n_rows long")
    schema = "policy string, source_model string, issue_type string, n_findings long"
    one = spark.createDataFrame([("quarantine", "fct_shipments", "unknown_order", 4), ("preserve_and_flag", "fct_sales_orders", "x", 1)], schema)
    two = spark.createDataFrame([("quarantine", "fct_shipments", "unknown_order", 5), ("preserve_and_flag", "fct_sales_orders", "x", 3),
                                 ("document", "nowhere", "y", 1)], schema)
    counts.record("r1", one, sizes)
    counts.record("r2", two, sizes)
    report = lambda run: {r["issue_type"]: (r["domain"], r["share"], r["limit"], r["previous_share"], r["is_over_limit"], r["is_growing"])
                          for r in counts.report(run).collect()}
    want = {"unknown_order": ("logistics", 0.05, 0.05, 0.04, 0, 0), "x": ("sales", 0.06, 0.05, 0.02, 1, 1),
            "y": ("other", None, 0.0, None, 1, 0)}
    assert report("r2") == want
    counts.record("r2", two, sizes)
    assert report("r2") == want
    assert report("r1")["x"] == ("sales", 0.02, 0.05, None, 0, 0) and report("r9") == {}


def test_stream_equals_batch_and_late_events_are_kept(spark, base):
    schema = "shipment_id string, event_timestamp string, event_type string"
    rows_of = [[("s1", "2024-01-01 10:00:00", "a"), ("s1", "2024-01-01 12:00:00", "a"), ("s2", "2024-01-01 09:00:00", "b")],
               [("s1", "2024-01-01 11:00:00", "a"), ("s2", "2024-01-01 13:30:00", "b"), ("s3", None, "a")],
               [("s1", "2024-01-01 12:00:00", "a"), ("s3", "2024-01-01 08:00:00", "a")]]
    table = UpsertTable(spark, f"{base}/t", StructType.fromDDL(schema), ["shipment_id", "event_type"],
                        [By("event_timestamp", desc=True)], F.col("event_type"))
    for n, part in enumerate(rows_of):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{base}/landed")
        stream = spark.readStream.schema(schema).parquet(f"{base}/landed")
        got, late = latest.take_in_landed(spark, stream, lambda df: df, table, f"{base}/run", "event_timestamp", 3600)
    best = {}
    for part in rows_of:
        for s, t, e in part:
            best[s, e] = max(best.get((s, e), ""), t or "")
    assert rows(got) == sorted(((s, t or None, e) for (s, e), t in best.items()), key=str)
    # behind 13:30 by more than an hour when they came in (11:00 came when 12:00 was the greatest time)
    assert rows(late) == [("s1", "2024-01-01 12:00:00", "a"), ("s3", "2024-01-01 08:00:00", "a")]


def test_queries_with_state_start_anew(spark):
    """Running a query again in one session gives the same rows (its table is its own)."""
    import __spark_entry__ as entry
    from conftest import SF_SMALL
    queries = entry.library_queries()
    for name in ("product_history", "surrogate_product_keys", "streamed_latest_events"):
        assert rows(queries[name](spark, SF_SMALL)) == rows(queries[name](spark, SF_SMALL))
