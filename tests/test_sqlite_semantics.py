"""Casts and day differences against SQLite itself on random dirty text.

The source project runs on SQLite; Python's sqlite3 module is that engine, so
each Spark expression is compared with SQLite's own CAST / julianday results
(the SQLite expressions below restate each rule's definition).
"""

import random
import sqlite3

from pyspark.sql import functions as F

from kiln.functions import casts, dates

ALPHABET = "0123456789+-.,eEaX$ \t"

# each rule stated in SQLite terms: blank handling, then SQLite's own CAST
SQLITE_RULES = {
    "strict_int": "case when nullif(trim(x), '') is null then null "
                  "when trim(x) <> cast(cast(trim(x) as integer) as text) then null else cast(x as integer) end",
    "positive_int": "case when x is null or trim(x) = '' then null "
                    "when cast(x as integer) > 0 then cast(x as integer) end",
    "alpha_reject_real": "case when nullif(trim(x), '') is null then null "
                         "when trim(x) glob '*[A-Za-z]*' then null else cast(x as real) end",
    "positive_real": "case when x is null or trim(x) = '' then null when cast(x as real) > 0 then cast(x as real) end",
    "unguarded_int": "cast(x as integer)",
}


def _samples(n=4000, seed=11):
    rnd = random.Random(seed)
    out = [None, "", " ", "\t"]
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(1, 7))))
    for _ in range(200):  # around and beyond 64 bits
        out.append(rnd.choice(["", "-", "+", " "]) + str(rnd.choice([2**63, 10**20, 9 * 10**18]) + rnd.randint(-2, 2))
                   + rnd.choice(["", "abc", ".5"]))
    return out


def test_casts_agree_with_sqlite(spark):
    samples = _samples()
    con = sqlite3.connect(":memory:")
    con.execute("create table t(i integer, x text)")
    con.executemany("insert into t values (?, ?)", list(enumerate(samples)))
    want = {name: [r[0] for r in con.execute(f"select {sql} from t order by i")]
            for name, sql in SQLITE_RULES.items()}
    df = spark.createDataFrame(list(enumerate(samples)), "i int, x string")
    got_rows = df.orderBy("i").select(*[getattr(casts, n)(F.col("x")).alias(n) for n in SQLITE_RULES]).collect()
    for name in SQLITE_RULES:
        got = [r[name] for r in got_rows]
        bad = [(s, g, w) for s, g, w in zip(samples, got, want[name])
               if not (g == w or (isinstance(g, float) and isinstance(w, float) and abs(g - w) <= 1e-12 * abs(w)))]
        assert not bad, f"{name}: {len(bad)} differences, e.g. {bad[:5]}"


def test_day_diff_agrees_with_julianday(spark):
    rnd = random.Random(5)
    pairs = []
    for _ in range(3000):
        def ts():
            kind = rnd.random()
            if kind < 0.15:      # Julian day numbers
                return rnd.choice([str(rnd.randint(0, 5400000)), f"{rnd.uniform(2440000, 2470000):.5f}", " 2450000.5 ",
                                   "5373484.5", "-1", "2.45e6", ".5"])
            d = f"{rnd.choice([0, 1582, 1990, 2024, 2100, rnd.randint(1970, 2030)]):04d}-{rnd.randint(0, 13):02d}" \
                f"-{rnd.randint(0, 32):02d}"
            if rnd.random() < 0.6:
                d = rnd.choice([d, d, d, ""]) + rnd.choice([" ", "T", "  "]) if rnd.random() < 0.95 else ""
                d = d.strip() and d
                d += f"{rnd.randint(0, 25):02d}:{rnd.randint(0, 60):02d}"
                if rnd.random() < 0.6:
                    d += f":{rnd.randint(0, 60):02d}" + rnd.choice(["", "", ".5", ".123456"])
                d += rnd.choice(["", "", "", "Z", "+02:00", " -05:30", "+15:00", " "])
            return d + rnd.choice(["", "", "", "", "x", " "])
        pairs.append((ts(), ts()))
    con = sqlite3.connect(":memory:")
    want = [con.execute("select julianday(?) - julianday(?)", (b, a)).fetchone()[0] for b, a in pairs]
    df = spark.createDataFrame([(i, b, a) for i, (b, a) in enumerate(pairs)], "i int, b string, a string")
    got = [r[0] for r in df.orderBy("i").select(dates.day_diff("b", "a")).collect()]
    bad = [(p, g, w) for p, g, w in zip(pairs, got, want)
           if (g is None) != (w is None) or g is not None and abs(g - w) >= 1e-6]
    assert sum(w is not None for w in want) > 300 and not bad, (len(bad), bad[:5])
