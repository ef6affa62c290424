"""Operator 6: personal data by candidate gradient boosting, in DataFrame functions only.

Base spans come from four fixed patterns with their checks (address parts, the
card checksum, digit counts). High-recall generators propose further,
overlapping candidates: strictly cut cards, phones and addresses (which base
patterns lose when they stand side by side), spelled-out mail addresses and
secret-like tokens. Gradient-boosted trees (``pyspark.ml``) score each from
its format and context, and per generator the least threshold that reaches
``PRECISION`` on the candidates of all documents not trained on selects what is
added. A selected
candidate that overlaps a base span is not added; base spans always stay.

Labels are the checks themselves (a well-formed number, address or key is
positive), so nothing is annotated by hand. Training uses the candidates of half
a sample of about ``SAMPLE_DOCS`` documents (all, if there are fewer), those of
the least hashes; its size does not shrink with the corpus. The trees become
column expressions, so detection is one narrow projection over the whole texts:
no shuffle, no Python on executors.

The patterns start a match only at the start of its run or where the last
match ended, and repeat possessively. Both leave the leftmost matches
unchanged and keep the search linear on long runs.

Defined cases: null text is empty; a text without data has zero counts, the
SHA-256 of the empty string and empty spans; a very long text is searched in
one pass (32,000 matches take seconds); spans of one start go in order of kind;
repeated rows give repeated rows; without positive or without negative candidates nothing is added; an empty
table gives an empty result; other columns are ignored (``redact`` keeps them).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: base patterns (fixed values of the contract, with linear starts and possessive repeats), in the order of kinds
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*BASE, "secret"]
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: high-recall generators by the kind they propose
GENERATORS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++"
             r"(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z.-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9A-Za-z])",
    "phone": r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9A-Za-z])",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]{0,40}[0-9])[A-Za-z0-9+/_-]{16,}+",
}
KEYWORD = r"(?i)(?:pass(?:word|wd)?|token|secret|api.?key|key|auth)\W{0,4}$"
CONTEXT = 24

SAMPLE_DOCS, TREES, DEPTH, PRECISION = 20_000, 8, 3, 0.99

SPANS = "array<struct<start:int,end:int,value:string>>"
#: spans that one step of a fold may copy
RUN = 128


def _text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def located(matches: Column, between: Column) -> Column:
    """Code-point spans of all matches: lengths of matches and of the text between them, added up.

    Both lists are columns, not part of the folded state, which every step copies; spans are gathered in runs of
    ``RUN`` and the runs in a list, so that no step copies more than a run or the list.
    """
    none = F.array().cast(SPANS)

    def add(acc: Column, k: Column) -> Column:
        value = F.get(matches, k)
        start = acc["at"] + F.length(F.get(between, k))
        end = start + F.length(value)
        span = F.struct(start.alias("start"), end.alias("end"), value.alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def run(acc: Column, first: Column) -> Column:
        last = F.least(first + (RUN - 1), F.size(matches) - 1)
        at = F.when(F.size(acc) > 0, F.element_at(F.element_at(acc, -1), -1)["end"]).otherwise(F.lit(0))
        own = F.aggregate(F.sequence(first, last), F.struct(at.alias("at"), none.alias("spans")), add,
                          lambda own: own["spans"])
        return F.concat(acc, F.array(own))

    walked = F.flatten(F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1, F.lit(RUN)),
                                   F.array().cast(f"array<{SPANS}>"), run))
    return F.when(F.size(matches) > 0, walked).otherwise(none)


def _matches(text: Column, pattern: str, needs: str) -> Column:
    """All matches; texts without a sign that every match needs are not searched."""
    found = F.when(text.rlike(needs), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.coalesce(found, F.array().cast("array<string>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    """The check of a base match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}\z")
    digits = _digits(value)
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    return F.length(digits).between(9, 15)


def with_spans(docs: DataFrame, patterns: dict[str, str], prefix: str) -> DataFrame:
    """Adds a column of spans for each pattern."""
    needs = {k: "@|[(\\[]at[)\\]]" if k == "email" else "[0-9]" for k in patterns}
    found = docs.select("*", *[_matches(F.col("text"), p, needs[k]).alias(f"{prefix}_{k}_m")
                               for k, p in patterns.items()])
    cut = found.select("*", *[F.when(F.size(f"{prefix}_{k}_m") > 0, F.split("text", p, -1)).alias(f"{prefix}_{k}_b")
                              for k, p in patterns.items()])
    return cut.select(*docs.columns, *[located(F.col(f"{prefix}_{k}_m"), F.col(f"{prefix}_{k}_b")).alias(f"{prefix}_{k}")
                                       for k in patterns])


def with_base(docs: DataFrame) -> DataFrame:
    """Adds ``base_<kind>``: the spans whose match passes its check."""
    rows = with_spans(docs, BASE, "base")

    def checked(kind: str) -> Column:
        return F.filter(f"base_{kind}", lambda s: valid(kind, s["value"]))

    return rows.withColumns({f"base_{k}": checked(k) for k in BASE})


# ---------------------------------------------------------------- features

def _count(value: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{kept}]", "")).cast("double")


def features(kind: str, value: Column, before: Column, after: Column) -> dict[str, Column]:
    """Format and context of a candidate, as doubles."""
    digits = _digits(value)
    flag = lambda c: c.cast("double")
    return {
        "kind": F.lit(float(KINDS.index(kind))),
        "length": F.length(value).cast("double"),
        "digits": _count(value, "0-9"),
        "upper": _count(value, "A-Z"),
        "lower": _count(value, "a-z"),
        "hex_only": flag(value.rlike(r"^[0-9a-f]+\z")),
        "dots": _count(value, "."),
        "at": _count(value, "@"),
        "checksum": flag(F.length(digits).between(1, 19) & F.call_function("luhn_check", digits)),
        "octets": flag(value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}\z")),
        "plus": flag(value.startswith("+")),
        "key_id": flag(value.rlike(r"^[A-Z]{4}[0-9A-Z]{16}\z")),
        "keyword_before": flag(before.rlike(KEYWORD)),
        "quoted": flag(before.endswith('"') & after.startswith('"')),
        "digit_before": flag(before.rlike(r"[0-9][ -]?\z")),
        "digit_after": flag(after.rlike("^[ -]?[0-9]")),
        "word_ending": flag(value.rlike(r"\.[A-Za-z]{2,}\z")),
    }


FEATURES = ["kind", "length", "digits", "upper", "lower", "hex_only", "dots", "at", "checksum", "octets", "plus",
            "key_id", "keyword_before", "quoted", "digit_before", "digit_after", "word_ending"]


def weak_label(kind: str, f: Column) -> Column:
    """Distant supervision from a candidate's own checks."""
    return {"email": (f["word_ending"] > 0),
            "ip": (f["octets"] > 0),
            "card": (f["checksum"] > 0),
            "phone": f["digits"].between(9, 15),
            "secret": (f["key_id"] > 0) | (f["keyword_before"] > 0) | ((f["hex_only"] > 0) & (f["length"] >= 32)),
            }[kind].cast("double")


def with_candidates(docs: DataFrame) -> DataFrame:
    """Adds ``cand_<kind>``: (start, end, value, features) of every generated candidate."""
    rows = with_spans(docs, GENERATORS, "cand")

    def described(kind: str) -> Column:
        def one(s: Column) -> Column:
            before = F.substring(F.col("text"), F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1,
                                 F.least(s["start"], F.lit(CONTEXT)))
            after = F.substring(F.col("text"), s["end"] + 1, F.lit(CONTEXT))
            f = F.struct(*[c.alias(n) for n, c in features(kind, s["value"], before, after).items()])
            return F.struct(s["start"].alias("start"), s["end"].alias("end"), f.alias("f"))
        return F.transform(f"cand_{kind}", one)

    return rows.withColumns({f"cand_{k}": described(k) for k in GENERATORS})


# ---------------------------------------------------------------- boosted trees

@dataclass(frozen=True)
class Model:
    trees: tuple            # nested (feature, threshold, left, right) or a leaf's value
    weights: tuple[float, ...]
    thresholds: dict        # generator -> least score that is selected

    def score(self, f: Column) -> Column:
        """Probability of a candidate with features ``f``."""
        def value(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            name, threshold, left, right = node
            return F.when(f[name] <= threshold, value(left)).otherwise(value(right))
        margin = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights):
            margin = margin + value(tree) * weight
        return 1 / (1 + F.exp(-2 * margin))


def _parse(lines: list[str]):
    """One tree of ``toDebugString``: nested If/Else lines over features, and Predict leaves."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return float(line.split(":")[1])
    number, threshold = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    left = _parse(lines)
    lines.pop(0)
    return FEATURES[int(number)], float(threshold), left, _parse(lines)


def candidate_table(docs: DataFrame) -> DataFrame:
    """One row per candidate: generator, label and features."""
    def named(kind: str) -> Column:
        return F.transform(f"cand_{kind}", lambda s: F.struct(F.lit(kind).alias("generator"), s["f"].alias("f")))

    table = with_candidates(docs).select(F.explode(F.concat(*[named(k) for k in GENERATORS])).alias("c")).select("c.*")
    label = F.coalesce(*[F.when(F.col("generator") == k, weak_label(k, F.col("f"))) for k in GENERATORS])
    return table.select("generator", label.alias("label"), *[f"f.{n}" for n in FEATURES])


def in_sample(share: float) -> Column:
    """Rows with the least hashes: about ``share`` of all, however many there are."""
    border = min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))
    return F.xxhash64("doc_id", "text") <= F.lit(border)


def learn(docs: DataFrame) -> Model | None:
    """Trees from a sample's candidates, thresholds from all others'; None where only one label occurs.

    Half of the sample (by another hash) is trained on. The candidates of all documents that are not are scored and
    counted by generator, score and label, a small map-side aggregate, so a kind that is rare is judged by all its
    candidates.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    spark = docs.sparkSession
    rows = _text(docs)
    trained = in_sample(SAMPLE_DOCS / max(1, rows.count())) & (
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0)
    from .common import Workspace
    train = Workspace(spark, "pii").stage(candidate_table(rows.where(trained)), "candidates")
    if train.select("label").distinct().count() < 2:
        return None
    vector = VectorAssembler(inputCols=FEATURES, outputCol="x")
    gbt = GBTClassifier(featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.5, seed=7)
    fitted = gbt.fit(vector.transform(train).select("x", "label").coalesce(8))
    trees = tuple(_parse(t.toDebugString.strip().splitlines()[1:]) for t in fitted.trees)
    model = Model(trees, tuple(fitted.treeWeights), {})
    scored = candidate_table(rows.where(~trained)).select(
        "generator", "label", F.round(model.score(F.struct(*FEATURES)), 4).alias("score"))
    # a few distinct scores per generator: leaves of TREES small trees, rounded
    counts = scored.groupBy("generator", "score").agg(F.count("*").alias("n"), F.sum("label").alias("good")).collect()
    thresholds = {}
    for kind in GENERATORS:
        n = good = 0
        for r in sorted((r for r in counts if r["generator"] == kind), key=lambda r: -r["score"]):
            n, good = n + r["n"], good + r["good"]
            if good / n >= PRECISION and r["score"] >= 0.5:
                thresholds[kind] = r["score"]
    return Model(trees, model.weights, thresholds)


# ---------------------------------------------------------------- detection

ALL = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _ranked(kind: str, spans: Column) -> Column:
    rank = KINDS.index(kind)
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"),
                                                 s["end"].alias("end"), F.lit(kind).alias("kind")))


def with_all_spans(docs: DataFrame, model: Model | None) -> DataFrame:
    """Adds ``base`` and ``spans``: ordered (start, rank, end, kind) of the base and of all selected spans."""
    keep = docs.columns
    rows = with_base(docs)
    base = F.array_sort(F.concat(*[_ranked(k, F.col(f"base_{k}")) for k in BASE]))
    rows = rows.withColumn("base", base)
    if model is None or not model.thresholds:
        return rows.withColumn("spans", F.col("base"))
    kinds = [k for k in GENERATORS if k in model.thresholds]
    rows = with_candidates(rows)

    def chosen(kind: str) -> Column:
        clear = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return F.filter(F.filter(f"cand_{kind}", clear),
                        lambda s: F.round(model.score(s["f"]), 4) >= model.thresholds[kind])

    added = F.concat(*[_ranked(k, chosen(k)) for k in kinds])
    return rows.withColumn("spans", F.array_sort(F.array_distinct(F.concat("base", added)))).select(
        *keep, *[f"base_{k}" for k in BASE], "base", "spans")


def _joined(spans: str) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def personal_data(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document: base counts and digest, and all spans as ``kind:start:end`` (code points, end exclusive)."""
    rows = with_all_spans(_text(docs), model)
    return rows.select("doc_id", *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in BASE],
                       F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
                       _joined("spans").alias("spans"),
                       (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def redact(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets; a null text stays null.

    Overlapping spans become one placeholder, that of the first.
    """
    names = docs.columns
    rows = with_all_spans(docs.select(*[F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
                                        if n == "text" else F.col(n).alias(f"own_{i}") for i, n in enumerate(names)],
                                      F.col("text").isNull().alias("missing")), model)

    def put(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        piece = F.concat(acc["out"], gap, F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        new = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(new, piece).otherwise(acc["out"]).alias("out"))

    rest = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), put,
                       lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    text = F.when(~F.col("missing"), F.when(F.size("spans") > 0, rest).otherwise(F.col("text")))
    return rows.select(*[text.alias("text") if n == "text" else F.col(f"own_{i}").alias(n)
                         for i, n in enumerate(names)])
