"""Operator 9, personal data by boosted candidates.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. Generators of high recall propose
further, overlapping spans; boosted trees score each by its format and context, a calibration turns the
score into a share of true cases, and spans above a threshold are added. Only DataFrame functions
and the trees of ``pyspark.ml``.

There are no labelled spans, so the trees learn from the base patterns: a proposed span that a valid base match of its
kind explains is a positive, and so are its rewritten forms (plus dropped, other separators, shorter cards); one that
fails a hard check (``plausible``) is a negative and is never added. All others are unlabelled, so how often a format
occurs that the base patterns miss does not count against it. Checksums are no feature; of numbers that fail the checksum
of cards there are nine for each that passes by chance, so each weighs a ninth.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.session import staged

# Fixed values of the contract: base kinds in order. Possessive quantifiers and the look-behind only keep
# Java's matcher linear and its stack flat; they match the same spans, leftmost and without overlap.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Generators of candidates: wider than the base patterns.
GENERATORS = {
    "email": r"[^\s@<>()\[\],;:]++@[^\s@<>()\[\],;:]++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:[.:][0-9]++){3,}+",
    "card": r"[0-9](?:[\x20.-]{0,2}+[0-9]){11,}+",
    "phone": r"[+(]?[0-9](?:[\x20().-]{0,3}+[0-9]){6,}+",
}
#: What a text must contain for a pattern to be tried at all.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": None}
FEATURES = ["chars", "digits", "letters", "separators", "digit_share", "dots", "longest_run", "before_space", "after_space",
            "before_alnum", "after_alnum", "is_email", "is_ip", "is_card", "is_phone"]
TRAIN_ROWS = 20_000
CONTEXT = 24
THRESHOLD = 0.9


def matches(text: str, pattern: str) -> Column:
    """All matches as structs (start, end, value) in code points: leftmost, without overlap."""
    gaps, values = F.split(F.col(text), pattern, -1), F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(m["g"])
        end = start + F.length(m["v"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), m["v"].alias("value")))).alias("out"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(values)), values, lambda g, v: F.struct(g.alias("g"), v.alias("v")))
    return F.when(F.size(values) > 0, F.aggregate(pairs, zero, step)["out"]).otherwise(zero["out"])


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a valid check digit."""
    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * (i % 2 + 1)
        return F.when(d > 9, d - 9).otherwise(d)

    backwards = F.filter(F.split(F.reverse(number), ""), lambda c: c != "")
    return F.aggregate(F.transform(backwards, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        # Longer parts than nine digits may be all zeros in front.
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3) & (F.coalesce(F.right(F.concat(F.lit("000"), p), F.lit(3)).cast("int"), F.lit(999)) <= 255))
    if kind == "card":
        return F.length(digits(value)).between(16, 19) & luhn(digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    return F.lit(True)


def plausible(kind: Column, value: Column, before: Column, after: Column) -> Column:
    """Whether a proposed span passes the hard checks of its kind."""
    number = digits(value)
    inside = before.rlike("[0-9A-Za-z]$") | after.rlike("^[0-9A-Za-z]")
    dated = value.rlike(r"^(19|20)[0-9]{2}[\x20.-]+[0-9]{1,2}[\x20.-]+[0-9]{1,2}([^0-9]|$)") | value.rlike(r"^[0-9]{1,3}([\x20.][0-9]{3})+$")
    grouped = value.rlike(r"^[+(]") | value.rlike("[0-9][^0-9]+[0-9]+[^0-9]+[0-9]")
    checks = {
        "email": value.rlike(r"@[^@]*[^@.]\.[^@.]"),
        "ip": ~inside & value.rlike(r"^[0-9]+(\.[0-9]+){3}$") & valid("ip", value),
        "card": ~inside & F.length(number).between(12, 19) & luhn(number),
        "phone": ~inside & valid("phone", value) & grouped & ~dated & ~value.rlike("[^0-9][0-9]([^0-9]|$)"),
    }
    passed = F.lit(False)
    for i, k in enumerate(KINDS):
        passed = F.when(kind == i, checks[k]).otherwise(passed)
    return passed


def _rewritten(kind: Column, value: Column) -> Column:
    """The value of a true case, and forms of it that the base patterns miss."""
    number = digits(value)
    stem = F.substring(number, 1, 14)
    last = F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(stem, d.cast("string"))), luhn)
    short = F.get(last, 0)
    in_groups = lambda n, sep: F.regexp_replace(n, "^([0-9]{4})([0-9]{4,6})([0-9]{4})?([0-9]{4,5})$", f"$1{sep}$2{sep}$3$4")
    parts = lambda n, shape: F.regexp_replace(F.right(n, F.lit(10)), "^([0-9]{2,3})([0-9]{3})([0-9]{3,4})$", shape)
    dotted = F.regexp_replace(number, "([0-9]{4})(?=[0-9])", "$1.")
    cards = [value, dotted, short, in_groups(short, " "), in_groups(short, "-"), in_groups(short, ".")]
    phones = [value, F.regexp_replace(value, r"^\+[0-9]+[\x20.-]*(?=\()", ""), F.regexp_replace(value, r"^\+", ""), *[parts(number, x) for x in ("($1) $2-$3", "($1)$2-$3", "$1-$2-$3", "$1.$2.$3", "$1 $2 $3")]]
    forms = {"email": [value, F.concat(F.lit("ü"), value)], "ip": [value], "card": cards, "phone": phones}
    out = F.array(value)
    for i, k in enumerate(KINDS):
        out = F.when(kind == i, F.array_distinct(F.array(*forms[k]))).otherwise(out)
    return out


def _tagged(text: str, kind: str, pattern: str, base: bool) -> Column:
    """Matches as (kind, start, end, value, before, after); only where the text can have any."""
    around = lambda m: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"),
        F.substring(F.col(text), F.greatest(m["start"] - CONTEXT, F.lit(0)) + 1, F.least(m["start"], F.lit(CONTEXT))).alias("before"),
        F.substring(F.col(text), m["end"] + 1, F.lit(CONTEXT)).alias("after"), F.lit(base).alias("base"),
    )
    found = matches(text, pattern)
    if base:
        found = F.filter(found, lambda m: valid(kind, m["value"]))
    may = F.col("_digit") if kind != "email" else F.contains(F.col(text), F.lit("@"))
    if base and kind == "phone":
        may = F.contains(F.col(text), F.lit("+"))
    empty = F.array().cast("array<struct<kind:int,start:int,end:int,value:string,before:string,after:string,base:boolean>>")
    return F.when(may, F.transform(found, around)).otherwise(empty)


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, _text, found): base matches and proposed spans of each document row, in one scan."""
    read = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    read = read.select(key, "_t", F.xxhash64("_t").alias("_text"), F.col("_t").rlike("[0-9]").alias("_digit"))
    found = [_tagged("_t", k, PATTERNS[k], True) for k in KINDS] + [_tagged("_t", k, GENERATORS[k], False) for k in KINDS]
    none = F.array().cast("array<struct<kind:int,start:int,end:int,value:string,before:string,after:string,base:boolean>>")
    may = F.col("_digit") | F.contains("_t", F.lit("@"))
    return read.select(key, "_text", F.when(may, F.concat(*found)).otherwise(none).alias("found"))


def _described(spans: DataFrame) -> DataFrame:
    """Features of the format and of the borders of spans, as doubles. What else stands near is the manner of a source, not a mark of a kind."""
    value = F.col("value")
    count = lambda pattern, of=value: F.length(of) - F.length(F.regexp_replace(of, pattern, ""))
    runs = F.transform(F.split(value, "[^0-9]+"), lambda p: F.length(p))
    shapes = {
        "chars": F.length(value), "digits": count("[0-9]"), "letters": count("[A-Za-z]"), "separators": count("[^0-9A-Za-z]"),
        "digit_share": count("[0-9]") / F.greatest(F.length(value), F.lit(1)), "dots": count(r"\."), "longest_run": F.array_max(runs),
        "before_space": F.col("before").rlike(r"(^|\s)$"), "after_space": F.col("after").rlike(r"^(\s|$)"),
        "before_alnum": F.col("before").rlike("[0-9A-Za-z]$"), "after_alnum": F.col("after").rlike("^[0-9A-Za-z]"),
    }
    shapes |= {f"is_{k}": F.col("kind") == i for i, k in enumerate(KINDS)}
    return spans.select("*", *[shapes[f].cast("double").alias(f) for f in FEATURES])


def _fit(described: DataFrame, rows: int) -> tuple[GBTClassificationModel | None, list[tuple[float, float]]]:
    """Trees on half of a bounded sample of labelled spans; on the other half, the share of true cases by score, made monotone."""
    columns = ["kind", "value", "before", "after", "label"]
    labelled = described.withColumn("label", F.when(F.col("same"), 1.0).when(~F.col("explained") & ~F.col("passes"), 0.0))
    labelled = labelled.where("label IS NOT NULL").select(*columns).distinct()
    drawn = labelled.orderBy(F.xxhash64("value", "before"), "value", "before", "after", "kind").limit(rows).withColumn("half", F.pmod(F.xxhash64("value"), F.lit(2)))
    forms = F.when(F.col("label") == 1, _rewritten(F.col("kind"), F.col("value"))).otherwise(F.array("value"))
    chance = (F.col("label") == 0) & (F.col("kind") == KINDS.index("card")) & F.length(digits(F.col("value"))).between(12, 19)
    drawn = drawn.withColumn("value", F.explode(forms)).withColumn("weight", F.when(chance, 1 / 9).otherwise(1.0))
    sample = staged(_described(drawn).select(*FEATURES, "label", "half", "weight"))
    counts = {(r["half"], r["label"]): r["count"] for r in sample.groupBy("half", "label").count().collect()}
    if any(not counts.get((h, float(y))) for h in (0, 1) for y in (0, 1)):
        return None, []
    vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
    model = GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.3, seed=5, weightCol="weight").fit(vector.transform(sample.where("half = 0")).coalesce(1))
    scored = model.transform(vector.transform(sample.where("half = 1")))
    steps = F.floor(vector_to_array("probability")[1] * 20) / 20
    table = scored.groupBy(steps.alias("s")).agg(F.sum(F.col("label") * F.col("weight")).alias("y"), F.sum("weight").alias("n")).orderBy("s").collect()
    blocks: list[list[float]] = []
    for r in table:  # at most 21 steps; neighbours that fall are pooled
        blocks.append([float(r["s"]), float(r["y"]), float(r["n"])])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            _, y, n = blocks.pop()
            blocks[-1][1] += y
            blocks[-1][2] += n
    return model, [(s, y / n) for s, y, n in blocks]


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(key, _text, spans) for each document row; spans: array of (kind, start, end, base), sorted by kind and start.

    Offsets are code points, the end exclusive. Base spans always stay; an added span overlaps no base span,
    and of overlapping added ones the best stays (then the longer, then the first). Null texts are empty; repeated rows each
    get their row; ``_text`` tells documents with one key apart. If the corpus has too few candidates of either
    sort to train on, nothing is added.
    """
    found = staged(candidates(docs, key, text))
    spans = found.where("size(found) > 0").select(F.col(key).alias("_key"), "_text", "found").distinct()
    base = F.filter("found", lambda s: s["base"])
    covers = lambda s, b: (s["start"] < b["end"]) & (b["start"] < s["end"])
    proposed = F.transform(
        F.filter("found", lambda s: ~s["base"]),
        lambda s: F.struct(
            s.alias("s"), F.exists(base, lambda b: covers(s, b)).alias("explained"),
            F.exists(base, lambda b: covers(s, b) & (s["kind"] == b["kind"])).alias("same"),
        ),
    )
    described = staged(_described(spans.select("_key", "_text", F.explode(proposed).alias("p")).select("_key", "_text", "p.s.*", "p.explained", "p.same")).withColumn("passes", plausible(*map(F.col, ("kind", "value", "before", "after")))))
    model, calibration = _fit(described, train_rows)
    fresh = described.where("NOT explained AND passes")
    if model is None:
        fresh = fresh.where("false").withColumn("share", F.lit(0.0))
    else:
        fresh = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(fresh))
        raw = vector_to_array("probability")[1]
        share = F.lit(0.0)
        for low, value in calibration:
            share = F.when(raw >= low, F.lit(value)).otherwise(share)
        fresh = fresh.withColumn("share", share).where(F.col("share") >= threshold)
    best = F.sort_array(F.collect_list(F.struct(-F.col("share"), F.col("start") - F.col("end"), F.col("start").alias("start"), F.col("end").alias("end"), F.col("kind").alias("kind"))))
    none = F.array().cast("array<struct<kind:int,start:int,end:int,base:boolean>>")
    taken = F.aggregate(
        best, none,
        lambda acc, s: F.when(F.exists(acc, lambda a: covers(s, a)), acc).otherwise(
            F.concat(acc, F.array(F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(False).alias("base"))))
        ),
    )
    added = fresh.groupBy("_key", F.col("_text").alias("_hash")).agg(taken.alias("added"))
    kept = F.transform(base, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")))
    rows = found.select(key, "_text", kept.alias("base"))
    joined = rows.join(added, rows[key].eqNullSafe(F.col("_key")) & (rows["_text"] == F.col("_hash")), "left")
    return joined.select(key, "_text", F.sort_array(F.concat("base", F.coalesce("added", none))).alias("spans"))


def redacted(text: str, spans: str) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans one mark stays."""
    ordered = F.sort_array(F.transform(F.col(spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    mark = lambda s: F.concat(F.lit("["), F.upper(F.get(F.array(*map(F.lit, KINDS)), s["kind"])), F.lit("]"))

    def step(acc: Column, s: Column) -> Column:
        apart = F.concat(F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"]), mark(s))
        piece = F.when(s["start"] >= acc["at"], apart).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))

    done = F.aggregate(ordered, zero, step)
    rest = lambda d: F.substring(F.col(text), d["at"] + 1, F.length(F.col(text)))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(done["out"], ""), rest(done))).otherwise(F.col(text))
