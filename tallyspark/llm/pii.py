"""Personal data: generous candidates, boosted trees and calibrated thresholds.

Patterns propose spans, which may overlap.  E-mail addresses, IPv4 addresses, card and phone
numbers that pass their checks (the *base* spans) always count.  Further spans - secrets,
bare numbers, disguised addresses, IPv6 - count if boosted trees over a span's format and the signs next to it
give them a probability above their kind's threshold.  The trees learn from evidence they do not see: a candidate is taken
for right if the words before it say so (an assignment to a key or an issuer's prefix, a word of calling, of writing, of
networks), and no feature reads these words.  So what is learned is how such values look, and values without a word before them are found as well.

The trees are fitted on all candidates.  Two more fits, each on one half of them, judge the other half, and so all candidates
set each kind's threshold: the lowest at which nine of ten of the kind are right; a kind that never gets there, or is never said to be right, is not added.  Of added spans that overlap in a chain the likeliest stays; those that overlap a base span go.

Only built-in expressions and Spark's own trees run.  Places come from running sums of the
lengths between matches, so a text with very many matches costs time in proportion.

Defined results: a null text is empty; documents without spans have counts of 0 and empty ``spans``;
repeated rows are judged one by one; without both kinds of labels no span is added.
"""

from __future__ import annotations

import functools

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import written

PRECISION = 0.9
BINS = 50
CONTEXT, AFTER = 24, 8

BASE = ["email", "ip", "card", "phone"]
# Fixed values.  A match may begin inside a run of its characters only where the match before it ended;
# possessive repeats change no match, as what follows them is not in the repeated class.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_/+-])(?:AKIA[A-Z0-9]{16}(?![A-Za-z0-9_/+-])|(?=[A-Za-z_/+-]*+[0-9])[A-Za-z0-9_/+-]{12,}+)",
    "number": r"(?<![0-9])[0-9](?:[ ./-]?[0-9]){6,}+",
    "mail_like": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]|(?<= )at(?= )) ?[A-Za-z0-9-]++(?:\.| ?(?:\(dot\)|\[dot\]|(?<= )dot(?= )) ?)[A-Za-z]{2,}+",
    "ip6": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
}
KINDS = list(PATTERNS)
# What the words before a candidate say; no feature reads them.
EVIDENCE = {
    "secret": r"(?i)(?:password|passwd|pwd|secret|token|key)\s*[=:]\s*[\"']?$",
    "number": r"(?i)(?:tel|phone|call|fax|mobil|dial|reach)[^\n]{0,16}$",
    "mail_like": r"(?i)(?:mail|contact|write|reach|send)[^\n]{0,16}$",
    "ip6": r"(?i)(?:\bip|host|server|addr|network|gateway|ping)[^\n]{0,16}$",
}
ISSUED = r"^AKIA[A-Z0-9]{16}$"
ADDED = list(EVIDENCE)

FEATURES = [
    "kind_index", "length", "digits", "digit_share", "upper_share", "lower_share", "hex_share", "separators",
    "distinct_share", "luhn", "touches", "quoted",
]


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check; false for others."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda c: F.try_to_number(c, F.lit("9")).cast("int"))
    terms = F.transform(numbers, lambda x, i: F.when(i % 2 == 0, x).otherwise(2 * x - F.when(x > 4, 9).otherwise(0)))
    total = F.aggregate(terms, F.lit(0), lambda a, b: a + b)
    return F.coalesce(F.when(F.length(digits) > 0, total % 10 == 0), F.lit(False))


def passes(kind: Column, value: Column) -> Column:
    """Whether a match of a base kind passes the kind's check."""
    digits = digits_of(value)
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", small)
        .when(kind == "card", F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False))
        .when(kind == "phone", F.length(digits).between(9, 15))
        .otherwise(False)
    )


def _found(docs: DataFrame) -> DataFrame:
    """One row per document with all matches of all patterns: ``row``, ``doc_id``, ``found``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    has_digit = F.col("text").rlike("[0-9]")
    worth = {
        "email": F.col("text").contains("@"),
        "phone": F.col("text").contains("+"),
        "mail_like": F.col("text").contains(" at ") | F.col("text").contains("(at)") | F.col("text").contains("[at]"),
        "ip6": F.col("text").contains(":"),
        "secret": has_digit | F.col("text").contains("AKIA"),
    }
    cut = []
    for kind, pattern in PATTERNS.items():
        there = worth.get(kind, has_digit)
        cut.append(F.when(there, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias(f"{kind}_match"))
        cut.append(F.when(there, F.split("text", pattern, -1)).alias(f"{kind}_gap"))
    # Exploding one struct keeps the patterns from being run again for each match.
    held = rows.select("row", "doc_id", F.explode(F.array(F.struct(*cut))).alias("f"))

    def of_kind(kind: str) -> Column:
        match, gap = F.col(f"f.{kind}_match"), F.col(f"f.{kind}_gap")
        listed = F.transform(
            match,
            lambda value, i: F.struct(
                F.lit(kind).alias("kind"), i.alias("number"), F.length(F.get(gap, i)).alias("gap"), value.alias("value"),
                F.right(F.get(gap, i), F.lit(CONTEXT)).alias("before"), F.left(F.get(gap, i + 1), F.lit(AFTER)).alias("after"),
            ),
        )
        return F.coalesce(listed, F.array().cast("array<struct<kind:string,number:int,gap:int,value:string,before:string,after:string>>"))

    return written(held.select("row", "doc_id", F.concat(*map(of_kind, KINDS)).alias("found")), "pii-found")


def _spans(found: DataFrame) -> DataFrame:
    """One row per match with its place, whether it is a base span, and whether it touches one."""
    rows = found.select("row", F.explode("found").alias("f")).select("row", "f.*")
    running = Window.partitionBy("row", "kind").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(running).cast("int"))
    placed = placed.withColumns({"start": F.col("end") - F.length("value"), "base": passes(F.col("kind"), F.col("value"))})
    earlier = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    # From the last one on, so that each step adds one match.
    later = Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(earlier)
    following = F.min(F.when(F.col("base"), F.col("start"))).over(later)
    overlaps = F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(following < F.col("end"), F.lit(False))
    return written(placed.withColumn("overlaps", overlaps), "pii-spans")


def with_features(spans: DataFrame) -> DataFrame:
    """``spans`` with the columns of ``FEATURES`` and the weak label ``good``."""
    value, before, after = F.col("value"), F.col("before"), F.col("after")
    length = F.length(value)
    share = lambda chars: F.length(F.regexp_replace(value, f"[^{chars}]", "")) / length
    index = functools.reduce(lambda c, k: c.when(F.col("kind") == k[1], k[0]), list(enumerate(KINDS))[1:], F.when(F.col("kind") == KINDS[0], 0))
    columns = {
        "kind_index": index,
        "length": length,
        "digits": F.length(digits_of(value)),
        "digit_share": share("0-9"),
        "upper_share": share("A-Z"),
        "lower_share": share("a-z"),
        "hex_share": share("0-9a-f"),
        "separators": F.length(F.regexp_replace(value, "[A-Za-z0-9]", "")),
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / length,
        "luhn": F.when(F.length(digits_of(value)).between(12, 19), luhn(digits_of(value))).otherwise(False),
        "touches": before.rlike("[A-Za-z0-9]$") | after.rlike("^[A-Za-z0-9]"),
        "quoted": before.rlike("[\"']$") & after.rlike("^[\"']"),
    }
    made = spans.withColumns({name: F.coalesce(c.cast("double"), F.lit(0.0)) for name, c in columns.items()})
    said = functools.reduce(lambda c, k: c.when(F.col("kind") == k, before.rlike(EVIDENCE[k])), ADDED, F).otherwise(False)
    return made.withColumn("good", (said | ((F.col("kind") == "secret") & value.rlike(ISSUED))).cast("double"))


def candidates(spans: DataFrame) -> DataFrame:
    """The spans that may be added."""
    return spans.filter(~F.col("overlaps") & F.col("kind").isin(ADDED))


def fit(spans: DataFrame):
    """(model, threshold of each kind that may be added) from all candidates; None where they, or either half, have one label only."""
    every = with_features(candidates(spans).withColumn("place", F.xxhash64("row", "kind", "start")))
    every = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(every)
    half = (F.shiftright(F.col("place"), 8) % 2 == 0).alias("half")
    every = written(every.select(half, "kind", "good", "features"), "pii-candidates")
    halves = [every.filter("half"), every.filter("not half")]
    if every.select("half", "good").distinct().count() < 4:
        return None
    trees = GBTClassifier(labelCol="good", featuresCol="features", maxIter=12, maxDepth=4, stepSize=0.3, seed=7)
    judged = functools.reduce(DataFrame.union, [trees.fit(mine).transform(other) for mine, other in (halves, halves[::-1])])
    bins = (
        judged.groupBy("kind", F.floor(vector_to_array("probability")[1] * BINS).alias("bin"))
        .agg(F.sum("good").alias("good"), F.count("*").alias("n"))
        .collect()
    )
    return trees.fit(every), thresholds([(r["kind"], r["bin"], r["good"], r["n"]) for r in bins])


def thresholds(bins: list[tuple[str, int, float, int]]) -> dict[str, float]:
    """For each kind the lowest probability from which on, by kind, bin, right ones and all ones, enough are right."""
    found = {}
    for kind in ADDED:
        right = seen = 0.0
        for _, bin_, good, n in sorted((b for b in bins if b[0] == kind), key=lambda b: -b[1]):
            right, seen = right + good, seen + n
            if right >= PRECISION * seen:
                found[kind] = max(0.5, bin_ / BINS)
    return found


def likeliest(added: DataFrame) -> DataFrame:
    """Of each chain of overlapping spans the one with the greatest ``p``; then the first, then the kind listed first."""
    in_order = Window.partitionBy("row").orderBy("start", "end", "kind")
    reached = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = (F.col("start") >= F.coalesce(reached, F.lit(0))).cast("int")
    chained = added.withColumn("begins", begins).withColumn("chain", F.sum("begins").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.row_number().over(Window.partitionBy("row", "chain").orderBy(F.desc("p"), "start", "kind"))
    return chained.withColumn("best", best).filter("best = 1").drop("begins", "chain", "best")


def find(docs: DataFrame) -> DataFrame:
    """Spans of every row of ``docs``: ``doc_id`` and ``spans``, sorted structs of start, kind, end and base."""
    found = _found(docs)
    spans = _spans(found)
    chosen = spans.filter("base")
    trained = fit(spans)
    columns = ["row", "start", "kind", "end", "base"]
    if trained:
        model, limits = trained
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(candidates(spans))))
        limit = functools.reduce(lambda c, k: c.when(F.col("kind") == k, limits[k]), limits, F.when(F.lit(False), 2.0)).otherwise(2.0)
        added = likeliest(scored.withColumn("p", vector_to_array("probability")[1]).filter(F.col("p") >= limit).select(*columns, "p"))
        chosen = chosen.select(*columns).union(added.select(*columns))
    order = functools.reduce(lambda c, k: c.when(F.col("kind") == k[1], k[0]), list(enumerate(KINDS))[1:], F.when(F.col("kind") == KINDS[0], 0))
    span = F.struct("start", order.alias("kind_index"), "end", "kind", "base")
    per_row = chosen.select(*columns).groupBy(F.col("row").alias("span_row")).agg(F.sort_array(F.collect_list(span)).alias("spans"))
    none = F.array().cast(per_row.schema["spans"].dataType)
    joined = found.select("row", "doc_id").join(per_row, F.col("row") == F.col("span_row"), "left")
    return joined.select("doc_id", F.coalesce("spans", none).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of base spans of each kind, the digest of all base spans, and all ``spans``."""
    found = find(docs)
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[{}]") -> DataFrame:
    """``doc_id`` and ``text`` with every span replaced by its kind; overlapping spans become one, named by the first."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Numbered once and written: numbers made anew could fall on other rows.
    numbered = written(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text")), "pii-rows")
    spans = find(numbered.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "spans")
    rows = numbered.join(spans, "row")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def take(done: Column, s: Column) -> Column:
        shown = functools.reduce(lambda c, k: c.when(s["kind"] == k, mark.format(k)), KINDS[1:], F.when(s["kind"] == KINDS[0], mark.format(KINDS[0])))
        kept = F.concat(done["out"], F.substring("text", done["at"] + 1, s["start"] - done["at"]), shown)
        inside = s["start"] < done["at"]
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(inside, done["out"]).otherwise(kept).alias("out"))

    done = rows.select("doc_id", "text", F.aggregate("spans", start, take).alias("done"))
    return done.select("doc_id", F.concat("done.out", F.expr("substring(text, done.at + 1)")).alias("text"))
