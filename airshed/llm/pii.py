"""Personal data by boosted candidates.

Base patterns find what is certainly well formed. Wider generators propose further spans, which
may overlap; gradient-boosted trees judge each by its format and its context. The trees learn from
the candidates themselves: those that are base spans are examples, those of the same shape that
break a rule of the format are counterexamples. All of them count: three in four teach the trees,
on the others, which the trees have not seen, thresholds are calibrated, so that what is accepted
there is nearly always right.
Everything is DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import free_name, keyed
from airshed.session import settle

PRECISION = 0.98  # of what is accepted, on candidates set aside
CONTEXT = 24  # characters to the left that are looked at
SEED = 3

KINDS = ("email", "ip", "card", "phone")


@dataclass(frozen=True)
class Kind:
    """Patterns of a kind. ``needs``: text without which none of them, base or wide, can match.

    The patterns are written so that the engine never steps back further than a match is long, with
    the same matches as the plain form: a run that fails is left as a whole.
    """

    name: str
    base: str
    wide: str
    needs: str


_LOCAL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++"
_AT = r"(?:@|\x20?(?:\(at\)|\[at\]|\{at\})\x20?|\x20@\x20)"
_DOT = r"(?:\.|\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?)"
PATTERNS = (
    Kind("email", _LOCAL + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _LOCAL + _AT + r"[A-Za-z0-9-]++(?:" + _DOT + r"[A-Za-z0-9-]++)++", "(?i)@|at[)}\\]]"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"(?<![0-9.])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\[dot\]|\.)[0-9]{1,3}+){3}(?![0-9])", r"[0-9](?:\.|\[|\()"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){12,}+", r"(?<![0-9])[0-9]{4}+(?:[\x20./-]{1,3}[0-9]{2,7}+){2,4}(?![0-9])", r"[0-9][\x20-]?[0-9]"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"(?<![0-9+])(?:00[0-9]{1,3}[\x20.-]?|\([0-9]{2,5}\)[\x20./-]?|0[0-9]{2,4}[\x20./-])[0-9]{2,4}+(?:[\x20.-][0-9]{2,4}+){1,3}(?![0-9])", r"\+[0-9]|[0-9]{2}"),
)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass the Luhn test (of at most 19 digits)."""
    d = lambda i: F.substring(number, -i, 1).cast("int")
    total = F.lit(0)
    for i in range(1, 20):
        value = d(i) if i % 2 else F.when(d(i) >= 5, d(i) * 2 - 9).otherwise(d(i) * 2)
        total = total + F.when(F.length(number) >= i, value).otherwise(0)
    return total % 10 == 0


def octets(text: Column) -> Column:
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return text.rlike(f"^{part}\\.{part}\\.{part}\\.{part}$")


def valid(kind: str, text: Column) -> Column:
    """Whether a base match counts."""
    n = F.length(digits(text))
    if kind == "ip":
        return octets(text)
    if kind == "card":
        return n.between(13, 19) & luhn(digits(text))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def matches(text: Column, pattern: str, needs: str, number: int) -> Column:
    """All matches from left to right: pattern (its number), i, gap (characters since the match before),
    found, and the characters before and after it.

    What stands between the matches is what splitting by the pattern leaves, so the lengths of
    both, added up, are the places of the matches (``located``).
    """
    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(
        gaps.alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), 0).alias("found"),
        F.slice(gaps, 2, F.greatest(F.size(gaps) - 1, F.lit(0))).alias("next"),
    )
    made = F.transform(
        F.filter(zipped, lambda x: x["found"].isNotNull()),
        lambda x, i: F.struct(
            F.lit(number).alias("pattern"),
            i.alias("i"),
            F.length(x["gap"]).alias("gap"),
            x["found"].alias("found"),
            F.right(x["gap"], F.lit(CONTEXT)).alias("before"),
            F.left(x["next"], F.lit(2)).alias("after"),
        ),
    )
    none = F.expr("cast(array() as array<struct<pattern:int,i:int,gap:int,found:string,before:string,after:string>>)")
    return F.when(text.rlike(needs) & text.rlike(pattern), made).otherwise(none)


def found_in(docs: DataFrame, name: str) -> tuple[DataFrame, str, str]:
    """docs without the text, written once, with a row key and the matches of all patterns.

    Pattern k is the base form of kind k, pattern 4 + k its wide form.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    every = [matches(text, p.base, p.needs, k) for k, p in enumerate(PATTERNS)]
    every += [matches(text, p.wide, p.needs, len(KINDS) + k) for k, p in enumerate(PATTERNS)]
    found = free_name(docs, "matches")
    rows = docs.withColumn(found, F.concat(*every)).drop("text")
    key = free_name(rows, "row_key")
    return keyed(rows, name, key), key, found


def located(rows: DataFrame, key: str, found: str) -> DataFrame:
    """row, kind, start, end, found, before, after, is_base, known of each different candidate.

    is_base: it has the base form and counts; known: it has the base form.
    """
    each = rows.select(F.col(key).alias("row"), F.inline(found))
    end = F.sum(F.col("gap") + F.length("found")).over(Window.partitionBy("row", "pattern").orderBy("i")).cast("int")
    each = each.withColumn("end", end).withColumns(
        {"start": F.col("end") - F.length("found"), "kind": F.col("pattern") % len(KINDS), "known": F.col("pattern") < len(KINDS)}
    )
    counts = wide = F.lit(False)
    n = F.length(digits(F.col("found")))
    for k, p in enumerate(PATTERNS):
        counts = counts | ((F.col("kind") == k) & valid(p.name, F.col("found")))
        least, most = {"card": (13, 19), "phone": (9, 15)}.get(p.name, (0, 1 << 30))
        wide = wide | ((F.col("kind") == k) & n.between(least, most))
    each = each.where(F.col("known") | wide).withColumn("is_base", F.col("known") & counts)
    return each.groupBy("row", "kind", "start", "end").agg(
        F.min("found").alias("found"),
        F.max("before").alias("before"),
        F.max("after").alias("after"),
        F.max("is_base").alias("is_base"),
        F.max("known").alias("known"),
    )


def untaken(taking: Column) -> Column:
    """Whether no other span of the same row for which ``taking`` holds overlaps the span.

    By start, one before it overlaps if it ends after its start, one behind it if it starts before
    its end: the largest end before and the smallest start behind tell.
    """
    order = Window.partitionBy("row").orderBy("start", "end", "kind")
    before = F.max(F.when(taking, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(taking, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    return F.coalesce(before <= F.col("start"), F.lit(True)) & F.coalesce(after >= F.col("end"), F.lit(True))


#: Words that speak for a kind when they stand before a span. The first letters do.
CUES = {
    "email": "e-?mail|mailto|contact|write",
    "ip": r"\bip\b|host|server|addr|from|login",
    "card": "card|visa|master|amex|credit|debit|account|konto|tarjeta|carte",
    "phone": r"\btel|phone|call|mobile|fax|handy|móvil|appel",
}


def features(candidates: DataFrame) -> tuple[DataFrame, list[str]]:
    """candidates with the columns that the trees see."""
    found, before, after = F.col("found"), F.col("before"), F.col("after")
    number = digits(found)
    n = F.length(number)
    flag = lambda c: c.cast("double")
    columns = {
        **{f"is_{k}": flag(F.col("kind") == i) for i, k in enumerate(KINDS)},
        "length": F.length(found).cast("double"),
        "n_digits": n.cast("double"),
        "n_letters": F.length(F.regexp_replace(found, "[^A-Za-z]", "")).cast("double"),
        "n_blanks": F.length(F.regexp_replace(found, "[^ ]", "")).cast("double"),
        "n_dots": F.length(F.regexp_replace(found, "[^.]", "")).cast("double"),
        "n_other": F.length(F.regexp_replace(found, "[A-Za-z0-9 .]", "")).cast("double"),
        "different": F.size(F.array_distinct(F.split(number, ""))).cast("double"),
        "sum_fits": flag((F.col("kind") == 2) & n.between(13, 19) & luhn(number)),
        "octets_fit": flag(octets(F.regexp_replace(found, r"[\[\]()]|dot", "")) & (F.col("kind") == 1)),
        "has_domain": flag(found.rlike("[A-Za-z]{2,}$")),
        "in_word": flag(before.rlike(r"[\p{L}0-9]$") | after.rlike(r"^[\p{L}0-9]")),
        "in_number": flag(before.rlike("[0-9][.,-]$") | after.rlike("^[.,-][0-9]")),
        **{f"cue_{k}": flag(before.rlike(f"(?iu){w}")) for k, w in CUES.items()},
    }
    return candidates.withColumns(columns), list(columns)


def judged_candidates(candidates: DataFrame) -> DataFrame:
    """Candidates that are not base spans, and are accepted: row, kind, start, end, score.

    candidates: those of ``located`` with free (boolean: no base span overlaps it).
    """
    rows, columns = features(candidates)
    vector = VectorAssembler(inputCols=columns, outputCol="x")
    picked = F.pmod(F.xxhash64("found", "before", F.lit(SEED)), F.lit(4)) == 0
    known = rows.where("known").withColumns({"y": F.col("is_base").cast("double"), "aside": picked})
    # Candidates that the trees cannot tell apart are one example that weighs as much as all of them.
    known = known.groupBy("kind", *columns, "y", "aside").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    examples = settle(vector.transform(known).select("kind", "x", "y", "aside", "weight"), "pii-examples")
    rows = vector.transform(rows)
    sides = {r["y"]: r["count"] for r in examples.where("not aside").groupBy("y").count().collect()}
    none = rows.select("row", "kind", "start", "end", F.lit(0.0).alias("score")).limit(0)
    if len(sides) < 2:
        return none  # nothing to learn from: only base spans count
    trees = GBTClassifier(featuresCol="x", labelCol="y", weightCol="weight", maxIter=12, maxDepth=3, seed=SEED, stepSize=0.3)
    model = trees.fit(examples.where("not aside"))
    score = vector_to_array("probability")[1].alias("score")
    seen = model.transform(examples.where("aside")).select("kind", "y", "weight", score)
    bins = seen.groupBy("kind", F.floor(F.col("score") * 50).alias("bin")).agg(
        F.sum(F.col("y") * F.col("weight")).alias("right"), F.sum("weight").alias("n")
    )
    limits = thresholds([tuple(r) for r in bins.collect()])  # 50 bins a kind at most
    limit = F.lit(2.0)
    for kind, at in limits.items():
        limit = F.when(F.col("kind") == kind, F.lit(at)).otherwise(limit)
    fresh = model.transform(rows.where("free and not known")).select("row", "kind", "start", "end", score)
    return fresh.where(F.col("score") >= limit)


def thresholds(bins: list[tuple[int, int, float, float]], precision: float = PRECISION) -> dict[int, float]:
    """For each kind the lowest score from which on the share of right ones is high enough."""
    out: dict[int, float] = {}
    for kind in {b[0] for b in bins}:
        right = n = 0.0
        for _, at, r, count in sorted((b for b in bins if b[0] == kind), key=lambda b: -b[1]):
            right, n = right + r, n + count
            if right / n >= precision:
                out[kind] = at / 50
    return {k: max(at, 0.5) for k, at in out.items()}


def detected(docs: DataFrame) -> DataFrame:
    """docs, without its text, with base_spans and spans: arrays of kind (number), start, end by kind, then start.

    spans holds the base spans and those that the trees accept and that overlap neither a base span
    nor an accepted one of a kind listed before. A null text counts as empty and has none; repeated
    rows get the same spans. The names get underscores in front where docs has them.
    """
    rows, key, found = found_in(docs, "pii-rows")
    each = located(rows, key, found)
    each = settle(each.withColumn("free", untaken(F.col("is_base"))), "pii-candidates")
    added = judged_candidates(each)
    first = F.lit(True)
    for k in range(1, len(KINDS)):
        first = first & ((F.col("kind") != k) | untaken(F.col("kind") < k))
    added = added.withColumn("first", first).where("first").select("row", "kind", "start", "end", F.lit(False).alias("is_base"))
    own = each.where("is_base").select("row", "kind", "start", "end", "is_base")
    span = F.struct("kind", "start", "end")
    base, spans = free_name(rows, "base_spans"), free_name(rows, "spans")
    by_row = (
        own.unionByName(added)
        .groupBy(F.col("row").alias("__row"))
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("is_base"), span))).alias("__base"),
            F.sort_array(F.collect_list(span)).alias("__spans"),
        )
    )
    none = F.expr("cast(array() as array<struct<kind:int,start:int,end:int>>)")
    out = rows.join(by_row, F.col(key) == F.col("__row"), "left")
    out = out.withColumns({base: F.coalesce("__base", none), spans: F.coalesce("__spans", none)})
    return out.drop("__row", "__base", "__spans", found, key)


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    line = F.transform(
        spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))
    )
    return F.array_join(line, ",")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of each document."""
    rows = detected(docs.select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda x: x["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id", *map(count, KINDS), F.sha2(joined(F.col("base_spans")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
