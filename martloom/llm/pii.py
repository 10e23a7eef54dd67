"""Personal data: rule spans, and further spans that boosted trees pick from loose candidates.

DataFrame functions and ``pyspark.ml`` only: the fitted trees are turned into column expressions,
so spans are found, scored and redacted inside the row, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import beside
from martloom.session import settle

KINDS = ("email", "ip", "card", "phone")
TREES = 10
DEPTH = 3
RECALL = 0.98  # share of the masked rule spans held out from fitting that a threshold lets pass
HELD_OUT = 5  # masked rule spans of a kind that its threshold needs
CONTEXT = 24  # characters before a candidate that count as its context

# The rules. A match can only begin where the run of characters it starts in begins, or where the
# last match ended; saying so keeps long runs linear. Possessive repeats change no match here.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Runs of fewer than 12 digits are never cards; the lookbehinds keep to the start of a run.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Candidates: anything like an address or a long number.
_AT = r"[\(\[{]\x20?at\x20?[\)\]}]"
_DOT = r"\x20?[\(\[{]\x20?dot\x20?[\)\]}]\x20?"
LOOSE_EMAIL = (
    rf"(?i)(?<![{_LOCAL}])[{_LOCAL}]++\x20?(?:@|{_AT})\x20?[A-Za-z0-9-]++"
    rf"(?:(?:\.|{_DOT})[A-Za-z0-9-]++)++"
)
LOOSE_NUMBER = r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[\x20().\/-]{0,2}[0-9]){6,23}(?![0-9A-Za-z])"

HAS_EMAIL = rf"@|(?i:{_AT})"
HAS_CANDIDATE = rf"[0-9]{{2}}|{HAS_EMAIL}"

_SPANS = "array<struct<start:int,end:int,kind:int,found:string>>"
FEATURES = (
    "digits", "letters", "marks", "groups", "longest", "last", "paren", "dots", "dashes", "blanks",
    "before", "after", "hint",
)


def _matches(text: Column, pattern: str, kind: int, keep: Callable[[Column], Column]) -> Column:
    """Spans of the pattern's leftmost matches that ``keep`` accepts, by code points. The pieces
    between matches and the matches themselves give the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"))
    step = lambda acc, x: F.struct(
        (acc["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))).alias("at"),
        F.when(
            x["hit"].isNotNull() & keep(x["hit"]),
            F.concat(
                acc["spans"],
                F.array(
                    F.struct(
                        (acc["at"] + F.length(x["gap"])).alias("start"),
                        (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"),
                        F.lit(kind).alias("kind"),
                        x["hit"].alias("found"),
                    )
                ),
            ),
        )
        .otherwise(acc["spans"])
        .alias("spans"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))
    return F.aggregate(both, start, step, lambda acc: acc["spans"])


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of ASCII digits passes the Luhn check."""
    n = F.length(digits)
    digit = lambda i: F.ascii(F.substr(digits, n - i + 1, F.lit(1))) - 48
    double = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 0, double(digit(i))).otherwise(digit(i)),
    )
    return (n > 0) & (F.when(n > 0, total) % 10 == 0)


def _octets(found: Column) -> Column:
    """Whether every number between full stops is at most 255."""
    small = lambda p: (F.length(p) <= 3) & (
        F.coalesce(F.when(F.length(p) <= 3, p).try_cast("int"), F.lit(0)) <= 255
    )
    return F.forall(F.split(found, r"\."), lambda p: small(F.regexp_replace(p, "^0+", "")))


def _card(found: Column) -> Column:
    digits = _digits(found)
    return F.length(digits).between(12, 19) & luhn(digits)


def base_spans(text: Column) -> Column:
    """Rule spans of all kinds, by start, then kind. NULL and empty texts have none."""
    none = F.array().cast(_SPANS)
    has = F.when  # each pattern runs only where its cheap test holds
    parts = [
        has(F.contains(text, F.lit("@")), _matches(text, EMAIL, 0, lambda m: F.lit(True))),
        has(text.rlike(r"[0-9]\.[0-9]"), _matches(text, IP, 1, _octets)),
        has(text.rlike(r"[0-9][\x20-]?[0-9]"), _matches(text, CARD, 2, _card)),
        has(
            F.contains(text, F.lit("+")),
            _matches(text, PHONE, 3, lambda m: F.length(_digits(m)).between(9, 15)),
        ),
    ]
    return F.array_sort(
        F.concat(*[F.coalesce(p, none) for p in parts]),
        lambda x, y: F.when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(x["kind"] - y["kind"]),
    )


def candidates(text: Column) -> Column:
    """Loose spans, which may overlap each other and the rules' spans; ``kind`` is 0 or 2 by the
    generator."""
    none = F.array().cast(_SPANS)
    always = lambda m: F.lit(True)
    email = F.when(text.rlike(HAS_EMAIL), _matches(text, LOOSE_EMAIL, 0, always))
    number = F.when(text.rlike("[0-9]{2}"), _matches(text, LOOSE_NUMBER, 2, always))
    return F.concat(F.coalesce(email, none), F.coalesce(number, none))


def kind_of(span: Column) -> Column:
    """The kind a candidate would be: an address is an email, four numbers up to 255 with full stops
    between them an ip, 13 to 19 digits with the check digit of cards a card, else up to 15 digits
    a phone. Longer numbers are of no kind (NULL)."""
    digits = _digits(span["found"])
    tight = F.regexp_replace(span["found"], " ", "")
    return (
        F.when(span["kind"] == 0, 0)
        .when(tight.rlike(r"^[0-9]+(?:\.[0-9]+){3}$") & _octets(tight), 1)
        .when(F.length(digits).between(13, 19) & luhn(digits), 2)
        .when(F.length(digits) <= 15, 3)
    )


def masked(span: Column) -> Column:
    """A rule span written in ways that miss its rule, as strings: without the '+' or with other
    marks between the digits, or with words or blanks in place of the marks of an address."""
    found, kind = span["found"], span["kind"]
    swap = F.regexp_replace
    local, host = F.substring_index(found, "@", 1), F.substring_index(found, "@", -1)
    email = [
        F.concat(local, F.lit(at), swap(host, r"\.", dot))
        for at, dot in (
            ("(at)", "."), ("[at]", "."), (" (at) ", "."), (" @ ", "."),
            ("(at)", "(dot)"), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" [at] ", " [dot] "),
        )
    ]
    ip = [swap(found, r"\.", mark) for mark in (". ", " .")]
    by_four = swap(_digits(found), "([0-9]{4})(?=[0-9])", "$1-")
    marked = F.when(found.rlike("^[0-9]+$"), by_four).otherwise(found)
    card = [swap(marked, "[^0-9]", mark) for mark in (".", "/", "  ", ". ")]
    bare = swap(found, r"^\+", "")
    short = swap(found, r"^\+[0-9]{1,3}[\x20.-]", "")  # without the country as well
    phone = [bare, short, F.concat(F.lit("00"), bare)]
    phone += [swap(swap(c, r"^\(", ""), "[^0-9]+", m) for c in (bare, short) for m in (".", "-", " ", "/")]
    ways = F.when(kind == 0, F.array(*email)).when(kind == 1, F.array(*ip))
    ways = F.array_distinct(ways.when(kind == 2, F.array(*card)).otherwise(F.array(*phone)))
    whole = rf"^(?:{LOOSE_NUMBER})$"
    return F.filter(
        ways, lambda w: F.when(kind == 0, w.rlike(rf"^(?:{LOOSE_EMAIL})$")).otherwise(w.rlike(whole))
    )


def _features(text: Column, span: Column) -> Column:
    """Format and context of a span as numbers. What a rule asks for (the '+', the '@', check digits
    and octets) is not among them: it would tell rule spans from all that the rules miss."""
    found, start, end = span["found"], span["start"], span["end"]
    count = lambda p: (F.length(found) - F.length(F.regexp_replace(found, p, ""))).cast("double")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int").cast("double")
    groups = F.filter(F.split(found, "[^0-9]+"), lambda g: g != "")
    sizes = F.transform(groups, lambda g: F.length(g))
    size = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    at = F.greatest(start - CONTEXT, F.lit(0))
    context = F.lower(F.substr(text, at + 1, start - at))
    before = F.substr(text, F.greatest(start, F.lit(1)), F.when(start > 0, 1).otherwise(0))
    after = F.substr(text, end + 1, F.lit(1))
    return F.struct(
        count("[0-9]").alias("digits"),
        count("[A-Za-z]").alias("letters"),
        count("[^0-9A-Za-z]").alias("marks"),
        F.size(groups).cast("double").alias("groups"),
        size(F.array_max(sizes)).alias("longest"),
        size(F.try_element_at(sizes, F.lit(-1))).alias("last"),
        flag(F.contains(found, F.lit("("))).alias("paren"),
        count(r"\.").alias("dots"),
        count("-").alias("dashes"),
        count(" ").alias("blanks"),
        flag(before.rlike(r"[\s(:;,]") | (start == 0)).alias("before"),
        flag(after.rlike(r"[\s).:;,]") | (after == "")).alias("after"),
        flag(context.rlike(r"mail|contact|tel|phone|call|fax|mobile|card|visa|host|server|addr")).alias("hint"),
    )


@dataclass(frozen=True)
class PiiModel:
    """Trees as nested tuples (feature, threshold, left, right) or leaf values, their weights, and
    the calibrated threshold on the odds of each kind. Without trees nothing is added to the rules."""

    trees: tuple = ()
    weights: tuple[float, ...] = ()
    thresholds: tuple[float, ...] = (float("inf"),) * len(KINDS)

    @property
    def threshold(self) -> float:
        return min(self.thresholds)

    def odds(self, features: Column) -> Column:
        def value(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            name, split, left, right = node
            return F.when(features[name] <= split, value(left)).otherwise(value(right))

        out = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights):
            out = out + value(tree) * weight
        return out


def _tree(node):
    if node.numDescendants() == 0:
        return float(node.prediction())
    split = node.split()
    return (
        FEATURES[split.featureIndex()],
        float(split.threshold()),
        _tree(node.leftChild()),
        _tree(node.rightChild()),
    )


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def labelled_spans(docs: DataFrame) -> DataFrame:
    """What the trees learn from, of all texts: ``label, kind, apart``, the features, and ``n``, how
    many spans look so. ``apart`` marks a third of the spans, by a hash of the text around them.

    Equal rows are counted before the shuffle, so the table grows with the different looks of the
    spans and not with the texts.
    """
    text = F.col("text").cast("string")
    held = docs.select(text.alias("text")).where(text.rlike(HAS_CANDIDATE))
    held = held.select("text", base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("c"))
    labelled = lambda spans, label: F.transform(
        spans, lambda s: F.struct(F.lit(label).alias("label"), s.alias("span"))
    )
    fresh = F.filter("c", lambda c: ~F.exists("base", lambda b: _overlaps(b, c)))
    both = F.concat(labelled(F.col("base"), 1), labelled(fresh, 0))
    held = held.select("text", F.explode(both).alias("x")).select("text", "x.label", "x.span")
    kind = F.when(F.col("label") == 1, F.col("span.kind")).otherwise(kind_of(F.col("span")))
    first = F.greatest(F.col("span.start") - CONTEXT, F.lit(0))
    around = F.substr(F.col("text"), first + 1, F.col("span.end") - first + 1)
    held = held.select(
        "label", kind.alias("kind"), (F.col("span.start") - first).alias("at"), "span.found", around.alias("around")
    ).where("kind IS NOT NULL")
    held = held.withColumn("apart", F.pmod(F.xxhash64("found", "around"), F.lit(3)) == 0)
    ways = F.when(F.col("label") == 1, masked(F.struct("found", "kind"))).otherwise(F.array("found"))
    held = held.withColumn("end", F.col("at") + F.length("found")).withColumn("found", F.explode(ways))
    generator = F.when(F.col("kind") == 0, 0).otherwise(2).alias("kind")
    span = F.struct(F.col("at").alias("start"), "end", generator, "found")
    features = _features(F.col("around"), span)
    looks = held.select("label", kind_of(span).alias("kind"), "apart", features.alias("f")).where("kind IS NOT NULL")
    looks = looks.select("label", "kind", "apart", "f.*")
    return looks.groupBy(*looks.columns).agg(F.count(F.lit(1)).alias("n"))


def fit(docs: DataFrame) -> PiiModel:
    """Fit the trees on all rule spans and candidates of the texts but a third, and calibrate on the
    rule spans of that third. Equal rows are folded, with their number as weight.

    Positives are the rule spans, each written in the ways of ``masked`` that miss its rule, in the
    context it has. The candidates that overlap no rule span are unlabelled: personal data may be
    among them, however common. So they serve to rank only; the threshold of a kind looks at the
    positives alone and lets ``RECALL`` of those kept apart pass. Kinds with less than ``HELD_OUT``
    of those get nothing added; too few positives, or nothing that could be added: no trees.
    """
    looks = labelled_spans(docs)
    looks = settle(looks.sortWithinPartitions(*looks.columns))
    fitted_on = looks.where(~F.col("apart"))
    counts = {(r["label"], r["kind"]): r["n"] for r in fitted_on.groupBy("label", "kind").agg(F.sum("n").alias("n")).collect()}
    positives = sum(n for (label, _), n in counts.items() if label)
    if positives < 10 or positives == sum(counts.values()):
        return PiiModel()
    # Both labels weigh the same within a kind, but for few rows.
    weight = F.lit(0.0)
    for (label, k), n in counts.items():
        weight = F.when((F.col("label") == label) & (F.col("kind") == k), 1000 / (n + 20)).otherwise(weight)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    weighted = fitted_on.withColumn("weight", weight * F.col("n"))
    train = assembler.transform(weighted).select("label", "weight", "features")
    fitted = GBTClassifier(
        maxIter=TREES, maxDepth=DEPTH, seed=3, labelCol="label", weightCol="weight"
    ).fit(train)
    trees = tuple(_tree(t._call_java("rootNode")) for t in fitted.trees)
    model = PiiModel(trees, tuple(float(w) for w in fitted.treeWeights))
    odds = F.round(model.odds(F.struct(*FEATURES)), 6).alias("odds")
    scored = looks.where(F.col("apart") & (F.col("label") == 1)).select("kind", odds, "n")
    scored = scored.groupBy("kind", "odds").agg(F.sum("n").alias("n"))
    # The least odds that leave no more than the rest of RECALL below them.
    of_kind = Window.partitionBy("kind")
    upto = F.sum("n").over(of_kind.orderBy("odds"))
    ranked = scored.select("kind", "odds", upto.alias("upto"), F.sum("n").over(of_kind).alias("total"))
    least = ranked.where(F.col("upto") > F.floor(F.col("total") * F.lit(1 - RECALL)))
    thresholds = [float("inf")] * len(KINDS)
    for r in least.groupBy("kind").agg(F.min("odds").alias("odds"), F.max("total").alias("total")).collect():
        if r["total"] >= HELD_OUT:
            thresholds[r["kind"]] = r["odds"]
    return PiiModel(model.trees, model.weights, tuple(thresholds))


def all_spans(text: Column, model: PiiModel, base: Column) -> Column:
    """The rules' spans and, where they overlap none of those nor an earlier one, the candidates
    that the trees accept, by start, then kind (``kind_of``)."""
    if not model.trees or model.threshold == float("inf"):
        return base
    fresh = F.filter(candidates(text), lambda c: ~F.exists(base, lambda b: _overlaps(b, c)))
    least = F.array(*[F.lit(t) for t in model.thresholds])
    passed = F.filter(
        fresh,
        lambda c: F.coalesce(
            F.round(model.odds(_features(text, c)), 6) >= F.get(least, kind_of(c)), F.lit(False)
        ),
    )
    step = lambda acc, c: F.when(
        F.exists(acc, lambda a: _overlaps(a, c)), acc
    ).otherwise(
        F.concat(acc, F.array(F.struct(c["start"], c["end"], kind_of(c).alias("kind"), c["found"])).cast(_SPANS))
    )
    added = F.aggregate(passed, F.array().cast(_SPANS), step)
    return F.when(
        text.rlike(HAS_CANDIDATE),
        F.array_sort(
            F.concat(base, added),
            lambda x, y: F.when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(x["kind"] - y["kind"]),
        ),
    ).otherwise(base)


def find_pii(docs: DataFrame, model: PiiModel) -> DataFrame:
    """``row`` (the document's columns), ``text``, ``base`` and ``spans`` (start, end, kind, found;
    code points, end exclusive), one row per document.

    NULL texts count as empty and have no spans. Very long texts are searched whole. Repeated rows
    are returned as often as they occur; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    rows = beside(docs).select("row", text.alias("text"))
    rows = rows.select("row", "text", base_spans(F.col("text")).alias("base"))
    return rows.withColumn("spans", all_spans(F.col("text"), model, F.col("base")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined with commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ","
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; a span that overlaps an earlier
    one is swallowed with it."""
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    step = lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(
            s["start"] >= acc["at"],
            F.concat(
                acc["out"],
                F.array(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(kinds, s["kind"])),
            ),
        )
        .otherwise(acc["out"])
        .alias("out"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    whole = F.aggregate(
        spans,
        start,
        step,
        lambda acc: F.array_join(
            F.concat(acc["out"], F.array(F.substr(text, acc["at"] + 1, F.length(text)))), ""
        ),
    )
    return F.when(F.size(spans) > 0, whole).otherwise(text)
