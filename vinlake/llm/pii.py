"""Personal data by weak supervision.

Candidates are spans that look like an e-mail address, an IP address, a card number or a phone number: those that meet
the strict rule of their kind, which always stay, and doubtful ones that miss it (a card number with
a wrong check digit, a phone number without a country, an address without a top-level domain). Labelers vote
on every candidate, for, against or not at all:

* regex: the strict rule of the kind;
* shape: the usual way of writing it;
* gazetteer: known top-level domains, country codes, card issuers, reserved networks;
* context: words just before it;
* boundary: whether it stands alone or is part of a longer word.

Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is, from all
documents. Its probabilities are the soft labels of the final classifier, a logistic regression on kind,
votes and length, whose weights then decide on doubtful candidates. The tables that are learned from have a row
per vote pattern, so they do not grow with the documents.

All of it is column expressions, aggregates and Spark ML; no Python runs on executors.
"""

from dataclasses import dataclass
from math import log

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinlake.llm.common import stored

KINDS = ["email", "ip", "card", "phone"]
LABELERS = ["regex", "shape", "gazetteer", "context", "boundary"]
ROUNDS = 12
CERTAIN = 0.5

# The strict patterns. Runs are possessive and start where a run starts, which finds the same
# matches as the plain patterns in one pass and without recursion, however long a run of digits or dots is.
LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must contain for a kind to be looked for.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
# Doubtful candidates that the strict patterns do not even match.
DOUBTFUL = {
    "email": rf"(?<![{LOCAL}])[{LOCAL}]++@[A-Za-z0-9-]++(?![A-Za-z0-9.@-])",
    "phone": r"(?<![0-9A-Za-z.+-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20-])[0-9]{3,4}[\x20-][0-9]{3,4}(?![0-9A-Za-z-])",
}
# Gazetteers and cue words: short public lists.
DOMAINS = "com|org|net|edu|gov|info|biz|io|de|fr|es|it|uk|eu|ch|at|nl|us|ca|mx|ar|br|in|jp|cn|au|ru|pl"
COUNTRIES = r"\+(?:1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])(?![0-9]{14})"
ISSUERS = r"(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65|30[0-5]|3[68])"
RESERVED = r"(?:0|10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|2[2-5][0-9])\."
CUES = {
    "email": "mail|contact|write|escrib|correo|kontakt|courriel|adress",
    "ip": r"\bip\b|address|server|login|from|host",
    "card": "card|karte|carte|tarjeta|visa|master|credit|pay",
    "phone": r"phone|tel|call|fax|mobile|handy|appel|llam|ruf",
}
AGAINST = r"\b(?:order|id|isbn|version|serial|ref|code|part|nr|no|token|key)\b[\x20.:#=]*$"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _passes(kind: str, match: Column) -> Column:
    """The check that a match of the strict pattern has to pass."""
    size = F.length(_digits(match))
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(size.between(13, 19), F.call_function("luhn_check", _digits(match))).otherwise(False)
    if kind == "phone":
        return size.between(9, 15)
    return F.lit(True)


def _found(text: Column, pattern: str, hint: str) -> Column:
    """Array of matches with ``start``, ``end`` (code points, end exclusive), ``match`` and what stands around it."""
    kind = "array<struct<start:int,end:int,match:string,before:string,after:string>>"
    matches, gaps = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1), F.split(text, pattern, -1)
    n = F.size(matches)
    zipped = F.arrays_zip(matches.alias("m"), F.slice(gaps, 1, n).alias("g"), F.slice(gaps, 2, n).alias("h"))

    def add(acc: Column, at: Column) -> Column:
        start = (acc["pos"] + F.length(at["g"])).cast("int")
        end = (start + F.length(at["m"])).cast("int")
        around = [F.right(at["g"], F.lit(32)).alias("before"), F.left(at["h"], F.lit(1)).alias("after")]
        one = F.struct(start.alias("start"), end.alias("end"), at["m"].alias("match"), *around)
        return F.struct(end.alias("pos"), F.array_append(acc["out"], one).alias("out"))

    nothing = F.array().cast(kind)
    spans = F.aggregate(zipped, F.struct(F.lit(0).alias("pos"), nothing.alias("out")), add, lambda acc: acc["out"])
    return F.when(text.rlike(hint), spans).otherwise(nothing)


def _vote(yes: Column, no: Column) -> Column:
    """1 for, 0 against, -1 for no vote."""
    return F.when(yes, 1).when(no, 0).otherwise(-1).cast("int")


def _votes(kind: str, base: Column, at: Column) -> list[Column]:
    match, never = at["match"], F.lit(False)
    shape = {
        "email": match.rlike(r"^[a-z0-9]++(?:[._+-][a-z0-9]++)*+@[a-z0-9-]++(?:\.[a-z0-9-]++)++$") & match.rlike(r"\.[a-z]{2,6}$"),
        "ip": ~match.rlike(r"(?:^|\.)0[0-9]"),
        "card": match.rlike(r"^(?:[0-9]{13,16}|[0-9]{4}(?:[\x20-][0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})$"),
        "phone": match.rlike(r"^(?:\+[0-9]{1,3}[\x20-])?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20-]?[0-9]{3,4}[\x20-]?[0-9]{3,4}$"),
    }[kind]
    known = {
        "email": match.rlike(rf"(?i)\.(?:{DOMAINS})$"),
        "ip": ~match.rlike(f"^{RESERVED}"),
        "card": match.rlike(f"^{ISSUERS}"),
        "phone": match.rlike(f"^{COUNTRIES}"),
    }[kind]
    before = F.lower(at["before"])
    joined = at["before"].rlike(r"[\p{L}0-9_]$") | at["after"].rlike(r"^[\p{L}0-9_]")
    return [
        _vote(base, ~base),
        _vote(shape, never),
        _vote(known, ~known),
        _vote(before.rlike(CUES[kind]), before.rlike(AGAINST)),
        _vote(never, joined),
    ]


def _of_kind(text: Column, place: int, kind: str) -> list[Column]:
    """Arrays of the strict and the doubtful candidates of a kind."""

    def span(at: Column, base: Column) -> Column:
        votes = [vote.alias(name) for name, vote in zip(LABELERS, _votes(kind, base, at), strict=True)]
        size = F.when(F.length(at["match"]) < 10, 0).when(F.length(at["match"]) < 17, 1).otherwise(2)
        return F.struct(F.lit(place).alias("kind"), at["start"], at["end"], base.alias("base"), *votes, size.alias("size"))

    def possible(at: Column) -> Column:
        if kind == "card":  # a wrong check digit leaves a doubtful candidate, a wrong length none
            return F.length(_digits(at["match"])).between(13, 19)
        return _passes(kind, at["match"])

    found = F.filter(_found(text, BASE[kind], HINT[kind]), possible)
    out = [F.transform(found, lambda at: span(at, _passes(kind, at["match"])))]
    if kind in DOUBTFUL:
        more = _found(text, DOUBTFUL[kind], "@" if kind == "email" else "[0-9]{3}")
        out.append(F.transform(more, lambda at: span(at, F.lit(False))))
    return out


def _candidates(text: Column) -> Column:
    """Array of all candidates of a text: kind, span, whether the strict rule holds, votes, length class."""
    return F.concat(*[group for place, kind in enumerate(KINDS) for group in _of_kind(text, place, kind)])


def _apart(spans: Column) -> Column:
    """Strict spans, and the doubtful ones that overlap none of them."""
    strict = F.filter(spans, lambda span: span["base"])

    def clear(span: Column) -> Column:
        meets = F.exists(strict, lambda other: (other["start"] < span["end"]) & (span["start"] < other["end"]))
        return span["base"] | ~meets

    return F.when(F.size(spans) > F.size(strict), F.filter(spans, clear)).otherwise(spans)


def with_candidates(docs: DataFrame, text: str = "text", name: str = "_spans") -> DataFrame:
    """``docs`` with the array of candidates of each text in a new column; a NULL text has none."""
    inner = f"{name}_all"
    found = docs.withColumn(inner, _candidates(F.coalesce(F.col(text), F.lit(""))))
    return found.withColumn(name, _apart(F.col(inner))).drop(inner)


@dataclass
class Model:
    """The final classifier: a constant, and a weight for each value of each feature."""

    constant: float
    weights: list[float]

    def chance(self, span: Column) -> Column:
        """Probability that a candidate is personal data."""
        score = F.lit(self.constant)
        for weight, feature in zip(self.weights, features(lambda name: span[name]), strict=True):
            score = score + F.lit(weight) * feature
        return 1 / (1 + F.exp(-score))


def features(of) -> list[Column]:
    """Indicators of kind, votes and length class."""
    wanted = [("kind", place) for place in range(len(KINDS))] + [("size", place) for place in range(3)]
    wanted += [(name, vote) for name in LABELERS for vote in (0, 1)]
    return [(of(name) == value).cast("double") for name, value in wanted]


def reliabilities(patterns: DataFrame) -> Column:
    """EM over vote patterns (``kind``, votes, ``n``): the log odds of a pattern as a column.

    Starts from the regex labeler at nine in ten. Votes are independent given the truth; a missing vote says
    nothing. One is added to every count, so that no probability becomes 0 or 1.
    """
    prior = dict.fromkeys(range(len(KINDS)), 0.0)
    rates = {name: (0.9, 0.1) if name == "regex" else (0.6, 0.5) for name in LABELERS}

    def odds() -> Column:
        kinds = F.create_map(*[F.lit(x) for pair in prior.items() for x in pair])
        out = kinds[F.col("kind")]
        for name, (good, bad) in rates.items():
            out = out + F.when(F.col(name) == 1, log(good / bad)).when(F.col(name) == 0, log((1 - good) / (1 - bad))).otherwise(0.0)
        return out

    for _ in range(ROUNDS):
        p = 1 / (1 + F.exp(-odds()))
        sums = []
        for name in LABELERS:
            for vote in (0, 1):
                hit = F.when(F.col(name) == vote, F.col("n")).otherwise(0)
                sums += [F.sum(hit * p).alias(f"{name}_{vote}_t"), F.sum(hit * (1 - p)).alias(f"{name}_{vote}_f")]
        for place in prior:
            hit = F.when(F.col("kind") == place, F.col("n")).otherwise(0)
            sums += [F.sum(hit * p).alias(f"kind_{place}_t"), F.sum(hit * (1 - p)).alias(f"kind_{place}_f")]
        row = patterns.agg(*sums).first().asDict()
        if row["kind_0_t"] is None:
            break
        for name in LABELERS:
            part = {key: row[f"{name}_{key}"] + 1 for key in ("0_t", "1_t", "0_f", "1_f")}
            rates[name] = tuple(part[f"1_{side}"] / (part[f"1_{side}"] + part[f"0_{side}"]) for side in "tf")
        prior = {place: log((row[f"kind_{place}_t"] + 1) / (row[f"kind_{place}_f"] + 1)) for place in prior}
    return odds()


def fit(docs: DataFrame) -> Model:
    """Learn labeler reliabilities and the final classifier from all candidates of ``docs`` (text)."""
    spans = with_candidates(docs.select("text")).filter(F.size("_spans") > 0).select(F.inline("_spans"))
    patterns = stored(spans.groupBy("kind", "size", *LABELERS).agg(F.count("*").alias("n")), "patterns")
    if patterns.isEmpty():
        return Model(0.0, [0.0] * len(features(F.col)))
    p = 1 / (1 + F.exp(-reliabilities(patterns)))
    vector = array_to_vector(F.array(*features(F.col))).alias("features")
    soft = patterns.select(vector, F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("label"), "n", p.alias("p"))
    soft = soft.select("features", "label", (F.col("n") * F.when(F.col("label") == 1, F.col("p")).otherwise(1 - F.col("p"))).alias("weight"))
    found = LogisticRegression(weightCol="weight", regParam=0.001, standardization=False, maxIter=50).fit(soft)
    return Model(float(found.intercept), [float(weight) for weight in found.coefficients])


def with_spans(docs: DataFrame, model: Model, name: str = "_spans") -> DataFrame:
    """``docs`` with its accepted spans, ordered by kind as listed, then start."""
    found = with_candidates(docs, name=name)

    def accepted(span: Column) -> Column:
        return span["base"] | (model.chance(span) >= CERTAIN)

    return found.withColumn(name, F.array_sort(F.filter(name, accepted)))


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    text = F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, number of strict spans of each kind, ``base_spans``, ``spans`` (texts of kind:start:end) of every document.

    ``docs`` has doc_id and text; other columns are not read. NULL and empty texts have no spans. Repeated rows
    get equal results. Positions count code points, ends are exclusive. Without any candidate nothing is learned.
    An empty table gives an empty result. No row is shuffled but the counts of vote patterns.
    """
    found = with_spans(docs.select("doc_id", "text"), fit(docs))
    strict = F.filter("_spans", lambda span: span["base"])
    found = found.select("doc_id", "_spans", strict.alias("_strict"))

    def number(place: int) -> Column:
        return F.size(F.filter("_strict", lambda span: span["kind"] == place)).cast("bigint")

    numbers = [number(place).alias(f"n_{kind}") for place, kind in enumerate(KINDS)]
    return found.select("doc_id", *numbers, _joined(F.col("_strict")).alias("base_spans"), _joined(F.col("_spans")).alias("spans"))


def mask(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with every accepted span of ``text`` replaced by its kind in brackets; a NULL text stays NULL.

    Overlapping spans are replaced together under the kind of the first. All columns stay as they are but text.
    """
    # The row travels whole in one column, so names of its columns cannot clash with those used here.
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    found, name = with_spans(rows, model or fit(docs), "spans"), "spans"
    text, kinds = F.col("text"), F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])
    ordered = F.array_sort(F.transform(name, lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def add(acc: Column, span: Column) -> Column:
        gap = F.substring(text, acc["pos"] + 1, span["start"] - acc["pos"])
        further = F.greatest(acc["pos"], span["end"])
        out = F.when(span["start"] < acc["pos"], acc["out"]).otherwise(F.concat(acc["out"], gap, F.get(kinds, span["kind"])))
        return F.struct(further.alias("pos"), out.alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))
    masked = F.aggregate(ordered, start, add, lambda acc: F.concat(acc["out"], F.substring(text, acc["pos"] + 1, F.length(text))))
    changed = F.when(F.size(name) > 0, masked).otherwise(text)
    return found.select(F.col("row").withField("text", changed).alias("row")).select("row.*")
