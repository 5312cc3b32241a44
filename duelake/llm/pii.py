"""Personal data by weak supervision.

Base kinds (email, ip, card, phone) are found by fixed patterns and always stay.  Looser candidates (secrets,
numbers without a country code) go through weak supervision: labelers of three sorts vote on every candidate and base
span (regular expressions on its form, gazetteers of field names and prefixes, the characters around it);
expectation-maximisation on the counts of vote patterns estimates how reliable each labeler is; the resulting
probabilities train a naive Bayes classifier on features of the span, which decides on the candidates.

All of it is DataFrame functions.  Spans are found, judged and joined inside their row, so nothing but counts is
shuffled: one row for each vote pattern or feature and task.  The number of patterns is bounded by the labelers, not by
the corpus, and each round of the estimation is one aggregate over them.

Patterns begin only where an earlier match ended or where the run of characters begins; that leaves the
matches as they are and keeps long runs from being tried from each of their characters.

Edge cases: a null or empty text has no spans; offsets count code points, end exclusive; a corpus without candidates
trains nothing and adds nothing.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelake.llm.common import staged

# The kinds of the base and their patterns, then the kinds of candidates.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
SECRET = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{16,}+"
NUMBER = r"(?<![0-9+.-])\(?[0-9]{2,4}\)?[\x20-][0-9]{2,4}[\x20-][0-9]{3,4}(?![0-9]|[.-][0-9])"
BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("secret", "number")

# Gazetteers.
FIELD_NAMES = (
    "account auth bearer call card contact credential fax host iban key login mail mobile passwd password phone pin pwd "
    "secret server ssn tel token visa"
).split()
SECRET_PREFIXES = "AKIA ASIA ghp_ gho_ glpat- sk- pk_ xoxb- xoxp- AIza".split()
DOMAIN_ENDS = "com org net edu gov io de fr es uk eu info".split()
CARD_STARTS = "4 51 52 53 54 55 34 37 6011 65 35".split()

#: Code points kept on either side of a span for the labelers.
CONTEXT = 24
ROUNDS = 12
SPAN = "array<struct<kind:string,start:int,end:int,value:string,before:string,after:string>>"


def _empty() -> Column:
    return F.array().cast(SPAN)


def _matches(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost matches that do not overlap: kind, start, end, value, what stands before and after."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

        def step(state: Column, pair: Column) -> Column:
            begin = state["at"] + F.length(pair["gap"])
            return F.struct(
                (begin + F.length(pair["value"])).alias("at"), F.concat(state["starts"], F.array(begin)).alias("starts")
            )

        pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
        starts = F.aggregate(pairs, start, step)["starts"]
        return F.zip_with(
            found,
            starts,
            lambda v, s: F.struct(
                F.lit(kind).alias("kind"),
                s.alias("start"),
                (s + F.length(v)).alias("end"),
                v.alias("value"),
                F.substring(text, F.greatest(s - CONTEXT, F.lit(0)) + 1, F.least(s, F.lit(CONTEXT))).alias("before"),
                F.substring(text, s + F.length(v) + 1, F.lit(CONTEXT)).alias("after"),
            ),
        )

    return F.get(
        F.transform(F.array(values), lambda v: F.when(F.size(v) > 0, placed(v)).otherwise(_empty())), F.lit(0)
    )


def _valid(span: Column) -> Column:
    """The checks that a match of its kind has to pass."""
    digits = F.regexp_replace(span["value"], "[^0-9]", "")
    parts = F.transform(F.split(span["value"], r"\."), lambda p: F.ltrim(p, F.lit("0")))
    small = F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    return (
        F.when(span["kind"] == "ip", small)
        .when(span["kind"] == "card", F.length(digits).between(13, 19) & F.call_function("luhn_check", digits))
        .when(span["kind"] == "phone", F.length(digits).between(9, 15))
        .otherwise(F.lit(True))
    )


def find(docs: DataFrame, text: str = "text", base: str = "base", more: str = "candidates") -> DataFrame:
    """Add ``base`` (valid spans of the base kinds) and ``candidates`` (looser spans that overlap none of them)."""
    value = F.coalesce(F.col(text), F.lit(""))
    when = lambda sign, spans: F.when(F.contains(value, F.lit(sign)), spans).otherwise(_empty())
    found = F.concat(
        when("@", _matches(value, EMAIL, "email")),
        when(".", _matches(value, IP, "ip")),
        _matches(value, CARD, "card"),
        when("+", _matches(value, PHONE, "phone")),
    )
    loose = F.concat(_matches(value, SECRET, "secret"), _matches(value, NUMBER, "number"))
    apart = lambda c: ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    return docs.withColumn(base, F.filter(found, _valid)).withColumn(more, F.filter(loose, apart))


def _either(words: list[str]) -> str:
    return "(?:" + "|".join(words) + ")"


def votes(span: Column) -> list[Column]:
    """Each labeler's vote on a span: 1 for, -1 against, 0 none."""
    kind, value, before, after = (span[f] for f in ("kind", "value", "before", "after"))
    vote = lambda yes, no=F.lit(False): F.when(yes, 1).when(no, -1).otherwise(0)
    inside = kind.isin(*BASE_KINDS)
    hexadecimal = value.rlike(r"^(?:[0-9a-f]{16,}|[0-9A-F]{16,})$")
    mixed = value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]") & (F.length(value) >= 20)
    grouped = value.rlike(r"^\(?[0-9]{3}\)?[ -][0-9]{3}-[0-9]{4}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$")
    form = vote(
        inside | ((kind == "secret") & (hexadecimal | mixed)) | ((kind == "number") & grouped),
        ~inside,
    )
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    density = vote(digits * 4 >= F.length(value), digits * 8 < F.length(value))
    field = vote(F.lower(before).rlike(_either(FIELD_NAMES) + r"[^a-z0-9]{0,6}$"))
    known = vote(
        F.when(kind == "email", value.rlike(r"\." + _either(DOMAIN_ENDS) + "$"))
        .when(kind == "card", value.rlike("^" + _either(CARD_STARTS)))
        .when(kind == "secret", value.rlike("^" + _either(SECRET_PREFIXES)))
        .otherwise(F.lit(False))
    )
    assigned = vote(before.rlike(r"[=:]\s?[\"']?$"))
    bounded = vote(
        before.rlike(r"(?:^|[\s\"'(<=:|])$") & after.rlike(r"^(?:$|[\s\"')>,.;|%&*#$!])"),
        before.rlike(r"\w$") | after.rlike(r"^\w"),
    )
    listed = vote(F.lit(False), before.rlike(r"[0-9][ ,;|/-]+$") | after.rlike(r"^[ ,;|/-]+[0-9]"))
    return [form, density, field, known, assigned, bounded, listed]


VOTERS = ("form", "density", "field", "known", "assigned", "bounded", "listed")


def features(span: Column) -> Column:
    """What the classifier sees of a span: its form and surroundings as a few named values."""
    value = span["value"]
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    named = lambda name, x: F.concat(F.lit(name + "="), span["kind"], F.lit(":"), x.cast("string"))
    return F.array(
        named("length", F.least(F.floor(F.length(value) / 8), F.lit(8))),
        named("digits", F.floor(digits * 8 / F.length(value))),
        named("upper", value.rlike("[A-Z]")),
        named("lower", value.rlike("[a-z]")),
        named("breaks", F.least(F.length(F.regexp_replace(value, "[A-Za-z0-9]", "")), F.lit(4))),
        named("ahead", F.regexp_extract(span["before"], r"([^\w\s]|\s|\w)$", 1).rlike(r"\w")),
        named("named", F.lower(span["before"]).rlike(_either(FIELD_NAMES) + r"[^a-z0-9]{0,6}$")),
    )


def _log_odds(pattern: dict[str, Column], reliable: dict[str, dict[int, float]], prior: dict[str, float]) -> Column:
    """Log odds of a vote pattern: the prior of its kind and each labeler's log ratio."""
    chosen = lambda column, values: reduce(
        lambda when, item: when.when(column == item[0], F.lit(item[1])), values.items(), F
    ).otherwise(F.lit(0.0))
    return sum((chosen(pattern[v], reliable[v]) for v in VOTERS), chosen(pattern["kind"], prior))


def estimate(spans: DataFrame, rounds: int = ROUNDS) -> Column | None:
    """Expectation-maximisation on vote patterns; the log odds of a row of votes, None without any span.

    The latent variable is whether a span is personal data; the labelers are independent given it.  It
    starts from the majority of the votes.  A kind's prior and each labeler's rates are smoothed by one.
    """
    # Kinds times votes: at most 6 * 3 ** 7 patterns, whatever the number of spans.
    patterns = [(r.asDict(), r["n"]) for r in spans.groupBy("kind", *VOTERS).agg(F.count("*").alias("n")).collect()]
    if not patterns:
        return None
    kinds = (*BASE_KINDS, *MORE_KINDS)
    weight = lambda found: [1 / (1 + math.exp(-min(500.0, max(-500.0, found(p))))) for p, _ in patterns]
    likely = weight(lambda p: sum(p[v] for v in VOTERS))
    for _ in range(rounds):
        count = {("kind", k): [1.0, 1.0] for k in kinds} | {(v, x): [1.0, 1.0] for v in VOTERS for x in (-1, 0, 1)}
        for (pattern, n), yes in zip(patterns, likely, strict=True):
            for cell in (("kind", pattern["kind"]), *((v, pattern[v]) for v in VOTERS)):
                count[cell][0] += n * yes
                count[cell][1] += n * (1 - yes)
        totals = [sum(count["kind", k][side] for k in kinds) for side in (0, 1)]
        ratio = lambda cell: math.log(count[cell][0] / totals[0]) - math.log(count[cell][1] / totals[1])
        reliable = {v: {x: ratio((v, x)) for x in (-1, 0, 1)} for v in VOTERS}
        prior = {k: math.log(count["kind", k][0] / count["kind", k][1]) for k in kinds}
        likely = weight(lambda p: prior[p["kind"]] + sum(reliable[v][p[v]] for v in VOTERS))
    return _log_odds({name: F.col(name) for name in ("kind", *VOTERS)}, reliable, prior)


def train(spans: DataFrame, odds: Column) -> tuple[dict[str, float], float]:
    """Naive Bayes on the spans' features, with the estimated probabilities as soft labels."""
    yes = 1 / (1 + F.exp(-odds))
    rows = (
        spans.select(yes.alias("yes"), F.explode(F.concat(F.array(F.lit("all")), "features")).alias("feature"))
        .groupBy("feature")
        .agg(F.sum("yes").alias("yes"), F.sum(1 - F.col("yes")).alias("no"))
        .collect()
    )
    count = {r["feature"]: (r["yes"] + 1, r["no"] + 1) for r in rows}
    yes_all, no_all = count.pop("all")
    weights = {f: math.log(y / yes_all) - math.log(n / no_all) for f, (y, n) in count.items()}
    return weights, math.log(yes_all / no_all)


def annotate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """One row a document: ``doc_id``, ``base`` and ``spans`` (base and accepted ones: kind, start, end, value).

    With ``keep_text`` all columns of ``docs`` stay; columns called ``base``, ``spans`` or ``candidates`` give way.
    """
    held = docs.drop("base", "spans", "candidates") if keep_text else docs.select(F.col(doc_id), F.col(text))
    found = find(held, text)
    found = staged(found if keep_text else found.drop(text), "pii-spans")
    spans = found.select(F.explode(F.concat("base", "candidates")).alias("span")).select(
        F.col("span.kind").alias("kind"),
        *(vote.alias(name) for name, vote in zip(VOTERS, votes(F.col("span")), strict=True)),
        features(F.col("span")).alias("features"),
    )
    odds = estimate(spans)
    accepted = _empty()
    if odds is not None:
        weights, prior = train(spans, odds)
        table = F.create_map(*(F.lit(x) for item in sorted(weights.items()) for x in item))
        weigh = lambda c: F.aggregate(
            features(c), F.lit(prior), lambda total, f: total + F.coalesce(F.try_element_at(table, f), F.lit(0.0))
        )
        accepted = F.filter("candidates", lambda c: weigh(c) >= 0)
    plain = lambda spans: F.transform(
        spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))
    )
    return found.withColumn("spans", plain(F.concat("base", accepted))).withColumn("base", plain(F.col("base"))).drop("candidates")


def redact(annotated: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Put ``<KIND>`` for every span; spans that overlap become one, named by the first."""
    value = F.coalesce(F.col(text), F.lit(""))
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus"), s["kind"].alias("kind")))
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substring(value, state["at"] + 1, s["start"] - state["at"])
        put = F.concat(state["out"], gap, F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        return F.struct(
            F.greatest(state["at"], -s["minus"]).alias("at"), F.when(fresh, put).otherwise(state["out"]).alias("out")
        )

    done = F.aggregate(ordered, start, step, lambda s: F.concat(s["out"], F.substring(value, s["at"] + 1, F.length(value))))
    return annotated.withColumn(text, F.when(F.size(spans) > 0, done).otherwise(F.col(text)))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, by kind as listed above, then start, joined by commas."""
    order = F.create_map(*(F.lit(x) for item in zip((*BASE_KINDS, *MORE_KINDS), range(9), strict=False) for x in item))
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(order[s["kind"]].alias("o"), s["start"].alias("s"), s["end"].alias("e"), s["kind"].alias("k")))
    )
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["k"], s["s"].cast("string"), s["e"].cast("string"))), ",")
