"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, a classifier decides.

Candidates come from patterns: those whose matches count in any case (email, ip, card, phone),
and looser ones for numbers that only may be personal. On every candidate labelers of three kinds vote
for, against or not at all: expressions on the value, gazetteers, and the words around it.
Expectation-maximisation over the counts of vote patterns estimates how often each labeler is right;
its posteriors train a span classifier on votes and features, which accepts looser candidates.
All of it is DataFrame functions; what reaches the driver are counts of patterns whose number the labelers bound.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandfold.llm.common import stored

#: Kinds of the base result, in the order of the contract, then the loose ones: pattern in possessive form, so
#: that a text of any length is matched in a loop, not by recursion. A run of an email's characters is tried from its
#: first one only, or from where the match before ended.
PATTERNS = (
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", r"[0-9](?:[ -]?[0-9])++"),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]"),
    ("account", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
    ("number", r"(?<![0-9A-Za-z+.])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{2,4}[ .-][0-9]{3,6}(?![0-9A-Za-z])"),
)
BASE = ("email", "ip", "card", "phone")
MARK, OTHER = "\x01", "\x02"
#: Characters of context in front of a candidate.
CONTEXT = 24
#: Lengths that are summed up together.
BLOCK = 256

#: Gazetteers: fixed values.
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "it", "eu", "ch", "at", "nl")
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "38")
CALLING_CODES = ("1", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "86", "91")
COUNTRIES = ("AT", "BE", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE")
CUES = {
    "email": "mail|contact|write|kontakt|correo|courriel|@",
    "ip": r"\bip\b|address|server|host|login|adresse",
    "card": "card|visa|master|credit|pay|karte|carte|tarjeta",
    "phone": r"tel|phone|call|fax|mobile|rufnummer|\+",
    "account": "iban|account|bank|konto|compte|cuenta",
    "number": "tel|phone|call|fax|mobile|ssn|social|passport|ausweis",
}
AGAINST = r"version|isbn|order|invoice|page|figure|release|\bno\.? ?$|\bid[ :=]*$|[A-Za-z]$"

PRIOR, ROUNDS = 0.5, 50
LABELERS = 6

SPAN = "array<struct<kind:string,start:int,end:int,value:string,left:string,right:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether every second digit from the right doubled, less nine if over nine, sums to a multiple of ten."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, _digit(digits, i)).when(_digit(digits, i) > 4, 2 * _digit(digits, i) - 9).otherwise(2 * _digit(digits, i)),
    )
    return total % 10 == 0


def _digit(digits: Column, from_right: Column) -> Column:
    return F.substring(digits, F.length(digits) - from_right + 1, F.lit(1)).cast("int")


def _valid(kind: str, value: Column) -> Column:
    """What a match must pass to be a span."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.cast("double") <= 255)
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def with_running_sums(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds, for arrays of strings, the array of lengths summed so far, that before the first included.

    Sums within blocks first, then those of the blocks: the work for one text stays near the number of its
    parts. Every step is a column, so that no lambda works it out again per element.
    """
    start = F.array(F.lit(0))
    summed = lambda values: F.aggregate(values, start, lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))
    rows = rows.select("*", *(F.transform(c, lambda p: F.char_length(p)).alias(f"_{c}_lengths") for c in columns))
    blocks = lambda c: F.sequence(F.lit(0), F.greatest(F.floor((F.size(c) - 1) / BLOCK), F.lit(0)).cast("int"))
    rows = rows.select("*", *(F.transform(blocks(c), _block_sum(f"_{c}_lengths", summed)).alias(f"_{c}_blocks") for c in columns))
    rows = rows.select("*", *(summed(F.transform(f"_{c}_blocks", lambda x: F.element_at(x, -1))).alias(f"_{c}_offsets") for c in columns))
    shifted = lambda c: F.zip_with(f"_{c}_blocks", F.slice(f"_{c}_offsets", F.lit(1), F.size(f"_{c}_blocks")), lambda x, at: F.transform(F.slice(x, F.lit(2), F.size(x)), lambda v: v + at))
    rows = rows.select("*", *(F.concat(start, F.flatten(shifted(c))).alias(name) for c, name in columns.items()))
    return rows.drop(*(f"_{c}_{step}" for c in columns for step in ("lengths", "blocks", "offsets")))


def _block_sum(lengths: str, summed: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda b: summed(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))


def _spans(kind: str, parts: Column, ends: Column) -> Column:
    """The matches among ``parts``, which alternate: text, match, text, ... Positions are running lengths."""
    count = F.floor((F.size(parts) - 1) / 2).cast("int")
    return F.when(count < 1, F.array().cast(SPAN)).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        lambda i: F.struct(
            F.lit(kind).alias("kind"), F.get(ends, 2 * i - 1).alias("start"), F.get(ends, 2 * i).alias("end"),
            F.get(parts, 2 * i - 1).alias("value"), F.right(F.get(parts, 2 * i - 2), F.lit(CONTEXT)).alias("left"), F.left(F.get(parts, 2 * i), F.lit(1)).alias("right"),
        ),
    ))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): matches of every pattern that pass its rule, with what stands around them."""
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), MARK, OTHER)
    rows = docs.select("doc_id", text.alias("text"))
    gates = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+"))}
    digits = F.col("text").rlike("[0-9]")
    rows = rows.select("doc_id", *(
        F.when(gates.get(kind, digits), F.split(F.regexp_replace("text", F.lit(pattern), F.lit(f"{MARK}$0{MARK}")), MARK)).otherwise(F.array().cast("array<string>")).alias(kind)
        for kind, pattern in PATTERNS
    ))
    rows = with_running_sums(rows, {kind: f"{kind}_ends" for kind, _ in PATTERNS})
    passing = lambda kind: lambda s: _valid(kind, s["value"])
    found = F.concat(*(F.filter(_spans(kind, F.col(kind), F.col(f"{kind}_ends")), passing(kind)) for kind, _ in PATTERNS))
    return rows.select("doc_id", found.alias("spans"))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(span: Column) -> Column:
    """One vote per labeler: 1 for, -1 against, 0 none."""
    kind, value, left, right = span["kind"], span["value"], span["left"], span["right"]
    digits = _digits(value)
    by_kind = lambda of: F.coalesce(*(F.when(kind == k, of[k]) for k in of), F.lit(0))
    never = F.lit(False)
    form = {
        "email": _vote(value.rlike(r"^[a-z][a-z0-9._-]{1,40}@[a-z0-9-]+(?:\.[a-z0-9-]+){1,4}$"), value.rlike(r"^[.%+-]|\.\.|@-")),
        "ip": _vote(value.rlike(r"^(?:[1-9][0-9]{0,2}\.)(?:[0-9]{1,3}\.){2}[0-9]{1,3}$"), value.rlike(r"^0|(?:^|\.)0[0-9]")),
        "card": _vote(value.rlike(r"^(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$"), value.rlike("^0")),
        "phone": _vote(value.rlike(r"^\+[1-9][0-9]{0,2}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){1,4}$"), value.rlike(r"^\+0|[ .-]{3}")),
        "account": _vote(F.length(F.replace(value, F.lit(" "), F.lit(""))).between(15, 32), F.length(value) < 14),
        "number": _vote(value.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}$|^[0-8][0-9]{2}-[0-9]{2}-[0-9]{4}$"), value.rlike(r"^(?:19|20)[0-9]{2}|\.[0-9]{3,}\.")),
    }
    length = {
        "email": _vote(F.length(value).between(6, 60), F.length(value) > 120),
        "ip": _vote(F.length(value).between(7, 15), F.length(value) > 15),
        "card": _vote(F.length(digits).between(13, 16), F.length(digits) > 16),
        "phone": _vote(F.length(digits).between(10, 13), never),
        "account": _vote(F.length(digits) >= 10, F.length(digits) < 6),
        "number": _vote(F.length(digits).between(9, 11), F.length(digits) < 8),
    }
    listed = {
        "email": _vote(F.lower(F.substring_index(value, ".", -1)).isin(*DOMAINS), F.substring_index(value, ".", -1).rlike("^[0-9]")),
        "ip": _vote(~value.rlike(r"^(?:0|127|22[4-9]|2[3-5][0-9])\."), value.rlike(r"^(?:0|127|22[4-9]|2[3-5][0-9])\.")),
        "card": _vote(digits.rlike("^(?:" + "|".join(CARD_STARTS) + ")"), ~digits.rlike("^[3-6]")),
        "phone": _vote(digits.rlike("^(?:" + "|".join(CALLING_CODES) + ")"), digits.rlike("^0")),
        "account": _vote(F.left(value, F.lit(2)).isin(*COUNTRIES), ~F.left(value, F.lit(2)).isin(*COUNTRIES)),
        "number": _vote(digits.rlike("^[2-9][0-9]{2}555"), digits.rlike("^(?:000|666|999)")),
    }
    cue = {k: _vote(left.rlike("(?i)(?:" + words + ")[^0-9]{0,12}$"), left.rlike("(?i)(?:" + AGAINST + ")")) for k, words in CUES.items()}
    edges = _vote(left.rlike(r"(?:^|[\s(\[\"':=,;<])$") & right.rlike(r"^(?:$|[\s)\]\"',;.!?>])"), left.rlike("[A-Za-z0-9_/-]$") | right.rlike("^[A-Za-z0-9_/@-]"))
    spread = F.size(F.array_distinct(F.split(digits, "")))
    varied = F.when(kind == "email", 0).otherwise(_vote(spread >= 4, spread <= 2))
    return F.array(*(v.cast("byte") for v in (by_kind(form), by_kind(length), by_kind(listed), by_kind(cue), edges, varied)))


def traits(span: Column) -> Column:
    """Features of a span besides the votes; each has a few values only."""
    value = span["value"]
    share = F.floor(4 * F.length(_digits(value)) / F.greatest(F.length(value), F.lit(1)))
    side = lambda c: F.when(c == "", "edge").when(c.rlike(r"^\s$"), "blank").when(c.rlike("^[A-Za-z0-9]$"), "word").otherwise("mark")
    return F.array(
        F.concat(F.lit("length "), F.least(F.floor(F.length(value) / 4), F.lit(8)).cast("string")), F.concat(F.lit("digits "), share.cast("string")),
        F.concat(F.lit("left "), side(F.right(span["left"], F.lit(1)))), F.concat(F.lit("right "), side(span["right"])),
    )


def reliabilities(counts: dict[tuple[int, ...], float]) -> Callable[[tuple[int, ...]], float]:
    """The probability that a vote pattern is a true span, from how often each pattern occurs.

    Each labeler has a chance of each vote on true and on false spans; these and the posteriors of
    the patterns are estimated in turn. Labelers start as right in seven of ten votes.
    """
    chance = [{1: {1: 0.6, 0: 0.3, -1: 0.1}, 0: {1: 0.1, 0: 0.3, -1: 0.6}} for _ in range(LABELERS)]
    prior = PRIOR

    def posterior(pattern: tuple[int, ...]) -> float:
        odds = math.log(prior / (1 - prior)) + sum(math.log(chance[i][1][v] / chance[i][0][v]) for i, v in enumerate(pattern))
        return 1 / (1 + math.exp(-max(min(odds, 30), -30)))

    for _ in range(ROUNDS if counts else 0):
        truth = {p: posterior(p) for p in counts}
        total = sum(counts.values())
        good = sum(n * truth[p] for p, n in counts.items())
        updated = []
        for i in range(LABELERS):
            sums = {z: {v: 1.0 for v in (1, 0, -1)} for z in (1, 0)}
            sums[1][1] += 3.0  # a labeler is rather right than wrong
            sums[0][-1] += 3.0
            for p, n in counts.items():
                sums[1][p[i]] += n * truth[p]
                sums[0][p[i]] += n * (1 - truth[p])
            updated.append({z: {v: x / sum(of.values()) for v, x in of.items()} for z, of in sums.items()})
        chance, prior = updated, min(max((good + 1) / (total + 2), 0.01), 0.99)
    return posterior


def classifier(counts: list[tuple[str, tuple[int, ...], tuple[str, ...], int]]) -> tuple[dict[str, float], dict[str, float]]:
    """(log odds of each kind, weight of each kind's feature) of the final span classifier.

    A naive Bayes model on votes and traits, its classes weighted by the posteriors of the vote patterns.
    """
    patterns: dict[str, dict[tuple[int, ...], float]] = defaultdict(lambda: defaultdict(float))
    for kind, pattern, _, n in counts:
        patterns[kind][pattern] += n
    posterior = {kind: reliabilities(of) for kind, of in patterns.items()}
    sums: dict[tuple[str, str], list[float]] = defaultdict(lambda: [0.5, 0.5])
    whole: dict[str, list[float]] = defaultdict(lambda: [1.0, 1.0])
    for kind, pattern, features, n in counts:
        p = posterior[kind](pattern)
        for names in (*features, *(f"vote{i} {v}" for i, v in enumerate(pattern))):
            sums[kind, names][0] += n * (1 - p)
            sums[kind, names][1] += n * p
        whole[kind][0] += n * (1 - p)
        whole[kind][1] += n * p
    bias = {kind: math.log(good / bad) for kind, (bad, good) in whole.items()}
    weights = {f"{kind} {name}": math.log(good / whole[kind][1]) - math.log(bad / whole[kind][0]) for (kind, name), (bad, good) in sums.items()}
    return bias, weights


def _table(values: dict[str, float]) -> Column:
    pairs = [F.lit(x) for k, v in sorted(values.items()) for x in (k, v)] or [F.lit(""), F.lit(0.0)]
    return F.create_map(*pairs)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of each row: spans are (kind, start, end, value, score), by start.

    Positions are code points, the end exclusive. Base kinds are all there, with their score; other kinds if
    their score is at least one half and they lie outside every base span. Null texts count as empty; rows that
    repeat a doc_id or a text each get their row; texts without candidates have an empty array; an
    empty table gives an empty result; extra columns are ignored.
    """
    found = stored(candidates(docs), "candidates")
    marked = found.select("doc_id", F.transform("spans", lambda s: F.struct(s.alias("span"), votes(s).alias("votes"), traits(s).alias("traits"))).alias("spans"))
    marked = stored(marked, "votes")
    seen = marked.select(F.explode("spans").alias("s")).groupBy(F.col("s.span.kind").alias("kind"), F.col("s.votes").alias("votes"), F.col("s.traits").alias("traits")).count()
    counts = [(r["kind"], tuple(r["votes"]), tuple(r["traits"]), r["count"]) for r in seen.collect()]
    bias, weights = classifier(counts)
    base, table = _table(bias), _table(weights)

    def score(s: Column) -> Column:
        kind = s["span"]["kind"]
        names = F.concat(s["traits"], F.transform(s["votes"], lambda v, i: F.concat(F.lit("vote"), i.cast("string"), F.lit(" "), v.cast("string"))))
        odds = F.aggregate(names, F.coalesce(F.element_at(base, kind), F.lit(0.0)), lambda acc, n: acc + F.coalesce(F.element_at(table, F.concat(kind, F.lit(" "), n)), F.lit(0.0)))
        return 1 / (1 + F.exp(-F.greatest(F.least(odds, F.lit(30.0)), F.lit(-30.0))))

    scored = F.transform("spans", lambda s: F.struct(
        s["span"]["start"].alias("start"), F.array_position(F.array(*(F.lit(k) for k, _ in PATTERNS)), s["span"]["kind"]).cast("int").alias("rank"),
        s["span"]["end"].alias("end"), s["span"]["kind"].alias("kind"), s["span"]["value"].alias("value"), score(s).alias("score"),
    ))
    rows = marked.select("doc_id", F.array_sort(scored).alias("spans"))
    is_base = lambda s: s["kind"].isin(*BASE)
    rows = rows.select("doc_id", F.filter("spans", is_base).alias("base"), F.filter("spans", lambda s: ~is_base(s) & (s["score"] >= 0.5)).alias("loose"))
    free = F.filter("loose", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return rows.select("doc_id", F.array_sort(F.concat("base", free)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    is_kind = lambda kind: lambda s: s["kind"] == kind
    return found.select(
        "doc_id", *(F.size(F.filter("spans", is_kind(k))).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(named(base), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"),
    )
