"""Personal data by weak supervision.

Base patterns are reported as they are. Wider patterns only give candidates, which a span
classifier accepts or rejects. Its training needs no labels by hand: matches of base patterns whose check
passes (Luhn, byte ranges, numbers of digits, the strict form of an address) are known to be personal
data, those whose check fails are known not to be, and candidates are open. Four labelers (gazetteer,
context words, borders, plausible length) vote yes, no or abstain on every one of them. Votes are counted
per combination in Spark, at most 3 * 3^4 rows whatever the corpus; expectation-maximisation on these
counts, in which the known ones keep their class, estimates how reliable each labeler is and how likely
each combination marks personal data. A logistic classifier on the spans' own features is then fitted to
these probabilities, again on counts per combination of features (`MAX_COMBINATIONS` at most, by
construction). Both fits are loops over these bounded tables; all passes over texts and spans are
DataFrame functions.

Defined results: null counts as empty; without spans nothing is fitted and nothing added; repeated
rows are searched, counted and reported one by one. Only doc_id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortwell.llm.common import settled
from sortwell.llm.spans import Kind, digests, found_rows, located, outside

# Possessive runs, look-behinds and \G only keep long runs of one class from being tried at every place.
KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    Kind("spelt_email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+\x20?[\[(](?i:at)[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?[\[(](?i:dot)[\])]\x20?|\.)[A-Za-z]{2,24}+", base=False),
    Kind("number", r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z-])", base=False),
    Kind("iban", r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Z0-9])", base=False),
    Kind("name", r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra?)\.?\x20[A-Z][a-z]{1,30}+(?:\x20[A-Z][a-z]{1,30}+)?", base=False),
]
BASE = [n for n, k in enumerate(KINDS) if k.base]
# Gazetteers: mail domains, dialling codes, country codes of accounts.
DOMAINS = r"(?i)\.(com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|ch|at|nl|us|ca|mx|ar)$"
DIALLING = r"^\+(1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
ACCOUNTS = r"^(AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)[0-9]{2}"
CUES = r"(?i)\b(e-?mail|mail|contact|call|phone|tel|fax|mobile|reach|write|from|server|host|address|card|visa|account|iban|dear|name|signed|correo|courriel|telefon|kontakt)\b"
COUNTER_CUES = r"(?i)\b(version|release|chapter|section|page|figure|table|isbn|order|article|item|no|number|rev)\b\.?\x20?$"
# Common given names and family names.
NAMES = (
    "Anna|Carlos|Carmen|Claire|Daniel|David|Elena|Emma|Frank|Hans|Isabel|James|Jan|Jane|Jean|John|Jose|Juan|Julia|Karl|"
    "Laura|Linda|Luis|Maria|Marie|Mark|Martin|Mary|Michael|Paul|Peter|Pierre|Robert|Sarah|Sophie|Susan|Thomas|William|"
    "Becker|Bernard|Brown|Dubois|Fischer|Garcia|Johnson|Jones|Lopez|Martinez|Meyer|Miller|Moreau|Petit|Roe|Schmidt|Smith|Weber|Williams"
)
# Plausible lengths of each kind.
LENGTHS = {"email": (6, 64), "ip": (7, 15), "card": (12, 23), "phone": (9, 22), "spelt_email": (8, 80),
           "number": (8, 18), "iban": (15, 42), "name": (5, 70)}
LABELERS = 4
ROUNDS = 60
# Kind, length, digits, context, border before, border after: the features and their numbers of values.
FEATURES = (len(KINDS), 5, 4, 3, 4, 4)
MAX_COMBINATIONS = math.prod(FEATURES)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def holds(kind: Column, match: Column) -> Column:
    """Whether a match passes its kind's check."""
    n = F.length(digits(match))
    byte = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
    return (
        F.when(kind == 1, F.forall(F.split(match, r"\."), lambda part: part.rlike(byte)))
        .when(kind == 2, n.between(12, 19) & F.call_function("luhn_check", digits(match)))
        .when(kind == 3, n.between(9, 15))
        .otherwise(True)
    )


def by_kind(values: dict[str, Column], other: Column) -> Column:
    for n, kind in enumerate(KINDS):
        if kind.name in values:
            other = F.when(F.col("kind") == n, values[kind.name]).otherwise(other)
    return other


def vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def context_vote() -> Column:
    return vote(F.col("before").rlike(CUES), F.col("before").rlike(COUNTER_CUES))


def border(side: str, last: bool) -> Column:
    """0 space or nothing, 1 punctuation, 2 letter, 3 digit."""
    char = F.right(F.col(side), F.lit(1)) if last else F.left(F.col(side), F.lit(1))
    return F.when(char.rlike(r"^\s?$"), 0).when(char.rlike(r"^\p{L}$"), 2).when(char.rlike(r"^[0-9]$"), 3).otherwise(1)


def with_votes(spans: DataFrame) -> DataFrame:
    """Adds anchor (1 personal, 0 not, -1 open), votes (array of -1, 0, 1) and features (array of small
    numbers) to located spans."""
    match, size = F.col("match"), F.length("match")
    base = F.col("kind").isin(BASE)
    known = by_kind({
        "email": vote(match.rlike(DOMAINS), ~match.rlike(DOMAINS)),
        "spelt_email": vote(match.rlike(r"(?i)(com|org|net|de|fr|es)$"), F.lit(False)),
        "phone": vote(match.rlike(DIALLING), ~match.rlike(DIALLING)),
        "iban": vote(match.rlike(ACCOUNTS), ~match.rlike(ACCOUNTS)),
        "ip": vote(F.lit(False), match.rlike(r"^(0|127|255)\.")),
        "name": vote(match.rlike(rf"\b({NAMES})\b"), F.lit(False)),
    }, F.lit(0))
    low = by_kind({k: F.lit(v[0]) for k, v in LENGTHS.items()}, F.lit(0))
    high = by_kind({k: F.lit(v[1]) for k, v in LENGTHS.items()}, F.lit(0))
    left, right = border("before", True), border("after", False)
    share = F.length(digits(match)) / size
    return spans.withColumns({
        "anchor": F.when(base, F.col("holds").cast("int")).otherwise(-1),
        "votes": F.array(
            known, context_vote(),
            vote((left <= 1) & (right <= 1), (left >= 2) | (right >= 2)), vote(size.between(low, high), ~size.between(low, high)),
        ),
        "features": F.array(
            F.col("kind"),
            F.when(size < 8, 0).when(size < 14, 1).when(size < 20, 2).when(size < 32, 3).otherwise(4),
            F.when(share == 0, 0).when(share < 0.5, 1).when(share < 0.9, 2).otherwise(3),
            context_vote() + 1, left, right,
        ),
    })


def reliabilities(counts: dict[tuple[int, tuple[int, ...]], int]) -> tuple[list, dict[tuple[int, tuple[int, ...]], float]]:
    """Vote probabilities [labeler][class][vote] and the probability of each (anchor, votes).

    Expectation-maximisation for a two-class model whose labelers err independently. Spans whose anchor is
    0 or 1 are of that class throughout, and the first estimate is theirs alone. The share of personal data
    among open spans stays at one half: it can't be learned from spans with an anchor, which are of other
    kinds, and left free it would drift to whatever most open spans are. An abstaining labeler says nothing.
    """
    belief = {key: float(max(key[0], 0)) for key in counts}
    known = {key: key[0] >= 0 for key in counts}
    table = [[{}, {}] for _ in range(LABELERS)]
    for step in range(ROUNDS):
        for k in range(LABELERS):
            for c in (0, 1):
                seen = {v: 1.0 for v in (-1, 1)}
                for key, n in counts.items():
                    if key[1][k] and (step or known[key]):
                        seen[key[1][k]] += n * (belief[key] if c else 1 - belief[key])
                size = sum(seen.values())
                table[k][c] = {v: x / size for v, x in seen.items()}
        for key in counts:
            if not known[key]:
                odds = sum(math.log(table[k][1][v] / table[k][0][v]) for k, v in enumerate(key[1]) if v)
                belief[key] = 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))
    return table, belief


def span_classifier(rows: list[tuple[tuple[int, ...], float, float]], rounds: int = 150) -> tuple[float, list[dict[int, float]]]:
    """Bias and weights [feature][value] of a logistic model of (features, rows, sum of beliefs)."""
    bias, weights = 0.0, [dict.fromkeys(range(size), 0.0) for size in FEATURES]
    total = sum(n for _, n, _ in rows) or 1.0
    for _ in range(rounds):
        slope, slopes = 0.0, [dict.fromkeys(range(size), 0.0) for size in FEATURES]
        for features, n, positive in rows:
            score = bias + sum(weights[k][v] for k, v in enumerate(features))
            error = (n / (1 + math.exp(-max(-60.0, min(60.0, score)))) - positive) / total
            slope += error
            for k, v in enumerate(features):
                slopes[k][v] += error
        bias -= slope
        for k, values in enumerate(slopes):
            for v, g in values.items():
                weights[k][v] -= g + 1e-4 * weights[k][v]
    return bias, weights


def score(bias: float, weights: list[dict[int, float]]) -> Column:
    total = F.lit(bias)
    for k, values in enumerate(weights):
        table = F.array(*[F.lit(float(values[v])) for v in range(FEATURES[k])])
        total = total + F.element_at(table, F.element_at("features", k + 1) + 1)
    return 1 / (1 + F.exp(-total))


def classified(spans: DataFrame) -> DataFrame:
    """Located spans with `holds`, and `score` from a classifier trained on all of them."""
    voted = settled(with_votes(spans).select("rid", "kind", "start", "end", "holds", "anchor", "votes", "features"))
    # At most 3 * 3^4 vote combinations and MAX_COMBINATIONS feature combinations come to the driver.
    counts = {(r.anchor, tuple(r.votes)): r.n for r in voted.groupBy("anchor", "votes").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return voted.withColumn("score", F.lit(0.0))
    _, belief = reliabilities(counts)
    table = voted.sparkSession.createDataFrame(
        [(a, list(v), p) for (a, v), p in belief.items()], "anchor int, votes array<int>, belief double"
    )
    soft = voted.join(F.broadcast(table), ["anchor", "votes"]).groupBy("features").agg(
        F.count("*").alias("n"), F.sum("belief").alias("positive")
    )
    rows = sorted((tuple(r.features), float(r.n), r.positive) for r in soft.collect())
    return voted.withColumn("score", score(*span_classifier(rows)))


def personal_data(docs: DataFrame, accept: float = 0.5) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    rows = found_rows(docs.select("doc_id", "text"), KINDS)
    checked = located(rows).withColumn("holds", holds(F.col("kind"), F.col("match")))
    found = classified(checked)
    wanted = F.when(F.col("kind").isin(BASE), F.col("holds")).otherwise(F.col("score") >= accept)
    spans = found.where(wanted).select("rid", "kind", "start", "end")
    return digests(rows, outside(spans, BASE), KINDS).withColumnRenamed("key", "doc_id")
