"""Secret scan with multipart credential linking.

Strong patterns (assignments, access ids, long hexadecimal) are reported as they are. Weak
candidates are reported only when the other parts of a credential stand in their scope: an id-like
token next to a secret, a secret-like token next to an id, an endpoint where both an id and a secret
are near. A scope reaches `SCOPE` characters to either side.

Linking is an interval join on (row, bin): every part lies in the bins of `SCOPE` characters that
it touches, and only the smallest start and largest end of each class and bin are kept, which is
enough to tell whether some part reaches into a candidate's scope. So a candidate meets a handful of
rows however many parts a text has. Only texts with weak candidates take part.

Defined results: null counts as empty; repeated rows are searched and reported one by one; only
doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortwell.llm.spans import Kind, digests, found_rows, located, outside

SCOPE = 400
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Possessive runs and look-behinds only keep long runs of one class from being tried at every place.
KINDS = [
    Kind("assign", ASSIGN),
    Kind("access", r"AKIA[A-Z0-9]++"),
    Kind("hex", r"(?<![0-9a-f])[0-9a-f]++"),
    Kind("id", r"(?<![A-Za-z0-9])(?:ASIA|AROA|AIDA|ghp_|gho_|xox[abp]-|sk_live_|pk_live_|AC)[A-Za-z0-9-]{14,}+", base=False),
    Kind("secret", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}+={0,2}+", base=False),
    Kind("endpoint", r"(?<![A-Za-z0-9])(?:https?|s3|jdbc:[a-z]{2,12}|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]{4,}+", base=False),
]
ID, SECRET, ENDPOINT = 0, 1, 2
CLASS_OF = {"assign": SECRET, "access": ID, "hex": SECRET, "id": ID, "secret": SECRET, "endpoint": ENDPOINT}


# Runs too short to count are not even taken out of the text.
SEARCHED = [
    Kind(k.name, k.pattern.replace("[0-9a-f]++", f"[0-9a-f]{{{MIN_HEX},}}+"), k.base) if k.name == "hex" else k
    for k in KINDS
]


def holds(kind: Column, match: Column) -> Column:
    """Whether a match passes its kind's check."""
    value = F.regexp_extract(match, ASSIGN, 2)
    mixed = match.rlike("[A-Z]") & match.rlike("[a-z]") & match.rlike("[0-9]")
    return (
        F.when(kind == 0, F.length(value) >= MIN_VALUE)
        .when(kind == 1, F.length(match) >= MIN_ACCESS)
        .when(kind == 2, F.length(match) >= MIN_HEX)
        .when(kind == 4, mixed)
        .otherwise(True)
    )


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """`spans` (rid, kind, start, end) without weak candidates that lack their other parts."""
    base = [n for n, k in enumerate(KINDS) if k.base]
    of_class = F.element_at(F.array(*[F.lit(CLASS_OF[k.name]) for k in KINDS]), F.col("kind") + 1)
    weak = ~F.col("kind").isin(base)
    classed = spans.withColumn("class", of_class)
    bins = classed.select(
        "rid", "class", "start", "end",
        F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))).alias("bin"),
    ).groupBy("rid", "bin", "class").agg(F.min("start").alias("low"), F.max("end").alias("high"))
    wide = bins.groupBy("rid", "bin").pivot("class", [ID, SECRET, ENDPOINT]).agg(
        F.first("low").alias("low"), F.first("high").alias("high")
    )
    near = classed.where(weak).select(
        "rid", "kind", "class", "start", "end",
        F.explode(F.sequence(F.floor(F.col("start") / scope) - 1, F.floor(F.col("end") / scope) + 1)).alias("bin"),
    ).join(wide, ["rid", "bin"])

    def reaches(part: int) -> Column:
        return F.coalesce(F.max(
            (F.col(f"{part}_low") <= F.col("end") + scope) & (F.col(f"{part}_high") >= F.col("start") - scope)
        ), F.lit(False))

    judged = near.groupBy("rid", "kind", "class", "start", "end").agg(
        reaches(ID).alias("has_id"), reaches(SECRET).alias("has_secret")
    )
    complete = (
        F.when(F.col("class") == ID, F.col("has_secret"))
        .when(F.col("class") == SECRET, F.col("has_id"))
        .otherwise(F.col("has_id") & F.col("has_secret"))
    )
    columns = ["rid", "kind", "start", "end"]
    return spans.where(~weak).select(*columns).unionByName(judged.where(complete).select(*columns))


def secret_scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    rows = found_rows(docs.select("doc_id", "text"), SEARCHED)
    spans = located(rows).where(holds(F.col("kind"), F.col("match"))).select("rid", "kind", "start", "end")
    base = [n for n, k in enumerate(KINDS) if k.base]
    return digests(rows, linked(outside(spans, base), scope), KINDS).withColumnRenamed("key", "doc_id")
