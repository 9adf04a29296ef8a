"""Secret scans by multipart credential linking, in SQL functions only.

A credential has parts: an access identifier, a secret, an endpoint. The base patterns find what is a
secret or an identifier by itself. Weak candidates (login names, addresses, mixed strings, hosts) are common and
mean nothing alone. Each opens a scope: SCOPE code points to both sides, within its paragraph. Scopes are
joined with the parts that they overlap, bucketed by place, and a weak candidate is reported only where the
parts that complement it stand in its scope.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamiz.llm.common import documents, shuffled, stored
from tamiz.llm.pii import _is_mixed
from tamiz.llm.spans import matches, placed

#: Base kinds in order, their patterns, and the least length of the match or of the group named.
#: Runs of hex digits and access keys that are too short are left out by the pattern, which changes nothing of the others.
BASE = {
    "assign": r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9+/_.=-]++",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
}
#: What stands before group 2 of an assignment, which has 6 characters at least.
_ASSIGNED = r"(?i)^(?:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?"
LEAST_ASSIGNED = 6
GATES = {"assign": r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]", "access": "AKIA", "hex": "[0-9a-f]{24}"}

_LABEL = r"[\"']?\x20*+[:=]\x20*+[\"']?"
#: Weak candidates by kind; where several begin at one place, the first in this order is taken.
WEAK = {
    "endpoint": "|".join([
        r"(?i:(?<![a-z0-9+])(?:https?|s?ftp|wss?|ldaps?|ssh|jdbc:[a-z]++|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?|s3)://[a-z0-9._~:/?#@!$&*+,;=%-]*[a-z0-9/])",
        r"(?i:(?<![a-z0-9_])(?:host(?:name)?|server|endpoint|base_?url)" + _LABEL + r"[a-z0-9][a-z0-9.:/_-]*[a-z0-9/])",
        r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9.]*[0-9])(?::[0-9]{2,5}+)?",
        r"(?i:(?<![a-z0-9.-])[a-z0-9-]{1,63}+(?:\.[a-z0-9-]{1,63}+){1,8}+:[0-9]{2,5}+(?![0-9]))",
    ]),
    "id": "|".join([
        r"(?i:(?<![a-z0-9_])(?:(?:aws_?)?access_?key_?id|client_?id|key_?id|app_?id|tenant_?id|user_?(?:name|id)?|login|account)" + _LABEL + r"[a-z0-9][a-z0-9@._+-]*[a-z0-9])",
        r"(?<![A-Z0-9])A(?:SIA|ROA|IDA|NPA|GPA)[A-Z0-9]{12,}+",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}+",
    ]),
    "secret": "|".join([
        r"(?i:(?<![a-z0-9_])(?:pwd|pass|passphrase|auth|credentials?|bearer|signature|(?:private|access|account|shared|client)_?key)" + _LABEL + r"[a-z0-9+/_.=-]{6,}+)",
        r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+",
    ]),
}
#: Without one of these a text has no weak candidate.
_WEAK_GATE = r"[0-9@:=]"
KINDS = [*BASE, *WEAK]
#: The part of a credential that each kind is.
ROLES = {"assign": "secret", "hex": "secret", "access": "id", "id": "id", "secret": "secret", "endpoint": "endpoint"}
#: Code points to both sides of a weak candidate in which its complements are looked for.
SCOPE = 200
BREAK = r"\n[\x20\t\r]*+\n"


def _found(docs: DataFrame) -> DataFrame:
    """(doc_id, row, kinds): matches of each base kind, of weak candidates and of blank lines, of each whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    nothing = F.array().cast("array<struct<gap:int,value:string,before:string,after:string>>")
    weak = "|".join(f"(?:{p})" for p in WEAK.values())
    patterns = {k: (GATES[k], p) for k, p in BASE.items()} | {"weak": (_WEAK_GATE, weak), "break": (BREAK, BREAK)}
    kinds = [F.struct(F.lit(kind).alias("kind"), F.when(F.rlike(text, F.lit(gate)), matches(text, F.lit(pattern))).otherwise(nothing).alias("found")) for kind, (gate, pattern) in patterns.items()]
    return stored(docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.filter(F.array(*kinds), lambda x: F.size(x["found"]) > 0).alias("kinds")))


def _is_base(kind: Column, value: Column) -> Column:
    return F.when(kind == "assign", F.char_length(F.regexp_replace(value, _ASSIGNED, "")) >= LEAST_ASSIGNED).otherwise(kind.isin("access", "hex"))


def _weak_kind(value: Column) -> Column:
    """The kind of a weak match; null for a long word that isn't mixed."""
    kind = F.lit(None).cast("string")
    labelled = F.rlike(value, F.lit(r"^[A-Za-z_]++" + _LABEL + r"[^=]"))
    for name, pattern in reversed(list(WEAK.items())):
        is_kind = F.rlike(value, F.lit(f"^(?:{pattern})$"))
        kind = F.when(is_kind & (labelled | _is_mixed(value)) if name == "secret" else is_kind, F.lit(name)).otherwise(kind)
    return kind


def _parts(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, low, high): base spans, and weak candidates that overlap none; low and high are the paragraph's bounds.

    Spans of a row are resolved in one pass in their order, whatever their number.
    """
    per_kind = found.select("row", F.explode("kinds").alias("k")).select("row", "k.kind", "k.found")
    spans = placed(per_kind, ["row", "kind"], "found").select("row", "kind", "start", "end", "value")
    kind = F.when(F.col("kind") == "weak", _weak_kind(F.col("value"))).when(F.col("kind") == "break", F.col("kind")).when(_is_base(F.col("kind"), F.col("value")), F.col("kind"))
    spans = stored(spans.withColumn("kind", kind).where("kind is not null").drop("value"))
    # What stands before and after, each by a running frame in its own order.
    row, place = Window.partitionBy("row"), ["start", "end", "kind"]
    before, after = (row.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1) for order in (place, [F.col(c).desc() for c in place]))
    is_base, is_break = F.col("kind").isin(*BASE), F.col("kind") == "break"
    base_end, base_start = F.max(F.when(is_base, F.col("end"))).over(before), F.min(F.when(is_base, F.col("start"))).over(after)
    low, high = F.max(F.when(is_break, F.col("end"))).over(before), F.min(F.when(is_break, F.col("start"))).over(after)
    told = spans.withColumns({"base_end": base_end, "base_start": base_start, "low": F.coalesce(low, F.lit(0).cast("long")), "high": F.coalesce(high, F.lit(2**62))})
    free = F.coalesce(F.col("base_end") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("base_start") >= F.col("end"), F.lit(True))
    return stored(told.where(~is_break & (is_base | free)).select("row", "kind", "start", "end", "low", "high"))


def linked(parts: DataFrame) -> DataFrame:
    """(row, kind, start, end) of the weak candidates whose complements stand in their scope.

    An identifier needs a secret, a secret an identifier or an endpoint, an endpoint an identifier and a secret. Scopes
    and parts meet by the blocks of text that they touch. A scope is short and parts of a kind don't overlap,
    so it meets few, however many a text has.
    """
    role = F.element_at(F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair]), F.col("kind"))
    width = 2 * SCOPE
    blocks = lambda low, high: F.explode(F.sequence(F.floor(low / width), F.floor((high - 1) / width)))
    weak = parts.where(F.col("kind").isin(*WEAK))
    begin, stop = F.greatest(F.col("start") - SCOPE, F.col("low")), F.least(F.col("end") + SCOPE, F.col("high"))
    scopes = weak.select("row", "kind", "start", "end", begin.alias("begin"), stop.alias("stop"))
    scopes = scopes.select("*", blocks(F.col("begin"), F.col("stop")).alias("block"))
    other = parts.select("row", F.col("start").alias("_start"), F.col("end").alias("_end"), role.alias("role"))
    other = other.select("*", blocks(F.col("_start"), F.col("_end")).alias("block"))
    met = scopes.join(shuffled(other), ["row", "block"]).where((F.col("_start") < F.col("stop")) & (F.col("_end") > F.col("begin")))
    has = {r: F.coalesce(F.bool_or(F.col("role") == r), F.lit(False)).alias(r) for r in set(ROLES.values())}
    seen = met.groupBy("row", "kind", "start", "end").agg(*has.values())
    needed = F.when(F.col("kind") == "id", F.col("secret")).when(F.col("kind") == "secret", F.col("id") | F.col("endpoint")).otherwise(F.col("id") & F.col("secret"))
    return seen.where(needed).select("row", "kind", "start", "end")


def secrets(docs: DataFrame) -> DataFrame:
    """Counts and places of secrets in each document; n_linked counts the weak candidates that were reported.

    A null text is empty and has none: its counts are 0, spans is an empty string and base_sha256 the
    hash of one. Repeated rows are searched each; an empty table gives an empty result; further
    columns are ignored. Texts, words and matches may have any length.
    """
    found = _found(docs)
    parts = _parts(found)
    spans = parts.where(F.col("kind").isin(*BASE)).select("row", "kind", "start", "end").unionByName(linked(parts))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    is_base = F.col("kind").isin(*BASE)
    per_row = stored(spans.groupBy(F.col("row").alias("_row")).agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE], F.count_if(~is_base).alias("n_linked"),
        F.array_sort(F.collect_list(F.struct("start", order.alias("o"), "end", "kind", is_base.alias("is_base")))).alias("all"),
    ))

    def printed(a: Column) -> Column:
        return F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    rows = found.select("doc_id", "row").join(shuffled(per_row), F.col("row") == F.col("_row"), "left")
    every_span = F.coalesce("all", F.array().cast(per_row.schema["all"].dataType))
    return rows.select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in [*[f"n_{k}" for k in BASE], "n_linked"]],
        F.sha2(printed(F.filter(every_span, lambda x: x["is_base"])), 256).alias("base_sha256"), printed(every_span).alias("spans"),
    )


def op13_linked_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(documents(spark, sf_dir))


QUERIES = {"op13_linked_credentials": op13_linked_credentials}
ORACLES: dict[str, str] = {}
