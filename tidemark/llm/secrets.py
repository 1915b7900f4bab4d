"""Secrets, told from copied examples by who owns them.

Base spans follow fixed patterns. Further candidates are long opaque strings of letters and digits. The hash of
every candidate is counted over the whole corpus: in how many repositories and with how many owners it
occurs. A value that many owners hold is an example that was copied; one that a single owner holds looks live.
Opaque strings that look live become spans. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans
from tidemark.llm.common import pick, store

# The base patterns. A run that is too short has no long enough part, so the least length of
# a run can stand in the pattern; the value of an assignment is measured afterwards.
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']? *[:=] *["']?[A-Za-z0-9+/_.=-]+"""
VALUE = r"""(?i)^(?:password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)$"""
WORDS = r"(?i)password|passwd|secret|token|api_?key"
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
OPAQUE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"

# Owners from which on a value is a copied example.
COPIED = 3
# Different characters that an opaque string needs.
VARIETY = 12


def base(text: Column) -> dict[str, Column]:
    """Spans of each kind."""
    long_value = lambda s: F.length(F.regexp_extract(s["value"], VALUE, 1)) >= 6
    return {
        "assign": spans.found(text, ASSIGN, text.rlike(WORDS), long_value),
        "access": spans.found(text, ACCESS, F.contains(text, F.lit("AKIA"))),
        "hex": spans.found(text, HEX, text.rlike("[0-9a-f]{24}")),
    }


def opaque(text: Column) -> Column:
    """Long strings with small letters, capitals and digits, and enough different characters."""

    def random_looking(s: Column) -> Column:
        v = s["value"]
        varied = F.size(F.array_distinct(F.split(v, ""))) >= VARIETY
        return v.rlike("[0-9].*[0-9].*[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]") & varied

    return spans.found(text, OPAQUE, text.rlike("[A-Za-z0-9+/_-]{20}"), random_looking)


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, repositories, owners, standing) from (hash, repository, owner), each distinct pair counted once.

    Distinct pairs come first, so a value copied a million times is combined in every task before it is moved.
    """
    by_repository = candidates.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    counted = by_owner.groupBy("hash").agg(F.sum("repositories").alias("repositories"), F.count("*").alias("owners"))
    standing = F.when(F.col("owners") >= COPIED, "copied").when(F.col("owners") == 1, "live").otherwise("shared")
    return counted.withColumn("standing", standing)


def scan(df: DataFrame, repository: str = "doc_id", owner: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex`` and ``base_sha256`` of the base spans, ``spans`` of all,
    ``n_live``, ``n_copied``, ``n_opaque``.

    A null or empty text has no span; a null owner or repository counts as one of its own; repeated rows come
    out repeated and count once in the frequencies; an empty table gives an empty table; other columns are ignored.
    """
    docs = pick(df, doc_id=doc_id, text=text, repository=repository, owner=owner)
    body = F.coalesce(F.col("text"), F.lit(""))
    first = docs.select(
        F.col("doc_id").cast("bigint"),
        F.col("repository").cast("string"),
        F.col("owner").cast("string"),
        *[c.alias(k) for k, c in base(body).items()],
        opaque(body).alias("opaque"),
    ).withColumn("row", F.monotonically_increasing_id())
    first = store(first, "secrets")
    kinds = {k: F.col(k) for k in ("assign", "access", "hex", "opaque")}

    def valued(kind: str) -> Column:
        value = (lambda v: F.regexp_extract(v, VALUE, 1)) if kind == "assign" else (lambda v: v)
        return F.transform(F.col(kind), lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.sha2(value(s["value"]), 256).alias("hash")))

    each = first.select("row", "repository", "owner", F.explode(F.concat(*map(valued, kinds))).alias("s"))
    each = store(each.select("row", "repository", "owner", "s.*"), "candidates")
    known = store(ownership(each.select("hash", "repository", "owner")), "ownership")
    judged = each.join(known, "hash").groupBy("row").agg(
        F.count_if(F.col("standing") == "live").alias("n_live"),
        F.count_if(F.col("standing") == "copied").alias("n_copied"),
        F.collect_set(F.when((F.col("kind") == "opaque") & (F.col("standing") == "live"), F.struct("start", "end"))).alias("added"),
    )
    # An opaque string inside a base span says nothing new.
    joined = first.join(judged, "row", "left")
    inside = lambda s: F.exists(F.concat("assign", "access", "hex"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    listed = lambda s: F.array_contains("added", F.struct(s["start"], s["end"]))
    more = F.filter("opaque", lambda s: F.coalesce(listed(s), F.lit(False)) & ~inside(s))
    base_kinds = {k: kinds[k] for k in ("assign", "access", "hex")}
    done = joined.withColumn("more", more)
    return done.select(
        "doc_id",
        *[F.size(c).cast("bigint").alias(f"n_{k}") for k, c in base_kinds.items()],
        F.sha2(spans.joined(base_kinds), 256).alias("base_sha256"),
        spans.joined(base_kinds | {"opaque": F.col("more")}).alias("spans"),
        F.coalesce("n_live", F.lit(0).cast("bigint")).alias("n_live"),
        F.coalesce("n_copied", F.lit(0).cast("bigint")).alias("n_copied"),
        F.size("more").cast("bigint").alias("n_opaque"),
    )
