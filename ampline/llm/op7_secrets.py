"""Secrets: strong patterns, and weak candidates linked to complementary parts nearby. DataFrame operations only.

Base kinds are assign (a named value), access (access key identifiers) and hex (long hex runs). Weak kinds prove nothing
alone: key (40 characters of base 64 with lower and upper case letters and digits), user (a named identifier) and
endpoint (the address of a service). Every span has a role: identifier (access, user), secret (assign, hex, key) or
endpoint. A weak span is reported if a span of another role lies in its scope, SCOPE_CHARS before or after it, of which
one of the two is strong, or if a key and a user share a scope; endpoints need an identifier or a secret that is strong.

The link is an interval join: strong and weak parts are put into bins of SCOPE_CHARS, the partners into all bins that
their scope touches, and parts of one document and bin are compared by their ends. Bins split a document with very many
parts; a document without weak parts takes no part in the join. Null texts count as empty; rows are handled one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampline.llm.common import documents
from ampline.llm.spans import count_of, merged, no_spans, spans, spelled
from ampline.staging import stage

KINDS = ("assign", "access", "hex", "key", "user", "endpoint")
N_BASE = 3
IDENTIFIER, SECRET, ENDPOINT = 0, 1, 2
ROLES = (SECRET, IDENTIFIER, SECRET, SECRET, IDENTIFIER, ENDPOINT)
SCOPE_CHARS = 200

ASSIGN = r"""(?=[PpSsTtAa])(?i:(password|passwd|secret|token|api_?key))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
KEY = r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]{0,39}[a-z])(?=[A-Za-z0-9+/]{0,39}[A-Z])(?=[A-Za-z0-9+/]{0,39}[0-9])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
USER = r"""(?i:\b(user|username|login|client_?id|access_?key_?id|account))["']? {0,4}[:=] {0,4}["']?[A-Za-z0-9+/_.@-]{3,}+"""
SERVICE = r"(?i:\b(?:https?|ftp|ssh|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\s\"'<>]{4,}+)"


def long_value(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 6


def find(text: Column) -> tuple[Column, Column]:
    """Base and weak spans of a text without nulls."""
    base = merged(spans(text, ASSIGN, 0, long_value), spans(text, ACCESS, 1), spans(text, HEX, 2))
    return base, merged(spans(text, KEY, 3), spans(text, USER, 4), spans(text, SERVICE, 5))


def _parts(rows: DataFrame, column: str) -> DataFrame:
    roles = F.array(*[F.lit(r) for r in ROLES])
    part = rows.select("at", F.posexplode(column).alias("place", "part"))
    part = part.select("at", "place", "part.start", "part.end", "part.kind")  # a long hit would go into every bin of its span
    return part.withColumn("role", F.get(roles, F.col("kind"))).withColumn("strong", F.col("kind") < N_BASE)


def linked(rows: DataFrame) -> DataFrame:
    """at, linked: places in weak of the spans of ``rows`` (at, base, weak) that a complementary part in their scope confirms."""
    crowded = rows.where(F.size("weak") > 0)
    weak = _parts(crowded, "weak")
    partners = weak.unionByName(_parts(crowded, "base"))

    def bins(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / SCOPE_CHARS), F.floor(high / SCOPE_CHARS)))

    left = weak.select("*", bins(F.col("start"), F.col("end")).alias("bin"))
    right = partners.select(
        F.col("at").alias("its_at"), F.col("start").alias("its_start"), F.col("end").alias("its_end"),
        F.col("role").alias("its_role"), F.col("strong").alias("its_strong"), F.col("kind").alias("its_kind"),
        bins(F.col("start") - SCOPE_CHARS, F.col("end") + SCOPE_CHARS).alias("its_bin"),
    )
    near = (
        (F.col("at") == F.col("its_at")) & (F.col("bin") == F.col("its_bin"))
        & (F.col("start") < F.col("its_end") + SCOPE_CHARS) & (F.col("its_start") - SCOPE_CHARS < F.col("end"))
    )
    complementary = (F.col("role") != F.col("its_role")) & (
        F.col("its_strong") | (F.lit(KINDS.index("key")) + KINDS.index("user") == F.col("kind") + F.col("its_kind"))
    )
    apart = (F.col("end") <= F.col("its_start")) | (F.col("its_end") <= F.col("start"))
    found = left.join(right, near & complementary & apart, "left_semi").select("at", "place").distinct()
    return found.groupBy("at").agg(F.collect_list("place").alias("linked"))


def secrets(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` but the text in ``row``; base and all, arrays of start, kind (place in KINDS), end and hit."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base, weak = find(text)
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("row"), base.alias("base"), weak.alias("weak"))
    rows = stage(rows.withColumn("at", F.monotonically_increasing_id()), "secret-parts")  # fixes ``at``
    links = linked(rows).withColumnRenamed("at", "of")
    joined = rows.join(links, rows["at"] == links["of"], "left")
    confirmed = F.transform("linked", lambda place: F.get("weak", place))
    return joined.select("row", "base", merged(F.col("base"), F.coalesce(confirmed, no_spans())).alias("all"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[count_of(F.col("base"), i).alias(f"n_{KINDS[i]}") for i in range(N_BASE)],
        F.sha2(spelled(F.col("base"), KINDS), 256).alias("base_sha256"),
        spelled(F.col("all"), KINDS).alias("spans"),
    )
