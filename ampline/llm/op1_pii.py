"""Personal data: patterns propose spans, checksums confirm them, context words adjust their score. SQL expressions only.

Base kinds are email, ip, card and phone; a card passes Luhn, an address has parts up to 255, a phone number 9 to 15
digits. The method adds iban (of the ends of words within its lengths, mod-97 chooses the one) and ssn (no checksum, so only context words can lift it to the
threshold). A span's score is its kind's prior, plus CONTEXT_GAIN if a word for its kind is within CONTEXT_CHARS before or
after it, other spans included. Base spans always stay; an added span stays from THRESHOLD on.

Patterns are written so that a search takes linear time on long texts without separators; they match what the plain
patterns match. Null texts count as empty and have no spans. Rows are handled one by one, repeated ones too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampline.llm.common import documents
from ampline.llm.spans import count_of, merged, spans, spelled

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
N_BASE = 4
PRIORS = (0.9, 0.7, 0.8, 0.6, 0.8, 0.3)
CONTEXT_GAIN = 0.3
CONTEXT_CHARS = 48
THRESHOLD = 0.5
CONTEXT = (
    r"\b(e-?mail|mail|contact|write)",
    r"\b(ip|host|server|address|login)\b",
    r"\b(card|visa|mastercard|amex|credit|payment|pay)",
    r"\b(phone|tel|call|mobile|fax|cell)",
    r"\b(iban|account|bank|transfer|sepa|konto|compte|cuenta)",
    r"\b(ssn|social security|social-security|taxpayer)",
)

#: A match starts where a run of address characters does, or where the match before it ended inside one.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
#: Whole chains of digits with single separators, of 12 to 19 digits.
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Country and check digits, with room for the shortest number behind.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?: ?[A-Z0-9]){11})"
#: The words behind that a number may consist of; it ends where one of them ends.
IBAN_WORDS = r"^[A-Z0-9]{0,30}+(?![A-Za-z0-9])(?: [A-Z0-9]{1,30}+(?![A-Za-z0-9])){0,30}+"
IBAN_MOST = 60  # characters of those words, 30 with a space before each
#: Length of the number by country, which decides between several ends that pass.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"


def ip_parts(hit: Column) -> Column:
    return F.forall(F.split(hit, r"\."), lambda part: F.coalesce(part.try_cast("int") <= 255, F.lit(False)))


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    """Every second digit from the right is doubled, its digits summed; the whole sum is a multiple of ten."""
    backwards = F.reverse(digits(hit))

    def add(total: Column, at: Column) -> Column:
        digit = F.substring(backwards, at, F.lit(1)).cast("int") * F.when(at % 2 == 0, 2).otherwise(1)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(backwards)), F.lit(0), add) % 10 == 0


def phone_digits(hit: Column) -> Column:
    return F.length(digits(hit)).between(9, 15)


def iban_end(head: Column, behind: Column) -> Column:
    """How many characters behind the head belong to its number, null without one that passes.

    A number has 15 to 34 letters and digits and ends where a word does. With its first four characters at the end and
    letters counted 10 to 35 it is 1 modulo 97. Of several such ends the one at the country's length is taken, else the last.
    """
    words = F.regexp_extract(behind, IBAN_WORDS, 0)
    country = F.substring(head, 1, 2)
    length = F.lit(0)
    for n, names in IBAN_LENGTHS.items():
        length = F.when(country.isin(names.split()), n).otherwise(length)

    def value(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    def add(done: Column, at: Column) -> Column:
        char = F.substring(done["words"], at, F.lit(1))
        n = done["n"] + F.when(char == " ", 0).otherwise(1)
        rest = F.when(char == " ", done["rest"]).otherwise(value(done["rest"], char))
        ends = (char != " ") & F.substring(done["words"], at + 1, F.lit(1)).isin("", " ")
        passes = ends & n.between(15, 34) & ((rest * (10**6 % 97) + done["front"]) % 97 == 1) & ~done["sure"]
        return F.struct(
            done["words"].alias("words"), done["front"].alias("front"), done["length"].alias("length"), rest.cast("int").alias("rest"), n.cast("int").alias("n"),
            F.when(passes, at).otherwise(done["best"]).cast("int").alias("best"),
            (done["sure"] | (passes & (n == done["length"]))).alias("sure"),
        )

    front = F.lit(0)
    for i in range(1, 5):
        front = value(front, F.substring(head, i, 1))
    begin = F.struct(
        words.alias("words"), front.cast("int").alias("front"), length.cast("int").alias("length"), F.lit(0).alias("rest"), F.lit(4).alias("n"),
        F.lit(None).cast("int").alias("best"), F.lit(False).alias("sure"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(IBAN_MOST)), begin, lambda d, at: F.when(at <= F.char_length(d["words"]), add(d, at)).otherwise(d), lambda d: d["best"])


def find(text: Column) -> tuple[Column, Column]:
    """Base spans and added candidates of a text without nulls."""
    patterns = ((EMAIL, None), (IP, ip_parts), (CARD, luhn), (PHONE, phone_digits), (IBAN, None), (SSN, None))
    ends = {IBAN: (iban_end, IBAN_MOST + 1)}
    found = [spans(text, pattern, kind, valid, CONTEXT_CHARS, *ends.get(pattern, ())) for kind, (pattern, valid) in enumerate(patterns)]
    return merged(*found[:N_BASE]), F.concat(*found[N_BASE:])


def scored(found: Column) -> Column:
    """Spans with their score."""
    priors, words = F.array(*[F.lit(p) for p in PRIORS]), F.array(*[F.lit(c) for c in CONTEXT])

    def score(span: Column) -> Column:
        gain = F.when(F.regexp_like(span["near"], F.get(words, span["kind"])), CONTEXT_GAIN).otherwise(0.0)
        total = F.round(F.get(priors, span["kind"]) + gain, 2)
        return F.struct(span["start"], span["kind"], span["end"], span["hit"], F.least(total, F.lit(1.0)).alias("score"))

    return F.transform(found, score)


def personal_data(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` in ``row``; base and all, arrays of start, kind (place in KINDS), end, hit and score."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    base, more = find(text)
    rows = rows.select("row", base.alias("base"), more.alias("more"))
    rows = rows.select("row", scored(F.col("base")).alias("base"), scored(F.col("more")).alias("more"))
    strong = F.filter("more", lambda s: s["score"] >= THRESHOLD)
    return rows.select("row", "base", merged(F.col("base"), strong).alias("all"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[count_of(F.col("base"), i).alias(f"n_{KINDS[i]}") for i in range(N_BASE)],
        F.sha2(spelled(F.col("base"), KINDS), 256).alias("base_sha256"),
        spelled(F.col("all"), KINDS).alias("spans"),
        F.round(F.coalesce(F.array_max(F.transform("all", lambda s: s["score"])), F.lit(0.0)), 2).alias("top_score"),
    )
