"""Which form the times of a column have, found from the column itself.

Each form is one bit. A value's bits are the forms that read it; the bits of all values and-ed are the forms that read the
whole column. One map-side count of the values by their bits finds them with the number of values that each form reads. If
several forms are left that differ in the order of day and month, the column does not tell them apart; month first is taken
then, and noted.

A text that a form does not read costs it an exception, so a value is only given to the forms that its shape admits: where
digits, words and separators stand. Every text that a form reads has its shape, and the form itself decides.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from ampline.functions.scalars import strip

# Spark patterns of the dates and times of day that are known, in the order of preference; ISO forms are read anyway.
DATES = [
    "M/d/yyyy", "d/M/yyyy", "yyyy/M/d", "M-d-yyyy", "d-M-yyyy", "M.d.yyyy", "d.M.yyyy", "yyyy.M.d",
    "d MMM yyyy", "d-MMM-yyyy", "MMM d yyyy", "MMM d, yyyy", "d MMMM yyyy", "MMMM d, yyyy", "yyyyMMdd",
]
TIMES = ["[ H:mm[:ss[.SSSSSS]]]", " h:mm[:ss[.SSSSSS]] a", "'T'H:mm[:ss[.SSSSSS]]"]
FORMS = [date + time for date in DATES for time in TIMES]
ISO = r"^\s*\d{4}-\d{1,2}(-|\s*$)"


@dataclass(frozen=True)
class Inferred:
    formats: tuple[str, ...]        # to be tried in turn
    ambiguous: bool = False         # day and month could be the other way round in every value
    mixed: bool = False             # no form reads all values that any form reads
    n_values: int = 0               # values that some form reads


def _order(form: str) -> tuple[bool, str]:
    """Whether the month comes before the day, and the rest of the form."""
    return form.index("M") < form.index("d"), form.replace("M", "x").replace("d", "x")


def _field(letters: str) -> str:
    if letters == "a" or letters.startswith("MMM"):
        return r"\D+"
    return rf"[+-]?\d{{{4 if letters == 'yyyy' else 1},}}"


def shape(pattern: str) -> str:
    """A regular expression that all texts match which the Spark pattern reads, and others of like shape."""
    parts = {"[": "(?:", "]": ")?", "'T'": r"[^\d ]"}
    return re.sub(
        r"'T'|[A-Za-z]+|.", lambda m: parts.get(m[0]) or (_field(m[0]) if m[0].isalpha() else re.escape(m[0])), pattern
    )


def bits_of(v: str) -> str:
    """The bits of the forms that read the text ``v``, as SQL: first by the shape of its date, then by that of the whole."""
    read = lambda date, time: f'if(try_to_timestamp({v}, "{date}{time}") is not null, {1 << FORMS.index(date + time)}L, 0L)'
    cases = []
    for like in dict.fromkeys(map(shape, DATES)):
        dates = [date for date in DATES if shape(date) == like]
        whole = [
            f"if({v} rlike r'^{like}{shape(time)}$', {' | '.join(read(date, time) for date in dates)}, 0L)" for time in TIMES
        ]
        cases.append(f"if({v} rlike r'^{like}', {' | '.join(whole)}, 0L)")
    return " | ".join(cases)


def infer_formats(texts: DataFrame, text: str) -> Inferred:
    """Forms of the times that ``text`` (a text column, or SQL) holds; none where its first value has an ISO form, as those are read anyway.

    Only a column whose first value has another form is read as a whole.
    """
    values = texts.selectExpr(f"{strip(text)} as v")
    first = values.where("v <> ''").selectExpr(f"v rlike r'{ISO}' as iso").first()
    if first is None or first.iso:
        return Inferred(())
    # At most as many rows as there are sets of forms that read one text.
    found = {r.bits: r["count"] for r in values.selectExpr(f"{bits_of('v')} as bits").groupBy("bits").count().collect() if r.bits}
    if not found:
        return Inferred(())
    n_values, common = sum(found.values()), reduce(int.__and__, found)
    if common:
        forms = [form for i, form in enumerate(FORMS) if common >> i & 1]
        best = forms[0]
        month_first, rest = _order(best)
        ambiguous = any(_order(form) == (not month_first, rest) for form in forms)
        return Inferred((best,), ambiguous=ambiguous, n_values=n_values)
    counts = [(sum(n for bits, n in found.items() if bits >> i & 1), form) for i, form in enumerate(FORMS)]
    ranked = sorted((x for x in counts if x[0]), key=lambda x: (-x[0], FORMS.index(x[1])))
    return Inferred(tuple(form for _, form in ranked), mixed=True, n_values=n_values)
