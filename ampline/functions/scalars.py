"""Scalar building blocks as SQL expression text, for ``selectExpr`` / ``where`` / ``expr``."""

from __future__ import annotations

from pyspark.sql import DataFrame

SECOND = 1_000_000

# Texts a CSV cell may hold to mean "missing".
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
LOCAL_ZONE = "Asia/Kolkata"

_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
_DATE_FIRST = r"^\s*\d{4}(-|\s*$)"
_OFFSET = r"(?i)(?<=:\d{2}|\.\d{1,9}|[AP]M)\s*(Z|UTC|GMT|[+-]\d{2}(:?\d{2})?)$"
_TIME_WITH_OFFSET = r"(?i):\d{2}(:\d{2}(\.\d+)?)?\s*(Z|UTC|GMT|[+-]\d{2}(:?\d{2})?)\s*$"


def text_list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def micros(ts: str) -> str:
    """Microseconds since 1970 of a naive timestamp (the session zone must be UTC)."""
    return f"unix_micros(cast({ts} as timestamp))"


def ntz_from_micros(us: str) -> str:
    return f"cast(timestamp_micros({us}) as timestamp_ntz)"


def seconds_between(start: str, end: str) -> str:
    return f"({micros(end)} - {micros(start)}) / 1e6D"


def round2(x: str) -> str:
    """Two decimals, halves of the scaled binary value to even."""
    return f"rint(({x}) * 100D) / 100D"


def strip(text: str) -> str:
    """Without white space of any kind at the ends, that of Unicode included."""
    return rf"regexp_replace({text}, r'(?U)^\s+|\s+$', '')"


def blank_missing(text: str) -> str:
    return f"case when {text} not in ({text_list(MISSING_TEXTS)}) then {text} end"


def no_nan(x: str) -> str:
    """NaN to NULL: Spark sorts NaN above every number, so caps would turn it into a value."""
    return f"case when not isnan({x}) then {x} end"


def to_number(text: str) -> str:
    """Text to double; NULL where it is no plain number, NaN included."""
    return f"case when {text} rlike r'{_NUMBER}' then try_cast(trim({text}) as double) end"


def _by_formats(text: str, formats: tuple[str, ...]) -> str:
    """Text read by the first format (a Spark datetime pattern) that fits it."""
    return "coalesce(" + ", ".join(f'cast(try_to_timestamp({text}, "{f}") as timestamp_ntz)' for f in formats) + ")"


def parse_local(text: str, formats: tuple[str, ...] = ()) -> str:
    """Naive timestamp taken as written. Text with an offset has no naive meaning: NULL."""
    parsed = (
        f"case when {text} rlike r'{_DATE_FIRST}' and not {text} rlike r'{_TIME_WITH_OFFSET}' "
        f"then try_cast(trim({text}) as timestamp_ntz) end"
    )
    return f"coalesce({parsed}, {_by_formats(strip(text), formats)})" if formats else parsed


def _with_colon(text: str) -> str:
    """Stripped text whose offset, if it has one, is written with a colon."""
    dated = rf"regexp_replace({strip(text)}, r'\s*IST\+0530', '+05:30')"
    return rf"regexp_replace({dated}, r'(:\d{{2}}(?:\.\d+)?)\s*([+-]\d{{2}})(\d{{2}})$', '$1$2:$3')"


def without_offset(text: str) -> str:
    """The text of a time without its offset, if it has one."""
    return rf"regexp_replace({_with_colon(text)}, r'{_OFFSET}', '')"


def parse_to_ist(text: str, formats: tuple[str, ...] = ()) -> str:
    """Text read as UTC unless it names an offset, shifted to Indian wall clock."""
    colon = _with_colon(text)
    zoned = (
        f"case when {colon} rlike r'{_TIME_WITH_OFFSET}' then {colon} "
        f"when {colon} rlike r':\\d{{2}}' then concat({colon}, 'Z') "
        f"when {colon} rlike r'^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$' then concat({colon}, 'T00:00:00Z') "
        f"else {colon} end"
    )
    instant = f"case when {text} rlike r'{_DATE_FIRST}' then try_cast({zoned} as timestamp) end"
    if formats:
        naive = f"date_format({_by_formats(without_offset(text), formats)}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
        offset = f"coalesce(nullif(trim(regexp_extract({colon}, r'{_OFFSET}', 0)), ''), 'Z')"
        instant = f"coalesce({instant}, try_cast(concat({naive}, {offset}) as timestamp))"
    return f"convert_timezone('UTC', '{LOCAL_ZONE}', cast({instant} as timestamp_ntz))"


def with_id_list(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add list text (JSON or Python literal) as ``array<bigint>``; one bad element voids the list.

    Accepted: square brackets, round brackets or braces around comma separated whole numbers,
    decimals (truncated) or quoted whole numbers; a bare comma separated row too.
    """
    bracketed = r"body rlike r'(?s)^(\[.*\]|\(.*\)|\{.*\})$'"
    inner = strip(rf"if({bracketed}, regexp_replace(body, r'(?s)^.|.$', ''), body)")
    # Round brackets or none make a list only with a comma, or as an empty pair.
    shaped = (
        r"body rlike r'(?s)^(\[.*\]|\{.*\}|\(\s*\))$' or (body <> '' and inner like '%,%')"
    )
    item = r"""^\s*("\s*[+-]?\d+\s*"|\x27\s*[+-]?\d+\s*\x27|[+-]?\d+(\.\d*)?([eE][+-]?\d+)?)\s*$"""
    bare = r"""regexp_replace(x, r'[\s"\x27]', '')"""
    to_id = (
        f"case when x rlike r'{item}' then coalesce(try_cast({bare} as bigint), "
        f"try_cast(try_cast({bare} as double) as bigint)) end"
    )
    ids = (
        "if(inner = '', cast(array() as array<bigint>), "
        rf"transform(split(regexp_replace(inner, r',\s*$', ''), ','), x -> {to_id}))"
    )
    return (
        df.selectExpr("*", f"{strip(text)} as body")
        .selectExpr("*", f"{inner} as inner")
        .selectExpr("*", f"if({shaped}, {ids}, null) as parsed")
        .selectExpr(*df.columns, f"if(exists(parsed, x -> x is null), null, parsed) as {name}")
    )


def python_quote(text: str) -> str:
    """Text in quotes, double ones only where it holds single but no double quotes."""
    escaped = rf"replace({text}, r'\', r'\\')"
    return (
        rf"""case when contains({text}, "'") and not contains({text}, '"') then concat('"', {escaped}, '"') """
        rf"""else concat("'", replace({escaped}, "'", r"\'"), "'") end"""
    )


def _is_place(df: DataFrame, row_ord: str) -> bool:
    return dict(df.dtypes)[row_ord].startswith("struct")


def no_chunk(prio: str = "0") -> str:
    return f"named_struct('prio', cast({prio} as int), 'file', '', 'block', 0L)"


def file_chunk(df: DataFrame, row_ord: str, prio: str = "0") -> str:
    """Coarse, order-keeping place of the stretch of input a row came from, behind a source's priority."""
    if _is_place(df, row_ord):
        return f"named_struct('prio', cast({prio} as int), 'file', {row_ord}.file, 'block', {row_ord}.block)"
    return f"named_struct('prio', cast({prio} as int), 'file', '', 'block', shiftright({row_ord}, 20))"


def file_place(df: DataFrame, row_ord: str) -> str:
    """A row's place as the text readers give it, whatever kind of number the feed has."""
    return row_ord if _is_place(df, row_ord) else as_place(row_ord)


def as_place(number: str) -> str:
    return f"named_struct('file', '', 'block', 0L, 'row', cast({number} as bigint))"
