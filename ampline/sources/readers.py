"""Readers of the four raw feeds. Each adds ``row_ord``, a place that follows file order, and ``faults``.

Times are read in ISO forms; ``formats`` names further forms (Spark datetime patterns) that are tried in turn. Without it
they are inferred from a column whose first value has no ISO form.

``faults`` lists what could not be read of a row: kind (malformed: the record as it stands; number: a cell that should be
one), item (the cell's column) and value. Rows with faults stay in the feed, a cell that is no number as missing; of a
record with too few or too many cells, the missing ones are missing and further ones left out. A JSON record that can't be
read has no time.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ampline.functions.scalars import blank_missing, parse_local, parse_to_ist, to_number, without_offset
from ampline.sources.formats import Inferred, infer_formats

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
EVENT_OUTPUT = "vehicle_id string, event string, event_ts timestamp_ntz"
SESSION_OUTPUT = (
    "vehicle_id string, start_ts timestamp_ntz, end_ts timestamp_ntz, delta_battery_pct double, "
    "start_battery_pct double, end_battery_pct double, duration_sec double, ignition_state string"
)


FAULTS = "array<struct<kind: string, item: string, value: string>>"
MALFORMED = "malformed_record"
Formats = tuple[str, ...] | None


class Note(NamedTuple):
    """What a reader has to say about a feed as a whole; becomes a finding."""

    stage: int
    item: str
    n_rows: int
    detail: str


class Feeds(NamedTuple):
    tlm: DataFrame
    trg: DataFrame
    map: DataFrame
    syn: DataFrame
    notes: tuple[Note, ...] = ()


def with_file_order(df: DataFrame, columns: list[str]) -> DataFrame:
    """Project ``columns`` and give each row its place: file by name, block in the file, row id.

    The kind of the place is the same for one file or many, and every sort compares it field by field.
    """
    place = (
        "named_struct('file', _metadata.file_path, 'block', _metadata.file_block_start, "
        "'row', monotonically_increasing_id()) as row_ord"
    )
    return df.selectExpr(place, *columns)


def _csv(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """All cells as text, and the record itself where it has too few or too many cells.

    ``multi_line``: quoted cells may hold line breaks; files are not split then.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    # Columns are picked by name later, so an unnamed index column does no harm.
    names = reader.csv(path).columns
    cells = T.StructType([T.StructField(name, T.StringType()) for name in [*names, MALFORMED]])
    # Cells can only be counted where none are skipped.
    return reader.schema(cells).option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False).csv(path)


def _fault(kind: str, item: str, value: str, when: str) -> str:
    return f"if({when}, named_struct('kind', '{kind}', 'item', '{item}', 'value', {value}), null)"


def _faults(cell: str, numbers: dict[str, str]) -> str:
    """Faults of a record and of its ``numbers`` (text column to the value read from it).

    ``cell``: any column. It is named beside the malformed record, as raw files can't be asked for that alone.
    """
    items = [
        _fault("malformed", "", f"coalesce({MALFORMED}, {cell})", f"{MALFORMED} is not null"),
        *[_fault("number", name, name, f"{name} is not null and ({value}) is null") for name, value in numbers.items()],
    ]
    return f"cast(filter(array({', '.join(items)}), x -> x is not null) as {FAULTS}) as faults"


def with_faults(feed: DataFrame) -> DataFrame:
    """A feed from elsewhere, without faults."""
    return feed if "faults" in feed.columns else feed.selectExpr("*", f"cast(array() as {FAULTS}) as faults")


def _text(name: str) -> str:
    return f"{blank_missing(name)} as {name}"


def _texts(df: DataFrame, names: list[str]) -> DataFrame:
    return with_file_order(df, [*[_text(n) for n in names], MALFORMED])


def _inferred(texts: DataFrame, text: str, formats: Formats) -> Inferred:
    return infer_formats(texts, text) if formats is None else Inferred(formats)


def _noted(inferred: Inferred, stage: int, tag: str, column: str) -> tuple[Note, ...]:
    form = inferred.formats[0] if inferred.formats else ""
    if inferred.ambiguous:
        text = f"{tag}: Day and month of column '{column}' could be swapped in all {inferred.n_values} values — read as {form}."
    elif inferred.mixed:
        text = f"{tag}: Column '{column}' mixes {len(inferred.formats)} forms of time — most frequent form {form}."
    else:
        return ()
    return (Note(stage, column, inferred.n_values, text),)


def _tlm(
    spark: SparkSession, path: str | list[str], formats: Formats, multi_line: bool
) -> tuple[DataFrame, tuple[Note, ...]]:
    numbers = {n: to_number(n) for n in ("SPEED", "EV_BATTERY_LEVEL", "ODOMETER")}
    texts = _texts(
        _csv(spark, path, multi_line),
        ["ID", "VEHICLE_ID", "TIMESTAMP", "SPEED", "IGNITION_STATUS", "EV_BATTERY_LEVEL", "ODOMETER"],
    )
    inferred = _inferred(texts, "TIMESTAMP", formats)
    feed = texts.selectExpr(
        "row_ord", "ID", "VEHICLE_ID", f"{parse_local('TIMESTAMP', inferred.formats)} as TIMESTAMP", f"{numbers['SPEED']} as SPEED",
        "IGNITION_STATUS", f"{numbers['EV_BATTERY_LEVEL']} as EV_BATTERY_LEVEL", f"{numbers['ODOMETER']} as ODOMETER",
        _faults("ID", numbers),
    )
    return feed, _noted(inferred, 1, "TLM", "TIMESTAMP")


def _trg(
    spark: SparkSession, path: str | list[str], formats: Formats, multi_line: bool
) -> tuple[DataFrame, tuple[Note, ...]]:
    number = f"try_cast({to_number('PNID')} as bigint)"
    texts = _texts(_csv(spark, path, multi_line), ["CTS", "PNID", "NAME", "VAL"])
    inferred = _inferred(texts, without_offset("CTS"), formats)
    feed = texts.selectExpr(
        "row_ord", f"{parse_to_ist('CTS', inferred.formats)} as CTS", f"{number} as PNID", "NAME", "VAL", _faults("NAME", {"PNID": number})
    )
    return feed, _noted(inferred, 8, "TRG", "CTS")


def _syn(spark: SparkSession, path: str | list[str], formats: Formats, lines: bool) -> tuple[DataFrame, tuple[Note, ...]]:
    raw = (
        spark.read.schema(f"vehicleId string, timestamp string, type string, {MALFORMED} string")
        .option("columnNameOfCorruptRecord", MALFORMED).option("multiLine", not lines).json(path)
    )
    texts = with_file_order(raw, ["vehicleId", f"if({MALFORMED} is null, timestamp, null) as timestamp", "type", MALFORMED])
    inferred = _inferred(texts, without_offset("timestamp"), formats)
    feed = texts.selectExpr(
        "row_ord", "vehicleId", f"{parse_to_ist('timestamp', inferred.formats)} as timestamp", "type", _faults("vehicleId", {})
    )
    return feed, _noted(inferred, 17, "SYN", "timestamp")


def read_tlm(spark: SparkSession, path: str | list[str], formats: Formats = None, multi_line: bool = False) -> DataFrame:
    return _tlm(spark, path, formats, multi_line)[0]


def read_trg(spark: SparkSession, path: str | list[str], formats: Formats = None, multi_line: bool = False) -> DataFrame:
    return _trg(spark, path, formats, multi_line)[0]


def read_map(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    return _texts(_csv(spark, path, multi_line), ["ID", "IDS"]).selectExpr("row_ord", "ID", "IDS", _faults("ID", {}))


def read_syn(spark: SparkSession, path: str | list[str], formats: Formats = None, lines: bool = False) -> DataFrame:
    """A JSON array per file, or with ``lines`` one object per line, which lets large files be split."""
    return _syn(spark, path, formats, lines)[0]


def read_feeds(
    spark: SparkSession, tlm: str | list[str], trg: str | list[str], map_: str | list[str], syn: str | list[str],
    formats: dict[str, tuple[str, ...]] | None = None, lines: bool = False, multi_line: bool = False,
) -> Feeds:
    """The four feeds with what their readers noted.

    ``formats``: forms of the times by feed (tlm, trg, syn); those of a feed that is not named are inferred.
    """
    known = (formats or {}).get
    (tlm_feed, tlm_notes), (trg_feed, trg_notes) = _tlm(spark, tlm, known("tlm"), multi_line), _trg(spark, trg, known("trg"), multi_line)
    syn_feed, syn_notes = _syn(spark, syn, known("syn"), lines)
    notes = (*tlm_notes, *trg_notes, *syn_notes)
    return Feeds(tlm_feed, trg_feed, read_map(spark, map_, multi_line), syn_feed, notes)


def table_options(fmt: str) -> dict[str, str]:
    """Options by which result tables are written and read: quotes are doubled and outer spaces kept."""
    if fmt != "csv":
        return {}
    return {
        "header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
        "timestampNTZFormat": TIME_FORMAT, "multiLine": "true", "emptyValue": '""',
    }


def read_results(spark: SparkSession, out_dir: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """Read back the written result tables; a table that does not exist is left out."""
    tables = {
        "IgnitionEvents": EVENT_OUTPUT,
        "ChargingEvents": SESSION_OUTPUT,
        "ChargingStatusEvents": EVENT_OUTPUT,
    }
    found = {}
    for name, schema in tables.items():
        reader = spark.read.schema(schema).options(**table_options(fmt)).format(fmt)
        try:
            found[name] = reader.load(f"{out_dir}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found
