"""The derived feeds written as text files, in the many forms that raw feeds have, and read back by the readers.

Rows keep their order: files are written in ranges of it and named by number.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampline.sources import readers
from ampline.sources.derived import DerivedFeeds
from ampline.staging import new_path

SLASHED = "yyyy/MM/dd HH:mm:ss.SSSSSS"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ARRAY_ROWS = 20_000
MISSING = "array('', 'NA', 'NaN', 'n/a', 'null')"


def _missing(value: str) -> str:
    return f"coalesce({value}, {MISSING}[cast(row_ord % 5 as int)])"


def _number(name: str) -> str:
    return f"{_missing(f'cast({name} as string)')} as {name}"


def _tlm_text(tlm: DataFrame) -> DataFrame:
    time = (
        f"case row_ord div 2 % 4 when 0 then date_format(TIMESTAMP, '{MICROS}') "
        f"when 1 then date_format(TIMESTAMP, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") "
        f"when 2 then concat(' ', date_format(TIMESTAMP, '{MICROS}'), ' ') else date_format(TIMESTAMP, '{SLASHED}') end"
    )
    return tlm.selectExpr(
        "row_ord", "row_ord as `Unnamed: 0`", "ID", "VEHICLE_ID", f"coalesce({time}, 'never') as TIMESTAMP", _number("SPEED"),
        f"{_missing('IGNITION_STATUS')} as IGNITION_STATUS", _number("EV_BATTERY_LEVEL"), _number("ODOMETER"),
    )


def _utc(local: str) -> str:
    return f"convert_timezone('Asia/Kolkata', 'UTC', {local})"


def _zoned(local: str) -> str:
    """A wall clock in India, written with or without its offset or in UTC."""
    return (
        f"case row_ord div 2 % 5 when 0 then date_format({_utc(local)}, '{MICROS}') "
        f"when 1 then concat(date_format({_utc(local)}, '{MICROS}'), 'Z') "
        f"when 2 then concat(date_format({local}, '{MICROS}'), ' IST+0530') "
        f"when 3 then concat(date_format({local}, '{MICROS}'), '+05:30') "
        f"else concat(date_format({_utc(local)}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+0000') end"
    )


def _trg_text(trg: DataFrame) -> DataFrame:
    return trg.selectExpr("row_ord", f"coalesce({_zoned('CTS')}, 'never') as CTS", "PNID", "NAME", "VAL")


def _map_text(map_: DataFrame) -> DataFrame:
    body = "regexp_replace(IDS, '^.|.$', '')"
    ids = (
        "case when IDS is null or IDS like 'b%' or IDS = '[]' then IDS "
        f"""when row_ord div 2 % 4 = 0 then concat('(', {body}, ')') """
        f"""when row_ord div 2 % 4 = 1 then concat("['", replace({body}, ',', "', '"), "']") """
        f"""when row_ord div 2 % 4 = 2 then concat('["', replace({body}, ',', '","'), '"]') else IDS end"""
    )
    return map_.selectExpr("row_ord", "ID", f"{_missing(ids)} as IDS")


def _syn_text(syn: DataFrame) -> DataFrame:
    return syn.selectExpr("row_ord", "vehicleId", f"{_zoned('timestamp')} as timestamp", "type")


#: Rows whose text has a fault, by their number: a unit behind the speed, a decimal comma, a letter before the PNID, a cell
#: too many, or the last cell missing.
FAULTS = {"unit": 31, "comma": 46, "letter": 83, "extra": 53, "cut": 59}


def _hit(fault: str) -> str:
    return f"row_ord % {FAULTS[fault]} = 0"


def _faulty_tlm(tlm: DataFrame) -> DataFrame:
    return _tlm_text(tlm).selectExpr(
        "row_ord", "`Unnamed: 0`", "ID", "VEHICLE_ID", "TIMESTAMP",
        f"if({_hit('unit')} and SPEED rlike '[0-9]', concat(SPEED, ' km/h'), SPEED) as SPEED", "IGNITION_STATUS", "EV_BATTERY_LEVEL",
        f"if({_hit('comma')} and ODOMETER rlike '[0-9]', '12,5', ODOMETER) as ODOMETER",
    )


def _faulty_trg(trg: DataFrame) -> DataFrame:
    return _trg_text(trg).selectExpr(
        "row_ord", "CTS", f"if({_hit('letter')}, concat('P', PNID), cast(PNID as string)) as PNID", "NAME", "VAL"
    )


def _faulty_lines(rows: DataFrame, names: list[str]) -> DataFrame:
    """CSV records, some with a cell too many or one too few; the column's name is the header."""
    options = "map('escape', '\"', 'ignoreLeadingWhiteSpace', 'false', 'ignoreTrailingWhiteSpace', 'false')"
    record = lambda cells: f"to_csv(struct({', '.join(f'`{c}`' for c in cells)}), {options})"
    line = (
        f"case when {_hit('extra')} then concat({record(names)}, ',x') "
        f"when {_hit('cut')} then {record(names[:-1])} else {record(names)} end"
    )
    return rows.selectExpr("row_ord", f"{line} as `{','.join(names)}`")


class TextFeeds:
    """The four feeds, each written and read when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._typed = spark, DerivedFeeds(spark, sf_dir)
        self._folder = new_path(spark, "text")

    def _csv(self, rows: DataFrame, name: str) -> str:
        path = f"{self._folder}/{name}"
        ordered = rows.orderBy("row_ord").drop("row_ord")
        ordered.write.options(**readers.table_options("csv")).csv(path)
        return path

    @cached_property
    def tlm(self) -> DataFrame:
        return readers.read_tlm(self._spark, self._csv(_tlm_text(self._typed.tlm), "tlm"), (SLASHED,))

    @cached_property
    def trg(self) -> DataFrame:
        return readers.read_trg(self._spark, self._csv(_trg_text(self._typed.trg), "trg"))

    @cached_property
    def tlm_lines(self) -> DataFrame:
        """Telemetry whose statuses hold line breaks in their quoted cells."""
        text = _tlm_text(self._typed.tlm).withColumn("IGNITION_STATUS", F.expr(
            r"if(row_ord div 2 % 3 = 0 and lower(trim(IGNITION_STATUS)) in ('on', 'off', 'unknown'), concat('\n', IGNITION_STATUS, '\n'), IGNITION_STATUS)"
        ))
        return readers.read_tlm(self._spark, self._csv(text, "tlm-lines"), (SLASHED,), multi_line=True)

    def in_form(self, form: str) -> readers.Feeds:
        """Feeds whose times are all written in one form (a Spark pattern) that the readers are not told."""
        time = lambda name: f"coalesce(date_format({name}, '{form}'), 'never')"
        zoned = lambda name: f"coalesce(concat(date_format({name}, '{form}'), ' IST+0530'), 'never')"
        tlm = _tlm_text(self._typed.tlm).drop("TIMESTAMP").join(
            self._typed.tlm.selectExpr("row_ord", f"{time('TIMESTAMP')} as TIMESTAMP"), "row_ord"
        )
        trg = self._typed.trg.selectExpr("row_ord", f"{zoned('CTS')} as CTS", "PNID", "NAME", "VAL")
        syn = self._typed.syn.selectExpr("row_ord", "vehicleId", f"{zoned('timestamp')} as timestamp", "type")
        path = f"{self._folder}/syn-form"
        syn.orderBy("row_ord").drop("row_ord").write.json(path)
        return readers.read_feeds(
            self._spark, self._csv(tlm, "tlm-form"), self._csv(trg, "trg-form"),
            self._csv(_map_text(self._typed.map), "map-form"), path, lines=True,
        )

    def _records(self, rows: DataFrame, name: str) -> str:
        path = f"{self._folder}/{name}"
        lines = _faulty_lines(rows, [c for c in rows.columns if c != "row_ord"]).orderBy("row_ord").drop("row_ord")
        lines.write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)
        return path

    @cached_property
    def faulty(self) -> readers.Feeds:
        """Telemetry and triggers with faulty records and cells."""
        tlm = readers.read_tlm(self._spark, self._records(_faulty_tlm(self._typed.tlm), "tlm-faulty"), (SLASHED,))
        trg = readers.read_trg(self._spark, self._records(_faulty_trg(self._typed.trg), "trg-faulty"))
        return readers.Feeds(tlm, trg, self.map, self.syn_lines)

    @cached_property
    def map(self) -> DataFrame:
        return readers.read_map(self._spark, self._csv(_map_text(self._typed.map), "map"))

    @cached_property
    def syn(self) -> DataFrame:
        """Files of one array each, of a bounded stretch of row numbers."""
        items = _syn_text(self._typed.syn).selectExpr(
            f"row_ord div {ARRAY_ROWS} as stretch", "struct(vehicleId, timestamp, type) as item"
        )
        path = f"{self._folder}/syn"
        arrays = items.groupBy("stretch").agg(F.expr("to_json(collect_list(item)) as value"))
        arrays.write.partitionBy("stretch").text(path)
        return readers.read_syn(self._spark, path)

    @cached_property
    def syn_lines(self) -> DataFrame:
        path = f"{self._folder}/syn-lines"
        _syn_text(self._typed.syn).orderBy("row_ord").drop("row_ord").write.json(path)
        return readers.read_syn(self._spark, path, lines=True)
