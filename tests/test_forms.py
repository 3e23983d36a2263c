"""Forms of time by the shape of a text: no form that reads a text is missed, and few others are tried."""

import re
import time

import pytest

from ampline.functions.scalars import parse_local, without_offset
from ampline.sources import formats
from ampline.sources.formats import DATES, FORMS, infer_formats

ODD = [
    "1/2/2024", "+1/2/2024", "-1/2/2024", "1/-2/2024", "0001/02/2024", "2024/0001/0002", "1/2/12024", "1/2/+12024", "1/2/-2024", "1/2/24",
    "1/2/024", "2 mar 2024", "2 MARCH 2024", "2 MAY 2024", "2 aprıl 2024", "2 ſep 2024", "2  Mar 2024", "2 03 2024", "Mar 2, 2024",
    "mar 2 , 2024", "Mar 2 2024 1:02 pm", "Mar 2 2024 1:02  pm", "Mar 2 2024 13:02 PM", "Mar 2 2024 1:02 p.m.", "Mar 2 2024 1:02 PM",
    "2-Mar-2024t1:02", "2-Mar-2024 1:2", "2-Mar-2024 1:02:3", "2-Mar-2024 1:02:03.1", "2-Mar-2024 1:02:03.1234567", "2-Mar-2024 25:00",
    "20240302", "120240302", "+120240302", "2024032", "20241302", "20240302T1:02", "20240302 1:02 AM", "30.2.2024", "29.2.2024", "29.2.2023",
    "2024.2.30", "2024.2.29", "１/２/2024", "1/2/2024\n", "1/2/2024 ", "1/2/2024 1:02 é", "1-2-2024", "never", "", "/", "1/2", "a" * 5000,
    "1" * 5000, " ", "12:00", "2024-01-02", "BC 2024", "1/2/2024 0:00 AM", "1/2/2024 12:00:00.000001 AM", "1/2/2024Z", None,
]


def test_no_form_that_reads_a_text_is_missed(spark):
    days = "'2024-01-02 03:04:05.678901', '2024-05-28 13:00:00', '1999-12-31 00:00:00.5', '2024-09-09 12:59:59'"
    written = [form.replace("[", "").replace("]", "") for form in FORMS] + DATES
    made = spark.sql(
        f"select explode(array({', '.join(f'date_format(d, {chr(34)}{w}{chr(34)})' for w in written)})) as v "
        f"from (select explode(array({days})) as t) lateral view explode(array(cast(t as timestamp))) as d"
    )
    odd = spark.createDataFrame([(v,) for v in ODD], "v string")
    cut = made.selectExpr("substr(v, 1, length(v) - 1) as v").union(made.selectExpr("lower(v) as v")).union(made.selectExpr("concat(v, 'x') as v"))
    plain = ", ".join(f'if(try_to_timestamp(v, "{form}") is not null, {i}, null)' for i, form in enumerate(FORMS))
    rows = made.union(odd).union(cut).selectExpr("v", f"array_compact(array({plain})) as plain", f"{formats.bits_of('v')} as bits").collect()
    assert {i for r in rows for i in r.plain} == set(range(len(FORMS)))
    for r in rows:
        assert [i for i in range(len(FORMS)) if r.bits >> i & 1] == r.plain, r.v


def test_a_text_is_tried_by_few_forms():
    """At most those of one time of day and two dates, of 45."""
    for text in ["28/02/2024 10:00:00.5", "28.02.2024", "2 Mar 2024 1:02:03.000000 PM", "March 2, 2024T10:00", "20240302", "never"]:
        tried = [form for form in FORMS if re.fullmatch(formats.shape(form), text)]
        assert len(tried) <= 2, tried


def taken(work):
    times = []
    for _ in range(2):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return min(times)


@pytest.mark.parametrize("form,text", [
    ("dd.MM.yyyy HH:mm:ss.SSSSSS", "concat(v, ' IST+0530')"), ("d MMM yyyy h:mm:ss.SSSSSS a", "v"), ("dd/MM/yyyy HH:mm:ss.SSSSSS", "v"),
])
def test_finding_a_form_costs_little_more_than_reading_by_it(spark, form, text):
    """Each text was given to all 45 forms, some of them several times, at the price of an exception each."""
    texts = spark.range(100_000, numPartitions=4).selectExpr(
        f'date_format(timestamp_micros(1704067200000000 + id * 1000003), "{form}") as v'
    ).selectExpr(f"{text} as t").cache()
    assert texts.count() == 100_000
    found = infer_formats(texts, without_offset("t"))
    assert found.n_values == 100_000 and len(found.formats) == 1 and found.ambiguous == (form[:2] == "dd")
    reading = lambda: texts.selectExpr(f"{parse_local(without_offset('t'), found.formats)} as x").where("x is not null").count()
    assert reading() == 100_000
    assert taken(lambda: infer_formats(texts, without_offset("t"))) < 6 * taken(reading) + 1
    texts.unpersist()
