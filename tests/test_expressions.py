"""Column expressions against hand-written values and pandas."""

import datetime as dt
import math
import unicodedata

import pandas as pd
import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenderlens import functions as fn
from tenderlens.functions.duration import UNIT_DAYS
from tenderlens.operators.cleaning import cast_money

CURRENCY = {
    "$ 1,500,000": 1500000.0, "2.500.000,50": 2500000.5, " 350000 ": 350000.0, None: None,
    "1500,50": 1500.5, "12,5": 125.0, "1.500": 1.5, "1.500.000": None, "1,500,50": None,
    "-$ 500": -500.0, "COP 5": None, "(500)": None, "1,500,000.50": 1500000.5,
    "1500,": 1500.0, "1f": None, "1.0d": None, "": None, "1e400": None, "1e5": 100000.0, "1e300": 1e300, "1.7e308": 1.7e308, "-1e305": -1e305,
    "\xa0$\xa01.234,5\xa0": 1234.5, "inf": math.inf, "-Infinity": -math.inf, "nan": None,
    ".5": 0.5, "5.": 5.0, "+5": 5.0, "0x10": None, "1_000": None, "$\t7": 7.0,
}


def test_currency_texts(one_column):
    assert one_column(list(CURRENCY), "string", fn.parse_currency) == list(CURRENCY.values())


def test_plain_numbers_are_cast_as_they_are(one_column):
    texts = ["12.5", "-0.25E-7", "+3e05", "9" * 200 + "E99", "9" * 201 + "E99", "1E308", "12.5\n", "1.", "1E400", "९", "1f"]
    wanted = [12.5, -0.25e-7, 3e5, 1e299, 1e300, 1e308, 12.5, 1.0, None, None, None]
    assert one_column(texts, "string", fn.parse_number) == wanted
    assert one_column(texts, "string", fn.parse_currency) == wanted


def test_currency_numbers_pass_through(spark):
    table = spark.createDataFrame(
        [(1, 120000.0), (2, float("nan")), (3, None)], "precio_base int, valor_total_adjudicacion double"
    )
    assert [tuple(r) for r in cast_money(table).collect()] == [(1.0, 120000.0), (2.0, None), (3.0, None)]


# Shrinking would rerun a Spark job per step.
quick = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck),
                 phases=(Phase.explicit, Phase.generate))
number_texts = st.text(alphabet="0123456789.,$ -+eE\xa0", max_size=12)


@quick
@given(st.lists(number_texts, min_size=60, max_size=200))
def test_currency_rule_on_random_texts(one_column, texts):
    def rule(text):
        bare = "".join(c for c in text.strip() if c not in "$ \xa0")
        last_comma, last_point = bare.rfind(","), bare.rfind(".")
        if last_comma >= 0:
            decimal = last_comma > last_point if last_point >= 0 else len(bare) - last_comma == 3
            if decimal:
                bare = "".join(bare.split(".")).replace(",", ".")
            else:
                bare = "".join(bare.split(","))
        value = pd.to_numeric(pd.Series([bare], dtype=object), errors="coerce").iloc[0]
        return None if pd.isna(value) else float(value)

    got = one_column(texts, "string", fn.parse_currency)
    for text, value in zip(texts, got):
        assert value == pytest.approx(rule(text), rel=1e-15) if value is not None else rule(text) is None, text


DATES = [
    "2023-05-12T00:00:00.000", "2024-01-01", "invalido", None, "20230512", "2023/05/12",
    "2023-5-1", "2023-05", "2023", "202305", "2023-05-12T10", "2023-05-12T10:11", "2023-05-12T",
    "2023-13-01", "2023-02-30", "1500-01-01", "2300-01-01", "10000-01-01", " 2023-05-12",
    "2023-05-12 ", "20230512T101112", "2023-05-12T1011", "2023-05-12T24:00:00", "2023-W05",
    "1677-09-22", "2262-04-11", "2023-05-12 10:11:12.123456", "+2023-05-12", "NaT", "",
]


def test_dates_agree_with_pandas(one_column):
    expected = [pd.to_datetime(pd.Series([d]), errors="coerce", format="ISO8601").iloc[0] for d in DATES]
    expected = [None if pd.isna(e) else e.to_pydatetime() for e in expected]
    got = one_column(DATES, "string", fn.parse_iso_date)
    assert dict(zip(DATES, got)) == dict(zip(DATES, expected))


def test_date_offset_keeps_wall_clock(one_column):
    texts = ["2023-05-12T10:11:12Z", "2023-05-12T10:11:12+05:00", "2023-05-12T10:11:12.5-0500"]
    wall = dt.datetime(2023, 5, 12, 10, 11, 12)
    assert one_column(texts, "string", fn.parse_iso_date) == [wall, wall, wall.replace(microsecond=500000)]


def normal_form(text):
    if text is None:
        return ""
    folded = unicodedata.normalize("NFKD", text.strip().lower())
    return " ".join(folded.encode("ascii", "ignore").decode().split())


def test_normalize_text(one_column):
    texts = ["  Licitación   PÚBLICA ", None, "Año(s)", "ﬁn ½ ™ º", "ｆｕｌｌ", "\x1cx\x1f", "日本", "", "ǅ ℃ ㎏"]
    assert one_column(texts, "string", fn.normalize_text) == [normal_form(t) for t in texts]


def test_fold_covers_every_code_point(spark):
    codes = [c for c in range(0x20, 0x30000) if not 0xD800 <= c <= 0xDFFF]
    table = spark.createDataFrame([(c, chr(c)) for c in codes], "c int, x string")
    got = table.select("c", fn.fold_ascii(F.col("x"))).collect()
    bad = [
        hex(c) for c, text in got
        if text != unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode()
    ]
    assert bad == []


@quick
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", max_codepoint=0x24F), max_size=10),
                min_size=50, max_size=100))
def test_normalize_random_text(one_column, texts):
    assert one_column(texts, "string", fn.normalize_text) == [normal_form(t) for t in texts]


def test_strip_keeps_inner_text(one_column):
    texts = ["  Régimen   Especial \t", " x ", "a", None]
    assert one_column(texts, "string", fn.strip_text) == ["Régimen   Especial", "x", "a", None]


DURATIONS = [
    ("3", "Mes(es)", 90.0), ("2", "meses", 60.0), ("45", "día(s)", 45.0), ("15", "dias", 15.0),
    ("1", "Año(s)", 365.0), ("0.5", "anos", 182.5), ("invalido", "dias", None),
    ("6", "Semestre", 180.0), ("2", "Semana(s)", 2.0), ("5", None, 5.0), (None, "dias", None),
    ("1", "AÑO", 365.0), ("3", "Hora(s)", 3.0), ("1e400", "dias", math.inf), ("nan", "mes", None),
]


def test_durations(spark):
    table = spark.createDataFrame(DURATIONS, "d string, u string, days double")
    number = fn.parse_number(F.col("d"), keep_overflow=True)
    got = table.select("days", fn.duration_days(number, F.col("u"))).collect()
    assert [r[1] for r in got] == [r[0] for r in got]


def test_durations_in_units_with_other_letters(one_column):
    units = ["\u00a0Me\u0301s\u2003", "ｍｅｓ", "me\u00adses", "mes日", "ªno", "AÑO\t", "dí\u200ba", "día日", "日", "", "ĀNO", "ſemana", "DÍAS de mes"]
    days = [30.0, 30.0, 30.0, 30.0, 365.0, 365.0, 1.0, 1.0, 1.0, 1.0, 365.0, 1.0, 30.0]
    assert one_column(units, "string", lambda unit: fn.duration_days(F.lit(1.0), unit)) == days
    whole = one_column(units, "string", lambda unit: fn.fold_ascii(F.lower(fn.strip_text(unit))))
    assert [next((d for word, d in UNIT_DAYS if word in text), 1.0) for text in whole] == days


def test_bands(one_column):
    values = [None, 0.0, 1.0, 2.0, 3.0, 4.0, 9.0, 10.0, 1.5, 3.5, 9.5]
    bands = one_column(values, "double", fn.competition_band)
    assert [fn.BAND_LABELS.index(b) + 1 for b in bands] == [1, 1, 1, 2, 2, 3, 3, 4, 4, 4, 4]


@quick
@given(st.lists(st.floats(min_value=-1e10, max_value=1e10), min_size=50, max_size=100))
def test_number_formats(one_column, values):
    values = values + [0.125, 2.675, -0.001, 1234.5, 2.5, 999.5]
    assert one_column(values, "double", fn.money_text) == [f"${v:,.2f}" for v in values]
    assert one_column(values, "double", fn.days_text) == [f"{v:,.1f} días" for v in values]
    assert one_column(values, "double", fn.skew_text) == [f"{v:,.4f}" for v in values]
    assert one_column(values, "double", fn.percent_text) == [f"{v:.2f}%" for v in values]
    signed = one_column(values, "double", lambda c: fn.percent_text(c, signed=True))
    assert signed == [f"{v:+,.2f}%" for v in values]


def test_missing_formats(one_column):
    assert one_column([None], "double", fn.money_text) == ["N/A"]
    assert one_column([None], "double", fn.days_text) == ["N/A"]


@pytest.mark.parametrize("signed, decimals", [(False, 0), (True, 1)])
def test_compact_money(one_column, signed, decimals):
    def rule(v):
        size = abs(v) if signed else v
        for scale, mark, digits in [(1e12, "T", 1), (1e9, "B", 1), (1e6, "M", decimals), (1e3, "K", 0)]:
            if size >= scale:
                return f"${v / scale:.{digits}f}{mark}"
        return f"${v:.0f}"

    values = [0.0, 12.4, 999.6, 1e3, 1.5e3, 2.5e6, 1.25e9, 7.77e12, 1.2e16, -5.0, -2.5e6, -3e12]
    got = one_column(values, "double", lambda c: fn.compact_money(c, decimals, signed))
    assert got == [rule(v) for v in values]


def test_feature_labels(one_column):
    names = ["num__precio_base_log", "num__duracion_dias_prevista", "num__proveedores_unicos_con",
             "cat__modalidad_de_contratacion_Mínima Cuantía"]
    assert one_column(names, "string", fn.feature_label) == [
        "Precio Base [log1p]", "Duración Prevista (Días)", "Concurrencia Oferentes (N°)",
        "Modalidad: Mínima Cuantía",
    ]
