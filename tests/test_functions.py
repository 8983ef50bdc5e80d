import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import calendar, labels, numeric, text


def apply(spark, values, kind, expr):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[1] for r in df.select("i", expr(F.col("x"))).orderBy("i").collect()]


def test_strip_and_title_examples(spark):
    cases = {
        "o'brien  ": "O'Brien", "mary-jane": "Mary-Jane", "3rd ave": "3Rd Ave", "\tMcDONALD": "Mcdonald",
        "élan vital": "Élan Vital", "": "", None: None, " x \n": "X", "\x1cy\x1f": "Y", " ": "",
    }
    got = apply(spark, list(cases), "string", lambda c: text.title(text.strip(c)))
    assert got == list(cases.values())


def test_title_agrees_with_str_title_on_random_text(spark):
    rng = random.Random(7)  # without sigma, whose final form looks beyond the run of letters
    letters = "aZéÉßǆИиİıŉﬁªⅷⓐ日ع0_-' .́ "
    words = ["".join(rng.choices(letters, k=rng.randint(0, 9))) for _ in range(800)]
    assert apply(spark, words, "string", text.title) == [w.title() for w in words]
    assert apply(spark, words, "string", text.strip) == [w.strip() for w in words]


def test_email_domain_and_segment(spark):
    cases = {
        " A@GMAIL.com ": ("gmail.com", "Personal"), "u@corp.com": ("corp.com", "Corporate"),
        "noat": (None, "Other"), "x@": ("", "Unknown"), "a@b@c": ("b", "Other"), None: (None, "Other"),
    }
    domains = apply(spark, list(cases), "string", lambda c: text.email_domain(F.lower(text.strip(c))))
    segments = apply(spark, domains, "string", text.customer_segment)
    assert list(zip(domains, segments)) == list(cases.values())


def test_round_cents(spark):
    cases = {2.675: 2.68, 0.285: 0.28, 1.005: 1.0, 0.145: 0.14, 1.115: 1.12, 0.575: 0.57, 0.125: 0.12,
             0.375: 0.38, 2.5: 2.5, -0.125: -0.12}
    assert apply(spark, list(cases), "double", numeric.round_cents) == list(cases.values())


@pytest.mark.parametrize("edges, names, cases", [
    (labels.PRICE_TIER_EDGES, labels.PRICE_TIERS,
     {-1.0: None, 0.0: None, None: None, 0.01: "Budget", 50.0: "Budget", 50.01: "Standard", 200.0: "Standard",
      500.0: "Premium", 500.01: "Luxury", float("inf"): "Luxury", float("nan"): None}),
    (labels.REVENUE_EDGES, labels.REVENUE_CATEGORIES,
     {0.0: None, 100.0: "Small", 500.0: "Medium", 1000.0: "Large", 1000.01: "Enterprise"}),
])
def test_bands(spark, edges, names, cases):
    assert apply(spark, list(cases), "double", lambda c: numeric.band(c, edges, names)) == list(cases.values())


def test_calendar(spark):
    dates = ["2024-01-01", "2024-01-06", "2024-01-07", None]
    day = lambda c: F.to_date(c)
    assert apply(spark, dates, "string", lambda c: calendar.is_weekend(day(c))) == [False, True, True, False]
    assert apply(spark, dates, "string", lambda c: F.weekday(day(c))) == [0, 5, 6, None]
    assert apply(spark, dates, "string", lambda c: calendar.date_key(day(c))) == [20240101, 20240106, 20240107, None]
    assert apply(spark, dates, "string", lambda c: calendar.month_label(calendar.month_start(day(c))))[0] == "2024-01"


def test_percent_of_zero_is_null(spark):
    assert apply(spark, [0.0, 4.0], "double", lambda c: numeric.percent_of(F.lit(1.0), c)) == [None, 25.0]
