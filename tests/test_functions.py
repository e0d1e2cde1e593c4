import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from ratebook.functions import keys, parsing, status, text
from ratebook.plans import extraction


def _column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_iso_date(spark):
    cases = {
        "1/2/2024": "2024-01-02",
        "12-31-1999": "1999-12-31",
        "2024/1/2": "2024-01-02",
        "2024-10-02": "2024-10-02",
        "1/2/68": "2068-01-02",
        "1/2/69": "1969-01-02",
        "1-2-00": "2000-01-02",
        "1/2-2024": None,
        "1/2/204": None,
        "13/1/2024": None,
        "2/30/2024": None,
        "2/29/2023": None,
        "2/29/2024": "2024-02-29",
        "": None,
        "soon": None,
    }
    assert _column(spark, list(cases), parsing.iso_date) == list(cases.values())


def test_is_iso_date(spark):
    values = ["2024-01-02", "2024-1-2", "2024-02-30", "01/02/2024", "", None]
    got = _column(spark, values, parsing.is_iso_date)
    assert got == [True, True, False, False, False, None]


def test_amounts(spark):
    cases = {
        "$1,250.00": 1250.0,
        " 85 ": 85.0,
        "1e3": 1000.0,
        ".5": 0.5,
        "5.": 5.0,
        "1_000": 1000.0,
        "-3": -3.0,
        "12d": None,
        "N/A": None,
        "": None,
        "$": None,
        "1__0": None,
        "inf": float("inf"),
    }
    got = _column(spark, list(cases), lambda v: parsing.number(parsing.bare_number(v)))
    assert got == list(cases.values())


def test_strip_equals_python(spark):
    values = ["\t a b \n", " x　", "\x1cy\x1f", "", "   ", "z"]
    assert _column(spark, values, text.strip) == [v.strip() for v in values]


def test_initials_and_names(spark):
    assert _column(spark, ["Blue  Cross Shield", "aetna", None], text.initials) == ["BC", "A", None]
    assert _column(spark, ["in/a b.pdf", "x.PDF", "d/e.txt"], text.file_stem) == ["a b", "x", "e.txt"]
    assert _column(spark, ["a%2Fb+c.pdf", "100%"], text.url_decode) == ["a/b c.pdf", "100%"]
    assert _column(spark, ["Metro\tGeneral "], text.tabs_to_spaces) == ["Metro General"]
    assert _column(spark, ["abcdef"], lambda v: text.varchar(v, 3)) == ["abc"]


def test_text_date(spark):
    day = datetime.date(2024, 1, 2)
    assert _column(spark, ["2024-01-02", "", "null", None], text.text_date) == [day, None, None, None]
    assert _column(spark, ["nope"], lambda v: text.text_date(v, strict=False)) == [None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        _column(spark, ["nope"], text.text_date)


def test_keys(spark):
    import hashlib

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert _column(spark, ["a", None], keys.md5_key) == [md5("a"), None]
    assert _column(spark, ["a", None], keys.surrogate_key) == [
        md5("a"),
        md5("_dbt_utils_surrogate_key_null_"),
    ]
    two = _column(spark, ["a"], lambda v: keys.surrogate_key(v, F.lit(None).cast("int")))
    assert two == [md5("a-_dbt_utils_surrogate_key_null_")]


def test_status(spark):
    d = datetime.date
    today = d(2024, 6, 1)
    rows = [
        (d(2023, 1, 1), d(2023, 12, 31)),
        (d(2025, 1, 1), None),
        (None, None),
        (None, d(2020, 1, 1)),
        (d(2023, 1, 1), None),
        (d(2024, 6, 1), d(2024, 6, 1)),
    ]
    df = spark.createDataFrame(rows, "s date, e date")
    s, e, now = F.col("s"), F.col("e"), F.lit(today)
    got = df.select(
        status.contract_status(s, e, now),
        status.rate_status(s, e, now),
        status.open_ended_status(e, now),
        status.dated_status(e, now),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("EXPIRED", "EXPIRED", "INACTIVE", "INACTIVE"),
        ("FUTURE", "FUTURE", "ACTIVE", "INACTIVE"),
        ("UNKNOWN", "ACTIVE", "ACTIVE", "INACTIVE"),
        ("EXPIRED", "EXPIRED", "INACTIVE", "INACTIVE"),
        ("ACTIVE", "ACTIVE", "ACTIVE", "INACTIVE"),
        ("ACTIVE", "ACTIVE", "ACTIVE", "ACTIVE"),
    ]


def test_normalized_rate(spark):
    rows = [("Percentage", "85.00"), ("PERCENTAGE", "0.85"), ("PER_DIEM", "450.00")]
    df = spark.createDataFrame(rows, "t string, a string")
    got = df.select(status.normalized_rate(F.col("t"), F.col("a").cast("decimal(12,2)"))).collect()
    assert [str(r[0]) for r in got] == ["0.850000", "0.850000", "450.000000"]


PIECES = [
    "Contract Number", "contract no", "CONTRACT ID:", "Agreement #", "CTR-", "ctr", "NPI:", "npi #",
    "Provider:", "Facility ", "Health Center", "clinic", "St. Mary, Medical", "Payer:", "Plan",
    "inſurance: ", "Blue Croſs", "Blue Cross Blue Shield", "cigna", "Kaiser", "UnitedHealthcare",
    "Effective Date:", "effective", "begins", "commencing:", "Termination Date", "End Date", "expires",
    "Amendment", "AMENDMENT No. ", "Amendment # 3:", "1/2/2024", "3-4-69", "2024-05-06", "13/13/13",
    "1234567890", "12345678901", "A-12", "7", ":", "\n", " ", "\t", " ", "x", "été", "İD 9",
]


def test_patterns_equal_python(spark):
    """Whole random texts against Python's own regular expressions."""
    rng = random.Random(7)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(1, 40))) for _ in range(1500)]
    names = ("CONTRACT_ID", "NPI", "PROVIDER", "PAYER", "EFFECTIVE_DATE", "TERMINATION_DATE")

    def first(patterns, value):
        for pattern, _ in patterns:
            found = re.search(pattern, value, re.IGNORECASE)
            if found:
                return found.group(1)
        return None

    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    df = df.withColumn("low", extraction.folded(F.col("text")))
    got = (
        df.orderBy("i")
        .select(
            *[
                extraction.first_match(F.col("text"), F.col("low"), getattr(extraction, n)).alias(n)
                for n in names
            ],
            extraction.amendments(F.col("text"), F.col("low")).alias("amendments"),
        )
        .collect()
    )
    blocks = re.compile(extraction.AMENDMENT, re.IGNORECASE | re.DOTALL)
    hits = 0
    for value, row in zip(texts, got):
        for name in names:
            assert row[name] == first(getattr(extraction, name), value), (name, value)
            hits += row[name] is not None
        expected = [
            (f"AMD-{m.group(1)}", m.group(2)[:500].strip()) for m in blocks.finditer(value)
        ]
        found = [(a.amendment_id, a.description) for a in row.amendments or []]
        assert found == expected, value
    assert hits > 1000


def test_url_decode_of_stray_percent_signs(spark):
    rows = [("100%+a.pdf",), ("in%2Fx+50%.pdf",), ("a%2",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(text.url_decode(df["s"])).collect()]
    assert got == ["100% a.pdf", "in/x 50%.pdf", "a%2", None]
