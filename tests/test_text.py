"""Label cleaners: truth tables on literal frames."""

import pytest
from pyspark.sql import functions as F

from stratalake.functions import clean_code, clean_label, empty_as, null_default, strip_special

LABELS = [
    ("new york", "NewYork", "newyork"),
    ("NEW  YORK", "NewYork", "NEWYORK"),
    ("  São paulo ", "SoPaulo", "Sãopaulo"),
    ("a-b c", "AbC", "a-bc"),
    ("d'or val", "DorVal", "d'orval"),
    ("ähm", "Hm", "ähm"),
    ("x\ty z", "X\tyZ", "x\tyz"),
    ("tab\t", "Tab\t", "tab\t"),
    ("007", "007", "007"),
    ("###", "", "###"),
    ("", "", ""),
    (None, "unknown", "unknown"),
]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(i, s) for i, (s, _, _) in enumerate(LABELS)], "i int, s string"
    )


def test_clean_label_truth_table(labels):
    got = dict(labels.select("i", clean_label("s").alias("c")).collect())
    assert [got[i] for i in range(len(LABELS))] == [e for _, e, _ in LABELS]


def test_clean_code_truth_table(labels):
    got = dict(labels.select("i", clean_code("s").alias("c")).collect())
    assert [got[i] for i in range(len(LABELS))] == [e for _, _, e in LABELS]


def test_clean_code_keeps_case_and_accents(spark):
    df = spark.createDataFrame([("  São paulo ",), ("NEW  YORK",)], "s string")
    assert [r[0] for r in df.select(clean_code("s")).collect()] == ["Sãopaulo", "NEWYORK"]


def test_strip_special_is_ascii_only(spark):
    df = spark.createDataFrame([("São-Paulo!",)], "s string")
    assert df.select(strip_special("s")).first()[0] == "SoPaulo"


def test_null_default_keeps_empty_string(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "s string")
    assert [r[0] for r in df.select(null_default("s")).collect()] == ["unknown", "", "x"]


def test_empty_as(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "s string")
    assert [r[0] for r in df.select(empty_as("s", "unknown")).collect()] == [None, "unknown", "x"]
    assert [r[0] for r in df.select(empty_as("s", None)).collect()] == [None, "", "x"]


def test_cleaners_are_jvm_expressions(labels):
    plan = labels.select(clean_label("s"), clean_code("s"))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEval" not in plan
    assert F  # keep import


def test_special_chars_class_equals_ascii_ranges(spark):
    """SPECIAL_CHARS (POSIX \\p{Alnum} form) removes exactly [^a-zA-Z0-9\\s] on every BMP code point."""
    chars = [chr(cp) for cp in range(0x10000) if not 0xD800 <= cp <= 0xDFFF]
    chars += [chr(cp) for cp in (0x10000, 0x1D400, 0x1F600, 0x10FFFF)]
    chunks = ["".join(chars[i : i + 2048]) for i in range(0, len(chars), 2048)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(chunks)], "i int, s string")
    bad = df.where(
        strip_special("s") != F.regexp_replace("s", r"[^a-zA-Z0-9\s]", "")
    ).count()
    assert bad == 0
    kept = "".join(r.k for r in df.orderBy("i").select(strip_special("s").alias("k")).collect())
    assert kept == "\t\n\x0b\x0c\r " + "0123456789" + "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "abcdefghijklmnopqrstuvwxyz"


def test_clean_label_same_with_and_without_icu_case_mapping(spark):
    """bench.py turns ICU case mapping off; the cleaned labels must not change."""
    from .conftest import SF_SMALL

    sample = ["İstanbul ıi", "straße ǅemal ǈ", "ΣΊΣΥΦΟΣ ς", "ﬁne ﬂow", "ǰ ŉ ẞ", "ABC def\tGHI"]
    lit = spark.createDataFrame([(i, s) for i, s in enumerate(sample + [s for s, _, _ in LABELS])],
                                "i int, s string")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id").alias("i"),
                                                                      F.col("text").alias("s"))
    key = "spark.sql.icu.caseMappings.enabled"
    before = spark.conf.get(key, None)
    got = {}
    try:
        for flag in ("true", "false"):
            spark.conf.set(key, flag)
            got[flag] = [sorted(df.select("i", clean_label("s").alias("c")).collect()) for df in (lit, docs)]
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    assert got["true"] == got["false"]
