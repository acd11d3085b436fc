"""Odd tables that every operator has to take, and helpers."""

from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables here")

A = "The quick brown fox jumps over the lazy dog near the old river bank today. It then sleeps all day long under a big tree."
B = "A quite different text about the weather in spring and the many birds that come back from the south each year."
LONG = " ".join(f"word{i} und so{i % 97}" for i in range(30_000))
#: doc_id, text, lang, source, n_chars and three columns whose names operators use themselves.
ODD = [
    (1, A, "en", "s1"),
    (2, A, "en", "s1"),
    (3, A.replace("lazy", "lacy"), "en", "s2"),
    (4, B, "en", None),
    (5, "", "en", "s1"),
    (6, None, "de", "s1"),
    (7, None, None, None),
    (8, " \t\n\n ", "fr", ""),
    (9, LONG, "en", "s1"),
    (10, "x", "en", "s3"),
    (11, f"{A}\n{B}\n{A}", "en", "s1"),
    (12, "Ünïcödé ☃ 😀 text with odd\x00 blanks\r\nand \x1c controls " * 3, "es", "s2"),
    (13, "one two three four five six seven " * 20, "en", "s2"),
    (13, "one two three four five six seven " * 20, "en", "s2"),
    (None, B, "en", "s1"),
    (None, None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size int, `key` string"


def documents(spark, rows=ODD):
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "r", 5, "k") for r in rows], SCHEMA)


def stored(spark, tmp_path, **tables):
    """Tables in a folder, as the queries read them."""
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
