"""Fixtures that all operators must survive: nulls, empty and long texts, ties,
repeated rows, clashing column names."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use inside.
    T.StructField("row", T.StringType()), T.StructField("h", T.StringType()), T.StructField("size", T.StringType()),
    T.StructField("kept", T.StringType()), T.StructField("m", T.StringType()), T.StructField("source_size", T.StringType()),
])


def doc(i, text, lang="en", source="s0"):
    return (i, text, lang, source, None if text is None else len(text), "r", "h", "z", "k", "m", "q")


def hard_documents() -> list[tuple]:
    rng = random.Random(5)
    words = ["alpha", "béta", "gamma", "δelta", "x", "word,", "end."]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    rows = [doc(i, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", "s2", None])) for i, t in enumerate(prose)]
    rows += [doc(100, None), doc(101, ""), doc(102, " \t\n"), doc(103, None, None, None), doc(None, "alpha beta gamma"), doc(None, None)]
    rows += [doc(200 + i, prose[0].replace(" ", "\n" * (1 + i % 2)) + " " * (i % 3)) for i in range(30)]  # one large group
    rows += [doc(300, prose[1]), doc(300, prose[1]), doc(300, prose[1]), doc(301, "  " + prose[1])]  # repeated rows, ties
    rows += [doc(400, " ".join(rng.choice(words) + str(rng.randint(0, 9999)) for _ in range(30_000)))]  # very long
    rows += [doc(401, "z" * 50_000)]
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(hard_documents() if rows is None else rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
