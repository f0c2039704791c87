"""Small documents that hold the odd cases: nulls, empty and long texts, copies, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use within.
        *(T.StructField(c, T.StringType()) for c in ("row", "key", "node", "size", "kept", "n_words", "score", "url")),
    ]
)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8)))
        out.append(word + rng.choice(["", "", "", "", ".", ","]) + (rng.choice(["\n", " "]) if i % 23 == 22 else " "))
    return "".join(out)


def odd_texts() -> list[str | None]:
    base, other, passage = prose(1, 300), prose(2, 200), prose(3, 70).replace("\n", " ")
    words = base.split(" ")
    near = " ".join([*words[:150], "changed", *words[151:]])
    return [
        base,
        base,
        near,
        other,
        prose(4, 60) + passage + prose(5, 60),
        prose(6, 80) + passage + prose(7, 40),
        None,
        "",
        " \n\t ",
        "one",
        "one two three four five",
        "One TWO three four five",
        "Nicht " * 400,
        "x" * 700,
        prose(8, 30_000),
        "Ünïcödé 日本語のテキスト ԱԲԳ   <|endoftext|> tail\x00nul 🙂🙂",
        prose(9, 100) + "\nReleased under the MIT License.\n" + prose(10, 100),
    ]


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents from (doc_id, text, source)."""
    clash = ["c"] * (len(DOCUMENTS) - 5)
    data = [(i, t, "en", s, None if t is None else len(t), *clash) for i, t, s in rows]
    return spark.createDataFrame(data, DOCUMENTS)


def odd_documents(spark: SparkSession) -> DataFrame:
    texts = odd_texts()
    rows = [(i, t, None if i % 7 == 3 else f"s{i % 4}") for i, t in enumerate(texts)]
    return frame(spark, rows).repartition(3, "doc_id")


def no_documents(spark: SparkSession) -> DataFrame:
    return frame(spark, [])
