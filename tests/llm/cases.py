"""Small tables with the cases every operator must stand: nulls, empty, long, repeated, clashes."""

from pyspark.sql import DataFrame, SparkSession

WORDS = "amber birch cedar delta ember fjord grove heath inlet jetty knoll ledge marsh".split()


def sentence(start: int, n: int) -> str:
    return " ".join(f"{WORDS[(start * 7 + k * (start + 3)) % 13]}{(start + k) % 5}" for k in range(n))


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """doc_id and text among columns whose names clash with those of operators."""
    wide = [(7.5, i, "else", t, 3, None, "en") for i, t in rows]
    schema = "score double, doc_id bigint, Text string, text string, part int, digest binary, lang string"
    return spark.createDataFrame(wide, schema)


EDGES = [
    (1, sentence(1, 60)),
    (1, sentence(1, 60)),
    (2, None),
    (3, ""),
    (4, " \n\t \n"),
    (None, sentence(1, 60)),
    (None, "a text without an id"),
    (None, None),
    (5, "word " * 30_000),
    (6, "x" * 20_000),
    (7, "Größe déjà 日本語 😀   end\r\n\x00"),
    (-8, sentence(2, 9)),
    (9, "one"),
    (9, sentence(4, 30)),
]
