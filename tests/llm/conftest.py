import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("name", T.StringType())])
LONG = " ".join(f"word{i % 977} tail{i % 13}" for i in range(6000))
PASSAGE = " ".join(f"p{i}" for i in range(60))

#: Nulls, empty and long texts, ties, repeated rows, odd characters.
ROWS = [
    (1, "The cat sat on the mat and looked at the dog for a while.", "en", "a"),
    (2, "the cat sat on the mat and looked at the dog for a while.", "en", "b"),
    (3, None, "en", None),
    (4, "", None, "d"),
    (None, "no id here, but words enough for a shingle", "en", "e"),
    (5, LONG, "en", "f"),
    (6, f"Ein Anfang. {PASSAGE} Und ein Ende mit Äpfeln.", "de", "g"),
    (7, f"{PASSAGE} don't  stop\n\n now", "en", "h"),
    (7, f"{PASSAGE} don't  stop\n\n now", "en", "h"),
    (8, "12 34 -- !!", None, "i"),
    (9, "été ÉTÉ   x² <|endoftext|> 🙂", "fr", "j"),
    (10, LONG.replace("word5 ", "changed "), "en", "k"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)
