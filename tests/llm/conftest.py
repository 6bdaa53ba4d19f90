import os
import sys

import pytest
from pyspark.sql import types as S

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = S.StructType([S.StructField("doc_id", S.LongType()), S.StructField("text", S.StringType()), S.StructField("lang", S.StringType()),
                     S.StructField("source", S.StringType()), S.StructField("n_chars", S.LongType())])
SF = "/root/testdata/sf0.001"

PROSE = ("the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak and a small grey mouse "
         "carries one seed after another into the warm nest below the roots where winter stores are kept dry and safe "
         "until the first green leaves of spring return and all the birds begin to sing again").split()


def prose(seed, n):
    """n words, other ones for every seed."""
    return " ".join(f"{PROSE[(seed * 31 + i * 7 + i * i % 11) % len(PROSE)]}{(seed * 17 + i) % 97}" for i in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty, blank, odd and long texts, ties, repeated rows, and a clashing extra column."""
    texts = {1: prose(1, 120), 2: prose(1, 120), 3: None, 4: "", 5: "   \n\t ", 6: "één naïve ünïcode\tword\r\nnext  line \x0b end", 7: prose(7, 4),
             8: "x" * 30_000, 9: " ".join(["same"] * 400), 10: prose(10, 9000), 11: "mail me: a.b@c.example, 10.1.2.3 or +1 (017) 555-7713",
             12: prose(1, 119) + " changed", 13: "line one\nline one\nline two\nline one", 14: "end <|endoftext|> mark", 15: "\x1cab\x1d cd e", 16: "A" * 200 + " " + prose(16, 60)}
    rows = [(d, t, "en", f"src{d % 3}", len(t) if t else None) for d, t in texts.items()]
    rows += [(16, texts[16], "en", "src1", 1), (17, prose(17, 80), None, None, None), (None, prose(18, 70), "en", "src2", 5)]
    return spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' as node", "1.5D as n", "doc_id as bucket").repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def sf_rows(sf_docs):
    return sorted((r.doc_id, r.text) for r in sf_docs.collect())
