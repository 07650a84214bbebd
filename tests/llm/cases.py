"""Rows that every training-data operator must take: nulls, empty and long
texts, repeated rows, and extra columns whose names clash with inner ones."""
import re

from pyspark.sql.types import LongType, StringType, StructField, StructType

CLASH = ["key", "node", "n", "_key", "_doc", "_pos", "d", "t", "at", "host", "salt", "range", "sig", "x", "slot", "shard", "__lost", "_id", "_row", "_bucket"]
WORDS = "the river stone of light and winter road in old garden keeps quiet house near green water over small hills".split()


def prose(seed: int, n: int) -> str:
    return " ".join(f"{WORDS[(seed * 7 + i * i * 3 + i) % len(WORDS)]}{(seed * 31 + i * 17) % 97}" for i in range(n))


def edge_rows():
    long_line = prose(3, 9000)
    base = prose(1, 120)
    return [(1, base), (2, None), (3, ""), (4, " \n\t "), (None, prose(9, 40)), (5, base), (5, base), (6, long_line), (7, "one"), (8, base + " tail"),
            (9, "x"), (10, long_line), (11, "Zeile eins.\nÜber früh – “so”.\nZeile eins."), (12, "a\x00b \x0bc")]


def edge_docs(spark):
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), *[StructField(c, StringType()) for c in CLASH], StructField("n_chars", LongType())])
    return spark.createDataFrame([(i, x, *["z"] * len(CLASH), None if x is None else len(x)) for i, x in edge_rows()], schema).repartition(3)


def no_docs(spark):
    return edge_docs(spark).where("false")


def lower_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingles(text, k=5):
    w = lower_words(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


class Groups:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
