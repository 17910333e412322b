"""Small inputs shared by the operator tests."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None):
    """A documents table of these texts; ids default to 0, 1, ..."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)], DOCS)


def clashing(docs):
    """The same table with columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    return docs.select("*", *[F.lit(n).alias(c) for n, c in enumerate((
        "key", "fp", "score", "shard", "spans", "piece", "part", "n_tokens", "doc", "anchors", "ids", "bucket", "tie"))])


ODD_TEXTS = [None, "", " ", "a", "one two three", "one two three", "é́ ½ 中文 \x00 \x85", "word " * 3000, "<|endoftext|> x"]
