import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import DOCS, ODD_TEXTS, SF, clashing, documents

from tessera.llm import queries, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return words, [zlib.crc32(f.encode()) % 10000 for f in words + [" ".join(p) for p in zip(words, words[1:])]]


def brute(rows, target):
    """(doc_id, n_features, weight, score, rank), as the contract says it."""
    s, t = Counter(), Counter()
    for text in target:
        t.update(features(text)[1])
    for _, text in rows:
        s.update(features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in s}
    out, long_enough = [], []
    for k, (i, text) in enumerate(rows):
        words, f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None])
        if len(words) >= 20:
            long_enough.append(((-score, i is None, i or 0, len(f), weight, k), k))
    for n, (_, k) in enumerate(sorted(long_enough)[: 25 * len(long_enough) // 100]):
        out[k][4] = n + 1
    return out


def same(got, want):
    assert sorted(map(str, map(tuple, got))) == sorted(str(tuple(r)) for r in want)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    same(queries.QUERIES["op13_resample"](spark, SF).collect(), brute(rows, target))


def test_odd_and_repeated_rows(spark):
    texts = ODD_TEXTS + ["A b-C é1 " * 20, "same words in every copy " * 9] + [f"w{i} x" * 30 for i in range(40)]
    ids = [None, 1, 1, 2, None, 3, 4, 5, 6, 7, 8, *range(100, 140)]
    docs = documents(spark, texts, ids)
    docs = docs.union(docs).union(documents(spark, [texts[10]] * 60, [8] * 60)).transform(clashing)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    target = spark.createDataFrame([(1, "same words here", 5), (2, None, 5)], "item_id long, text string, node int")
    same(resample.resampled(docs, target).collect(), brute(rows, ["same words here", None]))


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], DOCS), documents(spark, ["one two", None])
    assert resample.resampled(none, some).collect() == []
    same(resample.resampled(some, none).collect(), brute([(0, "one two"), (1, None)], []))


@pytest.mark.parametrize("half", [1e-9, 1 / 2000])
@pytest.mark.parametrize("k", [0, 1, 7, 250, 999, 1000])
def test_bracket_widens_until_it_holds_the_cutoff(spark, k, half):
    rng = np.random.default_rng(k)
    data = [(int(s), i % 9 if i % 11 else None, 1, 2, i) for i, s in enumerate(rng.integers(0, 40, 1000))]
    rows = spark.createDataFrame(data, "score long, doc_id long, n_features long, weight long, node long")
    best = sorted(data, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[4]))[:k]
    got = rows.where(resample.drawn(rows, k, 1000, half)).select("node").collect()
    assert sorted(r.node for r in got) == sorted(r[4] for r in best)


def test_runs_hash_as_their_joined_words(monkeypatch):
    monkeypatch.setattr(resample, "PART", 4)
    words = [w.encode() for w in "a bb ccc dd e ff g hh i".split()]
    got = sorted(int(x) for part in resample.buckets(words, 3, 1 << 32) for x in part)
    runs = [b" ".join(words[i: i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    assert got == sorted(map(zlib.crc32, runs))
