import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import DOCS, ODD_TEXTS, SF, clashing, documents

from tessera.llm import queries, repeats


def covered(texts, size):
    count = Counter(t[i:i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        mask = np.zeros(len(t), bool)
        for i in range(len(t) - size + 1):
            if count[t[i:i + size]] > 1:
                mask[i:i + size] = True
        out.append(mask)
    return out


def brute_rows(ids, texts):
    raw = [(t or "").encode() for t in texts]
    rows = []
    for i, b, m in zip(ids, raw, covered(raw, 200)):
        kept = np.frombuffer(b, np.uint8)[~m].tobytes()
        rows.append((i, len(b), int(m.sum()), int(np.diff(np.r_[0, m.astype(int)]).clip(0).sum()),
                     hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, rows))


def brute_maximal(texts, least):
    """{string: occurrences} of the repeats that differ on both sides."""
    found = {}
    for size in range(least, max(map(len, texts), default=0) + 1):
        at = {}
        for n, t in enumerate(texts):
            for i in range(len(t) - size + 1):
                at.setdefault(t[i:i + size], []).append((n, i))
        for s, places in at.items():
            left = {texts[n][i - 1] if i else (n, i) for n, i in places}
            right = {texts[n][i + size] if i + size < len(texts[n]) else (n, i) for n, i in places}
            if len(places) > 1 and len(left) > 1 and len(right) > 1:
                found[s] = sorted(places)
    return found


def test_maximal_repeats_equal_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        texts = [bytes(rng.choice(b"ab" if rng.random() < 0.9 else b"abcd") for _ in range(rng.randint(0, 25)))
                 for _ in range(rng.randint(1, 5))]
        least = rng.randint(1, 6)
        got = repeats.maximal_repeats(texts, least)
        groups = {texts[n[0]][s[0]:s[0] + size]: sorted(zip(n.tolist(), s.tolist())) for size, n, s in got.groups()}
        assert groups == brute_maximal(texts, least)
        mask = [np.zeros(len(t), bool) for t in texts]
        for n, s, size in zip(got.text, got.start, got.longest()):
            mask[n][s:s + size] = True
        assert all((a == b).all() for a, b in zip(mask, covered(texts, least)))


def test_periodic_text_stays_linear():
    got = repeats.maximal_repeats([b"And " * 20_000])
    assert len(got.length) <= 80_000 and got.longest().max() == 79_996


def passages(seed):
    rng = random.Random(seed)
    def prose(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [prose(n) for n in (150, 199, 200, 230, 700)]
    texts = []
    for k in range(60):
        texts.append(prose(rng.randint(0, 300)) + rng.choice(shared) + prose(rng.randint(0, 300)) + rng.choice(shared))
    return texts + [texts[0], texts[0], "xy" * 400, "And so " * 100, "z" * 199, "z" * 200, shared[3] * 2, "", None]


@pytest.mark.parametrize("hot", [4096, 3])
def test_removals_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    texts = passages(hot)
    ids = [None if i == 5 else i // 2 for i in range(len(texts))]
    got = repeats.removals(clashing(documents(spark, texts, ids)))
    assert sorted(str(tuple(r)) for r in got.collect()) == brute_rows(ids, texts)


@pytest.mark.parametrize("hot", [4096, 3])
def test_groups_hold_all_occurrences_and_cover_the_spans(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    texts = passages(4)
    docs = documents(spark, texts)
    raw = {r.key: (texts[r.doc] or "").encode() for r in repeats.keyed(docs).collect()}
    assert len(raw) == len(texts)                                   # one key a row here
    groups = {}
    for r in repeats.repeat_groups(docs).collect():
        groups.setdefault((r.repeat, r.length), []).append((r.key, r.start))
    mask = {k: np.zeros(len(t), bool) for k, t in raw.items()}
    for (_, size), places in groups.items():
        (k, at), *_ = places
        string = raw[k][at: at + size]
        assert size >= 200 and sorted(places) == sorted(
            (k, i) for k, t in raw.items() for i in range(len(t) - size + 1) if t[i: i + size] == string)
        assert len(places) > 1
        for k, at in places:
            mask[k][at: at + size] = True
    for (k, t), want in zip(raw.items(), covered(list(raw.values()), 200)):
        assert (mask[k] == want).all()


def test_groups_of_rows_that_are_alike(spark):
    text = "".join(random.Random(9).choice("abcdefgh") for _ in range(250))
    docs = documents(spark, [text, text, "short"], [1, 1, 2])
    got = repeats.repeat_groups(docs).collect()
    assert {r.key for r in got} == {r.key for r in repeats.keyed(docs).collect() if r.doc == 1}
    assert set().union(*(range(r.start, r.start + r.length) for r in got)) == set(range(250))


def test_groups_of_rows_that_are_alike_with_hot_anchors(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 1)
    test_groups_of_rows_that_are_alike(spark)


@pytest.mark.parametrize("hot", [4096, 50, 1])
def test_rows_that_are_alike_equal_brute_force(spark, monkeypatch, hot):
    """One row holds a third of the table, with a null doc_id; others repeat in twos and threes."""
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "COPIES", 7)
    rng = random.Random(11)
    def prose(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = prose(260)
    rows = [(None, prose(50) + shared + prose(400))] * 60 + [(k // 2, prose(30) + shared + prose(k)) for k in range(60)]
    rows += [(7, None), (7, ""), (7, "short"), (7, "short"), (7, prose(199))] + [rows[70]] * 2 + [rows[80], (None, rows[0][1] + "!")]
    ids, texts = [list(c) for c in zip(*rows)]
    docs = clashing(documents(spark, texts, ids)).repartition(5)
    got = repeats.removals(docs)
    assert sorted(str(tuple(r)) for r in got.collect()) == brute_rows(ids, texts)
    cut = repeats.cleaned(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert cut.where("length(text) > 0 and doc_id is null").count() == 1        # what follows the copies' text


def test_each_copy_of_a_row_costs_no_more_than_a_number(spark):
    """The anchors of 20,000 equal rows are sent once."""
    text = "".join(random.Random(3).choice("abcdefgh ") for _ in range(2_889))
    docs = spark.range(20_000).selectExpr("cast(null as long) doc_id", f"'{text}' text")
    rows, alike = repeats._distinct(docs)
    assert alike and [(r.doc, r.copies) for r in rows.select("doc", "copies").collect()] == [(None, 20_000)]
    got = repeats.removals(docs).groupBy("n_bytes", "n_removed", "n_spans").count().collect()
    assert [tuple(r) for r in got] == [(2_889, 2_889, 1, 20_000)]


def test_cleaned_keeps_rows_columns_and_characters(spark):
    shared = "é" * 150 + "passage " * 20
    texts = ["ab" + shared + "ü", "ac" + shared + "ä", None, "", "short"]
    docs = clashing(documents(spark, texts))
    got = repeats.cleaned(docs)
    assert got.columns == docs.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert [rows[i].text for i in range(5)] == ["abü", "acä", None, "", "short"]
    assert [rows[i].n_chars for i in range(5)] == [3, 3, None, 0, 5]


def test_odd_and_empty_tables(spark):
    got = repeats.removals(documents(spark, ODD_TEXTS)).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_rows(range(len(ODD_TEXTS)), ODD_TEXTS)
    none = spark.createDataFrame([], DOCS)
    assert repeats.removals(none).collect() == [] and repeats.cleaned(none).collect() == []


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op10_suffix_array"](spark, SF).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_rows([r.doc_id for r in rows], [r.text for r in rows])
