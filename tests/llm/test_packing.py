import random
from collections import defaultdict

import pytest
from helpers import DOCS, ODD_TEXTS, SF, clashing, documents
from tokenizers import Tokenizer

from tessera.llm import packing, queries
from tessera.llm.words import vocabulary


def check(rows, sizes, capacities):
    """Every token of every document once, gapless bins within their least capacity."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        if r.n_tokens:
            by_seq[r.seq_id].append(r)
        else:
            assert (r.seq_id, r.capacity, r.offset) == (None, None, None)
    assert sorted((d, sum(r.n_tokens for r in rs)) for d, rs in by_doc.items()) == sorted(sizes.items())
    for rs in by_doc.values():
        rs = sorted(rs, key=lambda r: r.piece)
        assert [r.token_start for r in rs] == [sum(q.n_tokens for q in rs[:k]) for k in range(len(rs))]
        assert all(r.n_tokens == max(capacities) for r in rs[:-1])
    for rs in by_seq.values():
        rs = sorted(rs, key=lambda r: r.offset)
        assert [r.offset for r in rs] == [sum(q.n_tokens for q in rs[:k]) for k in range(len(rs))]
        used = sum(r.n_tokens for r in rs)
        assert {r.capacity for r in rs} == {min(c for c in capacities if c >= used)}
    return by_seq


def test_query(spark):
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    sizes = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) + 1
             for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    seqs = check(queries.QUERIES["op5_best_fit"](spark, SF).collect(), sizes, packing.CAPACITIES)
    used = sum(sizes.values())
    assert used / sum(rs[0].capacity for rs in seqs.values()) > 0.95


@pytest.mark.parametrize("group_tokens", [200, 10_000])
def test_pieces_and_groups(spark, group_tokens):
    rng = random.Random(3)
    sizes = {i: rng.choice([0, 1, 5, 64, 65, 200, 1000]) for i in range(300)}
    df = spark.createDataFrame(list(sizes.items()), "doc_id long, n_tokens long")
    check(packing.packed(df, (16, 64), group_tokens).collect(), sizes, (16, 64))


def test_pack_beats_a_single_capacity():
    rng = random.Random(1)
    lengths = sorted((rng.randint(1, 900) for _ in range(400)), reverse=True)
    _, _, opened = packing.pack(lengths, (256, 512, 1024))
    _, _, single = packing.pack(lengths, (1024,))
    assert sum(map(packing.cost, opened)) <= sum(map(packing.cost, single))
    assert packing.pack([]) == ([], [], [])


def test_best_fit_takes_the_fullest_bin():
    where, offset, capacity = packing.best_fit([6, 5, 4, 3, 1], lambda n, rest: 10)
    assert (where, offset, capacity) == ([0, 1, 0, 1, 1], [0, 0, 6, 5, 8], [10, 10])


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, 3), (1, None), (1, -5), (2, 7), (2, 7)], "doc_id long, n_tokens long")
    got = packing.packed(df).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.seq_id is None) for r in got) == [
        (0, 3, False), (1, 0, True), (1, 0, True), (2, 7, False), (2, 7, False)]
    assert len(packing.documents(clashing(documents(spark, ODD_TEXTS))).collect()) >= len(ODD_TEXTS)


def test_empty_table(spark):
    assert packing.documents(spark.createDataFrame([], DOCS)).collect() == []
