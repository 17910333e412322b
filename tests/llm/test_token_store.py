import random
import zlib
from array import array

import pytest
from helpers import DOCS, ODD_TEXTS, SF, clashing, documents
from tokenizers import Tokenizer

from tessera.llm import queries, token_store, words


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(words.vocabulary("word_bpe_49k.json"))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def test_memo_gives_the_librarys_ids(library):
    enc = words.WordEncoder(words.vocabulary("word_bpe_49k.json"))
    marks = ["a", "B", "É", "é", " ", "\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "'s", "'LL", "!", "1", "²", "½",
             "İ", "Σ", "中", "😀", "<|endoftext|>", "<|", "\x00", "‍", "ﬁ", "ß", "_", "é"]
    rng = random.Random(5)
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    for text, got in zip(texts, enc.encode(texts)):
        assert array(enc.code, got).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(words, "MEMO_WORDS", 50)
    enc = words.WordEncoder(words.vocabulary("word_bpe_49k.json"))
    for lo in range(0, 400, 40):
        enc.encode([" ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(lo, lo + 40))])
        assert len(enc.memo) <= 50


def test_round_trip_of_odd_rows(spark, library, tmp_path):
    ids = [7, 3, None, 5, 5, 9, -2, 11, 12]
    path = str(tmp_path / "store")
    token_store.write(clashing(documents(spark, ODD_TEXTS, ids)), path)
    rows = sorted(token_store.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(ids, key=lambda i: (i is not None, i or 0))
    want = sorted((i is not None, i or 0, ids_of(library, t)) for i, t in zip(ids, ODD_TEXTS))
    assert sorted((r.doc_id is not None, r.doc_id or 0, array("I", bytes(r.ids)).tolist()) for r in rows) == want
    assert [r.start for r in rows] == [sum(q.n_tokens for q in rows[:k]) for k in range(len(rows))]
    assert token_store.read_document(spark, path, 9) == [ids_of(library, "one two three")]
    assert sorted(token_store.read_document(spark, path, 5)) == sorted([ids_of(library, "a"), ids_of(library, "one two three")])
    assert token_store.read_document(spark, path, 1000) == []


def test_a_changed_dictionary_is_refused(spark, tmp_path):
    path = str(tmp_path / "store")
    token_store.write(documents(spark, ["some words here", "other words"]), path)
    spark.createDataFrame([("0" * 64, bytearray(b"x"))], "dict_hash string, dictionary binary").write.mode(
        "overwrite").parquet(path + "/dictionary")
    with pytest.raises(ValueError):
        token_store.read(spark, path)


def test_empty_table(spark):
    assert token_store.store_and_read(spark.createDataFrame([], DOCS)).collect() == []


def test_query_against_the_library(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op1_token_store"](spark, SF).collect()}
    start = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = ids_of(library, r.text)
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens) == (start, len(ids))
        assert got[r.doc_id].ids_crc32 == zlib.crc32(array("I", ids).tobytes())
        start += len(ids)


def test_the_dictionarys_sample_takes_one_text_per_id(spark, monkeypatch):
    """The sample is picked by ids alone; copies and partitions do not change it."""
    monkeypatch.setattr(token_store, "SAMPLE_DOCS", 5)
    texts = [f"text number {i} " * (i % 5 + 1) for i in range(40)]
    docs = documents(spark, texts + ["another text of the same id"] * 30, list(range(40)) + [3] * 30)
    got = [token_store._sample(d, token_store.VOCABULARY, 1) for d in (docs.repartition(3), docs.union(docs).coalesce(1))]
    assert got[0] == got[1] and len(got[0]) == 5
