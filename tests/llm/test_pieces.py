import hashlib
import random

import numpy as np
import pytest
import sentencepiece as spm
from helpers import DOCS, ODD_TEXTS, SF, clashing, documents
from sentencepiece import sentencepiece_model_pb2 as pb

from tessera.llm import pieces, queries
from tessera.llm.words import vocabulary

MARKS = ["a", "B", " ", "  ", "ﬁ", "ｆ", "　", "é", "é", "が", "ｶﾞ", "①", "㍿", "\t", "\n", "\xa0", "½", "…", "﷽", "Å",
         "​", "�", "가", "ㄱ", pieces.BLANK, "😀", "\x00"]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(MARKS) for _ in range(rng.randint(0, 12))) for _ in range(n)]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_normaliser_equals_the_librarys(rule, squeeze):
    library = spm.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True,
                                          remove_extra_whitespaces=squeeze)
    model = pb.ModelProto()
    model.ParseFromString(library.serialized_model_proto())
    ours = pieces.Normalizer(model.normalizer_spec)
    for text in random_texts(800, 4):
        want, places = library.normalize(text, with_offsets=True)
        got, at = ours(text.encode())
        assert got.decode() == want
        firsts = np.r_[0, np.cumsum([len(c.encode()) for c in want])].astype(int)
        chars = [len(text.encode()[:b].decode()) for b in at[firsts]]
        assert chars[: len(want)] == list(places)[: len(want)]


@pytest.fixture(scope="module")
def encoder():
    return pieces.PieceEncoder(vocabulary(pieces.MODEL))


def test_spans_cover_the_text_piece_by_piece(encoder):
    for text in random_texts(500, 8) + ["plain words", "  two  blanks "]:
        raw = text.encode()
        (ids, begin, stop), = encoder.encode([text])
        assert ids == encoder.library.encode(text) + [2] and begin[-1] == stop[-1] == len(raw)
        if ids[:-1]:
            assert begin[0] == 0 and stop[-2] == len(raw) and (begin[1:] == stop[:-1]).all()
        for i, lo, hi in zip(ids[:-1], begin, stop):
            name = encoder.library.id_to_piece(i)
            if not encoder.library.is_byte(i):
                surface = raw[lo:hi].decode().replace(" ", pieces.BLANK)
                assert name == surface or lo == 0 and name == pieces.BLANK + surface


def test_arrays_and_decoding(spark, encoder):
    docs = clashing(documents(spark, ODD_TEXTS, [1, 2, None, 4, 5, 5, 7, 8, 9]))
    got = pieces.encoded(docs)
    want = [encoder.library.encode(t or "") + [2] for t in ODD_TEXTS]
    assert sorted(r.ids for r in got.collect()) == sorted(want)
    back = [r.text for r in pieces.decoded(got).collect()]
    assert sorted(back) == sorted(encoder.library.decode(i) for i in want)


def test_empty_table(spark):
    assert pieces.digests(spark.createDataFrame([], DOCS)).collect() == []


def test_query_against_the_library(spark, encoder):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = encoder.library.encode(r.text or "", add_eos=True)
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(encoder.library.decode(ids))))
    got = queries.QUERIES["op9_pieces"](spark, SF).drop("spans_crc32").collect()
    assert sorted(map(tuple, got)) == want


def _chain(key: bytes) -> bytes:
    """A compiled map of the one rule key -> "!": the children of the n-th node lie in block n + 1."""
    units, node = {0: 0x100 << 10}, 0x100
    for n, byte in enumerate(key):
        at, following = node ^ byte, 0x100 * (n + 2)
        units[at] = byte | (at ^ following) << 10 | (0x100 if n == len(key) - 1 else 0)
        node = following
    units[node] = 0x80000000  # the replacement starts at 0
    blob = b"".join(units.get(i, 0xFF).to_bytes(4, "little") for i in range(node + 1))
    return len(blob).to_bytes(4, "little") + blob + b"!\0"


@pytest.mark.parametrize("length", [3, 64, 65, 200])
def test_long_keys_of_a_character_map_are_found(length):
    key = bytes(65 + i % 26 for i in range(length))
    rules = pieces.CharacterMap(_chain(key))
    assert rules.longest(b"__" + key + b"x", 2) == (b"!", length)
    assert rules.longest(key[:-1], 0) is None and rules.longest(b"", 0) is None
