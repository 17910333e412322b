import random

import numpy as np
import pytest
from helpers import DOCS, ODD_TEXTS, SF, clashing, documents
from xxhash import xxh64_intdigest

from tessera.llm import queries, simhash


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=2):
    """Least index reachable over fingerprints within the radius."""
    label = list(range(len(fps)))
    for _ in fps:
        new = [min(label[j] for j in range(len(fps)) if (fps[i] ^ fps[j]).bit_count() <= radius) for i in range(len(fps))]
        if new == label:
            break
        label = new
    return label


def near_prints(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        fp = rng.getrandbits(64) if not out or rng.random() < 0.4 else rng.choice(out)
        for _ in range(rng.randint(0, 3)):
            fp ^= 1 << rng.randrange(64)
        out.append(fp)
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_sliced_distances(radius):
    fps = np.array(near_prints(300, 7), np.uint64)
    planes = simhash.planes_of(fps)
    everyone = np.packbits(np.r_[np.ones(len(fps), np.uint8), np.zeros(planes.shape[1] * 64 - len(fps), np.uint8)],
                           bitorder="little").view("<u8")
    for shift in (1, 2, 63, 64, 65, 130):
        near = np.unpackbits(simhash.near_lanes(planes, everyone, shift, radius).view(np.uint8), bitorder="little")
        want = [(int(a) ^ int(b)).bit_count() <= radius for a, b in zip(fps, fps[shift:])]
        assert near[: len(want)].astype(bool).tolist() == want


@pytest.mark.parametrize("rows, chunk", [(4096, 1 << 18), (7, 40)])
def test_components_equal_brute_force(spark, monkeypatch, rows, chunk):
    monkeypatch.setattr(simhash, "GROUP_ROWS", rows)
    monkeypatch.setattr(simhash, "CHUNK_ROWS", chunk)
    fps = sorted(np.array(near_prints(250, 11), np.uint64).view(np.int64).tolist())
    got = {r.fp: r.root for r in simhash.classes(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()}
    label = brute_components([f & (1 << 64) - 1 for f in fps])
    assert [got.get(f, f) for f in fps] == [fps[i] for i in label]


def test_too_wide_a_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_odd_rows(spark):
    ids = [8, 7, 6, None, 4, 3, 2, 2, 0]
    docs = clashing(documents(spark, ODD_TEXTS, ids))
    got = simhash.linked(docs).collect()
    fps = [brute_fingerprint(t) for t in ODD_TEXTS]
    label = brute_components(fps)
    least = {c: min((i for i, b in zip(ids, label) if b == c and i is not None), default=None) for c in label}
    assert sorted(map(str, [(r.doc_id, r.fingerprint, r.component_id) for r in got])) == sorted(
        map(str, [(i, f"{f:016x}", least[c]) for i, f, c in zip(ids, fps, label)]))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == sorted(
        (i is None, i) for i in (least[c] for c in set(label)))


def test_identical_rows_leave_one(spark):
    docs = documents(spark, ["a b c d"] * 40 + ["x y z"], [3] * 40 + [9])
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [3, 9]


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert simhash.linked(none).collect() == [] and simhash.keep_one(none).collect() == []


def test_query_against_brute_force(spark):
    rows = sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    fps = [brute_fingerprint(r.text) for r in rows]
    want = [(r.doc_id, f"{f:016x}", rows[c].doc_id) for r, f, c in zip(rows, fps, brute_components(fps))]
    assert sorted(map(tuple, queries.QUERIES["op7_simhash"](spark, SF).collect())) == want
