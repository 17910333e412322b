import numpy as np
import pytest
from helpers import DOCS, ODD_TEXTS, SF, clashing, documents
from test_packing import check
from test_repeats import covered
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import packing, quality, queries
from tessera.llm.words import vocabulary


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def test_run_equals_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    weights = quality.fit(docs, labels)
    rows = []
    for r in sorted(docs.select("doc_id", "text").collect()):
        ids, values = quality.features(r.text)
        if quality.sigmoid(float(weights[ids] @ values)) >= 0.3:
            rows.append((r.doc_id, r.text or ""))
    label = brute_components([brute_fingerprint(t) for _, t in rows])
    rows = [r for i, r in enumerate(rows) if label[i] == i]
    raw = [t.encode() for _, t in rows]
    kept = [np.frombuffer(b, np.uint8)[~m].tobytes().decode(errors="ignore") for b, m in zip(raw, covered(raw, 200))]
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    sizes = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for (i, _), t in zip(rows, kept)}
    check(corpus_pipeline.run(spark, SF).collect(), sizes, packing.CAPACITIES)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows_and_empty_tables(spark, name, stage):
    docs = clashing(documents(spark, ODD_TEXTS, [1, 2, None, 4, 5, 5, 7, 8, 9]))
    got = stage(spark, docs, SF)
    assert name == "best_fit_packing" or got.columns == docs.columns
    assert 0 < got.count() <= len(ODD_TEXTS) + 1
    assert stage(spark, spark.createDataFrame([], DOCS), SF).collect() == []
