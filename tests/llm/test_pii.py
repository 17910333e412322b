import hashlib
import random
import re

import pytest
from helpers import DOCS, ODD_TEXTS, SF, clashing, documents

from tessera.llm import pii, queries

FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in value.split(".")),
            "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]


def base(text):
    """The contract's base spans with Python's own patterns."""
    found = [(m.start(), n, f"{kind}:{m.start()}:{m.end()}") for n, (kind, form) in enumerate(FORMS.items())
             for m in re.finditer(form, text or "") if good(kind, m.group())]
    return [name for _, _, name in sorted(found)]


def check(got, texts):
    """``got`` rows against the texts of the same doc_id."""
    for r in got:
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in FORMS]
        every = r.spans.split(",") if r.spans else []
        assert set(want) <= set(every)
        keys = [(int(s), list(FORMS).index(k)) for k, s, _ in (x.split(":") for x in every)]
        assert keys == sorted(keys)


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op11_weak_labels"](spark, SF).collect()
    check(got, texts)
    assert len(got) == len(texts)


@pytest.mark.parametrize("seed", [1, 2])
def test_base_spans_of_random_texts(spark, seed):
    rnd = random.Random(seed)
    pieces = ["a@b", "@", ".c", "x_y", "+", "1", "23", "255.", "256.", "0.0.0.0", "4111 1111 1111 1111", "-", " ", "(", ")", "é", "😀",
              "+1 (2", "4242424242424242", "\n", "aa.bb@cc-d.ee.", "%", "007.", "12345678901", "..", "@@", "3.4", "--", "  "]
    texts = {i: "".join(rnd.choices(pieces, k=rnd.randrange(1, 30))) for i in range(400)}
    got = pii.detected(documents(spark, list(texts.values()), list(texts))).collect()
    check(got, texts)


def test_odd_rows_and_very_long_texts(spark):
    # Python's own patterns are quadratic on some of these
    long = ["1.2.3.4 and 4242424242424242, " * 3000, "9" * 9000, "a" * 9000, "a@" * 5000, "+1" * 5000, "1 " * 5000,
            "a." * 4000, "é" * 100_000 + "x@y.de"]
    texts = ODD_TEXTS + long
    ids = list(range(len(texts)))
    docs = documents(spark, texts + texts[:3] + ["x@y.de"], ids + [0, 0, 0, None]).transform(clashing)
    got = pii.detected(docs).collect()
    assert len(got) == len(texts) + 4
    check([r for r in got if r.doc_id not in (0, None)], dict(zip(ids, texts)))
    assert [(r.n_email, r.spans) for r in got if r.doc_id is None] == [(1, "email:0:6")]
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r.base_sha256, r.spans) for r in got if r.doc_id == 0] == [(empty, "")] * 4


def test_very_long_runs_are_read_once(spark):
    docs = documents(spark, ["9" * 400_000, "a" * 400_000, "a@" * 200_000, "a." * 200_000, "1." * 200_000, "1 " * 200_000])
    assert pii.spans(docs).selectExpr("sum(size(spans))").first()[0] == 200_000 // 4


def test_empty_table(spark):
    assert pii.detected(spark.createDataFrame([], DOCS)).collect() == []


CLEAN = "Nothing personal stands in this text, version 4.0 of 2024, page 12 to 17."


def planted():
    rnd = random.Random(5)
    texts, added, decoys = [], {}, []

    def card(ok):
        while True:
            digits = "4" + "".join(rnd.choices("0123456789", k=15))
            if luhn(digits) == ok:
                return digits
    for _ in range(60):
        a, b = rnd.randrange(1, 223), rnd.randrange(255)
        texts += [f"Write to ann.{a}@mail{b}.example.com today.", f"Call +1 (2{a % 90 + 10}) 555-{1000 + b} soon.",
                  f"The server {a}.{b}.7.{a} answered.", f"Card {card(True)} was used.", CLEAN]
    for k in range(12):
        decoys += [len(texts), len(texts) + 1]
        texts += [f"Order {card(False)} was sent.", f"Numbers 7{k}.999.31.2 are no address."]
        for text, value in ((f"Cards {card(True)} 77 and more", None), ("Write to bob [at] firm [dot] com please", "bob [at] firm [dot] com"),
                            (f"Call (212) 555-0{k + 100} now", None), ("Host 2001:db8:0:0:1:0:0:1 is up", "2001:db8:0:0:1:0:0:1")):
            value = value or re.search(r"4[0-9]{15}|\(212\) 555-[0-9]{4}", text).group()
            added[len(texts)] = (text.index(value), text.index(value) + len(value))
            texts.append(text)
    return texts, added, decoys


def test_additions_are_found_and_others_left_alone(spark):
    texts, added, decoys = planted()
    got = {r.doc_id: r for r in pii.detected(documents(spark, texts)).collect()}
    check(got.values(), dict(enumerate(texts)))
    for i, (start, end) in added.items():
        assert got[i].spans.split(":")[1:] == [str(start), str(end)], (texts[i], got[i].spans)
    assert [(texts[i], got[i].spans) for i in decoys if got[i].spans] == []
    assert all(got[i].spans == "" for i, t in enumerate(texts) if t == CLEAN)


def test_labelers_reliability_is_estimated(spark):
    """The checksum, which agrees with the known members, is trusted more than a constant vote."""
    texts, _, _ = planted()
    spans = pii.candidates(pii.spans(documents(spark, texts)))
    patterns = spans.groupBy("kind", "base", *pii.LABELERS, "features").count().withColumnRenamed("count", "n").cache()
    prior, yes = pii.estimated(patterns)
    assert 0.8 < prior["card"] < 1
    assert yes["card", "check", 1] > 0.95 > 0.3 > yes["card", "check", 0]
    assert abs(yes["card", "form", 1] - yes["card", "form", 0]) < 0.3


def test_no_python_on_the_executors(spark):
    plan = pii.detected(documents(spark, ["x@y.de", None]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_places_of_many_matches(spark):
    from pyspark.sql import functions as F
    text = "".join("x" * (k % 7) + "12" for k in range(2000)) + "y"
    df = spark.createDataFrame([(text,)], "t string").select(F.split("t", "[0-9]+", -1).alias("p"), F.regexp_extract_all("t", F.lit("[0-9]+"), F.lit(0)).alias("m"))
    got = df.select(pii.running_starts(F.transform(F.slice("p", 1, F.size("m")), F.length), F.transform("m", F.length))).first()[0]
    assert got == [m.start() for m in re.finditer("[0-9]+", text)]
