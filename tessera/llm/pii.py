"""Personal data in whole texts: base grammars, and weakly supervised additions.

Base spans (email, ip, card, phone) come from four patterns and their checks; they always
stay.  Looser patterns propose further candidates: spelled-out addresses, colon addresses,
cards inside longer digit runs, numbers without a plus.  Those that overlap no base span
are judged.  Labelers vote yes, no or nothing on every span: two regular-expression ones
(form, check), one gazetteer (top-level domains, address ranges, issuers, country codes) and
two of context (words near by, neighbouring characters).  Expectation-maximisation over the
counts of vote patterns estimates per kind how often a labeler says yes on personal and on
other spans; base spans are known members of the first class, failed card checksums and address
ranges of the second.  Its posteriors, as weights,
train a logistic regression over span features, which decides about the candidates.

Everything is a DataFrame expression: splits at matches give their places as running sums
of lengths, in two levels so that a text with very many matches stays cheap.  The loops run
over counts of patterns, not over spans, and carry only model parameters.

Patterns use possessive repeats and look-behinds, which find the same matches as the plain
forms without their quadratic search.  Null texts count as empty.  Rows that repeat, or
share or lack a doc_id, are judged one by one.  A table without candidates has base spans
only; an empty table gives no row.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
STEPS = 6                  # of expectation-maximisation
THRESHOLD = 0.8            # of the classifier, for an addition
CHUNK = 256                # matches whose places are summed in one go
BEFORE, AFTER = 32, 16     # characters of context
YES, NO = 1, 2             # votes; 0 says nothing

#: The plain forms are in the contract of op11.  ``\\G`` is the end of the match before.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?[(\[{] ?(?i:at) ?[)\]}] ?[A-Za-z0-9-]{1,63}+"
             r"(?:(?: ?[(\[{] ?(?i:dot) ?[)\]}] ?| (?i:dot) |\.)[A-Za-z0-9-]{2,63}+)++"
             r"| (?i:at) [A-Za-z0-9-]{1,63}+(?: (?i:dot) [A-Za-z0-9-]{2,63}+)++)",
    "ip": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![0-9A-Za-z:]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z.])(?:[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}|[0-9]{14,19}+)(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:(?:00 ?|\+)[1-9][0-9]{0,2}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
}
#: A text without this cannot match.
NEEDS = {"email": r"@", "ip": r"\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

# Gazetteers and context words.
DOMAINS = ("com org net edu gov mil int info biz io dev app ai co eu de fr es it uk ie nl be at ch pt pl se no fi dk cz "
           "gr ru ua tr us ca mx br ar cl au nz jp cn in kr za").split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[0-9]|6[0245])"
COUNTRIES = r"^(?:\+|00 ?)(?:1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"
SPECIAL = r"^(?:0+|10|127|22[4-9]|2[3-5][0-9]|192\.168|169\.254|172\.(?:1[6-9]|2[0-9]|3[01]))\."
FOR = {
    "email": "mail|contact|kontakt|correo|courriel|write|schreib|escri|reply",
    "ip": r"\bip\b|host|server|client|address|adress|direcci",
    "card": "card|karte|carte|tarjeta|visa|master|amex|credit|kredit",
    "phone": r"phone|tel\b|tel[.:]|call|mobile|mobil|handy|fax|fon\b|móvil|téléphone|anruf|llam|appel",
}
AGAINST = {
    "email": "example of|format", "ip": "version|release|section|chapter|kapitel|v$",
    "card": "isbn|order|invoice|serial|sku|token|hash|rechnung|factura|facture|id[:=#]",
    "phone": "isbn|order|invoice|serial|sku|part no|version|rechnung|factura|facture",
}


def running_starts(gaps: Column, sizes: Column) -> Column:
    """Start of each match: all gaps up to it and all matches before it, in two levels of sums."""
    steps = F.zip_with(gaps, sizes, lambda g, s: g + s)
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / CHUNK).cast("int")),
                         lambda k: F.slice(steps, k * CHUNK + 1, F.lit(CHUNK)))

    def sums(values: Column, first: Column) -> Column:
        """first, first + values[0], ... : one sum before each value."""
        start = F.struct(first.cast("int").alias("at"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(values, start, lambda a, x: F.struct(
            (a["at"] + x).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")), lambda a: a["all"])

    totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x))
    before = F.flatten(F.zip_with(chunks, sums(totals, F.lit(0)), sums))
    return F.zip_with(before, gaps, lambda b, g: b + g)


def luhn(digits: Column) -> Column:
    """Whether at most 19 digits pass the Luhn check; zeros in front do not change the sum."""
    padded = F.lpad(digits, 20, "0")
    total = F.lit(0)
    for k in range(20):
        d = F.substring(padded, 20 - k, 1).try_cast("int")
        total = total + (2 * d - F.when(d > 4, 9).otherwise(0) if k % 2 else d)
    return total % 10 == 0


def card_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[ -]", "")


def passes(kind: Column, value: Column) -> Column:
    """The check of a base match of the kind of that name."""
    digits = card_digits(value)
    return (F.when(kind == "ip", value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"))
            .when(kind == "card", F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False))
            .when(kind == "phone", F.length(F.regexp_replace(value, "[^0-9]", "")).between(10, 15)).otherwise(True))


def spans(docs: DataFrame) -> DataFrame:
    """(row, doc_id, spans) of every row: base spans that pass, and all loose matches."""
    forms = [(k, True, BASE[k]) for k in KINDS] + [(k, False, LOOSE[k]) for k in KINDS]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"))
    t = F.col("t")
    none = F.array().cast("array<string>")
    df = df.select("*", *[F.when(t.rlike(NEEDS[k]) if base else t.rlike("[0-9@({\\[]| (?i:at) "),
                                 F.regexp_extract_all("t", F.lit(form), F.lit(0))).otherwise(none).alias(f"m{n}")
                          for n, (k, base, form) in enumerate(forms)])
    # one entry per form: its matches, and the pieces between them where there are any
    forms_ = F.array(*[F.struct(F.lit(KINDS.index(k)).alias("kind"), F.lit(base).alias("base"), F.col(f"m{n}").alias("m"),
                                F.when(F.size(f"m{n}") > 0, F.split("t", form, -1)).otherwise(none).alias("p"))
                       for n, (k, base, form) in enumerate(forms)])
    df = df.select("row", "doc_id", F.filter(forms_, lambda f: F.size(f["m"]) > 0).alias("forms"))
    df = df.select("row", "doc_id", F.transform("forms", lambda f: F.struct(
        f["kind"].alias("kind"), f["base"].alias("base"), f["m"].alias("m"), f["p"].alias("p"), running_starts(
            F.transform(F.slice(f["p"], 1, F.size(f["m"])), F.length), F.transform(f["m"], F.length)).alias("s"))).alias("forms"))

    def found(f: Column) -> Column:
        def one(k: Column) -> Column:
            value, start = F.get(f["m"], k), F.get(f["s"], k)
            return F.struct(f["kind"].alias("kind"), f["base"].alias("base"), start.cast("long").alias("start"),
                            (start + F.length(value)).cast("long").alias("end"), value.alias("value"),
                            F.right(F.get(f["p"], k), F.lit(BEFORE)).alias("before"),
                            F.left(F.get(f["p"], k + 1), F.lit(AFTER)).alias("after"))
        good = reduce(lambda c, k: c.when(f["kind"] == KINDS.index(k), F.lit(k)), KINDS, F)
        return F.filter(F.transform(F.sequence(F.lit(0), F.size(f["m"]) - 1), one),
                        lambda x: ~f["base"] | passes(good, x["value"]))

    return df.select("row", "doc_id", F.flatten(F.transform("forms", found)).alias("spans"))


# ------------------------------------------------------------------ labelers and features

def _by_kind(**cases: Column) -> Column:
    """The case of the span's kind."""
    return reduce(lambda c, k: c.when(F.col("kind") == KINDS.index(k), cases[k]), KINDS, F)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, YES).when(no, NO).otherwise(0)


def votes() -> dict[str, Column]:
    """The labelers; columns kind, value, before, after, checked (passes the base check)."""
    v, near = F.col("value"), F.lower(F.concat("before", F.lit(" "), "after"))
    plain, quad = v.contains("@"), v.rlike(r"^[0-9]+\.")
    digits = F.length(F.regexp_replace(v, "[^0-9]", ""))
    issuer = card_digits(v).rlike(ISSUERS)
    domain = F.lower(F.regexp_extract(v, r"([A-Za-z0-9-]+)$", 1)).isin(DOMAINS)
    form = _by_kind(
        email=_vote(v.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9][A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24}$"), plain),
        ip=_vote(~v.rlike(r"(?:^|\.)0[0-9]"), F.lit(True)),
        card=_vote(v.rlike(r"^(?:[0-9]+|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})$"), F.lit(True)),
        phone=_vote(v.rlike(r"^\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}$"), v.rlike(r"[ ().-]{4}")))
    check = _by_kind(
        email=_vote(plain & ~v.contains("..") & ~v.startswith("."), plain),
        ip=_vote(~quad | F.col("checked"), F.lit(True)), card=_vote(F.col("checked"), F.lit(True)),
        phone=_vote(digits.between(10, 13), ~digits.between(9, 15)))
    gazetteer = _by_kind(email=_vote(domain, F.lit(True)), ip=_vote(F.lit(False), v.rlike(SPECIAL)),
                         card=_vote(issuer, F.lit(True)), phone=_vote(v.rlike(COUNTRIES), v.rlike(r"^\+0")))
    words = _by_kind(**{k: _vote(near.rlike(FOR[k]) & ~near.rlike(AGAINST[k]), near.rlike(AGAINST[k])) for k in KINDS})
    alone = ~F.col("before").rlike(r"[\p{L}\p{N}_=/]$") & ~F.col("after").rlike(r"^[\p{L}\p{N}_=/@]")
    return {"form": form, "check": check, "gazetteer": gazetteer, "words": words, "borders": _vote(alone, F.lit(True))}


def features() -> dict[str, Column]:
    """What the classifier sees of a span."""
    v, near, kind = F.col("value"), F.lower(F.concat("before", F.lit(" "), "after")), F.col("kind")
    digits = F.length(F.regexp_replace(v, "[^0-9]", ""))
    checked = F.col("checked")
    out = {f"is_{k}": kind == n for n, k in enumerate(KINDS)}
    out |= {"plus": v.startswith("+"), "parentheses": v.contains("("), "sign": v.contains("@"),
            "spelled": v.rlike(r"(?i)[ (\[{]dot[ )\]}]"), "colons": v.contains(":"),
            "luhn": (kind == 2) & checked, "no_luhn": (kind == 2) & ~checked,
            "bytes": (kind == 1) & checked, "no_bytes": (kind == 1) & ~v.contains(":") & ~checked,
            "known_domain": (kind == 0) & F.lower(F.regexp_extract(v, r"([A-Za-z0-9-]+)$", 1)).isin(DOMAINS),
            "known_issuer": (kind == 2) & card_digits(v).rlike(ISSUERS), "special_range": (kind == 1) & v.rlike(SPECIAL),
            "few_digits": (kind == 3) & (digits < 10), "one_separator": ~v.rlike(r"[ .-][^ .-]+[ .-]"),
            "words_for": _by_kind(**{k: near.rlike(FOR[k]) for k in KINDS}),
            "words_against": _by_kind(**{k: near.rlike(AGAINST[k]) for k in KINDS}),
            "left_free": ~F.col("before").rlike(r"[\p{L}\p{N}_=/]$"), "right_free": ~F.col("after").rlike(r"^[\p{L}\p{N}_=/@]")}
    return out


LABELERS = ("form", "check", "gazetteer", "words", "borders")
#: How often a labeler is right before any data is seen, worth WORTH votes.
RIGHT = {"form": 0.7, "check": 0.9, "gazetteer": 0.7, "words": 0.8, "borders": 0.6}
WORTH = 10.0


def candidates(found: DataFrame) -> DataFrame:
    """Base spans, and loose matches that meet none of them, with votes and features (as bits)."""
    every = found.select("row", F.inline("spans"))
    place = Window.partitionBy("row").orderBy("start", "end", "kind", "base")
    upto = F.max(F.when(F.col("base"), F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, -1))
    # from behind: a frame that grows is one pass, one that shrinks is not
    behind = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("end"), F.desc("kind"), F.desc("base"))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(behind.rowsBetween(Window.unboundedPreceding, -1))
    free = (F.coalesce(upto, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    kind = F.get(F.array(*map(F.lit, KINDS)), F.col("kind"))
    kept = every.withColumn("free", free).where("base or free").withColumn("checked", passes(kind, F.col("value")))
    bits = reduce(lambda a, b: a + b, [F.when(c, F.lit(1 << n)).otherwise(0) for n, c in enumerate(features().values())])
    return kept.select("row", "kind", "base", "start", "end", *[c.cast("int").alias(n) for n, c in votes().items()],
                       bits.cast("long").alias("features"))


def _sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def impossible() -> Column:
    """Known not to be personal: a checksum or a range that fails leaves no card and no address."""
    return F.col("kind").isin(KINDS.index("ip"), KINDS.index("card")) & (F.col("check") == NO)


def posterior(prior: dict, yes: dict) -> Column:
    """Probability that a span is personal, by its votes; base spans are, impossible ones are not.

    The parameters are looked up in array literals, so every step runs the same compiled code."""
    logs = [math.log(prior[k] / (1 - prior[k])) for k in KINDS]
    votes_ = [x for k in KINDS for n in LABELERS for x in (
        0.0, math.log(yes[k, n, 1] / yes[k, n, 0]), math.log((1 - yes[k, n, 1]) / (1 - yes[k, n, 0])))]
    table = F.array(*map(F.lit, votes_))
    z = F.get(F.array(*map(F.lit, logs)), F.col("kind"))
    for n, name in enumerate(LABELERS):
        z = z + F.get(table, (F.col("kind") * len(LABELERS) + n) * 3 + F.col(name))
    return F.when(F.col("base"), 1.0).when(impossible(), 0.0).otherwise(_sigmoid(z))


def estimated(patterns: DataFrame, steps: int = STEPS) -> tuple[dict, dict]:
    """Share of personal spans among the candidates, and P(yes | vote, class), per kind, by EM."""
    prior = {k: 0.5 for k in KINDS}
    yes = {(k, n, c): RIGHT[n] if c else 1 - RIGHT[n] for k in KINDS for n in LABELERS for c in (0, 1)}
    for _ in range(steps):
        # one row per kind, labeler and vote
        weighed = patterns.select("kind", (~F.col("base") & ~impossible()).alias("open"), "n", posterior(prior, yes).alias("p"), F.explode(F.array(*[
            F.struct(F.lit(name).alias("labeler"), F.col(name).alias("vote")) for name in LABELERS])).alias("said"))
        got = weighed.groupBy("kind", "said.labeler", "said.vote").agg(
            F.sum(F.col("n") * F.col("p")).alias("mine"), F.sum(F.col("n") * (1 - F.col("p"))).alias("others"),
            F.sum(F.when(F.col("open"), F.col("n") * F.col("p")).otherwise(0.0)).alias("open_mine"),
            F.sum(F.when(F.col("open"), F.col("n")).otherwise(0)).alias("open")).collect()  # 4 x 5 x 3 rows at most
        rows = {(KINDS[r.kind], r.labeler, r.vote): r for r in got}
        for k in KINDS:
            whole = [rows[k, LABELERS[0], v] for v in (0, YES, NO) if (k, LABELERS[0], v) in rows]
            prior[k] = round((sum(r.open_mine for r in whole) + 2) / (sum(r.open for r in whole) + 4), 9)
            for name in LABELERS:
                for c, side in ((1, "mine"), (0, "others")):
                    said, against = (rows[k, name, v][side] if (k, name, v) in rows else 0.0 for v in (YES, NO))
                    right = RIGHT[name] if c else 1 - RIGHT[name]
                    yes[k, name, c] = round((said + WORTH * right) / (said + against + WORTH), 9)
    return prior, yes


def trained(patterns: DataFrame, prior: dict, yes: dict) -> tuple[list[float], float]:
    """Weights and intercept of the span classifier, fitted to the posteriors."""
    names = list(features())
    p = posterior(prior, yes)
    bits = [F.shiftright("features", n).bitwiseAND(F.lit(1)).cast("double").alias(x) for n, x in enumerate(names)]
    sides = patterns.select(*bits, F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("n") * p).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - p)).alias("weight")))).alias("side"))
    rows = sides.select(*names, "side.*").where("weight > 0")
    rows = VectorAssembler(inputCols=names, outputCol="x").transform(rows).select("x", "label", "weight")
    model = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", regParam=1e-4, maxIter=60,
                               standardization=False).fit(rows)
    return [float(w) for w in model.coefficients], float(model.intercept)


def chosen(spans_: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The base spans and the additions that the classifier accepts; additions do not overlap."""
    patterns = stored(spans_.groupBy("kind", "base", *LABELERS, "features").agg(F.count("*").alias("n")), "pii-patterns")
    base = spans_.where("base").select("row", "kind", "base", "start", "end")
    if patterns.where("not base").isEmpty():
        return base
    weights, intercept = trained(patterns, *estimated(patterns))
    z = reduce(lambda a, b: a + b, [F.shiftright("features", n).bitwiseAND(F.lit(1)) * w for n, w in enumerate(weights)])
    good = spans_.where(~F.col("base") & (z + intercept >= math.log(threshold / (1 - threshold))))
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    free = good.withColumn("reach", F.max("end").over(before)).where("reach is null or reach <= start")
    return base.union(free.select("row", "kind", "base", "start", "end"))


def detected(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row; counts are of base spans."""
    found = stored(spans(docs.select("doc_id", "text")), "pii-spans")
    judged = chosen(stored(candidates(found), "pii-candidates"), threshold)
    kind = F.get(F.array(*map(F.lit, KINDS)), F.col("kind"))
    per = judged.groupBy("row").agg(
        *[F.count_if(F.col("base") & (F.col("kind") == n)).alias(f"n_{k}") for n, k in enumerate(KINDS)],
        F.array_sort(F.collect_list(F.struct("start", "kind", "base", F.concat_ws(":", kind, "start", "end").alias("name")))).alias("all"))

    def joined(keep) -> Column:
        return F.coalesce(F.array_join(F.transform(F.filter("all", keep), lambda s: s["name"]), ","), F.lit(""))

    return found.select("row", "doc_id").join(per, "row", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(lambda s: s["base"]), 256).alias("base_sha256"), joined(lambda s: F.lit(True)).alias("spans"))
