"""PII by weak supervision, in DataFrame operations only.

Four kinds have a fixed definition and are always reported: email, ip, card and
phone. Further candidates (secret, ssn, name) come from loose patterns. On spans
of all seven kinds regex, gazetteer and context labelers vote. Their votes are
aggregated by Spark into a table of patterns, whose size is bounded by the
labelers and classes, not by the corpus. Expectation-maximisation over that table
estimates each labeler's reliability per kind and each pattern's probability; a
logistic span classifier is trained on those probabilities from the span's own
shape, its neighbours and length as well as the votes. Candidates it accepts are
added; fixed spans it doubts stay and are counted. Work on a text is in
proportion to its length: places are running sums taken in blocks, overlaps are
found by one sort, and texts are put together from pieces.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, table, texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "ssn", "name")

# Possessive forms of the contract's patterns: they match the same, without
# backtracking or recursion on long runs. \G lets a match begin where the last
# one ended; elsewhere a run is only tried from its first sign, as a later
# start would fail for the same reason.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "secret": r"(?:\G|(?<![A-Za-z0-9_/+=-]))[A-Za-z0-9_/+-]{16,}+",
    "ssn": r"(?:\G|(?<![0-9-]))[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "name": r"\b[A-Z][a-z]{1,20} [A-Z][a-z]{1,20}\b",
}

# Common given names and surnames; a longer list can be given as a parameter.
GIVEN = """james mary john patricia robert jennifer michael linda william elizabeth david barbara richard susan joseph jessica thomas sarah charles karen
christopher lisa daniel nancy matthew betty anthony margaret mark sandra donald ashley steven kimberly andrew emily paul donna joshua michelle
kenneth carol kevin amanda brian dorothy george melissa timothy deborah ronald stephanie edward rebecca jason sharon jeffrey laura ryan cynthia
anna peter maria hans klaus ursula jean pierre marie sophie jose juan carmen luis ana pedro emma oliver antonio francisco manuel isabel lucia
wolfgang jurgen dieter helmut sabine petra monika karin claude michel jacques francoise nathalie isabelle marco giulia olga ivan elena""".split()
FAMILY = """smith johnson williams brown jones garcia miller davis rodriguez martinez hernandez lopez gonzalez wilson anderson taylor moore jackson martin lee
perez thompson white harris clark lewis robinson walker young allen king wright scott torres hill green adams nelson baker hall
mueller schmidt schneider fischer weber meyer wagner becker schulz hoffmann dubois durand moreau laurent lefebvre leroy fernandez sanchez ramirez ruiz""".split()
# Endings of addresses, issuers' first digits, countries' codes, openings of secrets, networks that are nobody's.
ENDINGS = r"(?i)\.(?:com|org|net|edu|gov|info|io|biz|eu|de|fr|es|it|uk|nl|ch|at|us|ca|mx|br|ar|ru|cn|jp|in|au)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|36|38|6011|65|35)"
CALLING = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|35[0-9]|37[0-9]|38[0-9]|42[013])"
OPENINGS = r"^(?:AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|sk-|sk_live_|pk_live_|xox[abprs]-|AIza|ya29|eyJ|SG\.)"
NOBODYS = r"^(?:0|10|127|255|192\.168|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.0\.2|198\.51\.100|203\.0\.113)\."
EMAIL_CONTEXT = r"(?i)(?:e-?mail|mail|contact|write to|to|from|reach me at|<)[:\s]*$"
IP_CONTEXT = r"(?i)(?:\bip\b|address|host|server|client|from|ping)[:=\s]*$"
VERSION_CONTEXT = r"(?i)(?:version|release|\bv|rev|section|chapter)[.:\s]*$"
CARD_CONTEXT = r"(?i)(?:card|visa|mastercard|amex|credit|payment|pan)\W{0,12}$"
PHONE_CONTEXT = r"(?i)(?:phone|tel|mobile|cell|call|fax|whatsapp)\W{0,12}$"
KEYWORDS = r"(?i)(?:password|passwd|pwd|secret|token|api.?key|access.?key|credential)[\"' ]{0,3}[:=]?[\"' ]{0,3}$"
SSN_CONTEXT = r"(?i)(?:ssn|social security|tax id)\W{0,12}$"
NAME_CONTEXT = r"(?i)(?:my name is|mr\.?|mrs\.?|ms\.?|dr\.?|contact|signed|regards,?|dear) ?$"
BEFORE = 30
ACCEPT = 0.5
ROUNDS = 60


BLOCK = 256  # elements of a running sum that are copied again and again


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, computed once: a lambda evaluates what it closes over for each element, but its argument not."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """For an array of whole numbers ``op`` (a sum, a maximum) of each and all before it.

    Blocks of BLOCK are run through by themselves, then their ends, so the work
    is in proportion to the array and not to its square. The start is 0.
    """
    none = F.array().cast("array<int>")

    def along(a: Column) -> Column:
        return F.aggregate(a, none, lambda acc, x: F.concat(acc, F.array(op(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)), x))))

    def whole(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda i: along(F.slice(v, i * BLOCK + 1, F.lit(BLOCK))))

        def joined(b: Column) -> Column:
            ends = along(F.transform(b, lambda x: F.element_at(x, -1)))
            return bound(ends, lambda e: F.flatten(F.transform(b, lambda x, i: bound(F.coalesce(F.get(e, i - 1), F.lit(0)), lambda before: F.transform(x, lambda y: op(before, y))))))

        return bound(blocks, joined)

    return bound(values, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(none))


def matches(text: Column, pattern: str) -> Column:
    """All matches as structs (start, end, match, before, after), in code points, end exclusive.

    The pattern splits the text into the gaps between its matches; running sums
    of the lengths of gaps and matches give the places. ``before`` is the text
    ahead of a match, back to the begin of the match before it at most.
    """
    empty = F.array().cast("array<struct<start:int,end:int,match:string,before:string,after:string>>")

    def placed(found: Column) -> Column:
        def among(gaps: Column) -> Column:
            ends = running(F.transform(found, lambda m, i: F.char_length(F.get(gaps, i)) + F.char_length(m)), lambda x, y: x + y)

            def span(at: Column) -> Column:
                return F.transform(
                    found,
                    lambda m, i: F.struct(
                        (F.get(at, i) - F.char_length(m)).alias("start"),
                        F.get(at, i).alias("end"),
                        m.alias("match"),
                        F.right(F.concat(F.right(F.coalesce(F.get(found, i - 1), F.lit("")), F.lit(BEFORE)), F.get(gaps, i)), F.lit(BEFORE)).alias("before"),
                        F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"),
                    ),
                )

            return bound(ends, span)

        return F.when(F.size(found) > 0, bound(F.split(text, pattern, -1), among)).otherwise(empty)

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    at = F.split(F.reverse(digits), "")

    def value(d, i):
        n = d.cast("int")
        return F.when(i % 2 == 0, n).when(n < 5, 2 * n).otherwise(2 * n - 9)

    return F.aggregate(F.transform(F.filter(at, lambda d: d != ""), value), F.lit(0), lambda a, v: a + v) % 10 == 0


def _small_part(p: Column) -> Column:
    bare = F.regexp_replace(p, "^0+", "")
    return (F.char_length(bare) <= 3) & (F.when(F.char_length(bare) <= 3, F.coalesce(F.try_to_number(F.concat(F.lit("0"), bare), F.lit("9999")), F.lit(0))).otherwise(999) <= 255)


def _passes(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), _small_part)
    if kind == "card":
        d = _digits(m)
        return F.char_length(d).between(14, 19) & luhn(d)
    if kind == "phone":
        return F.char_length(_digits(m)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> dict[str, Column]:
    """The fixed kinds: per kind an array of (start, end, match)."""

    def passing(kind: str) -> Column:
        return F.filter(matches(text, PATTERNS[kind]), lambda s: _passes(kind, s["match"]))

    return {k: passing(k) for k in BASE}


# ---------------------------------------------------------------- candidates and votes


def _vote(yes: Column, no: Column) -> Column:
    """1 for, 0 against, -1 no opinion."""
    return F.when(yes, 1).when(no, 0).otherwise(-1)


def _votes(kind: str, m: Column, before: Column, given: list[str], family: list[str]) -> dict[str, Column]:
    """What the labelers say: ``shape`` and ``spread`` by patterns, ``book`` by gazetteers, ``context`` by the words ahead."""
    share = F.char_length(_digits(m)) / F.char_length(m)
    mixed = m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    never = F.lit(False)
    alike = m.rlike(r"([0-9])\1{6}")
    if kind == "email":
        return {"shape": _vote(m.rlike(r"^[A-Za-z0-9][A-Za-z0-9._+-]*@"), m.rlike(r"\.\.|^[.%+-]")), "book": _vote(m.rlike(ENDINGS), ~m.rlike(r"\.[A-Za-z]{2,}$")), "context": _vote(before.rlike(EMAIL_CONTEXT), before.rlike(r"[/@:]$")), "spread": _vote(m.rlike(r"^[^@]{3,40}@[^@]{4,}$"), m.rlike(r"^[^@]{65,}@"))}
    if kind == "ip":
        return {"shape": _vote(~m.rlike(r"(?:^|\.)0[0-9]"), m.rlike(r"(?:^|\.)0[0-9]")), "book": _vote(never, m.rlike(NOBODYS)), "context": _vote(before.rlike(IP_CONTEXT), before.rlike(VERSION_CONTEXT) | before.rlike(r"\.$")), "spread": _vote(m.rlike(r"[0-9]{2,3}\.[0-9]+\.[0-9]+"), m.rlike(r"^[0-9]\.[0-9]\.[0-9]\.[0-9]$"))}
    if kind == "card":
        return {"shape": _vote(m.rlike(r"^(?:[0-9]{4}[ -]){3}[0-9]{2,7}$|^[0-9]{14,19}$"), m.rlike(r"[ -][0-9][ -]")), "book": _vote(m.rlike(ISSUERS), m.rlike(r"^[01789]")), "context": _vote(before.rlike(CARD_CONTEXT), before.rlike(r"[.+/_-]$")), "spread": _vote(never, alike | m.rlike(r"^0+$"))}
    if kind == "phone":
        return {"shape": _vote(m.rlike(r"^\+[0-9]{1,3} ?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,5}){2,}$"), m.rlike(r"\(\(|\)\)|--|\.\.")), "book": _vote(m.rlike(CALLING), m.rlike(r"^\+0")), "context": _vote(before.rlike(PHONE_CONTEXT), before.rlike(r"[0-9*/=^]$")), "spread": _vote(m.rlike(r"[ ().-]"), alike)}
    if kind == "secret":
        return {
            "shape": _vote(m.rlike(r"^(?:AKIA[0-9A-Z]{16}|[0-9a-f]{16,}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{20,})$") & mixed, ~m.rlike("[0-9]")),
            "book": _vote(m.rlike(OPENINGS) | before.rlike(KEYWORDS), never),
            "context": _vote(before.rlike(r"[=:][\"' ]{0,3}$"), before.rlike(r"[/.@]$")),
            "spread": _vote(mixed & share.between(0.15, 0.9), (share == 0) | m.rlike(r"(.)\1{5}")),
        }
    if kind == "ssn":
        odd = m.rlike(r"^(?:000|666|9)|-00-|-0000$")
        return {"shape": _vote(~odd, odd), "book": _vote(never, m.isin("123-45-6789", "111-11-1111", "078-05-1120", "219-09-9999")), "context": _vote(before.rlike(SSN_CONTEXT), before.rlike(r"(?i)(?:isbn|order|part|no\.?) ?$")), "spread": _vote(never, m.rlike(r"(\d)\1\1-\1\1-"))}
    first, last = F.lower(F.substring_index(m, " ", 1)), F.lower(F.substring_index(m, " ", -1))
    return {
        "shape": _vote(never, m.rlike(r"^(?:The|This|That|And|But|For|With|From|Not|Die|Der|Das|Les|Los|Las|El|La|Le)\b")),
        "book": _vote(first.isin(given) & last.isin(family), ~first.isin(given) & ~last.isin(family)),
        "context": _vote(before.rlike(NAME_CONTEXT), before.rlike(r"[|#*]\s*$")),
        "spread": _vote(first.isin(given), ~first.isin(given) & ~before.rlike(NAME_CONTEXT)),
    }


LABELERS = ("shape", "book", "context", "spread")
TRAITS = ("form", "left", "right")  # classes of the span's own signs and of its neighbours


def _form(m: Column) -> Column:
    """What a span is made of: figures, small hexadecimals, capitals and figures, figures and letters, letters, other signs."""
    return F.when(m.rlike(r"^[0-9 ().+-]+$"), 0).when(m.rlike("^[0-9a-f]+$"), 1).when(m.rlike("^[0-9A-Z]+$"), 2).when(m.rlike("^[0-9A-Za-z]+$") & m.rlike("[0-9]"), 3).when(m.rlike("^[A-Za-z ]+$"), 4).otherwise(5)


def _neighbour(c: Column) -> Column:
    return F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike(r"^[\"'=:<>()\[\]{},;]$"), 2).when(c.rlike(r"^[A-Za-z0-9]$"), 3).otherwise(4)


def voted(kind: str, given: list[str], family: list[str]) -> Callable[[Column], Column]:
    """A match as a struct of its place, votes and traits."""

    def of(s: Column) -> Column:
        m, before = s["match"], s["before"]
        size = F.least(F.floor(F.log2(F.char_length(m).cast("double"))), F.lit(8)).cast("int")
        votes = [v.cast("int").alias(n) for n, v in _votes(kind, m, before, given, family).items()]
        traits = [_form(m).alias("form"), _neighbour(F.right(before, F.lit(1))).alias("left"), _neighbour(s["after"]).alias("right")]
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), size.alias("size"), *votes, *traits)

    return of


def clear_of(spans: Column, base: Column) -> Column:
    """The spans that no base span overlaps.

    All are sorted by where bases begin and spans end. Up to its own end the
    furthest end of a base must not pass the span's begin.
    """
    entry = lambda pos, tag, far, i: F.struct(pos.alias("pos"), F.lit(tag).alias("tag"), far.alias("far"), i.alias("i"))

    def among(s: Column) -> Column:
        ends = F.transform(s, lambda x, i: entry(x["end"], 0, F.lit(0), i))
        begins = F.transform(base, lambda b: entry(b["start"], 1, b["end"], F.lit(-1)))

        def swept(order: Column) -> Column:
            far = running(F.transform(order, lambda e: e["far"]), F.greatest)

            def kept(f: Column) -> Column:
                marked = F.transform(order, lambda e, j: F.struct(e["i"].alias("i"), F.get(f, j).alias("far")))
                mine = F.filter(marked, lambda x: x["i"] >= 0)
                free = F.filter(mine, lambda x: x["far"] <= F.get(s, x["i"])["start"])
                return F.transform(F.array_sort(F.transform(free, lambda x: x["i"])), lambda i: F.get(s, i))

            return bound(far, kept)

        return F.when((F.size(s) == 0) | (F.size(base) == 0), s).otherwise(bound(F.array_sort(F.concat(ends, begins)), swept))

    return bound(spans, among)


def with_candidates(docs: DataFrame, given: list[str] | None = None, family: list[str] | None = None) -> DataFrame:
    """``docs`` (with a text that is not null) plus ``base`` and ``extra`` arrays of spans with votes and traits.

    ``extra`` are candidates of the further kinds that no fixed span overlaps.
    """
    names = given or GIVEN, family or FAMILY
    fixed = F.concat(*[F.transform(spans, voted(kind, *names)) for kind, spans in base_spans(F.col("text")).items()])
    loose = lambda base: F.concat(*[F.transform(clear_of(matches(F.col("text"), PATTERNS[k]), base), voted(k, *names)) for k in KINDS[len(BASE) :]])
    return docs.withColumn("base", fixed).withColumn("extra", bound(F.col("base"), loose))


# ---------------------------------------------------------------- aggregation of the votes


def candidate_table(docs: DataFrame) -> DataFrame:
    """(doc_id, base, extra) per row, written to the shared folder: the texts are searched once."""
    return staged(with_candidates(texts(docs)).select("doc_id", "base", "extra"), "pii-candidates")


def vote_table(found: DataFrame) -> list[tuple]:
    """(kind, size, votes..., traits..., n): at most kinds x sizes x 3^labelers x classes rows, whatever the corpus."""
    rows = found.select(F.explode(F.concat("base", "extra")).alias("c")).groupBy("c.kind", "c.size", *[f"c.{n}" for n in (*LABELERS, *TRAITS)]).count().collect()
    return sorted(tuple(r) for r in rows)


def estimate(rows: list[tuple], rounds: int = ROUNDS) -> tuple[dict, list[float]]:
    """EM over vote patterns: (reliabilities by (kind, labeler), probability of each row).

    Labelers are taken as independent given the truth. A labeler's chances of
    each vote, for real and for chance spans, start from "right three times of
    four" and are smoothed, so a pattern never seen has a defined probability.
    """
    kinds = sorted({r[0] for r in rows})
    votes = np.array([r[2 : 2 + len(LABELERS)] for r in rows]).reshape(-1, len(LABELERS))
    n = np.array([float(r[-1]) for r in rows])
    prior = {(y, v): 0.6 if v == y else 0.2 if v >= 0 else 0.4 for y in (0, 1) for v in (-1, 0, 1)}
    p = np.zeros(len(rows))
    trust = {}
    for k in kinds:
        mine = np.array([r[0] == k for r in rows])
        v, m, share = votes[mine], n[mine], 0.5
        chance = np.array([[[prior[y, x] for x in (-1, 0, 1)] for y in (0, 1)] for _ in LABELERS])  # labeler, truth, vote
        for _ in range(rounds):
            odds = math.log(share / (1 - share)) + sum(np.log(chance[i, 1, v[:, i] + 1] / chance[i, 0, v[:, i] + 1]) for i in range(len(LABELERS)))
            q = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            share = float((m @ q + 1) / (m.sum() + 2))
            for i in range(len(LABELERS)):
                for y in (0, 1):
                    w = m * (q if y else 1 - q)
                    for x in (-1, 0, 1):
                        chance[i, y, x + 1] = (w[v[:, i] == x].sum() + 4 * prior[y, x]) / (w.sum() + 4 * 1.2)
        p[mine] = q
        trust |= {(k, name): tuple(round(float(chance[i, y, y + 1]), 6) for y in (0, 1)) for i, name in enumerate(LABELERS)}
    return trust, p.tolist()


def span_classifier(rows: list[tuple], p: list[float], rounds: int = 800) -> dict[tuple, float]:
    """Logistic weights by (kind, feature, value), trained on the estimated probabilities of the rows."""

    def parts(r: tuple) -> list[tuple]:
        return [(r[0], "bias", 0), (r[0], "size", r[1]), *[(r[0], n, v) for n, v in zip((*LABELERS, *TRAITS), r[2:-1], strict=False)]]

    index: dict[tuple, int] = {}
    at = np.array([[index.setdefault(f, len(index)) for f in parts(r)] for r in rows])
    w = np.zeros(len(index))
    if not len(at):
        return {}
    weight, target = np.log1p([r[-1] for r in rows]), np.array(p)
    weight = weight / weight.sum()
    for _ in range(rounds):
        d = (1 / (1 + np.exp(-np.clip(w[at].sum(axis=1), -30, 30))) - target) * weight
        g = np.bincount(at.ravel(), weights=np.repeat(d, at.shape[1]), minlength=len(w))
        w -= 2.0 * (g + 1e-4 * w)
    return {f: float(w[i]) for f, i in index.items()}


def _probability(c: Column, weights: dict[tuple, float]) -> Column:
    """The classifier as an expression: per feature a map from kind and value to the weight."""
    z = F.lit(0.0)
    for field in ("size", *LABELERS, *TRAITS):
        known = [(f"{kind}:{value}", x) for (kind, name, value), x in sorted(weights.items()) if name == field]
        if known:
            rule = F.create_map(*[F.lit(v) for pair in known for v in pair])
            z = z + F.coalesce(F.try_element_at(rule, F.concat(c["kind"], F.lit(":"), c[field].cast("string"))), F.lit(0.0))
    bias = F.lit(-30.0)  # a kind that was never seen
    for (kind, name, _), x in sorted(weights.items()):
        if name == "bias":
            bias = F.when(c["kind"] == kind, x).otherwise(bias)
    return 1 / (1 + F.exp(-(z + bias)))


class Model:
    def __init__(self, reliabilities: dict, weights: dict[tuple, float]):
        self.reliabilities, self.weights = reliabilities, weights


def train(found: DataFrame) -> Model:
    """Reliabilities and span classifier from a table with candidates (``extra``)."""
    rows = vote_table(found)
    if not rows:
        return Model({}, {})
    reliabilities, p = estimate(rows)
    return Model(reliabilities, span_classifier(rows, p))


# ---------------------------------------------------------------- results


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row (doc_id, spans, n_doubtful) per row of ``docs``; spans are (start, rank, kind, end, base), sorted.

    ``rank`` is the kind's place in KINDS. Fixed kinds are all there; further
    spans are those that the classifier accepts; ``n_doubtful`` counts the fixed
    ones it would not have. Null texts are empty; empty texts have no spans. A
    null doc_id keeps its row, repeated rows are kept, an empty table gives no rows.
    """
    found = candidate_table(docs)
    return _with_spans(found, model or train(found)).select("doc_id", "spans", "n_doubtful")


def _with_spans(docs: DataFrame, model: Model) -> DataFrame:
    rank = F.create_map(*[F.lit(v) for i, k in enumerate(KINDS) for v in (k, i)])
    accepted = lambda c: _probability(c, model.weights) >= ACCEPT

    def placed(s, base):
        return F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(base).alias("base"))

    spans = F.array_sort(F.concat(F.transform("base", lambda s: placed(s, True)), F.transform(F.filter("extra", accepted), lambda s: placed(s, False))))
    doubtful = F.size("base") - F.size(F.filter("base", accepted))
    return docs.withColumn("spans", spans).withColumn("n_doubtful", doubtful.cast("long"))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; of spans that overlap the first goes whole.

    ``spans`` are sorted. The text is taken apart once and put together from pieces.
    """

    def pieces(chars: Column) -> Column:
        def among(far: Column) -> Column:
            upto = lambda i: F.coalesce(F.get(far, i - 1), F.lit(0))
            between = lambda a, z: F.array_join(F.slice(chars, a + 1, F.greatest(z - a, F.lit(0))), "")
            parts = F.transform(spans, lambda s, i: F.when(s["start"] >= upto(i), F.concat(between(upto(i), s["start"]), F.lit("<"), s["kind"], F.lit(">"))).otherwise(""))
            return F.concat(F.array_join(parts, ""), between(F.element_at(far, -1), F.size(chars)))

        return bound(running(F.transform(spans, lambda s: s["end"]), F.greatest), among)

    return F.when(F.size(spans) == 0, text).otherwise(bound(F.split(text, ""), pieces))


def masked(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with all its columns, the spans of each text replaced by their kinds, n_chars brought up to date.

    A null text stays null, an empty one empty; rows with null or repeated ids
    stay as many as they are; an empty table gives no rows. Texts are searched
    once: the rows are written down with their candidates.
    """
    packed = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = staged(with_candidates(packed).select("row", "base", "extra"), "pii-rows")
    done = _with_spans(found, model or train(found))
    clean = F.when(F.size("spans") > 0, redact(F.col("row.text").cast("string"), F.col("spans"))).otherwise(F.col("row.text").cast("string"))
    done = done.withColumn("clean", clean)
    new = {"text": F.col("clean"), "n_chars": F.char_length("clean").cast("long")}
    return done.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_pii_weak(spark, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in BASE]
    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), "n_doubtful")
