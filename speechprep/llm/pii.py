"""Operator 10: personal data by weak supervision.

Candidate spans come from patterns that are wider than the base rules.  Six
labelers vote on each candidate (+ yes, - no, 0 abstain): form, gazetteer,
context cue before it, left edge, digit variety, separators.  Votes of all
candidates of all rows are counted per kind and vote pattern (2 * 3^6 patterns a
kind at most, so the counts have a fixed bound); expectation-maximisation on
these counts estimates, for each kind, how many candidates are true and how
reliable each labeler is when it votes (abstaining says nothing).  The kinds'
tables are drawn towards their common one, which decides where a kind has few
candidates.  Truth is anchored: a base span is a near-certain yes, a span that
fails its form (a wrong check digit, a part over 255) a known no.  The
probabilities are the soft labels that train the final span classifier, a
naive-Bayes model over span features whose counts are one grouped sum over all
candidates.  A candidate that is a base span always stays; any other is added
if the classifier says yes and it overlaps no base span.

:func:`detect` scans the texts once: each row's candidates, votes and features
are written as a narrow table, which trains the model and is then scored.

Patterns are written so that no text makes them slow or deep: runs are single
character classes, and separators inside a run are first replaced, one for
one, by a private-use character (which keeps positions).

Defined cases: null text counts as empty; no candidates give an untrained
classifier that adds nothing; repeated rows and null doc_ids each get their
row; an empty table gives an empty result; extra columns are ignored by
:func:`detect` and carried by :func:`redact`.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, let, matches, pick, running_max, table, total, unboxed, written

KINDS = ("email", "ip", "card", "phone", "ssn", "name", "secret")  # base kinds first, in their fixed order
BASE_KINDS = KINDS[:4]
#: Slots that the shapes of one kind are hashed into.
SHAPES = 512
LABELERS = ("form", "gazetteer", "context", "edge", "variety", "separators")

#: Stand-ins for one separator inside a run; the first step moves the same
#: characters of the text itself out of the way.
_MARK, _OTHER = "\ue000", "\ue001"

GIVEN_NAMES = ("Alexander", "Andrew", "Anthony", "Barbara", "Benjamin", "Carlos", "Catherine", "Charles", "Charlotte",
               "Christopher", "Claudia", "Daniel", "Deborah", "Elizabeth", "Emily", "François", "Friedrich", "George",
               "Hannah", "Heinrich", "Isabella", "Jacques", "James", "Jennifer", "Jessica", "Johannes", "Jonathan",
               "Joseph", "Juan", "Katharina", "Kenneth", "Laura", "Margaret", "Maria", "Matthew", "Michael", "Michelle",
               "Nicole", "Olivia", "Patricia", "Richard", "Robert", "Rebecca", "Samuel", "Sandra", "Sebastian", "Sophie",
               "Stephanie", "Susan", "Theodore", "Thomas", "Victoria", "Wilhelm", "William")
MAIL_ENDS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "it", "eu", "info", "co")
CUES = {
    "email": r"(?i)(?:mail|contact|write to|reach|address)\W{0,4}(?:\w{1,6}\W{0,3})?$",
    "ip": r"(?i)(?:\bip|host|server|address|from|login)\W{0,4}(?:\w{1,6}\W{0,3})?$",
    "card": r"(?i)(?:card|visa|mastercard|credit|payment)\W{0,4}(?:\w{1,7}\W{0,3})?$",
    "phone": r"(?i)(?:phone|call|tel|mobile|fax|contact)\W{0,4}(?:\w{1,7}\W{0,3})?$",
    "ssn": r"(?i)(?:ssn|social security|security number|tax id)\W{0,4}(?:\w{1,7}\W{0,3})?$",
    "name": r"(?i)(?:name|dear|contact|signed|patient|regards)\W{0,4}(?:is\W{1,2})?$",
    "secret": r"(?i)(?:token|secret|api[ _-]?key|access[ _-]?key|auth[ _-]?key|password|passwd|pwd|bearer)\W{0,5}(?:is\W{1,3})?$",
}
AGAINST = r"(?i)(?:version|release|isbn|order|section|chapter|page|build|serial|invoice|figure|item)\W{0,4}(?:\w{1,3}\W{0,3})?$"


def _marked(text: Column, around: str, sep: str) -> Column:
    """``sep`` between two characters of class ``around`` becomes the mark."""
    clear = F.replace(text, F.lit(_MARK), F.lit(_OTHER))
    return F.regexp_replace(clear, f"(?<=[{around}])[{sep}](?=[{around}])", _MARK)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def part(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 1, 2 * d).otherwise(d)
        return F.when(twice > 9, twice - 9).otherwise(twice).cast("long")

    return total(F.transform(F.sequence(F.lit(0), n - 1), part)) % 10 == 0


def _ip_ok(m: Column) -> Column:
    """Four parts of at most 255, however many leading zeros."""
    return ~F.exists(F.split(m, r"\."), lambda p: ~F.rlike(p, F.lit(r"^0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$")))


_SPAN = ("array<struct<kind:int,start:bigint,end:bigint,match:string,left:string,base:boolean>>")


def _spans(gate: Column, text: Column, pattern: str, kind: str, is_base, keep=None) -> Column:
    """Matches of one pattern as candidate spans; nothing runs unless ``gate``."""

    def one(m: Column) -> Column:
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
            m["match"].alias("match"), m["left"].alias("left"), is_base(m["match"]).alias("base"),
        )

    found = let(text, lambda t: matches(t, F.lit(pattern)))
    spans = F.transform(found if keep is None else F.filter(found, lambda m: keep(m["match"])), one)
    return F.when(gate, spans).otherwise(F.expr(f"CAST(array() AS {_SPAN})"))


def candidates(text: Column) -> Column:
    """All candidate spans of a text: base spans flagged, wider ones not."""
    yes, no = (lambda m: F.lit(True)), (lambda m: F.lit(False))
    n_digits = lambda m: F.length(_digits(m))
    local, label = "A-Za-z0-9._%+-", "A-Za-z0-9-"
    n = F.length(text) - F.length(F.regexp_replace(text, "[0-9]+", ""))
    digits = F.rlike(text, F.lit("[0-9]"))
    run = r"[0-9]" + f"[0-9{_MARK}]" + "{12,}"
    card = lambda m: F.length(_digits(m)).between(16, 19) & _luhn(_digits(m))
    parts = [
        # a local part starts where its run starts, or right after the match before
        _spans(F.contains(text, F.lit("@")), _marked(text, label, "."),
               rf"(?:\G|(?<![{_MARK}{local}]))[{_MARK}{local}]++@[{label}]++{_MARK}[{_MARK}{label}]++", "email", yes),
        _spans(F.rlike(text, F.lit(r"[\[(] ?at ?[\])]")), text,
               rf"(?<![{local}])[{local}]++ ?[\[(] ?at ?[\])] ?[{label}]++(?: ?[\[(] ?dot ?[\])] ?|\.)[{label}]++", "email", no),
        _spans(F.rlike(text, F.lit(r"[0-9]\.[0-9]")), text, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "ip", _ip_ok),
        _spans(digits & (n >= 13), _marked(text, "0-9", " -"), run, "card", card,
               lambda m: n_digits(m).between(13, 19)),
        _spans(F.rlike(text, F.lit(r"\+[0-9]")), text, r"\+[0-9][\x20().0-9-]+[0-9]", "phone",
               lambda m: n_digits(m).between(8, 15)),
        _spans(F.rlike(text, F.lit(r"[0-9]{3}[.-][0-9]{4}")), text,
               r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-]?[0-9]{3}[.-][0-9]{4}(?![0-9.-])", "phone", no),
        _spans(F.rlike(text, F.lit(r"[0-9]-[0-9]{2}-[0-9]")), text,
               r"(?<![0-9.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9.-])", "ssn", no),
        _spans(F.rlike(text, F.lit(r"\b(?:" + "|".join(GIVEN_NAMES) + r") [A-Z]")), text,
               r"(?<![\p{L}0-9])(?:" + "|".join(GIVEN_NAMES) + r") [A-Z][\p{L}'-]{1,30}(?![\p{L}0-9])", "name", no),
        _spans(F.rlike(text, F.lit(r"[A-Za-z0-9+/_-]{20}")), text, r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+", "secret", no,
               lambda m: (n_digits(m) >= 4) & F.rlike(m, F.lit("[A-Za-z].*[A-Za-z].*[A-Za-z]"))),
    ]
    return let(F.concat(*parts), _apart)


def _apart(spans: Column) -> Column:
    """Base spans, and the others that overlap none.  In the order of where a
    base span starts and where another ends, the furthest end of the base spans
    so far tells; spans are not compared one with another."""
    of = lambda y: F.get(spans, y["k"])
    events = F.sort_array(F.transform(spans, lambda x, k: F.struct(
        F.when(x["base"], x["start"]).otherwise(x["end"]).alias("at"), x["base"].cast("int").alias("base"), k.alias("k"))))

    def free(e: Column) -> Column:
        ends = F.transform(e, lambda y: F.when(y["base"] == 1, of(y)["end"]).otherwise(-1))
        return let(running_max(ends), lambda far: F.transform(
            F.filter(F.transform(e, lambda y, i: F.struct(
                y["k"].alias("k"), ((y["base"] == 1) | (F.get(far, i) <= of(y)["start"])).alias("ok"))), lambda y: y["ok"]), of))

    some = F.exists(spans, lambda x: x["base"]) & F.exists(spans, lambda x: ~x["base"])
    return F.when(some, let(events, free)).otherwise(spans)


def _by_kind(kind: Column, values: dict[str, Column], other: Column) -> Column:
    return reduce(lambda acc, kv: F.when(kind == KINDS.index(kv[0]), kv[1]).otherwise(acc), values.items(), other)


def votes(x: Column) -> Column:
    """Six characters of ``+``, ``-``, ``0`` for one candidate span."""
    kind, m, left = x["kind"], F.replace(x["match"], F.lit(_MARK), F.lit(" ")), x["left"]
    d = _digits(m)
    vote = lambda yes, no: F.when(yes, "+").when(no, "-").otherwise("0")
    none = F.lit(False)
    luhn = F.when((kind == KINDS.index("card")) & (d != ""), _luhn(d)).otherwise(none)
    form = F.when(x["base"], "+").otherwise(_by_kind(kind, {
        "ssn": vote(~F.rlike(m, F.lit(r"^(?:000|666|9..)-|-00-|-0000$")), ~none),
        "phone": vote(F.rlike(m, F.lit(r"^\(?[2-9]")), ~none), "name": F.lit("0"),
        # no base span: written with [at], or 13 to 15 digits, or too many digits or wrong ones
        "email": F.lit("0"), "secret": vote(F.rlike(m, F.lit(r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$")) | (F.rlike(m, F.lit("[a-z]")) & F.rlike(m, F.lit("[A-Z]"))), none),
        "card": vote(luhn & F.rlike(d, F.lit(r"^(?:3[47][0-9]{13}|3(?:0[0-5]|[689][0-9])[0-9]{11}|4[0-9]{12})$")), ~luhn),
    }, F.lit("-")))
    gazetteer = _by_kind(kind, {
        "email": vote(F.regexp_extract(F.lower(x["match"]), r"([a-z0-9-]+)$", 1).isin(*MAIL_ENDS), none),
        "ip": vote(none, F.rlike(m, F.lit(r"^0+\.|\.255$"))),
        "card": vote(F.rlike(d, F.lit(r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)")), F.rlike(d, F.lit("^0"))),
        "phone": vote(F.rlike(d, F.lit(r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])")), F.rlike(d, F.lit("^0"))),
        "name": F.lit("+"),
    }, F.lit("0"))
    cue = _by_kind(kind, {k: F.rlike(left, F.lit(rx)) for k, rx in CUES.items()}, none)
    context = vote(cue, F.rlike(left, F.lit(AGAINST)))
    edge = vote(F.rlike(left, F.lit(r"(?:^|[\s(:,;\"'<])$")), F.rlike(left, F.lit(r"[\p{L}\p{N}._/=#-]$")))
    variety = F.when(d == "", "0").otherwise(vote(
        F.length(F.regexp_replace(d, r"(.)(?=.*\1)", "")) >= 4, F.length(F.regexp_replace(d, r"(.)(?=.*\1)", "")) <= 2))
    separators = _by_kind(kind, {
        "phone": vote(F.rlike(m, F.lit(r"^\+|\)|-")), none), "card": vote(F.rlike(m, F.lit(r"^[0-9]{4}[ -][0-9]{4}")), none),
        "ssn": F.lit("+"), "email": vote(F.rlike(m, F.lit("@")), none),
    }, F.lit("0"))
    return F.concat(form, gazetteer, context, edge, variety, separators)


def _translated(m: Column) -> Column:
    """Characters as their class: 9, a, a blank, an ASCII sign, or the replacement character."""
    for rx, to in ((r"\p{N}", "9"), (r"\p{L}", "a"), (r"[\p{Z}\s]", " "), (r"[^\x20-\x7E]", "\ufffd")):
        m = F.regexp_replace(m, rx, to)
    return m


def features(x: Column) -> Column:
    """Categorical features of a span, as an array of strings.  Their values
    are closed sets: classes and capped numbers, the last two characters as
    digit, letter, blank, one of ASCII's signs or any other, and the whole
    shape hashed into ``SHAPES`` slots a kind."""
    m = F.replace(x["match"], F.lit(_MARK), F.lit(" "))
    n = F.length(_digits(m))
    name = lambda k, v: F.concat(F.lit(k + "="), v.cast("string"))
    kind = x["kind"].cast("string")
    return F.array(
        F.concat(F.lit("kind="), kind, F.lit(x_sep), x["base"].cast("string")),
        F.concat(F.lit("digits="), kind, F.lit(x_sep), F.least(n, F.lit(24)).cast("string")),
        name("length", F.least(F.length(m) / 4, F.lit(16)).cast("int")),
        F.concat(F.lit("shape="), kind, F.lit(x_sep), F.pmod(F.xxhash64(F.regexp_replace(F.regexp_replace(F.regexp_replace(m, "[0-9]+", "9"), r"\p{Lu}+", "A"), r"\p{Ll}+", "a")), F.lit(SHAPES)).cast("string")),
        name("left", _translated(F.right(x["left"], F.lit(2)))),
        F.concat(F.lit("votes="), F.substring(votes(x), 1, 3)),
    )


x_sep = "/"


YES, NO = 0.99, 0.0  # probabilities of anchored patterns


def _known(pattern: str) -> float | None:
    """``y`` before the votes marks base spans; the form labeler's no is certain."""
    return YES if pattern[0] == "y" else NO if pattern[-len(LABELERS)] == "-" else None


def em_kinds(counts: dict[str, dict[str, int]], rounds: int = 200, pull: float = 8.0) -> tuple[dict, dict]:
    """Expectation-maximisation over the vote patterns of several kinds: the
    probability of each kind's patterns and, by kind, the prior and each
    labeler's reliability when it votes.

    ``pull`` votes of the kinds' common table are added to each kind's own; a
    light prior says that a labeler is right more often than wrong."""
    n = len(LABELERS)
    light = {("+", 1): 2.0, ("-", 1): 0.5, ("-", 0): 2.0, ("+", 0): 0.5}
    start = lambda s: 1 / (1 + math.exp(-(s[-n:].count("+") - s[-n:].count("-"))))
    p = {k: {s: start(s) if _known(s) is None else _known(s) for s in c} for k, c in counts.items()}
    prior, open_, rates = {}, {}, {}
    for _ in range(rounds):
        got = {}
        for k, c in counts.items():
            got[k] = {(j, v, z): 0.0 for j in range(n) for v, z in light}
            for s, m in c.items():
                for j, v in enumerate(s[-n:]):
                    if v != "0":
                        got[k][j, v, 1] += m * p[k][s]
                        got[k][j, v, 0] += m * (1 - p[k][s])
            prior[k] = (sum(m * p[k][s] for s, m in c.items()) + 1) / (sum(c.values()) + 2)
            # what is true among those that no anchor decides
            left = [(m, p[k][s]) for s, m in c.items() if _known(s) is None]
            open_[k] = (sum(m * x for m, x in left) + 1) / (sum(m for m, _ in left) + 2)
        common = {}
        for j in range(n):
            for z in (0, 1):
                sums = {v: light[v, z] + sum(g[j, v, z] for g in got.values()) for v in "+-"}
                common |= {(j, v, z): sums[v] / (sums["+"] + sums["-"]) for v in "+-"}
        for k, g in got.items():
            rates[k] = {}
            for j in range(n):
                for z in (0, 1):
                    sums = {v: g[j, v, z] + pull * common[j, v, z] for v in "+-"}
                    rates[k] |= {(j, v, z): sums[v] / (sums["+"] + sums["-"]) for v in "+-"}
        change = 0.0
        for k, c in counts.items():
            for s in c:
                log = math.log(open_[k] / (1 - open_[k])) + sum(
                    math.log(rates[k][j, v, 1] / rates[k][j, v, 0]) for j, v in enumerate(s[-n:]) if v != "0")
                new = 1 / (1 + math.exp(-max(-30.0, min(30.0, log)))) if _known(s) is None else _known(s)
                change = max(change, abs(new - p[k][s]))
                p[k][s] = new
        if change < 1e-9:
            break
    return p, {k: {"prior": prior[k], "labelers": {
        name: {"yes_if_true": r[j, "+", 1], "no_if_false": r[j, "-", 0]} for j, name in enumerate(LABELERS)}} for k, r in rates.items()}


def em(counts: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], dict]:
    """:func:`em_kinds` for one kind."""
    if not counts:
        return {}, {"prior": 0.5, "labelers": {}}
    p, model = em_kinds({"": counts}, rounds)
    return p[""], model[""]


_DESCRIBED = "array<struct<kind:int,start:bigint,end:bigint,base:boolean,votes:string,features:array<string>>>"


def described(text: Column) -> Column:
    """Candidates of a text with their votes and features."""
    return F.transform(candidates(text), lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["base"].alias("base"),
        F.concat(F.when(x["base"], "y").otherwise(""), votes(x)).alias("votes"), features(x).alias("features")))


def fit(docs: DataFrame) -> dict:
    """Train on all candidates of all rows; see :func:`fit_spans`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return fit_spans(written(pick(docs, "text").select(described(text).alias("found")).where(F.size("found") > 0), "pii-candidates"))


def fit_spans(rows: DataFrame) -> dict:
    """Train on the candidates in column ``found``.  Returns the EM result of
    each kind and the span classifier (prior log odds and one weight a feature).

    The values of all features are closed sets (about 5,000 values at most),
    which bounds the model whatever the data; every value has its weight."""
    spans = rows.select(F.explode("found").alias("x")).select("x.kind", "x.votes", "x.features")
    counts: dict[str, dict[str, int]] = {}
    for r in spans.groupBy("kind", "votes").count().collect():
        counts.setdefault(KINDS[r.kind], {})[r.votes] = r["count"]
    p, kinds = em_kinds(counts)
    model = {"kinds": kinds, "weights": {}, "bias": -1.0, "chances": p}
    if not p:
        return model
    flat = {f"{KINDS.index(k)}{s}": x for k, of in p.items() for s, x in of.items()}
    soft = F.element_at(F.from_json(F.lit(_json(flat)), "map<string,double>"), F.concat(F.col("kind").cast("string"), "votes"))
    sums = (
        spans.select(F.explode("features").alias("f"), soft.alias("p"))
        .groupBy("f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
        .collect()
    )
    yes = sum(m * p[k][s] for k, c in counts.items() for s, m in c.items())
    no = sum(sum(c.values()) for c in counts.values()) - yes
    model["bias"] = math.log((yes + 1) / (no + 1))
    model["weights"] = {
        r["f"]: round(math.log((r["yes"] + 0.5) / (yes + 1)) - math.log((r["no"] + 0.5) / (no + 1)), 6) for r in sums
    }
    return model


def _json(d: dict) -> str:
    import json

    return json.dumps(d)


def kept(found: Column, model: dict) -> Column:
    """Of :func:`described` candidates the spans that stay, by kind and start."""
    weights = F.from_json(F.lit(_json(model["weights"] or {"-": 0.0})), "map<string,double>")

    def says_yes(x: Column) -> Column:
        log = F.aggregate(
            x["features"], F.lit(float(model["bias"])),
            lambda a, f: a + F.coalesce(F.try_element_at(weights, f), F.lit(0.0)),
        )
        return x["base"] | (log > 0)

    return F.sort_array(F.transform(F.filter(found, says_yes), lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["base"].alias("base"))))


def spans_of(text: Column, model: dict) -> Column:
    """The spans of a text that stay, ordered by kind and start."""
    return kept(described(text), model)


def _told(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def detect(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """doc_id, counts of base spans, their digest, all spans as text; one row
    per input row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(pick(docs, "doc_id", "text").select("doc_id", described(text).alias("found")), "pii-candidates")
    d = rows.select("doc_id", kept(F.col("found"), model or fit_spans(rows)).alias("found"))
    d = d.withColumn("base", F.filter("found", lambda x: x["base"]))
    n = lambda k: F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return d.select("doc_id", *[n(k) for k in BASE_KINDS],
                    F.sha2(_told(F.col("base")).cast("binary"), 256).alias("base_sha256"), _told(F.col("found")).alias("spans"))


_CUT = 1024  # characters of a stretch of text


def _before(far: Column, i: Column) -> Column:
    """Where the spans before the ``i``-th end."""
    return F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(far, i - 1))


def _stretch(cut: Column, a: Column, b: Column) -> Column:
    """Characters ``a`` to ``b`` of a text cut into stretches, so that the work
    is that of the characters taken and does not grow with their place."""
    at = lambda x: F.floor(x / _CUT).cast("int")
    rest = lambda x: (x % _CUT).cast("int")
    part = lambda k, start, n: F.coalesce(F.substring(F.get(cut, k), start + 1, n), F.lit(""))
    inner = F.array_join(F.slice(cut, at(a) + 2, F.greatest(F.lit(0), at(b) - at(a) - 1)), "")
    return F.when(at(a) == at(b), part(at(a), rest(a), (b - a).cast("int"))).otherwise(
        F.concat(part(at(a), rest(a), F.lit(_CUT)), inner, part(at(b), F.lit(0), rest(b))))


def redact(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (spans that
    overlap become one) and n_chars, if there is such a column, brought up to
    date; rows without spans are unchanged."""
    model = model or fit(docs)
    cols = docs.columns
    d = boxed(docs, "text").withColumn("found", spans_of(F.coalesce(F.col("text"), F.lit("")), model))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.sort_array(F.transform("found", lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    clean = let(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{_CUT}}}"), F.lit(0)), lambda cut: let(
        by_start, lambda spans: let(
            running_max(F.transform(spans, lambda x: x["end"])), lambda far: F.concat(
                F.array_join(F.transform(spans, lambda x, i: F.when(
                    x["start"] < _before(far, i), "").otherwise(
                    F.concat(_stretch(cut, _before(far, i), x["start"]), F.get(names, x["kind"])))), ""),
                _stretch(cut, F.get(far, F.size(far) - 1), F.length("text").cast("long"))))))
    d = d.withColumn("clean", F.when(F.size("found") > 0, clean).otherwise(F.col("text")))
    replace = {"text": F.col("clean")}
    if "n_chars" in cols:
        old = F.col(f"_row.c{cols.index('n_chars')}")
        replace["n_chars"] = F.when(F.size("found") > 0, F.length("clean").cast(docs.schema.fields[cols.index("n_chars")].dataType)).otherwise(old)
    return unboxed(d, cols, **replace)


def query(spark, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents"))
