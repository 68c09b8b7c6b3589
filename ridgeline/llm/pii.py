"""Personal data by weak supervision, with DataFrame functions only.

Candidates. Every kind has a pattern. The four base kinds are exact: ``email``,
``ip`` (four numbers of at most 255), ``card`` (12 to 19 digits that pass Luhn) and
``phone`` (``+`` and 9 to 15 digits); a match that fails its check is consumed and
dropped. Five more kinds are looser and only propose: ``local`` (a phone number
without country code), ``ssn``, ``iban``, ``spoken`` (an address written as "name at
host dot com") and ``person`` (a title and names).

Labelers. Each candidate, base ones and base matches that failed their check
included, gets a vote (yes, no, abstain) from six labelers: two read its form by
regex and check digits, two look it up in gazetteers (top-level domains, issuer and
country prefixes, given names; reserved and sample values), two read its context
(cue words in front, the characters around).

Aggregation. A two-class model with one vote table per kind and labeler, votes
independent given the class, is fitted by expectation-maximisation on the counts of
the distinct vote vectors of the whole corpus. The posteriors are the soft labels
of a logistic regression over the votes and the form of a span (length, digits,
separators, capitals), fitted on the counts of its distinct feature vectors. A
candidate of a further kind is reported if that classifier gives it ``THRESHOLD`` or
more and it overlaps no base span; base spans always are.

The text is scanned once; only matches and the characters around them go on. The
vote and feature vectors are few whatever the corpus (3 ** 6 votes a kind), so
the fits see bounded tables. Patterns are linear: runs are possessive and begin at
a run's first character or where the last match ended, which gives the same
leftmost matches as the plain patterns.

Defined results: null and empty texts have no spans and the digest of the empty
string. Every row maps to one row, repeated ids and rows included; an empty table
gives no rows, a corpus without candidates only base spans (none). Offsets are code
points, end exclusive. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import Scratch, stored

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "local", "ssn", "iban", "spoken", "person")
LABELERS = ("form", "check", "listed", "sample", "cue", "edges")
BEFORE, BEHIND = 40, 24       # code points of context
ROUNDS = 30                   # of expectation-maximisation
STRENGTH = 8.0                # pseudo-candidates behind the starting vote tables
THRESHOLD = 0.7

# The patterns of the kinds. `\G` and the look-behind let a match begin
# only at the first character of a run, or where the match before it ended.
_TITLES = r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Mlle|Monsieur|Madame|Señor|Señora|Sra)"
_NAME = r"\p{Lu}[\p{Ll}'’-]++"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "local": r"(?<![\p{L}0-9+_=/])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[.-][0-9]{4}(?![\p{L}0-9_-])",
    "ssn": r"(?<![\p{L}0-9._=/-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}0-9_-])",
    "iban": r"(?<![\p{L}0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![\p{L}0-9])",
    "spoken": r"(?<![\p{L}0-9])[a-z0-9][a-z0-9._-]{0,63}+\x20?(?:[\[(]at[\])]|\x20at\x20)\x20?[a-z0-9-]{1,63}+"
              r"\x20?(?:[\[(]dot[\])]|\x20dot\x20)\x20?[a-z]{2,24}+(?![\p{L}0-9])",
    "person": rf"(?<![\p{{L}}0-9]){_TITLES}\.?\x20{_NAME}(?:\x20{_NAME}){{0,2}}+",
}
# What a text must hold for a kind's pattern to be tried.
NEEDS = {"email": ("@",), "phone": ("+",), "spoken": ("dot",),
         "person": ("Mr", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Mlle", "Monsieur", "Madame", "Señor", "Sra")}
_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[0-9]|(?<=0))"

# Gazetteers and cue words.
DOMAINS = ("com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "name", "io", "co", "eu", "de", "fr", "es", "it",
           "uk", "us", "ca", "mx", "br", "ar", "nl", "be", "ch", "at", "se", "no", "fi", "dk", "pl", "pt", "ru", "cn", "jp",
           "kr", "in", "au", "nz", "za")
GIVEN_NAMES = ("james", "john", "robert", "michael", "william", "david", "richard", "thomas", "charles", "daniel", "paul", "mark",
               "mary", "patricia", "linda", "barbara", "elizabeth", "jennifer", "maria", "susan", "anna", "laura", "sarah", "emma",
               "hans", "peter", "klaus", "stefan", "andreas", "julia", "sabine", "monika", "pierre", "jean", "michel", "marie",
               "claire", "sophie", "josé", "juan", "carlos", "luis", "ana", "carmen", "lucía", "pablo")
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[0-9]|6[0245])"
COUNTRY_CODES = r"^(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RESERVED_IPS = r"^(?:0|127|255)\.|^(?:192\.0\.2|198\.51\.100|203\.0\.113)\."
CUES = {
    "email": "mail|correo|contact|kontakt|write to|cc", "ip": r"\bip\b|host|server|address|adresse|dirección|from|client|ping",
    "card": "card|karte|carte|tarjeta|visa|credit", "phone": "tel|phone|call|fax|mobile|handy|móvil|contact|kontakt",
    "local": "tel|phone|call|fax|mobile|handy|móvil|contact|kontakt", "ssn": "ssn|social security",
    "iban": "iban|konto|compte|cuenta|account|bank", "spoken": "mail|correo|contact|kontakt|write", "person": "name|nom|nombre|by|dear",
}
OTHER_CUES = (r"\b(?:version|release|chapter|section|page|order|invoice|isbn|doi|serial|part|model|build|sha|hash|key|token|secret|"
              r"password|passwd)\b[^\p{L}0-9]{0,4}$")


def let(value: Column, then) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), 0)


def _count(text: Column, pattern: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    back = F.split(F.reverse(digits), "")
    doubled = F.transform(back, lambda c, i: F.when(i % 2 == 1, F.element_at(
        F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1)).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number (no spaces) leaves 1, letters as 10 to 35."""
    turned = F.split(F.concat(F.substring(iban, F.lit(5), F.char_length(iban)), F.substring(iban, 1, 4)), "")

    def step(a: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.when(digit, (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), lambda a, c: step(a, c).cast("int")) == 1


def passes(kind: Column, body: Column) -> Column:
    """The check digits or bounds of a kind that has them; a match without is never
    reported, though it votes."""
    n = F.char_length(digits_of(body))
    return (F.when(kind == "ip", body.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
            .when(kind == "card", F.when(n.between(12, 19), luhn(digits_of(body))).otherwise(False))
            .when(kind == "phone", n.between(9, 15))
            .when(kind == "iban", mod97(F.regexp_replace(body, " ", ""))).otherwise(True))


def matches(text: Column) -> Column:
    """An array over the kinds of arrays of (gap, body, before, behind): the code
    points since the last match, the match, and what stands around it."""
    def one(kind: str) -> Column:
        pattern = PATTERNS[kind]
        around = let(F.split(text, pattern, -1), lambda gaps: F.transform(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda body, i: F.struct(
                F.char_length(F.get(gaps, i)).alias("gap"), body.alias("body"), F.right(F.get(gaps, i), F.lit(BEFORE)).alias("before"),
                F.left(F.get(gaps, i + 1), F.lit(BEHIND)).alias("behind"))))
        needs = NEEDS.get(kind)
        may = F.contains(text, F.lit(needs[0])) if needs else text.rlike("[0-9]")
        for word in (needs or ())[1:]:
            may = may | F.contains(text, F.lit(word))
        return F.when(may, around).otherwise(F.array().cast(
            "array<struct<gap:int,body:string,before:string,behind:string>>"))

    return F.array(*[F.struct(F.lit(k).alias("kind"), one(k).alias("found")) for k in KINDS])


def candidates(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per row of ``df``: ``row``, ``keep`` and ``kinds``, the matches of
    the kinds that have any."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    src = df.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("keep"), t.alias("text"))
    return src.select("row", "keep", F.filter(matches(F.col("text")), lambda k: F.size(k.found) > 0).alias("kinds"))


def placed(table: DataFrame) -> DataFrame:
    """(row, kind, start, end, body, before, behind): one row per match."""
    one = (table.select("row", F.explode("kinds").alias("k"))
           .select("row", F.col("k.kind").alias("kind"), F.posexplode("k.found").alias("at", "m"))
           .select("row", "kind", "at", "m.*"))
    along = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.char_length("body")).over(along)
    return (one.withColumn("end", end).withColumn("start", F.col("end") - F.char_length("body"))
            .select("row", "kind", "start", "end", "body", "before", "behind"))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The labelers' votes (1 yes, -1 no, 0 abstain) on a match."""
    kind, body, before, behind = (F.col(c) for c in ("kind", "body", "before", "behind"))
    digits = digits_of(body)
    n = F.char_length(digits)
    never = F.lit(False)

    def by_kind(**cases: Column) -> Column:
        out = F
        for k, v in cases.items():
            out = out.when(kind == k, v)
        return out.otherwise(0)

    domain = F.lower(F.regexp_extract(body, r"([A-Za-z0-9-]+)$", 1))
    form = by_kind(
        email=_vote(domain.rlike("^[a-z]{2,24}$"), body.rlike(r"\.\.|^\.|\.@|@-")),
        ip=_vote(~body.rlike(r"(?:^|\.)0[0-9]"), behind.rlike(r"^\.[0-9]") | before.rlike(r"[0-9]\.$")),
        card=_vote(body.rlike(r"^[0-9]+$|^(?:[0-9]{4}[ -]){3}[0-9]{1,7}$"), n < 12),
        phone=_vote(n.between(10, 15), ~n.between(9, 15)), local=_vote(digits.rlike("^[2-9][0-9]{2}[2-9]"), digits.rlike("^[01]")),
        ssn=_vote(~digits.rlike("^(?:000|666|9)|^...00|0000$"), digits.rlike("^(?:000|666|9)|^...00|0000$")),
        iban=_vote(F.char_length(F.regexp_replace(body, " ", "")) >= 15, never),
        spoken=_vote(body.rlike(r"[\[(]at"), never), person=_vote(body.rlike(r" \S+ \S+"), never))
    check = by_kind(
        ip=_vote(passes(kind, body), ~passes(kind, body)), card=_vote(passes(kind, body), ~passes(kind, body)),
        iban=_vote(passes(kind, body), ~passes(kind, body)),
        phone=_vote(body.rlike(r"^\+[0-9]{1,3}[ (.-]"), body.rlike(r"[(][^)]*$|[ .-]{3}")))
    names = F.split(F.lower(body), r"[ .]+")
    listed = by_kind(
        email=_vote(domain.isin(*DOMAINS), ~domain.isin(*DOMAINS)), card=_vote(digits.rlike(ISSUERS), ~digits.rlike(ISSUERS)),
        phone=_vote(digits.rlike(COUNTRY_CODES), ~digits.rlike(COUNTRY_CODES)),
        spoken=_vote(domain.isin(*DOMAINS), ~domain.isin(*DOMAINS)),
        person=_vote(F.arrays_overlap(names, F.array(*[F.lit(x) for x in GIVEN_NAMES])), never))
    sample = by_kind(
        ip=_vote(never, body.rlike(RESERVED_IPS)), local=_vote(never, digits.rlike("^...55501")),
        ssn=_vote(never, digits.isin("123456789", "078051120", "219099999")),
        card=_vote(never, digits.rlike(r"^(.)\1+$|^1234567")), email=_vote(never, F.lower(body).rlike("^(?:no-?reply|test)@")))
    low = F.lower(before)
    cue = F.lit(0)
    for k, words in CUES.items():
        cue = F.when(kind == k, _vote(low.rlike(words), low.rlike(OTHER_CUES))).otherwise(cue)
    inside = before.rlike(r"[\p{L}0-9_=/\"'@#-]$") | behind.rlike(r"^[\p{L}0-9_=/@-]")
    edges = _vote((before.rlike(r"[\s(]$") | (before == "")) & (behind.rlike(r"^[\s,.;:!?)]") | (behind == "")), inside)
    return dict(zip(LABELERS, (form, check, listed, sample, cue, edges)))


def shapes() -> dict[str, Column]:
    """What the classifier sees of a span beside the votes, in coarse steps."""
    body = F.col("body")
    size = F.char_length(body)
    return {"length": F.least(F.lit(4), F.floor(size / 8)).cast("int"),
            "digits": F.floor(4 * F.char_length(digits_of(body)) / size).cast("int"),
            "breaks": F.least(F.lit(3), _count(body, r"[\s().-]+")).cast("int"),
            "capitals": F.least(F.lit(2), _count(body, r"\p{Lu}+")).cast("int")}


# ------------------------------------------------------------------ EM

#: P(vote | personal), P(vote | not) before any data: labelers beat chance.
START = {-1: (0.1, 0.55), 0: (0.3, 0.3), 1: (0.6, 0.15)}
VOTES = tuple(START)


def cell(k: int, j: int, vote: Column) -> Column:
    """Number of the entry of a vote in the vote tables."""
    return F.lit((k * len(LABELERS) + j) * len(VOTES) + 1) + vote


def cells() -> Column:
    """The entries that a row's votes pick."""
    out = F.array()
    for k, kind in enumerate(KINDS):
        out = F.when(F.col("kind") == kind, F.array(*[cell(k, j, F.col(name)) for j, name in enumerate(LABELERS)])).otherwise(out)
    return out


def fitted(patterns: DataFrame) -> DataFrame:
    """Expectation-maximisation over (kind, votes, n), as one expression over the
    bounded list of patterns: log odds of the kinds and of the vote tables."""
    one = F.lit(1.0)
    rows = patterns.agg(F.collect_list(F.struct(
        (F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1).alias("k"), cells().alias("v"),
        F.col("n").cast("double").alias("n"))).alias("rows"))
    first = [F.array(*[F.lit(STRENGTH * START[v][y]) for v in VOTES]) for y in (0, 1)]
    start = F.struct(F.array(*[F.lit(0.0) for _ in KINDS]).alias("prior"), F.array(*[
        F.lit(math.log(START[v][0] / START[v][1])) for _ in KINDS for _ in LABELERS for v in VOTES]).alias("table"))

    def total(told: Column, keep) -> Column:
        zero = F.struct(F.lit(0.0).alias("yes"), F.lit(0.0).alias("no"))
        return F.aggregate(F.filter(told, keep), zero, lambda s, x: F.struct((s.yes + x.yes).alias("yes"), (s.no + x.no).alias("no")))

    def step(state: Column, _: Column) -> Column:
        def told(x: Column) -> Column:
            odds = F.aggregate(x.v, F.get(state.prior, x.k), lambda s, c: s + F.get(state.table, c))
            p = one / (one + F.exp(-odds))
            return F.struct(x.k.alias("k"), x.v.alias("v"), (x.n * p).alias("yes"), (x.n * (one - p)).alias("no"))

        def refit(t: Column) -> Column:
            def entry(c: Column) -> Column:
                kind = F.get(t.kinds, F.floor(c / (len(LABELERS) * len(VOTES))).cast("int"))
                seen, vote = total(t.told, lambda x: F.array_contains(x.v, c)), F.pmod(c, F.lit(len(VOTES)))
                return F.log((seen.yes + F.get(first[0], vote)) / (kind.yes + STRENGTH)) \
                    - F.log((seen.no + F.get(first[1], vote)) / (kind.no + STRENGTH))

            prior = F.transform(t.kinds, lambda k: F.log((k.yes + STRENGTH / 2) / (k.no + STRENGTH / 2)))
            every = F.sequence(F.lit(0), F.lit(len(KINDS) * len(LABELERS) * len(VOTES) - 1))
            return F.struct(prior.alias("prior"), F.transform(every, entry).alias("table"))

        return let(F.transform(F.col("rows"), told), lambda rows: let(F.struct(
            rows.alias("told"), F.transform(F.sequence(F.lit(0), F.lit(len(KINDS) - 1)), lambda k: total(
                rows, lambda x: x.k == k)).alias("kinds")), refit))

    return rows.select(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step).alias("state")).select("state.*")


def estimate(patterns: DataFrame) -> Column:
    """The posterior of a row (kind, votes): literals of a model of bounded size."""
    state = fitted(patterns).first()
    odds = F.get(F.array(*[F.lit(x) for x in state.prior]), F.array_position(
        F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1)
    table = F.array(*[F.lit(x) for x in state.table])
    return 1 / (1 + F.exp(-F.aggregate(cells(), odds, lambda s, c: s + F.get(table, c))))


# ------------------------------------------------------------------ classifier

def features() -> list[Column]:
    """0/1 features: kinds, votes, steps of the shapes."""
    def is_(c: Column) -> Column:
        return c.cast("int").cast("double")

    out = [is_(F.col("kind") == k) for k in KINDS]
    out += [is_(F.col(j) == v) for j in LABELERS for v in (1, -1)]
    steps = {"length": 4, "digits": 4, "breaks": 3, "capitals": 2}
    return out + [is_(F.col(c) >= i) for c, n in steps.items() for i in range(1, n + 1)]


def classifier(vectors: DataFrame, soft: Column) -> Column:
    """Logistic regression of the posteriors over (kind, votes, shapes, n): the
    score as an expression."""
    rows = vectors.withColumn("p", soft).select(array_to_vector(F.array(*features())).alias("features"), F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("p")).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("p"))).alias("weight")))).alias("y"))
    model = LogisticRegression(weightCol="weight", regParam=1e-3, standardization=False, maxIter=40).fit(
        rows.select("features", "y.label", "y.weight").where("weight > 0"))
    odds = F.lit(float(model.intercept))
    for f, w in zip(features(), model.coefficients.toArray().tolist()):
        odds = odds + f * F.lit(w)
    return 1 / (1 + F.exp(-odds))


SPANS = "array<struct<start:bigint,rank:int,end:bigint,kind:string,score:double>>"


def find_personal(df: DataFrame, text: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns, ``base`` and ``added``: the spans of base kinds and those
    that the classifier adds, each by start, then kind as listed, with its score."""
    with Scratch() as scratch:
        table = scratch.keep(stored(candidates(df, text, keep or []), "pii-matches"))
        kind, body = F.col("kind"), F.col("body")
        rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind).cast("int")
        judged = stored(placed(table).withColumns(votes()).withColumns(shapes())
                        .select("row", "kind", "start", "end", rank.alias("rank"),
                                passes(kind, body).alias("passes"), kind.isin(*BASE_KINDS).alias("base"), *LABELERS, *shapes()), "pii-votes")
        vectors = stored(judged.groupBy("kind", *LABELERS, *shapes()).agg(F.count(F.lit(1)).alias("n")), "pii-vectors")
        patterns = stored(vectors.groupBy("kind", *LABELERS).agg(F.sum("n").alias("n")), "pii-patterns")
        score = F.lit(0.0) if patterns.isEmpty() else classifier(vectors, estimate(patterns))
        span = F.struct("start", "rank", "end", "kind", "score")
        scored = judged.withColumn("score", score).where(F.col("passes") & (F.col("base") | (F.col("score") >= threshold)))
        spans = scratch.keep(stored(scored.groupBy("row").agg(
            F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"),
            F.sort_array(F.collect_list(F.when(~F.col("base"), span))).alias("added")), "pii-spans"))
    none = F.array().cast(SPANS)
    base, added = F.coalesce("base", none), F.coalesce("added", none)
    clear = F.filter(added, lambda a: ~F.exists(base, lambda b: (b.start < a.end) & (a.start < b.end)))
    return (table.join(spans, "row", "left")
            .select(*[F.col(f"keep.`{c}`").alias(c) for c in keep or []], base.alias("base"), clear.alias("added")))
