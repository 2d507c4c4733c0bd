"""Personal data by weak supervision, in DataFrame operations only.

Base kinds come from fixed patterns and always stay. Secrets (mixed letter-digit tokens) and names of
persons (capitalised words in a row) are candidates on which labelers vote for or against, or abstain:
by pattern, gazetteer, context and, for persons, function words. An abstention says nothing of the
class. For each kind expectation maximisation over the counts of vote patterns estimates how often each
labeler votes for a candidate of either class; the posteriors train a naive Bayes classifier over votes,
size and surroundings of a span, which alone decides. Labelers see the 24 code points around a candidate.
Defined results: null text is empty and has no spans; offsets are code points, end exclusive; a row of
docs is a row of the result, so repeated rows and a null doc_id stay, and count as often in the
estimates; an empty table gives no rows; spans of the added kinds that overlap a base span are left out;
a text of any length is read whole, in time in proportion to it but for a binary search per candidate;
other columns are left out, whatever their names.
"""
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns with possessive repeats, started only where a run begins or the last match
# ended: the same matches, without backtracking over long runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without them is not searched.
MARKS = {"email": "@", "ip": ".", "phone": "+"}
SECRET = r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])(?=[0-9]*+[A-Za-z])[A-Za-z0-9]{12,}+"
PERSON = r"\p{Lu}(?<![\p{L}\p{N}].)\p{Ll}{1,20}+(?:[ ]\p{Lu}(?:\p{Ll}{1,20}+|\.)){1,3}+(?![\p{L}\p{N}])"
#: Words before a secret, and before a code that is none.
GAZETTEER = r"(?i)(password|passwd|passphrase|pwd|secret|token|key|credentials?|auth|bearer|contraseña|passwort|kennwort|clave)[^A-Za-z0-9]{0,4}$"
HARMLESS = r"(?i)(commit|sha-?[0-9]*|md5|hash|checksum|digest|revision|uuid|guid|isbn|version|build|serial|model|order|article)[^A-Za-z0-9]{0,4}$"
FORMATS = "^((?i:[0-9a-f]{16,})|AKIA[0-9A-Z]{12,}|gh[pousr][A-Za-z0-9]{30,}|sk[A-Za-z0-9]{30,})$"
#: Given names of several languages (the default of a parameter of find_pii), words that no name holds, words that open sentences.
GIVEN = """James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Mark Donald Steven Paul Andrew Joshua Kenneth Kevin Brian George Edward Ronald
Timothy Jason Jeffrey Ryan Jacob Gary Nicholas Eric Jonathan Stephen Larry Scott Frank Raymond Samuel Patrick Alexander Jack Dennis Henry Peter Mary Patricia Jennifer Linda Elizabeth Barbara
Susan Jessica Sarah Karen Lisa Nancy Betty Margaret Sandra Ashley Emily Donna Michelle Carol Amanda Melissa Deborah Stephanie Rebecca Laura Sharon Cynthia Kathleen Amy Angela Anna Emma Helen
José Juan Antonio Manuel Francisco Carlos Luis Javier Miguel Pedro Alejandro Pablo Diego María Carmen Ana Isabel Lucía Elena Rosa Pilar Jean Pierre Michel André Philippe Jacques Louis François
Marie Jeanne Françoise Monique Sophie Catherine Nathalie Isabelle Camille Claire Hans Karl Heinz Klaus Jürgen Wolfgang Stefan Andreas Matthias Dieter Ursula Monika Petra Sabine Renate Ingrid
Katharina Wei Ming Hiroshi Yuki Kenji Ahmed Mohammed Omar Fatima Aisha Priya Rahul Sanjay Olga Ivan Dmitri Natalia Sergei Giovanni Marco Giulia Francesca João Paulo""".split()
NO_NAME = """License Licence Public General Version Software Copyright Foundation Apache Creative Commons Attribution University College School Institute Department Ministry Company Corporation Inc Ltd Limited
Group Bank Street Road Avenue Park River Lake Mountain City County State States United Kingdom Republic North South East West New Northern Southern Eastern Western January February March April
May June July August September October November December Monday Tuesday Wednesday Thursday Friday Saturday Sunday World International National Open Source Data Privacy Policy Terms Service Services
Internet Web Home Page Table Figure Chapter Section Article Part Volume Supreme Court High House White""".split()
OPENERS = """The This That These Those A An And Or But For Of On In To By As At Is Are Was Were From With Not All Some Any When Where What Who How If It We You They He She Our Your Their His Her
El La Los Las Un Una De Del Y En Que Por Con Para Su Se Es Le Les Des Du Une Et Est Dans Pour Par Sur Qui Der Die Das Den Dem Ein Eine Und Oder Ist Von Zu Mit Im Am Für Auf Nicht""".split()
TITLE = r"(?:\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Sr|Sra|Mme|Monsieur|Madame|Señor|Señora)\.?|\b(?i:my name is|name|signed|author|contact|patient|dear|by|from)[:,]?)\s{0,2}$"
ARTICLE = r"(?i)\b(?:the|a|an|gnu|der|die|das|le|la|les|el|los|las|un|una|une|ein|eine)\s{1,2}$"
SPEECH = r"^,?\s(?i:said|says|told|wrote|writes|asked|lives|works|born|was born|called|dijo|sagte|a dit)\b"
ENTRY = "struct<start:long,end:long,value:string,before:string,after:string>"
#: Entries of a text are counted in stretches of so many.
STRETCH = 128


def matches(text, pattern, mark: str = ""):
    """array<struct<start, end, value, before, after>> of the pattern's matches, in order; each of them holds the mark.

    Starts are running sums: first over each stretch of entries, then over the stretches, so that the
    lists built on the way stay short however many matches a text has.
    """
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pair = lambda v: F.arrays_zip(v.alias("v"), F.slice(gaps, F.lit(1), F.size(v)).alias("g"), F.slice(gaps, F.lit(2), F.size(v)).alias("h"))
    zero = lambda kind: F.struct(F.lit(0).cast("long").alias("p"), F.array().cast(f"array<{kind}>").alias("s"))

    def add(acc, stretch):
        size = F.aggregate(stretch, F.lit(0).cast("long"), lambda n, x: n + F.length(x["g"]) + F.length(x["v"]))
        return F.struct((acc["p"] + size).alias("p"), F.concat(acc["s"], F.array(F.struct(acc["p"].alias("at"), stretch.alias("x")))).alias("s"))

    def step(acc, x):
        start = acc["p"] + F.length(x["g"])
        end = start + F.length(x["v"])
        one = F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), x["v"].alias("value"), F.right(x["g"], F.lit(24)).alias("before"), F.left(x["h"], F.lit(24)).alias("after"))
        return F.struct(end.cast("long").alias("p"), F.concat(acc["s"], F.array(one)).alias("s"))

    # arrays of one element, so that each is computed once
    cut = lambda p: F.transform(F.sequence(F.lit(1), F.size(p), F.lit(STRETCH)), lambda i: F.slice(p, i, F.lit(STRETCH)))
    cut = F.transform(F.transform(F.array(found), pair), cut)[0]
    placed = F.aggregate(cut, zero("struct<at:long,x:array<struct<v:string,g:string,h:string>>>"), add, lambda a: a["s"])
    one = lambda c: F.aggregate(c["x"], F.struct(c["at"].alias("p"), F.array().cast(f"array<{ENTRY}>").alias("s")), step, lambda a: a["s"])
    return F.when(text.contains(mark) & text.rlike(pattern), F.flatten(F.transform(placed, one))).otherwise(F.array().cast(f"array<{ENTRY}>"))


def _digits(v):
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(v):
    d = F.reverse(_digits(v))
    one = lambda i: F.substring(d, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda a, i: a + one(i) - F.when(one(i) > 9, 9).otherwise(0)) % 10 == 0


VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(F.split(v, r"\."), lambda p: p.cast("double") <= 255),
    "card": lambda v: F.length(_digits(v)).between(16, 19) & luhn(v),
    "phone": lambda v: F.length(_digits(v)).between(8, 15),
}


def em(patterns: dict, rounds: int = 60, most: float = 0.4):
    """{votes: count} -> (prior, P(for | votes, sought), P(for | votes, other)) of a two-class latent model.

    Votes are 1 (for), -1 (against) and 0 (abstains). The estimates start from ten imagined votes of each
    class, eight of them right, and keep to their side of a half, so the classes cannot change places
    where all candidates have one vote pattern. The prior stays within 0.02 and `most`.
    """
    n = sum(patterns.values())
    k = len(next(iter(patterns)))
    prior, yes, no = 0.3, [0.8] * k, [0.2] * k
    for _ in range(rounds):
        post = {v: posterior(v, prior, yes, no) for v in patterns}
        prior = min(most, max(0.02, (1 + sum(post[v] * c for v, c in patterns.items())) / (4 + n)))
        share = lambda i, p, base: (base + sum(p(v) * c for v, c in patterns.items() if v[i] > 0)) / (10 + sum(p(v) * c for v, c in patterns.items() if v[i]))
        yes = [min(0.999, max(0.55, share(i, post.get, 8))) for i in range(k)]
        no = [max(0.001, min(0.45, share(i, lambda v: 1 - post[v], 2))) for i in range(k)]
    return prior, yes, no


def posterior(v, prior, yes, no):
    a, b = prior, 1 - prior
    for x, p, q in zip(v, yes, no):
        if x:
            a, b = a * (p if x > 0 else 1 - p), b * (q if x > 0 else 1 - q)
    return a / (a + b)


def base_spans(kind):
    """Spans of a base kind in column text."""
    good = F.filter(matches(F.col("text"), PATTERNS[kind], MARKS.get(kind, "")), lambda m: VALID[kind](m["value"]))
    return F.transform(good, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")))


def _vote(yes, no):
    """1, -1 or 0: for, against, abstains; for and against at once is an abstention."""
    return F.coalesce(yes, F.lit(False)).cast("int") - F.coalesce(no, F.lit(False)).cast("int")


def _any_of(words, end: bool = True):
    """Pattern: one of the words stands in the value, or with end=False, opens it."""
    return ("(?:^| )" if end else "^") + "(?:" + "|".join(words) + ")(?:$| )"


def _secret_votes(v, before, after, given):
    kinds = F.size(F.array_distinct(F.split(F.lower(F.left(v, F.lit(4096))), "")))
    turns = F.regexp_count(F.left(v, F.lit(4096)), F.lit("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]"))
    return [
        _vote(v.rlike(FORMATS), v.rlike("^[A-Za-z]++[0-9]{1,4}$")),
        _vote(before.rlike(GAZETTEER), before.rlike(HARMLESS)),
        _vote(before.rlike(r'[=:]\s*["\x27]?$'), before.rlike(r"[/\\.@_-]$") | after.rlike("^[/@_-]|^[.][A-Za-z]")),
        _vote((kinds >= 8) & (turns >= 3), (kinds <= 5) | (turns == 1)),
    ]


def _person_votes(v, before, after, given):
    return [
        _vote(v.rlike(r"^\p{L}{2,}+(?: \p{Lu}\.)+ \p{L}{2,}+$"), v.rlike(r"(?:^| )(\p{L}++) \1(?: |$)|(?:^| )\p{L}{1,2}(?: |$)")),
        _vote(F.split_part(v, F.lit(" "), F.lit(1)).isin(*given), v.rlike(_any_of(NO_NAME))),
        _vote(before.rlike(TITLE) | after.rlike(SPEECH), before.rlike(ARTICLE)),
        _vote(F.lit(False), v.rlike(_any_of(OPENERS, end=False))),
    ]


#: Kinds the labelers add: pattern of candidates, their votes (pattern, gazetteer, context; shape or function words) and
#: size classes of a candidate.
ADDED = {
    "secret": (SECRET, _secret_votes, lambda v: F.least(F.lit(3), (F.length(v) / 12).cast("int"))),
    "person": (PERSON, _person_votes, lambda v: F.least(F.lit(3), F.size(F.split(v, " ")) - 1)),
}
SPANS = "array<struct<kind:string,start:long,end:long,value:string>>"


def _surroundings(before, after):
    """Class of what stands before (line start, word, opening mark, other) and after (line end, lower-case word, mark, other): 0 to 15."""
    b = F.when((before == "") | before.rlike(r"\n$"), 0).when(before.rlike(r"[\p{L}\p{N}]\s*$"), 1).when(before.rlike(r"[=:\x22\x27(<\[]\s*$"), 2).otherwise(3)
    a = F.when((after == "") | after.rlike(r"^\n"), 0).when(after.rlike(r"^\s+\p{Ll}"), 1).when(after.rlike(r"^[\p{P}\p{S}]"), 2).otherwise(3)
    return b * 4 + a


def classifier(seen) -> tuple | None:
    """rows(votes, size, place, count) of candidates -> (log prior odds, log ratios of a vote for and against by labeler, of each size, of each place).

    Expectation maximisation over the votes gives posteriors; a naive Bayes classifier over votes, size
    class and surroundings is trained on them. Shares of sizes and places of a class are drawn towards
    those of all candidates by eight imagined ones, so they say little where a class is small.
    """
    if not seen:
        return None
    by = {}
    for votes, _, _, n in seen:
        by[tuple(votes)] = by.get(tuple(votes), 0) + n
    prior, yes, no = em(by)

    def ratios(col, values):
        pooled, soft = [0.0] * values, [[0.0, 0.0] for _ in range(values)]
        for row in seen:
            post, n, k = posterior(row[0], prior, yes, no), row[3], row[col]
            pooled[k] += n
            soft[k][0] += post * n
            soft[k][1] += (1 - post) * n
        n = sum(pooled)
        s, o = sum(x[0] for x in soft), sum(x[1] for x in soft)
        return [math.log(((x[0] + 8 * p / n) / (s + 8)) / ((x[1] + 8 * p / n) / (o + 8))) if p else 0.0 for x, p in zip(soft, pooled)]

    return math.log(prior / (1 - prior)), [(math.log(p / q), math.log((1 - p) / (1 - q))) for p, q in zip(yes, no)], ratios(1, 4), ratios(2, 16)


def log_odds(c, fitted):
    """Column: log odds of a candidate struct, by what classifier() gives."""
    w0, wv, *more = fitted
    odds = F.lit(w0)
    for i, (p, q) in enumerate(wv):
        odds = odds + F.when(c["votes"][i] > 0, p).when(c["votes"][i] < 0, q).otherwise(0.0)
    for name, w in zip(("size", "place"), more):
        odds = odds + F.element_at(F.array(*map(F.lit, w)), c[name] + 1)
    return odds


def overlaps(spans, c):
    """Whether a span of a sorted array of spans without overlaps meets c: binary search for the last one that starts before c ends."""

    def halve(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"] + 1) / 2).cast("int")
        below = F.coalesce(F.get(spans, mid - 1)["start"] < c["end"], F.lit(False))
        return F.struct(F.when(below, mid).otherwise(acc["lo"]).alias("lo"), F.when(below, acc["hi"]).otherwise(mid - 1).alias("hi"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))
    at = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi")), halve, lambda a: a["lo"])
    return (F.size(spans) > 0) & F.coalesce(F.get(spans, at - 1)["end"] > c["start"], F.lit(False))


def added_spans(kind: str, fitted):
    """Column: the candidates of a kind that its classifier takes and no base span overlaps."""
    if fitted is None:
        return F.array().cast(SPANS)

    def taken(c):
        free = F.lit(True)
        for k in KINDS:
            free = free & ~overlaps(F.col(k), c)
        return (log_odds(c, fitted) > 0) & free

    return F.transform(F.filter(f"{kind}?", taken), lambda c: F.struct(F.lit(kind).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["value"].alias("value")))


def find_pii(docs: DataFrame, given: list = GIVEN) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, and an array<struct<kind, start, end, value>> for each base and added kind).

    given: the gazetteer of given names.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    def judged(kind):
        pattern, votes, size = ADDED[kind]
        one = lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"), F.array(*votes(m["value"], m["before"], m["after"], given)).alias("votes"), size(m["value"]).alias("size"), _surroundings(m["before"], m["after"]).alias("place"))
        return F.transform(matches(F.col("text"), pattern), one)

    base = docs.select("doc_id", text.alias("text")).select("doc_id", *[base_spans(k).alias(k) for k in KINDS], *[judged(k).alias(f"{k}?") for k in ADDED])
    base = materialise(base)
    out = {}
    for kind in ADDED:
        seen = base.select(F.explode(f"{kind}?").alias("c")).groupBy("c.votes", "c.size", "c.place").count().collect()  # at most 81 x 64 rows
        out[kind] = added_spans(kind, classifier([tuple(r) for r in seen]))
    return base.select("doc_id", *KINDS, *[x.alias(kind) for kind, x in out.items()])


def span_text(*arrays):
    return F.array_join(F.transform(F.concat(*arrays), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
