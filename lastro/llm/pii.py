"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs them, and a
span classifier trained on the result decides.

Strict patterns give spans that always stay.  Looser patterns (addresses written with "at" and "dot", phone
numbers without country code, card numbers with a wrong check digit, IPv6) only propose.  Four labelers vote on
both sorts: the strict pattern, gazetteers (top-level domains, card issuers, dialling codes, reserved networks), the
words before the span, and its shape.  The classifier learns from what the labelers make of a span together, and sees
more than they do: its length, its share of digits, what stands before it.  All votes are SQL expressions; equal
patterns are counted, and only these counts (at most a few thousand rows, by construction) reach the driver, where
reliabilities and the classifier are fitted.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.llm.text import text_of
from lastro.session import stored

# Patterns are possessive where nothing could be given back: the engine then runs repeated groups in a loop and
# not by recursion, which very long matches would exhaust, and looks at no run of characters twice.
#: In the order in which spans that begin together are listed.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]+(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20|\.)\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}[\x20-]?[0-9]{4,6}[\x20-]?[0-9]{4,5}(?:[\x20-]?[0-9]{1,4})?(?![0-9])",
    "phone": r"(?<![0-9.])\(?[0-9]{2,4}\)?[\x20/-][0-9]{3,4}[\x20-][0-9]{3,4}(?![0-9.])",
}
#: Texts without these have no match of the kind; the test is cheaper than the pattern.
GATES = {"email": "contains(_t, '@')", "ip": "_digits", "card": "_digits", "phone": "contains(_t, '+')"}
LOOSE_GATES = {"email": r"rlike(_t, r'[\(\[\x20]at[\)\]\x20]')", "ip": "contains(_t, ':')", "card": "_digits", "phone": "_digits"}

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DIGITS = "regexp_replace({x}, '[^0-9]', '')"
_LUHN = (
    "aggregate(sequence(1, length({d})), 0, (s, i) -> s + CASE WHEN i % 2 = 1 THEN int(substring({d}, -i, 1))"
    " WHEN substring({d}, -i, 1) >= '5' THEN 2 * int(substring({d}, -i, 1)) - 9 ELSE 2 * int(substring({d}, -i, 1)) END) % 10 = 0"
)
VALID = {
    "email": "true",
    "ip": rf"rlike({{x}}, r'^{_OCTET}(\.{_OCTET}){{{{3}}}}$')",
    "card": f"CASE WHEN length({_DIGITS}) BETWEEN 12 AND 19 THEN {_LUHN.format(d=_DIGITS)} ELSE false END",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
}
# Gazetteers and words that speak for or against a span.
DOMAINS = "com|net|org|edu|gov|info|biz|io|co|eu|de|fr|es|it|uk|us|ca|nl|ch|at|be|pt|br|mx|ar|au|jp|in"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65|35|30[0-5]|36|38"
DIALLING = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[0-9]|35[0-9]|37[0-9]|38[0-9]|42[013]"
RESERVED = r"0\.|127\.|255\.|22[4-9]\.|2[3-5][0-9]\."
CUES = {
    "email": "mail|contact|write|schreib|courriel|correo|kontakt",
    "ip": "ip|host|server|address|adresse|login|from|client",
    "card": "card|karte|carte|tarjeta|visa|master|amex|credit|payment",
    "phone": "phone|tel|call|fax|mobile|cell|handy|ruf|contact",
}
AGAINST = "version|release|chapter|section|isbn|issn|order|invoice|serial|article|page|ratio|score|token|hash|id"
VOTES = ("regex", "gazetteer", "context", "shape")


#: Matches that are listed at a time; a list is copied for each one added to it.
CHUNK = 256
_SPAN = "struct<s: int, e: int, k: int, x: string, b: string>"


def _spans(gate: str, pattern: str, kind: str, valid: str) -> str:
    """All matches as structs of kind, code-point start and end, text and the 24 characters before; matches and the
    pieces between them both come from the regex engine's left-to-right search, their lengths add up to the places.

    The work is linear in the text: matches are listed in chunks, and what stands before one is carried along.
    """
    place = KINDS.index(kind)
    matches = f"regexp_extract_all(_t, r'{pattern}', 0)"
    pieces = f"zip_with({matches}, slice(split(_t, r'{pattern}'), 1, size({matches})), (x, g) -> named_struct('x', x, 'g', g))"
    chunks = f"transform(array({pieces}), z -> transform(sequence(0, size(z) div {CHUNK}), i -> slice(z, int(i) * {CHUNK} + 1, {CHUNK})))[0]"
    span = (
        f"named_struct('s', a.at + length(z.g), 'e', a.at + length(z.g) + length(z.x), 'k', {place}, 'x', z.x,"
        " 'b', right(concat(a.tail, z.g), 24))"
    )
    within = (
        f"aggregate(part, named_struct('at', whole.at, 'tail', whole.tail, 'out', cast(array() AS array<{_SPAN}>)),"
        " (a, z) -> named_struct('at', a.at + length(z.g) + length(z.x), 'tail', right(concat(a.tail, z.g, z.x), 24), 'out',"
        f" CASE WHEN {valid.format(x='z.x')} THEN array_append(a.out, {span}) ELSE a.out END))"
    )
    return (
        f"CASE WHEN {gate} THEN aggregate({chunks},"
        f" named_struct('at', 0, 'tail', '', 'out', cast(array() AS array<array<{_SPAN}>>)),"
        f" (whole, part) -> aggregate(array({within}), whole, (w, r) ->"
        " named_struct('at', r.at, 'tail', r.tail, 'out', array_append(w.out, r.out))),"
        f" whole -> flatten(whole.out)) ELSE cast(array() AS array<{_SPAN}>) END"
    )


def _overlaps(base: str) -> str:
    """Whether a span ``c`` overlaps one of a sorted list of disjoint spans, by binary search."""
    middle = "int((p.lo + p.hi) div 2)"
    earlier = (
        f"aggregate(sequence(0, 1 + int(log2(size({base}) + 1))), named_struct('lo', 0, 'hi', size({base})),"
        f" (p, i) -> CASE WHEN p.lo >= p.hi THEN p WHEN get({base}, {middle}).s < c.e"
        f" THEN named_struct('lo', {middle} + 1, 'hi', p.hi) ELSE named_struct('lo', p.lo, 'hi', {middle}) END, p -> p.lo)"
    )
    return f"coalesce(get({base}, {earlier} - 1).e > c.s, false)"


#: What the classifier sees of a span besides the votes, with the number of values of each.
SIGHTS = {"length": 4, "digits": 4, "before": 4}


def _sights() -> str:
    """Length, share of digits in thirds, and what stands before a span ``c``: nothing, a letter, white space, else."""
    return (
        "named_struct('length', CASE WHEN length(c.x) < 12 THEN 0 WHEN length(c.x) < 18 THEN 1 WHEN length(c.x) < 30 THEN 2 ELSE 3 END,"
        f" 'digits', int(3 * length({_DIGITS.format(x='c.x')}) div length(c.x)),"
        " 'before', CASE WHEN c.b = '' THEN 0 WHEN rlike(c.b, r'[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]$') THEN 1 WHEN rlike(c.b, r'[\\x20\\x09-\\x0D]$') THEN 2 ELSE 3 END)"
    )


def _votes(strict: bool) -> str:
    """A struct of votes for a span ``c``: 1 for, 0 against, -1 no opinion."""
    before = "lower(c.b)"
    by_kind = lambda parts: "CASE c.k " + " ".join(f"WHEN {i} THEN {parts[k]}" for i, k in enumerate(KINDS)) + " END"
    digits = _DIGITS.format(x="c.x")
    gazetteer = by_kind({
        "email": rf"rlike(lower(c.x), r'(\.|dot[\x20\)\]]*)({DOMAINS})$')",
        "ip": rf"NOT rlike(c.x, r'^({RESERVED})')",
        "card": f"rlike({digits}, r'^({ISSUERS})')",
        "phone": rf"rlike(c.x, r'^\+({DIALLING})')",
    })
    shape = by_kind({
        "email": r"rlike(c.x, r'^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}[\x20@\(\[]')",
        "ip": r"rlike(c.x, r'^((0|[1-9][0-9]*)(\.|$)){4}$')",
        "card": rf"rlike(c.x, r'^([0-9]{{12,19}}|[0-9]{{4}}([\x20-][0-9]{{4}}){{3}}|[0-9]{{4}}[\x20-][0-9]{{6}}[\x20-][0-9]{{5}})$')",
        "phone": r"rlike(c.x, r'[\x20()-]')",
    })
    cue = by_kind({k: f"rlike({before}, r'\\b({CUES[k]})')" for k in KINDS})
    against = f"rlike({before}, r'\\b({AGAINST})\\b')"
    return (
        f"named_struct('regex', {int(strict)}, 'gazetteer', int({gazetteer}), 'context',"
        f" CASE WHEN {cue} THEN 1 WHEN {against} THEN 0 ELSE -1 END, 'shape', int({shape}))"
    )


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``base`` and ``loose``, arrays of spans (``s``, ``e``, ``k``) with votes ``v`` and
    sights ``f``."""
    held = docs.select(docs[id_column].alias("id"), text_of(docs[text_column]).alias("_t"))
    held = held.withColumn("_digits", F.expr("rlike(_t, '[0-9]')"))
    for kind in KINDS:
        held = held.withColumn(f"_b_{kind}", F.expr(_spans(GATES[kind], BASE[kind], kind, VALID[kind])))
        held = held.withColumn(f"_l_{kind}", F.expr(_spans(LOOSE_GATES[kind], LOOSE[kind], kind, "true")))
    held = held.withColumn("_base", F.expr(f"concat({', '.join(f'_b_{k}' for k in KINDS)})"))
    taken = " OR ".join(_overlaps(f"_b_{k}") for k in KINDS)
    held = held.withColumn("_loose", F.expr(f"filter(concat({', '.join(f'_l_{k}' for k in KINDS)}), c -> NOT ({taken}))"))
    voted = f"transform({{of}}, c -> named_struct('s', c.s, 'e', c.e, 'k', c.k, 'v', {{votes}}, 'f', {_sights()}))"
    return held.select(
        "id", F.expr(voted.format(of="_base", votes=_votes(True))).alias("base"),
        F.expr(voted.format(of="_loose", votes=_votes(False))).alias("loose"),
    )


def reliabilities(counts: list[tuple[int, tuple[int, ...], int]], rounds: int = 50) -> list[float]:
    """Posterior of being personal data for each (kind, votes, number), by expectation-maximisation.

    Each labeler has a rate of speaking for a true and for a false span, apart for each kind; abstentions count
    for nothing.  Pseudo-counts (40 to 10 for the better answer) keep labelers with few votes near sound.
    """
    strength, good = 50.0, 0.8
    posterior = [min(max(sum(v == 1 for v in votes) / max(sum(v >= 0 for v in votes), 1), 0.05), 0.95) for _, votes, _ in counts]
    for _ in range(rounds):
        prior, rate = {}, {}
        for kind in range(len(KINDS)):
            own = [(votes, n, p) for (k, votes, n), p in zip(counts, posterior) if k == kind]
            total = sum(n for _, n, _ in own)
            prior[kind] = (sum(n * p for _, n, p in own) + 1) / (total + 2)
            for j in range(len(VOTES)):
                said = [(votes[j], n, p) for votes, n, p in own if votes[j] >= 0]
                true, false = sum(n * p for _, n, p in said), sum(n * (1 - p) for _, n, p in said)
                rate[kind, j] = (
                    (sum(n * p for v, n, p in said if v) + strength * good) / (true + strength),
                    (sum(n * (1 - p) for v, n, p in said if v) + strength * (1 - good)) / (false + strength),
                )
        for i, (kind, votes, _) in enumerate(counts):
            odds = math.log(prior[kind] / (1 - prior[kind]))
            for j, vote in enumerate(votes):
                if vote >= 0:
                    a, b = rate[kind, j]
                    odds += math.log(a / b) if vote else math.log((1 - a) / (1 - b))
            posterior[i] = 1 / (1 + math.exp(-min(max(odds, -30), 30)))
    return posterior


def features(kind: int, votes: tuple[int, ...], seen: tuple[int, ...]) -> list[float]:
    """One for each kind, then for and against for each labeler, then one for each value of each sight."""
    own = [float(value == v) for value, n in zip(seen, SIGHTS.values()) for v in range(n)]
    return [float(kind == k) for k in range(len(KINDS))] + [float(v == s) for v in votes for s in (1, 0)] + own


Pattern = tuple[int, tuple[int, ...], tuple[int, ...], int]


def train(patterns: list[Pattern], posterior: list[float]) -> list[float]:
    """Logistic regression on the posteriors (weight decay 1), by Newton steps on the counted patterns."""
    size = len(KINDS) + 2 * len(VOTES) + sum(SIGHTS.values())
    if not patterns:
        return [-1.0] * len(KINDS) + [0.0] * (size - len(KINDS))
    x = np.array([features(k, v, f) for k, v, f, _ in patterns])
    n, y, w = np.array([float(c) for *_, c in patterns]), np.array(posterior), np.zeros(size)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(size)
        w = w - np.linalg.solve(curve, slope)
    return w.tolist()


def fit(patterns: list[Pattern]) -> list[float]:
    """Weights of the classifier: reliabilities from the votes, the classifier from votes and sights."""
    counts: dict[tuple[int, tuple[int, ...]], int] = {}
    for kind, votes, _, n in patterns:
        counts[kind, votes] = counts.get((kind, votes), 0) + n
    voted = [(k, v, n) for (k, v), n in counts.items()]
    posterior = dict(zip(counts, reliabilities(voted)))
    return train(patterns, [posterior[k, v] for k, v, *_ in patterns])


def _decides(weights: list[float]) -> str:
    """SQL of the classifier for a span ``c``: true where it takes it for personal data."""
    parts = [f"CASE c.k {' '.join(f'WHEN {i} THEN {w!r}D' for i, w in enumerate(weights[: len(KINDS)]))} END"]
    rest = iter(weights[len(KINDS):])
    for name in VOTES:
        yes, no = next(rest), next(rest)
        parts.append(f"CASE c.v.{name} WHEN 1 THEN {yes!r}D WHEN 0 THEN {no!r}D ELSE 0D END")
    for name, n in SIGHTS.items():
        parts.append(f"CASE c.f.{name} {' '.join(f'WHEN {v} THEN {next(rest)!r}D' for v in range(n))} END")
    return " + ".join(parts) + " >= 0"


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, ``base`` and ``spans``, arrays of structs (``s``, ``k``, ``e``) in order.

    ``base`` holds the valid matches of the strict patterns, ``spans`` these and what the classifier adds; added
    spans never overlap base ones.  Null and empty texts have none.  Null ids and repeated rows get a row each; an
    empty table gives no rows.  Other columns are ignored.
    """
    found = stored(candidates(docs, id_column, text_column), "pii-candidates")
    votes = found.select(F.explode(F.concat("base", "loose")).alias("c")).groupBy("c.k", "c.v", "c.f").count()
    weights = fit(sorted((r["k"], tuple(r["v"]), tuple(r["f"]), r["count"]) for r in votes.collect()))
    order = "sort_array(transform({of}, c -> named_struct('s', c.s, 'k', c.k, 'e', c.e)))"
    added = f"filter(loose, c -> {_decides(weights)})"
    return found.select(
        F.col("id").alias(id_column), F.expr(order.format(of="base")).alias("base"),
        F.expr(order.format(of=f"concat(base, {added})")).alias("spans"),
    )


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda c: F.concat_ws(":", names[c["k"]], c["s"].cast("string"), c["e"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
