"""Personal data by weak supervision, with DataFrame functions only.

Patterns propose spans: the base rules (whose valid matches always stay) and looser forms. Six labelers
vote on every proposed span for, against or not at all: the rule itself, the form, a checksum or range,
a gazetteer, words in front, and the neighbouring characters. Expectation-maximisation estimates per
kind how reliable each labeler is; its posteriors train a logistic span classifier, which decides the
looser spans. Both need only how often each pattern of votes occurs, which Spark counts over all
spans of all documents; the number of patterns does not grow with the data.

Offsets come from the pieces between matches: their lengths are summed per document by a window over
rows, so a text may hold any number of spans."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campuslens.llm.common import Stage

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_AT, _DOT = r"(?: ?[\[({] ?(?:at|AT|@) ?[\])}] ?| at | ?@ ?)", r"(?: ?[\[({] ?(?:dot|DOT|\.) ?[\])}] ?| dot |\.)"

#: Proposals: kind, a pattern that a text must hold to be looked at, pattern of the spans. A match may
#: start inside a run of characters only where the match before ended (\G), and no part is given back,
#: so that each is one pass. ``digits`` are whole chains; base cards are among those of 16 to 19.
PROPOSALS = {
    "email": ("email", "@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++"),
    "ip": ("ip", r"[0-9]\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "digits": ("card", "[0-9]", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])"),
    "phone": ("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]"),
    "email_spelt": ("email", r" at |@ | @|[\[({] ?(?:at|AT|@) ?[\])}]",
                    rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+{_AT}{_HOST}{{1,63}}+(?:{_DOT}{_HOST}{{1,63}}+){{1,8}}+"),
    "ip_spelt": ("ip", r"[0-9](?:\[\.\]|\(\.\))[0-9]|:[0-9A-Fa-f]{0,4}:",
                 r"(?<![0-9A-Za-z:.])(?:[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}+){3}+(?![0-9])"
                 r"|(?:[0-9A-Fa-f]{1,4}+::?){3,7}[0-9A-Fa-f]{1,4}+(?![0-9A-Za-z:]))"),
    "phone_bare": ("phone", "[0-9][ )./-]",
                   r"(?<![0-9A-Za-z+])(?<![0-9][ ./-])\(?[0-9]{2,5}+\)?(?:[ ./-]{1,2}+[0-9]{2,5}+){1,4}+(?![0-9A-Za-z])"),
}
BEFORE, AFTER = 32, 8

# Lists of the gazetteer and context labelers.
TLDS = ("com org net edu gov info biz io eu es mx ar de at ch fr be uk us ca br it nl pt dev app example test").split()
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|30[0-5]|3[689]|35|6011|64[4-9]|65|62"
CALLING = ("1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|21[1-3]|35[0-9]|37[0-9]|38[0-9]|42[01]|50[0-9]"
           "|59[0-9]|85[2356]|88[06]|96[0-8]|97[0-7]|99[2-8]")
CONTEXT = {
    "email": "mail|contact|write to|correo|courriel|kontakt|schreib",
    "ip": "ip|address|host|server|adress|direcci|client|peer",
    "card": "card|visa|amex|master|credit|debit|tarjeta|carte|karte|kredit",
    "phone": "tel|phone|call|fax|mobil|cell|whatsapp|ruf|handy|appel|llam"}
AGAINST = "version|release|isbn|issn|order|invoice|serial|build|price|total|page|chapter|section|figure"

LABELERS = ("rule", "form", "number", "gazetteer", "context", "neighbours")
#: Observations besides the votes that the classifier sees.
SHAPES = ("loose", "blanks", "long")


def _hits(family: str) -> Column:
    kind, guard, pattern = PROPOSALS[family]
    pieces = F.split("text", pattern, -1)
    found = F.arrays_zip(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("value"), pieces.alias("gap"),
                         F.slice(pieces, F.lit(2), F.size(pieces)).alias("next"))
    made = F.transform(found, lambda x, k: F.struct(
        F.lit(kind).alias("kind"), F.lit(family).alias("family"), k.cast("long").alias("k"), x["value"].alias("value"),
        F.length(x["gap"]).cast("long").alias("gap"), F.substring(x["gap"], -BEFORE, BEFORE).alias("before"),
        F.substring(x["next"], 1, AFTER).alias("after")))
    return F.when(F.col("text").rlike(guard), F.filter(made, lambda x: x["value"].isNotNull()))


def proposals(docs: DataFrame) -> Stage:
    """Stage table with a row per proposed span: ``at`` (the row of ``docs``), doc_id, kind, family, k (its
    number), value, gap, before, after; and a row of nulls for each text. Texts stay behind."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("at"))
    every = F.concat(*[F.coalesce(_hits(f), F.array()) for f in PROPOSALS], F.array(F.lit(None)))
    return Stage(rows.select("at", "doc_id", F.explode(every).alias("x")).select("at", "doc_id", "x.*"),
                 "personal-proposals")


def _placed(found: DataFrame) -> DataFrame:
    """Adds start and end (code points, end exclusive)."""
    size = F.length("value").cast("long")
    earlier = Window.partitionBy("at", "family").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("gap") + size).over(earlier), F.lit(0)) + F.col("gap")
    return found.withColumn("start", start).withColumn("end", F.col("start") + size)


def _vote(plus: str, minus: str) -> Column:
    return F.expr(f"CASE WHEN {plus} THEN 1 WHEN {minus} THEN -1 ELSE 0 END")


def _by_kind(**votes: tuple[str, str]) -> Column:
    """A labeler's vote: per kind the conditions for and against."""
    return F.coalesce(*[F.when(F.col("kind") == k, _vote(*v)) for k, v in votes.items()], F.lit(0))


_PART = "(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_IP = f"^0*{_PART}(\\\\.0*{_PART}){{3}}$"
_DIGITS = "length(digits)"


def labelled(found: DataFrame) -> DataFrame:
    """Adds ``base`` (valid by a base rule), a column per labeler and the shapes."""
    rows = found.withColumns({
        "digits": F.regexp_replace("value", "[^0-9]", ""), "plain": F.regexp_replace("value", r"[\[\](){} ]", ""),
        "tld": F.lower(F.regexp_extract("value", "([A-Za-z0-9-]+)$", 1)),
        "first": F.substring(F.regexp_replace("value", r"[^0-9.]", ""), 1, 3), "front": F.lower("before")})
    rows = rows.withColumn("number_ok", F.expr(f"""CASE kind
        WHEN 'ip' THEN plain RLIKE '{_IP}' WHEN 'card' THEN luhn_check(digits)
        WHEN 'phone' THEN {_DIGITS} BETWEEN 8 AND 15 ELSE NOT contains(value, '..') END"""))
    rows = rows.withColumn("base", F.expr(f"""coalesce(family = 'email' OR family IN ('ip', 'phone') AND number_ok
        OR family = 'digits' AND {_DIGITS} >= 16 AND number_ok, false)"""))
    words = F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN front RLIKE '({w})[^0-9]*$'" for k, w in CONTEXT.items())
                   + " END")
    date = "value RLIKE '^((19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-](19|20)[0-9]{2})$'"
    return rows.withColumns({
        "rule": _vote("base", "family IN ('ip', 'phone') OR family = 'digits' AND length(digits) >= 16"),
        "form": _by_kind(
            email=("value RLIKE '^[A-Za-z0-9].*[.] ?[A-Za-z]{2,}$'", "value RLIKE '^[.%+-]|[0-9-]$'"),
            ip=("value RLIKE '^[1-9]' AND length(plain) >= 7", "value RLIKE '(^|[.])0[0-9]'"),
            card=("value RLIKE '^([0-9]{13,19}|[0-9]{4}([ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$'", "true"),
            phone=(f"NOT {date} AND value RLIKE '[ ().-]' AND {_DIGITS} >= 9", f"{date} OR {_DIGITS} < 7")),
        "number": _by_kind(email=("number_ok", "true"), ip=("number_ok", "NOT contains(value, ':')"),
                           card=("number_ok", "true"), phone=("number_ok", "true")),
        "gazetteer": _by_kind(
            email=("tld IN ('" + "', '".join(TLDS) + "')", "true"),
            ip=("int(split(first, '[.]')[0]) BETWEEN 1 AND 223 AND NOT first = '127'", "NOT contains(value, ':')"),
            card=(f"digits RLIKE '^({ISSUERS})'", "true"),
            phone=(f"value RLIKE '^([+]|00)' AND digits RLIKE '^(00)?({CALLING})'", "startswith(value, '+')")),
        "context": F.when(F.coalesce(words, F.lit(False)), 1).when(F.expr(f"front RLIKE '({AGAINST})[^0-9]*$'"), -1)
            .otherwise(0),
        "neighbours": _vote("before RLIKE '(^|[ \\\\t\\\\n|(<\"\\':,;])$' AND after RLIKE '^($|[ \\\\t\\\\n|)>\"\\':,;.!?])'",
                            "before RLIKE '[A-Za-z0-9_=/#$%.-]$' OR after RLIKE '^[A-Za-z0-9_=/#$%-]'"),
        "loose": F.expr("int(NOT base AND rule = 0)"), "blanks": F.expr("int(contains(value, ' '))"),
        "long": F.expr("int(length(value) > 15)")})


class SpanModel:
    """Reliabilities of the labelers and the span classifier, from counts of vote patterns."""

    def __init__(self, patterns: list, tolerance: float = 1e-9, ridge: float = 1.0):
        """``patterns`` are rows (kind, votes, shapes, n)."""
        self.kinds = np.array([KINDS.index(r["kind"]) for r in patterns], int)
        self.votes = np.array([[r[c] for c in LABELERS] for r in patterns], int).reshape(-1, len(LABELERS))
        self.shapes = np.array([[r[c] for c in SHAPES] for r in patterns], float).reshape(-1, len(SHAPES))
        self.n = np.array([r["n"] for r in patterns], float)
        #: P(vote -1, 0, 1 | span is none, is one) by kind and labeler, and the share of spans that are one.
        start = np.array([[0.5, 0.3, 0.2], [0.1, 0.3, 0.6]])
        self.reliability = np.tile(start, (len(KINDS), len(LABELERS), 1, 1))
        self.share = np.full(len(KINDS), 0.5)
        self.posterior = self._fit_reliabilities(start, tolerance)
        self.weights = self._fit_classifier(ridge)

    def _expect(self) -> tuple[np.ndarray, float]:
        chosen = self.reliability[self.kinds[:, None], np.arange(len(LABELERS)), :, self.votes + 1]
        joint = np.log(chosen).sum(1) + np.log(np.stack([1 - self.share, self.share], 1))[self.kinds]
        top = joint.max(1, keepdims=True)
        total = top[:, 0] + np.log(np.exp(joint - top).sum(1))
        return np.exp(joint[:, 1] - total), float(self.n @ total)

    def _fit_reliabilities(self, start: np.ndarray, tolerance: float) -> np.ndarray:
        """EM until the likelihood stands still; two made-up spans of each class (``start``) keep every
        probability above zero and the classes from trading places."""
        posterior, before = self._expect()
        while len(self.n):
            mass = np.stack([self.n * (1 - posterior), self.n * posterior], 1)
            for kind in range(len(KINDS)):
                own = self.kinds == kind
                self.share[kind] = (mass[own, 1].sum() + 1) / (mass[own].sum() + 2)
                for j in range(len(LABELERS)):
                    for y in (0, 1):
                        counts = np.bincount(self.votes[own, j] + 1, mass[own, y], 3) + 2 * start[y]
                        self.reliability[kind, j, y] = counts / counts.sum()
            posterior, now = self._expect()
            if abs(now - before) <= tolerance * abs(now):
                break
            before = now
        return posterior

    def _features(self) -> np.ndarray:
        return np.concatenate([np.ones((len(self.n), 1)), self.votes == 1, self.votes == -1, self.shapes,
                               self.kinds[:, None] == np.arange(len(KINDS))], axis=1).astype(float)

    def _fit_classifier(self, ridge: float) -> np.ndarray:
        """Logistic regression on the posteriors, by Newton steps that are halved until they gain."""
        x, target = self._features(), self.posterior

        def loss(w):
            z = x @ w
            return float(self.n @ (np.logaddexp(0, z) - target * z)) + ridge / 2 * float(w @ w)

        w = np.zeros(x.shape[1])
        for _ in range(100):
            p = 1 / (1 + np.exp(-(x @ w)))
            slope = x.T @ (self.n * (p - target)) + ridge * w
            step = np.linalg.solve((x * (self.n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), slope)
            while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
                step = step / 2
            w = w - step
            if np.abs(step).max() <= 1e-9:
                break
        return w

    def score(self) -> Column:
        """Probability that a labelled row is personal data."""
        inputs = [F.lit(1.0), *[(F.col(c) == 1).cast("double") for c in LABELERS],
                  *[(F.col(c) == -1).cast("double") for c in LABELERS], *[F.col(c).cast("double") for c in SHAPES],
                  *[(F.col("kind") == k).cast("double") for k in KINDS]]
        z = sum((x * float(w) for x, w in zip(inputs, self.weights, strict=True)), F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def fit(rows: DataFrame) -> SpanModel:
    """Model of labelled rows. The driver gets a row per pattern of kind, votes and shapes, at most
    4 * 3**6 * 2**3 of them, whatever the number of spans."""
    keys = ["kind", *LABELERS, *SHAPES]
    return SpanModel(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(*keys).collect())


def _kind_number() -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))


def find_spans(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Spans of personal data in the texts of ``docs``: ``at`` (number of the row of ``docs``), doc_id,
    kind, start, end (code points, end exclusive), value, base, score; and a row of nulls for each
    text.

    Valid matches of the base rules stay whatever their score. Other proposed spans count if they
    overlap no base span, their score is ``threshold`` or more and no other such span that begins
    earlier (of equal starts: the longer, then the kind listed first) overlaps them. Null and empty
    texts have no spans; a text is matched whole by one task; a null doc_id stays null; equal rows
    keep spans of their own; other columns are ignored; an empty table gives an empty result."""
    made = proposals(docs).frame
    rows = Stage(labelled(_placed(made.where("family IS NOT NULL"))), "personal-votes")
    order = Window.partitionBy("at").orderBy("start", F.desc("end"), F.desc("base"), _kind_number(), "family")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ends = F.max(F.when(F.col("base"), F.col("end"))).over(before)
    starts = F.min(F.when(F.col("base"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(ends, F.lit(0)) <= F.col("start")) & F.coalesce(starts >= F.col("end"), F.lit(True))
    open_rows = Stage(rows.frame.withColumn("free", free).where("base OR free"), "personal-spans").frame
    rows.drop()
    scored = open_rows.withColumn("score", fit(open_rows).score()).where(F.col("base") | (F.col("score") >= threshold))
    taken = F.coalesce(F.max(F.when(~F.col("base"), F.col("end"))).over(before), F.lit(0)) > F.col("start")
    spans = scored.withColumn("taken", taken).where("base OR NOT taken").select(
        "at", "doc_id", "kind", "start", "end", "value", "base", "score")
    return spans.unionByName(made.where("family IS NULL").select("at", "doc_id"), allowMissingColumns=True)


def span_digests(spans: DataFrame) -> DataFrame:
    """A row per text of ``find_spans``: counts and digest of the base spans, and all spans as text,
    by kind as listed, then start."""
    span = F.struct(_kind_number().alias("kind"), "start", "end",
                    F.concat_ws(":", "kind", "start", "end").alias("text"), "base")
    lists = spans.groupBy("at", "doc_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), span))).alias("spans"),
        *[F.count_if((F.col("kind") == k) & F.col("base")).alias(f"n_{k}") for k in KINDS])
    base = F.array_join(F.transform(F.filter("spans", lambda s: s["base"]), lambda s: s["text"]), ",")
    return lists.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        F.array_join("spans.text", ",").alias("spans"))
