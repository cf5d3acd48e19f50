"""Personal data by weak supervision, in DataFrame and SQL functions only.

Patterns give candidate spans: the base patterns and looser ones (obfuscated addresses, IPv6, numbers
that fail the card checksum, phone numbers without a plus). Regex, gazetteer and context labelers vote
on every candidate. Expectation-maximisation over the counts of vote patterns estimates how reliable
each labeler is per kind; its posteriors then train a naive Bayes classifier of spans, on the votes and
the spans' own features. Base spans always stay; the classifier decides on the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut, numbered, table, whole_text

KINDS = ("email", "ip", "card", "phone")

# A greedy run followed by something it can't contain is written possessively, and a run is entered at
# its first character or where the last match ended: the same matches, in linear time and without
# recursion on very long runs.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:\x20?[\[(]at[\])]\x20?|\x20at\x20)"
_DOT = r"(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20)"
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,8}}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
#: What a text must contain for a pattern to be tried.
_GATE = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_LOOSE_GATE = {"email": "dot", "ip": ":", "phone": None}

# Gazetteers and context words.
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "eu", "us", "ch", "at", "nl")
CARD_ISSUERS = r"^(4|5[1-5]|2[2-7]|3[4-9]|30|6011|62|64|65|50|5[6-8]|60|63|67)"
CALLING_CODES = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-689]\d|3[578]\d|42\d|5[09]\d|6[7-9]\d|8[0578]\d|9[679]\d)"
AREA_CODES = r"^[2-9]\d\d[2-9]|^[2-9]\d\d1"
RESERVED_IPS = r"^(0|10|127|255|22[4-9]|23\d|24\d|25[0-5])\.|^192\.168\.|^169\.254\."
GOOD_CONTEXT = {
    "email": r"(?i)\b(e-?mail|mail|contact|write|reach|correo|adresse|courriel)\b",
    "ip": r"(?i)\b(ip|ipv6|host|server|client|address|login|from)\b",
    "card": r"(?i)\b(card|visa|mastercard|amex|credit|debit|karte|tarjeta|carte)\b",
    "phone": r"(?i)\b(tel|phone|call|mobile|cell|fax|telefon|tel[eé]fono|t[eé]l[eé]phone)\b",
}
BAD_CONTEXT = r"(?i)\b(version|release|isbn|order|invoice|ticket|serial|part|id|token|key|hash|price|total)\b[\W_]*$"

LABELERS = 5
EM_ROUNDS = 20
#: A span beyond the base ones needs this probability.
ACCEPT = 0.9
CONTEXT_CHARS = 40


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the checksum holds; the caller bounds the length."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _is_base(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.right(p, F.lit(3)).cast("int") <= 255)
        return F.forall(F.split(m, r"\."), small)
    digits = F.length(_digits(m))
    if kind == "phone":
        return digits.between(9, 15)
    return F.when(digits.between(13, 19), _luhn(_digits(m))).otherwise(False)


def _matches(text: Column, kind: str, pattern: str, gate: str | None, loose: bool) -> Column:
    """Structs of every match: its place among the pattern's matches and the text around it."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def one(m: Column, i: Column) -> Column:
        left = F.element_at(pieces, i + 1)
        return F.struct(
            F.lit(kind).alias("kind"),
            F.lit(loose).alias("loose"),
            i.alias("i"),
            F.length(left).cast("long").alias("gap"),
            m.alias("m"),
            F.right(left, F.lit(CONTEXT_CHARS)).alias("left"),
            F.left(F.element_at(pieces, i + 2), F.lit(1)).alias("right"),
        )

    has = F.contains(text, F.lit(gate)) if gate else F.lit(True)
    if kind in ("ip", "card", "phone") and not (loose and kind == "ip"):
        has = has & text.rlike("[0-9]")
    return F.when(has, F.transform(found, one))


def candidates(docs: DataFrame) -> DataFrame:
    """rid, doc_id, found: every pattern's matches in the whole text."""
    text = whole_text("text")
    arrays = [_matches(text, k, BASE[k], _GATE[k], False) for k in KINDS]
    arrays += [_matches(text, k, p, _LOOSE_GATE[k], True) for k, p in LOOSE.items()]
    none = F.array().cast("array<struct<kind:string,loose:boolean,i:int,gap:bigint,m:string,left:string,right:string>>")
    found = F.concat(*[F.coalesce(a, none) for a in arrays])
    return numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), found.alias("found")))


def _by_kind(col: dict[str, Column], otherwise: Column | None = None) -> Column:
    out = F.lit(0) if otherwise is None else otherwise
    for kind, value in col.items():
        out = F.when(F.col("kind") == kind, value).otherwise(out)
    return out


def _vote(yes: Column, no: Column) -> Column:
    """1 for, -1 against, 0 no opinion."""
    return F.when(yes, 1).when(no, -1).otherwise(0)


def spans(found: DataFrame) -> DataFrame:
    """rid, kind, start, end, base, votes, features for every candidate span.

    Offsets are sums over the matches of one pattern in one row. Failing matches of a base pattern are
    dropped, but for card-like numbers, which stay as candidates. Candidates that overlap a base span go.
    """
    rows = found.select("rid", F.explode("found").alias("s")).select("rid", "s.*")
    order = Window.partitionBy("rid", "kind", "loose").orderBy("i")
    upto = F.sum(F.col("gap") + F.length("m")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("end", upto).withColumn("start", F.col("end") - F.length("m"))
    base = ~F.col("loose") & _by_kind({k: _is_base(k, F.col("m")) for k in KINDS}, F.lit(False))
    number = _digits(F.col("m"))
    rows = rows.withColumn("base", base).withColumn("number", number)
    rows = rows.where("base or loose or (kind = 'card' and length(number) between 13 and 19)")
    near = Window.partitionBy("rid").orderBy("start", "end", "kind", "loose")
    ends = F.max(F.when(F.col("base"), F.col("end"))).over(near.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.min(F.when(F.col("base"), F.col("start"))).over(near.rowsBetween(1, Window.unboundedFollowing))
    clear = (F.coalesce(ends, F.lit(0)) <= F.col("start")) & (F.coalesce(starts, F.col("end")) >= F.col("end"))
    rows = rows.withColumn("clear", clear).where("base or clear")
    m, left, right = F.col("m"), F.col("left"), F.col("right")
    tail = F.lower(F.regexp_extract(F.right(m, F.lit(64)), r"([A-Za-z0-9-]+)$", 1))
    same = F.length(F.replace(F.col("number"), F.substring("number", 1, 1))) == 0
    glued = left.rlike(r"[\p{L}\p{N}_]$") | right.rlike(r"^[\p{L}\p{N}_]")
    shape = _vote(F.col("base"), (F.col("kind") == "card"))
    gazetteer = _by_kind({
        "email": _vote(tail.isin(*TOP_DOMAINS), ~tail.isin(*TOP_DOMAINS)),
        "ip": _vote(~m.rlike(RESERVED_IPS), m.rlike(RESERVED_IPS)),
        "card": _vote(F.col("number").rlike(CARD_ISSUERS), ~F.col("number").rlike(CARD_ISSUERS)),
        "phone": _vote(F.when(m.startswith("+"), F.col("number").rlike(CALLING_CODES)).otherwise(F.col("number").rlike(AREA_CODES)), F.lit(True)),
    })
    context = _vote(_by_kind({k: left.rlike(p) for k, p in GOOD_CONTEXT.items()}, F.lit(False)), left.rlike(BAD_CONTEXT))
    # a number that neither a pattern nor its context speaks for is no candidate
    rows = rows.withColumn("context", context).where("base or loose or context = 1")
    context = F.col("context")
    votes = [shape, gazetteer, context, _vote(F.lit(False), glued), _vote(F.lit(False), (F.length("number") > 0) & same)]
    fits = _by_kind({
        "email": tail.rlike("^[a-z]{2,}$"),
        "ip": F.lit(True),
        "card": F.length("number").between(13, 19),
        "phone": F.length("number").between(9, 15),
    }, F.lit(False))
    features = F.array(
        F.concat(F.lit("fits:"), fits.cast("string")),
        F.concat(F.lit("alone:"), (left.rlike(r"(^|[\s(:;,.\"'])$") & ~right.rlike(r"^[\p{L}\p{N}_-]")).cast("string")),
    )
    return rows.select("rid", "kind", "start", "end", "base", F.array(*[v.cast("int") for v in votes]).alias("votes"), features.alias("features"))


# theta: prior, and for y = 1 (yes) and y = 0 (no) the chance of each labeler's votes -1, 0, 1
_JOINT = "aggregate(sequence(0, {n} - 1), {prior}, (acc, l) -> acc * element_at(element_at({side}, l + 1), p.votes[l] + 2))"


def _posterior(theta: str) -> str:
    yes = _JOINT.format(n=LABELERS, prior=f"{theta}.prior", side=f"{theta}.yes")
    no = _JOINT.format(n=LABELERS, prior=f"(1 - {theta}.prior)", side=f"{theta}.no")
    return f"({yes}) / (({yes}) + ({no}))"


def reliabilities(patterns: DataFrame) -> DataFrame:
    """kind, theta: what expectation-maximisation finds from (kind, votes, n).

    There are 3 ** LABELERS vote patterns of a kind at most, so a kind's patterns fit one row; the
    rounds are one expression over it.
    """
    start_yes, start_no = "array(0.1D, 0.2D, 0.7D)", "array(0.7D, 0.2D, 0.1D)"
    rows = patterns.groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("ps"))

    def side(weight: str) -> str:
        per_vote = f"transform(sequence(-1, 1), v -> (aggregate(ws, 0D, (acc, p) -> acc + IF(p.votes[l] = v, {weight}, 0D)) + 1D) / (aggregate(ws, 0D, (acc, p) -> acc + {weight}) + 3D))"
        return f"transform(sequence(0, {LABELERS} - 1), l -> {per_vote})"

    # ws: the patterns with their posterior; a one-element transform names it for the next step
    step = f"""
      transform(array(transform(ps, p -> named_struct('votes', p.votes, 'n', p.n, 'w', {_posterior("t")}))), ws ->
        named_struct(
          'prior', (aggregate(ws, 0D, (acc, p) -> acc + p.n * p.w) + 1D) / (aggregate(ws, 0D, (acc, p) -> acc + p.n) + 2D),
          'yes', {side("p.n * p.w")},
          'no', {side("p.n * (1 - p.w)")}
        ))[0]
    """
    start = f"named_struct('prior', 0.5D, 'yes', array_repeat({start_yes}, {LABELERS}), 'no', array_repeat({start_no}, {LABELERS}))"
    return rows.select("kind", F.expr(f"aggregate(sequence(1, {EM_ROUNDS}), {start}, (t, round) -> {step})").alias("theta"))


def classifier(found: DataFrame) -> DataFrame:
    """kind, prior, weights: a naive Bayes classifier of spans, trained on the posteriors.

    One row per kind; its weights have a key per vote and feature value, a few dozen.
    """
    patterns = found.groupBy("kind", "votes", "features").agg(F.count(F.lit(1)).cast("double").alias("n"))
    patterns = cut(patterns)
    theta = reliabilities(patterns.groupBy("kind", "votes").agg(F.sum("n").alias("n")))
    rows = patterns.join(F.broadcast(theta), "kind").withColumn("p", F.struct("votes")).withColumn("w", F.expr(_posterior("theta")))
    keys = F.concat(F.expr("transform(votes, (v, l) -> concat('vote', l, ':', v))"), F.col("features"))
    rows = rows.select("kind", (F.col("n") * F.col("w")).alias("yes"), (F.col("n") * (1 - F.col("w"))).alias("no"), keys.alias("keys"))
    totals = rows.groupBy("kind").agg(F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"))
    per = rows.select("kind", "yes", "no", F.explode("keys").alias("key")).groupBy("kind", "key").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    per = per.join(F.broadcast(totals), "kind")
    weight = F.log((F.col("yes") + 1) / (F.col("all_yes") + 2)) - F.log((F.col("no") + 1) / (F.col("all_no") + 2))
    return per.groupBy("kind").agg(
        F.log((F.first("all_yes") + 1) / (F.first("all_no") + 1)).alias("prior"),
        F.map_from_entries(F.collect_list(F.struct("key", weight))).alias("weights"),
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row of ``docs``.

    The counts and the hash are of base spans; ``spans`` lists all, as kind:start:end in code points, by
    kind and start. A null or empty text has none, and the hash of an empty string. Repeated rows and
    rows with a null id are rows of their own. Other columns are ignored; an empty table gives an empty
    result.
    """
    found = cut(candidates(docs))
    every = cut(spans(found.where(F.size("found") > 0)))
    model = classifier(every)
    keys = F.concat(F.expr("transform(votes, (v, l) -> concat('vote', l, ':', v))"), F.col("features"))
    odds = F.aggregate(F.transform(keys, lambda k: F.coalesce(F.col("weights")[k], F.lit(0.0))), F.col("prior"), lambda a, x: a + x)
    judged = every.join(F.broadcast(model), "kind").withColumn("score", 1 / (1 + F.exp(-odds)))
    kept = judged.where((F.col("base")) | (F.col("score") >= ACCEPT))
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    per_row = kept.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct(place.alias("k"), "start", "end", "kind", "base"))).alias("all"))
    name = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    out = found.select("rid", "doc_id").join(per_row, "rid", "left")
    every_span = F.coalesce(F.col("all"), F.array().cast(per_row.schema["all"].dataType))
    base = F.filter(every_span, lambda s: s["base"])
    kind_of = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(base) - F.size(F.array_remove(kind_of, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    joined = lambda c: F.array_join(F.transform(c, name), ",")
    return out.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(every_span).alias("spans"))


def op5_weak_supervision_pii(spark, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
