"""Personal data: spans of known forms, and others that a classifier trained by weak labels accepts.

Regular expressions propose spans; labelers of shape, gazetteer, context and digits vote on
each or abstain; expectation-maximisation estimates from the votes alone how far each labeler
can be trusted, and its beliefs are the soft labels of a naive Bayes classifier of spans.
All of it is SQL functions and aggregates; the models are fitted on a table of vote patterns,
whose size the labelers bound, not the texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import settled, text_or_empty

# The kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone", "name")
# The base forms, for Java.  Possessive, and from the start of a run of characters, so that
# a long run is not tried from each of its characters; the matches are the same.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"  # what has fewer digits cannot be one
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Wider forms, which only the classifier lets in.
WIDE = {
    "email": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}+\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}+"
             r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]{1,63}+){1,5}+",
    "phone": r"(?<![A-Za-z0-9+().-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![A-Za-z0-9-])",
    "name": r"(?<![\p{L}])(?:Mrs?|Ms|Dr|Herr|Frau|Monsieur|Madame|Señora?)\.?\x20\p{Lu}\p{L}{1,40}+",
}

# What the labelers know.
TOP_DOMAINS = "com org net edu gov io info de fr es uk it nl eu at ch us ca"
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 61 81 82 86 90 91"
CARD_PREFIXES = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
SPECIAL_NETS = r"^(?:0|10|127|192\.168|169\.254|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
GIVEN_NAMES = "anna peter maria john mary james paul marie jean pierre hans karl jose juan carmen thomas michael"
CUES = {
    "email": "mail|contact|kontakt|correo|courriel|write|@",
    "ip": r"\bip\b|address|host|server|adresse",
    "card": "card|visa|master|karte|carte|tarjeta|pay",
    "phone": "phone|tel|call|mobil|fax|anruf|llam|appel",
    "name": "dear|name|sincerely|signed|liebe|cher|estimad",
}
OTHER_CUES = r"version|isbn|issue|order|invoice|page|chapter|figure|\bno\b|\bnr\b|#"
CONTEXT_CHARS = 32

LABELERS = ("shape", "gazetteer", "context", "digits")
ROUNDS = 12
#: A wider span is taken if the classifier is as sure as this.
SURE = 0.9


def _hits(text: Column, pattern: str, gate: Column) -> Column:
    """``start, end, hit`` of all matches, in code points, found without a UDF: what stands
    between the matches and the matches themselves, laid end to end."""
    between = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")

    def add(state: Column, next_: Column) -> Column:
        start = state["at"] + next_["between"]
        end = start + F.length(next_["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), next_["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    pairs = F.zip_with(
        F.slice(between, F.lit(1), F.size(found)), found,
        lambda b, h: F.struct(b.alias("between"), h.alias("hit")),
    )
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.when(gate, F.aggregate(pairs, start, add, lambda state: state["spans"])).otherwise(none)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _is_ip(hit: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return (F.length(bare) <= 2) | ((F.length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(hit, r"\."), small)


def _is_card(hit: Column) -> Column:
    turned = F.split(F.reverse(_digits(hit)), "")
    doubled = F.transform(
        turned,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")),
    )
    luhn = F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0
    return F.length(_digits(hit)).between(14, 19) & luhn


def _is_phone(hit: Column) -> Column:
    return F.length(_digits(hit)).between(10, 15)


def _proposed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, base, wide``: arrays of ``start, kind, end, wide, votes, form``, sorted."""
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("digit", text.rlike("[0-9]"))
    gates = {
        "email": text.contains("@"), "ip": F.col("digit"), "card": F.col("digit"), "phone": text.contains("+"),
    }
    valid = {"email": lambda h: F.lit(True), "ip": _is_ip, "card": _is_card, "phone": _is_phone}
    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    rows = rows.withColumns({k: _hits(text, p, gates[k]) for k, p in patterns.items()})
    wide_gates = {"email": text.rlike(r"[\[(]at[\])]"), "phone": F.col("digit"), "name": F.lit(True)}
    rows = rows.withColumns({f"wide_{k}": _hits(text, p, wide_gates[k]) for k, p in WIDE.items()})

    def typed(column: str, kind: str, wide: bool) -> Column:
        def span(h: Column) -> Column:
            before = F.lower(F.substring(
                F.col("text"), F.greatest(h["start"] - CONTEXT_CHARS, F.lit(0)) + 1, F.least(h["start"], F.lit(CONTEXT_CHARS))
            ))
            return F.struct(
                h["start"].cast("long").alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                h["end"].cast("long").alias("end"), F.lit(wide).alias("wide"),
                _votes(kind, h["hit"], before).alias("votes"), _form(h["hit"]).alias("form"),
            )

        good = F.col(column) if wide else F.filter(column, lambda h: valid[kind](h["hit"]))
        return F.transform(good, span)

    base = F.sort_array(F.concat(*[typed(k, k, False) for k in patterns]))
    rows = rows.withColumn("base", base)
    rows = rows.withColumn("wide", F.concat(*[typed(f"wide_{k}", k, True) for k in WIDE]))
    apart = F.filter(
        "wide", lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"]))
    )
    return rows.select("doc_id", "base", F.sort_array(apart).alias("wide"))


def _votes(kind: str, hit: Column, before: Column) -> Column:
    """1, 0 or, for an abstention, null of each labeler."""
    digits = _digits(hit)
    nothing = F.lit(None).cast("int")

    def listed(value: Column, names: str, otherwise: Column) -> Column:
        return F.when(value.isin(names.split()), F.lit(1)).otherwise(otherwise)

    shape = {
        "email": F.when(hit.rlike(r"(?i)[a-z0-9]\x20?(?:@|[\[(]at[\])])\x20?[a-z0-9].*[a-z]{2,}$"), 1).otherwise(0),
        "ip": F.when(hit.rlike(r"(?:^|\.)0[0-9]"), 0).otherwise(1),
        "card": F.when(hit.rlike(r"^[0-9]+$|^[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{2,4}$"), 1).otherwise(0),
        "phone": F.when(hit.rlike(r"^\+?[1-9(]") & hit.rlike(r"^[^()]*(?:\([0-9]+\)[^()]*)?$"), 1).otherwise(0),
        "name": nothing,
    }[kind]
    gazetteer = {
        "email": listed(F.lower(F.regexp_extract(hit, r"([A-Za-z]+)$", 1)), TOP_DOMAINS, F.lit(0)),
        "ip": F.when(hit.rlike(SPECIAL_NETS), 0).otherwise(nothing),
        "card": F.when(digits.rlike(CARD_PREFIXES), 1).otherwise(0),
        "phone": F.when(~hit.startswith("+"), nothing).otherwise(
            F.when(digits.rlike("^(?:" + "|".join(CALLING_CODES.split()) + ")"), 1).otherwise(0)
        ),
        "name": listed(F.lower(F.regexp_extract(hit, r"(\p{L}+)$", 1)), GIVEN_NAMES, nothing),
    }[kind]
    context = F.when(before.rlike(CUES[kind]), 1).when(before.rlike(OTHER_CUES), 0).otherwise(nothing)
    varied = F.size(F.array_distinct(F.split(digits, "")))
    plain = F.when(digits == "", nothing).when(varied <= 2, 0).when(varied >= 5, 1).otherwise(nothing)
    return F.array(*[v.cast("int") for v in (shape, gazetteer, context, plain)])


def _form(hit: Column) -> Column:
    """What else the classifier looks at: length, digits, separators, in a few classes each."""
    return F.struct(
        F.least(F.floor(F.length(hit) / 4), F.lit(6)).cast("int").alias("length"),
        F.least(F.floor(F.length(_digits(hit)) / 3), F.lit(6)).cast("int").alias("digits"),
        F.least(F.length(F.regexp_replace(hit, r"[\p{L}0-9]", "")), F.lit(4)).alias("marks"),
    )


def _log_odds(p: float, q: float) -> float:
    return math.log(p) - math.log(q)


def _belief(model: dict) -> Column:
    """The log odds that a span is personal, from its votes."""
    score = F.lit(0.0)
    for k, prior in model["prior"].items():
        score = F.when(F.col("kind") == k, F.lit(_log_odds(prior, 1 - prior))).otherwise(score)
    for n, name in enumerate(LABELERS):
        yes, no = model["yes"][name], model["no"][name]
        vote = F.col("votes")[n]
        score = score + F.when(vote == 1, F.lit(_log_odds(yes, no))).when(
            vote == 0, F.lit(_log_odds(1 - yes, 1 - no))
        ).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-score))


def fit_labelers(patterns: DataFrame) -> dict:
    """Expectation-maximisation over ``kind, votes, n``: of each kind the share that is
    personal, of each labeler how often it votes 1 on what is and on what is not.

    Each round is one aggregate of the pattern table.  Prior counts (a labeler is right
    8 times of 10) keep the two classes from changing places.
    """
    model = {
        "prior": {k: 0.5 for k in range(len(KINDS))},
        "yes": dict.fromkeys(LABELERS, 0.8), "no": dict.fromkeys(LABELERS, 0.2),
    }
    for _ in range(ROUNDS):
        weighed = patterns.withColumn("p", _belief(model))
        sums = []
        for n in range(len(LABELERS)):
            vote = F.col("votes")[n]
            for side in (F.col("p"), 1 - F.col("p")):
                voted = F.when(vote.isNotNull(), side * F.col("n")).otherwise(F.lit(0.0))
                sums += [F.sum(voted * vote.eqNullSafe(F.lit(1)).cast("int")), F.sum(voted)]
        rows = weighed.groupBy("kind").agg(F.sum(F.col("p") * F.col("n")), F.sum("n"), *sums).collect()
        for kind, true, all_, *_rest in rows:
            model["prior"][kind] = (true + 1) / (all_ + 2)
        for n, name in enumerate(LABELERS):
            yes1, yes, no1, no = (sum(r[3 + 4 * n + i] for r in rows) for i in range(4))
            model["yes"][name], model["no"][name] = (yes1 + 8) / (yes + 10), (no1 + 2) / (no + 10)
    return model


def _features(span: Column, kind: Column) -> list[Column]:
    votes = [F.concat_ws("=", F.lit(n), F.coalesce(span["votes"][i].cast("string"), F.lit("-"))) for i, n in enumerate(LABELERS)]
    forms = [F.concat_ws("=", F.concat(F.lit(f), kind.cast("string")), span["form"][f].cast("string"))
             for f in ("length", "digits", "marks")]
    return [F.concat_ws("=", F.lit("kind"), kind.cast("string")), *votes, *forms]


def fit_classifier(patterns: DataFrame, model: dict) -> tuple[float, dict[str, float]]:
    """Naive Bayes with the labelers' beliefs as soft labels: the prior's log odds and
    the weight of each feature."""
    weighed = patterns.withColumn("p", _belief(model))
    span = F.struct("votes", "form")
    each = weighed.select("p", "n", F.explode(F.array(*_features(span, F.col("kind")))).alias("feature"))
    sums = each.groupBy("feature").agg(
        F.sum(F.col("p") * F.col("n")).alias("yes"), F.sum((1 - F.col("p")) * F.col("n")).alias("no")
    ).collect()
    all_yes, all_no = weighed.agg(
        F.coalesce(F.sum(F.col("p") * F.col("n")), F.lit(0.0)), F.coalesce(F.sum((1 - F.col("p")) * F.col("n")), F.lit(0.0))
    ).first()
    # A feature seen seldom is drawn towards the share of all spans, that is to weight 0.
    share = (all_yes + 1) / (all_yes + all_no + 2)
    weights = {
        r["feature"]: _log_odds(r["yes"] + 2 * share, r["no"] + 2 * (1 - share)) - _log_odds(share, 1 - share)
        for r in sums
    }
    return _log_odds(share, 1 - share), weights


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``spans``: arrays of ``start, kind, end``, in code points, end
    exclusive, sorted by start, then by kind as listed.

    ``base`` are the valid matches of the four base forms; ``spans`` are these and the
    wider ones that the classifier accepts, none of which overlaps a base span.  One
    row per row; a null text is empty; an empty table gives no rows; other columns
    are not read.
    """
    rows = settled(_proposed(docs, id_col, text_col))
    spans = rows.select(F.explode(F.concat("base", "wide")).alias("s"))
    patterns = settled(
        spans.groupBy(F.col("s.kind").alias("kind"), F.col("s.votes").alias("votes"), F.col("s.form").alias("form"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by_votes = patterns.groupBy("kind", "votes").agg(F.sum("n").alias("n"))
    prior, weights = fit_classifier(patterns, fit_labelers(by_votes))
    weight = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else None

    def sure(span: Column) -> Column:
        if weight is None:
            return F.lit(False)
        score = F.lit(prior)
        for feature in _features(span, span["kind"]):
            score = score + F.coalesce(F.element_at(weight, feature), F.lit(0.0))
        return score >= math.log(SURE / (1 - SURE))

    def listed(found: Column) -> Column:
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.transform(
            F.sort_array(found),
            lambda s: F.struct(s["start"].alias("start"), names[s["kind"]].alias("kind"), s["end"].alias("end")),
        )

    all_spans = F.concat(F.col("base"), F.filter("wide", sure))
    return rows.select("doc_id", listed(F.col("base")).alias("base"), listed(all_spans).alias("spans"))
