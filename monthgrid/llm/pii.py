"""Personal data by weak supervision, in DataFrame operations only.

1. Candidate spans come from patterns: four base kinds (email, ip, card, phone) and looser ones (written-out addresses, phones
   without a country code, keys and passwords, national numbers, bank accounts).
2. Five labelers vote 1, 0 or -1 on each candidate: the strict form of the pattern, gazetteers (top-level domains, issuer and
   calling codes, key prefixes), words before it that speak for it, words that speak against it, and what it is glued to.
3. Expectation-maximisation (Dawid-Skene) estimates how each labeler votes on true and false spans. It sees counts of equal
   vote patterns, at most ``len(FORMS) * 3**5`` rows whatever the corpus.
4. A logistic regression learns the resulting soft labels from the shape of the span and its surroundings, again on counts of
   equal feature rows, and decides on every candidate. Base spans always stay; an added span must not overlap one kept before it.

Texts are read once. A text without a digit, @ or = leaves in a scan with one character class. Patterns use possessive
quantifiers and look-behind, so that a very long run of letters or digits takes linear time and no recursion.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthgrid.session import stage

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "id", "iban")
#: (form, kind, pattern). The base forms find what the plain patterns find, leftmost and without overlap: a match can only begin
#: where a run of its first class begins, or right after the match before.
FORMS = (
    ("email", "email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", "card", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", "phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("key", "secret", r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"),
    ("assigned", "secret", r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|token|secret|api[_-]?key)\x20?[=:]\x20?\x22?[A-Za-z0-9+/_-]{8,}+\x22?"),
    ("local_phone", "phone", r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
    ("spelt_email", "email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}+\x20?[\[(](?i:at)[\])]\x20?[A-Za-z0-9-]{2,63}+\x20?(?:\.|[\[(](?i:dot)[\])])\x20?[A-Za-z]{2,24}+"),
    ("national", "id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("account", "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
)
#: Gazetteers and context words; lower case.
DOMAINS = "com org net edu gov mil int info biz io co uk us ca au de fr es it nl be ch at pt br mx jp cn in ru pl se no dk fi eu"
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|35|36|38|30[0-5]|6011|64[4-9]|65|62)"
CALLING = r"^\+?(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
SPEAK_FOR = ("call phone tel mobile fax contact mail email e-mail write address host server ip login user account card visa "
             "credit pay key secret password token ssn iban telefon anruf kontakt téléphone appel courriel teléfono correo llame")
SPEAK_AGAINST = "version license licence release section chapter page figure isbn doi order item apache gnu build v ver no"
#: A text without any of these characters has no candidates.
ABLE = r"'[0-9@=:\\[(]|AKIA'"
VOTES = ("strict", "listed", "before_for", "before_against", "edges")
ROUNDS = 30


def _any_word(words: str) -> str:
    return r"(?i)(?<![\p{L}\p{N}])(?:" + "|".join(w.replace("-", r"\-") for w in words.split()) + r")(?![\p{L}\p{N}])"


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


_SPAN = "array<struct<form:string,n:int,gap:int,value:string,before:string,after:string>>"


def _found(form: str, pattern: str) -> str:
    """All matches of one pattern with the length of the text since the last one, and what stands around them.

    A text without a match is searched once and not cut, so that few copies of a text are made.
    """
    p = _quoted(pattern)
    hits = (f"transform(array(struct(split(text, {p}, -1) AS gaps, regexp_extract_all(text, {p}, 0) AS hits)), "
            f"x -> transform(x.hits, (v, i) -> named_struct('form', '{form}', 'n', i, 'gap', length(x.gaps[i]), 'value', v, "
            "'before', right(x.gaps[i], 48), 'after', left(x.gaps[i + 1], 2))))[0]")
    return f"coalesce(CASE WHEN text RLIKE {p} THEN {hits} END, CAST(array() AS {_SPAN}))"


def candidates(docs: DataFrame) -> DataFrame:
    """(row, doc_id, spans) of every row of ``docs``; spans has every match of every form, null where there is none."""
    found = "concat(" + ", ".join(_found(form, pattern) for form, _, pattern in FORMS) + ")"
    return (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .withColumn("spans", F.expr(f"CASE WHEN text RLIKE {ABLE} THEN {found} END")).drop("text")
            .withColumn("row", F.monotonically_increasing_id()))


def _luhn(digits: str) -> str:
    """Sum of the digits, every second from the right doubled and reduced, ends in 0."""
    return (f"aggregate(transform(sequence(1, greatest(length({digits}), 1)), i -> "
            f"CASE WHEN (length({digits}) - i) % 2 = 1 THEN element_at(array(0,2,4,6,8,1,3,5,7,9), cast(concat('0', substr({digits}, i, 1)) AS int) + 1) "
            f"ELSE cast(concat('0', substr({digits}, i, 1)) AS int) END), 0, (a, b) -> a + b) % 10 = 0")


def located(scanned: DataFrame) -> DataFrame:
    """A row per candidate: row, form, kind, value, start and end in code points, base (a base kind that passes its test)."""
    w = Window.partitionBy("row", "form").orderBy("n")
    c = scanned.select("row", F.explode("spans").alias("s")).select("row", "s.*").withColumn("size", F.length("value"))
    upto = F.sum(F.col("gap") + F.col("size")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    kinds = F.create_map(*[F.lit(x) for form, kind, _ in FORMS for x in (form, kind)])
    digits = F.regexp_replace("value", "[^0-9]", "")
    part = "CASE WHEN length(trim(LEADING '0' FROM p)) > 3 THEN 999 ELSE cast(concat('0', p) AS int) END"
    part = part.replace("concat('0', p)", "concat('0', trim(LEADING '0' FROM p))")
    ok = F.expr(f"""CASE form WHEN 'email' THEN true
        WHEN 'ip' THEN forall(split(value, '[.]'), p -> {part} <= 255)
        WHEN 'card' THEN length(digits) BETWEEN 12 AND 19 AND {_luhn('digits')}
        WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15 ELSE false END""")
    return (c.withColumn("end", upto).withColumn("start", F.col("end") - F.col("size")).withColumn("digits", digits)
            .withColumn("kind", kinds[F.col("form")]).withColumn("base", ok))


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return (out.when(no, -1) if no is not None else out).otherwise(0)


def labelled(spans: DataFrame) -> DataFrame:
    """Adds the five votes and the 0/1 features of the final classifier (``f_*``)."""
    form, value, digits = F.col("form"), F.col("value"), F.col("digits")
    based = form.isin(*BASE)
    domain = F.lower(F.regexp_extract("value", r"(?<![A-Za-z])([A-Za-z]++)$", 1))
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    first = F.regexp_extract("value", r"^[0-9]{1,3}", 0)
    gone = first.isin("0", "10", "127", "255")
    glued = F.col("before").rlike(r"[\p{L}\p{N}]$") | F.col("after").rlike(r"^[\p{L}\p{N}]")
    votes = {
        "strict": _vote(F.col("base") | form.isin("key", "national") | (form.isin("assigned", "account") & mixed), based & ~F.col("base")),
        "listed": F.when(form.isin("email", "spelt_email"), _vote(domain.isin(*DOMAINS.split()), ~domain.isin(*DOMAINS.split())))
        .when(form == "card", _vote(digits.rlike(ISSUERS), ~digits.rlike(ISSUERS)))
        .when(form == "phone", _vote(value.rlike(CALLING), ~value.rlike(CALLING)))
        .when(form == "ip", _vote(F.lit(False), gone)).when(F.col("kind") == "secret", 1).otherwise(0),
        "before_for": _vote(F.col("before").rlike(_any_word(SPEAK_FOR))),
        "before_against": _vote(F.lit(False), F.col("before").rlike(_any_word(SPEAK_AGAINST))),
        "edges": _vote(~glued, glued),
    }
    size = F.length("digits")
    features = {f"f_{name}": form == name for name, _, _ in FORMS} | {
        "f_base": F.col("base"), "f_few": size < 9, "f_many": size > 19, "f_parted": value.rlike(r"[0-9][\x20().-]+[0-9]"),
        "f_mixed": mixed, "f_glued": glued, "f_for": F.col("before").rlike(_any_word(SPEAK_FOR)),
        "f_against": F.col("before").rlike(_any_word(SPEAK_AGAINST)), "f_one_digit": digits.rlike(r"^(\d)\1+$")}
    return spans.select("*", *[v.alias(k) for k, v in votes.items()], *[F.coalesce(v, F.lit(False)).cast("double").alias(k) for k, v in features.items()])


def reliabilities(patterns: list[tuple]) -> tuple[dict[str, float], dict]:
    """EM over (form, five votes, count): the share of true spans by form, and for each labeler P(vote | true or false).

    Starts from the majority vote; one pseudo-count keeps every rate above 0. No patterns give empty shares.
    """
    belief = {p[:-1]: 1 / (1 + math.exp(-sum(p[1:-1]))) for p in patterns}
    share: dict[str, float] = {}
    rate: dict = {}
    for _ in range(ROUNDS if patterns else 0):
        total, true = {}, {}
        seen = {(j, y, v): 1.0 for j in range(len(VOTES)) for y in (0, 1) for v in (-1, 0, 1)}
        for *key, n in patterns:
            b, form = belief[tuple(key)], key[0]
            total[form] = total.get(form, 2.0) + n
            true[form] = true.get(form, 1.0) + n * b
            for j, v in enumerate(key[1:]):
                seen[j, 1, v] += n * b
                seen[j, 0, v] += n * (1 - b)
        share = {f: true[f] / total[f] for f in total}
        rate = {(j, y, v): x / sum(seen[j, y, u] for u in (-1, 0, 1)) for (j, y, v), x in seen.items()}
        for key in belief:
            odds = math.log(share[key[0]] / (1 - share[key[0]])) + sum(math.log(rate[j, 1, v] / rate[j, 0, v]) for j, v in enumerate(key[1:]))
            belief[key] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
    return share, rate


def _belief(share: dict, rate: dict) -> Column:
    """The labelers' joint verdict as an expression of their votes."""
    prior = F.create_map(*[F.lit(x) for f, s in share.items() for x in (f, math.log(s / (1 - s)))])[F.col("form")]
    says = [reduce(lambda c, v, j=j: c.when(F.col(name) == v, math.log(rate[j, 1, v] / rate[j, 0, v])), (0, 1), F.when(F.col(name) == -1, math.log(rate[j, 1, -1] / rate[j, 0, -1])))
            for j, name in enumerate(VOTES)]
    return F.lit(1.0) / (1 + F.exp(-(prior + sum(says, F.lit(0.0)))))


def classified(spans: DataFrame) -> DataFrame:
    """Adds ``p``: the final classifier's probability that a candidate is personal data."""
    votes = stage(labelled(spans), "votes")
    patterns = votes.groupBy("form", *VOTES).count().collect()  # len(FORMS) * 3**5 rows at most
    if not patterns:
        return votes.withColumn("p", F.lit(0.0))
    share, rate = reliabilities([tuple(r) for r in patterns])
    features = [c for c in votes.columns if c.startswith("f_")]
    soft = votes.withColumn("q", _belief(share, rate)).groupBy(*features).agg(F.sum("q").alias("yes"), F.sum(1 - F.col("q")).alias("no"))
    rows = soft.select(*features, F.expr("stack(2, 1.0D, yes, 0.0D, no) AS (label, weight)"))
    model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=50, standardization=False).fit(
        VectorAssembler(inputCols=features, outputCol="features").transform(stage(rows, "soft-labels")))
    z = sum((float(c) * F.col(f) for c, f in zip(model.coefficients, features)), F.lit(float(model.intercept)))
    return votes.withColumn("p", F.lit(1.0) / (1 + F.exp(-z)))


def spans(docs: DataFrame, threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(rows, spans). rows: (row, doc_id) of every row of ``docs``. spans: (row, kind, start, end, base, p) of what is kept.

    Positions count code points, the end is exclusive. Null and empty texts have no spans; repeated rows and rows without an id
    are rows like any other; other columns are not read.
    """
    scanned = stage(candidates(docs), "candidates")
    found = classified(located(scanned))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    kept = found.filter(F.col("base") | (~F.col("form").isin(*BASE) & (F.col("p") >= threshold))).withColumn("order", order)
    # Base spans of different kinds may overlap; an added one may not touch them, nor an added one that begins before it.
    by_start = Window.partitionBy("row").orderBy("start", "order", "end")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    free = kept.withColumn("clear", F.col("base") | ((F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))))
    added = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    final = free.filter("clear").withColumn("last", added).filter(F.col("base") | (F.coalesce("last", F.lit(0)) <= F.col("start")))
    return scanned.select("row", "doc_id"), final.select("row", "kind", "order", "start", "end", "base", "p")


def _listed(when: Column | None = None) -> Column:
    s = F.struct("start", "order", "end", "kind")
    return F.transform(F.array_sort(F.collect_list(F.when(when, s) if when is not None else s)),
                       lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))


def op5_pii(spark, sf_dir) -> DataFrame:
    rows, found = spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    per_row = found.groupBy("row").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE],
        F.concat_ws(",", _listed(F.col("base"))).alias("listed"), F.concat_ws(",", _listed()).alias("spans"))
    return (rows.join(per_row, "row", "left")
            .select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in BASE],
                    F.sha2(F.coalesce("listed", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans")))


def redacted(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; all columns stay, n_chars follows the text.

    Rows are matched by id and text, so repeated ids do no harm. Where spans overlap, the union is replaced once, by the kind
    that begins first. Rows without spans stay as they are, null texts stay null. Only texts that may hold a candidate are shuffled.
    """
    keyed = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "to-redact")
    able = F.coalesce(F.expr(f"text RLIKE {ABLE}"), F.lit(False))
    rows, found = spans(keyed.filter(able).select(F.col("__row").alias("doc_id"), "text"), threshold)
    w = Window.partitionBy("row").orderBy("start", "order", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = (found.withColumn("begins", (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int"))
            .withColumn("run", F.sum("begins").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("row", "run").agg(F.min(F.struct("start", "order", "kind")).alias("s"), F.max("end").alias("end"))
            .groupBy("row").agg(F.array_sort(F.collect_list(F.struct(F.col("s.start").alias("start"), "end", F.col("s.kind").alias("kind")))).alias("cuts")))
    cuts = rows.join(runs, "row").select(F.col("doc_id").alias("__row"), F.col("cuts").alias("__cuts"))
    # Pieces between the cuts, each followed by its cut's kind; the last piece runs to the end of the text.
    pieces = F.expr("""concat(array_join(transform(__cuts, (c, i) -> concat(
        substring(text, CASE WHEN i = 0 THEN 1 ELSE cast(element_at(__cuts, i).end AS int) + 1 END,
                  cast(c.start - CASE WHEN i = 0 THEN 0 ELSE element_at(__cuts, i).end END AS int)),
        '[', upper(c.kind), ']')), ''), substring(text, cast(element_at(__cuts, -1).end AS int) + 1))""")
    text = F.when(F.col("__cuts").isNull(), F.col("text")).otherwise(pieces)
    out = keyed.filter(able).join(cuts, "__row", "left").withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__cuts").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return keyed.filter(~able).select(*columns).unionByName(out.select(*columns))
