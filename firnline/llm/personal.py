"""Personal data in texts by weak supervision, in DataFrame functions only.

Candidates are the spans of a pattern per kind. Labelers vote on each (personal, not, no
opinion): a stricter pattern, a gazetteer, the words before it, the spread of its digits.
Candidates that look alike are counted together, which leaves a table bounded by the number of
vote patterns and feature values whatever the corpus; on it expectation-maximisation
estimates how reliable each labeler is for each kind, and its posteriors train a
naive Bayes classifier of spans. Both small models go back into the plan as literals, and a second
pass over the texts marks the spans row by row: no text is ever shuffled.

Spans of the four base kinds are fixed by their patterns and checks and always stay; the
classifier decides on the candidates of the other kinds.
"""

import math
from collections import defaultdict
from functools import partial

from pyspark.sql import functions as F

# The patterns match what the plain forms in PLAIN match, written so that no match takes
# more than one look at a character: long runs neither backtrack nor recurse.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])[A-Za-z0-9-][A-Za-z0-9.-]*?(?=\.\.|\.?(?![A-Za-z0-9.-]))",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9 -]*?(?=[ -]{2}|[ -]?(?![0-9 -]))",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Given names, titles, mail hosts, country codes.
NAMES = "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica Thomas Sarah Anna Maria Hans Peter Klaus Ursula Pierre Marie Jean Sophie Carlos Carmen Luis Ana"
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame"
MAIL_HOSTS = "gmail hotmail yahoo outlook icloud proton gmx web mail"
COUNTRIES = "AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT SE SK"
FIRST = "".join(sorted({n[0] for n in f"{NAMES} {TITLES}".split()}))
EXTRA = {
    "name": rf"(?=[{FIRST}])\b(?:(?:{'|'.join(TITLES.split())})\.? |(?:{'|'.join(NAMES.split())}) )[A-Z][a-zà-ÿ]{{2,20}}+(?: [A-Z][a-zà-ÿ]{{2,20}}+)?+",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,64}|AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36})(?![A-Za-z0-9])",
}
KINDS = {**BASE, **EXTRA}
#: What a text must contain for a pattern to be tried at all.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "name": " ", "ssn": "-", "iban": None, "secret": None}
CUES = {
    "email": ("mail|contact|write|address", "sample"), "ip": ("ip|host|server|address|client", "version|release|v$"), "card": ("card|visa|master|credit|pay", "order|isbn|serial"),
    "phone": ("tel|phone|call|mobile|fax", "order|isbn"), "name": ("dear|by|from|name|contact", "street|saint"), "ssn": ("ssn|social|security", "part|model|order"),
    "iban": ("iban|account|bank", "part|model"), "secret": ("token|key|secret|password|passwd|auth", "commit|sha|md5|checksum"),
}
STRICT = {
    "email": r"^[A-Za-z0-9][^@]{0,63}@[^@]*\.[A-Za-z]{2,24}$", "ip": r"^(?:(?:0|[1-9][0-9]*)\.){3}(?:0|[1-9][0-9]*)$", "card": r"^[3-6]", "phone": r"^\+[1-9]",
    "name": r" [A-Z]", "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)", "iban": r"^[A-Z]{2}(?!00)", "secret": r"(?=.*[0-9])(?=.*[A-Za-z])",
}
GAZETTEER = {
    "email": rf"@(?:.*\.)?(?:{'|'.join(MAIL_HOSTS.split())}|example)[0-9]*\.", "ip": r"^(?:10|127|192|172)\.", "card": r"^(?:4|5[1-5]|3[47]|6011)", "phone": r"^\+(?:1|33|34|39|41|43|44|49)",
    "name": rf"(?:{'|'.join(NAMES.split())})", "ssn": "^$", "iban": rf"^(?:{'|'.join(COUNTRIES.split())})", "secret": r"^(?:AKIA|ghp_)",
}
LABELERS = ("strict", "gazetteer", "context", "spread")
FEATURES = ("size", "ahead", "behind", "digits")
MARK, OTHER = "\u0001", "\u0002"
BLOCK = 256


def _pieces(text, kind):
    """The text cut at the matches: every second piece is one."""
    marked = F.split(F.regexp_replace(text, KINDS[kind], f"{MARK}$0{MARK}"), MARK)
    return F.when(F.contains(text, F.lit(NEEDS[kind])), marked) if NEEDS[kind] else F.when(F.rlike(text, F.lit("[0-9]")), marked)


def _starts(pieces):
    """Start of each piece in code points; summed in blocks, so that many matches stay cheap."""
    zero = F.lit(0).cast("long")
    one = lambda block, at: F.aggregate(
        block, F.struct(at.alias("at"), F.array().cast("array<bigint>").alias("out")),
        lambda s, x: F.struct((s["at"] + F.length(x)).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))["out"]
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / BLOCK).cast("int")), lambda b: F.slice(pieces, b * BLOCK + 1, F.lit(BLOCK)))
    with_at = F.aggregate(
        blocks, F.struct(zero.alias("at"), F.array().cast("array<struct<at:bigint,block:array<string>>>").alias("out")),
        lambda s, b: F.struct(
            F.aggregate(b, s["at"], lambda t, x: t + F.length(x)).alias("at"),
            F.concat(s["out"], F.array(F.struct(s["at"].alias("at"), b.alias("block")))).alias("out")))["out"]
    return F.flatten(F.transform(with_at, lambda b: one(b["block"], b["at"])))


def _valid(kind, hit):
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(hit, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.concat(F.lit("0"), F.substring(part(p), 1, 3)).cast("int") <= 255))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "card":
        twice = lambda d, i: F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)
        each = F.split(F.reverse(digits), "")
        luhn = F.aggregate(F.transform(F.filter(each, lambda d: d != ""), lambda d, i: twice(d.cast("int"), i)), F.lit(0), lambda s, d: s + d)
        return F.when(F.length(digits).between(13, 19), luhn % 10 == 0).otherwise(F.lit(False))
    return F.lit(True)


def _hit(pieces, starts):
    """Piece i as a match with its surroundings."""
    return lambda i: F.struct(
        F.get(starts, i).alias("start"), (F.get(starts, i) + F.length(F.get(pieces, i))).alias("end"), F.get(pieces, i).alias("hit"),
        F.lower(F.substring(F.get(pieces, i - 1), -30, 30)).alias("before"), F.substring(F.get(pieces, i + 1), 1, 1).alias("after"))


def _checked(kind):
    return lambda x: _valid(kind, x["hit"])


def _spans(docs):
    """``docs`` (text first made null-free) with an array _span_<kind> of matches per kind; only _pii_ columns are added."""
    text = F.coalesce(docs["text"], F.lit(""))
    docs = docs.withColumn("_pii_text", F.when(F.contains(text, F.lit(MARK)), F.translate(text, MARK, OTHER)).otherwise(text))
    docs = docs.withColumns({f"_pii_p_{k}": _pieces(F.col("_pii_text"), k) for k in KINDS})
    docs = docs.withColumns({f"_pii_s_{k}": F.when(F.size(f"_pii_p_{k}") > 1, _starts(F.col(f"_pii_p_{k}"))) for k in KINDS})
    out = {}
    for k in KINDS:
        p, s = F.col(f"_pii_p_{k}"), F.col(f"_pii_s_{k}")
        hits = F.filter(F.transform(F.sequence(F.lit(1), F.size(p) - 2, F.lit(2)), _hit(p, s)), _checked(k))
        out[f"_pii_{k}"] = F.when(F.size(p) > 1, hits)
    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:string,before:string,after:string>>")
    docs = docs.withColumns(out)
    return docs.withColumns({c: F.coalesce(c, none) for c in out}).drop(*[f"_pii_{x}_{k}" for x in "ps" for k in KINDS])


def _seen(kind, x):
    """Votes (1, -1, 0) and features of one span."""
    yes, no = CUES[kind]
    hit, before = x["hit"], x["before"]
    digits = F.regexp_replace(hit, "[^0-9]", "")
    different = F.size(F.array_distinct(F.split(F.substring(digits, 1, 20), "")))
    share = F.floor(F.length(digits) * 3 / F.length(hit)).cast("int")
    kind_of = lambda c: F.when(c == "", 0).when(F.rlike(c, F.lit(r"\s")), 1).when(F.rlike(c, F.lit(r"[\w]")), 2).otherwise(3)
    return {
        "strict": F.when(F.rlike(hit, F.lit(STRICT[kind])), 1).otherwise(-1),
        "gazetteer": F.when(F.rlike(hit, F.lit(GAZETTEER[kind])), 1).otherwise(0),
        "context": F.when(F.rlike(before, F.lit(rf"(?:{yes})\W*$")), 1).when(F.rlike(before, F.lit(rf"(?:{no})\W*$")), -1).otherwise(0),
        "spread": F.when(F.length(digits) < 4, 0).when(different <= 3, -1).otherwise(1),
        "size": F.least(F.floor(F.length(hit) / 8), F.lit(6)).cast("int"),
        "ahead": kind_of(F.substring(before, -1, 1)),
        "behind": kind_of(x["after"]),
        "digits": share,
    }


def _row(kind, x):
    return F.struct(F.lit(kind).alias("kind"), *[v.cast("int").alias(n) for n, v in _seen(kind, x).items()])


def _counts(docs):
    """How often each combination of kind, votes and features occurs: a table bounded by their values."""
    marked = _spans(docs.select("text"))
    cands = F.flatten(F.array(*[
        F.transform(f"_pii_{k}", partial(_row, k)) for k in KINDS]))
    rows = marked.select(F.explode(cands).alias("c")).select("c.*")
    return rows.groupBy("kind", *LABELERS, *FEATURES).agg(F.count("*").alias("n"))


def reliabilities(patterns, rounds=60):
    """EM over (kind, votes) -> count: posterior of each pattern, and each labeler's chance of each vote.

    Starts from the majority; a labeler is taken as right in 0.8 of ten votes to begin with.
    """
    kinds = {k for k, _ in patterns}
    post = {p: 0.5 + 0.4 * max(-1, min(1, sum(p[1]))) for p in patterns}
    prior, like = {}, {}
    for _ in range(rounds):
        for k in kinds:
            own = [(p, n) for p, n in patterns.items() if p[0] == k]
            n_all = sum(n for _, n in own)
            prior[k] = (sum(post[p] * n for p, n in own) + 1) / (n_all + 2)
            for i in range(len(LABELERS)):
                for y in (0, 1):
                    mass = defaultdict(float, {(1 if y else -1): 8.0, (-1 if y else 1): 2.0, 0: 5.0})
                    for p, n in own:
                        mass[p[1][i]] += n * (post[p] if y else 1 - post[p])
                    total = sum(mass.values())
                    for v in (-1, 0, 1):
                        like[k, i, v, y] = mass[v] / total
        for p in patterns:
            k, votes = p
            odds = math.log(prior[k] / (1 - prior[k])) + sum(math.log(like[k, i, v, 1] / like[k, i, v, 0]) for i, v in enumerate(votes))
            post[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post, like


def train(docs):
    """Weights of the span classifier, {(kind, feature, value): log odds}; (kind, '', 0) is the kind's own."""
    rows = [r.asDict() for r in _counts(docs).collect()]  # bounded: kinds x votes x feature values
    patterns = defaultdict(int)
    for r in rows:
        patterns[r["kind"], tuple(r[v] for v in LABELERS)] += r["n"]
    post, _ = reliabilities(dict(patterns))
    mass = defaultdict(lambda: [0.0, 0.0])
    names = (*LABELERS, *FEATURES)
    for r in rows:
        p = post[r["kind"], tuple(r[v] for v in LABELERS)]
        for name, value in (("", 0), *((n, r[n]) for n in names)):
            mass[r["kind"], name, value][0] += r["n"] * p
            mass[r["kind"], name, value][1] += r["n"] * (1 - p)
    values = defaultdict(int)
    for k, n, _ in mass:
        values[k, n] += 1
    out = {}
    for (k, n, v), (yes, no) in mass.items():
        if not n:
            out[k, n, v] = math.log((yes + 1) / (no + 1))
            continue
        own, m = mass[k, "", 0], values[k, n]
        out[k, n, v] = math.log((yes + 1) / (own[0] + m) * (own[1] + m) / (no + 1))
    return out


def _keep(kind, weights, x):
    score = F.lit(weights[kind, "", 0])
    for name, value in _seen(kind, x).items():
        for (k, n, v), w in sorted(weights.items()):
            if (k, n) == (kind, name):
                score = score + F.when(value == v, w).otherwise(0.0)
    return score >= 0


def _chosen(weights):
    """Expressions for the arrays of kept spans per kind; a kind without candidates has none."""
    known = {k for k, n, _ in weights if not n}
    return {k: F.filter(f"_pii_{k}", partial(_keep, k, weights)) if k in EXTRA and k in known else F.col(f"_pii_{k}") for k in KINDS}


def _named(kind, x):
    return F.concat(F.lit(kind + ":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))


def _placed(kind, x):
    return F.struct(x["start"].alias("start"), (-x["end"]).alias("stop"), F.lit(kind.upper()).alias("kind"))


def _listed(spans, kinds):
    return F.array_join(F.concat(*[F.transform(spans[k], partial(_named, k)) for k in kinds]), ",")


def find(docs):
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row of ``docs``.

    Spans are kind:start:end in code points, ends exclusive, by kind (email, ip, card, phone, name, ssn,
    iban, secret) and start. Null and empty texts have none (the digest is that of the empty
    string). Every row stands for itself, repeated ones alike and null doc_id as any; an
    empty table gives no rows; other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    spans = _chosen(train(docs))
    out = _spans(docs).select("doc_id", *[spans[k].alias(f"_pii_{k}") for k in KINDS])
    done = {k: F.col(f"_pii_{k}") for k in KINDS}
    return out.select(
        "doc_id", *[F.size(done[k]).cast("long").alias(f"n_{k}") for k in BASE], F.sha2(_listed(done, BASE).cast("binary"), 256).alias("base_sha256"), _listed(done, KINDS).alias("spans"))


def mask(docs):
    """``docs`` with each span replaced by its kind in brackets; overlapping spans become one, named after the first.

    Columns as they are, null texts stay null; n_chars, if there, is that of the new text.
    """
    spans = _chosen(train(docs))
    out = _spans(docs)
    every = F.concat(*[F.transform(spans[k], partial(_placed, k)) for k in KINDS])
    out = out.withColumn("_pii_all", F.array_sort(every))
    text = F.col("text")
    between = lambda s, x: F.substr(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))
    step = lambda s, x: F.struct(
        F.greatest(s["at"], -x["stop"]).alias("at"),
        F.when(x["start"] >= s["at"], F.concat(s["out"], F.array(between(s, x), F.concat(F.lit("["), x["kind"], F.lit("]"))))).otherwise(s["out"]).alias("out"))
    made = F.aggregate("_pii_all", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out")), step)
    out = out.withColumn("_pii_made", F.when(F.size("_pii_all") > 0, made))
    rest = F.substr(text, (F.col("_pii_made.at") + 1).cast("int"), F.length(text))
    out = out.withColumn("text", F.when(F.size("_pii_all") > 0, F.concat(F.array_join("_pii_made.out", ""), rest)).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("_pii_all") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
