"""Operator 6, personal data by weak supervision, in DataFrame expressions only.

Base spans are what the four fixed patterns find. Candidates are what wider
patterns find besides (addresses written with "(at)", phone numbers without a plus,
card-like digit groups, colon addresses). Three labelers vote on every span, base or
candidate: one on its form, one on lists of known endings and prefixes, one on the
words around it. Expectation-maximisation over the counts of vote patterns (a table
whose size does not depend on the data) estimates how far each labeler is right; the
posteriors are the soft labels on which the final span classifier, a logistic model over
votes and shape, is trained. Candidates it accepts are added; base spans stay.

Positions come from the pieces between matches: the pattern splits the text and
lists its matches, and a span starts after all pieces and matches before it. Work is
linear in the text. Patterns use possessive loops, which match the same here as no
part after a loop could take its last character, so long runs neither recurse nor go back.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolake.llm.common import fresh
from annolake.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9            # least probability of a span that is added
EM_ROUNDS = 50
FIT_STEPS = 300

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# An address is looked for where a run of local characters begins or the last match ended: from within a run nothing else can match.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# The base pattern comes first in each, so that no candidate lies inside a base match of its kind.
WIDE = {
    "email": rf"(?i){BASE['email']}|(?<!{_LOCAL}){_LOCAL}{{1,64}}+ ?(?:\(at\)|\[at\]|\{{at\}}) ?{_LABEL}{{1,63}}+(?: ?(?:\.|\(dot\)|\[dot\]) ?{_LABEL}{{1,63}}+){{1,8}}+",
    "ip": rf"{BASE['ip']}|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{{1,4}}:){{7}}[0-9A-Fa-f]{{1,4}}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9.])[0-9]{4}([.\x20_/-])[0-9]{4}\1[0-9]{4}\1[0-9]{2,4}(?![0-9])",
    "phone": rf"{BASE['phone']}|(?<![0-9(+.-])\(?[0-9]{{3}}\)?[ .-][0-9]{{3}}[ .-][0-9]{{4}}(?![0-9.-])",
}
_BYTE = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?"
ENDINGS = ("com", "org", "net", "edu", "gov", "io", "info", "biz", "de", "fr", "es", "uk", "it", "nl", "ch", "at", "be", "eu", "us", "ca", "mx")
CUES = {
    "email": "mail|contact|kontakt|correo|courriel|write to|escrib|adresse|schreib",
    "ip": r"\bip\b|address|host|server|login|adresse|client|direcci",
    "card": "card|visa|master|amex|payment|credit|karte|carte|tarjeta|zahl",
    "phone": "phone|tel|call|mobile|cell|fax|whatsapp|telefon|anruf|appel|llam|portable",
}
AGAINST = r"version|isbn|order|invoice|page|build|sku|serial|figure|doi|item|ticket|[$€£%#=]"
_SPAN = "array<struct<s:int,k:int,e:int,base:boolean,form:int,list:int,words:int,size:int,marks:int>>"


def _found(text: Column, pattern: str, gate: Column) -> Column:
    """The matches of a pattern, each with the lengths and texts needed to place it and judge it."""
    m = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    p = F.split(text, pattern, -1)
    rows = F.zip_with(F.zip_with(p, m, lambda a, b: F.struct(
        F.length(a).alias("gap"), F.length(b).alias("len"), b.alias("m"), F.lower(F.right(a, F.lit(40))).alias("before"))),
        F.slice(p, 2, F.greatest(F.lit(1), F.size(p))), lambda x, n: F.struct(
            x["gap"].alias("gap"), x["len"].alias("len"), x["m"].alias("m"), x["before"].alias("before"),
            F.lower(F.left(n, F.lit(20))).alias("after")))
    kind = "array<struct<gap:int,len:int,m:string,before:string,after:string>>"
    return F.when(gate, F.filter(rows, lambda x: x["m"].isNotNull())).otherwise(F.array().cast(kind)).cast(kind)


def _placed(col: str) -> str:
    """SQL: the rows of ``_found`` with start and end. They are placed in blocks of 200 rows, each carrying on where the
    one before ended, so that a text of very many matches costs little more than their number."""
    kind = "array<struct<s:int,e:int,m:string,before:string,after:string>>"
    step = ("(a, x) -> named_struct('p', a.p + x.gap + x.len, 'o', concat(a.o, array(named_struct("
            "'s', a.p + x.gap, 'e', a.p + x.gap + x.len, 'm', x.m, 'before', x.before, 'after', x.after))))")
    block = (f"aggregate(slice({col}, 200 * c + 1, 200), named_struct('p', b.p, 'o', cast(array() as {kind})), {step})")
    return (f"if(size({col}) = 0, cast(array() as {kind}), flatten(aggregate(sequence(0, cast((size({col}) - 1) div 200 as int)), "
            f"named_struct('p', 0, 'o', cast(array() as array<{kind}>)), (b, c) -> element_at(transform(array({block}), "
            f"i -> named_struct('p', i.p, 'o', concat(b.o, array(i.o)))), 1)).o))")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _valid(kind: str, m: Column) -> Column:
    """The base test of a match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    d = _digits(m)
    if kind == "card":
        return F.length(d).between(14, 19) & F.call_function("luhn_check", d)
    return F.length(d).between(10, 15)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(kind: str, r: Column) -> tuple[Column, Column, Column]:
    """Votes of the three labelers: 1 personal data, -1 not, 0 no opinion."""
    m, d = r["m"], _digits(r["m"])
    if kind == "email":
        form = _vote(m.rlike(r"(?i)(?:\.|dot[)\]] ?)[a-z]{2,24}$"), m.rlike(r"[0-9]$"))
        known = _vote(m.rlike(rf"(?i)[^a-z](?:{'|'.join(ENDINGS)})$"), F.lit(False))
    elif kind == "ip":
        form = _vote(m.contains(":") | _valid("ip", m), ~m.contains(":"))
        known = _vote(m.rlike("^(?:1?[0-9]?[0-9]|2[0-4][0-9])\\.") | m.rlike("(?i)^(?:2|3|fd|fe8)"), m.rlike("^0+[.:]"))
    elif kind == "card":
        form = _vote(F.length(d).between(14, 19) & F.call_function("luhn_check", d), F.lit(True))
        known = _vote(d.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)"), F.lit(True))
    else:
        form = _vote(F.length(d).between(10, 15), F.lit(True))
        known = _vote(m.startswith("+") | d.rlike("^[2-9][0-9]{2}[2-9]"), d.rlike("^[01]"))
    around = F.concat(r["before"], F.lit(" "), r["after"])
    words = _vote(around.rlike(CUES[kind]), around.rlike(AGAINST))
    return form, known, words


def _spans(kind: str, rows: Column, base: bool) -> Column:
    k = KINDS.index(kind)

    def one(r):
        form, known, words = _votes(kind, r)
        return F.struct(r["s"].alias("s"), F.lit(k).alias("k"), r["e"].alias("e"), F.lit(base).alias("base"),
                        form.alias("form"), known.alias("list"), words.alias("words"),
                        F.least(F.lit(4), ((r["e"] - r["s"]) / 8).cast("int")).alias("size"),
                        F.least(F.lit(4), F.length(F.regexp_replace(r["m"], "[A-Za-z0-9]", ""))).alias("marks"))

    if base:
        return F.transform(F.filter(rows, lambda r: _valid(kind, r["m"])), one).cast(_SPAN)
    # what matches the base pattern is either a base span or was dropped for good
    return F.transform(F.filter(rows, lambda r: ~r["m"].rlike(f"^(?:{BASE[kind]})$")), one).cast(_SPAN)


def find_spans(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with ``out``: the base spans and candidates of each text, with votes and shape."""
    names = fresh(docs, *[f"_{k}{w}" for k in KINDS for w in "bw"])
    t = F.coalesce(F.col(text), F.lit(""))
    digit = t.rlike("[0-9]")
    gates = {"email": (t.contains("@"), t.contains("@") | t.rlike(r"(?i)[(\[{]at[)\]}]")), "ip": (digit, digit | t.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]")),
             "card": (digit, digit), "phone": (t.contains("+"), digit)}
    found = {n: _found(t, p[k], gates[k][i]) for n, (k, i, p) in zip(names, [(k, i, p) for k in KINDS for i, p in ((0, BASE), (1, WIDE))])}
    d = docs.select("*", *[c.alias(n) for n, c in found.items()])
    d = d.select(*docs.columns, *[F.expr(_placed(f"`{n}`")).alias(n) for n in names])
    spans = [_spans(k, F.col(n), i == 0) for n, (k, i) in zip(names, [(k, i) for k in KINDS for i in (0, 1)])]
    return d.select(*docs.columns, F.array_sort(F.concat(*spans)).alias(out))


def estimate(patterns: list[tuple], rounds: int = EM_ROUNDS) -> list[float]:
    """Posterior of each row (kind, base, form, list, words, ..., count): a Dawid-Skene model with three labelers,
    three votes, two classes, a class share by kind, add-one smoothed; it starts from the majority of votes."""
    post = [min(0.9, max(0.1, 0.5 + 0.2 * (r[2] + r[3] + r[4]))) for r in patterns]
    for _ in range(rounds):
        theta = [[[1.0] * 3, [1.0] * 3] for _ in range(3)]
        share = {k: [1.0, 1.0] for k in range(len(KINDS))}
        for r, p in zip(patterns, post):
            for y, q in ((1, p), (0, 1 - p)):
                share[r[0]][y] += q * r[-1]
                for lab in range(3):
                    theta[lab][y][r[2 + lab] + 1] += q * r[-1]
        new = []
        for r in patterns:
            z = [math.log(share[r[0]][y]) + sum(math.log(theta[a][y][r[2 + a] + 1] / sum(theta[a][y])) for a in range(3)) for y in (0, 1)]
            new.append(1 / (1 + math.exp(max(-700.0, min(700.0, z[0] - z[1])))))
        moved = max((abs(a - b) for a, b in zip(new, post)), default=0.0)
        post = new
        if moved < 1e-9:
            break
    return post


SHAPES = (("k", range(4)), ("form", (-1, 0, 1)), ("list", (-1, 0, 1)), ("words", (-1, 0, 1)), ("size", range(5)), ("marks", range(5)))


def fit(spans: DataFrame, col: str) -> dict[tuple[str, int], float]:
    """Weights of the final classifier, by (feature, value). The driver sees counts of feature
    patterns only: at most 4 * 2 * 27 * 25 rows whatever the input."""
    s = spans.select(F.explode(col).alias("x")).select("x.*")
    keys = ["k", "base", "form", "list", "words", "size", "marks"]
    rows = sorted(tuple(r) for r in s.groupBy(*keys).count().collect())
    post = estimate(rows)
    at = {"k": 0, "form": 2, "list": 3, "words": 4, "size": 5, "marks": 6}
    w = {(n, v): 0.0 for n, vs in SHAPES for v in vs} | {("bias", 0): 0.0}
    total = sum(r[-1] for r in rows) or 1
    for _ in range(FIT_STEPS):
        g = dict.fromkeys(w, 0.0)
        for r, p in zip(rows, post):
            on = [("bias", 0), *[(n, r[at[n]]) for n in at]]
            d = (p - 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w[x] for x in on)))))) * r[-1] / total
            for x in on:
                g[x] += d
        w = {x: v + 2.0 * (g[x] - 1e-4 * v) for x, v in w.items()}
    return w


def _accepted(x: Column, w: dict[tuple[str, int], float], accept: float) -> Column:
    z = F.lit(w["bias", 0])
    for n, vs in SHAPES:
        part = F.lit(0.0)
        for v in vs:
            part = F.when(x[n] == v, w[n, v]).otherwise(part)
        z = z + part
    # a form that its own labeler rejects is never added
    return x["base"] | ((x["form"] > 0) & (z >= math.log(accept / (1 - accept))))


def _written(spans: Column) -> Column:
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kind, x["k"] + 1), x["s"], x["e"])), ",")


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row for each row of ``docs``.

    The counts and the digest are of base spans, ``spans`` of all. Null texts are empty; a text without
    spans has counts 0, the digest of the empty string and empty ``spans``. Repeated rows
    are repeated; an empty table gives an empty result; other columns are not read.
    The spans (not the texts) are written once and read for the estimate and for the result.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = cut_lineage(find_spans(d, "text", "_spans").drop("text"), "pii_spans")
    w = fit(found, "_spans")
    base = F.filter("_spans", lambda x: x["base"])

    def count(k: int) -> Column:
        return F.size(F.filter("_spans", lambda x: x["base"] & (x["k"] == k))).cast("long")

    n = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *n, F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"),
                        _written(F.filter("_spans", lambda x: _accepted(x, w, accept))).alias("spans"))


BLOCK = 1000


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", accept: float = ACCEPT) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets (overlapping spans by the kind of
    the first); a column ``n_chars``, if there, gets the new length. A null text stays null."""
    spans, parts = fresh(docs, "_spans", "_parts")
    w = fit(cut_lineage(find_spans(docs.select(text), text, spans).select(spans), "pii_spans"), spans)
    d = find_spans(docs, text, spans)
    d = d.withColumn(spans, F.filter(spans, lambda x: _accepted(x, w, accept)))
    merged = F.expr(f"""aggregate(`{spans}`, cast(array() as array<struct<s:int,k:int,e:int>>), (a, x) ->
        if(size(a) > 0 and x.s < element_at(a, -1).e,
           concat(slice(a, 1, size(a) - 1), array(named_struct('s', element_at(a, -1).s, 'k', element_at(a, -1).k, 'e', greatest(element_at(a, -1).e, x.e)))),
           concat(a, array(named_struct('s', x.s, 'k', x.k, 'e', x.e)))))""")
    d = d.withColumn(spans, merged)
    # the text in blocks, so that a stretch is cut out of a block and not out of the whole text again and again
    d = d.withColumn(parts, F.when(F.size(spans) > 0, F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))

    def stretch(a: str, b: str) -> str:
        p = f"`{parts}`"
        return (f"case when {a} >= {b} then '' when {a} div {BLOCK} = ({b} - 1) div {BLOCK} "
                f"then substring(get({p}, cast({a} div {BLOCK} as int)), {a} % {BLOCK} + 1, {b} - {a}) "
                f"else concat(substring(get({p}, cast({a} div {BLOCK} as int)), {a} % {BLOCK} + 1), "
                f"array_join(slice({p}, cast({a} div {BLOCK} as int) + 2, cast(({b} - 1) div {BLOCK} - {a} div {BLOCK} - 1 as int)), ''), "
                f"substring(get({p}, cast(({b} - 1) div {BLOCK} as int)), 1, ({b} - 1) % {BLOCK} + 1)) end")

    names = "array(" + ", ".join(f"'<{k.upper()}>'" for k in KINDS) + ")"
    ends = f"concat(array(0), transform(`{spans}`, x -> x.e))"
    new = (f"case when size(`{spans}`) = 0 then `{text}` else concat(array_join(zip_with(`{spans}`, slice({ends}, 1, size(`{spans}`)), (x, f) -> concat("
           f"{stretch('f', 'x.s')}, get({names}, x.k))), ''), coalesce(substring({stretch('element_at(`' + spans + '`, -1).e', 'length(`' + text + '`)')}, 1), '')) end")
    d = d.withColumn(text, F.expr(new))
    if n_chars and n_chars in docs.columns:
        d = d.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType))
    return d.select(*docs.columns)
