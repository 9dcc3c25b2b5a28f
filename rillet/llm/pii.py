"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans, checksums (Luhn, mod 97) and ranges confirm them,
and words nearby raise or lower a span's score. Spans are in code points, end
exclusive. The expressions are written so that no text makes them slow: possessive
quantifiers, and starts only where a run begins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]

_LOCAL = r"[A-Za-z0-9._%+-]"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

# The length of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}


def _iban_rest() -> str:
    """Country, check digits and the account: as many characters as the country's IBAN has, so a
    word behind it is no part of it; of other countries as many as come (15 to 34 in all)."""
    by_length: dict[int, list[str]] = {}
    for country, n in IBAN_LENGTHS.items():
        by_length.setdefault(n, []).append(country)
    known = "|".join(f"(?:{'|'.join(cs)})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, cs in sorted(by_length.items()))
    return f"(?:{known}|(?!{'|'.join(IBAN_LENGTHS)})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}}+)"


#: Proposals. Leftmost, non-overlapping and greedy as the plain forms would be:
#: a local part starts at the start of a run or where the last address ended, a
#: number where no digit stands before, a card where no digit and separator do. Looking
#: ahead for the first character is cheaper than looking behind at every place.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?=[0-9])(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": rf"(?=[A-Z]{{2}}[0-9]{{2}})(?<![A-Za-z0-9]){_iban_rest()}(?![A-Za-z0-9])",
    "ssn": r"(?=[0-9])(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}

#: Score before context, and words that raise it when they stand up to NEAR code points before.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
CONTEXT = {
    "email": r"e-?mail|mail|contact|write|address",
    "ip": r"\bip\b|host|server|address|login",
    "card": r"card|visa|credit|payment|pay",
    "phone": r"phone|call|tel|mobile|fax|contact",
    "iban": r"iban|account|bank|transfer|konto",
    "ssn": r"ssn|social security|security number",
}
AGAINST = r"version|release|isbn|order no|invoice no"
NEAR, RAISE, LOWER, LEAST = 48, 0.3, 0.2, 0.6
BLOCK = 256  # spans accumulated at a time, so that the work on n spans is far from n squared


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _mod97(hit: Column) -> Column:
    """Remainder of an IBAN's number: country and check digits last, letters as 10 to 35."""
    plain = F.translate(hit, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    code = F.transform(F.filter(F.split(turned, ""), lambda c: c != ""), lambda c: F.ascii(c))
    return F.aggregate(code, F.lit(0), lambda acc, c: F.when(c >= 65, (acc * 100 + c - 55) % 97)
                       .otherwise((acc * 10 + c - 48) % 97).cast("int"))


def _confirmed(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.call_function("luhn_check", _digits(hit))
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    if kind == "iban":
        return _mod97(hit) == 1
    if kind == "ssn":
        return ~hit.rlike(r"^(?:000|666|9..)|-00-|-0000$")
    return F.lit(True)


_SPAN = "struct<kind:string,start:bigint,end:bigint,score:double>"


def _placed(items: Column) -> Column:
    """Positions of ``items`` (gap, size, near, hit) laid one after another: (start, end, near, hit).

    Two levels: sums of blocks first, then the positions within each block.
    """
    n = F.size(items)
    starts = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int"))).otherwise(
        F.array().cast("array<int>"))

    def part(b):
        return F.slice(items, b * BLOCK + 1, F.lit(BLOCK))

    sums = F.transform(starts, lambda b: F.aggregate(part(b), F.lit(0).cast("long"),
                                                     lambda acc, x: acc + x["gap"] + x["size"]))
    offsets = F.aggregate(sums, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("all")),
                          lambda acc, s: F.struct((acc["at"] + s).alias("at"),
                                                  F.concat(acc["all"], F.array(acc["at"])).alias("all")))["all"]
    empty = F.array().cast("array<struct<start:bigint,end:bigint,near:string,hit:string>>")

    def place(b, at):
        return F.aggregate(
            part(b), F.struct(at.alias("at"), empty.alias("all")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["size"]).alias("at"),
                F.concat(acc["all"], F.array(F.struct(
                    (acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["size"]).alias("end"),
                    x["near"].alias("near"), x["hit"].alias("hit")))).alias("all")))["all"]

    return F.flatten(F.zip_with(starts, offsets, place))


def _items(text: Column, kind: str) -> Column:
    """What a pattern proposes: length of the text before (since the last proposal), of the
    hit, the text just before, and the hit."""
    pattern = F.lit(PATTERNS[kind])
    pieces, hits = F.split(text, PATTERNS[kind], -1), F.regexp_extract_all(text, pattern, F.lit(0))
    return F.zip_with(F.slice(pieces, F.lit(1), F.size(hits)), hits, lambda p, h: F.struct(
        F.length(p).cast("long").alias("gap"), F.length(h).cast("long").alias("size"),
        F.lower(F.right(p, F.lit(NEAR))).alias("near"), h.alias("hit")))


def _may_hold(kind: str, text: Column) -> Column:
    """A cheap look at the whole text before it is split."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike(PATTERNS[kind])


def _scored(kind: str, rank: int, placed: Column) -> Column:
    """Confirmed spans as (start, rank, end, score); kinds without a base rule need LEAST."""
    def score(s):
        value = (F.lit(SCORES[kind]) + F.when(s["near"].rlike(CONTEXT[kind]), RAISE).otherwise(0.0)
                 - F.when(s["near"].rlike(AGAINST), LOWER).otherwise(0.0))
        return F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
                        F.round(F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)), 2).alias("score"))

    hits = F.transform(F.filter(placed, lambda s: _confirmed(kind, s["hit"])), score)
    return hits if kind in BASE else F.filter(hits, lambda s: s["score"] >= LEAST)


def find(docs: DataFrame, text: str = "text", column: str = "pii") -> DataFrame:
    """``docs`` with ``column``: all spans of every whole text as an array of
    (kind, start, end, score), by start and then by kind.

    Email, ip, card and phone spans are those of the base rules, each kind leftmost and
    non-overlapping by itself, failing matches dropped; context changes their score only.
    IBANs need their checksum; social security numbers, which have none, need a word nearby.
    Kinds may overlap one another. Null texts have no spans. A column of that name is replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    no_items = F.array().cast("array<struct<gap:bigint,size:bigint,near:string,hit:string>>")
    # step by step, so that each array is computed once however often the next step reads it
    df = docs.withColumns({f"__{k}_items": F.when(_may_hold(k, t), _items(t, k)).otherwise(no_items) for k in KINDS})
    df = df.withColumns({f"__{k}": _placed(F.col(f"__{k}_items")) for k in KINDS})
    found = [_scored(kind, rank, F.col(f"__{kind}")) for rank, kind in enumerate(KINDS)]
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(F.array_sort(F.concat(*found)), lambda s: F.struct(
        names[s["rank"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != column]
    return df.select(*kept, spans.cast(f"array<{_SPAN}>").alias(column))


def count(spans: str, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets.

    Overlapping spans become one, named after the first. Texts without spans, null
    texts among them, stay as they are. Spans are worked on in blocks, each on its own
    stretch of the text, so a long text full of them costs little more than its length.
    """
    df = find(docs, text, "__spans").withColumn("__whole", F.col(text))
    n, spans = F.size("__spans"), F.col("__spans")
    blocks = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))

    def part(b):
        return F.slice(spans, b * BLOCK + 1, F.lit(BLOCK))

    # how far the spans of each block and of those before it reach
    ends = F.transform("__blocks", lambda b: F.array_max(F.transform(part(b), lambda s: s["end"])))
    zero = F.array(F.lit(0).cast("long"))
    reach = F.aggregate("__ends", zero, lambda acc, e: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), e))))
    stretch = F.transform("__blocks", lambda b: F.substr(
        F.col("__whole"), (F.get("__reach", b) + 1).cast("int"),
        (F.get("__reach", b + 1) - F.get("__reach", b)).cast("int")))
    for name, value in (("__blocks", blocks), ("__ends", ends), ("__reach", reach), ("__stretch", stretch)):
        df = df.withColumn(name, value)

    def masked(b, whole):
        base = F.get("__reach", b)
        start = F.struct(base.alias("at"), F.array().cast("array<string>").alias("out"))

        def step(acc, s):
            piece = F.array(F.substr(whole, (acc["at"] - base + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                            F.when(s["start"] >= acc["at"], F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

        return F.array_join(F.aggregate(part(b), start, step)["out"], "")

    clean = F.concat(F.array_join(F.zip_with("__blocks", "__stretch", masked), ""),
                     F.substr(F.col("__whole"), (F.element_at("__reach", -1) + 1).cast("int")))
    clean = F.when(n > 0, clean).otherwise(F.col("__whole"))
    return df.select(*[clean.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
