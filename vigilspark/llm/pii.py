"""Personal data by regular expressions, checksums and context words, in column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilspark.operators.columns import evaluated_once

# Fixed patterns. They match what the plain forms in the comments match; possessive repeats and a start that cannot lie
# inside a run keep them linear on long runs of letters or digits.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # Two letters, two check digits and up to 30 letters or digits, single spaces allowed between them.
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
    # Three, two and four digits: one of many numbers of that form, unless words say that it is a person's.
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# Words near a span that make it likelier to be what it looks like.
CONTEXT = {
    "email": "mail|contact|write|correo|courriel|adresse",
    "ip": r"\bip\b|address|server|host|login|adresse",
    "card": "card|visa|credit|payment|karte|tarjeta|carte",
    "phone": r"phone|\btel|call|mobile|fax|telefon|tel[eé]fono",
    "iban": "iban|account|bank|konto|cuenta|compte",
    "ssn": r"\bssn\b|social security|taxpayer|\btin\b",
}
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "iban", "ssn"]
CONTEXT_CHARS = 40
# Score of a match that passes its check, and what a context word before it adds.
BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.5, "iban": 0.8, "ssn": 0.3}
CONTEXT_BONUS = {"email": 0.1, "ip": 0.2, "card": 0.1, "phone": 0.3, "iban": 0.1, "ssn": 0.5}
# Matches of the kinds beside the base ones count from this score on.
MIN_SCORE = 0.5
BLOCK = 128

SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string,score:double>>"


def _starts(lengths: Column) -> Column:
    """Running sums before each element. Blocks keep the copying that array accumulation costs away from long lists."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK))

    def of_block(block: Column, before: Column) -> Column:
        empty = F.struct(before.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(block, empty, lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<array<bigint>>").alias("out"))
    summed = F.aggregate(blocks, start, lambda acc, block: F.struct(
        of_block(block, acc["at"])["at"].alias("at"),
        F.concat(acc["out"], F.array(of_block(block, acc["at"])["out"])).alias("out")))
    return F.when(F.size(lengths) == 0, F.array().cast("array<bigint>")).otherwise(F.flatten(summed["out"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn sum."""
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + F.when(
        (F.length(digits) - i) % 2 == 0, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                     F.substring(digits, i, F.lit(1)).cast("int") + 1)))
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number passes its check: letters count 10 to 35, and the first four characters go last."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    code = F.ascii  # the pattern admits A-Z and 0-9 only
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).when(
        code(c) >= 65, (acc * 100 + code(c) - 55) % 97).otherwise((acc * 10 + code(c) - 48) % 97))
    return rest == 1


def _holds(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3)
                        & (F.substring(F.regexp_replace(p, "^0+", "0"), -3, 3).cast("int") <= 255))
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return mod97(value)
    if kind == "ssn":  # areas 000, 666 and 900 on, group 00 and serial 0000 are not given to anyone
        return ~F.rlike(value, F.lit("^(?:000|666|9)|-00-|-0000$"))
    return F.lit(True)


def _found(kind: str, gaps: Column, values: Column, begins: Column, min_score: float) -> Column:
    """Spans of one kind. What lies between the matches gives their places and the words before them."""
    rows = F.transform(values, lambda v, i: F.struct(
        F.lit(kind).alias("kind"), (F.get(begins, i) + F.length(F.get(gaps, i))).alias("start"),
        (F.get(begins, i) + F.length(F.get(gaps, i)) + F.length(v)).alias("end"), v.alias("value"),
        (F.lit(BASE_SCORE[kind]) + F.when(
            F.rlike(F.lower(F.right(F.get(gaps, i), F.lit(CONTEXT_CHARS))), F.lit(CONTEXT[kind])),
            F.lit(CONTEXT_BONUS[kind])).otherwise(F.lit(0.0))).alias("score")))
    # Scores are sums of tenths, which are rounded before they are compared.
    scored = F.transform(rows, lambda s: s.withField("score", F.round(s["score"], 2)))
    if kind not in BASE_KINDS:
        scored = F.filter(scored, lambda s: s["score"] >= min_score)
    return F.when(F.size(values) == 0, F.array().cast(SPAN)).otherwise(F.filter(scored, lambda s: _holds(kind, s["value"])))


def find(docs: DataFrame, *, text: str = "text", kinds: list[str] = KINDS, min_score: float = MIN_SCORE) -> DataFrame:
    """All columns of ``docs`` with ``pii``: spans (kind, start, end, value, score) by kind as listed, then by start.

    Starts and ends are in code points, the end exclusive. Matches of one kind do not overlap; a match that fails its
    check is dropped. The score rises where a context word stands in the forty characters before the span; of the kinds beside
    the base ones only spans of ``min_score`` and more are found. Null and empty texts hold no spans. A column called ``pii`` is replaced. The work is one projection: no shuffle, no Python.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    parts = F.struct(*[x for kind in kinds for x in (
        F.split(body, PATTERNS[kind], -1).alias(f"{kind}_gaps"),
        F.regexp_extract_all(body, F.lit(PATTERNS[kind]), F.lit(0)).alias(f"{kind}_values"))])
    cut = evaluated_once(docs.drop("pii"), {"_pii_parts": parts})
    # What a lambda refers to is evaluated for each element, so the places are columns of their own.
    begins = {f"_pii_{k}": _starts(F.transform(f"_pii_parts.{k}_values", _with_gap(k))) for k in kinds}
    placed = evaluated_once(cut, begins)
    spans = F.concat(*[_found(k, F.col(f"_pii_parts.{k}_gaps"), F.col(f"_pii_parts.{k}_values"), F.col(f"_pii_{k}"), min_score)
                       for k in kinds])
    return evaluated_once(placed, {"pii": spans}).drop("_pii_parts", *begins)


def _with_gap(kind: str):
    return lambda value, i: (F.length(F.get(F.col(f"_pii_parts.{kind}_gaps"), i)) + F.length(value)).cast("long")


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once, however often it is mentioned."""
    return F.get(F.transform(F.array(value), use), 0)


def redact(docs: DataFrame, *, text: str = "text", spans: str = "pii") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets; of overlapping spans the first to
    start, then the longest, counts. Null stays null.

    Finding a place in a text takes a walk from its beginning, so the text is cut where each block of spans ends, and the
    places of a block are sought in its own part: long texts with many spans take linear time.
    """
    order = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("less"), F.upper(s["kind"]).alias("kind"))))
    sorted_docs = evaluated_once(docs, {"_pii_order": order})
    count = F.size("_pii_order")
    blocks = F.when(count == 0, F.array().cast("array<array<struct<start:bigint,less:bigint,kind:string>>>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.floor((count - 1) / BLOCK).cast("int")), lambda b: F.slice("_pii_order", b * BLOCK + 1, BLOCK)))
    cut = evaluated_once(sorted_docs, {"_pii_blocks": blocks})

    def reach(block: Column, at: Column) -> Column:
        """Where the last span of the block that counts ends."""
        return F.aggregate(block, at, lambda acc, s: F.when(s["start"] < acc, acc).otherwise(-s["less"]))

    def written(block: Column, part: Column, begin: Column) -> Column:
        """The block's part of the text, which begins at ``begin``, with its spans replaced."""
        start = F.struct(begin.alias("at"), F.array().cast("array<string>").alias("out"))
        done = F.aggregate(block, start, lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(F.struct(
            (-s["less"]).alias("at"), F.concat(acc["out"], F.array(
                F.substr(part, (acc["at"] - begin + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                F.concat(F.lit("<"), s["kind"], F.lit(">")))).alias("out"))))
        return F.array_join(done["out"], "")

    def step(acc: Column, block: Column) -> Column:
        return _bound(reach(block, acc["at"]), lambda to: F.struct(
            to.alias("at"), F.substr(acc["rest"], (to - acc["at"] + 1).cast("int")).alias("rest"),
            F.concat(acc["out"], F.array(_bound(
                F.substr(acc["rest"], F.lit(1), (to - acc["at"]).cast("int")),
                lambda part: written(block, part, acc["at"])))).alias("out")))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.col(text).alias("rest"), F.array().cast("array<string>").alias("out"))
    done = evaluated_once(cut, {"_pii_done": F.aggregate("_pii_blocks", start, step)})
    whole = F.when(count == 0, F.col(text)).otherwise(F.concat(F.array_join("_pii_done.out", ""), F.col("_pii_done.rest")))
    return done.withColumn(text, whole).drop("_pii_order", "_pii_blocks", "_pii_done")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str) -> Column:
    return F.filter("pii", lambda s: s["kind"] == kind)


def op7_pii(spark, docs: DataFrame) -> DataFrame:
    """Spans of all documents, with their scores in the spans' order; columns but doc_id and text are ignored."""
    found = find(docs.select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(BASE_KINDS))
    return found.select(
        "doc_id", *[F.size(_of_kind(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))
