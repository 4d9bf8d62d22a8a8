"""Personal data: base formats, and identifiers found through the contexts of the base ones.

Bootstrapping: the words before an entity of a base format are a lexical
pattern of its kind. Patterns and instances (entity texts) form a graph whose
scores are computed in rounds: a pattern is as good as the instances it
extracts, a new instance as the patterns that extract it. Good patterns then
discover identifiers that no base format describes. Column expressions and
joins only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.llm.common import prepare, settle

KINDS = ("email", "ip", "card", "phone")
# The base formats. Possessive repetitions and the look behind
# change no match; they keep the search linear in very long runs.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A sequence of fewer than 13 digits fails and holds no longer one.
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must contain for a format to be looked for.
_HINTS = {"email": "@", "ip": ".", "phone": "+"}
# Identifiers that may be discovered: names joined to a host by an at sign, however it is written; groups of digits
# joined by single blanks, hyphens, brackets, slashes or dots; runs of at least 6 of these characters with a digit; and
# words joined by dots. Those with digits and no at sign need 4 of them.
_RUN = "[A-Za-z0-9@#_+./-]"
_AT = r"(?:@|[(\[](?i:at)[)\]])"
_GROUPS = r"\(?+[0-9]++(?:(?:\)[\x20/.-]?|[\x20/.-])?+\(?+[0-9]++){1,18}"
CANDIDATE = (
    rf"(?:\G|(?<!{_RUN}))(?:{_LOCAL}++{_AT}[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+|{_GROUPS}(?!{_RUN})"
    rf"|(?=[A-Za-z@#_+./-]*+[0-9]){_RUN}{{6,}}+|[A-Za-z_-]++(?:\.[A-Za-z_-]++)++)"
)
CANDIDATE_DIGITS = 4
# The pattern before an entity: one or two words on its line, within so many characters.
CONTEXT_CHARS = 64
CONTEXT = r"((?:[^\s]+[ \t]+)?[^\s]*\p{L}[^\s]*)[ \t]*[\"'(<]?$"
ROUNDS = 3
# A pattern discovers from this score on, if it has that many different seeds.
MIN_SCORE = 0.7
MIN_SEEDS = 3
# Counts in a pattern's total like so many unknown instances, so that rare patterns stay low.
DOUBT = 0.5
_PART = 512


def _pieces(text: Column, pattern: str) -> Column:
    """Each match with the length of the text before it since the last match, and the end of that text."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    before = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    return F.zip_with(before, found, lambda b, f: F.struct(
        F.length(b).alias("skip"), f.alias("text"), F.right(b, F.lit(CONTEXT_CHARS)).alias("left")
    ))


def _placed(pieces: Column) -> Column:
    """``_pieces`` with start and end in the text.

    Lengths are added up within parts of ``_PART`` matches and over the parts,
    so that many matches do not make an array grow one by one.
    """
    item = "struct<s: int, e: int, text: string, left: string>"
    inner = f"struct<at: int, out: array<{item}>>"
    outer = f"struct<at: int, out: array<struct<off: int, out: array<{item}>>>>"

    def one(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["skip"]
        end = start + F.length(x["text"])
        new = F.struct(start.alias("s"), end.alias("e"), x["text"].alias("text"), x["left"].alias("left"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(new)).alias("out")).cast(inner)

    def part(k: Column) -> Column:
        return F.aggregate(
            F.slice(pieces, k * _PART + 1, F.lit(_PART)), F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(inner), one
        )

    def join(acc: Column, x: Column) -> Column:
        return F.struct(
            (acc["at"] + x["at"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct(acc["at"].alias("off"), x["out"].alias("out")))).alias("out"),
        ).cast(outer)

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / _PART).cast("int")), part)
    joined = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(outer), join)["out"]
    moved = F.flatten(F.transform(joined, lambda p: F.transform(p["out"], lambda x: F.struct(
        (x["s"] + p["off"]).alias("s"), (x["e"] + p["off"]).alias("e"), x["text"].alias("text"), x["left"].alias("left")
    ))))
    return F.when(F.size(pieces) > 0, moved).otherwise(F.array().cast(f"array<{item}>"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _byte(part: Column) -> Column:
    """Whether digits are at most 255, however many zeros they begin with."""
    short = F.concat(F.lit("0"), F.ltrim(part, F.lit("0")))
    return (F.length(short) <= 4) & (F.substring(short, 1, 4).cast("int") <= 255)


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return F.when((n - i) % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


_VALID = {
    "email": lambda x: F.lit(True),
    "ip": lambda x: F.forall(F.split(x, r"\."), _byte),
    "card": lambda x: F.length(_digits(x)).between(13, 19) & _luhn(F.substring(_digits(x), 1, 19)),
    "phone": lambda x: F.length(_digits(x)).between(9, 15),
}


def _once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and the columns, each computed once per row and not again in what follows."""
    made = F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items()))))
    return df.select(*keep, made)


def mentions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(rid, doc_id, email, ip, card, phone, candidates)`` for every row, written once.

    Each list has structs of start and end in code points, the matched text
    and the words before it; candidates overlap no base match.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = prepare(docs.sparkSession) and docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(doc_id).alias("doc_id"), body.alias("text")
    )
    t = F.col("text")

    def looked_for(kind: str) -> Column:
        hint = F.contains(t, F.lit(_HINTS[kind])) if kind in _HINTS else t.rlike("[0-9]")
        return F.when(hint, _pieces(t, PATTERNS[kind])).otherwise(_pieces(F.lit(""), PATTERNS[kind]))

    raw = _once(
        rows, ["rid", "doc_id"], **{k: looked_for(k) for k in KINDS},
        candidates=F.when(t.rlike("[0-9@.]|(?i:[(\\[]at[)\\]])"), _pieces(t, CANDIDATE)).otherwise(_pieces(F.lit(""), CANDIDATE)),
    )

    def valid(kind: str) -> Column:
        return F.filter(_placed(F.col(kind)), lambda x: _VALID[kind](x["text"]))

    placed = _once(raw, ["rid", "doc_id"], **{k: valid(k) for k in KINDS}, candidates=_placed(F.col("candidates")))
    base = F.concat(*(F.col(k) for k in KINDS))
    fit = F.filter("candidates", lambda c: (
        (F.length(_digits(c["text"])) >= CANDIDATE_DIGITS) | ~c["text"].rlike("[0-9]") | c["text"].rlike(_AT)
    ) & ~F.exists(base, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])))
    return settle(placed.withColumn("candidates", fit))


def _pattern(left: Column) -> Column:
    """The lexical pattern at the end of a text: lower-case words, digits alike; empty without a word."""
    return F.regexp_replace(F.lower(F.regexp_extract(left, CONTEXT, 1)), "[0-9]", "#")


def graph(found: DataFrame) -> DataFrame:
    """``(kind, pattern, instance, n, seed)``: how often a pattern of a kind extracts an instance.

    Seeds are base matches; other instances only occur with patterns that have
    seeds. Occurrences are summed before any join.
    """
    x = F.col("x")
    seeds = None
    for kind in KINDS:
        one = found.select(F.lit(kind).alias("kind"), F.explode(kind).alias("x"))
        seeds = one if seeds is None else seeds.unionByName(one)
    seeds = (
        seeds.select("kind", _pattern(x["left"]).alias("pattern"), F.lower(x["text"]).alias("instance"))
        .where("pattern <> ''").groupBy("kind", "pattern", "instance").agg(F.count("*").alias("n"))
        .withColumn("seed", F.lit(True))
    )
    seeds = settle(seeds)
    others = (
        found.select(F.explode("candidates").alias("x"))
        .select(_pattern(x["left"]).alias("pattern"), F.lower(x["text"]).alias("instance"))
        .where("pattern <> ''").groupBy("pattern", "instance").agg(F.count("*").alias("n"))
    )
    kinds = seeds.select("kind", "pattern").distinct()
    return settle(seeds.unionByName(
        others.join(kinds, "pattern").select("kind", "pattern", "instance", "n", F.lit(False).alias("seed"))
    ))


def score(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Scores of patterns ``(kind, pattern, p, seeds)`` and of new instances ``(kind, instance, q)`` after some rounds.

    A pattern's score is the share of its instances, each weighted by the
    logarithm of its count, that are seeds or believed; a new instance is
    believed unless all of its patterns err.
    """
    weight = F.log1p("n")

    def patterns(known: DataFrame) -> DataFrame:
        return settle(known.groupBy("kind", "pattern").agg(
            (F.sum(weight * F.col("q")) / (F.sum(weight) + DOUBT)).alias("p"), F.sum(F.col("seed").cast("int")).alias("seeds")
        ))

    def instances(of: DataFrame) -> DataFrame:
        return settle(
            edges.where("not seed").join(of.where(F.col("seeds") >= MIN_SEEDS), ["kind", "pattern"])
            .groupBy("kind", "instance").agg((1 - F.exp(F.sum(F.log(1 - F.least("p", F.lit(0.999)))))).alias("q"))
        )

    scored = patterns(edges.withColumn("q", F.col("seed").cast("double")))
    believed = instances(scored)
    for _ in range(rounds - 1):
        known = edges.join(believed, ["kind", "instance"], "left").withColumn(
            "q", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("q", F.lit(0.0)))
        )
        scored = patterns(known)
        believed = instances(scored)
    return scored, believed


def discover(found: DataFrame) -> DataFrame:
    """``(rid, found)``: per row the spans that good patterns discover, with the kind they are like."""
    scored, believed = score(graph(found))
    good = scored.where((F.col("p") >= MIN_SCORE) & (F.col("seeds") >= MIN_SEEDS)).select("kind", "pattern")
    x = F.col("x")
    return (
        found.select("rid", F.explode("candidates").alias("x"))
        .select("rid", x["s"].alias("s"), x["e"].alias("e"), _pattern(x["left"]).alias("pattern"), F.lower(x["text"]).alias("instance"))
        .join(good, "pattern").join(believed.where(F.col("q") >= MIN_SCORE), ["kind", "instance"])
        .groupBy("rid").agg(F.array_sort(F.collect_set(F.struct(F.concat(F.lit("new_"), "kind").alias("k"), "s", "e"))).alias("found"))
    )


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_new)`` for every row of ``docs``.

    spans are ``kind:start:end`` in code points, end exclusive, by kind, then
    start: the base kinds, then ``new_`` and the kind for discovered ones. The
    digest covers the base ones. Null and empty texts have none. Repeated rows
    each give a row, told apart by a number of their own; other columns are
    ignored; an empty table gives no rows.
    """
    found = mentions(docs, doc_id, text)

    def named(kind: str) -> Column:
        return F.transform(kind, lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))

    base = F.concat(*map(named, KINDS))
    new = F.transform(F.coalesce("found", F.array().cast("array<struct<k: string, s: int, e: int>>")),
                      lambda x: F.concat_ws(":", x["k"], x["s"].cast("string"), x["e"].cast("string")))
    return found.drop("candidates").join(discover(found), "rid", "left").select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(base, new), ",").alias("spans"), F.size(new).cast("long").alias("n_new"),
    )
