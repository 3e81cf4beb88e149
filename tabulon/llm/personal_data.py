"""Personal data: protected values by pattern, and terms in their texts that would give them away.

How much a term tells about a protected value is estimated from the whole corpus: their pointwise mutual
information as a share of the value's own information. Terms above a threshold are generalised, those that
as good as name the value are removed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.llm.tables import if_small, store, text_key

KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = "[A-Za-z0-9._%+-]"
# like the plain patterns, but a search neither starts inside a run it has tried nor gives characters back
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# a text without this has no valid match
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
_GAP = r"[^\p{L}]+"
_KEY = ["_t1", "_t2"]
_PART = 16  # terms are first counted in one of so many texts


@dataclass(frozen=True)
class Disclosure:
    contexts: int = 2  # different texts with a value that a term must share with it
    generalise: float = 0.8
    remove: float = 0.95


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise((2 * x.cast("int")) % 10 + F.floor(x.cast("int") / 5).cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return (
        (kind == "email")
        | ((kind == "ip") & match.rlike(rf"^{part}(?:\.{part}){{3}}$"))
        | ((kind == "card") & F.length(digits).between(14, 19) & _luhn(digits))
        | ((kind == "phone") & F.length(digits).between(10, 15))
    )


def _value(kind: Column, match: Column) -> Column:
    """One spelling of each protected value."""
    return F.concat_ws(":", kind, F.when(kind == "email", F.lower(match)).when(kind == "ip", match).otherwise(_digits(match)))


def protected_spans(rows: DataFrame) -> DataFrame:
    """(id, _t1, _t2, kind, start, end, value) of each valid match in ``rows`` (id, text); _t1 and _t2 name the text.

    A text is taken apart by each pattern; the running sum of the parts' lengths gives the places, in code points.
    """
    found = []
    for kind, pattern in PATTERNS.items():
        body = F.col("text")
        hint = F.instr(body, "@") > 0 if kind == "email" else body.rlike(_HINTS[kind])
        parts = F.arrays_zip(F.split(body, pattern, -1).alias("gap"), F.regexp_extract_all(body, F.lit(pattern), F.lit(0)).alias("match"))
        found.append(F.struct(F.lit(kind).alias("kind"), F.when(hint, parts).alias("parts")))
    of_kind = rows.select("id", *text_key(), F.explode(F.array(*found)).alias("f")).where("f.parts is not null")
    parts = of_kind.select("id", *_KEY, "f.kind", F.posexplode("f.parts").alias("k", "p")).select(
        "id",
        *_KEY,
        "kind",
        "k",
        F.length("p.gap").alias("gap"),
        F.col("p.match").alias("match"),
    )
    of_text = Window.partitionBy("id", "kind").orderBy("k")
    length = F.coalesce(F.length("match"), F.lit(0))
    end = F.sum(F.col("gap") + length).over(of_text.rowsBetween(Window.unboundedPreceding, 0))
    return (
        parts.select("id", *_KEY, "kind", "match", end.cast("int").alias("end"))
        .where(F.col("match").isNotNull() & _valid(F.col("kind"), F.col("match")))
        .select(
            "id", *_KEY, "kind", (F.col("end") - F.length("match")).cast("int").alias("start"), "end",
            _value(F.col("kind"), F.col("match")).alias("value"),
        )
    )


def _terms(text: str) -> Column:
    """The different words of letters of a text, lower-cased."""
    return F.array_distinct(F.transform(F.split(text, _GAP), F.lower))


def _some(texts: DataFrame, ids: DataFrame) -> DataFrame:
    return texts.join(if_small(ids, 16), "id", "left_semi")


def _texts_with(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """(term, n_t): different texts with each of the stored ``terms``."""
    words = texts.select(*text_key(), F.explode(_terms("text")).alias("term"))
    words = words.join(if_small(terms.select("term"), 40), "term", "left_semi")
    return words.groupBy("term").agg(F.count_distinct(*_KEY).alias("n_t"))


def disclosing_terms(own: DataFrame, texts: DataFrame, d: Disclosure) -> DataFrame:
    """(value, term, share): what each term tells of a value, as a share of the value's information.

    All counts are of different texts: with n texts, a value in n(v) of them, a term in n(t) and both in n(t, v), a
    term tells log(n * n(t, v) / (n(t) * n(v))) of log(n / n(v)). ``own`` (id, value) has the values of one row of
    each text. As n(t, v) is n(v) at most, terms in too many texts are ruled out before they meet values; most
    of them by their number in a part of the texts, which is never above n(t).
    """
    texts = texts.where("text is not null")
    n = texts.select(*text_key()).distinct().count()
    values = own.groupBy("value").agg(F.count("*").alias("n_v")).where(F.col("n_v") >= d.contexts)
    held = store(own.join(if_small(store(values), 80), "value"))
    of_text = store(held.groupBy("id").agg(F.max("n_v").alias("most")))
    words = texts.join(if_small(of_text, 24), "id").select("id", "most", F.explode(_terms("text")).alias("term"))
    words = store(words.where("term != ''"))
    met = words.groupBy("term").agg(F.count("*").alias("n"), F.max("most").alias("most"))
    most = F.lit(n) * F.pow(F.col("most") / (n + 1), F.lit(d.generalise)) * (1 + 1e-9)
    wanted = store(met.where(F.col("n") >= d.contexts).select("term", most.alias("n_max")))
    part = _texts_with(wanted, texts.where(F.pmod(text_key()[0], F.lit(_PART)) == 0))
    wanted = store(wanted.join(part, "term", "left").where("n_t is null or n_t <= n_max").select("term", "n_max"))
    rare = store(wanted.join(_texts_with(wanted, texts), "term").where("n_t <= n_max").select("term", "n_t"))
    joint = (
        words.join(if_small(rare, 48), "term")
        .join(held, "id")
        .groupBy("value", "n_v", "term", "n_t")
        .agg(F.count("*").alias("n_tv"))
        .where(F.col("n_tv") >= d.contexts)
    )
    told = F.log(F.lit(n) * F.col("n_tv") / (F.col("n_t") * F.col("n_v"))) / F.log(F.lit(n + 1) / F.col("n_v"))
    return joint.select("value", "term", told.alias("share")).where(F.col("share") >= d.generalise)


def _places(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, start, end, tag) of each word of ``texts`` (id, text) that is a term in ``wanted`` (id, term, tag)."""
    word = F.posexplode(F.arrays_zip(F.split("text", r"\p{L}+", -1).alias("gap"), F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0)).alias("word")))
    words = texts.select("id", word.alias("k", "p")).select(
        "id", "k", F.length("p.gap").alias("gap"), F.col("p.word").alias("word")
    )
    size = F.coalesce(F.length("word"), F.lit(0))
    ahead = Window.partitionBy("id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    placed = words.select("id", "word", F.sum(F.col("gap") + size).over(ahead).cast("int").alias("end")).where("word is not null")
    return placed.select("id", F.lower("word").alias("term"), (F.col("end") - F.length("word")).cast("int").alias("start"), "end").join(
        if_small(wanted, 80), ["id", "term"]
    )


def sanitise(docs: DataFrame, d: Disclosure = Disclosure()) -> DataFrame:
    """The documents with counts ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, the lists ``base`` and ``spans``, and ``clean_text``.

    Base spans are the leftmost matches of each pattern, from left to right, that are valid; kinds may overlap. Terms
    are words of letters, wherever they stand in a text with a value, that tell more about it than ``d`` allows and share
    ``d.contexts`` different texts with it at least; those that overlap a base span are left out. Spans are structs of start, end (code
    points, end exclusive), kind and tag, by start and kind. ``clean_text`` has the tag in place of each span, of
    overlapping ones the first. A null text is null again and has no spans; equal rows have equal results. Columns named like the
    added ones are replaced. Only ``doc_id`` and ``text`` are looked at.
    """
    added = ("n_email", "n_ip", "n_card", "n_phone", "base", "spans", "clean_text")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added]).alias("row")
    stored = store(docs.select(row, F.monotonically_increasing_id().alias("id")))
    texts = stored.select("id", F.col("row.text").alias("text"))
    spans = store(protected_spans(texts))
    copies = store(spans.select("id", *_KEY).distinct())
    firsts = store(copies.groupBy(*_KEY).agg(F.min("id").alias("first")))
    own = store(_some(spans.select("id", "value"), firsts.select(F.col("first").alias("id"))).distinct())
    telling = store(disclosing_terms(own, texts, d))
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")

    def listed(kind: Column, tag: Column) -> Column:
        return F.struct("start", number.alias("order"), "end", kind.alias("kind"), tag.alias("tag"))

    base = spans.select("id", listed(F.col("kind"), F.concat(F.lit("<"), F.upper("kind"), F.lit(">"))).alias("s"))
    tag = F.when(F.col("share") >= d.remove, "").otherwise("<TERM>")
    told = store(own.join(if_small(telling, 80), "value").groupBy("id", "term").agg(F.min(tag).alias("tag")))
    extra = (
        _places(_some(texts, store(told.select("id").distinct())), told)
        .withColumn("kind", F.lit("term"))
        .select(F.col("id").alias("first"), listed(F.col("kind"), F.col("tag")).alias("s"))
        .groupBy("first")
        .agg(F.collect_list("s").alias("extra"))
    )
    extra = store(copies.join(if_small(firsts, 40), _KEY).join(if_small(store(extra), 48 + 64 * F.size("extra")), "first").select("id", "extra"))
    of_base = base.groupBy("id").agg(F.collect_list("s").alias("s"))
    per_text = of_base.join(if_small(extra, 48 + 64 * F.size("extra")), "id", "left").select(
        "id", F.array_sort(F.when(F.col("extra").isNull(), F.col("s")).otherwise(F.concat("s", "extra"))).alias("all")
    )
    is_base = F.filter("all", lambda x: x["kind"] != "term")
    of_text = per_text.select("id", "all", is_base.alias("base")).select(
        "id",
        "base",
        F.filter(
            "all",
            lambda x: (x["kind"] != "term") | ~F.exists("base", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])),
        ).alias("spans"),
    )
    of_text = store(of_text)
    none = F.array().cast(of_text.schema["base"].dataType)
    # columns of their own, so that those nobody asks for are not read
    names = {c: f"_row_{i}" for i, c in enumerate(c for c in docs.columns if c not in added)}
    flat = stored.select("id", *[F.col("row")[c].alias(name) for c, name in names.items()])
    joined = flat.join(if_small(of_text, 48 + 64 * F.size("spans")), "id", "left").select(
        *names.values(), F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans")
    )
    counts = [_number_of(k, "base").alias(f"n_{k}") for k in KINDS[:4]]
    cleaned = _rebuilt(F.col(names["text"]), F.col("spans")).alias("clean_text")
    return joined.select(*[F.col(name).alias(c) for c, name in names.items()], *counts, "base", "spans", cleaned)


def _number_of(kind: str, spans: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def _rebuilt(text: Column, spans: Column) -> Column:
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(a: Column, x: Column) -> Column:
        more = F.concat(a["out"], F.substring(text, a["at"] + 1, x["start"] - a["at"]), x["tag"])
        return F.when(x["start"] >= a["at"], F.struct(more.alias("out"), x["end"].alias("at"))).otherwise(a)

    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    )


def span_list(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
