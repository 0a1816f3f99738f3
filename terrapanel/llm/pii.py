"""Information-theoretic sanitisation of personal data.

Native: DataFrame functions only.  Patterns find the protected entities; what an entity belongs to (an
address's host, a number's prefix) is protected like it.  What a term leaves unknown of an entity is
estimated from co-occurrence over the whole corpus: -log P(entity | term), the entity's information less
what the term tells.  Terms that leave little unknown are generalised, or removed if they leave
hardly anything, in the documents that hold the entity.  One text is no co-occurrence, and a
co-occurrence that entities dealt to texts at random would show as well is none either.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.llm.common import materialise, row_id, whole_text

#: The base patterns, written so that no text makes them backtrack far or recurse deep: a match
#: can only start where a run of its first characters starts, or where the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
_PATTERNS = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True))
#: A cheap test that any match passes.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

#: Distinct texts that must show a term together with an entity.
MIN_TEXTS = 2
#: Share of the texts with a term that hold the entity, exp(-what is left unknown): from the first on a term is generalised, from the second on removed.
DISCLOSURE = 0.7
REMOVAL = 0.95
#: Chance, under entities dealt at random, below which a co-occurrence counts.
CHANCE = 1e-3
#: A term is a run of these: letters with their marks, digits, of any length.
_TERM_CHARACTERS = r"\p{L}\p{M}\p{N}"
_TERMS = rf"[{_TERM_CHARACTERS}]++"

def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z")
    digits = _digits(match)
    n = F.length(digits)
    if kind == "card":
        return F.when(n.between(13, 19), F.call_function("luhn_check", digits)).otherwise(False)
    return n.between(9, 15)


def _entity(kind: str, match: Column) -> Column:
    """The same value for every way to write an entity."""
    value = F.lower(match) if kind in ("email", "ip") else _digits(match)
    return F.concat(F.lit(f"{kind}:"), value)


def _group(kind: Column, entity: Column) -> Column:
    """What an entity belongs to: the host of an address, the network of an ip, the issuer of a card, the area of a phone."""
    value = F.substring_index(entity, ":", -1)
    return F.concat(F.lit("group:"), kind, F.lit(":"), F.when(kind == "email", F.substring_index(value, "@", -1)).when(
        kind == "ip", F.substring_index(value, ".", 2)).when(kind == "card", F.substring(value, 1, 6)).otherwise(F.substring(value, 1, 5)))


def _matches(text: Column, kind: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(_PATTERNS[kind]), F.lit(0))
    none = F.array().cast("array<string>")
    if kind in _NEEDS:
        found = F.when(F.contains(text, F.lit(_NEEDS[kind])), found).otherwise(none)
    return found


def _if_valid(matches: str, kind: str) -> Column:
    """The matches if one of them holds; the others are needed for the places between."""
    holds = F.exists(matches, lambda m: _valid(kind, m))
    return F.when(holds, F.col(matches)).otherwise(F.array().cast("array<string>"))


def _gaps(text: Column, matches: Column, pattern: str) -> Column:
    """Code points between the matches, in front of each."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))
    return F.when(F.size(matches) > 0, F.slice(gaps, 1, F.size(matches)))


def detected(docs: DataFrame, columns: list[str], with_text: bool) -> DataFrame:
    """One pass over the texts, written to the shared folder: row, columns, and matches with gaps of each kind.

    ``_text`` holds the text of the rows with a base span, or of all rows if asked.
    """
    rows = row_id(docs.select(*columns, whole_text().alias("_text")), "_row")
    text = F.col("_text")
    for kind in KINDS:
        rows = rows.withColumn(f"_{kind}", _matches(text, kind))
    for kind in KINDS:
        rows = rows.withColumn(f"_{kind}", _if_valid(f"_{kind}", kind))
    for kind in KINDS:
        rows = rows.withColumn(f"_{kind}_gaps", _gaps(text, F.col(f"_{kind}"), _PATTERNS[kind]))
    found = " or ".join(f"size(_{k}) > 0" for k in KINDS)
    rows = rows.withColumn("_found", F.expr(found))
    if not with_text:
        rows = rows.withColumn("_text", F.when(F.col("_found"), text))
    return materialise(rows)


def _spans(rows: DataFrame, matches: str, gaps: str) -> DataFrame:
    """_row, start, end, match: running sums over the matches and gaps of one row."""
    each = rows.select("_row", F.posexplode(F.arrays_zip(F.col(matches).alias("m"), F.col(gaps).alias("g"))).alias("i", "x"))
    each = each.select("_row", "i", F.col("x.m").alias("match"), F.col("x.g").alias("gap"), F.char_length("x.m").alias("n"))
    upto = Window.partitionBy("_row").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("n")).over(upto)
    return each.select("_row", (end - F.col("n")).alias("start"), end.alias("end"), "match")


def base_spans(found: DataFrame) -> DataFrame:
    """_row, rank, kind, start, end, entity of the base matches that hold."""
    out = None
    for rank, kind in enumerate(KINDS):
        rows = found.where(F.size(f"_{kind}") > 0)
        spans = _spans(rows, f"_{kind}", f"_{kind}_gaps").where(_valid(kind, F.col("match")))
        spans = spans.select("_row", F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), "start", "end",
                             _entity(kind, F.col("match")).alias("entity"))
        out = spans if out is None else out.unionByName(spans)
    return out


def _terms(text: Column) -> Column:
    """Distinct 64-bit hashes of a text's runs of letters and digits, lower case."""
    words = F.filter(F.split(F.lower(text), rf"[^{_TERM_CHARACTERS}]++"), lambda w: F.char_length(w) > 0)
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def held_texts(found: DataFrame, spans: DataFrame) -> DataFrame:
    """_row, text_hash, entities (hashes, also of their groups), masked: the rows that hold an entity, with as many spaces for its base spans."""
    before = Window.partitionBy("_row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("_row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    runs = spans.withColumn("new", F.coalesce(F.col("start") >= F.max("end").over(before), F.lit(True)).cast("int"))
    whole = runs.withColumn("run", F.sum("new").over(upto)).groupBy("_row", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.flatten(F.collect_list(F.array(F.xxhash64("entity"), F.xxhash64(_group(F.col("kind"), F.col("entity")))))).alias("e"))
    lists = whole.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"),
                                      F.array_distinct(F.flatten(F.collect_list("e"))).alias("entities"))
    masked = F.expr(
        "concat(array_join(transform(s, (x, i) -> concat(substring(_text, int(if(i = 0, 0, s[i - 1].end) + 1), "
        "int(x.start - if(i = 0, 0, s[i - 1].end))), repeat(' ', int(x.end - x.start)))), ''), substring(_text, int(s[size(s) - 1].end + 1)))")
    return found.where("_found").join(lists, "_row").select("_row", F.xxhash64("_text").alias("text_hash"), "entities", masked.alias("masked"))


def _entity_terms(texts: DataFrame, entities: DataFrame, *columns: str) -> DataFrame:
    """columns, entity, term: the distinct terms of each text beside each of its entities that ``entities`` has."""
    held = texts.select("_row", F.explode("entities").alias("entity")).join(entities.select("entity"), "entity", "left_semi")
    lists = held.groupBy("_row").agg(F.collect_list("entity").alias("some"))
    rows = texts.join(lists, "_row").select(*columns, "some", F.explode(_terms(F.col("masked"))).alias("term"))
    return rows.select(*columns, F.explode("some").alias("entity"), "term")


def disclosing_terms(docs: DataFrame, found: DataFrame, spans: DataFrame, min_texts: int = MIN_TEXTS,
                     disclosure: float = DISCLOSURE, texts: DataFrame | None = None) -> DataFrame:
    """entity, term, share: the terms that reveal an entity or a group of entities.

    Of N texts, n(e), n(t) and n(e, t) hold an entity, a term and both; rows with one text that holds an entity
    count as one.  The share is n(e, t) / n(t), whatever N is.  At least ``min_texts`` texts must hold both,
    and more than chance explains: were the n(e) texts drawn at random, n(e) n(t) / N = m of the term's would be
    among them on average, and k or more with a probability of at most m ** k / k! and of exp(k - m) (m / k) ** k;
    one of these must be at most ``CHANCE``.
    """
    texts = held_texts(found, spans) if texts is None else texts
    copies = texts.groupBy("text_hash").agg(F.count("*").alias("n"), F.min("_row").alias("_row"))
    one = texts.drop("text_hash").join(copies, "_row")  # a row a text
    entities = one.select("n", F.explode("entities").alias("entity")).groupBy("entity").agg(
        F.sum("n").alias("n_e"), F.count("*").alias("e_texts")).where(F.col("e_texts") >= min_texts)
    pairs = _entity_terms(one, entities, "_row", "n").groupBy("entity", "term").agg(
        F.sum("n").alias("n_et"), F.count("*").alias("texts")).where(F.col("texts") >= min_texts)
    total = found.agg(F.count("*").alias("n_all"))  # one row
    counts = docs.select(F.explode(_terms(whole_text())).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    # What is left of a word beside a base span may be in no whole text.
    known = pairs.join(counts, "term", "left").join(F.broadcast(total)).join(entities, "entity")
    k = F.col("texts").cast("double")
    t = F.greatest("n_t", "n_et") - F.col("n_et") + k
    n = F.col("n_all") - F.col("n_e") + F.col("e_texts")
    mean = F.col("e_texts") * t / n
    # Of k! the lower bound by Stirling's formula.
    tail = k + k * F.log(mean / k)
    by_chance = F.when(mean < k, F.least(tail - mean, tail - F.log(2 * math.pi * k) / 2)).otherwise(0.0)
    known = known.where(by_chance <= math.log(CHANCE)).select("entity", "term", (k / t).alias("share"))
    return known.where(F.col("share") >= disclosure)


def term_spans(texts: DataFrame, terms: DataFrame, removal: float = REMOVAL) -> DataFrame:
    """_row, rank, kind, start, end, entity of the disclosing terms, in rows that hold their entity.

    Rows and terms meet by entity and term together, words and told terms by row and term: neither a
    frequent entity nor a long text is met twice.
    """
    told = _entity_terms(texts, terms.select("entity").distinct(), "_row").join(terms, ["entity", "term"])
    told = materialise(told.groupBy("_row", "term").agg(F.max("share").alias("share")))
    rows = texts.join(told, "_row", "left_semi").withColumn("_words", F.regexp_extract_all("masked", F.lit(_TERMS), F.lit(0)))
    words = _spans(rows.withColumn("_word_gaps", _gaps(F.col("masked"), F.col("_words"), _TERMS)), "_words", "_word_gaps")
    hits = words.withColumn("term", F.xxhash64(F.lower("match"))).join(told, ["_row", "term"])
    label = F.when(F.col("share") >= removal, F.lit("removed")).otherwise(F.lit("generalised"))
    return hits.select("_row", F.lit(len(KINDS)).alias("rank"), F.lit(TERM).alias("kind"), "start", "end", label.alias("entity"))


def all_spans(docs: DataFrame, found: DataFrame, min_texts: int = MIN_TEXTS, disclosure: float = DISCLOSURE) -> DataFrame:
    base = materialise(base_spans(found))
    texts = materialise(held_texts(found, base))
    terms = disclosing_terms(docs, found, base, min_texts, disclosure, texts)
    return base.unionByName(term_spans(texts, terms))


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame, min_texts: int = MIN_TEXTS, disclosure: float = DISCLOSURE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row a row.

    Spans are in code points, end exclusive, by kind and start.  Null texts are empty; repeated
    rows are rows of their own, but one text as evidence.  A text has term spans only if another text
    shows the same terms with the same entity, or with one of its group.
    """
    found = detected(docs, ["doc_id"], with_text=False)
    spans = all_spans(docs, found, min_texts, disclosure)
    lists = spans.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("rank", "start", "end", "kind"))).alias("spans"))
    rows = found.select("_row", "doc_id").join(lists, "_row", "left")
    rows = rows.withColumn("spans", F.coalesce("spans", F.expr("cast(array() as array<struct<rank:int,start:long,end:long,kind:string>>)")))
    rows = rows.withColumn("base", F.filter("spans", lambda s: s["rank"] < len(KINDS)))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def sanitise(docs: DataFrame, min_texts: int = MIN_TEXTS, disclosure: float = DISCLOSURE) -> DataFrame:
    """The rows of ``docs`` with every span of ``text`` replaced; all other columns and null texts stay.

    Base spans become ``<EMAIL>``, ``<IP>``, ``<CARD>`` or ``<PHONE>``, generalised terms ``<TERM>``, removed
    ones nothing.  Spans that overlap become one, under the first one's name.  Only rows with
    spans are shuffled.
    """
    others = [c for c in docs.columns if c != "text"]
    named = [f"_c{i}" for i in range(len(others))]
    kept = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(others, named, strict=True)], "text")
    found = detected(kept.withColumn("_null", F.col("text").isNull()), [*named, "_null"], with_text=True)
    found = found.withColumn("text", F.when(~F.col("_null"), F.col("_text")))
    spans = all_spans(docs, found, min_texts, disclosure)
    before = Window.partitionBy("_row").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    new = F.coalesce(F.col("start") >= F.max("end").over(before), F.lit(True))
    runs = spans.withColumn("new", new.cast("int"))
    runs = runs.withColumn("run", F.sum("new").over(Window.partitionBy("_row").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, 0)))
    label = F.when(F.col("kind") != TERM, F.concat(F.lit("<"), F.upper("kind"), F.lit(">"))).otherwise(
        F.when(F.col("entity") == "removed", F.lit("")).otherwise(F.lit("<TERM>")))
    whole = runs.groupBy("_row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                            F.min_by(label, F.struct("start", "rank")).alias("label"))
    lists = whole.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "label"))).alias("s"))
    touched = found.where("_found").join(lists, "_row")
    pieces = F.expr(
        "concat(array_join(transform(s, (x, i) -> concat(substring(text, int(if(i = 0, 0, s[i - 1].end) + 1), "
        "int(x.start - if(i = 0, 0, s[i - 1].end))), x.label)), ''), substring(text, int(s[size(s) - 1].end + 1)))")
    back = [F.col(n).alias(c) for c, n in zip(others, named, strict=True)]
    clean = found.where("not _found").select(*back, "text")
    return clean.unionByName(touched.select(*back, pieces.alias("text"))).select(*[f"`{c}`" for c in docs.columns])
