"""Personal data: base patterns, and terms that reveal a protected entity by how they occur together with it.

Base spans are e-mail addresses, internet addresses, card numbers and phone numbers.  Each found value is a protected
entity.  The words of a text outside its base spans occur together with each of its entities.  Over the whole corpus,
counted in documents, the disclosure of entity e by term t is their pointwise mutual information over the information
content of e, PMI(t; e) / IC(e): 1 if t occurs nowhere but with e, 0 if it is independent.  A term whose disclosure is more
than chance is generalised from ``GENERALISE`` on and removed from ``REMOVE`` on, wherever it stands in any text.

Chance is a binomial test: of the m unlike texts with e, k or more have t although each has it only as often as any
document.  Chernoff's bound of that must be below ``ALPHA`` over the number of pairs that can be tested at all.  An entity
or a term of one text is no such pair: each word that occurs once would disclose whatever stands in its text.  Near copies
are one text here: texts with entities whose sets of words agree in a band of min-hashes, or are linked by others that do,
have one vote together.

Expressions and joins only.  Patterns are written so that Java's engine neither recurses nor scans a run twice:
possessive, and starting where a run starts (``\\G`` allows the rest of a run after a match).

Null and empty texts have no spans.  Rows of one id with different texts are told apart by text; repeated rows get the
same spans.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import fresh, pick, written
from spendloom.llm.stars import components

#: In the order of the digest; the method's own kind comes last.
KINDS = ("email", "ip", "card", "phone", "term")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must have for the pattern to match at all; cheaper to look for.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][ -]?){12}", "phone": r"\+[0-9]"}
LETTER = r"[\p{L}\p{M}\p{N}]"
TERM = r"[\p{L}\p{M}\p{N}]++"
BETWEEN = r"[^\p{L}\p{M}\p{N}]++"
ALPHA = 0.05
GENERALISE = 0.5
REMOVE = 0.8
BLOCK = 256
#: Min-hashes of a text's words: texts that agree in all rows of a band are near copies.
BANDS, ROWS = 4, 6

SPAN = "struct<start:bigint,kind:int,end:bigint,value:string>"


def running(lengths: Column) -> Column:
    """Sums of the numbers before each, in two steps, so that long arrays stay cheap."""
    zero = F.lit(0).cast("bigint")
    none = F.array().cast("array<bigint>")

    def sums(numbers: Column, start: Column) -> Column:
        begin = F.struct(start.alias("at"), none.alias("out"))
        step = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(numbers, begin, step, lambda acc: acc["out"])

    blocks = F.transform(
        F.sequence(F.lit(0), F.expr("0").cast("int") + F.floor((F.size(lengths) - 1) / BLOCK).cast("int")),
        lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK),
    )
    totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda acc, x: acc + x))
    whole = F.flatten(F.zip_with(blocks, sums(totals, zero), sums))
    return F.when(F.size(lengths) > 0, whole).otherwise(none)


def matches(text: Column, pattern: str | Column, kind: int, keep) -> Column:
    """Spans of all matches for which ``keep(value)`` holds, in order."""
    values = F.regexp_extract_all(text, F.lit(pattern) if isinstance(pattern, str) else pattern, F.lit(0))
    gaps = F.split(text, pattern, -1)
    both = F.arrays_zip(
        F.transform(F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))), lambda g: F.length(g).cast("bigint")).alias("gap"),
        values.alias("value"),
    )
    starts = running(F.transform(both, lambda x: x["gap"] + F.length(x["value"])))
    spans = F.zip_with(
        both,
        starts,
        lambda x, s: F.struct(
            (s + x["gap"]).alias("start"),
            F.lit(kind).alias("kind"),
            (s + x["gap"] + F.length(x["value"])).alias("end"),
            x["value"].alias("value"),
        ),
    )
    return F.filter(spans, lambda x: keep(x["value"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    back = F.reverse(_digits(value))
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(back)),
        F.lit(0),
        lambda acc, i: acc
        + F.when(i % 2 == 1, F.substring(back, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*[F.lit(d) for d in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substring(back, i, F.lit(1)).cast("int") + 1)
        ),
    )
    return F.length(back).between(12, 19) & (total % 10 == 0)


CHECKS = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: ~F.exists(F.split(v, r"\."), lambda p: ~p.rlike("^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$")),
    "card": _luhn,
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind."""
    none = F.array().cast(f"array<{SPAN}>")
    found = []
    for kind, pattern in PATTERNS.items():
        hint = text.contains("@") if kind == "email" else text.rlike(HINTS[kind])
        found.append(F.when(hint, matches(text, pattern, KINDS.index(kind), CHECKS[kind])).otherwise(none))
    return F.array_sort(F.concat(*found))


def outside(text: Column, spans: Column) -> Column:
    """The text with each span blank, of the same length."""
    blank = lambda x, at: F.repeat(F.lit(" "), (x["end"] - F.greatest(x["start"], at)).cast("int"))
    return F.when(F.size(spans) > 0, _replaced(text, spans, blank, blank)).otherwise(text)


def folded(text: Column) -> Column:
    """In lower case, which for sigma depends on what follows."""
    return F.replace(F.lower(text), F.lit("ς"), F.lit("σ"))


def vocabulary(text: Column, spans: Column) -> Column:
    """Distinct words of a text outside its base spans, folded, and maybe an empty one."""
    return F.array_distinct(F.split(folded(outside(text, spans)), BETWEEN))


def _classes(texts: DataFrame) -> DataFrame:
    """``digest, class`` of texts (``digest, words``): one class for near copies and what links them (written)."""

    def least_hash(i: int) -> Column:
        return F.array_min(F.transform("words", lambda w: F.xxhash64(w, F.lit(i)))).alias(f"h{i}")

    bands = [F.struct(F.lit(b).alias("band"), F.xxhash64(*[f"h{b * ROWS + r}" for r in range(ROWS)]).alias("hash")) for b in range(BANDS)]
    hashed = texts.dropDuplicates(["digest"]).select("digest", *[least_hash(i) for i in range(BANDS * ROWS)])
    dealt = written(hashed.select("digest", F.explode(F.array(*bands)).alias("at")).select("digest", "at.*"), "bands")
    # Each text is linked to the least of its band, so links are as many as texts.
    firsts = dealt.groupBy("band", "hash").agg(F.min("digest").alias("b"), F.max("digest").alias("most")).where("b != most")
    links = dealt.join(firsts, ["band", "hash"]).select(F.col("digest").alias("a"), "b")
    reached = components(links).withColumnRenamed("node", "digest")
    own = texts.select("digest").distinct().join(reached, "digest", "left")
    return written(own.select("digest", F.coalesce("component", "digest").alias("class")), "classes")


def _risky(rows: DataFrame, found: DataFrame, alpha: float) -> DataFrame:
    """``term, deed`` of the terms that disclose an entity (written); ``rows`` has a row for each text and word of it."""
    texts = found.where("size(base) > 0").select(
        "doc_id", "digest", F.explode(F.array_distinct(F.transform("base", lambda b: F.concat_ws(":", b["kind"].cast("string"), F.lower(b["value"]))))).alias("entity")
    )
    # Counts are of documents; tests are of unlike texts, so that copies prove nothing.
    held = texts.groupBy("entity", "digest").agg(F.count("*").alias("copies"))
    held = written(held.join(_classes(found.where("size(base) > 0").select("digest", "words")), "digest"), "entities-held")
    entities = held.groupBy("entity").agg(F.sum("copies").alias("n_e"), F.countDistinct("class").alias("m")).where("m > 1")
    entities = written(entities, "entities-tested")
    documents, tested = found.count(), entities.agg(F.count("*"), F.max("n_e")).first()
    n, (n_entities, most) = float(documents), tested
    if not n_entities:
        return rows.sparkSession.createDataFrame([], "term string, deed string")
    # The whole vocabulary is counted, by task first, and only then cut.
    counted = written(rows.groupBy("term").count().where("count > 1 AND term <> ''"), "vocabulary")
    pairs = n_entities * max(1, counted.count())
    # A term of more documents cannot reach the least disclosure, whatever it stands with.
    rare = counted.where(F.col("count") <= n * (most / n) ** GENERALISE + 1).withColumnRenamed("count", "n_t")
    held = held.join(entities, "entity")
    words = found.where("size(base) > 0").join(held.select("digest").distinct(), "digest", "left_semi")
    words = words.select("digest", F.explode("words").alias("term")).distinct().join(rare, "term")
    together = (
        words.join(held, "digest")
        .where(F.col("n_t") <= n * F.pow(F.col("n_e") / n, F.lit(GENERALISE)) + 1)
        .groupBy("entity", "term")
        .agg(*[F.first(c).alias(c) for c in ("n_t", "n_e", "m")], F.sum("copies").alias("n_te"), F.countDistinct("class").alias("k"))
    )
    information = F.log(n / F.col("n_e"))
    shared = F.log(F.col("n_te") * n / (F.col("n_t") * F.col("n_e")))
    q, k, m = F.col("n_t") / n, F.col("k"), F.col("m")
    rest = F.when(k < m, (m - k) * F.log((m - k) / (m * (1 - q)))).otherwise(0.0)
    chance = F.when(k > m * q, -(k * F.log(k / (m * q)) + rest)).otherwise(0.0)
    risky = (
        together.withColumn("disclosure", F.when(information > 0, shared / information).otherwise(0.0))
        .where((F.col("disclosure") >= GENERALISE) & (chance + F.log(F.lit(float(pairs))) <= F.log(F.lit(alpha))))
        # Of several entities the one that the term discloses most decides.
        .groupBy("term").agg(F.max("disclosure").alias("disclosure"))
        .select("term", F.when(F.col("disclosure") >= REMOVE, "remove").otherwise("generalise").alias("deed"))
    )
    return written(risky, "terms")


def _told_spans(text: Column) -> Column:
    """Spans of the text's words that are keys of ``deeds``."""
    kind = KINDS.index("term")
    keys = F.transform(F.map_keys("deeds"), lambda t: F.concat(F.lit("\\Q"), t, F.lit("\\E")))  # words have no backslash
    pattern = F.concat(F.lit(f"(?<!{LETTER})(?:"), F.array_join(keys, "|"), F.lit(f")(?!{LETTER})"))
    small = folded(text)
    # Few words are told, so they alone are looked for; where folding moves places, each word is.
    exact = matches(small, pattern, kind, lambda v: F.lit(True))
    every = matches(text, TERM, kind, lambda v: F.map_contains_key("deeds", folded(v)))
    return F.when(F.length(small) == F.length(text), exact).otherwise(every)


def find(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """``doc_id, digest, spans`` of every row: base spans and terms, by start, then kind; digest is the text's (written).

    A term's value says what becomes of it: ``generalise`` or ``remove``.
    """
    rows = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("digest"), base_spans(F.col("text")).alias("base"))
    # Only texts with entities keep their words.  All are written with their base spans, which take long to find.
    own = F.when(F.size("base") > 0, vocabulary(F.col("text"), F.col("base")))
    rows = written(rows.select("doc_id", "digest", "base", own.alias("words"), "text"), "entities")
    found = rows.drop("text")
    # Outer, as a filter on the words' number would make them twice.
    words = rows.select("doc_id", "digest", F.explode_outer(F.coalesce("words", vocabulary(F.col("text"), F.col("base")))).alias("term"))
    risky = _risky(words, found, alpha)
    if risky.isEmpty():
        return found.select("doc_id", "digest", F.col("base").alias("spans"))
    deeds = (
        words.join(risky, "term")
        .groupBy("doc_id", "digest").agg(F.map_from_entries(F.collect_set(F.struct("term", "deed"))).alias("deeds"))
        .toDF("k", "d", "deeds")
    )
    told = written(deeds, "texts-told")
    same = F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d"))
    terms = F.transform(
        _told_spans(outside(F.col("text"), F.col("base"))), lambda x: x.withField("value", F.element_at("deeds", folded(x["value"])))
    )
    marked = rows.join(told, same).select("k", "d", F.array_sort(F.concat("base", terms)).alias("spans"))
    marked = written(marked.dropDuplicates(["k", "d"]), "texts-marked")
    return found.join(marked, same, "left").select("doc_id", "digest", F.coalesce("spans", "base").alias("spans"))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    name = lambda x: F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["kind"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _replaced(text: Column, spans: Column, mark, later) -> Column:
    """The text with ``mark(span, at)`` for each span, and ``later(span, at)`` for one that overlaps the ones before up to ``at``."""
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int"))
        return F.when(
            x["start"] >= acc["at"],
            F.struct(x["end"].alias("at"), F.concat(acc["out"], F.array(gap, mark(x, acc["at"]))).alias("out")),
        ).otherwise(F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.concat(acc["out"], F.array(later(x, acc["at"]))).alias("out")))

    rest = lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))
    )
    return F.aggregate(spans, begin, step, rest)


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind; where spans overlap, by the first one's."""
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def mark(x: Column, at: Column) -> Column:
        return F.when((x["kind"] == 4) & (x["value"] == "remove"), F.lit("")).otherwise(F.element_at(marks, x["kind"] + 1))

    return _replaced(text, spans, mark, lambda x, at: F.lit(""))


def sanitise(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """The documents with all spans masked; ``n_chars`` follows.  All rows and columns stay.

    Any text can have terms, so each meets the spans found.
    """
    found = find(docs, alpha).where("size(spans) > 0").dropDuplicates(["doc_id", "digest"])
    key, digest, spans = fresh(docs, "span_key"), fresh(docs, "span_digest"), fresh(docs, "spans")
    found = found.toDF(key, digest, spans)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.xxhash64("text") == F.col(digest))
    hit = F.col(spans).isNotNull()
    out = docs.join(found, same, "left").withColumn("text", F.when(hit, masked(F.col("text"), F.col(spans))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return out.select(*columns)
