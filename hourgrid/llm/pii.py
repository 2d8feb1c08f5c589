"""Personal data: base patterns and information-theoretic sanitisation.

Base entities (e-mail, IP, card and phone numbers) are found by pattern.  The
corpus then tells how strongly a term that shares documents with an entity
reveals it: with document frequencies, the disclosure of entity e by term t is
PMI(e; t) / IC(e), which is 1 when the term occurs in no other document.  Terms
at or beyond a threshold are generalised wherever they occur in the documents
that hold the entity, and removed when they disclose it fully.  Everything is
DataFrame functions; no Python runs on executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.joins import join_dimension
from .common import materialise, read_table

KINDS = ("email", "ip", "card", "phone")
#: The kinds' patterns.  Possessive repeats and the look-behinds change no match:
#: they only spare searches that must fail (from inside a run that failed from its
#: start), so long runs cost linear time and no stack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
TERM = r"\p{L}+"
TERM_KIND = len(KINDS)  # sorts behind the base kinds
LEAST_LETTERS = 3
SUPPORT = 2  # documents that must hold both entity and term
THRESHOLD = 0.9


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running sums (or maxima, ...) of an array: in each of log2(n) rounds a place
    takes in what stands 1, 2, 4, ... places before it, so n values cost n log n
    steps and no array is rebuilt per value."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))

    def add(done: Column, n: Column) -> Column:
        return F.transform(done, lambda x, i: _let(F.get(done, i - F.call_function("shiftleft", F.lit(1), n)), lambda y: F.when(y.isNull(), x).otherwise(combine(x, y))))

    return F.aggregate(rounds, values, add)


def _spans(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the pattern's matches, in code points: the
    lengths of the matches and of the gaps between them add up."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def placed(hits: Column) -> Column:
        steps = F.zip_with(hits, F.slice(F.split(text, pattern, -1), 1, F.size(hits)), lambda hit, gap: F.length(hit) + F.length(gap))
        ends = _let(steps, lambda lengths: _running(lengths, lambda x, y: x + y))
        return F.zip_with(hits, ends, lambda hit, end: F.struct((end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("value")))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: F.when(F.size(hits) == 0, none).otherwise(placed(hits)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        double = d * 2
        return total + F.when(i % 2 == 1, d).otherwise(F.when(double > 9, double - 9).otherwise(double))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    count = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "card":
        return F.when(count.between(12, 19), _luhn(value)).otherwise(False)
    if kind == "phone":
        return count.between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end, value>> of all valid base entities, by start
    and then kind (its place in KINDS)."""
    def of(n: int, kind: str) -> Column:
        valid = F.filter(_spans(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
        return F.transform(valid, lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))

    return F.array_sort(F.concat(*[of(n, kind) for n, kind in enumerate(KINDS)]))


def _terms(text: Column) -> Column:
    """array<string> of the distinct letter runs of a text, in lower case."""
    runs = F.transform(F.split(text, r"[^\p{L}]+", -1), lambda run: F.lower(run))
    return F.array_distinct(F.filter(runs, lambda run: F.length(run) >= LEAST_LETTERS))


def _term_spans(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """(row, terms): every occurrence of a row's wanted terms (row, term, disclosure)
    that overlaps no base span of the row.

    A term is free if the base spans that start before its end reach no further than
    its start; a running maximum over the row's spans in order tells."""
    held = found.join(wanted.select("row").distinct(), "row", "left_semi")
    words = held.select("row", F.explode(_spans(F.col("text"), TERM)).alias("t")).select("row", "t.start", "t.end", F.lower("t.value").alias("term"))
    hits = words.join(wanted, ["row", "term"]).select("row", F.col("end").alias("at"), F.lit(0).alias("base"), "start", "end", "disclosure")
    base = held.select("row", F.explode("base").alias("s")).select(
        "row", F.col("s.start").alias("at"), F.lit(1).alias("base"), "s.start", "s.end", F.lit(None).cast("double").alias("disclosure"))
    before = Window.partitionBy("row").orderBy("at", "base").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(F.when(F.col("base") == 1, F.col("end"))).over(before), F.lit(0))
    free = hits.union(base).withColumn("reach", reach).filter("base = 0 AND reach <= start")
    return free.groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct("start", F.lit(TERM_KIND).alias("kind"), "end", "disclosure"))).alias("terms"))


def _disclosure(total: int, n_both: Column, n_entity: Column) -> Column:
    """PMI / IC from the numbers of rows; 0 for an entity of all rows."""
    pmi = F.log2(n_both * F.lit(float(total)) / (n_entity * F.col("n_term").cast("double")))
    content = F.log2(F.lit(float(total)) / n_entity)
    return F.when(content > 0, pmi / content).otherwise(0.0)


def find_personal_data(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT,
                       id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """(doc_id, base, terms[, text]) per row of ``docs``.

    ``base`` is array<struct<start, kind, end, value>> of the base entities and
    ``terms`` array<struct<start, kind, end, disclosure>> of all occurrences of the
    terms that disclose an entity of the row, which overlap no base entity;
    positions are code points, ends exclusive.  Entities, terms and their meetings
    are counted over whole rows, and all rows count; a repeated row counts like any
    other.  Null and empty texts have no spans, and an empty table gives an empty
    result.  Work grows as the length of a text (times its logarithm), with many
    matches in it as well; pairs of a row that cannot reach the threshold are not
    made."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = rows.withColumn("base", base_spans(F.col("text"))).withColumn("row", F.monotonically_increasing_id())
    text = F.col("text") if with_text else F.when(F.size("base") > 0, F.col("text"))
    found = materialise(found.select("row", "doc_id", "base", text.alias("text")), "entities")
    total = found.count()
    entity = F.concat(F.col("s.kind").cast("string"), F.lit(":"), F.lower("s.value"))
    held = found.select("row", F.explode("base").alias("s")).select("row", entity.alias("entity")).distinct()
    entities = held.groupBy("entity").agg(F.count("*").alias("n_entity")).filter(F.col("n_entity") >= support)
    lists = join_dimension(held, entities, "entity").groupBy("row").agg(F.collect_list(F.struct("entity", "n_entity")).alias("held"))
    terms = rows.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term")).filter(F.col("n_term") >= support)
    words = found.filter(F.size("base") > 0).join(lists, "row").select("row", "held", F.explode(_terms(F.col("text"))).alias("term"))
    # no pair meets more often than its rarer side occurs, so the others cannot reach the threshold
    near = F.filter("held", lambda e: _disclosure(total, F.least(e["n_entity"], F.col("n_term")), e["n_entity"]) >= threshold - 1e-9)
    pairs = materialise(join_dimension(words, terms, "term").select("row", "term", "n_term", F.inline(near)), "pairs")
    both = pairs.groupBy("entity", "term", "n_entity", "n_term").agg(F.count("*").alias("n_both")).filter(F.col("n_both") >= support)
    disclosing = both.withColumn("disclosure", _disclosure(total, F.col("n_both"), F.col("n_entity"))).filter(F.col("disclosure") >= threshold)
    pair = F.struct("entity", "term").alias("pair")
    hits = join_dimension(pairs.select("row", "term", pair), disclosing.select(pair, "disclosure"), "pair")
    best = hits.groupBy("row", "term").agg(F.max("disclosure").alias("disclosure"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,disclosure:double>>")
    spans = _term_spans(found, materialise(best, "wanted"))
    return found.join(spans, "row", "left").select("doc_id", "base", *(["text"] if with_text else []), F.coalesce("terms", none).alias("terms"))


def sanitised_text() -> Column:
    """The text of ``find_personal_data`` with base entities replaced by their kind,
    disclosing terms generalised to ``[term]`` and full disclosures removed."""
    label = F.array(*map(F.lit, (f"[{k}]" for k in KINDS)))
    spans = F.array_sort(F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.element_at(label, s["kind"] + 1).alias("put"))),
        F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(t["disclosure"] >= 1, "").otherwise("[term]").alias("put")))))

    def put(own: Column) -> Column:
        """Each span puts down the text since the furthest end before it, and its label
        if it reaches beyond that end."""
        ends = _running(F.transform(own, lambda s: s["end"]), lambda x, y: F.greatest(x, y))
        parts = _let(F.split("text", ""), lambda chars: _let(ends, lambda reach: F.concat(
            F.transform(own, lambda s, i: _let(F.coalesce(F.get(reach, i - 1), F.lit(0)), lambda at: F.concat(
                F.array_join(F.slice(chars, at + 1, F.greatest(s["start"] - at, F.lit(0))), ""), F.when(s["end"] > at, s["put"]).otherwise("")))),
            F.array(F.array_join(F.slice(chars, F.element_at(reach, -1) + 1, F.size(chars)), "")))))
        return F.array_join(parts, "")

    return _let(spans, lambda own: F.when(F.size(own) == 0, F.col("text")).otherwise(put(own)))


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, text) with the sanitised texts; options as in ``find_personal_data``."""
    return find_personal_data(docs, **options).select("doc_id", sanitised_text().alias("text"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, [*KINDS, "term"]))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is_kind(n: int):
    return lambda span: span["kind"] == n


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(read_table(spark, sf_dir, "documents"), with_text=False)
    place = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    counts = [F.size(F.filter("base", _is_kind(n))).cast("long").alias(f"n_{kind}") for n, kind in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat(place("base"), place("terms")))).alias("spans"), F.size("terms").cast("long").alias("n_terms"))
