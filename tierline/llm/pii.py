"""Personal data: known forms, and terms that give protected entities away. SQL functions only.

Base forms (e-mail, IP address, card, phone) are regular expressions; their
places are found natively: ``split`` gives the gaps between the matches and
``regexp_extract_all`` the matches, so running lengths give the offsets.

Every base match is a protected entity (an address in lower case, an IP address without
leading zeros, the digits of a card or phone). Its context are the terms (words of four
letters or more) of the whole texts that hold it; what lies in a base match or touches
it is no term, there and in every count. With document counts over the whole corpus - N documents, n_e
with the entity, n_t with the term, n_te with both - the term discloses the share

    PMI(t, e) / IC(e) = log(n_te * N / (n_t * n_e)) / log(N / n_e)

of the entity's information content. From ``REMOVE`` on every occurrence of the term
in the texts with that entity is removed, from ``GENERALISE`` on it is replaced by a general word. Pairs of
every count are judged; few documents prove less, so n_te is taken as
n_te ** 3 / (n_te ** 2 + ``SHRINK``): a pair seen in one document counts 0.29, in two
1.23, in three 2.35, in ten 9.76.

Nothing is paired that cannot matter, with the result of pairing everything:

* Entities of the same documents are one class, and so are terms of the same documents
  and the same n_t. A list of contacts that stands in one text (or in copies of it) is one class.
* n_te is n_h at most (the documents with entities that hold the term) and n_e at most. The share that this
  allows at best decides first which terms are looked at, then which classes of a text meet.
* Where an entity or a term has a single document, n_te is 1, and the share is the larger
  the smaller n_e is: only the rarest entity of the text is paired.

Left is one row a text for each pair of classes that both recur and may reach ``GENERALISE``.
Classes go by two 64-bit hashes over their documents. Counts are summed on the map side; tables
looked up by a key are written first, so that Spark can split a hot key of the other side.

Defined cases: null and empty texts have no spans; an entity in every document has no
information to disclose; repeated rows give equal rows (they count as documents);
rows without doc_id are scanned alike; other columns are ignored. Spans count code
points, the end is exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import id_and_text

# The base forms. A form's first class is tried only where its run begins (or where the match before
# it ended), its bounds are in the pattern: the same matches, without going back over long runs.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = r"0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"

KINDS = ("email", "ip", "card", "phone", "removed", "generalised")
TERM = r"[A-Za-z\x{80}-\x{10FFFF}]{4,}"
# in a masked text: a term that touches a span is a part of it, no word beside it
_MASK = "\x01"
FREE_TERM = r"(?<![\x01A-Za-z\x{80}-\x{10FFFF}])[A-Za-z\x{80}-\x{10FFFF}]{4,}+(?!\x01)"
SHRINK, REMOVE, GENERALISE = 2.5, 0.9, 0.7


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running sums or maxima (``op``; 0 is neutral) of array<int>. Appending copies an array, so chunks
    of about the square root of its size are run through apart, then carried on."""
    none = F.expr("cast(array() as array<int>)")

    def append(acc, x):
        return F.concat(acc, F.array(op(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)), x)))

    def carried(chunks):
        before = F.aggregate(chunks, F.array(F.lit(0)), lambda acc, c: F.concat(
            acc, F.array(op(F.element_at(acc, F.lit(-1)), F.element_at(c, F.lit(-1))))))
        return F.flatten(F.zip_with(chunks, F.slice(before, F.lit(1), F.size(chunks)),
                                    lambda c, carry: F.transform(c, lambda x: op(carry, x))))

    def chunked(v):
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        starts = F.sequence(F.lit(1), F.size(v), width)
        return let(F.transform(starts, lambda at: F.aggregate(F.slice(v, at, width), none, append)), carried)

    return let(values, lambda v: F.when(F.size(v) > 0, chunked(v)).otherwise(none))


def located(text: Column, pattern: str) -> Column:
    """array<struct<s, e, v>>: the leftmost non-overlapping matches and their places."""
    def places(p):
        lengths = F.zip_with(p["found"], F.slice(p["gaps"], F.lit(1), F.size(p["found"])), lambda v, gap: F.length(gap) + F.length(v))
        return F.zip_with(p["found"], running(lengths, lambda a, b: a + b),
                          lambda v, e: F.struct((e - F.length(v)).alias("s"), e.alias("e"), v.alias("v")))

    return let(F.struct(F.split(text, pattern, -1).alias("gaps"),
                        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")), places)


def luhn(value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")

    def weigh(total, i):
        d = F.substr(F.reverse(digits), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), weigh) % 10 == 0


def base_spans(text: Column) -> Column:
    """array<struct<k, s, e, v>> in the order of kinds, then of starts."""
    none = F.expr("cast(array() as array<struct<s:int,e:int,v:string>>)")
    n_digits = lambda x: F.length(F.regexp_replace(x["v"], "[^0-9]", ""))
    by_kind = (
        (EMAIL, F.instr(text, "@") > 0, None),
        (IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]"), lambda x: x["v"].rlike(rf"\A{_PART}(?:\.{_PART}){{3}}\z")),
        (CARD, text.rlike(CARD), lambda x: luhn(x["v"])),
        (PHONE, text.rlike(r"\+[0-9]"), lambda x: n_digits(x).between(8, 15)),
    )
    parts = []
    for k, (pattern, there, valid) in enumerate(by_kind):
        found = F.when(there, located(text, pattern)).otherwise(none)
        found = F.filter(found, valid) if valid else found
        parts.append(F.transform(found, _of_kind(k)))
    return F.concat(*parts)


def _of_kind(k: int):
    return lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v"))


def rebuilt(text: Column, spans: Column, label: Callable[[Column, Column], Column]) -> Column:
    """The text with ``label(span, end of the spans before it)`` for every span of array<struct<s, e, ..>>, sorted by s.
    Pieces are cut from 4-byte code points, whose places need no counting."""
    mark = F.unhex(F.lit("0000FEFF"))           # a decoder eats one mark at the beginning

    def piece(wide, start, n_bytes):
        return F.decode(F.concat(mark, F.substr(wide, start * 4 + 1, n_bytes)), "UTF-32")

    def joined(p):
        last = F.coalesce(F.try_element_at(p["ends"], F.lit(-1)), F.lit(0))

        def part(x, i):
            before = F.when(i > 0, F.get(p["ends"], i - 1)).otherwise(0)
            return F.concat(piece(p["wide"], before, F.greatest(x["s"] - before, F.lit(0)) * 4), label(x, before))

        return F.concat(F.array_join(F.transform(p["spans"], part), ""), piece(p["wide"], last, F.length(p["wide"])))

    return let(spans, lambda xs: let(F.struct(
        F.encode(text, "UTF-32").alias("wide"), xs.alias("spans"), running(F.transform(xs, lambda x: x["e"]), F.greatest).alias("ends")), joined))


def masked(plain: Column, base: Column) -> Column:
    """The text (free of marks) with a mark for every code point of a base span; all places stay the same."""
    spans = F.array_sort(F.transform(base, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))
    return rebuilt(plain, spans, lambda x, before: F.repeat(F.lit(_MASK), F.greatest(x["e"] - F.greatest(x["s"], before), F.lit(0))))


def free_words(text: Column, base: Column) -> Column:
    """array<struct<s, e, term>>: the terms outside the base spans."""
    words = located(masked(F.translate(text, _MASK, " "), base), FREE_TERM)
    return F.transform(words, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lower(x["v"]).alias("term")))


def distinct_terms(text: Column, pattern: str) -> Column:
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.array_distinct(F.transform(found, F.lower))


def entity(x: Column) -> Column:
    """A protected entity's 128-bit name: its kind and its normal form."""
    digits = F.regexp_replace(x["v"], "[^0-9]", "")
    normal = (F.when(x["k"] == 0, F.lower(x["v"])).when(x["k"] == 1, F.regexp_replace(x["v"], r"(?<![0-9])0+(?=[0-9])", ""))
              .otherwise(digits))
    return F.unhex(F.substr(F.sha2(F.encode(F.concat(x["k"].cast("string"), F.lit(":"), normal), "UTF-8"), 256), F.lit(1), F.lit(32)))


def scanned(docs: DataFrame) -> DataFrame:
    """row, doc_id, key, base, entities and, of texts with base spans, words. A written table without the matches themselves."""
    base = id_and_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("base", base_spans(F.col("text")))
    places = F.transform("base", lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e")))
    held = F.size("base") > 0
    return cut_lineage(base.select(
        "row", "doc_id", F.xxhash64("text").alias("key"), places.alias("base"), F.array_distinct(F.transform("base", entity)).alias("entities"),
        F.when(held, free_words(F.col("text"), F.col("base"))).alias("words")), "pii-base")


def share(n_te: Column, n_t: Column, n_e: Column, total: int) -> Column:
    """The disclosed share of an entity's information content."""
    n = n_te.cast("double")
    shrunk = n * n * n / (n * n + SHRINK)
    return F.try_divide(F.log(shrunk * float(total) / (n_t * n_e)), F.log(F.lit(float(total)) / n_e))


def _documents() -> list[Column]:
    """Two hashes over the rows of a group."""
    return [F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64(F.lit(7), "row")).alias("y")]


def disclosing_terms(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """row, term, share, n_te, n_e, n_t: every term of a text whose largest share, over the entities of that text,
    reaches GENERALISE, with the counts behind it."""
    total = rows.count()
    holders = rows.select("row", F.explode("entities").alias("entity"))
    classes = cut_lineage(holders.groupBy("entity").agg(F.count("*").alias("n_e"), *_documents()).where(F.col("n_e") < total), "pii-entities")
    most = classes.agg(F.max("n_e")).first()[0] or 1
    held = cut_lineage(holders.join(classes, "entity").select("row", "n_e", F.col("x").alias("ex"), F.col("y").alias("ey")).distinct(), "pii-held")
    rarest = held.groupBy("row").agg(F.min("n_e").alias("rarest"))

    found = rows.where("words is not null").select("row", F.explode(F.array_distinct(F.transform("words", lambda x: x["term"]))).alias("term"))
    plain = id_and_text(docs).select(F.coalesce("text", F.lit("")).alias("text")).where(F.size(base_spans(F.col("text"))) == 0)
    elsewhere = plain.select(F.explode(distinct_terms(F.col("text"), TERM)).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    terms = (found.groupBy("term").agg(F.count("*").alias("n_h"), *_documents()).join(elsewhere, "term", "left")
             .select("term", "n_h", (F.col("n_h") + F.coalesce("n", F.lit(0))).alias("n_t"), "x", "y"))
    at_best = F.least("n_h", F.lit(most))           # of all n_e, this many allows the largest share
    terms = cut_lineage(terms.where(share(at_best, F.col("n_t"), at_best, total) >= GENERALISE), "pii-terms")
    words = cut_lineage(found.join(terms, "term"), "pii-words")

    of_term = ["n_t", "n_h", "x", "y"]
    n_te = F.least("n_h", "n_e")
    may = (share(n_te, F.col("n_t"), F.col("n_e"), total) >= GENERALISE) & ((F.col("n_e") == F.col("rarest")) | (n_te > 1))
    pairs = cut_lineage(words.select("row", *of_term).distinct().join(held.join(rarest, "row"), "row").where(may).drop("rarest"), "pii-pairs")
    by_pair = ["n_e", "ex", "ey", *of_term]
    judged = (pairs.groupBy(*by_pair).agg(F.count("*").alias("n_te"))
              .withColumn("share", share(F.col("n_te"), F.col("n_t"), F.col("n_e"), total)).where(F.col("share") >= GENERALISE))
    best = (pairs.join(cut_lineage(judged, "pii-judged"), by_pair).groupBy("row", *of_term)
            .agg(F.max(F.struct("share", "n_te", "n_e")).alias("best")))
    return words.join(cut_lineage(best, "pii-best"), ["row", *of_term]).select("row", "term", "best.*", "n_t")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, text key, base spans and term spans: array<struct<k, s, e>> by kind, then start."""
    rows = scanned(docs)
    kind = F.when(F.col("share") >= REMOVE, 4).otherwise(5)
    flagged = cut_lineage(disclosing_terms(docs, rows).select("row", "term", kind.alias("k")), "pii-flagged")
    places = rows.where("words is not null").select("row", F.explode("words").alias("w")).select("row", "w.*")
    spans = (places.join(flagged, ["row", "term"]).groupBy("row")
             .agg(F.array_sort(F.collect_list(F.struct("k", "s", "e"))).alias("terms")))
    none = F.expr("cast(array() as array<struct<k:int,s:int,e:int>>)")
    return rows.join(spans, "row", "left").select("doc_id", "key", "base", F.coalesce("terms", none).alias("terms"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["k"]], x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """The digest per document."""
    count = lambda xs, k: F.size(F.filter(xs, lambda x: x["k"] == k)).cast("long")
    found = find_personal_data(docs)
    return found.select("doc_id", *(count(F.col("base"), k).alias(f"n_{KINDS[k]}") for k in range(4)),
                        F.sha2(F.encode(_joined(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
                        _joined(F.concat("base", "terms")).alias("spans"),
                        count(F.col("terms"), 4).alias("n_removed"), count(F.col("terms"), 5).alias("n_generalised"))


def sanitised(docs: DataFrame) -> DataFrame:
    """doc_id, text: base spans as <kind>, removed terms gone, generalised ones as <term>."""
    found = find_personal_data(docs).distinct()
    base = id_and_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    spans = F.array_sort(F.transform(F.concat("base", "terms"), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    labels = F.array(F.lit("<email>"), F.lit("<ip>"), F.lit("<card>"), F.lit("<phone>"), F.lit(""), F.lit("<term>"))
    same = base["doc_id"].eqNullSafe(found["doc_id"]) & (base["key"] == found["key"])
    both = base.join(found.select(found["doc_id"], found["key"], spans.alias("spans")), same)
    return both.select(base["doc_id"], rebuilt(F.col("text"), F.col("spans"), lambda x, before: F.when(
        x["e"] > before, labels[x["k"]]).otherwise("")).alias("text"))
