"""Filter interaction audit: what each order of five filters removes, by failing-id relations. SQL functions only.

One scan judges the whole texts. Each filter gets a relation of its own in the shared
folder, the ids of the rows that fail it; label relations hold the ids of good and toxic
rows. What a row meets before a step is a *set* of filters, so 32 prefixes stand for the
prefixes of all 120 orders. With an id's prefixes beside it, all counts are joins by id:

    survivors of a prefix    = all ids       left-anti  the relations of the prefix
    removals of a next step  = failing ids   left-anti  the relations of the prefix
    redundancies             = failing ids   left-semi  the relations of the prefix
    label losses             = removals      left-semi  a label's relation

Ids are unique, so no join key is hot; they are dealt once, before their prefixes are
laid beside them. Counts by part are summed on the map side, 112 at most a part.

Defined cases: null and empty texts have no words (they fail A); a null source is the
part with the empty name; a row without doc_id neither fails E nor makes another fail;
rows that share a doc_id are judged one by one, and neither of two equal ones is the
smaller; a document labelled twice counts as good or toxic if one label says so; labels
without a document are unused; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, shared_scratch
from .common import id_and_text

FILTERS = "ABCDE"
BIT = {f: 1 << k for k, f in enumerate(FILTERS)}
EVERY = sum(BIT.values())
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 50, 65, 5      # words; distinct words and capitals of 100
SPACE, SIGNS = r"[\x20\x09-\x0D]+", r"[#$%&*|]"


def text_failures(text: Column) -> dict[str, Column]:
    """Which filters a text fails by itself."""
    words = F.array_remove(F.split(text, SPACE), "")
    n_upper = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"A": F.size(words) < MIN_WORDS,
            "B": F.lit(100) * F.size(F.array_distinct(words)) < MIN_DISTINCT * F.size(words),
            "C": F.lit(100).cast("long") * n_upper > MAX_UPPER * F.length(text).cast("long"),
            "D": text.rlike(SIGNS)}


def relations(docs: DataFrame, labels: DataFrame, source_col: str = "source") -> dict[str, DataFrame]:
    """row and part of: every row ("rows"), those that fail a filter (A to E), good and toxic ones. Written tables."""
    spark = docs.sparkSession
    path = shared_scratch(spark, "audit")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    fails = text_failures(text)
    (docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
                 F.coalesce(docs[source_col].cast("string"), F.lit("")).alias("part"),
                 F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), *(c.alias(f) for f, c in fails.items()))
     .write.parquet(f"{path}/rows"))
    rows = spark.read.parquet(f"{path}/rows")
    first = cut_lineage(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                        .where("first < last").select("digest", "first"), "audit-first")
    marked = cut_lineage(labels.groupBy(labels["doc_id"].cast("long").alias("doc_id"))
                         .agg(F.max(labels["quality"] == 1).alias("good"), F.max(labels["toxic"] == 1).alias("toxic")), "audit-labels")
    found = {f: rows.where(F.col(f)) for f in fails}
    found["E"] = rows.join(first, "digest").where("doc_id > first")
    for name in ("good", "toxic"):
        found[name] = rows.join(marked.where(F.col(name)), "doc_id", "left_semi")
    for name, ids in found.items():
        ids.select("row", "part").write.parquet(f"{path}/{name}")
    return {name: spark.read.parquet(f"{path}/{name}").select("row", "part") for name in ("rows", *found)}


def interactions(rel: dict[str, DataFrame]) -> DataFrame:
    """part, prefix, bit, and for the filter of that bit (0: none) after that prefix: kept, removed, redundant, good, toxic."""
    failing = reduce(DataFrame.unionAll, (rel[f].withColumn("bit", F.lit(BIT[f])) for f in FILTERS))
    ids, failing = rel["rows"].repartition("row"), failing.repartition("row")
    prefixes = F.array(*map(F.lit, range(EVERY + 1)))
    survivors_of = ids.select("row", "part", F.explode(prefixes).alias("prefix"), F.lit(0).alias("bit"))
    steps = failing.select("row", "part", "bit", F.explode(prefixes).alias("prefix")).where("prefix & bit = 0")
    met = failing.select(F.col("row").alias("met_row"), F.col("bit").alias("met"))

    def joined(left: DataFrame, how: str) -> DataFrame:
        return left.join(met, (left["row"] == met["met_row"]) & (left["prefix"].bitwiseAND(met["met"]) != 0), how)

    removed = joined(steps, "left_anti")
    counted = {"kept": joined(survivors_of, "left_anti"), "removed": removed, "redundant": joined(steps, "left_semi"),
               **{name: removed.join(rel[name].select("row"), "row", "left_semi") for name in ("good", "toxic")}}
    parts = [df.groupBy("part", "prefix", "bit").agg(F.count("*").alias("n")).withColumn("what", F.lit(what))
             for what, df in counted.items()]
    return (reduce(DataFrame.unionByName, parts).groupBy("part", "prefix", "bit")
            .agg(*(F.sum(F.when(F.col("what") == what, F.col("n")).otherwise(0)).alias(what) for what in counted)))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    found = cut_lineage(interactions(relations(docs, labels)), "audit-counts")
    # of the orders that have a filter after just this prefix: those of the prefix times those of the rest
    weight = F.array(*(F.lit(factorial(bin(p).count("1")) * factorial(max(0, len(FILTERS) - 1 - bin(p).count("1")))) for p in range(EVERY + 1)))
    at = F.struct("prefix", "bit")
    what = F.struct("kept", "removed", "redundant", "good", "toxic")
    by_part = found.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct(at, what))).alias("at"),
        F.array(*(F.coalesce(F.sum(F.when(F.col("bit") == b, F.col("removed") * weight[F.col("prefix")])), F.lit(0)).cast("long")
                  for b in BIT.values())).alias("shares"))
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    steps = (by_part.select("*", F.explode(orders).alias("filter_order"))
             .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")))
    before, letter = F.expr("left(filter_order, step - 1)"), F.expr("substr(filter_order, step, 1)")
    steps = steps.withColumns({
        "prefix": sum((F.when(F.contains(before, F.lit(f)), b).otherwise(0) for f, b in BIT.items()), F.lit(0)),
        "bit": sum((F.when(letter == f, b).otherwise(0) for f, b in BIT.items()), F.lit(0))})

    def of(prefix: Column, bit: Column, name: str) -> Column:
        return F.coalesce(F.try_element_at("at", F.struct(prefix.alias("prefix"), bit.alias("bit")))[name], F.lit(0).cast("long"))

    prefix, bit, none = F.col("prefix"), F.col("bit"), F.lit(0)
    return steps.select("part", "filter_order", "step",
                        of(prefix.bitwiseOR(bit), none, "kept").alias("kept"), of(prefix, bit, "removed").alias("removed"),
                        of(prefix, bit, "redundant").alias("redundant"),
                        of(F.lit(EVERY).bitwiseXOR(bit), bit, "removed").alias("unique_fails"),
                        of(prefix, bit, "good").alias("good_lost"), of(prefix, bit, "toxic").alias("toxic_lost"),
                        F.element_at("shares", F.instr(F.lit(FILTERS), letter)).alias("shapley"))
