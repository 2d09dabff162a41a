"""Mixing sources to target weights: hierarchical token budgets and seeded epochs, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, from_files, place, placed, whole_row, word_count

LEVELS = ("domain", "lang", "source")
#: Production weights among siblings; who isn't listed has weight 1.
WEIGHTS = {
    "domain": {"domain0": 4, "domain1": 2},
    "lang": {"en": 8, "de": 4, "fr": 2, "es": 2},
    "source": {},
}


def domain_of(source: Column) -> Column:
    """The production rule that groups sources into four domains."""
    return F.concat(F.lit("domain"), (F.crc32(source) % 4).cast("string"))


def weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.when(F.lit(False), F.lit(1))
    for name, w in weights[level].items():
        out = out.when(F.col(level) == name, F.lit(w))
    return out.otherwise(1).cast("long")


def fill(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds ``given``: each parent's ``budget`` shared among its children by ``weight``, none above its ``supply``.

    Children are taken in order of supply per weight: while the next one's supply
    is no more than its share of what is left, it gets its supply and the others
    share the rest. Whole numbers only; less than a token a child is lost by rounding.
    """
    order = W.partitionBy(*parent).orderBy(F.col("supply") / F.col("weight"), name)
    before = F.coalesce(F.sum("supply").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    seen = children.withColumn("capped", F.col("supply") * left <= F.col("weight") * (F.col("budget") - before))
    whole = W.partitionBy(*parent)
    rest = F.col("budget") - F.sum(F.when(F.col("capped"), F.col("supply")).otherwise(0)).over(whole)
    shares = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(whole)
    seen = seen.withColumn("rest", rest).withColumn("shares", shares)
    return seen.withColumn("given", F.when(F.col("capped"), F.col("supply")).otherwise(F.expr("rest * weight div shares"))).drop("capped", "rest", "shares")


def budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], share: tuple[int, int], epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, given) for leaves with their tokens.

    The root has ``share`` of all tokens; each node's budget goes to its children
    by weight, up to what their subtrees can supply in ``epochs`` passes. So what
    one source lacks goes to its siblings first, and only what all of them
    together lack has gone to other languages, and then to other domains.
    """
    sums = leaves.withColumn("supply", F.col("tokens") * epochs)
    lang = sums.groupBy("domain", "lang").agg(F.sum("supply").alias("supply"))
    domain = lang.groupBy("domain").agg(F.sum("supply").alias("supply"))
    root = leaves.agg(F.expr(f"coalesce(sum(tokens), 0) * {share[0]} div {share[1]}").alias("budget"))
    top = domain.withColumn("weight", weight("domain", weights)).withColumn("budget", root.scalar()).withColumn("root", F.lit(0))
    given = fill(top, ["root"], "domain").select("domain", F.col("given").alias("budget"))
    given = fill(lang.withColumn("weight", weight("lang", weights)).join(given, "domain"), ["domain"], "lang").select("domain", "lang", F.col("given").alias("budget"))
    given = fill(sums.withColumn("weight", weight("source", weights)).join(given, ["domain", "lang"]), ["domain", "lang"], "source")
    return given.select(*LEVELS, "tokens", "given")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: dict[str, dict[str, int]] = WEIGHTS,
    share: tuple[int, int] = (3, 4), epochs: int = 2, seed: int = 17, digits: int = 3,
) -> DataFrame:
    """A row per row of docs: place, id, domain, lang, source, tokens, copies (how often it is in the mixture).

    A leaf's budget is filled from epochs over its documents, each in the order
    of md5(seed:epoch:id): as many whole epochs as fit, then the documents of the
    next one while the running total stays within the budget. The running total
    is taken in two steps, over buckets of equal first ``digits`` hex digits and
    then inside the one bucket that holds the end, so a leaf with a third of all
    rows is never in one task.

    Tokens are words. Null text has none (such rows are in every epoch that is
    reached, for nothing); null lang or source is a name of its own, the empty
    one; rows without an id are ordered by their place instead; repeated rows are rows; an
    empty table gives no rows. Budgets below one document give no document.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    named = placed(docs.select(id_col, text_col, "lang", "source"))
    slim = named.select(
        F.col("_place").alias("place"), F.col(id_col).alias("id"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        word_count(F.col(text_col)).alias("tokens"),
    ).withColumn("domain", domain_of(F.col("source")))
    slim = scratch.write(slim, "documents")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    leaf = scratch.write(budgets(leaves, weights, share, epochs), "leaves").select(
        *LEVELS, F.expr("CASE WHEN tokens = 0 THEN 0 ELSE given div tokens END").alias("whole"), F.expr("CASE WHEN tokens = 0 THEN 0 ELSE given % tokens END").alias("part"),
    )
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("id").cast("string"), F.col("place"))).cast("binary"))
    ordered = slim.join(leaf, list(LEVELS)).withColumn("key", key).withColumn("bucket", F.substring("key", 1, digits))
    sums = ordered.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("sum"), F.first("part").alias("part"))
    running = F.sum("sum").over(W.partitionBy(*LEVELS).orderBy("bucket"))
    ends = sums.withColumn("upto", running).where("upto > part").groupBy(*LEVELS).agg(F.min(F.struct("bucket", (F.col("upto") - F.col("sum")).alias("before"))).alias("end"))
    ends = scratch.write(ends.select(*LEVELS, F.col("end.bucket").alias("last"), F.col("end.before").alias("before")), "ends")
    judged = ordered.join(ends, list(LEVELS), "left")
    at_end = judged.where("bucket = last")
    total = F.sum("tokens").over(W.partitionBy(*LEVELS, "bucket").orderBy("key", "place").rowsBetween(W.unboundedPreceding, W.currentRow))
    at_end = at_end.withColumn("in_part", F.col("before") + total <= F.col("part"))
    others = judged.where("last IS NULL OR bucket <> last").withColumn("in_part", F.col("last").isNull() | (F.col("bucket") < F.col("last")))
    both = at_end.unionByName(others)
    return both.select("place", F.col("id").alias(id_col), *LEVELS, "tokens", (F.col("whole") + F.col("in_part").cast("long")).alias("copies"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that the mixture holds, once for each copy, with all their columns, whatever these are called. Nulls,
    repeated rows and empty tables as in ``mix``."""
    docs = from_files(docs)
    decided = mix(docs, **options).where("copies > 0").select("place", "copies")
    rows = docs.select(whole_row(docs).alias("row"), place().alias("place"))
    return rows.join(decided, "place").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).select("row.*")
