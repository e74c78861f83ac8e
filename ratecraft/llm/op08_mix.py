"""Mixing sources to target weights, with DataFrame functions only.

1. One aggregate gives each source's size (words of its texts).
2. Sources in code-point order (null last) get the weights ``weights``,
   repeating. Targets share the whole size by weight; no target passes
   ``max_repeat`` times its source's size, and what is cut off is shared again
   by weight. The fixed point is target = min(max_repeat * size, level *
   weight), and the level follows from running sums over the sources sorted by
   max_repeat * size / weight, so no iteration is needed.
3. The repetition rate of a source is target / size. A document is taken
   floor(rate) times, plus once more if a number in [0, 1) made from the md5
   of its id and a seed is below the fraction. Reruns agree, and the decision
   of a document depends on no other document.

The source table (one row a source) is written to the shared folder, so the
planner knows its size when it chooses between broadcasting it and a skew-aware
shuffle join; no hint forces a broadcast.

Defined cases: a null text has size 0; documents without a source form one
source (last in order); a source of size 0 has target and rate 0; a null id
hashes as the empty string; repeated rows are documents of their own that share
one decision; an empty table gives an empty result; columns named like the
added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratecraft.llm.common import aside, table
from ratecraft.session import materialize

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
SEED = "mix-1"
_HEX = 13        # hex digits of the md5 that make the number: 52 bits


def word_count(text: str = "text") -> F.Column:
    """Runs of characters other than ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def unit_hash(key: F.Column, seed: str = SEED) -> F.Column:
    """A number in [0, 1) fixed by ``key`` and ``seed``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, _HEX), 16, 10).cast("long") / F.lit(float(16 ** _HEX))


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Per source of ``sized`` (source, size): source, source_size, weight, target, rate."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = (per.withColumn("weight", pick)
           .withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size"))
           .withColumn("fill", F.col("cap") / F.col("weight")))
    upto = Window.orderBy(F.col("fill"), F.col("source").asc_nulls_last())
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    rest = upto.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    # level if all sources before this one (by fill) are capped and the rest share by weight
    per = (per.withColumn("total", F.sum("source_size").over(everything).cast("double"))
           .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                       / F.sum("weight").over(rest)))
    # the first source that its level does not fill holds the level of all that follow
    level = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "level"))).over(everything)["level"]
    per = per.withColumn("target", F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap"))))
    return per.select("source", "source_size", "weight", "target",
                      F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))


def plan_mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT,
             seed: str = SEED) -> DataFrame:
    """``docs`` (doc_id, text, source, others) with size, source_size, target, rate, copies, taken."""
    docs = docs.drop("size", "source_size", "target", "rate", "copies", "taken")
    sized = docs.withColumn("size", word_count())
    targets = materialize(source_targets(sized.select("source", "size"), weights, max_repeat), "mix-targets")
    right = targets.select(F.col("source").alias("__target_source"), "source_size", "target", "rate")
    whole = F.floor("rate")
    extra = (unit_hash(F.col("doc_id"), seed) < F.col("rate") - whole).cast("long")
    return (sized.join(right, F.col("source").eqNullSafe(F.col("__target_source")), "left").drop("__target_source")
            .withColumn("copies", whole + extra)
            .withColumn("taken", F.col("copies") * F.col("size")))


def emit_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row of ``docs``, all its columns as they are, as often as the mix takes it."""
    rows, back = aside(docs, "doc_id", "text", "source")
    return back(plan_mix(rows, **options).filter("copies > 0")
                .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return plan_mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
