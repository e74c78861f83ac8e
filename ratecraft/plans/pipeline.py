"""The analysis pipeline over the driver tables.

rated      ratings with the part each row belongs to, one narrow table written
           once: raw and corrected item id, user, rating, ts, bucket, rating
           month, part
             part 'validation'  guarded split of all rows, test = bucket 0
             part 'tune'        guarded split of the known rows, test = bucket 1
             part 'fit'         the known rows that are left
items      one row per item: title, genres, release year, and its corrected id
           and genres (id 7 becomes 3 with item 3's genres)
known      'fit' and 'tune' rows; folds over fit_rows: fold = bucket - 2
           (buckets 2..9 -> 8 folds; put-back rows never test)

Titles and genres are joined to rows only where a query asks for them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.functions.features import from_epoch_seconds, release_year, round_to_period
from ratecraft.operators.prepare import correct_ids, drop_ids
from ratecraft.operators.split import KEEP, flag_fold_guard
from ratecraft.session import fingerprint, materialize
from ratecraft.sources import fixtures

_CACHE: dict = {}

# Fixed parameters of the pipeline.
OUTER_TEST_BUCKET = 0
INNER_TEST_BUCKET = 1
N_FOLDS = 8
FOLD_OFFSET = 2
LAMBDAS = [i * 0.25 for i in range(41)]    # 0, 0.25, ..., 10
REG_LAMBDA = 5.0


class Pipeline:
    """Lazily built DataFrames of the analysis for one scale-factor folder.

    ``Pipeline.of`` shares one instance per (session, folder), so the tables
    written to the shared checkpoint folder are reused by every query of the
    session instead of being recomputed.
    """

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, dirty: bool = False) -> "Pipeline":
        mark = fingerprint(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("lineitem", "orders", "part")])
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), dirty)
        if key not in _CACHE or _CACHE[key].fingerprint != mark:    # other files, or the same written anew
            _CACHE[key] = cls(spark, sf_dir, dirty, mark)
        return _CACHE[key]

    def __init__(self, spark: SparkSession, sf_dir: str, dirty: bool = False, mark: str = ""):
        self.spark, self.sf_dir, self.dirty, self.fingerprint = spark, sf_dir, dirty, mark
        self.models: dict = {}   # fitted models shared by the queries of a session

    @cached_property
    def ratings(self) -> DataFrame:
        """The join of the two large tables, made once: five narrow columns."""
        return materialize(fixtures.load_ratings(self.spark, self.sf_dir), "ratings")

    @cached_property
    def items(self) -> DataFrame:
        f = fixtures.load_items_dirty if self.dirty else fixtures.load_items
        return f(self.spark, self.sf_dir)

    @cached_property
    def corrections(self) -> DataFrame:
        return materialize(fixtures.load_corrections(self.spark, self.sf_dir), "corrections")

    @cached_property
    def item_facts(self) -> DataFrame:
        """Per raw id: title, genres, release year, and the id and genres after the correction."""
        fixed = correct_ids(self.items.withColumnsRenamed({"item_id": "id", "genres": "g"})
                            .select("id", "title", "g", F.col("id").alias("item_id"), F.col("g").alias("genres")), self.corrections)
        return materialize(fixed.select(F.col("id").alias("raw_id"), "title", F.col("g").alias("raw_genres"), "item_id", "genres",
                                        release_year("title").alias("release_year")), "items")

    @cached_property
    def rated_items(self) -> DataFrame:
        return self.ratings.join(self.items, "item_id", "left")

    @cached_property
    def rated(self) -> DataFrame:
        """The narrow fact table: both splits flagged in one job, written once."""
        outer = flag_fold_guard(self.ratings, F.when(F.col("bucket") == OUTER_TEST_BUCKET, F.lit(0)), 1)
        rows = outer.withColumnsRenamed({"item_id": "raw_id", KEEP: "held"}).drop("__fold")
        # a row for each row of its item; other ids than the raw one are few, so the join moves no rows as a rule
        rows = (rows.join(self.changed_ids, "raw_id", "left").withColumn("item_id", F.explode(F.coalesce("new_ids", F.array("raw_id")))).drop("new_ids")
                .withColumn("rating_date", round_to_period(from_epoch_seconds("ts"), "month")))
        inner = flag_fold_guard(rows, F.when((F.col("bucket") == INNER_TEST_BUCKET) & ~F.col("held"), F.lit(0)), 1, among=~F.col("held"))
        part = F.when(F.col("held"), "validation").when(F.col(KEEP), "tune").otherwise("fit")
        return materialize(inner.withColumn("part", part).drop("held", "__fold", KEEP), "rated")

    @cached_property
    def changed_ids(self) -> DataFrame:
        """(raw_id, new_ids) of the items that do not have exactly their own id after the correction."""
        ids = self.item_facts.filter("raw_id is not null").groupBy("raw_id").agg(F.collect_list(F.coalesce("item_id", "raw_id")).alias("new_ids"))
        return materialize(ids.filter((F.size("new_ids") != 1) | (F.get("new_ids", F.lit(0)) != F.col("raw_id"))), "changed-ids")

    @cached_property
    def featured(self) -> DataFrame:
        """The rows of all parts with genres and release year, without titles: joined and written once."""
        facts = self.item_facts.select("raw_id", "genres", "release_year")
        return materialize(self.rated.join(facts, "raw_id", "left")
                           .select("user_id", "item_id", "rating", "ts", "bucket", "genres", "release_year", "rating_date", "part"), "featured")

    def model_rows(self, *parts: str) -> DataFrame:
        """Rows of ``parts`` as models take them: a scan, no join and no titles."""
        return self.featured.filter(F.col("part").isin(*parts)).drop("part")

    def item_counts(self, *parts: str) -> DataFrame:
        """(item_id, n, release_year): one row for each raw id and row of its item, counted before the join."""
        counts = self.rated.filter(F.col("part").isin(*parts)).groupBy("raw_id", "item_id").agg(F.count(F.lit(1)).alias("n"))
        return counts.join(self.item_facts.select("raw_id", "release_year"), "raw_id", "left").drop("raw_id")

    def narrow(self, *parts: str) -> DataFrame:
        """Rows of ``parts`` without titles, genres and years: a scan of the fact table, no join."""
        return self.rated.filter(F.col("part").isin(*parts)).select("user_id", "item_id", "rating", "ts", "bucket", "rating_date")

    @cached_property
    def known_narrow(self) -> DataFrame:
        return self.narrow("fit", "tune")

    def _rows(self, *parts: str) -> DataFrame:
        facts = self.item_facts.select("raw_id", "title", "genres", "release_year")
        return (self.rated.filter(F.col("part").isin(*parts)).join(facts, "raw_id", "left")
                .select("user_id", "item_id", "rating", "ts", "bucket", "title", "genres", "release_year", "rating_date"))

    def _raw_rows(self, *parts: str) -> DataFrame:
        facts = self.item_facts.select("raw_id", "title", F.col("raw_genres").alias("genres"))
        return (self.rated.filter(F.col("part").isin(*parts)).join(facts, "raw_id", "left")
                .select("user_id", F.col("raw_id").alias("item_id"), "rating", "ts", "bucket", "title", "genres"))

    @cached_property
    def known_raw(self) -> DataFrame:
        return self._raw_rows("fit", "tune")

    @cached_property
    def validation_raw(self) -> DataFrame:
        return self._raw_rows("validation")

    @cached_property
    def known(self) -> DataFrame:
        return self._rows("fit", "tune")

    @cached_property
    def validation(self) -> DataFrame:
        return self._rows("validation")

    @cached_property
    def fit_rows(self) -> DataFrame:
        return self._rows("fit")

    @cached_property
    def tune_rows(self) -> DataFrame:
        return self._rows("tune")

    @cached_property
    def title_pairs(self) -> DataFrame:
        """Distinct (item_id, title) of the known rows before the id correction."""
        ids = self.rated.filter("part <> 'validation'").select(F.col("raw_id").alias("item_id")).distinct()
        return materialize(ids.join(self.item_facts.select(F.col("raw_id").alias("item_id"), "title"), "item_id", "left"), "title-pairs")

    @cached_property
    def item_titles(self) -> DataFrame:
        """title_pairs without the wrong id."""
        return drop_ids(self.title_pairs, self.corrections)

    def plain_model(self, upto: int = 5):
        """Plain fit on fit_rows with (at least) the first ``upto`` effects, shared by the session's queries.

        Effects are fitted in sequence, so the first k effects of a longer
        model are exactly the k-effect model. The mean alone and the item
        effect alone are fitted without the rest.
        """
        size = upto if upto < 2 else 5
        if ("plain", size) not in self.models:
            from ratecraft.operators.effects import fit_effects, standard_effects
            rows = self.model_rows("fit") if size > 1 else self.narrow("fit")
            self.models["plain", size] = fit_effects(rows, standard_effects(upto=size), None)
        return self.models["plain", size]

    def reg_model(self, lam: float):
        """Regularized 5-effect fit on fit_rows at ``lam``, shared within the session."""
        key = ("reg", lam)
        if key not in self.models:
            from ratecraft.operators.effects import fit_effects, standard_effects
            self.models[key] = fit_effects(self.model_rows("fit"), standard_effects(), lam)
        return self.models[key]

    @property
    def fold(self):
        return F.col("bucket") - FOLD_OFFSET
