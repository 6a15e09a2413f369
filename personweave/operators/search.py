"""Search over golden records by postings: many queries are one join, none scans the records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from personweave.sources.buckets import BucketTable
from personweave.sources.scratch import scratch_table

SIZE = 3  # characters of a gram
RAREST = 3  # grams of a query whose postings are intersected
SHOWN = ("first_name", "last_name", "email", "phone", "company_name")


def searched_text() -> Column:
    return F.lower(F.concat_ws(" ", *SHOWN))


def _grams(text: Column, size: int) -> Column:
    """The distinct runs of `size` characters."""
    places = F.sequence(F.lit(1), F.char_length(text) - (size - 1))
    runs = F.transform(places, lambda i: F.substr(text, i, F.lit(size)))
    return F.when(F.char_length(text) >= size, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def postings(golden: DataFrame) -> DataFrame:
    """`gram`, `entity_id`: every run of one to SIZE characters of the searched text, once per entity."""
    text = searched_text()
    grams = F.concat(*[_grams(text, n) for n in range(1, SIZE + 1)])
    return golden.select(F.explode(grams).alias("gram"), "entity_id")


@dataclass(frozen=True)
class SearchIndex:
    """Postings, their lengths and the texts, in tables bucketed by gram and by entity."""

    lists: BucketTable
    lengths: BucketTable
    texts: BucketTable

    @classmethod
    def create(cls, spark: SparkSession, path: str, golden: DataFrame, buckets: int = 256) -> "SearchIndex":
        def table(name: str, keys: tuple[str, ...], ids: tuple[str, ...], fields: dict[str, T.DataType]) -> BucketTable:
            schema = T.StructType([T.StructField(n, kind) for n, kind in fields.items()])
            return BucketTable(spark, f"{path}/{name}", schema, keys, ids, buckets)

        text = T.StringType()
        found = scratch_table(postings(golden), "postings")
        return cls(table("lists", ("gram",), ("gram", "entity_id"), {"gram": text, "entity_id": text}).create(found),
                   table("lengths", ("gram",), ("gram",), {"gram": text, "n": T.LongType()}).create(
                       found.groupBy("gram").agg(F.count("*").alias("n"))),
                   table("texts", ("entity_id",), ("entity_id",), {"entity_id": text, "email": text, "text": text}).create(
                       golden.select("entity_id", "email", searched_text().alias("text"))))

    def search(self, queries: DataFrame) -> DataFrame:
        """`q`, `entity_id` for every distinct query text `q` and each entity with it in an attribute, or as its email.

        Capitals and surrounding spaces don't matter. The lists of a query's rarest grams are intersected, and what is
        left is verified. A gram that no record has ends a query at once. Null and empty queries find nothing.
        """
        wanted = F.lower(F.trim("q"))
        asked = scratch_table(queries.select("q", wanted.alias("wanted")).where(F.char_length("wanted") > 0).distinct(), "queries")
        grams = F.when(F.char_length("wanted") >= SIZE, _grams(F.col("wanted"), SIZE))
        for size in range(1, SIZE):
            grams = grams.when(F.char_length("wanted") == size, _grams(F.col("wanted"), size))
        of_query = scratch_table(asked.select("wanted", F.explode(grams).alias("gram")).distinct(), "query-grams")
        rank = F.row_number().over(Window.partitionBy("wanted").orderBy("n", "gram"))  # at most the grams of one query
        lengths = self.lengths.lookup(of_query.select("gram"))
        rarest = scratch_table(of_query.join(lengths, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
                               .withColumn("rank", rank).where(F.col("rank") <= RAREST), "rarest-grams")
        needed = rarest.groupBy("wanted").agg(F.count("*").alias("needed"))
        held = rarest.select("wanted", "gram").join(self.lists.lookup(rarest.select("gram")), "gram")
        candidates = scratch_table(held.groupBy("wanted", "entity_id").agg(F.count("*").alias("found")).join(needed, "wanted")
                                   .where(F.col("found") == F.col("needed")).select("wanted", "entity_id"), "candidates")
        texts = self.texts.lookup(candidates.select("entity_id"))
        hits = candidates.join(texts, "entity_id").where(F.contains("text", F.col("wanted")) | (F.col("email") == F.col("wanted")))
        return hits.join(asked, "wanted").select("q", "entity_id")

    def refresh(self, golden: DataFrame, ended: DataFrame) -> None:
        """Put changed golden records in the place of those with their ids, and drop ended entities."""
        changed = scratch_table(golden.select("entity_id", "email", searched_text().alias("text")), "changed-texts")
        gone = scratch_table(changed.select("entity_id").unionByName(ended.select("entity_id")).distinct(), "changed-ids")
        old_texts = self.texts.lookup(gone)
        grams = F.concat(*[_grams(F.col("text"), n) for n in range(1, SIZE + 1)])
        old = scratch_table(old_texts.select(F.explode(grams).alias("gram"), "entity_id"), "old-postings")
        new = scratch_table(changed.select(F.explode(grams).alias("gram"), "entity_id"), "new-postings")
        self.lists.merge(new, old)
        touched = scratch_table(old.select("gram").unionByName(new.select("gram")).distinct(), "changed-grams")
        lengths = scratch_table(self.lists.lookup(touched).groupBy("gram").agg(F.count("*").alias("n")), "changed-lengths")
        self.lengths.merge(lengths, touched)
        self.texts.merge(changed, gone)
