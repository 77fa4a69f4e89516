"""Text search in names by posting lists of trigrams, so that a search does not read all names.

Different names are written with their trigrams in folders by a hash of the trigram. A search takes the
trigrams that its term requires, reads the folders of these alone, intersects their lists and
holds what is left against the pattern. A term without three letters in a row reads
the different names, which are written beside the lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import like_any
from .skew import join_apart

SIZE = 3
#: Folders of posting lists.
BUCKETS = 64


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def required_grams(term: str) -> list[str]:
    """The trigrams that a name must have to be like %term%; wildcards part the letters."""
    runs, letters = [""], iter(term)
    for letter in letters:
        if letter in "%_":
            runs.append("")
        else:
            runs[-1] += next(letters, "") if letter == "\\" else letter
    return sorted({run[i : i + SIZE] for run in runs for i in range(len(run) - SIZE + 1)})


class NameIndex:
    """The lists of one set of names under a folder of its own; a new set is written to a new folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def write(self, names: DataFrame, column: str) -> None:
        """Index the different values of a column; nulls are like no pattern."""
        once = names.select(F.col(column).alias("name")).filter("name is not null").distinct()
        once.write.parquet(f"{self.root}/names")
        known = self.spark.read.schema("name string").parquet(f"{self.root}/names")
        places = F.sequence(F.lit(1), F.length("name") - (SIZE - 1))
        grams = F.array_distinct(F.transform(places, lambda at: F.substring(F.col("name"), at, F.lit(SIZE))))
        lists = known.filter(F.length("name") >= SIZE).select("name", F.explode(grams).alias("gram"))
        # A common trigram's list is as long as the names: it is cut by name as well.
        dealt = lists.withColumn("bucket", _bucket(F.col("gram"))).repartition("bucket", F.xxhash64("name") % 16)
        dealt.sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").parquet(f"{self.root}/lists")

    def find(self, term: str) -> DataFrame:
        """(name): the names that are like %term%."""
        grams = required_grams(term)
        if grams:
            lists = self.spark.read.schema("name string, gram string, bucket int").parquet(f"{self.root}/lists")
            wanted = F.col("bucket").isin([_bucket(F.lit(g)) for g in grams]) & F.col("gram").isin(grams)
            held = lists.filter(wanted).groupBy("name").agg(F.count("*").alias("n"))
            names = held.filter(F.col("n") == len(grams)).select("name")
        else:
            names = self.spark.read.schema("name string").parquet(f"{self.root}/names")
        return names.filter(like_any(F.col("name"), F.lit(term)))

    def rows(self, table: DataFrame, column: str, term: str) -> DataFrame:
        """Rows of a table whose name is like %term%, from the names that the index finds."""
        found = self.find(term).withColumnRenamed("name", column)
        return join_apart(table, found, [column], "left_semi").select(*table.columns)
