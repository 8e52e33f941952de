"""Which texts contain which terms, by an index: each term is found by one trigram, texts by theirs, and those that meet are looked at whole.

The work of a text is that of its different trigrams, whatever the number of terms; a table of terms of any size is joined, never sent along unless Spark
finds it small. A term is listed under the trigram that the fewest terms have, so that no trigram has many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of an index key. Shorter terms are looked for by all that they begin in a text.
N = 3


def grams(text: Column, n: int = N) -> Column:
    """Different runs of n characters of a text."""
    chars = F.split(text, "")
    join, after = lambda a, b: F.concat(a, b), lambda k: F.slice(chars, k, F.greatest(F.size(chars), F.lit(1)))
    runs = chars
    for k in range(2, n + 1):
        runs = F.zip_with(runs, after(k), join)
    return F.array_distinct(F.filter(runs, lambda g: g.isNotNull() & (F.char_length(g) == n)))


def indexed(terms: DataFrame, term: str = "term") -> DataFrame:
    """term, gram: of each different term of N characters and more, the trigram that the fewest terms have (of those the least)."""
    once = terms.select(F.col(term).alias("term")).filter(F.char_length("term") >= N).distinct()
    each = once.select("term", F.explode(grams(F.col("term"))).alias("gram"))
    counts = each.groupBy("gram").agg(F.count("*").alias("n"))
    return each.join(counts, "gram").groupBy("term").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))


def containing(texts: DataFrame, terms: DataFrame, key: str, text: str = "text", term: str = "term") -> DataFrame:
    """key, term: each text that contains a term, once, whatever the number of places; letters count as they are.

    Terms of fewer than N characters meet texts by a nested loop of those few (there are no more of them than pairs of characters). Null and empty
    terms, and null texts, meet nothing; rows that repeat a key are one text each.
    """
    index, rows = indexed(terms, term), texts.select(F.col(key).alias("key_"), F.col(text).alias("text_")).filter("text_ is not null")
    own = rows.withColumn("print_", F.xxhash64("text_"))
    met = own.select(F.col("key_").alias("of_"), F.col("print_").alias("as_"), F.explode(grams(F.col("text_"))).alias("gram")).join(index, "gram").select("of_", "as_", "term").distinct()
    long = own.distinct().join(met, F.col("key_").eqNullSafe(F.col("of_")) & (F.col("print_") == F.col("as_"))).filter(F.contains("text_", "term")).select("key_", "term")
    short = terms.select(F.col(term).alias("term")).filter((F.char_length("term") < N) & (F.char_length("term") > 0)).distinct()
    few = own.join(short, F.contains("text_", "term")).select("key_", "term")
    return long.unionByName(few).distinct().withColumnRenamed("key_", key)
