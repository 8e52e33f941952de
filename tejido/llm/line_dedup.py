"""Line dedup (operator 11): each line that several documents hold stays in the first of them only.

Every line of at least LEAST code points becomes a row of hashes, document and line number. The rows are range-partitioned by hash and sorted by
hash, document and number within each range, so that a window streams over the occurrences of a line, of which the first names the
document that keeps it. What comes back is no text but a keep bitmap for each document, compressed to the runs of lines that stay.
All of it is DataFrame functions.

A line that many documents hold is split: a sample of the rows tells which hashes have more than a quarter of a range's rows (at most four for
each range, whatever the input), and those are dealt by document as well. Each part names its first document, and the least of those
is the line's. The sample only balances the ranges; no result depends on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._shared import cut, drop_cut, fresh, shuffle_width

#: Lines whose key is shorter are never dropped.
LEAST = 10
#: What is stripped at the ends of a line.
SPACE = " \t\n\x0b\f\r"
#: Ranges are fair if no hash has more than this part of one's rows undivided.
PART = 4
#: Rows sampled for each range.
SAMPLED = 256

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """line without white space at its ends, A-Z in lower case; other letters as they are."""
    bare = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("print"), F.col("text").cast("string").alias("text"))


def lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """h, h2, doc_id, print, pos: 128 bits of the key of every line of at least `least` code points, and where it stands. print tells apart
    rows that repeat a doc_id with other texts."""
    each = _keyed(docs).filter("doc_id is not null and text is not null").select("doc_id", "print", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    long = each.filter(F.char_length(F.btrim("line", F.lit(SPACE))) >= least)
    key = line_key(F.col("line"))
    return long.select(F.xxhash64(key).alias("h"), F.xxhash64(F.lit(11), key).alias("h2"), "doc_id", "print", "pos")


def frequent(rows: DataFrame, width: int) -> DataFrame:
    """h, parts: hashes that would crowd a range, at most PART * width of them, and the parts into which each one's rows are dealt."""
    total = rows.count()
    share = min(1.0, SAMPLED * width / max(1, total))
    most = max(SAMPLED / PART, share * total / (PART * width))
    return rows.select("h").sample(share, seed=11).groupBy("h").count().filter(F.col("count") > most).select("h", F.ceil(F.col("count") / most).cast("int").alias("parts"))


def repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, print, pos: every line that a document with a lesser doc_id holds, once for rows that are equal as a whole."""
    spark = docs.sparkSession
    rows = cut(lines(docs, least), "lines")
    crowding = frequent(rows, shuffle_width(spark))
    dealt = rows.join(F.broadcast(crowding), "h", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("parts")), F.lit(0)))
    streamed = Window.partitionBy("h", "part", "h2").orderBy("doc_id", "print", "pos")
    own = F.struct("doc_id", "print", "pos")
    first = F.first("doc_id").over(streamed.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = dealt.repartitionByRange("h", "part").withColumn("first", first).withColumn("before", F.lag(own).over(streamed))
    several = seen.filter(~F.col("before").eqNullSafe(own) & ((F.col("first") < F.col("doc_id")) | F.col("parts").isNotNull()))
    found = cut(several.select("h", "h2", "doc_id", "print", "pos", "first", F.col("parts").isNotNull().alias("crowding")), "repeats")
    drop_cut(rows)
    # a row for each crowding hash
    heads = found.filter("crowding").groupBy("h", "h2").agg(F.min("first").alias("least"))
    return found.join(F.broadcast(heads), ["h", "h2"], "left").filter(F.col("doc_id") > F.coalesce("least", "first")).select("doc_id", "print", "pos")


def keep_bitmaps(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, print, n_dropped, keep: for each document that loses lines, the runs of lines that stay: where a run starts, and of how many
    lines it is; the last one has n null and goes on to the end. Documents without a row keep all their lines.

    Lines are what stands between line feeds. A line whose key (line_key()) has `least` code points or more is dropped where a document with a
    lesser doc_id has a line of the same key; all lines of the least one stay, repeated ones too. Rows that share a doc_id are one document,
    however their texts differ; each text has a bitmap of its own, found by print (xxhash64 of the text). Rows with a null doc_id or text
    have no bitmap and don't count as holders. No rows give no rows. Keys are compared by 128 bits of their hashes.
    """
    dealt = repeats(docs, least).repartition("doc_id", "print")
    rank = F.row_number().over(Window.partitionBy("doc_id", "print").orderBy("pos"))
    runs = dealt.withColumn("run", F.col("pos") - rank).groupBy("doc_id", "print", "run").agg(F.min("pos").alias("start"), F.count("*").cast("int").alias("n"))
    gone = runs.groupBy("doc_id", "print").agg(F.sum(F.col("n").cast("long")).alias("n_dropped"), F.sort_array(F.collect_list(F.struct("start", "n"))).alias("gone"))
    stop = lambda r: r["start"] + r["n"]
    up_to = F.transform("gone", lambda r, i: F.when(i == 0, F.struct(F.lit(0).alias("start"), r["start"].alias("n"))).otherwise(F.struct(stop(F.get("gone", i - 1)).alias("start"), (r["start"] - stop(F.get("gone", i - 1))).alias("n"))))
    last = F.array(F.struct(stop(F.element_at("gone", -1)).alias("start"), F.lit(None).cast("int").alias("n")))
    return gone.select("doc_id", "print", "n_dropped", F.concat(F.filter(up_to, lambda r: r["n"] > 0), last).alias("keep"))


def deduplicated(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, text, n_lines, n_dropped of all rows of docs, text being joined of the lines that its bitmap keeps; null and empty texts are one empty line."""
    maps = keep_bitmaps(docs, least).withColumnsRenamed({"doc_id": "of", "print": "as"}).hint("shuffle_hash")
    joined = _keyed(docs).join(maps, (F.col("doc_id") == F.col("of")) & (F.col("print") == F.col("as")), "left").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "n_dropped", "keep")
    parted = joined.withColumn("lines", F.split("text", "\n"))
    stay = F.flatten(F.transform("keep", lambda r: F.slice("lines", r["start"] + 1, F.coalesce(r["n"], F.size("lines")))))
    text = F.when(F.col("keep").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n"))
    return parted.select("doc_id", text.alias("text"), F.size("lines").cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"))


def report(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of all rows of docs."""
    return deduplicated(docs, least).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def drop_repeated_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """docs, all columns, with the text that deduplicated() gives; null texts stay null."""
    own, mark = fresh("keep", docs.columns), fresh("print", docs.columns)
    maps = keep_bitmaps(docs, least).select(F.col("doc_id").alias(f"{mark}_id"), F.col("print").alias(f"{mark}_as"), F.col("keep").alias(own)).hint("shuffle_hash")
    joined = docs.withColumn(mark, F.xxhash64("text")).join(maps, (F.col("doc_id").cast("long") == F.col(f"{mark}_id")) & (F.col(mark) == F.col(f"{mark}_as")), "left")
    parted = joined.withColumn(mark, F.split("text", "\n"))
    stay = F.flatten(F.transform(own, lambda r: F.slice(mark, r["start"] + 1, F.coalesce(r["n"], F.size(mark)))))
    return parted.withColumn("text", F.when(F.col(own).isNull(), F.col("text")).otherwise(F.array_join(stay, "\n"))).select(docs.columns)
