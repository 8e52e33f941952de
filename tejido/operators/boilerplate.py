"""Main text without boilerplate: pages are cut into blocks, which are judged by their links, their words, and how many pages of the host hold them.

Blocks stand between block-level tags. One is boilerplate if it is part of the site's template, that is, found on several of the host's pages and on a
good share of them; if a third of its characters and more are links; or if it is short and stands beside no long block. Counts are summed in each
task before the shuffle, so a host with many pages is gathered nowhere; a page's blocks come together in the end. All of it is regular
expressions and aggregates on columns; pages that have too little text so are read by the tag-dropping reader.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html, urls

# Elements without text to read, block-level tags, and named characters.
DROPPED = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>|<head\b.*?</head\s*>|<!--.*?-->|<!doctype[^>]*>"
BLOCKS = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h1|h2|h3|h4|h5|h6|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)"
    r"(?:\s[^>]*)?/?>"
)
ANCHOR = r"(?is)<a\b[^>]*>(.*?)</a\s*>"
TAG = r"<[^>]*>"
SPACE = r"[\x09-\x0D ]+"
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&copy;": "©", "&middot;": "·", "&amp;": "&"}

#: Pages of a host that a template's block is found on at least, and their share.
TEMPLATE_PAGES, TEMPLATE_SHARE = 3, 0.1
#: Words of a long block, and of a block that may stand beside one.
LONG, SHORT = 10, 3
#: Share of characters in links that a block of text stays below.
LINKED = 1 / 3
#: Characters of a main text, without which the tag-dropping reader is asked, and of what that must find.
ENOUGH, LEAST = 50, 20


def plain(fragment: Column) -> Column:
    """Text of a fragment without tags, named characters decoded, white space collapsed."""
    out = F.regexp_replace(fragment, TAG, "")
    for name, character in ENTITIES.items():
        out = F.replace(out, F.lit(name), F.lit(character))
    return F.btrim(F.regexp_replace(out, SPACE, " "))


def blocks(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """page, key, host, pos, block, n_words, linked of the blocks with text of pages (page_id, url, html); key tells apart rows that repeat a page_id, equal
    rows are one. linked: the share of characters that are in links."""
    rows = pages.select(F.col(page_id).alias("page"), _key().alias("key"), urls.host(F.col("url")).alias("host"), "html").filter("html is not null").dropDuplicates(["page", "key"])
    each = rows.select("page", "key", "host", F.posexplode(F.split(F.regexp_replace("html", DROPPED, " "), BLOCKS)).alias("pos", "fragment"))
    links = plain(F.array_join(F.regexp_extract_all("fragment", F.lit(ANCHOR), 1), " "))
    read = each.withColumn("block", plain(F.col("fragment"))).filter("block <> ''")
    return read.select("page", "key", "host", "pos", "block", F.size(F.split("block", " ")).alias("n_words"), (F.length(links) / F.length("block")).alias("linked"))


def _key() -> Column:
    return F.md5(F.concat(F.coalesce("url", F.lit("")), F.lit("\n"), F.coalesce("html", F.lit(""))))


def templates(rows: DataFrame, least: int = TEMPLATE_PAGES, share: float = TEMPLATE_SHARE) -> DataFrame:
    """host and print (MD5) of the blocks that are part of a host's template."""
    found = rows.select("host", F.md5("block").alias("print"), "page", "key").distinct().groupBy("host", "print").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    sizes = rows.select("host", "page", "key").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    return found.join(sizes, "host").filter(F.col("n") >= F.col("pages") * share).select("host", "print")


def dense_text(rows: DataFrame) -> DataFrame:
    """page, key, text: the blocks of text of each page, in order, a line each; pages without one are left out."""
    marks = templates(rows).withColumn("template", F.lit(True))
    marked = rows.withColumn("print", F.md5("block")).join(marks, ["host", "print"], "left")
    plain_ = F.col("linked") <= LINKED
    packed = marked.select("page", "key", F.struct("pos", "block", "n_words", plain_.alias("plain"), F.col("template").isNull().alias("own")).alias("b"))
    pages = packed.groupBy("page", "key").agg(F.sort_array(F.collect_list("b")).alias("blocks"))  # the blocks of one page
    long = lambda b: F.coalesce(b["plain"] & (b["n_words"] >= LONG), F.lit(False))
    beside = lambda i: long(F.get("blocks", i - 1)) | long(F.get("blocks", i + 1))
    kept = F.filter("blocks", lambda b, i: b["own"] & b["plain"] & ((b["n_words"] >= LONG) | ((b["n_words"] >= SHORT) & beside(i))))
    return pages.select("page", "key", F.array_join(F.transform(kept, lambda b: b["block"]), "\n").alias("text")).filter("text <> ''")


def main_text(pages: DataFrame, page_id: str = "page_id", keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """page_id, method, text of every row of pages (page_id, url, html): method `blocks`; `fallback` where those have fewer than ENOUGH characters, with what the
    tag-dropping reader finds; null, like the text, if that is less than LEAST. keep() materialises the blocks, which are read twice.

    Null pages have no text. Pages without a host have no templates. Equal rows get the same text. No rows give no rows.
    """
    dense = keep(dense_text(keep(blocks(pages, page_id)))).filter(F.length("text") >= ENOUGH)
    rows = pages.select(F.col(page_id).alias("page"), _key().alias("key"), "html")
    same = lambda a, b: a["page"].eqNullSafe(b["page"]) & (a["key"] == b["key"])
    good = rows.drop("html").join(dense, same(rows, dense)).select(rows["page"].alias(page_id), F.lit("blocks").alias("method"), "text")
    rest = rows.join(dense, same(rows, dense), "left_anti").select("page", html.main_text("html").alias("text"))
    enough = F.coalesce(F.length("text"), F.lit(0)) >= LEAST
    return good.unionByName(rest.select(F.col("page").alias(page_id), F.when(enough, "fallback").alias("method"), F.when(enough, F.col("text")).alias("text")))
