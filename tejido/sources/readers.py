"""Readers of landed data: configuration, forum and video records, feeds, sitemaps, domain lists, corpora, bytes, robots rules, PDF."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..functions import text
from ..schemas import SOURCE_CONFIG

#: Sections of a configuration, and the keys that some of them must have.
SECTIONS = ["politeness", "extraction", "validation", "storage", "concurrency"]
REQUIRED = {"politeness": ["user_agent", "request_delay", "timeout"], "validation": ["min_words", "min_sentences"], "storage": ["output_dir", "state_db", "snapshot_dir"]}


class ConfigError(ValueError):
    """A configuration that lacks sections or keys."""


def config(document: str, required: dict[str, list[str]] | None = None) -> dict:
    """A YAML configuration with all sections and required keys."""
    import yaml

    found = yaml.safe_load(document) or {}
    if missing := [s for s in SECTIONS if s not in found]:
        raise ConfigError(f"sections are missing: {missing}")
    for section, keys in (required or REQUIRED).items():
        if missing := [k for k in keys if k not in (found[section] or {})]:
            raise ConfigError(f"{section} lacks {missing}")
    return found


def source_catalog(spark: SparkSession, document: str) -> DataFrame:
    """One row a source of a YAML list under `sources`; each must have name and type."""
    import yaml

    rows = (yaml.safe_load(document) or {}).get("sources") or []
    for r in rows:
        if not {"name", "type"} <= set(r):
            raise ConfigError(f"a source lacks name or type: {r}")
    names = [c.split(" ")[0] for c in SOURCE_CONFIG.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], SOURCE_CONFIG)


def seeds(catalog: DataFrame) -> DataFrame:
    """Configured URLs of every source."""
    return catalog.select("name", F.explode(F.concat(F.coalesce("urls", F.array().cast("array<string>")), F.coalesce("start_urls", F.array().cast("array<string>")))).alias("url"))


def ranked_domains(lines: DataFrame, most: int = 1_000_000) -> DataFrame:
    """rank and domain of `rank,domain` lines (column value); lines of fewer fields or without a number are dropped."""
    parts = F.split("value", ",")
    return lines.filter(F.size(parts) >= 2).select(parts[0].try_cast("int").alias("rank"), F.lower(F.trim(parts[1])).alias("domain")).filter(F.col("rank").between(1, most))


def read_ranked_domains(spark: SparkSession, path: str) -> DataFrame:
    """A domain list as CSV, or as a zip archive with one."""
    if not path.endswith(".zip"):
        return ranked_domains(spark.read.text(path))
    files = spark.read.format("binaryFile").load(path).select("content")

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile

        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(z.namelist()[0]) as f:
                    while part := f.readlines(1 << 20):
                        yield pd.DataFrame({"value": [x.decode("utf-8", "ignore").rstrip("\r\n") for x in part]})

    return ranked_domains(files.mapInPandas(lines, "value string"))


def feed_entries(feeds: DataFrame) -> DataFrame:
    """Entries of feeds (source, feed_url, xml), each item's fields kept together; entries without a link are dropped."""
    schema = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("title", "link", "description", "published", "category", "id")]))
    parsed = pandas_udf(_items, schema)
    return feeds.select("source", "feed_url", F.explode(parsed(text.without_controls(F.col("xml")))).alias("e")).select(
        F.col("e.link").alias("url"), F.coalesce("e.title", F.lit("Sin título")).alias("title"), F.coalesce("e.description", F.lit("")).alias("description"), published(F.col("e.published")).alias("published_date"),
        F.filter(F.split(F.coalesce("e.category", F.lit("")), "\x1f"), lambda c: c != "").alias("categories"), "source", "feed_url", F.coalesce("e.id", "e.link").alias("entry_id"),
    ).filter(F.coalesce("url", F.lit("")) != "")


def _items(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    from xml.etree import ElementTree

    local = lambda e: e.tag.rpartition("}")[2]
    for s in text.in_parts(batches):
        out = []
        for xml in s:
            try:
                root = ElementTree.fromstring(xml or "")
            except ElementTree.ParseError:
                out.append([])
                continue
            items = []
            for e in (e for e in root.iter() if local(e) in ("item", "entry")):
                text_of = lambda *names: next((c.text for n in names for c in e if local(c) == n and c.text), None)  # noqa: B023, E731
                link = next((c.get("href") or (c.text or "").strip() for c in e if local(c) == "link"), None)
                category = "\x1f".join(c.get("term") or c.text or "" for c in e if local(c) == "category")
                items.append({"title": text_of("title"), "link": link, "description": text_of("description", "summary"), "published": text_of("pubDate", "published", "updated"), "category": category, "id": text_of("guid", "id")})
            out.append(items)
        yield pd.Series(out, dtype=object)


def published(value: Column) -> Column:
    """Time of an RFC 822 or ISO 8601 date; null if it is neither."""
    rfc = F.try_to_timestamp(F.regexp_replace(value, r"^[A-Za-z]{3},\s*", ""), F.lit("d MMM yyyy HH:mm:ss Z"))
    return F.coalesce(rfc, F.try_to_timestamp(value))


def read_sitemaps(spark: SparkSession, path: str, row_tag: str = "url") -> DataFrame:
    """url and file of the sitemaps under path, whatever their size: each <url> is a row as the file is read, no file is one string. With row_tag `sitemap`, the
    sitemaps that an index names. Name spaces are passed over; entries without an address, and what is no XML, are left out."""
    rows = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", "true").option("mode", "DROPMALFORMED").schema("loc string").load(path)
    return rows.select(F.trim("loc").alias("url"), F.col("_metadata.file_path").alias("file")).filter("url <> ''")


#: An item of RSS or an entry of Atom; a link is text, or an address in an attribute; a category text, or a term.
FEED_ROW = (
    "title string, link array<struct<_VALUE: string, _href: string>>, description string, summary string, pubDate string, published string, updated string, "
    "category array<struct<_VALUE: string, _term: string>>, guid struct<_VALUE: string>, id string"
)


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """Entries of the feed files under path as feed_entries() has them, with the file in place of source and feed_url: each item (RSS) or entry (Atom) is a row
    as the file is read. Files with characters that XML doesn't allow are for feed_entries(), which takes those out."""
    read = lambda tag: spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", "true").option("mode", "DROPMALFORMED").schema(FEED_ROW).load(path).withColumn("file", F.col("_metadata.file_path"))
    rows = read("item").unionByName(read("entry"))
    links = F.filter(F.transform("link", lambda x: F.trim(F.coalesce(x["_href"], x["_VALUE"]))), lambda x: x != "")
    categories = F.filter(F.transform("category", lambda c: F.coalesce(c["_term"], c["_VALUE"], F.lit(""))), lambda c: c != "")
    told = rows.withColumn("url", F.get(links, 0))
    return told.filter("url is not null").select(
        "url", F.coalesce(F.trim("title"), F.lit("Sin título")).alias("title"), F.coalesce("description", "summary", F.lit("")).alias("description"), published(F.coalesce("pubDate", "published", "updated")).alias("published_date"),
        F.coalesce(categories, F.array().cast("array<string>")).alias("categories"), "file", F.coalesce("guid._VALUE", "id", "url").alias("entry_id"),
    )


def sitemap_urls(xml: Column) -> Column:
    return F.transform(F.xpath(xml, F.lit("//*[local-name()='url']/*[local-name()='loc']/text()")), lambda u: F.trim(u))


#: A response of a video service's list of uploads, and one item of it.
UPLOAD = "struct<snippet: struct<title: string, description: string, publishedAt: string, resourceId: struct<videoId: string>>>"
UPLOADS = f"struct<nextPageToken: string, items: array<{UPLOAD}>>"


def channel_videos(responses: DataFrame, most: int, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """channel_id, rank, video_id, title, description and published_at of landed responses (channel_id, token, json), of which a channel's
    first one has no token and each names the next one's. A channel ends with a response that names none, one that hasn't landed or one
    that was read before, or at `most` videos.

    A round follows all channels' cursors by one response; rounds carry tokens and counts only, which keep() writes, and the items are
    read at the end. Responses that landed twice count once.
    """
    page = F.from_json("json", UPLOADS)
    landed = responses.groupBy("channel_id", F.coalesce("token", F.lit("")).alias("token")).agg(F.min("json").alias("json")).select("channel_id", "token", page.alias("page"))
    items = F.coalesce(F.col("page.items"), F.array().cast(f"array<{UPLOAD}>"))
    cursors = keep(landed.select("channel_id", "token", F.nullif("page.nextPageToken", F.lit("")).alias("next"), F.size(items).alias("n")))
    newest = keep(cursors.filter("token = ''").withColumn("before", F.lit(0)))
    read = newest
    while not newest.isEmpty():
        ahead = newest.filter((F.col("before") + F.col("n") < most) & F.col("next").isNotNull()).select("channel_id", F.col("next").alias("token"), (F.col("before") + F.col("n")).alias("before"))
        newest = keep(ahead.join(cursors, ["channel_id", "token"]).join(read.select("channel_id", "token"), ["channel_id", "token"], "left_anti").select(*newest.columns))
        read = read.unionByName(newest)
    found = landed.join(read.select("channel_id", "token", "before"), ["channel_id", "token"]).select("channel_id", "before", F.posexplode(items).alias("at", "item"))
    return found.withColumn("rank", F.col("before") + F.col("at") + 1).filter(F.col("rank") <= most).select(
        "channel_id", "rank", F.col("item.snippet.resourceId.videoId").alias("video_id"), F.col("item.snippet.title").alias("title"),
        F.col("item.snippet.description").alias("description"), F.col("item.snippet.publishedAt").alias("published_at"),
    )


def transcripts(segments: DataFrame, languages: list[str] = ("es", "es-MX")) -> DataFrame:
    """video_id and text of (video_id, lang, seq, text): the first listed language that a video has, its segments cleaned and joined."""
    order = F.array_position(F.array(*map(F.lit, languages)), F.col("lang"))
    cleaned = segments.withColumn("order", order).filter("order > 0").withColumn("line", text.clean_segment(F.col("text")))
    joined = cleaned.groupBy("video_id", "order").agg(F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("seq", "line"))), lambda s: s["line"]), lambda x: x != ""), " ").alias("text"))
    return joined.groupBy("video_id").agg(F.min_by("text", "order").alias("text"))


def key_of_file(path: Column) -> Column:
    """The content key at the end of a file's name, if that has three parts or more."""
    parts = F.split(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.txt$", ""), "_")
    return F.when(F.size(parts) >= 3, F.element_at(parts, -1))


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """path, text and content key of all text files below a folder."""
    rows = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt").select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return rows.withColumn("content_hash", key_of_file(F.col("path")))


def decoded(content: Column) -> Column:
    """Text of bytes: UTF-8 if they are valid, or else Latin-1."""
    return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))


def robots_rules(lines: DataFrame) -> DataFrame:
    """host, agent, rule and path of robots.txt lines (host, seq, line): a rule is for all user-agents of the group before it, which are
    those named in successive lines."""
    from pyspark.sql.window import Window

    agent = F.nullif(F.lower(F.trim(F.regexp_extract("line", r"(?i)^\s*user-agent:\s*([^#]*)", 1))), F.lit(""))
    rule, path = F.lower(F.regexp_extract("line", r"(?i)^\s*(allow|disallow):", 1)), F.trim(F.regexp_extract("line", r"(?i)^\s*(?:allow|disallow):\s*([^#]*)", 1))
    told = lines.select("host", "seq", agent.alias("agent"), rule.alias("rule"), path.alias("path")).filter("agent is not null or rule <> ''")
    order = Window.partitionBy("host").orderBy("seq")  # the lines of one file
    opens = F.col("agent").isNotNull() & F.lag("agent").over(order).isNull()
    grouped = told.withColumn("opens", opens.cast("int")).withColumn("group", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    named = grouped.filter("agent is not null").groupBy("host", "group").agg(F.collect_set("agent").alias("agents"))
    return grouped.filter("agent is null and path <> ''").join(named, ["host", "group"]).select("host", F.explode("agents").alias("agent"), "rule", "path")


#: What a content stream is made of: strings, hexadecimal strings, arrays, numbers, names and operators.
PDF_TOKEN = re.compile(rb"\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>|\[(?:\((?:\\.|[^\\()])*\)|[^\]()])*\]|[-+]?\d*\.?\d+|/[^\s/\[\]()<>]+|[A-Za-z*'\"]+", re.S)
PDF_STRING = re.compile(rb"\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>", re.S)
PDF_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
PDF_FIELDS = {"title": b"Title", "author": b"Author", "subject": b"Subject", "creator": b"Creator", "creation_date": b"CreationDate"}


def _pdf_string(raw: bytes) -> str:
    if raw[:1] == b"<":
        digits = re.sub(rb"\s", b"", raw[1:-1])
        return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode()).decode("utf-8", "replace")

    def plain(m: re.Match) -> bytes:
        code = m.group(1)
        return bytes([int(code, 8) & 255]) if code[:1].isdigit() else PDF_ESCAPES.get(code, code)

    return re.sub(rb"\\([0-7]{1,3}|.)", plain, raw[1:-1], flags=re.S).decode("utf-8", "replace")


def _pdf_shown(stream: bytes) -> list[tuple[float, float, str]]:
    """x, y and text of every string that a content stream shows, in its order. Only moves are followed, not the widths of glyphs."""
    out, stack = [], []
    x = y = leading = 0.0
    for m in PDF_TOKEN.finditer(stream):
        token = m.group()
        if token[:1] in b"(<[/" or token[-1:].isdigit() or token[-1:] == b".":
            stack.append(token)
            continue
        numbers = [float(t) for t in stack if re.fullmatch(rb"[-+]?\d*\.?\d+", t)]
        if token == b"BT":
            x = y = 0.0
        elif token in (b"Td", b"TD") and len(numbers) >= 2:
            x, y = x + numbers[-2], y + numbers[-1]
            leading = -numbers[-1] if token == b"TD" else leading
        elif token == b"Tm" and len(numbers) >= 6:
            x, y = numbers[-2:]
        elif token == b"TL" and numbers:
            leading = numbers[-1]
        elif token in (b"T*", b"'", b'"'):
            y -= leading
        if token in (b"Tj", b"TJ", b"'", b'"') and stack:
            out.append((x, y, "".join(map(_pdf_string, PDF_STRING.findall(stack[-1])))))
        stack = []
    return out


def _pdf_tables(shown: list[tuple[float, float, str]]) -> list[str]:
    """Runs of two and more successive rows (strings of one height) that have two and more strings at the same places."""
    rows: list[tuple[float, list[tuple[float, str]]]] = []
    for x, y, cell in shown:
        if not rows or rows[-1][0] != y:
            rows.append((y, []))
        rows[-1][1].append((x, cell))
    tables, run, places = [], [], None
    for _, cells in [*rows, (0.0, [])]:
        own = tuple(x for x, _ in cells)
        if own != places:
            tables += [run] if len(run) > 1 else []
            run, places = [], own if len(set(own)) == len(own) > 1 else None
        if places:
            run.append("\t".join(cell for _, cell in cells))
    return ["\n[TABLA]\n" + "\n".join(t) + "\n[/TABLA]\n" for t in tables]


def pdf_of(content: bytes | None) -> dict | None:
    """Text, tables and document fields of a PDF: strings shown in plain or deflated streams, a line each, pages apart by an empty line,
    each page's tables after its text as tab-separated [TABLA] blocks. None if the bytes are no PDF. Fonts with an encoding of their own
    are not decoded, and tables are told by the places of their cells, not by ruled lines."""
    if not content or content[:5] != b"%PDF-":
        return None
    parts, found = [], 0
    for raw in re.findall(rb"stream\r?\n(.*?)\r?\nendstream", content, re.S):
        try:
            raw = zlib.decompress(raw)
        except zlib.error:
            pass
        shown = _pdf_shown(raw)
        if shown:
            tables = _pdf_tables(shown)
            found += len(tables)
            parts += ["\n".join(s for _, _, s in shown), *tables]
    out = {"text": "\n\n".join(parts), "total_pages": len(re.findall(rb"/Type\s*/Page\b", content)), "tables_found": found}
    for name, key in PDF_FIELDS.items():
        value = re.search(rb"/" + key + rb"\s*(\((?:\\.|[^\\()])*\))", content, re.S)
        out[name] = _pdf_string(value.group(1)) if value else ""
    return out


def pdf(content: Column) -> Column:
    """Struct of text, total_pages, tables_found, title, author, subject, creator and creation_date; its text is null if bytes are no PDF."""
    types = {"total_pages": T.IntegerType(), "tables_found": T.IntegerType()}
    names = ["text", *types, *PDF_FIELDS]

    @pandas_udf(T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in names]))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in text.in_parts(batches):
            found = [pdf_of(b) or {} for b in s]
            yield pd.DataFrame({n: pd.Series([f.get(n) for f in found], dtype=object if n not in types else "Int32") for n in names})

    return run(content)


def pdf_text(content: Column) -> Column:
    return pdf(content)["text"]
