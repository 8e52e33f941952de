"""Sources: uploads page by page in batches and streams, sitemaps and feeds by row tags, links by a table function."""

import json
import os

from tejido.functions.register import register
from tejido.sources import readers, services
from tejido.streaming import flows


def respond(root, channel, token, ids, following=None, raw=None):
    folder = f"{root}/channel_id={channel}/token={token}"
    os.makedirs(folder, exist_ok=True)
    items = [{"snippet": {"title": f"t{i}", "resourceId": {"videoId": str(i)}, "publishedAt": "2024-01-01T00:00:00Z"}} for i in ids]
    with open(f"{folder}/part-0.txt", "w") as f:
        f.write(raw if raw is not None else json.dumps({"items": items} | ({"nextPageToken": following} if following else {})))


def batch(spark, root, most=500):
    services.register(spark)
    rows = spark.read.format("channel_uploads").option("path", root).option("most", most).load().collect()
    return sorted((r.channel_id, r.rank, r.video_id) for r in rows)


def test_cursors_are_followed_in_each_channel(spark, tmp_path):
    root = str(tmp_path / "r")
    respond(root, "a", "first", [1, 2], "p9")
    respond(root, "a", "p9", [3], "p2")
    respond(root, "a", "p2", [4], "first")  # a circle
    respond(root, "b", "first", [7, 8], "gone")
    respond(root, "c", "p1", [9])  # its first response has not landed
    respond(root, "d", "first", [], raw="no json")
    respond(root, "e%20f", "first", [5])
    assert batch(spark, root) == [("a", 1, "1"), ("a", 2, "2"), ("a", 3, "3"), ("a", 4, "4"), ("b", 1, "7"), ("b", 2, "8"), ("e f", 1, "5")]
    assert batch(spark, root, 3) == [("a", 1, "1"), ("a", 2, "2"), ("a", 3, "3"), ("b", 1, "7"), ("b", 2, "8"), ("e f", 1, "5")]
    services.register(spark)
    assert spark.read.format("channel_uploads").option("path", root).load().rdd.getNumPartitions() == 5
    assert batch(spark, str(tmp_path / "none")) == []


def test_a_stream_reads_what_lands_later(spark, tmp_path, monkeypatch):
    root, out = str(tmp_path / "r"), str(tmp_path / "out")
    services.register(spark)
    respond(root, "a", "first", [1, 2], "p1")
    respond(root, "a", "p1", [3], "p2")

    def run():
        flows.run_stream(spark.readStream.format("channel_uploads").option("path", root).load(), flows.batch_sink(out), str(tmp_path / "state"))
        return sorted((r.batch, r.channel_id, r.video_id) for r in spark.read.parquet(out).collect())

    assert run() == [(0, "a", "1"), (0, "a", "2"), (0, "a", "3")]
    respond(root, "a", "p2", [4], "p10")
    respond(root, "a", "p10", [5])
    respond(root, "b", "first", [9])
    assert run() == [(0, "a", "1"), (0, "a", "2"), (0, "a", "3"), (1, "a", "4"), (1, "a", "5"), (1, "b", "9")]


def test_pages_of_a_stream_are_shared_out():
    stream = services.UploadsStream("x")
    assert services._in_order({"p10": "c", "first": "a", "p2": "b"}) == ["a", "b", "c"]
    assert stream.initialOffset() == {} and stream.latestOffset() == {} and stream.partitions({}, {}) == []


def test_sitemaps_of_any_form(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc> https://a.mx/1?x=1&amp;y=2 </loc><lastmod>2024</lastmod></url><url><loc/></url><url></url></urlset>')
    (tmp_path / "b.xml").write_text('<s:urlset xmlns:s="urn:x"><s:url><s:loc>https://b.mx/1</s:loc></s:url></s:urlset>')
    (tmp_path / "c.xml").write_text("<urlset>" + "".join(f"<url><loc>https://c.mx/{k}</loc></url>" for k in range(20_000)) + "</urlset>")
    (tmp_path / "d.xml").write_text("no xml")
    (tmp_path / "e.xml").write_text("<sitemapindex><sitemap><loc>https://e.mx/s.xml</loc></sitemap></sitemapindex>")
    urls = [r.url for r in readers.read_sitemaps(spark, str(tmp_path / "[abcd].xml")).collect()]
    assert len(urls) == 20_002 and {"https://a.mx/1?x=1&y=2", "https://b.mx/1", "https://c.mx/19999"} <= set(urls)
    assert [r.url for r in readers.read_sitemaps(spark, str(tmp_path / "e.xml"), "sitemap").collect()] == ["https://e.mx/s.xml"]


def test_feeds_of_both_kinds(spark, tmp_path):
    (tmp_path / "rss.xml").write_text('<rss xmlns:dc="urn:d"><channel><item><title> A &amp; B </title><link>https://a.mx/1</link><category>x</category><category>y</category><pubDate>Mon, 01 Jan 2024 10:00:00 +0000</pubDate><guid isPermaLink="false">g1</guid></item><item><title>no link</title></item></channel></rss>')
    (tmp_path / "atom.xml").write_text('<feed xmlns="http://www.w3.org/2005/Atom"><entry><link rel="self" href="https://b.mx/1"/><summary>s</summary><category term="z"/><updated>2024-01-02T00:00:00Z</updated><id>i1</id></entry></feed>')
    found = {r.url: (r.title, r.description, str(r.published_date), r.categories, r.entry_id) for r in readers.read_feeds(spark, str(tmp_path)).collect()}
    assert found == {"https://a.mx/1": ("A & B", "", "2024-01-01 10:00:00", ["x", "y"], "g1"), "https://b.mx/1": ("Sin título", "s", "2024-01-02 00:00:00", ["z"], "i1")}


def test_links_by_a_table_function(spark):
    register(spark)
    spark.createDataFrame([(1, '<a href="/x">uno</a><a>no</a><a href="/y"> dos </a>'), (2, None), (3, "")], "id int, html string").createOrReplaceTempView("linked")
    rows = spark.sql("SELECT id, l.* FROM linked, LATERAL html_links(html) l").collect()
    assert sorted(map(tuple, rows)) == [(1, 0, "/x", "uno"), (1, 1, "/y", "dos")]
