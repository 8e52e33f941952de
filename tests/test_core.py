"""Literal cases with answers worked out by hand, for expressions, pages, readers, the frontier and the session."""

import json
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tejido.functions import html, scoring, text, urls
from tejido.functions.register import register
from tejido.operators import frontier
from tejido.plans.session import Harvest, HarvestError, main
from tejido.sources import readers


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def lit(x):
    return F.lit(x).cast("string") if x is None else F.lit(x)


@pytest.mark.parametrize("url, want", [("https://www.unam.mx/noticia/2025/mexico.pdf", 6.3), ("https://example.org/x", 1.0)])
def test_url_priority(spark, url, want):
    assert one(spark, urls.priority(F.lit(url))) == pytest.approx(want)


def test_domain_score(spark):
    row = spark.range(1).select(urls.domain_score(F.lit("www.gob.mx"), F.lit(500), urls.domain_indicators(F.lit("www.gob.mx"))).alias("s"), urls.domain_category(F.lit("www.gob.mx"), urls.domain_indicators(F.lit("www.gob.mx"))).alias("c")).first()
    assert (row.s, row.c) == (51.5, "government")


def test_links(spark):
    u, a = F.lit("https://www.unam.mx/tesis"), F.lit("Tesis de investigación")
    assert one(spark, urls.link_score(u, a)) == 18.0 and one(spark, urls.link_type(u, a)) == "academic"
    assert one(spark, urls.link_score(F.lit("https://e.com/a"), F.lit("12"))) == 0.0


def test_geography(spark):
    g = one(spark, scoring.geography(F.lit("La UNAM y el gobierno de México en Puebla cobran $ 100 pesos"), F.lit("")))
    assert (g.institutional, g.regional, g.linguistic, g.other, g.score, g.confidence) == (2, 3, 1, 1, 40, "high")
    for t, n in (("tel 222 123 4567", 2), ("tel 55 123 4567", 1), ("55 1234 5678", 1), ("C.P. 06600", 1), (None, 0)):
        assert one(spark, scoring.geography(lit(t)))["other"] == n
    assert one(spark, urls.url_score(F.lit("https://www.gob.mx/sep"))) == 36


def test_region(spark):
    r = one(spark, scoring.region(F.lit("en guadalajara y jalisco, tapatío; también monterrey")))
    assert (r.region, r.confidence) == ("occidente", "high")
    assert one(spark, scoring.region(lit(None))).region == "unknown"


def test_overall(spark):
    total = one(spark, scoring.overall(*map(F.lit, (40.0, 60.0, 50.0, 20.0, 70.0))))
    assert total == pytest.approx(50.5) and one(spark, scoring.overall_confidence(F.lit(total))) == "medium"


@pytest.mark.parametrize("t, want", [("a. b! c", 3), ("abc", 2), ("", 0), (None, 0)])
def test_sentence_estimate(spark, t, want):
    assert one(spark, text.sentence_estimate(lit(t))) == want


@pytest.mark.parametrize("t, want", [("jaaaaa", True), ("jaaaa", False), ("http://x.com www. casino", True)])
def test_spam(spark, t, want):
    assert one(spark, text.is_spam(F.lit(t))) is want


@pytest.mark.parametrize("n, want", [(9, False), (10, True), (2000, True), (2001, False)])
def test_comment_lengths(spark, n, want):
    assert one(spark, text.comment_admissible(F.lit(("el " * 1000)[:n]))) is want


@pytest.mark.parametrize(
    "make, given_, want",
    [
        (text.safe_name, 'Órale: "Güey" / Vol. 1', "rale_gey_vol._1"), (text.clean, "a \t b\r\n", "a b"), (text.clean, "  \n\n\n\nx\x00�\x07 Ã±", "x ñ"), (text.clean, None, ""),
        (text.clean_lyrics, "[Coro] Hola.Mundo (x2) 01:23 @yo", "Hola. Mundo"), (text.clean_pdf, "palabra cor-\n tada\n 12 \nfin ---- ●", "palabra cortada\nfin"),
        (text.clean_gazette, "uno\nPágina 3 de 4\ndos\n1 de mayo de 2024\ntres", "uno\ndos\ntres"), (text.clean_legislature, "x\n Artículo 1. y\nTítulo IV", "x\n\nArtículo 1. y\n\nTítulo IV"), (text.clean_segment, " [Música]  hola  que ", " hola que"),
    ],
)
def test_cleaning(spark, make, given_, want):
    assert one(spark, make(lit(given_))) == want


def test_quality_ladder(spark):
    def level(t):
        q = one(spark, text.quality(lit(t)))
        return q.text_quality, q.is_valid

    assert level("x" * 49) == ("too_short", False) and level(None) == ("too_short", False)
    assert level("texto " * 20 + "£¤¥¦") == ("binary", False)
    assert level("\x01\x02" * 30 + "a" * 60)[1] is False
    assert level("á é í ó " * 20) == ("good", True)
    assert level("the quick brown fox " * 5) == ("acceptable", True)
    assert level("abc def � " * 21) == ("corrupted", False)
    assert level("abc zzz " * 20 + "� " * 6) == ("poor", False)


@settings(max_examples=40, deadline=None)
@given(st.text(max_size=300))
def test_tolerant_parser_never_fails(t):
    html.main_text_of(f"<article>{t}</article><p>{t}")
    html.links_of(t)
    assert html.parse(None).text() == ""


def test_selectors():
    root = html.parse('<div class="a b"><ul class=x><li><a href="/artista/q/">Q</a><li id=z>y</ul><p>one<p data-k="v w">two <b>three</div><section><p>four</section>')
    assert [n.text() for n in html.select(root, "p")] == ["one", "twothree", "four"]
    assert [len(html.select(root, s)) for s in ("div.a.b > ul a", "div > a", "#z", '[data-k~="w"]', 'a[href*="/artista/"]', "li, section", "[href^='/']")] == [1, 0, 1, 1, 1, 3, 1]
    html.drop(root, "ul")
    assert not html.select(root, "li")


def test_debate_and_rules():
    said = html.debate_lines("nadie\nEL PRESIDENTE Gómez: Se abre.\nSigue.\nANA: Sí.")
    assert said == "EL: Se abre. Sigue.\n\nANA: Sí."
    assert html.rule_of("www.scjn.gob.mx") == "scjn.gob.mx" and html.rule_of("www.scjn.gob.mx", True) == "gob.mx"
    assert html.rule_of("www.example.com.mx") is None and html.rule_of("www.example.com.mx", True) == "jornada.com.mx"
    assert html.site_extract("<p>x", "www.example.org")["success"] is False


def test_song_and_next_page():
    s = html.song_of('<h1>T</h1><div class="cnt-letra"><script>x</script><p>Uno<p>Dos.</div><span class="cnt-info">1,234 views</span>', "https://h.example/el-grupo/song/")
    assert (s["title"], s["artist"], s["views"], s["paragraphs"], s["language"]) == ("T", "El Grupo", "1,234", ["Uno", "Dos."], "es")
    assert html.next_page_of('<div class="cnt-paginacao"><ul><li class="current">3</li><li><a href="/l/1/">1</a></ul></div>', "https://h.example/l/3/") == "https://h.example/l/4/"
    assert html.next_page_of("", "https://h.example/") is None


def test_readers(spark, tmp_path):
    import zipfile

    with pytest.raises(readers.ConfigError):
        readers.config("politeness: {}")
    with pytest.raises(readers.ConfigError):
        readers.source_catalog(spark, "sources: [{name: x}]")
    with zipfile.ZipFile(tmp_path / "top.zip", "w") as z:
        z.writestr("top.csv", "1,WWW.Gob.MX\nbad\n2, example.org \n")
    assert [tuple(r) for r in readers.read_ranked_domains(spark, str(tmp_path / "top.zip")).orderBy("rank").collect()] == [(1, "www.gob.mx"), (2, "example.org")]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "s_20240101_abc.txt").write_text("hola")
    assert [(r.text, r.content_hash) for r in readers.read_corpus(spark, str(tmp_path / "c")).collect()] == [("hola", "abc")]
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><link href="https://x/1"/><updated>2024-05-01T10:00:00Z</updated><category term="c1"/><category term="c2"/></entry><entry><title>no link</title></entry></feed>'
    rss = "<rss><channel><item><link>https://x/2</link><pubDate>Wed, 1 May 2024 10:00:00 +0200</pubDate></item></channel></rss>"
    rows = spark.createDataFrame([("s", "f", atom), ("s", "f", rss), ("s", "f", "broken <"), ("s", "f", None)], "source string, feed_url string, xml string")
    found = {r.url: r for r in readers.feed_entries(rows).collect()}
    assert set(found) == {"https://x/1", "https://x/2"} and found["https://x/1"].categories == ["c1", "c2"] and found["https://x/2"].title == "Sin título"
    assert (found["https://x/1"].published_date.hour, found["https://x/2"].published_date.hour) in {(10, 8)}
    assert one(spark, readers.decoded(F.lit(b"\xf1a"))) == "ña"


def test_pdf():
    assert readers.pdf_of(b"no pdf") is None and readers.pdf_of(None) is None and readers.pdf_of(b"%PDF-1.4")["text"] == ""
    assert readers.pdf_of(b"%PDF-1.4\nstream\nBT [(Ho) -20 (la)] TJ (a \\(b\\)\\101) Tj <4869> Tj ET\nendstream")["text"] == "Hola\na (b)A\nHi"
    place = lambda x, y, s: b"1 0 0 1 %d %d Tm (%s) Tj " % (x, y, s)
    cells = place(72, 700, b"head") + b"".join(place(x, y, b"%d" % (x + y)) for y in (600, 580) for x in (72, 200)) + place(72, 500, b"one") + place(200, 500, b"row") + place(90, 400, b"x") + place(220, 400, b"y")
    page = zlib.compress(b"BT " + cells + b"ET")
    found = readers.pdf_of(b"%PDF-1.4\n<< /Title (A \\(b\\)) /Type /Pages >> << /Type /Page >>\nstream\n" + page + b"\nendstream")
    assert (found["tables_found"], found["total_pages"], found["title"], found["author"]) == (1, 1, "A (b)", "")
    assert found["text"].endswith("\n\n\n[TABLA]\n672\t800\n652\t780\none\trow\n[/TABLA]\n") and found["text"].startswith("head\n672\n800\n")


def test_channel_videos(spark):
    page = lambda ids, following: json.dumps({"nextPageToken": following, "items": [{"snippet": {"title": f"t{i}", "resourceId": {"videoId": i}}} for i in ids]})
    rows = [
        ("a", None, page("abc", "p1")), ("a", "p1", page("de", "p2")), ("a", "p1", page("de", "p2")), ("a", "p2", page("fgh", "p3")), ("a", "p3", page("i", None)),
        ("circle", None, page("x", "p1")), ("circle", "p1", page("y", "p1")), ("open", None, page("z", "lost")), ("headless", "p1", page("q", None)), ("empty", None, "{}"), ("broken", None, "no json"), ("null", None, None),
    ]
    found = readers.channel_videos(spark.createDataFrame(rows, "channel_id string, token string, json string"), 7, lambda df: df).collect()
    got = {c: "".join(r.video_id for r in sorted(found, key=lambda r: r["rank"]) if r.channel_id == c) for c, _, _ in rows}
    assert got == {"a": "abcdefg", "circle": "xy", "open": "z", "headless": "", "empty": "", "broken": "", "null": ""}
    assert [r["rank"] for r in sorted(found, key=lambda r: r["rank"]) if r.channel_id == "a"] == list(range(1, 8))


def test_language(spark):
    texts = ["La casa de los abuelos es grande, pero el jardín no", "the cat sat on the mat and it was", "Der Hund und die Katze sind nicht da", "le chat est dans la maison avec des amis", "", "123", None, "não é para uma pessoa em casa"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", text.language(F.col("t")).alias("l")).orderBy("i").collect()
    assert [r.l for r in got] == ["es", "en", "de", "fr", None, None, None, "pt"]


def test_frontier_lifecycle(spark):
    now = F.lit("2024-01-01").cast("timestamp")
    seeds = spark.createDataFrame([("https://a.gob.mx/1", "s"), ("https://a.gob.mx/1", "s"), ("https://b.org/2", "s"), ("https://c.org/3", "s")], "url string, source string")
    f = frontier.new_rows(seeds, now)
    whole = frontier.insert_if_absent(f.limit(0), f)
    assert whole.count() == 3 and frontier.insert_if_absent(whole, f).count() == 3
    best = frontier.dequeue(whole, 1)
    assert best.first().url == "https://a.gob.mx/1"
    taken = frontier.mark(whole, best, "processing", now)
    assert {r.status: r.n for r in taken.groupBy("status").agg(F.count("*").alias("n")).collect()} == {"processing": 1, "pending": 2}
    assert frontier.released(taken, now + F.expr("INTERVAL 2 HOURS")).filter("status = 'processing'").count() == 0


def test_harvest(spark, tmp_path):
    body = "<p>" + "El gobierno de México publica una noticia sobre la cultura. " * 3
    page = lambda extra: f"<html><body><article>{body}{extra}</article></body></html>"
    pages = spark.createDataFrame(
        [("https://a.gob.mx/1", page('<a href="/noticia/2">Noticia de México</a>')), ("https://a.gob.mx/noticia/2", page("otra")), ("https://b.org/copy", page('<a href="/noticia/2">Noticia de México</a>')), ("https://b.org/empty", "<p>")], "url string, html string",
    )
    h = Harvest(spark, str(tmp_path / "h"))
    with pytest.raises(HarvestError):
        h.discover()
    first = pages.filter("url <> 'https://a.gob.mx/noticia/2'").select("url", F.lit("s").alias("source"))
    h.populate(h.discover(items=first, domains=spark.createDataFrame([(1, "www.unam.mx"), (2, "example.org")], "rank int, domain string")), "2024-01-01 00:00:00")
    report = h.session(pages, "2024-01-02 00:00:00", rounds=4).first()
    state = {r.url: (r.status, r.error_message) for r in h.frontier().collect()}
    assert state["https://a.gob.mx/noticia/2"][0] == "completed" and state["https://b.org/empty"] == ("failed", "No content extracted")
    assert sorted([state["https://a.gob.mx/1"], state["https://b.org/copy"]], key=str)[1] == ("failed", "duplicate") and state["https://www.unam.mx"] == ("failed", "not landed")
    assert report.completed == 2 and h.status()["overall"][0]["total"] == len(state)
    pages.write.parquet(str(tmp_path / "pages"))
    assert main([str(tmp_path / "cli"), "--pages", str(tmp_path / "pages"), "--rounds", "1"], lambda: spark) == 0
    assert main([str(tmp_path / "cli"), "--pages", str(tmp_path / "pages"), "--sources", str(tmp_path / "none")], lambda: spark) == 1


def test_sql_functions(spark):
    register(spark)
    row = spark.sql("SELECT est_tokens('0123456789') t, url_priority('https://example.org/x') p, is_mexican_domain('www.gob.mx') m, html_text('<body><p>a</body>') h, word_count(' a  b ') w").first()
    assert tuple(row) == (2, 1.0, True, "a", 2)


def test_ranks_over_strides(spark):
    from tejido.operators import ranking

    rows = spark.createDataFrame([(k, "hot" if k % 3 else None, k * 7 % 100) for k in range(300)], "i bigint, key string, v bigint")
    found = {r.i: (r.total, r.rank) for r in ranking.rank(ranking.running(rows, "key", "i", F.col("v"), "total", stride=16), "key", "i", "rank", stride=16).collect()}
    so_far = {}
    for k in range(300):
        key = bool(k % 3)
        n, total = so_far.get(key, (0, 0))
        so_far[key] = n, total = n + 1, total + k * 7 % 100
        assert found[k] == (total, n)
