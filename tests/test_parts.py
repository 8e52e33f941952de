"""What Arrow-batched functions make of a batch is handed on in parts of bounded size."""

import unicodedata
import weakref

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from tejido.functions import html, text
from tejido.sources import readers


def test_parts_are_bounded_and_whole():
    texts = [None, "a" * 1_000_000, *["b" * 1000] * 3000, "", "c"]
    found = list(text.in_parts(iter([pd.Series(texts, dtype=object), pd.Series([], dtype=object), pd.Series(range(1200))])))
    assert pd.concat(found[:-3]).tolist() == texts and [len(p) for p in found[-3:]] == [512, 512, 176]
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= text.PART_CHARS and len(p) <= text.PART_ROWS for p in found[:-3])
    pairs = list(text.in_parts(iter([(pd.Series(texts, dtype=object), pd.Series(range(len(texts))))])))
    assert [k for _, b in pairs for k in b] == list(range(len(texts))) and len(pairs) == len(found) - 3


def test_entries_of_a_batch_come_in_parts():
    feed = "<rss><channel>" + "<item><title>t</title><link>https://a.mx/1</link></item>" * 50 + "</channel></rss>"
    out = list(readers._items(iter([pd.Series([feed] * 1000)])))
    assert sum(map(len, out)) == 1000 and max(map(len, out)) < 100 and all(len(items) == 50 for s in out for items in s)


def test_rows_stay_beside_their_results(spark):
    rows = spark.range(3000).select("id", F.concat(F.lit("<body>é"), F.col("id").cast("string"), F.lit("</body>")).alias("html")).coalesce(1)
    found = rows.select("id", html.main_text("html").alias("m"), text.nfc(F.col("html")).alias("n"), text.lexicon_counts(F.col("html"), {"x": ["1", "2"]})["x"].alias("x")).collect()
    assert len(found) == 3000 and all(r.m == f"é{r.id}" and r.n == f"<body>é{r.id}</body>" and r.x == ("1" in str(r.id)) + ("2" in str(r.id)) for r in found)


def test_a_batch_is_let_go_before_the_next_is_read():
    held, kept = [], []

    class Text(str):
        pass

    def batches():
        for _ in range(3):
            kept.append(sum(r() is not None for r in held))
            texts = [Text(f"{k} " * 100) for k in range(2000)]
            held[:] = map(weakref.ref, texts)
            yield (pd.Series(texts, dtype=object), pd.Series(range(2000)))
            del texts

    for a, _ in text.in_parts(batches()):
        assert len(a) <= text.PART_ROWS
    assert max(kept) <= text.PART_ROWS


def test_only_texts_that_composition_may_change_go_to_python(spark, monkeypatch):
    texts = ["plain", "ma\u00f1ana \u02ff", "man\u0303ana", "\u212b \u1e9b\u0323", "\u1100\u1161\u11a8", "\u201cquoted\u201d", "\U0001f600 \u00e9", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    made = lambda: {r.id: r.n for r in rows.select("id", text.nfc(F.col("t")).alias("n")).collect()}
    found = made()
    assert found == {k: t and unicodedata.normalize("NFC", t) for k, t in enumerate(texts)} and found[2] == texts[1][:6] and found[4] == "\uac01"
    monkeypatch.setattr(text, "_composed", lambda t: F.concat(F.lit("sent "), t))
    assert [k for k, t in made().items() if t and t.startswith("sent ")] == [2, 3, 4, 5, 6]


def test_pages_stay_in_arrow_but_for_a_part(monkeypatch):
    texts = [None, "a" * 1_000_000, *["b" * 1000] * 3000, "", "\u00e9"]
    found = list(text.in_lists(iter([pa.array(texts), pa.array([], pa.string()), pa.array(["c"] * 1200)])))
    assert [t for part in found for t in part] == [*texts, *["c"] * 1200] and [len(p) for p in found[-3:]] == [512, 512, 176]
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= text.PART_CHARS and len(p) <= text.PART_ROWS for p in found)
    monkeypatch.setattr(html, "arrow_udf", lambda run, kind: lambda column: run)
    pages = pa.array([None, "", '<a href="/1">&eacute;<b>x</b></a><a>no</a><a href="">y</a>', *["<p>none</p>"] * 1000])
    made = list(html._each(html.LINK, html.links_of)("html")(iter([pages.slice(1), pages])))
    rows = [links for part in made for links in part.to_pylist()]
    assert max(map(len, made)) <= text.PART_ROWS and rows == [html.links_of(p) for p in [*pages.to_pylist()[1:], *pages.to_pylist()]]
    assert rows[1] == [{"pos": 0, "href": "/1", "anchor": "\u00e9x"}, {"pos": 1, "href": "", "anchor": "y"}]
