"""Queries against their SQL on rows that the driver's smallest tables don't have."""

import duckdb
import pytest

from tejido import queries as engine


@pytest.fixture
def same(spark, tmp_path):
    def check(name, table, rows, schema):
        """The query's rows, which must be those of its SQL on this table."""
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
        db = duckdb.connect()
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
        df = engine.queries()[name](spark, str(tmp_path))
        columns = sorted(df.columns)
        got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
        assert got == sorted(db.execute(f"SELECT {', '.join(columns)} FROM ({engine.oracle_sql()[name]})").fetchall(), key=repr)
        return got

    return check


PAGES, DOCUMENTS = "page_id bigint, url string, html string", "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_snapshots_of_a_url_that_comes_again(same):
    rows = [(1, "https://a.mx/1", "<p>a</p>"), (2, "https://a.mx/1", "<p>longer</p>"), (3, None, "x"), (None, "https://a.mx/2", None), (4, "https://a.mx/2", "y"), (4, "https://a.mx/2", "y")]
    assert len(same("j09_content_snapshot", "pages", rows, PAGES)) == 6


ARTICLE = "<!DOCTYPE html><html><head><title>t</title></head><body><article>{}</article></body></html>"


@pytest.mark.parametrize("name", ["x02_main_text", "x01_main_text_gated", "x01_main_text_dense", "x13_basic_extract"])
def test_references_without_an_end(same, name):
    """A title may be cut within a reference; what has no semicolon is text."""
    cut = "<h1>un título cortado&amp;&amp;&amp{}</h1><p>b&lt;c &quot;d&quot;</p>"
    rows = [(k, f"https://a{k}.mx/{k}", ARTICLE.format(cut.format(end))) for k, end in enumerate(["", " ", ";", "x", "x;", "<b>y</b>", "&", "&am"])]
    rows.append((100, "https://b.mx/1", ARTICLE.format("<p> espacio duro a los lados </p>")))
    assert len(same(name, "pages", rows, PAGES)) == len(rows)


def test_references_elsewhere():
    from tejido.functions import html

    assert html.parse("<script>a && b &amp; c</script><a href='?a=1&copy=2&amp;d=3'>&#65;&#x42;&nbsp;&eacute;&ntilde &zz;</a>").text() == "a && b &amp; cAB\u00a0é&ntilde &zz;"
    assert html.links_of("<a href='?a=1&copy=2&amp;d=3'>x</a>")[0]["href"] == "?a=1&copy=2&d=3"


def test_songs_that_are_long_enough_as_they_are(same):
    texts = ["ab.cd " * 3 + "x", "ab.cd ab.cd ab.cde", "[" + "x" * 30 + "]", "", None, "\x0b" * 25, " \n" + "y" * 20 + "\t\n", " " * 20, "z" * 19 + "  ", "z" * 19 + " \u0085"]
    assert len(same("k10_lyrics_sink", "documents", [(k + 1, t, "es", f"s{k}", 0) for k, t in enumerate(texts)], DOCUMENTS)) == 6


def test_rejects_are_the_short_ones(same):
    odd = ["\U0001f600" * 60, "ª¬®" * 30, None, "", " a b\tc\n", "abcd \x0b", "a" * 30, "ß" * 80]
    assert {r[0] for r in same("k13_rejects", "documents", [(k, t, "es", "s", 0) for k, t in enumerate(odd)], DOCUMENTS)} == {3, 4}


def test_letters_that_stand_alone(same):
    texts = ["rele paraitreellele ê leque la vequance +1 (557) 5", "La é le de de.", "Des la de ennsds é.", "à", "È vero che l'uva è ô"]
    same("v03_charsets", "documents", [(6 * k + 5, t, "fr", "s", 0) for k, t in enumerate(texts)], DOCUMENTS)


def test_edges_of_texts_before_a_heading(same):
    ends = ["", " ", "\n", "\n\n\n", " \n ", "\t\n", "\r\n", "\n\u3000", "\u00a0", "\x0b", "\u0085", "|", "|\n", "|\n\nArtículo 5. Ley\n\nCapítulo IV"]
    texts = [None, *[a + b + c for a in ends[:-1] for b in ["", "x|y\nz"] for c in ends]]
    same("v12_legislature_clean", "documents", [(k, t, "es", "s", 0) for k, t in enumerate(texts)], DOCUMENTS)


def test_headings_of_the_text_itself(spark, tmp_path):
    """Beyond the SQL, which knows only the headings that the query adds."""
    spark.createDataFrame([(1, "a\n Artículo 1. b\nTítulo IV", "es", "s", 0)], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    got = engine.queries()["v12_legislature_clean"](spark, str(tmp_path)).first().cleaned
    assert got == "a\n\nArtículo 1. b\n\nTítulo IV\n\nArtículo 5. Ley\n\nCapítulo IV"
