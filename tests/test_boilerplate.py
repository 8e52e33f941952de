"""Main text without boilerplate: menus, templates, short lines beside long ones, and odd pages."""

from tejido.operators import boilerplate

LONG = "Esta es una frase larga de la nota número {} que tiene más de diez palabras seguidas."
MENU = '<nav><ul><li><a href="/a">Inicio</a></li><li><a href="/b">Noticias del día en la ciudad y en el mundo entero, todas juntas</a></li></ul></nav>'
NOTICE = "<div>Todos los derechos de esta casa editorial están reservados, y nadie puede copiar las notas sin permiso.</div>"


def page(k, extra=""):
    return f'<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{MENU}<h2>Un título corto</h2><p>{LONG.format(k)}</p><p>Firma de autor</p>{extra}<div>x</div><!-- <p>{LONG}</p> -->{NOTICE}<script>var a = "<p>";</script></body></html>'


def found(spark, rows):
    return {r.page_id: (r.method, r.text) for r in boilerplate.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}


def test_templates_and_menus_go(spark):
    rows = [(k, f"https://a.mx/{k}", page(k)) for k in range(6)]
    texts = found(spark, rows)
    # titles and signatures come on every page of the host, as its notice does
    assert texts == {k: ("blocks", LONG.format(k)) for k in range(6)}


def test_short_lines_stay_beside_long_ones(spark):
    texts = found(spark, [(1, "https://a.mx/1", page(1)), (2, "https://b.mx/1", page(2, "<p>solo dos</p><p>tres palabras lejos</p>"))])
    notice = "Todos los derechos de esta casa editorial están reservados, y nadie puede copiar las notas sin permiso."
    assert texts[1] == ("blocks", "\n".join(["Un título corto", LONG.format(1), "Firma de autor", notice]))
    assert texts[2][1].split("\n") == ["Un título corto", LONG.format(2), "Firma de autor", notice]  # far from a long block, or too short


def test_links_and_entities(spark):
    body = f"<div>{LONG.format(1)} <a href='/x'>más</a> &amp; m&aacute;s&nbsp;&quot;así&quot;</div><div>{'palabra ' * 9}<a>{'enlace ' * 9}</a></div>"
    assert found(spark, [(1, "https://a.mx/1", body)])[1] == ("blocks", LONG.format(1) + ' más & m&aacute;s "así"')


def test_odd_pages(spark):
    rows = [(1, None, page(1)), (2, "https://a.mx/2", None), (3, "https://a.mx/3", ""), (4, "https://a.mx/4", "<body><p>Unas palabras sueltas aquí</p></body>"), (None, "https://a.mx/5", page(5)), (6, "https://a.mx/6", "<p>" + "palabra " * 200_000)]
    texts = found(spark, rows + [rows[0]])
    assert texts[1][0] == "blocks" and texts[2] == texts[3] == (None, None) and texts[4] == ("fallback", "Unas palabras sueltas aquí")
    assert texts[None][0] == "blocks" and texts[6] == ("blocks", ("palabra " * 200_000).strip())
    assert boilerplate.main_text(spark.createDataFrame(rows + [rows[0]], "page_id bigint, url string, html string")).count() == 7
    assert found(spark, rows[:0] + [(1, "u", None)]) == {1: (None, None)}


def test_differs_from_dropping_tags(spark):
    from tejido.functions import html

    df = spark.createDataFrame([(1, "https://a.mx/1", f"<body><div><a href='/x'>{'menú ' * 12}</a></div><p>{LONG.format(1)}</p></body>")], "page_id bigint, url string, html string")
    assert boilerplate.main_text(df).first().text == LONG.format(1) != df.select(html.main_text("html")).first()[0]
