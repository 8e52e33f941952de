"""The engine's expressions as SQL functions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf, udtf

from . import html, scoring, text
from . import lexicons as L


def _list(terms: list[str]) -> str:
    return "array(" + ", ".join("'" + t.replace("'", "\\'") + "'" for t in terms) + ")"


def _hits(text: str, terms: list[str]) -> str:
    return f"size(filter({_list(terms)}, k -> contains({text}, k)))"


def functions() -> dict[str, tuple[str, str, str]]:
    """name: parameters, type, body. All are SQL expressions, which Catalyst inlines and optimises."""
    geo = f"10 * {_hits('lower(t)', L.INSTITUTIONS)} + 5 * ({_hits('lower(t)', L.STATES)} + {_hits('lower(t)', L.CITIES)}) + 3 * {_hits('lower(t)', L.VOCABULARY)}"
    any_ = lambda terms: f"exists({_list(terms)}, k -> contains(lower(u), k))"
    return {
        "est_tokens": ("t STRING", "BIGINT", "coalesce(length(t) div 4, 0)"),
        "content_key": ("t STRING", "STRING", "substring(sha2(cast(t as binary), 256), 1, 16)"),
        "url_key": ("u STRING", "STRING", "sha2(cast(u as binary), 256)"),
        "word_count": ("t STRING", "BIGINT", r"cast(size(filter(split(t, '(?U)\\s+'), w -> w <> '')) as bigint)"),
        "geo_terms_score": ("t STRING", "BIGINT", f"cast({geo} as bigint)"),
        "url_priority": ("u STRING", "DOUBLE", f"least(10.0D, 1.0D + if({any_(L.PRIORITY_OFFICIAL)}, 2.0D, 0D) + if({any_(L.PRIORITY_NEWS)}, 1.0D, 0D) + if(endswith(lower(u), '.pdf'), 1.5D, 0D) + if({any_(L.PRIORITY_SOCIAL)}, 0.5D, 0D) + if({any_(L.PRIORITY_PLACES)}, 0.8D, 0D))"),
        "is_mexican_domain": ("d STRING", "BOOLEAN", f"exists({_list(L.DOMAIN_TLDS)}, k -> endswith(lower(d), k)) OR exists({_list(L.DOMAIN_KEYWORDS)}, k -> contains(lower(d), k))"),
    }


def register(spark: SparkSession) -> list[str]:
    """Temporary SQL functions of this session; their names. html_text, nfc and token_numbers are Arrow-batched Python, the others SQL; html_links is a table
    function: FROM pages, LATERAL html_links(html)."""
    for name, (parameters, kind, body) in functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    spark.udf.register("nfc", text.nfc)
    spark.udf.register("token_numbers", scoring.token_numbers)
    spark.udf.register("html_text", pandas_udf(_texts, "string"))
    spark.udtf.register("html_links", udtf(HtmlLinks, returnType="pos int, href string, anchor string"))
    return [*functions(), "nfc", "token_numbers", "html_text", "html_links"]


class HtmlLinks:
    """The links of a page in order; a null page has none."""

    def eval(self, page: str) -> Iterator[tuple[int, str, str]]:
        for link in html.links_of(page):
            yield link["pos"], link["href"], link["anchor"]


def _texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in batches:
        yield pd.Series([html.main_text_of(x) for x in s], dtype=object)
