"""Document scores: geography, dialect, formality, culture, complexity, richness, and what is derived of them."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from . import lexicons as L
from .text import any_in, counter_of, let, lexicon_counts, matches, n_words, sentences
from .urls import url_score


def _full(text: Column, title: Column | None) -> Column:
    return F.lower(F.concat(F.coalesce(title, F.lit("")) if title is not None else F.lit(""), F.lit(" "), F.coalesce(text, F.lit(""))))


def geography(text: Column, title: Column | None = None) -> Column:
    """Struct of institutional, regional, linguistic, other, score and confidence. Patterns are matched in the text alone."""
    raw = F.coalesce(text, F.lit(""))
    other = sum((matches(raw, f"(?U){p}") for p in (L.PHONE, L.AREA_PHONE, L.POSTAL, L.PESOS, L.MEXICAN_PESOS)), F.lit(0))
    other = F.when(F.regexp_like(raw, F.lit(r"(?U)\d")), other).otherwise(F.lit(0))  # all have a digit
    hits = lexicon_counts(_full(text, title), {"institutional": L.INSTITUTIONS, "states": L.STATES, "cities": L.CITIES, "linguistic": L.VOCABULARY})
    found = F.struct(hits["institutional"].alias("institutional"), (hits["states"] + hits["cities"]).alias("regional"), hits["linguistic"].alias("linguistic"), other.cast("long").alias("other"))
    scored = let(found, lambda g: F.struct(g["institutional"].alias("institutional"), g["regional"].alias("regional"), g["linguistic"].alias("linguistic"), g["other"].alias("other"), (10 * g["institutional"] + 5 * g["regional"] + 3 * g["linguistic"] + 2 * g["other"]).alias("score")))
    return let(scored, lambda g: F.struct(*[g[n].alias(n) for n in ("institutional", "regional", "linguistic", "other", "score")], geo_confidence(g["institutional"], g["score"]).alias("confidence")))


def geo_confidence(institutional: Column, score: Column) -> Column:
    return F.when((institutional >= 2) | (score >= 30), "high").when((institutional >= 1) | (score >= 15), "medium").when(score >= 5, "low").otherwise("very_low")


def is_mexican(geo: Column, url: Column, least: float = 10.0) -> Column:
    return geo["score"] + url_score(url) >= least


def geo_reasons(geo: Column) -> Column:
    told = lambda n, what: F.when(geo[n] > 0, F.concat(geo[n].cast("string"), F.lit(f" {what} {'indicators' if n == 'regional' else 'markers'}")))
    return F.array_compact(F.array(told("institutional", "institutional"), told("regional", "regional"), told("linguistic", "linguistic")))


def region(text: Column) -> Column:
    """Struct of region, hits and confidence: the region with the most markers, the first of several, `unknown` without one."""
    hits = lexicon_counts(F.lower(F.coalesce(text, F.lit(""))), {f"r{k}": terms for k, terms in enumerate(L.REGIONS.values())})
    each = F.array(*[F.struct(hits[f"r{k}"].alias("n"), F.lit(-k).alias("k"), F.lit(name).alias("name")) for k, name in enumerate(L.REGIONS)])
    return let(F.array_max(each), lambda best: F.struct(
        F.when(best["n"] > 0, best["name"]).otherwise("unknown").alias("region"), best["n"].alias("hits"),
        F.when(best["n"] >= 3, "high").when(best["n"] >= 1, "medium").otherwise("low").alias("confidence"),
    ))


def _counts(hits: Column, n: Column, lists: dict[str, list[str]], body) -> Column:
    """body of the hits of each list and n, all evaluated once."""
    return let(F.struct(*[hits[name].alias(name) for name in lists], n.alias("n_")), lambda c: body(c, F.greatest(c["n_"], F.lit(1))))


#: The lists that dialect, formality and culture count.
DIALECT = {"lexical": L.DIALECT_WORDS, "phrases": L.DIALECT_PHRASES, "diminutives": L.DIMINUTIVES}
FORMALITY = {"very_high": L.FORMAL_VERY_HIGH, "high": L.FORMAL_HIGH, "medium": L.FORMAL_MEDIUM, "academic": L.ACADEMIC_WORDS}
CULTURE = {"history": L.HISTORY, "culture": L.CULTURE, "geography": L.GEOGRAPHY}


def dialect(lowered: Column, n: Column, hits: Column | None = None) -> Column:
    """Struct of hits, density and score of lower-cased text of n words; `hits` are counts that are there already."""

    def body(c: Column, n: Column) -> Column:
        density = (c["lexical"] + c["phrases"] + c["diminutives"]) / n * 1000
        variety = F.least(c["lexical"] + c["phrases"], F.lit(20)) / 20 * 100
        return F.struct(*[c[k].alias(k) for k in ("lexical", "phrases", "diminutives")], density.alias("density"), (variety * 0.6 + F.least(density, F.lit(10.0)) / 10 * 100 * 0.4).alias("score"))

    return _counts(lexicon_counts(lowered, DIALECT) if hits is None else hits, n, DIALECT, body)


def formality(lowered: Column, n: Column, hits: Column | None = None) -> Column:
    def body(c: Column, n: Column) -> Column:
        score = F.least((c["very_high"] * 4 + c["high"] * 3 + c["medium"] * 2 + c["academic"] * 2) / n * 1000, F.lit(100.0))
        level = F.when(score >= 30, "muy_alto").when(score >= 20, "alto").when(score >= 10, "medio").when(score >= 5, "bajo").otherwise("muy_bajo")
        return F.struct(*[c[k].alias(k) for k in ("very_high", "high", "medium", "academic")], score.alias("score"), level.alias("level"))

    return _counts(lexicon_counts(lowered, FORMALITY) if hits is None else hits, n, FORMALITY, body)


def culture(lowered: Column, n: Column, hits: Column | None = None) -> Column:
    def body(c: Column, n: Column) -> Column:
        total = c["history"] + c["culture"] + c["geography"]
        balance = F.when((c["history"] > 0) & (c["culture"] > 0), 20).when(total > 0, 10).otherwise(0)
        score = F.least(total / n * 1000, F.lit(5.0)) / 5 * 60 + F.least(total, F.lit(15)) / 15 * 20 + balance
        return F.struct(*[c[k].alias(k) for k in ("history", "culture", "geography")], score.alias("score"))

    return _counts(lexicon_counts(lowered, CULTURE) if hits is None else hits, n, CULTURE, body)


#: Tokens of a window of the moving type-token ratio.
WINDOW = 100
#: Of the tokens of a text: all, different ones and subordinators; then without subordinators: all, different ones, those that come once, and
#: the mean share of different ones over all windows of WINDOW tokens (or the whole).
NUMBERS = {"n": T.LongType(), "kinds": T.LongType(), "subs": T.LongType(), "rest": T.LongType(), "rest_kinds": T.LongType(), "once": T.LongType(), "mattr": T.DoubleType()}
_TOKEN = re.compile(r"[^\W_]+")  # letters and digits
#: Characters of texts whose tokens are held at once, about.
STRETCH = 1 << 20


def numbers_of(texts: Sequence[str | None]) -> np.ndarray:
    """NUMBERS of lower-cased texts, a row each, from one pass over all their tokens."""
    lists = [_TOKEN.findall(t or "") for t in texts]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    codes, kinds = pd.factorize(np.fromiter(chain.from_iterable(lists), object, int(sizes.sum())))
    subordinate = np.fromiter((k in _SUBORDINATORS for k in kinds), bool, len(kinds))[codes]
    doc = np.repeat(np.arange(len(lists)), sizes)
    per = lambda at: np.bincount(at, minlength=len(lists))
    different = lambda key: np.unique(key) // max(1, len(kinds))
    subs = per(doc[subordinate])
    sub_kinds = per(different((doc * len(kinds) + codes)[subordinate]))
    doc, codes, n = doc[~subordinate], codes[~subordinate], sizes - subs
    w = np.minimum(n, WINDOW)
    i = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    key = doc * max(1, len(kinds)) + codes
    order = np.argsort(key, kind="stable")
    again = np.concatenate([[False], key[order][1:] == key[order][:-1]]) if len(key) else np.empty(0, bool)
    before = np.full(len(doc), -1)
    before[order[again]] = i[order[np.flatnonzero(again) - 1]]
    # a token counts in the windows that hold it but not its occurrence before
    held = np.maximum(0, np.minimum(i, (n - w)[doc]) - np.maximum(np.maximum(before + 1, i - w[doc] + 1), 0) + 1)
    first = ~again
    alone = first & np.concatenate([first[1:], [True]]) if len(first) else first
    rest_kinds = per(doc[order[first]])
    mattr = np.bincount(doc, held, minlength=len(lists)) / np.maximum(1, (n - w + 1) * w)
    return np.column_stack([sizes, rest_kinds + sub_kinds, subs, n, rest_kinds, per(doc[order[alone]]), mattr])


_SUBORDINATORS = frozenset(L.SUBORDINATORS)


def _in_stretches(texts: pd.Series) -> Iterator[np.ndarray]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or "")
        if size >= STRETCH:
            yield numbers_of(held)
            held, size = [], 0
    yield numbers_of(held)


def _framed(texts: pd.Series, prefix: str = "") -> pd.DataFrame:
    found = np.concatenate(list(_in_stretches(texts)))
    return pd.DataFrame({prefix + name: found[:, k] if isinstance(kind, T.DoubleType) else found[:, k].astype(np.int64) for k, (name, kind) in enumerate(NUMBERS.items())})


def _opens(pattern: str) -> list[str]:
    """The words of which one begins whatever a pattern of COMPLEX_PATTERNS matches."""
    return re.match(r"\\b\(\?:(.*?)\)", pattern)[1].split("|")


OPENS = {f"opens{k}": _opens(p) for k, p in enumerate(L.COMPLEX_PATTERNS)}


def _reader(lists: dict[str, list[str]], prefix: str):
    """An Arrow step that counts the terms of all lists and the NUMBERS of lower-cased texts; in columns each term would read
    each text, and windows would sort a list for each of its elements."""

    @pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in lists] + [T.StructField(prefix + name, kind) for name, kind in NUMBERS.items()]))
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counts = counter_of(lists) if lists else None
        for texts in batches:
            numbers = _framed(texts, prefix)
            yield pd.concat([pd.DataFrame([counts(t) for t in texts], columns=list(lists), dtype=np.int64), numbers], axis=1) if counts else numbers

    return read


#: NUMBERS of lower-cased texts; with the terms that complexity() needs; with all that quality_axes() counts.
token_numbers, complexity_numbers, axis_numbers = _reader({}, ""), _reader(OPENS, "t_"), _reader(DIALECT | FORMALITY | CULTURE | OPENS, "t_")


def complexity(text: Column, numbers: Column | None = None) -> Column:
    """Struct of avg_sentence_length, ttr, patterns, subordinates and score; tokens stand for lemmas, sentences end at their marks."""
    m = complexity_numbers(F.lower(text)) if numbers is None else numbers
    patterns = sum((F.when((m[name] > 0) & F.regexp_like(text, F.lit(f"(?iU){p}")), 1).otherwise(0) for name, p in zip(OPENS, L.COMPLEX_PATTERNS, strict=True)), F.lit(0))
    m = _told(m, "t_")
    found = F.struct(m["n"].alias("n"), m["kinds"].alias("kinds"), m["subs"].alias("subs"), F.size(sentences(text)).alias("sents"), patterns.alias("patterns"))

    def body(m: Column) -> Column:
        ttr, per = m["kinds"] / F.greatest(m["n"], F.lit(1)), lambda v: v / F.greatest(m["sents"], F.lit(1))
        score = F.least(per(m["n"]) / 25, F.lit(1.0)) * 25 + ttr * 30 + F.least(per(m["patterns"]) * 100, F.lit(20.0)) + F.least(per(m["subs"]) * 50, F.lit(25.0))
        zero = lambda v: F.when((m["n"] > 0) & (m["sents"] > 0), v).otherwise(F.lit(0.0))
        return F.struct(zero(per(m["n"])).alias("avg_sentence_length"), zero(ttr).alias("ttr"), m["patterns"].cast("long").alias("patterns"), m["subs"].cast("long").alias("subordinates"), zero(F.least(score, F.lit(100.0))).alias("score"))

    return let(found, body)


def richness(text: Column, numbers: Column | None = None) -> Column:
    """Struct of ttr, mattr, hapax_ratio and score; 0 below ten tokens. No stop words are taken out but the subordinators."""

    def body(m: Column) -> Column:
        n, per = m["rest"], F.greatest(m["rest"], F.lit(1))
        ttr, moving, once = m["rest_kinds"] / per, m["mattr"], m["once"] / per
        score = F.least(ttr * 100, F.lit(50.0)) + F.least(moving * 80, F.lit(30.0)) + F.least(once * 100, F.lit(20.0))
        zero = lambda v: F.when(n >= 10, v).otherwise(F.lit(0.0))
        return F.struct(zero(ttr).alias("ttr"), zero(moving).alias("mattr"), zero(once).alias("hapax_ratio"), zero(score).alias("score"))

    return let(_told(token_numbers(F.lower(F.coalesce(text, F.lit("")))) if numbers is None else numbers, "" if numbers is None else "t_"), body)


def _told(numbers: Column, prefix: str) -> Column:
    return F.struct(*[numbers[prefix + name].alias(name) for name in NUMBERS])


def overall(dialect_: Column, formality_: Column, complexity_: Column, culture_: Column, richness_: Column) -> Column:
    return dialect_ * 0.15 + formality_ * 0.25 + complexity_ * 0.25 + culture_ * 0.15 + richness_ * 0.20


def overall_confidence(score: Column) -> Column:
    return F.when(score >= 70, "high").when(score >= 50, "medium").when(score >= 30, "low").otherwise("very_low")


def document_type(text: Column) -> Column:
    """Struct of document_type, formality_level and language_quality of a PDF document's text."""
    hits = lexicon_counts(F.lower(F.coalesce(text, F.lit(""))), {"academic": L.PDF_ACADEMIC, "official": L.PDF_GOVERNMENT, "links": L.PDF_CONNECTORS, "legal": L.PDF_LEGAL, "manual": L.PDF_MANUAL})
    academic, official, links = (hits[x] for x in ("academic", "official", "links"))
    kind = F.when(academic >= 3, "academic").when(official >= 2, "government").when(hits["legal"] > 0, "legal").when(hits["manual"] > 0, "manual").otherwise("unknown")
    level = F.when(kind.isin("academic", "manual"), "high").when(kind.isin("government", "legal"), "very_high").otherwise("medium")
    return F.struct(kind.alias("document_type"), level.alias("formality_level"), F.when(links >= 5, "very_high").when(links >= 3, "high").when(links >= 1, "medium").otherwise("basic").alias("language_quality"))


def topic(title: Column, description: Column) -> Column:
    """First topic with a keyword in title or description; null without one."""
    t = F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit(""))))
    return F.coalesce(*[F.when(any_in(t, terms), F.lit(name)) for name, terms in L.TOPICS.items()])


def quality_axes(text: Column, title: Column | None = None) -> dict[str, Column]:
    """The five scores' structs of a text with its title."""
    full = F.concat(title, F.lit(" "), text) if title is not None else text
    lowered, n = F.lower(full), n_words(full)
    m = axis_numbers(lowered)
    return {"dialect": dialect(lowered, n, m), "formality": formality(lowered, n, m), "complexity": complexity(full, m), "culture": culture(lowered, n, m), "richness": richness(full, m)}
