"""Text expressions: tokens, counters, cleaning and validation ladders, all as columns over columns.

Java's \\w, \\s, \\d and \\b take in all of Unicode only under (?U), which the patterns here carry where that matters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from . import lexicons as L

#: Characters (of the first column) and rows of a part of an Arrow batch.
PART_CHARS, PART_ROWS = 1 << 18, 512


def in_parts(batches: Iterator) -> Iterator:
    """Arrow batches, of a column or a tuple of columns, in parts of bounded size. Spark bounds a batch (64 MB), not what a function makes of it, which
    may be many times as large; made and handed on part by part, that stays small whatever the input."""
    for batch in batches:
        several = isinstance(batch, tuple)
        columns = batch if several else (batch,)
        del batch
        ends = np.cumsum([0, *(len(x) if isinstance(x, (str, bytes)) else 1 for x in columns[0])])
        start, n = 0, len(columns[0])
        while start < n:
            end = min(max(start + 1, int(np.searchsorted(ends, ends[start] + PART_CHARS, "right")) - 1), start + PART_ROWS, n)
            part = tuple(c.iloc[start:end].copy() for c in columns)  # a view would hold the whole batch while the next one is read
            yield part if several else part[0]
            start = end
        columns = part = None


def in_lists(batches: Iterator[pa.Array]) -> Iterator[list]:
    """As in_parts, of a column of texts that stays in Arrow: only a part at a time is made into Python's strings."""
    for batch in batches:
        ends = np.cumsum(np.concatenate([[0], pc.fill_null(pc.binary_length(batch), 1).to_numpy(zero_copy_only=False).astype(np.int64)]))
        start, n = 0, len(batch)
        while start < n:
            end = min(max(start + 1, int(np.searchsorted(ends, ends[start] + PART_CHARS, "right")) - 1), start + PART_ROWS, n)
            yield batch.slice(start, end - start).to_pylist()
            start = end
        del batch  # before the next one is read


def words(text: Column) -> Column:
    """Tokens between white space of any kind, none of them empty."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    return matches(text, r"(?U)\S+")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is evaluated once; inside a lambda an expression would be evaluated for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lexicon_hits(lowered: Column, terms: list[str]) -> Column:
    """How many of the different terms are contained in lower-cased text."""
    return let(lowered, lambda t: F.size(F.filter(F.array(*map(F.lit, terms)), lambda k: F.contains(t, k))).cast("long"))


def finder(terms: list[str]) -> Callable[[str], set[int]]:
    """Finds the numbers of the terms that a text contains: by an automaton that reads the text once, or a term at a time without that library."""
    try:
        import ahocorasick
    except ImportError:
        return lambda text: {k for k, term in enumerate(terms) if term in text}
    machine = ahocorasick.Automaton()
    for k, term in enumerate(terms):
        machine.add_word(term, k)
    machine.make_automaton()
    return lambda text: {k for _, k in machine.iter(text)}


def counter_of(lists: dict[str, list[str]]) -> Callable[[str | None], list[int]]:
    """Counts, for each list, the different terms of it that a text contains."""
    terms = sorted({t for terms in lists.values() for t in terms})
    places = {t: k for k, t in enumerate(terms)}
    of = [[] for _ in terms]
    for k, name in enumerate(lists):
        for t in set(lists[name]):
            of[places[t]].append(k)
    find, empty = finder(terms), [0] * len(lists)

    def count(text: str | None) -> list[int]:
        out = empty.copy()
        if text:
            for term in find(text):
                for k in of[term]:
                    out[k] += 1
        return out

    return count


def lexicon_counts(lowered: Column, lists: dict[str, list[str]]) -> Column:
    """Struct of how many different terms of each list lower-cased text contains. A batch of texts is read once for all lists together;
    in columns each term would read each text. Not for use inside a lambda."""

    @pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in lists]))
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counts = counter_of(lists)
        for texts in in_parts(batches):
            yield pd.DataFrame([counts(t) for t in texts], columns=list(lists))

    return count(lowered)


def any_in(text: Column, terms: list[str]) -> Column:
    return let(text, lambda t: F.exists(F.array(*map(F.lit, terms)), lambda k: F.contains(t, k)))


def matches(text: Column, pattern: str) -> Column:
    """Number of matches of a pattern; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def n_chars_of(text: Column, characters: str) -> Column:
    """How many characters of text are among `characters` (a character class's inside)."""
    return (F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]", ""))).cast("long")


def token_estimate(text: Column) -> Column:
    """Tokens as a quarter of the characters, rounded down: the definition where no vocabulary is at hand."""
    return F.coalesce(F.floor(F.length(text) / 4), F.lit(0)).cast("long")


def content_key(text: Column) -> Column:
    """First 16 hexadecimal digits of the text's SHA-256."""
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 16)


def url_key(url: Column) -> Column:
    """SHA-256 of the URL as it is written."""
    return F.sha2(url.cast("binary"), 256)


def is_upper(text: Column) -> Column:
    """At least one cased character, and none in lower case."""
    return (text == F.upper(text)) & (text != F.lower(text))


def is_digits(text: Column) -> Column:
    return text.rlike(r"^\p{Nd}+$")


def safe_name(name: Column) -> Column:
    """A file name: no characters that file systems refuse, white space as underscores, ASCII only, at most 50 characters, lower case."""
    kept = F.regexp_replace(name, r'[\\/*?:"<>|]', "")
    joined = F.regexp_replace(F.regexp_replace(kept, r"(?U)^\s+|\s+$", ""), r"(?U)\s+", "_")
    return F.lower(F.substring(F.regexp_replace(joined, r"[^\x00-\x7F]", ""), 1, 50))


def file_name(source: Column, day: Column, key: Column, suffix: Column | None = None) -> Column:
    """{source}_{yyyymmdd}_{key}[_{suffix}].txt"""
    parts = [source, F.date_format(day, "yyyyMMdd"), key] + ([suffix] if suffix is not None else [])
    return F.concat(F.concat_ws("_", *parts), F.lit(".txt"))


def path_domain(host: Column) -> Column:
    return F.translate(host, ":/", "__")


@pandas_udf(T.StringType())
def _composed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    import unicodedata

    for s in in_parts(batches):
        yield s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def nfc(text: Column) -> Column:
    """Canonical composition; there is no built-in for it. Characters below U+0300 never change by it nor compose with each other, so that texts of
    them alone are not sent to Python."""
    return F.coalesce(_composed(F.when(text.rlike(r"[^\x{0}-\x{2FF}]"), text)), text)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def without_controls(text: Column) -> Column:
    """No control characters but tab, line feed and carriage return."""
    return F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def repair(text: Column) -> Column:
    """UTF-8 that was read as Latin-1, for the fixed pairs."""
    for wrong, right in L.MOJIBAKE.items():
        text = F.replace(text, F.lit(wrong), F.lit(right))
    return text


def clean(text: Column, composed: bool = False) -> Column:
    """Composition (unless text is composed), no NUL and replacement characters, repaired pairs, no controls, at most one blank line,
    single spaces, line feeds, trimmed; in this order. Null gives ''."""
    out = text if composed else nfc(text)
    out = F.replace(F.replace(out, F.lit("\x00"), F.lit("")), F.lit("�"), F.lit(""))
    out = without_controls(repair(out))
    out = F.regexp_replace(out, r"(?U)\n\s*\n\s*\n+", "\n\n")
    out = F.regexp_replace(out, r"[ \t]+", " ")
    out = F.replace(out, F.lit("\r\n"), F.lit("\n"))
    return F.coalesce(strip(out), F.lit(""))


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for pattern, by in pairs:
        text = F.regexp_replace(text, pattern, by)
    return text


def clean_pdf(text: Column) -> Column:
    """Blank runs, spaces, lone page numbers and page lines, bullets, rules, words broken over lines."""
    return strip(_replaced(text, L.PDF_CLEANING))


def clean_lyrics(text: Column) -> Column:
    """No bracketed parts, times and mentions, single spaces, a space after sentence ends."""
    return F.coalesce(strip(_replaced(text, L.LYRICS_CLEANING)), F.lit(""))


def clean_segment(text: Column) -> Column:
    """A transcript's segment without bracketed parts, single spaces."""
    return F.regexp_replace(F.regexp_replace(strip(text), r"\[.*?\]", ""), r"(?U)\s+", " ")


def clean_gazette(text: Column) -> Column:
    """No page lines, titles and dates of the paper, one blank line at most."""
    lines = [(f"(?iU){p}", "\n") for p in L.GAZETTE_LINES]
    return strip(_replaced(text, [*lines, (f"(?U){L.GAZETTE_BLANKS}", "\n\n")]))


def clean_legislature(text: Column) -> Column:
    """A blank line before each heading."""
    return strip(_replaced(text, [(f"(?U){p}", f"\n\n{name} $1") for p, name in L.LAW_HEADINGS]))


def lyrics_paragraphs(pieces: Column) -> Column:
    """Paragraphs that end in a sentence's end, one blank line between them."""
    kept = F.filter(F.transform(pieces, strip), lambda p: p != "")
    ended = F.transform(kept, lambda p: F.when(F.substring(p, -1, 1).isin(".", "!", "?"), p).otherwise(F.concat(p, F.lit("."))))
    return strip(F.regexp_replace(F.array_join(ended, "\n\n"), r"\n{3,}", "\n\n"))


def post_text(title: Column, body: Column) -> Column:
    """Title and body, a blank line between them; '' below 20 characters."""
    full = strip(F.concat_ws("\n\n", F.when(title != "", title), F.when(body != "", body)))
    return F.when(F.length(full) < 20, F.lit("")).otherwise(full)


def sentences(text: Column) -> Column:
    """Stretches up to and with their end marks, trimmed, none empty."""
    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"[^.!?…]+[.!?…]*"), F.lit(0)), strip), lambda s: s != "")


def sentence_estimate(text: Column) -> Column:
    """The larger of the non-blank pieces between end marks and the paragraphs, 2 at least; 0 for an empty text."""
    pieces = F.size(F.filter(F.split(text, "[.!?]+"), lambda s: strip(s) != ""))
    paragraphs = F.floor((F.length(text) - F.length(F.replace(text, F.lit("\n\n"), F.lit("")))) / 2) + 1
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(0)).otherwise(F.greatest(pieces, paragraphs, F.lit(2))).cast("long")


# ---- validation -----------------------------------------------------------------------------------------------------


def looks_spanish(text: Column) -> Column:
    """Function words above a twentieth of the words, or any Spanish character."""
    lowered = F.lower(text)
    hits = sum((matches(lowered, f"(?U){p}") for p in L.FUNCTION_WORDS), F.lit(0))
    marked = n_chars_of(text, L.SPANISH_CHARS) > 0
    n = n_words(text)
    return F.when(n > 0, (hits / n > 0.05) | marked).otherwise(marked)


def quality(text: Column) -> Column:
    """Struct of text_quality, is_valid, is_binary, is_corrupted, spanish_score, issues: the ladder's first step that holds.

    Steps look at the first 1000 characters, but for the replacement characters. Null counts as empty.
    """
    both = F.struct(F.coalesce(text, F.lit("")).alias("whole"), F.substring(F.coalesce(text, F.lit("")), 1, 1000).alias("sample"))
    return let(let(both, lambda x: _facts(x["whole"], x["sample"])), _ladder)


def _facts(whole: Column, sample: Column) -> Column:
    """What the ladder's steps compare, each counted once."""
    pattern = F.coalesce(*[F.when(sample.rlike(p), F.lit(k)) for k, p in enumerate(L.BINARY_PATTERNS)])
    return F.struct(
        F.length(whole).alias("n_all"), F.length(sample).alias("n"), pattern.alias("pattern"), n_chars_of(sample, rf"{L.PROBLEM_CHARS}\x{{100}}-\x{{10FFFF}}").alias("odd"),
        (n_chars_of(sample, r"\p{C}\p{Z}") - n_chars_of(sample, r" \n\t\r")).alias("unprintable"), matches(whole, "�").alias("replaced"), n_chars_of(sample, r"\x00-\x08\x0B\x0C\x0E-\x1F").alias("controls"),
        n_chars_of(sample, L.SPANISH_CHARS).alias("spanish"), looks_spanish(sample).alias("looks"),
    )


def _ladder(m: Column) -> Column:
    n, pattern, replaced, controls = m["n"], m["pattern"], m["replaced"], m["controls"]
    spanish = m["spanish"] / F.greatest(n, F.lit(1))
    short, binary = m["n_all"] < 50, pattern.isNotNull()
    excess = (n > 50) & (m["odd"] / F.greatest(n, F.lit(1)) > 0.35)
    low = (n - m["unprintable"]) / F.greatest(n, F.lit(1)) < 0.85
    lost = replaced > 20
    early = short | binary | excess | low
    issue = lambda when, text: F.when(when, text)
    issues = F.array_compact(F.array(
        issue(short, F.concat(F.lit("too_short: "), m["n_all"].cast("string"), F.lit(" < 50"))),
        issue(~short & binary, F.concat(F.lit("binary_pattern_"), pattern.cast("string"), F.lit("_detected"))),
        issue(~short & ~binary & excess, F.lit("excessive_problematic_chars")),
        issue(~short & ~binary & ~excess & low, F.lit("low_printable_ratio")),
        issue(~early & (replaced > 5), F.concat(F.lit("replacement_chars: "), replaced.cast("string"))),
        issue(~early & ~lost & (controls > 5), F.concat(F.lit("control_chars: "), controls.cast("string"))),
    ))
    level = (
        F.when(short, "too_short").when(binary | excess, "binary").when(low | lost, "corrupted").when(spanish >= 0.1, "good")
        .when(m["looks"], "acceptable").when((replaced > 5) | (controls > 5), "poor").otherwise("acceptable")
    )
    return F.struct(
        level.alias("text_quality"), level.isin("good", "acceptable").alias("is_valid"), (~short & (binary | excess)).alias("is_binary"),
        (~short & ~binary & ~excess & low).alias("is_corrupted"), F.when(early, F.lit(0.0)).otherwise(spanish).alias("spanish_score"), issues.alias("issues"),
    )


def recommended(found: Column) -> Column:
    """What to do with a text of that quality: delete, review, clean or keep."""
    return (
        F.when(found["is_binary"] | found["is_corrupted"], "delete").when(found["text_quality"] == "poor", "review")
        .when(F.size(found["issues"]) > 0, "clean").otherwise("keep")
    )


def is_spam(text: Column) -> Column:
    """Over two of eight patterns, or a character five times in a row, or over 20 characters all in upper case."""
    lowered = F.lower(text)
    hits = sum((lowered.rlike(p).cast("int") for p in L.SPAM_PATTERNS), F.lit(0))
    return (hits > 2) | text.rlike(r"(.)\1{4,}") | ((F.length(text) > 20) & is_upper(text))


def likely_spanish(text: Column) -> Column:
    """Comments: short, or with a Spanish letter, or a function word as a token."""
    lowered = F.lower(text)
    return (F.length(text) < 20) | any_in(lowered, L.SPANISH_LETTERS) | F.arrays_overlap(words(lowered), F.array(*map(F.lit, L.COMMENT_WORDS)))


def _word_hits(lowered: Column, list_: list[str]) -> Column:
    return F.size(F.filter(words(lowered), lambda w: w.isin(*list_)))


#: Frequent function words of some languages, by which language() tells them; the first of languages with equal counts is taken.
FUNCTION_WORDS = {
    "es": ["de", "la", "que", "el", "los", "las", "por", "con", "para", "una", "su", "del", "al", "como", "más", "pero", "es", "se", "un", "y"],
    "en": ["the", "of", "and", "to", "is", "in", "that", "it", "was", "for", "on", "are", "with", "as", "be", "this", "by", "not", "an", "or"],
    "fr": ["le", "les", "des", "et", "du", "une", "est", "dans", "qui", "pour", "pas", "sur", "au", "avec", "ce", "ne", "la", "de", "par", "un"],
    "de": ["der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist", "im", "nicht", "ein", "eine", "dem", "es", "auch"],
    "pt": ["de", "que", "do", "da", "em", "um", "para", "com", "não", "uma", "os", "no", "se", "na", "por", "mais", "as", "dos", "ao", "foi"],
    "it": ["di", "che", "il", "per", "non", "una", "della", "con", "sono", "del", "gli", "dei", "alla", "più", "ha", "è", "le", "un", "nel", "si"],
}


def language(text: Column) -> Column:
    """The language of which text holds the most different function words; null if it holds none. A plain scorer of the engine's own."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0)))

    def best(words_: Column) -> Column:
        counts = {lang: F.size(F.array_intersect(words_, F.array(*map(F.lit, terms)))) for lang, terms in FUNCTION_WORDS.items()}
        most = F.greatest(*counts.values())
        out = F.when(most <= 0, F.lit(None).cast("string"))
        for lang, n in counts.items():
            out = out.when(n == most, lang)
        return out

    return let(found, best)


def spanish_post(text: Column) -> Column:
    lowered = F.lower(text)
    return any_in(lowered, L.SPANISH_LETTERS) | (_word_hits(lowered, L.POST_WORDS) >= 2)


def spanish_transcript(text: Column) -> Column:
    """A Spanish letter, or a twentieth of the tokens among the words; no tokens pass."""
    lowered = F.lower(text)
    return any_in(lowered, L.SPANISH_LETTERS) | (_word_hits(lowered, L.TRANSCRIPT_WORDS) >= F.size(words(lowered)) * 0.05)


def comment_admissible(text: Column) -> Column:
    return F.length(text).between(10, 2000) & ~is_spam(text) & likely_spanish(text)
