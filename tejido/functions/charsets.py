"""Which charset bytes are in: byte order marks, valid UTF-8, zero bytes of UTF-16, and for one-byte charsets what stands beside what."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

from .text import in_parts

# Byte order marks, the longest first, and the one-byte charsets that are told apart.
MARKS = {b"\xff\xfe\x00\x00": "utf-32-le", b"\x00\x00\xfe\xff": "utf-32-be", b"\xef\xbb\xbf": "utf-8-sig", b"\xff\xfe": "utf-16-le", b"\xfe\xff": "utf-16-be"}
ONE_BYTE = ["cp1252", "latin-1", "mac_roman", "cp850"]
COMMON = "áéíóúñüàèçãõâêôöäßÁÉÍÓÚÑÜÀÈÇÃÕÂÊÔÖÄ¿¡"  # the most frequent letters beyond ASCII of Spanish, Portuguese, French and German
#: Share of zero bytes at even or odd places by which text is taken for UTF-16.
ZEROS = 0.25

_KINDS: dict[str, np.ndarray] = {}


def kinds(charset: str) -> np.ndarray:
    """What each byte is in a charset: 0 a space, digit or mark, 1 a small letter, 2 a large one, 3 a control character, a drawn line, or none."""
    if charset not in _KINDS:
        out = np.full(256, 3, np.int8)
        for b in range(256):
            c = bytes([b]).decode(charset, "ignore")
            if c:
                out[b] = 1 if c.islower() else 2 if c.isupper() else 3 if c.isalpha() or "\u2500" <= c <= "\u259f" or not (c.isprintable() or c in "\t\n\r\f") else 0
        _KINDS[charset] = out
    return _KINDS[charset]


def pair_score(data: np.ndarray, charset: str) -> float:
    """How well bytes beyond ASCII fit their neighbours in a charset: 1 for each small letter beside a letter, 0.8 for one that stands alone and for large ones that no small one precedes, half
    for marks beside a space or mark; less for large letters within words, marks within words, and characters that no text has; more for COMMON letters. The
    mean over those bytes."""
    kind = kinds(charset)[data]
    at = np.flatnonzero(data >= 128)
    if not len(at):
        return 0.0
    before = np.where(at > 0, kind[np.maximum(at - 1, 0)], 0)
    after = np.where(at + 1 < len(data), kind[np.minimum(at + 1, len(data) - 1)], 0)
    own, letter = kind[at], lambda k: (k == 1) | (k == 2)
    score = np.select(
        [own == 3, (own == 1) & (letter(before) | letter(after)), own == 1, (own == 2) & (before != 1), own == 2, letter(before) & letter(after)],
        [-2.0, 1.0, 0.8, 0.8, -1.0, -1.0], 0.5,
    )
    common = np.array([bytes([b]).decode(charset, "replace") in COMMON for b in range(256)])
    return float((score + 0.6 * common[data[at]]).mean())


def detect(content: bytes | None) -> tuple[str | None, float]:
    """The charset of bytes, in Python's names, and how sure that is (0 to 1); None for null. Empty bytes are UTF-8."""
    if content is None:
        return None, 0.0
    for mark, name in MARKS.items():
        if content.startswith(mark):
            return name, 1.0
    if not content:
        return "utf-8", 1.0
    data = np.frombuffer(content, np.uint8)
    if len(data) % 2 == 0:
        even, odd = (data[::2] == 0).mean(), (data[1::2] == 0).mean()
        if max(even, odd) >= ZEROS and min(even, odd) < ZEROS / 5:
            return "utf-16-be" if even > odd else "utf-16-le", float(max(even, odd))
    try:
        content.decode("utf-8")
        return "utf-8", 1.0 if (data < 128).all() else 1.0 - 0.5 ** int((data >= 192).sum())
    except UnicodeDecodeError:
        pass
    scores = {name: pair_score(data, name) for name in ONE_BYTE}
    if not ((data >= 128) & (data < 160)).any():
        scores["cp1252"] = scores["latin-1"] - 1  # the two say the same then
    best = max(scores, key=scores.get)  # of equals the first
    return best, max(0.0, min(0.99, (scores[best] + 2) / 3.6))


def decode(content: bytes | None) -> tuple[str | None, str | None, float, int]:
    """Text, charset, sureness, and the number of characters that stand for bytes that can't be read."""
    name, sure = detect(content)
    if name is None:
        return None, None, 0.0, 0
    for mark in MARKS:
        if content.startswith(mark):
            content = content[len(mark) :]
            break
    text = content.decode("utf-8" if name == "utf-8-sig" else name, "replace")
    return text, name, sure, text.count("�")


SCHEMA = "text string, charset string, confidence double, errors bigint"


def decoded(content: Column) -> Column:
    """A struct of text, charset, confidence and errors of bytes."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in in_parts(batches):
            yield pd.DataFrame([decode(bytes(x) if x is not None else None) for x in s], columns=["text", "charset", "confidence", "errors"])

    return pandas_udf(run, SCHEMA)(content)
