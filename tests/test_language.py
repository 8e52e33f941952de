"""N-grams of many texts as one array, against a plain count of each."""

from collections import Counter

from tejido.operators import language


def plain(text):
    out = Counter()
    for w in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
        for n in (1, 2, 3):
            out.update(f" {w} "[i : i + n] for i in range(len(w) + 3 - n))
    del out[" "]
    return out


def test_grams_of_many_texts():
    texts = ["Una nota, otra NOTA", None, "", " ", "a", "ß İstanbul ΣΑΣ ς", "中文 文本", "\U00010400x \ud800 y", "½²x٣", "b"] * 300 + ["palabra " * 100_000, "fin"]
    found, base = {}, 0
    for part in language.parts(texts):
        for text, code, n in zip(*map(list, language.counted(part)), strict=True):
            found[base + text, language.gram_of(int(code))] = n
        base += len(part)
    assert base == len(texts) and found == {(i, g): n for i, t in enumerate(texts) for g, n in plain(t).items()}


def test_nearest_of_many_texts():
    profiles = language.Profiles({lang: {g: k for k, (g, _) in enumerate(sorted(plain(t).items(), key=lambda x: (-x[1], x[0])))} for lang, t in {"es": "la nota que el día trae", "de": "die Zeitung der Stadt", "aa": "die Zeitung der Stadt"}.items()})
    texts = ["la nota", "die Stadt", None, "12", "xyz"]
    assert profiles.nearest_of(texts) == [profiles.nearest(t) for t in texts] and [n for n, _ in profiles.nearest_of(texts)] == ["es", "aa", None, None, "aa"]
    assert profiles.nearest("die Stadt")[1] == 0.0 and language.Profiles({}).nearest_of(texts) == [(None, 0.0)] * 5
