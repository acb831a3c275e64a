"""The Porter stemming rules for one word in plain Python: what the column expressions are held to."""

from __future__ import annotations

from textree.functions.porter import STEP2, STEP3, STEP4

VOWELS = "aeiou"


def _shape(word: str) -> str:
    """One letter per character: v for a vowel, c for a consonant (y after a consonant is a vowel)."""
    shape = ""
    for letter in word:
        vowel = letter in VOWELS or (letter == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _ends_cvc(word: str) -> bool:
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _ends_double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _longest(word: str, suffixes) -> str | None:
    found = [s for s in suffixes if word.endswith(s)]
    return max(found, key=len) if found else None


def _plural(word: str) -> str:
    if word.endswith("sses") or word.endswith("ies"):
        return word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    suffix = _longest(word, ("ed", "ing"))
    if suffix is None or "v" not in _shape(word[: -len(suffix)]):
        return word
    word = word[: -len(suffix)]
    if word.endswith(("at", "bl", "iz")):
        return word + "e"
    if _ends_double(word) and word[-1] not in "lsz":
        return word[:-1]
    if _measure(word) == 1 and _ends_cvc(word):
        return word + "e"
    return word


def _replace(word: str, rules: dict[str, str]) -> str:
    suffix = _longest(word, rules)
    if suffix and _measure(word[: -len(suffix)]) > 0:
        return word[: -len(suffix)] + rules[suffix]
    return word


def _drop(word: str) -> str:
    suffix = _longest(word, STEP4)
    if suffix is None:
        return word
    rest = word[: -len(suffix)]
    if _measure(rest) > 1 and (suffix != "ion" or rest.endswith(("s", "t"))):
        return rest
    return word


def stem(word: str) -> str:
    word = word.lower()
    if len(word) <= 2:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _drop(_replace(_replace(word, STEP2), STEP3))
    if word.endswith("e"):
        rest = word[:-1]
        if _measure(rest) > 1 or (_measure(rest) == 1 and not _ends_cvc(rest)):
            word = rest
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word
