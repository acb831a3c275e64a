"""The public Porter stemming rules (M. F. Porter, 1980) as column expressions.

A word is read as runs of consonants and vowels; its measure is the number of times a vowel run is followed by a
consonant run. ``y`` is a vowel after a consonant, so a leading ``y`` is written ``Y`` while the steps run: then a
consonant run is one of anything but ``aeiou`` and more of anything but ``aeiouy``, and patterns settle every test.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffix -> replacement when the part before it has measure > 0.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate",
    "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al",
    "iviti": "ive", "biliti": "ble",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
# Suffixes dropped when the part before them has measure > 1.
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
    "ate", "iti", "ous", "ive", "ize",
)

CONSONANTS = "[^aeiou][^aeiouy]*"
VOWELS = "[aeiouy][aeiou]*"
HAS_VOWEL = f"^({CONSONANTS})?[aeiouy]"
ABOVE_0 = f"^({CONSONANTS})?{VOWELS}{CONSONANTS}"
ABOVE_1 = f"{ABOVE_0}{VOWELS}{CONSONANTS}"
EXACTLY_1 = rf"{ABOVE_0}({VOWELS})?\z"
#: Measure 1 and an end of consonant, vowel, consonant other than w, x, y: nothing else stands in such a word.
SHORT = rf"^{CONSONANTS}[aeiouy][^aeiouwxy]\z"
#: The same consonant twice, but l, s and z. In a run of ``y`` vowels and consonants take turns.
DOUBLED = r"([^aeiouylsz])\1\z|[^aeiouy](yy)+\z|[aeiou]y(yy)+\z"

Step = Callable[[Column], Column]


def _without(word: Column, size: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - size)


def _longest_first(suffixes) -> list[str]:
    return sorted(suffixes, key=len, reverse=True)


def _rules(word: Column, suffixes, then: Callable[[str], Column]) -> Column:
    """What ``then`` says about the longest suffix the word has; a word with none stays. Its last letter is looked at first."""
    by_letter: dict[str, list[str]] = {}
    for suffix in _longest_first(suffixes):
        by_letter.setdefault(suffix[-1], []).append(suffix)

    def among(group: list[str]) -> Column:
        first, *others = group
        chosen = F.when(word.endswith(first), then(first))
        for suffix in others:
            chosen = chosen.when(word.endswith(suffix), then(suffix))
        return chosen.otherwise(word)

    (letter, group), *others = by_letter.items()
    chosen = F.when(word.endswith(letter), among(group))
    for letter, group in others:
        chosen = chosen.when(word.endswith(letter), among(group))
    return chosen.otherwise(word)


def _replacing(rules: Mapping[str, str]) -> Step:
    def step(word: Column) -> Column:
        def then(suffix: str) -> Column:
            rest = _without(word, len(suffix))
            return F.when(rest.rlike(ABOVE_0), F.concat(rest, F.lit(rules[suffix]))).otherwise(word)

        return _rules(word, rules, then)

    return step


def _plural(word: Column) -> Column:
    shorter = {"sses": 2, "ies": 2, "ss": 0, "s": 1}
    return _rules(word, shorter, lambda suffix: _without(word, shorter[suffix]))


def _past(word: Column) -> Column:
    """The participle's ending goes; the word left is marked with a space at its end for the next step."""

    def then(suffix: str) -> Column:
        rest = _without(word, len(suffix))
        if suffix == "eed":
            return F.when(rest.rlike(ABOVE_0), _without(word, 1)).otherwise(word)
        return F.when(rest.rlike(HAS_VOWEL), F.concat(rest, F.lit(" "))).otherwise(word)

    return _rules(word, ("eed", "ed", "ing"), then)


def _mended(word: Column) -> Column:
    """What is left of a participle gets its ``e`` back or loses a doubled letter."""
    rest = _without(word, 1)
    mended = (
        F.when(rest.rlike(r"(at|bl|iz)\z"), F.concat(rest, F.lit("e")))
        .when(rest.rlike(DOUBLED), _without(word, 2))
        .when(rest.rlike(SHORT), F.concat(rest, F.lit("e")))
        .otherwise(rest)
    )
    return F.when(word.endswith(" "), mended).otherwise(word)


def _last_y(word: Column) -> Column:
    rest = _without(word, 1)
    return F.when(word.endswith("y") & rest.rlike(HAS_VOWEL), F.concat(rest, F.lit("i"))).otherwise(word)


def _dropping(word: Column) -> Column:
    def then(suffix: str) -> Column:
        rest = _without(word, len(suffix))
        drop = rest.rlike(ABOVE_1)
        if suffix == "ion":
            drop = drop & rest.rlike(r"[st]\z")
        return F.when(drop, rest).otherwise(word)

    return _rules(word, STEP4, then)


def _last_e(word: Column) -> Column:
    rest = _without(word, 1)
    drop = rest.rlike(ABOVE_1) | (rest.rlike(EXACTLY_1) & ~rest.rlike(SHORT))
    return F.when(word.endswith("e") & drop, rest).otherwise(word)


def _last_l(word: Column) -> Column:
    return F.when(word.endswith("ll") & word.rlike(ABOVE_1), _without(word, 1)).otherwise(word)


STEPS: tuple[Step, ...] = (
    _plural, _past, _mended, _last_y, _replacing(STEP2), _replacing(STEP3), _dropping, _last_e, _last_l,
)


def stems(words: Column) -> Column:
    """The stems of an array of words, lower-cased; words of up to two characters and nulls stay as they are.

    Each step is a pass over the array, which names the word once however often the step looks at it. Words are
    runs without whitespace.
    """
    lowered = F.transform(words, lambda word: F.lower(word))
    kept = F.transform(lowered, lambda word: F.when(word.startswith("y"), F.concat(F.lit("Y"), F.substring(word, 2, 2**31 - 1))).otherwise(word))
    for step in STEPS:
        kept = F.transform(kept, step)
    kept = F.transform(kept, lambda word: F.when(word.startswith("Y"), F.concat(F.lit("y"), F.substring(word, 2, 2**31 - 1))).otherwise(word))
    return F.zip_with(lowered, kept, lambda word, stem: F.when(F.length(word) > 2, stem).otherwise(word))
