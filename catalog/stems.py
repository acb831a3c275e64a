"""Porter stems in SQL: a word travels with its shape (1 for a vowel, 0 for a consonant), and each step cuts off an end
and adds another. The shape of a beginning is the beginning of the shape, so it is worked out once a word."""

from __future__ import annotations

from textree.functions.porter import STEP2, STEP3, STEP4

SHAPE = """list_reduce(list_prepend('', string_split(lower(token), '')), lambda s, x: s || CASE
  WHEN x IN ('a', 'e', 'i', 'o', 'u') OR (x = 'y' AND right(s, 1) = '0') THEN '1' ELSE '0' END)"""


def measure(shape: str) -> str:
    return f"len(regexp_extract_all({shape}, '10'))"


def ending(suffixes) -> str:
    """The longest of ``suffixes`` that the word has: the leftmost place from which one reaches the end."""
    return f"regexp_extract(w, '({'|'.join(suffixes)})$', 1)"


def step(name: str, before: str, cut: str, add: str = "''", suffixes=(), keep: str = "FALSE") -> str:
    """One step; ``cut`` and ``add`` may look at the word w, its shape s, the suffix found and the shape before it, rest."""
    found = ending(suffixes) if suffixes else "right(w, 1)"
    return f"""{name} AS (SELECT token, left(w, len(w) - cut) || added AS w, left(s, len(s) - cut)
      || regexp_replace(regexp_replace(added, '[aeiou]', '1', 'g'), '[^1]', '0', 'g') AS s, mark
    FROM (SELECT *, {cut} AS cut, {add} AS added, {keep} AS mark FROM (
      SELECT * EXCLUDE (mark), mark AS marked, left(s, len(s) - len(suffix)) AS rest
      FROM (SELECT *, {found} AS suffix FROM {before}))))"""


def replacing(name: str, before: str, rules: dict[str, str]) -> str:
    ends = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in rules.items())
    met = f"suffix <> '' AND {measure('rest')} > 0"
    return step(name, before, f"CASE WHEN {met} THEN len(suffix) ELSE 0 END", f"CASE WHEN {met} THEN CASE suffix {ends} END ELSE '' END", rules)


SHORT_END = "ends_with(s, '010') AND right(w, 1) NOT IN ('w', 'x', 'y')"
LAST_TWO = "len(w) > 1 AND right(w, 1) = left(right(w, 2), 1) AND right(s, 1) = '0' AND right(w, 1) NOT IN ('l', 's', 'z')"
PAST = "suffix IN ('ed', 'ing') AND contains(rest, '1')"
#: Continues a WITH list that has ``kept`` (token): stems (token, stem) for each distinct token.
STEMS_SQL = ", ".join(
    [
        f"""p0 AS (SELECT token, lower(token) AS w, {SHAPE} AS s, FALSE AS mark
        FROM (SELECT DISTINCT token FROM kept) WHERE len(token) > 2)""",
        step("p1", "p0", "CASE suffix WHEN 'sses' THEN 2 WHEN 'ies' THEN 2 WHEN 's' THEN 1 ELSE 0 END", suffixes=("sses", "ies", "ss", "s")),
        step(
            "p2", "p1", f"CASE WHEN suffix = 'eed' AND {measure('rest')} > 0 THEN 1 WHEN {PAST} THEN len(suffix) ELSE 0 END",
            suffixes=("eed", "ed", "ing"), keep=PAST,
        ),
        step(
            "p3", "p2", f"CASE WHEN marked AND NOT regexp_matches(w, '(at|bl|iz)$') AND {LAST_TWO} THEN 1 ELSE 0 END",
            f"""CASE WHEN marked AND (regexp_matches(w, '(at|bl|iz)$') OR (NOT ({LAST_TWO}) AND {measure('s')} = 1 AND {SHORT_END}))
            THEN 'e' ELSE '' END""",
        ),
        step(
            "p4", "p3", "CASE WHEN suffix = 'y' AND contains(rest, '1') THEN 1 ELSE 0 END",
            "CASE WHEN suffix = 'y' AND contains(rest, '1') THEN 'i' ELSE '' END",
        ),
        replacing("p5", "p4", STEP2),
        replacing("p6", "p5", STEP3),
        step(
            "p7", "p6", f"""CASE WHEN suffix <> '' AND {measure('rest')} > 1
            AND (suffix <> 'ion' OR regexp_matches(w, '[st]ion$')) THEN len(suffix) ELSE 0 END""", suffixes=STEP4,
        ),
        step(
            "p8", "p7", f"""CASE WHEN suffix = 'e' AND ({measure('rest')} > 1 OR ({measure('rest')} = 1 AND NOT (
            ends_with(rest, '010') AND left(right(w, 2), 1) NOT IN ('w', 'x', 'y')))) THEN 1 ELSE 0 END""",
        ),
        step("p9", "p8", f"CASE WHEN ends_with(w, 'll') AND {measure('s')} > 1 THEN 1 ELSE 0 END"),
        "stems AS (SELECT token, w AS stem FROM p9 UNION ALL SELECT DISTINCT token, lower(token) FROM kept WHERE len(token) <= 2)",
    ]
)
