"""Porter stemmer (M. F. Porter, "An algorithm for suffix stripping", 1980) as SQL expressions over a word column.

A word's letters are told apart by its shape, a string of ``c`` (consonant) and ``v`` (vowel; ``y`` after a consonant is
one). The algorithm's measure is the number of ``vc`` in a shape, and the shape of a stem is the beginning of its word's.
Each step is one expression over the columns ``w`` (word) and ``s`` (its shape); the rules of a step stand from the
longest suffix down, and the first that fits decides. No Python runs per word.

The steps are plain SQL but for the shape, which is a fold over letters and differs between engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# fixed values: the rules as published (suffix, replacement)
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
]
STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
         "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]

SHAPE = ("aggregate(split({w}, ''), '', (a, x) -> concat(a, CASE WHEN x IN ('a', 'e', 'i', 'o', 'u', '#') OR (x = 'y' AND right(a, 1) = 'c') "
         "THEN 'v' ELSE 'c' END))")


def _cut(col: str, n: int) -> str:
    return f"left({col}, length({col}) - {n})"


def _measure(shape: str) -> str:
    return f"((length({shape}) - length(replace({shape}, 'vc', ''))) / 2)"


def _double(w: str, s: str) -> str:
    """Ends in two equal consonants."""
    return f"(length({w}) >= 2 AND right({w}, 1) = left(right({w}, 2), 1) AND right({s}, 1) = 'c')"


def _cvc(w: str, s: str) -> str:
    return f"({s} LIKE '%cvc' AND right({w}, 1) NOT IN ('w', 'x', 'y'))"


def _rules(rules: list[tuple[str, str]]) -> str:
    whens = [f"WHEN w LIKE '%{a}' THEN CASE WHEN {_measure(_cut('s', len(a)))} > 0 THEN concat({_cut('w', len(a))}, '{b}') ELSE w END"
             for a, b in sorted(rules, key=lambda r: -len(r[0]))]
    return f"CASE {' '.join(whens)} ELSE w END"


def steps() -> list[str]:
    """The steps in order, each an expression for the new word over ``w`` and ``s``. ``#`` in front of a word says that step
    1b took ``ed`` or ``ing`` away; in a shape it is as good as no letter (a ``y`` after it is a consonant)."""
    s1a = f"CASE WHEN w LIKE '%sses' OR w LIKE '%ies' THEN {_cut('w', 2)} WHEN w LIKE '%ss' THEN w WHEN w LIKE '%s' THEN {_cut('w', 1)} ELSE w END"
    s1b = (f"CASE WHEN w LIKE '%eed' THEN CASE WHEN {_measure(_cut('s', 3))} > 0 THEN {_cut('w', 1)} ELSE w END "
           f"WHEN w LIKE '%ed' AND {_cut('s', 2)} LIKE '%v%' THEN concat('#', {_cut('w', 2)}) "
           f"WHEN w LIKE '%ing' AND {_cut('s', 3)} LIKE '%v%' THEN concat('#', {_cut('w', 3)}) ELSE w END")
    rest, shape = "substr(w, 2)", "substr(s, 2)"
    s1b2 = (f"CASE WHEN w NOT LIKE '#%' THEN w WHEN w LIKE '%at' OR w LIKE '%bl' OR w LIKE '%iz' THEN concat({rest}, 'e') "
            f"WHEN {_double(rest, shape)} AND right(w, 1) NOT IN ('l', 's', 'z') THEN {_cut(rest, 1)} "
            f"WHEN {_measure(shape)} = 1 AND {_cvc(rest, shape)} THEN concat({rest}, 'e') ELSE {rest} END")
    s1c = f"CASE WHEN w LIKE '%y' AND {_cut('s', 1)} LIKE '%v%' THEN concat({_cut('w', 1)}, 'i') ELSE w END"
    s4 = []
    for a in sorted(STEP4, key=len, reverse=True):
        more = f" AND right({_cut('w', 3)}, 1) IN ('s', 't')" if a == "ion" else ""
        s4.append(f"WHEN w LIKE '%{a}' THEN CASE WHEN {_measure(_cut('s', len(a)))} > 1{more} THEN {_cut('w', len(a))} ELSE w END")
    s5a = (f"CASE WHEN w LIKE '%e' AND ({_measure(_cut('s', 1))} > 1 OR ({_measure(_cut('s', 1))} = 1 AND NOT {_cvc(_cut('w', 1), _cut('s', 1))})) "
           f"THEN {_cut('w', 1)} ELSE w END")
    s5b = f"CASE WHEN {_measure('s')} > 1 AND {_double('w', 's')} AND w LIKE '%l' THEN {_cut('w', 1)} ELSE w END"
    return [s1a, s1b, s1b2, s1c, _rules(STEP2), _rules(STEP3), f"CASE {' '.join(s4)} ELSE w END", s5a, s5b]


def stems(words: DataFrame, col: str, out: str = "stem") -> DataFrame:
    """``words`` with ``out``: the stem of each word. Words of one or two letters are their own stems; null stays null."""
    keep = [c for c in words.columns if c != out]
    d = words.selectExpr(*[f"`{c}`" for c in keep], f"lower(`{col}`) AS _w")
    d = d.selectExpr("*", "_w AS w")
    for step in steps():
        d = d.selectExpr(*[f"`{c}`" for c in keep], "_w", "w", f"{SHAPE.format(w='w')} AS s")
        d = d.selectExpr(*[f"`{c}`" for c in keep], "_w", f"{step} AS w")
    return d.selectExpr(*[f"`{c}`" for c in keep], f"CASE WHEN length(_w) <= 2 THEN _w ELSE w END AS `{out}`")
