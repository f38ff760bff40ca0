"""English stems by Porter's algorithm [Porter 1980], as SQL expressions that Spark and DuckDB both read.

Each step is one expression over a word w. Words of one or two letters, and
those with anything but a to z, are their own stems. `porter` does the same
for one word in Python, for folds over whole texts that keep the stems they
have seen; a test holds the two against each other.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Endings and what stands in their place, by step.
ENDINGS_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize",
    "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log",
}
ENDINGS_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
ENDINGS_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]

_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
#: What is before an ending: measure above 0, exactly 1, above 1; a vowel; consonant, vowel, consonant.
_M0, _M1, _MORE = f"^({_C})?{_V}{_C}", f"^({_C})?{_V}{_C}({_V})?$", f"^({_C})?{_V}{_C}{_V}{_C}"
_VOWEL, _CVC = f"^({_C})?[aeiouy]", f"^{_C}[aeiouy][^aeiouwxyY]$"


def steps(like: str = "rlike") -> list[str]:
    """The steps as expressions of w. like: the name of the function that says whether a pattern is found in a text."""
    before = lambda n: f"left(w, length(w) - {n})"
    has = lambda text, pattern: f"{like}({text}, '{pattern}')"
    ends = lambda text, tail: f"right({text}, {len(tail)}) = '{tail}'"

    def swapped(endings: dict[str, str], pattern: str) -> str:
        cases = [f"when {ends('w', e)} then case when {has(before(len(e)), pattern)} then concat({before(len(e))}, '{to}') else w end" for e, to in sorted(endings.items(), key=lambda x: (-len(x[0]), x[0]))]
        return f"case when length(w) < 3 then w {' '.join(cases)} else w end"

    tidy = (
        f"case when substr(w, 1, 1) <> '+' then w when {has('w', '(at|bl|iz)$')} then concat(substr(w, 2), 'e') "
        f"when length(w) > 2 and right(w, 1) = substr(w, length(w) - 1, 1) and {has('w', '[^aeiouylsz]$')} then substr(w, 2, length(w) - 2) when {has('substr(w, 2)', _CVC)} then concat(substr(w, 2), 'e') else substr(w, 2) end"
    )
    removed = {e: "" for e in ENDINGS_4}
    cases_4 = [f"when {ends('w', e)} then case when {has(before(len(e)), _MORE)} then {before(len(e))} else w end" for e in sorted([*removed, "ion"], key=lambda e: (-len(e), e)) if e != "ion"]
    ion = f"when {ends('w', 'ion')} then case when {has(before(3), '[st]$')} and {has(before(3), _MORE)} then {before(3)} else w end"
    return [
        "case when substr(w, 1, 1) = 'y' and length(w) > 2 then concat('Y', substr(w, 2)) else w end",
        f"case when length(w) < 3 then w when {has('w', '.(ss|i)es$')} then {before(2)} when {has('w', '.[^s]s$')} then {before(1)} else w end",
        # a leading + marks words that lost ed or ing, for the next step
        f"case when length(w) < 3 then w when {ends('w', 'eed')} then case when {has(before(3), _M0)} then {before(1)} else w end "
        f"when {ends('w', 'ed')} and {has(before(2), _VOWEL)} then concat('+', {before(2)}) when {ends('w', 'ing')} and {has(before(3), _VOWEL)} then concat('+', {before(3)}) else w end",
        tidy,
        f"case when length(w) > 2 and {ends('w', 'y')} and {has(before(1), _VOWEL)} then concat({before(1)}, 'i') else w end",
        swapped(ENDINGS_2, _M0),
        swapped(ENDINGS_3, _M0),
        f"case when length(w) < 3 then w {' '.join(cases_4)} {ion} else w end",
        f"case when length(w) > 2 and {ends('w', 'e')} and ({has(before(1), _MORE)} or ({has(before(1), _M1)} and not {has(before(1), _CVC)})) then {before(1)} else w end",
        f"case when length(w) > 2 and {ends('w', 'll')} and {has('w', _MORE)} then {before(1)} else w end",
        "case when substr(w, 1, 1) = 'Y' then concat('y', substr(w, 2)) else w end",
    ]


def stem_of(word: str) -> str:
    """The stem of a column as one Spark SQL expression; each step's word is bound once, so the steps don't multiply."""
    out = word
    for step in steps():
        out = f"transform(array({out}), w -> {step})[0]"
    return f"case when rlike({word}, '^[a-z]+$') then {out} else {word} end"


def with_stems(words: DataFrame, word: str = "word", stem: str = "stem") -> DataFrame:
    """words with the stem of each; null stays null."""
    return words.withColumn(stem, F.expr(stem_of(word)))


def stems_sql(words: str, word: str = "word", stem: str = "stem") -> str:
    """DuckDB SQL for the rows of the query `words` with their stems."""
    out = f"select *, {word} as w from ({words})"
    for step in steps("regexp_matches"):
        out = f"select * replace (case when not regexp_matches({word}, '^[a-z]+$') then w else {step} end as w) from ({out})"
    return f"select * exclude (w), w as {stem} from ({out})"


_HAS = {name: re.compile(pattern).search for name, pattern in {"m0": _M0, "m1": _M1, "more": _MORE, "vowel": _VOWEL, "cvc": _CVC, "st": "[st]$", "ss": ".(ss|i)es$", "s": ".[^s]s$", "e": "(at|bl|iz)$", "double": "[^aeiouylsz]$"}.items()}
_BY_LENGTH = lambda endings: sorted(endings, key=lambda e: (-len(e), e))
_STEPS_2_3 = [(endings, _BY_LENGTH(endings)) for endings in (ENDINGS_2, ENDINGS_3)]
_STEP_4 = [*_BY_LENGTH(ENDINGS_4), "ion"]


def porter(w: str) -> str:
    """The stem of one word, by the steps of steps()."""
    has = _HAS
    if len(w) < 3 or not (w.isascii() and w.isalpha() and w.islower()):
        return w
    if w[0] == "y":
        w = "Y" + w[1:]
    if has["ss"](w):
        w = w[:-2]
    elif has["s"](w):
        w = w[:-1]
    if len(w) >= 3:
        cut = None
        if w.endswith("eed"):
            if has["m0"](w[:-3]):
                w = w[:-1]
        elif w.endswith("ed") and has["vowel"](w[:-2]):
            cut = w[:-2]
        elif w.endswith("ing") and has["vowel"](w[:-3]):
            cut = w[:-3]
        if cut is not None:
            if has["e"](cut):
                w = cut + "e"
            elif cut[-1:] == cut[-2:-1] and has["double"](cut):
                w = cut[:-1]
            else:
                w = cut + "e" if has["cvc"](cut) else cut
    if len(w) > 2 and w[-1] == "y" and has["vowel"](w[:-1]):
        w = w[:-1] + "i"
    for endings, order in _STEPS_2_3:
        if len(w) >= 3:
            for e in order:
                if w.endswith(e):
                    if has["m0"](w[: -len(e)]):
                        w = w[: -len(e)] + endings[e]
                    break
    if len(w) >= 3:
        for e in _STEP_4:
            if w.endswith(e):
                before = w[: -len(e)]
                if has["more"](before) and (e != "ion" or has["st"](before)):
                    w = before
                break
    if len(w) > 2 and w[-1] == "e":
        before = w[:-1]
        if has["more"](before) or (has["m1"](before) and not has["cvc"](before)):
            w = before
    if len(w) > 2 and w.endswith("ll") and has["more"](w):
        w = w[:-1]
    return "y" + w[1:] if w[:1] == "Y" else w
