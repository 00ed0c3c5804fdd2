"""Canonical form of short LaTeX answers (G5, G6) as replacement chains.

Canonicalisation can fail (null); two answers are equal when both canonical forms exist and
agree, or else when the raw texts agree.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollweave.operators.messages import let, strip_space

# Ordered substitutions and removed expressions of the final-answer rule.
SUBSTITUTIONS = (
    ("an ", ""),
    ("a ", ""),
    (".$", "$"),
    ("\\$", ""),
    ("\\ ", ""),
    (" ", ""),
    ("mbox", "text"),
    (",\\text{and}", ","),
    ("\\text{and}", ","),
    ("\\text{m}", "\\text{}"),
)
REMOVED = (
    "square", "ways", "integers", "dollars", "mph", "inches", "ft", "hours", "km", "units", "\\ldots", "sue", "points",
    "feet", "minutes", "digits", "cents", "degrees", "cm", "gm", "pounds", "meters", "meals", "edges", "students",
    "childrentickets", "multiples", "\\text{s}", "\\text{.}", "\\text{\ns}", "\\text{}^2", "\\text{}^3", "\\text{\n}",
    "\\text{}", "\\mathrm{th}", "^\\circ", "^{\\circ}", "\\;", ",\\!", "{,}", '"', "\\dots",
)
FINAL_ANSWER = r"(?d)Final Answer: The final answer is(.*?). I hope it is correct\."
CLOSING = "I hope it is correct."


def _replace(text: Column, old: str, new: str = "") -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def _count(text: Column, part: str) -> Column:
    return F.size(F.split(text, f"\\Q{part}\\E", -1)) - 1


def _replacing(pairs):
    """Ordered replacements as one fold over a constant list of pairs."""
    listed = json.dumps([{"old": old, "new": new} for old, new in pairs])

    def apply(text: Column) -> Column:
        constant = F.from_json(F.lit(listed), "array<struct<old:string,new:string>>")
        return F.aggregate(constant, text, lambda acc, p: F.replace(acc, p["old"], p["new"]))

    return apply


def _chain(text: Column, *steps) -> Column:
    """Apply steps one after another, each on a bound value."""
    for step in steps:
        text = let(text, step)
    return text


REWRITES = (
    (r"(?md)^[^$\n]*\$([^$\n]*)\$.*$", r"\$$1\$"),  # per line, in one pass
    (r"(?d)\\text\{(.*?)\}", "$1"),
    (r"(?d)\\textbf\{(.*?)\}", "$1"),
    (r"(?d)\\overline\{(.*?)\}", "$1"),
    (r"(?d)\\boxed\{(.*)\}", "$1"),
    (r"(?d)frac([^{])(.)", "frac{$1}{$2}"),
    (r"sqrt([^{])", "sqrt{$1}"),
)


def normalise_final(answer: Column) -> Column:
    """The quantitative-answer rule: unit words and markup removed, shorthand TeX written out."""
    text = _replacing(SUBSTITUTIONS + tuple((part, "") for part in REMOVED))(F.substring_index(answer, "=", -1))
    for pattern, replacement in REWRITES:
        text = F.regexp_replace(text, pattern, replacement)
    whole_number = lambda t: F.when(_replace(t, ",").rlike(r"^[0-9]+$"), _replace(t, ",")).otherwise(t)
    return let(_replace(text, "$"), whole_number)


def _canonical_fractions(text: Column) -> Column:
    wrapped = F.regexp_replace(text, r"\\frac([^{])([^{])", r"\\frac{$1}{$2}")
    wrapped = F.regexp_replace(wrapped, r"\\frac([^{])\{", r"\\frac{$1}{")
    return (
        F.when(text.rlike(r"\\frac(\\frac|$)"), F.lit(None).cast("string"))
        .when(text.rlike(r"\\frac[^{](\\frac|$)"), text)
        .otherwise(wrapped)
    )


def _slash(text: Column) -> Column:
    whole = r"(0|-?[1-9][0-9]*)"
    return (
        F.when(_count(text, "/") != 1, text)
        .when(text.rlike(f"^{whole}/{whole}$"), F.regexp_replace(text, f"^{whole}/{whole}$", r"\\frac{$1}{$2}"))
        .when(text.rlike(r"^[+-]?[0-9]+/[+-]?[0-9]+$"), text)
        .otherwise(F.lit(None).cast("string"))
    )


# Plain replacements before and after the unit rule.
PLAIN = (
    ("\n", ""), ("\\!", ""), ("\\\\", "\\"), ("tfrac", "frac"), ("dfrac", "frac"), ("\\left", ""), ("\\right", ""),
    ("^{\\circ}", ""), ("^\\circ", ""), ("\\$", ""),
)
AFTER_UNITS = (("\\%", ""), (" .", " 0."), ("{.", "{0."))


def _units(text: Column) -> Column:
    count = _count(text, "\\text{ ")
    return F.when(count == 0, text).when(count == 1, F.substring_index(text, "\\text{ ", 1))


def _leading_zero(text: Column) -> Column:
    return F.when(text.startswith("."), F.concat(F.lit("0"), text)).otherwise(text)


def _assignment(text: Column) -> Column:
    short = (_count(text, "=") == 1) & (F.length(F.substring_index(text, "=", 1)) <= 2)
    return F.when(short, F.substring_index(text, "=", -1)).otherwise(text)


def _roots(text: Column) -> Column:
    return F.when(~text.rlike(r"\\sqrt(\\sqrt|$)"), F.regexp_replace(text, r"\\sqrt([^{])", r"\\sqrt{$1}"))


def _half(text: Column) -> Column:
    return F.when(text == "0.5", F.lit("\\frac{1}{2}")).otherwise(text)




def canonical(answer: Column) -> Column:
    """The string-equality form; null when the text cannot be brought into it."""
    spaces = _replacing(((" ", ""),))
    return _chain(
        answer, _replacing(PLAIN), _units, _replacing(AFTER_UNITS), _leading_zero, _assignment, _roots, spaces,
        _canonical_fractions, _half, _slash,
    )


def any_equal(answers: Column, label: Column) -> Column:
    """Does any of the candidate answers equal the label?"""

    def against(target: Column) -> Column:
        same = lambda a: F.coalesce(canonical(a) == target["form"], a == target["raw"])
        return F.exists(answers, lambda a: F.coalesce(same(a), F.lit(False)))

    return let(F.struct(label.alias("raw"), canonical(label).alias("form")), against)


def boxed_answer(text: Column) -> Column:
    """Body of the last ``\\boxed``: to the matching brace, or to ``$`` in the spaced form."""
    spaced = F.substring_index(F.substring_index(text, "\\boxed ", -1), "$", 1)
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end"))

    def step(acc: Column, ch: Column) -> Column:
        move = F.when(ch == "{", 1).when(ch == "}", -1).otherwise(0)
        closed = (acc["end"] == 0) & (ch == "}") & (acc["depth"] == 1)
        return F.struct((acc["depth"] + move).alias("depth"), (acc["at"] + 1).alias("at"), F.when(closed, acc["at"] + 1).otherwise(acc["end"]).alias("end"))

    def braced(tail: Column) -> Column:
        end = F.aggregate(F.split(tail, ""), start, step, lambda acc: acc["end"])
        inside = lambda e: F.when(e > 0, F.substr(tail, F.lit(2), e - 2))
        return F.when(tail.startswith("{"), let(end, inside))

    return (
        F.when(F.contains(text, F.lit("\\boxed ")), spaced)
        .when(F.contains(text, F.lit("\\boxed")), let(F.substring_index(text, "\\boxed", -1), braced))
    )


def stated_answer(text: Column) -> Column:
    """Normalised answer of the closing formula, or null."""
    found = F.regexp_extract_all(F.concat(text, F.lit(CLOSING)), F.lit(FINAL_ANSWER), F.lit(1))
    return normalise_final(strip_space(F.get(found, 0)))


def dollar_answer(text: Column) -> Column:
    """Normalised text between the last two dollar signs, or null."""
    between = lambda parts: F.when(F.size(parts) > 2, normalise_final(F.element_at(parts, -2)))
    return let(F.split(text, r"\$", -1), between)
