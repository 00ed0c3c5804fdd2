"""Verifiers (G4-G13, G17, G19) as column rules and their registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollweave.functions import latex
from rollweave.functions.text import remove_thinking
from rollweave.operators.messages import as_column, let, strip_space

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Sample:
    """What a rule may look at."""

    prediction: Column
    label: Column
    tokens: Column
    config: dict


@dataclass(frozen=True)
class Verifier:
    """``by_row`` rules see all their labels of a response as one array and give a score for each."""

    name: str
    score: Callable[[Sample], Column]
    weight: float = 1.0
    by_row: bool = False


def as_score(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def normalise_answer(text: str | Column) -> Column:
    """Lower case, no punctuation, no articles, single spaces."""
    bare = F.translate(F.lower(as_column(text)), PUNCTUATION, "")
    bare = F.regexp_replace(bare, r"(?U)\b(a|an|the)\b", " ")
    return strip_space(F.regexp_replace(bare, r"(?U)\s+", " "))


def answer_words(text: Column) -> Column:
    return F.filter(F.split(normalise_answer(text), " "), lambda w: w != "")


def _shared_words(p: Column, t: Column) -> Column:
    """Size of the multiset intersection: both sides sorted together, counted in one pass."""
    side = lambda words, flag: F.transform(words, lambda w: F.struct(w.alias("w"), F.lit(flag).alias("s")))
    start = F.struct(F.lit("").alias("w"), F.lit(0).alias("p"), F.lit(0).alias("t"), F.lit(0).alias("same"))

    def step(acc: Column, item: Column) -> Column:
        fresh = acc["w"] != item["w"]
        count = lambda name, flag: F.when(fresh, 0).otherwise(acc[name]) + F.when(item["s"] == flag, 1).otherwise(0)
        done = F.when(fresh, F.least(acc["p"], acc["t"])).otherwise(0)
        return F.struct(item["w"].alias("w"), count("p", 0).alias("p"), count("t", 1).alias("t"), (acc["same"] + done).alias("same"))

    merged = F.sort_array(F.concat(side(p, 0), side(t, 1)))
    return F.aggregate(merged, start, step, lambda acc: acc["same"] + F.least(acc["p"], acc["t"]))


def f1(prediction: Column, label: Column) -> Column:
    """Token multiset F1."""

    def score(words: Column) -> Column:
        p, t = words["p"], words["t"]
        share = lambda n, part: n / F.size(part)
        ratio = lambda n: F.when(n == 0, F.lit(0.0)).otherwise(
            2 * share(n, p) * share(n, t) / (share(n, p) + share(n, t))
        )
        return let(_shared_words(p, t), ratio)

    return let(F.struct(answer_words(prediction).alias("p"), answer_words(label).alias("t")), score)


def best_f1(prediction: Column, labels: Column) -> Column:
    return F.array_max(F.transform(labels, lambda label: f1(prediction, label)))


def label_list(label: Column) -> Column:
    """A JSON list of labels, or the trimmed text itself."""
    single = F.get_json_object(F.concat(F.lit('{"x":'), label, F.lit("}")), "$.x")
    parsed = F.when(F.trim(label).startswith("["), F.from_json(label, "array<string>"))
    return F.coalesce(parsed, F.array(F.coalesce(single, strip_space(label))))


def gsm8k(s: Sample) -> Column:
    """The last signed number, thousands commas removed, else the whole text."""
    response = F.regexp_replace(s.prediction, r"(\d),(\d)", "$1$2")
    number = F.try_element_at(F.regexp_extract_all(response, F.lit(r"[-+]?(?:\d*\.\d+|\d+)"), F.lit(0)), F.lit(-1))
    return as_score(F.lower(F.coalesce(number, response)) == F.lower(s.label))


def math(s: Sample) -> Column:
    """Boxed and stated answers, else the last dollar span, else the whole text."""
    text = s.prediction
    named = F.array_compact(F.array(latex.boxed_answer(text), latex.stated_answer(text)))
    dollars = F.array_compact(F.array(latex.dollar_answer(text)))
    whole = F.array(latex.normalise_final(text), text)
    fallback = let(dollars, lambda d: F.when(F.size(d) > 0, d).otherwise(whole))
    candidates = let(named, lambda n: F.when(F.size(n) > 0, n).otherwise(fallback))
    return as_score(let(candidates, lambda c: latex.any_equal(c, s.label)))


def strict_math(s: Sample) -> Column:
    """The closing formula only, else the normalised whole text."""
    answer = F.coalesce(latex.stated_answer(s.prediction), latex.normalise_final(s.prediction))
    return as_score(latex.any_equal(F.array(answer), s.label))


def flan(s: Sample) -> Column:
    """G7."""
    answer = strip_space(F.substring_index(s.prediction, "The answer is: ", -1))
    return as_score(normalise_answer(answer) == normalise_answer(s.label))


def string_matcher(s: Sample) -> Column:
    """Both answer tags are needed."""
    tagged = F.contains(s.prediction, F.lit("<answer>")) & F.contains(s.prediction, F.lit("</answer>"))
    body = F.substring_index(F.substring_index(s.prediction, "<answer>", -1), "</answer>", 1)
    return as_score(tagged & (normalise_answer(body) == normalise_answer(s.label)))


def puzzle(s: Sample) -> Column:
    """G9."""
    return as_score(normalise_answer(remove_thinking(s.prediction)) == normalise_answer(s.label))


def string_f1(s: Sample) -> Column:
    """G10 for one label; ``best_f1`` takes several."""
    return f1(remove_thinking(s.prediction), s.label)


def re_search_f1(s: Sample) -> Column:
    """F1 of the ``<finish>`` body, 0.1 for the form alone; missing both tags or an empty body is 0."""
    untagged = ~F.contains(s.prediction, F.lit("<finish>")) & ~F.contains(s.prediction, F.lit("</finish>"))
    body = F.substring_index(F.substring_index(s.prediction, "<finish>", -1), "</finish>", 1)
    best = let(best_f1(body, label_list(s.label)), lambda x: F.when(x == 0, F.lit(0.1)).otherwise(x))
    return F.when(untagged | (body == ""), F.lit(0.0)).otherwise(best)


def re_search(s: Sample) -> Column:
    """The first ``<finish>`` body equals any label after normalisation."""
    body = strip_space(F.get(F.regexp_extract_all(s.prediction, F.lit(r"(?is)<finish>(.*?)</finish>"), F.lit(1)), 0))
    hit = lambda answer: F.exists(label_list(s.label), lambda label: normalise_answer(label) == answer)
    return as_score((body != "") & let(normalise_answer(body), hit))


def max_length(s: Sample) -> Column:
    """May be negative."""
    return 1 - F.abs(s.tokens - s.label.cast("double")) / s.config.get("max_length", 32768)


def up_to_max_length(s: Sample) -> Column:
    """Shorter is fine, longer falls linearly and may be negative."""
    over = s.tokens - s.label.cast("double")
    return F.when(over < 0, F.lit(1.0)).otherwise(1 - over / s.config.get("max_length", 32768))


def passthrough(s: Sample) -> Column:
    """G17."""
    return F.lit(0.0)


def format_reward(text: str | Column, scale: float = 1.0) -> Column:
    """``...</think> <answer>...</answer>`` from the start of the text."""
    matched = as_column(text).rlike(r"(?s)\A.*?</think>\s*<answer>.*?</answer>")
    return F.when(matched, F.lit(float(scale))).otherwise(F.lit(0.0))


_VERIFIERS: dict[str, Verifier] = {}


def register_verifier(name: str, score: Callable[[Sample], Column], weight: float = 1.0, by_row: bool = False) -> None:
    """L2: add a scoring rule.

    A rule of built-in expressions scores one label at a time, inside the row. A ``pandas_udf`` cannot run
    there; register it with ``by_row``: ``label`` is then the array of all its labels of a response, and the
    rule returns an array of as many scores.
    """
    _VERIFIERS[name.lower()] = Verifier(name.lower(), score, weight, by_row)


for _rule in (gsm8k, math, strict_math, flan, string_matcher, puzzle, string_f1, re_search_f1, re_search, max_length, up_to_max_length, passthrough):
    register_verifier(_rule.__name__, _rule)


def build_verifiers(remap: str | None = None, names: list[str] | None = None) -> dict[str, Verifier]:
    """The registry, with ``old=new`` calling the new rule under the old name.

    ``names`` narrows it to the rules a table uses, which keeps the plan small.
    """
    from rollweave.functions import constraints  # noqa: F401 - registers the constraint verifiers

    verifiers = {k: x for k, x in _VERIFIERS.items() if names is None or k in names}
    if remap:
        parts = remap.split("=")
        if len(parts) != 2:
            raise ValueError("remap must be old_name=new_name")
        old, new = (p.lower() for p in parts)
        if new not in verifiers:
            raise ValueError(f"{new} not found in verifiers during remapping")
        verifiers[old] = verifiers[new]
    return verifiers
