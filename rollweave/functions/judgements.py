"""Parsing of judge answers (I1-I5) as column rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollweave.operators.messages import as_column, let, strip_space

# Words that decide without a number.
POSITIVE = ("yes", "correct", "good", "true", "pass")
NEGATIVE = ("no", "incorrect", "bad", "false", "fail")


def _any_word(text: Column, words: tuple[str, ...]) -> Column:
    return text.rlike("|".join(words))


def parse_score(text: str | Column) -> Column:
    """First ratio, else percent, else number, else positive or negative words, else 0."""
    text = as_column(text)
    number = r"(\d+\.?\d*|\.\d+)"
    first = lambda pattern, group: F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), 0)
    ratio = F.try_divide(first(r"(\d+)/(\d+)", 1).cast("double"), first(r"(\d+)/(\d+)", 2).cast("double"))
    percent = first(number + "%", 1).cast("double") / 100
    plain = first(number, 1).cast("double")
    word = F.when(_any_word(F.lower(text), POSITIVE), 1.0).otherwise(0.0)
    return F.coalesce(ratio, percent, plain, word)


def parse_decision(text: str | Column) -> Column:
    """The closing yes or no, 0 without either."""
    return F.when(F.contains(F.lower(as_column(text)), F.lit("final decision: yes")), 1.0).otherwise(0.0)


def clean_judgement(text: str | Column) -> Column:
    """Code fences stripped, newlines and stray backslashes escaped."""
    bare = F.regexp_replace(strip_space(as_column(text)), r"\A```(?:json)?", "")
    bare = F.regexp_replace(bare, r"```\z", "")
    bare = F.replace(F.replace(bare, F.lit("\r\n"), F.lit("\n")), F.lit("\n"), F.lit("\\n"))
    return strip_space(F.regexp_replace(bare, r"\\(?![\"\\/bfnrtu])", r"\\\\"))


def parse_json_score(text: str | Column, scale: float = 1.0) -> Column:
    """``{reasoning, score}`` of a JSON answer, by pattern when it does not parse, else 0.

    A leading escaped newline is what remains of a fence line and is not part of the object.
    """

    def read(clean: Column) -> Column:
        body = F.regexp_replace(clean, r"\A(?:\\n|\s)+|(?:\\n|\s)+\z", "")
        fields = F.from_json(body, "struct<REASONING:string,SCORE:string,_corrupt_record:string>")
        parsed = body.startswith("{") & fields["_corrupt_record"].isNull()
        direct = F.coalesce(F.try_to_number(F.trim(fields["SCORE"]), F.lit("S99999D999999")).cast("double"), fields["SCORE"].try_cast("double"))
        found = F.get(F.regexp_extract_all(clean, F.lit(r'"SCORE"\s*:\s*"?([0-9]+(?:\.[0-9]+)?)"?'), F.lit(1)), 0)
        score = F.when(parsed, F.coalesce(direct, F.lit(0.0))).otherwise(F.coalesce(found.cast("double"), F.lit(0.0)))
        reasoning = F.when(parsed, F.coalesce(fields["REASONING"], F.lit(""))).otherwise(F.when(found.isNotNull(), clean).otherwise(as_column(text)))
        return F.struct(reasoning.alias("reasoning"), (score / scale).alias("score"))

    return let(clean_judgement(text), read)


def parse_total_score(text: str | Column) -> Column:
    """I4: ``Total score: n`` of one completion, -1 when absent; average over completions."""
    found = F.get(F.regexp_extract_all(as_column(text), F.lit(r"Total score:\s*(\d+)"), F.lit(1)), 0)
    return F.coalesce(found.cast("double"), F.lit(-1.0))


#: Escaped quotes and backslashes, quotes, runs of braces, and what lies between them.
_JSON_PARTS = r'(?s)\\["\\]|"|\{+|\}+|[^\\"{}]+|\\'


def extract_json(text: str | Column) -> Column:
    """The first decodable object that ends at the last brace, doubled braces repaired.

    An object that ends there can begin in one place only: where the count of braces outside quotes, taken
    backwards, comes to nothing. One fold finds that place for the text as it is and for the text with
    doubled braces made single (a run of n braces then counts as half as many), so two texts are parsed.
    """

    def step(state: Column, part: Column) -> Column:
        n = F.length(part)
        half = F.shiftright(n + 1, 1)
        opens = F.startswith(part, F.lit("{")) & ~state["quoted"]
        closes = F.startswith(part, F.lit("}")) & ~state["quoted"]
        begin = state["left"] - n

        def depth(name: str, size: Column) -> Column:
            return F.when(closes, state[name] + size).when(opens, state[name] - size).otherwise(state[name])

        # The last ``depth`` braces of an opening run belong to the object; of doubled ones, the pairs.
        own = begin + n - state["depth"]
        pairs = begin + n - F.least(state["pairs"] * 2, n)
        return F.struct(
            depth("depth", n).alias("depth"),
            depth("pairs", half).alias("pairs"),
            F.when(part == '"', ~state["quoted"]).otherwise(state["quoted"]).alias("quoted"),
            begin.alias("left"),
            F.when((state["own"] < 0) & opens & (state["depth"] <= n), own).otherwise(state["own"]).alias("own"),
            F.when((state["doubled"] < 0) & opens & (state["pairs"] <= half), pairs).otherwise(state["doubled"]).alias("doubled"),
        )

    def search(t: Column) -> Column:
        start = F.struct(
            F.lit(0).alias("depth"), F.lit(0).alias("pairs"), F.lit(False).alias("quoted"), F.length(t).alias("left"), F.lit(-1).alias("own"), F.lit(-1).alias("doubled")
        )
        found = F.aggregate(F.reverse(F.regexp_extract_all(t, F.lit(_JSON_PARTS), F.lit(0))), start, step)

        def chosen(places: Column) -> Column:
            decoded = lambda s: F.when(F.try_parse_json(s).isNotNull(), s)
            behind = lambda at: F.when(at >= 0, F.substr(t, at + 1, F.length(t)))
            own = let(behind(places["own"]), decoded)
            repaired = F.replace(F.replace(behind(places["doubled"]), F.lit("{{"), F.lit("{")), F.lit("}}"), F.lit("}"))
            doubled = let(repaired, decoded)
            first = (places["doubled"] >= 0) & ((places["own"] < 0) | (places["doubled"] < places["own"]))
            return F.when(first, F.coalesce(doubled, own)).otherwise(F.coalesce(own, doubled))

        return let(found, chosen)

    text = as_column(text)
    upto = F.substr(text, F.lit(1), F.length(text) - F.instr(F.reverse(text), "}") + 1)
    return F.when(F.contains(text, F.lit("}")) & F.contains(text, F.lit("{")), let(upto, search))
