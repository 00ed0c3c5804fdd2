"""Extraction rules over text columns (B18-B22) as table jobs.

Each rule is a column builder; ``extract`` adds its value to a table and ``rule_counts``
reports how often it matched or fell back.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.operators.messages import as_column, strip_space

# Two transcript syntaxes, the turn before an assistant think-turn.
QUERY_PATTERN = (
    r"(?s)(?:<\|user\|>\n(.*?)\n<\|assistant\|>\n<think>"
    r"|<\|im_start\|>user\n(.*?)(?:\n<functions>.*?</functions>)?<\|im_end\|>\n"
    r"(?=[\s\S]*?<\|im_start\|>assistant\n<think>))"
)
FENCE_PATTERN = r"(?s)```(?:python)?(.*?)```"


def extract_user_query(conversation: str | Column) -> Column:
    """Last user turn before an assistant think-turn, else the whole text."""
    text = as_column(conversation)
    simple = F.try_element_at(F.regexp_extract_all(text, F.lit(QUERY_PATTERN), F.lit(1)), F.lit(-1))
    tagged = F.try_element_at(F.regexp_extract_all(text, F.lit(QUERY_PATTERN), F.lit(2)), F.lit(-1))
    body = F.when(simple != "", simple).otherwise(tagged)
    return F.coalesce(strip_space(body), text)


def extract_final_answer(prediction: str | Column) -> Column:
    """``<answer>`` body, else text after the first ``</think>``, else without the role tag."""
    text = as_column(prediction)
    answer = F.get(F.regexp_extract_all(text, F.lit(r"(?s)<answer>(.*?)</answer>"), F.lit(1)), 0)
    thought = F.instr(text, "</think>")
    after = F.substr(text, thought + len("</think>"))
    cleaned = F.replace(text, F.lit("<|assistant|>"), F.lit(""))
    return (
        F.when(answer.isNotNull(), strip_space(answer))
        .when(thought > 0, strip_space(after))
        .when(cleaned != text, strip_space(cleaned))
        .otherwise(text)
    )


def remove_thinking(prediction: str | Column) -> Column:
    """Text after the last ``</think>`` without role and answer tags, trimmed."""
    text = strip_space(F.replace(as_column(prediction), F.lit("<|assistant|>"), F.lit("")))
    text = F.substring_index(text, "</think>", -1)
    for tag in ("<answer>", "</answer>"):
        text = F.replace(text, F.lit(tag), F.lit(""))
    return strip_space(text)


def extract_code(output: str | Column) -> Column:
    """Last fenced block, else the whole text."""
    text = as_column(output)
    block = F.try_element_at(F.regexp_extract_all(text, F.lit(FENCE_PATTERN), F.lit(1)), F.lit(-1))
    return F.coalesce(strip_space(block), text)


def extract_tool_calls(df: DataFrame, text: str, tools: list[str]) -> DataFrame:
    """One row per ``<name>body</name>`` span of each tool, in text order.

    Spans of one tool never overlap, spans of different tools may nest; each tool is therefore
    matched on its own and ordered by where its span starts.
    """
    spans = []
    for name in tools:
        pattern = F.lit(f"(?s)<{re.escape(name)}>(.*?)</{re.escape(name)}>")
        bodies = F.regexp_extract_all(text, pattern, F.lit(1))
        gap = F.split(F.col(text), f"(?s)<{re.escape(name)}>.*?</{re.escape(name)}>", -1)
        tags = 2 * len(name) + 5

        def starts(bodies: Column = bodies, gap: Column = gap, name: str = name, tags: int = tags) -> Column:
            sized = F.transform(bodies, lambda b, i: F.struct(F.length(F.get(gap, i)).alias("g"), F.length(b).alias("n"), b.alias("b")))
            begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,tool_name:string,content:string>>").alias("out"))
            step = lambda acc, s: F.struct(
                (acc["at"] + s["g"] + s["n"] + tags).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(F.struct((acc["at"] + s["g"]).alias("start"), F.lit(name).alias("tool_name"), s["b"].alias("content"))),
                ).alias("out"),
            )
            return F.aggregate(sized, begin, step, lambda acc: acc["out"])

        spans.append(starts())
    ordered = F.array_sort(F.concat(*spans))
    return df.select("*", F.posexplode(ordered).alias("call_no", "call")).select(
        *df.columns, "call_no", "call.tool_name", "call.content"
    )


def stop_sequence_call(text: str | Column, tool: str, stops: list[str]) -> Column:
    """B22, stop form: one call holding the whole text once any stop sequence occurs."""
    text = as_column(text)
    hit = F.lit(False)
    for stop in dict.fromkeys(stops):
        hit = hit | F.contains(text, F.lit(stop))
    return F.when(hit, F.struct(F.lit(tool).alias("tool_name"), text.alias("content")))


def format_tool_outputs(outputs: str | Column, wrap: str = "output") -> Column:
    """Each output in its wrapper, joined by newlines."""
    wrapped = F.transform(as_column(outputs), lambda o: F.concat(F.lit(f"<{wrap}>\n"), o, F.lit(f"\n</{wrap}>\n")))
    return F.array_join(wrapped, "\n")


EXTRACTORS = {
    "user_query": extract_user_query,
    "final_answer": extract_final_answer,
    "without_thinking": remove_thinking,
    "code": extract_code,
}


def extract(df: DataFrame, column: str, rule: str, out: str | None = None) -> DataFrame:
    """Add the value of a named rule to a table."""
    return df.withColumn(out or rule, EXTRACTORS[rule](column))


def rule_counts(df: DataFrame, column: str, extracted: str, by: str) -> DataFrame:
    """Per source: rows, rows where the rule found something, rows that kept the whole text."""
    changed = F.col(column) != F.col(extracted)
    return df.groupBy(by).agg(
        F.count("*").alias("rows"),
        F.count_if(changed).alias("matched"),
        F.count_if(~changed).alias("fallback"),
    )
