"""Chat rendering (D1): one text per conversation from a per-message rule.

A template is a preamble, a default system block, a per-message piece and a generation
suffix.  Pieces depend only on the message, whether it comes first or last and whether a
generation prompt follows, so prefix lengths can be summed up instead of rendered again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollweave.operators.messages import let


@dataclass(frozen=True)
class Turn:
    """One message as seen by a template."""

    role: Column
    content: Column
    first: Column
    last: Column
    ends: Column
    eos: Column
    functions: Column
    function_calls: Column


@dataclass(frozen=True)
class Template:
    piece: Callable[[Turn], Column]
    suffix: str = ""
    preamble: str = ""
    default_system: str | None = None
    additive: bool = True


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _capitalised(role: Column) -> Column:
    return _text(F.upper(F.substring(role, 1, 1)), F.lower(F.substr(role, F.lit(2))))


def _joined(separator: str, named: bool = False) -> Callable[[Turn], Column]:
    def piece(t: Turn) -> Column:
        body = _text(_capitalised(t.role), ": ", t.content) if named else t.content
        gap = F.when(t.first, F.lit("")).otherwise(F.lit(separator))
        return _text(gap, body, F.when(t.ends, t.eos).otherwise(F.lit("")))

    return piece


def _assistant_only(t: Turn) -> Column:
    return F.when(t.role == "assistant", t.content).otherwise(F.lit(""))


def _all_closed(t: Turn) -> Column:
    block = _text("<|", t.role, "|>\n", t.content, t.eos, "\n")
    return F.when(t.role.isin("user", "system", "assistant"), block).otherwise(F.lit(""))


def _after_thinking(content: Column) -> Column:
    return F.substring_index(content, "</think>", -1)


def _role_tags(assistant: Callable[[Turn], Column] = lambda t: t.content) -> Callable[[Turn], Column]:
    def piece(t: Turn) -> Column:
        newline = F.when(t.last, F.lit("")).otherwise(F.lit("\n"))
        return (
            F.when(t.role.isin("system", "user"), _text("<|", t.role, "|>\n", t.content, "\n"))
            .when(t.role == "assistant", _text("<|assistant|>\n", assistant(t), t.eos, newline))
            .otherwise(F.lit(""))
        )

    return piece


# Block marks and the note on missing functions.
NO_FUNCTIONS = " You do not currently have access to any functions. <functions></functions>"
HELPFUL = "You are a helpful AI assistant."
FUNCTION_CALLING = "You are a helpful function-calling AI assistant." + NO_FUNCTIONS


def _blocks(assistant: Callable[[Turn], Column] = lambda t: t.content) -> Callable[[Turn], Column]:
    def piece(t: Turn) -> Column:
        listed = _text("<functions>", t.functions, "</functions>")
        system = _text(t.content, F.coalesce(_text(" ", listed), F.lit(NO_FUNCTIONS)))
        user = _text(t.content, F.coalesce(_text("\n", listed), F.lit("")))
        calls = _text("<function_calls>", t.function_calls, "</function_calls>")
        reply = _text(F.coalesce(assistant(t), F.lit("")), F.coalesce(calls, F.lit("")))
        close = F.when(t.last, t.eos).otherwise(F.lit("<|im_end|>\n"))
        block = lambda role, body: _text(f"<|im_start|>{role}\n", body, "<|im_end|>\n")
        return (
            F.when(t.role == "system", block("system", system))
            .when(t.role == "user", block("user", user))
            .when(t.role == "assistant", _text("<|im_start|>assistant\n", reply, close))
            .when(t.role == "environment", block("environment", t.content))
            .otherwise(F.lit(""))
        )

    return piece


def _trim_earlier_thinking(t: Turn) -> Column:
    both = F.contains(t.content, F.lit("</think>")) & F.contains(t.content, F.lit("<think>"))
    cut = F.ltrim(_after_thinking(t.content), F.lit("\n"))
    return F.when(~t.last & both, cut).otherwise(t.content)


def _paragraphs(before: str = "", named: bool = False) -> Callable[[Turn], Column]:
    def piece(t: Turn) -> Column:
        gap = F.when(t.first, F.lit("")).otherwise(F.lit("\n\n"))
        speaker = _text(_capitalised(t.role), ": ") if named else F.lit("")
        return _text(gap, speaker, before, t.content, "\n")

    return piece


# Preambles and instructions.
DIALOGUE = (
    "A conversation between User and Assistant. "
    "The user asks a question, and the Assistant solves it. "
    "The assistant first thinks about the reasoning process in "
    "the mind and then provides the user with the answer. "
    "The reasoning process and answer are enclosed within <think> </think> "
    "and <answer> </answer> tags, respectively, "
    "i.e., <think> reasoning process here </think> "
    "<answer> answer here </answer>.\n\n"
)
DIALOGUE_COMPACT = (
    "A conversation between User and Assistant. "
    "The user asks a question, and the Assistant solves it. "
    "The assistant first thinks about the reasoning process in "
    "the mind and then provides the user with the answer."
    "The reasoning process and answer are enclosed within <think> </think> "
    "and <answer> </answer> tags, respectively, "
    "i.e., <think> reasoning process here </think>"
    "<answer> answer here </answer>.\n\n"
)
DIALOGUE_WITH_CODE = (
    "A conversation between User and Assistant. "
    "The User asks a question, and the Assistant solves it. "
    "The Assistant first thinks about the reasoning process in "
    "the mind and then provides the User with the answer. \n\n"
    "When given a question, the Assistant must conduct reasoning inside the <think> "
    "and </think> tags. During reasoning, the Assistant may write and execute python "
    "code using the <code> </code> tag, in order to solve the problem or verify the answer. "
    "Then the Assistant will get the stdout and stderr in the <output> and </output> tags. "
    "For example, the code could be\n<code>\nx, y = 1, 2\nresult = x + y\nprint(result)\n</code>\nor\n"
    "<code>\nimport sympy as sp\nfrom sympy import Symbol\nx = Symbol('x')\ny = Symbol('y')\n"
    "solution = sp.solve(x**2 + y**2 - 1, (x, y))\nprint(solution)\n</code>\n"
    "The Assistant will always `print` the result of the code execution in order to see it in the <output> tag. "
    "The Assistant may use the <code> </code> tag multiple times. "
    "When the Assistant is done reasoning, it should provide the answer inside the <answer> "
    "and </answer> tag.\n\n"
)
BOXED_REMINDER = (
    "You must put your answer inside <answer> </answer> tags, i.e., <answer> answer here </answer>. "
    "And your final answer will be extracted automatically by the \\boxed{} tag. This is the problem: "
)
STEPWISE = (
    "Solve the following problem step by step. The last line of your response should be the answer to the problem "
    "in form Answer: $Answer (without quotes) where $Answer is the answer to the problem.\n\n"
)
STEPWISE_CODE = (
    "Solve the following code problem step by step. The last part of your response should be the solution to the "
    "problem in form ```\npython\nCODE\n``` where CODE is the solution for the problem.\n\n"
)

_PLAIN_REPLY = "<|im_start|>assistant\n"
_THINKING_REPLY = "<|im_start|>assistant\n<think>"

TEMPLATES = {
    "simple_concat_with_space": Template(_joined(" ")),
    "simple_concat_with_new_line": Template(_joined("\n")),
    "simple_chat": Template(_joined("\n\n", named=True)),
    "assistant_message_only": Template(_assistant_only, additive=False),
    "closed_tags": Template(_all_closed, "<|assistant|>\n"),
    "role_tags": Template(_role_tags(), "<|assistant|>\n"),
    "role_tags_thinker": Template(_role_tags(), "<|assistant|>\n<think>"),
    "role_tags_thinker_preamble": Template(_role_tags(lambda t: _after_thinking(t.content)), "<|assistant|>\n<think>", DIALOGUE),
    "blocks": Template(_blocks(), _PLAIN_REPLY, default_system=FUNCTION_CALLING),
    "blocks_old": Template(_blocks(), _PLAIN_REPLY, default_system=FUNCTION_CALLING),
    "blocks_thinker": Template(_blocks(), _THINKING_REPLY, default_system=HELPFUL),
    "blocks_no_think": Template(_blocks(), _PLAIN_REPLY, default_system=HELPFUL),
    "blocks_thinker_trimmed": Template(_blocks(_trim_earlier_thinking), _THINKING_REPLY, default_system=HELPFUL),
    "blocks_no_think_sft": Template(_blocks(), _PLAIN_REPLY, default_system=HELPFUL),
    "stepwise": Template(_paragraphs(), '\nRemember to put your answer on its own line after "Answer:"', STEPWISE),
    "stepwise_code": Template(_paragraphs(), "\nRemember to put your solution inside the ```\npython\nCODE\n``` tags", STEPWISE_CODE),
    "dialogue": Template(_paragraphs(named=True), "Assistant:", DIALOGUE),
    "dialogue_think": Template(_paragraphs(named=True), "Assistant: <think>", DIALOGUE),
    "dialogue_think_boxed": Template(_paragraphs(BOXED_REMINDER, named=True), "Assistant: <think>", DIALOGUE),
    "dialogue_think_boxed_code": Template(_paragraphs(BOXED_REMINDER, named=True), "Assistant: <think>", DIALOGUE_WITH_CODE),
    "dialogue_compact": Template(_paragraphs(named=True), "Assistant:", DIALOGUE_COMPACT),
}

CORE_FIELDS = ("role", "content")


def resolve(template: str | Template, default_system: str | None = None) -> Template:
    """A template by name, with its default system text replaced when one is given."""
    found = TEMPLATES[template] if isinstance(template, str) else template
    return found if default_system is None else replace(found, default_system=default_system)


def piece(template: Template, m: Column, i: Column, last: Column, eos: str, generate: bool, fields=CORE_FIELDS) -> Column:
    """The text one message contributes."""
    field = lambda name: m[name] if name in fields else F.lit(None).cast("string")
    turn = Turn(
        role=m["role"],
        content=m["content"],
        first=i == 0,
        last=last,
        ends=last & F.lit(not generate),
        eos=F.lit(eos),
        functions=field("functions"),
        function_calls=field("function_calls"),
    )
    return template.piece(turn)


def header(template: Template, messages: Column) -> Column:
    """Preamble plus the default system block when no message has the system role."""
    if template.default_system is None:
        return F.lit(template.preamble)
    block = f"<|im_start|>system\n{template.default_system}<|im_end|>\n"
    has_system = F.exists(messages, lambda m: m["role"] == "system")
    return F.when(has_system, F.lit(template.preamble)).otherwise(F.lit(template.preamble + block))


def render(
    messages: str | Column,
    template: str | Template,
    eos: str = "</s>",
    add_generation_prompt: bool = False,
    bos: str = "",
    fields=CORE_FIELDS,
    default_system: str | None = None,
) -> Column:
    """The whole conversation as text."""
    chosen = resolve(template, default_system)

    def build(msgs: Column) -> Column:
        final = F.size(msgs) - 1
        pieces = F.transform(msgs, lambda m, i: piece(chosen, m, i, i == final, eos, add_generation_prompt, fields))
        suffix = F.lit(chosen.suffix if add_generation_prompt else "")
        suffix = F.when(F.size(msgs) > 0, suffix).otherwise(F.lit(""))
        return F.concat(F.lit(bos), header(chosen, msgs), F.array_join(pieces, ""), suffix)

    return let(messages, build)


def render_chat(df: DataFrame, template: str, messages: str = "messages", out: str = "text", **options) -> DataFrame:
    """D1 as a table operator; optional message fields are read when the schema has them."""
    element = df.schema[messages].dataType.elementType
    return df.withColumn(out, render(messages, template, fields=tuple(element.fieldNames()), **options))
