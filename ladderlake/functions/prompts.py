"""Prompts from templates, and chats of them, as columns.

A template is text with {{ name }} or {{ name.field }} and {% if name %} ... {% endif %}; a prompts file of the user's maps keys to
templates. Names are given as columns; one that isn't given is empty. A null or empty column is false in an `if`.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_PART = re.compile(r"\{\{\s*([\w.]+)\s*\}\}|\{%\s*if\s+([\w.]+)\s*%\}|\{%\s*endif\s*%\}")
MESSAGE = "struct<role:string,content:string>"


def _value(name: str, given: dict[str, Column]) -> Column:
    base, _, field = name.partition(".")
    if base not in given:
        return F.lit("")
    c = given[base][field] if field else given[base]
    return c.cast("string")


def template(text: str, **given: Column) -> Column:
    """The text with its names filled in; a null value shows as None. One line end at the end of the template goes."""
    stack: list[tuple[str | None, list[Column]]] = [(None, [])]
    at = 0
    text = text.removesuffix("\n")
    for m in _PART.finditer(text):
        stack[-1][1].append(F.lit(text[at : m.start()]))
        at = m.end()
        if m[1]:
            stack[-1][1].append(F.coalesce(_value(m[1], given), F.lit("None")))
        elif m[2]:
            stack.append((m[2], []))
        else:
            name, parts = stack.pop()
            base = name.partition(".")[0]
            truth = given[base].isNotNull() & (F.coalesce(_value(name, given), F.lit("x")) != "") if base in given else F.lit(False)
            stack[-1][1].append(F.when(truth, F.concat(*parts)).otherwise(""))
    if len(stack) > 1:
        raise ValueError("a {% if %} without its {% endif %}")
    return F.concat(*stack[0][1], F.lit(text[at:]))


def render(prompts: dict[str, str], key: str, **given: Column) -> Column:
    """The template under this key, or the text that says it is missing."""
    return template(prompts[key], **given) if prompts.get(key) else F.lit(f"[Error: Prompt key '{key}' not found]")


def evolved(strategies: list[str], task: Column, draw: Column, share: float = 0.7) -> Column:
    """The task as it is, or rewritten by one of the strategies: draw, a number from 0 up to 1, decides by `share`, and its place below that chooses."""
    if not strategies:
        return task
    k = F.least(F.floor(draw / F.lit(share / len(strategies))), F.lit(len(strategies) - 1)).cast("int")
    how = F.element_at(F.array(*[template(s, task=task) for s in strategies]), k + 1)
    return F.when(draw >= share, task).otherwise(how)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat(prompts: dict[str, str], kind: str, **given: Column) -> Column:
    """Messages of a kind: generate (system text with an optional golden example, then the task), critique or brainstorm."""
    if kind == "generate":
        return F.array(message("system", render(prompts, "system_prompt", **{k: v for k, v in given.items() if k == "golden_example"})), message("user", render(prompts, "generation_template", task=given["task"])))
    return F.array(message("user", render(prompts, f"{kind}_template", **given)))


def with_feedback(messages: Column, code: Column, kind: Column, reason: Column) -> Column:
    """The chat with a failed reply and what is wrong with it; kind: Syntax or Logic."""
    asked = F.concat(kind, F.lit(" Error: "), reason, F.lit(". Fix it."))
    return F.concat(messages, F.array(message("assistant", code), message("user", asked)))
