"""Prompt rendering, completion parsing and the completion-only loss mask
(G12-G14, R4).  All Column functions; tokenization is an input column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The reference's prompt template and response marker.
PROMPT_HEAD = ("<|system|>: 你是一个根据输入文本判断是否为恶意/风险的助手。输出严格为 0 或 1。\n"
               "<|user|>: 文本：")
PROMPT_TAIL = "\n请只输出 0 或 1（1=恶意/阳性；0=正常/阴性）。\n<|assistant|>: "
RESPONSE_MARKER = "<|assistant|>:"
DEFAULT_PREDICTION = "0"
IGNORE_INDEX = -100
# ---------------------------------------------------------------------------


def build_prompt(text: Column, label: Column | None = None) -> Column:
    """The prompt; with ``label`` the training form (label text appended, trimmed).

    Null text renders as "nan", as the reference's string formatting does.
    """
    body = F.concat(F.lit(PROMPT_HEAD), F.coalesce(text.cast("string"), F.lit("nan")), F.lit(PROMPT_TAIL))
    if label is None:
        return body
    return F.concat(body, F.regexp_replace(label.cast("string"), r"(?U)^\s+|\s+$", ""))


def completion(generated: Column) -> Column:
    """The text after the last response marker (all of it when absent)."""
    return F.substring_index(generated, RESPONSE_MARKER, -1)


def first_digit01(s: Column) -> Column:
    """The first '0' or '1' character, else "0"."""
    return F.coalesce(F.nullif(F.regexp_extract(s, "[01]", 0), F.lit("")), F.lit(DEFAULT_PREDICTION))


def prediction(generated: Column) -> Column:
    """G13 + G14."""
    return first_digit01(completion(generated))


def char_ids(text: Column) -> Column:
    """A stand-in tokenizer for tests and fixtures: one id per character (code point)."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.ascii(c))


def template_start(ids: Column, templ: Column) -> Column:
    """1-based start of the LAST occurrence of ``templ`` in ``ids``, else null.

    One search from the end over the ids' text, so work is linear in the row."""
    def marked(a: Column) -> Column:
        return F.concat(F.lit(","), F.array_join(a, ",", "n"), F.lit(","))

    text, n, t = marked(ids), F.size(ids), F.size(templ)
    behind = F.call_function("substring_index", text, marked(templ), F.lit(-1))
    # each token behind the template ends in a comma; without an occurrence nothing is cut off
    after = F.length(behind) - F.length(F.replace(behind, F.lit(",")))
    return F.when((t > 0) & (n >= t) & (F.length(behind) < F.length(text)), n - after - t + 1)


def completion_mask(ids: Column, start: Column, attention: Column | None = None) -> Column:
    """Loss labels from token ids and the template start (a column, see
    ``with_completion_mask``).  Positions before the last template start are
    IGNORE_INDEX; the whole row when the template is absent; padding too.
    The template tokens themselves keep their loss, as in the reference."""
    ign = F.lit(IGNORE_INDEX)
    labels = F.transform(ids, lambda x, j: F.when(start.isNull() | (j + 1 < start), ign).otherwise(x))
    if attention is not None:
        labels = F.transform(labels, lambda x, j: F.when(F.element_at(attention, j + 1) == 0, ign)
                             .otherwise(x))
    return labels


def with_completion_mask(df, ids_col: str, templ: Column, attention_col: str | None = None,
                         max_length: int | None = None, out: str = "labels"):
    """Add ``template_start`` and ``labels`` (R4).  The start is computed once
    per row as its own column, so the mask stays linear in the row length."""
    ids = F.col(ids_col)
    att = F.col(attention_col) if attention_col else None
    if max_length:
        df = df.withColumn(ids_col, F.slice(ids, 1, max_length))
        if att is not None:
            df = df.withColumn(attention_col, F.slice(att, 1, max_length))
    df = df.withColumn("template_start", template_start(F.col(ids_col), templ))
    return df.withColumn(out, completion_mask(F.col(ids_col), F.col("template_start"), att))
