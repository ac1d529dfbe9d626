"""Cleaning of texts by configured rules, as column expressions; folds over paragraphs and rules run in Arrow batches."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
import warnings
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import expressions as X

MAX_SEQUENCE = 5
# What stands for the parts that a sample leaves out.
MIDDLE, END = "\n\n[...MIDDLE OF DOCUMENT...]\n\n", "\n\n[...END OF DOCUMENT...]\n\n"
LEAST_CONFIDENCE, MOST_REMOVED = 80, 3.0


@dataclass(frozen=True)
class CleanupRules:
    collapse_newlines: bool = True
    remove_zero_width_spaces: bool = True
    trim_trailing_whitespace: bool = True
    deduplicate_paragraphs: bool = False
    regex_removals: tuple[str, ...] = field(default=())


def remove_zero_width(text: Column) -> Column:
    return F.translate(text, X.ZERO_WIDTH, "")


def trim_lines(text: Column) -> Column:
    """Each line, split at ``\\n`` only, without whitespace at its end."""
    return F.regexp_replace(text, r"[\s\x{1c}-\x{1f}\x{85}\p{Z}&&[^\n]]+(?=\n|\z)", "")


def collapse_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def java_pattern(pattern: str) -> str | None:
    """A pattern for the JVM with line anchors, ``\\n`` as the only line end; null, with a warning, if it is none."""
    try:
        re.compile(pattern)
    except re.error as e:
        warnings.warn(f"pattern {pattern!r} is left out: {e}", stacklevel=3)
        return None
    return "(?md)" + re.sub(r"\(\?P<", "(?<", pattern)


def remove_patterns(text: Column, patterns: tuple[str, ...] | list[str]) -> Column:
    """Removes what the patterns match, one after the other; an invalid pattern is left out."""
    for p in patterns:
        if java := java_pattern(p):
            text = F.regexp_replace(text, java, "")
    return text


def fold_paragraphs(text: str | None) -> str | None:
    """Paragraphs without runs of up to five that repeat the run before, letter case aside. Null stays null."""
    if text is None:
        return None
    kept: list[str] = []
    low: list[str] = []
    for block in re.split(r"\n{2,}", text):
        if not (block := block.strip()):
            continue
        kept.append(block)
        low.append(block.lower())
        n = next((n for n in range(1, min(MAX_SEQUENCE, len(low) // 2) + 1) if low[-n:] == low[-2 * n : -n]), 0)
        if n:
            del kept[-n:], low[-n:]
    return "\n\n".join(kept)


@F.arrow_udf(StringType())
def folded_paragraphs(text: pa.Array) -> pa.Array:
    return pa.array([fold_paragraphs(t) for t in text.to_pylist()], pa.string())


def clean(text: Column, rules: CleanupRules = CleanupRules()) -> Column:
    """A text after all steps in their fixed order; empty and null texts stay as they are."""
    out = text
    if rules.remove_zero_width_spaces:
        out = remove_zero_width(out)
    if rules.trim_trailing_whitespace:
        out = trim_lines(out)
    out = remove_patterns(out, rules.regex_removals)
    if rules.collapse_newlines:
        out = collapse_newlines(out)
    if rules.deduplicate_paragraphs:
        out = folded_paragraphs(out)
    return F.when(text == "", text).otherwise(X.strip(out))


def sample(text: Column, whole: int = 15_000, part: int = 3_000) -> Column:
    """A short text whole, of a longer one its head, middle and tail with a line between them."""
    n = F.length(text)
    middle = F.substring(text, F.floor(n / 2).cast("int") - part // 2 + 1, F.lit(part))
    return F.when(n < whole, text).otherwise(F.concat(F.substring(text, 1, part), F.lit(MIDDLE), middle, F.lit(END), F.substring(text, -part, part)))


RULE = "struct<pattern:string,description:string,confidence:int>"


def answered_rules(answer: Column) -> Column:
    """ARRAY of (pattern, description, confidence) in a model's answer: JSON, with or without a fence around it; the first
    list of an object, or the object itself as the only rule. Null where the answer holds no such JSON; entries without a
    pattern are left out."""
    bare = F.regexp_replace(F.regexp_replace(X.strip(answer), r"\A```(?:json)?\s*", ""), r"\s*```\z", "")

    def rules(found: object) -> list[dict] | None:
        if isinstance(found, dict):
            found = next((v for v in found.values() if isinstance(v, list)), [found])
        if not isinstance(found, list):
            return None
        number = lambda x: int(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else None
        return [{"pattern": r["pattern"], "description": str(r.get("description") or ""), "confidence": number(r.get("confidence"))} for r in found if isinstance(r, dict) and isinstance(r.get("pattern"), str)]

    @F.arrow_udf(f"array<{RULE}>")
    def parse(answers: pa.Array) -> pa.Array:
        out: list = []
        for a in answers.to_pylist():
            try:
                out.append(rules(json.loads(a)) if a else None)
            except ValueError:
                out.append(None)
        return pa.array(out, pa.list_(pa.struct([("pattern", pa.string()), ("description", pa.string()), ("confidence", pa.int32())])))

    return parse(bare)


def propose_rules(df: DataFrame, key: str, text: str, ask: Callable[[str], str]) -> DataFrame:
    """(key, pattern, description, confidence) of the rules that a model proposes for each text, of which it is shown the
    sample. ``ask`` maps a text to an answer and runs in the executors; texts that are null or empty aren't asked about."""
    answers = F.arrow_udf(lambda texts: pa.array([ask(t) for t in texts.to_pylist()], pa.string()), StringType())
    asked = df.filter(F.col(text) != "").select(key, answers(sample(F.col(text))).alias("_a"))
    return asked.select(key, F.explode(answered_rules(F.col("_a"))).alias("r")).select(key, "r.*")


def apply_rules(df: DataFrame, key: str, text: str, rules: list[dict], most_removed: float = MOST_REMOVED, least_confidence: int = LEAST_CONFIDENCE) -> DataFrame:
    """(key, text, held): the text after all rules that are safe, and why the others are held for review.

    ``rules`` are (pattern, description, confidence) in order. A rule is held if its confidence is below the least, if
    its pattern is invalid, or if on this text it would remove more than ``most_removed`` percent of what is left; a
    rule that matches nothing does nothing. ``held`` has (pattern, reason, removed_chars). Null stays null.
    """
    kind = df.schema[key].dataType.simpleString()
    ready: list[tuple[str, re.Pattern | None, str]] = []
    for r in rules:
        try:
            p = re.compile(r["pattern"], re.MULTILINE)
            why = "" if (r.get("confidence") or 0) >= least_confidence else "Low confidence"
        except re.error as e:
            p, why = None, f"Invalid pattern: {e}"
        ready.append((r["pattern"], p, why))

    def run(batches):
        for b in batches:
            texts, held = [], []
            for t in b.column(1).to_pylist():
                notes = []
                for source, p, why in ready:
                    if why:
                        notes.append({"pattern": source, "reason": why, "removed_chars": 0})
                    elif t and p.search(t):
                        new = p.sub("", t)
                        share = (len(t) - len(new)) / len(t) * 100
                        if share > most_removed:
                            notes.append({"pattern": source, "reason": f"Blast radius too large ({share:.1f}%)", "removed_chars": len(t) - len(new)})
                        else:
                            t = new
                texts.append(t)
                held.append(notes)
            note = pa.struct([("pattern", pa.string()), ("reason", pa.string()), ("removed_chars", pa.int32())])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(held, pa.list_(note))], names=[key, "text", "held"])

    return df.select(key, F.col(text).alias("_t")).mapInArrow(run, f"`{key}` {kind}, text string, held array<struct<pattern:string,reason:string,removed_chars:int>>")
