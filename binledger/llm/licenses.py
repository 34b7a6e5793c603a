"""License scan: Aho-Corasick for tags and notice phrases, a shunting-yard parser for licence expressions.

A text is lower-cased (A-Z only) and cut into words of digits, letters and characters beyond ASCII; one Aho-Corasick
pass over the joined words finds every place of every phrase, whatever its length or overlap. Where a tag such as
``SPDX-License-Identifier:`` occurs, the longest expression that follows on its line is read, of any length: WITH binds
before AND, AND before OR, parentheses group. Identifiers have a strictness from 0 (public domain) to 1 (no rights given); AND takes the
strictest part, OR the loosest (the user may choose), WITH keeps that of the licence.

A document's score is the strictest of its findings, 0 without any.

Defined results: NULL and empty texts have no words, empty label strings and score 0; a tag that no expression
follows yields the label ``unparsed``; unknown identifiers are labels of their own with strictness 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binledger.llm.automaton import _free, _slices, _with
from binledger.llm.registry import query, table

#: Phrases whose places are counted, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further notice phrases.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "gnu general public license": "gnu-gpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl-1.0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "creative-commons",
    "dedicated to the public domain": "public-domain",
    "this is free and unencumbered software": "unlicense",
    "proprietary and confidential": "proprietary",
}
#: Tags in front of an expression, as words and as they stand in a text.
TAGS = {"spdx license identifier": "spdx-license-identifier:", "license expression": "license-expression:"}
#: From 0, nothing asked, to 1, nothing allowed; an identifier without its version counts where the full one is missing.
STRICTNESS = {
    "public-domain": 0.0, "unlicense": 0.0, "cc0": 0.0, "0bsd": 0.0, "mit": 0.1, "isc": 0.1, "bsd": 0.1, "bsl": 0.1,
    "zlib": 0.1, "apache": 0.15, "cc-by": 0.2, "creative-commons": 0.3, "mpl": 0.4, "epl": 0.4, "lgpl": 0.5,
    "cc-by-sa": 0.5, "gpl": 0.7, "gnu-gpl": 0.7, "agpl": 0.8, "cc-by-nc": 0.8, "cc-by-nc-sa": 0.8, "cc-by-nd": 0.85,
    "cc-by-nc-nd": 0.9, "reserved": 1.0, "proprietary": 1.0,
}
UNKNOWN = 0.5

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_PART = re.compile(r"[^\S\r\n]*([()]|(?:(?!-->)[A-Za-z0-9.+:\-])+)")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def strictness(identifier: str) -> float:
    name = identifier
    while name:
        if name in STRICTNESS:
            return STRICTNESS[name]
        name = name.rpartition("-")[0]
    return UNKNOWN


def prefix(text: str, at: int = 0) -> tuple[list[str] | None, int]:
    """The longest expression that begins at ``at`` in reverse Polish order, lower case, and its end; None where none does.

    It never goes beyond a line, a comment end or a full stop behind a word.
    """
    parts: list[str] = []
    whole, end = 0, at  # parts of the longest expression so far, and where it ends
    depth, operand = 0, True  # operand: an identifier or "(" must follow
    while match := _PART.match(text, at):
        part = match[1].lower()
        at = match.end()
        name = part.rstrip(".") if part not in "()" else part
        if name in _PRECEDENCE or part == ")":
            if operand or part == ")" and not depth:
                break
            depth -= part == ")"
            operand = part != ")"
        elif not operand or not name:
            break
        elif part == "(":
            depth += 1
        else:
            operand = False
        parts.append(name)
        if not operand and not depth:
            whole, end = len(parts), at - (len(part) - len(name))
        if name != part:
            break
    return (_polish(parts[:whole]) if whole else None), end


def _polish(parts: list[str]) -> list[str]:
    out: list[str] = []
    waiting: list[str] = []
    for part in parts:
        if part in _PRECEDENCE:
            while waiting and waiting[-1] != "(" and _PRECEDENCE[waiting[-1]] >= _PRECEDENCE[part]:
                out.append(waiting.pop())
            waiting.append(part)
        elif part == "(":
            waiting.append(part)
        elif part == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        else:
            out.append(part)
    return out + waiting[::-1]


def parse(text: str) -> list[str] | None:
    """An expression in reverse Polish order, lower case; None where the text is not one as a whole."""
    rpn, end = prefix(text)
    return None if text[end:].strip() else rpn


def evaluate(rpn: list[str]) -> tuple[float, list[str]]:
    """Strictness of a parsed expression, and the licences in it (what follows WITH is no licence)."""
    names: list[str] = []
    stack: list[tuple[float, int]] = []  # strictness, and where its licences begin among the names
    for part in rpn:
        if part not in _PRECEDENCE:
            stack.append((strictness(part), len(names)))
            names.append(part)
            continue
        (right, at), (left, start) = stack.pop(), stack.pop()
        if part == "with":
            del names[at:]
            stack.append((left, start))
        else:
            stack.append(((max if part == "and" else min)(left, right), start))
    return stack[0][0], names


def expressions(text: str, tag: str) -> list[tuple[str, list[str] | None]]:
    """The expression behind each ``tag`` as it stands and parsed; where none is, the rest of the line and None."""
    out = []
    tags = list(re.finditer(re.escape(tag) + r"[ \t\"';,]*", text, re.IGNORECASE | re.ASCII))
    for match, after in zip(tags, [*tags[1:], None], strict=True):
        rpn, end = prefix(text, match.end())
        line = text[match.end() : end]
        if rpn is None:  # up to the next tag
            line = re.match(r"[^\r\n]*", text[match.end() : after.start() if after else len(text)])[0]
            line = re.sub(r"(\*/|-->|\*\)|#\}).*$", "", line).strip().strip("\"';,").rstrip(".")
        out.append((line.strip(), rpn))
    return out


@lru_cache(1)
def _machine():
    import ahocorasick

    machine = ahocorasick.Automaton()
    for phrase in {**BASE, **NOTICES, **TAGS}:
        machine.add_word(f" {phrase} ", phrase)
    machine.make_automaton()
    return machine


def scan(data: bytes) -> dict:
    """Findings of one text, given in UTF-8."""
    words = _WORD.findall(data.lower())  # bytes.lower() touches A-Z only
    joined = " " + b" ".join(words).decode("latin-1") + " "
    n_base, first, last, base, labels, strict = 0, None, None, set(), set(), []
    seen = word = 0  # spaces up to and with position ``seen``
    tags = set()
    for end, phrase in _machine().iter(joined):
        if phrase in TAGS:
            tags.add(TAGS[phrase])
            continue
        label = BASE.get(phrase) or NOTICES[phrase]
        labels.add(label)
        strict.append(strictness(label))
        if phrase in BASE:
            # the machine reports by end, starts may go back a little; each character is counted once or twice
            start = end - len(phrase) - 1
            word += joined.count(" ", seen, start + 1) if start + 1 >= seen else -joined.count(" ", start + 1, seen)
            seen = start + 1
            n_base += 1
            base.add(label)
            first = word - 1 if first is None else min(first, word - 1)
            last = word - 1 if last is None else max(last, word - 1)
    found = []
    if tags:
        text = data.decode("utf-8", "replace")
        for tag in sorted(tags):
            for line, rpn in expressions(text, tag):
                value, names = evaluate(rpn) if rpn else (UNKNOWN, ["unparsed"])
                found.append(line)
                labels.update(names)
                strict.append(value)
    return {
        "n_words": len(words), "n_base": n_base, "first_word": first, "last_word": last,
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "expressions": found,
        "score": max(strict, default=0.0),
    }


_SCHEMA = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("expressions", T.ArrayType(T.StringType())), T.StructField("score", T.DoubleType()),
])
_ARROW = pa.schema([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("expressions", pa.list_(pa.string())),
    ("score", pa.float64()),
])


def license_scan(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the findings of ``text``; columns that already bear their names are replaced."""
    df = _free(df, *_SCHEMA.names)
    schema = T.StructType([*df.schema.fields, *_SCHEMA.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            column = pc.cast(batch.column(batch.schema.get_field_index(text)), pa.binary())
            found = pa.RecordBatch.from_pylist([scan(x or b"") for x in column.to_pylist()], schema=_ARROW)
            yield _with(batch, **dict(zip(found.schema.names, found.columns, strict=True)))

    return df.mapInArrow(run, schema)


@query("op7_license_scan")
def op7(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return license_scan(docs).select("doc_id", *[c for c in _SCHEMA.names if c != "expressions"],
                                     F.array_join("expressions", "; ").alias("expressions"))
