"""Operator 7, licence scans: notice phrases and identifier tags by an
Aho-Corasick automaton, licence expressions by a shunting-yard parser.

A text becomes its words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text
with A-Z lower-cased) with one space around each. The automaton holds the
phrases and the identifier tag in that form, so each hit is a run of whole
words, and one pass over the text finds all of them, overlapping ones too. A
text with an identifier tag is looked up again in its raw form for what
follows the tag: the expression (``and``, ``or``, ``with``, parentheses,
``+``) is brought into postfix order by the shunting-yard algorithm and
evaluated to the ids that it requires (``and``) or offers (``or``).

The score is 1 - 0.5 ** evidence, where a base phrase or a valid expression
counts 2 and any other phrase 1.

Defined cases: null counts as empty; a text without a hit has empty labels,
null places and score 0; an expression that does not parse adds no label;
repeated rows get a row each; other columns are not read; texts of any
length are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.llm.common import bounded_batches

#: The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notice phrases of the method, in words, and their labels.
NOTICES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "creative commons": "cc",
    "cc by": "cc-by",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc0 1 0": "cc0",
    "isc license": "isc",
    "boost software license": "bsl",
    "the unlicense": "unlicense",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_EXPRESSION = re.compile(r"spdx-license-identifier:[ \t]*([a-z0-9.+\-() \t]*)", re.I | re.A)
_TOKEN = re.compile(r"[()]|[^\s()]+")
_POWER = {"or": 1, "and": 2, "with": 3}
_ID = re.compile(r"[a-z0-9][a-z0-9.\-]*\+?")


def postfix(expression: str) -> list[str]:
    """The expression's tokens in postfix order; ValueError when malformed."""
    out, held, value_next = [], [], True
    for token in _TOKEN.findall(expression.lower()):
        if token == "(":
            if not value_next:
                raise ValueError("an operator is missing")
            held.append(token)
        elif token == ")":
            if value_next:
                raise ValueError("a licence is missing")
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise ValueError("a parenthesis is missing")
            held.pop()
        elif token in _POWER:
            if value_next:
                raise ValueError("a licence is missing")
            while held and held[-1] != "(" and _POWER[held[-1]] >= _POWER[token]:
                out.append(held.pop())
            held.append(token)
            value_next = True
        else:
            if not value_next or not _ID.fullmatch(token):
                raise ValueError("not a licence expression")
            out.append(token)
            value_next = False
    if value_next:
        raise ValueError("a licence is missing")
    while held:
        if held[-1] == "(":
            raise ValueError("a parenthesis is missing")
        out.append(held.pop())
    return out


def evaluate(expression: str) -> tuple[frozenset, frozenset]:
    """(ids that hold in any case, ids that may be chosen)."""
    values: list[tuple[frozenset, frozenset]] = []
    for token in postfix(expression):
        if token not in _POWER:
            values.append((frozenset([token]), frozenset([token])))
            continue
        right, left = values.pop(), values.pop()
        if token == "with":  # an exception: the licence stays the licence
            (licence,), (exception,) = left[1], right[1]
            value = frozenset([f"{licence} with {exception}"])
            values.append((value, value))
        elif token == "and":
            values.append((left[0] | right[0], left[1] | right[1]))
        else:
            values.append((left[0] & right[0], left[1] | right[1]))
    return values[0]


def leading_expression(text: str) -> str | None:
    """The longest valid expression that the text begins with."""
    tokens, ends, depth, value_next = _TOKEN.findall(text), [], 0, True
    for n, token in enumerate(map(str.lower, tokens), 1):
        if token == "(" and value_next:
            depth += 1
        elif token == ")" and not value_next and depth:
            depth -= 1
        elif token in _POWER and not value_next:
            value_next = True
        elif token not in _POWER and value_next and _ID.fullmatch(token):
            value_next = False
        else:
            break
        if not value_next and not depth:
            ends.append(n)  # complete up to here
    for n in reversed(ends):
        candidate = " ".join(tokens[:n])
        try:
            evaluate(candidate)
        except ValueError:  # "with" between expressions
            continue
        return candidate
    return None


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    own: dict[str, list] = {}
    for phrase, label in BASE.items():
        own.setdefault(phrase, []).append(("base", label))
    for phrase, label in NOTICES.items():
        own.setdefault(phrase, []).append(("notice", label))
    own[TAG] = [("tag", "")]
    for phrase, meaning in own.items():
        found.add_word(f" {phrase} ", (len(phrase) + 2, meaning))
    found.make_automaton()
    return found


def scan(text: str, find: ahocorasick.Automaton) -> dict:
    """Words, base places, labels, expressions and score of a text."""
    words = text.encode("utf-8", "replace").translate(_FOLD).split(b" ")
    words = [w for w in words if w]
    line = " " + b" ".join(words).decode("utf-8", "replace") + " "
    places, base, labels, tagged, evidence = [], set(), set(), False, 0
    at, spaces = 0, 0
    for end, (length, meaning) in find.iter(line):
        start = end - length + 1
        for kind, label in meaning:
            if kind == "tag":
                tagged = True
                continue
            labels.add(label)
            evidence += 2 if kind == "base" else 1
            if kind == "base":
                if start >= at:
                    spaces += line.count(" ", at, start)
                else:
                    spaces -= line.count(" ", start, at)
                at = start
                places.append(spaces)
                base.add(label)
    expressions = []
    for match in _EXPRESSION.finditer(text) if tagged else ():
        expression = leading_expression(match[1])
        if expression is not None:
            expressions.append(expression)
            labels |= evaluate(expression)[1]
            evidence += 2
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(labels)),
        "expressions": expressions,
        "score": 1.0 - 0.5 ** min(evidence, 50),
    }


_FIELDS = {
    "n_words": pa.int64(),
    "n_base": pa.int64(),
    "first_word": pa.int64(),
    "last_word": pa.int64(),
    "base_labels": pa.string(),
    "labels": pa.string(),
    "expressions": pa.list_(pa.string()),
    "score": pa.float64(),
}
SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, expressions array<string>, score double"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    find = automaton()
    for batch in batches:
        found = [scan(t or "", find) for t in (x.as_py() for x in batch.column(1))]
        columns = [pa.array([f[name] for f in found], kind) for name, kind in _FIELDS.items()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *_FIELDS])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col and the fields of ``scan``."""
    rows = bounded_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_scan, f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions"
    )
