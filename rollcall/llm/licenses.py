"""Licence scan: tags, notices and licence expressions of whole texts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases that are counted, and their labels: fixed values.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notice phrases with labels of their own.
NOTICES = {
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "cc0": "cc0",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "dedicated to the public domain": "public-domain",
    "the unlicense": "unlicense",
}
TAG = "spdx license identifier"

# How much a licence family restricts use, from 0 to 1; the longest matching beginning counts.
RESTRICTION = {
    "": 0.5, "0bsd": 0.05, "agpl": 0.8, "apache": 0.1, "bsd": 0.1, "cc-by": 0.2, "cc-by-nc": 0.7,
    "cc-by-nd": 0.8, "cc-by-sa": 0.5, "cc0": 0.0, "epl": 0.5, "gpl": 0.6, "isc": 0.1, "lgpl": 0.45, "mit": 0.1,
    "mpl": 0.4, "public-domain": 0.0, "reserved": 1.0, "unlicense": 0.0, "zlib": 0.1,
}
# An exception granted by "with" takes this share of the restriction away.
EXCEPTION = 0.25

SEPARATORS = re.compile(rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TAGGED = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)")
TOKEN = re.compile(r"[ \t]*([()]|[a-z0-9][a-z0-9.+:-]*)")
STRENGTH = {"or": 1, "and": 2, "with": 3}

COLUMNS = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, expressions array<string>"
)


def restriction(label: str) -> float:
    return RESTRICTION[max((x for x in RESTRICTION if label.startswith(x)), key=len)]


def evaluate(expression: str) -> tuple[frozenset[str], float, str] | None:
    """Labels, restriction and normal form of a licence expression, read by the shunting-yard way.

    ``and`` adds requirements (the larger restriction), ``or`` leaves a choice
    (the smaller), ``with`` grants an exception. Reading stops at the first
    text that cannot go on the expression; None if no expression is there.
    """
    values: list[tuple[frozenset[str], float, str]] = []
    operators: list[str] = []

    def reduce() -> None:
        op = operators.pop()
        right, left = values.pop(), values.pop()
        if op == "with":
            new = (left[0], left[1] * (1 - EXCEPTION))
        else:
            new = (left[0] | right[0], (max if op == "and" else min)(left[1], right[1]))
        values.append((*new, f"({left[2]} {op} {right[2]})"))

    at, wants_value, depth = 0, True, 0
    while found := TOKEN.match(expression, at):
        token = found[1]
        if wants_value:
            if token == "(":
                operators.append(token)
                depth += 1
            elif token == ")" or token in STRENGTH:
                break
            else:
                values.append((frozenset([token]), restriction(token), token))
                wants_value = False
        elif token in STRENGTH:
            while operators and operators[-1] != "(" and STRENGTH[operators[-1]] >= STRENGTH[token]:
                reduce()
            operators.append(token)
            wants_value = True
        elif token == ")" and depth:
            while operators[-1] != "(":
                reduce()
            operators.pop()
            depth -= 1
        else:
            break
        at = found.end()
    if wants_value or depth:
        # What is cut short counts as far as its names go, all of them required.
        labels = frozenset().union(*(v[0] for v in values)) if values else frozenset()
        return (labels, max(map(restriction, labels)), " and ".join(sorted(labels))) if labels else None
    while operators:
        reduce()
    return values[0]


@lru_cache(1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in {**BASE, **NOTICES, TAG: ""}:
        found.add_word(f" {phrase} ", (phrase, phrase.count(" ") + 1))
    found.make_automaton()
    return found


def scan_text(text: str) -> tuple:
    """All output columns but ``doc_id`` for one text."""
    raw = text.encode("utf-8", "replace")
    words = SEPARATORS.sub(b" ", b" " + raw.lower() + b" ").decode("latin-1")
    base: list[int] = []
    base_labels: set[str] = set()
    labels: set[str] = set()
    tagged = False
    spaces = seen = 0
    for last, (phrase, size) in automaton().iter(words):
        spaces += words.count(" ", seen, last + 1)
        seen = last + 1
        if phrase in BASE:
            base.append(spaces - 1 - size)
            base_labels.add(BASE[phrase])
        elif phrase == TAG:
            tagged = True
        else:
            labels.add(NOTICES[phrase])
    n_words = spaces + words.count(" ", seen) - 1
    labels |= base_labels
    score = max((restriction(x) for x in labels), default=0.0)
    expressions = []
    if tagged:
        for tag in TAGGED.finditer(text.lower()):
            if value := evaluate(tag[1]):
                labels |= value[0]
                score = max(score, value[1])
                expressions.append(value[2])
    return (
        n_words, len(base), min(base, default=None), max(base, default=None),
        ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, expressions,
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Licence findings of every document, one row per input row.

    Null and empty texts have no words and no findings: counts 0, empty label
    texts, score 0. ``score`` is the restriction of the strictest finding, from
    0 (none, or public domain) to 1 (all rights reserved); an expression counts
    by its value. Columns other than ``doc_id`` and ``text`` are left out.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64(), pa.list_(pa.string())]
        for batch in batches:
            rows = [scan_text(x.as_py() or "") for x in batch.column("text")]
            columns = [batch.column("doc_id"), *zip(*rows, strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [columns[0], *(pa.array(c, type=k) for c, k in zip(columns[1:], kinds[1:], strict=True))], names=names
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, COLUMNS)
