"""Licence scans: notice phrases and identifier tags by Aho-Corasick, expressions evaluated.

A text's ASCII letters are made lower-case and its words taken; a phrase is found where
its words stand one after the other. One pass of an automaton over the words finds all
phrases and the tag of licence identifiers. The expression after a tag is put in postfix
order by a shunting yard (WITH binds closest, then AND, then OR) and evaluated: OR gives
the freer choice, AND the stricter sum, WITH an exception that eases copyleft.

Null and empty texts have no words and no labels. Repeated rows each give a row. A tag
whose expression is no expression gives no identifiers. An empty table gives no rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from talktally.llm.frames import id_and_text

# Phrases and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Phrases, labels, and how surely a text with the phrase is under that licence.
NOTICES = {
    "apache license": ("apache", 0.9),
    "mit license": ("mit", 0.9),
    "bsd license": ("bsd", 0.9),
    "isc license": ("isc", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "lesser general public license": ("lgpl", 0.9),
    "affero general public license": ("agpl", 0.9),
    "creative commons": ("cc", 0.6),
    "cc by nc": ("cc-by-nc", 0.9),
    "cc by sa": ("cc-by-sa", 0.9),
    "cc by nd": ("cc-by-nd", 0.9),
    "cc0": ("cc0", 0.9),
    "public domain": ("public-domain", 0.5),
    "licensed under": ("notice", 0.4),
    "permission is hereby granted": ("notice", 0.7),
}
BASE_WEIGHT = 0.8
TAG, TAG_WEIGHT = "spdx license identifier", 0.95

# How much a licence asks of those who pass the work on, by how its identifier begins.
FREE, WEAK_COPYLEFT, COPYLEFT, CLOSED = 0, 1, 2, 3
STRICTNESS = {
    "mit": FREE, "isc": FREE, "bsd": FREE, "apache": FREE, "0bsd": FREE, "zlib": FREE,
    "unlicense": FREE, "cc0": FREE, "cc-by-4": FREE, "cc-by-3": FREE, "wtfpl": FREE,
    "lgpl": WEAK_COPYLEFT, "mpl": WEAK_COPYLEFT, "epl": WEAK_COPYLEFT, "cddl": WEAK_COPYLEFT,
    "gpl": COPYLEFT, "agpl": COPYLEFT, "cc-by-sa": COPYLEFT,
    "cc-by-nc": CLOSED, "cc-by-nd": CLOSED, "licenseref": CLOSED,
}

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_TAGGED = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE | re.ASCII)
_TERM = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_BINDING = {"or": 1, "and": 2, "with": 3}

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, strictness int"
)


def postfix(expression: str) -> list[str]:
    """The longest beginning that is an expression, in postfix order; empty if there is none."""
    out: list[str] = []
    waiting: list[str] = []
    best: list[str] = []
    operand_next, at = True, 0
    while term := _TERM.match(expression, at):
        at, word = term.end(), term[1].lower()
        if word == "(" and operand_next:
            waiting.append(word)
        elif word == ")" and not operand_next and "(" in waiting:
            while (last := waiting.pop()) != "(":
                out.append(last)
        elif word in _BINDING and not operand_next:
            while waiting and _BINDING.get(waiting[-1], 0) >= _BINDING[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand_next = True
        elif word not in _BINDING and word not in "()" and operand_next:
            out.append(word)
            operand_next = False
        else:
            break
        if not operand_next and "(" not in waiting:
            best = out + waiting[::-1]
    return best


def strictness(identifier: str) -> int:
    known = [k for k in STRICTNESS if identifier.startswith(k)]
    return STRICTNESS[max(known, key=len)] if known else CLOSED


def evaluated(terms: list[str]) -> int:
    """The strictness of an expression in postfix order."""
    stack: list[int] = []
    for at, term in enumerate(terms):
        if term == "with":
            stack.pop()
            stack[-1] = WEAK_COPYLEFT if stack[-1] == COPYLEFT else stack[-1]
        elif term in _BINDING:
            last = stack.pop()
            stack[-1] = (min if term == "or" else max)(stack[-1], last)
        else:
            stack.append(strictness(term))
    return stack[0]


def identifiers(terms: list[str]) -> list[str]:
    """The licences of an expression in postfix order, without exceptions."""
    exceptions = {at - 1 for at, term in enumerate(terms) if term == "with"}
    return [t for at, t in enumerate(terms) if t not in _BINDING and at not in exceptions]


@dataclass
class Scan:
    n_words: int = 0
    n_base: int = 0
    first_word: int | None = None
    last_word: int | None = None
    base_labels: str = ""
    labels: str = ""
    score: float = 0.0
    strictness: int | None = None


class Scanner:
    """Finds phrases; base ones are counted and placed, all give labels."""

    def __init__(self, base: dict[str, str], notices: dict[str, tuple[str, float]]):
        self._found = ahocorasick.Automaton()
        phrases: dict[str, list[tuple[str, float, bool]]] = {}
        for phrase, label in base.items():
            phrases.setdefault(phrase, []).append((label, BASE_WEIGHT, True))
        for phrase, (label, weight) in notices.items():
            phrases.setdefault(phrase, []).append((label, weight, False))
        phrases.setdefault(TAG, []).append(("", 0.0, False))
        for phrase, meanings in phrases.items():
            self._found.add_word(f" {phrase} ", (len(phrase) + 2, meanings))
        self._found.make_automaton()

    def __call__(self, text: str) -> Scan:
        words = text.encode("utf-8").translate(_WORD_BYTES).split()
        # Phrases are ASCII, so each byte may stand for itself.
        line = f" {b' '.join(words).decode('latin-1')} "
        scan, weights, base, places, tagged = Scan(len(words)), {}, set(), [], False
        for end, (size, meanings) in self._found.iter(line):
            for label, weight, is_base in meanings:
                if not label:
                    tagged = True
                    continue
                weights[label] = max(weights.get(label, 0.0), weight)
                if is_base:
                    base.add(label)
                    places.append(end + 1 - size)
        if tagged:
            for expression in _TAGGED.findall(text):
                if terms := postfix(expression):
                    weights |= dict.fromkeys(identifiers(terms), TAG_WEIGHT)
                    scan.strictness = max(scan.strictness or FREE, evaluated(terms))
        scan.n_base = len(places)
        if places:
            scan.first_word = line.count(" ", 0, min(places))
            scan.last_word = line.count(" ", 0, max(places))
        scan.base_labels, scan.labels = ",".join(sorted(base)), ",".join(sorted(weights))
        doubt = 1.0
        for label in sorted(weights):
            doubt *= 1 - weights[label]
        scan.score = 1 - doubt
        return scan


def licence_scan(
    documents: DataFrame,
    base: dict[str, str] | None = None,
    notices: dict[str, tuple[str, float]] | None = None,
) -> DataFrame:
    """Words, places of base phrases, labels, score and strictness of each text."""
    base = BASE_PHRASES if base is None else base
    notices = NOTICES if notices is None else notices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices)
        for batch in batches:
            scans = [vars(scanner(text.as_py())) for text in batch.column(1)]
            rows = [{"doc_id": i.as_py()} | s for i, s in zip(batch.column(0), scans, strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return id_and_text(documents).mapInArrow(run, SCHEMA)


_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string())]
    + [("score", pa.float64()), ("strictness", pa.int32())]
)
