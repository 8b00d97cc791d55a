"""License scans: an Aho-Corasick pass over words, and licence expressions by shunting-yard.

One automaton over word numbers finds fixed phrases, notices and identifier tags in one pass over a text.
Words are runs of 0-9, a-z (A-Z count as these) and anything beyond ASCII, so that punctuation and line
ends between the words of a phrase don't matter. Behind a tag (`SPDX-License-Identifier:`, `license =`)
an expression is read from the text itself: identifiers, `and`, `or`, `with` and brackets, put into
postfix order by a shunting-yard parser and evaluated. An expression's licences are all it names; its
terms are the lightest of what `or` offers, the heaviest of what `and` joins, and one step lighter
behind `with` an exception from a copyleft licence.

Texts are read in blocks that end between words, each with the last words of the block before, so that
memory follows the longest text and not the number of its words.

Defined results: null and empty texts have no words and nothing found; repeated rows are documents of
their own; overlapping places all count; an expression ends where the grammar can't go on, and one that
ends in an operator or an open bracket is read without it and marked as not whole; unknown identifiers
give no label. Of other columns only doc_id is carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.ship import ship

# The phrases to count, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# What notices say, as words, with labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "licensed under the bsd": "bsd",
    "permission to use copy modify and or distribute this software": "isc",
    "isc license": "isc",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu gpl": "gpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nd": "cc-by-nd",
    "cc0 1 0": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "reserved",
}
TAGS = ("spdx license identifier", "license expression", "license", "licence", "licenses", "license type")

PUBLIC, PERMISSIVE, WEAK, STRONG, NETWORK, RESTRICTED = range(6)
TERMS = ("public", "permissive", "weak copyleft", "copyleft", "network copyleft", "restricted")
# Families of identifiers, the terms of each. An identifier belongs to the longest that starts it.
FAMILIES = {
    "unlicense": PUBLIC, "cc0": PUBLIC, "0bsd": PUBLIC, "public-domain": PUBLIC,
    "mit": PERMISSIVE, "apache": PERMISSIVE, "bsd": PERMISSIVE, "isc": PERMISSIVE, "zlib": PERMISSIVE,
    "bsl": PERMISSIVE, "cc-by": PERMISSIVE, "python": PERMISSIVE, "psf": PERMISSIVE, "artistic": PERMISSIVE,
    "lgpl": WEAK, "mpl": WEAK, "epl": WEAK, "cddl": WEAK,
    "gpl": STRONG, "cc-by-sa": STRONG, "eupl": STRONG,
    "agpl": NETWORK,
    "cc-by-nc": RESTRICTED, "cc-by-nd": RESTRICTED, "cc-by-nc-sa": RESTRICTED, "cc-by-nc-nd": RESTRICTED,
    "busl": RESTRICTED, "sspl": RESTRICTED, "reserved": RESTRICTED,
}
#: How sure each kind of evidence makes that a text states a licence; kinds count once, as if independent.
SURE = {"phrase": 0.8, "notice": 0.85, "expression": 0.95, "fragment": 0.5}

BLOCK = 1 << 20
OPERATORS = {"or": 1, "and": 2, "with": 3}

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SOLID = np.array([_FOLD[c] != 32 for c in range(256)])
_SIGN = re.compile(rb"""["'\]]?[ \t]*[:=]""")
_TOKEN = re.compile(rb"""[ \t"'\[,]*([()]|[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?)""")


def family(identifier: str) -> str | None:
    """The family of an identifier such as GPL-2.0-or-later, or none."""
    name = identifier.lower().rstrip("+")
    parts = name.split("-")
    for k in range(len(parts), 0, -1):
        head = "-".join(parts[:k])
        if head in FAMILIES:
            return head
    return None


def is_exception(identifier: str) -> bool:
    return identifier.lower().split("-")[-1] in ("exception", "note") or "-exception-" in f"{identifier.lower()}-"


def postfix(tokens: Iterator[str]) -> tuple[list[str], bool]:
    """Shunting-yard over as many tokens as the grammar takes: postfix order, and whether all was whole."""
    out: list[str] = []
    waiting: list[str] = []
    operand_next, whole = True, True
    for token in tokens:
        low = token.lower()
        if low in OPERATORS:
            if operand_next:
                whole = False
                break
            while waiting and waiting[-1] != "(" and OPERATORS[waiting[-1]] >= OPERATORS[low]:
                out.append(waiting.pop())
            waiting.append(low)
            operand_next = True
        elif token == "(":
            if not operand_next:
                break
            waiting.append("(")
        elif token == ")":
            if operand_next or "(" not in waiting:
                whole = whole and not operand_next
                break
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        else:
            if not operand_next:
                break
            out.append(token)
            operand_next = False
    if operand_next:  # an operator or a bracket without what belongs behind it
        whole = False
        while waiting:
            last = waiting.pop()
            if last != "(":
                break
    while waiting:
        last = waiting.pop()
        if last == "(":
            whole = False
        else:
            out.append(last)
    return out, whole


def evaluate(order: list[str]) -> tuple[frozenset[str], int | None]:
    """Labels and terms of an expression in postfix order; no terms where no licence is known."""
    stack: list[tuple[frozenset[str], int | None, bool]] = []
    for item in order:
        if item not in OPERATORS:
            name = family(item)
            stack.append((frozenset([name]) if name else frozenset(), None if name is None else FAMILIES[name], is_exception(item)))
            continue
        b, a = stack.pop(), stack.pop()
        if item == "with":
            terms = a[1] - 1 if b[2] and a[1] in (STRONG, NETWORK) else a[1]
            stack.append((a[0], terms, False))
            continue
        known = [x for x in (a[1], b[1]) if x is not None]
        stack.append((a[0] | b[0], (min if item == "or" else max)(known) if known else None, False))
    return (stack[-1][0], stack[-1][1]) if stack else (frozenset(), None)


def read_expression(data: bytes, at: int) -> tuple[str, bool, frozenset[str], int | None] | None:
    """The expression that starts at a byte of a text: itself, whole or not, labels and terms."""
    end = at

    def tokens() -> Iterator[str]:
        nonlocal end
        place = at
        while found := _TOKEN.match(data, place):
            yield found[1].decode()
            end = place = found.end()  # only what the grammar took moves the end

    order, whole = postfix(tokens())
    if not order:
        return None
    labels, terms = evaluate(order)
    return data[at:end].decode("utf-8", "replace").strip(" \t\"'[,"), whole, labels, terms


@lru_cache(maxsize=1)
def _automaton() -> tuple[dict[bytes, int], ahocorasick.Automaton, int]:
    """Word numbers, the automaton over them, and the length of the longest phrase."""
    patterns: dict[tuple[str, ...], list[tuple[str, str]]] = {}
    for kind, entries in (("phrase", PHRASES), ("notice", NOTICES), ("tag", dict.fromkeys(TAGS, ""))):
        for words, label in entries.items():
            patterns.setdefault(tuple(words.split()), []).append((kind, label))
    numbers: dict[bytes, int] = {}
    machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for words, meanings in patterns.items():
        machine.add_word(tuple(numbers.setdefault(w.encode(), len(numbers) + 1) for w in words), (len(words), meanings))
    machine.make_automaton()
    return numbers, machine, max(map(len, patterns))


def _blocks(folded: bytes) -> Iterator[tuple[int, int]]:
    """Ranges of a text that end between words."""
    at = 0
    while at < len(folded):
        end = len(folded) if at + BLOCK >= len(folded) else folded.rfind(b" ", at, at + BLOCK) + 1
        if end <= at:
            end = folded.find(b" ", at + BLOCK) + 1 or len(folded)
        yield at, end
        at = end


def scan_text(data: bytes) -> dict:
    """What one text holds: n_words, `places` (word, label), `notices` (word, label), `expressions`."""
    numbers, machine, longest = _automaton()
    folded = data.translate(_FOLD)
    places, notices, expressions = [], [], []
    before, carried = 0, []  # words before the block's carried ones; numbers of those
    for at, end in _blocks(folded):
        own = [numbers.get(w, 0) for w in folded[at:end].split()]
        ids = carried + own
        starts = None
        for last, (size, meanings) in machine.iter(tuple(ids)):
            if last < len(carried):
                continue
            for kind, label in meanings:
                if kind == "phrase":
                    places.append((before + last - size + 1, label))
                elif kind == "notice":
                    notices.append((before + last - size + 1, label))
                else:
                    if starts is None:
                        solid = _SOLID[np.frombuffer(data, np.uint8, end - at, at)]
                        starts = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
                        ends = np.flatnonzero(solid & ~np.concatenate([solid[1:], [False]])) + 1
                    sign = _SIGN.match(data, at + int(ends[last - len(carried)]))
                    found = sign and read_expression(data, sign.end())
                    if found and found[2]:
                        expressions.append((before + last - size + 1, *found))
        keep = min(longest - 1, len(ids))
        before += len(ids) - keep
        carried = ids[len(ids) - keep :] if keep else []
    labels = {label for _, label in places + notices} | {x for e in expressions for x in e[3]}
    kinds = {"phrase": places, "notice": notices, "expression": [e for e in expressions if e[2]], "fragment": [e for e in expressions if not e[2]]}
    doubt = 1.0
    for kind, found in kinds.items():
        doubt *= 1 - SURE[kind] if found else 1.0
    heaviest = [FAMILIES[x] for x in {label for _, label in places + notices}] + [e[4] for e in expressions if e[4] is not None]
    return {
        "n_words": before + len(carried), "places": places, "notices": notices, "expressions": expressions,
        "labels": sorted(labels), "terms": TERMS[max(heaviest)] if heaviest else None, "score": 1 - doubt,
    }


_PLACE = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
_EXPRESSION = pa.list_(pa.struct([
    ("word", pa.int64()), ("expression", pa.string()), ("whole", pa.bool_()), ("labels", pa.list_(pa.string())), ("terms", pa.string()),
]))
SCHEMA = (
    "n_words bigint, places array<struct<word:bigint,label:string>>, notices array<struct<word:bigint,label:string>>, "
    "expressions array<struct<word:bigint,expression:string,whole:boolean,labels:array<string>,terms:string>>, "
    "labels array<string>, terms string, score double"
)


def scan(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """doc_id and what each whole text holds: places of the fixed phrases, notices, expressions behind
    tags, all labels, the terms of all that is stated together, and how sure it is that a licence is."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan_text(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in batch.column("data")]

            def pairs(name: str) -> pa.Array:
                return pa.array([[{"word": w, "label": label} for w, label in f[name]] for f in found], _PLACE)

            expressions = pa.array(
                [
                    [{"word": w, "expression": e, "whole": ok, "labels": sorted(of), "terms": None if t is None else TERMS[t]} for w, e, ok, of, t in f["expressions"]]
                    for f in found
                ],
                _EXPRESSION,
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([f["n_words"] for f in found], pa.int64()), pairs("places"), pairs("notices"), expressions,
                    pa.array([f["labels"] for f in found], pa.list_(pa.string())), pa.array([f["terms"] for f in found], pa.string()),
                    pa.array([f["score"] for f in found], pa.float64()),
                ],
                ["doc_id", "n_words", "places", "notices", "expressions", "labels", "terms", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text).cast("binary").alias("data")).mapInArrow(run, f"doc_id {kind}, {SCHEMA}")
