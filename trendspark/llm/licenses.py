"""License scans of whole texts (operator 9).

Method: an Aho-Corasick automaton over the words of a text finds the phrases of notices and the tag of license
identifiers; after a tag, the expression on its line is read by a shunting-yard parser (``WITH`` binds before ``AND``
before ``OR``) and evaluated to its labels and to whether the licenses allowed by the caller satisfy it. The same is
read after ``License:``. Operands are known identifiers or start with ``LicenseRef-``, after ``WITH`` an exception's
name; any other word ends the expression.

Words: runs of digits, letters a-z (A-Z in lower case) and characters beyond ASCII. ``n_base`` counts every place of a
base phrase, overlapping ones too. ``score`` is 1 for a readable expression, 0.9 for a base phrase, 0.6 for another
notice, 0.5 for a tag without a readable expression, else 0. Results: null counts as empty; an empty text has no words,
null positions and empty labels; other columns of the input are not read.
"""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import arrow_map, word_bytes

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notices that the method adds, and their labels.
NOTICES = {
    "all rights reserved": "proprietary",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl-1.0",
    "creative commons attribution": "cc-by",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "public domain dedication": "cc0",
    "released into the public domain": "public-domain",
    "mit license": "mit",
    "apache license": "apache-2",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "simplified bsd license": "bsd-2-clause",
    "new bsd license": "bsd-3-clause",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons zero": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "european union public licence": "eupl",
}
TAG = "spdx license identifier"
#: Words of a field that may hold an expression.
FIELDS = ("license", "licence")
#: Identifiers whose label differs from their lower-case text.
IDENTIFIERS = {"apache-2.0": "apache-2", "cc-by-nc-4.0": "cc-by-nc", "cc-by-nc-3.0": "cc-by-nc", "cc-by-4.0": "cc-by", "cc0-1.0": "cc0"}
#: Licenses that the caller accepts, unless told otherwise.
ALLOWED = frozenset({"mit", "apache-2", "bsd-2-clause", "bsd-3-clause", "bsd", "isc", "cc-by", "cc0", "unlicense", "public-domain"})

_TAG_LINE = re.compile(r"spdx[\W_]*license[\W_]*identifier[\W_]*?[:=]?[ \t]*([^\r\n]*)", re.I)
_FIELD_LINE = re.compile(r"(?<![\w-])licen[cs]e[ \t]*:[ \t]*([^\r\n]*)", re.I)
#: The identifiers that an expression may name, families with their versions as patterns.
KNOWN = re.compile(
    r"mit(-0|-cmu)?|apache-(1\.0|1\.1|2\.0)|bsd-[1-4]-clause(-clear|-patent|-uc)?|0bsd|isc|zlib|libpng(-2\.0)?|"
    r"(gpl|lgpl|agpl)-[1-3]\.[01](\+|-only|-or-later)?|gfdl-1\.[1-3](-only|-or-later)?|mpl-(1\.0|1\.1|2\.0)(-no-copyleft-exception)?|"
    r"epl-[12]\.0|eupl-1\.[0-2]|cddl-1\.[01]|cpl-1\.0|bsl-1\.0|busl-1\.1|sspl-1\.0|artistic-[12]\.0|afl-[123]\.[01]|osl-[123]\.[01]|"
    r"cc0-1\.0|cc-by(-nc)?(-sa|-nd)?-[1-4]\.[05]|cc-pddc|pddl-1\.0|odbl-1\.0|odc-by-1\.0|ofl-1\.[01]|unlicense|wtfpl|ncsa|postgresql|"
    r"psf-2\.0|python-2\.0|php-3\.0[01]?|ruby|vim|w3c|x11|curl|openssl|ms-pl|ms-rl|unicode-(dfs-201[56]|3\.0)|upl-1\.0|blueoak-1\.0\.0|"
    r"mulanpsl-[12]\.0|hpnd|ecl-[12]\.0|licenseref-[a-z0-9.-]+"
)
_EXCEPTION = re.compile(r"[a-z0-9.+-]*-exception(-[a-z0-9.]+)?|licenseref-[a-z0-9.-]+")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_BINDS = {"or": 1, "and": 2, "with": 3}


def to_postfix(expression: str) -> list[str] | None:
    """The longest readable start of an expression in postfix order, by the shunting-yard method; None without one."""
    out: list[str] = []
    held: list[str] = []
    best, wants_operand = None, True
    for token in _TOKEN.findall(expression):
        low = token.lower()
        if token == "(":
            if not wants_operand:
                break
            held.append("(")
        elif token == ")":
            if wants_operand or "(" not in held:
                break
            while (top := held.pop()) != "(":
                out.append(top)
        elif low in _BINDS:
            if wants_operand:
                break
            while held and held[-1] != "(" and _BINDS[held[-1]] >= _BINDS[low]:
                out.append(held.pop())
            held.append(low)
            wants_operand = True
            continue
        else:
            name = low.rstrip(".:-")
            if not wants_operand or not (_EXCEPTION if held and held[-1] == "with" else KNOWN).fullmatch(name):
                break
            out.append(name)
            wants_operand = False
        if not wants_operand and "(" not in held:
            best = out + held[::-1]
    return best


def evaluate(postfix: list[str], allowed: frozenset[str] = ALLOWED) -> tuple[set[str], bool]:
    """The labels that an expression names, and whether allowed licenses satisfy it."""
    stack: list[tuple[set[str], bool]] = []
    for token in postfix:
        if token not in _BINDS:
            label = IDENTIFIERS.get(token, token)
            stack.append(({label}, label in allowed))
            continue
        (b, b_ok), (a, a_ok) = stack.pop(), stack.pop()
        if token == "with":  # an exception adds permissions to a license and is none itself
            stack.append((a, a_ok))
        else:
            stack.append((a | b, (a_ok and b_ok) if token == "and" else (a_ok or b_ok)))
    return stack[0]


@cache
def automaton() -> ahocorasick.Automaton:
    """One automaton a Python worker, over words parted and surrounded by blanks."""
    found = ahocorasick.Automaton()
    for phrase, label in [*NOTICES.items(), *BASE.items(), (TAG, ""), *((w, "") for w in FIELDS)]:
        found.add_word(f" {phrase} ", (len(phrase) + 2, phrase, label))
    found.make_automaton()
    return found


def scan(text: str | None, allowed: frozenset[str] = ALLOWED) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, permitted) of a whole text."""
    joined = word_bytes(text).decode("latin-1")
    if not joined:
        return 0, 0, None, None, "", "", 0.0, None
    line = f" {joined} "
    starts, base, labels, score, permitted = [], set(), set(), 0.0, None
    tagged = field = False
    for end, (length, phrase, label) in automaton().iter(line):
        if phrase == TAG:
            tagged, score = True, max(score, 0.5)
        elif phrase in FIELDS:
            field = True
        elif phrase in BASE:
            starts.append(end - length + 1)
            base.add(label)
            score = max(score, 0.9)
        else:
            labels.add(label)
            score = max(score, 0.6)
    if tagged or field:
        for expression in [*(_TAG_LINE.findall(text) if tagged else ()), *_FIELD_LINE.findall(text)]:
            if postfix := to_postfix(expression):
                named, ok = evaluate(postfix, allowed)
                labels |= named
                score, permitted = 1.0, ok if permitted is None else permitted and ok
    first, last = ((line.count(" ", 0, p + 1) - 1 for p in (min(starts), max(starts))) if starts else (None, None))
    return joined.count(" ") + 1, len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), score, permitted


_COLUMNS = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "permitted": pa.bool_(),
}


def license_scan(docs: DataFrame, allowed: frozenset[str] = ALLOWED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and the columns of ``scan``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = zip(*(scan(t, allowed) for t in batch.column(1).to_pylist()), strict=True)
        arrays = [pa.array(x, t) for x, t in zip(found, _COLUMNS.values(), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *_COLUMNS])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, permitted boolean"
    return arrow_map(narrow, run, schema)
