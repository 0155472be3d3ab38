"""Finding licence notices and tags by one automaton, and evaluating licence expressions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import text_or_empty

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# notice phrases in normal words and their labels
NOTICES = {
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "public domain": "public-domain",
    "apache license": "apache",
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu general public license": "gpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "isc license": "isc",
    "released into the public domain": "public-domain",
    "licensed under": "notice",
}
TAG = "spdx license identifier"
# licences that a tag's expression may choose freely; "with" an exception keeps the licence's standing
FREE = ("mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "cc0-1.0", "unlicense", "cc-by-4.0", "zlib", "bsl-1.0", "mpl-2.0")
#: what the evaluation of a tag's expression adds: free licences meet it, they do not, or it does not parse
FREE_TAG, BOUND_TAG, BAD_TAG = "tag-free", "tag-restricted", "tag-malformed"
# the share of doubt that each label leaves, others leave 0.2; licences that only restricted tags name leave BOUND_DOUBT
DOUBT = {"notice": 0.7, "reserved": 0.5, FREE_TAG: 0.5, BOUND_TAG: 0.8, BAD_TAG: 0.9}
BOUND_DOUBT = 0.7
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_EXPRESSION = re.compile(rb"spdx-license-identifier:[\x20\t]*([^\n]*)")
_TOKEN = re.compile(r"[()]|[a-z0-9.+-]+")
_NEXT = re.compile(r"[\x20\t]*([()]|[a-z0-9][a-z0-9.+:-]*)")
_COMMENT_END = re.compile(r"\*/|--+!?>")
_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def postfix(expression: str) -> list[str] | None:
    """The expression in postfix order by the shunting-yard rule; None if it is malformed."""
    out: list[str] = []
    held: list[str] = []
    operand = True  # whether an operand must come next
    for token in _TOKEN.findall(expression):
        if token == "(":
            if not operand:
                return None
            held.append(token)
        elif token == ")":
            if operand:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        elif token in PRECEDENCE:
            if operand:
                return None
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[token]:
                out.append(held.pop())
            held.append(token)
            operand = True
        else:
            if not operand:
                return None
            out.append(token)
            operand = False
    if operand or "(" in held:
        return None
    return out + held[::-1]


def leading_expression(said: str) -> str:
    """The start of a tag's line that can be read as an expression: up to a comment's end or a token that cannot follow."""
    said = _COMMENT_END.split(said, maxsplit=1)[0]
    end, operand, open_ = 0, True, 0
    while m := _NEXT.match(said, end):
        token = m[1]
        if operand:
            if token == ")" or token in PRECEDENCE:
                break
            open_ += token == "("
            operand = token == "("
        elif token in PRECEDENCE:
            operand = True
        elif token == ")" and open_:
            open_ -= 1
        else:
            break
        end = m.end()
    return said[:end].strip()


def evaluate(order: list[str], free=FREE) -> tuple[bool, list[str]]:
    """Whether a postfix expression can be met by free licences alone, and all licences that it names."""
    stack: list[tuple[bool, list[str]]] = []
    for token in order:
        if token in PRECEDENCE:
            (b, names_b), (a, names_a) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((a, names_a))
            else:
                stack.append((a or b if token == "or" else a and b, names_a + names_b))
        else:
            stack.append((token in free, [token]))
    return stack[0][0], sorted(set(stack[0][1]))


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE, TAG: "tag"}.items():
        found.add_word(f" {phrase} ", (len(phrase) + 2, phrase in BASE, label))
    found.make_automaton()
    return found


def scan(text: str | None, automaton) -> dict:
    raw = (text or "").encode()
    words = raw.translate(_TO_WORDS).split()
    # one byte is one character here, so places in the string are places in the bytes
    normal = b" ".join([b"", *words, b""])
    places, base, every = [], set(), set()
    tag, at, word = False, 0, 0  # ``word`` blanks lie before place ``at``: each is counted once
    for end, (size, is_base, label) in automaton.iter(normal.decode("latin-1")):
        if label == "tag":
            tag = True
            continue
        if is_base:
            start = end - size + 1
            word += normal.count(b" ", at, start) if start >= at else -normal.count(b" ", start, at)
            at = start
            places.append(word)
            base.add(label)
        every.add(label)
    expressions, bound = [], set()
    if tag:
        for m in _EXPRESSION.finditer(raw.translate(_LOWER)):
            said = leading_expression(m[1].decode(errors="replace"))
            order = postfix(said)
            ok, names = evaluate(order) if order else (False, [])
            expressions.append({"expression": said, "valid": order is not None, "free": ok, "licenses": names})
            (every if ok else bound).update(names)
            every.add(BAD_TAG if order is None else FREE_TAG if ok else BOUND_TAG)
    doubt = BOUND_DOUBT ** len(bound - every)
    for label in every:
        doubt *= DOUBT.get(label, 0.2)
    every |= bound
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(every)),
        "score": 1.0 - doubt,
        "expressions": expressions,
    }


def license_scan(docs: DataFrame) -> DataFrame:
    """Licence phrases and tags of every document.

    ``doc_id``, ``n_words``, ``n_base`` (all places of base phrases), ``first_word`` and ``last_word`` (their
    smallest and largest start; null without one), ``base_labels``, ``labels`` (with those of notices and of
    the licences that tags name, and ``tag-free``, ``tag-restricted`` or ``tag-malformed`` for what a tag's expression
    comes to; sorted, joined by commas), ``score`` (0 without a label, nearer to 1 the more labels agree; licences that
    only restricted or malformed tags name count less) and ``expressions`` (what each tag says up to the end of its
    comment or the first token that cannot follow, whether it parses and whether free licences meet it). Work grows
    with the text, however often a phrase stands in it. Null and empty texts have no word and score 0. Documents are scanned one by one, without a shuffle;
    repeated rows are scanned each; other columns are not read.
    """
    import pyarrow as pa

    expression = pa.struct([("expression", pa.string()), ("valid", pa.bool_()), ("free", pa.bool_()), ("licenses", pa.list_(pa.string()))])
    fields = [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("expressions", pa.list_(expression)),
    ]

    def run(batches):
        automaton = _automaton()
        for b in batches:
            found = [{"doc_id": i, **scan(t, automaton)} for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pylist(found, pa.schema(fields))

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
        " score double, expressions array<struct<expression:string,valid:boolean,free:boolean,licenses:array<string>>>",
    )
