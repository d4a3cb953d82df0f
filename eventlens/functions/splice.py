"""Replace regex matches by a value computed from each match.

Spark's ``regexp_replace`` only knows constant replacements.  Here every match
is enclosed in a mark, the text is cut at the marks, each match is mapped by an
expression, and the pieces are joined again.  That takes one regex search, with
a match or without.

The expressions are composed as SQL text: as Columns, each of their hundreds of
nodes would be a round trip to the JVM whenever a query is built.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points that Unicode reserves as "not a character": around a match, and between its branches.
MARK = "￿"
SEPARATOR = "\ufdd0"


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bind(value: str, name: str, body: str) -> str:
    """Evaluate ``value`` once and use it as ``name`` inside ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def apply(value: Column, name: str, body: str) -> Column:
    """The SQL ``body`` with ``name`` standing for a Column."""
    return F.call_function("transform", F.array(value), F.expr(f"{name} -> {body}"))[0]


def splice(
    text: str,
    pattern: str,
    replace: Callable[[str], str],
    accept: Callable[[str], str] | None = None,
    needs: str | None = None,
) -> str:
    """The variable ``text`` with the accepted matches replaced, and how many those are.

    Gives a struct of ``text`` and ``hits``.  ``needs`` is a plain string without
    which no match is possible.  The cut is at a constant character, because
    Spark compiles a regex given to ``split`` anew for every row.  A text that
    holds the mark itself takes that slow way.
    """
    regex, mark = literal(pattern), literal(MARK)
    pairs = f"zip_with(split({text}, {regex}, -1), regexp_extract_all({text}, {regex}, 0), (g, m) -> array_compact(array(g, m)))"
    # Gaps and matches in turn, a gap first.
    pieces = f"CASE WHEN contains({text}, {mark}) THEN flatten({pairs}) ELSE split(marked, {mark}, -1) END"
    chosen = "i % 2 = 1" if accept is None else f"i % 2 = 1 AND {accept('p')}"
    # NULL for whatever stays as it is.
    mapped = f"transform(pieces, (p, i) -> CASE WHEN {chosen} THEN {replace('p')} END)"
    joined = "array_join(zip_with(mapped, pieces, (n, p) -> coalesce(n, p)), '')"
    result = f"named_struct('text', {joined}, 'hits', size(array_compact(mapped)))"
    clean = f"named_struct('text', {text}, 'hits', 0)"
    replaced = bind(pieces, "pieces", bind(mapped, "mapped", result))
    # One search both finds out whether there is a match and marks all of them.
    marked = f"regexp_replace({text}, {regex}, {literal(MARK + '$0' + MARK)})"
    searched = bind(marked, "marked", f"CASE WHEN marked <> {text} THEN {replaced} ELSE {clean} END")
    return searched if needs is None else f"CASE WHEN contains({text}, {literal(needs)}) THEN {searched} ELSE {clean} END"


def stable_id(token: str) -> str:
    """Four digits that depend on the lower-cased token only.

    31-multiplier string hash in unsigned 32 bits, modulo 10,000.
    """
    digest = f"aggregate(split(lower({token}), ''), 0L, (h, c) -> (h * 31 + ascii(c)) & 4294967295)"
    return f"lpad(cast({digest} % 10000 AS string), 4, '0')"


def placeholder(kind: str, token: str) -> str:
    return f"concat('[{kind}_', {stable_id(token)}, ']')"
