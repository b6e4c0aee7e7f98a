"""Script texts: comments, blocks, hashes and placeholders. All work on whole texts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Block delimiter and comment marks of the SQL dialect, and the placeholder form.
BLOCK_DELIMITER = "GO"
COMMENT_START = "/*"
COMMENT_END = "*/"
PLACEHOLDER = r"\{CFG:([A-Za-z0-9_]+)\}"


# What a script is made of; deeper comments count on from COMMENT. A state of the lexer is one of
# these, times three, plus 1 or 2 if the last character may be the first one of a mark: of a comment's
# start (1), of its end or of a line comment (2).
_CODE, _LITERAL, _QUOTED, _NAME, _LINE, _COMMENT = range(6)
# Marks that open and close literals, names and line comments.
_OPENING = {"'": _LITERAL, '"': _QUOTED, "[": _NAME}
_CLOSING = {_LITERAL: "'", _QUOTED: '"', _NAME: "]", _LINE: "\n"}
_LINE_COMMENT = "--"
_DOUBLED = "]]"  # the bracket itself inside a name; a doubled quote closes and opens again

# Tokens whose states are found one after the other; larger scripts go on chunk by chunk.
_CHUNK = 64

# A line break that is no end of a line of code, until the blocks are cut.
_GUARD, _GUARDED_BREAK, _GUARDED_GUARD = "\u0001", "\u0001\u0003", "\u0001\u0002"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often ``then`` names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _marks(start: str, end: str) -> str:
    """The characters that marks are made of."""
    if len(start) != 2 or len(end) != 2:
        raise ValueError("marks of comments have two characters")
    return "".join(dict.fromkeys([*start, *end, *_LINE_COMMENT, *_OPENING, *_CLOSING.values()]))


def _tokens(text: Column, marks: str) -> Column:
    """The text cut into single characters of marks, and what is between them."""
    chars = re.escape(marks)
    return F.regexp_extract_all(text, F.lit(f"{re.escape(_DOUBLED)}|[{chars}]|[^{chars}]++"), F.lit(0))


def _after(state: int, char: str, start: str, end: str) -> int:
    """The state of the lexer after a character, or after other text if it is empty."""
    part, pending = divmod(state, 3)
    if part == _CODE:
        if pending == 1 and char == start[1]:
            return 3 * _COMMENT
        if pending == 2 and char == _LINE_COMMENT[1]:
            return 3 * _LINE
        if char and char == start[0]:
            return 1
        return 2 if char == _LINE_COMMENT[0] else 3 * _OPENING.get(char, _CODE)
    if part >= _COMMENT:
        if pending == 1 and char == start[1]:
            return 3 * (part + 1)
        if pending == 2 and char == end[1]:
            return 3 * (part - 1) if part > _COMMENT else 3 * _CODE
        return 3 * part + (1 if char == start[0] else 2 if char == end[0] else 0)
    return 3 * _CODE if char == _CLOSING[part] else state


def _step(start: str, end: str, marks: str) -> Callable[[Column, Column], Column]:
    """The state after a token by a table of changes; in deeper comments they are those in the second."""
    deepest = 3 * (_COMMENT + 1)
    changes = [_after(s, c, start, end) - s for s in range(deepest + 3) for c in ["", *marks]]
    table = F.array(*map(F.lit, changes))

    def step(state: Column, kind: Column) -> Column:
        row = F.when(state < deepest, state).otherwise(state % 3 + deepest)
        return state + F.get(table, row * (len(marks) + 1) + kind)

    return step


def _states(tokens: Column, start: str, end: str, marks: str) -> Column:
    """The state before each token, and that after the last one: in one pass from left to right.

    States at the starts of chunks come first, so that no list grows with a whole script.
    """
    step = _step(start, end, marks)
    last = lambda states: F.element_at(states, -1)
    n_chunks = F.ceil(F.size(tokens) / _CHUNK).cast("int")
    # The place of the character among the marks, 0 for other text.
    kinds = F.transform(tokens, lambda t: F.instr(F.lit(marks), t))
    chunks = _let(
        kinds,
        lambda k: F.transform(
            F.sequence(F.lit(1), n_chunks), lambda c: F.slice(k, (c - 1) * _CHUNK + 1, F.lit(_CHUNK))
        ),
    )

    def of(chunked: Column) -> Column:
        starts = F.aggregate(
            chunked,
            F.array(F.lit(3 * _CODE)),
            lambda acc, chunk: F.concat(acc, F.array(F.aggregate(chunk, last(acc), step))),
        )

        def inner(chunk: Column, state: Column) -> Column:
            whole = F.aggregate(chunk, F.array(state), lambda acc, k: F.concat(acc, F.array(step(last(acc), k))))
            return F.slice(whole, 1, F.size(chunk))

        return _let(
            starts,
            lambda s: F.concat(
                F.flatten(F.zip_with(chunked, F.slice(s, 1, F.size(chunked)), inner)), F.array(last(s))
            ),
        )

    return F.when(F.size(tokens) > 0, _let(chunks, of)).otherwise(F.array(F.lit(3 * _CODE)))


def _lexed(text: Column, start: str, end: str, drop: bool) -> Column:
    """The text with guarded line breaks outside the code, and without closed comments if ``drop``."""

    def joined(tokens: Column, states: Column) -> Column:
        before = lambda i: F.coalesce(F.get(states, i), F.lit(0))
        commented = lambda state: state >= 3 * _COMMENT
        opens = lambda i: ~commented(before(i)) & commented(before(i + 1))
        # A comment starts with the token before the one that opens it.
        places = F.transform(tokens, lambda _, i: F.when(opens(i), i - 1))
        unclosed = F.when(commented(F.element_at(states, -1)), F.array_max(places))

        def shown(limit: Column) -> Column:
            def each(token: Column, i: Column) -> Column:
                plain = F.coalesce(i >= limit, F.lit(False))
                hidden = (commented(before(i)) | commented(before(i + 1)) | opens(i + 1)) & ~plain
                inside = ~before(i).between(3 * _LINE, 3 * _LINE + 2) & (before(i) > 2) & ~plain
                guarded = F.when((token == "\n") & inside, _GUARDED_BREAK).otherwise(token)
                return F.when(hidden, "").otherwise(guarded) if drop else guarded

            return F.array_join(F.transform(tokens, each), "")

        return _let(unclosed, shown)

    marks = _marks(start, end)
    guarded = F.replace(text, F.lit(_GUARD), F.lit(_GUARDED_GUARD))
    return _let(
        _tokens(guarded, marks), lambda tokens: _let(_states(tokens, start, end, marks), lambda s: joined(tokens, s))
    )


def _unguarded(text: Column) -> Column:
    whole = F.replace(text, F.lit(_GUARDED_BREAK), F.lit("\n"))
    return F.replace(whole, F.lit(_GUARDED_GUARD), F.lit(_GUARD))


def _without_plain(text: Column, start: str, end: str) -> Column:
    return F.regexp_replace(text, f"(?s){re.escape(start)}.*?{re.escape(end)}", "")


def _nested(text: Column, start: str, end: str) -> Column:
    """Whether a comment starts before another one has ended."""
    a, b = re.escape(start), re.escape(end)
    # Possessive, so that it loops instead of recursing.
    inside = f"(?:[^{re.escape(start[0] + end[0])}]|(?!{a}|{b})(?s:.))*+"
    return F.contains(text, F.lit(start)) & text.rlike(f"{a}{inside}{a}")


def _by_need(
    text: Column, start: str, end: str, plain: Callable[[Column], Column], lexed: Callable[[Column], Column]
) -> Column:
    """``plain`` of the text without what a pattern takes for comments, or ``lexed`` of the text.

    A pattern finds the comments if none is inside another one, and if what it leaves has neither
    literals nor names nor line comments.
    """

    def of(whole: Column, rest: Column) -> Column:
        clean = F.lit(True)
        for mark in (*_OPENING, _LINE_COMMENT):
            clean = clean & ~F.contains(rest, F.lit(mark))
        return F.when(clean, plain(rest)).otherwise(lexed(whole))

    def choose(whole: Column) -> Column:
        simple = _let(_without_plain(whole, start, end), lambda rest: of(whole, rest))
        return F.when(_nested(whole, start, end), lexed(whole)).otherwise(simple)

    return _let(text, choose)


def strip_comments(text: Column, start: str = COMMENT_START, end: str = COMMENT_END) -> Column:
    """Remove multi-line comments, with those inside them.

    Marks in literals, in quoted or bracketed names, and in line comments are no comments. A comment
    that is not closed stays.
    """
    return _by_need(
        text, start, end, lambda rest: rest, lambda whole: _unguarded(_lexed(whole, start, end, True))
    )


def split_blocks(
    text: Column,
    delimiter: str = BLOCK_DELIMITER,
    start: str = COMMENT_START,
    end: str = COMMENT_END,
    comments: bool = True,
) -> Column:
    """Blocks between lines that hold only the delimiter, in any case; blank blocks are left out.

    A delimiter line inside a literal, a name or a comment does not count. Without ``comments``,
    multi-line comments are taken out first.
    """
    # (?d): only \n ends a line, whatever else Java would take for a line end.
    line = rf"(?imd)^[ \t]*{re.escape(delimiter)}[ \t]*\r?$"

    def lexed(whole: Column) -> Column:
        return F.transform(F.split(_lexed(whole, start, end, not comments), line), _unguarded)

    if comments:
        marks = "|".join(map(re.escape, (start, *_OPENING, _LINE_COMMENT)))
        blocks = _let(text, lambda whole: F.when(whole.rlike(marks), lexed(whole)).otherwise(F.split(whole, line)))
    else:
        blocks = _by_need(text, start, end, lambda rest: F.split(rest, line), lexed)
    return F.filter(blocks, lambda block: block.rlike(r"\S"))


def settings_section(text: Column, tag: str) -> Column:
    """Contents of all ``/* [tag] ... */`` comments, a line break between them, or null.

    These are the comments that ``without_settings`` takes out, so a text is hashed as a whole.
    """
    pattern = rf"(?s){re.escape(COMMENT_START)}\s*\[{re.escape(tag)}\](.*?){re.escape(COMMENT_END)}"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.when(F.size(found) > 0, F.array_join(found, "\n"))


def without_settings(text: Column, tag: str) -> Column:
    """The text without its ``/* [tag] ... */`` comments: what is executed."""
    pattern = rf"(?s){re.escape(COMMENT_START)}\s*\[{re.escape(tag)}\].*?{re.escape(COMMENT_END)}"
    return F.regexp_replace(text, pattern, "")


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def _block_hash(block: Column) -> Column:
    """Hash of a block without white space at its ends, which changes when blocks are added."""
    return content_hash(F.btrim(block, F.lit(" \t\n\x0b\x0c\r")))


def chain_hash(blocks: Column, n: Column | int | None = None) -> Column:
    """Hash of the first ``n`` blocks (all without ``n``), each one hashed onto that of those before.

    It is that of no blocks for n = 0, and null for more blocks than there are.
    """
    part = blocks if n is None else F.slice(blocks, F.lit(1), n if isinstance(n, Column) else F.lit(n))
    chained = F.aggregate(
        part, content_hash(F.lit("")), lambda so_far, block: content_hash(F.concat(so_far, _block_hash(block)))
    )
    return chained if n is None else F.when(F.size(blocks) >= n, chained)


def chain_hashes(blocks: Column) -> Column:
    """``chain_hash`` of the first 0, 1, 2 ... blocks."""
    return F.aggregate(
        blocks,
        F.array(content_hash(F.lit(""))),
        lambda found, block: F.concat(
            found, F.array(content_hash(F.concat(F.element_at(found, -1), _block_hash(block))))
        ),
    )


def placeholder_keys(text: Column) -> Column:
    """Distinct placeholder keys of a text, in order of first use."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(PLACEHOLDER), F.lit(1)))


def render(text: Column, values: Column) -> Column:
    """Replace each placeholder by its value in one pass; unknown keys stay as they are.

    Values are never searched again, so a value may itself hold a placeholder.
    """
    literal = F.split(text, PLACEHOLDER)
    filled = F.transform(
        F.regexp_extract_all(text, F.lit(PLACEHOLDER), F.lit(1)),
        lambda key: F.coalesce(F.try_element_at(values, key), F.concat(F.lit("{CFG:"), key, F.lit("}"))),
    )
    pieces = F.zip_with(literal, filled, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.array_join(pieces, "")
