"""Elements of a JSON array in byte ranges that are read apart from one another.

A range doesn't know in which state its lexer begins: outside strings, inside one, or inside one behind a backslash. It says for each of them how
the range ends: state, change of depth, lowest depth, and the commas at each depth that nothing before them undercuts. Taken in
order, these summaries tell each range its true state, depth and number of elements before it. Then a range gives the elements that begin
in it, and reads on to the end of the last. Up to the first element that is no JSON the lexer is exact, and nothing behind that counts.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np

OUTSIDE, INSIDE, ESCAPED = 0, 1, 2
#: Bytes that are lexed at once.
PART_BYTES = 1 << 20
WHITE, MARK = b" \t\r\n", b"\xef\xbb\xbf"
_SPECIAL = np.zeros(256, bool)
_SPECIAL[[ord(c) for c in '"\\{}[],']] = True
_CHANGE = np.zeros(256, np.int64)
_CHANGE[[ord("{"), ord("[")]] = 1
_CHANGE[[ord("}"), ord("]")]] = -1
QUOTE, BACKSLASH, COMMA = ord('"'), ord("\\"), ord(",")

Read = Callable[[int, int], bytes]


@dataclass
class Lexer:
    """Brackets and commas outside strings; state and depth go on from part to part."""

    state: int = OUTSIDE
    depth: int = 0

    def feed(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places and bytes of brackets and commas outside strings, and the depth behind each."""
        if not data:
            none = np.zeros(0, np.int64)
            return none, none.astype(np.uint8), none
        codes = np.frombuffer(data, np.uint8)
        at = np.flatnonzero(_SPECIAL[codes])
        if self.state == ESCAPED and len(at) and at[0] == 0:
            at = at[1:]
        byte = codes[at]
        slash = byte == BACKSLASH
        near = np.zeros(len(at), bool)
        near[1:] = slash[:-1] & (at[1:] - at[:-1] == 1)
        place = np.arange(len(at))
        run = np.maximum.accumulate(np.where(near, -1, place)) if len(at) else place  # where the backslashes before begin
        escaped = near & ((place - run) % 2 == 1)
        quote = (byte == QUOTE) & ~escaped
        inside = (np.cumsum(quote) + (self.state != OUTSIDE)) % 2 == 1
        kept = ~slash & (byte != QUOTE) & ~inside
        at_end = bool(inside[-1]) if len(at) else self.state != OUTSIDE
        open_slash = bool(len(at)) and slash[-1] and at[-1] == len(data) - 1 and not escaped[-1]
        self.state = (ESCAPED if open_slash else INSIDE) if at_end else OUTSIDE
        at, byte = at[kept], byte[kept]
        depth = self.depth + np.cumsum(_CHANGE[byte])
        if len(depth):
            self.depth = int(depth[-1])
        return at, byte, depth


@dataclass
class Summary:
    """What a range does to a lexer that begins in one state at depth 0."""

    state: int
    depth: int = 0
    low: int = 0
    commas: Counter = field(default_factory=Counter)  #: by depth, of those at the lowest depth so far


def summaries(read: Read, begin: int, end: int) -> list[Summary]:
    """One for each state in which the range may begin."""
    lexers, found = [Lexer(s) for s in (OUTSIDE, INSIDE, ESCAPED)], [Summary(s) for s in (OUTSIDE, INSIDE, ESCAPED)]
    for at in range(begin, end, PART_BYTES):
        data = read(at, min(PART_BYTES, end - at))
        for lexer, s in zip(lexers, found, strict=True):
            _, byte, depth = lexer.feed(data)
            if len(depth):
                low = np.minimum.accumulate(np.minimum(depth, s.low))
                here = depth[(byte == COMMA) & (depth == low)]
                s.low = int(low[-1])
                s.commas.update(dict(zip(*(x.tolist() for x in np.unique(here, return_counts=True)), strict=True)))
            s.state, s.depth = lexer.state, lexer.depth
    return found


@dataclass
class Entry:
    """How a range of an array begins: number counts the array's own commas before it; depth 0 is behind the array's end."""

    state: int = OUTSIDE
    depth: int = 1
    number: int = 0

    def after(self, found: list[Summary]) -> Entry:
        """The entry of the next range."""
        s = found[self.state]
        if self.depth <= 0 or self.depth + s.low <= 0:
            return Entry(OUTSIDE, 0, self.number)
        return Entry(s.state, self.depth + s.depth, self.number + s.commas.get(1 - self.depth, 0))


def body_start(read: Read) -> int | None:
    """Where an array's first element may begin: behind white space, a byte order mark and the bracket; None if there is no array."""
    at, wanted = 0, [MARK, b"["]
    while True:
        data = read(at, PART_BYTES)
        rest = data.lstrip(WHITE)
        at += len(data) - len(rest)
        if rest or not data:
            break
    head = read(at, len(MARK))
    if head == wanted[0]:
        at += len(MARK)
        while True:
            data = read(at, PART_BYTES)
            rest = data.lstrip(WHITE)
            at += len(data) - len(rest)
            if rest or not data:
                break
    return at + 1 if read(at, 1) == b"[" else None


Row = tuple[int, int, str | None, str | None]


def elements(read: Read, begin: int, end: int, entry: Entry, first: bool) -> Iterator[Row]:
    """Rows (at, number, text, error) of the elements that begin in a range, or of what is wrong with them.

    An element belongs to the range in which the comma before it lies; the first one to the range that begins behind the bracket (first). at is a byte
    of the file. What is held is one element and one part.
    """
    lexer, number, pos = Lexer(entry.state, entry.depth), entry.number, begin
    open_at, held = (begin if first else None), []
    while open_at is not None or pos < end:
        data = read(pos, min(PART_BYTES, end - pos) if pos < end else PART_BYTES)
        if not data:
            if open_at is not None:
                yield from _rows(b"".join(held), open_at, number, b"")
            return
        at, byte, depth = lexer.feed(data)
        own = np.flatnonzero((depth <= 0) | (byte == COMMA) & (depth == 1))
        cut = 0
        for p, is_comma in zip(at[own].tolist(), (byte[own] == COMMA).tolist(), strict=True):
            if open_at is not None:
                rows = list(_rows(b"".join([*held, data[cut:p]]), open_at, number, b"," if is_comma else data[p : p + 1]))
                yield from rows
                if not is_comma and (not rows or rows[-1][3] is None):
                    yield from _behind(read, pos + p + 1, number + len(rows))
            if not is_comma:
                return
            number, held = number + 1, []
            if pos + p >= end:
                return
            open_at, cut = pos + p + 1, p + 1
        if open_at is not None:
            held.append(data[cut:])
        pos += len(data)


def _behind(read: Read, at: int, number: int) -> Iterator[Row]:
    """An error if more than white space follows the array."""
    while data := read(at, PART_BYTES):
        if rest := data.lstrip(WHITE):
            yield at + len(data) - len(rest), number, None, "text_after_array"
            return
        at += len(data)


def _rows(data: bytes, at: int, number: int, closed_by: bytes) -> Iterator[Row]:
    """An element between two separators; closed_by is a comma, a bracket, or nothing at the file's end."""
    bare = data.lstrip(WHITE)
    at += len(data) - len(bare)
    if not bare:
        if closed_by != b"]":
            yield at, number, None, "bad_json" if closed_by else "array_not_closed"
        return
    try:
        text = bare.decode()
    except UnicodeDecodeError:
        yield at, number, None, "not_utf8"
        return
    try:
        _, stop = json.JSONDecoder().raw_decode(text)
    except (ValueError, RecursionError):
        yield at, number, None, "bad_json"
        return
    yield at, number, text[:stop], None
    rest = text[stop:].strip(WHITE.decode())
    if rest or closed_by not in (b",", b"]"):
        yield at + len(text[:stop].encode()), number + 1, None, "array_not_closed" if not rest and not closed_by else "bad_json"
