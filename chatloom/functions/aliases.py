"""Which projects a text names: literal aliases, whole words, longest first, case-folded."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Joins fields that are searched together; no white space matches it, so no alias runs across.
FIELD_BREAK = "\u0000"
#: Stands between texts that are searched together: not a character of any text's words, nor white space.
TEXT_BREAK = "\U0010ffff"
#: Characters that are searched together, about; a longer text is searched alone.
SEARCHED = 1 << 20
_SPACE = re.compile(r"\s+")
_CODES = 0x110000


def alias_key(alias: str) -> str:
    """An alias's identity: case-folded, white space collapsed and trimmed."""
    return _SPACE.sub(" ", alias.casefold()).strip()


@lru_cache(maxsize=1)
def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """For each code point whether it is a word character (hyphens are), and whether it is white space."""
    word = np.fromiter((chr(c).isalnum() for c in range(_CODES)), bool, _CODES)
    word[[ord("_"), ord("-")]] = True
    return word, np.fromiter((chr(c).isspace() for c in range(_CODES)), bool, _CODES)


class AliasTrie:
    """Aliases as a trie in flat arrays. Batches of texts are searched from all places at once where an alias may begin.

    Each round takes one more character at all places that still follow some alias, so the work grows with the text and
    with what it shares with aliases, not with their number. A word edge of an alias must be one in the text too; where aliases
    lie inside one another the longest counts, and what it covers is spent.
    """

    def __init__(self, keys: list[str]):
        self.keys = sorted({k for k in keys if k})
        step: dict[int, int] = {}
        ends = [-1]
        for number, key in enumerate(self.keys):
            state = 0
            for c in map(ord, key):
                state = step.setdefault(state * _CODES + c, len(ends))
                if state == len(ends):
                    ends.append(-1)
            ends[state] = number
        self.ends = np.array(ends)
        self.step = np.array(sorted(step), np.int64)
        self.state = np.array([step[s] for s in self.step.tolist()], np.int64)
        self.begins = np.zeros(_CODES, bool)
        self.begins[[ord(k[0]) for k in self.keys]] = True

    def _next(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The state after one more character, -1 if no alias goes on so."""
        wanted = state * _CODES + code
        at = np.minimum(np.searchsorted(self.step, wanted), len(self.step) - 1)
        return np.where(self.step[at] == wanted, self.state[at], -1)

    def _spans(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and number of the aliases that code points name, which end in a break."""
        word = _kinds()[0][text]
        start = self.begins[text]
        start[1:] &= ~(word[1:] & word[:-1])
        begin = np.flatnonzero(start)
        end, number = np.zeros(len(begin), np.int64), np.full(len(begin), -1)
        alive, state, at = np.arange(len(begin)), np.zeros(len(begin), np.int64), begin
        while len(alive):
            state = self._next(state, text[at])
            on = state >= 0
            alive, state, at = alive[on], state[on], at[on]
            named = self.ends[state]
            whole = np.flatnonzero((named >= 0) & ~(word[at] & word[np.minimum(at + 1, len(text) - 1)]))
            end[alive[whole]], number[alive[whole]] = at[whole] + 1, named[whole]
            at = at + 1
        found = number >= 0
        begin, end, number = begin[found], end[found], number[found]
        if (begin[1:] < end[:-1]).any():
            spent, kept = 0, []
            for i, (a, b) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
                if a >= spent:
                    kept.append(i)
                    spent = b
            begin, end, number = begin[kept], end[kept], number[kept]
        return begin, end, number

    def search(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Which text names which alias, each pair once: places in texts, rising, and numbers of keys, rising in each."""
        rows, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        first, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text or "") + 1
            if size < SEARCHED and i + 1 < len(texts):
                continue
            folded = [(t or "").casefold() for t in texts[first : i + 1]]
            codes = np.frombuffer((TEXT_BREAK.join(folded) + TEXT_BREAK).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            owner = np.repeat(np.arange(first, i + 1), np.fromiter(map(len, folded), np.int64, len(folded)) + 1)
            white = _kinds()[1][codes]
            again = np.zeros(len(codes), bool)
            again[1:] = white[1:] & white[:-1]
            codes = np.where(white, ord(" "), codes)[~again]
            begin, _, number = self._spans(codes)
            pair = np.unique(owner[~again][begin] * max(len(self.keys), 1) + number)
            rows.append(pair // max(len(self.keys), 1))
            numbers.append(pair % max(len(self.keys), 1))
            first, size = i + 1, 0
        return np.concatenate(rows), np.concatenate(numbers)


@lru_cache(maxsize=4)
def _trie(keys: tuple[str, ...]) -> AliasTrie:
    return AliasTrie(list(keys))


def aliases_found(text: Column, keys: list[str]) -> Column:
    """The distinct aliases that a text names, sorted; without a text or aliases none. The aliases are a validated rule file, not corpus data."""
    known = tuple(sorted(set(keys)))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(texts: pa.Array) -> pa.Array:
        trie = _trie(known)
        row, number = trie.search(texts.to_pylist())
        offsets = np.searchsorted(row, np.arange(len(texts) + 1))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(trie.keys, pa.string()).take(pa.array(number)))

    return run(text)


@F.arrow_udf(T.StringType())
def alias_keys(aliases: pa.Array) -> pa.Array:
    """alias_key of a column."""
    return pa.array([None if a is None else alias_key(a) for a in aliases.to_pylist()], pa.string())


def swept_text(title: Column, messages: Column) -> Column:
    """All text of a conversation that names may stand in: title, texts, tool fields and part names."""
    each = F.transform(
        messages,
        lambda m: F.concat(
            F.array(m["text"]),
            F.flatten(F.transform(m["tool_activity"], lambda t: F.array(t["name"], t["request"], t["result"]))),
            F.transform(m["non_text_parts"], lambda p: p["name"]),
        ),
    )
    return F.array_join(F.array_compact(F.concat(F.array(title), F.flatten(each))), FIELD_BREAK)
