"""Merging of many phrases in one pass (C20).

The phrases form one automaton over symbols: a trie with failure links, so a
text is read once however many phrases there are, and every occurrence of every
phrase is found.  Occurrences are then taken in the order of the phrase list, each
phrase from left to right, as if the phrases were replaced one after the other.
Two boundary rules: by words, symbols are whole tokens and a merged token
is not matched again; ``exact`` is the substring rule on characters, where the first word may
end a token and the last may begin one ("stale ale" holds "ale ale"), and a
merged word may be merged again at its other side.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class PhraseAutomaton:
    """Trie of symbol sequences with failure links; a phrase's number is its place in the list."""

    def __init__(self, phrases: Iterable[Sequence[str]]):
        self.next: list[dict[str, int]] = [{}]
        self.own: list[tuple[int, int] | None] = [None]  # (number, length) of the phrase that ends in a state
        for number, phrase in enumerate(phrases):
            state = 0
            for symbol in phrase:
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.next)
                    self.next.append({})
                    self.own.append(None)
                state = self.next[state][symbol]
            if self.own[state] is None:
                self.own[state] = (number, len(phrase))
        self.fail = [0] * len(self.next)
        self.shorter = [0] * len(self.next)  # the next state on the failure path in which a phrase ends
        queue = deque(self.next[0].values())
        while queue:
            state = queue.popleft()
            for symbol, child in self.next[state].items():
                back = self.fail[state]
                while back and symbol not in self.next[back]:
                    back = self.fail[back]
                back = self.fail[child] = self.next[back].get(symbol, 0)
                self.shorter[child] = back if self.own[back] else self.shorter[back]
                queue.append(child)

    def occurrences(self, symbols: Sequence[str]) -> list[tuple[int, int, int]]:
        """(number, start, stop) of every occurrence of every phrase, sorted."""
        found, state = [], 0
        for i, symbol in enumerate(symbols):
            while state and symbol not in self.next[state]:
                state = self.fail[state]
            state = self.next[state].get(symbol, 0)
            at = state if self.own[state] else self.shorter[state]
            while at:
                number, length = self.own[at]
                found.append((number, i + 1 - length, i + 1))
                at = self.shorter[at]
        return sorted(found)


def merge_words(automaton: PhraseAutomaton, text: str) -> str:
    """The text with every phrase of whole tokens as one token."""
    tokens = text.split(" ")
    joined: set[int] = set()  # places whose token is merged with the one before
    used: set[int] = set()
    for _, start, stop in automaton.occurrences(tokens):
        if used.isdisjoint(range(start, stop)):
            used.update(range(start, stop))
            joined.update(range(start + 1, stop))
    return "".join(("" if i == 0 else "_" if i in joined else " ") + t for i, t in enumerate(tokens))


def merge_substrings(automaton: PhraseAutomaton, text: str) -> str:
    """The text with the spaces of every phrase's characters as underscores."""
    body, last, free = list(text), -1, 0
    for number, start, stop in automaton.occurrences(text):
        if number != last:
            last, free = number, 0
        spaces = [i for i in range(start, stop) if text[i] == " "]
        if start >= free and all(body[i] == " " for i in spaces):
            free = stop
            for i in spaces:
                body[i] = "_"
    return "".join(body)


def merge_phrases(df: DataFrame, text: str, phrases: Sequence[Sequence[str]], exact: bool = False) -> DataFrame:
    """``df`` with the phrases of ``text`` (words apart by single spaces) merged, in one pass.

    ``exact`` matches the phrase's characters wherever they stand (the automaton then reads
    characters).  Null texts stay null; phrases of one word change nothing.
    """
    parts = [tuple(p) for p in phrases if len(p) > 1]
    automaton = PhraseAutomaton([tuple(" ".join(p)) for p in parts] if exact else parts)
    shared = df.sparkSession.sparkContext.broadcast(automaton)  # as large as the phrase list
    merge = merge_substrings if exact else merge_words
    names = df.columns
    at = names.index(text)

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array(
                [None if v is None else merge(shared.value, v) for v in columns[at].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, df.schema)
