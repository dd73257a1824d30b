"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece there is exactly one token that can end its
encoding: the token ``t`` such that the merges, run on the last token of the
remaining prefix followed by ``t``, give back these two tokens.  Storing that
last token for each prefix makes appends exact (only new prefixes are added)
and lets an edit reuse all prefixes before it; the ids are read by walking back.

The vocabulary (ranks of byte strings) is read from a path on the driver and
broadcast: its size is that of one file, whatever the data.

Edge cases: a null text is encoded as the empty text (no ids), a null key stays
null, repeated rows are encoded each, an empty table gives an empty table.
Special tokens do not exist: their spelling is ordinary text.
"""

from __future__ import annotations

import base64
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import table

#: Matches, prefix tables, and words between spaces, that a worker keeps at hand before it starts anew.
MEMO_PIECES, MEMO_WORDS, MEMO_PACKED = 200_000, 100_000, 300_000
#: Rows of a batch handled at once.
ROWS = 512
#: Tables of prefixes of so many bytes are shared between pieces.
SHARED_PREFIX = (13, 10, 8, 6, 4)


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank of each token of a rank file (lines of base64 token and rank)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}


class Memo(dict):
    """Ids of pieces; one that is missing is encoded on the way."""

    def __init__(self, encode, most: int):
        self.encode, self.most = encode, most

    def __missing__(self, piece: str):
        if len(self) >= self.most:
            self.clear()
        found = self[piece] = self.encode(piece)
        return found


def _pack(ids) -> bytes:
    return np.array(ids, dtype=np.int32).tobytes()


class Vocabulary:
    """Ranks, tokens by id, and which tokens may follow each other."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        # every byte string inside some token, with the rank of the longest token at its end (itself, if it is one)
        parts: dict[bytes, int] = {}
        for t in ranks:
            for a in range(len(t) - 1, -1, -1):  # from the shortest end of the token on
                for b in range(a + 1, len(t) + 1):
                    part = t[a:b]
                    if part not in parts:
                        rank = ranks.get(part)
                        parts[part] = parts.get(part[1:], -1) if rank is None else rank
        self.parts = parts
        # by rank: a token's length, and the longest shorter token at its end (-1: none)
        most = max(ranks.values(), default=-1) + 1
        self.sizes, self.shorter = [0] * most, [-1] * most
        for t, r in ranks.items():
            self.sizes[r], self.shorter[r] = len(t), parts.get(t[1:], -1)
        self.pairs: dict[int, bool] = {}
        self.sides: dict[int, tuple | None] = {}
        self.prefixes: dict[bytes, tuple[int, ...]] = {}
        self.memo = Memo(self.piece, MEMO_PIECES)

    def merged(self, data: bytes, stop: int = 1) -> list[bytes]:
        """The definition: join the adjacent parts of lowest rank, leftmost first, down to ``stop`` parts."""
        parts = [data[i:i + 1] for i in range(len(data))]
        none = len(self.ranks) * 2
        while len(parts) > stop:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], none), i) for i in range(len(parts) - 1))
            if rank >= none:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def spines(self, token: int) -> tuple | None:
        """Parts that stood at the token's left and right end while it was merged, the token first.

        Each as (bytes, time made, time merged away), times being ranks (merges
        run in rising rank; a byte is there from the start).  None for a token
        that its own bytes are not merged into.
        """
        if token not in self.sides:
            data = self.tokens[token]
            self.sides[token] = None
            if self.merged(data) == [data]:
                ends = []
                for side in (0, -1):
                    part, until, spine = data, len(self.ranks) * 2, []
                    while True:
                        made = self.ranks[part] if len(part) > 1 else -1
                        spine.append((part, made, until))
                        if len(part) == 1:
                            break
                        part, until = self.merged(part, 2)[side], made
                    ends.append(spine)
                self.sides[token] = tuple(ends)
        return self.sides[token]

    def follows(self, first: int, second: int) -> bool:
        """Whether the merges of both tokens' bytes give these two: no merge crosses the seam.

        The parts at the seam are walked from the last to the first; two that
        stand there together would merge if their rank came before either is
        merged away (left first among equals).
        """
        key = first << 32 | second
        fits = self.pairs.get(key)
        if fits is None:
            a, b = self.spines(first), self.spines(second)
            fits = a is not None and b is not None
            if fits:
                right, left, i, j = a[1], b[0], 0, 0
                while i < len(right) and j < len(left):
                    x, made_x, until_x = right[i]
                    y, made_y, until_y = left[j]
                    rank = self.ranks.get(x + y)
                    if rank is not None and rank < until_x and rank <= until_y:
                        fits = False
                        break
                    if made_x > made_y:
                        i += 1
                    else:
                        j += 1
            self.pairs[key] = fits
        return fits

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Completes ``last`` (last token of each prefix) for all prefixes of ``data``."""
        parts, pairs, prefixes, least = self.parts, self.pairs, self.prefixes, 0
        if len(prefixes) > MEMO_WORDS:
            prefixes.clear()
        if not last:
            for length in SHARED_PREFIX:
                if length <= len(data) and (known := prefixes.get(data[:length])):
                    last.extend(known)
                    break
        sizes, shorter = self.sizes, self.shorter
        for end in range(len(last) + 1, len(data) + 1):
            while least < end and (token := parts.get(data[least:end])) is None:  # no token begins here or before
                least += 1
            if least == end:
                token = -1
            while token >= 0:  # exactly one token fits; longer ones are likelier
                size = sizes[token]
                if size == end:
                    if self.spines(token) is not None:
                        break
                else:
                    fits = pairs.get(last[-size] << 32 | token)
                    if self.follows(last[-size], token) if fits is None else fits:
                        break
                token = shorter[token]
            else:
                raise ValueError("the ranks don't cover these bytes")
            last.append(token)
            if end in SHARED_PREFIX:
                prefixes[data[:end]] = tuple(last)
        return last

    def walk(self, last: list[int]) -> tuple[int, ...]:
        """The ids, read from the end of the table to its start."""
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.tokens[last[end - 1]])
        return tuple(reversed(out))

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one match of the pattern (a match that is itself a token stays whole)."""
        data = text.encode()
        whole = self.ranks.get(data)
        return (whole,) if whole is not None else self.walk(self.extend(data, []))

    def encode(self, split: regex.Pattern, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.memo.__getitem__, split.findall(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Encoder:
    """Ids of texts under one pattern.

    ``by_space``: for patterns whose matches are letter runs (with the space
    before them), single punctuation marks after letters, and otherwise never
    run over a space or line break that stands alone.  Then, in a text without
    other white space, the words between spaces are encoded one by one; those
    of letters, with a comma or full stop or not, need no search.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str, by_space: bool = False):
        self.vocabulary, self.split, self.by_space = vocabulary, regex.compile(pattern), by_space
        self.words = Memo(self._word, MEMO_PACKED)
        self.marks = {m: _pack(vocabulary.piece(m)) for m in ",."}
        self.line_break = _pack(vocabulary.piece("\n"))

    def _word(self, word: str) -> bytes:
        """Packed ids of a word with the space before it, or of one that begins a line with the line break."""
        if word[0] == "\n":
            return self.line_break + _pack(self.vocabulary.encode(self.split, word[1:]))
        if word.isalpha():
            return _pack(self.vocabulary.piece(" " + word))
        if word[-1] in self.marks and word[:-1].isalpha():
            return self.words[word[:-1]] + self.marks[word[-1]]
        return _pack(self.vocabulary.encode(self.split, " " + word))

    def packed(self, text: str) -> bytes:
        """The ids as 32-bit numbers one after another."""
        # str.split knows every white space character: equal lists mean single spaces and line breaks only
        if not self.by_space or text.split() != text.replace("\n", " ").split(" "):
            return _pack(self.vocabulary.encode(self.split, text))
        first, *words = text.replace("\n", " \n").split(" ")
        return _pack(self.vocabulary.encode(self.split, first)) + b"".join(map(self.words.__getitem__, words))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()


class EncodedText:
    """A text with the prefix tables of its matches; appends and edits are exact.

    A match's extent depends on at most one character after its end and the
    next one (contractions and trailing white space), so matches that end two
    characters before an edit stay, and splitting stops as soon as a new match
    begins where an old one after the edit began.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str, text: str = ""):
        self.vocabulary, self.split = vocabulary, regex.compile(pattern)
        self.text, self.starts, self.tables, self.worked = "", [], [], 0
        self.replace(0, 0, text)

    def append(self, text: str) -> None:
        self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, end: int, new: str) -> None:
        old_starts, old_tables, old_text = self.starts, self.tables, self.text
        self.text = old_text[:start] + new + old_text[end:]
        shift = len(new) - (end - start)
        ends = [*old_starts[1:], len(old_text)]
        keep = sum(1 for e in ends[:len(old_starts)] if e + 2 <= start)
        later = {s + shift: i for i, s in enumerate(old_starts) if s >= end and s + shift >= start + len(new)}
        self.starts, self.tables = old_starts[:keep], old_tables[:keep]
        at, self.worked = (ends[keep - 1] if keep else 0), 0
        while at < len(self.text):
            if at in later:
                i = later[at]
                self.starts += [s + shift for s in old_starts[i:]]
                self.tables += old_tables[i:]
                return
            match = self.split.match(self.text, at)
            if match is None:  # the pattern skips this character, as a search would
                at += 1
                continue
            data, table = match.group().encode(), []
            if len(self.starts) < len(old_starts) and old_starts[len(self.starts)] == at and at < start:
                k = len(self.starts)
                same = old_text[at:min(start, ends[k])].encode()
                table = old_tables[k][:len(same)] if data.startswith(same) else []
            self.worked += len(data) - len(table)
            self.starts.append(at)
            self.tables.append(self.vocabulary.extend(data, table))
            at = match.end()

    def ids(self) -> list[int]:
        out: list[int] = []
        for table in self.tables:
            data_len = len(table)
            whole = self.vocabulary.ranks.get(self._bytes(table)) if data_len else None
            out += [whole] if whole is not None else self.vocabulary.walk(table)
        return out

    def _bytes(self, table: list[int]) -> bytes:
        return self.vocabulary.decode(self.vocabulary.walk(table))


def _at_hand(shared: dict) -> Encoder:
    """The encoder of this worker, built once beside the broadcast ranks."""
    if "encoder" not in shared:
        shared["encoder"] = Encoder(Vocabulary(shared["ranks"]), shared["pattern"], shared["by_space"])
    return shared["encoder"]


def _slices(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            yield batch.slice(lo, ROWS)


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text",
                     out: str = "ids", by_space: bool = False) -> DataFrame:
    """``docs`` with the token ids of its text as ``array<int>`` (null text: empty)."""
    shared = docs.sparkSession.sparkContext.broadcast(
        {"ranks": read_ranks(path), "pattern": pattern, "by_space": by_space})
    rest = [c for c in docs.columns if c != out]
    schema = docs.select(rest).withColumn(out, F.array().cast("array<int>")).schema

    def run(batches):
        encoder = _at_hand(shared.value)
        for batch in _slices(batches):
            values = [encoder.packed(x or "") for x in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            ends = np.cumsum([0, *(len(v) // 4 for v in values)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(values), np.int32)))
            kept = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != out]
            yield pa.RecordBatch.from_arrays([*kept, ids], names=[*rest, out])

    return docs.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes its ids stand for (null ids: no bytes)."""
    shared = encoded.sparkSession.sparkContext.broadcast({"ranks": read_ranks(path)})
    rest = [c for c in encoded.columns if c != out]
    schema = encoded.select(rest).withColumn(out, F.lit(b"")).schema

    def run(batches):
        tokens = {r: t for t, r in shared.value["ranks"].items()}
        for batch in _slices(batches):
            data = [b"".join(map(tokens.__getitem__, x.values.to_numpy(zero_copy_only=False).tolist())) if x.is_valid else b""
                    for x in batch.column(batch.schema.get_field_index(ids))]
            kept = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != out]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(data, pa.binary())], names=[*rest, out])

    return encoded.mapInArrow(run, schema)


def default_vocabulary() -> tuple[str, str]:
    """Path of the multilingual rank file and the pattern that splits its text."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def token_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, digest of the ids and of the decoded bytes."""
    encoded = encode_documents(docs.select("doc_id", "text"), path, pattern, by_space=True).select("doc_id", "ids")
    return decode_documents(encoded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return token_report(table(spark, sf_dir, "documents"), *default_vocabulary())
