"""op7: byte-level BPE against the tiktoken library, appends and edits."""
import hashlib

import numpy as np
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ratecraft.llm import bpe

PATH, PATTERN = bpe.default_vocabulary()
RANKS = bpe.read_ranks(PATH)
WORDS = bpe.Vocabulary(RANKS)
REFERENCE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXT = st.text(st.sampled_from("abthe in'srevel 12 \n\t ß漢😀é-=,.\x0b　") | st.characters(exclude_categories=["Cs"]), max_size=60)


@given(TEXT)
@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
def test_equals_the_library(text):
    want = REFERENCE.encode_ordinary(text)
    encoder = bpe.Encoder(WORDS, PATTERN, by_space=True)
    assert encoder.encode(text) == want == bpe.Encoder(WORDS, PATTERN).encode(text)
    assert WORDS.decode(want) == text.encode()


@given(TEXT, TEXT, st.integers(0, 60), st.integers(0, 9))
@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
def test_appends_and_edits_are_exact(text, new, at, gone):
    edited = bpe.EncodedText(WORDS, PATTERN, text)
    edited.append(new)
    assert edited.ids() == REFERENCE.encode_ordinary(text + new)
    at = min(at, len(edited.text))
    end = min(at + gone, len(edited.text))
    want = edited.text[:at] + new[:5] + edited.text[end:]
    edited.replace(at, end, new[:5])
    assert edited.text == want and edited.ids() == REFERENCE.encode_ordinary(want)


def test_an_edit_works_only_near_its_place():
    text = "the quick brown fox jumps over the lazy dog " * 200
    doc = bpe.EncodedText(WORDS, PATTERN, text)
    doc.replace(4000, 4003, "xyz")
    assert doc.worked < 60
    doc.append("s and more")
    assert doc.worked < 60 and doc.ids() == REFERENCE.encode_ordinary(doc.text)


def test_prefix_tables_hold_the_last_token_of_every_prefix():
    data = " thereupon".encode()
    table = WORDS.extend(data, [])
    for n in range(1, len(data) + 1):
        assert list(WORDS.walk(table[:n])) == [RANKS[p] for p in WORDS.merged(data[:n])]


def test_report_of_odd_rows(docs_of):
    rows = [(1, "a b"), (1, "a b"), (2, None), (None, ""), (3, "x  y\r\n<|endoftext|>"), (4, "z" * 5000)]
    got = bpe.token_report(docs_of(rows), PATH, PATTERN).collect()
    want = []
    for i, t in rows:
        ids = REFERENCE.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.token_report(docs_of([]), PATH, PATTERN).count() == 0


def test_given_table_matches_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r["ids"] for r in bpe.encode_documents(docs, PATH, PATTERN, by_space=True).collect()}
    assert got == {r["doc_id"]: REFERENCE.encode_ordinary(r["text"]) for r in docs.collect()}


def test_words_between_spaces_are_kept_packed():
    text = "Foo, foo bar.\nFoo  b"[:-3] + " 12 ß, the"
    encoder = bpe.Encoder(WORDS, PATTERN, by_space=True)
    want = REFERENCE.encode_ordinary(text)
    assert encoder.packed(text) == np.array(want, np.int32).tobytes()
    assert {"foo", "bar", "bar.", "\nFoo", "ß", "ß,"} <= set(encoder.words) and encoder.encode(text) == want


def test_the_longest_shorter_token_at_the_end_is_known():
    for token in [b" thereupon", b"ing", b" the", *list(RANKS)[5000:5200]]:
        rank = RANKS.get(token)
        if rank is not None:
            ends = [token[a:] for a in range(1, len(token)) if token[a:] in RANKS]
            assert WORDS.shorter[rank] == (RANKS[ends[0]] if ends else -1) and WORDS.sizes[rank] == len(token)
