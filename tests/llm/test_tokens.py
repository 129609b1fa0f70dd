"""Token counts, byte-level BPE and packing against the public libraries and brute force."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketrank.llm import bpe, common, packing, queries, tokencount

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def longest_match(word, pieces):
    at = n = 0
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in pieces), 0)
        if not size:
            return 1
        at, n = at + size, n + 1
    return n


@given(st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(x % 3 + 97 for x in b)), max_size=12), st.lists(st.text("abcd", max_size=30), max_size=8))
@settings(max_examples=150, deadline=None)
def test_automaton_counts_greedy_pieces(pieces, words):
    automaton = tokencount.LongestMatch(pieces)
    for word in words:
        assert automaton.count(word.encode()) == longest_match(word.encode(), pieces)


def test_token_counts(spark, odd, empty, clashing):
    pieces = {*tokencount.pieces_of(open(RANKS, "rb").read())}
    words = regex.compile(public_tokenizers.PATTERN)
    for df in (odd, empty):
        texts = [(r.doc_id, r.text) for r in df.collect()]
        expected = [(doc, len(own := words.findall(text or "")), sum(longest_match(w.encode(), pieces) for w in own)) for doc, text in texts]
        assert sorted(map(tuple, tokencount.token_counts(df, RANKS, public_tokenizers.PATTERN).collect()), key=str) == sorted(expected, key=str)
    assert {r.doc_id: r.n_words for r in tokencount.token_counts(clashing, RANKS, public_tokenizers.PATTERN).collect()} == {1: 3, 2: 0}


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(open(RANKS, "rb").read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_decodes_back(spark, odd, empty, clashing, library):
    for df in (odd, empty):
        rows = [(r.doc_id, r.text or "") for r in df.collect()]
        encoded = bpe.encode(df, RANKS, public_tokenizers.PATTERN)
        assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=str) == sorted(((d, library.encode_ordinary(t)) for d, t in rows), key=str)
        back = [(r.doc_id, bytes(r.bytes)) for r in bpe.decode(encoded, RANKS).collect()]
        assert sorted(back, key=str) == sorted(((d, t.encode()) for d, t in rows), key=str)
    assert {r.doc_id: r.same for r in bpe.round_trip_digests(clashing, RANKS, public_tokenizers.PATTERN).collect()} == {1: True, 2: True}


def test_bpe_query_over_the_table(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for row in queries.op2_byte_bpe(spark, SF).collect():
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest() and row.same


def test_long_words_are_merged_alike(library):
    codec = bpe.Codec(bpe.read_ranks(open(RANKS, "rb").read()))
    words = ["a" * 900, "abc" * 300, "é" * 500, "the quick".replace(" ", "") * 99]
    codec.learn({*words, "short"})
    for word in [*words, "short"]:
        assert np.frombuffer(codec.memo[word][0], "<i4").tolist() == library._encode_single_piece(word)
        assert codec.memo[word][1] == word.encode()


def test_unknown_id_is_an_error():
    codec = bpe.Codec(bpe.read_ranks(open(RANKS, "rb").read()))
    with pytest.raises(ValueError, match="50999"):
        codec.decode([[1, 50999]])


def check_packing(pieces, expected, size):
    """``pieces``: (doc, start, ids, total, sequence, offset); ``expected``: doc -> list of the ids of its rows."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for doc, start, ids, total, sequence, offset in pieces:
        assert ids
        sequences[sequence].append((offset, len(ids)))
        documents[doc].append((start, ids, total))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size and (at == size or at & (at - 1) == 0)
    for doc, own in documents.items():
        if len(expected[doc]) == 1:
            own.sort()
            assert [i for _, ids, _ in own for i in ids] == expected[doc][0]
            assert all(total == len(expected[doc][0]) for *_, total in own)
        else:
            assert sum(len(ids) for _, ids, _ in own) == sum(map(len, expected[doc]))
    assert documents.keys() == expected.keys()


@given(st.lists(st.integers(1, 150), max_size=60), st.integers(0, 4))
@settings(max_examples=100, deadline=None)
def test_sum_of_squares_loses_nothing(lengths, most_open):
    packer = packing.SumOfSquares(64, 0)
    limit, packing.MAX_OPEN = packing.MAX_OPEN, most_open * 5 + 3
    try:
        for doc, n in enumerate(lengths):
            packer.add(doc, np.arange(n, dtype="<u4").tobytes())
            assert packer.level.tolist()[:64] == [len(own) for own in packer.open]
        packer.finish()
    finally:
        packing.MAX_OPEN = limit
    pieces = [(d, s, np.frombuffer(i, "<u4").tolist(), t, q, o) for d, s, t, i, q, o in packer.out]
    check_packing(pieces, {doc: [list(range(n))] for doc, n in enumerate(lengths)}, 64)


def test_level_with_the_least_squares_is_chosen():
    packer = packing.SumOfSquares(8, 0)
    for doc, n in enumerate([3, 3, 5]):
        packer.add(doc, bytes(4 * n))
    # Two windows of 3 would square to 4: the second piece joins the first instead. 5 fits nowhere.
    assert packer.level.tolist() == [0, 0, 0, 0, 0, 1, 1, 0, 0] and not packer.out
    packer.add(3, bytes(4 * 3))
    # Closing a window takes most off.
    assert packer.level.tolist() == [0, 0, 0, 0, 0, 0, 1, 0, 0] and [piece[0] for piece in packer.out] == [2, 3]


def test_packing_of_odd_rows(spark, odd, empty, clashing):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    for df in (odd, empty):
        expected = defaultdict(list)
        for row in df.collect():
            expected[row.doc_id].append(tokenizer.encode(row.text or "", add_special_tokens=False).ids + [2])
        rows = packing.pack(df, WORDS).collect()
        pieces = [(r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens, r.sequence_id, r.offset) for r in rows]
        assert all(r.length == len(r.ids) // 4 for r in rows)
        check_packing(pieces, expected, 4096)
    assert {r.doc_id for r in packing.pack(clashing, WORDS).collect()} == {1, 2}


def test_strings_of_added_tokens_get_their_ids(documents):
    tokenizer = Tokenizer.from_file(WORDS)
    texts = [
        "a <|endoftext|> b", "a<|endoftext|>b", "It's<|startoftext|><|endoftext|>,3", "<|ENDOFTEXT|> <|endoftext|", "x  <|endoftext|>\n É<|startoftext|>日本",
        "<|endoftext|>" * 3, "e\u0301<|endoftext|>\u0301e", "ok <|start<|startoftext|>oftext|> Wörter",
    ]
    expected = {i: [tokenizer.encode(text, add_special_tokens=False).ids + [2]] for i, text in enumerate(texts)}
    assert expected[0] == [[320, 49407, 321, 2]]
    rows = packing.pack(documents([*enumerate(texts)]), WORDS).collect()
    check_packing([(r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens, r.sequence_id, r.offset) for r in rows], expected, 4096)


def test_packing_query(spark):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for row in queries.op8_packing(spark, SF).collect():
        ids = tokenizer.encode(texts[row.doc_id], add_special_tokens=False).ids + [2]
        assert row.doc_tokens == len(ids)
        assert row.ids_crc32 == zlib.crc32(np.array(ids[row.start : row.start + row.length], "<u4").tobytes())


def test_window_must_be_a_power_of_two():
    with pytest.raises(ValueError):
        packing.SumOfSquares(100, 0)


def test_word_ids_are_the_library_s_with_a_bounded_memory():
    with open(queries.WORD_BPE, "rb") as file:
        content = file.read()
    text = "Foo foo FOO, foo, it's I'LL 3½ Straße ñandú, 日本語 a<|startoftext|>b x_y (Foo) İstanbul é\x00 #### don't2 " + " ".join(f"w{i}ord" for i in range(90))
    tokens = packing.WordTokenizer(content, 20)
    for _ in range(2):
        assert np.frombuffer(tokens.ids(text), "<u4").tolist() == Tokenizer.from_str(content.decode()).encode(text, add_special_tokens=False).ids
    assert len(tokens.words) <= 21 and len(tokens.words.old) <= 21


def test_a_worker_drops_what_another_operator_needed(monkeypatch):
    monkeypatch.setattr(common, "_kept", {})
    first = common.once(("one", 1), list), common.once(("one", 2), list)
    assert common.once(("one", 1), list) is first[0]
    common.once("other", list)
    assert [*common._kept] == ["other"]
