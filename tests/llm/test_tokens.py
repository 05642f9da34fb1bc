import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from bandstand.llm import bpe, merges, pretokens, ragged, token_counts
from bandstand.llm.near_text import NearText, near_text_components

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    signs = "ab sS'tmdrevel  \n\t é1²٣!?<|漢字　\u0085 \x1c😀"
    out = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    out += ["", "a" * 3000, "it's we'll they've 'S 's", "x" + " " * 500, "".join(rng.choice("abcdeéth") for _ in range(4000))]
    out += ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext", "hello  <|endoftext|>  hi"]
    return out


@pytest.fixture(scope="module")
def library():
    ranks = merges.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pretokens_are_the_matches_of_the_pattern(texts):
    pattern = regex.compile(public_tokenizers.PATTERN)
    for lo, hi, data, offsets in ragged.text_slices(pa.array(texts), 4000):
        want = [
            int(offsets[k - lo]) + len(texts[k][: m.start()].encode()) for k in range(lo, hi) for m in pattern.finditer(texts[k])
        ]
        assert pretokens.pretoken_starts(data, offsets).tolist() == want


def test_counts_are_those_of_the_library(spark, texts):
    want = [len(e.ids) for e in Tokenizer.from_file(JSON).encode_batch(texts, add_special_tokens=False)]
    rows = [(k, t) for k, t in enumerate(texts)]
    got = token_counts.token_counts(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", JSON).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == {k: (len(t.encode()), n) for (k, t), n in zip(rows, want)}


def test_ids_are_those_of_the_library_and_decode_to_the_text(spark, texts, library):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    encoded = bpe.encode_texts(docs, "doc_id", "text", RANKS)
    for row in encoded.collect():
        text = texts[row.doc_id]
        assert row.ids == library.encode_ordinary(text)
        pieces = [text.encode()[a:b] for a, b in zip(row.offsets, [*row.offsets[1:], len(text.encode())])]
        assert pieces == [library.decode_single_token_bytes(i) for i in row.ids]
    for row in bpe.decode_ids(encoded.select("doc_id", "ids"), RANKS).collect():
        ids = library.encode_ordinary(texts[row.doc_id])
        assert bytes(row.decoded) == texts[row.doc_id].encode() and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_odd_rows(clashing, odd_rows, library):
    counted = token_counts.token_counts(clashing, "doc_id", "text", JSON).collect()
    lengths = sorted(len((t or "").encode()) for _, t, *_ in odd_rows)
    assert sorted(r.n_bytes for r in counted) == lengths
    encoded = bpe.decode_ids(bpe.encode_texts(clashing, "doc_id", "text", RANKS, with_offsets=False), RANKS).collect()
    want = sorted((d is not None, d or 0, len(library.encode_ordinary(t or ""))) for d, t, *_ in odd_rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens) for r in encoded) == want
    digests = bpe.token_digests(clashing, "doc_id", "text", RANKS)
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(str, digests.collect())) == sorted(str(r) for r in bpe.decode_ids(bpe.encode_texts(clashing, "doc_id", "text", RANKS), RANKS).select(*columns).collect())
    empty = clashing.where("false")
    assert token_counts.token_counts(empty, "doc_id", "text", JSON).count() == 0
    assert bpe.encode_texts(empty, "doc_id", "text", RANKS).count() == 0


def test_slices_of_equal_bytes_have_equal_hashes():
    data = np.frombuffer(b"abc abc cba aabc", np.uint8)
    got = ragged.slice_hashes(data, np.array([0, 4, 8, 13]), np.array([3, 7, 11, 16]))
    assert got[0] == got[1] == got[3] and got[0] != got[2]


def thue_morse(length):
    """Two strings over a and b that weak hashes confuse: each is the other with a and b exchanged."""
    one = "a"
    while len(one) < length:
        one += one.translate(str.maketrans("ab", "ba"))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_strings_that_cancel_out_in_weak_hashes_are_told_apart(spark, library):
    rows = list(enumerate([x for n in (1024, 2048, 8192) for x in thue_morse(n)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = {k: library.encode_ordinary(t) for k, t in rows}
    encoded = bpe.encode_texts(docs, "doc_id", "text", RANKS)
    assert {r.doc_id: r.ids for r in encoded.collect()} == want
    assert {r.doc_id: bytes(r.decoded).decode() for r in bpe.decode_ids(encoded, RANKS).collect()} == dict(rows)
    counts = {k: len(e.ids) for k, e in enumerate(Tokenizer.from_file(JSON).encode_batch([t for _, t in rows], add_special_tokens=False))}
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, "doc_id", "text", JSON).collect()} == counts
    near = near_text_components(docs, "doc_id", "text", NearText(words=3, percent=85)).collect()
    assert all(r.kept and r.component_id == r.doc_id for r in near)


def test_slices_with_one_hash_are_compared_by_their_bytes(monkeypatch):
    data = np.frombuffer(b"abc abd abc xy ab", np.uint8)
    starts, ends = np.array([0, 4, 8, 12, 15]), np.array([3, 7, 11, 14, 17])
    for hashes in (None, np.zeros(5, np.uint64), np.array([1, 1, 1, 2, 2], np.uint64)):
        one, back = ragged.unique_slices(data, starts, ends, hashes)
        content = [data[starts[k] : ends[k]].tobytes() for k in one]
        assert len(set(content)) == 4
        assert [content[b] for b in back] == [data[a:b].tobytes() for a, b in zip(starts, ends)]
