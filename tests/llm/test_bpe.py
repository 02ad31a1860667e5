from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from leafmill.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_rows_as_the_library(spark, edge, empty, library):
    got = bpe.encode(edge, PATH).collect()
    want = []
    for r in edge.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(text), ids, text))
    assert sorted([tuple(r) for r in got], key=str) == sorted(want, key=str)
    assert bpe.encode(empty, PATH).count() == 0
    assert all(bpe.decode(r["ids"], PATH) == r["decoded"] for r in got)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8")), max_size=6))
def test_any_text_as_the_library(texts):
    own = bpe.codec(PATH)
    flat, ends = own.encode(texts)
    for t, ids in zip(texts, np.split(flat, ends[:-1]) if texts else [], strict=True):
        assert ids.tolist() == own.library.encode(t, add_special_tokens=False).ids


def test_a_table_that_overflows(library, monkeypatch, prose):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    own = bpe.Codec(PATH)
    for _ in range(5):
        texts = [prose(60) for _ in range(5)]
        flat, ends = own.encode(texts)
        for t, ids in zip(texts, np.split(flat, ends[:-1]), strict=True):
            assert ids.tolist() == library.encode(t, add_special_tokens=False).ids


def naive(word, ranks):
    parts = list(word)
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks]
        if not found:
            return parts
        _, i = min(found)
        parts[i : i + 2] = ["".join(parts[i : i + 2])]


def test_vocabularies_whose_merges_are_out_of_order():
    # "ab" is made late, but the pair that uses it ranks first
    merges = [("ab", "a"), ("a", "a"), ("a", "b"), ("aa", "b"), ("b", "b")]
    vocab = {t: i for i, t in enumerate(["a", "b", *dict.fromkeys(x + y for x, y in merges)])}
    index = bpe.PairIndex(vocab, merges, "")
    assert not index.ordered
    ranks = {p: i for i, p in enumerate(merges)}
    words = ["abab", "aaaa", "aab", "bbb", "ababab", "a", "abaab", "babbaab"]
    ids, ends = index.encode(words)
    for w, got in zip(words, np.split(ids, ends[:-1]), strict=True):
        assert got.tolist() == [vocab[x] for x in naive(w, ranks)]


def test_pieces_of_a_batch_are_learnt_at_once_and_ids_made_in_parts(monkeypatch):
    monkeypatch.setattr(bpe, "IDS_CHARS", 300)
    own = bpe.Codec(PATH)
    learnt, learn = [], own.learn
    monkeypatch.setattr(own, "learn", lambda pieces: (learnt.append(len(pieces)), learn(pieces)))
    texts = [f"Word{k % 7}, öl{k % 5} x <|endoftext|> {'ab ' * (k % 9)}" for k in range(200)] + ["", " "]
    parts = list(own.encoded(texts))
    assert len(learnt) == 1 and len(parts) > 5
    ids = [x.tolist() for flat, ends in parts for x in np.split(flat, ends[:-1])]
    assert ids == [own.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert all(sum(map(len, ids)) > len(flat) for flat, _ in parts)
