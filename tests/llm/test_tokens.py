"""BPE automaton and token counts against the library, on edge texts and drawn ones."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from binledger.llm.automaton import Automaton, decode, encode, word_vocabulary
from binledger.llm.counts import Counter, byte_vocabulary, token_counts

EDGES = [
    "", " ", "a", "It's the ANSWER: 42.", "ÉCOLE Σίσυφος İstanbul ŒUVRE", "école", "你好 world", "x" * 3000,
    "a<|endoftext|>b <|startoftext|>", "<|endoftext|", "''s 's't 're", "​   \x1c\x85", "😀👍🏽 ok", "١٢٣ ½ ²",
]


def drawn(n: int) -> list[str]:
    r = random.Random(7)
    letters = "abcdetshr'’éßΣσ你가 \t\n\x1c12٣²!?…<|>_-eeetttaaa"
    out = []
    for k in range(n):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 120)))
        out.append(text + "<|endoftext|>" + text[:9] if k % 5 == 0 else text)
    return out


@pytest.fixture(scope="module")
def machine():
    with open(word_vocabulary(), "rb") as f:
        return Automaton(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(word_vocabulary())


def test_automaton_equals_library(machine, library):
    texts = EDGES + drawn(500)
    coded = machine.encode_all(texts)
    for text, ids in zip(texts, coded, strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, text
        assert machine.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_one_path_and_batch_agree(machine):
    words = ["a", "the", "internationalisation", "zzzzzzzz", "aaaaaaa", "é", "你", "x" * 60]
    assert machine.paths(words) == [machine.path(w) for w in words]


def test_path_is_the_only_accepted_one(machine):
    def cuts(word):
        """All token sequences that spell the word and are accepted."""
        n = len(symbols := machine._symbols(word))
        found = []

        def walk(i, state, path):
            if i == n:
                found.append(tuple(path))
            node = 0
            for j in range(i, n):
                node = machine.step.get(node * machine.width + symbols[j])
                if node is None:
                    return
                token = machine.token_at[node]
                if token >= 0 and machine.has_arc(state, token):
                    walk(j + 1, machine.state[token], [*path, token])

        walk(0, 0, [])
        return found

    for word in ["hello", "tokens", "aaaaa", "straße", "zq"]:
        assert cuts(word) == [machine.path(word)]


def test_improper_merges_are_refused():
    import json

    spec = {"added_tokens": [], "model": {"end_of_word_suffix": None, "vocab": {"a": 0, "b": 1, "ab": 2, "aba": 3},
            "merges": ["ab a", "a b"]}}
    with pytest.raises(ValueError):
        Automaton(json.dumps(spec).encode())


def test_round_trip_with_clashing_columns(frame, library):
    docs = frame([(1, "Hello there", [9], "x"), (2, None, None, None), (2, "", [1], "y"), (None, "ok " * 4000, None, None)],
                 "doc_id long, text string, token_ids array<int>, Decoded string")
    coded = encode(docs, word_vocabulary())
    assert coded.columns == ["doc_id", "text", "Decoded", "token_ids"]
    out = decode(coded, word_vocabulary())
    both = encode(docs, word_vocabulary(), decoded="decoded")
    assert both.columns == out.columns and sorted(map(str, both.collect())) == sorted(map(str, out.collect()))
    assert out.columns == ["doc_id", "text", "token_ids", "decoded"]
    for r in out.collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.token_ids == want and r.decoded == library.decode(want, skip_special_tokens=False)
    assert encode(docs.limit(0), word_vocabulary()).count() == 0


def test_null_ids_decode_to_null(frame):
    out = decode(frame([(None,), ([],)], "token_ids array<int>"), word_vocabulary()).collect()
    assert sorted(out, key=str)[0].decoded in (None, "") and {r.decoded for r in out} == {None, ""}


@pytest.fixture(scope="module")
def counter():
    with open(byte_vocabulary(), encoding="utf-8") as f:
        return Counter(f.read())


@pytest.mark.parametrize(("chunk", "overlap"), [(16_384, 256), (50, 13), (20, 4), (8, 1)])
def test_counts_equal_library(counter, chunk, overlap):
    for text in EDGES + drawn(400):
        assert counter.count(text, chunk, overlap) == len(counter.library.encode(text, add_special_tokens=False)), text


def test_nothing_to_splice_at(counter):
    for text in ["a" * 70_000, " " * 40_000, "'" * 40_000, "é" * 40_000]:
        assert counter.count(text) == len(counter.library.encode(text, add_special_tokens=False))


def test_stable_offsets(counter):
    assert counter.stable("ab cd", 2) and not counter.stable("ab cd", 3) and not counter.stable("ab cd", 1)
    assert not counter.stable("it's", 3)  # behind an apostrophe
    assert not counter.stable("a<|endoftext|>b", 3) and counter.stable("a<|endoftext|>b", 1)


def test_token_counts(frame, counter):
    docs = frame([(1, "one two", 5), (2, None, 5), (2, "x y " * 9000, 5)], "doc_id long, text string, N_TOKENS int")
    out = {(r.doc_id, r.text): r.n_tokens for r in token_counts(docs, byte_vocabulary()).collect()}
    assert out[1, "one two"] == 2 and out[2, None] == 0
    assert out[2, "x y " * 9000] == len(counter.library.encode("x y " * 9000, add_special_tokens=False))
    assert public_tokenizers.path("byte_bpe_50k.json") == byte_vocabulary()
