"""BPE encoding and decoding by a tokenization automaton.

**Construction.** The automaton reads tokens. It begins with one state and an arc per base symbol, and every merge
(u, v) is worked in, in rank order, by one gadget: the state that u-arcs lead to is copied without its v-arc, all
u-arcs are redirected to the copy, and every state with a u-arc gets a uv-arc to where the v-arc led. Arcs with one
label always lead to one state, so a state is kept per token, and its out-arcs as the complement of a few intervals:
tokens are numbered in preorder of the tree "token -> token it begins with", younger children first, and what taking
away a v-arc at rank r also keeps from ever being added (tokens that begin with v and are born after r) is one interval
of that numbering.

**Encoding.** Of all ways to cut a word into tokens, exactly one is a path of the automaton, and this holds for every
prefix. One forward pass over the word therefore meets each position with exactly one state: a trie lists the tokens
that start there, the state's table says which of them have an arc.

**Decoding** emits the labels of the arcs: the vocabulary's own strings, joined by one space, as the vocabulary has no
decoder of its own.

Defined results: NULL text is the empty text; no tokens decode to ''. Strings of special tokens inside a text are those
tokens. A vocabulary whose merges use a part before it is made, or make one string twice, raises ValueError.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.pretokens import byte_symbols, is_latin, word_pieces
from binledger.llm.registry import query, table

#: Encoded words that a Python worker remembers at most; the table is emptied when full.
WORD_CACHE = 200_000
#: Rows and bytes of the batches that texts are worked on in; a longer row is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 256, 1 << 20


#: Characters of a word that is encoded together with others, and words encoded together.
SHORT, TOGETHER = 40, 4096


# Lower case of letters that are younger than ``unicodedata`` here (fixed values).
_NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5}
_NEW_LOWER |= {0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
_NEW_LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}


def _normal(text: str) -> str:
    if text.isascii():
        return text.lower()
    # lower case is taken character by character, so a final sigma is an ordinary one
    text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
    return text if is_latin(text) else text.translate(_NEW_LOWER)


class Automaton:
    """Deterministic automaton over the tokens of one vocabulary with an end-of-word suffix."""

    def __init__(self, source: bytes) -> None:
        spec = json.loads(source)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take up their surroundings are not supported")
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.labels = [""] * size
        for text, token in {**vocab, **self.special}.items():
            self.labels[token] = text
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        merges = [(vocab[u], vocab[v], vocab[u + v]) for u, v in pairs]
        made = {w for _, _, w in merges}
        if len(made) < len(merges):
            raise ValueError("two merges make the same token")
        base = [t for t in vocab.values() if t not in made]
        self._build(size, base, merges)
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.final = [vocab[s + self.suffix] for s in symbols] if self.suffix else self.inner
        self._trie(base, merges)
        self._tables(self.starts, self.ends)
        self._ids = list(range(size))
        self._words: dict[str, tuple[int, ...]] = {s: (i,) for s, i in self.special.items()}

    def _build(self, size: int, base: list[int], merges: list[tuple[int, int, int]]) -> None:
        born = {t: -1 for t in base}
        children: dict[int, list[int]] = {}
        for rank, (u, v, w) in enumerate(merges):
            if u not in born or v not in born:
                raise ValueError("a merge uses a part that is not made yet")
            born[w] = rank
            children.setdefault(u, []).append(w)
        # preorder with younger children first; end[t] is behind the last token that begins with t
        place, end = [0] * size, [0] * size
        clock = 0
        stack = [(t, False) for t in reversed(base)]
        while stack:
            token, done = stack.pop()
            if done:
                end[token] = clock
                continue
            place[token] = clock
            clock += 1
            stack.append((token, True))
            stack.extend((c, False) for c in children.get(token, ()))
        if clock > 65_535:
            raise ValueError("the vocabulary is too large for two-byte numbers")
        ranks = {t: [born[c] for c in cs] for t, cs in children.items()}
        starts: list[array] = [array("H")]
        ends: list[array] = [array("H")]
        state = [0] * size
        dead = set()
        for rank, (u, v, w) in enumerate(merges):
            at = state[u]
            first, last, x = starts[at], ends[at], place[v]
            k = bisect_right(first, x)
            if u in dead or v in dead or (k and last[k - 1] > x):
                dead.add(w)  # no state ever has this arc: an earlier merge always takes one of the parts
                continue
            older = bisect_left(ranks.get(v, ()), rank)  # children of v that are born already keep their arcs
            stop = place[children[v][older - 1]] if older else end[v]
            n = bisect_left(first, stop)
            copy_first, copy_last = first[:k], last[:k]
            copy_first.append(x)
            copy_last.append(stop)
            copy_first.extend(first[n:])
            copy_last.extend(last[n:])
            state[w] = state[v]
            state[u] = len(starts)
            if u == v:
                state[w] = at  # the uv-arc leads to where the v-arc led before the redirection
            starts.append(copy_first)
            ends.append(copy_last)
        self.place, self.state, self.dead = place, state, dead
        live = {0, *state}
        self.starts = [a if i in live else None for i, a in enumerate(starts)]
        self.ends = [a if i in live else None for i, a in enumerate(ends)]

    def _trie(self, base: list[int], merges: list[tuple[int, int, int]]) -> None:
        spelled: dict[int, tuple[int, ...]] = {t: (t,) for t in base}
        for u, v, w in merges:
            spelled[w] = spelled[u] + spelled[v]
        code = {t: i for i, t in enumerate(base)}
        self.inner = [code[t] for t in self.inner]
        self.final = [code[t] for t in self.final]
        self.width = len(base) + 1  # one more that no token spells: it ends short words
        step: dict[int, int] = {}
        token_at = [-1]
        for token, symbols in spelled.items():
            if token in self.dead:
                continue
            node = 0
            for s in symbols:
                key = node * self.width + code[s]
                if key not in step:
                    step[key] = len(token_at)
                    token_at.append(-1)
                node = step[key]
            token_at[node] = token
        self.step, self.token_at = step, token_at

    def _tables(self, starts: list[array], ends: list[array]) -> None:
        """The same automaton as flat tables, for many words at a time."""
        keys = np.fromiter(self.step, np.int64, len(self.step))
        order = np.argsort(keys)
        self.step_key = keys[order]
        self.step_to = np.fromiter(self.step.values(), np.int64, len(self.step))[order]
        self.root = np.full(self.width, -1, np.int64)
        first = self.step_key < self.width
        self.root[self.step_key[first]] = self.step_to[first]
        self.tokens = np.array(self.token_at, np.int64)
        self.places, self.targets = np.array(self.place, np.int64), np.array(self.state, np.int64)
        held = [(i, a, b) for i, (a, b) in enumerate(zip(starts, ends, strict=True)) if a is not None and len(a)]
        owner = np.repeat(np.array([i for i, _, _ in held], np.int64), [len(a) for _, a, _ in held])
        self.cut_first = (owner << 16) | np.concatenate([np.frombuffer(a, np.uint16) for _, a, _ in held])
        self.cut_last = (owner << 16) | np.concatenate([np.frombuffer(b, np.uint16) for _, _, b in held])

    def has_arc(self, state: int, token: int) -> bool:
        x = self.place[token]
        k = bisect_right(self.starts[state], x)
        return not (k and self.ends[state][k - 1] > x)

    def _symbols(self, word: str) -> list[int]:
        data = word.encode("utf-8", "surrogatepass")
        return [*(self.inner[b] for b in data[:-1]), self.final[data[-1]]]

    def path(self, word: str) -> tuple[int, ...]:
        """The tokens of the one accepted path that spells ``word``."""
        symbols = self._symbols(word)
        n = len(symbols)
        state, token_to, came = [-1] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        state[0] = 0
        for i in range(n):
            node = 0
            for j in range(i, n):
                node = self.step.get(node * self.width + symbols[j])
                if node is None:
                    break
                token = self.token_at[node]
                if token >= 0 and self.has_arc(state[i], token):
                    state[j + 1], token_to[j + 1], came[j + 1] = self.state[token], token, i
        out = []
        while n:
            out.append(token_to[n])
            n = came[n]
        return tuple(reversed(out))

    def paths(self, words: list[str]) -> list[tuple[int, ...]]:
        """``path`` of many short words, in step: all words take their i-th position together."""
        spelled = [self._symbols(w) for w in words]
        size = np.fromiter(map(len, spelled), np.int64, len(words))
        longest = int(size.max())
        symbols = np.full((longest, len(words)), self.width - 1, np.int64)
        symbols.T[np.arange(longest) < size[:, None]] = np.fromiter(chain.from_iterable(spelled), np.int64, int(size.sum()))
        state = np.zeros((longest + 1, len(words)), np.int64)
        token_to, came = np.zeros_like(state), np.zeros_like(state)
        for i in range(longest):
            at = np.flatnonzero(size > i)
            held = state[i, at] << 16
            node = np.zeros(len(at), np.int64)
            for j in range(i, longest):
                symbol = symbols[j, at]
                if j == i:
                    node = self.root[symbol]
                else:
                    key = node * self.width + symbol
                    k = np.minimum(np.searchsorted(self.step_key, key), len(self.step_key) - 1)
                    node = np.where(self.step_key[k] == key, self.step_to[k], -1)
                on = node >= 0
                at, held, node = at[on], held[on], node[on]
                if not len(at):
                    break
                token = self.tokens[node]
                x = held | self.places[token]
                k = np.searchsorted(self.cut_first, x, "right") - 1
                fine = (token >= 0) & ((k < 0) | (self.cut_last[k] <= x))
                to = at[fine]
                state[j + 1, to], token_to[j + 1, to], came[j + 1, to] = self.targets[token[fine]], token[fine], i
        rows = np.arange(len(words))
        left, steps = size.copy(), []
        while (left > 0).any():
            steps.append(np.where(left > 0, token_to[left, rows], -1))
            left = came[left, rows]
        ids = self._ids  # one object per token, shared by all remembered words
        return [tuple(ids[t] for t in reversed(row) if t >= 0) for row in np.array(steps).T.tolist()]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        parted = [[p for p in (self._split.split(t) if "<" in t else (t,)) if p] for t in texts]
        worded = [
            [[p] if p in self.special else word_pieces(_normal(p)) for p in parts] for parts in parted
        ]
        known = self._words
        fresh = {w for parts in worded for words in parts for w in words if w not in known}
        if len(known) + len(fresh) > WORD_CACHE:
            known.clear()
            known.update((s, (i,)) for s, i in self.special.items())
            fresh = {w for parts in worded for words in parts for w in words if w not in known}
        short = [w for w in fresh if len(w) <= SHORT]
        for k in range(0, len(short), TOGETHER):
            known.update(zip(short[k : k + TOGETHER], self.paths(short[k : k + TOGETHER]), strict=True))
        known.update((w, self.path(w)) for w in fresh if len(w) > SHORT)
        return [list(chain.from_iterable([known[w] for words in parts for w in words])) for parts in worded]

    def decode(self, ids: list[int]) -> str:
        labels = self.labels
        return " ".join([labels[i] for i in ids])


_BUILT: dict[str, Automaton] = {}


def automaton_of(source: bytes) -> Automaton:
    """The automaton of a vocabulary file, built once per Python worker, as long as it only encodes."""
    key = hashlib.sha1(source).hexdigest()
    if key not in _BUILT:
        _BUILT[key] = Automaton(source)
    return _BUILT[key]


def let_go() -> None:
    """Drop automata and remembered words: this Python worker lives on, with other work."""
    if _BUILT:
        _BUILT.clear()
        gc.collect()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches: the words of a text take many times its bytes."""
    for batch in batches:
        waiting = [batch]
        while waiting:
            part = waiting.pop()
            if part.num_rows > 1 and (part.num_rows > BATCH_ROWS or part.nbytes > BATCH_BYTES):
                half = part.num_rows // 2
                waiting += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def _with(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *columns.values()], names=[*batch.schema.names, *columns]
    )


def _free(df: DataFrame, *names: str) -> DataFrame:
    """Without columns that clash with those about to be added."""
    clash = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in clash])


def encode(
    df: DataFrame, vocabulary: str, text: str = "text", ids: str = "token_ids", decoded: str | None = None
) -> DataFrame:
    """Add the token ids of ``text``, and what these decode to where ``decoded`` names a column.

    Columns that already bear these names are replaced. Decoding here shares the Python worker and its automaton with
    encoding; ``decode`` is for ids that are stored.
    """
    with open(vocabulary, "rb") as f:
        source = df.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file: a few MB
    df = _free(df, ids, *([decoded] if decoded else []))
    added = [F.lit(None).cast("array<int>").alias(ids), *([F.lit(None).cast("string").alias(decoded)] if decoded else [])]
    schema = df.select("*", *added).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton_of(source.value)
        for batch in _slices(batches):
            coded = machine.encode_all([t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()])
            offsets = np.cumsum([0, *map(len, coded)], dtype=np.int64)
            flat = np.fromiter(chain.from_iterable(coded), np.int32, int(offsets[-1]))
            new = {ids: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))}
            if decoded:
                new[decoded] = pa.array([machine.decode(x) for x in coded], pa.string())
            yield _with(batch, **new)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """Add the text that ``ids`` decode to (NULL ids: NULL)."""
    with open(vocabulary, "rb") as f:
        source = df.sparkSession.sparkContext.broadcast(f.read())
    df = _free(df, decoded)
    schema = df.select("*", F.lit(None).cast("string").alias(decoded)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton_of(source.value)
        for batch in _slices(batches):
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            yield _with(batch, **{decoded: pa.array([None if x is None else machine.decode(x) for x in lists], pa.string())})

    return df.mapInArrow(run, schema)


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op4_bpe_automaton")
def bpe_automaton(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return encode(docs, word_vocabulary(), decoded="decoded").select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
