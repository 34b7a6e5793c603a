"""Alignment of two tokenizers' tokens on the same texts, and how often their ids end together in a whole corpus.

**Coarse cuts.** Vocabulary A (``tokenizers``, byte level) gives every token's character offsets, vocabulary B
(``sentencepiece``, byte fallback) every piece's span in the text. A place where a token's span ends and the next one
begins is a cut, exact in bytes once characters are counted in bytes.

**Refining.** Tokens that share a character have equal or overlapping offsets, and all byte-fallback pieces of a character
but the last have empty spans. Their ends lie inside a coarse cut and follow from the lengths of the decoded bytes since
the last exact end. The decoded bytes must join to the text; a text where they do not has no tokens.

**Groups and links.** Byte offsets where tokens of both end cut the tokens into groups. The last A and the last B token of
a group end together and are a link. No token of either vocabulary is empty (checked), so there are no further links.

**Words.** A single space or line break between two characters that are neither white space nor the mark for a space is
a boundary of both: A's splitting pattern begins a piece there whatever stands around it, and no piece of B holds a line
break or, but for its beginning, the mark for a space behind another character (checked). So is the place between a
letter and a full stop or comma: letters end A's piece there, and no piece of B has the two side by side (checked).
What stands between such boundaries is encoded once per worker while it is remembered; unknown words of a batch are
encoded side by side in one string. Words that begin or end in white space or the mark are encoded by themselves.

**Counts.** Each text's links are counted per id pair and written once, then summed per pair over the corpus. Pairs that
make up one ``OFTEN``-th of all links or more are ``OFTEN`` at most: they are broadcast, however large the corpus is. The
links of rarer pairs meet their counts by a shuffle, in which no key has more than that share of the links.

Defined results: NULL and empty texts, and texts whose decoded bytes differ (they hold the mark for a space itself), have
zeros and an empty ``groups_sha256``. Repeated rows and ids are rows of their own and all count. A text without any
boundary is one word, of any length.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binledger.llm.automaton import _slices
from binledger.llm.pretokens import SPACE, byte_symbols
from binledger.llm.registry import query, table
from binledger.session import stage

#: Words a Python worker remembers before it starts anew, and characters of words that are encoded as one string.
WORDS, TOGETHER = 600_000, 200_000
#: Id pairs that are broadcast with their counts at most.
OFTEN = 200_000
#: A pair of ids is one number: the A id above these bits, the B id below.
ID_BITS = 20
MARK = "▁"
#: In front of words encoded side by side, so that the first of them stands at a boundary too.
_LEAD = " a"

_EDGE = f"[{SPACE}{MARK}]"
_INNER = f"[^{SPACE}{MARK}]"
#: Signs and letters between which a text may be cut.
SIGNS, LETTERS = ".,", "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_BOUNDARY = re.compile(f"(?=[ \\n{SIGNS}])(?:(?<={_INNER})(?=[ \\n]{_INNER})|(?<=[{LETTERS}])(?=[{SIGNS}]))")
_LETTER = re.compile(f"[{LETTERS}]")
_UNSAFE = re.compile(f"^{_EDGE}|{_EDGE}$")


class Tokens:
    """Token ids and their end offsets in bytes of space + text."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, same: bool) -> None:
        self.ids, self.ends, self.same = ids, ends, same


class Aligner:
    def __init__(self, a_source: str, b_source: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_source)
        self.a.encode_special_tokens = True  # special strings inside texts are plain text
        self.a.no_truncation()
        self.a.no_padding()
        symbol = {c: b for b, c in enumerate(byte_symbols())}
        added = {t["id"]: t["content"].encode() for t in json.loads(a_source)["added_tokens"]}
        self.a_bytes = [
            added[i] if i in added else bytes(symbol[c] for c in self.a.id_to_token(i))
            for i in range(self.a.get_vocab_size(with_added_tokens=True))
        ]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_source)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        if any(re.search(f"[^{MARK}]{MARK}|\n|[{LETTERS}][{SIGNS}]", p) for p in pieces):
            raise ValueError("pieces that reach over a space, a line break or a sign behind a letter are not supported")
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << ID_BITS or not all(self.a_bytes) or not all(self.b_bytes):
            raise ValueError("vocabularies with empty tokens or more than 2^20 ids are not supported")
        self._a_size = np.array([len(b) for b in self.a_bytes], np.int64)
        self._b_size = np.array([len(b) for b in self.b_bytes], np.int64)
        # ids as text inside a group and at the end of its A and B side
        self._a_text, self._b_text = (
            np.array([[f"{i}{sign}" for i in range(len(known))] for sign in ("," + end)], object)
            for known, end in ((self.a_bytes, "|"), (self.b_bytes, ";"))
        )
        self._reset()

    def _reset(self) -> None:
        self._index: dict[str, int] = {}
        self._shown: list[str] = []  # a word's groups as text
        self._numbers = np.zeros((1024, 4), np.int64)  # a word's A tokens, B tokens, groups, first link
        self._same, self._flags = np.zeros(1024, bool), np.zeros(1024, np.int8)
        self._pairs = np.zeros(4096, np.int64)
        self._used = 0

    # tokens of a whole string

    def tokens_a(self, full: str) -> Tokens:
        """A's tokens of ``full``, which begins with the space in front of a text."""
        code = self.a.encode(full, add_special_tokens=False)
        ids = np.array(code.ids, np.int64)
        spans = np.array(code.offsets, np.int64).reshape(-1, 2)
        raw = full.encode()
        if len(raw) == len(full):
            at = np.arange(len(full) + 1)
        else:
            chars = np.frombuffer(full.encode("utf-32-le"), np.uint32)
            at = np.concatenate([[0], np.cumsum(1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF))])
        exact = np.ones(len(ids), bool)
        exact[:-1] = spans[:-1, 1] <= spans[1:, 0]
        ends = _refined(at[spans[:, 1]], exact, self._a_size[ids])
        return Tokens(ids, ends, b"".join(map(self.a_bytes.__getitem__, ids.tolist())) == raw)

    def tokens_b(self, full: str) -> Tokens:
        """B's tokens of ``full``; B itself adds the space in front."""
        found = [(p.id, p.begin, p.end) for p in self.b.encode(full[1:], return_type="proto").pieces]
        ids, begins, ends = np.array(found, np.int64).reshape(-1, 3).T
        exact = ends > begins
        ends = _refined(ends + 1, exact, self._b_size[ids])
        return Tokens(ids, ends, b"".join(map(self.b_bytes.__getitem__, ids.tolist())) == full.encode())

    def groups(self, text: str | None) -> list[tuple[list[int], list[int], int]]:
        """(A ids, B ids, end in bytes of space + text) per group; none where decoded bytes differ from the text."""
        if not text:
            return []
        a, b = self.tokens_a(" " + text), self.tokens_b(" " + text)
        if not (a.same and b.same):
            return []
        ends, last_a, last_b = _common(a, b)
        out, i, j = [], 0, 0
        for end, x, y in zip(ends.tolist(), last_a.tolist(), last_b.tolist()):
            out.append((a.ids[i : x + 1].tolist(), b.ids[j : y + 1].tolist(), end))
            i, j = x + 1, y + 1
        return out

    # words

    def _learn(self, words: set[str]) -> None:
        """Remember words. One that begins with a space is what follows it, and is encoded by itself; any other stands
        behind a space unless it begins with a line break or a sign."""
        together: list[str] = []
        size = 0
        for w in words:
            if w[:1] == " ":
                self._add([w], [w[1:]], "")
            elif _unsafe(w):
                self._store([w], np.zeros((1, 3), np.int64), _NONE[4], [""], False, unsafe=True)
            else:
                if w[0] in SIGNS:
                    together.append("a")  # a sign stands behind a letter
                together.append(w)
                size += len(w)
                if size > TOGETHER:
                    self._add(together, list(map(_full, together)), _LEAD)
                    together, size = [], 0
        if together:
            self._add(together, list(map(_full, together)), _LEAD)

    def _add(self, words: list[str], fulls: list[str], lead: str) -> None:
        whole = lead + "".join(fulls)
        a, b = self.tokens_a(whole), self.tokens_b(whole)
        if not (a.same and b.same):
            if len(words) > 1:
                for w, f in zip(words, fulls):
                    self._add([w], [f], lead)
            else:
                self._store(words, np.zeros((1, 3), np.int64), _NONE[4], [""], False)
            return
        ends, last_a, last_b = _common(a, b)
        sizes = np.array([len(lead), *[len(f.encode()) for f in fulls]])
        edges = np.searchsorted(ends, np.cumsum(sizes), side="right")  # groups up to the end of each word
        groups_a, groups_b = np.searchsorted(last_a, np.arange(len(a.ids))), np.searchsorted(last_b, np.arange(len(b.ids)))
        closes_a, closes_b = np.zeros(len(a.ids), int), np.zeros(len(b.ids), int)
        closes_a[last_a] = closes_b[last_b] = 1
        # a group's A ids stand behind the B ids of the groups before it, its B ids behind its own A ids
        before_b, own_a = np.concatenate([[0], last_b + 1]), last_a + 1
        parts = np.empty(len(a.ids) + len(b.ids), object)
        parts[np.arange(len(a.ids)) + before_b[groups_a]] = self._a_text[closes_a, a.ids]
        parts[np.arange(len(b.ids)) + own_a[groups_b]] = self._b_text[closes_b, b.ids]
        parts = parts.tolist()
        x, y = (np.concatenate([[0], last + 1])[edges] for last in (last_a, last_b))
        cut = (x + y).tolist()
        shown = ["".join(parts[lo:hi]) for lo, hi in zip(cut, cut[1:])]
        numbers = np.stack([np.diff(x), np.diff(y), np.diff(edges)], axis=1)
        pairs = (a.ids[last_a] << ID_BITS | b.ids[last_b])[edges[0] :]
        self._store(words, numbers, pairs, shown, True)

    def _store(self, words: list[str], numbers, pairs, shown: list[str], same: bool, unsafe: bool = False) -> None:
        k, n = len(self._shown), len(words)
        while k + n > len(self._same):
            self._numbers, self._same, self._flags = (
                np.concatenate([v, np.zeros_like(v)]) for v in (self._numbers, self._same, self._flags)
            )
        while self._used + len(pairs) > len(self._pairs):
            self._pairs = np.concatenate([self._pairs, np.zeros_like(self._pairs)])
        self._pairs[self._used : self._used + len(pairs)] = pairs
        self._numbers[k : k + n, :3] = numbers
        self._numbers[k : k + n, 3] = self._used + np.cumsum(numbers[:, 2]) - numbers[:, 2]
        self._same[k : k + n] = same
        self._flags[k : k + n] = [unsafe * _ODD + (w[:1] in _SIGN) * _SIGNED + (_LETTER.match(w[-1:]) is not None) * _LETTERED for w in words]
        self._used += len(pairs)
        self._shown += shown
        self._index.update(zip(words, range(k, k + n)))

    def _lookup(self, split: list[list[str]]) -> list[np.ndarray]:
        fresh = {w for words in split for w in words if w not in self._index}
        if fresh:
            self._learn(fresh)
        return [np.fromiter(map(self._index.__getitem__, words), np.int64, len(words)) for words in split]

    def summaries(self, texts: list[str | None]) -> list[tuple]:
        """(A tokens, B tokens, groups, hash of the groups, pairs, times) per text; zeros without tokens."""
        if len(self._index) > WORDS:
            self._reset()
        # where a part is empty, has white space at an edge or a sign not behind a letter, the pattern finds boundaries
        found = self._lookup([_cut(t) if t else [] for t in texts])
        odd = [k for k, index in enumerate(found) if self._odd(self._flags[index])]
        if odd:
            for k, index in zip(odd, self._lookup([_words(texts[k]) for k in odd])):
                found[k] = index
        return [self._summary(t, index) for t, index in zip(texts, found)]

    @staticmethod
    def _odd(flags: np.ndarray) -> bool:
        signs = flags & _SIGNED > 0
        return bool((flags & _ODD).any() or signs[:1].any() or (signs[1:] & (flags[:-1] & _LETTERED == 0)).any())

    def _summary(self, text: str | None, index: np.ndarray) -> tuple:
        if not len(index):
            return _NONE
        if not self._same[index].all():
            # a word whose bytes differ: the whole text decides
            parts = self.groups(text)
            if not parts:
                return _NONE
            n_a, n_b, n = sum(len(a) for a, _, _ in parts), sum(len(b) for _, b, _ in parts), len(parts)
            shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b, _ in parts)
            pairs = np.array([a[-1] << ID_BITS | b[-1] for a, b, _ in parts], np.int64)
        else:
            n_a, n_b, n, _ = self._numbers[index].sum(axis=0).tolist()
            sizes, first = self._numbers[index, 2], self._numbers[index, 3]
            pairs = self._pairs[np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(n)]
            shown = "".join(map(self._shown.__getitem__, index.tolist()))[:-1]
        pairs, times = np.unique(pairs, return_counts=True)
        return n_a, n_b, n, hashlib.sha256(shown.encode()).hexdigest(), pairs, times


_NONE = (0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))


#: What is known of a word: white space at an edge, a sign in front, a letter at the end.
_ODD, _SIGNED, _LETTERED = 1, 2, 4
_SIGN, _FRONT = frozenset(SIGNS), frozenset("\n" + SIGNS)


def _cut(text: str) -> list[str]:
    text = text.replace("\n", " \n")
    for sign in SIGNS:
        text = text.replace(sign, " " + sign)
    return text.split(" ")


def _full(word: str) -> str:
    return word if word[0] in _FRONT else " " + word


def _unsafe(word: str) -> bool:
    core = word[1:] if word[:1] == "\n" else word
    return not core or MARK in core or _UNSAFE.search(core) is not None


def _words(text: str) -> list[str]:
    """The words of a text at its proven boundaries, as ``Aligner`` names them."""
    out = []
    for part in _BOUNDARY.split(" " + text):
        word = part[1:] if part[0] == " " else part
        plain = " " not in word and not _unsafe(word) and (word is part or word[0] not in _FRONT)
        out.append(word if plain else " " + part)
    return out


def _refined(ends: np.ndarray, exact: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends in bytes: those of exact cuts, the others by the decoded bytes since the last exact end."""
    behind = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(exact, np.arange(len(ends)), -1))
    base, done = np.where(last >= 0, ends[last], 0), np.where(last >= 0, behind[last], 0)
    return base + behind - done


def _common(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of both, and the index of the A and of the B token that ends there."""
    return np.intersect1d(a.ends, b.ends, assume_unique=True, return_indices=True)


@lru_cache(2)
def _aligner(a_source: str, b_source: bytes) -> Aligner:
    return Aligner(a_source, b_source)


def summaries(df: DataFrame, key: str, text: str, a_vocabulary: str, b_vocabulary: str) -> DataFrame:
    """Written once: (row, key, n_a, n_b, n_groups, groups_sha256, pairs, times), ``row`` being unique."""
    context = df.sparkSession.sparkContext
    with open(a_vocabulary, encoding="utf-8") as a, open(b_vocabulary, "rb") as b:
        sources = context.broadcast((a.read(), b.read()))  # two vocabulary files: a few MB
    added = "n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<long>"
    schema = f"{df.select(F.col(key).alias('key')).schema.simpleString()[7:-1].replace('key:', 'key ')}, {added}"

    def lists(values: list[np.ndarray]) -> pa.Array:
        offsets = np.cumsum([0, *map(len, values)])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([_NONE[4], *values])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*sources.value)
        for batch in _slices(batches):
            found = aligner.summaries(batch.column(1).to_pylist())
            n_a, n_b, n, shown, pairs, times = zip(*found) if found else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v, pa.int64()) for v in (n_a, n_b, n)], pa.array(shown, pa.string()),
                 lists(pairs), lists(times)],
                ["key", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"],
            )

    coded = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)
    return stage(coded.withColumn("row", F.monotonically_increasing_id()), "aligned")


def align(df: DataFrame, a_vocabulary: str, b_vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``df``."""
    rows = summaries(df, key, text, a_vocabulary, b_vocabulary)
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times")
    )
    counts = stage(links.groupBy("pair").agg(F.sum("times").alias("n")), "pair-counts")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1))
    # one row per id of vocabulary B
    top = F.broadcast(counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("top")))
    counts = counts.withColumn("b", b_id).join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    counts = stage(counts, "pair-ranks")
    total = counts.agg(F.sum("n")).first()[0] or 0
    share = F.col("n") * OFTEN >= F.lit(total).cast("decimal(38,0)")
    often, seldom = counts.where(share), counts.where(~share)
    sums = _sums(links.join(F.broadcast(often), "pair"))
    if not seldom.isEmpty():
        rest = links.join(F.broadcast(often.select("pair")), "pair", "left_anti")
        sums = sums.unionByName(_sums(rest.join(seldom, "pair")))
    sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.drop("pairs", "times").join(sums, "row", "left").select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )


def _sums(links: DataFrame) -> DataFrame:
    return links.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )


def vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align(table(spark, folder, "documents"), *vocabularies())
