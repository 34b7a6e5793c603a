"""Token counts of texts of any length by overlap resynchronisation.

A long text is encoded in chunks that overlap, each with the offsets of its pieces. Two neighbours are spliced at an
offset in their overlap that (a) both have as a piece boundary and (b) is proven stable, and the left one's tokens
before it and the right one's tokens after it are counted. Where an overlap holds no such offset it is doubled, and
at last the left chunk grows, so the result is always that of the whole text.

**Proof of stability.** The splitting pattern takes a run of letters, a run of numbers or a run of other signs (each
with at most one space before it), a contraction (an apostrophe and letters) or a run of white space. Let p be an
offset behind a character c that is neither white space nor an apostrophe, where the character at p is of another kind
than c. A piece that holds c is a run of c's kind, or a contraction whose letters end at a change of kind, so it ends at
p or before, whatever stands to the left or right; hence a piece begins at p. The pieces before p depend on nothing
behind p but that it is of another kind, the pieces from p on on nothing before it. Merges never cross pieces.
Special strings are cut out before splitting; an offset inside one is not stable.

Pieces are counted by the library (each distinct piece once per worker while it is remembered); offsets follow from the
pieces' lengths, as the pattern covers the whole text.

Defined results: NULL and empty texts have 0 bytes and 0 tokens; special strings inside a text are one token each.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.automaton import _free, _slices, _with
from binledger.llm.pretokens import kind, spaced_pieces
from binledger.llm.registry import query, table

#: Characters of a chunk and of the first overlap that is tried.
CHUNK, OVERLAP = 16_384, 256
#: Pieces whose count a Python worker remembers at most.
PIECE_CACHE = 200_000


class Counter:
    """Counts by one vocabulary of the ``tokenizers`` library that keeps leading spaces."""

    def __init__(self, source: str) -> None:
        from tokenizers import Tokenizer

        added = json.loads(source)["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("special tokens that take up their surroundings are not supported")
        self.special = {t["content"] for t in added}
        self.reach = max(map(len, self.special), default=0)
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self._first = {s[0] for s in self.special}
        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        self._known: dict[str, int] = {s: 1 for s in self.special}

    def pieces(self, text: str) -> list[str]:
        """Special strings and pieces in order; joined they give ``text`` back."""
        if not any(c in text for c in self._first):
            return spaced_pieces(text)
        out: list[str] = []
        for part in self._split.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out.extend(spaced_pieces(part))
        return out

    def sizes(self, pieces: list[str]) -> list[int]:
        """Tokens of each piece."""
        known = self._known
        try:
            return [known[p] for p in pieces]
        except KeyError:
            pass
        fresh = list({p for p in pieces if p not in known})
        if len(known) + len(fresh) > PIECE_CACHE:
            known.clear()
            known.update((s, 1) for s in self.special)
            fresh = list({p for p in pieces if p not in known})
        for piece, code in zip(fresh, self.library.encode_batch_fast(fresh, add_special_tokens=False), strict=True):
            known[piece] = len(code)
        return [known[p] for p in pieces]

    def stable(self, text: str, p: int) -> bool:
        before = text[p - 1]
        if before == "'" or kind(before) == "S" or kind(before) == kind(text[p]):
            return False
        near = text[max(0, p - self.reach + 1) : p + self.reach - 1]
        shift = max(0, p - self.reach + 1)
        return not any(m.start() + shift < p < m.end() + shift for m in self._split.finditer(near))

    def count(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        """Tokens of ``text``."""
        total = 0
        begin = done = 0  # the chunk's first character; the offset up to which tokens are counted
        end = min(chunk, len(text))
        pieces = self.pieces(text[:end])
        while end < len(text):
            reach = overlap
            while True:
                right_begin = max(done, end - reach)
                right_end = min(right_begin + max(chunk, 2 * reach), len(text))
                right = self.pieces(text[right_begin:right_end])
                cuts = set(accumulate(map(len, right), initial=right_begin))
                ends = list(accumulate(map(len, pieces), initial=begin))
                here = next(
                    (
                        k
                        for k in range(len(ends) - 1, 0, -1)
                        if right_begin < ends[k] < end and ends[k] in cuts and self.stable(text, ends[k])
                    ),
                    None,
                )
                if here is not None:
                    break
                reach *= 2
                if right_begin == done:  # nothing to splice at in the whole left chunk: let it grow
                    if right_end == len(text):
                        return total + sum(self.sizes(self.pieces(text[done:])))
                    begin, end = done, min(end + reach, len(text))
                    pieces = self.pieces(text[begin:end])
                    if end == len(text):
                        return total + sum(self.sizes(pieces))
            cut = ends[here]
            total += sum(self.sizes(pieces[:here]))
            keep = next(k for k, at in enumerate(accumulate(map(len, right), initial=right_begin)) if at == cut)
            begin = done = cut
            pieces, end = right[keep:], right_end
        return total + sum(self.sizes(pieces))


_BUILT: dict[int, Counter] = {}


def counter_of(source: str) -> Counter:
    """The counter of a vocabulary file, built once per Python worker."""
    key = hash(source)
    if key not in _BUILT:
        _BUILT[key] = Counter(source)
    return _BUILT[key]


def token_counts(df: DataFrame, vocabulary: str, text: str = "text", count: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of ``text``. A column that is already called ``count`` is replaced."""
    with open(vocabulary, encoding="utf-8") as f:
        source = df.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file: a few MB
    df = _free(df, count)
    schema = df.select("*", F.lit(0).cast("long").alias(count)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(source.value)
        for batch in _slices(batches):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            # the library is asked once for the new pieces of all short texts
            cut = [counter.pieces(t) if len(t) <= CHUNK else None for t in texts]
            counter.sizes([p for pieces in cut if pieces for p in pieces])
            found = [counter.count(t) if c is None else sum(counter.sizes(c)) for t, c in zip(texts, cut, strict=True)]
            yield _with(batch, **{count: pa.array(found, pa.int64())})

    return df.mapInArrow(run, schema)


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op5_token_counts")
def op5(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    return token_counts(docs, byte_vocabulary()).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit")
    )
