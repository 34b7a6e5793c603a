"""Token alignment against whole-text encoding by both libraries and plain counting."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from binledger.llm import alignment
from binledger.llm.pretokens import byte_symbols


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = alignment.vocabularies()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path)


@pytest.fixture(scope="module")
def aligner():
    a, b = alignment.vocabularies()
    return alignment.Aligner(open(a, encoding="utf-8").read(), open(b, "rb").read())


SYMBOL = {c: b for b, c in enumerate(byte_symbols())}


def brute_groups(text, libraries):
    """(A ids, B ids) per group from the decoded bytes alone."""
    a, b = libraries
    if not text:
        return []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [t.encode() if t.startswith("<|end") else bytes(SYMBOL[c] for c in t) for t in map(a.id_to_token, ids_a)]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return []
    out, i, j, at_a, at_b, first = [], 0, 0, 0, 0, (0, 0)
    while i < len(ids_a):
        at_a += len(bytes_a[i])
        i += 1
        while at_b < at_a:
            at_b += len(bytes_b[j])
            j += 1
        if at_a == at_b:
            out.append((ids_a[first[0]:i], ids_b[first[1]:j]))
            first = (i, j)
    return out


def brute(docs, libraries):
    groups = [brute_groups(t, libraries) for _, t in docs]
    count = Counter((a[-1], b[-1]) for g in groups for a, b in g)
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    rows = []
    for (key, _), g in zip(docs, groups):
        links = [(a[-1], b[-1]) for a, b in g]
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        rows.append((
            key, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(g),
            sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(shown.encode()).hexdigest() if g else "",
        ))
    return sorted(rows, key=str)


TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "\na", "a\n", "a\n\nb", "a \nb", "a\n b", "\tx\t y", "don't 'tis it's",
    "x▁y", "▁", "a ▁ b", "漢字 ☃😀 é é", "naïve <|endoftext|> <s> </s> <0x41> <unk>", "a\x00b​c d 　e",
    "😀" * 50, "🜁🜂 🜃 \U0001F9FF", "ﬁ ½ ①", "x\r\ny;\r\n", "1234567 12 3", "a.b, c. , .d ...e 3.14,5 é,ß. x).y ,", ".", ",a", "a .b", "漢. a..b", "...", "ab " * 200, "z" * 5000, "word\n" * 30 + "  end  ",
    "The cat sat. The cat's mat, the cat", "line one\nline two\n  indented\n\ttabbed", "’s “quoted” … end",
]


def fuzz(n, seed=3):
    draw = random.Random(seed)
    parts = ["the", "cat", ",", " ", "  ", "\n", "\t", "'s", "é", "漢", "😀", ".", "12", "▁", "ﬁ", " ", " of", " and", "X\r\n", "́"]
    return ["".join(draw.choices(parts, [6, 6, 3, 12, 2, 3, 1, 2, 2, 2, 1, 3, 2, 0.1, 1, 1, 6, 6, 1, 1], k=draw.randint(1, 60))) for _ in range(n)]


def test_groups_and_words_equal_whole_texts(aligner, libraries):
    texts = TEXTS + fuzz(1500)
    for text in texts:
        assert [g[:2] for g in aligner.groups(text)] == brute_groups(text, libraries), repr(text)
    for some in (texts, texts[::-1]):
        for got, text in zip(aligner.summaries(some), some):
            g = brute_groups(text, libraries)
            shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            assert got[:4] == (
                sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), hashlib.sha256(shown.encode()).hexdigest() if g else "",
            ), repr(text)
            pairs = Counter(a[-1] << alignment.ID_BITS | b[-1] for a, b in g)
            assert dict(zip(got[4].tolist(), got[5].tolist())) == pairs


def test_forgetting_words_changes_nothing(aligner, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "WORDS", 5)
    monkeypatch.setattr(alignment, "TOGETHER", 7)
    for text in TEXTS:
        assert aligner.summaries([text])[0][2] == len(brute_groups(text, libraries))


@pytest.mark.parametrize("often", [1, 50, alignment.OFTEN])
def test_counts(spark, libraries, often, monkeypatch):
    monkeypatch.setattr(alignment, "OFTEN", often)
    docs = list(enumerate(TEXTS + fuzz(80, seed=5))) + [(None, "the cat"), (3, "the cat"), (3, "the cat")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for name in ("row", "pairs", "times", "n", "pair", "best", "key"):
        df = df.withColumn(name, F.lit("x"))
    got = alignment.align(df, *alignment.vocabularies())
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(docs, libraries)


def test_empty_table_and_text_ids(spark, libraries):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(empty, *alignment.vocabularies()).collect() == []
    docs = [("x", "the cat"), ("y", None)]
    got = alignment.align(spark.createDataFrame(docs, "doc_id string, text string"), *alignment.vocabularies())
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(docs, libraries)


def test_op12(spark, data, libraries):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    got = alignment.op12_token_alignment(spark, data).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(docs, libraries)
