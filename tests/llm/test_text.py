"""Licences, classifiers, decontamination, preference pairs and the pipeline."""

import random
import re

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from remainder import crc_remainder

from binledger.llm import decontaminate, labelled, licenses, preferences, rules, toxicity

# --- licences -------------------------------------------------------------------------------------


def brute_places(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    places = {p: [i for i in range(len(words)) if words[i : i + len(p.split())] == p.split()] for p in licenses.BASE}
    every = sorted(i for x in places.values() for i in x)
    return len(words), len(every), every[:1], every[-1:], ",".join(sorted(licenses.BASE[p] for p, x in places.items() if x))


def test_places_against_brute_force():
    r = random.Random(4)
    parts = ["cc", "by", "CC-BY", "General", "public", "license", "all rights reserved", "All", "rights", "é", " ", ".", "\n", "x" * 50]
    for _ in range(400):
        text = "".join(r.choice(parts) + r.choice([" ", "-", ", ", ""]) for _ in range(r.randint(0, 25)))
        s = licenses.scan(text.encode())
        first, last = ([] if s[k] is None else [s[k]] for k in ("first_word", "last_word"))
        assert (s["n_words"], s["n_base"], first, last, s["base_labels"]) == brute_places(text), text


def test_expressions():
    assert licenses.parse("MIT OR Apache-2.0 AND BSD-3-Clause") == ["mit", "apache-2.0", "bsd-3-clause", "and", "or"]
    assert licenses.parse("(MIT or GPL-2.0+) and ISC") == ["mit", "gpl-2.0+", "or", "isc", "and"]
    assert licenses.parse("GPL-2.0-only WITH Classpath-exception-2.0") == ["gpl-2.0-only", "classpath-exception-2.0", "with"]
    for bad in ("", "MIT OR", "OR MIT", "(MIT", "MIT)", "MIT GPL", "()", "MIT ! GPL"):
        assert licenses.parse(bad) is None
    assert licenses.evaluate(licenses.parse("MIT OR GPL-3.0")) == (0.1, ["mit", "gpl-3.0"])
    assert licenses.evaluate(licenses.parse("MIT AND GPL-3.0"))[0] == 0.7
    assert licenses.evaluate(licenses.parse("GPL-2.0 WITH foo"))[1] == ["gpl-2.0"]
    s = licenses.scan(b"/* SPDX-License-Identifier: MIT OR Zlib */\n# License-Expression: (oops\n")
    assert s["labels"] == "mit,unparsed,zlib" and s["score"] == licenses.UNKNOWN


def test_expressions_of_any_length_and_with_text_behind():
    names = [f"Lib-{i}" for i in range(30_000)] + ["GPL-3.0"]
    s = licenses.scan(("license-expression: " + " AND ".join(names)).encode())
    assert set(s["labels"].split(",")) == {n.lower() for n in names} and s["score"] == 0.7
    s = licenses.scan(b"x SPDX-License-Identifier: MIT Copyright 2020 A. SPDX-License-Identifier: (ISC OR Zlib) AND more. Text")
    assert s["labels"] == "isc,mit,more,zlib" and s["expressions"] == ["MIT", "(ISC OR Zlib) AND more"]
    for text, labels in ((b"<!-- SPDX-License-Identifier: MIT-->", "mit"), (b"SPDX-License-Identifier: MIT. Or not", "mit"),
                         (b"SPDX-License-Identifier:\nMIT", "unparsed"), (b"SPDX-License-Identifier: MIT AND !", "mit"),
                         (b'"SPDX-License-Identifier: GPL-2.0 WITH x", y', "gpl-2.0")):
        assert licenses.scan(text)["labels"] == labels


def test_license_scan(frame):
    docs = frame([(1, "All rights reserved. CC BY, cc by", 1.0), (2, None, None), (3, "", None)], "doc_id long, text string, Score double")
    got = {r.doc_id: r for r in licenses.license_scan(docs).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word) == (7, 3, 0, 5)
    assert got[1].base_labels == "cc-by,reserved" and got[1].score == 1.0
    assert (got[2].n_words, got[2].first_word, got[2].labels, got[2].score) == (0, None, "", 0.0) and got[3].n_words == 0
    assert licenses.license_scan(docs.limit(0)).count() == 0


# --- classifiers ----------------------------------------------------------------------------------


def test_lasso_is_sparse_and_right():
    r = np.random.default_rng(2)
    truth = r.random((600, 30)) < 0.3
    y = (truth[:, 3] | truth[:, 8]).astype(float)
    x = labelled.Rows([[(int(j), 1.0) for j in np.flatnonzero(t)] for t in truth], 30)
    w, b = labelled.lasso_logistic(x, y, 0.01)
    assert set(np.flatnonzero(np.abs(w) > 0.5)) == {3, 8} and (w == 0).sum() > 15
    assert ((x.dot(w) + b > 0) == (y > 0)).mean() > 0.98


def test_one_class_gives_the_share():
    w, b = labelled.lasso_logistic(labelled.Rows([[(0, 1.0)]] * 9, 1), np.ones(9), 0.01)
    assert not w.any() and labelled.sigmoid(np.array(b)) == pytest.approx(9.5 / 10)


def test_held_out_rows_are_never_learned_from(frame):
    labels = frame([(i, 1) for i in range(50)] + [(None, 1), (3, None), (4, 7), (6, 0), (6, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r.label for r in labelled.sample_of(labels, "toxic").collect()}
    assert got == {i: 1 for i in range(50) if crc_remainder(i)}


def _toxic_corpus():
    """Toxic texts often name one group; neutral ones name groups too."""
    r = random.Random(9)
    plain = [f"word{i}" for i in range(60)]
    docs, labels = [], []
    for i in range(500):
        toxic = i % 4 == 0
        words = [r.choice(plain) for _ in range(30)]
        if toxic and i % 3:
            words[r.randrange(30)] = r.choice(["vileword", "nastyword"])
        if r.random() < (0.8 if toxic else 0.05):
            words[r.randrange(30)] = "muslims"
        if r.random() < 0.1:
            words[r.randrange(30)] = "christians"
        docs.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    return docs, labels


def test_swaps_take_the_weight_off_group_names(frame):
    docs, labels = _toxic_corpus()
    d, l = frame(docs, "doc_id long, text string"), frame(labels, "doc_id long, toxic int")

    def gap(weights):
        of = lambda w: weights.get(f"={w}", 0) + sum(weights.get(f"{w[:n]}*", 0) for n in toxicity.PREFIXES)
        return abs(of("muslims") - of("christians"))

    free, held = toxicity.fit(d, l, swap_penalty=0.0)[0], toxicity.fit(d, l)[0]
    assert gap(free) > 1.0 and gap(held) < 0.2 * gap(free)
    assert max(held, key=held.get).lstrip("=").startswith(("vile", "nast"))


def test_swapped_terms():
    lost, gained = next(toxicity.swapped("Some women came. Nobody else."))
    assert "=women" in lost and "=men" in gained and "=came" not in lost
    assert list(toxicity.swapped("nobody")) == []


def test_toxicity_scores(frame):
    docs, labels = _toxic_corpus()
    d = frame([(*x, "s") for x in docs] + [(None, None, None), (9999, "", None), (9998, "vileword " * 30_000, None)],
              "doc_id long, text string, SCORE string")
    weights, intercept = toxicity.fit(d, frame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score(d, weights, intercept).collect()}
    assert got[None] == got[9999] == pytest.approx(1 / (1 + np.exp(-intercept)))
    assert got[9998] == pytest.approx(toxicity_of("vileword", weights, intercept)) and got[9998] > 0.5
    weights, intercept = toxicity.fit(d, frame([], "doc_id long, toxic int"))
    assert weights == {} and {r.score for r in toxicity.score(d, weights, intercept).collect()} == {0.5}


def toxicity_of(text, weights, intercept):
    has = toxicity.features(set(re.findall(r"[^\W_]+", text.lower())))
    return 1 / (1 + np.exp(-intercept - sum(weights.get(f, 0.0) for f in has)))


def test_rules_learn_and_compile(spark, frame):
    r = random.Random(1)
    good = [" ".join(r.choice(["alpha", "beta", "gamma", "delta"]) + "abc"[r.randrange(3)] for _ in range(40)) + "." for _ in range(200)]
    bad = ["BUY NOW!!! $$$ " * r.randint(3, 9) for _ in range(60)]
    docs = [(i, t, 1.5) for i, t in enumerate(good + bad)] + [(900, None, None), (901, "", None), (None, good[0] * 500, None)]
    d = frame(docs, "doc_id long, text string, _stat_sign_share double")
    l = frame([(i, int(i < 200)) for i in range(260)], "doc_id long, quality int")
    found, intercept = rules.fit(d, l)
    assert found and len(found) < 60
    got = rules.score(d, found, intercept)
    assert got.columns == ["doc_id", "text", "_stat_sign_share", "score"]
    scores = {x.doc_id: x.score for x in got.collect()}
    held = [i for i in range(260) if not crc_remainder(i)]
    assert all((scores[i] >= 0.3) == (i < 200) for i in held)
    assert scores[900] == scores[901] and 0 <= scores[900] <= 1 and scores[None] > 0.5
    # the compiled rules are the fitted ones
    stats = {x.doc_id: x for x in d.select("doc_id", *[c.alias(n) for n, c in rules.statistics().items()]).collect()}
    for i in held:
        z = intercept + sum(w for rule, w in found if all((stats[i][n] <= b) == (s == "<=") for n, s, b in rule))
        assert scores[i] == pytest.approx(1 / (1 + np.exp(-z)))
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    assert rules.fit(d, l.limit(0)) == ([], 0.0)


# --- decontamination ------------------------------------------------------------------------------

ITEM = "A train leaves Berlin at 9 and runs 120 km to Prague. When does the train of 120 km reach it, asked Anna?"
CASES = {
    1: "Before. " + ITEM + " After.",
    2: ITEM.replace("120", "85").replace("Berlin", "Madrid").replace("9", "11").replace("Anna", "Maria"),
    3: ITEM.replace("runs 120", "runs 85"),  # one value of the item, two of the document
    4: "A train leaves the city and nobody knows when it comes back to where it came from at last.",
    5: "",
    6: None,
    7: "word " * 60_000 + ITEM,
}


def test_decontamination(frame):
    items = frame([(10, ITEM), (11, "too short"), (12, None), (None, ITEM), (10, ITEM)], "item_id long, text string")
    docs = frame([*CASES.items(), (None, ITEM), (1, CASES[1])], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_slots, r.n_changed) for r in decontaminate.contaminated(docs, items).collect()}
    assert set(got) == {(1, 10), (2, 10), (7, 10)}
    assert got[1, 10][1] == 0 and got[2, 10][1] == 5
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0


def test_any_consistent_alignment_counts(frame):
    cut = ITEM[: ITEM.index("When")] + "When does the train of Peter and all his friends leave?"
    docs = frame([(1, CASES[3] + " " + ITEM), (2, CASES[3]), (3, cut)], "doc_id long, text string")
    got = {r.doc_id: (r.n_slots, r.n_changed) for r in decontaminate.contaminated(docs, frame([(10, ITEM)], "item_id long, text string")).collect()}
    assert set(got) == {1, 3} and got[1][1] == 0 and got[3][1] == 0


def test_every_item_is_searched(frame):
    dense, short = "Compute 12 + 34 * 56 - 78 / 9 + 10 * 11 - 12 now please", "What is 7 times 8?"
    eight = "Find the largest prime below one hundred please"
    items = frame([(1, dense), (2, short), (3, eight), (4, "?!"), (5, "Never there")], "item_id long, text string")
    docs = frame([
        (1, "Well, " + dense + " and more."), (2, dense.replace("34", "35")), (3, "he asked, " + short), (4, short.replace("7", "6")),
        (5, "so they said, " + eight), (6, "so they said: " + eight), (7, None), (8, "somewhat is 7 times 8 or so"),
    ], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(1, 1), (3, 2), (5, 3), (6, 3)}


CLIPS = ("Natalia sold clips to 48 friends in April. Natalia then sold half as many in May. How many clips did Natalia "
         "sell altogether?")  # fmt: skip
JOURNEY = ("after a long and very quiet winter the old teacher travelled to Prague with 12 children and found that nobody "
           "had ever heard about them there")  # fmt: skip
PLAIN = "the slow river carries small stones down from old hills and leaves them along wide banks where tall reeds grow"
PAIRED = "Ann gave 3 red apples to the man and then Ann gave 3 red apples to the woman before 5 came"
VARIED = {
    1: CLIPS.replace("Natalia", "Marta").replace("48", "36"),
    2: "People say: " + CLIPS.replace("Natalia", "Mary Ann Smith").replace("48", "thirty-six"),
    3: JOURNEY.replace("Prague", "New York").replace("12", "twenty one"),
    4: PLAIN.replace("hills", "mountains"),
    5: PLAIN.replace("and leaves", "and quietly leaves"),
    6: PLAIN.replace("carries", "often carries").replace("wide", "very wide"),  # no eight tokens stand but in the middle
    7: PLAIN[0].upper() + PLAIN[1:],
    8: PAIRED,
    9: PAIRED.replace("Ann gave 3", "Bob gave 4"),
    10: PAIRED.replace("then Ann", "then Bob"),
    11: "Natalia walked to the market in April. She then came home in May. How many people did she meet there?",
    12: "How do I say this? the slow river carries small stones and nothing else of this is said here or later on at all",
}


def varied(frame):
    items = frame([(1, CLIPS), (2, JOURNEY), (3, PLAIN), (4, PAIRED), (5, "What is 7 times 8?")], "item_id long, text string")
    rows = [*VARIED.items(), *((k + 100, t) for k, t in CASES.items()), (200, "well, what is 7 times 8"), (201, "what is 7 times 9")]
    return frame(rows, "doc_id long, text string"), items.unionByName(frame([(6, ITEM), (7, None)], "item_id long, text string"))


def test_changed_questions_are_found(frame):
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(*varied(frame)).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 2), (4, 3), (5, 3), (7, 3), (8, 4), (9, 4), (101, 6), (102, 6), (107, 6), (200, 5)}
    assert got[1, 1].n_changed == 4 and got[3, 2].n_changed == 2 and got[8, 4].n_changed == 0


def test_decontamination_sql_has_every_branch(frame, tmp_path):
    docs, items = varied(frame)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as from '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(decontaminate._ORACLE).fetchall()
    assert sorted(want) == sorted(map(tuple, decontaminate.contaminated(docs, items).collect())) and want


def odd_texts(n):
    """Texts of ordinary and of odd pieces: marks, letters of other scripts and beyond U+FFFF, numbers, runs of names."""
    r = random.Random(9)
    parts = ["one", "Two", "SIX", "sixty", "seventeen", "Anna", "Anna2", "McDonald", "USA", "\u00dcber", "\u039f\u0394\u039f\u03a3", "\u0130st", "5", "3.5",
             "1.2.3", "7%", "5 kg", "two km", "_", "-", "'", '"', ")", ".", "!", "?", ":", "\n", "\t", "  ", " ", "\x01", "\x02", "\x06", "\x07",
             "\U0001f600", "\U0001d400\U0001d41b", "\U00010400\U00010428x", "A\u0308b", "\u01c5", "\u6f22", "\u00bd", "a", "the", "The"]
    texts = ["".join(r.choice(parts) + r.choice([" ", " ", "", ". ", "\n"]) for _ in range(r.randint(0, 40))) for _ in range(n)]
    return [(0, None), (1, ""), (2, " "), *((i + 3, t) for i, t in enumerate(texts))]


def test_faster_steps_give_the_tokens_of_the_plain_ones(frame):
    t = F.coalesce(F.col("text"), F.lit(""))
    for pattern, to in decontaminate._STEPS:
        t = F.regexp_replace(t, pattern, re.sub(r"\\(\d)", r"$\1", to))
    got = frame(odd_texts(600), "id long, text string").select(
        F.trim(F.lower(t)).alias("want"), decontaminate.tokens("text").alias("got"), decontaminate.template("text").alias("bare")).collect()
    for x in got:
        assert x.got == x.want and x.bare == re.sub("([\x02-\x04])[^ ]*", r"\1", x.want)


@pytest.mark.parametrize("window", [1, 2, 3, 8])
def test_windows_around_seeds_lose_no_hit(frame, window):
    docs = frame(odd_texts(200), "id long, text string")
    items = frame([(i, t and t[: len(t) // 2]) for i, t in odd_texts(200) if i % 9 == 4], "item long, text string")
    asked = decontaminate._item_windows(items, "item", "text", window, 0)
    seeds = asked.select(F.explode("seeds").alias("seed")).distinct()
    hits = [w.join(asked, "hash").select("id", "place", "item", "at").distinct() for w in (
        decontaminate.windows(docs, "id", "text", window), decontaminate.windows(docs, "id", "text", window, seeds))]
    assert sorted(hits[0].collect()) == sorted(hits[1].collect()) and hits[0].count()
    # every window was a row before; now half a window of them is
    rows = decontaminate._stretches(docs, "id", "text", window).count()
    every = decontaminate.windows(docs, "id", "text", window).select("id", "place").distinct().count()
    assert rows <= every / max(window // 2, 1) + docs.count()
    assert decontaminate.windows(docs, "id", "text", window, seeds.limit(0)).count() == 0


def test_join_beyond_the_broadcast_bound(frame, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    got = decontaminate.contaminated(frame([*CASES.items()], "doc_id long, text string"), frame([(10, ITEM)], "item_id long, text string"))
    assert {r.doc_id for r in got.collect()} == {1, 2, 7}
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


# --- preference pairs -----------------------------------------------------------------------------


def test_preference_pairs(frame):
    ddl = "pair_id long, turn long, role string, text string"
    chosen = [(1, 0, "user", "q"), (1, 1, "assistant", "good"), (1, 1, "assistant", "good"), (2, 0, "user", "a"), (3, 0, "user", "only"),
              (None, 0, "user", "x"), (4, 0, "user", "q"), (4, 1, "assistant", "same"), (4, 70, "user", "late")]
    rejected = [(1, 0, "user", "q"), (1, 1, "assistant", "bad"), (1, 2, "user", None), (2, 0, "user", "b"), (4, 0, "user", "q"),
                (4, 1, "assistant", "same"), (4, 70, "user", "late")]
    out = {(r.pair_id, r.part, r.segment): r for r in preferences.preference_pairs(frame(chosen, ddl), frame(rejected, ddl)).collect()}
    one = out[1, "chosen", 0]
    assert out[1, "prompt", 0].text == "<|im_start|>user\nq<|im_end|>\n" and out[1, "prompt", 0].loss_spans == ""
    start, end = map(int, one.loss_spans.split("-"))
    assert one.text[start:end] == "good<|im_end|>\n" and one.n_turns == 1
    assert out[1, "rejected", 0].n_turns == 2 and out[1, "rejected", 0].text.endswith("<|im_start|>user\n<|im_end|>\n")
    assert (2, "prompt", 0) not in out and out[2, "chosen", 0].loss_spans == ""
    assert (3, "prompt", 0) not in out and (3, "chosen", 0) in out and (3, "rejected", 0) not in out
    assert {k for k in out if k[0] == 4} == {(4, "prompt", 0), (4, "prompt", 1)}
    assert not any(k[0] is None for k in out)
    assert preferences.preference_pairs(frame([], ddl), frame([], ddl)).count() == 0


# --- pipeline -------------------------------------------------------------------------------------


def test_stages_keep_the_columns_and_the_clean(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").where("toxic = 1").collect()}
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, data)
        assert out.schema.names == docs.schema.names, name
        rows = out.collect()
        assert {r.doc_id for r in rows} <= set(before) and all(before[r.doc_id] == r.text for r in rows)
        if name != "toxicity":
            assert len(rows) > 0.6 * len(before)
        else:
            assert len(set(before) - {r.doc_id for r in rows} - toxic) < 0.1 * len(before)


def test_pipeline_stages_on_an_empty_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(0)
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, docs, data).count() == 0, name
