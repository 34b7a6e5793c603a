"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

A text becomes a row of tokens: words in lower case, and numbers (digits or English number words), names (a capital and
small letters; a run of them is one name) and units (behind a number) with a mark of their type. Its **template** keeps
the mark in place of the value, so a question whose numbers and names were changed has the template of the original. A
lone capitalised word at the start of a sentence has a mark of its own and two readings, as a word and as a name; a window
over such words meets others under either. All windows of ``WINDOW`` template tokens of the documents meet those of the
benchmark in a hash join. Windows are made around seeds only: of every few windows that begin side by side, the tokens
that all of them share are looked up among the same stretches of the benchmark first, so none that meets is left out.

A document repeats an item if windows of one alignment are ``COVER`` of the item's, or hold ``SPREAD`` of its tokens,
and the **slots** in them are consistent: each value of the item stands for one value of the document at all its places.
Every alignment of that cover is looked at, and one consistent is enough. Where none is, alignments that lie up to
``SLACK`` tokens apart are taken together, as a word put in or left out shifts the rest of an item: each of the item's
windows then counts in the alignment of most windows.

The benchmark's windows, seeds and bytes are counted first and broadcast only up to ``BROADCAST_ROWS`` and
``BROADCAST_BYTES``; more windows are joined by a shuffle, more seeds are left aside and every window is made. Slots are compared for the found pairs only; capitalised first words count as slots where
both sides have one.

Items without a window that holds ``WORDS`` words (those of fewer than ``WINDOW`` tokens, or dense in values) are found
by their exact words and values in a row; they count as one window.

Defined results: NULL and empty texts match nothing, nor do items without a letter or digit. Rows of documents
with one id are one document, NULL ids match nothing. Repeated items with one id count once; with a NULL id they
match nothing.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binledger.llm.registry import query, table
from binledger.session import stage

#: Template tokens of a window, words among them at least, share of an item's windows that must be there.
WINDOW, WORDS, COVER = 8, 4, 0.5
#: Share of an item's tokens inside found windows that does as well; tokens by which a shift may change inside an item.
SPREAD, SLACK = 0.8, 4
#: Benchmark windows (16 bytes of key and a few of position each) and bytes of items that are broadcast at most.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20
#: Units of measure that count as such behind a number.
UNITS = (
    "mm", "cm", "dm", "m", "km", "in", "ft", "yd", "mi", "inches", "feet", "yards", "miles", "meters", "metres",
    "kilometers", "kilometres", "mg", "g", "kg", "t", "oz", "lb", "lbs", "grams", "kilograms", "pounds", "tons", "ml",
    "cl", "l", "liters", "litres", "gallons", "ms", "s", "sec", "min", "h", "hr", "hrs", "seconds", "minutes", "hours",
    "days", "weeks", "months", "years", "usd", "eur", "dollars", "cents", "euros", "percent", "degrees", "v", "w", "kw",
    "hz", "khz", "mhz", "ghz", "kb", "mb", "gb", "tb", "mph", "kmh",
)

#: Numbers in words.
NUMBERS = (
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen",
    "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty", "fifty", "sixty",
    "seventy", "eighty", "ninety", "hundred", "thousand", "million", "billion",
)

#: (pattern, replacement) in order; \x01 marks a lone capitalised word at the start of a sentence, \x02 a name, \x03 a
#: number, \x04 a unit; \x06 and \x07 stand behind names and number words until runs of them are one.
_STEPS = [
    (r"[\x01-\x07_]", " "),
    (r"([0-9])[.,]([0-9])", r"\1_\2"),
    (r"([0-9])[.,]([0-9])", r"\1_\2"),  # once more for the middle of 1.2.3
    (r"(^|[.!?:;][\"')\]]*\s+|\n\s*)(\p{Lu}\p{Ll})", "\\1\x01\\2"),
    (r"(^|[^\p{L}\p{N}\x01])(\p{Lu}\p{Ll}[\p{L}\p{N}]*)", "\\1 \x02\\2\x06"),
    (r"\x01([\p{L}\p{N}]+)  \x02", " \x02\\1_"),
    ("\x06  \x02", "_"),
    (r"(^|[^\p{L}\p{N}\x01_])([0-9]+(?:_[0-9]+)*)", "\\1 \x03\\2"),
    (r"(\x03[0-9_]+) *%", "\\1 \x04percent "),
    (r"(\x03[0-9_]+) *(?i:(" + "|".join(UNITS) + r"))([^\p{L}\p{N}]|$)", "\\1 \x04\\2\\3"),
    (r"[^\p{L}\p{N}\x01-\x04_]+", "  "),
    (r"(^| )\x01?(?i:(" + "|".join(NUMBERS) + "))( |$)", "\\1\x03\\2\x07\\3"),
    ("\x07  \x03", "_"),
    ("\x07", ""),
    ("  ", " "),
    (r"(\x03[A-Za-z_]+) (?i:(" + "|".join(UNITS) + "))( |$)", "\\1 \x04\\2\\3"),
]



def _any_of(words: list[str]) -> str:
    """A pattern of the words that reads a common beginning once."""
    rest = {w[0]: [v[1:] for v in words if v[:1] == w[0]] for w in words if w}
    each = "|".join(head + _any_of(tails) for head, tails in rest.items())
    if "" in words:
        return f"(?:{each})?" if each else ""
    return f"(?:{each})" if len(rest) > 1 else each


# a letter beyond U+FFFF among those looked back at: without one, Java looks back at half of such letters
_NAME = "(?=\\p{Lu})(?<![\\p{L}\\p{N}\x01\U00010000])\\p{Lu}\\p{Ll}[\\p{L}\\p{N}]*"
_GAP = r"[^\p{L}\p{N}\x01-\x04_]"

#: Steps as Java's patterns find them faster, with the same result: behind \x05, which stands before every text here,
#: no step has to look for the beginning; what begins few matches is looked at first; and looking ahead shares the space
#: between two words, so that one is enough and stays as it is.
_QUICK = {
    _STEPS[3]: (r"(?=[.!?:;\n\x05])([.!?:;][\"')\]]*\s+|\n\s*|\x05)(\p{Lu}\p{Ll})", "\\1\x01\\2"),
    _STEPS[4]: (f"({_NAME})", " \x02\\1\x06"),
    _STEPS[10]: (f"{_GAP}(?:(?<! ){_GAP}*|{_GAP}+)", " "),
    _STEPS[11]: (r" \x01?(?i:(" + _any_of([*NUMBERS]) + "))(?= |$)", " \x03\\1\x07"),
    _STEPS[12]: ("\x07 \x03", "_"),
    _STEPS[14]: None,
}
#: The same without the values of names.
_BARE = _QUICK | {
    _STEPS[4]: (_NAME, " \x02\x06"),
    _STEPS[5]: (r"\x01[\p{L}\p{N}]+  \x02", " \x02"),
    _STEPS[6]: ("\x06  \x02", ""),
}


def _run(text: str, quick: dict) -> Column:
    start = F.coalesce(F.col(text), F.lit(""))

    def step(t: Column, pattern: str, to: str) -> Column:
        if pattern.strip("\x02\x03\x06\x07 ") == "":
            return F.replace(t, F.lit(pattern), F.lit(to))
        return F.regexp_replace(t, pattern, re.sub(r"\\(\d)", r"$\1", to))

    def run(steps: list[tuple[str, str]]) -> Column:
        first = F.concat(F.lit("\x05"), step(start, *steps[0]))
        return reduce(lambda t, s: step(t, *s), filter(None, [quick.get(s, s) for s in steps[1:]]), first)

    # most texts have no digit: the steps that need one are left out for them
    wordy = [s for s in _STEPS if "0-9" not in s[0]]
    return F.when(start.rlike("[0-9]"), run(_STEPS)).otherwise(run(wordy))


def tokens(text: str) -> Column:
    """Tokens of a text as one string, a space between them; values follow their mark."""
    return F.trim(F.lower(_run(text, _QUICK)))


def template(text: str) -> Column:
    """The tokens of a text with the mark alone in place of a value."""
    return F.lower(F.trim(F.regexp_replace(_run(text, _BARE), "([\x02-\x04])[^ ]+", "$1")))


def windows(df: DataFrame, key: str, text: str, window: int, seeds: DataFrame | None = None) -> DataFrame:
    """(key, place, hash) of every window of the template of ``text`` in its readings; places begin with 1.

    With ``seeds`` only windows that hold one of them where all windows of a stretch do; rows may repeat.
    """
    parts = _stretches(df, key, text, window)
    if seeds is not None:
        shared = F.substring_index(F.substring_index("stretch", " ", window), " ", -_seed(window))
        parts = parts.withColumn("seed", shared).withColumn("seed", F.explode(_readings("seed")))
        parts = parts.withColumn("seed", F.xxhash64("seed")).join(F.broadcast(seeds), "seed", "left_semi")
    each = parts.select(key, "begin", F.posexplode(_windows_of(F.rtrim("stretch"), window)).alias("place", "part"))
    each = each.select(key, (F.col("begin") + F.col("place")).alias("place"), F.explode(_readings("part")).alias("hash"))
    return each.withColumn("hash", F.xxhash64("hash"))


def _seed(window: int) -> int:
    """Tokens that all windows of a stretch share: half a window of windows begin in a stretch."""
    return window - max(window // 2, 1) + 1


def _stretches(df: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """(key, begin, stretch): the windows of a text, cut into runs of half a window of them; ends may hold fewer."""
    step = window + 1 - _seed(window)
    word = "[^ ]++ "  # written out as often as it stands there, which Java's patterns run faster than a count
    more = reduce(lambda rest, _: f"(?:{word}{rest})?", range(step - 1), "")
    ahead = F.lit(f"(?<![^ ])(?=({word * window}{more})){word * step}")
    found = F.regexp_extract_all(F.concat(template(text), F.lit(" ")), ahead, F.lit(1))
    return df.select(key, F.posexplode(found).alias("begin", "stretch")).withColumn("begin", F.col("begin") * step + 1)


def _readings(part: str) -> Column:
    """A window with the first words of sentences as words and, where there are any, as names."""
    word = F.replace(F.col(part), F.lit("\x01"), F.lit(""))
    name = F.regexp_replace(part, "\x01[^ ]*", "\x02")
    return F.when(F.contains(F.col(part), F.lit("\x01")), F.array(word, name)).otherwise(F.array(part))


def _windows_of(tokens: Column, window: int) -> Column:
    # before every token, what the next tokens are: one pass of a pattern over the whole text
    return F.regexp_extract_all(F.concat(tokens, F.lit(" ")), F.lit(f"(?<![^ ])(?=((?:[^ ]+ ){{{window}}}))"), F.lit(1))


def _marked(part: str | Column) -> Column:
    return F.size(F.filter(F.split(part, " "), lambda w: w.rlike("^[\x02-\x04]")))


def _item_windows(items: DataFrame, key: str, text: str, window: int, words: int) -> DataFrame:
    """Windows of the benchmark, in each reading, that hold enough words to tell something, and their seeds."""
    parts = items.select(key, F.posexplode(_windows_of(template(text), window)).alias("at", "part"))
    read = parts.select(key, (F.col("at") + 1).alias("at"), F.explode(_readings("part")).alias("part"))
    seeds = F.transform(_windows_of(F.rtrim("part"), _seed(window)), lambda s: F.xxhash64(F.rtrim(s)))
    return read.where(window - _marked("part") >= words).select(
        key, "at", F.xxhash64("part").alias("hash"), seeds.alias("seeds")).distinct()


def _plain(text: str) -> Column:
    """Words and values of a text in lower case, a space between them."""
    return F.trim(F.lower(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^\p{L}\p{N}]+", " ")))


def _literal(docs: DataFrame, bench: DataFrame, window: int, words: int, few: bool) -> DataFrame | None:
    """(document, item, slots) of items without a usable window: documents that hold all their words in a row."""
    usable = F.exists(_windows_of(template("_text"), window), lambda p: window - _marked(p) >= words)
    rest = bench.where(~usable).select("_item", _plain("_text").alias("whole"), _marked(tokens("_text")).alias("n_slots"))
    rest = rest.where("whole <> ''").distinct().withColumn("k", F.least(F.size(F.split("whole", " ")), F.lit(window)))
    begin = F.array_join(F.slice(F.split("whole", " "), F.lit(1), F.col("k")), " ")
    rest = stage(rest.withColumn("hash", F.xxhash64(begin)), "short-items")
    sizes = sorted(r.k for r in rest.select("k").distinct().collect())
    if not sizes:
        return None
    plain = docs.select("_doc", _plain("_text").alias("t"))
    # at every place the beginnings of all the lengths that items have
    ahead = F.lit(f"(?<![^ ])(?=((?:[^ ]+ ){{1,{sizes[-1]}}}))")
    parts = F.regexp_extract_all(F.concat("t", F.lit(" ")), ahead, F.lit(1))
    starts = plain.select("_doc", F.explode(F.array_distinct(parts)).alias("part"))
    split = F.split(F.rtrim(F.col("part")), " ")
    starts = starts.select("_doc", split.alias("w")).select("_doc", "w", F.explode(F.array(*map(F.lit, sizes))).alias("k"))
    begin = F.array_join(F.slice("w", F.lit(1), F.col("k")), " ")
    starts = starts.where(F.size("w") >= F.col("k")).select("_doc", "k", F.xxhash64(begin).alias("hash"))
    met = starts.join(F.broadcast(rest) if few else rest, ["k", "hash"])
    whole = met.select("_doc", "_item", "whole", "n_slots").distinct().join(plain, "_doc")
    held = F.contains(F.concat(F.lit(" "), "t", F.lit(" ")), F.concat(F.lit(" "), "whole", F.lit(" ")))
    return whole.where(held).groupBy("_doc", "_item").agg(F.max("n_slots").alias("n_slots"))


def contaminated(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", window: int = WINDOW, words: int = WORDS, cover: float = COVER, spread: float = SPREAD,
    slack: int = SLACK,
) -> DataFrame:
    """One row per document and item that it repeats: windows found and asked for, slots and how many have changed."""
    docs = documents.select(F.col(key).alias("_doc"), F.col(text).alias("_text")).where("_doc is not null")
    bench = items.select(F.col(item_key).alias("_item"), F.col(item_text).alias("_text")).where("_item is not null")
    asked = stage(_item_windows(bench, "_item", "_text", window, words), "item-windows")
    seeds = stage(asked.select(F.explode("seeds").alias("seed")).distinct(), "item-seeds")
    asked = asked.drop("seeds")
    size = bench.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    few = size <= BROADCAST_BYTES and asked.count() <= BROADCAST_ROWS
    length = bench.groupBy("_item").agg(F.max(F.size(F.split(tokens("_text"), " "))).alias("length"))
    total = asked.groupBy("_item").agg(F.countDistinct("at").alias("asked")).join(length, "_item")
    near = seeds if few and seeds.count() <= BROADCAST_ROWS else None
    hits = windows(docs, "_doc", "_text", window, near).join(F.broadcast(asked) if few else asked, "hash")
    lines = hits.groupBy("_doc", "_item", (F.col("place") - F.col("at")).alias("shift")).agg(F.collect_set("at").alias("ats"))
    lines = stage(lines.join(total, "_item"), "lines")

    inside = F.size(F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, a + window - 1)))))
    enough = (F.size("ats") >= F.col("asked") * cover) | (inside >= F.col("length") * spread)
    # a first word that is a name elsewhere in its item is a name
    values = _values(bench).withColumn("first", F.min("first").over(Window.partitionBy("_item", "value"))).distinct()

    # every alignment that enough windows agree on
    pairs = lines.where(enough).select("_doc", "_item", F.col("shift").alias("line"), "ats", "asked", "shift")
    wanted = pairs.join(F.broadcast(values) if few else values, "_item")
    wanted = wanted.select(
        "_doc", "_item", "line", "at", "value", "first", (F.col("at") + F.col("shift")).alias("place"),
        F.exists("ats", lambda a: (a <= F.col("at")) & (F.col("at") < a + window)).alias("inside"),
    )
    out = stage(_consistent(pairs.withColumn("found", F.size("ats")), _slots(docs, wanted)), "pairs")

    # where none is consistent: alignments of nearly one shift, every window of the item in that of most windows
    other = lines.join(out, ["_doc", "_item"], "left_anti").withColumn("n", F.size("ats"))
    band = F.floor(F.col("shift") / slack)
    near = other.select("_doc", "_item", "asked", "length", "shift", "n", F.explode("ats").alias("at"),
                        F.array(band, band - 1).alias("bands"))
    near = near.withColumn("line", F.explode("bands")).groupBy("_doc", "_item", "asked", "length", "line", "at").agg(
        (-F.max(F.struct("n", (-F.col("shift")).alias("less")))["less"]).alias("shift"))
    bands = near.groupBy("_doc", "_item", "asked", "length", "line").agg(
        F.collect_list("at").alias("ats"), F.collect_list(F.struct("at", "shift")).alias("picks"))
    bands = stage(bands.where(enough), "bands")
    each = bands.select("_doc", "_item", "line", F.explode("picks").alias("p")).select(
        "_doc", "_item", "line", "p.shift", F.explode(F.sequence(F.col("p.at"), F.col("p.at") + window - 1)).alias("at")
    )
    each = each.distinct().join(F.broadcast(values) if few else values, ["_item", "at"])
    wanted = each.select("_doc", "_item", "line", "at", "value", "first", (F.col("at") + F.col("shift")).alias("place"),
                         F.lit(True).alias("inside"))
    out = out.unionByName(_consistent(bands.withColumn("found", F.size("ats")), _slots(docs, wanted)))

    literal = _literal(docs, bench, window, words, few)
    if literal is not None:  # an item id may have a text of either kind
        literal = literal.join(out, ["_doc", "_item"], "left_anti").select(
            "_doc", "_item", F.lit(1).alias("found"), F.lit(1).alias("asked"), "n_slots", F.lit(0).alias("n_changed")
        )
        out = out.unionByName(literal)
    return out.select(
        F.col("_doc").alias(key), F.col("_item").alias(item_key), F.col("found").cast("long").alias("n_windows"),
        F.col("asked").cast("long").alias("n_asked"), F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots"),
        F.coalesce("n_changed", F.lit(0)).cast("long").alias("n_changed"),
    )


def _consistent(pairs: DataFrame, slots: DataFrame) -> DataFrame:
    """Of the consistent alignments of a document and item that of most windows."""
    fine = pairs.join(slots, ["_doc", "_item", "line"], "left").where("coalesce(consistent, true)")
    best = F.struct("found", -F.col("line"), "asked", "n_slots", "n_changed")
    out = fine.groupBy("_doc", "_item").agg(F.max(best).alias("b")).select("_doc", "_item", "b.*")
    return out.select("_doc", "_item", "found", "asked", "n_slots", "n_changed")


def _values(texts: DataFrame, key: str = "_item", at: str = "at", value: str = "value") -> DataFrame:
    """(key, place, value, first) of all slots; a capitalised first word of a sentence is a name here, and marked."""
    each = texts.select(key, F.posexplode(F.split(tokens("_text"), " ")).alias(at, value))
    each = each.where(F.col(value).rlike("^[\x01-\x04]")).withColumn(at, F.col(at) + 1)
    first = F.startswith(value, F.lit("\x01")).alias("first")
    return each.select(key, at, F.translate(value, "\x01", "\x02").alias(value), first).distinct()


def _slots(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(document, item, line): number of slots, changed ones, and whether every value of the item has one counterpart.

    Only slots inside the windows that were found can speak against an alignment, and none of values that are but first
    words in the item; the others are counted too where they agree with it.
    """
    there = _values(docs.join(wanted.select("_doc").distinct(), "_doc", "left_semi"), "_doc", "place", "other")
    met = wanted.join(there.drop("first"), ["_doc", "place"]).withColumn("inside", F.col("inside") & ~F.col("first"))
    place = F.struct("at", "other", "inside")
    values = met.groupBy("_doc", "_item", "line", "value").agg(F.collect_set(place).alias("m"))
    others = lambda m: F.size(F.array_distinct(F.transform(m, lambda x: x["other"])))
    count = lambda m: F.size(F.array_distinct(F.transform(m, lambda x: x["at"])))
    changed = lambda m: count(F.filter(m, lambda x: x["other"] != F.col("value")))
    near = F.filter("m", lambda x: x["inside"])
    values = values.select("_doc", "_item", "line", *[
        c(m).alias(f"{name}{of}") for of, m in (("", F.col("m")), ("_in", near))
        for name, c in (("others", others), ("n", count), ("changed", changed))
    ])
    sums = values.groupBy("_doc", "_item", "line").agg(
        F.max("others").alias("_o"), F.max("others_in").alias("_i"),
        *[F.sum(c).alias(c) for c in ("n", "changed", "n_in", "changed_in")],
    )
    whole = F.col("_o") == 1
    return sums.select(
        "_doc", "_item", "line", F.when(whole, F.col("n")).otherwise(F.col("n_in")).alias("n_slots"),
        F.when(whole, F.col("changed")).otherwise(F.col("changed_in")).alias("n_changed"),
        (F.col("_i") <= 1).alias("consistent"),
    )


def _sql_tokens(text: str) -> str:
    """The steps of ``tokens`` in the other engine's spelling."""
    out = f"coalesce({text}, '')"
    for pattern, to in _STEPS:
        out = f"regexp_replace({out}, '{pattern.replace(chr(39), chr(39) * 2)}', e'{_escaped(to)}', 'g')"
    return f"trim(lower({out}))"


def _escaped(to: str) -> str:
    return to.replace("\\", "\\\\").translate({n: f"\\x{n:02x}" for n in range(1, 8)})


_MARKS = "(2, 3, 4)"
_SPANS = f"len(list_distinct(flatten(list_transform(ats, lambda a: range(a, a + {WINDOW})))))"
_ENOUGH = f"(len(ats) >= asked * {COVER} or {_SPANS} >= length * {SPREAD})"
_ORACLE = f"""
with d as (
  select doc_id, string_split({_sql_tokens("text")}, ' ') as t from documents where doc_id is not null
), b as (
  select item_id, text, string_split({_sql_tokens("text")}, ' ') as t from (select distinct item_id, text from benchmark)
  where item_id is not null
), dw as (
  select doc_id, unnest(t) as value, generate_subscripts(t, 1) as place from d
), bw as (
  select item_id, text, unnest(t) as value, generate_subscripts(t, 1) as place from b
), dt as (
  select *, case when ascii(value) in {_MARKS} then value[1] when ascii(value) = 1 then value[2:] else value end as w,
   case when ascii(value) in {_MARKS} then value[1] when ascii(value) = 1 then e'\\x02' else value end as nm from dw
), bt as (
  select *, case when ascii(value) in {_MARKS} then value[1] when ascii(value) = 1 then value[2:] else value end as w,
   case when ascii(value) in {_MARKS} then value[1] when ascii(value) = 1 then e'\\x02' else value end as nm from bw
), dboth as (
  select doc_id, place, unnest([string_agg(w, ' ') over f, string_agg(nm, ' ') over f]) as win, count(*) over f as n from dt
  window f as (partition by doc_id order by place rows between current row and {WINDOW - 1} following)
), dwin as (
  select distinct * from dboth where n = {WINDOW}
), bboth as (
  select item_id, text, place as pos, count(*) over f as n,
   unnest([{{'win': string_agg(w, ' ') over f, 'words': sum((coalesce(ascii(w), 0) not in {_MARKS})::int) over f}},
           {{'win': string_agg(nm, ' ') over f, 'words': sum((coalesce(ascii(nm), 0) not in {_MARKS})::int) over f}}]) as x
  from bt window f as (partition by item_id, text order by place rows between current row and {WINDOW - 1} following)
), told as (
  select distinct item_id, text, pos, x.win as win from bboth where n = {WINDOW} and x.words >= {WORDS}
), asked as (
  select distinct item_id, pos, win from told
), total as (
  select item_id, asked, length from (select item_id, count(distinct pos) as asked from asked group by all)
  join (select item_id, max(len(t)) as length from b group by all) using (item_id)
), lines as (
  select doc_id, item_id, place - pos as shift, list(distinct pos) as ats
  from dwin join asked using (win) group by all
), pairs as (
  select * from lines join total using (item_id) where {_ENOUGH}
), bmarked as (
  select distinct item_id, place, ascii(value) = 1 as first, case when ascii(value) = 1 then e'\\x02' || value[2:] else value end as value
  from bw where ascii(value) in (1, 2, 3, 4)
), bval as (
  select distinct item_id, place, value, bool_and(first) over (partition by item_id, value) as first from bmarked
), dval as (
  select distinct doc_id, place, case when ascii(value) = 1 then e'\\x02' || value[2:] else value end as other
  from dw where ascii(value) in (1, 2, 3, 4)
), met as (
  select p.doc_id, p.item_id, p.shift, v.value, v.place, o.other,
   len(list_filter(p.ats, lambda a: a <= v.place and v.place < a + {WINDOW})) > 0 and not v.first as inside
  from pairs p join bval v using (item_id) join dval o on o.doc_id = p.doc_id and o.place = v.place + p.shift
), vals as (
  select doc_id, item_id, shift, value, count(distinct other) as o, count(distinct place) as n,
   count(distinct place) filter (where other <> value) as c, count(distinct other) filter (where inside) as o_in,
   count(distinct place) filter (where inside) as n_in, count(distinct place) filter (where inside and other <> value) as c_in
  from met group by all
), slots as (
  select doc_id, item_id, shift, max(o_in) as o_in, case when max(o) = 1 then sum(n) else sum(n_in) end as n_slots,
   case when max(o) = 1 then sum(c) else sum(c_in) end as n_changed from vals group by all
), exact as (
  select doc_id, item_id, len(ats) as found, asked, n_slots, n_changed
  from pairs left join slots using (doc_id, item_id, shift) where coalesce(o_in, 0) <= 1
  qualify row_number() over (partition by doc_id, item_id order by len(ats) desc, shift) = 1
), tries as (
  select doc_id, item_id, shift, len(ats) as n, unnest(ats) as pos from lines anti join exact using (doc_id, item_id)
), banded as (
  select doc_id, item_id, pos, shift, n, unnest([floor(shift / {SLACK}), floor(shift / {SLACK}) - 1])::int as line from tries
), picks as (
  select doc_id, item_id, line, pos, shift from banded
  qualify row_number() over (partition by doc_id, item_id, line, pos order by n desc, shift) = 1
), bands as (
  select * from (select doc_id, item_id, line, list(pos) as ats from picks group by all) join total using (item_id)
  where {_ENOUGH}
), bmet as (
  select distinct k.doc_id, k.item_id, k.line, v.value, v.place, o.other, not v.first as inside
  from picks k join bands using (doc_id, item_id, line)
  join bval v on v.item_id = k.item_id and v.place >= k.pos and v.place < k.pos + {WINDOW}
  join dval o on o.doc_id = k.doc_id and o.place = v.place + k.shift
), bvals as (
  select doc_id, item_id, line, value, count(distinct other) as o, count(distinct place) as n,
   count(distinct place) filter (where other <> value) as c, count(distinct other) filter (where inside) as o_in,
   count(distinct place) filter (where inside) as n_in, count(distinct place) filter (where inside and other <> value) as c_in
  from bmet group by all
), bslots as (
  select doc_id, item_id, line, max(o_in) as o_in, case when max(o) = 1 then sum(n) else sum(n_in) end as n_slots,
   case when max(o) = 1 then sum(c) else sum(c_in) end as n_changed from bvals group by all
), loose as (
  select doc_id, item_id, len(ats) as found, asked, n_slots, n_changed
  from bands left join bslots using (doc_id, item_id, line) where coalesce(o_in, 0) <= 1
  qualify row_number() over (partition by doc_id, item_id order by len(ats) desc, line) = 1
), windowed as (
  select * from exact union all select * from loose
), rest as (
  select item_id, trim(lower(regexp_replace(text, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))) as whole,
   len(list_filter(t, lambda x: ascii(x) in {_MARKS})) as n_slots
  from b where (item_id, text) not in (select item_id, text from told) and text is not null
), literal as (
  select doc_id, item_id, 1 as found, 1 as asked, max(n_slots) as n_slots, 0 as n_changed
  from documents join rest on whole <> '' and contains(
   ' ' || trim(lower(regexp_replace(documents.text, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))) || ' ', ' ' || whole || ' ')
  where doc_id is not null group by doc_id, item_id
)
select doc_id, item_id, found::bigint as n_windows, asked::bigint as n_asked,
       coalesce(n_slots, 0)::bigint as n_slots, coalesce(n_changed, 0)::bigint as n_changed
from (select * from windowed union all select * from literal anti join windowed using (doc_id, item_id))
"""


@query("op6_template_decontamination", _ORACLE)
def op6(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return contaminated(docs, table(spark, folder, "benchmark").select("item_id", "text"))
