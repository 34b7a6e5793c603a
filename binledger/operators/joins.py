"""Joins with the reference semantics: filtered, temporal, coalescing, enriching.

No side is broadcast by hint unless its size is fixed in code; otherwise Spark decides from the measured size, which
``if_small`` makes known for derived lookup tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binledger.operators.grouping import dedup_first
from binledger.session import stage
from binledger.sources.tables import literal_table


def if_small(side: DataFrame) -> DataFrame:
    """Write a lookup table once, so that its bytes are known and Spark broadcasts it below its threshold.

    Meant for lookup tables derived by joins or groupings, whose size Spark cannot estimate: without it the large
    side would be shuffled on a handful of hot keys. The bound is ``spark.sql.autoBroadcastJoinThreshold``, in bytes.
    The table is computed once, by a job that runs when this is called; the join reads what was written.
    """
    return stage(side, "lookup")


def left_join_on_filter(left: DataFrame, right: DataFrame, on: Sequence[str], right_filter: Column) -> DataFrame:
    """Left join whose ON clause also tests the right side."""
    return left.join(right.where(right_filter), list(on), "left")


#: Versions of one key up to which a probe may simply meet them all.
FEW_VERSIONS = 32


def asof_dim_join(
    left: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    at: Column | str,
    eff: str = "eff_dt",
    disc: str = "disc_dt",
    how: str = "left",
    few: int = FEW_VERSIONS,
) -> DataFrame:
    """Dimension version valid at ``at``: ``eff <= at <= disc``, always with an equality part.

    Overlapping versions fan out, as they do in the warehouse. NULL keys, bounds and times match nothing.

    A key with more than ``few`` versions gets bins of time, about as many as it has versions: a version stands in every
    bin it touches, a probe in one, and the bin joins the key, so a probe meets the versions around it and not all of
    its key's. Keys with few versions have one bin. Bins only say who meets; the exact test follows.
    """
    probes, versions = binned_sides(left, dim, on, at, eff, disc, few)
    match = [F.col(k) == F.col(f"__d_{k}") for k in on] + [F.col("__bin") == F.col("__d_bin")]
    match += [F.col(eff) <= F.col("__at"), F.col(disc) >= F.col("__at")]
    return probes.join(versions, match, how).drop("__at", "__bin", "__d_bin", *[f"__d_{k}" for k in on])


def binned_sides(
    left: DataFrame, dim: DataFrame, on: Sequence[str], at: Column | str, eff: str, disc: str, few: int = FEW_VERSIONS
) -> tuple[DataFrame, DataFrame]:
    """Both sides of ``asof_dim_join``: probes with ``__at`` and ``__bin``, versions with ``__d_<key>`` and ``__d_bin``."""
    at = F.col(at) if isinstance(at, str) else at
    kind = dim.schema[eff].dataType
    keys = [f"__d_{k}" for k in on]

    def number(c: Column) -> Column:
        if isinstance(kind, T.DateType):
            return F.unix_date(c.cast("date")).cast("long")
        return c.cast("timestamp").cast("long") if isinstance(kind, T.TimestampType) else c.cast("long")

    versions = dim.withColumnsRenamed({k: f"__d_{k}" for k in on}).where(F.col(eff) <= F.col(disc))
    begin, end = number(F.col(eff)), number(F.col(disc))
    span = versions.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(begin).alias("__first"), F.max(begin).alias("__last"))
    # no bin begins behind the last version: what is later falls into the last bin, so open ends do not unfold
    many = if_small(span.where(F.col("__n") > few))
    busy = versions.join(many, keys)
    length = F.least(end, F.col("__last")) - begin
    widths = busy.groupBy(*keys, "__n", "__first", "__last").agg(F.sum(length).alias("__length"))
    # a version touches one bin more than its length holds; all of a key's together not more than five times their number
    width = F.greatest((F.col("__last") - F.col("__first")) / F.col("__n"), F.col("__length") / (4 * F.col("__n")), F.lit(1.0))
    widths = if_small(widths.select(*keys, F.ceil(width).alias("__width"), "__first", "__last"))

    place = lambda x: F.floor((F.least(x, F.col("__last")) - F.col("__first")) / F.col("__width"))
    bins = F.when(F.col("__width").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(place(begin), place(end)))
    there = versions.join(widths, keys, "left").withColumn("__d_bin", F.explode(bins))
    probe = left.withColumn("__at", at)
    spread = widths.withColumnsRenamed({f"__d_{k}": f"__w_{k}" for k in on})
    here = probe.join(spread, [F.col(k) == F.col(f"__w_{k}") for k in on], "left")
    here = here.withColumn("__bin", F.when(F.col("__width").isNull(), F.lit(0).cast("long")).otherwise(place(number(F.col("__at")))))
    extra = ["__width", "__first", "__last"]
    return here.drop(*extra, *[f"__w_{k}" for k in on]), there.drop(*extra)


#: Rows of a lookup table up to which rows may simply meet it.
FEW_LOOKED_UP = 50_000


def looked_up(
    rows: DataFrame, lookup: DataFrame, key: str, dealt_by: str, asked: DataFrame | None = None, few: int = FEW_LOOKED_UP
) -> DataFrame:
    """``rows.join(lookup, key)`` for wide rows that lie dealt by ``dealt_by`` and are to stay so.

    To a lookup table of more than ``few`` rows only the distinct pairs of both keys travel, and come back with what was
    found; as pairs and rows are then dealt alike, by one of the keys they join on, the rows are not shuffled. ``asked``
    has the two keys of all rows, and maybe of others, where these are cheaper to read than ``rows``. NULL keys match
    nothing, in ``dealt_by`` neither.
    """
    if lookup.limit(few + 1).count() <= few:
        return rows.join(lookup, key)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = (rows if asked is None else asked).select(dealt_by, key).dropna().distinct()
    return rows.join(pairs.join(lookup, key).repartition(tasks, dealt_by), [dealt_by, key])


def full_join_coalesce(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    prefer_left: Sequence[str] = (),
    prefer_right: Sequence[str] = (),
    default_zero: Sequence[str] = (),
) -> DataFrame:
    """Full outer join; keys come from either side.

    ``prefer_left``/``prefer_right`` columns exist on both sides and take the first non-NULL value;
    ``default_zero`` columns exist on one side and are 0 where that side is absent. Any other column
    stays as it is on its side.
    """
    both = [*on, *prefer_left, *prefer_right]
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in both})
    joined = left.join(renamed, [left[k] == renamed[f"__r_{k}"] for k in on], "full")
    picked = [F.coalesce(left[c], F.col(f"__r_{c}")).alias(c) for c in [*on, *prefer_left]]
    picked += [F.coalesce(F.col(f"__r_{c}"), left[c]).alias(c) for c in prefer_right]
    picked += [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in default_zero]
    rest = [c for c in [*left.columns, *right.columns] if c not in {*both, *default_zero}]
    return joined.select(*picked, *dict.fromkeys(rest))


def keep_listed(df: DataFrame, wanted: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(wanted, list(on), "left_semi")


#: Bits of a Bloom filter per listed key, bits of one of its blocks, and bytes it may have at most.
BLOOM_BITS, BLOCK_BITS, BLOOM_BYTES = 16, 32768, 64 << 20


def bloom_filtered(df: DataFrame, wanted: DataFrame, on: Sequence[str], most_bytes: int = BLOOM_BYTES) -> DataFrame:
    """Rows of ``df`` whose key may be in ``wanted``: all that are, and about one in seventy of the others.

    A blocked Bloom filter as a table: a key's hash chooses a block of 32,768 bits and two bits in it; a block's bits are
    set by one partial aggregation, and the blocks, whose number follows from the number of keys and is bounded by
    ``most_bytes``, are broadcast. Beyond the bound the filter lets more rows pass, never fewer. Rows with a NULL in
    the key do not pass.
    """
    listed = wanted.select(*on).dropna()
    count = listed.agg(F.approx_count_distinct(F.xxhash64(*on))).first()[0]
    blocks = max(1, min(-(-count * BLOOM_BITS // BLOCK_BITS), most_bytes // (BLOCK_BITS // 8)))
    keys = [F.col(c) for c in on]
    block = F.pmod(F.xxhash64(*keys), F.lit(blocks))
    second = F.xxhash64(*keys, F.lit(1))
    bits = [F.pmod(second, F.lit(BLOCK_BITS)), F.pmod(F.shiftright(second, 32), F.lit(BLOCK_BITS))]
    table = listed.select(block.alias("__block"), F.explode(F.array(*bits)).alias("__bit")).groupBy("__block").agg(
        F.expr("bitmap_construct_agg(__bit)").alias("__bits")
    )
    return _tested(df, table, block, bits)


def _tested(df: DataFrame, table: DataFrame, block: Column, bits: list[Column]) -> DataFrame:
    probes = df.withColumn("__block", block).withColumns({f"__bit{i}": b.cast("int") for i, b in enumerate(bits)})
    hit = F.lit(True)
    for i in range(len(bits)):
        at = F.col(f"__bit{i}")
        byte = F.conv(F.hex(F.expr(f"substring(__bits, __bit{i} div 8 + 1, 1)")), 16, 10).cast("int")
        hit = hit & (F.getbit(byte, at % 8) == 1)
    # as many rows as the filter has blocks
    return probes.join(F.broadcast(table), "__block").where(hit).select(*df.columns)


def keep_listed_of_many(df: DataFrame, wanted: DataFrame, on: Sequence[str], most_bytes: int = BLOOM_BYTES) -> DataFrame:
    """``keep_listed`` for a list too long to be broadcast: a Bloom filter drops most other rows before the shuffle."""
    # an inner join with distinct keys, as the optimizer moves a semi join below the filter's join
    listed = wanted.select(*on).dropna().distinct()
    return bloom_filtered(df, wanted, on, most_bytes).join(listed, list(on)).select(*df.columns)


def drop_listed(df: DataFrame, unwanted: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(unwanted, list(on), "left_anti")


def code_domain(
    codes: DataFrame,
    domain: str,
    code_name: str,
    text_name: str,
    extra: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """One domain of the shared code table: active rows, blanks removed, literal rows added, one row per code."""
    squeeze = lambda c: F.regexp_replace(c, " ", "")
    listed = codes.where((F.col("domain") == domain) & (F.col("status") == "A")).select(
        squeeze(F.col("code")).alias(code_name), squeeze(F.col("description")).alias(text_name)
    )
    if extra:
        names, texts = zip(*extra)
        added = literal_table(codes.sparkSession, {code_name: names, text_name: texts})
        listed = listed.unionByName(added)
    return dedup_first(listed, [code_name], [F.col(text_name).asc_nulls_first()])


def code_enrich(df: DataFrame, domains: Mapping[str, DataFrame]) -> DataFrame:
    """Left join one description per code column; unknown codes keep a NULL description.

    Code columns have a handful of values, so the small tables are written first to be broadcast.
    """
    for column, table in domains.items():
        df = df.join(if_small(table), column, "left")
    return df


def unmatched_codes(df: DataFrame, descriptions: Sequence[str]) -> DataFrame:
    """Rows where at least one description is missing."""
    missing = F.lit(False)
    for name in descriptions:
        missing = missing | F.col(name).isNull()
    return df.where(missing)


def key_fallback_join(
    df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, translated: Column, out: str
) -> DataFrame:
    """Replace ``key`` by an expression over the matching lookup row, keep it where none matches.

    All columns of ``df`` stay, also those that share a name with one of the lookup. Of lookup rows with one key the first in column order counts, so no row is multiplied.
    """
    rest = [F.col(c).asc_nulls_last() for c in lookup.columns if c != lookup_key]
    lookup = dedup_first(lookup, [lookup_key], rest or [F.col(lookup_key).asc()])
    # only the key and the translation meet the rows, under names of their own
    pairs = lookup.select(F.col(lookup_key).alias("__lookup_key"), translated.alias("__translated"))
    met = df.join(pairs, F.col(key) == F.col("__lookup_key"), "left")
    return met.withColumn(out, F.coalesce("__translated", F.col(key))).drop("__lookup_key", "__translated")
