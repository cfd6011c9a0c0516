"""Mixing sources to target weights, with DataFrame functions only.

The words of each source form one stream, cut into blocks of ``block`` words. A
mix is a number of output slots, each filled with one block. How many slots each
source gets in each output shard is a multinomial draw given the sources' totals:
a pseudorandom permutation throws all slots onto the shards. A source's slots are
then numbered; slot k takes block ``perm_pass(k mod n_blocks)`` of pass
``k div n_blocks``, so no block is taken twice before all are taken once, and two
passes bound every document by twice its size. Slots and blocks meet in an equi-join
on (source, block), of which no key holds more than a block; it is a merge join by hint, as
the slots are made from a few rows and their number is beyond the planner's estimate.

Stream positions are prefix sums in two levels: within 4096 hash chunks of a source
and over the chunks' sums, so a source with a third of all rows is no single task.

Permutations are "swap or not" shuffles with keys from MD5: bijections on any range,
evaluated per row in whole numbers, equal in every rerun.

Defined results: a null text has size 0 and is never taken; a null source is a
source of its own, last in order; null and repeated ids are rows like any other,
told apart by their text; rows equal in id, source and text are interchangeable;
an empty table gives an empty mix. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmfold.llm.common import bound, pick, words, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BLOCK = 128
SHARD_SLOTS = 4096
ROUNDS = 16
SEED = "mix-1"
_SLOTS_PER_ROW = 4096
_PRIME = (1 << 31) - 1


def _over(x: Column, divisor: int) -> Column:
    """Whole-number division of a non-negative number."""
    return F.call_function("div", x, F.lit(divisor).cast("bigint"))


def _number(digest: Column, first: int, digits: int) -> Column:
    """Some hexadecimal digits of an MD5 text as a number."""
    return F.conv(F.substring(digest, first, digits), 16, 10).cast("bigint")


def _rounds(label: Column, n: Column) -> Column:
    """The keys of a permutation of 0 .. n-1: per round a reflection point and two factors."""
    def key(r: Column) -> Column:
        digest = F.md5(F.concat_ws(":", F.lit(SEED), label, r.cast("string")).cast("binary"))
        return F.struct((_number(digest, 1, 12) % F.greatest(n, F.lit(1))).alias("mirror"),
                        (_number(digest, 13, 8) % (_PRIME - 1) + 1).alias("a"),
                        (_number(digest, 21, 8) % _PRIME).alias("b"))

    return F.transform(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), key)


def _permuted(x: Column, n: Column, rounds: Column) -> Column:
    """The place of x in a pseudorandom permutation of 0 .. n-1.

    A round either leaves x or mirrors it; both of a mirrored pair ask the same coin, a
    quadratic hash of the larger one, so a round is its own inverse.
    """
    def step(at: Column, key: Column) -> Column:
        mirror = F.pmod(key["mirror"] - at, n)

        def coin(high: Column) -> Column:
            return bound((key["a"] * (high % _PRIME) + key["b"] + _over(high, _PRIME)) % _PRIME,
                         lambda y: _over((y * y + key["b"]) % _PRIME, 128) % 2)

        return F.when(coin(F.greatest(at, mirror)) == 1, mirror).otherwise(at)

    return F.aggregate(rounds, x, step)


def _keyed(source: Column) -> Column:
    """A non-null text that orders and tells apart sources; null comes last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Slim rows: id, source, its key, size in words, the text's digest and the hash chunk."""
    rows = pick(docs, id=id_col, text=text_col, source=source_col)
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    slim = rows.select("id", "source", _keyed(F.col("source")).alias("s"), digest.alias("digest"),
                       F.size(words(F.col("text"))).cast("bigint").alias("size"))
    mixed = F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("digest"))
    return slim.withColumn("chunk", F.substring(F.md5(mixed.cast("binary")), 1, 3))


def source_targets(slim: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   cap: int = CAP, block: int = BLOCK) -> DataFrame:
    """One row per source: size, weight, target words, blocks, slots and where its slots begin.

    Targets fill like water: with sources in order of size over weight, those before the
    water line stop at ``cap`` times their size and the others share the rest by weight.
    The table has one row per source, so ordering it whole is cheap.
    """
    sizes = slim.groupBy("s").agg(F.sum("size").alias("source_size"))
    nth = (F.row_number().over(Window.orderBy("s")) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), nth))
    line = Window.orderBy(F.col("source_size") / F.col("weight"), "s")
    before, everything = line.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rest = F.lit(float(share)) * F.sum("source_size").over(everything) - cap * F.coalesce(
        F.sum("source_size").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = weighed.withColumn("level", rest / weight_left)
    full = (F.col("source_size") * cap).cast("double")
    target = F.least(full, F.max("level").over(everything) * F.col("weight"))
    placed = levels.withColumn("target", target).withColumn(
        "n_blocks", F.ceil(F.col("source_size") / block).cast("bigint"))
    slots = F.floor(F.col("target") * F.col("n_blocks") / F.col("source_size") + 0.5).cast("bigint")
    placed = placed.withColumn("slots", F.when(F.col("source_size") > 0, F.least(slots, F.col("n_blocks") * cap))
                               .otherwise(F.lit(0).cast("bigint")))
    by_key = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("s", "source_size", "weight", "target", "n_blocks", "slots",
                         F.coalesce(F.sum("slots").over(by_key), F.lit(0)).alias("first_slot"),
                         F.sum("slots").over(everything).alias("all_slots"))


def draw_slots(targets: DataFrame, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """One row per output slot: source, block, pass, shard and place in the shard."""
    ranges = targets.filter("slots > 0").withColumn(
        "from_k", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.col("slots") - 1, F.lit(_SLOTS_PER_ROW).cast("bigint"))))
    # A stated number of partitions: by size the few range rows would be put into one task.
    tasks = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = ranges.repartition(tasks, "s", "from_k").withColumn(
        "shard_rounds", _rounds(F.lit("shards"), F.col("all_slots")))
    first_pass, last_pass = (F.floor(k / F.col("n_blocks")).cast("bigint") for k in (
        F.col("from_k"), F.least(F.col("slots"), F.col("from_k") + _SLOTS_PER_ROW) - 1))
    passes = spread.withColumn("pass", F.explode(F.sequence(first_pass, last_pass))).withColumn(
        "label", F.concat_ws(":", F.lit("pass"), F.col("s"), F.col("pass").cast("string")))
    keyed = passes.withColumn("rounds", _rounds(F.col("label"), F.col("n_blocks")))
    low = F.greatest(F.col("from_k"), F.col("pass") * F.col("n_blocks"))
    high = F.least(F.col("from_k") + _SLOTS_PER_ROW, F.col("slots"), (F.col("pass") + 1) * F.col("n_blocks")) - 1
    each = keyed.withColumn("k", F.explode(F.sequence(low, high)))
    place = _permuted(F.col("first_slot") + F.col("k"), F.col("all_slots"), F.col("shard_rounds"))
    block = _permuted(F.pmod(F.col("k"), F.col("n_blocks")), F.col("n_blocks"), F.col("rounds"))
    return each.select("s", "pass", block.alias("block"), place.alias("place")).select(
        "s", "pass", "block", F.floor(F.col("place") / shard_slots).cast("bigint").alias("shard"),
        (F.col("place") % shard_slots).alias("slot"))


def shard_counts(slots: DataFrame) -> DataFrame:
    """The drawn number of blocks per shard and source."""
    return slots.groupBy("shard", "s").agg(F.count(F.lit(1)).alias("n_blocks"))


def laid_out(slim: DataFrame) -> DataFrame:
    """The slim rows with each one's first word in its source's stream (``start``)."""
    sums = slim.groupBy("s", "chunk").agg(F.sum("size").alias("chunk_size"))
    earlier = Window.partitionBy("s").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("s", "chunk", F.coalesce(F.sum("chunk_size").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("s", "chunk").orderBy("id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    local = slim.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return local.join(bases, ["s", "chunk"]).withColumn("start", F.col("base") + F.col("local")).drop("base", "local")


def pieces(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document and block it reaches into: block, first word within the document, words.

    A document without words keeps one row with a null block.
    """
    first = F.floor(F.col("start") / block)
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    blocks = F.when(F.col("size") > 0, F.sequence(first, last))
    each = rows.withColumn("block", F.explode_outer(blocks))
    low = F.greatest(F.col("start"), F.col("block") * block)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    return each.withColumns({"word": low - F.col("start"), "n_words": high - low})


def mix(docs: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", **targets) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken words, and the first shard it is in."""
    slim = written(measured(docs, id_col, text_col, source_col), "sizes")
    wanted = source_targets(slim, block=block, **targets)
    slots = draw_slots(wanted, shard_slots)
    taken = pieces(laid_out(slim), block).join(slots.hint("merge"), ["s", "block"], "left").groupBy(
        "s", "start", "id", "size", "digest").agg(
        F.sum(F.when(F.col("pass").isNotNull(), F.col("n_words")).otherwise(0)).alias("taken"),
        F.min("shard").alias("first_shard"), F.count(F.lit(1)).alias("n"))
    # Equal rows without words share their start and are counted, not lost.
    copies = F.when(F.col("size") > 0, F.lit(1).cast("bigint")).otherwise(F.col("n"))
    whole = taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
    return whole.join(wanted.select("s", "source_size", "target"), "s").select(
        F.col("id").alias(id_col), "size", "source_size", "target", "taken", "first_shard")


def mixed_texts(docs: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source", **targets) -> DataFrame:
    """The mix itself, with the input's columns: one row per document and pass that took words of it.

    A document taken whole keeps its text; else the text holds the taken words, joined by
    blanks. An integer column ``n_chars`` follows the new text. Of rows equal in id, source
    and text, the other columns are taken from one.
    """
    slim = written(measured(docs, id_col, text_col, source_col), "sizes")
    slots = draw_slots(source_targets(slim, block=block, **targets), shard_slots)
    part = F.struct("word", "n_words")
    took = pieces(laid_out(slim), block).join(slots.hint("merge"), ["s", "block"]).groupBy(
        "s", "start", "id", "digest", "size", "pass").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    source, text, id_ = F.col(f"`{source_col}`"), F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    whole = docs.select(row, id_.alias("i"), _keyed(source).alias("k"),
                        F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("d")).dropDuplicates(["i", "k", "d"])
    joined = took.join(whole, took["id"].eqNullSafe(whole["i"]) & (took["s"] == whole["k"]) & (took["digest"] == whole["d"]))
    old = F.col("row").getField(text_col)
    n = F.aggregate("parts", F.lit(0).cast("bigint"), lambda total, p: total + p["n_words"])
    taken = bound(words(old), lambda w: F.array_join(F.flatten(F.transform(
        "parts", lambda p: F.slice(w, p["word"].cast("int") + 1, p["n_words"].cast("int")))), " "))
    new = joined.withColumn("new", F.when(n == F.col("size"), old).otherwise(taken))

    def output(name: str, kind: str) -> Column:
        if name == text_col:
            return F.col("new")
        if name == "n_chars":
            return F.char_length("new").cast(kind)
        return F.col("row").getField(name)

    return new.select(*[output(name, kind).alias(name) for name, kind in docs.dtypes])
