"""Mixing sources to target weights, with DataFrame functions only.

The words of each source, document after document, are cut into blocks of nearly equal length, of at most BLOCK_WORDS. A
source has as many slots of one block in the mix as its target has blocks. Its slots fall on the output shards
multinomially: each shard's source counts are multinomial draws, given that they add up to the source's slots. (Free draws,
``residual=False``, have the same expectation, but small sources then miss their targets by far.) The i-th slot of a source
takes the block at place i of a pseudorandom permutation of the source's blocks. Slots and documents meet by block index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridprep.llm.common import cut, shielded, with_rows

#: What counts as a word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS, SHARD_SLOTS, MAX_REPEATS = 64, 1_024, 3
#: Groups in which the documents of a source are counted up, at least, and documents of one, about; a hot source is spread
#: over all of them.
BUCKETS, BUCKET_ROWS = 512, 100_000
#: Rounds of the permutations, slots of a source that are made from one row, and slots that one task makes, about.
ROUNDS, RUN_SLOTS, TASK_SLOTS = 16, 4_096, 1_000_000


@dataclass
class Mix:
    """``documents``: doc_id, source, size, start (in words in its source), rank, source_size, blocks (of its source);
    ``sources``: one row for each source with its size, weight, target, blocks and slots; ``slots``: shard, rank, turn, block."""

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame


def permuted(df: DataFrame, i: str, n: str, seed: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``, where a pseudorandom permutation of 0 .. n - 1 (n and the seed columns of the row) takes i.

    Swap-or-not rounds: each pairs x with (k - x) mod n for a key k of its own, and one hash bit of the larger of the two
    decides for both whether they change places. That is a permutation for every n, without walking through cycles as a
    network over pairs needs, so all rows take the same few column functions.
    """
    others = df.columns
    df = df.select(*others, F.xxhash64(*seed).alias("__key"), F.pmod(F.col(i), F.col(n)).cast("long").alias("__x"))
    x, size = F.col("__x"), F.col(n)
    for turn in range(ROUNDS):
        partner = F.pmod(F.pmod(F.xxhash64("__key", F.lit(turn)), size) - x, size)
        bit = F.shiftrightunsigned(F.xxhash64("__key", F.lit(turn), F.greatest(x, partner)), 63)
        df = df.select(*others, "__key", F.when(bit == 1, partner).otherwise(x).alias("__x"))
    return df.select(*others, x.alias(name))


def _uniform(*seed: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*seed), 11).cast("double") * F.lit(2.0**-53)


def source_targets(sizes: DataFrame, weights: list[float], repeats: int = MAX_REPEATS) -> DataFrame:
    """rank, source, source_size, weight, target: one row for each source of ``sizes`` (source, source_size).

    Sources by code point, nulls last, weigh ``weights`` in turn and share the sum of all sizes; a target stops at
    ``repeats`` times its source's size and the excess goes to the others by weight, until none is above.
    """
    # one row for each source from here on
    everything = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights)) + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    ratio = everything.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    # level: what each unit of weight gets if exactly the sources before this one stop at their caps
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    ranked = ranked.withColumn("level", left / open_weight)
    stops = F.col("cap") < F.col("level") * F.col("weight")
    last = F.max(F.when(~stops, F.struct(-F.col("cap") / F.col("weight"), -F.col("rank"), F.col("level"))))
    ranked = ranked.withColumn("final", last.over(everything)["level"])
    target = F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("final") * F.col("weight")))
    return ranked.select("rank", "source", "source_size", "weight", F.when(F.col("source_size") > 0, target).otherwise(0.0).alias("target"))


def word_count(text: Column | str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plan_mix(docs: DataFrame, weights: list[float], seed: int = 0, block_words: int = BLOCK_WORDS, keys: tuple[str, ...] = (), residual: bool = True) -> Mix:
    """Draws the mix of ``docs`` (doc_id, source, text).

    Null texts have no words; null is a source of its own; rows of equal doc_id in a source follow by size and
    then by ``keys``, columns of ``docs`` that ``documents`` keeps. A block is
    taken at most 3 times, so no document gives more than 3 times its words. The draw depends on the ids, sizes,
    sources and ``seed`` alone, not on how rows are partitioned. Without words there are no slots. A source gets its target
    to within half a block and the blocks' differences of one word; with ``residual`` false each slot
    draws its source, among all.
    """
    sized = cut(docs.select("doc_id", "source", *keys, word_count().alias("size")))
    n_buckets = max(BUCKETS, -(-sized.count() // BUCKET_ROWS))
    sized = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(n_buckets)).cast("int"))
    buckets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    sources = source_targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights)
    sources = sources.withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
    want = F.col("target") * F.col("blocks") / F.greatest("source_size", F.lit(1))
    sources = cut(sources.withColumn("slots", F.least(F.round(want).cast("long"), F.col("blocks") * MAX_REPEATS)))
    # where each document begins in its source: buckets in turn, and documents in their bucket
    order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = buckets.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(order), F.lit(0)))
    begins = begins.join(sources, begins["source"].eqNullSafe(sources["source"])).select("rank", begins["source"], "bucket", "bucket_start", "source_size", "blocks")
    inner = Window.partitionBy("source", "bucket").orderBy("doc_id", "size", *keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    placed = placed.alias("d").join(begins.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.bucket") == F.col("b.bucket")))
    documents = placed.select("d.doc_id", "d.source", *(f"d.{k}" for k in keys), "d.size", (F.col("bucket_start") + F.col("inside")).alias("start"), "rank", "source_size", "blocks")

    # a row for each run of slots of a source; few rows that become many are dealt out before, so a hot source is in all tasks
    total = sources.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-total // SHARD_SLOTS))
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_SLOTS))
    if residual:
        runs = sources.filter("slots > 0").select("rank", "blocks", "slots", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / RUN_SLOTS))).alias("run"))
        runs = runs.repartition(tasks, "rank", "run")
        last = F.least(F.col("slots"), (F.col("run") + 1) * RUN_SLOTS) - 1
        slots = runs.select("rank", "blocks", F.explode(F.sequence(F.col("run") * RUN_SLOTS, last)).alias("turn"))
    else:
        words = sources.agg(F.sum("source_size")).first()[0] or 0
        slots = _free_slots(sources, -(-words // block_words), seed)
    slots = slots.withColumn("pass", F.floor(F.col("turn") / F.col("blocks")))
    slots = slots.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "rank", "turn", F.lit("shard")), F.lit(shards)))
    # cut off here: a filter on the block would be pushed down through all rounds, and grow threefold in each
    slots = cut(permuted(slots, "turn", "blocks", [F.lit(seed), F.col("rank"), F.col("pass")], "block"))
    return Mix(documents, sources, slots.select("shard", "rank", "turn", "block"))


def _free_slots(sources: DataFrame, total: int, seed: int) -> DataFrame:
    """rank, blocks, turn: how many slots each source has is drawn, shard by shard, from all sources by their expected slots."""
    line = Window.partitionBy(F.lit(0)).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    upto = sources.filter("slots > 0").select("rank", "blocks", F.sum("slots").over(line).alias("upto"))
    drawn = sources.sparkSession.range(total).select(_uniform(F.col("id"), F.lit(seed)).alias("u"))
    # a row for each source at most, in order: a draw belongs to the first whose end lies behind it
    ends = [(r["rank"], r["upto"]) for r in upto.orderBy("rank").collect()]
    ends = [(rank, n / ends[-1][1]) for rank, n in ends]
    place = F.coalesce(*(F.when(F.col("u") < end, F.lit(rank)) for rank, end in ends), F.lit(ends[-1][0])) if ends else F.lit(0)
    counts = drawn.groupBy(place.cast("int").alias("rank")).agg(F.count(F.lit(1)).alias("n")).join(upto.select("rank", "blocks"), "rank")
    n = F.least(F.col("n"), F.col("blocks") * MAX_REPEATS)
    return counts.select("rank", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("turn"))


def _end_of_block(k: Column) -> Column:
    """Words of a source before its block ``k``: blocks differ by one word at most."""
    return F.floor(k.cast("decimal(19,0)") * F.col("source_size").cast("decimal(19,0)") / F.col("blocks").cast("decimal(19,0)")).cast("long")


def _pieces(mix: Mix) -> DataFrame:
    """doc_id, source, size, start, block, words of the document in the block, times the block is taken (0: not at all)."""
    # the block of the word w is the last that doesn't begin after it; a block lies in few documents and a document in many
    # blocks: spread by block, whatever the source
    at = lambda w: F.floor(((w + 1).cast("decimal(19,0)") * F.col("blocks").cast("decimal(19,0)") - 1) / F.col("source_size").cast("decimal(19,0)")).cast("long")
    held = mix.documents.filter("size > 0").withColumn("block", F.explode(F.sequence(at(F.col("start")), at(F.col("start") + F.col("size") - 1))))
    begin = F.greatest(F.col("start"), _end_of_block(F.col("block")))
    end = F.least(F.col("start") + F.col("size"), _end_of_block(F.col("block") + 1))
    held = held.withColumn("from_word", begin - F.col("start")).withColumn("words", end - begin).drop("source_size", "blocks")
    times = mix.slots.groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))
    return held.join(times, ["rank", "block"], "left").fillna(0, ["times"])


def mix_documents(docs: DataFrame, weights: list[float] = (1, 2, 3), seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row for each row of ``docs``; see plan_mix for all cases."""
    mix = plan_mix(docs, list(weights), seed)
    taken = _pieces(mix).groupBy("rank", "doc_id", "start").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    facts = mix.sources.select("rank", "source_size", "target")
    d = mix.documents.alias("d")
    same = (F.col("d.rank") == F.col("t.rank")) & F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("d.start") == F.col("t.start")) & (F.col("d.size") > 0)
    out = d.join(taken.alias("t"), same, "left").join(facts.alias("s"), F.col("d.rank") == F.col("s.rank"))
    return out.select("d.doc_id", "d.size", "s.source_size", "s.target", F.coalesce("t.taken", F.lit(0)).alias("taken"))


def mixed_texts(docs: DataFrame, weights: list[float] = (1, 2, 3), seed: int = 0) -> DataFrame:
    """The mix as rows with the columns of ``docs``: each row once for each of the up to 3 turns it is in.

    In a turn where all its blocks are taken a document keeps its text as it is; otherwise the text is the taken words
    in their order, one blank between them, and n_chars, if there is such a column, counts it. Documents without words
    are in no block: they stay once, as they are. Rows repeating a doc_id, or with none, are documents of their own.
    """
    docs, back = shielded(docs, "doc_id", "source", "text", "n_chars")
    own = with_rows(docs.withColumn("__hash", F.xxhash64("text")))
    mix = plan_mix(own, list(weights), seed, keys=("__hash", "__row"))
    piece = F.struct(F.col("from_word"), F.col("words"), F.col("times"))
    got = _pieces(mix).groupBy("__row").agg(F.array_sort(F.collect_list(piece)).alias("__pieces"))
    joined = own.alias("d").join(got.alias("g"), F.col("d.__row") == F.col("g.__row"), "left").select("d.*", "g.__pieces")
    least, most = (f(F.transform("__pieces", lambda p: p["times"])) for f in (F.array_min, F.array_max))
    rows = joined.withColumn("__least", least).withColumn("__most", most)
    # in the turns up to the least all blocks are taken; the words, split once, are wanted for the others only
    some = F.col("__most") > F.col("__least")
    words = F.when(some, F.regexp_extract_all(F.col("text"), F.lit("(" + WORD + ")")))
    # how often each word is taken: the pieces cover the words one after another
    each = F.when(some, F.flatten(F.transform("__pieces", lambda p: F.array_repeat(p["times"].cast("int"), p["words"].cast("int")))))
    # explode of one row keeps the optimizer from moving the split into the loop over words
    rows = rows.select("*", F.explode(F.array(F.struct(words.alias("words"), each.alias("times")))).alias("__split"))
    turns = F.when(F.col("__most").isNull(), F.array(F.lit(0))).when(F.col("__most") > 0, F.sequence(F.lit(0), F.col("__most").cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("__turn", F.explode(turns))
    rows = rows.withColumn("__cut", F.coalesce(F.col("__turn") >= F.col("__least"), F.lit(False)))
    marked = F.zip_with("__split.words", "__split.times", lambda w, t: F.when(t > F.col("__turn"), w))
    text = F.when(F.col("__cut"), F.array_join(marked, " ")).otherwise(F.col("text"))
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("__cut"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return back(rows)
