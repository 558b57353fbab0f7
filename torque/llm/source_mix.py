"""Operator 5: mixing sources to target weights by fixed-length blocks.

The words of each source, document after document, form a stream that is cut
into blocks of equal length. The output is a row of shards of block slots.
How many slots of a shard go to each source is drawn (a multinomial draw given
the sources' total slots, by splitting the totals down a binary tree of shards,
so every shard finds its own draw). A source's slots are numbered through all
shards, and slot j of a source with n blocks holds block perm(j mod n) of its
pass j div n, for a pseudorandom permutation per source and pass. The last slot
of a source takes only the words still wanting, so every source, however small,
meets its target to the word. Slots meet blocks, and blocks documents, by index
joins; a hot source is spread by them.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from torque.llm.columns import let, stored, words

BLOCK_WORDS = 128
SHARD_SLOTS = 4096
MAX_PASSES = 3                 # a target is at most so many times its source
BUCKETS = 4096                 # of a source's documents, for running totals
MAX_SOURCES = 100_000          # rows of the source catalogue that the driver holds


@dataclass(frozen=True)
class Source:
    number: int
    name: str | None
    size: int                  # words
    target: Fraction           # words
    blocks: int
    slots: int
    skip: int                  # words before those that the last slot takes of its block
    most: int                  # words that the last slot takes


def targets(sizes: list[int], weights: list[int], passes: int = MAX_PASSES) -> list[Fraction]:
    """Share the sum of sizes by weight; cap at ``passes`` times the size and share the
    excess again by weight until no target is above its cap."""
    out = [Fraction(0)] * len(sizes)
    active = [i for i, n in enumerate(sizes) if n > 0]
    left = Fraction(sum(sizes))
    while active:
        total = sum(weights[i] for i in active)
        over = [i for i in active if left * weights[i] > passes * sizes[i] * total]
        if not over:
            for i in active:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = Fraction(passes * sizes[i])
            left -= out[i]
        active = [i for i in active if i not in set(over)]
    return out


def plan_sources(totals: list[tuple[str | None, int]], block_words: int = BLOCK_WORDS,
                 weights: list[int] | None = None, seed: int = 0) -> list[Source]:
    """Number sources by code point (null last), weigh them 1, 2, 3, 1, ... and size
    their share of the output: whole passes, blocks and the words of the last one."""
    ordered = sorted(totals, key=lambda t: (t[0] is None, t[0] or ""))
    weights = weights or [1 + i % 3 for i in range(len(ordered))]
    goal = targets([n for _, n in ordered], weights)
    return [Source(i, name, size, target, -(-size // block_words),
                   *_last_slot(i, size, round(target), block_words, seed))
            for i, ((name, size), target) in enumerate(zip(ordered, goal))]


def _last_slot(source: int, size: int, goal: int, block_words: int,
               seed: int) -> tuple[int, int, int]:
    """(slots, skip, most) of a source that is to give ``goal`` words."""
    if goal == 0:
        return 0, 0, 0
    blocks = -(-size // block_words)
    turn, rest = (goal - 1) // size, (goal - 1) % size + 1     # words of the last pass, >= 1
    short = size - (blocks - 1) * block_words                  # words of the source's last block
    key = pass_keys(seed, source, np.array([turn]))
    at = int(place_of(np.array([blocks - 1]), blocks, key)[0])
    words = lambda n: n * block_words - (block_words - short if at < n else 0)
    slots = rest // block_words
    while words(slots) < rest:
        slots += 1
    while slots > 1 and words(slots - 1) >= rest:
        slots -= 1
    most = rest - words(slots - 1)
    held = short if at == slots - 1 else block_words
    skip = int(_mixed(key + np.uint64(99))[0] % np.uint64(held - most + 1))
    return turn * blocks + slots, skip, most


def drawn(rng, counts: np.ndarray, take: int) -> np.ndarray:
    """Kinds of ``take`` things drawn from ``counts`` of each without replacement, however many.

    Every thing is taken on its own with the same chance, and what that is too many
    or too few (about the root of ``take``) is put back or taken by single draws. A
    random part of a random choice is a random choice, so this is exact.
    """
    total = int(counts.sum())
    got = rng.binomial(counts, take / total)
    off = int(got.sum()) - take
    if off:
        among = got if off > 0 else counts - got
        ends = np.cumsum(among)
        which = np.searchsorted(ends, rng.choice(int(ends[-1]), abs(off), replace=False), "right")
        got = got - np.sign(off) * np.bincount(which, minlength=len(counts))
    return got


def shard_draws(slots: tuple[int, ...], shard_slots: int = SHARD_SLOTS, seed: int = 0):
    """A function from a shard to (first slot, slot count) per source."""
    total = sum(slots)
    n_shards = -(-total // shard_slots)
    zero = np.zeros(len(slots), np.int64)

    @lru_cache(maxsize=256)
    def split(low: int, high: int) -> np.ndarray:
        """Counts of the left half of the shards low..high-1."""
        _, counts = node(low, high)
        mid = (low + high) // 2
        take = min(mid * shard_slots, total) - low * shard_slots
        return drawn(np.random.default_rng([seed, low, high]), counts, take)

    @lru_cache(maxsize=256)
    def node(low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """First slots and counts of the shards low..high-1, from the root down."""
        lo, hi, first, counts = 0, n_shards, zero, np.array(slots, np.int64)
        while (lo, hi) != (low, high):
            mid, left = (lo + hi) // 2, split(lo, hi)
            if high <= mid:
                hi, counts = mid, left
            else:
                lo, first, counts = mid, first + left, counts - left
        return first, counts

    return n_shards, lambda shard: node(shard, shard + 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit values (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pass_keys(seed: int, source: int, turn: np.ndarray) -> np.ndarray:
    """Names of the permutations of a source's passes."""
    own = _mixed(np.full(len(turn), source + 1, np.uint64))
    return _mixed(np.uint64(seed) * np.uint64(1 << 20) + turn.astype(np.uint64) + own)


def _walk(index: np.ndarray, n: int, key: np.ndarray, turns: range, back: bool) -> np.ndarray:
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    out, todo = index.astype(np.uint64), np.ones(len(index), bool)
    while todo.any():
        left, right = out[todo] >> shift, out[todo] & low
        for turn in turns:
            salt = _mixed(key[todo] + np.uint64(turn))
            if back:
                left, right = right ^ (_mixed(left + salt) & low), left
            else:
                left, right = right, left ^ (_mixed(right + salt) & low)
        out[todo] = left << shift | right
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


def permuted(index: np.ndarray, n: int, key: np.ndarray) -> np.ndarray:
    """Places of ``index`` under the pseudorandom permutations of 0..n-1 that ``key``
    names: a four-round Feistel network on the next even number of bits, walked
    until it falls below n."""
    return _walk(index, n, key, range(4), False)


def place_of(image: np.ndarray, n: int, key: np.ndarray) -> np.ndarray:
    """What ``permuted`` sends to ``image``."""
    return _walk(image, n, key, range(3, -1, -1), True)


def block_slots(spark, sources: list[Source], shard_slots: int = SHARD_SLOTS,
                seed: int = 0) -> DataFrame:
    """(shard, place, __source, pass, block, skip, most): every slot of the output. ``most``
    is null where the slot takes its whole block."""
    slots, blocks = tuple(s.slots for s in sources), [s.blocks for s in sources]
    last = [(s.skip, s.most) for s in sources]
    schema = "shard bigint, place int, __source int, pass int, block bigint, skip int, most int"
    if sum(slots) == 0:
        return spark.createDataFrame([], schema)
    n_shards, _ = shard_draws(slots, shard_slots, seed)

    def fill(batches):
        _, draw = shard_draws(slots, shard_slots, seed)
        for batch in batches:
            for shard in batch["id"]:
                first, counts = draw(int(shard))
                which = np.repeat(np.arange(len(counts)), counts)
                order = np.random.default_rng([seed, 1, int(shard)]).permutation(len(which))
                rows = []
                for s in np.flatnonzero(counts):
                    j = first[s] + np.arange(counts[s])
                    turn = j // blocks[s]
                    ends = j == slots[s] - 1
                    rows.append((turn, permuted(j % blocks[s], blocks[s],
                                                pass_keys(seed, int(s), turn)),
                                 np.where(ends, last[s][0], 0), np.where(ends, last[s][1], -1)))
                turn, block, skip, most = (np.concatenate(c) for c in zip(*rows))
                yield pd.DataFrame({
                    "shard": np.int64(shard), "place": order.astype(np.int32),
                    "__source": which.astype(np.int32), "pass": turn.astype(np.int32),
                    "block": block, "skip": skip.astype(np.int32),
                    "most": most.astype(np.int32)})

    tasks = min(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.range(0, n_shards, 1, tasks).mapInPandas(fill, schema).withColumn(
        "most", F.expr("nullif(most, -1)"))


def _overlap() -> tuple[Column, Column]:
    """Of a piece, what a slot takes: the words before it and its words."""
    end = F.coalesce(F.col("skip") + F.col("most"), F.col("at") + F.col("length"))
    begin = F.greatest(F.col("skip") - F.col("at"), F.lit(0))
    words = F.least(F.col("length"), end - F.col("at")) - begin
    return begin, F.greatest(words, F.lit(0))


class Mix:
    """One mix of (doc_id, text, source) rows; all parts are lazy DataFrames.

    The planner takes the generated slots for a tiny table, so joins with them
    are hinted to shuffle: they grow with the data and must not be broadcast.

    Documents are told apart by id, source, text and, among rows alike in all
    three, by number, so repeated rows and ids stay separate documents. Null
    texts and texts without words have size 0 and are never taken.
    """

    KEYS = ["doc_id", "__source", "__hash", "__copy"]

    def __init__(self, docs: DataFrame, block_words: int = BLOCK_WORDS,
                 shard_slots: int = SHARD_SLOTS, seed: int = 0):
        self.docs, self.block_words = docs, block_words
        spark = docs.sparkSession
        alike = Window.partitionBy("doc_id", "source", "__hash").orderBy("size")
        self.sized = stored(
            docs.select("doc_id", "source", F.xxhash64(F.coalesce("text", F.lit("")))
                        .alias("__hash"),
                        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
                        .alias("size"))
            .fillna(0, ["size"]).withColumn("__copy", F.row_number().over(alike)))
        totals = (self.sized.groupBy("source").agg(F.sum("size").alias("n"))
                  .limit(MAX_SOURCES + 1).collect())
        if len(totals) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        self.sources = plan_sources([(r["source"], int(r["n"])) for r in totals], block_words,
                                    seed=seed)
        self.catalogue = F.broadcast(spark.createDataFrame(
            [(s.number, s.name, s.size, float(s.target)) for s in self.sources],
            "__source int, __name string, source_size bigint, target double"))
        self.numbered = self.sized.join(
            self.catalogue, F.col("source").eqNullSafe(F.col("__name"))).drop("__name")
        self.slots = block_slots(spark, self.sources, shard_slots, seed)

    def pieces(self) -> DataFrame:
        """(keys, block, start, length, at): the parts that blocks cut documents into; ``start``
        counts a document's words, ``at`` its block's.

        Running totals are taken per bucket of a source and then over buckets, so
        no task sees a whole source.
        """
        rows = self.numbered.filter("size > 0").withColumn(
            "bucket", F.pmod(F.xxhash64("doc_id", "__hash"), F.lit(BUCKETS)))
        inside = Window.partitionBy("__source", "bucket").orderBy("doc_id", "__hash", "__copy")
        before = rows.groupBy("__source", "bucket").agg(F.sum("size").alias("n")).select(
            "__source", "bucket", (F.sum("n").over(
                Window.partitionBy("__source").orderBy("bucket")) - F.col("n")).alias("base"))
        n = F.lit(self.block_words)
        return (rows.withColumn("offset", F.sum("size").over(inside) - F.col("size"))
                .join(before.hint("merge"), ["__source", "bucket"])
                .withColumn("offset", F.col("offset") + F.col("base"))
                .select(*self.KEYS, "offset", "size", F.explode(F.sequence(
                    F.floor(F.col("offset") / n),
                    F.floor((F.col("offset") + F.col("size") - 1) / n))).alias("block"))
                .withColumn("start", F.greatest(F.col("block") * n - F.col("offset"), F.lit(0)))
                .select(*self.KEYS, "size", "block", "start",
                        (F.least((F.col("block") + 1) * n - F.col("offset"), F.col("size"))
                         - F.col("start")).alias("length"),
                        (F.col("offset") + F.col("start") - F.col("block") * n).alias("at")))

    def report(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken) per document."""
        # a source's last slot is the only one that takes a part of its block
        times = self.slots.groupBy("__source", "block").agg(
            F.count_if(F.col("most").isNull()).alias("times"), F.max("skip").alias("skip"),
            F.max("most").alias("most"))
        taken = (self.pieces().join(times.hint("merge"), ["__source", "block"]).groupBy(*self.KEYS)
                 .agg(F.sum(F.col("length") * F.col("times") + F.when(
                     F.col("most").isNotNull(), _overlap()[1]).otherwise(0)).alias("taken"))
                 .filter("taken > 0"))
        own, other = self.numbered.alias("a"), taken.hint("merge").alias("b")
        same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in self.KEYS]
        on = same[0] & same[1] & same[2] & same[3]
        return own.join(other, on, "left").select(
            "a.doc_id", "a.size", "a.source_size", "a.target",
            F.coalesce("b.taken", F.lit(0).cast("long")).alias("taken"))

    def documents(self) -> DataFrame:
        """The taken words as rows with the columns of the input: one row per document
        and pass. A document taken whole keeps its text; otherwise its taken words
        are joined by blanks. ``n_chars``, if there, is set to the new length."""
        begin, length = _overlap()
        taken = (self.pieces().join(self.slots.hint("merge"), ["__source", "block"])
                 .withColumns({"start": F.col("start") + begin, "length": length})
                 .filter("length > 0").groupBy(*self.KEYS, "size", "pass").agg(
                     F.sort_array(F.collect_list(F.struct("start", "length"))).alias("parts"),
                     F.sum("length").alias("n")))
        alike = Window.partitionBy("doc_id", "__source", "__hash").orderBy("__source")
        numbers = self.catalogue.select("__source", "__name")
        full = (self.docs.join(numbers, F.col("source").eqNullSafe(F.col("__name"))).drop("__name")
                .withColumn("__hash", F.xxhash64(F.coalesce("text", F.lit(""))))
                .withColumn("__copy", F.row_number().over(alike)))
        a, b = full.alias("a"), taken.hint("merge").alias("b")
        on = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
        for k in self.KEYS[1:]:
            on = on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
        cut = let(words(F.col("a.text")), lambda w: F.array_join(F.flatten(F.transform(
            F.col("b.parts"), lambda p: F.slice(w, (p["start"] + 1).cast("int"),
                                                p["length"].cast("int")))), " "))
        text = F.when(F.col("b.n") == F.col("b.size"), F.col("a.text")).otherwise(cut)
        out = a.join(b, on).select(
            *[text.alias("text") if c == "text" else F.col(f"a.{c}") for c in self.docs.columns])
        if "n_chars" in out.columns:
            kind = self.docs.schema["n_chars"].dataType
            out = out.withColumn("n_chars", F.char_length("text").cast(kind))
        return out


def mix_sources(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS,
                seed: int = 0) -> Mix:
    """Plan a mix of all documents. Reruns with a seed agree.

    Other columns stay with their documents; the mix's own columns have names
    that start with two underscores. An empty table gives a mix without slots.
    """
    return Mix(docs, block_words, shard_slots, seed)
