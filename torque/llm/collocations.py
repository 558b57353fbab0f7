"""Operator 12: phrases that occur more often than their parts would by chance.

Words are coded by 64-bit hashes of (lang, word), checked on all distinct words:
no other word shares the code of a frequent one. An n-gram is the packed row of
its word codes. An invertible permutation spreads the packed rows evenly; the
leading bytes are the quotient, everything else is the remainder, and a counting
filter holds sorted remainders by quotient with their counters. Nothing of a
key is lost, so counts are exact and the permutation gives the words back.

Each task counts into filters of its own (partial counts, whatever is frequent),
which are cut by ranges of quotients and merged shard by shard. Only n-grams
whose words and word pairs are frequent can be frequent themselves; tasks look
these up in bitmaps of a fixed size, which may let others through but lose none.
Most pairs of frequent words are rare, so a first pass counts them by the leading
bytes of their marks: a mark that is shared counts too much, never too little.

Only what later stages read (frequent words, phrases) is stored, and in few files: on
a local file system each file costs the JVM several processes (``chmod``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from torque.llm.columns import stored
from torque.llm.packing import from_planes, planes
from torque.llm.wordhash import BASE, BASE_INVERSE, STEP, mix, powers, text_slices
from torque.llm.worker_memory import release

LONGEST = 5
FILTER_BITS = 26                 # bits of a bitmap of frequent keys: 8 MB, whatever the data
MARK_BYTES = 5                   # leading bytes of a pair's mark that the first pass counts by
SHARD_ENTRIES = 1_000_000        # counted occurrences a shard gets at most on average
HELD_ENTRIES = 1_500_000         # entries after which a task hands its filters on
WAITING = 300_000                # rows that wait to be sorted into a small filter
HELD_WORDS = 400_000             # distinct words after which a task hands its counts on
HELD_BYTES = 32_000_000          # bytes of words, likewise
WORD_ROWS = 20_000               # rows of words that travel at once
FILES = 16                       # files that frequent words or phrases are stored in
SALTS = 16
BREAKS = ".,;:!?\n\x0b\x0c\r"    # end a piece; blanks and tabs end a word

_STEPS = [np.uint64(j * int(STEP) & (1 << 64) - 1) for j in range(max(SALTS, LONGEST) + 1)]
_CLASS = np.zeros(256, np.uint8)             # 0 part of a word, 1 blank, 2 break
_CLASS[[32, 9]] = 1
_CLASS[[ord(c) for c in BREAKS]] = 2
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32


# ---- words ----------------------------------------------------------------------
def lang_codes(langs: list[str], salt: int) -> np.ndarray:
    digest = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8, salt=bytes([salt]))
                                .digest(), "big") for x in set(langs)}
    return np.array([digest[x] for x in langs], np.uint64)


def split_bytes(column: pa.Array):
    """Bytes of a column of texts, their classes, where its rows begin, and where every
    word starts and ends."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    values = column.buffers()[2]
    raw = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    data = raw[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    kind = _CLASS[data]
    black = np.zeros(len(data) + 1, bool)
    black[:-1] = kind == 0
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    before = np.concatenate(([False], black[:-1]))
    return (data, kind, offsets, np.flatnonzero(black & (~before | fresh)),
            np.flatnonzero(before & (~black | fresh)))


class Pieces:
    """Words of a column of texts: code and number of the piece they stand in."""

    def __init__(self, column: pa.Array, langs: list[str], salt: int):
        data, kind, offsets, start, end = split_bytes(column)
        n = len(data)
        ends_piece = np.zeros(n + 1, bool)
        ends_piece[offsets] = True
        ends_piece[:n] |= kind == 2
        self.piece = np.cumsum(ends_piece)[start]
        sums = np.zeros(n + 1, np.uint64)
        table = mix(_LOWER + np.uint64(1) + _STEPS[salt])
        np.take(table, data, out=sums[1:], mode="clip")
        sums[1:] *= powers("up", BASE, n)
        np.cumsum(sums[1:], out=sums[1:])
        own = (sums[end] - sums[start]) * powers("down", BASE_INVERSE, n + 1)[start]
        row = np.searchsorted(offsets, start, "right") - 1
        self.code = mix(mix(own ^ (end - start).astype(np.uint64) * STEP)
                        + lang_codes(langs, salt)[row])


def spelled(column: pa.Array, langs: pa.Array) -> pa.Table:
    """(lang, word, a) of a column of texts: its distinct words, compared letter by letter."""
    data, kind, offsets, start, end = split_bytes(column)
    ends = np.concatenate(([0], np.cumsum(end - start, dtype=np.int64)))
    letters = _LOWER.astype(np.uint8)[data[kind == 0]]
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(letters))
    own = langs.dictionary_encode()
    at = own.indices.to_numpy()[np.searchsorted(offsets, start, "right") - 1]
    found = (pa.table({"at": at, "word": words})
             .group_by(["at", "word"], use_threads=False).aggregate([([], "count_all")]))
    return pa.table({"lang": own.dictionary.take(found["at"]), "word": found["word"],
                     "a": found["count_all"]})


def pair_marks(codes: np.ndarray) -> np.ndarray:
    """64-bit marks of neighbouring pairs, for the bitmap of frequent pairs."""
    return mix(codes[:-1] * STEP + codes[1:])


# ---- filters ----------------------------------------------------------------------
def permute(rows: np.ndarray) -> np.ndarray:
    """Invertible: every word is masked by a mix of the one before it, the first by all."""
    out = rows.copy()
    width = out.shape[1]
    for _ in range(2):
        for j in range(1, width):
            out[:, j] ^= mix(out[:, j - 1] + _STEPS[j])
        out[:, 0] = mix(out[:, 0] ^ mix(out[:, -1] + BASE)) if width > 1 else mix(out[:, 0])
    return out


def unmix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(pow(0xC4CEB9FE1A85EC53, -1, 1 << 64))
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(pow(0xFF51AFD7ED558CCD, -1, 1 << 64))
    return x ^ (x >> np.uint64(33))


def restore(rows: np.ndarray) -> np.ndarray:
    out = rows.copy()
    width = out.shape[1]
    for _ in range(2):
        out[:, 0] = unmix(out[:, 0])
        if width > 1:
            out[:, 0] ^= mix(out[:, -1] + BASE)
        for j in range(width - 1, 0, -1):
            out[:, j] ^= mix(out[:, j - 1] + _STEPS[j])
    return out


class CountingFilter:
    """Counters of permuted rows, sorted, so that two filters merge like sorted lists.

    Rows that were added wait until they outnumber the filter's own entries.
    """

    def __init__(self, width: int):
        self.width = width
        self.rows, self.counts = np.zeros((0, width), np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.added = 0

    def __len__(self) -> int:
        return len(self.counts) + self.added

    def add(self, rows: np.ndarray, counts: np.ndarray | None = None) -> None:
        """Add permuted rows in any order, counted once each unless counts are given."""
        self.waiting.append((rows, np.ones(len(rows), np.int64) if counts is None else counts))
        self.added += len(rows)
        if self.added > max(len(self.counts), WAITING):
            self.merge()

    def merge(self) -> None:
        rows = np.concatenate([self.rows, *(w[0] for w in self.waiting)])
        counts = np.concatenate([self.counts, *(w[1] for w in self.waiting)])
        # the entries are in ``rows`` now: no second copy stays while they are sorted
        self.rows, self.counts, self.waiting, self.added = rows[:0], counts[:0], [], 0
        if not len(rows):
            return
        order = np.argsort(rows[:, 0])
        first = rows[order, 0]
        if self.width > 1:        # equal first words are equal rows, but for odd cases
            same = first[1:] == first[:-1]
            if np.any(rows[order[1:][same], 1:] != rows[order[:-1][same], 1:]):
                order = np.lexsort(rows.T[::-1])
        rows = self.rows = rows[order]
        counts = self.counts = counts[order]
        del order, first
        fresh = np.concatenate(([True], np.any(rows[1:] != rows[:-1], axis=1)))
        if not fresh.all():
            self.rows = rows[fresh]
            self.counts = np.add.reduceat(counts, np.flatnonzero(fresh))

    def shards(self, quotient: int, shard_bits: int, spare: int = 0):
        """(shard, packed filter) of every range of quotients that holds entries."""
        self.merge()
        shard = (self.rows[:, 0] >> np.uint64(64 - shard_bits) if shard_bits
                 else np.zeros(len(self.rows), np.uint64)).astype(np.int64)
        edges = np.flatnonzero(np.diff(shard, prepend=-1))
        for a, b in zip(edges, np.append(edges[1:], len(shard))):
            yield int(shard[a]), pack(self.rows[a:b], self.counts[a:b], quotient, spare)


def pack(rows: np.ndarray, counts: np.ndarray, quotient: int, spare: int = 0) -> bytes:
    """Filter entries: run lengths by quotient, then remainders and counters as byte
    planes. The ``quotient`` leading bytes of a row are kept once per run, the ``spare``
    last bytes of its first word, which must be zero, not at all."""
    top = rows[:, 0] >> np.uint64(64 - 8 * quotient)
    starts = np.flatnonzero(np.concatenate(([True], top[1:] != top[:-1])))
    runs = np.diff(np.append(starts, len(rows)))
    first = planes(np.ascontiguousarray(rows[:, 0]))[len(rows) * spare:len(rows) * (8 - quotient)]
    rest = b"".join(planes(np.ascontiguousarray(rows[:, j])) for j in range(1, rows.shape[1]))
    size = 1 if counts.max() < 256 else 4 if counts.max() < 1 << 32 else 8
    head = np.array([len(rows), len(starts), size], np.int64).tobytes()
    return b"".join((head, planes(top[starts].astype(np.uint32)), planes(runs.astype(np.uint32)),
                     first, rest, planes(counts.astype(f"u{size}"))))


def unpack(data: bytes, width: int, quotient: int, spare: int = 0) -> tuple[np.ndarray, np.ndarray]:
    n, m, size = np.frombuffer(data[:24], np.int64).tolist()
    at = 24
    top = from_planes(data[at:at + 4 * m], np.uint32).astype(np.uint64)
    runs = from_planes(data[at + 4 * m:at + 8 * m], np.uint32).astype(np.int64)
    at += 8 * m
    rows = np.empty((n, width), np.uint64)
    stop = at + n * (8 - quotient - spare)
    low = bytes(n * spare) + data[at:stop] + bytes(n * quotient)
    rows[:, 0] = from_planes(low, np.uint64) | (
        np.repeat(top, runs) << np.uint64(64 - 8 * quotient))
    at = stop
    for j in range(1, width):
        rows[:, j] = from_planes(data[at:at + 8 * n], np.uint64)
        at += 8 * n
    return rows, from_planes(data[at:], f"u{size}").astype(np.int64)


# ---- Spark stages --------------------------------------------------------------------
def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, a) of all distinct words. Each task counts its own first, so that
    rows of words, not every word of every text, pass through Spark."""
    def count(batches):
        release()
        held, fresh = None, []

        def merged():
            own = pa.concat_tables(([held] if held else []) + fresh)
            own = own.group_by(["lang", "word"], use_threads=False).aggregate([("a", "sum")])
            return own.rename_columns({"a_sum": "a"})

        for batch in batches:
            langs = batch.column(0).cast(pa.large_string())
            for at, column in text_slices(batch.column(1)):
                fresh.append(spelled(column, langs.slice(at, len(column))))
                if sum(map(len, fresh)) > HELD_WORDS or sum(x.nbytes for x in fresh) > HELD_BYTES:
                    held, fresh = merged(), []
                    if len(held) > HELD_WORDS or held.nbytes > HELD_BYTES:
                        yield from held.cast(schema).to_batches(WORD_ROWS)
                        held = None
        if held or fresh:
            yield from merged().cast(schema).to_batches(WORD_ROWS)

    schema = pa.schema({"lang": pa.string(), "word": pa.string(), "a": pa.int64()})
    return (docs.select("lang", "text").mapInArrow(count, "lang string, word string, a bigint")
            .groupBy("lang", "word").agg(F.sum("a").alias("a")))


def coded(words: DataFrame, salt: int) -> DataFrame:
    """Adds ``gram`` (the code as bytes) and ``mark`` (as a number)."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                column = batch.column(1)
                # a word may hold no blank, so each row has exactly one
                code = Pieces(column, batch.column(0).to_pylist(), salt).code
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(code.view(np.int64)), grams_of(code[:, None])],
                    names=["lang", "word", "a", "mark", "gram"])

    return words.mapInArrow(run, "lang string, word string, a bigint, mark bigint, gram binary")


def grams_of(rows: np.ndarray) -> pa.Array:
    """Rows of codes as big-endian bytes."""
    n, width = rows.shape
    data = np.ascontiguousarray(rows).astype(">u8").tobytes()
    return pa.Array.from_buffers(pa.large_binary(), n, [
        None, pa.py_buffer(np.arange(n + 1, dtype=np.int64) * (8 * width)),
        pa.py_buffer(data)]).cast(pa.binary())


def bitmap(marks: DataFrame, bits: int) -> bytes:
    """Bits of all marks modulo 2 ** bits: at most 2 ** bits / 8 bytes for the driver."""
    at = F.col("mark").bitwiseAND((1 << bits) - 1)
    cells = (marks.select((at + 1).alias("at"))
             .groupBy(F.bitmap_bucket_number("at").alias("cell"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")))
    out = np.zeros(max(1, (1 << bits) >> 15) * 4096, np.uint8)
    for cell, own in cells.collect():
        out[(cell - 1) * 4096:cell * 4096] = np.frombuffer(own, np.uint8)
    return out.tobytes()


def has(filter_bits: np.ndarray, marks: np.ndarray, bits: int) -> np.ndarray:
    at = (marks & np.uint64((1 << bits) - 1)).astype(np.int64)
    return (filter_bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def handed_on(held: dict, quotient: int, shard_bits: int, spare: int = 0):
    """Batches of packed filters; ``held`` begins anew."""
    rows = [(k, shard, data) for k in held
            for shard, data in held[k].shards(quotient, shard_bits, spare)]
    held.update({k: CountingFilter(held[k].width) for k in held})
    for at in range(0, len(rows), 512):
        part = rows[at:at + 512]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in part], pa.int32()),
             pa.array([r[1] for r in part], pa.int32()),
             pa.array([r[2] for r in part], pa.binary())], names=["k", "shard", "data"])


def neighbours(split: Pieces, in_words: np.ndarray, bits: int) -> np.ndarray:
    """Do words i and i + 1 stand in one piece and are both frequent?"""
    known = has(in_words, split.code, bits)
    return known[:-1] & known[1:] & (split.piece[:-1] == split.piece[1:])


def frequent_marks(docs: DataFrame, salt: int, words_map, bits: int, least: int,
                   quotient: int, shard_bits: int) -> DataFrame:
    """(mark) of word pairs, the leading ``MARK_BYTES`` of it, that occur ``least`` times:
    those of all frequent pairs, and of others that share theirs."""
    spare = 8 - MARK_BYTES
    cut = np.uint64(8 * spare)

    def count(batches):
        release()
        in_words = np.frombuffer(words_map.value, np.uint8)
        held = {2: CountingFilter(1)}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for at, column in text_slices(batch.column(1)):
                split = Pieces(column, langs[at:at + len(column)], salt)
                marks = pair_marks(split.code)[neighbours(split, in_words, bits)]
                if len(marks):
                    held[2].add((marks >> cut << cut)[:, None])
                if len(held[2]) > HELD_ENTRIES:
                    yield from handed_on(held, quotient, shard_bits, spare)
        yield from handed_on(held, quotient, shard_bits, spare)

    def merge(key, table):
        total = CountingFilter(1)
        for data in table.column("data"):
            total.add(*unpack(data.as_py(), 1, quotient, spare))
        total.merge()
        mark = total.rows[total.counts >= least, 0] >> cut
        return pa.table({"mark": pa.array(mark.view(np.int64))})

    parts = docs.mapInArrow(count, "k int, shard int, data binary")
    return parts.groupBy("k", "shard").applyInArrow(merge, "mark bigint")


def frequent_grams(docs: DataFrame, salt: int, words_map, pairs_map, bits: int,
                   least: int, quotient: int, shard_bits: int) -> DataFrame:
    """(k, gram, a) of all n-grams of two or more words that occur ``least`` times."""
    sizes = range(2, LONGEST + 1)
    cut = np.uint64(8 * (8 - MARK_BYTES))

    def count(batches):
        release()
        in_words = np.frombuffer(words_map.value, np.uint8)
        in_pairs = np.frombuffer(pairs_map.value, np.uint8)
        held = {k: CountingFilter(k) for k in sizes}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for at, column in text_slices(batch.column(1)):
                split = Pieces(column, langs[at:at + len(column)], salt)
                # linked[i]: words i and i + 1 may stand in one frequent phrase
                linked = neighbours(split, in_words, bits)
                linked &= has(in_pairs, pair_marks(split.code) >> cut, bits)
                for k in sizes:
                    n = max(0, len(split.code) - k + 1)
                    whole = np.ones(n, bool)
                    for j in range(k - 1):
                        whole &= linked[j:j + n]
                    starts = np.flatnonzero(whole)
                    if len(starts):
                        rows = split.code[starts[:, None] + np.arange(k)]
                        held[k].add(permute(rows))
                if sum(map(len, held.values())) > HELD_ENTRIES:
                    yield from handed_on(held, quotient, shard_bits)
        yield from handed_on(held, quotient, shard_bits)

    def merge(key, table):
        k = key[0].as_py()
        total = CountingFilter(k)
        for data in table.column("data"):
            total.add(*unpack(data.as_py(), k, quotient))
        total.merge()
        often = total.counts >= least
        codes = restore(total.rows[often])
        return pa.Table.from_arrays(
            [pa.array(np.full(len(codes), k, np.int32)), pa.chunked_array([grams_of(codes)]),
             pa.array(total.counts[often])], names=["k", "gram", "a"])

    parts = docs.mapInArrow(count, "k int, shard int, data binary")
    return parts.groupBy("k", "shard").applyInArrow(merge, "k int, gram binary, a bigint")


def frequent_words(docs: DataFrame, salt: int, least: int) -> DataFrame:
    """(kind, lang, word, a, mark, gram) in few files: the frequent words (``word``), the
    words of every language (``size``), and marks of frequent words that another word
    shares (``clash``). All three come from one shuffle of the words."""
    counted = word_counts(docs)
    clash = (coded(counted, salt).groupBy("mark").agg(F.count(F.lit(1)).alias("n"), F.max("a").alias("a"))
             .filter((F.col("n") > 1) & (F.col("a") >= least)))
    words = coded(counted.filter(F.col("a") >= least), salt)
    sizes = counted.groupBy("lang").agg(F.sum("a").alias("a"))
    found = words.withColumn("kind", F.lit("word"))
    for kind, rows in (("size", sizes), ("clash", clash.select("mark", "a"))):
        found = found.unionByName(rows.withColumn("kind", F.lit(kind)), allowMissingColumns=True)
    return stored(found.repartition(FILES))


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, inside_percent: int = 100,
                 filter_bits: int = FILTER_BITS, shard_entries: int = SHARD_ENTRIES,
                 id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` best phrases of 2 to 5 words of every language.

    Text is lower-cased (A-Z) and split into pieces at ``.,;:!?`` and line ends,
    pieces into words at blanks and tabs. A phrase occurs ``a`` times within
    pieces, overlaps included; phrases with a >= ``least`` are candidates. Cut in
    two parts that occur l and r times, a phrase scores floor(1000 a n / (l r)),
    n being the words of the language; its lowest-scoring cut counts, of equal
    ones the shortest first part. A phrase inside a longer candidate that has
    ``inside_percent`` of its occurrences is dropped. Ranks go by score, a
    (both descending) and phrase (by bytes). All counts and scores are exact.

    Returns lang, rank, phrase, a, l, r, n, score. Null texts count as empty, a
    null language is ``und``; ids are not used, so repeated rows count twice. An
    empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for salt in range(SALTS):
        found = frequent_words(docs, salt, least)
        if found.filter("kind = 'clash'").isEmpty():
            break
    else:
        raise RuntimeError("no salt keeps the words' codes apart")
    common = found.filter("kind = 'word'")
    sizes = found.filter("kind = 'size'").select("lang", F.col("a").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    shard_bits = max(0, (total // shard_entries).bit_length())
    quotient = 2 if shard_bits <= 16 else 4

    send = spark.sparkContext.broadcast
    words_map = send(bitmap(common, filter_bits))
    pairs_map = send(bitmap(frequent_marks(docs, salt, words_map, filter_bits, least, quotient,
                                           shard_bits), filter_bits))
    phrases = stored(frequent_grams(docs, salt, words_map, pairs_map, filter_bits, least,
                                    quotient, shard_bits).repartition(FILES))
    return ranked(common, phrases, sizes, top, inside_percent)


def ranked(words: DataFrame, phrases: DataFrame, sizes: DataFrame, top: int,
           inside_percent: int) -> DataFrame:
    """Score the candidates by their best-explained cut and rank them by language."""
    phrases = phrases.select("gram", "k", "a")
    counts = words.select("gram", "a").union(phrases.select("gram", "a"))
    runs = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("k") - 1),
        lambda n: F.transform(F.sequence(F.lit(0), F.col("k") - n),
                              lambda at: F.struct(at.alias("at"), n.alias("n")))))
    inside = (phrases.filter("k > 2").select("gram", "a", F.explode(runs).alias("run"))
              .select(F.expr("substring(gram, 8 * run.at + 1, 8 * run.n)").alias("gram"), "a")
              .groupBy("gram").agg(F.max("a").alias("longer")))
    kept = (phrases.join(inside, "gram", "left")
            .filter(F.col("longer").isNull()
                    | (100 * F.col("longer") < inside_percent * F.col("a")))
            .withColumn("lead", F.substring("gram", 1, 8))
            .join(words.select(F.col("gram").alias("lead"), "lang"), "lead")
            .join(sizes, "lang").select("gram", "k", "a", "lang", "n"))
    cuts = (kept.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
            .withColumn("left", F.expr("substring(gram, 1, 8 * cut)"))
            .withColumn("right", F.expr("substring(gram, 8 * cut + 1)"))
            .join(counts.select(F.col("gram").alias("left"), F.col("a").alias("l")), "left")
            .join(counts.select(F.col("gram").alias("right"), F.col("a").alias("r")), "right")
            .select("*", (F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(15,0)")
                          * F.col("n").cast("decimal(17,0)")).alias("up"),
                    (F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)"))
                    .alias("down"))
            .withColumn("score", F.expr("up div down")))
    scored = cuts.groupBy("gram").agg(
        F.first("lang").alias("lang"), F.first("k").alias("k"), F.first("a").alias("a"),
        F.first("n").alias("n"), F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    texts = (kept.select("gram", F.posexplode(F.sequence(F.lit(0), F.col("k") - 1)).alias("at", "_"))
             .withColumn("word_gram", F.expr("substring(gram, 8 * at + 1, 8)"))
             .join(words.select(F.col("gram").alias("word_gram"), "word"), "word_gram")
             .groupBy("gram").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
             .select("gram", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.join(texts, "gram")
            .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
            .withColumn("rank", F.row_number().over(order).cast("bigint"))
            .filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


ORACLE = """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\\x20\\x09]+') IF x <> ''] AS w FROM p),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
k AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
g AS (SELECT lang, k, unnest([w[i:i + k - 1] FOR i IN range(1, len(w) - k + 2)]) AS g
      FROM w, k WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS a
      FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT * FROM f WHERE k > 1 AND NOT EXISTS (
        SELECT 1 FROM f b WHERE b.lang = f.lang AND b.k > f.k AND 100 * b.a >= 100 * f.a
        AND contains(' ' || b.phrase || ' ', ' ' || f.phrase || ' '))),
cut AS (SELECT c.lang, c.phrase, c.a, x.j, l.a AS l, r.a AS r, n,
               ((1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a))::BIGINT AS score
        FROM c JOIN sizes USING (lang) JOIN (SELECT unnest([1, 2, 3, 4]) AS j) x ON x.j < c.k
        JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.g[1:x.j], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.g[x.j + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (
           PARTITION BY lang, phrase ORDER BY score, j) = 1),
o AS (SELECT *, row_number() OVER (
        PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000"""
