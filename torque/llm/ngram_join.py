"""Operator 7: exact n-gram Jaccard join in size-banded tiles.

1. Texts with equal shingle sets fall into one class, by a hash of the set.
2. Linked sets differ in few elements: at most d for two sets of a size band.
   Elements are dealt by hash into more than d parts, so two linked sets have
   some equal, non-empty part. Each set sends a hash per part, for its own band
   and for a higher one that it can still link into; sets with a common hash
   are tied. Widely shared elements (boilerplate, quoted passages) are left out
   of the parts, which keeps the guarantee, unless a set would lose it: then it
   sends its parts with all elements besides. Of its parts a set keeps back the
   smallest, as many as the guarantee can spare: parts of one or two elements
   are what unlike texts share by chance, more of them the larger the table.
   Two sets with a common hash are tied only if their marks allow a link: a mark
   is the parity of a set's elements that hash to one place, and every place in
   which two sets differ is an element that only one of them has. Of a hash that
   many sets share, all are tied to one.
3. Tied sets of one group are sorted by size and cut into bands of bounded
   volume. Each pair of bands whose sizes allow a link is a tile.
4. Inside a tile every set has a bitmap of hashed elements. A bit that only one
   of two sets has is an element that only it has, so bit counts bound the
   overlap from above; pairs that pass are intersected exactly, as sorted
   arrays. No pairs are emitted: a tile returns one root per set and, if links
   are to be counted, how many copies of other sets each set links with; every
   pair of sets is counted in one tile. Where they are not counted, sets already
   known to be connected are not compared again.

Part hashes travel packed, one row per batch and hash bucket. A hash that many
sets of a batch share is sent once, and their ties with it. Everything but the fixed-size list of widely shared
elements is distributed; links are lost nowhere.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from torque.llm.columns import stored
from torque.llm.components import components
from torque.llm.packing import (MARK, bucket_keys, by_bucket, document_row, found_row, from_planes,
                                packed_rows, planes)
from torque.llm.segments import gather_ranges
from torque.llm.wordhash import SLICE_BYTES, STEP, Words, mix, text_slices, window_hashes
from torque.llm.worker_memory import release

COMMON_LOCAL = 16         # sets of one batch that make an element a candidate for the list
COMMON_LISTED = 65_536    # length of the list of widely shared elements (no effect on links)
PAIRED = 8                # documents with one part hash that are tied pair by pair
MARK_BITS = 1 << 15       # most marks of a set (no effect on links)
BAND_GROWTH = 1.5         # of sizes from one band to the next
BAND_SHINGLES = 2_000_000 # elements in one band of a tile
SIZE_SLICES = 64          # of a group's sets of one size, for running volumes
COMPARED_WORDS = 1 << 20   # 64-bit words of bitmaps compared at once
HOT_SHARE = 2_048         # a set that holds over one in so many rows is hot; fewer than that are
PART_ROWS = "bucket int, docs binary, places binary, keys binary, found boolean"


def shingle_sets(column: pa.Array, words_each: int) -> list[np.ndarray]:
    """Ascending distinct shingle hashes of each text; a shorter text is one shingle."""
    split = Words(column, lower=True)
    hashes = split.hashes()
    windows = window_hashes(hashes, words_each)
    out = []
    for a, b in zip(split.bounds[:-1].tolist(), split.bounds[1:].tolist()):
        if b - a >= words_each:
            out.append(np.unique(windows[a:b - words_each + 1]))
        elif b > a:
            out.append(window_hashes(hashes[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_hash(elements: np.ndarray) -> int:
    return int(mix(np.sum(mix(elements), dtype=np.uint64)[None] + np.uint64(len(elements)))
               .view(np.int64)[0])


@lru_cache(maxsize=8)
def size_bands(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least size, allowed differences and number of parts of each size band."""
    low = [1]
    while low[-1] < 1 << 40:
        low.append(max(low[-1] + 1, int(low[-1] * BAND_GROWTH)))
    low = np.array(low, np.int64)
    largest = low[1:] - 1
    differ = (100 - percent) * 2 * largest // (100 + percent)
    return low[:-1], differ, differ + 1 + np.maximum(3, largest // 24)


def part_hashes(elements: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of a set's parts; linked sets share at least one.

    At least g parts of two linked sets are equal, so each may keep back all parts
    with fewer elements than its g-th smallest one: the largest of the equal parts
    is not among them, in either set.
    """
    n = len(elements)
    lows, differ, parts = size_bands(percent)
    own = int(np.searchsorted(lows, n, "right")) - 1
    rare = elements
    if len(common):
        at = np.minimum(np.searchsorted(common, elements), len(common) - 1)
        rare = elements[common[at] != elements]
    out, band = [], own
    apart = (100 - percent) * n // percent      # no linked set differs in more elements
    while band == own or lows[band] * percent <= 100 * n:
        m = int(parts[band])
        for level, members in enumerate((rare, elements)):
            place = (mix(members + np.uint64(band)) % np.uint64(m)).astype(np.int64)
            sums = np.zeros(m, np.uint64)
            np.add.at(sums, place, mix(members ^ STEP))
            held = np.bincount(place, minlength=m)
            # of two linked sets at least m - differ parts are equal, and m - apart
            spare = m - min(int(differ[band]), apart) - 1
            least = int(np.partition(held, spare)[spare])
            sent = np.flatnonzero(held >= max(least, 1))
            out.append(mix(sums[sent] + (sent.astype(np.uint64) << np.uint64(20))
                           + np.uint64(band * 4 + level)))
            if least:
                break
        else:                        # even with all elements too many parts are empty
            out.append(mix(np.array([band * 4 + 2], np.uint64)))
        band += 1
    return np.concatenate(out)


def parity_marks(elements: np.ndarray) -> bytes:
    """Parities of the elements that hash to each place, of places as many as elements
    or up to twice as many."""
    bits = min(MARK_BITS, 1 << max(6, (len(elements) - 1).bit_length()))
    place = (mix(elements) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits) & 1, bitorder="little").tobytes()


def may_link(sizes: list[np.ndarray], marks: list[np.ndarray], percent: int) -> np.ndarray:
    """For pairs, given as sizes and marks of the left and of the right sets: whether
    they may be linked. Marks are folded to the width of the shorter ones."""
    total = sizes[0] + sizes[1]
    out = np.zeros(len(total), bool)
    widths = [np.array([len(m) for m in side], np.int64) for side in marks]
    for pair in set(zip(*(w.tolist() for w in widths))):
        at = np.flatnonzero((widths[0] == pair[0]) & (widths[1] == pair[1]))
        folded = []
        for side, width in zip(marks, pair):
            rows = np.frombuffer(b"".join(side[at]), np.uint64).reshape(len(at), -1)
            while width > min(pair):
                width //= 2
                rows = rows[:, :width // 8] ^ rows[:, width // 8:]
            folded.append(rows)
        apart = np.bitwise_count(folded[0] ^ folded[1]).sum(axis=1, dtype=np.int64)
        apart = np.maximum(apart, np.abs(sizes[0][at] - sizes[1][at]))
        out[at] = (100 + percent) * apart <= (100 - percent) * total[at]
    return out


class Bitmaps:
    """Hashed bitmaps of sets, each as wide as its own size asks for.

    A bitmap is folded to half its width by joining its halves, so two sets are
    compared at the width of the narrower one; linked sets are of like size.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.level = np.array([max(8, (2 * len(s) - 1).bit_length()) if len(s) else 8
                               for s in sets], np.int64)
        self.row = np.zeros(len(sets), np.int64)
        self.marks = {}
        for level in np.unique(self.level).tolist():
            members = np.flatnonzero(self.level == level)
            self.row[members] = np.arange(len(members))
            marks = self.marks[level] = np.zeros((len(members), 1 << (level - 6)), np.uint64)
            for row, i in zip(marks, members):
                place = mix(sets[i]) & np.uint64((1 << level) - 1)
                np.bitwise_or.at(row, (place >> np.uint64(6)).astype(np.int64),
                                 np.uint64(1) << (place & np.uint64(63)))

    def _at(self, level: int, members: np.ndarray, width: int) -> np.ndarray:
        marks = self.marks[level][self.row[members]]
        for _ in range(level - width):
            half = marks.shape[1] // 2
            marks = marks[:, :half] | marks[:, half:]
        return marks

    def only(self, p: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits that p alone has, and that each other alone has: never more than the
        elements that are in one of the two only."""
        mine, theirs = np.zeros(len(others), np.int64), np.zeros(len(others), np.int64)
        own, levels = int(self.level[p]), self.level[others]
        for level in np.unique(levels).tolist():
            width = min(level, own)
            a = self._at(own, np.array([p]), width)[0]
            where = np.flatnonzero(levels == level)
            step = max(1, COMPARED_WORDS >> (level - 6))
            for part in (where[i:i + step] for i in range(0, len(where), step)):
                b = self._at(level, others[part], width)
                mine[part] = np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64)
                theirs[part] = np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64)
        return mine, theirs


def linked_roots(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Root (smallest place) per set under links of at least ``percent`` similarity."""
    sizes = np.array([len(s) for s in sets], np.int64)
    bitmaps = Bitmaps(sets)
    roots = np.arange(len(sets))
    rest = np.argsort(sizes, kind="stable")
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        root = frontier[0]
        while frontier and len(rest):
            p = frontier.pop()
            low = np.searchsorted(sizes[rest], -(-percent * sizes[p] // 100))
            high = np.searchsorted(sizes[rest], 100 * sizes[p] // percent, "right")
            near = rest[low:high]
            only_p, only_q = bitmaps.only(p, near)
            most = np.minimum(sizes[p] - only_p, sizes[near] - only_q)
            total = sizes[p] + sizes[near]
            found = np.zeros(len(near), bool)
            for k in np.flatnonzero((100 + percent) * most >= percent * total):
                q = sets[near[k]]
                at = np.minimum(np.searchsorted(sets[p], q), sizes[p] - 1)
                shared = int(np.count_nonzero(sets[p][at] == q))
                found[k] = (100 + percent) * shared >= percent * total[k]
            hit = near[found]
            if len(hit):
                roots[hit] = root
                frontier.extend(hit.tolist())
                keep = np.ones(len(rest), bool)
                keep[low:high] = ~found
                rest = rest[keep]
    # name each component by its smallest place
    least = np.full(len(sets), len(sets))
    np.minimum.at(least, roots, np.arange(len(sets)))
    return least[roots]


def link_counts(sets: list[np.ndarray], copies: np.ndarray, bands: np.ndarray, home: np.ndarray,
                percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Root (smallest place) per set, and the copies of all sets that it links with.

    Two sets of one band are compared only where the tile is their band's home.
    Intersections are exact: the elements of all sets get codes, those of one set
    are marked, and the marks are summed over each set that its bitmap lets pass.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    bitmaps = Bitmaps(sets)
    starts = np.cumsum(sizes) - sizes
    codes = np.unique(np.concatenate(sets or [np.zeros(0, np.uint64)]), return_inverse=True)[1]
    marked = np.zeros(len(codes), bool)
    roots, links = np.arange(len(sets)), np.zeros(len(sets), np.int64)
    order = np.argsort(sizes, kind="stable")
    ends = np.searchsorted(sizes[order], 100 * sizes[order] // percent, "right")
    for i, p in enumerate(order.tolist()):
        near = order[i + 1:ends[i]]
        if not home[p]:
            near = near[bands[near] != bands[p]]
        only_p, only_q = bitmaps.only(p, near)
        most = np.minimum(sizes[p] - only_p, sizes[near] - only_q)
        near = near[(100 + percent) * most >= percent * (sizes[p] + sizes[near])]
        if not len(near):
            continue
        own = codes[starts[p]:starts[p] + sizes[p]]
        marked[own] = True
        shared = np.add.reduceat(marked[gather_ranges(codes, starts[near], sizes[near])],
                                 np.cumsum(sizes[near]) - sizes[near], dtype=np.int64)
        marked[own] = False
        near = near[(100 + percent) * shared >= percent * (sizes[p] + sizes[near])]
        links[p] += copies[near].sum()
        links[near] += copies[p]
        joined = np.unique(roots[np.append(near, p)])
        if len(joined) > 1:
            roots[np.isin(roots, joined)] = joined[0]
    return roots, links


def ngram_jaccard_join(docs: DataFrame, percent: int = 85, words_each: int = 4,
                       id_col: str = "doc_id", text_col: str = "text",
                       by_text: bool = False, count_links: bool = False) -> DataFrame:
    """Components of documents whose shingle sets have 100 |A & B| >= percent |A | B|.

    Words are runs of non-blank characters with A-Z lower-cased. Returns
    doc_id, ``n_shingles`` (distinct), ``set_id`` (hash of the set; equal sets
    share it), ``component_id``: the smallest doc_id reachable by links.

    Null, empty and blank texts have an empty set and link with nothing:
    component_id is their own id. Rows that repeat an id all count and each
    get a row, which may name different components if their texts differ.
    Rows with a null id get a row but are linked by equal sets only; their
    component_id is null unless a row with an id has the same set. An empty table gives an empty result; other
    columns are not read. Elements are 64-bit hashes, and a set is known by
    its size and a 64-bit hash.

    With ``by_text``, rows also have ``text_hash`` (xxhash64 of the text, null as
    empty) and ``stays``: true for the rows of one id and text in each component,
    the smallest, and for rows with an empty set.

    With ``count_links``, rows also have ``n_links``: the other rows with an id
    whose sets are equal to this row's set or link with it (0 for an empty set).
    A row that repeats an id counts like any other.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def shared_here(batches):
        release()
        for batch in batches:
            seen, all_sets = set(), []
            for _, part in text_slices(batch.column(0)):
                for s in shingle_sets(part, words_each):
                    key = (len(s), set_hash(s))
                    if key not in seen:
                        seen.add(key)
                        all_sets.append(s)
            elements, counts = np.unique(np.concatenate(all_sets or [np.zeros(0, np.uint64)]),
                                         return_counts=True)
            often = counts >= COMMON_LOCAL
            yield pa.RecordBatch.from_arrays(
                [pa.array(elements[often].view(np.int64)), pa.array(counts[often])],
                names=["element", "n"])

    listed = (rows.select("text").mapInArrow(shared_here, "element bigint, n bigint")
              .groupBy("element").agg(F.sum("n").alias("n"))
              .orderBy(F.desc("n"), "element").limit(COMMON_LISTED).collect())
    shared = spark.sparkContext.broadcast(
        np.sort(np.array([r["element"] for r in listed], np.int64).view(np.uint64)))
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def profile(batches):
        release()
        for batch in batches:
            for at, part in text_slices(batch.column(1)):
                sets = shingle_sets(part, words_each)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_hash(s) for s in sets], pa.int64()),
                     batch.column(2).slice(at, len(part)),
                     pa.array([parity_marks(s) if len(s) else None for s in sets], pa.binary())],
                    names=["doc_id", "n_shingles", "set_id", "text_hash", "marks"])

    def send_parts(batches):
        release()
        for batch in batches:
            known = batch.filter(batch.column(0).is_valid())
            for at, part in text_slices(known.column(1), 4 * SLICE_BYTES):
                docs = known.column(0).slice(at, len(part)).to_numpy()
                packed = _packed_parts(part, docs, words_each, percent, shared.value, buckets)
                if packed:
                    yield packed_rows(packed)

    profiles = stored(rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        profile, f"doc_id {kind}, n_shingles bigint, set_id bigint, text_hash bigint, marks binary"))
    ties = (rows.withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(
        send_parts, PART_ROWS).groupBy("bucket").applyInArrow(
            _part_ties, "a bigint, b bigint, sure boolean"))
    groups = components(_possible(ties, profiles, percent))
    # an id with several texts ties them to each other, also if it is tied to no other id
    several = (profiles.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(
        F.col("doc_id").cast("bigint").alias("node"))
        .agg(F.min("set_id").alias("x"), F.max("set_id").alias("y"))
        .filter("x <> y").select("node", F.col("node").alias("root"))
        .join(groups, "node", "left_anti"))
    # one row per distinct set before anything meets by set, so that a text with
    # many copies weighs no more than another
    alike = profiles.filter("n_shingles > 0").groupBy("set_id", "n_shingles").agg(
        F.count(F.lit(1)).alias("copies"), F.count("doc_id").alias("near"), F.min(F.when(
            F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("first"))
    alike = stored(alike) if count_links else alike.drop("near")
    tiles = _tiles(rows, profiles, groups.union(several), percent,
                   alike if count_links else None).groupBy("tile")
    if count_links:
        compared = stored(tiles.applyInArrow(
            lambda table: _tile_counts(table, words_each, percent),
            "a bigint, b bigint, links bigint"))
        links = compared.select("a", "b")
        counts = compared.groupBy(F.col("a").alias("set_id")).agg(F.sum("links").alias("links"))
    else:
        links = tiles.applyInArrow(
            lambda table: _tile_links(table, words_each, percent), "a bigint, b bigint")
    roots = components(links)
    near = ["near"] if count_links else []
    if count_links:
        alike = alike.join(counts, "set_id", "left").withColumn(
            "near", F.col("near") + F.coalesce("links", F.lit(0)))
    named = alike.join(roots, F.col("set_id") == F.col("node"), "left").select(
        "set_id", "n_shingles", "copies", "first", *near, F.coalesce("root", "set_id").alias("root"),
        F.when(F.col("root").isNull(), F.col("n_shingles")).alias("own_size"))
    named = stored(named)
    least = named.groupBy("root", "own_size").agg(F.min("first").alias("least"))
    own, other = named.alias("a"), least.alias("b")
    sets = stored(own.join(other, (F.col("a.root") == F.col("b.root")) & F.col(
        "a.own_size").eqNullSafe(F.col("b.own_size"))).select(
            F.col("a.set_id").alias("s"), F.col("a.n_shingles").alias("n"), "copies", *near,
            F.col("least").alias("first")))
    # the rows of hot sets, of which there are fewer than HOT_SHARE, meet them by broadcast
    total = sets.agg(F.sum("copies")).first()[0] or 0
    hot = F.col("copies") * HOT_SHARE > total
    same = (F.col("set_id") == F.col("s")) & (F.col("n_shingles") == F.col("n"))
    few = F.broadcast(sets.filter(hot))
    met = profiles.join(few, same).unionByName(
        profiles.join(few, same, "left_anti").join(sets.filter(~hot), same, "left"))
    found = F.col("n_shingles") > 0
    more = [] if not by_text else ["text_hash", (~found | F.struct("doc_id", "text_hash").eqNullSafe(
        F.col("first"))).alias("stays")]
    if count_links:
        others = F.col("near") - F.col("doc_id").isNotNull().cast("bigint")
        more.append(F.when(found, others).otherwise(F.lit(0)).alias("n_links"))
    return met.select("doc_id", "n_shingles", "set_id", F.when(found, F.col("first.doc_id"))
                      .otherwise(F.col("doc_id")).alias("component_id"), *more)


def _packed_parts(texts: pa.Array, docs: np.ndarray, words_each: int, percent: int,
                  common: np.ndarray, n: int) -> list[tuple]:
    """Packed rows of some documents: their part hashes, but one that over PAIRED of them
    share once, flagged, and the ties of the others with that one."""
    seen, hashes, places = set(), [], []
    for at, part in text_slices(texts):
        for i, elements in enumerate(shingle_sets(part, words_each), at):
            key = (len(elements), set_hash(elements))
            if len(elements) and key not in seen:
                seen.add(key)
                hashes.append(part_hashes(elements, common, percent))
                places.append(np.full(len(hashes[-1]), i))
    if not hashes:
        return []
    hashes, places = np.concatenate(hashes), np.concatenate(places)
    order = np.lexsort((docs[places], hashes))
    hashes, places = hashes[order], places[order]
    fresh = np.concatenate(([True], hashes[1:] != hashes[:-1]))
    run = np.cumsum(fresh) - 1
    first, many = places[fresh][run], (np.bincount(run) > PAIRED)[run]
    tied = np.unique(np.stack((places[many & ~fresh], first[many & ~fresh])), axis=1)
    rows = found_row(docs, tied[0], docs[tied[1]], n)
    sent = fresh | ~many
    bucket, key = bucket_keys(hashes[sent], n)
    places, many = places[sent], many[sent]
    order = np.lexsort((key, bucket))
    bucket, key, places, many = bucket[order], key[order], places[order], many[order]
    for b, part in by_bucket(bucket, n):
        steps = np.diff(key[part], prepend=np.uint32(0))
        rows.append((b, *document_row(docs, places[part], many[part]), planes(steps), False))
    return rows


def _part_ties(table: pa.Table) -> pa.Table:
    """(a, b, sure) per part hash: each pair of the documents that have it or, of more than
    PAIRED documents, each one and the smallest. These ties are sure, as others hang on them."""
    docs, keys, flags = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)], [np.zeros(0, bool)]
    left, right, sure = [], [], []
    for row in table.to_pylist():
        names, at = from_planes(row["docs"], np.int64), from_planes(row["places"], np.uint32)
        if row["found"]:
            left.append(names[at])
            right.append(from_planes(row["keys"], np.int64))
            sure.append(np.ones(len(at), bool))
        else:
            docs.append(names[at & ~MARK])
            flags.append((at & MARK) > 0)
            keys.append(np.cumsum(from_planes(row["keys"], np.uint32), dtype=np.uint32))
    docs, keys, flags = np.concatenate(docs), np.concatenate(keys), np.concatenate(flags)
    order = np.lexsort((docs, keys))
    docs, keys, flags = docs[order], keys[order], flags[order]
    fresh = np.append(True, keys[1:] != keys[:-1])[:len(keys)]
    run = np.cumsum(fresh) - 1
    first = docs[fresh][run]
    many = (np.bincount(run) > PAIRED) | (np.bincount(run, flags) > 0)
    star = many[run] & ~fresh
    left.append(docs[star])
    right.append(first[star])
    sure.append(np.ones(len(left[-1]), bool))
    few = np.flatnonzero(~many[run])
    docs, run = docs[few], run[few]
    for step in range(1, PAIRED):
        same = run[step:] == run[:-step]
        left.append(docs[step:][same])
        right.append(docs[:-step][same])
        sure.append(np.zeros(len(left[-1]), bool))
    a, b, sure = np.concatenate(left), np.concatenate(right), np.concatenate(sure)
    return pa.table({"a": a[a != b], "b": b[a != b], "sure": sure[a != b]})


def _possible(ties: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the ties that are sure or whose sets may be linked by their marks. An id
    with several sets has no marks of its own; its ties stay."""
    ties = stored(ties.groupBy("a", "b").agg(F.max("sure").alias("sure")))
    marks = (profiles.filter("n_shingles > 0 AND doc_id IS NOT NULL")
             .groupBy(F.col("doc_id").cast("bigint").alias("id"))
             .agg(F.min("n_shingles").alias("n"), F.max("n_shingles").alias("n_most"),
                  F.min("set_id").alias("x"), F.max("set_id").alias("y"),
                  F.min("marks").alias("marks"))
             .select("id", "n", F.when((F.col("x") == F.col("y")) & (
                 F.col("n") == F.col("n_most")), F.col("marks")).alias("marks")))
    left, right = (marks.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"),
                                F.col("marks").alias(f"marks_{c}")) for c in "ab")

    def pass_on(batches):
        release()
        for batch in batches:
            known = batch.column("marks_a").is_valid().to_numpy(False) & batch.column(
                "marks_b").is_valid().to_numpy(False)
            kept = ~known
            part = batch.filter(pa.array(known))
            kept[known] = may_link(
                [part.column(f"n_{c}").to_numpy() for c in "ab"],
                [part.column(f"marks_{c}").to_numpy(zero_copy_only=False) for c in "ab"], percent)
            yield batch.select(["a", "b"]).filter(pa.array(kept))

    paired = ties.filter(~F.col("sure")).select("a", "b").join(left, "a").join(right, "b")
    return ties.filter("sure").select("a", "b").union(paired.mapInArrow(
        pass_on, "a bigint, b bigint"))


def _tiles(rows: DataFrame, profiles: DataFrame, groups: DataFrame, percent: int,
           alike: DataFrame | None) -> DataFrame:
    """(tile, set_id, n, text) of every set that a link may join to another set; with the
    table ``alike`` of distinct sets, also its copies, its band and whether the tile is
    the band's home."""
    sets = (groups.join(profiles.filter("n_shingles > 0"), F.col("node") == F.col("doc_id"))
            .groupBy("root", "set_id", "n_shingles").agg(F.min("doc_id").alias("rep")))
    copies = []
    if alike is not None:
        copies = ["copies"]
        sets = sets.join(alike.select("set_id", "n_shingles", F.col("near").alias("copies")),
                         ["set_id", "n_shingles"])
    # running volumes per slice of a group's sets of one size and then over slices, so no
    # task sorts a whole group
    sets = stored(sets.withColumn("slice", F.pmod("set_id", F.lit(SIZE_SLICES))))
    slices = ["root", "n_shingles", "slice"]
    before = sets.groupBy(*slices).agg(F.sum("n_shingles").alias("sum")).select(
        *slices, (F.sum("sum").over(Window.partitionBy("root").orderBy("n_shingles", "slice"))
                  - F.col("sum")).alias("base"))
    volume = F.sum("n_shingles").over(Window.partitionBy(*slices).orderBy("set_id"))
    members = stored(sets.withColumn("volume", volume - F.col("n_shingles"))
                     .join(before, slices).withColumn("band", F.floor(
                         (F.col("base") + F.col("volume")) / F.lit(BAND_SHINGLES)))
                     .select("root", "set_id", "n_shingles", "rep", *copies, "band"))
    bands = members.groupBy("root", "band").agg(F.min("n_shingles").alias("low"),
                                                F.max("n_shingles").alias("high"))
    left, right = bands.alias("l"), bands.alias("r")
    pairs = left.join(right, (F.col("l.root") == F.col("r.root")) & (
        F.col("l.band") <= F.col("r.band")) & (
            F.col("l.high") * 100 >= F.col("r.low") * percent)).select(
                F.col("l.root").alias("root"), F.col("l.band").alias("x"), F.col("r.band").alias("y"))
    # a band that meets others need not be a tile of its own
    met = pairs.filter("x <> y")
    alone = pairs.filter("x = y").join(met.select("root", "x").union(
        met.select("root", F.col("y").alias("x"))).distinct(), ["root", "x"], "left_anti").select(
            "root", "x", "y")
    tiled = met.union(alone).select(
        "root", F.concat_ws("/", "root", "x", "y").alias("tile"),
        F.explode(F.array_distinct(F.array("x", "y"))).alias("band"))
    of_set = [*copies, "band", "home"] if copies else []
    if copies:
        tiled = tiled.withColumn("home", F.col("tile") == F.min("tile").over(
            Window.partitionBy("root", "band")))
    placed = members.join(tiled, ["root", "band"]).select(
        "tile", "set_id", F.col("n_shingles").alias("n"), "rep", *of_set)
    # the representative's text; rows that share its id but not its set are told
    # apart again in the tile
    return (placed.join(rows, F.col("rep") == F.col("doc_id"))
            .select("tile", "set_id", "n", "text", *of_set))


def _tile_sets(table: pa.Table, words_each: int) -> dict[int, np.ndarray]:
    """The sets of a tile by their id."""
    sets: dict[int, np.ndarray] = {}
    column = table.column("text").combine_chunks()
    wanted = table.column("set_id").to_numpy()
    for at, part in text_slices(column):
        for i, elements in enumerate(shingle_sets(part, words_each)):
            if set_hash(elements) == wanted[at + i]:
                sets[int(wanted[at + i])] = elements
    return sets


def _tile_counts(table: pa.Table, words_each: int, percent: int) -> pa.Table:
    """(a, b, links): each linked set of the tile, the root of its component there
    and the copies of the sets that it links with."""
    sets = _tile_sets(table, words_each)
    names = np.array(list(sets), np.int64)
    known, at = np.unique(table.column("set_id").to_numpy(), return_index=True)
    at = at[np.searchsorted(known, names)]
    copies, bands, home = (table.column(c).to_numpy()[at] for c in ("copies", "band", "home"))
    roots, links = link_counts(list(sets.values()), copies, bands, home, percent)
    some = links > 0
    return pa.table({"a": pa.array(names[some], pa.int64()),
                     "b": pa.array(names[roots[some]], pa.int64()),
                     "links": pa.array(links[some], pa.int64())})


def _tile_links(table: pa.Table, words_each: int, percent: int) -> pa.Table:
    """(a, b): each set of the tile and the root of its component there."""
    sets = _tile_sets(table, words_each)
    names = np.array(list(sets), np.int64)
    roots = linked_roots(list(sets.values()), percent)
    joined = roots != np.arange(len(roots))
    return pa.table({"a": pa.array(names[joined], pa.int64()),
                     "b": pa.array(names[roots[joined]], pa.int64())})


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4
          THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
          WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b USING (g)
          JOIN n p ON p.doc_id = a.doc_id JOIN n q ON q.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id, p.n, q.n
          HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(r.y, doc_id)) AS component_id,
       coalesce(l.n, 0)::BIGINT AS n_links
FROM documents LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, count(*) AS n FROM links WHERE x <> y GROUP BY x) l USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, min(y) AS y FROM reach GROUP BY x) r USING (doc_id)
"""
