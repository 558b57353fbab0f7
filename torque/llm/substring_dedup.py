"""Operator 8: substring dedup with fixed-block anchors.

A repeat of 13 words always holds a whole block of 7 words that starts at a
multiple of 7 in the document it comes from. So

1. the non-overlapping 7-word blocks of every document are the index, and every
   rolling 7-word window probes it. Probes and blocks travel as packed arrays,
   one row per batch and hash bucket (about five bytes a word), and each
   distinct window of a batch is sent once, however common it is;
2. a hit anchors a repeat; it is extended to all 13-word windows around it, and
   these are looked up by their full hashes for the smallest document that
   holds them. Neighbouring windows found this way join to maximal repeats;
3. words under a window that a smaller document holds are removed.

Truncated hashes in step 1 can only add candidates; step 2 decides. The texts
are dealt out by doc_id once, and that exchange serves steps 2 and 3.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from torque.llm.packing import (MARK, bucket_keys, by_bucket, document_row, found_row, from_planes,
                                packed_rows, planes)
from torque.llm.segments import gather_ranges
from torque.llm.wordhash import Words, text_slices, window_hashes
from torque.llm.worker_memory import release

PACKED = "bucket int, docs binary, places binary, keys binary, found boolean"
ANSWER = "doc bigint, key bigint"
PROBE_BYTES = 8_000_000          # of texts whose windows are sorted at once


def _answers(docs: np.ndarray, keys: np.ndarray) -> pa.Table:
    """Documents and keys, by document."""
    order = np.argsort(docs, kind="stable")
    return pa.table({"doc": pa.array(docs[order], pa.int64()),
                     "key": pa.array(keys[order], pa.int64())})


def _joined_key(bucket, key: np.ndarray, n: int) -> np.ndarray:
    return key.astype(np.int64) * n + bucket


def _probes(batch_texts: pa.Array, docs: np.ndarray, window: int, block: int, n: int):
    """Packed rows of one batch: every distinct block-sized window once."""
    hashes, places, aligned = [], [], []
    for at, part in text_slices(batch_texts):
        split = Words(part)
        rolled = window_hashes(split.hashes(), block)
        sizes = np.diff(split.bounds)
        count = np.where(sizes >= window, sizes - block + 1, 0)
        start = split.bounds[:-1]
        hashes.append(gather_ranges(rolled, start, count))
        places.append(np.repeat(np.arange(at, at + len(part)), count))
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        aligned.append(inside % block == 0)
    hashes, places, aligned = map(np.concatenate, (hashes, places, aligned))
    if not len(hashes):
        return []
    order = np.argsort(hashes, kind="stable")            # places ascend within a hash
    hashes, places, aligned = hashes[order], places[order], aligned[order]
    fresh = np.concatenate(([True], hashes[1:] != hashes[:-1]))
    group = np.cumsum(fresh) - 1
    has_block = np.zeros(group[-1] + 1, bool)
    np.logical_or.at(has_block, group, aligned)
    new_doc = fresh | np.concatenate(([True], places[1:] != places[:-1]))
    several = np.bincount(group, new_doc) > 1
    local = several & has_block                          # a hit within this batch
    bucket, key = bucket_keys(hashes, n)
    hit = new_doc & local[group]
    rows = found_row(docs, places[hit], _joined_key(bucket[hit], key[hit], n), n)
    # One entry stands for a group that is a hit already; else each document sends one.
    sent = np.where(local[group], fresh, new_doc)
    bucket, key, places, flags = bucket[sent], key[sent], places[sent], has_block[group][sent]
    order = np.lexsort((key, bucket))
    bucket, key, places, flags = bucket[order], key[order], places[order], flags[order]
    for b, part in by_bucket(bucket, n):
        steps = np.diff(key[part], prepend=np.uint32(0))
        rows.append((b, *document_row(docs, places[part], flags[part]), planes(steps), False))
    return rows


def _block_hits(table: pa.Table, n: int) -> pa.Table:
    """Answer one bucket: entries whose key some other entry has, one of them a block."""
    docs, keys, flags, out_docs, out_keys = [], [], [], [], []
    for row in table.to_pylist():
        names, at = from_planes(row["docs"], np.int64), from_planes(row["places"], np.uint32)
        if row["found"]:
            out_docs.append(names[at])
            out_keys.append(from_planes(row["keys"], np.int64))
        else:
            docs.append(names[(at & ~MARK).astype(np.int64)])
            flags.append((at & MARK) != 0)
            keys.append(np.cumsum(from_planes(row["keys"], np.uint32), dtype=np.uint32))
        bucket = row["bucket"]
    if keys:
        docs, keys, flags = map(np.concatenate, (docs, keys, flags))
        order = np.argsort(keys, kind="stable")
        docs, keys, flags = docs[order], keys[order], flags[order]
        start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        size = np.diff(np.append(start, len(keys)))
        blocks = np.logical_or.reduceat(flags, start)
        hit = np.repeat((size > 1) & blocks, size)
        out_docs.append(docs[hit])
        out_keys.append(_joined_key(bucket, keys[hit], n))
    return _answers(np.concatenate(out_docs or [np.zeros(0, np.int64)]),
                    np.concatenate(out_keys or [np.zeros(0, np.int64)]))


def _covered(marks: np.ndarray, reach: int) -> np.ndarray:
    """Places i with a mark at one of i-reach+1..i."""
    total = np.concatenate(([0], np.cumsum(marks)))
    i = np.arange(len(marks))
    return total[i + 1] > total[np.maximum(i - reach + 1, 0)]


def _windows_at(hashes: np.ndarray, keys: np.ndarray, window: int, block: int, n: int):
    """Starts and hashes of the windows of one document that hold an anchor."""
    bucket, key = bucket_keys(window_hashes(hashes, block), n)
    anchors = np.isin(_joined_key(bucket, key, n), keys)
    near = np.zeros(len(hashes) - window + 1, bool)
    reach = window - block                   # a window starts at most so far before an anchor
    total = np.concatenate(([0], np.cumsum(anchors)))
    i = np.arange(len(near))
    near = total[np.minimum(i + reach + 1, len(anchors))] > total[i]
    starts = np.flatnonzero(near)
    return starts, window_hashes(hashes, window)[starts]


def _candidates(batch: pa.RecordBatch, window: int, block: int, n: int, out_n: int):
    """Packed rows of the candidate windows of one batch, by their full hashes."""
    keys = batch.column(2)
    docs, hashes, places = batch.column(0).to_numpy(zero_copy_only=False), [], []
    for at, part in text_slices(batch.column(1)):
        split = Words(part)
        own = split.hashes()
        for i in range(len(part)):
            found = keys[at + i]
            a, b = split.bounds[i], split.bounds[i + 1]
            if found.is_valid and len(found) and b - a >= window:
                _, full = _windows_at(own[a:b], found.values.to_numpy(), window, block, n)
                full = np.unique(full)
                hashes.append(full)
                places.append(np.full(len(full), at + i))
    if not hashes:
        return []
    hashes, places = np.concatenate(hashes), np.concatenate(places)
    order = np.lexsort((docs[places], hashes))
    hashes, places = hashes[order], places[order]
    fresh = np.concatenate(([True], hashes[1:] != hashes[:-1]))
    least = docs[places][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    late = docs[places] > least              # a smaller document of this batch has it
    rows = found_row(docs, places[late], hashes[late].view(np.int64), out_n)
    hashes, places = hashes[fresh], places[fresh]
    bucket = (hashes % np.uint64(out_n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    hashes, places, bucket = hashes[order], places[order], bucket[order]
    for b, part in by_bucket(bucket, out_n):
        rows.append((b, *document_row(docs, places[part]), hashes[part].tobytes(), False))
    return rows


def _late_windows(table: pa.Table) -> pa.Table:
    """Answer one bucket: windows that a smaller document has, by document."""
    docs, keys, out_docs, out_keys = [], [], [], []
    for row in table.to_pylist():
        names, at = from_planes(row["docs"], np.int64), from_planes(row["places"], np.uint32)
        if row["found"]:
            out_docs.append(names[at])
            out_keys.append(from_planes(row["keys"], np.int64))
        else:
            docs.append(names[at])
            keys.append(np.frombuffer(row["keys"], np.int64))
    if keys:
        docs, keys = np.concatenate(docs), np.concatenate(keys)
        order = np.lexsort((docs, keys))
        docs, keys = docs[order], keys[order]
        fresh = np.concatenate(([True], keys[1:] != keys[:-1]))
        late = docs > docs[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
        out_docs.append(docs[late])
        out_keys.append(keys[late])
    return _answers(np.concatenate(out_docs or [np.zeros(0, np.int64)]),
                    np.concatenate(out_keys or [np.zeros(0, np.int64)]))


def substring_dedup(docs: DataFrame, window: int = 13, block: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text",
                    carry: list[str] | None = None) -> DataFrame:
    """Remove every word under a window of ``window`` words that also starts in a
    document with a smaller id; windows are judged on the input.

    Returns doc_id, ``n_words``, ``n_removed``, ``kept_sha256`` (of the kept
    words joined by one blank). ``carry`` names columns to hand through as the
    struct ``carried``, beside ``kept_text``: the text as it is where nothing was
    removed, else its kept words joined by one blank. ``block`` is at most
    (window + 1) / 2, its default.

    Null, empty and blank texts have no words; texts shorter than a window keep
    all. Rows that share an id do not remove each other's words; a window
    that a smaller id has is removed from each of them. Rows without id keep all
    words and remove none. An empty table gives an empty result; other columns
    are not read. Windows are compared by 64-bit hashes.
    """
    block = block or (window + 1) // 2
    if 2 * block > window + 1:
        raise ValueError("a window must hold a whole aligned block")
    spark = docs.sparkSession
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the same columns in both joins, so that the texts are dealt out once
    carried = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"), *carried)
    extra = ["carried"] if carry else []

    def probe(batches):
        release()
        for batch in batches:
            known = batch.filter(batch.column(0).is_valid())
            for at, part in text_slices(known.column(1), PROBE_BYTES):
                own = known.column(0).slice(at, len(part)).to_numpy()
                packed = _probes(part, own, window, block, n)
                if packed:
                    yield packed_rows(packed)

    def extend(batches):
        release()
        for batch in batches:
            known = batch.filter(batch.column(0).is_valid())
            if known.num_rows:
                packed = _candidates(known, window, block, n, n)
                if packed:
                    yield packed_rows(packed)

    def by_document(answers: DataFrame, name: str) -> DataFrame:
        return answers.groupBy(F.col("doc").alias(f"{name}_doc")).agg(
            F.collect_list("key").alias(name))

    anchors = by_document(rows.select("doc_id", "text").mapInArrow(probe, PACKED).groupBy("bucket").applyInArrow(
        lambda t: _block_hits(t, n), ANSWER), "anchors")
    anchored = rows.join(anchors, rows["doc_id"] == F.col("anchors_doc"), "left").select(
        "doc_id", "text", "anchors", *extra)
    late = by_document(anchored.mapInArrow(extend, PACKED).groupBy("bucket").applyInArrow(
        _late_windows, ANSWER), "late")

    def cut(batches):
        release()
        for batch in batches:
            for at, part in text_slices(batch.column(1)):
                yield _cut(*[c.slice(at, len(part)) for c in batch.columns], window=window)

    schema = (T.StructType().add("doc_id", "long").add("n_words", "long").add("n_removed", "long")
              .add("kept_sha256", "string"))
    if carry:
        schema = schema.add("kept_text", "string").add("carried", rows.schema["carried"].dataType)
    return (rows.join(late, rows["doc_id"] == F.col("late_doc"), "left")
            .select("doc_id", "text", "late", *extra).mapInArrow(cut, schema))


def _cut(ids: pa.Array, texts: pa.Array, late: pa.Array, carried: pa.Array | None = None, *,
         window: int) -> pa.RecordBatch:
    """The kept words of some documents."""
    split = Words(texts)
    own = split.hashes()
    removed = np.zeros(len(own), bool)
    for i in range(len(texts)):
        a, b = split.bounds[i], split.bounds[i + 1]
        if late[i].is_valid and b - a >= window:
            starts = np.zeros(b - a, bool)
            starts[:b - a - window + 1] = np.isin(
                window_hashes(own[a:b], window).view(np.int64), late[i].values.to_numpy())
            removed[a:b] = _covered(starts, window)
    kept = ~removed
    lengths = (split.end - split.start + 1)[kept]        # with one blank behind each word
    flat = gather_ranges(np.append(split.data, np.uint8(32)), split.start[kept], lengths)
    flat[np.cumsum(lengths) - 1] = 32
    before = np.concatenate(([0], np.cumsum(np.where(kept, split.end - split.start + 1, 0))))
    data, at = flat.tobytes(), before[split.bounds].tolist()
    out = [data[s:max(s, e - 1)] for s, e in zip(at[:-1], at[1:])]
    total = np.concatenate(([0], np.cumsum(removed)))[split.bounds]
    columns = [ids, pa.array(np.diff(split.bounds), pa.int64()), pa.array(np.diff(total), pa.int64()),
               pa.array([hashlib.sha256(x).hexdigest() for x in out])]
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    if carried is not None:
        gone = np.diff(total) > 0
        whole = texts.to_pylist()
        columns += [pa.array([x.decode() if g else t for x, g, t in zip(out, gone, whole)],
                             pa.string()), carried]
        names += ["kept_text", "carried"]
    return pa.RecordBatch.from_arrays(columns, names=names)


ORACLE = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''),
               '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - 11), lambda i:
            struct_pack(p := i, g := array_to_string(ws[i:i + 12], ' ')))) AS x FROM w),
late AS (SELECT doc_id, x.p AS p FROM win
         QUALIFY min(doc_id) OVER (PARTITION BY x.g) < doc_id),
gone AS (SELECT doc_id, list(DISTINCT p + k) AS ps FROM late, range(13) r(k) GROUP BY doc_id),
kept AS (SELECT w.doc_id, len(ws) AS n, coalesce(len(ps), 0) AS r,
           CASE WHEN ps IS NULL THEN ws
                ELSE list_transform(list_filter(range(1, len(ws) + 1),
                       lambda i: NOT list_contains(ps, i)), lambda i: ws[i]) END AS ks
         FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, n::BIGINT AS n_words, r::BIGINT AS n_removed,
       sha256(array_to_string(ks, ' ')) AS kept_sha256 FROM kept
"""
