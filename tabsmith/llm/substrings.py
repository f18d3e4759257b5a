"""Substring removal by relative Lempel-Ziv parsing against the indexed corpus.

A window is ``size`` consecutive words. Every window holds one *anchor*, its smallest
hashed run of ``ANCHOR`` words, and equal windows hold equal anchors; so the corpus is
indexed by anchor, and a document needs the index only where an anchor occurs twice.
There the windows around each anchor are written as a sequence of window hashes (a
segment), and segments with one anchor meet in one reference block. In it a segment is
parsed greedily: a factor starts at a window that the block holds elsewhere, refers to
its earliest other place, and goes on while the next window follows at that place. A
factor of f windows covers f + size - 1 words. Where a factor ends, the next window is
looked up anew, so windows across factor borders are checked too.

Two windows agree when both the hash of the anchor run and the hash of the whole
window (64 bits each) agree. Segments of anchors with more than ``hot`` occurrences do
not meet in one task: equal segments are counted first, which Spark pre-aggregates; one
of each kind is then opened, and its windows are counted by an aggregate on their hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import pick, schema, whole_groups
from tabsmith.llm.words import Words, in_one_doc, mix, ngrams, pieces
from tabsmith.session import materialize

ANCHOR = 8


def window_anchors(w: Words, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor position of each window, whether the window lies in one document, hash of
    the run at each position): the leftmost smallest run of each window."""
    k = min(ANCHOR, size)
    runs = ngrams(h, k)
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, bool), runs
    at = np.arange(len(runs))
    span = 1                                # at[i]: place of the smallest run in [i, i + span)
    width = size - k + 1
    while span < width:
        step = min(span, width - span)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(runs[b] < runs[a], b, a)
        span += step
    return at[:n], in_one_doc(w.doc, size), runs


def anchor_rows(docs: DataFrame, size: int) -> DataFrame:
    """(anchor, doc_id, key, first, n): each run of windows with one anchor place."""
    def rows(batches):
        for batch in batches:
            for piece, buf, offs in pieces(batch, "text"):
                w = Words(buf, offs, lower=False)
                at, whole, runs = window_anchors(w, w.hashes(), size)
                win = np.flatnonzero(whole)
                at = at[win]
                new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (w.doc[win[1:]] != w.doc[win[:-1]])])) if len(at) else win
                n = np.diff(np.concatenate([new, [len(at)]]))
                d = w.doc[win[new]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(runs[at[new]].view(np.int64)), piece.column(0).take(pa.array(d)), piece.column(1).take(pa.array(d)),
                     pa.array((win[new] - w.first[d]).astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=["anchor", "doc_id", "key", "first", "n"])

    return docs.select("doc_id", "key", "text").mapInArrow(
        rows, schema(("anchor", "bigint"), ("doc_id", "bigint"), ("key", "bigint"), ("first", "int"), ("n", "int")))


def segments(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(anchor, hot, doc_id, key, first, windows): window hashes of the wanted places."""
    def rows(batches):
        for batch in batches:
            for piece, buf, offs in pieces(batch, "text"):
                h = Words(buf, offs, lower=False)
                win = ngrams(mix(h.hashes()), size).view(np.int64)
                places = piece.column(3)
                p, lo = places.flatten(), np.asarray(places.offsets) - places.offsets[0].as_py()
                d = np.repeat(np.arange(piece.num_rows), np.diff(lo))
                first, n = np.asarray(p.field("first")).astype(np.int64), np.asarray(p.field("n")).astype(np.int64)
                cum = np.concatenate([[0], np.cumsum(n)])
                take = np.arange(cum[-1]) - np.repeat(cum[:-1], n) + np.repeat(first + h.first[d], n)
                offsets = pa.array(cum.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [p.field("anchor"), p.field("hot"), piece.column(0).take(pa.array(d)), piece.column(1).take(pa.array(d)), p.field("first"),
                     pa.ListArray.from_arrays(offsets, pa.array(win[take]))],
                    names=["anchor", "hot", "doc_id", "key", "first", "windows"])

    at = wanted.groupBy("doc_id", "key").agg(F.collect_list(F.struct("anchor", "hot", "first", "n")).alias("places"))
    a, b = docs.alias("a"), at.alias("b")
    both = a.join(b, (F.col("a.key") == F.col("b.key")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")))
    return both.select("a.doc_id", "a.key", "a.text", "b.places").mapInArrow(
        rows, schema(("anchor", "bigint"), ("hot", "boolean"), ("doc_id", "bigint"), ("key", "bigint"), ("first", "int"), ("windows", "array<bigint>")))


def parse_blocks(segs: DataFrame) -> DataFrame:
    """(doc_id, key, first, n): the factors of all segments, n windows from first."""
    def rows(batches):
        for t in whole_groups(batches, "anchor"):
            seg = t.column("windows").combine_chunks()
            n = np.diff(np.asarray(seg.offsets))
            tok = np.asarray(seg.flatten()).view(np.uint64)
            owner = np.repeat(np.arange(t.num_rows), n)
            anchor = t.column("anchor").to_numpy().view(np.uint64)[owner]
            order = np.lexsort((tok, anchor))       # stable: places of one window stay in order
            new = np.concatenate([[True], (tok[order[1:]] != tok[order[:-1]]) | (anchor[order[1:]] != anchor[order[:-1]])]) if len(tok) else np.zeros(0, bool)
            begin = np.flatnonzero(new)
            first = np.repeat(order[begin], np.diff(np.concatenate([begin, [len(tok)]])))
            later = np.concatenate([~new[1:], [False]]) if len(new) else new
            other = np.where(new, np.where(later, np.concatenate([order[1:], order[:1]]) if len(order) else order, -1), first)
            ref = np.empty(len(tok), np.int64)
            ref[order] = other                      # earliest other place of each window, -1: none
            goes_on = np.zeros(len(tok), bool)
            goes_on[1:] = (ref[1:] >= 0) & (ref[:-1] >= 0) & (ref[1:] == ref[:-1] + 1) & (owner[1:] == owner[:-1])
            at = np.flatnonzero((ref >= 0) & ~goes_on)
            stop = np.flatnonzero((ref >= 0) & ~np.concatenate([goes_on[1:], [False]])) + 1 if len(tok) else at
            own = owner[at]
            starts = np.concatenate([[0], np.cumsum(n)])[own]
            pick_ = pa.array(own)
            yield pa.RecordBatch.from_arrays(
                [t.column("doc_id").combine_chunks().take(pick_), t.column("key").combine_chunks().take(pick_),
                 pa.array((at - starts + t.column("first").to_numpy()[own]).astype(np.int32)), pa.array((stop - at).astype(np.int32))],
                names=["doc_id", "key", "first", "n"])

    return (segs.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "key", "first")
            .mapInArrow(rows, schema(("doc_id", "bigint"), ("key", "bigint"), ("first", "int"), ("n", "int"))))


def duplicate_spans(docs: DataFrame, size: int = 50, hot: int = 2000) -> DataFrame:
    """(doc_id, key, spans): windows (first, n) of each document that start elsewhere too;
    n = -1 stands for all of them. ``docs`` has doc_id, key and text; (doc_id, key) names
    equal rows only. Rows that occur several times repeat each other as a whole, so one of
    them stands for all against the others."""
    copies = materialize(docs.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id", "key"), "copies")
    if copies.isEmpty():
        return _spans(docs, size, hot)
    c = copies.select(F.col("doc_id").alias("c_id"), F.col("key").alias("c_key"))
    same = docs["doc_id"].eqNullSafe(c["c_id"]) & (docs["key"] == c["c_key"])
    one = docs.join(c, same, "left_anti").union(docs.join(c, same, "left_semi").dropDuplicates(["doc_id", "key"]))
    whole = copies.select("doc_id", "key", F.array(F.struct(F.lit(0).alias("first"), F.lit(-1).alias("n"))).alias("spans"))
    both = _spans(one, size, hot).union(whole).groupBy("doc_id", "key").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return both


def _spans(docs: DataFrame, size: int, hot: int) -> DataFrame:
    anchors = anchor_rows(docs, size)
    often = materialize(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "anchors")
    wanted = materialize(anchors.join(often, "anchor").select("anchor", "doc_id", "key", "first", "n", (F.col("c") > hot).alias("hot")), "places")
    segs = materialize(segments(docs, wanted, size), "segments")
    cold = parse_blocks(segs.where(~F.col("hot")).drop("hot"))
    many = segs.where("hot").withColumn("kind", F.xxhash64("windows"))
    kinds = materialize(many.groupBy("anchor", "kind").agg(F.count(F.lit(1)).alias("c"), F.first(F.struct("doc_id", "key", "first", "windows")).alias("one")), "kinds")
    # a part of a kind with two members knows that both repeat; only what is alone in its
    # part asks whether the kind has others, at most one row a part
    parts = max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    narrow = many.select("anchor", "kind", "doc_id", "key", "first", F.size("windows").alias("n")).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "key", "first"), F.lit(parts)))
    counted = materialize(narrow.withColumn("same", F.count(F.lit(1)).over(Window.partitionBy("anchor", "kind", "part"))), "equal")
    alone = counted.where("same = 1").join(kinds.where("c > 1").select("anchor", "kind"), ["anchor", "kind"])
    equal = counted.where("same > 1").select("doc_id", "key", "first", "n").union(alone.select("doc_id", "key", "first", "n"))
    windows = (kinds.select("c", "one.doc_id", "one.key", "one.first", F.posexplode("one.windows").alias("i", "win"))
               .select("c", "doc_id", "key", (F.col("first") + F.col("i")).alias("first"), "win"))
    twice = windows.groupBy("win").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("win")
    warm = equal.union(windows.where("c = 1").join(twice, "win").select("doc_id", "key", "first", F.lit(1).alias("n")))
    return (cold.union(warm).groupBy("doc_id", "key")
            .agg(F.collect_list(F.struct("first", "n")).alias("spans")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 50, keep_text: bool = True, hot: int = 2000) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, with
    ``keep_text``, kept (the remaining words joined by one space).

    A word goes when a window of ``size`` words over it also starts anywhere else, the
    same document included; windows are judged on the input. Null and wordless texts
    have no words (kept: empty). Repeated rows count each: they repeat each other. Rows
    without doc_id take part like others. An empty table gives no rows."""
    src = pick(docs, doc_id=id_col, text=text_col).withColumn("key", F.xxhash64("doc_id", "text"))
    spans = materialize(duplicate_spans(src, size, hot), "spans")
    a, b = src.alias("a"), spans.alias("b")
    both = a.join(b, (F.col("a.key") == F.col("b.key")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")), "left")

    def rows(batches):
        for batch in batches:
            for piece, buf, offs in pieces(batch, "text"):
                w = Words(buf, offs, lower=False)
                gone = covered(w, piece.column(2), size)
                n_removed = np.add.reduceat(np.concatenate([gone, [False]]).astype(np.int64), w.first[:-1]) * (w.n_words > 0)
                kept = kept_texts(w, offs, gone)
                cols = [piece.column(0), pa.array(w.n_words.astype(np.int64)), pa.array(n_removed),
                        pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
                if keep_text:
                    cols.append(pa.array(kept, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    fields = [("doc_id", "bigint"), ("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string")]
    fields += [("kept", "string")] * keep_text
    names = [x for x, _ in fields]
    return both.select("a.doc_id", "a.text", "b.spans").mapInArrow(rows, schema(*fields))


def covered(w: Words, spans: pa.ListArray, size: int) -> np.ndarray:
    """Which words of a piece lie in a span of windows."""
    flat_spans = spans.flatten()
    d = np.repeat(np.arange(len(spans)), np.nan_to_num(np.asarray(spans.value_lengths().fill_null(0))))
    first = np.asarray(flat_spans.field("first")).astype(np.int64) + w.first[d]
    n = np.asarray(flat_spans.field("n")).astype(np.int64)
    n = np.where(n < 0, w.n_words[d] - size + 1, n)         # all windows of the document
    first, n = first[n > 0], n[n > 0]
    delta = np.zeros(len(w.start) + 1, np.int64)
    np.add.at(delta, first, 1)
    np.add.at(delta, first + n + size - 1, -1)
    return np.cumsum(delta)[:-1] > 0


def kept_texts(w: Words, offs: np.ndarray, gone: np.ndarray) -> list[bytes]:
    """Each document's words that stay, joined by one space."""
    keep = np.flatnonzero(~gone)
    doc = w.doc[keep]
    last = np.concatenate([doc[1:] != doc[:-1], [True]]) if len(keep) else np.zeros(0, bool)
    delta = np.zeros(len(w.buf) + 1, np.int32)
    delta[w.start[keep]] += 1
    delta[w.end[keep]] -= 1
    mask = np.cumsum(delta)[:-1] > 0
    gap = w.end[keep][~last]                # the byte after a kept word is a separator
    mask[gap] = True
    buf = w.buf.copy()
    buf[gap] = 0x20
    out = buf[mask].tobytes()
    cut = np.concatenate([[0], np.cumsum(mask)])[offs]
    return [out[cut[i]: cut[i + 1]] for i in range(len(offs) - 1)]


