"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``n`` consecutive words of each benchmark item (an item of
fewer words is one window). For each pattern length a block shift table over hashed
pairs of words tells how far the search may jump; at shift 0 the suffix-hash bucket of
the pair names the patterns to compare, and the words' bytes confirm an occurrence.

The benchmark goes to the tasks in blocks of about ``block_patterns`` windows (hash of
the window), each block a broadcast of that bounded size, and the documents are scanned
once per block; nothing of the documents is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.llm.common import pick, schema
from tabsmith.llm.words import LETTERS_DIGITS, Words, flat, mix, pieces
from tabsmith.session import materialize

SEGMENT = 256           # end positions that one cursor walks
TABLE_BITS = 18
SPANS = "array<struct<start:int,size:int>>"


def item_windows(bench: DataFrame, n: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item, words) of a benchmark: the windows' words joined by one space."""
    def windows(batches):
        for b in batches:
            items = b.column(0).to_pylist()
            w = Words(*flat(b.column(1)), lower=True, word_bytes=LETTERS_DIGITS)
            out_i, out_w = [], []
            for d, item in enumerate(items):
                words = [w.text(i) for i in range(w.first[d], w.first[d + 1])]
                for j in range(max(1, len(words) - n + 1) if words else 0):
                    out_i.append(item)
                    out_w.append(b" ".join(words[j: j + n]))
            yield pa.RecordBatch.from_arrays([pa.array(out_i, pa.string()), pa.array(out_w, pa.binary())], names=["item", "words"])

    src = pick(bench, item=item_col, text=text_col).select(F.col("item").cast("string"), "text")
    return src.mapInArrow(windows, schema(("item", "string"), ("words", "binary"))).distinct()


class PatternBlock:
    """Shift tables and suffix buckets of one block of patterns, by pattern length."""

    def __init__(self, rows: list[tuple[bytes, list[str]]]):
        self.items = [items for _, items in rows]
        self.words = [w for w, _ in rows]
        by_len: dict[int, list[int]] = {}
        for i, w in enumerate(self.words):
            by_len.setdefault(w.count(b" ") + 1, []).append(i)
        self.tables = []
        for m, idx in sorted(by_len.items()):
            data = b"".join(self.words[i] + b" " for i in idx)
            w = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), lower=False, word_bytes=LETTERS_DIGITS)
            h = w.hashes().reshape(len(idx), m)
            size = min(m, 2)                                    # words in a block
            shift = np.full(1 << TABLE_BITS, m - size + 1, np.int32)
            for j in range(m - size + 1):                       # later blocks allow smaller shifts
                slot = block_hash(h[:, j], h[:, j + 1] if size == 2 else None) >> np.uint64(64 - TABLE_BITS)
                np.minimum.at(shift, slot.astype(np.int64), m - size - j)
            suffix = block_hash(h[:, m - size], h[:, m - 1] if size == 2 else None)
            order = np.argsort(suffix, kind="stable")
            self.tables.append((m, size, shift, suffix[order], h[order], np.array(idx)[order]))

    def occurrences(self, w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, number of words, pattern) of every occurrence in a piece."""
        starts, sizes, pats = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for m, size, shift, suffix, pat_h, pat_id in self.tables:
            at = self.stops(w, h, m, size, shift)
            if not len(at):
                continue
            bh = block_hash(h[at - size + 1], h[at] if size == 2 else None)
            lo, hi = np.searchsorted(suffix, bh, "left"), np.searchsorted(suffix, bh, "right")
            live = np.flatnonzero(lo < hi)
            while len(live):                                    # the next pattern of each bucket
                p, first = lo[live], at[live] - m + 1
                same = np.ones(len(live), bool)
                for j in range(m):
                    same &= pat_h[p, j] == h[first + j]
                for k in np.flatnonzero(same):
                    i, f = int(pat_id[p[k]]), int(first[k])
                    if b" ".join(w.text(f + j) for j in range(m)) == self.words[i]:
                        starts.append(np.array([f])), sizes.append(np.array([m])), pats.append(np.array([i]))
                lo[live] += 1
                live = live[lo[live] < hi[live]]
        return np.concatenate(starts), np.concatenate(sizes), np.concatenate(pats)

    @staticmethod
    def stops(w: Words, h: np.ndarray, m: int, size: int, shift: np.ndarray) -> np.ndarray:
        """End positions at which the shift is 0. Cursors, one per segment of a document's
        end positions, jump side by side."""
        lo, hi = w.first[:-1] + m - 1, w.first[1:]
        docs = np.flatnonzero(lo < hi)
        if not len(docs):
            return np.zeros(0, np.int64)
        lo, hi = lo[docs], hi[docs]
        n_seg = -(-(hi - lo) // SEGMENT)
        nth = np.arange(n_seg.sum()) - np.repeat(np.cumsum(n_seg) - n_seg, n_seg)
        at = np.repeat(lo, n_seg) + nth * SEGMENT
        end = np.minimum(at + SEGMENT, np.repeat(hi, n_seg))
        slot = (block_hash(h[:-1], h[1:]) if size == 2 else block_hash(h, None)) >> np.uint64(64 - TABLE_BITS)
        step = shift[slot.astype(np.int64)]
        found = []
        while len(at):
            by = step[at - size + 1]
            found.append(at[by == 0])
            at = at + np.maximum(by, 1)
            live = at < end
            at, end = at[live], end[live]
        return np.concatenate(found)


def block_hash(a: np.ndarray, b: np.ndarray | None) -> np.ndarray:
    return mix(a) if b is None else mix(mix(a) + b)


def pattern_blocks(bench: DataFrame, n: int, item_col: str, text_col: str, block_patterns: int):
    """The benchmark's windows with their items, in blocks of bounded size."""
    wins = materialize(item_windows(bench, n, item_col, text_col), "benchmark")
    total = wins.count()
    n_blocks = max(1, -(-total // block_patterns))
    blk = F.pmod(F.xxhash64("words"), F.lit(n_blocks))
    for k in range(n_blocks if total else 0):
        found: dict[bytes, list[str]] = {}
        for r in wins.where(blk == k).toLocalIterator():
            found.setdefault(bytes(r["words"]), []).append(r["item"])
        yield PatternBlock(sorted(found.items()))


def mark_hits(docs: DataFrame, bench: DataFrame, text_col: str = "text", n: int = 10, item_col: str = "item_id",
              bench_text: str = "text", block_patterns: int = 1 << 16) -> DataFrame:
    """``docs`` with n_words int, n_hit int, spans (start word, number of words of each
    merged hit) and items (distinct ids of items with an occurring window, as strings,
    unsorted; an item without id is null there). ``docs`` may not have columns of these four names.

    Null or wordless texts have 0 words and no hits; wordless items, and an empty
    benchmark, have no windows. Repeated rows and repeated items count each for itself."""
    sc = docs.sparkSession.sparkContext
    blocks = [sc.broadcast(b) for b in pattern_blocks(bench, n, item_col, bench_text, block_patterns)]
    at = len(docs.columns)
    kind = T.StructType([*docs.schema.fields, *schema(("n_words", "int"), ("n_hit", "int"), ("spans", SPANS), ("items", "array<string>"))])

    def scan_with(block, first: bool):
        def scan(batches):
            for batch in batches:
                for piece, buf, offs in pieces(batch, text_col):
                    w = Words(buf, offs, lower=True, word_bytes=LETTERS_DIGITS)
                    start, size, pat = block.value.occurrences(w, w.hashes())
                    delta = np.zeros(len(w.start) + 1, np.int32)
                    np.add.at(delta, start, 1)
                    np.add.at(delta, start + size, -1)
                    items: list[set] = [set() for _ in range(piece.num_rows)]
                    for s, p in zip(start, pat):
                        items[w.doc[s]].update(block.value.items[p])
                    if not first:               # what earlier blocks found
                        for d, (spans, had) in enumerate(zip(piece.column(at + 2).to_pylist(), piece.column(at + 3).to_pylist())):
                            items[d].update(had)
                            for s in spans:
                                delta[w.first[d] + s["start"]] += 1
                                delta[w.first[d] + s["start"] + s["size"]] -= 1
                    n_hit, spans = hit_columns(w, np.cumsum(delta)[:-1] > 0)
                    yield pa.RecordBatch.from_arrays(
                        [*piece.columns[:at], pa.array(w.n_words.astype(np.int32)), n_hit, spans,
                         pa.array([list(x) for x in items], pa.list_(pa.string()))], names=kind.names)
        return scan

    out = docs
    for k, block in enumerate(blocks or [sc.broadcast(PatternBlock([]))]):
        out = out.mapInArrow(scan_with(block, k == 0), kind)
    return out


def without_hits(docs: DataFrame, bench: DataFrame, text_col: str = "text", n: int = 10, item_col: str = "item_id",
                 bench_text: str = "text", block_patterns: int = 1 << 16) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs; all columns."""
    sc, out = docs.sparkSession.sparkContext, docs

    def clean_of(block):
        def rows(batches):
            for batch in batches:
                for piece, buf, offs in pieces(batch, text_col):
                    w = Words(buf, offs, lower=True, word_bytes=LETTERS_DIGITS)
                    keep = np.ones(piece.num_rows, bool)
                    keep[w.doc[block.value.occurrences(w, w.hashes())[0]]] = False
                    yield piece.filter(pa.array(keep))
        return rows

    for block in pattern_blocks(bench, n, item_col, bench_text, block_patterns):
        out = out.mapInArrow(clean_of(sc.broadcast(block)), docs.schema)
    return out


def hit_columns(w: Words, hit: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """(number of hit words, merged hit spans) per document of a piece."""
    total = np.concatenate([[0], np.cumsum(hit)])
    n_hit = (total[w.first[1:]] - total[w.first[:-1]]).astype(np.int32)
    edge = np.zeros(len(hit) + 1, bool)
    edge[w.first[:-1][w.first[:-1] < len(hit)]] = True       # a span ends with its document
    begin = np.flatnonzero(hit & (~np.concatenate([[False], hit[:-1]]) | edge[:-1])) if len(hit) else np.zeros(0, np.int64)
    stop = np.flatnonzero(hit & (~np.concatenate([hit[1:], [False]]) | edge[1:])) + 1 if len(hit) else begin
    n_spans = np.bincount(w.doc[begin], minlength=len(n_hit)) if len(begin) else np.zeros(len(n_hit), np.int64)
    kind = pa.struct([("start", pa.int32()), ("size", pa.int32())])
    rel = (begin - w.first[w.doc[begin]]).astype(np.int32) if len(begin) else np.zeros(0, np.int32)
    flat_spans = pa.StructArray.from_arrays([pa.array(rel), pa.array((stop - begin).astype(np.int32))], fields=list(kind))
    offs = pa.array(np.concatenate([[0], np.cumsum(n_spans)]).astype(np.int32))
    return pa.array(n_hit), pa.ListArray.from_arrays(offs, flat_spans)


def hit_report(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 10, **kw) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hits = mark_hits(pick(docs, doc_id=id_col, text=text_col), bench, "text", n, **kw)
    items = F.array_sort(F.filter("items", lambda x: x.isNotNull()))
    return hits.select(
        "doc_id", F.col("n_words").cast("bigint"), F.col("n_hit").cast("bigint"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
