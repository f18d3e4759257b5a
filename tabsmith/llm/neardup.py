"""N-gram Jaccard join: documents whose sets of word shingles are similar.

Two sets x, y with Jaccard at least t differ in at most D = (1-t)/(1+t) * (|x|+|y|)
shingles. Sizes fall into bands (ratio 1/t), so linked sets lie in one band or in two
adjacent ones. For a band, the hash space of shingles is cut into more than D parts; two
linked sets must agree in one whole part. A *tile* is (band, part, hash of the set's
shingles in the part); a document enters the tiles of its band and of the next one.
Tiles select only texts that share whole runs of the hash space, so a common shingle or
passage doesn't bring unlike documents together.

In a tile a pair is tested by hashed bitmaps: each set toggles one bit per shingle, and
|x xor y| of the sets is at least the number of differing bits, which bounds the overlap
from above. What passes is decided by intersecting the sorted shingle arrays.

Equal sets are one class and are joined once. A group of near copies is not compared all
against all: a tile first compares its members with two pivots (the smallest by a seeded
hash each, so tiles of one group mostly agree on them; a tile's rows name both), and only
members not yet known to be connected go on. The second round compares all of these
with each other, tested by bitmap in the tile, so no link between different components
is lost. Near copies meet in many tiles: members of large tiles carry their first few, and
a pair with one of these in common is given only by the first they share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import both_of, components, pick, schema, whole_groups
from tabsmith.llm.words import Words, in_one_doc, mix, ngrams, pieces
from tabsmith.session import materialize

SEEDS = (0x5851F42D4C957F2D, 0x14057B7EF767814F)     # pivot orders
LARGE_TILE = 32         # members of a tile that gives a pair only if it is the first they share
FIRST_TILES = 12        # so many large tiles a class carries
NO_TILE = np.iinfo(np.int64).max
PIVOTS = [f"pivot{i}" for i in range(len(SEEDS))]


class ShingleSets:
    """Distinct shingle hashes of the documents of a piece, sorted in each document."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, shingle: int):
        w = Words(buf, offs, lower=True)
        h = w.hashes()
        whole = in_one_doc(w.doc, shingle)
        docs, values = [w.doc[: len(whole)][whole]], [ngrams(h, shingle)[whole]]
        for m in range(1, shingle):                     # fewer words: the whole sequence
            d = np.flatnonzero(w.n_words == m)
            docs.append(d)
            values.append(mix(ngrams(h, m)[w.first[d]] + np.uint64(m)) if len(d) else np.zeros(0, np.uint64))
        doc, g = np.concatenate(docs), np.concatenate(values)
        order = np.lexsort((g, doc))
        doc, g = doc[order], g[order]
        new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (g[1:] != g[:-1])]) if len(g) else np.zeros(0, bool)
        self.doc, self.g = doc[new], g[new]
        self.n = np.bincount(self.doc, minlength=len(offs) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.n)])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Wrapping sum of ``values`` (one per shingle) of each document."""
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return total[self.first[1:]] - total[self.first[:-1]]

    def class_ids(self) -> np.ndarray:
        """One 64-bit id per distinct set (from two independent sums and the size)."""
        a, b = self.sums(mix(self.g + np.uint64(1))), self.sums(mix(self.g ^ np.uint64(0xD6E8FEB86659FD93)))
        return mix(a ^ mix(b + self.n.astype(np.uint64))).view(np.int64)

    def bitmaps(self) -> list[bytes]:
        """Parity bitmaps of a power of two bits, four to eight a shingle."""
        bits = bitmap_bits(self.n)
        base = np.concatenate([[0], np.cumsum(bits)])
        slot = base[self.doc] + (mix(self.g ^ np.uint64(0xA0761D6478BD642F)) & (bits[self.doc] - 1).astype(np.uint64)).astype(np.int64)
        packed = np.packbits(np.bincount(slot, minlength=base[-1]).astype(np.uint8) & 1).tobytes()
        return [packed[base[i] // 8: base[i + 1] // 8] for i in range(len(bits))]

    def tiles(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, tile) of every tile of every document."""
        out_d, out_t = [], []
        own = band_of(self.n, percent)
        for step in (0, 1):                             # the own band and the next one
            band = own + step
            parts, slack = parts_of(band, percent)
            use = parts[self.doc] > 0                   # no parts: only equal sets are linked
            doc, g = self.doc[use], self.g[use]
            part = ((mix(g ^ np.uint64(0xE7037ED1A0B428DB)) >> np.uint64(32)) * parts[doc].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            base = np.concatenate([[0], np.cumsum(parts)])
            slot = base[doc] + part
            size = np.bincount(slot, minlength=base[-1])
            order = np.argsort(slot, kind="stable")
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(g[order]), dtype=np.uint64)])
            end = np.cumsum(size)
            sums = total[end] - total[end - size]
            owner = np.repeat(np.arange(len(parts)), parts)
            nth = np.arange(base[-1]) - base[owner]
            empty = np.bincount(owner[size == 0], minlength=len(parts))
            # an empty part says nothing; only documents with many of them need it
            keep = (size > 0) | (empty > slack)[owner]
            key = mix(sums + mix((band[owner] << 32 | nth).astype(np.uint64)))
            out_d.append(owner[keep])
            out_t.append(key[keep])
        return np.concatenate(out_d), np.concatenate(out_t).view(np.int64)


def bitmap_bits(n: np.ndarray) -> np.ndarray:
    """Four to eight bits a shingle: few differences cancel, so the bound stays tight."""
    return np.maximum(64, 4 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))


def band_edges(percent: int, largest: int) -> np.ndarray:
    """First size of each band: sizes of linked sets lie at most one band apart."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(edges[-1] * 100 // percent + 1)
    return np.array(edges)


def band_of(n: np.ndarray, percent: int) -> np.ndarray:
    return np.searchsorted(band_edges(percent, int(n.max(initial=1))), n, side="right") - 1


def parts_of(band: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of parts, how many of them may be empty) of each band: more parts than two
    linked sets below the band's end can differ in, and a few more."""
    top = int(band.max(initial=0))
    edges = [1]
    while len(edges) <= top + 1:
        edges.append(edges[-1] * 100 // percent + 1)
    last = np.array(edges)[np.maximum(band, 0) + 1] - 1
    differ = (100 - percent) * 2 * last // (100 + percent)
    slack = differ * (100 - percent) // 400
    return np.where(band < 0, 0, np.where(differ > 0, differ + 1 + slack, 0)), slack


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n, cid, bitmap) of each document; cid names the set."""
    def rows(batches):
        for b in batches:
            for piece, buf, offs in pieces(b, "text"):
                s = ShingleSets(buf, offs, shingle)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(s.n.astype(np.int64)), pa.array(s.class_ids()), pa.array(s.bitmaps(), pa.binary())],
                                                 names=["doc_id", "n", "cid", "bitmap"])

    return docs.select("doc_id", "text").mapInArrow(rows, schema(("doc_id", "bigint"), ("n", "bigint"), ("cid", "bigint"), ("bitmap", "binary")))


def shared_tiles(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(tile, cid, pivots) of the tiles with at least two classes; pivots are the tile's
    smallest classes in the orders of SEEDS. A task gives each class once."""
    def enter(batches):
        seen: set[int] = set()
        for b in batches:
            for _, buf, offs in pieces(b, "text"):
                s = ShingleSets(buf, offs, shingle)
                cid = s.class_ids()
                first = np.array([c not in seen and not seen.add(c) for c in cid.tolist()], bool)
                d, tile = s.tiles(percent)
                keep = first[d]
                yield pa.RecordBatch.from_arrays([pa.array(tile[keep]), pa.array(cid[d[keep]])], names=["tile", "cid"])

    def shared(batches):
        for t in whole_groups(batches, "tile"):
            tile, cid = t.column("tile").to_numpy(), t.column("cid").to_numpy()
            new = np.concatenate([[True], (tile[1:] != tile[:-1]) | (cid[1:] != cid[:-1])])
            tile, cid = tile[new], cid[new]
            alone = np.concatenate([[True], tile[1:] != tile[:-1]]) & np.concatenate([tile[1:] != tile[:-1], [True]])
            tile, cid = tile[~alone], cid[~alone]
            begin = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])) if len(tile) else np.zeros(0, np.int64)
            members = np.diff(np.concatenate([begin, [len(tile)]]))
            pivots = [cid[np.repeat(np.lexsort((mix(cid.view(np.uint64) ^ np.uint64(seed)), tile))[begin], members)] for seed in SEEDS]
            yield pa.RecordBatch.from_arrays([pa.array(tile), pa.array(cid), *map(pa.array, pivots)], names=["tile", "cid", *PIVOTS])

    entered = docs.select("text").mapInArrow(enter, schema(("tile", "bigint"), ("cid", "bigint")))
    return (entered.repartition("tile").sortWithinPartitions("tile", "cid")
            .mapInArrow(shared, schema(("tile", "bigint"), ("cid", "bigint"), *[(p, "bigint") for p in PIVOTS])))


def pivot_pairs(tiles: DataFrame) -> DataFrame:
    """(a, b): each member of a tile with each of the tile's pivots."""
    return (tiles.select("cid", F.explode(F.array(*PIVOTS)).alias("pivot")).where("cid <> pivot")
            .select(F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b")).distinct())


def folded(bitmap: bytes, size: int) -> np.ndarray:
    """A bitmap reduced to ``size`` bytes; bits that fall together cancel."""
    x = np.frombuffer(bitmap, np.uint8)
    return x if len(x) == size else np.bitwise_xor.reduce(fold_order(x, size))


def fold_order(x: np.ndarray, size: int) -> np.ndarray:
    return x.reshape(-1, size)


def may_link(n1, n2, differing, percent: int):
    """Whether sets of these sizes whose bitmaps differ in so many bits can be linked."""
    overlap = (n1 + n2 - differing) // 2
    return 100 * overlap >= percent * (n1 + n2 - overlap)


def tile_pairs(tiles: DataFrame, percent: int) -> DataFrame:
    """(a, b, comp_a, comp_b): all members of a tile in different components that sizes and
    bitmaps allow, with their components. ``first`` are tiles that a member is in, too; a pair is left to the smallest in both.
    A pair that shares none of them comes once from each of its tiles."""
    def rows(batches):
        for t in whole_groups(batches, "tile"):
            tile, cid, comp, n = (t.column(c).to_numpy() for c in ("tile", "cid", "comp", "n"))
            maps = t.column("bitmap").to_pylist()
            first = np.full((len(tile), FIRST_TILES), NO_TILE)
            for i, known in enumerate(t.column("first").to_pylist()):
                if known:
                    first[i, :len(known)] = known
            out = []
            edge = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1], [True]]))
            for lo, hi in zip(edge[:-1], edge[1:]):
                if (comp[lo:hi] == comp[lo]).all():
                    continue
                size = min(len(maps[i]) for i in range(lo, hi))
                m = np.stack([folded(maps[i], size) for i in range(lo, hi)])
                for i in range(hi - lo - 1):
                    j = np.flatnonzero(comp[lo + i + 1: hi] != comp[lo + i]) + i + 1
                    j = j[may_link(n[lo + i], n[lo + j], 0, percent) & (100 * np.minimum(n[lo + i], n[lo + j]) >= percent * np.maximum(n[lo + i], n[lo + j]))]
                    differing = np.bitwise_count(m[j] ^ m[i]).sum(1, dtype=np.int64)
                    j = j[may_link(n[lo + i], n[lo + j], differing, percent)]
                    other = first[lo + j]
                    meet = np.where((other[:, :, None] == first[lo + i]).any(2), other, NO_TILE).min(1)
                    j = j[(meet == NO_TILE) | (meet == tile[lo])]
                    less = cid[lo + i] < cid[lo + j]
                    both = [[np.where(less, x[lo + i], x[lo + j]), np.where(less, x[lo + j], x[lo + i])] for x in (cid, comp)]
                    out.append(np.stack([*both[0], *both[1]]))
            if out:
                pair = np.unique(np.concatenate(out, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, pair)), names=names)

    names = ["a", "b", "comp_a", "comp_b"]
    return tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(rows, schema(*[(c, "bigint") for c in names]))


def first_tiles(tiles: DataFrame) -> DataFrame:
    """The rows (tile, cid, comp) of the tiles with several components, with the first few
    large ones of these tiles of each class."""
    def several(batches):
        for t in whole_groups(batches, "tile"):
            tile, comp = t.column("tile").to_numpy(), t.column("comp").to_numpy()
            begin = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
            members = np.diff(np.concatenate([begin, [len(tile)]]))
            mixed = np.repeat(np.minimum.reduceat(comp, begin) != np.maximum.reduceat(comp, begin), members)
            t = t.append_column("large", pa.array(np.repeat(members >= LARGE_TILE, members)))
            yield from t.filter(pa.array(mixed)).to_batches()

    mixed = (tiles.select("tile", "cid", "comp").repartition("tile").sortWithinPartitions("tile")
             .mapInArrow(several, schema(("tile", "bigint"), ("cid", "bigint"), ("comp", "bigint"), ("large", "boolean"))))
    one = Window.partitionBy("cid")
    nth = F.row_number().over(one.orderBy(F.desc("large"), "tile"))
    return (mixed.withColumn("few", F.when(F.col("large") & (nth <= FIRST_TILES), F.col("tile")))
            .withColumn("first", F.collect_set("few").over(one)).drop("few", "large"))


def half_bitmaps(classes: DataFrame) -> DataFrame:
    """The classes with bitmaps of half the size."""
    def rows(batches):
        for b in batches:
            maps = [folded(m, max(8, len(m) // 2)).tobytes() for m in b.column("bitmap").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("cid"), b.column("n"), pa.array(maps, pa.binary())], names=["cid", "n", "bitmap"])

    return classes.select("cid", "n", "bitmap").mapInArrow(rows, schema(("cid", "bigint"), ("n", "bigint"), ("bitmap", "binary")))


def bitmap_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and bitmaps allow, with the documents of the classes (rep_a, rep_b)."""
    side = lambda c: classes.select(F.col("cid").alias(c), F.col("rep").alias(f"rep_{c}"), F.col("n").alias(f"n_{c}"), F.col("bitmap").alias(f"m_{c}"))
    near = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")

    def rows(batches):
        for b in batches:
            n1, n2 = b.column("n_a").to_numpy(), b.column("n_b").to_numpy()
            differing = np.zeros(len(n1), np.int64)
            for i, (x, y) in enumerate(zip(b.column("m_a").to_pylist(), b.column("m_b").to_pylist())):
                size = min(len(x), len(y))
                differing[i] = np.bitwise_count(folded(x, size) ^ folded(y, size)).sum(dtype=np.int64)
            yield b.select(kept.names).filter(pa.array(may_link(n1, n2, differing, percent)))

    met = pairs.join(side("a"), "a").join(side("b"), "b").where(near)
    kept = met.select(*pairs.columns, "rep_a", "rep_b").schema
    return met.select(*kept.names, "n_a", "n_b", "m_a", "m_b").mapInArrow(rows, kept)


def sorted_shingles(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(cid, shingles) of the wanted classes (cid, doc_id): sorted shingle hashes."""
    def rows(batches):
        for b in batches:
            for piece, buf, offs in pieces(b, "text"):
                s = ShingleSets(buf, offs, shingle)
                keep = np.flatnonzero(s.class_ids() == piece.column(1).to_numpy())      # a doc_id may name other rows too
                arrays = pa.LargeListArray.from_arrays(pa.array(s.first), pa.array(s.g.view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([piece.column(1).take(pa.array(keep)), arrays.take(pa.array(keep))], names=["cid", "shingles"])

    # texts are shuffled at every size; as a broadcast the wanted ones would grow with the input
    have = docs.join(wanted.hint("merge"), "doc_id").select("text", "cid")
    return have.mapInArrow(rows, schema(("cid", "bigint"), ("shingles", "array<bigint>"))).dropDuplicates(["cid"])


def linked_pairs(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (with rep_a, rep_b) whose shingle sets are similar enough, by exact intersection."""
    wanted = both_of(pairs, ("rep_a", "a"), ("rep_b", "b")).toDF("doc_id", "cid").distinct()
    sets = sorted_shingles(docs, wanted, shingle)       # both joins below use one shuffle of it

    def rows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                x, y = b.column("x"), b.column("y")
                xo, yo, xv, yv = np.asarray(x.offsets), np.asarray(y.offsets), np.asarray(x.values).view(np.uint64), np.asarray(y.values).view(np.uint64)
                ok = np.zeros(b.num_rows, bool)
                for i in range(b.num_rows):
                    p, q = xv[xo[i]: xo[i + 1]], yv[yo[i]: yo[i + 1]]
                    at_q = np.searchsorted(q, p)
                    both = int((q[np.minimum(at_q, len(q) - 1)] == p).sum()) if len(q) else 0
                    ok[i] = 100 * both >= percent * (len(p) + len(q) - both)
                yield b.select(kept.names).filter(pa.array(ok))

    side = lambda c, v: sets.select(F.col("cid").alias(c), F.col("shingles").alias(v))
    kept = pairs.drop("rep_a", "rep_b").schema
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select(*kept.names, "x", "y").mapInArrow(rows, kept)


def similar_documents(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, class_id (smallest doc_id with an equal
    set), component_id (smallest doc_id reachable by links, itself included).

    Linked: 100 * intersection >= percent * union of the distinct ``shingle``-word
    shingles of the lower-cased (A-Z) text; a text of fewer words is one shingle. Texts
    without words (null, empty) are linked with nothing. Rows of one doc_id are one
    document. Rows without doc_id take no part: class_id and component_id are null."""
    src = pick(docs, doc_id=id_col, text=text_col)
    sets = materialize(shingle_sets(src, shingle), "sets")
    usable = sets.where("n > 0 AND doc_id IS NOT NULL")
    classes = materialize(usable.groupBy("cid").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap")), "classes")
    named = src.where(F.col("doc_id").isNotNull())
    tiles = materialize(shared_tiles(named, shingle, percent), "tiles")

    # rows of one doc_id with different texts belong together
    one_id = usable.groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("z")).where("a <> z")
    links = materialize(usable.join(one_id.select("doc_id", "a"), "doc_id").select("a", F.col("cid").alias("b")).where("a <> b").distinct(), "links")

    def tested(pairs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """The pairs that the bitmaps allow, and those of them that are linked."""
        found = materialize(bitmap_filter(pairs, classes, percent), "pairs")
        return found, None if found.isEmpty() else materialize(linked_pairs(found, named, shingle, percent), "links")

    group = classes.select("cid", "rep", F.col("cid").alias("comp"))
    now = tiles.select("tile", "cid", F.col("cid").alias("comp"))
    found, near = tested(pivot_pairs(tiles))
    links = links if near is None else links.union(near)
    if not links.isEmpty():
        comp = components(links).select(F.col("id").alias("cid"), F.col("comp").alias("known"))
        group, now = (x.join(comp, "cid", "left").withColumn("comp", F.coalesce("known", "cid")).drop("known") for x in (group, now))
    # tiles carry half of each bitmap; the pairs they leave meet the whole ones once
    rest = tile_pairs(first_tiles(now).join(half_bitmaps(classes), "cid"), percent).dropDuplicates(["a", "b"])
    _, near = tested(rest.join(found.select("a", "b"), ["a", "b"], "left_anti"))
    if near is not None and not near.isEmpty():         # these links join whole components
        comp = components(near.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))).select(F.col("id").alias("comp"), F.col("comp").alias("known"))
        group = group.join(comp, "comp", "left").withColumn("comp", F.coalesce("known", "comp")).drop("known")

    # back to documents: the smallest doc_id of each component
    low = group.groupBy("comp").agg(F.min("rep").alias("component"))
    final = group.join(low, "comp").select("cid", F.col("rep").alias("class_id"), "component")
    has = sets.withColumn("key", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("cid")))
    out = has.where("key IS NOT NULL").join(final.withColumnRenamed("cid", "key"), "key")
    none = has.where("key IS NULL")
    return (out.select("doc_id", F.col("n").alias("n_shingles"), "class_id", F.col("component").alias("component_id"))
            .union(none.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))))


def one_of_each_group(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their component (the smallest doc_id); all
    columns. Of several rows with that doc_id the smallest (column by column) stays. Rows
    without doc_id stay as they are."""
    groups = similar_documents(docs, shingle, percent, id_col, text_col)
    stay = groups.where("doc_id = component_id").select(F.col("doc_id").alias("_stays")).distinct()
    named = docs.join(stay, docs[id_col] == stay["_stays"], "left_semi")
    one = named.groupBy(id_col).agg(F.min(F.struct(*[named[c] for c in docs.columns])).alias("_row"))
    return one.select("_row.*").union(docs.where(docs[id_col].isNull()))
