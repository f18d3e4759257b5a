"""Language-model scores by Brown classes: class-based bigrams over exchange clusters.

Every training word that occurs ``MIN_COUNT`` times has a class of its own; rarer and unseen
words belong to the *unit* of their last three bytes' hash (``ENDINGS`` units), which has a
class. Classes are made in two steps, both over the whole training corpus:

1. Exchange clustering of the ``FREQUENT`` most frequent words (whatever their count) and of
   the endings of all other words: each round counts how often a unit stands before and after
   each class, and moves every unit to the class under which its neighbours are likeliest.
2. Every other word goes to the class under which its own neighbours are likeliest: their
   classes are gathered per word by a shuffle. This table (word, class, c) grows with the
   vocabulary and stays in Spark.

    P(word | previous) = P(class | previous class) * P(unit | class) * P(word | unit)

Transitions are counted anew over the final classes and smoothed towards the class
frequencies, units by a small constant, words of an ending unit by absolute discounting; the
discounted mass goes to the unit's unseen words, which count as one type. A word with a class
is a unit by itself. The end of a text is a token with a class of its own, and it is the
context of the first word.

Counts of all words are a Spark aggregate. The most frequent words, ``LOOKUP`` at most, go to
the tasks as a table of that bounded size, with their classes; the tokens of all other words
are joined with the counts and classes by word hash. So LOOKUP decides what is joined, not
what has a class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import pick, schema, whole_groups
from tabsmith.llm.words import Words, pieces
from tabsmith.session import materialize

FREQUENT, ENDINGS, CLASSES = 8192, 1024, 64
MIN_COUNT = 3               # words that occur so often have a class of their own
LOOKUP = 1 << 18
UNITS = FREQUENT + ENDINGS
END_UNIT, END_CLASS = UNITS, CLASSES
END_NUMBER = LOOKUP + ENDINGS       # numbers in texts: rank of a looked-up word, LOOKUP + ending of others, the end
ROUNDS = 8
DISCOUNT, UNIT_SMOOTHING, CLASS_SMOOTHING = 0.5, 0.1, 5.0
SLICES = 16                 # parts of a count matrix on its way to the sum


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def ending(w: Words) -> np.ndarray:
    return (w.ends(3) >> np.uint64(54)).astype(np.int64) % ENDINGS


def word_counts(training: DataFrame) -> DataFrame:
    """(word, ending, c): every distinct word of the training texts."""
    def rows(batches):
        for batch in batches:
            for _, buf, offs in pieces(batch, "text"):
                w = Words(buf, offs, lower=True)
                word, at, c = np.unique(w.hashes(), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(ending(w)[at].astype(np.int32)), pa.array(c)], names=["word", "ending", "c"])

    local = training.select("text").mapInArrow(rows, schema(("word", "bigint"), ("ending", "int"), ("c", "bigint")))
    return local.groupBy("word").agg(F.first("ending").alias("ending"), F.sum("c").alias("c"))


class Lookup:
    """The most frequent words by hash, with count, rank and ending; those that have a class
    of their own; ``emit``, log10 of each word's share of its class without the divisor."""

    def __init__(self, word: np.ndarray, c: np.ndarray, ending: np.ndarray):
        rank = np.arange(len(word))
        order = np.argsort(word.view(np.uint64))
        self.by_rank, self.count, self.ending = word, c, ending
        self.own = (rank < FREQUENT) | (c >= MIN_COUNT)
        self.emit = np.zeros(len(word))
        self.word, self.c, self.rank = word.view(np.uint64)[order], c[order], rank[order]

    def units(self) -> np.ndarray:
        """Unit of the first clustering step by number in texts."""
        ranked = np.zeros(LOOKUP, np.int64)
        ranked[: len(self.ending)] = np.where(np.arange(len(self.ending)) < FREQUENT, np.arange(len(self.ending)), FREQUENT + self.ending)
        return np.concatenate([ranked, FREQUENT + np.arange(ENDINGS), [END_UNIT]])

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count or 0, rank or -1) of each word hash."""
        if not len(self.word):
            return np.zeros(len(h), np.int64), np.full(len(h), -1)
        distinct, back = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.word, distinct), len(self.word) - 1)
        ok = self.word[at] == distinct
        return np.where(ok, self.c[at], 0)[back], np.where(ok, self.rank[at], -1)[back]


def most_frequent(counts: DataFrame, most: int) -> Lookup:
    """The words above the lowest count that at most ``most`` words exceed. The counts'
    histogram has at most sqrt(2 * tokens) rows."""
    above, cut = 0, 0
    for c, n in sorted(((r["c"], r["n"]) for r in counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True):
        if above + n > most:
            cut = c
            break
        above += n
    top = counts.where(F.col("c") > cut).select("word", "c", "ending").toArrow()
    word, c, end = (top.column(k).to_numpy() for k in ("word", "c", "ending"))
    order = np.lexsort((word, -c))
    return Lookup(word[order], c[order], end[order])


def encode(docs: DataFrame, lookup) -> DataFrame:
    """(row, doc_id, held_out, units, n_words, seen, base, emit, rest): the numbers of each
    whole text (32 bits), sums over its looked-up words, and the other words with their places."""
    rest = "array<struct<word:bigint,ending:int,pos:int>>"

    def rows(batches):
        table, part, nth = lookup.value, TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece, buf, offs in pieces(batch, "text"):
                w = Words(buf, offs, lower=True)
                h, end = w.hashes(), ending(w)
                c, rank = table.find(h)
                known = rank >= 0
                own = known & (table.own[rank] if len(table.own) else False)
                unit = np.where(own, rank, LOOKUP + end).astype("<u4")
                base = np.where(known, np.log10(c + 1.0), 0.0)
                emit = np.where(known, table.emit[rank], 0.0) if len(table.emit) else np.zeros(len(h))
                total = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[w.first])
                raw = unit.tobytes()
                far = np.flatnonzero(~known)
                cuts = np.concatenate([[0], np.cumsum(np.bincount(w.doc[far], minlength=piece.num_rows))]).astype(np.int32)
                others = pa.StructArray.from_arrays([pa.array(h[far].view(np.int64)), pa.array(end[far].astype(np.int32)), pa.array((far - w.first[w.doc[far]]).astype(np.int32))], ["word", "ending", "pos"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array((part << 40) + nth + np.arange(piece.num_rows)), piece.column(0), piece.column(1),
                     pa.array([raw[4 * w.first[i]: 4 * w.first[i + 1]] for i in range(piece.num_rows)], pa.binary()),
                     pa.array(w.n_words.astype(np.int64)), pa.array(total(known).astype(np.int64)), pa.array(total(base).astype(float)), pa.array(total(emit).astype(float)),
                     pa.ListArray.from_arrays(pa.array(cuts), others)], names=kind.names)
                nth += piece.num_rows

    kind = schema(("row", "bigint"), ("doc_id", "bigint"), ("held_out", "boolean"), ("units", "binary"), ("n_words", "bigint"),
                  ("seen", "bigint"), ("base", "double"), ("emit", "double"), ("rest", rest))
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(rows, kind)


def unit_stream(col: pa.Array) -> np.ndarray:
    """Numbers of a batch of texts, END before the first text and after each."""
    end = np.array([END_NUMBER], "<u4").tobytes()
    return np.frombuffer(end + b"".join(x + end for x in col.to_pylist()), "<u4").astype(np.int64)


def places(n_words: pa.Array, lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Where the listed words (struct with pos) of a batch of texts stand in its stream."""
    flat = lists.flatten()
    n = n_words.to_numpy()
    begin = 1 + np.cumsum(n + 1) - (n + 1)
    return np.repeat(begin, pc.fill_null(lists.value_lengths(), 0).to_numpy()) + pc.struct_field(flat, "pos").to_numpy(), flat


def neighbour_counts(encoded: DataFrame, classes: np.ndarray, unit_of) -> tuple[np.ndarray, np.ndarray]:
    """(before, after): how often each class stands before / after each unit, over all
    given texts. Task matrices are summed by Spark in slices; the sum has fixed size."""
    spark = encoded.sparkSession
    cls = spark.sparkContext.broadcast(classes)
    width, cells = CLASSES + 1, (UNITS + 1) * (CLASSES + 1)

    def count(batches):
        both, c, units = np.zeros(2 * cells, np.int64), cls.value, unit_of.value
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                u = units[unit_stream(b.column(0).slice(at, 1000))]
                if len(u) > 1:
                    both[:cells] += np.bincount(u[1:] * width + c[u[:-1]], minlength=cells)
                    both[cells:] += np.bincount(u[:-1] * width + c[u[1:]], minlength=cells)
        if both.any():
            parts = np.array_split(both, SLICES)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(SLICES, dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "counts"])

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in t.column("counts"))
        return pa.table({"part": pa.array([t.column("part")[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    kind = schema(("part", "int"), ("counts", "binary"))
    sums = encoded.where("NOT held_out").select("units").mapInArrow(count, kind).groupBy("part").applyInArrow(add, kind).collect()
    if not sums:
        return np.zeros((UNITS + 1, width)), np.zeros((UNITS + 1, width))
    both = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in sorted(sums, key=lambda r: r["part"])])
    return both[:cells].reshape(-1, width).astype(float), both[cells:].reshape(-1, width).astype(float)


def transition_log10(pair: np.ndarray) -> np.ndarray:
    """log10 P(next class | class), smoothed towards the classes' own frequencies."""
    freq = (pair.sum(0) + 1) / (pair.sum() + CLASSES + 1)
    weight = CLASS_SMOOTHING * CLASSES
    return np.log10((pair + weight * freq) / (pair.sum(1, keepdims=True) + weight))


def class_totals(before: np.ndarray, after: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(transitions, tokens of each class) from the units' counts."""
    pair, size = np.zeros((CLASSES + 1, CLASSES + 1)), np.zeros(CLASSES + 1)
    np.add.at(pair, classes, after)
    np.add.at(size, classes, before.sum(1))
    return transition_log10(pair), size


def likeliest(before: np.ndarray, after: np.ndarray, trans: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The class that makes a unit's own occurrences and its followers likeliest (ties: the
    smaller class)."""
    gain = after @ trans.T + before @ trans - before.sum(1)[:, None] * np.log10(size + 1)
    gain[:, END_CLASS] = -np.inf
    return gain.argmax(1)


def exchange(before: np.ndarray, after: np.ndarray, classes: np.ndarray, movable: np.ndarray) -> np.ndarray:
    """One round: each movable unit goes to its likeliest class (a unit without counts stays)."""
    return np.where(movable & (before.sum(1) > 0), likeliest(before, after, *class_totals(before, after, classes)), classes)


def cluster(encoded: DataFrame, unit_of) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(classes, before, after) after ROUNDS exchange rounds; half of the units move in a
    round, so that neighbours don't swap places for ever."""
    units = np.arange(UNITS + 1)
    classes = np.where(units == END_UNIT, END_CLASS, units % CLASSES)
    for k in range(ROUNDS):
        before, after = neighbour_counts(encoded, classes, unit_of)
        moving = (units != END_UNIT) & ((units * 2654435761 >> 7) % 2 == k % 2)
        classes = exchange(before, after, classes, moving)
    before, after = neighbour_counts(encoded, classes, unit_of)
    return classes, before, after


def word_classes(encoded: DataFrame, lookup, class_of, trans: np.ndarray, size: np.ndarray) -> DataFrame:
    """(word, class, c, rank): every training word of MIN_COUNT occurrences that is not among
    the FREQUENT ones, by the classes of its neighbours; rank -1 if it isn't looked up."""
    width = CLASSES + 1

    def occurrences(batches):
        by_rank, cls = lookup.value.by_rank, class_of.value
        for b in batches:
            for at in range(0, b.num_rows, 4000):
                part = b.slice(at, 4000)
                u = unit_stream(part.column(0))
                k = cls[u]
                near = np.flatnonzero((u >= FREQUENT) & (u < LOOKUP))
                far, flat = places(part.column(1), part.column(2))
                place = np.concatenate([near, far])
                if not len(place):
                    continue
                word = np.concatenate([by_rank[u[near]], pc.struct_field(flat, "word").to_numpy()])
                pair = (k[place - 1] * width + k[place + 1]).astype("<u2")
                order = np.argsort(word, kind="stable")
                word = word[order]
                first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
                cuts = (2 * np.concatenate([first, [len(word)]])).astype(np.int32)
                pairs = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(cuts), pa.py_buffer(pair[order].tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(word[first]), pairs], names=["word", "pairs"])

    def assign(batches):
        for t in whole_groups(batches, "word"):
            word, back = np.unique(t.column("word").to_numpy(), return_inverse=True)
            pairs = t.column("pairs")
            p = np.frombuffer(b"".join(pairs.to_pylist()), "<u2").astype(np.int64)
            at = np.repeat(back, pc.binary_length(pairs).to_numpy() // 2) * width
            before = np.bincount(at + p // width, minlength=len(word) * width).reshape(-1, width).astype(float)
            after = np.bincount(at + p % width, minlength=len(word) * width).reshape(-1, width).astype(float)
            n = before.sum(1).astype(np.int64)
            cls, (_, rank) = likeliest(before, after, trans, size), lookup.value.find(word.view(np.uint64))
            often = pa.array(n >= MIN_COUNT)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(cls.astype(np.int32)), pa.array(n), pa.array(rank.astype(np.int64))], names=kind.names).filter(often)

    kind = schema(("word", "bigint"), ("class", "int"), ("c", "bigint"), ("rank", "bigint"))
    found = encoded.where("NOT held_out").select("units", "n_words", "rest").mapInArrow(occurrences, schema(("word", "bigint"), ("pairs", "binary")))
    return found.repartition("word").sortWithinPartitions("word").mapInArrow(assign, kind)


def in_classes(encoded: DataFrame, per_row: DataFrame, class_of) -> DataFrame:
    """(doc_id, held_out, classes, n_words, seen, base, emit): the class of each word of each
    text (one byte each), and the sums over all its words."""
    def rows(batches):
        cls = class_of.value
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                k = cls[unit_stream(part.column(2))]
                place, flat = places(part.column(3), part.column(7))
                k[place] = pc.struct_field(flat, "class").to_numpy()
                n = part.column(3).to_numpy()
                raw, begin = k.astype(np.uint8).tobytes(), 1 + np.cumsum(n + 1) - (n + 1)
                text = pa.array([raw[i: i + m] for i, m in zip(begin, n)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), text, *[part.column(i) for i in (3, 4, 5, 6)]], names=kind.names)

    kind = schema(("doc_id", "bigint"), ("held_out", "boolean"), ("classes", "binary"), ("n_words", "bigint"), ("seen", "bigint"), ("base", "double"), ("emit", "double"))
    add = lambda a, b, zero: (F.col(a) + F.coalesce(F.col(b), F.lit(zero))).alias(a)
    src = encoded.drop("rest").join(per_row, "row", "left").select(
        "doc_id", "held_out", "units", "n_words", add("seen", "t_seen", 0), add("base", "t_base", 0.0), add("emit", "t_emit", 0.0), "t_classes")
    return src.mapInArrow(rows, kind)


def class_stream(col: pa.Array) -> np.ndarray:
    end = bytes([END_CLASS])
    return np.frombuffer(end + b"".join(x + end for x in col.to_pylist()), np.uint8).astype(np.int64)


def transitions(tagged: DataFrame) -> np.ndarray:
    """How often each class follows each class in the training texts."""
    width = CLASSES + 1

    def count(batches):
        pair = np.zeros(width * width, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                k = class_stream(b.column(0).slice(at, 1000))
                pair += np.bincount(k[:-1] * width + k[1:], minlength=width * width)
        cell = np.flatnonzero(pair)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(pair[cell])], names=["cell", "n"])

    out = np.zeros(width * width)
    for r in tagged.where("NOT held_out").select("classes").mapInArrow(count, schema(("cell", "int"), ("n", "bigint"))).groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out.reshape(width, width)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = LOOKUP) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (both log10 of the text's probability), perplexity (of the score).

    The model learns from rows whose crc32 of the doc_id's text modulo 7 is not 2 (rows
    without doc_id: learned from). A null, empty or wordless text is one token, its end.
    Repeated rows are scored and counted each. Without training rows every token is
    unknown and the scores come from the smoothing alone. At most ``most`` words are
    looked up in the tasks, the others joined."""
    src = pick(docs, doc_id=id_col, text=text_col)
    sc = src.sparkSession.sparkContext
    counts = materialize(word_counts(src.where(~held_out())), "words")
    n_docs = src.where(~held_out()).count()
    table = most_frequent(counts, min(most, LOOKUP))
    # tokens and types of the ending units: the words without a class of their own
    frequent = sc.broadcast(np.sort(table.word[table.rank < FREQUENT]))
    rare = rare_words(counts.where(F.col("c") < MIN_COUNT), frequent)
    ends = {r["ending"]: (r["c"], r["n"]) for r in rare.groupBy("ending").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect()}
    end_c, end_n = np.array([ends.get(i, (0, 0)) for i in range(ENDINGS)], float).T
    end_log = np.log10((end_c + UNIT_SMOOTHING) / (end_c + 1))
    unseen_log = end_log + np.log10(DISCOUNT * end_n + 1)
    table.emit = np.where(table.own, np.log10(table.count + UNIT_SMOOTHING), end_log[table.ending] + np.log10(table.count - DISCOUNT))
    lookup, unit_of = sc.broadcast(table), sc.broadcast(table.units())
    encoded = materialize(encode(src, lookup), "encoded")

    classes, before, after = cluster(encoded, unit_of)
    number_class = classes[unit_of.value]
    tail = materialize(word_classes(encoded, lookup, sc.broadcast(number_class), *class_totals(before, after, classes)), "tail")
    near = tail.where("rank >= 0").select("rank", "class").toArrow()
    number_class = number_class.copy()
    number_class[near.column("rank").to_numpy()] = near.column("class").to_numpy()
    size, members = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    own = np.flatnonzero(table.own)
    for cls, c in ((number_class[own], table.count[own]), (classes[FREQUENT: UNITS], end_c), ([END_CLASS], [n_docs])):
        np.add.at(size, cls, c)
        np.add.at(members, cls, 1)
    for r in tail.where("rank < 0").groupBy("class").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        size[r["class"]] += r["c"]
        members[r["class"]] += r["n"]

    far = encoded.select("row", F.explode("rest").alias("r")).select("row", "r.word", "r.ending", "r.pos")
    far = far.join(counts.select("word", "c"), "word", "left").join(tail.where("rank < 0").select("word", "class"), "word", "left")
    of = lambda values: F.element_at(F.lit([float(x) for x in values]), F.col("ending") + 1)
    seen = F.col("c").isNotNull()
    per_row = far.groupBy("row").agg(
        F.sum(F.when(seen, 1).otherwise(0)).alias("t_seen"),
        F.sum(F.when(seen, F.log10(F.col("c") + 1)).otherwise(0.0)).alias("t_base"),
        F.sum(F.when(F.col("class").isNotNull(), F.log10(F.col("c") + UNIT_SMOOTHING)).when(seen, of(end_log) + F.log10(F.col("c") - DISCOUNT)).otherwise(of(unseen_log))).alias("t_emit"),
        F.collect_list(F.when(F.col("class").isNotNull(), F.struct("pos", "class"))).alias("t_classes"))
    tagged = materialize(in_classes(encoded, per_row, sc.broadcast(number_class)), "tagged")

    # the end of a text is the only member of its class
    model = sc.broadcast((transition_log10(transitions(tagged)), np.log10(np.maximum(size + UNIT_SMOOTHING * members, UNIT_SMOOTHING)), float(np.log10(n_docs + UNIT_SMOOTHING))))

    def rows(batches):
        trans, divisor, end_emit = model.value
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                k = class_stream(part.column(2))
                step = trans[k[:-1], k[1:]] - divisor[k[1:]]
                ends_at = np.cumsum(part.column(3).to_numpy() + 1)
                score = np.diff(np.concatenate([[0], np.cumsum(step)])[np.concatenate([[0], ends_at])]) + part.column(6).to_numpy() + end_emit
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in (0, 1, 3, 4, 5)], pa.array(score)], names=kind.names)

    kind = schema(("doc_id", "bigint"), ("held_out", "boolean"), ("n_words", "bigint"), ("seen", "bigint"), ("base", "double"), ("score", "double"))
    n_words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n_all, n_types = n_words + n_docs, distinct + (n_docs > 0)
    n_tokens = F.col("n_words") + 1
    divisor = float(np.log10(n_all + n_types + 1.0))
    return tagged.mapInArrow(rows, kind).select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"), (F.col("seen") + int(n_docs > 0)).cast("bigint").alias("n_known"),
        F.lit(n_all).cast("bigint").alias("train_tokens"), (F.col("base") + float(np.log10(n_docs + 1.0)) - n_tokens * divisor).alias("base_score"), "score"
    ).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def rare_words(counts: DataFrame, frequent) -> DataFrame:
    """The counted words that are no units of their own."""
    def rows(batches):
        f = frequent.value
        for b in batches:
            w = b.column(0).to_numpy().view(np.uint64)
            at = np.minimum(np.searchsorted(f, w), max(0, len(f) - 1))
            yield b.filter(pa.array(f[at] != w if len(f) else np.ones(len(w), bool)))

    return counts.mapInArrow(rows, counts.schema)
