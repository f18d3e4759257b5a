"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades run from 0 (worst) to K. One weight vector over hashed text features is shared by
all grades; K ordered thresholds cut its score:

    P(grade >= k | x) = sigmoid(w . x - threshold_k)

Features are the presence of lower-cased words and of word shapes (case, digits, the
punctuation behind a word), hashed to ``BITS`` bits; features of fewer
than ``MIN_DOCS`` training texts, however many there are, are left out. The model is fitted by proximal AdaGrad (an L1
term keeps weights of uninformative words at zero) on at most ``per_grade`` labelled rows
of each grade; the grades' shares among all labelled rows weight them. The expected grade
is the sum of the tail probabilities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import pick, schema
from tabsmith.llm.words import LETTERS_DIGITS, Words, mix, pieces

BITS = 18
MIN_DOCS = 4            # training texts a feature occurs in
EPOCHS, BATCH, RATE, L1 = 20, 64, 0.4, 7e-4


class Features:
    """Distinct hashed features of each text of a piece: ``idx``, cut by ``first``."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        words = Words(buf, offs, lower=True, word_bytes=LETTERS_DIGITS)
        raw = Words(buf, offs, lower=False)
        shape = Words(_shape(buf), offs, lower=False)           # the same word borders as raw
        doc = np.concatenate([words.doc, raw.doc])
        key = np.concatenate([words.hashes(), mix(_tail(shape))])
        slot = (key >> np.uint64(64 - BITS)).astype(np.int64)
        pair = np.unique(doc * (1 << BITS) + slot)
        self.idx = pair & ((1 << BITS) - 1)
        self.first = np.searchsorted(pair, np.arange(len(offs)) << BITS)


_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x30:0x3A] = 0x39            # digits
_CLASS[0x41:0x5B] = 0x41            # capitals
_CLASS[0x61:0x7B] = 0x61            # small letters
_CLASS[0x80:] = 0x61                # letters beyond ASCII count as small


def _shape(buf: np.ndarray) -> np.ndarray:
    return _CLASS[buf]


def _tail(shape: Words) -> np.ndarray:
    """Shape of a word's last four bytes, with its first byte's class."""
    return shape.ends(4) * np.uint64(256) + shape.buf[shape.start].astype(np.uint64) + np.uint64(1)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class OrdinalModel:
    """Shared weights ``w`` and ordered ``thresholds`` (one fewer than grades)."""

    def __init__(self, n_grades: int):
        self.w = np.zeros(1 << BITS)
        self.thresholds = np.linspace(-1, 1, n_grades - 1) if n_grades > 2 else np.zeros(n_grades - 1)

    def fit(self, idx: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = 3) -> "OrdinalModel":
        df = np.bincount(idx, minlength=len(self.w))
        use = df >= MIN_DOCS
        grade = np.arange(1, len(self.thresholds) + 1)
        share = np.array([np.average(y >= k, weights=weight) for k in grade]).clip(1e-3, 1 - 1e-3)
        self.thresholds = np.log((1 - share) / share)
        rng, g2, t2 = np.random.default_rng(seed), np.full(len(self.w), 1.0), np.ones(len(grade))
        for _ in range(EPOCHS):
            for at in np.array_split(rng.permutation(len(y)), max(1, len(y) // BATCH)):
                n = first[at + 1] - first[at]
                pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at], n)
                f, doc = idx[pos], np.repeat(np.arange(len(at)), n)
                f, doc = f[use[f]], doc[use[f]]
                s = np.bincount(doc, weights=self.w[f], minlength=len(at))
                tail = sigmoid(s[:, None] - self.thresholds)
                err = ((y[at][:, None] >= grade) - tail) * weight[at][:, None] / len(at)        # ascent direction
                hit, back = np.unique(f, return_inverse=True)
                grad = np.bincount(back, weights=err.sum(1)[doc])
                g2[hit] += (grad * len(at)) ** 2
                step = RATE / np.sqrt(g2[hit])
                w = self.w[hit] + step * grad * len(at)
                self.w[hit] = np.sign(w) * np.maximum(np.abs(w) - step * L1 * len(at), 0)
                gt = -err.sum(0) * len(at)
                t2 += gt ** 2
                self.thresholds = np.sort(self.thresholds + RATE * gt / np.sqrt(t2))
        return self

    def tails(self, features: Features) -> np.ndarray:
        """P(grade >= k) for k = 1..K, one row per text."""
        total = np.concatenate([[0], np.cumsum(self.w[features.idx])])
        s = total[features.first[1:]] - total[features.first[:-1]]
        return sigmoid(s[:, None] - self.thresholds)


def graded(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """(doc_id, grade) from 0/1 labels: toxic 0, poor 1, good 2; of several labels of one
    document the lowest. Rows with a null id or label say nothing."""
    rows = pick(labels, doc_id=id_col, quality=quality_col, toxic=toxic_col).dropna()
    grade = F.when(F.col("toxic") == 1, 0).otherwise(F.col("quality") + 1).cast("int")
    return rows.groupBy("doc_id").agg(F.min(grade).alias("grade"))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 2, F.lit(False))


def train(docs: DataFrame, grades: DataFrame, n_grades: int = 3, per_grade: int = 4000) -> OrdinalModel:
    """Fit on at most ``per_grade`` labelled rows of each grade (smallest hash of doc_id)
    that are not held out."""
    labelled = docs.join(grades, "doc_id").where(~held_out() & F.col("text").isNotNull() & F.col("grade").between(0, n_grades - 1))
    w = Window.partitionBy("grade").orderBy(F.xxhash64("doc_id"), "doc_id")
    count = labelled.groupBy("grade").agg(F.count(F.lit(1)).alias("n"))
    chosen = (labelled.select("doc_id", "grade").withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= per_grade)
              .join(F.broadcast(count), "grade").withColumnRenamed("doc_id", "chosen"))
    # tasks reduce the chosen texts to feature numbers
    src = docs.join(chosen, F.col("doc_id") == F.col("chosen")).select("doc_id", "grade", "n", "rn", "text")

    def rows(batches):
        for b in batches:
            for piece, buf, offs in pieces(b, "text"):
                f = Features(buf, offs)
                lists = pa.ListArray.from_arrays(pa.array(f.first.astype(np.int32)), pa.array(f.idx.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*[piece.column(i) for i in range(4)], lists], names=kind.names)

    kind = schema(("doc_id", "bigint"), ("grade", "int"), ("n", "bigint"), ("rn", "int"), ("f", "array<int>"))
    got = src.mapInArrow(rows, kind).orderBy("grade", "rn").toArrow()
    model = OrdinalModel(n_grades)
    if not got.num_rows:
        return model
    y, n = got.column("grade").to_numpy(), got.column("n").to_numpy().astype(float)
    f = got.column("f").combine_chunks()
    idx, first = np.asarray(f.flatten()).astype(np.int64), np.asarray(f.offsets).astype(np.int64) - f.offsets[0].as_py()
    weight = n / np.bincount(y, minlength=n_grades)[y]           # back to the grades' shares
    return model.fit(idx, first, y, weight / weight.mean())


def grade_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = 0.65, per_grade: int = 4000, **cols) -> DataFrame:
    """One row per document: doc_id, held_out, expected_grade (0 to 2), p_not_toxic =
    P(grade >= 1), p_good = P(grade >= 2), keep (p_not_toxic >= ``keep_at``).

    Null and empty texts have no features and get the grades' overall odds, as do all
    texts when nothing is labelled (then with equal odds). Repeated rows are graded each;
    rows without doc_id are graded and not learned from. Labels of unknown documents say
    nothing. A document's features are those of its whole text."""
    src = pick(docs, doc_id=id_col, text=text_col)
    model = src.sparkSession.sparkContext.broadcast(train(src, graded(labels, **cols), per_grade=per_grade))
    kind = schema(("doc_id", "bigint"), ("held_out", "boolean"), ("expected_grade", "double"), ("p_not_toxic", "double"), ("p_good", "double"))

    def rows(batches):
        for b in batches:
            for piece, buf, offs in pieces(b, "text"):
                p = model.value.tails(Features(buf, offs))
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(p.sum(1)), pa.array(p[:, 0]), pa.array(p[:, 1])], names=kind.names)

    return (src.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(rows, kind)
            .withColumn("keep", F.col("p_not_toxic") >= F.lit(keep_at)))


