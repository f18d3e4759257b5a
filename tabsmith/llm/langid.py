"""Language identification by a bidirectional gated recurrent network over bytes.

The network is small (``HIDDEN`` units each way) and trained in numpy by
backpropagation through time on a bounded sample: at most ``per_lang`` labelled
documents of each language (smallest hash of doc_id), ``WINDOWS`` windows of ``SPAN``
bytes drawn from all over each of them. Every position of a window is a training case.

To predict, whole texts are cut into stretches of ``STRETCH`` bytes, each read with
``CONTEXT`` bytes of its surroundings on either side; the stretches of many documents run
side by side. The network labels every position, and a document's probabilities are the
means over its positions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import pick, schema
from tabsmith.llm.words import pieces

HIDDEN, SPAN, WINDOWS = 8, 48, 4
STRETCH, CONTEXT, BATCH = 256, 16, 4096
UNKNOWN = "und"
f32 = np.float32


def sigmoid(x: np.ndarray) -> np.ndarray:
    x *= f32(0.5)
    np.tanh(x, out=x)
    x *= f32(0.5)
    x += f32(0.5)
    return x


class Gru:
    """One direction: ``wx`` byte weights (3H x 256), ``u`` recurrent weights (3H x H),
    ``b`` bias of the candidate's recurrent part (H); gate order reset, update, candidate."""

    def __init__(self, rng: np.random.Generator):
        h = HIDDEN
        self.params = {"wx": rng.normal(0, 0.3, (3 * h, 256)).astype(f32), "u": (rng.normal(0, 1, (3 * h, h)) / np.sqrt(h)).astype(f32),
                       "b": np.zeros((h, 1), f32)}

    def run(self, x: np.ndarray, tape: list | None = None):
        """States after each step for bytes ``x`` (steps x batch), in reading order."""
        h, wx, u, b = HIDDEN, self.params["wx"], self.params["u"], self.params["b"]
        s = np.zeros((h, x.shape[1]), f32)
        for row in x:
            a = wx.take(row, axis=1)
            ur = u @ s
            a[: 2 * h] += ur[: 2 * h]
            gates = sigmoid(a[: 2 * h])
            un = ur[2 * h:]
            un += b
            cand = a[2 * h:]
            cand += gates[:h] * un
            np.tanh(cand, out=cand)
            new = cand + gates[h:] * (s - cand)
            if tape is not None:
                tape.append((row, s, gates, un, cand))
            s = new
            yield s

    def back(self, tape: list, d_out: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Gradients from the gradients of all states (backpropagation through time)."""
        h, u = HIDDEN, self.params["u"]
        grad = {k: np.zeros_like(v) for k, v in self.params.items()}
        ds, d_gates, rows = np.zeros_like(d_out[0]), [], []
        for (row, s, gates, un, cand), d in zip(reversed(tape), reversed(d_out)):
            ds = ds + d
            r, z = gates[:h], gates[h:]
            dn = ds * (1 - z) * (1 - cand * cand)
            dz = ds * (s - cand) * z * (1 - z)
            dr = dn * un * r * (1 - r)
            rec = np.concatenate([dr, dz, dn * r])
            grad["u"] += rec @ s.T
            grad["b"] += rec[2 * h:].sum(1, keepdims=True)
            d_gates.append(np.concatenate([dr, dz, dn]))
            rows.append(row)
            ds = ds * z + u.T @ rec
        at, flat = np.concatenate(rows), np.concatenate(d_gates, 1)
        grad["wx"] = np.stack([np.bincount(at, weights=g, minlength=256) for g in flat]).astype(f32)
        return grad


class ByteLabeller:
    """The two directions and the output layer."""

    def __init__(self, langs: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.ahead, self.behind = Gru(rng), Gru(rng)
        self.out = {"v": rng.normal(0, 0.3, (len(langs), 2 * HIDDEN)).astype(f32), "c": np.zeros((len(langs), 1), f32)}

    @staticmethod
    def softmax(logits: np.ndarray) -> np.ndarray:
        p = np.exp(logits - logits.max(0))
        return p / p.sum(0)

    def fit(self, windows: np.ndarray, labels: np.ndarray, steps: int = 260, batch: int = 96, rate: float = 0.02, seed: int = 5) -> "ByteLabeller":
        """``windows`` (n x SPAN bytes); cross-entropy of every position, Adam."""
        rng = np.random.default_rng(seed)
        by_lang = [np.flatnonzero(labels == k) for k in range(len(self.langs))]
        parts = [self.ahead.params, self.behind.params, self.out]
        m = [{k: np.zeros_like(v) for k, v in p.items()} for p in parts]
        v = [{k: np.zeros_like(x) for k, x in p.items()} for p in parts]
        for step in range(1, steps + 1):
            take = np.concatenate([rng.choice(i, max(1, batch // len(by_lang))) for i in by_lang])
            x, y = windows[take].T, labels[take]
            tapes: list[list] = [[], []]
            fwd = list(self.ahead.run(x, tapes[0]))
            bwd = list(self.behind.run(x[::-1], tapes[1]))[::-1]
            states = np.stack([np.concatenate(s) for s in zip(fwd, bwd)])            # step x 2H x batch
            p = self.out["v"] @ states + self.out["c"]
            p = np.exp(p - p.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[:, y, np.arange(len(y))] -= 1
            p /= p.shape[0] * len(y)
            d_states = self.out["v"].T @ p
            grads = [self.ahead.back(tapes[0], list(d_states[:, :HIDDEN])), self.behind.back(tapes[1], list(d_states[::-1, HIDDEN:])),
                     {"v": np.einsum("tkb,thb->kh", p, states), "c": p.sum((0, 2))[:, None]}]
            lr = rate * (1 - 0.9 * step / steps)
            for part, g, m1, v1 in zip(parts, grads, m, v):
                for k in part:
                    gk = np.clip(g[k], -1, 1)
                    m1[k] += (gk - m1[k]) * f32(0.1)
                    v1[k] += (gk * gk - v1[k]) * f32(0.01)
                    part[k] -= (lr * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(v1[k] / (1 - 0.99 ** step)) + 1e-8)).astype(f32)
        return self

    def document_probabilities(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Mean probabilities (documents x languages) over all positions."""
        size = np.diff(offs)
        n = -(-size // STRETCH)
        doc = np.repeat(np.arange(len(size)), n)
        begin = np.repeat(offs[:-1], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * STRETCH
        total = np.zeros((len(size), len(self.langs)))
        length = np.minimum(STRETCH, offs[doc + 1] - begin)
        order = np.argsort(-length, kind="stable")              # alike lengths run together
        padded = np.concatenate([np.full(CONTEXT, 0x20, np.uint8), buf, np.full(STRETCH + CONTEXT, 0x20, np.uint8)])
        for at in range(0, len(order), BATCH):
            pick_ = order[at: at + BATCH]
            b, ln, d = begin[pick_], length[pick_], doc[pick_]
            width = int(ln[0])
            pos = np.arange(-CONTEXT, width + CONTEXT)[:, None] + b
            x = padded[pos + CONTEXT]
            x[(pos < offs[d]) | (pos >= offs[d + 1])] = 0x20       # nothing of other documents
            sums = np.zeros((len(self.langs), len(b)), f32)
            kept = []
            for t, s in enumerate(self.ahead.run(x[: width + CONTEXT])):
                if t >= CONTEXT:
                    kept.append(s)
            vf, vb = self.out["v"][:, :HIDDEN], self.out["v"][:, HIDDEN:]
            for t, s in enumerate(self.behind.run(x[: CONTEXT - 1: -1])):
                place = width + CONTEXT - 1 - t                    # position in the stretch
                if place < width:
                    p = vf @ kept.pop()
                    p += vb @ s
                    p += self.out["c"]
                    np.exp(p, out=p)                               # logits are small: states lie in (-1, 1)
                    p /= p.sum(0)
                    if ln[-1] <= place:
                        p[:, ln <= place] = 0
                    sums += p
            np.add.at(total, d, sums.T.astype(np.float64))
        return total / np.maximum(size, 1)[:, None]


def has_letter(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    low = buf | 0x20
    ascii_letter = (low >= 0x61) & (low <= 0x7A) & (buf < 0x80)
    count = np.concatenate([[0], np.cumsum(ascii_letter)])
    out = count[offs[1:]] > count[offs[:-1]]
    high = np.concatenate([[0], np.cumsum(buf >= 0x80)])
    for i in np.flatnonzero(~out & (high[offs[1:]] > high[offs[:-1]])):
        out[i] = any(c.isalpha() for c in buf[offs[i]: offs[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def sample_windows(texts: list[bytes], seed: int) -> np.ndarray:
    """``WINDOWS`` windows of SPAN bytes from random places of each text."""
    rng = np.random.default_rng(seed)
    out = []
    for t in texts:
        x = np.frombuffer(t.ljust(SPAN), np.uint8)
        out += [x[i: i + SPAN] for i in rng.integers(0, len(x) - SPAN + 1, WINDOWS)]
    return np.array(out, np.uint8).reshape(-1, SPAN)


def train(labelled: DataFrame, per_lang: int = 300) -> ByteLabeller | None:
    """Fit on at most ``per_lang`` rows (doc_id, text, lang) of each language; None
    without any. Null labels and texts without letters are no cases."""
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    rows = (labelled.where("lang IS NOT NULL AND text IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
            .withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= per_lang).select("lang", "text").orderBy("lang", "rn").collect())
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return None
    windows, labels = [], []
    for k, lang in enumerate(langs):
        windows.append(sample_windows([r["text"].encode() for r in rows if r["lang"] == lang], k))
        labels.append(np.full(len(windows[-1]), k))
    return ByteLabeller(langs).fit(np.concatenate(windows), np.concatenate(labels))


def learnable(docs: DataFrame) -> DataFrame:
    """The rows that may be learned from: crc32 of the doc_id's text modulo 3 is not 1."""
    return docs.where(~held_out())


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def label_texts(model: ByteLabeller | None, buf: np.ndarray, offs: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text of a piece; ``und`` with 0 for a text without letters."""
    ok = has_letter(buf, offs)
    if model is None:
        return [UNKNOWN] * len(ok), np.zeros(len(ok))
    p = model.document_probabilities(buf, offs)
    return [model.langs[k] if o else UNKNOWN for k, o in zip(p.argmax(1), ok)], np.where(ok, np.clip(p.max(1), 0, 1), 0.0)


def predict(docs: DataFrame, model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of (doc_id, held_out, text) rows. ``model``: a
    broadcast labeller (or None in it)."""
    kind = schema(("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double"))

    def rows(batches):
        for batch in batches:
            for piece, buf, offs in pieces(batch, "text"):
                names, score = label_texts(model.value, buf, offs)
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(names, pa.string()), pa.array(score)], names=kind.names)

    return docs.select("doc_id", "held_out", "text").mapInArrow(rows, kind)


def in_known_language(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a letter, so that it gets a language; all columns
    as they are. The label and its score decide nothing. Without a model (no learnable row
    is labelled) the rows with a letter stay too."""
    def rows(batches):
        for batch in batches:
            for piece, buf, offs in pieces(batch, text_col):
                if model.value is None:
                    yield piece.filter(pa.array(has_letter(buf, offs)))
                    continue
                names, _ = label_texts(model.value, buf, offs)
                yield piece.filter(pa.array([x != UNKNOWN for x in names], pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 300):
    """A broadcast labeller learned from the learnable rows of ``docs``."""
    src = pick(docs, doc_id=id_col, text=text_col, lang=lang_col)
    return src.sparkSession.sparkContext.broadcast(train(learnable(src), per_lang))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 300) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    lang_pred is a learned language, or ``und`` with score 0 when the text is null or has
    no letter, and for all rows when nothing is labelled. Ties between languages go to
    the first in sorted order. Repeated rows and rows without doc_id are predicted like
    others (without doc_id: not held out)."""
    model = trained(docs, id_col, text_col, lang_col, per_lang)
    return predict(pick(docs, doc_id=id_col, text=text_col).withColumn("held_out", held_out()), model)
