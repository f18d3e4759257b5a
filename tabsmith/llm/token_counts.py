"""Token counts by a tokenizer compiled to a finite-state transducer.

The tokenizer is a piece model of the byte-pair kind with byte fallback (``.model``):
repeatedly the adjacent pair with the best score joins, leftmost first. Its result on a
text is the only sequence of pieces in which every two neighbours are the tokenizer's
own result on their joined text. So the last piece of every prefix is determined, and

    tokens(prefix + c) = tokens(prefix + c without its last piece) + 1,

where the last piece is the suffix that may follow the last piece of what is before it.
A *state* of the transducer holds, for each suffix of the prefix that begins a piece,
the last piece before that suffix and how many tokens lie before it, relative to the
whole prefix. That is all the future can depend on. A transition on a character leads to
the next state and is annotated with the number of tokens it adds (negative when pieces
join). States and transitions are compiled when a text first needs them and kept.

A text is cut into chunks between two characters that no piece holds side by side; no
piece spans such a cut, so a chunk is entered in the start state. Equal chunks are run
once. A chunk longer than ``BLOCK`` characters is cut into blocks: a block's map takes
the state before it to (state after it, tokens); maps are evaluated in parallel for the
start state and for every state that an earlier block can hand over, and composed by a
prefix scan (pointer doubling over blocks).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import pick, schema
from tabsmith.llm.words import pieces

BLOCK = 64              # characters of a block
LANES = 1 << 16         # characters run before the size of the tables is looked at
STATES = 1 << 17        # states kept in a task; beyond, the tables are compiled anew
SPACE = "▁"        # stands for a space in pieces
FEW = 16                # pieces ahead that are tried to see whether two states are one
ANY = -1                # no piece before: whatever follows may begin here

#: classes 0 to 3: characters that no piece has, by UTF-8 length; they become one token a byte
UNKNOWN = 4


def read_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, score) of the pieces that take part in joining. The model must have byte
    fallback, keep its input as it is and put one space in front; anything else raises."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = " ﬁ Ａ  é\n x "
    if sp.normalize(probe) != (SPACE + probe).replace(" ", SPACE):
        raise ValueError(f"{path} rewrites its input; only models that keep it can be compiled")
    if len(sp.encode("\U000f1234")) != 5:
        raise ValueError(f"{path} has no byte fallback")
    out, singles = [], set()
    for i in range(sp.get_piece_size()):
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)):
            if sp.is_unused(i):
                raise ValueError(f"{path} has unused pieces")
            out.append((sp.id_to_piece(i), sp.get_score(i)))
    singles = {p for p, _ in out if len(p) == 1}
    if {c for p, _ in out for c in p} - singles:
        raise ValueError(f"{path} has pieces of characters that are no pieces")
    return out


class Transducer:
    """The transducer of one piece model; states and transitions are compiled lazily."""

    def __init__(self, scored: list[tuple[str, float]]):
        chars = sorted({c for p, _ in scored for c in p})
        self.class_of = np.zeros(0x110000, np.uint16)
        self.class_of[0x80:], self.class_of[0x800:], self.class_of[0x10000:] = 1, 2, 3
        self.class_of[[ord(c) for c in chars]] = np.arange(UNKNOWN, UNKNOWN + len(chars))
        self.class_of[ord(" ")] = self.class_of[ord(SPACE)]
        self.n_classes = UNKNOWN + len(chars)
        # a piece is the string of its classes
        self.pieces = ["".join(chr(self.class_of[ord(c)]) for c in p) for p, _ in scored]
        self.score = {p: s for p, (_, s) in zip(self.pieces, scored)}
        # trie of the pieces; node 0 is empty
        self.child: dict[tuple[int, int], int] = {}
        self.parts: list[str] = [""]
        self.piece_at: list[bool] = [False]
        self.inner: list[bool] = [False]
        self.kids: dict[int, list[int]] = {}
        self.ahead: dict[int, list[int] | None] = {}
        together = np.zeros(self.n_classes * self.n_classes, bool)
        for p in self.pieces:
            node = 0
            for i, c in enumerate(map(ord, p)):
                self.inner[node] = True
                nxt = self.child.get((node, c))
                if nxt is None:
                    nxt = self.child[node, c] = len(self.parts)
                    self.kids.setdefault(node, []).append(nxt)
                    self.parts.append(p[: i + 1])
                    self.piece_at.append(False)
                    self.inner.append(False)
                node = nxt
                if i:
                    together[ord(p[i - 1]) * self.n_classes + c] = True
            self.piece_at[node] = True
        self.together = np.packbits(together, bitorder="little")
        self.follows: dict[tuple[int, int], bool] = {}
        self.same: dict[tuple[int, int], int] = {}
        self.counts: dict[bytes, int] = {}
        self.restart()

    def restart(self) -> None:
        """Forget the compiled states and transitions."""
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.keys, self.to, self.emit = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.start = self._state(((0, ANY, 0),))
        for held in (self.follows, self.same):
            if len(held) > 4 * STATES:
                held.clear()

    def _state(self, chain: tuple) -> int:
        n = self.number.get(chain)
        if n is None:
            n = self.number[chain] = len(self.states)
            self.states.append(chain)
        return n

    def joined(self, x: str, y: str) -> bool:
        """Whether the tokenizer's result on x + y is the two pieces x and y."""
        s, score = list(x + y), self.score
        worth = [score.get(a + b) for a, b in zip(s, s[1:])]
        border = len(x) - 1         # the pair that spans the border must never join
        while True:
            best, at = None, -1
            for i, v in enumerate(worth):
                if v is not None and (best is None or v > best):
                    best, at = v, i
            if best is None:
                return s == [x, y]
            if at == border:
                return False
            s[at: at + 2] = [s[at] + s[at + 1]]
            del worth[at]
            border -= at < border
            if at:
                worth[at - 1] = score.get(s[at - 1] + s[at])
            if at < len(worth):
                worth[at] = score.get(s[at] + s[at + 1])

    def may_follow(self, last: int, node: int) -> bool:
        if last == ANY or self.apart(last, node):
            return True
        got = self.follows.get((last, node))
        if got is None:
            got = self.follows[last, node] = self.joined(self.parts[last], self.parts[node])
        return got

    def transition(self, state: int, c: int) -> tuple[int, int]:
        """(next state, tokens added) on a character of class ``c``."""
        if c < UNKNOWN:
            return self.start, c + 1
        last, before, grown = None, 0, []
        for node, prev, rel in self.states[state]:
            nxt = self.child.get((node, c))
            if nxt is None:
                continue
            if last is None and self.piece_at[nxt] and self.may_follow(prev, nxt):
                last, before = nxt, rel
            if self.inner[nxt]:
                grown.append((nxt, prev, rel))
        added = before + 1
        chain = [(node, self._relevant(prev, node), rel - added) for node, prev, rel in grown]
        return self._state((*chain, (0, last, 0))), added

    def apart(self, last: int, node: int) -> bool:
        """Whether no piece spans the border of the two, so that both stay as they are."""
        k = ord(self.parts[last][-1]) * self.n_classes + ord(self.parts[node][0])
        return not self.together[k >> 3] >> (k & 7) & 1

    def _relevant(self, prev: int, node: int) -> int:
        """``prev``, or ANY when it excludes no piece that begins with ``node``."""
        if prev == ANY or self.apart(prev, node):
            return ANY
        got = self.same.get((prev, node))
        if got is None:
            ahead = self.below(node)
            free = ahead is not None and all(self.may_follow(prev, p) for p in ahead)
            got = self.same[prev, node] = ANY if free else prev
        return got

    def below(self, node: int) -> list[int] | None:
        """Pieces longer than ``node`` that begin with it, if they are few."""
        if node not in self.ahead:
            out, todo = [], [node]
            while todo and len(out) <= FEW:
                at = todo.pop()
                for n in self.kids.get(at, ()):
                    todo.append(n)
                    if self.piece_at[n]:
                        out.append(n)
            self.ahead[node] = out if len(out) <= FEW else None
        return self.ahead[node]

    def step(self, state: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One character for many lanes at once."""
        key = state * self.n_classes + cls
        at = np.searchsorted(self.keys, key)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == key[known]
        if not known.all():
            new = np.unique(key[~known])
            made = np.array([self.transition(*divmod(int(k), self.n_classes)) for k in new], np.int64)
            where = np.searchsorted(self.keys, new)
            self.keys = np.insert(self.keys, where, new)
            self.to, self.emit = np.insert(self.to, where, made[:, 0]), np.insert(self.emit, where, made[:, 1])
            at = np.searchsorted(self.keys, key)
        return self.to[at], self.emit[at]

    def run(self, chunks: list[np.ndarray], state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end state, tokens) of every chunk entered in its state; one lane a chunk."""
        size = np.array([len(c) for c in chunks], np.int64)
        order = np.argsort(-size, kind="stable")
        padded = np.zeros((len(chunks), int(size.max(initial=0))), np.int64)
        for row, i in enumerate(order):
            padded[row, : size[i]] = chunks[i]
        live, state, tokens = size[order], state[order].copy(), np.zeros(len(chunks), np.int64)
        for i in range(padded.shape[1]):
            n = int(np.searchsorted(-live, -i, side="left"))       # lanes longer than i
            state[:n], added = self.step(state[:n], padded[:n, i])
            tokens[:n] += added
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], tokens[back]

    def short(self, distinct: list[bytes]) -> np.ndarray:
        """Tokens of distinct chunks entered in the start state."""
        todo = [c for c in distinct if c not in self.counts]
        held, got = dict.fromkeys(distinct), 0
        at = 0
        while at < len(todo):
            to, chars = at, 0
            while to < len(todo) and chars < LANES:
                chars += len(todo[to]) // 2
                to += 1
            _, n = self.run([np.frombuffer(c, np.uint16) for c in todo[at:to]], np.full(to - at, self.start))
            held.update(zip(todo[at:to], n.tolist()))
            at = to
            if len(self.states) > STATES:
                self.restart()
        for c in distinct:
            if held[c] is None:
                held[c] = self.counts[c]
        if len(self.counts) > 2 * STATES:
            self.counts.clear()
        self.counts.update(held)
        return np.fromiter((held[c] for c in distinct), np.int64, len(distinct))

    def long(self, blocks: list[bytes], first: np.ndarray) -> np.ndarray:
        """Tokens of each stretch of consecutive blocks; ``first`` marks the block that
        begins a stretch. Blocks are mapped in parallel and maps composed by doubling."""
        if len(self.states) > STATES:
            self.restart()
        kind_of: dict[bytes, int] = {}
        kind = np.array([kind_of.setdefault(b, len(kind_of)) for b in blocks], np.int64)
        content = [np.frombuffer(b, np.uint16) for b in kind_of]
        n = len(blocks)
        last = np.append(first[1:], True)
        maps: dict[tuple[int, int], tuple[int, int]] = {}
        # (block, state) pairs that can occur, beginning with the start state for all
        block, state = np.arange(n), np.full(n, self.start)
        seen = [(block, state)]
        have = set(zip(block.tolist(), state.tolist()))
        ends, tokens = [], []
        while len(block):
            want = list({(k, s) for k, s in zip(kind[block].tolist(), state.tolist())} - maps.keys())
            if want:
                end, cnt = self.run([content[k] for k, _ in want], np.array([s for _, s in want], np.int64))
                maps.update(zip(want, zip(end.tolist(), cnt.tolist())))
            got = [maps[k, s] for k, s in zip(kind[block].tolist(), state.tolist())]
            ends.append(np.array([e for e, _ in got], np.int64))
            tokens.append(np.array([t for _, t in got], np.int64))
            nxt = [(b + 1, e) for b, e, stop in zip(block.tolist(), ends[-1].tolist(), last[block].tolist()) if not stop]
            nxt = [p for p in dict.fromkeys(nxt) if p not in have]
            have.update(nxt)
            block = np.array([b for b, _ in nxt], np.int64)
            state = np.array([s for _, s in nxt], np.int64)
            if nxt:
                seen.append((block, state))
        block, state = (np.concatenate(x) for x in zip(*seen))
        end, total = np.concatenate(ends), np.concatenate(tokens)
        index = {p: i for i, p in enumerate(zip(block.tolist(), state.tolist()))}
        stop = len(block)       # a pair past the end that adds nothing
        ahead = np.array([stop if s else index[b + 1, e] for b, e, s in zip(block.tolist(), end.tolist(), last[block].tolist())] + [stop])
        total = np.append(total, 0)
        while (ahead != stop).any():        # total: tokens of a run of 1, 2, 4, ... blocks
            total, ahead = total + total[ahead], ahead[ahead]
        return total[: n][first]            # pair i is (block i, start state)

    def count(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Tokens of each text of a piece (bytes, offsets)."""
        text = buf.tobytes().decode("utf-8")
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        begins = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[offs]       # in characters
        n_texts, filled = len(offs) - 1, np.diff(begins) > 0
        out = np.zeros(n_texts, np.int64)
        if not filled.any():
            return out
        # one space in front of every text that isn't empty
        at = begins[:-1][filled]
        cls = np.insert(self.class_of[code], at, self.class_of[ord(SPACE)])
        at = at + np.arange(len(at))
        pair = cls[:-1].astype(np.int64) * self.n_classes + cls[1:]
        cut = np.ones(len(cls), bool)
        cut[1:] = self.together[pair >> 3] >> (pair & 7).astype(np.uint8) & 1 == 0
        cut[at] = True
        start = np.flatnonzero(cut)
        size = np.diff(start, append=len(cls))
        tokens = np.zeros(len(start), np.int64)
        tall = size > BLOCK
        if tall.any():
            blocks, first = [], []
            for s, z in zip(start[tall].tolist(), size[tall].tolist()):
                cuts = range(s, s + z, BLOCK)
                blocks += [cls[c: min(c + BLOCK, s + z)].tobytes() for c in cuts]
                first += [True] + [False] * (len(cuts) - 1)
            tokens[tall] = self.long(blocks, np.array(first))
        data = pa.Array.from_buffers(pa.large_binary(), len(start),
                                     [None, pa.py_buffer(np.append(start, len(cls)) * 2), pa.py_buffer(np.ascontiguousarray(cls))])
        coded = data.filter(pa.array(~tall)).dictionary_encode() if tall.any() else data.dictionary_encode()
        if len(coded):
            tokens[~tall] = self.short(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        out[filled] = np.add.reduceat(tokens, np.searchsorted(start, at))
        return out


_HELD: dict[int, Transducer] = {}


def transducer(scored: list[tuple[str, float]]) -> Transducer:
    """The transducer of these pieces, compiled once in a worker process."""
    key = hash(tuple(scored))
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = Transducer(scored)
    return _HELD[key]


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of
    every whole text, as the piece model at path ``model`` splits it, without begin or
    end tokens; special strings in a text are ordinary text.

    One row per row of ``docs``, repeated rows and ids included; other columns don't
    matter. A null or empty text has 0 bytes and 0 tokens; an empty table gives none.
    The model is read by the driver and its pieces (a few hundred KB, fixed by the
    model) go with the function; nothing is shuffled. Memory of a task follows its
    longest text and ``STATES``, not the table."""
    scored = read_pieces(model)
    docs = pick(docs, doc_id=id_col, text=text_col).select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    out = schema(("doc_id", docs.schema["doc_id"].dataType.simpleString()), ("n_bytes", "bigint"), ("n_tokens", "bigint"))

    def run(batches):
        t = transducer(scored)
        for batch in batches:
            for piece, buf, offs in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(2), pa.array(t.count(buf, offs))], names=["doc_id", "n_bytes", "n_tokens"])

    return docs.mapInArrow(run, out).withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
