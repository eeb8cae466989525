"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A run of letters longer than 64 characters enters as overlapping pieces, each a word of its own.
A word enters with a hashed word vector and the mean of its hashed character groups (3 to 5, word ends marked). The network
reads windows of ``WINDOW`` words that overlap by half and cover the whole text; a text scores as its
highest window. Labels are per text, so training learns from the window of each text that scores
highest at the time. The training sample is bounded by a parameter; scoring covers all rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import bucket_of, per_process

WINDOW, STRIDE = 32, 16
WORD_ROWS, CHAR_ROWS = 1 << 15, 1 << 15
WORD_DIM, CHAR_DIM, HIDDEN, ATTEND = 8, 6, 8, 8
#: Labelled texts that the training may fetch: so many of either label, chosen by a hash of the id.
SAMPLE = 1500
#: Longer texts of the sample lend it a run of this many windows, from a place given by the same hash.
SAMPLE_WINDOWS = 64
THRESHOLD = 0.7
EPOCHS = 6
KEPT_WORDS = 300_000
PIECE, LAP = 64, 16  # characters of a piece of a long run, and those that it shares with the next
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters and digits; of a run longer than ``PIECE``, overlapping pieces that cover it."""
    out = []
    for w in _WORD.findall(text.lower()):
        if len(w) <= PIECE:
            out.append(w)
        else:
            out += [w[a:a + PIECE] for a in range(0, len(w) - LAP, PIECE - LAP)]
    return out


def window_starts(n: int) -> range:
    """First words of the windows: every ``STRIDE`` words until the text is covered."""
    return range(0, max(n - WINDOW + STRIDE, 1), STRIDE) if n else range(0)


def word_row(word: str) -> int:
    return zlib.crc32(word.encode()) % WORD_ROWS


def char_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the hashed groups of 3 to 5 bytes of every word, ends marked, and where each word's begin."""
    data = [f"^{w}$".encode() for w in words]
    raw = np.frombuffer(b"".join(data) + b"\0" * 8, np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    owner, length = np.repeat(np.arange(len(data)), sizes), int(sizes.sum())
    left = np.cumsum(sizes)[owner] - np.arange(length)
    owners, rows = [], []
    for n in (3, 4, 5):
        code = np.full(length, n, np.uint64)
        for k in range(n):
            code = code * np.uint64(0x100000001B3) + raw[k:length + k]
        code = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        rows.append(((code >> np.uint64(40)) % np.uint64(CHAR_ROWS)).astype(np.int64)[left >= n])
        owners.append(owner[left >= n])
    order = np.argsort(np.concatenate(owners), kind="stable")
    counts = np.bincount(np.concatenate(owners), minlength=len(data))
    return np.concatenate(rows)[order], np.cumsum(counts) - counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


Params = dict[str, np.ndarray]


def new_params(rng: np.random.Generator) -> Params:
    dim = WORD_DIM + CHAR_DIM

    def normal(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    p = {
        "words": (rng.standard_normal((WORD_ROWS, WORD_DIM)) * 0.1).astype(np.float32),
        "chars": (rng.standard_normal((CHAR_ROWS, CHAR_DIM)) * 0.1).astype(np.float32),
        "attend": normal(2 * HIDDEN, ATTEND), "ask": normal(ATTEND), "out": normal(2 * HIDDEN),
        "bias": np.zeros(1, np.float32)}
    for d in "fb":
        p |= {f"x{d}": normal(dim, 3 * HIDDEN), f"h{d}": normal(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
    return p


def gru(inputs: np.ndarray, mask: np.ndarray, weights: np.ndarray, keep: bool = False):
    """States (steps, rows, HIDDEN) of projected inputs (steps, rows, 3 * HIDDEN): gates z, r, then the candidate."""
    steps, rows, _ = inputs.shape
    h = np.zeros((rows, HIDDEN), np.float32)
    states, memory = np.empty((steps, rows, HIDDEN), np.float32), []
    for t in range(steps):
        back = h @ weights
        gates = _sigmoid(inputs[t, :, :2 * HIDDEN] + back[:, :2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = np.tanh(inputs[t, :, 2 * HIDDEN:] + r * back[:, 2 * HIDDEN:])
        if keep:
            memory.append((h, z, r, n, back[:, 2 * HIDDEN:]))
        h = np.where(mask[t, :, None], (1 - z) * n + z * h, h)
        states[t] = h
    return states, memory


def gru_back(grad: np.ndarray, mask: np.ndarray, weights: np.ndarray, memory: list):
    steps, rows, _ = grad.shape
    d_inputs, d_weights = np.zeros((steps, rows, 3 * HIDDEN), np.float32), np.zeros_like(weights)
    carried = np.zeros((rows, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        h, z, r, n, back_n = memory[t]
        on = mask[t, :, None]
        d = (carried + grad[t]) * on
        skip = (carried + grad[t]) * ~on
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (h - n) * z * (1 - z)
        dr = dn * back_n * r * (1 - r)
        d_inputs[t] = np.concatenate((dz, dr, dn), axis=1)
        d_back = np.concatenate((dz, dr, dn * r), axis=1)
        d_weights += h.T @ d_back
        carried = d * z + d_back @ weights.T + skip
    return d_inputs, d_weights


def pooled(states: np.ndarray, mask: np.ndarray, p: Params):
    """Attention pooling over the steps: logits, and what its gradient needs."""
    hidden = np.tanh(states @ p["attend"])
    scores = np.where(mask, hidden @ p["ask"], -1e9)
    share = np.exp(scores - scores.max(axis=0))
    share /= share.sum(axis=0)
    pool = (share[:, :, None] * states).sum(axis=0)
    return pool @ p["out"] + p["bias"][0], (hidden, share, pool)


class Words:
    """Numbers of words, 0 for none, with their hashed rows; with parameters, their projections instead."""

    def __init__(self, p: Params | None = None, kept: int = KEPT_WORDS):
        self.p, self.kept = p, kept
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {"": 0}
        self.rows: list[tuple[int, np.ndarray]] = [(0, np.zeros(1, np.int64))]
        self.table = np.zeros((1024, 6 * HIDDEN), np.float32)

    def number(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Word numbers of each text; the table is ready for all of them."""
        met = set().union(*texts)
        new = sorted(met - self.numbers.keys())
        if self.p is not None and len(self.numbers) + len(new) > self.kept:
            self.clear()
            new = sorted(met - self.numbers.keys())
        if new:
            start = len(self.numbers)
            self.numbers.update(zip(new, range(start, start + len(new)), strict=True))
            while self.p is not None and len(self.table) < len(self.numbers):
                self.table = np.concatenate((self.table, np.zeros_like(self.table)))
            for a in range(0, len(new), 8192):  # pieces are long: their groups are made for so many at a time
                part = new[a:a + 8192]
                own = np.fromiter(map(word_row, part), np.int64, len(part))
                flat, begins = char_rows(part)
                if self.p is None:
                    self.rows += list(zip(own.tolist(), np.split(flat, begins[1:]), strict=True))
                else:
                    self.table[start + a:start + a + len(part)] = projections(_features(own, flat, begins, self.p), self.p)
        at = self.numbers.__getitem__
        return [np.fromiter(map(at, t), np.int64, len(t)) for t in texts]


def _features(own: np.ndarray, flat: np.ndarray, begins: np.ndarray, p: Params) -> np.ndarray:
    counts = np.diff(np.concatenate((begins, [len(flat)])))
    chars = np.add.reduceat(p["chars"][flat], begins, axis=0) / counts[:, None]
    return np.concatenate((p["words"][own], chars), axis=1).astype(np.float32)


def features(rows: list[tuple[int, np.ndarray]], p: Params) -> np.ndarray:
    counts = np.fromiter((len(cs) for _, cs in rows), np.int64, len(rows))
    own = np.fromiter((w for w, _ in rows), np.int64, len(rows))
    return _features(own, np.concatenate([cs for _, cs in rows]), np.cumsum(counts) - counts, p)


def projections(inputs: np.ndarray, p: Params) -> np.ndarray:
    return np.concatenate([inputs @ p["x" + d] + p["c" + d] for d in "fb"], axis=1).astype(np.float32)


def windows(numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(text of each window, word numbers of each window, 0 behind the end)."""
    owner, grid = [], []
    for k, n in enumerate(numbers):
        starts = np.array(window_starts(len(n)), np.int64)
        if len(starts):
            padded = np.concatenate((n, np.zeros(WINDOW, np.int64)))
            grid.append(padded[starts[:, None] + np.arange(WINDOW)])
            owner.append(np.full(len(starts), k))
    if not grid:
        return np.zeros(0, np.int64), np.zeros((0, WINDOW), np.int64)
    return np.concatenate(owner), np.concatenate(grid)


def logits(grid: np.ndarray, words: Words, p: Params, rows: int = 4096) -> np.ndarray:
    out = np.empty(len(grid), np.float32)
    for a in range(0, len(grid), rows):
        part = grid[a:a + rows].T
        mask = part > 0
        inputs = words.table[part]
        ahead, _ = gru(inputs[:, :, :3 * HIDDEN], mask, p["hf"])
        behind, _ = gru(inputs[::-1, :, 3 * HIDDEN:], mask[::-1], p["hb"])
        out[a:a + rows], _ = pooled(np.concatenate((ahead, behind[::-1]), axis=2), mask, p)
    return out


def gradients(grid: np.ndarray, labels: np.ndarray, weights: np.ndarray, words: Words, p: Params) -> tuple[float, Params]:
    """Weighted cross-entropy of windows and its gradient for every parameter."""
    part = grid.T
    mask = part > 0
    used, inverse = np.unique(part, return_inverse=True)
    inverse = inverse.reshape(part.shape)
    rows = [words.rows[k] for k in used]
    inputs = features(rows, p)
    ahead, mf = gru((inputs @ p["xf"] + p["cf"])[inverse], mask, p["hf"], keep=True)
    behind, mb = gru((inputs @ p["xb"] + p["cb"])[inverse[::-1]], mask[::-1], p["hb"], keep=True)
    states = np.concatenate((ahead, behind[::-1]), axis=2)
    value, (hidden, share, pool) = pooled(states, mask, p)
    chance = _sigmoid(value)
    loss = float(-(weights * np.log(np.where(labels > 0, chance, 1 - chance) + 1e-9)).sum() / weights.sum())
    d = ((chance - labels) * weights / weights.sum()).astype(np.float32)
    g = {"out": pool.T @ d, "bias": np.array([d.sum()], np.float32)}
    d_pool = d[:, None] * p["out"]
    d_share = (states * d_pool).sum(axis=2)
    d_scores = share * (d_share - (share * d_share).sum(axis=0))
    g["ask"] = np.einsum("tra,tr->a", hidden, d_scores)
    d_hidden = d_scores[:, :, None] * p["ask"] * (1 - hidden * hidden)
    g["attend"] = np.einsum("trs,tra->sa", states, d_hidden)
    d_states = share[:, :, None] * d_pool + d_hidden @ p["attend"].T
    d_inputs = np.zeros_like(inputs)
    for name, memory, turn, cut in (("f", mf, 1, slice(0, HIDDEN)), ("b", mb, -1, slice(HIDDEN, 2 * HIDDEN))):
        back, g["h" + name] = gru_back(d_states[::turn, :, cut], mask[::turn], p["h" + name], memory)
        by_word = np.zeros((len(used), 3 * HIDDEN), np.float32)
        np.add.at(by_word, inverse[::turn].ravel(), back.reshape(-1, 3 * HIDDEN))
        g["x" + name], g["c" + name] = inputs.T @ by_word, by_word.sum(axis=0)
        d_inputs += by_word @ p["x" + name].T
    g["words"], g["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
    np.add.at(g["words"], [w for w, _ in rows], d_inputs[:, :WORD_DIM])
    counts = np.array([len(cs) for _, cs in rows])
    np.add.at(g["chars"], np.concatenate([cs for _, cs in rows]), np.repeat(d_inputs[:, WORD_DIM:] / counts[:, None], counts, axis=0))
    return loss, g


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> tuple[Params, float]:
    """Parameters, and the shift that puts the best cut of the sample at ``THRESHOLD``."""
    rng = np.random.default_rng(seed)
    p = new_params(rng)
    words = Words()
    numbers = words.number([words_of(t) for t in texts])
    owner, grid = windows(numbers)
    if not len(grid) or labels.min() == labels.max():
        p["out"][:] = 0
        return p, -5.0 if not len(labels) or labels.max() == 0 else 5.0
    # one input of words and one of character groups start at their log-odds in the sample
    totals = np.array([(labels == 0).sum(), (labels == 1).sum()])
    rows_of = {"words": [np.array([w]) for w, _ in words.rows], "chars": [cs for _, cs in words.rows]}
    for name in ("words", "chars"):
        seen = np.zeros((2, len(p[name])))
        for k, n in enumerate(numbers):
            seen[int(labels[k]), np.unique(np.concatenate([rows_of[name][x] for x in np.unique(n)] or [np.zeros(0, np.int64)]))] += 1
        odds = np.log((seen[1] + 1) / (totals[1] + 2)) - np.log((seen[0] + 1) / (totals[0] + 2))
        p[name][:, 0] = np.clip(np.where(seen.sum(axis=0) > 3, odds, 0), -3, 3)
    by_number = features(words.rows, p)[:, [0, WORD_DIM]].sum(axis=1)
    by_number[0] = 0
    level = by_number[grid].max(axis=1)
    first, second = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    weight_of = np.where(labels == 1, 0.5 / totals[1], 0.5 / totals[0]) * len(labels)
    for epoch in range(epochs):
        if epoch:
            level = logits(grid, _projected(words, p), p)
        order = np.lexsort((-level, owner))
        top = order[np.concatenate(([True], owner[order][1:] != owner[order][:-1]))]
        clean = np.flatnonzero(labels[owner] == 0)
        chosen = np.concatenate((top, rng.choice(clean, min(len(clean), len(top)), replace=False)))
        rng.shuffle(chosen)
        for a in range(0, len(chosen), 64):
            batch = chosen[a:a + 64]
            _, g = gradients(grid[batch], labels[owner[batch]].astype(np.float32), weight_of[owner[batch]], words, p)
            step += 1
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            rate = 0.01 * min(1.0, 5.0 / (norm + 1e-9))
            for k, x in g.items():
                first[k] = 0.9 * first[k] + 0.1 * x
                second[k] = 0.99 * second[k] + 0.01 * x * x
                p[k] -= (rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    value = logits(grid, _projected(words, p), p)
    best = np.full(len(texts), -30.0)
    np.maximum.at(best, owner, value)
    cuts = np.unique(best)
    cuts = (cuts[1:] + cuts[:-1]) / 2
    hits = np.array([[(best[labels == 1] > c).sum(), (best[labels == 0] > c).sum()] for c in cuts])
    f1 = 2 * hits[:, 0] / (hits.sum(axis=1) + totals[1])
    good = np.flatnonzero(f1 >= f1.max() - 1e-9)
    return p, float(np.log(THRESHOLD / (1 - THRESHOLD)) - cuts[good[len(good) // 2]])


def _projected(words: Words, p: Params) -> Words:
    out = Words(p)
    out.numbers, out.rows = words.numbers, words.rows
    out.table = projections(features(words.rows, p), p)
    return out


def training_sample(docs: DataFrame, labels: DataFrame, folds: int, held_out: int, per_label: int) -> DataFrame:
    """doc_id, text and toxic of at most ``per_label`` labelled rows of either label, outside the held-out fold.

    Rows are chosen by id and a hash of their text; whole texts are fetched of the chosen rows only, by
    a broadcast of their names, at most ``2 * per_label``. Equal rows are chosen once.
    """
    known = labels.where("toxic is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic"))
    rows = docs.where((bucket_of(F.col("doc_id"), folds) != held_out) & F.col("text").isNotNull())
    rows = rows.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("_h"))
    named = rows.select("doc_id", "_h").distinct().join(known, F.col("doc_id") == F.col("_id"))
    order = F.xxhash64("doc_id", F.lit("sample"))
    parts = [named.where(F.col("toxic") == k).orderBy(order, "doc_id", "_h").limit(per_label) for k in (0, 1)]
    chosen = parts[0].unionByName(parts[1]).select(
        F.col("doc_id").alias("_id"), F.col("_h").alias("_name"), F.col("toxic").cast("int").alias("toxic"))
    met = rows.join(F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col("_h") == F.col("_name")))
    return met.dropDuplicates(["doc_id", "_h"]).select("doc_id", "text", "toxic")


def toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, per_label: int = SAMPLE,
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Rows whose crc32(doc_id) modulo ``folds`` is ``held_out`` lend no label. An id with several labels
    counts as toxic if one says so. A null text, or one without a word, scores 0. Without labels of
    both kinds all scores are the same.
    """
    picked = training_sample(docs, labels, folds, held_out, per_label).collect()
    picked.sort(key=lambda r: (r["doc_id"], r["text"]))
    texts = []
    for r in picked:
        found = words_of(r["text"])
        span = SAMPLE_WINDOWS * STRIDE
        at = zlib.crc32(str(r["doc_id"]).encode()) % max(len(found) - span, 1) if r["toxic"] == 0 else 0
        texts.append(" ".join(found[at:at + span] if r["toxic"] == 0 else found))
    p, shift = train(texts, np.array([r["toxic"] for r in picked], np.int64))
    shared = docs.sparkSession.sparkContext.broadcast((p, shift))
    size = 300_000  # characters scored together

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, shift = shared.value
        key = float(np.sum(p["words"][::97])) + shift
        words = per_process(("toxicity", key), lambda: Words(p))
        for batch in batches:
            best = np.full(batch.num_rows, -np.inf)
            held: list[tuple[int, list[str]]] = []
            n = 0

            def flush(held=held, best=best) -> None:
                owner, grid = windows(words.number([w for _, w in held]))
                if len(grid):
                    np.maximum.at(best, np.array([k for k, _ in held])[owner], logits(grid, words, p))
                held.clear()

            for k, text in enumerate(batch.column(2).to_pylist()):
                found = words_of(text or "")
                # long texts in runs that overlap, so that every window is met
                for a in range(0, max(len(found) - WINDOW + STRIDE, 1), 50_000 // STRIDE * STRIDE):
                    held.append((k, found[a:a + 50_000 // STRIDE * STRIDE + WINDOW - STRIDE]))
                    n += len(held[-1][1]) * 6
                    if n >= size:
                        flush()
                        n = 0
            flush()
            value = _sigmoid(best.clip(-30, 30) + shift) * (best > -np.inf)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(value, pa.float64()),
                 pa.array((value >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (bucket_of(F.col("doc_id"), folds) == held_out).alias("held_out"),
        F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
