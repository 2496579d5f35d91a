"""Toxicity of whole texts: a bidirectional GRU with attention pooling over characters and words.

A word goes in as a hashed word embedding and as the mean and the largest
evidence of its hashed character grams, so unseen forms of known stems count. A
word of more than PIECE bytes, as of text without white space, is cut into
overlapping pieces that go in as words. Every run of WINDOW words of a text is
scored, at all starts; the text's score is that of its worst window, put on the
scale of the labels by a logistic fit. Training picks its examples from windows
STRIDE words apart.
Trained in numpy on a bounded, hash-chosen set of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import _IS_SPACE, Batch, batch_of, mix, slices, text_rows

WINDOW, STRIDE = 32, 24
WORD_BITS, GRAM_BITS, GRAM = 16, 18, 4
PIECE, PIECE_STEP = 64, 48  # bytes
WORD_DIMS, HIDDEN = 3, 6
INPUTS = WORD_DIMS + 3
# Bounds of what is learned from: labelled rows of each kind, and their length.
TRAIN_ROWS, TRAIN_CHARS = 1500, 8_000
# States (h + 1) / 2 this near are taken as one (logits keep to about 1e-5, as after rounding); steps after which they are compared.
MERGED, MERGE_AT = 2e-6, (12, 14, 17)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Words:
    """The distinct words of a batch of texts, and which of them stands where."""

    word: np.ndarray  # bucket of each distinct word
    grams: np.ndarray  # buckets of all their character grams, word after word
    first: np.ndarray  # where each word's grams start
    place: np.ndarray  # per word of the batch, its distinct word


def in_pieces(batch: Batch) -> Batch:
    """A batch with its words of more than PIECE bytes cut: a piece every PIECE_STEP bytes, the last one ending with the word."""
    lengths = batch.ends - batch.starts
    many = np.where(lengths > PIECE, -(-(lengths - PIECE) // PIECE_STEP) + 1, 1)
    word = np.repeat(np.arange(len(many)), many)
    step = np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many)
    starts = batch.starts[word] + np.minimum(step * PIECE_STEP, np.maximum(lengths[word] - PIECE, 0))
    ends = starts + np.minimum(lengths[word], PIECE)
    return Batch(batch.data, batch.offsets, starts, ends, np.concatenate(([0], np.cumsum(many)))[batch.first])


def words_of(batch: Batch) -> Words:
    """The words of a batch `in_pieces`. A word's grams are its runs of GRAM bytes, lower-cased, with one byte around the word.

    Where a piece is cut off, the byte around it is another one than at a word's end.
    """
    hashes = batch.hashes(lower=True)
    outside = np.ones(len(batch.data) + 2, bool)  # whether a word can't go on with the byte before
    outside[1:-1] = _IS_SPACE[batch.data]
    edge = np.zeros(len(batch.data) + 1, bool)
    edge[batch.offsets] = True
    cut = [~(outside[batch.starts] | edge[batch.starts]), ~(outside[batch.ends + 1] | edge[batch.ends])]
    hashes = np.where(cut[0] | cut[1], mix(hashes, 41) + cut[0] + np.uint64(2) * cut[1], hashes)
    hashes = np.where(cut[0] | cut[1], mix(hashes, 42), hashes)
    distinct, at, place = np.unique(hashes, return_index=True, return_inverse=True)
    word = (distinct >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    lengths = batch.ends[at] - batch.starts[at]
    padded = lengths + 2
    count = np.maximum(padded - GRAM + 1, 1)
    first = np.concatenate(([0], np.cumsum(padded)))
    bytes_ = np.zeros(first[-1] + GRAM, np.uint64)
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    value = batch.data[np.repeat(batch.starts[at], lengths) + inside].astype(np.uint64)
    value += np.uint64(32) * ((value >= 65) & (value <= 90))
    bytes_[np.repeat(first[:-1] + 1, lengths) + inside] = value
    bytes_[first[:-1]], bytes_[first[1:] - 1] = 256 * cut[0][at], 256 * cut[1][at]
    codes = np.zeros(first[-1], np.uint64)
    for j in range(GRAM):
        codes = codes * np.uint64(257) + bytes_[j:j + first[-1]] + np.uint64(1)
    keep = np.arange(first[-1]) - np.repeat(first[:-1], padded) < np.repeat(count, padded)
    grams = (mix(codes[keep], 5) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)
    return Words(word, grams, np.concatenate(([0], np.cumsum(count)[:-1])), place)


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, text) of the windows that are learned from: every STRIDE words, the last one ending with the text."""
    n = np.diff(first)
    many = np.where(n > WINDOW, -(-(n - WINDOW) // STRIDE) + 1, (n > 0).astype(int))
    text = np.repeat(np.arange(len(n)), many)
    step = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    start = first[text] + np.minimum(step * STRIDE, np.maximum(n[text] - WINDOW, 0))
    return start, text


def _slid(x: np.ndarray, u: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """`ends` of the states of windows at all starts, after each of their words: (2, WINDOW, windows).

    States forget: after some words that of a window is the one that the next
    window has at the same word, to MERGED. From there on the window takes the next
    one's states, and only the others are carried on; they are tested again at the
    steps MERGE_AT. Windows that aren't `inside` a text are given up then.
    """
    cut, n = 2 * HIDDEN, len(inside)
    out, live = np.empty((2, WINDOW, n), np.float32), None
    k = state = np.full((HIDDEN, n), 0.5, np.float32)
    for t in range(WINDOW):
        some = x[:, t:t + n] if live is None else x[:, live + t]
        gates = u[:cut] @ k
        gates += some[:cut]
        new = k - np.float32(0.5)
        with np.errstate(over="ignore"):
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            new *= gates[HIDDEN:]
            new = u[cut:] @ new
            new += some[cut:]
            np.exp(new, out=new)
        new += 1
        np.reciprocal(new, out=new)
        new -= k
        new *= gates[:HIDDEN]
        new += k
        before, k = state, new
        if live is None:
            state, out[:, t] = k, ends @ k
        else:
            out[:, t, :-1] = out[:, t - 1, 1:]
            out[:, t, live] = ends @ k
            if t <= MERGE_AT[-1]:
                state = np.empty_like(before)
                state[:, :-1] = before[:, 1:]
                state[:, live] = k
        if t in MERGE_AT:
            near = np.zeros(n, bool)
            near[:-1] = np.abs(state[:, :-1] - before[:, 1:]).max(0) <= MERGED
            near[:-1] &= inside[1:]
            live = np.flatnonzero(inside & ~near) if live is None else live[~near[live]]
            k = state[:, live]
    return out


class Model:
    """Weights; forward and backward passes over windows in time-major order."""

    def __init__(self, word_evidence: np.ndarray, gram_evidence: np.ndarray, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        f = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.words = f(1 << WORD_BITS, WORD_DIMS) * 0.1
        self.words[:, 0] = word_evidence
        self.grams = gram_evidence.astype(np.float32)
        self.w = {d: f(INPUTS, 3 * HIDDEN) for d in "fb"}
        self.u = {d: f(HIDDEN, 3 * HIDDEN) for d in "fb"}
        self.c = {d: np.zeros(3 * HIDDEN, np.float32) for d in "fb"}
        self.attend, self.out = f(2 * HIDDEN), f(2 * HIDDEN)
        self.bias = np.zeros(1, np.float32)
        self.scale = (1.0, 0.0)
        self.base = 0.0

    def weights(self) -> list[np.ndarray]:
        return [self.words, *self.w.values(), *self.u.values(), *self.c.values(), self.attend, self.out, self.bias]

    def evidence_of(self, words: Words) -> np.ndarray:
        """Per distinct word: mean and largest evidence of its grams, and whether it is short."""
        if not len(words.word):
            return np.zeros((0, INPUTS - WORD_DIMS), np.float32)
        evidence = self.grams[words.grams]
        sums, top = np.add.reduceat(evidence, words.first), np.maximum.reduceat(evidence, words.first)
        counts = np.diff(np.append(words.first, len(evidence)))
        return np.column_stack([sums / counts, top, counts < 3]).astype(np.float32)

    def run(self, x: dict[str, np.ndarray], mask: np.ndarray, keep: bool = False):
        """Window logits from gate inputs x[d] (time, window, gates); mask (time, window)."""
        steps, n = mask.shape
        hidden, saved = np.zeros((steps, n, 2 * HIDDEN), np.float32), []
        for d in "fb":
            h, part = np.zeros((n, HIDDEN), np.float32), slice(0, HIDDEN) if d == "f" else slice(HIDDEN, None)
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                gates = sigmoid(x[d][t, :, :2 * HIDDEN] + h @ self.u[d][:, :2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(x[d][t, :, 2 * HIDDEN:] + (r * h) @ self.u[d][:, 2 * HIDDEN:])
                m = mask[t][:, None]
                if keep:
                    saved.append((d, t, h, z, r, new, m))
                h = h + m * z * (new - h)
                hidden[t, :, part] = h
        scores = np.where(mask > 0, hidden @ self.attend, -1e9)
        scores = np.exp(scores - scores.max(0))
        share = scores / scores.sum(0)
        logits = np.einsum("tn,tnh,h->n", share, hidden, self.out, optimize=True) + self.bias[0]
        return (logits, hidden, share, saved) if keep else logits

    def gate_inputs(self, table: np.ndarray) -> dict[str, np.ndarray]:
        return {d: table @ self.w[d] + self.c[d] for d in "fb"}

    def window_logits(self, words: Words, start: np.ndarray, end: np.ndarray, most: int = 4096) -> np.ndarray:
        table = np.concatenate([self.words[words.word], self.evidence_of(words)], 1)
        gates, out = self.gate_inputs(table), np.empty(len(start), np.float32)
        for s in range(0, len(start), most):
            at = start[s:s + most] + np.arange(WINDOW)[:, None]
            mask = (at < end[s:s + most]).astype(np.float32)
            at = words.place[np.minimum(at, len(words.place) - 1)]
            out[s:s + most] = self.run({d: gates[d][at] for d in "fb"}, mask)
        return out

    def slid_logits(self, words: Words, first: np.ndarray, most: int = 16384) -> np.ndarray:
        """Per text of WINDOW words or more, the largest logit of its windows at all starts; -inf for shorter ones.

        The same as `run` without a mask, over neighbouring windows at once: their
        words at a step are a slice. Windows across two texts are left out.
        """
        out = np.full(len(first) - 1, -np.inf)
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        whole = np.arange(len(text)) + WINDOW <= first[text + 1]
        table = np.concatenate([self.words[words.word], self.evidence_of(words)], 1)
        gates, cut = self.gate_inputs(table), 2 * HIDDEN
        u = {d: np.concatenate([-2 * self.u[d][:, :cut], -4 * self.u[d][:, cut:]], 1).T for d in "fb"}
        for d, g in gates.items():
            # States go as (h + 1) / 2, so that tanh and sigmoid are both 1 / (1 + exp) and need no more steps.
            g[:, :cut] = self.u[d][:, :cut].sum(0) - g[:, :cut]
            g[:, cut:] *= -2
        ends = {d: 2 * np.stack([self.attend[own], self.out[own]]) for d, own in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None)))}
        for s in range(0, len(text) - WINDOW + 1, most):
            if not whole[s:s + most].any():
                continue
            n = min(most, len(text) - WINDOW + 1 - s)
            place, inside = words.place[s:s + n + WINDOW - 1], whole[s:s + n]
            x = {d: np.ascontiguousarray(gates[d][place if d == "f" else place[::-1]].T) for d in "fb"}
            scores, values = _slid(x["f"], u["f"], ends["f"], inside) + _slid(x["b"], u["b"], ends["b"], inside[::-1])[:, ::-1, ::-1]
            scores -= scores.max(0)
            np.exp(scores, out=scores)
            logits = (scores * values).sum(0) / scores.sum(0) + (self.bias[0] - self.out.sum())
            kept = np.flatnonzero(inside)
            np.maximum.at(out, text[s + kept], logits[kept])
        return out

    def learn(self, words: Words, start: np.ndarray, end: np.ndarray, label: np.ndarray, epochs: int) -> None:
        """Adam on the windows' log loss, through time and attention."""
        rng, step, fixed = np.random.default_rng(3), 0, self.evidence_of(words)
        size = min(256, max(16, len(start) // 40))  # few windows make as many steps
        weights = self.weights()
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for _ in range(epochs):
            order = rng.permutation(len(start))
            for s in range(0, len(order), size):
                some, step = order[s:s + size], step + 1
                at = start[some] + np.arange(WINDOW)[:, None]
                mask = (at < end[some]).astype(np.float32)
                at = words.place[np.minimum(at, len(words.place) - 1)]
                table = np.concatenate([self.words[words.word[at]], fixed[at]], 2)
                x = {d: table @ self.w[d] + self.c[d] for d in "fb"}
                grads = self._gradients(table, x, mask, label[some], words.word[at])
                for w, g, a, b in zip(weights, grads, first, second):
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    w -= 0.01 * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-6)

    def _gradients(self, table, x, mask, label, buckets) -> list[np.ndarray]:
        logits, hidden, share, saved = self.run(x, mask, keep=True)
        n = mask.shape[1]
        up = ((sigmoid(logits) - label) / n).astype(np.float32)
        value = hidden @ self.out
        g_out = np.einsum("n,tn,tnh->h", up, share, hidden, optimize=True)
        g_score = share * (value - (share * value).sum(0)) * up
        g_attend = np.einsum("tn,tnh->h", g_score, hidden, optimize=True)
        g_hidden = (share * up)[:, :, None] * self.out + g_score[:, :, None] * self.attend
        g_w = {d: np.zeros_like(self.w[d]) for d in "fb"}
        g_u = {d: np.zeros_like(self.u[d]) for d in "fb"}
        g_c = {d: np.zeros_like(self.c[d]) for d in "fb"}
        g_x, carry = np.zeros_like(table), {d: np.zeros((n, HIDDEN), np.float32) for d in "fb"}
        for d, t, h, z, r, new, m in reversed(saved):
            g = carry[d] + g_hidden[t, :, :HIDDEN] if d == "f" else carry[d] + g_hidden[t, :, HIDDEN:]
            g_new = g * m * z * (1 - new * new)
            back = g_new @ self.u[d][:, 2 * HIDDEN:].T
            g_gates = np.concatenate([g * m * (new - h) * z * (1 - z), back * h * r * (1 - r)], 1)
            g_u[d][:, :2 * HIDDEN] += h.T @ g_gates
            g_u[d][:, 2 * HIDDEN:] += (r * h).T @ g_new
            g_all = np.concatenate([g_gates, g_new], 1)
            g_w[d] += table[t].T @ g_all
            g_c[d] += g_all.sum(0)
            g_x[t] += g_all @ self.w[d].T
            carry[d] = g * (1 - m * z) + back * r + g_gates @ self.u[d][:, :2 * HIDDEN].T
        g_words = np.zeros_like(self.words)
        np.add.at(g_words, buckets.ravel(), (g_x[:, :, :WORD_DIMS] * mask[:, :, None]).reshape(-1, WORD_DIMS))
        return [g_words, *g_w.values(), *g_u.values(), *g_c.values(), g_attend, g_out, np.array([up.sum()], np.float32)]

    def scores(self, batch: Batch) -> np.ndarray:
        """Per text of a batch, the logit of its worst window; -inf without words."""
        words = words_of(batch)
        out = self.slid_logits(words, batch.first)
        n = np.diff(batch.first)
        short = np.flatnonzero((n > 0) & (n < WINDOW))
        if len(short):
            out[short] = self.window_logits(words, batch.first[short], batch.first[short + 1])
        return out

    def probabilities(self, batch: Batch) -> np.ndarray:
        a, b = self.scale
        logits = self.scores(batch)
        return np.where(np.isfinite(logits), sigmoid(a * np.where(np.isfinite(logits), logits, 0) + b), self.base)


def evidence(batch: Batch, words: Words, label: np.ndarray, block: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed log odds that a text is labelled 1, per word bucket and per gram bucket in it.

    Texts are counted some at a time, so memory follows the largest, not all.
    """
    counts = [np.zeros((2, 1 << bits)) for bits in (WORD_BITS, GRAM_BITS)]
    lengths = np.diff(np.append(words.first, len(words.grams)))
    for low in range(0, len(label), block):
        high = min(len(label), low + block)
        place = words.place[batch.first[low]:batch.first[high]]
        text = np.repeat(np.arange(low, high), np.diff(batch.first[low:high + 1]))
        pairs = np.unique(text * len(words.word) + place)
        text, distinct = pairs // max(1, len(words.word)), pairs % max(1, len(words.word))
        n = lengths[distinct]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        grams = words.grams[np.repeat(words.first[distinct], n) + inner] if len(distinct) else words.grams[:0]
        for table, owner, bucket in ((counts[0], text, words.word[distinct]), (counts[1], np.repeat(text, n), grams)):
            seen = np.unique(owner * table.shape[1] + bucket)
            np.add.at(table, (label[seen // table.shape[1]], seen % table.shape[1]), 1)
    texts = [max(1, int((label == v).sum())) for v in (0, 1)]
    odds = [np.log((t[1] + 0.5) / (texts[1] + 1)) - np.log((t[0] + 0.5) / (texts[0] + 1)) for t in counts]
    return tuple(np.where(t.sum(0) > 2, o, 0).astype(np.float32) for t, o in zip(counts, odds))


def trained(texts: list[str], labels: list[int]) -> Model | float:
    """A model, or where there is one kind of label only, its constant score."""
    label = np.array(labels)
    if not len(label) or label.min() == label.max():
        return float(label[0]) if len(label) else 0.0
    batch = in_pieces(batch_of(pa.array(texts, pa.large_string())))
    words = words_of(batch)
    model = Model(*evidence(batch, words, label))
    start, of = windows_of(batch.first)
    end = np.minimum(start + WINDOW, batch.first[of + 1])
    hot = np.maximum(model.words[words.word, 0], 0) + np.maximum(model.evidence_of(words)[:, 1], 0)
    heat = np.concatenate(([0], np.cumsum(hot[words.place])))
    strength, rng = heat[end] - heat[start], np.random.default_rng(5)
    for epochs in (3, 2, 2):
        # The worst window of each text stands for it; of the clean ones also some others.
        order = np.lexsort((-strength, of))
        worst = order[np.unique(of[order], return_index=True)[1]]
        clean = np.flatnonzero(label[of] == 0)
        chosen = np.concatenate((worst, rng.choice(clean, min(len(clean), 2 * len(worst)), replace=False)))
        model.learn(words, start[chosen], end[chosen], label[of[chosen]].astype(np.float32), epochs)
        strength = model.window_logits(words, start, end)
    scores, known = model.scores(batch), np.diff(batch.first) > 0
    model.scale = logistic_fit(scores[known], label[known])
    return model


def logistic_fit(x: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a small ridge."""
    a, b = 1.0, 0.0
    for _ in range(30):
        p = sigmoid(a * x + b)
        w = p * (1 - p) + 1e-6
        gradient = np.array([((p - label) * x).sum() + 0.1 * (a - 1), (p - label).sum()])
        hessian = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum()]])
        a, b = np.array([a, b]) - np.linalg.solve(hessian, gradient)
    return float(a), float(b)


def picked_labels(labels: DataFrame, name: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, label): of each label the `rows` ids with the smallest hashes."""
    known = labels.select("doc_id", F.col(name).cast("int").alias("label")).filter("label IN (0, 1) AND doc_id IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    order = [F.xxhash64(F.lit(17), "doc_id"), F.col("doc_id")]
    picked = [known.filter(F.col("label") == v).orderBy(*order).limit(rows) for v in (0, 1)]
    return picked[0].union(picked[1])


def training_rows(docs: DataFrame, labels: DataFrame, name: str, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> list[tuple[str, int]]:
    """Labelled texts of `picked_labels`, where they have 1 to `chars` characters.

    Only ids are ranked; the texts of the few chosen come straight from a scan.
    """
    texts = text_rows(docs, "doc_id", "text").filter(F.length("text").between(1, chars))
    found = texts.join(F.broadcast(picked_labels(labels, name, rows)), "doc_id").dropDuplicates(["doc_id", "text"])
    # The order of examples, and so the model, is the same in a rerun.
    return [(r["text"], r["label"]) for r in sorted(found.collect(), key=lambda r: (r["doc_id"], r["text"]))]


def scored(docs: DataFrame, model: Model | float) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id and score, 0 to 1.

    Null and empty texts and texts of white space score 0: nothing in them is
    toxic. Repeated rows score alike; other columns are ignored.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, most=1 << 19):
            batch = in_pieces(batch_of(rows["text"]))
            values = np.full(rows.num_rows, model) if isinstance(model, float) else model.probabilities(batch)
            yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(values, pa.float64())], ["doc_id", "score"])

    return text_rows(docs, "doc_id", "text").mapInArrow(score, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """Scores of all `docs` from a model trained on labelled rows of `learn_from` (default: `docs`)."""
    examples = training_rows(docs if learn_from is None else learn_from, labels, "toxic")
    return scored(docs, trained([t for t, _ in examples], [v for _, v in examples]))
