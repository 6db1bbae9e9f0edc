"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is scored window by window: ``WINDOW`` words, a new window every ``STRIDE`` words, over the
whole text, and its score is that of its most toxic window. A word enters as a learned vector of
its own (if the training sample holds it) beside the mean of learned vectors of its character
trigrams (so that unseen spellings count too). Two GRUs read the window from either end,
attention weighs their states, and a logistic unit scores the weighted mean.

Training knows labels of documents only, so the window that speaks for a document is chosen again
each few epochs: the highest-scored one, first by the words' smoothed log-odds; clean documents
add a random window. The sample holds at most ``sample`` documents of each label, picked by a hash of
doc_id, and of them those of at most ``longest`` characters (documented bounds); vocabularies come
from it, so the model's size is bounded too. Scores read whole texts of any length.

Defined cases: null text counts as empty; a text without words gets the score of a window without
words; labels that are null are ignored; without labels of both kinds every score is the share of
toxic labels (0 without any label); rows that repeat are scored alike; an empty table gives an
empty result; further columns are ignored. Training is deterministic.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import text_of

WINDOW, STRIDE = 32, 16
SAMPLE = 1_500
#: Characters of a labelled text that are learned from: with SAMPLE it bounds what reaches the driver. Of longer texts they are drawn in PARTS from end to end.
LONGEST, PARTS = 40_000, 16
UNITS, VECTOR = 8, 6
MIN_DOCS = 3
EPOCHS, BATCH, RATE = 24, 256, 0.02
AT_ONCE = 4_096
KNOWN_WORDS = 200_000

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def trigrams(word: str) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + 3] for i in range(len(marked) - 2)]


def windows(n: int) -> list[tuple[int, int]]:
    """Begin and end of the windows over n words; together they cover all words, and a text has one at least."""
    return [(b, min(n, b + WINDOW)) for b in range(0, max(1, n - WINDOW + STRIDE), STRIDE)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters, forward pass and gradients. Row 0 of the vectors belongs to what is unknown and stays zero."""

    def __init__(self, words: dict[str, int], grams: dict[str, int], word_prior: np.ndarray, gram_prior: np.ndarray, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.words, self.grams = words, grams
        h, d = UNITS, 2 * VECTOR
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {
            "word": np.zeros((len(word_prior), VECTOR), np.float32),
            "gram": np.zeros((len(gram_prior), VECTOR), np.float32),
            "in": draw(d, 6 * h),
            "in_b": np.zeros(6 * h, np.float32),
            "up_f": draw(h, 3 * h),
            "up_b": draw(h, 3 * h),
            "rec_f": np.zeros(3 * h, np.float32),
            "rec_b": np.zeros(3 * h, np.float32),
            "look": draw(2 * h),
            "out": draw(2 * h),
            "out_b": np.zeros(1, np.float32),
        }
        self.p["word"][:, 0], self.p["gram"][:, 0] = word_prior, gram_prior

    # a vocabulary of the words at hand: rows of (word row, trigram rows)
    def describe(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        rows = np.array([self.words.get(w, 0) for w in words], dtype=np.int64)
        found = [[self.grams.get(g, 0) for g in trigrams(w)] for w in words]
        sizes = np.array([len(f) for f in found], dtype=np.int64)
        flat = np.array([g for f in found for g in f], dtype=np.int64)
        return rows, flat, np.repeat(np.arange(len(words)), sizes), np.maximum(sizes, 1).astype(np.float32)

    def inputs(self, described) -> np.ndarray:
        rows, flat, owner, sizes = described
        chars = np.stack([np.bincount(owner, self.p["gram"][flat, j], len(rows)) for j in range(VECTOR)], 1) if len(rows) else np.zeros((0, VECTOR))
        return np.concatenate([self.p["word"][rows], (chars / sizes[:, None]).astype(np.float32)], axis=1)

    def projected(self, x: np.ndarray) -> np.ndarray:
        return x @ self.p["in"] + self.p["in_b"]

    def _scan(self, table: np.ndarray, ids: np.ndarray, mask: np.ndarray, way: str, keep: bool):
        h, n, t_all = UNITS, len(ids), ids.shape[1]
        up, rec = self.p["up_" + way], self.p["rec_" + way]
        state = np.zeros((n, h), np.float32)
        states, saved = np.empty((t_all, n, h), np.float32), []
        for t in range(t_all) if way == "f" else range(t_all - 1, -1, -1):
            x, back = table[ids[:, t]], state @ up + rec
            gates = _sigmoid(x[:, : 2 * h] + back[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h :] + r * back[:, 2 * h :])
            m = mask[:, t, None]
            if keep:
                saved.append((t, state, z, r, new, back[:, 2 * h :], m))
            state = state + m * (1 - z) * (new - state)
            states[t] = state
        return states, saved

    def forward(self, table: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows; table: projected inputs, with row -1 for padding."""
        h = UNITS
        ahead, saved_f = self._scan(table[:, : 3 * h], ids, mask, "f", keep)
        behind, saved_b = self._scan(table[:, 3 * h :], ids, mask, "b", keep)
        states = np.concatenate([ahead, behind], axis=2)
        looks = states @ self.p["look"] + np.where(mask.T > 0, 0, -30).astype(np.float32)
        weights = np.exp(looks - looks.max(0))
        weights /= weights.sum(0)
        pooled = (weights[:, :, None] * states).sum(0)
        logits = pooled @ self.p["out"] + self.p["out_b"][0]
        return (logits, (states, weights, pooled, saved_f, saved_b)) if keep else logits

    def gradients(self, described, ids: np.ndarray, mask: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        h, x = UNITS, self.inputs(described)
        table = np.concatenate([self.projected(x), np.zeros((1, 6 * h), np.float32)])
        logits, (states, weights, pooled, saved_f, saved_b) = self.forward(table, ids, mask, keep=True)
        d_logit = ((_sigmoid(logits) - target) * weight / weight.sum()).astype(np.float32)
        g = {"out": pooled.T @ d_logit, "out_b": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * self.p["out"]
        along = (states * d_pooled).sum(2)
        d_look = weights * (along - (weights * along).sum(0))
        g["look"] = (d_look[:, :, None] * states).sum((0, 1))
        d_states = weights[:, :, None] * d_pooled + d_look[:, :, None] * self.p["look"]
        d_table = np.zeros_like(table)
        for way, saved, part, cols in (("f", saved_f, d_states[:, :, :h], slice(0, 3 * h)), ("b", saved_b, d_states[:, :, h:], slice(3 * h, 6 * h))):
            up, d_up, d_rec = self.p["up_" + way], np.zeros((h, 3 * h), np.float32), np.zeros(3 * h, np.float32)
            carry, d_x_all = np.zeros((len(ids), h), np.float32), np.empty((ids.shape[1], len(ids), 3 * h), np.float32)
            for t, before, z, r, new, back, m in reversed(saved):
                total = carry + part[t]
                own = total * m
                d_new = own * (1 - z) * (1 - new * new)
                d_z = own * (before - new) * z * (1 - z)
                d_r = d_new * back * r * (1 - r)
                d_back = np.concatenate([d_z, d_r, d_new * r], axis=1)
                d_x_all[t] = np.concatenate([d_z, d_r, d_new], axis=1)
                d_up += before.T @ d_back
                d_rec += d_back.sum(0)
                carry = total * (1 - m) + own * z + d_back @ up.T
            g["up_" + way], g["rec_" + way] = d_up, d_rec
            flat = ids.T.ravel()
            for j in range(3 * h):
                d_table[:, cols.start + j] += np.bincount(flat % len(table), d_x_all[:, :, j].ravel(), len(table))
        d_proj = d_table[:-1]
        g["in"], g["in_b"] = x.T @ d_proj, d_proj.sum(0)
        d_input = d_proj @ self.p["in"].T
        rows, grams, owner, sizes = described
        g["word"], g["gram"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["gram"])
        for j in range(VECTOR):
            g["word"][:, j] = np.bincount(rows, d_input[:, j], len(g["word"]))
            g["gram"][:, j] = np.bincount(grams, (d_input[:, VECTOR + j] / sizes)[owner], len(g["gram"]))
        g["word"][0] = g["gram"][0] = 0
        return g


def _prior(hits: Counter, misses: Counter, toxic: int, clean: int) -> tuple[dict[str, int], np.ndarray]:
    """Entries seen in MIN_DOCS documents, and their log-odds, pulled to zero where seldom."""
    seen = sorted(w for w in {*hits, *misses} if hits[w] + misses[w] >= MIN_DOCS)
    odds = [(np.log((hits[w] + 0.5) / (toxic + 1)) - np.log((misses[w] + 0.5) / (clean + 1))) * (n := hits[w] + misses[w]) / (n + 10) for w in seen]
    return {w: i + 1 for i, w in enumerate(seen)}, np.array([0.0, *odds], dtype=np.float32) / 4


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Network | None:
    """A network for the sample; None without documents of both labels."""
    toxic, clean = sum(labels), len(labels) - sum(labels)
    if not toxic or not clean:
        return None
    split = [words_of(t) for t in texts]
    counts = {(kind, y): Counter() for kind in "wg" for y in (0, 1)}
    for own, y in zip(split, labels):
        distinct = set(own)
        counts["w", y].update(distinct)
        counts["g", y].update({g for w in distinct for g in trigrams(w)})
    words, word_prior = _prior(counts["w", 1], counts["w", 0], toxic, clean)
    grams, gram_prior = _prior(counts["g", 1], counts["g", 0], toxic, clean)
    net = Network(words, grams, word_prior, gram_prior, seed)

    known = sorted({w for own in split for w in own})
    place = {w: i for i, w in enumerate(known)}
    described = net.describe(known)
    spans = [(d, b, e) for d, own in enumerate(split) for b, e in windows(len(own))]
    owner = np.array([s[0] for s in spans])
    ids, mask = _pad([[place[w] for w in split[d][b:e]] for d, b, e in spans])
    y = np.array(labels, dtype=np.float32)
    first = np.r_[0, np.flatnonzero(np.diff(owner)) + 1]
    rng = np.random.default_rng(seed)
    own_prior = np.r_[net.p["word"][described[0], 0], np.float32(-99)]
    scores = own_prior[ids].max(1)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        if epoch % 4 == 0 and epoch:
            table = np.concatenate([net.projected(net.inputs(described)), np.zeros((1, 6 * UNITS), np.float32)])
            scores = np.concatenate([net.forward(table, ids[i : i + AT_ONCE], mask[i : i + AT_ONCE]) for i in range(0, len(ids), AT_ONCE)])
        order = np.lexsort((-scores, owner))
        speaks = order[first]
        others = rng.integers(0, len(ids), clean)
        others = others[y[owner[others]] == 0]
        chosen = np.concatenate([speaks, others])
        rng.shuffle(chosen)
        for i in range(0, len(chosen), BATCH):
            part = chosen[i : i + BATCH]
            own, where = np.unique(ids[part], return_inverse=True)
            own = own[own >= 0]
            where = where.reshape(len(part), -1) - (len(np.unique(ids[part])) - len(own))  # padding becomes -1
            target = y[owner[part]]
            weight = np.where(target > 0, len(chosen) / max(1, 2 * toxic), len(chosen) / max(1, 2 * (len(chosen) - toxic))).astype(np.float32)
            sub = _subset(described, own)
            g = net.gradients(sub, where, mask[part], target, weight)
            step += 1
            rate = RATE * (1 - step / (epochs * (len(chosen) // BATCH + 1) + 1)) + 1e-4
            for k, value in g.items():
                m, v = moments[k]
                m += 0.1 * (value - m)
                v += 0.01 * (value * value - v)
                net.p[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def _subset(described, own: np.ndarray):
    rows, flat, owner, sizes = described
    starts = np.searchsorted(owner, own)
    lengths = np.searchsorted(owner, own, side="right") - starts
    at = np.repeat(starts - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum())
    return rows[own], flat[at], np.repeat(np.arange(len(own)), lengths), sizes[own]


def _pad(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    ids = np.full((len(rows), WINDOW), -1, dtype=np.int64)
    for i, r in enumerate(rows):
        ids[i, : len(r)] = r
    return ids, (ids >= 0).astype(np.float32)


class Scorer:
    """Scores texts, keeping the projected inputs of up to KNOWN_WORDS words."""

    def __init__(self, net: Network) -> None:
        self.net, self.place, self.table = net, {}, np.zeros((1, 6 * UNITS), np.float32)

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.place]
        if len(self.place) + len(new) > KNOWN_WORDS:
            self.place, self.table, new = {}, self.table[:1], list(words)
        at = len(self.table)
        self.place |= {w: at + i for i, w in enumerate(new)}
        self.table = np.concatenate([self.table, self.net.projected(self.net.inputs(self.net.describe(new)))])

    def scores(self, texts: list[str]) -> np.ndarray:
        split = [words_of(t) for t in texts]
        self._learn({w for own in split for w in own})
        place = self.place
        flat = np.array([place[w] for own in split for w in own], dtype=np.int64)
        sizes = np.array([len(own) for own in split], dtype=np.int64)
        bases = np.r_[0, np.cumsum(sizes)[:-1]]
        counts = np.maximum(1, -(-(sizes - WINDOW + STRIDE) // STRIDE))
        owner = np.repeat(np.arange(len(texts)), counts)
        nth = np.arange(len(owner)) - np.repeat(np.r_[0, np.cumsum(counts)[:-1]], counts)
        begin = nth * STRIDE
        best = np.full(len(texts), -np.inf, np.float32)
        for i in range(0, len(owner), AT_ONCE):
            o, b = owner[i : i + AT_ONCE], begin[i : i + AT_ONCE]
            inside = b[:, None] + np.arange(WINDOW) < sizes[o][:, None]
            at = np.where(inside, (bases[o] + b)[:, None] + np.arange(WINDOW), 0)
            ids = np.where(inside, flat[at] if len(flat) else 0, 0)
            np.maximum.at(best, o, self.net.forward(self.table, ids, inside.astype(np.float32)))
        return _sigmoid(best.astype(np.float64))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, longest: int = LONGEST) -> Network | float:
    """A network for at most ``sample`` labelled documents of each label, or the share of toxic labels where there is only one.

    Of a text of more than ``longest`` characters so many are learned from, in parts spread evenly over the whole of it.
    """
    known = labels.filter(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    order = [F.xxhash64("_id"), F.col("_id")]
    picked = known.filter("_y = 1").orderBy(*order).limit(sample).unionByName(known.filter("_y = 0").orderBy(*order).limit(sample))
    # at most 2 * sample rows of an id and a label
    size, part = F.length("_text"), longest // PARTS
    drawn = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda i: F.substr(F.col("_text"), F.floor(i * (size - part) / (PARTS - 1)).cast("int") + 1, F.lit(part))), " ")
    rows = docs.select(F.col(id_col).alias("_doc"), text_of(text_col).alias("_text")).join(F.broadcast(picked), F.col("_doc") == F.col("_id"))
    rows = rows.withColumn("_text", F.when(size <= longest, F.col("_text")).otherwise(drawn))
    held = sorted((r["_doc"], r["_text"], r["_y"]) for r in rows.select("_doc", "_text", "_y").collect())
    net = train([t for _, t, _ in held], [y for _, _, y in held])
    return net if net is not None else (sum(y for _, _, y in held) / len(held) if held else 0.0)


def score(docs: DataFrame, model: Network | float, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score: the whole text of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if isinstance(model, Network) else None
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                found = scorer.scores(part.column(1).to_pylist()) if scorer else np.full(part.num_rows, float(model))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
