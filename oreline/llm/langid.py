"""Language identification of words in code-switched text by a linear-chain conditional random field.

A word's emission scores come from hashed prefixes, suffixes and character n-grams and from lexicons learned per label; learned
transition scores join neighbouring words. Forward-backward gives each word's label probabilities, in NumPy over many texts
at once: texts are cut into segments whose transfer matrices are multiplied along each text, so a chain of any length is
exact and still vectorised. Emissions depend on the word alone, so each distinct word is scored once a worker.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, of_worker, with_text


def _letters_and_marks() -> str:
    """The ranges of a character class of all letters and combining marks: vowel signs belong to the word they stand in."""
    inside, out, start = False, [], 0
    for i in range(sys.maxunicode + 2):
        now = i <= sys.maxunicode and unicodedata.category(chr(i))[0] in "LM"
        if now and not inside:
            start = i
        elif inside and not now:
            out.append(f"\\U{start:08x}-\\U{i - 1:08x}")
        inside = now
    return "".join(out)


WORD = re.compile(f"[{_letters_and_marks()}]+")
SEGMENT = 128
#: Namespaces of the hashed features: (seed, kind, characters).
AFFIXES = [(101 + n, side, n) for side in ("prefix", "suffix") for n in (1, 2, 3, 4)]
AFFIXES = [(seed + 50 * (side == "suffix"), side, n) for seed, side, n in AFFIXES]
NGRAMS = [(301, 2), (302, 3)]


@dataclass
class Model:
    """weights: a row for each hashed feature, then one for each label's lexicon, then a bias; transitions: from, to."""

    labels: list[str]
    bits: int
    lexicon_keys: np.ndarray
    lexicon_labels: np.ndarray
    weights: np.ndarray
    transitions: np.ndarray


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def features(words: list[str], bits: int, keys: np.ndarray, key_labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word, feature) of every feature that fires."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    shift, out = np.uint64(64 - bits), []

    def polynomial(at: np.ndarray, n: int, seed: int) -> np.ndarray:
        h = np.full(len(at), seed, np.uint64)
        for i in range(n):
            h = _mix(h * np.uint64(0x100000001B3) + codes[at + i])
        return h

    for seed, side, n in AFFIXES:
        who = np.flatnonzero(sizes >= n)
        at = starts[who] + (sizes[who] - n if side == "suffix" else 0)
        out.append((who, _mix(polynomial(at, n, seed)) >> shift))
    for seed, n in NGRAMS:
        inside = np.flatnonzero(np.arange(len(codes)) + n <= (starts + sizes)[owner])
        out.append((owner[inside], _mix(polynomial(inside, n, seed)) >> shift))
    if len(keys):
        whole = word_keys(words)
        at = np.minimum(np.searchsorted(keys, whole), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == whole)
        out.append((hit, (1 << bits) + key_labels[at[hit]]))
    return np.concatenate([x for x, _ in out]), np.concatenate([y.astype(np.int64) for _, y in out])


def word_keys(words: list[str]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.array([xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)


def emissions(model: Model, words: list[str]) -> np.ndarray:
    """Scores of each word and label; the label scores of letterless words are marked as not a number."""
    out = np.empty((len(words), len(model.labels)))
    for i in range(0, len(words), 20_000):
        some = words[i : i + 20_000]
        who, which = features(some, model.bits, model.lexicon_keys, model.lexicon_labels)
        for k in range(out.shape[1]):
            out[i : i + len(some), k] = np.bincount(who, model.weights[which, k], len(some)) + model.weights[-1, k]
        for j, w in enumerate(some):
            if not w.isalpha() and not any(map(str.isalpha, w)):
                out[i + j] = np.nan
    return out


def forward_backward(scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Label probabilities of each word. scores: the emissions of all texts in a row; sizes: words of each text."""
    n_labels = scores.shape[1]
    step = np.exp(transitions - transitions.max())
    local = np.exp(scores - scores.max(axis=1, keepdims=True))
    counts = -(-sizes // SEGMENT)
    text_of = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    first = (np.cumsum(sizes) - sizes)[text_of] + nth * SEGMENT
    length = np.minimum(sizes[text_of] - nth * SEGMENT, SEGMENT)
    by = np.argsort(-length, kind="stable")  # at each step the segments that still run stand in front
    first, length = first[by], length[by]
    running = np.searchsorted(-length, -np.arange(1, SEGMENT + 1), side="right")
    m = len(by)
    transfer = np.tile(np.eye(n_labels), (m, 1, 1))
    for t in range(length[0] if m else 0):
        k = running[t]
        x = (transfer[:k].reshape(-1, n_labels) @ step).reshape(k, n_labels, n_labels) * local[first[:k] + t][:, None, :]
        transfer[:k] = x / x.sum(axis=(1, 2), keepdims=True)
    place = np.empty(m, np.int64)
    place[by] = np.arange(m)  # of the segments in text order
    base = np.cumsum(counts) - counts
    into, after = np.full((m, n_labels), 1.0 / n_labels), np.ones((m, n_labels))
    for j in range(1, counts.max() if m else 0):
        some = np.flatnonzero(counts > j)
        a, b = place[base[some] + j - 1], place[base[some] + j]
        x = np.einsum("ni,nij->nj", into[a], transfer[a])
        into[b] = x / x.sum(axis=1, keepdims=True)
    for j in range((counts.max() if m else 0) - 2, -1, -1):
        some = np.flatnonzero(counts > j + 1)
        a, b = place[base[some] + j], place[base[some] + j + 1]
        x = np.einsum("nij,nj->ni", transfer[b], after[b])
        after[a] = x / x.sum(axis=1, keepdims=True)
    out = np.empty_like(local)
    alpha = into
    for t in range(length[0] if m else 0):
        k = running[t]
        x = (alpha[:k] @ step) * local[first[:k] + t]
        alpha[:k] = x / x.sum(axis=1, keepdims=True)
        out[first[:k] + t] = alpha[:k]
    beta = after
    for t in range((length[0] if m else 0) - 1, -1, -1):
        k = running[t]
        out[first[:k] + t] *= beta[:k]
        x = (beta[:k] * local[first[:k] + t]) @ step.T
        beta[:k] = x / x.sum(axis=1, keepdims=True)
    return out / out.sum(axis=1, keepdims=True)


def _sequences(texts: list[list[str]], labels: list[int], n_labels: int, length: int, seed: int, most: int) -> tuple[list[list[str]], np.ndarray]:
    """Code-switched training sequences of as many words as the texts have, ``most`` at the most: runs of words from anywhere in
    one whole text, then in another, of random lengths."""
    rng = np.random.default_rng(seed)
    by_label = [[t for t, y in zip(texts, labels) if y == k and t] for k in range(n_labels)]
    usable = [k for k in range(n_labels) if by_label[k]]
    total = sum(len(t) for group in by_label for t in group)
    words, tags = [], []
    for _ in range(max(1, min(total, most) // length)):
        seq, tag, k = [], [], int(rng.choice(usable))
        while len(seq) < length:
            source = by_label[k][int(rng.integers(len(by_label[k])))]
            n = 1 + int(rng.geometric(1 / 20))
            at = int(rng.integers(max(1, len(source) - n + 1)))
            run = source[at : at + n][: length - len(seq)]
            seq += run
            tag += [k] * len(run)
            k = int(rng.choice(usable))
        words.append(seq)
        tags.append(tag)
    return words, np.array(tags)


def train(texts: list[str], langs: list[str], bits: int = 18, rounds: int = 40, length: int = 64, l2: float = 1e-4, seed: int = 7, most_words: int = 400_000) -> Model:
    """Fits the field by full-batch Adam on the conditional log-likelihood of code-switched sequences made of the texts.

    ``most_words`` bounds the sequences' words and so the driver's memory; lexicons are counted over the whole texts."""
    labels = sorted(set(langs))
    once: dict[str, str] = {}  # a word is one object however often it stands
    tokens = [[once.setdefault(w, w) for w in WORD.findall(t.lower())] for t in texts]
    y = [labels.index(x) for x in langs]
    n = len(labels)
    per = [Counter() for _ in labels]
    for ws, k in zip(tokens, y):
        per[k].update(ws)
    lexicon = sorted((w, k) for k, held in enumerate(per) for w, c in held.items() if c >= 3 and c >= 0.8 * sum(other[w] for other in per))
    del per
    keys = word_keys([w for w, _ in lexicon])
    order = np.argsort(keys)
    keys, key_labels = keys[order], np.array([k for _, k in lexicon], np.int64)[order]
    model = Model(labels, bits, keys, key_labels, np.zeros(((1 << bits) + n + 1, n)), np.zeros((n, n)))
    if n == 1 or not any(tokens):
        model.weights = model.weights.astype(np.float32)
        return model

    seqs, tags = _sequences(tokens, y, n, length, seed, most_words)
    del tokens, once
    index: dict[str, int] = {}
    ids = np.array([[index.setdefault(w, len(index)) for w in s] for s in seqs]).ravel()
    who, which = features(list(index), bits, keys, key_labels)
    used, column = np.unique(which, return_inverse=True)
    w = np.zeros((len(used) + 1, n))  # the last is the bias
    trans = np.zeros((n, n))
    gold = np.eye(n)[tags.ravel()]
    gold_trans = np.array([[np.sum((tags[:, :-1] == a) & (tags[:, 1:] == b)) for b in range(n)] for a in range(n)], float)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(trans), np.zeros_like(trans)]
    batch, n_words = len(seqs), ids.size
    del seqs
    for it in range(1, rounds + 1):
        word_scores = np.stack([np.bincount(who, w[column, k], len(index)) for k in range(n)], axis=1) + w[-1]
        e = word_scores[ids].reshape(batch, length, n)
        local, step = np.exp(e - e.max(axis=2, keepdims=True)), np.exp(trans - trans.max())
        alpha, beta = np.empty_like(local), np.ones_like(local)
        a = np.full((batch, n), 1.0 / n)
        for t in range(length):
            a = (a @ step) * local[:, t]
            a /= a.sum(axis=1, keepdims=True)
            alpha[:, t] = a
        for t in range(length - 2, -1, -1):
            b = (beta[:, t + 1] * local[:, t + 1]) @ step.T
            beta[:, t] = b / b.sum(axis=1, keepdims=True)
        post = alpha * beta
        post /= post.sum(axis=2, keepdims=True)
        pairs = np.zeros((n, n))
        for t in range(length - 1):
            pair = alpha[:, t, :, None] * step * (local[:, t + 1] * beta[:, t + 1])[:, None, :]
            pairs += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        missing = gold - post.reshape(-1, n)
        by_word = np.stack([np.bincount(ids, missing[:, k], len(index)) for k in range(n)], axis=1)
        gw = np.empty_like(w)
        for k in range(n):
            gw[:-1, k] = np.bincount(column, by_word[who, k], len(used))
        gw[-1] = by_word.sum(axis=0)
        gw = gw / n_words - l2 * w / len(used) ** 0.5
        gt = (gold_trans - pairs) / n_words - l2 * trans
        for p, g, i in ((w, gw, 0), (trans, gt, 2)):
            state[i] = 0.9 * state[i] + 0.1 * g
            state[i + 1] = 0.99 * state[i + 1] + 0.01 * g * g
            p += 0.1 * (state[i] / (1 - 0.9**it)) / (np.sqrt(state[i + 1] / (1 - 0.99**it)) + 1e-8)
    model.weights[used], model.weights[-1], model.transitions = w[:-1], w[-1], trans
    model.weights = model.weights.astype(np.float32)
    return model


class Tagger:
    """A model with a memory of word scores of about ``most`` bytes."""

    def __init__(self, model: Model, most: int = 40 << 20):
        self.model, self.most = model, most
        self._restart()

    def _restart(self) -> None:
        self.index: dict[str, int] = {}
        self.scores, self.n, self.room = np.empty((16_384, len(self.model.labels))), 0, self.most

    def tag(self, texts: list[str]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
        """Words with a letter of each text, label probabilities of all words in a row, words of each text."""
        if self.room < 0:
            self._restart()
        found = [WORD.findall(t.lower()) for t in texts]
        index = self.index
        new = list({w for ws in found for w in ws if w not in index})
        if new:
            if self.n + len(new) > len(self.scores):
                self.scores = np.concatenate([self.scores[: self.n], np.empty((max(len(new), len(self.scores)), self.scores.shape[1]))])
            self.scores[self.n : self.n + len(new)] = emissions(self.model, new)
            index.update(zip(new, range(self.n, self.n + len(new))))
            self.n += len(new)
            self.room -= (150 + 16 * self.scores.shape[1]) * len(new) + 2 * sum(map(len, new))
        sizes = np.array([len(ws) for ws in found], np.int64)
        ids = np.fromiter((i for ws in found for i in map(index.__getitem__, ws)), np.int64, int(sizes.sum()))
        scores = self.scores[ids]
        letters = ~np.isnan(scores[:, 0])
        if not letters.all():
            found = [[w for w in ws if any(map(str.isalpha, w))] for ws in found]
            sizes, scores = np.array([len(ws) for ws in found], np.int64), scores[letters]
        return found, forward_backward(scores, sizes, self.model.transitions), sizes

    def label_words(self, text: str) -> list[tuple[str, str, float]]:
        """(word, label, probability) of each word of a text."""
        words, p, _ = self.tag([text])
        best = p.argmax(axis=1)
        return [(w, self.model.labels[k], float(p[i, k])) for i, (w, k) in enumerate(zip(words[0], best))]

    def label_texts(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Label, score, words and label switches of each text. The label has most probability over the text's letters; the score is its share of them."""
        words, p, sizes = self.tag(texts)
        weight = np.fromiter((len(w) for ws in words for w in ws), float, int(sizes.sum()))
        owner = np.repeat(np.arange(len(texts)), sizes)
        mass = np.stack([np.bincount(owner, p[:, k] * weight, len(texts)) for k in range(p.shape[1])], axis=1)
        total = mass.sum(axis=1)
        best = mass.argmax(axis=1)
        top = p.argmax(axis=1)
        switch = (top[1:] != top[:-1]) & (owner[1:] == owner[:-1])
        switches = np.bincount(owner[1:][switch], minlength=len(texts))
        labels = [self.model.labels[k] if t > 0 else "und" for k, t in zip(best.tolist(), total.tolist())]
        share = np.minimum(1.0, mass.max(axis=1) / np.where(total > 0, total, 1.0))
        return labels, share, sizes, switches


def in_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, docs_a_label: int = 400, most_docs: int = 20_000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Trains on a bounded sample of the labelled rows that are not held out: of each label the ``docs_a_label`` whole documents of
    the least hash, fewer if all labels together would pass ``most_docs``. Labels beyond ``most_docs`` are an error. None if there
    is no labelled row. Null texts, null labels and ``und`` teach nothing; repeated rows may each be in the sample."""
    rows = docs.filter(~in_held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.col(lang_col) != "und"))
    rows = rows.select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col), F.lit(5)).alias("h"), F.col(text_col).alias("text"))
    n_labels = rows.select("lang").distinct().count()
    if n_labels > most_docs:
        raise ValueError(f"{n_labels} labels, more than the sample's {most_docs} documents")
    if not n_labels:
        return None
    w = Window.partitionBy("lang").orderBy("h", "text")
    sample = rows.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= min(docs_a_label, most_docs // n_labels)).orderBy("lang", "n").collect()
    sample = [r for r in sample if WORD.search(r["text"])]
    return train([r["text"] for r in sample], [r["lang"] for r in sample]) if sample else None


def identify_languages(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", whole_rows: bool = False) -> DataFrame:
    """Labels every whole text: id_col, held_out, lang_pred, score, n_words, n_switches (label changes between neighbouring words).

    A word is a run of letters and combining marks. Null texts, texts without a letter, and all texts if there is no model are ``und`` with score 0. A null id counts as the
    empty text for held_out. Repeated rows give repeated results, ties go to the label that sorts first, an empty table gives
    no rows. Other columns take no part; with ``whole_rows`` the input's row comes along as the struct ``doc``.
    Language, source and id are never read for a prediction.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by 2**bits and the number of labels
    run_id = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = of_worker(("tagger", run_id), lambda: Tagger(shared.value)) if shared.value else None
        for batch in blocks(with_text(batches, "doc", text_col), "text"):
            n = batch.num_rows
            texts = [t or "" for t in batch["text"].to_pylist()]
            labels, score, words, switches = tagger.label_texts(texts) if tagger else (["und"] * n, np.zeros(n), np.zeros(n, int), np.zeros(n, int))
            yield pa.RecordBatch.from_arrays(
                [batch["doc"] if whole_rows else pa.StructArray.from_arrays([pc.struct_field(batch["doc"], id_col)], [id_col]), batch["held_out"], pa.array(labels, pa.string()), pa.array(score, pa.float64()), pa.array(words, pa.int64()), pa.array(switches, pa.int64())],
                ["doc", "held_out", "lang_pred", "score", "n_words", "n_switches"],
            )

    carried = F.struct("*") if whole_rows else F.struct(F.col(id_col), F.col(text_col))
    rows = docs.select(carried.alias("doc"), in_held_out(F.col(id_col)).alias("held_out"))
    schema = (rows.select("doc", "held_out") if whole_rows else rows.select(F.struct(F.col("doc")[id_col].alias(id_col)).alias("doc"), "held_out")).schema.add("lang_pred", "string").add("score", "double").add("n_words", "long").add("n_switches", "long")
    out = rows.mapInArrow(run, schema)
    return out if whole_rows else out.select(F.col("doc")[id_col].alias(id_col), "held_out", "lang_pred", "score", "n_words", "n_switches")
