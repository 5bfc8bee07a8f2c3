"""Language identification with a linear-chain conditional random field (operator 6).

Each word is labelled with a language.  A word's score for a language sums the learned weights of
its byte n-grams, of its affixes (n-grams that hold the word's border) and of its lexicon class;
transitions between neighbouring words are learned with them.  Forward-backward gives every word
its marginal probabilities, also in code-switched text; a document gets the language with the
highest mean marginal.

The model is fitted on the driver, on a bounded sample of labelled rows (FIT_DOCS per language, and of a
text with more than FIT_CHARS characters as many in FIT_PIECES runs spread over all of it).  Prediction
is one pass over the whole texts without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import Words, byte_table, mix64, slices, texts
from .labels import held_out, sample, sampled_texts

#: Bound of the training sample: rows of a language, languages (the most frequent), and characters of a row, in
#: so many runs spread over all of it.
FIT_DOCS, FIT_LANGS, FIT_CHARS, FIT_PIECES = 300, 200, 8000, 8
#: Most words of a training chain, half of them from each of two documents so that chains switch.
CHAIN = 48
#: Least runs of CHAIN / 2 words that an epoch draws of a row that has them; all are drawn over the epochs.
RUNS = 6
#: Bytes of a word; longer ones, as of scripts without blanks, are cut into pieces (32 CJK characters).
LONGEST = 96
EPOCHS, RATE = 6, 0.3
#: Hashed n-gram weights; words of the sample seen at least twice form the lexicon.
DIMS = 1 << 18
#: Words per block of the chain recursion, and numbers that are worked on at a time.
BLOCK, WORKING = 128, 1 << 21

UNKNOWN = "und"
#: Columns that labelling adds.
FOUND = {"lang_pred": T.StringType(), "score": T.DoubleType(), "n_letter_words": T.LongType(), "n_switched": T.LongType()}


def _word_table() -> np.ndarray:
    t = byte_table("alnum")
    t[0x30:0x3A] = 0
    return t


def _letters(words: Words, which: np.ndarray) -> list[str]:
    """The letters of words, folded; empty for words without a letter."""
    out = []
    for a, b in zip(words.start[which], words.end[which]):
        w = words.data[a:b].tobytes().decode(errors="ignore").lower()
        out.append(w if w.isalpha() else "".join(c for c in w if c.isalpha()))
    return out


def _ngrams(plain: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words and the place of each word's first: 2- to 4-grams of the bytes
    of ``^word$``, so prefixes and suffixes are features of their own."""
    data = np.frombuffer(("".join(f"^{w}$" for w in plain)).encode(), np.uint8).astype(np.uint64)
    size = np.array([len(w.encode()) + 2 for w in plain], np.int64)
    ends = np.cumsum(size)
    word = np.repeat(np.arange(len(plain)), size)
    feats, owner, gram = [], [], data
    for n in (2, 3, 4):
        gram = gram[:-1] * np.uint64(257) + data[n - 1:]
        own = word[:len(gram)]
        inside = np.arange(len(gram)) + n <= ends[own]
        feats.append((mix64(gram[inside] + np.uint64(n << 40)) % np.uint64(DIMS)).astype(np.int64))
        owner.append(own[inside])
    feats, owner = np.concatenate(feats), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return feats[order], np.searchsorted(owner[order], np.arange(len(plain)))


def _emissions(weights: np.ndarray, feats: np.ndarray, first: np.ndarray) -> np.ndarray:
    if not len(first):
        return np.zeros((0, weights.shape[1]), np.float32)
    return np.add.reduceat(weights[feats], first, axis=0)  # every ^word$ has a 2-gram


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray     # DIMS x languages
    lexicon: np.ndarray     # sorted hashes of the lexicon's words
    lex_class: np.ndarray   # class of each: its language if nearly always so, else 0
    lex_weights: np.ndarray  # class x languages
    transitions: np.ndarray

    def emissions(self, plain: list[str]) -> np.ndarray:
        e = _emissions(self.weights, *_ngrams(plain)) if plain else np.zeros((0, len(self.langs)), np.float32)
        return e + self.lex_weights[self.classes(plain)]

    def classes(self, plain: list[str]) -> np.ndarray:
        h = _hashes(plain)
        if not len(self.lexicon):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, h), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == h, self.lex_class[at], 0)


def _hashes(plain: list[str]) -> np.ndarray:
    if not plain:
        return np.zeros(0, np.uint64)
    w = Words(*texts(pa.array(plain, pa.large_string())), byte_table("alnum"))
    out = np.zeros(len(plain), np.uint64)
    some = np.diff(w.first) > 0
    out[some] = w.hash[w.first[:-1][some]]
    return out


def _softmax(x: np.ndarray, axis: int = -1) -> np.ndarray:
    e = np.exp(x - x.max(axis=axis, keepdims=True))
    return e / e.sum(axis=axis, keepdims=True)


def fit(rows: list[tuple[str, str]], seed: int = 7) -> Model:
    """Fit on (language, text) rows by minibatch gradient steps on the chains' log-likelihood.

    Rows of any length teach the chain, with all their words; a language none of whose rows has a
    letter is none of the model's.  (``train`` gives it excerpts of long rows.)
    """
    langs = sorted({lang for lang, _ in rows})
    if not langs:
        nothing = np.zeros((0, 0), np.float32)
        return Model([], nothing, np.zeros(0, np.uint64), np.zeros(0, np.int64), nothing, nothing)
    words = Words(*texts(pa.array([t for _, t in rows], pa.large_string())), _word_table(), LONGEST)
    distinct, sample_, which = np.unique(words.hash, return_index=True, return_inverse=True)
    plain = _letters(words, sample_)
    lettered = np.array([bool(p) for p in plain], bool)
    owns = [which[lo:hi][lettered[which[lo:hi]]] for lo, hi in zip(words.first[:-1], words.first[1:])]
    langs = sorted({lang for (lang, _), own in zip(rows, owns) if len(own)})
    if not langs:  # no labelled row has a letter
        return fit([])
    rng, label = np.random.default_rng(seed), {x: i for i, x in enumerate(langs)}
    of_row = np.repeat([label.get(x, 0) for x, _ in rows], np.diff(words.first))
    # each row's runs of up to CHAIN / 2 words, in random order
    runs_of = [([own[i:i + CHAIN // 2] for i in range(0, len(own), CHAIN // 2)], label[lang])
               for (lang, _), own in zip(rows, owns) if len(own)]
    runs_of = [([runs[i] for i in rng.permutation(len(runs))], lang) for runs, lang in runs_of]
    n_lang, seen = len(langs), np.zeros((len(distinct), len(langs)))
    np.add.at(seen, (which, of_row), 1)
    in_lexicon = (seen.sum(axis=1) >= 2) & lettered
    main = seen.argmax(axis=1)
    cls = np.where(in_lexicon & (seen.max(axis=1) >= 0.9 * seen.sum(axis=1)), main + 1, 0)
    hashes = _hashes(plain)
    order = np.argsort(hashes)
    order = order[cls[order] > 0]
    model = Model(langs, np.zeros((DIMS, n_lang), np.float32), hashes[order], cls[order],
                  np.zeros((n_lang + 1, n_lang), np.float32), np.zeros((n_lang, n_lang), np.float32))
    if n_lang < 2:
        return model
    feats, first = _ngrams(plain)
    spread = np.diff(np.append(first, len(feats)))
    g2 = [np.full(a.shape, 1e-6, np.float32) for a in (model.weights, model.lex_weights, model.transitions)]
    for epoch in range(EPOCHS):
        runs = []
        for own, lang in runs_of:
            n = min(len(own), max(RUNS, -(-len(own) // EPOCHS)))
            runs += [(own[(epoch * n + i) % len(own)], lang) for i in range(n)]
        perm, other = rng.permutation(len(runs)), rng.permutation(len(runs))
        for at in range(0, len(runs), 64):
            pairs = [(runs[i], runs[j] if k % 2 else runs[i]) for k, (i, j) in enumerate(zip(perm[at:at + 64], other[at:at + 64]))]
            size = np.array([len(a[0]) + len(b[0]) for a, b in pairs])
            live = np.arange(size.max()) < size[:, None]
            x = np.zeros(live.shape, np.int64)
            x[live] = np.concatenate([r for a, b in pairs for r in (a[0], b[0])])
            x = np.where(live, x, x[:, :1])  # shorter chains are filled up, and masked
            y = np.zeros(live.shape, np.int64)
            y[live] = np.repeat([r[1] for pair in pairs for r in pair], [len(r[0]) for pair in pairs for r in pair])
            used, back = np.unique(x, return_inverse=True)
            back = back.reshape(x.shape)
            take = np.concatenate([np.arange(first[u], first[u] + spread[u]) for u in used])
            e = _emissions(model.weights, feats[take], np.concatenate([[0], np.cumsum(spread[used])[:-1]]))
            e = (e + model.lex_weights[cls[used]])[back]
            marginals, joint = _chains(e, model.transitions, live)
            grad = (np.eye(n_lang, dtype=np.float32)[y] - marginals) * live[:, :, None]
            per_word = np.zeros((len(used), n_lang), np.float32)
            np.add.at(per_word, back.ravel(), grad.reshape(-1, n_lang))
            trans = -joint
            np.add.at(trans, (y[:, :-1][live[:, 1:]], y[:, 1:][live[:, 1:]]), 1)
            touched, slot = np.unique(feats[take], return_inverse=True)
            gw = np.zeros((len(touched), n_lang), np.float32)
            np.add.at(gw, slot, np.repeat(per_word, spread[used], axis=0))
            gl = np.zeros_like(model.lex_weights)
            np.add.at(gl, cls[used], per_word)
            scale = 1 / len(pairs)
            for weights, acc, rows_, g in ((model.weights, g2[0], touched, gw * scale),
                                           (model.lex_weights, g2[1], slice(None), gl * scale),
                                           (model.transitions, g2[2], slice(None), trans * scale)):
                acc[rows_] += g * g
                weights[rows_] += RATE * g / np.sqrt(acc[rows_])
                weights[rows_] *= 1 - 1e-4
    return model


def _chains(e: np.ndarray, transitions: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of chains and the expected transition counts (training); live: words of each chain,
    the others are filling at its end."""
    x, a = np.exp(e - e.max(axis=2, keepdims=True)), np.exp(transitions - transitions.max())
    alpha, beta = np.empty_like(x), np.ones_like(x)
    now = x[:, 0] / x[:, 0].sum(axis=1, keepdims=True)
    alpha[:, 0] = now
    for t in range(1, x.shape[1]):
        now = (now @ a) * x[:, t]
        now /= now.sum(axis=1, keepdims=True)
        alpha[:, t] = now
    joint = np.zeros_like(a)
    for t in range(x.shape[1] - 2, -1, -1):
        ahead = x[:, t + 1] * beta[:, t + 1]
        pair = alpha[:, t][:, :, None] * a[None] * ahead[:, None, :]
        joint += (pair / pair.sum(axis=(1, 2), keepdims=True))[live[:, t + 1]].sum(axis=0)
        now = ahead @ a.T
        beta[:, t] = np.where(live[:, t + 1, None], now / now.sum(axis=1, keepdims=True), 1)
    gamma = alpha * beta
    return gamma / gamma.sum(axis=2, keepdims=True), joint


def marginals(e: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Marginals of chains of any length (chain i: rows first[i] to first[i + 1]), exactly.

    Chains are taken by length, as many at a time as keep WORKING numbers within bounds: short ones
    in narrow blocks, so memory follows words and languages, not the number of texts.
    """
    length, n = np.diff(first), e.shape[1]
    out = np.empty((len(e), n))
    order = np.argsort(length, kind="stable")
    order = order[length[order] > 0]
    width = np.minimum(length[order], BLOCK)
    cost = -(-length[order] // width) * (3 * n * n + width * n)
    lo = 0
    while lo < len(order):
        # a chain's blocks are as wide as the widest of its group
        upto = np.cumsum(cost[lo:lo + WORKING])
        hi = lo + max(1, int(np.searchsorted(upto, WORKING, side="right")))
        hi = lo + max(1, int(np.searchsorted(width[lo:hi], 2 * width[lo], side="right")))
        chains = order[lo:hi]
        size = length[chains]
        rows = np.repeat(first[chains] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out[rows] = _marginals(e[rows], np.concatenate([[0], np.cumsum(size)]), transitions, int(width[hi - 1]))
        lo = hi
    return out


def _marginals(e: np.ndarray, first: np.ndarray, transitions: np.ndarray, block: int) -> np.ndarray:
    """Chains are cut into blocks.  Each block's transfer matrix is formed for all blocks at once,
    the matrices are chained, and a second sweep fills in the words: the number of numpy steps is
    that of a block, not that of the longest text.
    """
    n = e.shape[1]
    a = np.exp(transitions - transitions.max()).astype(np.float64)
    length = np.diff(first)
    blocks = -(-length // block)
    base = np.concatenate([[0], np.cumsum(blocks)])
    chain = np.repeat(np.arange(len(length)), length)
    at = np.arange(len(e)) - first[chain]
    row, col = base[chain] + at // block, at % block
    x = np.ones((base[-1], block, n))
    x[row, col] = np.exp(e - e.max(axis=1, keepdims=True))
    live = np.zeros((base[-1], block), bool)
    live[row, col] = True
    width = live.sum(axis=1).max(initial=0)
    through = np.broadcast_to(np.eye(n), (base[-1], n, n)).copy()
    for t in range(width):
        step = (through @ a) * x[:, t, None, :]
        step /= step.sum(axis=(1, 2), keepdims=True)
        through = np.where(live[:, t, None, None], step, through)
    enter, leave = np.full((base[-1], n), 1 / n), np.ones((base[-1], n))
    for depth in range(1, blocks.max(initial=0)):
        here = base[:-1][blocks > depth] + depth
        v = np.einsum("bi,bij->bj", enter[here - 1], through[here - 1])
        enter[here] = v / v.sum(axis=1, keepdims=True)
        there = base[1:][blocks > depth] - 1 - depth
        v = np.einsum("bij,bj->bi", through[there + 1], leave[there + 1])
        leave[there] = v / v.sum(axis=1, keepdims=True)
    out, now = np.empty_like(x), enter
    for t in range(width):
        step = (now @ a) * x[:, t]
        now = np.where(live[:, t, None], step / step.sum(axis=1, keepdims=True), now)
        out[:, t] = now
    now = leave
    for t in range(width - 1, -1, -1):
        out[:, t] *= now
        step = (x[:, t] * now) @ a.T
        now = np.where(live[:, t, None], step / step.sum(axis=1, keepdims=True), now)
    found = out[row, col]
    return found / found.sum(axis=1, keepdims=True)


class Labeller:
    """A model and the emissions of the distinct words met so far, by their hash."""

    CACHE = 1 << 19

    def __init__(self, model: Model):
        self.model, self.table = model, _word_table()
        self.clear()

    def clear(self) -> None:
        self.keys, self.e = np.zeros(0, np.uint64), np.zeros((0, len(self.model.langs)), np.float32)
        self.is_word = np.zeros(0, bool)

    def label(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Word marginals of each text: (rows, first row of each text)."""
        words = Words(*texts(column), self.table, LONGEST)
        distinct, some, which = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.keys) > self.CACHE:
            self.clear()
        at = np.minimum(np.searchsorted(self.keys, distinct), max(0, len(self.keys) - 1))
        new = self.keys[at] != distinct if len(self.keys) else np.ones(len(distinct), bool)
        if new.any():
            plain = _letters(words, some[new])
            keys = np.concatenate([self.keys, distinct[new]])
            order = np.argsort(keys)
            self.keys = keys[order]
            self.e = np.concatenate([self.e, self.model.emissions(plain)])[order]
            self.is_word = np.concatenate([self.is_word, [bool(p) for p in plain]]).astype(bool)[order]
        index = np.searchsorted(self.keys, distinct)[which] if len(distinct) else np.zeros(0, np.int64)
        keep = self.is_word[index]
        first = np.concatenate([[0], np.cumsum(keep)])[words.first]
        return marginals(self.e[index[keep]], first, self.model.transitions), first


def _predict(batches, model: Model, text_col: str, prefix: str):
    labeller = Labeller(model)
    names = np.array([*model.langs, UNKNOWN], object)
    for whole in batches:
        for batch in slices(whole, text_col):
            if model.langs:
                p, first = labeller.label(batch.column(text_col))
            else:
                p, first = np.zeros((0, 1)), np.zeros(batch.num_rows + 1, np.int64)
            n = np.diff(first)
            mean = np.zeros((len(n), max(1, len(model.langs))))
            if len(p):
                total = np.concatenate([np.zeros((1, p.shape[1])), np.cumsum(p, axis=0)])
                mean = (total[first[1:]] - total[first[:-1]]) / np.maximum(n, 1)[:, None]
            best = np.where(n > 0, mean.argmax(axis=1), len(model.langs))
            score = np.clip(np.where(n > 0, mean.max(axis=1), 0.0), 0.0, 1.0)
            switched = np.zeros(len(n), np.int64)
            if len(p):
                own = p.argmax(axis=1)
                other = own != np.repeat(best, n)
                switched = np.diff(np.concatenate([[0], np.cumsum(other)])[first])
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(names[best], pa.string()), pa.array(score), pa.array(n), pa.array(switched)],
                [*batch.schema.names, *(f"{prefix}{c}" for c in FOUND)])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on at most FIT_DOCS rows of each of at most FIT_LANGS languages, none of them held out."""
    known = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(
        ~held_out("id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # one row of an id, so that the sample has the rows that it is bounded by
    ids = known.groupBy("id").agg(F.min("lang").alias("lang"))
    chosen = sample(ids, "id", "lang", FIT_DOCS, FIT_LANGS)
    of = chosen.withColumnRenamed("lang", "of")
    own = known.join(F.broadcast(of), "id").filter("lang = of").drop("of", "lang")
    rows = sampled_texts(own, chosen, "id", "text", FIT_CHARS, FIT_PIECES).orderBy("lang", "id").select("lang", "text")
    return fit([tuple(r) for r in rows.toLocalIterator()])


def label_documents(docs: DataFrame, model: Model, text_col: str = "text", prefix: str = "crf_") -> DataFrame:
    """``docs`` with the columns of FOUND, each name after ``prefix``; one pass, no shuffle."""
    fields = [T.StructField(f"{prefix}{c}", kind) for c, kind in FOUND.items()]
    return docs.mapInArrow(lambda it: _predict(it, model, text_col, prefix), T.StructType(docs.schema.fields + fields))


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """One row per document: ``id_col, held_out, lang_pred, score, n_letter_words, n_switched``.

    ``score`` is the mean marginal of the predicted language over the document's words, and
    ``n_switched`` counts the words whose likeliest language is another.  Words are runs of letters
    (of ASCII letters and characters over 127 with their other characters taken out); runs of more
    than LONGEST bytes, as in scripts without blanks, count as several words.

    Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text
    if no labelled row could be learned from; a null id is not held out; repeated rows are each
    predicted, alike; an empty table gives no row; other columns are ignored.
    """
    model = model or train(docs, id_col, text_col, lang_col)
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = label_documents(narrow, model)
    return found.select(F.col("id").alias(id_col), held_out("id").alias("held_out"),
                        *[F.col(f"crf_{c}").alias(c) for c in FOUND])


def reject_unidentified(docs: DataFrame, least: float = 0.3, model: Model | None = None,
                        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the documents that are ``und`` or whose language scores below ``least``.  Columns
    of any name stay as they are."""
    model = model or train(docs, id_col, text_col, lang_col)
    prefix = "crf_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    found = label_documents(docs, model, text_col, prefix)
    return found.filter((F.col(f"{prefix}lang_pred") != UNKNOWN) & (F.col(f"{prefix}score") >= least)).select(
        *[F.col(f"`{c}`") for c in docs.columns])
