"""Language identification by a linear-chain conditional random field over words.

Each word of a text is labelled with a language, so text that switches languages is followed word by word.  A word's
features are its affixes, its character n-grams and its place in a learned lexicon; transitions between the labels of
neighbours are learned too.  Training sequences are spans of labelled texts of several languages put one after the other.
Texts are labelled by forward-backward: segments of a fixed number of words are multiplied up side by side, chained
per text, and then filled in, which gives the exact marginals for a text of any length.
A text's language is the one with the largest expected number of words, its score that share of the words.

A text without a letter (also null or empty) is ``und`` with score 0; so is every text if nothing could be learned.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm.common import REMEMBERED_WORDS, WORD_BLOCK, WordNumbers, held_out, map_arrow, mix64, ranges, shared_table, table, text_blocks

UNKNOWN = "und"
BITS = 16
#: The labelled sample: so many texts a language in order of a hash of the id, of up to so many characters each.
SAMPLE_TEXTS, SAMPLE_CHARS = 250, 20_000
SEGMENT = 32
#: So many numbers (words x languages, or words x languages squared / 8) are worked on at once, whatever the length of the texts.
PIECE = 4_000_000
_PLAIN_WORDS = re.compile(r"[a-z]{1,48}")
_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]{0,47}\p{M}*+")


def words_of(text: str) -> list[str]:
    """Runs of letters and the marks on them (vowel signs, accents); one of more than 48 characters (a clause in a script without
    blanks) is cut into consecutive words of up to 48.  Number signs such as ``½`` or ``Ⅷ`` are no letters.
    """
    return (_PLAIN_WORDS if text.isascii() else _WORDS).findall(text.lower())


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # hashed affixes and n-grams x languages
    lexicon: dict[str, int]  # words that belong to one language
    lexicon_weights: np.ndarray  # lexicon entry (last: none) x languages
    transitions: np.ndarray
    bits: int


def word_features(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words, one after the other, and each word's number of features.

    Character bigrams and trigrams with word bounds, and prefixes and suffixes of one to three characters.
    """
    flat = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)

    def gram(at: np.ndarray, n: int, salt: int) -> np.ndarray:
        h = np.full(len(at), salt, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n):
                h = h * np.uint64(0x100000001B3) + flat[at + k]
            return mix64(h) >> np.uint64(64 - bits)

    features, owners = [], []
    for n in (2, 3):
        at = ranges(starts, np.maximum(sizes - n + 1, 0))
        features.append(gram(at, n, n))
        owners.append(owner[at])
    for n in (1, 2, 3):
        long = np.flatnonzero(sizes >= n + 2)
        for at, salt in ((starts[long] + 1, 10 + n), (starts[long] + sizes[long] - 1 - n, 20 + n)):
            features.append(gram(at, n, salt))
            owners.append(long)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(features)[order].astype(np.int64), np.bincount(owner, minlength=len(words))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of ``counts`` rows; every run has a row."""
    return np.add.reduceat(values, np.cumsum(counts) - counts, axis=0)


def emissions(words: list[str], model: Model) -> np.ndarray:
    """Scores word x language."""
    if not words:
        return np.zeros((0, len(model.languages)))
    features, counts = word_features(words, model.bits)
    none = len(model.languages)
    entry = np.fromiter((model.lexicon.get(w, none) for w in words), np.int64, len(words))
    return _sums(model.weights[features], counts) + model.lexicon_weights[entry]


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def _products(emit: np.ndarray, step: np.ndarray, at: list[np.ndarray], live: list[np.ndarray]) -> np.ndarray:
    """The product of the step matrices of each segment, scaled."""
    k = len(step)
    product = np.broadcast_to(np.eye(k), (len(at[0]), k, k))
    for t in range(SEGMENT):
        after = (product @ step) * emit[at[t]][:, None, :]
        after /= after.sum(axis=(1, 2), keepdims=True)
        product = np.where(live[t][:, :, None], after, product)
    return product


def before_piece(scores: np.ndarray, transitions: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The backward vector before a piece of one text, from the one behind it."""
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    first = np.arange(0, len(scores), SEGMENT)
    size = np.minimum(len(scores) - first, SEGMENT)
    at = [first + np.minimum(t, size - 1) for t in range(SEGMENT)]
    product = _products(emit, np.exp(transitions - transitions.max()), at, [(t < size)[:, None] for t in range(SEGMENT)])
    for one in product[::-1]:
        last = _normal(one @ last)
    return last


def marginals(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray, before: np.ndarray | None = None,
              behind: np.ndarray | None = None) -> np.ndarray:
    """Probabilities word x language for texts of ``counts`` words, one after the other.

    A piece from the middle of one text takes the forward vector before it and the backward vector behind it; the former is changed in place into
    the one at its end.
    """
    n, k = scores.shape
    emit = np.exp(scores - scores.max(axis=1, keepdims=True)) if n else scores
    step = np.exp(transitions - transitions.max())
    pieces = -(-counts // SEGMENT)
    text = np.repeat(np.arange(len(counts)), pieces)
    place = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = (np.cumsum(counts) - counts)[text] + place * SEGMENT
    size = np.minimum(counts[text] - place * SEGMENT, SEGMENT)
    at = [first + np.minimum(t, size - 1) for t in range(SEGMENT)]
    live = [(t < size)[:, None] for t in range(SEGMENT)]
    product = _products(emit, step, at, live)
    into, out = np.full((len(text), k), 1 / k), np.full((len(text), k), 1 / k)
    if before is not None:
        into[0], out[-1] = before, behind
    by_place = np.argsort(place, kind="stable")
    layers = np.split(by_place, np.cumsum(np.bincount(place))[:-1]) if len(place) else []
    for layer in layers[1:]:
        into[layer] = _normal(np.einsum("si,sij->sj", into[layer - 1], product[layer - 1]))
    for layer in layers[:0:-1]:
        out[layer - 1] = _normal(np.einsum("sij,sj->si", product[layer], out[layer]))
    forward = np.empty((SEGMENT, len(text), k))
    for t in range(SEGMENT):
        into = np.where(live[t], _normal(into @ step * emit[at[t]]), into)
        forward[t] = into
    if before is not None:
        before[:] = into[-1]
    result = np.empty((n, k))
    for t in range(SEGMENT - 1, -1, -1):
        on = live[t][:, 0]
        result[at[t][on]] = _normal(forward[t][on] * out[on])
        out = np.where(live[t], _normal((emit[at[t]] * out) @ step.T), out)
    return result


def train(texts: list[str], languages: list[str], bits: int = BITS, steps: int = 300, batch: int = 48, length: int = 24,
          rate: float = 0.3, seed: int = 7) -> Model:
    """Conditional likelihood by AdaGrad over random sequences of spans of the texts."""
    names = sorted(set(languages))
    label = np.array([names.index(x) for x in languages])
    numbers = WordNumbers()
    at, counts = numbers.number(texts, words_of)
    words, ends = numbers.since(0), np.cumsum(counts)
    seen: dict[str, Counter] = defaultdict(Counter)
    for i, text_label in enumerate(label.tolist()):
        for w in set(at[ends[i] - counts[i]:ends[i]].tolist()):
            seen[words[w]][text_label] += 1
    # a word enters the lexicon of a language where nine in ten of its texts are, of three at least
    lexicon = {w: best for w, c in seen.items() for best, most in c.most_common(1)
               if c.total() >= 3 and most >= 0.9 * c.total()}
    k = len(names)
    model = Model(names, np.zeros((1 << bits, k)), lexicon, np.zeros((k + 1, k)), np.zeros((k, k)), bits)
    usable = [np.flatnonzero((label == y) & (counts > 0)) for y in range(k)]
    usable = [u for u in usable if len(u)]
    if not usable:
        return model
    features, sizes = word_features(words, bits)
    starts = np.cumsum(sizes) - sizes
    entry = np.array([lexicon.get(w, k) for w in words])
    rng = np.random.default_rng(seed)
    grown = [np.full_like(x, 1e-6) for x in (model.weights, model.lexicon_weights, model.transitions)]
    for _ in range(steps):
        w, y = np.zeros((batch, length), np.int64), np.zeros((batch, length), np.int64)
        for b in range(batch):
            t = 0
            while t < length:
                i = int(rng.choice(usable[rng.integers(len(usable))]))
                span = int(rng.integers(3, length + 1))
                begin = int(rng.integers(0, max(1, counts[i] - span + 1)))
                part = at[ends[i] - counts[i] + begin:ends[i]][:min(span, length - t)]
                w[b, t:t + len(part)], y[b, t:t + len(part)] = part, label[i]
                t += len(part)
        flat = w.ravel()
        used = features[ranges(starts[flat], sizes[flat])]
        scores = (_sums(model.weights[used], sizes[flat]) + model.lexicon_weights[entry[flat]]).reshape(batch, length, k)
        step, emit = np.exp(model.transitions), np.exp(scores - scores.max(axis=2, keepdims=True))
        alpha, beta = np.empty_like(emit), np.ones_like(emit)
        before = np.full((batch, k), 1 / k)
        for t in range(length):
            before = alpha[:, t] = _normal(before @ step * emit[:, t])
        for t in range(length - 2, -1, -1):
            beta[:, t] = _normal((emit[:, t + 1] * beta[:, t + 1]) @ step.T)
        wrong = _normal(alpha * beta)
        pair = alpha[:, :-1, :, None] * step * (emit[:, 1:] * beta[:, 1:])[:, :, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        moves = pair.sum(axis=(0, 1))
        np.subtract.at(moves, (y[:, :-1], y[:, 1:]), 1)
        np.put_along_axis(wrong, y[:, :, None], np.take_along_axis(wrong, y[:, :, None], 2) - 1, 2)
        wrong = wrong.reshape(-1, k)
        gradients = [np.zeros_like(model.weights), np.zeros_like(model.lexicon_weights), moves]
        for j in range(k):
            gradients[0][:, j] = np.bincount(used, np.repeat(wrong[:, j], sizes[flat]), 1 << bits)
            gradients[1][:, j] = np.bincount(entry[flat], wrong[:, j], k + 1)
        for x, g, total in zip((model.weights, model.lexicon_weights, model.transitions), gradients, grown, strict=True):
            g /= batch
            total += g * g
            x -= rate * g / np.sqrt(total)
    return model


def fit(df: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", sample_texts: int = SAMPLE_TEXTS,
        sample_chars: int = SAMPLE_CHARS, **training: float) -> Model:
    """Learn from rows with a language that are not in the held-out fold, ``sample_texts`` a language or a little more.

    The number of languages must fit the driver; the sample grows with it alone.
    """
    rows = (df.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
            .where(F.col("lang").isNotNull() & ~held_out(F.col("id")) & F.length("text").between(1, sample_chars)))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return train([], [], **training)
    place = F.xxhash64(F.lit("sample"), "id", "text")
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 1.5 * sample_texts / n))])
    sample = (rows.where(F.pmod(place, F.lit(1 << 30)) < F.try_element_at(share, F.col("lang")) * (1 << 30))
              .orderBy(place, "id", "lang", "text").limit(2 * sample_texts * len(sizes)).collect())
    taken: Counter = Counter()
    chosen = []
    for row in sample:
        taken[row["lang"]] += 1
        if taken[row["lang"]] <= sample_texts:
            chosen.append(row)
    return train([r["text"] for r in chosen], [r["lang"] for r in chosen], **training)


class Labeller:
    """Labels texts with a model; remembers the scores of the words it has met, up to a bound."""

    def __init__(self, model: Model, remembered: int = REMEMBERED_WORDS) -> None:
        self.model, self.limit = model, remembered
        self._forget()

    def _forget(self) -> None:
        self.words, self.scores = WordNumbers(), np.zeros((0, len(self.model.languages)))

    def pieces(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of the first text, words of each text, probabilities word x language) of consecutive texts, or of a piece of a long one."""
        if len(self.words) > self.limit:
            self._forget()
        at, counts = self.words.number(texts, words_of)
        new, k = self.words.since(len(self.scores)), len(self.model.languages)
        self.scores = np.concatenate([self.scores, *(emissions(new[i:i + 50_000], self.model) for i in range(0, len(new), 50_000))])
        most = max(SEGMENT, PIECE // max(k, k * k // 8))
        ends = np.cumsum(counts)
        first = 0
        while first < len(texts):
            begin = int(ends[first] - counts[first])
            stop = max(first + 1, int(np.searchsorted(ends, begin + most, "right")))
            if counts[first] <= most:
                yield first, counts[first:stop], marginals(self.scores[at[begin:ends[stop - 1]]], counts[first:stop], self.model.transitions)
            else:
                yield from ((first, np.array([len(found)]), found) for found in self._long(at[begin:ends[first]], most))
            first = stop

    def _long(self, at: np.ndarray, most: int) -> Iterator[np.ndarray]:
        """The probabilities of a long text in pieces: backward vectors between them first, then each piece with its forward vector."""
        k, moves = len(self.model.languages), self.model.transitions
        parts = [at[i:i + most] for i in range(0, len(at), most)]
        behind = [np.full(k, 1 / k)]
        for part in parts[:0:-1]:
            behind.append(before_piece(self.scores[part], moves, behind[-1]))
        before = np.full(k, 1 / k)
        for part in parts:
            yield marginals(self.scores[part], np.array([len(part)]), moves, before, behind.pop())

    def texts(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        if not self.model.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        sums, counts = np.zeros((len(texts), len(self.model.languages))), np.zeros(len(texts), np.int64)
        for first, own, found in self.pieces(texts):
            at = first + np.flatnonzero(own)
            if len(at):
                sums[at] += _sums(found, own[own > 0])
            counts[first:first + len(own)] += own
        some = counts > 0
        best = sums.argmax(axis=1)
        score = np.where(some, sums[np.arange(len(texts)), best] / np.maximum(counts, 1), 0)
        return [self.model.languages[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist(), strict=True)], score.clip(0, 1)


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        for rows, texts in text_blocks(batches, "text", WORD_BLOCK):
            langs, scores = labeller.texts(texts)
            yield pa.record_batch([rows.column("id"), pa.array(langs, pa.string()), pa.array(scores)],
                                  names=["id", "lang_pred", "score"])

    kind = source.schema["id"].dataType.simpleString()
    return map_arrow(source, run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def label_words(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<lang, words>>): runs of words of one language, in order."""
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        for rows, texts in text_blocks(batches, "text", WORD_BLOCK):
            counts, labels = np.zeros(len(texts), np.int64), []
            for first, own, found in labeller.pieces(texts) if labeller.model.languages else ():
                counts[first:first + len(own)] += own
                labels.append(found.argmax(axis=1))
            best = np.concatenate(labels) if labels else np.zeros(0, np.int64)
            spans, end = [], 0
            for n in counts.tolist():
                own, end = best[end:end + n] if n else [], end + n
                cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), n] if n else [0]
                spans.append([{"lang": labeller.model.languages[own[a]], "words": b - a}
                              for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
            yield pa.record_batch([rows.column("id"), pa.array(spans, pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())])))],
                                  names=["id", "spans"])

    kind = source.schema["id"].dataType.simpleString()
    return map_arrow(source, run, f"id {kind}, spans array<struct<lang: string, words: bigint>>").withColumnRenamed("id", id_col)


def with_language(df: DataFrame, model: Model, text_col: str = "text", least_score: float = 0.5) -> DataFrame:
    """The rows, all columns as they are, of a language that the model knows and is sure enough of."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        for rows, texts in text_blocks(batches, text_col, WORD_BLOCK):
            langs, scores = labeller.texts(texts)
            yield rows.filter(pa.array([x != UNKNOWN and s >= least_score for x, s in zip(langs, scores.tolist(), strict=True)]))

    return map_arrow(df, run, df.schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
