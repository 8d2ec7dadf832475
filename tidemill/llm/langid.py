"""Language of each word by a linear-chain conditional random field, and of each document.

States are languages. A word's score for a state sums learned weights of its character n-grams
(bigrams and trigrams, the blanks around the word included), its four-byte prefix and suffix, and
the entry of the whole word in a hashed lexicon; learned transitions join neighbouring words. Forward-backward gives
each word's state probabilities, so text that switches language is cut where it switches. The model
is fitted by gradient steps on the likelihood of training words that are put together from
stretches of different languages, which is what teaches it transitions.

Words of many documents are worked through side by side: the sequence of a batch is folded into
stretches of ``STEP`` words, the stretches' transfer matrices are chained, and messages then run
inside all stretches at once. That is exact for documents of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemill.llm.common import stored

#: Bounds of the training sample: documents (one a language at least), bytes taken of one of them.
SAMPLE_DOCS = 1600
SAMPLE_BYTES = 20_000
#: Languages from which on weight tables get fewer entries, so that they stay as large as with these.
WIDE_LANGS = 64
EPOCHS = 3
STEP = 256
#: Bytes scored and characters chained at once with up to 8 languages, fewer with more.
_BYTES_AT_ONCE = 1_000_000
_CHARS_AT_ONCE = 1_500_000
_GRAM_BITS, _WORD_BITS = 17, 16
UNKNOWN = "und"

_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass
class Words:
    """Words of a batch: bytes with blanks around every word, places, first word of a document."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    counts: np.ndarray


def words_of(texts: list[str | None]) -> Words:
    parts, sizes = [], []
    for text in texts:
        part = (text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS)
        parts.append(part)
        sizes.append(len(part) + 1)
    data = np.frombuffer(b" " + b" ".join(parts) + b"     ", np.uint8)
    inside = (data != 32).astype(np.int8)
    edge = np.diff(inside)
    begin, end = np.nonzero(edge == 1)[0] + 1, np.nonzero(edge == -1)[0] + 1
    bounds = np.concatenate(([0], np.cumsum(sizes))) + 1
    at = np.searchsorted(begin, bounds)
    return Words(data, begin, end, np.diff(at))


def _less(size: int, langs: int) -> int:
    return max(1000, size * 8 // max(8, langs))


def _word_hashes(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash over all bytes of each word: bytes times powers of an odd number, modulo 2**32."""
    starts = np.cumsum(length) - length
    inside = np.arange(length.sum()) - np.repeat(starts, length)
    powers = np.full(int(length.max()), 0x01000193, np.uint32)
    powers[0] = 1
    powers = np.multiply.accumulate(powers, dtype=np.uint32)
    letters = data[inside + np.repeat(begin, length)] + np.uint32(1)
    return np.add.reduceat(letters * powers[inside], starts, dtype=np.uint32)


class Features:
    """Indexes into the weight tables of a range of words; ``fewer`` bits than with few languages."""

    def __init__(self, words: Words, first: int, last: int, fewer: int = 0):
        begin, end = words.begin[first:last], words.end[first:last]
        low = int(begin[0]) - 1
        data = words.data[low:int(end[-1]) + 4].astype(np.uint32)
        pair = data[:-1] << np.uint32(8) | data[1:]
        triple = pair[:-1] << np.uint32(8) | data[2:]
        begin, end = begin - low, end - low
        # grams of a word begin at the blank before it and end with the blank behind it
        self.starts = begin - 1
        self.pair = pair * np.uint32(2654435761) >> np.uint32(16 + fewer) if fewer else pair
        self.triple = triple * np.uint32(2654435761) >> np.uint32(32 - _GRAM_BITS + fewer)
        quad = triple[:-1] << np.uint32(8) | data[3:]
        length = end - begin
        head, tail = quad[begin], quad[np.maximum(end - 4, 0)]
        head = np.where(length >= 4, head, 0)
        tail = np.where(length >= 4, tail, quad[begin] | np.uint32(1 << 31))
        fold = lambda x, k: x * np.uint32(k) >> np.uint32(32 - _WORD_BITS + fewer)
        self.prefix, self.suffix = fold(head, 2654435761), fold(tail, 2246822519)
        whole = _word_hashes(data, begin, length)
        self.entry = fold(whole ^ whole >> np.uint32(15), 2246822519)
        self.size = int(end[-1])
        #: grams of word w: positions spans[w]..; grams from its last byte on belong to nobody
        self.cuts = np.stack([self.starts, end], axis=1).ravel()

    def sums(self, values: np.ndarray, width: int) -> np.ndarray:
        """Sum over each word's grams of ``width`` bytes; values stand at the gram's begin."""
        stop = self.cuts[1::2] - (width - 2)
        cuts = np.stack([self.starts, np.maximum(stop, self.starts)], axis=1).ravel()
        cuts = np.minimum(cuts, len(values) - 1)
        out = np.add.reduceat(values, cuts, axis=0)[::2]
        out[stop <= self.starts] = 0
        return out

    def owner(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, position) of every gram of ``width`` bytes."""
        n = np.maximum(self.cuts[1::2] - (width - 2) - self.starts, 0)
        word = np.repeat(np.arange(len(n)), n)
        return word, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.starts[word]


class Chain:
    """Messages of a batch of sequences laid end to end; all values are scaled."""

    def __init__(self, scores: np.ndarray, first: np.ndarray, moves: np.ndarray, start: np.ndarray):
        n, k = scores.shape
        rows = -(-n // STEP)
        self.n, self.k = n, k
        phi = np.ones((rows * STEP, k), np.float64)
        phi[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
        begins = np.ones(rows * STEP, bool)
        begins[:n] = first
        begins[0] = True
        self.phi = np.ascontiguousarray(phi.reshape(rows, STEP, k).swapaxes(0, 1))
        self.begins = np.ascontiguousarray(begins.reshape(rows, STEP).T)
        self.any = self.begins.any(axis=1)
        self.moves, self.start = np.exp(moves), np.exp(start)
        self._run(rows)

    def _step(self, alpha: np.ndarray, t: int) -> np.ndarray:
        """One word on; ``alpha`` has the states last and any shape (rows, ..., k) before."""
        out = alpha @ self.moves
        if self.any[t]:
            own = self.begins[t]
            out[own] = alpha[own].sum(axis=-1, keepdims=True) * self.start
        return out * (self.phi[t] if alpha.ndim == 2 else self.phi[t][:, None, :])

    def _run(self, rows: int) -> None:
        k = self.k
        transfer = np.broadcast_to(np.eye(k), (rows, k, k)).copy()
        for t in range(STEP):
            transfer = self._step(transfer, t)
            transfer /= transfer.sum(axis=(1, 2), keepdims=True)
        alpha, beta = np.full((rows, k), 1 / k), np.ones((rows, k))
        for r in range(1, rows):
            alpha[r] = alpha[r - 1] @ transfer[r - 1]
            alpha[r] /= alpha[r].sum()
        for r in range(rows - 2, -1, -1):
            beta[r] = transfer[r + 1] @ beta[r + 1]
            beta[r] /= beta[r].sum()
        self.into = alpha.copy()
        self.alpha, self.beta = np.empty_like(self.phi), np.empty_like(self.phi)
        for t in range(STEP):
            alpha = self._step(alpha, t)
            alpha /= alpha.sum(axis=1, keepdims=True)
            self.alpha[t] = alpha
        for t in range(STEP - 1, -1, -1):
            self.beta[t] = beta
            ahead = self.phi[t] * beta
            beta = ahead @ self.moves.T
            if self.any[t]:
                own = self.begins[t]
                beta[own] = 1.0
            beta /= beta.sum(axis=1, keepdims=True)

    def posteriors(self) -> np.ndarray:
        both = self.alpha * self.beta
        both /= both.sum(axis=2, keepdims=True)
        return both.swapaxes(0, 1).reshape(-1, self.k)[:self.n]

    def pair_counts(self) -> np.ndarray:
        """Expected transitions between the words of one sequence, (k, k)."""
        before = np.concatenate((self.into[None], self.alpha[:-1]))
        joint = before[..., :, None] * self.moves * (self.phi * self.beta)[..., None, :]
        joint /= joint.sum(axis=(2, 3), keepdims=True)
        joint[self.begins] = 0
        flat = joint.swapaxes(0, 1).reshape(-1, self.k, self.k)[:self.n]
        return flat.sum(axis=0)


class Model:
    def __init__(self, langs: list[str]):
        self.langs, k = langs, len(langs)
        self.fewer = fewer = min(10, max(0, (k - 1) // WIDE_LANGS).bit_length())
        self.tables = {
            "pair": np.zeros((1 << 16 - fewer, k), np.float32),
            "triple": np.zeros((1 << _GRAM_BITS - fewer, k), np.float32),
            "prefix": np.zeros((1 << _WORD_BITS - fewer, k), np.float32),
            "suffix": np.zeros((1 << _WORD_BITS - fewer, k), np.float32),
            "entry": np.zeros((1 << _WORD_BITS - fewer, k), np.float32),
        }
        self.moves, self.start = 2 * np.eye(k), np.zeros(k)

    def scores(self, f: Features) -> np.ndarray:
        t = self.tables
        return (f.sums(t["pair"][f.pair], 2) + f.sums(t["triple"][f.triple], 3)
                + t["prefix"][f.prefix] + t["suffix"][f.suffix] + t["entry"][f.entry])

    def posteriors(self, words: Words) -> np.ndarray:
        """State probabilities of every word; scores are made for a stretch of bytes at a time."""
        n = len(words.begin)
        if not n:
            return np.zeros((0, len(self.langs)))
        size = _less(_BYTES_AT_ONCE, len(self.langs))
        cuts = np.searchsorted(words.begin, np.arange(0, int(words.begin[-1]) + 1, size))
        cuts = np.unique(np.concatenate((cuts, [0, n])))
        scores = np.concatenate([self.scores(Features(words, a, b, self.fewer))
                                 for a, b in zip(cuts.tolist(), cuts[1:].tolist())])
        first = np.zeros(n, bool)
        starts = np.cumsum(words.counts) - words.counts
        first[starts[words.counts > 0]] = True
        return Chain(scores, first, self.moves, self.start).posteriors()


def fit(rows: list[tuple[str, str]], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Model from (language, text) rows; the same rows give the same model."""
    model = Model(sorted({lang for lang, _ in rows}))
    k, rng = len(model.langs), np.random.default_rng(seed)
    pieces: list[tuple[int, str]] = []
    for lang, text in rows:
        state, found = model.langs.index(lang), text.split()
        at = 0
        while at < len(found):
            n = int(rng.integers(4, 60))
            pieces.append((state, " ".join(found[at:at + n])))
            at += n
    squares = {name: np.full(t.shape, 1e-3, np.float32) for name, t in model.tables.items()}
    move_sq, start_sq = np.full((k, k), 1.0), np.full(k, 1.0)
    for _ in range(epochs):
        order = rng.permutation(len(pieces))
        for low in range(0, len(order), 800):
            own = [pieces[i] for i in order[low:low + 800]]
            words = words_of([p[1] for p in own])
            if not len(words.begin):
                continue
            truth = np.repeat([p[0] for p in own], words.counts)
            lone = rng.integers(1, 6)  # sequences of so many stretches
            begins = np.zeros(len(truth), bool)
            begins[np.minimum((np.cumsum(words.counts) - words.counts)[::lone],
                              len(truth) - 1)] = True
            begins[0] = True
            f = Features(words, 0, len(words.begin), model.fewer)
            chain = Chain(model.scores(f), begins, model.moves, model.start)
            gap = -chain.posteriors()
            gap[np.arange(len(truth)), truth] += 1
            for name, width in (("pair", 2), ("triple", 3), ("prefix", 0), ("suffix", 0),
                                ("entry", 0)):
                index = getattr(f, name)
                word = slice(None)
                if width:
                    word, place = f.owner(width)
                    index = index[place]
                table = model.tables[name]
                step = np.stack([np.bincount(index, gap[word, c], len(table))
                                 for c in range(k)], axis=1).astype(np.float32)
                squares[name] += step * step
                table += 0.1 * step / np.sqrt(squares[name])
            inner = ~begins[1:]
            seen = np.zeros((k, k))
            np.add.at(seen, (truth[:-1][inner], truth[1:][inner]), 1)
            step = seen - chain.pair_counts()
            move_sq += step * step
            model.moves += 0.3 * step / np.sqrt(move_sq)
            step = np.bincount(truth[begins], minlength=k) - chain.posteriors()[begins].sum(axis=0)
            start_sq += step * step
            model.start += 0.1 * step / np.sqrt(start_sq)
    return model


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           lang_col: str = "lang", most: int = SAMPLE_DOCS,
           text_bytes: int = SAMPLE_BYTES) -> list[tuple[str, str]]:
    """At most ``most`` (language, text) rows, about as many for each language.

    Every language of the rows that are not held out and have an id, a language and a text is
    there, with at least one row even if there are more than ``most`` languages. Of longer texts
    the first ``text_bytes`` bytes are taken. Rows are chosen by a hash of their id.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"),
                       F.col(text_col).alias("text")).where(
        F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
        & ~held_out("id")).withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1 << 30)))
    # one row a language, as the model has: smaller than what every task is sent of that
    counts = stored(rows.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    langs = counts.count()
    if not langs:
        return []
    each = max(1, most // langs)
    # few more than wanted of a frequent language, a rare one whole; of a text as many characters
    # as the bytes could hold, the rest is cut off when they are read
    near = rows.join(F.broadcast(counts), "lang").where(
        F.col("h") * F.col("rows") <= F.lit(float(1 << 30)) * (1.2 * each + 50)).select(
            "lang", "id", "h", F.substring("text", 1, text_bytes).alias("text"))
    first = F.row_number().over(W.partitionBy("lang").orderBy("h", "id", "text"))
    chosen = near.withColumn("at", first).where(F.col("at") <= each).select("lang", "text", "h")
    return [(r.lang, _first_bytes(r.text, text_bytes))
            for r in sorted(chosen.collect(), key=lambda r: (r.h, r.lang, r.text))]


def _first_bytes(text: str, most: int) -> str:
    data = text.encode("utf-8", "surrogatepass")
    return text if len(data) <= most else data[:most].decode("utf-8", "ignore")


def _batches(column: pa.Array, most: int) -> Iterator[tuple[int, list[str | None]]]:
    at, n = 0, len(column)
    while at < n:
        first, texts, size = at, [], 0
        while at < n and size < most:
            texts.append(column[at].as_py())
            size += len(texts[-1] or "")
            at += 1
        yield first, texts


def _has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def _judged(column: pa.Array, model: Model):
    """(first row, language, score, word probabilities, words per row) of stretches of a column."""
    k = len(model.langs)
    for first, texts in _batches(column, _less(_CHARS_AT_ONCE, k)):
        words = words_of(texts)
        share = model.posteriors(words) if k else np.zeros((len(words.begin), 0))
        totals = np.zeros((len(texts), max(k, 1)))
        full = words.counts > 0
        if k and full.any():
            starts = (np.cumsum(words.counts) - words.counts)[full]
            totals[full] = np.add.reduceat(share, starts, axis=0) / words.counts[full][:, None]
        best = totals.argmax(axis=1)
        langs, scores = [], []
        for i, text in enumerate(texts):
            known = k > 0 and full[i] and _has_letter(text)
            langs.append(model.langs[best[i]] if known else UNKNOWN)
            scores.append(float(min(1.0, totals[i, best[i]])) if known else 0.0)
        yield first, langs, scores, share, words.counts


def _runs(labels: np.ndarray, langs: list[str]) -> list[dict]:
    cuts = np.concatenate(([0], np.nonzero(np.diff(labels))[0] + 1, [len(labels)]))
    return [{"lang": langs[labels[a]], "first": int(a), "words": int(b - a)}
            for a, b in zip(cuts, cuts[1:])] if len(labels) else []


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            with_segments: bool = True) -> DataFrame:
    """``doc_id, lang_pred, score`` and, if asked, ``segments`` (runs of words of one language).

    ``score`` is the mean probability of the language over the words. A text that is null, empty or
    without a letter, and any text if nothing was learned, is ``und`` with score 0. Ties go to the
    language first in the alphabet. Repeated rows are judged each, empty tables give no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double" + (
        ", segments array<struct<lang:string,first:bigint,words:bigint>>" if with_segments else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, langs, scores, share, counts in _judged(batch.column(1), model):
                columns = [batch.column(0).slice(first, len(langs)), pa.array(langs, pa.string()),
                           pa.array(scores, pa.float64())]
                names = ["doc_id", "lang_pred", "score"]
                if with_segments:
                    labels = np.split(share.argmax(axis=1) if share.size else
                                      np.zeros(0, np.int64), np.cumsum(counts)[:-1])
                    columns.append(pa.array(
                        [_runs(x, model.langs) for x in labels],
                        pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()),
                                            ("words", pa.int64())]))))
                    names.append("segments")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, schema)


def _sureness(share: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean probability of each word's own best language, by document."""
    out, full = np.zeros(len(counts)), counts > 0
    if share.size and full.any():
        starts = (np.cumsum(counts) - counts)[full]
        out[full] = np.add.reduceat(share.max(axis=1), starts) / counts[full]
    return out


def keep_known(docs: DataFrame, model: Model, text_col: str = "text",
               least_score: float = 0.5, mixed: bool = False) -> DataFrame:
    """Rows of ``docs`` with a language and a score of ``least_score`` or more, columns kept.

    With ``mixed`` a text may switch between languages: the score is how sure the words are of
    their own language each, not how much of the text is in the most frequent one.
    """
    column = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, langs, scores, share, counts in _judged(batch.column(column), model):
                if mixed:
                    scores = _sureness(share, counts)
                keep = [x != UNKNOWN and bool(s >= least_score) for x, s in zip(langs, scores)]
                yield batch.slice(first, len(langs)).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
