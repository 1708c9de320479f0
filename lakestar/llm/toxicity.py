"""Operator 2: toxicity of whole texts, after a noisy-channel decoder has undone disguised spellings.

1. A character language model, four characters deep, is counted over all documents: letters a-z, one sign for other letters and
   one for everything else, so it has 28 ** 4 counts whatever the corpus.
2. Disguised spellings are found by pattern (signs beside letters, letters spaced out, letters said three times or more),
   and each is a lattice: every character can stand for itself or for what it imitates, a repeated one can be dropped.
   Viterbi's algorithm picks the reading that language model and channel together find likeliest. All other characters
   have one reading, so the rest of the text is its own decoding. A second lattice lets a word border come before any
   character, as spaced and glued spellings show none; where its reading differs, both count. A spelling that is read as
   it stands is a plain word, and like others not cut.
3. The restored text is scored by its words and their beginnings: each has the smoothed share of toxic documents among
   the labelled ones that hold it. The largest share and the log-odds that all telling words add up to are turned into a
   probability by the labelled documents.

Defined results: NULL and empty texts score like a text without telling words; without labels of both kinds every score is
about 0; of several labels of a document the largest counts; repeated rows are scored alike; an empty table gives no rows; other columns are never inputs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakestar.llm.common import staged, text_or_empty

# Labelled rows that shares are counted on at most: those with the least hashes of their ids.
FIT_ROWS = 40_000
# Rows of the sample that are calibrated on; a labelled id that many rows share is in the sample with all of them.
CALIBRATE_ROWS = 100_000
# What a feature at the least share still adds to the evidence.
_FLOOR = 0.9
# A feature needs so many toxic documents; shares are smoothed by so many documents of the common share.
LEAST_DOCUMENTS, SMOOTHING = 4, 4.0
# Only features above this share are kept: others say no more than that a text is a text.
LEAST_SHARE = 0.3

# What a character can stand for in a disguised spelling.
IMITATES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il",
    "+": "t", "*": "aeiou", "#": "aeiou", "(": "c", "€": "e", "£": "l", "¡": "i", "ß": "b",
}
# Log probabilities of the channel: a sign for a letter, a sign as itself, a letter as itself, a repeated letter dropped or kept.
_SIGN, _SIGN_SELF, _SELF, _DROP, _KEEP = -1.0, -2.5, 0.0, -0.1, -1.5

# Log probability of a word border between two characters of a disguised spelling that shows none.
_BORDER = -2.0

_SIGNS, _LETTER = r"0-9@$!|+*#(€£¡", r"[^\W\d_]"
# Word characters and signs in a row, with a sign beside a letter, or a letter three times.
_DISGUISED = re.compile(rf"(?<![\w{_SIGNS}])[\w{_SIGNS}]*?(?:[{_SIGNS}](?={_LETTER})|{_LETTER}[{_SIGNS}]|({_LETTER})\1\1)[\w{_SIGNS}]*")
_HINT = re.compile(rf"[{_SIGNS}]{_LETTER}|{_LETTER}[{_SIGNS}]|({_LETTER})\1\1")
# Three or more single characters with the same separator between them, of which any can be a sign.
_ONE = rf"(?:[^\W_]|[{_SIGNS}])"
_SPACED = re.compile(rf"(?<![^\W_]){_ONE}([^\S\r\n]+|[.\-_*/]){_ONE}(?:\1{_ONE})+(?![^\W_])")
_WORD = re.compile(r"[^\W\d_]+")
# A short run of one sign at the end.
_RUN = re.compile(rf"([{re.escape(''.join(c for c in IMITATES if not c.isalpha()))}])\1{{0,7}}\Z")
# Where a lower-case spelling begins to have more than one reading.
_BRANCH = re.compile(rf"[{re.escape(''.join(IMITATES))}]|(.)\1", re.DOTALL)

SYMBOLS = 28
_OTHER_LETTER, _REST = 26, 27


def symbols(text: str) -> np.ndarray:
    """Symbols of the language model: a-z, other letters, everything else."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    out = np.full(len(code), _REST, dtype=np.int32)
    plain = (code >= 97) & (code <= 122)
    out[plain] = code[plain] - 97
    # Beyond Latin-1's signs nearly everything in a text is a letter.
    out[code >= 0xC0] = _OTHER_LETTER
    return out


def language_model(documents: DataFrame) -> np.ndarray:
    """Log probability of each symbol after each three others, counted over all documents."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**4, dtype=np.int64)
        for batch in batches:
            for i in range(0, len(batch), 256):
                s = symbols(" " * 3 + "   ".join(batch.column(0)[i : i + 256].to_pylist()))
                total += np.bincount(((s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1]) * SYMBOLS + s[3:], minlength=SYMBOLS**4)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["gram", "n"])

    grams = text_or_empty(documents).select("text").mapInArrow(count, "gram long, n long")
    found = grams.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SYMBOLS**4)
    counts[found["gram"].to_numpy(dtype=np.int64)] = found["n"].to_numpy()
    counts = counts.reshape([SYMBOLS] * 4)
    # Each depth is smoothed by the one below it.
    p = (counts.sum(axis=(0, 1, 2)) + 1) / (counts.sum() + SYMBOLS)
    for depth in (2, 1, 0):
        c = counts.sum(axis=tuple(range(depth)))
        p = (c + 5 * p) / (c.sum(axis=-1, keepdims=True) + 5)
    return np.log(p).astype(np.float32)


# Readings of spellings up to this length are kept for the next time.
KEPT = 40


_START = _REST * (SYMBOLS**2 + SYMBOLS + 1)


@lru_cache(maxsize=10_000)
def _symbol(sign: str) -> int:
    return ord(sign) - 97 if "a" <= sign <= "z" else _OTHER_LETTER if ord(sign) >= 0xC0 else _REST


def _spelled(read: tuple) -> str:
    out = []
    while read:
        read, sign = read
        out.append(sign)
    return "".join(reversed(out))


class Decoder:
    """Viterbi decoding of disguised spellings under a language model."""

    def __init__(self, model: np.ndarray) -> None:
        self._array = model.ravel().astype(np.float64)
        self._model = self._array.tolist()
        self._cached, self._ends = lru_cache(maxsize=50_000)(self._word), lru_cache(maxsize=50_000)(self._end)
        self._runs = lru_cache(maxsize=32)(self._run)

    def word(self, text: str) -> str:
        """The likeliest reading of one spelling of any length, lower-cased, and that with word borders if it is another.
        Only short ones come again and are kept."""
        return self._cached(text) if len(text) <= KEPT else self._word(text)

    def _word(self, text: str) -> str:
        text = text.lower()
        plain = self._plain(text)
        if plain == text:
            # Read as it stands: nothing is disguised here, and other plain words are not cut either.
            return plain
        split = self._likeliest(text, True)
        return plain if plain == split else f"{plain} {split}"

    def _plain(self, text: str) -> str:
        """The likeliest reading without borders. Up to its first sign or doubled letter a spelling has one reading, so what follows
        depends on the last three letters before alone."""
        found = _BRANCH.search(text)
        at = found.start() if found else len(text)
        state = _START
        for sign in text[max(0, at - 3) : at]:
            state = (state * SYMBOLS + _symbol(sign)) % SYMBOLS**3
        end = text[at:]
        return text[:at] + (self._ends(end, state) if len(end) <= KEPT else self._end(end, state))

    def _end(self, text: str, state: int) -> str:
        return self._likeliest(text, False, state)

    def _readings(self, text: str, i: int) -> list[tuple[str, float]]:
        c = text[i]
        if c.isalpha():
            if i and text[i - 1] == c and (text[i - 2 : i] == c * 2 or text[i + 1 : i + 2] == c):
                return [(c, _KEEP), ("", _DROP)]
            return [(c, _SELF)]
        if c not in IMITATES:
            return [(c, _SELF)]
        return [(c, _SIGN_SELF), *((x, _SIGN) for x in IMITATES[c])]

    def _likeliest(self, text: str, borders: bool, start: int = _START) -> str:
        model, done, base, states = self._model, [], SYMBOLS, SYMBOLS**3
        run = _RUN.search(text)
        stop = run.start() if run and (run.start() or not borders) else len(text)
        # Paths by their last three symbols as one number. They are chains (earlier, signs), so that a step costs the same however
        # long the text; what all paths share is done.
        paths: dict[int, tuple[float, tuple]] = {start: (0.0, ())}
        for i in range(stop):
            after: dict[int, tuple[float, tuple]] = {}
            readings = self._readings(text, i)
            if borders and i:
                readings += [(f" {out}", channel + _BORDER) for out, channel in readings if out.isalpha()]
            coded = [(out, channel, *map(_symbol, out)) for out, channel in readings]
            for state, (score, read) in paths.items():
                for out, total, *signs in coded:
                    total += score
                    new = state
                    for s in signs:
                        at = new * base + s
                        total += model[at]
                        new = at % states
                    known = after.get(new)
                    if known is None or known[0] < total:
                        after[new] = (total, (read, out) if out else read)
            paths = after
            if len(paths) == 1:
                ((state, (score, read)),) = paths.items()
                done.append(_spelled(read))
                paths = {state: (score, ())}
        left, picks, nexts, outs = self._runs(text[stop : stop + 1], len(text) - stop, borders)
        state = max(paths, key=lambda s: paths[s][0] + left[s])
        done.append(_spelled(paths[state][1]))
        for pick, after_pick in zip(picks, nexts, strict=True):
            chosen = pick[state]
            done.append(outs[chosen])
            state = after_pick[chosen][state]
        return "".join(done)

    def _run(self, sign: str, count: int, borders: bool) -> tuple:
        """For a run of one sign at a spelling's end, the best score from every state on to the end, and for each place the reading
        that leads there. Spellings end in few different runs, so each is worked out for all states at once, from the end."""
        model, every = self._array, np.arange(SYMBOLS**3)
        left = model[every * SYMBOLS + _REST]
        readings = self._readings(sign, 0) if count else []
        if borders:
            readings += [(f" {out}", channel + _BORDER) for out, channel in readings if out.isalpha()]
        step, reached = [], []
        for out, channel in readings:
            total, new = np.full(len(every), channel), every
            for s in map(_symbol, out):
                at = new * SYMBOLS + s
                total, new = total + model[at], at % SYMBOLS**3
            step.append(total)
            reached.append(new.astype(np.int32))
        picks = []
        for _ in range(count):
            totals = np.stack([t + left[new] for t, new in zip(step, reached, strict=True)])
            picks.append(totals.argmax(axis=0).astype(np.int8))
            left = totals.max(axis=0)
        return left, picks[::-1], [reached] * count, [out for out, _ in readings]

    def restore(self, text: str) -> str:
        """The text with every disguised spelling replaced by its likeliest reading."""
        text = _SPACED.sub(lambda m: self.word(m[0][:: 1 + len(m[1])]), text)
        if _HINT.search(text):
            text = _DISGUISED.sub(lambda m: self.word(m[0]), text)
        return text


# Beginnings of words that are features beside the words themselves.
BEGINNINGS = (4, 5, 6, 7)


_decoder: tuple[np.ndarray, Decoder] | None = None


def worker_decoder(model: np.ndarray) -> Decoder:
    """The worker's decoder for a model, with what earlier tasks have read; one for another model takes its place."""
    global _decoder
    if _decoder is None or _decoder[0] is not model:
        _decoder = (model, Decoder(model))
    return _decoder[1]


def features(word: str) -> list[str]:
    return [word, *(f"{word[:k]}-" for k in BEGINNINGS if len(word) > k)]


def _sample(documents: DataFrame, labels: DataFrame, model: np.ndarray) -> DataFrame:
    """(text, label): restored texts of a bounded sample of the labelled rows."""
    labels = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    labels = staged(labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS), "labels")

    def restore(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(model)
        for batch in batches:
            texts = [decode.restore(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(1)], ["text", "label"])

    chosen = text_or_empty(documents).join(F.broadcast(labels), "doc_id").select("text", F.col("label").cast("int").alias("label"))
    return staged(chosen.mapInArrow(restore, "text string, label int"), "sample")


def feature_shares(sample: DataFrame) -> dict[str, float]:
    """Share of toxic documents for each telling feature."""
    common = sample.agg(F.avg("label").alias("p")).first()["p"]
    if not common:
        return {}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, list[int]] = {}
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for f in {f for w in set(_WORD.findall(text.lower())) for f in features(w)}:
                    total.setdefault(f, [0, 0])[label > 0] += 1
            if len(total) > 500_000:
                yield _counted(total)
                total = {}
        yield _counted(total)

    seen = sample.mapInArrow(count, "feature string, clean long, toxic long")
    kept = seen.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= LEAST_DOCUMENTS)
    share = (F.col("toxic") + SMOOTHING * common) / (F.col("toxic") + F.col("clean") + SMOOTHING)
    # The sample bounds this table; the shares leave a small part of it.
    found = kept.withColumn("share", share).where(F.col("share") > max(LEAST_SHARE, 1.5 * common)).toPandas()
    return dict(zip(found["feature"], found["share"], strict=True))


class Scorer:
    """Evidence of the words of a text, and what probability that has turned out to mean."""

    def __init__(self, shares: dict[str, float], weights: Sequence[float] = (1.0, 0.0, 0.0)) -> None:
        self._shares, self._weights, self._known = shares, np.array(weights), {}

    def evidence(self, text: str) -> tuple[float, float]:
        """The largest share of any word, and the log-odds that all telling words add up to, each word once."""
        best, total, known = 0.0, 0.0, self._known
        for word in set(_WORD.findall(text.lower())):
            p = known.get(word)
            if p is None:
                p = max((self._shares.get(f, 0.0) for f in features(word)), default=0.0)
                if len(known) > 200_000:
                    known.clear()
                known[word] = p
            if p:
                best = max(best, p)
                total += math.log(p / (1 - p)) + _FLOOR
        return best, total

    def score(self, text: str) -> float:
        return float(_probability(_inputs([self.evidence(text)]), self._weights)[0])


def _log_odds(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 0.05, 0.9999)
    return np.log(share / (1 - share))


def _inputs(evidence: Sequence[tuple[float, float]]) -> np.ndarray:
    found = np.array(evidence, dtype=float).reshape(-1, 2)
    return np.stack([_log_odds(found[:, 0]), np.log1p(np.maximum(found[:, 1], 0)), np.ones(len(found))], axis=1)


def _probability(inputs: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))


def calibrate(sample: DataFrame, shares: dict[str, float]) -> tuple[float, ...]:
    """Weights of the log-odds at which the sample's documents are toxic, given their evidence: the largest share of hundreds
    of words is often high by chance, and several telling words say more than one. A bounded part of the sample is looked at."""

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shares)
        for batch in batches:
            found = [scorer.evidence(x) for x in batch.column(0).to_pylist()]
            columns = [pa.array([x[k] for x in found], pa.float64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(1)], ["share", "total", "label"])

    rows = sample.mapInArrow(gather, "share double, total double, label int").limit(CALIBRATE_ROWS).toPandas()
    y = (rows["label"].to_numpy() > 0).astype(float)
    if not len(y) or y.min() == y.max():
        return 0.0, 0.0, -30.0
    weights, inputs = np.array([1.0, 0.0, 0.0]), _inputs(rows[["share", "total"]].to_numpy())
    for _ in range(50):  # Newton's method with a weak pull to zero, so that clean separation stays finite
        p = _probability(inputs, weights)
        gradient = inputs.T @ (y - p) - 1e-2 * weights
        curve = (inputs * (p * (1 - p))[:, None]).T @ inputs + 1e-2 * np.eye(3)
        step = np.clip(np.linalg.solve(curve, gradient), -2, 2)
        weights += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(w) for w in weights)


def _counted(total: dict[str, list[int]]) -> pa.RecordBatch:
    columns = [pa.array(list(total), pa.string()), *(pa.array([x[k] for x in total.values()], pa.int64()) for k in (0, 1))]
    return pa.RecordBatch.from_arrays(columns, ["feature", "clean", "toxic"])


def _learned(documents: DataFrame, labels: DataFrame):  # noqa: ANN202
    """Broadcast of the decoder's model and the scorer. Both are bounded: the model by its symbols, the shares by the sample."""
    model = language_model(documents)
    sample = _sample(documents, labels, model)
    shares = feature_shares(sample)
    return documents.sparkSession.sparkContext.broadcast((model, shares, calibrate(sample, shares)))


def score_toxicity(documents: DataFrame, labels: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, score, and the restored text if asked for) of every row of ``documents``; ``labels`` (doc_id, label) are
    the rows to learn from."""
    known = _learned(documents, labels)
    out = "doc_id long, score double" + ", restored string" * with_text

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, *rest = known.value
        decode, scorer = worker_decoder(model), Scorer(*rest)
        for batch in batches:
            texts = [decode.restore(x.as_py()) for x in batch.column(1)]
            scores = pa.array([scorer.score(x) for x in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores, *[pa.array(texts, pa.string())] * with_text], ["doc_id", "score", *["restored"] * with_text])

    return text_or_empty(documents).mapInArrow(score, out)


def keep_below(documents: DataFrame, labels: DataFrame, bound: float) -> DataFrame:
    """The rows of ``documents`` that score below ``bound``, with all their columns; nothing is shuffled."""
    known, text = _learned(documents, labels), documents.columns.index("text")

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, *rest = known.value
        decode, scorer = worker_decoder(model), Scorer(*rest)
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(decode.restore(x.as_py() or "")) < bound for x in batch.column(text)], pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
