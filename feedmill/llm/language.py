"""Language identification with interpolated Kneser-Ney character models.

A text becomes a row of lower-case letters, with one blank for anything between
them.  One model per language gives the probability of a letter after the three
before it, interpolated down to single letters.  The n-grams of all languages are
kept in sorted arrays of hashes, each with one log probability per language, so a
position is looked up once for all of them.  The language with the lowest cross-entropy per
letter is chosen; texts that no language explains about as well as its own are rejected.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from feedmill.llm.arrow import begin_task, by_size, slices, small_batches, with_columns
from feedmill.llm.tables import bytes_of
from feedmill.operators.limits import LIMITS
from feedmill.operators.storage import materialised

ORDER = 4
UNDETERMINED = "und"
# The classifier is fitted on a sample of so many documents per language; every fifth of them calibrates it.
SAMPLE_DOCS, CALIBRATES = 750, 5
# N-grams kept per language, the most frequent ones.
MAX_GRAMS = 200_000
_PAD = "\n" * (ORDER - 1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
# Letters that are enough for certainty; a score counts no more of them.
_FULL_LETTERS = 25
# A text of fewer letters is never rejected for its cross-entropy, which varies too much.
_MIN_LETTERS = 30
# How far, in nats per letter, a text may lie beyond this quantile of the calibration texts.
_MARGIN = 1.0
_QUANTILE = 0.98


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, ends) of several texts behind one another, each with a run of blanks (0) before it."""
    data = [np.frombuffer((_PAD + t.lower()).encode("utf-32-le"), "<u4") for t in texts]
    codes = np.concatenate(data) if data else np.zeros(0, "<u4")
    ends = np.cumsum([len(d) for d in data], dtype=np.int64)
    is_letter = _letters()[codes]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first blank after a letter
    starts = ends - [len(d) for d in data]
    for k in range(ORDER - 1):
        keep[starts + k] = True
    return np.where(is_letter, codes, 0)[keep].astype(np.uint64), np.cumsum(keep)[ends - 1] if len(ends) else ends


def _hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` codes that end at each place (of fewer at the beginning)."""
    out = codes + np.uint64(1)
    for k in range(1, order):
        out[k:] += (codes[:-k] + np.uint64(1)) * _POWERS[k]
    return out


_POWERS = np.cumprod(np.full(ORDER, _MULTIPLIER))
_POWERS = np.concatenate([np.ones(1, np.uint64), _POWERS])


def _row_hashes(grams: np.ndarray) -> np.ndarray:
    """The hash of each row of codes, as :func:`_hashes` gives it for a running text."""
    out = np.zeros(len(grams), np.uint64)
    for k in range(grams.shape[1]):
        out += (grams[:, -1 - k] + np.uint64(1)) * _POWERS[k]
    return out


def _distinct(grams: np.ndarray) -> np.ndarray:
    """Rows without repeats, in the order of their hashes."""
    return grams[np.unique(_row_hashes(grams), return_index=True)[1]]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in the sorted ``keys``, and which of them are there."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _counted(grams: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of one order and their counts: below the highest, the number of letters seen before them."""
    if order == ORDER:
        return grams, counts
    longer = _distinct(grams[:, ORDER - order - 1 :])
    _, first, n = np.unique(_row_hashes(longer[:, 1:]), return_index=True, return_counts=True)
    return longer[first][:, 1:], n


class Model:
    """Log probabilities per language in sorted hash arrays, one array per order."""

    def __init__(self, grams: dict[str, np.ndarray], counts: dict[str, np.ndarray]):
        """``grams``: per language an array (n, ORDER) of codes; ``counts``: how often each was seen."""
        self.languages = sorted(grams)
        self.worst = {}
        self.hashes, self.log_p, self.contexts, self.log_backoff = [], [], [], []
        lower = None
        for order in range(1, ORDER + 1):
            union = _distinct(np.concatenate([grams[lang][:, ORDER - order :] for lang in self.languages]))
            keys = _row_hashes(union)
            contexts, context_of = np.unique(_row_hashes(union[:, :-1]), return_inverse=True)
            if order == 1:
                uniform = 1 / (len(union) + 1)
                below = np.full((len(union), len(self.languages)), uniform)
            else:
                below = lower[_find(self.hashes[-1], _row_hashes(union[:, 1:]))[0]]
            p, backoff = np.empty_like(below), np.ones((len(contexts), len(self.languages)))
            for j, lang in enumerate(self.languages):
                seen, n = _counted(grams[lang], counts[lang], order)
                own = np.zeros(len(union))
                own[_find(keys, _row_hashes(seen))[0]] = n
                once, twice = (own == 1).sum(), (own == 2).sum()
                discount = once / (once + 2 * twice) if once else 0.5
                total = np.bincount(context_of, own, len(contexts))
                kinds = np.bincount(context_of, own > 0, len(contexts))
                known = total > 0
                backoff[known, j] = np.maximum(discount * kinds[known] / total[known], 1e-6)
                p[:, j] = np.maximum(own - discount, 0) / np.maximum(total, 1)[context_of] + backoff[context_of, j] * below[:, j]
            lower = p
            self.hashes.append(keys)
            self.log_p.append(np.log(p).astype(np.float32))
            self.contexts.append(contexts)
            self.log_backoff.append(np.log(backoff).astype(np.float32))
        self.log_uniform = np.float32(np.log(uniform))

    def _log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """(place, language): the highest order that was seen, times the backoff of the contexts above it."""
        out = np.zeros((len(codes), len(self.languages)), np.float32)
        todo = np.arange(len(codes))
        for order in range(ORDER, 0, -1):
            at, found = _find(self.hashes[order - 1], _hashes(codes, order)[todo])
            out[todo[found]] += self.log_p[order - 1][at[found]]
            todo = todo[~found]
            if order > 1:
                at, found = _find(self.contexts[order - 1], _hashes(codes, order - 1)[todo - 1])
                out[todo[found]] += self.log_backoff[order - 1][at[found]]
        out[todo] += self.log_backoff[0][0] + self.log_uniform
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(letters, cross-entropy per letter and language) of whole texts."""
        codes, ends = _codes(texts)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) + ORDER - 1
        n = ends - starts
        values = np.concatenate([self._log_probabilities(codes), np.zeros((1, len(self.languages)), np.float32)])
        bounds = np.stack([starts, ends], axis=1).reshape(-1)
        sums = np.add.reduceat(values, bounds, axis=0, dtype=np.float64)[::2]
        return n, -sums / np.maximum(n, 1)[:, None]

    def identify(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """(language, score, accepted) of each text."""
        languages, scores, accepted = [], [], []
        for group in by_size(texts):
            letters, entropy = self.entropies(group)
            best = entropy.argmin(axis=1)
            lowest = entropy[np.arange(len(group)), best]
            odds = np.exp(-(entropy - lowest[:, None]) * np.minimum(letters, _FULL_LETTERS)[:, None])
            worst = np.array([self.worst.get(lang, np.inf) for lang in self.languages])[best]
            kept = (letters < _MIN_LETTERS) | (lowest <= worst + _MARGIN)
            some = letters > 0
            languages += [self.languages[b] if s else UNDETERMINED for b, s in zip(best, some)]
            scores += np.where(some, 1 / odds.sum(axis=1), 0.0).tolist()
            accepted += (kept & some).tolist()
        return languages, scores, accepted


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model of the languages of ``labelled``; None without any labelled text.

    Of each language the SAMPLE_DOCS documents first in the order of their ids' hashes
    are taken whole.  Four of five are learnt, the fifth helps to set the bound of rejection: a
    high quantile of the cross-entropy of those that the model finds to be in their language, so that a
    few mixed or mislabelled texts do not lift it.  Counting is distributed; the driver receives at
    most MAX_GRAMS counted n-grams per language.  Rows without id, text or language are left out.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")).dropna()
    hashed = F.xxhash64("_id")
    first = Window.partitionBy("_lang").orderBy(hashed, "_id")
    # Ranked without the texts; every task leaves out what is too far down before the shuffle.
    ranked = rows.select("_id", "_lang").distinct().withColumn("_rank", F.row_number().over(first))
    ranked = materialised(ranked.where(F.col("_rank") <= SAMPLE_DOCS), "language-sample")
    if bytes_of(ranked, 32 + F.octet_length("_lang")) <= LIMITS.broadcast_max_bytes // 8:
        ranked = F.broadcast(ranked)
    sample = rows.join(ranked, ["_id", "_lang"])

    def count(batches):
        begin_task()
        for batch in batches:
            for part in slices(batch, 200):
                langs, texts = [c.to_pylist() for c in part.columns]
                for lang in set(langs):
                    codes, ends = _codes([t for t, other in zip(texts, langs) if other == lang])
                    if len(codes) < ORDER:
                        continue  # a single text without letters
                    grams = np.lib.stride_tricks.sliding_window_view(codes, ORDER)
                    inside = np.ones(len(codes), bool)
                    for k in range(ORDER - 1):
                        inside[np.concatenate([[0], ends[:-1]]).astype(int) + k] = False
                    grams = grams[inside[ORDER - 1 :]]
                    _, at, n = np.unique(_row_hashes(grams), return_index=True, return_counts=True)
                    points = np.where(grams[at] == 0, ord(" "), grams[at]).astype("<u4")
                    strings = [points[i].tobytes().decode("utf-32-le") for i in range(len(points))]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(strings), pa.array(n)], ["lang", "gram", "n"])

    learnt = sample.where(F.col("_rank") % CALIBRATES != 0).select("_lang", "_text")
    counted = learnt.mapInArrow(count, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    most = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    found = counted.withColumn("_r", F.row_number().over(most)).where(F.col("_r") <= MAX_GRAMS).drop("_r").toArrow().to_pandas()
    if found.empty:
        return None
    grams, counts = {}, {}
    for lang, own in found.groupby("lang"):
        points = np.frombuffer("".join(own["gram"]).encode("utf-32-le"), "<u4").reshape(-1, ORDER).astype(np.uint64)
        grams[lang], counts[lang] = np.where(points == ord(" "), np.uint64(0), points), own["n"].to_numpy()
    model = Model(grams, counts)

    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        begin_task()
        for batch in batches:
            for part in slices(batch, 200):
                langs, texts = [c.to_pylist() for c in part.columns]
                letters, entropy = shared.value.entropies(texts)
                best = entropy.argmin(axis=1)
                own = [i for i, lang in enumerate(langs) if letters[i] >= _MIN_LETTERS and lang == shared.value.languages[best[i]]]
                values = [entropy[i, shared.value.languages.index(langs[i])] for i in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([langs[i] for i in own], pa.string()), pa.array(values, pa.float64())], ["lang", "value"]
                )

    calibration = sample.where(F.col("_rank") % CALIBRATES == 0).select("_lang", "_text")
    worst = calibration.mapInArrow(measure, "lang string, value double").groupBy("lang").agg(F.percentile("value", _QUANTILE).alias("value"))
    model.worst = {r["lang"]: r["value"] for r in worst.collect()}
    return model


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``accepted`` after its columns (names after ``prefix``).

    A text that is null or has no letter is ``und`` with score 0 and not accepted, as is
    every text without a model.  Whole texts are read, in groups of bounded size; very long ones alone.
    """
    new = {f"{prefix}lang_pred": T.StringType(), f"{prefix}score": T.DoubleType(), f"{prefix}accepted": T.BooleanType()}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def values(texts):
        if shared.value is None:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts), [False] * len(texts)
        return shared.value.identify(texts)

    return with_columns(docs, text_col, new, values)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text is divisible by 5 (a null id is)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))
