"""Language identification by prediction by partial matching.

For every language a tree of byte contexts of up to ``ORDER`` bytes counts which byte follows. A byte is
coded in the longest context seen in training; a byte new there costs an escape (method C: bytes seen
once against all seen) and is coded in the next shorter context, down to a uniform code. Counts are
frozen after training, so a text's code length under a language is a sum over its bytes, and the language
with the shortest code is predicted.

For scoring, the trees are merged into one table per order: code lengths of all languages for each
(context, byte) that any language has seen, and the escape costs of each context. So a byte takes about
one look-up for all languages together.

The model is fitted on whole texts of about ``PER_LANGUAGE`` documents a language, those with the smallest
hashes of id and text, which bounds the tables that are broadcast.

Defined results: ``und`` with score 0 for texts that are null, empty or without a letter, and for all when
nothing can be learned; equal code lengths go to the first language by name; a null id is not held out
and not learned from; repeated rows each keep their row; an empty table gives an empty result. Texts are scored
whole, very long ones in chunks of ``CHUNK`` bytes that see the bytes before them; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintage.llm.staging import packed, stage

ORDER = 4
PER_LANGUAGE = 600
UNKNOWN = "und"
FOLDS = 5
CHUNK = 1 << 16
_LETTER = regex.compile(r"\p{L}")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _contexts(data: np.ndarray, order: int) -> np.ndarray:
    """For every byte a key of its ``order`` bytes before and itself; bytes in front of the text count as 0."""
    key = data.astype(np.int64)
    for back in range(1, order + 1):
        before = np.zeros(len(data), np.int64)
        before[back:] = data[:-back]
        key |= before << (8 * back)
    return key


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(df: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, text) of the documents to learn from.

    A language with more than ``per_language`` documents gives those whose hash lies below a cut that
    lets about so many through, so no text is shuffled or sorted for the choice.
    """
    # These columns alone: others may have the names used below.
    usable = df.select("doc_id", "text", "lang").filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").filter(~held_out())
    cuts = usable.groupBy("lang").agg((per_language / F.count(F.lit(1))).alias("share"))
    chance = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) / float(1 << 53)
    return usable.join(stage(cuts), "lang").filter(chance < F.col("share")).select("lang", "text")


def counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, k, key, n): how often each byte followed each context of k bytes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, same in frame.groupby("lang"):
                for k in range(order + 1):
                    keys = np.concatenate([_contexts(np.frombuffer(t.encode(), np.uint8), k) for t in same["text"]])
                    keys, n = np.unique(keys, return_counts=True)
                    yield pd.DataFrame({"lang": lang, "k": np.int32(k), "key": keys, "n": n})

    found = texts.mapInPandas(run, "lang string, k int, key long, n long")
    return found.groupBy("lang", "k", "key").agg(F.sum("n").alias("n"))


class Table:
    """Hash table from a key to a row of numbers, by open addressing."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray) -> None:
        self.bits = max(4, int(np.ceil(np.log2(4 * max(len(keys), 1)))))
        self.place = np.zeros(1 << self.bits, np.int32)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rows = np.vstack([np.zeros((1, rows.shape[1]), np.float32), rows.astype(np.float32)])
        at, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] == -1
            self.keys[at[todo[free]]] = keys[todo[free]]
            placed = self.keys[at[todo]] == keys[todo]
            self.place[at[todo[placed]]] = todo[placed] + 1
            todo = todo[~placed]
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places in ``rows``; 0, a row of zeros, for keys that are not there."""
        at = self._slots(keys)
        found = self.keys[at]
        result = np.where(found == keys, self.place[at], 0)
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
            found = self.keys[at[todo]]
            hit = found == keys[todo]
            result[todo[hit]] = self.place[at[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return result


class Model:
    """Code lengths in bits. ``codes[k]`` by (context, byte) and ``escapes[k]`` by context, a column per language."""

    def __init__(self, counted: pd.DataFrame, order: int = ORDER) -> None:
        self.languages = sorted(counted["lang"].unique())
        n_lang = len(self.languages)
        shorter_keys, shorter = np.empty(0, np.int64), np.empty((0, n_lang))
        self.codes, self.escapes = [], []
        column = {lang: i for i, lang in enumerate(self.languages)}
        for k in range(order + 1):
            own = counted[counted["k"] == k]
            keys = np.unique(own["key"].to_numpy(np.int64))
            n = np.zeros((len(keys), n_lang))
            n[np.searchsorted(keys, own["key"].to_numpy(np.int64)), own["lang"].map(column).to_numpy(np.int64)] = own["n"]
            contexts, of = np.unique(keys >> 8, return_inverse=True)
            total, kinds = np.zeros((len(contexts), n_lang)), np.zeros((len(contexts), n_lang))
            np.add.at(total, of, n)
            np.add.at(kinds, of, (n > 0).astype(float))
            with np.errstate(divide="ignore", invalid="ignore"):
                # A context that a language has never seen passes on at no cost.
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                seen = -np.log2(n / (total + kinds)[of])
            below = np.full((len(keys), n_lang), 8.0)  # order -1: every byte alike
            if k:
                short = keys & ((1 << (8 * k)) - 1)
                below = shorter[np.searchsorted(shorter_keys, short)]
            code = np.where(n > 0, seen, escape[of] + below)
            self.codes.append(Table(keys, code))
            self.escapes.append(Table(contexts, escape))
            shorter_keys, shorter = keys, code

    def bits(self, text: str) -> np.ndarray:
        """Code length of a whole text under each language."""
        data = np.frombuffer(text.encode(), np.uint8)
        total = np.zeros(len(self.languages))
        order = len(self.codes) - 1
        for start in range(0, len(data), CHUNK):  # with the bytes before as context
            lead = min(order, start)
            keys = _contexts(data[start - lead : start + CHUNK], order)[lead:]
            for k in range(order, -1, -1):
                short = keys & ((1 << (8 * (k + 1))) - 1)
                found = self.codes[k].find(short)
                total += self.codes[k].rows[found].sum(0, dtype=np.float64)
                missed = found == 0
                if not missed.any():
                    break
                keys = keys[missed]
                at = self.escapes[k].find(short[missed] >> 8)
                total += self.escapes[k].rows[at].sum(0, dtype=np.float64)
            else:
                total += 8.0 * len(keys)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and the posterior chance of it, languages being alike beforehand."""
        if not self.languages or not text or not _LETTER.search(text):
            return UNKNOWN, 0.0
        bits = self.bits(text)
        best = int(bits.argmin())
        return self.languages[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum())


def fit(df: DataFrame, order: int = ORDER, per_language: int = PER_LANGUAGE) -> Model:
    """A model from ``df`` (doc_id, text, lang), without the held-out documents."""
    counted = stage(counts(sample(df, per_language), order)).toPandas()
    return Model(counted.astype({"key": "int64", "k": "int64"}), order)


def identify(df: DataFrame, carry: list[str], model: Model) -> DataFrame:
    """``row``, ``lang_pred`` and ``score`` per row of ``df``, from its texts alone."""
    rows = df.select(packed(df, carry).alias("row"), F.col("text").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return rows.select("row", predict("text").alias("p")).select("row", "p.lang_pred", "p.score")
