"""Language identification by multilingual mixture inference (operator 8).

A language's model is the smoothed distribution of its hashed letter trigrams (lower-cased, words
padded by a space).  A document is a mixture: expectation-maximisation over its n-gram counts
estimates the proportion of each language, and the language set is chosen by penalised likelihood:
starting from all languages, the one with the smallest proportion is dropped as long as the
log-likelihood lost is under ``PENALTY`` times the logarithm of the number of trigrams.  The
prediction is the language with the largest proportion in the chosen set, the score that proportion.

Training reads only text and language of the labelled rows it is given, at most ``TRAIN_DOCS`` of
each language (chosen by a hash of the id); the model is ``BUCKETS`` counts per language, so what
reaches the driver does not grow with the corpus.  Prediction is one pass over whole texts; long
texts are counted in slices, their counts summed.  Where ``wanted`` languages are named, an even
component stands for all languages that were not learnt, and ``share`` is what the wanted ones hold.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without any labelled
row every prediction is ``und``; ties go to the first language by name; repeated rows are predicted
each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Collection, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemstats.llm import common

BUCKETS = 1 << 15
TRAIN_DOCS = 1500
#: Log-likelihood a further language must gain, times the logarithm of the number of trigrams.
PENALTY = 4.0
ITERATIONS = 12
SMOOTHING = 0.05
#: Letters handled at once, so that a batch of very long texts stays within memory.
SLICE = 1 << 20
UNKNOWN = "und"
#: Probability of each trigram in a language that was not learnt, in parts of the mean one.  Well under 1, so that
#: trigrams not seen in few labelled rows speak against no text.
STRANGE = 0.1


@cache
def letters() -> np.ndarray:
    """Code point to its lower-case letter, 0 for all that is no letter."""
    out = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in range(sys.maxunicode + 1):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def grams(text: str) -> np.ndarray:
    """Hashed trigrams of the letters of a text; runs of other characters count as one space."""
    c = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    gap = c == 0
    if gap.all():
        return np.zeros(0, np.int64)
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    c = np.concatenate([[0], c[keep], [0]]).astype(np.uint32)
    h = (c[:-2] * np.uint32(0x9E3779B1) + c[1:-1]) * np.uint32(0x85EBCA6B) + c[2:]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(32 - 15)).astype(np.int64)[c[1:-1] != 0]


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed trigrams and their counts, slice by slice; slices end at white space where
    there is any."""
    if len(text) <= SLICE:
        return np.unique(grams(text), return_counts=True)
    total, at = np.zeros(BUCKETS, np.int64), 0
    while at < len(text):
        end = text.rfind(" ", at + 1, at + SLICE) if at + SLICE < len(text) else len(text)
        end = end if end > at else at + SLICE
        total += np.bincount(grams(text[at:end]), minlength=BUCKETS)
        at = end
    found = np.flatnonzero(total)
    return found, total[found]


def train(docs: DataFrame, text: str, lang: str, labelled: Column, order: Column, limit: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities (bucket, language) from the ``labelled`` rows.  Where a
    language has more than about ``limit`` rows, the rows with the smallest hashes are taken."""
    own = docs.filter(labelled & F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(order).alias("h"))
    sizes = {r[0]: r[1] for r in own.groupBy("lang").count().collect()}  # one row per language
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((BUCKETS, 0))
    share = F.create_map([F.lit(x) for la in langs for x in (la, limit / sizes[la])])
    position = (F.col("h").bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))).cast("double")
    sample = own.filter(F.col("text").isNotNull() & (position < share[F.col("lang")])).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for la, t in zip(b["lang"], b["text"]):
                found, n = counts(t)
                total.setdefault(la, np.zeros(BUCKETS, np.int64))[found] += n
        for la, n in total.items():
            found = np.flatnonzero(n)
            yield pd.DataFrame({"lang": la, "bucket": found, "n": n[found]})

    rows = sample.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    model = np.full((BUCKETS, len(langs)), SMOOTHING)
    for la, own_rows in rows.groupby("lang"):
        model[own_rows["bucket"].to_numpy(), langs.index(la)] += own_rows["n"].to_numpy()
    return langs, np.log(model / model.sum(axis=0))


class Batch:
    """N-grams of many documents one after the other; sums per document are segment sums."""

    def __init__(self, found: list[np.ndarray], n: list[np.ndarray], model: np.ndarray):
        sizes = np.array([len(f) for f in found])
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.owner = np.repeat(np.arange(len(found)), sizes)
        self.weight = np.concatenate(n).astype(float)
        logp = model[np.concatenate(found)]
        self.logp = logp - logp.max(axis=1, keepdims=True)
        self.p = np.exp(self.logp)
        self.letters = self.sums(self.weight)

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts, axis=0)

    def fit(self, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expectation-maximisation: proportions of the active languages, and the log-likelihood."""
        pi = active / active.sum(axis=1, keepdims=True)
        for _ in range(ITERATIONS):
            joint = self.p * pi[self.owner]
            joint *= (self.weight / joint.sum(axis=1))[:, None]
            new = self.sums(joint) / self.letters[:, None]
            moved = np.abs(new - pi).max()
            pi = new
            if moved < 1e-3:
                break
        return pi, self.sums(self.weight * np.log((self.p * pi[self.owner]).sum(axis=1)))


def mixtures(found: list[np.ndarray], n: list[np.ndarray], model: np.ndarray) -> np.ndarray:
    """Proportions per document of the languages in its chosen set (0 outside it)."""
    batch, k = Batch(found, n, model), model.shape[1]
    price = PENALTY * np.log1p(batch.letters)
    pi, like = batch.fit(np.ones((len(found), k)))
    single = batch.sums(batch.weight[:, None] * batch.logp)
    out = np.eye(k)[single.argmax(axis=1)]
    # no set gains more than all languages do: most documents are settled here
    several = np.flatnonzero(like - single.max(axis=1) > price)
    if len(several):
        batch = Batch([found[i] for i in several], [n[i] for i in several], model)
        pi, like, price = pi[several], like[several], price[several]
        active, open_ = np.ones_like(pi), np.ones(len(several), bool)
        while (open_ := open_ & (active.sum(axis=1) > 1)).any():
            smaller, rows = active.copy(), np.flatnonzero(open_)
            smaller[rows, np.where(active > 0, pi, 2.0)[rows].argmin(axis=1)] = 0
            pi2, like2 = batch.fit(smaller)
            open_ &= like - like2 < price
            active[open_], pi[open_], like[open_] = smaller[open_], pi2[open_], like2[open_]
        out[several] = np.where(active > 0, pi, 0.0)
    return out


def predict(docs: DataFrame, langs: list[str], model: np.ndarray, text: str = "text", keep: list[Column] | None = None, wanted: Collection[str] | None = None) -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score`` and ``languages`` (the chosen set with proportions); with
    ``wanted``, languages not learnt are a component (``und``) and ``share`` is the proportion of the wanted ones."""
    if wanted is not None:
        chosen = np.array([la in wanted for la in langs] + [False])
        langs, model = [*langs, UNKNOWN], np.column_stack([model, np.full(BUCKETS, np.log(STRANGE / BUCKETS))])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows, one column per language
    rows = docs.select(*(keep or []), F.col(text).cast("string").alias("_text"))
    names = rows.columns[:-1]
    schema = rows.drop("_text").schema.add("lang_pred", "string").add("score", "double").add("languages", "string")
    if wanted is not None:
        schema = schema.add("share", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred, score, sets, share = [UNKNOWN] * b.num_rows, [0.0] * b.num_rows, [""] * b.num_rows, [0.0] * b.num_rows
            group: list[tuple] = []

            def flush() -> None:
                if group:
                    pi = mixtures([g[1] for g in group], [g[2] for g in group], shared.value)
                    for (row, _, _), own in zip(group, pi):
                        best = int(own.argmax())
                        pred[row], score[row] = langs[best], min(1.0, float(own[best]))
                        sets[row] = ",".join(f"{langs[i]}:{own[i]:.3f}" for i in np.flatnonzero(own))
                        if wanted is not None:
                            share[row] = float(own[chosen].sum())
                    group.clear()

            size = 0
            for row, t in enumerate(b.column(b.num_columns - 1)):
                t = t.as_py()
                found, n = counts(t) if t and langs else ((), ())
                if len(found):
                    group.append((row, found, n))
                    size += len(found)
                    if size > 200_000:
                        flush()
                        size = 0
            flush()
            out = [pa.array(pred), pa.array(score), pa.array(sets), *([pa.array(share)] if wanted is not None else [])]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(names))], *out], names=schema.names)

    return common.map_in_arrow(rows, run, schema)


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, languages``: learns from the rows whose
    crc32(doc_id as text) mod 4 is not 2 and predicts all."""
    held_out = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
    langs, model = train(docs, text, lang, ~held_out, F.col(doc_id))
    return predict(docs, langs, model, text, [F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out")])
