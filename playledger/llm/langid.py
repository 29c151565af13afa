"""Language identification as a mixture: proportions of languages per text by EM."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playledger.llm.common import small_batches, text_slices
from playledger.llm.words import LOWER

GRAM = 4
BUCKETS = 1 << 17
ROUNDS = 8
UNKNOWN = "und"
FOREIGN = 2 / 3
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass(frozen=True)
class Model:
    """Languages, log probabilities (bucket, language) of hashed byte n-grams of words, and background.

    `background` is the mean log probability per n-gram, per language, under which a text is not in it.
    """

    languages: tuple[str, ...]
    logs: np.ndarray
    background: np.ndarray


def word_grams(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each n-gram, start of each word's n-grams, and text index of each word.

    A word is a run of ASCII letters and bytes outside ASCII, A-Z in lower case, with a mark
    before it; a word of k bytes has k n-grams, each ending at one of its bytes.
    """
    n = len(data)
    letters = _LETTER[data] if n else np.zeros(0, bool)
    if not letters.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    fresh = np.zeros(n, bool)
    fresh[edges[:-1][edges[:-1] < n]] = True
    first = letters & (np.concatenate(([True], ~letters[:-1])) | fresh)
    low = np.where(letters, LOWER[data], 0).astype(np.uint32)
    at = np.flatnonzero(letters)
    opens = np.flatnonzero(first[at])
    depth = np.arange(len(at)) - np.repeat(opens, np.diff(np.append(opens, len(at))))
    key = low[at]
    for back in range(1, GRAM):
        before = np.where(depth >= back, low[np.maximum(at - back, 0)], np.uint32(1))
        before = np.where(depth >= back - 1, before, np.uint32(0))
        key = key * np.uint32(0x01000193) ^ before * np.uint32(0x9E3779B1)
    key ^= key >> np.uint32(15)
    key *= np.uint32(0x85EBCA6B)
    key ^= key >> np.uint32(13)
    owner = np.searchsorted(edges, at[opens], "right") - 1
    return (key & np.uint32(BUCKETS - 1)).astype(np.int64), opens, owner


def fit(docs: DataFrame, train: Column) -> Model:
    """Counts n-grams per language over all rows of `docs(text, lang)` that `train` selects.

    Each task sends one dense count vector per language it has seen, and Spark sums them; the
    result is BUCKETS rows per language, whatever the size of the corpus.
    """
    small_batches(docs.sparkSession)

    def counted(batches):
        sums: dict[str, np.ndarray] = {}
        for rows, data, edges in text_slices(batches, "text"):
            grams, opens, owner = word_grams(data, edges)
            langs = np.array(rows.column(1).to_pylist(), object)
            names, code = np.unique(langs.astype(str), return_inverse=True)
            of_gram = np.repeat(code[owner], np.diff(np.append(opens, len(grams))))
            found = np.bincount(of_gram * BUCKETS + grams, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
            for name, more in zip(names.tolist(), found):
                sums[name] = sums.get(name, 0) + more
        for name, total in sums.items():
            used = np.flatnonzero(total)
            columns = [pa.array([name] * len(used), pa.string()), pa.array(used), pa.array(total[used])]
            yield pa.record_batch(columns, ["lang", "bucket", "n"])

    rows = docs.filter(train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    sums = rows.mapInArrow(counted, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found: pd.DataFrame = sums.toPandas()
    languages = tuple(sorted(found["lang"].unique()))
    counts = np.full((BUCKETS, len(languages)), 0.5)
    where = {name: k for k, name in enumerate(languages)}
    counts[found["bucket"].to_numpy(np.int64), found["lang"].map(where).to_numpy(np.int64)] += found["n"].to_numpy(float)
    logs = np.log(counts / counts.sum(0))
    return Model(languages, logs.astype(np.float32), background(counts, logs))


def background(counts: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Per language, the level FOREIGN of the way from how its own text reads to how it reads where it is not learned.

    Own: mean log probability of its n-grams, each left out of the counts. Foreign: the mean under the likeliest other
    language, or even odds for all buckets where there is none.
    """
    seen = counts - 0.5
    share = seen / np.maximum(seen.sum(0), 1)
    own = (share * np.log(np.maximum(counts - 1, 0.5) / (counts.sum(0) - 1))).sum(0)
    across = share.T @ logs
    np.fill_diagonal(across, -np.inf)
    foreign = across.max(1, initial=-np.inf)
    foreign = np.where(np.isfinite(foreign), foreign, -np.log(BUCKETS))
    return own + FOREIGN * np.minimum(foreign - own, 0)


def mixture(likelihood: np.ndarray, first: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM per text over its words: proportions (text, language) and log likelihood per text.

    `likelihood` (word, language) is scaled so that a word's best language has 1; `first` is
    each text's first word; `allowed` (text, language) is its language set.
    """
    sizes = np.diff(np.append(first, len(likelihood)))
    shares = allowed / allowed.sum(1, keepdims=True)
    for _ in range(ROUNDS):
        joint = likelihood * np.repeat(shares, sizes, axis=0)
        joint /= joint.sum(1, keepdims=True) + 1e-30
        shares = np.add.reduceat(joint, first, axis=0) / sizes[:, None]
    joint = (likelihood * np.repeat(shares, sizes, axis=0)).sum(1)
    return shares, np.add.reduceat(np.log(joint + 1e-30), first)


def language_sets(likelihood: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Proportions under the language set with the best penalised likelihood, per text.

    A set of k languages costs (k - 1) * log(n words) / 2 nats and a fixed price. All languages together bound what any
    set can reach; where one language alone comes within the least price of that bound it
    is taken at once, elsewhere the weakest language is dropped as long as that pays.
    """
    n_texts, n_langs = len(first), likelihood.shape[1]
    sizes = np.diff(np.append(first, len(likelihood)))
    price = 1.0 + 0.5 * np.log(sizes)
    single = np.add.reduceat(np.log(likelihood + 1e-30), first, axis=0)
    best = single.argmax(1)
    out = np.zeros((n_texts, n_langs))
    out[np.arange(n_texts), best] = 1.0
    shares, bound = mixture(likelihood, first, np.ones((n_texts, n_langs)))
    todo = np.flatnonzero(single[np.arange(n_texts), best] < bound - price)
    if not len(todo):
        return out
    rows = np.concatenate([np.arange(first[i], first[i] + sizes[i]) for i in todo])
    words, sizes, price = likelihood[rows], sizes[todo], price[todo]
    starts = np.cumsum(sizes) - sizes
    shares, score = shares[todo], bound[todo] - (n_langs - 1) * price
    allowed = np.ones_like(shares)
    kept = shares.copy()
    top = single[todo].max(1)
    for left in range(n_langs - 1, 1, -1):
        weakest = np.where(allowed > 0, shares, np.inf).argmin(1)
        allowed[np.arange(len(todo)), weakest] = 0
        shares, bound = mixture(words, starts, allowed)
        better = bound - (left - 1) * price > score
        kept[better] = shares[better]
        score = np.maximum(score, bound - (left - 1) * price)
    mixed = score > top
    out[todo[mixed]] = kept[mixed]
    return out


def identify(docs: DataFrame, model: Model, evidence: str | None = None) -> DataFrame:
    """Adds lang_pred, score (its share of the text) and n_languages to every row of `docs`.

    `und` with score 0 where the text is null or has no letter, or nothing was learned. Ties go
    to the language first in order of its name. Other columns are passed through untouched,
    also under these names' clashes: the result's own columns then replace them. No shuffle.
    `evidence` names one more column: mean log likelihood per n-gram under the text's languages
    over that of their backgrounds; below 0 the text is in none of them, null where it is `und`.
    """
    spark = docs.sparkSession
    small_batches(spark)
    logs, languages, floor = model.logs, model.languages, model.background
    docs = docs.drop("lang_pred", "score", "n_languages", "__letters")
    names = [*docs.columns, "lang_pred", "score", "n_languages", *([evidence] if evidence else [])]
    lettered = docs.withColumn("__letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def predicted(batches):
        for rows, data, edges in text_slices(batches, "text"):
            n = rows.num_rows
            shares, over = np.zeros((n, max(1, len(languages)))), np.zeros(n)
            grams, opens, owner = word_grams(data, edges)
            if len(grams) and languages:
                by_word = np.add.reduceat(logs[grams], opens, axis=0)
                top = by_word.max(1, keepdims=True)
                likelihood = np.exp(by_word - top).astype(np.float64)
                texts, first = np.unique(owner, return_index=True)
                shares[texts] = language_sets(likelihood, first)
                if evidence:
                    joint = (likelihood * shares[owner]).sum(1)
                    total = np.add.reduceat(np.log(joint + 1e-30) + top[:, 0].astype(np.float64), first)
                    n_grams = np.diff(np.append(opens[first], len(grams)))
                    over[texts] = total / n_grams - shares[texts] @ floor
            letters = rows.column(rows.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            best = shares.argmax(1)
            found = letters & (shares.max(1) > 0)
            labels = [languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), found.tolist())]
            columns = [
                *rows.columns[:-1],
                pa.array(labels, pa.string()),
                pa.array(np.where(found, np.clip(shares.max(1), 0.0, 1.0), 0.0)),
                pa.array(np.where(found, (shares > 0.01).sum(1), 0), pa.int32()),
                *([pa.array(over, mask=~found)] if evidence else []),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = StructType(docs.schema.fields).add("lang_pred", "string").add("score", "double").add("n_languages", "integer")
    schema = schema.add(evidence, "double") if evidence else schema
    return lettered.mapInArrow(predicted, schema)
