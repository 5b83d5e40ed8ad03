"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed character n-grams (1 to 3 lower-case
characters, non-letters folded to one blank), scaled to length 1.  Document
frequencies are counted over all training documents.  The model is trained by
follow-the-regularised-leader with elastic-net penalties (FTRL-proximal) on
fixed shards of a bounded sample; after every pass the shards' states are
averaged.  A held-back part of the sample then sets one temperature, so that
the score is a calibrated probability.

Cases: NULL text or text without a letter is ``und`` with score 0; NULL
languages are never learned from; repeated rows count as often as they occur;
an empty training table gives ``und`` everywhere; texts are used whole; only
``doc_id``, ``text`` and (for training) ``lang`` are read, whatever other
columns there are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfold.llm.token_memo import text_batches
from clickfold.session import write_table

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    bits: int = 15              # hash space of the n-grams
    max_training_docs: int = 12_000   # bound of the sample the model is fitted on
    calibration_part: int = 5   # one in so many of the sample sets the temperature
    shards: int = 8             # fixed, so that a fit does not depend on the cluster
    updates: int = 20_000       # learning steps aimed at: small samples take more passes
    max_passes: int = 20
    alpha: float = 0.5          # FTRL step size
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.5
    max_languages: int = 500    # bound of the model's size; more raise an error


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray             # [2**bits]
    weights: np.ndarray         # [2**bits, languages]
    bias: np.ndarray            # [languages]
    temperature: float
    bits: int

    def scores(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=-1, keepdims=True))
        return z / z.sum(axis=-1, keepdims=True)


_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    """Whether the text has a character of a Unicode letter category."""
    if not text:
        return False
    return bool(_LETTER.search(text)) or any(c.isalpha() for c in set(text))


_FOLD = np.zeros(0x110000, np.uint32)


def _fold_table() -> np.ndarray:
    """Code point -> lower-case letter, or 32 for all else (made once)."""
    if not _FOLD[32]:
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                _FOLD[c] = ord(low) if len(low) == 1 else c
            else:
                _FOLD[c] = 32
    return _FOLD


def ngram_counts(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashed n-grams of a text and how often each occurs."""
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    x = np.concatenate([[32], _fold_table()[x], [32]]).astype(np.uint64)
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
    x = x[keep]
    one = x * np.uint64(0x9E3779B97F4A7C15)
    two = (one[:-1] ^ (one[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + one[2:]
    shift = np.uint64(64 - bits)
    h = np.concatenate([one[x != 32] * np.uint64(3) >> shift,
                        two * np.uint64(0xD6E8FEB86659FD93) >> shift,
                        three * np.uint64(0xA0761D6478BD642F) >> shift]).astype(np.int64)
    c = np.bincount(h, minlength=1 << bits)
    at = np.flatnonzero(c)
    return at, c[at]


def features(text: str, idf: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    at, n = ngram_counts(text, bits)
    v = (1.0 + np.log(n)) * idf[at]
    norm = np.sqrt(v @ v)
    return at, v / norm if norm > 0 else v


def document_frequencies(train: DataFrame, bits: int) -> tuple[int, np.ndarray]:
    """Documents and, per hashed n-gram, the documents that hold it.  Tasks
    count for themselves; 2**bits sums reach the driver."""
    def count(batches):
        df, docs = np.zeros(1 << bits, np.int64), 0
        for _, texts in text_batches(batches):
            for t in texts:
                if has_letter(t):
                    at, _ = ngram_counts(t, bits)
                    df[at] += 1
                    docs += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(df[at], docs))], ["gram", "n"])

    rows = (train.select("text").mapInArrow(count, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).toArrow())
    gram, n = rows["gram"].to_numpy(), rows["n"].to_numpy()
    df = np.zeros(1 << bits, np.int64)
    df[gram[gram >= 0]] = n[gram >= 0]
    return int(n[gram < 0].sum()), df


def training_sample(train: DataFrame, s: Settings) -> DataFrame:
    """At most about ``max_training_docs`` labelled documents, by the hash of
    doc_id and text, the same share of each language up to an equal number."""
    labelled = train.where(F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    counts = [(r["lang"], r["n"]) for r in labelled.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n")).limit(s.max_languages + 1).collect()]
    if len(counts) > s.max_languages:
        raise ValueError(f"more than {s.max_languages} languages")
    if not counts:
        return labelled.withColumn("_h", F.lit(0).cast("long")).where("false")
    each = max(1, s.max_training_docs // len(counts))
    share = F.create_map(*[x for lang, n in sorted(counts) for x in
                           (F.lit(lang), F.lit(min(1.0, each / n)))])
    h = F.xxhash64(F.col("doc_id"), F.col("text"))
    picked = labelled.withColumn("_h", F.pmod(h, F.lit(1 << 40)))
    return picked.where(F.col("_h") < F.try_element_at(share, F.col("lang")) * (1 << 40))


class Ftrl:
    """FTRL-proximal states ``z`` and ``n`` of one weight matrix."""

    def __init__(self, z: np.ndarray, n: np.ndarray, s: Settings):
        self.z, self.n, self.s = z, n, s

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n, s = self.z[at], self.n[at], self.s
        w = -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)
        return np.where(np.abs(z) <= s.l1, 0.0, w)

    def learn(self, at: np.ndarray, v: np.ndarray, y: int) -> None:
        w = self.weights(at)
        logits = v @ w
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[y] -= 1.0
        g = v[:, None] * p[None, :]
        old = self.n[at]
        new = old + g * g
        self.z[at] += g - (np.sqrt(new) - np.sqrt(old)) / self.s.alpha * w
        self.n[at] = new


def _sparse_sample(sample: DataFrame, idf: np.ndarray, languages: list[str], s: Settings) -> DataFrame:
    """Shard, class and sparse features of each sampled document; the last
    feature, always 1, is the bias."""
    shared = sample.sparkSession.sparkContext.broadcast(idf)
    number = {x: i for i, x in enumerate(languages)}

    def make(batches):
        for batch, texts in text_batches(batches):
            rows = []
            for h, lang, t in zip(batch.column("_h").to_pylist(),
                                  batch.column("lang").to_pylist(), texts):
                if has_letter(t):
                    at, v = features(t, shared.value, s.bits)
                    rows.append((h, number[lang], np.append(at, 1 << s.bits).astype("<i4").tobytes(),
                                 np.append(v, 1.0).astype("<f4").tobytes()))
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                     pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())],
                    ["h", "y", "at", "v"])

    out = sample.select("_h", "lang", "text").mapInArrow(make, "h long, y int, at binary, v binary")
    return out.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(s.shards)).cast("long")) \
        .withColumn("held", F.pmod(F.xxhash64("h", F.lit(7)), F.lit(s.calibration_part)) == 0)


def fit(train: DataFrame, s: Settings = Settings()) -> Model:
    """Train on ``doc_id, text, lang``.  The driver holds the model and, per
    pass, the states of ``shards`` shards; the documents stay in tasks."""
    bits, width = s.bits, (1 << s.bits) + 1
    docs, df = document_frequencies(train, bits)
    idf = np.where(df > 0, np.log((1.0 + docs) / (1.0 + df)) + 1.0, 0.0)
    sample = training_sample(train, s)
    languages = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    k = len(languages)
    if not k:
        return Model([], idf, np.zeros((1 << bits, 0)), np.zeros(0), 1.0, bits)
    sparse = write_table(_sparse_sample(sample, idf, languages, s), name="sample")
    sc = train.sparkSession.sparkContext
    z, n = np.zeros((width, k)), np.zeros((width, k))
    learned = sparse.where("NOT held").count()
    for _ in range(min(s.max_passes, -(-s.updates // max(learned, 1)))):
        state = sc.broadcast((z, n))

        def learn(key, table):
            own = Ftrl(*(x.copy() for x in state.value), s)
            order = np.lexsort((table["y"].to_numpy(), table["h"].to_numpy()))
            rows = table.select(["at", "v", "y"]).take(order)
            for at, v, y in zip(*(rows[c].to_pylist() for c in ("at", "v", "y"))):
                own.learn(np.frombuffer(at, "<i4"), np.frombuffer(v, "<f4").astype(float), y)
            return pa.table({"shard": [key[0].as_py()], "docs": [len(rows)],
                             "z": [own.z.astype("<f4").tobytes()],
                             "n": [own.n.astype("<f4").tobytes()]})

        states = write_table(sparse.where(~F.col("held")).groupBy("shard").applyInArrow(
            learn, "shard long, docs long, z binary, n binary"), name="states")
        total, z_sum, n_sum = 0, np.zeros((width, k)), np.zeros((width, k))
        for row in states.orderBy("shard").toLocalIterator():
            total += row["docs"]
            z_sum += row["docs"] * np.frombuffer(row["z"], "<f4").reshape(width, k)
            n_sum += row["docs"] * np.frombuffer(row["n"], "<f4").reshape(width, k)
        if total:
            z, n = z_sum / total, n_sum / total
    w = Ftrl(z, n, s).weights()
    model = Model(languages, idf, w[:-1], w[-1], 1.0, bits)
    model.temperature = _temperature(sparse.where("held"), model)
    return model


def _temperature(held: DataFrame, model: Model) -> float:
    """The temperature (0.25 to 20) with the least log loss on the held-back
    sample; the bound keeps a small separable sample from certainty."""
    rows = held.select("y", "at", "v").toLocalIterator()
    w = np.vstack([model.weights, model.bias])
    logits, ys = [], []
    for r in rows:
        logits.append(np.frombuffer(r["v"], "<f4").astype(float) @ w[np.frombuffer(r["at"], "<i4")])
        ys.append(r["y"])
    if not logits:
        return 1.0
    z, y = np.array(logits), np.array(ys)
    best = (np.inf, 1.0)
    for t in np.exp(np.linspace(np.log(0.25), np.log(20.0), 101)):
        q = z / t
        q = q - q.max(axis=1, keepdims=True)
        loss = float((np.log(np.exp(q).sum(axis=1)) - q[np.arange(len(y)), y]).mean())
        best = min(best, (loss, float(t)))
    return best[1]


def predict(docs: DataFrame, model: Model, carry: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score``; with ``carry`` the input row as ``_row``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cols = [F.col("doc_id"), F.col("text")]
    if carry:
        cols.append(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"))
    inner = docs.select(*cols)
    keep = [f for f in inner.schema.fields if f.name != "text"]
    names = [f.name for f in keep]
    schema = type(inner.schema)(list(keep)).add("lang_pred", "string").add("score", "double")

    def run(batches):
        m = shared.value
        for batch, texts in text_batches(batches):
            langs, scores = [], []
            for t in texts:
                if not m.languages or not has_letter(t):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                at, v = features(t, m.idf, m.bits)
                p = m.scores(v @ m.weights[at] + m.bias)
                k = int(p.argmax())
                langs.append(m.languages[k])
                scores.append(float(p[k]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(langs), pa.array(scores)],
                [*names, "lang_pred", "score"])

    return inner.mapInArrow(run, schema)


def is_held_out(doc_id: Column) -> Column:
    """The test fold: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Train on the documents outside the test fold and predict all."""
    fold = is_held_out(F.col("doc_id"))
    model = fit(docs.where(~fold).where(F.col("lang").isNotNull()), s)
    return predict(docs, model).select("doc_id", fold.alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5, s: Settings = Settings()) -> DataFrame:
    """The documents whose language is found with at least this score, with
    all their columns."""
    fold = is_held_out(F.col("doc_id"))
    model = fit(docs.where(~fold).where(F.col("lang").isNotNull()), s)
    scored = predict(docs, model, carry=True)
    return scored.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("_row.*")
