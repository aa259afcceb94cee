"""Language identification with error-correcting output codes.

Each language has a codeword. One binary classifier per bit, a weight for each hashed run of bytes, says how far a text
leans to the languages whose codeword has that bit. Decoding sums over the bits a loss of the classifier's margin, weighted
by how well the bit did in training, and takes the codeword of least loss. A text whose best two codewords are nearly as
near is flagged as ambiguous.

The classifiers are fitted on a bounded sample: about ``per_language`` labelled rows of each language, chosen by a hash of
the id. Their runs are counted and added up in Spark, and the driver gets one row of counts for each language, a quarter of a
megabyte. Texts are read whole, in training and in prediction; a prediction sees nothing but the text.

Defined results: a null text, or one without a letter, is ``und`` with score 0; without labelled rows every text is ``und``;
a null id is held out of training; more than ``MOST_LANGUAGES`` labels raise, none is dropped; ties go to the language that sorts first; rows repeat as in the input; an empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import fresh, place_of, shuffle_partitions

#: Rows of each language from which the classifiers learn, at most about.
PER_LANGUAGE = 600
#: Bits of a feature's number, bytes in the runs, bits of a codeword for many languages, steepness of the loss, and the
#: least difference of two losses that is not ambiguous.
FEATURE_BITS, RUNS, BITS_PER_LOG, STEEP, UNSURE = 16, (2, 3, 4), 10, 8.0, 0.1
#: Labels that a model may have.
MOST_LANGUAGES = 500
UND = "und"
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[ord("A") : ord("Z") + 1] += 32
_PLAIN[[c for c in range(128) if not chr(c).isalpha()]] = 32


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, of -1 and 1
    weights: np.ndarray  # features + 1 x bits; the last feature is none
    trust: np.ndarray  # bits


def codewords(n: int) -> np.ndarray:
    """All splits of up to six languages; random words of about ten bits for each doubling beyond, all different."""
    if n <= 6:
        bits = max(1, 2 ** (n - 1) - 1)
        words = [[1] * bits] + [[1 if (c >> i) & 1 else -1 for c in range(bits)] for i in range(n - 1)]
        return np.array(words[:n], np.float32)
    rng = np.random.default_rng(7)
    while True:
        code = rng.choice(np.array([-1, 1], np.float32), (n, int(BITS_PER_LOG * np.ceil(np.log2(n)))))
        if len(np.unique(code, axis=0)) == n and (np.abs(code.sum(0)) < n).all():
            return code


def _features(data: np.ndarray, offsets: np.ndarray):
    """For slices of the joined bytes: each place's text, and its feature for each length of run."""
    none = np.int64(1 << FEATURE_BITS)
    step = K.SLICE // 4
    for lo in range(0, len(data), step):
        hi = min(len(data), lo + step)
        text, left = K.room(offsets, lo, hi)
        values = _PLAIN[data[lo : hi + max(RUNS)]].astype(np.uint64)
        out = []
        for n in RUNS:
            part = np.zeros(hi - lo, np.uint64)
            for k in range(n):
                piece = values[k : hi - lo + k]
                part[: len(piece)] |= piece << K.U(8 * k)
            f = (K.mix(part, n) >> K.U(64 - FEATURE_BITS)).astype(np.int64)
            f[left < n] = none
            out.append(f)
        yield text, out


def _margins(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    total, count = np.zeros((n, model.weights.shape[1])), np.zeros(n)
    for text, features in _features(data, offsets):
        runs = K.run_starts(text)
        at = text[runs]
        for f in features:
            total[at] += np.add.reduceat(model.weights[f], runs, axis=0)
            count[at] += np.add.reduceat((f < 1 << FEATURE_BITS).astype(np.int64), runs)
    return total / np.maximum(count, 1)[:, None]


def _losses(model: Model, margins: np.ndarray) -> np.ndarray:
    """Texts x languages."""
    out = np.empty((len(margins), len(model.languages)))
    for i, word in enumerate(model.code):
        out[:, i] = (model.trust * np.logaddexp(0, -STEEP * margins * word)).sum(1)
    return out


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row's id keeps it out of training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} labels in {lang_col}")
    whole = (1 << 63) - 1
    if not counts:
        return rows.where(F.lit(False))
    limit = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], whole if r["n"] <= per_language else whole // r["n"] * per_language)])
    return rows.where(F.xxhash64("doc_id").bitwiseAND(F.lit(whole)) <= limit[F.col("lang")])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """Fit the classifiers, or None if no row is labelled."""
    features = (1 << FEATURE_BITS) + 1

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            data, offsets = K.joined(batch.column("text"))
            for text, found in _features(data, offsets):
                lang = langs[text]
                for name in set(lang.tolist()):
                    mine = total.setdefault(name, np.zeros(features, np.int64))
                    at = lang == name
                    for f in found:
                        mine += np.bincount(f[at], minlength=features)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([t.astype(np.uint32).tobytes() for t in total.values()], pa.binary())], names=["lang", "counts"])

    def add(key, rows):
        total = np.zeros(features, np.int64)
        for x in rows.column("counts"):
            total += np.frombuffer(x.as_py(), np.uint32)
        return pa.table([pa.array([key[0].as_py()], pa.string()), pa.array([np.minimum(total, (1 << 32) - 1).astype(np.uint32).tobytes()], pa.binary())], names=["lang", "counts"])

    # the scan keeps its tasks; only the sample, which is bounded, is brought together before it is counted
    sample = _sample(docs, id_col, text_col, lang_col, per_language).repartition(shuffle_partitions(docs.sparkSession))
    counted = sample.mapInArrow(count, "lang string, counts binary").groupBy("lang").applyInArrow(add, "lang string, counts binary")
    counts = {row["lang"]: np.frombuffer(row["counts"], np.uint32).astype(np.int64) for row in counted.toLocalIterator()}
    if not counts:
        return None
    languages = sorted(counts)
    code = codewords(len(languages))
    share = np.stack([(counts[x][:-1] + 0.05) / (counts[x][:-1] + 0.05).sum() for x in languages])
    weights = np.zeros((features, code.shape[1]), np.float32)
    for b in range(code.shape[1]):
        yes, no = code[:, b] > 0, code[:, b] < 0
        if yes.any() and no.any():
            weights[:-1, b] = np.log(share[yes].mean(0)) - np.log(share[no].mean(0))
    # a bit counts as much as its mean margin on the languages it learned from stands out
    lean = (share @ weights[:-1]) * code
    trust = np.maximum(lean.min(0), 0.05) if len(languages) > 1 else np.ones(code.shape[1])
    return Model(languages, code, weights, trust / trust.mean())


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """The rows of docs with three more columns, and their names: predicted language, score, whether it is ambiguous."""
    names = [fresh(docs.columns, n) for n in ("_lang_pred", "_score", "_ambiguous")]
    if model is None:
        return docs.withColumns(dict(zip(names, (F.lit(UND), F.lit(0.0), F.lit(True)), strict=True))), names
    letter = fresh([*docs.columns, *names], "_letter")
    marked = docs.withColumn(letter, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    column = place_of(docs, text_col)

    def run(batches):
        for batch in batches:
            data, offsets = K.joined(batch.column(column))
            has_letter = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            losses = _losses(model, _margins(model, data, offsets))
            order = np.argsort(losses, axis=1, kind="stable")
            best = losses[np.arange(len(losses)), order[:, 0]]
            odds = np.exp(-(losses - best[:, None]))
            apart = (losses[np.arange(len(losses)), order[:, 1]] - best) if len(model.languages) > 1 else np.ones(len(losses))
            said = [model.languages[i] if ok else UND for i, ok in zip(order[:, 0].tolist(), has_letter.tolist(), strict=True)]
            more = [pa.array(said, pa.string()), pa.array(np.where(has_letter, 1 / odds.sum(1), 0.0)), pa.array(~has_letter | (apart < UNSURE))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *more], names=[*batch.schema.names[:-1], *names])

    schema = docs.withColumns(dict(zip(names, (F.lit(""), F.lit(0.0), F.lit(True)), strict=True))).schema
    return marked.mapInArrow(run, schema), names


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, ambiguous."""
    model = train(docs, id_col, text_col, lang_col, per_language)
    rows, names = predict(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    said = [F.col(n).alias(x) for n, x in zip(names, ("lang_pred", "score", "ambiguous"), strict=True)]
    return rows.select("doc_id", held_out().alias("held_out"), *said)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """The documents with an identified language, with their own columns."""
    rows, names = predict(docs, train(docs, id_col, text_col, lang_col, per_language), text_col)
    return rows.where(F.col(names[0]) != UND).select(*docs.columns)
