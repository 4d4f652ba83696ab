"""Language identification in two steps: family, then language inside the family.

A text becomes hashed counts of its letter pairs and triples (lower case, every run of
other characters is one blank). Linear support vector machines, one versus one, first
choose the language family; those of the family's languages then play one versus one, and
the most won duels (ties: the larger sum of margins, then the smaller code) give the
language. The score is the logistic of twice the least margin that the winner had on the
way, times the share of the text's letters that were seen in training.

Training uses the documents of the learning fold, ``per_language`` of each language (those
of the least hash; all where a language has fewer): a bounded sample of every language,
however many there are. The driver fits the duels; their number grows with the square of
the families, and of the languages in one.
Whole texts and random stretches of them are learned, so short texts are known too.
Prediction reads the whole of every text and nothing but the text.

Defined results:

* null text or text without a letter: ``und``, score 0;
* null lang: not learned from, predicted like any other; no learnable document: ``und``, 0;
* null doc_id: not held out, not learned from; repeated rows: each is returned;
* empty table: empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from zonepulse.llm.common import other_columns_aside, read_table, small_batches

DIM = 1 << 12
PER_LANGUAGE = 100
UNKNOWN = "und"
#: A pipeline keeps documents whose language is sure to this score.
MIN_SCORE = 0.45

#: Language families by ISO 639 code; a code not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("am", "ar", "he", "mt"),
}


def family(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang.lower().split("-")[0] in codes), lang)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letter_grams(text: str, tally: np.ndarray, piece: int = 1 << 20) -> np.ndarray:
    """Hashed counts (``DIM``) of letter pairs and triples of the whole text.

    ``tally`` is added up over the letters: a weight per code point (see ``LanguageModel``).
    Returns the counts with two numbers behind them: letters, and their weight.
    """
    counts, letters, carry = np.zeros(DIM + 2, np.int64), _letters(), np.array([32], np.uint32)
    for start in range(0, len(text), piece):
        low = text[start: start + piece].lower()
        c = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = letters[c]
        counts[DIM] += int(is_letter.sum())
        counts[DIM + 1] += int(tally[c[is_letter]].sum())
        c = np.where(is_letter, c, np.uint32(32))
        last = start + piece >= len(text)
        c = np.concatenate([carry, c, np.array([32] if last else [], np.uint32)])
        c = c[np.concatenate([[True], (c[1:] != 32) | (c[:-1] != 32)])]
        pair = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
        triple = pair[:-1] * np.uint32(0xC2B2AE3D) + c[2:] * np.uint32(0x27D4EB2F)
        fresh = len(carry) > 1 and len(pair)      # the carried pair is counted already
        counts[:DIM] += np.bincount(pair[1 if fresh else 0:] >> np.uint32(20), minlength=DIM)
        counts[:DIM] += np.bincount((triple ^ (triple >> np.uint32(15))) & np.uint32(DIM - 1), minlength=DIM)
        carry = c[-2:]
    return counts


def features(counts: np.ndarray) -> np.ndarray:
    """Square roots of the relative counts: a vector of length 1."""
    grams = counts[:DIM]
    return np.sqrt(grams / grams.sum()).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, rounds: int = 15, seed: int = 3) -> np.ndarray:
    """Linear SVM (squared hinge, bias as a last weight) by dual coordinate ascent; y is -1 or 1."""
    w, bias, alpha = np.zeros(x.shape[1]), 0.0, np.zeros(len(x))
    weight = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    diag = 1.0 / (2 * c * weight)
    norm = np.einsum("ij,ij->i", x, x) + 1.0 + diag
    order = np.arange(len(x))
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        rng.shuffle(order)
        for i in order:
            gradient = y[i] * (w @ x[i] + bias) - 1 + diag[i] * alpha[i]
            new = max(alpha[i] - gradient / norm[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                bias += (new - alpha[i]) * y[i]
                alpha[i] = new
    return np.append(w, bias).astype(np.float32)


class Duels:
    """One-versus-one classifiers of some classes."""

    def __init__(self, x: np.ndarray, labels: np.ndarray) -> None:
        self.classes = sorted(set(labels.tolist()))
        self.pairs = [(i, j) for i in range(len(self.classes)) for j in range(i)]
        rows = []
        for i, j in self.pairs:
            one = labels == self.classes[i]
            part = one | (labels == self.classes[j])
            rows.append(fit_svm(x[part], np.where(one[part], 1.0, -1.0)))
        self.weights = np.array(rows, np.float32).reshape(len(rows), x.shape[1] + 1)

    def best(self, x: np.ndarray) -> tuple[str, float]:
        """The winning class and its least margin (infinite without a rival)."""
        if not self.pairs:
            return self.classes[0], float("inf")
        margins = self.weights[:, :-1] @ x + self.weights[:, -1]
        won, total = np.zeros(len(self.classes)), np.zeros(len(self.classes))
        least = np.full(len(self.classes), np.inf)
        for (i, j), m in zip(self.pairs, margins.tolist()):
            won[i if m > 0 else j] += 1
            total[i] += m
            total[j] -= m
            least[i], least[j] = min(least[i], m), min(least[j], -m)
        k = max(range(len(self.classes)), key=lambda k: (won[k], total[k], -k))
        return self.classes[k], float(least[k])


class LanguageModel:
    """Duels of families, and of the languages inside each; ``alphabet``: the letters learned from."""

    def __init__(self, x: np.ndarray, langs: list[str], alphabet: set[str]) -> None:
        labels = np.array(langs, dtype=object)
        families = np.array([family(v) for v in langs], dtype=object)
        self.families = Duels(x, families)
        self.inside = {f: Duels(x[families == f], labels[families == f]) for f in self.families.classes}
        self.known = np.zeros(0x110000, bool)
        self.known[[ord(c) for c in alphabet]] = True

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: logistic of twice the least margin, times the share of known letters."""
        counts = letter_grams(text or "", self.known)
        letters, known = counts[DIM:].tolist()
        if not letters:
            return UNKNOWN, 0.0
        x = features(counts)
        chosen, margin = self.families.best(x)
        lang, inner = self.inside[chosen].best(x)
        return lang, float(known / letters / (1.0 + np.exp(-2.0 * min(margin, inner))))


def held_out(doc_id: Column) -> Column:
    """True for the fold that is never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Model of the learning fold of ``docs`` (doc_id, text, lang); None if nothing can be learned."""
    usable = (docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
                         & F.rlike("text", F.lit(r"\p{L}")))
              .select("doc_id", "lang", "text"))
    counts = dict(tuple(r) for r in usable.groupBy("lang").count().collect())
    if not counts:
        return None
    rank = F.xxhash64(F.lit(29), "doc_id")
    # twice the sample is let through by hash, so that the ranks of a language are a bounded job
    share = F.element_at(F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, 2.0 * per_language / n))]), F.col("lang"))
    unit = F.shiftrightunsigned(rank, 11) / F.lit(float(1 << 53))
    first = Window.partitionBy("lang").orderBy("_unit", F.xxhash64("text"))
    picked = (usable.where(F.col("lang").isin(list(counts))).withColumn("_unit", unit).where(F.col("_unit") < share)
              .withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= per_language)
              .select("doc_id", "lang", "text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_tally = np.zeros(0x110000, bool)
        for batch in batches:
            for _, lang, text, h in zip(*(batch.column(i).to_pylist() for i in range(4))):
                rnd, out = random.Random(h), []
                for span in (len(text), 300, 80):
                    at = rnd.randrange(max(1, len(text) - span + 1))
                    grams = letter_grams(text[at: at + span], no_tally)
                    if grams[DIM]:
                        x = features(grams)
                        at = np.flatnonzero(x)
                        out.append(at.astype(np.uint16).tobytes() + x[at].tobytes())   # six bytes an entry
                letters = "".join(sorted({c for c in text.lower() if c.isalpha()}))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h] * len(out), pa.int64()), pa.array([lang] * len(out), pa.string()),
                     pa.array([letters] * len(out), pa.string()), pa.array(out, pa.binary())],
                    ["h", "lang", "letters", "x"])

    rows = (small_batches(picked).withColumn("_h", rank).mapInArrow(vectors, "h bigint, lang string, letters string, x binary")
            .orderBy("h", "lang", "x").collect())
    if not rows:
        return None
    x = np.zeros((len(rows), DIM), np.float32)
    for i, r in enumerate(rows):
        n = len(r.x) // 6
        x[i, np.frombuffer(r.x, np.uint16, n)] = np.frombuffer(r.x, np.float32, n, 2 * n)
    return LanguageModel(x, [r.lang for r in rows], set("".join(r.letters for r in rows)))


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` plus ``_lang`` and ``_score`` (0 to 1)."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [model.predict(t.as_py()) if model else (UNKNOWN, 0.0) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                [*batch.schema.names, "_lang", "_score"])

    return small_batches(docs).mapInArrow(run, StructType(
        [*docs.schema.fields, StructField("_lang", StringType()), StructField("_score", DoubleType())]))


@other_columns_aside("doc_id", "text", "lang")
def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without those whose language is unknown or unsure (below ``min_score``)."""
    known = predict(docs, fit(docs))
    return known.where((F.col("_lang") != UNKNOWN) & (F.col("_score") >= min_score)).drop("_lang", "_score")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from three of the four folds."""
    docs = read_table(spark, sf_dir, "documents")
    said = predict(docs.select("doc_id", "text"), fit(docs))
    return said.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))
