"""Toxicity by a weighted lexicon, matched by Aho-Corasick after folding.

Folding lower-cases, maps look-alike letters of other scripts to Latin and digits or signs inside words to the
letters they stand for. The lexicon holds whole words and word beginnings with a log-odds weight learned from
labelled rows, and exception phrases: a match with its neighbour word that toxic texts use no more than clean ones do
counts nothing. A text's matched weight, also divided by its length, enters a logistic curve that is
fitted on the same rows.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textree.llm.batches import text_slices
from textree.llm.secret_scan import join_measured
from textree.storage import store

#: Letters of other scripts that look like Latin ones, and what stands for letters inside words.
LOOKALIKES = {
    "а": "a", "в": "b", "г": "r", "е": "e", "ё": "e", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "п": "n", "р": "p", "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ɡ": "g",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
} | {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
SIGNS = {"0": "o", "1": "i", "!": "i", "3": "e", "4": "a", "@": "a", "5": "s", "$": "s", "7": "t"}
_LOOKALIKE = re.compile("[" + "".join(LOOKALIKES) + "]")
_SIGN = re.compile(r"(?<=[^\W\d_])[013457@$!]+(?=[^\W\d_])|(?<!\w)[013457@$]+(?=[^\W\d_]{2})")
_WORD = re.compile(r"[^\W\d_]+")

PREFIX_LENGTHS = (4, 5, 6)
LEAST_ROWS = 3  # words of one text come together, so a single row is no evidence for each of them
LEAST_WEIGHT = 2.0  # natural log-odds of a form
MOST_EXCEPTION_WEIGHT = 0.0  # natural log-odds of an exception: no likelier in a toxic text than in a clean one
LEAST_EVIDENCE = 25.0  # likelihood ratio statistic: by chance about one form or phrase in 10^6 has it
FIT_ROWS = 500_000  # a model is fitted on about so many labelled rows, drawn by a hash; rows scored have no bound
HITS = "toxic int, n_words int, weight double, phrases array<string>"


def fold(text: str) -> str:
    text = text.lower()
    if _LOOKALIKE.search(text):
        text = _LOOKALIKE.sub(lambda m: LOOKALIKES[m[0]], text)
    return _SIGN.sub(lambda m: "".join(SIGNS[x] for x in m[0]), text)


def word_forms(word: str) -> Iterator[str]:
    """The word, closed by a space, and its beginnings."""
    yield word + " "
    for size in PREFIX_LENGTHS:
        if len(word) >= size:
            yield word[:size]


class Matcher:
    """Matches of a lexicon {form: weight} in folded texts; the heaviest at each word counts."""

    def __init__(self, lexicon: dict[str, float], exceptions: frozenset[str] = frozenset()):
        self.exceptions = exceptions
        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for text in {form.rstrip(" ") for form in lexicon}:
            # (weight as a whole word, weight as a beginning)
            self.automaton.add_word(text, (text, lexicon.get(text + " ", 0.0), lexicon.get(text, 0.0)))
        if lexicon:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> dict[int, tuple[int, float]]:
        """Start of each matched word: its end and weight."""
        best: dict[int, tuple[int, float]] = {}
        if not self.lexicon:
            return best
        size = len(folded)
        for end, (form, as_word, as_beginning) in self.automaton.iter(folded):
            start, stop = end + 1 - len(form), end + 1
            if start and folded[start - 1].isalpha():
                continue
            while stop < size and folded[stop].isalpha():
                stop += 1
            weight = max(as_word, as_beginning) if stop == end + 1 else as_beginning
            if weight and (start not in best or best[start][1] < weight):
                best[start] = (stop, weight)
        return best

    def phrases(self, folded: str, start: int, stop: int) -> list[str]:
        """The matched word with the word before it and with the word after it."""
        word = folded[start:stop]
        before = _WORD.findall(folded[max(0, start - 64) : start])
        after = _WORD.findall(folded[stop : stop + 64])
        return [f"{x} {word}" for x in before[-1:]] + [f"{word} {x}" for x in after[:1]]

    def weigh(self, text: str) -> tuple[int, float]:
        """Number of words and the weight of the matches that no exception phrase covers."""
        folded = fold(text)
        total = 0.0
        for start, (stop, weight) in self.hits(folded).items():
            if not self.exceptions or self.exceptions.isdisjoint(self.phrases(folded, start, stop)):
                total += weight
        return text.count(" ") + 1 if text else 0, total


def features(n_words, weight):
    """Matched weight and weight per hundred words, both on a log scale; arrays or columns' numbers."""
    return np.log1p(weight), np.log1p(100.0 * weight / np.maximum(n_words, 1))


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    exceptions: frozenset[str]
    coefficients: tuple[float, float]
    intercept: float

    def score(self, n_words: np.ndarray, weight: np.ndarray) -> np.ndarray:
        a, b = features(n_words, weight)
        return 1.0 / (1.0 + np.exp(-(self.intercept + self.coefficients[0] * a + self.coefficients[1] * b)))


def _form_counts(rows: DataFrame, forms: frozenset[str] | None) -> DataFrame:
    """Rows per form (of ``forms``, or of all with enough rows), combined per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for _, texts in text_slices(batch, "text"):
                for text in texts:
                    found = {form for word in set(_WORD.findall(fold(text))) for form in word_forms(word)}
                    for form in found if forms is None else found & forms:
                        counts[form] = counts.get(form, 0) + 1
                if len(counts) > 500_000:
                    yield pa.RecordBatch.from_pydict({"form": list(counts), "n": pa.array(counts.values(), pa.int64())})
                    counts.clear()
        if counts:
            yield pa.RecordBatch.from_pydict({"form": list(counts), "n": pa.array(counts.values(), pa.int64())})

    return rows.select("text").mapInArrow(run, "form string, n long").groupBy("form").agg(F.sum("n").alias("n"))


def evidence(toxic: Column, clean: Column, share: float) -> Column:
    """Likelihood ratio statistic of a form's toxic and clean rows (columns) against an overall share of toxic ones."""

    def part(n: Column, expected: float) -> Column:
        return F.when(n > 0, n * F.log(n / ((toxic + clean) * F.lit(expected)))).otherwise(0.0)

    return 2.0 * (part(toxic, share) + part(clean, 1 - share))


def fewest(share: float) -> int:
    """No form with fewer toxic rows has enough evidence, whatever its clean ones are."""
    return max(LEAST_ROWS, math.ceil(LEAST_EVIDENCE / (-2.0 * math.log(share))))


def _log_odds(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    return F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))


def learnable(labelled: DataFrame, text_col: str, label_col: str, most_rows: int) -> DataFrame:
    """text and toxic of the rows labelled 0 or 1; of more than ``most_rows``, a sample of about so many by a hash of the text."""
    kept = labelled.where(F.col(label_col).isin(0, 1))
    rows = kept.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(label_col).cast("int").alias("toxic"))
    total = rows.count()
    if total > most_rows:
        rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int((1 << 30) * most_rows / total))
    return rows


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", most_rows: int = FIT_ROWS) -> Model:
    """Learn from the rows whose label is 0 or 1, beyond ``most_rows`` from a sample of about so many.

    Words, beginnings and exceptions are chosen by one test of evidence against the share of toxic rows, so no form is
    too rare as such and none is cut off by rank. Without both labels the model scores the share of label 1.
    """
    stored = store(learnable(labelled, text_col, label_col, most_rows), "toxicity-labelled")
    rows = stored.df
    sizes = {x["toxic"]: x["count"] for x in rows.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        stored.release()
        return Model({}, frozenset(), (0.0, 0.0), 5.0 if toxic else -5.0)
    share = toxic / (toxic + clean)
    # what comes back to the driver are forms of the bounded sample
    often = store(_form_counts(rows.where("toxic = 1"), None).where(F.col("n") >= fewest(share)), "toxicity-forms")
    forms = frozenset(x["form"] for x in often.df.select("form").collect())
    both = often.df.withColumnRenamed("n", "toxic").join(_form_counts(rows.where("toxic = 0"), forms), "form", "left")
    both = both.select("form", "toxic", F.coalesce("n", F.lit(0)).alias("clean"))
    weighed = both.withColumn("weight", _log_odds(F.col("toxic"), F.col("clean"), toxic, clean))
    proven = weighed.where((F.col("weight") >= LEAST_WEIGHT) & (evidence(F.col("toxic"), F.col("clean"), share) >= LEAST_EVIDENCE))
    strong = {x["form"]: x["weight"] for x in proven.collect()}
    # a beginning stands for the longer forms under it unless they weigh clearly more
    lexicon = {
        form: w for form, w in strong.items()
        if not any(strong.get(form[:k], -9.0) >= w - 0.5 for k in PREFIX_LENGTHS if k < len(form.rstrip(" ")))
    }
    hits = store(_hits(rows, Matcher(lexicon)), "toxicity-hits")
    exceptions = _exceptions(hits.df, toxic, clean)
    weighed = hits
    if exceptions:
        weighed = store(_hits(rows, Matcher(lexicon, exceptions)), "toxicity-hits")
    a = F.log1p("weight")
    b = F.log1p(100.0 * F.col("weight") / F.greatest(F.col("n_words"), F.lit(1)))
    # equal rows enter once, with their number as weight
    shaped = weighed.df.groupBy("toxic", a.alias("a"), b.alias("b")).agg(F.count("*").cast("double").alias("rows"))
    shaped = shaped.select(F.col("toxic").cast("double").alias("label"), "rows", array_to_vector(F.array("a", "b")).alias("features"))
    fitted = LogisticRegression(maxIter=50, regParam=1e-4, weightCol="rows").fit(shaped)
    for used in {stored, often, hits, weighed}:
        used.release()
    first, second = (float(x) for x in fitted.coefficients)
    return Model(lexicon, exceptions, (first, second), float(fitted.intercept))


def _exceptions(hits: DataFrame, toxic: int, clean: int) -> frozenset[str]:
    """Phrases around matches that are no likelier in toxic texts than in clean ones, by the evidence that forms need.

    Their share is held against that of all phrases around matches; a mislabelled text among many does not undo one.
    """
    phrases = hits.select("toxic", F.explode("phrases").alias("phrase"))
    counted = phrases.groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
    stored = store(counted, "toxicity-phrases")
    n_toxic, n_clean = stored.df.agg(F.sum("toxic"), F.sum("clean")).first()
    if not n_toxic or not n_clean:
        stored.release()
        return frozenset()
    light = _log_odds(F.col("toxic"), F.col("clean"), toxic, clean) <= MOST_EXCEPTION_WEIGHT
    proof = evidence(F.col("toxic"), F.col("clean"), n_toxic / (n_toxic + n_clean)) >= LEAST_EVIDENCE
    found = frozenset(x["phrase"] for x in stored.df.where(light & proof).select("phrase").collect())
    stored.release()
    return found


def _hits(rows: DataFrame, matcher: Matcher) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = built(tuple(sorted(lexicon.items())), exceptions)
        for batch in batches:
            for start, texts in text_slices(batch, "text"):
                phrases = []
                for text in texts:
                    folded = fold(text)
                    phrases.append(sorted({p for s, (e, _) in local.hits(folded).items() for p in local.phrases(folded, s, e)}))
                weighed = [local.weigh(x) for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("toxic").slice(start, len(texts)).cast(pa.int32()),
                        pa.array([n for n, _ in weighed], pa.int32()),
                        pa.array([w for _, w in weighed], pa.float64()),
                        pa.array(phrases, pa.list_(pa.string())),
                    ],
                    ["toxic", "n_words", "weight", "phrases"],
                )

    lexicon, exceptions = dict(matcher.lexicon), matcher.exceptions
    return rows.mapInArrow(run, HITS)


@functools.lru_cache(maxsize=2)
def built(lexicon: tuple[tuple[str, float], ...], exceptions: frozenset[str]) -> Matcher:
    """One automaton per Python worker and lexicon."""
    return Matcher(dict(lexicon), exceptions)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, weight, score (0 to 1) and predicted for each row of ``docs``; only the text is looked at.

    Null and empty texts get the score of a text without matches; repeated rows and null ids each give a row; an
    empty table gives an empty table; other columns are not read; texts are scored whole. No shuffle. The model
    (a bounded lexicon) travels with the function.
    """
    lexicon, exceptions = tuple(sorted(model.lexicon.items())), model.exceptions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = built(lexicon, exceptions)
        for batch in batches:
            for start, texts in text_slices(batch, "text"):
                weighed = [matcher.weigh(x) for x in texts]
                n_words = np.array([n for n, _ in weighed], np.int64)
                weight = np.array([w for _, w in weighed], np.float64)
                ids = batch.column("doc_id").slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n_words), pa.array(weight), pa.array(model.score(n_words, weight))], ["doc_id", "n_words", "weight", "score"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, n_words long, weight double, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``threshold``. No shuffle; only texts go to Python."""
    lexicon, exceptions = tuple(sorted(model.lexicon.items())), model.exceptions

    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        matcher, keep = built(lexicon, exceptions), []
        for _, slice_ in text_slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            weighed = [matcher.weigh(x) for x in slice_]
            scores = model.score(np.array([n for n, _ in weighed], np.int64), np.array([w for _, w in weighed], np.float64))
            keep += (scores < threshold).tolist()
        return pa.array(keep, pa.bool_())

    return docs.where(clean(F.col(text_col)))


def held_out(id_col: str = "doc_id"):
    """Every fifth row by checksum of its id; never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit_split(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> Model:
    """Fit on the labelled rows of ``docs`` that are not held out. The label table is broadcast if measured small.

    An id with labels 0 and 1 counts as toxic; null labels are passed over.
    """
    known = labels.where("toxic IN (0, 1)").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic"))
    mine = docs.where(~held_out(id_col)).select(F.col(id_col).alias("_doc"), "text")
    return fit(join_measured(mine, known, F.col("_doc") == F.col("_id")))
