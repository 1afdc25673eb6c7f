"""Toxicity scores: boosted trees over dense text features, with isotonic calibration.

The features are densities of a fixed insult lexicon and of one learnt from labels, how near its words stand to second-person words, shares of
capitals, punctuation and repeated characters, and how much of the lexicon appears only once look-alike characters
are undone. All are computed over whole texts in numpy, a slice of an Arrow batch at a time.

The trees and the calibration are fitted on at most ``max_fit_rows`` labelled rows (documented bound, 20,000; chosen
by hash of the id, and by it dealt out to the lexicon and to the trees with their calibration). Every document is scored.

Defined results: null and empty texts have all features 0 and get the score of that point; rows keep their
multiplicity; labels of unknown documents and null labels are ignored; of an id with several labels each teaches, as does
each text of an id; without usable labels of both classes each score is the share of class 1 among them (0.5 if none).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm import textbytes as tb
from weft.llm.boosting import BoostedTrees, Isotonic
from weft.llm.shared import bounded_rows, crc32_of_id, drop_stored, map_texts, stored

# Common insults (English, French, German, Spanish) and second-person words.
INSULTS = """
idiot idiots idiotic moron morons moronic stupid stupidity dumb dumbass fool foolish loser losers trash garbage scum
scumbag worthless pathetic disgusting clown clowns jerk jerks creep freak bastard bastards bitch bitches asshole
assholes shit shitty crap fuck fucking fucker damn hell liar ugly hate kill die imbecile cretin retard retarded
lunatic psycho vermin filth filthy pig pigs rat rats nazi
connard connards connasse salaud salope merde putain abruti abrutis imbécile crétin débile ordure pourriture
arschloch idioten dummkopf trottel scheiße scheisse blöd blödmann abschaum wichser schlampe dreckig
estúpido estúpida idiota imbécil tonto basura mierda puta puto cabrón gilipollas asqueroso patético payaso escoria
""".split()
SECOND_PERSON = "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch usted ustedes ti tú vosotros".split()
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

FEATURES = [
    "insults", "insult_density", "insult_kinds", "near_second_person", "second_person", "hidden_insults", "mixed_words",
    "starred_words", "capitals", "capital_words", "exclamations", "questions", "punctuation", "repeats", "digits", "word_length", "log_words",
    "learnt", "learnt_density", "learnt_weight", "learnt_top",
]


def _hashes(words: list[str]) -> np.ndarray:
    return tb.words_of(*tb.column_bytes(pa.array(words, pa.large_string()))).hash


_FIXED = (tb.HashTable(_hashes(INSULTS)), tb.HashTable(_hashes(SECOND_PERSON)))


def features(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """A row of :data:`FEATURES` for each text."""
    w = tb.words_of(data, offsets)
    count = lambda marks: tb.per_row(marks, offsets).astype(float)
    by_word = lambda marks: tb.per_row(marks, w.bounds).astype(float)
    bad, you = _FIXED[0].marks(w.hash), _FIXED[1].marks(w.hash)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(w.bounds))
    near = np.zeros(len(bad), bool)
    spots, people = np.flatnonzero(bad), np.flatnonzero(you)
    if len(people):
        after = np.searchsorted(people, spots)
        for k in (after - 1, after):
            other = people[np.clip(k, 0, len(people) - 1)]
            near[spots[(np.abs(other - spots) <= 5) & (row[other] == row[spots])]] = True
    pairs = np.unique(np.column_stack([row[spots], w.hash[spots].view(np.int64)]), axis=0)
    kinds = np.bincount(pairs[:, 0], minlength=len(offsets) - 1).astype(float)

    undo = np.arange(256, dtype=np.uint8)
    for a, b in LOOKALIKES.items():
        undo[ord(a)] = ord(b)
    plain = undo[w.lower]
    letter = (plain >= 97) & (plain <= 122) | (plain >= 128)
    start, end = tb.spans(letter, offsets)
    hidden = _FIXED[0].marks(tb.RangeHash(plain)(start, end))
    hidden_by_row = tb.per_row(hidden, np.searchsorted(start, offsets)).astype(float)

    upper = (data >= 65) & (data <= 90)
    lower_ = (w.lower >= 97) & (w.lower <= 122)
    digit = (data >= 48) & (data <= 57)
    star = (data == 42) | (data == 35) | (data == 36) | (data == 64)
    total = lambda marks: np.concatenate([[0], np.cumsum(marks)])
    within = lambda t: t[w.end] - t[w.start]
    digits, letters, capitals = (within(total(x)) for x in (digit, lower_, upper))
    inside = np.zeros(len(data), bool)
    inside[1:-1] = star[1:-1] & lower_[:-2] & lower_[2:] if len(data) > 2 else False
    same = np.zeros(len(data), bool)
    same[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & (data[2:] != 32)
    full = np.flatnonzero(np.diff(offsets))
    first, last = offsets[full], offsets[full + 1] - 1
    inside[first] = inside[last] = False
    same[first] = same[np.minimum(first + 1, last)] = False
    n_words, n_bytes = np.maximum(np.diff(w.bounds), 1).astype(float), np.maximum(np.diff(offsets), 1).astype(float)
    insult_count = by_word(bad)
    return np.column_stack([
        np.minimum(insult_count, 20), insult_count / n_words, kinds, by_word(near), by_word(you) / n_words,
        np.maximum(hidden_by_row - insult_count, 0), by_word((digits > 0) & (letters > 0)) / n_words, count(inside) / n_words,
        count(upper) / n_bytes, by_word((capitals == w.end - w.start) & (capitals > 1)) / n_words, count(data == 33) / n_bytes, count(data == 63) / n_bytes,
        count((data > 32) & (data < 128) & ~tb._WORD[data]) / n_bytes, count(same) / n_bytes, count(digit) / n_bytes,
        by_word((w.end - w.start).astype(np.int64)) / n_words, np.log1p(np.diff(w.bounds)),
        learnt_features(w, lexicon),
    ])


class Lexicon:
    """Weights of words and word beginnings, learnt as smoothed log odds of label 1 against label 0."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        order = np.argsort(keys)
        self.table, self.weights = tb.HashTable(keys), weights[order]

    def by_word(self, w: tb.Words) -> np.ndarray:
        best = np.zeros(len(w.hash))
        for at, h in entries(w):
            found, which = self.table.find(h)
            np.maximum.at(best, at[found], self.weights[which])
        return best


def entries(w: tb.Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word numbers with the hashes of what a lexicon may hold of them: the word, and its first 4, 5 and 6 bytes."""
    yield np.arange(len(w.hash)), w.hash
    for n in (4, 5, 6):
        at = np.flatnonzero(w.end - w.start > n)
        yield at, w.ranges(w.start[at], w.start[at] + n, n)


def learnt_features(w: tb.Words, lexicon: Lexicon) -> np.ndarray:
    weight = lexicon.by_word(w)
    n_words = np.maximum(np.diff(w.bounds), 1).astype(float)
    strong = tb.per_row(weight >= 3, w.bounds).astype(float)
    top = np.zeros(len(w.bounds) - 1)
    np.maximum.at(top, np.repeat(np.arange(len(top)), np.diff(w.bounds)), weight)
    return np.column_stack([np.minimum(strong, 20), strong / n_words, tb.per_row(weight, w.bounds) / n_words, top])


def learn_lexicon(sample: DataFrame, least: int = 4, most: int = 20_000) -> Lexicon:
    """Weights of entries that stand in ``least`` or more texts of label 1 of ``sample(text, y, part)``, part 0.

    Each task counts the texts that hold an entry, so what is shuffled grows with the vocabulary of the bounded sample;
    the ``most`` heaviest entries are fetched.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, data, offsets in tb.slices(whole):
                w, y = tb.words_of(data, offsets), batch.column("y").to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(batch.num_rows), np.diff(w.bounds))
                found = np.concatenate([np.column_stack([h.view(np.int64), row[at]]) for at, h in entries(w)])
                found = np.unique(found, axis=0)
                keys, inverse = np.unique(found[:, 0], return_inverse=True)
                bad = np.bincount(inverse, y[found[:, 1]], len(keys)).astype(np.int64)
                n = np.bincount(inverse, minlength=len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(bad), pa.array(n - bad)], names=["key", "bad", "good"])

    part = sample.filter("part = 0")
    n_bad, n_good = part.agg(F.coalesce(F.sum("y"), F.lit(0)), F.coalesce(F.sum(1 - F.col("y")), F.lit(0))).first()
    counts = map_texts(part.select("text", "y"), run, "key long, bad long, good long").groupBy("key").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    weight = F.log((F.col("bad") + 0.5) / (n_bad + 1) / ((F.col("good") + 0.5) / (n_good + 1)))
    kept = counts.filter(F.col("bad") >= least).select("key", weight.alias("weight")).filter("weight > 1.5").orderBy(F.desc("weight"), "key").limit(most).toArrow()
    return Lexicon(kept["key"].to_numpy().astype(np.int64).view(tb.U64), kept["weight"].to_numpy())


class Model:
    """Lexicon, trees and calibration."""

    def __init__(self, lexicon: Lexicon, x: np.ndarray, y: np.ndarray, folds: int = 5):
        self.lexicon = lexicon
        self.constant = None
        if len(set(y.tolist())) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        unseen, fold = np.zeros(len(y)), np.arange(len(y)) % folds
        for k in range(folds):
            unseen[fold == k] = BoostedTrees().fit(x[fold != k], y[fold != k]).raw(x[fold == k])
        self.trees = BoostedTrees().fit(x, y)
        self.calibration = Isotonic().fit(unseen, y)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offsets) - 1, self.constant)
        raw = self.trees.raw(features(data, offsets, self.lexicon))
        return np.clip(0.99 * self.calibration(raw) + 0.01 / (1 + np.exp(-raw)), 0, 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, max_fit_rows: int) -> DataFrame:
    """At most ``max_fit_rows`` labelled rows that aren't held out, as ``(text, y, part)``; part is 0 to 9 by hash. Each text
    of an id teaches once, with each label of the id."""
    order = F.xxhash64(F.col("doc_id").cast("string"))
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("double").alias("y")).distinct()
    chosen = known.filter(~held_out).orderBy(order, "y").limit(max_fit_rows).select("doc_id", "y", F.pmod(order, F.lit(10)).cast("int").alias("part"))
    return bounded_rows(docs, chosen, max_fit_rows).select("text", "y", "part")


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", max_fit_rows: int = 20_000) -> Model:
    """Parts 0 to 3 of the sample teach the lexicon, so it hasn't seen the rows of the trees. Those are calibrated on what
    each fifth of their rows gets from trees of the others."""
    sample = labelled_sample(docs, labels, label, held_out, max_fit_rows)
    sample = stored(sample.withColumn("part", (F.col("part") >= 4).cast("int")), "toxicity-sample")
    lexicon = learn_lexicon(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch, data, offsets in tb.slices(whole):
                x = features(data, offsets, lexicon).astype("<f8")
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), batch.column("y"), batch.column("part")], names=["x", "y", "part"])

    rows = map_texts(sample.filter("part > 0"), run, "x binary, y double, part int").toArrow()
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), "<f8").reshape(rows.num_rows, len(FEATURES))
    y = rows["y"].to_numpy()
    order = np.lexsort([*x.T, y]) if len(x) else np.empty(0, int)
    drop_stored(docs.sparkSession, sample)
    return Model(lexicon, x[order], y[order])


def learnt_split() -> Column:
    """True for held-out documents, from which no label is learnt."""
    return F.coalesce(crc32_of_id() % 4 == 2, F.lit(False))


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_fit_rows: int = 20_000) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted. Labels are learnt where crc32(doc_id) mod 4 is not 2."""
    kept = pickle.dumps(fit(docs, labels, learnt_split(), max_fit_rows=max_fit_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(kept)
        for whole in batches:
            for batch, data, offsets in tb.slices(whole):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model(data, offsets))], names=["doc_id", "score"])

    scored = map_texts(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", learnt_split().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_fit_rows: int = 20_000) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``; all columns, rows repeated as before."""
    kept = pickle.dumps(fit(docs, labels, learnt_split(), max_fit_rows=max_fit_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(kept)
        for whole in batches:
            for batch, data, offsets in tb.slices(whole):
                yield batch.filter(pa.array(model(data, offsets) < threshold))

    return map_texts(docs, run, docs.schema)
