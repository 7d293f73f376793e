"""Toxicity by fuzzy lexicon matches in context.

A lexicon of terms (whole words) and stems (beginnings of words) is learned
from labelled texts: what is far more frequent in toxic than in other ones, in
many different surroundings, so that copies of one text count little. The
lexicon is a trie; its intersection with a Levenshtein automaton is determinised
as words come in, so a word costs one step per letter and most words leave the
automaton after two or three. It finds misspelled terms too.

Each match is judged in a window of words around it: other matches beside it
speak for abuse; quotation marks around it, or a reporting word before it, for
a quotation. Sums of both kinds, and how many terms matched exactly, by stem or
misspelled, are the features of a logistic model.

The learning rows are a bounded sample of labelled ones, MAX_ROWS_PER_CLASS of
each label, chosen by hash. Scores depend on the text alone. Null and empty texts
score as texts without a match. Without labelled rows of both kinds every score
is 0. Repeated rows, and labels of unknown documents, do no harm: labels that
contradict each other for one id count as toxic. Columns of documents are kept,
except those that are called like a result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import freeing, key_bits, land

MAX_ROWS_PER_CLASS = 8000
MAX_TERMS = 5000
MIN_G = 35.0
MAX_RATE_RATIO = 0.1
FULL_LOG_RATIO = 4.0
MIN_CONTEXTS = 0.5
STEM_LENGTHS = range(4, 9)
MIN_STEM_WORDS = 4
WINDOW = 8
CACHE_WORDS = 250_000
THRESHOLD = 0.7

# What is stripped from the ends of a word.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡§«·»¿–—‘’‚“”„…‹›"
QUOTES = "\"«»‘“”„‹›`"
# Letters that digits and signs stand for.
LOOKALIKES = str.maketrans("013457@$!|", "oieastasii")
RUN = re.compile(r"(.)\1\1+")
# Words that introduce what somebody else has said.
REPORTING = frozenset(
    "said says saying called wrote quoted quote word term phrase dit écrit mot appelé sagte schrieb wort nannte dijo escribió palabra llamó".split()
)


def normal(word: str) -> str:
    return word.strip(MARKS)


def max_errors(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


class LexiconAutomaton:
    """Trie of terms and stems, intersected with a Levenshtein automaton that also allows swapped neighbours.

    A state is the set of (trie node, errors so far, letter still owed by a
    swap); states and steps between them are made when first needed.
    """

    def __init__(self, terms: list[str], stems: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: dict[int, str] = {}
        self.stem: dict[int, str] = {}
        for words, ends in ((terms, self.term), (stems, self.stem)):
            for word in words:
                node = 0
                for letter in word:
                    if letter not in self.children[node]:
                        self.children.append({})
                        self.children[node][letter] = len(self.children) - 1
                    node = self.children[node][letter]
                ends[node] = word
        self.most = max((max_errors(len(w)) for w in terms), default=0)
        self.steps: list[dict[str, int]] = []
        self.sets: list[frozenset] = []
        self.numbers: dict[frozenset, int] = {}
        self.start = self._number({(0, 0, "")})

    def _number(self, states: set) -> int:
        # A letter of the term may be missing in the word.
        todo = list(states)
        while todo:
            node, errors, owed = todo.pop()
            if not owed and errors < self.most:
                for child in self.children[node].values():
                    if (child, errors + 1, "") not in states:
                        states.add((child, errors + 1, ""))
                        todo.append((child, errors + 1, ""))
        least: dict[tuple, int] = {}
        for node, errors, owed in states:
            least[node, owed] = min(errors, least.get((node, owed), errors))
        key = frozenset((node, errors, owed) for (node, owed), errors in least.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
        return self.numbers[key]

    def _step(self, number: int, letter: str) -> int:
        after = set()
        for node, errors, owed in self.sets[number]:
            if owed:
                if owed == letter:
                    after.add((node, errors, ""))
                continue
            if node in self.stem and not errors:
                after.add((node, errors, ""))
            children = self.children[node]
            if letter in children:
                after.add((children[letter], errors, ""))
            if errors < self.most:
                after.add((node, errors + 1, ""))
                for other, child in children.items():
                    if other != letter:
                        after.add((child, errors + 1, ""))
                        if letter in self.children[child]:
                            after.add((self.children[child][letter], errors + 1, other))
        new = self._number(after) if after else -1
        self.steps[number][letter] = new
        return new

    def match(self, word: str) -> tuple[str, int, bool] | None:
        """The closest entry: (entry, errors, whether by its stem), or None."""
        at = self.start
        for letter in word:
            nxt = self.steps[at].get(letter)
            at = self._step(at, letter) if nxt is None else nxt
            if at < 0:
                return None
        best = None
        for node, errors, owed in self.sets[at]:
            if owed:
                continue
            if node in self.stem and not errors:
                found = (0, 1, self.stem[node])
            elif node in self.term:
                entry = self.term[node]
                if errors > max_errors(len(entry)) or (errors and len(entry) < 6 and word[:1] != entry[:1]):
                    continue
                found = (errors, 0, entry)
            else:
                continue
            best = min(best, found) if best else found
        return (best[2], best[0], bool(best[1])) if best else None


class Matcher(dict):
    """Raw word to (entry, errors, by stem) or None; filled as words come in, emptied when it grows too large."""

    def __init__(self, terms: list[str], stems: list[str], benign: list[str]):
        super().__init__()
        self.automaton = LexiconAutomaton(terms, stems)
        self.benign = frozenset(benign)

    def __missing__(self, raw: str):
        if len(self) >= CACHE_WORDS:
            self.clear()
        word = normal(raw)
        found = self.automaton.match(word) if word else None
        if found is None or found[1]:
            plain = word if word.isalpha() else word.translate(LOOKALIKES)
            for other in {plain, RUN.sub(r"\1", plain)} - {word}:
                again = self.automaton.match(other)
                if again and (found is None or again[1] + 1 < found[1]):
                    found = (again[0], max(1, again[1]), again[2])
        if found and found[1] and word in self.benign:
            found = None
        self[raw] = found
        return found

    def hits(self, text: str | None) -> tuple[list[str], list[tuple[int, tuple]]]:
        words = (text or "").lower().split()
        return words, [(i, m) for i, m in enumerate(map(self.__getitem__, words)) if m]


FEATURES = ("direct", "quoted", "terms", "exact", "stem", "misspelled", "strongest", "dense")


def features(words: list[str], hits: list[tuple[int, tuple]], purity: dict[str, float]) -> list[float]:
    """What the model sees of a text. ``purity``: how surely each entry is toxic, up to 1."""
    if not hits:
        return [0.0] * len(FEATURES)
    at = [i for i, _ in hits]
    direct = quoted = strongest = 0.0
    for k, (i, (entry, errors, _)) in enumerate(hits):
        near = sum(1 for j in at[max(0, k - WINDOW) : k + WINDOW + 1] if 0 < abs(j - i) <= WINDOW)
        before, after = words[max(0, i - WINDOW) : i + 1], words[i : i + WINDOW + 1]
        marked = any(w[:1] in QUOTES for w in before if w) and any(w.rstrip(".,;:!?)")[-1:] in QUOTES for w in after if w.rstrip(".,;:!?)"))
        reported = any(normal(w) in REPORTING for w in before[:-1])
        value = purity[entry] * (1.0 + 0.5 * min(near, 4)) / (1 + errors)
        if marked or reported:
            quoted += value
        else:
            direct += value
            strongest = max(strongest, value)
    exact = sum(not e and not s for _, (_, e, s) in hits)
    stem = sum(s for _, (_, _, s) in hits)
    terms = len({m[0] for _, m in hits})
    log = math.log1p
    return [log(direct), log(quoted), log(terms), log(exact), log(stem), log(len(hits) - exact - stem), strongest, log(100 * direct / len(words))]


class ToxicityModel:
    """The lexicon, the misspellings known to be harmless, and the weights (last one: constant)."""

    def __init__(self, terms: dict[str, float], stems: dict[str, float], benign: list[str], weights: list[float]):
        self.terms, self.stems, self.benign, self.weights = terms, stems, benign, weights
        self.purity = terms | stems

    def matcher(self) -> Matcher:
        return Matcher(list(self.terms), list(self.stems), self.benign)

    def score(self, words: list[str], hits: list) -> float:
        x = features(words, hits, self.purity)
        z = self.weights[-1] + sum(a * b for a, b in zip(self.weights, x))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> list[float]:
    """Logistic regression by Newton steps; the constant is not shrunk."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, shrink = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    shrink[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(shrink), x.T @ (y - p) - shrink * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def _lexicon(sample: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Terms and stems with their purity, from the sample (text, toxic), by the log-likelihood ratio of distinct surroundings."""
    words = F.transform(F.split(F.lower("text"), r"\s+"), lambda w: F.btrim(w, F.lit(MARKS)))
    at = sample.select("toxic", words.alias("words")).select("toxic", "words", F.posexplode("words").alias("i", "word"))
    around = F.xxhash64(F.get("words", F.col("i") - 1), F.get("words", F.col("i") + 1))
    seen = at.where(F.length("word") >= STEM_LENGTHS[0]).select("toxic", "word", around.alias("around"))
    once = seen.groupBy("toxic", "word", "around").agg(F.count("*").alias("n"))
    stats = land(once.groupBy("toxic", "word").agg(F.count("*").alias("contexts"), F.sum("n").alias("n")), "tox-words")
    totals = {r["toxic"]: r["t"] for r in stats.groupBy("toxic").agg(F.sum("contexts").alias("t")).collect()}
    if len(totals) < 2:
        return {}, {}
    all_pos, all_neg = float(totals[1]), float(totals[0])

    def select(by: DataFrame) -> DataFrame:
        """Features with counts ``pos`` and ``neg`` that stand out."""
        pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
        both = pos + neg
        expected = both * all_pos / (all_pos + all_neg)
        part = lambda n, e: F.when(n > 0, n * F.log(n / e)).otherwise(0.0)
        g = 2 * (part(pos, expected) + part(neg, both - expected))
        return (
            by.withColumn("g", g)
            .where((F.col("g") >= MIN_G) & (neg / all_neg <= MAX_RATE_RATIO * pos / all_pos) & (pos >= MIN_CONTEXTS * F.col("n_pos")))
            .orderBy(F.desc("g"), "feature")
            .limit(MAX_TERMS)
        )

    split = [
        F.sum(F.when(F.col("toxic") == 1, F.col("contexts")).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("toxic") == 0, F.col("contexts")).otherwise(0)).alias("neg"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("n_pos"),
    ]
    whole = select(stats.groupBy(F.col("word").alias("feature")).agg(*split)).collect()
    starts = F.explode(F.transform(F.array(*(F.lit(k) for k in STEM_LENGTHS)), lambda k: F.when(F.length("word") > k, F.substr("word", F.lit(1), k))))
    longest = F.max(F.when(F.col("toxic") == 1, F.col("contexts")).otherwise(0)).alias("most")
    kinds = F.count(F.when(F.col("toxic") == 1, 1)).alias("kinds")
    stem = stats.select("toxic", "word", "contexts", "n", starts.alias("feature")).where("feature is not null")
    stem = stem.groupBy("feature").agg(*split, longest, kinds).where((F.col("kinds") >= MIN_STEM_WORDS) & (F.col("most") < 0.6 * F.col("pos")))
    pure = lambda r: min(1.0, math.log((r["pos"] + 0.5) / (r["neg"] + 0.5) * all_neg / all_pos) / FULL_LOG_RATIO)
    stems: dict[str, float] = {}
    for r in sorted(select(stem).collect(), key=lambda r: (-r["g"], -len(r["feature"]), r["feature"])):
        if not any(r["feature"].startswith(s) or s.startswith(r["feature"]) for s in stems):
            stems[r["feature"]] = pure(r)
    terms = {r["feature"]: pure(r) for r in whole if not any(r["feature"].startswith(s) for s in stems)}
    return terms, stems


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Learn from labelled documents. ``labels`` should hold only rows to learn from."""
    one = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(label).alias("toxic"))
    chosen = one.where("toxic = 1").orderBy(key_bits(F.col("id")), "id").limit(MAX_ROWS_PER_CLASS).unionByName(
        one.where("toxic = 0").orderBy(key_bits(F.col("id")), "id").limit(MAX_ROWS_PER_CLASS)
    )
    # At most 2 * MAX_ROWS_PER_CLASS short rows: small enough for every executor.
    chosen = F.broadcast(land(chosen, "tox-chosen"))
    texts = docs.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    sample = land(texts.join(chosen, "id").select("text", "toxic"), "tox-sample")
    terms, stems = _lexicon(sample)
    if not terms and not stems:
        return ToxicityModel({}, {}, [], [0.0] * len(FEATURES) + [-30.0])

    def misspelled(batches):
        matcher = Matcher(list(terms), list(stems), [])
        for batch in batches:
            words, toxic = [], []
            for x, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                raw, hits = matcher.hits(x)
                new = {normal(raw[i]) for i, m in hits if m[1]}
                words.extend(new)
                toxic.extend([y] * len(new))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic, pa.int32())], names=["word", "toxic"])

    forms = sample.mapInArrow(freeing(misspelled), "word string, toxic int").groupBy("word").agg(F.sum("toxic").alias("pos"), F.count("*").alias("n"))
    harmless = [r["word"] for r in forms.where("n - pos >= 1 and n - pos > 0.2 * n").orderBy(F.desc("n"), "word").limit(MAX_TERMS).collect()]
    model = ToxicityModel(terms, stems, harmless, [])

    def featurise(batches):
        matcher = model.matcher()
        for batch in batches:
            x = [features(*matcher.hits(t), model.purity) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("toxic")], names=["x", "toxic"])

    rows = sample.mapInArrow(freeing(featurise), T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), sample.schema["toxic"]])).collect()
    model.weights = _fit(np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], dtype=float))
    return model


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1), ``toxic_terms`` (entries that matched) and ``toxic_at`` (their word positions)."""
    results = ("toxicity", "toxic_terms", "toxic_at")
    kept = [f for f in docs.schema if f.name.lower() not in results]
    schema = T.StructType(
        [*kept, T.StructField("toxicity", T.DoubleType()), T.StructField("toxic_terms", T.ArrayType(T.StringType())), T.StructField("toxic_at", T.ArrayType(T.LongType()))]
    )
    names = [f.name for f in kept]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        matcher, known = shared.value.matcher(), shared.value
        for batch in batches:
            scores, entries, places = [], [], []
            # One text at a time: the words of a whole batch would take ten times its bytes.
            for value in batch.column(text):
                words, hits = matcher.hits(value.as_py())
                scores.append(known.score(words, hits))
                entries.append([m[0] for _, m in hits])
                places.append([i for i, _ in hits])
            columns = [*(batch.column(c) for c in names), pa.array(scores, pa.float64())]
            columns += [pa.array(entries, pa.list_(pa.string())), pa.array(places, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *results])

    return docs.select(*names).mapInArrow(freeing(run), schema)
