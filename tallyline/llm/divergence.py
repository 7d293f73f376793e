"""Source divergence audit by run-length columns.

For every language the terms in at least ``least_docs`` of its documents are
its vocabulary. Every group (language, source), and the language as a whole,
gives each term of it a share p = 1 + floor(1e9 * (count + 1) / (N + V)). A
group diverges from a reference by f = floor((p - q)^2 / q), in integers.

* Part ``pair``: the group against every other source of its language, f summed
  over the whole vocabulary.
* Part ``term``: the terms that the group uses more than its language does, the
  ``top`` largest f.

Most terms are missing from most sources, and most counts are small, so a
group's counts repeat. The vocabulary is reordered: terms with the same counts
in all sources become one entry with a multiplicity, and entries are sorted by
their counts. Each group's column is then run-length encoded, the runs of two
columns are intersected, and f is multiplied by the length of what they share.
Entries are dealt out by ranges of that order, so a task sees a part of the
vocabulary; sums over parts are added by Spark.

A term's row holds one count for each source that has it. The result has a row
for every pair of sources, which bounds how many there can usefully be; the
table of groups is sent to every executor, its size is checked, and more groups
than fit raise an error. Counts up to 9e15 are exact.

Null text, language and source count as ''. Texts without terms still make
their group appear; languages without a vocabulary have pairs of value 0.
Repeated rows are documents of their own. Terms of the same f are ranked by
their UTF-8 bytes. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import MAX_BROADCAST_BYTES, land

LEAST_DOCS = 3
TOP = 200
#: Different terms a task counts before it sends them on.
HELD_TERMS = 300_000
#: Counts in the run-length columns a task holds at once.
HELD_COUNTS = 1_000_000
#: Counts of an entry that decide the range it is dealt to.
HEAD_COUNTS = 3
GROUP_BYTES = 200  # of a group in a broadcast table

# ASCII letters in lower case; every other ASCII byte parts terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))

_COUNTED = "lang string, source string, term string, n long, docs long"


def _count_terms(batches):
    """Per (lang, source, term): occurrences and documents. A row of the empty term stands for the group."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows():
        for (lang, source), (n, docs) in counts.items():
            n[b""], docs[b""] = 0, 0
            terms = list(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array(list(n.values()), pa.int64()),
                    pa.array([docs[t] for t in terms], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    seen = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
            own = counts.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            terms = text.as_py().encode().translate(TERM_BYTES).split()
            before = len(own[0])
            own[0].update(terms)
            own[1].update(set(terms))
            seen += len(own[0]) - before
            if seen > HELD_TERMS:
                yield from rows()
                counts, seen = {}, 0
    yield from rows()


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Per language and term: its documents, and its counts by source (``by``). The empty term lists all sources."""
    own = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))))
    counted = own.mapInArrow(_count_terms, _COUNTED).repartition("lang", "term")
    # Dealt by language and term once; neither step shuffles again.
    by_source = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("by"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(1e9 * (count + 1) / (total + terms)) in whole numbers: three steps of long division by thousands."""
    below = total + terms
    rest, out = count + 1, F.lit(0).cast("long")
    for _ in range(3):
        out = out * 1000 + F.call_function("div", rest * 1000, below)
        rest = (rest * 1000) % below
    return out + 1


def _shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The same for an array."""
    rest, out = counts + 1, np.zeros(len(counts), dtype=np.int64)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total + terms)
        out = out * 1000 + more
    return out + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def run_lengths(rows: np.ndarray, counts: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """A column that is ``counts`` at ``rows`` (ascending) and 0 elsewhere, as starts and values of its runs."""
    # After each entry the column falls to 0, unless the next entry follows.
    gap = np.append(rows[1:] != rows[:-1] + 1, rows[-1] + 1 < n_rows) if len(rows) else np.empty(0, dtype=bool)
    starts = np.concatenate([[0] if not len(rows) or rows[0] else [], rows, rows[gap] + 1]).astype(np.int64)
    values = np.concatenate([[0] if not len(rows) or rows[0] else [], counts, np.zeros(gap.sum())]).astype(np.int64)
    order = np.argsort(starts, kind="stable")
    starts, values = starts[order], values[order]
    first = np.append(True, values[1:] != values[:-1])
    return starts[first], values[first]


def _pair_sums(lang: str, sources: list[tuple[str, int, int]], rows: np.ndarray, codes: np.ndarray, counts: np.ndarray, times: np.ndarray):
    """f over a part of the vocabulary, for every pair of sources. ``times``: how many terms each entry stands for."""
    upto = np.concatenate([[0], np.cumsum(times)])
    order = np.argsort(codes, kind="stable")
    cuts = np.searchsorted(codes[order], np.arange(len(sources) + 1))
    columns = []
    for k, (_, total, terms) in enumerate(sources):
        own = order[cuts[k] : cuts[k + 1]]
        starts, values = run_lengths(rows[own], counts[own], len(times))
        columns.append((starts, _shares(values, total, terms)))
    names = [s for s, _, _ in sources]
    for i, (starts, p) in enumerate(columns):
        sums = np.zeros((2, i), dtype=np.int64)
        for j, (other, q) in enumerate(columns[:i]):
            bounds = np.union1d(starts, other)
            length = np.diff(upto[np.append(bounds, len(times))])
            x = p[np.searchsorted(starts, bounds, "right") - 1]
            y = q[np.searchsorted(other, bounds, "right") - 1]
            square = (x - y) ** 2
            sums[:, j] = (square // y * length).sum(), (square // x * length).sum()
        if i:
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * 2 * i), pa.array([names[i]] * i + names[:i]), pa.array(names[:i] + [names[i]] * i), pa.array(sums.ravel())],
                names=["lang", "source", "item", "value"],
            )


def _pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """Sums of f per (lang, source, item), where the language has a vocabulary."""
    entries = land(terms.groupBy("lang", "by").agg(F.count("*").alias("times")), "audit-entries")
    known: dict[str, list[tuple[str, int, int]]] = {}
    if groups.count() * GROUP_BYTES > MAX_BROADCAST_BYTES:
        raise ValueError("more groups than the pair part can hold")
    for r in groups.orderBy("lang", "source").collect():
        known.setdefault(r["lang"], []).append((r["source"], r["total"], r["terms"]))
    sent = terms.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        lang, held, n_held = None, [], 0

        def flush():
            sources = sent.value[lang]
            places = pa.array([s for s, _, _ in sources])
            names, counts, lengths, times = (pa.concat_arrays(x) if isinstance(x[0], pa.Array) else np.concatenate(x) for x in zip(*held))
            codes = pc.index_in(names, places).to_numpy()
            rows = np.repeat(np.arange(len(lengths)), lengths)
            return _pair_sums(lang, sources, rows, codes, counts, times)

        for batch in batches:
            if not batch.num_rows:
                continue
            langs = batch.column("lang").to_pylist()
            cuts = [0, *(k for k in range(1, len(langs)) if langs[k] != langs[k - 1]), len(langs)]
            for a, b in zip(cuts, cuts[1:]):
                if held and (langs[a] != lang or n_held > HELD_COUNTS):
                    yield from flush()
                    held, n_held = [], 0
                lang = langs[a]
                piece = batch.slice(a, b - a)
                by = piece.column("by")
                cells = by.flatten()
                held.append((cells.field("source"), cells.field("n").to_numpy(), by.value_lengths().to_numpy(), piece.column("times").to_numpy()))
                n_held += len(cells)
        if held:
            yield from flush()

    # Ranges of the first counts, equal ones by a hash: Spark samples what ranges
    # are made of, and whole rows of counts would be too much for the driver.
    head = F.slice("by", 1, HEAD_COUNTS)
    dealt = entries.repartitionByRange("lang", head, F.xxhash64("by")).sortWithinPartitions("lang", "by")
    parts = dealt.mapInArrow(run, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _few(groups: DataFrame) -> DataFrame:
    return F.broadcast(groups) if groups.count() * GROUP_BYTES <= MAX_BROADCAST_BYTES else groups


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank (from 1 per group and part; larger values first, then by item)."""
    counted = land(term_counts(docs, lang, source, text).where((F.col("docs") >= least_docs) | (F.col("term") == "")), "audit-terms")
    terms = counted.where("term <> ''")
    by_group = counted.select("lang", "term", F.explode("by").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("total"))
    by_lang = counted.groupBy("lang").agg(
        F.count(F.when(F.col("term") != "", 1)).alias("terms"),
        F.sum(F.aggregate("by", F.lit(0).cast("long"), lambda s, x: s + x["n"])).alias("lang_total"),
    )
    groups = land(by_group.join(by_lang, "lang"), "audit-groups")

    other = groups.select("lang", F.col("source").alias("item"))
    everyone = groups.select("lang", "source").join(other, "lang").where("source <> item")
    pairs = everyone.join(_pairs(terms, groups), ["lang", "source", "item"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value")
    )
    one = terms.select("lang", "term", F.aggregate("by", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("n"), F.explode("by").alias("c"))
    one = one.select("lang", F.col("c.source").alias("source"), "term", "n", F.col("c.n").alias("own")).where("own > 0")
    shared = one.join(_few(groups), ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("own"), F.col("total"), F.col("terms")).alias("p"), share(F.col("n"), F.col("lang_total"), F.col("terms")).alias("q")
    )
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    more = shared.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    first = more.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(place)).unionByName(first)
