"""Divergence of sources from each other and from their language, by count-level bitmaps.

Every (language, source) group keeps, for each count that occurs in it, the set
of terms with that count as a bitmap over term ids. Two groups meet level by
level: AND and a population count give the number of terms in each joint cell
(count here, count there); cells with a count of zero are what the levels leave
over. A cell's number times its divergence is all the sum needs, so terms are
never paired one by one.

Term ids are dealt to blocks of about ``BLOCK`` terms of similar total count,
and sources to parts of about ``PART``, so a task holds the levels of one block
and two parts however large the corpus, a language or a source is.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscout.llm.common import term_table, text_of
from shelfscout.session import materialise

FOLD = term_table(digits=False)
# Terms of a block and sources of a part, about; entries a counting task holds before it hands them on.
BLOCK, PART = 1024, 64
HELD = 500_000
# Columns of joint cells worked on at a time.
AT_ONCE = 4096
# Fixed by the audit's definition: the unit of probabilities, and what is added to every count.
UNIT, ADDED = 1_000_000_000, 1


def count_terms(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """``lang``, ``source``, ``term``, ``count``, ``holding`` (documents with the term), summed
    within tasks only; every group has a row without a term as well."""
    read = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).alias("text"))
    Group = tuple[str, str]

    def rows(counts: dict[Group, Counter], holding: dict[Group, Counter]) -> pa.RecordBatch:
        langs, sources, terms, sums, held = [], [], [], [], []
        for group, found in counts.items():
            langs += [group[0]] * (len(found) + 1)
            sources += [group[1]] * (len(found) + 1)
            terms += [None, *found]
            sums += [0, *found.values()]
            held += [0, *map(holding[group].__getitem__, found)]
        return pa.record_batch(
            [
                pa.array(langs, pa.string()),
                pa.array(sources, pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(sums, pa.int64()),
                pa.array(held, pa.int64()),
            ],
            names=["lang", "source", "term", "count", "holding"],
        )

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[Group, Counter] = defaultdict(Counter)
        holding: dict[Group, Counter] = defaultdict(Counter)
        size = 0
        for part in parts:
            groups = zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), strict=True)
            for group, text in zip(groups, part.column("text"), strict=True):
                terms = text.as_py().encode().translate(FOLD).split()
                found = counts[group]
                size -= len(found)
                found.update(terms)
                holding[group].update(set(terms))
                size += len(found)
                if size > HELD:
                    yield rows(counts, holding)
                    counts.clear()
                    holding.clear()
                    size = 0
        if counts:
            yield rows(counts, holding)

    return read.mapInArrow(task, "lang string, source string, term string, count long, holding long")


def kept_terms(counted: DataFrame, least_docs: int) -> DataFrame:
    """One row per group and kept term it holds: ``lang``, ``source``, ``term``, ``count``, the language's
    ``total`` and ``first``, true in one row per language and term. Every group has a row without a term."""
    term = Window.partitionBy("lang", "term")
    return (
        counted.repartition("lang", "term")  # serves the sum and the windows
        .groupBy("lang", "term", "source")
        .agg(F.sum("count").alias("count"), F.sum("holding").alias("holding"))
        .withColumns(
            {
                "docs": F.sum("holding").over(term),
                "total": F.sum("count").over(term),
                "first": F.col("source") == F.min("source").over(term),
            }
        )
        .where(F.col("term").isNull() | (F.col("docs") >= least_docs))
        .select("lang", "source", "term", "count", "total", (F.col("first") & F.col("term").isNotNull()).alias("first"))
    )


def level_bitmaps(kept: DataFrame, classes: DataFrame, block: int) -> DataFrame:
    """The bitmaps, one row per 64 terms that are not all absent: ``lang``, ``klass``, ``bucket`` (the
    block), its number of terms ``size``, ``source``, ``count``, ``word`` (place in the bitmap), ``bits``."""
    keys = ["lang", "klass", "bucket"]
    dealt = (
        kept.where("term is not null")
        .withColumn("klass", _klass())
        .join(classes, ["lang", "klass"])
        .withColumn("bucket", F.pmod(F.xxhash64("term"), F.ceil(F.col("terms") / block)))
    )
    ids = dealt.withColumn("id", F.dense_rank().over(Window.partitionBy(*keys).orderBy("term")) - 1)
    sized = ids.withColumn("size", F.max("id").over(Window.partitionBy(*keys)) + 1)
    bit = F.expr("shiftleft(1L, id % 64)")
    return sized.groupBy(*keys, "size", "source", "count", F.expr("id div 64").cast("int").alias("word")).agg(
        F.bit_or(bit).alias("bits")
    )


def _klass() -> Column:
    """Terms of a language by the power of two below their total."""
    return F.floor(F.log2("total")).cast("int")


def _share(count: str, size: str) -> Column:
    """1 + floor(UNIT * (count + ADDED) / size), without overflow."""
    return F.expr(f"1L + (cast({count} + {ADDED} as decimal(20, 0)) * cast({UNIT} as decimal(10, 0))) div {size}")


def shares(counts: np.ndarray, size: int) -> np.ndarray:
    """The same for an array, in integers of any size."""
    return np.array([1 + UNIT * (count + ADDED) // size for count in counts.tolist()], np.int64)


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class Block:
    """The levels of all given groups in one block of terms."""

    def __init__(self, size: int, groups: list[tuple[str, int]], levels: pa.Table):
        """``groups``: source and the divisor of its shares; ``levels``: source, count, word, bits."""
        self.size = size
        self.sources = [source for source, _ in groups]
        place_of = {source: i for i, source in enumerate(self.sources)}
        at = np.array([place_of[source] for source in levels.column("source").to_pylist()], np.int64)
        count, word = levels.column("count").to_numpy(), levels.column("word").to_numpy()
        order = np.lexsort((count, at))
        at, count = at[order], count[order]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (count[1:] != count[:-1])
        row = np.cumsum(new) - 1
        self.words = np.zeros((-(-size // 64), int(new.sum())), np.uint64)
        self.words[word[order], row] = levels.column("bits").to_numpy().view(np.uint64)[order]
        self.many = np.bitwise_count(self.words).sum(axis=0, dtype=np.int64)
        self.ends = np.searchsorted(at[new], np.arange(len(groups) + 1))
        self.zero = np.concatenate([shares(np.zeros(1, np.int64), by) for _, by in groups])
        self.share = np.empty(len(self.many), np.int64)
        for i, (_, by) in enumerate(groups):
            own = slice(self.ends[i], self.ends[i + 1])
            self.share[own] = shares(count[new][own], by)

    def sums(self, one: int, low: int, high: int) -> np.ndarray:
        """Over the block's terms, the gap of group ``one`` to each of the groups from ``low`` up to ``high``."""
        own = slice(self.ends[one], self.ends[one + 1])
        p, p_zero = self.share[own, None], self.zero[one]
        first, last = self.ends[low], self.ends[high]
        met = np.zeros((own.stop - own.start, high - low), np.int64)  # own level by other group
        joint = np.zeros(last - first, np.int64)  # per other level: sum over own levels, zero included
        for start in range(first, last, AT_ONCE):
            other = slice(start, min(start + AT_ONCE, last))
            cells = np.zeros((len(p), other.stop - other.start), np.int64)
            for word in self.words:
                cells += np.bitwise_count(word[own, None] & word[None, other])
            q = self.share[None, other]
            alone = self.many[other] - cells.sum(axis=0)
            joint[other.start - first : other.stop - first] = (cells * gap(p, q)).sum(axis=0) + alone * gap(p_zero, q[0])
            group = np.searchsorted(self.ends, np.arange(other.start, other.stop), "right") - 1 - low
            np.add.at(met, (slice(None), group), cells)
        running = np.concatenate([[0], np.cumsum(joint)])
        places = self.ends[low : high + 1] - first
        found = running[places[1:]] - running[places[:-1]]
        q_zero = self.zero[low:high]
        found += ((self.many[own, None] - met) * gap(p, q_zero[None, :])).sum(axis=0)
        totals = np.concatenate([[0], np.cumsum(self.many)])
        others = totals[self.ends[low + 1 : high + 1]] - totals[self.ends[low:high]]
        neither = self.size - self.many[own].sum() - others + met.sum(axis=0)
        return found + neither * gap(p_zero, q_zero)


def _block_pairs(levels: pa.Table, groups: pa.Table) -> pa.Table:
    """Ordered pairs of groups of one block and two parts of the sources, with the block's share of their gap."""
    rows = groups.sort_by([("part", "ascending"), ("source", "ascending")])
    low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
    pairs = list(zip(rows.column("source").to_pylist(), rows.column("divisor").to_pylist(), strict=True))
    block = Block(rows.column("size")[0].as_py(), pairs, levels)
    parts = np.array(rows.column("part").to_pylist())
    ones, others, values = [], [], []
    for one, source in enumerate(block.sources):
        part = parts[one]
        wanted = high if part == low else low
        start, end = np.searchsorted(parts, [wanted, wanted + 1])
        if start == end:
            continue
        found = block.sums(one, int(start), int(end))
        for other, value in zip(range(start, end), found.tolist(), strict=True):
            if other != one:
                ones.append(source)
                others.append(block.sources[other])
                values.append(value)
    lang = [rows.column("lang")[0].as_py()] * len(ones)
    return pa.table(
        [pa.array(lang, pa.string()), pa.array(ones, pa.string()), pa.array(others, pa.string()), pa.array(values, pa.int64())],
        names=["lang", "source", "item", "value"],
    )


def _cells(parts: str = "parts") -> Column:
    """The pairs of parts that a row of ``part`` takes part in."""
    each = F.sequence(F.lit(0).cast("long"), F.col(parts) - 1)
    pair = F.transform(each, lambda x: F.struct(F.least("part", x).alias("low"), F.greatest("part", x).alias("high")))
    return F.explode(pair).alias("cell")


def audit(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    least_docs: int = 3,
    most_terms: int = 200,
    block: int = BLOCK,
    part: int = PART,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: how far every group lies from others.

    Terms are maximal runs of letters and everything beyond ASCII, A-Z
    lower-cased; a language keeps those in at least ``least_docs`` of its
    documents. A group gives a term that it holds ``count`` times the share
    1 + floor(10^9 (count + 1) / (N + V)); the gap of shares p and q is
    floor((p - q)^2 / q). Rows of part ``pair``: the gap to every other source
    of the language, summed over its kept terms. Rows of part ``term``: the
    ``most_terms`` terms the group holds above the language's share, by gap.

    Null language, source and text are the empty string, a group like any other.
    A group without terms has its pairs all the same (value 0 if the language
    keeps no term). Ties rank by UTF-8 of the item. Repeated rows count each; an
    empty table gives no rows; other columns are not read. Texts are counted
    whole, in memory proportional to the longest.
    """
    kept = materialise(kept_terms(count_terms(docs, lang_col, source_col, text_col), least_docs), "kept-terms")
    classes = materialise(
        kept.where("first").groupBy("lang", _klass().alias("klass")).agg(
            F.count("*").alias("terms"), F.sum("total").alias("tokens")
        ),
        "term-classes",
    )
    langs = classes.groupBy("lang").agg(
        F.sum("terms").alias("lang_terms"), (F.sum("terms") + F.sum("tokens")).alias("lang_divisor")
    )
    groups = kept.groupBy("lang", "source").agg(F.sum(F.when(F.col("term").isNotNull(), F.col("count"))).alias("own"))
    parts = groups.groupBy("lang").agg(F.ceil(F.count("*") / part).alias("parts"))
    groups = materialise(
        groups.join(parts, "lang")
        .join(langs, "lang", "left")
        .select(
            "lang",
            "source",
            "parts",
            F.pmod(F.xxhash64("source"), F.col("parts")).alias("part"),
            (F.coalesce("own", F.lit(0)) + F.coalesce("lang_terms", F.lit(0))).alias("divisor"),
            "lang_divisor",
        ),
        "groups",
    )
    bitmaps = materialise(level_bitmaps(kept, classes.drop("tokens"), block), "count-level-bitmaps")
    pairs = _pairs(bitmaps, groups)
    terms = _terms(kept, groups, most_terms)
    return pairs.unionByName(terms)


def _pairs(bitmaps: DataFrame, groups: DataFrame) -> DataFrame:
    block = ["lang", "klass", "bucket"]
    keys = [*block, "low", "high"]
    where = groups.select("lang", "source", "parts", "part")
    levels = bitmaps.join(where, ["lang", "source"]).select(*block, "source", "count", "word", "bits", _cells())
    here = bitmaps.select(*block, "size").distinct().join(groups.drop("lang_divisor"), "lang")
    own = [F.col(name).alias(name) for name in block]  # columns of their own, told apart from those of levels
    given = here.select(*own, "size", "source", "divisor", "part", _cells())
    met = (
        levels.select("*", "cell.*").groupBy(*keys)
        .cogroup(given.select("*", "cell.*").groupBy(*keys))
        .applyInArrow(_block_pairs, "lang string, source string, item string, value long")
    )
    # Languages that keep no term have no block; their pairs are worth 0.
    bare = groups.where("lang_divisor is null").select("lang", "source")
    other = bare.withColumnRenamed("source", "item")
    none = bare.join(other, "lang").where("source != item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    summed = met.unionByName(none).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(summed, "pair", None)


def _terms(kept: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    shares_of = (
        kept.where("term is not null and count > 0")
        .join(groups.select("lang", "source", "divisor", "lang_divisor"), ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), _share("count", "divisor").alias("p"), _share("total", "lang_divisor").alias("q"))
    )
    return _ranked(
        shares_of.where("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value")), "term", most
    )


def _ranked(values: DataFrame, part: str, most: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = values.withColumn("rank", F.row_number().over(order))
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
