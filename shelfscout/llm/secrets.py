"""Secret scan: three base rules, and strings a character model holds for random.

Two character Markov models are counted from labelled samples, one of random
strings, one of ordinary identifiers. What the base rules leave of a run of key
characters is cut into segments by the log-likelihood ratio of the two: a
segment ends where its sum falls to zero or ``LEAST_RATIO`` below its best, and
is a secret if that best is ``LEAST_RATIO`` or more. Built-in functions only.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscout.llm.common import text_of

# The base rules, their least lengths, in the order kinds are listed.
KEY, VALUE = "(?i:password|passwd|secret|token|api_?key)", "[A-Za-z0-9+/_.=-]+"
SIGN = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = f"({KEY}){SIGN}({VALUE})"
LEAST_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"  # AKIA[A-Z0-9]+ of 18 characters or more
HEX = r"[0-9a-f]{16,}"  # [0-9a-f]+ of 16 characters or more
# What a base match takes.
BASE = f"{KEY}{SIGN}{VALUE}|{ACCESS}|{HEX}"
BASE_KINDS = ("assign", "access", "hex")
MODEL_KIND = "markov"

# What the models look at: runs of key characters, in samples and in the scan.
RUN = "[A-Za-z0-9+/_=-]"
LEAST_SAMPLE = 6
# Runs that are scored: of 8 characters or more, and of 20 if they are letters of one case, as words
# are, with a capital or without. Above that the ratio decides.
LEAST_RUN = 8
WORD = "(?:[A-Z]?[a-z]{0,18}|[A-Z]{0,19})"
CANDIDATE = rf"(?<!{RUN})((?!{WORD}(?!{RUN})){RUN}{{{LEAST_RUN},}})"
# Characters a model knows: those of RUN. Codes are ASCII; 0 stands before the first.
KNOWN, CODES = 67, 128
CLASSES = (string.ascii_lowercase, string.ascii_uppercase, string.digits, "+/_=-")
# Shares of pairs, of classes and of all characters alike in the two models: a random string may be
# written in any characters, an ordinary one keeps to the classes that follow each other in others.
MIXED = {True: (0.5, 0.0, 0.5), False: (0.7, 0.25, 0.05)}
# Natural logarithm of the odds against a run being random before it is looked at.
LEAST_RATIO = math.log(1e4)
# A base match, or a piece of a run between base matches.
PIECE = f"{BASE}|((?!{WORD}(?!{RUN}))(?:(?!{BASE}){RUN}){{{LEAST_RUN},}})"
BLOCK = 256
# Up to here the rest of a run does not speak against belonging to the segment beside it.
EDGE = LEAST_RATIO / 2


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio (random over ordinary) of each pair of neighbouring characters."""

    ratios: tuple[float, ...]


def _codes(value: Column) -> Column:
    return F.transform(F.filter(F.split(value, ""), lambda x: x != ""), lambda x: F.ascii(x))


def _before(codes: Column) -> Column:
    return F.concat(F.array(F.lit(0)), F.slice(codes, 1, F.greatest(F.size(codes) - 1, F.lit(0))))


def samples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Labelled samples (``value``, ``random``) from all documents.

    Random: what the base rules find. Ordinary: the runs of key characters in
    the rest of the text.
    """
    texts = docs.select(text_of(text_col).alias("text"))
    values = F.filter(
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda x: F.char_length(x) >= LEAST_VALUE
    )
    found = F.concat(
        values,
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )
    rest = F.regexp_replace("text", f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    ordinary = F.regexp_extract_all(rest, F.lit(f"{RUN}{{{LEAST_SAMPLE},}}"), F.lit(0))
    random = texts.select(F.explode(found).alias("value"), F.lit(True).alias("random"))
    return random.unionByName(texts.select(F.explode(ordinary).alias("value"), F.lit(False).alias("random")))


def train(labelled: DataFrame, smoothing: float = 0.5) -> Model:
    """Models from samples (``value``, ``random``); nulls are left out, no sample leaves the ratios at 0.

    Equal samples count once, so copies of documents, and words that are common,
    weigh no more than others.
    """
    codes = _codes(F.col("value"))
    values = labelled.where("value is not null and random is not null").distinct()
    pairs = values.select(
        "random", F.explode(F.arrays_zip(_before(codes).alias("a"), codes.alias("b"))).alias("pair")
    )
    pairs = pairs.select("random", F.col("pair.a").alias("a"), F.col("pair.b").alias("b"))
    pairs = pairs.where(f"a < {CODES} and b < {CODES}").groupBy("random", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    counts = {False: [0] * (CODES * CODES), True: [0] * (CODES * CODES)}
    # At most one row per label and pair of ASCII codes.
    for random, a, b, n in pairs.collect():
        counts[random][a * CODES + b] = n
    logs = {label: _logs(table, smoothing, MIXED[label]) for label, table in counts.items()}
    if not any(counts[True]) or not any(counts[False]):
        return Model((0.0,) * (CODES * CODES))
    return Model(tuple(x - y for x, y in zip(logs[True], logs[False], strict=True)))


def _logs(table: list[int], smoothing: float, mixed: tuple[float, float, float]) -> list[float]:
    """Log probability of each pair's second character after its first.

    A mixture: of the pairs, each leaning on how common its second
    character is at all; of the pairs of classes, characters of a class alike;
    and of all characters alike. So one odd pair never decides alone, and what is
    unseen but of ordinary classes stays nearly ordinary.
    """
    faith, total = smoothing * KNOWN, sum(table)
    alone = [(sum(table[b::CODES]) + smoothing) / (total + faith) for b in range(CODES)]
    kinds = [_kind(code) for code in range(CODES)]
    members = [max(1, sum(kind == k for kind in kinds)) for k in range(len(CLASSES) + 1)]
    pairs = [[0.0] * len(members) for _ in members]
    for a in range(CODES):
        for b in range(CODES):
            pairs[kinds[a]][kinds[b]] += table[a * CODES + b]
    found = []
    for a in range(CODES):
        row, of_kind = table[a * CODES : (a + 1) * CODES], pairs[kinds[a]]
        for n, chance, kind in zip(row, alone, kinds, strict=True):
            share = (of_kind[kind] + 1) / (sum(of_kind) + len(members)) / members[kind]
            own = (n + faith * chance) / (sum(row) + faith)
            found.append(math.log(mixed[0] * own + mixed[1] * share + mixed[2] / KNOWN))
    return found


def _kind(code: int) -> int:
    """The class of a character; the last one is what no run holds."""
    return next((i for i, members in enumerate(CLASSES) if chr(code) in members), len(CLASSES))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + x)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(lengths: Column) -> Column:
    """The sum of all lengths up to and with each place, block by block, so long arrays stay cheap."""

    def blocks(held: Column) -> Column:
        last = F.greatest(F.ceil(F.size(held) / BLOCK) - 1, F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: _sum(F.slice(held, i * BLOCK + 1, F.lit(BLOCK))))

    def up_to(held: Column, sums: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        return _sum(F.slice(sums, F.lit(1), block)) + _sum(F.slice(held, block * BLOCK + 1, i % BLOCK + 1))

    return _let(
        lengths,
        lambda held: _let(blocks(held), lambda sums: F.transform(held, lambda _, i: up_to(held, sums, i))),
    )


def _lengths(values: Column) -> Column:
    return F.transform(values, lambda x: F.char_length(x).cast("long"))


def _span(order: int, kind: str) -> Callable[[Column, Column], Column]:
    return lambda text, end: F.struct(
        (end - F.char_length(text)).alias("start"),
        F.lit(order).alias("order"),
        F.lit(kind).alias("kind"),
        end.alias("end"),
        text.alias("text"),
    )


def _ends(sizes: Column, gaps: Column) -> Column:
    """Where matches end: before match i lie the gaps up to i and the matches before it."""
    nothing = F.array().cast("array<bigint>")
    ends = F.zip_with(_running(sizes), _running(F.slice(gaps, 1, F.size(sizes))), lambda x, y: x + y)
    return F.when(F.size(sizes) > 0, ends).otherwise(nothing)


def _segments(ratios: Column, least: float) -> Column:
    """(start, end) of the segments of an array of ratios that reach ``least``, left to right."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    begin = F.struct(
        F.lit(0).alias("at"), F.lit(0.0).alias("sum"), F.lit(0).alias("start"),
        F.lit(0.0).alias("best"), F.lit(0).alias("end"), none.alias("found"),
    )

    def reached(state: Column) -> Column:
        held = F.array(F.struct(state["start"].alias("start"), state["end"].alias("end")))
        return F.when(state["best"] >= least, F.concat(state["found"], held)).otherwise(state["found"])

    def step(state: Column, ratio: Column) -> Column:
        total, after = state["sum"] + ratio, state["at"] + 1
        over = (total <= 0) | (state["best"] - total >= least)
        better = total > state["best"]
        kept = [
            ("sum", total, F.lit(0.0)),
            ("start", state["start"], after),
            ("best", F.greatest(state["best"], total), F.lit(0.0)),
            ("end", F.when(better, after).otherwise(state["end"]), after),
            ("found", state["found"], reached(state)),
        ]
        fields = [F.when(over, ended).otherwise(going).alias(name) for name, going, ended in kept]
        return F.struct(after.alias("at"), *fields)

    return F.aggregate(ratios, begin, step, reached)


def _length(part: Column, pattern: str) -> Column:
    return F.char_length(F.regexp_extract(part, pattern, 0))


def _snapped(run: Column, segment: Column, ratios: Column) -> Column:
    """A segment from the begin of its first letters and digits to the end of its last ones,
    or to the run's own ends where what lies beyond is less than ``EDGE`` below zero."""
    text, size = run["text"], F.char_length(run["text"])

    def neutral(part: Column) -> Column:
        return F.aggregate(part, F.lit(0.0), lambda total, x: total + x) > -EDGE

    start = F.when(neutral(F.slice(ratios, F.lit(1), segment["start"])), 0).otherwise(segment["start"])
    end = F.when(neutral(F.slice(ratios, segment["end"] + 1, size)), size).otherwise(segment["end"])
    body = F.substring(text, start + 1, end - start)
    lead = F.when(start > 0, _length(body, "^[+/_=-]*")).otherwise(0)
    tail = F.when(end < size, _length(body, "[+/_-]*$")).otherwise(0)
    before = F.when(lead == 0, _length(F.substring(text, F.lit(1), start), "[A-Za-z0-9]*$")).otherwise(0)
    after = F.when(tail == 0, _length(F.substring(text, end + 1, size), "^[A-Za-z0-9]*=*")).otherwise(0)
    return F.struct((start + lead - before).alias("start"), (end - tail + after).alias("end"))


def _joined(segments: Column) -> Column:
    """Segments that meet once they are snapped, as one."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(held: Column, one: Column) -> Column:
        last = F.element_at(held, -1)
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], one["end"]).alias("end"))
        meets = (F.size(held) > 0) & (F.try_element_at(held, F.lit(-1))["end"] >= one["start"])
        return F.when(meets, F.concat(F.slice(held, 1, F.size(held) - 1), F.array(wider))).otherwise(
            F.concat(held, F.array(one))
        )

    return F.aggregate(segments, none, step)


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id`` and ``spans``, an array of (start, order, kind, end, text).

    Positions are code points, ends exclusive; spans go by start, then kind.
    Matches of one base rule never overlap; rules may. The model's spans never
    overlap a base span; what a base rule matched but dropped for its length is
    not scored either. Null and empty texts have no spans; an empty table gives
    no rows; ids may be null or repeated; other columns are not read. A text of
    any length is scanned whole by one task.
    """
    rules = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    nothing = F.array().cast("array<string>")
    read = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    found = ["id"]
    for kind, rule in rules.items():
        hit = F.col("text").rlike(rule)
        found += [
            F.when(hit, F.regexp_extract_all("text", F.lit(rule), F.lit(0))).otherwise(nothing).alias(f"{kind}_text"),
            F.when(hit, _lengths(F.split("text", rule))).otherwise(nothing.cast("array<bigint>")).alias(f"{kind}_gap"),
        ]
    values = F.when(F.col("text").rlike(ASSIGN), F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)))
    # Where no base rule matches, and that is nearly everywhere, runs need no cutting.
    cut, whole = F.col("text").rlike(BASE), F.col("text").rlike(CANDIDATE)

    def pieces(extract: Callable[[str], Column], none: Column) -> Column:
        return F.when(cut, extract(PIECE)).when(whole, extract(CANDIDATE)).otherwise(none)

    found += [
        pieces(lambda rule: F.regexp_extract_all("text", F.lit(rule), F.lit(1)), nothing).alias("piece_text"),
        pieces(lambda rule: _lengths(F.regexp_extract_all("text", F.lit(rule), F.lit(0))), nothing.cast("array<bigint>")).alias("piece_size"),
        pieces(lambda rule: _lengths(F.split("text", rule)), nothing.cast("array<bigint>")).alias("piece_gap"),
    ]
    read = read.select(*found, _lengths(values).alias("assign_value"))
    for kind in rules:
        read = read.withColumn(f"{kind}_end", _ends(_lengths(F.col(f"{kind}_text")), F.col(f"{kind}_gap")))
    read = read.withColumn("piece_end", _ends(F.col("piece_size"), F.col("piece_gap")))
    spans = {kind: F.zip_with(f"{kind}_text", f"{kind}_end", _span(order, kind)) for order, kind in enumerate(rules)}
    spans["assign"] = F.filter(spans["assign"], lambda _, i: F.element_at("assign_value", i + 1) >= LEAST_VALUE)
    # Base matches among the pieces are empty.
    runs = F.zip_with("piece_text", "piece_end", _span(len(rules), MODEL_KIND))
    runs = F.filter(runs, lambda run: run["text"].rlike(CANDIDATE))
    read = read.select("id", F.concat(*[spans[kind] for kind in BASE_KINDS]).alias("base"), runs.alias("runs"))
    # A literal that the optimizer folds once: one number per pair of ASCII codes.
    ratios = F.from_json(F.lit(str(list(model.ratios))), "array<double>")

    def random_parts(run: Column) -> Column:
        codes = _codes(run["text"])
        each = F.zip_with(_before(codes), codes, lambda a, b: F.element_at(ratios, a * CODES + b + 1))
        segments = _let(
            each, lambda held: _joined(F.transform(_segments(held, LEAST_RATIO), lambda one: _snapped(run, one, held)))
        )
        return F.transform(
            segments,
            lambda one: F.struct(
                (run["start"] + one["start"]).alias("start"),
                run["order"].alias("order"),
                run["kind"].alias("kind"),
                (run["start"] + one["end"]).alias("end"),
                F.substring(run["text"], one["start"] + 1, one["end"] - one["start"]).alias("text"),
            ),
        )

    def trimmed(part: Column) -> Column:
        """Without the separators that stand between it and a base span."""
        lead = F.when(F.exists("base", lambda one: one["end"] == part["start"]), _length(part["text"], "^[+/_=-]*")).otherwise(0)
        tail = F.when(F.exists("base", lambda one: one["start"] == part["end"]), _length(part["text"], "[+/_=-]*$")).otherwise(0)
        text = F.substring(part["text"], lead + 1, F.char_length(part["text"]) - lead - tail)
        ends = ((part["start"] + lead).alias("start"), part["order"].alias("order"), part["kind"].alias("kind"), (part["end"] - tail).alias("end"))
        return F.struct(*ends, text.alias("text"))

    def free(run: Column) -> Column:
        return ~F.exists("base", lambda one: (one["start"] < run["end"]) & (run["start"] < one["end"]))

    # A base match may begin inside another one's; what lies in its rest is not added. Nor are numbers.
    parts = F.transform(F.flatten(F.transform("runs", random_parts)), trimmed)
    added = F.filter(parts, lambda one: one["text"].rlike("[A-Za-z]") & free(one))
    return read.select("id", F.array_sort(F.concat("base", added)).alias("spans"))


def of_kind(spans: Column | str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
