"""Secret scan: patterns, and character Markov models for random strings the patterns don't know. Spark's own functions only."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from morbidity.llm.common import table
from morbidity.llm.quality import let

#: The pattern of the kind assign, and the least length of a match (for assign, of group 2).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LEAST = {"assign": 12, "access": 18, "hex": 16}
NAMES = ("assign", "access", "hex", "random")
CUES = ("password", "passwd", "secret", "token", "api_key", "apikey")

RUN = "[A-Za-z0-9+/_=-]{20,}"  # what the models look at: whole runs,
PART = "[A-Za-z0-9+]{12,}"  # and what lies between separators
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SAMPLE_ROWS = 20_000  # about so many rows are looked through for labelled strings
PLAIN_ROWS = 2_000  # and so many of them for ordinary words
MARGIN = 0.5  # mean log-likelihood ratio of two neighbouring characters, in nats
VARIETY = 6  # different characters at least
PAIRS = 19  # a string of fewer pairs needs the sum that so many would need


def places(text: Column, pattern: str, group: int = 0, least: int = 0, keep: Callable[[Column], Column] | None = None) -> Column:
    """array<struct<start, end>> of the matches whose group has ``least`` characters or more, and that ``keep`` is true for, in code points.

    What lies between the matches, and the matches, are taken out by two passes of the same pattern; their lengths
    in turn give the places.
    """
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def walk(found: Column) -> Column:
        def sizes(m: Column, i: Column) -> Column:
            good = F.length(F.get(found["g"], i)) >= least
            gap = F.length(F.get(found["p"], i)).alias("gap")
            return F.struct(gap, F.length(m).alias("n"), (good & keep(m) if keep else good).alias("good"))

        def on(a: Column, x: Column) -> Column:
            start = a["at"] + x["gap"]
            span = F.array(F.struct(start.alias("start"), (start + x["n"]).alias("end")))
            return F.struct((start + x["n"]).alias("at"), F.when(x["good"], F.concat(a["out"], span)).otherwise(a["out"]).alias("out"))

        return F.aggregate(F.transform(found["m"], sizes), F.struct(F.lit(0).alias("at"), none.alias("out")), on, lambda a: a["out"])

    return let(F.struct(pieces.alias("p"), matches.alias("m"), groups.alias("g")), walk)


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``assign``, ``access`` and ``hex``: the spans of each kind; null text counts as empty.

    A pattern is only run on texts that hold what each of its matches holds. For access and hex, a run too short to
    count can't hide a longer one, so their least lengths are part of the patterns.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<struct<start:int,end:int>>")
    cued = let(F.lower(whole), lambda t: F.exists(F.array(*[F.lit(c) for c in CUES]), lambda c: F.contains(t, c)))
    access = rf"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}"
    hexes = rf"[0-9a-f]{{{LEAST['hex']},}}"
    return docs.withColumns(
        {
            "assign": F.when(cued, places(whole, ASSIGN, 2, LEAST["assign"])).otherwise(none),
            "access": F.when(F.contains(whole, F.lit("AKIA")), places(whole, access)).otherwise(none),
            "hex": F.when(whole.rlike(hexes), places(whole, hexes)).otherwise(none),
        }
    )


def _counts(strings: DataFrame) -> dict[tuple[str, str], int]:
    """Neighbouring characters of the alphabet in a column ``s``; at most the square of the alphabet's size reaches the driver."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring("s", i, F.lit(2)))
    rows = strings.where(F.length("s") > 1).select(F.explode(pairs).alias("p")).where(F.col("p").rlike(r"^[A-Za-z0-9+/_=-]{2}$"))
    return {(r.p[0], r.p[1]): r["count"] for r in rows.groupBy("p").count().collect()}


def train(
    docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS, plain_rows: int = PLAIN_ROWS, doc_id: str = "doc_id"
) -> list[float]:
    """Log-likelihood ratios (random against ordinary) of all pairs of neighbouring characters, row by row.

    Labelled samples come from about ``sample_rows`` rows, drawn by a hash of text and id (where there is one), so that copies are drawn
    apart: what the patterns find there is random; words of four letters and more, identifiers of words, and numbers of four
    digits and more, are ordinary. Each pair counts once more than seen, so that without any rows all ratios are 0.
    """
    rows = max(1, docs.count())
    drawn = F.pmod(F.xxhash64(text, *[c for c in docs.columns if c == doc_id], F.lit(10)), F.lit(1_000_000))
    few = docs.select(F.col(text).alias("text")).where(drawn < int(1e6 * min(1.0, sample_rows / rows)))
    spans = base_spans(few)
    cut = F.transform(
        F.concat("assign", "access", "hex"), lambda x: F.regexp_extract(F.substring("text", x["start"] + 1, x["end"] - x["start"]), "[A-Za-z0-9+/_=-]+$", 0)
    )
    random = _counts(spans.select(F.explode(cut).alias("s")))
    fewer = docs.select(F.col(text).alias("text")).where(drawn < int(1e6 * min(1.0, plain_rows / rows)))
    word = F.regexp_extract_all("text", F.lit("(?<![A-Za-z0-9+/_=-])(?:[A-Za-z_]{4,}|[0-9]{4,})(?![A-Za-z0-9+/_=-])"), F.lit(0))
    plain = _counts(fewer.select(F.explode(word).alias("s")))

    def logs(counts: dict) -> list[float]:
        out = []
        for a in ALPHABET:
            total = sum(counts.get((a, b), 0) for b in ALPHABET) + len(ALPHABET)
            out += [math.log((counts.get((a, b), 0) + 1) / total) for b in ALPHABET]
        return out

    return [x - y for x, y in zip(logs(random), logs(plain))]


def random_spans(text: Column, ratios: list[float], known: Column, margin: float = MARGIN) -> Column:
    """Spans, by start, of strings whose neighbouring characters are, on average, likelier under the random model by ``margin``, and in all by
    what ``PAIRS`` pairs would need: whole runs, and parts between separators outside those runs. None overlaps a ``known`` span; a string
    without a letter is a number, and one of fewer than ``VARIETY`` characters a rule or a filler."""
    n = len(ALPHABET)
    codes = F.lit([ALPHABET.find(chr(i)) for i in range(128)])
    table_ = F.lit([round(x, 6) for x in ratios])

    def likelier(s: Column) -> Column:
        at = F.transform(F.split(s, ""), lambda c: F.get(codes, F.ascii(c)))

        def enough(k: Column) -> Column:
            pairs = F.zip_with(F.slice(k, 1, F.size(k) - 1), F.slice(k, 2, F.size(k) - 1), lambda a, b: F.get(table_, a * n + b))
            return F.aggregate(pairs, F.lit(0.0), lambda x, y: x + y) > margin * F.greatest(F.size(k) - 1, F.lit(PAIRS))

        return s.rlike("[A-Za-z]") & let(at, lambda k: (F.size(F.array_distinct(k)) >= VARIETY) & enough(k))

    def apart(spans: Column, others: Column) -> Column:
        return F.filter(spans, lambda x: ~F.exists(others, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))

    def both(runs: Column) -> Column:
        return F.array_sort(F.concat(runs, apart(places(text, PART, keep=likelier), F.concat(known, runs))))

    found = let(apart(places(text, RUN, keep=likelier), known), both)
    return F.when(text.rlike(PART) | text.rlike(RUN), found).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def _listed(arrays: list[str]) -> Column:
    """kind:start:end by start, then kind."""

    def of_kind(kind: int) -> Column:
        spans = arrays[kind]
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))

    every = F.concat(*[of_kind(k) for k in range(len(arrays))])
    names = F.array(*[F.lit(c) for c in NAMES])
    text = F.transform(F.array_sort(every), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"]))
    return F.array_join(text, ",")


def scan(docs: DataFrame, ratios: list[float], text: str = "text") -> DataFrame:
    """``docs`` with spans ``assign``, ``access``, ``hex`` and ``random``; such columns are replaced.

    A run that overlaps one of the others is left out, its parts outside are not. Null text is empty and has none; no row is dropped.
    """
    based = base_spans(docs.drop("random"), text)
    known = F.concat("assign", "access", "hex")
    return based.withColumn("random", random_spans(F.coalesce(F.col(text), F.lit("")), ratios, known))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = scan(docs, train(docs))
    return found.select(
        "doc_id",
        *[F.size(c).cast("long").alias(f"n_{c}") for c in NAMES[:3]],
        F.sha2(_listed(list(NAMES[:3])), 256).alias("base_sha256"),
        _listed(list(NAMES)).alias("spans"),
    )
