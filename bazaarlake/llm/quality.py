"""Quality rules whose thresholds follow the data: DataFrame functions only.

Each measure of a document is a whole number. A sketch is a histogram of it over
buckets of bounded relative width, held as rows (group, measure, bucket, count).
Sketches merge by adding counts, in any order and with the same result, so the
sketch of a language is the sum of those of its sources. Quantiles read from
them give fences per (language, source), joined back to the documents.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import SPACES, free_name, let, same, words, written
from bazaarlake.session import tune

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Fences at the quartiles, ``reach`` spreads out.

    The spread is the distance of the quartiles, but at least ``least``, so that
    a measure that is nearly always the same does not reject the rest.
    """

    measure: str
    reach: int
    least: int
    low: bool = False


RULES = (
    Rule("mean_word", 4, 40, low=True),  # hundredths of a character
    Rule("symbol_share", 4, 10),  # per mille of the words' characters
    Rule("repeat_line_share", 4, 100),  # per mille of the lines
    Rule("repeat_word_share", 4, 75),  # per mille of the words; where few repeat, as the base
    Rule("echo_share", 20, 5),  # words equal to the one before, per mille
)
_STEPS = 16  # buckets per power of two: width at most 1/16 of the value


def _repeated_words(tokens: Column, window: int) -> Column:
    """Words inside windows that the text has more than once."""
    size = F.size(tokens)
    hashes = let(
        F.transform(tokens, lambda w: F.xxhash64(w)),
        lambda h: F.transform(
            F.sequence(F.lit(1), size - (window - 1)),
            lambda i: F.xxhash64(F.slice(h, i, window)),
        ),
    )

    def covered(starts: Column) -> Column:
        """Length of the union of [start, start + window)."""
        gaps = F.zip_with(
            F.slice(starts, 1, F.size(starts) - 1),
            F.slice(starts, 2, F.size(starts) - 1),
            lambda a, b: F.least(b - a, F.lit(window)),
        )
        return F.aggregate(gaps, F.lit(window), lambda s, g: s + g)

    def starts(h: Column) -> Column:
        marked = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(
            marked,
            lambda m: F.array_sort(
                F.array_distinct(
                    F.flatten(
                        F.zip_with(
                            F.slice(m, 1, F.size(m) - 1),
                            F.slice(m, 2, F.size(m) - 1),
                            lambda a, b: F.when(
                                a["h"] == b["h"], F.array(a["i"], b["i"])
                            ).otherwise(F.array().cast("array<int>")),
                        )
                    )
                )
            ),
        )

    found = let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(starts(h), covered)
        ),
    )
    return F.when(size <= window, F.lit(0)).otherwise(found).cast("long")


def counts_of(text: Column, window: int = 8) -> Column:
    """A struct of counts of the whole text (NULL: empty)."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(
        F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0
    )

    def counts(tokens: Column) -> Column:
        return F.struct(
            F.size(tokens).cast("long").alias("n_words"),
            F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, "")))
            .cast("long")
            .alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias(
                "n_dup_lines"
            ),
            F.size(lines).cast("long").alias("n_lines"),
            _repeated_words(tokens, window).alias("n_repeat_words"),
            F.size(F.filter(tokens, lambda w, i: w == F.get(tokens, i - 1)))
            .cast("long")
            .alias("n_echoes"),
        )

    return let(words(text), counts)


def base_failed(m: Column) -> Column:
    """Too short, or too much of the text repeats."""
    return (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])


def measures(m: Column) -> dict[str, Column]:
    """The rules' measures as whole numbers; 0 where nothing is divided by."""

    def share(part: Column, whole: Column, scale: int) -> Column:
        return F.floor(part * scale / F.greatest(whole, F.lit(1))).cast("long")

    return {
        "mean_word": share(m["word_chars"], m["n_words"], 100),
        "symbol_share": share(m["n_symbols"], m["word_chars"], 1000),
        "repeat_line_share": share(m["n_dup_lines"], m["n_lines"], 1000),
        "repeat_word_share": share(m["n_repeat_words"], m["n_words"], 1000),
        "echo_share": share(m["n_echoes"], m["n_words"], 1000),
    }


def bucket(value: Column) -> Column:
    """Lower end of the value's bucket: exact below 16, then 16 per doubling."""
    shift = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    width = F.pow(F.lit(2.0), shift).cast("long")
    return (F.floor(value / width) * width).cast("long")


def sketch(values: DataFrame, groups: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Histogram rows: the groups, ``measure``, ``bucket``, ``n``."""
    long = values.select(
        *groups,
        F.explode(
            F.array(
                *[F.struct(F.lit(k).alias("measure"), bucket(F.col(k)).alias("bucket")) for k in names]
            )
        ).alias("s"),
    )
    return long.groupBy(*groups, "s.measure", "s.bucket").agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Sketches of finer groups added up."""
    return sketches.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The groups, ``measure``, ``n``, ``q1``, ``q3``: first bucket that reaches the share."""
    by = [*groups, "measure"]
    order = Window.partitionBy(*by).orderBy("bucket")
    run = sketches.withColumn("_run", F.sum("n").over(order)).withColumn(
        "_all", F.sum("n").over(Window.partitionBy(*by))
    )

    def first(quarters: int) -> Column:
        return F.min(F.when(4 * F.col("_run") >= quarters * F.col("_all"), F.col("bucket")))

    return run.groupBy(*by).agg(
        F.max("_all").alias("n"), first(1).alias("q1"), first(3).alias("q3")
    )


def thresholds(
    sketches: DataFrame, groups: Sequence[str], rules: Sequence[Rule], enough: int
) -> DataFrame:
    """One row per finest group and measure with ``low`` and ``high`` fences.

    A group with fewer than ``enough`` values uses the sketch of its first
    column's value (the language), and that failing the sketch of everything.
    """
    own = quartiles(sketches, groups)
    first = groups[0]
    lang = quartiles(merge(sketches, [first]), [first])
    whole = quartiles(merge(sketches, []), [])

    def named(df: DataFrame, tag: str, keys: Sequence[str]) -> DataFrame:
        return df.select(
            *[F.col(k).alias(f"{tag}_{k}") for k in [*keys, "measure", "n", "q1", "q3"]]
        )

    a, b, c = named(own, "a", groups), named(lang, "b", [first]), named(whole, "c", [])
    joined = a.join(
        b,
        F.col(f"a_{first}").eqNullSafe(F.col(f"b_{first}"))
        & (F.col("a_measure") == F.col("b_measure")),
    ).join(c, F.col("a_measure") == F.col("c_measure"))

    def pick(q: str) -> Column:
        return (
            F.when(F.col("a_n") >= enough, F.col(f"a_{q}"))
            .when(F.col("b_n") >= enough, F.col(f"b_{q}"))
            .otherwise(F.col(f"c_{q}"))
        )

    chosen = joined.select(
        *[F.col(f"a_{g}").alias(g) for g in groups],
        F.col("a_measure").alias("measure"),
        pick("q1").alias("q1"),
        pick("q3").alias("q3"),
    )
    low = high = F.lit(None).cast("long")
    for rule in rules:
        here = F.col("measure") == rule.measure
        out = rule.reach * F.greatest(F.col("q3") - F.col("q1"), F.lit(rule.least))
        high = F.when(here, F.col("q3") + out).otherwise(high)
        if rule.low:
            low = F.when(here, F.col("q1") - out).otherwise(low)
    return chosen.select(*groups, "measure", low.alias("low"), high.alias("high"))


def verdicts(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    groups: Sequence[str] = ("lang", "source"),
    text_col: str = "text",
    enough: int = 200,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Per document: ``row`` (struct of its columns), ``counts``, ``base_failed``, ``kept``.

    Thresholds come from all documents that pass the base. NULL text is empty and
    fails the base; a NULL language or source is a group of its own; repeated rows
    count as often as they occur; no rows give none. Other columns may have any
    name: they travel inside ``row`` (``columns`` names those wanted).

    Each text is measured once: the counts are written to the shared folder with
    the wanted columns. Only counts, never texts, are grouped. The fences are few
    rows (groups x rules), joined by Spark's measured size.
    """
    tune(docs.sparkSession)
    wanted = docs.columns if columns is None else columns
    keys = [f"g{i}" for i, _ in enumerate(groups)]
    names = [r.measure for r in rules]
    seen = written(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in wanted]).alias("row"),
            *[F.col(f"`{g}`").alias(k) for k, g in zip(keys, groups, strict=True)],
            counts_of(F.col(f"`{text_col}`")).alias("counts"),
        ),
        "measured",
    )
    got = measures(F.col("counts"))
    seen = seen.select("*", *[got[k].alias(k) for k in names])
    passed = seen.filter(~base_failed(F.col("counts"))).select(*keys, *names)
    fences = thresholds(sketch(passed, keys, names), keys, rules, enough)
    wide = fences.groupBy(*[F.col(k).alias(f"f_{k}") for k in keys]).agg(
        *[
            F.max(F.when(F.col("measure") == r.measure, F.col(side))).alias(f"{side}_{r.measure}")
            for r in rules
            for side in ("low", "high")
        ]
    )
    on = reduce(lambda a, b: a & b, [same(F.col(k), F.col(f"f_{k}")) for k in keys])
    failed = base_failed(F.col("counts"))
    good = ~failed
    for rule in rules:
        good = good & (F.col(rule.measure) <= F.col(f"high_{rule.measure}"))
        if rule.low:
            good = good & (F.col(rule.measure) >= F.col(f"low_{rule.measure}"))
    return seen.join(wide, on, "left").select(
        "row", "counts", failed.alias("base_failed"), F.coalesce(good, F.lit(False)).alias("kept")
    )


def keep_good(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    groups: Sequence[str] = ("lang", "source"),
    **options,
) -> DataFrame:
    """The documents the rules keep, with their own columns.

    Rows are told apart by their id and a hash of what the rules see, so only counts
    are written; a row's text is shuffled once, to its verdict.
    """
    seen, key, mark = (free_name(docs.columns, n) for n in ("seen", "kept_id", "kept_hash"))
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in (text_col, *groups)])
    found = verdicts(
        docs.withColumn(seen, hashed), text_col=text_col, groups=groups, columns=[id_col, seen], **options
    )
    kept = found.filter("kept").select(
        F.col(f"row.`{id_col}`").alias(key), F.col(f"row.`{seen}`").alias(mark)
    ).distinct()
    return docs.join(kept, same(F.col(f"`{id_col}`"), F.col(key)) & (hashed == F.col(mark)), "left_semi")
